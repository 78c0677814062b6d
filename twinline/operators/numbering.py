"""Ordered positions without a single-partition window.

Two building blocks used by line numbering (W1), the train/test split (T2)
and batch assignment (W2):

``prefix_offsets``
    exclusive running sum of a weight inside a group, ordered by any columns: a
    distributed scan.  Rows are sorted once over the cluster (sampled splitters
    on the order), which gives each a place in its partition; every
    ``block_rows`` places of a partition are a block.  A window per (group, block) sums inside
    it, and a running sum over the per-block totals, a table ``block_rows`` times
    smaller, gives what lies before.  No window partition holds more than
    ``block_rows`` rows, whatever the distribution of keys and groups.

``hash_rank``
    1-based global rank in the order of a uniform hex hash (md5) with a
    tie-break.  Rows are bucketed by the first hex digits of the hash, so
    buckets are balanced by construction; per-bucket counts (a table of at
    most 16**digits rows, a bound fixed by the parameter) are prefix-summed
    and broadcast; a window per bucket numbers rows inside it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .skew import null_safe_join

MAX_HASH_DIGITS = 5  # at most 16**5 = 1,048,576 buckets (~16 MB offset table)


PLACE_BITS = 33  # of a monotonically increasing id: the rest is the partition


def ordered_blocks(df: DataFrame, order: list[Column], block_rows: int, place_col: str = "_scan_at",
                   block_col: str = "_scan_block") -> DataFrame:
    """Add two longs that follow ``order``: a place, different for each row, and
    a block of at most ``block_rows`` rows.  The result is checkpointed: places
    must not change between its readers."""
    ensure_checkpoint_dir(df.sparkSession)
    place = F.col(place_col)
    inside = F.floor(place.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) / F.lit(block_rows))
    first = F.shiftleft(F.shiftright(place, PLACE_BITS), PLACE_BITS)
    placed = df.orderBy(*order).withColumn(place_col, F.monotonically_increasing_id())
    return placed.withColumn(block_col, (first + inside).cast("long")).checkpoint(eager=True)


def block_offsets(placed: DataFrame, group_cols: list[str], weight_col: str, out_col: str) -> DataFrame:
    """From ``ordered_blocks`` (ordered by group first): ``out_col`` = sum of
    ``weight_col`` over the rows of the same group at smaller places."""
    at, blk = "_scan_at", "_scan_block"
    in_block = Window.partitionBy(*group_cols, blk).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*group_cols, blk).agg(F.sum(weight_col).alias("_scan_tot"))
    before = Window.partitionBy(*group_cols).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*group_cols, blk, F.coalesce(F.sum("_scan_tot").over(before), F.lit(0)).alias("_scan_before"))
    d = placed.withColumn("_scan_in", F.coalesce(F.sum(weight_col).over(in_block), F.lit(0)))
    return (null_safe_join(d, totals, [*group_cols, blk])
            .withColumn(out_col, (F.col("_scan_before") + F.col("_scan_in")).cast("long"))
            .drop(at, blk, "_scan_in", "_scan_before"))


def prefix_offsets(df: DataFrame, group_cols: list[str], order_col: str | list[str], weight_col: str,
                   out_col: str = "offset", block_rows: int = 1 << 16) -> DataFrame:
    """Add ``out_col`` = sum of ``weight_col`` over the rows of the same group
    that come before this row in ``order_col`` order (exclusive prefix sum),
    nulls last.  The order must be unique inside a group; a null group is a
    group like any other.  ``df`` should be narrow: it is sorted and
    checkpointed."""
    by = [*group_cols, *([order_col] if isinstance(order_col, str) else order_col)]
    return block_offsets(ordered_blocks(df, [F.col(c).asc_nulls_last() for c in by], block_rows), group_cols, weight_col, out_col)


def hash_digits_for(n_rows: int, rows_per_bucket: int = 1 << 14) -> int:
    """Hex digits of the bucket key so that a bucket holds about
    ``rows_per_bucket`` rows; at least two, so that a cluster has tasks."""
    return min(MAX_HASH_DIGITS, max(2, math.ceil(math.log(max(n_rows, 1) / rows_per_bucket, 16))))


def hash_bucket(hash_col: Column, digits: int) -> Column:
    return F.conv(F.substring(hash_col, 1, digits), 16, 10).cast("long")


def hash_rank(df: DataFrame, hash_col: str, tie_cols: list[str], digits: int,
              out_col: str = "rank", keep_bucket: bool = False, with_offsets: bool = False):
    """Add a 1-based global rank ordered by (hash_col, *tie_cols).

    With ``keep_bucket`` the bucket column ``_hr_bucket`` is kept: the
    result is hash-partitioned by it, so later windows keyed by
    (bucket, ...) need no new exchange.  With ``with_offsets`` the small
    per-bucket offset table is returned too.
    """
    if digits > MAX_HASH_DIGITS:
        raise ValueError(f"digits must be <= {MAX_HASH_DIGITS}")
    b = "_hr_bucket"
    d = df.withColumn(b, hash_bucket(F.col(hash_col), digits))
    counts = d.groupBy(b).agg(F.count(F.lit(1)).alias("_hr_n"))
    # at most 16**digits rows: a bounded, broadcastable table
    offsets = counts.select(
        b, F.coalesce(F.sum("_hr_n").over(Window.orderBy(b).rowsBetween(Window.unboundedPreceding, -1)),
                      F.lit(0)).alias("_hr_off"))
    w = Window.partitionBy(b).orderBy(hash_col, *tie_cols)
    out = (d.withColumn("_hr_rn", F.row_number().over(w))
           .join(F.broadcast(offsets), b)
           .withColumn(out_col, (F.col("_hr_off") + F.col("_hr_rn")).cast("long"))
           .drop("_hr_rn", "_hr_off"))
    out = out if keep_bucket else out.drop(b)
    # offsets: (_hr_bucket, _hr_off) -- rows before each bucket; bounded table
    return (out, offsets) if with_offsets else out


def bucket_counts(df: DataFrame, hash_col: str, digits: int) -> list[tuple[int, int]]:
    """Rows per hash bucket, sorted by bucket (<= 16**digits rows reach the
    driver); their sum is the row count, so no separate count pass is needed."""
    b = hash_bucket(F.col(hash_col), digits).alias("_b")
    return sorted((int(r[0]), int(r[1])) for r in df.groupBy(b).count().collect())


def hash_threshold(df: DataFrame, hash_col: str, tie_cols: list[str], k: int, digits: int,
                   counts: list[tuple[int, int]] | None = None):
    """The k-th smallest (hash, *tie) tuple, found without sorting all rows.

    Per-bucket counts (<= 16**digits rows) reach the driver; only the one
    bucket that holds the k-th row is ranked.  Returns (bucket, row) or None
    when k <= 0.
    """
    if k <= 0:
        return None
    b = "_ht_bucket"
    d = df.withColumn(b, hash_bucket(F.col(hash_col), digits))
    if counts is None:
        counts = bucket_counts(df, hash_col, digits)
    seen = 0
    for bucket, n in counts:
        if seen + n >= k:
            r = k - seen
            w = Window.partitionBy(b).orderBy(hash_col, *tie_cols)
            row = (d.where(F.col(b) == bucket)
                   .withColumn("_ht_rn", F.row_number().over(w))
                   .where(F.col("_ht_rn") == r)
                   .select(hash_col, *tie_cols).first())
            return bucket, row
        seen += n
    raise ValueError(f"k={k} exceeds the row count {seen}")


def tuple_le(cols: list[str], values: list) -> Column:
    """Lexicographic (c1, c2, ...) <= (v1, v2, ...) as a native predicate."""
    cond = None
    for i in range(len(cols) - 1, -1, -1):
        c, v = F.col(cols[i]), F.lit(values[i])
        cond = (c <= v) if cond is None else ((c < v) | ((c == v) & cond))
    return cond
