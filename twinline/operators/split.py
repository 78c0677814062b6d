"""Seeded, partition-independent ordering and splitting.

Rows are ordered by ``md5(seed:[epoch:]key...)`` -- the same hex string in
Spark and in SQL engines -- with the key itself as tie-break.  The split is
exact (``ceil(p * n)`` test rows) and needs no global sort: per-bucket
counts find the one hash bucket holding the boundary, that bucket alone is
ranked, and the result is a plain predicate on each row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import TEST_SHARE
from ..session import ensure_checkpoint_dir
from .numbering import bucket_counts, hash_bucket, hash_digits_for, hash_threshold, tuple_le


def row_hash(seed: int | str, key_cols: list[str], epoch: int | None = None) -> Column:
    """md5 hex of ``seed:[epoch:]k1:k2...`` (keys cast to string)."""
    parts = [F.lit(str(seed))]
    if epoch is not None:
        parts.append(F.lit(str(epoch)))
    parts += [F.col(c).cast("string") for c in key_cols]
    return F.md5(F.concat_ws(":", *parts))


def epoch_order_key(seed: int | str, key_cols: list[str], epoch: int) -> Column:
    """Per-epoch shuffle key; order by (this, *key_cols)."""
    return row_hash(seed, key_cols, epoch)


def test_rows(n: int, test_share: float) -> int:
    """Number of test rows: ceil(p * n) computed in double precision."""
    return int(math.ceil(test_share * n))


def train_test_split(df: DataFrame, key_cols: list[str], test_share: float = TEST_SHARE,
                     seed: int | str = 42, split_col: str = "split",
                     n_rows: int | None = None, materialize: bool = False,
                     digits: int | None = None) -> DataFrame:
    """Mark exactly ceil(test_share * n) rows 'test', the rest 'train'.

    Test rows are the smallest by (md5(seed:key), key).  One bucket
    histogram (<= 16**digits rows; its sum is n) and one ranked bucket reach
    the driver; the data itself is only filtered.  With ``materialize`` the
    keys (not the rows) are reliably checkpointed first, so the upstream plan
    runs once for them instead of once per pass.
    """
    h = "_split_hash"
    keys = df.select(*key_cols).withColumn(h, row_hash(seed, key_cols))
    if materialize:
        ensure_checkpoint_dir(df.sparkSession)
        keys = keys.checkpoint(eager=True)  # keys only: no text is stored
    if digits is None:
        digits = hash_digits_for(n_rows if n_rows is not None else 1 << 20)
    hist = bucket_counts(keys, h, digits)
    n = sum(c for _, c in hist)
    if n_rows is None and hash_digits_for(n) != digits:
        digits = hash_digits_for(n)
        hist = bucket_counts(keys, h, digits)
    k = test_rows(n, test_share)
    found = hash_threshold(keys, h, key_cols, k, digits, hist)
    if found is None:
        is_test = F.lit(False)
    else:
        bucket, row = found
        b = hash_bucket(F.col(h), digits)
        is_test = (b < F.lit(bucket)) | ((b == F.lit(bucket)) & tuple_le([h, *key_cols], list(row)))
    return (df.withColumn(h, row_hash(seed, key_cols))
            .withColumn(split_col, F.when(is_test, F.lit("test")).otherwise(F.lit("train"))).drop(h))


def hash_share_split(df: DataFrame, key_cols: list[str], test_share: float = TEST_SHARE, seed: int | str = 42,
                     split_col: str = "split") -> DataFrame:
    """T2, cheap mode: a row is 'test' if its hash lies in the lowest
    ``test_share`` of the range.  No pass over the data; the size is
    approximate."""
    bits = F.conv(F.substring(row_hash(seed, key_cols), 1, 12), 16, 10).cast("double")
    return df.withColumn(split_col, F.when(bits < test_share * 16.0**12, F.lit("test")).otherwise(F.lit("train")))


def select_split(df: DataFrame, name: str, split_col: str = "split") -> DataFrame:
    """One split; a partition filter when the data is partitioned by split."""
    return df.where(F.col(split_col) == name)


def dataset_summary(df: DataFrame, by: tuple[str, ...] = ("corpus", "split")) -> DataFrame:
    """A1: rows per group (partial aggregation, no skew hazard)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("num_rows"))
