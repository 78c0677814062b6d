"""Exact dedup by a content sort (built-in functions only).

Method.  Bounded keys of a row sample give splitters that cut the order
(first characters of the normalised text, its hash, -length, id, a hash of the
row's place) into range buckets; one exchange brings each bucket together, Spark's
external sort puts equal texts next to each other, and every row is compared in
full with its neighbour.  Id and place are part of the range key, so a group of
copies that holds a third of all rows is cut over many buckets, even if the rows
share an id or have none; the pieces of a group that
touch a bucket's edge (at most a few rows a bucket) are then joined by their
whole text.

Defined results: a null text counts as empty, and texts that are empty after
normalisation are equal to each other; ties on length go to the smallest id,
null ids last; of rows repeated with the same id exactly one is kept; columns
other than the two named are ignored, whatever their names.  An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinline.llm.common import (
    cut,
    keep_rows,
    ordered_hex,
    sha256_hex,
    shuffle_partitions,
    splitter_bucket,
    strip_spaces,
    text_or_empty,
    with_row_key,
)

PREFIX_CHARS = 12         # characters of text in a range key
BUCKETS_PER_PARTITION = 8  # range buckets per shuffle partition
MAX_BUCKETS = 1 << 14      # bounds the splitters, the sample and the edge table
SAMPLE_PER_BUCKET = 24     # sampled keys per bucket (expected)


def content_key(norm: Column) -> Column:
    """Equal texts have equal keys; 12 characters and a 64-bit hash bound its size."""
    prefix = F.replace(F.substring(norm, 1, PREFIX_CHARS), F.lit("\n"), F.lit(" "))
    return F.concat(prefix, F.lit("\x00"), F.lpad(F.hex(F.xxhash64(norm)), 16, "0"))


def sample_splitters(keyed: DataFrame, key: str, buckets: int, sample_rows: int, total: int) -> list[str]:
    """``buckets - 1`` quantiles of about ``sample_rows`` sampled keys."""
    if total == 0 or buckets < 2:
        return []
    fraction = min(1.0, sample_rows / total)
    rows = keyed.sample(fraction, seed=17) if fraction < 1 else keyed
    keys = sorted(r[0] for r in rows.select(key).collect())  # bounded: SAMPLE_PER_BUCKET * MAX_BUCKETS short keys
    cuts = {keys[len(keys) * i // buckets] for i in range(1, buckets)} if keys else set()
    return sorted(cuts)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                buckets: int | None = None) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    spark = docs.sparkSession
    buckets = buckets or min(MAX_BUCKETS, BUCKETS_PER_PARTITION * shuffle_partitions(spark))
    raw = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    total = docs.count()

    def keyed(rows: DataFrame) -> DataFrame:
        # the place only spreads rows that are equal in all else: any bucket will do for them
        d = rows.select("_id", strip_spaces(F.col("_text")).alias("_norm"), F.length("_text").alias("_len"),
                        F.hex(F.xxhash64(F.monotonically_increasing_id())).alias("_spread"))
        return d.withColumn("_content", content_key(F.col("_norm")))

    def full_key() -> Column:
        return F.concat("_content", ordered_hex(-F.col("_len").cast("long")), ordered_hex(F.col("_id").cast("long")),
                        F.lpad("_spread", 16, "0"))

    sample_rows = SAMPLE_PER_BUCKET * buckets
    fraction = min(1.0, sample_rows / max(1, total))
    sampled = raw.sample(fraction, seed=17) if fraction < 1 else raw  # before normalising: only sampled rows pay for it
    splitters = sample_splitters(keyed(sampled).select(full_key().alias("_k")), "_k", buckets, sample_rows,
                                 min(total, sample_rows))
    rows = keyed(raw).withColumn("_b", splitter_bucket(full_key(), splitters))

    last_id = F.coalesce(F.col("_id").cast("long"), F.lit((1 << 63) - 1))
    order = [F.col("_content"), F.col("_norm"), F.col("_len").desc(), last_id]
    sorted_w = Window.partitionBy("_b").orderBy(*order)
    whole = sorted_w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = rows.withColumn("_prev", F.lag("_norm").over(sorted_w))
    d = d.withColumn("_new", F.when(F.col("_prev").isNull() | (F.col("_prev") != F.col("_norm")), 1).otherwise(0))
    d = d.withColumn("_run", F.sum("_new").over(sorted_w))
    edge = (F.col("_content") == F.first("_content").over(whole)) | (F.col("_content") == F.last("_content").over(whole))
    d = d.withColumn("_edge", edge)
    d = d.select("_id", "_b", "_run", "_len", "_new", "_edge",
                 sha256_hex(F.col("_norm")).alias("_sha"),
                 F.when(F.col("_edge") & (F.col("_new") == 1), F.col("_norm")).alias("_edge_norm"))
    run_w = Window.partitionBy("_b", "_run")
    in_run = run_w.orderBy(F.col("_len").desc(), last_id)
    d = d.withColumn("_local_keep", F.first("_id").over(in_run)).withColumn("_local_size", F.count(F.lit(1)).over(run_w))
    d = cut(d)  # narrow: no text but for the few edge runs

    # pieces of one group that lie in several buckets: joined by whole text.
    # At most a few edge runs per bucket, so this table is bounded by MAX_BUCKETS.
    heads = d.where(F.col("_edge_norm").isNotNull())
    merged = heads.groupBy("_edge_norm").agg(
        F.min(F.struct((-F.col("_len")).alias("l"), last_id.alias("i"), F.col("_b").alias("b"), F.col("_run").alias("r"),
                       F.col("_local_keep").alias("k"))).alias("_win"),
        F.sum("_local_size").alias("_size"), F.count(F.lit(1)).alias("_pieces")).where("_pieces > 1")
    spread = (heads.select("_edge_norm", "_b", "_run").join(merged, "_edge_norm")
              .select("_b", "_run", F.col("_win.k").alias("_keep"), F.col("_win.b").alias("_wb"),
                      F.col("_win.r").alias("_wr"), "_size"))
    out = d.join(spread, ["_b", "_run"], "left")
    wins = F.col("_wb").isNull() | ((F.col("_wb") == F.col("_b")) & (F.col("_wr") == F.col("_run")))
    return out.select(
        F.col("_id").alias(id_col),
        F.when(F.col("_wb").isNull(), F.col("_local_keep")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_size", "_local_size").cast("long").alias("group_size"),
        ((F.col("_new") == 1) & wins).alias("kept"),
        F.col("_sha").alias("text_sha256"))


def keep_unique(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    rows, key = with_row_key(docs, id_col)
    return keep_rows(rows, key, exact_dedup(rows, key, text_col).where("kept").select(key), docs.columns)
