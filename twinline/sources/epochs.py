"""An epoch in stored order (T1 as files): a shuffled dataset that is read batch
by batch, by seek.

``write_epoch`` is an external shuffle: rows are exchanged by range of their
epoch key (``md5`` of seed, epoch and row key; sampled splitters), sorted inside
each range and written, one sorted file a range, with the key in a column.  The
manifest beside them has a row per file (its rows, and how many rows lie before
it) and a row per batch (the file and the row in it where the batch starts, and
the key found there).  A row's rank is its file's first rank plus its place in
the file, which Spark reports for parquet (``_metadata.row_index``): no window
and no second sort.

``read_batches`` opens only the files of the wanted batches and filters them by
the key range that the manifest names; the files are sorted by it, so the
reader skips the row groups and pages outside.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import MICRO_BATCH
from ..operators.split import epoch_order_key

ORDER = "epoch_key"
BROADCAST_FILES = 100_000  # rows of the per-file table up to which it is broadcast


def _placed(spark: SparkSession, path: str, files: DataFrame, n_files: int, columns: list[str]) -> DataFrame:
    rows = spark.read.parquet(f"{path}/rows").select(*columns, F.col("_metadata.file_name").alias("file"),
                                                     F.col("_metadata.row_index").alias("offset"))
    first = files.select("file", "first_rank")
    joined = rows.join(F.broadcast(first) if n_files <= BROADCAST_FILES else first, "file")
    return joined.withColumn("rank", (F.col("first_rank") + F.col("offset")).cast("long")).drop("first_rank")


def write_epoch(df: DataFrame, path: str, key_cols: list[str], seed: int | str, epoch: int, batch_size: int = MICRO_BATCH,
                files: int | None = None) -> None:
    """Store ``df`` in the order of epoch ``epoch``.  ``files`` is the number
    of ranges (the session's shuffle partitions, merged adaptively, if not
    given).  Rows must differ in ``key_cols``."""
    spark = df.sparkSession
    order = [ORDER, *key_cols]
    keyed = df.withColumn(ORDER, epoch_order_key(seed, key_cols, epoch))
    ranged = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode("overwrite").option("maxRecordsPerFile", 0).parquet(f"{path}/rows")
    # the files in key order: a file's range is known by its smallest key
    rows = spark.read.parquet(f"{path}/rows").select(F.col("_metadata.file_name").alias("file"), F.struct(*order).alias("_k"))
    per_file = rows.groupBy("file").agg(F.min("_k").alias("_k"), F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    per_file = per_file.select("file", "rows", F.coalesce(F.sum("rows").over(before), F.lit(0)).cast("long").alias("first_rank"))
    per_file = per_file.select(F.lit(epoch).alias("epoch"), F.lit(batch_size).alias("batch_size"), "*")
    per_file.coalesce(1).write.mode("overwrite").parquet(f"{path}/files")
    stored = spark.read.parquet(f"{path}/files")
    starts = _placed(spark, path, stored, stored.count(), [ORDER]).where(F.col("rank") % batch_size == 0)
    starts = starts.select((F.col("rank") / batch_size).cast("long").alias("batch_id"), "file", "offset", F.col(ORDER).alias("first_key"))
    starts.write.mode("overwrite").parquet(f"{path}/batches")


def read_epoch(spark: SparkSession, path: str) -> DataFrame:
    """All rows with ``batch_id``, ``pos``, ``rank`` (from 0), ``file`` and ``offset``."""
    files = spark.read.parquet(f"{path}/files")
    head = files.agg(F.max("batch_size").alias("b"), F.count(F.lit(1)).alias("n")).first()
    columns = spark.read.parquet(f"{path}/rows").columns
    if not head["n"]:
        empty = spark.read.parquet(f"{path}/rows")
        return empty.select("*", *[F.lit(None).cast(t).alias(c) for c, t in
                                   (("file", "string"), ("offset", "long"), ("rank", "long"), ("batch_id", "long"), ("pos", "int"))]).drop(ORDER)
    return _with_batch(_placed(spark, path, files, head["n"], columns), head["b"]).drop(ORDER)


def _with_batch(rows: DataFrame, batch_size: int) -> DataFrame:
    return rows.withColumn("batch_id", F.floor(F.col("rank") / batch_size).cast("long")).withColumn(
        "pos", (F.col("rank") % batch_size).cast("int"))


def read_batches(spark: SparkSession, path: str, batch_ids: list[int]) -> DataFrame:
    """The rows of some batches: only their files are opened, and only the key
    range that holds them is read."""
    wanted = sorted(set(batch_ids))
    files = spark.read.parquet(f"{path}/files")
    size = files.agg(F.max("batch_size")).first()[0]
    near = [*wanted, *(b + 1 for b in wanted)]  # a batch ends where the next one starts
    starts = {r["batch_id"]: r for r in spark.read.parquet(f"{path}/batches").where(F.col("batch_id").isin(near)).collect()}
    known = [b for b in wanted if b in starts]
    if not known:
        return read_epoch(spark, path).where("false")
    # a batch's ranks lie in the files that overlap them
    spans = [(b * size, (b + 1) * size) for b in known]
    touched = reduce(or_, [(F.col("first_rank") < hi) & (F.col("first_rank") + F.col("rows") > lo) for lo, hi in spans])
    mine = files.where(touched).select("file", "first_rank").collect()  # at most a few files a batch
    first = spark.createDataFrame([tuple(r) for r in mine], "file string, first_rank long")
    rows = spark.read.parquet(*[f"{path}/rows/{r['file']}" for r in mine])
    keys = [(F.col(ORDER) >= starts[b]["first_key"]) & ((F.col(ORDER) <= starts[b + 1]["first_key"]) if b + 1 in starts else F.lit(True))
            for b in known]
    rows = rows.where(reduce(or_, keys)).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("offset"))
    rows = rows.join(F.broadcast(first), "file").withColumn("rank", (F.col("first_rank") + F.col("offset")).cast("long")).drop("first_rank")
    return _with_batch(rows, size).where(F.col("batch_id").isin(known)).drop(ORDER)
