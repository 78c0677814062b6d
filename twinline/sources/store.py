"""Persisted datasets, vocabularies and metric logs.

Datasets are parquet partitioned by ``split`` so reading one split prunes
partitions; schemas are declared on read instead of inferred.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

IDS = T.ArrayType(T.IntegerType(), containsNull=False)

RAW_SCHEMA = T.StructType([
    T.StructField("corpus", T.StringType()),
    T.StructField("line_no", T.LongType()),
    T.StructField("english", T.StringType()),
    T.StructField("french", T.StringType()),
    T.StructField("split", T.StringType()),
])

TOKEN_SCHEMA = T.StructType([
    T.StructField("corpus", T.StringType()),
    T.StructField("line_no", T.LongType()),
    T.StructField("src_ids", IDS),
    T.StructField("tgt_ids", IDS),
    T.StructField("split", T.StringType()),
])

VOCAB_SCHEMA = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("id", T.IntegerType()),
])

MERGES_SCHEMA = T.StructType([
    T.StructField("rank", T.IntegerType()),
    T.StructField("left_id", T.IntegerType()),
    T.StructField("right_id", T.IntegerType()),
    T.StructField("new_id", T.IntegerType()),
    T.StructField("count", T.LongType()),
])


def write_dataset(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S4.  Rows are rebalanced by split before they are written: adaptive
    execution cuts a large split into files near the session's advisory size
    and joins the pieces of a small one, so neither leaves a file a task."""
    df.hint("rebalance", "split").write.mode(mode).partitionBy("split").parquet(path)


def read_dataset(spark: SparkSession, path: str, schema: T.StructType = TOKEN_SCHEMA) -> DataFrame:
    """S5 (``split`` comes back from the directory names)."""
    return spark.read.schema(schema).parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """S4 as a table whose files are dealt by ``keys``: a join on them (C4 with
    its batch layout) reads the token arrays where they lie.  ``table`` is a
    name in the session's catalog, ``path`` a folder all executors see; a row's
    bucket is the hash that Spark's exchange uses, so one exchange on writing
    saves one for every epoch that is collated."""
    dealt = df.repartition(buckets, *keys).sortWithinPartitions(*keys)  # one file a bucket
    (dealt.write.mode("overwrite").bucketBy(buckets, keys[0], *keys[1:]).sortBy(*keys).option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def write_vocab(vocab: DataFrame, path: str, merges: DataFrame | None = None) -> None:
    """``path/vocab`` (token, id) and optionally ``path/merges``."""
    vocab.select("token", "id").write.mode("overwrite").parquet(path.rstrip("/") + "/vocab")
    if merges is not None:
        merges.write.mode("overwrite").parquet(path.rstrip("/") + "/merges")


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VOCAB_SCHEMA).parquet(path.rstrip("/") + "/vocab")


def read_merges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MERGES_SCHEMA).parquet(path.rstrip("/") + "/merges")


METRICS_SCHEMA = T.StructType([
    T.StructField("epoch", T.IntegerType()),
    T.StructField("step", T.LongType()),
    T.StructField("train_loss", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("test_loss", T.DoubleType()),
    T.StructField("test_acc", T.DoubleType()),
])
_LOG_FOLDERS = T.StructType([T.StructField("run", T.StringType()), T.StructField("kind", T.StringType()),
                             T.StructField("steps_from", T.LongType())])
STEPS_PER_FOLDER = 1000


def read_metrics(spark: SparkSession, path: str, schema: T.StructType = METRICS_SCHEMA) -> DataFrame:
    """The metric log (S7): ``schema`` and run, kind; columns that a kind of
    row does not have are null.  A filter on run or kind reads only its folders."""
    return _log(spark, path, schema).drop("steps_from")


def _log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType(schema.fields + _LOG_FOLDERS.fields)).parquet(path)


def append_metrics(metrics: DataFrame, path: str, run: str = "run", kind: str = "train", schema: T.StructType = METRICS_SCHEMA,
                   steps_per_folder: int = STEPS_PER_FOLDER) -> None:
    """Commit metric rows to a log table; a row's key is (run, kind, step).

    The log lies in folders of (run, kind, range of steps).  A commit merges the
    new rows with the other steps of the folders it touches and overwrites just
    these: writing the same rows again, as after a retry or a resumed job,
    leaves the log as it was, a step that is logged anew replaces itself alone,
    and files stay few.  ``kind`` tells training rows from evaluation rows,
    which have other columns.  One writer a run at a time."""
    spark = metrics.sparkSession
    ensure_checkpoint_dir(spark)
    extra = set(metrics.columns) - set(schema.names)
    if extra:
        raise ValueError(f"columns without a place in the log: {sorted(extra)}")
    new = metrics.select(*[(F.col(f.name) if f.name in metrics.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    first = (F.floor(F.col("step") / steps_per_folder) * steps_per_folder).cast("long")
    new = new.select("*", F.lit(run).alias("run"), F.lit(kind).alias("kind"), first.alias("steps_from")).checkpoint(eager=True)
    rows = new
    try:
        old = _log(spark, path, schema).where((F.col("run") == run) & (F.col("kind") == kind))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        same = old.join(new.select("steps_from").distinct(), "steps_from", "left_semi").join(new.select("step"), "step", "left_anti")
        rows = new.unionByName(same).checkpoint(eager=True)  # read before its folders are replaced
    by = _LOG_FOLDERS.names
    rows.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    spark.catalog.refreshByPath(path)


def read_vocab_lines(spark: SparkSession, path: str) -> DataFrame:
    """A one-token-per-line vocabulary file (the usual ``vocab.txt`` of
    pretrained WordPiece models): id = 0-based line number (W1 on files)."""
    from .files import read_lines
    return read_lines(spark, path).select(F.col("text").alias("token"), F.col("line_no").cast("int").alias("id"))
