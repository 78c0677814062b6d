"""Word counts of a growing corpus (A2), kept as mergeable partial counts.

Every call of ``add_files`` lists the corpus, leaves out the files that the
manifest already names, counts the words of the new ones and commits them as one
increment: its counts first, then its manifest rows.  Counts without manifest
rows (a job that died in between) are not read, and the next call counts those
files again under its own number.  ``stored_counts`` sums the increments; a
sum over distinct words, never over text.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import counts

MANIFEST = "file string, bytes long, modified timestamp, increment string"


class ChangedFileError(ValueError):
    """A file that was counted is not the same any more."""


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def manifest(spark: SparkSession, store: str) -> DataFrame:
    """(file, bytes, modified, increment) of every file that is counted."""
    return _stored(spark, f"{store}/manifest", MANIFEST)


def new_files(spark: SparkSession, corpus: str, store: str) -> DataFrame:
    """Files of the glob ``corpus`` that no increment holds.  Only metadata is
    read.  A counted file whose length or time changed is an error: its old
    words cannot be taken back."""
    found = spark.read.format("binaryFile").load(corpus).select(
        F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    known = manifest(spark, store).select("file", F.col("bytes").alias("_b"), F.col("modified").alias("_m"), F.lit(True).alias("_known"))
    both = found.join(known, "file", "left")
    changed = [r["file"] for r in both.where((F.col("bytes") != F.col("_b")) | (F.col("modified") != F.col("_m"))).limit(5).collect()]
    if changed:
        raise ChangedFileError(f"counted files have changed, the first: {', '.join(changed)}")
    return both.where(F.col("_known").isNull()).select("file", "bytes", "modified")


def add_files(spark: SparkSession, corpus: str, store: str, text_col: str = "text", by: list[str] | None = None,
              format: str = "parquet") -> int:
    """Count the files of the glob ``corpus`` that are new; how many these are.
    ``format`` is ``parquet`` (with ``text_col`` and the columns ``by``) or
    ``text`` (a line a row).  The new files' paths are held by the driver, as
    Spark itself does with the files of a scan."""
    by = by or []
    fresh = new_files(spark, corpus, store).collect()
    if not fresh:
        return 0
    paths = [r["file"] for r in fresh]
    rows = spark.read.text(paths).withColumnRenamed("value", text_col) if format == "text" else spark.read.parquet(*paths)
    name = uuid.uuid4().hex
    found = counts.word_counts(rows, text_col, by).withColumn("increment", F.lit(name))
    found.write.mode("append").partitionBy("increment").parquet(f"{store}/counts")
    rows_ = [(r["file"], r["bytes"], r["modified"], name) for r in fresh]
    spark.createDataFrame(rows_, MANIFEST).coalesce(1).write.mode("append").parquet(f"{store}/manifest")  # the commit
    return len(paths)


def stored_counts(spark: SparkSession, store: str, by: list[str] | None = None) -> DataFrame:
    """(*by, word, count) over all committed increments."""
    by = by or []
    schema = ", ".join([*(f"{c} string" for c in by), "word string", "count long", "increment string"])
    done = manifest(spark, store).select("increment").distinct()
    parts = _stored(spark, f"{store}/counts", schema).join(done, "increment", "left_semi")
    return parts.groupBy(*by, "word").agg(F.sum("count").alias("count"))
