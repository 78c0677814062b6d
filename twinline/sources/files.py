"""Line files on disk (S1, S2, S3 and W1 for files).

``discover_pairs`` lists ``root/<corpus>/<file>`` with the binaryFile
source, selecting only metadata so file contents are never read.
``read_lines`` reads text files with Spark's line reader and numbers lines
per file: inside one file split, rows arrive in file order in one task, so a
line's index in its split is its ``monotonically_increasing_id`` minus the
split's smallest one; the split's start offset inside the file comes from a
per-split table (one row per file split) prefix-summed per file.  That table
is broadcast up to ``BROADCAST_SPLITS`` rows, so the lines stay where they
were read; beyond it the join shuffles the lines once.

A file is known everywhere by ``_metadata.file_path`` (URL-encoded), on both
the listing and the line side; ``corpus`` is the decoded directory name.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


BROADCAST_SPLITS = 200_000  # rows of the per-split table up to which it is broadcast


class DiscoveryError(ValueError):
    pass


def escape_glob(path: str) -> str:
    """A path as a glob that matches only itself."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path.rstrip("/"))


def _decoded(segment: Column) -> Column:
    return F.url_decode(F.replace(segment, F.lit("+"), F.lit("%2B")))


def _corpus(file_path: Column) -> Column:
    return _decoded(F.regexp_extract(file_path, r"([^/]+)/[^/]+$", 1))


def discover_pairs(spark: SparkSession, root: str, src_suffix: str = ".en", tgt_suffix: str = ".fr") -> DataFrame:
    """S1 + F1 + F2: corpus directories directly under ``root`` holding
    exactly one file per language suffix.  Directories missing a side are
    skipped; more than one match for a suffix is an error.
    Result: corpus, src_path, tgt_path, src_bytes, tgt_bytes (sorted by corpus)."""
    listing = spark.read.format("binaryFile").load(escape_glob(root) + "/*/*")
    d = listing.select(F.col("_metadata.file_path").alias("path"), "length").withColumn("corpus", _corpus(F.col("path")))
    name = _decoded(F.regexp_extract("path", r"([^/]+)$", 1))
    is_src, is_tgt = name.endswith(src_suffix), name.endswith(tgt_suffix)
    g = d.groupBy("corpus").agg(
        F.sum(is_src.cast("int")).alias("n_src"), F.sum(is_tgt.cast("int")).alias("n_tgt"),
        F.max(F.when(is_src, F.col("path"))).alias("src_path"),
        F.max(F.when(is_tgt, F.col("path"))).alias("tgt_path"),
        F.max(F.when(is_src, F.col("length"))).alias("src_bytes"), F.max(F.when(is_tgt, F.col("length"))).alias("tgt_bytes"))
    several = g.where((F.col("n_src") > 1) | (F.col("n_tgt") > 1))
    bad = several.select("corpus").orderBy("corpus").limit(20).collect()
    if bad:
        raise DiscoveryError(f"several files for one language in {several.count()} directories, the first: "
                             + ", ".join(r["corpus"] for r in bad))
    return (g.where(F.col("src_path").isNotNull() & F.col("tgt_path").isNotNull())
            .select("corpus", "src_path", "tgt_path", "src_bytes", "tgt_bytes").orderBy("corpus"))


def glob_lang_files(root: str, suffix: str = ".fr") -> str:
    """The glob of all files with ``suffix`` exactly one directory down
    (files at the root or deeper are not matched)."""
    return escape_glob(root) + "/*/*" + escape_glob(suffix)


def _split_bound(spark: SparkSession, paths: str | list[str], name_filter: str | None) -> int:
    """At most how many splits the reader makes, from file lengths alone."""
    reader = spark.read.format("binaryFile")
    listing = (reader.option("pathGlobFilter", name_filter) if name_filter else reader).load(paths)
    sizes = [spark.sql(f"SET {k}").first()["value"] for k in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")]
    least = min(int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(v)) for v in sizes)
    return listing.agg(F.sum(F.ceil(F.col("length") / least) + 1)).first()[0] or 0


def read_lines(spark: SparkSession, paths: str | list[str], name_filter: str | None = None) -> DataFrame:
    """S3 + W1: one row per line with its file and 0-based line number.
    ``paths`` are globs (see ``escape_glob``); ``name_filter`` a glob on file
    names.  Result: file_path, line_no, text.  Lines split on \\n, \\r\\n or
    \\r; empty lines are kept.  A compressed file is one split and is read by
    one task."""
    reader = spark.read.option("pathGlobFilter", name_filter) if name_filter else spark.read
    raw = reader.text(paths).select(
        F.col("value").alias("text"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    # one row per file split
    splits = raw.groupBy("file_path", "block_start").agg(
        F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file_path", "block_start", "_first",
                           F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    splits = F.broadcast(splits) if _split_bound(spark, paths, name_filter) <= BROADCAST_SPLITS else splits
    return (raw.join(splits, ["file_path", "block_start"])
            .select("file_path", (F.col("_off") + F.col("_mid") - F.col("_first")).cast("long").alias("line_no"),
                    "text"))


def read_corpus_lines(spark: SparkSession, root: str, pairs: DataFrame, side: str, suffix: str) -> DataFrame:
    """Lines of one side of every discovered corpus: corpus, line_no, text.
    All files of the suffix are read at once; the join with the discovered
    pairs uses the same encoded path on both sides."""
    if not pairs.limit(1).count():
        raise DiscoveryError("no complete corpus directory found")
    known = pairs.select("corpus", F.col(f"{side}_path").alias("file_path"))
    lines = read_lines(spark, escape_glob(root) + "/*/*", "*" + escape_glob(suffix))
    return lines.join(known, "file_path").select("corpus", "line_no", "text")


def check_all_read(pairs: DataFrame, lines: DataFrame, side: str) -> None:
    """Raise if a discovered corpus whose file is not empty reached no line."""
    seen = lines.select("corpus").distinct()
    lost = pairs.where(F.col(f"{side}_bytes") > 0).join(seen, "corpus", "left_anti")
    names = [r["corpus"] for r in lost.select("corpus").orderBy("corpus").limit(20).collect()]
    if names:
        raise DiscoveryError(f"no line read from {lost.count()} corpora, the first: {', '.join(names)}")
