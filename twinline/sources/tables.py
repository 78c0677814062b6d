"""Readers for the input tables, with only the columns each job needs.

Selecting columns right at the read lets the parquet scan prune them
(``ReadSchema`` in the plan), and filters written after it are pushed into
the scan by Catalyst.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*cols) if cols else df


def spread(df: DataFrame) -> DataFrame:
    """Local mode only: a file with one row group is read by one task, so its
    rows are dealt over the cores.  On a cluster the scan is left as it is;
    ``spark.sql.files.maxPartitionBytes`` sizes its splits there."""
    sc = df.sparkSession.sparkContext
    return df.repartition(sc.defaultParallelism) if sc.master.startswith("local[") else df


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents", *(cols or ("doc_id", "text", "lang", "source"))))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
