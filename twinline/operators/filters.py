"""Length filters on token tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import MAX_LENGTH, MIN_TARGET_LENGTH


def min_target_length(df: DataFrame, min_length: int = MIN_TARGET_LENGTH, tgt_col: str = "tgt_ids") -> DataFrame:
    """keep rows whose target has strictly more than ``min_length`` ids
    (specials included).  The source side is never filtered."""
    return df.where(F.size(tgt_col) > min_length)


def over_length_report(df: DataFrame, max_length: int = MAX_LENGTH, by: tuple[str, ...] = ("split",),
                       cols: tuple[str, ...] = ("src_ids", "tgt_ids")) -> DataFrame:
    """per group, how many rows exceed the position table on each side."""
    aggs = [F.sum((F.size(c) > max_length).cast("long")).alias(f"{c}_over") for c in cols]
    aggs.append(F.count(F.lit(1)).alias("num_rows"))
    return df.groupBy(*by).agg(*aggs)
