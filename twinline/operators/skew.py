"""Joins that survive hot keys."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

HOT_KEYS = 1024  # at most so many keys hold more than one row in HOT_KEYS each: the bound of what join_hot broadcasts


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` where null equals null; the keys of ``left`` stay."""
    names = {c: f"_right_{i}" for i, c in enumerate(on)}
    other = right.select(*[F.col(c).alias(names.get(c, c)) for c in right.columns])
    same = reduce(and_, [left[c].eqNullSafe(other[n]) for c, n in names.items()])
    return left.join(other, same, how).drop(*names.values())


def hot_keys(per_key: DataFrame, n_col: str, n_rows: int, least: int) -> DataFrame:
    """Of a table of rows per key, the keys with more than ``least`` rows and
    more than one in ``HOT_KEYS`` of all rows: at most ``HOT_KEYS`` of them,
    whatever the data."""
    return per_key.where(F.col(n_col) > max(least, n_rows // HOT_KEYS))


def join_hot(rows: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner", least: int = 1024,
             hot: DataFrame | None = None) -> DataFrame:
    """``rows`` joined with ``lookup`` (unique in ``on``; null equals null),
    however many rows share a key: the lookup rows of hot keys (``hot_keys``;
    at most ``HOT_KEYS``) are broadcast, the others meet by a shuffle.  ``rows``
    is read several times: pass a stored table or a cheap plan."""
    ensure_checkpoint_dir(rows.sparkSession)
    if hot is None:
        per_key = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_hot_n"))
        hot = hot_keys(per_key, "_hot_n", rows.count(), least)
    hot = hot.select(*on).checkpoint(eager=True)
    if not hot.limit(1).count():
        return null_safe_join(rows, lookup, on, how)
    few = null_safe_join(lookup, F.broadcast(hot), on, "left_semi").checkpoint(eager=True)
    cold = null_safe_join(null_safe_join(rows, F.broadcast(hot), on, "left_anti"), lookup, on, how)
    warm = null_safe_join(null_safe_join(rows, F.broadcast(hot), on, "left_semi"), F.broadcast(few), on, how)
    return cold.unionByName(warm)
