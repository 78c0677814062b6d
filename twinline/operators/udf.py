"""User functions over column batches.

The reference hands whole column batches to user code (a batched map, a
batched predicate, a collate function per batch).  Here the same shapes run
on Arrow record batches inside Spark tasks; parallelism is the number of
partitions, not a process count.  Prefer native Column expressions; use
these only for logic that has none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch],
                schema: T.StructType | str) -> DataFrame:
    """``fn`` maps each Arrow record batch to a batch of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield fn(b)

    return df.mapInArrow(run, schema)


def batch_predicate(fn: Callable[..., pa.Array]) -> Callable[..., Column]:
    """Wrap ``fn(*arrow_arrays) -> boolean array`` as a Column predicate,
    for ``df.where(pred("col"))``."""
    return F.arrow_udf(fn, T.BooleanType())


def filter_batches(df: DataFrame, fn: Callable[..., pa.Array], *cols: str) -> DataFrame:
    """D2 in one call: keep rows where ``fn`` over the given columns is true."""
    return df.where(batch_predicate(fn)(*[F.col(c) for c in cols]))


def apply_per_batch(df: DataFrame, key: str, fn: Callable[[pa.Table], pa.Table],
                    schema: T.StructType | str) -> DataFrame:
    """D3: ``fn`` receives all rows of one group (e.g. one ``batch_id``) as an
    Arrow table.  Groups must be bounded (a batch holds B rows); the default
    collation (C4) uses native columns instead."""
    return df.groupBy(key).applyInArrow(fn, schema)
