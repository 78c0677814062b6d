"""Small helpers shared by the pipeline operators."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinline.session import ensure_checkpoint_dir

# Functions that run in tasks travel by value: executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: ASCII white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CHARS = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """The column of exactly this name."""
    return F.col("`" + name.replace("`", "``") + "`")


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, seen by all executors."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def with_row_key(docs: DataFrame, id_col: str) -> tuple[DataFrame, str]:
    """The table and a column that names its rows in id order: the id itself
    where ids are unique and not null, else a new column (ids in order, null
    ids last; materialised, so that it stays the same)."""
    odd = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > 1) | F.col(id_col).isNull()).limit(1).count()
    if not odd:
        return docs, id_col
    key = "_row"
    while key in docs.columns:
        key += "_"
    # the hash spreads the rows of one id (or of no id) over the sort's partitions
    hashed = [quoted(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    rows = docs.orderBy(F.col(id_col).asc_nulls_last(), F.xxhash64(*hashed))
    return cut(rows.withColumn(key, F.monotonically_increasing_id())), key


def keep_rows(docs: DataFrame, key: str, kept: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``docs`` whose key is in ``kept`` (one column, unique)."""
    names = kept.withColumnRenamed(kept.columns[0], "_kept_key")
    return docs.join(names, quoted(key) == names["_kept_key"], "left_semi").select(*[quoted(c) for c in columns])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).cast("string")


def strip_spaces(c: Column) -> Column:
    """Delete every ASCII white-space character."""
    for ch in SPACE_CHARS:
        c = F.replace(c, F.lit(ch), F.lit(""))
    return c


def sha256_hex(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def ordered_hex(c: Column) -> Column:
    """A long as 16 hex digits whose string order is the numeric order (null last)."""
    flipped = F.coalesce(c, F.lit((1 << 63) - 1)).bitwiseXOR(F.lit(-(1 << 63)))
    return F.lpad(F.hex(flipped), 16, "0")


def splitter_bucket(key: Column, splitters: list[str]) -> Column:
    """Number of splitters <= key, by binary search over a constant array.
    ``splitters`` are sorted, and none contains a line feed."""
    if not splitters:
        return F.lit(0)
    steps = len(splitters).bit_length()
    table = F.split(F.lit("\n".join(splitters)), "\n")
    n = F.lit(len(splitters))

    def step(acc: Column, jump: Column) -> Column:
        nxt = acc + jump
        return F.when((nxt <= n) & (F.get(table, F.least(nxt, n) - 1) <= key), nxt).otherwise(acc)

    jumps = F.array(*[F.lit(1 << i) for i in reversed(range(steps))])
    return F.aggregate(jumps, F.lit(0), step)


def chunks(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of a piece hold about ``max_bytes``
    (always at least one row)."""

    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(column)
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


TREE_FAN_OUT = 16


def spanning_trees(near: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect ``ids`` as the symmetric boolean matrix ``near``
    does: for each connected group a tree of small degree over its sorted ids."""
    out, unseen = [], near.any(axis=1)
    while unseen.any():
        front = group = np.array([np.argmax(unseen)])
        unseen[front] = False
        while len(front):
            front = np.nonzero(near[front].any(axis=0) & unseen)[0]
            unseen[front] = False
            group = np.concatenate([group, front])
        tree = np.sort(ids[group]).tolist()
        out += [(tree[(k - 1) // TREE_FAN_OUT], tree[k]) for k in range(1, len(tree))]
    return out


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of equal ``keys`` (long columns) of a task sorted by them, one table a group."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if b.num_rows == 0:
            continue
        k = np.stack([np.asarray(b.column(c)).astype(np.int64) for c in keys], axis=1)
        new = (np.nonzero((k[1:] != k[:-1]).any(axis=1))[0] + 1).tolist()
        edges = [0, *new, b.num_rows]
        for i, j in zip(edges[:-1], edges[1:]):
            now = tuple(k[i].tolist())
            if now != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(i, j - i))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def vector_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equally long lists without nulls as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)
