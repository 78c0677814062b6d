"""Near-dedup of embeddings by sorted projection passes.

Method.  A pass draws ``BITS`` random hyperplanes; the signs of a vector's
projections, one after the other, are its sort key.  Vectors are ordered by
(length, label, key), and every vector is compared with its neighbours in that
order: with all vectors of its own chunk of ``window`` rows and of the chunk
before, across the borders of partitions too.  Pairs whose cosine reaches the
threshold are links.  Passes repeat with other hyperplanes and their links are
united: what one order tears apart another one keeps together.  The number of
passes follows the size of the largest label: for a pair just at the threshold
the chance to be missed by all of them is at most ``1 - recall`` where the keys
spread the vectors evenly (nearer pairs are safer).

Linked vectors lie in one component whatever the windows missed, so the links
are then counted exactly among all vectors of a component; one of more than
``block`` vectors is cut into blocks, and each pair of blocks is a task's group.
Windows report trees, not pairs, and counts are summed, so no output grows with
the square of a group.  Its comparisons do, for vectors that differ; equal
vectors are one node with a count.

Equal vectors are found by grouping; a vector that many rows share is joined
back by a broadcast of at most ``HOT_KEYS`` rows.

Defined results: rows with a null label, or a vector that is null, empty, zero or holds
a null or non-finite component, have no links and are components of their own;
vectors of different length have no link; a component's id is the smallest id
of its rows (null if they have none); ``kept`` is ``id <=> component_id``, so
rows repeated with the smallest id all stay, as do rows without an id that link
with nothing but such rows; an empty table gives an empty result; extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinline.llm.common import cut, groups_of, spanning_trees, vector_matrix
from twinline.llm.simhash import components
from twinline.operators.skew import join_hot

cloudpickle.register_pickle_by_value(sys.modules[__name__])

THRESHOLD = 0.98
WINDOW = 512     # rows of a chunk; a row meets its own chunk and the one before
RECALL = 0.999   # of pairs just at the threshold
LEAST_PASSES = 6
BITS = 64
BLOCK = 2048     # vectors of a block of a large component
SEED = 11


def usable(vec: Column) -> Column:
    """Neither null, empty nor zero, and all components finite."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce((F.size(vec) > 0) & ~F.exists(vec, odd) & F.exists(vec, lambda x: x != 0), F.lit(False))


def passes_for(rows_of_label: int, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes so that a pair at the threshold is missed by all of them with a
    chance of at most ``1 - recall``: it stays within a window while its first
    log2(rows / window) signs agree."""
    flip = math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    signs = max(0.0, math.log2(max(rows_of_label, 1) / window))
    miss = 1 - (1 - flip) ** signs
    return max(LEAST_PASSES, math.ceil(math.log(1 - recall) / math.log(miss))) if miss > 1e-9 else LEAST_PASSES


def unit_rows(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def with_keys(classes: DataFrame, passes: int, seed: int) -> DataFrame:
    """``classes`` with ``_keys``: the sort key of each pass, as a long whose
    order is the lexicographic order of the signs."""
    names = [f.name for f in classes.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, list[np.ndarray]] = {}
        for b in batches:
            vec = b.column("_vec")
            dims = np.asarray(b.column("_dim"))
            keys = np.empty((b.num_rows, passes), np.int64)
            for d in np.unique(dims).tolist():
                if d not in planes:
                    planes[d] = [np.random.default_rng([seed, p, d]).standard_normal((d, BITS)) for p in range(passes)]
                at = np.nonzero(dims == d)[0]
                m = unit_rows(vector_matrix(vec.take(pa.array(at))))
                for p in range(passes):
                    bits = np.packbits(m @ planes[d][p] >= 0, axis=1)
                    keys[at, p] = (bits.view(">u8").reshape(-1) ^ np.uint64(1 << 63)).astype(np.int64)
            ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * passes)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(ends, pa.array(keys.reshape(-1)))],
                                             names=[*names, "_keys"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema.fields)
    return classes.mapInArrow(run, f"{fields}, _keys array<long>")


def _window_links(ids: np.ndarray, unit: np.ndarray, before: int, threshold: float) -> list[tuple[int, int]]:
    """Trees over the links of a chunk (rows from ``before`` on) with itself
    and with the ``before`` rows of the chunk before it."""
    near = unit[before:] @ unit.T >= threshold
    near[np.arange(len(near)), np.arange(before, len(ids))] = False
    r, c = np.nonzero(near)
    if not len(r):
        return []
    own = np.union1d(r + before, c)  # only rows with a link
    small = np.zeros((len(own), len(own)), bool)
    i, j = np.searchsorted(own, r + before), np.searchsorted(own, c)
    small[i, j] = small[j, i] = True
    return spanning_trees(small, ids[own])


def window_pass(hashed: DataFrame, p: int, threshold: float, window: int) -> DataFrame:
    """(a, b) links that connect classes as the windows of pass ``p`` do."""
    label = hashed.schema["_label"].dataType.simpleString()
    vec = hashed.schema["_vec"].dataType.simpleString()
    order = ["_dim", "_label", "_key", "_c"]
    rows = hashed.select("_dim", "_label", F.col("_keys")[p].alias("_key"), "_c", "_vec")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = f"a long, b long, part int, first boolean, _dim int, _label {label}, _c long, _vec {vec}"

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
        """Pieces of at most ``window`` rows of one label, and whether a run starts."""
        last, filled = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            code = np.asarray(b.column("_label").dictionary_encode().indices)
            dims = np.asarray(b.column("_dim"))
            new = (np.nonzero((code[1:] != code[:-1]) | (dims[1:] != dims[:-1]))[0] + 1).tolist()
            for i, j in zip([0, *new], [*new, b.num_rows]):
                now = (b.column("_dim")[i].as_py(), b.column("_label")[i].as_py())
                start, last, at = now != last, now, i
                if start:
                    filled = 0
                while at < j:
                    n = min(j - at, window - filled)
                    yield start and at == i, b.slice(at, n)
                    at, filled = at + n, (filled + n) % window

    def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.Table]]:
        """Whole chunks: ``window`` rows of one label, fewer at its end."""
        held, rows_held, fresh = [], 0, True
        for start, piece in runs(batches):
            if held and (start or rows_held == window):
                yield fresh, pa.Table.from_batches(held)
                held, rows_held, fresh = [], 0, False
            fresh = start if not held else fresh
            held.append(piece)
            rows_held += piece.num_rows
        if held:
            yield fresh, pa.Table.from_batches(held)

    def border(t: pa.Table, part: int, first: bool) -> pa.RecordBatch:
        n = t.num_rows
        cols = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(np.full(n, part, np.int32)), pa.array([first] * n),
                *[t.column(c).combine_chunks() for c in ("_dim", "_label", "_c", "_vec")]]
        return pa.RecordBatch.from_arrays(cols, names=names)

    names = ["a", "b", "part", "first", "_dim", "_label", "_c", "_vec"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, last, opened = TaskContext.get().partitionId(), None, None, False
        for start, t in chunks_of(batches):
            ids, unit = np.asarray(t.column("_c")), unit_rows(vector_matrix(t.column("_vec")))
            if not opened:
                opened = True
                yield border(t, part, True)
            last = t
            held, at = (ids, unit), 0
            if before is not None and not start:
                at = len(before[0])
                ids, unit = np.concatenate([before[0], ids]), np.concatenate([before[1], unit])
            before = held
            found = _window_links(ids, unit, at, threshold) if len(ids) > 1 else []
            if found:
                e = np.array(found, np.int64)
                n = len(e)
                rest = [pa.nulls(n, t) for t in (pa.int32(), pa.bool_(), pa.int32(), last.schema.field("_label").type,
                                                 pa.int64(), last.schema.field("_vec").type)]
                yield pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1]), *rest], names=names)
        if last is not None:
            yield border(last, part, False)

    found = cut(rows.mapInArrow(run, schema))
    # the last chunk of a partition meets the first chunk of the next one
    borders = found.where(F.col("_c").isNotNull()).withColumn("_b", F.when(F.col("first"), F.col("part") - 1).otherwise(F.col("part")))

    def meet(t: pa.Table) -> pa.Table:
        left, right = t.filter(pc.invert(t["first"])), t.filter(t["first"])
        edges: list[tuple[int, int]] = []
        if left.num_rows and right.num_rows and left["_dim"][0] == right["_dim"][0] and left["_label"][0] == right["_label"][0]:
            both = pa.concat_tables([left, right])
            edges = _window_links(np.asarray(both["_c"]), unit_rows(vector_matrix(both["_vec"])), left.num_rows, threshold)
        e = np.array(edges, np.int64).reshape(-1, 2)
        return pa.table({"a": e[:, 0], "b": e[:, 1]})

    across = borders.groupBy("_b").applyInArrow(meet, "a long, b long")
    return cut(found.where(F.col("a").isNotNull()).select("a", "b").unionByName(across))


def count_links(members: DataFrame, threshold: float, block: int) -> DataFrame:
    """(_c, _links): rows linked with each class, compared exactly with all
    classes of its component.  members: ``_comp``, ``_c``, ``_vec``, ``_n``."""
    sizes = members.groupBy("_comp").agg(F.count(F.lit(1)).alias("_size"))
    rows = join_hot(members, sizes, ["_comp"])
    blocks = F.ceil(F.col("_size") / block).cast("int")
    rows = rows.withColumn("_nb", blocks).withColumn("_b", F.pmod(F.xxhash64("_c"), F.col("_nb")).cast("int"))
    rows = rows.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
    key = ["_comp", "_lo", "_hi"]
    rows = rows.select("_comp", F.least("_b", "_o").alias("_lo"), F.greatest("_b", "_o").alias("_hi"),
                       (F.col("_b") <= F.col("_o")).alias("_low"), "_c", "_n", "_vec")
    rows = rows.repartition(*key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups_of(batches, key):
            c, n = np.asarray(t["_c"]), np.asarray(t["_n"])
            unit, low = unit_rows(vector_matrix(t["_vec"])), np.asarray(t["_low"]).astype(bool)
            total = np.zeros(len(c), np.int64)
            one = t["_lo"][0] == t["_hi"][0]
            left, right = (np.arange(len(c)),) * 2 if one else (np.nonzero(low)[0], np.nonzero(~low)[0])
            for i in range(0, len(left), WINDOW):
                rows_ = left[i:i + WINDOW]
                near = unit[rows_] @ unit[right].T >= threshold
                if one:
                    near[np.arange(len(rows_)), rows_] = False
                total[rows_] += near @ n[right]
                if not one:
                    total[right] += near.T @ n[rows_]
            yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(total)], names=["_c", "_links"])

    return rows.mapInArrow(run, "_c long, _links long").groupBy("_c").agg(F.sum("_links").alias("_links"))


def near_dedup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
               threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL, passes: int | None = None,
               block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``."""
    kind = vectors.schema[vec_col].dataType.simpleString()
    vec = F.col(vec_col) if kind == "array<float>" else F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), vec.alias("_vec"))
    ok = F.col("_label").isNotNull() & usable(F.col("_vec"))
    if passes is None:
        top = rows.groupBy("_label").count().agg(F.max("count")).first()[0] or 0
        passes = passes_for(top, threshold, window, recall)
    classes = rows.where(ok).groupBy("_label", "_vec").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    classes = classes.select(F.monotonically_increasing_id().alias("_c"), F.size("_vec").alias("_dim"), "*")
    hashed = cut(with_keys(classes, passes, seed))

    links = [window_pass(hashed, p, threshold, window) for p in range(passes)]
    united = links[0]
    for more in links[1:]:
        united = united.unionByName(more)
    comp = components(united.distinct())
    linked = hashed.select("_c", "_vec", "_n", "_first").join(comp.select(F.col("_node").alias("_c"), "_comp"), "_c")
    linked = cut(linked)
    counted = count_links(linked.select("_comp", "_c", "_vec", "_n"), threshold, block)
    names = linked.groupBy("_comp").agg(F.min("_first").alias("_name"))
    found = join_hot(linked.select("_c", "_comp"), names, ["_comp"]).select("_c", "_name").join(counted, "_c")
    found = found.withColumn("_in", F.lit(True))
    # a class without links is a component of its own
    known = cut(hashed.drop("_keys").join(found, "_c", "left").select(
        "_label", "_vec", "_n", "_first", (F.coalesce("_links", F.lit(0)) + F.col("_n") - 1).cast("long").alias("n_links"),
        F.when(F.col("_in"), F.col("_name")).otherwise(F.col("_first")).alias("component_id")))
    single = known.where("_n = 1").select(F.col("_first").alias("_id"), "n_links", "component_id")  # its only row's id
    shared = known.where("_n > 1").select("_label", "_vec", "n_links", "component_id")
    copies = join_hot(rows.where(ok), shared, ["_label", "_vec"]).select("_id", "n_links", "component_id")
    rest = rows.where(~ok).select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    out = single.unionByName(copies).unionByName(rest)
    return out.select(F.col("_id").alias(id_col), "n_links", "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))
