"""SimHash near-dedup with a segment-popcount embedding.

Method.  A 64-bit fingerprint is cut into 32 segments of two bits; a segment's
coordinate is its bit count (0, 1 or 2).  One differing bit moves one
coordinate by one, so the Manhattan distance of two count vectors is a lower
bound of the Hamming distance.  The coordinates form six blocks.  Vectors
within distance 3 differ in at most three blocks, so they are equal in at
least three: the grid has one cell for each choice of three blocks and their
coordinates (20 cells a fingerprint), and two linked fingerprints always share
a cell.  Rows of a cell meet in one task, are filtered by Manhattan distance
and then verified by their differing bits.

A task reports links that connect its rows (a spanning forest with small
degrees), never all pairs.  A cell with many rows is cut into blocks of about ``BLOCK`` rows and
each pair of blocks is a task of its own, so no task grows with a group and
no pair is lost.  A fingerprint is one node, whatever its ids.  Components
come from repeated minimum-label steps with pointer jumping, each cut by a
checkpoint.

The counts are kept in unary (a bit for "at least one", a bit for "two"), so
Manhattan distance is the bit count of an exclusive or.

Defined results: a null text has no words; texts without words have
fingerprint zero and are linked like any other; fewer words than a shingle
give one shingle of all of them; a component's id is the smallest id of its
rows, null if they have none (so components of null ids alone have no name,
and two components whose smallest id is one repeated id have the same name);
repeated rows share a component; an empty table gives an empty result; extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinline.llm.common import cut, keep_rows, with_row_key
from twinline.operators.skew import hot_keys, join_hot

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BLOCK = 512                       # rows of a block of a large cell
SEGMENT_BLOCKS = (5, 5, 5, 5, 6, 6)  # segments of each coordinate block
FAN_OUT = 16
HOT = 256                         # rows of a key from which join_hot may take it as hot


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Whole text to its 64-bit fingerprint."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: only A-Z change, ASCII white space splits
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    n = max(1, len(words) - shingle + 1)
    starts = [0, *ends[:n - 1]]
    stops = ends[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b - 1], SEED) for a, b in zip(starts, stops)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):  # bounded memory on very long texts
        part = np.ascontiguousarray(h[i:i + (1 << 16)])
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(_id, _fp) of every document, the fingerprint as a signed long."""
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["_id", "_fp"])

    return src.mapInArrow(run, "_id long, _fp long")


EVEN = 0x5555555555555555


def unary_counts(fp: Column) -> Column:
    """Bit counts of the two-bit segments, in unary."""
    shifted = F.shiftrightunsigned(fp, 1)
    return fp.bitwiseOR(shifted).bitwiseAND(F.lit(EVEN)).bitwiseOR(
        F.shiftleft(fp.bitwiseAND(shifted).bitwiseAND(F.lit(EVEN)), 1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def cell_masks() -> list[int]:
    masks, at = [], 0
    for n in SEGMENT_BLOCKS:
        masks.append(((1 << 2 * n) - 1) << at)
        at += 2 * n
    return [_signed(a | b | c) for a, b, c in itertools.combinations(masks, 3)]


def _forest(fp: np.ndarray, unary: np.ndarray, ids: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect the rows of one task as all its verified pairs do.
    A group of rows connected by verified pairs becomes a tree of ``FAN_OUT``
    children a node over its sorted ids, so no id gets many links."""
    n = len(fp)
    if n == 2:
        ok = np.bitwise_count(unary[0] ^ unary[1]) <= max_bits and np.bitwise_count(fp[0] ^ fp[1]) <= max_bits
        return [(int(ids[0]), int(ids[1]))] if ok else []
    near = np.bitwise_count(unary[:, None] ^ unary[None, :]) <= max_bits          # lower bound
    r, c = np.nonzero(np.triu(near, 1))
    near[:] = False
    ok = np.bitwise_count(fp[r] ^ fp[c]) <= max_bits                              # exact
    near[r[ok], c[ok]] = near[c[ok], r[ok]] = True
    out, unseen = [], near.any(axis=1)
    while unseen.any():
        front = group = np.array([np.argmax(unseen)])
        unseen[front] = False
        while len(front):
            front = np.nonzero(near[front].any(axis=0) & unseen)[0]
            unseen[front] = False
            group = np.concatenate([group, front])
        tree = np.sort(ids[group]).tolist()
        out += [(tree[(k - 1) // FAN_OUT], tree[k]) for k in range(1, len(tree))]
    return out


def links(classes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b) links that connect the nodes of ``classes`` (_fp, _node) as their
    verified pairs do; nodes of a link need not be a pair themselves."""
    unary = unary_counts(F.col("_fp"))
    cells = classes.select("_fp", "_node", F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), unary.bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(cell_masks())])).alias("_x"))
    cells = cells.select("_fp", "_node", F.col("_x.c").alias("_c"), F.col("_x.k").alias("_k"))
    shared = cut(cells.groupBy("_c", "_k").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    total = shared.agg(F.sum("_n")).first()[0] or 0
    rows = join_hot(cells, shared, ["_c", "_k"], hot=hot_keys(shared, "_n", total, HOT))
    # a large cell: about `block` rows to a block, a task for each pair of blocks
    blocks = F.when(F.col("_n") <= 2 * block, 1).otherwise(F.ceil(F.col("_n") / block)).cast("int")
    rows = rows.withColumn("_nb", blocks).withColumn("_b", F.pmod(F.xxhash64("_fp"), F.col("_nb")).cast("int"))
    other = F.when(F.col("_nb") == 1, F.array(F.lit(0))).otherwise(
        F.array_except(F.sequence(F.lit(0), F.col("_nb") - 1), F.array("_b")))
    rows = rows.withColumn("_o", F.explode(other))
    key = ["_c", "_k", "_lo", "_hi"]
    rows = rows.select("_c", "_k", F.least("_b", "_o").alias("_lo"), F.greatest("_b", "_o").alias("_hi"), "_fp", "_node")
    rows = rows.repartition(*key).sortWithinPartitions(*key)
    even = np.uint64(EVEN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None  # rows of the task that the last batch ended in
        for b in itertools.chain(batches, [None]):
            if b is not None:
                if b.num_rows == 0:
                    continue
                t = np.stack([np.asarray(b.column(i)).astype(np.int64) for i in range(6)], axis=1)
                held = t if held is None else np.concatenate([held, t])
            if held is None:
                return
            new = np.nonzero((held[1:, :4] != held[:-1, :4]).any(axis=1))[0] + 1
            edges = np.concatenate([[0], new, [len(held)]])
            out = []
            for i, j in zip(edges[:-1], edges[1:] if b is None else edges[1:-1]):
                if j - i > 1:
                    fp = held[i:j, 4].astype(np.uint64)
                    half = fp >> np.uint64(1)
                    un = ((fp | half) & even) | ((fp & half & even) << np.uint64(1))
                    out += _forest(fp, un, held[i:j, 5], max_bits)
            held = None if b is None else held[edges[-2]:].copy()
            if out:
                a = np.array(out, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(a.min(axis=1)), pa.array(a.max(axis=1))], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(_node, _comp): the smallest node reachable, for every node of an edge."""
    edges = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("l")))
    while True:
        seen = edges.join(label.select(F.col("a").alias("b"), F.col("l").alias("m")), "b").groupBy("a").agg(F.min("m").alias("m"))
        hooked = label.join(seen, "a").select("a", F.col("l").alias("old"), F.least("l", "m").alias("l"))
        hooked = cut(hooked)
        jump = hooked.select(F.col("a").alias("l"), F.col("l").alias("j"))
        # the nodes of a large component share their label
        new = cut(join_hot(hooked, jump, ["l"], least=HOT).select("a", "old", F.least("l", "j").alias("l")))
        moved = new.where("l <> old").limit(1).count()
        label = new.select("a", "l")
        if not moved:
            return label.select(F.col("a").alias("_node"), F.col("l").alias("_comp"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                  max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id``."""
    if max_bits > 3:
        raise ValueError("six coordinate blocks cover at most 3 differing bits")
    by_doc = cut(fingerprints(docs, id_col, text_col, shingle))
    classes = cut(by_doc.groupBy("_fp").agg(F.min("_id").alias("_first")))
    comp = components(links(classes.select("_fp", F.col("_fp").alias("_node")), max_bits, block))
    linked = cut(classes.join(comp, F.col("_fp") == F.col("_node")).select("_fp", "_comp", "_first"))
    first = linked.groupBy("_comp").agg(F.min("_first").alias("_least"))
    # a fingerprint without links is a component of its own
    named = classes.join(linked.join(first, "_comp").select("_fp", F.lit(True).alias("_in"), "_least"), "_fp", "left").select(
        "_fp", F.when(F.col("_in"), F.col("_least")).otherwise(F.col("_first")).alias("_name"))
    return join_hot(by_doc, named, ["_fp"], least=HOT).select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("_name").alias("component_id"))


def keep_first_of_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: the one that names it."""
    rows, key = with_row_key(docs, id_col)
    found = simhash_dedup(rows, key, text_col, **options)
    return keep_rows(rows, key, found.where(F.col("component_id") == F.col(key)).select(key), docs.columns)
