"""Hard-negative mining by slot-decomposed selection.

Method.  An anchor's positives are its nearest rows of the same label; each
opens a window of negative scores, from ``low`` to ``high`` percent of the
positive's score.  The windows overlap, but they differ in their upper limits:
the distinct upper limits cut the scores below the highest one into disjoint
slots.  While the table is scored against a block of anchors, a task keeps the
k best rows of each (anchor, slot); Spark merges these by slot.  The first k
rows of any window lie among the k best of its own slot and the slots below,
so every window is answered from the slots of its suffix in descending order,
cut at its lower limit.  No window needs a pass of its own, and no row is kept
more than once a slot.

Anchors go in blocks of ``ANCHORS`` (a bound on what is broadcast); every row
is scored against every block, in blocks, exactly (integers; matrix products
in doubles where all sums stay below 2^53, else in 64-bit integers).

Defined results: rows with a null label, or a vector that is null, empty or holds a
null or non-finite component, take no part; floor(256 x) saturates at 64 bits
and sums beyond wrap; rows of different length do not meet; repeated ids are
rows of their own (a copy of the anchor's id is an other row); null ids are no
anchors and come last among equal scores; an anchor without positives, or a
window without rows, gives no rows; an empty table gives an empty result;
extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinline.llm.common import cut, vector_matrix, with_row_key
from twinline.llm.lexical_search import top_k

cloudpickle.register_pickle_by_value(sys.modules[__name__])

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90   # window of a positive's score, in percent
ANCHORS = 2048       # anchors of a block
CHUNK = 2048         # rows scored at a time
EXACT = float(1 << 53)
NO_ID = (1 << 63) - 1
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def to_units(m: np.ndarray) -> np.ndarray:
    """floor(256 x), saturating at 64 bits."""
    x = np.floor(m * 256.0)
    out = np.clip(x, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
    out[x >= 2.0**63] = MOST
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows."""
    reach = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * a.shape[1]
    return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64) if reach < EXACT else a @ b.T


def _limits(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest negative score of the window of each positive score."""
    s = [int(x) for x in score]
    return np.array([-(-low * x // 100) for x in s], np.int64), np.array([high * x // 100 for x in s], np.int64)


class Kept:
    """The best rows of each group so far, ``k`` a group at most after ``settle``."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.kth = np.full(groups, LEAST, np.int64)  # a lower score cannot enter any more
        self.cols = [np.empty(0, np.int64) for _ in range(4)]  # group, score, id, key

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        g, s, i, r = (np.concatenate([old, new]) for old, new in zip(self.cols, (group, score, ids, keys)))
        order = np.lexsort((r, i, ~s, g))  # ~s: descending without overflow
        g, s, i, r = g[order], s[order], i[order], r[order]
        first = np.searchsorted(g, g)
        place = np.arange(len(g)) - first
        last = place == self.k - 1
        self.kth[g[last]] = s[last]
        keep = place < self.k
        self.cols = [g[keep], s[keep], i[keep], r[keep]]


def _scored(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Chunks of rows of ``dim`` components: units, label codes, ids, keys; small ones first."""
    size = 256
    for b in batches:
        at = np.nonzero(np.asarray(b.column("_dim")) == dim)[0]
        b = b.take(pa.array(at)) if len(at) < b.num_rows else b
        i = 0
        while i < b.num_rows:
            part = b.slice(i, size)
            i, size = i + size, min(CHUNK, size * 2)
            yield (to_units(vector_matrix(part.column("_vec"))), np.asarray(part.column("_label")),
                   np.asarray(part.column("_sort")), np.asarray(part.column("_row")))


SCORED = "_anchor long, _slot long, score long, _sort long, _row long"


def _report(kept: Kept, anchors: np.ndarray, slots: int) -> pa.RecordBatch:
    g, s, i, r = kept.cols
    return pa.RecordBatch.from_arrays([pa.array(anchors[g // slots]), pa.array(g % slots), pa.array(s), pa.array(i), pa.array(r)],
                                      names=["_anchor", "_slot", "score", "_sort", "_row"])


def nearest_of_label(batches, units: np.ndarray, labels: np.ndarray, keys: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """The k best other rows of each anchor's label among a task's rows."""
    kept = Kept(len(keys), k)
    for x, lab, ids, rows in _scored(batches, units.shape[1]):
        score = products(units, x)
        a, r = np.nonzero((score >= kept.kth[:, None]) & (labels[:, None] == lab[None, :]) & (keys[:, None] != rows[None, :]))
        if len(a):
            kept.add(a, score[a, r], ids[r], rows[r])
    yield _report(kept, keys, 1)


def best_of_slots(batches, units: np.ndarray, labels: np.ndarray, keys: np.ndarray, upper: np.ndarray, least: np.ndarray,
                  k: int) -> Iterator[pa.RecordBatch]:
    """The k best rows of other labels of each (anchor, slot).  ``upper`` holds
    the anchors' upper limits, descending, padded with LEAST; slot j is
    (upper[j + 1], upper[j]]; scores below ``least`` are in no window."""
    slots = upper.shape[1]
    kept = Kept(len(keys) * slots, k)
    base = np.arange(len(keys))[:, None] * slots
    for x, lab, ids, rows in _scored(batches, units.shape[1]):
        score = products(units, x)
        slot = np.zeros(score.shape, np.int64)
        for j in range(slots):
            slot += score <= upper[:, j:j + 1]
        inside = (slot > 0) & (score >= least[:, None]) & (labels[:, None] != lab[None, :])
        group = base + np.maximum(slot - 1, 0)
        a, r = np.nonzero(inside & (score >= kept.kth[group]))
        if len(a):
            kept.add(group[a, r], score[a, r], ids[r], rows[r])
    yield _report(kept, keys, slots)


def mine(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", anchor_every: int = 100,
         shift_every: int = 7, n_labels: int = 10, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, block: int = ANCHORS) -> DataFrame:
    """One row per anchor, positive and rank: ``anchor_id``, ``positive_id``,
    ``rank``, ``negative_id``, ``positive_score``, ``negative_score``."""
    spark = vectors.sparkSession
    narrow = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_given"), F.col(vec_col).alias("_vec"))
    keyed, key = with_row_key(narrow, "_id")
    kind = keyed.schema["_vec"].dataType.simpleString()
    vec = F.col("_vec") if kind == "array<float>" else F.col("_vec").cast("array<double>")
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    label = F.when(F.col("_id") % shift_every == 0, (F.col("_given").cast("long") + 1) % n_labels).otherwise(F.col("_given")).cast("long")
    rows = keyed.where(F.col("_given").isNotNull() & (F.size("_vec") > 0) & ~F.exists("_vec", odd)).select(
        F.col("_id").cast("long").alias("_id"), F.coalesce(F.col("_id").cast("long"), F.lit(NO_ID)).alias("_sort"),
        F.col(key).cast("long").alias("_row"), label.alias("_label"), F.size("_vec").alias("_dim"), vec.alias("_vec"))
    anchors = rows.where(F.col("_id") % anchor_every == 0)
    # numbered inside 64 parts, so that a block takes as many of each
    part = F.pmod(F.xxhash64("_row"), F.lit(64))
    nth = F.row_number().over(Window.partitionBy(part).orderBy("_row")) - 1
    anchors = cut(anchors.withColumn("_block", F.floor(nth / max(1, block // 64))))
    sizes = anchors.select("_dim", "_block").distinct().orderBy("_dim", "_block").collect()  # a row a block
    pos_parts, neg_parts = [], []
    for s in sizes:
        some = anchors.where((F.col("_dim") == s["_dim"]) & (F.col("_block") == s["_block"]))
        t = some.select("_row", "_label", "_vec").toArrow()  # at most ``block`` rows
        units, labels, keys = to_units(vector_matrix(t["_vec"])), np.asarray(t["_label"]), np.asarray(t["_row"])
        shared = spark.sparkContext.broadcast((units, labels, keys))

        def near(batches, shared=shared):
            return nearest_of_label(batches, *shared.value, positives)

        order = [F.col("score").desc(), F.col("_sort"), F.col("_row")]
        found = cut(top_k(rows.select("_sort", "_row", "_label", "_dim", "_vec").mapInArrow(near, SCORED), ["_anchor"], order, positives, "_place"))
        got = found.select("_anchor", "score").toArrow()  # at most ``positives`` rows an anchor
        number = {k: i for i, k in enumerate(keys.tolist())}
        at, score = np.array([number[k] for k in got["_anchor"].to_pylist()], np.int64), np.asarray(got["score"])
        lows, highs = _limits(score, low, high)
        upper, least = np.full((len(keys), positives), LEAST, np.int64), np.full(len(keys), MOST, np.int64)
        for i in range(len(keys)):
            mine_ = at == i
            real = mine_ & (lows <= highs)
            limits = np.unique(highs[real])[::-1]
            upper[i, :len(limits)] = limits
            least[i] = lows[real].min(initial=MOST)
        cuts = spark.sparkContext.broadcast((units, labels, keys, upper, least))

        def slots(batches, cuts=cuts):
            return best_of_slots(batches, *cuts.value, negatives)

        best = rows.select("_sort", "_row", "_label", "_dim", "_vec").mapInArrow(slots, SCORED)
        neg_parts.append(top_k(best, ["_anchor", "_slot"], order, negatives, "_place").drop("_place"))
        pos_parts.append(found)
    if not pos_parts:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    pos, neg = pos_parts[0], neg_parts[0]
    for p, n in zip(pos_parts[1:], neg_parts[1:]):
        pos, neg = pos.unionByName(p), neg.unionByName(n)
    # each window from the slots of its suffix, in descending order
    pos = pos.select("_anchor", F.col("score").alias("positive_score"), F.col("_sort").alias("_pid"), F.col("_row").alias("_prow"))
    neg = neg.select("_anchor", F.col("score").alias("negative_score"), F.col("_sort").alias("_nid"), F.col("_row").alias("_nrow"))
    times = lambda c, x: F.col(c).cast("decimal(20,0)") * F.lit(x)  # noqa: E731  (no overflow)
    inside = (times("positive_score", low) <= times("negative_score", 100)) & (times("negative_score", 100) <= times("positive_score", high))
    window = Window.partitionBy("_anchor", "_prow").orderBy(F.col("negative_score").desc(), "_nid", "_nrow")
    out = pos.join(neg, "_anchor").where(inside).withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= negatives)
    names = anchors.select(F.col("_row").alias("_anchor"), F.col("_id").alias("anchor_id"))
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.join(names, "_anchor").select("anchor_id", real("_pid").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                                             real("_nid").alias("negative_id"), "positive_score", "negative_score")
