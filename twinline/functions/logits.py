"""Argmax and cross-entropy over rows of logits (T3, A9), whole or in
vocabulary shards.

``row_scores`` is one Arrow UDF: a batch's logits are one flat array, and
maxima, first positions of the maxima and sums of exponentials are taken per
row by segment reductions, a bounded piece at a time.  ``shard_scores`` gives
the mergeable form for logits that are stored in pieces of the vocabulary: the
piece's maximum, the sum of exponentials scaled by it, the maximum's position
and the target's logit.  ``merge_shards`` combines them per example; only these
few numbers are shuffled, never logits.

Defined values: a NaN logit counts as the largest (the first one is the
argmax) and makes the loss NaN; +inf makes the loss NaN; -inf weighs nothing,
and a target at -inf has loss +inf; only -inf gives NaN.  A null logit is
skipped by the argmax and makes the loss null.  Null or empty logits give null
for both; a null target, or one outside the row, gives a null loss.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE = 1 << 21  # logits worked on at a time


def _reduce(logits: pa.ListArray, target: np.ndarray) -> dict[str, np.ndarray]:
    """Per row of a batch: ``size``, ``m`` (maximum), ``at`` (its first
    position), ``s`` (sum of exp(x - m)), ``t`` (logit at ``target``), ``nulls``."""
    n = len(logits)
    size = np.asarray(pc.fill_null(pc.list_value_length(logits), 0), dtype=np.int64)
    flat = logits.flatten()
    ends = np.concatenate([[0], np.cumsum(size)])
    out = {"size": size, "m": np.full(n, -np.inf), "at": np.zeros(n, np.int64), "s": np.zeros(n), "t": np.full(n, np.nan),
           "nulls": np.zeros(n, np.int64)}
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + PIECE, side="right")) - 1)
        part = flat.slice(ends[i], ends[j] - ends[i])
        x = np.array(part.to_numpy(zero_copy_only=False), np.float64)
        rows = i + np.nonzero(size[i:j])[0]
        if len(rows):
            starts = ends[rows] - ends[i]
            if part.null_count:
                null = np.asarray(part.is_null())
                x[null] = -np.inf
                out["nulls"][rows] = np.add.reduceat(null.astype(np.int64), starts)
            with np.errstate(invalid="ignore", over="ignore"):
                m = np.maximum.reduceat(x, starts)
                per = np.repeat(m, size[rows])
                top = (x == per) | (np.isnan(x) if np.isnan(m).any() else False)
                if part.null_count:
                    top &= ~null
                hit = np.nonzero(top)[0]
                first = hit[np.minimum(np.searchsorted(hit, starts), len(hit) - 1)] if len(hit) else starts
                s = np.add.reduceat(np.exp(x - per), starts)
            out["m"][rows], out["at"][rows] = m, first - starts
            out["s"][rows] = np.where(np.isneginf(m), 0.0, s)
            inside = (target[rows] >= 0) & (target[rows] < size[rows])
            out["t"][rows[inside]] = x[starts[inside] + target[rows[inside]]]
        i = j
    return out


def _targets(target: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(target.cast(pa.int64()), -1))


@F.arrow_udf(T.StructType().add("pred_id", T.IntegerType()).add("loss", T.DoubleType()))
def _whole(logits: pa.Array, target: pa.Array) -> pa.Array:
    t = _targets(target)
    r = _reduce(logits, t)
    empty = r["nulls"] >= r["size"]
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        loss = np.where(np.isneginf(r["m"]), np.nan, np.log(r["s"]) + r["m"]) - r["t"]
    lost = empty | (r["nulls"] > 0) | (t < 0) | (t >= r["size"])
    return pa.StructArray.from_arrays([pa.array(r["at"].astype(np.int32), mask=empty), pa.array(loss, mask=lost)], names=["pred_id", "loss"])


@F.arrow_udf(T.StructType().add("m", T.DoubleType()).add("at", T.IntegerType()).add("s", T.DoubleType())
             .add("t", T.DoubleType()).add("nulls", T.LongType()))
def _piece(logits: pa.Array, target: pa.Array) -> pa.Array:
    t = _targets(target)
    r = _reduce(logits, t)
    empty = r["nulls"] >= r["size"]
    away = (t < 0) | (t >= r["size"])
    return pa.StructArray.from_arrays(
        [pa.array(r["m"], mask=empty), pa.array(r["at"].astype(np.int32), mask=empty), pa.array(r["s"], mask=empty),
         pa.array(r["t"], mask=away), pa.array(r["nulls"])], names=["m", "at", "s", "t", "nulls"])


def row_scores(logits: Column | str, target: Column | str) -> Column:
    """Struct (pred_id, loss) of a row of logits."""
    return _whole(logits, target)


def shard_scores(logits: Column, target: Column, offset: Column) -> Column:
    """Struct (m, at, s, t, nulls) of a piece of the vocabulary that starts at
    id ``offset``; ``at`` is the id of the piece's maximum."""
    s = _piece(logits, (target - offset).cast("long"))
    return F.struct(s["m"].alias("m"), (s["at"] + offset).cast("int").alias("at"), s["s"].alias("s"), s["t"].alias("t"),
                    s["nulls"].alias("nulls"))


def merge_shards(pieces: DataFrame, by: list[str], score: str = "score") -> DataFrame:
    """(*by, pred_id, loss) from a ``shard_scores`` column, pieces in any order."""
    m, at = F.col(f"{score}.m"), F.col(f"{score}.at")
    some = m.isNotNull()
    got = pieces.groupBy(*by).agg(
        F.max(F.when(some, F.struct(m.alias("m"), (-at).alias("back")))).alias("_top"),
        F.collect_list(F.when(some, F.struct(m.alias("m"), F.col(f"{score}.s").alias("s")))).alias("_sums"),  # a row a piece
        F.max(f"{score}.t").alias("_t"), F.sum(f"{score}.nulls").alias("_nulls"))
    # a piece of only -inf weighs nothing
    parts = F.transform("_sums", lambda p: F.when(p["m"] == float("-inf"), 0.0).otherwise(p["s"] * F.exp(p["m"] - F.col("_top.m"))))
    total = F.aggregate(parts, F.lit(0.0).cast("double"), lambda a, v: a + v)
    lse = F.when(F.col("_top.m") == float("-inf"), float("nan")).otherwise(F.log(total) + F.col("_top.m"))
    return got.select(*by, (-F.col("_top.back")).cast("int").alias("pred_id"), F.when(F.col("_nulls") == 0, lse - F.col("_t")).alias("loss"))
