"""Mixing sources to target weights by pivotal dependent rounding.

Method.  Each source's target is a share of all words by weight, stopped at
``ceiling`` times the source's size, with the excess reshared by weight until
none is above (one small aggregate a step).  A document is then wanted
``target / source size`` times: the whole part is taken as is, the fractional
part is a probability.  Inside a block of documents of one source the
probabilities are paired: a fair random transfer moves mass between the two
until one of them is 0 or 1, and the other goes on to the next pair.  A block
leaves at most one fractional document; a reduction tree joins the leftovers
of ``FAN_IN`` blocks at a time by the same rule until one is left per source,
which a last draw settles.  Blocks visit documents from large to small, so
mass moves between documents of like size and a source's words stay near the
target.

Every draw comes from a generator seeded by (seed, source rank, level, block),
so reruns and other partitionings give the same copies.

Defined results: a null text has size 0; documents of size 0 take 0 words; the
null source is the last one; a source of size 0 has target 0; rows repeated
with one id are rounded each on its own; an empty table gives an empty result;
extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinline.llm.common import cut, quoted, with_row_key

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CEILING = 3.0
BLOCK_ROWS = 10_000       # expected documents of a block
FAN_IN = 256              # blocks joined by one node of the tree
BROADCAST_SOURCES = 50_000  # rows of the source table up to which it is broadcast
EPS = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, ceiling: float = CEILING) -> DataFrame:
    """From (source, size) rows: one row per source with its rank, rows,
    ``source_size`` and ``target``."""
    stats = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count(F.lit(1)).alias("_n"))
    # one row per source: the only global order is over this aggregate
    order = Window.orderBy(F.col("source").asc_nulls_last())
    stats = stats.withColumn("_rank", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    stats = cut(stats.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * ceiling))
    first = stats.agg(F.sum("source_size").alias("t"), F.sum("_w").alias("w")).first()
    total, level, stopped = float(first["t"] or 0), (first["t"] or 0) / first["w"] if first["w"] else 0.0, -1
    while True:
        above = F.col("_w") * F.lit(level) > F.col("_cap")
        s = stats.agg(F.sum(F.when(above, 1).otherwise(0)).alias("n"), F.sum(F.when(above, F.col("_cap")).otherwise(0.0)).alias("cap"),
                      F.sum(F.when(above, 0.0).otherwise(F.col("_w"))).alias("w")).first()
        if not s["n"] or s["n"] == stopped or not s["w"]:
            break
        stopped, level = s["n"], (total - s["cap"]) / s["w"]
    return stats.withColumn("target", F.least(F.col("_w") * F.lit(level), F.col("_cap")).cast("double"))


def _pivot(pdf: pd.DataFrame, seed: int, level: int) -> pd.DataFrame:
    """One node: settle all rows but at most one."""
    pdf = pdf.sort_values(["_size", "_key"], ascending=[False, True], na_position="last", kind="stable").reset_index(drop=True)
    draws = np.random.default_rng([seed, level, int(pdf["_rank"][0]), int(pdf["_block"][0])]).random(len(pdf))
    p = pdf["_p"].to_numpy().copy()
    held = -1
    for i in range(len(p)):
        if p[i] <= EPS or p[i] >= 1 - EPS:
            p[i] = round(p[i])
            continue
        if held < 0:
            held = i
            continue
        a, b = p[held], p[i]
        if a + b <= 1:
            lose, win, rest = (held, i, a + b) if draws[i] < b / (a + b) else (i, held, a + b)
            p[lose] = 0.0
        else:
            full, win, rest = (held, i, a + b - 1) if draws[i] < (1 - b) / (2 - a - b) else (i, held, a + b - 1)
            p[full] = 1.0
        if EPS < rest < 1 - EPS:
            p[win], held = rest, win
        else:
            p[win], held = round(rest), -1
    pdf["_p"] = p
    return pdf


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, ceiling: float = CEILING, seed: int = 42,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_rows: int = BLOCK_ROWS,
        fan_in: int = FAN_IN) -> DataFrame:
    """One row per document: id, ``source``, ``size``, ``source_size``,
    ``target``, ``copies`` and ``taken`` (copies times size)."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    narrow = cut(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"), size.alias("size")))
    narrow, key = with_row_key(narrow, "_id")  # rows of one id go to blocks of their own
    stats = source_targets(narrow, weights, ceiling)
    wanted = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(ceiling))).otherwise(0.0)
    per_source = stats.select(F.col("source").alias("_source"), "_rank", "source_size", "target",
                              F.ceil(F.col("_n") / block_rows).alias("_blocks"), wanted.alias("_wanted"))
    per_source = cut(per_source)
    bound = per_source.agg(F.count(F.lit(1)).alias("n"), F.max("_blocks").alias("b")).first()
    right = F.broadcast(per_source) if bound["n"] <= BROADCAST_SOURCES else per_source
    rows = narrow.join(right, narrow["source"].eqNullSafe(per_source["_source"]))
    base = F.floor(F.col("_wanted") + EPS)
    rows = rows.select(
        "_id", F.col(key).alias("_key"), F.col("_rank").cast("int").alias("_rank"), F.pmod(F.xxhash64(key), F.col("_blocks")).alias("_block"),
        F.col("size").alias("_size"), base.cast("long").alias("_base"),
        F.when(F.col("size") > 0, F.greatest(F.col("_wanted") - base, F.lit(0.0))).otherwise(0.0).alias("_p"))
    schema = rows.schema

    def level(df: DataFrame, n: int) -> DataFrame:
        return df.groupBy("_rank", "_block").applyInPandas(lambda pdf: _pivot(pdf, seed, n), schema)

    settled = (F.col("_p") <= EPS) | (F.col("_p") >= 1 - EPS)
    now = cut(level(rows, 0))
    done, open_, blocks, n = now.where(settled), now.where(~settled), int(bound["b"] or 0), 0
    while blocks > 1:  # at most one row per block of the level below
        n, blocks = n + 1, -(-blocks // fan_in)
        now = cut(level(open_.withColumn("_block", F.floor(F.col("_block") / fan_in)), n))
        done, open_ = done.unionByName(now.where(settled)), now.where(~settled)
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("_rank"), F.col("_key")), F.lit(1 << 30)) / float(1 << 30)
    done = done.unionByName(open_.withColumn("_p", F.when(draw < F.col("_p"), 1.0).otherwise(0.0)))
    copies = (F.col("_base") + F.round("_p").cast("long"))
    done = done.select("_id", F.col("_rank").alias("_r"), "_size", copies.alias("copies"))
    return done.join(F.broadcast(per_source) if bound["n"] <= BROADCAST_SOURCES else per_source,
                     F.col("_r") == F.col("_rank")).select(
        F.col("_id").alias(id_col), F.col("_source").alias("source"), F.col("_size").alias("size"), "source_size", "target",
        "copies", (F.col("copies") * F.col("_size")).cast("long").alias("taken"))


def repeat_rows(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The mixture itself: every row of ``docs`` as many times as it is taken."""
    rows, key = with_row_key(docs, id_col)
    # the user's columns travel as one, so that no name can clash
    whole = rows.select(F.struct(*[quoted(c) for c in docs.columns]).alias("_row"), F.col(key).alias("_key"))
    copies = mix(rows, id_col=key, **options).where("copies > 0").select(F.col(key).alias("_of"), F.col("copies").cast("int").alias("_copies"))
    taken = whole.join(copies, F.col("_key") == F.col("_of")).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return taken.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
