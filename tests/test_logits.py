"""Argmax and cross-entropy over whole rows and over vocabulary shards."""

import math
import random

import pytest
from pyspark.sql import functions as F

from twinline.functions import logits as lg
from twinline.operators import metrics

NAN, INF = math.nan, math.inf
SCHEMA = "example_id long, batch_id long, pos int, target_id int, logits array<float>"


def plain(x, target):
    """(argmax, loss) of one row, as the module defines them."""
    if not x or all(v is None for v in x):
        return None, None
    known = [(-INF if v is None else v) for v in x]
    at = next((i for i, v in enumerate(known) if math.isnan(v)), None)
    if at is None:
        at = max((i for i, v in enumerate(x) if v is not None), key=lambda i: (x[i], -i))
    if target is None or not 0 <= target < len(x) or None in x:
        return at, None
    m = max(known)
    if any(math.isnan(v) for v in known) or math.isinf(m):
        return at, NAN
    return at, math.log(sum(math.exp(v - m) for v in known)) + m - known[target]


def odd_rows():
    rows = [[1.0, 2.0, 3.0], [3.0, 3.0, 1.0], [], None, [None, 1.0], [None, None], [NAN, 1.0], [1.0, NAN, NAN], [INF, 0.0], [-INF, 0.0],
            [-INF, -INF], [0.0, INF, INF], [1e30, -1e30], [88.0, 89.0, 90.0], [None, -INF], [-INF, None, -INF, 2.0, 2.0], [5.0]]
    out = [(k * 10 + j, 0, k, t, x) for k, x in enumerate(rows) for j, t in enumerate([0, 1, None, -5, 99])]
    rnd = random.Random(2)
    for k in range(200):
        x = [rnd.gauss(0, 3) for _ in range(rnd.randint(1, 40))]
        out.append((1000 + k, 0, k, rnd.randrange(len(x)), x))
    return out


def close(a, b):
    if a is None or b is None:
        return a is b
    return (math.isnan(a) and math.isnan(b)) or a == b or abs(a - b) < 1e-5


@pytest.mark.parametrize("piece", [7, 1 << 21])
def test_whole_rows(spark, monkeypatch, piece):
    monkeypatch.setattr(lg, "PIECE", piece)
    df = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    got = metrics.with_predictions(df).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        at, loss = plain(r["logits"], r["target_id"])
        assert r["pred_id"] == at, r
        assert close(r["loss"], loss), r


@pytest.mark.parametrize("width", [1, 3, 16, 100])
def test_shards_equal_whole_rows(spark, width):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    shards = metrics.vocabulary_shards(df, width).repartition(5)
    got = {r["example_id"]: r for r in metrics.sharded_predictions(shards).collect()}
    whole = metrics.with_predictions(df).drop("logits").collect()
    assert len(got) == len(whole)
    for r in whole:
        s = got[r["example_id"]]
        assert s["pred_id"] == r["pred_id"], (r, s)
        assert close(s["loss"], r["loss"]), (r, s)
        assert s["correct"] == r["correct"]


def test_no_logits_in_the_shuffle_of_shards(spark):
    df = spark.createDataFrame(odd_rows()[-5:], SCHEMA)
    plan = metrics.sharded_predictions(metrics.vocabulary_shards(df, 8))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "ArrowEvalPython" in below  # the kernel runs before the shuffle
    assert "ArrowEvalPython" not in plan[:plan.index("Exchange")]


def test_a_wide_vocabulary(spark):
    wide = spark.range(64).select(
        F.col("id").alias("example_id"), F.lit(0).cast("long").alias("batch_id"), F.col("id").cast("int").alias("pos"),
        F.lit(31_999).alias("target_id"),
        F.transform(F.sequence(F.lit(1), F.lit(32_000)), lambda i: F.sin(i * (F.col("id") + 1)).cast("float")).alias("logits")).cache()
    whole = {r["example_id"]: (r["pred_id"], r["loss"]) for r in metrics.with_predictions(wide).collect()}
    parts = {r["example_id"]: (r["pred_id"], r["loss"]) for r in metrics.sharded_predictions(metrics.vocabulary_shards(wide, 4096)).collect()}
    assert set(whole) == set(parts)
    for k, (p, loss) in whole.items():
        assert parts[k][0] == p and abs(parts[k][1] - loss) < 1e-6
    r = wide.first()
    at, loss = plain(r["logits"], 31_999)
    assert whole[r["example_id"]][0] == at and abs(whole[r["example_id"]][1] - loss) < 1e-6
