"""Collation (FIXTURES example, straddling batches) and metric arithmetic."""

import math

import numpy as np
from pyspark.sql import functions as F

from twinline.functions import arrays as ax
from twinline.operators import collate as col
from twinline.operators import metrics


def test_collation_example(spark):
    df = spark.createDataFrame([("c", 0, [2, 5, 3], [2, 7, 8, 3]), ("c", 1, [2, 3], [2, 9, 3])],
                               "corpus string, line_no long, src_ids array<int>, tgt_ids array<int>")
    out = {r["line_no"]: r for r in col.collate(df, ["corpus", "line_no"], 64, shuffle=False).collect()}
    assert out[0]["tgt_input_ids"] == [2, 7, 8] and out[1]["tgt_input_ids"] == [2, 9, 3]
    assert out[0]["tgt_outputs"] == [7, 8, 3] and out[1]["tgt_outputs"] == [9, 3, -100]
    assert all(out[0]["tgt_pad_mask"]) and all(out[1]["tgt_pad_mask"])
    assert out[1]["src_input_ids"] == [2, 3, 1] and out[1]["src_pad_mask"] == [True, True, False]


def test_shuffled_batches_match_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [("k", i, [2] + rng.integers(4, 50, rng.integers(0, 9)).tolist() + [3],
             [2] + rng.integers(4, 50, rng.integers(0, 12)).tolist() + [3]) for i in range(700)]
    df = spark.createDataFrame(rows, "corpus string, line_no long, src_ids array<int>, tgt_ids array<int>")
    for digits in (1, 2):  # 2 digits -> 256 buckets -> many batches straddle bucket boundaries
        got = {r["line_no"]: r for r in col.collate(df, ["corpus", "line_no"], 16, seed=5, epoch=1,
                                                    digits=digits).collect()}
        order = [r["line_no"] for r in df.select("line_no", F.md5(F.concat_ws(":", F.lit("5"), F.lit("1"),
                 F.col("corpus"), F.col("line_no").cast("string"))).alias("h")).orderBy("h", "line_no").collect()]
        by_id = {r[1]: r for r in rows}
        for b in range(0, len(order), 16):
            ids = order[b:b + 16]
            smax = max(len(by_id[i][2]) for i in ids)
            tmax = max(len(by_id[i][3]) for i in ids)
            for p, i in enumerate(ids):
                r = got[i]
                assert r["batch_id"] == b // 16 and r["pos"] == p
                assert len(r["src_input_ids"]) == smax
                assert len(r["tgt_input_ids"]) == tmax - 1
                padded = by_id[i][3] + [1] * (tmax - len(by_id[i][3]))
                assert r["tgt_input_ids"] == padded[:-1]
                assert r["tgt_outputs"] == [-100 if x == 1 else x for x in padded[1:]]


def test_clip_and_argmax(spark):
    df = spark.createDataFrame([([2, 5, 3, 7],), ([4, 4, 4],), ([],)], "ids array<int>")
    got = [r[0] for r in df.select(ax.clip_generated("ids", 3, 2)).collect()]
    assert got == [[2, 5], [4, 4], []]
    got = [r[0] for r in df.select(ax.clip_generated("ids", 3, 10)).collect()]
    assert got == [[2, 5, 3], [4, 4, 4], []]
    df = spark.createDataFrame([([0.1, 0.9, 0.9],)], "v array<float>")
    assert df.select(ax.argmax("v")).first()[0] == 1


def test_cross_entropy_and_accuracy_against_numpy(spark):
    rng = np.random.default_rng(0)
    logits = rng.normal(size=(40, 7)).astype(np.float32)
    target = rng.integers(0, 7, 40)
    target[::5] = -100
    rows = [(i, i // 10, i % 10, int(target[i]), logits[i].tolist()) for i in range(40)]
    df = spark.createDataFrame(rows, "example_id long, batch_id long, pos int, target_id int, logits array<float>")
    got = {r["batch_id"]: r for r in metrics.batch_metrics(df).collect()}
    for b in range(4):
        sl = slice(b * 10, b * 10 + 10)
        lg, tg = logits[sl].astype(np.float64), target[sl]
        m = tg != -100
        lse = np.log(np.exp(lg - lg.max(1, keepdims=True)).sum(1)) + lg.max(1)
        loss = (lse - lg[np.arange(10), np.where(m, tg, 0)])[m].mean()
        acc = (lg.argmax(1)[m] == tg[m]).mean()
        assert math.isclose(got[b]["loss"], loss, rel_tol=1e-9)
        assert math.isclose(got[b]["accuracy"], acc, rel_tol=1e-12)


def test_batch_without_valid_positions_gives_null(spark):
    df = spark.createDataFrame([(0, 0, 0, -100, [0.1, 0.2])],
                               "example_id long, batch_id long, pos int, target_id int, logits array<float>")
    r = metrics.batch_metrics(df).first()
    assert r["accuracy"] is None and r["loss"] is None and r["valid_tokens"] == 0


def test_step_metrics_drop_short_group(spark):
    b = spark.createDataFrame([(i, 1.0 * i, 0.5) for i in range(5)], "batch_id long, loss double, accuracy double")
    s = metrics.step_metrics(metrics.assign_steps(b, 2), 2).orderBy("step").collect()
    assert [(r["step"], r["train_loss"]) for r in s] == [(0, 0.5), (1, 2.5)]
    assert metrics.eval_points(metrics.assign_steps(b, 2).withColumn("step", F.col("step") * 2500), 2500).count() == 5


def test_steps_run_on_over_epochs(spark):
    rows = [(e, b, 1.0 * b + e, 0.5) for e, n in ((0, 5), (1, 4), (2, 3)) for b in range(n)]
    df = spark.createDataFrame(rows, "epoch int, batch_id long, loss double, accuracy double")
    got = sorted((r["epoch"], r["step"], r["train_loss"]) for r in metrics.step_metrics(metrics.assign_steps(df, 2), 2).collect())
    # five batches make two steps (the fifth is dropped), four make two, three make one
    assert got == [(0, 0, 0.5), (0, 1, 2.5), (1, 2, 1.5), (1, 3, 3.5), (2, 4, 2.5)]
