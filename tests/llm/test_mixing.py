import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from twinline.llm.mixing import _pivot, mix, repeat_rows, source_targets


def plain_targets(sizes, weights=(5, 2, 1), ceiling=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > ceiling * sizes[s]}
        if not over:
            return target | {s: left * w[s] / total for s in open_}
        target |= {s: ceiling * sizes[s] for s in over}
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


@pytest.mark.parametrize("block_rows,fan_in", [(10_000, 256), (50, 3)])
def test_documents(docs, block_rows, fan_in):
    rows = docs.collect()
    got = {r["doc_id"]: r for r in mix(docs, block_rows=block_rows, fan_in=fan_in).collect()}
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += words(r["text"])
    want = plain_targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        g = got[r["doc_id"]]
        assert g["size"] == words(r["text"]) and g["source_size"] == sizes[r["source"]]
        assert g["target"] == pytest.approx(want[r["source"]])
        assert g["taken"] == g["copies"] * g["size"] <= 3 * g["size"]
        base = int(want[r["source"]] / sizes[r["source"]] + 1e-9)
        assert base <= g["copies"] <= base + 1
        taken[r["source"]] += g["taken"]
        largest[r["source"]] = max(largest[r["source"]], g["size"])
    for s, t in taken.items():
        assert abs(t - want[s]) <= (1.5 if block_rows > 100 else 3) * largest[s]
    again = {r["doc_id"]: r["copies"] for r in mix(docs.repartition(11), block_rows=block_rows, fan_in=fan_in).collect()}
    assert again == {i: r["copies"] for i, r in got.items()}


def test_edge_rows(edge, empty):
    got = mix(edge).collect()
    assert len(got) == edge.count()
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    assert {r["size"] for r in got if r["source"] is None} == {0, 1}
    assert mix(empty).count() == 0


def test_targets_stop_at_the_ceiling(spark):
    sizes = {"a": 1, "b": 1000, "c": 10, None: 5, "d": 0}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(df).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    for s in got:
        assert got[s] == pytest.approx(want[s])


def test_pivot_keeps_the_sum_and_the_probabilities():
    n = 40
    p0 = np.random.default_rng(3).random(n)
    hits = np.zeros(n)
    for seed in range(2000):
        pdf = pd.DataFrame({"_rank": 0, "_block": 1, "_size": np.arange(n), "_key": np.arange(n), "_p": p0})
        out = _pivot(pdf, seed, 0).sort_values("_key")["_p"].to_numpy()
        inside = (out > 1e-9) & (out < 1 - 1e-9)
        assert inside.sum() <= 1 and out.sum() == pytest.approx(p0.sum())
        hits += out
    assert np.abs(hits / 2000 - p0).max() < 0.05


def test_repeated_rows_of_the_mixture(docs):
    copies = {r["doc_id"]: r["copies"] for r in mix(docs).collect()}
    out = repeat_rows(docs)
    assert out.columns == docs.columns
    got = defaultdict(int)
    for r in out.select("doc_id").collect():
        got[r["doc_id"]] += 1
    assert got == {i: c for i, c in copies.items() if c}


def test_blocks_of_a_hot_id_are_bounded(spark, monkeypatch):
    """A third of the rows under one id, a third without: no block is large."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, "w " * (i % 9 + 1), "s") for i in range(6000)]
    rows += [(i, "w w w", "t") for i in range(10_000, 11_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    seen, real = [], type(df).groupBy

    def watched(self, *cols):
        if cols == ("_rank", "_block"):
            seen.append(self)
        return real(self, *cols)

    monkeypatch.setattr(type(df), "groupBy", watched)
    got = mix(df, block_rows=500).collect()
    assert len(got) == len(rows) and sum(r["taken"] for r in got if r["source"] == "s") == pytest.approx(
        next(r["target"] for r in got if r["source"] == "s"), abs=30)
    blocks = [r["count"] for r in real(seen[0], "_rank", "_block").count().collect()]
    assert max(blocks) <= 2 * 500
