import random
from collections import defaultdict

import pytest
from plain_simhash import plain_components, plain_fingerprint

from twinline.llm import simhash as sh


def test_documents(docs, texts):
    got = {r["doc_id"]: r for r in sh.simhash_dedup(docs).collect()}
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r["component_id"] for i, r in got.items()} == plain_components(fps)
    kept = sh.keep_first_of_component(docs)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == set(plain_components(fps).values())


@pytest.mark.parametrize("block", [4, 512])
def test_links_of_close_fingerprints(spark, block):
    rng = random.Random(5)
    fps = []
    for _ in range(12):
        c = rng.getrandbits(64)
        for _ in range(30):
            x = c
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(64)
            fps.append(x)
    fps = dict(enumerate(dict.fromkeys(fps)))
    classes = spark.createDataFrame([(sh._signed(f), i) for i, f in fps.items()], "_fp long, _node long").repartition(5)
    edges = sh.links(classes, block=block).collect()
    want = plain_components(fps)
    assert edges and all(want[r["a"]] == want[r["b"]] for r in edges)
    comp = {r["_node"]: r["_comp"] for r in sh.components(sh.links(classes, block=block)).collect()}
    assert {i: comp.get(i, i) for i in fps} == want


def test_components_of_a_long_chain(spark):
    n = 40
    order = random.Random(1).sample(range(n), n)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)], "a long, b long")
    assert {r["_comp"] for r in sh.components(edges).collect()} == {0}


def test_edge_rows(edge, empty):
    rows = edge.collect()
    got = defaultdict(set)
    for r in sh.simhash_dedup(edge).collect():
        got[r["fingerprint"]].add(r["component_id"])
    assert set(got) == {f"{plain_fingerprint(r['text']):016x}" for r in rows}
    assert got["0" * 16] == {4} and all(len(v) == 1 for v in got.values())
    assert got[f"{plain_fingerprint('abc'):016x}"] == {3}
    assert sh.simhash_dedup(edge).count() == len(rows)
    assert sh.simhash_dedup(empty).count() == 0


def test_null_and_repeated_ids_merge_no_unrelated_texts(spark):
    rng = random.Random(11)
    words = [[f"w{i}x{rng.randrange(10**6)}" for _ in range(1500)] for i in range(7)]
    text = [" ".join(w) for w in words]
    near = [" ".join(w[:-1]) for w in words]  # one word less: a few bits at most
    assert [(plain_fingerprint(a) ^ plain_fingerprint(b)).bit_count() <= 3 for a, b in zip(text[:2], near[:2])] == [True] * 2
    # two null-id texts near docs 7 and 100, null ids alone, one repeated id on two unrelated texts
    rows = [(7, text[0]), (None, near[0]), (100, text[1]), (None, near[1]), (None, text[2]), (None, text[3]),
            (200, text[4]), (200, text[5]), (300, text[5]), (301, text[6])]
    fps = {t: f"{plain_fingerprint(t):016x}" for _, t in rows}
    want = [7, 7, 100, 100, None, None, 200, 200, 200, 301]
    got = sh.simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    key = lambda x: tuple((v is None, v or 0) for v in (x[0], x[2])) + (x[1],)
    assert sorted(map(tuple, got), key=key) == sorted(((i, fps[t], c) for (i, t), c in zip(rows, want)), key=key)
