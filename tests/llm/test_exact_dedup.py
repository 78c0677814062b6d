import re
from collections import defaultdict

import pytest

from twinline.llm.exact_dedup import exact_dedup, keep_unique


def brute(rows):
    """{(id, text): (keep, size)} by the definition."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), float("inf") if i is None else i, i))
    return {k: (min(v)[2], len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("buckets", [1, 2, 64])
def test_edge_rows(spark, edge, buckets):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    want = brute(rows)
    got = exact_dedup(edge, buckets=buckets).collect()
    assert len(got) == len(rows)
    by_sha = defaultdict(list)
    for r in got:
        by_sha[r["text_sha256"]].append(r)
    assert sorted((g[0]["keep_id"] is None, g[0]["keep_id"], len(g)) for g in by_sha.values()) == sorted((k is None, k, n) for k, n in want.values())
    for g in by_sha.values():
        assert sum(r["kept"] for r in g) == 1
        assert {r["group_size"] for r in g} == {len(g)} and len({r["keep_id"] for r in g}) == 1
        assert [r["doc_id"] for r in g if r["kept"]] == [g[0]["keep_id"]]


@pytest.mark.parametrize("buckets", [3, 200])
def test_hot_group_over_many_buckets(spark, buckets):
    rows = [(i, "hot text " * (1 + i % 2) if i % 3 else f"own {i // 6}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    want = brute(rows)
    got = {r["doc_id"]: r for r in exact_dedup(df, buckets=buckets).collect()}
    for i, t in rows:
        keep, size = want[re.sub(r"[\x20\x09-\x0D]", "", t)]
        assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (keep, size, keep == i)


def test_empty_and_rows_kept(spark, empty, docs, texts):
    assert exact_dedup(empty).count() == 0
    kept = keep_unique(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {k for k, _ in brute(texts.items()).values()}


@pytest.mark.parametrize("hot", [None, 5])
def test_equal_rows_are_cut_over_buckets(spark, monkeypatch, hot):
    """Half of the rows share text and id (or have none): no bucket holds them all."""
    from twinline.llm import exact_dedup as ed

    rows = [(hot, "the same text") for _ in range(4000)] + [(10 + k, f"own text {k}") for k in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    seen, real = [], ed.cut
    monkeypatch.setattr(ed, "cut", lambda d: seen.append(real(d)) or seen[-1])
    got = ed.exact_dedup(df, buckets=32).collect()
    same = [r for r in got if r["doc_id"] == hot]
    assert len(got) == 8000 and {(r["keep_id"], r["group_size"]) for r in same} == {(hot, 4000)}
    assert sum(r["kept"] for r in same) == 1 and sum(r["kept"] for r in got) == 4001
    sizes = [r["count"] for r in seen[0].groupBy("_b").count().collect()]
    assert max(sizes) <= 1500
