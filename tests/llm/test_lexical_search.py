"""Limited accumulators against scoring every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from twinline.llm import lexical_search as ls

TERM = re.compile(ls.TERM)
LOWER = {ord(a): b for a, b in zip(ls.UPPER, ls.LOWER)}


def tokens(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    toks = [(i, tokens(t)) for i, t in docs]
    toks = [(i, t, Counter(t)) for i, t in toks if t]
    n, total = len(toks), sum(len(t) for _, t, _ in toks)
    df = Counter(w for _, _, c in toks for w in c)
    out = []
    for qid, text in items:
        scored = []
        for i, t, c in toks:
            m = 100 - 25 + (25 * len(t) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 12 * m))
                    for w in tokens(text) if c[w])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        for r, (s, null, i) in enumerate(sorted(scored)[:k], 1):
            out.append((qid, r, None if null else i, -s))
    return sorted(out, key=repr)


def rows(df):
    return sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()], key=repr)


def test_documents(spark, docs, texts):
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    some = bench.orderBy("item_id").limit(6)
    assert rows(ls.search(docs, some)) == brute(sorted(texts.items()), [(r["item_id"], r["text"]) for r in some.collect()])


@pytest.mark.parametrize("postings,piece,terms", [(40, 64, 100_000), (1 << 20, 1 << 20, 3)])
def test_small_blocks(spark, monkeypatch, postings, piece, terms):
    """Many blocks of documents, pieces of texts and blocks of queries give the same rows."""
    monkeypatch.setattr(ls, "BLOCK_POSTINGS", postings)
    monkeypatch.setattr(ls, "PIECE_BYTES", piece)
    rnd = np.random.default_rng(1)
    words = [f"w{i}" for i in range(60)]
    share = 1 / np.arange(1, 61)
    docs = [(i, " ".join(rnd.choice(words, rnd.integers(1, 40), p=share / share.sum()))) for i in range(400)]
    items = [(q, " ".join(rnd.choice(words, 12))) for q in range(7)] + [(0, "w3 w3 w50"), (9, "none of these"), (10, None), (11, "w1 W1 -w59!")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = rows(ls.search(df, spark.createDataFrame(items, "item_id long, text string"), k=5, query_terms=terms))
    assert got == brute(docs, items, 5)


def test_odd_rows(spark, edge, empty):
    items = [(1, "ABC zebra"), (1, "ABC zebra"), (None, "日本語 abd"), (3, None), (4, ""), (5, "a a a b")]
    clash = [(i, t, 1, 2, 3) for i, t in items]
    asked = spark.createDataFrame(clash, "item_id long, text string, rank int, _q long, score long")
    docs = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert rows(ls.search(edge, asked)) == brute(docs, items)
    assert ls.search(empty, asked).collect() == []
    assert ls.search(edge, asked.where("false")).collect() == []


def test_hot_document(spark):
    """Copies of one text, most without an id, are ranked each on its own."""
    docs = [(None if i % 3 else i, "same words here") for i in range(90)] + [(500, "words")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(9)
    items = [(0, "words here")]
    assert rows(ls.search(df, spark.createDataFrame(items, "item_id long, text string"))) == brute(docs, items)


def test_accumulators_are_limited():
    """Documents that hold only frequent terms get no accumulator once the rare
    terms decide, and the result is that of scoring all."""
    n = 1000
    rare = [np.arange(30)] * 4
    common = [np.arange(n)] * 2
    lists = rare + common
    starts = np.cumsum([0, *map(len, lists)])
    gain = np.concatenate([np.full(len(x), 100) for x in lists])
    q = (0, np.arange(6), np.array([50, 50, 50, 50, 1, 1]))
    found, score = ls.search_block(q, starts, np.concatenate(lists), gain, np.full(6, 100), n, 20, 1)
    assert sorted(found) == list(range(30)) and set(score) == {20200}
    # a floor from elsewhere that nothing reaches
    found, _ = ls.search_block(q, starts, np.concatenate(lists), gain, np.full(6, 100), n, 20, 10**6)
    assert len(found) == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aZ9 -_é日\U0001f600\n{", max_size=30), max_size=8))
def test_token_runs(texts):
    raw = [t.encode() for t in texts]
    starts = np.cumsum([0, *map(len, raw)])[:-1]
    buf = np.frombuffer(b"".join(raw), np.uint8)
    at, found = ls.token_runs(buf, starts)
    assert [t.decode() for t in found.to_pylist()] == [w for t in texts for w in tokens(t)]
    owner = np.searchsorted(starts, at, side="right") - 1
    # an empty text shares its start with the next one: the last of them owns the bytes
    assert np.bincount(owner, minlength=len(texts)).tolist() == [len(tokens(t)) for t in texts]
