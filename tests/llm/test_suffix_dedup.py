import hashlib
import random

import numpy as np
import pytest

from twinline.llm import suffix_dedup as sd


def plain(rows, width=100):
    """rows: [(id, text)] with unique ids; by definition, one string at a time."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - width + 1):
            w = hashlib.md5(raw[s:s + width]).digest()
            if w in seen:
                gone[s:s + width] = True
            seen.add(w)
        edges = int((np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1).sum())
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[i] = (len(raw), int(gone.sum()), edges, hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(1500):
        x = [rng.randint(1, rng.randint(1, 4)) for _ in range(rng.randint(1, 40))] + [0]
        assert sd.gsaca(np.array(x)) == sorted(range(len(x)), key=lambda i: x[i:])


def test_context_order():
    rng = np.random.default_rng(2)
    ctx = rng.integers(0, 3, (200, 76)).astype(np.uint8)
    ctx[50:100] = ctx[:50]
    ctx[100:150, :40] = ctx[:50, :40]
    ranks, common = sd.context_order(ctx)
    order = np.argsort(ranks)
    rows = [ctx[i].tobytes() for i in order]
    assert rows == sorted(rows) and sorted(ranks) == list(range(200))
    for i in range(1, 200):
        n = next((j for j in range(76) if rows[i][j] != rows[i - 1][j]), 76)
        assert common[i] == n


def made(seed=3):
    """Passages shared at all offsets, near copies, periodic texts, short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randint(15, 60)) for _ in range(12)]
    rows = []
    for i in range(160):
        parts = []
        for _ in range(rng.randint(1, 5)):
            if rng.random() < 0.6:
                p = rng.choice(passages)
                a = rng.randint(0, len(p) // 2)
                p = p[a:rng.randint(a, len(p))]
                if rng.random() < 0.5 and len(p) > 3:
                    at = rng.randrange(len(p))
                    p = p[:at] + "X" + p[at + 1:]
                parts.append(p)
            else:
                parts.append(prose(rng.randint(1, 60)))
        rows.append((i * 7 % 1000, "\n".join(parts)))
    rows += [(2000, "ab" * 400), (2001, "ba" * 300), (2002, "x" * 99), (2003, "x" * 100), (2004, "x" * 350), (2005, ""), (2006, None)]
    return rows


@pytest.mark.parametrize("limits", [{}, {"PIECE": 16, "FLUSH": 200, "SEGMENT": 700, "LOCAL_HOT": 3}])
@pytest.mark.parametrize("hot_gram", [sd.HOT_GRAM, 4])
def test_against_the_definition(spark, monkeypatch, limits, hot_gram):
    for k, v in limits.items():
        monkeypatch.setattr(sd, k, v)
    rows = made()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(sd.remove_repeats(df, hot_gram=hot_gram)) == plain(rows)


def test_documents(docs, texts):
    assert result(sd.remove_repeats(docs)) == plain(texts.items())


def test_edge_rows(edge, empty):
    rows = edge.collect()
    got = sd.remove_repeats(edge, keep_bytes=True).collect()
    assert len(got) == len(rows)
    assert all(r["kept_sha256"] == hashlib.sha256(r["kept"]).hexdigest() for r in got)
    zebra = next(r for r in got if r["doc_id"] == 2)
    assert zebra["n_spans"] == 1 and zebra["n_bytes"] - zebra["n_removed"] == 6
    assert {r["n_removed"] for r in got if r["doc_id"] != 2} == {0}
    assert sd.remove_repeats(empty).count() == 0


def test_repeated_and_null_ids(spark):
    """A repeated row is one document; rows of one id with other texts come in hash order; null ids come last."""
    rng = random.Random(9)
    prose = ["".join(rng.choice("abcdef ") for _ in range(400)) for _ in range(3)]
    rows = [(1, prose[0]), (1, prose[0]), (2, prose[1]), (2, prose[0][:250] + prose[2]), (None, prose[1] + "tail"), (None, prose[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sd.remove_repeats(df, keep_bytes=True).collect()
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["kept"].decode()) for r in got)
    assert kept == sorted([(False, 1, prose[0]), (False, 1, prose[0]), (False, 2, prose[1]), (False, 2, prose[2]), (True, 0, "tail"), (True, 0, "")])
