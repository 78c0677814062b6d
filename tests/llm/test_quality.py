import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import sentencepiece

from twinline.llm import quality as ql


def plain(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit),
            len(words) < 10 or 100 * len(hit) > 20 * len(words))


def test_documents(docs, texts):
    got = {r["doc_id"]: r for r in ql.quality_rules(docs, ql.vocabulary_path()).collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=ql.vocabulary_path())
    for i, t in texts.items():
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain(t)
        assert not (r["kept"] and r["base_failed"])
    for i in list(texts)[:60]:
        ids = [x for w in re.findall(r"[^\x20\x09-\x0D]+", texts[i]) for x in sp.encode(w)]
        r = got[i]
        assert r["n_tokens"] == len(ids)
        if ids:
            p = np.array(list(Counter(ids).values())) / len(ids)
            assert abs(r["token_entropy"] + (p * np.log2(p)).sum()) < 1e-9
            assert abs(r["fallback_share"] - sum(map(sp.is_byte, ids)) / len(ids)) < 1e-12


def test_words_of_pieces_equal_words_of_texts():
    sp = sentencepiece.SentencePieceProcessor(model_file=ql.vocabulary_path())
    text = "plain words of a text, with (marks) and 123 numbers"
    assert sp.encode(text) == [x for w in text.split() for x in sp.encode(w)]


def test_repeated_windows_with_equal_hashes(monkeypatch):
    rng = np.random.default_rng(4)
    for _ in range(30):
        sizes = rng.integers(0, 60, 5)
        words = [[str(x) for x in rng.integers(0, 3, n)] for n in sizes]
        flat = pa.array([w for d in words for w in d], pa.string()).dictionary_encode()
        codes, doc = np.asarray(flat.indices).astype(np.int64), np.repeat(np.arange(5), sizes)
        got = ql.repeated_words(codes, doc, 5, max(1, len(flat.dictionary)))
        assert got.tolist() == [plain(" ".join(d))[4] for d in words]


def test_bands(spark):
    prose = "The committee read the report with care and agreed that most of its findings were sound enough to publish."
    rows = {1: prose, 2: " ".join(f"word{i % 2}" for i in range(12)), 3: "".join(chr(0xA720 + i % 90) + " " for i in range(60)),
            4: "සිංහල " * 3 + "x y z w v u t s r", 5: "комитет прочитал доклад и согласился что большинство его выводов верны"}
    got = {r["doc_id"]: r for r in ql.quality_rules(spark.createDataFrame(list(rows.items()), "doc_id long, text string"), ql.vocabulary_path()).collect()}
    assert got[1]["kept"] and got[1]["script"] == "latin" and got[1]["fallback_share"] == 0
    assert got[5]["kept"] and got[5]["script"] == "cyrillic"
    assert got[3]["fallback_share"] > 0.5
    strict = {s: ql.Band(100, 101, 0, 0) for s in ql.DEFAULT_BANDS}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    assert not any(r["kept"] for r in ql.quality_rules(df, ql.vocabulary_path(), bands=strict).collect())


def test_edge_rows(edge, empty):
    got = ql.quality_rules(edge, ql.vocabulary_path()).collect()
    rows = edge.collect()
    assert len(got) == len(rows)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r["doc_id"], *plain(r["text"])) for r in rows), key=key) == sorted(
        ((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got), key=key)
    assert ql.quality_rules(empty, ql.vocabulary_path()).count() == 0


def plain_verdict(rows, sp):
    """kept of (id, text, lang) rows, recomputed from the definitions; at most
    MAX_LANGUAGES labels, Latin script."""
    prepared = {}
    for i, t, lang in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        ids = [x for w in words for x in sp.encode(w)]
        prepared[i] = (lang or "latin", words, Counter(ids), len(ids), plain(t)[5])
    df, n = {}, Counter()
    for lang, _, cnt, _, failed in prepared.values():
        if not failed:
            n[lang] += 1
            df.setdefault(lang, Counter()).update(cnt.keys())
    bits = {i: sum(c * -math.log2((df[lang][k] - 0.5) / n[lang]) for k, c in cnt.items()) / size
            for i, (lang, _, cnt, size, failed) in prepared.items() if not failed}
    median = {}
    for lang in n:
        mine = sorted(math.floor(b * ql.MEDIAN_STEPS) / ql.MEDIAN_STEPS for i, b in bits.items() if prepared[i][0] == lang)
        median[lang] = mine[(len(mine) + 1) // 2 - 1]
    out = {}
    for i, (lang, words, cnt, size, failed) in prepared.items():
        if failed:
            out[i] = False
            continue
        band = ql.DEFAULT_BANDS["latin"]
        p = np.array(list(cnt.values())) / size
        inside = (band.min_chars_per_token <= sum(map(len, words)) / size <= band.max_chars_per_token
                  and sum(c for k, c in cnt.items() if sp.is_byte(k)) / size <= band.max_fallback_share
                  and -(p * np.log2(p)).sum() >= band.min_relative_entropy * min(math.log2(size), ql.ENTROPY_CAP))
        out[i] = inside and bits[i] <= median[lang] + ql.SURPRISAL_BITS
    return out, bits


def gibberish(n, alphabet, seed):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(40, 200))) for _ in range(n)]


def test_verdict_against_a_plain_version_with_planted_gibberish(spark, docs):
    """The default bands reject planted gibberish, keep clean texts, and give
    what the definitions give."""
    rows = [(r["doc_id"], r["text"], r["lang"] if r["doc_id"] % 9 else None) for r in docs.collect()]
    letters, consonants = "abcdefghijklmnopqrstuvwxyz", "bcdfghjklmnpqrstvwxz"
    planted = gibberish(10, letters, 1) + gibberish(10, consonants, 2) + gibberish(4, "0123456789abcdef", 3)
    langs = ["en", "fr", "de", "es"]
    rows += [(10**6 + k, t, langs[k % 4]) for k, t in enumerate(planted)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {r["doc_id"]: r for r in ql.quality_rules(df, ql.vocabulary_path()).collect()}
    want, bits = plain_verdict(rows, sentencepiece.SentencePieceProcessor(model_file=ql.vocabulary_path()))
    assert {i for i, r in got.items() if r["kept"]} == {i for i, k in want.items() if k}
    assert all(abs(got[i]["token_surprisal"] - b) < 1e-9 for i, b in bits.items())
    assert not any(got[10**6 + k]["kept"] for k in range(len(planted)))
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    clean = [i for i, q in labels.items() if q == 1 and i in got and not got[i]["base_failed"]]
    assert np.mean([got[i]["kept"] for i in clean]) >= 0.99


def test_many_labels_share_the_scripts_statistics(spark):
    rows = [(k, f"the committee read report number {k} with care and agreed on most of its findings", f"l{k}") for k in range(200)]
    got = ql.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string"), ql.vocabulary_path()).collect()
    assert len(got) == 200 and all(r["kept"] for r in got)
    none = ql.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string").drop("lang"), ql.vocabulary_path()).collect()
    assert all(r["kept"] for r in none)
