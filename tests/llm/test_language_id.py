import math
import random
import zlib

import numpy as np
import pytest

from twinline.llm import language_id as li


@pytest.fixture(scope="module")
def model(docs):
    return li.train(docs.where(~li.held_out()))


def test_held_out_accuracy(docs, model):
    labels = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = {r["doc_id"]: r for r in li.predict(docs, model).collect()}
    assert got.keys() == labels.keys()
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {r["doc_id"] for r in docs.where(li.held_out()).collect()} == set(held)
    told = [i for i in held if got[i]["lang_pred"] != li.UND]
    assert np.mean([got[i]["lang_pred"] == labels[i] for i in told]) > 0.97
    assert 0.5 < model.zeros < 1 and 0.05 <= model.temperature <= 20
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_same_model_from_other_partitions(docs, model):
    other = li.train(docs.where(~li.held_out()).repartition(7))
    assert np.array_equal(other.weights, model.weights) and other.temperature == model.temperature


def test_features_stay_inside_a_text():
    letters = li._unpack(li.letter_bits())
    apart = [li.char_features([t], letters) for t in ("Ab c", "", "12 é!x", "ß")]
    doc, feats, has = li.char_features(["Ab c", "", "12 é!x", "ß"], letters)
    assert has.tolist() == [True, False, True, True]
    for k, (_, own, _) in enumerate(apart):
        for f, g in zip(feats, own):
            assert f[doc == k].tolist() == g.tolist()


def test_ftrl_learns_and_stays_sparse():
    rng = np.random.default_rng(1)
    examples = []
    for _ in range(300):
        y = int(rng.integers(3))
        idx = np.unique(np.concatenate([rng.integers(1000, 2000, 10), [y]]))
        examples.append((idx, np.ones(len(idx)), y))
    w, b = li.ftrl(examples, 3, l1=1.0)
    assert np.mean([int(np.argmax(v @ w[i] + b)) == y for i, v, y in examples]) > 0.95
    assert (w == 0).mean() > 0.98


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(2)
    logits = rng.normal(size=(500, 3))
    y = np.array([rng.choice(3, p=li._softmax(x / 3)) for x in logits])
    assert 2 < li.fit_temperature(logits, y) < 5
    assert li.fit_temperature(logits[:0], y[:0]) == 1.0


def test_edge_rows(edge, empty, model):
    got = li.predict(edge, model).collect()
    assert len(got) == edge.count()
    und = [r["doc_id"] for r in got if r["lang_pred"] == li.UND]
    assert sorted(und, key=str) == sorted([4, 8, 7, None], key=str)
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == li.UND)
    assert li.predict(empty, model).count() == 0
    none = li.train(empty)
    assert {(r["lang_pred"], r["score"]) for r in li.predict(edge, none).collect()} == {(li.UND, 0.0)}
    own = li.train(edge)
    assert own.languages == ["de", "en", "fr"] and li.predict(edge, own).count() == edge.count()


def plain_features(text):
    """Counts of the hashed 1- to 3-grams, character by character."""
    chars = []
    for c in (text or "").lower():
        if c.isalpha():
            chars.append(ord(c))
        elif chars and chars[-1] != 32:
            chars.append(32)
    if chars and chars[-1] != 32:
        chars.append(32)
    out, wrap = {}, (1 << 64) - 1
    a, b = int(li._MIX[0]), int(li._MIX[1])
    for i in range(len(chars)):
        h = 0
        for n, c in enumerate(chars[i:i + 3], 1):
            h = (h * 0x100000001B3 + (c + n) * a) & wrap
            f = (((h ^ (h >> 29)) * b) & wrap) >> (64 - li.DIM_BITS)
            out[f] = out.get(f, 0) + 1
    return out


def plain_model(rows):
    """The same method with dictionaries: document frequencies, FTRL one
    coordinate at a time, grid search of the temperature."""
    counted = [(plain_features(t), lang) for t, lang in rows]
    langs = sorted({lang for _, lang in counted})
    df = {}
    for f, _ in counted:
        for k in f:
            df[k] = df.get(k, 0) + 1
    idf = lambda k: math.log((1 + len(rows)) / (1 + df.get(k, 0))) + 1
    return counted, langs, idf


def plain_ftrl(examples, classes, order):
    z, n = {}, {}

    def weight(k):
        if abs(z.get(k, 0.0)) <= li.L1:
            return 0.0
        return -(z[k] - math.copysign(li.L1, z[k])) / ((li.BETA + math.sqrt(n[k])) / li.ALPHA + li.L2)

    for e in order:
        feats, y = examples[e]
        feats = {**feats, li.DIM: 1.0}
        w = {(f, c): weight((f, c)) for f in feats for c in range(classes)}
        logits = [sum(v * w[f, c] for f, v in feats.items()) for c in range(classes)]
        top = max(logits)
        p = [math.exp(x - top) for x in logits]
        p = [x / sum(p) for x in p]
        for f, v in feats.items():
            for c in range(classes):
                g = v * (p[c] - (c == y))
                old = n.get((f, c), 0.0)
                z[f, c] = z.get((f, c), 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / li.ALPHA * w[f, c]
                n[f, c] = old + g * g
    return weight


def test_model_equals_a_plain_version(spark):
    """Features, document frequencies, training, calibration and scores against
    the definitions, on texts that all fall into the sample."""
    rng = random.Random(8)
    alphabet = {"aa": "abcde", "bb": "defgh", "cc": "ghijéß"}
    rows = [(k, " ".join("".join(rng.choice(alphabet[lang]) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 8))) + "! 12", lang)
            for k, lang in enumerate(["aa", "bb", "cc"] * 14)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = li.train(df)
    counted, langs, idf = plain_model([(t, lang) for _, t, lang in rows])
    assert model.languages == langs and model.temperature == 1.0  # under 50 texts: no calibration rows
    # the sample's order: by hash of the text
    hashed = {r["text"]: r["h"] for r in df.selectExpr("text", "hex(xxhash64('sample', text)) AS h").collect()}
    order = sorted(range(len(rows)), key=lambda k: (hashed[rows[k][1]], rows[k][2]))
    examples = []
    for k in order:
        f, lang = counted[k]
        n = sum(f.values())
        examples.append(({x: li.SCALE * c / n * idf(x) for x, c in f.items()}, langs.index(lang)))
    rounds = np.random.default_rng(7)
    steps = [int(e) for _ in range(li.EPOCHS) for e in rounds.permutation(len(examples))]
    weight = plain_ftrl(examples, len(langs), steps)
    seen = {f for e, _ in examples for f in e}
    for f in seen:
        for c in range(len(langs)):
            assert model.weights[f, c] == pytest.approx(weight((f, c)) * idf(f) * li.SCALE, rel=1e-4, abs=1e-5)
    assert model.bias == pytest.approx([weight((li.DIM, c)) for c in range(len(langs))], abs=1e-6)
    assert not model.weights[[f for f in range(li.DIM) if f not in seen]].any()
    for r in li.predict(df, model).collect():
        f, _ = counted[r["doc_id"]]
        n = sum(f.values())
        logits = [sum(c * weight((x, k)) * idf(x) * li.SCALE for x, c in f.items()) / n + weight((li.DIM, k)) for k in range(len(langs))]
        p = li._softmax(np.array(logits))
        assert r["lang_pred"] == langs[int(p.argmax())] and r["score"] == pytest.approx(p.max(), abs=1e-4)


def test_many_labels(spark):
    """More labels than are learned: the most frequent ones, no error."""
    rows = [(k, f"text number {k} of label", f"l{k % 1100:04d}") for k in range(1100 + 300)]  # labels 0 to 299 have two rows
    model = li.train(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4))
    assert model.languages == [f"l{k:04d}" for k in range(li.MAX_LANGUAGES)]
    few = li.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_languages=3)
    assert few.languages == ["l0000", "l0001", "l0002"]


@pytest.mark.parametrize("hot", [7, None])
def test_sample_is_bounded_with_a_hot_id(spark, monkeypatch, hot):
    """A third of the rows under one id (or none) and many of one text: the
    sample keeps its bound, and a language that only that id has is learned."""
    rows = [(k, f"some words of document {k} here", "en") for k in range(3000)]
    rows += [(hot, f"andere wörter von {k} dort" if k % 2 else "immer der gleiche text", "de") for k in range(3000)]
    sizes, real = [], li.sparse_counts
    monkeypatch.setattr(li, "sparse_counts", lambda docs, bits: sizes.append(docs.count()) or real(docs, bits))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = li.train(df, sample_rows=400)
    assert 200 <= sizes[0] <= 800
    got = li.predict(df.where("text <> 'immer der gleiche text'"), model).groupBy("lang_pred").count().collect()
    assert {r["lang_pred"]: r["count"] for r in got} == {"en": 3000, "de": 1500}
