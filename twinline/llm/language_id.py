"""Language identification: sparse multinomial logistic regression on hashed
character n-grams with TF-IDF weights.

Method.  Texts are lower-cased; every run of other characters than letters
becomes one boundary.  Features are the 1- to 3-grams hashed to ``DIM``
buckets.  Document frequencies count every training row.  The classifier is
fitted with follow-the-regularised-leader (per-coordinate rates) under an
elastic net (L1 gives exact zeros) on about ``SAMPLE_ROWS`` labelled texts (or
``SAMPLE_EACH`` a language) and at most twice as many, taken evenly over the languages by a hash of the text (a
text counts once, however many rows or ids it has); a fifth of them is set aside
to fit the temperature that calibrates the scores.  Of more than
``MAX_LANGUAGES`` labels the most frequent ones are learned (ties: by code
point); rows with other labels count in no statistic.  Prediction
reads whole texts, a gather and a segmented sum per batch.

A feature's value is ``SCALE * count / n * idf``; it needs no per-document
norm, so a logit is a sum over positions.

Defined results: null texts and texts without a letter get ``und`` and score
0; rows with a null language train nothing; without any labelled row every
prediction is ``und``; an empty table gives an empty result; extra columns
are ignored, whatever their names; repeated rows are predicted alike.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinline.llm.common import chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIM_BITS = 16
DIM = 1 << DIM_BITS
ORDERS = (1, 2, 3)
SCALE = 10.0
SAMPLE_ROWS = 2_000      # expected texts of the fitting sample
SAMPLE_EACH = 50         # or so many a language, if that is more
MAX_LANGUAGES = 200      # labels learned: bounds the weight matrix (DIM x labels)
CALIBRATION_SHARE = 5    # one sampled row in five
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 0.01, 0.01, 4
CHUNK_BYTES = 1 << 19
UND = "und"
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def letter_bits() -> np.ndarray:
    """Packed bits: which code points are letters."""
    return np.packbits(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))


def char_features(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """For a list of texts: the text number of every kept position, the
    feature of each order at it (-1 where an n-gram leaves the text), and
    which texts have a letter."""
    low = [t.lower() for t in texts]
    lens = np.array([len(t) + 1 for t in low], np.int64)
    cps = np.frombuffer((" ".join(low) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(low), dtype=np.int32), lens)
    is_letter = letters[cps]
    has = np.zeros(len(low), bool)
    has[doc[is_letter]] = True
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]                 # a letter, or the first boundary after one
    c = np.where(is_letter, cps, 32)[keep].astype(np.uint64)
    doc = doc[keep]
    out, h = [], np.zeros(len(c), np.uint64)
    for n in ORDERS:
        if len(c) < n:
            out.append(np.full(len(c), -1, np.int32))
            continue
        m = len(c) - n + 1
        h = h[:m] * np.uint64(0x100000001B3) + (c[n - 1:] + np.uint64(n)) * _MIX[0]
        x = (h ^ (h >> np.uint64(29))) * _MIX[1]
        f = (x >> np.uint64(64 - DIM_BITS)).astype(np.int32)
        if n > 1:
            f[doc[:m] != doc[n - 1:]] = -1
        out.append(np.concatenate([f, np.full(n - 1, -1, np.int32)]))
    return doc, out, has


def _texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def _unpack(bits: np.ndarray) -> np.ndarray:
    return np.unpackbits(bits)[:0x110000].astype(bool)


def document_frequencies(docs: DataFrame, bits: np.ndarray) -> np.ndarray:
    """How many texts hold each feature, over all rows of ``docs`` (_text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, df = _unpack(bits), np.zeros(DIM, np.int64)
        seen = np.zeros(DIM, bool)
        for b in chunks(batches, "_text", CHUNK_BYTES):
            doc, feats, _ = char_features(_texts(b, "_text"), letters)
            starts = np.searchsorted(doc, np.arange(b.num_rows + 1))
            for i, j in zip(starts[:-1], starts[1:]):
                for f in feats:
                    seen[f[i:j][f[i:j] >= 0]] = True
                df += seen
                seen[:] = False
        at = np.nonzero(df)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], names=["f", "n"])

    rows = docs.mapInArrow(run, "f int, n long").groupBy("f").agg(F.sum("n").alias("n")).collect()  # at most DIM rows
    df = np.zeros(DIM, np.int64)
    for r in rows:
        df[r["f"]] = r["n"]
    return df


def sparse_counts(docs: DataFrame, bits: np.ndarray) -> list:
    """(_id, _lang, features, counts) of a bounded sample, on the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _unpack(bits)
        for b in chunks(batches, "_text", CHUNK_BYTES):
            doc, feats, _ = char_features(_texts(b, "_text"), letters)
            starts = np.searchsorted(doc, np.arange(b.num_rows + 1))
            idx, cnt = [], []
            for i, j in zip(starts[:-1], starts[1:]):
                all_f = np.concatenate([f[i:j][f[i:j] >= 0] for f in feats])
                u, n = np.unique(all_f, return_counts=True)
                idx.append(u.astype("<u2").tobytes())
                cnt.append(n.astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_lang"), pa.array(idx, pa.binary()),
                                              pa.array(cnt, pa.binary())], names=["_id", "_lang", "idx", "cnt"])

    return docs.mapInArrow(run, "_id string, _lang string, idx binary, cnt binary").collect()


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray      # DIM x languages, idf and scale folded in
    bias: np.ndarray
    temperature: float
    zeros: float             # share of exact zeros


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], classes: int, seed: int = 7, epochs: int = EPOCHS,
         alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> tuple[np.ndarray, np.ndarray]:
    """Weights (DIM + 1 rows; the last is the bias) from (indices, values, class)."""
    z, n = np.zeros((DIM + 1, classes)), np.zeros((DIM + 1, classes))

    def weight(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            idx, val, y = examples[k]
            idx, val = np.append(idx, DIM), np.append(val, 1.0)
            zi, ni = z[idx], n[idx]
            w = weight(zi, ni)
            p = _softmax(val @ w)
            p[y] -= 1.0
            g = val[:, None] * p[None, :]
            g2 = g * g
            z[idx] = zi + g - (np.sqrt(ni + g2) - np.sqrt(ni)) / alpha * w
            n[idx] = ni + g2
    return weight(z, n)[:DIM], weight(z, n)[DIM]


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """Golden-section search of the log temperature that minimises log loss."""
    if len(y) == 0:
        return 1.0

    def loss(t: float) -> float:
        p = _softmax(logits / np.exp(t))
        return float(-np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).mean())

    lo, hi, ratio = np.log(0.05), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_rows: int = SAMPLE_ROWS, max_languages: int = MAX_LANGUAGES) -> Model:
    """Fit on the labelled rows of ``docs``; only text and label are read."""
    bits = letter_bits()
    labelled = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("_lang"), F.col(text_col).cast("string").alias("_text"))
    per_label = labelled.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "_lang")
    counts = {r["_lang"]: r["n"] for r in per_label.limit(max_languages).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((DIM, 0)), np.zeros(0), 1.0, 1.0)
    each = max(sample_rows / len(languages), SAMPLE_EACH)
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, each / n))])
    labelled = labelled.withColumn("_share", F.try_element_at(share, F.col("_lang"))).where(F.col("_share").isNotNull())
    total = sum(counts.values())
    idf = np.log((1 + total) / (1 + document_frequencies(labelled.select("_text"), bits))) + 1
    hashed = F.xxhash64(F.lit("sample"), F.col("_text"))
    draw = F.pmod(hashed, F.lit(1 << 30)) / float(1 << 30)
    drawn = labelled.withColumn("_hash", hashed).where(draw < F.col("_share")).groupBy("_lang", "_hash").agg(F.min("_text").alias("_text"))
    few = Window.partitionBy("_lang").orderBy("_hash")
    drawn = drawn.withColumn("_nth", F.row_number().over(few)).where(F.col("_nth") <= max(1, math.ceil(2 * each)))
    rows = sorted(sparse_counts(drawn.select(F.hex("_hash").alias("_id"), "_lang", "_text"), bits),
                  key=lambda r: (r["_id"], r["_lang"], r["idx"], r["cnt"]))
    examples = []
    for r in rows:
        idx, cnt = np.frombuffer(r["idx"], "<u2").astype(np.int64), np.frombuffer(r["cnt"], "<f4").astype(np.float64)
        if len(idx):
            examples.append((idx, SCALE * cnt / cnt.sum() * idf[idx], languages.index(r["_lang"])))
    held = [e for i, e in enumerate(examples) if i % CALIBRATION_SHARE == 0] if len(examples) >= 50 else []
    fit = [e for i, e in enumerate(examples) if i % CALIBRATION_SHARE] if held else examples
    w, b = ftrl(fit, len(languages))
    logits = np.array([v @ w[i] + b for i, v, _ in held]).reshape(len(held), len(languages))
    t = fit_temperature(logits, np.array([y for *_, y in held], np.int64))
    return Model(languages, (w * idf[:, None] * SCALE).astype(np.float32), b, t, float((w == 0).mean()))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``lang_pred``, ``score``) of every row; only the text is an input."""
    bits = letter_bits()
    spark = docs.sparkSession
    k = len(model.languages)
    # DIM x languages floats: bounded by parameters
    shared = spark.sparkContext.broadcast((bits, model.languages, model.weights, model.bias, model.temperature))
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    id_type = src.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits_, languages, weights, bias, temperature = shared.value
        letters = _unpack(bits_)
        for b in chunks(batches, "_text", max(1 << 14, CHUNK_BYTES // max(1, k // 8))):
            doc, feats, has = char_features(_texts(b, "_text"), letters)
            best, score = np.full(b.num_rows, -1), np.zeros(b.num_rows)
            if k and len(doc):
                used = np.unique(doc)
                starts = np.searchsorted(doc, used)
                sums, n = np.zeros((len(used), k)), np.zeros(len(used))
                for f in feats:
                    ok = f >= 0
                    g = weights[np.where(ok, f, 0)]
                    if not ok.all():
                        g[~ok] = 0
                    sums += np.add.reduceat(g, starts, axis=0, dtype=np.float64)
                    n += np.add.reduceat(ok, starts, dtype=np.int64)
                p = _softmax((sums / np.maximum(n, 1)[:, None] + bias) / temperature)
                best[used], score[used] = p.argmax(axis=1), p.max(axis=1)
            best[~has], score[~has] = -1, 0.0
            names = np.array([*languages, UND], object)
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(names[best], pa.string()), pa.array(score)],
                                             names=["_id", "lang_pred", "score"])

    return src.mapInArrow(run, f"_id {id_type}, lang_pred string, score double").withColumnRenamed("_id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept out of training: crc32 of the id as text leaves 1 modulo 3."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def keep_known(docs: DataFrame, model: Model, text_col: str = "text", min_score: float = 0.3) -> DataFrame:
    """``docs`` without the rows whose language cannot be told: ``und``, or a
    calibrated score below ``min_score``.  Whole rows travel, so ids need not
    be unique."""
    row = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text_col).alias("_body"))
    told = predict(row, model, "_row", "_body").where((F.col("lang_pred") != UND) & (F.col("score") >= min_score))
    return told.select("_row.*")
