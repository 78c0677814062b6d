"""Quality rules by tokeniser fertility.

Method.  A public sentencepiece vocabulary with byte fallback is run over the
words of every whole text.  Per document: characters per token, the share of
byte-fallback tokens, the entropy of its tokens, and their surprisal: the mean
number of bits of its tokens under the corpus, where a token weighs as many
documents of the same group as hold it (the document itself left out).  A group
is a language label (the ``MAX_LANGUAGES`` most frequent ones) or, without one,
the main script.  Two bands decide: fixed ones of the main script, and, fitted
to the corpus, the group's median surprisal and ``SURPRISAL_BITS`` more: prose
reuses its language's tokens, strings of random letters and shouted or symbol
text do not.  The first pass stores figures and token counts, so texts are
tokenised once.  Words of a batch are dictionary-encoded, and each distinct word
is tokenised once (pieces never cross white space).

Base figures (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and
``base_failed`` follow fixed definitions; ``kept`` is false for a failed base
and otherwise the bands' verdict.

Defined results: a null or empty text has no words, fails the base and has
null fertility figures; a text without letters is judged by the bands of
``other``; ties between scripts go to the one first in ``SCRIPTS``; an empty
table gives an empty result; extra columns are ignored, whatever their names;
repeated rows are judged alike.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinline.llm.common import chunks, cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SYMBOLS = "[#*$%&|<>]"
NON_SPACE = r"[^\x20\x09-\x0D]"
WINDOW = 5
CHUNK_BYTES = 1 << 22
CACHE_BYTES = 48 << 20
ENTRY_BYTES = 260  # what Python adds to a cached word
ENTROPY_CAP = 6.0  # bits; long texts reuse tokens by nature
MAX_LANGUAGES = 50     # labels with statistics of their own: bounds the table of token weights
SURPRISAL_BITS = 3.0   # over the median of the group
MEDIAN_STEPS = 256     # a median is exact to 1 / MEDIAN_STEPS bit

# Main Unicode ranges of each script (first, last code point).
SCRIPTS: dict[str, tuple[tuple[int, int], ...]] = {
    "latin": ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)),
    "cyrillic": ((0x400, 0x52F),),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F)),
    "hebrew": ((0x590, 0x5FF),),
    "devanagari": ((0x900, 0x97F),),
    "thai": ((0xE00, 0xE7F),),
    "hangul": ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)),
}


@dataclass(frozen=True)
class Band:
    """A document is rejected outside these."""
    min_chars_per_token: float
    max_chars_per_token: float
    max_fallback_share: float
    min_relative_entropy: float  # of log2(tokens), counted up to ENTROPY_CAP bits


# Rejection bands.  Latin prose takes 2 to 5 characters a token of a 32,000
# entry vocabulary; below 1.2 it is mostly single characters or raw bytes.
# Scripts that the vocabulary covers badly fall back to bytes by nature.
DEFAULT_BANDS: dict[str, Band] = {
    "latin": Band(1.2, 12.0, 0.20, 0.65),
    "cyrillic": Band(1.0, 12.0, 0.20, 0.65),
    "greek": Band(0.6, 12.0, 0.60, 0.65),
    "arabic": Band(0.5, 12.0, 0.70, 0.65),
    "hebrew": Band(0.5, 12.0, 0.70, 0.65),
    "devanagari": Band(0.4, 12.0, 0.90, 0.65),
    "thai": Band(0.4, 12.0, 0.90, 0.65),
    "hangul": Band(0.3, 12.0, 0.95, 0.65),
    "kana": Band(0.4, 12.0, 0.90, 0.65),
    "han": Band(0.3, 12.0, 0.95, 0.65),
    "other": Band(0.3, 12.0, 0.95, 0.65),
}


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments; ``ends`` starts with 0."""
    run = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return run[ends[1:]] - run[ends[:-1]]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and where each text's words end (from 0)."""
    parts = pc.ascii_split_whitespace(texts)
    flat, sizes = parts.flatten(), np.asarray(pc.list_value_length(parts), dtype=np.int64)
    real = np.asarray(pc.not_equal(flat, ""))
    ends = np.concatenate([[0], np.cumsum(_sums(real, np.concatenate([[0], np.cumsum(sizes)])))])
    return flat.filter(pa.array(real)), ends


def repeated_words(codes: np.ndarray, doc: np.ndarray, n_docs: int, n_codes: int) -> np.ndarray:
    """Words inside windows of ``WINDOW`` words that a text has twice or more."""
    n = len(codes) - WINDOW + 1
    if n < 2:
        return np.zeros(n_docs, np.int64)
    inside = doc[:n] == doc[WINDOW - 1:]
    h = doc[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(WINDOW):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + codes[j:n + j].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    at = np.nonzero(inside)[0]
    order = at[np.argsort(h[at], kind="stable")]
    same = h[order[1:]] == h[order[:-1]]
    a, b = order[:-1][same], order[1:][same]
    equal = doc[a] == doc[b]
    for j in range(WINDOW):
        equal &= codes[a + j] == codes[b + j]
    if not equal.all():  # two windows of one hash: group by exact ranks instead
        rank = codes[:n].astype(np.int64)
        for j in range(1, WINDOW):
            rank = np.unique(rank * n_codes + codes[j:n + j], return_inverse=True)[1]
        _, inv, cnt = np.unique(doc[at].astype(np.int64) * (n + 1) + rank[at], return_inverse=True, return_counts=True)
        hit = at[cnt[inv] > 1]
    else:
        hit = np.concatenate([a, b])
    mark = np.zeros(len(codes) + 1, np.int64)
    flags = np.zeros(n, bool)
    flags[hit] = True
    w = np.nonzero(flags)[0]
    np.add.at(mark, w, 1)
    np.add.at(mark, w + WINDOW, -1)
    covered = np.cumsum(mark[:-1]) > 0
    return np.bincount(doc[covered], minlength=n_docs)


def duplicate_lines(texts: pa.Array) -> np.ndarray:
    """Lines with a word that are equal to an earlier line of their text."""
    lines = pc.split_pattern(texts, "\n")
    doc = np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(lines)))
    flat = lines.flatten()
    with_word = np.asarray(pc.match_substring_regex(flat, NON_SPACE))
    codes = np.asarray(flat.dictionary_encode().indices).astype(np.int64)
    key = doc[with_word] * (len(flat) + 1) + codes[with_word]
    first = np.unique(key, return_index=True)[1]
    d = doc[with_word]
    return np.bincount(d, minlength=len(texts)) - np.bincount(d[first], minlength=len(texts))


def script_of(word: str) -> int:
    """Number of the script of the word's first letter; -1 without a letter."""
    for ch in word:
        if ch.isalpha():
            cp = ord(ch)
            for i, ranges in enumerate(SCRIPTS.values()):
                if any(a <= cp <= b for a, b in ranges):
                    return i
            return len(SCRIPTS)
    return -1


def quality_rules(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  bands: dict[str, Band] | None = None, min_words: int = 10, max_repeat_percent: int = 20,
                  surprisal_bits: float = SURPRISAL_BITS) -> DataFrame:
    """One row per document: the base figures, the fertility figures, ``script``,
    ``base_failed`` and ``kept``.  ``model_path`` is read once, on the driver.
    A missing ``lang_col`` counts as null."""
    label = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    per_label = docs.select(label.alias("_lang")).where("_lang is not null").groupBy("_lang").count().orderBy(F.col("count").desc(), "_lang")
    groups = [*SCRIPTS, "other", *(r["_lang"] for r in per_label.limit(MAX_LANGUAGES).collect())]
    stored = cut(_figures(docs.withColumn("_lang_label", label), model_path, id_col, text_col, "_lang_label", groups, bands or DEFAULT_BANDS,
                          min_words, max_repeat_percent))
    scored = cut(_with_surprisal(stored, len(groups)))
    limits = _medians(scored)
    limit = F.try_element_at(F.create_map(*[F.lit(x) for g, m in limits.items() for x in (g, m + surprisal_bits)]), F.col("_group")) if limits \
        else F.lit(None).cast("double")
    near = F.coalesce(F.col("token_surprisal") <= limit, F.lit(True))
    return scored.withColumn("kept", F.col("_inside") & near & ~F.col("base_failed")).drop("_group", "_inside").withColumnRenamed("_id", id_col)


def _with_surprisal(stored: DataFrame, n_groups: int) -> DataFrame:
    """The figures with ``token_surprisal``; the token counts are dropped."""
    good = stored.where(~F.col("base_failed") & (F.col("n_tokens") > 0)).select("_group", "_tokens")

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        n: dict[int, int] = {}
        for b in batches:
            for g, tokens in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.frombuffer(tokens.as_py(), "<u4")
                if g not in seen:
                    seen[g], n[g] = np.zeros(1 << 16, np.int64), 0
                if len(ids) and ids[-1] >= len(seen[g]):  # ids ascend
                    seen[g] = np.concatenate([seen[g], np.zeros(int(ids[-1]) + 1 - len(seen[g]), np.int64)])
                seen[g][ids] += 1
                n[g] += 1
        for g, per in seen.items():
            at = np.append(np.nonzero(per)[0], -1)  # -1: the documents
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), g, np.int32)), pa.array(at.astype(np.int32)),
                                              pa.array(np.append(per[at[:-1]], n[g]))], names=["g", "t", "n"])

    # at most groups times vocabulary rows
    table = good.mapInArrow(held, "g int, t int, n long").groupBy("g", "t").agg(F.sum("n").alias("n")).toArrow()
    g, t, n = (np.asarray(table[c]) for c in ("g", "t", "n"))
    docs_of = {int(x): int(y) for x, y in zip(g[t < 0], n[t < 0])}
    size = int(t.max(initial=0)) + 1
    weight = {k: np.zeros(size, np.int32) for k in docs_of}
    for k in docs_of:
        mine = (g == k) & (t >= 0)
        weight[k][t[mine]] = n[mine]
    shared = stored.sparkSession.sparkContext.broadcast((docs_of, weight))
    keep = [f for f in stored.schema.fields if f.name not in ("_tokens", "_counts")]
    names = [f.name for f in keep]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, per = shared.value
        for b in batches:
            out = np.full(b.num_rows, np.nan)
            for i, (k, tokens, counts, failed) in enumerate(zip(*(b.column(c).to_pylist() for c in ("_group", "_tokens", "_counts", "base_failed")))):
                if failed or not tokens or k not in total:
                    continue
                ids, c = np.frombuffer(tokens, "<u4"), np.frombuffer(counts, "<u4")
                out[i] = (c * -np.log2((per[k][ids] - 0.5) / total[k])).sum() / c.sum()  # the document itself left out
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(out, mask=np.isnan(out))], names=[*names, "token_surprisal"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keep)
    return stored.mapInArrow(measure, f"{schema}, token_surprisal double")


def _medians(scored: DataFrame) -> dict[int, float]:
    """Each group's (lower) median surprisal, rounded down to a step."""
    step = F.floor(F.col("token_surprisal") * MEDIAN_STEPS).alias("s")
    rows = scored.where(F.col("token_surprisal").isNotNull()).groupBy("_group", step).count().collect()  # bounded by groups and steps
    out: dict[int, float] = {}
    for g in {r["_group"] for r in rows}:
        mine = sorted((r["s"], r["count"]) for r in rows if r["_group"] == g)
        half, run = (sum(n for _, n in mine) + 1) // 2, 0
        for s, n in mine:
            run += n
            if run >= half:
                out[g] = s / MEDIAN_STEPS
                break
    return out


def _figures(docs: DataFrame, model_path: str, id_col: str, text_col: str, lang_col: str, groups: list[str], bands: dict[str, Band],
             min_words: int, max_repeat_percent: int) -> DataFrame:
    """Base and fertility figures, the fixed bands' verdict ``_inside``, the
    number of the group, and the distinct tokens with their counts."""
    with open(model_path, "rb") as f:
        proto = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(proto)  # one vocabulary file: fixed size
    names = [*SCRIPTS, "other"]
    table = [bands[s] for s in names]
    number = {g: len(names) + i for i, g in enumerate(groups[len(names):])}
    src = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"),
                      F.col(lang_col).alias("_lang"))
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens"]
    schema = (f"_id {src.schema['_id'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in longs)
              + ", chars_per_token double, fallback_share double, token_entropy double, script string, "
                "base_failed boolean, _inside boolean, _group int, _tokens binary, _counts binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        vocab = sp.get_piece_size()
        is_byte = np.fromiter((sp.is_byte(i) for i in range(vocab)), bool, vocab)
        cache: dict[str, tuple[np.ndarray, int]] = {}
        held = 0

        def pieces(words: list[str]) -> list[tuple[np.ndarray, int]]:
            nonlocal held
            new = [w for w in words if w not in cache]
            if held > CACHE_BYTES:
                cache.clear()
                held, new = 0, words
            fresh = {w: (np.array(ids, np.int32), script_of(w)) for w, ids in zip(new, sp.encode(new, num_threads=1))}
            out = [fresh.get(w) or cache[w] for w in words]
            cache.update(fresh)
            held += sum(len(w) + 4 * len(x[0]) + ENTRY_BYTES for w, x in fresh.items())
            return out

        for b in chunks(batches, "_text", CHUNK_BYTES):
            texts, n_docs = b.column("_text"), b.num_rows
            flat, ends = split_words(texts)
            n_words = np.diff(ends)
            enc = flat.dictionary_encode()
            words, codes = enc.dictionary, np.asarray(enc.indices).astype(np.int64)
            doc = np.repeat(np.arange(n_docs), n_words)
            chars = np.asarray(pc.utf8_length(words)).astype(np.int64)
            symbols = np.asarray(pc.count_substring_regex(words, SYMBOLS)).astype(np.int64)
            word_chars = _sums(chars[codes], ends)
            repeats = repeated_words(codes, doc, n_docs, max(1, len(words)))
            # fertility
            got = pieces(words.to_pylist())
            size = np.array([len(x[0]) for x in got], np.int64)
            ids = np.concatenate([x[0] for x in got]) if got else np.zeros(0, np.int32)
            begin = np.cumsum(size) - size
            script = np.array([x[1] for x in got], np.int64)
            per = size[codes]
            n_tokens = _sums(per, ends)
            at = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per) + np.repeat(begin[codes], per)
            tokens, token_doc = ids[at], np.repeat(doc, per)
            fallback = np.bincount(token_doc[is_byte[tokens]], minlength=n_docs)
            key, cnt = np.unique(token_doc.astype(np.int64) * vocab + tokens, return_counts=True)
            whole = np.maximum(n_tokens, 1)
            share = cnt / whole[key // vocab]
            entropy = np.bincount(key // vocab, weights=-share * np.log2(share), minlength=n_docs)
            # main script by characters
            letters = script[codes] >= 0
            by = np.bincount(doc[letters] * len(names) + script[codes][letters], weights=chars[codes][letters],
                             minlength=n_docs * len(names)).reshape(n_docs, len(names))
            main = np.where(by.sum(axis=1) > 0, by.argmax(axis=1), len(names) - 1)
            cpt, fb = word_chars / whole, fallback / whole
            band = [table[i] for i in main]
            reach = np.minimum(np.log2(whole), ENTROPY_CAP)
            inside = np.array([x.min_chars_per_token <= c <= x.max_chars_per_token and f <= x.max_fallback_share
                               and e >= x.min_relative_entropy * r for x, c, f, e, r in zip(band, cpt, fb, entropy, reach)], bool)
            first = np.searchsorted(key, np.arange(n_docs + 1) * vocab).tolist()
            ids_raw, cnt_raw = (key % vocab).astype("<u4").tobytes(), cnt.astype("<u4").tobytes()
            group = [number.get(x, int(m)) for x, m in zip(b.column("_lang").to_pylist(), main)]
            failed = (n_words < min_words) | (100 * repeats > max_repeat_percent * n_words)
            none = n_tokens == 0
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), *(pa.array(np.asarray(x, np.int64)) for x in (
                    n_words, word_chars, _sums(symbols[codes], ends), duplicate_lines(texts), repeats, n_tokens)),
                 *(pa.array(x, mask=none) for x in (cpt, fb, entropy)), pa.array([names[i] for i in main]),
                 pa.array(failed), pa.array(inside), pa.array(np.array(group, np.int32)),
                 *(pa.array([raw[4 * i:4 * j] for i, j in zip(first[:-1], first[1:])], pa.binary()) for raw in (ids_raw, cnt_raw))],
                names=["_id", *longs, "chars_per_token", "fallback_share", "token_entropy", "script", "base_failed", "_inside", "_group",
                       "_tokens", "_counts"])

    return src.mapInArrow(run, schema)


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return os.path.realpath(public_tokenizers.path(name))
