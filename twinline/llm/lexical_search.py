"""Ranked lexical search, term at a time with limited accumulators.

Method.  Spark tokenises every document once: the terms that any query holds
become a compact posting row a document (term codes and counts), written to
the shared folder, and the corpus figures (documents, terms, documents of a
term) are summed over all rows.  Scoring works on blocks of documents inside
the tasks.  A block is inverted; each query takes its terms rarest first and
adds their contributions to accumulators, one a document.  Once the largest
possible sum of the remaining terms (from the block's own largest contribution
of each) is below the k-th partial score, no document without an accumulator
can enter the result: creation stops, and the survivors, those whose partial
score plus that sum still reaches the k-th, are updated exactly for the
remaining terms.  The k-th score of earlier blocks of the task counts as well.
A task reports its k best documents of a query, and Spark ranks them.

Queries are taken in blocks of about ``QUERY_TERMS`` distinct terms, so what is
broadcast is bounded whatever the number of queries.

The score is the contract's integer arithmetic: weight floor(1000 ln((2N+2) /
(2df+1))), m = 100 - 25 + (25 n N) div L, contribution weight * ((10^9 tf) div
(1000 tf + 12 m)).

Defined results: a null or empty text has no terms, so a null query has no
rows and a null document is in none; fewer than k documents with a score
above 0 give fewer rows; equal scores by ascending id, null ids last; repeated
documents are ranked each on its own, repeated queries answered each on its
own; empty tables give an empty result; extra columns are ignored, whatever
their names.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinline.llm.common import chunks, cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = 20
QUERY_TERMS = 100_000     # distinct (query, term) rows of a block of queries
PIECE_BYTES = 4 << 20     # text bytes tokenised at a time
BLOCK_POSTINGS = 2 << 20  # postings of a block of documents
NO_ID = (1 << 63) - 1     # stands for a null id in the order

#: bytes of a term: letters and digits of ASCII, and every byte of other characters
TERM_BYTE = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
LOWER_BYTE = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def terms(c: Column) -> Column:
    """The terms of a text, in order."""
    return F.regexp_extract_all(F.translate(F.coalesce(c.cast("string"), F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))


def token_runs(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Where the terms of joined texts begin, and the terms; no term crosses a
    text's start."""
    is_term = TERM_BYTE[text]
    new = np.empty(len(text), bool)
    if len(text):
        new[0] = True
        new[1:] = ~is_term[:-1]
        new[starts[starts < len(text)]] = True
    at = np.nonzero(is_term & new)[0]
    kept = LOWER_BYTE[text[is_term]]
    ends = np.append(np.cumsum(is_term, dtype=np.int64)[at] - 1, len(kept)).astype(np.int32)
    return at, pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(kept)])


def _pieces(raw: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``PIECE_BYTES`` that cut no term."""
    i = 0
    while i < len(raw):
        j = min(len(raw), i + PIECE_BYTES)
        nxt = int(np.searchsorted(starts, j))
        limit = int(starts[nxt]) if nxt < len(starts) else len(raw)
        while j < limit and TERM_BYTE[raw[j - 1]]:  # on to the end of the term, or of the text
            stop = np.nonzero(~TERM_BYTE[raw[j:min(limit, j + 4096)]])[0]
            j = j + int(stop[0]) if len(stop) else min(limit, j + 4096)
            if len(stop):
                break
        yield i, j
        i = j


def posting_rows(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """(_id, _n, _codes, _tfs): a document's number of terms, and the codes and
    counts of its terms that are in ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # bounded: QUERY_TERMS
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.binary())
        for b in chunks(batches, "_text", PIECE_BYTES):
            text = pc.fill_null(b.column("_text"), "")
            size = np.asarray(pc.binary_length(text), dtype=np.int64)
            starts = np.cumsum(size) - size
            wide = text.type == pa.large_string()
            offsets = np.frombuffer(text.buffers()[1], np.int64 if wide else np.int32)[text.offset:text.offset + len(text) + 1]
            raw = (np.frombuffer(text.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
                   if text.buffers()[2] is not None else np.empty(0, np.uint8))
            total, keys, counts = np.zeros(len(text), np.int64), [], []
            for i, j in _pieces(raw, starts):
                at, found = token_runs(raw[i:j], starts[(starts >= i) & (starts < j)] - i)
                row = np.searchsorted(starts, at + i, side="right") - 1
                total += np.bincount(row, minlength=len(text))
                code = pc.index_in(found, known)
                hit = np.asarray(pc.is_valid(code))
                key, n = np.unique(row[hit] * len(known) + np.asarray(pc.fill_null(code, 0), dtype=np.int64)[hit], return_counts=True)
                keys.append(key)
                counts.append(n)
            key = np.concatenate(keys) if keys else np.empty(0, np.int64)
            n = np.concatenate(counts) if counts else np.empty(0, np.int64)
            key, back = np.unique(key, return_inverse=True)
            n = np.bincount(back, weights=n, minlength=len(key)).astype(np.int64)
            ends = pa.array(np.searchsorted(key, np.arange(len(text) + 1) * len(known)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array(total), pa.ListArray.from_arrays(ends, pa.array((key % max(1, len(known))).astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(n))], names=["_id", "_n", "_codes", "_tfs"])

    return src.mapInArrow(run, "_id long, _n long, _codes array<int>, _tfs array<long>")


def length_factor(n: np.ndarray, docs: int, all_terms: int) -> np.ndarray:
    """m of documents with ``n`` terms (exact integers of any size)."""
    kinds, at = np.unique(n, return_inverse=True)
    return np.array([75 + 25 * int(x) * docs // all_terms for x in kinds], np.int64)[at]


#: a query: its number, and its terms' codes and weights (repeats included), rarest first
Query = tuple[int, np.ndarray, np.ndarray]


def search_block(query: Query, starts: np.ndarray, rows: np.ndarray, gain: np.ndarray, most: np.ndarray, n_docs: int,
                 k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of a block that may be among the query's k best.

    The postings of code c are rows[starts[c]:starts[c + 1]] (documents,
    ascending) with ``gain`` (contribution of weight 1); ``most`` is the
    largest gain of each code.  ``floor`` is a score that k documents are known
    to reach elsewhere: lower ones are not needed.
    """
    _, codes, weights = query
    at, end = starts[codes], starts[codes + 1]
    bound = weights * most[codes]
    rest = np.append(np.cumsum(bound[::-1])[::-1], 0)  # of terms j, j + 1, ...
    score = np.zeros(n_docs, np.int64)
    j, kth = 0, floor
    while j < len(at):
        # stop creating: what is left cannot bring a new document to the k-th partial score
        if rest[j] < kth:
            break
        if j and rest[j] * 2 <= rest[0]:  # the k-th partial score is worth looking up
            held = np.nonzero(score)[0]
            if len(held) >= k:
                kth = max(kth, int(np.partition(score[held], len(held) - k)[len(held) - k]))
                if rest[j] < kth:
                    break
        score[rows[at[j]:end[j]]] += weights[j] * gain[at[j]:end[j]]
        j += 1
    alive = np.nonzero(score)[0]
    for j in range(j, len(at)):
        if len(alive) >= k:
            kth = max(kth, int(np.partition(score[alive], len(alive) - k)[len(alive) - k]))
        alive = alive[score[alive] + rest[j] >= kth]
        if not len(alive):
            break
        mine = rows[at[j]:end[j]]
        if not len(mine):
            continue
        place = np.minimum(np.searchsorted(mine, alive), len(mine) - 1)
        hit = mine[place] == alive
        score[alive[hit]] += weights[j] * gain[at[j] + place[hit]]
    return alive, score[alive]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def best_of_task(batches: Iterator[pa.RecordBatch], queries: list[Query], n_codes: int, n_docs: int, all_terms: int,
                 k: int) -> Iterator[pa.RecordBatch]:
    """The k best documents of each query among a task's posting rows."""
    best = {q[0]: (np.empty(0, np.int64), np.empty(0, np.int64)) for q in queries}
    for b in batches:
        ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(b.column("_codes")), dtype=np.int64))])
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(ends, ends[i] + BLOCK_POSTINGS, side="right")) - 1)
            part = b.slice(i, j - i)
            ids = np.asarray(pc.fill_null(part.column("_id"), NO_ID))
            codes, tf = np.asarray(part.column("_codes").flatten()), np.asarray(part.column("_tfs").flatten())
            doc = np.repeat(np.arange(j - i), np.diff(ends[i:j + 1]))
            m = length_factor(np.asarray(part.column("_n")), n_docs, all_terms)[doc]
            gain = 1_000_000_000 * tf // (1000 * tf + 12 * m)
            order = np.argsort(codes, kind="stable")
            codes, rows, gain = codes[order], doc[order], gain[order]
            starts = np.searchsorted(codes, np.arange(n_codes + 1))
            most = np.zeros(n_codes, np.int64)
            np.maximum.at(most, codes, gain)
            for q in queries:
                had, scores = best[q[0]]
                floor = int(scores[-1]) if len(scores) == k else 1
                found, new = search_block(q, starts, rows, gain, most, j - i, k, floor)
                if len(found):
                    best[q[0]] = _best(np.concatenate([had, ids[found]]), np.concatenate([scores, new]), k)
            i = j
    for number, (ids, scores) in best.items():
        if len(ids):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), number, np.int64)), pa.array(ids), pa.array(scores)],
                                             names=["_q", "_id", "score"])


def top_k(scored: DataFrame, key: list[str], order: list[Column], k: int, rank: str) -> DataFrame:
    """The first k rows of each key; a key's rows are thinned in 64 parts first."""
    part = Window.partitionBy(*key, "_part").orderBy(*order)
    thin = scored.withColumn("_part", F.pmod(F.xxhash64(*scored.columns), F.lit(64))).withColumn(rank, F.row_number().over(part))
    thin = thin.where(F.col(rank) <= k).drop("_part", rank)
    return thin.withColumn(rank, F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col(rank) <= k)


def search(docs: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           query_id_col: str = "item_id", query_text_col: str = "text", query_terms: int = QUERY_TERMS) -> DataFrame:
    """One row per query and rank: the query's id, ``rank``, the document's id, ``score``."""
    spark = docs.sparkSession
    asked = cut(queries.select(F.monotonically_increasing_id().alias("_q"), F.col(query_id_col).alias("_qid"),
                               F.col(query_text_col).alias("_text")))
    held = cut(asked.select("_q", F.explode(terms(F.col("_text"))).alias("term")).groupBy("_q", "term").agg(
        F.count(F.lit(1)).alias("repeats")))
    n = held.count()
    blocks = -(-n // query_terms)
    out = None
    for i in range(blocks):
        mine = held if blocks == 1 else held.where(F.pmod(F.xxhash64("_q"), F.lit(blocks)) == i)
        rows = mine.collect()  # a block of queries: about QUERY_TERMS rows
        vocabulary = sorted({r["term"] for r in rows})
        code = {t: c for c, t in enumerate(vocabulary)}
        postings = cut(posting_rows(docs, [t.encode("utf-8") for t in vocabulary], id_col, text_col))
        whole = postings.where("_n > 0").agg(F.count(F.lit(1)).alias("n"), F.sum("_n").alias("l")).first()
        if not whole["n"]:
            break
        n_docs, all_terms = whole["n"], whole["l"]
        df = {r[0]: r[1] for r in postings.select(F.explode("_codes").alias("c")).groupBy("c").count().collect()}  # a row a term
        per: dict[int, list[tuple[int, int, int]]] = {}
        for r in rows:
            c = code[r["term"]]
            w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(c, 0) + 1)))
            if df.get(c) and w > 0:
                per.setdefault(r["_q"], []).append((df[c], c, w * r["repeats"]))
        plans = [(q, *np.array(sorted(ts), np.int64).T[1:]) for q, ts in sorted(per.items())]
        shared = spark.sparkContext.broadcast(plans)
        size = len(vocabulary)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, size=size, n_docs=n_docs, all_terms=all_terms) -> Iterator[pa.RecordBatch]:
            return best_of_task(batches, shared.value, size, n_docs, all_terms, k)

        scored = postings.where("_n > 0").mapInArrow(run, "_q long, _id long, score long")
        ranked = top_k(scored, ["_q"], [F.col("score").desc(), F.col("_id")], k, "rank")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        out = spark.createDataFrame([], "_q long, _id long, score long, rank int")
    return out.join(asked.select("_q", "_qid"), "_q").select(
        F.col("_qid").alias(query_id_col), F.col("rank").cast("int").alias("rank"),
        F.when(F.col("_id") != NO_ID, F.col("_id")).alias(id_col), "score")
