"""Learning a WordPiece vocabulary from distributed counts (A5, C2 core).

The trainer merges the most frequent adjacent symbol pair, weighted by word
frequency, until the vocabulary reaches the requested size or no pair is
left.  Vocabulary order: specials, characters by code point, continuation
(``##``) characters by code point, then merged tokens in merge order; a
merge whose token already exists adds no id.  Ties between equally frequent
pairs go to the smaller (left id, right id).

Spark shape: pair counts as a maintained view
---------------------------------------------
* ``words(n, syms)``: one row per distinct word, its symbol ids, built once
  from the distributed word count; words of one symbol are dropped because
  they can no longer form pairs.
* ``pairs(left_id, right_id, count)``: counted once, then kept up to date.
* A round plans as many merges as can be known exactly, applies them to the
  words that hold them, and adds the signed changes of those words' pairs to
  ``pairs``.  Words without a chosen pair are scanned but never moved, counted
  again or handed to per-word code; only pairs of touched words are shuffled.
* Both tables are checkpointed every round (to the session's checkpoint
  folder): lineage stays short and a lost executor recomputes one round.

Planning a round (exact)
------------------------
Take the K first pairs by rank.  Cut every word into its longest runs of
symbols whose neighbours all are among these K, and count equal runs: a table
that is far smaller than the words, because runs are short and repeat.  K is
lowered until it has at most ``PLAN_RUNS`` rows (one pair always fits), so what
the driver gets is bounded by two parameters, whatever the corpus.

Merging these runs in rank order gives the merges of the whole table, as long
as the next pair ranks no lower than the K-th pair did:

* every occurrence of one of the K pairs lies inside a run, so their counts
  are complete;
* a new pair (x, ab) comes from neighbours x, a, so it is no more frequent than
  (x, a), and on a tie it ranks after it because ab has the larger id; if it
  ranks within the cut then so did (x, a), and all its occurrences lie inside
  runs too;
* a merge whose token exists already (two ways to one token) could add to a
  pair that is only partly inside the runs, so it ends its round.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import CONTINUATION_PREFIX, SPECIAL_TOKENS, TARGET_VOCAB_SIZE
from ..session import ensure_checkpoint_dir
from . import counts as cnt

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PLAN_PAIRS = 1 << 14   # pairs a round looks at
PLAN_RUNS = 1 << 14    # distinct runs a round may plan with

Pair = tuple[int, int]


@dataclass
class TrainResult:
    vocab: DataFrame          # token string, id int
    merges: DataFrame         # rank int, left_id int, right_id int, new_id int, count long
    rounds: int
    tokens: list[str] = field(repr=False, default_factory=list)
    plans: list[dict] = field(repr=False, default_factory=list)  # a round's pairs, runs and merges


def _neighbours(syms: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Flat symbols, where rows end (from 0), the code of each symbol and its
    right neighbour, and whether both are of one row."""
    flat = np.asarray(syms.flatten()).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(syms), dtype=np.int64))])
    code = (flat[:-1] << 32) | flat[1:]
    inside = np.ones(len(code), bool)
    last = ends[1:-1]
    inside[last[(last > 0) & (last < len(flat))] - 1] = False
    return flat, ends, code, inside


def _codes(pairs: list[Pair]) -> np.ndarray:
    return np.sort(np.array([(a << 32) | b for a, b in pairs], np.int64))


def _among(code: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    return chosen[np.minimum(np.searchsorted(chosen, code), len(chosen) - 1)] == code


def runs_of(words: DataFrame, pairs: list[Pair]) -> DataFrame:
    """(run, n): the longest runs whose neighbours all are among ``pairs``,
    counted over all words."""
    chosen = _codes(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            flat, ends, code, inside = _neighbours(b.column(1))
            hit = np.concatenate([[False], _among(code, chosen) & inside, [False]])
            first = np.nonzero(hit[1:] & ~hit[:-1])[0]     # a run's first symbol
            size = np.nonzero(hit[:-1] & ~hit[1:])[0] - first + 1
            if not len(first):
                continue
            stop = np.cumsum(size)
            at = np.arange(stop[-1]) + np.repeat(first - (stop - size), size)
            weight = np.asarray(b.column(0))[np.searchsorted(ends, first, side="right") - 1]
            runs = pa.ListArray.from_arrays(pa.array(np.append(0, stop).astype(np.int32)), pa.array(flat[at].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([runs, pa.array(weight)], names=["run", "n"])

    return words.select("n", "syms").mapInArrow(run, "run array<int>, n long").groupBy("run").agg(F.sum("n").alias("n"))


def joined_token(left: str, right: str, prefix: str) -> str:
    return left + (right[len(prefix):] if right.startswith(prefix) else right)


def _merged(syms: list[int], pair: Pair, new: int) -> list[int]:
    """One merge, left to right."""
    out: list[int] = []
    for s in syms:
        if out and s == pair[1] and out[-1] == pair[0]:
            out[-1] = new  # never ``pair[0]``: the joined token is longer
        else:
            out.append(s)
    return out


def plan_merges(runs: list[list[int]], weight: list[int], cut: tuple[int, int, int], tokens: list[str], ids: dict[str, int],
                vocab_size: int, prefix: str) -> list[tuple[int, int, int, int]]:
    """(left, right, new id, count) of the merges down to the rank ``cut``
    (-count, left, right); ``tokens`` and ``ids`` grow."""
    runs = list(runs)
    total: dict[Pair, int] = {}
    where: dict[Pair, set[int]] = {}
    for k, syms in enumerate(runs):
        for p in zip(syms, syms[1:]):
            total[p] = total.get(p, 0) + weight[k]
            where.setdefault(p, set()).add(k)
    heap = [(-n, a, b) for (a, b), n in total.items()]
    heapq.heapify(heap)
    out: list[tuple[int, int, int, int]] = []
    while heap and len(tokens) < vocab_size:
        rank = heapq.heappop(heap)
        n, a, b = rank
        if total.get((a, b)) != -n:
            continue  # an older count of this pair
        if rank > cut:
            break
        joined = joined_token(tokens[a], tokens[b], prefix)
        new = ids.get(joined)
        known = new is not None
        if not known:
            new = ids[joined] = len(tokens)
            tokens.append(joined)
        out.append((a, b, new, -n))
        if known:
            break
        changed: set[Pair] = set()
        for k in where.pop((a, b)):
            old = runs[k]
            syms = runs[k] = _merged(old, (a, b), new)
            for p in zip(old, old[1:]):
                total[p] -= weight[k]
                changed.add(p)
                if p in where:
                    where[p].discard(k)
            for p in zip(syms, syms[1:]):
                total[p] = total.get(p, 0) + weight[k]
                changed.add(p)
                where.setdefault(p, set()).add(k)
        for p in changed:
            if total[p]:
                if (-total[p], *p) <= cut:
                    heapq.heappush(heap, (-total[p], *p))
            else:
                del total[p]
                where.pop(p, None)
    return out


def apply_merges(words: DataFrame, merges: list[tuple[int, int, int, int]]) -> DataFrame:
    """(n, syms, before): the words after the merges, in their order;
    ``before`` holds the former symbols of a touched word, else null."""
    chosen = _codes([(a, b) for a, b, _, _ in merges])
    order = {(a, b): k for k, (a, b, _, _) in enumerate(merges)}  # a pair is merged once a round

    def rewrite(syms: list[int]) -> list[int]:
        k = -1
        while True:
            k = min((at for p in zip(syms, syms[1:]) if (at := order.get(p, -1)) > k), default=None)
            if k is None:
                return syms
            a, b, new, _ = merges[k]
            syms = _merged(syms, (a, b), new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            syms = b.column(1)
            flat, ends, code, inside = _neighbours(syms)
            touched = np.zeros(b.num_rows, bool)
            touched[np.searchsorted(ends, np.nonzero(_among(code, chosen) & inside)[0], side="right") - 1] = True
            mask = pa.array(touched)
            old = syms.filter(mask)
            new = pa.array([rewrite(s) for s in old.to_pylist()], pa.list_(pa.int32()))
            # untouched rows first, then the touched ones: the order of rows is free
            rest = pc.invert(mask)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(rest), syms.filter(rest).cast(pa.list_(pa.int32())),
                                              pa.nulls(b.num_rows - len(old), pa.list_(pa.int32()))], names=["n", "syms", "before"])
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), new, old.cast(pa.list_(pa.int32()))], names=["n", "syms", "before"])

    return words.select("n", "syms").mapInArrow(run, "n long, syms array<int>, before array<int>")


def pair_deltas(words: DataFrame) -> DataFrame:
    """(left_id, right_id, count): signed changes of the pair counts, from the
    touched words alone."""
    touched = words.where(F.col("before").isNotNull())
    gone = cnt.pair_rows(touched.select((-F.col("n")).alias("n"), F.col("before").alias("syms")))
    come = cnt.pair_rows(touched.select("n", "syms"))
    return gone.unionByName(come).groupBy("left_id", "right_id").agg(F.sum("n").alias("count")).where("count <> 0")


def train_wordpiece(texts: DataFrame, text_col: str = "text", vocab_size: int = TARGET_VOCAB_SIZE,
                    plan_pairs: int = PLAN_PAIRS, plan_runs: int = PLAN_RUNS, prefix: str = CONTINUATION_PREFIX,
                    max_rounds: int | None = None) -> TrainResult:
    """A5: learn a vocabulary of at most ``vocab_size`` tokens (the alphabet
    is always kept whole, so the result can be larger when V is tiny)."""
    spark = texts.sparkSession
    ensure_checkpoint_dir(spark)
    wc = cnt.word_counts(texts, text_col).checkpoint(eager=True)
    base = cnt.initial_vocab(wc, prefix)
    tokens = [r["token"] for r in base.orderBy("id").collect()]  # alphabet-sized
    assert tokens[: len(SPECIAL_TOKENS)] == list(SPECIAL_TOKENS)
    # dealt over the cluster once: a small aggregate can come back as one partition
    words = cnt.word_types(wc, base, prefix).where(F.size("syms") >= 2)
    words = words.repartition(max(1, spark.sparkContext.defaultParallelism), "word").select("n", "syms").checkpoint(eager=True)
    merges, plans = _merge_in_rounds(words, tokens, vocab_size, plan_pairs, plan_runs, prefix, max_rounds)
    vocab = cnt.arrow_rows(spark, [tokens, range(len(tokens))], "token string, id int")
    merges_df = cnt.arrow_rows(spark, [range(len(merges)), *([m[i] for m in merges] for i in range(4))],
                               "rank int, left_id int, right_id int, new_id int, count long")
    return TrainResult(vocab=vocab, merges=merges_df, rounds=len(plans), tokens=tokens, plans=plans)


def _merge_in_rounds(words: DataFrame, tokens: list[str], vocab_size: int, plan_pairs: int, plan_runs: int, prefix: str,
                     max_rounds: int | None) -> tuple[list[tuple[int, int, int, int]], list[dict]]:
    """The rounds; ``tokens`` grows."""
    ids = {t: i for i, t in enumerate(tokens)}
    pairs = cnt.pair_counts(words).checkpoint(eager=True)
    merges: list[tuple[int, int, int, int]] = []
    plans: list[dict] = []
    k = plan_pairs
    while len(tokens) < vocab_size and (max_rounds is None or len(plans) < max_rounds):
        ranked = [(int(r["left_id"]), int(r["right_id"]), int(r["count"])) for r in cnt.best_pairs(pairs, plan_pairs).collect()]
        if not ranked:
            break
        k = min(k, len(ranked))
        while True:
            top = ranked[:k]
            got = runs_of(words, [(a, b) for a, b, _ in top]).limit(plan_runs + 1).collect()
            if len(got) <= plan_runs or k == 1:
                break
            k = max(1, min(k // 2, k * plan_runs // (2 * len(got))))
        a, b, n = top[-1]
        planned = plan_merges([list(r["run"]) for r in got], [int(r["n"]) for r in got], (-n, a, b), tokens, ids, vocab_size, prefix)
        plans.append({"pairs": k, "runs": len(got), "merges": len(planned)})
        merges += planned
        if len(got) < plan_runs // 2:
            k = min(plan_pairs, 2 * k)
        if len(tokens) >= vocab_size:
            break
        after = apply_merges(words, planned).checkpoint(eager=True)
        pairs = (pairs.unionByName(pair_deltas(after)).groupBy("left_id", "right_id").agg(F.sum("count").alias("count"))
                 .where("count > 0").checkpoint(eager=True))
        words = after.where(F.size("syms") >= 2).select("n", "syms")
    return merges, plans
