"""WordPiece encoding (X5, X6, X8, X9, X10, T4) as Column functions.

Pre-tokenisation and every array step run natively; only the greedy
longest-match split of each *distinct* word runs in Python, inside an Arrow
UDF that works on whole column batches.  The vocabulary is a small model
artefact (bounded by the vocabulary-size parameter, size-checked before it
is broadcast); word -> ids is memoised for the life of a task.
"""

from __future__ import annotations

import sys
import uuid
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (
    BOS,
    CONTINUATION_PREFIX,
    EOS,
    MAX_INPUT_CHARS_PER_WORD,
    MAX_LENGTH,
    MAX_VOCAB,
    PAD,
    SPECIAL_TOKENS,
    UNK,
)
from . import text as tx

# Executors need not have this package installed: the UDFs of this module
# travel with the task (pickled by value) instead of by import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MEMO_LIMIT = 1 << 16    # words: some 15 MB a vocabulary and task
_CHUNK_WORDS = 1 << 16   # words that are split at a time


Matcher = tuple[dict[int, int], list[int], list[tuple[int, ...]]]
_START, _CONT = 0, 1   # roots of the matcher: a word's start, and after a piece
_CHAR_BITS = 21        # a code point fits


def build_matcher(vocab: dict[str, int], prefix: str = CONTINUATION_PREFIX) -> Matcher:
    """A trie of all tokens (root ``_START``) and of the continuation tokens
    without their prefix (root ``_CONT``), with failure links: (steps, fails,
    pops).  ``steps`` maps node and character to the next node.  A node without
    such a step has matched text whose longest-match split begins with the
    pieces ``pops[node]`` and leaves what ``fails[node]`` stands for (-1: the
    text cannot be split).  Plain containers, so that it travels without code."""
    steps: dict[int, int] = {}
    ends: dict[int, int] = {}
    parents: list[tuple[int, int]] = [(-1, 0), (-1, 0)]
    depth = [0, 0]

    def insert(text: str, node: int, token: int) -> None:
        for c in map(ord, text):
            key = node << _CHAR_BITS | c
            nxt = steps.get(key)
            if nxt is None:
                nxt = steps[key] = len(parents)
                parents.append((node, c))
                depth.append(depth[node] + 1)
            node = nxt
        ends[node] = token

    for t, i in vocab.items():
        if t:
            insert(t, _START, i)
        if t.startswith(prefix) and len(t) > len(prefix):
            insert(t[len(prefix):], _CONT, i)
    fails, pops = [-1] * len(parents), [()] * len(parents)
    for v in sorted(range(2, len(parents)), key=depth.__getitem__):  # shallow nodes first
        u, c = parents[v]
        if v in ends:
            pops[v], fails[v] = (ends[v],), _CONT
            continue
        z, out = fails[u], pops[u]
        while z >= 0 and (z << _CHAR_BITS | c) not in steps:
            z, out = fails[z], out + pops[z]
        if z >= 0:
            fails[v], pops[v] = steps[z << _CHAR_BITS | c], out
    return steps, fails, pops


def match_pieces(word: str, matcher: Matcher, unk_id: int, max_chars: int = MAX_INPUT_CHARS_PER_WORD) -> list[int]:
    """The greedy longest-match split of one word (X5, X6), in time linear in
    its length: every probe either takes a character or follows a failure link,
    and a link never leads to longer text."""
    if len(word) > max_chars:
        return [unk_id]
    steps, fails, pops = matcher
    out: list[int] = []
    node = _START
    for c in map(ord, word):
        nxt = steps.get(node << _CHAR_BITS | c)
        while nxt is None:
            out += pops[node]
            node = fails[node]
            if node < 0:
                return [unk_id]
            nxt = steps.get(node << _CHAR_BITS | c)
        node = nxt
    while node > _CONT:
        out += pops[node]
        node = fails[node]
        if node < 0:
            return [unk_id]
    return out


class Vocabulary:
    """Token <-> id table held by the driver (bounded) and broadcast once."""

    def __init__(self, token_to_id: dict[str, int]):
        self.token_to_id = dict(token_to_id)
        self._bc = None

    @classmethod
    def from_df(cls, vocab_df: DataFrame) -> "Vocabulary":
        rows = vocab_df.select("token", "id").limit(MAX_VOCAB + 1).collect()
        if len(rows) > MAX_VOCAB:
            raise ValueError(f"vocabulary has more than {MAX_VOCAB} entries: not broadcast")
        return cls({r["token"]: int(r["id"]) for r in rows})

    def __len__(self) -> int:
        return len(self.token_to_id)

    def id_of(self, token: str) -> int:
        return self.token_to_id[token]

    def tokens_by_id(self) -> list[str | None]:
        size = max(self.token_to_id.values()) + 1 if self.token_to_id else 0
        out: list[str | None] = [None] * size
        for t, i in self.token_to_id.items():
            out[i] = t
        return out

    def broadcast(self, spark):
        if self._bc is None:
            self._bc = spark.sparkContext.broadcast(build_matcher(self.token_to_id))  # within MAX_VOCAB
        return self._bc


def _wordpiece_udf(bc, unk_id: int, max_chars: int, specials: dict[str, int], nested: bool = False, first: int | None = None):
    """Arrow UDF: array<string> words -> array<int> piece ids (no specials),
    with ``first`` only a row's first ids; ``nested``: a list of word arrays ->
    a list of id arrays.  Words go through in chunks of ``_CHUNK_WORDS``, whatever
    the rows of a batch.  Not deterministic to the planner: a filter on the ids
    would otherwise be moved below them and split every word a second time."""
    memo_key = uuid.uuid4().hex  # one memo per vocabulary (per deserialised UDF, i.e. per task)

    def encode_chunk(flat: pa.Array, matcher: Matcher, memo: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of the distinct words, where each word's ids begin, how many)."""
        enc = pc.dictionary_encode(flat)
        idx = enc.indices.to_numpy(zero_copy_only=False)
        pieces = []  # a word's ids as 4 bytes each: a third of a list, and joined without a loop
        for w in enc.dictionary.to_pylist():
            p = memo.get(w)
            if p is None:
                p = array("i", [specials[w]] if w in specials else match_pieces(w, matcher, unk_id, max_chars)).tobytes()
                if len(w) <= max_chars:
                    if len(memo) >= _MEMO_LIMIT:
                        memo.clear()
                    memo[w] = p
            pieces.append(p)
        ulen = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) // 4
        uflat = np.frombuffer(b"".join(pieces), dtype=np.int32)
        return uflat, (np.cumsum(ulen) - ulen)[idx], ulen[idx]

    def encode_flat(words: pa.ListArray) -> pa.ListArray:
        matcher = bc.value
        memo = _memo_for(memo_key)
        flat = words.flatten()
        ends = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(words), 0), dtype=np.int64))])
        n_ids = np.zeros(len(words), np.int64)
        out = [np.zeros(0, np.int32)]
        for a in range(0, len(flat), _CHUNK_WORDS):
            uflat, begin, size = encode_chunk(flat.slice(a, _CHUNK_WORDS), matcher, memo)
            row = np.searchsorted(ends, np.arange(a, a + len(size)), side="right") - 1
            if first is not None:
                # ids of the same row before each word, those of earlier chunks included
                before = np.cumsum(size) - size
                before += n_ids[row] - before[np.maximum(ends[row] - a, 0)]
                size = np.clip(first - before, 0, size)
            stop = np.cumsum(size)
            out.append(uflat[np.repeat(begin - (stop - size), size) + np.arange(stop[-1])])
            n_ids[row[0]:row[-1] + 1] += np.bincount(row - row[0], weights=size).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(n_ids)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(out)), mask=words.is_null())

    if nested:
        @F.arrow_udf(T.ArrayType(T.ArrayType(T.IntegerType(), containsNull=False)))
        def encode_lists(lists: pa.Array) -> pa.Array:
            if isinstance(lists, pa.ChunkedArray):
                lists = lists.combine_chunks()
            ends = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))])
            return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), encode_flat(lists.flatten()), mask=lists.is_null())

        return encode_lists.asNondeterministic()

    @F.arrow_udf(T.ArrayType(T.IntegerType(), containsNull=False))
    def encode_words(words: pa.Array) -> pa.Array:
        return encode_flat(words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words)

    return encode_words.asNondeterministic()


_MEMOS: dict[str, dict] = {}


def _memo_for(key: str) -> dict:
    m = _MEMOS.get(key)
    if m is None:
        _MEMOS.clear()
        m = _MEMOS[key] = {}
    return m


@dataclass(frozen=True)
class Profile:
    """How text becomes words and which specials wrap the ids."""

    name: str
    bos: str = BOS
    eos: str = EOS
    pad: str = PAD
    unk: str = UNK

    extra: tuple[str, ...] = ()

    @property
    def specials(self) -> tuple[str, ...]:
        """Literals that stay whole in text."""
        return (self.unk, self.pad, self.bos, self.eos, *self.extra)

    def words(self, c: Column) -> Column:
        return tx.words(c) if self.name == "target" else tx.source_words(c, self.specials)


TARGET = Profile("target")
SOURCE = Profile("source")
# FIXED VALUES: special tokens of pretrained uncased WordPiece vocabularies
BERT_SOURCE = Profile("source", bos="[CLS]", eos="[SEP]", pad="[PAD]", unk="[UNK]", extra=("[MASK]",))


def wordpiece_ids(word_array: Column, vocab: Vocabulary, spark, unk: str = UNK,
                  specials: tuple[str, ...] = SPECIAL_TOKENS, nested: bool = False, first: int | None = None) -> Column:
    """X5/X6 over an array<string> of words -> array<int> (no specials);
    with ``first``, only so many ids of each row leave Python."""
    bc = vocab.broadcast(spark)
    known = {t: vocab.token_to_id[t] for t in specials if t in vocab.token_to_id}
    udf = _wordpiece_udf(bc, vocab.id_of(unk), MAX_INPUT_CHARS_PER_WORD, known, nested, first)
    return udf(word_array)


def truncate_right(ids: Column, n: int) -> Column:
    """T4: first n ids."""
    return F.slice(ids, 1, n)


def add_bos_eos(ids: Column, bos_id: int, eos_id: int) -> Column:
    """[BOS] $A [EOS]."""
    return F.concat(F.array(F.lit(bos_id)), ids, F.array(F.lit(eos_id)))


def encode(text: Column, vocab: Vocabulary, spark, profile: Profile = TARGET,
           truncate: bool = False, max_length: int = MAX_LENGTH) -> Column:
    """X9 (target profile) / X10 (source profile): text -> ids with specials.

    With ``truncate`` the content is cut to ``max_length - 2`` so that the
    result including both specials is at most ``max_length``.  Null text
    gives null ids.
    """
    if not isinstance(text, Column):
        raise TypeError(f"encode expects a Column of strings, got {type(text).__name__}")
    ids = wordpiece_ids(profile.words(text), vocab, spark, profile.unk, profile.specials,
                        first=max_length - 2 if truncate else None)
    if truncate:
        ids = truncate_right(ids, max_length - 2)
    out = add_bos_eos(ids, vocab.id_of(profile.bos), vocab.id_of(profile.eos))
    return F.when(text.isNotNull(), out)


def encode_target(text: Column, vocab: Vocabulary, spark, truncate: bool = False,
                  max_length: int = MAX_LENGTH) -> Column:
    return encode(text, vocab, spark, TARGET, truncate, max_length)


def encode_source(text: Column, vocab: Vocabulary, spark, max_length: int = MAX_LENGTH) -> Column:
    """The source side is always truncated to ``max_length`` incl. specials."""
    return encode(text, vocab, spark, SOURCE, True, max_length)


def encode_list(df: DataFrame, texts_col: str, vocab: Vocabulary, out_col: str = "ids",
                truncate: bool = False, max_length: int = MAX_LENGTH) -> DataFrame:
    """X9 on an ``array<string>`` column (the reference's list input):
    ``out_col`` gets one id list per element, in element order; a null element
    or list stays null.  The whole list goes through one Arrow UDF, so rows
    need no key, join or shuffle."""
    words = tx.words_of_list(F.col(texts_col))
    ids = wordpiece_ids(words, vocab, df.sparkSession, UNK, SPECIAL_TOKENS, nested=True)
    bos, eos = vocab.id_of(BOS), vocab.id_of(EOS)

    def finish(x: Column) -> Column:
        return F.when(x.isNotNull(), add_bos_eos(truncate_right(x, max_length - 2) if truncate else x, bos, eos))

    return df.withColumn(out_col, F.transform(ids, finish))
