"""Byte-level BPE encoding and decoding with DuckDB recursive queries per
partition.

Method.  Spark's regular expression cuts whole texts into the pattern's
matches ("words").  In each task the distinct words of a batch that are not
yet known become rows (word, position, token); a recursive query joins
neighbouring tokens with the merge table and contracts each word's leftmost
pair of the smallest rank, until no word has a pair left.  The merge table
holds every split of a vocabulary entry into two entries, so joining it is
looking up the joined bytes.  A word that is an entry as a whole is that
token.

Before that, a word is cut where no vocabulary entry holds the two bytes beside
the cut: no merge can cross it, so its pieces are merged on their own.  A piece
of over ``LONG_PIECE`` bytes goes through a second recursive query that
contracts, in one step, every occurrence of the smallest-rank pair that does not
overlap one before it.  That is what the rule does one by one, provided that no
joined token makes a pair of a smaller rank with its neighbours (looked up in the
same step; if one would, only the leftmost is contracted).  Rounds then follow
the number of different pairs, not the length.

Decoding joins token rows with the vocabulary and concatenates bytes by an
ordered aggregation.

DuckDB runs inside the task: one thread, memory only, no files.  Encoding feeds
it at most ``SQL_BATCH_WORK`` a query, decoding at most ``DECODE_TOKENS`` tokens,
whatever the length of a text, and the hash of the decoded bytes takes the
pieces in order.  Known words are kept while the Python worker lives, up to
``CACHE_BYTES``.

Defined results: a null text is encoded like an empty one (no tokens); an
empty table gives an empty result; extra columns are ignored, whatever their
names; repeated rows are encoded alike; ids out of the vocabulary are an
error when decoding.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import types
from collections.abc import Iterator
from contextlib import closing

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONG_PIECE = 64             # bytes of a piece from which a step contracts all occurrences of a pair
SQL_BATCH_WORK = 1_000_000  # squared piece lengths of one query: bounds the rows of all its steps
LONG_BATCH_BYTES = 1 << 20  # bytes of long pieces of one query (at least one piece)
CACHE_BYTES = 40 << 20      # of known words and their tokens, with what Python adds
ENTRY_BYTES = 180           # what Python adds to a key and its value
CHUNK_BYTES = 1 << 21       # of texts that are encoded at a time (at least one text)
DECODE_TOKENS = 1 << 18     # tokens of one decoding query: a longer text is decoded in pieces

# A row is a piece with its tokens; the token positions join the merge table.  A
# step contracts, in every piece that still has a known pair, the leftmost pair
# of the smallest rank.  The last step of a piece is its result.
MERGE_SQL = """
CREATE OR REPLACE TEMP TABLE steps AS
WITH RECURSIVE s(step, w, ids) AS (
  SELECT 0, w, ids FROM start_pieces
  UNION ALL
  SELECT s.step + 1, s.w, s.ids[:b.at - 1] || [b.joined] || s.ids[b.at + 2:]
  FROM s JOIN (
    SELECT p.w, arg_min(p.at, (m.id::BIGINT << 32) | p.at) AS at, min(m.id) AS joined
    FROM (SELECT w, unnest(range(1, len(ids))) AS at, unnest(ids[:-2]) AS l, unnest(ids[2:]) AS r FROM s) p
    JOIN merges m ON m.l = p.l AND m.r = p.r
    GROUP BY p.w) b ON b.w = s.w)
SELECT step, w, ids FROM s
"""

LAST_SQL = """
SELECT s.w, s.ids FROM steps s
JOIN (SELECT w, max(step) AS step FROM steps GROUP BY w) l ON l.w = s.w AND l.step = s.step
ORDER BY s.w
"""

# A row is a token of a long piece; only its latest state is kept (id -1: joined
# to the token before), and a step returns the rows it changed.  ``nth`` numbers
# the occurrences of the piece's smallest pair; ``place - nth`` is equal in a run
# of overlapping ones, of which every second one waits.  ``early``: the joined
# token and a neighbour (the left one as it then is, the right one as it still is)
# would be a pair of a smaller rank, so the occurrences must go one by one.
LONG_SQL = """
WITH RECURSIVE s(w, pos, id) USING KEY (w, pos) AS (
  SELECT w, pos, id FROM start_tokens
  UNION
  SELECT w, pos, CASE WHEN goes THEN -1 ELSE best END
  FROM (
    SELECT w, pos, best, takes, coalesce(lag(takes) OVER (PARTITION BY w ORDER BY pos), false) AS goes
    FROM (
      SELECT w, pos, best, nth, CASE WHEN bool_or(early) OVER (PARTITION BY w) THEN hit AND nth = 1 ELSE chosen END AS takes
      FROM (
        SELECT c.*, chosen AND (coalesce(a.id < best, false) OR coalesce(b.id < best, false)) AS early
        FROM (
          SELECT *, CASE WHEN coalesce(lag(chosen, 2) OVER o, false) THEN best ELSE lag(id) OVER o END AS before, lead(id, 2) OVER o AS after
          FROM (
            SELECT *, hit AND (row_number() OVER (PARTITION BY w, hit, place - nth ORDER BY pos)) % 2 = 1 AS chosen
            FROM (
              SELECT *, row_number() OVER (PARTITION BY w, hit ORDER BY pos) AS nth
              FROM (
                SELECT *, joined IS NOT NULL AND joined = best AS hit
                FROM (
                  SELECT q.*, f.id AS joined, min(f.id) OVER (PARTITION BY q.w) AS best
                  FROM (SELECT w, pos, id, lead(id) OVER o AS r, row_number() OVER o AS place FROM recurring.s
                        WHERE id >= 0 AND w IN (SELECT w FROM s) WINDOW o AS (PARTITION BY w ORDER BY pos)) q
                  LEFT JOIN merges f ON f.l = q.id AND f.r = q.r)
                WHERE best IS NOT NULL)))
          WINDOW o AS (PARTITION BY w ORDER BY pos)) c
        LEFT JOIN merges a ON chosen AND a.l = c.before AND a.r = c.best
        LEFT JOIN merges b ON chosen AND b.l = c.best AND b.r = c.after)))
  WHERE goes OR takes
)
SELECT w, id FROM s WHERE id >= 0 ORDER BY w, pos
"""

DECODE_SQL = """
SELECT t.doc, string_agg(v.bytes, '' ORDER BY t.pos) AS bytes
FROM tokens t LEFT JOIN vocab v ON v.id = t.id GROUP BY t.doc ORDER BY t.doc
"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Vocabulary:
    """What tasks need of a rank file; built once, on the driver."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        parts = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        # every split of an entry into two entries
        self.left, self.right, self.joined = np.array(parts, np.int32).reshape(-1, 3).T
        self.beside = np.zeros((256, 256), bool)  # byte pairs inside an entry
        for t in ranks:
            a = np.frombuffer(t, np.uint8)
            self.beside[a[:-1], a[1:]] = True
        self.key = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions starts[k] .. starts[k] + sizes[k] - 1, one segment after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _worker_state() -> types.ModuleType:
    """Where a Python worker keeps known words from one task to the next
    (code that travels by value has new globals in every task)."""
    return sys.modules.setdefault("_bpe_known_words", types.ModuleType("_bpe_known_words"))


class Remembered:
    """Keys and values within ``limit`` bytes: when the young half is full, it
    becomes the old one, and what is then not looked up is forgotten."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old, self.size = limit // 2, {}, {}, 0

    def look(self, keys: list) -> list:
        young, old = self.young.get, self.old.get
        got = [young(k) for k in keys]
        if self.old:
            again = [(i, v) for i, x in enumerate(got) if x is None and (v := old(keys[i])) is not None]
            for i, v in again:
                got[i] = v
            self.keep([keys[i] for i, _ in again], [v for _, v in again])
        return got

    def keep(self, keys: list, values: list) -> None:
        size = sum(map(len, keys)) + sum(map(len, values)) + ENTRY_BYTES * len(keys)
        if self.size + size > self.limit:
            self.young, self.old, self.size = {}, self.young, 0
        if size <= self.limit:
            self.young.update(zip(keys, values))
            self.size += size


class TaskBpe:
    """One task's encoder and decoder around an in-process DuckDB."""

    def __init__(self, vocabulary: Vocabulary | types.SimpleNamespace):
        import duckdb

        v, ranks = vocabulary, vocabulary.ranks
        self.ranks, self.beside = ranks, v.beside
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self._load("merges", pa.table({"l": v.left, "r": v.right, "id": v.joined}))
        # bytes travel as Latin-1 characters: tokens need not be valid UTF-8
        self._load("vocab", pa.table({"id": pa.array(list(ranks.values()), pa.int32()),
                                      "bytes": pa.array([t.decode("latin-1") for t in ranks])}))
        self.byte_id = np.full(256, -1, np.int32)
        for t, i in ranks.items():
            if len(t) == 1:
                self.byte_id[t[0]] = i
        state = _worker_state()
        if getattr(state, "key", None) != v.key:
            state.key, state.known = v.key, Remembered(CACHE_BYTES)
        self.known = state.known  # word -> ids as little-endian 32-bit integers

    def _load(self, name: str, table: pa.Table) -> None:
        self.con.register("_in", table)
        self.con.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM _in")
        self.con.unregister("_in")

    def close(self) -> None:
        self.con.close()

    def _merge_short(self, pieces: list[bytes]) -> list[bytes]:
        size = np.array([len(w) for w in pieces], np.int64)
        ends = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
        ids = pa.ListArray.from_arrays(ends, pa.array(self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]))
        self.con.register("start_pieces", pa.table({"w": np.arange(len(pieces), dtype=np.int32), "ids": ids}))
        self.con.execute(MERGE_SQL)
        got = self.con.sql(LAST_SQL).to_arrow_table()["ids"].combine_chunks()
        self.con.execute("DROP TABLE steps")
        self.con.unregister("start_pieces")
        flat = np.asarray(got.flatten()).astype("<u4").tobytes()
        at = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(got)))]).tolist()
        return [flat[4 * i:4 * j] for i, j in zip(at[:-1], at[1:])]

    def _merge_long(self, pieces: list[bytes]) -> list[bytes]:
        size = np.array([len(w) for w in pieces], np.int64)
        w = np.repeat(np.arange(len(pieces), dtype=np.int32), size)
        pos = ragged(np.zeros(len(pieces), np.int64), size).astype(np.int32)
        self.con.register("start_tokens", pa.table({"w": w, "pos": pos, "id": self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]}))
        got = self.con.sql(LONG_SQL).to_arrow_table()
        self.con.unregister("start_tokens")
        w, ids = np.asarray(got["w"]), np.asarray(got["id"]).astype("<u4")
        return [x.tobytes() for x in np.split(ids, np.searchsorted(w, np.arange(1, len(pieces))))]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers."""
        if not words:
            return []
        size = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(size)
        raw = np.frombuffer(b"".join(words), np.uint8)
        cut = np.zeros(len(raw), bool)
        cut[1:] = ~self.beside[raw[:-1], raw[1:]]
        cut[ends - size] = True
        start = np.nonzero(cut)[0]
        offsets = pa.py_buffer(np.append(start, len(raw)).astype(np.int32))
        enc = pa.Array.from_buffers(pa.binary(), len(start), [None, offsets, pa.py_buffer(raw)]).dictionary_encode()
        pieces, codes = enc.dictionary.to_pylist(), np.asarray(enc.indices)
        got: list[bytes] = [b""] * len(pieces)
        for long in (False, True):
            mine = [k for k, p in enumerate(pieces) if (len(p) > LONG_PIECE) is long]
            run = self._merge_long if long else self._merge_short
            bound = LONG_BATCH_BYTES if long else SQL_BATCH_WORK
            i = 0
            while i < len(mine):
                j, work = i, 0
                while j < len(mine) and (j == i or work < bound):
                    n = len(pieces[mine[j]])
                    work += n if long else n * n
                    j += 1
                for k, ids in zip(mine[i:j], run([pieces[k] for k in mine[i:j]])):
                    got[k] = ids
                i = j
        first = np.searchsorted(start, np.append(ends - size, len(raw))).tolist()
        parts = [got[c] for c in codes.tolist()]
        return [parts[i] if j == i + 1 else b"".join(parts[i:j]) for i, j in zip(first[:-1], first[1:])]

    def tokens_of(self, words: list[str]) -> list[bytes]:
        """Ids of each (distinct) word; what is new is merged and remembered."""
        got = self.known.look(words)
        new = [k for k, x in enumerate(got) if x is None]
        if new:
            raw = {k: words[k].encode("utf-8") for k in new}
            whole = {k: self.ranks.get(b) for k, b in raw.items()}
            todo = [k for k in new if whole[k] is None]
            for k, ids in zip(todo, self.merge([raw[k] for k in todo])):
                got[k] = ids
            for k in new:
                if whole[k] is not None:
                    got[k] = whole[k].to_bytes(4, "little")
            self.known.keep([words[k] for k in new], [got[k] for k in new])
        return got

    def encode(self, words: pa.Array, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, and where each text's ids end (from 0)."""
        enc = words.dictionary_encode()
        codes = np.asarray(enc.indices)
        got = self.tokens_of(enc.dictionary.to_pylist())
        size = np.fromiter(map(len, got), np.int64, len(got)) // 4
        flat = np.frombuffer(b"".join(got), "<u4")
        per = size[codes]
        ids = flat[ragged((np.cumsum(size) - size)[codes], per)]
        return ids, np.concatenate([[0], np.cumsum(per)])[ends]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(text, bytes) pieces by an ordered aggregation over token rows: the
        pieces of a text are in order, a text without tokens has none."""
        doc = np.repeat(np.arange(len(ends) - 1, dtype=np.int32), np.diff(ends))
        for i in range(0, len(ids), DECODE_TOKENS):
            part = ids[i:i + DECODE_TOKENS].astype(np.int32)
            self.con.register("tokens", pa.table({
                "doc": doc[i:i + DECODE_TOKENS], "pos": np.arange(len(part), dtype=np.int32), "id": part}))
            rows = self.con.sql(DECODE_SQL).to_arrow_table()
            self.con.unregister("tokens")
            for d, s in zip(rows["doc"].to_pylist(), rows["bytes"].to_pylist()):
                yield d, s.encode("latin-1")

    def decoded(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Bytes of each text."""
        out: list[list[bytes]] = [[] for _ in range(len(ends) - 1)]
        for d, piece in self.decode(ids, ends):
            out[d].append(piece)
        return [b"".join(pieces) for pieces in out]

    def decoded_sha256(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """SHA-256 of the bytes of each text, fed piece by piece."""
        out = [hashlib.sha256() for _ in range(len(ends) - 1)]
        for d, piece in self.decode(ids, ends):
            out[d].update(piece)
        return [h.hexdigest() for h in out]


def _bytes_upto(words: pa.Array, ends: np.ndarray) -> np.ndarray:
    """Bytes of the words before each of ``ends``, read from the array's own
    offsets: nothing is made for each word of a batch."""
    kind = np.int64 if pa.types.is_large_string(words.type) else np.int32
    if not len(words):
        return np.zeros(len(ends), np.int64)
    offsets = np.frombuffer(words.buffers()[1], kind)[words.offset:words.offset + len(words) + 1]
    return offsets[ends].astype(np.int64)


def _slices(upto: np.ndarray, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``max_bytes`` (at least one row); ``upto``: the bytes
    before each row, and of all."""
    i, n = 0, len(upto) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(upto, upto[i] + max_bytes, side="right")) - 1)
        yield i, j
        i = j


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     digest: bool = False) -> DataFrame:
    """One row per document: id, ``n_tokens`` and ``ids`` (array of int), or
    with ``digest`` the hashes of the ids and of the decoded bytes instead."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(Vocabulary(load_ranks(ranks_path))))  # one vocabulary: fixed size
    words = F.regexp_extract_all(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit("(?U)" + pattern), F.lit(0))
    src = docs.select(F.col(id_col).alias("_id"), words.alias("_words"))
    id_type = src.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with closing(TaskBpe(types.SimpleNamespace(**shared.value))) as task:
            for b in batches:
                yield from encode_batch(task, b)

    def encode_batch(task: TaskBpe, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = b.column("_words")
        flat = lists.flatten()
        ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists), dtype=np.int64))])
        for i, j in _slices(_bytes_upto(flat, ends), CHUNK_BYTES):
            ids, at = task.encode(flat.slice(ends[i], ends[j] - ends[i]), ends[i:j + 1] - ends[i])
            row, n = b.column("_id").slice(i, j - i), pa.array(np.diff(at))
            if digest:
                raw = ids.astype("<u4")
                sha = pa.array([hashlib.sha256(raw[x:y]).hexdigest() for x, y in zip(at[:-1], at[1:])], pa.string())
                dec = pa.array(task.decoded_sha256(ids, at), pa.string())
                yield pa.RecordBatch.from_arrays([row, n, sha, dec], names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                lists_out = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([row, n, lists_out], names=["_id", "n_tokens", "ids"])

    cols = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>"
    return src.mapInArrow(run, f"_id {id_type}, n_tokens long, {cols}").withColumnRenamed("_id", id_col)


def decode_documents(tokens: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row: id and ``decoded`` (binary); null ids decode to nothing."""
    ranks = load_ranks(ranks_path)
    shared = tokens.sparkSession.sparkContext.broadcast(vars(Vocabulary(ranks)))
    src = tokens.select(F.col(id_col).alias("_id"), F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>")).alias("_ids"))
    known = max(ranks.values())
    bad = F.exists("_ids", lambda x: x.isNull() | (x < 0) | (x > known))
    src = src.withColumn("_ids", F.when(bad, F.raise_error(F.lit("token id out of the vocabulary"))).otherwise(F.col("_ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with closing(TaskBpe(types.SimpleNamespace(**shared.value))) as task:
            for b in batches:
                yield from decode_batch(task, b)

    def decode_batch(task: TaskBpe, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = b.column("_ids")
        flat = np.asarray(lists.flatten())
        ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists), dtype=np.int64))])
        for i, j in _slices(4 * ends, CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays(
                [b.column("_id").slice(i, j - i), pa.array(task.decoded(flat[ends[i]:ends[j]], ends[i:j + 1] - ends[i]), pa.binary())],
                names=["_id", "decoded"])

    return src.mapInArrow(run, f"_id {src.schema['_id'].dataType.simpleString()}, decoded binary").withColumnRenamed("_id", id_col)
