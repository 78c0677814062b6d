"""Removal of repeated 100-byte strings with suffix arrays built by linear
grouping (GSACA: suffixes are grouped by Lyndon prefix, groups are processed
in descending order through previous-smaller pointers, then every group's
order is emitted; nothing is renamed recursively).

Definition.  Over all documents as UTF-8 bytes, a byte is removed if it lies in
a ``width``-byte string that also starts earlier (smaller id, or the same
document further left).  Strings are judged on the input.  Matches never
cross documents.

How the corpus is cut into suffix arrays that a task can hold:

1. Every window of 100 bytes is owned by its minimizer, the leftmost smallest
   24-byte gram in it.  Equal windows have it at the same offset, so an
   occurrence is (anchor, offset), and equal windows meet under one gram.
   A task emits each anchor once, with hashes of its gram and of the bytes
   that its windows span, after collapsing equal ones of its own input.
2. Anchors meet by gram.  Of anchors with equal spans all but the first are
   repeats as a whole; a gram with a single span is done; only the firsts of
   grams with several spans go on.
3. Their 100 bytes to the right and 76 to the left are fetched from the texts.
4. A task builds one suffix array over the right contexts and one over the
   reversed left contexts (16 bytes a symbol, which keeps the byte order), and
   takes the longest common prefixes of neighbours in bytes.  Windows at
   offset o are equal if they share the prefix interval of length 100 - o on
   the right and of length o on the left; all but the first are repeats.
   A gram with over ``HOT_GRAM`` spans is cut by its contexts first: windows
   at the offsets of a band of ``BAND`` share all bytes but ``BAND`` - 1 of them, so its
   contexts are dealt by those bytes, band by band, and every part is compared by
   suffix arrays of its own.
5. Repeats of a document are united, cut out and hashed.

Steps 1 and 2 compare spans by 128 bits of hash; step 4 compares bytes.

Defined results: a null text has no bytes; texts below 100 bytes keep all;
rows repeated with one id and one text count as one document and all get its
result; of rows with one id and different texts the order is that of the
texts' hash; null ids come last; an empty table gives an empty result; extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinline.llm.common import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 100
GRAM = 24
BACK = WIDTH - GRAM          # largest offset of an anchor in its window
SYMBOL = 16                  # bytes of a suffix-array symbol
SEGMENT = 1 << 20            # bytes hashed at a time
FLUSH = 1 << 20              # anchors collapsed at a time inside a task
LOCAL_HOT = 2_000            # spans of one gram in one flush from which its anchors are spread
HOT_GRAM = 20_000            # spans of one gram from which its contexts are dealt by their bytes
BAND = 4                     # offsets compared together in a part of such a gram
BROADCAST_GRAMS = 100_000    # hot grams up to which their names are broadcast
PIECE = 1 << 13              # contexts of one suffix array (more only for one gram of up to HOT_GRAM)
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


# ------------------------------------------------------------------ suffix array


def gsaca(text: np.ndarray) -> list[int]:
    """Suffix array of a non-negative integer string whose last symbol is its
    only smallest."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    start_of = np.concatenate([[True], text[order[1:]] != text[order[:-1]]])
    starts = np.nonzero(start_of)[0]
    sizes = np.zeros(n, np.int64)
    sizes[starts] = np.diff(np.append(starts, n))
    group_arr, place_arr = np.empty(n, np.int64), np.empty(n, np.int64)
    group_arr[order] = starts[np.cumsum(start_of) - 1]
    place_arr[order] = np.arange(n)
    sa, size, group, place = order.tolist(), sizes.tolist(), group_arr.tolist(), place_arr.tolist()
    prev = [-1] * n
    # groups from the highest down; a group is a run of `sa`, named by its start
    end = n - 1
    while end >= 0:
        first = group[sa[end]]
        members = sa[first:end + 1]
        if end > first:
            members.sort()
        hits: dict[int, int] = {}
        for s in members:
            p = s - 1
            while p >= 0 and group[p] >= first:
                p = prev[p]
            prev[s] = p
            if p >= 0:
                hits[p] = hits.get(p, 0) + 1
        # suffixes that this group follows most often become the highest of their group
        levels = sorted(set(hits.values()), reverse=True)
        for level in levels:
            moved: dict[int, int] = {}
            for p, k in hits.items():
                if k == level:
                    h = group[p]
                    m = moved[h] = moved.get(h, 0) + 1
                    at, to = place[p], h + size[h] - m
                    q = sa[to]
                    sa[at], place[q] = q, at
                    sa[to], place[p] = p, to
            for h, m in moved.items():
                rest = size[h] - m
                if rest:
                    size[h], new = rest, h + rest
                    size[new] = m
                    for p in sa[new:new + m]:
                        group[p] = new
        end = first - 1
    # emit: every suffix follows the one after it, then its previous-smaller chain
    out, free, placed = [0] * n, list(range(n)), bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            at = free[g]
            out[at], free[g], placed[j] = j, at + 1, 1
            j = prev[j]
    return out


def context_order(ctx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each row of a byte matrix among all, by the suffix array of
    their concatenation, and the common prefix of each rank with the one before."""
    n, width = ctx.shape
    per = -(-width // SYMBOL)
    wide = np.zeros((n, per * SYMBOL), np.uint8)
    wide[:, :width] = ctx
    halves = wide.reshape(n * per, 2, SYMBOL // 2).view(">u8").reshape(n * per, 2).astype(np.uint64)
    by = np.lexsort((halves[:, 1], halves[:, 0]))
    rank = np.empty(n * per, np.int64)
    rank[by] = np.cumsum(np.concatenate([[0], (halves[by[1:]] != halves[by[:-1]]).any(axis=1)]))
    text = np.ones((n, per + 1), np.int64)      # 1 separates contexts
    text[:, :per] = rank.reshape(n, per) + 2
    sa = np.array(gsaca(np.append(text.ravel(), 0)), np.int64)
    order = sa[sa % (per + 1) == 0] // (per + 1)
    order = order[order < n]
    differ = ctx[order[1:]] != ctx[order[:-1]]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    ranks = np.empty(n, np.int64)
    ranks[order] = np.arange(n)
    return ranks, np.concatenate([[0], common])


def repeated_offsets(right: np.ndarray, left: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Flags [context, offset]: the window at this offset equals one of an
    earlier row.  Rows are in document order; ``left`` is reversed."""
    n = len(right)
    flags = np.zeros((n, BACK + 1), bool)
    if n < 2:
        return flags
    r_rank, r_common = context_order(right)
    l_rank, l_common = context_order(left)
    for o in range(int(low.min()), int(high.max()) + 1):
        own = np.nonzero((low <= o) & (o <= high))[0]
        if len(own) < 2:
            continue
        key = np.cumsum(r_common < WIDTH - o)[r_rank[own]] * (n + 1) + np.cumsum(l_common < o)[l_rank[own]]
        _, first, inv = np.unique(key, return_index=True, return_inverse=True)
        flags[own[first[inv] != np.arange(len(own))], o] = True
    return flags


# ------------------------------------------------------------------ anchors


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * _M[0]) ^ (b * _M[1])
    x ^= x >> np.uint64(29)
    x *= _M[2]
    return x


def anchors(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of the windows of all documents in ``raw``: document number,
    position in it, back (distance to the first window owned), span (windows
    owned less one), gram hash, span hash."""
    n = len(raw)
    counts = np.maximum(sizes - WIDTH + 1, 0)
    if counts.sum() == 0:
        e = np.zeros(0, np.int64)
        return e, e, e, e, e, e
    h = {1: (raw.astype(np.uint64) + np.uint64(1)) * _M[3]}
    for w in (1, 2, 4, 8, 16, 32):
        h[2 * w] = _join(h[w][:-w], h[w][w:])
    gram = _join(h[16][:n - GRAM + 1], h[8][16:])
    # hash in the high bits, place in the low ones: the minimum is the leftmost smallest
    low = _join(gram, gram) & ~np.uint64((1 << 24) - 1) | np.arange(len(gram), dtype=np.uint64)
    span, width = low, 1
    while 2 * width <= BACK + 1:
        span, width = np.minimum(span[:-width], span[width:]), 2 * width
    rest = BACK + 1 - width
    if rest:
        span = np.minimum(span[:-rest], span[rest:])
    ends = np.cumsum(counts)
    s = np.arange(ends[-1]) + np.repeat(starts - (ends - counts), counts)
    doc = np.repeat(np.arange(len(starts)), counts)
    a = (span[s] & np.uint64((1 << 24) - 1)).astype(np.int64)
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (doc[1:] != doc[:-1])])
    i = np.nonzero(new)[0]
    j = np.append(i[1:], len(s)) - 1
    s0, s1, at, d = s[i], s[j], a[i], doc[i]

    def window(x: np.ndarray) -> np.ndarray:
        return _join(_join(h[64][x], h[32][x + 64]), h[4][x + 96])

    shape = ((at - s0) * 128 + (s1 - s0)).astype(np.uint64)
    return (d, at - starts[d], at - s0, s1 - s0, gram[at].view(np.int64),
            _join(_join(window(s0), window(s1)), shape * _M[3]).view(np.int64))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(raw bytes, starts, sizes, keys, base offsets) of about SEGMENT bytes.
    A longer text is cut into overlapping parts, each window in one part."""
    raw, keys, bases = [], [], []
    held = 0

    def out():
        sizes = np.array([len(x) for x in raw], np.int64)
        return np.concatenate(raw), np.cumsum(sizes) - sizes, sizes, np.array(keys, np.int64), np.array(bases, np.int64)

    for b in batches:
        for key, text in zip(b.column(0).to_pylist(), b.column(1)):
            if not text.is_valid:
                continue
            whole = np.frombuffer(text.as_buffer(), np.uint8)
            for base in range(0, max(1, len(whole) - WIDTH + 1), SEGMENT):
                part = whole[base:base + SEGMENT + WIDTH - 1]
                if len(part) >= WIDTH:
                    raw.append(part)
                    keys.append(key)
                    bases.append(base)
                    held += len(part)
                if held >= SEGMENT:
                    yield out()
                    raw, keys, bases, held = [], [], [], 0
    if raw:
        yield out()


# kinds of rows
ANCHOR, MARK, REPEAT, FIRST = 0, 1, 2, 3
_ANCHOR_SCHEMA = "route long, kind int, gram long, span_hash long, k long, pos long, back int, span int"
_ANCHOR_NAMES = [c.split(" ")[0] for c in _ANCHOR_SCHEMA.split(", ")]


def _batch(cols: list, names: list[str], ints: tuple[str, ...] = ("kind", "back", "span")) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c, np.int32 if n in ints else np.int64)) for c, n in zip(cols, names)], names=names)


def _first_of_span(gram, span_hash, k, pos):
    """Order by (gram, span, document, place); which rows of that order start a
    span, and which repeat the very same place (repeated rows)."""
    order = np.lexsort((pos, k, span_hash, gram))
    g, h, kk, pp = gram[order], span_hash[order], k[order], pos[order]
    same = np.concatenate([[False], (g[1:] == g[:-1]) & (h[1:] == h[:-1])])
    again = np.concatenate([[False], same[1:] & (kk[1:] == kk[:-1]) & (pp[1:] == pp[:-1])])
    return order, ~same, again


def _ranges(k: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unite overlapping or touching ranges of each document."""
    if len(k) == 0:
        return k, start, end
    order = np.lexsort((start, k))
    k, start, end = k[order], start[order], end[order]
    doc = np.cumsum(np.concatenate([[0], k[1:] != k[:-1]]))
    lift = doc * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + lift)
    new = np.concatenate([[True], (start + lift)[1:] > reach[:-1]])
    i = np.nonzero(new)[0]
    return k[i], start[i], (reach - lift)[np.append(i[1:], len(k)) - 1]


def _collapse(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Step 1 inside a task: only the first anchor of each span goes on."""
    k, pos, back, span, gram, span_hash = (np.concatenate(x) for x in zip(*parts))
    order, first, again = _first_of_span(gram, span_hash, k, pos)
    repeat = order[~first & ~again]
    rk, rs, re = _ranges(k[repeat], pos[repeat] - back[repeat], pos[repeat] - back[repeat] + span[repeat] + WIDTH)
    if len(rk):
        z = np.zeros(len(rk), np.int64)
        route = (rk.astype(np.uint64) * _M[0] + rs.astype(np.uint64)).view(np.int64)
        yield _batch([route, z + REPEAT, z, z, rk, rs, re - rs, z], _ANCHOR_NAMES)
    keep = order[first]
    g = gram[keep]                                # sorted
    edge = np.nonzero(np.concatenate([[True], g[1:] != g[:-1]]))[0]
    many = np.diff(np.append(edge, len(g)))
    hot = np.repeat(many > LOCAL_HOT, many)
    route = np.where(hot, (g.view(np.uint64) * _M[1] ^ span_hash[keep].view(np.uint64)).view(np.int64), g)
    kind = np.where(hot, FIRST, ANCHOR)           # a hot gram has several spans for certain
    yield _batch([route, kind, g, span_hash[keep], k[keep], pos[keep], back[keep], span[keep]], _ANCHOR_NAMES)
    marks = g[edge[many > LOCAL_HOT]]
    if len(marks):
        z = np.zeros(len(marks), np.int64)
        yield _batch([marks, z + MARK, marks, z, z, z, z, z], _ANCHOR_NAMES)


def _emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, held = [], 0
    for raw, starts, sizes, keys, bases in _segments(batches):
        d, pos, back, span, gram, span_hash = anchors(raw, starts, sizes)
        if len(d):
            parts.append([keys[d], pos + bases[d], back, span, gram, span_hash])
            held += len(d)
        if held >= FLUSH:
            yield from _collapse(parts)
            parts, held = [], 0
    if parts:
        yield from _collapse(parts)


def _meet_by_gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2: repeats as ranges (pos, back = length), firsts that go on."""
    names = ["kind", "gram", "k", "pos", "back", "span"]
    cols: list[list[np.ndarray]] = []
    for b in batches:
        kind, gram, span_hash, k, pos, back, span = (np.asarray(b.column(i)).astype(np.int64) for i in range(1, 8))
        done = kind == REPEAT
        if done.any():
            yield _batch([kind[done], gram[done], k[done], pos[done], back[done], span[done]], names)
        cols.append([x[~done] for x in (kind, gram, span_hash, k, pos, back, span)])
    if not cols:
        return
    kind, gram, span_hash, k, pos, back, span = (np.concatenate(x) for x in zip(*cols))
    several = np.unique(gram[kind == MARK])
    real = kind != MARK
    kind, gram, span_hash, k, pos, back, span = (x[real] for x in (kind, gram, span_hash, k, pos, back, span))
    order, first, again = _first_of_span(gram, span_hash, k, pos)
    r = order[~first & ~again]
    if len(r):
        rk, rs, re = _ranges(k[r], pos[r] - back[r], pos[r] - back[r] + span[r] + WIDTH)
        z = np.zeros(len(rk), np.int64)
        yield _batch([z + REPEAT, z, rk, rs, re - rs, z], names)
    f = order[first]
    g = gram[f]
    if len(g):
        edge = np.concatenate([[True], g[1:] != g[:-1]])
        many = np.diff(np.append(np.nonzero(edge)[0], len(g)))
        f = f[np.repeat(many > 1, many) | (kind[f] == FIRST) | np.isin(g, several)]
        if len(f):
            yield _batch([np.full(len(f), FIRST), gram[f], k[f], pos[f], back[f], span[f]], names)


_CONTEXT_SCHEMA = "gram long, k long, pos long, low int, high int, hot boolean, lft binary, rgt binary"


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3: (k, text, [gram, pos, back, span, hot]) to fixed-width contexts."""
    for b in batches:
        k, gram, pos, low, high, hot, lft, rgt = [], [], [], [], [], [], [], []
        for key, text, firsts in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
            raw = text.as_buffer().to_pybytes()
            for f in firsts:
                a = f["pos"]
                k.append(key)
                gram.append(f["gram"])
                pos.append(a)
                low.append(f["back"] - f["span"])
                high.append(f["back"])
                hot.append(f["hot"])
                lft.append(raw[max(0, a - BACK):a][::-1].ljust(BACK, b"\0"))
                rgt.append(raw[a:a + WIDTH].ljust(WIDTH, b"\0"))
        if k:
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram, pa.int64()), pa.array(k, pa.int64()), pa.array(pos, pa.int64()), pa.array(low, pa.int32()),
                 pa.array(high, pa.int32()), pa.array(hot, pa.bool_()), pa.array(lft, pa.binary()), pa.array(rgt, pa.binary())],
                names=[c.split(" ")[0] for c in _CONTEXT_SCHEMA.split(", ")])


_RANGE_SCHEMA = "k long, start long, stop long"


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(len(col), width)


def _compare(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """Step 4 on whole grams."""
    k, pos = np.asarray(t["k"]), np.asarray(t["pos"])
    flags = repeated_offsets(_matrix(t["rgt"].combine_chunks(), WIDTH), _matrix(t["lft"].combine_chunks(), BACK),
                             np.asarray(t["low"]), np.asarray(t["high"]))
    wide = np.zeros((len(k), BACK + 3), np.int8)
    wide[:, 1:-1] = flags
    step = np.diff(wide, axis=1)
    row, lo = np.nonzero(step == 1)
    hi = np.nonzero(step == -1)[1] - 1
    rk, rs, re = _ranges(k[row], pos[row] - hi, pos[row] - lo + WIDTH)
    if len(rk):
        yield _batch([rk, rs, re], ["k", "start", "stop"])


def _suffix_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in itertools.chain(batches, [None]):
        if b is not None:
            held.append(b)
            rows += b.num_rows
            if rows < PIECE:
                continue
        if not held:
            return
        t = pa.Table.from_batches(held)
        gram = np.asarray(t["gram"])
        edges = np.append(np.nonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))[0], len(gram))
        end = len(gram) if b is None else int(edges[-2])   # the last gram may go on
        at = 0
        while at < end:
            stop = int(edges[max(np.searchsorted(edges, at + PIECE, side="right") - 1, np.searchsorted(edges, at, side="right"))])
            stop = min(stop, end)
            yield from _compare(t.slice(at, stop - at))
            at = stop
        rest = t.slice(end)
        held, rows = rest.to_batches(), rest.num_rows


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts as they are, but those of hot grams once for each band of
    offsets they own, under a route in place of the gram: windows of a band that
    are equal share the bytes it is made of.  (The route only brings contexts
    together.)"""
    lw, rw = (np.random.default_rng(n).integers(1, 1 << 62, n, np.uint64) * np.uint64(2) + np.uint64(1) for n in (BACK, WIDTH))
    names = [c.split(" ")[0] for c in _CONTEXT_SCHEMA.split(", ")]
    for b in batches:
        mask = b.column("hot")
        yield b.filter(pc.invert(mask))
        b = b.filter(mask)
        if not b.num_rows:
            continue
        gram = np.asarray(b.column("gram")).view(np.uint64)
        low, high = np.asarray(b.column("low")), np.asarray(b.column("high"))
        left, right = _matrix(b.column("lft"), BACK).astype(np.uint64), _matrix(b.column("rgt"), WIDTH).astype(np.uint64)
        for lo in range(0, BACK + 1, BAND):
            hi = min(lo + BAND - 1, BACK)
            at = np.nonzero((low <= hi) & (high >= lo))[0]
            if not len(at):
                continue
            shared = left[at, :lo] @ lw[:lo] ^ _join(right[at, :WIDTH - hi] @ rw[:WIDTH - hi], gram[at] + np.uint64(lo))
            part = b.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shared.view(np.int64)), part.column("k"), part.column("pos"), pa.array(np.maximum(low[at], lo).astype(np.int32)),
                 pa.array(np.minimum(high[at], hi).astype(np.int32)), part.column("hot"), part.column("lft"), part.column("rgt")], names=names)


# ------------------------------------------------------------------ the whole


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """(_id, _raw, _k): _k orders the documents.  It is the id itself where ids
    are unique and not null; else ranks of distinct (id, text hash).  And
    whether _k is unique."""
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    src = docs.select(F.col(id_col).cast("long").alias("_id"), raw.alias("_raw"))
    odd = src.groupBy("_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or _id is null").limit(1).count()
    if not odd:
        return src.withColumn("_k", F.col("_id")), True
    src = src.withColumn("_h", F.xxhash64("_raw"))
    pairs = src.select("_id", "_h").distinct().orderBy(F.col("_id").asc_nulls_last(), "_h")
    ranked = pairs.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1])).toDF("_id long, _h long, _k long")
    ranked = cut(ranked).select(F.col("_id").alias("_i"), F.col("_h").alias("_hh"), "_k")
    return src.join(ranked, src["_id"].eqNullSafe(ranked["_i"]) & (src["_h"] == ranked["_hh"])).select("_id", "_raw", "_k"), False


def repeated_ranges(keyed: DataFrame, hot_gram: int = HOT_GRAM) -> DataFrame:
    """(k, start, stop) byte ranges to remove; they may overlap.  keyed: (_k, _raw), _k unique."""
    met = (keyed.mapInArrow(_emit_anchors, _ANCHOR_SCHEMA).repartition("route")
           .mapInArrow(_meet_by_gram, "kind int, gram long, k long, pos long, back int, span int"))
    met = cut(met)
    sure = met.where(F.col("kind") == REPEAT).select("k", F.col("pos").alias("start"), (F.col("pos") + F.col("back")).alias("stop"))
    firsts = met.where(F.col("kind") == FIRST)
    hot = cut(firsts.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_gram).select("gram", F.lit(True).alias("hot")))
    few = F.broadcast(hot) if hot.limit(BROADCAST_GRAMS + 1).count() <= BROADCAST_GRAMS else hot
    firsts = firsts.join(few, "gram", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    by_doc = firsts.groupBy("k").agg(F.collect_list(F.struct("gram", "pos", "back", "span", "hot")).alias("_firsts"))  # at most a text's anchors
    contexts = keyed.join(by_doc, keyed["_k"] == by_doc["k"]).select("_k", "_raw", "_firsts").mapInArrow(_cut_contexts, _CONTEXT_SCHEMA)
    found = (contexts.mapInArrow(_bands, _CONTEXT_SCHEMA).repartition("gram").sortWithinPartitions("gram", "k", "pos")
             .mapInArrow(_suffix_arrays, _RANGE_SCHEMA))
    return sure.unionByName(found)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_gram: int = HOT_GRAM,
                   keep_bytes: bool = False) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256``, and with ``keep_bytes`` the remaining bytes as ``kept``."""
    keyed, unique = _keyed(docs, id_col, text_col)
    texts = keyed.select("_k", "_raw")
    spans = repeated_ranges(texts if unique else texts.dropDuplicates(["_k"]), hot_gram).groupBy("k").agg(F.collect_list(F.struct("start", "stop")).alias("_spans"))
    rows = keyed.join(spans, keyed["_k"] == spans["k"], "left").select("_id", "_raw", "_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, gone, count, sha, left = [], [], [], [], []
            for text, spans_ in zip(b.column(1), b.column(2)):
                raw = memoryview(text.as_buffer())
                kept, removed, n, at = [], 0, 0, 0
                if spans_.is_valid:
                    v = spans_.values
                    start, stop = np.asarray(v.field("start")), np.asarray(v.field("stop"))
                    _, start, stop = _ranges(np.zeros(len(start), np.int64), start, stop)
                    for x, y in zip(start.tolist(), stop.tolist()):
                        kept.append(raw[at:x])
                        removed, n, at = removed + y - x, n + 1, y
                kept.append(raw[at:])
                digest = hashlib.sha256()
                for x in kept:
                    digest.update(x)
                size.append(len(raw))
                gone.append(removed)
                count.append(n)
                sha.append(digest.hexdigest())
                left.append(b"".join(kept) if keep_bytes else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()),
                                              pa.array(sha, pa.string()), pa.array(left, pa.binary())],
                                             names=["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = rows.mapInArrow(run, "_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    out = out.withColumnRenamed("_id", id_col)
    return out if keep_bytes else out.drop("kept")
