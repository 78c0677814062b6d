"""Sharding by histogram sort (built-in functions only).

Method.  Rows are ordered by a 64-bit key: the CRC-32 of the text, then a
32-bit hash of the id, so equal texts lie together yet a hot text can be cut.
Candidate boundaries (probes) are laid between the bounds known for each
wanted boundary; every round counts the exact bytes below all probes across
the partitions and narrows the bounds, until each boundary is within
tolerance.  Then the rows are exchanged once, by fine bucket; a slot is the
bucket's offset plus the rank inside the bucket.

Shard boundaries keep groups of equal texts whole whenever a boundary between
two groups is within tolerance; a group too large for that is cut by id.  Where
so many rows share text and id (or have none) that no boundary falls near enough,
these rows, and only they, are cut by a hash of their place in the table, by the
same rounds; the table is then stored first, so that places stay the same.

Law ``bytes``: shard sizes differ from the mean by the tolerance, or by the
one row that no boundary can cut.

Defined results: a null text has size 1 and CRC 0; null ids are hashed as
null and sort last; repeated rows get slots of their own; an empty table gives
an empty result; extra columns are passed through, whatever their names, and one
named like an output column is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinline.llm.common import cut, quoted, shuffle_partitions

TOLERANCE = 0.001     # of a shard's ideal size
FINE_TOLERANCE = 0.5  # of a fine bucket's ideal size
PROBES = 16           # probes per open boundary and round
MAX_FINE = 1 << 12    # fine buckets in all; bounds the probe table
KEY_MIN, KEY_MAX = -(1 << 63), (1 << 63) - 1


def _array(keys: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, keys))), ",").cast("array<bigint>")


def _below(keys: list[int], c: Column) -> Column:
    """Number of keys <= c: binary search over a constant array of longs."""
    return _search(_array(keys), len(keys), c)


def _below_pairs(keys: list[tuple[int, int]], k: Column, s: Column) -> Column:
    """Number of (key, spread) pairs <= (k, s)."""
    if all(second == KEY_MIN for _, second in keys):
        return _below([first for first, _ in keys], k)
    table = F.arrays_zip(_array([x for x, _ in keys]).alias("k"), _array([x for _, x in keys]).alias("s"))
    return _search(table, len(keys), F.struct(k.alias("k"), s.alias("s")))


def _search(table: Column, size: int, c: Column) -> Column:
    if not size:
        return F.lit(0)
    n = F.lit(size)

    def step(acc: Column, jump: Column) -> Column:
        nxt = acc + jump
        return F.when((nxt <= n) & (F.get(table, F.least(nxt, n) - 1) <= c), nxt).otherwise(acc)

    return F.aggregate(F.array(*[F.lit(1 << i) for i in reversed(range(size.bit_length()))]), F.lit(0), step)


def find_splitters(narrow: DataFrame, total: int, targets: list[tuple[float, float]], key: str = "_k",
                   coarse: bool = True) -> list[tuple[int, int, int | None, int]]:
    """For each target (target bytes, tolerance bytes): a key k so that the
    bytes with key < k are within the tolerance, these bytes, and, where one
    single key holds the target, that key and the bytes below it (else None).
    Exact counts, narrowing bounds.

    narrow: columns ``key`` (long) and ``_size``; ``coarse``: probe between
    groups of equal upper halves first.
    """
    state = [[KEY_MIN, 0, KEY_MAX, total, None] for _ in targets]  # low key, bytes below, high key, bytes below, found
    while True:
        probes: set[int] = set()
        for s in state:
            if s[4] is None:
                lo, hi = s[0], s[2]
                # whole text groups first: probes on CRC steps while the bounds hold more than one CRC
                unit = 1 << 32 if coarse and (hi >> 32) - (lo >> 32) > 1 else 1
                span = (hi // unit) - (lo // unit)
                probes.update(p * unit for j in range(1, PROBES + 1)
                              if lo < (p := lo // unit + max(1, span * j // (PROBES + 1))) * unit < hi)
        if not probes:
            break
        keys = sorted(probes)
        got = {r["_p"]: r["_s"] for r in narrow.groupBy(_below(keys, F.col(key)).alias("_p"))
               .agg(F.sum("_size").alias("_s")).collect()}  # at most one row a probe
        run, below = 0, []
        for j in range(len(keys)):
            run += got.get(j, 0)
            below.append(run)
        for s, (target, tol) in zip(state, targets, strict=True):
            if s[4] is not None:
                continue
            for k, b in zip(keys, below, strict=True):
                if not s[0] < k < s[2]:
                    continue
                if b <= target and (b > s[1] or (b == s[1] and k > s[0])):
                    s[0], s[1] = k, b
                elif b >= target and (b < s[3] or (b == s[3] and k < s[2])):
                    s[2], s[3] = k, b
            near = min(((abs(s[1] - target), s[0], s[1]), (abs(s[3] - target), s[2], s[3])))
            if near[0] <= tol or s[2] - s[0] <= 1 or s[1] == s[3]:
                single = near[0] > tol and s[2] - s[0] <= 1 and s[3] > s[1]
                s[4] = (near[1], near[2], s[0] if single else None, s[1])
    return [s[4] if s[4] is not None else (s[0], s[1], None, s[1]) for s in state]


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
          fine_per_shard: int | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and
    ``grown_shard``; the only exchange of whole rows is the last one."""
    spark = docs.sparkSession
    new = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    kept = [c for c in docs.columns if c not in new]
    fine = fine_per_shard or max(1, min(MAX_FINE // shards, 4 * shuffle_partitions(spark) // shards))
    bytes_ = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    # the user's columns travel as one, so that no name can clash
    sized = docs.select(F.struct(*[quoted(c) for c in kept]).alias("_row"), F.col(id_col).alias("_id"),
                        (F.octet_length(bytes_) + 1).cast("long").alias("_size"), F.crc32(bytes_).cast("long").alias("_crc"))
    low = F.xxhash64("_id").bitwiseAND(F.lit((1 << 32) - 1))
    sized = sized.withColumn("_k", (F.col("_crc") - F.lit(1 << 31)) * F.lit(1 << 32) + low)

    narrow = cut(sized.select("_k", "_size"))
    total = narrow.agg(F.sum("_size")).first()[0] or 0
    count = shards * fine
    ideal = total / count
    targets = [(total * i / count, total / shards * tolerance if i % fine == 0 else ideal * FINE_TOLERANCE)
               for i in range(1, count)]
    found = find_splitters(narrow, total, targets) if total else []
    keys = [(k, KEY_MIN) for k, *_ in found]
    hot = {f[2] for f in found if f[2] is not None}  # at most one a boundary
    if hot:
        sized = cut(sized.withColumn("_s", F.xxhash64(F.monotonically_increasing_id())))
        narrow = cut(sized.select("_k", "_s", "_size"))
        for k in sorted(hot):
            mine = [i for i, f in enumerate(found) if f[2] == k]
            inside = cut(narrow.where(F.col("_k") == k).select("_s", "_size"))
            held = inside.agg(F.sum("_size")).first()[0]
            want = [(targets[i][0] - found[i][3], targets[i][1]) for i in mine]
            for i, (s, *_) in zip(mine, find_splitters(inside, held, want, "_s", coarse=False)):
                keys[i] = (k, s)
    else:
        sized = sized.withColumn("_s", F.lit(KEY_MIN).cast("long"))
        narrow = narrow.withColumn("_s", F.lit(KEY_MIN).cast("long"))
    bounds = sorted(keys[fine - 1::fine])         # the shards' boundaries
    cuts = sorted(set(keys) | set(bounds))
    at = (F.col("_k"), F.col("_s"))
    placed = sized.withColumn("_shard", _below_pairs(bounds, *at).cast("int")).withColumn("_f", _below_pairs(cuts, *at))
    # rows before each fine bucket: at most MAX_FINE rows
    counts = narrow.groupBy(_below_pairs(cuts, *at).alias("_f"), _below_pairs(bounds, *at).cast("int").alias("_shard")).agg(
        F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_shard").orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_f", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_f").orderBy("_k", F.coalesce(F.col("_id").cast("long"), F.lit(KEY_MAX)), "_s")
    ranked = placed.withColumn("_r", F.row_number().over(inside))
    out = ranked.join(F.broadcast(offsets), "_f")  # bounded by MAX_FINE
    return out.select(*[F.col("_row").getField(c).alias(c) for c in kept], F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
                      F.lit("bytes").alias("law"), F.col("_shard").alias("shard"),
                      (F.col("_off") + F.col("_r") - 1).cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Shard files in slot order: one folder a shard."""
    shard(docs, **options).write.partitionBy("shard").parquet(path)
