"""The distributed scan: bounded windows whatever the order's distribution."""

import random

import pytest
from pyspark.sql import functions as F

from twinline.operators import align
from twinline.operators.numbering import ordered_blocks, prefix_offsets
from twinline.operators.skew import join_hot

BLOCK = 500


def ids_of(kind):
    rnd = random.Random(1)
    if kind == "outlier":  # dense ids and one far off
        return [*range(20_000), 4 * 10**18]
    if kind == "hashed":
        return list({rnd.randint(-(1 << 62), 1 << 62) for _ in range(20_000)})
    return list(range(20_000))


@pytest.mark.parametrize("kind", ["dense", "outlier", "hashed", "hot group", "null group"])
def test_windows_are_bounded(spark, kind):
    rows = [(i, "hot" if kind == "hot group" and k % 3 else None if kind == "null group" and k % 3 else f"g{k % 5}", k % 7)
            for k, i in enumerate(ids_of(kind))]
    df = spark.createDataFrame(rows, "id long, g string, w long").repartition(6)
    blocks = ordered_blocks(df, [F.col("g").asc_nulls_last(), F.col("id")], BLOCK)
    sizes = [r["count"] for r in blocks.groupBy("_scan_block").count().collect()]
    assert max(sizes) <= BLOCK and sum(sizes) == len(rows)
    assert len(sizes) <= len(rows) / BLOCK + 8  # as many as needed and one a partition
    got = {(r["g"], r["id"]): r["o"] for r in prefix_offsets(df, ["g"], "id", "w", "o", BLOCK).collect()}
    run: dict = {}
    for i, g, w in sorted(rows, key=lambda r: r[0]):
        assert got[g, i] == run.get(g, 0)
        run[g] = run.get(g, 0) + w
    assert len(got) == len(rows)


def test_lines_of_a_hot_id(spark):
    """A third of the rows without an id, another third under one id."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"t{i} a\nt{i} b", "en", "s") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    got = {r["line_no"]: r["text"] for r in align.corpus_lines(df, block_rows=64).collect()}
    assert sorted(got) == list(range(6000))
    place = {f"t{i} {c}": (d is None, d or 0, c) for i, (d, *_) in enumerate(rows) for c in "ab"}
    keys = [place[got[n]] for n in range(6000)]
    assert keys == sorted(keys)


def test_join_hot(spark):
    rows = [(None if i % 3 == 0 else i % 3 if i % 2 else i, i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(4)
    look = df.select("k").distinct().withColumn("x", F.coalesce(F.col("k") * 10, F.lit(-1)))
    got = sorted((r["v"], r["x"]) for r in join_hot(df, look, ["k"], least=100).collect())
    assert got == sorted((v, -1 if k is None else k * 10) for k, v in rows)
    some = look.where("k > 2 or k is null")
    left = {r["v"]: r["x"] for r in join_hot(df, some, ["k"], "left", least=100).collect()}
    assert left == {v: -1 if k is None else k * 10 if k > 2 else None for k, v in rows}
