import zlib

import pytest
from pyspark.sql import functions as F

from twinline.llm.sharding import TOLERANCE, shard, write_shards


def check(rows, got, shards):
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert set(by) <= set(range(shards))
    for v in by.values():
        assert sorted(r["slot"] for r in v) == list(range(len(v)))
    return {k: sum(r["size"] for r in v) for k, v in by.items()}


def test_edge_rows(edge, empty):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    out = shard(edge, shards=3)
    check(rows, out.collect(), 3)
    assert out.schema["shard"].dataType.simpleString() == "int"
    assert shard(empty, shards=3).count() == 0


@pytest.mark.parametrize("fine", [1, 20])
def test_hot_text_is_cut_and_shards_are_level(spark, fine):
    rows = [(i, "hot " * 20 if i % 3 else f"own text {i} " * (1 + i % 40)) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sizes = check(rows, shard(df, shards=8, fine_per_shard=fine).collect(), 8)
    ideal = sum(sizes.values()) / 8
    largest = max(len(t.encode()) + 1 for _, t in rows)
    assert len(sizes) == 8 and all(abs(s - ideal) <= 2 * (ideal * TOLERANCE + largest) for s in sizes.values())


def test_groups_stay_whole_when_they_can(docs):
    out = shard(docs, shards=8)
    assert out.groupBy("text").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0
    again = shard(docs.repartition(13), shards=8)
    key = ["doc_id", "shard", "slot"]
    assert sorted(map(tuple, out.select(key).collect())) == sorted(map(tuple, again.select(key).collect()))


def test_shard_files(spark, docs, tmp_path):
    write_shards(docs, str(tmp_path / "s"), shards=4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 4


@pytest.mark.parametrize("fine", [1, 12])
@pytest.mark.parametrize("ids", ["null", "one", "both"])
def test_equal_rows_are_cut(spark, ids, fine):
    """A third (or two) of the rows share id and text."""
    rows = [(i, "own text " * (1 + i % 40)) for i in range(4000)]
    rows += [(None, "the same text " * 3)] * (3000 if ids != "one" else 0) + [(17, "the same text " * 3)] * (3000 if ids != "null" else 0)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sizes = check(rows, shard(df, shards=8, fine_per_shard=fine).collect(), 8)
    ideal = sum(sizes.values()) / 8
    assert len(sizes) == 8 and all(abs(s - ideal) <= 0.01 * ideal for s in sizes.values())


def test_columns_pass_through_whatever_their_names(spark):
    names = ["_k", "_f", "_r", "_off", "_n", "_s", "_row", "_id", "_size", "_crc", "_shard", "_copy", "_copies", "_key", "odd.name"]
    rows = [(i, f"text {i % 7}", *[f"{n}{i}" for n in names]) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    got = shard(df.repartition(3), shards=3).collect()
    assert sorted(tuple(r)[:2 + len(names)] for r in got) == sorted(rows)
