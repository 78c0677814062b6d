"""Stored epochs, bucketed token tables, rebalanced datasets, mergeable counts."""

import glob
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from twinline.operators import counts
from twinline.plans import jobs
from twinline.sources import counted, epochs, store


def tokens(spark, n, parts=4):
    rows = spark.range(n, numPartitions=parts).select(
        F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("corpus"), F.col("id").alias("line_no"),
        F.sequence(F.lit(0), (F.col("id") % 7).cast("int")).alias("src_ids"), F.sequence(F.lit(0), (F.col("id") % 5 + 2).cast("int")).alias("tgt_ids"))
    return rows.withColumn("split", F.when(F.col("line_no") % 50 == 0, "test").otherwise("train"))


def order_of(n, seed, epoch):
    keys = [(f"c{i % 3}", i) for i in range(n)]
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{epoch}:{k[0]}:{k[1]}".encode()).hexdigest(), k))


@pytest.mark.parametrize("files,batch", [(5, 8), (1, 64), (7, 1000), (None, 7)])
def test_epoch_files_hold_the_order(spark, tmp_path, files, batch):
    n, path = 500, str(tmp_path / "e")
    epochs.write_epoch(tokens(spark, n), path, ["corpus", "line_no"], 42, 3, batch, files)
    got = sorted(epochs.read_epoch(spark, path).collect(), key=lambda r: r["rank"])
    assert [(r["corpus"], r["line_no"]) for r in got] == order_of(n, 42, 3)
    assert [r["rank"] for r in got] == list(range(n))
    assert all(r["batch_id"] == r["rank"] // batch and r["pos"] == r["rank"] % batch for r in got)
    last = (n - 1) // batch
    for wanted in ([0], [last], [1, last], [last + 5], [0, 0, last + 1]):
        rows = epochs.read_batches(spark, path, wanted).collect()
        assert sorted((r["rank"], r["corpus"], r["line_no"], r["file"], r["offset"]) for r in rows) == [
            (r["rank"], r["corpus"], r["line_no"], r["file"], r["offset"]) for r in got if r["batch_id"] in wanted]


def test_a_batch_opens_only_its_files(spark, tmp_path):
    path = str(tmp_path / "e")
    epochs.write_epoch(tokens(spark, 800), path, ["corpus", "line_no"], 1, 0, 10, 8)
    assert len(glob.glob(f"{path}/rows/*.parquet")) >= 6
    one = epochs.read_batches(spark, path, [33])
    assert len(one.inputFiles()) <= 2 + 1  # its rows' files (and the broadcast manifest has none)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(epoch_key" in plan


def test_empty_epoch(spark, tmp_path):
    path = str(tmp_path / "e")
    epochs.write_epoch(tokens(spark, 10).where("false"), path, ["corpus", "line_no"], 1, 0, 10)
    assert epochs.read_epoch(spark, path).count() == 0


def test_bucketed_tokens_join_without_an_exchange(spark, tmp_path):
    train = tokens(spark, 3000).where("split = 'train'")
    table = store.write_bucketed(train, "tokens_bucketed_test", str(tmp_path / "b"), ["corpus", "line_no"], 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as when the layout is large
    try:
        out = jobs.collate(table, 16, 7, 0, True)
        plan = out._jdf.queryExecution().executedPlan().toString()
        scan = next(i for i, line in enumerate(plan.splitlines()) if "Scan" in line and "tokens_bucketed_test" in line or "Bucketed: true" in line)
        lines = plan.splitlines()
        depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
        above = []
        for line in reversed(lines[:scan]):
            d = len(line) - len(line.lstrip(" :+-"))
            if d < depth:
                above.append(line)
                depth = d
        join = next(i for i, line in enumerate(above) if "Join" in line)
        assert not any("Exchange" in line for line in above[:join]), plan
        want = {(r["corpus"], r["line_no"]): (r["batch_id"], r["pos"], r["tgt_outputs"]) for r in jobs.collate(train, 16, 7, 0, True).collect()}
        assert {(r["corpus"], r["line_no"]): (r["batch_id"], r["pos"], r["tgt_outputs"]) for r in out.collect()} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE tokens_bucketed_test")


def test_files_of_a_dataset_are_near_the_target_size(spark, tmp_path):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        wide = tokens(spark, 20_000, 40).withColumn("src_ids", F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.hash("line_no", i)))
        store.write_dataset(wide, str(tmp_path / "d"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    sizes = {s: [os.path.getsize(f) for f in glob.glob(f"{tmp_path}/d/split={s}/*.parquet")] for s in ("train", "test")}
    assert len(sizes["test"]) <= 2                        # not one a task
    assert 4 <= len(sizes["train"]) <= 40                 # the large split is cut
    assert max(sizes["train"]) < 4 * sorted(sizes["train"])[len(sizes["train"]) // 2]
    assert store.read_dataset(spark, str(tmp_path / "d")).count() == 20_000


def test_counts_grow_by_new_files_alone(spark, tmp_path):
    texts = [("a b a", "x"), ("b c", "x"), ("a d", None), ("a", "y")]
    where, stored = str(tmp_path / "corpus"), str(tmp_path / "store")
    for k, row in enumerate(texts):
        spark.createDataFrame([row], "text string, lang string").coalesce(1).write.mode("append").parquet(where)
        assert len(counted.new_files(spark, f"{where}/*.parquet", stored).collect()) == 1
        assert counted.add_files(spark, f"{where}/*.parquet", stored, by=["lang"]) == 1
        assert counted.add_files(spark, f"{where}/*.parquet", stored, by=["lang"]) == 0
        want = counts.word_counts(spark.createDataFrame(texts[:k + 1], "text string, lang string"), by=["lang"])
        got = counted.stored_counts(spark, stored, by=["lang"])
        key = lambda r: repr(tuple(r))
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr), key
    assert counted.manifest(spark, stored).select("increment").distinct().count() == 4
    # counts whose commit never came are not read
    spark.createDataFrame([("x", "zzz", 5, "lost")], "lang string, word string, count long, increment string").write.mode("append").partitionBy(
        "increment").parquet(f"{stored}/counts")
    assert counted.stored_counts(spark, stored, by=["lang"]).where("word = 'zzz'").count() == 0
    # a file that was counted must stay as it is
    name = glob.glob(f"{where}/*.parquet")[0]
    os.utime(name, (1, 1))
    with pytest.raises(counted.ChangedFileError):
        counted.add_files(spark, f"{where}/*.parquet", stored, by=["lang"])


def test_counts_of_text_files(spark, tmp_path):
    (tmp_path / "a.fr").write_text("le chat\nle chien\n")
    stored = str(tmp_path / "store")
    assert counted.stored_counts(spark, stored).count() == 0
    counted.add_files(spark, str(tmp_path / "*.fr"), stored, format="text")
    (tmp_path / "b.fr").write_text("le chat")
    assert counted.add_files(spark, str(tmp_path / "*.fr"), stored, format="text") == 1
    assert {r["word"]: r["count"] for r in counted.stored_counts(spark, stored).collect()} == {"le": 3, "chat": 2, "chien": 1}
