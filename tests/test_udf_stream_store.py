"""D1-D3 wrappers, the streaming wiring and the dataset/vocab stores."""

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from twinline.constants import SPECIAL_TOKENS
from twinline.functions import decode as dec
from twinline.functions import wordpiece as wp
from twinline.operators import udf
from twinline.sources import store
from twinline.sources.store import RAW_SCHEMA
from twinline.streaming import start_tokenize_files, tokenize_stream


def test_map_filter_apply(spark):
    df = spark.createDataFrame([(i, f"w{i}") for i in range(20)], "id long, s string")
    m = udf.map_batches(df, lambda b: pa.RecordBatch.from_arrays(
        [b.column(0), pc.utf8_length(b.column(1))], names=["id", "n"]), "id long, n int")
    assert sorted(r["n"] for r in m.collect()) == [2] * 10 + [3] * 10
    f = udf.filter_batches(df, lambda ids: pc.greater(ids, 14), "id")
    assert sorted(r["id"] for r in f.collect()) == [15, 16, 17, 18, 19]
    g = udf.apply_per_batch(df.withColumn("b", F.col("id") % 3), "b",
                            lambda t: pa.table({"b": [t.column("b")[0].as_py()], "n": [t.num_rows]}),
                            "b long, n long")
    assert sorted((r["b"], r["n"]) for r in g.collect()) == [(0, 7), (1, 7), (2, 6)]


def _vocab():
    toks = list(SPECIAL_TOKENS) + ["le", "chat", "the", "cat", "a", "b", "##b", "."]
    return wp.Vocabulary({t: i for i, t in enumerate(toks)})


def test_stream_matches_batch(spark, tmp_path):
    v = _vocab()
    rows = [("c", 0, "The cat.", "Le chat le chat.", "train"), ("c", 1, "a b", "ab le", "test")]
    src = tmp_path / "in"
    spark.createDataFrame(rows, RAW_SCHEMA).write.parquet(str(src))
    q = start_tokenize_files(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ckpt"), v, v)
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = tokenize_stream(spark.createDataFrame(rows, RAW_SCHEMA), v, v)
    cols = ["corpus", "line_no", "split", "src_ids", "tgt_ids"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))
    assert got.count() == 1  # "ab le" -> [BOS] a ##b le [EOS]: 5 ids, not more than 5


def test_dataset_and_vocab_round_trip(spark, tmp_path):
    v = spark.createDataFrame([("[UNK]", 0), ("x", 1)], "token string, id int")
    store.write_vocab(v, str(tmp_path / "v"))
    assert sorted(store.read_vocab(spark, str(tmp_path / "v")).collect()) == sorted(v.collect())
    t = spark.createDataFrame([("c", 0, [2, 3], [2, 5, 3], "train"), ("c", 1, [2, 3], [2, 3], "test")],
                              store.TOKEN_SCHEMA)
    store.write_dataset(t, str(tmp_path / "d"))
    back = store.read_dataset(spark, str(tmp_path / "d"))
    assert back.where("split = 'test'").count() == 1
    assert sorted(map(tuple, back.select(t.columns).collect())) == sorted(map(tuple, t.collect()))


def test_metric_commits_are_idempotent(spark, tmp_path):
    log = str(tmp_path / "m")
    options = {"steps_per_folder": 2}
    steps = spark.createDataFrame([(0, s, 1.5 - s / 10, 0.5) for s in range(4)], "epoch int, step long, train_loss double, accuracy double")
    tests = spark.createDataFrame([(0, 2.5, 0.25), (3, 1.5, 0.5)], "step long, test_loss double, test_acc double")
    store.append_metrics(steps, log, "a", **options)
    store.append_metrics(tests, log, "a", "eval", **options)
    once = sorted(map(tuple, store.read_metrics(spark, log).collect()), key=repr)
    assert len(once) == 6
    store.append_metrics(steps, log, "a", **options)                      # a job that runs again
    store.append_metrics(steps.where("step >= 2"), log, "a", **options)   # a resumed one
    store.append_metrics(tests, log, "a", "eval", **options)
    assert sorted(map(tuple, store.read_metrics(spark, log).collect()), key=repr) == once
    # a step that is logged anew replaces itself alone; another run is another series
    store.append_metrics(steps.where("step = 1").withColumn("train_loss", F.lit(9.0)), log, "a", **options)
    store.append_metrics(steps, log, "b", **options)
    got = store.read_metrics(spark, log)
    assert got.where("run = 'a' and kind = 'train'").count() == 4 and got.where("run = 'b'").count() == 4
    assert [r["train_loss"] for r in got.where("run = 'a' and step = 1 and kind = 'train'").collect()] == [9.0]
    assert got.where("kind = 'eval'").where("train_loss is null and epoch is null").count() == 2


def test_decode_lists(spark):
    v = _vocab()
    df = spark.createDataFrame([([[2, 4, 5, 3], [2, 8, 10, 11, 3], [], None],), (None,), ([],)], "ids array<array<int>>")
    got = [r[0] for r in df.select(dec.decode_list("ids", v)).collect()]
    assert got == [["le chat", "ab.", "", None], None, []]
    kept = df.select(dec.decode_list("ids", v, skip_special_tokens=False)).first()[0]
    assert kept == ["[BOS] le chat [EOS]", "[BOS] ab. [EOS]", "", None]
    texts = spark.createDataFrame([(["le chat", "ab."],)], "texts array<string>")
    back = wp.encode_list(texts, "texts", v).select(dec.decode_list("ids", v)).first()[0]
    assert back == ["le chat", "ab."]


def test_bert_style_source_vocab(spark, tmp_path):
    p = tmp_path / "vocab.txt"
    toks = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "hello", "world", "!", "wo", "##rld", "cafe"]
    p.write_text("\n".join(toks) + "\n")
    vdf = store.read_vocab_lines(spark, str(p))
    assert sorted((r["id"], r["token"]) for r in vdf.collect()) == list(enumerate(toks))
    v = wp.Vocabulary.from_df(vdf)
    df = spark.createDataFrame([("Hello, World! Café",)], "t string")
    ids = df.select(wp.encode(F.col("t"), v, spark, wp.BERT_SOURCE, True, 512)).first()[0]
    assert ids == [2, 4, 1, 5, 6, 9, 3]
