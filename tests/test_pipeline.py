"""C1 -> C2 -> C3 -> C4 -> C5 on real line files, end to end."""

import math

from pyspark.sql import functions as F

from twinline.functions import wordpiece as wp
from twinline.operators import counts
from twinline.plans import jobs
from twinline.sources import store, tables


def test_files_to_batches(spark, tmp_path):
    docs = tables.documents(spark, "/root/testdata/sf0.001").where(F.col("lang").isin("en", "fr")).collect()
    root = tmp_path / "corpora"
    expected = 0
    for corpus in ("europarl", "news"):
        d = root / corpus
        d.mkdir(parents=True)
        en = [ln for r in docs if r["lang"] == "en" for ln in r["text"].split("\n")][:300]
        fr = [ln for r in docs if r["lang"] == "fr" for ln in r["text"].split("\n")][:300]
        (d / f"{corpus}.en").write_text("\n".join(en) + "\n")
        (d / f"{corpus}.fr").write_text("\n".join(fr) + "\n")
        expected += min(len(en), len(fr))
    raw = str(tmp_path / "raw")
    pairs = jobs.build_pairs(spark, str(root), save_to=raw)
    assert pairs.count() == expected
    saved = store.read_dataset(spark, raw, store.RAW_SCHEMA)
    assert saved.where("split = 'test'").count() == math.ceil(0.005 * expected)

    res = jobs.train_vocab_from_files(spark, str(root), vocab_size=300, save_to=str(tmp_path / "vocab"))
    vdf = store.read_vocab(spark, str(tmp_path / "vocab"))
    assert vdf.count() == len(res.tokens) and store.read_merges(spark, str(tmp_path / "vocab")).count() > 0
    tgt_vocab = wp.Vocabulary.from_df(vdf)
    src_vocab = wp.Vocabulary.from_df(counts.vocab_freq(counts.word_counts(saved, "english"), 500))

    tok = jobs.tokenize_saved(spark, raw, str(tmp_path / "tok"), src_vocab, tgt_vocab)
    assert tok.where(F.size("tgt_ids") <= 5).count() == 0
    assert tok.where(F.element_at("tgt_ids", 1) != 2).count() == 0

    batches = jobs.collate(tok.where("split = 'train'"), batch_size=32, seed=3, epoch=1)
    n_train = tok.where("split = 'train'").count()
    assert batches.count() == n_train
    assert batches.agg(F.max("batch_id")).first()[0] == (n_train - 1) // 32
    chk = batches.where(F.size("tgt_input_ids") != F.size("tgt_outputs"))
    assert chk.count() == 0


def test_token_to_id(spark):
    v = spark.createDataFrame([("a", 4), ("b", 5)], "token string, id int")
    t = spark.createDataFrame([("a",), ("zz",)], "tok string")
    got = {r["tok"]: r["id"] for r in counts.token_to_id(t, "tok", v).collect()}
    assert got == {"a": 4, "zz": None}
