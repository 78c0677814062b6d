import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from plain_simhash import plain_components, plain_fingerprint

import corpus_pipeline
from twinline.llm import bpe, language_id
from twinline.llm.mixing import mix


@pytest.fixture(scope="module")
def outputs(spark, docs, tmp_path_factory):
    """Each stage's rows, made as run() makes them."""
    out, now = [], docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("p") / name)
        stage(spark, now, "").write.parquet(path)
        now = spark.read.parquet(path)
        out.append(now)
    return out


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_columns(docs, outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash", "mixing", "bpe"]
    assert all(sorted(o.dtypes) == sorted(docs.dtypes) for o in outputs[:-1])


def test_language_stage(docs, outputs):
    model = language_id.train(docs.where(~language_id.held_out()))
    want = {r["doc_id"] for r in language_id.predict(docs, model).collect() if r["lang_pred"] != language_id.UND and r["score"] >= 0.3}
    assert set(rows(outputs[0])) == want and len(want) > 950


def test_dedup_stages(outputs):
    before, after = rows(outputs[0]), rows(outputs[1])
    best = {}
    for i, t in before.items():
        k = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best[k] = min(best.get(k, (0, float("inf"))), (-len(t or ""), i))
    assert set(after) == {i for _, i in best.values()}
    comp = plain_components({i: plain_fingerprint(t) for i, t in sorted(after.items())})
    assert set(rows(outputs[2])) == set(comp.values())


def test_mixing_and_tokens(outputs):
    copies = {r["doc_id"]: r["copies"] for r in mix(outputs[2]).collect() if r["copies"]}
    mixed = outputs[3].select("doc_id", "text").collect()
    assert Counter(r["doc_id"] for r in mixed) == copies
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))

    def want(r):
        ids = np.array(lib.encode_ordinary(r["text"]), "<u4")
        return r["doc_id"], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()

    assert sorted(map(tuple, outputs[4].select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == sorted(map(want, mixed))


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_edge_rows(spark, edge, empty, stage):
    got = stage(spark, edge, "")
    n = got.count()
    assert n <= 3 * edge.count()
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert got.columns == edge.columns
        if stage is corpus_pipeline.exact_copies:
            assert n == 5
        if stage is corpus_pipeline.near_copies:
            assert n == len({plain_fingerprint(r["text"]) for r in edge.collect()})
    assert stage(spark, empty, "").count() == 0
