"""Line numbering, positional zip, split: invariants and partition independence."""

import math
import os
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from twinline.plans import jobs
from twinline.operators import align, split
from twinline.operators.numbering import hash_rank, prefix_offsets
from twinline.sources import files, tables

SF01 = "/root/testdata/sf0.01"


def test_corpus_lines_counts(spark):
    cl = align.corpus_lines(tables.documents(spark, SF01))
    got = {r["lang"]: r["count"] for r in cl.groupBy("lang").count().collect()}
    assert got == {"en": 5651, "fr": 1398, "de": 1320, "es": 975}
    # line numbers are dense 0..n-1 per (corpus, lang)
    chk = cl.groupBy("corpus", "lang").agg(F.min("line_no").alias("lo"), F.max("line_no").alias("hi"),
                                           F.count(F.lit(1)).alias("n"), F.countDistinct("line_no").alias("d"))
    assert chk.where((F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1) | (F.col("d") != F.col("n"))).count() == 0


def test_prefix_offsets_small_blocks_equal_large_blocks(spark):
    docs = tables.documents(spark, SF01).select("doc_id", "source", "lang", F.length("text").cast("long").alias("w"))
    a = prefix_offsets(docs, ["source", "lang"], "doc_id", "w", "o", block_rows=7)
    b = prefix_offsets(docs, ["source", "lang"], "doc_id", "w", "o", block_rows=1 << 20)
    assert a.select("doc_id", "o").exceptAll(b.select("doc_id", "o")).count() == 0


@pytest.mark.parametrize("ids", ["unique", "any"])
def test_corpus_lines_of_null_groups_and_odd_ids(spark, ids):
    rows = []
    for i in range(60):
        text = None if i % 13 == 5 else "\n".join(f"d{i} l{p}" for p in range(i % 4 + 1))
        doc_id = i if ids == "unique" else (None if i % 7 == 3 else i // 4 if i % 3 == 0 else i)
        rows.append((doc_id, text, [None, "en", "fr"][i % 3], [None, "s1"][i % 2]))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    want = defaultdict(list)
    for doc_id, text, lang, source in rows:
        for pos, line in enumerate(text.split("\n") if text is not None else []):
            want[source, lang].append(((doc_id is None, doc_id or 0, pos), line))
    results = []
    for parts in (1, 5):
        got = defaultdict(dict)
        found = align.corpus_lines(df.repartition(parts, F.rand(parts)), block_rows=4).collect()
        for r in found:
            got[r["corpus"], r["lang"]][r["line_no"]] = r["text"]
        assert len(found) == sum(map(len, want.values())) and set(got) == set(want)
        for group, lines in want.items():
            assert sorted(got[group]) == list(range(len(lines)))
            place = {line: key for key, line in lines}
            # every line once, in (doc_id, position) order; lines are different
            assert sorted(got[group].values()) == sorted(place)
            keys = [place[got[group][n]] for n in range(len(lines))]
            assert keys == sorted(keys)
        results.append(got)
    assert results[0] == results[1]


def test_pairs_and_strict_mode(spark):
    cl = align.corpus_lines(tables.documents(spark, SF01))
    assert align.language_pairs(cl).count() == 1398
    with pytest.raises(align.AlignmentError):
        align.language_pairs(cl, mode="strict").count()
    same = cl.where(F.col("lang") == "fr")
    assert align.positional_zip(same, same, mode="strict").count() == 1398


def test_turn_pairs(spark):
    assert align.turn_pairs(tables.conversations(spark, SF01)).count() == 233


def test_concat_empty_raises():
    with pytest.raises(ValueError):
        align.concat_corpora([])


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_split_exact_and_partition_independent(spark, parts):
    pairs = align.language_pairs(align.corpus_lines(tables.documents(spark, SF01))).repartition(parts)
    s = split.train_test_split(pairs, ["corpus", "line_no"], 0.005, seed=7)
    rows = {(r["corpus"], r["line_no"]): r["split"] for r in s.collect()}
    assert len(rows) == 1398
    test = sorted(k for k, v in rows.items() if v == "test")
    assert len(test) == math.ceil(0.005 * 1398)
    # the same rows whatever the partitioning, and a larger share is a superset
    base = split.train_test_split(pairs.coalesce(1), ["corpus", "line_no"], 0.005, seed=7)
    assert sorted((r["corpus"], r["line_no"]) for r in base.where("split = 'test'").collect()) == test
    big = split.train_test_split(pairs, ["corpus", "line_no"], 0.3, seed=7, n_rows=1398)
    bigtest = {(r["corpus"], r["line_no"]) for r in big.where("split = 'test'").collect()}
    assert len(bigtest) == math.ceil(0.3 * 1398) and set(test) <= bigtest


def test_hash_rank_is_a_permutation(spark):
    df = spark.range(5000).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("h"))
    for digits in (1, 2, 3):
        r = hash_rank(df, "h", ["id"], digits)
        got = [row["id"] for row in r.orderBy("rank").collect()]
        assert got == [row["id"] for row in df.orderBy("h", "id").collect()]
        assert r.agg(F.min("rank"), F.max("rank")).first() == (1, 5000)


def test_files_discover_and_read_lines(spark, tmp_path):
    root = tmp_path / "root"
    for corpus, n in (("c1", 3000), ("c2", 5)):
        d = root / corpus
        d.mkdir(parents=True)
        (d / f"{corpus}.en").write_text("".join(f"en {corpus} {i}\n" for i in range(n)))
        (d / f"{corpus}.fr").write_text("".join(f"fr {corpus} {i}\n" for i in range(n)))
    (root / "only_en").mkdir()
    (root / "only_en" / "x.en").write_text("a\n")
    (root / "stray.fr").write_text("top level\n")
    found = files.discover_pairs(spark, str(root))
    assert [r["corpus"] for r in found.collect()] == ["c1", "c2"]
    # force many splits per file
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        en = files.read_corpus_lines(spark, str(root), found, "src", ".en")
        fr = files.read_corpus_lines(spark, str(root), found, "tgt", ".fr")
        assert en.select("file_path" if "file_path" in en.columns else "corpus").count() == 3005
        bad = en.where(F.col("text") != F.concat(F.lit("en "), F.col("corpus"), F.lit(" "),
                                                 F.col("line_no").cast("string")))
        assert bad.count() == 0
        z = align.positional_zip(en, fr, mode="strict")
        assert z.where(F.substring("english", 4, 100) != F.substring("french", 4, 100)).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    (root / "c2" / "other.fr").write_text("x\n")
    with pytest.raises(files.DiscoveryError):
        files.discover_pairs(spark, str(root))
    assert files.glob_lang_files(str(root)).endswith("/*/*.fr")
    assert os.path.isdir(root)


def test_read_lines_gzip_and_plain_mix(spark, tmp_path):
    import gzip
    d = tmp_path / "c"
    d.mkdir()
    with gzip.open(d / "a.txt.gz", "wt") as fh:
        fh.write("".join(f"g{i}\n" for i in range(2500)))
    (d / "b.txt").write_text("".join(f"p{i}\n" for i in range(2500)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        lines = files.read_lines(spark, [str(d / "a.txt.gz"), str(d / "b.txt")])
        got = {(r["file_path"].rsplit("/", 1)[-1], r["line_no"]): r["text"] for r in lines.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 5000
    assert all(got[("a.txt.gz", i)] == f"g{i}" and got[("b.txt", i)] == f"p{i}" for i in range(2500))


ODD_NAMES = ["common crawl", "a%20b", "c[1]", "é+ü", "x{y,z}", "plain", "q?r*s"]


@pytest.mark.parametrize("parent", ["root", "odd [root] 1%2"])
def test_no_line_is_lost_in_odd_directories(spark, tmp_path, parent):
    root = tmp_path / parent
    for name in ODD_NAMES:
        (root / name).mkdir(parents=True)
        for lang in ("en", "fr"):
            (root / name / f"{name} file.{lang}").write_text("".join(f"{lang} {name} {i}\n" for i in range(3)))
    (root / "half").mkdir()
    (root / "half" / "x.en").write_text("lonely\n")
    pairs = jobs.build_pairs(spark, str(root), mode="strict")
    got = sorted((r["corpus"], r["line_no"], r["english"], r["french"]) for r in pairs.collect())
    assert got == sorted((n, i, f"en {n} {i}", f"fr {n} {i}") for n in ODD_NAMES for i in range(3))
    texts = spark.read.text(files.glob_lang_files(str(root))).collect()
    assert len(texts) == 3 * len(ODD_NAMES)


def test_strict_mode_notices_a_corpus_without_lines(spark, tmp_path):
    (tmp_path / "c").mkdir()
    for lang in ("en", "fr"):
        (tmp_path / "c" / f"x.{lang}").write_text("one\n")
    found = files.discover_pairs(spark, str(tmp_path))
    lines = files.read_corpus_lines(spark, str(tmp_path), found, "src", ".en")
    files.check_all_read(found, lines, "src")
    with pytest.raises(files.DiscoveryError, match="no line"):
        files.check_all_read(found, lines.where("false"), "src")
