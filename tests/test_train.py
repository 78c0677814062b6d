"""Distributed WordPiece training against a plain sequential merge loop."""

import random

import pytest
from pyspark.sql import functions as F
from sequential_wordpiece import sequential_wordpiece

from twinline.operators import counts
from twinline.operators import wordpiece_train as wt
from twinline.operators.wordpiece_train import train_wordpiece

LINES = ["aaab aab ab ab abc", "bc bca cab été été école", "aaaa aaaa abab abab"]
SMALL = {"plan_pairs": 4, "plan_runs": 6}  # many rounds


@pytest.mark.parametrize("options", [{}, SMALL, {"plan_pairs": 1}])
@pytest.mark.parametrize("v,size", [(8, 20), (1000, 38)])
def test_fixture_corpus(spark, v, size, options):
    df = spark.createDataFrame([(l,) for l in LINES], "text string")
    r = train_wordpiece(df, vocab_size=v, **options)
    wc = {row["word"]: row["count"] for row in counts.word_counts(df).collect()}
    assert len(r.tokens) == size
    assert r.tokens == sequential_wordpiece(wc, v)
    assert r.vocab.count() == size
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"  # settings are left alone


def test_random_corpora(spark):
    rnd = random.Random(11)
    for trial in range(3):
        words = ["".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 7))) for _ in range(60)]
        lines = [" ".join(rnd.choice(words) for _ in range(12)) for _ in range(20)]
        df = spark.createDataFrame([(l,) for l in lines], "text string")
        wc = {row["word"]: row["count"] for row in counts.word_counts(df).collect()}
        wide = train_wordpiece(df, vocab_size=80)
        assert wide.tokens == sequential_wordpiece(wc, 80), trial
        if trial == 0:  # many small rounds give the same merges
            small = train_wordpiece(df, vocab_size=80, **SMALL)
            assert small.rounds > 3 * wide.rounds
            assert small.tokens == wide.tokens and small.merges.collect() == wide.merges.collect()


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'fr'")
    wc = {row["word"]: row["count"] for row in counts.word_counts(df).collect()}
    assert train_wordpiece(df, vocab_size=600).tokens == sequential_wordpiece(wc, 600)


def loop(words, weight, tokens, vocab_size, cut=(0, 1 << 40, 0)):
    ids = {t: i for i, t in enumerate(tokens)}
    return wt.plan_merges(words, weight, cut, tokens, ids, vocab_size, "##")


def test_planning_stops_at_the_cut_and_after_a_known_token():
    tokens = ["a", "b", "##a", "##b", "ab"]
    # (a, ##b) makes a token that exists: the round ends with it
    assert loop([[0, 3], [1, 2]], [5, 3], list(tokens), 100) == [(0, 3, 4, 5)]
    # nothing below the cut is planned
    assert loop([[1, 2], [1, 3]], [5, 3], list(tokens), 100, cut=(-4, 9, 9)) == [(1, 2, 5, 5)]


def test_rounds_plan_what_the_whole_table_would(spark):
    """Runs of any K first pairs give a prefix of the merges of all words."""
    rnd = random.Random(5)
    words = list({"".join(rnd.choice("abcd") for _ in range(rnd.randint(2, 8))) for _ in range(200)})
    n = [rnd.randint(1, 50) for _ in words]
    tokens = [*"abcd", *("##" + c for c in "abcd")]
    syms = [["abcd".index(w[0]), *(4 + "abcd".index(c) for c in w[1:])] for w in words]
    full = loop(syms, n, list(tokens), 60)
    df = spark.createDataFrame(list(zip(n, syms)), "n long, syms array<int>").repartition(3).cache()
    ranked = [(r["left_id"], r["right_id"], r["count"]) for r in counts.best_pairs(counts.pair_counts(df), 100).collect()]
    sizes = []
    for k in (1, 3, 7, len(ranked)):
        got = wt.runs_of(df, [(a, b) for a, b, _ in ranked[:k]]).collect()
        a, b, c = ranked[k - 1]
        plan = loop([list(r["run"]) for r in got], [r["n"] for r in got], list(tokens), 60, cut=(-c, a, b))
        assert plan == full[:len(plan)] and len(plan) >= 1
        sizes.append(len(got))
    assert sizes == sorted(sizes) and sizes[-1] == len(words)


def test_deltas_come_from_touched_words_alone(spark):
    """Counts plus signed changes equal a full recount, and only words that
    hold a merge send rows to the shuffle."""
    rnd = random.Random(3)
    rows = [(rnd.randint(1, 9), [rnd.randint(0, 11) for _ in range(rnd.randint(2, 9))]) for _ in range(400)]
    df = spark.createDataFrame(rows, "n long, syms array<int>").repartition(4).cache()
    merges = [(0, 1, 12, 0), (2, 2, 13, 0), (12, 3, 14, 0)]
    after = wt.apply_merges(df, merges).cache()

    def plain(syms):
        for a, b, new, _ in merges:
            syms = wt._merged(syms, (a, b), new)
        return syms

    assert sorted((r["n"], r["syms"]) for r in after.collect()) == sorted((n, plain(s)) for n, s in rows)
    touched = [(n, s) for n, s in rows if plain(s) != s]
    assert 0 < len(touched) < len(rows)
    assert after.where("before is not null").count() == len(touched)
    moved = counts.pair_rows(after.where("before is not null").select("n", F.col("before").alias("syms"))).count()
    assert moved == sum(len(s) - 1 for _, s in touched)
    kept = counts.pair_counts(df).unionByName(wt.pair_deltas(after)).groupBy("left_id", "right_id").agg(
        F.sum("count").alias("count")).where("count > 0")
    again = counts.pair_counts(after)
    assert kept.exceptAll(again).count() == 0 and again.exceptAll(kept).count() == 0


def test_a_later_merge_does_not_reuse_an_earlier_one():
    """Symbols that a round's last merge makes again stay as they are."""
    order = [(5, 1, 9, 0), (0, 2, 5, 0)]  # (5, 1) first; then 0, 2 become 5 beside a 1
    syms = [0, 2, 1]
    for a, b, new, _ in order:
        syms = wt._merged(syms, (a, b), new)
    assert syms == [5, 1]


def test_reused_token_on_a_table(spark):
    df = spark.createDataFrame([(1, [0, 2, 1]), (1, [5, 1])], "n long, syms array<int>")
    got = wt.apply_merges(df, [(5, 1, 9, 0), (0, 2, 5, 0)]).collect()
    assert sorted(r["syms"] for r in got) == [[5, 1], [9]]


def test_no_words(spark):
    df = spark.createDataFrame([("",), (None,), ("a b",)], "text string")
    r = train_wordpiece(df, vocab_size=100)
    assert r.tokens == ["[UNK]", "[PAD]", "[BOS]", "[EOS]", "a", "b"] and r.rounds == 0


def test_one_lookup_and_no_rows_through_python_workers(spark, capsys):
    """The filter on symbols does not repeat the lookup; the specials, the
    vocabulary and the merges reach executors without Python workers."""
    df = spark.createDataFrame([(l,) for l in LINES], "text string")
    wc = counts.word_counts(df).localCheckpoint()
    base = counts.initial_vocab(wc)
    r = train_wordpiece(df, vocab_size=30)
    capsys.readouterr()
    counts.word_types(wc, base).where(F.size("syms") >= 2).explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1
    for frame in (counts.initial_vocab(spark.range(1).select(F.lit("ab").alias("word"))), r.vocab, r.merges):
        frame.explain()
        assert "ExistingRDD" not in capsys.readouterr().out
    assert r.merges.dtypes == [("rank", "int"), ("left_id", "int"), ("right_id", "int"), ("new_id", "int"), ("count", "bigint")]
    assert r.vocab.dtypes == [("token", "string"), ("id", "int")]
