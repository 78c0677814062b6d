"""Distributed counts behind vocabulary learning (A2, A3, A4, T5, A6) and
the SQL-expressible frequency vocabulary ``vocab_freq``.

All counts are ``explode`` + ``groupBy`` with map-side partial aggregation,
so a very frequent word or pair costs one partial row per task, never a hot
reducer holding raw rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import CONTINUATION_PREFIX, MAX_VOCAB, SPECIAL_TOKENS
from ..functions import text as tx
from ..session import ensure_checkpoint_dir

# Functions that run in tasks travel by value: executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def word_counts(df: DataFrame, text_col: str = "text", by: list[str] | None = None) -> DataFrame:
    """A2: count of each normalised, pre-tokenised word (optionally per group).
    As in training, literal specials are ordinary text (only encoding keeps
    them whole)."""
    by = by or []
    return (df.select(*by, F.explode(tx.plain_words(F.col(text_col))).alias("word"))
            .groupBy(*by, "word").agg(F.count(F.lit(1)).alias("count")))


def top_words(counts: DataFrame, k: int, by: list[str] | None = None) -> DataFrame:
    """Top-k report by (count desc, word asc), per group when ``by`` is set."""
    by = by or []
    if not by:
        return counts.orderBy(F.col("count").desc(), "word").limit(k)
    w = Window.partitionBy(*by).orderBy(F.col("count").desc(), "word")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def chars(word: Column) -> Column:
    """Code points of a string (a Java regex '.' is one code point)."""
    return F.regexp_extract_all(word, F.lit("(?s)."), F.lit(0))


def symbols(word: Column, prefix: str = CONTINUATION_PREFIX) -> Column:
    """Initial split of a word: first char plain, the others with ``##``."""
    return F.transform(chars(word), lambda c, i: F.when(i == 0, c).otherwise(F.concat(F.lit(prefix), c)))


def alphabet(counts: DataFrame, prefix: str = CONTINUATION_PREFIX) -> DataFrame:
    """A3: every distinct character (kind 'char') plus a continuation form
    for each character seen in a non-initial position (kind 'cont').
    One pass: distinct (character, non-initial?) pairs, then expanded."""
    e = (counts.select(F.posexplode(chars(F.col("word"))).alias("pos", "ch"))
         .select("ch", (F.col("pos") > 0).alias("later")).distinct())
    kinds = F.when(F.col("later"), F.array(F.lit("char"), F.lit("cont"))).otherwise(F.array(F.lit("char")))
    return (e.select("ch", F.explode(kinds).alias("kind"))
            .select(F.when(F.col("kind") == "cont", F.concat(F.lit(prefix), F.col("ch"))).otherwise(F.col("ch"))
                    .alias("token"), "ch", "kind")
            .distinct())


def arrow_rows(spark: SparkSession, columns: list[Iterable], schema: str) -> DataFrame:
    """A small table from the driver's columns, as Arrow.  (A list of rows
    would be unpickled by Python workers on the executors, which then stay
    beside those of the column functions.)"""
    names = T.StructType.fromDDL(schema).names
    return spark.createDataFrame(pa.table([pa.array(c) for c in columns], names=names), schema)


def _vocab_rows(counts: DataFrame, prefix: str) -> DataFrame:
    """(token, grp, k1, k2) rows of the initial vocabulary in id order:
    specials (grp 0), characters (1), continuation characters (2)."""
    n = len(SPECIAL_TOKENS)
    specials = arrow_rows(counts.sparkSession, [list(SPECIAL_TOKENS), [0] * n, range(n), [""] * n],
                          "token string, grp int, k1 long, k2 string")
    a = alphabet(counts, prefix)
    body = a.select("token", F.when(F.col("kind") == "char", 1).otherwise(2).alias("grp"),
                    F.lit(0).cast("long").alias("k1"), F.col("ch").alias("k2"))
    return specials.unionByName(body)


def _number(rows: DataFrame) -> DataFrame:
    # one window over the vocabulary itself: bounded by alphabet + k
    w = Window.orderBy("grp", "k1", "k2")
    return rows.select("token", (F.row_number().over(w) - 1).cast("int").alias("id"))


def initial_vocab(counts: DataFrame, prefix: str = CONTINUATION_PREFIX) -> DataFrame:
    """Specials, then characters by code point, then continuation characters
    by code point; ids dense from 0.  Bounded by the alphabet size."""
    return _number(_vocab_rows(counts, prefix))


def vocab_freq(counts: DataFrame, k: int, prefix: str = CONTINUATION_PREFIX,
               materialize: bool = True) -> DataFrame:
    """Frequency vocabulary: the initial vocabulary, then the top-k words of
    two or more characters by (count desc, word asc), minus those that are
    already a token (e.g. the word ``###`` is the continuation form of ``#``).
    Total words over all groups are used.  The counts feed three branches,
    so with ``materialize`` they are reliably checkpointed once (a table of
    distinct words) instead of being recomputed from the text per branch."""
    if materialize:
        ensure_checkpoint_dir(counts.sparkSession)
        counts = counts.checkpoint(eager=True)
    base = _vocab_rows(counts, prefix)
    totals = counts.groupBy("word").agg(F.sum("count").alias("count"))
    top = totals.where(F.length("word") >= 2).orderBy(F.col("count").desc(), "word").limit(k)
    cand = top.join(base.select(F.col("token").alias("word")), "word", "left_anti")
    words_ = cand.select(F.col("word").alias("token"), F.lit(3).alias("grp"),
                         (-F.col("count")).cast("long").alias("k1"), F.col("word").alias("k2"))
    return _number(base.unionByName(words_))


def word_types(counts: DataFrame, vocab: DataFrame, prefix: str = CONTINUATION_PREFIX) -> DataFrame:
    """(word, n, syms array<int>) -- each word as initial-vocabulary ids, by a
    dictionary lookup in column batches (the vocabulary is alphabet-sized).
    Not deterministic to the planner: a filter on the symbols would otherwise
    be moved below the lookup and do it a second time, in a second worker."""
    rows = vocab.limit(MAX_VOCAB + 1).collect()
    if len(rows) > MAX_VOCAB:
        raise ValueError(f"initial vocabulary above {MAX_VOCAB} entries")
    ids = {r["token"]: r["id"] for r in rows}
    shared = counts.sparkSession.sparkContext.broadcast(ids)

    @F.arrow_udf(T.ArrayType(T.IntegerType(), containsNull=False))
    def symbol_ids(words: pa.Array) -> pa.Array:
        table = shared.value
        first = {t: i for t, i in table.items() if len(t) == 1}
        later = {t[len(prefix):]: i for t, i in table.items() if t.startswith(prefix) and len(t) == len(prefix) + 1}
        return pa.array([None if not w else [first[w[0]], *(later[c] for c in w[1:])] for w in words.to_pylist()],
                        pa.list_(pa.int32()))

    return counts.select("word", F.col("count").cast("long").alias("n"), symbol_ids.asNondeterministic()("word").alias("syms"))


def pair_rows(types: DataFrame) -> DataFrame:
    """(left_id, right_id, n): every adjacent symbol pair of every word type."""
    t = types.where(F.size("syms") >= 2)
    pairs = F.arrays_zip(F.slice("syms", 1, F.size("syms") - 1).alias("l"),
                         F.slice("syms", 2, F.size("syms") - 1).alias("r"))
    return t.select("n", F.explode(pairs).alias("p")).select(F.col("p.l").alias("left_id"), F.col("p.r").alias("right_id"), "n")


def pair_counts(types: DataFrame) -> DataFrame:
    """A4: weighted count of each adjacent symbol pair over word types."""
    return pair_rows(types).groupBy("left_id", "right_id").agg(F.sum("n").alias("count"))


def best_pairs(pairs: DataFrame, k: int) -> DataFrame:
    """T5: the k most frequent pairs, ties by (left_id, right_id)."""
    return pairs.orderBy(F.col("count").desc(), "left_id", "right_id").limit(k)


def vocab_size(vocab: DataFrame) -> DataFrame:
    """A6."""
    return vocab.agg(F.count(F.lit(1)).alias("vocab_size"))


def token_to_id(df: DataFrame, token_col: str, vocab: DataFrame, out_col: str = "id") -> DataFrame:
    """J2 on a table of tokens: left join with the vocabulary, broadcast if it
    is within the bound of vocabularies.  Unknown tokens get a null id."""
    v = vocab.select(F.col("token").alias(token_col), F.col("id").alias(out_col))
    small = v.limit(MAX_VOCAB + 1).count() <= MAX_VOCAB
    return df.join(F.broadcast(v) if small else v, token_col, "left")


def id_to_token(df: DataFrame, id_col: str, vocab: DataFrame, out_col: str = "token") -> DataFrame:
    """J3 on a table of ids; unknown ids get a null token."""
    v = vocab.select(F.col("id").alias(id_col), F.col("token").alias(out_col))
    small = v.limit(MAX_VOCAB + 1).count() <= MAX_VOCAB
    return df.join(F.broadcast(v) if small else v, id_col, "left")
