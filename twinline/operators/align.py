"""Line tables and positional alignment.

``corpus_lines`` turns documents into a line table keyed by
(corpus, lang, line_no); ``positional_zip`` pairs the n-th source line with
the n-th target line of the same corpus by an equi-join on that key, so no
column is ever held in memory and the pairing is independent of how the
input is partitioned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .numbering import block_offsets, ordered_blocks, prefix_offsets
from .skew import join_hot, null_safe_join


class AlignmentError(ValueError):
    """Raised in strict mode when two sides of a corpus differ in length."""


def corpus_lines(docs: DataFrame, corpus_col: str = "source", block_rows: int = 1 << 16) -> DataFrame:
    """W1 over documents: one row per ``\\n``-separated line.

    ``line_no`` is the 0-based position of the line inside (corpus, lang) in
    (doc_id, position-in-doc) order, null ids last; lines at one position of
    a repeated (or null) id are ordered by a hash of the line.  A null corpus
    or lang is a group like any other.  Documents with a null text have no
    lines.  Result: corpus, lang, line_no, text.

    The scan sees only (corpus, lang, doc_id, lines); its offsets are joined
    back, so the text is moved at most once and never sorted.  Ids that many
    rows share are joined by a bounded broadcast; their lines, and only theirs,
    are numbered one by one after the id's offset.
    """
    key = ["corpus", "lang", "doc_id"]
    d = docs.where(F.col("text").isNotNull()).select(F.col(corpus_col).alias("corpus"), "lang", "doc_id", "text")
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    per_id = d.groupBy(*key).agg(F.sum(n_lines.cast("long")).alias("_n"), F.count(F.lit(1)).alias("_rows"))
    placed_ids = ordered_blocks(per_id, [F.col(c).asc_nulls_last() for c in key], block_rows)
    offsets = block_offsets(placed_ids, key[:2], "_n", "_line_off").select(*key, "_rows", "_line_off")
    lines = F.posexplode(F.split("text", "\n", -1)).alias("_pos", "text")
    if not placed_ids.where("_rows > 1").limit(1).count():
        placed = null_safe_join(d, offsets.drop("_rows"), key)
        return placed.select(*key[:2], "_line_off", lines).select(
            *key[:2], (F.col("_line_off") + F.col("_pos")).cast("long").alias("line_no"), "text")
    rows = d.withColumn("_row", F.monotonically_increasing_id()).checkpoint(eager=True)
    placed = join_hot(rows, offsets.checkpoint(eager=True), key)
    single = placed.where("_rows = 1").select(*key[:2], "_line_off", lines).select(
        *key[:2], (F.col("_line_off") + F.col("_pos")).cast("long").alias("line_no"), "text")
    several = placed.where("_rows > 1").select(*key, "_row", "_line_off", lines).withColumn("_hash", F.xxhash64("text"))
    several = several.checkpoint(eager=True)
    inside = prefix_offsets(several.select(*key, "_row", "_pos", "_hash", F.lit(1).cast("long").alias("_one")), key,
                            ["_pos", "_hash", "_row"], "_one", "_nth", block_rows)
    numbered = several.join(inside.select("_row", "_pos", "_nth"), ["_row", "_pos"])
    return single.unionByName(numbered.select(*key[:2], (F.col("_line_off") + F.col("_nth")).cast("long").alias("line_no"), "text"))


def rename(df: DataFrame, old: str, new: str) -> DataFrame:
    """P1."""
    return df.withColumnRenamed(old, new)


def positional_zip(src_lines: DataFrame, tgt_lines: DataFrame, src_name: str = "english",
                   tgt_name: str = "french", mode: str = "truncate") -> DataFrame:
    """N-th source line with n-th target line of the same corpus.

    Inputs have (corpus, line_no, text).  ``truncate`` keeps the common
    prefix (inner join).  ``strict`` first compares per-corpus line counts
    (one small aggregate, one row per corpus reaches the driver) and raises
    ``AlignmentError`` on any mismatch.
    """
    if mode not in ("truncate", "strict"):
        raise ValueError("mode must be 'truncate' or 'strict'")
    if mode == "strict":
        a = src_lines.groupBy("corpus").agg(F.count(F.lit(1)).alias("n_src"))
        b = tgt_lines.groupBy("corpus").agg(F.count(F.lit(1)).alias("n_tgt"))
        bad = (a.join(b, "corpus", "full_outer")
               .where(F.coalesce(F.col("n_src"), F.lit(-1)) != F.coalesce(F.col("n_tgt"), F.lit(-1)))
               .orderBy("corpus").limit(21).collect())
        if bad:
            detail = ", ".join(f"{r['corpus']}: {r['n_src']} vs {r['n_tgt']}" for r in bad[:20])
            raise AlignmentError(f"line counts differ per corpus: {detail}{', and more' * (len(bad) > 20)}")
    s = src_lines.select("corpus", "line_no", F.col("text").alias(src_name))
    t = tgt_lines.select("corpus", "line_no", F.col("text").alias(tgt_name))
    return s.join(t, ["corpus", "line_no"], "inner")


def language_pairs(lines: DataFrame, src_lang: str = "en", tgt_lang: str = "fr",
                   src_name: str = "english", tgt_name: str = "french", mode: str = "truncate") -> DataFrame:
    """J1 from one line table holding both languages: the two lines of a
    (corpus, line_no) meet in one grouping, so the table is read once (the
    language filter is pushed to its scan).  ``strict`` as in positional_zip."""
    if mode != "truncate":
        return positional_zip(lines.where(F.col("lang") == src_lang), lines.where(F.col("lang") == tgt_lang),
                              src_name, tgt_name, mode)
    is_src, is_tgt = F.col("lang") == src_lang, F.col("lang") == tgt_lang
    both = lines.where(F.col("lang").isin(src_lang, tgt_lang) & F.col("corpus").isNotNull()).groupBy("corpus", "line_no").agg(
        F.max(F.when(is_src, F.col("text"))).alias(src_name), F.max(F.when(is_tgt, F.col("text"))).alias(tgt_name),
        # flags, so that a reader of the keys alone needs no text
        F.max(is_src).alias("_s"), F.max(is_tgt).alias("_t"))
    return both.where(F.col("_s") & F.col("_t")).select("corpus", "line_no", src_name, tgt_name)


def concat_corpora(frames: list[DataFrame]) -> DataFrame:
    """Stack corpora, duplicates kept (UNION ALL)."""
    if not frames:
        raise ValueError("concat_corpora needs at least one DataFrame")
    return reduce(lambda a, b: a.unionByName(b), frames)


def turn_pairs(conversations: DataFrame) -> DataFrame:
    """A second source->target table: a user turn and the assistant turn
    right after it in the same conversation (equi-join on conv_id, turn+1)."""
    u = conversations.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("source_text"))
    a = conversations.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("target_text"))
    return u.join(a, ["conv_id", "turn"], "inner")
