"""Composite jobs a user calls (C1-C6), built from the operators.

Each job returns DataFrames (lazy plans); the caller decides when to write
them.  Shapes: pairs (corpus, line_no, english, french[, split]); tokens
(corpus, line_no, src_ids, tgt_ids[, split]).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import MAX_LENGTH, MICRO_BATCH, MIN_TARGET_LENGTH, TARGET_VOCAB_SIZE, TEST_SHARE
from ..functions import wordpiece as wp
from ..operators import align, collate as col, counts, filters, metrics, split
from ..operators.wordpiece_train import TrainResult, train_wordpiece
from ..sources import files, store


def build_pairs(spark: SparkSession, root: str, test_share: float = TEST_SHARE, seed: int | str = 42,
                mode: str = "truncate", src_suffix: str = ".en", tgt_suffix: str = ".fr",
                save_to: str | None = None) -> DataFrame:
    """C1 from line files: discover corpora, number lines, zip the two
    sides, stack corpora, split train/test, optionally save."""
    found = files.discover_pairs(spark, root, src_suffix, tgt_suffix)
    src = files.read_corpus_lines(spark, root, found, "src", src_suffix)
    tgt = files.read_corpus_lines(spark, root, found, "tgt", tgt_suffix)
    if mode == "strict":
        files.check_all_read(found, src, "src")
        files.check_all_read(found, tgt, "tgt")
    pairs = align.positional_zip(src, tgt, "english", "french", mode)
    out = split.train_test_split(pairs, ["corpus", "line_no"], test_share, seed, materialize=True)
    if save_to:
        store.write_dataset(out, save_to)
    return out


def build_pairs_from_documents(docs: DataFrame, test_share: float = TEST_SHARE, seed: int | str = 42,
                               src_lang: str = "en", tgt_lang: str = "fr", mode: str = "truncate") -> DataFrame:
    """C1 over a documents table: line table, zip, split."""
    lines = align.corpus_lines(docs.where(F.col("lang").isin(src_lang, tgt_lang)))
    pairs = align.language_pairs(lines, src_lang, tgt_lang, "english", "french", mode)
    return split.train_test_split(pairs, ["corpus", "line_no"], test_share, seed, materialize=True)


def train_vocab(texts: DataFrame, text_col: str = "text", vocab_size: int = TARGET_VOCAB_SIZE,
                **kwargs) -> TrainResult:
    """Learn the target vocabulary from a text column."""
    return train_wordpiece(texts, text_col, vocab_size, **kwargs)


def train_vocab_from_files(spark: SparkSession, root: str, vocab_size: int = TARGET_VOCAB_SIZE,
                           suffix: str = ".fr", save_to: str | None = None, **kwargs) -> TrainResult:
    """C2 end to end: every ``suffix`` file one directory below ``root``,
    line by line, into a trained vocabulary (optionally saved, S6)."""
    lines = spark.read.text(files.glob_lang_files(root, suffix)).withColumnRenamed("value", "text")
    res = train_wordpiece(lines, "text", vocab_size, **kwargs)
    if save_to:
        store.write_vocab(res.vocab, save_to, res.merges)
    return res


def tokenize_saved(spark: SparkSession, raw_path: str, save_to: str, src_vocab: wp.Vocabulary,
                   tgt_vocab: wp.Vocabulary, max_length: int = MAX_LENGTH,
                   min_length: int = MIN_TARGET_LENGTH, truncate: bool = False) -> DataFrame:
    """C3 end to end: load a saved pair dataset (S5), encode, filter, save
    the token dataset partitioned by split (S4); returns the saved table."""
    pairs = store.read_dataset(spark, raw_path, store.RAW_SCHEMA)
    tok = tokenize_pairs(pairs, src_vocab, tgt_vocab, max_length, min_length, truncate)
    store.write_dataset(tok, save_to)
    return store.read_dataset(spark, save_to)


def frequency_vocab(texts: DataFrame, k: int, text_col: str = "text") -> DataFrame:
    """SQL-expressible vocabulary: alphabet plus the top-k words."""
    return counts.vocab_freq(counts.word_counts(texts, text_col), k)


def tokenize_pairs(pairs: DataFrame, src_vocab: wp.Vocabulary, tgt_vocab: wp.Vocabulary,
                   max_length: int = MAX_LENGTH, min_length: int = MIN_TARGET_LENGTH,
                   truncate: bool = False, keep: tuple[str, ...] = ("corpus", "line_no", "split"),
                   src_profile: wp.Profile = wp.SOURCE) -> DataFrame:
    """Encode both sides (one narrow stage), drop the text, keep targets
    longer than ``min_length``."""
    spark = pairs.sparkSession
    keep = tuple(c for c in keep if c in pairs.columns)
    src_ids = wp.encode(F.col("english"), src_vocab, spark, src_profile, True, max_length)
    tgt_ids = wp.encode_target(F.col("french"), tgt_vocab, spark, truncate, max_length)
    tok = pairs.select(*keep, src_ids.alias("src_ids"), tgt_ids.alias("tgt_ids"))
    return filters.min_target_length(tok, min_length)


def collate(tokens: DataFrame, batch_size: int = MICRO_BATCH, seed: int | str = 42, epoch: int = 0,
            shuffle: bool = True, **kwargs) -> DataFrame:
    """C4: batches of padded, masked and shifted examples."""
    return col.collate(tokens, ["corpus", "line_no"], batch_size, seed, epoch, shuffle, **kwargs)


def evaluate(predictions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per-batch metrics and their means."""
    batches = metrics.batch_metrics(predictions)
    return batches, metrics.eval_mean(batches)


def step_log(predictions: DataFrame, accumulation: int = 2, epoch: int = 0) -> DataFrame:
    """Optimiser-step metrics from micro-batch metrics; with an ``epoch``
    column, steps run on over epochs."""
    by = ("epoch", "batch_id") if "epoch" in predictions.columns else ("batch_id",)
    batches = metrics.batch_metrics(predictions, by)
    return metrics.step_metrics(metrics.assign_steps(batches, accumulation, epoch), accumulation)


def split_length_summary(tokens: DataFrame) -> DataFrame:
    """Rows, mean and max id length per split (the flagship report)."""
    return tokens.groupBy("split").agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.round(F.avg(F.size("src_ids")), 6).alias("mean_src_len"),
        F.round(F.avg(F.size("tgt_ids")), 6).alias("mean_tgt_len"),
        F.max(F.size("src_ids")).alias("max_src_len"),
        F.max(F.size("tgt_ids")).alias("max_tgt_len"),
    )
