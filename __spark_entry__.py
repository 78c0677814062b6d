"""

``entry(spark)`` runs the flagship job on sf0.001; ``queries()`` holds one
in ``sf_dir``, whole); ``oracle_sql()`` holds the equivalent DuckDB SQL over
the same parquet tables.  Computed columns carry the same names on both
sides; doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

import os
import threading
import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinline.constants import EOS_ID, GRAD_ACCUMULATION, MAX_LENGTH, MICRO_BATCH, TARGET_VOCAB_SIZE
from twinline.functions import arrays as ax
from twinline.functions import decode as dec
from twinline.functions import wordpiece as wp
from twinline.operators import align, collate, counts, filters, metrics, split
from twinline.plans import jobs
from twinline.session import ensure_checkpoint_dir, shared_folder
from twinline.sources import counted, epochs, store, tables

SEED = 42
VOCAB_K = 2000          # words in the frequency vocabulary
TOP_PAIRS = 64          # first-round best pairs
EVAL_EVERY = 3          # the fixture has few steps, so evaluate more often than the library's default
EDGE_PREFIX = "x[PAD]y [EOS] [pad] [ UNK ]?[BOS] " + "a" * 101 + " \u2603 a\u2603 \u2028 b "
TOP_WORDS = 100         # top-k word report per language
BUCKETS = 8              # of the bucketed token table
SHARD_WIDTH = 16        # ids of a vocabulary shard in the sharded prediction query
MERGES_VOCAB_SIZE = 400  # a training whose merges SQL can follow in seconds
WORLD_SIZE = 2          # processes for the rank-mean query
TRAIN_VOCAB_SIZE = TARGET_VOCAB_SIZE  # or until no pair is left

# ------------------------------------------------------------------ helpers

_VOCABS: dict[tuple[str, str], wp.Vocabulary] = {}
_LOCK = threading.Lock()


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.documents(spark, sf_dir)


def _vocab_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.frequency_vocab(_docs(spark, sf_dir), VOCAB_K)


def _vocab(spark: SparkSession, sf_dir: str) -> wp.Vocabulary:
    """The frequency vocabulary as a broadcastable model (built once per
    session and input, like a tokenizer file loaded once)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        v = _VOCABS.get(key)
        if v is None:
            v = _VOCABS[key] = wp.Vocabulary.from_df(_vocab_df(spark, sf_dir))
        return v


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # numbers are per language: the filter comes first, so that other languages are not numbered
    return align.language_pairs(align.corpus_lines(_docs(spark, sf_dir).where(F.col("lang").isin("en", "fr"))))


def _split_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.build_pairs_from_documents(_docs(spark, sf_dir), seed=SEED)


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vocab(spark, sf_dir)
    return jobs.tokenize_pairs(_split_pairs(spark, sf_dir), v, v)


def _stored_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token table cut from its lineage (as if saved by C3 and loaded
    by C4): batch plans read it several times."""
    ensure_checkpoint_dir(spark)
    return _tokens(spark, sf_dir).checkpoint(eager=True)


def _train_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.select_split(_stored_tokens(spark, sf_dir), "train")


def _preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.prediction_table(tables.embeddings(spark, sf_dir))


def _fr_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The French side as text.  Words never cross a line break, so counting
    words over documents equals counting them over their lines (no line
    numbering needed)."""
    return _docs(spark, sf_dir).where(F.col("lang") == "fr")


def _fr_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return counts.word_counts(_fr_texts(spark, sf_dir)).checkpoint(eager=True)


# ------------------------------------------------------------------ queries


def q_word_counts(spark, sf_dir):
    return counts.word_counts(_docs(spark, sf_dir), by=["lang"])


def q_top_words(spark, sf_dir):
    return counts.top_words(counts.word_counts(_docs(spark, sf_dir), by=["lang"]), TOP_WORDS, by=["lang"])


def q_alphabet(spark, sf_dir):
    return counts.initial_vocab(counts.word_counts(_docs(spark, sf_dir)))


def q_vocab_freq(spark, sf_dir):
    return _vocab_df(spark, sf_dir)


def q_vocab_size(spark, sf_dir):
    return counts.vocab_size(_vocab_df(spark, sf_dir))


def _fr_types(spark, sf_dir):
    wc = _fr_word_counts(spark, sf_dir)
    base = counts.initial_vocab(wc)
    return counts.word_types(wc, base), base


def q_pair_counts(spark, sf_dir):
    types, base = _fr_types(spark, sf_dir)
    pc = counts.pair_counts(types)
    named = counts.id_to_token(counts.id_to_token(pc, "left_id", base, "left"), "right_id", base, "right")
    return named.select("left", "right", "count")


def q_best_pairs(spark, sf_dir):
    types, _ = _fr_types(spark, sf_dir)
    return counts.best_pairs(counts.pair_counts(types), TOP_PAIRS)


def q_corpus_lines(spark, sf_dir):
    return align.corpus_lines(_docs(spark, sf_dir))


def q_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)


def q_turn_pairs(spark, sf_dir):
    return align.turn_pairs(tables.conversations(spark, sf_dir))


def q_tokenize_turns(spark, sf_dir):
    """C3 on the second source->target table: user turn -> assistant turn."""
    v = _vocab(spark, sf_dir)
    tp = align.turn_pairs(tables.conversations(spark, sf_dir))
    tok = tp.select("conv_id", "turn",
                    wp.encode_source(F.col("source_text"), v, spark).alias("src_ids"),
                    wp.encode_target(F.col("target_text"), v, spark).alias("tgt_ids"))
    return filters.min_target_length(tok)


def q_concat_corpora(spark, sf_dir):
    """Document pairs, and the turn pairs twice: duplicates are kept."""
    docs = _pairs(spark, sf_dir).select("corpus", "english", "french")
    turns = align.turn_pairs(tables.conversations(spark, sf_dir)).select(
        F.lit("conversations").alias("corpus"), F.col("source_text").alias("english"), F.col("target_text").alias("french"))
    return align.concat_corpora([docs, turns, turns])


def q_rename(spark, sf_dir):
    """P1 over the French lines."""
    lines = align.corpus_lines(_fr_texts(spark, sf_dir))
    return align.rename(lines, "text", "french").select("corpus", "line_no", "french")


def q_saved_dataset(spark, sf_dir):
    """S4 then S5: the split pairs written by split and read back."""
    path = shared_folder(spark, "dataset")
    store.write_dataset(_split_pairs(spark, sf_dir), path)
    return store.read_dataset(spark, path, store.RAW_SCHEMA)


def q_saved_vocab(spark, sf_dir):
    """A vocabulary written and read back."""
    path = shared_folder(spark, "vocab")
    store.write_vocab(_vocab_df(spark, sf_dir), path)
    return store.read_vocab(spark, path)


def q_token_to_id(spark, sf_dir):
    """J2 over the word counts; the text is counted once for both sides."""
    ensure_checkpoint_dir(spark)
    words = counts.word_counts(_docs(spark, sf_dir)).checkpoint(eager=True)
    vocab = counts.vocab_freq(words, VOCAB_K, materialize=False).checkpoint(eager=True)
    return counts.token_to_id(words.withColumnRenamed("word", "token"), "token", vocab).select("token", "count", "id")


def q_saved_merges(spark, sf_dir):
    """Vocabulary and merges of a small training written and read back."""
    path = shared_folder(spark, "trained")
    res = jobs.train_vocab(_fr_texts(spark, sf_dir), vocab_size=MERGES_VOCAB_SIZE)
    store.write_vocab(res.vocab, path, res.merges)
    v, m = store.read_vocab(spark, path), store.read_merges(spark, path)
    for side in ("left", "right", "new"):
        m = counts.id_to_token(m, f"{side}_id", v, side)
    return m.select("rank", "left", "right", F.col("new").alias("joined"), "count")


def _with_edges(spark, sf_dir):
    """Every document (a null text counts as empty) after a prefix that holds
    literal specials (inside a word too), a word of 101 characters and a
    character outside the vocabulary."""
    return _docs(spark, sf_dir).select("doc_id", F.concat(F.lit(EDGE_PREFIX), F.coalesce("text", F.lit(""))).alias("text"))


def q_encode_edges(spark, sf_dir):
    """X6 and X7 on the target side."""
    v = _vocab(spark, sf_dir)
    return _with_edges(spark, sf_dir).select("doc_id", wp.encode_target(F.col("text"), v, spark).alias("ids"))


def q_encode_source_edges(spark, sf_dir):
    """X6 and X7 on the source side."""
    v = _vocab(spark, sf_dir)
    return _with_edges(spark, sf_dir).select("doc_id", wp.encode_source(F.col("text"), v, spark).alias("ids"))


def q_encode_list(spark, sf_dir):
    """X9 on lists: the texts of each conversation, in turn order."""
    v = _vocab(spark, sf_dir)
    conv = tables.conversations(spark, sf_dir).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("_t"))
    lists = conv.select("conv_id", F.col("_t.text").alias("texts"))
    return wp.encode_list(lists, "texts", v).select("conv_id", "ids")


def q_metrics_log(spark, sf_dir):
    """The step rows of two epochs committed one after the other, the
    first one twice (as after a retry)."""
    path = shared_folder(spark, "metrics")
    steps = jobs.step_log(metrics.two_epochs(_preds(spark, sf_dir)), GRAD_ACCUMULATION)
    for epoch in (0, 1, 0):
        store.append_metrics(steps.where(F.col("epoch") == epoch), path, "run")
    return _round6(store.read_metrics(spark, path), ["train_loss", "accuracy"]).select("epoch", "step", "train_loss", "accuracy")


def q_metrics_log_eval(spark, sf_dir):
    """S7 with both kinds of rows: a training row a step, and at every
    evaluation step the means over that epoch's batches; all committed twice."""
    path = shared_folder(spark, "metrics")
    preds = metrics.two_epochs(_preds(spark, sf_dir))
    steps = jobs.step_log(preds, GRAD_ACCUMULATION)
    means = metrics.eval_mean(metrics.batch_metrics(preds, ("epoch", "batch_id")), ("epoch",))
    evals = metrics.eval_points(steps, EVAL_EVERY).select("epoch", "step").join(means, "epoch").select(
        "epoch", "step", "test_loss", "test_acc")
    for _ in range(2):
        store.append_metrics(steps, path, "run")
        store.append_metrics(evals, path, "run", "eval")
    out = store.read_metrics(spark, path).select("run", "kind", "epoch", "step", "train_loss", "accuracy", "test_loss", "test_acc")
    return _round6(out, ["train_loss", "accuracy", "test_loss", "test_acc"])


def q_train_test_split(spark, sf_dir):
    return _split_pairs(spark, sf_dir).select("corpus", "line_no", "split")


def q_hash_share_split(spark, sf_dir):
    """T2, cheap mode."""
    return split.hash_share_split(_pairs(spark, sf_dir), ["corpus", "line_no"], seed=SEED).select("corpus", "line_no", "split")


def q_dataset_summary(spark, sf_dir):
    return split.dataset_summary(_split_pairs(spark, sf_dir))


def q_encode_target(spark, sf_dir):
    v = _vocab(spark, sf_dir)
    return _pairs(spark, sf_dir).select("corpus", "line_no",
                                        wp.encode_target(F.col("french"), v, spark).alias("tgt_ids"))


def q_encode_target_truncated(spark, sf_dir):
    v = _vocab(spark, sf_dir)
    lines = align.corpus_lines(_docs(spark, sf_dir))
    return lines.select("corpus", "lang", "line_no",
                        wp.encode_target(F.col("text"), v, spark, truncate=True,
                                         max_length=MAX_LENGTH).alias("ids"))


def q_encode_source(spark, sf_dir):
    v = _vocab(spark, sf_dir)
    return _pairs(spark, sf_dir).select("corpus", "line_no",
                                        wp.encode_source(F.col("english"), v, spark).alias("src_ids"))


def q_tokenize_pairs(spark, sf_dir):
    return _tokens(spark, sf_dir)


def q_over_length_report(spark, sf_dir):
    v = _vocab(spark, sf_dir)
    tok = jobs.tokenize_pairs(_split_pairs(spark, sf_dir), v, v, min_length=-1)
    return filters.over_length_report(tok)


def q_decode(spark, sf_dir):
    v = _vocab(spark, sf_dir)
    t = _tokens(spark, sf_dir)
    return t.select("corpus", "line_no", dec.decode(F.col("tgt_ids"), v).alias("text"))


def q_decode_specials(spark, sf_dir):
    """X11 with the special tokens kept."""
    v = _vocab(spark, sf_dir)
    t = _tokens(spark, sf_dir)
    return t.select("corpus", "line_no", dec.decode(F.col("tgt_ids"), v, skip_special_tokens=False).alias("text"))


def q_decode_list(spark, sf_dir):
    """X11 on lists: the encoded texts of each conversation back to texts."""
    v = _vocab(spark, sf_dir)
    return q_encode_list(spark, sf_dir).select("conv_id", dec.decode_list("ids", v).alias("texts"))


def q_assign_batches(spark, sf_dir):
    r = collate.shuffled_ranks(_train_tokens(spark, sf_dir), ["corpus", "line_no"], SEED, 0)
    return collate.assign_batches(r, MICRO_BATCH).select("corpus", "line_no", "batch_id", "pos")


def q_batch_max_len(spark, sf_dir):
    r = collate.shuffled_ranks(_train_tokens(spark, sf_dir), ["corpus", "line_no"], SEED, 0)
    return collate.batch_max_len(collate.assign_batches(r, MICRO_BATCH))


def q_collate(spark, sf_dir):
    return jobs.collate(_train_tokens(spark, sf_dir), MICRO_BATCH, SEED, 0, True)


def q_collate_bucketed(spark, sf_dir):
    """C4 over tokens stored in buckets of their key (S4): the join with the
    batch layout reads them where they lie."""
    path = shared_folder(spark, "bucketed")
    tokens = store.write_bucketed(_train_tokens(spark, sf_dir), f"tokens_{uuid.uuid4().hex}", path, ["corpus", "line_no"], BUCKETS)
    return jobs.collate(tokens, MICRO_BATCH, SEED, 0, True)


def _stored_epoch(spark, sf_dir):
    path = shared_folder(spark, "epoch")
    epochs.write_epoch(_train_tokens(spark, sf_dir), path, ["corpus", "line_no"], SEED, 0, MICRO_BATCH)
    return path


def q_epoch_order(spark, sf_dir):
    """T1 as stored files: every row's rank, batch and place from the manifest."""
    rows = epochs.read_epoch(spark, _stored_epoch(spark, sf_dir))
    return rows.select("corpus", "line_no", "rank", "batch_id", "pos")


def q_epoch_batches(spark, sf_dir):
    """Some batches of the stored epoch, read by seek."""
    rows = epochs.read_batches(spark, _stored_epoch(spark, sf_dir), [0, 7, 15])
    return rows.select("batch_id", "pos", "corpus", "line_no", "src_ids", "tgt_ids")


def q_word_counts_incremental(spark, sf_dir):
    """A2 over a corpus that grows in three steps: partial counts of the new
    files alone, merged on reading."""
    root = shared_folder(spark, "growing")
    d = _docs(spark, sf_dir).select("text", "lang", F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3)).alias("step"))
    for step in range(3):
        d.where(F.col("step") == step).drop("step").write.mode("append").parquet(f"{root}/corpus")
        counted.add_files(spark, f"{root}/corpus/*.parquet", f"{root}/counts", by=["lang"])
    return counted.stored_counts(spark, f"{root}/counts", by=["lang"])


def q_collate_eval(spark, sf_dir):
    return jobs.collate(split.select_split(_stored_tokens(spark, sf_dir), "test"), MICRO_BATCH, SEED, 0, False)


def _round6(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def q_predictions(spark, sf_dir):
    p = metrics.with_predictions(_preds(spark, sf_dir))
    return _round6(p.select("example_id", "batch_id", "pos", "target_id", "pred_id", "correct", "loss"), ["loss"])


def q_predictions_sharded(spark, sf_dir):
    """T3 and A9 over logits that are stored in pieces of the vocabulary."""
    shards = metrics.vocabulary_shards(_preds(spark, sf_dir), SHARD_WIDTH)
    p = metrics.sharded_predictions(shards)
    return _round6(p.select("example_id", "batch_id", "pos", "target_id", "pred_id", "correct", "loss"), ["loss"])


def q_valid_positions(spark, sf_dir):
    return metrics.valid_positions(_preds(spark, sf_dir)).select("example_id", "batch_id", "pos", "target_id")


def q_batch_metrics(spark, sf_dir):
    return _round6(jobs.evaluate(_preds(spark, sf_dir))[0], ["accuracy", "loss"])


def q_eval_mean(spark, sf_dir):
    return _round6(jobs.evaluate(_preds(spark, sf_dir))[1], ["test_loss", "test_acc", "weighted_loss", "weighted_acc"])


def q_rank_mean(spark, sf_dir):
    b = metrics.with_ranks(metrics.batch_metrics(_preds(spark, sf_dir)), WORLD_SIZE)
    return _round6(metrics.rank_mean(b, ["local_batch"], ["loss", "accuracy"]), ["loss", "accuracy"])


def q_step_metrics(spark, sf_dir):
    return _round6(jobs.step_log(metrics.two_epochs(_preds(spark, sf_dir)), GRAD_ACCUMULATION), ["train_loss", "accuracy"])


def q_eval_points(spark, sf_dir):
    s = jobs.step_log(metrics.two_epochs(_preds(spark, sf_dir)), GRAD_ACCUMULATION)
    return _round6(metrics.eval_points(s, EVAL_EVERY), ["train_loss", "accuracy"])


def q_clip_generated(spark, sf_dir):
    g = metrics.generated_sequences(_preds(spark, sf_dir))
    return g.select("batch_id", ax.clip_generated("ids", EOS_ID, MAX_LENGTH).alias("ids"))


def q_strip_specials(spark, sf_dir):
    t = _tokens(spark, sf_dir)
    return t.select("corpus", "line_no", ax.strip_specials("tgt_ids", [0, 1, 2, 3]).alias("ids"))


def q_train_wordpiece(spark, sf_dir):
    return jobs.train_vocab(_fr_texts(spark, sf_dir), vocab_size=TRAIN_VOCAB_SIZE).vocab


def q_train_wordpiece_1k(spark, sf_dir):
    """The first 1,000 entries: a size whose merges SQL can follow one by one."""
    return jobs.train_vocab(_fr_texts(spark, sf_dir), vocab_size=1000).vocab


def q_flagship(spark, sf_dir):
    return jobs.split_length_summary(_tokens(spark, sf_dir))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "word_counts": q_word_counts,
    "word_counts_incremental": q_word_counts_incremental,
    "top_words": q_top_words,
    "alphabet": q_alphabet,
    "vocab_freq": q_vocab_freq,
    "vocab_size": q_vocab_size,
    "pair_counts": q_pair_counts,
    "best_pairs": q_best_pairs,
    "corpus_lines": q_corpus_lines,
    "pairs": q_pairs,
    "turn_pairs": q_turn_pairs,
    "tokenize_turns": q_tokenize_turns,
    "concat_corpora": q_concat_corpora,
    "rename": q_rename,
    "saved_dataset": q_saved_dataset,
    "saved_vocab": q_saved_vocab,
    "token_to_id": q_token_to_id,
    "saved_merges": q_saved_merges,
    "encode_edges": q_encode_edges,
    "encode_source_edges": q_encode_source_edges,
    "encode_list": q_encode_list,
    "metrics_log": q_metrics_log,
    "metrics_log_eval": q_metrics_log_eval,
    "train_test_split": q_train_test_split,
    "hash_share_split": q_hash_share_split,
    "dataset_summary": q_dataset_summary,
    "encode_target": q_encode_target,
    "encode_target_truncated": q_encode_target_truncated,
    "encode_source": q_encode_source,
    "tokenize_pairs": q_tokenize_pairs,
    "over_length_report": q_over_length_report,
    "decode": q_decode,
    "decode_specials": q_decode_specials,
    "decode_list": q_decode_list,
    "strip_specials": q_strip_specials,
    "assign_batches": q_assign_batches,
    "batch_max_len": q_batch_max_len,
    "collate": q_collate,
    "collate_eval": q_collate_eval,
    "collate_bucketed": q_collate_bucketed,
    "epoch_order": q_epoch_order,
    "epoch_batches": q_epoch_batches,
    "predictions": q_predictions,
    "predictions_sharded": q_predictions_sharded,
    "valid_positions": q_valid_positions,
    "batch_metrics": q_batch_metrics,
    "eval_mean": q_eval_mean,
    "rank_mean": q_rank_mean,
    "step_metrics": q_step_metrics,
    "eval_points": q_eval_points,
    "clip_generated": q_clip_generated,
    "train_wordpiece": q_train_wordpiece,
    "train_wordpiece_1k": q_train_wordpiece_1k,
    "flagship": q_flagship,
}


# The pipeline operators (twinline/llm and corpus_pipeline.py) are optional.
_LLM_ORACLE: dict[str, str] = {}
try:
    import corpus_pipeline
    from twinline.llm import queries as llm_queries
except ImportError as missing:  # the folders, or a package that only they need
    if os.path.exists(os.path.join(os.path.dirname(os.path.abspath(__file__)), "corpus_pipeline.py")):
        warnings.warn(f"pipeline operators left out: {missing}", stacklevel=1)
else:
    _QUERIES |= llm_queries.QUERIES
    _LLM_ORACLE |= llm_queries.ORACLE
    _QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        _LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """Flagship on sf0.001: aligned en/fr lines -> encode both sides ->
    filter -> split -> rows, mean and max length per split."""
    ensure_checkpoint_dir(spark)
    return q_flagship(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from twinline.plans.reference_sql import ORACLE
    return {k: v for k, v in (ORACLE | _LLM_ORACLE).items() if k in _QUERIES}
