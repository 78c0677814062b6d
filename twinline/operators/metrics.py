"""Evaluation arithmetic over prediction tables.

A prediction table has one row per target position:
``example_id, batch_id, pos, target_id, logits array<float>``.
Argmax and log-sum-exp come from one Arrow kernel over whole rows, or over
pieces of the vocabulary that are merged by a small aggregate
(``functions/logits.py``, which also defines NaN, infinite and null logits);
means by ``groupBy`` with partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import EVALUATION_STEPS, GRAD_ACCUMULATION, IGNORE_INDEX, MICRO_BATCH
from ..functions import arrays as ax
from ..functions.logits import merge_shards, row_scores, shard_scores


def prediction_table(emb: DataFrame, batch_size: int = MICRO_BATCH, ignore_every: int = 7) -> DataFrame:
    """The ``logits`` fixture: embeddings as logits, label as target, every
    ``ignore_every``-th vector ignored (-100)."""
    return emb.select(
        F.col("vec_id").alias("example_id"),
        F.floor(F.col("vec_id") / batch_size).cast("long").alias("batch_id"),
        (F.col("vec_id") % batch_size).cast("int").alias("pos"),
        F.when(F.col("vec_id") % ignore_every == 0, F.lit(IGNORE_INDEX)).otherwise(F.col("label"))
        .cast("int").alias("target_id"),
        F.col("embedding").alias("logits"))


def is_valid(target: Column | str = "target_id", ignore: int = IGNORE_INDEX) -> Column:
    t = F.col(target) if isinstance(target, str) else target
    return t != F.lit(ignore)


def valid_positions(df: DataFrame, target: str = "target_id") -> DataFrame:
    """F4."""
    return df.where(is_valid(target))


def with_predictions(df: DataFrame) -> DataFrame:
    """T3 argmax, correctness and cross-entropy per position (the latter two
    null when ignored)."""
    return _judged(df.withColumn("_score", row_scores("logits", "target_id")).select("*", "_score.pred_id", "_score.loss").drop("_score"))


def _judged(df: DataFrame) -> DataFrame:
    v = is_valid()
    return (df.withColumn("correct", F.when(v, (F.col("pred_id") == F.col("target_id")).cast("double")))
            .withColumn("loss", F.when(v, F.col("loss"))))


def vocabulary_shards(df: DataFrame, width: int) -> DataFrame:
    """A prediction table whose logits are stored in pieces of ``width`` ids:
    one row per position and piece, with the piece's first id as ``shard_start``."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("logits") - 1, F.lit(0)), F.lit(width))
    return df.withColumn("shard_start", F.explode(starts)).withColumn("logits", F.slice("logits", F.col("shard_start") + 1, width))


def sharded_predictions(shards: DataFrame) -> DataFrame:
    """``with_predictions`` over vocabulary shards (without the logits): each
    piece is reduced where it is read, and only its few numbers are shuffled."""
    keys = [c for c in shards.columns if c not in ("logits", "shard_start")]
    score = shard_scores(F.col("logits"), F.col("target_id"), F.col("shard_start"))
    return _judged(merge_shards(shards.select(*keys, score.alias("score")), keys))


def batch_metrics(df: DataFrame, by: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """A8 + A9 per batch: accuracy and mean cross-entropy over valid
    positions; a batch without valid positions gets nulls."""
    p = with_predictions(df)
    return p.groupBy(*by).agg(
        F.avg("correct").alias("accuracy"),
        F.avg("loss").alias("loss"),
        F.count("correct").alias("valid_tokens"),
    )


def eval_mean(batches: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Unweighted mean of batch means (the reference) and the
    token-weighted mean, of all batches or per ``by``."""
    return batches.groupBy(*by).agg(
        F.avg("loss").alias("test_loss"),
        F.avg("accuracy").alias("test_acc"),
        (F.sum(F.col("loss") * F.col("valid_tokens")) / F.sum("valid_tokens")).alias("weighted_loss"),
        (F.sum(F.col("accuracy") * F.col("valid_tokens")) / F.sum("valid_tokens")).alias("weighted_acc"),
    )


def rank_mean(values: DataFrame, key_cols: list[str], value_cols: list[str]) -> DataFrame:
    """Mean over processes of per-process values for each key."""
    return values.groupBy(*key_cols).agg(*[F.avg(c).alias(c) for c in value_cols])


def with_ranks(batches: DataFrame, world_size: int) -> DataFrame:
    """Data-parallel layout: global micro-batch i runs on process i mod R as
    its local batch i div R."""
    return (batches.withColumn("rank", (F.col("batch_id") % world_size).cast("int"))
            .withColumn("local_batch", F.floor(F.col("batch_id") / world_size).cast("long")))


def assign_steps(batches: DataFrame, accumulation: int = GRAD_ACCUMULATION, epoch: int = 0,
                 batch_col: str = "batch_id") -> DataFrame:
    """Micro-batch i of an epoch belongs to optimiser step i div G of that
    epoch; steps run on over epochs.  An epoch adds as many steps as it has
    full groups of G (a short last group makes no step).  Without an ``epoch``
    column all rows are of ``epoch``."""
    local = F.floor(F.col(batch_col) / accumulation).cast("long")
    if "epoch" not in batches.columns:
        return batches.withColumn("epoch", F.lit(epoch)).withColumn("step", local)
    # one row per epoch
    full = batches.groupBy("epoch").agg(F.floor(F.countDistinct(batch_col) / accumulation).cast("long").alias("_full"))
    before = Window.orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    offset = full.select("epoch", F.coalesce(F.sum("_full").over(before), F.lit(0)).alias("_off"))
    return batches.join(offset, "epoch").withColumn("step", (F.col("_off") + local).cast("long")).drop("_off")


def step_metrics(stepped: DataFrame, accumulation: int = GRAD_ACCUMULATION) -> DataFrame:
    """A10: per step, sum of loss/G and accuracy/G over its G micro-batches;
    a short trailing group never becomes a step."""
    return (stepped.groupBy("epoch", "step")
            .agg(F.sum(F.col("loss") / accumulation).alias("train_loss"),
                 F.sum(F.col("accuracy") / accumulation).alias("accuracy"),
                 F.count(F.lit(1)).alias("micro_batches"))
            .where(F.col("micro_batches") == accumulation)
            .drop("micro_batches"))


def log_points(metrics: DataFrame, every: int = 1, step_col: str = "step") -> DataFrame:
    """Steps that are logged: every ``every``-th, from step 0."""
    return metrics.where(F.col(step_col) % every == 0)


def two_epochs(preds: DataFrame, batch_size: int = MICRO_BATCH, shift: int = 17) -> DataFrame:
    """The prediction fixture seen in two epochs, the second one ``shift``
    positions on (so its batches differ)."""
    at = F.col("example_id") + F.col("epoch") * shift
    return (preds.withColumn("epoch", F.explode(F.array(F.lit(0), F.lit(1))))
            .withColumn("batch_id", F.floor(at / batch_size).cast("long"))
            .withColumn("pos", (at % batch_size).cast("int")))


def eval_points(metrics: DataFrame, every: int = EVALUATION_STEPS, step_col: str = "step") -> DataFrame:
    """Steps where evaluation runs (step 0 included)."""
    return metrics.where(F.col(step_col) % every == 0)


def generated_sequences(preds: DataFrame) -> DataFrame:
    """Per batch, the argmax ids in position order: stands in for a table of
    generated sequences (groups are bounded by the batch size)."""
    p = preds.select("batch_id", "pos", ax.argmax("logits").alias("pred_id"))
    return p.groupBy("batch_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "pred_id"))).alias("_s")
    ).select("batch_id", F.col("_s.pred_id").alias("ids"))
