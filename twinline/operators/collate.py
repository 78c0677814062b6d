"""Shuffle, batch and collate (T1, W2, A7, X13-X17 -> C4).

Shuffled batches (the training loader): rows get a global rank in the
order of ``md5(seed:epoch:key)`` via hash buckets (``hash_rank``), and
``batch_id = (rank - 1) div B``.  Unshuffled batches (the evaluation loader)
follow key order via ``prefix_offsets`` ranks.  Ranks, batches and the
per-batch maximum lengths are computed on keys and lengths; the token arrays
are shuffled once, to meet their layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import MICRO_BATCH, PAD_ID
from ..functions import arrays as ax
from ..session import ensure_checkpoint_dir
from .numbering import hash_digits_for, hash_rank, prefix_offsets
from .split import epoch_order_key


def shuffled_ranks(df: DataFrame, key_cols: list[str], seed: int | str, epoch: int,
                   digits: int | None = None, n_rows: int | None = None, with_offsets: bool = False):
    """T1 + global rank: adds ``rank`` (1-based) and ``_hr_bucket``
    (and returns the per-bucket offset table when asked)."""
    if digits is None:
        digits = hash_digits_for(n_rows if n_rows is not None else df.count())
    d = df.withColumn("_order", epoch_order_key(seed, key_cols, epoch))
    ranked, offsets = hash_rank(d, "_order", key_cols, digits, keep_bucket=True, with_offsets=True)
    ranked = ranked.drop("_order")
    return (ranked, offsets) if with_offsets else ranked


def ordered_ranks(df: DataFrame, group_col: str, order_col: str) -> DataFrame:
    """Global rank in (group_col, order_col) order without a global window."""
    d = df.withColumn("_one", F.lit(1).cast("long"))
    d = prefix_offsets(d, [group_col], order_col, "_one", "_in_group")
    sizes = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("_gn"))
    # one row per group; joined as its size allows
    sizes = sizes.select(group_col, F.coalesce(F.sum("_gn").over(
        Window.orderBy(group_col).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_goff"))
    return (d.join(sizes, group_col)
            .withColumn("rank", (F.col("_goff") + F.col("_in_group") + 1).cast("long"))
            .drop("_one", "_in_group", "_goff"))


def assign_batches(ranked: DataFrame, batch_size: int = MICRO_BATCH) -> DataFrame:
    """Consecutive groups of B rows in rank order; the last may be short."""
    r = F.col("rank") - 1
    return ranked.withColumn("batch_id", F.floor(r / batch_size).cast("long")).withColumn(
        "pos", (r % batch_size).cast("int"))


def batch_max_len(batched: DataFrame, src_col: str = "src_ids", tgt_col: str = "tgt_ids") -> DataFrame:
    """Longest row of each batch, per side."""
    return batched.groupBy("batch_id").agg(F.max(F.size(src_col)).alias("src_max_len"),
                                           F.max(F.size(tgt_col)).alias("tgt_max_len"))


def batch_layout(tokens: DataFrame, key_cols: list[str], batch_size: int, seed: int | str, epoch: int, shuffle: bool,
                 src_col: str, tgt_col: str, digits: int | None = None) -> DataFrame:
    """(*key_cols, batch_id, pos, src_max_len, tgt_max_len) of every row, from
    keys and lengths alone: ranks, batches and batch maxima never see a token."""
    narrow = tokens.select(*key_cols, F.size(src_col).alias("_s"), F.size(tgt_col).alias("_t"))
    ensure_checkpoint_dir(tokens.sparkSession)
    narrow = narrow.checkpoint(eager=True)
    if shuffle:
        ranked = shuffled_ranks(narrow, key_cols, seed, epoch, digits)
    else:
        if len(key_cols) != 2:
            raise ValueError("unshuffled order needs (group, order) key columns")
        ranked = ordered_ranks(narrow, key_cols[0], key_cols[1])
    w = Window.partitionBy("batch_id")  # a batch holds at most batch_size rows
    return assign_batches(ranked, batch_size).select(
        *key_cols, "batch_id", "pos", F.max("_s").over(w).alias("src_max_len"), F.max("_t").over(w).alias("tgt_max_len"))


def collate_columns(d: DataFrame, src_col: str, tgt_col: str, src_pad: int, tgt_pad: int) -> DataFrame:
    """X13-X17 given per-row batch maxima."""
    tgt_padded = ax.pad(tgt_col, F.col("tgt_max_len"), tgt_pad)
    return d.select(
        "*",
        ax.pad(src_col, F.col("src_max_len"), src_pad).alias("src_input_ids"),
        tgt_padded.alias("_tgt_padded"),
    ).select(
        "*",
        ax.pad_mask("src_input_ids", src_pad).alias("src_pad_mask"),
        ax.shift_input("_tgt_padded").alias("tgt_input_ids"),
        ax.ignore_index(ax.shift_labels("_tgt_padded"), tgt_pad).alias("tgt_outputs"),
    ).select("*", ax.pad_mask("tgt_input_ids", tgt_pad).alias("tgt_pad_mask")).drop("_tgt_padded")


def collate(tokens: DataFrame, key_cols: list[str], batch_size: int = MICRO_BATCH, seed: int | str = 42,
            epoch: int = 0, shuffle: bool = True, src_col: str = "src_ids", tgt_col: str = "tgt_ids",
            src_pad: int = PAD_ID, tgt_pad: int = PAD_ID, digits: int | None = None,
            materialize: bool = False) -> DataFrame:
    """C4: token table -> one row per example with its batch tensors.

    Output: *key_cols, batch_id, pos, src_input_ids, src_pad_mask,
    tgt_input_ids, tgt_pad_mask, tgt_outputs.  With ``materialize`` the
    token table is reliably checkpointed first (use it when ``tokens`` is a
    long plan rather than a stored dataset: the ranking reads it several
    times).
    """
    if materialize:
        ensure_checkpoint_dir(tokens.sparkSession)
        tokens = tokens.checkpoint(eager=True)
    layout = batch_layout(tokens, key_cols, batch_size, seed, epoch, shuffle, src_col, tgt_col, digits)
    d = tokens.join(layout, key_cols)  # the one shuffle of the token arrays
    out = collate_columns(d, src_col, tgt_col, src_pad, tgt_pad)
    return out.select(*key_cols, "batch_id", "pos", "src_input_ids", "src_pad_mask", "tgt_input_ids",
                      "tgt_pad_mask", "tgt_outputs")
