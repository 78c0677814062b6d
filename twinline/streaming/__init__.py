"""Streaming use of the stateless column functions.

The reference has no streams, watermarks or state.  Its text functions
(normalise, pre-tokenise, encode, decode, pad) are stateless per row, so the
same Column expressions apply unchanged to a streaming DataFrame; this
module wires them to a file source and a parquet sink with an exactly-once
checkpoint, for pair files that arrive over time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..constants import MAX_LENGTH, MIN_TARGET_LENGTH
from ..functions import wordpiece as wp
from ..plans.jobs import tokenize_pairs
from ..sources.store import RAW_SCHEMA


def tokenize_stream(pairs: DataFrame, src_vocab: wp.Vocabulary, tgt_vocab: wp.Vocabulary,
                    max_length: int = MAX_LENGTH, min_length: int = MIN_TARGET_LENGTH) -> DataFrame:
    """C3 over a streaming (or batch) pair table: stateless, row by row."""
    return tokenize_pairs(pairs, src_vocab, tgt_vocab, max_length, min_length)


def start_tokenize_files(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_location: str,
                         src_vocab: wp.Vocabulary, tgt_vocab: wp.Vocabulary,
                         available_now: bool = True) -> StreamingQuery:
    """Read parquet pair files as they land in ``source_dir``, write token
    rows to ``sink_dir`` (partitioned by split).  ``checkpoint_location``
    must be on shared storage."""
    src = spark.readStream.schema(RAW_SCHEMA).parquet(source_dir)
    out = tokenize_stream(src, src_vocab, tgt_vocab)
    w = (out.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_location).partitionBy("split").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
