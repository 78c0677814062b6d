"""The whole chain gives identical results under 1, 4 and 17 partitions."""

from pyspark.sql import functions as F

from twinline.functions import wordpiece as wp
from twinline.operators import align, counts, split
from twinline.plans import jobs
from twinline.sources import tables


def _chain(spark, docs, vocab):
    lines = align.corpus_lines(docs, block_rows=16)
    pairs = align.language_pairs(lines)
    sp = split.train_test_split(pairs, ["corpus", "line_no"], 0.05, seed=9)
    tok = jobs.tokenize_pairs(sp, vocab, vocab)
    b = jobs.collate(tok.where("split = 'train'"), batch_size=8, seed=9, epoch=2, digits=2)
    wc = counts.word_counts(docs, by=["lang"])
    return (sorted(map(tuple, b.select("corpus", "line_no", "batch_id", "pos", "src_input_ids",
                                         "tgt_outputs").collect())),
            sorted(map(tuple, wc.collect())))


def test_partition_independence(spark):
    base = tables.table(spark, "/root/testdata/sf0.001", "documents", "doc_id", "text", "lang", "source")
    vocab = wp.Vocabulary.from_df(counts.vocab_freq(counts.word_counts(base), 300))
    results = [_chain(spark, base.repartition(n, F.rand(n)), vocab) for n in (1, 4, 17)]
    assert results[0] == results[1] == results[2]
    assert len(results[0][0]) > 100
