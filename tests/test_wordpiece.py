"""Encode / decode goldens (FIXTURES.md section 4) and a library cross-check."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from twinline.constants import SPECIAL_TOKENS
from twinline.functions import decode as dec
from twinline.functions import text as tx
from twinline.functions import wordpiece as wp
from twinline.operators import align, counts
from twinline.sources import tables


def _vocab(tokens):
    return wp.Vocabulary({t: i for i, t in enumerate(list(SPECIAL_TOKENS) + tokens)})


def _enc(spark, vocab, texts, **kw):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(wp.encode_target(F.col("t"), vocab, spark, **kw)).collect()]


def test_unknown_piece_makes_whole_word_unknown(spark):
    v = _vocab(["a", "b", "##b", "##z"][:3])
    assert _enc(spark, v, ["abz"]) == [[2, 0, 3]]


def test_long_word_limit(spark):
    v = _vocab(["a", "##a"])
    out = _enc(spark, v, ["a" * 100, "a" * 101])
    assert out[0] == [2, 4] + [5] * 99 + [3]
    assert out[1] == [2, 0, 3]


def test_special_passthrough_and_empty(spark):
    v = _vocab(["[", "]", "x", "y", "pad", "p", "##a", "##d"])
    out = _enc(spark, v, ["[pad] x[PAD]y [PAD]", "", None])
    t = {i: s for s, i in v.token_to_id.items()}
    assert [t[i] for i in out[0]] == ["[BOS]", "[", "pad", "]", "x", "[PAD]", "y", "[PAD]", "[EOS]"]
    assert out[1] == [2, 3]
    assert out[2] is None


def test_truncate_before_specials(spark):
    v = _vocab(["a", "b", "ab", "abc", "aab", "##b", "##c"])
    out = _enc(spark, v, ["ab abc aab"], truncate=True, max_length=4)
    t = {i: s for s, i in v.token_to_id.items()}
    assert [t[i] for i in out[0]] == ["[BOS]", "ab", "abc", "[EOS]"]


@pytest.mark.parametrize("tokens,expected", [
    ("do not I 'm a ##b . he ' s ##x !", "do not I'm ab. he ' sx!"),
    ("##a b ? , n't 've 're 's", "##a b?,n't've're's"),
])
def test_decode(spark, tokens, expected):
    toks = tokens.split(" ")
    v = _vocab(sorted(set(toks)))
    ids = [v.token_to_id[t] for t in toks]
    df = spark.createDataFrame([(ids,)], "ids array<int>")
    assert df.select(dec.decode(F.col("ids"), v)).first()[0] == expected


def test_decode_skips_specials_and_unknown_ids(spark):
    v = _vocab(["a", "b"])
    df = spark.createDataFrame([([2, 4, 1, 5, 99, 3],)], "ids array<int>")
    assert df.select(dec.decode(F.col("ids"), v)).first()[0] == "a b"
    assert df.select(dec.decode(F.col("ids"), v, skip_special_tokens=False)).first()[0] == "[BOS] a [PAD] b [EOS]"


def test_matches_public_tokenizers_library(spark):
    tk = pytest.importorskip("tokenizers")
    from tokenizers import Tokenizer, normalizers, pre_tokenizers
    from tokenizers.models import WordPiece
    from tokenizers.processors import TemplateProcessing
    docs = tables.documents(spark, "/root/testdata/sf0.001")
    vdf = counts.vocab_freq(counts.word_counts(docs), 500)
    v = wp.Vocabulary.from_df(vdf)
    lines = align.corpus_lines(docs)
    got = {(r["corpus"], r["lang"], r["line_no"]): (r["text"], r["ids"]) for r in
           lines.select("corpus", "lang", "line_no", "text",
                        wp.encode_target(F.col("text"), v, spark).alias("ids")).collect()}
    t = Tokenizer(WordPiece(vocab=v.token_to_id, unk_token="[UNK]", max_input_chars_per_word=100))
    t.normalizer = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
    t.pre_tokenizer = pre_tokenizers.Whitespace()
    t.add_special_tokens(list(SPECIAL_TOKENS))
    t.post_processor = TemplateProcessing(single="[BOS] $A [EOS]", special_tokens=[("[BOS]", 2), ("[EOS]", 3)])
    bad = [k for k, (text, ids) in got.items() if t.encode(text).ids != ids]
    assert not bad, bad[:5]


def test_vocab_broadcast_bound():
    assert wp.MAX_VOCAB >= 32000


def test_encode_list_matches_per_text(spark):
    v = _vocab(["a", "b", "ab", "##b", "le", "."])
    df = spark.createDataFrame([(0, ["ab le.", "", "a b"]), (1, []), (2, None), (3, ["zz"])],
                               "k long, texts array<string>")
    got = {r["k"]: r["ids"] for r in wp.encode_list(df, "texts", v).collect()}
    each = {t: i for t, i in zip(["ab le.", "", "a b", "zz"],
                                 _enc(spark, v, ["ab le.", "", "a b", "zz"]))}
    assert got[0] == [each["ab le."], each[""], each["a b"]]
    assert got[1] == [] and got[2] is None and got[3] == [each["zz"]]


def test_encode_rejects_non_columns(spark):
    with pytest.raises(TypeError):
        wp.encode_target("plain string", _vocab(["a"]), spark)


def longest_match(word, vocab, unk=0, prefix="##"):
    """The definition: try every end, the longest first."""
    out, start = [], 0
    while start < len(word):
        for end in range(len(word), start, -1):
            piece = word[start:end] if start == 0 else prefix + word[start:end]
            if piece in vocab:
                out.append(vocab[piece])
                start = end
                break
        else:
            return [unk]
    return out if len(word) <= 100 else [unk]


class CountedSteps(dict):
    probes = 0

    def get(self, key, default=None):
        CountedSteps.probes += 1
        return dict.get(self, key, default)


def test_matcher_equals_the_definition_in_linear_probes():
    rnd = random.Random(4)
    for trial in range(60):
        letters = "ab#é"[:rnd.randint(2, 4)]
        some = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 6))) for _ in range(25)]
        tokens = [*SPECIAL_TOKENS, *dict.fromkeys([*some[:12], *("##" + t for t in some[12:])])]
        vocab = {t: i for i, t in enumerate(tokens)}
        steps, fails, pops = wp.build_matcher(vocab)
        matcher = (CountedSteps(steps), fails, pops)
        for _ in range(120):
            word = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30)))
            CountedSteps.probes = 0
            assert wp.match_pieces(word, matcher, 0) == longest_match(word, vocab), (vocab, word)
            assert CountedSteps.probes <= 2 * len(word)


def test_matcher_on_every_word_of_the_documents(spark):
    wc = counts.word_counts(tables.documents(spark, "/root/testdata/sf0.01"))
    v = wp.Vocabulary.from_df(counts.vocab_freq(wc, 2000))
    matcher = wp.build_matcher(v.token_to_id)
    words = [r["word"] for r in wc.select("word").collect()]
    assert len(words) > 60_000
    for w in [*words, "a" * 100, "a" * 101, "###", "##a", "[UNK]", "[PAD]x"]:
        assert wp.match_pieces(w, matcher, 0) == longest_match(w, v.token_to_id), w


def test_encode_list_after_shuffles_keeps_every_row(spark):
    """A grouping and a merge join with a wide payload in front: all rows, each with its own ids."""
    v = _vocab(["a", "b", "ab", "##b", "le", "."])
    base = spark.range(4000).select("id", F.array(*[F.when(F.col("id") % k == 0, "ab le.").otherwise("a b") for k in (2, 3, 5)]).alias("texts"),
                                    F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 512) for i in range(8)]).alias("wide"))
    grouped = base.groupBy("id").agg(F.first("texts").alias("texts"), F.first("wide").alias("wide"))
    joined = grouped.hint("merge").join(base.select("id", F.col("wide").alias("other")), "id")
    long_, short = _enc(spark, v, ["ab le.", "a b"])
    for df in (grouped, joined):
        got = {r["id"]: r["ids"] for r in wp.encode_list(df, "texts", v).select("id", "ids").collect()}
        assert got == {i: [long_ if i % k == 0 else short for k in (2, 3, 5)] for i in range(4000)}


def test_source_profile_equals_the_public_library(spark):
    """Every white-space and control character, and literal specials."""
    import unicodedata

    from tokenizers import normalizers, pre_tokenizers

    from twinline.functions import text as tx

    odd = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) <= 0xDFFF
           and (c.isspace() or unicodedata.category(c) in ("Cc", "Cf", "Zs", "Zl", "Zp"))]
    rows = [f"ab{c}Cd é{c} x" for c in odd]
    norm, pre = normalizers.BertNormalizer(), pre_tokenizers.BertPreTokenizer()
    df = spark.createDataFrame(list(enumerate(rows)), "i long, t string")
    got = {r["i"]: r["w"] for r in df.select("i", tx.source_words(F.col("t")).alias("w")).collect()}
    want = {i: [w for w, _ in pre.pre_tokenize_str(norm.normalize_str(t))] for i, t in enumerate(rows)}
    # the library's character tables are older than the JVM's: format characters that they do not know stay in its words
    assert {odd[i] for i in got if got[i] != want[i]} <= {c for c in odd if ord(c) in (0x8E2, 0x890, 0x891, 0x110CD, *range(0x13430, 0x13440))}
    special = {"a[SEP]b [PAD]": ["a", "[SEP]", "b", "[PAD]"], "[sep] [CLS": ["[", "sep", "]", "[", "cls"],
               "[SE\ufdd0P] \ufdd1[MASK][MASK]": ["[", "sep", "]", "[MASK]", "[MASK]"]}
    df = spark.createDataFrame([(t,) for t in special], "t string")
    got = {r["t"]: r["w"] for r in df.select("t", tx.source_words(F.col("t"), wp.BERT_SOURCE.specials).alias("w")).collect()}
    assert got == special


def test_training_words_treat_specials_as_text(spark):
    from twinline.operators import counts

    df = spark.createDataFrame([("x[PAD]y [PAD] abc",)], "text string")
    base = {r["token"] for r in counts.initial_vocab(counts.word_counts(df)).collect()}
    assert {t for t in base if len(t) == 1} == set("[]abcdpxy")


def test_decode_of_a_large_vocabulary_is_planned_quickly(spark):
    import time

    from twinline.functions import decode as dec

    v = wp.Vocabulary({t: i for i, t in enumerate(list(SPECIAL_TOKENS) + [f"tok{i}" for i in range(32_000)])})
    t0 = time.perf_counter()
    df = spark.createDataFrame([([2, 5, 31_999, 40_000, 3],)], "ids array<int>")
    row = df.select(dec.decode(F.col("ids"), v).alias("t")).first()
    assert row["t"] == "tok1 tok31995" and time.perf_counter() - t0 < 5


def test_chunks_give_what_whole_batches_give(spark, monkeypatch):
    """Rows longer than a chunk, several rows a chunk, empty and null rows; with and without a cut."""
    v = _vocab(["a", "b", "##a", "##b", "ab", "##ab"])
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abz") for _ in range(rng.randint(1, 5))) for _ in range(rng.choice([0, 1, 3, 40]))) for _ in range(60)]
    texts[7:9] = [None, ""]
    whole = [_enc(spark, v, texts), _enc(spark, v, texts, truncate=True, max_length=9)]
    assert [None if x is None else ([2, *x[1:-1][:7], 3]) for x in whole[0]] == whole[1]
    monkeypatch.setattr(wp, "_CHUNK_WORDS", 5)
    assert [_enc(spark, v, texts), _enc(spark, v, texts, truncate=True, max_length=9)] == whole


def test_words_in_flight_and_known_words_are_bounded(spark, monkeypatch):
    """Python strings of one chunk at a time; the known words stay within their limit."""
    import pyarrow as pa
    v = _vocab(["a", "##a"])
    monkeypatch.setattr(wp, "_CHUNK_WORDS", 50)
    monkeypatch.setattr(wp, "_MEMO_LIMIT", 30)
    seen, sizes = [], []
    split = wp.match_pieces
    monkeypatch.setattr(wp, "match_pieces", lambda *a: (seen.append(len(next(iter(wp._MEMOS.values())))), split(*a))[1])
    encode = wp.pc.dictionary_encode
    monkeypatch.setattr(wp.pc, "dictionary_encode", lambda x: (sizes.append(len(x)), encode(x))[1])
    words = [["a" * (1 + (7 * i + k) % 90) for k in range(40)] for i in range(20)]
    udf = wp._wordpiece_udf(v.broadcast(spark), 0, 100, {})
    got = udf.func(pa.array(words, pa.list_(pa.string())))
    assert got.to_pylist() == [[i for w in row for i in [4] + [5] * (len(w) - 1)] for row in words]
    assert max(sizes) <= 50 and max(seen) <= 30


def test_splitting_many_distinct_words_takes_little_memory(spark):
    """What Python holds while and after 300,000 different words are split, words of no piece among them."""
    import tracemalloc
    import pyarrow as pa
    v = _vocab([*"0123456789", *(f"##{d}" for d in range(10))])
    udf = wp._wordpiece_udf(v.broadcast(spark), 0, 100, {})
    words = pa.array([[f"{i + k}" for k in range(100)] for i in range(1_000_000, 1_300_000, 100)] + [[], None, ["", "x", "12"]], pa.list_(pa.string()))
    v.broadcast(spark).value
    tracemalloc.start()
    try:
        got = udf.func(words)
        held, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert len(got) == 3003 and got[3000:].to_pylist() == [[], None, [0, 5, 16]]
    assert got[1].as_py() == [i for k in range(100) for i in [5, *(14 + int(d) for d in f"{1_000_100 + k}"[1:])]]
    assert held < 20e6 and peak < 40e6, (held, peak)


def test_filter_on_ids_does_not_split_words_twice(spark):
    v = _vocab(["a", "##a"])
    df = spark.createDataFrame([("a aa",), ("a",)], "t string")
    ids = df.select(wp.encode_target(F.col("t"), v, spark).alias("ids")).where(F.size("ids") > 3)
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert plan.count("encode_words(") == 1, plan
    assert [r[0] for r in ids.collect()] == [[2, 4, 4, 5, 3]]


def test_normalising_in_slices_keeps_every_row(spark):
    texts = [None if i % 7 == 0 else ("é" * (i % 5) + "ế" if i % 3 else "plain") for i in range(1000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    got = [r[0] for r in df.select("i", tx.nfc("t").alias("n")).orderBy("i").select("n").collect()]
    assert got == [None if t is None else unicodedata.normalize("NFC", t) for t in texts]


def test_normalising_holds_few_rows_as_strings(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(tx, "_SLICE_ROWS", 16)
    calls = []
    out = tx._normalized(pa.array(["é"] * 100), "NFC", lambda a: (calls.append(len(a)), a)[1])
    assert out.to_pylist() == ["é"] * 100 and max(calls) <= 16 and sum(calls) == 100
