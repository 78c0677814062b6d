import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from twinline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def test_documents(docs, texts, library):
    got = {r["doc_id"]: r for r in bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN, digest=True).collect()}
    assert len(got) == len(texts)
    for i, t in texts.items():
        ids = np.array(library.encode_ordinary(t or ""), "<u4")
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


TRICKY = ["", "a" * 5000, "日本語テキスト  \n\n x", " \t  x", "it's 12345 !!! \U0001f600‍", "x  y z", "<|endoftext|>", "xyz" * 400,
          "\x00\x01 \x85 \x1c", "ÀÈ" * 200, "don't we'll I've", None]


def test_tricky_texts_and_round_trip(spark, library):
    df = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string").repartition(2)
    enc = bpe.encode_documents(df, PATH, public_tokenizers.PATTERN)
    got = {r["doc_id"]: r["ids"] for r in enc.collect()}
    assert got == {i: library.encode_ordinary(t or "") for i, t in enumerate(TRICKY)}
    back = {r["doc_id"]: r["decoded"] for r in bpe.decode_documents(enc, PATH).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(TRICKY)}
    with pytest.raises(Exception, match="out of the vocabulary"):
        bpe.decode_documents(spark.createDataFrame([(1, [5, 10**6])], "doc_id long, ids array<int>"), PATH).collect()


def plain_merge(word, ranks):
    """One merge at a time: the leftmost pair of the smallest rank."""
    parts = [word[i:i + 1] for i in range(len(word))]
    while True:
        best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def ids_of(pieces):
    return [np.frombuffer(x, "<u4").tolist() for x in pieces]


@pytest.fixture()
def task():
    t = bpe.TaskBpe(bpe.Vocabulary(bpe.load_ranks(PATH)))
    yield t
    t.close()


def test_both_queries_follow_the_rule(task):
    rng = random.Random(3)
    words = ["".join(rng.choice("aeinrstéß0 ") for _ in range(rng.randint(1, 90))).encode() for _ in range(300)]
    want = [plain_merge(w, task.ranks) for w in words]
    assert ids_of(task.merge(words)) == want
    assert ids_of(task._merge_short(words)) == want
    assert ids_of(task._merge_long(words)) == want


def test_queries_on_odd_vocabularies():
    """Vocabularies in which a longer entry ranks before its parts, so that a
    joined token may pair with a neighbour before the next occurrence."""
    rng = random.Random(7)
    for trial in range(40):
        entries = {bytes([c]) for c in b"abc"}
        while len(entries) < 14:
            a, b = rng.sample(sorted(entries), 2) if rng.random() < 0.8 else [rng.choice(sorted(entries))] * 2
            entries.add(a + b)
        order = sorted(entries)
        rng.shuffle(order)
        ranks = {t: k for k, t in enumerate(order)}
        task = bpe.TaskBpe(bpe.Vocabulary(ranks))
        words = ["".join(rng.choice("abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(1, 40))).encode() for _ in range(40)]
        want = [plain_merge(w, ranks) for w in words]
        assert ids_of(task._merge_short(words)) == want, trial
        assert ids_of(task._merge_long(words)) == want, trial
        assert ids_of(task.merge(words)) == want, trial
        task.close()


@pytest.mark.parametrize("word", ["a" * 20_000, "ab" * 20_000, "etaoinshrdlu" * 2000, "日本語テキスト" * 2000, "aaabaaab" * 3000])
def test_long_words_take_few_rounds(task, library, word):
    t0 = time.process_time()
    assert ids_of(task.merge([word.encode()])) == [library.encode_ordinary(word)]
    assert time.process_time() - t0 < 20


def test_long_word_of_random_letters(task, library):
    rng = random.Random(5)
    for letters, n in (("etaoins", 3000), ("abcdefghijklmnopqrstuvwxyz", 20_000)):
        word = "".join(rng.choice(letters) for _ in range(n))
        assert ids_of(task.merge([word.encode()])) == [library.encode_ordinary(word)]


def test_remembered_words_are_bounded():
    kept = bpe.Remembered(40 * (bpe.ENTRY_BYTES + 10))
    for k in range(0, 1000, 10):
        keys = ["often", *(f"w{i:06d}" for i in range(k, k + 10))]
        got = kept.look(keys)
        new = [x for x, v in zip(keys, got) if v is None]
        kept.keep(new, [x.encode() for x in new])
        assert k == 0 or got[0] == b"often"
        assert len(kept.young) + len(kept.old) <= 40
    assert kept.look(["w000001"]) == [None] and kept.look(["w000999"]) == [b"w000999"]


def test_edge_rows(edge, empty, library):
    got = bpe.encode_documents(edge, PATH, public_tokenizers.PATTERN).collect()
    want = [(r["doc_id"], library.encode_ordinary(r["text"] or "")) for r in edge.collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=key) == sorted(want, key=key)
    assert bpe.encode_documents(empty, PATH, public_tokenizers.PATTERN).count() == 0


def test_text_of_several_million_tokens(spark, library):
    text = "0;" * 3_000_000 + "end"
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string").unionByName(
        spark.range(1).selectExpr("3L AS doc_id", "concat(repeat('0;', 3000000), 'end') AS text")).coalesce(1)
    got = {r["doc_id"]: r for r in bpe.encode_documents(df, PATH, public_tokenizers.PATTERN, digest=True).collect()}
    ids = np.array(library.encode_ordinary(text), "<u4")
    assert len(ids) > 5_000_000
    assert (got[3]["n_tokens"], got[3]["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
    assert {i: r["decoded_sha256"] for i, r in got.items()} == {
        i: hashlib.sha256(t.encode()).hexdigest() for i, t in ((1, "a b"), (2, ""), (3, text))}


def test_pieces_of_the_longest_tokens_fit():
    ranks = bpe.load_ranks(PATH)
    longest = max(ranks, key=len)
    task = bpe.TaskBpe(bpe.Vocabulary(ranks))
    n = 3 * bpe.DECODE_TOKENS + 5
    ids = np.full(n, ranks[longest], "<u4")
    whole = hashlib.sha256(longest * (n - 7)).hexdigest()
    assert task.decoded_sha256(ids, np.array([0, 7, 7, n])) == [
        hashlib.sha256(longest * 7).hexdigest(), hashlib.sha256(b"").hexdigest(), whole]
    task.close()


def test_batch_is_cut_without_a_number_for_each_word():
    """Byte positions come from the offsets of the words, also of a slice and of no words."""
    import pyarrow as pa
    words = pa.array(["skipped", "ab", "c", "", "éé", "f"])
    for kind in (pa.string(), pa.large_string()):
        part = words.cast(kind).slice(1)
        upto = bpe._bytes_upto(part, np.array([0, 2, 2, 5]))
        assert (upto - upto[0]).tolist() == [0, 3, 3, 8]
    assert bpe._bytes_upto(pa.array([], pa.string()), np.array([0, 0])).tolist() == [0, 0]
    assert list(bpe._slices(np.array([7, 10, 10, 15, 40]), 5)) == [(0, 2), (2, 3), (3, 4)]


def test_memory_of_a_task_beside_its_batch():
    """Cutting a batch of a million words takes no more than its rows do."""
    import tracemalloc
    import pyarrow as pa
    words = pa.array(["word"] * 1_000_000)
    ends = np.arange(0, 1_000_001, 100)
    tracemalloc.start()
    assert len(list(bpe._slices(bpe._bytes_upto(words, ends), 1 << 16))) == 62
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 1_000_000
