import numpy as np
import public_tokenizers
import pytest
import tiktoken

from twinline.llm import token_counts as tc

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RUN = (PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tc.load_ranks(PATH), special_tokens={})


def plain(text, library, rule):
    """Tokens per line, one character at a time."""
    text = text or ""
    owner, line = [], 0                       # line of each byte
    at = []                                   # character of each byte
    for c, ch in enumerate(text):
        n = len(ch.encode())
        owner += [line] * n
        at += [c] * n
        line += ch == "\n"
    counts, cross, pos = [0] * (line + 1), [0] * (line + 1), 0
    for t in library.encode_ordinary(text):
        n = len(library.decode_single_token_bytes(t))
        chars = {at[b]: owner[b] for b in range(pos, pos + n)}
        lines = [chars[c] for c in sorted(chars)]
        got = {"start": lines[0], "end": lines[-1], "most": max(sorted(set(lines)), key=lines.count)}[rule]
        counts[got] += 1
        cross[got] += len(set(lines)) > 1
        pos += n
    return list(zip(counts, cross))


@pytest.mark.parametrize("rule", tc.RULES)
def test_rules(spark, library, rule):
    texts = ["", None, "a\nb", "x\n\n\n\ny", "\n", "日本\n語\U0001f600\U0001f469‍\n\n\n  z", "one two\n  three\n\n\n\n\n four", "no newline"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {}
    for r in tc.section_token_counts(df, *RUN, rule=rule).collect():
        got.setdefault(r["doc_id"], {})[r["section"]] = (r["n_tokens"], r["n_crossing"])
    for i, t in enumerate(texts):
        assert [got[i][s] for s in sorted(got[i])] == plain(t, library, rule)


def test_documents(docs, texts, library):
    total, chars = {}, {}
    for r in tc.section_token_counts(docs, *RUN).collect():
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["n_tokens"]
        chars[r["doc_id"]] = chars.get(r["doc_id"], 0) + r["n_chars"]
        assert texts[r["doc_id"]][r["start_char"]:r["start_char"] + r["n_chars"]].count("\n") <= 1
    assert total == {i: len(library.encode_ordinary(t or "")) for i, t in texts.items()}
    assert chars == {i: len(t or "") for i, t in texts.items()}


def test_spans_inside_a_character():
    first, end = tc.token_spans("é\U0001f600x", np.array([1, 1, 2, 2, 1]))
    assert first.tolist() == [0, 0, 1, 1, 2] and end.tolist() == [1, 1, 2, 2, 3]


def test_edge_rows(edge, empty):
    got = tc.section_token_counts(edge, *RUN).collect()
    assert len(got) == sum((r["text"] or "").count("\n") + 1 for r in edge.collect())
    assert tc.section_token_counts(empty, *RUN).count() == 0
    with pytest.raises(ValueError, match="rule"):
        tc.section_token_counts(edge, *RUN, rule="half")
