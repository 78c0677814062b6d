"""Token counts per section by offset mapping.

Method.  A whole document is encoded once with a public byte-level BPE
vocabulary.  The tokens' byte lengths give their byte offsets, and the text's
code point starts turn those into character spans.  An interval join inside
the document (binary search of span ends among section starts) attributes each
token.  Sections are the document's lines; a line owns its line feed.

Boundary rule (``rule``):
  ``start``  a token belongs to the section of its first character;
  ``end``    to that of its last character;
  ``most``   to the section that holds most of its characters, the earlier on
             ties.
Each token is attributed exactly once, so the sections of a document sum to
its tokens.  A character cut into several tokens belongs to each of them for
the purpose of spans.

Defined results: a null or empty text has one empty section with no tokens;
an empty table gives an empty result; extra columns are ignored, whatever
their names; repeated rows give repeated sections.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinline.llm.common import chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 1 << 22
RULES = ("start", "end", "most")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def token_spans(text: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character spans [start, end) of tokens with these byte lengths."""
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    starts_char = (raw & 0xC0) != 0x80
    upto = np.concatenate([[0], np.cumsum(starts_char)])       # characters that begin before a byte
    ends_b = np.cumsum(lengths)
    begins_b = ends_b - lengths
    first = upto[begins_b] - (~starts_char[begins_b] if len(begins_b) else 0)  # inside a character: that character
    return first.astype(np.int64), upto[ends_b].astype(np.int64)


def attribute(first: np.ndarray, end: np.ndarray, section_starts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, and whether it crosses a boundary."""
    a = np.searchsorted(section_starts, first, side="right") - 1
    z = np.searchsorted(section_starts, np.maximum(end - 1, first), side="right") - 1
    if rule == "start":
        got = a
    elif rule == "end":
        got = z
    else:
        got = a.copy()
        bounds = np.append(section_starts, np.iinfo(np.int64).max)
        for i in np.nonzero(z > a)[0]:
            part = [min(end[i], bounds[s + 1]) - max(first[i], bounds[s]) for s in range(a[i], z[i] + 1)]
            got[i] = a[i] + int(np.argmax(part))
    return got, z > a


def section_token_counts(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                         rule: str = "start") -> DataFrame:
    """One row per document and line: id, ``section``, ``start_char``,
    ``n_chars``, ``n_tokens``, ``n_crossing`` and the document's ``doc_tokens``."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))  # one vocabulary: fixed size
    src = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    id_type = src.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = shared.value
        enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            size[i] = len(token)
        for b in chunks(batches, "_text", CHUNK_BYTES):
            row, sect, start, chars, toks, cross, total = [], [], [], [], [], [], []
            for k, text in enumerate(b.column("_text").to_pylist()):
                lengths = size[np.array(enc.encode_ordinary(text), np.int64)]
                lines = [len(x) + 1 for x in text.split("\n")]
                lines[-1] -= 1
                starts = np.concatenate([[0], np.cumsum(lines[:-1])]).astype(np.int64)
                first, end = token_spans(text, lengths)
                got, over = attribute(first, end, starts, rule)
                n = len(lines)
                row.append(np.full(n, k))
                sect.append(np.arange(n))
                start.append(starts)
                chars.append(np.array(lines))
                toks.append(np.bincount(got, minlength=n))
                cross.append(np.bincount(got[over], minlength=n))
                total.append(np.full(n, len(lengths)))
            cols = [np.concatenate(x).astype(np.int64) for x in (sect, start, chars, toks, cross, total)]
            ids = b.column("_id").take(pa.array(np.concatenate(row)))
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, cols)], names=[
                "_id", "section", "start_char", "n_chars", "n_tokens", "n_crossing", "doc_tokens"])

    schema = (f"_id {id_type}, section long, start_char long, n_chars long, n_tokens long, n_crossing long, doc_tokens long")
    return src.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
