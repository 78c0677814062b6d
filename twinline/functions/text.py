"""Text normalisation and pre-tokenisation as Spark Column expressions.

Everything here stays in the JVM (whole-stage codegen) except Unicode
normalisation, which Spark has no built-in for.  That one runs as an Arrow
UDF, and only on rows that could change: a row is sent to Python only when
it holds a character that NFC may rewrite (see ``_nfc_gate_class``);
otherwise the UDF receives a null, which costs one validity bit.

Target profile (the trained French vocabulary):
    specials split out -> NFC -> lowercase -> word runs / punctuation runs
Source profile (BERT-uncased style):
    clean control chars -> space CJK ideographs -> strip accents -> lowercase
    -> word runs / single punctuation characters
"""

from __future__ import annotations

import sys

import functools
import re
import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import SPECIAL_TOKENS

# Executors need not have this package installed: the UDFs of this module
# travel with the task (pickled by value) instead of by import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---------------------------------------------------------------- patterns

# FIXED VALUES: a literal special token in raw text is kept whole and
# matched case-sensitively before any normalisation.
_SPECIAL_ALT = r"\[(?:UNK|PAD|BOS|EOS)\]"

# Word runs and punctuation runs; whitespace is dropped.  (?U) makes \w and
# \s Unicode-aware (letters, marks, digits, letter numbers, connectors).
# Punctuation runs stop in front of a special token so `?[PAD]` -> `?`, `[PAD]`.
PRE_TOKENIZE_PATTERN = (
    _SPECIAL_ALT + r"|(?U)\w+|(?U)(?:(?!" + _SPECIAL_ALT + r")[^\w\s])+"
)

# Source profile: whitespace is tab/newline/CR or any separator (spaces, line
# and paragraph separators); punctuation is every ASCII non-alphanumeric
# printable or any Unicode P* character.  Literal specials travel through the
# normaliser as noncharacters (see source_normalize), a word each.
_SRC_SPACE = r"\t\n\r\p{Z} "
_SRC_PUNCT = r"!-/:-@\[-`{-~\p{P}"
_STAND_IN = 0xFDD0
_STAND_INS = r"\x{FDD0}-\x{FDEF}"
SOURCE_PRE_TOKENIZE_PATTERN = (
    "[^" + _SRC_SPACE + _SRC_PUNCT + _STAND_INS + "]+|[" + _SRC_PUNCT + _STAND_INS + "]"
)
# CJK ideograph blocks that the source profile surrounds with spaces.
_CJK = (
    r"[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
    r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}]"
)


@functools.lru_cache(maxsize=1)
def _nfc_gate_class() -> str:
    """Java regex class of characters that can make NFC change a string.

    Derived by rule from the Unicode database: combining marks, characters
    not stable under NFC, and second halves of canonical compositions (which
    includes the Hangul vowel and trailing jamo).  A string without any of
    them is already NFC.
    """
    second: set[int] = set()
    for cp in range(0x110000):
        d = unicodedata.decomposition(chr(cp))
        if d and not d.startswith("<"):
            parts = d.split()
            if len(parts) == 2:
                second.add(int(parts[1], 16))
    second.update(range(0x1161, 0x1176))
    second.update(range(0x11A8, 0x11C3))
    ranges: list[list[int]] = []
    for cp in range(0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        if unicodedata.category(ch).startswith("M"):
            continue
        if cp in second or unicodedata.combining(ch) or unicodedata.normalize("NFC", ch) != ch:
            if ranges and ranges[-1][1] == cp - 1:
                ranges[-1][1] = cp
            else:
                ranges.append([cp, cp])
    body = "".join(
        f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges
    )
    # Every gate character is >= U+0300.  Java evaluates a class
    # intersection left to right, so one range test rejects nearly all of
    # Latin-1 before the long union is consulted (~50x faster on prose).
    low = min([0x300] + [a for a, _ in ranges])
    return f"[\\x{{{low:X}}}-\\x{{10FFFF}}&&[\\p{{M}}" + body + "]]"


# ---------------------------------------------------------------- Arrow UDFs


_SLICE_ROWS = 256  # rows that are Python strings at a time


def _normalized(s: pa.Array, form: str, then: Callable[[pa.Array], pa.Array] = lambda a: a) -> pa.Array:
    """A batch in slices, so that only a few rows are Python strings at once."""
    if isinstance(s, pa.ChunkedArray):
        s = s.combine_chunks()
    out = [pa.array([], pa.string())]
    for i in range(0, len(s), _SLICE_ROWS):
        part = s.slice(i, _SLICE_ROWS)
        if part.null_count == len(part):
            out.append(pa.nulls(len(part), pa.string()))
        else:
            out.append(then(pa.array([None if x is None else unicodedata.normalize(form, x) for x in part.to_pylist()], pa.string())))
    return pa.concat_arrays(out)


@F.arrow_udf(T.StringType())
def _nfc_arrow(s: pa.Array) -> pa.Array:
    # only gated rows arrive non-null; the rest are nulls (validity bits)
    return _normalized(s, "NFC")


@F.arrow_udf(T.StringType())
def _strip_accents_arrow(s: pa.Array) -> pa.Array:
    return _normalized(s, "NFD", lambda nfd: pc.replace_substring_regex(nfd, pattern=r"\p{Mn}", replacement=""))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- X1 .. X4


def nfc(c: Column | str) -> Column:
    """Unicode NFC.  Rows that NFC cannot change never leave the JVM."""
    c = _col(c)
    return F.coalesce(_nfc_arrow(F.when(c.rlike(_nfc_gate_class()), c)), c)


def lowercase(c: Column | str) -> Column:
    """Unicode lowercase without locale and without the final-sigma rule."""
    return F.lower(F.replace(_col(c), F.lit("Σ"), F.lit("σ")))


def normalize_text(c: Column | str) -> Column:
    """NFC then lowercase (special tokens are not protected here)."""
    return lowercase(nfc(c))


def pre_tokenize(c: Column | str) -> Column:
    """X4 + X7: split into specials, word runs and punctuation runs,
    then lowercase every piece that is not a special token.

    Input should already be NFC (use ``words`` for the whole chain).
    """
    toks = F.regexp_extract_all(_col(c), F.lit(PRE_TOKENIZE_PATTERN), F.lit(0))
    specials = list(SPECIAL_TOKENS)
    return F.transform(toks, lambda t: F.when(t.isin(specials), t).otherwise(lowercase(t)))


# Without literal specials, lowercasing before or after the split is the same
# (lowercase maps word characters to word characters); the whole-text form
# skips the per-token lambda.
_PLAIN_PATTERN = r"(?U)\w+|(?U)[^\w\s]+"


def words(c: Column | str) -> Column:
    """Target-profile words of a text column: X7 -> X1 -> X2 -> X4."""
    c = _col(c)
    n = nfc(c)
    plain = F.regexp_extract_all(lowercase(n), F.lit(_PLAIN_PATTERN), F.lit(0))
    return F.when(c.rlike(_SPECIAL_ALT), pre_tokenize(n)).otherwise(plain)


def plain_words(c: Column | str) -> Column:
    """Words as the vocabulary trainer sees them: X1 -> X2 -> X4, literal
    specials being ordinary text."""
    return F.regexp_extract_all(lowercase(nfc(c)), F.lit(_PLAIN_PATTERN), F.lit(0))


@F.arrow_udf(T.ArrayType(T.StringType()))
def _nfc_list_arrow(s: pa.Array) -> pa.Array:
    return pa.array([None if x is None else [None if t is None else unicodedata.normalize("NFC", t) for t in x]
                     for x in s.to_pylist()], pa.list_(pa.string()))


def words_of_list(c: Column) -> Column:
    """Target-profile words of every element of an array of texts."""
    gate = F.coalesce(F.exists(c, lambda t: t.rlike(_nfc_gate_class())), F.lit(False))
    n = F.coalesce(_nfc_list_arrow(F.when(gate, c)), c)
    return F.transform(n, lambda t: F.when(t.rlike(_SPECIAL_ALT), pre_tokenize(t)).otherwise(
        F.regexp_extract_all(lowercase(t), F.lit(_PLAIN_PATTERN), F.lit(0))))


def source_normalize(c: Column | str, specials: tuple[str, ...] = ()) -> Column:
    """Source profile normaliser (BERT uncased): clean, CJK spacing, strip
    accents, lowercase.  Accent stripping runs in Python only for non-ASCII
    rows.  A literal special of raw text becomes a stand-in noncharacter; the
    text's own noncharacters of that block are removed like all others."""
    c = F.regexp_replace(_col(c), f"[{_STAND_INS}]", "\ufffd")  # removed below; never joins its neighbours before the literals are found
    for i, t in enumerate(specials):
        c = F.replace(c, F.lit(t), F.lit(chr(_STAND_IN + i)))
    cleaned = F.regexp_replace(c, r"[\x{0}\x{FFFD}]|[\p{C}&&[^\t\n\r" + _STAND_INS + "]]", "")
    cleaned = F.regexp_replace(cleaned, r"[\t\n\r\p{Z}]", " ")
    cleaned = F.regexp_replace(cleaned, "(" + _CJK + ")", " $1 ")
    stripped = F.coalesce(_strip_accents_arrow(F.when(cleaned.rlike(r"[^\x{0}-\x{7F}]"), cleaned)), cleaned)
    return lowercase(stripped)


def source_words(c: Column | str, specials: tuple[str, ...] = SPECIAL_TOKENS) -> Column:
    """Source-profile words: whitespace split, each punctuation char alone,
    literal specials whole."""
    toks = F.regexp_extract_all(source_normalize(c, specials), F.lit(SOURCE_PRE_TOKENIZE_PATTERN), F.lit(0))
    marks = "".join(chr(_STAND_IN + i) for i in range(len(specials)))
    has = _col(c).rlike("|".join(re.escape(t) for t in specials)) if specials else F.lit(False)

    def back(t: Column) -> Column:
        at = F.when(F.length(t) == 1, F.instr(F.lit(marks), t)).otherwise(0)
        return F.when(at > 0, F.get(F.array(*[F.lit(x) for x in specials]), at - 1)).otherwise(t)

    return F.when(has, F.transform(toks, back)).otherwise(toks) if specials else toks
