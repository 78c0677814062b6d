"""Decoding ids back to text.

The id -> token lookup is a literal array indexed by id (vocabularies have
dense ids and a size bound), so decoding is a per-row native expression:
no explode, no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import CONTINUATION_PREFIX, MAX_VOCAB, SPECIAL_TOKENS
from .arrays import strip_specials
from .wordpiece import Vocabulary

# FIXED VALUES: after a space-prefixed token, the space is dropped when the
# token starts with one of: .  ?  !  ,  n't  'm  's  've  're
_TIDY = r"^ (?=[.?!,]|n't|'m|'s|'ve|'re)"


def id_to_token(ids: Column, vocab: Vocabulary) -> Column:
    """Ids -> tokens; unknown ids become null."""
    table = vocab.tokens_by_id()
    if len(table) > MAX_VOCAB:
        raise ValueError(f"vocabulary of {len(table)} ids is above the bound {MAX_VOCAB}")
    # one string literal, split by a constant-folded expression: a literal per token would take seconds to plan
    mark = next(m for m in ("\x00", "\x01", "\ufdd0", "\ufdd1") if not any(t and m in t for t in table))
    lut = F.split(F.lit(mark.join(t or "" for t in table)), mark, -1)
    return F.transform(ids, lambda i: F.when((i >= 0) & (i < len(table)), F.nullif(F.get(lut, i), F.lit(""))))


def join_pieces(tokens: Column, prefix: str = CONTINUATION_PREFIX) -> Column:
    """X11 text assembly: the first token as is; a later ``##`` token glued
    to the previous one; any other token after a space, tidied."""
    plen = len(prefix)

    def piece(t: Column, i: Column) -> Column:
        return (F.when(i == 0, t)
                .when(t.startswith(prefix), F.substring(t, plen + 1, 1 << 30))
                .otherwise(F.regexp_replace(F.concat(F.lit(" "), t), _TIDY, "")))

    return F.array_join(F.transform(tokens, piece), "")


def decode(ids: Column, vocab: Vocabulary, skip_special_tokens: bool = True) -> Column:
    """X11 (+X12): ids -> text."""
    if skip_special_tokens:
        special_ids = [vocab.token_to_id[t] for t in SPECIAL_TOKENS if t in vocab.token_to_id]
        ids = strip_specials(ids, special_ids)
    toks = F.filter(id_to_token(ids, vocab), lambda t: t.isNotNull())
    return F.when(ids.isNotNull(), join_pieces(toks))


def decode_list(lists: Column | str, vocab: Vocabulary, skip_special_tokens: bool = True) -> Column:
    """X11 on a list of id lists (``array<array<int>>``): a list of texts, the
    inverse of ``wordpiece.encode_list``; a null list of ids gives a null text."""
    lists = F.col(lists) if isinstance(lists, str) else lists
    return F.transform(lists, lambda ids: decode(ids, vocab, skip_special_tokens))
