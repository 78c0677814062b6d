"""Native array functions on id sequences.

All are higher-order SQL functions (``transform``, ``filter``, ``slice``),
so they run inside whole-stage codegen with no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import IGNORE_INDEX


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad(ids: Column | str, length: Column, pad_id: int) -> Column:
    """Right-pad to ``length`` with ``pad_id``."""
    ids = _col(ids)
    return F.concat(ids, F.array_repeat(F.lit(pad_id), F.greatest(length - F.size(ids), F.lit(0))))


def pad_mask(padded: Column | str, pad_id: int) -> Column:
    """True where the id is not the pad id (by value)."""
    return F.transform(_col(padded), lambda x: x != F.lit(pad_id))


def shift_input(padded: Column | str) -> Column:
    """All but the last column."""
    p = _col(padded)
    return F.slice(p, 1, F.size(p) - 1)


def shift_labels(padded: Column | str) -> Column:
    """All but the first column."""
    p = _col(padded)
    return F.slice(p, 2, F.size(p) - 1)


def ignore_index(labels: Column | str, pad_id: int, ignore: int = IGNORE_INDEX) -> Column:
    """Pad labels -> -100."""
    return F.transform(_col(labels), lambda x: F.when(x == F.lit(pad_id), F.lit(ignore)).otherwise(x))


def strip_specials(ids: Column | str, special_ids: list[int]) -> Column:
    """Drop special ids."""
    return F.filter(_col(ids), lambda x: ~x.isin(special_ids))


def argmax(values: Column | str) -> Column:
    """0-based index of the largest value, first on ties."""
    v = _col(values)
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def clip_generated(ids: Column | str, end_id: int, max_len: int) -> Column:
    """Cut after the first end id, and at ``max_len`` ids."""
    ids = _col(ids)
    first_end = F.array_position(ids, F.lit(end_id)).cast("int")
    stop = F.coalesce(F.nullif(first_end, F.lit(0)), F.lit(max_len))
    return F.slice(ids, 1, F.least(F.lit(max_len), stop))
