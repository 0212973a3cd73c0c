"""Array column helpers used by the formatting and batching operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def take(arr, n) -> Column:
    """First ``n`` elements (``n`` may be a column); ``n <= 0`` gives ``[]``."""
    a = _col(arr)
    n = _lit(n)
    return F.when(n <= 0, F.slice(a, 1, 0)).otherwise(F.slice(a, F.lit(1), n))


def repeat(value, n) -> Column:
    """``[value] * n`` with ``n <= 0`` giving ``[]``."""
    return F.array_repeat(_lit(value), F.greatest(_lit(n).cast("int"), F.lit(0)))


def pad_right(arr, length, value) -> Column:
    """Pad to ``length`` with ``value``; arrays already that long are unchanged."""
    a = _col(arr)
    return F.concat(a, repeat(value, _lit(length) - F.size(a)))


def all_equal_to(arr, value) -> Column:
    """True when every element equals ``value``; true for ``[]`` (like Python's ``all``)."""
    return F.forall(_col(arr), lambda x: x == _lit(value))


def argmax(arr) -> Column:
    """0-based index of the largest element, first one on ties; NULL for ``[]``."""
    a = _col(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("bigint")


def not_equal_mask(arr, value) -> Column:
    return F.transform(_col(arr), lambda x: x != _lit(value))
