"""Comparing key tuples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def tuple_lt(key: Sequence[str], bound: Sequence) -> Column:
    """``(k1, k2, ..) < (b1, b2, ..)``, spelled out column by column.

    Written this way, unlike a struct comparison, it reaches the scan as a
    pushed filter.
    """
    pairs = [(F.col(k), _column(b)) for k, b in zip(key, bound, strict=True)]
    (last, bound_of_last), *others = reversed(pairs)
    return reduce(lambda less, kb: (kb[0] < kb[1]) | ((kb[0] == kb[1]) & less), others,
                  last < bound_of_last)


def tuple_ge(key: Sequence[str], bound: Sequence) -> Column:
    """``(k1, k2, ..) >= (b1, b2, ..)``."""
    pairs = [(F.col(k), _column(b)) for k, b in zip(key, bound, strict=True)]
    (last, bound_of_last), *others = reversed(pairs)
    return reduce(lambda more, kb: (kb[0] > kb[1]) | ((kb[0] == kb[1]) & more), others,
                  last >= bound_of_last)
