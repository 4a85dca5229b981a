"""Array-column helpers for token sequences (truncate, shift, pad, mask, pool, stop).

Every helper is a pure Spark SQL expression. Note two traps they avoid:
``slice(a, -L, L)`` is empty when ``size(a) < L``, and ``sequence(1, 0)`` counts down.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def left_truncate(a: str | Column, max_len: int | Column) -> Column:
    """Keep the last ``max_len`` elements (Python ``a[-max_len:]``)."""
    a = _c(a)
    L = max_len if isinstance(max_len, Column) else F.lit(max_len)
    return F.slice(a, F.greatest(F.lit(1), F.size(a) - L + 1), L)


def head(a: str | Column, n: int | Column) -> Column:
    """``a[:n]``."""
    return F.slice(_c(a), 1, n if isinstance(n, Column) else F.lit(n))


def drop_last(a: str | Column) -> Column:
    """``a[:-1]`` (empty stays empty)."""
    a = _c(a)
    return F.slice(a, 1, F.greatest(F.lit(0), F.size(a) - 1))


def drop_first(a: str | Column) -> Column:
    """``a[1:]``."""
    a = _c(a)
    return F.slice(a, 2, F.greatest(F.lit(0), F.size(a) - 1))


def repeat(value, n: Column) -> Column:
    v = value if isinstance(value, Column) else F.lit(value)
    return F.array_repeat(v, F.greatest(F.lit(0), n).cast("int"))


def pad_right(a: str | Column, width: int | Column, pad) -> Column:
    """Right-pad to ``width`` with ``pad`` (never truncates)."""
    a = _c(a)
    w = width if isinstance(width, Column) else F.lit(width)
    return F.concat(a, repeat(pad, w - F.size(a)))


def pad_left(a: str | Column, width: int | Column, pad) -> Column:
    """Left-pad to ``width`` with ``pad`` (never truncates)."""
    a = _c(a)
    w = width if isinstance(width, Column) else F.lit(width)
    return F.concat(repeat(pad, w - F.size(a)), a)


def attention_mask(a: str | Column, width: int | Column) -> Column:
    """1 for each real element, 0 for each pad up to ``width``."""
    a = _c(a)
    w = width if isinstance(width, Column) else F.lit(width)
    return F.concat(repeat(1, F.size(a)), repeat(0, w - F.size(a)))


def mask_prefix(a: str | Column, n_masked: Column | int, ignore) -> Column:
    """Replace the first ``n_masked`` elements with ``ignore``."""
    a = _c(a)
    n = n_masked if isinstance(n_masked, Column) else F.lit(n_masked)
    ig = ignore if isinstance(ignore, Column) else F.lit(ignore)
    m = F.least(F.greatest(n, F.lit(0)), F.size(a)).cast("int")
    return F.concat(F.array_repeat(ig, m), F.slice(a, m + 1, F.size(a) - m))


def count_not(a: str | Column, ignore) -> Column:
    """Number of elements different from ``ignore``."""
    ig = ignore if isinstance(ignore, Column) else F.lit(ignore)
    return F.size(F.array_remove(_c(a), ig))


def mask_sum(mask: str | Column) -> Column:
    """Number of ones in a 0/1 mask."""
    return F.size(F.array_remove(_c(mask), 0))


def last_real_index(mask: str | Column) -> Column:
    """0-based index of the last real token of a right-padded row: ``sum(mask) - 1``."""
    return mask_sum(mask) - 1


def pool_last(values: str | Column, mask: str | Column) -> Column:
    """Value at the last real position (right padding only)."""
    return F.element_at(_c(values), last_real_index(mask) + 1)


def first_stop(a: str | Column, stops: Sequence) -> Column:
    """1-based position of the first element equal to any stop value, or 0."""
    a = _c(a)
    positions = [F.array_position(a, F.lit(s)) for s in stops]
    found = [F.when(p > 0, p) for p in positions]
    return F.coalesce(F.least(*found) if len(found) > 1 else found[0], F.lit(0))


def cut_at_stop(a: str | Column, stops: Sequence, keep_stop: bool = True) -> Column:
    """Truncate at the first stop element (kept or not); unchanged when none occurs."""
    a = _c(a)
    p = first_stop(a, stops)
    keep = p if keep_stop else p - 1
    return F.when(p == 0, a).otherwise(F.slice(a, 1, keep))


def dot(x: str | Column, w: str | Column) -> Column:
    """Inner product of two equal-length numeric arrays."""
    return F.aggregate(F.zip_with(_c(x), _c(w), lambda a, b: a * b), F.lit(0.0),
                       lambda acc, v: acc + v)


def join_tokens(a: str | Column, sep: str = " ") -> Column:
    """Array -> one string (oracle-friendly display of token arrays)."""
    return F.array_join(_c(a).cast("array<string>"), sep)
