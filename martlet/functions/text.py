"""Text and array helpers (section 2.7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_from_text(col, sep: str = "-", width: int = 15) -> Column:
    """``substr(s, locate(sep, s) + 1, width)``: the part after the first
    separator, or the whole text when there is none (locate gives 0)."""
    c = _c(col)
    return F.substring(c, F.locate(sep, c) + 1, F.lit(width))


def number_format(col, decimals: int = 2, sep: str = " ") -> Column:
    """Thousands separator and fixed decimals (``f'{x:,.2f}'.replace(',', sep)``)."""
    return F.replace(F.format_number(_c(col), decimals), F.lit(","), F.lit(sep))


def phone_text(col, prefix: str = "+") -> Column:
    """``'+' || phone``; a NULL part gives NULL like ``concat``."""
    return F.concat(F.lit(prefix), _c(col))


def full_name(first, last) -> Column:
    """``firstname || ' ' || lastname`` (NULL if either is NULL)."""
    return F.concat(_c(first), F.lit(" "), _c(last))


def mask_pii(col) -> Column:
    """Hash a personal field before it leaves the warehouse."""
    return F.md5(_c(col).cast("string"))


def sorted_text(values, sep: str = ", ") -> Column:
    """Distinct values of an array, sorted, as one text (a stable
    ``groupUniqArray`` rendering)."""
    return F.array_join(F.array_sort(F.array_distinct(_c(values))), sep)


def any_in(arr, values: Sequence) -> Column:
    """``hasAny(arr, [..])``."""
    return F.arrays_overlap(_c(arr), F.array(*[F.lit(v) for v in values]))


def has(arr, value) -> Column:
    """``has(arr, x)``."""
    return F.array_contains(_c(arr), value)


def share_equal(arr, value) -> Column:
    """Share of the elements equal to ``value`` (NULL for an empty list)."""
    a = _c(arr)
    hits = F.size(F.filter(a, lambda x: x == F.lit(value)))
    return F.try_divide(hits.cast("double"), F.size(a).cast("double"))
