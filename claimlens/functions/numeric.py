"""Rounding, safe ratios and labels for numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimlens.functions.text import _col


def round_even(c: Column | str, digits: int = 0) -> Column:
    """Scale, round half to even, scale back: the floating-point rule of array libraries.

    For doubles; a decimal loses digits beyond the fifteenth here, ``bround`` keeps them."""
    scale = 10.0**digits
    return F.rint(_col(c).cast("double") * scale) / scale


def r0(c: Column | str) -> Column:
    return round_even(c, 0)


def r2(c: Column | str) -> Column:
    return round_even(c, 2)


def r4(c: Column | str) -> Column:
    return round_even(c, 4)


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Double ratio, NULL where the divisor is zero."""
    return F.try_divide(_col(top).cast("double"), _col(bottom).cast("double"))


def flag(condition: Column) -> Column:
    """1 where true, 0 where false or unknown."""
    return F.when(condition, 1).otherwise(0)


def nan_to_null(c: Column | str) -> Column:
    return F.nanvl(_col(c), F.lit(None).cast("double"))


# Upper bounds of |r| with their marks, and the class names of the marks.
CORRELATION_MARKS = [
    (0.2, "(-----)", "veryweak"),
    (0.4, "(*----)", "weak"),
    (0.6, "(**---)", "moderate"),
    (0.8, "(***--)", "strong"),
    (1.0, "(****-)", "verystrong"),
]
FULL_MARK = "(*****)"


def _by_magnitude(r: Column, position: int) -> Column:
    size = F.abs(r)
    out = F.when(r.isNull(), None)
    for bound in CORRELATION_MARKS:
        out = out.when(size < bound[0], bound[position])
    return out


def magnitude_mark(r: Column | str) -> Column:
    """Star mark of |r|; exact one and above takes the full mark, NULL stays NULL."""
    return _by_magnitude(_col(r), 1).otherwise(FULL_MARK)


def magnitude_class(r: Column | str) -> Column:
    """Class name of |r|; exact one belongs to no class (NULL)."""
    return _by_magnitude(_col(r), 2)
