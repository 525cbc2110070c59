"""Text and code columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Provider id that is a label rather than a number, and the id layout.
NO_PROVIDER_ID = "Sin rut prestador"
ID_ZEROS = "0000000000"
ID_KEEP = 10
ID_WIDTH = 12


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def named(name: str) -> Column:
    """The column of exactly this name, whatever signs are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def quoted(names: Iterable[str]) -> list[Column]:
    return [named(n) for n in names]


def pad_id(c: Column | str) -> Column:
    """Ten zeros in front of the first ten characters, then the last twelve.

    Not the same as ``lpad(c, 12)``: a one-character id comes out eleven long.
    """
    kept = F.left(_col(c).cast("string"), F.lit(ID_KEEP))
    return F.right(F.concat(F.lit(ID_ZEROS), kept), F.lit(ID_WIDTH))


def pad_provider_id(c: Column | str, label: str = NO_PROVIDER_ID) -> Column:
    """``pad_id`` for every id except the label, which is kept as it is."""
    return F.when(_col(c) == label, _col(c)).otherwise(pad_id(c))


def zero_fill(c: Column | str, width: int | Column) -> Column:
    """Left-fill with zeros up to ``width``; longer text is never cut."""
    text = _col(c).cast("string")
    size = F.lit(width) if isinstance(width, int) else width
    return F.concat(F.repeat(F.lit("0"), F.greatest(size - F.length(text), F.lit(0))), text)


def truncate(c: Column | str, length: int) -> Column:
    return F.substring(_col(c).cast("string"), 1, length)


def code_to_int(c: Column | str) -> Column:
    """Benefit code as an integer: blank counts as 0, a non-numeric code is NULL."""
    text = F.trim(_col(c))
    return F.when(text == "", F.lit(0)).otherwise(text.try_cast("int"))


def spec_fields(line: Column | str) -> Column:
    """``a;b;c`` as an array of trimmed parts."""
    return F.transform(F.split(F.trim(_col(line)), ";"), lambda part: F.trim(part))
