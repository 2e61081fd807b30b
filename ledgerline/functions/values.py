"""Booleans, numbers and units from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

TRUE_WORDS = ("true", "yes", "1", "y", "t")
FALSE_WORDS = ("false", "no", "0", "n", "f")


def to_tristate(c: Column) -> Column:
    """True, false, or null for any word that is neither."""
    word = F.lower(strip(c.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def to_number(c: Column) -> Column:
    """The number that the whole text is, else null: no NA, no suffixes that casts allow."""
    text = strip(c.cast("string"))
    return F.when(text.rlike("^[+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?$"), text.try_cast("double"))


def significant(x: Column, digits: int = 5) -> Column:
    power = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x * power) / power)


def format_bytes(n: Column) -> Column:
    """With one decimal, in the largest of B, KB ... PB that leaves it under 1024; halves to even."""
    found = None
    for k, unit in enumerate(("B", "KB", "MB", "GB", "TB")):
        text = F.format_string(f"%.1f {unit}", F.bround(n.cast("double") / F.lit(float(1024**k)), 1))
        found = F.when(F.abs(n) < 1024 ** (k + 1), text) if found is None else found.when(F.abs(n) < 1024 ** (k + 1), text)
    return found.otherwise(F.format_string("%.1f PB", F.bround(n.cast("double") / F.lit(float(1024**5)), 1)))


def megabytes(n: Column) -> Column:
    """Millions of bytes to one decimal, halves to even."""
    return F.bround(n.cast("double") / 1e6, 1)


def snap(x: Column, known: list[float], within: float = 0.25) -> Column:
    """The first of ``known`` that is nearer than ``within``, else null."""
    return F.get(F.filter(F.array(*map(F.lit, known)), lambda k: F.abs(k - x) < within), 0)


#: The names of the verdicts on a field of view; the last four by whether it is square as given (1) and swapped (2).
SQUARE, NO_SPACING = "square_ambiguous", "no_pixelspacing"
BY_ORDER = ("neither", "matches_unswapped", "matches_swapped", "either")


def field_of_view(rows: Column, cols: Column, first: Column, second: Column, within: float = 0.05) -> Column:
    """Which order of two spacings makes the field square. Its sides are as rows to cols times, or swapped over, the spacings' proportion."""
    shape, grid = rows / cols, F.try_divide(first, second)
    square = lambda sides: F.coalesce(F.least(sides, F.try_divide(F.lit(1.0), sides)) > 1 - within, F.lit(False)).cast("int")
    order = square(shape * grid) + 2 * square(F.try_divide(shape, grid))
    return F.when(shape == 1, SQUARE).when(grid.isNull(), NO_SPACING).otherwise(F.element_at(F.array(*map(F.lit, BY_ORDER)), order + 1))


def index_selection(c: Column) -> Column:
    """'[1, 3]', '1,3', '3' or 'all' as sorted, distinct numbers packed by commas; 'all' and null stay."""
    text = F.lower(strip(c))
    numbers = F.filter(F.transform(F.split(F.regexp_replace(text, "[\\[\\]\\s]", ""), ","), lambda x: x.try_cast("int")), lambda x: x.isNotNull())
    return F.when(text == "all", "all").when(~text.isin("", "none"), F.array_join(F.array_sort(F.array_distinct(numbers)), ","))


def array_text(values: Column, sep: str = "x") -> Column:
    return F.array_join(values, sep)
