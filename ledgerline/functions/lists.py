"""Lists packed into one text cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def split_packed(cell: Column, sep: str = ";") -> Column:
    """The items of a packed cell: trimmed, no blanks, each once, in order. Null gives an empty list."""
    items = F.split(F.coalesce(cell, F.lit("")), f"\\Q{sep}\\E")
    return F.array_distinct(F.filter(F.transform(items, strip), lambda x: x != ""))


def join_packed(items: Column, sep: str = ";") -> Column:
    return F.array_join(F.filter(items, lambda x: strip(x) != ""), sep)


def has_packed(cell: Column, item: Column | str, sep: str = ";") -> Column:
    """Whole items only: S1 is not in S12."""
    return F.array_contains(split_packed(cell, sep), item)


def write_once(cell: Column, item: Column | str) -> Column:
    """The cell, or ``item`` where the cell has none."""
    return F.when(F.size(split_packed(cell)) == 0, item).otherwise(cell)


def add_packed(cell: Column, item: Column | str) -> Column:
    return join_packed(F.array_union(split_packed(cell), F.array(item if isinstance(item, Column) else F.lit(item))))


def remove_packed(cell: Column, item: Column | str) -> Column:
    return join_packed(F.array_remove(split_packed(cell), item))


def any_contains(items: Column, part: Column | str) -> Column:
    """Some one item has ``part`` in it, whatever the case; never across two items."""
    part = F.lower(part if isinstance(part, Column) else F.lit(part))
    return F.exists(items, lambda x: F.contains(F.lower(x), part))
