"""Searching a registry: a blob of all searchable text, list-valued keys, filters, pages."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.lists import any_contains, split_packed

PAGE_LIMIT = 200


def search_blob(*columns: str) -> Column:
    """All columns as one lower-case text; nulls as empty, so that positions stay apart by one space."""
    return F.lower(F.concat_ws(" ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)))


def multi_lookup(rows: DataFrame, key: str, cell: str, dimension: DataFrame, dimension_key: str, joined: list[str], first: list[str]) -> DataFrame:
    """``rows`` with the dimension's columns for every key packed in ``cell``.

    ``joined`` columns are packed in the order of the keys over those that are found; ``first`` columns are of the first
    one found. Rows without keys or hits stay, with empty text and nulls. Only keys and the columns asked for are shuffled.
    """
    keys = rows.select(key, F.posexplode(split_packed(F.col(cell))).alias("_pos", "_key"))
    dim = dimension.select(F.col(dimension_key).cast("string").alias("_key"), *dict.fromkeys(joined + first))
    hits = keys.join(dim, "_key").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_pos", *dict.fromkeys(joined + first)))).alias("_hits"))
    out = rows.join(hits, key, "left")
    columns = {f"{c}s": F.coalesce(F.array_join(F.col("_hits")[c].cast("array<string>"), ";"), F.lit("")) for c in joined}
    columns |= {f"first_{c}": F.get("_hits", 0)[c] for c in first}
    return out.withColumns(columns).drop("_hits")


def in_range(day: Column, since: str | None, until: str | None, blank_passes: bool = True) -> Column:
    """Days as ISO text, ends included."""
    known = F.coalesce(day, F.lit(""))
    inside = F.lit(True)
    if since:
        inside = inside & (known >= since)
    if until:
        inside = inside & (known <= until)
    return (known == "") | inside if blank_passes else (known != "") & inside


@dataclass(frozen=True)
class Filters:
    """What a search asks for; what is None or empty passes all."""

    text: str = ""
    equal: tuple[tuple[str, str], ...] = ()
    contain: tuple[tuple[str, str], ...] = ()
    either: tuple[tuple[tuple[str, ...], str], ...] = ()
    lists: tuple[tuple[tuple[str, ...], str], ...] = ()
    since: str | None = None
    until: str | None = None
    blank_passes: bool = True


def matches(filters: Filters, blob: Column, day: Column) -> Column:
    """All of ``filters``: text in the blob, equal and containing columns whatever the case, one of several columns, any
    item of packed lists, days."""
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    found = F.contains(blob, F.lit(filters.text.lower())) if filters.text else F.lit(True)
    for column, value in filters.equal:
        found &= low(column) == value.lower()
    for column, part in filters.contain:
        found &= F.contains(low(column), F.lit(part.lower()))
    for columns, part in filters.either:
        some = F.lit(False)
        for column in columns:
            some |= F.contains(low(column), F.lit(part.lower()))
        found &= some
    for columns, part in filters.lists:
        found &= any_contains(F.concat(*(split_packed(F.col(c)) for c in columns)), part)
    if filters.since or filters.until:
        found &= in_range(day, filters.since, filters.until, filters.blank_passes)
    return found


def split(filters: Filters, known: tuple[str, ...]) -> tuple[Filters, Filters]:
    """``filters`` in two that ask the same together: what the ``known`` columns and the day tell, and the rest."""
    own = lambda columns: set(columns) <= set(known)
    halves = []
    for early in (True, False):
        halves.append(
            replace(
                filters,
                text="" if early else filters.text,
                equal=tuple(f for f in filters.equal if own([f[0]]) == early),
                contain=tuple(f for f in filters.contain if own([f[0]]) == early),
                either=tuple(f for f in filters.either if own(f[0]) == early),
                lists=tuple(f for f in filters.lists if own(f[0]) == early),
                since=filters.since if early else None,
                until=filters.until if early else None,
            )
        )
    return halves[0], halves[1]


def page(rows: DataFrame, day: str, tie: str, limit: int = PAGE_LIMIT, offset: int = 0) -> DataFrame:
    """Newest first, blank days last, ties by ``tie``; at most PAGE_LIMIT rows from ``offset``.

    A sort under a limit keeps only offset + limit rows a task, so a page never sorts the whole table.
    """
    return rows.orderBy(F.coalesce(day, F.lit("")).desc(), tie).offset(max(0, offset)).limit(min(max(1, limit), PAGE_LIMIT))


def counted(rows: DataFrame, excluded: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that are not excluded, and one row with how many are."""
    return rows.where(~excluded), rows.agg(F.count_if(excluded).alias("n_excluded"))
