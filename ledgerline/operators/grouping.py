"""Groupings whose result depends on which row came first, and other summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_item(rows: DataFrame, items: Column, name: str) -> DataFrame:
    """A row for each item of a list; an item twice in a list counts once if the list was made by ``split_packed``."""
    return rows.select("*", F.explode(items).alias(name))


def histogram(values: DataFrame, value: str, order: str) -> DataFrame:
    """value, n, first: how often and when first seen. Sort by n descending and first to list the most common first."""
    return values.groupBy(value).agg(F.count("*").alias("n"), F.min(order).alias("first"))


def mode_first(rows: DataFrame, key: str, value: str, order: str, most: int | None = None) -> DataFrame:
    """key, mode: each key's commonest value among its first ``most`` rows; of values as common the one seen first."""
    if most:
        rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where(F.col("_n") <= most)
    counted = rows.groupBy(key, value).agg(F.count("*").alias("_n"), F.min(order).alias("_first"))
    return counted.groupBy(key).agg(F.max_by(value, F.struct("_n", -F.col("_first"))).alias("mode"))


def collisions(rows: DataFrame, keys: list[Column], member: str, shown: str, order: str) -> DataFrame:
    """Groups of more than one row by ``keys``: members packed in order, and the first spelling of ``shown``.

    Rows are counted before members are gathered, so only those of groups that collide are.
    """
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    keyed = rows.select(*named, member, shown, order).where(F.expr(" and ".join(f"_k{i} <> ''" for i in range(len(keys)))))
    names = [f"_k{i}" for i in range(len(keys))]
    several = keyed.groupBy(*names).agg(F.count("*").alias("n"), F.min_by(shown, order).alias("shown")).where("n > 1")
    members = keyed.join(several, names).groupBy(*names, "n", "shown").agg(F.array_sort(F.collect_list(member)).alias("members"))
    return members.select("shown", "n", F.array_join(F.col("members").cast("array<string>"), ";").alias("members"))


def top_and_rest(rows: DataFrame, value: str, order: str, k: int = 5) -> DataFrame:
    """value, n of the ``k`` commonest, and a row '(rest)' for all others if there are any."""
    counted = histogram(rows, value, order)
    top = counted.orderBy(F.col("n").desc(), "first").limit(k)
    rest = counted.join(top.select(value), value, "left_anti").agg(F.sum("n").alias("n")).where("n is not null").select(F.lit("(rest)").alias(value), "n")
    return top.select(value, "n").unionByName(rest)


def next_number(rows: DataFrame, id_col: str, sep: str = "-") -> DataFrame:
    """prefix, next: one more than the greatest number after the last ``sep``; what is no number is left out."""
    prefix = F.regexp_extract(id_col, f"^(.*)\\Q{sep}\\E[^{sep}]*$", 1)
    number = F.substring_index(id_col, sep, -1).try_cast("long")
    return rows.select(prefix.alias("prefix"), number.alias("n")).where("n is not null").groupBy("prefix").agg((F.max("n") + 1).alias("next"))


def carry_forward(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """``rows`` with ``value`` filled by the last one before that is not null."""
    window = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(value, F.last(value, ignorenulls=True).over(window))
