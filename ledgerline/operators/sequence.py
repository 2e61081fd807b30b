"""Numbers and names given out in order, and canonical rows of groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.sources.tables import materialised


def assign_ids(cases: DataFrame, prefix: str, order: str, taken: DataFrame, reserved: DataFrame | None = None) -> DataFrame:
    """``cases`` with ``id``: their prefix and the next free numbers in ``order``, after those of ``taken`` (prefix, n) and,
    if given, of ``reserved`` (prefix, n). ``order`` leaves no ties in a prefix. A prefix with most of the cases is no burden: places
    are had over all of them, and a prefix's first place is taken off. Without a prefix there is no id."""
    rows = placed(cases, F.col(prefix), F.col(order), name="_place")
    starts = rows.groupBy(prefix).agg((F.min("_place") - 1).alias("_off"))
    starts = starts.join(taken.groupBy(prefix).agg(F.max("n").alias("_a")), prefix, "left")
    start = F.coalesce("_a", F.lit(0))
    if reserved is not None:
        starts = starts.join(reserved.groupBy(prefix).agg(F.max("n").alias("_b")), prefix, "left")
        start = F.greatest(start, F.coalesce("_b", F.lit(0)))
    starts = starts.select(prefix, (start - F.col("_off")).alias("_start"))
    number = F.col("_start") + F.col("_place")
    return rows.join(starts, prefix, "left").select(*cases.columns, F.concat(prefix, F.format_string("%03d", number)).alias("id"))


def least_deep(rows: DataFrame, keys: list[str], path: str) -> DataFrame:
    """Of each group the row of fewest levels, then of the least path."""
    depth = F.size(F.split(path, "/"))
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(depth, path))).where("_n = 1").drop("_n")


def with_summary(rows: DataFrame, key: Column, **summary: Column) -> DataFrame:
    """``rows`` with aggregates over all rows of their ``key``, nulls being one key. The aggregates are summed up before they are shuffled and
    joined, so Spark can split a key that most rows have, as it cannot under a window."""
    keyed = rows.withColumn("_key", key)
    found = keyed.groupBy("_key").agg(*(value.alias(name) for name, value in summary.items())).withColumnRenamed("_key", "_of")
    return keyed.join(found, F.col("_key").eqNullSafe(F.col("_of")), "left").drop("_key", "_of")


def claim_names(wanted: DataFrame, name: str, order: str, eligible: Column, taken: DataFrame, taken_name: str) -> DataFrame:
    """``wanted`` with ``claim``: raw-missing, collision or new. Only eligible rows claim; of several claims of one name, in
    any case, the least by ``order``, which leaves no ties, wins; names in ``taken`` are gone."""
    gone = taken.select(F.lower(taken_name).alias("_t")).distinct()
    rows = wanted.withColumns({"_e": eligible, "_l": F.lower(name)}).join(gone, F.col("_l") == F.col("_t"), "left")
    free = F.col("_e") & F.col("_t").isNull()
    rows = with_summary(rows, F.col("_l"), _first=F.min(F.when(free, F.col(order))))
    claim = F.when(~F.col("_e"), "raw-missing").when(F.col("_t").isNotNull(), "collision").when(F.col(order) == F.col("_first"), "new").otherwise("collision")
    return rows.withColumn("claim", claim).drop("_e", "_l", "_t", "_first")


def after_limit(rows: DataFrame, order: str, counts: Column, limit: int) -> DataFrame:
    """``rows`` with ``deferred``: true once ``limit`` rows that count came before.

    The place of the row that reaches the limit is found by a top-k of the rows that count, so nothing is sorted in one task.
    """
    last = rows.where(counts).select(F.col(order).alias("_o")).orderBy("_o").limit(limit).agg(F.count("*").alias("_n"), F.max("_o").alias("_last"))
    deferred = (F.col("_n") == limit) & (F.col(order) > F.col("_last"))
    return rows.crossJoin(F.broadcast(last)).withColumn("deferred", deferred).drop("_n", "_last")


def placed(rows: DataFrame, *order: Column, name: str = "place") -> DataFrame:
    """``rows`` with their place, from 1, in ``order``, which leaves no ties.

    Spark deals them out by ranges and sorts each; what that gives is written once, then counts of the ranges before are
    added. No task sorts all rows.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = materialised(ranged, "places").withColumns({"_part": F.expr("_at div 8589934592"), "_in": F.expr("_at % 8589934592")})
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return ranged.join(F.broadcast(before), "_part").select(*rows.columns, (F.col("_before") + F.col("_in") + 1).alias(name))  # a row a range
