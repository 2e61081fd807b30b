"""Places and running values within groups of any size: rows are dealt out by ranges, so no task orders a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common


def _dealt(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows``, written once, with the range they lie in (_part) and numbers that grow along it (_at)."""
    ranged = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    return common.materialised(ranged.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))


def _beside(dealt: DataFrame, pieces: DataFrame, group: list[str]) -> DataFrame:
    return dealt.join(pieces, [*group, "_part"])


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str = "index", total: str = "total") -> DataFrame:
    """``rows`` with their place in the group, from 0, and the group's number of rows. Columns of ``group`` hold no nulls; nulls in
    ``order`` come first; rows alike in all of them take their places in any order."""
    dealt = _dealt(rows, group, order)
    pieces = dealt.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    along = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(along), F.lit(0)) - F.col("_first")
    pieces = pieces.select(*group, "_part", before.alias("_off"), F.sum("_n").over(Window.partitionBy(*group)).alias(total))
    return _beside(dealt, pieces, group).select(*rows.columns, (F.col("_off") + F.col("_at")).alias(name), total)


def running(rows: DataFrame, group: list[str], order: list[str], sums: dict[str, Column] | None = None, xors: dict[str, Column] | None = None) -> DataFrame:
    """``rows`` with sums, or bitwise exclusive ors, over the rows of their group up to and including their own. ``group`` and ``order`` hold no
    nulls, and no two rows are alike in them."""
    kinds = {**{n: (F.sum, lambda a, b: a + b) for n in sums or {}}, **{n: (F.bit_xor, lambda a, b: a.bitwiseXOR(b)) for n in xors or {}}}
    dealt = _dealt(rows.withColumns({**(sums or {}), **(xors or {})}), group, order)
    pieces = dealt.groupBy(*group, "_part").agg(*(of(n).alias(f"_{n}") for n, (of, _) in kinds.items()))
    along = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumns({f"_{n}": F.coalesce(of(f"_{n}").over(along), F.lit(0)) for n, (of, _) in kinds.items()})
    inside = Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = _beside(dealt, pieces, group)
    return found.select(*rows.columns, *(both(F.col(f"_{n}"), of(n).over(inside)).alias(n) for n, (of, both) in kinds.items()))
