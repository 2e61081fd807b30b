"""Merging updates into tables: ranked, fill-only, only-if-blank, queues and logs. Each gives the new table; publishing is
left to ``sources.tables.publish``, which replaces a folder as a whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.text import strip

from .sequence import placed


def blank(c: Column, *sentinels: str) -> Column:
    return F.lower(strip(F.coalesce(c.cast("string"), F.lit("")))).isin("", *sentinels)


def ranked_upsert(existing: DataFrame, incoming: DataFrame, key: str, order: str, fields: list[str], source: str, ranks: dict[str, int], sentinels: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """key, fields, source, action and n_changes after all ``incoming`` rows are applied in ``order``.

    A blank never overwrites; a blank is filled by anything; of two real values the one of the strictly higher rank stays.
    The source is the highest ranked. Rather than row by row this is one window a key: a row that outranks all before it
    is a record; a field ends as the last real value among records, else the first real value, else the first row's.
    """
    sentinels, rank = sentinels or {}, F.lit(0)
    for name, value in ranks.items():
        rank = F.when(strip(F.coalesce(source, F.lit(""))) == name, value).otherwise(rank)
    real = lambda f: F.when(~blank(F.col(f), *sentinels.get(f, ())), F.col(f))
    columns = [key, *fields, source]
    rows = existing.select(*columns, F.lit(None).cast(incoming.schema[order].dataType).alias("_o")).unionByName(incoming.select(*columns, F.col(order).alias("_o")))
    rows = rows.where(~blank(F.col(key))).withColumn("_r", rank)
    upto = Window.partitionBy(key).orderBy(F.col("_o").asc_nulls_first())
    earlier = upto.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"_n": F.row_number().over(upto), "_best": F.max("_r").over(earlier), "_known": F.max(F.col("_o").isNull()).over(Window.partitionBy(key))})
    rows = rows.withColumn("_record", (F.col("_n") > 1) & (F.col("_r") > F.col("_best")))
    fills = F.lit(False)
    for f in fields:
        fills |= real(f).isNotNull() & F.coalesce(F.max(real(f).isNotNull()).over(earlier), F.lit(False)).eqNullSafe(False)
    rows = rows.withColumn("_changes", (F.col("_n") > 1) & (F.col("_record") | fills))
    at = F.struct("_n")
    merged = [F.coalesce(F.max_by(real(f), F.when(F.col("_record") & real(f).isNotNull(), at)), F.min_by(real(f), F.when(real(f).isNotNull(), at)), F.min_by(f, at)).alias(f) for f in fields]
    where_from = F.coalesce(F.max_by(source, F.when(F.col("_record"), at)), F.min_by(source, at)).alias(source)
    out = rows.groupBy(key).agg(*merged, where_from, F.count_if("_changes").alias("n_changes"), F.max("_known").alias("_known"))
    action = F.when(~F.col("_known"), "inserted").when(F.col("n_changes") > 0, "updated").otherwise("unchanged")
    return out.withColumn("action", action).drop("_known")


def only_if_blank(table: DataFrame, updates: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``table`` with blanks of ``fields`` filled from ``updates``, and n_applied, n_skipped of each row."""
    new = updates.select(F.col(key).alias("_k"), *(F.col(f).alias(f"_{f}") for f in fields))
    rows = table.join(new, F.col(key) == F.col("_k"), "left")
    applied = sum((F.when(blank(F.col(f)) & ~blank(F.col(f"_{f}")), 1).otherwise(0) for f in fields), F.lit(0))
    skipped = sum((F.when(~blank(F.col(f)) & ~blank(F.col(f"_{f}")), 1).otherwise(0) for f in fields), F.lit(0))
    rows = rows.withColumns({"n_applied": applied, "n_skipped": skipped})
    rows = rows.withColumns({f: F.when(blank(F.col(f)) & ~blank(F.col(f"_{f}")), F.col(f"_{f}")).otherwise(F.col(f)) for f in fields})
    return rows.drop("_k", *(f"_{f}" for f in fields))


def whitelisted(table: DataFrame, updates: DataFrame, key: str, editable: list[str]) -> DataFrame:
    """``table`` with the columns of ``updates``, all of which must be editable, set where given; changed tells if any differs."""
    fields = [c for c in updates.columns if c != key]
    refused = sorted(set(fields) - set(editable))
    if refused:
        raise ValueError(f"columns that may not be edited: {', '.join(refused)}")
    new = updates.select(F.col(key).alias("_k"), *(F.col(f).alias(f"_{f}") for f in fields))
    rows = table.join(new, F.col(key) == F.col("_k"), "left")
    changed = F.lit(False)
    for f in fields:
        changed |= F.col(f"_{f}").isNotNull() & ~F.col(f"_{f}").eqNullSafe(F.col(f))
    rows = rows.withColumn("changed", changed).withColumns({f: F.coalesce(f"_{f}", f) for f in fields})
    return rows.drop("_k", *(f"_{f}" for f in fields))


def queue_upsert(queue: DataFrame, incoming: DataFrame, key: str | list[str], refreshed: list[str], status: Column, kept: list[str]) -> DataFrame:
    """``queue`` with ``refreshed`` columns taken from ``incoming``, ``kept`` ones preserved and new rows added.

    ``status`` is the column of the new state; it may speak of ``old`` (null for new rows) and ``new`` columns by these prefixes.
    """
    keys = [key] if isinstance(key, str) else key
    old = queue.select(*keys, *(F.col(c).alias(f"old_{c}") for c in [*refreshed, "status", *kept]), F.lit(True).alias("_old"))
    new = incoming.select(*keys, *(F.col(c).alias(f"new_{c}") for c in incoming.columns if c not in keys), F.lit(True).alias("_new"))
    rows = old.join(new, keys, "full_outer")
    return rows.select(*keys, *(F.when(F.col("_new"), F.col(f"new_{c}")).otherwise(F.col(f"old_{c}")).alias(c) for c in refreshed), status.alias("status"), *(F.col(f"old_{c}").alias(c) for c in kept))


def append_absent(log: DataFrame, incoming: DataFrame, unique: str, number: str, order: str, prefix: str) -> DataFrame:
    """The rows of ``incoming`` whose ``unique`` the log lacks, numbered on without gaps after the log's greatest number.

    Numbers go by ``order``, ties by ``unique``; of several rows of one ``unique`` the first counts.
    """
    fresh = incoming.groupBy(unique).agg(F.min(order).alias(order)).join(log.select(unique), unique, "left_anti")
    greatest = log.agg(F.coalesce(F.max(F.substring_index(number, "-", -1).try_cast("long")), F.lit(0)).alias("_base"))
    rows = placed(fresh, F.col(order), F.col(unique), name="_place").crossJoin(F.broadcast(greatest))  # one row
    return rows.select(unique, order, F.concat(F.lit(prefix), F.format_string("%04d", F.col("_base") + F.col("_place"))).alias(number))


def migrate(table: DataFrame, renamed: dict[str, str], target: list[str]) -> DataFrame:
    """``table`` in the columns of ``target``: renamed, ordered, new ones empty. A column that has no place is refused."""
    rows = table.withColumnsRenamed(renamed)
    unknown = sorted(set(rows.columns) - set(target))
    if unknown:
        raise ValueError(f"columns without a place: {', '.join(unknown)}")
    return rows.select(*(F.col(c) if c in rows.columns else F.lit("").alias(c) for c in target))


def guarded_replace(text: Column, old: Column, new: Column) -> Column:
    """``text`` with its one occurrence of ``old`` replaced; null where it has none or several."""
    n = (F.length(text) - F.length(F.replace(text, old, F.lit("")))) / F.length(old)
    return F.when(n == 1, F.replace(text, old, new))


def first_source_wins(parts: list[DataFrame], key: str, columns: list[str]) -> DataFrame:
    """Rows of several tables; of a key's rows those of the first table count."""
    rows = None
    for k, part in enumerate(parts):
        part = part.select(key, *columns, F.lit(k).alias("_p"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("_p", *columns))).where("_n = 1").drop("_n")
