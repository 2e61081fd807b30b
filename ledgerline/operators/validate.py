"""Validation rules: each gives the violations of a registry as severity, key, line, rule, message."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.lists import split_packed
from ledgerline.functions.text import null_alias, strip

ID_PATTERN = "^ACQ-[0-9]{8}-[A-Z0-9]+-[0-9]{3}$"
RESIDUE = r"\$\{[^}]*\}|\{\{[^}]*\}\}|<[^<>\n]*>"


def header_errors(df: DataFrame, expected: list[str]) -> list[str]:
    """What keeps ``df`` from having just the expected columns in order; known from the schema, no rows are read."""
    if df.columns == expected:
        return []
    missing, extra = [c for c in expected if c not in df.columns], [c for c in df.columns if c not in expected]
    return [f"missing {c}" for c in missing] + [f"unexpected {c}" for c in extra] or ["columns out of order"]


def _found(rows: DataFrame, key: str, line: str, rule: str, message: Column, severity: str = "ERROR") -> DataFrame:
    return rows.select(F.lit(severity).alias("severity"), F.col(key).cast("string").alias("key"), F.col(line).cast("long").alias("line"), F.lit(rule).alias("rule"), message.alias("message"))


def duplicates(rows: DataFrame, key: str, line: str) -> DataFrame:
    """Keys that come again, each with the line it first stands on. First lines are counted before rows are shuffled."""
    several = rows.groupBy(F.col(key).alias("_k")).agg(F.min(line).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    found = rows.select(key, line).join(several, F.col(key).eqNullSafe(F.col("_k"))).where(F.col(line) > F.col("_first"))
    return _found(found, key, line, "duplicate", F.concat(F.lit("first on line "), F.col("_first").cast("string")))


def grammar(rows: DataFrame, key: str, line: str, pattern: str = ID_PATTERN) -> DataFrame:
    return _found(rows.where(~F.coalesce(F.col(key), F.lit("")).rlike(pattern)), key, line, "grammar", F.concat(F.lit("bad id "), F.coalesce(key, F.lit(""))))


def required(rows: DataFrame, key: str, line: str, columns: list[str]) -> DataFrame:
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns)))
    found = rows.select(key, line, cells.alias("c")).where(strip(F.coalesce("c.value", F.lit(""))) == "")
    return _found(found, key, line, "required", F.concat(F.lit("blank "), F.col("c.column")))


def residue(rows: DataFrame, key: str, line: str, columns: list[str]) -> DataFrame:
    """Template syntax that nobody filled in, in any column."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.regexp_extract(F.coalesce(F.col(c).cast("string"), F.lit("")), RESIDUE, 0).alias("value")) for c in columns)))
    found = rows.select(key, line, cells.alias("c")).where("c.value <> ''")
    return _found(found, key, line, "residue", F.concat_ws(" ", "c.column", "c.value"))


def vocabulary(rows: DataFrame, key: str, line: str, column: str, words: list[str]) -> DataFrame:
    return _found(rows.where((F.coalesce(column, F.lit("")) != "") & ~F.col(column).isin(*words)), key, line, "vocabulary", F.concat(F.lit(f"{column} "), F.col(column)))


def located(rows: DataFrame, key: str, line: str, path: str, prefix: str, listing: DataFrame, listed: str) -> DataFrame:
    """Paths that do not begin right, and those that do and are not listed."""
    right = F.startswith(path, F.lit(prefix))
    wrong = _found(rows.where(~right), key, line, "path", F.concat(F.lit("outside "), F.lit(prefix)))
    absent = rows.where(right).join(listing.select(F.col(listed).alias("_l")), F.col(path) == F.col("_l"), "left_anti")
    return wrong.unionByName(_found(absent, key, line, "path", F.lit("no folder")))


def references(rows: DataFrame, key: str, line: str, cell: str, pattern: str, table: DataFrame, table_key: str) -> DataFrame:
    """Well-formed ids of a packed cell that the table lacks."""
    ids = rows.select(key, line, F.explode(split_packed(F.col(cell))).alias("_id")).where(F.col("_id").rlike(pattern))
    dangling = ids.join(table.select(F.col(table_key).cast("string").alias("_t")), F.col("_id") == F.col("_t"), "left_anti")
    return _found(dangling, key, line, "reference", F.concat(F.lit("unknown "), F.col("_id")))


def null_aliases(rows: DataFrame, key: str, line: str, cell: str, stem: str) -> DataFrame:
    ids = rows.select(key, line, F.explode(split_packed(F.col(cell))).alias("_id")).withColumn("_a", null_alias(F.col("_id"), stem))
    return _found(ids.where("_a is not null"), key, line, "null alias", F.concat(F.lit("ambiguous "), F.col("_id")))


def enrichment(rows: DataFrame, key: str, line: str, kind: str, doc: Column) -> DataFrame:
    """Blocks and sentinels of a parsed document (VARIANT; null if it could not be parsed), as warnings. A key that is
    absent is no finding where a JSON null is one."""
    kind_of = lambda path: F.schema_of_variant(F.try_variant_get("_d", path, "variant"))
    absent = lambda path: F.try_variant_get("_d", path, "variant").isNull() | F.coalesce(F.is_variant_null(F.try_variant_get("_d", path, "variant")), F.lit(False))
    is_object = lambda path: F.startswith(kind_of(path), F.lit("OBJECT"))
    null_flag = lambda path: F.coalesce(F.is_variant_null(F.try_variant_get("_d", path, "variant")), F.lit(False))
    organism = F.col(kind) == "organism"
    object_doc = F.startswith(F.schema_of_variant("_d"), F.lit("OBJECT"))
    checks = [
        F.when(absent("$.subject"), "subject missing").when(~is_object("$.subject"), "subject is no object").when(F.try_variant_get("_d", "$.subject.source", "string") == "pending-db", "subject pending"),
        F.when(absent("$.condition"), "condition missing").when(~is_object("$.condition"), "condition is no object").when(null_flag("$.condition.is_control"), "is_control unknown"),
        F.when(organism & absent("$.anatomy"), "anatomy missing").when(organism & ~is_object("$.anatomy"), "anatomy is no object").when(organism & null_flag("$.anatomy.is_whole_body"), "is_whole_body unknown"),
    ]
    found = F.when(F.col("_d").isNull(), F.array(F.lit("not parsed"))).when(~object_doc, F.array(F.lit("no object"))).otherwise(F.array_compact(F.array(*checks)))
    rows = rows.withColumn("_d", doc).select(key, line, F.explode(found).alias("_m"))
    return _found(rows, key, line, "enrichment", F.col("_m"), "WARN")


def subjects(rows: DataFrame, key: str, line: str, alias: str, stem: str) -> DataFrame:
    """A null alias in the id; the alias column as a word for null, or empty on an id of ours."""
    ours = F.contains(F.lower(F.coalesce(key, F.lit(""))), F.lit(stem.lower()))
    value = strip(F.coalesce(alias, F.lit("")))
    second = F.when(F.lower(value).isin("none", "null"), F.concat(F.lit("alias is "), value)).when((value == "") & ours, "alias is empty")
    checks = F.array_compact(F.array(F.when(null_alias(F.col(key), stem).isNotNull(), "null alias in id"), second))
    return _found(rows.select(key, line, F.explode(checks).alias("_m")), key, line, "subject", F.col("_m"))


def report(*rules: DataFrame) -> DataFrame:
    """All violations as one table; rules that read one registry share its scan."""
    return reduce(DataFrame.unionByName, rules)
