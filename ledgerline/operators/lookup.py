"""Lookups and classifications by joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.keywords import first_keyword
from ledgerline.functions.text import strip


def first_per_key(rows: DataFrame, key: str | list[str], *order) -> DataFrame:
    """One row a key, the first in ``order``."""
    keys = [key] if isinstance(key, str) else key
    return rows.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_place = 1").drop("_place")


def in_request_order(request: DataFrame, table: DataFrame, key: str, ordinal: str, last_by: str) -> DataFrame:
    """The table's rows for the request's keys, in the request's order; unknown keys drop, of repeated rows the last counts."""
    return request.join(first_per_key(table, key, F.col(last_by).desc()), key).orderBy(ordinal)


def by_id_or_name(asked: DataFrame, term: str, table: DataFrame, id_col: str, name_col: str, line: str) -> DataFrame:
    """``asked`` with the id of the first table row, by ``line``, that has the term as its id or, whatever the case, its name.

    Two equi-joins and a union, for a condition with OR could only be met by comparing all pairs.
    """
    terms = asked.select(term).distinct()
    ids = terms.join(table, F.col(term) == F.col(id_col).cast("string")).select(term, F.col(id_col).alias("found"), line)
    names = terms.join(table, F.lower(term) == F.lower(name_col)).select(term, F.col(id_col).alias("found"), line)
    first = ids.unionByName(names).groupBy(term).agg(F.min_by("found", line).alias("found"))
    return asked.join(first, term, "left")


def by_id_then_name(asked: DataFrame, term: str, table: DataFrame, id_col: str, name_col: str, line: str) -> DataFrame:
    """As ``by_id_or_name``, but any id comes before any name, the last row of a key counts, and an unknown term stays itself."""
    ids = table.groupBy(F.lower(F.col(id_col).cast("string")).alias("_i")).agg(F.max_by(F.col(id_col).cast("string"), line).alias("_id"))
    names = table.groupBy(F.lower(name_col).alias("_n")).agg(F.max_by(F.col(id_col).cast("string"), line).alias("_name"))
    rows = asked.join(ids, F.lower(term) == F.col("_i"), "left").join(names, F.lower(term) == F.col("_n"), "left")
    return rows.withColumn("found", F.coalesce("_id", "_name", term)).drop("_i", "_n", "_id", "_name")


def transformed_join(left: DataFrame, left_key: Column, right: DataFrame, right_key: Column, order: str, columns: list[str], on_missing: str = "warn") -> DataFrame:
    """``left`` with ``columns`` of the right row whose transformed key equals its own; of several the first in ``order``.

    on_missing: warn keeps the row and marks it in ``_matched``, skip drops it, error fails the query.
    """
    table = first_per_key(right.select(right_key.alias("_key"), order, *columns).where("_key <> ''"), "_key", order).drop(order)
    found = left.withColumn("_own", left_key).join(table.withColumn("_matched", F.lit(True)), F.col("_own") == F.col("_key"), "inner" if on_missing == "skip" else "left")
    matched = F.coalesce("_matched", F.lit(False))
    if on_missing == "error":
        matched = F.when(matched, True).otherwise(F.raise_error(F.concat(F.lit("no row for key "), F.coalesce("_own", F.lit("null")))).cast("boolean"))
    return found.withColumn("_matched", matched).drop("_own", "_key")


def exact_then_prefix(rows: DataFrame, key: str, table: DataFrame, table_key: str, value: str) -> DataFrame:
    """``value`` of the row whose key is the same, else of the least key that goes on after ``key`` with - or /.

    The longer keys are cut at each of their separators, so the search for a beginning is an equi-join as well.
    """
    exact = table.groupBy(table_key).agg(F.min(value).alias("_exact")).withColumnRenamed(table_key, "_e")
    cut = F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.length(table_key), F.lit(1))), lambda k: F.substr(F.col(table_key), k, F.lit(1)).isin("-", "/")), lambda k: F.substr(F.col(table_key), F.lit(1), k - 1))
    begun = table.select(table_key, value, F.explode(cut).alias("_p")).groupBy("_p").agg(F.min_by(value, F.struct(table_key, value)).alias("_prefix"))
    found = rows.join(exact, F.col(key) == F.col("_e"), "left").join(begun, F.col(key) == F.col("_p"), "left")
    return found.withColumn("found", F.coalesce("_exact", "_prefix")).drop("_e", "_p", "_exact", "_prefix")


CASE_WORDS = 50


def first_match(text: Column, rules: list[tuple[str, str]], otherwise: str | None = None) -> Column:
    """The value of the first rule (pattern, value) whose pattern is in the text. The table of rules becomes one CASE."""
    found = None
    for pattern, value in rules:
        found = F.when(text.rlike(pattern), value) if found is None else found.when(text.rlike(pattern), value)
    return found.otherwise(otherwise)


def longest_keyword(text: Column, words: dict[str, str], preferred: dict[str, str] | None = None) -> Column:
    """The value of a preferred word in the text, else of the longest word in it; of words as long the first listed.

    A few words become one CASE, which asks for each; more become an automaton, which reads a text once. Both say the same.
    """
    low = F.lower(text)
    order = list((preferred or {}).items()) + sorted(words.items(), key=lambda w: -len(w[0]))
    if len(order) > CASE_WORDS:
        return first_keyword(text, order)
    return F.coalesce(*(F.when(F.contains(low, F.lit(w.lower())), v) for w, v in order), F.lit(None).cast("string"))


def code_then_keyword(rows: DataFrame, owner: str, code: str, text: Column, codes: DataFrame, words: dict[str, str]) -> DataFrame:
    """``rows`` with region and source: by the owner's own code (owner, code, region), else by a keyword in the text."""
    table = codes.select(F.col("owner").alias("_o"), F.lower("code").alias("_c"), F.col("region").alias("_r"))
    found = rows.join(table, (F.col(owner) == F.col("_o")) & (F.lower(strip(F.col(code))) == F.col("_c")), "left")
    word = longest_keyword(text, words)
    source = F.when(F.col("_r").isNotNull(), "code").when(word.isNotNull(), "keyword")
    return found.withColumns({"region": F.coalesce("_r", word), "source": source}).drop("_o", "_c", "_r")


def compared(recorded: DataFrame, actual: DataFrame, key: str, value: str, ignored: list[str]) -> DataFrame:
    """key, status of a full outer join: ok, mismatched, missing (recorded only) or extra (actual only, less ``ignored``)."""
    norm = lambda c: F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("/")), "^/+", "")
    a = recorded.select(norm(F.col(key)).alias(key), F.lower(value).alias("_a"))
    b = actual.select(norm(F.col(key)).alias(key), F.lower(value).alias("_b")).where(~F.col(key).isin(*ignored))
    status = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra").when(F.col("_a") == F.col("_b"), "ok").otherwise("mismatched")
    return a.join(b, key, "full_outer").select(key, status.alias("status"))
