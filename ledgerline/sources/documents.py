"""Key-value headers, JSON and XML in text columns; files by their first bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.text import strip

from .headers import with_magic


def _last_wins(entries: Column) -> Column:
    """A map from an array of (key, value) in which a later entry replaces an earlier one of its key."""
    later = lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x["key"] == e["key"])
    return F.map_from_entries(F.filter(entries, later))


def labelled_records(text: Column) -> Column:
    """The map of a header of ##KEY= records: $$ comments go, sizes such as ( 3 ) before values go, <...> is a string.

    A record lasts to the next ##; its lines are joined by spaces. A leading $ of a key goes.
    """
    clean = F.regexp_replace(F.coalesce(text, F.lit("")), "(?m)\\$\\$.*$", "")
    records = F.filter(F.split(clean, "(?m)^##"), lambda r: F.contains(r, F.lit("=")))
    value = lambda r: strip(F.regexp_replace(F.regexp_replace(F.substr(r, F.instr(r, "=") + F.lit(1)), "\\s+", " "), "^\\s*\\(\\s*[0-9]+(?:\\s*,\\s*[0-9]+)*\\s*\\) ", ""))
    plain = lambda v: F.regexp_replace(v, "^<(.*)>$", "$1")
    entries = F.transform(records, lambda r: F.struct(F.regexp_replace(strip(F.substring_index(r, "=", 1)), "^[$]", "").alias("key"), plain(value(r)).alias("value")))
    return _last_wins(entries)


def colon_lines(text: Column) -> Column:
    """The map of lines such as key: value; the first colon cuts, lines without one are left out."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.contains(x, F.lit(":")))
    return _last_wins(F.transform(lines, lambda x: F.struct(strip(F.substring_index(x, ":", 1)).alias("key"), strip(F.substr(x, F.instr(x, ":") + F.lit(1))).alias("value"))))


def json_or_null(text: Column) -> Column:
    """A VARIANT; null where there is no document or it cannot be parsed, so the row stays."""
    return F.try_parse_json(text)


def documents_under(spark: SparkSession, listing: DataFrame, path: str, root: str, name: str = "metadata.json") -> DataFrame:
    """``listing`` with ``doc``, the parsed file ``name`` (a glob) of each folder in ``path``; null where there is none or it cannot be parsed."""
    files = spark.read.option("pathGlobFilter", name).option("recursiveFileLookup", "true").text(root, wholetext=True)
    folder = F.regexp_replace(F.regexp_replace(F.input_file_name(), "/[^/]*$", ""), "^file:/+", "/")
    docs = files.select(folder.alias("_folder"), json_or_null(F.col("value")).alias("doc"))
    return listing.join(docs, F.col(path) == F.col("_folder"), "left").drop("_folder")


def discovered(spark: SparkSession, root: str, name: str) -> DataFrame:
    """path and length of the files under ``root``, at any depth, whose name the glob fits. No file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", name).option("recursiveFileLookup", "true").load(root)
    return files.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length")


def has_magic(content: Column, magic: bytes, at: int = 128) -> Column:
    """The bytes from ``at`` on are ``magic``; false for null and short content."""
    return F.coalesce(F.substring(content, at + 1, len(magic)) == F.lit(magic), F.lit(False))


def files_with_magic(spark: SparkSession, root: str, magic: bytes, at: int = 128) -> DataFrame:
    """Files under ``root`` by their bytes: path, length, modificationTime. Only the bytes in question are read, so files may have any size."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return with_magic(files.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length", "modificationTime"), magic, at)


def allowed(rows: DataFrame, allow: list[str], deny: list[str]) -> DataFrame:
    """Only columns on the allow-list, and never one on the deny-list, whatever else comes with the data."""
    denied = {d.lower() for d in deny}
    return rows.select(*(c for c in allow if c in rows.columns and c.lower() not in denied))


def exposed(rows: DataFrame, fields: list[tuple[str, Column, str]]) -> DataFrame:
    """The fields that templates may refer to: (name, value, description), as text, '' where there is none."""
    return rows.select(*(F.coalesce(value.cast("string"), F.lit("")).alias(name) for name, value, _ in fields))


def summarized(files: DataFrame, folder: str, formats: dict[str, Column], measures: dict[str, dict[str, Column]]) -> DataFrame:
    """Per folder and format of ``files``: the file count, megabytes and the format's own measures, one pass for all formats.

    ``formats`` tells by a condition which files are of a format, the first that holds; ``measures`` has aggregates by format.
    Files of no format are left out; measures a format does not have are null.
    """
    kind = F.coalesce(*(F.when(condition, name) for name, condition in formats.items()))
    rows = files.withColumn("format", kind).where("format is not null")
    names = list(dict.fromkeys(m for of in measures.values() for m in of))
    value = lambda m: F.coalesce(*(F.when(F.first("format") == name, of[m]) for name, of in measures.items() if m in of))
    return rows.groupBy(folder, "format").agg(F.count("*").alias("file_count"), F.bround(F.sum("length") / 1e6, 1).alias("total_size_mb"), *(value(m).alias(m) for m in names))


def extracted(rows: DataFrame, shapes: list[tuple[str, Column, Column]]) -> DataFrame:
    """``rows`` with section and metadata, by what a source looks like: (section, condition, value), the first that holds; else null."""
    section = F.coalesce(*(F.when(condition, name) for name, condition, _ in shapes))
    metadata = F.coalesce(*(F.when(section == name, value) for name, _, value in shapes))
    return rows.select("*", section.alias("section"), metadata.alias("metadata"))
