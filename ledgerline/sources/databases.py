"""Tables of SQLite database files as a data source: files on a shared mount are read and written by every executor.

    spark.dataSource.register(SqliteSource)
    spark.read.format("sqlite_files").schema("id long, name string").option("table", "parts").option("parts", 4).load("/shared/parts")

A path is one file or a folder of files that hold parts of the table. Only the columns of the schema are read. With ``parts`` a
file is read in that many ranges of rowids. Conditions (column, sign, value) are the database's work: =, <, <=, >, >=, in, prefix
and known (not null). Like the bounds of a walk they belong to a load, not to a later filter.
"""

from __future__ import annotations

import json
import operator
import os
import sqlite3
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

ROWS = 10_000  # rows fetched at a time
MOST_VALUES = 500  # of one condition
COMPARED = {"=": operator.eq, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
WIDTHS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
SQL_TYPES = {T.BooleanType: "INTEGER", T.FloatType: "REAL", T.DoubleType: "REAL", T.StringType: "TEXT", T.BinaryType: "BLOB"} | dict.fromkeys(WIDTHS, "INTEGER")


def name_of(column: str) -> str:
    return '"' + column.replace('"', '""') + '"'


def local(path: str) -> str:
    """The path of a mounted folder; SQLite opens nothing else."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        raise ValueError(f"{path}: database files must be on a mounted folder")
    return path


def connected(path: str) -> sqlite3.Connection:
    """A connection that reads only."""
    return sqlite3.connect(f"file:{quote(path)}?mode=ro", uri=True)


def database_files(path: str) -> list[str]:
    if not os.path.isdir(path):
        return [path]
    return sorted(f"{path.rstrip('/')}/{n}" for n in os.listdir(path) if n[0] not in "._" and os.path.isfile(f"{path}/{n}"))


def converter(kind: T.DataType):
    """What makes a value of ``kind`` of a stored one; null of a value of another class or out of range, so that one odd cell stops no scan."""
    if type(kind) in WIDTHS:
        top = 1 << (WIDTHS[type(kind)] - 1)
        return lambda v: v if isinstance(v, int) and -top <= v < top else None
    if isinstance(kind, T.BooleanType):
        return lambda v: bool(v) if isinstance(v, int) and v in (0, 1) else None
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return lambda v: float(v) if isinstance(v, (int, float)) else None
    wanted = bytes if isinstance(kind, T.BinaryType) else str
    return lambda v: v if isinstance(v, wanted) else None


@dataclass
class Range(InputPartition):
    """Rowids of one file, from ``low`` on and below ``high``; None is an open end."""

    path: str
    low: int | None = None
    high: int | None = None


class SqliteReader(DataSourceReader):
    def __init__(self, path: str, table: str, schema: T.StructType, parts: int = 1, conditions: Iterable[tuple] = ()):
        self.path, self.table, self.schema, self.parts = path, table, schema, parts
        self.where: list[tuple[str, list]] = []
        self.by_bytes: list[tuple[str, list]] = []  # as ``where``, if texts are stored as UTF-8: others sort otherwise
        for name, sign, value in conditions:
            column, ordered = self._column(name, sign, value)
            values = value if sign == "in" else [] if sign == "known" else [value]
            part = {"in": f"IN ({', '.join('?' * len(values))})", "known": "IS NOT NULL", "prefix": ">= ?"}.get(sign, f"{sign} ?")
            (self.by_bytes if ordered else self.where).append((f"{column} {part}", values))

    def _column(self, name: str, sign: str, value) -> tuple[str, bool]:
        """A column in SQL, and whether the order of its texts matters. SQLite is to pass at least the rows that Spark would."""
        kind = self.schema[name].dataType
        if sign == "known":
            return name_of(name), False
        if sign not in ("in", "prefix", *COMPARED):
            raise ValueError(f"{sign} is no sign of a condition")
        wanted = int if type(kind) in WIDTHS else str if isinstance(kind, T.StringType) and kind == T.StringType() else None
        values = value if sign == "in" else [value]
        if wanted is None or not all(type(v) is wanted for v in values) or len(values) > MOST_VALUES or (sign == "prefix" and wanted is int):
            raise ValueError(f"{name} {sign}: conditions compare integers or texts with their like, at most {MOST_VALUES} of them")
        text = wanted is str
        return name_of(name) + " COLLATE BINARY" * text, text and sign not in ("=", "in")

    def partitions(self) -> list[Range]:
        return [r for f in database_files(self.path) for r in self._ranges(f)]

    def _ranges(self, path: str) -> list[Range]:
        if self.parts < 2:
            return [Range(path)]
        connection = connected(path)
        try:
            low, high = connection.execute(f"SELECT (SELECT min(rowid) FROM {name_of(self.table)}), (SELECT max(rowid) FROM {name_of(self.table)})").fetchone()
        finally:
            connection.close()
        if low is None:
            return [Range(path)]
        parts = min(self.parts, high - low + 1)
        cuts = [low + (high - low + 1) * k // parts for k in range(1, parts)]
        return [Range(path, a, b) for a, b in zip([None, *cuts], [*cuts, None])]  # open ends take rows written since

    def statement(self, part: Range, utf8: bool = True) -> tuple[str, list]:
        """The query of one range, and its values."""
        ends = [(f"rowid {sign} ?", [v]) for sign, v in ((">=", part.low), ("<", part.high)) if v is not None]
        conditions = self.where + (self.by_bytes if utf8 else []) + ends
        columns = ", ".join(map(name_of, self.schema.names)) or "NULL"
        where = f" WHERE {' AND '.join(c for c, _ in conditions)}" if conditions else ""
        return f"SELECT {columns} FROM {name_of(self.table)}{where}", [v for _, vs in conditions for v in vs]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        converters = [converter(f.dataType) for f in self.schema]
        arrow = to_arrow_schema(self.schema)
        connection = connected(part.path)
        try:
            utf8 = connection.execute("PRAGMA encoding").fetchone()[0] == "UTF-8"
            cursor = connection.execute(*self.statement(part, utf8))
            while rows := cursor.fetchmany(ROWS):
                columns = [pa.array([of(v) for v in values], field.type) for of, values, field in zip(converters, zip(*rows), arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        finally:
            connection.close()


@dataclass
class Written(WriterCommitMessage):
    name: str


class SqliteWriter(DataSourceWriter):
    """A database file a partition. Tasks write into a folder that readers pass over; the files of those that count are moved
    when all are done, so lost tasks, second attempts and a failed run leave nothing to be read. NaN is stored as null, as SQLite has none."""

    def __init__(self, path: str, table: str, schema: T.StructType, overwrite: bool):
        self.path, self.table, self.schema, self.overwrite = path, table, schema, overwrite
        self.work = f"{path.rstrip('/')}/_{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> Written:
        os.makedirs(self.work, exist_ok=True)
        name = f"part-{uuid.uuid4().hex}.db"
        connection = sqlite3.connect(f"{self.work}/{name}", isolation_level=None)
        try:
            connection.execute("PRAGMA journal_mode = OFF")  # a file that is not finished is never read
            columns = ", ".join(f"{name_of(f.name)} {SQL_TYPES[type(f.dataType)]}" for f in self.schema)
            connection.execute(f"CREATE TABLE {name_of(self.table)} ({columns})")
            connection.execute("BEGIN")
            connection.executemany(f"INSERT INTO {name_of(self.table)} VALUES ({', '.join('?' * len(self.schema))})", (tuple(r) for r in rows))
            connection.execute("COMMIT")
        finally:
            connection.close()
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        old = database_files(self.path) if self.overwrite and os.path.isdir(self.path) else []
        os.makedirs(self.work, exist_ok=True)
        for m in messages:
            if m:
                os.rename(f"{self.work}/{m.name}", f"{self.path}/{m.name}")
        for path in old:
            os.remove(path)
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        for name in os.listdir(self.work) if os.path.isdir(self.work) else []:
            os.remove(f"{self.work}/{name}")
        if os.path.isdir(self.work):
            os.rmdir(self.work)


class SqliteSource(DataSource):
    """Options: path; table; parts, the ranges a file is read in, 1 if not given; conditions, a JSON list. Without a schema it is that of the first file."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_files"

    def schema(self) -> T.StructType:
        files = database_files(local(self.options["path"]))
        if not files:
            raise FileNotFoundError(self.options["path"])
        connection = connected(files[0])
        try:
            columns = connection.execute(f"PRAGMA table_info({name_of(self.options['table'])})").fetchall()
        finally:
            connection.close()
        return T.StructType([T.StructField(name, declared(kind)) for _, name, kind, *_ in columns])

    def reader(self, schema: T.StructType) -> SqliteReader:
        _writable(schema)
        return SqliteReader(local(self.options["path"]), self.options["table"], schema, int(self.options.get("parts", 1)), json.loads(self.options.get("conditions", "[]")))

    def writer(self, schema: T.StructType, overwrite: bool) -> SqliteWriter:
        _writable(schema)
        return SqliteWriter(local(self.options["path"]), self.options["table"], schema, overwrite)


def declared(kind: str) -> T.DataType:
    """The type that a declared one stands for, by SQLite's rules of affinity; numeric ones are read as doubles."""
    kind = kind.upper()
    if "INT" in kind:
        return T.LongType()
    if any(w in kind for w in ("CHAR", "CLOB", "TEXT")):
        return T.StringType()
    return T.BinaryType() if "BLOB" in kind or not kind else T.DoubleType()


def _writable(schema: T.StructType) -> None:
    other = [f"{f.name} {f.dataType.simpleString()}" for f in schema if type(f.dataType) not in SQL_TYPES]
    if other:
        raise ValueError(f"SQLite has no class for {', '.join(other)}; cast them")


def _holds(name: str, sign: str, value) -> Column:
    column = F.col("`" + name.replace("`", "``") + "`")
    if sign == "in":
        return column.isin(value)
    if sign == "prefix":
        return F.startswith(column, F.lit(value))
    return column.isNotNull() if sign == "known" else COMPARED[sign](column, F.lit(value))


def database_rows(spark: SparkSession, path: str, table: str, schema: str | None = None, parts: int = 1, where: list[tuple] | None = None) -> DataFrame:
    """The rows of ``table`` in the database files at ``path`` that meet all conditions of ``where``; columns those of ``schema``, all if not given.

    Conditions are checked by the database, so rows that fail do not reach Python, and by Spark, whose order of texts counts.
    """
    spark.dataSource.register(SqliteSource)
    source = spark.read.format("sqlite_files").option("table", table).option("parts", parts).option("conditions", json.dumps(where or []))
    rows = (source.schema(schema) if schema else source).load(path)
    for condition in where or []:
        rows = rows.where(_holds(*condition))
    return rows


def write_database(rows: DataFrame, path: str, table: str, mode: str = "append") -> None:
    """``rows`` as ``table`` in database files under ``path``, one a partition; ``overwrite`` removes older files once the new ones are there."""
    rows.sparkSession.dataSource.register(SqliteSource)
    rows.write.format("sqlite_files").option("table", table).mode(mode).save(path)
