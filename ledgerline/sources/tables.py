"""Registries in CSV and parquet, a database, and how a new table takes the place of an old one."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.text import strip


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share: under ``spark.checkpoint.dir``; in local mode the warehouse will do.

    It lies in a folder of this application, which is deleted when the application ends, however it does but for a killed driver,
    or before by ``discard``.
    """
    folder = _application_folder(spark)
    files, of = _files(spark, folder)
    files.mkdirs(of(folder))
    files.deleteOnExit(of(folder))
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def _application_folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{(base or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/scratch/{spark.sparkContext.applicationId}"


def discard(spark: SparkSession) -> None:
    """Delete all scratch tables of this application: for long ones, between jobs. What still reads them fails afterwards."""
    folder = _application_folder(spark)
    files, of = _files(spark, folder)
    files.delete(of(folder), True)


def materialised(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to a scratch folder: what reads them twice sees the same and computes them once."""
    path = scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def read_registry(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV registry with all columns as text, blanks as '' and a header that is just ``columns``; a missing file has no rows.

    Each file is read as UTF-8, with or without a byte order mark, or, if its bytes are no UTF-8, as Latin-1: bytes decide, so a sign
    that stands for a broken one is as good as any other. Cells may be quoted and span lines. A file is not split, so many
    files make many tasks.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)

    def read(encoding: str, paths: list[str]) -> DataFrame:
        return spark.read.schema(schema).csv(paths, header=True, multiLine=True, escape='"', encoding=encoding, enforceSchema=False).fillna("")

    odd = not_utf8(spark, path)
    if not odd:
        return read("UTF-8", [path])
    files, of = _files(spark, path)
    names = {s.getPath().getName(): s.getPath().toString() for s in files.listStatus(of(path)) if s.isFile() and s.getPath().getName()[0] not in "._"}
    others = [full for name, full in names.items() if name not in odd]
    rows = read("ISO-8859-1", [full for name, full in names.items() if name in odd])
    return rows.unionByName(read("UTF-8", others)) if others else rows


def not_utf8(spark: SparkSession, path: str) -> set[str]:
    """The names of the files at ``path`` whose bytes are no UTF-8, told line by line."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), "value")
    return {unquote(r[0].rpartition("/")[2]) for r in lines.where(~F.is_valid_utf8("value")).select("file").distinct().collect()}  # a name a file


def write_registry(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="", quoteAll=True)


def last_per_key(rows: DataFrame, key: str, line: str) -> DataFrame:
    """Of each key the last row by ``line``; rows with a blank key are left out."""
    known = rows.where(strip(F.coalesce(F.col(key).cast("string"), F.lit(""))) != "")
    return known.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.col(line).desc()))).where("_n = 1").drop("_n")


def _files(spark: SparkSession, path: str):
    """The file system of ``path``, and what makes a path of a text."""
    of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), of


def _exists(spark: SparkSession, path: str) -> bool:
    files, of = _files(spark, path)
    return files.exists(of(path))


def _claimed(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file ``path``, whole, unless there is one: of several writers one succeeds, and no reader sees half of it.

    On a mounted folder a hard link does it, elsewhere a rename that does not overwrite, which HDFS does at once; a store that has neither will not do.
    """
    files, of = _files(spark, path)
    target = of(path)
    whole = of(f"{target.getParent()}/.{uuid.uuid4().hex}")
    stream = files.create(whole, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if files.getScheme() == "file":
            os.link(whole.toUri().getPath(), target.toUri().getPath())
        else:
            jvm = spark.sparkContext._jvm
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(whole, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        files.delete(whole, False)
    return True


def _versions(spark: SparkSession, path: str) -> dict[int, str]:
    """The whole versions of the table at ``path``, by number, and the folder of each."""
    files, of = _files(spark, path)
    log = of(f"{path}/_log")
    names = [s.getPath().getName() for s in files.listStatus(log)] if files.exists(log) else []
    lines = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
    found = {}
    for name in names:
        if name.isdigit():
            stream = files.open(of(f"{path}/_log/{name}"))
            found[int(name)] = f"{path}/{lines.toString(stream, 'UTF-8')}"
            stream.close()
    return found


def _commit(spark: SparkSession, path: str, number: int, folder: str, keep: int) -> bool:
    """Whether ``folder`` became version ``number``; all but the latest ``keep`` versions are removed then."""
    files, of = _files(spark, path)
    files.mkdirs(of(f"{path}/_log"))
    if not _claimed(spark, f"{path}/_log/{number:08d}", folder):
        return False
    found = _versions(spark, path)
    for old in sorted(found)[:-keep]:
        files.delete(of(f"{path}/_log/{old:08d}"), False)
        files.delete(of(found[old]), True)
    return True


def _written(rows: DataFrame, path: str) -> str:
    folder = f"data-{uuid.uuid4().hex}"
    rows.write.parquet(f"{path}/{folder}")
    return folder


def publish(rows: DataFrame, path: str, keep: int = 2) -> int:
    """Write ``rows`` as the next version of the parquet table at ``path``; its number.

    A version counts from the moment its number is in the log, after all of it is written, so ``current`` gives the old
    table or the new one and never less, whenever a writer dies. ``rows`` may read from ``current``. The latest ``keep`` versions
    stay for those who read them still. Of writers at once each gets a number of its own and the last one's table is the
    current one; a writer whose rows depend on the current table uses ``update``.
    """
    spark, folder = rows.sparkSession, _written(rows, path)
    while True:
        number = max(_versions(spark, path), default=0) + 1
        if _commit(spark, path, number, folder, keep):
            return number


def update(spark: SparkSession, path: str, change: Callable[[DataFrame | None], DataFrame], keep: int = 2, tries: int = 20) -> int:
    """Replace the table at ``path`` by ``change`` of it (of None if there is none); the version's number.

    The new version counts only if it follows the one it was made from. If another writer came first, ``change`` is asked again,
    of what that one left, so nothing either of them did is lost.
    """
    for _ in range(tries):
        found = _versions(spark, path)
        base = max(found, default=0)
        folder = _written(change(spark.read.parquet(found[base]) if base else None), path)
        if _commit(spark, path, base + 1, folder, keep):
            return base + 1
        files, of = _files(spark, path)
        files.delete(of(f"{path}/{folder}"), True)
    raise RuntimeError(f"{path}: other writers came first {tries} times")


def current(spark: SparkSession, path: str) -> DataFrame:
    """The latest version of the table at ``path``."""
    found = _versions(spark, path)
    if not found:
        raise FileNotFoundError(path)
    return spark.read.parquet(found[max(found)])


def reserve(spark: SparkSession, path: str, wanted: DataFrame, taken: DataFrame) -> DataFrame:
    """Per prefix of ``wanted`` (prefix, n): prefix and start; the numbers start + 1 to start + n are this caller's, for good.

    The highest number given out by prefix is kept in the table at ``path`` before any is used. A run that fails afterwards leaves a
    gap; no number is given twice, to whatever runs at once. ``taken`` (prefix, n) are numbers in use, such as of a registry made before the table.
    """
    asked = materialised(wanted.groupBy("prefix").agg(F.sum("n").alias("n")), "asked")
    used = taken.groupBy(F.col("prefix").alias("_p")).agg(F.max("n").alias("_used"))
    start = F.greatest(F.coalesce("_used", F.lit(0)), F.coalesce("high", F.lit(0))).cast("long")

    def raised(held: DataFrame | None) -> DataFrame:
        held = held if held is not None else spark.createDataFrame([], "prefix string, high long, last long")
        rows = held.select("prefix", "high").join(asked, "prefix", "full").join(used, F.col("prefix") == F.col("_p"), "left")
        return rows.select("prefix", F.when(F.col("n").isNull(), F.col("high")).otherwise(start + F.col("n")).alias("high"), F.when(F.col("n").isNotNull(), start).alias("last"))

    number = update(spark, path, raised, keep=1000)
    given = spark.read.parquet(_versions(spark, path)[number])  # our own version, whatever came after
    return asked.join(given, "prefix").select("prefix", F.col("last").alias("start"))


class Watched:
    """A table kept in memory for as long as its files do not change: each use compares their names, sizes and times."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.stamp, self.rows = None, None

    def get(self) -> DataFrame:
        files, of = _files(self.spark, self.path)
        stamp = sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in files.listStatus(of(self.path)))
        if stamp != self.stamp:
            if self.rows is not None:
                self.rows.unpersist()
            self.stamp, self.rows = stamp, self.spark.read.parquet(self.path).persist()
        return self.rows


def database_table(spark: SparkSession, url: str, table: str, properties: dict[str, str], column: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 8) -> DataFrame:
    """A table of a database by JDBC; filters and limits are pushed into it. With ``column`` and ``bounds`` it is read in parts."""
    if column and bounds:
        return spark.read.jdbc(url, table, column, bounds[0], bounds[1], parts, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def required_codes(codes: DataFrame) -> DataFrame:
    """``codes`` if there are any; an empty set of valid codes would call everything invalid, so it is an error."""
    if codes.isEmpty():
        raise ValueError("no valid codes")
    return codes
