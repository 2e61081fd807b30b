"""Database files as a source and a sink against rows held in Python."""

import os
import random
import sqlite3

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources import databases, tables

COLUMNS = "id long, name string, size int, share double, raw binary, good boolean"
NAMES = ["", "a", "A", "aa", "Ab", "é", "z", "\U0001f600", "￿", "it's", 'two "quotes"', None]


def made(seed, n):
    draw = random.Random(seed)
    return [
        (i, draw.choice(NAMES), draw.choice([None, -5, 0, 7, 2**31 - 1]), draw.choice([None, 0.5, -1e300]), draw.choice([None, b"", b"\x00\xff"]), draw.choice([None, True, False]))
        for i in range(n)
    ]


def same(rows):
    return sorted((tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in rows), key=repr)


@pytest.fixture
def stored(spark, tmp_path):
    rows = made(1, 500)
    databases.write_database(spark.createDataFrame(rows, COLUMNS).repartition(3), f"file://{tmp_path}/db", "t x")
    return rows, f"{tmp_path}/db"


@pytest.mark.parametrize("parts", [1, 2, 7, 1000])
def test_rows_come_back_whatever_the_ranges(spark, stored, parts):
    rows, path = stored
    found = databases.database_rows(spark, path, "t x", COLUMNS, parts)
    assert same(found.collect()) == same(rows)
    assert found.rdd.getNumPartitions() >= min(parts, 100)
    assert same(databases.database_rows(spark, path, "t x", "name string", parts).collect()) == same([r[1:2] for r in rows])


def test_filters_give_what_spark_gives(spark, stored):
    rows, path = stored
    found, plain = databases.database_rows(spark, path, "t x", COLUMNS, 2), spark.createDataFrame(rows, COLUMNS)
    for where in ("id > 40 and id <= 90", "size is null", "name like 'a%'", "name = 'it''s' or size < 0", "not good", "raw = X'00FF'"):
        assert same(found.where(where).collect()) == same(plain.where(where).collect()), where
    few, more = found.where("id < 10"), found.where("id >= 5")
    assert (few.count(), found.count(), more.count()) == (10, 500, 495)
    assert few.unionByName(more).count() == more.unionByName(few).count() == 505


def test_conditions_give_what_spark_gives(spark, stored):
    rows, path = stored
    plain = spark.createDataFrame(rows, COLUMNS)
    conditions = [("size", "=", 7), ("size", "known", None), ("size", "in", [0, -5]), ("name", "in", []), ("name", "in", ["a", "é", ""]), ("name", "prefix", "a"), ("name", "prefix", "")]
    conditions += [("name", sign, text) for sign in databases.COMPARED for text in ("", "A", "aa", "é", "￿", "it's")]
    for condition in conditions:
        found = databases.database_rows(spark, path, "t x", "id long, name string, size int", 1, [("id", ">=", 20), condition])
        expected = plain.where("id >= 20").where(databases._holds(*condition)).select("id", "name", "size")
        assert same(found.collect()) == same(expected.collect()), condition
    for odd in (("share", "=", 0.5), ("id", "=", "1"), ("id", "=", True), ("id", "prefix", 1), ("name", "like", "a"), ("id", "in", list(range(501)))):
        with pytest.raises(ValueError, match="condition"):
            databases.SqliteReader(path, "t x", plain.schema, 1, [odd])


def test_the_database_checks_conditions(stored):
    rows, path = stored
    schema = T.StructType().add("id", "long").add("name", "string")
    reader = databases.SqliteReader(path, "t x", schema, 2, [("id", ">", 3), ("name", "known", None), ("name", "in", ["a", "é"]), ("name", "prefix", "a")])
    part = databases.Range(path, None, 9)
    assert reader.statement(part) == ('SELECT "id", "name" FROM "t x" WHERE "id" > ? AND "name" IS NOT NULL AND "name" COLLATE BINARY IN (?, ?) AND "name" COLLATE BINARY >= ? AND rowid < ?', [3, "a", "é", "a", 9])
    assert "COLLATE BINARY IN" in reader.statement(part, utf8=False)[0] and "BINARY >=" not in reader.statement(part, utf8=False)[0]
    got = [tuple(r.values()) for p in reader.partitions() for batch in reader.read(p) for r in batch.to_pylist()]
    assert sorted(got) == sorted(r[:2] for r in rows if r[0] > 3 and r[1] in ("a", "é"))


def test_tables_of_other_programs(spark, tmp_path):
    """Other encodings and collations, cells of another class, no rows, no schema; the ends of rowids."""
    path = f"{tmp_path}/other #1?.db"
    connection = sqlite3.connect(path)
    connection.execute("PRAGMA encoding = 'UTF-16le'")
    connection.execute("create table t (k integer primary key, name text collate nocase, odd, big decimal(9, 2))")
    for k, name in ((-(2**63), "B"), (0, "a"), (5, "\U0001f600"), (2**63 - 1, "～")):
        connection.execute("insert into t values (?, ?, ?, 1.5)", (k, name, "text" if k else 3))
    connection.execute("create table empty (a text)")
    connection.commit()
    connection.close()
    rows = databases.database_rows(spark, path, "t", "k long, name string, odd int", parts=3)
    assert same(rows.select("k", "odd").collect()) == same([(-(2**63), None), (0, 3), (5, None), (2**63 - 1, None)])

    def names(*where):
        return {r.name for r in databases.database_rows(spark, path, "t", "k long, name string, odd int", 3, list(where)).collect()}

    assert names(("name", "<", "a")) == {"B"} and names(("name", ">", "～")) == {"\U0001f600"} and names(("name", "=", "A")) == set()
    assert names(("odd", ">", 1)) == {"a"} and names(("odd", "known", None)) == {"a"} and names(("k", ">", 5)) == {"～"}
    whole = databases.database_rows(spark, path, "t")
    assert dict(whole.dtypes) == {"k": "bigint", "name": "string", "odd": "binary", "big": "double"} and whole.agg(F.sum("big")).first()[0] == 6.0
    assert databases.database_rows(spark, path, "empty", parts=4).collect() == []


def test_files_are_replaced_and_failed_runs_leave_none(spark, stored):
    rows, path = stored
    more = spark.createDataFrame(made(2, 50), COLUMNS)
    databases.write_database(more, path, "t x")
    assert databases.database_rows(spark, path, "t x", COLUMNS).count() == 550
    before = sorted(os.listdir(path))
    with pytest.raises(Exception, match="boom"):
        databases.write_database(more.withColumn("id", F.when(F.col("id") == 49, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id"))), path, "t x", "overwrite")
    assert sorted(x for x in os.listdir(path) if x[0] != "_") == before
    databases.write_database(more.limit(0), path, "t x", "overwrite")
    assert databases.database_rows(spark, path, "t x", COLUMNS).collect() == []
    with pytest.raises(Exception, match="cast them"):
        databases.write_database(more.select(F.current_date().alias("d")), path, "t x")
    with pytest.raises(Exception, match="mounted folder"):
        databases.database_rows(spark, "hdfs://x/y", "t", "a int").collect()


def test_jdbc_in_parts(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/derby;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    spark.range(100).withColumn("name", F.concat(F.lit("n"), "id")).write.jdbc(url, "things", properties=driver)
    rows = tables.database_table(spark, url, "things", driver, "id", (0, 99), 4).where("id >= 90")
    assert rows.rdd.getNumPartitions() == 4 and {r.id for r in rows.collect()} == set(range(90, 100))
    assert tables.database_table(spark, url, "things", driver).count() == 100
