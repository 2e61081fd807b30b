"""Sources, published tables, streams and places: what the queries do not show."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import text, values
from ledgerline.operators import search, sequence, validate
from ledgerline.sources import documents, tables
from ledgerline.streaming import incremental


def test_a_failed_writer_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        tables.current(spark, path)
    assert tables.publish(spark.range(5), path) == 1
    failing = spark.range(100).withColumn("id", F.when(F.col("id") == 77, F.raise_error(F.lit("dies here")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="dies here"):
        tables.publish(failing, path)
    assert tables.current(spark, path).count() == 5
    spark.range(9).write.parquet(f"{path}/data-dead")  # a writer that was killed before its version was in the log
    assert tables.current(spark, path).count() == 5
    assert tables.publish(tables.current(spark, path).union(spark.range(2)), path) == 2
    assert tables.current(spark, path).count() == 7
    for _ in range(3):
        tables.publish(tables.current(spark, path), path)
    whole = [p.name for p in (tmp_path / "table").iterdir() if (p / "_SUCCESS").exists() and p.name != "data-dead"]
    assert len(whole) == 2 and tables.current(spark, path).count() == 7


def test_missing_registry_has_no_rows(spark, tmp_path):
    rows = tables.read_registry(spark, str(tmp_path / "none.csv"), ["a", "b"])
    assert rows.columns == ["a", "b"] and rows.count() == 0


def test_registry_with_another_header_is_refused(spark, tmp_path):
    (tmp_path / "r.csv").write_text("a,c\n1,2\n")
    with pytest.raises(Exception, match="header|column|schema"):
        tables.read_registry(spark, str(tmp_path / "r.csv"), ["a", "b"]).collect()


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Session:
        """As much of a session as is looked at."""

        def __init__(self, master):
            self.sparkContext = self.conf = self
            self.master, self.applicationId = master, "app-1"

        def get(self, name, *otherwise):
            return otherwise[0] if otherwise else "/warehouse"

    assert tables._application_folder(Session("local[2]")) == "/warehouse/scratch/app-1"
    with pytest.raises(ValueError):
        tables.scratch(Session("spark://host:7077"), "x")


def test_places_are_those_of_a_sort(spark):
    rnd = random.Random(3)
    rows = [(k, rnd.choice([None, "a", "b", "c"]), rnd.random()) for k in range(3000)]
    df = spark.createDataFrame(rows, "k int, s string, x double").repartition(7)
    found = sequence.placed(df, F.col("s").desc_nulls_last(), F.col("x"), F.col("k"))
    order = sorted(rows, key=lambda r: (r[1] is None, -ord(r[1] or "a"), r[2], r[0]))
    assert {r.k: r.place for r in found.collect()} == {r[0]: n for n, r in enumerate(order, 1)}
    assert sequence.placed(df.where("false"), F.col("k")).count() == 0


def test_a_batch_reads_only_partitions_it_has_rows_of(spark, tmp_path, monkeypatch):
    schema = "id long, day string"
    known = spark.createDataFrame([(k, f"2024-01-0{1 + k % 9}") for k in range(90)], schema)
    known.write.partitionBy("day").parquet(str(tmp_path / "registry"))
    spark.createDataFrame([(3, "2024-01-04"), (300, "2024-01-04"), (301, None)], schema).write.parquet(str(tmp_path / "in"))
    read = []

    def seen(incoming, registry, keys):
        read.extend(registry.inputFiles())
        read.append(registry._jdf.queryExecution().executedPlan().toString())
        return real(incoming, registry, keys)

    real = incremental.new_rows
    monkeypatch.setattr(incremental, "new_rows", seen)
    incremental.append_stream(spark, str(tmp_path / "in"), known.schema, str(tmp_path / "registry"), str(tmp_path / "cp"), ["id"], "day")
    assert any("PartitionFilters: [" in x and "2024-01-04" in x for x in read)
    rows = spark.read.schema(known.schema).parquet(str(tmp_path / "registry"))
    assert rows.count() == 92 and rows.where("id = 3").count() == 1


def test_halves_of_a_search_ask_what_the_whole_asks(spark):
    rows = spark.range(400).selectExpr("id", "concat('n', id % 7) as a", "concat('m', id % 5) as b", "if(id % 11 = 0, '', concat('2024-01-', lpad(id % 28 + 1, 2, '0'))) as day", "concat('x', id % 3, ';y', id % 4) as cell")
    whole = search.Filters(text="n3", equal=(("a", "N3"),), contain=(("b", "m"),), either=((("a", "b"), "3"),), lists=((("cell",), "y1"),), since="2024-01-05")
    blob = search.search_blob("a", "b", "cell")
    expected = sorted(r.id for r in rows.where(search.matches(whole, blob, F.col("day"))).collect())
    for known in (("a",), ("a", "b"), ("a", "b", "cell"), ()):
        early, late = search.split(whole, known)
        assert early.text == "" and late.since is None
        found = rows.where(search.matches(early, F.lit(""), F.col("day"))).where(search.matches(late, blob, F.col("day")))
        assert sorted(r.id for r in found.collect()) == expected and expected


def test_verdicts_and_aliases_by_hand(spark):
    cases = [(10, 10, 1, 2, "square_ambiguous"), (10, 20, None, 1, "no_pixelspacing"), (10, 20, 2, 1, "matches_unswapped"), (10, 20, 1, 2, "matches_swapped"), (100, 101, 1, 1, "either"), (10, 20, 1, 1, "neither"), (10, 20, 0, 0, "no_pixelspacing")]
    df = spark.createDataFrame([tuple(None if x is None else float(x) for x in c[:4]) + (c[4],) for c in cases], "r double, c double, a double, b double, v string")
    assert [r.f for r in df.select(values.field_of_view(*map(F.col, "rcab")).alias("f")).collect()] == [c[4] for c in cases]
    aliases = {"12-AB-5": None, "12-ab-NONE": "NONE", "12-AB-": "", "12-AB- null ": "null", "zz-AB-none": "none", "-AB-": "", "AB-none": None, "12-AB-3-AB-none": None, "z-AB- none": None, "": None, None: None}
    df = spark.createDataFrame([(k, v) for k, v in aliases.items()], "id string, v string")
    assert [r.f for r in df.select(text.null_alias(F.col("id"), "AB").alias("f")).collect()] == list(aliases.values())


def test_slugs_in_any_script(spark):
    df = spark.createDataFrame([("Ünï — çode",), ("ﬁne ½",), ("漢字",), (None,), ("Ž-ł",)], "s string")
    assert [r[0] for r in df.select(text.slug(F.col("s"))).collect()] == ["uni-code", "ne", "unnamed", "unnamed", "z"]
    assert [r[0] for r in df.select(text.slug(F.col("s"), any_script=True)).collect()] == ["uni-code", "fine-12", "unnamed", "unnamed", "z"]


def test_duplicates_with_blank_keys(spark):
    rows = spark.createDataFrame([("a", 2), ("a", 5), (None, 3), (None, 9), ("b", 4)], "key string, line int")
    assert sorted((r.key or "", r.line, r.message) for r in validate.duplicates(rows, "key", "line").collect()) == [("", 9, "first on line 3"), ("a", 5, "first on line 2")]


def test_summaries_of_no_files(spark):
    files = spark.createDataFrame([], "folder string, length long, name string")
    assert documents.summarized(files, "folder", {"dcm": F.col("name") == "x"}, {"dcm": {"m": F.max("name")}}).count() == 0


def test_numbers_of_a_prefix_that_has_nearly_all(spark):
    cases = spark.range(5000).selectExpr("if(id % 50 = 0, 'B-', 'A-') as prefix", "id as place").union(spark.createDataFrame([(None, 9)], "prefix string, place long")).repartition(6)
    taken = spark.createDataFrame([("A-", 7), ("A-", 3), ("C-", 99)], "prefix string, n long")
    found = sequence.assign_ids(cases, "prefix", "place", taken).collect()
    order = {p: sorted(r.place for r in found if r.prefix == p) for p in ("A-", "B-")}
    for r in found:
        assert r.id == (r.prefix and f"{r.prefix}{order[r.prefix].index(r.place) + (8 if r.prefix == 'A-' else 1):03d}")
    assert len(found) == 5001


def test_writers_at_once_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "counted")
    together, seen = threading.Barrier(2, timeout=60), []

    def add(name):
        def change(held):
            seen.append(name)
            if seen.count(name) == 1:
                together.wait()  # both have read the same version by now
            new = spark.createDataFrame([(name,)], "name string")
            return new if held is None else held.unionByName(new)

        numbers.append(tables.update(spark, path, change))

    numbers = []
    threads = [threading.Thread(target=add, args=(n,)) for n in ("a", "b")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(numbers) == [1, 2] and len(seen) == 3
    assert sorted(r.name for r in tables.current(spark, path).collect()) == ["a", "b"]


def test_published_versions_have_numbers_of_their_own(spark, tmp_path):
    path = str(tmp_path / "published")
    numbers = []
    threads = [threading.Thread(target=lambda k=k: numbers.append(tables.publish(spark.range(k), path, keep=9))) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(numbers) == [1, 2, 3, 4]
    assert sorted(spark.read.parquet(f).count() for f in tables._versions(spark, path).values()) == [0, 1, 2, 3]


def test_reserved_numbers_are_given_once(spark, tmp_path):
    path = str(tmp_path / "held")
    taken = spark.createDataFrame([("A", 7)], "prefix string, n long")
    ask = lambda **wanted: {r.prefix: r.start for r in tables.reserve(spark, path, spark.createDataFrame(list(wanted.items()), "prefix string, n long"), taken).collect()}
    assert ask(A=3, B=2) == {"A": 7, "B": 0}  # and the run that asked fails: 8 to 10 stay a gap
    assert ask(A=1) == {"A": 10}
    got = []
    threads = [threading.Thread(target=lambda: got.append(ask(A=5, C=1))) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(g["A"] for g in got) == [11, 16, 21] and sorted(g["C"] for g in got) == [0, 1, 2]
    assert ask(B=1) == {"B": 2}


def test_encodings_are_told_by_bytes(spark, tmp_path):
    (tmp_path / "reg").mkdir()
    (tmp_path / "reg" / "a.csv").write_text("k,v\n1,é �\n", encoding="utf-8")
    (tmp_path / "reg" / "b c.csv").write_bytes("k,v\n2,é\n".encode("latin-1"))
    (tmp_path / "reg" / "c.csv").write_bytes(b"\xef\xbb\xbfk,v\n3,\"x\ny\"\n")
    rows = tables.read_registry(spark, str(tmp_path / "reg"), ["k", "v"]).collect()
    assert sorted((r.k, r.v) for r in rows) == [("1", "é �"), ("2", "é"), ("3", "x\ny")]
