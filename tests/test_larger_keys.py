"""Queries against their SQL where keys have more digits than at the given sizes."""

import duckdb
import pytest

from ledgerline.functions import paths
from ledgerline.plans import scalars
from ledgerline.plans.base import ORACLES, QUERIES
from test_queries import SF, rows_of


def agrees(spark, folder, name, **tables):
    """Whether the query equals its SQL over ``tables``, SQL of their own over those of sf0.001."""
    duck = duckdb.connect()
    for table, sql in tables.items():
        duck.sql(f"copy ({sql}) to '{folder}/{table}.parquet' (format parquet)")
        duck.sql(f"create view {table} as select * from '{folder}/{table}.parquet'")
    found = QUERIES[name](spark, str(folder))
    expected = duck.sql(ORACLES[name])
    got = rows_of(found.select(*expected.columns).collect())
    assert got and got == rows_of(expected.fetchall())


def more(table, times, **steps):
    """``table`` repeated, each time with its keys moved on."""
    moved = "".join(f"{key} + i * {step} as {key}, " for key, step in steps.items())
    return f"select {moved}* exclude (i, {', '.join(steps)}) from range({times}) g(i), '{SF}/{table}.parquet'"


def test_analyse_path_with_customers_of_six_digits_and_more(spark, tmp_path):
    agrees(spark, tmp_path, "analyse_path", orders=more("orders", 6, o_orderkey=1500, o_custkey=199_999))


def test_walkup_non_noise_with_pages_of_six_digits_and_more(spark, tmp_path):
    agrees(spark, tmp_path, "walkup_non_noise", pages=more("pages", 6, page_id=199_999))


def test_walkup_non_noise_with_pages_without_number_or_below_zero(spark, tmp_path):
    numbered = "case when page_id % 7 = 0 then null when page_id % 7 < 4 then -page_id else page_id end"
    agrees(spark, tmp_path, "walkup_non_noise", pages=f"select {numbered} as page_id, * exclude page_id from '{SF}/pages.parquet'")


@pytest.mark.parametrize(
    "dirs, subject, series, date",
    [
        (["0522_m1_24h", "240124", "Slices", "3"], "0522_m1_24h", None, "240124"),
        (["240124", "0522 series", "RAT 12", "raw"], "RAT 12", "0522 series", "240124"),
        (["Phantom NEMA", "240124"], "Phantom NEMA", None, "240124"),
        (["1015_x", "240124", "4 hours"], "240124", "1015_x", None),
        (["m1", "1240124"], "1240124", "m1", None),
    ],
)
def test_six_digits_are_a_date_beside_a_folder_that_names_what_was_scanned(spark, dirs, subject, series, date):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(dirs,)], "dirs array<string>")
    found = rows.select(paths.walk_up(F.col("dirs"), scalars.BETWEEN, scalars.TIMES, scalars.INDEXED, scalars.NAMED).alias("s")).first().s
    assert (found.subject, found.series, found.date) == (subject, series, date)


#: Suppliers, and lines of theirs, about S5000 and S50000.
ABOUT_5000 = {
    "supplier": f"select s_suppkey + 4995 + i * 45000 as s_suppkey, * exclude (i, s_suppkey) from range(2) g(i), '{SF}/supplier.parquet'",
    "lineitem": f"select l_suppkey + 4995 + l_orderkey % 2 * 45000 as l_suppkey, * exclude (l_suppkey) from '{SF}/lineitem.parquet'",
    "orders": f"select * from '{SF}/orders.parquet'",
}


def test_v_fk_where_there_are_suppliers_about_the_withdrawn_one(spark, tmp_path):
    agrees(spark, tmp_path, "v_fk", **ABOUT_5000)


def test_v_report_where_there_are_suppliers_about_the_withdrawn_one(spark, tmp_path):
    agrees(spark, tmp_path, "v_report", **ABOUT_5000)


def test_export_has_a_folder_for_each_project_and_one_to_move_for_each_task(spark, tmp_path, monkeypatch):
    from pathlib import Path

    from ledgerline.sources import tables

    monkeypatch.setattr(tables, "scratch", lambda spark, name: str(tmp_path / name))
    rows = QUERIES["export_by_project"](spark, SF).collect()
    folders = list((tmp_path / "export").glob("part=*/project=*"))
    assert len(folders) == len({r.project for r in rows}) == len(rows) > 1
    tasks = {folder.name: {Path(f).name.split("-")[1] for f in folder.glob("*/part-*")} for folder in (tmp_path / "export").glob("part=*")}
    assert len(tasks) > 1 and all(len(of) == 1 for of in tasks.values())


def test_a_batch_of_events_costs_a_read_and_a_write_of_the_state(monkeypatch):
    import pandas as pd

    from ledgerline.streaming.queues import Advancing

    calls, kept = [], {}

    class State:
        def exists(self):
            calls.append("exists")
            return "s" in kept

        def get(self):
            calls.append("get")
            return kept.get("s")

        def update(self, value):
            calls.append("update")
            kept["s"] = value

    class Handle:
        def registerTimer(self, at):
            calls.append("timer")
            kept["t"] = at

        def deleteTimer(self, at):
            assert kept.pop("t") == at

    item = Advancing([("a", "x", "b"), ("b", "y", "a")], "a", "b", "late", 1000)
    item.handle, item.status = Handle(), State()
    times = pd.date_range("2024-01-01", periods=9, freq="s")
    events = pd.DataFrame({"at": times, "event": ["x", "y"] * 4 + ["x"]}).sample(frac=1, random_state=1)
    (found,) = item.handleInputRows(("k",), iter([events[:4], events[4:]]), None)
    due = int(times[-1].timestamp() * 1000) + 1000
    assert found["step"].tolist() == list(range(1, 10)) and found["status"].tolist() == ["b", "a"] * 4 + ["b"]
    assert kept == {"s": ("b", 9, due), "t": due} and calls == ["get", "timer", "update"]
    assert list(item.handleInputRows(("k",), iter([events[events["event"] == "x"]]), None)) == [] and calls[3:] == ["get"]
    list(item.handleInputRows(("k",), iter([pd.DataFrame({"at": [times[-1]], "event": ["y"]})]), None))
    assert kept == {"s": ("a", 10, 0)}
