"""Windows of a stream against plain code, batch by batch; how long scratch tables live."""

import os
import random
import subprocess
import sys
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from ledgerline.sources import tables
from ledgerline.streaming import incremental

DAY = datetime(2024, 5, 1)
HOUR = timedelta(hours=1)


def closed_by_hand(batches, late):
    """A batch's events count unless their window had been closed before it; windows close after a batch, by the latest event so far."""
    open_, closed, mark = {}, [], None
    for batch in batches:
        for at, kind, value in batch:
            start = at and DAY + (at - DAY) // HOUR * HOUR
            if at and (mark is None or start + HOUR > mark):
                n, total = open_.get((start, kind), (0, 0))
                open_[start, kind] = n + 1, total + (value or 0)
        latest = max((at for at, _, _ in batch if at), default=None)
        mark = max(x for x in (mark, latest and latest - late, datetime.min) if x is not None)
        done = sorted((k for k in open_ if k[0] + HOUR <= mark), key=repr)
        closed += [(*k, *open_.pop(k)) for k in done]
    return closed, open_


def test_windows_close_once(spark, tmp_path):
    draw, now, batches = random.Random(3), DAY, []
    for _ in range(6):  # each may reach back further than the watermark lets it
        batch = [(now + timedelta(minutes=draw.randrange(-300, 90)), draw.choice(["a", "b", None]), draw.choice([1, 2, None])) for _ in range(40)]
        batches.append(batch + [(None, "a", 5)])
        now += HOUR
    late, schema = timedelta(hours=2), "at timestamp_ntz, kind string, value long"
    for k, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        for _ in range(1 + k % 2):  # a call without news adds nothing
            stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
            incremental.closed_windows(stream, f"{tmp_path}/out", f"{tmp_path}/state", "at", "1 hour", ["kind"], "2 hours", total=F.sum(F.coalesce("value", F.lit(0))))
    expected, open_ = closed_by_hand(batches, late)
    rows = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select("start", "kind", "n", "total").collect()]
    assert sorted(rows, key=repr) == sorted(expected, key=repr) and open_
    assert sum(n for _, _, n, _ in rows) + sum(n for n, _ in open_.values()) < sum(len(b) - 1 for b in batches)  # some came too late


def test_a_time_without_zone_has_the_same_windows_in_any(spark, tmp_path):
    rows = spark.createDataFrame([(DAY - timedelta(days=60) + k * timedelta(minutes=7),) for k in range(20_000)], "at timestamp_ntz")
    rows.write.parquet(f"{tmp_path}/in")
    plain = {tuple(r) for r in incremental.windowed(rows, "at", "6 hours", []).collect()}
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/St_Johns")  # half hours, and clocks that change in these weeks
        incremental.closed_windows(spark.readStream.schema("at timestamp_ntz").parquet(f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/state", "at", "6 hours", [], "0 seconds")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    closed = {tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert closed < plain and len(plain - closed) == 1


def test_discarded_scratch_tables_are_gone(spark):
    rows = tables.materialised(spark.range(5), "numbers")
    assert rows.count() == 5
    folder = Path(tables.scratch(spark, "x").removeprefix("file:")).parent
    assert os.listdir(folder)
    tables.discard(spark)
    assert not folder.exists()
    assert tables.materialised(spark.range(3), "numbers").count() == 3


PROGRAM = """
import sys
from pyspark.sql import SparkSession
from ledgerline.sources import tables
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
tables.materialised(spark.range(5), "numbers")
tables.publish(spark.range(5), sys.argv[1] + "/kept")
assert tables.materialised(spark.range(2), "numbers").count() == 2
if sys.argv[2] == "fails":
    raise SystemExit(3)
spark.stop()
"""


def test_scratch_tables_end_with_their_application(tmp_path):
    repo = Path(__file__).resolve().parent.parent
    for way in ("stops", "fails"):
        done = subprocess.run([sys.executable, "-c", PROGRAM, f"file://{tmp_path}/{way}", way], cwd=repo, env=os.environ | {"PYTHONPATH": str(repo)}, capture_output=True, timeout=240)
        assert done.returncode == (3 if way == "fails" else 0), done.stderr
        waited = tmp_path / way / "scratch"
        for _ in range(100):  # the JVM ends a little after its program
            if not os.listdir(waited):
                break
            subprocess.run(["sleep", "0.2"])
        assert os.listdir(waited) == [] and (tmp_path / way / "kept").exists()
