"""How queries are registered, and tables and views that several share."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """``t.orders`` reads orders.parquet."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of Tables under its name."""

    def add(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(Tables(spark, sf_dir))

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def spread(rows: DataFrame) -> DataFrame:
    """``rows``, narrow ones, for work that is costly a row: dealt out evenly if their files make fewer tasks than there are cores."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


FEW = 2_000_000


def only_of(rows: DataFrame, key: str, some: DataFrame, some_key: str) -> DataFrame:
    """``rows`` whose key is among ``some``; these are counted, and sent to all tasks if they are no more than FEW numbers."""
    keys = some.select(F.col(some_key).alias("_some"))
    keys = F.broadcast(keys) if keys.count() <= FEW else keys
    return rows.join(keys, F.col(key) == F.col("_some"), "left_semi")


def packed_suppliers(t: Tables, of: DataFrame | None = None) -> DataFrame:
    """order_key, cell: the suppliers of an order's lines as one packed cell, repeats included, in line order; of some orders only, if given."""
    rows = t.lineitem if of is None else only_of(t.lineitem, "l_orderkey", of, "o_orderkey")
    lines = rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey"))).alias("lines"))
    names = F.transform("lines", lambda x: F.concat(F.lit("S"), x["l_suppkey"].cast("string")))
    return lines.select(F.col("l_orderkey").alias("order_key"), F.array_join(names, ";").alias("cell"))


PACKED_SQL = "packed as (select l_orderkey as order_key, string_agg('S' || l_suppkey, ';' order by l_linenumber, l_suppkey, l_partkey) as cell from lineitem group by l_orderkey)"


def acquisition_heads(t: Tables) -> DataFrame:
    """Orders in the form of a registry, without their lines: acq_id, day ('' for some), instrument, status, project_key, price. No shuffle."""
    blank = F.col("o_orderkey") % 11 == 0
    return t.orders.select(
        "o_orderkey",
        F.concat(F.lit("ACQ-"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("-"), F.regexp_replace(F.substring("o_orderpriority", 3, 3), "[^A-Z]", "X"), F.lit("-"), F.format_string("%03d", F.col("o_orderkey") % 1200)).alias("acq_id"),
        F.when(blank, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.col("o_orderpriority").alias("instrument"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").alias("project_key"),
        F.col("o_totalprice").alias("price"),
    )


def acquisitions(t: Tables, narrowed: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``acquisition_heads`` with the cell of each. ``narrowed`` picks rows by all but the cell; lines of others are not shuffled."""
    orders = acquisition_heads(t)
    orders = narrowed(orders) if narrowed else orders
    packed = packed_suppliers(t, orders if narrowed else None)
    return orders.join(packed, orders["o_orderkey"] == packed["order_key"], "left").drop("order_key").withColumn("cell", F.coalesce("cell", F.lit("")))


ACQ_SQL = (
    PACKED_SQL
    + """, acq as (
  select o_orderkey, 'ACQ-' || strftime(o_orderdate, '%Y%m%d') || '-' || regexp_replace(substr(o_orderpriority, 3, 3), '[^A-Z]', 'X', 'g') || '-'
      || printf('%03d', o_orderkey % 1200) as acq_id,
    case when o_orderkey % 11 = 0 then '' else strftime(o_orderdate, '%Y-%m-%d') end as day, o_orderpriority as instrument, o_orderstatus as status,
    o_custkey as project_key, o_totalprice as price, coalesce(cell, '') as cell
  from orders left join packed on o_orderkey = order_key)"""
)
