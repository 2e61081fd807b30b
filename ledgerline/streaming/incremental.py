"""Idempotent runs, restarts and queues with states; batch and Structured Streaming forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def new_rows(incoming: DataFrame, registry: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``incoming`` whose keys the registry lacks, each key once. Running twice adds nothing the second time."""
    return incoming.join(registry.select(*keys), keys, "left_anti").dropDuplicates(keys)


def append_stream(spark: SparkSession, source: str, schema, registry: str, checkpoint: str, keys: list[str], by: str) -> None:
    """Read what is new under ``source`` and append to the parquet ``registry`` what it lacks, batch by batch, until all is read.

    A batch that is run again after a failure finds its rows there, so each row is appended once. The registry is
    partitioned by ``by``, such as a day, which must follow from the keys: a batch reads only the partitions it has rows of, so its
    cost does not grow with the registry's history.
    """

    def append(batch: DataFrame, _: int) -> None:
        touched = [r[0] for r in batch.select(by).distinct().collect()]  # partitions of one batch
        held = F.col(by).isin(*[x for x in touched if x is not None]) | (F.col(by).isNull() if None in touched else F.lit(False))
        known = batch.sparkSession.read.schema(schema).parquet(registry).where(held)
        new_rows(batch, known, keys).write.mode("append").partitionBy(by).parquet(registry)

    spark.createDataFrame([], schema).write.mode("append").partitionBy(by).parquet(registry)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(source)
    stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def to_transfer(wanted: DataFrame, present: DataFrame, path: str, size: str, mtime: str, within: float = 2.0) -> DataFrame:
    """Files of ``wanted`` that are not there with the same size and a time within some seconds."""
    there = present.select(F.col(path).alias("_p"), F.col(size).alias("_s"), F.col(mtime).alias("_m"))
    same = (F.col(path) == F.col("_p")) & (F.col(size) == F.col("_s")) & (F.abs(F.col(mtime) - F.col("_m")) <= within)
    return wanted.join(there, same, "left_anti")


def advanced(queue: DataFrame, results: DataFrame, key: str, status: str, transitions: list[tuple[str, str, str]]) -> DataFrame:
    """``queue`` after ``results`` (key, event): the status that (from, event, to) gives; other rows stay."""
    rows = queue.join(results.select(F.col(key).alias("_k"), F.col("event").alias("_e")), F.col(key) == F.col("_k"), "left")
    new = F.col(status)
    for before, event, after in transitions:
        new = F.when((F.col(status) == before) & (F.col("_e") == event), after).otherwise(new)
    return rows.withColumn(status, new).drop("_k", "_e")


def reconciled(queue: DataFrame, present: DataFrame, key: str, status: str, open_: str = "pending", done: str = "done") -> DataFrame:
    """``queue`` with open rows whose data is there already marked as done: a run died between the two writes."""
    there = present.select(F.col(key).alias("_k")).distinct().withColumn("_there", F.lit(True))
    rows = queue.join(there, F.col(key) == F.col("_k"), "left")
    return rows.withColumn(status, F.when((F.col(status) == open_) & F.coalesce("_there", F.lit(False)), done).otherwise(F.col(status))).drop("_k", "_there")


EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _instant(time: Column) -> Column:
    """A time without a zone as an instant of UTC, by seconds since 1970: differences of instants would go by the session's clock."""
    seconds = (time - F.expr(EPOCH)).cast("interval second").cast("decimal(18, 6)")
    return F.timestamp_micros((seconds * 1_000_000).cast("long"))


def _without_zone(instant: Column) -> Column:
    return F.expr(EPOCH) + (F.unix_micros(instant).cast("decimal(18, 0)") / 1_000_000).cast("decimal(18, 6)").cast("interval second")


def windowed(events: DataFrame, time: str, size: str, by: list[str], late: str | None = None, **measures: Column) -> DataFrame:
    """Counts and ``measures`` by tumbling windows of event time, for batches and, with ``late``, streams.

    Watermarks need instants, so a time without a zone stands for that of UTC meanwhile, whatever the session's zone: windows are the same either way.
    """
    wall = bool(late) and events.schema[time].dataType == T.TimestampNTZType()
    rows = events.withColumn(time, _instant(F.col(time))) if wall else events
    rows = rows.withWatermark(time, late) if late else rows
    found = rows.groupBy(F.window(time, size).alias("w"), *by).agg(F.count("*").alias("n"), *(m.alias(k) for k, m in measures.items()))
    return found.select((_without_zone(F.col("w.start")) if wall else F.col("w.start")).alias("start"), *by, "n", *measures)


def closed_windows(events: DataFrame, path: str, checkpoint: str, time: str, size: str, by: list[str], late: str, **measures: Column) -> None:
    """Append to the parquet table ``path`` those windows of a stream that are closed by now, then stop; the next call goes on.

    A window is closed once an event ``late`` after its end was seen; it is then written once, whatever fails and is run again,
    and its state is dropped, so what is kept does not grow with the stream. Events of closed windows, and those
    without a time, are in none.
    """
    found = windowed(events.where(F.col(time).isNotNull()), time, size, by, late, **measures)
    found.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
