"""Free-text search over a large registry by a table of trigrams, kept up as the registry grows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH = 3
BUCKETS = 64
BLOCK = 1 << 20  # bytes of blobs that are packed together
FEW = 10_000  # candidates that are asked for by their keys


def grams(text: str) -> list[str]:
    return sorted({text[k : k + WIDTH] for k in range(len(text) - WIDTH + 1)})


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def _packed(keys: np.ndarray, blobs: list[str]) -> pa.RecordBatch:
    """gram, keys: each trigram of ``blobs`` once, with the keys of those that hold it. A trigram is a number of three characters of 21 bits."""
    chars = np.frombuffer("".join(blobs).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    row = np.repeat(np.arange(len(blobs)), [len(b) for b in blobs])
    inside = row[: 1 - WIDTH] == row[WIDTH - 1 :]
    code, row = (chars[:-2] << 42 | chars[1:-1] << 21 | chars[2:])[inside], row[: 1 - WIDTH][inside]
    order = np.lexsort((row, code))
    code, row = code[order], row[order]
    once = np.r_[True, (code[1:] != code[:-1]) | (row[1:] != row[:-1])][: len(code)]
    code, row = code[once], row[once]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]][: len(code)])
    names = ["".join(chr(c >> shift & 0x1FFFFF) for shift in (42, 21, 0)) for c in code[first].tolist()]
    lists = pa.ListArray.from_arrays(pa.array(np.r_[first, len(code)], pa.int32()), pa.array(keys[row]))
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), lists], names=["gram", "keys"])


def postings(rows: DataFrame, key: str, blob: str) -> DataFrame:
    """gram, keys, bucket: the trigrams of the blobs, each with the keys of the rows that hold it. A task packs BLOCK characters at a time, so a trigram has a row each time; a key stands in one of them for each of its rows."""
    long_enough = rows.where(F.char_length(blob) >= WIDTH).select(F.col(key).cast("long").alias("key"), F.col(blob).alias("blob")).where("key is not null")

    def batches(parts):
        keys, blobs, size = [], [], 0
        for part in parts:
            keys.append(part.column(0).to_numpy())
            blobs += part.column(1).to_pylist()
            size += part.column(1).nbytes
            if size >= BLOCK:
                yield _packed(np.concatenate(keys), blobs)
                keys, blobs, size = [], [], 0
        if blobs:
            yield _packed(np.concatenate(keys), blobs)

    return long_enough.mapInArrow(batches, "gram string, keys array<long>").withColumn("bucket", _bucket(F.col("gram")))


def add(rows: DataFrame, key: str, blob: str, path: str) -> None:
    """Append the trigrams of new ``rows``; a bucket's file is sorted, so a gram lies in few row groups. Rows must be new: ``incremental.new_rows`` tells which are."""
    new = postings(rows, key, blob)
    new.repartition("bucket").sortWithinPartitions("bucket", "gram").write.mode("append").partitionBy("bucket").parquet(path)


def candidates(spark: SparkSession, path: str, text: str) -> DataFrame:
    """key of the rows that have all trigrams of ``text``, which holds WIDTH characters or more. Only the buckets and row groups of these are read."""
    wanted = grams(text.lower())
    buckets = [r[0] for r in spark.createDataFrame([(g,) for g in wanted], "gram string").select(_bucket(F.col("gram"))).distinct().collect()]
    held = spark.read.schema("gram string, keys array<long>, bucket int").parquet(path).where(F.col("bucket").isin(buckets) & F.col("gram").isin(wanted))
    held = held.select("gram", F.explode("keys").alias("key"))
    return held.groupBy("key").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(wanted)).select("key")


def searched(registry: DataFrame, key: str, blob: str, path: str, text: str) -> DataFrame:
    """The rows of ``registry`` whose blob, in lower case, holds ``text`` in any case.

    Trigrams give candidates, the text itself decides. Few candidates are asked for by key, which reaches the scan of a registry that is
    sorted by it; many are joined. A text under WIDTH characters has no trigram, so all rows are looked at.
    """
    holds = F.contains(F.col(blob), F.lit(text.lower()))
    if len(text) < WIDTH:
        return registry.where(holds)
    found = candidates(registry.sparkSession, path, text)
    some = [r[0] for r in found.limit(FEW + 1).collect()]
    if len(some) <= FEW:
        return registry.where(F.col(key).isin(some) & holds)
    return registry.join(found.withColumnRenamed("key", "_key"), F.col(key) == F.col("_key"), "left_semi").where(holds)
