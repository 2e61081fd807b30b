"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs_view(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, as ``doc_id`` and ``text``: no other column of ``docs`` can clash with one an operator adds."""
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))


def with_id(docs: DataFrame, fields: str) -> T.StructType:
    """A schema of ``doc_id``, typed as in ``docs``, followed by ``fields`` in DDL."""
    rest = T._parse_datatype_string(fields)
    return T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *rest.fields])


def sliced(parts: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The rows of ``parts`` in smaller batches: what Python holds of texts at a time stays small, however long they are."""
    for part in parts:
        for start in range(0, part.num_rows, rows):
            yield part.slice(start, rows)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Texts go to Python in batches of at most ``rows``, here and in what the session runs later: what is in flight stays small."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Use the shared folder of ``spark.checkpoint.dir``; a folder of our own only in local mode, where one machine is all there is."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(shared or "/tmp/checkpoints")


def materialised(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: later reads survive lost executors and do not compute it again."""
    ensure_checkpoints(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Ask the driver to collect its garbage: Spark removes shuffles and checkpoints that nothing refers to only once it has, so those of a finished step may stay on disk to the end."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared_folder(spark: SparkSession, name: str) -> str:
    """The path of a new folder below the shared checkpoint folder, not made yet."""
    ensure_checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the shared folder: later reads take the columns they need only, and each row has a place in a file."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
