"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most two bits have a value between them that differs from either in at most one. So
every distinct fingerprint emits itself and its 64 one-bit variants, and the rows meet on the variant. All fingerprints
that meet there lie within one bit of the variant, so within two of each other: each collision is a verified link, and
linking a variant's members to the least of them keeps what is connected without emitting all pairs. A variant has at
most 65 members; which they are fits a 64-bit mask of flipped bits and one flag, so the shuffle sums up fixed-width rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import connected_components

RADIUS = 2
SHINGLE = 3
SEED = 42
BLOCK = 1 << 16
VARIANTS_A_PART = 4_000_000
BLOCK_ROWS = 1 << 10
LEAST_PARTS = 64
ROWS_A_PART = 1 << 18


def fingerprint(text: str, width: int = SHINGLE, seed: int = SEED) -> int:
    """The signed 64-bit fingerprint of ``text``: bits that over half of its shingles' hashes have."""
    words = text.encode().lower().split()  # of bytes: A-Z only, and the six ASCII white space characters only
    if not words:
        return 0
    digest, n = xxhash.xxh64_intdigest, max(1, len(words) - width + 1)
    if n == 1:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(width))))
    votes, left = np.zeros(64, np.int64), n
    while left:
        some = min(left, BLOCK)
        hashes = np.fromiter((digest(s, seed) for s, _ in zip(shingles, range(some))), np.uint64, some)
        votes += np.unpackbits(hashes.view(np.uint8).reshape(some, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        left -= some
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, seed: int = SEED, also: Sequence[Column] = ()) -> DataFrame:
    """Per row of ``docs``: doc_id, fp (signed long) and the columns ``also``, longs of other names. Null texts and texts without words have fingerprint zero; repeated rows give a row each. An empty table gives no rows; other columns are ignored, whatever their names."""
    view = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"), *also)
    names = ["doc_id", "fp", *view.columns[2:]]

    def batches(parts):
        for part in common.sliced(parts):
            fps = [fingerprint(x, width, seed) if x else 0 for x in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps, pa.int64()), *part.columns[2:]], names=names)

    return view.mapInArrow(batches, common.with_id(view, ", ".join(["fp long", *(f"{c} long" for c in view.columns[2:])])))


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between distinct values of ``fp`` that differ in one or two bits, enough to connect all that are."""
    masks = F.array(*(F.lit(0 if k < 0 else (1 << k) - (1 << 64 if k == 63 else 0)).cast("long") for k in range(-1, 64)))
    # Dealt out before and after they grow 65-fold: nearly all variants are single, so summing them up before the shuffle
    # would only fill memory, and few rows before must not mean few tasks. Their number follows from that of the fingerprints.
    parts = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-65 * fps.count() // VARIANTS_A_PART))
    emitted = fps.repartition(parts, "fp").select("fp", F.explode(masks).alias("mask")).select(F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), "mask")
    emitted = emitted.repartition(parts, "variant")
    met = emitted.groupBy("variant").agg(F.bit_or("mask").alias("flips"), F.max(F.col("mask") == 0).alias("own"))
    met = met.where(F.bit_count("flips") + F.col("own").cast("int") > 1)
    members = F.filter(masks, lambda m: F.when(m == 0, F.col("own")).otherwise(F.col("flips").bitwiseAND(m) != 0))
    met = met.select(F.transform(members, lambda m: F.col("variant").bitwiseXOR(m)).alias("members"))
    return met.select(F.array_min("members").alias("a"), F.explode("members").alias("b")).where("a <> b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the least doc_id that links of at most two differing bits reach, the row's own included; where a
    component has null ids only, it is null. Texts that are null or without words share fingerprint zero and are linked
    like any other. Repeated rows give a row each; an empty table gives none; other columns are ignored.
    """
    marked = common.materialised(fingerprints(docs, id_col, text_col))  # narrow; texts are read once
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(_components(marked), "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def _components(marked: DataFrame) -> DataFrame:
    """Per distinct fp of ``marked``: fp, the root of its component, component_id."""
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(links(least.select("fp")), "a", "b")
    rooted = least.join(roots, least["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(of_root, "root").select("fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their component: one each.

    It is the one with the least id, null ids last, of several texts under that id the one with the least XXH64, and of rows
    alike in id and text the one whose other columns (maps aside) hash least. Null and empty texts stand for each other, as
    they share fingerprint zero; an empty table gives no rows; no name of a column can clash.

    Texts are never shuffled. A row's place is the file it is read from and its number there; which places stay is settled on
    ids, hashes and places alone and written to the shared folder, by blocks of BLOCK_ROWS rows of a file. A task then looks
    up the blocks it reads, so no task holds more of them than a block, at any size of ``docs``. Rows that no Parquet file
    holds, or of which several come from one place, as above a join, are written first; Parquet must know their types.
    """
    found, marked = docs, None
    if _place(docs):
        marked = _marked(docs, id_col, text_col)
        if marked.groupBy("file", "at").count().where("count > 1").head(1):
            marked = None
    if marked is None:
        found = common.written(docs, "rows")
        marked = _marked(found, id_col, text_col)

    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "rest", "file", "at")
    best = marked.groupBy("fp").agg(F.min(order).alias("best")).join(_components(marked), "fp").groupBy("root").agg(F.min("best").alias("best"))
    block = F.floor(F.col("at") / BLOCK_ROWS).cast("long")
    parts = max(LEAST_PARTS, -(-marked.count() // ROWS_A_PART))
    part = F.pmod(F.xxhash64("file", block), F.lit(parts)).cast("int")
    best = best.select("best.file", "best.at").select(part.alias("part"), "file", block.alias("block"), "at")
    folder = common.shared_folder(docs.sparkSession, "places")
    best.repartition("part").sortWithinPartitions("part", "file", "block").write.partitionBy("part").parquet(folder)

    rows = found.select(F.struct(*(found[c] for c in found.columns)).alias("row"), *_place(found))
    return rows.where(_stays(folder)(part, "file", block, "at")).select("row.*")


def _place(docs: DataFrame) -> list[Column]:
    """The columns ``file`` (a hash of its path) and ``at`` (the row's number in it); none where ``docs`` is not read from Parquet files."""
    try:
        hidden = docs.metadataColumn("_metadata")
        place = [F.xxhash64(hidden["file_path"]).alias("file"), hidden["row_index"].alias("at")]
        docs.select(*place)
    except AnalysisException:
        return []
    return place


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row of ``docs``: doc_id, fp, hashes of the text and of all columns, and the row's place."""
    plain = [docs[c] for c, kind in docs.dtypes if "map<" not in kind]
    also = [F.xxhash64(docs[text_col].cast("string")).alias("text_hash"), F.xxhash64(*plain).alias("rest"), *_place(docs)]
    return common.materialised(fingerprints(docs, id_col, text_col, also=also))


def _stays(folder: str):
    """A function of a row's part, file, block and number: whether ``folder`` holds its place."""
    held: dict[tuple, np.ndarray] = {}

    def numbers(part: int, file: int, block: int) -> np.ndarray:
        store, root = fs.FileSystem.from_uri(folder)
        whole, places = store.get_file_info([f"{root}/_SUCCESS", f"{root}/part={part}"])
        if whole.type == fs.FileType.NotFound:
            raise FileNotFoundError(f"{folder} is not whole")
        if places.type == fs.FileType.NotFound:
            return np.zeros(0, np.int64)
        asked = [("file", "=", file), ("block", "=", block)]
        return pq.read_table(places.path, columns=["at"], filters=asked, filesystem=store, partitioning=None).column(0).to_numpy()

    @F.arrow_udf("boolean")
    def stays(part: pa.Array, file: pa.Array, block: pa.Array, at: pa.Array) -> pa.Array:
        keys = np.column_stack([c.to_numpy(zero_copy_only=False) for c in (part, file, block)])
        found = np.zeros(len(keys), bool)
        changes = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1  # rows come in the order of their file
        for some in np.split(np.arange(len(keys)), changes):
            if len(some):
                key = tuple(keys[some[0]].tolist())
                if key not in held:
                    held.clear()
                    held[key] = numbers(*key)
                found[some] = np.isin(at.to_numpy(zero_copy_only=False)[some], held[key])
        return pa.array(found)

    return stays


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"))
