"""Files opened in tasks: headers and checksums by reads of ranges, so no file is held whole, whatever its size."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from .trees import opened

BLOCK = 1 << 20

# Fixed values of the DICOM standard, parts 5 and 10
PREAMBLE, MAGIC = 128, b"DICM"
LONG_LENGTHS = {b"OB", b"OD", b"OF", b"OL", b"OV", b"OW", b"SQ", b"SV", b"UC", b"UN", b"UR", b"UT", b"UV"}
TRANSFER_SYNTAX, IMPLICIT = (0x0002, 0x0010), "1.2.840.10008.1.2"
UNREADABLE = {"1.2.840.10008.1.2.2", "1.2.840.10008.1.2.1.99"}  # big endian; deflated
PIXELS, ITEM, ITEM_END, SEQUENCE_END = (0x7FE0, 0x0010), (0xFFFE, 0xE000), (0xFFFE, 0xE00D), (0xFFFE, 0xE0DD)
UNDEFINED = 0xFFFFFFFF
MODALITY = (0x0008, 0x0060)
NO_IMAGES = {"PR", "SR", "KO"}  # presentation states, reports, key object selections

MOST_VALUE = 1 << 16  # a header value that claims to be longer is taken for a broken one


class Ranges:
    """A file read in small ranges; ``read_bytes`` tells how many bytes were."""

    def __init__(self, path: str):
        files, inner = opened(path)
        self.file, self.read_bytes = files.open_input_file(inner), 0

    def __enter__(self) -> Ranges:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def read(self, n: int) -> bytes:
        got = self.file.read(n)
        self.read_bytes += len(got)
        return got

    def exactly(self, n: int) -> bytes:
        got = self.read(n)
        if len(got) < n:
            raise EOFError
        return got

    def skip(self, n: int) -> None:
        self.file.seek(self.file.tell() + n)


def _element(file: Ranges, explicit: bool) -> tuple[tuple[int, int], int]:
    """Tag and length of the element that begins here; the file stands at its value then."""
    group, number, kind, short = struct.unpack("<HH2sH", file.exactly(8))
    if group == 0xFFFE or not (explicit or group == 0x0002):  # items carry no kind
        return (group, number), struct.unpack("<I", kind + struct.pack("<H", short))[0]
    return (group, number), struct.unpack("<I", file.exactly(4))[0] if kind in LONG_LENGTHS else short


def _skip_sequence(file: Ranges, explicit: bool) -> None:
    """To the end of a sequence or item without a length; inner ones are counted, not called for."""
    depth = 1
    while depth:
        tag, length = _element(file, explicit)
        if tag in (ITEM_END, SEQUENCE_END):
            depth -= 1
        elif length == UNDEFINED:
            depth += 1
        else:
            file.skip(length)


def elements(file: Ranges, wanted: set[tuple[int, int]], denied: set[tuple[int, int]] = frozenset()) -> dict[tuple[int, int], str] | None:
    """The texts of the ``wanted`` elements, denied ones left out before a byte of them is read; None if the file is of another kind.

    Elements come in the order of their tags, so reading ends after the last wanted one, and never reaches the pixels. What
    is read up to a broken place is kept.
    """
    file.skip(PREAMBLE)
    if file.read(len(MAGIC)) != MAGIC:
        return None
    found, explicit, last = {}, True, max(wanted, default=(0, 0))
    try:
        while True:
            tag, length = _element(file, explicit)
            if tag >= PIXELS or (tag > last and tag[0] > 0x0002):
                return found
            if length == UNDEFINED:
                _skip_sequence(file, explicit)
            elif tag == TRANSFER_SYNTAX or (tag in wanted and tag not in denied):
                if length > MOST_VALUE:
                    return found
                text = file.exactly(length).decode("utf-8", "replace").strip("\0 ")
                if tag == TRANSFER_SYNTAX:
                    if text in UNREADABLE:
                        return found
                    explicit = text != IMPLICIT
                if tag in wanted and tag not in denied:
                    found[tag] = text
            else:
                file.skip(length)
    except (EOFError, OSError, struct.error):
        return found


def folder_headers(files: DataFrame, fields: dict[str, tuple[int, int]], denied: set[tuple[int, int]], listed: int = 400, parsed: int = 40) -> DataFrame:
    """Per folder of ``files`` (folder, path) that has a header: folder, ``fields``, modalities, instances and bytes_read.

    Fields not in the header are ''; denied ones always are. The first ``listed`` files by name are looked at, in that order, until
    ``parsed`` had a header or an image is found and a second modality seen. Fields are those of the first image, or of the
    first header if there is no image.
    """
    first = Window.partitionBy("folder").orderBy("path")
    some = files.select("folder", "path").withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= listed).drop("_n")
    wanted = {*fields.values(), MODALITY}

    def read(key, part):
        best, modalities, seen, read_bytes = None, [], 0, 0
        for path in sorted(part["path"]):
            if seen >= parsed:
                break
            try:
                with Ranges(path) as file:
                    found = elements(file, wanted, denied)
                    read_bytes += file.read_bytes
            except OSError:
                continue
            if not found:
                continue
            seen += 1
            kind = found.get(MODALITY, "")
            modalities += [kind] * (kind != "" and kind not in modalities)
            if best is None or (best.get(MODALITY, "") in NO_IMAGES and kind not in NO_IMAGES):
                best = found
            if best.get(MODALITY, "") not in NO_IMAGES and len(modalities) > 1:
                break
        told = pd.DataFrame([[key[0], *((best or {}).get(tag, "") for tag in fields.values()), "/".join(sorted(modalities)), seen, read_bytes]], columns=names)
        return told if best is not None else told.iloc[:0]

    names = ["folder", *fields, "modalities", "instances", "bytes_read"]
    return some.groupBy("folder").applyInPandas(read, ", ".join(["folder string", *(f"`{f}` string" for f in fields), "modalities string, instances long, bytes_read long"]))


def with_magic(files: DataFrame, magic: bytes, at: int = PREAMBLE) -> DataFrame:
    """The rows of ``files`` whose path leads to a file with ``magic`` at byte ``at``; of each no more than that is read."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield part.filter(pa.array([_has(path, magic, at) for path in part["path"].to_pylist()], pa.bool_()))

    return files.mapInArrow(batches, files.schema)


def _has(path: str, magic: bytes, at: int) -> bool:
    try:
        with Ranges(path) as file:
            file.skip(at)
            return file.read(len(magic)) == magic
    except OSError:
        return False


def checksums(files: DataFrame) -> DataFrame:
    """path and sha256 of ``files``, read in blocks; null for a file that cannot be read."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield pa.RecordBatch.from_arrays([part["path"], pa.array([_sha256(path) for path in part["path"].to_pylist()], pa.string())], names=["path", "sha256"])

    return files.select("path").mapInArrow(batches, "path string, sha256 string")


def _sha256(path: str) -> str | None:
    digest = hashlib.sha256()
    try:
        with Ranges(path) as file:
            while block := file.read(BLOCK):
                digest.update(block)
    except OSError:
        return None
    return digest.hexdigest()


@udtf(returnType="folder string, format string, files long, bytes long, detail string")
class FolderContents:
    """Per folder and format of its files, told by their first bytes: how many, how large, and what the first one says of itself."""

    def __init__(self):
        self.folder, self.found = None, {}

    def eval(self, row):
        self.folder = row["folder"]
        try:
            with Ranges(row["path"]) as file:
                head = file.read(PREAMBLE + 128)
        except OSError:
            return
        kind = kind_of(head)
        entry = self.found.setdefault(kind, [0, 0, None])
        entry[0] += 1
        entry[1] += row["length"]
        if entry[2] is None:
            entry[2] = DETAILS[kind](row["path"], head)

    def terminate(self):
        for kind, (n, size, detail) in sorted(self.found.items()):
            yield self.folder, kind, n, size, detail


def kind_of(head: bytes) -> str:
    start = head.lstrip()
    if head[PREAMBLE : PREAMBLE + len(MAGIC)] == MAGIC:
        return "dicom"
    return "parameters" if start.startswith(b"##") else "json" if start.startswith((b"{", b"[")) else "xml" if start.startswith(b"<") else "other"


def _modality(path: str, head: bytes) -> str:
    with Ranges(path) as file:
        return (elements(file, {MODALITY}) or {}).get(MODALITY, "")


def _first_line(path: str, head: bytes) -> str:
    return head.lstrip().split(b"\n")[0].decode("utf-8", "replace").strip()


DETAILS = {"dicom": _modality, "parameters": _first_line, "json": lambda path, head: "", "xml": _first_line, "other": lambda path, head: ""}


def folder_contents(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``FolderContents`` of ``files`` (folder, path, length): a partition a folder, its files by path; a task reads heads only."""
    spark.udtf.register("folder_contents", FolderContents)
    return spark.sql("SELECT * FROM folder_contents(TABLE({files}) PARTITION BY folder ORDER BY path)", files=files.select("folder", "path", "length"))
