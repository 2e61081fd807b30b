"""Directory trees as a data source: a folder that the bounds of a walk rule out is never listed.

    spark.dataSource.register(TreeSource)
    spark.read.format("tree").option("anchor", "^scan_").option("below", 0).load("/data")

Rows are folders and files, with ``below``, the number of levels under the nearest folder above whose name the anchor fits: 0
for the anchor itself and for what is under none. The driver lists the upper levels; each folder found there is a partition,
whose task walks it. Bounds stop the walk: below at an anchor, depth at a level, a prefix of the path beside it. They are
options of a load, not filters that Spark hands down: it keeps those by loaded table, so of two uses of one DataFrame with
unlike filters one would miss rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, name string, depth int, below int, is_dir boolean, length long, modified timestamp"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def listed(files: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    """What is in ``folder``, by name; nothing if it is gone."""
    return sorted(files.get_file_info(fs.FileSelector(folder, allow_not_found=True)), key=lambda i: i.path)


class Subtree(InputPartition):
    """Folders to walk, with their depth and levels below an anchor; and rows that are there already."""

    def __init__(self, folders: list[tuple[str, int, int]], rows: list[tuple]):
        super().__init__(None)
        self.folders, self.rows = folders, rows


class TreeReader(DataSourceReader):
    def __init__(self, root: str, anchor: str | None = None, spread: int = 1, below: int | None = None, depth: int | None = None, prefix: str = ""):
        self.root, self.anchor, self.spread = root, anchor, spread
        self.most_below, self.deepest, self.prefix = below, depth, prefix

    def _wanted(self, path: str, depth: int, below: int) -> bool:
        """Whether what is in the folder can be within the bounds."""
        if self.deepest is not None and depth + 1 > self.deepest:
            return False
        anchored = below > 0 or self._is_anchor(path)
        if self.most_below is not None and anchored and below + 1 > self.most_below:
            return False
        inside = path.rstrip("/") + "/"
        return inside.startswith(self.prefix) or self.prefix.startswith(inside)

    def _is_anchor(self, path: str) -> bool:
        return self.anchor is not None and re.search(self.anchor, path.rpartition("/")[2]) is not None

    def _inside(self, files: fs.FileSystem, folder: str, depth: int, below: int) -> Iterator[tuple]:
        under = below + 1 if below or (depth and self._is_anchor(folder)) else 0
        for i in listed(files, folder):
            is_dir = i.type == fs.FileType.Directory
            yield i.path, i.base_name, depth + 1, under, is_dir, None if is_dir else i.size, i.mtime

    def partitions(self) -> list[Subtree]:
        files, root = opened(self.root)
        level, above = [(root.rstrip("/") or "/", 0, 0)], []
        for _ in range(self.spread):
            rows = [r for f in level if self._wanted(*f) for r in self._inside(files, *f)]
            above += rows
            level = [(r[0], r[2], r[3]) for r in rows if r[4]]
        return [Subtree([], above), *(Subtree([f], []) for f in level if self._wanted(*f))]

    def read(self, part: Subtree) -> Iterator[tuple]:
        yield from part.rows
        files, _ = opened(self.root)
        waiting = list(part.folders)
        while waiting:
            for row in self._inside(files, *waiting.pop()):
                yield row
                if row[4] and self._wanted(row[0], row[2], row[3]):
                    waiting.append((row[0], row[2], row[3]))


class TreeSource(DataSource):
    """Options: path; anchor, a pattern of folder names; spread, the levels that the driver lists, 1 if not given; the bounds below, depth and prefix."""

    @classmethod
    def name(cls) -> str:
        return "tree"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TreeReader:
        bounds = {k: int(self.options[k]) for k in ("below", "depth") if k in self.options}
        return TreeReader(self.options["path"], self.options.get("anchor"), int(self.options.get("spread", 1)), prefix=self.options.get("prefix", ""), **bounds)


def walked(spark: SparkSession, root: str, anchor: str | None = None, spread: int = 1, below: int | None = None, depth: int | None = None, prefix: str | None = None) -> DataFrame:
    """The folders and files under ``root`` within the bounds that are given: at most ``below`` and ``depth``, a path that begins with ``prefix``."""
    spark.dataSource.register(TreeSource)
    options = {"anchor": anchor, "spread": spread, "below": below, "depth": depth, "prefix": prefix}
    rows = spark.read.format("tree").options(**{k: v for k, v in options.items() if v is not None}).load(root)
    rows = rows if below is None else rows.where(F.col("below") <= below)
    rows = rows if depth is None else rows.where(F.col("depth") <= depth)
    return rows if prefix is None else rows.where(F.startswith("path", F.lit(prefix)))
