"""Passages that repeat, by compacting a De Bruijn graph of words.

A window of WINDOW words is an edge, from the node of its first words to that of its last. Edges are not moved one by one: in
each window the ANCHOR words that hash least are its anchor, and windows of one document that share their anchor are a segment,
a path without branches that is counted and compared as one. A window can repeat only where its anchor does, so segments whose
anchor is alone in the corpus are done with. Of the others, an anchor that has one segment only repeats with all its windows;
segments that differ about one anchor are told apart window by window, each distinct segment once, whatever its number of
copies. Repeated segments that follow each other wherever either occurs are joined to paths. Their first copies follow each other
too, in one text, so a path is a run of representatives of one text, and no rounds over the graph are needed.

Names are hashes, so source coordinates verify them: a digest of 128 bits over the words of a segment's representative is held
against the words at each place where the segment is said to be, before anything there counts as repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

WINDOW = 35
ANCHOR = 8
BLOCK = 1 << 20  # bytes of a text that are looked at together
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xD6E8FEB86659FD93)
FEW = 1_000_000  # keys, of 8 bytes, that may be sent to all tasks


def _blocks(text: bytes, keep: int) -> Iterator[tuple[int, list[bytes]]]:
    """The words of ``text``, about BLOCK bytes at a time, each block led by the last ``keep`` words before it; with the place of its first word."""
    at, place, led = 0, 0, []
    while at < len(text):
        end = at + BLOCK
        while end < len(text) and text[end] != 32 and not 9 <= text[end] <= 13:
            end += 1
        words = led + text[at:end].split()
        yield place, words
        led = words[-keep:] if keep else []
        place += len(words) - len(led)
        at = end


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of BASE and of its inverse below ``n``, modulo 2 ** 64."""
    some = lambda x: np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, x, np.uint64)])
    return some(np.uint64(BASE)), some(np.uint64(pow(BASE, -1, 1 << 64)))


def segments_of(text: str, window: int = WINDOW, anchor: int = ANCHOR) -> Iterator[np.ndarray]:
    """Per block of ``text``: five rows, place of the first window, number of windows, anchor, name of the segment and of the one that follows, 0 if none.

    What is chosen in a window depends on its words alone. Where a block ends a segment is cut, which costs comparisons but loses none.
    """
    width = window - anchor + 1
    for place, words in _blocks(text.encode(), window - 1):
        n = len(words) - window + 1
        if n < 1:
            continue
        size = 1 << len(words).bit_length()
        powers, inverse = _powers(size)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        sums = np.r_[np.uint64(0), np.cumsum(hashes * inverse[: len(words)])]
        grams = (sums[anchor:] - sums[:-anchor]) * powers[: len(words) - anchor + 1] * MIX
        grams = (grams ^ (grams >> np.uint64(32))) * MIX
        least = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(1) + np.arange(n)
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        end = np.r_[first[1:], n]
        names = ((sums[end + window - 1] - sums[first]) * powers[first] + (end - first).astype(np.uint64)) * MIX
        names = (names ^ (names >> np.uint64(32))) | np.uint64(1)
        follows = np.r_[names[1:], np.uint64(0)]
        yield np.stack([first + place, end - first, grams[least[first]].view(np.int64), names.view(np.int64), follows.view(np.int64)])


def segments(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Per segment of the texts of ``docs`` (doc_id, text, text_hash): doc_id, text_hash, place, n, anchor, name, follows."""
    names = ["doc_id", "text_hash", "place", "n", "anchor", "name", "follows"]

    def batches(parts):
        for part in common.sliced(parts):
            found, rows = [np.zeros((5, 0), np.int64)], [np.zeros(0, np.int64)]
            for row, text in enumerate(part.column(1)):
                for some in segments_of(text.as_py() or "", window, anchor):
                    found.append(some)
                    rows.append(np.full(some.shape[1], row))
            place, n, *rest = np.concatenate(found, 1)
            at = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(2).take(at), *map(pa.array, (place, n.astype(np.int32), *rest))], names=names)

    return docs.mapInArrow(batches, common.with_id(docs, "text_hash long, place long, n int, anchor long, name long, follows long"))


def _beside(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """``rows`` joined with ``keys``, written ones, which are counted and sent to all tasks if they are few."""
    return rows.join(F.broadcast(keys) if keys.count() <= FEW else keys, on)


def candidates(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Segments whose anchor occurs more than once in the corpus, with mixed: whether segments about that anchor differ."""
    found = common.materialised(segments(docs, window, anchor))
    anchors = found.groupBy("anchor").agg(F.count("*").alias("times"), (F.min("name") != F.max("name")).alias("mixed")).where("times > 1").drop("times")
    return common.materialised(_beside(found, common.materialised(anchors), "anchor"))


def _lists(marks) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Of a column of arrays of structs without nulls: per row that is not empty its number and its fields."""
    offsets, fields = marks.offsets.to_numpy(), [f.to_numpy(zero_copy_only=False) for f in marks.values.flatten()]
    for row, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        yield row, [f[a:b] for f in fields]


def _digest(words: list[bytes]) -> tuple[int, int]:
    high, low = divmod(xxhash.xxh3_128_intdigest(b" ".join(words)), 1 << 64)
    return high - (1 << 63), low - (1 << 63)


def _of_text(docs: DataFrame, marks: DataFrame, how: str = "inner") -> DataFrame:
    """doc_id, text, marks: rows of ``docs`` that have ``marks`` (doc_id, text_hash, marks). Only texts whose hash is among the marked ones are shuffled, if these are few enough to be sent around."""
    hashes = common.materialised(marks.select("text_hash").distinct())
    some = docs.join(F.broadcast(hashes), "text_hash", "left_semi") if hashes.count() <= FEW else docs
    marks = marks.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    return some.join(marks, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), how).select("doc_id", "text", "marks")


def representatives(docs: DataFrame, distinct: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per segment of ``distinct``: anchor, name, high and low, the digest of its representative's words, and windows, their hashes where it is mixed."""
    fields = ["place", "n", "anchor", "name", "mixed"]
    names = ["anchor", "name", "high", "low", "windows"]
    marks = distinct.select("first.doc_id", "first.text_hash", F.struct("first.place", *fields[1:]).alias("mark")).groupBy("doc_id", "text_hash").agg(F.collect_list("mark").alias("marks"))

    def batches(parts):
        for part in common.sliced(parts):
            found = []
            for row, (places, ns, anchors, segment_names, mixed) in _lists(part.column(2)):
                words = part.column(1)[row].as_py().encode().split()
                for place, n, a, name, differs in zip(*(x.tolist() for x in (places, ns, anchors, segment_names, mixed))):
                    hashes = [xxhash.xxh3_64_intdigest(b" ".join(words[k : k + window])) - (1 << 63) for k in range(place, place + n)] if differs else []
                    found.append((a, name, *_digest(words[place : place + n + window - 1]), hashes))
            columns = list(zip(*found)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.list_(pa.int64()))], names=names)

    return _of_text(docs, marks).mapInArrow(batches, "anchor long, name long, high long, low long, windows array<long>")


def repeated_segments(docs: DataFrame, found: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per distinct segment with a repeated window: anchor, name, copies, high, low, path and mask, a bit for each of its windows that repeats."""
    least = F.min(F.struct("doc_id", "text_hash", "place")).alias("first")
    distinct = found.groupBy("anchor", "name").agg(F.count("*").alias("copies"), least, F.first("n").alias("n"), F.first("mixed").alias("mixed"), F.min("follows").alias("follows"), F.max("follows").alias("last"))
    distinct = common.materialised(distinct)
    common.release(docs.sparkSession)
    known = common.materialised(distinct.join(representatives(docs, distinct, window).dropDuplicates(["anchor", "name"]), ["anchor", "name"]))
    del distinct
    common.release(docs.sparkSession)
    # A window is never twice in one segment, as its anchor would then be at two places of it: it occurs as often as the segments that have it.
    each = known.where("mixed").select("anchor", "name", "copies", F.posexplode("windows").alias("k", "hash"))
    twice = each.groupBy("hash").agg(F.sum("copies").alias("times")).where("times > 1").drop("times")
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("k"))).alias("mask")
    masks = each.where("copies = 1").drop("copies").join(twice, "hash").groupBy("anchor", "name").agg(bits)
    known = known.drop("windows", "mixed")
    whole = known.where("copies > 1").withColumn("mask", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("n")) - 1)
    masked = whole.unionByName(known.where("copies = 1").join(masks, ["anchor", "name"]))
    return _with_paths(masked).select("anchor", "name", "copies", "high", "low", "mask", "path")


def _with_paths(masked: DataFrame) -> DataFrame:
    """``masked`` with path, the least name on it. A segment and the next are of one path if each of its copies is followed by that, which occurs as often,
    and both repeat where they touch. The next one's copies are then those behind its own, so their first ones are neighbours, too."""
    rows = masked.select("*", "first.*").drop("first")  # columns of their own: all windows are then over one shuffle
    text = Window.partitionBy("doc_id", "text_hash")
    before = F.lag(F.struct("name", "n", "copies", "mask", "follows", "last", "place")).over(text.orderBy("place"))
    ends = (F.col("_b.follows") == F.col("_b.last")) & (F.call_function("shiftright", F.col("_b.mask"), F.col("_b.n") - 1) == 1)
    meets = (F.col("_b.follows") == F.col("name")) & (F.col("_b.place") + F.col("_b.n") == F.col("place"))
    linked = ends & meets & (F.col("mask").bitwiseAND(1) == 1) & (F.col("_b.copies") == F.col("copies")) & (F.col("_b.name") != F.col("name"))
    runs = rows.withColumn("_b", before).withColumn("_run", F.sum(F.when(linked, 0).otherwise(1)).over(text.orderBy("place")))
    return runs.withColumn("path", F.min("name").over(Window.partitionBy("doc_id", "text_hash", "_run"))).drop("_b", "_run")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept, the words that no repeated window covers, joined by spaces, and spans.

    A window repeats if its words also start at another place of any row, the same one included. spans has start and end, in words
    of the row, and path of each run of repeated windows that lies on one path. Rows alike in id and text are rows of their
    own, so all their windows repeat; a null text has no words, a null id is an id; texts under ``window`` words lose none. An
    empty table gives no rows; other columns are ignored.
    """
    view = common.docs_view(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    found = candidates(view, window, anchor)
    common.release(docs.sparkSession)
    known = common.materialised(repeated_segments(view, found, window))
    common.release(docs.sparkSession)
    marks = found.select("doc_id", "text_hash", "place", "n", "anchor", "name").join(known, ["anchor", "name"])
    marks = marks.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("place", "n", "mask", "path", "high", "low")).alias("marks"))
    marks = common.materialised(marks)
    del found, known
    common.release(docs.sparkSession)
    names = ["doc_id", "n_words", "n_removed", "kept", "spans"]

    def batches(parts):
        for part in common.sliced(parts):
            counts, removed, kept, spans = [], [], [], []
            for row, mark in _lists(part.column(2)):
                words = (part.column(1)[row].as_py() or "").encode().split()
                covered, found = _covered(words, mark, window)
                left = [w for w, gone in zip(words, covered.tolist()) if not gone] if len(found) else words
                counts.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
                spans.append(found)
            fields = [pa.array(x, pa.int64()) for x in (np.concatenate(spans).T if spans else np.zeros((3, 0), np.int64))]
            ends = pa.array(np.r_[0, np.cumsum([len(x) for x in spans])], pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(fields, names=["start", "end", "path"]))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), lists], names=names)

    rows = _with_marks(view, marks)
    return rows.mapInArrow(batches, common.with_id(view, "n_words long, n_removed long, kept string, spans array<struct<start: long, end: long, path: long>>"))


def _with_marks(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """doc_id, text, marks of all rows of ``docs``; marks are empty where there are none. Texts without any are not shuffled, if the hashes of the others are few."""
    none = F.array().cast(marks.schema["marks"].dataType)
    hashes = common.materialised(marks.select("text_hash").distinct())
    if hashes.count() <= FEW:
        plain = docs.join(F.broadcast(hashes), "text_hash", "left_anti").select("doc_id", "text", none.alias("marks"))
        return plain.unionByName(_of_text(docs, marks, "left").select("doc_id", "text", F.coalesce("marks", none).alias("marks")))
    return _of_text(docs, marks, "left").select("doc_id", "text", F.coalesce("marks", none).alias("marks"))


def _covered(words: list[bytes], mark: list[np.ndarray], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each word whether a repeated window covers it; and the runs of windows on one path, as rows of start, end and path. Only windows of segments whose words are those of their representative count."""
    place, n, mask, path, high, low = mark
    same = [_digest(words[a : a + k + window - 1]) == (x, y) for a, k, x, y in zip(*(v.tolist() for v in (place, n, high, low)))]
    bits = np.arange(window, dtype=np.int64)
    on = ((mask[:, None] >> bits) & 1 == 1) & np.array(same, bool)[:, None]
    starts, at = np.unique((place[:, None] + bits)[on], return_index=True)
    paths = np.broadcast_to(path[:, None], on.shape)[on][at]
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    cut = np.flatnonzero(np.r_[True, (np.diff(starts) != 1) | (np.diff(paths) != 0)]) if len(starts) else np.zeros(0, np.int64)
    last = np.r_[cut[1:], len(starts)][: len(cut)] - 1
    return np.cumsum(change[:-1]) > 0, np.stack([starts[cut], starts[last] + window, paths[cut]], 1).astype(np.int64)


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP12_SQL = """
with numbered as (select doc_id, row_number() over () as row, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from documents),
windows as (
  select row, start, md5(array_to_string(words[start:start + 34], ' ')) as name
  from numbered, unnest(range(1, len(words) - 33)) as u(start)),
twice as (select name from windows group by name having count(*) > 1),
starts as (select row, start from windows where name in (select name from twice)),
words as (select row, at_place, words[at_place] as word from numbered, unnest(range(1, len(words) + 1)) as u(at_place)),
judged as (
  select w.row, w.at_place, word, max(start) over (partition by w.row order by w.at_place rows between 34 preceding and current row) is not null as gone
  from words w left join starts s on s.row = w.row and s.start = w.at_place),
left_over as (select row, count(*) filter (gone) as n_removed, coalesce(string_agg(word, ' ' order by at_place) filter (not gone), '') as kept from judged group by row)
select doc_id, len(words)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from numbered left join left_over using (row)
"""
