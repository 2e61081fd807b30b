"""Document fingerprints by locally consistent parsing.

A text is parsed in levels. Each level cuts its symbols into phrases and names each phrase by a hash of what is in it;
the names are the symbols of the next level. Where a phrase ends is decided by deterministic coin tossing: every symbol
is labelled by the lowest bit in which it differs from the one before and by that bit's value, which after a few rounds
leaves labels of a few values; a phrase begins where a label is less than both its neighbours, and a run of equal symbols
is first made one symbol. All this looks a few symbols to either side only, so equal substrings get equal names inside,
wherever they stand. The fingerprint is a one-permutation min-hash of the names of some levels.

A batch of texts is parsed as one array, with borders at which nothing is compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from . import common

LEVELS = (2, 3, 4)
BINS = 64
ROUNDS = 3
BATCH_CHARS = 1 << 18
RANGES_A_PART = 8
IDS_A_RANGE = 20
U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def _toss(label: np.ndarray, first: np.ndarray) -> np.ndarray:
    """New labels: twice the lowest bit in which each differs from the one before, plus that bit. ``first``: has none before."""
    before = np.empty_like(label)
    before[1:] = label[:-1]
    before[first] = ~label[first]
    apart = label ^ before
    low = apart & (~apart + U(1))
    place = np.bitwise_count(low - U(1)).astype(U)
    return (place << U(1)) | ((label & low) != 0).astype(U)


def _parse(symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next level's symbols and owners."""
    new = np.ones(len(symbols), bool)
    new[1:] = (symbols[1:] != symbols[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    lengths = np.diff(np.append(at, len(symbols)))
    symbols, owner = symbols[at], owner[at]
    runs = lengths > 1
    symbols[runs] = _mix(symbols[runs] + lengths[runs].astype(U) * U(0x9E3779B97F4A7C15))
    first = np.ones(len(symbols), bool)
    first[1:] = owner[1:] != owner[:-1]
    label = symbols
    for _ in range(ROUNDS):
        label = _toss(label, first)
    least = np.zeros(len(symbols), bool)
    if len(symbols) > 2:
        least[1:-1] = (label[1:-1] < label[:-2]) & (label[1:-1] <= label[2:]) & ~first[1:-1] & ~first[2:]
        least[1:] &= ~first[:-1]  # no phrase of one symbol at a text's beginning
    starts = np.flatnonzero(least | first)
    inside = np.arange(len(symbols)) - np.repeat(starts, np.diff(np.append(starts, len(symbols))))
    powers = np.cumprod(np.full(int(inside.max()) + 1, 0x9E3779B97F4A7C15, U))
    return _mix(np.add.reduceat(symbols * powers[inside], starts)), owner[starts]


def sketches(texts: list[str], levels: tuple = LEVELS, bins: int = BINS) -> list[str]:
    """The fingerprint of each text: ``bins`` numbers of 16 bits in hexadecimal, ffff where a bin is empty."""
    out, start = [], 0
    while start < len(texts):  # as many texts at a time as fit, one at least
        end, chars = start + 1, len(texts[start])
        while end < len(texts) and chars + len(texts[end]) <= BATCH_CHARS:
            chars += len(texts[end])
            end += 1
        out += _sketched(texts[start:end], levels, bins)
        start = end
    return out


def _sketched(texts: list[str], levels: tuple, bins: int) -> list[str]:
    counts = np.array([len(t) for t in texts])
    table = np.full(len(texts) * bins, 0xFFFF, np.uint16)
    symbols = _mix(np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(U) + U(1))
    owner = np.repeat(np.arange(len(texts)), counts)
    for level in range(1, max(levels) + 1):
        if not len(symbols):
            break
        symbols, owner = _parse(symbols, owner)
        if level in levels:
            hashed = _mix(symbols ^ U(level))
            value = np.minimum((hashed & U(0xFFFF)).astype(np.uint16), np.uint16(0xFFFE))
            np.minimum.at(table, owner * bins + ((hashed >> U(32)) % U(bins)).astype(np.int64), value)
    digits = table.astype(">u2").tobytes().hex()
    return [digits[k * bins * 4 : (k + 1) * bins * 4] for k in range(len(texts))]


def likeness(a: str, b: str) -> float:
    """The share of bins that agree among those that either fills; 1 for two empty texts."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(s), np.uint16) for s in (a, b))
    filled = (x != 0xFFFF) | (y != 0xFFFF)
    return float(((x == y) & filled).sum() / max(1, filled.sum()))


def fingerprint(docs: DataFrame, levels: tuple = LEVELS, bins: int = BINS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint. Null counts as empty; equal texts have equal fingerprints; repeated rows give a row each. An empty table gives no rows; other columns are ignored, whatever their names."""
    view = common.docs_view(docs, id_col, text_col)

    def batches(parts):
        for part in parts:
            texts = [x or "" for x in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sketches(texts, levels, bins), pa.string())], names=["doc_id", "fingerprint"])

    return view.mapInArrow(batches, common.with_id(view, "fingerprint string"))


FIELDS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_next(docs: DataFrame, levels: tuple = LEVELS, bins: int = BINS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next row is that of the next greater (doc_id, hash of the text, text), nulls first and null texts as empty; after the
    last comes the first. A row that is alone is its own next. Repeated rows give a row each and are each other's next; an
    empty table gives none; other columns are ignored.

    The order is had without one big sort: ids are cut into ranges at approximate quantiles, each range is sorted where
    it lies, and the first row of each range is sent to the range before it too. A range goes to one task, which keeps
    two texts and a batch; an id with more rows than a range holds, null too, is cut further by the hash. Texts are shuffled once.
    """
    spark = docs.sparkSession
    view = common.docs_view(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = _ranged(view, parts * RANGES_A_PART)
    nulls = F.max(F.col("doc_id").isNull())
    ends = ranged.groupBy("range").agg(F.when(~nulls, F.min("doc_id")).alias("first")).orderBy("range").collect()  # a row a range
    if not ends:
        return view.mapInArrow(lambda parts: iter(()), common.with_id(view, FIELDS))
    schema = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("first", view.schema["doc_id"].dataType), T.StructField("before", T.IntegerType())])
    table = spark.createDataFrame([(e["range"], e["first"], ends[k - 1]["range"]) for k, e in enumerate(ends)], schema)  # RANGES_A_PART rows a part at most
    digest = F.xxhash64("text")
    firsts = ranged.join(F.broadcast(table), (F.col("range") == F.col("at")) & F.col("doc_id").eqNullSafe(F.col("first")))
    guests = firsts.groupBy("before", "doc_id").agg(F.min_by("text", F.struct(digest, "text")).alias("text"))
    sent = ranged.select("doc_id", "text", "range", F.lit(False).alias("guest")).union(guests.select("doc_id", "text", "before", F.lit(True)))
    sent = sent.repartition(parts, "range").sortWithinPartitions("range", "guest", "doc_id", digest, "text")

    def batches(found: Iterator[pa.RecordBatch]):
        waiting, chars = [], 0
        for row, following in _with_next(found):
            waiting.append((*row, following))
            chars += len(row[1]) + len(following)
            if chars >= BATCH_CHARS:
                yield _compared(waiting, levels, bins, id_type)
                waiting, chars = [], 0
        if waiting:
            yield _compared(waiting, levels, bins, id_type)

    id_type = to_arrow_type(view.schema["doc_id"].dataType)
    return sent.select("doc_id", "text", "range", "guest").mapInArrow(batches, common.with_id(view, FIELDS))


def _ranged(view: DataFrame, n: int) -> DataFrame:
    """``view`` with the number, 0 to ``n`` - 1, of the ``range`` that a row is in.

    Cuts come from a bounded sample of ids: they even out the ranges and decide nothing else. An id that is several cuts is
    spread over as many ranges by the hash of its texts. The cuts are one row of two arrays, searched in two short steps.
    """
    ids = view.select("doc_id")
    total = ids.count()
    sample = ids.sample(min(1.0, IDS_A_RANGE * n / total), 11) if total else ids
    seen = sorted((r[0] for r in sample.limit(2 * IDS_A_RANGE * n).collect()), key=lambda x: (x is not None, x))
    cuts = [seen[len(seen) * k // n] for k in range(1, n)] if seen else []
    known = [x for x in cuts if x is not None]
    several = {x for x, y in zip(known, known[1:]) if x == y}
    cuts, known = [None] * (len(cuts) - len(known)), [x for k, x in enumerate(known) if x in several or k == 0 or x != known[k - 1]]
    if not cuts and not known:
        return view.withColumn("range", F.lit(0))
    width = max(1, int(len(known) ** 0.5))
    rows = [known[k : k + width] for k in range(0, len(known), width)]
    kind = T.ArrayType(view.schema["doc_id"].dataType)
    schema = T.StructType([T.StructField("_heads", kind), T.StructField("_rows", T.ArrayType(kind))])
    table = view.sparkSession.createDataFrame([([r[0] for r in rows], rows)], schema)
    upto = lambda values: F.size(F.filter(values, lambda x: x <= F.col("doc_id")))
    found = common.let(F.greatest(upto(F.col("_heads")) - 1, F.lit(0)), lambda k: k * width + upto(F.get("_rows", k)))
    place = F.lit(len(cuts)) + (found if known else 0)
    share = F.xxhash64("text") / F.lit(2.0**64) + 0.5
    spread = lambda last, times: last - F.least(F.floor((1 - share) * times).cast("int"), times - 1)
    if several:
        times = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for y in several for x in (y, known.count(y)))), F.col("doc_id")), F.lit(1))
        place = F.when(F.col("doc_id").isin(*several), spread(place, times)).otherwise(place)
    of_null = spread(F.lit(len(cuts)), F.lit(len(cuts) + 1)) if cuts else F.lit(0)
    found = view.crossJoin(F.broadcast(table))  # one row
    return found.select(*view.columns, F.when(F.col("doc_id").isNull(), of_null).otherwise(place).cast("int").alias("range"))


def _with_next(found: Iterator[pa.RecordBatch]):
    """((id, text), text of the next row) of each own row; a range's last row is followed by its first guest."""
    last = None
    for part in found:
        for row in zip(*(c.to_pylist() for c in part.columns)):
            if last is not None:
                yield last[:2], row[1]
            last = None if row[3] else row


def _compared(rows: list, levels: tuple, bins: int, id_type: pa.DataType) -> pa.RecordBatch:
    ids, texts, following = zip(*rows)
    edited = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for t, n in zip(texts, following)]
    follows = [k + 1 < len(texts) and n is texts[k + 1] for k, n in enumerate(following)]
    own, changed = sketches(list(texts), levels, bins), sketches(edited, levels, bins)
    others = iter(sketches([n for n, f in zip(following, follows) if not f], levels, bins))
    after = [own[k + 1] if f else next(others) for k, f in enumerate(follows)]
    columns = (
        pa.array(ids, id_type),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array(own, pa.string()),
        pa.array(changed, pa.string()),
        pa.array(list(map(likeness, own, changed)), pa.float64()),
        pa.array(list(map(likeness, own, after)), pa.float64()),
    )
    return pa.RecordBatch.from_arrays(list(columns), names=["doc_id", *(f.split()[0] for f in FIELDS.split(", "))])


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(common.table(spark, sf_dir, "documents"))
