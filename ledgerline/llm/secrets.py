"""Secret scans in SQL functions alone.

Three patterns give the base spans. The method adds tokens that look random: over each long run of token characters a
window of WINDOW characters slides, and its Shannon entropy is kept by counts: a character that enters or leaves changes
its own count and the sum of n * log2(n), by a difference read from a table, so no window is counted anew. Runs end at base
spans; what is left of them is looked at too. A token is a secret if some window's entropy reaches the threshold of its character class and the allow-list does not clear it. Entropies are
compared as whole numbers (millionths), so that no rounding decides.

Positions are code points. SQL has no function that gives the places of all matches; they are had from the lengths of
the matches and of the text between them, summed up in blocks so that many matches stay affordable.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import let

ASSIGN = "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{32,}"  # whole runs, so the same as the runs of any length that are long enough
TOKEN = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
VALUE_CHARS, ACCESS_CHARS = 8, 16
WINDOW = 20
#: Least entropy in bits of some window, by class: hexadecimal digits in one case, letters and digits, more symbols.
THRESHOLDS = {"hex": 2.9, "alnum": 3.6, "symbol": 3.9}
#: What looks random and is no secret: tokens of one kind of character, UUIDs, words joined by separators, placeholders.
ALLOW = (
    "[0-9+/_=-]+",
    "[A-Za-z+/_=-]+",
    "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    "(?:[A-Za-z]+|[0-9]{1,4})(?:[/_=+-]+(?:[A-Za-z]+|[0-9]{1,4}))*",
    ".*(?i:example|placeholder|dummy|xxxxx|00000|12345).*",
)
KINDS = ("assign", "access", "hex", "entropy")
SCALE = 1_000_000
#: Token characters lie between + and z; a count under 32 takes five bits.
FIRST_CODE, LAST_CODE, COUNT_BITS, COUNTS_A_LONG = ord("+"), ord("z"), 5, 12
CHUNK = 2048
SPAN = "array<struct<start:long,rank:int,end:long,kind:string>>"


def running(values: Column, both=lambda a, b: a + b) -> Column:
    """Sums of each value and those before it, or what else ``both`` makes of two values that are 0 or more. Work grows as the length to the power 1.5."""

    def blocked(a: Column) -> Column:
        def of(blocks: Column) -> Column:
            total = lambda x: F.aggregate(x, F.lit(0).cast("long"), both)
            within = lambda x, h: F.transform(x, lambda v, j: both(h, total(F.slice(x, 1, j + 1))))
            return let(F.transform(blocks, total), lambda s: F.flatten(F.zip_with(blocks, F.transform(s, lambda v, k: total(F.slice(s, 1, k))), within)))

        width = F.ceil(F.sqrt(F.size(a))).cast("int")
        return let(width, lambda w: let(F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / w).cast("int")), lambda k: F.slice(a, k * w + 1, w)), of))

    return let(values, lambda a: F.when(F.size(a) > 0, blocked(a)).otherwise(a))


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """Matches of ``pattern``, leftmost and not overlapping: array of (start, end, value), end exclusive, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    long = lambda c: F.char_length(c).cast("long")

    def placed(m: Column) -> Column:
        ends = running(F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(m)), m, lambda g, f: long(g) + long(f)))
        spans = F.zip_with(m, ends, lambda f, e: F.struct((e - long(f)).alias("start"), e.alias("end")))
        return F.zip_with(spans, values, lambda s, v: F.struct(s["start"].alias("start"), s["end"].alias("end"), v.alias("value")))

    return let(found, placed)


def _spans(text: Column, gate: str, pattern: str, kind: str, keep, group: int = 0) -> Column:
    """Spans of one kind, looked for only where the cheap ``gate`` pattern occurs."""
    rank = KINDS.index(kind)
    chosen = F.filter(located(text, pattern, group), keep)
    shaped = F.transform(chosen, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))
    return F.when(text.rlike(gate), shaped.cast(SPAN)).otherwise(F.array().cast(SPAN))


def lowest(token: Column, window: int = WINDOW) -> Column:
    """The least sum of n * log2(n) over the counts of any window of ``token``, in millionths; its entropy is greatest there.

    The counts of all characters a token can have are the state, packed in longs of COUNTS_A_LONG: one step takes one
    from the character that leaves and adds one to the one that enters. ``window`` is under 32.
    """
    table = F.array(*(F.lit(round(SCALE * n * log2(n)) if n else 0).cast("long") for n in range(window + 2)))
    units = F.array(*(F.lit(1 << COUNT_BITS * k).cast("long") for k in range(COUNTS_A_LONG)))
    longs = -(-(LAST_CODE - FIRST_CODE + 1) // COUNTS_A_LONG)

    def slot(char: Column) -> Column:
        """The long that counts ``char``, where its count begins in it, and one of it."""
        code = F.ascii(char) - FIRST_CODE
        at = code % COUNTS_A_LONG
        return F.struct(F.floor(code / COUNTS_A_LONG).cast("int").alias("long"), (at * COUNT_BITS).alias("shift"), F.get(units, at).alias("one"))

    def slide(slots: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            count = lambda c: F.call_function("shiftright", F.get(acc["counts"], c["long"]), c["shift"]).bitwiseAND(F.lit((1 << COUNT_BITS) - 1)).cast("int")
            add = lambda v, j, c: F.when(j == c["long"], c["one"]).otherwise(0)

            def enter(come: Column) -> Column:
                m = count(come)
                return F.struct(
                    (acc["sum"] + F.get(table, m + 1) - F.get(table, m)).alias("sum"),
                    F.transform(acc["counts"], lambda v, j: v + add(v, j, come)).alias("counts"),
                )

            def move(come: Column, gone: Column) -> Column:
                n, m = count(gone), count(come) - F.when(come == gone, 1).otherwise(0)
                return F.struct(
                    (acc["sum"] + F.get(table, n - 1) - F.get(table, n) + F.get(table, m + 1) - F.get(table, m)).alias("sum"),
                    F.transform(acc["counts"], lambda v, j: v + add(v, j, come) - add(v, j, gone)).alias("counts"),
                )

            now = F.when(i > window, let(F.get(slots, i - window - 1), lambda gone: move(F.get(slots, i - 1), gone))).otherwise(enter(F.get(slots, i - 1)))
            least = lambda s: F.when(i >= window, F.least(acc["least"], s["sum"])).otherwise(acc["least"])
            return let(now, lambda s: F.struct(s["sum"].alias("sum"), least(s).alias("least"), s["counts"].alias("counts")))

        zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(1 << 60).cast("long").alias("least"), F.array(*[F.lit(0).cast("long")] * longs).alias("counts"))
        return F.aggregate(F.sequence(F.lit(1), F.size(slots)), zero, step)["least"]

    return let(F.transform(F.split(token, "(?!^)(?!$)", -1), slot), slide)


def looks_random(token: Column, window: int = WINDOW) -> Column:
    most = {k: round(SCALE * window * (log2(window) - v)) for k, v in THRESHOLDS.items()}
    limit = F.when(token.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), most["hex"]).when(token.rlike("^[A-Za-z0-9]+$"), most["alnum"]).otherwise(most["symbol"])
    cleared = token.rlike("^(?:" + "|".join(ALLOW) + ")$")
    return F.when(cleared, False).otherwise(lowest(token, window) <= limit)


def _cut(text: Column, start: Column, end: Column) -> Column:
    """``text`` from ``start`` to ``end``, where ``text`` is an array of pieces of CHUNK characters: no call reads all of a long text."""
    first, last = F.floor(start / CHUNK).cast("int"), F.floor(end / CHUNK).cast("int")
    of = lambda k, begin, n: F.coalesce(F.substring(F.get(text, k), (begin + 1).cast("int"), n.cast("int")), F.lit(""))
    between = F.array_join(F.slice(text, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    apart = F.concat(of(first, start % CHUNK, F.lit(CHUNK)), between, of(last, F.lit(0), end % CHUNK))
    return F.when(end <= start, "").when(first == last, of(first, start % CHUNK, end - start)).otherwise(apart)


def replaced(text: Column, spans: Column, filler) -> Column:
    """``text`` with the characters in any of the sorted ``spans`` gone and ``filler(span, reach)`` in the place of each; ``reach`` is where those before it end."""

    def cut(pieces: Column, reach: Column) -> Column:
        """Before each span the text since the end of all before it; a span that begins inside another adds none."""
        before = lambda k: F.coalesce(F.get(reach, k - 1), F.lit(0))
        parts = F.transform(spans, lambda s, k: F.concat(_cut(pieces, before(k), s["start"]), filler(s, before(k))))
        return F.concat(F.array_join(parts, ""), _cut(pieces, F.array_max(reach), F.char_length(text).cast("long")))

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    ends = running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    return F.when(F.size(spans) > 0, let(pieces, lambda p: let(ends, lambda r: cut(p, r)))).otherwise(text)


def with_spans(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``_assign``, ``_access``, ``_hex`` and ``_entropy``, arrays of spans; a null text has none."""
    text = F.coalesce(text, F.lit(""))
    long = lambda s: s["end"] - s["start"]
    found = docs.withColumns(
        {
            "_assign": _spans(text, "(?i:passw|secret|token|api_?key)", ASSIGN, "assign", lambda s: F.char_length(s["value"]) >= VALUE_CHARS, 2),
            "_access": _spans(text, "AKIA", ACCESS, "access", lambda s: long(s) >= ACCESS_CHARS),
            "_hex": _spans(text, HEX, HEX, "hex", lambda s: F.lit(True)),
        }
    )
    # Blanks in the place of base spans: what is left of a run beside one is looked at like any other, at the same places.
    blanks = lambda s, reach: F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(s["start"], reach), F.lit(0)).cast("int"))
    rest = let(F.array_sort(F.concat("_assign", "_access", "_hex")), lambda base: replaced(text, base, blanks))
    return found.withColumn("_entropy", let(rest, lambda t: _spans(t, TOKEN, TOKEN, "entropy", lambda s: looks_random(s["value"]))))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy.

    Null and empty texts have no spans: counts of 0, the digest of nothing, an empty list. Repeated rows give a row each;
    an empty table gives none; other columns are ignored. No shuffle, and nothing leaves the row.
    """
    found = with_spans(common.docs_view(docs, id_col, text_col), F.col("text"))
    return found.select(
        "doc_id",
        *(F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(_listed(F.concat("_assign", "_access", "_hex")), 256).alias("base_sha256"),
        _listed(F.concat("_assign", "_access", "_hex", "_entropy")).alias("spans"),
        F.size("_entropy").cast("long").alias("n_entropy"),
    )


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs``, all columns and rows, with each secret of ``text_col`` replaced by ``mark``; spans that overlap by one mark.

    Null texts stay null, empty ones empty; an empty table gives none; no name of a column can clash.
    """
    text = F.col("row")[text_col]
    found = with_spans(docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row")), text)
    marks = lambda s, reach: F.when(s["start"] >= reach, mark).otherwise("")
    cleaned = let(F.array_sort(F.concat("_assign", "_access", "_hex", "_entropy")), lambda s: replaced(text, s, marks))
    return found.select(*(cleaned.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"))


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def _places(kind: str, rank: int, pattern: str, keep: str, group: int = 0) -> str:
    """Spans of ``pattern`` in SQL: a match begins where the texts between matches and the matches before it end."""
    return f"""select row_id, {rank} as rank, '{kind}' as kind, start, start + length(m) as stop, m, g from (
    select row_id, m, g, sum(length(gap) + length(m)) over (partition by row_id order by k) - length(m) as start from (
      select row_id, unnest(ms) as m, unnest(gs) as g, unnest(gaps[1:len(ms)]) as gap, generate_subscripts(ms, 1) as k from (
        select row_id, regexp_extract_all(body, '{pattern}') as ms, regexp_extract_all(body, '{pattern}', {group}) as gs, regexp_split_to_array(body, '{pattern}') as gaps from {{source}})))
    where {keep}"""


_ASSIGN_SQL = "(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + ")[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
_TABLE = [round(SCALE * n * log2(n)) if n else 0 for n in range(WINDOW + 1)]
_MOST = {k: round(SCALE * WINDOW * (log2(WINDOW) - v)) for k, v in THRESHOLDS.items()}

OP5_SQL = f"""
with texts as (select row_number() over () as row_id, doc_id, coalesce(text, '') as body from documents),
base as materialized (
  {_places("assign", 0, _ASSIGN_SQL, f"length(g) >= {VALUE_CHARS}", 2).format(source="texts")}
  union all {_places("access", 1, ACCESS, f"length(m) >= {ACCESS_CHARS}").format(source="texts")}
  union all {_places("hex", 2, "[0-9a-f]+", "length(m) >= 32").format(source="texts")}),
covered as (select row_id, list({{'a': start, 'b': stop}}) as spans from base group by row_id),
masked as (
  select row_id, list_aggregate(list_transform(string_split(body, ''), lambda c, i: case when len(list_filter(spans, lambda s: s.a < i and i <= s.b)) > 0 then ' ' else c end), 'string_agg', '') as body
  from texts join covered using (row_id) union all select row_id, body from texts anti join covered using (row_id)),
tokens as (
  {_places("entropy", 3, "[A-Za-z0-9+/_=-]+", "length(m) >= 20").format(source="masked")}),
open as (select * from tokens where not regexp_matches(m, '^(?:{"|".join(ALLOW)})$')),
windows as (select row_id, start, unnest(range(1, length(m) - {WINDOW - 2})) as i, m from open),
sums as (
  select row_id, start, list_sum(list_transform(map_values(list_histogram(string_split(substr(m, i, {WINDOW}), ''))), lambda n: ({_TABLE}::bigint[])[n::bigint + 1])) as s from windows),
random as (
  select o.row_id, rank, kind, o.start, stop from open o join (select row_id, start, min(s) as least from sums group by all) l on o.row_id = l.row_id and o.start = l.start
  where least <= case when regexp_matches(m, '^([0-9a-f]+|[0-9A-F]+)$') then {_MOST["hex"]} when regexp_matches(m, '^[A-Za-z0-9]+$') then {_MOST["alnum"]} else {_MOST["symbol"]} end),
found as (
  select row_id, rank, kind || ':' || start || ':' || stop as shown, start, stop from base union all select row_id, rank, kind || ':' || start || ':' || stop, start, stop from random),
listed as (
  select row_id, coalesce(string_agg(shown, ',' order by start, rank, stop) filter (rank < 3), '') as base_list, string_agg(shown, ',' order by start, rank, stop) as spans,
    {", ".join(f"count(*) filter (rank = {k}) as n_{kind}" for k, kind in enumerate(KINDS))} from found group by row_id)
select doc_id, {", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in KINDS[:3])}, sha256(coalesce(base_list, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_entropy, 0) as n_entropy
from texts left join listed using (row_id)
"""
