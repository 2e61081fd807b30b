"""Quality rules as a short-circuit cascade, in SQL functions alone.

A rule is a condition that rejects. What each costs and how many rows it rejects is measured on a sample of the rows that
reach the cascade, by jobs that ask it over and over until its own time shows; the cascade then asks the rules in the order of rejections per cost, and a row that one rejects is asked no further. The verdict does not
depend on the order, only the work does.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import let

SAMPLE_ROWS = 2000
SYMBOLS = "[#*$%&|<>]"
BASE = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"
TIMES = (1, 4, 32, 512)  # how often a job may ask a rule of each row of the sample
STANDS_OUT = 2.0


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: str
    """SQL over the columns of the measured table; null counts as false."""


#: Over ``measures``. Thresholds leave prose in any language alone: they catch symbol noise, pages that are one line over
#: and over, tokens of no plausible length, and lists of numbers or marks.
RULES = (
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("same_lines", "10 * n_dup_lines > 9 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 25 * n_words"),
    Rule("no_letters", f"2 * regexp_count(text, '(?<![^\\\\x20\\\\x09-\\\\x0D])[^\\\\x20\\\\x09-\\\\x0DA-Za-z\\\\x80-\\\\x{{10FFFF}}]+(?![^\\\\x20\\\\x09-\\\\x0D])') > n_words"),
    Rule("bullets", "10 * regexp_count(text, '(?m)^[\\\\x20\\\\t]*[-*•]') > 9 * n_lines"),
    Rule("cut_lines", "2 * regexp_count(text, '(?m)(?:[.]{3}|…)[\\\\x20\\\\t]*$') > n_lines"),
)


def _repeated(words: Column) -> Column:
    """How many of ``words`` stand in a window of three that the text has twice or more."""

    def of(windows: Column) -> Column:
        def among(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k - 1)["x"] == x["x"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["x"] == x["x"], F.lit(False))
            starts = F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))
            covered = lambda p: F.aggregate(F.transform(p, lambda v, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - v, F.lit(3)))), F.lit(0), lambda a, v: a + v)
            return let(starts, covered)

        found = let(F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i")))), among)
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(found)

    def windows(w: Column) -> Column:
        return F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2)))

    return F.when(F.size(words) < 3, 0).otherwise(let(words, lambda w: let(windows(w), of)))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text ('' for null), n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of each row."""
    view = common.docs_view(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = F.array_remove(F.split("text", common.SPACE), "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(common.WORD))
    view = view.select("doc_id", "text", words.alias("_words"), lines.alias("_lines"))
    long = lambda c: c.cast("long")
    return view.select(
        "doc_id",
        "text",
        long(F.size("_words")).alias("n_words"),
        long(F.char_length(F.array_join("_words", ""))).alias("word_chars"),
        long(F.regexp_count("text", F.lit(SYMBOLS))).alias("n_symbols"),
        long(F.size("_lines")).alias("n_lines"),
        long(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        long(_repeated(F.col("_words"))).alias("n_repeat_words"),
    )


def ordered(rows: DataFrame, measure, rules: tuple[Rule, ...], sample_rows: int = SAMPLE_ROWS, seed: int = 7, asked: str = "true") -> list[tuple[Rule, float, float]]:
    """(rule, seconds a row, share rejected), best first by rejections per second on a sample of about ``sample_rows``.

    ``measure`` turns rows into what the rules speak of; of the sample only rows that reach the cascade (``asked``) count. The sample
    only orders the rules; with no rows they stay as given. A job asks a rule of the whole sample as many times over as it
    takes for the rule's own time to stand out from that of a job, as long again, that asks nothing.
    """
    total = rows.count()
    if not total or len(rules) < 2:
        return [(r, 0.0, 0.0) for r in rules]
    # Drawn and measured by all tasks; then in one partition, as a job's time is to be that of its rows.
    sample = measure(rows.sample(min(1.0, sample_rows / total), seed)).where(asked).repartition(1).persist()
    try:
        n = sample.count()
        if not n:
            return [(r, 0.0, 0.0) for r in rules]

        def run(condition: str, times: int) -> tuple[float, float]:
            asked_again = sample.select("*", F.explode(F.sequence(F.lit(1), F.lit(times))).alias("_time"))
            began = time.perf_counter()
            hits = asked_again.agg(F.count_if(F.coalesce(F.expr(condition), F.lit(False)))).first()[0]
            return time.perf_counter() - began, hits / (n * times)

        run("true", 1)
        idle = {k: min(run("_time < 0", k)[0] for _ in range(2)) for k in TIMES}
        found = []
        for rule in rules:
            for times in TIMES:
                seconds, share = run(rule.rejects, times)
                if seconds - idle[times] > STANDS_OUT * idle[1]:
                    break
            seconds = min(seconds, run(rule.rejects, times)[0])
            found.append((rule, max(seconds - idle[times], 0.1 * idle[1]) / (n * times), share))
    finally:
        sample.unpersist()
    return sorted(found, key=lambda x: -x[2] / x[1])


def passes(rules: list[Rule]) -> Column:
    """True for rows that none of ``rules`` rejects; asks them in order and stops at the first that does."""
    verdict = None
    for rule in rules:
        condition = F.coalesce(F.expr(rule.rejects), F.lit(False))
        verdict = F.when(condition, False) if verdict is None else verdict.when(condition, False)
    return F.lit(True) if verdict is None else verdict.otherwise(True)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    Null and empty texts have no words and so fail the base. Repeated rows give a row each; an empty table gives none;
    other columns are ignored. No shuffle: a text and its words stay in their row.
    """
    found = measures(docs, id_col, text_col)
    order = [rule for rule, _, _ in ordered(common.docs_view(docs, id_col, text_col), measures, rules, sample_rows, asked=f"not ({BASE})")]
    kept = F.when(F.col("base_failed"), False).otherwise(passes(order))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return found.withColumn("base_failed", F.expr(BASE)).select(*columns, kept.alias("kept"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "documents"))


OP1_SQL = """
with texts as (select row_number() over () as row_id, doc_id, coalesce(text, '') as text from documents),
split as (
  select *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from texts),
windows as (
  select row_id, i, count(*) over (partition by row_id, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) as times
  from (select row_id, words, unnest(range(1, len(words) - 1)) as i from split where len(words) > 2)),
repeated as (
  select row_id, count(distinct i + k) as n_repeat_words
  from windows, (values (0), (1), (2)) as t(k) where times > 1 group by row_id),
measured as (
  select s.doc_id, s.text, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, len(lines)::bigint as n_lines,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    len(list_filter(words, lambda x: not regexp_matches(x, '[A-Za-z\\x{80}-\\x{10FFFF}]'))) as letterless,
    len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^[ \\t]*[-*•]'))) as bullets,
    len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '(\\.\\.\\.|…)[ \\t]*$'))) as cut_lines
  from split s left join repeated using (row_id)),
failed as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or 10 * n_symbols > n_words or 10 * n_dup_lines > 9 * n_lines or word_chars < 2 * n_words or word_chars > 25 * n_words
    or 2 * letterless > n_words or 10 * bullets > 9 * n_lines or 2 * cut_lines > n_lines) as kept
from failed
"""
