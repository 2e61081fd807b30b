"""The keyword automaton against CASE, trigram postings against a scan."""

import random
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import keywords
from ledgerline.operators import lookup, postings


def plain_first(words, text):
    return next((k for k, w in enumerate(words) if w and w in text), None)


@pytest.mark.parametrize("seed", range(4))
def test_first_word_of_random_texts(seed):
    draw = random.Random(seed)
    word = lambda most: "".join(draw.choice("abé ") for _ in range(draw.randint(0, most)))
    for _ in range(150):
        words = [word(5) for _ in range(draw.randint(0, 12))]
        automaton = keywords.Automaton(words)
        for text in ("", *(word(30) for _ in range(5))):
            assert automaton.first(text) == plain_first(words, text), (words, text)


def test_ten_thousand_words_equal_the_case(spark, monkeypatch):
    draw = random.Random(1)
    words = {"".join(draw.choice("abcdef") for _ in range(draw.randint(4, 7))): f"v{k}" for k in range(10_000)}
    few = dict(list(words.items())[:60])
    texts = [(k, "".join(draw.choice("abcdefX ") for _ in range(draw.randint(0, 60)))) for k in range(300)] + [(300, None)]
    df = spark.createDataFrame(texts, "k long, text string")
    rows = lambda ws: {r.k: r.v for r in df.select("k", lookup.longest_keyword(F.col("text"), ws, {"x a": "first"}).alias("v")).collect()}
    by_automaton = rows(few)
    monkeypatch.setattr(lookup, "CASE_WORDS", 1 << 30)
    assert rows(few) == by_automaton
    monkeypatch.undo()
    order = [("x a", "first"), *sorted(words.items(), key=lambda w: -len(w[0]))]
    plain = {k: None if t is None else next((v for w, v in order if w in t.lower()), None) for k, t in texts}
    assert rows(words) == plain


def test_time_does_not_grow_with_the_words():
    draw = random.Random(2)
    words = ["".join(draw.choice("bcdefghijk") for _ in range(8)) for _ in range(20_000)]
    text = "".join(draw.choice("abcdefghijk") for _ in range(200_000))

    def seconds(n):
        automaton = keywords.Automaton(words[:n])
        automaton.first("a")
        began = time.process_time()
        automaton.first(text)
        return time.process_time() - began

    assert min(seconds(20_000) for _ in range(3)) < 6 * min(seconds(100) for _ in range(3))


def test_too_many_words_are_refused(monkeypatch):
    monkeypatch.setattr(keywords, "MOST_CHARS", 10)
    with pytest.raises(ValueError, match="more than 10"):
        keywords.Automaton(["abcdef", "ghijkl"])


def test_postings_find_what_a_scan_finds(spark, tmp_path, monkeypatch):
    draw = random.Random(3)
    rows = [(k, None if k % 50 == 0 else "".join(draw.choice("abc d") for _ in range(draw.randint(0, 25)))) for k in range(600)]
    df = spark.createDataFrame(rows, "k long, blob string")
    for part in range(3):
        some = df.where(F.col("k") % 3 == part)
        some.write.mode("append").parquet(str(tmp_path / "registry"))
        postings.add(some, "k", "blob", str(tmp_path / "grams"))
    registry = spark.read.parquet(str(tmp_path / "registry"))
    for text in ("", "a", "AB", "abc", "c d", "aaaa", "abcabc", "b ca", rows[7][1] or "abc", "xyz"):
        plain = {k for k, b in rows if b is not None and text.lower() in b}
        for few in (10_000, 2):
            monkeypatch.setattr(postings, "FEW", few)
            assert {r.k for r in postings.searched(registry, "k", "blob", str(tmp_path / "grams"), text).collect()} == plain, (text, few)


def test_a_search_reads_few_buckets(spark, tmp_path):
    df = spark.range(2000).select(F.col("id").alias("k"), F.concat(F.lit("row "), F.col("id").cast("string")).alias("blob"))
    postings.add(df, "k", "blob", str(tmp_path / "grams"))
    found = postings.candidates(spark, str(tmp_path / "grams"), "w 1234")
    assert {r.key for r in found.collect()} == {1234}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket", "bucket") or "bucket#" in plan.split("PartitionFilters")[1][:200]
    assert "In(gram" in plan


def test_postings_are_packed_by_block_and_no_lines_are_read(spark, tmp_path, monkeypatch):
    from ledgerline.plans.base import QUERIES, Tables

    df = spark.createDataFrame([(1, "abcabc"), (2, "xabc"), (3, "äbc\U0001f600d"), (None, "abc"), (4, None), (1, "abc")], "k long, blob string").coalesce(1)
    for block in (1 << 20, 1):  # one block, or one a batch
        monkeypatch.setattr(postings, "BLOCK", block)
        found = {r.gram: sorted(r["keys"]) for r in postings.postings(df, "k", "blob").collect()}
        assert found == {"abc": [1, 1, 2], "bca": [1], "cab": [1], "xab": [2], "äbc": [3], "bc\U0001f600": [3], "c\U0001f600d": [3]}
    read, plain = [], Tables.__getattr__
    monkeypatch.setattr(Tables, "__getattr__", lambda self, name: read.append(name) or plain(self, name))
    assert QUERIES["search_postings"](spark, "/root/testdata/sf0.001").count() > 0 and set(read) == {"orders"}
