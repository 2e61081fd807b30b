"""Fingerprints and components against brute force."""

import random

import pytest
import xxhash

from ledgerline.llm import components, simhash


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words, now = [], ""
    for c in lowered + " ":
        if c in "\x20\x09\x0a\x0b\x0c\x0d":
            if now:
                words.append(now)
            now = ""
        else:
            now += c
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_components(pairs):
    """pairs: (id, value); union of all within two bits."""
    root = {i: i for i, _ in pairs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(pairs):
        for j, b in pairs[:k]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in pairs}


def test_fingerprint():
    cases = ["", " \n", "One", "one TWO", "one two three", "A b c d\x0be f g ÀÉ", "x y z " * 50]
    assert [simhash.fingerprint(t) % (1 << 64) for t in cases] == [slow_fingerprint(t) for t in cases]


def test_links_connect_all_within_two_bits(spark):
    rnd = random.Random(5)
    values = [0, (1 << 64) - 1]
    for _ in range(40):
        v = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 6)):
            values.append(v)
            v ^= 1 << rnd.randrange(64)
            if rnd.random() < 0.5:
                v ^= 1 << rnd.randrange(64)
    rnd.shuffle(values)
    pairs = list(enumerate(values, 1))
    expected = slow_components(pairs)
    least = {}
    for i, v in pairs:
        least.setdefault(v, i)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    fps = spark.createDataFrame([(signed(v),) for v in least], "fp long")
    roots = {r.node: r.root for r in components.connected_components(simhash.links(fps), "a", "b").collect()}
    groups = {}
    for i, v in pairs:
        groups.setdefault(roots.get(signed(v), signed(v)), []).append(i)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(i for i in expected if expected[i] == r) for r in set(expected.values()))


def test_long_chain_and_no_edges(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 100), (200, 201)], "a long, b long")
    found = {r.node: r.root for r in components.connected_components(chain, "a", "b").collect()}
    assert found == {k: 0 for k in range(61)} | {200: 200, 201: 200}
    assert components.connected_components(chain.where("false"), "a", "b").count() == 0


@pytest.fixture(scope="module")
def rows():
    base = "the quick brown fox jumps over the lazy dog and runs far away from it all " * 20
    rows = [(5, base), (3, base), (9, base + " end"), (7, None), (8, ""), (2, "\n "), (11, "Some other text"), (11, "Some other text"), (12, "SOME other\ttext"), (20, "unlike all " * 40)]
    return rows + [(None, "lone null id text")]


def test_documents(spark, rows):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    known = [(i, t) for i, t in rows if i is not None]
    expected = slow_components([(i, slow_fingerprint(t or "")) for i, t in dict(known).items()])
    for r in found:
        if r.doc_id is not None:
            assert r.component_id == expected[r.doc_id]
        else:
            assert r.component_id is None
    assert {r.fingerprint for r in found if r.doc_id in (7, 8, 2)} == {"0" * 16}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted({r.component_id or 0 for r in found})
    assert simhash.near_duplicates(docs.where("false")).count() == 0


@pytest.mark.parametrize("rows_a_part, block_rows", [(simhash.ROWS_A_PART, simhash.BLOCK_ROWS), (1, 1), (2, 3)])
def test_one_row_stands_for_each_component(spark, monkeypatch, rows_a_part, block_rows):
    monkeypatch.setattr(simhash, "ROWS_A_PART", rows_a_part)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", block_rows)
    long, other = "one two three four five six seven eight", "nothing here is like the rest of it at all"
    rows = [(5, long, "x"), (5, other, "x"), (3, other, "x"), (None, "alone without an id here", "x"), (None, "alone without an id here", "x"), (None, long, "x"), (None, "another text of its own", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, more string").repartition(3)
    kept = sorted((r.doc_id or 0, r.text) for r in simhash.keep_one(docs).collect())
    assert kept == [(0, "alone without an id here"), (0, "another text of its own"), (3, other), (5, long)]
    for order in (rows, rows[::-1]):
        found = simhash.keep_one(spark.createDataFrame(order, "doc_id long, text string, more string").coalesce(1)).collect()
        assert sorted((r.doc_id or 0, r.text) for r in found) == kept


@pytest.mark.parametrize("block_rows", [simhash.BLOCK_ROWS, 2])
def test_kept_rows_have_their_own_columns(spark, monkeypatch, block_rows):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", block_rows)
    names = ["doc_id", "text", "row", "key", "file", "at", "part", "block", "rest", "_metadata", "fp", "root", "text_hash", "_row", "_text"]
    texts = ["one two three four five six", "one two three four five six", None, "", "quite unlike any other text of these"] * 40
    rows = [(k % 150, t, *(f"{n} {k}" for n in names[2:])) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, ", ".join(f"{n} {'long' if n == 'doc_id' else 'string'}" for n in names))
    found = simhash.keep_one(docs.repartition(5)).collect()
    assert found and found[0].asDict().keys() == set(names)
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, simhash.keep_one(docs.repartition(2)).collect()), key=str)
    assert len(found) == 3 and {tuple(r) for r in found} <= set(rows) and {r.doc_id for r in found} == {0, 2, 4}
    assert simhash.keep_one(docs.where("false")).count() == 0


def _kept_by_rule(docs):
    """Of the rows of ``docs`` the one of each component, by the groups that near_duplicates tells."""
    component = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    return sorted(r.doc_id for r in docs.collect() if component[r.doc_id] == r.doc_id)


def test_rows_of_files_are_told_by_place_and_texts_are_not_shuffled(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs.repartition(7).write.option("parquet.block.size", 100_000).parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    kept = simhash.keep_one(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert sorted(r.doc_id for r in kept.collect()) == _kept_by_rule(docs)
    whole = {r.doc_id: r for r in docs.collect()}
    assert all(r == whole[r.doc_id] for r in kept.collect())
    some = docs.where("doc_id % 3 > 0").select("text", "doc_id")
    assert sorted(r.doc_id for r in simhash.keep_one(some).collect()) == _kept_by_rule(some)


def test_several_rows_of_one_place(spark, tmp_path):
    words = "one two three four five six seven eight"
    spark.createDataFrame([(1, words), (2, "nothing here is like the rest of it")], "k long, text string").coalesce(1).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs")).selectExpr("explode(array(10 * k, 10 * k + 1)) as doc_id", "text")
    twice = docs.unionByName(docs)
    joined = docs.join(spark.createDataFrame([(10,), (11,), (11,), (21,)], "doc_id long"), "doc_id")
    for frame, expected in ((docs, [10, 20]), (twice, [10, 20]), (joined, [10, 21])):
        assert sorted(r.doc_id for r in simhash.keep_one(frame).collect()) == expected
