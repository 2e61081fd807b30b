"""The Merkle manifest, repeated passages and the conversation trie against plain code, with the edges of each."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import common, merkle, ordered, repeats, trie

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree_of(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][k : k + fanout]) for k in range(0, len(levels[-1]), fanout)])
    return levels


def path_of(levels, at, fanout):
    """Siblings level by level, and the place in each run."""
    found = []
    for level in levels[:-1]:
        run = level[at // fanout * fanout :][:fanout]
        found.append((run[: at % fanout], run[at % fanout + 1 :]))
        at //= fanout
    return found


def plain_manifest(rows, fanout):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha(*(field(v) for v in (r[0], r[3], r[2], r[4], r[1])))
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append((r[0] is not None, r[0] or 0, leaf(r), r[0]))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree_of([x[2] for x in sorted(by[s])], fanout) for s in names}
    top = tree_of([trees[s][-1][0] for s in names], fanout)
    found = []
    for k, s in enumerate(names):
        for at, (_, _, node, doc_id) in enumerate(sorted(by[s])):
            steps = path_of(trees[s], at, fanout) + path_of(top, k, fanout)
            found.append((doc_id, node, trees[s][-1][0], top[-1][0], sha(*("".join(a + b) for a, b in steps))))
    return sorted(found, key=str)


def manifest(docs, **how):
    found = merkle.proofs(merkle.leaves(docs), **how)
    lefts, rights = F.col("lefts"), F.col("rights")
    rows = found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(lefts, rights), merkle.folded(F.col("leaf"), lefts, rights).alias("again")).collect()
    assert all(r.again == r.root for r in rows)
    return sorted((tuple(r)[:5] for r in rows), key=str)


@pytest.mark.parametrize(("fanout", "levels"), [(2, 1), (3, 2), (16, 3)])
def test_manifest_against_plain_trees(spark, fanout, levels):
    draw = random.Random(fanout)
    sources = [None, "", "a", "b", "ä", "z" * 40]
    rows = [(draw.choice([None, *range(40)]), draw.choice([None, "", "x y", "é\n"]), draw.choice([None, "en"]), draw.choice(sources + ["hot"] * 8), draw.choice([None, 3])) for _ in range(150)]
    rows += [(900, "alone", "en", "one row", 5)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"root": F.lit(1), "index": F.lit(2)})
    assert manifest(docs, fanout=fanout, levels=levels) == plain_manifest(rows, fanout)


def test_manifest_edges(spark):
    assert manifest(spark.createDataFrame([], DOCS)) == []
    (one,) = manifest(spark.createDataFrame([(7, None, None, None, None)], DOCS))
    assert one == (7, sha("1:7----"), sha("1:7----"), sha("1:7----"), sha())
    twice = manifest(spark.createDataFrame([(7, "t", "en", "s", 1)] * 2, DOCS))
    assert len(twice) == 2 and twice[0] == twice[1]
    long_text = "wörter " * 200_000
    assert manifest(spark.createDataFrame([(1, long_text, "en", "s", 1)], DOCS)) == plain_manifest([(1, long_text, "en", "s", 1)], 16)


def test_manifest_shows_every_change(spark):
    rows = [(k, f"text {k}", "en", f"s{k % 3}", k) for k in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    changed = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    found = merkle.proofs(merkle.leaves(docs, shown={"text": changed}), ("shown",), 4, 1)
    again = found.select("doc_id", (merkle.folded(F.col("shown"), F.col("lefts"), F.col("rights")) == F.col("root")).alias("same"))
    assert {r.doc_id for r in again.collect() if not r.same} == set(range(0, 60, 7))


def test_places_and_running_values(spark):
    rows = [(f"g{k % 3 if k % 5 else 0}", (k * 37) % 1000, k) for k in range(1000)]
    df = spark.createDataFrame(rows, "g string, o long, v long").repartition(7)
    expected, total, sums, xors = {}, Counter(r[0] for r in rows), Counter(), Counter()
    for g, _, v in sorted(rows):
        expected[v] = (sum(1 for _ in ()) if g not in sums else sums[(g, "n")], total[g])
        sums[(g, "n")] += 1
        sums[g] += v
        xors[g] ^= v
        expected[v] += (sums[g], xors[g])
    got = {r.v: (r["index"], r.total) for r in ordered.numbered(df, ["g"], ["o"]).collect()}
    run = {r.v: (r.s, r.x) for r in ordered.running(df, ["g"], ["o"], sums={"s": F.col("v")}, xors={"x": F.col("v")}).collect()}
    assert {v: got[v] + run[v] for v in got} == expected


def plain_repeats(texts, window):
    words = [t.encode().split() if t else [] for t in texts]
    times = Counter(tuple(w[k : k + window]) for w in words for k in range(len(w) - window + 1))
    found = []
    for w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if times[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        left = [x for x, g in zip(w, gone) if not g]
        found.append((len(w), len(w) - len(left), b" ".join(left).decode()))
    return found


def without(spark, texts, **how):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumns({"n_words": F.lit("x"), "place": F.lit(1)})
    return {r.doc_id: r for r in repeats.without_repeats(docs.repartition(5), **how).collect()}


@pytest.mark.parametrize(("window", "anchor", "block"), [(5, 2, 1 << 20), (7, 7, 1 << 20), (6, 3, 24), (4, 1, 50)])
def test_repeats_against_plain_windows(spark, monkeypatch, window, anchor, block):
    monkeypatch.setattr(repeats, "BLOCK", block)
    draw = random.Random(window)
    pool = [[draw.choice("abcdefghijklmnop") * draw.randint(1, 2) for _ in range(draw.randint(3, 30))] for _ in range(12)]
    texts = [None, "", " \n", "one two"]
    for _ in range(60):
        parts = [draw.choice(pool) if draw.random() < 0.4 else [draw.choice("abcdé" + chr(0xA0)) * draw.randint(1, 3) for _ in range(draw.randint(1, 12))] for _ in range(draw.randint(1, 5))]
        texts.append(draw.choice([" ", "\n\t", "  "]).join(w for p in parts for w in p))
    texts += [texts[10]] * 3 + ["a " * 50, "a b " * 40]
    found = without(spark, texts, window=window, anchor=anchor)
    assert [(found[k].n_words, found[k].n_removed, found[k].kept) for k in range(len(texts))] == plain_repeats(texts, window)
    for k, text in enumerate(texts):
        inside = {w for s in found[k].spans for w in range(s.start, s.end)}
        assert len(inside) == found[k].n_removed


def test_repeats_past_what_may_be_broadcast(spark, monkeypatch):
    monkeypatch.setattr(repeats, "FEW", 0)
    shared = " ".join(f"w{k}" for k in range(60))
    texts = [f"{shared} end", f"start {shared}", "nothing of it", None, f"own {' '.join(map(str, range(50)))}"]
    found = without(spark, texts)
    assert [(found[k].n_words, found[k].n_removed, found[k].kept) for k in range(5)] == plain_repeats(texts, 35)


def test_repeated_copies_are_one_path(spark):
    shared = " ".join(f"w{k}" for k in range(400))
    found = without(spark, [f"a b c {shared} d e", f"f {shared} g", f"{shared}"])
    assert [[(s.start, s.end) for s in found[k].spans][0][0] for k in range(3)] == [3, 1, 0]
    paths = [{s.path for s in found[k].spans} for k in range(3)]
    assert len(paths[0] & paths[1] & paths[2]) == 1 and all(len(found[k].spans) <= 8 for k in range(3))  # the middle is compacted to one path


def test_long_paths_need_no_more_steps_than_short_ones(spark):
    common.ensure_checkpoints(spark)
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))

    def steps(words):
        shared = " ".join(f"w{k}" for k in range(words))
        before = set(folder.glob("rdd-*"))
        spans = without(spark, [f"a b {shared} c", f"d {shared} e f", "none"])[0].spans
        assert {s.path for s in spans if 100 < s.start < words - 100} <= {spans[len(spans) // 2].path}
        return len(set(folder.glob("rdd-*")) - before)

    assert steps(4000) == steps(120)


def test_paths_are_the_components_of_their_links(spark):
    draw = random.Random(3)
    pool = [" ".join(f"p{p}w{k}" for k in range(draw.randint(20, 300))) for p in range(8)]
    rows = [(draw.choice([None, k]), " ".join(draw.choice(pool) if draw.random() < 0.6 else f"own{k}x{j}" for j in range(12))) for k in range(40)]
    docs = spark.createDataFrame(rows + rows[:5], "doc_id int, text string").withColumn("text_hash", F.xxhash64("text"))
    kept = {}
    with pytest.MonkeyPatch.context() as patch:
        plain = repeats._with_paths
        patch.setattr(repeats, "_with_paths", lambda masked: plain(kept.setdefault("masked", common.materialised(masked))))
        found = {r.name: r.path for r in repeats.repeated_segments(docs, repeats.candidates(docs)).collect()}
    segments = {r.name: r for r in kept["masked"].collect()}
    root = {name: name for name in segments}

    def top(name):
        while root[name] != name:
            name = root[name]
        return name

    for name, s in segments.items():
        to = segments.get(s.follows)
        if to and s.follows == s["last"] and s.follows != name and s.mask >> (s.n - 1) == 1 and to.mask & 1 and s.copies == to.copies:
            a, b = sorted((top(name), top(s.follows)))
            root[b] = a
    assert len(set(found.values())) < len(found) == len(segments)
    assert found == {name: top(name) for name in segments}


def test_repeats_edges(spark):
    assert repeats.without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    text = " ".join(map(str, range(40)))
    rows = spark.createDataFrame([(None, text), (None, text), (1, None), (1, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in repeats.without_repeats(rows).collect())
    assert got == [(0, 40, 40, ""), (0, 40, 40, ""), (1, 0, 0, ""), (1, 0, 0, "")]
    long_text = " ".join(str(k) for k in range(300_000))
    (one,) = repeats.without_repeats(spark.createDataFrame([(1, long_text)], "doc_id long, text string")).collect()
    assert (one.n_words, one.n_removed, one.kept) == (300_000, 0, long_text)


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, sha(f"{len(role.encode())}:", role, text), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(own.get(c - c % 5, [])[:h] + v[h:])
    nodes = defaultdict(list)
    for c, v in whole.items():
        for d in range(len(v) + 1):
            nodes[v[:d]].append(c)
    found = []
    for node, members in nodes.items():
        below = [x for x in nodes if x[: len(node)] == node]
        leaves = sum(not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in nodes) for x in below)
        saved = sum((len(nodes[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        last = ",".join(map(str, sorted(c for c in members if len(whole[c]) == len(node))))
        parent = min(nodes[node[:-1]]) if node else None
        found.append((min(members), len(node), parent, len(members), sum(len(y) == len(node) + 1 for y in below), leaves, saved, sha(last)))
    return sorted(found, key=str)


TURNS = "conv_id long, turn long, role string, text string"


def nodes_of(df):
    return sorted((tuple(r) for r in trie.prefix_trie(df).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_plain_prefixes(spark, seed):
    draw = random.Random(seed)
    rows = []
    for c in [*range(25), 31, 47, 48, 95]:
        for turn in range(draw.choice([1, 2, 9, 14])):
            rows.append((c, draw.choice([turn, turn, turn, None]), draw.choice(["user", "user", None]), draw.choice(["a", "bé", None, "a"])))
    rows += [(None, 1, "user", "of none"), rows[0], rows[0]]
    df = spark.createDataFrame(rows, TURNS).withColumns({"node": F.lit(1), "depth": F.lit("x")}).repartition(6)
    assert nodes_of(df) == plain_trie(rows)


def test_trie_edges(spark):
    assert nodes_of(spark.createDataFrame([], TURNS)) == []
    rows = [(5, k, "user", f"t{k}") for k in range(120)] + [(6, 0, None, None), (7, 0, "user", "é" * 100_000)]
    assert nodes_of(spark.createDataFrame(rows, TURNS)) == plain_trie(rows)


@pytest.mark.parametrize("name", ["op11_merkle", "op12_repeats", "op13_prefix_trie"])
def test_queries_against_sql(spark, sf_dir, name):
    from pathlib import Path

    import __spark_entry__

    duck = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        duck.sql(f"create view {path.stem} as select * from '{path}'")
    got = __spark_entry__.queries()[name](spark, sf_dir)
    expected = duck.sql(__spark_entry__.oracle_sql()[name])
    columns = sorted(expected.columns)
    rows = lambda found: sorted((tuple(map(str, r)) for r in found))
    assert rows(got.select(*columns).collect()) == rows(expected.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall())
