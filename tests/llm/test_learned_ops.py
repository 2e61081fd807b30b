"""Toxicity and language: held-out accuracy, gradients, decoding."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest

from ledgerline.llm import language, toxicity

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit(*tables)


def test_toxicity_held_out(tables, model):
    docs, labels = tables
    rows = toxicity.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    toxic, civil = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert np.mean([(s > np.array(civil)).mean() for s in toxic]) > 0.85
    assert np.mean([s >= 0.5 for s in civil]) < 0.05


def test_trigrams_are_those_of_plain_counting(spark):
    docs = spark.createDataFrame([("ab",), (None,), ("",), ("bä!",)], "text string")
    counts = toxicity.trigram_counts(docs)
    seen = np.flatnonzero(counts).tolist()
    at = lambda a, b, c: (a * 28 + b) * 28 + c
    for key in (at(0, 0, 1), at(0, 1, 2), at(1, 2, 0), at(2, 1, 0)):
        assert key in seen
    assert counts[at(0, 1, 2)] == 1


def test_disguises_are_restored(spark):
    words = "the idiot and the loser are stupid and worthless clown moron trash of a pathetic scum disgusting people with that of " * 40
    docs = spark.createDataFrame([(1, words)], "doc_id long, text string")
    restorer = toxicity.Restorer(toxicity.trigram_counts(docs))
    for given, clear in {"1d10t": "idiot", "m0r0n": "moron", "stuuuupid": "stupid", "l o s e r": "loser", "p.a.t.h.e.t.i.c": "pathetic", "tr@sh": "trash", "cl0wn": "clown", "the moron": "the moron"}.items():
        assert restorer.restore(given) == clear
    for given in ("scum!!", "scum$$$ of", "moron, the"):  # punctuation and noise after a word are no disguise
        assert restorer.restore(given) == given
    assert restorer.restore("m0r0n!!") == "moron!!"
    for plain in ("", "in 2024 of 3 | 4", "a b", "the idiot, and", "x@y"):
        assert len(restorer.restore(plain)) <= len(plain)


def test_spacing_and_signs_together(spark):
    words = "the idiot and the loser are stupid and worthless clown moron trash of a pathetic scum ass disgusting people with that of " * 40
    restorer = toxicity.Restorer(toxicity.trigram_counts(spark.createDataFrame([(1, words)], "doc_id long, text string")))
    given = {"$ c u m": "scum", "$ t u p i d": "stupid", "! d 1 o t": "idiot", "a $ s": "ass", "s  c  u  m": "scum", "l . o . s . e . r": "loser", "c,l,o,w,n": "clown", "m/o/r/o/n": "moron", "t~r~@~s~h": "trash"}
    given |= {"s\tc\tu\tm": "scum", "s\nc\nu\nm": "scum", "s\u200bc\u200bu\u200bm": "scum", "* s s": "ass", "l * s e r": "loser", "s c u m !": "scum !"}
    assert {x: restorer.restore(x) for x in given} == given
    for plain in ("1 | 2 | 3", "! ! ! ! !", "the idiot, and"):
        assert restorer.restore(plain) == plain
    assert restorer.restore("$ " * 20_000) and restorer.restore("_!" * 20_000)  # in linear time


def test_toxicity_edges(spark, model):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, "1" * 50_000 + "a", 0.5), (None, "a idiot", 0.5), (5, "idiot", 0.5), (5, "idiot", 0.5)], "doc_id long, text string, score double")
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert rows[0].score == rows[1].score
    assert toxicity.keep_civil(docs, model).columns == docs.columns
    none = docs.where("false")
    assert toxicity.score(none, model).count() == 0
    alone = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.predicted for r in toxicity.score(docs, alone).collect()} <= {0, 1}


def test_gradients_equal_differences():
    net = language.Network(["a", "b", "c"], 4)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 9, (6, 5)), np.array([0, 1, 2, 1, 0])
    mask = np.ones((6, 5))
    mask[4:, 1] = 0
    _, found = net.gradients(x, mask, y)
    for name, grad in found.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in grad.shape)
            if name[0] == "x":
                at = (rng.integers(0, 9), at[1])
            kept, ends = net.w[name][at], []
            for step in (1e-2, -1e-2):
                net.w[name][at] = kept + step
                ends.append(net.gradients(x, mask, y)[0])
            net.w[name][at] = kept
            assert abs((ends[0] - ends[1]) / 2e-2 - grad[at]) < 2e-3, (name, at)


def test_language_held_out(tables):
    docs, _ = tables
    network = language.fit(docs)
    rows = language.identify(docs, network).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges_and_batches(spark):
    net = language.Network(["x", "y"])
    texts = [b"abc", "é".encode() * 700, b"z", b"longer text " * 99]
    together = net.pooled(texts)
    for k, t in enumerate(texts):
        assert np.allclose(net.pooled([t])[0], together[k], atol=1e-5)
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "123 !"), (4, "words"), (None, "words"), (4, "words")], "doc_id long, text string")
    rows = language.identify(docs, net).collect()
    assert [r.lang_pred for r in rows[:3]] == ["und"] * 3 and rows[3].lang_pred in ("x", "y") and len(rows) == 6
    assert {r.lang_pred for r in language.identify(docs, language.fit(docs.selectExpr("*", "cast(null as string) as lang"))).collect()} == {"und"}
    assert language.identify(docs.where("false"), net).count() == 0


def test_every_language_is_drawn(spark):
    rows = [(k, f"words of text number {k}", None) for k in range(3000)] + [(k, f"a text that is the {k}th", "a") for k in range(3000, 3600)]
    rows += [(k, "the same text again", "a") for k in range(4000, 4900)] + [(k, f"qx zq xxq {k} zzq", "rare") for k in range(5000, 5009)] + [(6000, "...", "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    found = [(r.lang, b"".join(r.stretches).decode()) for r in language.sample(docs, 100).collect()]
    rare = {t for i, t, lang in rows if lang == "rare" and zlib.crc32(str(i).encode()) % language.FOLDS != language.HELD_OUT}
    assert len(found) == len(set(found)) == 100 and {t for lang, t in found if lang == "rare"} == rare
    assert {r.lang for r in language.sample(docs, 1).collect()} == {"a", "rare"}
    network = language.fit(docs)
    best = {r.doc_id: r.lang_pred for r in language.identify(docs, network).collect()}
    assert all(best[k] == "rare" for k in range(5000, 5009)) and best[3001] == "a"


def test_stretches_come_from_all_of_a_text(spark):
    text = "".join(f"{k:05d} " for k in range(40_000))
    found = language._drawn(text, -5)
    at = [text.index(x.decode()) for x in found]
    assert len(set(at)) == language.DRAWS and all(k % language.STRETCH == 0 for k in at)
    reached = {text.index(x.decode()) * 10 // len(text) for seed in range(20) for x in language._drawn(text, seed)}
    assert reached == set(range(10))
    assert b"".join(language._drawn(text[:960], 1)) == text[:960].encode() and language._drawn("é", 1) == ["é".encode()]
    few = spark.range(200_000).selectExpr("id as doc_id", "concat('text number ', id) as text", "if(id % 100 = 0, concat('l', id % 300), null) as lang")
    assert language.sample(few, 600).count() == 600  # drawn from the labelled rows, though they are one in a hundred


def test_repeated_ids_do_not_grow_the_sample(spark):
    docs = spark.range(5000).selectExpr("id % 10 as doc_id", "concat('text ', id) as text")
    labels = spark.range(10).selectExpr("id as doc_id", "id % 2 as toxic")
    assert toxicity._sample(docs, labels, 20).count() <= 10
    assert toxicity._sample(docs, labels, 3).count() == 3
    assert toxicity._sample(docs.repartition(3), labels, 20).collect() and sorted(map(tuple, toxicity._sample(docs.repartition(3), labels, 20).collect())) == sorted(map(tuple, toxicity._sample(docs, labels, 20).collect()))


def test_caches_hold_no_long_words(spark):
    model = toxicity.Model(toxicity.Restorer(np.ones(28**3, np.int64)), {"a-": 1.0}, 0.0)
    model.score("x1y" * 5000 + " " + "abc" * 5000 + " short sh0rt")
    assert model.restorer.known.keys() == {"sh0rt"} and "short" in model.of_word
    assert all(len(x) <= toxicity.CACHED for x in model.of_word)


SAID = "an asshole is stupid and the code of a book fuck that stoopid thing so all will call the boss"
READ = {
    "A$$hole": "asshole", "st00000pid": "stoopid", "f**k": "fuck", "st*pid": "stupid", "stuuuupid": "stupid", "b0$$": "boss", "s t u p i d": "stupid",
    "C++ code": "c++ code", "c+ grade": "c+ grade", "R$ 5": "r$ 5", "a book, all of it!!!": "a book, all of it!!!", "call the boss": "call the boss",
}


@pytest.mark.parametrize("text", READ)
def test_runs_of_signs_and_plain_text(text):
    codes = toxicity._codes("\n\n" + "\n\n".join(SAID.split() * 50) + "\n\n")
    counts = np.bincount((codes[:-2] * 28 + codes[1:-1]) * 28 + codes[2:], minlength=28**3)
    assert toxicity.Restorer(counts).restore(text) == READ[text]


def test_best_readings_are_the_best_of_all(spark):
    rng = random.Random(6)
    counts = np.array([rng.randint(0, 60) for _ in range(28**3)])
    restorer = toxicity.Restorer(counts)

    def price(reading):
        a = b = 0
        total = 0.0
        for char in reading:
            symbol = toxicity._class_of(char)
            if symbol or b:
                total += restorer.cost[a][b][symbol]
                a, b = b, symbol
            else:
                a = 0
        return total + (restorer.cost[a][b][0] if b else 0.0)

    for _ in range(400):
        spaced = rng.random() < 0.4
        span = (" " if spaced else "").join(rng.choice("abs0134@$!|*eett") for _ in range(rng.randint(2, 4 if spaced else 6)))
        ways = itertools.product(*(restorer.readings(span, k, spaced) for k in range(len(span))))
        best = min((sum(cost for _, cost in way) + price("".join(char for char, _ in way)), "".join(char for char, _ in way)) for way in ways)
        assert restorer.decode(span, spaced) == best[1], span


def test_scores_by_hand(tables, model):
    docs, _ = tables
    for r, s in zip(docs.limit(60).collect(), toxicity.score(docs.limit(60), model).collect()):
        assert r.doc_id == s.doc_id
        words, now = set(), ""
        for c in model.restorer.restore(r.text or "") + " ":
            if c.isalpha():
                now += c
            elif now:
                words.add(now)
                now = ""
        seen = {w for w in words} | {w[:k] + "-" for w in words for k in (3, 4, 5, 6) if len(w) > k}
        z = model.bias + math.fsum(model.weights.get(f, 0) for f in seen)
        assert abs(s.score - 1 / (1 + math.exp(-z))) < 1e-6


def test_network_by_loops():
    net = language.Network(["a", "b", "c"], 3, seed=4)
    sigmoid = lambda x: 1 / (1 + math.exp(-x))

    def states(data, d):
        h, out = [0.0] * 3, []
        for byte in data if d == "f" else data[::-1]:
            given = [net.w["x" + d][byte][k] + net.w["a" + d][k] for k in range(9)]
            pushed = [sum(h[j] * net.w["h" + d][j][k] for j in range(3)) for k in range(9)]
            z, r = [sigmoid(given[k] + pushed[k]) for k in range(3)], [sigmoid(given[k + 3] + pushed[k + 3]) for k in range(3)]
            n = [math.tanh(given[k + 6] + r[k] * pushed[k + 6]) for k in range(3)]
            h = [(1 - z[k]) * n[k] + z[k] * h[k] for k in range(3)]
            out.append(h)
        return out if d == "f" else out[::-1]

    for data in (b"x", "é\n".encode(), bytes(range(256)), b"some longer text " * 30):
        total = [0.0] * 3
        for at in range(0, len(data), language.STRETCH):
            part = data[at : at + language.STRETCH]
            # a short stretch is padded with bytes of 0 behind, which the backward pass reads first
            back = states(part + bytes(language.STRETCH - len(part)), "b")
            for f, b in zip(states(part, "f"), back):
                scores = [sum(v * net.w["o"][k][c] for k, v in enumerate(f + b)) + net.w["c"][c] for c in range(3)]
                logs = [x - math.log(sum(map(math.exp, scores))) for x in scores]
                total = [t + x for t, x in zip(total, logs)]
        shares = [math.exp(t / len(data)) for t in total]
        assert np.allclose(net.pooled([data])[0], np.array(shares) / sum(shares), atol=1e-4)
