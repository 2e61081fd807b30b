"""Results do not depend on where texts and sources are cut for work."""

import random

from ledgerline.llm import mixing, simhash


def test_fingerprints_across_blocks(monkeypatch):
    draw = random.Random(1)
    texts = [" ".join(draw.choice("abcdefgh") * draw.randint(1, 3) for _ in range(n)) for n in (1, 2, 3, 7, 8, 9, 10, 40)]
    whole = [simhash.fingerprint(t) for t in texts]
    for block in (1, 2, 7):
        monkeypatch.setattr(simhash, "BLOCK", block)
        assert [simhash.fingerprint(t) for t in texts] == whole


def test_mixing_comes_near_its_targets_with_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE", 16)
    draw = random.Random(2)
    rows = [(k, "w " * draw.randint(1, 30), f"s{k % 3}") for k in range(900)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target = {}, {}
    for r in found:
        source = rows[r.doc_id][2]
        taken[source] = taken.get(source, 0) + r.taken
        target[source] = r.target
        assert r["size"] == len(rows[r.doc_id][1].split()) and r.taken % r["size"] == 0 and r.taken <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 30 for s in target)
