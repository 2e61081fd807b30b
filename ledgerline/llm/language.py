"""Language of texts by a bidirectional gated recurrent network over bytes, in numpy.

Two recurrent layers read the UTF-8 bytes of a stretch forwards and backwards. At every position both states give the
languages' probabilities; a document's are the mean of their logarithms over all its positions. The network is trained by
backpropagation through time on stretches of about SAMPLE_DOCS documents outside the held-out fold, drawn language by
language by a hash of their texts; training visits a document some DRAWS times, each time at another stretch, drawn from
all of its text. Texts are read whole, in stretches of STRETCH bytes that go through the network many at a time.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

FOLDS, HELD_OUT = 3, 1
SAMPLE_DOCS = 4000
STRETCH = 96
HIDDEN = 8
STEPS, ROWS, RATE = 240, 256, 0.02
DRAWS = -(-STEPS * ROWS // SAMPLE_DOCS)  # as many stretches in all as training visits
LANES = 4096
UNKNOWN = "und"

_letter = re.compile(r"[^\W\d_]")


class Network:
    """Weights: of bytes (256, 3H), of states (H, 3H), biases (3H) for either direction; of the labels (2H, C), (C)."""

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        scale = 1 / np.sqrt(hidden)
        draw = lambda *shape: rng.uniform(-scale, scale, shape).astype(np.float32)
        self.w = {f"{name}{d}": draw(*shape) for d in "fb" for name, shape in (("x", (256, 3 * hidden)), ("h", (hidden, 3 * hidden)), ("a", (3 * hidden,)))}
        self.w |= {"o": draw(2 * hidden, len(labels)), "c": np.zeros(len(labels), np.float32)}

    def _read(self, x: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """States (T, B, H) after each byte of ``x`` (T, B), backwards if ``d`` is b; and what training needs of each step."""
        size = self.hidden
        steps, lanes = x.shape
        table = self.w["x" + d] + self.w["a" + d]
        table[:, : 2 * size] *= 0.5  # a sigmoid is half a tanh of half
        inner = self.w["h" + d].copy()
        inner[:, : 2 * size] *= 0.5
        states, cache = np.empty((steps, lanes, size), np.float32), []
        h = np.zeros((lanes, size), np.float32)
        given, pushed = np.empty((lanes, 3 * size), np.float32), np.empty((lanes, 3 * size), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            np.take(table, x[t], axis=0, out=given, mode="clip")
            np.matmul(h, inner, out=pushed)
            gates = given[:, : 2 * size] + pushed[:, : 2 * size]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            z, r = gates[:, :size], gates[:, size:]
            n = r * pushed[:, 2 * size :]
            n += given[:, 2 * size :]
            np.tanh(n, out=n)
            if keep:
                cache.append((t, h, z, r, n, pushed[:, 2 * size :].copy()))
            h = np.add(n, z * (h - n), out=states[t])
        return states, cache

    def log_probs(self, x: np.ndarray) -> np.ndarray:
        """(T, B, C): the labels' log-probabilities at every position."""
        return self._label(self._read(x, "f", False)[0], self._read(x, "b", False)[0])

    def _label(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        size = self.hidden
        scores = forward @ self.w["o"][:size] + backward @ self.w["o"][size:] + self.w["c"]
        scores -= scores.max(-1, keepdims=True)
        scores -= np.log(np.exp(scores).sum(-1, keepdims=True))
        return scores

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean loss over the positions in ``mask`` (T, B), with labels ``y`` (B); its gradients, by going back through time."""
        size, found = self.hidden, {k: np.zeros_like(v) for k, v in self.w.items()}
        kept = {d: self._read(x, d, True) for d in "fb"}
        logs = self._label(kept["f"][0], kept["b"][0])
        n = max(1.0, float(mask.sum()))
        loss = -float((logs[:, np.arange(len(y)), y] * mask).sum()) / n
        off = np.exp(logs)
        off[:, np.arange(len(y)), y] -= 1
        off *= mask[..., None] / np.float32(n)
        found["c"] = off.sum((0, 1))
        for d, rows in (("f", slice(0, size)), ("b", slice(size, None))):
            states, cache = kept[d]
            found["o"][rows] = np.tensordot(states, off, ((0, 1), (0, 1)))
            back = off @ self.w["o"][rows].T
            carried = np.zeros_like(states[0])
            inner = self.w["h" + d]
            for t, before, z, r, n_, pushed in reversed(cache):
                dh = back[t] + carried
                dn = dh * (1 - z) * (1 - n_ * n_)
                dz = dh * (before - n_) * z * (1 - z)
                dr = dn * pushed * r * (1 - r)
                given = np.concatenate([dz, dr, dn], 1)
                through = np.concatenate([dz, dr, dn * r], 1)
                np.add.at(found["x" + d], x[t], given)
                found["a" + d] += given.sum(0)
                found["h" + d] += before.T @ through
                carried = dh * z + through @ inner.T
        return loss, found

    def train(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, steps: int = STEPS, rows: int = ROWS, rate: float = RATE, seed: int = 2) -> list[float]:
        """Adam over random rows of ``x`` (N, T); the losses. A label comes up as often as the root of its share asks, so that rare ones are learned."""
        rng, losses = np.random.default_rng(seed), []
        upto = np.cumsum(1 / np.sqrt(np.bincount(y)[y]))
        m, v = ({k: np.zeros_like(w) for k, w in self.w.items()} for _ in range(2))
        for step in range(1, steps + 1):
            some = np.minimum(np.searchsorted(upto, rng.random(min(rows, len(x))) * upto[-1], "right"), len(x) - 1)
            loss, found = self.gradients(np.ascontiguousarray(x[some].T).astype(np.intp), np.ascontiguousarray(mask[some].T), y[some])
            losses.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in found.values()))
            pace = rate * min(1.0, 4 * (1 - (step - 1) / steps)) * min(1.0, 1 / max(norm, 1e-12))
            for k, g in found.items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.02 * (g * g - v[k])
                self.w[k] -= pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.98**step)) + 1e-6)
        return losses

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """(N, C): each text's label probabilities, pooled over all its bytes."""
        sums, data = np.zeros((len(texts), len(self.labels))), b"".join(texts)
        lengths = np.array([len(t) for t in texts])
        count = -(-lengths // STRETCH)
        owner = np.repeat(np.arange(len(texts)), count)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        starts = (np.cumsum(lengths) - lengths)[owner] + inside * STRETCH
        sizes = np.minimum(lengths[owner] - inside * STRETCH, STRETCH)
        flat = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(STRETCH, np.uint8)])
        place = np.arange(STRETCH)[:, None]
        for k in range(0, len(owner), LANES):
            part = slice(k, k + LANES)
            valid = place < sizes[part][None]
            x = np.where(valid, flat[starts[part][None] + place], 0)
            logs = self.log_probs(x) * valid[..., None]
            np.add.at(sums, owner[part], logs.sum(0, dtype=np.float64))
        mean = sums / np.maximum(lengths, 1)[:, None]
        share = np.exp(mean - mean.max(1, keepdims=True))
        return share / share.sum(1, keepdims=True)


def _held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def _level(counts: list[int], total: int) -> int:
    """How many of each language fit ``total`` if all have as many, or all they hold; at least one."""
    left = total
    for k, n in enumerate(sorted(counts)):
        if n * (len(counts) - k) > left:
            return max(1, left // (len(counts) - k))
        left -= n
    return max(1, *counts)


def _drawn(text: str, seed: int) -> list[bytes]:
    """All stretches of ``text``, or DRAWS of them at random, each as likely as any other; short ends only where there is no other."""
    data = text.encode()
    n = max(1, len(data) // STRETCH)
    some = range(n) if n <= DRAWS else sorted(np.random.default_rng(seed % (1 << 63)).choice(n, DRAWS, replace=False).tolist())
    return [data[k * STRETCH : (k + 1) * STRETCH] for k in some]


def sample(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, hash, stretches of the texts to learn from; a row a text.

    What counts is a text with a letter, a language and an id outside the held-out fold; equal texts of a language count
    once. Every language gives all its texts or as many as any other, so that they are ``sample_docs`` in all; it gives one at
    least, so there are more if there are more languages than that. Texts are drawn by their hash and read whole in the
    tasks, and a text gives DRAWS stretches at most. A number a language comes to the driver; about twice ``sample_docs`` texts'
    stretches, and those of thirty more a language, are shuffled.
    """
    known = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang")).where("lang is not null and doc_id is not null")
    known = known.where(F.col("text").rlike("\\p{L}") & ~_held_out(F.col("doc_id"))).withColumn("hash", F.xxhash64("text"))
    spark = docs.sparkSession
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n")).collect()}
    level = _level(list(counts.values()), sample_docs) if counts else 0
    shares = spark.createDataFrame([(k, min(1.0, (2.0 * level + 30) / max(1, n))) for k, n in counts.items()], "_lang string, share double")
    draw = F.pmod("hash", F.lit(1 << 32)) / F.lit(float(1 << 32))
    rows = known.join(F.broadcast(shares), F.col("lang") == F.col("_lang")).where(draw < F.col("share")).select("lang", "hash", "text")

    def batches(parts):
        for part in common.sliced(parts):
            found = [_drawn(*x) for x in zip(part.column(2).to_pylist(), part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.list_(pa.binary()))], names=["lang", "hash", "stretches"])

    found = rows.mapInArrow(batches, "lang string, hash long, stretches array<binary>").dropDuplicates(["lang", "hash"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy(draw, "hash"))
    return found.withColumn("place", place).where(F.col("place") <= level).drop("place")


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | None:
    """A network of all languages of ``docs``, from a ``sample`` of the texts; None if no document has both."""
    rows = sorted(sample(docs, sample_docs, id_col, text_col, lang_col).collect(), key=lambda r: (r["lang"], r["hash"]))
    if not rows:
        return None
    labels = sorted({r["lang"] for r in rows})
    place = {lang: k for k, lang in enumerate(labels)}
    pieces = [(data, place[r["lang"]]) for r in rows for data in r["stretches"]]
    x, mask = np.zeros((len(pieces), STRETCH), np.uint8), np.zeros((len(pieces), STRETCH), np.float32)
    for k, (data, _) in enumerate(pieces):
        x[k, : len(data)] = np.frombuffer(data, np.uint8)
        mask[k, : len(data)] = 1
    network = Network(labels)
    network.train(x, mask, np.array([y for _, y in pieces]))
    return network


def identify(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score.

    Texts that are null or have no letter, and all texts where nothing could be learned, are ``und`` with score 0. A null
    doc_id is not held out. Repeated rows give a row each; an empty table gives none; other columns are ignored.
    """
    view = common.docs_view(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def batches(parts):
        network = shared.value
        for part in parts:
            texts = part.column(1).to_pylist()
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            some = [k for k, t in enumerate(texts) if network and t and _letter.search(t)]
            at = 0
            while at < len(some):  # about a megabyte at a time
                end, size = at, 0
                while end < len(some) and (end == at or size < 1 << 20):
                    size += len(texts[some[end]])
                    end += 1
                shares = network.pooled([texts[k].encode() for k in some[at:end]])
                for k, row in zip(some[at:end], shares):
                    best = int(row.argmax())
                    names[k], scores[k] = network.labels[best], float(row[best])
                at = end
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    found = view.mapInArrow(batches, common.with_id(view, "lang_pred string, score double"))
    return found.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
