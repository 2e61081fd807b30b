"""Toxicity of texts by noisy-channel deobfuscation.

Spans that look disguised (digits or signs among letters, spaced-out letters, letters repeated thrice) become lattices: a
sign stands for letters it resembles, two stars or more for any letters; of a letter written thrice or more often one may be left, of a run of
signs one letter or two; up to three separators between spaced letters or signs may be nothing. A single sign, or any number of plus signs, after a word's only letter stays. Viterbi
decoding under a character language model picks the likeliest reading; text outside such spans has one reading only and
stays. A logistic model over the words, and the beginnings of words, of the restored text gives the score.

The language model counts character trigrams over all documents. The classifier is fitted on at most SAMPLE_ROWS labelled
documents, chosen by a hash of the doc_id; words enter it if they set the labels apart by a z-score.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

FOLDS = 5
SAMPLE_ROWS = 20_000
FEATURES = 1024
LEAST_DOCS = 5
STEPS, DECAY, RATE = 800, 3e-5, 1.0
BEGINNINGS = (3, 4, 5, 6)
CACHED = 64  # no longer words or spans are kept in the caches of a task

#: What a sign may stand for.
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "*": "aeiou"}
SIGNS = "".join(LOOKALIKES)
#: Members of spaced-out words beside letters and digits; * is a separator that may be a vowel.
MEMBERS = SIGNS.translate(dict.fromkeys(map(ord, "0123456789*")))
MOST_APART = 3
TAILS = "!.,;:?"
COSTS = {"stands for": 1.0, "stays": 9.0, "repeated": 0.7, "one of two": 3.0, "any letter": 2.0, "kept apart": 4.0, "dropped": 0.3}
ANY, CONSONANTS = "*", "bcdfghjklmnpqrstvwxyz"
#: Language-model symbols: 0 between words, 1 to 26 letters without their accents, 27 other letters.
SYMBOLS = 28

_sign = re.compile(f"[{re.escape(SIGNS)}]+")
_closing = re.compile(r"!+|(.)\1\1+")  # after a word, these are punctuation or noise
_repeat = re.compile(r"([^\W\d_])\1\1")
_member, _apart = rf"(?:[^\W_]|[{re.escape(MEMBERS)}])", rf"(?:[^\w{re.escape(MEMBERS)}]|_)"
#: No character is both a member and a separator, so matching takes no more than linear time. A last ! is punctuation.
_more = rf"(?:{_apart}{{1,{MOST_APART}}}{_member})"
_spaced = re.compile(rf"(?<![^\W_])(?:{_member}{_more}{{2,}}|(?<!\S)\*\s{{1,{MOST_APART}}}{_member}{_more}+)(?<!!)(?![^\W_])")
_run = re.compile(rf"{_apart}+")
_word = re.compile(r"[^\W\d_]+")
_token_end = re.compile(r"\s|\Z")


def _class_of(char: str) -> int:
    base = unicodedata.normalize("NFKD", char.lower())[:1]
    if "a" <= base <= "z":
        return ord(base) - 96
    return 27 if char.isalpha() else 0


_classes = np.array([_class_of(chr(c)) for c in range(0x250)] + [27], np.int64)


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return _classes[np.minimum(points, 0x250)]


def trigram_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often each three symbols follow each other, over all texts; a row a trigram comes to the driver."""

    def batches(parts):
        total = np.zeros(SYMBOLS**3, np.int64)
        for part in common.sliced(parts):
            block: list[str] = []
            chars = 0
            for text in [*part.column(0).to_pylist(), None]:
                if text is not None:
                    block.append(text)
                    chars += len(text)
                if block and (text is None or chars > 1 << 18):
                    c = _codes("\n\n" + "\n\n".join(block) + "\n\n")
                    total += np.bincount((c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:], minlength=SYMBOLS**3)
                    block, chars = [], 0
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["trigram", "n"])

    texts = docs.select(docs[text_col].cast("string").alias("text")).where("text is not null")
    counts = np.zeros(SYMBOLS**3, np.int64)
    for trigram, n in texts.mapInArrow(batches, "trigram long, n long").groupBy("trigram").agg(F.sum("n")).collect():
        counts[trigram] = n
    return counts


class Restorer:
    """Restores disguised spans under a trigram model made from ``counts``."""

    def __init__(self, counts: np.ndarray, smoothing: float = 0.5):
        table = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
        pairs = table.sum(0) + smoothing
        backoff = pairs / pairs.sum(1, keepdims=True)
        share = (table + 5 * backoff[None]) / (table.sum(2, keepdims=True) + 5)
        self.cost = (-np.log(share)).tolist()
        self.known: dict[str, str] = {}

    def readings(self, span: str, k: int, spaced: bool) -> list[tuple[str, float]]:
        """What the character at ``k`` may be, with costs: itself, letters it resembles, or nothing."""
        char = span[k]
        run = _run.match(span, k) if spaced else None
        if run and k and _run.match(span, k - 1):  # kept or dropped with the first of the run
            return [("", 0.0)] + [(x, COSTS["stands for"]) for x in LOOKALIKES.get(char, "")]
        found = [(run[0] if run else char, COSTS["kept apart"] if run else COSTS["stays"] if char in LOOKALIKES else 0.0)]
        found += [(x, COSTS["stands for"]) for x in LOOKALIKES.get(char, "")]
        first, beyond = k, k + 1
        while first and span[first - 1] == char:
            first -= 1
        while beyond < len(span) and beyond - first < 3 and span[beyond] == char:
            beyond += 1
        if char == ANY and beyond - first > 1:
            found += [(x, COSTS["any letter"]) for x in CONSONANTS]
        if k > first and (beyond - first > 2 or k - first > 1):
            found.append(("", COSTS["repeated"] if char not in LOOKALIKES or k - first > 1 else COSTS["one of two"]))
        elif k > first and char in LOOKALIKES:
            found.append(("", COSTS["one of two"]))
        if run and len(run[0]) <= MOST_APART:
            found.append(("", COSTS["dropped"]))
        return found

    def decode(self, span: str, spaced: bool) -> str:
        """The least-cost reading of ``span``. States are the last two symbols; the work is linear in the length."""
        live = {(0, 0): (0.0, None)}
        for k in range(len(span)):
            then: dict = {}
            for char, price in self.readings(span, k, spaced):
                symbol = _class_of(char) if char else -1
                for (a, b), (cost, path) in live.items():
                    if symbol < 0:
                        key, total, way = (a, b), cost + price, path
                    elif not symbol and not b:
                        key, total, way = (0, 0), cost + price, (char, path)
                    else:
                        key, total, way = (b, symbol), cost + price + self.cost[a][b][symbol], (char, path)
                    if key not in then or total < then[key][0]:
                        then[key] = (total, way)
            live = then
        best = min(((cost + (self.cost[a][b][0] if b else 0.0), path) for (a, b), (cost, path) in live.items()), key=lambda x: x[0])[1]
        out = []
        while best is not None:
            out.append(best[0])
            best = best[1]
        return "".join(reversed(out))

    def spans(self, text: str) -> list[tuple[int, int, bool]]:
        """Disguised spans of lower-case ``text``, in order and apart: (start, end, spaced out)."""
        hits = []
        for m in _sign.finditer(text):
            i, j = m.span()
            alone = i and text[i - 1].isalpha() and not text[j : j + 1].isalpha() and not (i > 1 and text[i - 2].isalnum())
            if alone and (j - i == 1 or set(m[0]) == {"+"}):
                continue  # as in c++
            if j < len(text) and text[j].isalpha() or i and text[i - 1].isalpha() and not _closing.fullmatch(m[0]):
                hits.append(i)
        hits += [m.start() for m in _repeat.finditer(text)]
        found = [(*m.span(), True) for m in _spaced.finditer(text) if any(map(str.isalpha, m[0])) or sum(map(str.isalnum, m[0])) > 3]
        end = -1
        for at in sorted(hits):
            if at >= end:
                start = at
                while start and not text[start - 1].isspace():
                    start -= 1
                end = _token_end.search(text, at).start()
                found.append((start, max(at + 1, self._without_tail(text, start, end)), False))
        found.sort()
        apart: list[tuple[int, int, bool]] = []
        for span in found:
            if apart and span[0] < apart[-1][1]:
                apart[-1] = (apart[-1][0], max(apart[-1][1], span[1]), apart[-1][2] or span[2])
            else:
                apart.append(span)
        return apart

    @staticmethod
    def _without_tail(text: str, start: int, end: int) -> int:
        """The end of ``text[start:end]`` without punctuation, and without a run of three of one sign or more."""
        while end > start and text[end - 1] in TAILS:
            end -= 1
        same = end
        while same > start and text[same - 1] == text[end - 1] and not text[same - 1].isalnum():
            same -= 1
        return same if end - same > 2 else end

    def restore(self, text: str) -> str:
        """``text`` in lower case with its disguised spans restored."""
        text = text.lower()
        out, at = [], 0
        for start, end, spaced in self.spans(text):
            span = text[start:end]
            reading = self.known.get(span)
            if reading is None:
                reading = self.decode(span, spaced)
                if len(span) <= CACHED:
                    if len(self.known) > 30_000:
                        self.known.clear()
                    self.known[span] = reading
            out += [text[at:start], reading]
            at = end
        return "".join(out) + text[at:] if out else text


def _features(word: str) -> list[str]:
    return [word] + [word[:k] + "-" for k in BEGINNINGS if len(word) > k]


def _held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """text, label of at most ``rows`` labelled documents outside the held-out fold, one of each doc_id.

    A doc_id labelled twice counts as toxic if once; of texts with one doc_id the one with the least hash is taken."""
    known = labels.where("toxic is not null and doc_id is not null").where(~_held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = common.docs_view(docs).join(F.broadcast(known), "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "label")
    return found.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("label").alias("label")).drop("doc_id")


class Model:
    def __init__(self, restorer: Restorer, weights: dict[str, float], bias: float):
        self.restorer, self.weights, self.bias = restorer, weights, bias
        self.of_word: dict[str, tuple] = {}

    def features(self, text: str) -> set[str]:
        found: set[str] = set()
        known, weights = self.of_word, self.weights
        for word in set(_word.findall(self.restorer.restore(text))):
            own = known.get(word)
            if own is None:
                own = tuple(f for f in _features(word) if f in weights)
                if len(word) <= CACHED:
                    if len(known) > 100_000:
                        known.clear()
                    known[word] = own
            found.update(own)
        return found

    def score(self, text: str) -> float:
        z = self.bias + sum(sorted(self.weights[f] for f in self.features(text)))
        return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


def _counts(seen: Counter, toxic: Counter) -> pa.RecordBatch:
    names = list(seen)
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([seen[x] for x in names], pa.int64()), pa.array([toxic[x] for x in names], pa.int64())], names=["feature", "n", "toxic"])


def _select(sample: DataFrame, restorer: Restorer, n: int) -> list[str]:
    """The features that set the labels apart most, by z-score of their documents' labels."""

    def batches(parts):
        seen, toxic = Counter(), Counter()
        for part in common.sliced(parts):
            for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                own = {f for w in set(_word.findall(restorer.restore(text))) for f in _features(w)}
                seen.update(own)
                if label:
                    toxic.update(own)
                if len(seen) > 100_000:
                    yield _counts(seen, toxic)
                    seen, toxic = Counter(), Counter()
        yield _counts(seen, toxic)

    rate = sample.agg(F.avg("label")).first()[0]
    if not rate or rate == 1:
        return []
    counted = sample.mapInArrow(batches, "feature string, n long, toxic long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    z = (F.col("toxic") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
    best = counted.where(F.col("n") >= LEAST_DOCS).orderBy(F.abs(z).desc(), "feature").limit(n)
    return [r["feature"] for r in best.select("feature").collect()]


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES) -> Model:
    """A model from ``labels`` (doc_id, toxic). With no labels, or one kind only, it scores all texts alike."""
    restorer = Restorer(trigram_counts(docs))
    sample = common.materialised(_sample(docs, labels, sample_rows))
    n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    names = _select(sample, restorer, features)
    bias = log((toxic + 0.5) / (n - toxic + 0.5))
    if not names:
        return Model(restorer, {}, bias)
    model, place = Model(restorer, dict.fromkeys(names, 0.0), 0.0), {x: k for k, x in enumerate(names)}

    def batches(parts):
        for part in common.sliced(parts):
            own = [[place[f] for f in model.features(t)] for t in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array(own, pa.list_(pa.int32()))], names=["label", "own"])

    rows = sample.mapInArrow(batches, "label int, own array<int>").collect()  # at most sample_rows, some numbers each
    rows.sort(key=lambda r: (r["label"], sorted(r["own"])))
    x, y = np.zeros((len(rows), len(names) + 1), np.float32), np.array([r["label"] for r in rows], np.float32)
    x[:, -1] = 1
    for k, r in enumerate(rows):
        x[k, r["own"]] = 1
    w = np.zeros(len(names) + 1, np.float32)
    w[-1] = bias
    speed, decay = np.zeros_like(w), np.full_like(w, DECAY)
    decay[-1] = 0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-(x @ w)))
        speed = 0.9 * speed - RATE * (x.T @ (p - y) / len(y) + decay * w)
        w += speed
    return Model(restorer, {f: round(float(v), 4) for f, v in zip(names, w)}, round(float(w[-1]), 4))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts get the model's score of no words. Repeated rows give a row each; an empty table gives none; a
    null doc_id is not held out; other columns are ignored.
    """
    view = common.docs_view(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batches(parts):
        model = shared.value
        for part in common.sliced(parts):
            scores = pa.array([model.score(x or "") for x in part.column(1).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([part.column(0), scores], names=["doc_id", "score"])

    scored = view.mapInArrow(batches, common.with_id(view, "score double"))
    return scored.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_civil(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that ``model`` does not call toxic.

    Null texts are scored as empty. Each row goes by its own text, so repeated rows stay or go together and repeated ids with
    unlike texts need not; an empty table gives none; no name of a column can clash.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def batches(parts):
        model = shared.value
        for part in common.sliced(parts):
            yield part.filter(pa.array([model.score(x or "") < 0.5 for x in part.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(batches, docs.schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return score(docs, fit(docs, common.table(spark, sf_dir, "labels")))
