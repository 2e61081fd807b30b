"""Token counts by a sentencepiece BPE model, with overlap resynchronisation for huge documents.

A document longer than ``chunk_chars`` is encoded in chunks that overlap. Two neighbouring chunks are spliced where both
have a token boundary between characters that no vocabulary piece holds side by side: no merge can cross such a place,
so the encodings left and right of it do not depend on each other. If an overlap has no such place it is doubled, and
the chunk itself grows once the overlap reaches the last splice; a document without any is encoded whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from . import common

LIMIT = 4096


class PieceCounter:
    def __init__(self, model: bytes, chunk_chars: int = 1 << 16, overlap: int = 256):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.chunk, self.overlap = chunk_chars, overlap
        self._beside: set[str] | None = None

    def beside(self) -> set[str]:
        """The pairs of characters that stand side by side in some piece."""
        if self._beside is None:
            sp = self.processor
            pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i)))
            self._beside = {p[k : k + 2] for p in pieces for k in range(len(p) - 1)}
        return self._beside

    def spans(self, text: str, start: int, end: int) -> list[int]:
        """Where each token of ``text[start:end]`` begins, in characters of the whole text."""
        part = text[start:end]
        begins = [p.begin for p in self.processor.encode(part, return_type="proto", num_threads=1).pieces]  # in bytes
        if not part.isascii():
            ahead = np.cumsum((np.frombuffer(part.encode(), np.uint8) & 0xC0) != 0x80) - 1
            begins = np.append(ahead, len(part))[begins].tolist()
        return [start + x for x in begins]

    def stable(self, text: str, at: int) -> bool:
        return text[at - 1 : at + 1].replace(" ", "▁") not in self.beside()

    def splice(self, text: str, left: list[int], right: list[int], low: int, high: int) -> int | None:
        """A proven boundary between ``low`` and ``high`` that both encodings have, the first of those nearest the middle."""
        both = {x for x in left if low < x < high} & {x for x in right if low < x < high}
        found = [x for x in both if self.stable(text, x)]
        return min(found, key=lambda x: (abs(2 * x - low - high), x), default=None)

    def count(self, text: str) -> int:
        n = len(text)
        if n <= self.chunk:
            return len(self.processor.encode(text, num_threads=1))
        total, cut, end = 0, 0, self.chunk
        begins = self.spans(text, 0, end)
        while end < n:
            overlap, at = self.overlap, None
            while at is None and end - overlap > cut:
                ahead = min(n, end + self.chunk)
                after = self.spans(text, end - overlap, ahead)
                at = self.splice(text, begins, after, end - overlap, end)
                overlap *= 2
            if at is None:
                end = min(n, end + self.chunk)
                begins = self.spans(text, cut, end) if cut == 0 else self._after(text, cut, end)
                continue
            total += sum(cut <= x < at for x in begins)
            begins, cut, end = after, at, ahead
        return total + sum(x >= cut for x in begins)

    def _after(self, text: str, cut: int, end: int) -> list[int]:
        """The encoding from the last splice on; one character before it keeps the model's prefix out of the part that counts."""
        return [x for x in self.spans(text, cut - 1, end) if x >= cut]


_counters: dict[tuple, PieceCounter] = {}


def _counter(model: bytes, *args) -> PieceCounter:
    key = (hash(model), *args)
    if key not in _counters:
        _counters.clear()
        _counters[key] = PieceCounter(model, *args)
    return _counters[key]


def count_tokens(docs: DataFrame, model_path: str, limit: int = LIMIT, chunk_chars: int = 1 << 16, overlap: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    A null text counts as empty: no bytes, no tokens. Repeated rows give a row each; an empty table gives none; other
    columns of ``docs`` are ignored, whatever their names. No shuffle; a task holds one Arrow batch of texts.
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())

    def batches(parts):
        counter = _counter(model.value, chunk_chars, overlap)
        for part in parts:
            text = part.column(1)
            n = pa.array([counter.count(x) if x else 0 for x in text.to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), pc.fill_null(pc.binary_length(text), 0).cast(pa.int64()), n, pc.greater(n, limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    view = common.docs_view(docs, id_col, text_col)
    return view.mapInArrow(batches, common.with_id(view, "n_bytes long, n_tokens long, over_limit boolean"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(common.table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
