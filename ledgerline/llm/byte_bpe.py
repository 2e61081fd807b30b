"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

Encoding. A sequence of tokens is the encoding of its bytes exactly if every token encodes to itself and every two
neighbours together encode to just these two: the first merge across a border would also happen with the pair alone.
So a nondeterministic machine that walks a trie of the tokens, may end a token at any terminal, and admits a token only
beside a neighbour it agrees with, has one accepting run for each input. It is determinised as bytes are read: a state is
the set of live runs. No run reaches back further than the longest token, so tokens before that are settled and come out
after a bounded lookahead. Transitions are kept; the table is dropped when full.

Decoding joins token bytes block by block; an incremental UTF-8 machine emits whole characters and carries the rest.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from . import common


def load_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


def merge(ranks: dict[bytes, int], piece: bytes, least: int = 1, made: list | None = None) -> list[int]:
    """Plain merging, lowest rank first and leftmost among equals, until ``least`` parts are left; used on the bytes of one
    or two tokens only. ``made`` gets the ranks as they come."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > least:
        at, best = -1, None
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                at, best = i, rank
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if made is not None:
            made.append(best)
    return [ranks[p] for p in parts]


class Transducer:
    """Reads bytes; ``encode`` gives tokens.

    A run is (its last whole token, its place in the trie), packed into one integer. The encoding of each prefix is
    unique, so a state needs no outputs: with each byte the machine says which token, if any, ends the encoding of the
    prefix read so far, and the tokens are had by walking back from any place that all live runs have passed.
    """

    ROOT, BITS = 0, 24

    def __init__(self, ranks: dict[bytes, int], max_states: int = 100_000, commit: int = 1024, few: int = 24):
        self.ranks, self.max_states, self.commit = ranks, max_states, commit
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        self.depth: list[int] = [0]
        for token, rank in ranks.items():
            node = 0
            for b in token:
                nxt = self.children[node].get(b)
                if nxt is None:
                    nxt = self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = nxt
            self.ends[node] = rank
        self.few, self.below = few, [0] * len(self.ends)  # tokens below each place
        for node in range(len(self.ends) - 1, -1, -1):
            self.below[node] = sum(self.below[x] + (self.ends[x] >= 0) for x in self.children[node].values())
        self.reduced: dict[int, int] = {}
        self.sound: dict[int, bool] = {}
        self.ordered: set[int] = set()  # sound tokens whose merges come in the order of their ranks
        self.halves: dict[int, list[int]] = {}
        self._reset()

    def _reset(self) -> None:
        start = (self.ROOT,)  # no token before: packed with 0, tokens with their number + 1
        self.runs: list[tuple] = [start]
        self.number: dict[tuple, int] = {start: 0}
        self.next: list[dict[int, tuple[int, int]]] = [{}]

    def _is_sound(self, token: int) -> bool:
        known = self.sound.get(token)
        if known is None:
            made: list[int] = []
            known = self.sound[token] = merge(self.ranks, self.bytes_of[token], made=made) == [token]
            if known and made == sorted(made):
                self.ordered.add(token)
        return known

    def _half(self, token: int, which: int) -> int:
        known = self.halves.get(token)
        if known is None:
            known = self.halves[token] = merge(self.ranks, self.bytes_of[token], 2)
        return known[which]

    def _agree(self, left: int, right: int) -> bool:
        """Whether the bytes of two sound tokens encode to just these two.

        Where merges come in the order of their ranks, they are undone from the last: the halves that then meet at the
        border must not have a merge of their own that would have come before the one undone. Of equal ranks the left one
        comes first. Single bytes come from no merge.
        """
        ranks, bytes_of, limit = self.ranks, self.bytes_of, 1 << 62
        if left not in self.ordered or right not in self.ordered:
            return merge(ranks, bytes_of[left] + bytes_of[right]) == [left, right]
        while True:
            a, b = bytes_of[left], bytes_of[right]
            joined = ranks.get(a + b)
            if joined is not None and joined < limit:
                return False
            if len(a) > 1 and (left > right or len(b) == 1):
                limit, left = left, self._half(left, 1)
            elif len(b) > 1:
                limit, right = right + 1, self._half(right, 0)
            else:
                return True

    def _determinise(self, state: int, byte: int) -> tuple[int, int]:
        """The state after ``byte``, and the token that ends there or -1."""
        moved, ending, mask = [], -1, (1 << self.BITS) - 1
        children, ends, below, few, reduced = self.children, self.ends, self.below, self.few, self.reduced
        for run in self.runs[state]:
            node = children[run & mask].get(byte)
            if node is not None:
                last = run >> self.BITS
                if children[node]:
                    run = last << self.BITS | node
                    if last and 0 < below[node] <= few:
                        key = reduced.get(run)
                        run = self._reduce(run, last, node) if key is None else key
                    if run:
                        moved.append(run)
                token = ends[node]
                if token >= 0 and ending < 0 and self._is_sound(token) and (not last or self._agree(last - 1, token)):
                    ending = token
                    moved.append(token + 1 << self.BITS)
        if not moved:
            raise ValueError(f"byte {byte} is in no token")
        moved.sort()
        runs = tuple(moved)
        to = self.number.get(runs)
        if to is None:
            to = self.number[runs] = len(self.runs)
            self.runs.append(runs)
            self.next.append({})
        self.next[state][byte] = found = (to, ending)
        return found

    def _reduce(self, run: int, last: int, node: int) -> int:
        """``run`` without its last token if that agrees with all tokens that may follow here, 0 if with none."""
        if len(self.reduced) > 500_000:
            self.reduced.clear()
        agree, nodes = set(), [*self.children[node].values()]
        while nodes and len(agree) < 2:
            token = self.ends[at := nodes.pop()]
            if token >= 0:
                agree.add(self._is_sound(token) and self._agree(last - 1, token))
            nodes += self.children[at].values()
        self.reduced[run] = found = run if len(agree) > 1 else node if True in agree else 0
        return found

    def _back(self, endings: list[int], at: int) -> list[int]:
        out = []
        while at:
            token = endings[at - 1]
            out.append(token)
            at -= len(self.bytes_of[token])
        out.reverse()
        return out

    def encode(self, piece: bytes) -> list[int]:
        """The tokens of ``piece``, a match of the splitting pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.runs) > self.max_states:
            self._reset()
        state, done, endings, table = 0, [], [], self.next
        for start in range(0, len(piece), self.commit):
            if start:
                keep = self._passed(state, endings)
                done += self._back(endings, keep)
                del endings[:keep]
            for byte in piece[start : start + self.commit]:
                state, token = table[state].get(byte) or self._determinise(state, byte)
                endings.append(token)
        if endings and endings[-1] < 0:
            raise ValueError("bytes that no token sequence covers")
        return done + self._back(endings, len(endings))

    def _passed(self, state: int, endings: list[int]) -> int:
        """The last border that every live run has passed: what comes next cannot change the tokens before it."""
        mask = (1 << self.BITS) - 1
        paths = []
        for run in self.runs[state]:
            at, path = len(endings) - self.depth[run & mask], set()
            while at:
                path.add(at)
                at -= len(self.bytes_of[endings[at - 1]])
            paths.append(path)
        return max(set.intersection(*paths), default=0)


class Utf8Stream:
    """Emits whole characters of a stream of bytes; the bytes of an unfinished one are the state."""

    def __init__(self):
        self.pending = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many bytes at the end begin a character that is not complete."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead < 0x80:
                return 0
            if lead >= 0xC0:
                need = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                return back if back < need else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.pending + data
        keep = self.unfinished(data)
        self.pending = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.pending = self.pending, b""
        return rest.decode("utf-8", "replace")


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str, max_pieces: int = 200_000):
        self.transducer = Transducer(ranks)
        self.bytes_of = self.transducer.bytes_of
        self.split = regex.compile(pattern).findall
        self.known: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}  # the full cache before this one, so that frequent pieces stay known
        self.max_pieces = max_pieces

    def encode(self, text: str) -> list[int]:
        known, older, out = self.known, self.older, []
        for piece in self.split(text):
            ids = known.get(piece)
            if ids is None:
                ids = older.get(piece)
                if ids is None:
                    ids = self.transducer.encode(piece.encode())
                if len(piece) <= 64:
                    if 2 * len(known) >= self.max_pieces:
                        self.older, self.known = older, known = known, {}
                    known[piece] = ids
            out += ids
        return out

    def decode_bytes(self, ids: list[int], block: int = 8192) -> Iterator[bytes]:
        for i in range(0, len(ids), block):
            yield b"".join(map(self.bytes_of.__getitem__, ids[i : i + block]))

    def decode(self, ids: list[int]) -> Iterator[str]:
        stream = Utf8Stream()
        for data in self.decode_bytes(ids):
            yield stream.feed(data)
        yield stream.finish()


_codecs: dict[tuple, Codec] = {}


def _codec(data: bytes, pattern: str) -> Codec:
    key = (hash(data), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(load_ranks(data), pattern)
    return _codecs[key]


def _ranks(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _digest(chunks: Iterable[bytes]) -> str:
    digest = hashlib.sha256()
    for data in chunks:
        digest.update(data)
    return digest.hexdigest()


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids; with ``decoded`` also decoded_sha256, of the bytes the ids decode to. Null texts count as empty and give no ids; repeated rows give a row each. An empty table gives no rows; other columns are ignored, whatever their names."""
    ranks, view = _ranks(docs.sparkSession, ranks_path), common.docs_view(docs, id_col, text_col)

    def batches(parts: Iterable[pa.RecordBatch]):
        codec = _codec(ranks.value, pattern)
        for part in common.sliced(parts):
            ids = pa.array([codec.encode(x or "") for x in part.column(1).to_pylist()], pa.list_(pa.int32()))
            columns = [part.column(0), pa.array(ids.value_lengths(), pa.int64()), ids]
            if decoded:
                columns.append(pa.array([_digest(codec.decode_bytes(x.as_py())) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "decoded_sha256"][: len(columns)])

    return view.mapInArrow(batches, common.with_id(view, "n_tokens long, ids array<int>" + ", decoded_sha256 string" * decoded))


def decode(encoded: DataFrame, ranks_path: str, pattern: str = "", id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row of ``encoded``: doc_id, text. Null or no ids give an empty text; bytes that are no UTF-8 give U+FFFD; repeated rows give a row each. An empty table gives no rows; other columns are ignored, whatever their names."""
    ranks = _ranks(encoded.sparkSession, ranks_path)
    view = encoded.select(encoded[id_col].alias("doc_id"), encoded[ids_col].alias("ids"))

    def batches(parts):
        codec = _codec(ranks.value, pattern)
        for part in common.sliced(parts):
            texts = pa.array(["".join(codec.decode(ids or [])) for ids in part.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([part.column(0), texts], names=["doc_id", "text"])

    return view.mapInArrow(batches, common.with_id(view, "text string"))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256, decoded_chars.

    Encodes each text and decodes its ids again. A null text counts as empty: no ids, and the digests of nothing.
    Repeated rows give a row each; an empty table gives none; other columns are ignored. No shuffle.
    """
    ranks, view = _ranks(docs.sparkSession, ranks_path), common.docs_view(docs, id_col, text_col)

    def batches(parts):
        codec = _codec(ranks.value, pattern)
        for part in common.sliced(parts):
            rows: tuple[list, list, list, list] = ([], [], [], [])
            for text in part.column(1).to_pylist():
                ids = codec.encode(text or "")
                decoded, stream, chars = hashlib.sha256(), Utf8Stream(), 0
                for data in codec.decode_bytes(ids):
                    decoded.update(data)
                    chars += len(stream.feed(data))
                chars += len(stream.finish())
                for column, value in zip(rows, (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), decoded.hexdigest(), chars)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string()), pa.array(rows[3], pa.int64())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "decoded_chars"])

    return view.mapInArrow(batches, common.with_id(view, "n_tokens long, ids_sha256 string, decoded_sha256 string, decoded_chars long"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
