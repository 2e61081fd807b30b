"""Token counts and byte-level BPE against the libraries."""

import random

import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from ledgerline.llm import byte_bpe, token_counts

ALPHABET = "aaab  \n\t.,é漢字🙂ßabcdefthe1290\x00▁ <s>"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def texts(n, longest, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def codec():
    with open(RANKS, "rb") as f:
        return byte_bpe.Codec(byte_bpe.load_ranks(f.read()), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.transducer.ranks, special_tokens={})


def test_chunks_are_spliced_as_the_whole():
    with open(MODEL, "rb") as f:
        data = f.read()
    counter, whole = token_counts.PieceCounter(data, 64, 8), sentencepiece.SentencePieceProcessor(model_proto=data)
    cases = texts(600, 600) + ["a" * 5000, "ab" * 3000, "the " * 3000, " " * 3000, "x " * 100 + "q" * 500 + " y" * 300, "", " ", "<s></s><0x0A>" * 20]
    assert [counter.count(t) for t in cases] == [len(whole.encode(t)) for t in cases]


def test_encoding_equals_the_library(codec, library):
    cases = texts(800, 80, 2) + ["a" * 5000, "ab" * 3000, "é" * 3000, "th" * 4000, "🙂" * 500, "=-" * 500, "", "\n\n  x"]
    assert [codec.encode(t) for t in cases] == [library.encode_ordinary(t) for t in cases]


def test_small_state_table_changes_nothing(codec, library):
    small = byte_bpe.Transducer(codec.transducer.ranks, max_states=20, commit=16)
    for word in ("transubstantiation" * 9, "eeeethethe", "xyzzyx" * 30, "ababbabaab" * 40):
        assert small.encode(word.encode()) == library.encode_ordinary(word)


def test_decoding_streams_whole_characters(codec):
    stream, out = byte_bpe.Utf8Stream(), ""
    for b in "a漢é🙂z".encode():
        out += stream.feed(bytes([b]))
        assert "�" not in out
    assert out + stream.finish() == "a漢é🙂z"
    stream = byte_bpe.Utf8Stream()
    assert stream.feed(b"a\xf0\x9f") + stream.finish() == "a�"
    for t in texts(100, 200, 3):
        assert "".join(codec.decode(codec.encode(t))) == t


def test_frames(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Hello  wörld\n", "x"), (3, "Hello  wörld\n", "x"), (None, "word " * 5000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    with open(MODEL, "rb") as f:
        whole = sentencepiece.SentencePieceProcessor(model_proto=f.read())
    counted = token_counts.count_tokens(docs, MODEL, chunk_chars=1000).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in counted) == sorted(
        (i or 0, len((t or "").encode()), n := len(whole.encode(t or "")), n > 4096) for i, t, _ in rows
    )
    trip = byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.decoded_chars) for r in trip) == sorted((i or 0, len(library.encode_ordinary(t or "")), len(t or "")) for i, t, _ in rows)
    ids = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    back = byte_bpe.decode(ids, RANKS).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((i or 0, t or "") for i, t, _ in rows)
    empty = docs.where("false")
    assert token_counts.count_tokens(empty, MODEL).count() == 0
    assert byte_bpe.round_trip(empty, RANKS, public_tokenizers.PATTERN).count() == 0
