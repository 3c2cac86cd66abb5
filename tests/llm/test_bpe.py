"""Byte-level BPE against tiktoken on the same ranks, and as an exact round trip."""

import hashlib
import random

import pytest
import tiktoken

from tallyflow.llm import bpe
from tallyflow.llm.queries import split_pattern, vocabulary_path

HARD = [
    "", " ", "\n\n  \t x", "don't DON'T it's", "naïve café — 東京 ñandú ß", "\x00\x01�▁", "a" * 5000, " " * 3000, "1234567890" * 50,
    "🤖👩‍👩‍👧 ok", "<unk> <s> </s> <|endoftext|>", "\r\n\x85\xa0 x", "\U0010ffff", "word " * 2000,
]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=split_pattern(), mergeable_ranks=bpe.read_ranks(vocabulary_path()), special_tokens={})


def texts():
    pick = random.Random(5)
    letters = [chr(c) for c in (*range(0x20, 0x250), 0x3042, 0x4E2D, 0x1F600, 0x0661, 0x0905, 0xAC00)]
    return HARD + ["".join(pick.choices(letters, k=pick.randrange(400))) for _ in range(60)]


def test_ids_and_bytes_agree_with_tiktoken(spark, reference):
    rows = [(i, t) for i, t in enumerate(texts())] + [(-1, None), (3, texts()[3]), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "'x' AS _text", "2 AS n_tokens")
    out = bpe.tokenise(docs, vocabulary_path(), split_pattern(), ("n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256")).collect()
    assert len(out) == len(rows)
    want = {i: t or "" for i, t in rows}
    for row in out:
        text = want[row.doc_id]
        ids = reference.encode_ordinary(text)
        assert row.ids == ids and row.n_tokens == len(ids)
        assert bytes(row.decoded) == text.encode()
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_decoding_by_itself(spark):
    docs = spark.createDataFrame([(1, "Ein Test, née ça"), (2, None)], "doc_id long, text string")
    encoded = bpe.tokenise(docs, vocabulary_path(), split_pattern())
    back = {r.doc_id: bytes(r.decoded).decode() for r in bpe.detokenise(encoded, vocabulary_path()).collect()}
    assert back == {1: "Ein Test, née ça", 2: ""}


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.tokenise(empty, vocabulary_path(), split_pattern()).count() == 0


def test_gaps_in_ranks_are_refused():
    with pytest.raises(ValueError):
        bpe.serialise({b"a": 0, b"b": 2})


def test_every_white_space_character_splits_as_the_pattern_says(reference):
    codec = bpe.Codec(bpe.serialise(bpe.read_ranks(vocabulary_path())), [], split_pattern())
    text = "".join(f"a{chr(c)}b{chr(c)}{chr(c)}c" for c in range(0x3001) if not 0xD800 <= c < 0xE000)
    assert codec.encode(text)[0] == reference.encode_ordinary(text)


@pytest.mark.parametrize("entries, length", [(100_000, 64), (300, 4), (3, 64)])
def test_new_pieces_of_many_texts_are_encoded_in_one_call(reference, monkeypatch, entries, length):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", entries)
    monkeypatch.setattr(bpe, "CACHED_LENGTH", length)
    ranks = bpe.read_ranks(vocabulary_path())
    codec = bpe.Codec(bpe.serialise(ranks), sorted(ranks, key=ranks.get), split_pattern(), ("ids", "written", "decoded"))
    calls, encode = [], codec.processor.encode
    codec.processor.encode = lambda pieces, **settings: calls.append(pieces) or encode(pieces, **settings)
    for some in (texts(), texts()[20:] + ["one word more \x7f\xa0\xad"], ["", ""], texts()[::-1]):
        before, got = len(calls), codec.read(some)
        assert [list(memoryview(x).cast("i")) for x in got["ids"]] == [reference.encode_ordinary(t) for t in some]
        assert got["written"] == [",".join(map(str, reference.encode_ordinary(t))) for t in some] and got["decoded"] == [t.encode() for t in some]
        assert len(calls) - before <= 2  # those to remember and the others
        assert all(len(table) <= entries and max(map(len, table), default=0) <= length for table in codec.cache.values())
    assert entries < 100_000 or len(codec.cache["ids"]) > 1000
