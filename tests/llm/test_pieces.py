"""SentencePiece ids and spans against the library, for the given model and for models with other normalisers."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
import sentencepiece

from tallyflow.llm import pieces
from tallyflow.llm.bpe import _field

MODEL = public_tokenizers.path("piece_bpe_32k.model")
HARD = [
    "", " ", "   ", "\n\n  \t x", "a" * 5000, " " * 300, "▁a ▁▁ b", "naïve — 東京 ñ ß", "\x00\x01�", "<unk> <s> </s> <0x41>", "🤖👩‍👩‍👧 ok ",
    "Ａ㍿ ﬁé", " leading and trailing ", "\r\n\x85\xa0 x", "\U0010ffff", "word " * 3000,
]
ALPHABET = list("ab cd  e▁ 　\tＡ㍿ﬁé́\x00​\x07漢字ｶﾞ¨ ½\U0001f600�한가")


def variant(rule="identity", prefix=1, extra=0, suffix=0, fallback=True, symbols=()):
    """The given model with another normaliser; its compiled map comes from the library."""
    compiled = b""
    if rule != "identity":
        compiled = dict(pieces.read_fields(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec()))[2]
    out, seen = b"", 0
    with open(MODEL, "rb") as file:
        for number, value in pieces.read_fields(file.read()):
            if number == 3:
                value = _field(1, rule.encode()) + _field(2, compiled) + _field(3, prefix) + _field(4, extra) + _field(5, 1)
            if number == 2:
                value += (_field(24, 1) if suffix else b"") + (b"" if fallback else _field(35, 0))
            if number == 1:
                piece = dict(pieces.read_fields(value))
                seen += 1
                if not fallback and piece.get(3) == 6:
                    value = _field(1, piece[1]) + piece_score(0.0) + _field(3, 5)
                if piece[1].decode() in symbols:
                    value = _field(1, piece[1]) + piece_score(0.0) + _field(3, 4)
            out += _field(number, value)
    assert seen == 32_000
    return out


def piece_score(score):
    return bytes([2 << 3 | 5]) + struct.pack("<f", score)


def library(processor, text):
    found = processor.encode(text, return_type="proto")
    return processor.encode(text, add_bos=True, add_eos=True), [(p.begin, p.end) for p in found.pieces]


@pytest.mark.parametrize("rule", ["identity", "nfkc", "nmt_nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize(("prefix", "extra", "suffix"), [(1, 0, 0), (1, 1, 0), (0, 1, 0), (0, 0, 0), (1, 1, 1), (1, 0, 1)])
def test_ids_and_spans_agree_with_the_library(rule, prefix, extra, suffix):
    model = variant(rule, prefix, extra, suffix)
    encoder, processor = pieces.Encoder(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    pick = random.Random(prefix * 4 + extra * 2 + suffix)
    for text in HARD + ["".join(pick.choices(ALPHABET, k=pick.randrange(14))) for _ in range(150)]:
        ids, spans = encoder.encode(text.encode())
        want, offsets = library(processor, text)
        assert ids == want
        assert [tuple(s) for s in spans.tolist()][1:-1] == offsets


def test_models_without_byte_pieces_and_with_symbols():
    for model in (variant(fallback=False), variant("nfkc", symbols=("ing", "▁the"))):
        encoder, processor = pieces.Encoder(model), sentencepiece.SentencePieceProcessor(model_proto=model)
        for text in HARD + ["漢漢 sing the king 가가a", "ﬁing▁the"]:
            ids, spans = encoder.encode(text.encode())
            want, offsets = library(processor, text)
            assert ids == want
            assert [tuple(s) for s in spans.tolist()][1:-1] == offsets


def test_rows(spark):
    texts = [*HARD, None]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "'x' AS _text", "2 AS spans")
    out = pieces.encode(docs, MODEL, tuple(pieces.OUTPUTS)).collect()
    assert len(out) == len(rows)
    processor = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = {i: t or "" for i, t in rows}
    for row in out:
        text = want[row.doc_id]
        ids = processor.encode(text, add_bos=True, add_eos=True)
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row.decoded == processor.decode(ids) and row.decoded_sha256 == hashlib.sha256(row.decoded.encode()).hexdigest()
        flat = [x for s in row.spans for x in (s.start, s.end)]
        assert row.spans_sha256 == hashlib.sha256(struct.pack(f"<{len(flat)}I", *flat)).hexdigest()
        assert [s.start for s in row.spans[1:]] == [s.end for s in row.spans[:-1]]  # pieces tile the text
    back = pieces.decode(pieces.encode(docs.filter("doc_id = 7"), MODEL), MODEL).first()
    assert back.decoded == want[7]


def test_bytes_that_are_no_text(spark):
    docs = spark.createDataFrame([(1, bytearray(b"ab\xff\xfe c\xe6\xbc d"))], "doc_id long, raw binary").selectExpr("doc_id", "CAST(raw AS STRING) AS text")
    row = pieces.encode(docs, MODEL).first()
    assert row.ids == sentencepiece.SentencePieceProcessor(model_file=MODEL).encode("ab�� c�� d", add_bos=True, add_eos=True)
    assert (row.spans[-1].start, row.spans[-1].end) == (10, 10) and row.spans[2].start == 2 and row.spans[2].end == 3


def test_no_rows(spark):
    assert pieces.encode(spark.createDataFrame([], "doc_id long, text string"), MODEL).count() == 0
