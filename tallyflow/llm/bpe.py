"""Byte-level BPE through a sentencepiece BPE model that is serialised straight from a rank file.

Bytes are mapped to printable characters, each vocabulary entry becomes a piece with score minus its rank, and the
normaliser is the identity: sentencepiece then applies the merges in rank order, as the rank file means them.
Each match of the splitting pattern is encoded by itself; ids decode by looking up their bytes.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import struct
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import in_slices, list_array

#: Texts in an Arrow batch where the encoded rows are stored; both the executor and its Python worker hold a batch whole.
TEXTS_AT_ONCE = 1_000
#: Bytes of text whose pieces are Python strings at once.
SLICE = 1 << 18
#: Pieces of at most this length are remembered by a task, at most CACHE_ENTRIES of them.
CACHED_LENGTH, CACHE_ENTRIES = 64, 100_000
#: sentencepiece looks at inputs as a whole; longer pre-tokens would still be exact, but only this many are sent at once.
ENCODE_AT_ONCE = 20_000

OUTPUTS = {
    "n_tokens": "n_tokens long", "ids": "ids array<int>", "ids_sha256": "ids_sha256 string",
    "decoded": "decoded binary", "decoded_sha256": "decoded_sha256 string",
}
_ARROW = {
    "n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "ids_sha256": pa.string(),
    "decoded": pa.binary(), "decoded_sha256": pa.string(),
}


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file with lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def byte_characters() -> list[str]:
    """A printable character for each byte: printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: bytes length-delimited, ints as varints, floats as 32 bits."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model whose ids are the ranks; the unknown piece takes the first free id after them."""
    ordered = sorted(ranks.items(), key=lambda x: x[1])
    if [rank for _, rank in ordered] != list(range(len(ordered))):
        raise ValueError("ranks must run from 0 without gaps")
    letters = byte_characters()
    pieces = [("".join(letters[b] for b in token), float(-rank), 1) for token, rank in ordered]
    pieces.append(("\ue000", 0.0, 2))  # a private-use character, which no mapped byte gives
    model = b"".join(_field(1, _field(1, p.encode()) + _field(2, score) + _field(3, kind)) for p, score, kind in pieces)
    # fixed values of the model format: BPE is model type 2; ids of special pieces; no start, end and padding pieces
    none = 2**64 - 1
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(ordered)) + _field(41, none) + _field(42, none) + _field(43, none) + _field(45, "\ue000".encode())
    normaliser = _field(1, b"identity") + _field(2, b"") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return model + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encoder and decoder of one task.

    What a piece gives is remembered by kind, as much of it as ``kinds`` names: its ids as 32-bit numbers, the same as decimals joined
    by commas (written), and the bytes that they decode to (decoded). A text's are its pieces' put together.
    """

    def __init__(self, model: bytes, tokens: Sequence[bytes], pattern: str, kinds: Sequence[str] = ("ids", "written")):
        import regex
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.tokens, self.decimals = tokens, [str(i) for i in range(self.processor.get_piece_size())]
        self.split = regex.compile(pattern).findall
        self.letters = "".join(byte_characters())
        self.cache: dict[str, dict] = {kind: {} for kind in kinds}

    def _learn(self, pieces: list[str], into: dict[str, dict]) -> None:
        for at in range(0, len(pieces), ENCODE_AT_ONCE):
            some = pieces[at:at + ENCODE_AT_ONCE]
            # all at once: a call of the library starts a thread; byte FF is in no UTF-8 and stands for itself
            mapped = codecs.charmap_decode(b"\xff".join([p.encode() for p in some]), "strict", self.letters)[0].split("\xff")
            found = self.processor.encode(mapped, num_threads=1)
            for kind, known in into.items():
                if kind == "ids":
                    made = [array("i", ids).tobytes() for ids in found]
                elif kind == "written":
                    made = [",".join([self.decimals[i] for i in ids]) for ids in found]
                else:
                    made = [b"".join([self.tokens[i] for i in ids]) for ids in found]
                known.update(zip(some, made))

    def read(self, texts: Sequence[str]) -> dict[str, list]:
        """What each text gives, by kind. Pieces that no text had before are learned together."""
        pieces, known = [self.split(text) for text in texts], self.cache
        distinct, old = set().union(*pieces), next(iter(known.values()))
        new = distinct.difference(old)
        if len(old) + len(new) > CACHE_ENTRIES:
            for table in known.values():
                table.clear()
            new = distinct
        apart = new if len(new) > CACHE_ENTRIES else {p for p in new if len(p) > CACHED_LENGTH}  # not remembered
        self._learn(list(new - apart), known)
        if apart:
            known = {kind: {p: table[p] for p in distinct - apart} for kind, table in known.items()}
            self._learn(list(apart), known)
        return {kind: [("," if kind == "written" else b"").join(map(table.__getitem__, some)) for some in pieces] for kind, table in known.items()}

    def encode(self, text: str) -> tuple[list[int], str]:
        """Ids of a text, and the same as decimals joined by commas."""
        got = self.read([text])
        return np.frombuffer(got["ids"][0], np.int32).tolist(), got["written"][0]


def tokenise(
    docs: DataFrame, vocabulary: str, pattern: str, outputs: Sequence[str] = ("n_tokens", "ids"), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode every text, without special tokens, and decode the ids again where an output asks for it.

    ``outputs`` picks columns: n_tokens, ids, ids_sha256 (of decimal ids joined by commas), decoded (bytes),
    decoded_sha256. Null text is the empty text: no ids, empty bytes. Every row gives one row, repeated ones too;
    other columns are not looked at. An empty table gives no rows. No shuffle; a task holds one Arrow batch and
    a bounded cache. The vocabulary is read on the driver, executors need no file.
    """
    ranks = read_ranks(vocabulary)
    tokens = [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]
    shipped = docs.sparkSession.sparkContext.broadcast((serialise(ranks), tokens))  # size fixed by the vocabulary
    wanted = tuple(outputs)
    kinds = [kind for kind, some in (("ids", ("ids",)), ("written", ("ids_sha256", "n_tokens")), ("decoded", ("decoded", "decoded_sha256"))) if {*some} & {*wanted}]
    fields = docs.select(F.col(f"`{id_col}`").alias(id_col)).schema
    schema = ", ".join([f"`{id_col}` {fields[0].dataType.simpleString()}", *(OUTPUTS[o] for o in wanted)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shipped.value, pattern, kinds)
        make = {
            "n_tokens": ("written", lambda ids: ids.count(",") + 1 if ids else 0), "ids": ("ids", lambda ids: np.frombuffer(ids, np.int32)),
            "ids_sha256": ("written", lambda ids: hashlib.sha256(ids.encode()).hexdigest()),
            "decoded": ("decoded", lambda text: text), "decoded_sha256": ("decoded", lambda text: hashlib.sha256(text).hexdigest()),
        }
        for batch in (part for whole in batches for part in in_slices(whole, 1, SLICE)):
            got = codec.read([text or "" for text in batch.column(1).to_pylist()])
            columns = {o: [make[o][1](value) for value in got[make[o][0]]] for o in wanted}
            made = (list_array(columns[o], pa.int32()) if o == "ids" else pa.array(columns[o], _ARROW[o]) for o in wanted)
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=[id_col, *wanted])

    return docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("_text")).mapInArrow(run, schema)


def detokenise(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded bytes) from (id, ids); null ids give empty bytes, an id outside the vocabulary raises."""
    tokens = [t for t, _ in sorted(read_ranks(vocabulary).items(), key=lambda x: x[1])]
    shipped = encoded.sparkSession.sparkContext.broadcast(tokens)
    kind = encoded.select(id_col).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shipped.value
        for batch in batches:
            out = [b"".join(map(table.__getitem__, ids.as_py() or ())) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=[id_col, "decoded"])

    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, decoded binary")
