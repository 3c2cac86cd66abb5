"""SentencePiece encoding that keeps offsets: every piece is projected to its bytes in the original text.

1. The model's normaliser is run here: at each position the longest prefix that the compiled character map knows is
   replaced, all else stays, and each output byte records the character of the source that it came from.
2. The library segments the normalised text with a copy of the model whose own normaliser does nothing, so its pieces
   tile the normalised bytes without gaps.
3. Piece ends are running sums of piece lengths; looked up in the recorded alignment they give spans of source bytes.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.bpe import _field

#: Fixed values of the model format: the sign that stands for a space, and the piece types that matter here.
SPACE_SIGN = "▁".encode()
USER_DEFINED, BYTE = 4, 6

OUTPUTS = {
    "n_tokens": ("long", pa.int64()), "ids": ("array<int>", pa.list_(pa.int32())), "ids_sha256": ("string", pa.string()),
    "spans": ("array<struct<start:int,end:int>>", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    "spans_sha256": ("string", pa.string()), "decoded": ("string", pa.string()), "decoded_sha256": ("string", pa.string()),
}


def read_fields(message: bytes) -> Iterator[tuple[int, bytes | int]]:
    """(field number, value) of one protobuf message; floats and doubles come as their bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, message[at:at + size]
            at += size


class Model:
    """What a model file says about pieces and normalisation."""

    def __init__(self, proto: bytes):
        top = list(read_fields(proto))
        self.pieces: list[tuple[str, int]] = []
        for number, value in top:
            if number == 1:
                piece = dict(read_fields(value))
                self.pieces.append((piece[1].decode(), piece.get(3, 1)))
        trainer = dict(read_fields(next((v for n, v in top if n == 2), b"")))
        rules = dict(read_fields(next((v for n, v in top if n == 3), b"")))
        self.charsmap: bytes = rules.get(2, b"")
        self.dummy_prefix, self.remove_extra, self.escape = (bool(rules.get(n, 1)) for n in (3, 4, 5))
        self.suffix = bool(trainer.get(24, 0))
        self.symbols = [p.encode() for p, kind in self.pieces if kind == USER_DEFINED]
        # the same pieces, and a normaliser that leaves its input alone
        idle = _field(3, _field(1, b"identity") + _field(2, b"") + _field(3, 0) + _field(4, 0) + _field(5, 0))
        kept = (_field(n, v) for n, v in top if n not in (3, 4))  # self tests would run through the idle normaliser
        self.segmenting = b"".join(kept) + idle


class CharacterMap:
    """The compiled map: a double-array trie over source bytes, whose values point at zero-ended replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.targets = blob[4 + size:]

    def _children(self, node: int) -> int:
        """Where the children of a node start."""
        unit = self.units[node]
        return node ^ ((unit >> 10) << ((unit & 0x200) >> 6))

    def _child(self, base: int, byte: int) -> int | None:
        node = base ^ byte
        return node if node < len(self.units) and self.units[node] & 0x800000FF == byte else None

    def longest(self, data: bytes, at: int) -> tuple[int, bytes]:
        """Length of the longest known prefix of ``data[at:]`` and what replaces it; length 0 where none is known."""
        found, base, end = (0, b""), self._children(0), at
        while end < len(data):
            node = self._child(base, data[end])
            if node is None:
                break
            end += 1
            base = self._children(node)
            if self.units[node] >> 8 & 1:
                target = self.units[base] & 0x7FFFFFFF
                found = (end - at, self.targets[target:self.targets.index(0, target)])
        return found

    def first_characters(self) -> list[str]:
        """Characters that a known prefix may start with, so that all other text is passed in bulk."""
        if not self.units:
            return []
        out, open_nodes = [], [(b"", self._children(0))]
        while open_nodes:
            begun, base = open_nodes.pop()
            for byte in range(1, 256):
                node = self._child(base, byte)
                if node is None:
                    continue
                path = begun + bytes([byte])
                try:
                    out.append(path.decode())
                except UnicodeDecodeError:
                    if len(path) < 4:
                        open_nodes.append((path, self._children(node)))
        return out


class Normaliser:
    """Normalised text, and for each of its bytes the source character it came from."""

    def __init__(self, model: Model):
        self.model, self.map = model, CharacterMap(model.charsmap)
        self.symbols = sorted(model.symbols, key=len, reverse=True)
        first = {*self.map.first_characters(), *(s.decode()[0] for s in self.symbols)}
        self.candidates = re.compile("[" + "".join(map(re.escape, sorted(first))) + "]") if first else None

    def _known(self, data: bytes, at: int) -> tuple[int, bytes]:
        for symbol in self.symbols:  # symbols the user defined pass as they are
            if data.startswith(symbol, at):
                return len(symbol), symbol
        return self.map.longest(data, at) if self.map.units else (0, b"")

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """(bytes, source character of each byte and, last, of the end)."""
        model, data = self.model, text.encode()
        raw = np.frombuffer(data, np.uint8)
        is_start = (raw & 0xC0) != 0x80
        source = np.cumsum(is_start, dtype=np.int32) - 1
        edits: dict[int, tuple[int, bytes]] = {}  # first character -> (character after it, replacement)
        if self.candidates:
            starts = np.flatnonzero(is_start)
            parts, aligned, done = [], [], 0
            for match in self.candidates.finditer(text):
                at = int(starts[match.start()])
                if at < done:
                    continue
                size, target = self._known(data, at)
                if not size:
                    continue
                edits[match.start()] = (match.start() + len(data[at:at + size].decode()), target)
                parts += [data[done:at], target]
                aligned += [source[done:at], np.full(len(target), match.start(), np.int32)]
                done = at + size
            if edits:
                data, source = b"".join([*parts, data[done:]]), np.concatenate([*aligned, source[done:]])
        first, end = 0, len(text)
        if model.remove_extra:
            while first < len(text):  # leading characters that are, or become, one space
                after, target = edits.get(first, (first + 1, text[first].encode()))
                if target != b" ":
                    break
                first = after
            spaces = np.frombuffer(data, np.uint8) == 0x20
            kept = ~(spaces & np.concatenate([[True], spaces[:-1]]))
            data, source = np.frombuffer(data, np.uint8)[kept].tobytes(), source[kept]
        if model.escape:
            source = np.repeat(source, np.where(np.frombuffer(data, np.uint8) == 0x20, 3, 1))
            data = data.replace(b" ", SPACE_SIGN)
        sign = SPACE_SIGN if model.escape else b" "
        if first == len(text):
            return b"", np.array([end], np.int32)
        if model.dummy_prefix and not model.suffix:
            data, source = sign + data, np.concatenate([np.full(len(sign), first, np.int32), source])
        while model.remove_extra and data.endswith(sign):
            end, data = int(source[len(data) - len(sign)]), data[:-len(sign)]
        source = source[:len(data)]
        if model.dummy_prefix and model.suffix:
            data, source = data + sign, np.concatenate([source, np.full(len(sign), end, np.int32)])
        return data, np.append(source, np.int32(end))


def read_text(raw: bytes | None) -> tuple[str, np.ndarray | None]:
    """A text and the source byte of each character and of the end; None where that is plain UTF-8.

    A byte that is no UTF-8 becomes U+FFFD by itself, as in the library.
    """
    raw = raw or b""
    try:
        return raw.decode(), None
    except UnicodeDecodeError:
        characters, offsets, at = [], [], 0
        while at < len(raw):
            size = next((n for n in (1, 2, 3, 4) if _is_character(raw[at:at + n])), 0)
            characters.append(raw[at:at + size].decode() if size else "�")
            offsets.append(at)
            at += size or 1
        return "".join(characters), np.array([*offsets, at])


def _is_character(raw: bytes) -> bool:
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


class Encoder:
    """Encoder and decoder of one task."""

    def __init__(self, proto: bytes):
        import sentencepiece

        model = Model(proto)
        self.normalise = Normaliser(model)
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=model.segmenting)
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.lengths = np.array([1 if kind == BYTE else len(p.encode()) for p, kind in model.pieces])
        self.unknown = self.whole.unk_id()
        self.byte_pieces = {p for p, kind in model.pieces if kind == BYTE}
        self.begin, self.end = ([i] if i >= 0 else [] for i in (self.whole.bos_id(), self.whole.eos_id()))

    def encode(self, raw: bytes | None) -> tuple[list[int], np.ndarray]:
        """Ids with begin and end, and the span of source bytes of each as rows of two."""
        text, offsets = read_text(raw)
        normal, source = self.normalise(text)
        ids = self.segmenter.encode(normal.decode())
        found = np.array(ids, np.int64)
        lengths = self.lengths[found]
        if (found == self.unknown).any():  # an unknown stretch is as long as what it stands for
            pieces = self.segmenter.encode(normal.decode(), out_type=str)
            lengths = np.array([1 if p in self.byte_pieces else len(p.encode()) for p in pieces])
        if offsets is None:
            data = np.frombuffer(raw or b"", np.uint8)
            offsets = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        edges = offsets[source[np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)]]
        spans = np.empty((len(ids) + len(self.begin) + len(self.end), 2), "<u4")
        spans[len(self.begin):len(self.begin) + len(ids), 0] = edges[:-1]
        spans[len(self.begin):len(self.begin) + len(ids), 1] = edges[1:]
        spans[:len(self.begin)] = 0
        spans[len(self.begin) + len(ids):] = len(raw or b"")
        return [*self.begin, *ids, *self.end], spans

    def decode(self, ids: Sequence[int]) -> str:
        return self.whole.decode(list(ids)) if len(ids) else ""


def encode(
    docs: DataFrame, model: str, outputs: Sequence[str] = ("n_tokens", "ids", "spans"), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode every text with begin and end ids, with the source bytes of each piece, and decode the ids again.

    ``outputs`` picks columns: n_tokens (all ids), ids, ids_sha256 (of ids as little-endian unsigned 32-bit integers),
    spans (start and end byte of each piece in the UTF-8 of the text; what a normaliser inserts or expands to is an
    empty span but for the last piece of it), spans_sha256 (of start, end, start, end, ... in the same form), decoded,
    decoded_sha256. Null text is the empty text: begin and end only. Every row gives one row, repeated ones too; other
    columns are not looked at. Bytes that are no UTF-8 count one by one as U+FFFD. An empty table gives no rows. No
    shuffle; a task holds one Arrow batch. The model is read on the driver, executors need no file.
    """
    with open(model, "rb") as file:
        shipped = docs.sparkSession.sparkContext.broadcast(file.read())  # size fixed by the model
    wanted = tuple(outputs)
    decoding = "decoded" in wanted or "decoded_sha256" in wanted
    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    schema = ", ".join([f"`{id_col}` {kind}", *(f"{o} {OUTPUTS[o][0]}" for o in wanted)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shipped.value)
        for batch in batches:
            columns: dict[str, list] = {o: [] for o in wanted}
            for raw in batch.column(1):
                ids, spans = encoder.encode(raw.as_py())
                decoded = encoder.decode(ids) if decoding else ""
                for name in wanted:
                    columns[name].append(
                        len(ids) if name == "n_tokens" else ids if name == "ids" else decoded if name == "decoded"
                        else [{"start": a, "end": b} for a, b in spans.tolist()] if name == "spans"
                        else hashlib.sha256(
                            np.array(ids, "<u4").tobytes() if name == "ids_sha256"
                            else spans.tobytes() if name == "spans_sha256" else decoded.encode()
                        ).hexdigest()
                    )
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(columns[o], OUTPUTS[o][1]) for o in wanted)], names=[id_col, *wanted])

    return docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").cast("binary").alias("_text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded text) from (id, ids); null or no ids give the empty text, an id outside the model raises."""
    with open(model, "rb") as file:
        shipped = encoded.sparkSession.sparkContext.broadcast(file.read())
    kind = encoded.select(f"`{id_col}`").schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shipped.value)
        for batch in batches:
            out = [encoder.decode(ids.as_py() or ()) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=[id_col, "decoded"])

    return encoded.select(f"`{id_col}`", f"`{ids_col}`").mapInArrow(run, f"`{id_col}` {kind}, decoded string")
