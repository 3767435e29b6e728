"""SentencePiece encoding that keeps where every piece came from, and decoding.

The model's normaliser is read from the model file: its compiled character map is
a double-array trie of rules. A text is normalised by the longest rule that
matches at each place, and every byte written records the source byte it stems
from. Pieces follow one another in the normalised text, so the running sum of
their lengths, looked up in that record, gives the bytes of the original text that
each piece stands for.

Segmentation and decoding are the library's, with no sampling.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from larder.llm.common import slices

_SPACE = "▁".encode()
_PIECE = model_pb2.ModelProto.SentencePiece
#: Text bytes that are encoded at a time.
ENCODE_BYTES = 1 << 20


class CharacterMap:
    """The compiled rules of a normaliser: longest-prefix lookup in their double-array trie."""

    def __init__(self, blob: bytes):
        self.units: tuple[int, ...] = ()
        self.starts = frozenset()
        if blob:
            size = struct.unpack_from("<I", blob)[0]
            self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
            self.values = blob[4 + size :]
            self.starts = frozenset(b for b in range(1, 256) if self._child(self._base(0), b) is not None)

    def _base(self, at: int) -> int:
        unit = self.units[at]
        return at ^ ((unit >> 10) << ((unit & 0x200) >> 6))

    def _child(self, base: int, byte: int) -> int | None:
        at = base ^ byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else None

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest rule that matches at a place."""
        if not self.units or raw[at] not in self.starts:
            return None
        base, found = self._base(0), None
        for i in range(at, len(raw)):
            node = self._child(base, raw[i])
            if node is None:
                break
            base = self._base(node)
            if self.units[node] & 0x100:
                found = i + 1 - at, self.units[base] & 0x7FFFFFFF
        if found is None:
            return None
        length, value = found
        return length, self.values[value : self.values.index(b"\0", value)]


def _width(lead: int) -> int:
    """Bytes of the UTF-8 character that a byte begins."""
    return 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Normaliser:
    """Normalises UTF-8 and records, per byte written and for the end, the source byte."""

    def __init__(self, proto: model_pb2.ModelProto):
        spec = proto.normalizer_spec
        self.rules = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.trim, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.suffix = proto.trainer_spec.treat_whitespace_as_suffix
        own = [p.piece.encode() for p in proto.pieces if p.type == _PIECE.USER_DEFINED]
        self.own = sorted(own, key=len, reverse=True)
        self.space = _SPACE if self.escape else b" "

    def __call__(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        if not raw:
            return b"", np.zeros(1, np.int64)
        if self.rules.units or self.own or self.trim or self.suffix:
            return self._by_rules(raw)
        # nothing changes but spaces
        data = np.frombuffer(raw, np.uint8)
        places = np.arange(len(data))
        leads = np.maximum.accumulate(np.where((data & 0xC0) != 0x80, places, 0))
        widths = np.where(data == 0x20, len(self.space), 1)
        front = len(self.space) if self.prefix else 0
        source = np.concatenate([np.zeros(front, np.int64), np.repeat(leads, widths), [len(data)]])
        return (self.space if self.prefix else b"") + raw.replace(b" ", self.space), source

    def _step(self, raw: bytes, at: int) -> tuple[int, bytes]:
        for piece in self.own:
            if raw.startswith(piece, at):
                return len(piece), piece
        found = self.rules.longest(raw, at)
        if found is None:
            width = _width(raw[at])
            return width, raw[at : at + width]
        return found

    def _by_rules(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        at, out, source = 0, bytearray(), []

        def write(text: bytes, place: int) -> None:
            out.extend(text)
            source.extend([place] * len(text))

        while self.trim and at < len(raw):
            width, text = self._step(raw, at)
            if text != b" ":
                break
            at += width
        if at == len(raw):
            return b"", np.array([at])
        if self.prefix and not self.suffix:
            write(self.space, at)
        after_space = self.trim
        while at < len(raw):
            width, text = self._step(raw, at)
            if after_space:
                text = text.lstrip(b" ")
            if text:
                write(text.replace(b" ", self.space), at)
                after_space = text.endswith(b" ")
            at += width
            after_space = after_space and self.trim
        if self.trim:
            while out.endswith(self.space):
                del out[-len(self.space) :]
                at = source[len(out)]
                del source[len(out) :]
        if self.prefix and self.suffix:
            write(self.space, at)
        return bytes(out), np.array([*source, at])


@dataclass(frozen=True)
class PieceModel:
    """A model file's bytes; what is made from them is made once per process."""

    raw: bytes

    @classmethod
    def load(cls, path: str) -> PieceModel:
        with open(path, "rb") as f:
            return cls(f.read())

    def __getstate__(self) -> dict:
        return {"raw": self.raw}

    @cached_property
    def processor(self) -> sentencepiece.SentencePieceProcessor:
        return sentencepiece.SentencePieceProcessor(model_proto=self.raw)

    @cached_property
    def normaliser(self) -> Normaliser:
        return Normaliser(self._proto)

    @cached_property
    def _proto(self) -> model_pb2.ModelProto:
        proto = model_pb2.ModelProto()
        proto.ParseFromString(self.raw)
        return proto

    @cached_property
    def widths(self) -> np.ndarray:
        """Normalised bytes of each piece: none of a control piece, one of a byte piece, -1 of the unknown piece."""
        special = {_PIECE.CONTROL: 0, _PIECE.BYTE: 1, _PIECE.UNKNOWN: -1}
        return np.array([special.get(p.type, len(p.piece.encode())) for p in self._proto.pieces])

    def spans(self, text: str, ids: np.ndarray, ends: bool) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last source byte of each piece.

        A character in several byte pieces belongs to the last of them; begin and end
        marks stand for no bytes, before the first and after the last piece.
        """
        normal, source = self.normaliser(text.encode())
        widths = self.widths[ids]
        if (widths < 0).any():
            pieces = self.processor.encode(text, out_type=str)
            inner = slice(1, -1) if ends else slice(None)
            widths[inner] = np.where(widths[inner] < 0, [len(p.encode()) for p in pieces], widths[inner])
        stops = np.cumsum(widths)
        if (stops[-1] if len(stops) else 0) != len(normal):
            raise ValueError("the pieces don't add up to the normalised text")
        return source[stops - widths], source[stops]


ENCODED = (("ids", "array<int>"), ("begins", "array<int>"), ("ends", "array<int>"))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def encode_batch(model: PieceModel, texts: list[str | None], ends: bool = True) -> dict[str, pa.Array]:
    """Ids and source spans of each text; null counts as empty."""
    texts = [t or "" for t in texts]
    ids = [np.array(x, np.int32) for x in model.processor.encode(texts, num_threads=1, add_bos=ends, add_eos=ends)]
    spans = [model.spans(t, x, ends) for t, x in zip(texts, ids)]
    return {"ids": _lists(ids), "begins": _lists([b for b, _ in spans]), "ends": _lists([e for _, e in spans])}


def decode_batch(model: PieceModel, ids: pa.Array) -> list[str]:
    """The texts of lists of ids; marks leave nothing."""
    values, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
    return [model.processor.decode(values[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:])]


def _encode_rows(shared, ends: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, most=ENCODE_BYTES):
            made = encode_batch(shared.value, part.column("text").to_pylist(), ends)
            rest = [c for c in part.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([part.column(c) for c in rest] + list(made.values()), names=rest + list(made))


def encoded(docs: DataFrame, model: PieceModel, ends: bool = True) -> DataFrame:
    """``docs`` with ``ids``, ``begins`` and ``ends`` in place of ``text``: a pass over the rows, no shuffle.

    Other columns called so are replaced. Null texts are empty: only the two marks, if asked for.
    """
    made = [name for name, _ in ENCODED]
    rows = docs.drop(*made)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]
    schema = ", ".join(kept + [f"{n} {t}" for n, t in ENCODED])
    return rows.mapInArrow(partial(_encode_rows, shared, ends), schema)


def decoded(rows: DataFrame, model: PieceModel) -> DataFrame:
    """``rows`` with the ``text`` of their ``ids``, the inverse of ``encoded`` up to normalisation; null ids give null."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else shared.value.processor.decode(x) for x in batch.column("ids").to_pylist()]
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + [pa.array(texts, pa.string())], names=rest + ["text"])

    return rows.mapInArrow(run, ", ".join(kept + ["text string"]))


DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, covered_bytes long"


def _digest_rows(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = shared.value
    for batch in batches:
        for part in slices(batch, most=ENCODE_BYTES):
            made = encode_batch(model, part.column("text").to_pylist())
            values, at = made["ids"].values.to_numpy(), made["ids"].offsets.to_numpy()
            width = made["ends"].values.to_numpy() - made["begins"].values.to_numpy()
            covered = np.concatenate([[0], np.cumsum(width)])
            sha = lambda raw: hashlib.sha256(raw).hexdigest()
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"),
                "n_tokens": pa.array(np.diff(at).astype(np.int64)),
                "ids_sha256": [sha(values[a:b].astype("<u4").tobytes()) for a, b in zip(at[:-1], at[1:])],
                "decoded_sha256": [sha(t.encode()) for t in decode_batch(model, made["ids"])],
                "covered_bytes": pa.array((covered[at[1:]] - covered[at[:-1]]).astype(np.int64)),
            })


def encoding_report(docs: DataFrame, model: PieceModel) -> DataFrame:
    """Digests of what ``encoded`` and ``decoded`` give for each row, made where the ids are, without shipping them.

    ``covered_bytes`` adds up the source bytes of all pieces' spans.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(partial(_digest_rows, shared), DIGEST_SCHEMA)
