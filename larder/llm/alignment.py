"""Alignment of two tokenizers by an inverted index of id pairs.

1. Each text is encoded by both tokenizers. The byte offsets where tokens of both end
   cut it into groups; each occurrence of an A id is linked with each of a B id in its
   group.
2. Texts are taken in blocks of a task. Per block and id pair the index holds the texts
   of the block that have the pair linked as compressed bitmaps: plane k holds the
   texts whose number of such links has bit k. Their union is the set of texts, so
   its population count is the number of documents, and the planes' counts weighted by
   powers of two are the number of links.
3. Counts of a pair are added up over the blocks; only numbers travel, not bitmaps.
4. The postings return scores: each block meets the corpus-wide counts of its pairs, and
   its planes deal them out to its texts.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from larder.llm.common import slices
from larder.plans.lineage import pin

#: The split of a text before its merges, as the byte-level tokenizer's file has it by name.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Postings (pair and text) after which a block ends, and texts at most.
BLOCK_POSTINGS = 2_000_000
BLOCK_TEXTS = 1 << 16
#: Links of a group that are listed one by one; larger groups are counted by distinct ids.
LISTED = 4096
_ID_BITS = 32


# Tokenizers ------------------------------------------------------------------------

def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


@dataclass(frozen=True)
class ByteTokens:
    """A byte-level BPE of which each merge's rank is that of its result's id."""

    ids: dict[bytes, int]

    @classmethod
    def load(cls, path: str) -> ByteTokens:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        alphabet = byte_alphabet()
        decoded = {bytes(alphabet[c] for c in entry): i for entry, i in model["vocab"].items() if all(c in alphabet for c in entry)}
        results = [decoded[bytes(alphabet[c] for part in (m.split(" ") if isinstance(m, str) else m) for c in part)] for m in model["merges"]]
        if results != sorted(results):
            raise ValueError("merges aren't in the order of their ids")
        singles = {b: i for b, i in decoded.items() if len(b) == 1}
        merged = set(results)
        return cls(singles | {b: i for b, i in decoded.items() if i in merged})

    @cached_property
    def encoder(self) -> tiktoken.Encoding:
        return tiktoken.Encoding("byte_level", pat_str=PATTERN, mergeable_ranks=self.ids, special_tokens={})

    @cached_property
    def pieces(self) -> list[bytes]:
        table = [b""] * (max(self.ids.values()) + 1)
        for piece, i in self.ids.items():
            table[i] = piece
        return table

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoder.encode_ordinary(" " + t) for t in texts]


@dataclass(frozen=True)
class PieceTokens:
    """A SentencePiece model; it puts the space before a text itself."""

    model: bytes

    @classmethod
    def load(cls, path: str) -> PieceTokens:
        with open(path, "rb") as file:
            return cls(file.read())

    @cached_property
    def processor(self) -> sentencepiece.SentencePieceProcessor:
        return sentencepiece.SentencePieceProcessor(model_proto=self.model)

    @cached_property
    def pieces(self) -> list[bytes]:
        own = self.processor
        return [
            bytes([int(own.id_to_piece(i)[3:5], 16)]) if own.is_byte(i) else own.id_to_piece(i).replace("▁", " ").encode()
            for i in range(own.vocab_size())
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


# One text --------------------------------------------------------------------------

class _Aligner:
    """Links and groups of texts; tables of both vocabularies are made once a worker."""

    def __init__(self, a: ByteTokens, b: PieceTokens):
        self.a, self.b = a, b
        self.sizes = [np.array([len(p) for p in t.pieces]) for t in (a, b)]
        names_a, names_b = ([str(i).encode() for i in range(len(t.pieces))] for t in (a, b))
        # an id inside its group's list, or at its end
        self.names = [n + e for names, end in ((names_a, b"|"), (names_b, b";")) for n in names for e in (b",", end)]
        self.first_b = 2 * len(names_a)

    def align(self, text: str, ids_a: list[int], ids_b: list[int]):
        """(n_a, n_b, n_groups, n_links, digest), pair codes and links of each; None without tokens."""
        data = b" " + text.encode()
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        # byte-level tokens of the right length are the text, as each piece of it is cut without a change
        if not len(a) or not len(b) or ends_a[-1] != len(data) or ends_b[-1] != len(data):
            return None
        if b"".join(map(self.b.pieces.__getitem__, ids_b)) != data:
            return None
        is_end = np.zeros(len(data) + 1, bool)
        is_end[ends_b] = True
        cut_a = is_end[ends_a]
        shared = ends_a[cut_a]
        is_end[ends_b] = False
        is_end[shared] = True
        cut_b = is_end[ends_b]
        at_a, at_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        size_a, size_b = (np.diff(np.flatnonzero(cut), prepend=-1) for cut in (cut_a, cut_b))
        first_a, first_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        codes, counts = self.pairs(a, b, at_a, at_b, size_a, size_b)
        names = np.empty(len(a) + len(b), np.int64)
        names[np.arange(len(a)) + first_b[at_a]] = 2 * a + cut_a
        names[np.arange(len(b)) + (first_a + size_a)[at_b]] = self.first_b + 2 * b + cut_b
        listed = b"".join(map(self.names.__getitem__, names.tolist()))[:-1]
        facts = (len(a), len(b), len(shared), int((size_a * size_b).sum()), hashlib.sha256(listed).hexdigest())
        return facts, codes, counts

    def pairs(self, a, b, at_a, at_b, size_a, size_b):
        """Codes of the text's linked id pairs and how many links each has."""
        links = size_a * size_b
        listed = links <= LISTED
        own = listed[at_a]
        repeats = size_b[at_a[own]]
        first_b = np.cumsum(size_b) - size_b
        total = int(repeats.sum())
        inside = np.arange(total) - np.repeat(np.cumsum(repeats) - repeats, repeats)
        partner = np.repeat(first_b[at_a[own]], repeats) + inside
        codes, counts = np.unique(np.repeat(a[own], repeats) << _ID_BITS | b[partner], return_counts=True)
        if listed.all():
            return codes, counts
        more_codes, more_counts = [codes], [counts]
        first_a = np.cumsum(size_a) - size_a
        for g in np.flatnonzero(~listed):
            some_a, n_a = np.unique(a[first_a[g]:first_a[g] + size_a[g]], return_counts=True)
            some_b, n_b = np.unique(b[first_b[g]:first_b[g] + size_b[g]], return_counts=True)
            more_codes.append((some_a[:, None] << _ID_BITS | some_b).ravel())
            more_counts.append((n_a[:, None] * n_b).ravel())
        codes, at = np.unique(np.concatenate(more_codes), return_inverse=True)
        counts = np.zeros(len(codes), np.int64)
        np.add.at(counts, at, np.concatenate(more_counts))
        return codes, counts


# Bitmaps ---------------------------------------------------------------------------

# A plane lists its texts, or is a bitmap of the block if that is shorter.
_AS_LIST, _AS_BITS = 0, 1
_NONE, _ONE = (bytes([_AS_LIST]) + n.to_bytes(2, "little") for n in (0, 1))


def pack_plane(slots: np.ndarray) -> bytes:
    """A set of texts of a block (sorted 16-bit numbers): the shorter of a list and a bitmap."""
    if not len(slots):
        return _NONE
    width = int(slots[-1]) // 8 + 1
    if 2 * len(slots) <= width:
        return bytes([_AS_LIST]) + len(slots).to_bytes(2, "little") + slots.astype("<u2").tobytes()
    bits = np.zeros(8 * width, np.uint8)
    bits[slots] = 1
    return bytes([_AS_BITS]) + (width - 1).to_bytes(2, "little") + np.packbits(bits, bitorder="little").tobytes()


def unpack_planes(data: bytes) -> list[np.ndarray]:
    """The planes that ``pack_plane`` made, joined one after another."""
    planes, at = [], 0
    while at < len(data):
        kind, size = data[at], int.from_bytes(data[at + 1:at + 3], "little")
        at += 3
        if kind == _AS_LIST:
            planes.append(np.frombuffer(data, "<u2", size, at))
            at += 2 * size
        else:
            planes.append(np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, size + 1, at), bitorder="little")))
            at += size + 1
    return planes


def pack_counts(slots: np.ndarray, links: np.ndarray) -> bytes:
    """The multiplicity planes of a pair: its texts by each bit of their numbers of links."""
    if len(slots) == 1:
        only = _ONE + int(slots[0]).to_bytes(2, "little")
        return b"".join(only if digit == "1" else _NONE for digit in reversed(f"{int(links[0]):b}"))
    return b"".join(pack_plane(slots[links >> k & 1 == 1]) for k in range(int(links.max()).bit_length()))


def union_count(planes: list[np.ndarray]) -> int:
    """The population count of the planes' union: the texts that hold the pair at all."""
    return len(planes[0]) if len(planes) == 1 else len(np.unique(np.concatenate(planes)))


# The index -------------------------------------------------------------------------

INDEX_SCHEMA = (
    "block long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a int, b int, texts long, links long, planes binary"
)
_FACTS = ("place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
_PAIRS = ("place", "a", "b", "texts", "links", "planes")
_TYPES = {
    "block": pa.int64(), "place": pa.int32(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
    "n_links": pa.int64(), "groups_sha256": pa.string(), "a": pa.int32(), "b": pa.int32(), "texts": pa.int64(), "links": pa.int64(),
    "planes": pa.binary(),
}
#: Rows of a batch that leaves a worker.
_BATCH = 20_000


class _Block:
    """Texts of a task and their postings, until they are enough for an index of their own."""

    def __init__(self, number: int):
        self.number, self.facts, self.postings, self.held = number, [], [], 0

    def add(self, doc_id: int | None, found) -> None:
        place = len(self.facts)
        if found is None:
            self.facts.append((place, doc_id, 0, 0, 0, 0, ""))
            return
        facts, codes, counts = found
        self.facts.append((place, doc_id, *facts))
        self.postings.append((codes, np.full(len(codes), place, np.uint16), counts))
        self.held += len(codes)

    def full(self) -> bool:
        return self.held >= BLOCK_POSTINGS or len(self.facts) >= BLOCK_TEXTS

    def _batch(self, names: tuple[str, ...], rows: list[tuple]) -> pa.RecordBatch:
        columns = dict(zip(names, zip(*rows)))
        columns["block"] = [self.number] * len(rows)
        return pa.RecordBatch.from_pydict(
            {c: pa.array(columns[c], t) if c in columns else pa.nulls(len(rows), t) for c, t in _TYPES.items()}
        )

    def batches(self) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(self.facts), _BATCH):
            yield self._batch(_FACTS, self.facts[k:k + _BATCH])
        if not self.postings:
            return
        codes, slots, counts = (np.concatenate(x) for x in zip(*self.postings))
        order = np.argsort(codes, kind="stable")  # texts stay in order within a pair
        codes, slots, counts = codes[order], slots[order], counts[order]
        starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        stops = np.append(starts[1:], len(codes))
        rows = []
        for place, (i, j) in enumerate(zip(starts.tolist(), stops.tolist())):
            code, links = int(codes[i]), counts[i:j]
            planes = pack_counts(slots[i:j], links)
            held = j - i if j - i == 1 else union_count(unpack_planes(planes))
            rows.append((place, code >> _ID_BITS, code & (1 << _ID_BITS) - 1, held, int(links.sum()), planes))
            if len(rows) == _BATCH:
                yield self._batch(_PAIRS, rows)
                rows = []
        if rows:
            yield self._batch(_PAIRS, rows)


def pair_index(docs: DataFrame, a: ByteTokens, b: PieceTokens) -> DataFrame:
    """Rows of ``INDEX_SCHEMA``: of each text its facts (``a`` is null), of each block and pair its planes.

    The numbers of blocks come from the task's, so the index has to be stored before it
    is read twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _Aligner(a, b)
        number = TaskContext.get().partitionId() << 32
        block = _Block(number)
        for batch in batches:
            for part in slices(batch):
                texts = [x or "" for x in part.column("text").to_pylist()]
                for doc_id, text, ids_a, ids_b in zip(part.column("doc_id").to_pylist(), texts, a.encode(texts), b.encode(texts)):
                    block.add(doc_id, aligner.align(text, ids_a, ids_b) if text else None)
                    if block.full():
                        yield from block.batches()
                        number += 1
                        block = _Block(number)
        yield from block.batches()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, INDEX_SCHEMA)


def pair_counts(index: DataFrame) -> DataFrame:
    """Per linked id pair: a, b, texts (documents that hold it linked) and links."""
    return index.filter("a is not null").groupBy("a", "b").agg(F.sum("texts").alias("texts"), F.sum("links").alias("links"))


def _scores(pairs: pa.Table, postings: pa.Table) -> pa.Table:
    """n_best and count_sum of each text of one block that has links."""
    pairs, postings = pairs.sort_by("place").combine_chunks(), postings.sort_by("at").combine_chunks()
    slots, powers, owners = [np.zeros(0, np.int64)], [], []
    for k, planes in enumerate(postings["planes"].to_pylist()):
        for power, plane in enumerate(unpack_planes(planes)):
            slots.append(plane)
            powers.append(power)
            owners.append(k)
    sizes = [len(x) for x in slots[1:]]
    slots, links = np.concatenate(slots), np.repeat(np.left_shift(1, np.array(powers, np.int64)), sizes)
    owners = np.repeat(np.array(owners, np.int64), sizes)
    at, place = np.unique(slots, return_inverse=True)
    best, total = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    np.add.at(total, place, links * pairs["texts"].to_numpy()[owners])
    np.add.at(best, place, links * pairs["is_best"].to_numpy(zero_copy_only=False)[owners])
    block = postings["in_block"][0].as_py() if postings.num_rows else 0
    return pa.table({
        "block": pa.array(np.full(len(at), block), pa.int64()), "place": pa.array(at, pa.int32()),
        "n_best": pa.array(best), "count_sum": pa.array(total),
    })


def alignment_report(docs: DataFrame, a: ByteTokens, b: PieceTokens) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): what both tokenizers make of it and how its links rank in the corpus.

    Columns: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. A
    null or empty text, and one whose tokens of either kind aren't its bytes after a
    space, has zeros and the digest ''. Each row is a document of its own, also if it
    repeats an id or has none; ties for the best count all win. Other columns aren't
    looked at, and an empty table has no rows. A text is encoded whole: a worker holds
    its tokens and its distinct pairs at a time.
    """
    index = pin(pair_index(docs, a, b))
    counts = pin(pair_counts(index).select("a", "b", "texts"))
    highest = counts.groupBy("a").agg(F.max("texts").alias("highest")).withColumnRenamed("a", "of_a")
    ranked = counts.join(highest, F.col("a") == F.col("of_a")).select("a", "b", "texts", (F.col("texts") == F.col("highest")).alias("is_best"))
    postings = index.filter("a is not null")
    planes = postings.select(F.col("block").alias("in_block"), F.col("place").alias("at"), "planes")
    known = postings.select("block", "place", "a", "b").join(ranked, ["a", "b"]).select("block", "place", "texts", "is_best")

    def scores(left: pa.Table, right: pa.Table) -> pa.Table:
        return _scores(left, right)

    scored = known.groupBy("block").cogroup(planes.groupBy("in_block")).applyInArrow(
        scores, "block long, place int, n_best long, count_sum long"
    )
    facts = index.filter("a is null").select("block", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return facts.join(scored, ["block", "place"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256",
    )
