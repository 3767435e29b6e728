"""Near-duplicates by SimHash, found without false negatives by covering hashing.

1. Every text becomes a 64-bit fingerprint; rows of equal fingerprints are one class.
2. A table of hashes is a bit mask: classes that agree under it share a bucket. Each
   bit position has a non-zero code of radius + 1 bits, and for each non-zero vector
   there is the mask of positions whose code has an odd product with it. At most
   ``radius`` differing positions leave a vector that is orthogonal to all of their
   codes, and under that vector's mask the pair agrees. So every pair within the
   radius collides in some table, whatever the data.
3. A bucket that holds too many classes is divided by a cover of the bits that its
   mask leaves free, which keeps the guarantee; a mask of nearly all bits bounds a
   bucket by itself.
4. Links within buckets become connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from larder.llm.common import map_texts
from larder.llm.components import components
from larder.llm.spread import attach
from larder.plans.lineage import pin

BITS = 64
SEED = 42


@dataclass(frozen=True)
class CoverRules:
    """``width`` words a shingle; fingerprints link at ``radius`` or fewer differing bits.

    A bucket of more than ``bucket`` fingerprints is divided again, unless its mask
    leaves ``least_free`` bits or fewer, of which it can hold but that power of two.
    """

    width: int = 4
    radius: int = 4
    bucket: int = 16384
    least_free: int = 16


# Fingerprints ----------------------------------------------------------------------

#: Bytes of a text that are cut into words at a time.
_PIECE = 1 << 20
_SPACE = b" \t\n\v\f\r"


def _word_runs(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a piece of it at a time; pieces end at white space."""
    begin = 0
    while begin < len(data):
        end = begin + _PIECE
        while end < len(data) and data[end] not in _SPACE:
            end += 1
        yield data[begin:end].split()
        begin = end


def _bit_counts(shingles: list[bytes]) -> np.ndarray:
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), "<u8", len(shingles))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, width: int = 4) -> int:
    """The SimHash of a text's word shingles, repeats included, as a signed 64-bit number.

    A bit is one if it is set in over half of the shingles' hashes. Fewer words than a
    shingle are one shingle; no words give zero.
    """
    if not text:
        return 0
    counts, total, carried = np.zeros(BITS, np.int64), 0, []
    for words in _word_runs(text.encode().lower()):  # of bytes, this lowers A-Z alone
        words = carried + words
        shingles = [b" ".join(x) for x in zip(*(words[k:] for k in range(width)))]
        for k in range(0, len(shingles), 1 << 16):
            counts += _bit_counts(shingles[k:k + (1 << 16)])
        total += len(shingles)
        carried = words[-(width - 1):] if width > 1 else []
    if not total and carried:
        counts, total = _bit_counts([b" ".join(carried)]), 1
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def _fingerprints(width: int, batch: pa.RecordBatch) -> pa.RecordBatch:
    prints = [fingerprint(x, width) for x in batch.column("text").to_pylist()]
    return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": pa.array(prints, pa.int64())})


def fingerprints(docs: DataFrame, rules: CoverRules = CoverRules()) -> DataFrame:
    """doc_id and fingerprint (``fp``, a long) of each row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_texts(rows, partial(_fingerprints, rules.width), "doc_id long, fp long")


# Covers ----------------------------------------------------------------------------

def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def cover_masks(positions: list[int], radius: int) -> list[int]:
    """Masks over bit positions, of which one at least misses any ``radius`` of them."""
    vectors = range(1, 1 << (radius + 1))
    # codes are dealt evenly; the step only spreads those of few positions
    codes = {p: 1 + (k * 11) % len(vectors) for k, p in enumerate(positions)}
    masks = {sum(1 << p for p, code in codes.items() if (code & v).bit_count() % 2) for v in vectors}
    return sorted(masks)


def _free(mask: int) -> list[int]:
    return [p for p in range(BITS) if not mask >> p & 1]


def _finer(mask: int, radius: int) -> list[int]:
    """Masks that add to ``mask`` a cover of the bits that it leaves free."""
    return sorted({_signed(mask | more) for more in cover_masks(_free(mask), radius)})


# Links -----------------------------------------------------------------------------

#: Buckets up to this size are compared by shifts of the whole batch.
_SHORT = 32


def _spanning(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of a bucket; each print is compared until it is reached."""
    left, ends = prints, []
    while len(left) > 1:
        reached, left = [left[-1:]], left[:-1]
        while reached and len(left):
            some = reached.pop()
            for x in some:
                near = np.bitwise_count(left ^ x) <= radius
                if near.any():
                    hits, left = left[near], left[~near]
                    ends.append((hits, np.full(len(hits), x)))
                    reached.append(hits)
    if not ends:
        return prints[:0], prints[:0]
    return np.concatenate([a for a, _ in ends]), np.concatenate([b for _, b in ends])


def _bucket_links(run: np.ndarray, prints: np.ndarray, radius: int) -> pa.RecordBatch:
    """Links of whole buckets; ``run`` numbers them in order."""
    sizes = np.bincount(run) if len(run) else np.zeros(0, np.int64)
    short = sizes[run] <= _SHORT if len(run) else np.zeros(0, bool)
    pieces = []
    for k in range(1, min(_SHORT, int(sizes.max(initial=1)))):
        near = np.flatnonzero((run[:-k] == run[k:]) & short[k:] & (np.bitwise_count(prints[:-k] ^ prints[k:]) <= radius))
        pieces.append((prints[near], prints[near + k]))
    ends = np.cumsum(sizes)
    for j in np.flatnonzero(sizes > _SHORT):
        pieces.append(_spanning(prints[ends[j] - sizes[j]:ends[j]], radius))
    a, b = (np.concatenate([p[i] for p in pieces]) if pieces else prints[:0] for i in (0, 1))
    return pa.RecordBatch.from_pydict({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})


def _sorted_bucket_links(radius: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within buckets of rows in the order of (mask, key); a bucket is held until it is whole."""
    held = [np.zeros(0, np.int64)] * 3
    for batch in batches:
        held = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("mask", "key", "fp"))]
        mask, key, prints = held
        new = (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])
        if not new.any():
            continue
        cut = int(np.flatnonzero(new)[-1]) + 1
        run = np.concatenate([[0], np.cumsum(new[:cut - 1])])
        yield _bucket_links(run, prints[:cut].view(np.uint64), radius)
        held = [h[cut:] for h in held]
    if len(held[2]):
        yield _bucket_links(np.zeros(len(held[2]), np.int64), held[2].view(np.uint64), radius)


def _in_buckets(prints: DataFrame, masks: Column) -> DataFrame:
    return prints.select(F.explode(masks).alias("mask"), "fp").withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))


def _links_of(buckets: DataFrame, radius: int) -> DataFrame:
    ordered = buckets.repartition("mask", "key").sortWithinPartitions("mask", "key")
    return ordered.mapInArrow(partial(_sorted_bucket_links, radius), "a long, b long")


def covered_links(prints: DataFrame, rules: CoverRules = CoverRules()) -> DataFrame:
    """Links (a, b) that join all of ``prints`` (fp, distinct longs) within the radius of each other.

    Links between prints that a bucket joins already may be left out.
    """
    buckets = _in_buckets(prints, F.array(*[F.lit(m) for m in _finer(0, rules.radius)]))
    found = None
    while True:
        free = BITS - F.bit_count("mask")
        full = pin(
            buckets.groupBy("mask", "key").agg(F.count("*").alias("size"))
            .filter((F.col("size") > rules.bucket) & (free > rules.least_free)).select("mask", "key")
        )
        masks = [row["mask"] for row in full.select("mask").distinct().collect()]  # one a table at most
        small = buckets.join(full, ["mask", "key"], "left_anti") if masks else buckets
        links = _links_of(small, rules.radius)
        found = links if found is None else found.unionByName(links)
        if not masks:
            return found
        cover = prints.sparkSession.createDataFrame(
            [(m, _finer(m % (1 << BITS), rules.radius)) for m in masks], "mask long, finer array<long>"
        )
        crowded = buckets.join(full, ["mask", "key"], "left_semi").join(F.broadcast(cover), "mask")
        buckets = pin(_in_buckets(crowded.select("fp", "finer"), F.col("finer")).distinct())


def covering_groups(docs: DataFrame, rules: CoverRules = CoverRules()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, fingerprint (16 hexadecimal digits), component_id.

    ``component_id`` is the smallest doc_id reached by links. Texts without words (null,
    empty, white space) have the fingerprint zero and link like any other. Equal
    fingerprints, of repeated rows or by chance, link. Rows that repeat a doc_id count
    as one document with the links of all of them. A row without an id links like any
    other; its component is null if it reaches no id. Very long texts are read in
    pieces, an empty table has no rows, and other columns aren't looked at.
    """
    rows = pin(fingerprints(docs, rules))
    classes = pin(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")))
    several = rows.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("last")).filter("doc_id is not null and a < last")
    same_document = rows.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("fp").alias("b")).filter("a <> b").distinct()
    links = pin(covered_links(classes.select("fp"), rules).unionByName(same_document))
    labels = components(links).withColumnRenamed("id", "fp")
    named = pin(classes.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp")))
    heads = pin(named.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("members")))
    of_class = pin(attach(named.select("fp", "component", "copies"), heads, "component", "members").select("fp", "component_id", "copies"))
    return attach(rows, of_class, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
