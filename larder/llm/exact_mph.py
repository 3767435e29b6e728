"""Exact dedup against history with a minimal perfect hash.

The distinct digests of earlier documents are dealt into shards by their leading
bytes. In each shard a minimal perfect hash gives every digest a slot of its own;
the slot holds the whole digest and its winner. A lookup computes the slot and
compares the bytes, so a digest that is not in the history is never mistaken for
one that is. Digests outside the history are grouped among themselves.

The hash is a cascade of bit arrays: at each level the digests that alone hit
their bit keep it, the others go on to the next level. A digest's slot is the
number of bits set before its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from larder.llm.common import SPACES, fresh, marked, text_or_empty
from larder.llm.spread import attach
from larder.plans.lineage import pin

#: Digests of a shard, about; a shard's index is 60 bytes a digest.
SHARD_DIGESTS = 40_000
#: Bits a level has for each digest that reaches it.
SPARE_BITS = 2
_LEVELS = 64

INDEX_SCHEMA = "shard long, levels binary, digests binary, chars binary, ids binary, has_id binary, copies binary"
WINNER_SCHEMA = "digest binary, keep_id long, keep_chars long, group_size long, in_history boolean"


def digest(name: str = "text") -> Column:
    """SHA-256 of a text without its ASCII white space, as 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(text_or_empty(name), SPACES, ""), 256))


def digest_keys(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", digest().alias("digest"), F.length(text_or_empty()).cast("long").alias("chars"))


def _winners(keys: DataFrame) -> DataFrame:
    """One row per digest: most code points, then smallest doc_id (null last); combined before the shuffle."""
    best = F.max(F.struct("chars", F.col("doc_id").isNotNull().alias("has_id"), (-F.col("doc_id")).alias("minus_id")))
    return keys.groupBy("digest").agg(best.alias("best"), F.count("*").alias("copies")).select(
        "digest", F.col("best.chars").alias("chars"), (-F.col("best.minus_id")).alias("id"), "copies"
    )


def _shard(count: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long"), F.lit(count)).alias("shard")


def _words(digests: np.ndarray) -> np.ndarray:
    """(n, 32) bytes as (n, 4) numbers."""
    return np.ascontiguousarray(digests).view("<u8").reshape(len(digests), 4)


def _spread(words: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of all 32 bytes, another one at each level."""
    x = np.full(len(words), (level * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1), np.uint64)
    for k in range(4):
        x = (x ^ words[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
    return x


def build_levels(digests: np.ndarray) -> list[np.ndarray]:
    """The cascade's bit arrays (as booleans) for distinct digests."""
    words, levels = _words(digests), []
    while len(words):
        if len(levels) == _LEVELS:
            raise ValueError("digests repeat")
        size = max(8, len(words) * SPARE_BITS)
        at = (_spread(words, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        words = words[~alone[at]]
    return levels


def slots(levels: list[np.ndarray], digests: np.ndarray) -> np.ndarray:
    """The slot of each digest; -1 for some of those that were not built in, any slot for the others."""
    words, found, before = _words(digests), np.full(len(digests), -1, np.int64), 0
    open_ = np.arange(len(digests))
    for level, bits in enumerate(levels):
        if not len(open_):
            break
        at = (_spread(words[open_], level) % np.uint64(len(bits))).astype(np.int64)
        hit = bits[at]
        rank = np.cumsum(bits) - 1
        found[open_[hit]] = before + rank[at[hit]]
        open_, before = open_[~hit], before + int(bits.sum())
    return found


def _pack(levels: list[np.ndarray]) -> bytes:
    head = np.array([len(levels), *map(len, levels)], "<i8").tobytes()
    return head + b"".join(np.packbits(x).tobytes() for x in levels)


def _unpack(raw: bytes) -> list[np.ndarray]:
    count = int(np.frombuffer(raw, "<i8", 1)[0])
    sizes = np.frombuffer(raw, "<i8", count, 8)
    at, levels = 8 * (count + 1), []
    for size in sizes:
        n = (int(size) + 7) // 8
        levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, n, at), count=int(size)).astype(bool))
        at += n
    return levels


def _digest_array(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return pc.fill_null(column, 0).to_numpy().astype("<i8")


def _index_shard(rows: pa.Table) -> pa.Table:
    """One row with the shard's hash and its slots."""
    digests = _digest_array(rows["digest"])
    levels = build_levels(digests)
    order = np.argsort(slots(levels, digests))
    has_id = np.array(rows["id"].is_valid())
    return pa.table({
        "shard": [rows["shard"][0].as_py()],
        "levels": [_pack(levels)],
        "digests": [digests[order].tobytes()],
        "chars": [_numbers(rows["chars"])[order].tobytes()],
        "ids": [_numbers(rows["id"])[order].tobytes()],
        "has_id": [has_id[order].astype(np.uint8).tobytes()],
        "copies": [_numbers(rows["copies"])[order].tobytes()],
    })


def _look_up(index: pa.Table, fresh_rows: pa.Table) -> pa.Table:
    """All digests of a shard with their winners: those of the history with what the new rows add, then the others."""
    n, levels = 0, []
    digests, chars, ids, copies, has_id = np.empty((0, 32), np.uint8), *(np.empty(0, np.int64) for _ in range(3)), np.empty(0, bool)
    if index.num_rows:
        row = index.to_pylist()[0]
        levels, digests = _unpack(row["levels"]), np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
        chars, ids, copies = (np.frombuffer(row[x], "<i8").copy() for x in ("chars", "ids", "copies"))
        has_id, n = np.frombuffer(row["has_id"], np.uint8).astype(bool), len(digests)
    member = np.empty(0, bool)
    if fresh_rows.num_rows:
        own = _digest_array(fresh_rows["digest"])
        own_chars, own_ids, own_copies = (_numbers(fresh_rows[x]) for x in ("chars", "id", "copies"))
        own_has = np.array(fresh_rows["id"].is_valid())
        at = slots(levels, own)
        member = np.zeros(len(own), bool)
        inside = at >= 0
        member[inside] = (digests[at[inside]] == own[inside]).all(axis=1)
        to = at[member]
        copies[to] += own_copies[member]
        c, i, h = own_chars[member], own_ids[member], own_has[member]
        wins = (c > chars[to]) | ((c == chars[to]) & ((h & ~has_id[to]) | ((h == has_id[to]) & (i < ids[to]))))
        has_id = has_id.copy()
        chars[to[wins]], ids[to[wins]], has_id[to[wins]] = c[wins], i[wins], h[wins]
        rest = ~member
        digests = np.concatenate([digests, own[rest]])
        chars, ids, copies = (np.concatenate(x) for x in ((chars, own_chars[rest]), (ids, own_ids[rest]), (copies, own_copies[rest])))
        has_id = np.concatenate([has_id, own_has[rest]])
    return pa.table({
        "digest": pa.array([x.tobytes() for x in digests], pa.binary()),
        "keep_id": pa.array(ids, pa.int64(), mask=~has_id),
        "keep_chars": pa.array(chars, pa.int64()),
        "group_size": pa.array(copies, pa.int64()),
        "in_history": pa.array(np.arange(len(digests)) < n),
    })


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """The perfect-hash index of winners (digest, chars, id, copies): one row per shard, written to shared storage.

    Each shard is built on its own, so a lost executor costs one shard's work.
    """
    dealt = history.select(_shard(shards), "*")
    return pin(dealt.groupBy("shard").applyInArrow(_index_shard, INDEX_SCHEMA))


def look_up(index: DataFrame, winners: DataFrame, shards: int) -> DataFrame:
    """Winners of history and new rows together, one row per digest (``WINNER_SCHEMA``)."""
    dealt = winners.select(_shard(shards), "*")
    return index.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInArrow(_look_up, WINNER_SCHEMA)


def exact_groups(history_keys: DataFrame, new_keys: DataFrame) -> DataFrame:
    """One row per distinct digest of both (``WINNER_SCHEMA``).

    Both sides are combined per digest before any shuffle, so a text that a third of
    all documents share is one row here.
    """
    history, new = pin(_winners(history_keys)), pin(_winners(new_keys))
    shards = max(1, -(-(history.count() + new.count()) // SHARD_DIGESTS))
    return pin(look_up(build_index(history, shards), new, shards))


def exact_duplicates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The keys of ``docs`` (doc_id, text) and its groups.

    The lower half of the id range counts as history, the rest as new documents; what
    stays doesn't depend on that split. Null text is empty, null ids lose to others, an
    empty table has no groups.
    """
    keys = pin(digest_keys(docs))
    low, high = keys.agg(F.min("doc_id"), F.max("doc_id")).first()
    early = F.col("doc_id") <= F.lit((low + high) // 2 if low is not None else None).cast("long")
    early = F.coalesce(early, F.lit(False))
    return keys, exact_groups(keys.filter(early), keys.filter(~early))


def exact_report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept and the digest in hex.

    Rows of equal text that share the winner's doc_id are all marked as kept;
    ``drop_exact`` leaves one of them.
    """
    keys, groups = exact_duplicates(docs)
    return attach(keys.select("doc_id", "digest"), groups, "digest", "group_size").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "in_history",
    )


def drop_exact(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that lose; one row of each distinct text, columns as they came."""
    keys, groups = exact_duplicates(docs.select("doc_id", "text"))
    many = groups.filter("group_size > 1").select("digest", "keep_id", "group_size")
    lost = attach(keys, many, "digest", "group_size").filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "digest").distinct()
    repeated = keys.groupBy("digest", "doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    twins = repeated.join(many, "digest").filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "digest")
    body, lost = fresh(["doc_id", "digest"], "row_"), pin(lost)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(body), F.col("doc_id"), digest().alias("digest"))
    # only rows whose id may be among the lost ones are shuffled for the exact test
    seen = marked(rows, F.col("doc_id").cast("long"), lost.select(F.col("doc_id").cast("long").alias("id")).distinct(), "_maybe")
    tested = seen.filter("_maybe").select(body, "doc_id", "digest")
    tested = tested.join(lost, tested["doc_id"].eqNullSafe(lost["doc_id"]) & (tested["digest"] == lost["digest"]), "left_anti")
    kept = seen.filter("not _maybe").select(body, "doc_id", "digest").unionByName(tested)
    twins = pin(twins)
    if twins.isEmpty():
        return kept.select(f"{body}.*")
    # rows that repeat the winner's id: one of each, whichever comes first by all columns as JSON
    pair = (kept["doc_id"].eqNullSafe(twins["doc_id"])) & (kept["digest"] == twins["digest"])
    first = (
        kept.join(twins, pair, "left_semi").groupBy("doc_id", "digest")
        .agg(F.min_by(body, F.to_json(body)).alias(body))
    )
    return kept.join(twins, pair, "left_anti").select(f"{body}.*").unionByName(first.select(f"{body}.*"))
