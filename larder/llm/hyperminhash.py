"""Shingle sets and HyperMinHash sketches of texts, in NumPy.

A sketch has one register per bucket of the hash space. A register keeps the
bucket's least hash as the count of its leading zeros and the mantissa bits that
follow its first one. Registers of equal sets are equal; of different sets they
agree with about the probability of their Jaccard similarity, plus a small chance
of agreement by accident that shrinks with the mantissa and is known from the
sizes of the sets.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
_REST = 64 - BUCKET_BITS
_MOST_ZEROS = 62
EMPTY = np.uint16(0xFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (A-Z lower-cased, split at ASCII white space) of all texts, and where each text's begin."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    coded = parts.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    codes = coded.indices.to_numpy()
    real = np.fromiter((w != "" for w in words), bool, len(words))[codes] if words else np.empty(0, bool)
    kept = np.concatenate([[0], np.cumsum(real)])
    return known[codes][real] if words else np.empty(0, np.uint64), kept[offsets]


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``width`` words; of fewer words, one hash of them all."""
    n = len(words)
    if not n:
        return words
    run = min(n, width)
    with np.errstate(over="ignore"):
        x = np.full(n - run + 1, run, np.uint64)
        for k in range(run):
            x = _mix(x * np.uint64(0x9E3779B97F4A7C15) + words[k : n - run + 1 + k])
    return np.unique(x)


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    words, at = word_hashes(texts)
    return [shingle_set(words[a:b], width) for a, b in zip(at[:-1], at[1:])]


_STARTS = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(_REST)


def registers(shingles: np.ndarray) -> np.ndarray:
    """The sketch of a sorted set: leading zeros and mantissa of each bucket's least hash; ``EMPTY`` without one."""
    out = np.full(BUCKETS, EMPTY, np.uint16)
    if not len(shingles):
        return out
    first = np.searchsorted(shingles, _STARTS)
    inside = first < len(shingles)
    inside[inside] = (shingles[first[inside]] >> np.uint64(_REST)) == np.flatnonzero(inside)
    rest = shingles[first[inside]] << np.uint64(BUCKET_BITS)
    # the position of the first one, by halves
    zeros, x = np.zeros(len(rest), np.uint64), rest.copy()
    for step in (32, 16, 8, 4, 2, 1):
        low = x < (np.uint64(1) << np.uint64(64 - step))
        zeros[low] += np.uint64(step)
        x[low] <<= np.uint64(step)
    zeros = np.minimum(zeros, np.uint64(_MOST_ZEROS))
    mantissa = (x << np.uint64(1)) >> np.uint64(64 - MANTISSA_BITS)
    out[inside] = ((zeros << np.uint64(MANTISSA_BITS)) | mantissa).astype(np.uint16)
    return out


#: For each bucket an order of all buckets, in which an empty one looks for a register to borrow.
_BORROW = np.argsort(
    _mix(np.arange(1, BUCKETS * BUCKETS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(BUCKETS, BUCKETS), axis=1
)


def densified(sketches: np.ndarray) -> np.ndarray:
    """Sketches (n, BUCKETS) whose empty registers are borrowed from full ones, for banding alone."""
    out = sketches.copy()
    full = sketches != EMPTY
    for row in np.flatnonzero(~full.all(axis=1) & full.any(axis=1)):
        holes = np.flatnonzero(~full[row])
        order = _BORROW[holes]
        lender = order[np.arange(len(holes)), full[row][order].argmax(axis=1)]
        out[row, holes] = sketches[row, lender]
    return out


def band_keys(sketches: np.ndarray, rows: int) -> np.ndarray:
    """(n, BUCKETS / rows) keys, equal for sketches that agree on a band of ``rows`` registers."""
    grouped = densified(sketches).reshape(len(sketches), BUCKETS // rows, rows).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, BUCKETS // rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), grouped.shape[:2]).copy()
        for k in range(rows):
            key = _mix(key + grouped[:, :, k] * np.uint64(0xD6E8FEB86659FD93))
    return key.astype(np.int64)


@lru_cache(4096)
def chance_agreement(log_a: float, log_b: float) -> float:
    """The probability that a bucket's registers agree for unrelated sets of 2**log_a and 2**log_b elements.

    Sums, over all register values, the chance that both buckets' minima lie in its interval.
    """
    a, b = 2.0**log_a / BUCKETS, 2.0**log_b / BUCKETS
    zeros = np.arange(_MOST_ZEROS + 1)[:, None]
    steps = np.arange((1 << MANTISSA_BITS) + 1)[None, :] / (1 << MANTISSA_BITS)
    edges = 2.0 ** (-zeros - 1.0) * (1 + steps)
    # buckets get a Poisson number of elements: P(minimum > x) = exp(-mean * x)
    beyond = lambda mean: np.exp(-mean * edges[:, :-1]) - np.exp(-mean * edges[:, 1:])
    return float((beyond(a) * beyond(b)).sum())


def estimated_jaccard(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard of sketch pairs (n, BUCKETS), and the number of registers it rests on.

    Sizes are rounded to quarter powers of two for the chance of agreement.
    """
    used = ((a != EMPTY) | (b != EMPTY)).sum(axis=1)
    equal = ((a == b) & (a != EMPTY)).sum(axis=1)
    logs = lambda n: np.round(np.log2(np.maximum(n, 1)) * 4) / 4
    kinds, back = np.unique(np.stack([logs(size_a), logs(size_b)]), axis=1, return_inverse=True)
    chance = np.array([chance_agreement(float(x), float(y)) for x, y in kinds.T])[back.ravel()] if len(used) else np.empty(0)
    share = equal / np.maximum(used, 1)
    # a register agrees by similarity, or else by chance
    return np.clip((share - chance) / np.maximum(1 - chance, 1e-9), 0, 1), used


def exact_overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Elements that two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())
