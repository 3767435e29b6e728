import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from larder.llm.covering import BITS, CoverRules, _finer, _spanning, cover_masks, covered_links, covering_groups, fingerprint

SPACES = " \t\n\x0b\x0c\r"


def plain_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in SPACES:
            words += [word] if word else []
            word = ""
        else:
            word += c
    shingles = [words[i:i + 4] for i in range(len(words) - 3)] or ([words] if words else [])
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Least node that each (id, print) reaches: links at 4 bits, same ids are one."""
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in combinations(range(len(prints)), 2):
        same = prints[i][0] is not None and prints[i][0] == prints[j][0]
        if same or (prints[i][1] ^ prints[j][1]).bit_count() <= 4:
            up[root(i)] = root(j)
    least = defaultdict(list)
    for i, (key, _) in enumerate(prints):
        if key is not None:
            least[root(i)].append(key)
    return [min(least[root(i)], default=None) for i in range(len(prints))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "cc", "É", "ǅ", " ", "\t", "\n", " ", "\x1c", "x y"]), max_size=40))
def test_fingerprint_equals_the_plain_one(parts):
    text = "".join(parts)
    assert fingerprint(text) % (1 << 64) == plain_print(text)


def test_long_texts_are_read_whole():
    rng = random.Random(1)
    text = " ".join(rng.choice(["alpha" * 5, "beta", "Gamma", "x" * 90]) + str(rng.randrange(999)) for _ in range(40_000))
    assert len(text) > 1 << 20
    assert fingerprint(text) % (1 << 64) == plain_print(text)
    assert fingerprint(None) == fingerprint("") == fingerprint(" \n ") == 0


def test_every_pair_within_the_radius_meets_in_some_table():
    positions, rng = list(range(64)), random.Random(2)
    masks = cover_masks(positions, 4)
    assert len(masks) == 31 and all(28 <= m.bit_count() <= 36 for m in masks)
    for apart in [rng.sample(positions, 4) for _ in range(5000)] + list(combinations(range(0, 64, 4), 4)):
        pair = sum(1 << p for p in apart)
        meeting = [m for m in masks if not m & pair]
        assert meeting
        finer = [m % (1 << BITS) for m in _finer(meeting[0], 4)]
        assert any(not m & pair for m in finer)


def test_spanning_links_join_what_all_pairs_join():
    rng = np.random.default_rng(3)
    prints = np.unique(rng.integers(0, 1 << 12, 600, dtype=np.uint64) * np.uint64(0x1001))
    a, b = _spanning(prints, 2)
    assert all((int(x) ^ int(y)).bit_count() <= 2 for x, y in zip(a, b)) and len(a) < len(prints)
    up = {int(x): int(x) for x in prints}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, y in zip(a, b):
        assert root(int(x)) != root(int(y))
        up[root(int(x))] = root(int(y))
    for x, y in combinations(map(int, prints), 2):
        if (x ^ y).bit_count() <= 2:
            assert root(x) == root(y)


@pytest.mark.parametrize("bucket", [2, 16384])
def test_full_buckets_lose_no_link(spark, bucket):
    """Prints in clumps, so that with a small bound buckets are divided twice."""
    rng = random.Random(4)
    prints = set()
    for _ in range(12):
        middle = rng.getrandbits(64)
        for _ in range(25):
            prints.add(middle ^ sum(1 << p for p in set(rng.choices(range(64), k=rng.randrange(7)))))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = covered_links(spark.createDataFrame([(p,) for p in signed], "fp long"), CoverRules(bucket=bucket)).collect()
    up = {p: p for p in signed}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        assert ((a ^ b) % (1 << 64)).bit_count() <= 4
        up[root(a)] = root(b)
    for x, y in combinations(signed, 2):
        if ((x ^ y) % (1 << 64)).bit_count() <= 4:
            assert root(x) == root(y)


def test_odd_rows(spark, make_docs):
    base = "the quick brown fox jumps over the lazy dog " * 30
    rows = [
        (5, base), (3, base.upper()), (9, None), (8, ""), (7, " \t\n"), (None, base + "end"), (None, "something else entirely"),
        (5, "another text of the same document id"), (2, "another  text of\nthe same document ID"), (11, "één"), (11, "één"), (12, "x"),
        (13, "long " * 30_000),
    ]
    docs = make_docs(rows).selectExpr("*", "'clash' as fp", "1 as component", "2 as a")
    got = covering_groups(docs).collect()
    prints = [(key, plain_print(text)) for key, text in rows]
    expected = [(key, f"{p:016x}", c) for (key, p), c in zip(prints, plain_components(prints))]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert covering_groups(make_docs([])).count() == 0


def test_query_equals_brute_force(spark):
    from larder.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    prints = [(key, plain_print(text)) for key, text in rows]
    expected = {(key, f"{p:016x}", c) for (key, p), c in zip(prints, plain_components(prints))}
    got = QUERIES["op11_covering_simhash"](spark, folder)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert {tuple(r) for r in got.collect()} == expected
