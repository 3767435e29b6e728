import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from larder.llm.components import components
from larder.llm.hyperminhash import EMPTY, band_keys, estimated_jaccard, registers, shingle_sets
from larder.llm.near_dedup import NearRules, drop_near, near_groups
from llm_texts import words


def shingles(text, width):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def brute(rows, width, percent=80):
    sets = {i: shingles(t, width) for i, t in rows}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def family(seed, n, edits, copies):
    """A text and copies of it with some words replaced, chained or from the first."""
    rng, base = random.Random(seed), words(seed, n)
    out = [base]
    for k in range(copies):
        w = list(base if k % 2 else out[-1])
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(w)
    return [" ".join(w) for w in out]


def test_groups_match_brute_force(make_docs):
    texts = [t for s in range(6) for t in family(s, 30 + 60 * s, 3 + 2 * s, 9)]
    texts += ["", None, " \n ", "one", "one", "One", "one two three", "ONE two\tthree", "é É", "é é"]
    texts += [" ".join(words(99, 20_000))] * 2
    rows = [(7 * i % 1009, t) for i, t in enumerate(texts)]
    for width in (4, 5):
        got = near_groups(make_docs(rows), NearRules(width=width, block=8)).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows, width)


def test_repeated_and_missing_ids(make_docs):
    a, b = family(1, 100, 2, 1)
    rows = [(3, a), (3, a), (5, b), (5, "other words here now then"), (1, "other words here now then"), (None, a)]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_groups(make_docs(rows)).collect()), key=str)
    assert got == sorted([(3, 1, False), (3, 1, False), (5, 1, False), (5, 1, False), (1, 1, True), (None, None, True)], key=str)


def test_an_id_with_several_texts_keeps_the_links_of_each(make_docs):
    x, y, z, far = (" ".join(words(seed, 200)) for seed in (11, 12, 13, 14))
    near_x, near_y, near_z = x + " more", y + " more", z + " more"
    rows = [(5, x), (5, y), (9, near_y), (10, near_x), (4, near_z), (10, z), (3, far), (20, far), (20, far + " and more"), (None, y)]
    got = {(r.doc_id, r.component_id, r.kept) for r in near_groups(make_docs(rows)).collect()}
    assert got == {(4, 4, True), (5, 4, False), (9, 4, False), (10, 4, False), (3, 3, True), (20, 3, False), (None, None, True)}
    assert sorted(r.doc_id or 0 for r in drop_near(make_docs(rows)).collect()) == [0, 3, 4]


def test_dropping_keeps_the_smallest_id(make_docs):
    texts = family(2, 80, 3, 5)
    docs = make_docs([(10 - i, t) for i, t in enumerate(texts)] + [(50, "alone in the world today"), (60, None)])
    docs = docs.withColumn("id", F.lit("mine")).withColumn("key", F.lit(0))
    out = drop_near(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [5, 50, 60]
    empty = make_docs([])
    assert near_groups(empty).count() == 0 and drop_near(empty).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    rng.shuffle(edges)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    expected = {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200, 202: 200, 300: 300}
    assert got == expected


def test_estimates_are_near_and_corrected():
    rng = np.random.default_rng(1)
    for size in (40, 300, 5000):
        for goal in (0.0, 0.5, 0.8, 1.0):
            estimates = []
            for _ in range(40):
                shared = int(2 * size * goal / (1 + goal))
                both = rng.integers(0, 2**63, shared, dtype=np.uint64) * np.uint64(2)
                a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**63, size - shared, dtype=np.uint64) * np.uint64(2) + np.uint64(1)])) for _ in "ab")
                # spread over all 64 bits
                ra, rb = (registers(np.unique(x * np.uint64(0x9E3779B97F4A7C15))) for x in (a, b))
                estimates.append(estimated_jaccard(ra[None], rb[None], np.array([len(a)]), np.array([len(b)]))[0][0])
            assert abs(np.mean(estimates) - goal) < 0.05


def test_bands_meet_for_similar_short_texts():
    hits = 0
    for seed in range(100):
        base = words(seed, 14)
        sets = shingle_sets(pa.array([" ".join(base), " ".join(base[1:])]), 4)
        keys = band_keys(np.array([registers(s) for s in sets]), 4)
        hits += bool((keys[0] == keys[1]).any())
    assert hits == 100
    assert (registers(np.empty(0, np.uint64)) == EMPTY).all()
