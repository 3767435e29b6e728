import hashlib
import os
import re

import numpy as np
from pyspark.sql import functions as F

from larder.llm.exact_mph import _pack, _unpack, build_levels, digest_keys, drop_exact, exact_groups, exact_report, slots

ROWS = [
    (5, "a b\tc"), (2, "abc"), (9, "a  b  c"), (1, "x"), (4, None), (3, ""), (7, " \n"), (8, " "), (6, "abc "),
    (10, "long " * 30_000), (11, "long" * 30_000), (12, "x"), (None, "x"),
]


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, len(t or "")))
    out = []
    for i, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best = min(groups[key], key=lambda x: (-x[1], x[0] is None, x[0] or 0))[0]
        out.append((i, best, len(groups[key]), i == best, hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=str)


def test_the_hash_is_minimal_and_perfect():
    digests = np.frombuffer(os.urandom(32 * 5000), np.uint8).reshape(-1, 32)
    levels = build_levels(digests)
    assert sorted(slots(levels, digests)) == list(range(5000))
    again = _unpack(_pack(levels))
    others = np.frombuffer(os.urandom(32 * 1000), np.uint8).reshape(-1, 32)
    assert (slots(again, digests) == slots(levels, digests)).all()
    assert slots(again, others).max() < 5000
    assert build_levels(digests[:0]) == [] and (slots([], others) == -1).all()


def test_report_matches_grouping(make_docs):
    got = [tuple(r) for r in exact_report(make_docs(ROWS)).drop("in_history").collect()]
    assert sorted(got, key=str) == brute(ROWS)


def test_any_split_into_history_gives_the_same_groups(make_docs):
    keys = digest_keys(make_docs(ROWS))
    whole = {(bytes(r.digest), r.keep_id, r.group_size) for r in exact_groups(keys.filter("false"), keys).collect()}
    for history in ("doc_id % 2 = 0", "doc_id > 4", "true"):
        early = F.coalesce(F.expr(history), F.lit(False))
        found = exact_groups(keys.filter(early), keys.filter(~early)).collect()
        assert {(bytes(r.digest), r.keep_id, r.group_size) for r in found} == whole


def test_dropping_keeps_one_row_of_each_text(make_docs):
    docs = make_docs(ROWS + [(1, "x"), (1, "x")]).withColumn("digest", F.lit("own")).withColumn("row_", F.lit(1))
    out = drop_exact(docs)
    assert out.columns == docs.columns
    kept = sorted(r.doc_id for r in out.collect())
    assert kept == sorted(i for i, k, *_ in brute(ROWS) if i == k)
    assert out.filter("digest = 'own'").count() == len(kept)


def test_empty_table(make_docs):
    assert exact_report(make_docs([])).count() == 0 and drop_exact(make_docs([])).count() == 0
