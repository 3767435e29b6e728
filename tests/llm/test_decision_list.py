import re
from collections import Counter

import numpy as np

from larder.llm.decision_list import FEATURES, learn_list, rule_report, text_stats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    None, "", " \n\t", "a", "a b c a b c a b c", "x x x x", "one two\none two\n\n  \n\nOne two\none two", "é #|# <b> $5 & %*>",
    "A\x0bB\x0cC\rD\n", "nb sp nb sp   z", "w " * 40_000, "\n".join(["line here"] * 60),
]


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def test_statistics_match_brute_force(make_docs):
    got = {r.doc_id: tuple(r[1:6]) for r in text_stats(make_docs(list(enumerate(TEXTS)))).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}
    assert text_stats(make_docs([])).count() == 0


def test_a_conjunction_is_learnt():
    rng = np.random.default_rng(0)
    table = {name: rng.random(3000) for name in FEATURES}
    table["bad"] = (table["upper_share"] > 0.7) & (table["word_length"] < 0.4)
    found = learn_list(table)
    hit = np.zeros(3000, bool)
    for rule in found:
        own = np.ones(3000, bool)
        for condition in rule:
            own &= condition.holds(table)
        hit |= own
    assert (hit & ~table["bad"]).mean() < 0.01 and hit[table["bad"]].mean() > 0.9
    assert {c.feature for c in found[0]} == {"upper_share", "word_length"}


def test_noise_teaches_nothing():
    rng = np.random.default_rng(1)
    table = {name: rng.random(1000) for name in FEATURES} | {"bad": rng.random(1000) < 0.2}
    assert learn_list(table) == []


def test_report_applies_base_rules_and_the_list(spark, make_docs):
    rng = np.random.default_rng(2)
    rows, marks = [], []
    for i in range(300):
        w = [f"w{rng.integers(10**6)}" for _ in range(80)]
        bad = i % 3 == 0
        rows.append((i, " ".join(x + "#$" if bad else x for x in w)))
        marks.append((i, int(not bad), 0))
    rows += [(1000, "short"), (1001, "a b c " * 40), (1002, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    docs = make_docs(rows)
    got = {r.doc_id: (r.base_failed, r.kept) for r in rule_report(docs, labels).collect()}
    assert [got[i] for i in (1000, 1001, 1002)] == [(True, False)] * 3
    assert all(got[i] == (False, i % 3 != 0) for i in range(300))
    without = rule_report(docs, labels.filter("false")).filter("doc_id < 1000 and kept").count()
    assert without == 300
