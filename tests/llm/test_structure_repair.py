import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest

from larder.llm.structure_repair import rank_paths, repair_report

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"
FULL = {"u": "user", "a": "assistant"}
AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        spot = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fault = zlib.crc32(spot.encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(turn, role, text)] * (2 if fault == 3 else 1)
    digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))


def plain_repair(rows):
    """All audits by dynamic programming over (cost, audit, lines), the least first."""
    kinds, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(SPACES)
        kinds.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, state, inserted):
        found = []
        if inserted < 2:
            cost, audit, lines = best(i, AFTER[state], inserted + 1) or (None, None, None)
            if cost is not None:
                found.append((cost + 5, "I" + audit, (FULL[AFTER[state]] + ":",) + lines))
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, "", ()))
            return min(found, default=None)
        _, role, text = rows[i]
        moves = [(2, "D", state, ())]
        if kinds[i] not in ("blank", "duplicate"):
            more = 5 if kinds[i] == "truncated" else 0
            moves.append((1 + more, "R", AFTER[state], (f"{FULL[AFTER[state]]}:{text}",)))
            if role[:1] in {"": "su", "s": "u", "u": "a", "a": "u"}[state] and role:
                moves.append((more, "K", role[0], (f"{role}:{text}",)))
        for cost, letter, to, line in moves:
            rest = best(i + 1, to, 0)
            if rest is not None:
                found.append((cost + rest[0], letter + rest[1], line + rest[2]))
        return min(found, default=None)

    for i in range(len(rows), -1, -1):  # from the end, so that recursion stays flat
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    cost, audit, lines = best(0, "", 0)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def plain_report(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    return {(conv, *plain_repair(plain_damage(part))) for conv, part in groups.items()}


def made(rng, conv, length):
    roles = ["user", "assistant"] * 4 + ["system", "user", "tool", "", "Assistant", "s", None]
    texts = ["Hello.", "Why? ", "so it goes", "Fine!\n", "", " \t", "a.b", "Yes. No.", "x", None, "same."]
    rows = []
    for k in range(length):
        role = ("system" if k == 0 and rng.random() < 0.3 else ("user", "assistant")[k % 2]) if rng.random() < 0.75 else rng.choice(roles)
        text = f"Line {rng.randrange(10 ** 6)}{rng.choice(['.', '?', ''])}" if rng.random() < 0.7 else rng.choice(texts)
        rows.append((conv, rng.choice([k, k, k, k, k + 2, None]), role, text))
    return rows


@pytest.mark.parametrize("slice_bits", [1, 4, 16])
def test_equals_brute_force(spark, slice_bits):
    """Slices of 2 and of 16 rows cut most conversations into segments."""
    rng = random.Random(slice_bits)
    rows = [r for conv in range(120) for r in made(rng, conv, rng.choice([1, 2, 3, 5, 8, 13]))]
    rows += made(rng, 1000, 150) + made(rng, None, 9)
    rows += [(2000, 1, "user", "The same."), (2000, 1, "user", "The same.")] * 20
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 as seq", "'x' as segment", "2 as fault")
    got = repair_report(df, slice_bits)
    assert got.columns == COLUMNS
    assert {tuple(r) for r in got.collect()} == plain_report(rows)


def test_a_conversation_that_is_lost_whole_and_an_empty_table(spark):
    lost = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(lost, 0, "user", "Hello."), (lost, 0, "assistant", "Hello!"), (7, 0, "user", "z" * 300_000 + ".")]
    got = {tuple(r) for r in repair_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == plain_report(rows)
    assert (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) in got
    assert repair_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ranked_paths_are_least():
    """Random acyclic graphs: audits by doubled pointers equal those of a plain recursion."""
    rng = random.Random(5)
    for _ in range(30):
        n = rng.randrange(2, 60)
        letters, targets = np.zeros((n, 4), int), np.zeros((n, 4), int)
        for x in range(n - 2):
            for arc in rng.sample(range(4), rng.randrange(1, 4)):
                letters[x, arc], targets[x, arc] = arc + 1, rng.randrange(x + 1, n)
        taken, pointers = rank_paths(letters, targets)

        def audit(x):
            return [] if not letters[x].any() else min([letters[x, a], *audit(targets[x, a])] for a in range(4) if letters[x, a])

        for x in range(n):
            path, at = [], x
            while taken[at]:
                path.append(taken[at])
                at = pointers[0][at]
            assert path == audit(x)
            jump = x
            for k, pointer in enumerate(pointers):
                steps, jump = 1 << k, x
                for _ in range(steps):
                    jump = pointers[0][jump]
                assert pointer[x] == jump


def test_query_equals_brute_force(spark):
    from larder.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op12_path_ranks"](spark, folder)
    assert got.columns == COLUMNS
    assert {tuple(r) for r in got.collect()} == plain_report(rows)
