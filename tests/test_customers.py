import datetime as dt
import random
from collections import Counter, defaultdict

from larder.operators.customers import (
    active_sets, cohort_retention, customer_numbers, merged_sets, rfm_scores,
)

SCHEMA = "customer_id string, invoice_no string, date date, revenue double"


def lines(rng, size, customers=60):
    rows = []
    for _ in range(size):
        who = "hot" if rng.random() < 0.4 else rng.choice([None, *map(str, range(customers))])
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(500))
        rows.append((who, str(rng.randrange(size // 3)), day, float(rng.randrange(1, 500))))
    return rows


def plain_retention(rows):
    months = defaultdict(set)
    for who, _, day, _ in rows:
        if who is not None:
            months[who].add(day.replace(day=1))
    cells, sizes = Counter(), Counter()
    for own in months.values():
        first = min(own)
        sizes[first] += 1
        for m in own:
            cells[first, m] += 1
    return {(c, m, (m.year - c.year) * 12 + m.month - c.month, n, sizes[c], n / sizes[c]) for (c, m), n in cells.items()}


def test_retention_equals_plain_sets(spark):
    rows = lines(random.Random(1), 900)
    tx = spark.createDataFrame(rows, SCHEMA).repartition(4)
    numbers = customer_numbers(tx)
    got = cohort_retention(active_sets(tx, numbers))
    assert {tuple(r) for r in got.collect()} == plain_retention(rows)


def test_sets_of_batches_merge(spark):
    """Customers of a later batch get numbers of their own; old ones keep theirs."""
    rng = random.Random(2)
    rows = lines(rng, 400, 20) + lines(rng, 400, 90)
    first, second = (spark.createDataFrame(part, SCHEMA) for part in (rows[:400], rows[400:]))
    known = customer_numbers(first)
    numbers = customer_numbers(second, known)
    found = {r.customer_id: r.number for r in numbers.collect()}
    assert len(set(found.values())) == len(found) == len({r[0] for r in rows if r[0]})
    assert {r.customer_id: r.number for r in known.collect()}.items() <= found.items()
    sets = merged_sets(active_sets(first, known), active_sets(second, numbers))
    assert {tuple(r) for r in cohort_retention(sets).collect()} == plain_retention(rows)


def test_no_lines_have_no_cohorts_and_scores(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cohort_retention(active_sets(none, customer_numbers(none))).count() == 0
    assert rfm_scores(none).count() == 0
    unnamed = spark.createDataFrame([(None, "1", dt.date(2020, 1, 1), 1.0)], SCHEMA)
    assert rfm_scores(unnamed).count() == 0


def test_scores_equal_plain_tiles(spark):
    rows = lines(random.Random(3), 700, 33)
    got = {r.customer_id: r for r in rfm_scores(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    who = sorted({r[0] for r in rows if r[0] is not None})
    last = max(r[2] for r in rows)
    facts = {
        w: ((last - max(r[2] for r in rows if r[0] == w)).days, len({r[1] for r in rows if r[0] == w}), sum(r[3] for r in rows if r[0] == w))
        for w in who
    }
    assert set(got) == set(who)

    def tiles(key):
        ordered = sorted(who, key=key)
        least, more = divmod(len(ordered), 5)
        sizes = [least + (k < more) for k in range(5)]
        return dict(zip(ordered, [k + 1 for k, n in enumerate(sizes) for _ in range(n)]))

    r, f, m = tiles(lambda w: (-facts[w][0], w)), tiles(lambda w: (facts[w][1], w)), tiles(lambda w: (facts[w][2], w))
    for w in who:
        row = got[w]
        assert (row.recency_days, row.frequency, row.monetary) == facts[w]
        assert (row.r_score, row.f_score, row.m_score, row.rfm) == (r[w], f[w], m[w], f"{r[w]}{f[w]}{m[w]}")
