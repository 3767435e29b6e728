import random

import duckdb
from pyspark.sql import functions as F

from larder.llm.queries import ORACLES
from larder.llm.revisits import RevisitRules, canonical_url, merged_headers, resolve_revisits

CAPTURES = "record_id long, kind string, url string, at long, digest string, etag string, last_modified string, headers map<string,string>"


def test_canonical_urls(spark):
    same = [
        "http://Example.com/a/b", "https://www.example.com:443/a/b/", "  http://example.com:80/a/b#top", "example.com/a/b?utm_source=x",
    ]
    other = ["http://example.com/A/b", "http://example.com/a/b?x=1&y=2", "https://example.com/a/b/?y=2&utm_medium=z&x=1", "http://example.com", None, ""]
    rows = [r.c for r in spark.createDataFrame([(u,) for u in same + other], "u string").select(canonical_url(F.col("u")).alias("c")).collect()]
    assert rows[:4] == ["example.com/a/b"] * 4
    assert rows[4:] == ["example.com/A/b", "example.com/a/b?x=1&y=2", "example.com/a/b?x=1&y=2", "example.com", None, ""]


def brute(rows):
    weak = lambda t: t[2:] if t.startswith("W/") else t
    out = []
    for i, kind, url, at, digest, etag, modified, headers in rows:
        if kind != "revisit":
            continue
        earlier = [r for r in rows if r[1] == "response" and r[2] == url and url is not None and at is not None and r[3] is not None and r[3] < at]
        if not earlier:
            out.append((i, "orphan", None, None))
            continue
        best = max(earlier, key=lambda r: (r[3], r[0]))
        votes = [a == b if k != 5 else weak(a) == weak(b) for k, a, b in ((4, digest, best[4]), (5, etag, best[5]), (6, modified, best[6])) if a is not None and b is not None]
        outcome = "unproven" if not votes else "resolved" if votes[0] else "changed"
        merged = None
        if outcome == "resolved":
            merged = {k.lower(): v for k, v in (best[7] or {}).items()} | {k.lower(): v for k, v in (headers or {}).items() if k.lower() in ("date", "etag", "expires")}
        out.append((i, outcome, best[0], merged))
    return sorted(out, key=str)


def test_matches_a_search_over_all_responses(spark):
    rng = random.Random(2)
    rows = []
    for i in range(500):
        tag = rng.choice([None, '"a"', 'W/"a"', '"b"'])
        rows.append((
            i, rng.choice(["response", "revisit"]), rng.choice(["hot.example/x"] * 5 + ["b.example/y", "c.example/z", None]), rng.choice([None, *range(60)]),
            rng.choice([None, None, "d1", "d2"]), tag, rng.choice([None, "Mon"]), rng.choice([None, {"Date": str(i), "ETag": str(tag), "Content-Length": str(i), "X": "1"}]),
        ))
    rows += [r for r in rows if r[1] == "revisit"][:20]
    for slices in (1, 7, 64):
        found = resolve_revisits(spark.createDataFrame(rows, CAPTURES).withColumn("key", F.lit("own")), RevisitRules(slices, ("date", "etag", "expires")))
        got = sorted(((r.record_id, r.outcome, r.response_id, r.headers) for r in found.collect()), key=str)
        assert got == brute(rows)
    assert resolve_revisits(spark.createDataFrame([], CAPTURES)).count() == 0


def test_only_permitted_headers_are_renewed(spark):
    maps = spark.createDataFrame([({"Content-Type": "text/html", "etag": "old", "ETag": "older"}, {"ETAG": "new", "Content-Type": "no", "Date": "d"})], "a map<string,string>, b map<string,string>")
    assert maps.select(merged_headers(F.col("a"), F.col("b"))).first()[0] == {"content-type": "text/html", "etag": "new", "date": "d"}


def test_the_ruled_query_has_every_outcome_and_merges_headers():
    con = duckdb.connect()
    con.execute("create view pages as select * from read_parquet('/root/testdata/sf0.001/pages.parquet')")
    made = f"({ORACLES['op1_revisits_ruled']})"
    counts = dict(con.execute(f"select outcome, count(*) from {made} group by 1").fetchall())
    assert set(counts) == {"resolved", "changed", "unproven", "orphan"}
    merged = con.execute(f"select count(*) from {made} where headers like '%max-age%' and headers like '%x-page%'").fetchone()[0]
    elsewhere = con.execute(f"select count(*) from {made} where response_page_id <> page_id").fetchone()[0]
    assert merged > 0 and elsewhere > 0
