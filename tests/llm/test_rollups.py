import base64

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from larder.llm.common import tokenizer_path
from larder.llm.rollups import TokenTotals, token_counts

CHANGES = "doc_id long, seq int, op string, source string, lang string, version string, tokens long"


def replay(batches):
    state = {}
    for rows in batches:
        for doc, _, op, *value in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] == "delete")):
            if doc is None:
                continue
            if op == "delete":
                state.pop(doc, None)
            else:
                state[doc] = (*value[:3], value[3] or 0)
    sums = {}
    for source, lang, version, tokens in state.values():
        docs, n = sums.get((source, lang, version), (0, 0))
        sums[source, lang, version] = docs + 1, n + tokens
    return sums


def read(tables):
    return {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in tables.totals().collect()}


BATCHES = [
    [(i, 0, "insert", f"s{i % 3}", "en", "v1", 10 * i) for i in range(30)] + [(None, 0, "insert", "s0", "en", "v1", 5), (40, 0, "insert", None, None, "v1", None)],
    [(3, 0, "revise", "s0", "en", "v2", 7), (4, 0, "delete", None, None, None, None), (99, 0, "delete", None, None, None, None),
     (50, 0, "revise", "new", "fr", "v2", 11), (5, 0, "revise", "s1", "en", "v1", 1), (5, 1, "revise", "s2", "en", "v1", 2), (6, 1, "delete", None, None, None, None), (6, 0, "insert", "s0", "en", "v1", 3)],
    [(4, 0, "insert", "s1", "de", "v2", 13), (50, 0, "delete", None, None, None, None), (0, 0, "insert", "s0", "en", "v1", 1)],
]


def test_totals_follow_the_changes(spark, tmp_path):
    tables = TokenTotals(spark, str(tmp_path / "totals"))
    assert read(tables) == {}
    for n, rows in enumerate(BATCHES, 1):
        assert tables.commit(n, spark.createDataFrame(rows, CHANGES))
        assert read(tables) == replay(BATCHES[:n])
        assert not tables.commit(n, spark.createDataFrame(rows, CHANGES))
        assert read(tables) == replay(BATCHES[:n])
    assert tables.commit(9, spark.createDataFrame([], CHANGES)) and read(tables) == replay(BATCHES)


def test_a_batch_that_died_counts_once(spark, tmp_path, monkeypatch):
    tables = TokenTotals(spark, str(tmp_path / "totals"))
    tables.commit(1, spark.createDataFrame(BATCHES[0], CHANGES))
    write = TokenTotals._replace

    def die_before_the_record(self, rows, folder, batch, *by):
        if folder.endswith("commits"):
            raise RuntimeError("lost")
        write(self, rows, folder, batch, *by)

    monkeypatch.setattr(TokenTotals, "_replace", die_before_the_record)
    try:
        tables.commit(2, spark.createDataFrame(BATCHES[1], CHANGES))
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert read(tables) == replay(BATCHES[:1])
    assert tables.commit(2, spark.createDataFrame(BATCHES[1], CHANGES))
    assert read(tables) == replay(BATCHES[:2])


def test_counts_are_the_tokenizers(make_docs):
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", None, "Hello <|endoftext|> world", "é" * 1000, "many words " * 5000]
    docs = make_docs(list(enumerate(texts))).withColumn("tokens", F.lit("own"))
    got = {r.doc_id: r.tokens for r in token_counts(docs, open(path, "rb").read(), public_tokenizers.PATTERN).collect()}
    assert got == {i: len(plain.encode_ordinary(t or "")) for i, t in enumerate(texts)}


def test_late_batches_are_refused(spark, tmp_path):
    tables = TokenTotals(spark, str(tmp_path / "totals"))
    tables.commit(2, spark.createDataFrame([(1, 0, "insert", "a", "en", "v", 10)], CHANGES))
    with pytest.raises(ValueError):
        tables.commit(1, spark.createDataFrame([(1, 0, "insert", "a", "en", "v", 7)], CHANGES))
    assert not tables.commit(2, spark.createDataFrame([], CHANGES))
    assert read(tables) == {("a", "en", "v"): (1, 10)}


def test_query_equals_brute_force(spark):
    from larder.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    bad = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if r.quality == 0}
    expected = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        if r.doc_id not in bad:
            docs, tokens = expected.get((r.source, r.lang, "byte_bpe_50k"), (0, 0))
            expected[r.source, r.lang, "byte_bpe_50k"] = docs + 1, tokens + len(plain.encode_ordinary(r.text or ""))
    got = {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in QUERIES["op8_token_rollups"](spark, folder).collect()}
    assert got == expected


def test_snapshots_change_no_total(spark, tmp_path):
    tables = TokenTotals(spark, str(tmp_path / "totals"))
    assert not tables.compact()
    for n, rows in enumerate(BATCHES, 1):
        tables.commit(n, spark.createDataFrame(rows, CHANGES))
        assert tables.compact() and not tables.compact()
        assert read(tables) == replay(BATCHES[:n])
    late = [(3, 0, "delete", None, None, None, None), (7, 0, "revise", "s9", "en", "v3", 1)]
    tables.commit(9, spark.createDataFrame(late, CHANGES))
    assert read(tables) == replay([*BATCHES, late])


def test_a_small_batch_reads_its_buckets_and_the_last_snapshot(spark, tmp_path):
    tables = TokenTotals(spark, str(tmp_path / "totals"))
    for n in range(1, 4):
        tables.commit(n, spark.createDataFrame([(i, 0, "insert", "s", "en", f"v{n}", i) for i in range(400)], CHANGES))
    some = tables._before(4, [5, 6])
    scans = [part.split("]")[0] for part in some._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1:]]
    assert any("bucket" in filters and "5,6" in filters for filters in scans)
    assert {r.bucket for r in some.select("bucket").distinct().collect()} == {5, 6}
    tables.compact()
    after = tables._before(4, [5, 6])
    assert some.count() == 3 * after.count() > 0  # a row a document, not one a batch
    assert sorted(map(tuple, tables._newest(after).collect())) == sorted(map(tuple, tables._newest(some).collect()))


def test_a_snapshot_that_died_is_not_read(spark, tmp_path, monkeypatch):
    tables = TokenTotals(spark, str(tmp_path / "totals"))
    tables.commit(1, spark.createDataFrame(BATCHES[0], CHANGES))
    write = TokenTotals._replace

    def die(self, rows, folder, batch, *by):
        if folder.endswith("snapshots"):
            raise RuntimeError("lost")
        write(self, rows.limit(1), folder, batch, *by)

    monkeypatch.setattr(TokenTotals, "_replace", die)
    with pytest.raises(RuntimeError):
        tables.compact()
    monkeypatch.undo()
    tables.commit(2, spark.createDataFrame(BATCHES[1], CHANGES))
    assert read(tables) == replay(BATCHES[:2])
