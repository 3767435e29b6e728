from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from larder.llm.mixing import MixRules, entropy_rates, mix_documents, mixed_corpus, source_targets


def water_fill(sizes, weights=(1, 2, 3), cap=3):
    """Targets by repeated sharing of the excess."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, open_ = float(sum(sizes.values())), {}, list(names)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            open_.remove(s)


def test_targets_are_shared_by_weight_up_to_the_cap(spark):
    sizes = {"a": 1000, "b": 10, "c": 300, "B": 40, None: 500, "é": 7}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    assert got == pytest.approx(water_fill(sizes))


def test_rates_meet_the_targets_of_two_families(spark):
    cells = spark.createDataFrame(
        [("a", "en", 500), ("a", "fr", 100), ("b", "en", 200), ("b", "fr", 400), ("c", None, 50)], "source string, lang string, tokens long"
    )
    by_source = spark.createDataFrame([("a", 300.0), ("b", 700.0), ("c", 100.0)], "source string, target double")
    by_lang = spark.createDataFrame([("en", 520.0), ("fr", 480.0), (None, 100.0)], "lang string, target double")
    rows = entropy_rates(cells, {"source": by_source, "lang": by_lang}).collect()
    for name, goal in (("source", {"a": 300, "b": 700, "c": 100}), ("lang", {"en": 520, "fr": 480, None: 100})):
        sums = defaultdict(float)
        for r in rows:
            sums[r[name]] += r.rate * r.tokens
        assert sums == pytest.approx(goal, rel=1e-6)
    # odds are products of one factor per category, as an exponential tilt has them
    odds = {(r.source, r.lang): r.rate / (3 - r.rate) for r in rows}
    assert (odds["a", "en"] / odds["a", "fr"]) == pytest.approx(odds["b", "en"] / odds["b", "fr"], rel=1e-4)


def test_impossible_targets_are_refused(spark):
    cells = spark.createDataFrame([("a", "en", 100), ("b", "fr", 100)], "source string, lang string, tokens long")
    by_source = spark.createDataFrame([("a", 150.0), ("b", 50.0)], "source string, target double")
    by_lang = spark.createDataFrame([("en", 50.0), ("fr", 150.0)], "lang string, target double")
    with pytest.raises(ValueError, match="together"):
        entropy_rates(cells, {"source": by_source, "lang": by_lang}, MixRules(most_steps=15))


def test_taken_words_come_near_the_targets(make_docs):
    rows = [(i, "w " * (1 + i * 37 % 200), "abc"[i % 3] if i % 5 else None) for i in range(600)]
    mix = mix_documents(make_docs(rows))
    taken = mix.copies(mix.sized).groupBy("source").agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most")
    ).collect()
    for r in taken:
        assert abs(r.taken - r.target) <= 200
        assert r.most <= 3


def test_odd_rows(spark, make_docs):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y", None), (3, "x y", None), (None, "z", "b"), (5, "q " * 50_000, "c")]
    docs = make_docs(rows).withColumn("copies", F.lit("kept")).withColumn("size", F.lit(7))
    mix = mix_documents(docs)
    sizes = {r.doc_id: r["size"] for r in mix.sized.collect()}
    assert sizes == {1: 0, 2: 0, 3: 2, None: 1, 5: 50_000}
    out = mixed_corpus(docs)
    assert out.columns == docs.columns
    assert set(out.select("copies").distinct().collect()) <= {("kept",)}
    empty = make_docs([])
    assert mix_documents(empty).sized.count() == 0 and mixed_corpus(empty).count() == 0


def test_mixed_rows_are_the_reported_copies(make_docs):
    rows = [(i, "w " * (1 + i % 23), "ab"[i % 4 == 0]) for i in range(200)]
    docs = make_docs(rows)
    mix = mix_documents(docs)
    copies = {r.doc_id: r.copies for r in mix.copies(mix.sized).collect() if r.copies}
    seen = {r.doc_id: r["count"] for r in mixed_corpus(docs).groupBy("doc_id").count().collect()}
    assert seen == copies


def taken_by_source(mix):
    rows = mix.copies(mix.sized).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target")).collect()
    return {r.source: (r.taken, r.target) for r in rows}


@pytest.mark.parametrize("shared", [None, 5])
@pytest.mark.parametrize("same_text", [True, False])
def test_missing_and_repeated_ids_meet_the_target(make_docs, shared, same_text):
    """900 rows without an id, or all of one id, in one source; with equal texts they are ties."""
    rows = [(shared, "w w w" if same_text else f"w w {k}", "a") for k in range(900)] + [(1000 + k, f"w {k} w", "b") for k in range(300)]
    docs = make_docs(rows).repartition(7)
    mix = mix_documents(docs)
    for taken, target in taken_by_source(mix).values():
        assert abs(taken - target) <= 3
    copies = {(r.source, r.copies): r["count"] for r in mix.copies(mix.sized).groupBy("source", "copies").count().collect()}
    assert sum(n * c for (source, n), c in copies.items() if source == "a") * 3 == taken_by_source(mix)["a"][0]
    seen = {r.source: r["count"] for r in mixed_corpus(docs).groupBy("source").count().collect()}
    assert {s: n * 3 for s, n in seen.items()} == {s: t for s, (t, _) in taken_by_source(mix).items()}


def test_sql_agrees_on_repeated_rows(spark, make_docs, tmp_path):
    import duckdb

    from larder.llm.sql import MIX

    rows = [(None if k % 3 else 7, "w " * (1 + k % 4), "abc"[k % 5 % 3]) for k in range(400)] + [(k, "x y z", None) for k in range(50)]
    path = str(tmp_path / "documents")
    make_docs(rows).repartition(4).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{path}/*.parquet')")
    mix = mix_documents(spark.read.parquet(path))
    ours = mix.copies(mix.sized).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
    assert sorted(map(tuple, ours.collect()), key=repr) == sorted(map(tuple, con.execute(MIX).fetchall()), key=repr)
