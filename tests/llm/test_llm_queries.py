import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from larder.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    ours, theirs = QUERIES[name](spark, FOLDER).toPandas(), con.execute(ORACLES[name]).df()
    columns = sorted(ours.columns)
    key = [c for c in ("doc_id", "page_id", "conv_id") if c in columns]
    a, b = (x[columns].sort_values(key).reset_index(drop=True).astype(object).where(lambda y: y.notna(), None) for x in (ours, theirs))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_pipeline_stages_keep_the_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert len(ids) == out.count() and ids <= {r.doc_id for r in docs.select("doc_id").collect()}
        sizes.append(len(ids))
        docs = docs.filter(docs.doc_id.isin(list(ids)))
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").filter("quality = 1")
    good = docs.join(labels, "doc_id", "left_semi").count()
    assert sizes == sorted(sizes, reverse=True) and good > 0.6 * labels.count()


def test_pipeline_runs_whole(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.count() > 0 and {"doc_id", "ids", "begins", "ends"} <= set(out.columns)
    repeated = out.groupBy("doc_id").count().filter("count > 3").count()
    assert repeated == 0
