from __future__ import annotations

import duckdb

import corpus_pipeline
from actlens.llm import queries as R
from actlens.llm.common import table


def test_stages_keep_the_documents_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    names, n = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        assert docs.count() <= n
        n = docs.count()
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == names
    assert docs.columns == ["doc_id", "n_tokens", "token_ids"]
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").collect()) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())


def test_stages_take_empty_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0


def test_sql_of_queries(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    for name, sql in R.oracle_sql().items():
        df = R.queries()[name](spark, sf_dir)
        result = con.execute(sql)
        names = [d[0] for d in result.description]
        want = sorted(result.fetchall())
        assert [tuple(r) for r in sorted(df.select(*names).collect())] == want, name
