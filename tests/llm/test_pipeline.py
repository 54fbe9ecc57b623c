import pytest

import corpus_pipeline
from docindex.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, count = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "t")
        assert docs.columns == columns, name
        assert 0 < docs.count() <= count, name
        count = docs.count()
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    rows = {r.doc_id: r for r in out.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {i: r.text for i, r in rows.items()} == texts
    assert all(r.n_tokens == len(r.ids) for r in rows.values())


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "t")
    assert docs.collect() == []


@pytest.mark.parametrize("name", ["op3_warc", "op5_decontaminate", "op6_hamming_top_k", "op11_periodic_runs"])
def test_queries_match_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.execute(f"select {', '.join(columns)} from ({ORACLE[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, want))
