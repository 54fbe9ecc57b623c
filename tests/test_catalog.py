"""Every registered query vs its DuckDB SQL on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as E
from docindex.plans.catalog import QUERIES
from docindex.plans.oracle import ORACLE
from tools.check import TABLES, canon

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["sum_value", "n"]


def test_every_query_has_an_oracle_or_is_marked():
    rows_only = {"size_estimate"}
    assert set(QUERIES) - set(ORACLE) == rows_only
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[name])
    want = canon([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "PythonUDF",
                "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"map_documents", "map_document_batches", "map_documents_nullable"}))
def test_no_python_in_local_plans(spark, name):
    """Everything except user document transforms stays in the JVM."""
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in PYTHON_NODES), name


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_column_types_match_oracle(spark, con, name):
    from tools.types import DUCK, SPARK
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    s = {c: SPARK.get(t, t) for c, t in df.dtypes}
    d = {c: DUCK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert s == d
