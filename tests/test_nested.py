"""The relational nested query equals the in-row nested query."""

from pyspark.sql import functions as F

from docindex.functions.query import where_query
from docindex.operators.nested import where_nested

SF = "/root/testdata/sf0.001"


def test_where_nested_equals_array_form(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderstatus")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    inner = {"bool": {"must": [{"range": {"lines.l_quantity": {"gte": 40}}},
                               {"term": {"lines.l_returnflag": "R"}}],
                      "must_not": [{"term": {"lines.l_linestatus": "O"}}]}}
    q = {"nested": {"path": "lines", "query": inner}}
    # in-row form: small fixture only (collects each order's lines into an array)
    nested_docs = orders.join(
        lines.groupBy("l_orderkey").agg(F.collect_list(F.struct(
            "l_quantity", "l_returnflag", "l_linestatus")).alias("lines"))
        .withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
    a = {r.o_orderkey for r in where_query(nested_docs, q).select("o_orderkey").collect()}
    b = {r.o_orderkey for r in where_nested(orders, lines, "o_orderkey", "l_orderkey", "lines", inner)
         .select("o_orderkey").collect()}
    assert a == b and len(a) > 0
