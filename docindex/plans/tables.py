"""Loading the test tables as indices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docindex.sources.hits import as_hits, flatten_hits

# Id column of each driver table used as an index.
ID_COLUMNS = {
    "region": "r_regionkey",
    "nation": "n_nationkey",
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": None,
    "events": "event_id",
    "documents": "doc_id",
    "labels": "doc_id",
    "embeddings": "vec_id",
    "pages": "page_id",
    "benchmark": "item_id",
    "conversations": None,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hits(spark: SparkSession, sf_dir: str, name: str, **kw) -> DataFrame:
    """The table as nested hits of index ``name``."""
    return as_hits(table(spark, sf_dir, name), name, ID_COLUMNS.get(name), **kw)


def index(spark: SparkSession, sf_dir: str, name: str, **kw) -> DataFrame:
    """The table as flat rows, as a reader of index ``name`` returns them."""
    return flatten_hits(hits(spark, sf_dir, name, **kw))
