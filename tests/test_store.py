import pytest
"""Folder store: versions, snapshot reads, several indices, bulk writes."""

import uuid

from pyspark.sql import functions as F

from docindex.session import shared_dir
from docindex.sources.store import read_index, versions, write_bulk, write_index


def _root(spark):
    return f"{shared_dir(spark)}/store-{uuid.uuid4().hex}"


def test_versions_and_snapshot(spark):
    root = _root(spark)
    rows = spark.range(10).select(F.col("id").cast("string").alias("_id"), F.col("id").alias("value"))
    assert write_index(rows, root, "test") == 1
    v1 = read_index(spark, root, "test")
    assert v1.agg(F.sum("value")).first()[0] == 45
    write_bulk(rows.where("value < 5").select("_id"), root, index="test", op_type="delete")
    assert versions(spark, root) == [1, 2]
    assert read_index(spark, root, "test").count() == 5
    assert read_index(spark, root, "test", version=1).count() == 10


def test_reference_write_then_read_example(spark):
    """Rename, add _id, write with field selection; full and filtered sums."""
    from docindex.functions.query import where_query
    root = _root(spark)
    rows = spark.range(10_000).withColumnRenamed("id", "value").withColumn("_id", F.col("value").cast("string"))
    write_bulk(rows, root, index="test", source_fields=["value"], meta_fields=["id"])
    df = read_index(spark, root, "test")
    assert df.agg(F.sum("value")).first()[0] == 49995000
    assert where_query(df, {"range": {"value": {"lt": 100}}}).agg(F.sum("value")).first()[0] == 4950
    assert set(df.columns) >= {"_index", "_id", "_version", "value"}


def test_several_indices_by_routing(spark):
    root = _root(spark)
    rows = spark.range(6).select(F.col("id").cast("string").alias("_id"),
                                 F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("_index"))
    write_index(rows, root)
    got = {r["_index"]: r["count"] for r in read_index(spark, root).groupBy("_index").count().collect()}
    assert got == {"even": 3, "odd": 3}
    assert read_index(spark, root, "odd").count() == 3


def test_order_column_survives_field_lists(spark):
    root = _root(spark)
    rows = spark.createDataFrame([("1", 1, 10), ("1", 2, 20)], "_id string, _o long, value long")
    write_bulk(rows, root, index="t", source_fields=["value"], meta_fields=["id"], order_col="_o")
    assert [r.value for r in read_index(spark, root, "t").collect()] == [20]


def test_numeric_looking_index_names_stay_text(spark):
    root = _root(spark)
    rows = spark.range(3).select(F.col("id").cast("string").alias("_id"), F.lit("007").alias("_index"))
    write_index(rows, root)
    df = read_index(spark, root, "007")
    assert dict(df.dtypes)["_index"] == "string" and df.count() == 3


def test_size_estimate_matches_files_on_disk(spark):
    import os
    from docindex.sources.stats import size_estimate
    path = "/root/testdata/sf0.001/events.parquet"
    row = size_estimate(spark.read.parquet(path)).first()
    assert (row.files, row.bytes) == (1, os.path.getsize(path))


def test_failed_write_leaves_no_version_and_hinders_none(spark, tmp_path):
    from pyspark.sql import functions as F
    from docindex.sources.store import read_index, versions, write_index
    root = str(tmp_path / "index")
    good = spark.range(3).select(F.col("id").cast("string").alias("_id"), F.col("id").alias("v"))
    assert write_index(good, root, index="a") == 1
    bad = good.withColumn("v", F.when(F.col("v") == 2, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        write_index(bad, root, index="a")
    assert versions(spark, root) == [1]
    assert write_index(good, root, index="a") == 2
    assert read_index(spark, root, "a").count() == 3
    with pytest.raises(FileExistsError):
        write_index(good, root, index="a", version=2)
