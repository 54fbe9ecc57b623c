"""Slices read their own buckets; bounds come from footers."""

import pytest

from docindex.sources.slices import drop_slices, read_slices, write_slices
from docindex.sources.stats import column_bounds


def test_slices_are_disjoint_complete_and_pruned(spark):
    df = spark.createDataFrame([(str(i), i) for i in range(500)], "_id string, n int").repartition(3)
    name = write_slices(df, 8)
    try:
        parts = [sorted(r.n for r in read_slices(spark, name, k).collect()) for k in range(8)]
        assert sorted(n for p in parts for n in p) == list(range(500)) and all(parts)
        assert sorted(r.n for r in read_slices(spark, name, [1, 4]).collect()) == sorted(parts[1] + parts[4])
        assert read_slices(spark, name).count() == 500 and read_slices(spark, name).columns == ["_id", "n"]
        # the plan tells of buckets where it keeps rows in them; files are skipped either way
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
        plan = read_slices(spark, name, 3)._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 1 out of 8" in plan
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        drop_slices(spark, name)
    with pytest.raises(ValueError):
        write_slices(df.selectExpr("_id", "n as _slice"), 2)


def test_bounds_from_footers(spark, tmp_path):
    spark.range(1000).selectExpr("id", "cast(id % 7 as int) as k").repartition(3).write.parquet(f"{tmp_path}/t")
    got = column_bounds(spark, f"{tmp_path}/t", ["id", "k"])
    assert [tuple(r) for r in got.collect()] == [(1000, 0, 999, 0, 6)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id), MIN(k), MAX(k)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
