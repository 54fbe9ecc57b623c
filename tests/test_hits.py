"""Hit model: flattening rules, nesting, local slices."""

from pyspark.sql import functions as F

from docindex.sources.hits import as_hits, flatten_hits, nest_hits, read_slice


def test_flatten_rules(spark):
    hits = spark.createDataFrame(
        [("test", "_doc", "1", None, {"value": 1, "_index": "from-source"})],
        "_index string, _type string, _id string, _score double, "
        "_source struct<value:int,_index:string>")
    row = flatten_hits(hits).first().asDict()
    assert row == {"_type": "_doc", "_id": "1", "_score": None, "value": 1, "_index": "from-source"}
    sel = flatten_hits(hits, source_fields=["value"], meta_fields=["id"])
    assert sel.columns == ["_id", "value"]
    assert flatten_hits(hits, source_fields=["value"], meta_fields=["_id"]).columns == ["_id", "value"]


def test_nest_then_flatten_round_trip(spark):
    df = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    flat = flatten_hits(as_hits(df, "ix", "k"))
    back = flatten_hits(nest_hits(flat))
    assert sorted(map(tuple, back.select(*flat.columns).collect())) == sorted(map(tuple, flat.collect()))


def test_slices_are_disjoint_and_complete(spark):
    flat = flatten_hits(as_hits(spark.range(1000).select(F.col("id").alias("k")), "ix", "k"))
    parts = [set(r._id for r in read_slice(flat, i, 7).collect()) for i in range(7)]
    assert sum(len(p) for p in parts) == 1000
    assert len(set().union(*parts)) == 1000
    assert all(parts)
