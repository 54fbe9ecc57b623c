"""Value conversions: every date-only format, timestamps, one-or-many,
vector length checks, conform with required fields."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docindex.functions.values import conform, parse_date, parse_timestamp
from docindex.sources.mapping import DATE_ONLY_FORMATS, mapping_to_struct
from docindex.sources.json_hits import hits_from_json

# One text per date-only format, all meaning 2024-01-30
# (ISO week 2024-W05, Tuesday), except the coarser formats.
SAMPLES = {
    "date": ("2024-01-30", "2024-01-30"),
    "basic_date": ("20240130", "2024-01-30"),
    "basic_ordinal_date": ("2024030", "2024-01-30"),
    "basic_week_date": ("2024W052", "2024-01-30"),
    "ordinal_date": ("2024-030", "2024-01-30"),
    "strict_date": ("2024-01-30", "2024-01-30"),
    "strict_ordinal_date": ("2024-030", "2024-01-30"),
    "strict_week_date": ("2024-W05-2", "2024-01-30"),
    "strict_weekyear": ("2024", "2024-01-01"),
    "strict_weekyear_week": ("2024-W05", "2024-01-29"),
    "strict_weekyear_week_day": ("2024-W05-2", "2024-01-30"),
    "strict_year": ("2024", "2024-01-01"),
    "strict_year_month": ("2024-01", "2024-01-01"),
    "strict_year_month_day": ("2024-01-30", "2024-01-30"),
    "week_date": ("2024-W05-2", "2024-01-30"),
    "weekyear": ("2024", "2024-01-01"),
    "weekyear_week": ("2024-W05", "2024-01-29"),
    "weekyear_week_day": ("2024-W05-2", "2024-01-30"),
    "year": ("2024", "2024-01-01"),
    "year_month": ("2024-01", "2024-01-01"),
    "year_month_day": ("2024-01-30", "2024-01-30"),
    "yyyy-MM-dd": ("2024-01-30", "2024-01-30"),
}


def test_every_date_only_format(spark):
    assert set(SAMPLES) == set(DATE_ONLY_FORMATS)
    cols = [parse_date(F.lit(text), fmt).cast("string").alias(fmt) for fmt, (text, _) in SAMPLES.items()]
    row = spark.range(1).select(*cols).first()
    assert {k: row[k] for k in SAMPLES} == {k: v for k, (_, v) in SAMPLES.items()}


def test_week_year_edges(spark):
    # ISO week-year 2021 starts on Monday 2021-01-04; 2020-W53-5 is 2021-01-01
    row = spark.range(1).select(parse_date(F.lit("2021-W01-1"), "week_date").cast("string").alias("a"),
                                parse_date(F.lit("2020-W53-5"), "week_date").cast("string").alias("b"),
                                parse_date(F.lit("garbage"), "week_date").alias("c")).first()
    assert (row.a, row.b, row.c) == ("2021-01-04", "2021-01-01", None)


def test_timestamps_from_text_and_epoch_millis(spark):
    row = spark.range(1).select(
        F.unix_millis(parse_timestamp(F.lit("2024-01-30T10:00:00Z"))).alias("a"),
        F.unix_millis(parse_timestamp(F.lit("1706608800000"))).alias("b"),
        F.unix_millis(parse_timestamp(F.lit(1706608800000))).alias("c")).first()
    assert row.a == row.b == row.c == 1706608800000


def test_json_hits_one_or_many_and_vectors(spark):
    lines = ['{"_id":"1","_source":{"tags":"a","vec":[1,2,3]}}',
             '{"_id":"2","_source":{"tags":["a","b"],"vec":[1,2,3]}}',
             '{"_id":"3","_source":{"tags":[]}}',
             '{"_id":"4","_source":{"tags":null}}',
             '{"_id":"5","_source":{}}']
    df = spark.createDataFrame([(x,) for x in lines], "hit string")
    schema = StructType.fromDDL("_id string, tags array<string>")
    got = {r._id: r.tags for r in hits_from_json(df, "hit", schema).collect()}
    assert got == {"1": ["a"], "2": ["a", "b"], "3": [], "4": None, "5": None}
    vec = mapping_to_struct({"vec": {"type": "dense_vector", "dims": 3}})
    ok = hits_from_json(df.limit(2), "hit", vec).collect()
    assert [list(r.vec) for r in ok] == [[1.0, 2.0, 3.0], [1.0, 2.0, 3.0]]
    bad = spark.createDataFrame([('{"_source":{"vec":[1,2]}}',)], "hit string")
    with pytest.raises(PySparkException, match="expected 3 dims"):
        hits_from_json(bad, "hit", vec).collect()


def test_conform_required_and_missing(spark):
    df = spark.createDataFrame([(1, None)], "a long, b string")
    out = conform(df, StructType.fromDDL("a int not null, c string"))
    assert out.columns == ["a", "c"] and out.first() == (1, None)
    with pytest.raises(PySparkException, match="required field 'b'"):
        conform(df, StructType.fromDDL("b string not null")).collect()


def test_conform_keeps_mapping_metadata(spark):
    from docindex.functions.query import where_query
    df = spark.createDataFrame([("1", "Hello brave world"), ("2", "bravery")], "_id string, t string")
    mapped = conform(df, mapping_to_struct({"t": {"type": "text"}, "_id": {"type": "keyword"}}))
    assert mapped.schema["t"].metadata["es_type"] == "text"
    got = where_query(mapped, {"term": {"t": "brave"}}).select("_id").collect()
    assert [r._id for r in got] == ["1"]


@pytest.mark.parametrize("tz", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_timestamps_do_not_depend_on_session_zone(spark, tz):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        texts = ["2024-01-30T10:00:00Z", "2024-01-30T10:00:00", "1706608800000",
                 "2024-01-30T11:00:00+01:00", "2024-01-30 10:00:00"]
        row = spark.range(1).select(*[F.unix_millis(parse_timestamp(F.lit(t))).alias(f"c{i}")
                                      for i, t in enumerate(texts)]).first()
        assert set(row) == {1706608800000}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_conform_keeps_nested_metadata(spark):
    from docindex.functions.query import where_query
    df = spark.createDataFrame([("1", ("Hello brave world", "k")), ("2", ("bravery", "k"))],
                               "_id string, obj struct<title:string,tag:string>")
    sch = mapping_to_struct({"_id": {"type": "keyword"},
                             "obj": {"properties": {"title": {"type": "text"}, "tag": {"type": "keyword"}}}})
    mapped = conform(df, sch)
    assert mapped.schema["obj"].dataType["title"].metadata["es_type"] == "text"
    got = where_query(mapped, {"term": {"obj.title": "brave"}}).select("_id").collect()
    assert [r._id for r in got] == ["1"]


def test_inferred_schema_over_all_hits(spark):
    from docindex.sources.json_hits import infer_source_schema
    lines = ['{"_id":"1","_source":{"a":1,"t":"x","tags":"s","o":{"p":1.5},"n":[{"k":"a"}]}}',
             '{"_id":"2","_source":{"a":2.5,"tags":["s","t"],"o":{"q":"z"},"big":12345678901}}']
    df = spark.createDataFrame([(x,) for x in lines], "hit string")
    sch = infer_source_schema(df, "hit")
    types = {f.name: f.dataType.simpleString() for f in sch.fields}
    assert types == {"a": "double", "big": "bigint", "n": "array<struct<k:string>>",
                     "o": "struct<p:double,q:string>", "t": "string", "tags": "variant"}
    rows = {r._id: r for r in hits_from_json(df, "hit").collect()}
    assert rows["2"].a == 2.5 and rows["1"].o.p == 1.5 and rows["2"].big == 12345678901


def test_single_valued_field_meeting_a_list(spark):
    lines = ['{"_id":"1","_source":{"n":5}}', '{"_id":"2","_source":{"n":[7]}}',
             '{"_id":"3","_source":{"n":[8,9]}}']
    df = spark.createDataFrame([(x,) for x in lines], "hit string")
    schema = StructType.fromDDL("_id string, n bigint")
    two = spark.createDataFrame([(x,) for x in lines[:2]], "hit string")
    ok = {r._id: r.n for r in hits_from_json(two, "hit", schema).collect()}
    assert ok == {"1": 5, "2": 7}
    with pytest.raises(PySparkException, match="several values"):
        hits_from_json(df, "hit", schema).collect()


def test_unreadable_value_names_field_and_document(spark):
    df = spark.createDataFrame([('{"_id":"9","_source":{"n":"abc","m":null}}',)], "hit string")
    with pytest.raises(PySparkException, match="n.*document 9.*abc"):
        hits_from_json(df, "hit", StructType.fromDDL("_id string, n bigint")).collect()
    assert hits_from_json(df, "hit", StructType.fromDDL("_id string, m bigint")).first().m is None


@pytest.mark.parametrize("prop,value", [
    ({"type": "date", "format": "basic_date"}, "2024-01-30"), ({"type": "date"}, "not a date"), ({"type": "integer"}, "x1"), ({"type": "byte"}, "300"),
    ({"type": "boolean"}, "perhaps"), ({"type": "double"}, "1,5"),
])
def test_unreadable_values_fail_with_their_place(spark, prop, value):
    df = spark.createDataFrame([("7", value), ("8", None)], "_id string, f string")
    schema = mapping_to_struct({"_id": {"type": "keyword"}, "f": prop})
    with pytest.raises(Exception, match="field f of document 7 is not a .*: " + value):
        conform(df, schema).collect()
    assert [r.f for r in conform(df.where("_id = '8'"), schema).collect()] == [None]
    nested = df.selectExpr("_id", "array(named_struct('g', f)) as o")
    with pytest.raises(Exception, match="field o.g of document 7"):
        conform(nested, mapping_to_struct({"_id": {"type": "keyword"}, "o": {"type": "nested", "properties": {"g": prop}}})).collect()


def test_declared_formats_and_dims(spark):
    from docindex.sources.model import Date, DenseVector, Document, model_to_struct

    class Day(Document):
        d = Date(format="basic_date")
        v = DenseVector(dims=3)

    schema = model_to_struct(Day, meta_fields=[])
    df = spark.createDataFrame([("20240130", [1.0, 2.0, 3.0])], "d string, v array<float>")
    assert [str(r.d) for r in conform(df, schema).collect()] == ["2024-01-30"]
    with pytest.raises(Exception, match="expected 3 dims, got 1"):
        conform(spark.createDataFrame([("20240130", [1.0])], "d string, v array<float>"), schema).collect()
