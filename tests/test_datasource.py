"""The docindex data source against a fake transport."""

from __future__ import annotations

import glob
import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from docindex.sources.datasource import count_remote, read_remote, register, size_remote

FAKE = "fake_index:factory"
N = 2500


def _setup(n=N, mapping=None):
    path = tempfile.mkdtemp(prefix="fake-index-")
    docs = [{"_id": str(i), "_source": {"value": i, "name": f"n{i % 7}", "ts": 1700000000000 + i}}
            for i in range(n)]
    with open(os.path.join(path, "docs.json"), "w") as f:
        json.dump(docs, f)
    with open(os.path.join(path, "mapping.json"), "w") as f:
        json.dump(mapping or {"properties": {"value": {"type": "long"}, "name": {"type": "keyword"},
                                             "ts": {"type": "date"}}}, f)
    return path


def _log(path, kind):
    out = []
    for p in sorted(glob.glob(os.path.join(path, "log", f"{kind}-*.json"))):
        with open(p) as f:
            out.append(json.load(f))
    return out


@pytest.mark.parametrize("slices", [1, 2, 7])
def test_sliced_read_is_disjoint_and_complete(spark, slices):
    path = _setup()
    df = read_remote(spark, "idx", transport=FAKE, **{"client.path": path}, slices=slices, chunk_size=1000)
    rows = df.select("_id", "value").collect()
    assert len(rows) == N and len({r._id for r in rows}) == N
    assert sum(r.value for r in rows) == N * (N - 1) // 2
    assert df.rdd.getNumPartitions() == slices
    searches = _log(path, "search")
    pits = {s["pit"]["id"] for s in searches}
    assert len(pits) == 1                       # one snapshot shared by all slices
    assert len(_log(path, "open")) >= 1
    if slices == 1:
        assert all("slice" not in s for s in searches)
    else:
        assert {s["slice"]["id"] for s in searches} == set(range(slices))
    assert all(s["size"] == 1000 and s["sort"] == ["_shard_doc"] for s in searches)


def test_schema_from_mapping_with_metadata(spark):
    path = _setup(10)
    df = read_remote(spark, "idx", transport=FAKE, **{"client.path": path})
    assert df.columns == ["value", "name", "ts", "_index", "_type", "_id", "_version", "_seq_no",
                          "_primary_term", "_score"]
    assert dict(df.dtypes)["ts"] == "timestamp"
    r = df.where(F.col("_id") == "3").first()
    assert (r.value, r.name, r._version) == (3, "n3", 1)


def test_field_selection_and_includes(spark):
    path = _setup(10)
    df = read_remote(spark, "idx", transport=FAKE, **{"client.path": path},
                     source_fields=["value"], meta_fields=["id"])
    assert df.columns == ["value", "_id"]
    assert df.count() == 10
    assert all(s["_source"]["includes"] == ["value"] for s in _log(path, "search"))


def test_explicit_schema_verbatim_and_required(spark):
    path = _setup(10)
    df = read_remote(spark, "idx", transport=FAKE, **{"client.path": path},
                     schema="value INT NOT NULL, missing STRING")
    assert df.columns == ["value", "missing"]
    assert df.agg(F.sum("value")).first()[0] == 45
    bad = read_remote(spark, "idx", transport=FAKE, **{"client.path": path},
                      schema="value INT, missing STRING NOT NULL")
    with pytest.raises(Exception, match="required field"):
        bad.collect()


def test_query_and_pushed_filters_reach_the_request(spark):
    path = _setup(100)
    df = read_remote(spark, "idx", {"range": {"value": {"lt": 50}}}, transport=FAKE,
                     **{"client.path": path})
    got = df.where(F.col("name") == "n3").select("value").collect()
    assert sorted(r.value for r in got) == [v for v in range(50) if v % 7 == 3]
    bodies = _log(path, "search")
    q = bodies[-1]["query"]
    assert q["bool"]["must"] == [{"range": {"value": {"lt": 50}}}]
    assert {"term": {"name": "n3"}} in q["bool"]["filter"]


def test_count_and_size(spark):
    path = _setup(100)
    opts = {"transport": FAKE, "client.path": path}
    assert count_remote("idx", {"range": {"value": {"lt": 10}}}, **opts) == 10
    assert size_remote("idx", **opts) == 1234


def _write(spark, df, path, **opts):
    register(spark)
    o = {"transport": FAKE, "client.path": path, "index": "out"}
    o.update({k: str(v) for k, v in opts.items()})
    df.write.format("docindex").mode("append").options(**o).save()


def _bulk_lines(path):
    return [line for req in _log(path, "bulk") for line in req]


def test_write_envelopes_chunks_and_nulls(spark):
    path = _setup(1)
    df = spark.range(10).select(F.col("id").cast("string").alias("_id"), F.col("id").alias("value"),
                                F.lit(None).cast("string").alias("note")).coalesce(1)
    _write(spark, df, path, chunk_size=3)
    reqs = _log(path, "bulk")
    assert len(reqs) == 4                       # 3 + 3 + 3 + 1 actions
    lines = _bulk_lines(path)
    assert json.loads(lines[0]) == {"index": {"_index": "out", "_id": "0"}}
    assert json.loads(lines[1]) == {"value": 0, "note": None}


def test_write_update_delete_and_byte_chunks(spark):
    path = _setup(1)
    df = spark.createDataFrame([("1", "update", 5), ("2", "delete", None)],
                               "_id string, _op_type string, value long").coalesce(1)
    _write(spark, df, path, max_chunk_bytes=40)
    lines = _bulk_lines(path)
    assert json.loads(lines[0]) == {"update": {"_index": "out", "_id": "1"}}
    assert json.loads(lines[1]) == {"doc": {"value": 5}}
    assert json.loads(lines[2]) == {"delete": {"_index": "out", "_id": "2"}}
    assert len(_log(path, "bulk")) == 2         # byte limit splits the two actions


def test_write_retries_rejections_then_succeeds(spark):
    path = _setup(1)
    df = spark.range(3).select(F.col("id").cast("string").alias("_id")).coalesce(1)
    _write(spark, df, path, fail_first=2, max_retries=3, initial_backoff=0.01, **{"client.fail_first": 2})
    assert len(_log(path, "bulk")) == 3


def test_write_fails_fast_on_item_error(spark):
    path = _setup(1)
    df = spark.range(5).select(F.col("id").cast("string").alias("_id")).coalesce(1)
    with pytest.raises(Exception, match="failed for _id='3'"):
        _write(spark, df, path, **{"client.fail_id": "3", "spark.task.maxFailures": 1})


def test_complex_types_through_arrow(spark):
    path = tempfile.mkdtemp(prefix="fake-index-")
    docs = [{"_id": "1", "_source": {"obj": {"a": 1, "b": "x"}, "items": [{"k": "p", "v": 2}],
                                     "feats": {"f1": 0.5}, "vec": [1.0, 2.0], "day": "2024-01-30",
                                     "tags": "solo"}},
            {"_id": "2", "_source": {"obj": None, "items": [], "feats": {}, "vec": [0.0, 1.0],
                                     "day": "2024-02-01", "tags": ["a", "b"]}}]
    with open(os.path.join(path, "docs.json"), "w") as f:
        json.dump(docs, f)
    with open(os.path.join(path, "mapping.json"), "w") as f:
        json.dump({"properties": {
            "obj": {"properties": {"a": {"type": "long"}, "b": {"type": "keyword"}}},
            "items": {"type": "nested", "properties": {"k": {"type": "keyword"}, "v": {"type": "integer"}}},
            "feats": {"type": "rank_features"},
            "vec": {"type": "dense_vector", "dims": 2},
            "day": {"type": "date", "format": "strict_date"},
        }}, f)
    df = read_remote(spark, "idx", transport=FAKE, **{"client.path": path}, meta_fields=["id"])
    rows = {r._id: r for r in df.collect()}
    assert rows["1"].obj.a == 1 and rows["1"].items[0].k == "p" and rows["1"].feats == {"f1": 0.5}
    assert rows["2"].obj is None and rows["2"].items == [] and list(rows["2"].vec) == [0.0, 1.0]
    assert str(rows["1"].day) == "2024-01-30"
    # one-or-many with an explicit list schema
    multi = read_remote(spark, "idx", transport=FAKE, **{"client.path": path},
                        schema="tags ARRAY<STRING>, _id STRING")
    assert {r._id: list(r.tags) for r in multi.collect()} == {"1": ["solo"], "2": ["a", "b"]}


def test_write_complex_types(spark):
    path = _setup(1)
    df = spark.createDataFrame([("1", {"a": 1.5}, [1, 2], ("x", 3))],
                               "_id string, m map<string,double>, arr array<int>, s struct<p:string,q:int>")
    _write(spark, df.coalesce(1), path)
    lines = _bulk_lines(path)
    assert json.loads(lines[1]) == {"m": {"a": 1.5}, "arr": [1, 2], "s": {"p": "x", "q": 3}}


def test_write_requires_ids_unless_allowed(spark):
    path = _setup(1)
    df = spark.range(2).select(F.col("id").alias("value")).coalesce(1)
    with pytest.raises(Exception, match="allow_auto_id"):
        _write(spark, df, path)
    path2 = _setup(1)
    _write(spark, df, path2, allow_auto_id="true")
    assert json.loads(_bulk_lines(path2)[0]) == {"index": {"_index": "out"}}


def test_track_scores_is_requested(spark):
    path = _setup(5)
    read_remote(spark, "idx", transport=FAKE, **{"client.path": path}, track_scores="true").count()
    assert all(b.get("track_scores") is True for b in _log(path, "search"))


def test_single_valued_field_meeting_a_list(spark):
    path = tempfile.mkdtemp(prefix="fake-index-")
    with open(os.path.join(path, "docs.json"), "w") as f:
        json.dump([{"_id": "1", "_source": {"name": ["a", "b"]}}], f)
    with open(os.path.join(path, "mapping.json"), "w") as f:
        json.dump({"properties": {"name": {"type": "keyword"}}}, f)
    df = read_remote(spark, "idx", transport=FAKE, **{"client.path": path}, meta_fields=["id"])
    with pytest.raises(Exception, match="several values"):
        df.collect()


def test_dates_follow_their_format():
    from docindex.sources.datasource import convert_value
    from pyspark.sql.types import DateType, IntegerType
    day = dt.date(2024, 1, 30)
    forms = {"basic_date": "20240130", "strict_date": "2024-01-30", "date": "2024-1-30", "basic_ordinal_date": "2024030", "ordinal_date": "2024-30",
             "strict_ordinal_date": "2024-030", "basic_week_date": "2024W052", "strict_week_date": "2024-W05-2"}
    for name, text in forms.items():
        assert convert_value(text, DateType(), "d", {"format": name}) == day, name
    assert convert_value("2024", DateType(), "d", {"format": "year"}) == dt.date(2024, 1, 1)
    assert convert_value("2024-03", DateType(), "d", {"format": "year_month"}) == dt.date(2024, 3, 1)
    assert convert_value("2024-W05", DateType(), "d", {"format": "weekyear_week"}) == dt.date(2024, 1, 29)
    with pytest.raises(ValueError):
        convert_value("30/01/2024", DateType(), "d", {"format": "basic_date"})
    with pytest.raises(ValueError):
        convert_value("abc", IntegerType(), "n")


def test_single_rejected_actions_are_sent_again():
    from docindex.sources.datasource import DocIndexWriter

    class Busy:
        calls = []

        def bulk(self, lines):
            self.calls.append(list(lines))
            if len(self.calls) == 1:
                return {"errors": True, "items": [{"index": {"_id": "1", "status": 201}}, {"index": {"_id": "2", "status": 429}}]}
            return {"errors": False, "items": []}
    busy = Busy()
    DocIndexWriter({"max_retries": "2", "initial_backoff": "0"}, None)._send(busy, [["h1", "b1"], ["h2", "b2"]])
    assert busy.calls == [["h1", "b1", "h2", "b2"], ["h2", "b2"]]
    Busy.calls = []
    with pytest.raises(RuntimeError, match="429"):
        DocIndexWriter({"max_retries": "0"}, None)._send(Busy(), [["h1", "b1"], ["h2", "b2"]])


def test_only_exact_fields_are_pushed():
    from docindex.sources.datasource import filter_to_clause
    from docindex.sources.mapping import mapping_to_struct
    from pyspark.sql.datasource import EqualTo, Not
    s = mapping_to_struct({"mappings": {"date_detection": False, "properties": {
        "k": {"type": "keyword"}, "i": {"type": "keyword", "ignore_above": 20}, "h": {"type": "half_float"}, "d": {"type": "date", "format": "basic_date"}, "n": {"type": "long"}}}})
    assert filter_to_clause(EqualTo(("k",), "a"), s) and filter_to_clause(EqualTo(("n",), 1), s)
    for flt in (EqualTo(("i",), "a"), EqualTo(("h",), 1.0), EqualTo(("d",), dt.date(2024, 1, 1)), Not(EqualTo(("k",), "a"))):
        assert filter_to_clause(flt, s) is None
    with pytest.raises(ValueError):
        mapping_to_struct({"idx": {"mappings": {}}}, index="idx")


def test_write_remote_helper(spark):
    from docindex.sources.datasource import write_remote
    path = _setup(1)
    df = spark.range(3).select(F.col("id").cast("string").alias("_id"), F.col("id").alias("v")).coalesce(1)
    write_remote(df, "out", op_type="create", transport=FAKE, **{"client.path": path})
    lines = _bulk_lines(path)
    assert json.loads(lines[0]) == {"create": {"_index": "out", "_id": "0"}}
    assert len(lines) == 6
