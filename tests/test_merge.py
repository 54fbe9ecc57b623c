"""One schema for several indices, with and without a server."""

import json
import os

import pytest
from pyspark.sql.types import StringType, VariantType
from test_datasource import FAKE, _setup

from docindex.sources.datasource import read_remote
from docindex.sources.mapping import mapping_to_struct
from docindex.sources.merge import merge_mappings, merge_schemas, union_indices


def merged(*props):
    return merge_schemas({str(i): mapping_to_struct(p) for i, p in enumerate(props)})


@pytest.mark.parametrize("a,b,want", [
    ("byte", "short", "smallint"), ("integer", "long", "bigint"), ("long", "unsigned_long", "decimal(20,0)"), ("short", "float", "float"), ("integer", "float", "double"),
    ("long", "double", "double"), ("keyword", "text", "string"), ("boolean", "boolean", "boolean"),
])
def test_lattice(a, b, want):
    for x, y in ((a, b), (b, a)):
        out = merged({"f": {"type": x}}, {"f": {"type": y}})
        assert out.schema["f"].dataType.simpleString() == want and not out.conflicts


def test_objects_lists_dates_and_conflicts():
    out = merged({"o": {"properties": {"x": {"type": "integer"}, "y": {"type": "keyword"}}}, "d": {"type": "date", "format": "yyyy-MM-dd"}, "l": {"type": "keyword"}, "c": {"type": "boolean"}},
                 {"o": {"properties": {"x": {"type": "double"}, "z": {"type": "date"}}}, "d": {"type": "date"}, "c": {"type": "nested", "properties": {"q": {"type": "long"}}}},
                 {"c": {"type": "long"}, "new": {"type": "keyword", "normalizer": "lowercase"}})
    kinds = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert kinds == {"o": "struct<x:double,y:string,z:timestamp>", "d": "timestamp", "l": "string", "c": "variant", "new": "string"}
    assert list(out.conflicts) == ["c"] and set(out.conflicts["c"]) == {"boolean", "array<struct<q:bigint>>", "bigint"} - {"array<struct<q:bigint>>"} | {"array<struct<q:bigint>>"}
    assert "format" not in out.schema["d"].metadata and out.schema["new"].metadata["normalizer"] == ["lowercase"]
    assert merged({"t": {"type": "text"}}, {"t": {"type": "keyword"}}).schema["t"].metadata["es_type"] == "text"


def test_union_of_frames(spark):
    a = spark.createDataFrame([("1", 5, "x", "s")], "_id string, n int, tags string, odd string")
    b = spark.createDataFrame([("1", 2.5, ["y", "z"], 7)], "_id string, n double, tags array<string>, odd int")
    got = union_indices({"a": a, "b": b})
    assert isinstance(got.schema["odd"].dataType, VariantType)
    rows = {r._index: (r._id, r.n, r.tags, r.odd) for r in got.selectExpr("_index", "_id", "n", "tags", "to_json(odd) as odd").collect()}
    assert rows == {"a": ("1", 5.0, ["x"], '"s"'), "b": ("1", 2.5, ["y", "z"], "7")}


def test_empty_and_warned():
    with pytest.raises(ValueError):
        merge_schemas({})
    with pytest.warns(UserWarning, match="field f"):
        out = merge_mappings({"a": {"mappings": {"properties": {"f": {"type": "long"}}}}, "b": {"mappings": {"properties": {"f": {"type": "text"}}}}, "empty": {"mappings": {}}}, StringType())
    assert out.schema["f"].dataType == StringType()


@pytest.mark.filterwarnings("ignore::UserWarning")
def test_remote_read_without_an_index(spark):
    path = _setup(20)
    docs = [{"_index": "a", "_id": str(i), "_source": {"n": i, "odd": i}} for i in range(6)] + [{"_index": "b", "_id": "x", "_source": {"n": 0.5, "odd": "text", "more": [1, 2]}}]
    with open(os.path.join(path, "docs.json"), "w") as f:
        json.dump(docs, f)
    with open(os.path.join(path, "mappings.json"), "w") as f:
        json.dump({"a": {"properties": {"n": {"type": "integer"}, "odd": {"type": "long"}}}, "b": {"properties": {"n": {"type": "double"}, "odd": {"type": "keyword"}, "more": {"type": "dense_vector", "dims": 2}}}}, f)
    df = read_remote(spark, transport=FAKE, **{"client.path": path}, slices=2)
    got = sorted((r._index, r._id, r.n, r.odd, r.more) for r in df.collect())
    assert got == [("a", str(i), float(i), str(i), None) for i in range(6)] + [("b", "x", 0.5, "text", [1.0, 2.0])]
