"""Field resolution: sub-fields, normalizers, null values, aliases, copies,
hidden and unmapped fields."""

import pytest
from pyspark.sql import functions as F

from docindex.functions.fields import FILTERS, HiddenField, fold, fold_text
from docindex.functions.query import where_query
from docindex.functions.values import conform
from docindex.sources.datasource import filter_to_clause
from docindex.sources.mapping import mapping_to_struct

MAPPING = {
    "_id": {"type": "keyword"},
    "name": {"type": "text", "copy_to": "all", "fields": {"raw": {"type": "keyword", "ignore_above": 12}, "low": {"type": "keyword", "normalizer": "lowercase"}, "plain": {"type": "text", "analyzer": "whitespace"}}},
    "code": {"type": "keyword", "null_value": "none", "copy_to": ["all", "codes"]},
    "codes": {"type": "keyword"},
    "all": {"type": "text"},
    "secret": {"type": "text", "index": False},
    "kept": {"type": "keyword", "index": False},
    "gone": {"type": "keyword", "index": False, "doc_values": False},
    "o": {"properties": {"x": {"type": "keyword", "normalizer": "lowercase"}, "label": {"type": "alias", "path": "o.x"}}},
    "other": {"type": "alias", "path": "name"},
    "tags": {"type": "keyword", "normalizer": "lowercase"},
}
ROWS = [
    ("1", "Red Fox", "A1", "s one", "K", "g", ("Äb",)),
    ("2", "red-fox jumps far", None, None, "L", None, ("ÄB",)),
    ("3", "The RED", "b2", "one", None, "g", None),
    ("4", None, None, None, "K", None, (None,)),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "_id string, name string, code string, secret string, kept string, gone string, o struct<x:string>")
    return conform(df, mapping_to_struct(MAPPING))


def ids(docs, q):
    return sorted(r._id for r in where_query(docs, q).select("_id").collect())


@pytest.mark.parametrize("q,want", [
    ({"match": {"name": "FOX"}}, ["1", "2"]),
    ({"term": {"name.raw": "Red Fox"}}, ["1"]),
    ({"term": {"name.raw": "red-fox jumps far"}}, []),  # longer than ignore_above
    ({"exists": {"field": "name.raw"}}, ["1", "3"]),
    ({"term": {"name.low": "RED FOX"}}, ["1"]),
    ({"terms": {"name.low": ["the red", "RED fox"]}}, ["1", "3"]),
    ({"prefix": {"name.low": "ReD-"}}, ["2"]),
    ({"wildcard": {"name.low": "*FOX*far"}}, ["2"]),
    ({"match": {"name.plain": "red-fox"}}, ["2"]),
    ({"match": {"name.plain": "fox"}}, []),
    ({"match_phrase": {"other": "red fox"}}, ["1", "2"]),
    ({"term": {"code": "none"}}, ["2", "4"]),
    ({"exists": {"field": "code"}}, ["1", "2", "3", "4"]),
    ({"range": {"code": {"gt": "b"}}}, ["2", "3", "4"]),
    ({"match": {"all": {"query": "fox a1", "operator": "and"}}}, ["1"]),
    ({"match": {"all": "b2 jumps"}}, ["2", "3"]),
    ({"term": {"codes": "A1"}}, ["1"]),
    ({"term": {"o.x": "äB"}}, ["1", "2"]),
    ({"term": {"o.label": "ÄB"}}, ["1", "2"]),
    ({"term": {"kept": "K"}}, ["1", "4"]),  # not indexed, found by doc values
    ({"term": {"name.unmapped": "x"}}, []),
    ({"term": {"nowhere.at.all": "x"}}, []),
    ({"bool": {"must_not": [{"term": {"nowhere": "x"}}]}}, ["1", "2", "3", "4"]),
    ({"multi_match": {"query": "RED FOX", "fields": ["name.l*"]}}, ["1"]),
])
def test_resolution(docs, q, want):
    assert ids(docs, q) == want


@pytest.mark.parametrize("q", [{"match": {"secret": "one"}}, {"term": {"gone": "g"}}, {"range": {"gone": {"gt": "a"}}}])
def test_hidden_fields_are_refused(docs, q):
    with pytest.raises(HiddenField):
        where_query(docs, q)


def test_strings_without_a_mapping_have_a_keyword(spark):
    df = spark.createDataFrame([("1", "Red Fox"), ("2", "x" * 300)], "_id string, name string")
    assert ids(df, {"term": {"name.keyword": "Red Fox"}}) == ["1"] and ids(df, {"term": {"name.keyword": "x" * 300}}) == []
    assert ids(df, {"match": {"name.keyword": "red"}}) == [] and ids(df, {"term": {"name.raw": "Red Fox"}}) == []


def test_filters_agree_on_columns_and_values(spark):
    words = ["Ångström", "İstanbul", "ΟΔΟΣ", "straße ÆØ", " x ", "ĳ", "née"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for value, column in FILTERS.values():
        assert [r[0] for r in df.select(column(F.col("w"))).collect()] == [value(w) for w in words]
    assert fold_text("Ångström née Øre") == "Angstrom nee Ore" and fold(F.col("w")) is not None


def test_only_exact_fields_are_pushed():
    from pyspark.sql.datasource import EqualTo, LessThan
    schema = mapping_to_struct({"a": {"type": "keyword"}, "b": {"type": "keyword", "normalizer": "lowercase"}, "c": {"type": "keyword", "index": False}, "d": {"type": "long", "null_value": 0}})
    assert filter_to_clause(LessThan(("a",), "a"), schema) == {"range": {"a": {"lt": "a"}}}
    assert all(filter_to_clause(EqualTo((c,), "x"), schema) is None for c in "bcd")


def test_greek_capitals(spark):
    df = spark.createDataFrame([("1", "ΟΔΟΣ.ΑΒ"), ("2", "η οδοσ αβ"), ("3", "ΟΔΟΣ")], "_id string, text string")
    assert ids(df, {"match": {"text": "ΟΔΟΣ"}}) == ["1", "2", "3"]
    assert ids(df, {"match_phrase": {"text": "ΟΔΟΣ ΑΒ"}}) == ["1", "2"]
    assert ids(df, {"bool": {"must": [{"match": {"text": "ΑΒ"}}, {"match": {"text": "οδοΣ"}}]}}) == ["1", "2"]
