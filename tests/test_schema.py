"""Schema translation: explicit schema, declared models, typed models,
mappings (one case per mapping type, errors and warnings)."""

from __future__ import annotations

import dataclasses
import warnings
from typing import Optional

import pytest
from pyspark.sql.types import (
    ArrayType, BooleanType, ByteType, DateType, DecimalType, DoubleType, FloatType,
    IntegerType, LongType, MapType, ShortType, StringType, StructField, StructType,
    TimestampType,
)

from docindex.sources.mapping import mapping_to_struct
from docindex.sources.model import (
    Date, DenseVector, Document, InnerDoc, Keyword, Long, Nested, Object, Text, index_name, model_to_struct,
)
from docindex.sources.schema import META_FIELDS, as_struct, complete_schema


class _Contact(InnerDoc):
    phone = Keyword(required=True)
    notes = Text(multi=True)


class _Supplier(Document):
    s_suppkey = Long(required=True)
    s_name = Text(fields={"raw": {"type": "keyword"}})
    regions = Keyword(multi=True)
    main_contact = Object(_Contact)
    contacts = Nested(_Contact, required=True)
    opened = Date(format="basic_date")
    shape = DenseVector(dims=3)

    class Index:
        name = "supplier"


CONTACT = "struct<phone:string,notes:array<string>>"
SUPPLIER = {"s_suppkey": ("bigint", False), "s_name": ("string", True), "regions": ("array<string>", True), "main_contact": (CONTACT, True),
            "contacts": (f"array<{CONTACT}>", False), "opened": ("date", True), "shape": ("array<float>", True)}


def bare(t):
    """A type as JSON, without the mapping's notes."""
    if isinstance(t, dict):
        return {k: bare(v) for k, v in t.items() if k != "metadata"}
    return [bare(v) for v in t] if isinstance(t, list) else t


def kinds(schema):
    return {f.name: (f.dataType.simpleString(), f.nullable) for f in schema.fields}


def test_schema_as_ddl_is_verbatim(spark):
    assert kinds(as_struct("p_partkey BIGINT NOT NULL, p_name STRING")) == {"p_partkey": ("bigint", False), "p_name": ("string", True)}
    whole = as_struct("p_size INT")
    assert as_struct(whole) is whole


def test_declared_model():
    schema = model_to_struct(_Supplier)
    assert kinds(schema) == SUPPLIER | kinds(META_FIELDS)
    inner = schema["contacts"].dataType.elementType
    assert not inner["phone"].nullable and inner["notes"].nullable
    assert index_name(_Supplier) == "supplier"


@pytest.mark.parametrize("chosen", [["shape"], ["contacts", "s_suppkey"], ["s_name", "no_such_field"]])
def test_declared_model_narrowed(chosen):
    schema = model_to_struct(_Supplier, source_fields=chosen, meta_fields=[])
    assert kinds(schema) == {k: v for k, v in SUPPLIER.items() if k in chosen}


def test_declared_model_keeps_every_parameter():
    schema = model_to_struct(_Supplier)
    assert schema["opened"].metadata["format"] == "basic_date" and schema["shape"].metadata["dims"] == 3
    assert schema["s_name"].metadata["fields"] == {"raw": {"es_type": "keyword"}}


@dataclasses.dataclass
class _Customer:
    c_custkey: int
    c_name: str
    c_acctbal: Optional[float]
    c_orders: list[int]
    c_notes: Optional[list[str]]


def test_annotated_model():
    want = {"c_custkey": ("bigint", False), "c_name": ("string", False), "c_acctbal": ("double", True), "c_orders": ("array<bigint>", False), "c_notes": ("array<string>", True)}
    assert kinds(model_to_struct(_Customer)) == want | kinds(META_FIELDS)
    assert kinds(model_to_struct(_Customer, source_fields=["c_name"], meta_fields=["id"])) == {"c_name": ("string", False), "_id": ("string", True)}


def test_pydantic_model_if_available():
    pydantic = pytest.importorskip("pydantic")

    class Order(pydantic.BaseModel):
        o_orderkey: int
        o_comment: Optional[str]

    assert kinds(model_to_struct(Order, complete=False)) == {"o_orderkey": ("bigint", False), "o_comment": ("string", True)}


def test_completion_order_and_unknown_names():
    base = StructType([StructField("b", LongType()), StructField("a", StringType())])
    got = complete_schema(base, source_fields=["a", "b", "zzz"], meta_fields=["score", "id", "nope"])
    assert got.fieldNames() == ["b", "a", "_id", "_score"]
    assert complete_schema(base, meta_fields=[]).fieldNames() == ["b", "a"]


MAPPING_CASES = [
    ({"type": "boolean"}, BooleanType()),
    ({"type": "byte"}, ByteType()),
    ({"type": "short"}, ShortType()),
    ({"type": "integer"}, IntegerType()),
    ({"type": "long"}, LongType()),
    ({"type": "unsigned_long"}, DecimalType(20, 0)),
    ({"type": "half_float"}, FloatType()),
    ({"type": "float"}, FloatType()),
    ({"type": "double"}, DoubleType()),
    ({"type": "rank_feature"}, DoubleType()),
    ({"type": "text"}, StringType()),
    ({"type": "keyword"}, StringType()),
    ({"type": "ip"}, StringType()),
    ({"type": "search_as_you_type"}, StringType()),
    ({"type": "version"}, StringType()),
    ({"type": "date"}, TimestampType()),
    ({"type": "date", "format": "strict_date_optional_time"}, TimestampType()),
    ({"type": "date", "format": "yyyy-MM-dd||basic_date"}, DateType()),
    ({"type": "date", "format": "yyyy-MM-dd||epoch_millis"}, TimestampType()),
    ({"type": "dense_vector", "dims": 3}, ArrayType(FloatType(), False)),
    ({"type": "dense_vector", "dims": 3, "element_type": "byte"}, ArrayType(ByteType(), False)),
    ({"type": "dense_vector", "dims": 3, "element_type": "bit"}, ArrayType(BooleanType(), False)),
    ({"type": "rank_features"}, MapType(StringType(), DoubleType())),
    ({"properties": {"a": {"type": "long"}}}, StructType([StructField("a", LongType())])),
    ({"type": "object", "properties": {"a": {"type": "long"}}}, StructType([StructField("a", LongType())])),
    ({"type": "nested", "properties": {"a": {"type": "keyword"}}},
     ArrayType(StructType([StructField("a", StringType())]))),
]


@pytest.mark.parametrize("prop,expected", MAPPING_CASES)
def test_mapping_types(prop, expected):
    got = mapping_to_struct({"f": prop})
    assert bare(got["f"].dataType.jsonValue()) == bare(expected.jsonValue())
    assert got["f"].nullable


@pytest.mark.parametrize("kind", ["scaled_float", "binary"])
def test_mapping_warnings(kind):
    prop = {"type": kind, "scaling_factor": 10} if kind == "scaled_float" else {"type": kind}
    with pytest.warns(UserWarning):
        t = mapping_to_struct({"f": prop})["f"].dataType
    assert t == (DoubleType() if kind == "scaled_float" else StringType())


@pytest.mark.parametrize("prop,exc", [
    ({"type": "alias", "path": "x"}, NotImplementedError),
    ({"type": "dense_vector"}, ValueError),
    ({"type": "dense_vector", "dims": 2, "element_type": "half"}, NotImplementedError),
    ({"type": "nested"}, ValueError),
    ({"type": "geo_point"}, NotImplementedError),
])
def test_mapping_errors(prop, exc):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        with pytest.raises(exc):
            mapping_to_struct({"f": prop})


def test_search_settings_of_a_mapping():
    mapping = {"settings": {"index": {"analysis": {"normalizer": {"plain": {"type": "custom", "filter": ["lowercase", "asciifolding"]}}}}}, "mappings": {"properties": {
        "name": {"type": "text", "analyzer": "simple", "copy_to": ["all"], "fields": {"raw": {"type": "keyword", "ignore_above": 9}, "low": {"type": "keyword", "normalizer": "plain"}}},
        "code": {"type": "keyword", "null_value": "none", "index": False, "doc_values": False}, "all": {"type": "text"}, "title": {"type": "alias", "path": "name"},
        "o": {"properties": {"x": {"type": "keyword", "normalizer": "lowercase", "copy_to": "all"}, "y": {"type": "alias", "path": "o.x"}}}}}}
    got = mapping_to_struct(mapping)
    assert got.fieldNames() == ["name", "code", "all", "o"] and got["o"].dataType.fieldNames() == ["x"]
    assert got["name"].metadata == {"es_type": "text", "analyzer": "simple", "aliases": ["title"],
                                    "fields": {"raw": {"es_type": "keyword", "ignore_above": 9}, "low": {"es_type": "keyword", "normalizer": ["lowercase", "asciifolding"]}}}
    assert got["code"].metadata == {"es_type": "keyword", "null_value": "none", "index": False, "doc_values": False}
    assert got["all"].metadata["copied_from"] == ["name", "o.x"] and got["o"].dataType["x"].metadata["aliases"] == ["o.y"]
    with pytest.raises(NotImplementedError):
        mapping_to_struct({"a": {"type": "keyword", "normalizer": "unheard_of"}})
    with pytest.warns(UserWarning):
        mapping_to_struct({"a": {"type": "text", "analyzer": "english"}})


def test_mapping_response_forms():
    props = {"a": {"type": "keyword"}}
    for m in (props, {"properties": props}, {"mappings": {"properties": props}},
              {"idx": {"mappings": {"properties": props}}}):
        got = mapping_to_struct(m, index="idx" if "idx" in m else None)
        assert got.fieldNames() == ["a"]
        assert got["a"].metadata["es_type"] == "keyword"
    with pytest.raises(ValueError):
        mapping_to_struct({"other": {"mappings": {"properties": props}}}, index="idx")
