"""Hits as JSON text: the wire form of a search response, one hit per value.

``hits_from_json`` parses a string column of hits into flat typed rows for
a target schema (metadata fields by name, source fields from ``_source``),
converting values as the mapping says: dates from text or epoch millis, one
value or a list into a list, objects into structs.  Parsing is Spark's own
(``from_json``, and ``parse_json`` for what doesn't fit), so it runs in the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
    VariantType,
    _parse_datatype_string,
)

from docindex.functions.values import _variant_value, parse_date, parse_timestamp, require, single_valued
from docindex.sources.schema import META_FIELDS, META_NAMES


def _decimal(m: re.Match) -> str:
    p, scale = int(m.group(1)), int(m.group(2))
    if scale > 0:
        return "DOUBLE"
    return "BIGINT" if p <= 18 else f"DECIMAL({p},0)"


def infer_source_schema(df: DataFrame, col: str) -> StructType:
    """One schema for the ``_source`` of all hits in ``df[col]``.

    A single partial aggregate (``schema_of_variant_agg``); only the schema
    text comes back.  JSON numbers with a fraction become DOUBLE, integral
    ones BIGINT; a field that is sometimes one value and sometimes a list,
    or of mixed types, stays VARIANT.  Fields come in name order.
    """
    src = F.variant_get(F.parse_json(F.col(col)), "$._source", "variant")
    text = df.select(F.schema_of_variant_agg(src)).first()[0]
    if not text or not text.startswith("OBJECT<"):
        return StructType([])
    text = text.replace("OBJECT<", "STRUCT<")
    text = re.sub(r"DECIMAL\((\d+),\s*(\d+)\)", _decimal, text)
    return _parse_datatype_string(text)


def _path(*names: str) -> str:
    return "$" + "".join("['" + n.replace("'", "\\'") + "']" for n in names)


#: Holds the whole hit where one of its values doesn't fit its type.
_BAD = "__unfit"


def _wire_type(dt: DataType) -> DataType:
    """The type a field is decoded to at first: dates as their text, whatever may
    be one value or many, or an object, as it is."""
    if isinstance(dt, (DateType, TimestampType, TimestampNTZType)):
        return StringType()
    return VariantType() if isinstance(dt, (ArrayType, StructType, MapType, VariantType)) else dt


def hits_from_json(df: DataFrame, col: str, schema: StructType | None = None) -> DataFrame:
    """Flat typed rows from JSON hits; without ``schema`` one is inferred
    over all hits (source fields, then the metadata columns).

    A hit is decoded once, straight into the types of its fields.  Only a hit of
    which some value doesn't fit (a lone element in a list, a number written as
    text, an unreadable date) is read a second time, as a variant, by the rules
    for such values: they convert, or fail with field, document and value.
    """
    if schema is None:
        schema = StructType(infer_source_schema(df, col).fields + META_FIELDS.fields)
    source = [f for f in schema.fields if f.name not in META_NAMES]
    wire = StructType([StructField(f.name, f.dataType) for f in schema.fields if f.name in META_NAMES]
                      + [StructField("_source", StructType([StructField(f.name, _wire_type(f.dataType)) for f in source])), StructField(_BAD, StringType())])
    df = df.select(F.col(col).alias("__hit"), F.from_json(F.col(col), wire, {"columnNameOfCorruptRecord": _BAD}).alias("__p"))
    raw, odd = [], F.col(f"__p.{_BAD}").isNotNull()
    for i, f in enumerate(schema.fields):
        c = F.col("__p").getField(f.name) if f.name in META_NAMES else F.col("__p._source").getField(f.name)
        value, own = c, _wire_type(f.dataType)
        if f.name in META_NAMES:
            pass
        elif isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType)):
            value = parse_date(c, (f.metadata or {}).get("format")) if isinstance(f.dataType, DateType) else parse_timestamp(c, isinstance(f.dataType, TimestampNTZType))
            odd = odd | (c.isNotNull() & F.col(f"__r{i}").isNull())
        elif isinstance(f.dataType, StringType):
            odd = odd | c.startswith("[")  # a list's text, mostly
        elif isinstance(f.dataType, ArrayType):
            value = _variant_value(c, "$", f.dataType, f.metadata)
        elif isinstance(own, VariantType) and not isinstance(f.dataType, VariantType):
            # objects are read from the whole hit
            value, odd = F.lit(None).cast(f.dataType), odd | c.isNotNull()
        raw.append(value.alias(f"__r{i}"))
    df = df.select("__hit", "__p", *raw)
    df = df.select("*", F.when(F.coalesce(odd, F.lit(False)), F.parse_json("__hit")).alias("__v"))
    v, cols = F.col("__v"), []
    for i, f in enumerate(schema.fields):
        value = F.col(f"__r{i}")
        if f.name in META_NAMES:
            again = F.try_variant_get(v, _path(f.name), f.dataType.simpleString())
        else:
            path = _path("_source", f.name)
            again = _variant_value(v, path, f.dataType, f.metadata)
            if not isinstance(f.dataType, (ArrayType, VariantType)):
                again = single_valued(v, path, again, f.dataType, f.metadata)
        c = F.when(v.isNull(), value).otherwise(again)
        if not f.nullable:
            c = require(c, f.name)
        cols.append(c.alias(f.name, metadata=f.metadata or {}))
    return df.select(*cols)


def hits_to_json(hits: DataFrame, col: str = "hit") -> DataFrame:
    """Nested hits (metadata + ``_source``) to one JSON text per hit; null
    fields are written as null."""
    return hits.select(F.to_json(F.struct(*[F.col(c) for c in hits.columns]), {"ignoreNullFields": "false"}).alias(col))


def write_hits_json(hits: DataFrame, path: str, compression: str | None = None) -> None:
    """Write nested hits as JSON lines (one hit per line), one file per task."""
    w = hits_to_json(hits, "value").write.mode("errorifexists")
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def read_hits_json(spark, path: str, schema: StructType | None = None) -> DataFrame:
    """Read JSON-lines hits (files or folders, any text compression Spark
    reads) as flat typed rows; without ``schema`` one is inferred."""
    return hits_from_json(spark.read.text(path), "value", schema)
