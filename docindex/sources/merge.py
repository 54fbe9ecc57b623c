"""One schema for several indices.

Types meet in the least type that holds both: integers and floats widen, a date
becomes a timestamp, objects merge field by field, one value meets a list as a
list.  Types without such a meeting point are kept as they are in a VARIANT, and
reported.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VariantType,
)

from docindex.functions.fields import TEXT_TYPES
from docindex.functions.values import conform
from docindex.sources.mapping import mapping_to_struct
from docindex.sources.schema import META_NAMES

# Numbers by growing range.
_NUMBERS = [ByteType(), ShortType(), IntegerType(), LongType(), DecimalType(20, 0), FloatType(), DoubleType()]


@dataclass
class Merged:
    """A schema, and of each field that could not be merged its types."""

    schema: StructType
    conflicts: dict[str, list[str]] = field(default_factory=dict)


def _wider(a: DataType, b: DataType) -> DataType | None:
    """The least scalar type that holds both."""
    if a == b:
        return a
    if a in _NUMBERS and b in _NUMBERS:
        low, high = sorted((a, b), key=_NUMBERS.index)
        # a float holds few digits: with integers only a double will do
        return DoubleType() if high == FloatType() and low not in (ByteType(), ShortType()) else high
    if {type(a), type(b)} == {DateType, TimestampType}:
        return TimestampType()
    return None


def _meet(a: DataType, b: DataType, path: str, other: DataType, conflicts: dict) -> DataType:
    if isinstance(a, StructType) and isinstance(b, StructType):
        return _structs(a, b, path + ".", other, conflicts)
    if isinstance(a, ArrayType) or isinstance(b, ArrayType):
        x, y = (t.elementType if isinstance(t, ArrayType) else t for t in (a, b))
        inner: dict = {}
        met = _meet(x, y, path, other, inner)
        if path not in inner:
            conflicts.update(inner)
            nulls = any(t.containsNull for t in (a, b) if isinstance(t, ArrayType))
            return ArrayType(met, nulls)
    elif isinstance(a, MapType) and isinstance(b, MapType):
        return MapType(a.keyType, _meet(a.valueType, b.valueType, path, other, conflicts), True)
    elif (wide := _wider(a, b)) is not None:
        return wide
    conflicts.setdefault(path, [])
    conflicts[path] += [t.simpleString() for t in (a, b) if t != other and t.simpleString() not in conflicts[path]]
    return other


def _notes(a: StructField, b: StructField, met: DataType) -> dict:
    """Metadata that holds for both; strings are text if one of them is."""
    x, y = a.metadata or {}, b.metadata or {}
    both = {k: v for k, v in x.items() if y.get(k) == v}
    if isinstance(met, StringType) and x.get("es_type") != y.get("es_type"):
        kinds = {x.get("es_type"), y.get("es_type")}
        both["es_type"] = "text" if kinds & set(TEXT_TYPES) else "keyword"
    return both


def _structs(a: StructType, b: StructType, prefix: str, other: DataType, conflicts: dict) -> StructType:
    out, have = [], {f.name: f for f in b.fields}
    for f in a.fields:
        g = have.pop(f.name, None)
        if g is None:
            out.append(StructField(f.name, f.dataType, True, f.metadata))
            continue
        met = _meet(f.dataType, g.dataType, prefix + f.name, other, conflicts)
        out.append(StructField(f.name, met, f.nullable or g.nullable, _notes(f, g, met)))
    return StructType(out + [StructField(g.name, g.dataType, True, g.metadata) for g in have.values()])


def merge_schemas(schemas: Mapping[str, StructType], other: DataType = VariantType()) -> Merged:
    """One schema for several; fields without a common type become ``other``."""
    conflicts: dict[str, list[str]] = {}
    if not schemas:
        raise ValueError("there is no schema to merge")
    whole = reduce(lambda a, b: _structs(a, b, "", other, conflicts), schemas.values())
    return Merged(whole, conflicts)


def merge_mappings(response: Mapping, other: DataType = VariantType()) -> Merged:
    """The same for a get-mapping response of several indices."""
    some = {name: m for name, m in response.items() if (m.get("mappings") or {}).get("properties")}
    out = merge_schemas({name: mapping_to_struct(m) for name, m in some.items()}, other)
    for path, types in out.conflicts.items():
        warnings.warn(f"field {path} has no common type over the indices ({', '.join(types)}): read as {other.simpleString()}", UserWarning, stacklevel=2)
    return out


def union_indices(indices: Mapping[str, DataFrame], schema: StructType | None = None) -> DataFrame:
    """Documents of several indices under one schema (merged from theirs, unless
    given), told apart by ``_index``."""
    own = {name: StructType([f for f in df.schema.fields if f.name not in META_NAMES]) for name, df in indices.items()}
    whole = schema or merge_schemas(own).schema
    out = None
    for name, df in indices.items():
        meta = [F.col(c) for c in META_NAMES if c in df.columns and c != "_index"]
        rows = df.select(F.lit(name).alias("_index"), *meta, *[F.col("`" + c + "`") for c in own[name].fieldNames()])
        metas = StructType([f for f in rows.schema.fields if f.name in META_NAMES])
        rows = conform(rows, StructType(metas.fields + whole.fields))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
