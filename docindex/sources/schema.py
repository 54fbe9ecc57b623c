"""Metadata columns and schema completion."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# The hit metadata columns, in this order.
META_FIELDS = StructType([
    StructField("_index", StringType(), True),
    StructField("_type", StringType(), True),
    StructField("_id", StringType(), True),
    StructField("_version", LongType(), True),
    StructField("_seq_no", LongType(), True),
    StructField("_primary_term", LongType(), True),
    StructField("_score", DoubleType(), True),
])
META_NAMES = [f.name for f in META_FIELDS.fields]


def meta_name(name: str) -> str:
    """``id`` and ``_id`` both name the ``_id`` column."""
    return name if name.startswith("_") else "_" + name


def select_meta(meta_fields: Iterable[str] | None) -> list[str]:
    """Metadata column names kept, in the fixed order; unknown names ignored."""
    if meta_fields is None:
        return list(META_NAMES)
    wanted = {meta_name(m) for m in meta_fields}
    return [n for n in META_NAMES if n in wanted]


def select_source(names: Iterable[str], source_fields: Iterable[str] | None) -> list[str]:
    """Source names kept, in source order; unknown names ignored."""
    names = list(names)
    if source_fields is None:
        return names
    wanted = set(source_fields)
    return [n for n in names if n in wanted]


def complete_schema(base: StructType, source_fields: Iterable[str] | None = None,
                    meta_fields: Iterable[str] | None = None) -> StructType:
    """Selected source fields (source order) followed by selected metadata."""
    by_name = {f.name: f for f in base.fields}
    src = select_source([f.name for f in base.fields if not f.name.startswith("_")
                         or f.name not in META_NAMES], source_fields)
    meta = select_meta(meta_fields)
    metas = {f.name: f for f in META_FIELDS.fields}
    fields = [by_name[n] for n in src] + [metas[n] for n in meta if n not in by_name]
    return StructType(fields)


def as_struct(schema) -> StructType:
    """StructType from a StructType, DDL string or JSON string."""
    if isinstance(schema, StructType):
        return schema
    if isinstance(schema, str):
        s = schema.strip()
        if s.startswith("{"):
            import json
            return StructType.fromJson(json.loads(s))
        return StructType.fromDDL(s)
    raise TypeError(f"cannot make a schema from {type(schema).__name__}")
