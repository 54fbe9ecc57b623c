"""Declared document models to StructType.

Two styles are supported:

* field objects: ``class Page(Document): title = Text(required=True)``,
  with ``multi=True`` for lists, ``Object(Inner)`` and ``Nested(Inner)``;
  ``class Index: name = "pages"`` names the index;
* type annotations (dataclasses, pydantic models or plain classes):
  ``title: str``, ``tags: Optional[list[str]]``.

Nullable is ``not required``; for annotations a field is required unless its
type admits ``None``.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import typing
from collections.abc import Mapping
from typing import Any

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from docindex.sources.mapping import property_type
from docindex.sources.schema import complete_schema


class Field:
    """A declared field; ``kind`` is its mapping type."""

    kind: str = "keyword"

    def __init__(self, required: bool = False, multi: bool = False, **params):
        self.required = required
        self.multi = multi
        self.params = params

    def mapping(self) -> dict:
        return {"type": self.kind, **self.params}


def _kind(name: str, kind: str):
    return type(name, (Field,), {"kind": kind})


# Field classes and the mapping type each declares.
Text = _kind("Text", "text")
Keyword = _kind("Keyword", "keyword")
Boolean = _kind("Boolean", "boolean")
Byte = _kind("Byte", "byte")
Short = _kind("Short", "short")
Integer = _kind("Integer", "integer")
Long = _kind("Long", "long")
UnsignedLong = _kind("UnsignedLong", "unsigned_long")
HalfFloat = _kind("HalfFloat", "half_float")
Float = _kind("Float", "float")
Double = _kind("Double", "double")
ScaledFloat = _kind("ScaledFloat", "scaled_float")
RankFeature = _kind("RankFeature", "rank_feature")
RankFeatures = _kind("RankFeatures", "rank_features")
Date = _kind("Date", "date")
Binary = _kind("Binary", "binary")
Ip = _kind("Ip", "ip")
SearchAsYouType = _kind("SearchAsYouType", "search_as_you_type")
Version = _kind("Version", "version")
DenseVector = _kind("DenseVector", "dense_vector")


class Object(Field):
    kind = "object"

    def __init__(self, doc_class: type, required: bool = False, multi: bool = False):
        super().__init__(required=required, multi=multi)
        self.doc_class = doc_class


class Nested(Object):
    kind = "nested"


class InnerDoc:
    """Base of declared inner documents (objects and nested)."""

    @classmethod
    def _fields(cls) -> list[tuple[str, Any]]:
        out: dict[str, Any] = {}
        for klass in reversed(cls.__mro__):
            for k, v in vars(klass).items():
                if isinstance(v, Field):
                    out[k] = v
        return list(out.items())

    def __init__(self, **values):
        for k, v in values.items():
            setattr(self, k, v)
        for k, _ in self._fields():
            if k not in values:
                setattr(self, k, None)

    @classmethod
    def from_hit(cls, hit: Mapping) -> "InnerDoc":
        """Build from ``{_meta..., "_source": {...}}`` or a flat row."""
        hit = dict(hit)
        source = dict(hit.get("_source") or {})
        for k, v in hit.items():
            if not k.startswith("_"):
                source.setdefault(k, v)
        doc = cls(**{k: _decode(f, source.get(k)) for k, f in cls._fields()})
        doc.meta = {k[1:]: v for k, v in hit.items() if k.startswith("_") and k != "_source"}
        return doc

    def to_dict(self) -> dict:
        return {k: getattr(self, k, None) for k, _ in self._fields()}


def _decode(field: Field, value):
    if value is None or not isinstance(field, Object):
        return value
    if isinstance(field, Nested) or field.multi:
        return [field.doc_class.from_hit(_as_map(v)) for v in value]
    return field.doc_class.from_hit(_as_map(value))


def _as_map(v):
    if isinstance(v, Mapping):
        return v
    if hasattr(v, "asDict"):
        return v.asDict(recursive=True)
    return dict(v)


class Document(InnerDoc):
    """Base of declared documents; ``Index.name`` names the index."""

    class Index:
        name: str | None = None

    @classmethod
    def index_name(cls) -> str:
        name = getattr(getattr(cls, "Index", None), "name", None)
        if not name:
            raise ValueError(f"{cls.__name__} declares no Index.name")
        return name


def _field_type(field: Field, path: str) -> DataType:
    if isinstance(field, Nested):
        return ArrayType(_doc_struct(field.doc_class, path + "."), True)
    if isinstance(field, Object):
        t: DataType = _doc_struct(field.doc_class, path + ".")
    else:
        t, _ = property_type(field.mapping(), path)
    return ArrayType(t, True) if field.multi else t


def _field_meta(field: Field, path: str) -> dict:
    """All that the field's mapping says, as for a mapping read from an index."""
    if isinstance(field, Object):
        return {"es_type": field.kind}
    meta = dict(property_type(field.mapping(), path)[1])
    if field.multi:
        meta.pop("dims", None)
    return meta


def _doc_struct(cls: type, prefix: str = "") -> StructType:
    return StructType([
        StructField(name, _field_type(f, prefix + name), not f.required, _field_meta(f, prefix + name))
        for name, f in cls._fields()
    ])


# Python annotation types and their Spark types.
_PY_TYPES: dict[Any, DataType] = {
    str: StringType(),
    int: LongType(),
    float: DoubleType(),
    bool: BooleanType(),
    _dt.datetime: TimestampType(),
    _dt.date: DateType(),
    bytes: StringType(),
}


def _annotation_type(tp: Any, path: str) -> tuple[DataType, bool]:
    """(Spark type, nullable) for a type annotation."""
    origin = typing.get_origin(tp)
    args = typing.get_args(tp)
    if origin is typing.Union or (origin is not None and str(origin) == "<class 'types.UnionType'>"):
        rest = [a for a in args if a is not type(None)]
        nullable = len(rest) != len(args)
        if len(rest) != 1:
            raise NotImplementedError(f"union types are not supported ({path})")
        t, inner_null = _annotation_type(rest[0], path)
        return t, nullable or inner_null
    if origin in (list, tuple, set, frozenset) or tp in (list, tuple, set):
        elem = args[0] if args else str
        t, _ = _annotation_type(elem, path)
        return ArrayType(t, True), False
    if origin in (dict, Mapping):
        vt = args[1] if len(args) == 2 else str
        t, _ = _annotation_type(vt, path)
        return MapType(StringType(), t, True), False
    if isinstance(tp, type) and issubclass(tp, InnerDoc):
        return _doc_struct(tp, path + "."), False
    if isinstance(tp, type) and (dataclasses.is_dataclass(tp) or _annotations(tp)) and tp not in _PY_TYPES:
        return typed_model_to_struct(tp, complete=False, _prefix=path + "."), False
    if tp in _PY_TYPES:
        return _PY_TYPES[tp], False
    if tp is Any:
        return StringType(), True
    raise NotImplementedError(f"annotation {tp!r} is not supported ({path})")


def _annotations(cls: type) -> dict:
    out: dict = {}
    for klass in reversed(cls.__mro__):
        if klass is object:
            continue
        try:
            out.update(typing.get_type_hints(klass))
        except Exception:  # noqa: BLE001
            out.update(getattr(klass, "__annotations__", {}))
    return {k: v for k, v in out.items() if not k.startswith("_") and typing.get_origin(v) is not typing.ClassVar}


def typed_model_to_struct(cls: type, complete: bool = True, source_fields=None,
                          meta_fields=None, _prefix: str = "") -> StructType:
    """StructType from a type-annotated model class."""
    fields = []
    for name, tp in _annotations(cls).items():
        t, nullable = _annotation_type(tp, _prefix + name)
        fields.append(StructField(name, t, nullable))
    base = StructType(fields)
    return complete_schema(base, source_fields, meta_fields) if complete else base


def model_to_struct(cls: type, complete: bool = True, source_fields=None,
                    meta_fields=None) -> StructType:
    """StructType from a declared model; completed with metadata by default."""
    if isinstance(cls, type) and issubclass(cls, InnerDoc) and cls._fields():
        base = _doc_struct(cls)
    else:
        return typed_model_to_struct(cls, complete, source_fields, meta_fields)
    return complete_schema(base, source_fields, meta_fields) if complete else base


def index_name(index: Any) -> str | None:
    """Index name from a string or a model class with ``Index.name``."""
    if index is None or isinstance(index, str):
        return index
    name = getattr(getattr(index, "Index", None), "name", None)
    if name:
        return name
    raise ValueError(f"{index!r} names no index")
