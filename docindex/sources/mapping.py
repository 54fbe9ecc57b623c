"""Index mapping (the ``properties`` dict of a search index) to a StructType.

Mapping-derived fields are always nullable.  Each field carries metadata
``es_type`` (and ``dims`` / ``format`` where they apply) so that the query
compiler knows text from keyword and readers know how to parse values, and the
settings that decide how its values are searched: sub-fields (``fields``),
``normalizer`` (as its list of filters), ``null_value``, ``ignore_above``,
``analyzer``, ``index`` / ``doc_values`` / ``enabled`` where they are off, the
``aliases`` that lead to it, and ``copied_from`` (the fields copied into it).
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
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
)

from docindex.functions.analyzer import ANALYZERS
from docindex.functions.fields import FILTERS, leaves

# Date formats that carry no time of day.
DATE_ONLY_FORMATS = (
    "date",
    "basic_date",
    "basic_ordinal_date",
    "basic_week_date",
    "ordinal_date",
    "strict_date",
    "strict_ordinal_date",
    "strict_week_date",
    "strict_weekyear",
    "strict_weekyear_week",
    "strict_weekyear_week_day",
    "strict_year",
    "strict_year_month",
    "strict_year_month_day",
    "week_date",
    "weekyear",
    "weekyear_week",
    "weekyear_week_day",
    "year",
    "year_month",
    "year_month_day",
    "yyyy-MM-dd",
)

# Scalar mapping types and their Spark types.
_SCALARS: dict[str, DataType] = {
    "boolean": BooleanType(),
    "byte": ByteType(),
    "short": ShortType(),
    "integer": IntegerType(),
    "long": LongType(),
    "unsigned_long": DecimalType(20, 0),
    "half_float": FloatType(),
    "float": FloatType(),
    "double": DoubleType(),
    "rank_feature": DoubleType(),
    "text": StringType(),
    "keyword": StringType(),
    "ip": StringType(),
    "search_as_you_type": StringType(),
    "version": StringType(),
}

_WARN = {
    "scaled_float": "scaled_float is read as double; precision may be lost",
    "binary": "binary fields are read as Base64 text; use unbase64() for bytes",
}


def is_date_only(fmt: str | None) -> bool:
    return fmt is not None and all(f in DATE_ONLY_FORMATS for f in fmt.split("||"))


#: Normalizers that a mapping may name without settings.
_NORMALIZERS = {"lowercase": ["lowercase"]}


def normalizers(settings: Mapping | None) -> dict[str, list[str]]:
    """Filters of each normalizer: the built-in one and those of the index
    settings (``{"analysis": {"normalizer": ...}}``, with or without ``index``)."""
    s = dict(settings or {})
    s = s.get("settings", s)
    analysis = s.get("analysis") or s.get("index", {}).get("analysis", {})
    own = {name: [str(x) for x in spec.get("filter", [])] for name, spec in analysis.get("normalizer", {}).items()}
    return _NORMALIZERS | own


def search_settings(prop: Mapping, kind: str, path: str, known: Mapping[str, list[str]]) -> dict:
    """Metadata of how a property's values are searched."""
    meta: dict = {"es_type": kind}
    if "ignore_above" in prop:
        meta["ignore_above"] = int(prop["ignore_above"])
    if prop.get("null_value") is not None:
        meta["null_value"] = prop["null_value"]
    for key in ("index", "doc_values", "enabled"):
        if str(prop.get(key, True)).lower() == "false":
            meta[key] = False
    if prop.get("normalizer"):
        filters = known.get(prop["normalizer"])
        unknown = [f for f in filters or [] if f not in FILTERS]
        if filters is None or unknown:
            raise NotImplementedError(f"normalizer {prop['normalizer']!r} is not known ({path}): " + (f"filters {unknown}" if unknown else "pass the index settings"))
        meta["normalizer"] = filters
    if prop.get("analyzer", "standard") != "standard":
        if prop["analyzer"] in ANALYZERS:
            meta["analyzer"] = prop["analyzer"]
        else:
            warnings.warn(f"analyzer {prop['analyzer']!r} is not available, texts are split as by the standard one ({path})", UserWarning, stacklevel=4)
    if prop.get("fields"):
        meta["fields"] = {name: search_settings(sub, sub.get("type", "text"), f"{path}.{name}", known) for name, sub in prop["fields"].items()}
    return meta


def property_type(prop: Mapping, path: str = "", known: Mapping[str, list[str]] = _NORMALIZERS) -> tuple[DataType, dict]:
    """Spark type and field metadata for one mapping property; ``known`` has the
    filters of normalizers by name."""
    prop = dict(prop)
    kind = prop.get("type")
    if kind is None and "properties" in prop or kind == "object":
        return properties_to_struct(prop.get("properties", {}), path + ".", known), search_settings(prop, "object", path, known)
    if kind is None:
        raise ValueError(f"property {path!r} has neither type nor properties")
    if kind == "alias":
        raise NotImplementedError(f"an alias has no values of its own ({path})")
    meta = search_settings(prop, kind, path, known)
    if kind in _SCALARS:
        return _SCALARS[kind], meta
    if kind in _WARN:
        warnings.warn(f"{_WARN[kind]} ({path})", UserWarning, stacklevel=3)
        if kind == "scaled_float" and "scaling_factor" in prop:
            meta["scaling_factor"] = prop["scaling_factor"]
        return (DoubleType() if kind == "scaled_float" else StringType()), meta
    if kind == "date":
        fmt = prop.get("format")
        if fmt is not None:
            meta["format"] = fmt
        return (DateType() if is_date_only(fmt) else TimestampType()), meta
    if kind == "dense_vector":
        if "dims" not in prop:
            raise ValueError(f"dense_vector needs dims ({path})")
        elem = prop.get("element_type", "float")
        elems = {"float": FloatType(), "byte": ByteType(), "bit": BooleanType()}
        if elem not in elems:
            raise NotImplementedError(f"dense_vector element type {elem!r} is not supported ({path})")
        meta["dims"] = int(prop["dims"])
        meta["element_type"] = elem
        return ArrayType(elems[elem], False), meta
    if kind == "nested":
        if "properties" not in prop:
            raise ValueError(f"nested property needs properties ({path})")
        return ArrayType(properties_to_struct(prop["properties"], path + ".", known), True), meta
    if kind == "rank_features":
        return MapType(StringType(), DoubleType(), True), meta
    raise NotImplementedError(f"property type {kind!r} is not supported ({path})")


def properties_to_struct(properties: Mapping, prefix: str = "", known: Mapping[str, list[str]] = _NORMALIZERS) -> StructType:
    fields = []
    for name, prop in properties.items():
        if prop.get("type") == "alias":
            continue  # recorded at the field it leads to
        dtype, meta = property_type(prop, prefix + name, known)
        fields.append(StructField(name, dtype, True, meta))
    return StructType(fields)


def _links(properties: Mapping, prefix: str = ""):
    """(kind, from, to) of the aliases and copied fields of a mapping."""
    for name, prop in properties.items():
        path = prefix + name
        if prop.get("type") == "alias":
            yield "aliases", path, prop["path"]
        to = prop.get("copy_to") or []
        for target in [to] if isinstance(to, str) else to:
            yield "copied_from", path, target
        if isinstance(prop.get("properties"), Mapping):
            yield from _links(prop["properties"], path + ".")


def _linked(schema: StructType, links: Mapping[str, dict[str, list[str]]], prefix: str = "") -> StructType:
    """``schema`` with the aliases and copies of each field in its metadata."""
    out = []
    for f in schema.fields:
        path, dt = prefix + f.name, f.dataType
        if isinstance(dt, StructType):
            dt = _linked(dt, links, path + ".")
        elif isinstance(dt, ArrayType) and isinstance(dt.elementType, StructType):
            dt = ArrayType(_linked(dt.elementType, links, path + "."), dt.containsNull)
        out.append(StructField(f.name, dt, f.nullable, (f.metadata or {}) | {kind: by[path] for kind, by in links.items() if path in by}))
    return StructType(out)


def _with_links(properties: Mapping, known: Mapping[str, list[str]]) -> StructType:
    links: dict[str, dict[str, list[str]]] = {"aliases": {}, "copied_from": {}}
    for kind, source, target in _links(properties):
        links[kind].setdefault(target, []).append(source)
    out = properties_to_struct(properties, "", known)
    paths = {path for path, _ in leaves(out)}
    for target, names in links["aliases"].items():
        if target not in paths:
            raise NotImplementedError(f"alias fields need a field of the same mapping ({names[0]} leads to {target})")
    return _linked(out, links) if any(links.values()) else out


def mapping_to_struct(mapping: Mapping, index: str | None = None, settings: Mapping | None = None) -> StructType:
    """Translate a mapping.

    Accepts the ``properties`` dict itself, ``{"properties": ...}``,
    ``{"mappings": {"properties": ...}}`` or a get-mapping response keyed by
    index name (then ``index`` picks the entry).  ``settings`` (or a
    ``settings`` entry beside ``mappings``) defines the index's normalizers.
    """
    m = dict(mapping)
    if index is not None and index in m:
        m = m[index]
    elif index is not None and "mappings" not in m and "properties" not in m:
        raise ValueError(f"no mapping found for index {index!r}")
    whole = "mappings" in m and isinstance(m["mappings"], Mapping) and "type" not in m
    known = normalizers(settings or (m.get("settings") if whole else None))
    if whole:
        m = m["mappings"]
    inner = m.get("properties")
    # mapping-level keys (dynamic, date_detection, ...) may stand beside it; a
    # field that is named so has texts among its settings
    if isinstance(inner, Mapping) and all(isinstance(p, Mapping) for p in inner.values()):
        return _with_links(inner, known)
    if whole or not m:
        raise ValueError("the mapping has no properties: " + (f"index {index!r}" if index else "pass a schema"))
    return _with_links(m, known)
