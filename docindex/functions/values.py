"""Column conversions for document values, all as Catalyst expressions.

Documents arrive as JSON: dates as text in a named format or as epoch
milliseconds, any field as one value or a list, vectors as lists, feature
maps as objects.  These functions turn such values into the Spark types of a
schema (see ``docindex.sources.mapping``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    MapType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
    VariantType,
)

# Date-only formats as Spark parse patterns ("week" marks
# the ISO week-date forms, computed by date arithmetic because Spark
# refuses week-based patterns).
DATE_PATTERNS = {
    "date": "y-M-d",
    "strict_date": "yyyy-MM-dd",
    "year_month_day": "y-M-d",
    "strict_year_month_day": "yyyy-MM-dd",
    "yyyy-MM-dd": "yyyy-MM-dd",
    "basic_date": "yyyyMMdd",
    "basic_ordinal_date": "yyyyDDD",
    "ordinal_date": "y-D",
    "strict_ordinal_date": "yyyy-DDD",
    "year": "y",
    "strict_year": "yyyy",
    "year_month": "y-M",
    "strict_year_month": "yyyy-MM",
    "basic_week_date": "week:basic",
    "week_date": "week:day",
    "strict_week_date": "week:day",
    "weekyear_week_day": "week:day",
    "strict_weekyear_week_day": "week:day",
    "weekyear_week": "week:week",
    "strict_weekyear_week": "week:week",
    "weekyear": "week:year",
    "strict_weekyear": "week:year",
}

# Regexes of the ISO week-date text forms.
WEEK_REGEX = {
    "basic": r"^(\d{4})W(\d{2})(\d)$",
    "day": r"^(\d{4})-W(\d{1,2})-(\d)$",
    "week": r"^(\d{4})-W(\d{1,2})$",
    "year": r"^(\d{4})$",
}


def iso_week_date(year: Column, week: Column, day: Column) -> Column:
    """Date of ISO week-year ``year``, week ``week`` (1-53), day ``day`` (1=Mon)."""
    monday_w1 = F.date_trunc("week", F.make_date(year, F.lit(1), F.lit(4))).cast("date")
    return F.date_add(monday_w1, ((week - 1) * 7 + (day - 1)).cast("int"))


def _week_parse(c: Column, form: str) -> Column:
    rx = WEEK_REGEX[form]
    s = F.trim(c)
    y = F.regexp_extract(s, rx, 1)
    ok = y != F.lit("")
    year = F.when(ok, y.cast("int"))
    if form == "year":
        week, day = F.lit(1), F.lit(1)
    else:
        week = F.regexp_extract(s, rx, 2).cast("int")
        day = F.regexp_extract(s, rx, 3).cast("int") if form in ("basic", "day") else F.lit(1)
    valid = ok & week.between(1, 53) & day.between(1, 7)
    return F.when(valid, iso_week_date(year, week, day))


def parse_date(c: Column, fmt: str | None = None) -> Column:
    """DateType from text in the named format(s) (``a||b`` tries each)."""
    fmts = (fmt or "strict_date").split("||")
    tries = []
    for f in fmts:
        pattern = DATE_PATTERNS.get(f)
        if pattern is None:
            raise ValueError(f"unknown date-only format {f!r}")
        if pattern.startswith("week:"):
            tries.append(_week_parse(c, pattern[5:]))
        else:
            tries.append(F.try_to_date(c.cast("string"), pattern))
    return tries[0] if len(tries) == 1 else F.coalesce(*tries)


_EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_micros(c: Column) -> Column:
    """Microseconds since the epoch of a zone-less timestamp read as UTC
    (independent of the session time zone)."""
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), c)


def parse_timestamp(c: Column, ntz: bool = False) -> Column:
    """Timestamp from ISO-8601 text or epoch milliseconds (text or number).

    Text with a zone (``Z``, ``+01:00``) is read in that zone; text without
    one is read as UTC, whatever the session time zone.
    """
    s = F.trim(c.cast("string"))
    micros = (F.when(s.rlike(r"^-?[0-9]+$"), s.try_cast("bigint") * F.lit(1000))
              .when(s.rlike(r"[Tt ][0-9]{2}:[0-9]{2}.*(Z|z|[+-][0-9]{2}(:?[0-9]{2})?)$"),
                    F.unix_micros(F.try_to_timestamp(s)))
              .otherwise(ntz_micros(s.try_cast("timestamp_ntz"))))
    if ntz:
        return F.timestamp_add("MICROSECOND", micros, F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))
    return F.timestamp_micros(micros)


def epoch_millis(c: Column, ntz: bool = False) -> Column:
    """Epoch milliseconds of a timestamp (the write form of date fields);
    zone-less timestamps are read as UTC."""
    if ntz:
        return F.floor(ntz_micros(c) / 1000).cast("bigint")
    return F.unix_millis(c)


def one_or_many(v: Column, path: str, elem_ddl: str) -> Column:
    """array<elem> from a variant value that is one value or a list.

    Null when the value is missing or null; an empty list stays empty.
    """
    arr = F.try_variant_get(v, path, f"array<{elem_ddl}>")
    one = F.try_variant_get(v, path, elem_ddl)
    return F.when(arr.isNotNull(), arr).when(one.isNotNull(), F.array(one))


def check_dims(c: Column, dims: int, name: str = "vector") -> Column:
    """The vector unchanged, or a job failure if its length is not ``dims``."""
    return F.when(c.isNull() | (F.size(c) == F.lit(dims)), c).otherwise(
        F.raise_error(F.concat(F.lit(f"{name}: expected {dims} dims, got "),
                               F.size(c).cast("string"))))


def require(c: Column, name: str) -> Column:
    """``c`` unchanged, or a job failure naming the field when it is null."""
    return F.when(c.isNotNull(), c).otherwise(
        F.raise_error(F.lit(f"required field {name!r} is null")))


def _ddl(dt: DataType) -> str:
    return dt.simpleString()


def readable(c: Column, out: Column, dst: DataType, name: str, doc: Column | None) -> Column:
    """``out``, or a job failure that names the field, the document and the
    value where a value ``c`` came out as null."""
    lost = F.concat(F.lit(f"field {name} of document "), F.coalesce(doc.cast("string") if doc is not None else F.lit(None), F.lit("?")),
                    F.lit(f" is not a {dst.simpleString()}: "), c.cast("string"))
    return F.when(c.isNotNull() & out.isNull(), F.raise_error(lost)).otherwise(out)


def convert(c: Column, src: DataType, dst: DataType, meta: dict | None, name: str, doc: Column | None = None) -> Column:
    """Convert column ``c`` of type ``src`` to ``dst`` (per mapping metadata).  A
    value that can't be read fails the job, with the field ``name``, the id
    ``doc`` of its document and the value."""
    meta = meta or {}
    if src == dst and not meta.get("dims"):
        return c
    if isinstance(dst, ArrayType):
        if isinstance(src, ArrayType):
            inner = {k: v for k, v in meta.items() if k != "dims"}
            out = F.transform(c, lambda x: convert(x, src.elementType, dst.elementType, inner, name, doc))
        else:
            one = convert(c, src, dst.elementType, meta, name, doc)
            out = F.when(c.isNotNull(), F.array(one))
        if meta.get("dims"):
            out = check_dims(out, int(meta["dims"]), name)
        return out
    if isinstance(dst, StructType) and isinstance(src, StructType):
        have = {f.name: f for f in src.fields}
        parts = []
        for f in dst.fields:
            if f.name in have:
                sub = convert(c.getField(f.name), have[f.name].dataType, f.dataType,
                              f.metadata, f"{name}.{f.name}", doc)
            else:
                sub = F.lit(None).cast(f.dataType)
            if not f.nullable:
                sub = require(sub, f"{name}.{f.name}")
            parts.append(sub.alias(f.name))
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(dst, VariantType):
        return F.to_variant_object(c) if isinstance(src, (StructType, ArrayType, MapType)) else c.cast("variant")
    if isinstance(dst, DateType) and isinstance(src, StringType):
        return readable(c, parse_date(c, meta.get("format")), dst, name, doc)
    if isinstance(dst, (TimestampType, TimestampNTZType)) and isinstance(src, (StringType, NumericType)):
        return readable(c, parse_timestamp(c, ntz=isinstance(dst, TimestampNTZType)), dst, name, doc)
    if isinstance(dst, MapType) and isinstance(src, StringType):
        return readable(c, F.from_json(c, dst), dst, name, doc)
    if isinstance(src, (StringType, NumericType)) and isinstance(dst, (NumericType, BooleanType)):
        return readable(c, c.try_cast(dst), dst, name, doc)
    return c.cast(dst)


def _has_struct(t: DataType) -> bool:
    if isinstance(t, StructType):
        return True
    if isinstance(t, ArrayType):
        return t.containsNull and _has_struct(t.elementType)
    return False


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` projected onto ``schema``: converted, missing fields null,
    required fields checked, unreadable values refused.  Extra columns are
    dropped."""
    have = {f.name: f for f in df.schema.fields}
    doc = F.col("_id") if "_id" in have else None
    cols = []
    for f in schema.fields:
        if f.name in have:
            c = convert(F.col("`" + f.name + "`"), have[f.name].dataType, f.dataType,
                        f.metadata, f.name, doc)
        else:
            c = F.lit(None).cast(f.dataType)
        if _has_struct(f.dataType):
            # the target type carries the nested fields' mapping metadata
            c = c.cast(f.dataType)
        if not f.nullable:
            c = require(c, f.name)
        cols.append(c.alias(f.name, metadata=f.metadata or {}))
    return df.select(*cols)


def single_valued(v: Column, path: str, value: Column, dst: DataType, meta: dict | None) -> Column:
    """``value`` (already converted, best passed as a column) unless the raw
    value at ``path`` is a list: then its one element; a longer list, and a
    value that doesn't convert, fail the job.

    A list read as a scalar gives null (as text, its JSON), so the raw value
    is only looked at in those cases.
    """
    suspect = value.isNull()
    if isinstance(dst, StringType):
        suspect = suspect | value.startswith("[")
    is_list = suspect & F.try_variant_get(v, path + "[0]", "variant").isNotNull()
    first = _variant_value(v, path + "[0]", dst, meta or {})
    many = is_list & F.try_variant_get(v, path + "[1]", "variant").isNotNull()
    raw = F.try_variant_get(v, path, "variant")
    is_empty = F.try_variant_get(v, path, "array<variant>").isNotNull()
    lost = suspect & raw.isNotNull() & ~F.is_variant_null(raw) & ~is_list & ~is_empty & value.isNull()
    return (F.when(many, F.raise_error(F.lit(f"field {path} holds several values but its type is single-valued")))
            .when(is_list, F.when(first.isNull() & ~F.is_variant_null(F.try_variant_get(v, path + "[0]", "variant")), _unreadable(v, path, dst)).otherwise(first))
            .when(lost, _unreadable(v, path, dst)).otherwise(value))


def _unreadable(v: Column, path: str, dst: DataType) -> Column:
    """A job failure that names the field, the document and the value."""
    return F.raise_error(F.concat(F.lit(f"field {path} of document "), F.coalesce(F.try_variant_get(v, "$._id", "string"), F.lit("?")),
                                  F.lit(f" is not a {dst.simpleString()}: "), F.coalesce(F.try_variant_get(v, path, "string"), F.lit("an object"))))


def _variant_value(v: Column, path: str, dst: DataType, meta: dict | None) -> Column:
    """The value at ``path`` converted to ``dst`` (lists for array types)."""
    meta = meta or {}
    if isinstance(dst, VariantType):
        return F.try_variant_get(v, path, "variant")
    if isinstance(dst, ArrayType):
        elem = dst.elementType
        if isinstance(elem, (DateType, TimestampType, TimestampNTZType)):
            raw = one_or_many(v, path, "string")
            out = F.transform(raw, lambda x: convert(x, StringType(), elem, meta, path))
        else:
            out = one_or_many(v, path, _ddl(elem))
        if meta.get("dims"):
            out = check_dims(out, int(meta["dims"]), path)
        return out
    if isinstance(dst, DateType):
        return parse_date(F.try_variant_get(v, path, "string"), meta.get("format"))
    if isinstance(dst, (TimestampType, TimestampNTZType)):
        return parse_timestamp(F.try_variant_get(v, path, "string"),
                               ntz=isinstance(dst, TimestampNTZType))
    if isinstance(dst, StringType):
        return F.try_variant_get(v, path, "string")
    return F.try_variant_get(v, path, _ddl(dst))
