"""Search-query JSON (the common query DSL) compiled to a Catalyst ``Column``.

The same query runs against a remote index (as a pushed request), a Parquet
folder or any DataFrame.  The compiler only builds expressions; Catalyst
plans them, pushes the plain comparisons into the Parquet scan and keeps the
rest inside whole-stage code generation.  No Python runs per row.

Rules:

* Two-valued logic.  A leaf on a missing or null value is false.  Leaves are
  emitted bare in positive position (so ``value < 100`` still reaches the
  scan as a pushed filter) and as ``NOT coalesce(leaf, false)`` under
  ``must_not``.
* Multi-valued fields.  A leaf on an array is true if any element matches.
* Text vs keyword comes from the field metadata key ``es_type``.  A string
  field without metadata counts as text for full-text queries (``match``,
  ``match_phrase``) and as keyword for term-level queries; its sub-field
  ``keyword`` is the keyword in either case.
* Sub-fields, normalizers, null values, aliases and copied fields of the
  mapping are resolved by ``docindex.functions.fields``.
* A text that a query asks several things of is lowered once by ``where_query``.
"""

from __future__ import annotations

import fnmatch
import json
import re
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    MapType,
    NumericType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from docindex.functions import analyzer as A
from docindex.functions.fields import View, aliases, check_searchable, searchable, sub_field
from docindex.functions.patterns import Pattern, regexp_pattern, wildcard_pattern

Leaf = Callable[[View], Column]


def to_query_dict(query: Any) -> dict | None:
    """Accept a Mapping, a JSON string, or any object with ``to_dict()``."""
    if query is None:
        return None
    if isinstance(query, str):
        return json.loads(query)
    if isinstance(query, Mapping):
        return dict(query)
    to_dict = getattr(query, "to_dict", None)
    if callable(to_dict):
        return to_dict()
    raise TypeError(f"query must be a mapping or have to_dict(), got {type(query).__name__}")


def _single(params: Mapping, name: str) -> tuple[str, Any]:
    if not isinstance(params, Mapping) or len(params) != 1:
        raise ValueError(f"[{name}] query expects exactly one field, got {params!r}")
    (field, value), = params.items()
    return field, value


def _literal(value: Any, dtype: DataType) -> Column:
    """A literal converted to the column's type."""
    if isinstance(dtype, (TimestampType, TimestampNTZType, DateType)):
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            ts = F.timestamp_millis(F.lit(int(value)))
            return ts.cast(dtype)
        s = str(value)
        if s.startswith("now") or "||" in s:
            raise ValueError(f"date math is not supported: {s!r}")
        return F.lit(s).cast(dtype)
    if isinstance(dtype, BooleanType) and isinstance(value, str):
        return F.lit(value.lower() == "true")
    if isinstance(dtype, NumericType) and isinstance(value, str):
        return F.lit(value).cast(dtype)
    return F.lit(value)


class QueryCompiler:
    """Compiles one query dict against one schema."""

    def __init__(self, schema: StructType, marks: Mapping[tuple[str, str], A.Marked | A.Lowered] | None = None):
        self.schema = schema
        self.marks = dict(marks or {})
        #: text passes that the compiled queries asked for, by path and analyzer,
        #: and whether phrases were among them
        self.touched: dict[tuple[str, str], tuple[int, bool]] = {}
        self.aliases = aliases(schema)
        # stack of (path prefix, element column, element struct type[, texts]) for nested
        self._scopes: list[tuple] = []
        self._in_array = 0

    # -- field resolution -------------------------------------------------
    def _lookup(self, stype: StructType, parts: list[str]) -> tuple[StructField, int] | None:
        names = {f.name: f for f in stype.fields}
        for i in range(len(parts), 0, -1):
            name = ".".join(parts[:i])
            if name in names:
                return names[name], i
        return None

    def field_pred(self, path: str, leaf: Leaf) -> Column:
        """Apply ``leaf`` to the field at ``path``; arrays mean any element."""
        path = self.aliases.get(path, path)
        for prefix, base, stype, *texts in reversed(self._scopes):
            if path.startswith(prefix + "."):
                rel = path[len(prefix) + 1:].split(".")
                got = self._walk(rel, base, stype, leaf, path, texts[0] if texts else None)
                if got is not None:
                    return got
        got = self._walk(path.split("."), None, self.schema, leaf, path, None if self._scopes else (self.marks, self.touched))
        return F.lit(False) if got is None else got

    # ``texts``: the marked texts at hand and the passes asked for, or None
    def _walk(self, parts, base, stype, leaf, path, texts):
        hit = self._lookup(stype, parts)
        if hit is None:
            return None
        field, used = hit
        c = F.col("`" + field.name + "`") if base is None else base.getField(field.name)
        copied = (field.metadata or {}).get("copied_from")
        if copied and used == len(parts) and not self._scopes:
            return self._copied(c, field, copied, leaf, path)
        return self._apply(c, field.dataType, field, parts[used:], leaf, path, texts)

    def _apply(self, c, dtype, field, rest, leaf, path, texts):
        check_searchable(path, field.metadata or {})
        if isinstance(dtype, ArrayType):
            # one marked text per document: elements are tested on their own
            self._in_array += 1
            try:
                return F.exists(c, lambda x: self._apply(x, dtype.elementType, field, rest, leaf, path, None))
            finally:
                self._in_array -= 1
        if not rest:
            return leaf(self._view(path, c, dtype, field.metadata, texts))
        if isinstance(dtype, StructType):
            got = self._walk(rest, c, dtype, leaf, path, texts)
            return F.lit(False) if got is None else got
        if isinstance(dtype, MapType):
            return self._apply(c.getItem(".".join(rest)), dtype.valueType, field, [], leaf, path, None)
        meta = sub_field(field, rest)
        if meta is None:
            return F.lit(False)
        check_searchable(path, meta)
        return leaf(self._view(path, c, dtype, meta, texts))

    def _view(self, path, c, dtype, meta, texts) -> View:
        return View(path, c, dtype, meta or {}, *(texts or ({}, None)))

    def _copied(self, c, field, sources, leaf, path):
        """A field that other fields are copied into: their texts together, or
        any of their values."""
        view = self._view(path, c, field.dataType, field.metadata, (self.marks, self.touched))
        if view.is_text(full_text=True):
            return leaf(View(path, F.concat_ws("\n", c, *[self._source(s) for s in sources]), view.dtype, view.meta, view.marks, view.touched))
        return _or_all([leaf(View(path, x.cast(field.dataType), field.dataType, field.metadata or {})) for x in (c, *map(self._source, sources))])

    def _source(self, path: str) -> Column:
        got = []
        self._walk(path.split("."), None, self.schema, lambda v: got.append(v.column) or F.lit(True), path, None)
        return got[0] if got else F.lit(None).cast("string")

    def view(self, path: str) -> View | None:
        """The field at ``path`` in the innermost scope; None if unmapped or
        below an array."""
        got: list[View | None] = []
        depth = self._in_array
        try:
            self.field_pred(path, lambda v: got.append(v if self._in_array == depth else None) or F.lit(True))
        except ValueError:
            return None
        return got[0] if got else None

    def resolve_fields(self, patterns: list[str]) -> list[str]:
        """Expand ``fields`` lists: strip ``^boost``, expand wildcards (also to
        sub-fields, but not to fields that can't be searched)."""
        names = []
        flat = _flat_names(self.schema, subs=True)
        for p in patterns:
            p = p.split("^", 1)[0]
            if any(ch in p for ch in "*?"):
                names.extend(n for n in flat if fnmatch.fnmatchcase(n, p))
            else:
                names.append(p)
        return names

    # -- entry ------------------------------------------------------------
    def compile(self, query: Any) -> Column:
        q = to_query_dict(query)
        if q is None or q == {}:
            return F.lit(True)
        if len(q) != 1:
            raise ValueError(f"a query object has exactly one key, got {sorted(q)}")
        (name, params), = q.items()
        handler = getattr(self, "_q_" + name, None)
        if handler is None:
            raise ValueError(f"unknown or unsupported query type {name!r}")
        return handler(params)

    # -- compound ---------------------------------------------------------
    def _q_match_all(self, params):
        return F.lit(True)

    def _q_match_none(self, params):
        return F.lit(False)

    def _q_bool(self, params):
        def clauses(key):
            v = params.get(key)
            if v is None:
                return []
            return list(v) if isinstance(v, list) else [v]

        must = [self.compile(c) for c in clauses("must") + clauses("filter")]
        should = [self.compile(c) for c in clauses("should")]
        must_not = [self.compile(c) for c in clauses("must_not")]
        msm = params.get("minimum_should_match")
        if msm is None:
            need = 1 if (should and not must) else 0
        else:
            need = _min_should(msm, len(should))
        parts: list[Column] = list(must)
        if should and need > 0:
            if need == 1:
                parts.append(_or_all(should))
            else:
                count = None
                for s in should:
                    term = F.coalesce(s, F.lit(False)).cast("int")
                    count = term if count is None else count + term
                parts.append(count >= F.lit(need))
        for n in must_not:
            parts.append(~F.coalesce(n, F.lit(False)))
        if not parts:
            return F.lit(True)
        return _and_all(parts)

    def _q_constant_score(self, params):
        return self.compile(params["filter"])

    def _q_dis_max(self, params):
        qs = [self.compile(c) for c in params.get("queries", [])]
        return _or_all(qs) if qs else F.lit(False)

    def _q_boosting(self, params):
        return self.compile(params["positive"])

    def _q_nested(self, params):
        path = params["path"]
        inner = params["query"]

        def leaf(v):
            if not isinstance(v.dtype, StructType):
                raise ValueError(f"nested path {path!r} is not an object")
            return self._scoped(path, v.column, v.dtype, inner)

        hit = self._lookup(self.schema, path.split("."))
        if hit is None and not self._scopes:
            if params.get("ignore_unmapped"):
                return F.lit(False)
            raise ValueError(f"nested path {path!r} not in schema")
        return self.field_pred(path, leaf)

    def _scoped(self, prefix, col, stype, inner):
        self._scopes.append((prefix, col, stype))
        try:
            return self.compile(inner)
        finally:
            self._scopes.pop()

    # -- term level -------------------------------------------------------
    def _q_term(self, params):
        field, spec = _single(params, "term")
        if isinstance(spec, Mapping):
            value = spec.get("value")
            ci = bool(spec.get("case_insensitive", False))
        else:
            value, ci = spec, False

        def leaf(v):
            if v.is_text(full_text=False):
                t = A.lower_text(str(value)) if ci else str(value)
                return v.has_any([t]) if A.is_token(t, v.analyzer) else F.lit(False)
            if ci and isinstance(v.dtype, StringType):
                return A.lower(v.values) == F.lit(A.lower_text(v.normal(str(value))))
            return v.values == _literal(v.normal(value), v.dtype)

        return self.field_pred(field, leaf)

    def _q_terms(self, params):
        items = [(k, v) for k, v in params.items() if k != "boost"]
        if len(items) != 1:
            raise ValueError("[terms] query expects exactly one field")
        field, values = items[0]
        if isinstance(values, Mapping):
            raise ValueError("terms lookup is not supported")
        values = list(values)

        def leaf(v):
            if v.is_text(full_text=False):
                return v.has_any([str(x) for x in values if A.is_token(str(x), v.analyzer)])
            if not values:
                return F.lit(False)
            if isinstance(v.dtype, (TimestampType, TimestampNTZType, DateType, BooleanType)):
                return v.values.isin(*[_literal(x, v.dtype) for x in values])
            return v.values.isin([v.normal(x) for x in values])

        return self.field_pred(field, leaf)

    def _q_ids(self, params):
        values = [str(v) for v in params.get("values", [])]
        if "_id" not in self.schema.fieldNames():
            raise ValueError("ids query needs an _id column")
        return F.col("_id").isin(values) if values else F.lit(False)

    def _q_exists(self, params):
        def any_value(c, dtype):
            if isinstance(dtype, StructType):
                # an object exists if any value inside it does
                inner = F.lit(False)
                for g in dtype.fields:
                    inner = inner | any_value(c.getField(g.name), g.dataType)
                return c.isNotNull() & inner
            return c.isNotNull()

        def leaf(v):
            return any_value(v.column, v.dtype) if isinstance(v.dtype, StructType) else v.values.isNotNull()

        return self.field_pred(params["field"], leaf)

    def _q_prefix(self, params):
        field, spec = _single(params, "prefix")
        if isinstance(spec, Mapping):
            value, ci = str(spec.get("value")), bool(spec.get("case_insensitive", False))
        else:
            value, ci = str(spec), False

        def leaf(v):
            if v.is_text(full_text=False):
                t = A.lower_text(value) if ci else value
                if t and not A.is_token(t, v.analyzer):
                    return F.lit(False)
                return v.has_prefix(t)
            if ci:
                return A.lower(v.values).startswith(A.lower_text(v.normal(value)))
            return v.values.startswith(v.normal(value))

        return self.field_pred(field, leaf)

    def _pattern_leaf(self, value: str, ci: bool, parse: Callable[[str], Pattern]) -> Leaf:
        def leaf(v):
            if v.is_text(full_text=False):
                rx = parse(value).regex(ci)
                return F.exists(A.tokens(v.column, v.analyzer), lambda t: t.rlike(rx))
            return parse(v.normal(value)).matches(v.values.cast("string"), ci)
        return leaf

    def _q_wildcard(self, params):
        field, spec = _single(params, "wildcard")
        if isinstance(spec, Mapping):
            value = spec.get("value", spec.get("wildcard"))
            ci = bool(spec.get("case_insensitive", False))
        else:
            value, ci = spec, False
        return self.field_pred(field, self._pattern_leaf(str(value), ci, wildcard_pattern))

    def _q_regexp(self, params):
        field, spec = _single(params, "regexp")
        if isinstance(spec, Mapping):
            value = spec["value"]
            ci = bool(spec.get("case_insensitive", False))
        else:
            value, ci = spec, False
        # normalizers don't apply to regular expressions
        parse = regexp_pattern(str(value))

        def leaf(v):
            if v.is_text(full_text=False):
                rx = parse.regex(ci)
                return F.exists(A.tokens(v.column, v.analyzer), lambda t: t.rlike(rx))
            return parse.matches(v.values.cast("string"), ci)

        return self.field_pred(field, leaf)

    def _q_range(self, params):
        field, spec = _single(params, "range")
        bounds = []
        gt, gte = spec.get("gt"), spec.get("gte")
        lt, lte = spec.get("lt"), spec.get("lte")
        if "from" in spec and spec["from"] is not None:
            if spec.get("include_lower", True):
                gte = spec["from"]
            else:
                gt = spec["from"]
        if "to" in spec and spec["to"] is not None:
            if spec.get("include_upper", True):
                lte = spec["to"]
            else:
                lt = spec["to"]
        for op, v in (("gt", gt), ("gte", gte), ("lt", lt), ("lte", lte)):
            if v is not None:
                bounds.append((op, v))
        fmt = spec.get("format")

        def leaf(v):
            c, out = v.values, None
            for op, x in bounds:
                if fmt and isinstance(x, str) and isinstance(v.dtype, (TimestampType, TimestampNTZType, DateType)):
                    lit = _date_in(x, fmt, v.dtype)
                else:
                    lit = _literal(v.normal(x), v.dtype)
                p = {"gt": c > lit, "gte": c >= lit, "lt": c < lit, "lte": c <= lit}[op]
                out = p if out is None else (out & p)
            return c.isNotNull() if out is None else out

        return self.field_pred(field, leaf)

    # -- full text --------------------------------------------------------
    def _match_leaf(self, query_text, operator="or", msm=None, zero_terms="none"):
        def leaf(v):
            if v.is_text(full_text=True):
                toks = A.analyze(query_text, v.analyzer)
                if not toks:
                    return F.lit(zero_terms == "all")
                uniq = sorted(set(toks))
                if msm is not None:
                    need = _min_should(msm, len(uniq))
                    if need <= 1:
                        return v.has_any(uniq)
                    return v.present(uniq) >= F.lit(need)
                if str(operator).lower() == "and":
                    return v.has_all(uniq)
                return v.has_any(uniq)
            return v.values == _literal(v.normal(query_text), v.dtype)
        return leaf

    def _q_match(self, params):
        field, spec = _single(params, "match")
        if isinstance(spec, Mapping):
            leaf = self._match_leaf(spec["query"], spec.get("operator", "or"),
                                    spec.get("minimum_should_match"),
                                    spec.get("zero_terms_query", "none"))
        else:
            leaf = self._match_leaf(spec)
        return self.field_pred(field, leaf)

    def _phrase_leaf(self, query_text, last_is_prefix=False):
        def leaf(v):
            if v.is_text(full_text=True):
                return v.has_phrase(A.analyze(query_text, v.analyzer), last_is_prefix)
            if last_is_prefix:
                return v.values.startswith(v.normal(str(query_text)))
            return v.values == _literal(v.normal(query_text), v.dtype)
        return leaf

    def _q_match_phrase(self, params):
        field, spec = _single(params, "match_phrase")
        if isinstance(spec, Mapping):
            if int(spec.get("slop", 0)) != 0:
                raise ValueError("match_phrase with slop is not supported")
            text = spec["query"]
        else:
            text = spec
        return self.field_pred(field, self._phrase_leaf(text))

    def _q_match_phrase_prefix(self, params):
        """A phrase whose last token may go on; a server stops after a number
        of such tokens (``max_expansions``), here all count."""
        field, spec = _single(params, "match_phrase_prefix")
        return self.field_pred(field, self._phrase_leaf(spec["query"] if isinstance(spec, Mapping) else spec, True))

    def _q_multi_match(self, params):
        text = params["query"]
        fields = self.resolve_fields(params.get("fields") or _flat_names(self.schema))
        kind = params.get("type", "best_fields")
        operator = params.get("operator", "or")
        msm = params.get("minimum_should_match")
        if kind in ("best_fields", "most_fields"):
            parts = [self.field_pred(f, self._match_leaf(text, operator, msm)) for f in fields]
        elif kind in ("phrase", "phrase_prefix"):
            parts = [self.field_pred(f, self._phrase_leaf(text, kind == "phrase_prefix")) for f in fields]
        elif kind == "cross_fields":
            toks = sorted(set(A.analyze(text)))
            per_tok = [_or_all([self.field_pred(f, self._match_leaf(t)) for f in fields])
                       for t in toks]
            if not per_tok:
                return F.lit(False)
            if str(operator).lower() == "and":
                return _and_all(per_tok)
            return _or_all(per_tok)
        else:
            raise ValueError(f"multi_match type {kind!r} is not supported")
        return _or_all(parts) if parts else F.lit(False)


def _date_in(text: str, fmt: str, dtype: DataType) -> Column:
    """A bound of a range query, written in the query's own date format."""
    from docindex.functions.values import DATE_PATTERNS, parse_date
    if all(f in DATE_PATTERNS for f in fmt.split("||")):
        return parse_date(F.lit(text), fmt).cast(dtype)
    if fmt in ("epoch_millis", "epoch_second"):
        return F.timestamp_millis(F.lit(int(text) * (1 if fmt == "epoch_millis" else 1000))).cast(dtype)
    return F.coalesce(*[F.try_to_timestamp(F.lit(text), F.lit(f)) for f in fmt.split("||")]).cast(dtype)


def _flat_names(schema: StructType, prefix: str = "", subs: bool = False) -> list[str]:
    out = []
    for f in schema.fields:
        name = prefix + f.name
        dt = f.dataType
        while isinstance(dt, ArrayType):
            dt = dt.elementType
        if isinstance(dt, StructType):
            out.extend(_flat_names(dt, name + ".", subs))
        elif isinstance(dt, StringType) and not f.name.startswith("_") and searchable(f.metadata or {}):
            out.append(name)
            if subs:
                out.extend(f"{name}.{s}" for s, meta in (f.metadata or {}).get("fields", {}).items() if searchable(meta))
    return out


def _min_should(msm: Any, n: int) -> int:
    """``minimum_should_match`` as a count: int, "3", "-1", "75%", "-25%"."""
    s = str(msm).strip()
    if s.endswith("%"):
        pct = int(s[:-1])
        v = (n * pct) // 100 if pct >= 0 else n - (n * -pct) // 100
    else:
        v = int(s)
        if v < 0:
            v = n + v
    return max(0, min(v, n)) if n else max(v, 0)


def _and_all(cs: list[Column]) -> Column:
    out = cs[0]
    for c in cs[1:]:
        out = out & c
    return out


def _or_all(cs: list[Column]) -> Column:
    out = cs[0]
    for c in cs[1:]:
        out = out | c
    return out


def query_column(query: Any, schema: StructType) -> Column:
    """Compile a search query to a boolean ``Column`` for ``schema``."""
    return QueryCompiler(schema).compile(query)


#: Column names of marked texts while a query runs.
_MARK = "__marked"


def marked_texts(df, touched: Mapping[tuple[str, str], tuple[int, bool]], split: bool):
    """``df`` with prepared texts for the keys of ``touched`` that ask for more
    than one pass, and these by key: marked texts, or (without ``split``) lowered
    ones, which is all that filters need.

    They come out of a generator of one row each: a projection would be merged
    into every test on it, and each test would prepare the text again.
    """
    qc, made, lines, ready = QueryCompiler(df.schema), [], [], {}
    for i, (key, (passes, line)) in enumerate(touched.items()):
        v = qc.view(key[0])
        if passes < 2 or v is None:
            continue
        an, c = A.ANALYZERS[key[1]], F.col(f"{_MARK}{i}")
        made.append((A.tokens(v.column, an) if split else A.lowered(v.column, an).low).alias(f"{_MARK}{i}"))
        if split and line:
            lines.append(A.joined(c).alias(f"{_MARK}{i}l"))
        ready[key] = A.Marked(c, F.col(f"{_MARK}{i}l") if line else None) if split else A.Lowered(c, an)
    for cols in (made, lines):
        if cols:
            df = df.select("*", F.inline(F.array(F.struct(*cols))))
    return df, ready


def where_query(df, query: Any):
    """``df`` restricted to the documents matching ``query``."""
    q = to_query_dict(query)
    if not q:
        return df
    plan = QueryCompiler(df.schema)
    cond = plan.compile(q)
    prepared, texts = marked_texts(df, plan.touched, split=False)
    if not texts:
        return df.where(cond)
    cond = QueryCompiler(df.schema, texts).compile(q)
    return prepared.where(cond).select(*[F.col("`" + c + "`") for c in df.columns])


def count_query(df, query: Any) -> int:
    """Number of matching documents (one distributed count)."""
    return where_query(df, query).count()


class Q:
    """A small query object: a dict with ``&``, ``|`` and ``~``.

    ``Q("range", value={"lt": 100}) & Q("match", text="foo")``
    """

    def __init__(self, name: str | Mapping, **params):
        if isinstance(name, Mapping):
            self._d = dict(name)
        else:
            self._d = {name: params}

    def to_dict(self) -> dict:
        return self._d

    def __and__(self, other: "Q") -> "Q":
        return Q({"bool": {"must": [self.to_dict(), to_query_dict(other)]}})

    def __or__(self, other: "Q") -> "Q":
        return Q({"bool": {"should": [self.to_dict(), to_query_dict(other)]}})

    def __invert__(self) -> "Q":
        return Q({"bool": {"must_not": [self.to_dict()]}})

    def __repr__(self) -> str:
        return f"Q({self._d!r})"
