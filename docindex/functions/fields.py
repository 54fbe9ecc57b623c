"""What a field path of a query means: which stored column it reads, and how
that column's values are indexed.

One stored column may be searched in several ways.  A mapping gives it
sub-fields (``name.raw``), a normalizer (values and query values go through the
same filters), a value that stands for null, a length above which values are
not indexed, or an analyzer; other names may lead to it (aliases), and its
values may be copied into further fields.  ``mapping.py`` records all of these in
the field metadata; a ``View`` applies them when a query reaches the field.

A path that nothing is mapped to matches no document.  A field that is mapped
but not searchable (``index: false`` without doc values, ``enabled: false``)
raises ``HiddenField``: a server refuses such queries too.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from docindex.functions import analyzer as A

# Mapping types whose strings are analyzed.
TEXT_TYPES = ("text", "search_as_you_type", "match_only_text")
# Fixed value: the sub-field that text without a mapping has, and its length limit.
DYNAMIC_SUBFIELD = {"keyword": {"es_type": "keyword", "ignore_above": 256}}
# Letters that fold to two.
_TWO_LETTERS = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ĳ": "ij", "Ĳ": "IJ", "þ": "th", "Þ": "TH"}
# Letters with a stroke, which have no decomposition.
_STROKES = {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L", "ħ": "h", "Ħ": "H", "ŧ": "t", "Ŧ": "T", "ı": "i"}


class HiddenField(ValueError):
    """A query on a field that is mapped but cannot be searched."""


@lru_cache(1)
def _folds() -> dict[str, str]:
    """Latin letters with marks and their plain letter, by decomposition."""
    out = dict(_STROKES)
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        ch = chr(code)
        base = unicodedata.normalize("NFD", ch)
        if len(base) > 1 and base[0].isascii() and all(unicodedata.combining(x) for x in base[1:]):
            out[ch] = base[0]
    return out


def fold_text(v: str) -> str:
    return "".join(_TWO_LETTERS.get(ch) or _folds().get(ch, ch) for ch in v)


def fold(c: Column) -> Column:
    for ch, two in _TWO_LETTERS.items():
        c = F.replace(c, F.lit(ch), F.lit(two))
    return F.translate(c, "".join(_folds()), "".join(_folds().values()))


# The filters a normalizer may name, for a value and for a column.
FILTERS = {
    "lowercase": (A.lower_text, A.lower),
    "uppercase": (str.upper, F.upper),
    "trim": (lambda v: v.strip(" "), F.trim),
    "asciifolding": (fold_text, fold),
}


@dataclass
class View:
    """A field as a query sees it."""

    path: str
    column: Column
    dtype: DataType
    meta: dict = field(default_factory=dict)
    marks: dict = field(default_factory=dict)   # (path, analyzer) -> marked text
    touched: dict | None = None                 # the same keys -> (text passes asked for, phrases among them)

    @property
    def es_type(self) -> str | None:
        return self.meta.get("es_type")

    def is_text(self, full_text: bool) -> bool:
        """Strings without a mapping are text for full-text queries only."""
        if not isinstance(self.dtype, StringType):
            return False
        return self.es_type in TEXT_TYPES if self.es_type is not None else full_text

    @property
    def analyzer(self) -> A.Analyzer:
        return A.ANALYZERS.get(self.meta.get("analyzer", "standard"), A.STANDARD)

    @property
    def exact(self) -> bool:
        """Whether values are indexed as they are stored."""
        return not any(k in self.meta for k in ("normalizer", "null_value", "ignore_above"))

    @property
    def values(self) -> Column:
        """The indexed values: bare where they are the stored ones."""
        c = self.column
        if "ignore_above" in self.meta and isinstance(self.dtype, StringType):
            c = F.when(F.char_length(c) <= int(self.meta["ignore_above"]), c)
        if "null_value" in self.meta:
            c = F.when(self.column.isNull(), F.lit(self.meta["null_value"]).cast(self.dtype)).otherwise(c)
        for name in self.meta.get("normalizer", ()):
            c = FILTERS[name][1](c)
        return c

    def normal(self, v: Any) -> Any:
        """A query value, as the field's values are indexed."""
        if isinstance(v, str) and isinstance(self.dtype, StringType):
            for name in self.meta.get("normalizer", ()):
                v = FILTERS[name][0](v)
        return v

    # -- text: over what the query has ready, else over the text itself

    def _mark(self, passes: int, line: bool = False) -> A.Marked | A.Lowered | None:
        key = (self.path, self.analyzer.name)
        if self.touched is not None:
            had = self.touched.get(key, (0, False))
            self.touched[key] = (had[0] + passes, had[1] or line)
        return self.marks.get(key)

    def marked(self, line: bool = False) -> A.Marked:
        """The marked text, made here if the query has none ready."""
        m = self._mark(2, line)
        return m if isinstance(m, A.Marked) else A.marked(self.column, self.analyzer)

    def has_any(self, toks: Iterable[str]) -> Column:
        return (self._mark(1) or A.lowered(self.column, self.analyzer)).has_any(list(toks))

    def has_all(self, toks: Iterable[str]) -> Column:
        out = None
        for t in sorted(set(toks)):
            p = self.has_any([t])
            out = p if out is None else out & p
        return F.lit(False) if out is None else out

    def present(self, toks: Iterable[str]) -> Column:
        """How many of the distinct ``toks`` the text has."""
        out = F.lit(0)
        for t in sorted(set(toks)):
            out = out + F.when(self.has_any([t]), 1).otherwise(0)
        return out

    def has_phrase(self, toks: list[str], last_is_prefix: bool = False) -> Column:
        if not toks:
            return F.lit(False)
        return (self._mark(1, True) or A.lowered(self.column, self.analyzer)).has_phrase(toks, last_is_prefix)

    def has_prefix(self, prefix: str) -> Column:
        return self.has_phrase([prefix], last_is_prefix=True) if prefix else self.column.isNotNull()


def searchable(meta: dict) -> bool:
    """Without an index, values other than text are still found by doc values."""
    return meta.get("enabled") is not False and (meta.get("index") is not False or (meta.get("es_type") not in TEXT_TYPES and meta.get("doc_values") is not False))


def check_searchable(path: str, meta: dict) -> None:
    if not searchable(meta):
        raise HiddenField(f"field {path!r} is mapped but not indexed: it can't be searched")


def sub_field(f: StructField, rest: list[str]) -> dict | None:
    """Metadata of the sub-field ``rest`` of a string field, if it has one."""
    meta = f.metadata or {}
    known = meta.get("fields")
    if known is None and meta.get("es_type") is None:
        known = DYNAMIC_SUBFIELD
    return (known or {}).get(".".join(rest))


def leaves(schema: StructType, prefix: str = "") -> Iterable[tuple[str, StructField]]:
    """(path, field) of all fields of a schema, objects included."""
    for f in schema.fields:
        yield prefix + f.name, f
        dt = f.dataType
        while isinstance(dt, ArrayType):
            dt = dt.elementType
        if isinstance(dt, StructType):
            yield from leaves(dt, prefix + f.name + ".")


def aliases(schema: StructType) -> dict[str, str]:
    """Other names that lead to a field."""
    return {name: path for path, f in leaves(schema) for name in (f.metadata or {}).get("aliases", ())}
