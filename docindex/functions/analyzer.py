"""Text analysis: lower case, split on anything that is not a token character,
drop empty tokens.  Three analyzers differ in their token characters.

The same rule exists in two forms: ``analyze`` for query texts on the driver,
and column expressions for documents.  Letters are lowered one by one on both
sides (a capital sigma at the end of a word would otherwise depend on its
neighbours).

Documents can be tested in two ways.  Filters read the lowered text: a
substring test, then a regular expression that begins with the token's letters
and only then looks at what stands beside them.  Frequencies and lengths read
the *marked* text: the tokens, found in one pass of a regular
expression, and for phrases the same in one line with blanks around each token,
where a phrase is a plain substring and its frequency a difference of lengths.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Analyzer:
    """Token characters as a regular-expression class and as categories of
    code points (None: anything but ASCII white space)."""

    name: str
    inside: str
    outside: str
    categories: str | None = None
    lower: bool = True

    def is_char(self, ch: str) -> bool:
        if self.categories is None:
            return ch not in " \t\n\x0b\f\r"
        return unicodedata.category(ch)[0] in self.categories


# Token characters of the built-in analyzers.
STANDARD = Analyzer("standard", r"[\p{L}\p{N}]", r"[^\p{L}\p{N}]", "LN")
SIMPLE = Analyzer("simple", r"[\p{L}]", r"[^\p{L}]", "L")
WHITESPACE = Analyzer("whitespace", r"[^ \t\n\x0B\f\r]", r"[ \t\n\x0B\f\r]", None, False)
ANALYZERS = {a.name: a for a in (STANDARD, SIMPLE, WHITESPACE)}

SEPARATOR = STANDARD.outside + "+"


def lower_text(text: str) -> str:
    """Lower case, letter by letter."""
    return text.replace("Σ", "σ").lower()


def lower(c: Column) -> Column:
    """The same for a column."""
    return F.lower(F.replace(c, F.lit("Σ"), F.lit("σ")))


def _low(c: Column, an: Analyzer) -> Column:
    return lower(c) if an.lower else c


@lru_cache(4096)
def _analyze(text: str, an: Analyzer) -> tuple[str, ...]:
    text = lower_text(text) if an.lower else text
    return tuple("".join(ch if an.is_char(ch) else " " for ch in text).split(" "))


def analyze(text: str, an: Analyzer = STANDARD) -> list[str]:
    """Analyze a query string on the driver (query literals only)."""
    if text is None:
        return []
    return [t for t in _analyze(str(text), an) if t]


def is_token(value: str, an: Analyzer = STANDARD) -> bool:
    """True if ``value`` could be produced by the analyzer."""
    return bool(value) and analyze(value, an) == [value]


def tokens(c: Column, an: Analyzer = STANDARD) -> Column:
    """array<string> of the analyzed tokens of a string column."""
    return F.regexp_extract_all(_low(c, an), F.lit(an.inside + "+"), F.lit(0))


# --- tests on the text itself -------------------------------------------------

def _quoted(tok: str) -> str:
    return "".join("\\" + ch if ch in r"\.[]{}()*+-?^$|&#~/" else ch for ch in tok)


def _bounded(toks: list[str], an: Analyzer) -> str:
    """A pattern for any of ``toks``: its letters first, then its edges, so
    that most positions of a text fail at the first letter."""
    parts = [f"{_quoted(t)}(?<!{an.inside}{_quoted(t)})" for t in toks]
    return f"(?:{'|'.join(parts)})(?!{an.inside})"


@dataclass(frozen=True)
class Lowered:
    """A text as the analyzer splits it, tested without being split."""

    low: Column
    analyzer: Analyzer = STANDARD

    def has_any(self, toks: list[str]) -> Column:
        """True if any of ``toks`` (already analyzed) is a token."""
        if not toks:
            return F.lit(False)
        toks = sorted(set(toks))
        found = self.low.contains(toks[0])
        for t in toks[1:]:
            found = found | self.low.contains(t)
        return found & self.low.rlike(_bounded(toks, self.analyzer))

    def has_phrase(self, toks: list[str], last_is_prefix: bool = False) -> Column:
        """True if ``toks`` occur as adjacent tokens, in order."""
        if not toks:
            return F.lit(False)
        an, pre = self.analyzer, None
        for t in sorted(set(toks)):
            p = self.low.contains(t)
            pre = p if pre is None else (pre & p)
        first = f"{_quoted(toks[0])}(?<!{an.inside}{_quoted(toks[0])})"
        body = (an.outside + "+").join([first, *map(_quoted, toks[1:])])
        return pre & self.low.rlike(body + ("" if last_is_prefix else f"(?!{an.inside})"))


def lowered(c: Column, an: Analyzer = STANDARD) -> Lowered:
    return Lowered(_low(c, an), an)


def has_any_token(c: Column, toks: list[str], an: Analyzer = STANDARD) -> Column:
    return lowered(c, an).has_any(toks)


# --- tests on the tokens -----------------------------------------------------------

@dataclass(frozen=True)
class Marked:
    """The analyzed text of a field: its tokens, and (for phrases) the same with
    every token between single blanks, ``"  red  fox  "``."""

    tokens: Column
    line: Column | None = None

    def _line(self) -> Column:
        return joined(self.tokens) if self.line is None else self.line

    def has(self, tok: str) -> Column:
        return F.array_contains(self.tokens, F.lit(tok))

    def has_any(self, toks: list[str]) -> Column:
        toks = sorted(set(toks))
        out = self.has(toks[0]) if toks else F.lit(False)
        for t in toks[1:]:
            out = out | self.has(t)
        return out

    def has_phrase(self, toks: list[str], last_is_prefix: bool = False) -> Column:
        """Whether ``toks`` stand next to each other."""
        if len(toks) == 1 and not last_is_prefix:
            return self.has(toks[0])
        p = _phrase(toks)
        return self._line().contains(p[:-1] if last_is_prefix else p)

    def count(self, toks: list[str]) -> Column:
        """How often ``toks`` stand next to each other, overlaps included."""
        if len(toks) == 1:
            return F.size(self.tokens) - F.size(F.array_remove(self.tokens, toks[0]))
        line, part = self._line(), _phrase(toks)
        if any(toks[i:] == toks[:-i] for i in range(1, len(toks))):
            # a phrase that can overlap itself: count where it begins
            return F.size(F.regexp_extract_all(line, F.lit(f"(?={_quoted(part)})"), F.lit(0)))
        return ((F.octet_length(line) - F.octet_length(F.replace(line, F.lit(part), F.lit("")))) / F.lit(len(part.encode()))).cast("int")

    def length(self) -> Column:
        """Number of tokens; null without a text."""
        return F.when(self.tokens.isNotNull(), F.size(self.tokens))


def _phrase(toks: list[str]) -> str:
    return " " + "  ".join(toks) + " "


def joined(toks: Column) -> Column:
    """Tokens as one text, each between single blanks."""
    return F.concat(F.lit(" "), F.array_join(toks, "  "), F.lit(" "))


def marked(c: Column, an: Analyzer = STANDARD) -> Marked:
    return Marked(tokens(c, an))
