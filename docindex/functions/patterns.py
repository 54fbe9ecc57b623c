"""Wildcard and regular-expression queries, with the literals they require.

A walk over the pattern finds what every match must begin with, end with and
contain.  These literals become plain comparisons in front of the regular
expression: ``startswith`` reaches the Parquet scan as a pushed filter, and
``contains`` spares most values the expression.  Patterns that the literals
express completely (``abc*``, ``*abc``, ``*abc*``) need no expression at all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters with a meaning in Java's regular expressions.
_JAVA_SPECIAL = r"\.[]{}()*+-?^$|&#~/"


def _quote(text: str) -> str:
    return "".join("\\" + ch if ch in _JAVA_SPECIAL else ch for ch in text)


@dataclass(frozen=True)
class Pattern:
    """Part of a pattern: its Java expression and the literals of its matches.

    ``exact``: the only text it matches, if there is just one.  ``prefix``,
    ``suffix``, ``need``: what all matches begin with, end with and contain.
    ``open``: whether any text that begins with ``prefix``, ends with
    ``suffix`` and has ``need`` in between matches.
    """

    java: str
    exact: str | None = None
    prefix: str = ""
    suffix: str = ""
    need: str = ""
    open: bool = False

    def then(self, other: "Pattern") -> "Pattern":
        if self.exact is not None and other.exact is not None:
            return literal(self.exact + other.exact)
        prefix = self.exact + other.prefix if self.exact is not None else self.prefix
        suffix = self.suffix + other.exact if other.exact is not None else other.suffix
        # at the joint a literal may go on
        need = max((self.need, other.need, self.suffix + other.prefix), key=len)
        # exactly one end of the two is a literal, the other one open
        free = (self.open and other.exact is not None and not self.suffix) or (other.open and self.exact is not None and not other.prefix)
        return Pattern(self.java + other.java, None, prefix, suffix, need, free)

    def regex(self, ci: bool = False) -> str:
        """The whole value must match."""
        return ("(?i)" if ci else "") + f"(?s)\\A(?:{self.java})\\z"

    def matches(self, c: Column, ci: bool = False) -> Column:
        if ci:
            found = F.lower(c).contains(self.need.lower()) & c.rlike(self.regex(True)) if self.need.isascii() and self.need else c.rlike(self.regex(True))
            return found
        if self.exact is not None:
            return c == F.lit(self.exact)
        tests = [c.startswith(self.prefix)] if self.prefix else []
        tests += [c.endswith(self.suffix)] if self.suffix else []
        if self.open and len(tests) < 2 and (not self.need or self.need in (self.prefix, self.suffix)):
            return tests[0] if tests else c.isNotNull()
        if len(self.need) > max(len(self.prefix), len(self.suffix)):
            if self.open and not tests:
                return c.contains(self.need)
            tests.append(c.contains(self.need))
        out = c.rlike(self.regex())
        for t in reversed(tests):
            out = t & out
        return out


def literal(text: str) -> Pattern:
    return Pattern(_quote(text), text, text, text, text)


ANY_CHAR = Pattern(".")
ANY_TEXT = Pattern(".*", open=True)
NOTHING = Pattern("(?!)")


def _common(a: str, b: str) -> str:
    n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[:n]


def either(parts: list[Pattern]) -> Pattern:
    if len(parts) == 1:
        return parts[0]
    prefix, suffix = parts[0].prefix, parts[0].suffix[::-1]
    for p in parts[1:]:
        prefix, suffix = _common(prefix, p.prefix), _common(suffix, p.suffix[::-1])
    need = parts[0].need if all(p.need == parts[0].need for p in parts) else ""
    return Pattern("(?:" + "|".join(p.java for p in parts) + ")", None, prefix, suffix[::-1], max((need, prefix, suffix[::-1]), key=len))


def repeated(p: Pattern, least: int, mark: str) -> Pattern:
    java = f"(?:{p.java}){mark}"
    if least < 1:
        return Pattern(java)
    # one occurrence at either end; with several in between anything may stand
    return Pattern(java, None, p.prefix, p.suffix, p.need)


def wildcard_pattern(text: str) -> Pattern:
    """``*`` any text, ``?`` one character, ``\\`` escapes."""
    out, i = literal(""), 0
    while i < len(text):
        ch = text[i]
        if ch == "\\" and i + 1 < len(text):
            i += 1
            part = literal(text[i])
        else:
            part = ANY_TEXT if ch == "*" else ANY_CHAR if ch == "?" else literal(ch)
        # "**" is "*"
        if not (part is ANY_TEXT and out.java.endswith(".*") and out.exact is None):
            out = out.then(part)
        i += 1
    # *abc*: both ends are open and one literal stands between
    parts = text.split("*")
    if len(parts) == 3 and not parts[0] and not parts[2] and parts[1] and not set(parts[1]) & set("?\\"):
        return Pattern(out.java, None, "", "", parts[1], True)
    return out


class _Reader:
    """A pattern of the search syntax, read from left to right."""

    def __init__(self, text: str):
        self.text, self.i = text, 0

    def at(self, chars: str) -> bool:
        return self.i < len(self.text) and self.text[self.i] in chars

    def fail(self, why: str):
        raise ValueError(f"regexp {self.text!r}: {why}")

    def union(self) -> Pattern:
        parts = [self.sequence()]
        while self.at("|"):
            self.i += 1
            parts.append(self.sequence())
        return either(parts)

    def sequence(self) -> Pattern:
        out = literal("")
        while self.i < len(self.text) and not self.at("|)"):
            out = out.then(self.piece())
        return out

    def piece(self) -> Pattern:
        p = self.atom()
        while self.at("?*+{"):
            ch = self.text[self.i]
            if ch == "{":
                end = self.text.find("}", self.i)
                low, comma, high = self.text[self.i + 1:end].partition(",")
                if end < 0 or not low.isdigit() or (high and not high.isdigit()):
                    self.fail("a number of repetitions is expected")
                mark, least, self.i = "{" + low + comma + high + "}", int(low), end + 1
            else:
                mark, least, self.i = ch, int(ch == "+"), self.i + 1
            p = repeated(p, least, mark)
        return p

    def atom(self) -> Pattern:
        ch = self.text[self.i]
        self.i += 1
        if ch == "(":
            if self.at(")"):
                self.i += 1
                return literal("")
            p = self.union()
            if not self.at(")"):
                self.fail("a bracket is not closed")
            self.i += 1
            return p if p.exact is not None else Pattern(f"(?:{p.java})", None, p.prefix, p.suffix, p.need, p.open)
        if ch == "[":
            return self.chars()
        if ch == ".":
            return ANY_CHAR
        if ch == "@":
            return ANY_TEXT
        if ch == "#":
            return NOTHING
        if ch == '"':
            end = self.text.find('"', self.i)
            if end < 0:
                self.fail("a quote is not closed")
            part, self.i = self.text[self.i:end], end + 1
            return literal(part)
        if ch == "\\":
            if self.i >= len(self.text):
                self.fail("nothing follows the escape")
            ch = self.text[self.i]
            self.i += 1
            return Pattern("\\" + ch) if ch in "dDsSwW" else literal(ch)
        if ch in "&~<>":
            raise ValueError(f"regexp operator {ch!r} is not supported")
        if ch in "?*+{":
            self.fail(f"nothing is there to repeat before {ch!r}")
        return literal(ch)

    def chars(self) -> Pattern:
        out = ["["]
        if self.at("^"):
            self.i += 1
            out.append("^")
        first = True
        while not self.at("]") or first:
            if self.i >= len(self.text):
                self.fail("a set is not closed")
            ch = self.text[self.i]
            self.i += 1
            if ch == "\\" and self.i < len(self.text):
                nxt = self.text[self.i]
                out.append("\\" + nxt if nxt in "dDsSwW" else _quote(nxt))
                self.i += 1
            elif ch == "-" and not first and not self.at("]"):
                out.append("-")
            else:
                out.append(_quote(ch) if ch in _JAVA_SPECIAL else ch)
            first = False
        self.i += 1
        return Pattern("".join(out) + "]")


def regexp_pattern(text: str) -> Pattern:
    """The search syntax: ``. ? * + {n,m} | ( ) [ ] "..." @ #`` and escapes;
    ``^`` and ``$`` are literals; ``&``, ``~`` and ``<n-m>`` are refused."""
    r = _Reader(text)
    out = r.union()
    if r.i < len(text):
        r.fail("a bracket is closed that was not opened")
    return out
