"""Literals of wildcard and regexp patterns: the same matches as the bare
regular expression, and plain comparisons in the plan."""

import random

import pytest
from pyspark.sql import functions as F

from docindex.functions.patterns import regexp_pattern, wildcard_pattern
from docindex.functions.query import where_query

ALPHABET = "ab.*?\\x"


def regexes(rng, depth=0):
    k = rng.randrange(9 if depth < 3 else 4)
    if k < 3:
        return rng.choice(["a", "b", "ab", "x", "\\.", '"a.b"'])
    if k == 3:
        return rng.choice([".", "[ab]", "[^a]", "[x-z.]", "@", "#"])
    if k == 4:
        return f"({regexes(rng, depth + 1)})" + rng.choice(["*", "+", "?", "{2}", "{0,2}", "{1,}"])
    if k == 5:
        return f"({regexes(rng, depth + 1)}|{regexes(rng, depth + 1)})"
    return regexes(rng, depth + 1) + regexes(rng, depth + 1)


def test_same_matches_as_the_expression(spark):
    rng = random.Random(8)
    values = sorted({"".join(rng.choice("abx.*") for _ in range(rng.randrange(7))) for _ in range(300)}) + [None, "a\nb"]
    df = spark.createDataFrame([(v,) for v in values], "v string").coalesce(1).cache()
    parsed = [wildcard_pattern("".join(rng.choice(ALPHABET) for _ in range(rng.randrange(6)))) for _ in range(60)]
    parsed += [wildcard_pattern(w) for w in ("*", "**", "a*", "*a", "*a*", "a*b", "?*", "*ab*x*", "\\*", "", "*a?b*")]
    parsed += [regexp_pattern(regexes(rng)) for _ in range(90)]
    c = F.col("v")
    flags = [F.coalesce(p.matches(c, ci) != c.rlike(p.regex(ci)), F.lit(False)).cast("int") for p in parsed for ci in (False, True)]
    for i in range(0, len(flags), 60):
        wrong = df.select(*[F.sum(f) for f in flags[i:i + 60]]).first()
        assert not any(wrong), [parsed[(i + j) // 2] for j, w in enumerate(wrong) if w]


@pytest.mark.parametrize("text,exact,prefix,suffix,need", [
    ("Brand\\#1[0-9]", None, "Brand#1", "", "Brand#1"),
    ("ab(c|cd)e*", None, "abc", "", "abc"),
    ("(foo|bar)baz", None, "", "baz", "baz"),
    ("(x){2,}yz", None, "x", "xyz", "xyz"),
    ("a.*bcd.*e", None, "a", "e", "bcd"),
    ('"a.b"c', "a.bc", "a.bc", "a.bc", "a.bc"),
    ("a?bc", None, "", "bc", "bc"),
    ("^a$", "^a$", "^a$", "^a$", "^a$"),
])
def test_literals_of_regexps(text, exact, prefix, suffix, need):
    p = regexp_pattern(text)
    assert (p.exact, p.prefix, p.suffix, p.need) == (exact, prefix, suffix, need)


@pytest.mark.parametrize("text", ["a&b", "~a", "<1-5>", "(a", "a)", "[a", "*a", "a{x}", "a\\", '"a'])
def test_refused(text):
    with pytest.raises(ValueError):
        regexp_pattern(text)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prefixes_reach_the_scan(spark):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    text = plan(where_query(part, {"wildcard": {"p_name": "re*d?*"}}))
    assert "StringStartsWith(p_name,re)" in text and "RLIKE" in text.upper()
    text = plan(where_query(part, {"wildcard": {"p_name": "red*"}}))
    assert "StringStartsWith(p_name,red)" in text and "RLIKE" not in text.upper()
    assert "StringStartsWith(p_brand,Brand#1)" in plan(where_query(part, {"regexp": {"p_brand": "Brand\\#1[0-9]"}}))
    assert "StringEndsWith(p_name,ring)" in plan(where_query(part, {"wildcard": {"p_name": "*ring"}}))
    assert "EqualTo(p_name,red ring)" in plan(where_query(part, {"wildcard": {"p_name": "red ring"}}))
