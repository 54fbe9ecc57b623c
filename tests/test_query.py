"""Query compiler vs a plain-Python evaluator on random documents with
missing and multi-valued fields; plan checks for pushdown."""

from __future__ import annotations

import fnmatch
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, LongType, StringType, StructField, StructType,
)

from docindex.functions.analyzer import analyze
from docindex.functions.query import Q, query_column, where_query

TEXT = {"es_type": "text"}
KW = {"es_type": "keyword"}
SCHEMA = StructType([
    StructField("_id", StringType()),
    StructField("n", LongType()),
    StructField("x", DoubleType()),
    StructField("s", StringType(), True, KW),
    StructField("t", StringType(), True, TEXT),
    StructField("tags", ArrayType(StringType()), True, KW),
    StructField("obj", StructType([StructField("a", LongType()), StructField("b", StringType(), True, KW)])),
    StructField("items", ArrayType(StructType([StructField("k", StringType(), True, KW),
                                               StructField("v", LongType())]))),
])

WORDS = ["foo", "bar", "Baz", "über", "qux", "x1", "de", "the"]
KEYS = ["red", "green", "blue", "Red"]


def rand_doc(r: random.Random, i: int) -> dict:
    def maybe(v):
        return None if r.random() < 0.2 else v
    text = None if r.random() < 0.15 else (" ".join(r.choice(WORDS) + r.choice(["", ",", "!", " -"])
                                                    for _ in range(r.randint(0, 6))))
    return {
        "_id": str(i),
        "n": maybe(r.randint(-5, 5)),
        "x": maybe(round(r.uniform(-3, 3), 2)),
        "s": maybe(r.choice(KEYS)),
        "t": text,
        "tags": maybe([r.choice(KEYS) for _ in range(r.randint(0, 3))]),
        "obj": maybe({"a": maybe(r.randint(0, 3)), "b": maybe(r.choice(KEYS))}),
        "items": maybe([{"k": maybe(r.choice(KEYS)), "v": maybe(r.randint(0, 9))}
                        for _ in range(r.randint(0, 3))]),
    }


def values(doc, path):
    """All values at a dotted path (arrays flattened, missing -> [])."""
    cur = [doc]
    for part in path.split("."):
        nxt = []
        for c in cur:
            if isinstance(c, dict) and c.get(part) is not None:
                v = c[part]
                nxt.extend(x for x in (v if isinstance(v, list) else [v]) if x is not None)
        cur = nxt
    return cur


TEXT_FIELDS = {"t"}


def ev(q, doc):
    (name, p), = q.items()
    if name == "match_all":
        return True
    if name == "match_none":
        return False
    if name == "bool":
        lst = lambda k: p.get(k, []) if isinstance(p.get(k, []), list) else [p[k]]
        must = lst("must") + lst("filter")
        should = lst("should")
        ok = all(ev(c, doc) for c in must) and not any(ev(c, doc) for c in lst("must_not"))
        need = p.get("minimum_should_match", 1 if should and not must else 0)
        return ok and sum(ev(c, doc) for c in should) >= need
    if name == "dis_max":
        return any(ev(c, doc) for c in p["queries"])
    if name == "constant_score":
        return ev(p["filter"], doc)
    if name == "boosting":
        return ev(p["positive"], doc)
    if name == "multi_match":
        toks = analyze(p["query"])
        if p.get("type") == "cross_fields":
            return bool(toks) and all(any(ev({"match": {f: {"query": t}}}, doc) for f in p["fields"]) for t in toks)
        return any(ev({"match": {f: {"query": p["query"]}}}, doc) for f in p["fields"])
    if name == "nested":
        path = p["path"]
        elems = values(doc, path)
        return any(ev(_strip(p["query"], path), e) for e in elems)
    if name == "exists":
        return len(values(doc, p["field"])) > 0
    (field, spec), = p.items()
    vals = values(doc, field)
    if name == "term":
        if isinstance(spec, dict):
            want = spec["value"].lower()
            return any(v.lower() == want for v in vals)
        if field in TEXT_FIELDS:
            return any(spec in analyze(v) for v in vals)
        return any(v == spec for v in vals)
    if name == "terms":
        if field in TEXT_FIELDS:
            return any(t in spec for v in vals for t in analyze(v))
        return any(v in spec for v in vals)
    if name == "regexp":
        import re as _re
        return any(_re.fullmatch(spec, t) for v in vals
                   for t in (analyze(v) if field in TEXT_FIELDS else [v]))
    if name == "range":
        def ok(v):
            return all({"gt": v > b, "gte": v >= b, "lt": v < b, "lte": v <= b}[k] for k, b in spec.items())
        return any(ok(v) for v in vals)
    if name == "match":
        toks = analyze(spec["query"])
        op = spec.get("operator", "or")
        if field in TEXT_FIELDS:
            if not toks:
                return False
            got = [set(analyze(v)) for v in vals]
            if "minimum_should_match" in spec:
                need = spec["minimum_should_match"]
                return any(sum(t in g for t in set(toks)) >= max(need, 1) for g in got)
            return any((all if op == "and" else any)(t in g for t in toks) for g in got)
        return any(v == spec["query"] for v in vals)
    if name == "match_phrase":
        toks = analyze(spec)
        for v in vals:
            vt = analyze(v)
            if toks and any(vt[i:i + len(toks)] == toks for i in range(len(vt))):
                return True
        return False
    if name == "prefix":
        if field in TEXT_FIELDS:
            return any(t.startswith(spec) for v in vals for t in analyze(v))
        return any(v.startswith(spec) for v in vals)
    if name == "wildcard":
        if field in TEXT_FIELDS:
            return any(fnmatch.fnmatchcase(t, spec) for v in vals for t in analyze(v))
        return any(fnmatch.fnmatchcase(v, spec) for v in vals)
    raise AssertionError(name)


def _strip(q, path):
    """Inner nested query fields are relative to the element."""
    if isinstance(q, dict):
        out = {}
        for k, v in q.items():
            k2 = k[len(path) + 1:] if k.startswith(path + ".") else k
            out[k2] = _strip(v, path)
        return out
    if isinstance(q, list):
        return [_strip(x, path) for x in q]
    return q


def rand_query(r: random.Random, depth=0):
    kinds = ["term_s", "term_t", "terms", "range_n", "range_x", "exists", "match", "match_and",
             "phrase", "prefix", "wildcard", "tags", "obj", "nested", "term_ci", "terms_t",
             "prefix_t", "wildcard_t", "regexp_s", "regexp_t", "match_msm", "multi", "cross"]
    if depth < 2:
        kinds += ["dis_max", "constant", "boosting"]
    if depth < 2:
        kinds += ["bool"] * 3
    k = r.choice(kinds)
    if k == "term_s":
        return {"term": {"s": r.choice(KEYS)}}
    if k == "term_t":
        return {"term": {"t": r.choice(["foo", "baz", "Baz", "über", "x1"])}}
    if k == "terms":
        return {"terms": {"s": r.sample(KEYS, 2)}}
    if k == "range_n":
        return {"range": {"n": {r.choice(["gt", "gte"]): r.randint(-5, 5), "lt": r.randint(-2, 6)}}}
    if k == "range_x":
        return {"range": {"x": {r.choice(["lt", "lte", "gt"]): round(r.uniform(-3, 3), 1)}}}
    if k == "exists":
        return {"exists": {"field": r.choice(["n", "t", "tags", "obj.a", "items.k", "s"])}}
    if k == "match":
        return {"match": {"t": {"query": " ".join(r.sample(WORDS, 2))}}}
    if k == "match_and":
        return {"match": {"t": {"query": " ".join(r.sample(WORDS, 2)), "operator": "and"}}}
    if k == "phrase":
        return {"match_phrase": {"t": " ".join(r.sample(WORDS, 2))}}
    if k == "prefix":
        return {"prefix": {"s": r.choice(["r", "R", "gr", "b"])}}
    if k == "wildcard":
        return {"wildcard": {"s": r.choice(["r*", "?ed", "*e*", "bl?e"])}}
    if k == "tags":
        return {"term": {"tags": r.choice(KEYS)}}
    if k == "obj":
        return {"term": {"obj.b": r.choice(KEYS)}}
    if k == "term_ci":
        return {"term": {"s": {"value": r.choice(["RED", "red", "Blue"]), "case_insensitive": True}}}
    if k == "terms_t":
        return {"terms": {"t": r.sample(["foo", "bar", "über", "Baz", "x1"], 2)}}
    if k == "prefix_t":
        return {"prefix": {"t": r.choice(["f", "ba", "üb", "x"])}}
    if k == "wildcard_t":
        return {"wildcard": {"t": r.choice(["b?r", "*o*", "x*", "ü*r"])}}
    if k == "regexp_s":
        return {"regexp": {"s": r.choice(["r.d", "[bg].*", "(red|blue)", "Re."])}}
    if k == "regexp_t":
        return {"regexp": {"t": r.choice(["ba.", "f.+", "[a-z]1"])}}
    if k == "match_msm":
        return {"match": {"t": {"query": " ".join(r.sample(WORDS, 3)), "minimum_should_match": r.randint(1, 3)}}}
    if k == "multi":
        return {"multi_match": {"query": " ".join(r.sample(WORDS, 2)), "fields": ["t", "s"]}}
    if k == "cross":
        return {"multi_match": {"query": " ".join(r.sample(WORDS + KEYS, 2)), "type": "cross_fields",
                                "operator": "and", "fields": ["t", "s"]}}
    if k == "dis_max":
        return {"dis_max": {"queries": [rand_query(r, depth + 1), rand_query(r, depth + 1)]}}
    if k == "constant":
        return {"constant_score": {"filter": rand_query(r, depth + 1)}}
    if k == "boosting":
        return {"boosting": {"positive": rand_query(r, depth + 1), "negative": rand_query(r, depth + 1),
                             "negative_boost": 0.5}}
    if k == "nested":
        return {"nested": {"path": "items", "query": {"bool": {"must": [
            {"term": {"items.k": r.choice(KEYS)}}, {"range": {"items.v": {"gte": r.randint(0, 9)}}}]}}}}
    clauses = {}
    for key in r.sample(["must", "filter", "should", "must_not"], r.randint(1, 3)):
        clauses[key] = [rand_query(r, depth + 1) for _ in range(r.randint(1, 2))]
    if "should" in clauses and r.random() < 0.4:
        clauses["minimum_should_match"] = r.randint(0, len(clauses["should"]))
    return {"bool": clauses}


def test_compiler_matches_python_evaluator(spark):
    r = random.Random(7)
    docs = [rand_doc(r, i) for i in range(120)]
    df = spark.createDataFrame(docs, SCHEMA)
    queries = [rand_query(r) for _ in range(400)]
    cols = [F.coalesce(query_column(q, df.schema), F.lit(False)).alias(f"q{i}")
            for i, q in enumerate(queries)]
    rows = {row["_id"]: row for row in df.select("_id", *cols).collect()}
    bad = []
    for i, q in enumerate(queries):
        for d in docs:
            if rows[d["_id"]][f"q{i}"] != ev(q, d):
                bad.append((q, d))
    assert not bad, bad[:3]


def test_query_object_and_operators(spark):
    df = spark.createDataFrame([("1", 1), ("2", 5), ("3", None)], "_id string, n long")
    q = Q("range", n={"gte": 1}) & ~Q("term", n=5)
    assert [r._id for r in where_query(df, q).collect()] == ["1"]
    q2 = Q("term", n=1) | Q("term", n=5)
    assert sorted(r._id for r in where_query(df, q2).collect()) == ["1", "2"]
    # must_not keeps documents where the field is missing
    assert sorted(r._id for r in where_query(df, ~Q("term", n=5)).collect()) == ["1", "3"]


def test_unknown_query_rejected(spark):
    with pytest.raises(ValueError):
        query_column({"fuzzy": {"s": "x"}}, SCHEMA)
    with pytest.raises(ValueError):
        query_column({"range": {"d": {"gte": "now-1d"}}}, StructType().add("d", "timestamp"))
    with pytest.raises(TypeError):
        query_column(42, SCHEMA)


def test_positive_leaves_reach_parquet(spark):
    ev_ = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    from docindex.sources.hits import as_hits, flatten_hits
    flat = flatten_hits(as_hits(ev_, "events", "event_id"))
    df = where_query(flat, {"bool": {"filter": [{"range": {"value": {"lt": 100}}},
                                                {"term": {"event_type": "click"}}]}})
    plan = df.select("value")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(value), IsNotNull(event_type), LessThan(value,100.0), EqualTo(event_type,click)]" in plan \
        or ("LessThan(value,100.0)" in plan and "EqualTo(event_type,click)" in plan)
    assert "ReadSchema: struct<event_type:string,value:double>" in plan
