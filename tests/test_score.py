"""search(): null scores by default, BM25 composition on request."""

from pyspark.sql import functions as F

from docindex.operators.score import search
from docindex.sources.mapping import mapping_to_struct
from docindex.functions.values import conform


def _docs(spark):
    df = spark.createDataFrame([("1", "red fox", "a"), ("2", "red red dog", "b"), ("3", "cat", "a")],
                               "_id string, t string, k string")
    return conform(df, mapping_to_struct({"_id": {"type": "keyword"}, "t": {"type": "text"},
                                          "k": {"type": "keyword"}}))


def test_scores_null_without_tracking(spark):
    got = search(_docs(spark), {"match": {"t": "red"}}).collect()
    assert sorted(r._id for r in got) == ["1", "2"] and all(r._score is None for r in got)


def test_constant_and_boosting(spark):
    d = _docs(spark)
    cs = {r._id: r._score for r in search(d, {"constant_score": {"filter": {"term": {"k": "a"}}, "boost": 2.5}},
                                         track_scores=True).collect()}
    assert cs == {"1": 2.5, "3": 2.5}
    q = {"boosting": {"positive": {"match": {"t": "red"}}, "negative": {"term": {"k": "b"}},
                      "negative_boost": 0.5}}
    plain = {r._id: r._score for r in search(d, {"match": {"t": "red"}}, track_scores=True).collect()}
    boosted = {r._id: r._score for r in search(d, q, track_scores=True).collect()}
    assert abs(boosted["2"] - plain["2"] * 0.5) < 1e-12 and abs(boosted["1"] - plain["1"]) < 1e-12


def test_more_occurrences_score_higher(spark):
    got = {r._id: r._score for r in search(_docs(spark), {"match": {"t": "red"}}, track_scores=True)
           .select("_id", F.col("_score")).collect()}
    assert got["2"] > got["1"] > 0


def test_scoring_does_not_shuffle_documents(spark):
    from docindex.plans.catalog import _docs_mapped
    out = search(_docs_mapped(spark, "/root/testdata/sf0.001"),
                 {"bool": {"must": [{"match": {"text": "the"}}], "should": [{"term": {"lang": "de"}}]}},
                 track_scores=True)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_boosts_inner_bool_and_default_fields(spark):
    from docindex.operators.score import search
    rows = [("1", "alpha"), ("2", "alpha beta"), ("3", "gamma"), ("4", None)]
    df = spark.createDataFrame(rows, "_id string, text string")
    score = lambda q: {r._id: r._score for r in search(df, q, track_scores=True).collect()}
    plain = score({"match": {"text": {"query": "alpha"}}})
    assert {i: round(s / plain[i], 6) for i, s in score({"match": {"text": {"query": "alpha", "boost": 10}}}).items()} == {"1": 10, "2": 10}
    assert {i: round(s / plain[i], 6) for i, s in score({"multi_match": {"query": "alpha", "fields": ["text^5"]}}).items()} == {"1": 5, "2": 5}
    both = score({"bool": {"should": [{"bool": {"must": [{"match": {"text": "alpha"}}, {"match": {"text": "beta"}}]}}, {"match_all": {}}]}})
    assert both["1"] == 1.0 and both["2"] > 1.0 and both["3"] == 1.0


def test_one_text_pass_a_field(spark):
    """Several tests of a text read it once; the scoring pass, too."""
    from docindex.functions.query import where_query
    from docindex.plans.catalog import _docs_mapped
    docs = _docs_mapped(spark, "/root/testdata/sf0.001")
    passes = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("lower(")
    q = {"bool": {"should": [{"match": {"text": w}} for w in ("und", "der", "die")], "minimum_should_match": 2, "filter": [{"range": {"n_chars": {"gte": 10}}}]}}
    got = where_query(docs, q)
    assert passes(got) == 1 and got.columns == docs.columns
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(n_chars,10)" in text and "inline" in text
    # scored documents: lowered for the filter, marked where they match
    assert passes(search(docs, {"bool": {"must": [{"match": {"text": "the und"}}], "should": [{"match_phrase": {"text": "of the"}}]}}, True)) == 2


def _score_of(df, q, **kw):
    return {r._id: r._score for r in search(df, q, track_scores=True, **kw).collect()}


def test_keyword_terms_score_alike(spark):
    d = _docs(spark)
    a, b, c = (_score_of(d, q) for q in ({"term": {"k": "a"}}, {"term": {"k": {"value": "a"}}}, {"match": {"k": "a"}}))
    assert a == b == c and set(a) == {"1", "3"} and 0 < a["1"] < 1
    n = spark.createDataFrame([("1", 5), ("2", 6)], "_id string, n int")
    assert _score_of(n, {"term": {"n": 5}}) == {"1": 1.0} == _score_of(n, {"term": {"n": {"value": 5}}})


def test_phrase_counts_its_own_frequency(spark):
    df = spark.createDataFrame([("1", "red fox red fox"), ("2", "red fox fox red"), ("3", "red x fox"), ("4", "a a a")], "_id string, t string")
    got = _score_of(df, {"match_phrase": {"t": "red fox"}})
    assert set(got) == {"1", "2"} and got["1"] > got["2"]
    # overlapping occurrences count: "a a" stands twice in "a a a"
    twice, avgdl = _score_of(df, {"match_phrase": {"t": "a a"}})["4"], (4 + 4 + 3 + 3) / 4
    from docindex.operators.score import idf
    assert abs(twice - 2 * idf(4, 1) * 2 / (2 + 1.2 * (0.25 + 0.75 * 3 / avgdl))) < 1e-12


def test_nested_score_modes(spark):
    rows = [("1", [("red", 1), ("red red", 5)]), ("2", [("blue", 1)]), ("3", None), ("4", [])]
    df = spark.createDataFrame(rows, "_id string, kids array<struct<t:string,n:int>>")
    q = lambda mode: {"nested": {"path": "kids", "query": {"match": {"kids.t": "red"}}, "score_mode": mode}}
    low, high, mean, total = (_score_of(df, q(m))["1"] for m in ("min", "max", "avg", "sum"))
    assert set(_score_of(df, q("avg"))) == {"1"} and 0 < low < high
    assert abs(mean - (low + high) / 2) < 1e-12 and abs(total - low - high) < 1e-12
    assert _score_of(df, q("none")) == {"1": 0.0}
    both = {"bool": {"must": [q("max")], "should": [{"term": {"_id": "1"}}]}}
    assert _score_of(df, both)["1"] > high


def test_checkpointed_scores_are_the_same(spark):
    q = {"match": {"t": "red dog"}}
    assert _score_of(_docs(spark), q) == _score_of(_docs(spark), q, checkpoint=True)
