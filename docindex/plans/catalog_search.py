"""Registered queries on field resolution, pattern literals and relevance.

Part of the catalog (``docindex.plans.catalog`` imports this module last).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from docindex.functions.query import where_query
from docindex.functions.values import conform
from docindex.operators.score import search, search_nested
from docindex.plans.catalog import _docs, _docs_labeled, _docs_mapped, register
from docindex.plans.tables import index, table
from docindex.sources.json_hits import hits_from_json
from docindex.sources.mapping import mapping_to_struct
from docindex.sources.model import Date, Document, Long, ScaledFloat
from docindex.sources.schema import complete_schema

# A mapping with sub-fields, normalizers, an alias and copied fields.
PART_SEARCH_MAPPING = {
    "settings": {"analysis": {"normalizer": {"folded": {"type": "custom", "filter": ["lowercase", "asciifolding"]}}}},
    "mappings": {"properties": {
        "p_partkey": {"type": "long"},
        "p_name": {"type": "text", "copy_to": "everything", "fields": {"raw": {"type": "keyword", "ignore_above": 9}, "folded": {"type": "keyword", "normalizer": "folded"}}},
        "p_brand": {"type": "keyword", "normalizer": "folded", "copy_to": "everything"},
        "p_type": {"type": "keyword", "normalizer": "lowercase", "copy_to": "everything"},
        "title": {"type": "alias", "path": "p_name"},
        "everything": {"type": "text"},
    }},
}


def _parts(spark, sf_dir):
    return conform(index(spark, sf_dir, "part"), mapping_to_struct(PART_SEARCH_MAPPING))


@register("query_subfield")
def q_subfield(spark, sf_dir):
    """One stored name as text, as keyword (values above nine characters are
    not indexed) and as folded keyword."""
    q = {"bool": {"must": [{"match": {"p_name": "RING red"}}],
                  "should": [{"term": {"p_name.raw": "small ring"}}, {"prefix": {"p_name.raw": "red"}}, {"term": {"p_name.folded": "Blue Ríng"}}],
                  "minimum_should_match": 1}}
    return where_query(_parts(spark, sf_dir), q).select("p_partkey", "p_name")


@register("query_normalized")
def q_normalized(spark, sf_dir):
    """Values and query values go through the field's normalizer."""
    q = {"bool": {"should": [{"term": {"p_type": "Economy"}}, {"terms": {"p_brand": ["BRAND#3", "bränd#4"]}}, {"range": {"p_type": {"gte": "SMA", "lt": "SN"}}}],
                  "must_not": [{"wildcard": {"p_brand": {"value": "BRAND#1*"}}}], "minimum_should_match": 1}}
    return where_query(_parts(spark, sf_dir), q).select("p_partkey", "p_brand", "p_type")


@register("query_alias_copied")
def q_alias_copied(spark, sf_dir):
    """An alias, and a field that others are copied into (all tokens in any)."""
    q = {"bool": {"must": [{"match": {"everything": {"query": "ring promo", "operator": "and"}}}], "must_not": [{"match": {"title": "red"}}]}}
    return where_query(_parts(spark, sf_dir), q).select("p_partkey", "p_name", "p_type")


@register("query_null_value")
def q_null_value(spark, sf_dir):
    """A missing value searched by the value that stands for it."""
    schema = mapping_to_struct({"doc_id": {"type": "long"}, "quality": {"type": "integer", "null_value": -1}, "toxic": {"type": "integer"}})
    q = {"bool": {"filter": [{"range": {"quality": {"lt": 1}}}, {"exists": {"field": "quality"}}], "must_not": [{"term": {"toxic": 1}}]}}
    return where_query(conform(_docs_labeled(spark, sf_dir), schema), q).select("doc_id", "quality")


@register("query_phrase_prefix")
def q_phrase_prefix(spark, sf_dir):
    """A phrase whose last token may go on."""
    return where_query(_docs_mapped(spark, sf_dir), {"match_phrase_prefix": {"text": "of th"}}).select("doc_id")


@register("query_range_format")
def q_range_format(spark, sf_dir):
    """Bounds of a date range in a format of the query's own."""
    q = {"range": {"o_orderdate": {"gte": "19950301", "lt": "19960301", "format": "basic_date"}}}
    return where_query(index(spark, sf_dir, "orders"), q).select("o_orderkey")


def _scores(df):
    return df.select("doc_id", F.round("_score", 4).alias("_score"))


@register("score_phrase")
def q_score_phrase(spark, sf_dir):
    """A phrase by its own frequency, beside one of its words."""
    q = {"bool": {"must": [{"match_phrase": {"text": "of the"}}], "should": [{"match": {"text": "the"}}]}}
    return _scores(search(_docs_mapped(spark, sf_dir), q, track_scores=True))


@register("score_nested")
def q_score_nested(spark, sf_dir):
    """Lines of a text as nested objects: each is scored as a document."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("text")))
    docs = _docs(spark, sf_dir).select("doc_id", lines.alias("lines"))
    q = {"nested": {"path": "lines", "query": {"match": {"lines.text": "the und"}}, "score_mode": "avg"}}
    return _scores(search(docs, q, track_scores=True))


@register("score_nested_table")
def q_score_nested_table(spark, sf_dir):
    """Nested objects kept as a child table: the best turn of a conversation."""
    turns = table(spark, sf_dir, "conversations")
    chats = turns.select("conv_id").distinct()
    q = {"bool": {"must": [{"match": {"turns.text": "the und de"}}], "should": [{"term": {"turns.role": "user"}}]}}
    got = search_nested(chats, turns, "conv_id", "conv_id", "turns", q, score_mode="max")
    return got.select("conv_id", F.round("_score", 4).alias("_score"))


@register("score_nested_lines")
def q_score_nested_lines(spark, sf_dir):
    """Scores of an order's lines added up: keyword term and constant clauses."""
    q = {"bool": {"must": [{"term": {"lines.l_returnflag": {"value": "R"}}}], "should": [{"range": {"lines.l_quantity": {"gte": 40}}}]}}
    got = search_nested(index(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey", "lines", q, score_mode="sum")
    return got.select("o_orderkey", F.round("_score", 4).alias("_score"))


@register("score_cross_fields")
def q_score_cross_fields(spark, sf_dir):
    """Terms found in several fields share one document frequency."""
    schema = complete_schema(mapping_to_struct({"doc_id": {"type": "long"}, "text": {"type": "text"}, "lang": {"type": "text"}}), meta_fields=["id"])
    q = {"multi_match": {"query": "de und", "type": "cross_fields", "fields": ["text", "lang^2"]}}
    return _scores(search(conform(_docs(spark, sf_dir), schema), q, track_scores=True))


@register("score_nested_bool")
def q_score_nested_bool(spark, sf_dir):
    """A bool query inside another scores only where it matches as a whole."""
    q = {"bool": {"should": [{"bool": {"must": [{"match": {"text": "the"}}, {"match": {"text": {"query": "of and", "operator": "and"}}}], "must_not": [{"match": {"text": "with"}}]}},
                             {"match": {"text": "und"}}, {"term": {"lang": {"value": "es"}}}]}}
    return _scores(search(_docs_mapped(spark, sf_dir), q, track_scores=True))


@register("score_boost")
def q_score_boost(spark, sf_dir):
    """Boosts of clauses; ``term`` on a keyword in both of its spellings."""
    q = {"bool": {"should": [{"match": {"text": {"query": "the", "boost": 2.5}}}, {"term": {"lang": {"value": "de", "boost": 3}}}, {"term": {"lang": "en"}},
                             {"match": {"lang": "fr"}}, {"constant_score": {"filter": {"range": {"n_chars": {"lt": 1000}}}, "boost": 0.5}}]}}
    return _scores(search(_docs_mapped(spark, sf_dir), q, track_scores=True))


@register("score_missing_field")
def q_score_missing_field(spark, sf_dir):
    """Documents without the field count neither in N nor in the mean length."""
    docs = _docs_mapped(spark, sf_dir)
    docs = docs.withColumn("text", F.when(F.col("n_chars") >= 1000, F.col("text")))
    return _scores(search(docs, {"match": {"text": "the und"}}, track_scores=True))


# ---------------------------------------------------------------------------
# Paging, chunks, several indices, declared formats
# ---------------------------------------------------------------------------

@register("paged_scan")
def q_paged_scan(spark, sf_dir):
    """All page boundaries of a deep scan, sorted by a field with many ties."""
    from docindex.sources.paging import pages
    ev = index(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    got = pages(ev, [("event_type", "desc"), "user_id"], 250, id_col="event_id")
    key = ("event_type", "user_id", "event_id")
    return got.select("page", "rows", *[F.col(f"{end}.{c}").alias(f"{end}_{c}") for end in ("first", "last") for c in key])


@register("bulk_chunks")
def q_bulk_chunks(spark, sf_dir):
    """Bulk lines in requests of at most 100 actions and 20,000 bytes; a stream
    is what a task of 500 documents sends."""
    from docindex.operators.bulk import action_lines, bulk_actions
    from docindex.operators.chunks import chunks
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_id"), "lang", "source", "n_chars", "text")
    lines = action_lines(bulk_actions(docs, index="copy", op_type="index"))
    sized = lines.select(F.expr("cast(_id as bigint) div 500").alias("stream"), F.col("_id").cast("long").alias("doc_id"),
                         (F.octet_length("header") + F.octet_length("body") + 2).cast("long").alias("size"))
    got = chunks(sized, "stream", ["doc_id"], "size", max_rows=100, max_bytes=20_000)
    return got.groupBy("stream", "chunk").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


@register("all_indices_mapping")
def q_all_indices_mapping(spark, sf_dir):
    """Three indices under one schema: a widened number, one value beside a
    list, and a field without a common type (kept as it is, in a VARIANT)."""
    from docindex.sources.merge import union_indices
    orders = index(spark, sf_dir, "orders").select("_id", F.col("o_custkey").cast("int").alias("key"), F.col("o_totalprice").alias("amount"), F.array("o_orderstatus", "o_orderpriority").alias("tags"))
    customers = index(spark, sf_dir, "customer").select("_id", F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("amount"), F.col("c_mktsegment").alias("tags"), F.col("c_name").alias("mixed"))
    events = index(spark, sf_dir, "events").select("_id", F.col("user_id").alias("key"), F.col("value").cast("float").alias("amount"), F.col("event_id").alias("mixed"))
    got = union_indices({"orders": orders, "customer": customers, "events": events})
    mixed = F.coalesce(F.try_variant_get("mixed", "$", "string"), F.lit("none"))
    return got.groupBy("_index").agg(F.count(F.lit(1)).alias("n"), F.sum("key").alias("keys"), F.round(F.sum(F.round("amount", 2)), 1).alias("amount"),
                                     F.sum(F.coalesce(F.size("tags"), F.lit(0))).cast("long").alias("tags"), F.max(mixed).alias("mixed"))


class OrderDoc(Document):
    o_orderkey = Long(required=True)
    o_orderdate = Date(format="basic_date")
    o_week = Date(format="basic_week_date||strict_date", multi=True)
    o_totalprice = ScaledFloat(scaling_factor=100)

    class Index:
        name = "orders"


@register("model_date_format")
def q_model_date_format(spark, sf_dir):
    """Dates in the format that the declared field names, also in lists."""
    import warnings

    from docindex.sources.model import model_to_struct
    day = F.col("o_orderdate")
    wire = index(spark, sf_dir, "orders").select(
        "_id", "o_orderkey", F.date_format(day, "yyyyMMdd").alias("o_orderdate"),
        F.array(F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("W"), F.lpad(F.extract(F.lit("WEEK"), day).cast("string"), 2, "0"), F.extract(F.lit("DAYOFWEEK_ISO"), day).cast("string")),
                F.date_format(day, "yyyy-MM-dd")).alias("o_week"), "o_totalprice")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        schema = model_to_struct(OrderDoc, meta_fields=["id"])
    text = lambda c: F.date_format(c, "yyyy-MM-dd")
    return conform(wire, schema).select("o_orderkey", text(F.col("o_orderdate")).alias("o_orderdate"), F.array_join(F.transform("o_week", text), ",").alias("o_week"),
                                        F.round("o_totalprice", 2).alias("o_totalprice"), "_id")


@register("types_nested_list")
def q_types_nested_list(spark, sf_dir):
    """Lists of objects in JSON hits, some of them a lone object or missing."""
    schema = complete_schema(mapping_to_struct({"event_id": {"type": "long"}, "tags": {"type": "nested", "properties": {"kind": {"type": "keyword"}, "weight": {"type": "double"}}}}), meta_fields=["id"])
    e = "named_struct('kind', event_type, 'weight', value)"
    tags = F.expr(f"""CASE WHEN event_id % 3 = 0 THEN to_json(array({e}, named_struct('kind', 'user', 'weight', cast(user_id as double))))
                           WHEN event_id % 3 = 1 THEN to_json({e}) END""")
    body = F.concat(F.lit('{"_id":"'), F.col("_id"), F.lit('","_source":{"event_id":'), F.col("event_id").cast("string"),
                    F.when(tags.isNotNull(), F.concat(F.lit(',"tags":'), tags)).otherwise(F.lit("")), F.lit("}}"))
    flat = hits_from_json(index(spark, sf_dir, "events").select(body.alias("hit")), "hit", schema)
    total = F.aggregate(F.coalesce("tags", F.array().cast("array<struct<kind:string,weight:double>>")), F.lit(0.0), lambda a, x: a + x.weight)
    return flat.select("event_id", "_id", F.coalesce(F.size("tags"), F.lit(0)).alias("n_tags"), F.get("tags", F.lit(0)).kind.alias("first_kind"), F.round(total, 2).alias("weight"))


@register("sliced_scan_pruned")
def q_sliced_scan_pruned(spark, sf_dir):
    """Two of seven slices, each read from its own files."""
    from docindex.sources.slices import read_slices, write_slices
    ev = index(spark, sf_dir, "events").select("_id", "event_id", "event_type", F.round("value", 2).alias("value"))
    name = write_slices(ev, 7, by=F.expr("pmod(event_id, 7)"))
    return read_slices(spark, name, [2, 5]).select("_id", "event_id", "event_type", "value")


@register("index_bounds")
def q_index_bounds(spark, sf_dir):
    """Rows, and bounds of numbers and days, from file footers."""
    from docindex.sources.stats import column_bounds
    return column_bounds(spark, f"{sf_dir.rstrip('/')}/orders.parquet", ["o_orderkey", "o_custkey"])
