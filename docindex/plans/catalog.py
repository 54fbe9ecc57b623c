"""Registered queries: one per inventory item, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (wrapped as indices) over their whole
extent.  The matching DuckDB SQL lives in ``docindex.plans.oracle``.
Timestamps are returned as epoch microseconds and doubles rounded, so that
results compare exactly.
"""

from __future__ import annotations

import dataclasses
import warnings
from collections.abc import Callable
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docindex.functions.query import Q, query_column, where_query
from docindex.functions.values import conform, epoch_millis, ntz_micros, parse_date, parse_timestamp
from docindex.operators.bulk import action_lines, apply_bulk, bulk_actions
from docindex.operators.nested import where_nested
from docindex.operators.score import bm25
from docindex.operators.transform import map_document_batches, map_documents
from docindex.plans.tables import hits, index, table
from docindex.session import scratch_path
from docindex.sources.hits import as_hits, flatten_hits, nest_hits, slice_column
from docindex.sources.json_hits import hits_from_json, hits_to_json, read_hits_json, write_hits_json
from docindex.sources.mapping import mapping_to_struct
from docindex.sources.model import Document, Double, Integer, Keyword, Long, Text, model_to_struct
from docindex.sources.schema import as_struct, complete_schema
from docindex.sources.store import read_index, write_bulk, write_index

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _sum_count(df: DataFrame, col: str = "value") -> DataFrame:
    return df.agg(F.round(F.sum(col), 2).alias("sum_value"), F.count(F.lit(1)).alias("n"))


def _us(c: str, ntz: bool = True):
    """Epoch microseconds; zone-less timestamps read as UTC (session-zone free)."""
    return ntz_micros(F.col(c)) if ntz else F.unix_micros(F.col(c))


# ---------------------------------------------------------------------------
# Scans and sources
# ---------------------------------------------------------------------------

@register("scan_sum")
def scan_sum(spark, sf_dir):
    """Full scan of an index, sum of one field (the read example)."""
    return _sum_count(index(spark, sf_dir, "events"))


@register("flatten_hits")
def q_flatten_hits(spark, sf_dir):
    """Hits flattened: metadata columns next to the source fields."""
    flat = index(spark, sf_dir, "events")
    return flat.select("_index", "_type", "_id", "_version", "_seq_no", "_primary_term", "_score",
                       "event_id", _us("ts").alias("ts_us"), "user_id", "event_type",
                       F.round("value", 2).alias("value"), "props")


@register("nest_hits")
def q_nest_hits(spark, sf_dir):
    """Flat rows back into ``{metadata, _source}``."""
    nested = nest_hits(index(spark, sf_dir, "events"))
    s = F.col("_source")
    return nested.select("_index", "_type", "_id", "_version", "_primary_term", s.event_id.alias("event_id"), ntz_micros(s.ts).alias("ts_us"), s.user_id.alias("user_id"),
                         s.event_type.alias("event_type"), F.round(s.value, 2).alias("value"), s.props.alias("props"))


@register("meta_columns")
def q_meta_columns(spark, sf_dir):
    """The seven metadata columns (sequence numbers from the event id)."""
    h = hits(spark, sf_dir, "events", seq_col="event_id")
    return h.select("_index", "_type", "_id", "_version", "_seq_no", "_primary_term", "_score")


@register("source_fields_select")
def q_source_fields(spark, sf_dir):
    """``source_fields=[value, event_type]``, ``meta_fields=[id]``."""
    flat = flatten_hits(hits(spark, sf_dir, "events"), source_fields=["value", "event_type"],
                        meta_fields=["id"])
    return flat.select("_id", F.round("value", 2).alias("value"), "event_type")


@register("meta_fields_select")
def q_meta_fields(spark, sf_dir):
    """Only metadata, names with or without ``_``; unknown names ignored."""
    return flatten_hits(hits(spark, sf_dir, "part"), source_fields=[],
                        meta_fields=["index", "_id", "version", "no_such_field"])


# The mapping used for the events index.
EVENTS_MAPPING = {
    "properties": {
        "event_id": {"type": "long"},
        "ts": {"type": "date"},
        "user_id": {"type": "long"},
        "event_type": {"type": "keyword"},
        "value": {"type": "double"},
        "props": {"type": "text"},
    }
}


@register("schema_completion")
def q_schema_completion(spark, sf_dir):
    """Mapping schema completed with selected source and metadata fields."""
    schema = complete_schema(mapping_to_struct(EVENTS_MAPPING),
                             source_fields=["value", "event_type", "no_such_field"],
                             meta_fields=["id", "score"])
    df = conform(index(spark, sf_dir, "events"), schema)
    return df.select("event_type", F.round("value", 2).alias("value"), "_id", "_score")


@register("explicit_schema_read")
def q_explicit_schema(spark, sf_dir):
    """A user schema is used verbatim: casts, absent fields null, no metadata."""
    schema = as_struct("o_orderkey INT NOT NULL, o_totalprice FLOAT, o_orderstatus STRING, "
                       "o_clerk STRING")
    df = conform(index(spark, sf_dir, "orders"), schema)
    return df.select("o_orderkey", F.round(F.col("o_totalprice").cast("double"), 2).alias("o_totalprice"),
                     "o_orderstatus", "o_clerk")


# The mapping used for the part index.
PART_MAPPING = {
    "part": {
        "mappings": {
            "properties": {
                "p_partkey": {"type": "long"},
                "p_name": {"type": "text"},
                "p_brand": {"type": "keyword"},
                "p_type": {"type": "keyword"},
                "p_size": {"type": "short"},
                "p_retailprice": {"type": "scaled_float", "scaling_factor": 100},
            }
        }
    }
}


@register("mapping_schema_read")
def q_mapping_schema(spark, sf_dir):
    """Schema from an index mapping (get-mapping response form)."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        schema = complete_schema(mapping_to_struct(PART_MAPPING, index="part"))
    df = conform(index(spark, sf_dir, "part"), schema)
    return df.select("p_partkey", "p_name", "p_brand", "p_type", F.col("p_size").cast("int").alias("p_size"),
                     F.round("p_retailprice", 2).alias("p_retailprice"), "_index", "_id", "_version")


class PartDoc(Document):
    p_partkey = Long(required=True)
    p_name = Text()
    p_brand = Keyword()
    p_size = Integer()
    p_retailprice = Double()

    class Index:
        name = "part"


@register("model_schema_read")
def q_model_schema(spark, sf_dir):
    """Schema and index name from a declared document class."""
    schema = model_to_struct(PartDoc, source_fields=["p_partkey", "p_name", "p_size"])
    df = conform(index(spark, sf_dir, PartDoc.index_name()), schema)
    return df.select("p_partkey", "p_name", "p_size", "_index", "_id")


@dataclasses.dataclass
class CustomerDoc:
    c_custkey: int
    c_name: str
    c_acctbal: Optional[float]
    c_mktsegment: Optional[str]
    c_phone: Optional[str]


@register("typed_model_schema_read")
def q_typed_model(spark, sf_dir):
    """Schema from a type-annotated model; missing fields are null."""
    schema = model_to_struct(CustomerDoc, meta_fields=["id"])
    df = conform(index(spark, sf_dir, "customer"), schema)
    return df.select("c_custkey", "c_name", F.round("c_acctbal", 2).alias("c_acctbal"),
                     "c_mktsegment", "c_phone", "_id")


@register("count_query")
def q_count(spark, sf_dir):
    """Number of documents matching a query."""
    ev = index(spark, sf_dir, "events")
    return where_query(ev, {"term": {"event_type": "click"}}).agg(F.count(F.lit(1)).alias("n"))


@register("sliced_scan")
def q_sliced(spark, sf_dir):
    """Seven disjoint slices of one snapshot; together they are the whole."""
    ev = index(spark, sf_dir, "events")
    per = ev.groupBy(slice_column(7).alias("slice")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("s"),
        F.count_distinct("_id").alias("d"))
    return per.agg(F.count(F.lit(1)).alias("n_slices"), F.sum("n").alias("total_rows"),
                   F.sum("s").alias("id_sum"), F.sum("d").alias("distinct_ids"))


@register("all_indices_scan")
def q_all_indices(spark, sf_dir):
    """Several indices read together, told apart by ``_index``."""
    both = index(spark, sf_dir, "orders").unionByName(index(spark, sf_dir, "customer"),
                                                      allowMissingColumns=True)
    return both.groupBy("_index").agg(F.count(F.lit(1)).alias("n"),
                                      F.count_distinct("_id").alias("ids"))


@register("snapshot_read")
def q_snapshot(spark, sf_dir):
    """A read pinned to version 1 is unchanged by a later write (version 2)."""
    root = scratch_path(spark, "snapshot")
    write_index(index(spark, sf_dir, "events"), root)
    errors = index(spark, sf_dir, "events").where(F.col("event_type") == "error")
    write_bulk(errors.select("_id"), root, index="events", op_type="delete")
    v1 = read_index(spark, root, "events", version=1)
    v2 = read_index(spark, root, "events", version=2)
    return (_sum_count(v1).withColumn("version", F.lit(1))
            .unionByName(_sum_count(v2).withColumn("version", F.lit(2))))


@register("size_estimate")
def q_size(spark, sf_dir):
    """Stored bytes of an index: sum of its distinct file sizes."""
    from docindex.sources.stats import size_estimate
    return size_estimate(table(spark, sf_dir, "events"))


# ---------------------------------------------------------------------------
# Queries (search DSL compiled to Catalyst)
# ---------------------------------------------------------------------------

@register("query_range")
def query_range(spark, sf_dir):
    """Range query (numbers), then sum."""
    ev = index(spark, sf_dir, "events")
    return _sum_count(where_query(ev, {"range": {"value": {"lt": 100}}}))


@register("query_range_date")
def q_range_date(spark, sf_dir):
    """Range query on dates given as text."""
    li = index(spark, sf_dir, "lineitem")
    got = where_query(li, {"range": {"l_shipdate": {"gte": "1995-01-01", "lt": "1996-01-01"}}})
    return _sum_count(got, "l_quantity")


def _docs(spark, sf_dir):
    return index(spark, sf_dir, "documents")


@register("query_match")
def q_match(spark, sf_dir):
    return where_query(_docs(spark, sf_dir), {"match": {"text": "the und"}}).select("doc_id", "lang")


@register("query_match_and")
def q_match_and(spark, sf_dir):
    q = {"match": {"text": {"query": "The, and!", "operator": "and"}}}
    return where_query(_docs(spark, sf_dir), q).select("doc_id", "lang")


@register("query_match_phrase")
def q_match_phrase(spark, sf_dir):
    return where_query(_docs(spark, sf_dir), {"match_phrase": {"text": "of the"}}).select("doc_id")


@register("query_multi_match")
def q_multi_match(spark, sf_dir):
    q = {"multi_match": {"query": "und EN", "fields": ["text", "lang^2"]}}
    return where_query(_docs(spark, sf_dir), q).select("doc_id", "lang")


def _docs_labeled(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return flatten_hits(as_hits(docs, "documents", "doc_id"))


@register("query_exists")
def q_exists(spark, sf_dir):
    return where_query(_docs_labeled(spark, sf_dir), {"exists": {"field": "quality"}}).select("doc_id")


@register("query_must_not")
def q_must_not(spark, sf_dir):
    q = {"bool": {"must_not": [{"term": {"toxic": 1}}]}}
    return where_query(_docs_labeled(spark, sf_dir), q).select("doc_id")


@register("query_bool")
def q_bool(spark, sf_dir):
    q = {"bool": {
        "must": [{"match": {"text": "the"}}],
        "filter": [{"range": {"n_chars": {"gte": 1000}}}],
        "should": [{"term": {"lang": "en"}}, {"term": {"lang": "de"}}],
        "minimum_should_match": 1,
        "must_not": [{"term": {"quality": 0}}],
    }}
    return where_query(_docs_labeled(spark, sf_dir), q).select("doc_id")


@register("query_min_should")
def q_min_should(spark, sf_dir):
    q = {"bool": {"should": [{"match": {"text": "und"}}, {"match": {"text": "der"}},
                             {"match": {"text": "die"}}, {"term": {"lang": "de"}}],
                  "minimum_should_match": 2}}
    return where_query(_docs(spark, sf_dir), q).select("doc_id")


@register("query_term")
def q_term(spark, sf_dir):
    q = {"bool": {"should": [{"term": {"p_brand": "Brand#13"}},
                             {"term": {"p_type": {"value": "promo", "case_insensitive": True}}}]}}
    return where_query(index(spark, sf_dir, "part"), q).select("p_partkey")


@register("query_terms")
def q_terms(spark, sf_dir):
    q = {"terms": {"c_mktsegment": ["BUILDING", "MACHINERY"]}}
    return where_query(index(spark, sf_dir, "customer"), q).select("c_custkey")


@register("query_ids")
def q_ids(spark, sf_dir):
    q = {"ids": {"values": ["1", "5", "17", "150", "1000", "99999999"]}}
    return where_query(index(spark, sf_dir, "part"), q).select("_id", "p_partkey")


@register("query_prefix")
def q_prefix(spark, sf_dir):
    return where_query(index(spark, sf_dir, "part"), {"prefix": {"p_name": "hot"}}).select("p_partkey")


@register("query_wildcard")
def q_wildcard(spark, sf_dir):
    q = {"wildcard": {"p_name": {"value": "r*d *"}}}
    return where_query(index(spark, sf_dir, "part"), q).select("p_partkey", "p_name")


@register("query_regexp")
def q_regexp(spark, sf_dir):
    q = {"regexp": {"p_brand": {"value": "Brand\\#1[0-9]"}}}
    return where_query(index(spark, sf_dir, "part"), q).select("p_partkey")


@register("query_nested")
def q_nested(spark, sf_dir):
    """Orders having a line with quantity >= 49 and return flag R."""
    inner = {"bool": {"must": [{"range": {"lines.l_quantity": {"gte": 49}}},
                               {"term": {"lines.l_returnflag": "R"}}]}}
    got = where_nested(index(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"),
                       "o_orderkey", "l_orderkey", "lines", inner)
    return got.select("o_orderkey")


def _customers_with_address(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.struct(F.col("n_name").alias("nation"),
                                F.col("r_name").alias("region")).alias("address"))
    cust = table(spark, sf_dir, "customer").join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    return flatten_hits(as_hits(cust.drop("n_nationkey"), "customer", "c_custkey"))


@register("query_dotted_path")
def q_dotted(spark, sf_dir):
    """Dotted field path into an object field."""
    q = {"bool": {"filter": [{"term": {"address.region": "ASIA"}},
                             {"range": {"c_acctbal": {"gt": 0}}}]}}
    return where_query(_customers_with_address(spark, sf_dir), q).select("c_custkey")


@register("query_multi_valued")
def q_multi_valued(spark, sf_dir):
    """A leaf on a multi-valued field matches if any value matches."""
    q = {"range": {"embedding": {"gt": 0.25}}}
    return where_query(index(spark, sf_dir, "embeddings"), q).select("vec_id", "label")


@register("query_constant_score")
def q_constant(spark, sf_dir):
    q = {"constant_score": {"filter": {"range": {"p_size": {"gte": 40}}}}}
    return where_query(index(spark, sf_dir, "part"), q).select("p_partkey")


@register("query_match_all")
def q_match_all(spark, sf_dir):
    part = index(spark, sf_dir, "part")
    everything = query_column({"match_all": {}}, part.schema)
    nothing = query_column({"match_none": {}}, part.schema)
    return part.agg(F.count_if(everything).alias("n"), F.count_if(nothing).alias("n_none"))


@register("query_object")
def q_object(spark, sf_dir):
    """A query object (anything with ``to_dict()``) combined with & and ~."""
    q = Q("range", p_retailprice={"lt": 1000}) & ~Q("term", p_brand="Brand#1")
    return where_query(index(spark, sf_dir, "part"), q).select("p_partkey")


@register("example_query_sum")
def q_example_query_sum(spark, sf_dir):
    """Write ``value`` documents (ids from a table), read back with
    ``range value < 100`` and sum (4950 when the ids are 0..9999)."""
    root = _value_store(spark, sf_dir)
    return where_query(read_index(spark, root, "test"), {"range": {"value": {"lt": 100}}}) \
        .agg(F.sum("value").alias("sum_value"), F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# Relevance
# ---------------------------------------------------------------------------

@register("score_bm25")
def q_bm25(spark, sf_dir):
    scored = bm25(_docs(spark, sf_dir), "text", "the und", keep=["doc_id"])
    return scored.select("doc_id", F.round("_score", 4).alias("_score"))


# ---------------------------------------------------------------------------
# Bulk writes (applied as relational upserts)
# ---------------------------------------------------------------------------

def _doc_state(df: DataFrame) -> DataFrame:
    cols = ["_id", "_version"]
    for c in ("lang", "source", "n_chars", "quality", "toxic"):
        if c in df.columns:
            cols.append(c)
    text = F.col("text") if "text" in df.columns else F.lit(None).cast("string")
    return df.select(*cols, text.isNotNull().alias("has_text"), F.sha2(text, 256).alias("text_sha256"))


@register("bulk_actions")
def q_bulk_actions(spark, sf_dir):
    """Rows shaped into bulk request lines, op chosen per row."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("_id"),
        F.when(F.col("lang") == "de", "update").when(F.col("lang") == "fr", "delete")
         .otherwise("index").alias("_op_type"), "lang", "source", "n_chars")
    return action_lines(bulk_actions(docs, index="documents"))


@register("bulk_index")
def q_bulk_index(spark, sf_dir):
    """op index: German documents replaced by a smaller document."""
    cur = index(spark, sf_dir, "documents")
    acts = cur.where(F.col("lang") == "de").select("_id", "lang", F.lit("reindexed").alias("source"))
    return _doc_state(apply_bulk(cur, bulk_actions(acts, op_type="index")))


@register("bulk_default")
def q_bulk_default(spark, sf_dir):
    """op unset: behaves as index."""
    cur = index(spark, sf_dir, "documents")
    acts = cur.where(F.col("lang") == "es").select("_id", "lang", F.lit("default").alias("source"))
    return _doc_state(apply_bulk(cur, bulk_actions(acts)))


@register("bulk_create")
def q_bulk_create(spark, sf_dir):
    """op create: benchmark passages added as new documents."""
    cur = index(spark, sf_dir, "documents")
    bench = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("_id"), "text",
        F.lit("bench").alias("lang"), F.lit("benchmark").alias("source"))
    return _doc_state(apply_bulk(cur, bulk_actions(bench, op_type="create")))


@register("bulk_update")
def q_bulk_update(spark, sf_dir):
    """op update: labels added to the labeled documents as new fields."""
    cur = index(spark, sf_dir, "documents")
    acts = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("_id"),
                                                 "quality", "toxic")
    return _doc_state(apply_bulk(cur, bulk_actions(acts, op_type="update")))


@register("bulk_delete")
def q_bulk_delete(spark, sf_dir):
    """op delete: documents labeled toxic removed."""
    cur = index(spark, sf_dir, "documents")
    acts = table(spark, sf_dir, "labels").where(F.col("toxic") == 1).select(
        F.col("doc_id").cast("string").alias("_id"))
    return _doc_state(apply_bulk(cur, bulk_actions(acts, op_type="delete")))


@register("bulk_mixed")
def q_bulk_mixed(spark, sf_dir):
    """Mixed ops in one table, ordered: reindex French, label, delete toxic,
    create benchmark passages.  A document can get several actions."""
    cur = index(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    step = F.col("_step")
    reidx = cur.where(F.col("lang") == "fr").select(
        "_id", F.lit("index").alias("_op_type"), F.lit(1).alias("_step"),
        "lang", F.lit("fr-reindexed").alias("source"), "n_chars", "text",
        F.lit(None).cast("int").alias("quality"))
    upd = labels.select(F.col("doc_id").cast("string").alias("_id"), F.lit("update").alias("_op_type"),
                        F.lit(2).alias("_step"), "quality")
    dele = labels.where(F.col("toxic") == 1).select(
        F.col("doc_id").cast("string").alias("_id"), F.lit("delete").alias("_op_type"),
        F.lit(3).alias("_step"))
    create = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("_id"),
        F.lit("create").alias("_op_type"), F.lit(4).alias("_step"), "text",
        F.lit("bench").alias("lang"))
    acts = (reidx.unionByName(upd, allowMissingColumns=True)
            .unionByName(dele, allowMissingColumns=True)
            .unionByName(create, allowMissingColumns=True))
    # updates carry only the quality column
    acts = acts.withColumn("_fields", F.when(F.col("_op_type") == "update", F.array(F.lit("quality"))))
    acts = acts.withColumn("_order", step.cast("long"))
    out = apply_bulk(cur, bulk_actions(acts), order_col="_order")
    return _doc_state(out)


@register("bulk_routing")
def q_bulk_routing(spark, sf_dir):
    """Per-row ``_index`` routes documents to several indices."""
    ev = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("_id"), F.concat(F.lit("events-"), F.col("event_type")).alias("_index"),
        "event_type", "value")
    empty = spark.createDataFrame([], "_index string, _id string")
    out = apply_bulk(empty, bulk_actions(ev))
    return out.groupBy("_index").agg(F.count(F.lit(1)).alias("n"),
                                     F.round(F.sum("value"), 2).alias("sum_value"))


@register("bulk_source_fields")
def q_bulk_source_fields(spark, sf_dir):
    """Only the named source fields are sent."""
    ev = index(spark, sf_dir, "events")
    acts = bulk_actions(ev, index="copy", source_fields=["event_type", "user_id"])
    return acts.select(*[c for c in acts.columns if c not in ("_version", "_seq_no", "_primary_term",
                                                              "_score", "_type")])


@register("bulk_meta_fields")
def q_bulk_meta_fields(spark, sf_dir):
    """Only the named metadata fields are used (``id``)."""
    ev = index(spark, sf_dir, "events")
    acts = bulk_actions(ev, meta_fields=["id"], source_fields=["value"])
    return acts.select("_op_type", "_id", F.round("value", 2).alias("value"))


def _value_store(spark, sf_dir) -> str:
    """Write the example documents: ``value`` = event id, ``_id`` = value."""
    root = scratch_path(spark, "values")
    rows = (table(spark, sf_dir, "events").select("event_id")
            .withColumnRenamed("event_id", "value")
            .withColumn("_id", F.col("value").cast("string")))
    write_bulk(rows, root, index="test", source_fields=["value"], meta_fields=["id"])
    return root


@register("range_rename_add")
def q_range_rename_add(spark, sf_dir):
    """Rename, add ``_id``, write with field selection, read back, sum."""
    root = _value_store(spark, sf_dir)
    back = read_index(spark, root, "test")
    return back.agg(F.sum("value").alias("sum_value"), F.count(F.lit(1)).alias("n"),
                    F.count_distinct("_id").alias("ids"))


@register("write_roundtrip")
def q_roundtrip(spark, sf_dir):
    """Write an index to the store and read it back unchanged."""
    root = scratch_path(spark, "roundtrip")
    write_index(index(spark, sf_dir, "events"), root)
    back = read_index(spark, root, "events")
    return back.select("_index", "_id", "event_id", _us("ts").alias("ts_us"), "user_id",
                       "event_type", F.round("value", 2).alias("value"), "props")


# ---------------------------------------------------------------------------
# Document transforms
# ---------------------------------------------------------------------------

class DocModel(Document):
    text = Text()
    lang = Keyword()

    class Index:
        name = "documents"


def _text_length(row, doc):
    return {"doc_id": row["doc_id"], "custom": len(doc.text)}


def _upper_lang(batch, docs):
    out = batch[["doc_id"]].copy()
    out["custom"] = [d.lang.upper() for d in docs]
    return out


@register("map_documents")
def q_map_documents(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("_id", "doc_id", "text", "lang")
    return map_documents(docs, DocModel, _text_length, "doc_id long, custom long")


@register("map_document_batches")
def q_map_batches(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("_id", "doc_id", "lang")
    return map_document_batches(docs, DocModel, _upper_lang, "doc_id long, custom string")


# ---------------------------------------------------------------------------
# Value types
# ---------------------------------------------------------------------------

# The mapping of the numeric type check.
NUMERIC_MAPPING = {
    "p_partkey": {"type": "unsigned_long"},
    "p_size": {"type": "byte"},
    "p_retailprice": {"type": "half_float"},
}


@register("types_numeric")
def q_types_numeric(spark, sf_dir):
    schema = mapping_to_struct(NUMERIC_MAPPING)
    df = conform(index(spark, sf_dir, "part"), schema)
    return df.select(F.col("p_partkey").cast("bigint").alias("p_partkey"),
                     F.col("p_size").cast("int").alias("p_size"),
                     F.round(F.col("p_retailprice").cast("double"), 1).alias("p_retailprice"))


@register("types_dates")
def q_types_dates(spark, sf_dir):
    """Date-only formats and epoch milliseconds parsed back to dates/times."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    d = F.to_date("ts")
    iso_dow = (F.dayofweek(d) + 5) % 7 + 1
    iso_year = F.year(F.date_add(d, (4 - iso_dow).cast("int")))
    week_text = F.format_string("%04d-W%02d-%d", iso_year, F.weekofyear(d), iso_dow)
    return ev.select(
        "event_id",
        parse_date(F.date_format(d, "yyyy-MM-dd"), "strict_date").cast("string").alias("d_date"),
        parse_date(F.date_format(d, "yyyyMMdd"), "basic_date").cast("string").alias("d_basic"),
        parse_date(F.date_format(d, "yyyy-DDD"), "ordinal_date").cast("string").alias("d_ordinal"),
        parse_date(week_text, "week_date").cast("string").alias("d_week"),
        F.unix_micros(parse_timestamp(epoch_millis(F.col("ts"), ntz=True).cast("string")))
        .alias("ts_ms_us"),
    )


@register("types_multi")
def q_types_multi(spark, sf_dir):
    """One value or a list: both read as a list (JSON hits on the wire)."""
    ev = table(spark, sf_dir, "events")
    # clicks and views carry one tag as a plain value, the others a list
    one = F.regexp_extract(F.to_json(F.array("event_type")), r"^\[(.*)\]$", 1)   # a JSON string
    tags = F.when(F.col("event_type").isin("click", "view"), one) \
        .otherwise(F.to_json(F.array(F.col("event_type"), F.lit("x"))))
    wire = ev.select(F.concat(
        F.lit('{"_index":"events","_id":"'), F.col("event_id").cast("string"),
        F.lit('","_source":{"user_id":'), F.col("user_id").cast("string"),
        F.lit(',"tags":'), tags, F.lit("}}")).alias("hit"))
    schema = complete_schema(as_struct("user_id BIGINT, tags ARRAY<STRING>"), meta_fields=["id"])
    flat = hits_from_json(wire, "hit", schema)
    return flat.select("_id", "user_id", F.size("tags").alias("n_tags"),
                       F.element_at("tags", 1).alias("first_tag"))


@register("types_vector")
def q_types_vector(spark, sf_dir):
    schema = mapping_to_struct({"embedding": {"type": "dense_vector", "dims": 64}, "label": {"type": "integer"}})
    df = conform(index(spark, sf_dir, "embeddings"), complete_schema(schema, meta_fields=["id"]))
    # every number counts, by its place
    weighted = F.aggregate(F.transform("embedding", lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return df.select("_id", F.size("embedding").alias("dims"), F.size(F.filter("embedding", lambda x: x > 0)).alias("n_positive"),
                     F.round(weighted, 2).alias("weighted_sum"), "label")


@register("types_rank_features")
def q_types_rank_features(spark, sf_dir):
    schema = mapping_to_struct({"event_id": {"type": "long"}, "props": {"type": "rank_features"}})
    df = conform(index(spark, sf_dir, "events"), schema)
    return df.select("event_id", F.explode("props").alias("feature", "weight"))


@register("types_nested")
def q_types_nested(spark, sf_dir):
    """Object fields: a struct built from joined tables, read back by path."""
    schema = mapping_to_struct({
        "c_custkey": {"type": "long"},
        "address": {"properties": {"nation": {"type": "keyword"}, "region": {"type": "keyword"}}},
    })
    df = conform(_customers_with_address(spark, sf_dir), schema)
    return df.select("c_custkey", F.col("address.nation").alias("nation"),
                     F.col("address.region").alias("region"))


@register("types_binary")
def q_types_binary(spark, sf_dir):
    """Binary fields travel as Base64 text; ``unbase64`` gives the bytes."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.base64(F.encode("html", "UTF-8")).alias("blob"))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        schema = mapping_to_struct({"page_id": {"type": "long"}, "blob": {"type": "binary"}})
    df = conform(pages, schema)
    return df.select("page_id", F.octet_length(F.unbase64("blob")).alias("n_bytes"))


@register("hits_json_roundtrip")
def q_hits_json(spark, sf_dir):
    """Hits written as JSON lines (the wire form) and read back typed."""
    h = hits(spark, sf_dir, "orders")
    wire = hits_to_json(h)
    schema = complete_schema(mapping_to_struct({
        "o_orderkey": {"type": "long"}, "o_totalprice": {"type": "double"},
        "o_orderdate": {"type": "date", "format": "strict_date_optional_time||epoch_millis"},
        "o_orderpriority": {"type": "keyword"}}), meta_fields=["index", "id", "version"])
    flat = hits_from_json(wire, "hit", schema)
    return flat.select("_index", "_id", "_version", "o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"),
                       _us("o_orderdate", ntz=False).alias("o_orderdate_us"), "o_orderpriority")


# ---------------------------------------------------------------------------
# Queries on an explicitly mapped text field (term-level queries per token)
# ---------------------------------------------------------------------------

# The mapping used for the documents index.
DOCUMENTS_MAPPING = {
    "properties": {
        "doc_id": {"type": "long"},
        "text": {"type": "text"},
        "lang": {"type": "keyword"},
        "source": {"type": "keyword"},
        "n_chars": {"type": "long"},
    }
}


def _docs_mapped(spark, sf_dir):
    schema = complete_schema(mapping_to_struct(DOCUMENTS_MAPPING), meta_fields=["index", "id"])
    return conform(_docs(spark, sf_dir), schema)


@register("query_match_msm")
def q_match_msm(spark, sf_dir):
    """``match`` with ``minimum_should_match``: two of three tokens."""
    q = {"match": {"text": {"query": "the und der", "minimum_should_match": "2"}}}
    return where_query(_docs_mapped(spark, sf_dir), q).select("doc_id")


@register("query_text_prefix")
def q_text_prefix(spark, sf_dir):
    """``prefix`` on a text field: some token starts with the prefix."""
    return where_query(_docs_mapped(spark, sf_dir), {"prefix": {"text": "thr"}}).select("doc_id")


@register("query_text_wildcard")
def q_text_wildcard(spark, sf_dir):
    """``wildcard`` on a text field: some token matches the pattern."""
    return where_query(_docs_mapped(spark, sf_dir), {"wildcard": {"text": "th?n*"}}).select("doc_id")


@register("query_term_text")
def q_term_text(spark, sf_dir):
    """``term`` on a text field matches a token exactly (an upper-case term
    never matches analyzed text)."""
    q = {"bool": {"should": [{"term": {"text": "und"}}, {"term": {"text": "The"}}]}}
    return where_query(_docs_mapped(spark, sf_dir), q).select("doc_id")


@register("query_dis_max")
def q_dis_max(spark, sf_dir):
    q = {"dis_max": {"queries": [{"match": {"text": "und"}}, {"term": {"lang": "fr"}}]}}
    return where_query(_docs_mapped(spark, sf_dir), q).select("doc_id")


@register("query_cross_fields")
def q_cross_fields(spark, sf_dir):
    """``multi_match`` of type ``cross_fields``: every token in some field."""
    q = {"multi_match": {"query": "und de", "type": "cross_fields", "operator": "and",
                         "fields": ["text", "lang"]}}
    return where_query(_docs_mapped(spark, sf_dir), q).select("doc_id")


@register("hits_json_inferred")
def q_hits_json_inferred(spark, sf_dir):
    """JSON hits read without a schema: one schema inferred over all hits."""
    wire = hits_to_json(hits(spark, sf_dir, "orders"))
    flat = hits_from_json(wire, "hit")
    return flat.select("_index", "_id", "_version", "o_orderkey", "o_custkey",
                       F.round("o_totalprice", 2).alias("o_totalprice"), F.substring("o_orderdate", 1, 10).alias("o_orderdate"),
                       "o_orderstatus", "o_orderpriority")


@register("score_bool")
def q_score_bool(spark, sf_dir):
    """Scores of a bool query: must + should (BM25; keyword term by idf),
    filter clauses not scored."""
    from docindex.operators.score import search
    q = {"bool": {"must": [{"match": {"text": "the"}}],
                  "should": [{"match": {"text": "und"}}, {"term": {"lang": "de"}}],
                  "filter": [{"range": {"n_chars": {"gte": 1000}}}]}}
    got = search(_docs_mapped(spark, sf_dir), q, track_scores=True)
    return got.select("doc_id", F.round("_score", 4).alias("_score"))


@register("score_dis_max")
def q_score_dis_max(spark, sf_dir):
    """Scores of a dis_max query: best clause plus tie-breaker times the rest."""
    from docindex.operators.score import search
    q = {"dis_max": {"queries": [{"match": {"text": "und"}}, {"match": {"text": "der die"}}],
                     "tie_breaker": 0.3}}
    got = search(_docs_mapped(spark, sf_dir), q, track_scores=True)
    return got.select("doc_id", F.round("_score", 4).alias("_score"))


@register("hits_jsonl_files")
def q_hits_jsonl_files(spark, sf_dir):
    """Hits written as JSON-lines files (gzip) and read back with a mapping."""
    path = scratch_path(spark, "hits-jsonl")
    write_hits_json(hits(spark, sf_dir, "orders"), path, compression="gzip")
    schema = complete_schema(mapping_to_struct({
        "o_orderkey": {"type": "long"}, "o_custkey": {"type": "long"},
        "o_orderstatus": {"type": "keyword"}, "o_totalprice": {"type": "double"}}),
        meta_fields=["index", "id"])
    flat = read_hits_json(spark, path, schema)
    return flat.select("_index", "_id", "o_orderkey", "o_custkey", "o_orderstatus",
                       F.round("o_totalprice", 2).alias("o_totalprice"))


# ---------------------------------------------------------------------------
# Null values, automatic ids, every date format, arrays of objects
# ---------------------------------------------------------------------------

def _labelled(spark, sf_dir):
    """Documents with their labels; null where there are none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "doc_id", "left")


@register("bulk_auto_id")
def q_bulk_auto_id(spark, sf_dir):
    """Actions without ids, many of them equal: a document for each."""
    acts = table(spark, sf_dir, "events").select("event_type", F.col("user_id").alias("o"))
    empty = spark.createDataFrame([], "_id string, event_type string")
    out = apply_bulk(empty, bulk_actions(acts, op_type="index", source_fields=["event_type"], order_col="o"), order_col="o")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_id").alias("ids"))


#: Date-only formats by what their text tells: the day, the month's or year's
#: first, the week's or week-year's first.
DATE_FORMS = {
    "day": {"date": "yyyy-M-d", "strict_date": "yyyy-MM-dd", "year_month_day": "yyyy-M-d", "strict_year_month_day": "yyyy-MM-dd", "yyyy-MM-dd": "yyyy-MM-dd", "basic_date": "yyyyMMdd",
            "basic_ordinal_date": "yyyyDDD", "ordinal_date": "yyyy-D", "strict_ordinal_date": "yyyy-DDD"},
    "month": {"year_month": "yyyy-M", "strict_year_month": "yyyy-MM"},
    "year": {"year": "yyyy", "strict_year": "yyyy"},
    "week_day": {"basic_week_date": "%04dW%02d%d", "week_date": "%04d-W%02d-%d", "strict_week_date": "%04d-W%02d-%d", "weekyear_week_day": "%04d-W%02d-%d", "strict_weekyear_week_day": "%04d-W%02d-%d"},
    "week": {"weekyear_week": "%04d-W%02d", "strict_weekyear_week": "%04d-W%02d"},
    "weekyear": {"weekyear": "%04d", "strict_weekyear": "%04d"},
}


@register("types_dates_all")
def q_types_dates_all(spark, sf_dir):
    """Every date-only format, written and read back."""
    d = F.to_date("ts")
    dow = (F.dayofweek(d) + 5) % 7 + 1
    parts = [F.year(F.date_add(d, (4 - dow).cast("int"))), F.weekofyear(d), dow]
    cols = []
    for kind, forms in DATE_FORMS.items():
        for name, shape in forms.items():
            text = F.format_string(shape, *parts[:shape.count("%")]) if "%" in shape else F.date_format(d, shape)
            cols.append(parse_date(text, name).cast("string").alias(name.replace("-", "_").lower()))
    return table(spark, sf_dir, "events").select("event_id", *cols)


def _far_ids(row: dict, doc) -> dict:
    return {"doc_id": row["doc_id"], "far": row["doc_id"] + 9007199254740993, "quality": row["quality"], "toxic": row["toxic"]}


@register("map_documents_nullable")
def q_map_documents_nullable(spark, sf_dir):
    """Nullable and very large integers pass through user code unchanged."""
    return map_documents(_labelled(spark, sf_dir), DocModel, _far_ids, "doc_id long, far long, quality int, toxic int")


@register("hits_json_nulls")
def q_hits_json_nulls(spark, sf_dir):
    """Null fields are written as null, not left out."""
    text = hits_to_json(as_hits(_labelled(spark, sf_dir), "documents", "doc_id"), "hit")
    return text.agg(F.count(F.lit(1)).alias("hits"), F.sum(F.col("hit").contains('"quality":null').cast("long")).alias("null_quality"), F.sum(F.col("hit").contains('"toxic":null').cast("long")).alias("null_toxic"))


@register("query_nested_array")
def q_nested_array(spark, sf_dir):
    """The nested query over an array of objects: both conditions in one object."""
    ev = table(spark, sf_dir, "events").select("event_id", F.array(
        F.struct(F.col("event_type").alias("name"), F.col("value").alias("num")),
        F.struct(F.lit("user").alias("name"), F.col("user_id").cast("double").alias("num"))).alias("parts"))
    q = {"nested": {"path": "parts", "query": {"bool": {"must": [{"term": {"parts.name": "click"}}, {"range": {"parts.num": {"gte": 50}}}]}}}}
    return where_query(ev, q).select("event_id")


from docindex.plans import catalog_search  # noqa: E402,F401  registers its queries
