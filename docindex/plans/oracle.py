"""DuckDB SQL equal to each registered query, for the correctness check.

Tokens: ``list_filter(string_split_regex(lower(x), '[^\\p{L}\\p{N}]+'), lambda t: t <> '')``.
"""

ORACLE: dict[str, str] = {}

TOK = "list_filter(string_split_regex(lower({c}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"


def tok(c: str) -> str:
    return TOK.format(c=c)


# --- scans -------------------------------------------------------------------
ORACLE["scan_sum"] = "SELECT round(sum(value), 2) AS sum_value, count(*) AS n FROM events"

ORACLE["flatten_hits"] = """
SELECT 'events' AS _index, '_doc' AS _type, CAST(event_id AS VARCHAR) AS _id, 1::BIGINT AS _version,
       NULL::BIGINT AS _seq_no, 1::BIGINT AS _primary_term, NULL::DOUBLE AS _score,
       event_id, epoch_us(ts) AS ts_us, user_id, event_type, round(value, 2) AS value, props
FROM events
"""

ORACLE["nest_hits"] = """
SELECT 'events' AS _index, '_doc' AS _type, CAST(event_id AS VARCHAR) AS _id, 1::BIGINT AS _version, 1::BIGINT AS _primary_term,
       event_id, epoch_us(ts) AS ts_us, user_id, event_type, round(value, 2) AS value, props FROM events
"""

ORACLE["meta_columns"] = """
SELECT 'events' AS _index, '_doc' AS _type, CAST(event_id AS VARCHAR) AS _id, 1::BIGINT AS _version,
       event_id AS _seq_no, 1::BIGINT AS _primary_term, NULL::DOUBLE AS _score
FROM events
"""

ORACLE["source_fields_select"] = """
SELECT CAST(event_id AS VARCHAR) AS _id, round(value, 2) AS value, event_type FROM events
"""

ORACLE["meta_fields_select"] = """
SELECT 'part' AS _index, CAST(p_partkey AS VARCHAR) AS _id, 1::BIGINT AS _version FROM part
"""

ORACLE["schema_completion"] = """
SELECT event_type, round(value, 2) AS value, CAST(event_id AS VARCHAR) AS _id, NULL::DOUBLE AS _score
FROM events
"""

ORACLE["explicit_schema_read"] = """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey,
       round(CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE), 2) AS o_totalprice,
       o_orderstatus, NULL::VARCHAR AS o_clerk
FROM orders
"""

ORACLE["mapping_schema_read"] = """
SELECT p_partkey, p_name, p_brand, p_type, p_size, round(p_retailprice, 2) AS p_retailprice,
       'part' AS _index, CAST(p_partkey AS VARCHAR) AS _id, 1::BIGINT AS _version
FROM part
"""

ORACLE["model_schema_read"] = """
SELECT p_partkey, p_name, p_size, 'part' AS _index, CAST(p_partkey AS VARCHAR) AS _id FROM part
"""

ORACLE["typed_model_schema_read"] = """
SELECT c_custkey, c_name, round(c_acctbal, 2) AS c_acctbal, c_mktsegment, NULL::VARCHAR AS c_phone,
       CAST(c_custkey AS VARCHAR) AS _id
FROM customer
"""

ORACLE["count_query"] = "SELECT count(*) AS n FROM events WHERE event_type = 'click'"

ORACLE["sliced_scan"] = """
SELECT 7::BIGINT AS n_slices, count(*) AS total_rows, CAST(sum(event_id) AS BIGINT) AS id_sum,
       count(DISTINCT event_id) AS distinct_ids
FROM events
"""

ORACLE["all_indices_scan"] = """
SELECT 'orders' AS _index, count(*) AS n, count(DISTINCT o_orderkey) AS ids FROM orders
UNION ALL
SELECT 'customer' AS _index, count(*) AS n, count(DISTINCT c_custkey) AS ids FROM customer
"""

ORACLE["snapshot_read"] = """
SELECT round(sum(value), 2) AS sum_value, count(*) AS n, 1 AS version FROM events
UNION ALL
SELECT round(sum(value), 2) AS sum_value, count(*) AS n, 2 AS version FROM events
WHERE event_type <> 'error'
"""

# --- queries -----------------------------------------------------------------
ORACLE["query_range"] = """
SELECT round(sum(value), 2) AS sum_value, count(*) AS n FROM events WHERE value < 100
"""

ORACLE["query_range_date"] = """
SELECT round(sum(l_quantity), 2) AS sum_value, count(*) AS n FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1996-01-01'
"""

ORACLE["query_match"] = f"""
SELECT doc_id, lang FROM documents WHERE list_has_any({tok('text')}, ['the', 'und'])
"""

ORACLE["query_match_and"] = f"""
SELECT doc_id, lang FROM documents WHERE list_has_all({tok('text')}, ['the', 'and'])
"""

ORACLE["query_match_phrase"] = f"""
WITH d AS (SELECT doc_id, {tok('text')} AS t FROM documents)
SELECT doc_id FROM d
WHERE len(list_filter(range(1, len(t)), lambda i: t[i] = 'of' AND t[i + 1] = 'the')) > 0
"""

ORACLE["query_multi_match"] = f"""
SELECT doc_id, lang FROM documents
WHERE list_has_any({tok('text')}, ['und', 'en']) OR list_has_any({tok('lang')}, ['und', 'en'])
"""

DOCS_LABELED = "(SELECT * FROM documents LEFT JOIN labels USING (doc_id))"

ORACLE["query_exists"] = f"SELECT doc_id FROM {DOCS_LABELED} WHERE quality IS NOT NULL"

ORACLE["query_must_not"] = f"SELECT doc_id FROM {DOCS_LABELED} WHERE NOT coalesce(toxic = 1, false)"

ORACLE["query_bool"] = f"""
SELECT doc_id FROM {DOCS_LABELED}
WHERE list_contains({tok('text')}, 'the') AND n_chars >= 1000
  AND (lang = 'en' OR lang = 'de') AND NOT coalesce(quality = 0, false)
"""

ORACLE["query_min_should"] = f"""
WITH d AS (SELECT doc_id, lang, {tok('text')} AS t FROM documents)
SELECT doc_id FROM d
WHERE CAST(list_contains(t, 'und') AS INT) + CAST(list_contains(t, 'der') AS INT)
    + CAST(list_contains(t, 'die') AS INT) + CAST(lang = 'de' AS INT) >= 2
"""

ORACLE["query_term"] = """
SELECT p_partkey FROM part WHERE p_brand = 'Brand#13' OR lower(p_type) = 'promo'
"""

ORACLE["query_terms"] = """
SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
"""

ORACLE["query_ids"] = """
SELECT CAST(p_partkey AS VARCHAR) AS _id, p_partkey FROM part
WHERE CAST(p_partkey AS VARCHAR) IN ('1', '5', '17', '150', '1000', '99999999')
"""

ORACLE["query_prefix"] = "SELECT p_partkey FROM part WHERE starts_with(p_name, 'hot')"

ORACLE["query_wildcard"] = "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'r%d %'"

ORACLE["query_regexp"] = "SELECT p_partkey FROM part WHERE regexp_full_match(p_brand, 'Brand#1[0-9]')"

ORACLE["query_nested"] = """
SELECT o_orderkey FROM orders o
WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
              AND l.l_quantity >= 49 AND l.l_returnflag = 'R')
"""

ORACLE["query_dotted_path"] = """
SELECT c_custkey FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE r.r_name = 'ASIA' AND c.c_acctbal > 0
"""

ORACLE["query_multi_valued"] = """
SELECT vec_id, label FROM embeddings WHERE len(list_filter(embedding, lambda x: x > 0.25)) > 0
"""

ORACLE["query_constant_score"] = "SELECT p_partkey FROM part WHERE p_size >= 40"

ORACLE["query_match_all"] = "SELECT count(*) AS n, 0::BIGINT AS n_none FROM part"

ORACLE["query_object"] = """
SELECT p_partkey FROM part WHERE p_retailprice < 1000 AND p_brand <> 'Brand#1'
"""

ORACLE["example_query_sum"] = """
SELECT CAST(sum(event_id) AS BIGINT) AS sum_value, count(*) AS n FROM events WHERE event_id < 100
"""

# --- relevance ---------------------------------------------------------------
ORACLE["score_bm25"] = f"""
WITH d AS (SELECT doc_id, {tok('text')} AS t FROM documents),
f AS (SELECT doc_id, len(t) AS dl,
             len(list_filter(t, lambda x: x = 'the')) AS tf0,
             len(list_filter(t, lambda x: x = 'und')) AS tf1 FROM d),
s AS (SELECT count(*)::DOUBLE AS n, avg(dl)::DOUBLE AS avgdl,
             count_if(tf0 > 0)::DOUBLE AS df0, count_if(tf1 > 0)::DOUBLE AS df1 FROM f)
SELECT doc_id, round(
    ln(1 + (n - df0 + 0.5) / (df0 + 0.5)) * tf0 / (tf0 + 1.2 * (0.25 + 0.75 * dl / avgdl))
  + ln(1 + (n - df1 + 0.5) / (df1 + 0.5)) * tf1 / (tf1 + 1.2 * (0.25 + 0.75 * dl / avgdl)), 4) AS _score
FROM f, s WHERE tf0 > 0 OR tf1 > 0
"""

# --- bulk ----------------------------------------------------------------------
ORACLE["bulk_actions"] = """
SELECT op AS _op_type, 'documents' AS _index, CAST(doc_id AS VARCHAR) AS _id,
       '{"' || op || '":{"_index":"documents","_id":"' || CAST(doc_id AS VARCHAR) || '"}}' AS header,
       CASE WHEN op = 'delete' THEN NULL
            WHEN op = 'update' THEN '{"doc":{"lang":"' || lang || '","source":"' || source
                                    || '","n_chars":' || CAST(n_chars AS VARCHAR) || '}}'
            ELSE '{"lang":"' || lang || '","source":"' || source || '","n_chars":'
                 || CAST(n_chars AS VARCHAR) || '}' END AS body
FROM (SELECT *, CASE lang WHEN 'de' THEN 'update' WHEN 'fr' THEN 'delete' ELSE 'index' END AS op
      FROM documents)
"""

ORACLE["bulk_index"] = """
SELECT CAST(doc_id AS VARCHAR) AS _id,
       CASE WHEN lang = 'de' THEN 2 ELSE 1 END::BIGINT AS _version, lang,
       CASE WHEN lang = 'de' THEN 'reindexed' ELSE source END AS source,
       CASE WHEN lang = 'de' THEN NULL ELSE n_chars END AS n_chars,
       lang <> 'de' AS has_text, CASE WHEN lang <> 'de' THEN sha256(text) END AS text_sha256
FROM documents
"""

ORACLE["bulk_default"] = """
SELECT CAST(doc_id AS VARCHAR) AS _id,
       CASE WHEN lang = 'es' THEN 2 ELSE 1 END::BIGINT AS _version, lang,
       CASE WHEN lang = 'es' THEN 'default' ELSE source END AS source,
       CASE WHEN lang = 'es' THEN NULL ELSE n_chars END AS n_chars,
       lang <> 'es' AS has_text, CASE WHEN lang <> 'es' THEN sha256(text) END AS text_sha256
FROM documents
"""

ORACLE["bulk_create"] = """
SELECT CAST(doc_id AS VARCHAR) AS _id, 1::BIGINT AS _version, lang, source, n_chars, true AS has_text, sha256(text) AS text_sha256
FROM documents
UNION ALL
SELECT 'b' || CAST(item_id AS VARCHAR) AS _id, 1::BIGINT AS _version, 'bench' AS lang,
       'benchmark' AS source, NULL::BIGINT AS n_chars, true AS has_text, sha256(text) AS text_sha256
FROM benchmark
"""

ORACLE["bulk_update"] = """
SELECT CAST(d.doc_id AS VARCHAR) AS _id,
       CASE WHEN l.doc_id IS NULL THEN 1 ELSE 2 END::BIGINT AS _version,
       lang, source, n_chars, quality, toxic, true AS has_text, sha256(text) AS text_sha256
FROM documents d LEFT JOIN labels l USING (doc_id)
"""

ORACLE["bulk_delete"] = """
SELECT CAST(doc_id AS VARCHAR) AS _id, 1::BIGINT AS _version, lang, source, n_chars, true AS has_text, sha256(text) AS text_sha256
FROM documents d WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
"""

ORACLE["bulk_mixed"] = """
SELECT CAST(d.doc_id AS VARCHAR) AS _id,
       (1 + CASE WHEN d.lang = 'fr' THEN 1 ELSE 0 END
          + CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 END)::BIGINT AS _version,
       d.lang,
       CASE WHEN d.lang = 'fr' THEN 'fr-reindexed' ELSE d.source END AS source,
       d.n_chars, l.quality, true AS has_text, sha256(text) AS text_sha256
FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE NOT coalesce(l.toxic = 1, false)
UNION ALL
SELECT 'b' || CAST(item_id AS VARCHAR) AS _id, 1::BIGINT AS _version, 'bench' AS lang,
       NULL AS source, NULL::BIGINT AS n_chars, NULL::INTEGER AS quality, true AS has_text, sha256(text) AS text_sha256
FROM benchmark
"""

ORACLE["bulk_routing"] = """
SELECT 'events-' || event_type AS _index, count(*) AS n, round(sum(value), 2) AS sum_value
FROM events GROUP BY event_type
"""

ORACLE["bulk_source_fields"] = """
SELECT 'index' AS _op_type, 'copy' AS _index, CAST(event_id AS VARCHAR) AS _id, user_id, event_type
FROM events
"""

ORACLE["bulk_meta_fields"] = """
SELECT 'index' AS _op_type, CAST(event_id AS VARCHAR) AS _id, round(value, 2) AS value FROM events
"""

ORACLE["range_rename_add"] = """
SELECT CAST(sum(event_id) AS BIGINT) AS sum_value, count(*) AS n, count(DISTINCT event_id) AS ids FROM events
"""

ORACLE["write_roundtrip"] = """
SELECT 'events' AS _index, CAST(event_id AS VARCHAR) AS _id, event_id, epoch_us(ts) AS ts_us,
       user_id, event_type, round(value, 2) AS value, props
FROM events
"""

# --- transforms --------------------------------------------------------------
ORACLE["map_documents"] = "SELECT doc_id, length(text)::BIGINT AS custom FROM documents"

ORACLE["map_document_batches"] = "SELECT doc_id, upper(lang) AS custom FROM documents"

# --- value types ---------------------------------------------------------------
ORACLE["types_numeric"] = """
SELECT p_partkey, p_size, round(CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE), 1) AS p_retailprice
FROM part
"""

ORACLE["types_dates"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS d_date, strftime(ts, '%Y-%m-%d') AS d_basic,
       strftime(ts, '%Y-%m-%d') AS d_ordinal, strftime(ts, '%Y-%m-%d') AS d_week,
       (epoch_us(ts) // 1000) * 1000 AS ts_ms_us
FROM events
"""

ORACLE["types_multi"] = """
SELECT CAST(event_id AS VARCHAR) AS _id, user_id,
       CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 2 END AS n_tags, event_type AS first_tag
FROM events
"""

ORACLE["types_vector"] = """
SELECT CAST(vec_id AS VARCHAR) AS _id, CAST(len(embedding) AS INTEGER) AS dims,
       CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS n_positive,
       round(list_sum(list_transform(embedding, lambda x, i: x::DOUBLE * i)), 2) AS weighted_sum, label
FROM embeddings
"""

ORACLE["types_rank_features"] = """
SELECT event_id, 'k' AS feature, CAST(json_extract(props, '$.k') AS DOUBLE) AS weight FROM events
"""

ORACLE["types_nested"] = """
SELECT c_custkey, n_name AS nation, r_name AS region
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

ORACLE["types_binary"] = "SELECT page_id, CAST(strlen(html) AS INTEGER) AS n_bytes FROM pages"

ORACLE["hits_json_roundtrip"] = """
SELECT 'orders' AS _index, CAST(o_orderkey AS VARCHAR) AS _id, 1::BIGINT AS _version, o_orderkey,
       round(o_totalprice, 2) AS o_totalprice, epoch_us(o_orderdate) AS o_orderdate_us, o_orderpriority
FROM orders
"""

# --- mapped text field -------------------------------------------------------
ORACLE["query_match_msm"] = f"""
WITH d AS (SELECT doc_id, {tok('text')} AS t FROM documents)
SELECT doc_id FROM d
WHERE CAST(list_contains(t, 'the') AS INT) + CAST(list_contains(t, 'und') AS INT)
    + CAST(list_contains(t, 'der') AS INT) >= 2
"""

ORACLE["query_text_prefix"] = f"""
SELECT doc_id FROM documents
WHERE len(list_filter({tok('text')}, lambda x: starts_with(x, 'thr'))) > 0
"""

ORACLE["query_text_wildcard"] = f"""
SELECT doc_id FROM documents WHERE len(list_filter({tok('text')}, lambda x: x LIKE 'th_n%')) > 0
"""

ORACLE["query_term_text"] = f"SELECT doc_id FROM documents WHERE list_contains({tok('text')}, 'und')"

ORACLE["query_dis_max"] = f"""
SELECT doc_id FROM documents WHERE list_contains({tok('text')}, 'und') OR lang = 'fr'
"""

ORACLE["query_cross_fields"] = f"""
SELECT doc_id FROM documents
WHERE (list_contains({tok('text')}, 'und') OR lang = 'und')
  AND (list_contains({tok('text')}, 'de') OR lang = 'de')
"""

ORACLE["hits_json_inferred"] = """
SELECT 'orders' AS _index, CAST(o_orderkey AS VARCHAR) AS _id, 1::BIGINT AS _version, o_orderkey,
       o_custkey, round(o_totalprice, 2) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderstatus, o_orderpriority
FROM orders
"""


def _bm25_sql(tf: str, dfc: str) -> str:
    return (f"ln(1 + (n - {dfc} + 0.5) / ({dfc} + 0.5)) * {tf} / "
            f"({tf} + 1.2 * (0.25 + 0.75 * dl / avgdl))")


_TF = f"""
WITH d AS (SELECT doc_id, lang, n_chars, {tok('text')} AS t FROM documents),
f AS (SELECT doc_id, lang, n_chars, len(t) AS dl,
             len(list_filter(t, lambda x: x = 'the')) AS tf_the,
             len(list_filter(t, lambda x: x = 'und')) AS tf_und,
             len(list_filter(t, lambda x: x = 'der')) AS tf_der,
             len(list_filter(t, lambda x: x = 'die')) AS tf_die FROM d),
s AS (SELECT count(*)::DOUBLE AS n, avg(dl)::DOUBLE AS avgdl,
             count_if(tf_the > 0)::DOUBLE AS df_the, count_if(tf_und > 0)::DOUBLE AS df_und,
             count_if(tf_der > 0)::DOUBLE AS df_der, count_if(tf_die > 0)::DOUBLE AS df_die,
             count_if(lang = 'de')::DOUBLE AS df_de FROM f)
"""

ORACLE["score_bool"] = _TF + f"""
SELECT doc_id, round({_bm25_sql('tf_the', 'df_the')}
    + CASE WHEN tf_und > 0 THEN {_bm25_sql('tf_und', 'df_und')} ELSE 0 END
    + CASE WHEN lang = 'de' THEN ln(1 + (n - df_de + 0.5) / (df_de + 0.5)) / 2.2 ELSE 0 END, 4) AS _score
FROM f, s WHERE tf_the > 0 AND n_chars >= 1000
"""

ORACLE["score_dis_max"] = _TF + f"""
, g AS (SELECT doc_id,
        CASE WHEN tf_und > 0 THEN {_bm25_sql('tf_und', 'df_und')} ELSE 0 END AS s1,
        CASE WHEN tf_der + tf_die > 0 THEN {_bm25_sql('tf_der', 'df_der')} + {_bm25_sql('tf_die', 'df_die')}
             ELSE 0 END AS s2
        FROM f, s WHERE tf_und > 0 OR tf_der > 0 OR tf_die > 0)
SELECT doc_id, round(greatest(s1, s2) + 0.3 * (s1 + s2 - greatest(s1, s2)), 4) AS _score FROM g
"""

ORACLE["hits_jsonl_files"] = """
SELECT 'orders' AS _index, CAST(o_orderkey AS VARCHAR) AS _id, o_orderkey, o_custkey, o_orderstatus,
       round(o_totalprice, 2) AS o_totalprice
FROM orders
"""

# --- nulls, automatic ids, every date format, arrays of objects -------------------
ORACLE["bulk_auto_id"] = "SELECT event_type, count(*) AS n, count(*) AS ids FROM events GROUP BY event_type"

_DATE_KINDS = {
    "day": "ts::DATE", "week_day": "ts::DATE", "month": "date_trunc('month', ts)", "year": "date_trunc('year', ts)",
    "week": "date_trunc('week', ts)", "weekyear": "date_trunc('week', make_date(isoyear(ts)::BIGINT, 1, 4))",
}


def _dates_all() -> str:
    from docindex.plans.catalog import DATE_FORMS
    cols = [f"strftime({_DATE_KINDS[kind]}, '%Y-%m-%d') AS {name.replace('-', '_').lower()}" for kind, forms in DATE_FORMS.items() for name in forms]
    return f"SELECT event_id, {', '.join(cols)} FROM events"


ORACLE["types_dates_all"] = _dates_all()

ORACLE["map_documents_nullable"] = """
SELECT d.doc_id, d.doc_id + 9007199254740993 AS far, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)
"""

ORACLE["hits_json_nulls"] = """
SELECT count(*) AS hits, sum((l.quality IS NULL)::INT)::BIGINT AS null_quality, sum((l.toxic IS NULL)::INT)::BIGINT AS null_toxic
FROM documents d LEFT JOIN labels l USING (doc_id)
"""

ORACLE["query_nested_array"] = "SELECT event_id FROM events WHERE (event_type = 'click' AND value >= 50) OR ('user' = 'click' AND user_id >= 50)"


from docindex.plans import oracle_search  # noqa: E402,F401  adds its queries
