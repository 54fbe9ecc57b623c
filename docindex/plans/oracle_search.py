"""DuckDB SQL equal to the queries of ``docindex.plans.catalog_search``."""

from docindex.plans.oracle import DOCS_LABELED, ORACLE, tok

_FOLD = "strip_accents(lower({c}))"

ORACLE["query_subfield"] = f"""
SELECT p_partkey, p_name FROM part
WHERE list_has_any({tok('p_name')}, ['ring', 'red'])
  AND ((length(p_name) <= 9 AND (p_name = 'small ring' OR starts_with(p_name, 'red'))) OR {_FOLD.format(c='p_name')} = 'blue ring')
"""

ORACLE["query_normalized"] = f"""
SELECT p_partkey, p_brand, p_type FROM part
WHERE (lower(p_type) = 'economy' OR {_FOLD.format(c='p_brand')} IN ('brand#3', 'brand#4') OR (lower(p_type) >= 'sma' AND lower(p_type) < 'sn'))
  AND NOT starts_with({_FOLD.format(c='p_brand')}, 'brand#1')
"""

ORACLE["query_alias_copied"] = f"""
WITH p AS (SELECT *, {tok("p_name || ' ' || p_brand || ' ' || p_type")} AS every FROM part)
SELECT p_partkey, p_name, p_type FROM p WHERE list_has_all(every, ['ring', 'promo']) AND NOT list_contains({tok('p_name')}, 'red')
"""

ORACLE["query_null_value"] = f"SELECT doc_id, quality FROM {DOCS_LABELED} WHERE coalesce(quality, -1) < 1 AND coalesce(toxic, 0) <> 1"

ORACLE["query_phrase_prefix"] = f"""
WITH d AS (SELECT doc_id, {tok('text')} AS t FROM documents)
SELECT doc_id FROM d WHERE len(list_filter(range(1, len(t)), lambda i: t[i] = 'of' AND starts_with(t[i + 1], 'th'))) > 0
"""

ORACLE["query_range_format"] = "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1995-03-01' AND o_orderdate < TIMESTAMP '1996-03-01'"


def part(weight: str, tf: str, dl: str = "dl", avgdl: str = "avgdl") -> str:
    """A BM25 summand, 0 where the frequency is 0."""
    return f"({weight}) * {tf} / ({tf} + 1.2 * (0.25 + 0.75 * {dl} / {avgdl}))"


def idf(df: str, n: str = "n") -> str:
    return f"ln(1 + ({n} - {df} + 0.5) / ({df} + 0.5))"


def counts(words: list[str], source: str, keys: str) -> str:
    """CTEs d (tokens), f (frequencies tf_<word>) and s (n, avgdl, df_<word>)."""
    tf = ", ".join(f"len(list_filter(t, lambda x: x = '{w}')) AS tf_{w}" for w in words)
    df = ", ".join(f"count_if(tf_{w} > 0)::DOUBLE AS df_{w}" for w in words)
    return (f"WITH d AS (SELECT {keys}, {tok('text')} AS t FROM {source}), f AS (SELECT *, len(t) AS dl, {tf} FROM d), "
            f"s AS (SELECT count(t)::DOUBLE AS n, avg(dl)::DOUBLE AS avgdl, {df} FROM f)")


ORACLE["score_phrase"] = f"""
{counts(['of', 'the'], 'documents', 'doc_id')},
p AS (SELECT *, len(list_filter(range(1, dl), lambda i: t[i] = 'of' AND t[i + 1] = 'the')) AS pf FROM f)
SELECT doc_id, round({part(idf('df_of') + ' + ' + idf('df_the'), 'pf')} + {part(idf('df_the'), 'tf_the')}, 4) AS _score FROM p, s WHERE pf > 0
"""

ORACLE["score_nested"] = f"""
{counts(['the', 'und'], "(SELECT doc_id, unnest(string_split(text, chr(10))) AS text FROM documents)", 'doc_id')}
SELECT doc_id, round(avg({part(idf('df_the'), 'tf_the')} + {part(idf('df_und'), 'tf_und')}), 4) AS _score
FROM f, s WHERE tf_the > 0 OR tf_und > 0 GROUP BY doc_id
"""

ORACLE["score_nested_table"] = f"""
{counts(['the', 'und', 'de'], 'conversations', 'conv_id, role')},
r AS (SELECT count(role)::DOUBLE AS nr, count_if(role = 'user')::DOUBLE AS dr FROM conversations)
SELECT conv_id, round(max({part(idf('df_the'), 'tf_the')} + {part(idf('df_und'), 'tf_und')} + {part(idf('df_de'), 'tf_de')}
    + CASE WHEN role = 'user' THEN {idf('dr', 'nr')} / 2.2 ELSE 0 END), 4) AS _score
FROM f, s, r WHERE tf_the > 0 OR tf_und > 0 OR tf_de > 0 GROUP BY conv_id
"""

ORACLE["score_nested_lines"] = f"""
WITH s AS (SELECT count(l_returnflag)::DOUBLE AS n, count_if(l_returnflag = 'R')::DOUBLE AS df FROM lineitem)
SELECT l_orderkey AS o_orderkey, round(sum({idf('df')} / 2.2 + CASE WHEN l_quantity >= 40 THEN 1 ELSE 0 END), 4) AS _score
FROM lineitem, s WHERE l_returnflag = 'R' AND l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey
"""

ORACLE["score_cross_fields"] = f"""
{counts(['de', 'und'], 'documents', 'doc_id, lang')},
l AS (SELECT count_if(lang = 'de')::DOUBLE AS lang_de, count_if(lang = 'und')::DOUBLE AS lang_und FROM documents),
b AS (SELECT *, greatest(df_de, lang_de) AS high_de, greatest(df_und, lang_und) AS high_und FROM s, l),
c AS (SELECT *, least(n, high_de + (df_de < lang_de)::INT) AS text_df_de, least(n, high_de + (lang_de < df_de)::INT) AS lang_df_de, least(n, high_und + (df_und < lang_und)::INT) AS text_df_und FROM b)
SELECT doc_id, round(greatest({part(idf('text_df_de'), 'tf_de')}, 2 * {idf('lang_df_de')} * (lang = 'de')::INT / 2.2) + {part(idf('text_df_und'), 'tf_und')}, 4) AS _score
FROM f, c WHERE tf_de > 0 OR tf_und > 0 OR lang IN ('de', 'und')
"""

_KEYWORD = "(SELECT count_if(lang = 'de')::DOUBLE AS k_de, count_if(lang = 'en')::DOUBLE AS k_en, count_if(lang = 'fr')::DOUBLE AS k_fr, count_if(lang = 'es')::DOUBLE AS k_es FROM documents)"

ORACLE["score_nested_bool"] = f"""
{counts(['the', 'of', 'and', 'with', 'und'], 'documents', 'doc_id, lang')},
g AS (SELECT doc_id, lang = 'es' AS es, tf_und, k_es, n, dl, avgdl, df_und, tf_the > 0 AND tf_of > 0 AND tf_and > 0 AND tf_with = 0 AS inner_match,
             {part(idf('df_the'), 'tf_the')} + {part(idf('df_of'), 'tf_of')} + {part(idf('df_and'), 'tf_and')} AS inner_score FROM f, s, {_KEYWORD})
SELECT doc_id, round(CASE WHEN inner_match THEN inner_score ELSE 0 END + {part(idf('df_und'), 'tf_und')} + CASE WHEN es THEN {idf('k_es')} / 2.2 ELSE 0 END, 4) AS _score
FROM g WHERE inner_match OR tf_und > 0 OR es
"""

ORACLE["score_boost"] = f"""
{counts(['the'], 'documents', 'doc_id, lang, n_chars')}
SELECT doc_id, round(2.5 * {part(idf('df_the'), 'tf_the')} + CASE lang WHEN 'de' THEN 3 * {idf('k_de')} WHEN 'en' THEN {idf('k_en')} WHEN 'fr' THEN {idf('k_fr')} ELSE 0 END / 2.2
    + CASE WHEN n_chars < 1000 THEN 0.5 ELSE 0 END, 4) AS _score
FROM f, s, {_KEYWORD} WHERE tf_the > 0 OR lang IN ('de', 'en', 'fr') OR n_chars < 1000
"""

ORACLE["score_missing_field"] = f"""
{counts(['the', 'und'], "(SELECT doc_id, CASE WHEN n_chars >= 1000 THEN text END AS text FROM documents)", 'doc_id')}
SELECT doc_id, round({part(idf('df_the'), 'tf_the')} + {part(idf('df_und'), 'tf_und')}, 4) AS _score FROM f, s WHERE tf_the > 0 OR tf_und > 0
"""

ORACLE["paged_scan"] = """
WITH r AS (SELECT event_id, event_type, user_id, row_number() OVER (ORDER BY event_type DESC, user_id, event_id) - 1 AS p FROM events),
g AS (SELECT p // 250 AS page, count(*) AS rows, min(p) AS a, max(p) AS z FROM r GROUP BY 1)
SELECT page, rows, f.event_type AS first_event_type, f.user_id AS first_user_id, f.event_id AS first_event_id,
       l.event_type AS last_event_type, l.user_id AS last_user_id, l.event_id AS last_event_id
FROM g JOIN r AS f ON f.p = g.a JOIN r AS l ON l.p = g.z
"""

ORACLE["bulk_chunks"] = """
WITH RECURSIVE d AS (
  SELECT doc_id // 500 AS stream, doc_id,
         strlen('{"index":{"_index":"copy","_id":"' || doc_id || '"}}') + strlen(to_json({'lang': lang, 'source': source, 'n_chars': n_chars, 'text': text})::VARCHAR) + 2 AS size FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY doc_id) AS i FROM d),
w(stream, i, doc_id, size, chunk, used, held) AS (
  SELECT stream, i, doc_id, size, 0::BIGINT, 1::BIGINT, size FROM n WHERE i = 1
  UNION ALL
  SELECT n.stream, n.i, n.doc_id, n.size, CASE WHEN used = 100 OR held + n.size > 20000 THEN chunk + 1 ELSE chunk END,
         CASE WHEN used = 100 OR held + n.size > 20000 THEN 1 ELSE used + 1 END, CASE WHEN used = 100 OR held + n.size > 20000 THEN n.size ELSE held + n.size END
  FROM w JOIN n ON n.stream = w.stream AND n.i = w.i + 1)
SELECT stream, chunk, count(*) AS rows, sum(size)::BIGINT AS bytes, min(doc_id) AS first_id, max(doc_id) AS last_id FROM w GROUP BY stream, chunk
"""

ORACLE["all_indices_mapping"] = """
SELECT 'orders' AS _index, count(*) AS n, sum(o_custkey)::BIGINT AS keys, round(sum(round(o_totalprice, 2)), 1) AS amount, (2 * count(*))::BIGINT AS tags, 'none' AS mixed FROM orders
UNION ALL
SELECT 'customer', count(*), sum(c_custkey)::BIGINT, round(sum(c_nationkey)::DOUBLE, 1), count(c_mktsegment)::BIGINT, max(c_name) FROM customer
UNION ALL
SELECT 'events', count(*), sum(user_id)::BIGINT, round(sum(round(value::FLOAT::DOUBLE, 2)), 1), 0::BIGINT, max(event_id::VARCHAR) FROM events
"""

ORACLE["model_date_format"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, strftime(o_orderdate, '%Y-%m-%d') || ',' || strftime(o_orderdate, '%Y-%m-%d') AS o_week,
       round(o_totalprice, 2) AS o_totalprice, o_orderkey::VARCHAR AS _id FROM orders
"""

ORACLE["types_nested_list"] = """
SELECT event_id, event_id::VARCHAR AS _id, CASE event_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END::INT AS n_tags, CASE WHEN event_id % 3 < 2 THEN event_type END AS first_kind,
       round(CASE event_id % 3 WHEN 0 THEN value + user_id WHEN 1 THEN value ELSE 0 END, 2) AS weight FROM events
"""

ORACLE["sliced_scan_pruned"] = "SELECT event_id::VARCHAR AS _id, event_id, event_type, round(value, 2) AS value FROM events WHERE event_id % 7 IN (2, 5)"

ORACLE["index_bounds"] = """
SELECT count(*) AS rows, min(o_orderkey) AS min_o_orderkey, max(o_orderkey) AS max_o_orderkey, min(o_custkey) AS min_o_custkey, max(o_custkey) AS max_o_custkey FROM orders
"""
