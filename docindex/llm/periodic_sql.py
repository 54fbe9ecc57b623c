"""The query op11_periodic_runs as SQL: the same runs from contexts of 1, 2, 4,
... words, as joins and windows."""

#: Contexts of up to 2**LEVELS words: periods up to that many, texts up to four
#: times as many words (SQL unrolls the levels; empty ones cost nothing).
LEVELS = 16

_CRC = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), "
        "lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda x: 0::BIGINT)), lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)")


def periodic_runs_sql() -> str:
    parts = [f"""d AS MATERIALIZED (
  SELECT *, CASE WHEN n > 0 AND h % 10 = 0 THEN (h // 10) % n END AS a FROM (
    SELECT row_number() OVER () AS k, doc_id, w, len(w) AS n, {_CRC} AS h
    FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents)))""",
             """t AS MATERIALIZED (
  SELECT k, doc_id, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END + 1]) END AS w FROM d)""",
             """x AS MATERIALIZED (SELECT k, unnest(w) AS w, unnest(range(len(w))) AS i FROM t)""",
             """c0 AS MATERIALIZED (SELECT k, i, dense_rank() OVER (PARTITION BY k ORDER BY w) AS name FROM x)"""]
    found = []
    for level in range(LEVELS + 1):
        c = 1 << level
        parts.append(f"""l{level} AS MATERIALIZED (SELECT k, i, name, i - lag(i) OVER (PARTITION BY k, name ORDER BY i) AS lag, count(*) OVER (PARTITION BY k, name) AS uses FROM c{level})""")
        parts.append(f"""r{level} AS (
  SELECT k, first - {c - 1} - lag AS start, size + {c - 1} + lag AS length, lag AS period FROM (
    SELECT k, lag, min(i) AS first, count(*) AS size FROM (SELECT k, i, lag, i - row_number() OVER (PARTITION BY k, lag ORDER BY i) AS island FROM l{level} WHERE lag > {c // 2} AND lag <= {c})
    GROUP BY k, lag, island) WHERE size + {c - 1} + lag >= greatest(6, 4 * lag))""")
        found.append(f"SELECT * FROM r{level}")
        if level < LEVELS:
            parts.append(f"""c{level + 1} AS MATERIALIZED (
  SELECT b.k, b.i, dense_rank() OVER (PARTITION BY b.k ORDER BY a.name, b.name) AS name
  FROM (SELECT * FROM l{level} WHERE uses > 1) AS b JOIN (SELECT * FROM l{level} WHERE uses > 1) AS a ON a.k = b.k AND a.i = b.i - {c})""")
    parts.append("r AS MATERIALIZED (" + " UNION ALL ".join(found) + ")")
    parts.append("""g AS MATERIALIZED (SELECT DISTINCT k, unnest(range(start + period, start + length)) AS i FROM r)""")
    parts.append("""kept AS (SELECT x.k, string_agg(x.w, ' ' ORDER BY x.i) AS text FROM x LEFT JOIN g ON g.k = x.k AND g.i = x.i WHERE g.i IS NULL GROUP BY x.k)""")
    parts.append("""s AS (SELECT k, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
  first(struct_pack(start := start, length := length, period := period) ORDER BY length DESC, start, period) AS best FROM r GROUP BY k)""")
    return "WITH " + ",\n".join(parts) + """
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length, best.period::BIGINT AS period,
       (1000 * best.length // best.period)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM t LEFT JOIN s ON s.k = t.k LEFT JOIN kept ON kept.k = t.k"""
