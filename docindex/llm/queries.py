"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .periodic_sql import periodic_runs_sql


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import similar_documents
    return similar_documents(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_id")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import remove_repeats
    out = remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import round_trip
    out = round_trip(_table(spark, sf_dir, "pages"))
    # the digest of what was read; a revisit has that of the record it repeats
    digest = F.when(F.col("record_type") == "response", F.sha1("payload")).otherwise(F.col("payload_digest"))
    size = F.when(F.col("record_type") == "response", F.length("payload").cast("long")).otherwise(F.col("payload_bytes"))
    return out.select("page_id", size.alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to", "url")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import decode, encode
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = decode(encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), path), path)
    return out.select("row.doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination
    out = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", F.size("hit").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hit") > 0).alias("contaminated"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard
    text = F.coalesce("text", F.lit(""))
    rows = _table(spark, sf_dir, "documents").select("doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"))
    return shard(rows, 16, order=["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


def op6_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hamming import sign_code, top_k
    points = _table(spark, sf_dir, "embeddings").select("vec_id", sign_code(F.col("embedding")).alias("code"))
    return top_k(points, points.where("vec_id % 50 = 0"), k=10).select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import predict, train
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")), F.lit(3)) == 1
    model = train(docs.where(~F.coalesce(held_out, F.lit(False))))
    out = predict(docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text"), model)
    return out.select("row.doc_id", "row.held_out", "lang_pred", "score")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import classify, train
    docs = _table(spark, sf_dir, "documents")
    out = classify(docs, train(docs, _table(spark, sf_dir, "labels")))
    return out.select("row.doc_id", "score", "text_score", "meta_score", "keep")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html import extract, train
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = extract(pages, train(pages))
    return out.select("row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic import collapse_runs, planted
    out = collapse_runs(planted(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    # longest first, then the smallest start and period
    out = out.withColumn("best", F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as s, -r.period as p)))"))
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return out.select("row.doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"),
                      (-F.col("best.p")).alias("period"), F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
                      F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .alignment import align_tokens
    out = align_tokens(_table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates
    out = near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id", "n_shingles")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_warc": op3_warc,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_decontaminate": op5_decontaminate,
    "op6_hamming_top_k": op6_hamming_top_k,
    "op7_sharding": op7_sharding,
    "op8_language_id": op8_language_id,
    "op9_quality": op9_quality,
    "op10_html_text": op10_html_text,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_alignment": op12_token_alignment,
    "op13_simhash": op13_simhash,
}
ORACLE: dict[str, str] = {
    "op11_periodic_runs": periodic_runs_sql(),
    "op6_hamming_top_k": """
WITH c AS (SELECT DISTINCT vec_id, array_to_string(list_transform(range(1, 65), lambda i: CASE WHEN embedding[i] > 0 AND NOT isnan(embedding[i]) THEN '1' ELSE '0' END), '')::BIT AS code
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
d AS (SELECT q.vec_id AS query_id, c.vec_id, bit_count(xor(q.code, c.code))::INT AS distance FROM c AS q, c WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INT AS rank, vec_id, distance FROM d)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10""",
    "op3_warc": """
WITH p AS (SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
k AS (SELECT d, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY d)
SELECT p.page_id, p.n::BIGINT AS payload_bytes, p.d AS payload_digest,
       CASE WHEN p.n >= 1000 AND p.page_id < k.keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.n >= 1000 AND p.page_id < k.keeper THEN k.keeper END AS refers_to, p.url
FROM p LEFT JOIN k ON p.d = k.d""",
    "op5_decontaminate": r"""
WITH b AS (SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS win
       FROM (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM bw),
d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens WHERE len(w) >= m),
h AS (SELECT p.doc_id, p.i, p.m, bw.item_id FROM p JOIN bw ON bw.m = p.m AND bw.win = array_to_string(p.w[p.i:p.i + p.m - 1], ' ')),
hw AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS pos FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(hw.n_hit, 0)::BIGINT AS n_hit, coalesce(hi.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(hi.items, '')) AS items_sha256, coalesce(hw.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)""",
}
