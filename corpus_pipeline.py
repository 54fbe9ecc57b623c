"""From raw documents to tokens: the stages of a training corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows as Parquet to the shared folder and hands the next stage
what it reads back, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docindex.llm.bpe import decode, encode
from docindex.llm.common import stored
from docindex.llm.decontaminate import decontaminate
from docindex.llm.ngram_join import one_of_each
from docindex.llm.quality import classify, train
from docindex.llm.suffix_dedup import remove_repeats, with_kept_text


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return classify(docs, model).where("keep").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the least doc_id."""
    return one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-byte strings that earlier ones have.

    Half characters at the edge of a removed span go with it; documents of
    which nothing is left go; n_chars follows the text where it changed.
    """
    out = with_kept_text(remove_repeats(docs).where("n_bytes = 0 or n_removed < n_bytes"))
    out = out.select("row", (F.col("n_removed") > 0).alias("cut"), F.col("kept_text").alias("text"))
    kept = {"text": F.col("text"), "n_chars": F.when(F.col("cut"), F.char_length("text").cast("long")).otherwise(F.col("row.n_chars")).alias("n_chars")}
    return out.select(*(kept[c] if c in kept else F.col(f"row.`{c}`") for c in docs.columns))


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the text that they decode to."""
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = decode(encode(docs, path), path)
    rest = [F.col(f"row.`{c}`") for c in docs.columns if c != "text"]
    return out.select(*rest, F.col("decoded").cast("string").alias("text"), F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeats),
    ("benchmark decontamination", clean_of_benchmarks),
    ("byte-level BPE encoding and decoding", tokens),
]

#: The classifier's verdicts have no SQL form; tests hold the stages against
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
