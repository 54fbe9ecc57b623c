"""Size of an index in storage, and what its files say about themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def size_estimate(df: DataFrame) -> DataFrame:
    """Files and stored bytes behind a file-based DataFrame.

    Reads the listing only (names and lengths, a row a file), no rows.
    """
    files = df.inputFiles()
    if not files:
        return df.sparkSession.range(1).select(F.lit(0).cast("long").alias("files"), F.lit(None).cast("long").alias("bytes"))
    listing = df.sparkSession.read.format("binaryFile").load(files).select("path", "length")
    return listing.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def column_bounds(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """One row about a folder or file of Parquet: rows, and of each column the
    least and the greatest value, answered from the files' footers.

    The aggregates are pushed into the scan (see ``PushedAggregation`` in the
    plan), which reads no row groups.  Columns whose footers hold no exact
    bounds (texts, timestamps in old formats) are aggregated from their values.
    The frame belongs to a session of its own, as pushing is a session setting.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        aggs += [F.min(f"`{c}`").alias(f"min_{c}"), F.max(f"`{c}`").alias(f"max_{c}")]
    return own.read.parquet(path).agg(*aggs)
