"""Slices that read their own files only.

A sliced read asks for one of N disjoint parts of an index.  Filtering a table by
a hash of the id reads every file for every slice; here the table is bucketed by
its slice number, so that Spark opens the buckets of the wanted slices and skips
the others, and a join or an aggregation by ``_slice`` and id needs no shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docindex.session import scratch_path
from docindex.sources.hits import slice_column

SLICE = "_slice"


def write_slices(df: DataFrame, slices: int, id_col: str = "_id", by: Column | None = None, name: str | None = None, path: str | None = None) -> str:
    """Write ``df`` once, bucketed by slice; returns the table's name.

    ``by`` numbers a row's slice from 0 (default: a hash of the id).  Every
    slice goes into one file of its bucket.  The table lies below the shared
    folder (or at ``path``) until ``drop_slices``.
    """
    spark = df.sparkSession
    if SLICE in df.columns:
        raise ValueError(f"{SLICE} names the slice: rename that column")
    name = name or f"slices_{uuid.uuid4().hex}"
    number = (slice_column(slices, id_col) if by is None else by).cast("int").alias(SLICE)
    (df.select("*", number).repartition(slices, SLICE).write.bucketBy(slices, SLICE).sortBy(id_col)
     .option("path", path or scratch_path(spark, name)).saveAsTable(name))
    return name


def read_slices(spark: SparkSession, name: str, slices: int | Iterable[int] | None = None) -> DataFrame:
    """Rows of some slices (all without numbers) of a table of ``write_slices``."""
    df = spark.table(name)
    if slices is not None:
        wanted = [slices] if isinstance(slices, int) else list(slices)
        df = df.where(F.col(SLICE) == wanted[0] if len(wanted) == 1 else F.col(SLICE).isin(wanted))
    return df.drop(SLICE)


def drop_slices(spark: SparkSession, name: str) -> None:
    """Forget the table (its files stay for the folder's owner to clear)."""
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
