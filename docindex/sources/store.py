"""A folder of Parquet snapshots as an index store.

Layout: ``<root>/v=<n>/_index=<name>/part-*.parquet``.  Every write goes to
an attempt folder of its own and is published as a version by one rename, so
a failed write leaves no version and hinders no later one.  A read pins one version, so it sees one
consistent snapshot however long it runs and whatever is written meanwhile
(the point-in-time read of a search index).  Several indices share a
version and are told apart by the ``_index`` partition column, so reading
one index prunes the others' files.

Bulk writes are copy-on-write: the next version is the current one with the
actions applied (``docindex.operators.bulk.apply_bulk``).  Writing a version
also cuts the lineage of whatever produced it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from docindex.sources.schema import META_NAMES

_V = re.compile(r"^v=(\d+)$")
#: Tasks that write one index, at most.
_SPREAD = 64


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions under ``root``, ascending."""
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = _V.match(st.getPath().getName())
        if m and st.isDirectory():
            ok = jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
            if fs.exists(ok):
                out.append(int(m.group(1)))
    return sorted(out)


def latest_version(spark: SparkSession, root: str) -> int | None:
    vs = versions(spark, root)
    return vs[-1] if vs else None


def _ordered(df: DataFrame) -> DataFrame:
    metas = [m for m in META_NAMES if m in df.columns]
    rest = [c for c in df.columns if c not in META_NAMES]
    return df.select(*metas, *[F.col("`" + c + "`") for c in rest])


def read_index(spark: SparkSession, root: str, index: str | Iterable[str] | None = None,
               version: int | None = None, source_fields: Iterable[str] | None = None,
               meta_fields: Iterable[str] | None = None) -> DataFrame:
    """Flat documents of ``index`` (all indices when None) at ``version``
    (latest committed when None)."""
    if version is None:
        version = latest_version(spark, root)
        if version is None:
            raise FileNotFoundError(f"no committed version under {root}")
    elif version not in versions(spark, root):
        raise FileNotFoundError(f"version {version} is not committed under {root}")
    path = f"{root}/v={version}"
    # index names are text: give the partition column its type explicitly
    # (an index named "007" must not be read as the number 7)
    data = [f for f in spark.read.parquet(path).schema.fields if f.name != "_index"]
    df = spark.read.schema(StructType(data + [StructField("_index", StringType(), True)])).parquet(path)
    if index is not None:
        names = [index] if isinstance(index, str) else list(index)
        df = df.where(F.col("_index").isin(names))
    df = _ordered(df)
    if source_fields is not None or meta_fields is not None:
        from docindex.sources.schema import select_meta, select_source
        src = select_source([c for c in df.columns if c not in META_NAMES], source_fields)
        metas = [m for m in select_meta(meta_fields) if m in df.columns]
        df = df.select(*metas, *src)
    return df


def write_index(df: DataFrame, root: str, index: str | None = None,
                version: int | None = None) -> int:
    """Write flat documents as a new committed version; returns it.

    ``index`` names the index of every row; otherwise the ``_index`` column
    routes rows (several indices in one write), an index in as many files as
    the session has shuffle partitions at most.  One writer at a time: a second
    one mostly fails on the version it finds, but a rename is no lock, least of
    all on an object store.
    """
    if index is not None:
        df = df.withColumn("_index", F.lit(index))
    if "_index" not in df.columns:
        raise ValueError("documents need an index: pass index= or an _index column")
    if version is None:
        last = latest_version(spark_of(df), root)
        version = 1 if last is None else last + 1
    attempt = f"{root}/.attempt-{uuid.uuid4().hex}"
    if index is None and "_id" in df.columns:
        # rows of an index go to few tasks, so files don't multiply
        spread = max(_SPREAD, int(spark_of(df).conf.get("spark.sql.shuffle.partitions")))
        df = df.repartition("_index", F.pmod(F.xxhash64("_id"), F.lit(spread)))
    df.write.mode("errorifexists").partitionBy("_index").parquet(attempt)
    fs, src, jvm = _fs(spark_of(df), attempt)
    target = jvm.org.apache.hadoop.fs.Path(f"{root}/v={version}")
    if fs.exists(target) or not fs.rename(src, target):
        raise FileExistsError(f"version {version} exists under {root}: another writer was first")
    return version


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def write_bulk(df: DataFrame, root: str, index: str | None = None, op_type: str | None = None,
               source_fields: Iterable[str] | None = None,
               meta_fields: Iterable[str] | None = None, order_col: str | None = None,
               version: int | None = None) -> int:
    """The local bulk sink: shape rows into actions, apply them to the latest
    version (empty when there is none) and commit the result as the next."""
    from docindex.operators.bulk import apply_bulk, bulk_actions

    spark = spark_of(df)
    actions = bulk_actions(df, index=index, op_type=op_type, source_fields=source_fields,
                           meta_fields=meta_fields, order_col=order_col)
    last = latest_version(spark, root)
    if last is None:
        schema = "_index string, _id string, _version bigint, _seq_no bigint, _primary_term bigint"
        current = spark.createDataFrame([], schema)
    else:
        current = read_index(spark, root, version=last)
    new = apply_bulk(current, actions, order_col=order_col)
    return write_index(new, root, version=version or (last or 0) + 1)
