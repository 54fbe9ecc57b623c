"""The hit model: metadata columns plus a nested ``_source`` struct.

``as_hits`` turns any table into an index, ``flatten_hits`` spreads
``_source`` next to the metadata (what a reader returns), ``nest_hits`` goes
back.  All three are projections: Catalyst collapses them, so column pruning
and filter pushdown still reach the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docindex.sources.schema import META_FIELDS, META_NAMES, select_meta, select_source


def _meta_col(name: str, value) -> Column:
    dt = META_FIELDS[name].dataType
    if isinstance(value, Column):
        return value.cast(dt).alias(name)
    return F.lit(value).cast(dt).alias(name)


def as_hits(df: DataFrame, index: str | Column, id_col: str | Column | None = None,
            version: int = 1, seq_col: str | None = None, type_name: str | None = "_doc",
            primary_term: int = 1) -> DataFrame:
    """Wrap a table as hits of ``index``.

    ``_id`` is the string form of ``id_col`` (null when no id column; the
    documents then have no stable identity).  ``_seq_no`` comes from
    ``seq_col`` when given.  ``_score`` is null: scores are not tracked.
    """
    if isinstance(id_col, str):
        id_expr = F.col(id_col)
    elif id_col is None:
        id_expr = F.lit(None)
    else:
        id_expr = id_col
    source = F.struct(*[F.col("`" + c + "`") for c in df.columns if c not in META_NAMES])
    return df.select(
        _meta_col("_index", index),
        _meta_col("_type", type_name),
        _meta_col("_id", id_expr),
        _meta_col("_version", version),
        _meta_col("_seq_no", F.col(seq_col) if seq_col else None),
        _meta_col("_primary_term", primary_term),
        _meta_col("_score", None),
        source.alias("_source"),
    )


def flatten_hits(hits: DataFrame, source_fields: Iterable[str] | None = None,
                 meta_fields: Iterable[str] | None = None) -> DataFrame:
    """Metadata columns (except ``_source``) next to the ``_source`` fields.

    A source field wins over a metadata column of the same name.  Field
    lists select (unknown names ignored); ``id`` and ``_id`` are the same.
    """
    src_names = [f.name for f in hits.schema["_source"].dataType.fields]
    src = select_source(src_names, source_fields)
    metas = [m for m in select_meta(meta_fields) if m in hits.columns and m not in src]
    cols = [F.col(m) for m in metas] + [F.col("_source").getField(n).alias(n) for n in src]
    return hits.select(*cols)


def nest_hits(flat: DataFrame) -> DataFrame:
    """Metadata columns stay, every other column goes under ``_source``."""
    metas = [c for c in flat.columns if c in META_NAMES]
    src = [c for c in flat.columns if not c.startswith("_")]
    return flat.select(*[F.col(m) for m in metas],
                       F.struct(*[F.col("`" + c + "`") for c in src]).alias("_source"))


def slice_column(n: int, id_col: str = "_id") -> Column:
    """Slice number in ``[0, n)`` from a hash of the id.

    Slices are disjoint and together complete; each is one task's share.
    """
    if n < 1:
        raise ValueError("slices must be >= 1")
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(n)).cast("int")


def read_slice(flat: DataFrame, slice_id: int, slices: int, id_col: str = "_id") -> DataFrame:
    """One slice of a snapshot, as a sliced read task would return it."""
    if not 0 <= slice_id < slices:
        raise ValueError("slice id out of range")
    return flat.where(slice_column(slices, id_col) == F.lit(slice_id))
