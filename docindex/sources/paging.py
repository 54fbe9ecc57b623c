"""Pages in sort order, without a task that orders everything.

A deep scan asks for a page after the last sort key of the page before
(``rows_after``).  ``pages`` finds all page boundaries at once: the sort keys are
dealt out by ranges and sorted within them, each range is counted, and running
sums of these counts give every row its position.  The id breaks ties, so a sort
key that a third of all rows share is dealt over many ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docindex.session import scratch_path

Sort = Sequence[str | tuple[str, str]]
#: ``monotonically_increasing_id`` counts rows of a partition in so many bits.
_ROW_BITS = 33


def _keys(sort: Sort, id_col: str) -> list[tuple[str, str]]:
    """(column, direction) of each key, ending with the id."""
    keys = [(k, "asc") if isinstance(k, str) else (k[0], str(k[1]).lower()) for k in sort]
    if any(d not in ("asc", "desc") for _, d in keys):
        raise ValueError(f"a sort direction is asc or desc: {sort!r}")
    return keys if id_col in [k for k, _ in keys] else [*keys, (id_col, "asc")]


def _quoted(name: str) -> Column:
    return F.col("`" + name + "`")


def _orders(keys: list[tuple[str, str]]) -> list[Column]:
    """Missing values come last in either direction, as on a server."""
    return [_quoted(k).asc_nulls_last() if d == "asc" else _quoted(k).desc_nulls_last() for k, d in keys]


def positions(df: DataFrame, sort: Sort, id_col: str = "_id", ranges: int | None = None) -> DataFrame:
    """The sort keys of ``df`` (and its id) with ``position``, from 0."""
    spark = df.sparkSession
    keys = _keys(sort, id_col)
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (df.select(*[_quoted(k) for k, _ in keys]).repartitionByRange(n, *_orders(keys)).sortWithinPartitions(*_orders(keys))
             .withColumn("__at", F.monotonically_increasing_id()))
    # written once: a range's sample, and with it the places, could change
    path = scratch_path(spark, "positions")
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path).withColumn("__range", F.shiftrightunsigned("__at", _ROW_BITS))
    # a row a range: bounded by ``ranges``
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    starts = counts.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    row = F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return dealt.join(F.broadcast(starts), "__range").select(*[_quoted(k) for k, _ in keys], (F.col("__start") + row).alias("position"))


def pages(df: DataFrame, sort: Sort, size: int, id_col: str = "_id", ranges: int | None = None) -> DataFrame:
    """(page, first, last, rows) of all pages of ``size`` rows in sort order;
    ``first`` and ``last`` are structs of the sort keys and the id."""
    if size < 1:
        raise ValueError("a page has one row at least")
    placed = positions(df, sort, id_col, ranges)
    key = F.struct(*[_quoted(k) for k, _ in _keys(sort, id_col)])
    page = F.expr(f"position div {size}").alias("page")
    total = placed.agg(F.count(F.lit(1))).scalar()
    first = placed.where(F.col("position") % size == 0).select(page, key.alias("first"))
    last = placed.where((F.col("position") % size == size - 1) | (F.col("position") == total - 1))
    last = last.select(page, key.alias("last"), (F.col("position") % size + 1).alias("rows"))
    return first.join(last, "page")


def after(sort: Sort, key: Sequence, id_col: str = "_id") -> Column:
    """Whether a row comes after ``key`` (a value for each sort key and the id)."""
    keys = _keys(sort, id_col)
    if len(key) != len(keys):
        raise ValueError(f"a key has {len(keys)} values")
    out, same = F.lit(False), F.lit(True)
    for (name, direction), v in zip(keys, key):
        c = _quoted(name)
        if v is None:
            beyond = F.lit(False)  # nothing comes after a missing value
        else:
            beyond = c.isNull() | (c > F.lit(v) if direction == "asc" else c < F.lit(v))
        out = out | (same & beyond)
        same = same & c.eqNullSafe(F.lit(v))
    return out


def rows_after(df: DataFrame, sort: Sort, size: int, key: Sequence | None = None, id_col: str = "_id") -> DataFrame:
    """The page of ``size`` rows after ``key`` (the first page without one):
    each task hands on its ``size`` first rows only."""
    rows = df if key is None else df.where(after(sort, key, id_col))
    return rows.orderBy(*_orders(_keys(sort, id_col))).limit(size)
