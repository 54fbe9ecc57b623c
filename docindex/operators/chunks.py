"""Chunks of a stream of bulk actions, by rows and bytes.

A writer sends a stream in requests of at most ``max_rows`` actions and
``max_bytes`` bytes, and closes a request only when the next action would not
fit.  Where a request ends depends on where it began, for the whole stream; yet
each row can be told at once where a request that begins with it would end.
These pointers are doubled (followed twice, then four times, ...) while the set of
rows that begin requests grows from the first row on: a number of steps
logarithmic in the number of requests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docindex.session import scratch_path


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chunks(rows: DataFrame, stream: str, order: Sequence[str], size: str, max_rows: int = 500, max_bytes: int = 100 * 1024 * 1024) -> DataFrame:
    """``stream``, ``order`` columns and ``size`` of all rows with ``chunk``, from
    0 in each stream.

    ``stream`` names what one task sends, in the order of the ``order`` columns
    (which tell its rows apart); a window goes over one stream, so a stream is
    as large as a task's input may be.  ``size`` is an action's bytes (null: 0).
    A row above ``max_bytes`` is a chunk of its own.
    """
    if max_rows < 1 or max_bytes < 1:
        raise ValueError("a chunk holds one row and one byte at least")
    place = Window.partitionBy(stream).orderBy(*order)
    so_far = place.rowsBetween(Window.unboundedPreceding, -1)
    bytes_ = F.coalesce(F.col(size).cast("long"), F.lit(0))
    numbered = rows.select(F.col(stream), *[F.col(c) for c in order], bytes_.alias("__size"), (F.row_number().over(place) - 1).cast("long").alias("__i"),
                           F.coalesce(F.sum(bytes_).over(so_far), F.lit(0)).alias("__start"))
    numbered = _stored(numbered, "stream")
    # a last row stands for the stream's end
    ends = numbered.groupBy(stream).agg((F.max("__i") + 1).alias("__i"), F.max(F.col("__start") + F.col("__size")).alias("__start"))
    line = numbered.select(stream, "__i", "__start").unionByName(ends)
    # rows that begin within max_bytes of this one: as many fit, less this one
    reach = Window.partitionBy(stream).orderBy("__start").rangeBetween(Window.currentRow, max_bytes)
    last = Window.partitionBy(stream).orderBy("__start", "__i").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # rows of no bytes begin where this one does, some of them before it
    fits = F.max("__i").over(reach) - F.col("__i")
    jump = line.select(stream, "__i", F.max("__i").over(last).alias("__end"), F.greatest(F.lit(1), F.least(F.lit(max_rows), fits)).alias("__n"))
    jump = _stored(jump.select(stream, "__i", F.least("__end", F.col("__i") + F.col("__n")).alias("__to")), "pointers")
    begun = _stored(ends.select(stream, F.lit(0).cast("long").alias("__i")), "begun")
    known = begun.count()
    while known:
        begun = _stored(begun.unionByName(begun.join(jump, [stream, "__i"]).select(stream, F.col("__to").alias("__i"))).distinct(), "begun")
        found = begun.count()
        if found == known:
            break
        known = found
        then = jump.select(F.col(stream).alias("__s"), F.col("__i").alias("__to"), F.col("__to").alias("__next"))
        jump = _stored(jump.join(then, (F.col(stream) == F.col("__s")) & (jump["__to"] == then["__to"])).select(stream, "__i", F.col("__next").alias("__to")), "pointers")
    first = begun.withColumn("__first", F.lit(1))
    number = F.sum(F.coalesce("__first", F.lit(0))).over(Window.partitionBy(stream).orderBy("__i")) - 1
    return numbered.join(first, [stream, "__i"], "left").select(stream, *order, F.col("__size").alias(size), number.cast("long").alias("chunk"))
