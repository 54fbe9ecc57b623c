"""Sharding by proportional stratified interleaving, in DataFrame functions.

Rows are ranked within their source in a seeded random order; rank divided by
the source's size is a row's fractional rank.  Sorted by it, every stretch of
rows has the sources in proportion, so cutting the order into equal counts
gives shards that all match the mixture.

No sort has more than a bucket of rows in one task.  Seeded hashes fall evenly
into buckets; counts of (source, bucket) and running sums over them give the
rank at which each bucket starts, so that a window only ranks the rows of one
bucket of one source.  The cut works the same way on buckets of fractional
rank.  Running sums go in two steps, within groups of GROUP buckets and over
these groups.  Equal rows share a hash; a bucket that they make much larger than
the others is dealt into parts by the rows' numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Rows that one window group ranks, about.
GROUP_ROWS = 4_000
#: Buckets whose running sum one window group makes.
GROUP = 1_000
#: A bucket of more than so many times GROUP_ROWS is dealt into parts.
HOT = 4
_PARTS = 1 << 24


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def running_sums(counts: DataFrame, bucket: str, by: list[str]) -> DataFrame:
    """``counts`` (columns ``by``, ``bucket``, c) with ``start``: the sum of c
    over the smaller buckets of the same ``by``.  No window has more than
    GROUP buckets, or a row for each GROUP buckets."""
    group = F.expr(f"{bucket} div {GROUP * (_PARTS if by else 1)}")
    upto = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.withColumn("__g", group)
    inside = parts.withColumn("__in", F.coalesce(F.sum("c").over(upto.partitionBy(*by, "__g").orderBy(bucket)), F.lit(0)))
    sums = parts.groupBy(*by, "__g").agg(F.sum("c").alias("__c"))
    over = upto.partitionBy(*by) if by else upto
    sums = sums.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("__g").alias("__gg"), F.coalesce(F.sum("__c").over(over.orderBy("__g")), F.lit(0)).alias("__over"))
    same = F.col("__g") == F.col("__gg")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return inside.join(sums, same).select(*by, bucket, "c", (F.col("__in") + F.col("__over")).alias("start"))


def _named(rows: DataFrame, *own: str) -> list[Column]:
    """The columns of ``row`` under their names; those named as ours get a
    trailing underscore (or more, until the name is free)."""
    out, taken = [], {c.lower() for c in rows.columns} | set(own)
    for c in rows.columns:
        name = c
        while name.lower() in own or (name != c and name.lower() in taken):
            name += "_"
        taken.add(name.lower())
        out.append(F.col(f"row.`{c}`").alias(name))
    return out


def _interleaved(rows: DataFrame, source: str, order: list[str], seed: int) -> DataFrame:
    """(row, position, total)"""
    whole = F.struct(*[_quoted(c) for c in rows.columns])
    numbered = stored(rows.select(whole.alias("row"), F.monotonically_increasing_id().alias("u")), "rows")
    n = numbered.count()
    fine = 1
    while fine * GROUP_ROWS < n:
        fine *= 2
    h = F.xxhash64(F.lit(seed), *[F.col(f"row.`{c}`") for c in order])
    keyed = numbered.select("row", F.col(f"row.`{source}`").alias("src"), "u", h.alias("h")).withColumn("b", (F.shiftrightunsigned("h", 40) % F.lit(fine)) * F.lit(_PARTS))
    # buckets of equal rows: at most one for each HOT * GROUP_ROWS rows
    large = keyed.groupBy("src", "b").agg(F.count("*").alias("c")).where(F.col("c") > HOT * GROUP_ROWS)
    large = stored(large.select(F.col("src").alias("s0"), F.col("b").alias("b0"), F.expr(f"least(c div {GROUP_ROWS}, {_PARTS - 1})").alias("parts")), "large")
    keyed = keyed.join(large, F.col("src").eqNullSafe(F.col("s0")) & (F.col("b") == F.col("b0")), "left")
    keyed = keyed.select("row", "src", "u", "h", (F.col("b") + F.coalesce(F.pmod(F.xxhash64("u"), F.col("parts")), F.lit(0))).alias("b"))
    # rank within the source: start of the bucket, and rank in the bucket
    sizes = stored(keyed.groupBy("src", "b").agg(F.count("*").alias("c")), "strata")
    every = sizes.groupBy("src").agg(F.sum("c").alias("n")).withColumnRenamed("src", "s2")
    starts = running_sums(sizes, "b", ["src"]).join(every, F.col("src").eqNullSafe(F.col("s2"))).select(F.col("src").alias("s1"), F.col("b").alias("b1"), "start", "n")
    starts = stored(starts, "starts")
    ranked = (keyed.withColumn("r", F.row_number().over(Window.partitionBy("src", "b").orderBy("h", "u")) - 1)
              .join(starts, F.col("src").eqNullSafe(F.col("s1")) & (F.col("b") == F.col("b1")))
              .withColumn("f", (F.col("start") + F.col("r") + 0.5) / F.col("n")).select("row", "src", "h", "u", "f", F.floor(F.col("f") * fine).cast("long").alias("fb")))
    # position: the same over buckets of the fractional rank
    ranked = stored(ranked, "ranked")
    cuts = running_sums(ranked.groupBy("fb").agg(F.count("*").alias("c")), "fb", []).select(F.col("fb").alias("cb"), "start")
    return (ranked.withColumn("r", F.row_number().over(Window.partitionBy("fb").orderBy("f", "src", "h", "u")) - 1)
            .join(cuts, F.col("fb") == F.col("cb")).select("row", (F.col("start") + F.col("r")).alias("position"), F.lit(n).cast("long").alias("total")))


def interleave(rows: DataFrame, source: str, order: list[str], seed: int) -> DataFrame:
    """``rows`` with ``position`` (0, 1, ... over all rows) and ``total``.

    ``order`` names columns that tell rows apart; rows equal in all of them
    are interchangeable.  A null source is a source of its own.  A column of
    ``rows`` that is named ``position`` or ``total`` gets a trailing underscore.
    """
    return _interleaved(rows, source, order, seed).select(*_named(rows, "position", "total"), "position", "total")


def shard(rows: DataFrame, shards: int, source: str = "source", order: list[str] = ["doc_id"], seed: int = 17) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (0, 1, ... in
    each shard).  Shards differ by one row at most.

    Null ids, sources and texts are values like others, texts of any length
    travel whole; repeated rows each get a slot of their own.  With fewer rows
    than shards some shards stay empty; an empty table gives no rows.  A column
    of ``rows`` that is named ``shard`` or ``slot`` gets a trailing underscore.
    """
    placed = _interleaved(rows, source, order, seed)
    number = F.expr(f"(position * {shards}) div total")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    placed = placed.withColumn("shard", number.cast("int")).withColumn("slot", (F.col("position") - first).cast("long"))
    return placed.select(*_named(rows, "shard", "slot"), "shard", "slot")
