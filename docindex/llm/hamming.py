"""Exact top-k search over binary codes by multi-index hashing.

A code of ``BITS`` bits is cut into segments, each indexed by its value.  Two
codes at Hamming distance d agree on some segment up to d // segments bits, so
once all segments have been probed to radius s, every code within
segments * (s + 1) - 1 has been met.  Radii grow by one a round; a query is
done when its k-th verified distance lies within that bound.

Equal codes are one index entry that keeps its k smallest ids: no more of them
can be in a result, and a code that a third of all rows share is one entry.
Queries with equal codes are searched once.  When probes would outnumber the
distinct codes, the queries still open are compared with all of them in
blocks, which is exact as well.  A block hands on only each query's nearest
candidates, never all of them.

A segment's entries lie in blocks by their value, and a query goes only to blocks
that can hold one of its probe values.  A value that more than BLOCK_CODES codes
share is dealt over blocks of its own, and only probes for it go there.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BITS = 64
#: Codes of one block of a segment, about.
BLOCK_CODES = 500_000


def sign_code(vector: Column, bits: int = BITS) -> Column:
    """A bit for each of the first ``bits`` numbers: 1 if above 0.  Missing,
    null and NaN numbers give 0; a null vector has no code."""
    code = F.lit(0).cast("long")
    for i in range(bits):
        v = F.get(vector, F.lit(i))
        code = code.bitwiseOR(F.shiftleft(F.when((v > 0) & ~F.isnan(v), F.lit(1)).otherwise(F.lit(0)).cast("long"), i))
    return F.when(vector.isNotNull(), code)


def _segments(code: Column, segments: int) -> list[Column]:
    width = BITS // segments
    return [F.shiftrightunsigned(code, i * width).bitwiseAND(F.lit((1 << width) - 1)).cast("long") for i in range(segments)]


def _masks(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in c) for c in combinations(range(width), radius)]


def _probe(masks: list[int], k: int):
    """Of one block of a segment: each query's candidates, that is the codes
    whose value differs from the query's by one of ``masks``; of these the k
    nearest, and all as near as the last of them."""
    flips = np.array(masks, np.int64)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros((4, 0), np.int64)]
        if left.num_rows and right.num_rows:
            v, code, c = (right.column(n).to_numpy().astype(np.int64) for n in ("v", "code", "c"))
            order = np.argsort(v, kind="stable")
            v, code, c = v[order], code[order], c[order]
            value, first = np.unique(v, return_index=True)
            size = np.diff(np.append(first, len(v)))
            for q, x in zip(left.column("q").to_pylist(), left.column("v").to_pylist()):
                probe = flips ^ x
                at = np.minimum(np.searchsorted(value, probe), len(value) - 1)
                at = at[value[at] == probe]
                n = size[at]
                rows = np.arange(int(n.sum())) + np.repeat(first[at] - (np.cumsum(n) - n), n)
                d = np.bitwise_count((code[rows] ^ q).view(np.uint64)).astype(np.int64)
                if len(rows) > k:
                    near = d <= np.partition(d, k - 1)[k - 1]
                    rows, d = rows[near], d[near]
                out.append(np.stack([np.full(len(rows), q, np.int64), code[rows], c[rows], d]))
        q, code, c, d = np.concatenate(out, axis=1)
        return pa.table({"q": q, "code": code, "c": c, "d": d.astype(np.int32)})
    return run


def _own_block(value: Column, part: Column) -> Column:
    """The number of a part of a heavy value, apart from all other blocks."""
    return -1 - F.pmod(F.xxhash64(value, part), F.lit(1 << 40))


def _asked(open_: DataFrame, segments: int, masks: list[int], blocks: int, heavy: DataFrame | None) -> DataFrame:
    """(q, s, v, b): each open query for the blocks that can hold an entry whose
    value differs from its own by one of ``masks``."""
    rows = open_.select("q", F.posexplode(F.array(*_segments(F.col("q"), segments))).alias("s", "v"))
    if len(masks) >= blocks:
        every = rows.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    else:
        own = [F.pmod(F.xxhash64(F.col("v").bitwiseXOR(F.lit(m))), F.lit(blocks)) for m in masks]
        every = rows.withColumn("b", F.explode(F.array_distinct(F.array(*own))))
    if heavy is None:
        return every
    probes = rows.withColumn("p", F.explode(F.array(*[F.col("v").bitwiseXOR(F.lit(m)) for m in masks])))
    probes = probes.join(heavy, (F.col("s") == F.col("hs")) & (F.col("p") == F.col("hv")))
    probes = probes.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    return every.unionByName(probes.select("q", "s", "v", _own_block(F.col("p"), F.col("part")).alias("b")))


def top_k(points: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", segments: int | None = None) -> DataFrame:
    """For each row of ``queries`` (id, code) its ``k`` nearest rows of
    ``points`` (id, code): query_id, rank (from 1), id and distance; nearer
    first, then smaller ids.  A query meets itself if it is among the points.

    Rows without code are neither found nor answered; a null id is left out.
    Rows that repeat an id with the same code count once.  Fewer than k
    points give fewer rows.
    """
    p = points.select(F.col(id_col).cast("long").alias("id"), F.col("code")).where("id is not null and code is not null")
    q = queries.select(F.col(id_col).cast("long").alias("query_id"), F.col("code").alias("q")).where("query_id is not null and q is not null").distinct()
    # the k smallest ids of each code, ranked in buckets first
    few = Window.partitionBy("code", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
    least = Window.partitionBy("code").orderBy("id")
    p = p.distinct().withColumn("r", F.row_number().over(few)).where(F.col("r") <= k).withColumn("r", F.row_number().over(least)).where(F.col("r") <= k)
    ids = stored(p.select("id", "code"), "ids")
    codes = stored(ids.groupBy("code").agg(F.count("*").alias("c")), "codes")
    n = codes.count()
    if segments is None:
        # segments of about log2(n) bits: a value has about one entry
        segments = min((m for m in (2, 4, 8, 16) if BITS // m <= 16), key=lambda m: abs(BITS / m - math.log2(max(n, 2))))
    width = BITS // segments
    # a segment's values lie in blocks of bounded size, heavy values in several
    blocks = max(8, math.ceil(n / BLOCK_CODES))
    index = codes.select("code", "c", F.posexplode(F.array(*_segments(F.col("code"), segments))).alias("s", "v"))
    heavy = index.groupBy("s", "v").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK_CODES)
    heavy = stored(heavy.select(F.col("s").alias("hs"), F.col("v").alias("hv"), F.ceil(F.col("n") / BLOCK_CODES).cast("long").alias("parts")), "heavy")
    some_heavy = not heavy.isEmpty()
    index = index.withColumn("b", F.pmod(F.xxhash64("v"), F.lit(blocks)))
    if some_heavy:
        part = F.pmod(F.xxhash64("code"), F.col("parts"))
        index = index.join(heavy, (F.col("s") == F.col("hs")) & (F.col("v") == F.col("hv")), "left")
        index = index.select("code", "c", "s", "v", F.when(F.col("parts").isNull(), F.col("b")).otherwise(_own_block(F.col("v"), part)).alias("b"))
    index = stored(index, "index")
    open_ = stored(q.select("q").distinct(), "queries")
    best, radius = None, 0
    done = []
    while True:
        waiting = open_.count()
        if not waiting:
            break
        masks = math.comb(width, radius)
        if radius > width or masks * segments >= max(n, 1):
            # as many probes as codes: compare with all, in blocks of codes
            spread = open_.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).withColumn("v", F.lit(0).cast("long"))
            every = codes.withColumn("b", F.pmod(F.xxhash64("code"), F.lit(blocks))).withColumn("v", F.lit(0).cast("long"))
            found = spread.groupBy("b").cogroup(every.groupBy("b")).applyInArrow(_probe([0], k), "q long, code long, c long, d int")
            done.append(_nearest(found, k))
            break
        asked = _asked(open_, segments, _masks(width, radius), blocks, heavy if some_heavy else None)
        found = asked.groupBy("s", "b").cogroup(index.groupBy("s", "b")).applyInArrow(_probe(_masks(width, radius), k), "q long, code long, c long, d int")
        if best is not None:
            found = found.unionByName(best.join(open_, "q"))
        best = stored(_nearest(found, k), "nearest")
        bound = segments * (radius + 1) - 1
        # done: the verified codes within the bound hold k ids
        full = best.where(F.col("d") <= bound).groupBy("q").agg(F.sum("c").alias("ids")).where(F.col("ids") >= k).select("q")
        closed = stored(open_.join(full, "q"), "closed")
        done.append(best.join(closed, "q"))
        open_ = stored(open_.join(closed, "q", "left_anti"), "queries")
        radius += 1
    if not done:
        found = ids.limit(0).select(F.col("code").alias("q"), "code", F.lit(0).cast("long").alias("c"), F.lit(0).alias("d"))
        done = [found]
    near = done[0]
    for d in done[1:]:
        near = near.unionByName(d)
    order = Window.partitionBy("q").orderBy("d", "id")
    ranked = near.select("q", "code", "d").join(ids, "code").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return q.join(stored(ranked.select("q", "rank", "id", "d"), "ranked"), "q").select("query_id", "rank", "id", F.col("d").cast("int").alias("distance"))


def _nearest(found: DataFrame, k: int) -> DataFrame:
    """Of each query, the distinct codes that can hold its k nearest ids: all
    codes up to the distance at which k codes are reached."""
    w = Window.partitionBy("q").orderBy("d")
    return found.distinct().withColumn("r", F.rank().over(w)).where(F.col("r") <= k).drop("r")
