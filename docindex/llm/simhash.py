"""Near duplicates by SimHash fingerprints, compared through pivot tables.

A fingerprint is 64 bits: bit b is set if more than half of the hashes of a
text's word shingles have it.  Texts link when their fingerprints differ in at
most ``limit`` bits.

For every fingerprint a table holds its Hamming distances to PIVOTS reference
fingerprints.  By the triangle inequality two fingerprints at distance r have
distances to any reference that differ by at most r: a pair whose coordinates
differ by more than ``limit`` somewhere is discarded, and what is left is
verified on the fingerprints.

Pivots alone would leave every pair to be discarded one by one, which grows
with the square of the corpus, so tables are compared cell by cell: of limit +
1 disjoint groups of bits a linked pair agrees on one at least, and each
agreement is a cell.  Cells of more than HEAVY fingerprints are cut again by
limit + 1 groups of the bits that they have not used yet.  Cells whose bits are
nearly used up are bounded by the number of codes left in them (4096).

Equal fingerprints are one row from the start, and each block of cells hands
on a spanning forest of its links, never all pairs of a group.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, components, joined_words, lean, lean_group, runs, stored, word_slices

BITS = 64
#: Words of a shingle, and the seed of its XXH64 hash.
WIDTH, SEED = 3, 42
#: Reference fingerprints of the distance table.
PIVOTS = np.random.default_rng(64).integers(0, 2**64, 32, dtype=np.uint64)
#: Cells with more fingerprints are cut again while more than LEAST_BITS are unused.
HEAVY, LEAST_BITS = 1024, 12
#: Fingerprints of one block of cells, about, and the least number of blocks.
BLOCK, LEAST_BLOCKS = 100_000, 64
#: Shingles whose bits are counted at once, and pairs merged at once.
CHUNK = 1 << 16
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def fingerprints(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, number of shingles) of each text of a run of texts."""
    docs = len(offs) - 1
    text = LOWER[buf]
    s, e, first = word_slices(text, offs)
    words = np.diff(first)
    line = joined_words(text, offs, s, e, first, np.ones(len(s), bool))
    raw, at = as_bytes(line)
    # where each word begins and ends in the joined text
    size = e - s
    ends = np.cumsum(size + 1) - 1 - np.repeat(np.cumsum(words > 0) - 1, words)
    begins = ends - size
    width = np.minimum(words, WIDTH)
    n = np.where(words > 0, words - width + 1, 0)
    upto = np.append(0, np.cumsum(n))
    head = np.arange(int(upto[-1])) + np.repeat(first[:-1] - upto[:-1], n)
    tail = head + np.repeat(width - 1, n)
    data, digest = raw.tobytes(), xxhash.xxh64_intdigest
    votes = np.zeros((docs, BITS), np.int64)
    owner = np.repeat(np.arange(docs), n)
    for i in range(0, len(head), CHUNK):
        a, b = begins[head[i:i + CHUNK]].tolist(), ends[tail[i:i + CHUNK]].tolist()
        h = np.fromiter((digest(data[x:y], SEED) for x, y in zip(a, b)), np.uint64, len(a))
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        who = owner[i:i + CHUNK]
        new = np.append(0, np.flatnonzero(np.diff(who)) + 1)
        votes[who[new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int64)
    on = np.packbits(2 * votes > n[:, None], axis=1, bitorder="little")
    return on.reshape(-1).view("<u8").astype(np.uint64), n


def _print(batches):
    for batch in batches:
        buf, offs = as_bytes(batch.column("text"))
        for i, j in runs(offs):
            code, n = fingerprints(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in ("row", "id")), pa.array(code.view(np.int64)), pa.array(n)],
                                             names=["row", "id", "code", "n_shingles"])


def simhash(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (a struct of the other columns), id, code (the fingerprint as a
    long) and n_shingles of each document.  Texts without words, null and
    empty ones included, have the fingerprint zero."""
    bounded_batches(docs.sparkSession)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    df = docs.select(F.struct(*rest).alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kind = df.schema["row"].dataType.simpleString()
    return df.mapInArrow(lean(_print), f"row {kind}, id long, code long, n_shingles long")


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _cuts(used: int, parts: int) -> list[int]:
    """The unused bits in ``parts`` groups of about equal size, as masks."""
    free = [b for b in range(BITS) if not used >> b & 1]
    return [sum(1 << b for b in free[len(free) * k // parts:len(free) * (k + 1) // parts]) for k in range(parts)]


def _cells(codes: DataFrame, limit: int, heavy: int) -> list[DataFrame]:
    """Frames of (code, cell), cells of more than one code each: all codes that
    agree on the cell's bits."""
    spark = codes.sparkSession
    rows = codes.select("code", F.lit(0).cast("long").alias("used"), F.lit(0).cast("long").alias("cell"))
    paths, out = [0], []
    while paths:
        # limit + 1 cuts a path: a few thousand rows at most, at any input size
        table = [(_signed(u), _signed(m)) for u in paths for m in _cuts(u, limit + 1)]
        cuts = spark.createDataFrame(table, "used long, mask long")
        rows = rows.join(F.broadcast(cuts), "used")
        rows = rows.select("code", F.col("used").bitwiseOR(F.col("mask")).alias("used"),
                           F.xxhash64("cell", "mask", F.col("code").bitwiseAND(F.col("mask"))).alias("cell"))
        # different cells of one name only mean more pairs to discard
        sizes = rows.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
        rows = stored(rows.join(sizes, "cell"), "cells")
        paths = {u | m for u in paths for m in _cuts(u, limit + 1)}
        paths = [u for u in sorted(paths) if BITS - u.bit_count() > LEAST_BITS]
        cut = (F.col("n") > heavy) & F.col("used").isin([_signed(u) for u in paths])
        out.append(rows.where(~cut).select("code", "cell"))
        rows = rows.where(cut).select("code", "used", "cell")
        if rows.isEmpty():
            break
    return out


class _Forest:
    """Which items hang together; merges whole arrays of pairs."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            self.root[np.maximum(x, y)] = np.minimum(x, y)
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def near_pairs(code: np.ndarray, cell: np.ndarray, limit: int):
    """Arrays (a, b) of the pairs of rows of one cell whose codes differ in at
    most ``limit`` bits; rows come ordered by cell and first coordinate."""
    table = [np.bitwise_count(code ^ p).astype(np.int8) for p in PIVOTS]
    i, k = np.arange(len(code)), 1
    while len(i):
        i = i[:np.searchsorted(i, len(code) - k)]
        # beyond the first coordinate's reach there is nothing for this row
        i = i[(cell[i] == cell[i + k]) & (table[0][i + k] - table[0][i] <= limit)]
        a, b = i, i + k
        for t in table[1:]:
            near = np.abs(t[a] - t[b]) <= limit
            a, b = a[near], b[near]
            if not len(a):
                break
        ok = np.bitwise_count(code[a] ^ code[b]) <= limit
        yield a[ok], b[ok]
        k += 1


def _links(limit: int):
    def run(block: pa.Table) -> pa.Table:
        code = block.column("code").to_numpy().astype(np.int64).view(np.uint64)
        cell = block.column("cell").to_numpy()
        order = np.lexsort((np.bitwise_count(code ^ PIVOTS[0]), cell))
        code, cell = code[order], cell[order]
        forest, held, n = _Forest(len(code)), [], 0
        for a, b in near_pairs(code, cell, limit):
            held.append((a, b))
            n += len(a)
            if n >= CHUNK:
                forest.join(*map(np.concatenate, zip(*held)))
                held, n = [], 0
        if held:
            forest.join(*map(np.concatenate, zip(*held)))
        linked = np.flatnonzero(forest.root != np.arange(len(code)))
        c = code.view(np.int64)
        return pa.table({"a": c[linked], "b": c[forest.root[linked]]})
    return run


def code_links(codes: DataFrame, limit: int = 3, heavy: int = HEAVY) -> DataFrame:
    """(a, b): links between the distinct codes of ``codes`` (column code) that
    join the same codes as all pairs within ``limit`` bits do."""
    cells = _cells(codes, limit, heavy)
    rows = cells[0]
    for more in cells[1:]:
        rows = rows.unionByName(more)
    blocks = max(LEAST_BLOCKS, math.ceil(rows.count() / BLOCK))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cell"), F.lit(blocks)))
    return rows.groupBy("block").applyInArrow(lean_group(_links(limit)), "a long, b long")


def near_duplicates(docs: DataFrame, limit: int = 3, id_col: str = "doc_id", text: str = "text", heavy: int = HEAVY) -> DataFrame:
    """``row`` (a struct of the other columns), id, code, n_shingles and
    component_id (the smallest id reachable by links, its own included) of each
    document.

    Texts without words have code zero and link like any other.  Rows without
    id link too, but give no component its name (null if no member has an id).
    Repeated rows and ids are separate members of one component; very long
    texts are counted whole; columns of any name travel in ``row``.
    """
    prints = stored(simhash(docs, id_col, text), "prints")
    codes = stored(prints.groupBy("code").agg(F.min("id").alias("least")), "codes")
    roots = components(docs.sparkSession, code_links(codes, limit, heavy))
    member = codes.join(roots.withColumnRenamed("node", "code"), "code", "left").withColumn("root", F.coalesce("root", "code"))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(member.join(least, "root").select("code", "component_id"), "members")
    return prints.join(named, "code").select("row", "id", "code", "n_shingles", "component_id")
