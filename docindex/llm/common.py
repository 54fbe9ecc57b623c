"""Helpers that the operators share: scratch tables, bounded Arrow batches,
byte views of string columns, and connected components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docindex.session import scratch_path

#: Largest Arrow batch, in bytes, that the JVM hands to a Python worker.
BATCH_BYTES = 4 << 20
#: Texts are worked on in runs of about so many bytes (at least one text).
RUN_BYTES = 1 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches end by bytes as well as by rows (session setting;
    kept if the session has its own)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in (None, str(2**31 - 1), str(2**63 - 1), "-1"):
        spark.conf.set(key, str(BATCH_BYTES))


def trim() -> None:
    """Give freed memory of this Python worker back; workers outlive tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to do
        pass


def lean(batches_fn):
    """A function of batches that leaves no memory behind in its worker."""
    def run(batches):
        try:
            yield from batches_fn(batches)
        finally:
            trim()
    return run


def lean_group(group_fn):
    """The same for a function of whole groups."""
    def one(table):
        try:
            return group_fn(table)
        finally:
            trim()

    def two(left, right):
        try:
            return group_fn(left, right)
        finally:
            trim()
    return two if group_fn.__code__.co_argcount == 2 else one


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage,
    and a lost executor costs a re-read instead of a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    schema = df.schema
    return spark.read.schema(schema).parquet(path)


def as_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        width = np.int64
    else:
        width = np.int32
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    _, off, data = col.buffers()
    offs = np.frombuffer(off, width, n + 1 + col.offset)[col.offset:].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def runs(offs: np.ndarray, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of about ``limit`` bytes, one row at least."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


#: Random odd value of each byte, and the base of the polynomial names.
BYTE_VALUE = (np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15


class Names:
    """64-bit names of byte slices, from prefix sums of a polynomial modulo
    2**64: equal slices have equal names, and the name of any slice costs one
    subtraction and one multiplication.

    For slices of bounded width, and where a name only chooses a feature or a
    bucket.  Slices of about a thousand bytes and more can be built to share a
    name (Thue-Morse words do), so names of words that decide come from
    ``word_names``."""

    _up = np.ones(1, np.uint64)
    _down = np.ones(1, np.uint64)

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        if len(Names._up) < n + 1:
            size = max(n + 1, RUN_BYTES + (1 << 16))
            for name, base in (("_up", BASE), ("_down", pow(BASE, -1, 2**64))):
                a = np.full(size, base, np.uint64)
                a[0] = 1
                setattr(Names, name, np.multiply.accumulate(a))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUE[buf] * Names._up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * Names._down[start] + (end - start).astype(np.uint64))

    def of_width(self, width: int) -> np.ndarray:
        """Names of all slices of one width, by start."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[width:] - self.sums[:n]) * Names._down[:n] + np.uint64(width))


def components(spark: SparkSession, edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``edges``
    (columns a, b; both long).

    Alternates two steps until nothing changes: every node hands its smallest
    neighbour to its larger neighbours, then to its smaller ones.  A round is
    two grouped minima with joins; hot nodes are split by the adaptive skew
    join, and each round's edges are written to the shared folder.
    """
    cur = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    before = None
    while True:
        # large step: larger neighbours of v go to the least node around v
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.where("a <> m").select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        large = stored(large, label)
        # small step: v and its smaller neighbours go to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        nxt = stored(small, label)
        sign = nxt.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        cur = nxt
        if sign == before:
            break
        before = sign
    roots = cur.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return stored(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()), label)


def unique(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


#: ASCII white space: the only bytes that end a word.
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True


def word_slices(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first) of the words of a run of texts: byte ranges in
    ``buf``, and how many words lie before each text (and before the end)."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    word = ~WHITE[buf]
    begin, stop = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    stop[:-1] &= ~word[1:]
    head, tail = offs[:-1][offs[:-1] < n], offs[1:][offs[1:] > 0] - 1
    begin[head] = word[head]
    stop[tail] = word[tail]
    start = np.flatnonzero(begin)
    return start, np.flatnonzero(stop) + 1, np.searchsorted(start, offs)


def word_codes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal bytes and only for those;
    ``start`` and ``end`` as from ``word_slices``."""
    size = np.append(0, np.cumsum(end - start))
    data = np.ascontiguousarray(buf[~WHITE[buf]])
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(size), pa.py_buffer(data)])
    return words.dictionary_encode().indices.to_numpy()


def word_names(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit name of each word, from its bytes alone: each distinct word is
    hashed once, by a hash without the structure of a polynomial."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = np.append(0, np.cumsum(end - start))
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(size), pa.py_buffer(np.ascontiguousarray(buf[~WHITE[buf]]))]).dictionary_encode()
    names = np.fromiter(map(xxhash.xxh3_64_intdigest, words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    return names[words.indices.to_numpy()]


def joined_words(buf: np.ndarray, offs: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one blank."""
    k = np.flatnonzero(keep)
    upto = np.searchsorted(k, first)  # kept words before each text
    follows = np.ones(len(k), bool)  # by another kept word of its text
    follows[upto[1:][upto[1:] > upto[:-1]] - 1] = False
    s, e = start[k], end[k] + follows  # the white space after a word becomes the blank
    step = np.zeros(len(buf) + 2, np.int8)
    step[s] += 1
    step[e] -= 1
    # ranges touch where one white space parts two words: their steps cancel
    data = np.where(WHITE[buf], np.uint8(32), buf)[np.cumsum(step[:len(buf)], dtype=np.int8) > 0]
    size = np.append(0, np.cumsum(e - s))[upto]
    return pa.Array.from_buffers(pa.large_string(), len(offs) - 1, [None, pa.py_buffer(size.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
