"""Removal of long repeated byte strings with a logarithmic family of
suffix arrays.

A byte of a document goes when a string of ``span`` bytes that covers it also
starts in a document with a smaller doc_id.

Every string of ``span`` bytes has one head: the ``head`` bytes in it whose
name is least.  The suffixes that begin at heads form the sampled suffix
array of a batch: equal strings have equal heads, so all long matches lie
between suffixes with equal heads.  Suffixes are ordered by names of their
leading bytes (any total order on strings brings equal prefixes together),
and arrays are cut into buckets by name.

Batches are ranges of ascending doc_id.  Each new batch is sorted into an
array of its own, merge-scanned against the arrays of the levels that exist
(an old suffix can only remove bytes of a newer document, never the other way
round), and equal-sized levels merge: L batches leave about log2(L) arrays.
A level is a table bucketed by name, one row a bucket, so that scans and
merges read it in place and shuffle nothing.

Suffixes whose head the scan found in two documents are then compared by
their whole context, that is all strings of ``span`` bytes with that head: a
string is removed from every document but the one with the smallest doc_id.
The work on texts goes by blocks of a table that is written once; one block
sends each distinct context once, so a passage that a third of all documents
share costs a row a block, not a row a document.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docindex.session import scratch_path

from .common import Names, as_bytes, bounded_batches, lean, lean_group, mix, partitions, runs, stored, unique


@dataclass(frozen=True)
class Shape:
    span: int = 50
    head: int = 24

    @property
    def choices(self) -> int:
        """Positions in a string of ``span`` bytes at which a head can start."""
        return self.span - self.head + 1


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    have, m = 1, x
    while have * 2 <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    rest = width - have
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def segments(buf: np.ndarray, offs: np.ndarray, shape: Shape):
    """(name of the head, name of the context, first string, strings, row)
    of each run of neighbouring strings with one head in a run of texts."""
    none = np.zeros(0, np.uint64)
    span, most = shape.span, shape.choices
    if len(buf) < span:
        return none, none, *(np.zeros(0, np.int64),) * 3
    names = Names(buf)
    least = sliding_least(names.of_width(shape.head), most)
    total = len(buf) - span + 1
    least = least[:total]
    size = np.diff(offs)
    row = np.repeat(np.arange(len(size)), size)[:total]
    inside = np.ones(len(buf) + span, bool)
    for cut in (offs[1:],):
        at = (cut[:, None] - np.arange(1, span)[None, :]).ravel()
        inside[at[at >= 0]] = False
    # a text shorter than span hides no string of its neighbour
    inside = inside[:total]
    start = np.empty(total, bool)
    start[0] = True
    np.not_equal(least[1:], least[:-1], out=start[1:])
    start[1:] |= row[1:] != row[:-1]
    start[1:] |= inside[1:] != inside[:-1]
    first = np.flatnonzero(start)
    length = np.diff(np.append(first, total))
    ok = inside[first]
    first, length = first[ok], length[ok]
    # runs of more strings than a head can have (repeats) are cut
    parts = -(-length // most)
    if len(parts) and parts.max() > 1:
        which = np.repeat(np.arange(len(first)), parts)
        k = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
        first = first[which] + k * most
        length = np.minimum(length[which] - k * most, most)
    context = names.of(first, first + length + span - 1)
    return mix(least[first]), context, first, length, row[first]


def _codes(head: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket, and the 32-bit name within it.  Two heads that share both only
    cost a comparison of contexts."""
    return (head % np.uint64(buckets)).astype(np.int64), (head >> np.uint64(32)).astype(np.uint32)


_HEADS = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("heads", pa.binary())])


def _heads(shape: Shape, buckets: int):
    """Sorted heads of each block, by bucket; twice if two documents have it."""
    def run(batches):
        for batch in batches:
            blocks = batch.column("block").to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            buf, offs = as_bytes(batch.column("text"))
            found = []
            for i, j in runs(offs):
                head, _, _, _, row = segments(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], shape)
                row = row + i
                keep = known[row]
                found.append((head[keep], row[keep]))
            if not found:
                continue
            head, row = (np.concatenate(x) for x in zip(*found))
            bucket, code = _codes(head, buckets)
            block, doc = blocks[row], ids[row]
            order = np.lexsort((doc, code, bucket, block))
            bucket, code, block, doc = bucket[order], code[order], block[order], doc[order]
            same = np.zeros(len(code), bool)
            same[1:] = (code[1:] == code[:-1]) & (bucket[1:] == bucket[:-1]) & (block[1:] == block[:-1])
            new = ~same
            new[1:] |= doc[1:] != doc[:-1]
            bucket, code, block = bucket[new], code[new], block[new]
            cut = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1]))) if len(code) else np.zeros(0, np.int64)
            ends = np.append(cut[1:], len(code))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cut].astype(np.int32)), pa.array(block[cut].astype(np.int32)),
                                              pa.array([code[a:b].tobytes() for a, b in zip(cut.tolist(), ends.tolist())], pa.binary())], schema=_HEADS)
    return run


_LEVEL = pa.schema([("bucket", pa.int32()), ("heads", pa.binary()), ("blocks", pa.binary())])
LEVEL = "bucket int, heads binary, blocks binary"


def _level(bucket: int, heads: np.ndarray, blocks: np.ndarray) -> dict:
    """Sorted, each head at most twice a block."""
    order = np.lexsort((blocks, heads))
    heads, blocks = heads[order], blocks[order]
    third = np.zeros(len(heads), bool)
    third[2:] = (heads[2:] == heads[:-2]) & (blocks[2:] == blocks[:-2])
    return {"bucket": bucket, "heads": heads[~third].tobytes(), "blocks": blocks[~third].tobytes()}


def _sort_batch(table: pa.Table) -> pa.Table:
    parts = [np.frombuffer(x, np.uint32) for x in table.column("heads").to_pylist()]
    blocks = np.repeat(table.column("block").to_numpy().astype(np.int32), [len(x) for x in parts])
    return pa.Table.from_pylist([_level(table.column("bucket")[0].as_py(), np.concatenate(parts), blocks)], schema=_LEVEL)


def _arrays(heads, blocks) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(heads, np.uint32), np.frombuffer(blocks, np.int32)) if heads is not None else (np.zeros(0, np.uint32), np.zeros(0, np.int32))


def _merge(batches):
    for batch in batches:
        for r in batch.to_pylist():
            (h0, b0), (h1, b1) = _arrays(r["heads"], r["blocks"]), _arrays(r["heads1"], r["blocks1"])
            yield pa.RecordBatch.from_pylist([_level(r["bucket"], np.concatenate([h0, h1]), np.concatenate([b0, b1]))], schema=_LEVEL)


def _within(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of ``a`` occur in the sorted ``b``."""
    if not len(b):
        return np.zeros(len(a), bool)
    return b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a


def _scan(levels: int):
    """Merge-scan of a batch against older levels: the heads that two
    documents have, for every block that has them."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                head, block = _arrays(r["heads"], r["blocks"])
                if not len(head):
                    continue
                same = head[1:] == head[:-1]
                hit = np.append(same, False) | np.append(False, same)
                out = []
                for i in range(1, levels + 1):
                    h, b = _arrays(r[f"heads{i}"], r[f"blocks{i}"])
                    hit |= _within(head, h)
                    old = _within(h, head)
                    out.append((h[old], b[old]))
                out.append((head[hit], block[hit]))
                heads, blocks = (np.concatenate(x) for x in zip(*out))
                order = np.lexsort((heads, blocks))
                heads, blocks = heads[order], blocks[order]
                cut = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])) if len(heads) else np.zeros(0, np.int64)
                ends = np.append(cut[1:], len(heads))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cut), r["bucket"], np.int32)), pa.array(blocks[cut]),
                                                  pa.array([heads[x:y].tobytes() for x, y in zip(cut.tolist(), ends.tolist())], pa.binary())], schema=_HEADS)
    return run


class Levels:
    """The arrays of one index: (size in batches, table) of each level, oldest
    and largest first."""

    def __init__(self, spark, tables: int):
        self.spark, self.tables, self.levels, self.found = spark, tables, [], []

    def _save(self, df: DataFrame) -> DataFrame:
        name = unique("suffixes")
        df.write.bucketBy(self.tables, "bucket").option("path", scratch_path(self.spark, name)).saveAsTable(name)
        return self.spark.table(name)

    def add(self, heads: DataFrame) -> DataFrame:
        """Sort a batch, scan it against the levels, keep it as a level;
        returns (bucket, block, heads) of suffixes to compare."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, a), (m, b) = self.levels[-2:]
            both = a.join(b.select("bucket", F.col("heads").alias("heads1"), F.col("blocks").alias("blocks1")), "bucket", "full")
            self.levels[-2:] = [(n + m, self._save(both.mapInArrow(_merge, LEVEL)))]
        new = self._save(heads.groupBy("bucket").applyInArrow(_sort_batch, LEVEL))
        scan = new
        for i, (_, old) in enumerate(self.levels, 1):
            scan = scan.join(old.select("bucket", F.col("heads").alias(f"heads{i}"), F.col("blocks").alias(f"blocks{i}")), "bucket", "left")
        hits = stored(scan.mapInArrow(_scan(len(self.levels)), "bucket int, block int, heads binary"), "hits")
        self.levels.append((1, new))
        return hits


CONTEXT = "bucket int, block int, heads binary, docs binary, rows binary, starts binary, counts binary, bytes binary"
_CONTEXT = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), *((n, pa.binary()) for n in ("heads", "docs", "rows", "starts", "counts", "bytes"))])
SPANS = "block int, spans binary"
_SPANS = pa.schema([("block", pa.int32()), ("spans", pa.binary())])
_SPAN = np.dtype([("row", "<u4"), ("start", "<u4"), ("end", "<u4")])


def _ranks(keys: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's rank among the distinct keys of its block (equal on every
    reading), and the distinct keys."""
    keys = keys.to_numpy()
    distinct, rank = np.unique(keys, return_inverse=True)
    return rank.reshape(-1), distinct


def _contexts(shape: Shape, buckets: int, gather: int):
    """Of one block: each distinct context with a found head once, with the
    smallest doc_id that has it; the block's other documents lose it here."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _CONTEXT.empty_table()
        block = left.column("block")[0].as_py()
        wanted = np.unique(np.concatenate([(np.uint64(b) << np.uint64(32)) | np.frombuffer(x, np.uint32).astype(np.uint64)
                                           for b, x in zip(right.column("bucket").to_pylist(), right.column("heads").to_pylist())]))
        rank, _ = _ranks(left.column("key"))
        ids = left.column("doc_id").combine_chunks()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        buf, offs = as_bytes(left.column("text"))
        found = []
        for i, j in runs(offs):
            head, context, first, length, row = segments(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], shape)
            bucket, code = _codes(head, buckets)
            keep = known[row + i] & _within((bucket.astype(np.uint64) << np.uint64(32)) | code.astype(np.uint64), wanted)
            found.append((head[keep], context[keep], first[keep] + offs[i], length[keep], row[keep] + i))
        head, context, first, length, row = (np.concatenate(x) for x in zip(*found))
        doc = ids[row]
        both = mix(head) ^ context
        order = np.lexsort((doc, both))
        head, both, first, length, row, doc = (x[order] for x in (head, both, first, length, row, doc))
        if not len(head):
            return _CONTEXT.empty_table()
        new = np.append(True, both[1:] != both[:-1])
        least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        mine = doc == least
        rows = []
        at = first - offs[row]
        local = np.empty(int((~mine).sum()), _SPAN)
        local["row"], local["start"], local["end"] = rank[row][~mine], at[~mine], (at + length + shape.span - 1)[~mine]
        if len(local):
            rows.append({"bucket": -1 - block, "block": block, "rows": local.tobytes()})
        head, first, length, row, doc, at = (x[mine] for x in (head, first, length, row, doc, at))
        part = (mix(head) % np.uint64(gather)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part = part[order]
        cut = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(part)]):
            o = order[a:b]
            size = length[o] + shape.span - 1
            ends = np.cumsum(size)
            index = np.arange(int(ends[-1])) + np.repeat(first[o] - (ends - size), size)
            rows.append({"bucket": int(part[a]), "block": block, "heads": head[o].tobytes(), "docs": doc[o].astype(np.int64).tobytes(), "rows": rank[row[o]].astype(np.uint32).tobytes(),
                         "starts": at[o].astype(np.uint32).tobytes(), "counts": length[o].astype(np.uint8).tobytes(), "bytes": pa.compress(buf[index].tobytes(), "zstd", asbytes=True)})
        return pa.Table.from_pylist(rows, schema=_CONTEXT)
    return run


def _compare(shape: Shape):
    """Of one bucket: the strings that a smaller doc_id has too, as spans."""
    def run(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:  # found within a block
            return pa.Table.from_arrays([table.column("block"), table.column("rows")], schema=_SPANS)
        doc, row, start, count = (np.concatenate([np.frombuffer(x, t) for x in table.column(n).to_pylist()])
                                  for n, t in (("docs", np.int64), ("rows", np.uint32), ("starts", np.uint32), ("counts", np.uint8)))
        count = count.astype(np.int64)
        block = np.repeat(table.column("block").to_numpy(), [len(x) for x in table.column("counts").to_pylist()])
        buf = np.frombuffer(b"".join(pa.CompressedInputStream(pa.BufferReader(x), "zstd").read() for x in table.column("bytes").to_pylist()), np.uint8)
        size = count + shape.span - 1
        ends = np.cumsum(size)
        begin = ends - size
        entry = np.repeat(np.arange(len(count)), count)
        k = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count)
        name = np.empty(len(entry), np.uint64)
        for i, j in runs(np.append(0, ends)):
            lo, hi = np.searchsorted(entry, [i, j])
            s = begin[entry[lo:hi]] + k[lo:hi] - begin[i]
            name[lo:hi] = Names(buf[begin[i]:ends[j - 1]]).of(s, s + shape.span)
        order = np.argsort(name, kind="stable")
        name = name[order]
        cut = np.flatnonzero(np.append(True, name[1:] != name[:-1]))
        least = np.minimum.reduceat(doc[entry[order]], cut)
        gone = np.empty(len(entry), bool)
        gone[order] = np.repeat(least, np.diff(np.append(cut, len(name)))) < doc[entry[order]]
        entry, k = entry[gone], k[gone]
        if not len(entry):
            return _SPANS.empty_table()
        new = np.append(True, (entry[1:] != entry[:-1]) | (k[1:] != k[:-1] + 1))
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(entry)) - 1
        spans = np.empty(len(a), _SPAN)
        e = entry[a]
        spans["row"], spans["start"], spans["end"] = row[e], start[e] + k[a], start[e] + k[b] + shape.span
        order = np.argsort(block[e], kind="stable")
        spans, at = spans[order], block[e][order]
        cut = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        return pa.Table.from_arrays([pa.array(at[cut].astype(np.int32)), pa.array([spans[x:y].tobytes() for x, y in zip(cut.tolist(), [*cut[1:].tolist(), len(spans)])], pa.binary())], schema=_SPANS)
    return run


def _cut_out(left: pa.Table, right: pa.Table) -> pa.Table:
    """Of one block: whole texts without their spans, a run at a time."""
    buf, offs = as_bytes(left.column("text"))
    n = len(offs) - 1
    owner = start = end = np.zeros(0, np.int64)
    if right.num_rows:
        rank, distinct = _ranks(left.column("key"))
        told = np.frombuffer(b"".join(right.column("spans").to_pylist()), _SPAN)
        by = np.argsort(rank, kind="stable")
        lo = np.searchsorted(rank[by], np.arange(len(distinct)))
        size = np.searchsorted(rank[by], np.arange(len(distinct)), side="right") - lo
        # rows that repeat a document have its spans, too
        times = size[told["row"]]
        which = np.repeat(np.arange(len(told)), times)
        copy = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
        owner = by[lo[told["row"][which]] + copy]
        order = np.argsort(owner, kind="stable")
        owner, start, end = owner[order], told["start"][which[order]].astype(np.int64), told["end"][which[order]].astype(np.int64)
    removed, counts, starts, ends, texts = [], [], [], [], []
    for i, j in runs(offs):
        part, o = buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        a, b = np.searchsorted(owner, [i, j])
        if a == b:
            removed.append(np.zeros(j - i, np.int64))
            counts.append(np.zeros(j - i, np.int64))
            texts.append(part)
            continue
        edge = np.zeros(len(part) + 1, np.int32)
        np.add.at(edge, o[owner[a:b] - i] + start[a:b], 1)
        np.add.at(edge, o[owner[a:b] - i] + end[a:b], -1)
        gone = np.cumsum(edge[:-1], dtype=np.int32) > 0
        total = np.append(0, np.cumsum(gone))
        removed.append(total[o[1:]] - total[o[:-1]])
        first, last = gone.copy(), gone.copy()
        first[1:] &= ~gone[:-1]
        last[:-1] &= ~gone[1:]
        border = o[1:-1][(o[1:-1] < len(part)) & (o[1:-1] > 0)]
        first[border], last[border - 1] = gone[border], gone[border - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        count = np.diff(np.searchsorted(s, o))
        base = np.repeat(o[:-1], count)
        counts.append(count)
        starts.append(s - base)
        ends.append(e - base)
        texts.append(part[~gone])
    whole = lambda x, t: np.concatenate([np.zeros(0, t), *x]).astype(t)
    removed, counts = whole(removed, np.int64), whole(counts, np.int64)
    size = np.diff(offs)
    spans = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)),
                                     pa.StructArray.from_arrays([pa.array(whole(starts, np.int64)), pa.array(whole(ends, np.int64))], names=["start", "end"]))
    upto = np.append(0, np.cumsum(size - removed)).astype(np.int32)
    kept = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(upto), pa.py_buffer(whole(texts, np.uint8))])
    return pa.Table.from_arrays([left.column("row"), *(pa.chunked_array([x]) for x in (pa.array(size), pa.array(removed), spans, kept))],
                                names=["row", "n_bytes", "n_removed", "spans", "kept"])


def _whole(batches):
    for batch in batches:
        out = []
        for kept, spans in zip(batch.column("kept").to_pylist(), batch.column("spans").to_pylist()):
            text, at, gone = [], 0, 0
            for s in spans:  # kept bytes before each removed span
                text.append(kept[at:s["start"] - gone])
                at, gone = s["start"] - gone, gone + s["end"] - s["start"]
            out.append("".join(x.decode("utf-8", "ignore") for x in [*text, kept[at:]]))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "kept_text"])


def with_kept_text(removed: DataFrame) -> DataFrame:
    """``removed`` (as from ``remove_repeats``) with kept_text: what is left, in
    whole characters.  A character of which a removed span took a part goes
    with it; between spans nothing changes, U+FFFD of the text included."""
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in removed.schema)
    return removed.mapInArrow(lean(_whole), f"{kind}, kept_text string")


def remove_repeats(docs: DataFrame, shape: Shape = Shape(), batches: int = 4, block_bytes: int = 4 << 20) -> DataFrame:
    """``row`` (a struct of all columns of ``docs`` but text), n_bytes,
    n_removed, spans (list of removed start and end, in bytes, maximal) and
    kept (the remaining bytes) for every row of ``docs`` (doc_id, text, ...).

    A null or empty text has no bytes and loses none.  Rows with a null doc_id
    have no place in the order: they lose nothing and take nothing from
    others.  Rows that share a doc_id take nothing from each other.  Texts
    shorter than ``span`` stay whole.  ``batches`` and ``block_bytes`` change
    the work, not the result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.struct(*rest).alias("row"))
    cuts = [i / batches for i in range(1, batches)]
    total, marks = docs.agg(F.sum(F.octet_length("text")), F.percentile_approx("doc_id", cuts or [0.5], 1000)).first()
    total, marks = int(total or 0), sorted(set(marks or []))[:batches - 1] if batches > 1 else []
    splits = max(1, docs.rdd.getNumPartitions())
    share = max(1, math.ceil(total / splits / batches / block_bytes))
    number = F.lit(0)
    for m in marks:
        number = number + F.when(F.col("doc_id") > m, 1).otherwise(0)
    number = F.coalesce(number, F.lit(0))
    # a block is what one reading task has of one batch, cut by id if large
    block = ((F.spark_partition_id() * batches + number) * share + F.pmod(F.xxhash64("doc_id"), F.lit(share))).cast("int")
    tables = max(partitions(spark), min(splits * batches * share, 100_000))
    name = unique("blocks")
    (docs.select(block.alias("block"), number.alias("batch"), F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text", "row")
     .write.bucketBy(tables, "block").option("compression", "zstd").option("path", scratch_path(spark, name)).saveAsTable(name))
    blocks = spark.table(name)

    # about 2 / (choices + 1) of all positions are heads; 2 MB of them a bucket
    entries = 2 * total / (shape.choices + 1)
    buckets = max(64, math.ceil(entries * 8 / (2 << 20)))
    levels = Levels(spark, max(partitions(spark), 64))
    hits = None
    for b in range(len(marks) + 1):
        found = levels.add(blocks.where(F.col("batch") == b).select("block", "doc_id", "text").mapInArrow(lean(_heads(shape, buckets)), "bucket int, block int, heads binary"))
        hits = found if hits is None else hits.unionByName(found)
    gather = max(64, math.ceil(entries * 80 / (16 << 20)))
    contexts = (blocks.select("block", "key", "doc_id", "text").groupBy("block").cogroup(hits.groupBy("block")).applyInArrow(lean_group(_contexts(shape, buckets, gather)), CONTEXT))
    spans = stored(contexts.groupBy("bucket").applyInArrow(lean_group(_compare(shape)), SPANS), "spans")
    out = "row %s, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary" % blocks.schema["row"].dataType.simpleString()
    return (blocks.select("block", "key", "text", "row").groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(lean_group(_cut_out), out))
