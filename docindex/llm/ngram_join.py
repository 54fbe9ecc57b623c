"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents are sets of word shingles; two documents link when the Jaccard
similarity of their sets reaches a threshold.  All shingles have one global
order, rare ones first.  The l-prefix of a set of n shingles, of which any
partner must share at least o, is its first n - o + l shingles: two linked
sets share at least l (and, by their sizes, mostly many more) of them.  Each
document takes the l whose estimated cost is least: a longer prefix costs
more entries, but demands more shared entries before a pair is verified.

Stages
1. one scan: set size and 128-bit digest of each document, and a fixed-size
   frequency sketch over the shingles of all documents;
2. second scan: each document's prefix, packed by hash bucket;
3. per bucket, the lists of documents that share a shingle.  Short lists give
   counted pairs.  Long lists (large groups of copies, common passages) stay
   rows; they give pairs with a few leading members only;
4. pairs with enough shared entries are verified on the whole texts and give
   links, the links give components;
5. the lists that still span several components are taken together by their
   largest component; their minority members meet all members, in blocks of
   bounded size, by size, shared entries and bitmaps of the whole sets.  Pairs
   of different components that pass are verified too: no link is missed.

Texts with equal sets form one class from the start and meet as one member.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, components, lean, lean_group, mix, partitions, runs, stored, word_names

#: The sketch has 2**SKETCH_BITS counters, at any input size.
SKETCH_BITS = 21
CHUNKS = 64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_K = np.uint64(0xA0761D6478BD642F)


@dataclass(frozen=True)
class Similarity:
    """Links when intersection / union >= num / den; ``width`` words a shingle."""

    num: int = 3
    den: int = 4
    width: int = 5

    def least(self, n):
        """Shared shingles that a set of n needs with any partner."""
        return -(-self.num * n // self.den)

    def shared(self, n, m):
        """Shared shingles that sets of n and m need."""
        return -(-self.num * (n + m) // (self.num + self.den))


def shingle_sets(buf: np.ndarray, offs: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle names of each text of a run.

    Words are runs of bytes other than ASCII white space, with A-Z in lower
    case.  A text of fewer than ``width`` words is one shingle; a text without
    words has none.
    """
    n, empty = len(buf), np.zeros(0, np.uint64)
    docs = len(offs) - 1
    if n == 0:
        return [empty] * docs
    text = LOWER[buf]
    word = ~SPACE[text]
    start, end = np.empty(n, bool), np.empty(n, bool)
    start[0], end[-1] = True, True
    start[1:], end[:-1] = ~word[:-1], ~word[1:]
    start[offs[:-1][offs[:-1] < n]] = True
    end[offs[1:][offs[1:] > 0] - 1] = True
    s, e = np.flatnonzero(start & word), np.flatnonzero(end & word) + 1
    w = word_names(text, s, e)
    first = np.searchsorted(s, offs)
    m = len(w) - width + 1
    if m > 0:
        h = w[:m].copy()
        for j in range(1, width):
            h = h * _K + w[j:j + m]
        h = mix(h)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            u = np.sort(h[a:b - width + 1])
            if len(u) > 1:
                keep = np.empty(len(u), bool)
                keep[0] = True
                np.not_equal(u[1:], u[:-1], out=keep[1:])
                u = u[keep]
            out.append(u)
        elif b > a:
            v = b - a
            for x in w[a:b].tolist():
                v = (v * 0xA0761D6478BD642F + x) & (2**64 - 1)
            out.append(mix(np.array([v ^ 0x5851F42D4C957F2D], np.uint64)))
        else:
            out.append(empty)
    return out


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sets) of each run of a batch with a ``text`` column."""
    buf, offs = as_bytes(batch.column("text"))
    for i, j in runs(offs):
        yield i, shingle_sets(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], width)


META = "doc_id long, n long, d0 long, d1 long, chunk int, counts binary"


def _meta(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d0", pa.int64()), ("d1", pa.int64()), ("chunk", pa.int32()), ("counts", pa.binary())])

    def run(batches):
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            sizes, digests = [], []
            for _, sets in _sets(batch, width):
                sizes += [len(u) for u in sets]
                digests += [hashlib.blake2b(u, digest_size=16).digest() for u in sets]
                every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                np.add.at(sketch, (every >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1) if len(every) < 4096 else \
                    sketch.__iadd__(np.bincount((every >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch)))
            d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            k = len(sizes)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1]),
                                              pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], schema=schema)
        if sketch.any():
            parts = [pa.compress(x.astype(np.int64).tobytes(), "zstd", asbytes=True) for x in np.split(sketch, CHUNKS)]
            none = pa.nulls(CHUNKS, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(range(CHUNKS), pa.int32()), pa.array(parts, pa.binary())], schema=schema)
    return run


def _add_chunks(batches):
    size = (1 << SKETCH_BITS) // CHUNKS
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, blob in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
            x = np.frombuffer(pa.decompress(blob, size * 8, "zstd", asbytes=True), np.int64)
            sums[k] = sums[k] + x if k in sums else x
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["chunk", "counts"])


def sketch_of(meta: DataFrame) -> np.ndarray:
    """Counters over the shingles of all documents: 2**SKETCH_BITS numbers,
    whatever the input, so that they may go to every task."""
    spark = meta.sparkSession
    rows = (meta.where("chunk is not null").select("chunk", "counts").repartition(min(CHUNKS, partitions(spark)), "chunk")
            .mapInArrow(_add_chunks, "chunk int, counts binary").collect())
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    size = len(out) // CHUNKS
    for r in rows:
        out[r.chunk * size:(r.chunk + 1) * size] = np.frombuffer(r.counts, np.int64)
    return out


def prefix_levels(u: np.ndarray, excess: np.ndarray, sim: Similarity, most: int) -> tuple[np.ndarray, int]:
    """Positions of the chosen prefix within ``u``, and its level l.

    ``excess`` estimates in how many other documents each shingle occurs.
    With l shared entries asked for, at most sum(excess) / l documents can
    become candidates, each worth a verification of n steps; an l-prefix has
    n - o + l entries to be listed.  The l with the least total wins.
    """
    n = len(u)
    o = int(sim.least(n))
    order = np.argsort(excess, kind="stable")
    base = n - o
    top = min(most, o)
    partners = np.cumsum(excess[order[:base + top]].astype(np.float64))
    level = np.arange(1, top + 1)
    cost = (base + level) + partners[base:base + top] + n * partners[base:base + top] / level
    l = int(np.argmin(cost)) + 1
    return order[:base + l], l


POSTING = "bucket int, docs binary, tokens binary"
_DOC = np.dtype([("doc", "<i8"), ("digest", "<u8"), ("n", "<u4"), ("l", "<u2"), ("count", "<u4")])
_TOKEN = np.dtype([("token", "<u8"), ("level", "u1")])


def _postings(sim: Similarity, sketch, buckets: int, most: int, hot: float):
    schema = pa.schema([("bucket", pa.int32()), ("docs", pa.binary()), ("tokens", pa.binary())])

    def pack(rows):
        """One row a bucket: documents with entries in it, and these entries."""
        tok = np.concatenate([r[0] for r in rows])
        lev = np.concatenate([r[1] for r in rows])
        heat = np.concatenate([r[2] for r in rows])
        head = np.zeros(len(rows), _DOC)
        for i, r in enumerate(rows):
            head[i] = r[3]
        idx = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
        bucket = (tok % np.uint64(buckets)).astype(np.int64)
        # entries of very common shingles are not gathered: they only pass
        spread = buckets + (mix(head["doc"].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        bucket = np.where(heat >= hot, spread[idx], bucket)
        order = np.argsort(bucket, kind="stable")
        bucket, idx = bucket[order], idx[order]
        ent = np.empty(len(order), _TOKEN)
        ent["token"], ent["level"] = tok[order], lev[order]
        cut = np.flatnonzero(np.diff(bucket, prepend=-1))
        out = ([], [], [])
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(bucket)]):
            if a == b:
                continue
            who, count = np.unique(idx[a:b], return_counts=True)
            h = head[who]
            h["count"] = count
            out[0].append(int(bucket[a]))
            out[1].append(pa.compress(h.tobytes(), "zstd", asbytes=True))
            out[2].append(np.ascontiguousarray(ent[a:b]["token"]).tobytes() + np.ascontiguousarray(ent[a:b]["level"]).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], schema=schema)

    def run(batches):
        counts = sketch.value
        usual = counts.mean()
        usual += 2 * math.sqrt(usual)
        rows, held, seen = [], 0, {}
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for i, sets in _sets(batch, sim.width):
                for doc, u in zip(ids[i:i + len(sets)], sets):
                    if doc is None or not len(u):
                        continue
                    digest = int.from_bytes(hashlib.blake2b(u, digest_size=16).digest()[:8], "little")
                    if seen.get(digest, doc + 1) <= doc:
                        continue  # an equal set with a smaller id of this block stands for it
                    seen[digest] = doc
                    excess = np.maximum(counts[(u >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] - usual, 0)
                    at, l = prefix_levels(u, excess, sim, most)
                    base = len(u) - int(sim.least(len(u)))
                    level = np.maximum(np.arange(len(at)) - base + 1, 1).astype(np.uint8)
                    rows.append((u[at], level, excess[at], (doc, digest, len(u), l, 0)))
                    held += len(at)
                    if held >= 1 << 19:
                        yield pack(rows)
                        rows, held, seen = [], 0, {}
        if rows:
            yield pack(rows)
    return run


#: Bits of a set's bitmap.
BITMAP = 4096


def _bitmaps(width: int):
    """The bitmap of each text's set.  With d bits that differ, sets of n and
    m shingles differ in d or more, so they share (n + m - d) / 2 at most."""
    def run(batches):
        for batch in batches:
            out = []
            for _, sets in _sets(batch, width):
                for u in sets:
                    bits = np.zeros(BITMAP, np.uint8)
                    bits[(u >> np.uint64(20)).astype(np.int64) % BITMAP] = 1
                    out.append(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], names=["a", "bits"])
    return run


def _pairs_of(sim: Similarity):
    """Of one block: pairs of different components that sizes, shared entries
    and bitmaps allow."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        a, n, s, rest, comp = (left.column(c).to_numpy().astype(np.int64) for c in ("a", "n", "s", "rest", "comp"))
        b, m, s_b, rest_b, comp_b = (right.column(c).to_numpy().astype(np.int64) for c in ("a", "n", "s", "rest", "comp"))
        found = [np.zeros((2, 0), np.int64)]
        if len(a) and len(b):
            x, y = (np.frombuffer(b"".join(t.column("bits").to_pylist()), np.uint64).reshape(-1, BITMAP // 64) for t in (left, right))
            minor = right.column("minor").to_numpy()
            for i in range(len(a)):
                total = sim.shared(n[i], m)
                ok = np.flatnonzero((comp_b != comp[i]) & (sim.den * np.minimum(n[i], m) >= sim.num * np.maximum(n[i], m)) & (np.minimum(s[i], s_b) + np.maximum(rest[i], rest_b) >= total) & (~minor | (a[i] < b)))
                far = np.bitwise_count(x[i] ^ y[ok]).sum(axis=1, dtype=np.int64)
                ok = ok[n[i] + m[ok] - far >= 2 * total[ok]]
                found.append(np.stack([np.minimum(a[i], b[ok]), np.maximum(a[i], b[ok])]))
        pairs = np.concatenate(found, axis=1)
        return pa.table({"a": pairs[0].astype(np.int64), "b": pairs[1].astype(np.int64)})
    return run


def _across(met: DataFrame, sim: Similarity, few: int = 2000, many: int = 20_000) -> DataFrame:
    """Candidate pairs between the minority members of the lists around one
    component and all members of these lists, in blocks of ``few`` by ``many``
    documents, so that no task holds a whole group."""
    met = met.withColumn("minor", F.col("comp") != F.col("main"))
    size = met.groupBy("main").agg(F.ceil(F.sum(F.col("minor").cast("int")) / few).cast("int").alias("rows"), F.ceil(F.count("*") / many).cast("int").alias("cols"))
    met = met.join(stored(size, "blocks"), "main")
    place = lambda k: F.pmod(F.xxhash64("a"), F.col(k)).cast("int")
    each = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    left = met.where("minor").withColumn("i", place("rows")).withColumn("j", each("cols"))
    met = met.select(*(F.col(c).alias(c) for c in met.columns))
    right = met.withColumn("j", place("cols")).withColumn("i", each("rows"))
    return left.groupBy("main", "i", "j").cogroup(right.groupBy("main", "i", "j")).applyInArrow(_pairs_of(sim), "a long, b long").distinct()


LISTS = "kind int, a long, b long, cnt int, need int, token long, n int, l int, level int"
_LISTS = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("cnt", pa.int32()), ("need", pa.int32()),
                    ("token", pa.int64()), ("n", pa.int32()), ("l", pa.int32()), ("level", pa.int32())])


def _rows(kind: int, **cols) -> pa.RecordBatch:
    n = len(next(iter(cols.values())))
    arrays = [pa.array(np.full(n, kind, np.int32)) if f.name == "kind" else
              pa.array(np.ascontiguousarray(cols[f.name]).astype(f.type.to_pandas_dtype())) if f.name in cols else pa.nulls(n, f.type) for f in _LISTS]
    return pa.RecordBatch.from_arrays(arrays, schema=_LISTS)


def _lists(sim: Similarity, buckets: int, short: int):
    """Of one bucket: counted pairs of short lists (kind 1), the members of
    long lists (kind 2), and each document's number of shared entries (kind 3)."""

    def run(table: pa.Table) -> pa.Table:
        heads, tokens, levels = [], [], []
        for docs, blob in zip(table.column("docs").to_pylist(), table.column("tokens").to_pylist()):
            n = len(blob) // 9
            tokens.append(np.frombuffer(blob, "<u8", n))
            levels.append(np.frombuffer(blob, "u1", n, 8 * n))
            raw = pa.CompressedInputStream(pa.BufferReader(docs), "zstd").read()
            heads.append(np.frombuffer(raw, _DOC))
        head, tok, lev = np.concatenate(heads), np.concatenate(tokens), np.concatenate(levels)
        idx = np.repeat(np.arange(len(head)), head["count"])
        through = table.column("bucket")[0].as_py() >= buckets
        # order by shingle, then class, then document; one member a class
        order = np.argsort(tok, kind="stable")
        tok, lev, idx = tok[order], lev[order], idx[order]
        if not through:
            many = np.empty(len(tok), bool)
            same = tok[1:] == tok[:-1]
            many[:-1] = same
            many[-1:] = False
            many[1:] |= same
            tok, lev, idx = tok[many], lev[many], idx[many]
        order = np.lexsort((head["doc"][idx], head["digest"][idx], tok))
        tok, lev, idx = tok[order], lev[order], idx[order]
        dig = head["digest"][idx]
        again = np.zeros(len(tok), bool)
        again[1:] = (tok[1:] == tok[:-1]) & (dig[1:] == dig[:-1]) & (head["n"][idx[1:]] == head["n"][idx[:-1]])
        tok, lev, idx = tok[~again], lev[~again], idx[~again]
        doc, n, l = head["doc"][idx], head["n"][idx].astype(np.int64), head["l"][idx].astype(np.int64)
        lev = lev.astype(np.int64)
        cut = np.flatnonzero(np.append(True, tok[1:] != tok[:-1])) if len(tok) else np.zeros(0, np.int64)
        size = np.diff(np.append(cut, len(tok)))
        length = np.repeat(size, size)
        big = np.ones(len(tok), bool) if through else length > short
        # how many entries of each document others share, too
        who, count = np.unique(idx[big | (length > 1)], return_counts=True)
        parts = [_rows(3, a=head["doc"][who], cnt=count, n=head["n"][who], l=head["l"][who])]
        parts += [_rows(2, token=tok[big].view(np.int64), a=doc[big], n=n[big], l=l[big], level=lev[big])]
        keep = ~big & (length > 1)
        tok, lev, doc, n, l = tok[keep], lev[keep], doc[keep], n[keep], l[keep]
        pairs = []
        for k in range(1, short):
            if k >= len(tok):
                break
            i = np.flatnonzero(tok[k:] == tok[:-k])
            if not len(i):
                break
            j = i + k
            both = np.minimum(l[i], l[j])
            ok = (sim.den * np.minimum(n[i], n[j]) >= sim.num * np.maximum(n[i], n[j])) & (np.maximum(lev[i], lev[j]) <= both) & (doc[i] != doc[j])
            i, j, both = i[ok], j[ok], both[ok]
            need = sim.shared(n[i], n[j]) - np.maximum(sim.least(n[i]), sim.least(n[j])) + both
            pairs.append(np.stack([np.minimum(doc[i], doc[j]), np.maximum(doc[i], doc[j]), np.maximum(need, 1)]))
        if pairs:
            a, b, need = np.concatenate(pairs, axis=1)
            order = np.lexsort((b, a))
            a, b, need = a[order], b[order], need[order]
            cut = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, np.int64)
            parts.append(_rows(1, a=a[cut], b=b[cut], need=need[cut], cnt=np.diff(np.append(cut, len(a)))))
        return pa.Table.from_batches(parts)
    return run


def _verify(sim: Similarity):
    """Pairs (a, b, ta, tb) whose whole texts link."""
    def run(batches):
        for batch in batches:
            ta, tb = (batch.column(c).dictionary_encode() for c in ("ta", "tb"))
            sets = []
            for col in (ta, tb):
                buf, offs = as_bytes(col.dictionary)
                sets.append([u for i, j in runs(offs) for u in shingle_sets(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], sim.width)])
            ok = []
            for i, j in zip(ta.indices.to_pylist(), tb.indices.to_pylist()):
                x, y = sets[0][i], sets[1][j]
                if len(x) > len(y):
                    x, y = y, x
                if not len(x) or sim.den * len(x) < sim.num * len(y):
                    ok.append(False)
                    continue
                both = np.sort(np.concatenate([x, y]))
                inter = int((both[1:] == both[:-1]).sum())
                ok.append(sim.den * inter >= sim.num * (len(both) - inter))
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([pc.filter(batch.column(c), mask) for c in ("a", "b")], names=["a", "b"])
    return run


def _links(pairs: DataFrame, texts: DataFrame, sim: Similarity) -> DataFrame:
    ta, tb = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    both = pairs.select("a", "b").join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(lean(_verify(sim)), "a long, b long")


def similar_documents(docs: DataFrame, sim: Similarity = Similarity(), most_level: int = 8, short_list: int = 48, hot_list: float = 50_000, leaders: int = 4) -> DataFrame:
    """One row for each row of ``docs`` (columns doc_id, text): doc_id,
    n_shingles, class_id (smallest doc_id with the same shingle set) and
    component_id (smallest doc_id reachable by links, itself included).

    ``most_level`` bounds l.  Lists longer than ``short_list`` take the way of
    steps 4 and 5; shingles that the sketch puts at ``hot_list`` documents or
    more are never gathered in one task.  These choose a way, not a result.

    A null or blank text has no shingles and no links.  Rows with a null
    doc_id have null ids and give no links.  Rows that share a doc_id are one
    document with several texts.  Other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    meta = stored(docs.mapInArrow(lean(_meta(sim.width)), META), "sets")
    rows = meta.where("chunk is null").select("doc_id", "n", "d0", "d1")
    counts = sketch_of(meta)
    entries = int(counts.sum()) * (1 - sim.num / sim.den)
    # a bucket gathers about 16 MB of entries
    buckets = max(48, math.ceil(entries * 16 / (16 << 20)))
    sketch = spark.sparkContext.broadcast(counts)
    packed = docs.mapInArrow(lean(_postings(sim, sketch, buckets, most_level, hot_list)), POSTING)
    lists = stored(packed.groupBy("bucket").applyInArrow(lean_group(_lists(sim, buckets, short_list)), LISTS), "lists", by=["kind"])

    counted = lists.where("kind = 1").groupBy("a", "b").agg(F.sum("cnt").alias("cnt"), F.min("need").alias("need"))
    # of two sets, all common shingles but max(o - l) are in both prefixes, and
    # there each has at most its number of shared entries
    least = F.expr(f"-floor(-{sim.num} * n / {sim.den})").cast("long")
    room = lists.where("kind = 3").groupBy("a", "n", "l").agg(F.sum("cnt").alias("s")).select("a", "n", "l", "s", (least - F.col("l")).alias("rest"))
    long = stored(lists.where("kind = 2").select("token", "a", "n", "l").join(stored(room, "room"), ["a", "n", "l"]), "long")
    # a few leading members of each long list, by size band, meet all its members
    band = F.floor(F.log("n") / math.log(sim.den / sim.num)).alias("band")
    member = long.select("token", "a", "n", "s", "rest", band)
    # the members with the most shared entries have the fewest shingles of their own: they stand in the middle
    lead = member.groupBy("token", "band", F.pmod(F.xxhash64("a"), F.lit(leaders)).alias("part")).agg(F.max(F.struct("s", F.xxhash64(F.lit(1), "a"), F.col("a").alias("b"), F.col("n").alias("m"), "rest")).alias("h"))
    lead = stored(lead.select("token", F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1)).alias("band"), "h.b", "h.m", F.col("h.s").alias("s_b"), F.col("h.rest").alias("rest_b")), "leads")
    total = F.expr(f"-floor(-{sim.num} * (n + m) / {sim.num + sim.den})").cast("long")
    fits = (sim.den * F.least("n", "m") >= sim.num * F.greatest("n", "m")) & (F.col("a") != F.col("b")) & (F.least("s", "s_b") + F.greatest("rest", "rest_b") >= total)
    star = member.join(lead, ["token", "band"]).where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = stored(counted.where("cnt >= need").select("a", "b").unionByName(star).distinct(), "pairs")

    wanted = pairs.select("a").union(pairs.select("b")).union(long.select("a")).distinct()
    # sorted and merged at every size, so that small inputs tell what large ones cost
    texts = stored(docs.join(wanted.withColumnRenamed("a", "doc_id").hint("merge"), "doc_id", "left_semi"), "texts")
    links = stored(_links(pairs, texts, sim), "links")
    root = components(spark, links)

    # long lists that still span components: pairs across these, exactly
    home = (long.join(root, F.col("a") == F.col("node"), "left").select("token", "a", "n", "s", "rest", F.coalesce("root", "a").alias("comp")))
    home = stored(home, "members")
    open_ = home.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    part = stored(home.join(open_, "token").groupBy("token", "comp").agg(F.count("*").alias("c")), "part")
    main = part.groupBy("token").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"))
    met = home.join(main, "token").select("main", "a", "n", "s", "rest", "comp").distinct()
    bits = texts.join(home.join(open_, "token", "left_semi").select(F.col("a").alias("doc_id")).distinct(), "doc_id").select("doc_id", "text").mapInArrow(lean(_bitmaps(sim.width)), "a long, bits binary")
    met = stored(met.join(bits, "a"), "met")
    late = stored(_across(met, sim).join(pairs, ["a", "b"], "left_anti"), "late")
    late_links = stored(_links(late, texts, sim), "links")

    cls = stored(rows.where("n > 0 and doc_id is not null").groupBy("d0", "d1", "n").agg(F.min("doc_id").alias("class_id")), "classes")
    ids = rows.where("n > 0 and doc_id is not null").join(cls, ["d0", "d1", "n"]).select("doc_id", "class_id").where("doc_id <> class_id")
    # only repeated ids bring links of their own: a document in several classes
    repeated = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("d0").alias("lo"), F.max("d0").alias("hi")).where("lo < hi").select("doc_id")
    own = ids.join(repeated, "doc_id").select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"))
    more = late_links.unionByName(own)
    if more.head(1):
        root = components(spark, links.unionByName(more))
    cls = stored(cls.join(root.withColumnRenamed("node", "class_id"), "class_id", "left")
                 .select("d0", "d1", "n", "class_id", F.coalesce("root", "class_id").alias("component_id")), "roots")
    return (rows.join(cls, ["d0", "d1", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))


def one_of_each(docs: DataFrame, sim: Similarity = Similarity()) -> DataFrame:
    """``docs`` with one document of each component, that with the smallest
    doc_id.  Rows without shingles or id stay; repeated rows of a kept id too."""
    found = similar_documents(docs, sim).where("component_id is not null and component_id <> doc_id").select("doc_id").distinct()
    return docs.join(stored(found, "dropped").hint("merge"), "doc_id", "left_anti").select(*docs.columns)
