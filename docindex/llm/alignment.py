"""Alignment of two tokenizers over the same bytes.

A is a byte-level BPE, read from its JSON file; B is a SentencePiece model.
Both tokenise the whole text (with a blank before it, as B adds one).  Where a
token of A and a token of B end at the same byte, a group ends.  A shared end
before tokens that begin with a blank is an anchor: anchors cut a text into
windows of token ids, mostly of one word.  A window's alignment depends on its
ids only, so windows are numbered by their ids, and each one is aligned once.

Links are pairs of an A and a B token that share bytes.  How often each pair of
ids is linked is counted over all documents.  Documents travel in blocks, of
about BLOCK_BYTES of text or one longer text: a block keeps each of its windows
once, and its documents as rows of window numbers, both compressed.  What the
corpus is asked for, and answers, is one row for each block and pair of ids.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, lean, lean_group, runs, stored

BLOCK_BYTES = 2 << 20
BLANK = 0x20
#: Fixed value: the pattern of byte-level pre-tokenisation.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for:
    printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pieces:
    """Bytes of every id of a vocabulary."""

    def __init__(self, token: list[bytes]):
        self.length = np.array([len(t) for t in token], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(token), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.length[ids]
        stop = np.cumsum(size)
        return self.bytes[np.arange(int(size.sum())) + np.repeat(self.first[ids] - (stop - size), size)]


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    letter = byte_alphabet()
    return {bytes(letter[c] for c in t): i for t, i in vocab.items()}


@lru_cache(2)
def byte_level(path: str):
    """The encoding of a byte-level BPE's JSON file."""
    import tiktoken
    return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=_ranks(path), special_tokens={})


@lru_cache(2)
def piece_model(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(2)
def byte_level_pieces(path: str) -> Pieces:
    ranks = _ranks(path)
    token = [b""] * (max(ranks.values()) + 1)
    for t, i in ranks.items():
        token[i] = t
    return Pieces(token)


@lru_cache(2)
def model_pieces(path: str) -> Pieces:
    sp = piece_model(path)
    return Pieces([bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(sp.get_piece_size())])


@dataclass
class Windows:
    """Token windows in a row: ids, how many of them each window has, and the
    byte at which each token ends."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    end_a: np.ndarray
    end_b: np.ndarray

    def __post_init__(self):
        self.ends = np.append(0, self.end_a)[np.cumsum(self.n_a)]
        mark = np.zeros(int(self.ends[-1]) + 1 if len(self.ends) else 1, np.uint8)
        mark[self.end_a] = 1
        mark[self.end_b] |= 2
        # between two ends, of either side, one A and one B token lie
        self.stops = np.flatnonzero(mark)
        kind = mark[self.stops]
        self.shared = self.stops[kind == 3]
        at_a, at_b = kind & 1, kind >> 1
        self.link_a, self.link_b = np.cumsum(at_a, dtype=np.int64) - at_a, np.cumsum(at_b, dtype=np.int64) - at_b

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs (a << 32 | b), and how many each window has."""
        pairs = self.a[self.link_a].astype(np.int64) << 32 | self.b[self.link_b]
        return pairs, np.diff(np.searchsorted(self.stops, self.ends, side="right"), prepend=0)

    def groups(self) -> np.ndarray:
        return np.diff(np.searchsorted(self.shared, self.ends, side="right"), prepend=0)

    def texts(self) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` of each window."""
        group_a, group_b = (np.searchsorted(self.shared, e, side="left") for e in (self.end_a, self.end_b))
        g = len(self.shared)
        upto_a, upto_b = (np.append(0, np.cumsum(np.bincount(x, minlength=g))) for x in (group_a, group_b))
        # in a group A's tokens come first
        n, last = len(self.a) + len(self.b), np.zeros(g, bool)
        last[np.searchsorted(self.shared, self.ends)] = True
        ids, sep = np.empty(n, np.int64), np.empty(n, np.uint8)
        at = np.arange(len(self.a)) + upto_b[group_a]
        ids[at] = self.a
        sep[at] = np.where(np.append(group_a[1:], -1) == group_a, ord(","), ord("|"))
        at = np.arange(len(self.b)) + upto_a[group_b + 1]
        ids[at] = self.b
        ends_group = np.append(group_b[1:], -1) != group_b
        sep[at] = np.where(ends_group, np.where(last[group_b], 0, ord(";")), ord(","))
        # decimal digits of each id, then its separator
        digits = 1 + sum((ids >= 10**k).astype(np.int64) for k in range(1, 10))
        width = digits + (sep > 0)
        stop = np.cumsum(width)
        out = np.empty(int(stop[-1]) if n else 0, np.uint8)
        first = stop - width
        left = ids.copy()
        for k in range(int(digits.max(initial=0))):
            some = digits > k
            out[first[some] + digits[some] - 1 - k] = 48 + left[some] % 10
            left //= 10
        out[(stop - 1)[sep > 0]] = sep[sep > 0]
        tokens = np.cumsum(self.n_a + self.n_b)
        return pa.Array.from_buffers(pa.large_string(), len(self.n_a), [None, pa.py_buffer(np.append(0, np.append(0, stop)[tokens])), pa.py_buffer(out)])


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.enc, self.sp = byte_level(path_a), piece_model(path_b)
        self.a, self.b = byte_level_pieces(path_a), model_pieces(path_b)

    def tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B; of both none where their bytes are not the text's."""
        a = [self.enc.encode_ordinary(" " + t) if t else [] for t in texts]
        b = self.sp.encode(texts, num_threads=1) if texts else []
        for k, t in enumerate(texts):
            want = (" " + t).encode() if t else b""
            if not (want and self.a.joined(np.array(a[k], np.int64)).tobytes() == want == self.b.joined(np.array(b[k], np.int64)).tobytes()):
                a[k], b[k] = [], []
        return a, b

    def windows(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> Windows:
        return Windows(a, b, n_a, n_b, np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b]))

    def block(self, texts: list[str]) -> dict:
        """A block of texts: per text the numbers of tokens, groups, links and
        windows; for all of them the pairs of linked ids with their counts, and
        what ``unpack`` makes windows of again."""
        la, lb = self.tokens(texts)
        na, nb = (np.array([len(x) for x in y], np.int64) for y in (la, lb))
        a, b = (np.fromiter(chain.from_iterable(y), np.int32, int(n.sum())) for y, n in ((la, na), (lb, nb)))
        whole = self.windows(a, b, na, nb)
        data = self.a.joined(a)  # the bytes of all texts that have tokens
        # texts begin with a blank, so each text's last byte is an anchor, too
        anchor = whole.shared[np.append(data, BLANK)[whole.shared] == BLANK]
        ia, ib = (np.append(0, np.searchsorted(e, anchor, side="right")) for e in (whole.end_a, whole.end_b))
        ca, cb = np.diff(ia), np.diff(ib)
        # windows as rows of numbers: count of A ids, A ids, B ids
        size = 1 + ca + cb
        at = np.cumsum(size) - size
        flat = np.empty(int(size.sum()), np.int32)
        flat[at] = ca
        flat[np.arange(len(a)) + np.repeat(at + 1 - ia[:-1], ca)] = a
        flat[np.arange(len(b)) + np.repeat(at + 1 + ca - ib[:-1], cb)] = b
        rows = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(np.append(at, len(flat)) * 4), pa.py_buffer(flat)]).dictionary_encode()
        path = rows.indices.to_numpy().astype(np.int32)
        own = rows.dictionary
        kept, bounds = (np.frombuffer(x, t) if x is not None else np.zeros(0, t) for x, t in zip(own.buffers()[2:0:-1], (np.int32, np.int64)))
        bounds = bounds[:len(own) + 1] // 4
        kept = kept[:int(bounds[-1])] if len(bounds) else kept
        aligned = self.unpacked(kept, np.diff(bounds))
        every, links = aligned.links()
        pair, which = np.unique(every, return_inverse=True)
        count = np.bincount(which, weights=np.repeat(np.bincount(path, minlength=len(links)), links), minlength=len(pair)).astype(np.int64)
        windows = np.searchsorted(anchor, whole.ends, side="right")
        sums = np.append(0, np.cumsum(links[path]))[windows]
        return {"n_a": na, "n_b": nb, "n_groups": whole.groups(), "n_links": np.diff(sums, prepend=0), "n_windows": np.diff(windows, prepend=0),
                "packed": [_packed(x) for x in (path, np.diff(bounds).astype(np.int32), kept)], "pair": pair, "count": count}

    def unpacked(self, flat: np.ndarray, size: np.ndarray) -> Windows:
        """Windows of rows of numbers (see ``block``)."""
        at = np.cumsum(size) - size
        n_a = flat[at].astype(np.int64)
        n_b = size - 1 - n_a
        a = flat[np.arange(int(n_a.sum())) + np.repeat(at + 1 - (np.cumsum(n_a) - n_a), n_a)]
        b = flat[np.arange(int(n_b.sum())) + np.repeat(at + 1 + n_a - (np.cumsum(n_b) - n_b), n_b)]
        return self.windows(a, b, n_a, n_b)


def _packed(x: np.ndarray) -> bytes:
    return len(x).to_bytes(8, "little") + pa.compress(x.tobytes(), "zstd", asbytes=True)


def _numbers(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    return np.frombuffer(pa.decompress(raw[8:], n * 4, "zstd", asbytes=True), np.int32)


_OWN = "block string, place int, n_a long, n_b long, n_groups long, n_links long, n_windows long, packed array<binary>, pair array<long>, pair_count array<long>"


def _read(path_a: str, path_b: str):
    """Documents with their numbers of windows; the first of each block also
    has the block's windows and pairs of ids with their counts."""
    def run(batches):
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            _, offs = as_bytes(batch.column("text"))
            for i, j in runs(offs, BLOCK_BYTES):
                x = aligner.block(batch.column("text").slice(i, j - i).to_pylist())
                k = j - i

                def once(values, kind):
                    return pa.ListArray.from_arrays(pa.array(np.append(0, np.full(k, len(values))).astype(np.int32)), pa.array(values, kind))
                yield pa.RecordBatch.from_arrays([
                    batch.column("row").slice(i, k), pa.array([uuid.uuid4().hex] * k), pa.array(np.arange(k, dtype=np.int32)),
                    *(pa.array(x[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_windows")),
                    once(x["packed"], pa.binary()), once(x["pair"], pa.int64()), once(x["count"], pa.int64())],
                    names=["row", *(c.split()[0] for c in _OWN.split(", "))])
    return run


def _answer(path_a: str, path_b: str):
    def run(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        """Documents of a block, given the corpus's counts of the block's pairs."""
        docs = docs.sort_by("place")
        own, order = docs.column("pair")[0].values.to_numpy(), np.argsort(pairs.column("pair").to_numpy())
        if not np.array_equal(own, pairs.column("pair").to_numpy()[order]):
            raise ValueError("a block and its pairs disagree")
        n, best = (pairs.column(c).to_numpy()[order].astype(np.int64) for c in ("n", "best"))
        path, size, flat = (_numbers(x) for x in docs.column("packed")[0].as_py())
        windows = Aligner(path_a, path_b).unpacked(flat, size.astype(np.int64))
        pair, links = windows.links()
        which, ends = np.searchsorted(own, pair), np.append(0, np.cumsum(links))
        stop = np.append(0, np.cumsum(docs.column("n_windows").to_numpy()))
        found = [np.diff(np.append(0, np.cumsum(np.diff(np.append(0, np.cumsum(v[which]))[ends])[path]))[stop]) for v in (best, n)]
        text, path = windows.texts().to_pylist(), path.tolist()
        groups = [";".join([text[w] for w in path[s:e]]) for s, e in zip(stop[:-1].tolist(), stop[1:].tolist())]
        out = {c: docs.column(c) for c in ("row", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table(out | {"n_best": pa.array(found[0], pa.int64()), "count_sum": pa.array(found[1], pa.int64()), "groups": pa.array(groups, pa.string())})
    return run


def align_tokens(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """``row`` (a struct of the other columns of ``docs``), n_a and n_b (tokens),
    n_groups, n_links, n_best (links of a pair that no other pair of the same B
    id exceeds in the corpus), count_sum (corpus counts of all links) and
    groups (``a1,a2|b1;a3|b2,b3``: ids of each group in order).

    ``path_a`` and ``path_b`` are files that every executor can read.  Null and
    empty texts, and those whose tokens do not spell a blank and the text (B
    may normalise), have no tokens: zeros and an empty string.  Whole texts are
    tokenised; a longer text than BLOCK_BYTES is a block of its own.  Repeated
    rows count as often as they occur; ties for the highest count all count as
    best; columns of any name travel in ``row``.
    """
    bounded_batches(docs.sparkSession)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    df = docs.select(F.struct(*rest).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kind = df.schema["row"].dataType.simpleString()
    # written once: blocks get their names here, and all that follows reads these
    read = stored(df.mapInArrow(lean(_read(path_a, path_b)), f"row {kind}, {_OWN}"), "blocks")
    asked = read.where(F.size("pair") > 0).select("block", F.explode(F.arrays_zip("pair", F.col("pair_count").alias("c"))).alias("x")).select("block", "x.pair", "x.c")
    counts = stored(asked.groupBy("pair").agg(F.sum("c").alias("n")), "pairs")
    # one row a B id: bounded by B's vocabulary
    b_id = F.col("pair").bitwiseAND(F.lit(2**32 - 1)).alias("b")
    highest = counts.groupBy(b_id).agg(F.max("n").alias("most"))
    scored = counts.withColumn("b", b_id).join(F.broadcast(highest), "b").select("pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best"))
    told = asked.select(F.col("block").alias("of"), "pair").join(scored, "pair")
    return read.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(
        lean_group(_answer(path_a, path_b)), f"row {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
