"""Byte-level BPE: encoding and decoding with the ranks of a public vocabulary.

Pre-tokenisation uses no regular expressions.  Every code point gets a class
(letter, number, white space, other; with marks for the apostrophe and for
the letters of English contractions).  A class stands for a transition
function on the states of a small automaton; functions compose associatively,
so the states at all positions come from a blocked scan: each row of a matrix
of characters composes its functions side by side with all other rows, one
recursion finds the state at the head of each row, and a second sweep finds
the state at each character.  States and classes then say where a piece
begins.  Pieces are named by their bytes; each distinct piece is merged once
by ranks and cached.
"""

from __future__ import annotations

import base64
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, lean, runs

# Classes of code points.  In SPACE_CLASSES the last character before a
# non-space is set apart, as the pattern's "\s+(?!\S)" leaves it.
LETTER, NUMBER, OTHER, BLANK, SPACE, QUOTE, SHORT, LONG = range(8)
# States: what the character before a position belongs to.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_BLANK, AFTER_SPACE, AFTER_QUOTE, IN_SUFFIX, AFTER_SUFFIX = range(9)
STATES = 9
# The pattern's white space (Unicode White_Space).
WHITE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(1)
def code_point_classes() -> np.ndarray:
    """Class of every code point, by its general category."""
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    out[WHITE] = SPACE
    out[0x20] = BLANK
    out[0x27] = QUOTE
    return out


def step(state: int, cls: int) -> int:
    """The state after a character of class ``cls``.

    SHORT: a letter that ends a contraction if a lone quote precedes it.
    LONG: a letter that does so with the letter that follows.
    """
    if cls == BLANK:
        return AFTER_BLANK
    if cls == SPACE:
        return AFTER_SPACE
    if cls == NUMBER:
        return IN_NUMBERS
    if cls == OTHER:
        return IN_OTHERS
    if cls == QUOTE:
        return IN_OTHERS if state in (IN_OTHERS, AFTER_BLANK, AFTER_QUOTE) else AFTER_QUOTE
    if state == AFTER_QUOTE and cls == SHORT:
        return AFTER_SUFFIX
    if state == AFTER_QUOTE and cls == LONG:
        return IN_SUFFIX
    if state == IN_SUFFIX:
        return AFTER_SUFFIX
    return IN_LETTERS


@lru_cache(1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The transition functions that classes generate: number of each class's
    function, table of compositions (first, then), table of applications."""
    functions = [tuple(range(STATES))]
    number = {functions[0]: 0}

    def of(f):
        if f not in number:
            number[f] = len(functions)
            functions.append(f)
        return number[f]

    single = [of(tuple(step(s, c) for s in range(STATES))) for c in range(8)]
    done = -1
    while done != len(functions):  # closure under one more character
        done = len(functions)
        for f in list(functions):
            for c in single:
                of(tuple(functions[c][s] for s in f))
    compose = np.array([[of(tuple(g[s] for s in f)) for g in functions] for f in functions], np.uint8)
    return np.array(single, np.uint8), compose, np.array(functions, np.uint8)


def scan_states(f: np.ndarray, width: int = 64) -> np.ndarray:
    """State before each position, from START, for an array of functions."""
    _, compose, apply = monoid()
    n = len(f)
    if n <= width:
        out, s = np.empty(n, np.uint8), START
        for i, g in enumerate(f.tolist()):
            out[i] = s
            s = int(apply[g, s])
        return out
    rows = -(-n // width)
    grid = np.zeros(rows * width, np.uint8)  # function 0 changes nothing
    grid[:n] = f
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    whole = grid[0]
    for i in range(1, width):
        whole = compose[whole, grid[i]]
    state = scan_states(whole, width)
    out = np.empty((width, rows), np.uint8)
    for i in range(width):
        out[i] = state
        state = apply[grid[i], state]
    return out.T.reshape(-1)[:n]


def piece_starts(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Byte positions at which pieces begin, in a run of UTF-8 texts."""
    if not len(buf):
        return np.zeros(0, np.int64)
    point = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    cls = code_point_classes()[point]
    n = len(cls)
    begin = np.zeros(n + 1, bool)
    begin[np.searchsorted(lead, offs)] = True  # first character of each text
    begin = begin[:n]
    last = np.append(begin[1:], True)
    follow = np.append(point[1:], 0)
    follow[last] = 0
    short = (point == ord("s")) | (point == ord("t")) | (point == ord("m")) | (point == ord("d"))
    long = ((point == ord("r")) & (follow == ord("e"))) | ((point == ord("v")) & (follow == ord("e"))) | ((point == ord("l")) & (follow == ord("l")))
    cls[short] = SHORT
    cls[long] = LONG
    single, compose, apply = monoid()
    f = single[cls]
    # the first character of a text starts afresh: a function of no state
    fresh = np.array([int(np.flatnonzero((apply == apply[g][START]).all(axis=1))[0]) if (apply == apply[g][START]).all(axis=1).any() else 255 for g in single], np.uint8)
    state = scan_states_from(f, begin, fresh, cls, apply)
    return lead[starts_of(state, cls, begin, last)]


def scan_states_from(f, begin, fresh, cls, apply):
    """States before each position, with START before each text."""
    g = f.copy()
    heads = np.flatnonzero(begin)
    g[heads] = fresh[cls[heads]]
    state = scan_states(g)
    state[heads] = START
    return state


def starts_of(state, cls, begin, last):
    """Whether a piece begins at each character."""
    white = (cls == BLANK) | (cls == SPACE)
    after_white = (state == AFTER_BLANK) | (state == AFTER_SPACE)
    follow_white = np.append(white[1:], False)
    ends_run = ~last & ~follow_white
    letter = (cls == LETTER) | (cls == SHORT) | (cls == LONG)
    other = (cls == OTHER) | (cls == QUOTE)
    suffix = ((state == AFTER_QUOTE) & ((cls == SHORT) | (cls == LONG))) | (state == IN_SUFFIX)
    goes_on = ((letter & ((state == IN_LETTERS) | suffix)) | ((cls == NUMBER) & (state == IN_NUMBERS))
               | (other & ((state == IN_OTHERS) | (state == AFTER_QUOTE))))
    start = np.where(white, ~after_white | ends_run, ~goes_on & (state != AFTER_BLANK))
    return start | begin


class Vocabulary:
    """Ranks of byte strings, and a bounded cache of merged pieces."""

    def __init__(self, path: str, cache: int = 200_000):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.room, self.cache = cache, {}
        size = max(self.ranks.values()) + 1
        token = [b""] * size
        for b, r in self.ranks.items():
            token[r] = b
        self.length = np.array([len(t) for t in token], np.int64)
        self.first = np.append(0, np.cumsum(self.length))[:-1]
        self.bytes = np.frombuffer(b"".join(token), np.uint8)

    def merge(self, piece: bytes) -> bytes:
        """Ids of one piece, as 32-bit numbers: the neighbours with the least
        rank join first."""
        ranks = self.ranks
        if piece in ranks:
            ids = [ranks[piece]]
        elif len(piece) > 512:
            ids = self._merge_long(piece)
        else:
            none = 1 << 60
            get, cuts = ranks.get, list(range(len(piece) + 1))
            pair = [get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
            while pair:
                least = min(pair)
                if least == none:
                    break
                i = pair.index(least)
                del cuts[i + 1], pair[i]
                if i < len(pair):
                    pair[i] = get(piece[cuts[i]:cuts[i + 2]], none)
                if i:
                    pair[i - 1] = get(piece[cuts[i - 1]:cuts[i + 1]], none)
            ids = [ranks[piece[x:y]] for x, y in zip(cuts, cuts[1:])]
        out = array("i", ids).tobytes()
        if len(self.cache) >= self.room:
            self.cache.clear()
        if len(piece) <= 64:
            self.cache[piece] = out
        return out

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap and linked neighbours, for very long pieces."""
        import heapq
        n, ranks = len(piece), self.ranks
        end, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = []

        def offer(i):
            j = end[i]
            if j < n:
                r = ranks.get(piece[i:end[j]])
                if r is not None:
                    heapq.heappush(heap, (r, i, j, end[j]))
        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, j, e = heapq.heappop(heap)
            if not (alive[i] and j < n and alive[j] and end[i] == j and end[j] == e):
                continue
            alive[j] = False
            end[i] = e
            if e < n:
                prev[e] = i
            offer(i)
            if prev[i] >= 0:
                offer(prev[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_run(buf: np.ndarray, offs: np.ndarray, voc: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids, number of ids up to each text's end) of a run of texts."""
    start = piece_starts(buf, offs)
    if not len(start):
        return np.zeros(0, np.int32), np.zeros(len(offs), np.int64)
    cuts = np.append(start, len(buf))
    pieces = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(buf))]).dictionary_encode()
    which, known, merge = pieces.indices.to_numpy(), voc.cache.get, voc.merge
    merged = [known(p) or merge(p) for p in pieces.dictionary.to_pylist()]
    size = np.fromiter(map(len, merged), np.int64, len(merged)) // 4
    flat = np.frombuffer(b"".join(merged), np.int32)
    at = np.append(0, np.cumsum(size))[:-1]
    count = size[which]
    ends = np.cumsum(count)
    ids = flat[np.arange(int(ends[-1])) + np.repeat(at[which] - (ends - count), count)]
    upto = np.append(0, ends)[np.searchsorted(start, offs)]
    return ids, upto


_TOKENS = ["ids", "offsets"]


def _encode(path: str, columns: list[str]):
    def run(batches):
        voc = vocabulary(path)
        for batch in batches:
            buf, offs = as_bytes(batch.column("text"))
            for i, j in runs(offs):
                o = offs[i:j + 1] - offs[i]
                ids, upto = encode_run(buf[offs[i]:offs[j]], o, voc)
                # where each token ends, counted from the start of its text
                ends = np.cumsum(voc.length[ids]) - np.repeat(o[:-1], np.diff(upto))
                lists = [pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(x.astype(np.int32))) for x in (ids, ends)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in columns), *lists], names=[*columns, *_TOKENS])
        voc.cache.clear()  # the worker may turn to other work
    return run


def _decode(path: str, columns: list[str]):
    def run(batches):
        voc = vocabulary(path)
        for batch in batches:
            lists, ends = (batch.column(c) for c in _TOKENS)
            at = lists.offsets.to_numpy().astype(np.int64)
            ids = lists.values.to_numpy()[at[0]:at[-1]]
            at = at - at[0]
            i = 0
            while i < len(at) - 1:
                j = max(i + 1, int(np.searchsorted(at, at[i] + (1 << 18), side="right")) - 1)
                part = ids[at[i]:at[j]]
                size = voc.length[part]
                stop = np.cumsum(size)
                total = int(stop[-1]) if len(stop) else 0
                text = voc.bytes[np.arange(total) + np.repeat(voc.first[part] - (stop - size), size)]
                offs = np.append(0, stop)[at[i:j + 1] - at[i]]
                # the retained offsets say how long each text must be
                rows = ends.slice(i, j - i)
                o = rows.offsets.to_numpy().astype(np.int64)
                v = np.append(rows.values.to_numpy(), 0)
                told = np.where(np.diff(o) > 0, v[np.maximum(o[1:] - 1, 0)], 0)
                if not np.array_equal(told, np.diff(offs)):
                    raise ValueError("ids and offsets disagree")
                out = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(text))])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in columns), out], names=[*columns, "decoded"])
                i = j
    return run


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``row`` (a struct of the other columns of ``docs``), ids (array<int>)
    and offsets (array<int>: byte at which each token ends in its text).

    ``path`` is a rank file that every executor can read.  Null and empty
    texts have no ids.  Whole texts are encoded, each piece separately,
    without special tokens.
    """
    bounded_batches(docs.sparkSession)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    df = docs.select(F.struct(*rest).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kind = df.schema["row"].dataType.simpleString()
    return df.mapInArrow(lean(_encode(path, ["row"])), f"row {kind}, ids array<int>, offsets array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` (as from ``encode``) with ``decoded``, the bytes of the ids;
    fails if the retained offsets do not fit them."""
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema)
    return tokens.mapInArrow(lean(_decode(path, tokens.columns)), f"{kind}, decoded binary")
