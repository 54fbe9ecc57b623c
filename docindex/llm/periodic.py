"""Periodic runs of words: stretches that repeat one passage at least four
times, found by a sparse recurrence on diagonals.

Reading a text word by word, the earlier occurrences of a word at distance d
lengthen the match on the diagonal of lag d; a diagonal that is not lengthened
ends, and gives a run if the match was long enough.  Frequent words have far
too many earlier occurrences for that, so a word is looked up together with
the words before it: contexts of 1, 2, 4, ... words.  The context of c words
serves the lags above c / 2 and up to c.  Inside a run of smallest period d <=
c the latest earlier occurrence of such a context is always exactly d words
back (a nearer one would make the period smaller), so that each word
lengthens one diagonal a context size at most, and runs come out with their
smallest period and once.  Contexts of 2c words are pairs of contexts of c
words, so equal numbers mean equal words.

Only positions that can still lie in a run go on to the next size: their
context repeats in the text, in a stretch of more than 3c such positions.  Of
ordinary text next to nothing is left after two or three sizes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, joined_words, lean, runs, word_codes, word_slices

#: A run has this many words and this many periods at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4


def _stretches(goes_on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, length) of the stretches of an array of ``len(goes_on) + 1``
    items, item i + 1 belonging to the stretch of item i where goes_on[i]."""
    first = np.append(0, np.flatnonzero(~goes_on) + 1)
    return first, np.diff(np.append(first, len(goes_on) + 1))


def _lags(at: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each position (ascending), the distance to the latest earlier one of
    the same name (0: none), and whether the name occurs again at all."""
    order = np.argsort(name, kind="stable")
    same = name[order[1:]] == name[order[:-1]]
    lag = np.zeros(len(at), np.int64)
    lag[order[1:]] = np.where(same, at[order[1:]] - at[order[:-1]], 0)
    again = np.zeros(len(at), bool)
    again[order[1:]] = same
    again[order[:-1]] |= same
    return lag, again


def periodic_runs(code: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period.

    ``code`` numbers the words of a few texts in a row, ``text`` says which
    text (ascending) a word belongs to; starts count from the first word.
    """
    at = np.arange(len(code))
    name = text.astype(np.int64) * (int(code.max(initial=0)) + 1) + code
    c, found = 1, [np.zeros((3, 0), np.int64)]
    while len(at):
        lag, again = _lags(at, name)
        live = np.flatnonzero((lag > c // 2) & (lag <= c))
        if len(live):
            # a diagonal ends where the next word doesn't lengthen it
            first, size = _stretches((np.diff(at[live]) == 1) & (np.diff(lag[live]) == 0))
            d = lag[live[first]]
            match = size + c - 1
            long = match + d >= np.maximum(LEAST_WORDS, LEAST_PERIODS * d)
            start = at[live[first]] - (c - 1) - d
            found.append(np.stack([start, match + d, d])[:, long])
        # positions that can lie in a run of a period above c
        left = np.flatnonzero(again)
        if not len(left):
            break
        first, size = _stretches(np.diff(at[left]) == 1)
        left = left[np.repeat(size >= LEAST_PERIODS * (c + 1) - c + 1, size)]
        if not len(left):
            break
        at, name = at[left], np.unique(name[left], return_inverse=True)[1].astype(np.int64)
        before = np.searchsorted(at, at - c)
        both = at[before] == at - c
        at, name = at[both], name[before[both]] * (int(name.max()) + 1) + name[both]
        c *= 2
    out = np.concatenate(found, axis=1)
    start, length, period = out[:, np.lexsort((out[2], out[0]))]
    return start, length, period


def repeated(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether each of n words lies in a run after the run's first period."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, start + length, -1)
    return np.cumsum(step[:-1]) > 0


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _collapse(batches):
    for batch in batches:
        row, (buf, offs) = batch.column("row"), as_bytes(batch.column("text"))
        for i, j in runs(offs):
            b, o = buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
            s, e, first = word_slices(b, o)
            n = np.diff(first)
            text = np.repeat(np.arange(j - i), n)
            start, length, period = periodic_runs(word_codes(b, s, e), text)
            keep = ~repeated(len(s), start, length, period)
            upto = np.searchsorted(start, first)
            own = start - np.repeat(first[:-1], np.diff(upto))  # counted within its text
            rows = pa.StructArray.from_arrays([pa.array(x) for x in (own, length, period)], fields=list(_RUN))
            yield pa.RecordBatch.from_arrays(
                [row.slice(i, j - i), pa.array(n), pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), rows), joined_words(b, o, s, e, first, keep).cast(pa.string())],
                names=["row", "n_words", "runs", "collapsed"])


def collapse_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (a struct of the other columns of ``docs``), n_words, runs
    (array of start, length, period in words, by start, then period) and
    collapsed: the words of the text, joined by one blank, without those that
    only repeat (those in a run, after its first period).

    Words are runs of anything but ASCII white space, compared byte by byte.
    Every run has its smallest period and is as long as it can be; runs of
    different periods may overlap.  Null and empty texts have no words, no
    runs and an empty collapsed text.  Texts are handled whole, in memory of
    about 100 bytes a word of the longest text; repeated rows give repeated
    rows, and columns of any name travel in ``row``.
    """
    bounded_batches(docs.sparkSession)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    df = docs.select(F.struct(*rest).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kind = df.schema["row"].dataType.simpleString()
    return df.mapInArrow(lean(_collapse), f"row {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def planted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with a periodic tail in about every tenth text, by the CRC-32
    of its id: h = crc32(id), g = h div 10; where h % 10 = 0, words from a = g %
    n on repeat the p = 1 + (n - a) div (3 + g % 8) words that begin there.

    Texts without words and rows without id stay as they are.
    """
    h = F.crc32(F.encode(F.col(f"`{doc_id}`").cast("string"), "utf-8"))
    parts = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), h.alias("h"), F.expr("cast(null as array<string>)").alias("w"))
    parts = parts.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all(F.col(f"row.`{text}`"), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))))
    parts = parts.withColumn("n", F.size("w").cast("long")).withColumn("g", F.expr("h div 10"))
    parts = parts.withColumn("a", F.expr("if(n > 0, g % n, null)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = "slice(flatten(array_repeat(slice(w, cast(a + 1 as int), cast(p as int)), cast((n - a) div p + 1 as int))), 1, cast(n - a as int))"
    changed = F.expr(f"array_join(concat(slice(w, 1, cast(a as int)), {tail}), ' ')")
    new = F.when(F.col("n") > 0, changed).otherwise(F.col(f"row.`{text}`"))
    return parts.select(*[new.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])
