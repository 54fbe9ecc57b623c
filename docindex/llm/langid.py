"""Language identification with language-bitmask n-gram filters.

Training counts byte n-grams of labelled texts.  A language contains every
n-gram of its texts but those that are rare in it against the language where
the n-gram is most frequent.  One Bloom filter holds all languages: slot i of
the table is a bit mask with a bit per language (a bit slice of each
language's own filter), so the AND of the few slots of an n-gram gives at once
all languages that contain it.  The table has as many slots as the largest
language needs for the wanted rate of false positives.  A text's per-language counts of contained n-grams, less the
false positives that each slice's fill lets expect, decide.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, lean, mix, runs

#: N-grams of so many bytes.
WIDTHS = (3, 4)
#: Texts that train one language, about (a bound on the sample).
TEXTS_PER_LANGUAGE = 3000
PROBES = 2
#: Wanted rate of false positives of the largest language; the table has
#: 2**LEAST_BITS slots at least.
FALSE, LEAST_BITS = 0.02, 12
#: A language keeps an n-gram at this part of its highest frequency, or more.
PART = 0.25

_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[:97] = 32
_BLANK[123:128] = 32


def grams(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, rows) of all n-grams of lower-case texts; ASCII other than
    letters counts as blank, runs of blanks as one."""
    text = _BLANK[buf]
    keep = text != 32
    keep[1:] |= text[:-1] != 32
    keep[offs[:-1][offs[:-1] < len(keep)]] = True  # each text starts afresh
    upto = np.append(0, np.cumsum(keep))
    text, offs = text[keep].astype(np.uint64), upto[offs]
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    codes, rows = [], []
    for w in WIDTHS:
        n = len(text) - w + 1
        if n <= 0:
            continue
        code = np.full(n, w, np.uint64)
        for j in range(w):
            code = (code << np.uint64(8)) | text[j:j + n]
        ok = row[:n] == row[w - 1:]
        codes.append(code[ok])
        rows.append(row[:n][ok])
    if not codes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(codes), np.concatenate(rows)


def _count(batches):
    for batch in batches:
        lang = batch.column("lang").to_numpy(zero_copy_only=False)
        buf, offs = as_bytes(batch.column("text"))
        for i, j in runs(offs):
            code, row = grams(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            names, which = np.unique(lang[i:j].astype(str), return_inverse=True)
            for k, name in enumerate(names):
                u, c = np.unique(code[which[row] == k], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(u), pa.string()), pa.array(u.astype(np.int64)), pa.array(c.astype(np.int64))], names=["lang", "gram", "n"])


@dataclass(frozen=True)
class Filters:
    languages: list[str]
    slots: np.ndarray  # (2**bits, words) of 64-bit masks
    false: np.ndarray  # chance of a false positive, by language

    def masks(self, code: np.ndarray) -> np.ndarray:
        out = None
        for at in probes(code, len(self.slots)):
            out = self.slots[at] if out is None else out & self.slots[at]
        return out


def probes(code: np.ndarray, size: int) -> list[np.ndarray]:
    """The slots of n-grams in a table of ``size`` (a power of two, up to 2**32)."""
    h = mix(code)
    return [((h >> np.uint64(32 * i)) & np.uint64(size - 1)).astype(np.int64) for i in range(PROBES)]


def slots_for(grams: int) -> int:
    """Slots that keep the false positives of a filter of ``grams`` at FALSE."""
    fill = FALSE ** (1 / PROBES)
    return 1 << max(LEAST_BITS, math.ceil(math.log2(max(1, -PROBES * grams / math.log(1 - fill)))))


def _edged(text):
    """Lower-case, with a blank at either end: short words have n-grams, too."""
    return F.concat(F.lit(" "), F.lower(text), F.lit(" "))


def train(texts: DataFrame) -> Filters | None:
    """Filters from ``texts`` (doc_id, text, lang).  Rows without text or lang
    teach nothing; None without any."""
    spark = texts.sparkSession
    bounded_batches(spark)
    texts = texts.where("text is not null and lang is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = {r.lang: r.n for r in texts.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    # about TEXTS_PER_LANGUAGE texts of each language, by a hash of the id
    share = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, TEXTS_PER_LANGUAGE / n))))
    pick = F.pmod(F.xxhash64(F.lit("train"), "doc_id", "text"), F.lit(1 << 20)) < F.get(F.array(share[F.col("lang")]), F.lit(0)) * (1 << 20)
    counts = texts.where(pick).select("lang", _edged(F.col("text")).alias("text")).mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    total = Window.partitionBy("lang")
    shares = counts.withColumn("f", F.col("n") / F.sum("n").over(total))
    languages = sorted(sizes, key=lambda k: (-sizes[k], k))  # the most common first: it wins ties
    number = F.create_map(*(F.lit(x) for k, name in enumerate(languages) for x in (name, k)))[F.col("lang")]
    # two numbers an n-gram, of the sampled texts only
    keep = (shares.withColumn("top", F.max("f").over(Window.partitionBy("gram"))).where(F.col("f") >= PART * F.col("top"))
            .select(number.cast("int").alias("k"), "gram").toPandas())
    of, gram = keep.k.to_numpy(), keep.gram.to_numpy().astype(np.uint64)
    slots = np.zeros((slots_for(int(np.bincount(of).max(initial=0))), -(-len(languages) // 64)), np.uint64)
    for at in probes(gram, len(slots)):
        np.bitwise_or.at(slots, (at, of // 64), np.uint64(1) << (of % 64).astype(np.uint64))
    fill = [((slots[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(languages))]
    return Filters(languages, slots, np.array(fill) ** PROBES)


def _predict(model, columns: list[str]):
    def run(batches):
        m = Filters(*model.value)
        names = np.array(m.languages, object)
        for batch in batches:
            buf, offs = as_bytes(batch.column("text"))
            best, score = [], []
            for i, j in runs(offs):
                code, row = grams(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                masks = m.masks(code)
                n = np.bincount(row, minlength=j - i).astype(float)
                hits = np.empty((len(names), j - i))
                for k in range(len(names)):
                    bit = ((masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).astype(float)
                    seen = np.bincount(row, bit, minlength=j - i)
                    hits[k] = np.maximum(seen - m.false[k] * n, 0) / (1 - m.false[k])
                best.append(hits.argmax(axis=0))
                score.append(hits.max(axis=0) / np.maximum(hits.sum(axis=0), 1e-9))
            best = np.concatenate([np.zeros(0, np.int64), *best])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(names[best], pa.string()), pa.array(np.minimum(np.concatenate([np.zeros(0), *score]), 1.0))],
                                             names=[*columns, "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Filters | None) -> DataFrame:
    """``row`` (a struct of the columns of ``docs`` but text), lang_pred and
    score (0 to 1: the winner's part of all languages' counts).

    ``und`` with score 0 for a null text, a text without any letter, or
    without a model.  A text of which no language contains an n-gram gets the
    most common language with score 0.  Only the text is looked at.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    df = docs.select(F.struct(*rest).alias("row"), _edged(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("known"))
    kind = df.schema["row"].dataType.simpleString()
    if model is None:
        return df.select("row", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    out = df.mapInArrow(lean(_predict(spark.sparkContext.broadcast((model.languages, model.slots, model.false)), ["row", "known"])), f"row {kind}, known boolean, lang_pred string, score double")
    return out.select("row", F.when(F.col("known"), F.col("lang_pred")).otherwise("und").alias("lang_pred"), F.when(F.col("known"), F.col("score")).otherwise(0.0).alias("score"))
