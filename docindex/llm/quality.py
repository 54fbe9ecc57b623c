"""Quality classifier by co-training.

Two classifiers see a document from different sides: one its text (hashed
words, shares of characters, repetition), the other its metadata (source,
language, length, and how length and language fit together).  Both start from
a sample of the labelled documents.  In each round a Spark job scores every
other document with both sides; each side hands those it is sure about, by a
threshold on its probability for their source and language, with its verdict
to the other.  Each side is then fitted anew: the handed documents come as sums
of their gradients over the whole corpus, the labelled sample gives the
curvature (a surrogate of the whole loss, as in distributed learning with one
exchange a round).  At the end each side's scores are calibrated on labelled
documents it was not fitted on, and a weighting fitted there combines them.
Every document is then scored by the whole text.

Toxicity is a cut of its own: words that labelled toxic documents have more
often than others carry evidence, and a document counts by its strongest word,
however long it is.

Only labelled documents are sampled (LABELLED, by a hash of the id); labelled
documents outside the sample take part as unlabelled ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Names, as_bytes, bounded_batches, lean, lean_group, runs, stored

#: Bound on the sample of labelled documents.
LABELLED = 4000
ROUNDS = 3
#: A side hands over the documents whose verdict it gives this probability.
SURE = 0.95
#: Weight of all handed documents together, against the labelled sample's 1 - this.
HANDED = 0.5
#: Pull towards the fit at which a round's sums were taken.
PULL = 1e-3
WORD_BITS = 15
META_BITS = 12
#: The sums of a round travel in so many parts.
PARTS = 64
BYTES = 256
SHAPE = 6
#: Text features: hashed words, bytes, and figures of the whole text.
TEXT_SIZE = (1 << WORD_BITS) + BYTES + SHAPE
_WORD = np.ones(256, bool)
_WORD[:48] = _WORD[58:65] = _WORD[91:97] = _WORD[123:128] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def text_features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed words as (row, feature, value), a dense block (rows x
    BYTES + SHAPE) of character shares and repetition, and the words' 64-bit
    names, for a run of texts."""
    rows = len(offs) - 1
    size = np.diff(offs)
    row = np.repeat(np.arange(rows), size)
    dense = np.zeros((rows, BYTES + SHAPE))
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), dense, np.zeros(0, np.uint64)
    dense[:, :BYTES] = np.bincount(row * 256 + buf, minlength=rows * 256).reshape(rows, 256) / np.maximum(size, 1)[:, None]
    text = _LOWER[buf]
    word = _WORD[text]
    start, end = np.empty(len(buf), bool), np.empty(len(buf), bool)
    start[0], end[-1] = True, True
    start[1:], end[:-1] = ~word[:-1], ~word[1:]
    start[offs[:-1][offs[:-1] < len(buf)]] = True
    end[offs[1:][offs[1:] > 0] - 1] = True
    s, e = np.flatnonzero(start & word), np.flatnonzero(end & word) + 1
    name = Names(text).of(s, e)
    at = row[s]
    words = np.bincount(at, minlength=rows)
    slot = (name >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    value = 1 / np.sqrt(np.maximum(words, 1))[at]
    # shape: length, word length, vocabulary, repeated neighbours, numbers of blanks
    dense[:, BYTES] = np.log1p(size) / 10
    dense[:, BYTES + 1] = np.log1p(words) / 10
    dense[:, BYTES + 2] = np.bincount(at, e - s, minlength=rows) / np.maximum(words, 1) / 10
    key = pd.unique((at.astype(np.uint64) << np.uint64(44)) | (name >> np.uint64(20)))
    dense[:, BYTES + 3] = np.bincount((key >> np.uint64(44)).astype(np.int64), minlength=rows) / np.maximum(words, 1)
    same = (name[1:] == name[:-1]) & (at[1:] == at[:-1])
    dense[:, BYTES + 4] = np.bincount(at[1:][same], minlength=rows) / np.maximum(words, 1)
    dense[:, BYTES + 5] = words > 0
    return at, slot, value, dense, name


def meta_columns(docs: DataFrame) -> list:
    """The metadata side: a few strings a document; each is hashed."""
    def of(name):
        return F.coalesce(F.col(name).cast("string"), F.lit("?")) if name in docs.columns else F.lit("?")
    n = F.coalesce(F.col("n_chars").cast("double"), F.lit(-1.0)) if "n_chars" in docs.columns else F.lit(-1.0)
    size = F.floor(F.log2(F.greatest(n, F.lit(0.0)) + 1) * 2).cast("string")
    return [F.concat(F.lit("source:"), of("source")), F.concat(F.lit("lang:"), of("lang")), F.concat(F.lit("size:"), size),
            F.concat(F.lit("lang size:"), of("lang"), F.lit(":"), size), F.concat(F.lit("source lang:"), of("source"), F.lit(":"), of("lang"))]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Sparse:
    """Rows of (feature, value), enough of a matrix for the fit below."""

    def __init__(self, row, col, val, rows, cols):
        order = np.argsort(row, kind="stable")
        self.row, self.col, self.val, self.rows, self.cols = row[order], col[order], val[order], rows, cols

    def dot(self, w):
        return np.bincount(self.row, self.val * w[self.col], minlength=self.rows)

    def tdot(self, r):
        return np.bincount(self.col, self.val * r[self.row], minlength=self.cols)

    def take(self, rows):
        rows = np.asarray(rows)
        at = np.searchsorted(self.row, rows)
        n = np.searchsorted(self.row, rows, side="right") - at
        i = np.arange(int(n.sum())) + np.repeat(at - (np.cumsum(n) - n), n)
        return Sparse(np.repeat(np.arange(len(rows)), n), self.col[i], self.val[i], len(rows), self.cols)


def balance(y: np.ndarray) -> np.ndarray:
    return np.where(y > 0.5, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / len(y)


def fit(x: Sparse, y: np.ndarray, start=None, steps: int = 120, l2: float = 1e-3, shift=None) -> tuple[np.ndarray, float]:
    """Logistic regression with balanced classes, by adaptive gradient steps.

    ``shift`` (weights, offset, pull) is added to the gradient: what other
    documents add to it at ``start``, with a pull towards ``start``."""
    w, b = (start[0].copy(), start[1]) if start is not None else (np.zeros(x.cols), 0.0)
    weight = balance(y)
    g2, gb2 = np.full(x.cols, 1e-8), 1e-8
    for _ in range(steps):
        r = (_sigmoid(x.dot(w) + b) - y) * weight
        g, gb = x.tdot(r) + l2 * w / 10, r.sum()
        if shift is not None:
            g, gb = g + shift[0] + shift[2] * (w - start[0]), gb + shift[1]
        g2 += g * g
        gb2 += gb ** 2
        w -= 0.5 * g / np.sqrt(g2)
        b -= 0.5 * gb / np.sqrt(gb2)
    return w, b


def calibrate(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn scores into log odds (Platt's scaling)."""
    scale = max(float(np.std(score)), 1e-9)
    x = Sparse(np.arange(len(score)), np.zeros(len(score), np.int64), score / scale, len(score), 1)
    w, b = fit(x, y, steps=200, l2=1e-4)
    return float(w[0]) / scale, float(b)


@dataclass(frozen=True)
class Side:
    """One side in a round: its fit, its scale, and by source and language
    how the labelled documents shift its log odds (others: not at all)."""

    fit: tuple[np.ndarray, float]
    scale: tuple[float, float]
    shifts: dict[str, float]
    trusted: bool

    def verdict(self, score: np.ndarray, group: list[str]) -> np.ndarray:
        """1 surely good, 0 surely bad, -1 neither; a side that doesn't beat
        the commoner class is never sure."""
        p = _sigmoid(self.scale[0] * score + self.scale[1] + np.array([self.shifts.get(g, 0.0) for g in group]))
        return np.where(p >= SURE, 1, np.where(p <= 1 - SURE, 0, -1)) if self.trusted else np.full(len(score), -1)


def side_of(fitted: tuple[np.ndarray, float], score: np.ndarray, y: np.ndarray, group: np.ndarray) -> Side:
    """Scale, shifts and trust from labelled documents outside the fit."""
    scale = calibrate(score, y)
    # balanced classes count alike in the scale; a verdict needs their real odds
    real = np.log(max(y.mean(), 1e-9) / max(1 - y.mean(), 1e-9))
    scale = (scale[0], scale[1] + real)
    p = _sigmoid(scale[0] * score + scale[1])
    frame = pd.DataFrame({"group": group, "off": y - p, "room": p * (1 - p)}).groupby("group").sum()
    # one step towards the group's own odds, held back where it has few labels
    shifts = (frame.off / (frame.room + 1)).to_dict()
    right = ((_sigmoid(score) > 0.5) == (y > 0.5)).mean()
    return Side(fitted, scale, shifts, bool(right > max(y.mean(), 1 - y.mean())))


def cut_of(p: np.ndarray, good: np.ndarray) -> float:
    """The cut that loses least, a good document counted four times; among
    equals the lowest, which keeps most."""
    cuts = np.append(0.5, np.unique(p))
    loss = [((p < c) & good).sum() / max(good.sum(), 1) * 4 + ((p >= c) & ~good).sum() / max((~good).sum(), 1) for c in cuts]
    best = cuts[np.flatnonzero(np.isclose(loss, min(loss)))]
    below = p[p < best.min()]
    return float(best.min() if not len(below) else (best.min() + below.max()) / 2)


@dataclass(frozen=True)
class Toxicity:
    """Words (64-bit names, ascending) that speak for toxicity, the log odds
    each carries at least, the scale of a document's strongest, and the cut."""

    names: np.ndarray
    weight: np.ndarray
    scale: tuple[float, float]
    cut: float

    def strongest(self, row: np.ndarray, name: np.ndarray, rows: int) -> np.ndarray:
        """The weight of each row's strongest word, 0 without any."""
        out = np.zeros(rows)
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, name), len(self.names) - 1)
            hit = self.names[at] == name
            np.maximum.at(out, row[hit], self.weight[at[hit]])
        return out

    def score(self, strongest: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale[0] * strongest + self.scale[1])


def fit_toxicity(words: list[np.ndarray], toxic: np.ndarray, fitted: np.ndarray, held: np.ndarray) -> Toxicity | None:
    """Evidence from the distinct words of the ``fitted`` documents, scale and
    cut from the ``held`` ones; None unless both have toxic and other ones."""
    if min(len(set(toxic[fitted])), len(set(toxic[held]))) < 2:
        return None
    sides = [np.concatenate([np.zeros(0, np.uint64), *(words[i] for i in fitted if toxic[i] == v)]) for v in (False, True)]
    names, with_it = np.unique(sides[1], return_counts=True)
    others, count = np.unique(sides[0], return_counts=True)
    at = np.minimum(np.searchsorted(others, names), max(len(others) - 1, 0))
    without = np.where(others[at] == names, count[at], 0) if len(others) else np.zeros(len(names))
    n = [(toxic[fitted] == v).sum() + 1 for v in (False, True)]
    # two standard errors below the estimate: chance words count for little
    weight = np.log((with_it + 0.5) / n[1]) - np.log((without + 0.5) / n[0]) - 2 * np.sqrt(1 / (with_it + 0.5) + 1 / (without + 0.5))
    told = Toxicity(names[weight > 0], weight[weight > 0], (0.0, 0.0), 0.0)
    strongest = told.strongest(np.repeat(np.arange(len(held)), [len(words[i]) for i in held]), np.concatenate([words[i] for i in held]), len(held))
    # the strongest word itself is cut, so it doesn't matter how the scale came out
    return Toxicity(told.names, told.weight, calibrate(strongest, toxic[held].astype(float)), -cut_of(-strongest, ~toxic[held]))


@dataclass(frozen=True)
class Model:
    text: tuple[np.ndarray, float]
    meta: tuple[np.ndarray, float]
    text_scale: tuple[float, float]
    meta_scale: tuple[float, float]
    blend: tuple[float, float, float]
    threshold: float
    toxicity: Toxicity | None


def _gather(batches):
    """Features of sampled documents, one row each."""
    for batch in batches:
        buf, offs = as_bytes(batch.column("text"))
        cols, vals, words = [], [], []
        for i, j in runs(offs):
            row, slot, value, dense, name = text_features(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            for k in range(j - i):
                a, b = np.searchsorted(row, [k, k + 1])
                u, c = np.unique(slot[a:b], return_counts=True)
                filled = np.flatnonzero(dense[k])
                cols.append(np.concatenate([u, (1 << WORD_BITS) + filled]).astype(np.int32))
                vals.append(np.concatenate([c * (value[a] if b > a else 0.0), dense[k][filled]]).astype(np.float32))
                words.append(np.unique(name[a:b]))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("good", "toxic", "meta")), *(pa.array([x.tobytes() for x in xs], pa.binary()) for xs in (cols, vals, words))],
                                         names=["good", "toxic", "meta", "cols", "vals", "words"])


def _meta_slots(meta: pd.Series) -> list[np.ndarray]:
    return [(pd.util.hash_array(np.array(list(m), object)) >> np.uint64(64 - META_BITS)).astype(np.int64) for m in meta]


def _meta_matrix(lists: pa.Array, rows: int) -> np.ndarray:
    """Slots of the metadata, rows x strings a document."""
    words = lists.flatten().dictionary_encode()
    if not len(words):
        return np.zeros((rows, 0), np.int64)
    return _meta_slots(pd.Series([words.dictionary.to_pylist()]))[0][words.indices.to_numpy()].reshape(rows, -1)


def sample_ids(labels: DataFrame) -> DataFrame:
    """(__id, good, toxic) of about LABELLED labelled documents.  Good: quality
    1; of repeated labels the worst counts."""
    told = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
            .agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")).select("doc_id", (F.col("q") == 1).cast("double").alias("good"), (F.col("t") != 0).alias("toxic")))
    share = F.lit(min(1.0, LABELLED / max(told.count(), 1)) * (1 << 20))
    some = told.where(F.pmod(F.xxhash64(F.lit("label"), "doc_id"), F.lit(1 << 20)) < share)
    return some.orderBy(F.xxhash64(F.lit("label"), "doc_id")).limit(2 * LABELLED).withColumnRenamed("doc_id", "__id")


def _width(view: int) -> int:
    """Sums of one side: both classes, each the features, the offset and the
    number of documents."""
    return 2 * ((TEXT_SIZE, 1 << META_BITS)[view] + 2)


def _hand_over(shared):
    """Sums over the documents of a task that one side is sure about: of each
    class, the gradient of the other side's loss, its offset's, and their
    number; text side first, in PARTS rows."""
    def run(batches):
        sides = tuple(Side(*x) for x in shared.value)
        sums = [np.zeros((2, _width(v) // 2)) for v in (0, 1)]
        for batch in batches:
            buf, offs = as_bytes(batch.column("text"))
            meta = _meta_matrix(batch.column("meta"), batch.num_rows)
            group = batch.column("meta").flatten().to_pylist()[meta.shape[1] - 1::meta.shape[1]] if batch.num_rows else []
            (w, b), (wm, bm) = sides[0].fit, sides[1].fit
            for i, j in runs(offs):
                row, slot, value, dense, _ = text_features(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                score = (np.bincount(row, w[slot] * value, minlength=j - i) + dense @ w[1 << WORD_BITS:] + b, wm[meta[i:j]].sum(axis=1) + bm)
                told = [side.verdict(x, group[i:j]) for side, x in zip(sides, score)]
                for v in (0, 1):
                    for label in (0, 1):
                        # the other side's verdict, unless this side is as sure of the opposite
                        mine = (told[1 - v] == label) & (told[v] != 1 - label)
                        if not mine.any():
                            continue
                        r = np.where(mine, _sigmoid(score[v]) - label, 0.0)
                        out = sums[v][label]
                        if v == 0:
                            out[:1 << WORD_BITS] += np.bincount(slot, r[row] * value, minlength=1 << WORD_BITS)
                            out[1 << WORD_BITS:TEXT_SIZE] += r @ dense
                        else:
                            out[:1 << META_BITS] += np.bincount(meta[i:j].ravel(), np.repeat(r, meta.shape[1]), minlength=1 << META_BITS)
                        out[-2] += r.sum()
                        out[-1] += mine.sum()
        if any(x[:, -1].any() for x in sums):
            parts = np.array_split(np.concatenate([x.ravel() for x in sums]), PARTS)
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], names=["part", "sums"])
    return run


def _add(table: pa.Table) -> pa.Table:
    # ascending, so the order of tasks doesn't matter
    rows = np.sort(np.stack([np.frombuffer(x, float) for x in table.column("sums").to_pylist()]), axis=0)
    return pa.table({"part": table.column("part")[:1], "sums": pa.array([rows.sum(axis=0).tobytes()], pa.binary())})


def hand_over(rest: DataFrame, sides: tuple[Side, Side]) -> list[np.ndarray]:
    """For each side (2 x features, offset, number): sums over all of ``rest``
    (meta, text), see _hand_over."""
    # plain values: a worker reads them without this module
    shared = rest.sparkSession.sparkContext.broadcast(tuple((s.fit, s.scale, s.shifts, s.trusted) for s in sides))
    parts = rest.mapInArrow(lean(_hand_over(shared)), "part int, sums binary").groupBy("part").applyInArrow(lean_group(_add), "part int, sums binary")
    got = {r.part: np.frombuffer(r.sums, float) for r in parts.collect()}  # PARTS rows of a fixed size
    whole = np.concatenate([got[k] for k in range(PARTS)]) if got else np.zeros(_width(0) + _width(1))
    return [x.reshape(2, -1) for x in np.split(whole, [_width(0)])]


def refit(x: Sparse, y: np.ndarray, model: tuple[np.ndarray, float], sums: np.ndarray) -> tuple[np.ndarray, float]:
    """A side fitted anew to the labelled sample and the handed documents;
    each class of the latter has equal weight, as in the sample."""
    number = sums[:, -1]
    if not number.all():  # one class alone says nothing about the difference
        return fit(x, y, model, steps=60)
    handed = (sums[:, :-1] / number[:, None]).sum(axis=0) / 2
    r = (_sigmoid(x.dot(model[0]) + model[1]) - y) * balance(y)
    return fit(x, y, model, steps=60, shift=(HANDED * (handed[:-1] - x.tdot(r)), HANDED * (handed[-1] - r.sum()), PULL))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from ``docs`` (doc_id, text and any of source, lang, n_chars)
    and ``labels`` (doc_id, quality, toxic); None unless both classes occur.

    Documents without text or id teach nothing, repeated rows count as often as
    they occur, labels that contradict each other count as the worst of them,
    whole texts count, and other columns of ``docs`` may have any name."""
    bounded_batches(docs.sparkSession)
    # at most 2 * LABELLED short rows: small at any input size
    chosen = F.broadcast(stored(sample_ids(labels), "labelled"))
    same = F.col("doc_id") == F.col("__id")
    # columns of any other name stay out of the joins
    whole = docs.where("text is not null").select("doc_id", F.array(*meta_columns(docs)).alias("meta"), F.col("text").cast("string").alias("text"))
    drawn = whole.join(chosen, same).select("good", "toxic", "meta", "text")
    rest = whole.join(chosen, same, "left_anti").where("text <> ''").select("meta", "text")
    got = drawn.mapInArrow(lean(_gather), "good double, toxic boolean, meta array<string>, cols binary, vals binary, words binary").toPandas()
    got = got.sort_values(["cols", "vals", "good", "toxic"]).reset_index(drop=True)  # the order of tasks doesn't matter
    y = got.good.to_numpy(float)
    known = np.arange(len(y))
    toxic = got.toxic.isin([True]).to_numpy(bool)
    if len(set(y[known])) < 2:  # labels that differ in toxicity only
        y = np.where(toxic & (y > 0.5), 0.0, y)
    if len(known) < 4 or len(set(y[known])) < 2:
        return None
    cols, vals = [np.frombuffer(c, np.int32) for c in got.cols], [np.frombuffer(v, np.float32) for v in got.vals]
    row = np.repeat(np.arange(len(cols)), [len(c) for c in cols])
    text = Sparse(row, np.concatenate(cols).astype(np.int64), np.concatenate(vals).astype(float), len(got), TEXT_SIZE)
    slots = _meta_slots(got.meta)
    meta = Sparse(np.repeat(np.arange(len(slots)), [len(s) for s in slots]), np.concatenate(slots), np.ones(sum(map(len, slots))), len(got), 1 << META_BITS)
    views = (text, meta)
    # a quarter of the labelled documents is kept for calibration
    order = np.random.default_rng(5).permutation(known)
    held, fitted = order[:max(2, len(order) // 4)], order[max(2, len(order) // 4):]
    if len(set(y[held])) < 2 or len(set(y[fitted])) < 2:
        held = fitted = known
    group = np.array([m[-1] for m in got.meta], object)
    models = [fit(x.take(fitted), y[fitted], steps=150) for x in views]
    for _ in range(ROUNDS):
        sides = tuple(side_of(m, x.take(held).dot(m[0]) + m[1], y[held], group[held]) for m, x in zip(models, views))
        # no side trusted: nothing would be handed over
        handed = hand_over(rest, sides) if any(s.trusted for s in sides) else [np.zeros((2, x.cols + 2)) for x in views]
        for v, (x, sums) in enumerate(zip(views, handed)):
            models[v] = refit(x.take(fitted), y[fitted], models[v], sums)
    scores = [x.take(held).dot(m[0]) + m[1] for x, m in zip(views, models)]
    scales = [calibrate(s, y[held]) for s in scores]
    odds = [a * s + b for (a, b), s in zip(scales, scores)]
    blend = blend_of(odds, y[held])
    p = _sigmoid(blend[0] * odds[0] + blend[1] * odds[1] + blend[2])
    threshold = cut_of(p, y[held] > 0.5)
    toxicity = fit_toxicity([np.frombuffer(w, np.uint64) for w in got.words], toxic, fitted, held)
    return Model(models[0], models[1], scales[0], scales[1], blend, threshold, toxicity)


def _plain(m: Model) -> tuple:
    """The parts of a model as arrays, tuples and numbers."""
    t = m.toxicity
    return (m.text, m.meta, m.text_scale, m.meta_scale, m.blend, m.threshold, t and (t.names, t.weight, t.scale, t.cut))


def blend_of(odds: list[np.ndarray], y: np.ndarray) -> tuple[float, float, float]:
    """Weights of both views' log odds and an offset; a view that would count
    against itself is left out."""
    used = [0, 1]
    while True:
        n = len(y)
        x = Sparse(np.tile(np.arange(n), len(used)), np.repeat(np.arange(len(used)), n), np.concatenate([odds[v] for v in used]) / 4, n, len(used))
        w, b = fit(x, y, steps=200, l2=1e-4)
        if len(used) == 1 or min(w) >= 0:
            weight = [0.0, 0.0]
            for v, value in zip(used, w):
                weight[v] = max(float(value), 0.0) / 4
            return weight[0], weight[1], float(b)
        used = [used[int(np.argmax(w))]]


def _score(shared, columns):
    def run(batches):
        *parts, toxicity = shared.value
        m = Model(*parts, Toxicity(*toxicity) if toxicity else None)
        w, b = m.text
        for batch in batches:
            buf, offs = as_bytes(batch.column("text"))
            text, strongest = [np.zeros(0)], [np.zeros(0)]
            for i, j in runs(offs):
                row, slot, value, dense, name = text_features(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                text.append(np.bincount(row, w[slot] * value, minlength=j - i) + dense @ w[1 << WORD_BITS:] + b)
                strongest.append(m.toxicity.strongest(row, name, j - i) if m.toxicity else np.zeros(j - i))
            text, strongest = np.concatenate(text), np.concatenate(strongest)
            meta = m.meta[0][_meta_matrix(batch.column("meta"), len(text))].sum(axis=1) + m.meta[1]
            odds = [a * s + c for (a, c), s in zip((m.text_scale, m.meta_scale), (text, meta))]
            p = _sigmoid(m.blend[0] * odds[0] + m.blend[1] * odds[1] + m.blend[2])
            toxic = m.toxicity.score(strongest) if m.toxicity else np.zeros(len(p))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(_sigmoid(odds[0])), pa.array(_sigmoid(odds[1])), pa.array(p * (1 - toxic)),
                                              pa.array(toxic), pa.array((p >= m.threshold) & (strongest <= m.toxicity.cut if m.toxicity else True))],
                                             names=[*columns, "text_score", "meta_score", "score", "toxic_score", "keep"])
    return run


def classify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), text_score, meta_score,
    score (0 to 1), toxic_score and keep, for every row.

    score is the probability of quality times that of not being toxic; keep
    asks for enough quality and for no word beyond the cut of toxicity.
    Without toxic labels toxic_score is 0.  A null or empty text scores 0 and is not kept.  Without a model (no labels
    of both kinds) every document with text is kept with score null.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.array(*meta_columns(docs)).alias("meta"), text.alias("text"), (F.length(text) > 0).alias("some"))
    if model is None:
        none = F.lit(None).cast("double")
        return df.select("row", none.alias("text_score"), none.alias("meta_score"), F.when(~F.col("some"), 0.0).alias("score"), none.alias("toxic_score"), F.col("some").alias("keep"))
    kind = df.schema["row"].dataType.simpleString()
    out = df.mapInArrow(lean(_score(spark.sparkContext.broadcast(_plain(model)), ["row", "some"])), f"row {kind}, some boolean, text_score double, meta_score double, score double, toxic_score double, keep boolean")
    return out.select("row", "text_score", "meta_score", F.when(F.col("some"), F.col("score")).otherwise(0.0).alias("score"), "toxic_score",
                      (F.col("some") & F.col("keep")).alias("keep"))
