import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from docindex.llm.periodic import collapse_runs, periodic_runs, planted, repeated
from docindex.llm.queries import op11_periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    """All runs: for every lag the longest stretches that keep it."""
    out = {}
    for d in range(1, len(w) // 4 + 1):
        i = d
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - d]:
                j += 1
            if j - i + d >= max(6, 4 * d):
                out.setdefault((i - d, j - i + d), d)  # the smallest lag comes first
            i = j + 1
    return sorted((s, n, d) for (s, n), d in out.items())


def collapsed(w, found):
    gone = {k for s, n, d in found for k in range(s + d, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def changed(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return text
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(n))


def texts(seed, n=300):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        kinds = "ab" if rng.random() < 0.5 else "abcdefgh"
        w = []
        while len(w) < rng.randrange(80):
            part = [rng.choice(kinds) for _ in range(rng.randrange(1, 9))]
            w += part * rng.choice([1, 1, 2, 3, 4, 5, 9])
        out.append(w)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_all_lags(seed):
    some = texts(seed)
    numbers = {x: i for i, x in enumerate("abcdefgh")}
    code = np.array([numbers[x] for w in some for x in w])
    text = np.repeat(np.arange(len(some)), [len(w) for w in some])
    start, length, period = periodic_runs(code, text)
    first = np.cumsum([0] + [len(w) for w in some])
    got = [[] for _ in some]
    for s, n, d in zip(start.tolist(), length.tolist(), period.tolist()):
        k = int(text[s])
        got[k].append((s - int(first[k]), n, d))
    assert got == [brute(w) for w in some]
    gone = repeated(len(code), start, length, period)
    for w, k in zip(some, first):
        assert " ".join(x for x, y in zip(w, gone[k:k + len(w)]) if not y) == collapsed(w, brute(w))


def test_one_word_repeated():
    n = 100_000
    assert [x.tolist() for x in periodic_runs(np.zeros(n, np.int64), np.zeros(n, np.int64))] == [[0], [n], [1]]
    code = np.tile(np.arange(1000), 40)
    assert [x.tolist() for x in periodic_runs(code, np.zeros(40_000, np.int64))] == [[0], [40_000], [1000]]
    assert [len(x) for x in periodic_runs(np.zeros(0, np.int64), np.zeros(0, np.int64))] == [0, 0, 0]


EDGES = [(0, None), (1, ""), (2, " \t\n "), (3, "x x x x x"), (4, "x x x x x x"), (None, "a b a b a b a b"), (5, "é é é é " * 7), (6, "\x0bX x " * 9 + "end"),
         (6, "\x0bX x " * 9 + "end"), (7, "long " * 30_000 + "w v " * 20_000), (8, "one  two\tone\ntwo one two one two")]


def rows_of(n=400):
    return EDGES + [(100 + i, ("  " if i % 3 else "\n").join(w)) for i, w in enumerate(texts(9, n))]


def test_frames(spark):
    rows = [(i, t, "r", i) for i, t in rows_of(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, runs long").repartition(3)
    got = sorted(((r.row.doc_id if r.row.doc_id is not None else -1, r.row.row, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in collapse_runs(df).collect()), key=str)
    want = []
    for i, t, x, _ in rows:
        w = WORD.findall(t or "")
        found = brute(w) if len(w) < 1000 else [(0, 30_000, 1), (30_000, 40_000, 2)]
        want.append((-1 if i is None else i, x, len(w), found, collapsed(w, found)))
    assert got == sorted(want, key=str)
    assert collapse_runs(df.limit(0)).collect() == []


def test_query(spark, tmp_path):
    rows = rows_of()
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").repartition(4)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((str(r.doc_id), r.text or "") for r in planted(df).collect()) == sorted((str(i), changed(i, t) or "") for i, t in rows)
    assert sum(changed(i, t) != t for i, t in rows) > 10
    want = []
    for i, t in rows:
        w = WORD.findall(changed(i, t) or "")
        found = brute(w) if len(w) < 1000 else [(0, 30_000, 1), (30_000, 40_000, 2)]
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join("%d,%d,%d\n" % r for r in found), collapsed(w, found))]
        want.append((i, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2], *sha))
    assert sorted((tuple(r) for r in op11_periodic_runs(spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)
