import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from docindex.llm import simhash
from docindex.llm.queries import op13_simhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text):
    w = WORD.findall((text or "").encode().translate(simhash.LOWER.tobytes()))
    parts = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)), len(h)


def groups(nodes, limit=3):
    """Smallest id by node; nodes: (id, code)."""
    root = list(range(len(nodes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (_, c) in enumerate(nodes):
        for j in range(i):
            if (c ^ nodes[j][1]).bit_count() <= limit:
                root[max(find(i), find(j))] = min(find(i), find(j))
    out = {}
    for i, (x, _) in enumerate(nodes):
        out.setdefault(find(i), []).append(x)
    return [min((x for x in out[find(i)] if x is not None), default=None) for i in range(len(nodes))]


def corpus(seed, n=120):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.randrange(3, 300))] for _ in range(12)]
    out = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"W{rng.randrange(400)}"
        out.append((i * 7 % n + 10, " ".join(w)))
    return out


EDGES = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "ONE "), (5, "one two"), (6, "a b c"), (None, "a  B\tc"), (None, "alone without an id here"), (6, "a b c"),
         (7, "É é É é"), (8, "Σ" * 5000 + " x" * 90_000)]


def test_codes():
    texts = [t for _, t in corpus(1) + EDGES]
    raw = [(t or "").encode() for t in texts]
    offs = np.cumsum([0] + [len(x) for x in raw])
    code, n = simhash.fingerprints(np.frombuffer(b"".join(raw), np.uint8), offs)
    assert list(zip(code.tolist(), n.tolist())) == [fingerprint(t) for t in texts]


def test_hash_is_sparks(spark):
    words = ["", "a", "one two three", "é" * 40, "x" * 1000]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w")).collect()
    assert [r[0] % 2**64 for r in rows] == [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]


def test_query(spark, tmp_path):
    rows = corpus(2) + EDGES
    spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    codes = [fingerprint(t) for _, t in rows]
    want = [(i, "%016x" % c, least, n) for (i, _), (c, n), least in zip(rows, codes, groups([(i, c) for (i, _), (c, _) in zip(rows, codes)]))]
    assert sorted((tuple(r) for r in op13_simhash(spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("heavy", [4, 1024])
def test_links_of_dense_codes(spark, heavy):
    """Codes close together, so that cells are cut down to their last bits."""
    rng = random.Random(heavy)
    codes = set()
    for c in (rng.getrandbits(64) for _ in range(5)):
        for _ in range(60):
            codes.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(8))))
    codes |= set(range(40)) | {rng.getrandbits(64) for _ in range(50)}
    codes = sorted(codes)
    df = spark.createDataFrame([(simhash._signed(c),) for c in codes], "code long")
    links = [(a % 2**64, b % 2**64) for a, b in simhash.code_links(df, 3, heavy).collect()]
    at = {c: i for i, c in enumerate(codes)}
    root = simhash._Forest(len(codes))
    root.join(np.array([at[a] for a, _ in links]), np.array([at[b] for _, b in links]))
    assert [codes[i] for i in root.root.tolist()] == groups([(c, c) for c in codes])


def test_pivots_discard_nothing_linked():
    rng = np.random.default_rng(5)
    code = rng.integers(0, 2**64, 300, dtype=np.uint64)
    code = np.concatenate([code, code ^ np.uint64(1 << 40), code ^ np.uint64(7 << 9), code ^ np.uint64(15)])
    code = code[np.argsort(np.bitwise_count(code ^ simhash.PIVOTS[0]), kind="stable")]
    got = {(int(i), int(j)) for a, b in simhash.near_pairs(code, np.zeros(len(code), np.int64), 3) for i, j in zip(a, b)}
    d = np.bitwise_count(code[:, None] ^ code[None, :])
    assert got == {(i, j) for i, j in zip(*np.where(d <= 3)) if i < j}


def test_empty_and_clashing(spark):
    df = spark.createDataFrame([(1, "a b c", 5, "x"), (2, "a b c", 6, None)], "doc_id long, text string, code long, component_id string")
    got = sorted((r.row.doc_id, r.row.code, r.row.component_id, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert got == [(1, 5, "x", 1), (2, 6, None, 1)]
    assert simhash.near_duplicates(df.limit(0)).collect() == []
