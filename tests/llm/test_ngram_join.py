import random
import re

import pytest

from docindex.llm.ngram_join import Similarity, one_of_each, similar_documents


def shingles(text, width=5):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(zip(*[w[i:] for i in range(width)])) if len(w) >= width else frozenset([tuple(w)])


def brute(rows):
    """component by doc_id, over all pairs."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for k, (a, s) in enumerate(sets):
        for b, t in sets[:k]:
            inter = len(s & t)
            if s and t and 100 * inter >= 75 * (len(s) + len(t) - inter):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def got(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id) for r in df.collect())


def corpus(seed, n=60, words=12, length=40):
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(words * 20)
    bases = [[word() for _ in range(rng.randrange(3, length))] for _ in range(6)]
    rows = []
    for i in range(n):
        t = list(rng.choice(bases))
        for _ in range(rng.randrange(0, 4)):
            t[rng.randrange(len(t))] = word()
        rows.append((i * 7 % n, " ".join(t).replace("w1", "W1" if rng.random() < 0.5 else "w1")))
    return rows


# words that a polynomial modulo 2**64 can't tell apart
MORSE = ["".join(pair[i.bit_count() & 1] for i in range(2048)) for pair in ("ab", "ba")]
EDGES = [(1010, MORSE[0]), (1011, MORSE[1]), (1012, f"{MORSE[0]} x y z w"), (1013, f"{MORSE[1]} x y z w"), (1000, None), (1001, ""), (1002, " \t\n"), (1003, "one two"), (1004, "One  TWO"), (1005, "É É É É É É"), (1006, "é é é é é é"),
         (1007, "a b c d e"), (1007, "a b c d e"), (1008, "A B C D E"), (None, "a b c d e"), (None, None), (1009, "x" * 100_000 + " " + "y z " * 50_000)]


@pytest.mark.parametrize("seed,ways", [(0, {}), (1, {"short_list": 2}), (2, {"short_list": 2, "hot_list": 2.0, "leaders": 1})])
def test_equals_all_pairs(spark, seed, ways):
    rows = corpus(seed) + EDGES + [(i % 9 + 100 * (seed % 2), t) for i, t in corpus(seed + 9, 30)]  # repeated ids, too
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    expect = sorted((-1 if i is None else i, len(shingles(t)), None if i is None else want[i]) for i, t in rows)
    assert got(similar_documents(df, **ways)) == expect


def test_repeated_id_is_one_document(spark):
    a, b = "a b c d e f g h i j", "k l m n o p q r s t"
    df = spark.createDataFrame([(1, a), (5, a), (5, b), (3, b)], "doc_id long, text string")
    assert {r.component_id for r in similar_documents(df).collect()} == {1}


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert similar_documents(empty).collect() == []
    rows = [(1, "a b c d e f", "x", 9), (2, "a b c d e f", "y", 8), (3, None, "z", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string, n long")
    out = one_of_each(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_threshold_is_exact(spark):
    s = Similarity()
    # 8 words have 4 shingles; sharing 6 of 8 is exactly 0.75
    base = [f"w{i}" for i in range(11)]  # 7 shingles
    longer = base + ["q1"]  # 8 shingles, 7 shared: 7 / 8
    two = base + ["q1", "q2", "q3"]  # 10 shingles: 7 / 10 is not enough
    rows = [(1, " ".join(base)), (2, " ".join(longer)), (3, " ".join(two))]
    out = {r.doc_id: r.component_id for r in similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), s).collect()}
    assert out == {1: 1, 2: 1, 3: 1}  # 3 links with 2: 8 / 10
    out = {r.doc_id: r.component_id for r in similar_documents(spark.createDataFrame([rows[0], rows[2]], "doc_id long, text string"), s).collect()}
    assert out == {1: 1, 3: 3}
