import random

import pytest
from pyspark.sql import functions as F

from docindex.llm.hamming import sign_code, top_k


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute(points, queries, k):
    out = []
    p = {(i, c) for i, c in points if i is not None and c is not None}
    for q, c in sorted({(i, c) for i, c in queries if i is not None and c is not None}):
        near = sorted((bin((c ^ x) & (2**64 - 1)).count("1"), i) for i, x in p)[:k]
        out += [(q, r, i, d) for r, (d, i) in enumerate(near, 1)]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r.rank, r.id, r.distance) for r in df.collect())


@pytest.mark.parametrize("segments,spread", [(None, 64), (8, 6)])
def test_equals_brute_force(spark, segments, spread):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    code = lambda: signed(centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(spread))) & (2**64 - 1))
    points = [(i, code()) for i in range(150)] + [(200 + i, signed(centre)) for i in range(40)]  # a group of copies
    points += [(None, code()), (900, None), (3, points[3][1])]
    queries = points[::10] + [(None, 1), (901, None)]
    df, q = spark.createDataFrame(points, "vec_id long, code long"), spark.createDataFrame(queries, "vec_id long, code long")
    assert got(top_k(df, q, k=5, segments=segments)) == brute(points, queries, 5)


def test_few_points_and_empty(spark):
    df = spark.createDataFrame([(1, 0), (2, 3)], "vec_id long, code long")
    assert got(top_k(df, df, k=5)) == brute([(1, 0), (2, 3)], [(1, 0), (2, 3)], 5)
    assert top_k(df.limit(0), df, k=5).collect() == [] and top_k(df, df.limit(0), k=5).collect() == []


def test_sign_code(spark):
    df = spark.createDataFrame([([1.0, -1.0, float("nan"), None, 2.0],), (None,), ([],)], "v array<double>")
    assert [r.c for r in df.select(sign_code(F.col("v")).alias("c")).collect()] == [0b10001, None, 0]


@pytest.mark.parametrize("segments", [4, 16])
def test_heavy_values_and_many_blocks(spark, monkeypatch, segments):
    """A third of all codes share a segment's value: it lies in several blocks."""
    from docindex.llm import hamming
    monkeypatch.setattr(hamming, "BLOCK_CODES", 12)
    rng = random.Random(segments)
    points = [(i, signed(rng.getrandbits(64) if i % 3 else rng.getrandbits(48) << 16 | 0xBEEF)) for i in range(240)]
    points += [(300 + i, signed((points[i][1] ^ 1 << i % 64) & (2**64 - 1))) for i in range(0, 240, 4)]
    df = spark.createDataFrame(points, "vec_id long, code long")
    ask = df.where("vec_id % 10 = 0")
    assert got(top_k(df, ask, k=3, segments=segments)) == brute(points, [p for p in points if p[0] % 10 == 0], 3)


def test_queries_go_to_the_blocks_of_their_probes(spark):
    from docindex.llm.hamming import _asked, _masks
    open_ = spark.createDataFrame([(signed(i * 0x9E3779B97F4A7C15 % 2**64),) for i in range(50)], "q long")
    assert _asked(open_, 4, _masks(16, 0), 1000, None).count() == 50 * 4
    assert _asked(open_, 4, _masks(16, 1), 1000, None).count() <= 50 * 4 * 16
    assert _asked(open_, 4, _masks(16, 1), 8, None).count() == 50 * 4 * 8
