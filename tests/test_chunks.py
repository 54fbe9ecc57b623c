"""Chunks of bulk streams against a loop."""

import random

import pytest

from docindex.operators.chunks import chunks


def loop(sizes, max_rows, max_bytes):
    out, rows, held = [], 0, 0
    for s in sizes:
        if rows and (rows == max_rows or held + s > max_bytes):
            out.append(out[-1] + 1)
            rows, held = 0, 0
        else:
            out.append(out[-1] if out else 0)
        rows, held = rows + 1, held + s
    return out


@pytest.mark.parametrize("max_rows,max_bytes", [(1, 100), (7, 100), (500, 60), (3, 10**9), (10**6, 10**9)])
def test_equals_a_loop(spark, max_rows, max_bytes):
    rng = random.Random(max_rows)
    streams = {"a": [rng.choice([0, 1, 10, 40, 61, 200]) for _ in range(150)], "b": [5] * 90, "c": [1000], "d": [0, 0, 0], "e": [60, 40, 60, 41]}
    rows = [(s, i, None if x == 0 and i % 2 else x) for s, sizes in streams.items() for i, x in enumerate(sizes)]
    df = spark.createDataFrame(rows, "stream string, at int, size long").repartition(5)
    got = {}
    for r in chunks(df, "stream", ["at"], "size", max_rows, max_bytes).orderBy("stream", "at").collect():
        got.setdefault(r.stream, []).append(r.chunk)
    assert got == {s: loop(sizes, max_rows, max_bytes) for s, sizes in streams.items()}


def test_edges(spark):
    df = spark.createDataFrame([], "stream string, at int, size long")
    assert chunks(df, "stream", ["at"], "size").collect() == []
    with pytest.raises(ValueError):
        chunks(df, "stream", ["at"], "size", max_rows=0)
