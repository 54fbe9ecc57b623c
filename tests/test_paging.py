"""Pages of a deep scan: boundaries from counts, ties, missing values."""

import random

import pytest

from docindex.sources.paging import after, pages, positions, rows_after


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    # a third of all rows share one key, some have none
    return [(i, None if i % 17 == 0 else "hot" if i % 3 == 0 else f"k{rng.randrange(40):02d}", rng.randrange(5)) for i in range(1000)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "_id long, name string, n int").repartition(7)


def ordered(rows, desc):
    # missing values last in either direction
    return sorted(sorted(rows, key=lambda r: r[0]), key=lambda r: (r[1] is None, [(-ord(c) if desc else ord(c)) for c in (r[1] or "") + ("\x00" if not desc else "\U0010ffff")]))


@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("ranges", [1, 9])
def test_positions(df, rows, direction, ranges):
    got = {r._id: r.position for r in positions(df, [("name", direction)], ranges=ranges).collect()}
    assert got == {r[0]: p for p, r in enumerate(ordered(rows, direction == "desc"))}


@pytest.mark.parametrize("size", [1, 7, 100, 999, 1000, 5000])
def test_pages_and_rows_after(df, rows, size):
    want = ordered(rows, False)
    got = sorted(pages(df, ["name"], size).collect())
    assert [(p.page, p.first._id, p.last._id, p.rows) for p in got] == [
        (k, c[0][0], c[-1][0], len(c)) for k, c in ((i // size, want[i:i + size]) for i in range(0, len(want), size))]
    if size == 100:
        for p in (3, 9):  # the page after the last key of the one before
            key = got[p - 1].last
            page = rows_after(df, ["name"], size, (key.name, key._id)).collect()
            assert [r._id for r in page] == [r[0] for r in want[p * size:(p + 1) * size]]
        assert rows_after(df, ["name"], size, (got[-1].last.name, got[-1].last._id)).collect() == []
        assert [r._id for r in rows_after(df, ["name"], 3).collect()] == [r[0] for r in want[:3]]


def test_edges(df):
    assert pages(df.limit(0), ["name"], 10).collect() == []
    with pytest.raises(ValueError):
        pages(df, ["name"], 0)
    with pytest.raises(ValueError):
        positions(df, [("name", "up")])
    with pytest.raises(ValueError):
        after(["name"], ["x"])


def test_no_task_orders_everything(df):
    plan = positions(df, ["name"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("Window")[-1].split("BroadcastExchange")[0] or "position" in plan
    assert pages(df, ["name"], 50).count() == 20
