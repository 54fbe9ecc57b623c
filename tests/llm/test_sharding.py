from pyspark.sql import functions as F

from docindex.llm import sharding


def test_counts_mixture_and_slots(spark, monkeypatch):
    monkeypatch.setattr(sharding, "GROUP_ROWS", 40)  # several buckets
    rows = [(i, "hot" if i % 3 else f"s{i % 7}") for i in range(1000)] + [(None, None), (5, "hot"), (5, "hot")]
    df = spark.createDataFrame(rows, "doc_id long, source string").repartition(4)
    out = [tuple(r) for r in sharding.shard(df, 16).select("doc_id", "source", "shard", "slot").collect()]
    assert sorted((i or -1, s or "") for i, s, _, _ in out) == sorted((i or -1, s or "") for i, s in rows)
    by = {k: [r for r in out if r[2] == k] for k in range(16)}
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    for part in by.values():
        assert sorted(r[3] for r in part) == list(range(len(part)))
        hot = sum(r[1] == "hot" for r in part)
        assert abs(hot - sum(s == "hot" for _, s in rows) / 16) <= 4
    again = [tuple(r) for r in sharding.shard(df.repartition(2), 16).select("doc_id", "source", "shard", "slot").collect()]
    assert sorted(map(str, out)) == sorted(map(str, again))  # the same however the input lies
    other = [tuple(r) for r in sharding.shard(df, 16, seed=1).select("doc_id", "source", "shard", "slot").collect()]
    assert sorted(map(str, out)) != sorted(map(str, other))


def brute(rows, shards):
    """(shard, slot) by row: ranks in each source by hash, fractional ranks,
    equal cuts; ``rows``: (key, source, hash)."""
    by = {}
    for k, s, h in rows:
        by.setdefault(s, []).append((h, k))
    order = []
    for s, part in by.items():
        order += [((i + 0.5) / len(part), s or "", k) for i, (_, k) in enumerate(sorted(part))]
    order.sort()
    n, out, used = len(order), {}, {}
    for p, (_, _, k) in enumerate(order):
        shard = p * shards // n
        out[k] = (shard, used.get(shard, 0))
        used[shard] = used.get(shard, 0) + 1
    return out


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sharding, "GROUP_ROWS", 40)
    monkeypatch.setattr(sharding, "GROUP", 3)
    rows = [(i, "hot" if i % 3 else None if i % 7 == 0 else f"s{i % 5}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string").repartition(3)
    h = {r.doc_id: r.h for r in df.select("doc_id", F.xxhash64(F.lit(17), "doc_id").alias("h")).collect()}
    # hashes count from the bucket's bits on
    fine = 32
    want = brute([(i, s, ((h[i] % 2**64 >> 40) % fine, h[i])) for i, s in rows], 16)
    assert {r.doc_id: (r.shard, r.slot) for r in sharding.shard(df, 16).collect()} == want


def test_equal_rows_are_dealt_out(spark, monkeypatch):
    """A third of all rows equal: no window ranks all of them."""
    monkeypatch.setattr(sharding, "GROUP_ROWS", 20)
    rows = [(7, "hot")] * 700 + [(i, f"s{i % 5}") for i in range(1400)]
    df = spark.createDataFrame(rows, "doc_id long, source string").repartition(5)
    seen, plain = [], sharding.running_sums
    monkeypatch.setattr(sharding, "running_sums", lambda c, b, by: seen.append(max(r.c for r in c.collect())) or plain(c, b, by))
    out = sharding.shard(df, 16).collect()
    assert seen[0] <= 4 * 20 + 40 and seen[1] <= 80
    by = [[r for r in out if r.shard == k] for k in range(16)]
    assert sorted((r.doc_id, r.source) for r in out) == sorted(rows)
    assert max(map(len, by)) - min(map(len, by)) <= 1 and all(sorted(r.slot for r in p) == list(range(len(p))) for p in by)
    assert all(abs(sum(r.source == "hot" for r in p) - 700 / 16) <= 2 for p in by)


def test_clashing_columns(spark):
    rows = [(i, "a", i, i + 1, i + 2, i + 3, i + 4) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, position long, total long, shard long, shard_ long, u long")
    out = sharding.shard(df, 4)
    assert out.columns == ["doc_id", "source", "position", "total", "shard__", "shard_", "u", "shard", "slot"]
    assert sorted((r.doc_id, r.position, r.total, r.shard__, r.shard_, r.u) for r in out.collect()) == [(i, i, i + 1, i + 2, i + 3, i + 4) for i in range(40)]
    assert sharding.interleave(df, "source", ["doc_id"], 1).columns[:4] == ["doc_id", "source", "position_", "total_"]


def test_small_and_empty(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, source string")
    assert sorted(r.slot for r in sharding.shard(df, 16).collect()) == [0, 0]
    assert sharding.shard(df.limit(0), 16).collect() == []


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, source string")
    plan = sharding.shard(df, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
