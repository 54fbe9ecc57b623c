import random

import numpy as np
import pytest

from docindex.llm.suffix_dedup import Shape, remove_repeats, sliding_least, with_kept_text


def brute(rows, span):
    """(n_bytes, n_removed, spans, kept) of each row, in order."""
    first, out = {}, []
    for i, t in rows:
        if i is not None:
            b = (t or "").encode()
            for j in range(len(b) - span + 1):
                w = b[j:j + span]
                first[w] = min(first.get(w, i), i)
    for i, t in rows:
        b = (t or "").encode()
        mark = bytearray(len(b))
        if i is not None:
            for j in range(len(b) - span + 1):
                if first[b[j:j + span]] < i:
                    mark[j:j + span] = b"\1" * span
        spans = len(bytes(mark).replace(b"\0", b" ").split())
        out.append((-1 if i is None else i, len(b), sum(mark), spans, bytes(x for x, m in zip(b, mark) if not m)))
    return sorted(out)


def got(df):
    rows = []
    for r in df.collect():
        for s in r.spans:
            assert 0 <= s.start < s.end <= r.n_bytes
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(x.end < y.start for x, y in zip(r.spans, r.spans[1:]))
        rows.append((-1 if r.row.doc_id is None else r.row.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)))
    return sorted(rows)


def corpus(seed, n=40):
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choice("abcé \n") for _ in range(k))
    parts = [text(rng.randrange(30, 160)) for _ in range(6)]
    rows = []
    for i in range(n):
        t = "".join(rng.choice(parts) if rng.random() < 0.5 else text(rng.randrange(0, 60)) for _ in range(rng.randrange(0, 5)))
        rows.append((rng.randrange(n), t))
    return rows


EDGES = [(500, None), (501, ""), (502, "x" * 49), (503, "x" * 50), (504, "x" * 51), (505, "ab" * 3000), (506, "ab" * 40), (507, "ab" * 40), (507, "ab" * 40), (None, "ab" * 40), (None, None)]


@pytest.mark.parametrize("seed,batches", [(0, 1), (1, 4), (2, 3)])
def test_equals_brute_force(spark, seed, batches):
    rows = corpus(seed) + EDGES
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(remove_repeats(df, batches=batches)) == brute(rows, 50)


def test_other_spans_and_small_blocks(spark):
    rows = corpus(7)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert got(remove_repeats(df, Shape(span=20, head=9), batches=5, block_bytes=500)) == brute(rows, 20)


def test_whole_characters(spark):
    """A half character at a span's edge goes, U+FFFD of the text stays, and
    bytes on both sides of a span make no new character."""
    same = "é" * 30
    rows = [(1, "x" * 3 + same), (2, "a\ufffd€" + same + "é\ufffdend"), (3, "plain \ufffd"), (4, None), (5, "\u20ac" + "y" * 60), (6, "y" * 60 + "\u20ac"), (7, "\u20ad" + "y" * 60 + "\u20ac")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = with_kept_text(remove_repeats(df)).collect()
    for r in out:
        raw = (dict(rows)[r.row.doc_id] or "").encode()
        keep = np.ones(len(raw), bool)
        for s in r.spans:
            a, b = s.start, s.end
            while a > 0 and raw[a] & 0xC0 == 0x80:
                a -= 1
            while b < len(raw) and raw[b] & 0xC0 == 0x80:
                b += 1
            keep[a:b] = False
        assert r.kept_text == bytes(np.frombuffer(raw, np.uint8)[keep]).decode(), r
    assert {r.row.doc_id: r.kept_text for r in out}[2].startswith("a\ufffd€")


def test_empty_table_and_clashing_columns(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([(1, "z" * 60, "k", 3), (2, "z" * 60, None, 4)], "doc_id long, text string, kept string, block int")
    out = {r.row.doc_id: r for r in remove_repeats(df).collect()}
    assert out[1].row.kept == "k" and out[2].row.block == 4
    assert bytes(out[1].kept) == b"z" * 60 and bytes(out[2].kept) == b""


@pytest.mark.parametrize("width", [1, 2, 3, 7, 27, 31])
def test_sliding_least(width):
    x = np.random.default_rng(width).integers(0, 50, 80).astype(np.uint64)
    assert sliding_least(x, width).tolist() == [int(x[i:i + width].min()) for i in range(len(x) - width + 1)]
