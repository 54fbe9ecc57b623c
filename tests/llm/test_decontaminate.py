import re

import pytest

from docindex.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, bench, width=10):
    wins = {}
    for i, t in bench:
        w = words(t)
        m = min(width, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            wins.setdefault(tuple(w[k:k + m]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, items = words(t), set(), set()
        for win, ids in wins.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    items |= {str(x) for x in ids if x is not None}
        out.append((i or 0, len(w), sorted(hit), sorted(items)))
    return sorted(out)


PASSAGE = "the quick brown fox jumps over the lazy dog and runs away"
BENCH = [(10, PASSAGE), (9, "x " + PASSAGE), (7, "short item"), (7, "other words"), (5, None), (4, " ,. "), (None, "Nameless one here"), (3, "É é café naïve I II III IV V VI VII")]
DOCS = [(1, "Intro. THE quick-brown fox; jumps over the lazy dog, and runs away! Outro"), (2, "the quick brown fox jumps over the lazy cat and runs away"), (3, None), (4, ""), (5, "a short\nitem"),
        (6, "nameless ONE here, short item short item"), (6, "nameless ONE here, short item short item"), (6, "clean"), (None, PASSAGE), (7, "é É café naïve I II III IV V VI VII"), (8, "É é café naïve i ii iii iv v vi vii"),
        (9, "word " * 3_000 + PASSAGE)]


@pytest.mark.parametrize("most", [1_000_000, 0])
@pytest.mark.parametrize("bench", [BENCH, BENCH[:2]])
def test_equals_brute_force(spark, monkeypatch, most, bench):
    monkeypatch.setattr(d, "MOST_BROADCAST", most)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(2)
    got = d.contamination(docs, spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_words, list(r.hit), list(r.items)) for r in got) == brute(DOCS, bench)


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_letters_beyond_a_to_z_equal_brute_force(spark, monkeypatch, most):
    """A capital sigma before . ' or : and a letter, and other letters whose
    lower case hangs on their neighbours or on their number."""
    monkeypatch.setattr(d, "MOST_BROADCAST", most)
    greek = "ΟΔΟΣ.ΑΒ ΛΟΓΟΣ'Χ ΝΟΜΟΣ:Υ ένα δύο τρία τέσσερα πέντε έξι"
    bench = [(1, greek), (2, "ΟΔΟΣ.ΑΒ short"), (3, "İstanbul I IĞDIR Ǆ ẞ one two three four five six seven")]
    docs = [(1, greek), (2, "before " + greek + " after"), (3, greek.lower()), (4, "x ΟΔΟΣ ΑΒ, SHORT y"), (5, "οδος αβ short"), (6, "İSTANBUL " + bench[2][1].upper()), (7, "- " + bench[2][1].replace("one", "ONE"))]
    got = d.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()
    want = brute(docs, bench)
    assert sorted((r.doc_id, r.n_words, list(r.hit), list(r.items)) for r in got) == want and {i for i, _, hit, _ in want if hit} >= {1, 2, 4, 7}


def test_plan_has_no_python(spark):
    docs, bench = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(BENCH, "item_id long, text string")
    plan = d.contamination(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan


def test_removal(spark):
    rows = [(i, t, "h") for i, t in DOCS]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string, hit string"), spark.createDataFrame(BENCH, "item_id long, text string")
    kept = d.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    dirty = {(i, ()) for i, _, h, _ in brute(DOCS, BENCH) if h}
    assert sorted((r.doc_id or 0) for r in kept.collect()) == sorted(i for i, _, h, _ in brute(DOCS, BENCH) if not h)
    cut = {(r.doc_id, r.text if r.doc_id != 1 else " ".join(words(r.text))) for r in d.decontaminate(docs, bench, remove="spans").collect()}
    assert (1, "intro outro") in cut and (2, DOCS[1][1]) in cut and (3, None) in cut and dirty


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(BENCH, "item_id long, text string")
    assert d.contamination(docs.limit(0), bench).collect() == []
    assert {len(r.hit) for r in d.contamination(docs, bench.limit(0)).collect()} == {0}


def test_clashing_columns(spark):
    words = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"a {words} b", 7, "k", 1), (2, "clean", 8, None, 2), (3, None, 9, "h", 3)], "doc_id long, text string, __id int, __key string, row int")
    bench = spark.createDataFrame([(1, words)], "item_id long, text string")
    out = d.decontaminate(docs, bench)
    assert out.columns == docs.columns and sorted((r.doc_id, r["__id"], r["__key"], r.row) for r in out.collect()) == [(2, 8, None, 2), (3, 9, "h", 3)]
    cut = {r.doc_id: (r.text, r["__key"]) for r in d.decontaminate(docs, bench, remove="spans").collect()}
    assert cut[2] == ("clean", None) and cut[3] == (None, "h") and "w3" not in cut[1][0] and cut[1][1] == "k"
