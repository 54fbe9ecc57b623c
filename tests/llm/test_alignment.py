import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from docindex.llm import alignment
from docindex.llm.queries import op12_token_alignment

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    t = tokenizers.Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=B)


def spans(libraries, text):
    """(id, start, end) of the tokens of A and of B, or none."""
    t, sp = libraries
    if not text:
        return [], []
    letter = alignment.byte_alphabet()
    a = [(i, bytes(letter[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()) for i in sp.encode(text)]
    if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
        return [], []
    out = []
    for tokens in (a, b):
        at, rows = 0, []
        for i, x in tokens:
            rows.append((i, at, at + len(x)))
            at += len(x)
        out.append(rows)
    return out


def brute(libraries, texts):
    each = []
    for text in texts:
        a, b = spans(libraries, text)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for c in cuts:
            groups.append(",".join(str(i) for i, s, e in a if low < e <= c) + "|" + ",".join(str(i) for i, s, e in b if low < e <= c))
            low = c
        links = [(i, j) for i, s, e in a for j, u, v in b if s < v and u < e]
        each.append((len(a), len(b), groups, links))
    count = Counter(p for *_, links in each for p in links)
    most = {}
    for (_, j), n in count.items():
        most[j] = max(most.get(j, 0), n)
    return [(na, nb, len(g), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), hashlib.sha256(";".join(g).encode()).hexdigest() if na else "")
            for na, nb, g, links in each]


def texts():
    rng = random.Random(4)
    words = ["the", "tokenizer", "unbelievable", "naïve", "Straße", "日本語", "中文字", "x1y2", "don't", "<|endoftext|>", "<s>", "<0x41>", "é", "𠀀", "ﬁ", "Ωmega", "==>", "3.14159", " ", "　"]
    out = [rng.choice(["", " ", "  ", "\n"]) + rng.choice([" ", " ", "  ", "\t", ""]).join(rng.choice(words) for _ in range(rng.randrange(1, 30))) for _ in range(150)]
    return out + [None, "", " ", "   ", "a▁b", "x\x00y", "﻿a", "\n", "日本語" * 50, "the " * 300, "aaaa" * 100, "the end", "the end"]


def test_query(spark, tmp_path, libraries):
    some = texts()
    rows = [(i if i % 40 else None, t, "en") for i, t in enumerate(some)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted(((i, *x) for (i, _, _), x in zip(rows, brute(libraries, some))), key=str)
    assert sum(w[1] == 0 for w in want) >= 3
    assert sorted((tuple(r) for r in op12_token_alignment(spark, str(tmp_path)).collect()), key=str) == want


def test_ids_are_the_librarys(libraries):
    t, sp = libraries
    some = [f" a{chr(c)}b1{chr(c)} {chr(c)}{chr(c)}" for c in [*range(1, 0x3100), *range(0x3100, 0x110000, 397)] if not 0xD800 <= c < 0xE000]
    enc, pieces = alignment.byte_level(A), alignment.byte_level_pieces(A)
    assert [enc.encode_ordinary(x) for x in some] == [e.ids for e in t.encode_batch(some, add_special_tokens=False)]
    assert all(pieces.joined(np.array(enc.encode_ordinary(x))).tobytes() == x.encode() for x in some)


def test_windows_are_aligned_once(libraries):
    x = alignment.Aligner(A, B)
    one = x.block(["the end of the end", "", "of the"])
    path, size, flat = (alignment._numbers(p) for p in one["packed"])
    assert path.tolist() == [0, 1, 2, 0, 1, 2, 0] and one["n_windows"].tolist() == [5, 0, 2] and len(size) == 3
    texts = x.unpacked(flat, size.astype(np.int64)).texts().to_pylist()
    assert all(t.count("|") == 1 and t.replace("|", "").isdigit() for t in texts) and len(set(texts)) == 3
    assert one["count"].sum() == one["n_links"].sum() == 7


def test_frames(spark, libraries):
    long = " ".join(f"word{i % 977} über" for i in range(60_000))
    df = spark.createDataFrame([(1, "the end", 5, "x"), (2, None, 6, None), (3, long, 7, "z"), (1, "the end", 5, "x")], "doc_id long, text string, pair int, block string")
    got = sorted((r.row.doc_id, r.row.pair, r.row.block, r.n_a, r.n_groups > 0, r.groups.count(";")) for r in alignment.align_tokens(df, A, B).collect())
    n = len(spans(libraries, long)[0])
    assert got[0] == got[1] == (1, 5, "x", 2, True, 1) and got[2] == (2, 6, None, 0, False, 0) and got[3][:5] == (3, 7, "z", n, True)
    assert alignment.align_tokens(df.limit(0), A, B).collect() == []
    assert [r.groups for r in alignment.align_tokens(df.where("doc_id = 2"), A, B).collect()] == [""]
