import base64
import random

import numpy as np
import pytest

from docindex.llm import bpe

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(texts):
    bs = [t.encode() for t in texts]
    offs = np.cumsum([0] + [len(b) for b in bs])
    ids, upto = bpe.encode_run(np.frombuffer(b"".join(bs), np.uint8), offs, bpe.vocabulary(PATH))
    return [ids[a:b].tolist() for a, b in zip(upto, upto[1:])]


def test_random_texts(reference):
    rng = random.Random(3)
    letters = "ab''  \n\t\r's'trevemlld9é中　 .,!-ʰ½\u0085"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(4000)]
    texts += ["", "don't we're they'll I'd 's s", "'", "''s", "x" * 1500, "'re" * 300, " " * 700, "<|endoftext|>", "a\n\n  b", "  "]
    assert encode(texts) == [reference.encode_ordinary(t) for t in texts]


def test_code_points(reference):
    texts = [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}" for c in range(1, 0x3100)] + [f" {chr(c)}1" for c in range(0x3100, 0x110000, 311) if not 0xD800 <= c < 0xE000]
    assert encode(texts) == [reference.encode_ordinary(t) for t in texts]


def thue_morse(n):
    """A word of n letters and its complement: polynomials modulo 2**64 can't
    tell them apart from about 1024 letters on."""
    bits = [i.bit_count() & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_of_one_polynomial(reference):
    texts = [x for n in (1024, 2048, 4096) for x in thue_morse(n)]
    assert encode(texts) == [reference.encode_ordinary(t) for t in texts]


def test_scan_equals_steps():
    rng = np.random.default_rng(1)
    single, _, _ = bpe.monoid()
    for n in (0, 1, 63, 64, 65, 5000):
        cls = rng.integers(0, 8, n)
        s, want = bpe.START, []
        for c in cls.tolist():
            want.append(s)
            s = bpe.step(s, c)
        assert bpe.scan_states(single[cls]).tolist() == want


def test_frames(spark, reference):
    rows = [(1, "Hello world's  end", "x"), (2, None, "y"), (3, "", None), (None, "é" * 3, "z"), (1, "Hello world's  end", "x"), (4, "long " * 20_000, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert sorted((r.row.doc_id or 0, r.row.ids or "", r.ids, bytes(r.decoded)) for r in out) == sorted(
        (i or 0, x or "", reference.encode_ordinary(t or ""), (t or "").encode()) for i, t, x in rows)
    assert all(list(r.offsets)[-1:] == ([len(bytes(r.decoded))] if r.ids else []) for r in out)
    assert bpe.decode(bpe.encode(df.limit(0), PATH), PATH).collect() == []
