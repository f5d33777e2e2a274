import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sitewise.llm import packing as P

SCHEMA = "doc_id long, text string"
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def hold(used, histogram):
    held = Counter()
    for key, k in used.items():
        assert sum(key) < len(histogram)
        for v in key:
            held[v] += k
    return held == Counter({n: int(c) for n, c in enumerate(histogram) if n and c})


@given(st.lists(st.integers(0, 400), min_size=1, max_size=64))
@settings(max_examples=60, deadline=None)
def test_plan_holds_the_histogram(counts):
    h = np.array([0, *counts])
    assert hold(P.plan(h), h)


def test_plan_is_near_the_least():
    r = random.Random(3)
    h = np.bincount([r.randrange(1, 1025) for _ in range(60_000)], minlength=1025)
    used = P.plan(h)
    least = -(-int((h * np.arange(1025)).sum()) // 1024)
    assert hold(used, h) and sum(used.values()) <= 1.005 * least
    assert sum(k for key, k in used.items() if len(key) in (2, 3) and sum(key) == 1024) > 0.5 * sum(used.values())


@given(st.text())
@settings(max_examples=300, deadline=None)
def test_ids_equal_the_other_librarys(text):
    ids = P.byte_bpe(*P.default_paths())
    assert ids(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_other_librarys_on_the_given_table(spark):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    ids = P.byte_bpe(*P.default_paths())
    assert all(ids(t) == e.ids for t, e in zip(texts, TOKENIZER.encode_batch(texts, add_special_tokens=False), strict=True))


def test_the_fit_by_itself_is_no_worse_than_best_fit(spark):
    """On the lengths of the given table, as they are and twenty times as many."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    h = np.bincount([r.length for r in P.pieces(docs).select("length").collect()], minlength=1025)
    for many in (h, 20 * h):
        used = P.fitted_plan(many)
        assert hold(used, many) and sum(used.values()) <= sum(P.best_fit(many).values())


def test_cut():
    assert P.cut(1, 4) == [(0, 1)] and P.cut(4, 4) == [(0, 4)] and P.cut(9, 4) == [(0, 1), (1, 4), (5, 4)] and P.cut(8, 4) == [(0, 4), (4, 4)]


def check(rows, texts, capacity):
    """Every piece once, sequences gapless and within the capacity, checksums as brute force gives them."""
    want = Counter()
    for i, text in texts:
        ids = np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        for k, (s, n) in enumerate(P.cut(len(ids), capacity)):
            want[(i, k, s, n, zlib.crc32(ids[s : s + n].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for at in by.values():
        at.sort()
        assert at[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(at, at[1:])) and sum(at[-1]) <= capacity
    return len(by)


def test_pack(spark):
    r = random.Random(5)
    texts = [(i, " ".join(r.choice(["the", "worthless", "été", "x1"]) for _ in range(r.choice([0, 1, 5, 40, 300])))) for i in range(150)]
    texts += [(7, texts[7][1]), (None, "no id"), (900, None), (901, ""), (902, "a <|endoftext|> b"), (903, "long " * 3000)]
    docs = spark.createDataFrame(texts, SCHEMA).selectExpr("*", "1 as length", "2 as salt", "'x' as piece")
    rows = P.pack(docs, capacity=64).collect()
    n = check(rows, texts, 64)
    assert n <= -(-sum(x.length for x in rows) // 64) * 1.03


def test_empty(spark):
    assert P.pack(spark.createDataFrame([], SCHEMA)).collect() == []
