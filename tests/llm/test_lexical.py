import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sitewise.llm import lexical as X

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=50):
    """Every document against every item."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted, out = {}, []
    for i, t in items:
        if i is not None:
            wanted.setdefault(i, set()).update(terms(t))
    for item, ts in wanted.items():
        found = []
        for i, c in counts:
            m = 50 + (50 * sum(c.values()) * n_docs) // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def check(spark, docs, items, k=50):
    got = X.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, k)


def test_given_tables(spark, sf_dir):
    rows = lambda name, c: [(r[c], r.text) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()]
    check(spark, rows("documents", "doc_id"), rows("benchmark", "item_id"))


def test_nulls_ties_copies_and_long_texts(spark):
    r = random.Random(2)
    words = ["Alpha", "beta", "Gamma", "été", "x9", "Δ", "日本"] + [f"w{i}" for i in range(60)]
    text = lambda n: r.choice([" ", "-", "\n"]).join(r.choices(words, k=n))
    docs = [(i, text(r.randrange(1, 40))) for i in range(400)] + [(1000 + i, "Alpha beta w1 w2") for i in range(200)]
    docs += [(None, "alpha BETA w1 w2"), (None, None), (3, "alpha"), (3, "alpha"), (5000, ""), (5001, "-- ++"), (5002, "beta_" * 90_000), (5003, "ab" * 600_000 + " w1")]
    items = [(i, text(12)) for i in range(20)] + [(30, "alpha"), (30, "w2 unseen"), (31, None), (32, "???"), (None, "alpha"), (33, "nowhere at all")]
    check(spark, docs, items)
    check(spark, docs, items, 3)


def test_empty_tables_and_clashing_columns(spark):
    one = spark.createDataFrame([(1, "a b", 7, 7)], "doc_id long, text string, n int, item_id int")
    none = one.limit(0)
    items = spark.createDataFrame([(4, "b", 1)], "item_id int, text string, doc_id int")
    assert X.search(none, items).count() == 0 and X.search(one, items.limit(0)).count() == 0
    assert [(r.item_id, r.rank, r.doc_id) for r in X.search(one, items).collect()] == [(4, 1, 1)]


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(X, "BLOCK_ITEMS", 3)
    monkeypatch.setattr(X, "BLOCK_TERMS", 5)
    check(spark, [(i, f"a b{i % 5} c{i % 7}") for i in range(80)], [(i, f"b{i} c{i} a c{i + 1}") for i in range(8)])


@pytest.mark.parametrize("n", [1, 32, 33, 400])
def test_blocks_hold_each_posting_once(n):
    postings = np.random.default_rng(n).integers(0, 5, (9, n))
    order, starts = X.blocks(postings)
    assert sorted(order) == list(range(n)) and starts[0] == 0 and max(np.diff([*starts, n])) <= X.BLOCK


def test_similar_documents_share_blocks_so_that_blocks_are_skipped():
    r = np.random.default_rng(1)
    topics = [np.flatnonzero(r.random(40) < 0.2) + 1 for _ in range(8)]
    impacts = np.zeros((41, 800), dtype=np.int32)
    for d in range(800):
        impacts[np.append(0, topics[d // 100]), d] = r.integers(500, 900, len(topics[d // 100]) + 1)  # term 0 is everywhere
    items = X.Items(np.arange(41), [np.append(0, t) for t in topics], [np.full(len(t) + 1, 10) for t in topics], np.ones(8, dtype=np.int64))
    found, seen = X.Found(items, 5), {}
    for counted in (None, seen):  # the second time with the scores of the first
        found.rows = X.Found(items, 5).rows
        X.search_chunk(impacts, np.zeros(800, dtype=bool), np.arange(800), items, found, counted)
    want = [sorted(zip(-(10 * impacts[np.append(0, t)].sum(axis=0)), range(800), strict=True))[:5] for t in topics]
    assert [[(-s, i) for s, i in zip(score.tolist(), ids.tolist(), strict=True)] for score, _, ids in found.rows] == want
    assert seen["skipped"] > 0.4 * seen["blocks"]
