import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from sitewise.llm import jaccard as J
from sitewise.llm.jaccard import jaccard_components
from sitewise.llm.shingles import shingle_set, word_hashes
from tests.llm import brute

SCHEMA = "doc_id long, text string"


@given(st.lists(st.sampled_from(["a", "A", "b", " ", "\n", "\x0b", "é", "É", "\x1c", " ", "ab", "  "]), max_size=40))
def test_sets_have_the_size_of_brute_force(parts):
    text = "".join(parts)
    assert len(word_hashes(text)) == len(brute.words(text))
    assert len(shingle_set(text)) == len(brute.shingles(text))
    assert np.array_equal(shingle_set(text), shingle_set(" " + text.replace("A", "a") + "\t"))


def family(r, n, length, edits):
    base = [f"w{r.randrange(10**6)}" for _ in range(length)]
    for _ in range(n):
        w = list(base)
        for _ in range(edits):
            w[r.randrange(length)] = f"x{r.randrange(10**6)}"
        yield " ".join(w)


def test_components_equal_brute_force(spark):
    r = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = []
    for length, edits in ((60, 1), (150, 2), (150, 4), (200, 6), (40, 1), (9, 1)):
        texts += family(r, 25, length, edits)
    texts += [passage + " " + " ".join(f"u{r.randrange(10**6)}" for _ in range(r.choice([2, 10, 15, 16, 40, 300]))) for _ in range(120)]
    texts += ["one two", "one two", "One  TWO", "one two three", "a", "", " \n", None, texts[0], texts[0].upper(), "x " * 3000]
    r.shuffle(texts)
    rows = list(enumerate(texts, start=5))
    want = brute.jaccard(rows)
    assert len({c for _, c in want.values()}) < len(rows) - 60
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as n", "2 as key", "'x' as component")
    got = jaccard_components(docs).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == want and len(got) == len(rows)


def test_other_tables(spark):
    assert jaccard_components(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(3, "a b c d e f g"), (3, "a b c d e f g"), (None, "a b c d e f g"), (1, "a b c d e f g"), (9, "z"), (None, None)]
    got = jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((x.doc_id or -1, x.n_shingles, x.component_id or -1) for x in got) == [(-1, 0, -1), (-1, 3, -1), (1, 3, 1), (3, 3, 1), (3, 3, 1), (9, 1, 9)]


def test_long_lists_are_told_apart_by_the_root_of_the_mean():
    counts = np.random.default_rng(1).poisson(1000, 1 << 16).astype(np.uint32)
    counts[[7, 8]] += np.array([400, 4000], dtype=np.uint32)  # beside a thousand that share the counter
    level = J.levels_of(counts)
    assert level[7] >= 2 and level[8] > level[7]
    assert (level > 0).sum() < 20
    assert not J.levels_of(np.zeros(8, dtype=np.uint32)).any()


@pytest.mark.parametrize("few", [0, 10**9])
def test_rounds_and_pairs_give_the_same(spark, monkeypatch, few):
    """With leader rounds as long as they help, and with the last step alone."""
    monkeypatch.setattr(J, "FEW_PAIRS", few)
    words = [f"w{i}" for i in range(60)]
    docs = [(10 * g + k, " ".join([*words[: 58 - k], f"x{g}", f"y{k}"] if g else words[k : k + 50])) for g in range(3) for k in range(6)]
    got = J.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in docs}
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = min(label[a], label[b])
    assert {r.doc_id: r.component_id for r in got} == label


def test_copies_make_no_more_rows_than_postings(spark, monkeypatch):
    """Lists of 15 near copies each: neither rounds nor the last step make all pairs."""
    r = random.Random(4)
    rows = list(enumerate(t for _ in range(8) for t in family(r, 15, 150, 1)))
    made, usual = [], J._candidates

    def counted(left, right, *rest, **more):
        pairs = usual(left, right, *rest, **more)
        made.append((pairs.groupBy().sum("on").first()[0] or 0, right.count()))
        return pairs

    monkeypatch.setattr(J, "_candidates", counted)
    got = jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == brute.jaccard(rows)
    assert made and all(joined <= postings for joined, postings in made)


def test_only_early_lists_of_a_pair_meet(spark):
    """Sets of 100 need 89 in common, of which a pair's first is at one of the first 12 places; the last list of 21 can't be it."""
    side = [(7, 1, 100, [0] * 4, 20, 1), (8, 1, 100, [0] * 4, 3, 1), (7, 2, 100, [0] * 4, 20, 2), (8, 2, 100, [0] * 4, 3, 2)]
    left = spark.createDataFrame(side, "key long, doc_id long, n long, bits array<long>, place int, component long")
    right = left.selectExpr("*", "true as minor")
    assert [tuple(x) for x in J._candidates(left, right, 80, early=True).collect()] == [(1, 2, 100, 100, 1)]
    assert [x.on for x in J._candidates(left, right, 80).collect()] == [2]


@pytest.mark.parametrize("few", [0, 10**9])
def test_pairs_near_the_limit_equal_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(J, "FEW_PAIRS", few)
    r = random.Random(9)
    rows = list(enumerate(t for length in (7, 30, 90, 200, 400) for edits in (1, length // 60 + 1, length // 40 + 1) for t in family(r, 8, length, edits)))
    got = jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == brute.jaccard(rows)


def test_a_pair_meets_once_in_the_last_step(spark, monkeypatch):
    """Texts that share most of their lists without linking, and some that link: rows are as many as pairs, not as their common lists."""
    monkeypatch.setattr(J, "LEADER_ROUNDS", 0)
    r = random.Random(6)
    rows = list(enumerate(t for edits in (4, 16) for t in family(r, 10, 500, edits)))
    made, usual = [], J._candidates

    def counted(left, right, *rest, **more):
        pairs = usual(left, right, *rest, **more)
        made.append(tuple(pairs.selectExpr("sum(on)", "count(*)").first()))
        return pairs

    monkeypatch.setattr(J, "_candidates", counted)
    got = jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == brute.jaccard(rows)
    [(joined, pairs)] = made
    assert pairs >= 40 and joined <= 2 * pairs


def test_an_id_with_several_texts_links_where_any_does(spark):
    """Lists before one are told apart by the text that they are of."""
    r = random.Random(8)
    texts = [t for _ in range(4) for t in family(r, 6, 120, 2)]
    rows = [(i % 9, t) for i, t in enumerate(texts)]
    sets = [(i, brute.shingles(t)) for i, t in rows]
    label = {i: i for i, _ in rows}
    for _ in label:
        for i, x in sets:
            for j, y in sets:
                if 100 * len(x & y) >= 80 * len(x | y):
                    label[i] = min(label[i], label[j])
    got = jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {x.doc_id: x.component_id for x in got} == label
