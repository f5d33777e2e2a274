import random
import re
import zlib

import numpy as np
import pytest

from sitewise.llm import quality as Q
from sitewise.llm import toxicity as T

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"


def crc(i):
    return zlib.crc32(str(i).encode())


def corpus(n=900, seed=1):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 7))) for _ in range(200)]
    docs, labels = [], []
    for i in range(n):
        w = [r.choice(words) for _ in range(r.randrange(30, 120))]
        good, toxic = r.random() > 0.3, r.random() < 0.2
        if not good:
            w = [f"{x}!!".upper() for x in w] if r.random() < 0.5 else [x for x in w[:15] for _ in range(5)]
        if toxic:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(["idiotic", "idioten", "scumbag", "scumlike"]).upper() if r.random() < 0.2 else r.choice(["idiotic", "scumbag"]))
        docs.append((i, " ".join(w)))
        labels.append((i, int(good), int(toxic)))
    return docs, labels


@pytest.mark.parametrize("operator,modulus,out,column", [(Q.quality, 5, 0, 1), (T.toxicity, 3, 1, 2)])
def test_held_out_accuracy(spark, operator, modulus, out, column):
    docs, labels = corpus()
    extra = [(None, "null id"), (5000, None), (5001, ""), (5002, "word " * 20_000), docs[0]]
    odd = [(None, 1, 1), (5001, None, None), (5002, 7, 7), labels[0]]
    table = spark.createDataFrame(docs + extra, DOCS).selectExpr("*", "1 as y", "0 as score")
    got = operator(table, spark.createDataFrame(labels + odd, LABELS).selectExpr("*", "'x' as text")).collect()
    assert len(got) == len(docs) + len(extra)
    truth = {x[0]: x[column] for x in labels}
    for r in got:
        assert r.held_out == (r.doc_id is not None and crc(r.doc_id) % modulus == out) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.93
    twice = [r.score for r in got if r.doc_id == 0]
    assert len(twice) == 2 and twice[0] == twice[1]


@pytest.mark.parametrize("operator", [Q.quality, T.toxicity])
def test_other_tables(spark, operator):
    docs, none = spark.createDataFrame([(1, "a"), (2, None)], DOCS), spark.createDataFrame([], LABELS)
    assert len(operator(docs, none).collect()) == 2
    assert operator(spark.createDataFrame([], DOCS), none).collect() == []
    one = operator(docs, spark.createDataFrame([(1, 1, 1), (2, 1, 1)], LABELS)).collect()
    assert len(one) == 2 and all(r.score > 0.9 for r in one)


def test_labels_of_held_out_rows_are_not_learnt(spark):
    docs, labels = corpus(300)
    flipped = [(i, 1 - q if crc(i) % 5 == 0 else q, 1 - t if crc(i) % 3 == 1 else t) for i, q, t in labels]
    table = spark.createDataFrame(docs, DOCS)
    for operator in (Q.quality, T.toxicity):
        a, b = ({r.doc_id: r.score for r in operator(table, spark.createDataFrame(x, LABELS)).collect()} for x in (labels, flipped))
        assert a == b


def test_counterfactual_penalty_frees_group_names():
    r = random.Random(4)
    words = ["".join(r.choice("abcdefghij") for _ in range(4)) for _ in range(100)]
    texts, y = [], []
    for _ in range(600):
        toxic = r.random() < 0.4
        w = [r.choice(words) for _ in range(20)]
        if r.random() < (0.9 if toxic else 0.05):
            w.append("muslims")
        if toxic:
            w.append(r.choice(["idiotic", "scumbag"]))
        texts.append(" ".join(w))
        y.append(int(toxic))
    y = np.array(y)
    plain, fair = T.fit(texts, y, fairness=0), T.fit(texts, y)
    neutral = "the muslims of the town met " + " ".join(words[:10])
    gap = lambda m: abs(m.weights[m.places(neutral)].sum() - m.weights[m.places(T.swap_terms(neutral))].sum())
    assert gap(fair) < 0.1 * gap(plain)
    assert fair.score(neutral) < 0.5 and fair.score(neutral + " idiotic") > 0.7


def test_swap():
    assert T.swap_terms("Some Women and old men.") == "Some men and young people."
    assert T.swap_terms("womens") is None


def given(spark, name):
    return spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")


def plain_toxicity(model, text):
    """The score from each word by itself: which weights its words and their beginnings have, each once."""
    words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode())
    found = {int(f) for w in words for f in T.word_features(np.frombuffer(w, dtype=np.uint8))}
    place = {int(f): i for i, f in enumerate(model.features)}
    return 1 / (1 + np.exp(-(model.bias + sum(model.weights[place[f]] for f in found if f in place))))


def test_toxicity_equals_a_plain_version_and_the_penalty_acts(spark):
    docs, labels = given(spark, "documents"), given(spark, "labels")
    model, texts = T.fit_on(docs, labels), {r.doc_id: r.text for r in docs.collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = T.toxicity(docs, labels).collect()
    assert len(got) == len(texts)
    for r in got:
        assert abs(r.score - plain_toxicity(model, texts[r.doc_id])) < 1e-9 and r.predicted == int(r.score >= T.THRESHOLD)
    held = [r for r in got if r.held_out and truth.get(r.doc_id) in (0, 1)]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    # none of these texts names a group, so mentions are put in; with them the names get no weight of their own
    assert model.mentioned > 20
    free = T.fit_on(docs, labels, fairness=0.0)
    weight = lambda m: np.abs(m.weights[m.places(" ".join(t for kind in T.IDENTITY_TERMS for t in kind))]).max()
    assert weight(model) < 0.3 * weight(free)


def test_quality_on_the_given_table(spark):
    docs, labels = given(spark, "documents"), given(spark, "labels")
    model, texts = Q.fit_on(docs, labels), {r.doc_id: r.text for r in docs.collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = Q.quality(docs, labels).collect()
    for r in got:
        buckets = Q.subword_buckets(Q.text_bytes(texts[r.doc_id]), Q.BITS)
        mean = sum(float(model.table[b]) for b in buckets) / len(buckets) if len(buckets) else 0.0
        assert abs(r.score - 1 / (1 + np.exp(-(model.bias + mean)))) < 1e-5
    held = [r for r in got if r.held_out and truth.get(r.doc_id) in (0, 1)]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
