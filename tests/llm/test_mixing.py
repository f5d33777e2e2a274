import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitewise.llm import mixing as M

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"


def corpus(n=500, seed=2):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(120)]
    docs, labels = [], []
    for i in range(n):
        kind = r.choices(M.DOMAINS, (0.6, 0.25, 0.15))[0]
        w = [r.choice(words) for _ in range(r.randrange(20, 90))]
        if kind == "low":
            w = [x.upper() + "!!" for x in w]
        if kind == "toxic":
            w += [r.choice(["idiotic", "scumbag"]) for _ in range(3)]
        docs.append((i, " ".join(w)))
        labels.append((i, int(kind != "low"), int(kind == "toxic")))
    return docs, labels


def solve(p, n, share, floor, budget, rounds=20_000):
    """Projected gradient to the end, in plain numpy: the same weighed squares."""
    h = (p * n[:, None]).T @ p / n.sum()
    inverse = np.linalg.inv(h + 1e-6 * np.eye(3))
    r = np.full(len(n), max(1.0, floor))
    for _ in range(rounds):
        gap = ((r * n) @ p - budget * share) / n.sum()
        r = np.maximum(floor, r - p @ inverse @ gap - M.RIDGE * (r - 1))
    gap = ((r * n) @ p - budget * share) / n.sum()
    return float(gap @ inverse @ gap)


@pytest.mark.parametrize("floor", [0.0, 1.0])
def test_rates_match_targets(spark, floor):
    docs, labels = corpus()
    targets = {"clean": 0.7, "low": 0.2, "toxic": 0.1}
    df = spark.createDataFrame(docs + [(900, None), (901, ""), (None, "abc"), docs[0], (902, "abc " * 30_000)], DOCS)
    rows = M.rates(df, spark.createDataFrame(labels + [(None, 1, 1), (5, None, 7)], LABELS), targets, floor).collect()
    assert len(rows) == len(docs) + 5 and all(x.rate >= floor and x.rate - 1 < x.copies < x.rate + 1 for x in rows)
    truth = {i: "toxic" if t else "clean" if q else "low" for i, q, t in labels}
    right = [max(M.DOMAINS, key=lambda d: x[f"p_{d}"]) == truth[x.doc_id] for x in rows if x.doc_id in truth]
    assert np.mean(right) > 0.95
    n, p = np.array([float(x.n_tokens) for x in rows]), np.array([[x[f"p_{d}"] for d in M.DOMAINS] for x in rows])
    assert np.allclose(p.sum(1), 1)
    r, share = np.array([x.rate for x in rows]), np.array([targets[d] for d in M.DOMAINS])
    budget = max(n.sum(), *(floor * (n @ p) / share))
    gap = ((r * n) @ p - budget * share) / n.sum()
    h = (p * n[:, None]).T @ p / n.sum()
    assert float(gap @ np.linalg.inv(h + 1e-6 * np.eye(3)) @ gap) <= 1.01 * solve(p, n, share, floor, budget) + 1e-6
    assert {x.n_tokens for x in rows if x.doc_id in (900, 901)} == {0}


@pytest.mark.parametrize("floor", [0.0, 1.0])
def test_documents_reach_the_optimum_from_anywhere(spark, floor):
    """Rates of each document against projected gradient to the end in numpy, beginning at the cells' solution and at the usual rate."""
    docs, labels = corpus()
    targets = {"clean": 0.7, "low": 0.2, "toxic": 0.1}
    members = M._members(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), M.MAX_LABELLED)
    rows = members.collect()
    n, p = np.array([float(x.n_tokens) for x in rows]), np.array([x.posterior for x in rows])
    share = np.array([targets[d] for d in M.DOMAINS])
    budget = max(n.sum(), *(floor * (n @ p) / share))
    best = solve(p, n, share, floor, budget)
    passes = {}
    for warm in (True, False):
        fit = M.fit_rates(members, targets, floor, warm=warm)
        r = np.array([x.rate for x in members.select(fit.rate().alias("rate")).collect()])
        assert r.min() >= floor
        gap = ((r * n) @ p - budget * share) / n.sum()
        assert np.allclose(gap * n.sum() / budget, list(fit.gaps.values()), atol=1e-9)
        h = (p * n[:, None]).T @ p / n.sum()
        assert float(gap @ np.linalg.inv(h + 1e-6 * np.eye(3)) @ gap) <= 1.01 * best + 1e-6
        passes[warm] = len(fit.steps)
    assert passes[True] <= passes[False] and passes[False] > 0


def test_native_plan(spark):
    docs, labels = corpus(60)
    plan = M.rates(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_mixed_repeats_rows(spark):
    docs, labels = corpus(300)
    df = spark.createDataFrame(docs, DOCS).selectExpr("*", "'x' as rate", "1 as copies", "2 as mix_words")
    table = spark.createDataFrame(labels, LABELS)
    out = M.mixed(df, table, {"clean": 0.5, "low": 0.3, "toxic": 0.2}, floor=1.0)
    assert out.columns == df.columns
    n = {x.doc_id: x["count"] for x in out.groupBy("doc_id").count().collect()}
    assert set(n) == {i for i, _ in docs} and max(n.values()) > 1
    fewer = M.mixed(df, table, {"clean": 0.98, "low": 0.01, "toxic": 0.01}).select("doc_id").distinct().count()
    assert fewer < len(docs)


def test_other_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert M.rates(spark.createDataFrame([], DOCS), none).collect() == []
    one = M.rates(spark.createDataFrame([(1, "a b"), (2, None)], DOCS), none).collect()
    assert len(one) == 2 and all(x.p_clean > 0.99 and x.rate > 0 for x in one)
    assert M.mixed(spark.createDataFrame([(1, "a")], DOCS), none).agg(F.count("*")).first()[0] <= 3


@pytest.mark.parametrize("floor", [0.0, 1.0])
def test_targets_are_met_on_the_given_table(spark, floor):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = M.rates(docs, labels, floor=floor)
    shares = M.reached(out).first().asDict()
    assert all(abs(shares[d] - M.TARGETS[d]) < 0.002 for d in M.DOMAINS), shares
    kept = out.agg(F.count_if(F.col("rate") == 0), F.count("*"), F.min("rate")).first()
    assert kept[2] >= floor and kept[0] < 0.1 * kept[1]
