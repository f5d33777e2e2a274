"""Mixing documents to target weights by soft membership, in DataFrame operations only.

Domains are what a table of labels says: toxic, low (quality 0) and clean. A naive Bayes classifier, counted from labelled documents
by Spark, gives every document a posterior for each domain from its telling words and from how its text is shaped
(capitals, symbols, repetition). Rates r >= 0, one for each document, are then fitted by projected gradient to least squares:
the expected tokens of each domain, the sum of rate x tokens x posterior, are to match the targets, while a small
weight keeps rates near 1.

A pass is one aggregation over the documents: from their rates, one for each, it sums the expected tokens of each domain; the gaps to the targets, three
numbers, are all that comes back. A document's rate then goes a step against its own gradient, which is its posterior times the weighed gaps and what keeps it near 1,
and is projected to rates of at least the floor. Several lengths of a step are summed in the same pass and the best is taken. Rates aren't written between passes: a
document's rate is worked out again from its posterior by the steps so far, a few numbers each, so passes only read the table of members. It ends where a further step
would move no rate to speak of, which is the optimum; where that leaves a gap, the targets can't be met with these posteriors, and Fit tells how much is left.

So that few passes are needed, rates begin near the optimum: the same squares are first solved by Newton steps over domains' multipliers on a grid of posteriors (GRID steps to a side,
at most 1,326 cells, whatever the input), and a document begins at what the multipliers say for its own posterior. Where it begins changes the number of passes, not where they end.

Texts are read once: what the posteriors come from goes no further than the table of members that is written.

Null texts are empty: no tokens, a rate like other documents of their posterior. Repeated rows have equal rates; a null id has its rate.
Labels other than 0 and 1, and rows without an id, are left out; of several labels of an id, the largest count. Without
labels every document is clean. An empty table gives an empty result. Extra columns of docs are ignored by rates() and
kept by mixed(), whatever their names.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from math import log

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.llm.common import clean_columns, least_hashes, saved

DOMAINS = ("clean", "low", "toxic")
TARGETS = {"clean": 0.90, "low": 0.08, "toxic": 0.02}
#: At most so many labelled documents are counted, and so many telling words kept.
MAX_LABELLED, MAX_WORDS = 12_000, 512
#: Steps of the grid of posteriors, how near to the targets is near enough, and the weight that keeps rates near 1.
GRID, NEAR, RIDGE = 50, 1e-3, 1e-4
#: Fractions of a Newton step, and lengths of a gradient step (1 is what the curvature of all documents asks for), that are tried at once.
_FRACTIONS = (1.0, 0.5, 0.2, 0.05, 0.01, 1e-3)
_LENGTHS = (1.0, 0.5, 2.0, 4.0, 16.0, 64.0)
#: Passes end where a step of length 1 would move rates by less than this, on average over tokens, or where the best step betters the squares by less than that share.
STILL, BETTER = 1e-6, 1e-4
#: (name, pattern that is counted, most, bins): shares of characters, in bins of equal width up to most.
_SHAPES = (("upper", "[A-Z]", 0.4, 8), ("symbol", r"[!#$%&*|]", 0.2, 8))
_REPEAT_BINS = 8
#: Bins of each shape: one below the first and one above the last.
_BINNED = {"upper": 10, "symbol": 10, "repeat": _REPEAT_BINS + 2}


def _shaped(docs: DataFrame) -> DataFrame:
    """Adds n_tokens and what the classifier sees of a text: mix_words, and its shape in bins.

    Each step's columns are read more than once by the next, which keeps the steps apart: higher-order functions aren't
    recognised as common parts of one expression and would be worked out for each use.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    shares = {f"mix_{name}": F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1)) for name, pattern, _, _ in _SHAPES}
    out = docs.withColumns({
        "mix_all": F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "n_tokens": (F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))).cast("long"), **shares,
    })
    out = out.withColumns({"mix_words": F.array_distinct("mix_all"), **{f"mix_{s}": F.width_bucket(f"mix_{s}", F.lit(0.0), F.lit(most), F.lit(bins)).cast("int") for s, _, most, bins in _SHAPES}})
    repeated = 1 - F.size("mix_words") / F.greatest(F.size("mix_all"), F.lit(1))
    return out.withColumn("mix_repeat", F.width_bucket(repeated, F.lit(0.0), F.lit(1.0), F.lit(_REPEAT_BINS)).cast("int")).drop("mix_all")


def _doubles(values) -> Column:
    """An array of numbers from one string, which the optimiser turns into one constant: plans stay small."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


@dataclass
class Membership:
    """Logarithms from the labelled sample's counts: of domains, of shape bins by domain, and of telling words by domain."""

    prior: list[float] = field(default_factory=lambda: [0.0, -20.0, -20.0])
    bins: dict[str, list[list[float]]] = field(default_factory=dict)
    words: list[str] = field(default_factory=list)
    logs: list[list[float]] = field(default_factory=list)

    def with_posterior(self, docs: DataFrame) -> DataFrame:
        """docs (with a column text) with n_tokens and posterior, an array in the order of DOMAINS, in the text's place."""
        out = _shaped(docs)
        if self.words:
            known = F.split(F.lit(" ".join(self.words)), " ")  # of letters and digits only
            out = out.withColumn("mix_hits", F.transform(F.array_intersect("mix_words", known), lambda w: F.array_position(known, w).cast("int")))
        logs = []
        for k in range(len(DOMAINS)):
            total = F.lit(self.prior[k])
            for s, by_domain in self.bins.items():
                total = total + F.element_at(_doubles(by_domain[k]), F.col(f"mix_{s}") + 1)
            if self.words:
                total = total + F.aggregate("mix_hits", F.lit(0.0), _adding(_doubles(self.logs[k])))
            logs.append(total)
        out = out.withColumn("mix_logs", F.array(*logs))
        out = out.withColumn("mix_most", F.array_max("mix_logs"))
        out = out.withColumn("mix_odds", F.transform("mix_logs", lambda x: F.exp(F.greatest(x - F.col("mix_most"), F.lit(-60.0)))))
        total = sum((F.get("mix_odds", F.lit(k)) for k in range(1, len(DOMAINS))), F.get("mix_odds", F.lit(0)))
        out = out.withColumn("mix_total", total)
        out = out.withColumn("posterior", F.array(*(F.get("mix_odds", F.lit(k)) / F.col("mix_total") for k in range(len(DOMAINS)))))
        return out.drop("text", *(c for c in out.columns if c.startswith("mix_")))


def _adding(values: Column):
    return lambda total, place: total + F.element_at(values, place)


def fit_membership(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, most_words: int = MAX_WORDS) -> Membership:
    """Counts the labelled documents: those with the least hashes of their ids, at most limit. docs has doc_id and text."""
    marked = clean_columns(labels, doc_id="doc_id", quality="quality", toxic="toxic").where("doc_id is not null and (quality in (0, 1) or toxic in (0, 1))")
    marked = marked.groupBy("doc_id").agg(F.max(F.when(F.col("quality").isin(0, 1), F.col("quality"))).alias("quality"), F.max(F.when(F.col("toxic").isin(0, 1), F.col("toxic"))).alias("toxic"))
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").otherwise("clean")
    marked = saved(marked.select("doc_id", domain.alias("domain"), F.xxhash64("doc_id").alias("h")), "mix-marks")
    marked = marked.where(least_hashes(marked, "h", limit)).drop("h")
    texts = clean_columns(docs, doc_id="doc_id", text="text").join(F.broadcast(marked), "doc_id")  # at most limit rows
    sample = saved(_shaped(texts).drop("doc_id", "text"), "mix-sample")

    model = Membership()
    sizes = {r.domain: r["count"] for r in sample.groupBy("domain").count().collect()}
    if not sizes:
        return model
    n = sum(sizes.values())
    model.prior = [log((sizes.get(d, 0) + 0.5) / (n + 1.5)) for d in DOMAINS]
    model.bins = {s: [[log(1 / (sizes.get(d, 0) + 10))] * bins for d in DOMAINS] for s, bins in _BINNED.items()}
    shapes = F.explode(F.array(*(F.struct(F.lit(s).alias("shape"), F.col(f"mix_{s}").alias("bin")) for s in _BINNED)))
    for r in sample.select("domain", shapes.alias("x")).groupBy("x.shape", "x.bin").pivot("domain", list(DOMAINS)).count().collect():
        for k, d in enumerate(DOMAINS):
            model.bins[r["shape"]][k][r["bin"]] = log(((r[d] or 0) + 1) / (sizes.get(d, 0) + 10))

    each = sample.select("domain", F.explode("mix_words").alias("word")).where("word <> ''").groupBy("word").pivot("domain", list(DOMAINS)).count().na.fill(0)
    both = sum((F.col(d) for d in DOMAINS), F.lit(0))
    # words that are commoner than chance in a domain other than clean; that a word of clean texts is missing tells only that a text is short
    z = [(F.col(d) - sizes.get(d, 0) / n * both) / F.sqrt(F.greatest(both * (sizes.get(d, 0) / n) * (1 - sizes.get(d, 0) / n), F.lit(1e-9))) for d in DOMAINS[1:] if 0 < sizes.get(d, 0) < n]
    if z:
        telling = each.where(both >= 4).withColumn("z", F.greatest(*z, F.lit(0.0))).where("z > 5").orderBy(F.desc("z"), "word").limit(most_words)
        found = sorted(telling.collect(), key=lambda r: r.word)
        model.words = [r.word for r in found]
        # a word that is missing tells something too: the prior takes all as missing, and a word that occurs makes up for it
        for k, d in enumerate(DOMAINS):
            p = [(r[d] + 0.5) / (sizes.get(d, 0) + 1) for r in found]
            model.prior[k] += sum(log(1 - x) for x in p)
            model.logs.append([log(x / (1 - x)) for x in p])
    return model


def cell_of(posterior: Column) -> Column:
    """The cell of the grid that holds a posterior."""
    first, second = (F.round(F.get(posterior, F.lit(k)) * GRID).cast("int") for k in (0, 1))
    return first * (GRID + 1) + second


def cells(members: DataFrame) -> DataFrame:
    """For each cell of members (n_tokens, posterior, cell): its tokens t, and s, tokens x posterior, summed as they are."""
    sums = (F.sum(F.col("n_tokens") * F.get("posterior", F.lit(k))) for k in range(len(DOMAINS)))
    return members.groupBy("cell").agg(F.sum("n_tokens").alias("t"), F.array(*sums).alias("s"))


@dataclass
class Fit:
    """Where rates begin (the multipliers of the domains), the steps since, the least rate, and what is left of each domain's gap as a share of the budget."""

    multipliers: list[float]
    floor: float
    gaps: dict[str, float]
    #: Each step as (length, weighed gaps): what rates went by.
    steps: list[tuple[float, list[float]]] = field(default_factory=list)

    @property
    def met(self) -> bool:
        return max(map(abs, self.gaps.values()), default=0.0) <= NEAR

    def rate(self) -> Column:
        """A document's rate from its column posterior: where it begins, then each step and its projection."""
        first = _projected(F.lit(_usual(self.floor)) - _along(self.multipliers), self.floor)
        if not self.steps:
            return first
        steps = F.array(*(F.array(*(F.lit(float(x)) for x in (length, *way))) for length, way in self.steps))
        return F.aggregate(steps, first, lambda r, x: _projected(r - x[0] * (_along([x[k + 1] for k in range(len(DOMAINS))]) + RIDGE * (r - _usual(self.floor))), self.floor))


def _usual(floor: float) -> float:
    """The rate that documents have where nothing draws them from it."""
    return float(max(1.0, floor))


def _projected(rate: Column, floor: float) -> Column:
    return F.greatest(F.lit(float(floor)), rate)


def _along(way) -> Column:
    """The posterior times three numbers."""
    return sum((F.get("posterior", F.lit(k)) * x for k, x in enumerate(way)), F.lit(0.0))


def _mean(k: int) -> Column:
    """A cell's mean posterior of domain k."""
    return F.when(F.col("t") > 0, F.get("s", F.lit(k)) / F.col("t")).otherwise(0.0)


def begin(table: DataFrame, share: np.ndarray, budget: float, floor: float, most: int = 100) -> list[float]:
    """Multipliers of the domains from cells (cell, t, s), by Newton steps in the dual of the squares: a rate is the usual one less the posterior times them.

    Each step is one aggregation of the cells. The number of steps has a limit only as a guard.
    """
    k, usual = range(len(DOMAINS)), _usual(floor)
    s = [F.get("s", F.lit(i)) for i in k]
    outer = [s[i] * _mean(j) for i in k for j in k]
    first = np.array(table.agg(*(F.sum(x).alias(f"x{i}") for i, x in enumerate([*s, *outer]))).first(), dtype=float)
    n, h = first[: len(DOMAINS)].sum(), first[len(DOMAINS) :].reshape(len(DOMAINS), -1)
    # in units of RIDGE, so that a multiplier is what it takes off a rate
    soft = RIDGE * (h / n + 1e-6 * np.eye(len(DOMAINS)))

    def at(ways: list[np.ndarray]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """For each choice of multipliers: the dual of the squares, its gradient and its curvature."""
        each = F.explode(F.array(*(F.struct(F.lit(i).alias("way"), *(F.lit(float(x)).alias(f"m{j}") for j, x in enumerate(w))) for i, w in enumerate(ways)))).alias("x")
        rated = table.select("t", "s", each).select("t", "s", "x.*")
        raw = F.lit(usual) - sum((_mean(j) * F.col(f"m{j}") for j in k), F.lit(0.0))
        rated = rated.withColumn("raw", raw).withColumn("rate", _projected(F.col("raw"), floor))
        off = sum((F.col(f"m{j}") * s[j] for j in k), F.lit(0.0))
        free = F.when(F.col("raw") >= floor, 1.0).otherwise(0.0)
        sums = [F.sum(F.col("t") * (F.col("rate") - usual) ** 2 / 2 + off * F.col("rate")), *(F.sum(F.col("rate") * x) for x in s), *(F.sum(free * x) for x in outer)]
        rows = {r.way: np.array(r[1:]) / n for r in rated.groupBy("way").agg(*(c.alias(f"x{i}") for i, c in enumerate(sums))).collect()}
        out = []
        for i, w in enumerate(ways):
            value, total, curve = rows[i][0], rows[i][1 : 1 + len(DOMAINS)], rows[i][1 + len(DOMAINS) :].reshape(len(DOMAINS), -1)
            out.append((float(value - w @ soft @ w / 2 - w @ (budget * share / n)), total - budget * share / n - soft @ w, curve + soft))
        return out

    m, tried = np.zeros(len(DOMAINS)), 0
    value, gradient, curve = at([m])[0]
    while np.abs(gradient).max() > 1e-9 and tried < most:
        way = np.linalg.solve(curve, gradient)
        ways = [m + f * way for f in _FRACTIONS]
        found = at(ways)
        i = int(np.argmax([x[0] for x in found]))
        tried += 1
        if found[i][0] <= value + 1e-15 * abs(value):
            break
        m, (value, gradient, curve) = ways[i], found[i]
    return m.tolist()


def fit_rates(members: DataFrame, targets: dict[str, float] | None = None, floor: float = 0.0, warm: bool = True, most: int = 100) -> Fit:
    """Fits the rates of members (n_tokens, posterior, cell) to shares of the budget by projected gradient; without warm they begin at the usual rate.

    The budget is the tokens there are; with a floor, the least at which no rate has to be below it. Gaps are weighed by the inverse
    of H, the tokens' mean outer product of posteriors: domains that overlap or are small then count like others. The number of passes has a limit only
    as a guard; a fit that reaches it says so in its log.
    """
    targets = targets or TARGETS
    share = np.array([targets[d] for d in DOMAINS]) / sum(targets.values())
    k, usual, tokens = range(len(DOMAINS)), _usual(floor), F.col("n_tokens")
    p = [F.get("posterior", F.lit(i)) for i in k]
    table = members.select("n_tokens", "posterior")
    sums = [*(tokens * x for x in p), *(tokens * p[i] * p[j] for i in k for j in k)]
    first = np.array([x or 0.0 for x in table.agg(*(F.sum(x).alias(f"x{i}") for i, x in enumerate(sums))).first()])
    have, h = first[: len(DOMAINS)], first[len(DOMAINS) :].reshape(len(DOMAINS), -1)
    n = have.sum()
    fit = Fit([0.0] * len(DOMAINS), floor, dict.fromkeys(DOMAINS, 0.0))
    if not n:
        return fit
    budget = max([n] + ([floor * x / y for x, y in zip(have, share, strict=True) if y > 0] if floor else []))
    weigh = np.linalg.inv(h / n + 1e-6 * np.eye(len(DOMAINS)))
    if warm:
        fit.multipliers = begin(saved(cells(members), "mix-cells"), share, budget, floor)

    def at(lengths: tuple[float, ...], way: list[float]) -> list[tuple[float, float, np.ndarray]]:
        """For each length of a step along way: the squares, how far it moves rates, and the gaps; one pass over the documents."""
        rated = table.withColumn("rate", fit.rate()).withColumn("slope", _along(way) + RIDGE * (F.col("rate") - usual))
        rated = rated.select("n_tokens", "posterior", "rate", *(_projected(F.col("rate") - x * F.col("slope"), floor).alias(f"r{i}") for i, x in enumerate(lengths)))
        each = [(tokens * (r - usual) ** 2, tokens * F.abs(r - F.col("rate")), *(tokens * r * x for x in p)) for r in (F.col(f"r{i}") for i in range(len(lengths)))]
        row = rated.agg(*(F.sum(x).alias(f"x{i}") for i, x in enumerate(x for one in each for x in one))).first()
        out = []
        for spread, moved, *total in np.array(row, dtype=float).reshape(len(lengths), -1) / n:
            gap = np.array(total) - budget * share / n
            out.append((float(gap @ weigh @ gap + RIDGE * spread), float(moved), gap))
        return out

    value, _, gap = at((0.0,), [0.0] * len(DOMAINS))[0]
    passes = 1
    while passes < most:
        way = (weigh @ gap).tolist()
        found = at(_LENGTHS, way)
        passes += 1
        i = int(np.argmin([x[0] for x in found]))
        if found[0][1] <= STILL or found[i][0] >= value * (1 - BETTER):
            break
        fit.steps.append((_LENGTHS[i], way))
        value, _, gap = found[i]
    fit.gaps = dict(zip(DOMAINS, (gap * n / budget).tolist(), strict=True))
    if not fit.met:
        logging.getLogger(__name__).warning("targets are missed by %s of the budget after %d passes", fit.gaps, passes)
    return fit


def _rated(members: DataFrame, targets: dict[str, float] | None, floor: float) -> DataFrame:
    """members (cell, posterior, n_tokens, chance and others) with rate and copies: the rate rounded up or down by the row's chance."""
    out = members.withColumn("rate", fit_rates(members, targets, floor).rate())
    return out.withColumn("copies", (F.floor("rate") + (F.col("chance") < F.col("rate") - F.floor("rate")).cast("int")).cast("int"))


def _members(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """docs (doc_id, text and others) with n_tokens, posterior, cell and chance in the text's place, written."""
    # a number from 0 to below 1 from a row's id and text
    chance = F.pmod(F.xxhash64("doc_id", "text", F.lit("mix")), F.lit(1 << 20)) / float(1 << 20)
    out = fit_membership(docs, labels, limit).with_posterior(docs.withColumn("chance", chance))
    return saved(out.withColumn("cell", cell_of(F.col("posterior"))), "mix-members")


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, floor: float = 0.0, limit: int = MAX_LABELLED) -> DataFrame:
    """doc_id, n_tokens, a posterior for each domain, rate and copies for each row."""
    rated = _rated(_members(clean_columns(docs, doc_id="doc_id", text="text"), labels, limit), targets, floor)
    return rated.select("doc_id", "n_tokens", *(F.get("posterior", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(DOMAINS)), "rate", "copies")


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, floor: float = 0.0, limit: int = MAX_LABELLED) -> DataFrame:
    """The rows of docs, each as often as its copies say, with their columns as they were."""
    packed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    rated = _rated(_members(packed, labels, limit), targets, floor).where("copies > 0")
    return rated.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def reached(rated: DataFrame) -> DataFrame:
    """Of rates(): each domain's share of the expected tokens after mixing."""
    totals = [F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")).alias(d) for d in DOMAINS]
    all_ = sum((F.col(d) for d in DOMAINS[1:]), F.col(DOMAINS[0]))
    return rated.agg(*totals).select(*(F.try_divide(d, all_).alias(d) for d in DOMAINS))
