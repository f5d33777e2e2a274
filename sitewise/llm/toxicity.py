"""Toxicity: a logistic classifier of words and word beginnings with a counterfactual penalty.

A text's features are which words and prefixes of words occur in it. Those whose counts in the labelled sample differ between
both labels beyond chance are kept, with those of the identity terms, and their weights are learnt by stochastic gradient descent. For each
labelled text that names a group of people, the same text is made with another group of its kind, and the difference of both scores is
penalised. Few labelled texts may name a group; so some of the others get a mention put in, are learnt with it under their own label, and are
held to the score of the same text with another group and of the text without. So a group's name gets no weight of its own, however often
abuse in the sample goes with it, and neutral mentions stay low.

Spark counts the features and finds each labelled text's places among those that are kept; the driver gets numbers, no texts.

Scores depend on the text alone. An empty or null text gets the score of no features. Repeated rows get equal
scores; a null id keeps its score and is never held out. With labels of one kind only, the score is their share.
An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.llm.common import saved, slices
from sitewise.llm.features import text_bytes, word_features
from sitewise.llm.labelled import MAX_LABELLED, labelled_rows, scored, sigmoid

#: Names of groups, by kind and language (en, de, fr, es); a parameter. A term is swapped for the next of its kind.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "people"), ("woman", "man", "person"), ("girls", "boys", "children"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "bisexual", "transgender", "straight"), ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "foreigners", "citizens"), ("old", "young", "disabled", "blind", "deaf"),
    ("frauen", "männer", "menschen"), ("muslime", "christen", "juden", "atheisten"), ("schwule", "lesben", "heterosexuelle"), ("ausländer", "flüchtlinge", "einwanderer", "bürger"),
    ("femmes", "hommes", "personnes"), ("musulmans", "chrétiens", "juifs", "athées"), ("homosexuels", "lesbiennes", "hétérosexuels"), ("étrangers", "réfugiés", "immigrés", "citoyens"),
    ("mujeres", "hombres", "personas"), ("musulmanes", "cristianos", "judíos", "ateos"), ("homosexuales", "lesbianas", "heterosexuales"), ("extranjeros", "refugiados", "inmigrantes", "ciudadanos"),
)
#: One labelled text in so many that names no group gets a mention put in.
MENTIONS = 4
MODULUS, HELD_OUT, THRESHOLD = 3, 1, 0.7


def swap_terms(text: str, terms=IDENTITY_TERMS) -> str | None:
    """The text with each group's name swapped for the next of its kind; null if there is none."""
    following = {t: kind[(i + 1) % len(kind)] for kind in terms for i, t in enumerate(kind)}
    if not following:
        return None
    swapped, n = re.subn(r"\b(" + "|".join(map(re.escape, following)) + r")\b", lambda m: following[m[0].lower()], text, flags=re.I)
    return swapped if n else None


def with_mention(text: str, terms=IDENTITY_TERMS) -> str | None:
    """The text with a group's name after it, for one text in MENTIONS, chosen and named by its checksum; null for others."""
    pick = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    if not terms or pick % MENTIONS:
        return None
    kind = terms[pick // MENTIONS % len(terms)]
    return f"{text} {kind[pick // MENTIONS // len(terms) % len(kind)]}"


@dataclass
class Toxicity:
    """Sorted features, their weights, the bias, and how many labelled texts the penalty was worked out for, as found and with a mention put in."""

    features: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))
    bias: float = 0.0
    swapped: int = 0
    mentioned: int = 0

    def places(self, text: str) -> np.ndarray:
        found = word_features(text_bytes(text))
        if not len(self.features) or not len(found):
            return np.empty(0, dtype=np.int64)
        at = np.searchsorted(self.features, found)
        at[at == len(self.features)] = 0
        return at[self.features[at] == found]

    def score(self, text: str) -> float:
        return sigmoid(self.bias + self.weights[self.places(text)].sum())


class Example(NamedTuple):
    """A labelled text's places; those of its counterpart with another group; and whether the group was put in, with the places without it."""

    y: int
    at: np.ndarray
    other: np.ndarray | None
    without: np.ndarray | None


def _example(model: Toxicity, text: str, y: int, terms) -> Example:
    other, without = swap_terms(text, terms), None
    if other is None and (named := with_mention(text, terms)) is not None:
        text, other, without = named, swap_terms(named, terms), model.places(text)
    return Example(y, model.places(text), None if other is None else model.places(other), without)


def _told(both: np.ndarray, ones: np.ndarray, n: int, n_ones: int, least: int, beyond: float) -> np.ndarray:
    """Whether a feature of so many texts, so many of them with label 1, differs between the labels by more than so many standard deviations."""
    p = both / n
    z = (ones - n_ones * p) / np.sqrt(np.maximum(n_ones * p * (1 - p) * (1 - n_ones / n), 1e-12))
    return (both >= least) & (np.abs(z) > beyond)


def _with_terms(features: np.ndarray, terms) -> np.ndarray:
    return np.unique(np.concatenate([features, word_features(text_bytes(" ".join(t for kind in terms for t in kind)), ())]))


def _constant(ones: int, n: int) -> Toxicity | None:
    """The score where labels are of one kind only: their share."""
    if 0 < ones < n:
        return None
    share = float(np.clip(ones / n if n else 0.0, 1e-6, 1 - 1e-6))
    return Toxicity(bias=float(np.log(share / (1 - share))))


def learn(features: np.ndarray, examples: list[Example], fairness: float = 1.0, epochs: int = 30, rate: float = 0.3, shrink: float = 1e-4, ones: float = 8.0, seed: int = 1) -> Toxicity:
    """Gradient descent over the examples; fairness is the penalty's weight, ones that of a text with label 1."""
    model = Toxicity(features, np.zeros(len(features)))
    model.swapped = sum(e.other is not None and e.without is None for e in examples)
    model.mentioned = sum(e.without is not None for e in examples)
    seen, seen_bias, w = np.full(len(features), 1e-8), 1e-8, model.weights
    order = np.random.default_rng(seed)

    def penalise(x: np.ndarray, other: np.ndarray) -> None:
        gap = w[x].sum() - w[other].sum()
        for only, sign in ((np.setdiff1d(x, other), 1), (np.setdiff1d(other, x), -1)):
            # a share of the gap for each of the features that make it, so that a step never overshoots
            w[only] -= sign * min(0.5, fairness / 2) * gap / max(1, len(only))

    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            y, x, other, without = examples[i]
            g = (sigmoid(model.bias + w[x].sum()) - y) * (ones if y else 1.0)
            step = g + shrink * w[x]
            seen[x] += step * step
            w[x] -= rate * step / np.sqrt(seen[x])
            seen_bias += g * g
            model.bias -= rate * g / np.sqrt(seen_bias)
            if fairness and other is not None:
                penalise(x, other)
                if without is not None:
                    penalise(x, without)
    return model


def fit(texts: list[str], y: np.ndarray, terms=IDENTITY_TERMS, least: int = 4, beyond: float = 4.0, **options) -> Toxicity:
    """Learns from texts and labels in memory."""
    if known := _constant(int(np.sum(y)), len(y)):
        return known
    found = [word_features(text_bytes(t)) for t in texts]
    names, which = np.unique(np.concatenate(found), return_inverse=True)
    both = np.bincount(which, minlength=len(names))
    ones = np.bincount(which, np.repeat(y, [len(f) for f in found]), len(names))
    features = _with_terms(names[_told(both, ones, len(y), int(np.sum(y)), least, beyond)], terms)
    return learn(features, [_example(Toxicity(features), t, int(v), terms) for t, v in zip(texts, y, strict=True)], **options)


def fit_on(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, terms=IDENTITY_TERMS, least: int = 4, beyond: float = 4.0, **options) -> Toxicity:
    """Learns from at most limit labelled rows of docs."""
    rows = saved(labelled_rows(docs, labels, "toxic", MODULUS, HELD_OUT, limit).limit(limit), "toxic-sample")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("ones")).first()
    if known := _constant(size.ones or 0, size.n):
        return known

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, y = batch.column("text").to_pylist(), batch.column("y").to_numpy()
            if not texts:
                continue
            found = [word_features(text_bytes(t)) for t in texts]
            names, which = np.unique(np.concatenate(found), return_inverse=True)
            ones = np.bincount(which, np.repeat(y, [len(f) for f in found]), len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(np.bincount(which, minlength=len(names))), pa.array(ones)], ["feature", "n", "ones"])

    p = F.col("n") / size.n
    z = (F.col("ones") - size.ones * p) / F.sqrt(F.greatest(size.ones * p * (1 - p) * (1 - size.ones / size.n), F.lit(1e-12)))
    counts = rows.select("y", "text").mapInArrow(count, "feature long, n long, ones long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"))
    told = counts.where((F.col("n") >= least) & (F.abs(z) > beyond)).select("feature")
    features = _with_terms(told.toArrow()["feature"].to_numpy().view(np.uint64), terms)  # of limit texts at most
    empty = Toxicity(features)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = pa.list_(pa.int32())
        for batch in slices(batches):
            made = [_example(empty, t, 0, terms) for t in batch.column("text").to_pylist()]
            columns = [pa.array([None if x is None else x.astype(np.int32) for x in c], lists) for c in ([e.at for e in made], [e.other for e in made], [e.without for e in made])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), *columns], ["doc_id", "y", "at", "other", "without"])

    kinds = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, y int, at array<int>, other array<int>, without array<int>"
    table = rows.mapInArrow(places, kinds).toArrow().sort_by([("doc_id", "ascending")])  # numbers of at most limit texts
    array = lambda x: None if x is None else np.array(x, dtype=np.int64)
    examples = [Example(y, array(a), array(b), array(c)) for y, a, b, c in zip(*(table[n].to_pylist() for n in ("y", "at", "other", "without")), strict=True)]
    return learn(features, examples, **options)


def toxicity(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs."""
    model: Toxicity = fit_on(docs, labels, limit)
    score: Callable[[str], float] = model.score
    return scored(docs, score, MODULUS, HELD_OUT, threshold)


def keep_below(docs: DataFrame, model: Toxicity, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text scores below the threshold, as they are."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([model.score(t.as_py() or "") < threshold for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
