"""Quality: supervised subword embeddings.

Words, pairs of words and character n-grams are hashed into buckets with a learnt vector each; a document is the mean of its
features' vectors, and a softmax over that mean gives the label. Vectors and output are learnt by stochastic gradient
descent in numpy. To score, each bucket's vector is multiplied with the output once, which leaves one number for
a bucket and a mean of numbers for a document.

Scores depend on the text alone. An empty or null text gets the score of no features. Repeated rows get equal
scores; a null id keeps its score and is never held out. With labels of one kind only, the score is their share.
An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from sitewise.llm.features import subword_buckets, text_bytes
from sitewise.llm.labelled import labelled_sample, scored, sigmoid

BITS, DIM, MAX_LABELLED = 18, 8, 6_000
MODULUS, HELD_OUT, THRESHOLD = 5, 0, 0.3


@dataclass
class Quality:
    """What a bucket adds to the difference of both logits, and what they differ by without features."""

    table: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        found = subword_buckets(text_bytes(text), BITS)
        return sigmoid(self.bias + (float(self.table[found].mean()) if len(found) else 0.0))


def fit(texts: list[str], y: np.ndarray, epochs: int = 5, rate: float = 0.1, least: int = 5, seed: int = 1) -> Quality:
    """Learns vectors of the buckets that occur in at least so many texts."""
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
        return Quality(np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))))
    bags, texts_with = [], np.zeros(1 << BITS, dtype=np.int32)
    for t in texts:
        found = subword_buckets(text_bytes(t), BITS)
        at, n = np.unique(found, return_counts=True)
        texts_with[at] += 1
        bags.append((at.astype(np.int32), (n / max(1, len(found))).astype(np.float32)))
    order = np.random.default_rng(seed)
    vectors = (order.standard_normal((1 << BITS, DIM)) * 0.1).astype(np.float32)
    vectors[texts_with < least] = 0
    out, bias = np.zeros((DIM, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    seen = np.full(1 << BITS, 1e-8, dtype=np.float32)
    seen_out, seen_bias = np.full((DIM, 2), 1e-8, dtype=np.float32), np.full(2, 1e-8, dtype=np.float32)
    weight = len(y) / (2 * np.bincount(y, minlength=2))
    for _ in range(epochs):
        for i in order.permutation(len(texts)):
            at, share = bags[i]
            known = texts_with[at] >= least
            at, share = at[known], share[known]
            mean = share @ vectors[at]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            g = p / p.sum()
            g[y[i]] -= 1
            g *= weight[y[i]]
            back = out @ g
            step = np.outer(mean, g)
            seen_out += step * step
            out -= rate * step / np.sqrt(seen_out)
            seen_bias += g * g
            bias -= rate * g / np.sqrt(seen_bias)
            # one scale for each bucket's vector, from what it has been moved by so far
            seen[at] += share * share * float(back @ back)
            vectors[at] -= (rate * share / np.sqrt(seen[at]))[:, None] * back
    table = vectors @ (out[:, 1] - out[:, 0])
    table[texts_with < least] = 0
    return Quality(table.astype(np.float32), float(bias[1] - bias[0]))


def fit_on(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Quality:
    return fit(*labelled_sample(docs, labels, "quality", MODULUS, HELD_OUT, limit))


def quality(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs."""
    return scored(docs, fit_on(docs, labels, limit).score, MODULUS, HELD_OUT, threshold)
