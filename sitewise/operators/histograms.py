"""Exact distributions that merge: counts by value, from which the spread of any union of libraries comes without a further pass over rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUANTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def histogram(rows: DataFrame, column: str, *by: str, count: str | None = None) -> DataFrame:
    """by, value and n: how often each value of a column occurs; count names a column with how many a row stands for. Null values are left out."""
    n = F.sum(count) if count else F.count(F.lit(1))
    return rows.where(F.col(column).isNotNull()).groupBy(*by, F.col(column).alias("value")).agg(n.cast("long").alias("n"))


def merged(*histograms: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One histogram for each value of by, of all that the given ones have counted; columns that by doesn't name are merged over."""
    all_ = reduce(DataFrame.unionByName, (h.select(*by, "value", "n") for h in histograms))
    return all_.groupBy(*by, "value").agg(F.sum("n").alias("n"))


def spread(histograms: DataFrame, *by: str, quantiles: dict[str, float] | None = None) -> DataFrame:
    """n, low, mean, high and interpolated quantiles of each value of by. Values that several rows count are merged on the way.

    Quantiles are exact and hold a group's distinct values in a task: distances and lengths have some millions at most.
    """
    quantiles = quantiles or QUANTILES
    n, value = F.col("n"), F.col("value")
    out = histograms.groupBy(*by).agg(
        F.sum("n").alias("n"), F.min("value").alias("low"), (F.sum(value * n) / F.sum(n)).alias("mean"), F.max("value").alias("high"),
        F.percentile(value, list(quantiles.values()), n).alias("q"),
    )
    return out.select(*by, "n", "low", "mean", "high", *(F.get("q", F.lit(i)).alias(name) for i, name in enumerate(quantiles)))
