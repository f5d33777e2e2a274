"""From raw documents to packed sequences: five stages, each written as Parquet and read again as the next one's documents.

1. toxicity: documents that the classifier rejects go.
2. exact dedup: of equal texts, the smallest id stays.
3. n-gram Jaccard join: of each group of near copies, the smallest id stays.
4. mixing: documents come as often as their rates say, by the operator's own targets; no rate is below 1, so that no document goes.
5. packing: the pieces of all documents, each with its sequence and offset.

Stages 1 to 4 return the columns of their input, whatever those are named. Each stage sees all that its predecessor kept. Stages take out rows, not
ids: of rows with one id and different texts each is judged by itself, of repeated rows one stays, and rows without an id are treated like others, but
come last where one of a group is chosen. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sitewise.llm.common import saved
from sitewise.llm.exact_dedup import distinct_rows
from sitewise.llm.jaccard import one_of_each
from sitewise.llm.mixing import mixed
from sitewise.llm.packing import pack
from sitewise.llm.toxicity import THRESHOLD, fit_on, keep_below

def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below the threshold."""
    return keep_below(docs, fit_on(docs, _labels(spark, sf_dir)), THRESHOLD)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts, one with the smallest id."""
    return distinct_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies, a row with the smallest id."""
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as its rate says."""
    return mixed(docs, _labels(spark, sf_dir), floor=1.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all rows."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity), ("exact dedup", exact_dedup), ("n-gram Jaccard join", near_dedup), ("mixing sources to target weights", mixing), ("best-fit packing", packing),
]

#: Classifiers and packing can't be said in SQL; tests compare the stages with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
