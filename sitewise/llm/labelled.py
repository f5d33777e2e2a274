"""What both classifiers of labelled documents share: the bounded sample that they learn from, and scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.llm.common import clean_columns, least_hashes, saved

#: At most so many labelled documents are learnt from: those with the least hashes of their ids.
MAX_LABELLED = 8_000


def remainder(id_column: Column, modulus: int) -> Column:
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(modulus))


def labelled_rows(docs: DataFrame, labels: DataFrame, target: str, modulus: int, held_out: int, limit: int = MAX_LABELLED) -> DataFrame:
    """doc_id, y (0 or 1) and text of at most limit labelled documents outside the held-out ones.

    Rows without an id or a label of 0 or 1 are left out; of several labels of an id, the largest counts.
    """
    marked = clean_columns(labels, doc_id="doc_id", y=target).where("doc_id is not null and y in (0, 1)")
    marked = marked.where(remainder(F.col("doc_id"), modulus) != held_out).groupBy("doc_id").agg(F.max("y").cast("int").alias("y"))
    marked = saved(marked.withColumn("h", F.xxhash64("doc_id")), "labelled-marks")
    marked = marked.where(least_hashes(marked, "h", limit)).drop("h")
    texts = clean_columns(docs, doc_id="doc_id", text="text").join(F.broadcast(marked), "doc_id")  # at most limit rows
    return texts.select("doc_id", "y", F.coalesce("text", F.lit("")).alias("text"))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, modulus: int, held_out: int, limit: int = MAX_LABELLED) -> tuple[list[str], np.ndarray]:
    """Texts and labels (0 or 1) of labelled_rows, in a fixed order."""
    rows = labelled_rows(docs, labels, target, modulus, held_out, limit).limit(limit).toPandas()
    rows = rows.sort_values(["doc_id", "text"])
    return rows["text"].tolist(), rows["y"].to_numpy(dtype=np.int64)


def scored(docs: DataFrame, score: Callable[[str], float], modulus: int, held_out: int, threshold: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for each row; the score reads the text alone."""
    named = clean_columns(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([score(t.as_py() or "") for t in batch.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    out = named.mapInArrow(run, f"doc_id {named.schema['doc_id'].dataType.simpleString()}, score double")
    return out.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), modulus) == held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def sigmoid(z: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

