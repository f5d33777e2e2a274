"""Exact deduplication by progressive refinement, in DataFrame operations only.

Rows are grouped by length; those of shared lengths by a hash of a prefix; only for rows of groups that still have two
members is the full text hashed. The texts never go through a shuffle: the first pass leaves counts of lengths, the second counts of
(length, prefix hash), the third finds the surviving rows by a bitmap of bounded size, and what is
shuffled and joined is a hash and an id. A third of all rows may be copies of one text: counts and minima
are aggregated before the shuffle, and the join back reads both sides from saved tables, so that adaptive
execution splits its hot key.

Texts are equal when identical after replacing each run of white space by one space; null counts as empty.
Repeated rows (same id, same text) are members of their group like others. A null id counts as the largest;
a group whose ids are all null has a null keep_id and keeps its rows. An empty table gives an empty result.
Columns other than the two named are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.llm.common import clean_columns, key_bitmap, normal_space, saved, with_maybe

PREFIX_CHARS = 128


def _refined(keyed: DataFrame) -> DataFrame:
    """Rows with text and length n, and whether a row may have an equal one (maybe).

    Lengths are counted first; prefixes are hashed for shared lengths alone, and of those only shared (length, prefix hash) groups survive.
    """
    lengths = saved(keyed.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("n"), "dedup-lengths")
    marked = with_maybe(keyed, F.xxhash64("n"), saved(key_bitmap(lengths, F.xxhash64("n")), "dedup-length-bitmap"), "shared")
    prefixed = marked.withColumn("p", F.when(F.col("shared"), F.xxhash64(F.substring("text", 1, PREFIX_CHARS))))
    counts = prefixed.where("shared").groupBy("n", "p").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    bitmap = saved(key_bitmap(counts, F.xxhash64("n", "p")), "dedup-bitmap")
    return with_maybe(prefixed, F.xxhash64("n", "p"), bitmap).withColumn("maybe", F.col("maybe") & F.col("shared"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_all: bool = False) -> DataFrame:
    """A row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256 (null where no full hash was needed, unless hash_all)."""
    texts = clean_columns(docs, doc_id=id_col, text=text_col).select("doc_id", normal_space(F.col("text")).alias("text"))
    marked = _refined(texts.select("doc_id", "text", F.length("text").alias("n")))
    full = F.sha2(F.col("text").cast("binary"), 256)
    rows = marked.select("doc_id", "maybe", (full if hash_all else F.when(F.col("maybe"), full)).alias("text_sha256"))
    rows = saved(rows, "dedup-rows")
    groups = rows.where("maybe").groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = saved(groups.where("group_size > 1"), "dedup-groups")

    grouped = rows.where("maybe").join(groups, "text_sha256", "left")
    alone = rows.where(~F.col("maybe")).select("*", F.lit(None).cast(rows.schema["doc_id"].dataType).alias("keep_id"), F.lit(None).cast("long").alias("group_size"))
    out = grouped.unionByName(alone)
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256",
    )


def distinct_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, one of each group of equal texts: that with the smallest id, nulls last; of repeated rows one stays.

    Rows, not ids, are taken out: where one id has several texts, each text is judged by itself. Rows that may have an equal one meet by their text's
    hash, of each task at most one row for each text.
    """
    packed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[id_col].alias("doc_id"), normal_space(docs[text_col]).alias("text"))
    marked = _refined(packed.withColumn("n", F.length("text")))
    alone = marked.where(~F.col("maybe")).select("row")
    hashed = marked.where("maybe").select("row", F.sha2(F.col("text").cast("binary"), 256).alias("h"), F.struct(F.isnull("doc_id").alias("none"), "doc_id").alias("rank"))
    kept = hashed.groupBy("h").agg(F.min_by("row", "rank").alias("row"))
    return alone.unionByName(kept.select("row")).select("row.*")
