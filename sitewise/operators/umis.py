"""UMIs: grouping by location, merging by cut site, exact deduplication, numbered BED rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.sources.shared import new_dir

#: Rows of one piece of a list: with sequences and qualities some 100 MB.
CHUNK_ROWS = 1 << 20
#: A row's place in its task, in ids that rise along each task.
_TASK_BITS = 33


def _ordered(order: list[str], *values: str) -> Column:
    """The rows of a group as an array of structs in a total order; a shuffle alone keeps none."""
    return F.array_sort(F.collect_list(F.struct(*order, *values)))


def group_umis(umis: DataFrame, order: str, by: tuple[str, ...] = ("chrom", "pos")) -> DataFrame:
    """One row for each location with parallel arrays seqs and quals in the order of a unique column.

    A location's lists are one row, as files of grouped UMIs have them: safe while a location's reads fit in a task's memory (some 10 million). Where they may
    not, list_chunks and dedup_chunks give the same lists in pieces, and count_distinct_umis the counts without lists.
    """
    rows = umis.groupBy(*by).agg(_ordered([order], "seq", "qual").alias("rows"))
    return rows.select(*by, F.col("rows.seq").alias("seqs"), F.col("rows.qual").alias("quals"), F.size("rows").cast("long").alias("n"))


def list_chunks(rows: DataFrame, order: str, by: tuple[str, ...] = ("chrom", "pos"), within: str | None = None, values: tuple[str, ...] = ("seq", "qual"), limit: int = CHUNK_ROWS, **sums: str) -> DataFrame:
    """A group's ordered lists in pieces of at most limit rows, for groups that one row can't hold: by, the chunk's place, the lists (<value>s), n, and sums of named columns.

    order is a unique whole number, within a column that comes before it. A group of more than limit rows is cut where order passes a multiple of limit (and where within changes), so no piece
    can hold more, whatever the group's size, and no row is numbered; other groups are one piece. A group's pieces in the order of (within, chunk) are its list.
    """
    large = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("group_rows")).where(F.col("group_rows") > limit).select(*by, F.lit(True).alias("large"))  # one for each limit rows at most
    left, right = rows.alias("left"), large.alias("right")
    marked = left.join(right, [F.col(f"left.{c}").eqNullSafe(F.col(f"right.{c}")) for c in by], "left").select("left.*", F.coalesce("right.large", F.lit(False)).alias("large"))
    marked = marked.withColumn("chunk", F.when(F.col("large"), F.floor(F.col(order) / limit)).otherwise(0).cast("long"))
    keys, first = [*by, "chunk"], [order]
    if within:
        marked = marked.withColumn(f"chunk_{within}", F.when(F.col("large"), F.col(within)))
        keys, first = [*by, f"chunk_{within}", "chunk"], [within, order]
    lists = marked.groupBy(*keys).agg(_ordered(first, *values).alias("rows"), *(F.sum(c).alias(name) for name, c in sums.items()))
    return lists.select(*keys, *(F.col(f"rows.{v}").alias(f"{v}s") for v in values), F.size("rows").cast("long").alias("n"), *sums)


def dedup_chunks(rows: DataFrame, order: str, by: tuple[str, ...] = ("chrom", "pos"), within: str | None = None, limit: int = CHUNK_ROWS) -> DataFrame:
    """Distinct sequences of each group in the order of their first occurrence, in pieces of at most limit: by, the chunk's place, seqs, pre_n and post_n of the piece.

    A sequence's first row and its copies are aggregated by (group, sequence), so a hot group is spread over tasks, and only then listed.
    """
    place = ([within] if within else []) + [order]
    firsts = rows.groupBy(*by, "seq").agg(F.min(F.struct(*place)).alias("first"), F.count(F.lit(1)).alias("copies"))
    lists = list_chunks(firsts.select(*by, "seq", "first.*", "copies"), order, by, within, ("seq",), limit, pre_n="copies")
    return lists.withColumnRenamed("n", "post_n")


def merge_sites(assigned: DataFrame, keep_terminal_row: bool = False) -> DataFrame:
    """Rows assigned to the same site become one, their lists in the order of the original positions.

    assigned has chrom, pos, seqs, quals, n and rs_pos. keep_terminal_row leaves each chromosome's last row by
    itself, as a known pipeline does.
    """
    by = ["chrom", "rs_pos"]
    if keep_terminal_row:
        last = assigned.groupBy("chrom").agg(F.max(F.struct("rs_pos", "pos")).alias("last"))  # a row for each chromosome
        assigned = assigned.join(last, "chrom").withColumn("terminal", F.struct("rs_pos", "pos") == F.col("last")).drop("last")
        by.append("terminal")
    rows = assigned.groupBy(*by).agg(_ordered(["pos"], "seqs", "quals").alias("rows"), F.sum("n").alias("n"))
    return rows.select("chrom", F.col("rs_pos").alias("pos"), F.flatten("rows.seqs").alias("seqs"), F.flatten("rows.quals").alias("quals"), "n")


def site_lists(near: DataFrame, order: str, keep_terminal_row: bool = False) -> DataFrame:
    """What group_umis and merge_sites give together, from reads with their site (chrom, pos, rs_pos, seq, qual and a unique order): one row for each site, in one aggregation."""
    by = ["chrom", "rs_pos"]
    if keep_terminal_row:
        last = near.groupBy("chrom").agg(F.max(F.struct("rs_pos", "pos")).alias("last"))  # a row for each chromosome
        near = near.join(last, "chrom").withColumn("terminal", F.struct("rs_pos", "pos") == F.col("last")).drop("last")
        by.append("terminal")
    rows = near.groupBy(*by).agg(_ordered(["pos", order], "seq", "qual").alias("rows"))
    return rows.select("chrom", F.col("rs_pos").alias("pos"), F.col("rows.seq").alias("seqs"), F.col("rows.qual").alias("quals"), F.size("rows").cast("long").alias("n"))


def dedup_umis(sited: DataFrame) -> DataFrame:
    """Exactly equal sequences of a row become one, in the order of their first occurrence; quality is dropped."""
    distinct = F.array_distinct("seqs")
    return sited.select("chrom", "pos", distinct.alias("seqs"), F.size("seqs").cast("long").alias("pre_n"), F.size(distinct).cast("long").alias("post_n"))


def count_distinct_umis(sited: DataFrame, reads: str | None = None) -> DataFrame:
    """What grouping, merging and deduplication give as counts, without the lists: chrom, pos, n_reads, n_umis.

    Two aggregations rather than count(distinct): the first, on (site, sequence), spreads a hot site over tasks. reads names a column with how many reads a row stands for.
    """
    each = sited.groupBy("chrom", F.col("rs_pos").alias("pos"), "seq").agg((F.sum(reads) if reads else F.count(F.lit(1))).alias("reads"))
    return each.groupBy("chrom", "pos").agg(F.sum("reads").alias("n_reads"), F.count("seq").alias("n_umis"))


def dedup_stats(deduplicated: DataFrame) -> DataFrame:
    pre, post = F.coalesce(F.sum("pre_n"), F.lit(0)), F.coalesce(F.sum("post_n"), F.lit(0))
    return deduplicated.agg(pre.alias("n_reads"), (pre - post).alias("n_duplicates"), post.alias("n_umis"))


def umi_lengths(umis: DataFrame) -> DataFrame:
    """How many lengths sequences have, and the mean of the distinct lengths."""
    lengths = umis.select(F.length("seq").alias("n")).where("n is not null").distinct()
    return lengths.agg(F.count("n").alias("n_lengths"), F.avg("n").alias("mean_length"), F.min("n").alias("min_length"), F.max("n").alias("max_length"))


def numbered(rows: DataFrame, *ties: str, by: tuple[str, ...] = ("chrom", "pos")) -> DataFrame:
    """Adds number, from 1, in the order of by and ties, without bringing all rows to one task and without working out the rows twice.

    Rows are dealt to tasks by ranges and sorted there, and written with their place in the task, which ids that rise along a task hold. Rows are then counted by task,
    and a task's rows begin behind those of the tasks before.
    """
    spark, path = rows.sparkSession, new_dir(rows.sparkSession, "numbered")
    held = rows.repartitionByRange(*by, *ties).sortWithinPartitions(*by, *ties).withColumn("id", F.monotonically_increasing_id())
    held.write.parquet(path)
    held = spark.read.schema(held.schema).parquet(path).withColumn("task", F.shiftright("id", _TASK_BITS))
    counts = sorted((r.task, r.n) for r in held.groupBy("task").agg(F.count(F.lit(1)).alias("n")).collect())  # a row for each task of the sort
    before, starts = 0, []
    for task, n in counts:
        starts.append((task, before))
        before += n
    starts = spark.createDataFrame(starts, "task long, before long")
    place = F.col("id").bitwiseAND(F.lit((1 << _TASK_BITS) - 1))
    return held.join(F.broadcast(starts), "task").withColumn("number", F.col("before") + place + 1).drop("task", "id", "before")


def bed5(deduplicated: DataFrame, *ties: str) -> DataFrame:
    """chrom, start, stop (equal to start), name pos_<number> and score, the count of UMIs."""
    return numbered(deduplicated, *ties).select(
        "chrom", F.col("pos").alias("start"), F.col("pos").alias("stop"), F.concat(F.lit("pos_"), F.col("number")).alias("name"), F.col("post_n").alias("score")
    )


def row_groups(rows: DataFrame, size: int, *ties: str) -> DataFrame:
    """Adds row_group, from 1: groups of so many consecutive rows."""
    return numbered(rows, *ties).withColumn("row_group", (F.floor((F.col("number") - 1) / size) + 1).cast("long"))
