"""Writers: tab-separated tables, BED, summaries, reads by route."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from sitewise.operators.alignments import sam_lines, with_reference_index
from sitewise.operators.summary import as_text


def tsv(df: DataFrame, path: str, compress: bool = True, header: bool = False, sep: str = "\t", mode: str = "errorifexists", folders: tuple[str, ...] = ()) -> None:
    """Arrays become space-joined text; quotes and backslashes stay as they are. Rows go to a folder for each value of the columns named in folders."""
    flat = df.select(*(F.concat_ws(" ", f.name).alias(f.name) if isinstance(f.dataType, ArrayType) else F.col(f.name) for f in df.schema))
    flat.write.mode(mode).partitionBy(*folders).option("sep", sep).option("quote", "").option("escape", "").option("header", header).option("compression", "gzip" if compress else "none").csv(path)


def clean_and_orphans(assigned: DataFrame, path: str, max_distance: int, compress: bool = True) -> dict[str, int]:
    """Both sides of the distance limit in one pass, in folders side=clean and side=orphan, and the counts that the same pass observed.

    The counts are rows and UMIs of the input and of what is kept, for counters. assigned has chrom, rs_pos, d_rs, seqs, quals and n.
    """
    kept = F.col("d_rs") <= max_distance
    seen, n = Observation(), F.coalesce("n", F.lit(0))
    zero = lambda x: F.coalesce(x, F.lit(0))
    counts = {"n_locations": F.count(F.lit(1)), "n_umis": zero(F.sum(n)), "kept_locations": F.count_if(kept), "from_cs": zero(F.sum(F.when(kept, n)))}
    rows = assigned.observe(seen, *(x.cast("long").alias(name) for name, x in counts.items()))
    side = F.when(kept, "clean").otherwise("orphan")
    tsv(rows.select(side.alias("side"), "chrom", F.col("rs_pos").alias("pos"), "seqs", "quals"), path, compress, folders=("side",))
    return seen.get


def bed(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Numbered rows in the order of their numbers, which names end with, over as many files as there are partitions."""
    tsv(df.orderBy("chrom", "start", F.regexp_extract("name", r"(\d+)$", 1).cast("long")), path, mode=mode)


def sam(alignments: DataFrame, path: str, references: DataFrame, name: str = "qname") -> None:
    """Records in coordinate order behind a header that lists the references; the files in order are one file."""
    header = references.select(
        F.lit(0).alias("part"), "index", F.lit(0).cast("long").alias("start_pos"), F.concat_ws("\t", F.lit("@SQ"), F.concat(F.lit("SN:"), "chrom"), F.concat(F.lit("LN:"), "length")).alias("value")
    )
    rows = with_reference_index(alignments, references)
    records = sam_lines(rows, F.col(name), F.lit(1).alias("part"), "index", "start_pos")
    first = references.sparkSession.createDataFrame([(-1, None, 0, "@HD\tVN:1.6\tSO:coordinate")], "part int, index long, start_pos long, value string")
    place = ["part", F.col("index").asc_nulls_last(), "start_pos"]
    lines = first.unionByName(header).unionByName(records).repartitionByRange(*place).sortWithinPartitions(*place, "value")
    lines.select("value").write.text(path)


def snp_list(snps: DataFrame, path: str) -> None:
    """Variants (chrom, snp_pos from 0, ref, alt) as readers.snp_list reads them; an id tells chromosome and position."""
    at = F.col("snp_pos") + 1
    tsv(snps.select(F.concat_ws(":", "chrom", at).alias("id"), "chrom", at.alias("position"), F.lit(1).alias("strand"), F.concat_ws("/", "ref", "alt").alias("bases")), path, header=True)


def summary(df: DataFrame, path: str, text: bool = True, mode: str = "errorifexists") -> None:
    """One file with a header, sorted by library: a row for each library is small by nature."""
    tsv((as_text(df) if text else df).orderBy("library_id").coalesce(1), path, compress=False, header=True, mode=mode)


def routed_reads(reads: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Reads of each route in a folder of its own, in one pass."""
    record = F.concat_ws("\n", F.concat(F.lit("@"), "name"), "seq", F.lit("+"), "qual")
    reads.select("route", record.alias("value")).write.mode(mode).partitionBy("route").option("compression", "gzip").text(path)


def reads_text(reads: DataFrame, path: str, compress: bool = True) -> None:
    """Reads as four lines each; packed files are read back by one task for each, plain ones in ranges."""
    record = F.concat_ws("\n", F.concat(F.lit("@"), "name"), "seq", F.lit("+"), "qual")
    reads.select(record.alias("value")).write.option("compression", "gzip" if compress else "none").text(path)


def classed(reads: DataFrame, path: str, column: str = "class") -> None:
    reads.write.partitionBy(column).parquet(path)


def counters(df: DataFrame, path: str) -> None:
    """Appends long counters (library_id, metric, value) to a table."""
    df.select("library_id", "metric", "value").write.mode("append").parquet(path)


def reports(lines: DataFrame, path: str) -> None:
    """Lines (library_id, line_no, line) of a step's report, a file in order in a folder for each library; also counters that are one number in a file."""
    rows = lines.select("library_id", "line_no", F.col("line").alias("value"))
    rows.repartition("library_id").sortWithinPartitions("library_id", "line_no").drop("line_no").write.partitionBy("library_id").text(path)


def run_counters(df: DataFrame, path: str, run: str, step: str) -> None:
    """Puts a step's counters (library_id, metric, value) into a table by run, library and step: what that step of that run wrote before is replaced, so a step may be repeated."""
    rows = df.select(F.lit(run).alias("run"), "library_id", F.lit(step).alias("step"), "metric", "value")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "library_id", "step").parquet(path)
