"""A library from files to files: reads to routes, and alignments to clean and orphan rows, deduplicated rows, numbered BED rows, counters and the summary.

A step that is repeated puts its files and counts in the place of those that it left before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sitewise.jobs.preprocess import prepared_reads
from sitewise.operators import alignments as A
from sitewise.operators import sites as S
from sitewise.operators import summary as M
from sitewise.operators import umis as U
from sitewise.sources import readers, sinks

_AGAIN = "overwrite"


def _count(spark: SparkSession, out: str, run: str, library: str, step: str, counts: dict[str, int]) -> None:
    rows = spark.createDataFrame([(library, m, int(v or 0)) for m, v in counts.items()], "library_id string, metric string, value long")
    sinks.run_counters(rows, f"{out}/counters", run, step)


def reads_step(spark: SparkSession, fastq: str, out: str, run: str, library: str, barcode: str, site: str, substitutions: int = 1) -> None:
    """Reads into a folder for each route below <out>/<library>/reads, and their counts, which the pass that writes observes."""
    seen, kept = Observation(), F.col("matched") & F.col("high_quality")
    counts = {"input": F.count(F.lit(1)), "umi_hq": F.count_if(kept), "prefix": F.count_if(kept & F.col("prefix_ok"))}
    reads = prepared_reads(readers.fastq(spark, fastq), barcode, site, substitutions)
    named = reads.withColumn("name", F.concat("name", *(x for f in ("umi", "bc", "cs") for x in (F.lit(f"~~{f}~"), F.coalesce(f, F.lit("")), F.lit(f"~~q{f}~"), F.coalesce(f"{f}_qual", F.lit(""))))))
    sinks.routed_reads(named.observe(seen, *(c.alias(m) for m, c in counts.items())), f"{out}/{library}/reads", mode=_AGAIN)
    _count(spark, out, run, library, "reads", seen.get)


def sites_step(spark: SparkSession, sam: str, sites: str, out: str, run: str, library: str, max_distance: int = S.MAX_DISTANCE, site_length: int = 4) -> None:
    """All that follows the aligner, below <out>/<library>: orphan, clean, dedup and bed, and the counts of each step.

    Read names carry their UMI and its quality (~~umi~, ~~qumi~). Alignments are read twice, for their counters and for their UMIs by location, which are written once with their sites; what
    comes after reads those. Lists are in the order of the strands and of the file's lines.
    """
    here, cut = f"{out}/{library}", readers.cut_sites(spark, sites)
    alignments = A.from_sam(readers.sam(spark, sam, numbered=True), "line")
    _count(spark, out, run, library, "alignments", A.alignment_counters(alignments).drop("total").first().asDict())

    place = F.struct("reverse_strand", "line").alias("place")
    umis = A.with_site_position(A.read_name_flags(A.clean(alignments)), site_length).select("chrom", "pos", F.col("umi").alias("seq"), F.col("umi_qual").alias("qual"), place)
    S.nearest_site(U.group_umis(umis, "place"), cut).write.mode(_AGAIN).parquet(f"{here}/assigned")
    assigned = spark.read.parquet(f"{here}/assigned")

    seen, n = Observation(), F.coalesce("n", F.lit(0))
    near, far = S.within_distance(assigned, max_distance), S.orphans(assigned, max_distance)
    counts = {"n_umis": F.sum(n), "from_cs": F.sum(F.when(F.col("d_rs") <= max_distance, n)), "n_locations": F.count(F.lit(1))}
    _count(spark, out, run, library, "assign", assigned.agg(*(c.cast("long").alias(m) for m, c in counts.items())).first().asDict())
    columns = ("chrom", "pos", "seqs", "quals")
    sinks.tsv(far.withColumn("pos", F.col("rs_pos")).select(*columns), f"{here}/orphan", mode=_AGAIN)
    merged = U.merge_sites(near)
    sinks.tsv(merged.select(*columns), f"{here}/clean", mode=_AGAIN)

    rows = U.dedup_umis(readers.grouped_umis(spark, f"{here}/clean"))
    left = {"pre_n": F.sum("pre_n"), "uniq": F.sum("post_n"), "n_sites": F.count(F.lit(1))}
    sinks.tsv(rows.observe(seen, *(c.cast("long").alias(m) for m, c in left.items())).select("chrom", "pos", "seqs", F.col("post_n").alias("counts")), f"{here}/dedup", mode=_AGAIN)
    _count(spark, out, run, library, "dedup", seen.get)
    counted = readers.tsv(spark, f"{here}/dedup", readers.schemas.DEDUP_UMI).select("chrom", "pos", F.col("counts").cast("long").alias("post_n"))
    sinks.bed(U.bed5(counted), f"{here}/bed", mode=_AGAIN)


def summary_step(spark: SparkSession, out: str, run: str) -> DataFrame:
    """The summary of a run's libraries from what their steps have counted, also written as <out>/summary."""
    counters = spark.read.parquet(f"{out}/counters").where(F.col("run") == run)
    table = M.library_summary(counters.withColumn("library_id", F.col("library_id").cast("string")), run)
    sinks.summary(table, f"{out}/summary", mode=_AGAIN)
    return table
