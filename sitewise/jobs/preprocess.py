"""Whole jobs: reads to routes, alignments to deduplicated sites, genomes, and each library's counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.operators import alignments as A
from sitewise.operators import allelic as L
from sitewise.operators import reads as R
from sitewise.operators import sites as S
from sitewise.operators import umis as U


def sites_of(alignments: DataFrame, sites: DataFrame, max_distance: int = S.MAX_DISTANCE, site_length: int = 4, **clean) -> DataFrame:
    """Reads and distinct UMIs at each cut site: one plan from alignments, which are read once, as are the sites."""
    placed = A.with_site_position(A.clean(alignments, **clean), site_length).select("chrom", "pos", "seq")
    return U.count_distinct_umis(S.near_site(placed, sites, max_distance))


def prepared_reads(reads: DataFrame, barcode: str, site: str, substitutions: int = 1) -> DataFrame:
    """Reads cut into their prefix and the rest, with both filters' outcomes and the route of each."""
    sliced = R.pass_umi_quality(R.slice_prefix(reads))
    return R.routed(R.pass_prefix(sliced, barcode, site, substitutions))


def read_counters(prepared: DataFrame, library: str = "library_id") -> DataFrame:
    """input, umi_hq and prefix of each library, in one pass."""
    kept = F.col("matched") & F.col("high_quality")
    return prepared.groupBy(library).agg(F.count(F.lit(1)).alias("input"), F.count_if(kept).alias("umi_hq"), F.count_if(kept & F.col("prefix_ok")).alias("prefix"))


def genome_near(reads: DataFrame, snps: DataFrame, base: Column, sites: DataFrame, max_distance: int = S.MAX_DISTANCE) -> DataFrame:
    """Reads of genome1 (g1), genome2 (g2) and both (m) near a site, with that site, from one pass: each read is classed with its place, and only those of a genome look for sites.

    Rows of a read that repeat wholly are one, so reads needn't be distinct.
    """
    classed = L.class_reads(reads, snps, base, "chrom", "start_pos", "end_pos", "reverse_strand", "seq")
    own = F.when(F.col("class") == "genome1", "g1").otherwise("g2").alias("own")
    placed = A.with_site_position(classed.where(F.col("class").isin("genome1", "genome2"))).select(own, "chrom", "pos", "seq")
    return S.near_site(placed, sites, max_distance).select(F.explode(F.array("own", F.lit("m"))).alias("genome"), "chrom", "pos", "seq", "rs_pos", "d_rs")


def allelic_counters(reads: DataFrame, snps: DataFrame, base: Column, sites: DataFrame, library: str = "library_id") -> DataFrame:
    """All counters of the allelic summary of each library, in columns, from one pass over the reads: each is classed with its place, and genomes are conditions of one aggregation."""
    classed = A.with_site_position(L.class_reads(reads, snps, base, library, "chrom", "start_pos", "end_pos", "reverse_strand", "seq"))
    is_class = {"g1": F.col("class") == "genome1", "g2": F.col("class") == "genome2", "m": F.col("class").isin("genome1", "genome2")}
    of_reads = {"mapped": F.lit(True), "unassigned": F.col("class") == "unassignable", "genome1": is_class["g1"], "genome2": is_class["g2"], "weird": F.col("weird"), "conflict": F.col("class") == "conflict"}
    table = S.near_counters(classed, sites, library, **is_class, **{name: F.col("first") & when for name, when in of_reads.items()})
    return table.select(F.col(library).alias("library_id"), *(F.col(f"{name}_all").alias(name) for name in of_reads), *(f"{g}_{m}" for g in is_class for m in ("n_umis", "from_cs", "uniq")))


def sited_lists(umis: DataFrame, sites: DataFrame, order: str, max_distance: int = S.MAX_DISTANCE, keep_terminal_row: bool = False) -> DataFrame:
    """Ordered UMI lists at each cut site, from rows (chrom, pos, seq, qual and a unique order)."""
    return U.site_lists(S.near_site(umis, sites, max_distance), order, keep_terminal_row)


def counters_of(reads: DataFrame, alignments: DataFrame, sites: DataFrame, library: str = "library_id") -> DataFrame:
    """Long counters (library_id, metric, value) of each library from tables, instead of parsed logs.

    reads are prepared (prepared_reads), alignments have flag columns; both carry the library's column.
    """
    placed = A.with_site_position(A.clean(alignments)).select(library, "chrom", "pos", "seq")
    tables = (
        (read_counters(reads, library), ["input", "umi_hq", "prefix"]), (A.alignment_counters(alignments, library), ["unmapped", "second_aln", "chrm", "low_mapq", "mapped"]),
        (S.near_counters(placed, sites, library), ["n_umis", "from_cs", "uniq"]),
    )
    long = [t.unpivot(library, names, "metric", "value") for t, names in tables]
    return long[0].unionByName(long[1]).unionByName(long[2]).withColumnRenamed(library, "library_id")
