"""Alleles: reads over known variants, a class for each read, the union of both genomes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewise.functions.expressions import cigar_runs, query_place

#: Bases for each bucket of the interval join; about a read's length, so that a read meets one or two.
BUCKET = 64


def snp_overlap(reads: DataFrame, snps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Each read with each variant that it covers: an equi-join on buckets, then the exact bound.

    reads: read_id, chrom, start_pos, end_pos (half open), seq; snps: chrom, snp_pos, ref, alt. A variant is in one
    bucket, so no pair comes twice.
    """
    at = F.explode(F.sequence(F.floor(F.col("start_pos") / bucket), F.floor((F.col("end_pos") - 1) / bucket)))
    spread = reads.where("end_pos > start_pos").withColumn("bucket", at)
    found = spread.join(snps.withColumn("bucket", F.floor(F.col("snp_pos") / bucket)), ["chrom", "bucket"])
    return found.where("snp_pos >= start_pos and snp_pos < end_pos").drop("bucket")


def snp_bases(reads: DataFrame, snps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Each read's base at each variant that its alignment spans, through the alignment's runs.

    reads: read_id, chrom, start_pos, end_pos, cigar and seq, as aligned (a reverse read's sequence is stored that way). Adds kind (base, deleted or skipped), offset and base: null where the
    read has no base there, so such a variant says nothing about the read in allele_class, as does a sequence that isn't stored (*). A read's runs are taken apart once, before it meets variants.
    """
    found = snp_overlap(reads.withColumn("runs", cigar_runs(F.col("cigar"))).drop("cigar"), snps, bucket)
    found = found.withColumn("place", query_place(F.col("runs"), F.col("start_pos"), F.col("snp_pos"))).drop("runs")
    has_base = (F.col("place.kind") == "base") & (F.col("seq") != "*")
    base = F.nullif(F.upper(F.substring("seq", (F.col("place.offset") + 1).cast("int"), F.lit(1))), F.lit(""))
    return found.withColumns({"kind": F.col("place.kind"), "offset": F.col("place.offset"), "base": F.when(has_base, base)}).drop("place", "seq")


def allele_class(overlaps: DataFrame, base: str = "base", read: str = "read_id", reads: DataFrame | None = None) -> DataFrame:
    """A class for each read: genome1, genome2, conflict or unassignable; weird says that some base was neither allele.

    reads are all reads, of which those that cover no variant are unassignable; without them only reads with overlaps are classed.
    """
    counts = overlaps.groupBy(read).agg(*_allele_counts(base))
    if reads is not None:
        counts = reads.select(read).distinct().join(counts, read, "left").na.fill(0, ["n_ref", "n_alt", "n_other"])
    return _classed(counts)


def _allele_counts(base: str) -> list[Column]:
    is_ref, is_alt = F.col(base) == F.col("ref"), F.col(base) == F.col("alt")
    return [F.count_if(is_ref).alias("n_ref"), F.count_if(is_alt).alias("n_alt"), F.count_if(~is_ref & ~is_alt).alias("n_other")]


def _classed(counts: DataFrame) -> DataFrame:
    ref, alt = F.col("n_ref") > 0, F.col("n_alt") > 0
    kind = F.when(ref & alt, "conflict").when(ref, "genome1").when(alt, "genome2").otherwise("unassignable")
    return counts.withColumn("class", kind).withColumn("weird", F.col("n_other") > 0)


def class_reads(reads: DataFrame, snps: DataFrame, base: Column, *keep: str, read: str = "read_id", bucket: int = BUCKET) -> DataFrame:
    """The class of each read from one pass over the reads: those that cover no variant stay in the same join and the same aggregation.

    base says a read's base at a variant, over the columns of both. With keep there is a row for each read and values of those columns (a read may be aligned more than once; rows that repeat
    wholly are one), all with the read's class; first marks one of a read's rows, so that reads can be counted.
    """
    buckets = F.when(F.col("end_pos") > F.col("start_pos"), F.sequence(F.floor(F.col("start_pos") / bucket), F.floor((F.col("end_pos") - 1) / bucket)))
    spread = reads.select("*", F.explode_outer(buckets).alias("at_bucket"))
    known = snps.withColumn("snp_bucket", F.floor(F.col("snp_pos") / bucket)).withColumnRenamed("chrom", "snp_chrom")
    on = (F.col("chrom") == F.col("snp_chrom")) & (F.col("at_bucket") == F.col("snp_bucket")) & (F.col("snp_pos") >= F.col("start_pos")) & (F.col("snp_pos") < F.col("end_pos"))
    met = spread.join(known, on, "left").select(read, *keep, base.alias("base"), "ref", "alt")
    if not keep:
        return _classed(met.groupBy(read).agg(*_allele_counts("base")))
    counts = met.repartition(read).groupBy(read, *keep).agg(*_allele_counts("base"))
    own = W.partitionBy(read)
    return _classed(counts.withColumns({c: F.sum(c).over(own) for c in ("n_ref", "n_alt", "n_other")} | {"first": F.row_number().over(own.orderBy(*keep)) == 1}))


def genome_union(**genomes: DataFrame) -> DataFrame:
    """Bag union of the genomes' rows under a genome column; alignments.coordinate_sorted orders it."""
    return reduce(DataFrame.unionByName, (df.withColumn("genome", F.lit(name)) for name, df in genomes.items()))
