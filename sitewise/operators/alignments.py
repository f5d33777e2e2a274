"""Alignments: the clean filter, counters in one pass, strand-dependent positions, read-name flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.functions.expressions import (
    MATE_UNMAPPED, PAIRED, REVERSE, SECONDARY, UNMAPPED, has_flag, named_token, reference_length,
)

MIN_MAPQ, MITOCHONDRION = 30, "chrM"


def from_sam(sam: DataFrame, *also: str) -> DataFrame:
    """Half-open, zero-based coordinates and flag columns from alignment records; also names further fields to keep, such as cigar."""
    start = F.col("pos") - 1
    mate_elsewhere = has_flag(F.col("flag"), PAIRED) & ~has_flag(F.col("flag"), MATE_UNMAPPED) & ~F.col("rnext").isin("=", "*") & (F.col("rnext") != F.col("chrom"))
    return sam.select(
        "qname", "chrom", start.alias("start_pos"), (start + reference_length(F.col("cigar"))).alias("end_pos"), "mapq", "seq", "qual",
        has_flag(F.col("flag"), UNMAPPED).alias("unmapped"), has_flag(F.col("flag"), SECONDARY).alias("secondary"),
        has_flag(F.col("flag"), REVERSE).alias("reverse_strand"), (mate_elsewhere & ~has_flag(F.col("flag"), UNMAPPED)).alias("chimeric"), *also,
    )


def is_clean(alignments: DataFrame, min_mapq: int = MIN_MAPQ, mitochondrion: str = MITOCHONDRION) -> Column:
    """Mapped well, on a chromosome other than the mitochondrion; flag columns count where the table has them."""
    clean = (F.col("mapq") >= min_mapq) & (F.col("chrom") != mitochondrion)
    for flag in ("unmapped", "secondary", "chimeric"):
        if flag in alignments.columns:
            clean &= ~F.col(flag)
    return clean


def clean(alignments: DataFrame, **how) -> DataFrame:
    return alignments.where(is_clean(alignments, **how))


def alignment_counters(alignments: DataFrame, *by: str, min_mapq: int = MIN_MAPQ, mitochondrion: str = MITOCHONDRION) -> DataFrame:
    """All counters from one scan. They overlap, so none is derived from another. Flags are counted where the table has them."""
    flags = [F.count_if(flag).alias(name) for flag, name in (("unmapped", "unmapped"), ("secondary", "second_aln")) if flag in alignments.columns]
    return alignments.groupBy(*by).agg(
        *flags,
        F.count_if(F.col("mapq") < min_mapq).alias("low_mapq"),
        F.count_if(F.col("chrom") == mitochondrion).alias("chrm"),
        F.count_if(is_clean(alignments, min_mapq, mitochondrion)).alias("mapped"),
        F.count(F.lit(1)).alias("total"),
    )


def with_site_position(alignments: DataFrame, site_length: int = 4) -> DataFrame:
    """Adds pos, the start of the cut site next to the read: the end of a reverse read, the start less the site of others."""
    return alignments.withColumn("pos", F.when(F.col("reverse_strand"), F.col("end_pos")).otherwise(F.col("start_pos") - site_length))


def with_reference_index(alignments: DataFrame, references: DataFrame) -> DataFrame:
    """Adds index, a chromosome's place in the header (references: chrom, index); null for reads that have none, such as unmapped ones."""
    known = references.select(F.col("chrom").alias("known_chrom"), "index")  # a row for each chromosome
    return alignments.join(known, F.col("chrom") == F.col("known_chrom"), "left").drop("known_chrom")


def coordinate_sorted(alignments: DataFrame, references: DataFrame | None = None) -> DataFrame:
    """Rows in the order of chromosome and start over the whole table: ranges are dealt to tasks, and each task sorts its own.

    Chromosomes come in the order of the header where references are given (chr2 before chr10), those that it lacks and unmapped reads last; without, in the order of their names.
    """
    if references is None:
        return alignments.repartitionByRange("chrom", "start_pos").sortWithinPartitions("chrom", "start_pos", "end_pos")
    index = F.col("index").asc_nulls_last()
    rows = with_reference_index(alignments, references)
    return rows.repartitionByRange(index, "start_pos").sortWithinPartitions(index, "start_pos", "end_pos").drop("index")


def merged(references: DataFrame, *parts: DataFrame) -> DataFrame:
    """All rows of several tables of alignments in coordinate order."""
    return coordinate_sorted(reduce(DataFrame.unionByName, parts), references)


def sam_lines(alignments: DataFrame, name: Column, *also: Column | str) -> DataFrame:
    """Records of the text format from rows with flag columns, as value; each is one whole match. The reverse of from_sam. also are further columns to give."""
    bits = ((F.col("unmapped"), UNMAPPED), (F.col("secondary"), SECONDARY), (F.col("reverse_strand"), REVERSE), (F.col("chimeric"), PAIRED))
    flag = sum((F.when(c, bit).otherwise(0) for c, bit in bits), F.lit(0))
    mate = F.when(F.col("chimeric"), F.concat("chrom", F.lit("_mate"))).otherwise("*")
    cigar = F.concat(F.col("end_pos") - F.col("start_pos"), F.lit("M"))
    return alignments.select(*also, F.concat_ws("\t", name, flag, "chrom", F.col("start_pos") + 1, "mapq", cigar, mate, F.lit("0"), F.lit("0"), "seq", "qual").alias("value"))


def read_name_flags(alignments: DataFrame, name: str = "qname") -> DataFrame:
    """Adds umi and umi_qual from the read name, found by their labels rather than by place."""
    return alignments.withColumns({"umi": named_token(F.col(name), "umi"), "umi_qual": named_token(F.col(name), "qumi")})
