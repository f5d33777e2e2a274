"""Reads: prefix slices, quality and prefix filters, flag histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.functions.expressions import low_quality_share, near_literal

#: The fixed prefix of a read: (flag, bases).
PREFIX = (("umi", 8), ("bc", 8), ("cs", 4))


def slice_prefix(reads: DataFrame, prefix=PREFIX) -> DataFrame:
    """Flag columns and their qualities from the read's start; matched says whether the read was long enough, and shorter reads keep null flags."""
    whole = sum(n for _, n in prefix)
    matched = F.length("seq") >= whole
    columns, at = [], 1
    for flag, n in prefix:
        columns += [
            F.when(matched, F.substring("seq", at, n)).alias(flag),
            F.when(matched, F.substring("qual", at, n)).alias(f"{flag}_qual"),
        ]
        at += n
    rest = [F.when(matched, F.substr(c, F.lit(at))).otherwise(F.col(c)).alias(c) for c in ("seq", "qual")]
    others = [c for c in reads.columns if c not in ("seq", "qual")]
    return reads.select(*others, *columns, *rest, F.coalesce(matched, F.lit(False)).alias("matched"))


def pass_umi_quality(reads: DataFrame, quality: str = "umi_qual", below: int = 30, share: float = 0.2) -> DataFrame:
    """Adds high_quality: at most the share of UMI bases under the quality. An empty or null quality fails."""
    return reads.withColumn("high_quality", F.coalesce(low_quality_share(F.col(quality), below) <= share, F.lit(False)))


def pass_prefix(reads: DataFrame, barcode: str, site: str, substitutions: int = 1) -> DataFrame:
    """Adds prefix_ok: barcode and cut site both within so many substitutions."""
    both = near_literal(F.col("bc"), barcode, substitutions) & near_literal(F.col("cs"), site, substitutions)
    return reads.withColumn("prefix_ok", F.coalesce(both, F.lit(False)))


def match_barcodes(reads: DataFrame, barcodes: DataFrame, flag: str = "bc") -> DataFrame:
    """Adds barcode, the expected one within one substitution, and match: exact, near, ambiguous (several as near; barcode is null) or none.

    barcodes has barcode. Two strings that differ in one place are equal once that place is masked, so both sides meet in an equi-join on strings with one place masked, however many
    barcodes there are. Only the different values of the flag look for theirs; reads meet what was found by value.
    """
    masked = lambda c: F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1))), lambda i: F.overlay(c, F.lit("*"), i)))
    values = reads.select(F.col(flag).alias("value")).where("value <> ''").distinct()
    known = barcodes.select("barcode").where("barcode <> ''").distinct()
    met = values.select("value", masked(F.col("value")).alias("key")).join(known.select("barcode", masked(F.col("barcode")).alias("key")), "key")
    found = met.groupBy("value").agg(F.max(F.when(F.col("value") == F.col("barcode"), F.col("barcode"))).alias("same"), F.min("barcode").alias("low"), F.max("barcode").alias("high"))
    kind = F.when(F.col("same").isNotNull(), "exact").when(F.col("low") == F.col("high"), "near").otherwise("ambiguous")
    found = found.select(F.col("value").alias("found_value"), F.coalesce("same", F.when(F.col("low") == F.col("high"), F.col("low"))).alias("barcode"), kind.alias("match"))
    out = reads.join(found, F.col(flag) == F.col("found_value"), "left").drop("found_value")
    return out.withColumn("match", F.coalesce("match", F.lit("none")))


def routed(reads: DataFrame) -> DataFrame:
    """Adds route, by which a sink is partitioned and so writes all routes in one pass: unmatched, low_quality, and high_quality or, once prefixes are
    checked (pass_prefix), prefix_ok and prefix_bad."""
    kept = F.when(F.col("prefix_ok"), "prefix_ok").otherwise("prefix_bad") if "prefix_ok" in reads.columns else F.lit("high_quality")
    return reads.withColumn("route", F.when(~F.col("matched"), "unmatched").when(~F.col("high_quality"), "low_quality").otherwise(kept))


def flag_histogram(reads: DataFrame, *flags: str) -> DataFrame:
    """How often each value of each flag occurs: flag, value, reads. One aggregation serves all flags."""
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("flag"), F.col(f).alias("value")) for f in flags)))
    return reads.select(pairs.alias("x")).groupBy("x.flag", "x.value").agg(F.count(F.lit(1)).alias("reads"))
