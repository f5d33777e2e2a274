"""Cut sites: nearest-site assignment, distance limit, orphans, chromosomes on either side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MAX_DISTANCE = 20
#: Bases for each window partition; a chromosome alone would leave a few dozen tasks however large the input.
BIN_WIDTH = 1 << 20


def _refuse(umis: DataFrame) -> None:
    if taken := {"rs_pos", "d_rs"} & {c.lower() for c in umis.columns}:
        raise ValueError(f"rows have a column named {sorted(taken)} already")


def cell_bits(max_distance: int) -> int:
    """By how many bits a position is shifted to its cell: cells are twice the distance or more."""
    return max(6, (2 * max_distance).bit_length())


def site_cells(sites: DataFrame, max_distance: int = MAX_DISTANCE, bin_width: int = BIN_WIDTH) -> tuple[DataFrame, int]:
    """The positions that belong to each site: chrom, cell, low and high (both included) and rs_pos; and by how many bits a position is shifted to its cell.

    A site has what lies within max_distance of it and no nearer to another one; of two as near, the lower has it. Cells are twice that distance or more, so a site is in one or two of
    them. Only neighbours within reach matter: sites near a bin's edge are in both bins while neighbours are looked up, and no chromosome's sites meet in one task. Repeated sites are one.
    """
    bits = cell_bits(max_distance)
    at, reach = F.col("start").cast("long"), 2 * max_distance + 1
    bin_of = lambda c: F.floor(c / bin_width)
    known = sites.select("chrom", at.alias("at")).where("chrom is not null and at is not null")
    near_bins = F.sequence(bin_of(F.col("at") - reach), bin_of(F.col("at") + reach))
    halo = known.select("chrom", "at", F.explode(near_bins).alias("bin")).repartition("chrom", "bin")
    along = W.partitionBy("chrom", "bin").orderBy("at")
    # of a repeated site all but the ends of the run are left with nothing
    low = F.greatest(F.col("at") - max_distance, F.shiftright(F.col("at") + F.lag("at").over(along), 1) + 1)
    high = F.least(F.col("at") + max_distance, F.shiftright(F.col("at") + F.lead("at").over(along), 1))
    own = halo.select("chrom", "at", "bin", low.alias("low"), high.alias("high")).where((F.col("bin") == bin_of(F.col("at"))) & (F.col("low") <= F.col("high")))
    cell = F.explode(F.sequence(F.shiftright("low", bits), F.shiftright("high", bits)))
    return own.select("chrom", cell.alias("cell"), "low", "high", F.col("at").alias("rs_pos")), bits


def near_site(umis: DataFrame, sites: DataFrame, max_distance: int = MAX_DISTANCE, how: str = "inner") -> DataFrame:
    """Adds rs_pos and d_rs of the nearest site within the distance; rows without one are left out, or have nulls where how is left.

    The same as nearest_site and within_distance, for a limit that is known beforehand: one equi-join on (chrom, cell), in which a row meets its one site, and no sort of the rows.
    """
    _refuse(umis)
    cells, bits = site_cells(sites, max_distance)
    pos = F.col("umi.pos").cast("long")
    left, right = umis.alias("umi"), cells.alias("site")
    met = left.join(right, (F.col("umi.chrom") == F.col("site.chrom")) & (F.shiftright(pos, bits) == F.col("site.cell")) & (pos >= F.col("site.low")) & (pos <= F.col("site.high")), how)
    return met.select("umi.*", "site.rs_pos", F.abs(pos - F.col("site.rs_pos")).alias("d_rs"))


def near_counters(umis: DataFrame, sites: DataFrame, *by: str, max_distance: int = MAX_DISTANCE, **counts: Column) -> DataFrame:
    """For each value of by and of counts (conditions over rows of umis): <name>_n_umis, the rows on chromosomes with sites; <name>_from_cs, those near one; <name>_uniq, their distinct
    (site, sequence); <name>_all, all rows. Without counts, all rows under plain names.

    Rows are read once. They are aggregated by (site, sequence), which spreads a hot site over tasks, then by chromosome; only that small table meets the chromosomes that have sites.
    """
    named = {f"{name}_": when for name, when in counts.items()} or {"": F.lit(True)}
    near = near_site(umis, sites, max_distance, "left")
    each = near.groupBy(*by, "chrom", "rs_pos", "seq").agg(*(F.count_if(when).alias(f"{name}n") for name, when in named.items()))
    has, n = F.col("rs_pos").isNotNull(), lambda name: F.col(f"{name}n")
    chroms = each.groupBy(*by, "chrom").agg(
        *(F.sum(n(name)).alias(f"{name}all") for name in named), *(F.sum(F.when(has, n(name)).otherwise(0)).alias(f"{name}from_cs") for name in named),
        *(F.count_if(has & (n(name) > 0)).alias(f"{name}uniq") for name in named),
    )
    sited = sites.select("chrom").distinct().withColumn("sited", F.lit(True))
    chroms = chroms.join(sited, "chrom", "left")
    out = [x for name in named for x in (
        F.sum(F.when(F.col("sited"), F.col(f"{name}all")).otherwise(0)).alias(f"{name}n_umis"), F.sum(f"{name}from_cs").alias(f"{name}from_cs"),
        F.sum(f"{name}uniq").alias(f"{name}uniq"), F.sum(f"{name}all").alias(f"{name}all"))]
    return chroms.groupBy(*by).agg(*out)


def nearest_site(umis: DataFrame, sites: DataFrame, bin_width: int = BIN_WIDTH) -> DataFrame:
    """Adds rs_pos and d_rs, the nearest site on the same chromosome (of two as near, the lower) and its distance.

    umis has chrom and pos; sites has chrom and start. Rows on chromosomes without sites are left out. Only distinct positions look for their sites, so a
    locus with very many rows is one position there; rows meet what was found in a join, whose hot keys adaptive execution splits.
    """
    _refuse(umis)
    spot = F.col("pos").cast("long")
    found = nearest_of(umis.select("chrom", spot.alias("at")).distinct(), sites, bin_width)
    left, right = umis.alias("umi"), found.alias("found")
    met = left.join(right, (F.col("umi.chrom") == F.col("found.chrom")) & (F.col("umi.pos").cast("long") == F.col("found.at")))
    return met.select("umi.*", "found.rs_pos", "found.d_rs")


def nearest_of(spots: DataFrame, sites: DataFrame, bin_width: int = BIN_WIDTH) -> DataFrame:
    """chrom, at, rs_pos and d_rs of each of the spots (chrom, at) whose chromosome has a site.

    Spots and sites of a bin are one sorted run, in which the last site before a spot and the first one after it are running values. What lies beyond
    the bin comes from each bin's first and last site: a small table, the only one in which a chromosome's rows meet.
    """
    bin_of = lambda c: F.floor(F.col(c) / bin_width)
    known = sites.select("chrom", F.col("start").cast("long").alias("at")).where("chrom is not null and at is not null").distinct().withColumn("bin", bin_of("at"))
    spots = spots.where("chrom is not null and at is not null").withColumn("bin", bin_of("at"))

    ends = known.groupBy("chrom", "bin").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    none = F.lit(None).cast("long")
    bins = ends.unionByName(spots.select("chrom", "bin").distinct().select("*", none.alias("low"), none.alias("high"))).groupBy("chrom", "bin").agg(F.max("low").alias("low"), F.max("high").alias("high"))
    along = W.partitionBy("chrom").orderBy("bin")
    beyond = bins.select(
        "chrom", "bin", F.last("high", ignorenulls=True).over(along.rowsBetween(W.unboundedPreceding, -1)).alias("before"),
        F.last("low", ignorenulls=True).over(W.partitionBy("chrom").orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, -1)).alias("after"),
    )

    line = spots.select("chrom", "bin", "at", none.alias("site")).unionByName(known.select("chrom", "bin", "at", F.col("at").alias("site")))
    running = lambda *order: F.last("site", ignorenulls=True).over(W.partitionBy("chrom", "bin").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    seen = line.withColumn("left", running("at", F.col("site").asc_nulls_last())).withColumn("right", running(F.desc("at"), F.col("site").asc_nulls_last())).where("site is null")
    seen = seen.join(beyond, ["chrom", "bin"]).select("chrom", "at", F.coalesce("left", "before").alias("left"), F.coalesce("right", "after").alias("right"))
    go_left = F.col("right").isNull() | (F.col("at") - F.col("left") <= F.col("right") - F.col("at"))
    rs_pos = F.when(go_left & F.col("left").isNotNull(), F.col("left")).otherwise(F.col("right"))
    return seen.select("chrom", "at", rs_pos.alias("rs_pos")).where("rs_pos is not null").withColumn("d_rs", F.abs(F.col("at") - F.col("rs_pos")))


def within_distance(assigned: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    return assigned.where(F.col("d_rs") <= max_distance)


def orphans(assigned: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    return assigned.where(F.col("d_rs") > max_distance)


def shared_chroms(umis: DataFrame, sites: DataFrame) -> DataFrame:
    """Chromosomes with both; each side is distinct before they meet, so that no chromosome's rows come together in a task."""
    return umis.select("chrom").distinct().intersect(sites.select("chrom").distinct())


def missing_chroms(umis: DataFrame, sites: DataFrame) -> DataFrame:
    """Chromosomes with UMIs but no cut site."""
    return umis.select("chrom").distinct().join(sites.select("chrom").distinct(), "chrom", "left_anti")


def assignment_stats(assigned: DataFrame, count: str | None = None) -> DataFrame:
    """Locations, UMIs and the spread of distances; count names a column with the UMIs of a row, else each row is one."""
    return assigned.agg(
        F.count(F.lit(1)).alias("n_locations"), (F.sum(count) if count else F.count(F.lit(1))).cast("long").alias("n_umis"),
        F.min("d_rs").alias("min_d"), F.avg("d_rs").alias("mean_d"), F.max("d_rs").alias("max_d"),
    )


def site_counters(assigned: DataFrame, *by: str, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """For each value of by: n_umis, the reads on chromosomes with sites; from_cs, those near one; uniq, their distinct (site, sequence); and n_sites.

    The first aggregation, on (site, sequence), spreads a hot site over tasks.
    """
    each = assigned.groupBy(*by, "chrom", "rs_pos", "seq").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("d_rs") <= max_distance).alias("near"))
    sites = each.groupBy(*by, "chrom", "rs_pos").agg(F.sum("n").alias("n"), F.sum("near").alias("near"), F.count_if(F.col("near") > 0).alias("uniq"))
    return sites.groupBy(*by).agg(F.sum("n").alias("n_umis"), F.sum("near").alias("from_cs"), F.sum("uniq").alias("uniq"), F.count_if(F.col("near") > 0).alias("n_sites"))
