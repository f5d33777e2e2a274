"""Alignments as a table laid out for what is asked of it: the clean filter prunes folders, a region prunes row groups, and the join with sites moves only the sites.

Rows are in buckets by (chromosome, cell, salt), sorted by place in each, with a folder for those that pass the clean filter and one for the others. A cell holds the positions that share
sites (sites.site_cells). A cell of very many rows is spread over salts, so no bucket holds a hot locus; which cells those are is a small table beside the rows, by which sites are repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewise.operators.alignments import is_clean, with_site_position
from sitewise.operators.sites import MAX_DISTANCE, cell_bits, site_cells

#: Rows of a cell that one bucket takes.
HOT_ROWS = 1 << 22


@dataclass(frozen=True)
class AlignmentTable:
    """A table in the catalog, where its files are, and the distance that its cells are made for."""

    name: str
    path: str
    max_distance: int

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def hot(self, spark: SparkSession) -> DataFrame:
        """chrom, cell and salts of the cells that are spread."""
        return spark.read.schema("chrom string, cell long, salts int").parquet(f"{self.path}/hot")


def store(
    alignments: DataFrame, name: str, path: str, unique: str, buckets: int | None = None, max_distance: int = MAX_DISTANCE, site_length: int = 4, hot_rows: int = HOT_ROWS, **clean
) -> AlignmentTable:
    """Writes alignments with their position at the site (pos), cell, salt and kept, the clean filter's outcome.

    unique names a column that tells rows apart, by which hot cells are dealt to salts. The number of buckets is by default that of shuffle partitions: a bucket is what a task reads.
    Rows without a chromosome or place are kept like others.
    """
    spark = alignments.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cell = F.shiftright(F.col("pos").cast("long"), cell_bits(max_distance))
    placed = with_site_position(alignments, site_length).select("*", cell.alias("cell"), F.coalesce(is_clean(alignments, **clean), F.lit(False)).alias("kept"))
    counts = placed.groupBy("chrom", "cell").agg(F.count(F.lit(1)).alias("n"))
    hot = counts.where(F.col("n") > hot_rows).select("chrom", "cell", F.ceil(F.col("n") / hot_rows).cast("int").alias("salts"))
    table = AlignmentTable(name, path, max_distance)
    hot.write.parquet(f"{path}/hot")
    left, right = placed.alias("row"), table.hot(spark).alias("hot")  # a row for each hot_rows rows at most
    dealt = left.join(right, F.col("row.chrom").eqNullSafe(F.col("hot.chrom")) & F.col("row.cell").eqNullSafe(F.col("hot.cell")), "left")
    salt = F.when(F.col("hot.salts").isNotNull(), F.pmod(F.xxhash64(F.col(f"row.{unique}")), F.col("hot.salts"))).otherwise(0).cast("int")
    keys = ("chrom", "cell", "salt")
    rows = dealt.select("row.*", salt.alias("salt")).repartition(buckets, *keys)  # a file for each bucket
    rows.write.partitionBy("kept").bucketBy(buckets, *keys).sortBy("chrom", "cell").option("path", f"{path}/rows").saveAsTable(name)
    return table


def region(spark: SparkSession, table: AlignmentTable, chrom: str, start: int, stop: int, kept: bool = True) -> DataFrame:
    """Rows whose position at the site lies in a half-open region: a folder is chosen, and row groups by their least and largest values."""
    bits = cell_bits(table.max_distance)
    place = (F.col("chrom") == chrom) & F.col("cell").between(start >> bits, (stop - 1) >> bits) & (F.col("pos") >= start) & (F.col("pos") < stop)
    return table.rows(spark).where(F.col("kept") == kept).where(place)


def near_site_stored(spark: SparkSession, table: AlignmentTable, sites: DataFrame) -> DataFrame:
    """Clean rows with rs_pos and d_rs of the nearest site within the table's distance, as sites.near_site gives them; rows stay where they are stored."""
    cells, _ = site_cells(sites, table.max_distance)
    salts = F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1)
    spread = cells.join(table.hot(spark), ["chrom", "cell"], "left").select("chrom", "cell", F.explode(salts).alias("salt"), "low", "high", "rs_pos")
    left, right = table.rows(spark).where("kept").alias("umi"), spread.alias("site")
    same = [F.col(f"umi.{c}") == F.col(f"site.{c}") for c in ("chrom", "cell", "salt")]
    met = left.join(right, [*same, F.col("umi.pos") >= F.col("site.low"), F.col("umi.pos") <= F.col("site.high")])
    return met.select("umi.*", "site.rs_pos", F.abs(F.col("umi.pos") - F.col("site.rs_pos")).alias("d_rs"))
