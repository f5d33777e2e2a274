"""Readers: reads, alignments, tables, sites, logs and counters. Compression follows from the suffix."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sitewise.sources import fastq as source
from sitewise.sources import schemas

#: Lines of one FASTQ record.
_RECORD = 4


def tsv(spark: SparkSession, path: str, schema: StructType, sep: str = "\t", mode: str = "FAILFAST") -> DataFrame:
    """A headerless table; quotes are ordinary characters, since qualities hold them. A wrong number of fields fails."""
    return spark.read.schema(schema).option("sep", sep).option("quote", "").option("mode", mode).csv(path)


def grouped_umis(spark: SparkSession, path: str) -> DataFrame:
    """Grouped rows with their space-joined lists as arrays."""
    rows = tsv(spark, path, schemas.GROUPED_UMI)
    lists = {c: F.split(F.col(c), " ") for c in ("seqs", "quals")}
    return rows.withColumns(lists).withColumn("n", F.size("seqs").cast("long"))


def sides(spark: SparkSession, path: str) -> DataFrame:
    """What clean_and_orphans wrote, with side from the folders."""
    schema = StructType([*schemas.GROUPED_UMI.fields, StructField("side", StringType())])
    rows = tsv(spark, path, schema)
    lists = {c: F.split(F.col(c), " ") for c in ("seqs", "quals")}
    return rows.withColumns(lists).withColumn("n", F.size("seqs").cast("long"))


def cut_sites(spark: SparkSession, path: str) -> DataFrame:
    """Sites with three or more columns; a missing name is null and further columns are left out."""
    parts = F.split(F.when(~F.col("value").startswith("#"), F.col("value")), "\t")  # null fields of headers, as in sam
    line = spark.read.text(path).where("value <> '' and not value like '#%'")
    return line.select(*(F.get(parts, F.lit(i)).cast(kind).alias(c) for i, (c, kind) in enumerate((("chrom", "string"), ("start", "bigint"), ("stop", "bigint")))), F.get(parts, F.lit(3)).alias("name"))


def snps(spark: SparkSession, path: str) -> DataFrame:
    return tsv(spark, path, schemas.SNP)


def snp_list(spark: SparkSession, path: str) -> DataFrame:
    """Variants as lists for allele splitting have them: id, chromosome, position (from 1), strand and both bases as C/T, in tabs, with or without a line of names.

    Gives chrom, snp_pos (from 0), ref and alt, in upper case. Lines whose bases aren't two single ones, such as insertions, are left out; a line with a position that is no number fails.
    """
    parts = F.split("value", "\t")
    field = lambda i: F.trim(F.get(parts, F.lit(i)))
    both = F.split(F.upper(field(4)), "/")
    rows = spark.read.text(path).select(field(1).alias("chrom"), field(2).alias("at"), F.get(both, F.lit(0)).alias("ref"), F.get(both, F.lit(1)).alias("alt"), F.size(both).alias("n"))
    single = [F.col(c).rlike("^[ACGT]$") for c in ("ref", "alt")]  # a line of names has none
    return rows.where(single[0] & single[1] & (F.col("n") == 2)).select("chrom", F.when(single[0], F.col("at")).cast("bigint").alias("x"), "ref", "alt").select("chrom", (F.col("x") - 1).alias("snp_pos"), "ref", "alt")


def sam(spark: SparkSession, path: str, numbered: bool = False) -> DataFrame:
    """Alignment records from text; header lines are left out. numbered adds line, which sorts in the order of files and of the lines in them."""
    # a later filter may be worked out beside ours, so header lines have null fields rather than wrong ones; a record that is cut short fails by its name
    header = F.col("value").startswith("@")
    parts = F.split(F.when(~header, F.col("value")), "\t")
    fields = [F.get(parts, F.lit(i)).cast(schemas.SAM_INTS.get(c, "string")).alias(c) for i, c in enumerate(schemas.SAM)]
    short = F.raise_error(F.concat(F.lit("not an alignment record: "), "value")).cast("string")
    fields[0] = F.when(F.size(parts) < len(schemas.SAM), F.when(~header, short)).otherwise(F.get(parts, F.lit(0))).alias("qname")
    # ids rise along a piece of a file, and pieces are told by where they begin
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    lines = spark.read.text(path)
    lines = lines.select("value", place.alias("line")) if numbered else lines
    return lines.where("not value like '@%' and value <> ''").select(*fields, *(["line"] if numbered else []))


def sam_references(spark: SparkSession, path: str) -> DataFrame:
    """The header's dictionary: chrom, index (its order, from 0) and length. Files that give a chromosome different places or lengths fail."""
    lines = spark.read.text(path).where("value like '@SQ\t%'").select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("id"), "value")
    field = lambda tag: F.regexp_extract("value", rf"\t{tag}:([^\t]+)", 1)
    each = lines.select(field("SN").alias("chrom"), (F.row_number().over(W.partitionBy("file").orderBy("id")) - 1).cast("long").alias("index"), field("LN").cast("bigint").alias("length"))
    known = each.groupBy("chrom").agg(F.min(F.struct("index", "length")).alias("x"), F.max(F.struct("index", "length")).alias("y"))
    differ = F.raise_error(F.concat(F.lit("headers differ about "), "chrom")).cast("bigint")
    return known.select("chrom", F.when(F.col("x") == F.col("y"), F.col("x.index")).otherwise(differ).alias("index"), F.col("x.length").alias("length"))


def fastq(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """Reads with library_id, file and read_no, which rises along a file. Plain files are read in ranges of split_bytes, packed ones by a task each; nothing is shuffled.

    A store that only Spark can open is read by lines (fastq_by_lines).
    """
    try:
        source.opened(path)
    except (pa.ArrowInvalid, OSError, NotImplementedError):
        return fastq_by_lines(spark, path)
    spark.dataSource.register(source.ReadsSource)
    reads = spark.read.format(source.NAME).option("splitBytes", split_bytes or source.SPLIT_BYTES).load(path)
    return reads.select(library_of(F.col("file")).alias("library_id"), "file", "read_no", "name", "seq", "qual")


def fastq_by_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same from Spark's own lines, for packed files in any store: ids that rise along the scan are in line order, since a file is one partition.

    Records are put together by their number, which shuffles each file over many tasks behind the one that unpacks it.
    """
    # wholetext is off, so lines of one file keep their order within its partitions and ids rise with it
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("id"), "value")
    first = lines.groupBy("file").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
    # one partition for each file is what makes the ids consecutive; a file in several pieces fails rather than mixing records
    whole = F.when(F.col("last") - F.col("first") + 1 == F.col("n"), F.col("first")).otherwise(F.raise_error(F.concat(F.lit("a reads file in several pieces: "), "file")).cast("long"))
    at = F.col("id") - F.col("first")
    rows = lines.join(first.select("file", whole.alias("first")), "file")
    record = rows.groupBy("file", F.floor(at / _RECORD).alias("read_no")).agg(
        *(F.max(F.when(F.pmod(at, F.lit(_RECORD)) == i, F.col("value"))).alias(c) for i, c in ((0, "name"), (1, "seq"), (3, "qual")))
    )
    return record.select(library_of(F.col("file")).alias("library_id"), "file", "read_no", F.substr("name", F.lit(2)).alias("name"), "seq", "qual")


def library_of(path: Column) -> Column:
    """A file's library: its base name up to the first underscore."""
    return F.split_part(F.regexp_extract(path, r"([^/]*)$", 1), F.lit("_"), F.lit(1))


def libraries(spark: SparkSession, glob: str) -> DataFrame:
    """Each library once, with its number of files."""
    files = spark.read.format("binaryFile").load(glob).select(F.col("path"))
    return files.groupBy(library_of(F.col("path")).alias("library_id")).agg(F.count(F.lit(1)).alias("files"))


def log_lines(spark: SparkSession, glob: str) -> DataFrame:
    """library_id, source, line_no (from 1 in each file), line. The library is that of the folder (library_id=...) or else of the file's name."""
    text = spark.read.text(glob)
    library = F.col("library_id").cast("string") if "library_id" in text.columns else library_of(F.col("source"))
    lines = text.select("*", F.col("_metadata.file_path").alias("source"), F.monotonically_increasing_id().alias("id"))
    return lines.select(library.alias("library_id"), "source", F.row_number().over(W.partitionBy("source").orderBy("id")).cast("long").alias("line_no"), F.col("value").alias("line"))


def counter_files(spark: SparkSession, glob: str, metric: str) -> DataFrame:
    """The integer on the first line of each file."""
    first = log_lines(spark, glob).where("line_no = 1")
    return first.select("library_id", F.lit(metric).alias("metric"), F.trim("line").cast("bigint").alias("value"))
