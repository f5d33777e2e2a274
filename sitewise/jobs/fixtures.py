"""The domain's tables, derived from the given star schema by fixed rules; nothing here is sampled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewise.functions.expressions import reference_length


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bases(number: Column, width: int = 8) -> Column:
    """A sequence from a number's decimal digits."""
    return F.translate(F.lpad(number.cast("string"), width, "0"), "0123456789", "ACGTACGTAC")


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chr0 to chr18, chr20 and chrM; chr20 has no cut sites."""
    k = F.col("l_suppkey") % 21
    return table(spark, sf_dir, "lineitem").select(
        F.when(k == 19, F.lit("chrM")).otherwise(F.concat(F.lit("chr"), k.cast("string"))).alias("chrom"),
        F.col("l_orderkey").alias("start_pos"), (F.col("l_orderkey") + F.col("l_quantity").cast("bigint")).alias("end_pos"),
        (F.col("l_linenumber") % 2 == 0).alias("reverse_strand"), F.col("l_quantity").cast("int").alias("mapq"), bases(F.col("l_partkey") % 16).alias("seq"),
    )


def flagged_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alignments with library, flags and qualities."""
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    lines = table(spark, sf_dir, "lineitem").select("*", (F.col("l_partkey") % 3).alias("library_id"))
    k = F.col("l_suppkey") % 21
    return lines.select(
        "library_id", F.concat(F.lit("a"), key).alias("name"), F.when(k == 19, F.lit("chrM")).otherwise(F.concat(F.lit("chr"), k.cast("string"))).alias("chrom"),
        F.col("l_orderkey").alias("start_pos"), (F.col("l_orderkey") + F.col("l_quantity").cast("bigint")).alias("end_pos"), (F.col("l_linenumber") % 2 == 0).alias("reverse_strand"),
        F.col("l_quantity").cast("int").alias("mapq"), bases(F.col("l_partkey") % 16).alias("seq"), F.lit("IIIIIIII").alias("qual"),
        (F.col("l_partkey") % 17 == 0).alias("unmapped"), (F.col("l_suppkey") % 13 == 0).alias("secondary"), (F.col("l_orderkey") % 19 == 0).alias("chimeric"),
    )


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header that lists chromosomes by number, so not by name, and the mitochondrion last."""
    n = F.element_at(F.split("chrom", "chr"), 2)
    chroms = alignments(spark, sf_dir).groupBy("chrom").agg(F.max("end_pos").alias("length"))
    return chroms.select("chrom", F.when(n == "M", 21).otherwise(F.expr("try_cast(element_at(split(chrom, 'chr'), 2) as bigint)")).cast("long").alias("index"), "length")


def cut_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    chrom = F.concat(F.lit("chr"), (F.col("o_custkey") % 20).cast("string"))
    return table(spark, sf_dir, "orders").select(chrom.alias("chrom"), F.col("o_orderkey").alias("start")).distinct()


def ordered_umis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a unique order: the fixture of everything that keeps lists."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("line_no"), (F.col("event_id") % 3).alias("library_id"), F.col("event_type").alias("chrom"), F.col("user_id").alias("pos"),
        bases(F.col("event_id") % 16).alias("seq"), F.translate((F.col("event_id") % 10).cast("string"), "0123456789", "?@ABCDEFGH").alias("qual"),
    )


def hot_umis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered rows of which a third are at one position, with some thousands of different sequences."""
    rows, hot = ordered_umis(spark, sf_dir), F.col("line_no") % 3 == 0
    place = {"chrom": F.when(hot, "hot").otherwise(F.col("chrom")), "pos": F.when(hot, 7).otherwise(F.col("pos"))}
    return rows.withColumns(place | {"seq": bases(F.col("line_no") * 7919 % 6000)})


def event_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cut site at the start of each 50 user ids in which a type has events, so that some events lie beyond the usual limit."""
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("chrom"), (F.col("user_id") - F.col("user_id") % 50).alias("start")).distinct()


def prefixed_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24-base reads whose qualities are Q28 to Q40."""
    quality = F.concat(*(F.char(61 + (F.lit(k) * F.col("p_partkey")) % 13) for k in range(1, 25)))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("read_id"), bases(F.col("p_partkey") * 7919 * 104729, 24).alias("seq"), quality.alias("qual"))


def barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expected barcode with two bases overwritten."""
    code, key = F.lit("GTCGTATC"), F.col("p_partkey")
    base = lambda c: F.substring(F.lit("ACGT"), (1 + c % 4).cast("int"), F.lit(1))
    at = (1 + key % 8).cast("int")
    code = F.overlay(code, base(F.col("p_size")), at, F.lit(1))
    return table(spark, sf_dir, "part").select(key.alias("read_id"), F.overlay(code, base(key), F.lit(5), F.lit(1)).alias("bc"))


def known_barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A barcode for each supplier."""
    return table(spark, sf_dir, "supplier").select(bases(F.col("s_suppkey") * 37).alias("barcode"))


def barcoded_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads with such a code, one base of it overwritten."""
    key = F.col("p_partkey")
    base = F.substring(F.lit("ACGT"), (1 + F.col("p_size") % 4).cast("int"), F.lit(1))
    return table(spark, sf_dir, "part").select(key.alias("read_id"), F.overlay(bases(key % 1500 * 37), base, (1 + key % 8).cast("int"), F.lit(1)).alias("bc"))


def named_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ordered_umis(spark, sf_dir)
    name = F.concat(F.lit("r"), "line_no", F.lit("~~umi~"), "seq", F.lit("~~bc~GTCGTATC~~cs~GATC~~qumi~"), "qual")
    return rows.select("line_no", "chrom", "pos", name.alias("qname"))


def snps(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = lambda c: F.substring(F.lit("ACGT"), (1 + c % 4).cast("int"), F.lit(1))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("chr"), (F.col("p_partkey") % 20).cast("string")).alias("chrom"), (F.col("p_partkey") * 7).alias("snp_pos"),
        base(F.col("p_size")).alias("ref"), base(F.col("p_size") + 1).alias("alt"),
    )


def allelic_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads by order and line; rows that repeat a line are one read."""
    return alignments_with_id(spark, sf_dir).groupBy("read_id", "chrom", "start_pos", "end_pos", "reverse_strand", "seq").agg(F.count(F.lit(1)).alias("copies")).drop("copies")


def alignments_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("read_id"), F.concat(F.lit("chr"), (F.col("l_suppkey") % 21).cast("string")).alias("chrom"),
        F.col("l_orderkey").alias("start_pos"), (F.col("l_orderkey") + F.col("l_quantity").cast("bigint")).alias("end_pos"),
        (F.col("l_linenumber") % 2 == 0).alias("reverse_strand"), bases(F.col("l_partkey") % 16).alias("seq"),
    )


#: Runs of eight bases of a read: how they lie on the reference.
CIGARS = ("8M", "2S6M", "3M2I3M", "3M4D5M", "4M20N4M", "5=3X", "2H3M1I2M2S", "1S2M1D1M2I2=")


def cigar_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reads by order and line with runs of every kind, as long on the reference as their runs say."""
    reads = allelic_reads(spark, sf_dir)
    cigar = F.element_at(F.array(*map(F.lit, CIGARS)), (1 + (F.col("end_pos") - F.col("start_pos")) % len(CIGARS)).cast("int"))
    return reads.withColumn("cigar", cigar).withColumn("end_pos", F.col("start_pos") + reference_length(F.col("cigar")))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that report how many rows each kind of event had; later kinds overwrite earlier ones."""
    counts = table(spark, sf_dir, "events").groupBy((F.col("event_id") % 3).alias("library_id"), (F.col("event_id") % 7).alias("line_no")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("m")
    )
    line = F.concat(F.lit("[10:00:00] INFO Output: "), "n", F.lit(" (97.50%) UMI sequences over "), "m", F.lit(" (80.00%) locations"))
    return counts.select("library_id", "line_no", line.alias("line"))


def event_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long counters (library_id, metric, value), one for each kind of event."""
    return table(spark, sf_dir, "events").groupBy((F.col("event_id") % 3).alias("library_id"), F.col("event_type").alias("metric")).agg(F.count(F.lit(1)).alias("value"))


#: The same tables for the comparing engine.
SQL = {
    "aln": """SELECT CASE WHEN l_suppkey % 21 = 19 THEN 'chrM' ELSE concat('chr', CAST(l_suppkey % 21 AS VARCHAR)) END AS chrom,
        l_orderkey AS start_pos, l_orderkey + CAST(l_quantity AS BIGINT) AS end_pos, l_linenumber % 2 = 0 AS reverse_strand,
        CAST(l_quantity AS INT) AS mapq, translate(lpad(CAST(l_partkey % 16 AS VARCHAR), 8, '0'), '0123456789', 'ACGTACGTAC') AS seq FROM lineitem""",
    "fal": """SELECT l_partkey % 3 AS library_id, concat('a', l_orderkey * 8 + l_linenumber) AS name, CASE WHEN l_suppkey % 21 = 19 THEN 'chrM' ELSE concat('chr', CAST(l_suppkey % 21 AS VARCHAR)) END AS chrom,
        l_orderkey AS start_pos, l_orderkey + CAST(l_quantity AS BIGINT) AS end_pos, l_linenumber % 2 = 0 AS reverse_strand, CAST(l_quantity AS INT) AS mapq,
        translate(lpad(CAST(l_partkey % 16 AS VARCHAR), 8, '0'), '0123456789', 'ACGTACGTAC') AS seq, 'IIIIIIII' AS qual,
        l_partkey % 17 = 0 AS unmapped, l_suppkey % 13 = 0 AS secondary, l_orderkey % 19 = 0 AS chimeric FROM lineitem""",
    "fumi": """SELECT library_id, chrom, CASE WHEN reverse_strand THEN end_pos ELSE start_pos - 4 END AS pos, seq FROM fal
        WHERE mapq >= 30 AND chrom <> 'chrM' AND NOT unmapped AND NOT secondary AND NOT chimeric""",
    "cs": "SELECT DISTINCT concat('chr', CAST(o_custkey % 20 AS VARCHAR)) AS chrom, o_orderkey AS start FROM orders",
    "umi": "SELECT chrom, CASE WHEN reverse_strand THEN end_pos ELSE start_pos - 4 END AS pos, seq FROM aln WHERE mapq >= 30 AND chrom <> 'chrM'",
    "near": """SELECT u.chrom, u.pos, u.seq, CASE WHEN p.start IS NULL THEN n.start WHEN n.start IS NULL THEN p.start
            WHEN u.pos - p.start <= n.start - u.pos THEN p.start ELSE n.start END AS rs_pos, abs(u.pos - CASE WHEN p.start IS NULL THEN n.start
            WHEN n.start IS NULL THEN p.start WHEN u.pos - p.start <= n.start - u.pos THEN p.start ELSE n.start END) AS d_rs
        FROM umi u ASOF LEFT JOIN cs p ON u.chrom = p.chrom AND u.pos >= p.start ASOF LEFT JOIN cs n ON u.chrom = n.chrom AND u.pos <= n.start
        WHERE p.start IS NOT NULL OR n.start IS NOT NULL""",
    "oumi": """SELECT event_id AS line_no, event_id % 3 AS library_id, event_type AS chrom, user_id AS pos,
        translate(lpad(CAST(event_id % 16 AS VARCHAR), 8, '0'), '0123456789', 'ACGTACGTAC') AS seq,
        translate(CAST(event_id % 10 AS VARCHAR), '0123456789', '?@ABCDEFGH') AS qual FROM events""",
    "hot": """SELECT line_no, CASE WHEN line_no % 3 = 0 THEN 'hot' ELSE chrom END AS chrom, CASE WHEN line_no % 3 = 0 THEN 7 ELSE pos END AS pos,
        translate(lpad(CAST(line_no * 7919 % 6000 AS VARCHAR), 8, '0'), '0123456789', 'ACGTACGTAC') AS seq, qual FROM oumi""",
    "ocs": "SELECT DISTINCT event_type AS chrom, user_id - user_id % 50 AS start FROM events",
    "oloc": "SELECT DISTINCT chrom, pos FROM oumi",
    "onear": """SELECT chrom, pos, rs_pos, abs(pos - rs_pos) AS d_rs FROM (SELECT u.chrom, u.pos, CASE WHEN p.start IS NULL THEN n.start WHEN n.start IS NULL THEN p.start
            WHEN u.pos - p.start <= n.start - u.pos THEN p.start ELSE n.start END AS rs_pos
        FROM oloc u ASOF LEFT JOIN ocs p ON u.chrom = p.chrom AND u.pos >= p.start ASOF LEFT JOIN ocs n ON u.chrom = n.chrom AND u.pos <= n.start
        WHERE p.start IS NOT NULL OR n.start IS NOT NULL)""",
    "snp": """SELECT concat('chr', CAST(p_partkey % 20 AS VARCHAR)) AS chrom, p_partkey * 7 AS snp_pos, substr('ACGT', CAST(1 + p_size % 4 AS INT), 1) AS ref,
        substr('ACGT', CAST(1 + (p_size + 1) % 4 AS INT), 1) AS alt FROM part""",
    "rd": """SELECT DISTINCT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS read_id, concat('chr', CAST(l_suppkey % 21 AS VARCHAR)) AS chrom,
        l_orderkey AS start_pos, l_orderkey + CAST(l_quantity AS BIGINT) AS end_pos, l_linenumber % 2 = 0 AS reverse_strand,
        translate(lpad(CAST(l_partkey % 16 AS VARCHAR), 8, '0'), '0123456789', 'ACGTACGTAC') AS seq FROM lineitem""",
    "ov": """SELECT r.read_id, r.chrom, r.start_pos, r.end_pos, s.snp_pos, s.ref, s.alt, substr(r.seq, CAST(1 + (s.snp_pos - r.start_pos) % 8 AS INT), 1) AS base
        FROM rd r JOIN snp s ON r.chrom = s.chrom AND s.snp_pos >= r.start_pos AND s.snp_pos < r.end_pos""",
    "cig": """SELECT * FROM (VALUES (0, 0, 8, 0, 'base'), (1, 0, 6, 2, 'base'), (2, 0, 3, 0, 'base'), (2, 3, 6, 5, 'base'), (3, 0, 3, 0, 'base'), (3, 3, 7, NULL, 'deleted'), (3, 7, 12, 3, 'base'),
        (4, 0, 4, 0, 'base'), (4, 4, 24, NULL, 'skipped'), (4, 24, 28, 4, 'base'), (5, 0, 8, 0, 'base'), (6, 0, 3, 0, 'base'), (6, 3, 5, 4, 'base'),
        (7, 0, 2, 1, 'base'), (7, 2, 3, NULL, 'deleted'), (7, 3, 4, 3, 'base'), (7, 4, 6, 6, 'base')) AS t(k, low, high, query, kind)""",
    "bov": """SELECT r.read_id, r.chrom, r.reverse_strand, r.start_pos, r.start_pos + l.n AS end_pos, s.snp_pos, s.ref, s.alt, c.kind, CAST(c.query + s.snp_pos - r.start_pos - c.low AS BIGINT) AS "offset",
          CASE WHEN c.query IS NOT NULL THEN substr(r.seq, CAST(1 + c.query + s.snp_pos - r.start_pos - c.low AS INT), 1) END AS base
        FROM rd r JOIN (SELECT k, max(high) AS n FROM cig GROUP BY k) l ON l.k = (r.end_pos - r.start_pos) % 8 JOIN snp s ON r.chrom = s.chrom AND s.snp_pos >= r.start_pos AND s.snp_pos < r.start_pos + l.n
        JOIN cig c ON c.k = l.k AND s.snp_pos - r.start_pos >= c.low AND s.snp_pos - r.start_pos < c.high""",
    "cls": """SELECT read_id, n_ref, n_alt, n_other, CASE WHEN n_ref > 0 AND n_alt > 0 THEN 'conflict' WHEN n_ref > 0 THEN 'genome1' WHEN n_alt > 0 THEN 'genome2'
        ELSE 'unassignable' END AS class, n_other > 0 AS weird FROM (SELECT rd.read_id, count(*) FILTER (base = ref) AS n_ref, count(*) FILTER (base = alt) AS n_alt,
        count(*) FILTER (base <> ref AND base <> alt) AS n_other FROM rd LEFT JOIN ov ON rd.read_id = ov.read_id GROUP BY rd.read_id)""",
    "gumi": """SELECT CASE class WHEN 'genome1' THEN 'g1' ELSE 'g2' END AS own, chrom, CASE WHEN reverse_strand THEN end_pos ELSE start_pos - 4 END AS pos, seq
        FROM rd JOIN cls USING (read_id) WHERE class IN ('genome1', 'genome2')""",
    "gall": "SELECT own AS genome, chrom, pos, seq, rs_pos, d_rs FROM gnear UNION ALL SELECT 'm', chrom, pos, seq, rs_pos, d_rs FROM gnear",
    "rp": """SELECT p_partkey AS read_id, translate(lpad(CAST(p_partkey * 7919 * 104729 AS VARCHAR), 24, '0'), '0123456789', 'ACGTACGTAC') AS seq,
        list_aggregate(list_transform(range(1, 25), lambda k: chr(CAST(61 + (k * p_partkey) % 13 AS INT))), 'string_agg', '') AS qual FROM part""",
    "bk": "SELECT DISTINCT translate(lpad(CAST(s_suppkey * 37 AS VARCHAR), 8, '0'), '0123456789', 'ACGTACGTAC') AS barcode FROM supplier",
    "br": """SELECT p_partkey AS read_id, concat(substr(c, 1, CAST(p_partkey % 8 AS INT)), substr('ACGT', CAST(1 + p_size % 4 AS INT), 1), substr(c, CAST(2 + p_partkey % 8 AS INT))) AS bc
        FROM (SELECT p_partkey, p_size, translate(lpad(CAST(p_partkey % 1500 * 37 AS VARCHAR), 8, '0'), '0123456789', 'ACGTACGTAC') AS c FROM part)""",
    "lg": """SELECT event_id % 3 AS library_id, event_id % 7 AS line_no, concat('[10:00:00] INFO Output: ', count(*), ' (97.50%) UMI sequences over ',
        count(DISTINCT user_id), ' (80.00%) locations') AS line FROM events GROUP BY 1, 2""",
    "ct": "SELECT event_id % 3 AS library_id, event_type AS metric, count(*) AS value FROM events GROUP BY 1, 2",
    "osite": """SELECT o.*, n.rs_pos FROM oumi o JOIN onear n USING (chrom, pos) WHERE d_rs <= 20""",
}


def _near(rows: str) -> str:
    """rows (chrom, pos and others) with the nearest site, of two as near the lower."""
    return f"""SELECT *, abs(pos - rs_pos) AS d_rs FROM (SELECT u.*, CASE WHEN p.start IS NULL THEN n.start WHEN n.start IS NULL THEN p.start
            WHEN u.pos - p.start <= n.start - u.pos THEN p.start ELSE n.start END AS rs_pos
        FROM {rows} u ASOF LEFT JOIN cs p ON u.chrom = p.chrom AND u.pos >= p.start ASOF LEFT JOIN cs n ON u.chrom = n.chrom AND u.pos <= n.start
        WHERE p.start IS NOT NULL OR n.start IS NOT NULL)"""


SQL |= {"gnear": _near("gumi"), "fnear": _near("fumi")}
#: Which tables each one reads.
_NEEDS = {"fumi": ["fal"], "fnear": ["fumi", "cs"], "gumi": ["rd", "cls"], "gnear": ["gumi", "cs"], "gall": ["gnear"], "umi": ["aln"], "near": ["umi", "cs"], "oloc": ["oumi"], "hot": ["oumi"], "onear": ["oloc", "ocs"], "ov": ["rd", "snp"], "bov": ["rd", "snp", "cig"], "cls": ["rd", "ov"], "osite": ["oumi", "onear"]}


def sql(body: str, *names: str) -> str:
    """A statement over the named tables and what they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in order) + " " + body
