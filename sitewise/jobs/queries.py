"""Registered queries of the site analytics, each with the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewise.functions.expressions import near_literal
from sitewise.jobs import fixtures as X
from sitewise.jobs import run as J
from sitewise.jobs.preprocess import allelic_counters, counters_of, genome_near, prepared_reads, sited_lists, sites_of
from sitewise.operators import alignments as A
from sitewise.operators import allelic as L
from sitewise.operators import histograms as H
from sitewise.operators import layout as T
from sitewise.operators import reads as R
from sitewise.operators import sites as S
from sitewise.operators import summary as M
from sitewise.operators import umis as U
from sitewise.sources import readers, schemas, sinks
from sitewise.sources.shared import new_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, *names: str):
    """Registers a query under its function's name, with its SQL over the named fixture tables."""

    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = X.sql(sql, *names) if names else sql
        return f

    return add


def _placed(spark, d) -> DataFrame:
    return A.with_site_position(A.clean(X.alignments(spark, d))).select("chrom", "pos", "seq")


def _assigned(spark, d) -> DataFrame:
    return S.nearest_site(_placed(spark, d), X.cut_sites(spark, d))


def _joined(df: DataFrame) -> DataFrame:
    """Lists as text, for comparing across engines."""
    return df.withColumns({c: F.array_join(c, " ") for c in ("seqs", "quals") if c in df.columns})


@query("SELECT chrom, rs_pos AS pos, count(*) AS n_reads, count(DISTINCT seq) AS n_umis FROM near WHERE d_rs <= 20 GROUP BY 1, 2", "near")
def flagship_sites(spark, d):
    return sites_of(X.alignments(spark, d), X.cut_sites(spark, d))


@query("SELECT * FROM aln WHERE mapq >= 30 AND chrom <> 'chrM'", "aln")
def clean_alignments(spark, d):
    return A.clean(X.alignments(spark, d))


@query(
    """SELECT count(*) FILTER (mapq < 30) AS low_mapq, count(*) FILTER (chrom = 'chrM') AS chrm,
    count(*) FILTER (mapq >= 30 AND chrom <> 'chrM') AS mapped, count(*) AS total FROM aln""", "aln",
)
def alignment_counters(spark, d):
    return A.alignment_counters(X.alignments(spark, d))


@query("SELECT chrom, pos, seq FROM umi", "umi")
def strand_positions(spark, d):
    return _placed(spark, d)


@query(
    """SELECT library_id, chrom, pos, string_agg(seq, ' ' ORDER BY line_no) AS seqs, string_agg(qual, ' ' ORDER BY line_no) AS quals, count(*) AS n
    FROM oumi GROUP BY library_id, chrom, pos""", "oumi",
)
def group_umis(spark, d):
    return _joined(U.group_umis(X.ordered_umis(spark, d), "line_no", ("library_id", "chrom", "pos")))


@query("SELECT chrom, pos, seq, rs_pos, d_rs FROM near", "near")
def nearest_site(spark, d):
    return _assigned(spark, d)


@query("SELECT chrom, pos, seq, rs_pos, d_rs FROM near WHERE d_rs <= 20", "near")
def within_distance(spark, d):
    return S.within_distance(_assigned(spark, d))


@query("SELECT chrom, rs_pos AS pos, seq, count(*) AS n FROM near WHERE d_rs > 20 GROUP BY 1, 2, 3", "near")
def orphans(spark, d):
    return S.orphans(_assigned(spark, d)).groupBy("chrom", F.col("rs_pos").alias("pos"), "seq").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT chrom FROM umi WHERE chrom NOT IN (SELECT chrom FROM cs)", "umi", "cs")
def missing_chroms(spark, d):
    return S.missing_chroms(_placed(spark, d), X.cut_sites(spark, d))


@query("SELECT chrom FROM umi INTERSECT SELECT chrom FROM cs", "umi", "cs")
def shared_chroms(spark, d):
    return S.shared_chroms(_placed(spark, d), X.cut_sites(spark, d))


@query("SELECT count(*) AS n_locations, count(*) AS n_umis, min(d_rs) AS min_d, avg(d_rs) AS mean_d, max(d_rs) AS max_d FROM near", "near")
def assignment_stats(spark, d):
    return S.assignment_stats(_assigned(spark, d))


_MERGED = "SELECT chrom, rs_pos AS pos, string_agg(seq, ' ' ORDER BY pos, line_no) AS seqs, string_agg(qual, ' ' ORDER BY pos, line_no) AS quals, count(*) AS n"


@query(f"{_MERGED} FROM osite GROUP BY chrom, rs_pos", "osite")
def merge_same_site(spark, d):
    return _joined(sited_lists(X.ordered_umis(spark, d), X.event_sites(spark, d), "line_no"))


@query(
    f"""{_MERGED} FROM (SELECT *, (rs_pos, pos) = max((rs_pos, pos)) OVER (PARTITION BY chrom) AS terminal FROM osite) GROUP BY chrom, rs_pos, terminal""",
    "osite",
)
def merge_same_site_terminal_row(spark, d):
    return _joined(sited_lists(X.ordered_umis(spark, d), X.event_sites(spark, d), "line_no", keep_terminal_row=True))


_DEDUP = """(SELECT chrom, rs_pos AS pos, seq, min((pos, line_no)) AS first, count(*) AS n FROM osite GROUP BY 1, 2, 3)"""


@query(f"SELECT chrom, pos, string_agg(seq, ' ' ORDER BY first) AS seqs, CAST(sum(n) AS BIGINT) AS pre_n, count(*) AS post_n FROM {_DEDUP} GROUP BY chrom, pos", "osite")
def dedup_umis(spark, d):
    return _joined(U.dedup_umis(sited_lists(X.ordered_umis(spark, d), X.event_sites(spark, d), "line_no")))


@query(f"SELECT CAST(sum(n) AS BIGINT) AS n_reads, CAST(sum(n) - count(*) AS BIGINT) AS n_duplicates, count(*) AS n_umis FROM {_DEDUP}", "osite")
def dedup_stats(spark, d):
    return U.dedup_stats(U.dedup_umis(sited_lists(X.ordered_umis(spark, d), X.event_sites(spark, d), "line_no")))


@query(
    """SELECT count(DISTINCT n) AS n_lengths, avg(DISTINCT n) AS mean_length, CAST(min(n) AS INT) AS min_length, CAST(max(n) AS INT) AS max_length
    FROM (SELECT length(substr(seq, 1, CAST(4 + line_no % 5 AS INT))) AS n FROM oumi)""", "oumi",
)
def umi_lengths(spark, d):
    cut = F.substring("seq", F.lit(1), (4 + F.col("line_no") % 5).cast("int"))
    return U.umi_lengths(X.ordered_umis(spark, d).withColumn("seq", cut))


_COUNTS = "(SELECT chrom, rs_pos AS pos, count(DISTINCT seq) AS post_n FROM near WHERE d_rs <= 20 GROUP BY 1, 2)"


def _site_counts(spark, d) -> DataFrame:
    return flagship_sites(spark, d).select("chrom", "pos", F.col("n_umis").alias("post_n"))


@query(f'SELECT chrom, pos AS start, pos AS stop, concat(\'pos_\', row_number() OVER (ORDER BY chrom, pos)) AS name, post_n AS score FROM {_COUNTS}', "near")
def bed5(spark, d):
    return U.bed5(_site_counts(spark, d))


@query(
    f"""SELECT chrom, pos, post_n, row_number() OVER (ORDER BY chrom, pos) AS number, (row_number() OVER (ORDER BY chrom, pos) - 1) // 1000 + 1 AS row_group
    FROM {_COUNTS}""", "near",
)
def row_groups(spark, d):
    return U.row_groups(_site_counts(spark, d), 1000)


@query(
    """SELECT read_id, substr(seq, 1, 8) AS umi, substr(qual, 1, 8) AS umi_qual, substr(seq, 9, 8) AS bc, substr(qual, 9, 8) AS bc_qual, substr(seq, 17, 4) AS cs,
    substr(qual, 17, 4) AS cs_qual, substr(seq, 21) AS seq, substr(qual, 21) AS qual, true AS matched FROM rp""", "rp",
)
def prefix_slices(spark, d):
    return R.slice_prefix(X.prefixed_reads(spark, d))


@query(
    """SELECT read_id, substr(qual, 1, 8) AS umi_qual,
    len(list_filter(range(1, 9), lambda i: ascii(substr(qual, CAST(i AS INT), 1)) - 33 < 30)) / 8 <= 0.2 AS high_quality FROM rp""", "rp",
)
def umi_quality_filter(spark, d):
    return R.pass_umi_quality(R.slice_prefix(X.prefixed_reads(spark, d))).select("read_id", "umi_qual", "high_quality")


@query(
    """SELECT read_id, bc, length(bc) = 8 AND hamming(bc, 'GTCGTATC') <= 1 AS passed FROM (SELECT p_partkey AS read_id,
      concat(substr(c, 1, 4), substr('ACGT', CAST(1 + p_partkey % 4 AS INT), 1), substr(c, 6)) AS bc FROM (SELECT p_partkey, p_size,
        concat(substr('GTCGTATC', 1, CAST(p_partkey % 8 AS INT)), substr('ACGT', CAST(1 + p_size % 4 AS INT), 1), substr('GTCGTATC', CAST(2 + p_partkey % 8 AS INT))) AS c FROM part))"""
)
def barcode_hamming(spark, d):
    return X.barcodes(spark, d).withColumn("passed", near_literal(F.col("bc"), "GTCGTATC"))


@query(
    """SELECT 'bc' AS flag, substr(seq, 9, 8) AS value, count(*) AS reads FROM rp GROUP BY 2
    UNION ALL SELECT 'cs', substr(seq, 17, 4), count(*) FROM rp GROUP BY 2""", "rp",
)
def flag_histogram(spark, d):
    return R.flag_histogram(R.slice_prefix(X.prefixed_reads(spark, d)), "bc", "cs")


@query("SELECT line_no, seq AS umi, qual AS umi_qual FROM oumi", "oumi")
def read_name_tokens(spark, d):
    return A.read_name_flags(X.named_reads(spark, d)).select("line_no", "umi", "umi_qual")


@query(r"SELECT library_id, 'from_cs' AS metric, arg_max(CAST(regexp_extract(line, 'Output: (\d+)', 1) AS BIGINT), line_no) AS value FROM lg GROUP BY library_id", "lg")
def log_extract_last(spark, d):
    return M.log_values(X.log_lines(spark, d))


@query(
    """SELECT library_id, max(CASE WHEN metric = 'view' THEN value END) AS "view", max(CASE WHEN metric = 'click' THEN value END) AS click,
    max(CASE WHEN metric = 'purchase' THEN value END) AS purchase,
    CAST(max(CASE WHEN metric = 'click' THEN value END) AS DOUBLE) / max(CASE WHEN metric = 'view' THEN value END) AS click_share FROM ct GROUP BY library_id""", "ct",
)
def summary_pivot(spark, d):
    table = M.wide(X.event_counters(spark, d), ("view", "click", "purchase"))
    return M.with_shares(table, [("click_share", "click", "view")])


@query("SELECT split_part(concat('TK', event_id % 3, '_S1_R', event_id % 2, '.fastq.gz'), '_', 1) AS library_id, count(DISTINCT event_id % 2) AS files FROM events GROUP BY 1")
def library_discovery(spark, d):
    from sitewise.sources.readers import library_of

    e = F.col("event_id")
    path = F.concat(F.lit("/data/fastq/TK"), e % 3, F.lit("_S1_R"), e % 2, F.lit(".fastq.gz"))
    files = X.table(spark, d, "events").select(path.alias("path")).distinct()
    return files.groupBy(library_of(F.col("path")).alias("library_id")).agg(F.count(F.lit(1)).alias("files"))


def _base() -> Column:
    """A base at a variant that the fixture makes up from a read's eight."""
    return F.substring("seq", (1 + (F.col("snp_pos") - F.col("start_pos")) % 8).cast("int"), F.lit(1))


def _overlaps(spark, d) -> DataFrame:
    return L.snp_overlap(X.allelic_reads(spark, d), X.snps(spark, d)).withColumn("base", _base()).drop("seq", "reverse_strand")


@query("SELECT * FROM ov", "ov")
def snp_overlap(spark, d):
    return _overlaps(spark, d)


def _classes(spark, d) -> DataFrame:
    """All reads, also those that cover no variant."""
    return L.class_reads(X.allelic_reads(spark, d), X.snps(spark, d), _base())


@query("SELECT * FROM cls", "cls")
def allele_class(spark, d):
    return _classes(spark, d)


@query("SELECT * FROM bov", "bov")
def snp_bases(spark, d):
    """Bases at variants through alignments with insertions, deletions, skips and clips."""
    return L.snp_bases(X.cigar_reads(spark, d), X.snps(spark, d))


@query(
    """SELECT read_id, n_ref, n_alt, n_other, CASE WHEN n_ref > 0 AND n_alt > 0 THEN 'conflict' WHEN n_ref > 0 THEN 'genome1' WHEN n_alt > 0 THEN 'genome2' ELSE 'unassignable' END AS class,
    n_other > 0 AS weird FROM (SELECT rd.read_id, count(*) FILTER (base = ref) AS n_ref, count(*) FILTER (base = alt) AS n_alt, count(*) FILTER (base <> ref AND base <> alt) AS n_other
    FROM rd LEFT JOIN bov ON rd.read_id = bov.read_id GROUP BY rd.read_id)""", "rd", "bov",
)
def allele_class_of_bases(spark, d):
    """Classes of all reads from their alignments' bases: deleted and skipped variants count for none."""
    reads = X.cigar_reads(spark, d)
    return L.allele_class(L.snp_bases(reads, X.snps(spark, d)), reads=reads)


def _genome_reads(spark, d) -> DataFrame:
    """Reads of genome1 and genome2, and both again as genome12."""
    reads = X.allelic_reads(spark, d).join(L.allele_class(_overlaps(spark, d)).select("read_id", "class"), "read_id")  # of the genomes, all cover a variant
    one, two = reads.where("class = 'genome1'"), reads.where("class = 'genome2'")
    return L.genome_union(g1=one, g2=two, m=one.unionByName(two))


_GENOMES = """(SELECT 'g1' AS genome, * FROM r WHERE class = 'genome1' UNION ALL SELECT 'g2', * FROM r WHERE class = 'genome2'
    UNION ALL SELECT 'm', * FROM r WHERE class IN ('genome1', 'genome2'))"""
_R = "r AS (SELECT rd.*, class FROM rd JOIN cls USING (read_id))"


@query(f"SELECT genome, chrom, count(*) AS reads, count(DISTINCT start_pos) AS positions FROM (WITH {_R} SELECT * FROM {_GENOMES}) GROUP BY genome, chrom", "rd", "cls")
def genome_union_sites(spark, d):
    each = _genome_reads(spark, d).groupBy("genome", "chrom", "start_pos").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("genome", "chrom").agg(F.sum("n").alias("reads"), F.count("start_pos").alias("positions"))


@query("SELECT genome, chrom, rs_pos AS pos, count(*) AS n_reads, count(DISTINCT seq) AS n_umis FROM gall WHERE d_rs <= 20 GROUP BY 1, 2, 3", "gall")
def genome_sites(spark, d):
    """The chain of each genome and of both together: nearest site, distance limit, merge, deduplication."""
    near = genome_near(X.alignments_with_id(spark, d), X.snps(spark, d), _base(), X.cut_sites(spark, d))
    each = near.groupBy("genome", "chrom", F.col("rs_pos").alias("pos"), "seq").agg(F.count(F.lit(1)).alias("reads"))
    return each.groupBy("genome", "chrom", "pos").agg(F.sum("reads").alias("n_reads"), F.count("seq").alias("n_umis"))


def _tail(g: str, whole: str) -> str:
    return f"{g}_from_cs / {g}_n_umis AS {g}_from_cs_share, {g}_uniq / {g}_from_cs AS {g}_uniq_share, {g}_uniq / {whole} AS {g}_out_share"


_TAILS = ", ".join(
    f"count(*) FILTER (genome = '{g}') AS {g}_n_umis, count(*) FILTER (genome = '{g}' AND d_rs <= 20) AS {g}_from_cs, count(DISTINCT (chrom, rs_pos, seq)) FILTER (genome = '{g}' AND d_rs <= 20) AS {g}_uniq"
    for g in ("g1", "g2", "m")
)


@query(
    f"""SELECT 0 AS library_id, *, unassigned / mapped AS unassigned_share, genome1 / mapped AS genome1_share, genome2 / mapped AS genome2_share, weird / mapped AS weird_share,
      conflict / mapped AS conflict_share, {_tail("g1", "genome1")}, {_tail("g2", "genome2")}, {_tail("m", "(genome1 + genome2)")}
    FROM (SELECT count(*) AS mapped, count(*) FILTER (class = 'unassignable') AS unassigned, count(*) FILTER (class = 'genome1') AS genome1, count(*) FILTER (class = 'genome2') AS genome2,
      count(*) FILTER (weird) AS weird, count(*) FILTER (class = 'conflict') AS conflict FROM cls), (SELECT {_TAILS} FROM gall)""", "cls", "gall",
)
def allelic_summary(spark, d):
    """Counters of one library from classes and genomes; each genome's reads go to their nearest site within the distance limit before they are counted."""
    reads = X.allelic_reads(spark, d).withColumn("library_id", F.lit(0))
    return M.allelic_shares(allelic_counters(reads, X.snps(spark, d), _base(), X.cut_sites(spark, d)))


@query("SELECT * EXCLUDE (name, qual) FROM fal WHERE mapq >= 30 AND chrom <> 'chrM' AND NOT unmapped AND NOT secondary AND NOT chimeric", "fal")
def clean_flagged_alignments(spark, d):
    return A.clean(X.flagged_alignments(spark, d)).drop("name", "qual")


_BC, _SITE = "GTCGTATC", "GATC"
_PREPARED = f"""(SELECT read_id, read_id % 3 AS library_id, substr(seq, 9, 8) AS bc, substr(seq, 17, 4) AS cs,
    len(list_filter(range(1, 9), lambda i: ascii(substr(qual, CAST(i AS INT), 1)) - 33 < 30)) / 8 <= 0.2 AS hq,
    hamming(substr(seq, 9, 8), '{_BC}') <= 6 AND hamming(substr(seq, 17, 4), '{_SITE}') <= 6 AS ok FROM rp)"""


def _prepared(spark, d) -> DataFrame:
    """Six substitutions, since made-up reads don't carry the barcode."""
    return prepared_reads(X.prefixed_reads(spark, d).withColumn("library_id", F.col("read_id") % 3), _BC, _SITE, 6)


@query(f"SELECT read_id, bc, cs, hq AS high_quality, ok AS prefix_ok, CASE WHEN NOT hq THEN 'low_quality' WHEN ok THEN 'prefix_ok' ELSE 'prefix_bad' END AS route FROM {_PREPARED}", "rp")
def read_routes(spark, d):
    return _prepared(spark, d).select("read_id", "bc", "cs", "high_quality", "prefix_ok", "route")


@query(
    f"""SELECT 'run' AS prep_run, *, umi_hq / input AS umi_hq_share, prefix / umi_hq AS prefix_share, mapped / prefix AS mapped_share, from_cs / n_umis AS from_cs_share,
      uniq / from_cs AS uniq_share, uniq / input AS out_share
    FROM (SELECT library_id, count(*) AS input, count(*) FILTER (hq) AS umi_hq, count(*) FILTER (hq AND ok) AS prefix FROM {_PREPARED} GROUP BY 1)
    JOIN (SELECT library_id, count(*) FILTER (unmapped) AS unmapped, count(*) FILTER (secondary) AS second_aln, count(*) FILTER (chrom = 'chrM') AS chrm, count(*) FILTER (mapq < 30) AS low_mapq,
      count(*) FILTER (mapq >= 30 AND chrom <> 'chrM' AND NOT unmapped AND NOT secondary AND NOT chimeric) AS mapped FROM fal GROUP BY 1) USING (library_id)
    JOIN (SELECT library_id, count(*) AS n_umis, count(*) FILTER (d_rs <= 20) AS from_cs, count(DISTINCT (chrom, rs_pos, seq)) FILTER (d_rs <= 20) AS uniq FROM fnear GROUP BY 1) USING (library_id)""",
    "rp", "fal", "fnear",
)
def library_summary(spark, d):
    """All counters and shares of each library, from reads and alignments to distinct UMIs."""
    table = counters_of(_prepared(spark, d), X.flagged_alignments(spark, d), X.cut_sites(spark, d))
    return M.require(M.library_summary(table, "run"), "input", "umi_hq", "prefix", "unmapped", "second_aln", "chrm", "low_mapq", "mapped", "from_cs", "uniq")


@query("SELECT concat('r', read_id) AS name, seq, qual FROM rp", "rp")
def fastq_round_trip(spark, d):
    path = new_dir(spark, "reads")
    sinks.reads_text(X.prefixed_reads(spark, d).withColumn("name", F.concat(F.lit("r"), "read_id")), path)
    return readers.fastq(spark, path).select("name", "seq", "qual")


@query("SELECT concat('r', read_id) AS name, seq, qual FROM rp", "rp")
def fastq_plain_round_trip(spark, d):
    """Plain files, cut into ranges that begin inside records."""
    path = new_dir(spark, "reads")
    sinks.reads_text(X.prefixed_reads(spark, d).withColumn("name", F.concat(F.lit("r"), "read_id")), path, compress=False)
    return readers.fastq(spark, path, split_bytes=2_500).select("name", "seq", "qual")


@query("SELECT name AS qname, * EXCLUDE (library_id, name, chimeric), chimeric AND NOT unmapped AS chimeric FROM fal", "fal")
def sam_round_trip(spark, d):
    path = new_dir(spark, "records")
    A.sam_lines(X.flagged_alignments(spark, d), F.col("name")).write.text(path)
    return A.from_sam(readers.sam(spark, path))


@query(
    """SELECT chrom, start_pos, end_pos, CAST(i AS BIGINT) AS "index", row_number() OVER (ORDER BY i, start_pos, end_pos) AS number
    FROM (SELECT *, dense_rank() OVER (ORDER BY CASE WHEN chrom = 'chrM' THEN 21 ELSE CAST(substr(chrom, 4) AS INT) END) - 1 AS i FROM fal)""", "fal",
)
def coordinate_order(spark, d):
    """Records of two sorted files, one for each strand, merged in the order of their headers' references."""
    path, references = new_dir(spark, "sorted"), X.references(spark, d)
    rows = X.flagged_alignments(spark, d).withColumnRenamed("name", "qname")
    for strand in ("reverse_strand", "not reverse_strand"):
        sinks.sam(rows.where(strand), f"{path}/{strand.split()[0]}", references)
    files = f"{path}/*"
    known = readers.sam_references(spark, files)
    records = A.with_reference_index(A.merged(known, A.from_sam(readers.sam(spark, files))), known)
    return U.numbered(records.select("chrom", "start_pos", "end_pos", "index"), "end_pos", by=("index", "start_pos"))


_CHUNKED = "SELECT *, CASE WHEN count(*) OVER (PARTITION BY chrom, pos) > 100 THEN line_no // 100 ELSE 0 END AS chunk FROM"


@query(
    f"""SELECT chrom, pos, chunk, string_agg(seq, ' ' ORDER BY line_no) AS seqs, string_agg(qual, ' ' ORDER BY line_no) AS quals, count(*) AS n
    FROM ({_CHUNKED} hot) GROUP BY chrom, pos, chunk""", "hot",
)
def hot_locus_lists(spark, d):
    """Lists of a locus with a third of all reads, in pieces of at most a hundred rows."""
    return _joined(U.list_chunks(X.hot_umis(spark, d), "line_no", limit=100))


@query(
    f"""SELECT chrom, pos, chunk, string_agg(seq, ' ' ORDER BY line_no) AS seqs, CAST(sum(copies) AS BIGINT) AS pre_n, count(*) AS post_n
    FROM ({_CHUNKED} (SELECT chrom, pos, seq, min(line_no) AS line_no, count(*) AS copies FROM hot GROUP BY chrom, pos, seq)) GROUP BY chrom, pos, chunk""", "hot",
)
def hot_locus_dedup(spark, d):
    """Distinct sequences of the same loci by first occurrence, in pieces."""
    return _joined(U.dedup_chunks(X.hot_umis(spark, d), "line_no", limit=100))


@query("SELECT chrom, start, start + 4 AS stop, concat('site', start) AS name FROM cs", "cs")
def sites_round_trip(spark, d):
    path = new_dir(spark, "sites")
    sites = X.cut_sites(spark, d)
    sinks.tsv(sites.select("chrom", "start", (F.col("start") + 4).alias("stop"), F.concat(F.lit("site"), "start").alias("name")), path)
    return readers.cut_sites(spark, path)


@query(
    """SELECT chrom, pos, string_agg(seq, ' ' ORDER BY line_no) AS seqs, string_agg(qual, ' ' ORDER BY line_no) AS quals, count(*) AS n
    FROM oumi GROUP BY chrom, pos""", "oumi",
)
def grouped_umis_round_trip(spark, d):
    path = new_dir(spark, "grouped")
    sinks.tsv(U.group_umis(X.ordered_umis(spark, d), "line_no").select("chrom", "pos", "seqs", "quals"), path)
    return _joined(readers.grouped_umis(spark, path))


@query("SELECT library_id, metric, value FROM ct", "ct")
def counters_round_trip(spark, d):
    path = new_dir(spark, "counters")
    sinks.counters(X.event_counters(spark, d), path)
    return spark.read.parquet(path)


_GROUPED = """(SELECT chrom, pos, string_agg(seq, ' ' ORDER BY line_no) AS seqs, string_agg(qual, ' ' ORDER BY line_no) AS quals, count(*) AS n FROM oumi GROUP BY chrom, pos)"""


def _sided(spark, d) -> DataFrame:
    return S.nearest_site(U.group_umis(X.ordered_umis(spark, d), "line_no"), X.event_sites(spark, d))


@query(f"SELECT CASE WHEN d_rs <= 20 THEN 'clean' ELSE 'orphan' END AS side, chrom, rs_pos AS pos, seqs, quals, n FROM onear JOIN {_GROUPED} USING (chrom, pos)", "onear")
def clean_orphan_round_trip(spark, d):
    """Both sides of the limit, written in one pass and read back by folder."""
    path = new_dir(spark, "sides")
    sinks.clean_and_orphans(_sided(spark, d), path, S.MAX_DISTANCE)
    return _joined(readers.sides(spark, path))


@query(
    f"""UNPIVOT (SELECT 'run1' AS run, 0 AS library_id, 'assign' AS step, count(*) AS n_locations, CAST(sum(n) AS BIGINT) AS n_umis, count(*) FILTER (d_rs <= 20) AS kept_locations,
    CAST(sum(n) FILTER (d_rs <= 20) AS BIGINT) AS from_cs FROM onear JOIN {_GROUPED} USING (chrom, pos)) ON n_locations, n_umis, kept_locations, from_cs INTO NAME metric VALUE value""", "onear",
)
def assignment_counters(spark, d):
    """Counts that the writing pass observed, put into the counters' table; the step runs twice and counts once."""
    path = new_dir(spark, "counters")
    for _ in range(2):
        counts = sinks.clean_and_orphans(_sided(spark, d), new_dir(spark, "sides"), S.MAX_DISTANCE)
        sinks.run_counters(spark.createDataFrame([(0, m, v) for m, v in counts.items()], "library_id int, metric string, value long"), path, "run1", "assign")
    return spark.read.parquet(path).select("run", "library_id", "step", "metric", "value")


@query(
    f"""SELECT CASE WHEN NOT hq THEN 'low_quality' WHEN ok THEN 'prefix_ok' ELSE 'prefix_bad' END AS route, concat('r', read_id) AS name, substr(rp.seq, 21) AS seq, substr(rp.qual, 21) AS qual
    FROM {_PREPARED} JOIN rp USING (read_id)""", "rp",
)
def routes_round_trip(spark, d):
    """Reads in a folder for each route, read back from there."""
    path = new_dir(spark, "routes")
    sinks.routed_reads(_prepared(spark, d).withColumn("name", F.concat(F.lit("r"), "read_id")), path)
    reads = readers.fastq(spark, path)
    return reads.select(F.regexp_extract("file", "/route=([^/]+)/", 1).alias("route"), "name", "seq", "qual")


@query(f"SELECT chrom, pos, string_agg(seq, ' ' ORDER BY first) AS seqs, CAST(count(*) AS INT) AS counts FROM {_DEDUP} GROUP BY chrom, pos", "osite")
def dedup_round_trip(spark, d):
    path = new_dir(spark, "dedup")
    lists = U.dedup_umis(sited_lists(X.ordered_umis(spark, d), X.event_sites(spark, d), "line_no"))
    sinks.tsv(lists.select("chrom", "pos", "seqs", F.col("post_n").alias("counts")), path)
    return readers.tsv(spark, path, schemas.DEDUP_UMI)


@query("SELECT chrom, pos AS start, pos AS stop, concat('pos_', row_number() OVER (ORDER BY chrom, pos)) AS name, post_n AS score FROM " + _COUNTS, "near")
def bed5_round_trip(spark, d):
    path = new_dir(spark, "bed")
    sinks.bed(U.bed5(_site_counts(spark, d)), path)
    return readers.tsv(spark, path, schemas.BED5)


@query("SELECT read_id, n_ref, n_alt, n_other, class, weird FROM cls", "cls")
def classes_round_trip(spark, d):
    """Reads in a folder for each class of allele, read back with their class from the folder."""
    path = new_dir(spark, "classes")
    sinks.classed(_classes(spark, d), path)
    return spark.read.parquet(path).select("read_id", "n_ref", "n_alt", "n_other", "class", "weird")


@query(
    """SELECT read_id, bc, CASE WHEN d = 0 OR n = 1 THEN barcode END AS barcode, CASE WHEN d = 0 THEN 'exact' WHEN n = 1 THEN 'near' WHEN n > 1 THEN 'ambiguous' ELSE 'none' END AS match
    FROM (SELECT read_id, any_value(r.bc) AS bc, arg_min(barcode, hamming(bc, barcode)) AS barcode, min(hamming(bc, barcode)) AS d, count(barcode) AS n
      FROM br r LEFT JOIN bk b ON length(bc) = length(barcode) AND hamming(bc, barcode) <= 1 GROUP BY read_id)""", "br", "bk",
)
def barcode_index(spark, d):
    """Reads with their barcode out of many, ambiguous ones kept apart."""
    return R.match_barcodes(X.barcoded_reads(spark, d), X.known_barcodes(spark, d))


@query(
    r"""SELECT CAST(library_id AS VARCHAR) AS library_id, 'from_cs' AS metric, arg_max(CAST(regexp_extract(line, 'Output: (\d+)', 1) AS BIGINT), line_no) AS value FROM lg GROUP BY library_id
    UNION ALL SELECT CAST(library_id AS VARCHAR), 'lines', count(*) FROM lg GROUP BY library_id""", "lg",
)
def reports_round_trip(spark, d):
    """Reports and counter files of each library, written and read back: the last line that matches counts, and a counter file's first line."""
    path, lines = new_dir(spark, "reports"), X.log_lines(spark, d)
    sinks.reports(lines, f"{path}/log")
    counts = lines.groupBy("library_id").agg(F.count(F.lit(1)).cast("string").alias("line"), F.lit(1).alias("line_no"))
    sinks.reports(counts.unionByName(counts.select("library_id", F.lit("more").alias("line"), F.lit(2).alias("line_no"))), f"{path}/counts")
    return M.log_values(readers.log_lines(spark, f"{path}/log")).unionByName(readers.counter_files(spark, f"{path}/counts", "lines"))


def _stored(spark, d) -> T.AlignmentTable:
    """The flagged alignments as a table; cells of over a hundred rows are spread over salts."""
    return T.store(X.flagged_alignments(spark, d), f"alignments_{uuid.uuid4().hex}", new_dir(spark, "alignments"), "name", hot_rows=100)


@query("SELECT chrom, rs_pos AS pos, count(*) AS n_reads, count(DISTINCT seq) AS n_umis FROM fnear WHERE d_rs <= 20 GROUP BY 1, 2", "fnear")
def stored_alignment_sites(spark, d):
    """Reads and UMIs at sites from the table of alignments, which stay where they are stored."""
    return U.count_distinct_umis(T.near_site_stored(spark, _stored(spark, d), X.cut_sites(spark, d)))


@query("SELECT name, chrom, pos, mapq FROM (SELECT name, chrom, mapq, CASE WHEN reverse_strand THEN end_pos ELSE start_pos - 4 END AS pos, mapq >= 30 AND chrom <> 'chrM' AND NOT unmapped AND NOT secondary AND NOT chimeric AS kept FROM fal) WHERE kept AND chrom = 'chr3' AND pos >= 1000 AND pos < 9000", "fal")
def stored_alignment_region(spark, d):
    """Clean alignments at a region, of which the scan prunes all else."""
    return T.region(spark, _stored(spark, d), "chr3", 1000, 9000).select("name", "chrom", "pos", "mapq")


@query(
    """SELECT coalesce(CAST(library_id AS VARCHAR), 'all') AS library_id, count(*) AS n, min(d_rs) AS low, avg(d_rs) AS mean, max(d_rs) AS high, quantile_cont(d_rs, 0.25) AS q25, quantile_cont(d_rs, 0.5) AS median, quantile_cont(d_rs, 0.75) AS q75
    FROM fnear GROUP BY GROUPING SETS ((library_id), ())""", "fnear",
)
def distance_quantiles(spark, d):
    """The spread of distances of each library and of all together, the latter from the libraries' histograms."""
    placed = A.with_site_position(A.clean(X.flagged_alignments(spark, d))).select("library_id", "chrom", "pos")
    each = H.histogram(S.nearest_site(placed, X.cut_sites(spark, d)), "d_rs", "library_id")
    both = F.explode(F.array(F.col("library_id").cast("string"), F.lit("all"))).alias("library_id")
    return H.spread(each.select(both, "value", "n"), "library_id")


@query(
    """SELECT flag, value, CAST(sum(n) AS BIGINT) AS n, count(*) AS libraries FROM (SELECT 'bc' AS flag, read_id % 3 AS library_id, substr(seq, 9, 8) AS value, count(*) AS n FROM rp GROUP BY 2, 3
    UNION ALL SELECT 'cs', read_id % 3, substr(seq, 17, 4), count(*) FROM rp GROUP BY 2, 3) GROUP BY flag, value""", "rp",
)
def merged_flag_histogram(spark, d):
    """Values of flags over all libraries, from the histograms of each, and how many libraries have a value."""
    reads = R.slice_prefix(X.prefixed_reads(spark, d)).withColumn("library_id", F.col("read_id") % 3)
    flags = F.explode(F.array(*(F.struct(F.lit(f).alias("flag"), F.col(f).alias("x")) for f in ("bc", "cs"))))
    each = H.histogram(reads.select("library_id", flags.alias("f")).select("library_id", "f.*"), "x", "library_id", "flag")
    seen = each.groupBy("flag", "value").agg(F.count(F.lit(1)).alias("libraries"))
    return H.merged(each, by=("flag",)).join(seen, ["flag", "value"])


@query(
    """SELECT chrom, pos AS start, pos AS stop, concat('pos_', row_number() OVER (ORDER BY chrom, pos)) AS name, post_n AS score
    FROM (SELECT chrom, rs_pos AS pos, count(DISTINCT seq) AS post_n FROM fnear WHERE d_rs <= 20 GROUP BY 1, 2)""", "fnear",
)
def run_to_bed(spark, d):
    """A library from files to files: records and sites as text, and the numbered rows that the job leaves."""
    path = new_dir(spark, "run")
    name = F.concat("name", F.lit("~~umi~"), "seq", F.lit("~~qumi~"), "qual")
    A.sam_lines(X.flagged_alignments(spark, d), name).write.text(f"{path}/in/sam")
    sinks.tsv(X.cut_sites(spark, d).select("chrom", "start", (F.col("start") + 4).alias("stop")), f"{path}/in/sites")
    J.sites_step(spark, f"{path}/in/sam", f"{path}/in/sites", f"{path}/out", "run1", "lib")
    return readers.tsv(spark, f"{path}/out/lib/bed", schemas.BED5)


@query("SELECT chrom, snp_pos, ref, alt FROM snp", "snp")
def snp_list_round_trip(spark, d):
    """Variants written and read back as lists for allele splitting have them."""
    path = new_dir(spark, "variants")
    sinks.snp_list(X.snps(spark, d), path)
    return readers.snp_list(spark, path)
