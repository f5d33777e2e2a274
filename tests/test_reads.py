import gzip

import pytest
from pyspark.sql import functions as F

from sitewise.functions.expressions import near_literal, reference_length
from sitewise.operators import alignments as A
from sitewise.operators import allelic as L
from sitewise.operators import reads as R
from sitewise.operators import summary as M
from sitewise.sources import readers, schemas, sinks


@pytest.mark.parametrize(
    "seq,expected,ok",
    [("GTCGTATC", "GTCGTATC", True), ("GTCGTATG", "GTCGTATC", True), ("GTCGTAGG", "GTCGTATC", False), ("GTCGTAT", "GTCGTATC", False), ("GNTC", "GATC", True), ("GNTA", "GATC", False)],
)
def test_near_literal(spark, seq, expected, ok):
    df = spark.createDataFrame([(seq,)], "s string")
    assert df.select(near_literal(F.col("s"), expected)).first()[0] is ok
    assert df.select(near_literal(F.col("s"), expected, 2)).first()[0] is (len(seq) == len(expected))


def test_prefix_and_quality(spark):
    rows = [("a", "A" * 8 + "GTCGTATC" + "GATC" + "TTT", "I" * 23), ("b", "ACGT", "IIII"), ("c", "A" * 20, "#" * 2 + "I" * 18), ("d", None, None)]
    got = {r.name: r for r in R.routed(R.pass_umi_quality(R.slice_prefix(spark.createDataFrame(rows, schemas.READ)))).collect()}
    assert (got["a"].umi, got["a"].bc, got["a"].cs, got["a"].seq, got["a"].route) == ("A" * 8, "GTCGTATC", "GATC", "TTT", "high_quality")
    assert (got["b"].umi, got["b"].seq, got["b"].route) == (None, "ACGT", "unmatched")
    assert got["c"].route == "low_quality"
    assert got["d"].route == "unmatched"


def test_reference_length(spark):
    df = spark.createDataFrame([("10M2I3D5N4S1=2X",), ("*",)], "c string")
    assert [r[0] for r in df.select(reference_length(F.col("c"))).collect()] == [21, 0]


def test_sam_round_trip(spark, tmp_path):
    lines = ["@HD\tVN:1", "r~~umi~ACGT~~bc~GG~~cs~GATC~~qumi~IIII\t16\tchr1\t61\t40\t40M\t*\t0\t0\tACGT\tII\"I", "r2\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI", "r3\t256\tchr1\t5\t60\t4M\t*\t0\t0\tA\tI"]
    (tmp_path / "x.sam").write_text("\n".join(lines) + "\n")
    got = A.from_sam(readers.sam(spark, str(tmp_path / "x.sam")))
    row = A.read_name_flags(A.with_site_position(A.clean(got))).collect()
    assert [(r.pos, r.umi, r.umi_qual, r.qual) for r in row] == [(100, "ACGT", "IIII", 'II"I')]
    counters = A.alignment_counters(got).first()
    assert (counters.low_mapq, counters.mapped, counters.total) == (1, 1, 3)


def test_fastq(spark, tmp_path):
    with gzip.open(tmp_path / "TK1_S1_R1.fastq.gz", "wt") as f:
        f.write("".join(f"@n{i}\nACGT{i}\n+\n@II{i}\n" for i in range(25)))
    got = readers.fastq(spark, str(tmp_path / "*.gz")).orderBy("read_no").collect()
    assert [(r.library_id, r.name, r.seq, r.qual) for r in got] == [("TK1", f"n{i}", f"ACGT{i}", f"@II{i}") for i in range(25)]
    assert [tuple(r) for r in readers.libraries(spark, str(tmp_path / "*")).collect()] == [("TK1", 1)]


def test_tsv_round_trip_keeps_quotes(spark, tmp_path):
    df = spark.createDataFrame([("c", 1, ["A", "C"], ['"I', 'I\\"'])], "chrom string, pos long, seqs array<string>, quals array<string>")
    sinks.tsv(df, str(tmp_path / "o"))
    assert [tuple(r) for r in readers.grouped_umis(spark, str(tmp_path / "o")).collect()] == [("c", 1, ["A", "C"], ['"I', 'I\\"'], 2)]
    bad = tmp_path / "bad.tsv"
    bad.write_text("c\tx\tA\tI\n")
    with pytest.raises(Exception):  # noqa: B017
        readers.tsv(spark, str(bad), schemas.STRAND_UMI).collect()


def test_cut_sites_and_counters(spark, tmp_path):
    (tmp_path / "s.bed").write_text("chr1\t5\t9\nchr1\t10\t14\tname\tmore\n")
    assert [tuple(r) for r in readers.cut_sites(spark, str(tmp_path / "s.bed")).collect()] == [("chr1", 5, 9, None), ("chr1", 10, 14, "name")]
    (tmp_path / "TK1_lq.txt").write_text(" 12 \nmore\n")
    assert [tuple(r) for r in readers.counter_files(spark, str(tmp_path / "*_lq.txt"), "low_mapq").collect()] == [("TK1", "low_mapq", 12)]


def test_alleles(spark):
    reads = spark.createDataFrame([("r1", "c", 0, 200, "A"), ("r2", "c", 63, 64, "A"), ("r3", "d", 0, 9, "A")], "read_id string, chrom string, start_pos long, end_pos long, seq string")
    snps = spark.createDataFrame([("c", 0, "A", "C"), ("c", 63, "A", "C"), ("c", 199, "A", "C"), ("c", 200, "A", "C")], "chrom string, snp_pos long, ref string, alt string")
    got = L.snp_overlap(reads, snps).select("read_id", "snp_pos").collect()
    assert sorted(map(tuple, got)) == [("r1", 0), ("r1", 63), ("r1", 199), ("r2", 63)]
    rows = [("a", "A"), ("b", "C"), ("c", "A"), ("c", "C"), ("d", "G")]
    over = spark.createDataFrame([(r, b, "A", "C") for r, b in rows], "read_id string, base string, ref string, alt string")
    assert {r.read_id: (r["class"], r.weird) for r in L.allele_class(over).collect()} == {"a": ("genome1", False), "b": ("genome2", False), "c": ("conflict", False), "d": ("unassignable", True)}


def test_logs_and_summary(spark, tmp_path):
    lines = [
        (1, 1, "    12 (3.40%) aligned 0 times"), (1, 2, " INFO Output: 9 (90.00%) UMI sequences over 4"), (1, 3, "75 UMIs left after deduplication."),
        (1, 4, " INFO Output: 90 (90.00%) UMI sequences over 40"), (2, 1, "nothing"),
    ]
    values = M.log_values(spark.createDataFrame(lines, "library_id long, line_no long, line string"))
    assert {r.metric: r.value for r in values.collect()} == {"unmapped": 12, "from_cs": 90, "uniq": 75}
    table = M.library_summary(values, "run")
    row = table.first()
    assert (row.prep_run, row.from_cs, row.uniq_share, row.mapped_share, row.out_share) == ("run", 90, 75 / 90, None, None)
    with pytest.raises(Exception, match="no mapped for library 1"):
        M.require(table, "mapped").collect()
    sinks.summary(table, str(tmp_path / "summary"))
    text = next((tmp_path / "summary").glob("part*")).read_text().splitlines()
    assert text[0].split("\t")[:3] == ["prep_run", "library_id", "input"] and "83.33%" in text[1]


def test_allelic_summary_ratios(spark):
    rows = [("L", "", "mapped", 100), ("L", "", "genome1", 40), ("L", "", "genome2", 10), ("L", "g1", "n_umis", 40), ("L", "g1", "from_cs", 20), ("L", "g1", "uniq", 10), ("L", "m", "uniq", 25)]
    r = M.allelic_summary(spark.createDataFrame(rows, "library_id string, genome string, metric string, value long")).first()
    assert (r.genome1_share, r.g1_from_cs_share, r.g1_uniq_share, r.g1_out_share, r.m_out_share, r.g2_out_share) == (0.4, 0.5, 0.5, 0.25, 0.5, None)


def test_patterns_of_filters_and_weird_reads(spark):
    lines = [
        (1, 1, "[10:00] INFO kept 80/100 (80.00%) records. flag_extract.py:246"), (1, 2, "[10:01] INFO kept 60/80 (75.00%) records. flag_regex.py:156"),
        (1, 3, "7 reads did not contain one of the expected bases at known SNP positions (1.00%)"),
    ]
    values = M.log_values(spark.createDataFrame(lines, "library_id long, line_no long, line string"))
    assert {r.metric: r.value for r in values.collect()} == {"input": 100, "umi_hq": 80, "prefix": 60, "weird": 7}
    row = M.library_summary(values, "run").first()
    assert (row.umi_hq_share, row.prefix_share) == (0.8, 0.75)


def test_routes_with_prefixes(spark):
    from sitewise.jobs.preprocess import prepared_reads, read_counters

    good, bad = "I" * 24, "#" * 24
    rows = [("a", "ACGTACGTGTCGTATCGATCTTTT", good), ("b", "ACGTACGTGTCGTATAGATCTTTT", good), ("c", "ACGTACGTGTCGTATCGGGCTTTT", good), ("d", "ACGTACGTGTCGTATCGATCTTTT", bad), ("e", "ACG", "III"), ("f", None, None)]
    got = prepared_reads(spark.createDataFrame(rows, schemas.READ).withColumn("library_id", F.lit(1)), "GTCGTATC", "GATC")
    assert {r.name: r.route for r in got.collect()} == {"a": "prefix_ok", "b": "prefix_ok", "c": "prefix_bad", "d": "low_quality", "e": "unmatched", "f": "unmatched"}
    assert tuple(read_counters(got).first()) == (1, 6, 3, 2)


def test_coordinate_order_and_bed_numbers(spark, tmp_path):
    rows = [(f"chr{i % 3}", (i * 37) % 101, (i * 37) % 101 + 5) for i in range(200)]
    got = [tuple(r) for r in A.coordinate_sorted(spark.createDataFrame(rows, "chrom string, start_pos long, end_pos long")).collect()]
    assert got == sorted(rows)
    sinks.bed(spark.createDataFrame([("c", 1, 1, f"pos_{i}", 1) for i in (10, 9, 2, 1)], schemas.BED5), str(tmp_path / "bed"))
    text = "".join(gzip.open(p, "rt").read() for p in sorted((tmp_path / "bed").glob("part*")))
    assert [line.split("\t")[3] for line in text.splitlines()] == ["pos_1", "pos_2", "pos_9", "pos_10"]


def test_reads_without_a_variant_are_unassignable(spark):
    over = spark.createDataFrame([("a", "A", "C", "A")], "read_id string, ref string, alt string, base string")
    got = L.allele_class(over, reads=spark.createDataFrame([("a",), ("b",)], "read_id string")).collect()
    assert {(r.read_id, r["class"], r.weird, r.n_ref) for r in got} == {("a", "genome1", False, 1), ("b", "unassignable", False, 0)}


def test_allelic_summary_counts_all_reads_and_sites(spark, sf_dir):
    from sitewise.jobs import fixtures as X
    from sitewise.jobs import queries as Q

    r = Q.allelic_summary(spark, sf_dir).first()
    reads = {x.read_id: x for x in X.allelic_reads(spark, sf_dir).collect()}
    sites = {}
    for x in X.cut_sites(spark, sf_dir).collect():
        sites.setdefault(x.chrom, []).append(x.start)
    kinds = {x.read_id: x["class"] for x in Q.allele_class(spark, sf_dir).collect()}
    assert r.mapped == len(reads) == len(kinds) == r.unassigned + r.genome1 + r.genome2 + r.conflict
    n, distinct = 0, set()
    for i, kind in kinds.items():
        x = reads[i]
        at = x.end_pos if x.reverse_strand else x.start_pos - 4
        if kind == "genome1" and x.chrom in sites:
            near = min(sites[x.chrom], key=lambda s: (abs(at - s), s))
            if abs(at - near) <= 20:
                n += 1
                distinct.add((x.chrom, near, x.seq))
    assert (r.g1_from_cs, r.g1_uniq) == (n, len(distinct)) and n > 0
    on_sites = sum(kind == "genome1" and reads[i].chrom in sites for i, kind in kinds.items())
    assert r.g1_n_umis == on_sites and r.g1_from_cs_share == n / on_sites


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace as O

    from sitewise.sources.shared import new_dir

    session = lambda master, path: O(conf=O(get=lambda k, d: path, set=lambda k, v: None), sparkContext=O(master=master))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        new_dir(session("spark://host:7077", None), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        new_dir(session("local-cluster[2,1,1024]", None), "x")
    assert new_dir(session("yarn", "hdfs://n/shared/"), "x").startswith("hdfs://n/shared/x-")
    assert new_dir(session("local[4]", None), "x").startswith("file://")
