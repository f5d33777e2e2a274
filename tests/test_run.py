import gzip

import pytest

from sitewise.jobs import run as J
from sitewise.sources import readers, schemas


def sam(name, umi, flag, chrom, pos, mapq, cigar="10M"):
    return "\t".join([f"{name}~~umi~{umi}~~qumi~{'I' * len(umi)}", str(flag), chrom, str(pos), str(mapq), cigar, "*", "0", "0", "A" * 10, "I" * 10])


def test_a_library_from_files_to_files(spark, tmp_path):
    quality, bad = "I" * 24, "!" * 24
    reads = [("a", "ACGTACGT" + "GTCGTATC" + "GATC" + "TTTT", quality), ("b", "ACGTACGT" + "GTCGTATC" + "GATC" + "TTTT", bad), ("c", "ACGTACGT" + "AAAAAAAA" + "GATC" + "TTTT", quality), ("d", "ACG", "III")]
    with gzip.open(tmp_path / "lib_R1.fastq.gz", "wt") as f:
        f.writelines(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in reads)
    # a forward read's place is its start less the site's length, a reverse read's its end
    lines = ["@SQ\tSN:chr1\tLN:9999", sam("1", "AC", 0, "chr1", 105, 40), sam("2", "AC", 0, "chr1", 105, 40), sam("3", "GT", 0, "chr1", 107, 40), sam("4", "TT", 16, "chr1", 94, 40),
             sam("5", "AC", 0, "chr1", 205, 40), sam("6", "CC", 0, "chr1", 505, 40), sam("7", "AC", 0, "chr1", 105, 10), sam("8", "AC", 0, "chrM", 105, 40), sam("9", "AC", 4, "*", 0, 0, "*"),
             sam("10", "GG", 256, "chr1", 105, 40), sam("11", "AC", 0, "chr9", 105, 40)]
    (tmp_path / "lib.sam").write_text("\n".join(lines) + "\n")
    (tmp_path / "sites.bed").write_text("chr1\t100\t104\tx\nchr1\t200\t204\ty\n")
    out = str(tmp_path / "out")
    for _ in range(2):  # a step may be repeated
        J.reads_step(spark, str(tmp_path / "lib_R1.fastq.gz"), out, "run1", "lib", "GTCGTATC", "GATC")
        J.sites_step(spark, str(tmp_path / "lib.sam"), str(tmp_path / "sites.bed"), out, "run1", "lib")
    assert sorted(p.name for p in (tmp_path / "out/lib/reads").glob("route=*")) == ["route=low_quality", "route=prefix_bad", "route=prefix_ok", "route=unmatched"]
    kept = readers.fastq(spark, f"{out}/lib/reads/route=prefix_ok").first()
    assert (kept.seq, kept.qual) == ("TTTT", "IIII") and "~~umi~ACGTACGT~~qumi~IIIIIIII" in kept.name
    clean = {(r.chrom, r.pos): list(r.seqs) for r in readers.grouped_umis(spark, f"{out}/lib/clean").collect()}
    assert clean == {("chr1", 100): ["AC", "AC", "GT", "TT"], ("chr1", 200): ["AC"]}
    orphan = [(r.chrom, r.pos, r.seqs) for r in readers.grouped_umis(spark, f"{out}/lib/orphan").collect()]
    assert orphan == [("chr1", 200, ["CC"])]
    dedup = sorted((r.pos, r.seqs, r.counts) for r in readers.tsv(spark, f"{out}/lib/dedup", schemas.DEDUP_UMI).collect())
    assert dedup == [(100, "AC GT TT", 3), (200, "AC", 1)]
    bed = [tuple(r) for r in readers.tsv(spark, f"{out}/lib/bed", schemas.BED5).collect()]
    assert sorted(bed) == [("chr1", 100, 100, "pos_1", 3), ("chr1", 200, 200, "pos_2", 1)]
    row = J.summary_step(spark, out, "run1").first()
    assert (row.prep_run, row.library_id, row.input, row.umi_hq, row.prefix) == ("run1", "lib", 4, 2, 1)
    assert (row.unmapped, row.second_aln, row.chrm, row.mapped) == (1, 1, 1, 7) and (row.n_umis, row.from_cs, row.uniq) == (6, 5, 4)
    assert row.from_cs_share == 5 / 6
    text = "".join(p.read_text() for p in (tmp_path / "out/summary").glob("*.csv"))
    assert "83.33%" in text


def test_lines_sort_in_file_order(spark, tmp_path):
    (tmp_path / "x.sam").write_text("".join(sam(str(i), "AC", 0, "chr1", 5, 40) + "\n" for i in range(3000)))
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = readers.sam(spark, str(tmp_path / "x.sam"), numbered=True)
        assert rows.rdd.getNumPartitions() > 3
        got = [r.qname for r in rows.repartition(3, "qname").orderBy("line").select("qname").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    assert [x.split("~")[0] for x in got] == [str(i) for i in range(3000)]


def test_header_lines_and_short_records(spark, tmp_path):
    """A filter on fields beside the reader's own must not see header lines; a record that is cut short fails."""
    (tmp_path / "x.sam").write_text("@HD\tVN:1.6\n@SQ\tSN:chr1\tLN:9\n" + sam("1", "AC", 0, "chr1", 5, 40) + "\n")
    assert [r.qname for r in readers.sam(spark, str(tmp_path / "x.sam")).where("mapq >= 30 and flag % 2 = 0 and chrom <> 'chrM'").collect()] == ["1~~umi~AC~~qumi~II"]
    (tmp_path / "y.bed").write_text("#chrom\nchr1\t5\t9\n")
    assert [tuple(r) for r in readers.cut_sites(spark, str(tmp_path / "y.bed")).where("start > 2 and start is not null").collect()] == [("chr1", 5, 9, None)]
    (tmp_path / "z.sam").write_text("a\t0\tchr1\t5\n")
    with pytest.raises(Exception, match="not an alignment record"):
        readers.sam(spark, str(tmp_path / "z.sam")).collect()


def test_variant_lists(spark, tmp_path):
    lines = ["ID\tChr\tPosition\tSNP value\tRef/SNP", "7\tchr5\t48794752\t1\tC/T", "8\tchr5\t10\t-1\ta/g", "9\tchr5\t11\t1\tAC/T", "10\tchr5\t12\t1\tA/C/G", "", "11\tchr6"]
    (tmp_path / "x.txt").write_text("\n".join(lines) + "\n")
    got = sorted(map(tuple, readers.snp_list(spark, str(tmp_path / "x.txt")).where("snp_pos >= 0 and chrom = 'chr5'").collect()))
    assert got == [("chr5", 9, "A", "G"), ("chr5", 48794751, "C", "T")]
    (tmp_path / "y.txt").write_text("1\tchr5\tmany\t1\tC/T\n")
    with pytest.raises(Exception, match="many"):
        readers.snp_list(spark, str(tmp_path / "y.txt")).collect()
