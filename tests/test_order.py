from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sitewise.jobs import fixtures as X
from sitewise.operators import alignments as A
from sitewise.operators import sites as S
from sitewise.operators import umis as U
from sitewise.sources import readers, sinks


@pytest.mark.parametrize("limit", [10, 64, 1 << 20])
def test_pieces_of_a_hot_locus_are_bounded_and_together_the_lists(spark, sf_dir, limit):
    rows = X.hot_umis(spark, sf_dir)
    whole = {(r.chrom, r.pos): r for r in U.group_umis(rows, "line_no").collect()}
    assert max(r.n for r in whole.values()) > 300
    pieces = defaultdict(list)
    for r in U.list_chunks(rows, "line_no", limit=limit).orderBy("chunk").collect():
        assert r.n == len(r.seqs) <= limit
        pieces[r.chrom, r.pos].append(r)
    assert {k: (sum((r.seqs for r in v), []), sum((r.quals for r in v), [])) for k, v in pieces.items()} == {k: (r.seqs, r.quals) for k, r in whole.items()}
    assert all(len(pieces[k]) == 1 for k, r in whole.items() if r.n <= limit)
    distinct = defaultdict(list)
    for r in U.dedup_chunks(rows, "line_no", limit=limit).orderBy("chunk").collect():
        assert r.post_n == len(r.seqs) <= limit
        distinct[r.chrom, r.pos].append(r)
    want = {(r.chrom, r.pos): r for r in U.dedup_umis(U.group_umis(rows, "line_no")).collect()}
    assert {k: (sum((r.seqs for r in v), []), sum(r.pre_n for r in v), sum(r.post_n for r in v)) for k, v in distinct.items()} == {k: (r.seqs, r.pre_n, r.post_n) for k, r in want.items()}


def test_pieces_of_sites_keep_the_order_of_positions(spark):
    rows = [("c", 100 + (i * 7) % 5, i, f"S{i % 40}", "I") for i in range(300)] + [(None, 1, 900, "N", "I")]
    umis, sites = spark.createDataFrame(rows, "chrom string, pos long, line_no long, seq string, qual string"), spark.createDataFrame([("c", 102)], "chrom string, start long")
    near = S.near_site(umis, sites)
    want = U.site_lists(near, "line_no").first()
    got = U.list_chunks(near, "line_no", ("chrom", "rs_pos"), "pos", limit=20).orderBy("chunk_pos", "chunk").collect()
    assert max(r.n for r in got) <= 20 and sum((r.seqs for r in got), []) == want.seqs
    got = U.dedup_chunks(near, "line_no", ("chrom", "rs_pos"), "pos", limit=20).orderBy("chunk_pos", "chunk").collect()
    assert sum((r.seqs for r in got), []) == list(dict.fromkeys(want.seqs)) and sum(r.pre_n for r in got) == 300
    assert [tuple(r) for r in U.list_chunks(umis.where("chrom is null"), "line_no", limit=20).collect()] == [(None, 1, 0, ["N"], ["I"], 1)]


def references(spark, *names):
    return spark.createDataFrame([(c, i, 1000) for i, c in enumerate(names)], "chrom string, index long, length long")


def alignments(spark, rows):
    return spark.createDataFrame([(f"r{i}", c, p, p + 4, 40, "ACGT", "IIII", c == "*", False, False, False) for i, (c, p) in enumerate(rows)],
        "qname string, chrom string, start_pos long, end_pos long, mapq int, seq string, qual string, unmapped boolean, secondary boolean, reverse_strand boolean, chimeric boolean")


def test_header_order_and_round_trip(spark, tmp_path):
    known = references(spark, "chr1", "chr2", "chr10", "chrM")
    rows = [(f"chr{c}", (i * 37) % 101) for i, c in enumerate(["10", "2", "M", "1"] * 30)] + [("*", -1), ("chrUn", 3)]
    order = {"chr1": 0, "chr2": 1, "chr10": 2, "chrM": 3}
    want = sorted(rows, key=lambda x: (order.get(x[0], 9), x[1]))
    got = A.coordinate_sorted(alignments(spark, rows), known).collect()
    assert [(r.chrom, r.start_pos) for r in got] == want
    sinks.sam(alignments(spark, rows), str(tmp_path / "a"), known)
    lines = [x for p in sorted((tmp_path / "a").glob("part*")) for x in p.read_text().splitlines()]
    assert lines[0].startswith("@HD") and [x.split("\t")[1] for x in lines[1:5]] == ["SN:chr1", "SN:chr2", "SN:chr10", "SN:chrM"]
    assert [(x.split("\t")[2], int(x.split("\t")[3]) - 1) for x in lines[5:]] == want
    assert sorted(map(tuple, readers.sam_references(spark, str(tmp_path / "a")).collect())) == sorted(map(tuple, known.collect()))
    back = A.from_sam(readers.sam(spark, str(tmp_path / "a")))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, alignments(spark, rows).select(back.columns).collect()))


def test_headers_that_differ_fail(spark, tmp_path):
    (tmp_path / "a.sam").write_text("@SQ\tSN:c1\tLN:5\n@SQ\tSN:c2\tLN:6\n")
    (tmp_path / "b.sam").write_text("@SQ\tSN:c2\tLN:6\n@SQ\tSN:c1\tLN:5\n")
    assert [tuple(r) for r in readers.sam_references(spark, str(tmp_path / "b.sam")).orderBy("index").collect()] == [("c2", 0, 6), ("c1", 1, 5)]
    with pytest.raises(Exception, match="headers differ about c"):
        readers.sam_references(spark, str(tmp_path / "*.sam")).collect()


def test_merged_tables_are_one_order(spark):
    known = references(spark, "chr2", "chr10")
    a, b = (alignments(spark, [(c, p + k) for c in ("chr10", "chr2") for p in range(0, 40, 4)]) for k in (0, 2))
    got = [(r.chrom, r.start_pos) for r in A.merged(known, a, b).collect()]
    assert got == [(c, p) for c in ("chr2", "chr10") for p in range(0, 40, 2)]
    assert A.with_reference_index(a.withColumn("chrom", F.lit(None).cast("string")), known).where("index is not null").count() == 0
