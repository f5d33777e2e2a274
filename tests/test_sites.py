import random

import pytest
from pyspark.sql import functions as F

from sitewise.operators import sites as S
from sitewise.operators import umis as U

GOLDEN = {-3: (10, 13), 10: (10, 0), 12: (10, 2), 15: (10, 5), 16: (20, 4), 25: (20, 5), 29: (30, 1), 99: (30, 69)}


def umis(spark, positions, chrom="c"):
    return spark.createDataFrame([(chrom, p) for p in positions], "chrom string, pos long")


def sites(spark, starts, chrom="c"):
    return spark.createDataFrame([(chrom, s) for s in starts], "chrom string, start long")


@pytest.mark.parametrize("width", [1 << 20, 7])
def test_nearest_golden(spark, width):
    got = S.nearest_site(umis(spark, list(GOLDEN)), sites(spark, [10, 20, 30]), width).collect()
    assert {r.pos: (r.rs_pos, r.d_rs) for r in got} == GOLDEN


@pytest.mark.parametrize("width", [1 << 20, 16])
def test_nearest_brute_force(spark, width):
    r = random.Random(1)
    at = {c: sorted(r.sample(range(500), n)) for c, n in (("a", 1), ("b", 9), ("c", 40))}
    rows = [(c, r.randrange(-50, 600)) for c in ("a", "b", "c", "none") for _ in range(120)]
    s = spark.createDataFrame([(c, x) for c, xs in at.items() for x in xs + xs[:1]], "chrom string, start long")
    got = S.nearest_site(spark.createDataFrame(rows, "chrom string, pos long"), s, width).collect()
    want = sorted((c, p, min(at[c], key=lambda x: (abs(x - p), x))) for c, p in rows if c in at)
    assert sorted((x.chrom, x.pos, x.rs_pos) for x in got) == want


def test_distance_limit(spark):
    got = S.nearest_site(umis(spark, [20, 21]), sites(spark, [0]))
    assert [r.pos for r in S.within_distance(got).collect()] == [20]
    assert [r.pos for r in S.orphans(got).collect()] == [21]


def test_empty_and_missing(spark):
    none = umis(spark, [])
    assert S.nearest_site(none, sites(spark, [1])).count() == 0
    assert S.nearest_site(umis(spark, [1]), sites(spark, [])).count() == 0
    assert [r.chrom for r in S.missing_chroms(umis(spark, [1]), sites(spark, [1], "d")).collect()] == ["c"]
    assert S.shared_chroms(umis(spark, [1, 2]), sites(spark, [1])).count() == 1


MERGES = [("p", [1], [1]), ("pp", [2], [1, 1]), ("ppp", [3], [2, 1]), ("ppq", [2, 1], [2, 1]), ("pqq", [1, 2], [1, 1, 1])]


@pytest.mark.parametrize("which,full,terminal", MERGES)
def test_merge_golden(spark, which, full, terminal):
    rows = [("c", {"p": 100, "q": 200}[x], i, [f"S{i}"], ["F"], 1) for i, x in enumerate(which)]
    df = spark.createDataFrame(rows, "chrom string, rs_pos long, pos long, seqs array<string>, quals array<string>, n long")
    sizes = lambda keep: sorted(r.n for r in U.merge_sites(df, keep).collect())
    assert sizes(False) == sorted(full)
    assert sizes(True) == sorted(terminal)
    merged = [s for r in sorted(U.merge_sites(df).collect(), key=lambda r: r.pos) for s in r.seqs]
    assert merged == [f"S{i}" for i in range(len(which))]


def test_dedup_golden(spark):
    df = spark.createDataFrame([("c", 1, ["B", "A", "B", "C", "b"])], "chrom string, pos long, seqs array<string>")
    r = U.dedup_umis(df).first()
    assert (r.seqs, r.pre_n, r.post_n) == (["B", "A", "C", "b"], 5, 4)
    s = U.dedup_stats(U.dedup_umis(df)).first()
    assert (s.n_reads, s.n_duplicates, s.n_umis) == (5, 1, 4)


def test_bed_numbers_rows_in_order(spark):
    rows = [("chr2", 5, 1), ("chr1", 100, 3), ("chr1", 9, 2), ("chr10", 7, 4)]
    got = U.bed5(spark.createDataFrame(rows, "chrom string, pos long, post_n long")).collect()
    assert sorted(map(tuple, got)) == [("chr1", 9, 9, "pos_1", 2), ("chr1", 100, 100, "pos_2", 3), ("chr10", 7, 7, "pos_3", 4), ("chr2", 5, 5, "pos_4", 1)]
    narrow = U.numbered(spark.createDataFrame(rows, "chrom string, pos long, post_n long"))
    assert [r.post_n for r in narrow.orderBy("number").collect()] == [2, 3, 4, 1]
    groups = U.row_groups(spark.createDataFrame(rows, "chrom string, pos long, post_n long"), 3).groupBy("row_group").agg(F.count("*").alias("n")).collect()
    assert {r.row_group: r.n for r in groups} == {1: 3, 2: 1}


def test_positions(spark):
    from sitewise.operators.alignments import with_site_position

    df = spark.createDataFrame([(104, 150, False), (60, 100, True)], "start_pos long, end_pos long, reverse_strand boolean")
    assert [r.pos for r in with_site_position(df).collect()] == [100, 100]


def test_shared_chroms_are_distinct_before_they_meet(spark):
    many = umis(spark, [1] * 50).unionByName(umis(spark, [1, 2], "a")).unionByName(umis(spark, [3], None))
    known = sites(spark, [1, 1, 2]).unionByName(sites(spark, [5], None)).unionByName(sites(spark, [5], "b"))
    shared = S.shared_chroms(many, known)
    assert {r.chrom for r in shared.collect()} == {"c", None} and shared.count() == 2
    plan = shared._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join") :].splitlines()
    assert sum("Aggregate [chrom" in line for line in join) == 2
