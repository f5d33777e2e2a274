import random
import re

import pytest
from pyspark.sql import functions as F

from sitewise.jobs import queries as Q
from sitewise.operators import sites as S
from sitewise.operators import umis as U

GOLDEN = {-3: 13, 10: 0, 12: 2, 15: 5, 16: 4, 25: 5, 29: 1, 99: 69}


@pytest.mark.parametrize("distance,width", [(20, 1 << 20), (20, 50), (3, 16), (200, 128), (0, 64)])
def test_near_site_equals_brute_force(spark, distance, width, monkeypatch):
    monkeypatch.setattr(S, "site_cells", (lambda f: lambda s, d: f(s, d, width))(S.site_cells))
    r = random.Random(distance)
    at = {c: sorted(r.sample(range(-300, 700), n)) for c, n in (("a", 1), ("b", 9), ("c", 120))}
    rows = [(c, r.randrange(-400, 800)) for c in ("a", "b", "c", "none") for _ in range(150)] + [(None, 1), ("a", None)]
    sites = spark.createDataFrame([(c, x) for c, xs in at.items() for x in xs + xs[:3] + xs[:1]] + [(None, 5), ("b", None)], "chrom string, start long")
    umis = spark.createDataFrame(rows, "chrom string, pos long")
    want = []
    for c, p in rows:
        best = min(((abs(x - p), x) for x in at.get(c, []) if p is not None), default=None)
        want.append((c, p, *((best[1], best[0]) if best and best[0] <= distance else (None, None))))
    assert sorted(map(tuple, S.near_site(umis, sites, distance, "left").collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, S.near_site(umis, sites, distance).collect()), key=str) == sorted((x for x in want if x[2] is not None), key=str)


def test_golden_and_names_that_are_taken(spark):
    umis, sites = spark.createDataFrame([("c", p) for p in GOLDEN], "chrom string, pos long"), spark.createDataFrame([("c", s) for s in (10, 20, 30)], "chrom string, start long")
    assert {r.pos: r.d_rs for r in S.near_site(umis, sites).collect()} == {p: d for p, d in GOLDEN.items() if d <= 20}
    for f in (S.near_site, S.nearest_site):
        with pytest.raises(ValueError, match="rs_pos"):
            f(umis.withColumn("RS_pos", F.lit(1)), sites)


def test_counters_in_one_pass_equal_those_of_all_nearest_sites(spark):
    r = random.Random(8)
    rows = [(r.randrange(2), c, r.choice((100, r.randrange(600))), r.choice("ACGT")) for c in "abc" for _ in range(200)]
    umis = spark.createDataFrame(rows, "lib long, chrom string, pos long, seq string")
    sites = spark.createDataFrame([(c, s) for c in "ab" for s in range(0, 600, 70)], "chrom string, start long")
    columns = ["lib", "n_umis", "from_cs", "uniq"]
    want = S.site_counters(S.nearest_site(umis, sites), "lib").select(columns)
    assert sorted(map(tuple, S.near_counters(umis, sites, "lib").select(columns).collect())) == sorted(map(tuple, want.collect()))
    both = S.near_counters(umis, sites, "lib", x=F.col("seq") == "A", y=F.lit(True)).collect()
    assert all(b.x_all == sum(1 for q in rows if q[0] == b.lib and q[3] == "A") and b.y_all == sum(1 for q in rows if q[0] == b.lib) and b.x_uniq < b.y_uniq for b in both)


def test_site_lists_equal_grouping_and_merging(spark, sf_dir):
    from sitewise.jobs import fixtures as X

    umis, sites = X.ordered_umis(spark, sf_dir), X.event_sites(spark, sf_dir)
    for keep in (False, True):
        grouped = U.merge_sites(S.within_distance(S.nearest_site(U.group_umis(umis, "line_no"), sites)), keep)
        got = U.site_lists(S.near_site(umis, sites), "line_no", keep)
        assert sorted(map(tuple, got.select(grouped.columns).collect())) == sorted(map(tuple, grouped.collect()))


def test_numbers_over_many_ranges(spark):
    rows = [(f"chr{i % 3}", (i * 37) % 101, i % 2) for i in range(500)]
    got = U.numbered(spark.createDataFrame(rows, "chrom string, pos long, tie long").repartition(7), "tie").orderBy("number").collect()
    assert [tuple(r) for r in got] == [(*x, i + 1) for i, x in enumerate(sorted(rows))]
    assert U.numbered(spark.createDataFrame([], "chrom string, pos long")).count() == 0


def scans(df):
    """Scans of files in the plan; those of exchanges that are reused count once."""
    return len(re.findall(r"FileScan|Scan parquet", df._jdf.queryExecution().executedPlan().toString()))


@pytest.mark.parametrize("name,most", [("flagship_sites", 2), ("merge_same_site", 2), ("dedup_umis", 2), ("allele_class", 2), ("allelic_summary", 4), ("bed5", 1)])
def test_tables_are_read_once(spark, sf_dir, name, most):
    plan = Q.QUERIES[name](spark, sf_dir)
    assert scans(plan) <= most
    if name == "flagship_sites":
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") <= 6 and "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
