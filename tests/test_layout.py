import random

from pyspark.sql import functions as F

from sitewise.operators import histograms as H
from sitewise.operators import layout as T
from sitewise.operators import sites as S

ROWS = "name string, chrom string, start_pos long, end_pos long, reverse_strand boolean, mapq int, seq string"


def hot_rows(n=4000):
    """A third of all rows at one place; some without a chromosome, some that the clean filter leaves out."""
    r = random.Random(5)
    rows = []
    for i in range(n):
        start = 5_000 if i % 3 == 0 else r.randrange(0, 60_000)
        chrom = "chr1" if i % 3 == 0 else r.choice(["chr1", "chr2", "chrM", None])
        rows.append((f"r{i}", chrom, start, start + 30, r.random() < 0.3, r.choice([10, 30, 40]), r.choice("ACGT") * 4))
    return rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sites_meet_stored_rows_without_moving_them(spark, tmp_path):
    rows = spark.createDataFrame(hot_rows(), ROWS)
    sites = spark.createDataFrame([(c, x) for c in ("chr1", "chr2") for x in range(0, 60_000, 37)] + [("chr1", 4_990)], "chrom string, start long")
    table = T.store(rows, "laid_out_rows", f"file://{tmp_path}/t", "name", buckets=8, hot_rows=200)
    assert table.rows(spark).count() == rows.count()
    # the hot place is spread: no bucket holds a third of the rows
    hot = table.rows(spark).where("chrom = 'chr1' and start_pos = 5000").groupBy("salt").count().collect()
    assert len(hot) > 3 and max(x["count"] for x in hot) < 400
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = T.near_site_stored(spark, table, sites).select("name", "rs_pos", "d_rs")
        placed = T.with_site_position(rows.where("mapq >= 30 and chrom <> 'chrM'"))
        plain = S.near_site(placed, sites).select("name", "rs_pos", "d_rs")
        assert sorted(map(tuple, met.collect())) == sorted(map(tuple, plain.collect()))
        plan = plan_of(T.near_site_stored(spark, table, sites))
        scan = next(line for line in plan.splitlines() if "laid_out_rows" in line)
        assert "kept" in scan.split("PartitionFilters")[1].split("]")[0], scan
        # what is above the scan of the rows, up to the join, holds no exchange
        lines = plan.splitlines()
        at = next(i for i, line in enumerate(lines) if "laid_out_rows" in line)
        join = max(i for i, line in enumerate(lines[:at]) if "SortMergeJoin" in line)
        assert not any("Exchange" in line for line in lines[join:at]), plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    spark.sql("drop table laid_out_rows")


def test_region_reads_what_it_needs(spark, tmp_path):
    rows = spark.createDataFrame(hot_rows(1500), ROWS)
    table = T.store(rows, "region_rows", f"file://{tmp_path}/t", "name", buckets=4, hot_rows=100)
    for kept in (True, False):
        got = {r.name for r in T.region(spark, table, "chr1", 4_900, 5_100, kept).collect()}
        good = (F.col("mapq") >= 30) & (F.col("chrom") != "chrM")
        want = T.with_site_position(rows).where(F.coalesce(good, F.lit(False)) == kept).where("chrom = 'chr1' and pos >= 4900 and pos < 5100")
        assert got == {r.name for r in want.collect()} and got
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(T.region(spark, table, "chr1", 4_900, 5_100).select("name"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "kept" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(chrom,chr1)" in plan and "GreaterThanOrEqual(pos,4900)" in plan
    spark.sql("drop table region_rows")


def test_empty_alignments(spark, tmp_path):
    table = T.store(spark.createDataFrame([], ROWS), "empty_rows", f"file://{tmp_path}/t", "name", buckets=2)
    assert T.near_site_stored(spark, table, spark.createDataFrame([("chr1", 5)], "chrom string, start long")).collect() == []
    spark.sql("drop table empty_rows")


def test_merged_histograms_equal_the_whole(spark):
    r = random.Random(1)
    rows = [(r.choice("ab"), r.choice([None, *range(0, 40, 3), 10**12])) for _ in range(500)]
    df = spark.createDataFrame(rows, "library_id string, x long")
    parts = [H.histogram(df.where(F.col("library_id") == c), "x", "library_id") for c in "ab"]
    whole = H.histogram(df, "x")
    key = lambda t: sorted(map(tuple, t.collect()))
    assert key(H.merged(*parts)) == key(whole)
    got = H.spread(H.merged(*parts), quantiles={"p10": 0.1, "p99": 0.99}).first()
    values = sorted(v for _, v in rows if v is not None)
    want = df.agg(F.percentile("x", 0.1), F.percentile("x", 0.99)).first()
    assert (got.n, got.low, got.high) == (len(values), values[0], values[-1]) and got["mean"] == sum(values) / len(values)
    assert (got.p10, got.p99) == tuple(want)
    weighed = spark.createDataFrame([(7, 3), (9, 1)], "x long, k long")
    assert H.spread(H.histogram(weighed, "x", count="k")).first()["mean"] == 7.5
    assert H.spread(H.histogram(df.limit(0), "x"), "value").collect() == []
