import random
import subprocess
import sys
from pathlib import Path

from sitewise.operators import reads as R
from sitewise.sources import readers, sinks

ASSIGNED = "chrom string, rs_pos long, d_rs long, seqs array<string>, quals array<string>, n long"


def test_both_sides_in_one_pass_with_its_counts(spark, tmp_path):
    rows = [("c", 10, 3, ["A", "C"], ['"I', "\\"], 2), ("c", 10, 20, ["G"], ["I"], 1), ("d", 7, 21, ["T"] * 3, ["I"] * 3, 3)]
    counts = sinks.clean_and_orphans(spark.createDataFrame(rows, ASSIGNED), str(tmp_path / "x"), 20)
    assert counts == {"n_locations": 3, "n_umis": 6, "kept_locations": 2, "from_cs": 3}
    assert sorted(p.name for p in (tmp_path / "x").glob("side=*")) == ["side=clean", "side=orphan"]
    got = sorted((r.side, r.chrom, r.pos, r.seqs, r.quals, r.n) for r in readers.sides(spark, str(tmp_path / "x")).collect())
    assert got == sorted(("clean" if d <= 20 else "orphan", c, p, s, q, n) for c, p, d, s, q, n in rows)
    one = spark.createDataFrame(rows[:2], ASSIGNED)
    sinks.clean_and_orphans(one, str(tmp_path / "y"), 20)
    assert {r.side for r in readers.sides(spark, str(tmp_path / "y")).collect()} == {"clean"}
    assert sinks.clean_and_orphans(one.limit(0), str(tmp_path / "z"), 20) == {"n_locations": 0, "n_umis": 0, "kept_locations": 0, "from_cs": 0}


def test_a_step_that_is_repeated_counts_once(spark, tmp_path):
    table = lambda *rows: spark.createDataFrame(rows, "library_id string, metric string, value long")
    path = str(tmp_path / "c")
    sinks.run_counters(table(("a", "n", 1), ("b", "n", 2)), path, "r1", "assign")
    sinks.run_counters(table(("a", "n", 5)), path, "r1", "assign")
    sinks.run_counters(table(("a", "m", 9)), path, "r1", "dedup")
    sinks.run_counters(table(("a", "n", 7)), path, "r2", "assign")
    got = sorted((r.run, r.library_id, r.step, r.metric, r.value) for r in spark.read.parquet(path).collect())
    assert got == [("r1", "a", "assign", "n", 5), ("r1", "a", "dedup", "m", 9), ("r1", "b", "assign", "n", 2), ("r2", "a", "assign", "n", 7)]


def test_barcodes_equal_brute_force(spark):
    r = random.Random(3)
    code = lambda n: "".join(r.choices("AC", k=n))
    known = [code(6) for _ in range(9)] + [code(4), "ACGTACGT"]
    reads = [(i, code(r.choice((4, 6)))) for i in range(150)] + [(900, None), (901, ""), (902, "ACGTACGT"), (903, "ACGTACGG"), (904, "ACGTACG"), (905, "AC*TACGT")]
    want = {}
    for i, bc in reads:
        near = {k for k in known if bc and len(k) == len(bc) and sum(a != b for a, b in zip(k, bc, strict=True)) <= 1}
        kind = "exact" if bc in near else {0: "none", 1: "near"}.get(len(near), "ambiguous")
        want[i] = (bc if kind == "exact" else next(iter(near)) if kind == "near" else None, kind)
    out = R.match_barcodes(spark.createDataFrame(reads, "read_id long, bc string"), spark.createDataFrame([(k,) for k in [*known, known[0], None]], "barcode string"))
    assert {x.read_id: (x.barcode, x.match) for x in out.collect()} == want and out.count() == len(reads)
    assert "CartesianProduct" not in (plan := out._jdf.queryExecution().executedPlan().toString()) and "NestedLoop" not in plan


def test_the_package_can_be_shipped(tmp_path):
    """A program elsewhere, whose workers only have the archive."""
    root = Path(__file__).resolve().parents[1]
    (tmp_path / "a_S1.fastq").write_text("@n\nAC\n+\nII\n" * 50)
    program = f"""
import os, sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
sys.path.insert(0, {str(root)!r})
from sitewise.shipping import ship
from sitewise.sources import readers
ship(spark)
sys.path.remove({str(root)!r})
print("reads", readers.fastq(spark, {str(tmp_path / "a_S1.fastq")!r}, 100).count())
"""
    out = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert "reads 50" in out.stdout, out.stderr[-1500:]
