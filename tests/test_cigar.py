import random
import re

import pytest
from pyspark.sql import functions as F

from sitewise.functions.expressions import cigar_runs, query_place, reference_length
from sitewise.operators import allelic as L
from sitewise.operators import alignments as A
from sitewise.sources import readers


def plain(cigar, start):
    """Position of the reference to (kind, offset), run by run."""
    out, ref, query, aligned = {}, start, 0, False
    for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar or ""):
        n = int(n)
        if op == "S":
            first = ref if aligned else ref - n
            for i in range(n):
                out.setdefault(first + i, ("clipped", query + i))
        for i in range(n):
            if op in "M=X":
                out.setdefault(ref + i, ("base", query + i))
            elif op in "DN":
                out.setdefault(ref + i, ("deleted" if op == "D" else "skipped", None))
        ref += n if op in "MDN=X" else 0
        query += n if op in "MIS=X" else 0
        aligned |= op in "MDN=X"
    return out


def test_place_equals_a_plain_walk(spark):
    r = random.Random(4)
    inner = lambda: "".join(f"{r.randrange(1, 6)}{r.choice('MIDN=XP')}" for _ in range(r.randrange(1, 7)))
    cigars = [f"{r.choice(['', '3S', '2H', '1H4S'])}{inner()}{r.choice(['', '2S', '3S1H'])}" for _ in range(40)] + ["*", "", None, "5S", "300M"]
    rows = [(c, s, p) for c in cigars for s in (0, 17) for p in range(s - 6, s + 40, 1)]
    df = spark.createDataFrame(rows, "c string, s long, p long")
    got = df.select("c", "s", "p", query_place(cigar_runs(F.col("c")), F.col("s"), F.col("p")).alias("x")).collect()
    for x in got:
        assert tuple(x.x) == plain(x.c, x.s).get(x.p, ("outside", None)), x


def test_runs_and_lengths_agree(spark):
    df = spark.createDataFrame([("10M2I3D5N4S1=2X",), ("*",), (None,)], "c string")
    runs = [r[0] for r in df.select(cigar_runs(F.col("c"))).collect()]
    assert [(x.length, x.op) for x in runs[0]] == [(10, "M"), (2, "I"), (3, "D"), (5, "N"), (4, "S"), (1, "="), (2, "X")] and runs[1:] == [[], []]
    assert [r[0] for r in df.where("c is not null").select(reference_length(F.col("c"))).collect()] == [21, 0]


@pytest.mark.parametrize("bucket", [4, 64])
def test_alleles_from_alignment_records(spark, tmp_path, bucket):
    lines = ["r1\t0\tc\t11\t60\t3M2D3M\t*\t0\t0\tACGTAC\tIIIIII", "r2\t16\tc\t11\t60\t2S2M1I3M\t*\t0\t0\ttttaCGGG\tIIIIIIII", "r3\t0\tc\t11\t60\t8M\t*\t0\t0\t*\t*", "r4\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI"]
    (tmp_path / "x.sam").write_text("\n".join(lines) + "\n")
    records = readers.sam(spark, str(tmp_path / "x.sam"))
    reads = A.from_sam(records, "cigar").withColumnRenamed("qname", "read_id")
    snps = spark.createDataFrame([("c", p, a, b) for p, a, b in ((10, "A", "T"), (13, "G", "C"), (15, "T", "C"), (17, "C", "G"), (18, "C", "G"))], "chrom string, snp_pos long, ref string, alt string")
    got = {(r.read_id, r.snp_pos): (r.kind, r.base) for r in L.snp_bases(reads, snps, bucket).collect()}
    want = {("r1", 10): ("base", "A"), ("r1", 13): ("deleted", None), ("r1", 15): ("base", "T"), ("r1", 17): ("base", "C"), ("r2", 10): ("base", "T"), ("r2", 13): ("base", "G")}
    assert got == want | {("r3", p): ("base", None) for p in (10, 13, 15, 17)}
    classes = L.allele_class(L.snp_bases(reads, snps, bucket), reads=reads).collect()
    assert {r.read_id: r["class"] for r in classes} == {"r1": "genome1", "r2": "conflict", "r3": "unassignable", "r4": "unassignable"}
