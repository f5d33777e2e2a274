from pyspark.sql import functions as F

from sitewise.jobs.preprocess import genome_near


def test_genomes_near_sites_from_one_pass(spark):
    """Repeated rows are one; a read that is aligned twice has one class; only reads near a site stay; reads are scanned once."""
    reads = [
        ("a", "c", 100, 110, False, "CCC"), ("a", "c", 100, 110, False, "CCC"),  # genome1, repeated
        ("b", "c", 100, 110, True, "GGG"), ("b", "c", 300, 310, False, "GGG"),  # genome2 by its first place; both places count
        ("d", "c", 100, 110, False, "TTT"), ("e", "c", 700, 710, False, "CCC"), ("f", "none", 100, 110, False, "CCC"), ("g", None, None, None, None, "CCC"),
    ]
    reads = spark.createDataFrame(reads, "read_id string, chrom string, start_pos long, end_pos long, reverse_strand boolean, seq string")
    snps = spark.createDataFrame([("c", 105, "C", "G"), ("c", 705, "C", "G"), ("none", 105, "C", "G")], "chrom string, snp_pos long, ref string, alt string")
    sites = spark.createDataFrame([("c", 98), ("c", 300)], "chrom string, start long")
    near = genome_near(reads, snps, F.substring("seq", 1, 1), sites)
    got = sorted((r.genome, r.pos, r.seq, r.rs_pos, r.d_rs) for r in near.collect())
    one = [("g1", 96, "CCC", 98, 2), ("g2", 110, "GGG", 98, 12), ("g2", 296, "GGG", 300, 4)]
    assert got == sorted(one + [("m", *x[1:]) for x in one])
    assert near._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD [read_id") + near._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation [read_id") == 1
