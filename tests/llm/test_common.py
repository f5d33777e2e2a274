import random

from pyspark.sql import functions as F

from sitewise.llm.common import key_bitmap, least_hashes, with_maybe
from sitewise.llm.graph import components
from tests.llm import brute


def test_bitmap_never_misses(spark):
    keys = spark.range(0, 30_000, 3).withColumnRenamed("id", "k")
    bitmap = key_bitmap(keys, F.xxhash64("k"))
    assert bitmap.count() <= 512
    got = with_maybe(spark.range(30_000).withColumnRenamed("id", "k"), F.xxhash64("k"), bitmap)
    assert got.columns == ["k", "maybe"]
    assert got.where("k % 3 = 0 and not maybe").count() == 0
    assert got.where("k % 3 <> 0 and maybe").count() < 60
    none = with_maybe(keys, F.xxhash64("k"), key_bitmap(keys.limit(0), F.xxhash64("k")))
    assert none.where("maybe").count() == 0


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(80)] + [(5, 5)]
    r.shuffle(edges)
    got = {x.vertex: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = {i for a, b in edges if a != b for i in (a, b)}
    assert got == brute.reach(ids, [(a, b) for a, b in edges if a != b])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_least_hashes_takes_the_least(spark):
    r = random.Random(3)
    for values in ([r.randrange(-(1 << 63), 1 << 63) for _ in range(500)], [r.randrange(40) for _ in range(500)], [7] * 20, []):
        df = spark.createDataFrame([(v,) for v in values], "h long")
        for limit in (0, 10, 60, 499, 1000):
            got = [x.h for x in df.where(least_hashes(df, "h", limit)).collect()]
            unsigned = sorted((v % (1 << 64) for v in values))
            assert len(got) <= limit and sorted(v % (1 << 64) for v in got) == unsigned[: len(got)]
            if len(set(values)) == len(values) and values:
                assert len(got) >= 0.9 * min(limit, len(values))
