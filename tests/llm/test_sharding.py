import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sitewise.llm import sharding as S


def check(rows, got):
    """Every row once, described rightly; counts of shards at most one apart; slots gapless."""
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts[s] for s in range(16)) <= 1
    for s in range(16):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def test_given_table_over_many_buckets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = S.sharded(docs).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], got)
    place = lambda rows: {r.doc_id: (r.shard, r.slot) for r in rows}
    assert place(got) == place(S.sharded(docs).collect()) != place(S.sharded(docs, seed=5).collect())


def test_nulls_repeats_hot_ids_and_clashing_columns(spark):
    rows = [(7, "same")] * 60 + [(i, "é" * i) for i in range(90)] + [(None, None), (None, ""), (8, "long " * 100_000)]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, shard int, row int, bucket int").repartition(3)
    docs.write.parquet(path := S.new_dir(spark, "rows"))
    docs = spark.read.parquet(path)
    check(rows, S.sharded(docs).collect())
    out = S.shuffled_rows(docs, bucket_bytes=2_000)
    assert sorted(r.row.doc_id or -1 for r in out.collect()) == sorted(i or -1 for i, _ in rows)
    assert out.select("row.*").columns == docs.columns


def test_empty_table(spark, sf_dir):
    assert S.sharded(spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)).count() == 0


def test_files_hold_whole_rows_in_the_order_of_slots(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    S.write_shards(docs, path := S.new_dir(spark, "shards"), bucket_bytes=20_000)
    for s in (0, 15):
        one = spark.read.parquet(f"{path}/shard={s}")
        files = {}
        for r in one.selectExpr("_metadata.file_name as f", "slot", "row").collect():
            files.setdefault(r.f, []).append(r.slot)
        assert all(slots == sorted(slots) for slots in files.values())
    assert sorted(map(tuple, S.read_shards(docs, path).select("row.*").collect())) == sorted(map(tuple, docs.collect()))


def test_rows_that_changed_since_they_were_counted_fail():
    batch = pa.RecordBatch.from_pydict({"bucket": [4, 4], "rows": [3, 3], "first": [0, 0], "row": [{"a": 1}, {"a": 2}]})
    with pytest.raises(ValueError, match="bucket 4 has 2 rows and 3 were counted"):
        list(S._shuffle_buckets(1, iter([batch])))


def test_each_order_is_as_likely():
    seen = Counter(tuple(S.fisher_yates(4, 3, b)) for b in range(24_000))
    assert len(seen) == 24 and max(abs(n - 1000) for n in seen.values()) < 160
    assert sorted(S.fisher_yates(1, 0, 0)) == [0] and len(S.fisher_yates(0, 0, 0)) == 0
    assert (np.sort(S.fisher_yates(1000, 1, 2)) == np.arange(1000)).all()
