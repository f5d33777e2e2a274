"""A uniform shuffle of rows into shards of equal row counts, in two passes.

Pass one scatters rows uniformly into buckets that fit in memory: a row's bucket is the leading part of a seeded hash of its number, so that copies of a
row, of an id or of a text spread like others. Pass two reads each bucket whole, shuffles it (Fisher-Yates, with a generator seeded by seed and bucket) and
writes it. Buckets in order, each in its shuffled order, are a uniformly random order of all rows; shards are its consecutive slices, so their row
counts differ by one at most (law `rows`). Before the passes, rows and bytes are counted by hash slots, at most 2**SLOT_BITS numbers, from which the number of buckets and
each bucket's first place follow. Texts are shuffled once and written once.

A row's number is its place in the scan, so docs must give the same rows in the same order when it is read again, as a table in files does; other rows are saved first
(saved). The result depends on the seed and on how the files are split, not on the run: a task that is repeated sorts its bucket by the hash before it shuffles it.
A bucket whose rows aren't those that were counted fails the job.

Null texts have no bytes; empty and very long texts are rows like others (a bucket holds at least one row, however long). Null ids, ties and repeated rows stay, each with
a place of its own. An empty table gives no rows. Further columns are kept in the files under their names, whatever those are: a row is kept as one struct.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewise.sources.shared import new_dir

SHARDS, SEED = 16, 20_240_229
#: Texts of about so many bytes are one bucket, more where 2**SLOT_BITS buckets wouldn't hold all: 100 TB are buckets of 400 MB.
BUCKET_BYTES = 8 << 20
SLOT_BITS = 18


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """The numbers below n in an order that seed and bucket decide, each order as likely."""
    order, draw = np.arange(n), np.random.Generator(np.random.PCG64([seed, bucket]))
    for i, j in zip(range(n - 1, 0, -1), draw.integers(0, np.arange(n, 1, -1)), strict=True):
        order[i], order[j] = order[j], order[i]
    return order


def _shuffle_buckets(seed: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition, sorted by bucket: each bucket in its shuffled order, with each row's place in the bucket."""

    def shuffled(bucket: int, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts).combine_chunks()
        wanted = table.column("rows")[0].as_py()
        if wanted != table.num_rows:
            raise ValueError(f"bucket {bucket} has {table.num_rows} rows and {wanted} were counted: the rows aren't the same when they are read again")
        order = fisher_yates(table.num_rows, seed, bucket)
        at = 0
        for start in range(0, len(order), 512):
            for part in table.take(pa.array(order[start : start + 512])).to_batches():
                place = pa.array(np.arange(at, at + part.num_rows), pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("bucket", "first", "row")), place], ["bucket", "first", "row", "place"])
                at += part.num_rows

    now, held = None, []
    for batch in batches:
        buckets = batch.column("bucket").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1), len(buckets)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a and buckets[a] != now:
                if held:
                    yield from shuffled(now, held)
                now, held = int(buckets[a]), []
            if b > a:
                held.append(batch.slice(a, b - a))
    if held:
        yield from shuffled(now, held)


def shuffled_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, text_col: str = "text") -> DataFrame:
    """row (a struct of all columns), shard and slot (from 0, gapless in each shard) of every row of docs."""
    size = F.octet_length(F.coalesce(docs[text_col], F.lit(""))).cast("long") + 1
    hashed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), size.alias("size"), F.xxhash64(F.lit(seed), F.monotonically_increasing_id()).alias("h"))
    slot = lambda bits: F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")

    slots = hashed.groupBy(slot(SLOT_BITS).alias("slot")).agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")).persist()
    try:
        total, weight = slots.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
        bits = min(SLOT_BITS, max(0, int(np.ceil(np.log2(max(1, weight) / bucket_bytes)))))
        counts = slots.groupBy(F.shiftright("slot", SLOT_BITS - bits).alias("bucket")).agg(F.sum("rows").alias("rows"))
        counts = [(r.bucket, r.rows) for r in counts.orderBy("bucket").collect()]  # a row for each bucket, at most 2**SLOT_BITS
    finally:
        slots.unpersist()
    first = np.cumsum([0, *(n for _, n in counts)])
    known = docs.sparkSession.createDataFrame([(b, n, int(at)) for (b, n), at in zip(counts, first, strict=False)], "bucket long, rows long, first long")

    scattered = hashed.select("row", "h", slot(bits).alias("bucket")).join(F.broadcast(known), "bucket")  # at most 2**SLOT_BITS rows
    scattered = scattered.repartitionById(1 << bits, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "h").select("bucket", "rows", "first", "row")
    schema = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("first", T.LongType()), scattered.schema["row"], T.StructField("place", T.LongType())])
    placed = scattered.mapInArrow(partial(_shuffle_buckets, seed), schema)

    total = max(1, total)
    at = F.col("first") + F.col("place")
    shard = F.expr(f"({shards} * (first + place)) div {total}")
    return placed.select("row", shard.cast("int").alias("shard"), (at - F.expr(f"({total} * (({shards} * (first + place)) div {total}) + {shards - 1}) div {shards}")).alias("slot"))


def write_shards(docs: DataFrame, path: str, **how) -> None:
    """A folder for each shard (shard=0 ...) with its rows (row, slot) in the order of their slots, over as many files as buckets reach into it."""
    shuffled_rows(docs, **how).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def read_shards(docs: DataFrame, path: str) -> DataFrame:
    """What write_shards wrote of rows like those of docs: row, slot, shard."""
    row = T.StructField("row", T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema]))
    return docs.sparkSession.read.schema(T.StructType([row, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])).parquet(path)


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the shards into the shared folder and describes each row that is read back: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    path = new_dir(docs.sparkSession, "shards")
    write_shards(docs, path, shards=shards, seed=seed, text_col=text_col)
    text = F.coalesce(F.col("row").getField(text_col), F.lit(""))
    return read_shards(docs, path).select(
        F.col("row").getField(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
