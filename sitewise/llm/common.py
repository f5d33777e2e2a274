"""What the operators share: saved tables, samples by hash, bounded key bitmaps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.sources.shared import new_dir

#: The white space and the words that every text operator uses.
SPACE = r"[\x20\x09-\x0D]+"
WORD = rb"[^\x20\x09-\x0D]+"

#: A key bitmap has 2**BITMAP_BITS bits in pieces of 2**15: 512 rows of 4 KB, however many keys it holds.
BITMAP_BITS = 24
_PIECE_BITS = 15
#: Bytes of a batch for Python while a table is saved.
BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Leading bits of hashes that are counted at a time.
_SLOT_BITS = 16


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes df into the shared folder and reads it back: lineage ends there, and a lost executor costs no recomputation.

    While it is written, batches for Python have at most BATCH_BYTES, since rows may hold long texts or whole sets.
    """
    spark, path = df.sparkSession, new_dir(df.sparkSession, name)
    usual = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(min(BATCH_BYTES, int(usual.rstrip("b")))) if usual.rstrip("b").isdigit() else str(BATCH_BYTES))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, usual)
    return spark.read.schema(df.schema).parquet(path)


def deleted(table: DataFrame) -> None:
    """Deletes the folder of a saved table that nothing reads any more, so that rounds don't fill the shared folder."""
    context = table.sparkSession.sparkContext
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what a task makes of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def clean_columns(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under our own names, so that no extra column can clash."""
    return df.select(*(df[source].alias(name) for name, source in columns.items()))


def normal_space(text: Column) -> Column:
    """Null as empty; each run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def least_hashes(df: DataFrame, hashed: str, limit: int) -> Column:
    """A condition that at most limit rows of df meet, those with the least values of the column hashed, 64-bit hashes.

    Only counts of hashes by their leading bits are gathered: 2**_SLOT_BITS numbers at a time, whatever the input. Where the rows of one slot
    are too many, its next bits are counted. Rows of equal hashes are taken or left together.
    """
    taken, shift, chosen = 0, 64 - _SLOT_BITS, F.lit(False)
    here = F.lit(True)
    while shift >= 0:
        slot = F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
        counts = sorted(tuple(r) for r in df.where(here).groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect())
        for k, n in counts:
            if taken + n > limit:
                chosen, here = chosen | (here & (slot < k)), here & (slot == k)
                break
            taken += n
        else:
            return chosen | here
        if taken >= limit * 0.9:
            break
        shift -= _SLOT_BITS
    return chosen


def distinct_sample(df: DataFrame, column: str, limit: int) -> list[str]:
    """At most limit distinct texts of a column, those with the least hashes: a group of copies is one text. No text is moved before the choice."""
    hashed = df.where(F.col(column).isNotNull()).select(F.xxhash64(column).alias("h"), F.col(column).alias("text"))
    chosen = least_hashes(saved(hashed.select("h").distinct(), "sample"), "h", limit)
    texts = hashed.where(chosen).groupBy("h").agg(F.min("text").alias("text"))
    return [r.text for r in texts.orderBy("h").collect()]  # at most limit


def key_bitmap(keys: DataFrame, slot: Column) -> DataFrame:
    """One row for each 2**15 slots that occur in keys: at most 512 rows of 4 KB, a proven bound for a broadcast."""
    slot = F.pmod(slot, F.lit(1 << BITMAP_BITS))
    return (
        keys.select(slot.alias("s"))
        .groupBy(F.shiftright("s", _PIECE_BITS).alias("bitmap_piece"))
        .agg(F.bitmap_construct_agg(F.pmod("s", F.lit(1 << _PIECE_BITS))).alias("bitmap_bits"))
    )


def with_maybe(df: DataFrame, slot: Column, bitmap: DataFrame, name: str = "maybe") -> DataFrame:
    """Adds whether a row's key may be among those of the bitmap: no false negatives, and no shuffle of df."""
    s = F.pmod(slot, F.lit(1 << BITMAP_BITS))
    rest = F.pmod(s, F.lit(1 << _PIECE_BITS))
    out = df.withColumn("bitmap_piece", F.shiftright(s, _PIECE_BITS)).join(F.broadcast(bitmap), "bitmap_piece", "left")
    byte = F.conv(F.hex(F.substring("bitmap_bits", (F.shiftright(rest, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    hit = F.getbit(byte, F.pmod(rest, F.lit(8)).cast("int")) == 1
    return out.withColumn(name, F.coalesce(hit, F.lit(False))).drop("bitmap_piece", "bitmap_bits")
