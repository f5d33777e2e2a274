"""Best-fit packing by patterns.

Documents become token pieces of at most CAPACITY tokens in one pass of tasks; only ids' checksums and lengths
leave it. The lengths make a histogram of at most CAPACITY bins, whatever the input's size, and the plan is made
from that alone: all patterns of two or three documents that fill a sequence exactly are enumerated, their repeat counts
are fitted to the histogram by non-negative least squares and rounded down; what is left over is fitted again, until rounding leaves nothing
to use, and then packed best-fit decreasing, by counts. Each piece then finds its place from its length and its rank among pieces of its length.
Ranks come from windows over (length, salt), so that a length that a third of all pieces share is dealt out, at any size.

Null texts are empty: one piece that holds the end id alone. Repeated rows are packed like others. A null id stays
null. An empty table gives an empty result. Columns other than the two named are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewise.llm.common import clean_columns, saved

CAPACITY, END_ID = 1024, 2
#: Salts of a length at least, and pieces for each salt beyond those.
SALTS, SALT_ROWS = 64, 200_000
#: A fit ends when no repeat count moves by more than this share of it (or of one), and in any case after so many steps, which leaves more to the next fit.
SETTLED, MOST_STEPS = 1e-3, 2000
SPECIAL = "<|endoftext|>"


@cache
def byte_bpe(ranks_path: str, json_path: str) -> Callable[[str], list[int]]:
    """Text to ids. Both files hold one vocabulary; the ranks are read by the faster library, and the other one
    takes the texts that hold the special token's string, which it reads as that token."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cache
    def slow():
        # most tasks never need it, and it takes some 50 MB
        from tokenizers import Tokenizer

        return Tokenizer.from_file(json_path)

    def ids(text: str) -> list[int]:
        return slow().encode(text, add_special_tokens=False).ids if SPECIAL in text else fast.encode_ordinary(text)

    return ids


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of n tokens: all but the first are full."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, paths: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: one row for each piece of each row's tokens."""
    named = clean_columns(docs, doc_id=id_col, text=text_col)
    id_type = named.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = byte_bpe(*(paths or default_paths()))
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column("text")):
                ids = np.asarray(ids_of(text.as_py() or "") + [END_ID], dtype="<u4")
                for k, (start, n) in enumerate(cut(len(ids), capacity)):
                    at.append(i)
                    rows.append((k, start, n, zlib.crc32(ids[start : start + n].tobytes())))
            if rows:
                own = [pa.array(x, pa.int32() if j == 0 else pa.int64()) for j, x in enumerate(zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at)), *own], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return named.mapInArrow(encode, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


def enumerate_patterns(histogram: np.ndarray) -> np.ndarray:
    """All pairs and triples of lengths that occur and fill a sequence exactly; zeros pad the pairs. At the usual capacity they are some 87,000 at most."""
    capacity = len(histogram) - 1
    lengths = np.flatnonzero(histogram[1:capacity]) + 1
    here = histogram > 0
    found = [np.stack([a := lengths[(2 * lengths <= capacity) & here[capacity - lengths]], capacity - a, 0 * a], 1)]
    for a in lengths[lengths * 3 <= capacity]:
        b = lengths[(lengths >= a) & (a + 2 * lengths <= capacity)]
        b = b[here[capacity - a - b]]
        found.append(np.stack([np.full_like(b, a), b, capacity - a - b], 1))
    return np.concatenate(found)


def fit_repeats(patterns: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 that lessen |A x - histogram|^2, column j of A being pattern j's lengths.

    Accelerated projected gradient: each count's step is as long as the patterns that share its lengths allow.
    """
    x = np.zeros(len(patterns))
    if not len(patterns):
        return x
    n, wanted = len(histogram), histogram.astype(float)
    wanted[0] = 0
    three = patterns[:, 2] > 0
    uses = np.bincount(patterns.ravel(), minlength=n).astype(float)
    uses[0] = 0
    bound = uses[patterns].sum(1)
    ahead, t = x, 1.0
    for _ in range(MOST_STEPS):
        held = sum((np.bincount(patterns[:, k], ahead, n) for k in (0, 1)), np.bincount(patterns[three, 2], ahead[three], n))
        left = wanted - held
        left[0] = 0
        new = np.maximum(0, ahead + left[patterns].sum(1) / bound)
        further = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / further * (new - x)
        moved = np.abs(new - x).max(initial=0.0) / max(1.0, new.max(initial=0.0))
        x, t = new, further
        if moved < SETTLED:
            break
    return x


def best_fit(counts: np.ndarray) -> dict[tuple[int, ...], int]:
    """Best-fit decreasing over counts of lengths: pattern to repeats. Its work depends on the number of lengths, not of pieces."""
    capacity = len(counts) - 1
    left: list[dict[tuple[int, ...], int]] = [{} for _ in range(capacity + 1)]
    for n in range(capacity, 0, -1):
        todo, room = int(counts[n]), n
        while todo:
            while room <= capacity and not left[room]:
                room += 1
            if room > capacity:
                each = capacity // n
                for k, bins in ((each, todo // each), (todo % each, 1)):
                    if k and bins:
                        key = (n,) * k
                        left[capacity - n * k][key] = left[capacity - n * k].get(key, 0) + bins
                break
            pattern, bins = left[room].popitem()
            used = min(bins, todo)
            if bins > used:
                left[room][pattern] = bins - used
            key = (*pattern, n)
            left[room - n][key] = left[room - n].get(key, 0) + used
            todo -= used
            room = n
    return {p: k for group in left for p, k in group.items()}


def use(patterns: np.ndarray, repeats: np.ndarray, rest: np.ndarray, used: dict[tuple[int, ...], int]) -> int:
    """Takes the repeats, rounded down, off the rest as far as the lengths last, and adds them to what is used; returns how many."""
    whole, taken = np.floor(repeats + 1e-9).astype(np.int64), 0
    for j in np.lexsort((-patterns.max(1, initial=0), -whole)):
        if whole[j] <= 0:
            break
        key = tuple(sorted((int(v) for v in patterns[j] if v), reverse=True))
        if k := min(int(whole[j]), *(int(rest[v]) // key.count(v) for v in key)):
            used[key] = used.get(key, 0) + k
            taken += k
            for v in key:
                rest[v] -= k
    return taken


def fitted_plan(histogram: np.ndarray) -> dict[tuple[int, ...], int]:
    """Patterns and how often each is used: fits of what is left over, until rounding down leaves nothing to use, and best-fit for the rest."""
    rest = histogram.astype(np.int64).copy()
    rest[0] = 0
    used: dict[tuple[int, ...], int] = {}
    while len(patterns := enumerate_patterns(rest)):
        if not use(patterns, fit_repeats(patterns, rest), rest, used):
            break
    for key, k in best_fit(rest).items():
        used[key] = used.get(key, 0) + k
    return used


def plan(histogram: np.ndarray) -> dict[tuple[int, ...], int]:
    """Patterns (lengths) and how often each is used; together they hold the histogram exactly.

    Best-fit alone is worked out too, from the same counts, and taken in the rare case that it needs fewer sequences.
    """
    rest = histogram.astype(np.int64).copy()
    rest[0] = 0
    return min(fitted_plan(histogram), best_fit(rest), key=lambda used: sum(used.values()))


def places(used: dict[tuple[int, ...], int]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, offset) in the order of ranks."""
    rows: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for key in sorted(used):
        offset = 0
        for n in key:
            rows.setdefault(n, []).append((taken.get(n, 0), sequence, offset))
            taken[n] = taken.get(n, 0) + used[key]
            offset += n
        sequence += used[key]
    return {n: np.array(r, dtype=np.int64) for n, r in rows.items()}


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, paths: tuple[str, str] | None = None) -> DataFrame:
    """Each piece with its sequence_id and its offset there."""
    made = saved(pieces(docs, id_col, text_col, capacity, paths), "pack-pieces")
    salts = max(SALTS, -(-made.count() // SALT_ROWS))
    salted = made.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = saved(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "pack-counts")

    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row for each length up to the capacity
        histogram[row.length] = row.n
    where = places(plan(histogram))

    before = F.sum("n").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select("length", "salt", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "start"))
    ranked = salted.withColumn("inside", inside).join(starts, ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("inside") - 1).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                rows = where[int(n)]
                r = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                sequence[at], offset[at] = r[:, 1] + rank[at] - r[:, 0], r[:, 2]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, made.schema.simpleString()[7:-1].replace(",", ", ").replace(":", " ") + ", sequence_id long, offset long")
