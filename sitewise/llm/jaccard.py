"""Similarity join of documents by the Jaccard overlap of their word shingles: a T-occurrence search with DivideSkip.

Every document is a query whose shingles are the keys of inverted lists. Lists are taken in one order for all
documents, rare ones first. To reach the overlap T, a document must be on at least T - L of a query's short
lists when L lists are left out as long ones; so short lists alone are merged, and the long ones are probed by binary
search, only for documents that came up often enough.

- One order: a sketch of 2**22 counters over all shingles of all documents says how long a list is, up to
  collisions. Any order gives the same result; a good one keeps very common passages among the long lists. The
  sketch has a fixed size, so it is broadcast whatever the input.
- Merging: postings of short lists meet by shingle, and the shuffle's sorted merge counts them for each pair of documents.
  That is the heap merge, spread over the cluster.
- Skipping: parity bits of both sets bound how far they differ; a pair that differs too far is never a row.
- Probing: a pair that reached T - L is decided by binary search of one sorted set in the other, exactly.

Documents with equal sets are one vertex, found before any list is made. What is asked for is components, not
pairs, so a list of m documents that resemble each other doesn't need all its pairs: rounds compare each list with
one leader, which costs as much as the list is long. Then only pairs of documents that are still in different
components are merged and probed. They meet on lists that can be the first common one of a pair that links, and not where they met on one of the last few before;
how many short lists both are on is then counted from the documents' own short lists, once for each pair. No pair that could join two components is left out.

A set has the distinct runs of WORDS words, as 64-bit hashes; with fewer words, the whole sequence; with none, it is empty
and links with nothing (its component is the document itself). Null texts are empty. Repeated rows are equal sets; an
id with several texts links where any of them does. A null id has its set size, no component, and links with
nothing. An empty table gives an empty result. Columns other than the two named are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewise.llm.common import clean_columns, deleted, key_bitmap, saved, slices, with_maybe
from sitewise.llm.graph import components
from sitewise.llm.shingles import WORDS, shingle_set

#: The similarity as a percentage of whole numbers, so that no rounding decides.
PERCENT = 80
#: The sketch: 2**22 counters in pieces of 2**16.
SKETCH_BITS, PIECE_BITS = 22, 16
#: Bits of the parities that bound from below how far two sets differ.
PARITY_BITS = 256
#: Leader rounds go on while the last step would have more than FEW_PAIRS pairs for each posting, each round settles at least this share of the
#: open lists' postings, and there were fewer than so many rounds. What they leave is done exactly by the last step, so no number changes the result.
FEW_PAIRS, WORTHWHILE, LEADER_ROUNDS = 1, 0.05, 8
#: Rounds ask for one part in so many of DivideSkip's bound: less makes fewer rows of common lists, and more pairs to probe. No number changes the result.
PART = 4
#: A pair doesn't meet on a list where both have a common one among so many of their open lists before it.
LOOK_BACK = 4


def _ceil_div(a, b: int):
    return (a + (b - 1)) // b


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[np.ndarray]:
    return (shingle_set(t.as_py(), words) for t in batch.column("text"))


def _first_pass(docs: DataFrame, words: int) -> DataFrame:
    """For each row its set's size and fingerprint (kind 0), and for each task pieces of its sketch (kind 1)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        names = ["doc_id", "n", "piece", "data"]
        for batch in slices(batches):
            sizes, prints = [], []
            for s in _sets(batch, words):
                sizes.append(len(s))
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                np.add.at(sketch, (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
            n = len(sizes)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.nulls(n, pa.int32()), pa.array(prints, pa.binary())], names)
        for k, part in enumerate(sketch.reshape(-1, 1 << PIECE_BITS)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names)

    return docs.mapInArrow(scan, "doc_id long, n long, piece int, data binary")


def _summed(parts: DataFrame) -> DataFrame:
    """Sums the sketch's pieces in two steps, so that no task gets the pieces of all tasks."""

    def add(key: tuple, parts: pa.Table) -> pa.Table:
        total = np.zeros(1 << PIECE_BITS, dtype=np.uint64)
        for data in parts["data"]:
            total += np.frombuffer(zlib.decompress(data.as_py()), dtype=np.uint32)
        total = np.minimum(total, np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()), "data": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    salted = parts.select("piece", "data", F.pmod(F.xxhash64("data"), F.lit(32)).alias("salt"))
    half = salted.groupBy("piece", "salt").applyInArrow(add, "piece int, data binary")
    return half.groupBy("piece").applyInArrow(add, "piece int, data binary")


def list_levels(parts: DataFrame) -> np.ndarray:
    """How long each list is, as a level (levels_of). 4 MB, always."""
    counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
    for row in _summed(parts).toLocalIterator():  # 64 rows
        counts[row.piece << PIECE_BITS : (row.piece + 1) << PIECE_BITS] = np.frombuffer(zlib.decompress(row.data), dtype=np.uint32)
    return levels_of(counts)


def levels_of(counts: np.ndarray) -> np.ndarray:
    """0 for counters that look like all others, one more for each doubling of what a counter has above their mean.

    Short lists fall on counters at random and spread them by the root of their mean; so the length from which a list is told from others grows
    with the root of the input, and pairs in lists that aren't told apart grow no faster than the input.
    """
    mean = counts.mean()
    return np.log2(np.maximum(1, (counts - mean) / (2 * np.sqrt(mean) + 4))).astype(np.uint8)


def parity(s: np.ndarray) -> np.ndarray:
    """For each of PARITY_BITS classes of shingles, whether the set has an odd number of them, as 64-bit words.

    Sets whose words differ in d bits have at least d shingles that are in one of them only.
    """
    odd = np.bincount(((s >> np.uint64(8)) % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _short_lists(docs: DataFrame, levels, words: int, percent: int) -> DataFrame:
    """doc_id, n, parity bits and the keys of the short lists of each row's set, in the common order; rows with empty sets are left out."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for batch in slices(batches):
            at, sizes, keys, parities = [], [], [], []
            for i, s in enumerate(_sets(batch, words)):
                if len(s):
                    order = np.lexsort((s, level[s >> np.uint64(64 - SKETCH_BITS)]))
                    at.append(i)
                    sizes.append(len(s))
                    parities.append(parity(s))
                    keys.append(s[order[: len(s) - _ceil_div(percent * len(s), 100) + 1]].view(np.int64))
            if at:
                offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys)))
                taken = [batch.column(c).take(pa.array(at)) for c in ("doc_id", "maybe")]
                bits = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * (PARITY_BITS // 64)), pa.array(np.concatenate(parities)))
                yield pa.RecordBatch.from_arrays([*taken, pa.array(sizes, pa.int64()), bits, lists], ["doc_id", "maybe", "n", "bits", "keys"])

    return docs.mapInArrow(scan, "doc_id long, maybe boolean, n long, bits array<long>, keys array<long>")


def _full_sets(docs: DataFrame, words: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = pa.array([s.tobytes() for s in _sets(batch, words)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sets], ["doc_id", "tokens"])

    return docs.mapInArrow(scan, "doc_id long, tokens binary")


def _needed(na: Column, nb: Column, percent: int) -> Column:
    """The least overlap of two sets that reaches the similarity: T."""
    return F.ceil(F.lit(percent) * (na + nb) / F.lit(100 + percent)).cast("long")


def _asked(na: Column, nb: Column, percent: int, part: int = PART) -> Column:
    """On how many common short lists a pair is looked for: a part of DivideSkip's bound T - L, L being the long lists of the document whose short lists
    end first. Which of both that is isn't known here, so the smaller of the two bounds is taken."""
    long_lists = lambda n: F.ceil(F.lit(percent) * n / 100).cast("long") - 1
    return F.ceil(F.greatest(F.lit(1), _needed(na, nb, percent) - F.greatest(long_lists(na), long_lists(nb))) / F.lit(part)).cast("long")


def _candidates(left: DataFrame, right: DataFrame, percent: int, early: bool = False) -> DataFrame:
    """Pairs a < b of different components, with how many short lists both are on.

    Each side has key, doc_id, n, bits, place (in the order of its document's lists) and component; both sides may hold
    a pair, in which case minor on the right keeps it from meeting twice. With early, lists count only where the pair's first common one
    can be: behind the first of at least T common shingles there are T - 1 more in each set. Where both sides have before, some of the document's lists
    before this one, a pair that has one of those in common doesn't meet here: it meets there. Where all lists are met, no pair is lost by either.
    """
    of_side = ("doc_id", "n", "bits", "place", "component", *(["before"] if "before" in left.columns else []))
    left = left.select("key", *(F.col(c).alias(f"{c}_a") for c in of_side))
    right = right.select("key", "minor", *(F.col(c).alias(f"{c}_b") for c in of_side))
    na, nb = F.col("n_a"), F.col("n_b")
    most = F.least("place_a", "place_b") + F.least(na - F.col("place_a"), nb - F.col("place_b"))
    fits = (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (most >= _needed(na, nb, percent))
    differ = sum((F.bit_count(F.get("bits_a", F.lit(i)).bitwiseXOR(F.get("bits_b", F.lit(i)))) for i in range(PARITY_BITS // 64)), F.lit(0))
    fits &= differ <= na + nb - 2 * _needed(na, nb, percent)
    if early:
        needed = _needed(na, nb, percent)
        fits &= (F.col("place_a") <= na - needed) & (F.col("place_b") <= nb - needed)
    if "before" in of_side:
        fits &= ~F.arrays_overlap("before_a", "before_b")
    once = ~F.col("minor") | (F.col("doc_id_a") < F.col("doc_id_b"))
    # one condition of the join, so that pairs which fail it are never rows
    right = right.withColumnRenamed("key", "key_b")
    met = left.join(right, (F.col("key") == F.col("key_b")) & (F.col("component_a") != F.col("component_b")) & once & fits)
    swap = F.col("doc_id_a") > F.col("doc_id_b")
    low = lambda c: F.when(swap, F.col(f"{c}_b")).otherwise(F.col(f"{c}_a"))
    high = lambda c: F.when(swap, F.col(f"{c}_a")).otherwise(F.col(f"{c}_b"))
    met = met.select(low("doc_id").alias("a"), high("doc_id").alias("b"), low("n").alias("na"), high("n").alias("nb"))
    return met.groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("on"))


def _often_enough(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs that are on as many common lists as is asked for."""
    return pairs.where(F.col("on") >= _asked(F.col("na"), F.col("nb"), percent))


def _with_before(open_lists: DataFrame) -> DataFrame:
    """With the keys of up to LOOK_BACK open lists that come last before each in its document's order."""
    earlier = Window.partitionBy("doc_id", "own").orderBy("place").rowsBetween(-LOOK_BACK, -1)
    return open_lists.withColumn("before", F.collect_list("key").over(earlier))


def _on_short_lists(pairs: DataFrame, short: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b, na, nb), those that are on as many common short lists as DivideSkip's bound says. A bitmap keeps other documents' lists out of the join."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    bitmap = saved(key_bitmap(named, F.xxhash64("doc_id")), "join-counted")
    lists = with_maybe(short, F.xxhash64("doc_id"), bitmap).where("maybe")
    both = pairs.join(lists.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("keys").alias("keys_a")), ["a", "na"])
    both = both.join(lists.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("keys").alias("keys_b")), ["b", "nb"])
    return both.where(F.size(F.array_intersect("keys_a", "keys_b")) >= _asked(F.col("na"), F.col("nb"), percent, 1)).select("a", "b").distinct()


def _probe(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that link: exact overlaps by binary search of the smaller set in the larger one.

    Sets are made again from the texts, for the documents of these pairs alone; a bitmap keeps the others out of the scan.
    """
    named = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    bitmap = saved(key_bitmap(named, F.xxhash64("doc_id")), "join-wanted")
    sets = _full_sets(with_maybe(docs, F.xxhash64("doc_id"), bitmap).where("maybe").select("doc_id", "text"), words)
    both = pairs.select("a", "b").join(sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("ta")), "a")
    both = both.join(sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("tb")), "b")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ta"), batch.column("tb"), strict=True):
                s, t = sorted((np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y)), key=len)
                found = np.searchsorted(t, s)
                found[found == len(t)] = 0
                shared = int((t[found] == s).sum()) if len(t) else 0
                keep.append(shared > 0 and 100 * shared >= percent * (len(s) + len(t) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(search, "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """For each row: doc_id, n_shingles, component_id (the least doc_id reachable by links, itself included), same_set_id (the least doc_id with an equal set)."""
    spark = docs.sparkSession
    docs = clean_columns(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    first = saved(_first_pass(docs, words), "join-first")
    rows = first.where("piece is null").select("doc_id", "n", F.col("data").alias("print"))
    levels = spark.sparkContext.broadcast(list_levels(first.where("piece is not null")))

    # Equal sets are one vertex: the least id that has it. Empty sets and null ids are none.
    groups = rows.where("n > 0 and doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("vertex"))
    groups = saved(groups, "join-groups")
    members = rows.where("n > 0 and doc_id is not null").join(groups, "print").select("doc_id", "n", "vertex")
    members = saved(members, "join-members")
    copies = saved(key_bitmap(members.where("doc_id <> vertex"), F.xxhash64("doc_id")), "join-copies")
    vertices = members.where("doc_id = vertex").select("doc_id").distinct()

    marked = with_maybe(docs.where("doc_id is not null"), F.xxhash64("doc_id"), copies)
    short = _short_lists(marked.select("doc_id", "text", "maybe"), levels, words, percent)
    short = saved(short, "join-short")
    short = short.where(~F.col("maybe")).unionByName(short.where("maybe").join(vertices, "doc_id", "left_semi")).drop("maybe")
    # an id may have several texts, so its sets are told apart by a hash
    postings = short.select("doc_id", "n", "bits", F.xxhash64("keys").alias("own"), F.posexplode("keys").alias("place", "key"))

    # Lists of one document lead nowhere; a bitmap keeps most of their postings out of the join.
    lists = postings.select("key").groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    lists = saved(lists, "join-lists")
    size = lists.agg(F.sum("m").alias("postings"), F.sum(F.col("m") * (F.col("m") - 1)).alias("pairs")).first()
    still_open, pairs_left = size.postings or 0, size.pairs or 0
    lists = lists.select("key")
    maybe = with_maybe(postings, F.xxhash64("key"), saved(key_bitmap(lists, F.xxhash64("key")), "join-maybe")).where("maybe").drop("maybe")
    postings = saved(maybe.join(lists, "key").select("key", "doc_id", "n", "bits", "own", "place"), "join-postings")

    def links_of(pairs: DataFrame, name: str) -> DataFrame:
        return saved(_probe(saved(pairs.select("a", "b"), f"{name}-pairs"), docs, words, percent), name)

    links = spark.createDataFrame([], "a long, b long")
    open_lists = postings.withColumn("component", F.col("doc_id"))
    for turn in range(LEADER_ROUNDS):
        if pairs_left <= FEW_PAIRS * still_open:
            break
        # One leader for each list: at first a document with the fewest rarer shingles, which resembles most of the others where they are
        # copies; then by an order that changes each turn. Of the leaders that a document meets, the one met most often is probed.
        first = F.col("place") if turn == 0 else F.lit(0)
        order = F.struct(first.alias("first"), F.xxhash64("doc_id", F.lit(turn)).alias("h"), "doc_id", "n", "bits", "place", "component")
        leaders = open_lists.groupBy("key").agg(F.min(order).alias("x")).select("key", "x.doc_id", "x.n", "x.bits", "x.place", "x.component")
        met = _often_enough(_candidates(leaders, open_lists.withColumn("minor", F.lit(False)), percent), percent)
        either = met.select(F.explode(F.array("a", "b")).alias("doc_id"), "a", "b", "on")
        best = either.groupBy("doc_id").agg(F.max(F.struct("on", "a", "b")).alias("x")).select("x.a", "x.b").distinct()
        new = links_of(best, f"join-links{turn}")
        if not new.limit(1).count():
            break
        links = links.unionByName(new)
        last, before = open_lists, still_open
        open_lists = saved(_open(postings, components(links)), f"join-open{turn}")
        if turn:
            deleted(last)
        of_list = _component_sizes(open_lists).groupBy("key").agg(F.sum("m").alias("m"), F.max("m").alias("most"))
        size = of_list.agg(F.sum("m").alias("postings"), F.sum((F.col("m") - F.col("most")) * F.col("m")).alias("pairs")).first()
        still_open, pairs_left = size.postings or 0, size.pairs or 0
        if still_open > (1 - WORTHWHILE) * before:
            break

    # What is left, exactly: of each list, the documents outside its largest component with all others.
    major = _component_sizes(open_lists).groupBy("key").agg(F.max_by("component", F.struct("m", "component")).alias("major"))
    split = saved(_with_before(open_lists).join(major, "key").withColumn("minor", F.col("component") != F.col("major")).drop("major"), "join-split")
    deleted(open_lists)
    deleted(postings)
    met = saved(_candidates(split.where("minor"), split, percent, early=True), "join-met-pairs")
    new = links_of(_on_short_lists(met, short, percent), "join-links")
    label = components(links.unionByName(new))

    vertex_of = label.select(F.col("vertex"), F.col("component").alias("component_id"))
    linked = members.join(vertex_of, "vertex", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "vertex").alias("component_id"), F.col("vertex").alias("same_set_id"))
    alone = rows.where("n = 0 or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).alias("component_id"), F.lit(None).cast("long").alias("same_set_id"))
    return linked.unionByName(alone)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, one of each component: that with the smallest id, nulls last.

    Rows get keys of their own and are written with them, so that ids may repeat or be missing. A bitmap of bounded size lets most rows pass where they
    are read; only the others are shuffled.
    """
    packed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    keyed = saved(packed.withColumn("key", F.monotonically_increasing_id()), "near-rows")
    found = jaccard_components(keyed, "key", "text", words, percent).select(F.col("doc_id").alias("key"), F.col("component_id").alias("component"))
    found = saved(found, "near-found")
    several = saved(found.where("component <> key").select("component").distinct(), "near-several")
    members = saved(found.join(several, "component").join(keyed.select("key", "doc_id"), "key"), "near-members")
    first = members.groupBy("component").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "key"))["key"].alias("first"))
    gone = saved(members.join(first, "component").where("key <> first").select("key"), "near-gone")
    marked = with_maybe(keyed, F.xxhash64("key"), saved(key_bitmap(gone, F.xxhash64("key")), "near-bitmap"))
    return marked.where("not maybe").select("row.*").unionByName(marked.where("maybe").join(gone, "key", "left_anti").select("row.*"))


def _open(postings: DataFrame, label: DataFrame) -> DataFrame:
    """Postings of the lists whose documents are still of several components, with their components."""
    named = postings.join(label.withColumnRenamed("vertex", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    several = named.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most").select("key")
    return named.join(several, "key").select("key", "doc_id", "n", "bits", "own", "place", "component")


def _component_sizes(open_lists: DataFrame) -> DataFrame:
    return open_lists.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m"))
