"""Ranked lexical search, exact, over posting lists in geometric blocks.

Every document becomes a vector of impacts, one for each of its terms that some item has (told by a bitmap of fixed size while texts are read), and documents are
sorted by a code of random hyperplanes, so that similar ones lie together. A task takes DOCS of them at a time as a small index: each term's posting list is clustered
by document similarity (each document goes to the most similar of some representatives of the list) and cut into blocks of at most BLOCK documents, and each block stores the
coordinatewise maximum of its documents' vectors, over the coordinates that items with that term have. A block's bound for an item is the item's weights times that summary, so no
document of the block scores more; a block is skipped only where the bound is below the score that the item's last rank has already. An item's lists are gone through from the one with the
largest bound down, so bounds leave out the terms of earlier lists, and lists end where the chunk's own maxima show that the rest can't reach that score. Documents of all other
blocks are scored exactly, in integers.

Scores to start from come from a sixteenth of the documents, searched in the same way: the last rank's score among some documents is never above that among all. Each task
raises them with what it finds, and gives at most k documents for an item, which meet in a window for the item.

Items are taken in blocks of at most BLOCK_ITEMS items and BLOCK_TERMS terms (an item alone may have more), one block in the driver at a time. Everything else, N, L, document frequencies and
postings, covers all documents and whole texts, and is aggregated before it is shuffled; a third of all documents may be copies: they are split by a hash of their id.

Null or empty texts have no terms and are never ranked; rows with a null item_id are left out, and rows that repeat an item_id are one item with all their terms. A null doc_id comes last among
equal scores; rows that repeat a doc_id are documents of their own. Empty tables give no rows. Further columns are ignored. Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewise.llm.common import BITMAP_BITS, clean_columns, key_bitmap, saved
from sitewise.llm.features import _LETTER, _LOW, _Hashes, letter_words

RANKS = 50
DOCS, BLOCK = 1024, 8
BLOCK_ITEMS, BLOCK_TERMS = 512, 8192
#: One document of so many gives the scores to start from.
PILOT = 16
#: Bytes of texts whose terms are found at once; longer texts are cut between terms.
_PIECE = 1 << 20
_CODE_BITS = 16
_MASK = np.uint64((1 << BITMAP_BITS) - 1)


def _pieces(texts: list[str | None]) -> Iterator[tuple[int, bytes, list[int]]]:
    """Texts joined by a separator up to _PIECE bytes: the first one's number, the bytes, and where each one starts. A long text is cut between terms."""
    joined, starts, first = bytearray(), [], 0
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        while len(raw) > _PIECE:
            outside = np.flatnonzero(~_LETTER[np.frombuffer(raw, np.uint8, _PIECE)])
            more = np.flatnonzero(~_LETTER[np.frombuffer(raw, np.uint8, offset=_PIECE)][: 1 << 24]) if not len(outside) else []
            at = int(outside[-1]) + 1 if len(outside) else _PIECE + int(more[0]) + 1 if len(more) else len(raw)
            yield i, raw[:at], [0]
            raw = raw[at:]
        if not starts:
            first = i
        starts.append(len(joined))
        joined += raw + b" "
        if len(joined) >= _PIECE:
            yield first, bytes(joined), starts
            joined, starts = bytearray(), []
    if starts:
        yield first, bytes(joined), starts


def term_counts(texts: list[str | None], bits: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """How many terms each text has, and its distinct terms: text's number, 64-bit hash, count. bits keeps only terms that may be among the items'."""
    n, owners, hashes = np.zeros(len(texts), dtype=np.int64), [], []
    for first, joined, starts in _pieces(texts):
        raw = np.frombuffer(joined, dtype=np.uint8)
        start, stop = letter_words(raw)
        owner = first + np.searchsorted(starts, start, side="right") - 1
        n += np.bincount(owner, minlength=len(texts))
        found = _Hashes(raw, _LOW).of(start, stop)
        if bits is not None:
            slot = found & _MASK
            maybe = (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
            owner, found = owner[maybe], found[maybe]
        owners.append(owner)
        hashes.append(found)
    if not owners:
        return n, *(np.empty(0, dtype=t) for t in (np.int64, np.uint64, np.int64))
    owner, found = np.concatenate(owners), np.concatenate(hashes)
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    new = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])) if len(owner) else [])
    return n, owner[new], found[new], np.diff(np.append(new, len(owner)))


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id and each of its distinct terms (a hash)."""
    named = clean_columns(items, item_id=id_col, text=text_col).where("item_id is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, owner, found, _ = term_counts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(owner)), pa.array(found.view(np.int64))], ["item_id", "term"])

    kind = named.schema["item_id"].dataType.simpleString()
    return named.mapInArrow(run, f"item_id {kind}, term long").distinct()


def vectors(docs: DataFrame, bits: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (all terms of the text), terms and counts (those that items may have), and code, whose equal leading bits tell of similar documents."""
    named = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                n, owner, found, count = term_counts(batch.column("text").to_pylist(), bits)
                ends = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
                signs = ((found[:, None] >> np.arange(32, 32 + _CODE_BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32) * 2 - 1
                sums = np.concatenate([np.zeros((1, _CODE_BITS)), np.cumsum(signs * (count / (count + 1))[:, None], axis=0)])
                code = (sums[ends[1:]] - sums[ends[:-1]] > 0) @ (1 << np.arange(_CODE_BITS)[::-1])
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (found.view(np.int64), count.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), *lists, pa.array(code.astype(np.int64))], ["doc_id", "n", "terms", "counts", "code"])

    return named.mapInArrow(run, "doc_id long, n long, terms array<long>, counts array<long>, code long")


@dataclass
class Items:
    """A block of items: of each one its terms, as places in the sorted vocabulary, their weights, and the score of its last rank so far (at least 1)."""

    vocabulary: np.ndarray
    terms: list[np.ndarray]
    weights: list[np.ndarray]
    least: np.ndarray


class Found:
    """The best documents of each item so far, and the score that a further one must reach."""

    def __init__(self, items: Items, k: int):
        self.k, self.least = k, items.least.copy()
        self.rows = [tuple(np.empty(0, dtype=t) for t in (np.int64, bool, np.int64)) for _ in items.terms]  # score, no id, id

    def add(self, item: int, scores: np.ndarray, none: np.ndarray, ids: np.ndarray) -> None:
        score, none, ids = (np.concatenate(x) for x in zip(self.rows[item], (scores, none, ids), strict=True))
        best = np.lexsort((ids, none, -score))[: self.k]
        self.rows[item] = score[best], none[best], ids[best]
        if len(best) == self.k:
            self.least[item] = max(self.least[item], score[best[-1]])


def blocks(postings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Clusters a list's documents, the columns of postings: an order, and where blocks start in it.

    Representatives are dealt evenly over the list; a document goes to the one with the largest cosine, and a representative's documents are cut into blocks of at most BLOCK.
    """
    n = postings.shape[1]
    if n <= BLOCK:
        return np.arange(n), np.zeros(1, dtype=np.int64)
    x = postings.astype(np.float32)
    some = x[:, :: BLOCK]
    nearest = np.argmax(x.T @ (some / np.maximum(np.linalg.norm(some, axis=0), 1)), axis=1)
    order = np.argsort(nearest, kind="stable")
    own = nearest[order]
    run = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    since = np.arange(n) - np.repeat(run, np.diff(np.append(run, n)))
    return order, np.flatnonzero(since % BLOCK == 0)


def search_chunk(impacts: np.ndarray, none: np.ndarray, ids: np.ndarray, items: Items, found: Found, seen: dict[str, int] | None = None) -> None:
    """Ranks the documents of a chunk, the columns of impacts (a row for each term of the vocabulary). seen counts blocks and the skipped ones.

    An item's lists are gone through from the largest bound down, and a document is found in the first list that it is in. So a list's bounds count only
    that term and those after it, and the lists end where all that are left can't make up the score that is needed.
    """
    most = impacts.max(axis=1).astype(np.int64)
    needed: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
    for i, (terms, weights) in enumerate(zip(items.terms, items.weights, strict=True)):
        bound = weights * most[terms]
        order = np.argsort(-bound, kind="stable")
        rest = np.cumsum(bound[order][::-1])[::-1]  # no document scores more with the terms from here on
        for at in range(int((rest >= found.least[i]).sum())):
            needed.setdefault(int(terms[order[at]]), []).append((i, terms[order[at:]], weights[order[at:]]))
    candidates: dict[int, np.ndarray] = {}
    for t, wanted in needed.items():
        docs = np.flatnonzero(impacts[t])
        coordinates = np.unique(np.concatenate([terms for _, terms, _ in wanted]))
        postings = impacts[np.ix_(coordinates, docs)]
        order, starts = blocks(postings)
        summary = np.maximum.reduceat(postings[:, order], starts, axis=1)
        lengths = np.diff(np.append(starts, len(docs)))
        for i, terms, weights in wanted:
            bound = weights @ summary[np.searchsorted(coordinates, terms)].astype(np.int64)
            keep = bound >= found.least[i]
            if seen is not None:
                seen["blocks"] = seen.get("blocks", 0) + len(keep)
                seen["skipped"] = seen.get("skipped", 0) + int((~keep).sum())
            if keep.any():
                candidates.setdefault(i, np.zeros(len(ids), dtype=bool))[docs[order[np.repeat(keep, lengths)]]] = True
    for i, mask in candidates.items():
        docs = np.flatnonzero(mask)
        scores = items.weights[i] @ impacts[np.ix_(items.terms[i], docs)].astype(np.int64)
        good = scores >= found.least[i]
        if good.any():
            docs = docs[good]
            found.add(i, scores[good], none[docs], ids[docs])


def _search(items: Items, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, size = Found(items, k), len(items.vocabulary)
    docs = max(BLOCK, min(DOCS, (1 << 23) // max(1, size)))
    for batch in batches:
        for at in range(0, batch.num_rows, docs):
            part = batch.slice(at, docs)
            lists = part.column("terms")
            owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            terms, impacts = lists.flatten().to_numpy(), part.column("impacts").flatten().to_numpy()
            place = np.minimum(np.searchsorted(items.vocabulary, terms), size - 1)
            known = items.vocabulary[place] == terms
            matrix = np.zeros((size, part.num_rows), dtype=np.int32)
            matrix[place[known], owner[known]] = impacts[known]
            ids = part.column("doc_id")
            search_chunk(matrix, np.asarray(ids.is_null()), np.asarray(ids.fill_null(0)), items, found)
    for i, (score, none, ids) in enumerate(found.rows):
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), i, dtype=np.int32)), pa.array(ids, pa.int64(), mask=none), pa.array(score, pa.int64())], ["item", "doc_id", "score"])


def _blocks_of_items(weighted: DataFrame) -> Iterator[tuple[list, list[np.ndarray], list[np.ndarray]]]:
    """Items in blocks: ids, hashes of terms and weights; one block is in the driver at a time."""
    ids, terms, weights, size = [], [], [], 0
    for row in weighted.orderBy("item_id").toLocalIterator():
        if ids and (len(ids) == BLOCK_ITEMS or size + len(row.terms) > BLOCK_TERMS):
            yield ids, terms, weights
            ids, terms, weights, size = [], [], [], 0
        pairs = sorted(zip(row.terms, row.weights, strict=True))
        ids.append(row.item_id)
        terms.append(np.array([t for t, _ in pairs], dtype=np.int64))
        weights.append(np.array([w for _, w in pairs], dtype=np.int64))
        size += len(pairs)
    if ids:
        yield ids, terms, weights


def search(docs: DataFrame, items: DataFrame, k: int = RANKS) -> DataFrame:
    """item_id, rank, doc_id and score of each item's k best documents."""
    spark = docs.sparkSession
    wanted = saved(item_terms(items), "search-items")
    bits = np.zeros(1 << (BITMAP_BITS - 3), dtype=np.uint8)
    for r in key_bitmap(wanted.select("term").distinct(), F.col("term")).collect():  # at most 512 rows of 4 KB
        bits[r.bitmap_piece * 4096 : (r.bitmap_piece + 1) * 4096] = np.frombuffer(r.bitmap_bits, dtype=np.uint8)
    salt = F.xxhash64("doc_id", "n", "terms")
    held = saved(vectors(docs, bits).withColumn("salt", salt).repartitionByRange("code", "salt").sortWithinPartitions("code", "salt"), "search-vectors")

    n_docs, n_terms = held.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    weighted = wanted.join(frequency, "term").select("item_id", "term", weight.alias("weight")).where("weight > 0")
    weighted = weighted.groupBy("item_id").agg(F.collect_list(F.struct("term", "weight")).alias("x"))
    weighted = saved(weighted.select("item_id", F.col("x.term").alias("terms"), F.col("x.weight").alias("weights")), "search-weights")

    share = F.expr(f"50 + ((50 * n * {n_docs}L) div {max(1, n_terms)}L)")
    index = held.select("doc_id", "terms", "counts", "salt", share.alias("m")).withColumn("impacts", F.expr("transform(counts, tf -> (1000000000L * tf) div (1000L * tf + 20L * m))"))
    index = index.select("doc_id", "terms", "impacts", "salt").where(F.size("terms") > 0)

    def ranked(block: Items, rows: DataFrame) -> DataFrame:
        rows = rows.select("doc_id", "terms", "impacts").mapInArrow(partial(_search, block, k), "item int, doc_id long, score long")
        order = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    out = spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    for ids, terms, weights in _blocks_of_items(weighted):
        vocabulary = np.unique(np.concatenate(terms))
        block = Items(vocabulary, [np.searchsorted(vocabulary, t) for t in terms], weights, np.ones(len(ids), dtype=np.int64))
        for r in ranked(block, index.where(F.pmod("salt", F.lit(PILOT)) == 0)).where(F.col("rank") == k).collect():  # a row for each item of the block
            block.least[r.item] = r.score
        names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {out.schema['item_id'].dataType.simpleString()}")
        found = ranked(block, index).join(F.broadcast(names), "item")  # at most BLOCK_ITEMS names
        out = out.unionByName(saved(found.select("item_id", "rank", "doc_id", "score"), "search-found"))
    return out
