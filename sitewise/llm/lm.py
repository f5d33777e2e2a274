"""Scoring documents by a language model: causal self-attention over subword ids, beside a plain count of words.

The model. A text's words, lower-cased and joined by one space each, become ids of a public vocabulary, and an end id. The
probability of an id is that of its class, given by masked self-attention over the ids before it, times that of the id
within its class after the id just before it, counted over all training documents. The most frequent ids are classes of their own. So every id
has a probability, and those of all continuations sum to one.

What covers what. Everything is learnt from all training documents: the counts of words, of ids and of pairs of a unit and the id after it, the grouping of
ids into classes and the attention's weights. Spark aggregates the counts and the grouping's sums, as many as the vocabulary has, for pairs times PAIRED + GROUPS + 1
units, which is 26 MB as half-precision logarithms. The weights begin
from a fit in the driver to at most SAMPLE_DOCS distinct texts; then all documents are dealt to ROUNDS rounds. In a round each task
goes by gradient descent through the windows of its own documents, from the same weights, and the next round begins from
the tasks' weights averaged by their numbers of windows. So each training document is gone through once, and weights depend
a little on how rows are dealt to tasks.

Scoring. Each text is cut into overlapping windows; every id is scored once, with at least OVERLAP ids before it save at
the beginning. For the word count, frequent words (at most HEAD) are looked up in each task; only rarer ones go through a
join, one row for each distinct rare word of a document, so no hot key is left in it.

A null text is empty: one token, the end. Repeated rows are counted and scored each; a row with a null id is learnt from and not
held out. Without training documents every word is unknown and ids are equally likely within a class. An empty table
gives an empty result. Columns other than the two named are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.llm.attention import OVERLAP, WINDOW, Adam, Attention, windows
from sitewise.llm.common import clean_columns, distinct_sample, least_hashes, saved, slices
from sitewise.llm.labelled import remainder
from sitewise.llm.shingles import word_hashes

MODULUS, HELD_OUT = 10, 0
END_ID, VOCABULARY = 50256, 50257
_END = array("H", [END_ID]).tobytes()
#: White space of Unicode that doesn't part words here.
_OTHER_SPACE = re.compile(r"[^\S\x20\x09-\x0D\x1C-\x1F]")
#: The word that stands for the end, a key that no word's hash is meant to have.
END_WORD = -1
HEAD, SAMPLE_DOCS, SAMPLE_WINDOWS, EPOCHS = 1 << 16, 2000, 24_000, 5
SINGLES, GROUPS, OWN_UNITS = 64, 64, 1024
SMOOTH = 0.1
#: So many frequent ids are units of their own in counts of pairs; counts of an id within its class are worth so many pairs.
PAIRED, KAPPA = 192, 20.0
#: Rounds over all documents, windows in a step, windows that a task shuffles at a time, and the first round's rate.
ROUNDS, BATCH, SHUFFLED, RATE = 4, 64, 4096, 4e-3
#: Distinct words that a task holds before it hands its counts on.
FLUSH_WORDS = 2_000_000
#: Words of at most 64 bytes whose ids a process keeps.
KNOWN_WORDS = 1 << 17
#: Windows at a time: few enough that their arrays stay in the cache.
_CHUNK = 64


@cache
def _vocabulary(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@cache
def _begins(path: str) -> np.ndarray:
    """Whether an id's bytes begin with a space."""
    spaced = np.zeros(VOCABULARY, dtype=bool)
    for token, rank in _vocabulary(path)[1].items():
        spaced[rank] = token.startswith(b" ")
    return spaced


@cache
def _known(path: str) -> dict[bytes, bytes]:
    """Ids of words that were met before, kept by the process."""
    return {}


def _packed_ids(texts: list[str | None], path: str) -> list[bytes]:
    """Ids of each text's lower-cased words, each after one space, and the end, two bytes each.

    The vocabulary's pattern begins a match at every space before a word, so a word's ids are the same in each text: those of new words are made in
    one go, and told apart by the ids that begin with a space. Only where a word holds white space of Unicode, which may be taken together with
    the space beside it, the whole text is cut into ids.
    """
    encode, known = _vocabulary(path)[0].encode_ordinary, _known(path)
    words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]  # ASCII white space and letters alone
    new = [w for w in set().union(*words).difference(known) if not _other_space(w)]
    if new:
        ids = np.array(encode(" " + b" ".join(new).decode("utf-8", "replace")), dtype=np.uint16)
        first = (np.flatnonzero(_begins(path)[ids]) * 2).tolist()
        every = ids.tobytes()
        known.update(zip(new, map(every.__getitem__, map(slice, first, [*first[1:], len(every)])), strict=True))
    out = []
    for some in words:
        try:
            out.append(b"".join(map(known.__getitem__, some)) + _END)
        except KeyError:
            out.append(array("H", encode(" " + b" ".join(some).decode("utf-8", "replace"))).tobytes() + _END)
    for w in new if len(known) > KNOWN_WORDS else [w for w in new if len(w) > 64]:
        del known[w]
    return out


def _other_space(word: bytes) -> bool:
    return not word.isascii() and _OTHER_SPACE.search(word.decode("utf-8", "replace")) is not None


def text_ids(text: str | None, path: str) -> np.ndarray:
    """Ids of the lower-cased words, each after one space, and the end."""
    return np.frombuffer(_packed_ids([text], path)[0], dtype=np.uint16).astype(np.int64)


def _word_counts(docs: DataFrame) -> DataFrame:
    """key and n of each word over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, numbers, held = [], [], 0

        def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, which = np.unique(np.concatenate(words), return_inverse=True)
            return keys, np.bincount(which, np.concatenate(numbers)).astype(np.int64)

        for batch in slices(batches):
            found = [word_hashes(t.as_py() or "").view(np.int64) for t in batch.column("text")]
            if not found:
                continue
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            words += [keys, np.array([END_WORD])]
            numbers += [n, np.array([len(found)])]
            held += len(keys) + 1
            if held > FLUSH_WORDS:
                keys, n = merged()
                words, numbers, held = [keys], [n], len(keys)
                if held > FLUSH_WORDS // 2:
                    yield rows(keys, n)
                    words, numbers, held = [], [], 0
        if words:
            yield rows(*merged())

    return docs.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _encoded(docs: DataFrame, path: str) -> DataFrame:
    """docs (doc_id, train, text) with a round and ids, two bytes each: texts are read once, and cut into ids once."""
    names = ["doc_id", "train", "text", "round", "ids"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId()
        for batch in slices(batches):
            ids = _packed_ids(batch.column("text").to_pylist(), path)
            rounds = pa.array((row + np.arange(len(ids))) % ROUNDS, pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:3]), rounds, pa.array(ids, pa.binary())], names)
            row += len(ids)

    return docs.select(*names[:3]).mapInArrow(encode, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, train boolean, text string, round int, ids binary")


def _ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for ids in batch.column("ids"):
            yield np.frombuffer(ids.as_py(), dtype=np.uint16).astype(np.int64)


def _id_counts(encoded: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(VOCABULARY, dtype=np.int64)
        for ids in _ids_of(batches):
            np.add.at(total, ids, 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["key", "n"])

    counts = np.zeros(VOCABULARY)
    for r in encoded.select("ids").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect():  # at most the vocabulary
        counts[r.key] = r.n
    return counts


def _usage(documents: Iterator[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each id how often it occurs, and the summed shares of the frequent ids in the documents that hold it."""
    rank = np.full(VOCABULARY, -1)
    rank[_order(counts)[:SINGLES]] = np.arange(SINGLES)
    seen, about = np.zeros(VOCABULARY), np.zeros((VOCABULARY, SINGLES), dtype=np.float32)
    for ids in documents:
        used = rank[ids]
        shares = np.bincount(used[used >= 0], minlength=SINGLES) / max(1, len(ids))
        at, n = np.unique(ids, return_counts=True)
        seen[at] += n
        about[at] += n[:, None] * shares.astype(np.float32)
    return seen, about


def _whole_usage(encoded: DataFrame, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """_usage over all documents: a row for each id, summed by Spark."""
    names = [f"u{k}" for k in range(SINGLES)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, about = _usage(_ids_of(batches), counts)
        at = np.flatnonzero(seen)
        for k in range(0, len(at), 4096):
            part = at[k : k + 4096]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), *(pa.array(about[part, c]) for c in range(SINGLES))], ["key", *names])

    made = encoded.select("ids").mapInArrow(sums, "key long, " + ", ".join(f"{c} float" for c in names))
    about = np.zeros((VOCABULARY, SINGLES), dtype=np.float32)
    table = made.groupBy("key").agg(*(F.sum(c).cast("float").alias(c) for c in names)).toArrow()  # at most the vocabulary
    for k, c in enumerate(names):
        about[table["key"].to_numpy(), k] = table[c].to_numpy()
    return counts, about


def _paired(model: Model, encoded: DataFrame) -> Model:
    """The model with the logarithms of ids within their classes after each unit, from the pairs of all documents."""
    base = model

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, total = [], 0, {}

        def take() -> None:
            at, n = np.unique(np.concatenate(held), return_counts=True)
            units = np.arange(at[0] // VOCABULARY, at[-1] // VOCABULARY + 2)
            first = np.searchsorted(at, units * VOCABULARY)  # at is sorted
            for u, start, stop in zip(units.tolist(), first, first[1:]):
                if start < stop:
                    total.setdefault(u, np.zeros(VOCABULARY, np.int64))[at[start:stop] - u * VOCABULARY] += n[start:stop]

        for ids in _ids_of(batches):
            held.append(base.before(ids) * VOCABULARY + ids)
            size += len(ids)
            if size > FLUSH_WORDS:
                take()
                held, size = [], 0
        if held:
            take()
        for u, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), u), pa.int32()), pa.array(at, pa.int32()), pa.array(n[at])], ["unit", "id", "n"])

    def logs(key, frame):
        import pandas as pd

        n = np.zeros(VOCABULARY)
        n[frame["id"].to_numpy()] = frame["n"].to_numpy()
        return pd.DataFrame({"unit": [int(key[0])], "logs": [base.after(n).astype(np.float16).tobytes()]})

    counts = saved(encoded.select("ids").mapInArrow(count, "unit int, id int, n long").groupBy("unit", "id").agg(F.sum("n").alias("n")), "lm-pairs")
    table = np.tile(model.within[0], (len(model.within) if len(model.within) > 1 else PAIRED + GROUPS + 1, 1))
    # a group has at most the vocabulary's rows; one row for each unit comes back
    for r in counts.groupBy("unit").applyInPandas(logs, "unit int, logs binary").collect():
        table[r.unit] = np.frombuffer(r.logs, dtype=np.float16)
    return replace(model, within=table)


def _trained(model: Model, encoded: DataFrame, rounds: int = ROUNDS) -> Model:
    """The model after its attention has gone through all documents, in rounds of which each averages what the tasks have learnt."""
    names = sorted(model.attention.p)
    for number in range(rounds):
        shared = encoded.sparkSession.sparkContext.broadcast(model)
        rate = RATE * (1 - 0.8 * number / rounds)

        def learn(batches: Iterator[pa.RecordBatch], shared=shared, rate=rate, number=number) -> Iterator[pa.RecordBatch]:
            model, r, seen, held, waiting = shared.value, np.random.default_rng(number), 0, [], 0
            own = Attention({n: v.copy() for n, v in model.attention.p.items()})
            adam = Adam(own)

            def take(most: int) -> None:
                u, c, w = (np.concatenate(x) for x in zip(*held, strict=True))
                held[:] = [(u[most:], c[most:], w[most:])]
                order = r.permutation(min(most, len(u)))
                for at in range(0, len(order), BATCH):
                    i = order[at : at + BATCH]
                    adam.step(u[i], c[i], w[i], rate * min(1.0, (adam.steps + 1) / 10))

            for ids in _ids_of(batches):
                for some in model.windows(ids):
                    held.append(some)
                    waiting += len(some[0])
                    if waiting >= SHUFFLED:  # less than twice as many
                        take(SHUFFLED)
                        seen += SHUFFLED
                        waiting -= SHUFFLED
            if waiting:
                take(waiting)
                seen += waiting
            if seen:
                flat = np.concatenate([own.p[n].ravel() for n in names]).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat * seen), pa.array(np.full(len(flat), float(seen)))], ["place", "total", "n"])

        made = encoded.where(F.col("round") == number).select("ids").mapInArrow(learn, "place int, total double, n double")
        table = made.groupBy("place").agg((F.sum("total") / F.sum("n")).alias("w")).toArrow()  # as many as the weights
        shared.unpersist()
        if not table.num_rows:
            continue
        flat = np.zeros(table.num_rows, dtype=np.float32)
        flat[table["place"].to_numpy()] = table["w"].to_numpy()
        sizes = np.cumsum([model.attention.p[n].size for n in names])
        parts = np.split(flat, sizes[:-1])
        model = replace(model, attention=Attention({n: x.reshape(model.attention.p[n].shape) for n, x in zip(names, parts, strict=True)}))
    return model


@dataclass
class Model:
    """Classes and units of ids, logarithms of ids within their classes, and the attention over units."""

    path: str
    class_of: np.ndarray
    unit_of: np.ndarray
    within: np.ndarray
    attention: Attention
    pair_unit: np.ndarray

    def before(self, ids: np.ndarray) -> np.ndarray:
        """The unit, as pairs are counted, before each id; the last one stands before the first id."""
        return np.concatenate([[PAIRED + GROUPS], self.pair_unit[ids[:-1]]])

    def after(self, n: np.ndarray) -> np.ndarray:
        """log10 of each id within its class, from the counts of ids after one unit and those over all units."""
        classes = SINGLES + GROUPS
        return np.log10((n + KAPPA * 10.0 ** self.within[0].astype(float)) / (np.bincount(self.class_of, n, classes) + KAPPA)[self.class_of])

    def log10_within(self, ids: np.ndarray) -> np.ndarray:
        return self._within(self.before(ids), ids)

    def _within(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return self.within[before if len(self.within) > 1 else np.zeros(len(ids), np.int64), ids].astype(np.float64)

    def inputs(self, ids: np.ndarray) -> np.ndarray:
        """The unit before each id; the last unit stands before the first id."""
        return np.concatenate([[len(self.attention.p["e"]) - 1], self.unit_of[ids[:-1]]])

    def windows(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Units, classes and weights of the windows of a text, for training, at most SHUFFLED at a time."""
        # side by side: each id is learnt once
        for at in range(0, len(ids), SHUFFLED * WINDOW):
            part = ids[at : at + SHUFFLED * WINDOW]
            shape = (-(-len(part) // WINDOW), WINDOW)
            u, c, w = np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.zeros(shape, np.float32)
            u.ravel()[: len(part)] = self.inputs(part)
            if at:
                u[0, 0] = self.unit_of[ids[at - 1]]
            c.ravel()[: len(part)], w.ravel()[: len(part)] = self.class_of[part], 1
            yield u, c, w

    def log10(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 of the probability of each sequence of ids."""
        lengths = np.array([len(t) for t in texts])
        first = np.concatenate([[0], np.cumsum(lengths)])
        every = np.concatenate(texts)
        before, pairs = self.inputs(every), self.before(every)
        before[first[:-1]], pairs[first[:-1]] = before[0], pairs[0]
        classes, products = self.class_of[every], self.attention.products()
        total = np.add.reduceat(self._within(pairs, every), first[:-1])
        cuts = [(d, at, skip) for d, n in enumerate(lengths) for at, skip in windows(int(n))]
        for wanted in (0, OVERLAP):
            rows = np.array([(d, at) for d, at, skip in cuts if skip == wanted], dtype=np.int64).reshape(-1, 2)
            for k in range(0, len(rows), _CHUNK):
                d, at = rows[k : k + _CHUNK].T
                place = at[:, None] + np.arange(WINDOW)
                valid = place < lengths[d][:, None]
                index = np.where(valid, first[d][:, None] + place, 0)
                logs = self.attention.log_probabilities(before[index], classes[index], wanted, products)
                total += np.bincount(d, np.where(valid[:, wanted:], logs, 0).sum(1), len(texts)) / np.log(10)
        return total


def _classes(counts: np.ndarray, usage: tuple[np.ndarray, np.ndarray], spaced: np.ndarray, seed: int = 3) -> np.ndarray:
    """The end and frequent ids alone; the others by the frequent ids that their documents hold (which tells languages apart), apart by whether they begin a word."""
    order = _order(counts)
    class_of = np.full(len(counts), SINGLES, dtype=np.int64)
    class_of[order[:SINGLES]] = np.arange(SINGLES)
    seen, about = usage
    about = about / np.maximum(seen, 1)[:, None]
    if (seen > 0).any():
        about[seen == 0] = about[seen > 0].mean(0)
    r, half = np.random.default_rng(seed), GROUPS // 2
    for kind in (0, 1):
        rest = np.array([i for i in order[SINGLES:] if spaced[i] == kind])
        known = rest[seen[rest] > 0]
        if len(known) <= half:
            class_of[rest] = SINGLES + kind * half
            continue
        centers = about[r.choice(known, half, replace=False)]
        for _ in range(8):
            group = _nearest(about[known], centers)
            for g in np.unique(group):
                centers[g] = about[known[group == g]].mean(0)
        class_of[rest] = SINGLES + kind * half + _nearest(about[rest], centers)
    return class_of


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers**2).sum(1) - 2 * x @ centers.T, 1)


def _order(counts: np.ndarray) -> np.ndarray:
    """Ids by falling counts, the end before all."""
    first = np.where(np.arange(len(counts)) == END_ID, np.inf, counts)
    return np.lexsort((np.arange(len(counts)), -first))


def fit(texts: list[str | None], counts: np.ndarray, path: str, most_windows: int = SAMPLE_WINDOWS, epochs: int = EPOCHS, usage: tuple[np.ndarray, np.ndarray] | None = None) -> Model:
    """Learns the attention from the texts; counts are those of all training documents' ids, and so is usage (of the texts where left out)."""
    spaced = _begins(path).copy()
    spaced[END_ID] = True
    sample = [text_ids(t, path) for t in texts]
    class_of = _classes(counts, usage or _usage(iter(sample), counts), spaced)
    totals, sizes = np.bincount(class_of, counts, SINGLES + GROUPS), np.bincount(class_of, minlength=SINGLES + GROUPS)
    within = np.log10((counts + SMOOTH) / (totals + SMOOTH * sizes)[class_of])
    order = _order(counts)
    unit_of = OWN_UNITS + class_of
    unit_of[order[:OWN_UNITS]] = np.arange(OWN_UNITS)
    pair_unit = PAIRED + np.maximum(class_of - SINGLES, 0)
    pair_unit[order[:PAIRED]] = np.arange(PAIRED)
    model = Model(path, class_of, unit_of, within[None].astype(np.float16), Attention.new(OWN_UNITS + SINGLES + GROUPS + 1, SINGLES + GROUPS), pair_unit)
    rows = [some for ids in sample for some in model.windows(ids)]
    if rows:
        keep = np.random.default_rng(4).permutation(sum(len(u) for u, _, _ in rows))[:most_windows]
        u, c, w = (np.concatenate(x)[keep] for x in zip(*rows, strict=True))
        # begin with the classes' frequencies
        model.attention.p["b"] += np.log((totals + 1) / (totals + 1).sum()).astype(np.float32)
        model.attention.train(u, c, w, epochs)
    return model


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, sample_docs: int = SAMPLE_DOCS, head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for each row."""
    path = path or default_path()
    docs = clean_columns(docs, doc_id=id_col, text=text_col)
    held_out = F.coalesce(remainder(F.col("doc_id"), MODULUS) == HELD_OUT, F.lit(False))
    every = saved(_encoded(docs.withColumn("train", ~held_out), path), "lm-ids")
    encoded = every.where("train")
    words = saved(_word_counts(encoded.select("text")), "lm-counts")
    size = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    train_tokens, distinct = size.n or 0, size.v
    id_counts = _id_counts(encoded)
    # from counts of counts, so that no task sends its own most frequent words; those of one count are taken or left together
    ranked = words.withColumn("h", F.lit((1 << 63) - 1) - F.col("n"))
    frequent = ranked.where(least_hashes(ranked, "h", head)).select("key", "n").collect()  # at most head
    frequent.sort(key=lambda r: r.key)
    keys, numbers = np.array([r.key for r in frequent], dtype=np.int64), np.array([r.n for r in frequent], dtype=np.int64)
    start = fit(distinct_sample(encoded, "text", sample_docs), id_counts, path, usage=_whole_usage(encoded, id_counts))
    model = _paired(_trained(start, encoded), encoded)
    shared = docs.sparkSession.sparkContext.broadcast((model, keys, np.log10(numbers + SMOOTH)))

    kinds = f"row long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, key long, n long, base double, score double"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, keys, logs = shared.value
        row = TaskContext.get().partitionId() << 40
        names = ["row", "doc_id", "key", "n", "base", "score"]
        for batch in slices(batches, 128):
            texts = [t.as_py() for t in batch.column("text")]
            if not texts:
                continue
            ids = np.arange(row, row + len(texts))
            row += len(texts)
            tokens, known, base, tails = [], [], [], []
            for i, text in enumerate(texts):
                found, n = np.unique(np.append(word_hashes(text or "").view(np.int64), END_WORD), return_counts=True)
                at = np.searchsorted(keys, found)
                at[at == len(keys)] = 0
                hit = keys[at] == found if len(keys) else np.zeros(len(found), dtype=bool)
                tokens.append(int(n.sum()))
                known.append(int(n[hit].sum()))
                base.append(float((n[hit] * logs[at[hit]]).sum()) if hit.any() else 0.0)
                tails.append((np.full(int((~hit).sum()), ids[i]), found[~hit], n[~hit]))
            scores = model.log10(list(_ids_of([batch])))
            # a row's own numbers have no key's word count: known words of the head stand in its key
            yield pa.RecordBatch.from_arrays([pa.array(ids), batch.column("doc_id"), pa.array(known, pa.int64()), pa.array(tokens, pa.int64()), pa.array(base, pa.float64()), pa.array(scores, pa.float64())], names)
            at, key, n = (np.concatenate([t[k] for t in tails]) for k in range(3))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.nulls(len(at), batch.column("doc_id").type), pa.array(key), pa.array(n.astype(np.int64)), pa.nulls(len(at), pa.float64()), pa.nulls(len(at), pa.float64())], names)

    made = saved(every.select("doc_id", "text", "ids").mapInArrow(scan, kinds), "lm-rows")
    rare = made.where("score is null").select("row", "key", "n").join(words.select("key", F.col("n").alias("c")), "key", "left")
    found = F.coalesce("c", F.lit(0))
    rare = rare.groupBy("row").agg(F.sum(F.col("n") * F.log10(found + SMOOTH)).alias("rare_base"), F.sum(F.when(found > 0, F.col("n")).otherwise(0)).alias("rare_known"))
    whole = made.where("score is not null").join(rare, "row", "left")
    scale = float(np.log10(train_tokens + SMOOTH * (distinct + 1)))
    return whole.select(
        "doc_id", held_out.alias("held_out"), F.col("n").alias("n_tokens"), (F.col("key") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n") * F.lit(scale)).alias("base_score"), "score",
    )
