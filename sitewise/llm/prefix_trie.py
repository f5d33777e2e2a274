"""The trie of conversation prefixes, with totals of each subtree by centroid decomposition.

Conversations are rebuilt from the first turns of another one (shared) and their own later turns. A prefix's node is told by its depth and 128 bits: turns are
hashed with their place, and a prefix is the exclusive or of its turns' hashes, so that running values in blocks of turns give all prefixes, a prefix's parent
is that value less its last turn, and no text goes beyond the first shuffle. A node's members, smallest member and weight are aggregated before they are shuffled,
so that a first turn that a third of all conversations share is like any other.

Totals of subtrees come from the parent edges. The forest is split recursively: a component's centroid is its deepest node that holds at least half of its
weight; the centroid's total, over what hangs below it in the component, is added to each node on the path from the centroid to the component's top, and what is
left is one component above the centroid and one for each of its children there. A node's weight is the number of members of all nodes below it, which members' lengths give
without a rollup, and each split halves it, so the rounds are the logarithm of the number of turns. While a component has more than LOCAL_NODES nodes, a round is joins over
the nodes of such components alone: a node's ancestor at the centroid's depth is the prefix of that depth of its smallest member. Smaller components are
grouped into tasks and finished there, all of a batch in each round.

Rows are ordered by turn, null first; of equal turns, by role and the first TIE_CHARS characters of role and text, then by hash, so repeated rows are turns of their own.
Null roles and texts count as empty; rows without a conv_id are left out; whole texts are hashed, however long. A conversation with very many turns is split by ranges
of them. An empty table gives no node. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewise.llm.common import clean_columns, saved

#: Conversation c takes its first crc32(c) % MOST_SHARED turns from the first one of its SHARED_BLOCK.
SHARED_BLOCK, MOST_SHARED = 100, 6
TIE_CHARS = 64
#: Turns of a conversation whose running values are made in one group.
BLOCK_TURNS = 1024
#: Components of at most so many nodes are finished inside a task.
LOCAL_NODES = 4096
#: Ids that one piece of a digest can hold.
DIGEST_IDS = 4096
_NODE = ("depth", "n0", "n1")
_TOP = ("top_depth", "top0", "top1")
_VALUES = ("leaf", "saving")


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, at (from 1), t0 and t1 (a turn's hash) and chars of each row, in the order of turns; rows of one conversation may be in many tasks."""
    named = clean_columns(turns, conv_id="conv_id", turn="turn", role="role", text="text").where("conv_id is not null")
    role, text = F.coalesce("role", F.lit("")).cast("string"), F.coalesce("text", F.lit("")).cast("string")
    both = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)  # no two different turns give one string
    digest = F.sha2(both.cast("binary"), 256)
    part = lambda i: F.conv(F.substring(digest, i, 15), 16, 10).cast("long")
    rows = named.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.substring(F.concat(role, F.lit("\0"), text), 1, TIE_CHARS).alias("tie"),
        part(1).alias("t0"), part(16).alias("t1"), F.length(text).cast("long").alias("chars"),
    )
    order = [F.col("turn").asc_nulls_first(), "tie", "t0", "t1"]
    ranged = saved(rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "trie-turns")
    counts = ranged.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.row_number().over(W.partitionBy("conv_id", "part").orderBy(*order))
    return ranged.withColumn("inside", inside).join(before, ["conv_id", "part"]).select("conv_id", (F.col("before") + F.col("inside")).alias("at"), "t0", "t1", "chars")


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, at, t0, t1, chars of the rebuilt conversations, and a row with at 0 for each of them, with its number of turns (length) on every row."""
    own = saved(numbered_turns(turns), "trie-numbered")
    lengths = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    share = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED
    convs = lengths.select("conv_id", "n", share.alias("h"), (F.col("conv_id") - F.col("conv_id") % SHARED_BLOCK).alias("base"))
    first = F.sort_array(F.collect_list(F.struct("at", "t0", "t1", "chars")))  # fewer than MOST_SHARED turns
    heads = own.where(F.col("at") < MOST_SHARED).where(F.col("conv_id") % SHARED_BLOCK == 0).groupBy(F.col("conv_id").alias("base")).agg(first.alias("head"))
    convs = convs.join(heads, "base", "left").withColumn("head", F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), F.array().cast(heads.schema["head"].dataType)))
    convs = convs.withColumn("shared", F.size("head").cast("long")).withColumn("length", F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = saved(convs.select("conv_id", "h", "shared", "length", "head"), "trie-conversations")
    none = F.lit(0).cast("long")
    tops = convs.select("conv_id", none.alias("at"), none.alias("t0"), none.alias("t1"), none.alias("chars"), "length")
    shared = convs.select("conv_id", "length", F.explode("head").alias("x")).select("conv_id", "x.at", "x.t0", "x.t1", "x.chars", "length")
    later = own.join(convs.select("conv_id", "h", "shared", "length"), "conv_id").where("at > h")
    later = later.select("conv_id", (F.col("at") - F.col("h") + F.col("shared")).alias("at"), "t0", "t1", "chars", "length")
    return tops.unionByName(shared).unionByName(later)


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, n0 and n1 (the node of that prefix), p0 and p1 (its parent's, null at depth 0), chars and length: a row for each prefix of each conversation."""
    placed = lambda a, b: F.when(F.col("at") == 0, F.lit(0)).otherwise(F.xxhash64("at", a, b))
    rows = rebuilt(turns).select("conv_id", "at", "chars", "length", placed("t0", "t1").alias("g0"), placed("t1", "t0").alias("g1"), F.shiftright("at", 10).alias("block"))
    assert BLOCK_TURNS == 1 << 10
    rows = saved(rows, "trie-rebuilt")
    blocks = rows.groupBy("conv_id", "block").agg(F.bit_xor("g0").alias("g0"), F.bit_xor("g1").alias("g1"))
    along = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)  # a row for each BLOCK_TURNS turns
    blocks = blocks.select("conv_id", "block", *(F.coalesce(F.bit_xor(c).over(along), F.lit(0)).alias(c.replace("g", "b")) for c in ("g0", "g1")))
    inside = W.partitionBy("conv_id", "block").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({c.replace("g", "i"): F.bit_xor(c).over(inside) for c in ("g0", "g1")}).join(blocks, ["conv_id", "block"])
    node = {f"n{k}": F.col(f"b{k}").bitwiseXOR(F.col(f"i{k}")) for k in (0, 1)}
    parent = {f"p{k}": F.when(F.col("at") > 0, node[f"n{k}"].bitwiseXOR(F.col(f"g{k}"))) for k in (0, 1)}
    return rows.select("conv_id", F.col("at").alias("depth"), *(x.alias(c) for c, x in (node | parent).items()), "chars", "length")


def nodes_of(paths: DataFrame) -> DataFrame:
    """A row for each node: its parent, conv_id (the smallest member), n_convs, chars of its last turn, and weight (members of all nodes of its subtree)."""
    return paths.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars"), F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
        F.min("p0").alias("p0"), F.min("p1").alias("p1"),
    )


def decomposed(parent: np.ndarray, depth: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The sums of values (rows by columns) over each row's subtree, by centroid decomposition.

    parent has each row's parent, -1 above a component's top; weight is positive and sums over the subtree. All components are split at once, so the rounds are the logarithm
    of the largest weight.
    """
    weight, total, gone, here = weight.copy(), np.zeros_like(values), np.zeros(len(parent), dtype=bool), np.arange(len(parent))

    def tops() -> np.ndarray:
        """The highest row that each row reaches without going over a removed one."""
        up = np.where((parent < 0) | gone[parent] | gone, here, parent)
        while not ((above := up[up]) == up).all():
            up = above
        return up

    top = tops()
    while not gone.all():
        live = np.flatnonzero(~gone)
        heavy = live[2 * weight[live] >= weight[top[live]]]
        heavy = heavy[np.lexsort((depth[heavy], top[heavy]))]
        centroid = heavy[np.append(top[heavy][1:] != top[heavy][:-1], True)]  # of each component the deepest row with half of its weight
        centroid_of = np.full(len(parent), -1)
        centroid_of[top[centroid]] = centroid
        mine = centroid_of[top[live]]
        gone[centroid] = True
        after = tops()
        below = (live == mine) | (parent[after[live]] == mine)  # the centroid and the components under it
        sums = np.zeros_like(values)
        np.add.at(sums, mine[below], values[live[below]])
        total[centroid] += sums[centroid]
        now, at = centroid.copy(), np.flatnonzero(centroid != top[centroid])
        while len(at):  # one step up on each component's path from its centroid to its top
            now[at] = parent[now[at]]
            total[now[at]] += sums[centroid[at]]
            weight[now[at]] -= weight[centroid[at]]
            at = at[now[at] != top[centroid[at]]]
        top = after
    return total


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole components, sorted by component: the totals of each node."""

    def totals(rows: pd.DataFrame) -> pa.RecordBatch:
        rows = rows.reset_index(drop=True)
        known = rows[list(_NODE)].assign(at=np.arange(len(rows)), depth=rows["depth"] + 1)
        up = rows[["depth", "p0", "p1"]].merge(known, how="left", left_on=["depth", "p0", "p1"], right_on=list(_NODE))["at"].fillna(-1).to_numpy(dtype=np.int64)
        is_top = (rows[list(_NODE)].to_numpy() == rows[list(_TOP)].to_numpy()).all(axis=1)
        sums = decomposed(np.where(is_top, -1, up), rows["depth"].to_numpy(), rows["weight"].to_numpy(), rows[list(_VALUES)].to_numpy())
        return pa.RecordBatch.from_pandas(rows[list(_NODE)].assign(**{v: rows[f"above_{v}"] + sums[:, i] for i, v in enumerate(_VALUES)}), preserve_index=False)

    held = pd.DataFrame()
    for batch in batches:
        rows = batch.to_pandas()
        held = pd.concat([held, rows], ignore_index=True) if len(held) else rows
        if len(held) >= 4 * LOCAL_NODES:
            last = (held[list(_TOP)] == held[list(_TOP)].iloc[-1]).all(axis=1).to_numpy()  # may go on in the next batch
            if not last.all():
                yield totals(held[~last])
                held = held[last]
    if len(held):
        yield totals(held)


def subtree_totals(nodes: DataFrame, paths: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """depth, n0, n1 and the subtree's sums of leaf and saving of each of the nodes, which have conv_id, p0, p1 and weight too; paths are the prefixes."""
    up = saved(paths.select("conv_id", *_NODE, "p0", "p1"), "trie-paths")
    zero = F.lit(0).cast("long")  # the root is 0, 0, 0
    start = [zero.alias(c) for c in (*(f"above_{v}" for v in _VALUES), *_TOP)]
    state = saved(nodes.select(*_NODE, "conv_id", F.coalesce("p0", zero).alias("p0"), F.coalesce("p1", zero).alias("p1"), "weight", *_VALUES, *start), "trie-state")
    finished, small = [], []
    while True:
        sizes = saved(state.groupBy(*_TOP).agg(F.count(F.lit(1)).alias("size"), F.max("weight").alias("whole")), "trie-components")
        large = sizes.where(F.col("size") > local_nodes).select(*_TOP, "whole")  # at most a row for each local_nodes nodes
        small.append(state.join(large, list(_TOP), "left_anti"))
        if not large.limit(1).count():
            break
        state = state.join(large, list(_TOP))
        heavy = state.where(2 * F.col("weight") >= F.col("whole")).groupBy(*_TOP).agg(F.max_by(F.struct(*_NODE, "conv_id", "weight"), "depth").alias("c"))
        cents = saved(heavy.select(*_TOP, F.col("c.depth").alias("c_depth"), F.col("c.n0").alias("c0"), F.col("c.n1").alias("c1"), F.col("c.conv_id").alias("c_conv"), F.col("c.weight").alias("c_weight")), "trie-centroids")

        # a node's prefix one turn longer than the centroid tells whether it hangs below it, and under which of its children
        child = up.select("conv_id", F.col("depth").alias("child_depth"), F.col("n0").alias("child0"), F.col("n1").alias("child1"), F.col("p0").alias("q0"), F.col("p1").alias("q1"))
        met = state.drop("whole").join(cents, list(_TOP)).withColumn("child_depth", F.when(F.col("depth") > F.col("c_depth"), F.col("c_depth") + 1))
        met = met.join(child, ["conv_id", "child_depth"], "left")
        is_c = (F.col("depth") == F.col("c_depth")) & (F.col("n0") == F.col("c0")) & (F.col("n1") == F.col("c1"))
        is_below = F.coalesce((F.col("q0") == F.col("c0")) & (F.col("q1") == F.col("c1")), F.lit(False))
        met = saved(met.withColumns({"is_c": is_c, "is_below": is_below}), "trie-split")
        sums = met.where("is_c or is_below").groupBy("c_depth", "c0", "c1").agg(*(F.sum(v).alias(f"sum_{v}") for v in _VALUES))
        sums = saved(cents.join(sums, ["c_depth", "c0", "c1"]), "trie-sums")

        done = met.where("is_c").select(*_NODE, *(f"above_{v}" for v in _VALUES)).join(sums.select(F.col("c_depth").alias("depth"), F.col("c0").alias("n0"), F.col("c1").alias("n1"), *(f"sum_{v}" for v in _VALUES)), list(_NODE))
        finished.append(done.select(*_NODE, *((F.col(f"above_{v}") + F.col(f"sum_{v}")).alias(v) for v in _VALUES)))
        onto = up.join(sums.select(F.col("c_conv").alias("conv_id"), "top_depth", "c_depth", "c_weight", *(f"sum_{v}" for v in _VALUES)), "conv_id").where("depth >= top_depth and depth < c_depth")
        onto = onto.select(*_NODE, F.col("c_weight").alias("less"), *(f"sum_{v}" for v in _VALUES))
        rest = met.where("not is_c").join(onto, list(_NODE), "left")
        tops = [F.when(F.col("is_below"), F.col(c)).otherwise(F.col(t)).alias(t) for t, c in zip(_TOP, ("child_depth", "child0", "child1"), strict=True)]
        above = [(F.col(f"above_{v}") + F.coalesce(f"sum_{v}", F.lit(0))).alias(f"above_{v}") for v in _VALUES]
        state = saved(rest.select(*_NODE, "conv_id", "p0", "p1", (F.col("weight") - F.coalesce("less", F.lit(0))).alias("weight"), *_VALUES, *above, *tops), "trie-state")

    pool = small[0]
    for more in small[1:]:
        pool = pool.unionByName(more)
    pool = pool.select(*_NODE, "p0", "p1", "weight", *_VALUES, *(f"above_{v}" for v in _VALUES), *_TOP).repartition(*_TOP).sortWithinPartitions(*_TOP)
    out = pool.mapInArrow(_finish, "depth long, n0 long, n1 long, leaf long, saving long")
    for more in finished:
        out = out.unionByName(more)
    return out


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of texts, sorted by node and place: the SHA-256 of each node's pieces, comma-joined. Only one piece is held at a time."""
    now, digest = None, None
    for batch in batches:
        found: list[tuple] = []
        for *node, piece in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "ids")), strict=True):
            if node == now:
                digest.update(b"," + piece.encode())
            else:
                if now:
                    found.append((*now, digest.hexdigest()))
                now, digest = node, hashlib.sha256(piece.encode())
        yield _digest_batch(found)
    if now:
        yield _digest_batch([(*now, digest.hexdigest())])


def _digest_batch(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], [*_NODE, "ends_sha256"])


def end_digests(paths: DataFrame) -> DataFrame:
    """ends_sha256 of each node at which a conversation ends. Ids are joined in pieces of DIGEST_IDS possible ones, so a node where very many end is a few rows for its digest."""
    ends = paths.where("depth = length")
    assert DIGEST_IDS == 1 << 12
    pieces = ends.groupBy(*_NODE, F.shiftright("conv_id", 12).alias("piece")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    sorted_pieces = pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "piece").select(*_NODE, "ids")
    return sorted_pieces.mapInArrow(_digests, "depth long, n0 long, n1 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths = saved(prefixes(turns), "trie-prefixes")
    nodes = saved(nodes_of(paths), "trie-nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p0").alias("n0"), F.col("p1").alias("n1")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, list(_NODE), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = saved(nodes.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "saving": (F.col("n_convs") - 1) * F.col("chars")}), "trie-nodes")
    totals = subtree_totals(nodes, paths, local_nodes)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("n0").alias("p0"), F.col("n1").alias("p1"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.drop(*_VALUES).join(totals, list(_NODE)).join(end_digests(paths), list(_NODE), "left").join(parents, ["depth", "p0", "p1"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaf").alias("n_leaves"), F.col("saving").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
