import hashlib
import random
import zlib

import numpy as np
import pytest

from sitewise.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """All nodes of the contract, from whole sequences."""
    convs, kids, nodes, totals, out = {}, {}, {}, {}, []
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    built = {c: convs.get(c - c % 100, [])[: zlib.crc32(str(c).encode()) % 6] + v[zlib.crc32(str(c).encode()) % 6 :] for c, v in convs.items()}
    for c, v in built.items():
        for d in range(len(v) + 1):
            nodes.setdefault(tuple(v[:d]), []).append(c)
    for n in nodes:
        if n:
            kids.setdefault(n[:-1], []).append(n)
    for n in sorted(nodes, key=len, reverse=True):
        below = kids.get(n, [])
        totals[n] = (sum(totals[k][0] for k in below) or 1, sum(totals[k][1] for k in below) + ((len(nodes[n]) - 1) * len(n[-1][1]) if n else 0))
        ends = ",".join(str(c) for c in sorted(c for c in nodes[n] if len(built[c]) == len(n)))
        out.append((min(nodes[n]), len(n), min(nodes[n[:-1]]) if n else None, len(nodes[n]), len(below), *totals[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, local_nodes=P.LOCAL_NODES):
    got = P.prefix_trie(spark.createDataFrame(rows, SCHEMA), local_nodes).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_given_table_with_splits_in_joins_and_in_tasks(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    want = brute(map(tuple, turns.select("conv_id", "turn", "role", "text").collect()))
    for local_nodes in (5, P.LOCAL_NODES):
        assert sorted(map(tuple, P.prefix_trie(turns, local_nodes).collect()), key=str) == want


def test_nulls_ties_repeats_and_a_third_in_one_group(spark):
    r = random.Random(3)
    rows = [(c, t, "u", r.choice("abc")) for c in range(190, 320) for t in range(r.randrange(5))]  # few different turns, so conversations share prefixes
    rows += [(c, t, "u", "hot") for c in range(400, 460) for t in range(7)]  # a group of copies
    rows += [(7, t % 40, "u", "x" * (t % 3)) for t in range(150)]  # a long conversation with ties and repeated rows
    rows += [(None, 1, "u", "lost"), (8, None, "u", "z"), (8, None, None, None), (8, 0, "", ""), (-150, 1, "u", "a"), (-100, 1, "u", "b"), (9, 1, "u", "long " * 40_000)]
    check(spark, rows, 20)


def test_empty_table_and_clashing_columns(spark):
    assert P.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(100, 0, "u", "a", 1, 2, 3), (101, 0, "u", "b", 1, 2, 3)]
    got = P.prefix_trie(spark.createDataFrame(rows, SCHEMA + ", depth int, n0 int, at int")).collect()
    assert sorted(map(tuple, got), key=str) == brute([x[:4] for x in rows])


def test_ids_of_many_pieces_have_one_digest(spark):
    ids = [*range(-5000, 9000, 7), 10**15]
    paths = spark.createDataFrame([(c, 0, 0, 0, 0) for c in ids], "conv_id long, depth long, n0 long, n1 long, length long")
    assert P.end_digests(paths.repartition(5)).first().ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest"])
def test_totals_by_centroids_equal_plain_sums(shape):
    r, n = random.Random(5), 700
    up = {"chain": lambda i: i - 1, "star": lambda i: 0, "random": lambda i: r.randrange(i), "forest": lambda i: i - 1 if i % 50 else -1}[shape]
    parent = np.array([-1, *(up(i) for i in range(1, n))])
    depth = np.zeros(n, dtype=int)
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1 if parent[i] >= 0 else 0
    values = np.array([[r.randrange(9), i] for i in range(n)])
    want, weight = values.copy(), np.array([r.randrange(1, 9) for _ in range(n)])
    for i in range(n - 1, 0, -1):
        if parent[i] >= 0:
            want[parent[i]] += want[i]
            weight[parent[i]] += weight[i]
    assert (P.decomposed(parent, depth, weight, values) == want).all()
