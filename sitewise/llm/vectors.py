"""Embedding near-dedup with randomised-rotation binary codes.

Each vector, scaled to length one and rotated by one random orthogonal matrix, is kept as the signs of its coordinates and
one correction factor: the inner product of the vector with its code. The inner product of a code with another
rotated vector, divided by that factor, estimates the cosine without bias, and the factor also bounds its error.
Only pairs whose upper bound reaches the threshold are computed again, exactly, in double precision.

Two bounds hold for each code: the usual confidence bound, and one that is certain: vectors of cosine >= t are at most
sqrt(2 - 2t) apart, so the estimate of a linked pair is at least 1 - sqrt(2 - 2t) / factor. The wider margin is used,
so that no link is lost to chance.

Vectors are compared within a label and dimension only. Equal vectors become one node with a count before anything is
compared. The nodes of a label are dealt into blocks by their nearest of a few pivots, and pairs of blocks are
compared unless the pivots' angles show that no link can cross them. Codes and factors of one block meet the vectors of the other; the vectors of
both meet for the rows that this leaves undecided alone, in strips of STRIP rows. A pair of blocks leaves counts and at
most one edge for each row and cell of links, never all pairs: n_links is a sum, and components need a spanning forest.

Vectors that are null, empty or zero, or hold null or non-finite components, and those of a null label, link with
nothing; they are components of their own. Repeated rows are equal vectors. A null id has no component and is kept.
An empty table gives an empty result. Columns other than the three named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.llm.common import clean_columns, saved
from sitewise.llm.graph import components

COSINE, BLOCK, PIVOTS, SEED = 0.98, 1024, 16, 20240229
#: Rows of a block that are compared at a time, so that what a task holds doesn't grow with how many pairs are near.
STRIP = 128
#: Standard errors of the confidence bound.
SURE = 3.0


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng((seed, dim)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


class Codes:
    """Sign codes of rotated unit vectors as packed bits, and the correction factor of each."""

    def __init__(self, dim: int, bits: np.ndarray, factor: np.ndarray):
        self.dim, self.bits, self.factor = dim, bits, factor

    @staticmethod
    def of(unit: np.ndarray) -> Codes:
        turned = rotated(unit)
        return Codes(unit.shape[1], np.packbits(turned >= 0, axis=1), np.abs(turned).sum(1) / np.float32(np.sqrt(unit.shape[1])))

    @staticmethod
    def read(dim: int, bits: bytes, factor: bytes) -> Codes:
        return Codes(dim, np.frombuffer(bits, dtype=np.uint8).reshape(-1, -(-dim // 8)), np.frombuffer(factor, dtype=np.float32))

    def signs(self) -> np.ndarray:
        return np.unpackbits(self.bits, axis=1, count=self.dim).astype(np.float32) * 2 - 1


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled by their largest component first, so that no square of a very small or large one is lost."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def rotated(unit: np.ndarray) -> np.ndarray:
    return (unit @ rotation(unit.shape[1])).astype(np.float32)


def estimates(queries: np.ndarray, codes: Codes) -> np.ndarray:
    """Unbiased estimates of all cosines of rotated queries with coded vectors."""
    return queries @ (codes.signs().T / (np.float32(np.sqrt(codes.dim)) * codes.factor))


def margins(codes: Codes, cosine: float = COSINE, sure: float = SURE) -> np.ndarray:
    """What to add to an estimate for its upper bound: the confidence bound, or the certain one where that is wider."""
    likely = sure * np.sqrt(np.maximum(0, 1 - codes.factor**2)) / codes.factor / np.sqrt(max(1, codes.dim - 1))
    certain = cosine - 1 + np.sqrt(2 - 2 * cosine) / codes.factor
    return np.maximum(likely, certain) + 1e-4


def undecided(queries: np.ndarray, codes: Codes, cosine: float = COSINE) -> tuple[np.ndarray, np.ndarray]:
    """Which rotated queries, and which coded vectors, are in a pair whose upper bound reaches the cosine: only those are compared exactly."""
    bound = margins(codes, cosine)[None, :]
    rows, columns = np.zeros(len(queries), dtype=bool), np.zeros(len(codes.factor), dtype=bool)
    for k in range(0, len(queries), STRIP):
        near = estimates(queries[k : k + STRIP], codes) + bound >= cosine
        rows[k : k + STRIP] = near.any(1)
        columns |= near.any(0)
    return np.flatnonzero(rows), np.flatnonzero(columns)


def links(a: np.ndarray, b: np.ndarray, cosine: float = COSINE) -> Iterator[tuple[int, np.ndarray]]:
    """(first row of a strip, which of its rows are linked with which of b), strip by strip, decided in double precision."""
    for k in range(0, len(a), STRIP):
        yield k, a[k : k + STRIP] @ b.T >= cosine


def forest(pairs: np.ndarray, n: int) -> np.ndarray:
    """A spanning forest of the pairs over n vertices: at most n - 1 edges (root, vertex)."""
    root = np.arange(n)
    while len(pairs):
        low = root.copy()
        np.minimum.at(low, pairs[:, 0], root[pairs[:, 1]])
        np.minimum.at(low, pairs[:, 1], root[pairs[:, 0]])
        np.minimum.at(low, root, low.copy())
        low = low[root]
        while (low != low[low]).any():
            low = low[low]
        if (low == root).all():
            break
        root = low
    at = np.flatnonzero(root != np.arange(n))
    return np.stack([root[at], at], 1)


def _stack(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def near_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """For each row: vec_id, n_links (other rows linked directly), component_id (the least vec_id reachable), kept."""
    rows = clean_columns(table, vec_id=id_col, vector=vector_col, label=label_col).withColumn("vector", F.col("vector").cast("array<double>"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = F.col("label").isNotNull() & (F.size("vector") > 0) & ~F.exists("vector", bad) & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False))).withColumn("node", F.when(F.col("usable"), F.xxhash64("label", "vector")))
    keyed = saved(rows.select("vec_id", "node"), "vectors-rows")

    # One row for each different vector of a label; copies are counted before the shuffle.
    nodes = rows.where("usable").groupBy("node", "label", "vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    nodes = saved(nodes.withColumn("dim", F.size("vector")), "vectors-nodes")
    blocks = saved(_blocks(nodes, block), "vectors-blocks")

    # Which blocks can hold a link between them: descriptions only, a row for each block.
    about = blocks.select("label", "dim", "block", "pivot", "radius", "center")
    left = about.select("label", "dim", *(F.col(c).alias(f"{c}_a") for c in ("block", "radius", "center")))
    right = about.select("label", "dim", *(F.col(c).alias(f"{c}_b") for c in ("block", "radius", "center")))
    dot = F.aggregate(F.zip_with("center_a", "center_b", lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    apart = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot)))
    tasks = left.join(right, ["label", "dim"]).where("block_a <= block_b").where(apart <= F.col("radius_a") + F.col("radius_b") + float(np.arccos(cosine)) + 1e-6)
    tasks = tasks.select("block_a", "block_b")

    # First codes and factors of one block meet the vectors of the other; of those only the undecided rows go on, to meet the coded block's vectors.
    coded = blocks.select(F.col("block").alias("block_b"), "codes", "factors")
    queries = blocks.select(F.col("block").alias("block_a"), "dim", *(F.col(c).alias(f"{c}_a") for c in ("nodes", "vectors", "copies")))
    kinds = [("block_a", pa.int64()), ("block_b", pa.int64()), ("dim", pa.int32()), *((c, pa.binary()) for c in ("columns", "nodes_a", "vectors_a", "copies_a"))]

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            vectors = _matrix(row["vectors_a"], row["dim"])
            rows, columns = undecided(rotated(vectors), Codes.read(row["dim"], row["codes"], row["factors"]), cosine)
            if len(rows):
                nodes, copies = (np.frombuffer(row[c], dtype=np.int64)[rows].tobytes() for c in ("nodes_a", "copies_a"))
                out = {"block_a": row["block_a"], "block_b": row["block_b"], "dim": row["dim"], "columns": columns.astype(np.int32).tobytes(), "nodes_a": nodes, "vectors_a": vectors[rows].tobytes(), "copies_a": copies}
                yield pa.RecordBatch.from_pylist([out], pa.schema(kinds))

    undecided_rows = tasks.join(queries, "block_a").join(coded, "block_b").mapInArrow(estimate, "block_a long, block_b long, dim int, columns binary, nodes_a binary, vectors_a binary, copies_a binary")
    whole = blocks.select(*(F.col(c).alias(f"{c}_b") for c in ("block", "nodes", "vectors", "copies")))
    pairs = undecided_rows.join(whole, "block_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            yield pa.RecordBatch.from_pandas(_compare(row, cosine), preserve_index=False)

    found = saved(pairs.mapInArrow(compare, "a long, b long, links long"), "vectors-found")
    counts = found.where("links is not null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    label = components(found.where("links is null").select("a", "b"))

    # A component's least id is that of all its nodes.
    named = nodes.select("node", "least", "copies").join(label.withColumnRenamed("vertex", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = saved(named.groupBy("component").agg(F.min("least").alias("component_id")), "vectors-least")
    named = named.join(least, "component").join(counts, "node", "left")
    named = saved(named.select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vectors-named")
    good = keyed.where("node is not null").join(named, "node").select("vec_id", "n_links", "component_id")
    rest = keyed.where("node is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    return good.unionByName(rest).select(
        "vec_id", F.col("n_links").cast("long").alias("n_links"), F.col("component_id").cast("long").alias("component_id"), F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _blocks(nodes: DataFrame, block: int) -> DataFrame:
    """Nodes of a label and nearest pivot, dealt into blocks of about so many: packed vectors and what bounds their angles.

    A label has as many pivots as it would fill blocks, up to PIVOTS, and beyond that salts; so a cell holds PIVOTS blocks
    at most, however a label's vectors lie.
    """
    sizes = nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    dealt = nodes.join(sizes, ["label", "dim"])
    kind = "node long, label string, dim int, vector array<double>, copies long, pivot int, salt int"
    label_type = nodes.schema["label"].dataType.simpleString()
    kind = kind.replace("label string", f"label {label_type}")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            pivot, salt = np.zeros(len(dims), np.int32), np.zeros(len(dims), np.int32)
            n, node = batch.column("n").to_numpy(), batch.column("node").to_numpy()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = unit_rows(_stack(batch.column("vector").take(pa.array(at))))
                used = np.arange(PIVOTS)[None, :] < -(-n[at] // block)[:, None]
                pivot[at] = np.argmax(np.where(used, x @ pivots(int(d)).T, -np.inf), 1)
            salt[:] = (node & 0x7FFFFFFF) % np.maximum(1, -(-n // (block * PIVOTS)))
            kept = [batch.column(c) for c in ("node", "label", "dim", "vector", "copies")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(pivot), pa.array(salt)], ["node", "label", "dim", "vector", "copies", "pivot", "salt"])

    cells = dealt.mapInArrow(assign, kind)

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        # a cell holds about a block; what it holds beyond is cut into further blocks
        x = np.array(pdf["vector"].tolist(), dtype=np.float64)
        unit = unit_rows(x)
        out = []
        for k in range(0, len(x), 2 * block):
            part, u = slice(k, k + 2 * block), unit[k : k + 2 * block]
            center = u.mean(0)
            center = center / np.linalg.norm(center) if np.linalg.norm(center) > 0 else u[0]
            radius = float(np.arccos(np.clip(u @ center, -1, 1)).max())
            radius = radius if np.isfinite(radius) else float(np.pi)  # compared with all, rather than with none
            node, codes = pdf["node"].to_numpy()[part], Codes.of(u)
            blocks = (node.tobytes(), u.tobytes(), codes.bits.tobytes(), codes.factor.astype(np.float32).tobytes(), pdf["copies"].to_numpy()[part].tobytes())
            out.append((int(node.min()), pdf["label"].iloc[0], int(pdf["dim"].iloc[0]), int(pdf["pivot"].iloc[0]), radius, center.tolist(), *blocks))
        return pd.DataFrame(out, columns=["block", "label", "dim", "pivot", "radius", "center", "nodes", "vectors", "codes", "factors", "copies"])

    schema = f"block long, label {label_type}, dim int, pivot int, radius double, center array<double>, nodes binary, vectors binary, codes binary, factors binary, copies binary"
    return cells.groupBy("label", "dim", "pivot", "salt").applyInPandas(packed, schema)


def pivots(dim: int, n: int = PIVOTS) -> np.ndarray:
    x = np.random.default_rng((SEED, dim, n)).standard_normal((n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time: each holds whole blocks."""
    for batch in batches:
        for r in range(batch.num_rows):
            yield batch.slice(r, 1).to_pylist()[0]


def _matrix(data: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(data).reshape(-1, dim)


def _compare(row: dict, cosine: float) -> pd.DataFrame:
    """Counts (a, null, links) of the undecided rows of two blocks, and edges (a, b, null) of a spanning forest of their links."""
    to = np.frombuffer(row["columns"], dtype=np.int32)
    na, copies_a = (np.frombuffer(row[f"{c}_a"], dtype=np.int64) for c in ("nodes", "copies"))
    nb, copies_b = (np.frombuffer(row[f"{c}_b"], dtype=np.int64)[to] for c in ("nodes", "copies"))
    a, b = _matrix(row["vectors_a"], row["dim"]), _matrix(row["vectors_b"], row["dim"])[to]
    same = row["block_a"] == row["block_b"]
    names, place = np.unique(np.concatenate([na, nb]), return_inverse=True)
    here, there, edges = np.zeros(len(na), np.int64), np.zeros(len(nb), np.int64), np.zeros((0, 2), np.int64)
    for k, near in links(a, b, cosine):
        part = slice(k, k + len(near))
        if same:
            near &= na[part, None] != nb[None, :]
        here[part] = near @ copies_b
        if not same:
            there += copies_a[part] @ near
        i, j = np.nonzero(near)
        # of each strip only what joins trees is kept
        edges = forest(np.concatenate([edges, np.stack([place[k + i], place[len(na) + j]], 1)]), len(names))
    links_of = np.concatenate([here, there])
    some = np.flatnonzero(links_of)
    n = len(some)
    return pd.DataFrame({"a": np.concatenate([np.concatenate([na, nb])[some], names[edges[:, 0]]]), "b": pd.array([None] * n + names[edges[:, 1]].tolist(), "Int64"), "links": pd.array(links_of[some].tolist() + [None] * len(edges), "Int64")})
