"""Exact top-k inner products by branch and bound over ball trees, one tree per shard.

Components x become floor(256 * x). Vectors are dealt into shards of about `SHARD` by a hash of their id, apart by
dimension. A task turns a shard into a ball tree: nodes halve their points along the longest spread, each with its centre
and radius. For a query q no point of a node scores above q . centre + |q| * radius. Queries come in blocks of about
`BLOCK`. Each block first searches one home shard; the k-th scores found there are exact lower bounds and go with the
block to all shards, `GROUP` of them a task. There the shards follow each other, and the k-th score so far goes from one
to the next. Nodes are taken by falling bound, and a search ends at the first node whose bound is below the k-th score.

Scores are whole numbers; products are taken in doubles where all partial sums are exact, else in 64-bit integers.
Ties go to the smaller id. Defined results: vectors that are null, or hold a null or non-finite component, take no part,
nor do rows without id; vectors of different length never meet; empty vectors score 0 among themselves; rows with equal
ids are candidates each, but a query never finds its own id, and a repeated query row counts once; other columns are
ignored; an empty table gives an empty table. Components beyond 2^31 / 256 in size raise an error.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefolio.session import written

SHARD, BLOCK, GROUP, LEAF = 8192, 2048, 4, 128
EXACT = float(1 << 53)
NONE = -(1 << 63)
LIMIT = 1 << 31


class Ball:
    """A ball tree over integer vectors; leaves are runs of the permuted rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        spans, children, stack = [], [], [(0, len(ids), -1)]
        while stack:
            a, b, parent = stack.pop()
            node = len(spans)
            spans.append((a, b))
            children.append([])
            if parent >= 0:
                children[parent].append(node)
            own = vectors[order[a:b]].astype(np.float64)
            if b - a > leaf and own.shape[1]:
                axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                middle = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(own[:, axis], middle)]
                stack += [(a, a + middle, node), (a + middle, b, node)]
        self.ids, self.vectors, self.spans, self.children = ids[order], vectors[order], spans, children
        f = self.vectors.astype(np.float64)
        self.centres = np.array([f[a:b].mean(axis=0) for a, b in spans]).reshape(len(spans), -1)
        self.radii = np.array([np.sqrt(((f[a:b] - c) ** 2).sum(axis=1).max()) for (a, b), c in zip(spans, self.centres, strict=True)])
        self.largest = float(np.abs(f).max(initial=0))
        self.floats = f

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bounds (queries x nodes), a little above to allow for rounding."""
        length = np.sqrt((queries ** 2).sum(axis=1))
        top = queries @ self.centres.T + length[:, None] * self.radii[None, :]
        return top + 1e-9 * (np.abs(top) + length[:, None] * (self.radii + np.sqrt((self.centres ** 2).sum(axis=1)))) + 1e-6

    def search(self, query_id: int, query: np.ndarray, top: np.ndarray, k: int, best: list[tuple[int, int]], least: int) -> None:
        """Better `best`, a heap of (score, -id) with the worst first; scores below `least` cannot count any more. A node
        or point at the k-th score itself may still hold a smaller id."""
        exact = self.largest * float(np.abs(query).max(initial=0)) * max(1, len(query)) < EXACT
        floats = query.astype(np.float64)
        nodes = [(-top[0], 0)]
        while nodes:
            bound, node = heapq.heappop(nodes)
            if -bound < least:
                return
            if self.children[node]:
                for child in self.children[node]:
                    if top[child] >= least:
                        heapq.heappush(nodes, (-top[child], child))
                continue
            a, b = self.spans[node]
            scores = (self.floats[a:b] @ floats).astype(np.int64) if exact else self.vectors[a:b] @ query
            for i in np.flatnonzero(scores >= least):
                found = (int(scores[i]), -int(self.ids[a + i]))
                if found[1] == -query_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
                if len(best) == k:
                    least = max(least, best[0][0])


def whole_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, v): integer vectors of the rows that take part."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = table.where(F.col(id_col).isNotNull() & x.isNotNull() & finite)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.size(x).alias("dim"),
                       F.transform(x, lambda c: F.floor(c.cast("double") * 256)).alias("v"))


def packed(vectors: DataFrame, key: Column, name: str) -> DataFrame:
    """One row per (dim, `name`): ids and vectors as bytes, in id order."""

    def pack(table: pa.Table) -> pa.Table:
        ids, dim = table["id"].to_numpy(), table["dim"][0].as_py()
        flat = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        if flat.max(initial=0) >= LIMIT or flat.min(initial=0) <= -LIMIT:
            raise ValueError("a component is too large for exact scores")
        order = np.argsort(ids, kind="stable")
        return pa.table({"dim": pa.array([dim], pa.int32()), name: table[name].slice(0, 1),
                         "ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
                         "m": pa.array([flat.reshape(len(ids), dim)[order].astype("<i4").tobytes()], pa.binary())})

    return vectors.select("dim", key.cast("int").alias(name), "id", "v").groupBy("dim", name).applyInArrow(
        pack, f"dim int, {name} int, ids binary, m binary")


def _unpacked(table: pa.Table, i: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(table["ids"][i].as_py(), "<i8")
    return ids, np.frombuffer(table["m"][i].as_py(), "<i4").reshape(len(ids), table["dim"][i].as_py()).astype(np.int64)


def _searched(shards: pa.Table, blocks: pa.Table, k: int) -> list[tuple[int, list[tuple[int, int]], int]]:
    """(query, its best points in these shards, the bound it came with) of all blocks."""
    if not len(blocks) or not len(shards):
        return []
    bests, queries = [], []
    for j in range(len(blocks)):
        ids, vectors = _unpacked(blocks, j)
        bounds = np.frombuffer(blocks["least"][j].as_py(), "<i8") if blocks["least"][j].as_py() is not None else None
        for i in range(len(ids)):
            queries.append((int(ids[i]), vectors[i], int(bounds[i]) if bounds is not None else NONE))
            bests.append([])
    matrix = np.array([q for _, q, _ in queries], np.float64).reshape(len(queries), -1)
    for s in range(len(shards)):
        tree = Ball(*_unpacked(shards, s))
        top = tree.bounds(matrix)
        for i, (query_id, query, least) in enumerate(queries):
            kth = bests[i][0][0] if len(bests[i]) == k else NONE
            tree.search(query_id, query, top[i], k, bests[i], max(least, kth))
    return [(query_id, best, least) for (query_id, _, least), best in zip(queries, bests, strict=True)]


def _renamed(df: DataFrame) -> DataFrame:
    """The same columns under new identities, for joins of tables with a common origin."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def top_k(table: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The `k` best candidates of `table` for each row of `queries`: query_id, rank, `id_col`, score."""
    points = whole_vectors(table, id_col, vector_col)
    asked = whole_vectors(queries, id_col, vector_col).groupBy("id").agg(
        F.min(F.struct("dim", "v")).alias("x")).select("id", "x.dim", "x.v")
    n_shards = max(1, -(-points.count() // SHARD))
    n_blocks = max(1, -(-asked.count() // BLOCK))
    n_groups = -(-n_shards // GROUP)
    shards = written(packed(points, F.pmod(F.xxhash64("id"), F.lit(n_shards)), "shard"), "ball-shards")
    blocks = written(packed(asked, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_blocks)), "block"), "ball-blocks")

    def pilot(shards: pa.Table, blocks: pa.Table) -> pa.Table:
        found = _searched(shards, blocks, k)
        least = np.array([best[0][0] if len(best) == k else NONE for _, best, _ in found], "<i8")
        made = [least.tobytes()] if found else []
        return pa.table({"dim": blocks["dim"].slice(0, len(made)).cast(pa.int32()), "block": blocks["block"].slice(0, len(made)),
                         "least": pa.array(made, pa.binary())})

    def search(shards: pa.Table, blocks: pa.Table) -> pa.Table:
        rows = [(q, -i, s) for q, best, _ in _searched(shards, blocks, k) for s, i in best]
        q, i, s = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "id": pa.array(i, pa.int64()), "score": pa.array(s, pa.int64())})

    home = blocks.withColumn("shard", F.pmod(F.col("block"), F.lit(n_shards))).withColumn("least", F.lit(None).cast("binary"))
    homes = home.select("dim", "shard", "block").distinct().join(shards, ["dim", "shard"])
    bounds = _renamed(homes).groupBy("dim", "block").cogroup(home.groupBy("dim", "block")).applyInArrow(
        pilot, "dim int, block int, least binary")
    everywhere = blocks.join(bounds, ["dim", "block"], "left").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("part"))
    trees = shards.select("*", F.pmod(F.col("shard"), F.lit(n_groups)).alias("part"),
                          F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
    found = _renamed(trees).groupBy("dim", "part", "block").cogroup(everywhere.groupBy("dim", "part", "block")).applyInArrow(
        search, "query_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id"))
    return found.select("query_id", rank.alias("rank"), F.col("id").alias(id_col), "score").where(F.col("rank") <= k)
