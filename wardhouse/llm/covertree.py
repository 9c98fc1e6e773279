"""Exact top-k by inner product: cover trees over queries and over data, searched together."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardhouse.llm.common import written

#: Radii of a node's children are at most its own divided by this.
BASE = 1.6
#: Points of a node that is not divided further.
LEAF = 32
#: Vectors of one data tree and of one query tree, about.
DATA_BLOCK = 2048
QUERY_BLOCK = 512
#: Pivots that group near vectors into blocks, at most; they go through the driver.
PIVOTS = 256
#: Data trees that one task holds at once.
TREES = 16
#: Points scored at once, and queries that go down a data tree together.
CHUNK = 2048
GROUP = 64


@dataclass
class CoverTree:
    """Nodes over points in an order in which every node's points are one range.

    Node k covers points first[k]:last[k]; its centre is the first of them, and
    radius[k] the distance to its farthest. Its children, none for a leaf, are
    the nodes from[k]:to[k]; the first has the same centre.
    """

    points: np.ndarray
    rows: np.ndarray
    ids: np.ndarray
    first: np.ndarray
    last: np.ndarray
    radius: np.ndarray
    child_from: np.ndarray
    child_to: np.ndarray

    @classmethod
    def build(cls, points: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> CoverTree:
        """Divide every node into centres farther apart than its radius over BASE, each with
        the points that come first within that reach of it."""
        points = np.asarray(points, float)
        order = np.arange(len(points))
        away = np.sqrt(((points - points[0]) ** 2).sum(1))
        nodes = [[0, len(points), float(away.max()), 0, 0]]
        at = 0
        while at < len(nodes):
            first, last, radius = nodes[at][:3]
            if last - first > LEAF and radius > 0:
                reach, left = radius / BASE, order[first:last]
                groups = []
                while len(left):
                    gap = np.sqrt(((points[left] - points[left[0]]) ** 2).sum(1))
                    near = gap <= reach
                    near[0] = True
                    groups.append((left[near], float(gap[near].max())))
                    left = left[~near]
                order[first:last] = np.concatenate([g for g, _ in groups])
                nodes[at][3] = len(nodes)
                for group, wide in groups:
                    nodes.append([first, first + len(group), wide, 0, 0])
                    first += len(group)
                nodes[at][4] = len(nodes)
            at += 1
        start, end, radius, low, high = (np.array(c) for c in zip(*nodes, strict=True))
        return cls(points[order], np.asarray(rows)[order], np.asarray(ids)[order], start, end, radius, low, high)

    def packed(self) -> bytes:
        """The arrays; the points, whole numbers, in four bytes each where that holds them."""
        kind = np.int32 if np.abs(self.points).max() < 1 << 31 else np.float64
        return pickle.dumps((self.points.astype(kind), *list(vars(self).values())[1:]))

    @classmethod
    def unpacked(cls, raw: bytes) -> CoverTree:
        points, *rest = pickle.loads(raw)
        return cls(points.astype(float), *rest)


class Best:
    """The k highest scores of each query so far, ties to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)
        self.row = np.full((queries, k), -1)

    def worst(self, part: slice) -> np.ndarray:
        return self.score[part, -1]

    def add(self, part: slice, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        bar = self.score[part, -1]
        if score.shape[1] > self.k:
            bar = np.maximum(bar, np.partition(score, -self.k, axis=1)[:, -self.k])
        q, c = np.nonzero((score >= bar[:, None]) & (score > -np.inf))
        if not len(q):
            return
        n = score.shape[0]
        owner = np.concatenate([np.repeat(np.arange(n), self.k), q])
        scores = np.concatenate([self.score[part].ravel(), score[q, c]])
        names = np.concatenate([self.id[part].ravel(), ids[c]])
        places = np.concatenate([self.row[part].ravel(), rows[c]])
        order = np.lexsort((places, names, -scores, owner))
        first = np.searchsorted(owner[order], np.arange(n))
        top = order[(first[:, None] + np.arange(self.k)[None, :]).ravel()]
        shape = (n, self.k)
        self.score[part] = scores[top].reshape(shape)
        self.id[part] = names[top].reshape(shape)
        self.row[part] = places[top].reshape(shape)


def ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers first[k] up to last[k] of every k, one after the other."""
    sizes = last - first
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)


def search(queries: CoverTree, data: CoverTree, best: Best) -> None:
    """Add what a data tree holds for the queries of a tree.

    For a query node (centre p, radius r) and a data node (centre x, radius s)
    no inner product is above p.x + r|x| + s|p| + rs. A pair whose bound is
    below the lowest kth score of the node's queries is left out, with all
    below it; at equality it is kept, for ties. Leaves of one query node go
    down the data tree together, GROUP queries at a time: a data node is left
    out where every one of them leaves it out.
    """
    norm = np.sqrt((data.points[data.first] ** 2).sum(1))

    def possible(group: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        centres, r = queries.points[queries.first[group]], queries.radius[group]
        part = slice(queries.first[group[0]], queries.last[group[-1]])
        worst = np.minimum.reduceat(best.worst(part), queries.first[group] - queries.first[group[0]])
        s = data.radius[nodes]
        bound = data.points[data.first[nodes]] @ centres.T + norm[nodes][:, None] * r
        bound += s[:, None] * (np.sqrt((centres**2).sum(1)) + r)
        bound += 0.5 + 1e-12 * np.abs(bound)
        keep = (bound >= worst).any(1)
        top = bound[keep].max(1) if keep.any() else np.empty(0)
        order = np.argsort(-top, kind="stable")
        return nodes[keep][order], top[order]

    def visit(group: np.ndarray, nodes: np.ndarray) -> None:
        nodes, bound = possible(group, nodes)
        if not len(nodes):
            return
        if queries.child_to[group[0]]:
            for some in families(group[0]):
                visit(some, nodes)
            return
        part = slice(queries.first[group[0]], queries.last[group[-1]])
        while len(nodes):
            leaf = data.child_to[nodes] == 0
            score_leaves(part, nodes[leaf], bound[leaf])
            inner = nodes[~leaf]
            if not len(inner):
                return
            nodes, bound = possible(group, ranges(data.child_from[inner], data.child_to[inner]))

    def families(q: int) -> list[np.ndarray]:
        """The children of a node: inner ones alone, neighbouring leaves up to GROUP queries."""
        out, held, size = [], [], 0
        for kid in range(queries.child_from[q], queries.child_to[q]):
            points = queries.last[kid] - queries.first[kid]
            inner = queries.child_to[kid] > 0
            if held and (inner or size + points > GROUP):
                out.append(np.array(held))
                held, size = [], 0
            if inner:
                out.append(np.array([kid]))
            else:
                held.append(kid)
                size += points
        return out + [np.array(held)] if held else out

    def score_leaves(part: slice, nodes: np.ndarray, bound: np.ndarray) -> None:
        ends = np.cumsum((data.last - data.first)[nodes])
        begin = 0
        while begin < len(nodes) and bound[begin] >= best.worst(part).min():  # the bounds fall
            done = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, done + CHUNK, side="right")))
            points = ranges(data.first[nodes[begin:stop]], data.last[nodes[begin:stop]])
            score = queries.points[part] @ data.points[points].T
            own = queries.rows[part][:, None] == data.rows[points][None, :]
            best.add(part, np.where(own, -np.inf, score), data.ids[points], data.rows[points])
            begin = stop

    visit(np.array([0]), np.array([0]))


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(row, id, dim, vector) of the rows that take part, the components as whole numbers."""
    x = F.col("v")
    return (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
        .where(F.col("id").isNotNull() & x.isNotNull() & (F.size(x) > 0))
        .where(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
        .select(
            F.monotonically_increasing_id().alias("row"),
            "id",
            F.size(x).alias("dim"),
            F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long")).alias("vector"),
        )
    )


def top_k(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every query by whole-number inner product.

    Components become floor(scale * x). Queries are the rows whose id is
    divisible by ``every``; candidates are all rows but the query's own. Ties go
    to the smaller id. Vectors that are null, empty or hold a null or
    non-finite component, and rows without id, take no part; vectors of another
    length than the query's are no candidates. A repeated id is as many rows,
    each a candidate, and as a query answered once for each row. An empty table
    gives an empty result; other columns do not matter. Scores are exact below
    2**53.

    Vectors are grouped by their nearest pivot, and a frequent group is dealt
    into several blocks. Each block becomes one tree; a task holds one query
    tree and TREES data trees, and gives at most k rows for each query.
    """
    spark = vectors.sparkSession
    rows = written(quantised(vectors, id_col, vector_col, scale), "vectors")
    counts = {r.dim: r["count"] for r in rows.groupBy("dim").count().collect()}
    pivots: dict[int, np.ndarray] = {}
    for dim, n in counts.items():
        few = rows.where(F.col("dim") == dim).orderBy(F.xxhash64("row"), "row")
        some = few.limit(max(1, min(PIVOTS, n // DATA_BLOCK))).select("vector").collect()
        pivots[dim] = np.array([r.vector for r in some], float)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros(batch.num_rows, np.int64)
            dims = np.array(batch.column(2))
            for dim in set(dims.tolist()):
                mine = np.flatnonzero(dims == dim)
                points = np.array(batch.column(3).take(pa.array(mine)).to_pylist(), float)
                centres = pivots[dim]
                gap = (centres**2).sum(1)[None, :] - 2 * points @ centres.T
                cells[mine] = gap.argmin(1)
            yield batch.append_column("cell", pa.array(cells))

    kinds = "row long, id long, dim int, vector array<long>, cell long"
    placed = written(rows.mapInArrow(nearest, kinds), "cells")
    query = F.col("id") % every == 0
    sizes = placed.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.count_if(query).alias("q")).collect()
    # Blocks are numbered through; at most PIVOTS cells for each vector length.
    layout, data_blocks, query_blocks = [], {}, {}
    space: dict[int, int] = {}
    for cell in sorted(sizes, key=lambda r: (r.dim, r.cell)):
        dim, parts, asks = cell.dim, -(-cell.n // DATA_BLOCK), -(-cell.q // QUERY_BLOCK)
        shared = 0 < cell.q <= space.get(dim, 0)  # the queries of small cells share a tree
        if not shared and asks:
            query_blocks[dim] = query_blocks.get(dim, 0) + asks
            space[dim] = asks * QUERY_BLOCK
        space[dim] = space.get(dim, 0) - cell.q
        ask_base = query_blocks.get(dim, 0) - (1 if shared else asks)
        layout.append((dim, cell.cell, data_blocks.get(dim, 0), parts, ask_base, 1 if shared else asks))
        data_blocks[dim] = data_blocks.get(dim, 0) + parts
    table = spark.createDataFrame(layout, "dim int, cell long, base long, parts long, ask_base long, asks long")
    placed = placed.join(F.broadcast(table), ["dim", "cell"])
    spread = F.xxhash64("row")

    def tree_of(frame):
        import pandas as pd

        tree = CoverTree.build(np.array(frame["vector"].tolist(), float), frame["row"].to_numpy(), frame["id"].to_numpy())
        head = {c: [frame[c].iloc[0]] for c in ("dim", "block")}
        return pd.DataFrame({**head, "tree": [tree.packed()]})

    def trees(frame: DataFrame) -> DataFrame:
        columns = frame.select("dim", "block", "row", "id", "vector")
        return columns.groupBy("dim", "block").applyInPandas(tree_of, "dim int, block long, tree binary")

    totals = spark.createDataFrame(
        [(d, query_blocks.get(d, 0), -(-data_blocks[d] // TREES)) for d in counts], "dim int, asks long, stores long"
    )
    data = written(trees(placed.withColumn("block", F.col("base") + F.pmod(spread, "parts"))), "data-trees")
    asked = trees(placed.where(query).withColumn("block", F.col("ask_base") + F.pmod(spread, "asks")))
    data = data.join(F.broadcast(totals), "dim").where("asks > 0").select(
        "dim",
        F.explode(F.sequence(F.lit(0), F.col("asks") - 1)).alias("ask"),
        F.expr(f"block div {TREES}").alias("store"),
        F.lit(False).alias("is_query"),
        "tree",
    )
    asked = asked.join(F.broadcast(totals), "dim").select(
        "dim",
        F.col("block").alias("ask"),
        F.explode(F.sequence(F.lit(0), F.col("stores") - 1)).alias("store"),
        F.lit(True).alias("is_query"),
        "tree",
    )

    def meet(frame):
        import pandas as pd

        # A query tree meets the nearest data first, which raises its kth scores soonest.
        asking = [CoverTree.unpacked(t) for t in frame["tree"][frame["is_query"]]]
        stores = [CoverTree.unpacked(t) for t in frame["tree"][~frame["is_query"]]]
        out = []
        for tree in asking:
            best = Best(len(tree.points), k)
            stores.sort(key=lambda s: -float(s.points[0] @ tree.points[0]))
            for store in stores:
                search(tree, store, best)
            q, at = np.nonzero(best.score > -np.inf)
            out.append(
                pd.DataFrame(
                    {
                        "row": tree.rows[q],
                        "query_id": tree.ids[q],
                        "vec_id": best.id[q, at],
                        "vec_row": best.row[q, at],
                        "score": best.score[q, at].astype(np.int64),
                    }
                )
            )
        return pd.concat(out)

    found = (
        data.union(asked)
        .groupBy("dim", "ask", "store")
        .applyInPandas(meet, "row long, query_id long, vec_id long, vec_row long, score long")
    )
    order = W.partitionBy("row").orderBy(F.desc("score"), "vec_id", "vec_row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
