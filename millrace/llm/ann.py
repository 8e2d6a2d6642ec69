"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample and every vector goes to one of its leaves. A
query walks the tree best bin first: a priority queue gives the nodes by the distance to
their centre. How many leaves it visits is widened until a set of calibration queries,
answered by brute force over all rows, reaches the recall asked for.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import staged

CHUNK_ROWS = 4096
#: queries that one task holds, on average, and rows looked at exactly beyond the k best
QUERY_ROWS = 32_768
SPARE = 12


@dataclass(frozen=True)
class Search:
    """``sample_rows`` and ``calibration_queries`` bound what the driver holds."""
    k: int = 20
    recall: float = 0.97
    sample_rows: int = 20_000
    calibration_queries: int = 256
    branching: int = 8
    leaf_rows: int = 200
    seed: int = 7


@dataclass
class Tree:
    """Node 0 is the root; a node without children is a leaf. ``radius`` bounds all norms."""
    centers: np.ndarray
    children: list[np.ndarray]
    radius: float
    leaf_of: dict[int, int] = field(default_factory=dict)

    def lifted(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """One more dimension, so that the nearest by distance has the largest inner product."""
        if query:
            last = np.zeros(len(vectors))
        else:
            last = np.sqrt(np.maximum(self.radius ** 2 - (vectors ** 2).sum(axis=1), 0))
        return np.column_stack([vectors, last])

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child at each node."""
        points = self.lifted(vectors)
        at = np.zeros(len(points), dtype=np.int64)
        open_ = {0: np.arange(len(points))}
        while open_:
            node, rows = open_.popitem()
            kids = self.children[node]
            if not len(kids):
                at[rows] = node
                continue
            nearest = _nearest(points[rows], self.centers[kids])
            for i, kid in enumerate(kids):
                if len(own := rows[nearest == i]):
                    open_[int(kid)] = own
        return at

    def visits(self, query: np.ndarray, most: int, rows: dict[int, int] | None = None, enough: int = 0) -> list[int]:
        """The first ``most`` leaves in best-bin-first order, and more until they hold ``enough`` rows."""
        point = self.lifted(query[None, :], query=True)[0]
        queue, found, held = [(0.0, 0)], [], 0
        while queue and (len(found) < most or held < enough):
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not len(kids):
                found.append(node)
                held += rows.get(node, 0) if rows else 0
                continue
            for far, kid in zip(((self.centers[kids] - point) ** 2).sum(axis=1).tolist(), kids.tolist()):
                heapq.heappush(queue, (far, kid))
        return found


def _nearest(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers ** 2).sum(axis=1)[None, :] - 2 * points @ centers.T).argmin(axis=1)


def fit_tree(sample: np.ndarray, radius: float, search: Search) -> Tree:
    """k-means of each node's points into ``branching`` children, down to small leaves."""
    rng = np.random.default_rng(search.seed)
    tree = Tree(np.zeros((1, sample.shape[1] + 1)), [np.empty(0, dtype=np.int64)], radius)
    points = tree.lifted(sample)
    centers, todo = [points.mean(axis=0) if len(points) else tree.centers[0]], [(0, np.arange(len(points)))]
    while todo:
        node, rows = todo.pop()
        if len(rows) <= search.leaf_rows:
            continue
        own = points[rows]
        means = own[rng.choice(len(own), search.branching, replace=False)]
        for _ in range(12):
            nearest = _nearest(own, means)
            means = np.array([own[nearest == i].mean(axis=0) if (nearest == i).any() else means[i]
                              for i in range(search.branching)])
        nearest = _nearest(own, means)
        filled = [i for i in range(search.branching) if (nearest == i).any()]
        if len(filled) < 2:
            continue
        kids = []
        for i in filled:
            kids.append(len(centers))
            centers.append(means[i])
            tree.children.append(np.empty(0, dtype=np.int64))
            todo.append((kids[-1], rows[nearest == i]))
        tree.children[node] = np.array(kids)
    tree.centers = np.array(centers)
    return tree


def _scores(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products summed in one order, so that equal vectors score the same."""
    return np.add.reduce(vectors * query, axis=1)


def _best(asked: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int,
          allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the best k rows of each query: most first, then smaller id; ids are distinct."""
    rough = queries @ vectors.T
    if allowed is not None:
        rough[~allowed] = -np.inf
    rough[asked[:, None] == ids[None, :]] = -np.inf
    n, m = len(ids), min(len(ids), k + SPARE)
    at = np.argpartition(rough, n - m, axis=1)[:, n - m:] if m < n else np.broadcast_to(np.arange(n), rough.shape)
    near = np.take_along_axis(rough, at, axis=1)
    score = np.where(np.isfinite(near), np.add.reduce(vectors[at] * queries[:, None, :], axis=2), -np.inf)
    order = np.lexsort((ids[at], -score), axis=1)[:, :k]
    row, score = np.take_along_axis(at, order, axis=1), np.take_along_axis(score, order, axis=1)
    query = np.broadcast_to(np.arange(len(asked))[:, None], row.shape)
    found = [x[np.isfinite(score)] for x in (query, row, score)]
    if m < n:
        # rough scores differ from exact ones in the last bits: where the last row taken is so
        # near to the k-th, others that were not taken may be as good
        kth = np.partition(near, m - k, axis=1)[:, m - k]
        unsure = np.flatnonzero(near.min(axis=1) >= kth - 1e-9 * np.maximum(1.0, np.abs(kth)))
        if len(unsure):
            found = [x[~np.isin(found[0], unsure)] for x in found]
            for i in unsure.tolist():
                own = np.flatnonzero(np.isfinite(rough[i]) & (rough[i] >= kth[i] - 1e-9 * max(1.0, abs(kth[i]))))
                exact = _scores(queries[i], vectors[own])
                first = np.lexsort((ids[own], -exact))[:k]
                found = [np.concatenate(x) for x in zip(found, (np.full(len(first), i), own[first], exact[first]))]
    return found[0], found[1], found[2]


def usable(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v): vectors of doubles; not those that are null, zero, or hold null or non-finite numbers.

    Of vectors of several lengths those of the most frequent length take part.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    length = kept.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return kept.filter(F.size("v") == (length["n"] if length else -1))


def _once(rows: DataFrame) -> DataFrame:
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def bins_of(rows: dict[int, int]) -> list[tuple[int, int, int]]:
    """(leaf, first bin, bins): neighbouring small leaves share a bin of CHUNK_ROWS rows, large ones have several."""
    found, bin_, held = [], 0, 0
    for leaf, n in sorted(rows.items()):
        if held and held + n > CHUNK_ROWS:
            bin_, held = bin_ + 1, 0
        parts = max(1, -(-n // CHUNK_ROWS))
        found.append((leaf, bin_, parts))
        held += n
        if parts > 1:
            bin_, held = bin_ + parts, 0
    return found


def neighbours(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector: str = "embedding",
               search: Search = Search()) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product found for each query.

    All rows are indexed and all queries answered; a row with the query's id is no
    candidate. Ties go to the smaller id. Of rows that repeat an id the smallest vector, by
    its components, stands for it, among queries too. Without usable rows there is no
    result, and with fewer candidates than k all of them come: a query goes on beyond its
    calibrated number of leaves until they hold k others.

    Small leaves share a bin and rows of a large one are dealt to several; a task matches one
    bin with one part of the queries, and sends on k rows for each query and bin.
    """
    spark = vectors.sparkSession
    rows = staged(_once(usable(vectors, id_col, vector)), "vectors")
    asked = staged(_once(usable(queries, id_col, vector)), "queries")
    shape = "query_id long, rank int, vec_id long, score double"
    facts = rows.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("norm")).first()
    n_asked = asked.count()
    if not facts["n"] or not n_asked:
        return spark.createDataFrame([], shape)
    by_hash = F.xxhash64("id", F.lit(search.seed))
    sample = np.array([r["v"] for r in rows.orderBy(by_hash, "id").limit(search.sample_rows).collect()])
    tree = fit_tree(sample, float(np.sqrt(facts["norm"])), search)
    k = search.k

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            points = np.stack(frame["v"].to_numpy()) if len(frame) else np.empty((0, sample.shape[1]))
            yield frame.assign(leaf=tree.leaves(points))

    placed = staged(rows.mapInPandas(place, "id long, v array<double>, leaf long"), "placed")

    # calibration: where in its visits would each true neighbour have been met
    some = asked.orderBy(by_hash, "id").limit(search.calibration_queries).collect()
    ids, points = np.array([r["id"] for r in some]), np.array([r["v"] for r in some])

    def exact(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own, all_ids, leaf = np.stack(frame["v"].to_numpy()), frame["id"].to_numpy(), frame["leaf"].to_numpy()
            query, row, score = _best(ids, points, all_ids, own, k)
            yield pd.DataFrame({"query": ids[query], "id": all_ids[row], "score": score, "leaf": leaf[row]})

    top = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    truth = placed.mapInPandas(exact, "query long, id long, score double, leaf long").withColumn(
        "rank", F.row_number().over(top)).filter(F.col("rank") <= k).select("query", "leaf").collect()
    # no more leaves than the sample has rows
    held = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}
    n_leaves = sum(1 for kids in tree.children if not len(kids))
    orders = {q: {leaf: i for i, leaf in enumerate(tree.visits(p, n_leaves))} for q, p in zip(ids.tolist(), points)}
    met = np.sort([orders[r["query"]][r["leaf"]] for r in truth])
    visits = int(met[int(np.ceil(search.recall * len(met))) - 1]) + 1 if len(met) else n_leaves
    bins = bins_of(held)
    first = {leaf: (bin_, parts) for leaf, bin_, parts in bins}
    blocks = -(-n_asked // QUERY_ROWS)

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for query, v in zip(frame["id"], frame["v"]):
                by_bin: dict[int, list[int]] = {}
                for leaf in tree.visits(np.asarray(v), visits, held, k + 1):
                    bin_, parts = first.get(leaf, (0, 0))
                    for part in range(bin_, bin_ + parts):
                        by_bin.setdefault(part, []).append(leaf)
                out += [(query, v, b, leaves) for b, leaves in by_bin.items()]
            yield pd.DataFrame(out, columns=["id", "v", "bin", "leaves"])

    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    walked = asked.mapInPandas(walk, "id long, v array<double>, bin int, leaves array<long>").withColumn("block", block)
    where = F.broadcast(spark.createDataFrame(bins, "leaf long, first int, parts int"))
    dealt = placed.join(where, "leaf").select(
        "id", "v", "leaf", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("bin"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def look(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        own, all_ids, found = np.stack(right["v"].to_numpy()), right["id"].to_numpy(), []
        leaves, leaf = np.unique(right["leaf"].to_numpy(), return_inverse=True)
        for at in range(0, len(left), 256):
            part = left.iloc[at:at + 256]
            asked_ids = part["id"].to_numpy()
            seen = np.stack([np.isin(leaves, own_leaves) for own_leaves in part["leaves"]])
            query, row, score = _best(asked_ids, np.stack(part["v"].to_numpy()), all_ids, own, k, seen[:, leaf])
            found.append(pd.DataFrame({"query_id": asked_ids[query], "vec_id": all_ids[row], "score": score}))
        return pd.concat(found)

    found = walked.groupBy("bin", "block").cogroup(dealt.groupBy("bin", "block")).applyInPandas(
        look, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
