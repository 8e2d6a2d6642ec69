"""Centroid clustering on bit planes.

A vector of 64 whole numbers is kept as one 64-bit word for each bit plane. The dot product
of two such vectors is the sum, over all pairs of planes, of the number of bits that both
planes have, times the weights of the planes. So distances are exact and need only AND and
population counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged
from millrace.llm.vectors import all_finite, fixed_binary, matrix, pack_planes, planes_of, weights, whole

WIDTH = 64
BLOCK_ROWS = 4096


def words(values: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes): each plane of 64 components as one word."""
    return np.ascontiguousarray(pack_planes(values, planes)).view("<u8").reshape(len(values), planes)


def dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dot products of all rows of ``left`` with all rows of ``right``, both as words of planes."""
    planes = left.shape[1]
    sign = np.where(np.arange(planes) == planes - 1, -1, 1)
    total = np.zeros((len(left), len(right)), dtype=np.int64)
    for shift in range(2 * planes - 1):
        # all pairs of planes with one weight
        same = np.zeros(total.shape, dtype=np.int32)
        for i in range(max(0, shift - planes + 1), min(planes, shift + 1)):
            j = shift - i
            both = np.bitwise_count(left[:, i, None] & right[None, :, j])
            same += np.int32(sign[i] * sign[j]) * both.astype(np.int32)
        total += same.astype(np.int64) << np.int64(shift)
    return total


def norms(own: np.ndarray) -> np.ndarray:
    """Dot product of each row with itself."""
    planes = own.shape[1]
    w = weights(planes)
    total = np.zeros(len(own), dtype=np.int64)
    for i in range(planes):
        for j in range(planes):
            total += w[i] * w[j] * np.bitwise_count(own[:, i] & own[:, j]).astype(np.int64)
    return total


def nearest(own: np.ndarray, square: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row, the smaller one of ties, and the squared distance."""
    there = words(centroids, own.shape[1])
    far = square[:, None] + (centroids ** 2).sum(axis=1)[None, :] - 2 * dots(own, there)
    cluster = far.argmin(axis=1)
    return cluster, far[np.arange(len(own)), cluster]


def component_sums(own: np.ndarray, cluster: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each cluster, and the sums of their components."""
    planes = own.shape[1]
    bits = np.unpackbits(np.ascontiguousarray(own, dtype="<u8").view(np.uint8), axis=-1, bitorder="little")
    member = (cluster[None, :] == np.arange(k)[:, None]).astype(np.float64)
    counts = (member @ bits.astype(np.float64)).astype(np.int64).reshape(k, planes, WIDTH)
    return member.sum(axis=1).astype(np.int64), (counts * weights(planes)[None, :, None]).sum(axis=1)


def _blocks(batches: Iterator[pa.RecordBatch], planes: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            own = fixed_binary(part.column("planes"), planes * 8).view("<u8")
            yield part, own, part.column("square").to_numpy(zero_copy_only=False)


def _moved(rows: DataFrame, centroids: np.ndarray, planes: int) -> np.ndarray:
    """Floors of the means of all non-empty clusters; each task sends one row for each cluster."""
    k = len(centroids)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, dtype=np.int64), np.zeros((k, WIDTH), dtype=np.int64)
        for _, own, square in _blocks(batches, planes):
            more = component_sums(own, nearest(own, square, centroids)[0], k)
            n, sums = n + more[0], sums + more[1]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(k, dtype=np.int32)), pa.array(n), pa.array(sums.tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"])

    parts = rows.select("planes", "square").mapInArrow(add_up, "cluster int, n bigint, sums array<bigint>")
    means = parts.select("cluster", "n", F.posexplode("sums").alias("at", "part")).groupBy("cluster", "at").agg(
        F.sum("part").alias("total"), F.sum("n").alias("n")).filter("n > 0").selectExpr(
        "cluster", "at", "(total - pmod(total, n)) div n AS mean")
    moved = centroids.copy()
    for r in means.collect():
        moved[r["cluster"], r["at"]] = r["mean"]
    return moved


def clusters(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 16, rounds: int = 3,
             scale: int = 64, seed: int = 1) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector that is kept.

    Kept are rows with exactly 64 components, none null or non-finite, each made floor(scale
    * x). Centroids start as the k kept vectors whose ``seed:id`` has the smallest SHA-256,
    ids null last, repeated ids by components. A round assigns every vector to its nearest
    centroid by squared distance, the smaller number of ties, and makes each non-empty
    centroid the floor of the mean of its vectors. After all rounds vectors are assigned once
    more. Rows with a null or repeated id are vectors of their own; with fewer than k vectors
    there are as many clusters, without any no rows. Other columns are left out.

    The driver holds k centroids and what a round sums up for them. Vectors stay where they
    are: no shuffle carries more than one row for each task, cluster and component.
    """
    spark = vectors.sparkSession
    schema = (f"`{id_col}` {vectors.schema[id_col].dataType.simpleString()}, cluster int, distance bigint, "
              "cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    v = F.col(f"`{vector}`")
    kept = vectors.filter((F.size(v) == WIDTH) & all_finite(v)).select(
        F.col(f"`{id_col}`").alias("id"), whole(v, scale).alias("v"))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(F.asc_nulls_last(name), "v").limit(k).collect()
    if not first:
        return spark.createDataFrame([], schema)
    centroids = np.array([r["v"] for r in first], dtype=np.int64)
    planes = planes_of(kept.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()[0])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                own = words(matrix(part.column("v")), planes)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([x.tobytes() for x in own], pa.binary()), pa.array(norms(own))],
                    names=["id", "planes", "square"])

    kind = kept.schema["id"].dataType.simpleString()
    rows = staged(kept.mapInArrow(pack, f"id {kind}, planes binary, square bigint"), "planes")
    for _ in range(rounds):
        centroids = _moved(rows, centroids, planes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own, square in _blocks(batches, planes):
            cluster, far = nearest(own, square, centroids)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(cluster.astype(np.int32)), pa.array(far)],
                                             names=["id", "cluster", "distance"])

    placed = staged(rows.mapInArrow(place, f"id {kind}, cluster int, distance bigint"), "clusters")
    # at most k rows
    spread = {r["cluster"]: r["spread"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("spread")).collect()}
    total = sum(spread.values())
    facts = spark.createDataFrame(
        [(c, s, total, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
         for c, s in spread.items()], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
