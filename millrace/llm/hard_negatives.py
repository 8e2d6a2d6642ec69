"""Hard negatives by the method of the four Russians.

Eight components of an anchor have 256 subset sums. A candidate's bits, plane by plane, name
one of them for each eight components with one byte. So a plane's part of the inner product
is a sum of table entries, and the whole product those parts, shifted and added from the
highest plane, the sign, down.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import staged
from millrace.llm.vectors import all_finite, fixed_binary, matrix, pack_planes, planes_of, whole
from millrace.session import shared_dir

GROUP = 8
CANDIDATE_ROWS = 4096
TABLE_BYTES = 1 << 22
#: anchors that the driver and each task hold at a time, on average
ANCHORS = 1024
NONE = np.iinfo(np.int64).min


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors): sums of each subset of eight components, its bits as index."""
    n, d = anchors.shape
    groups = -(-d // GROUP)
    parts = np.zeros((groups, GROUP, n), dtype=kind)
    parts.reshape(groups * GROUP, n)[:d] = anchors.T
    sums = np.zeros((groups, 1 << GROUP, n), dtype=kind)
    for bit in range(GROUP):
        sums[:, 1 << bit:2 << bit] = sums[:, :1 << bit] + parts[:, bit, None, :]
    return sums


def scores(tables: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """(candidates, anchors): inner products from subset sums and packed planes (rows, planes, groups)."""
    rows, planes, groups = packed.shape
    total = np.zeros((rows, tables.shape[2]), dtype=tables.dtype)
    for plane in range(planes - 1, -1, -1):
        if plane < planes - 1:
            total <<= 1
        for group in range(groups):
            part = tables[group].take(packed[:, plane, group], axis=0)
            # the highest plane is the sign
            total = total - part if plane == planes - 1 else total + part
    return total


class Best:
    """The first ``k`` candidates of each column, higher scores first, of equal ones the smaller id."""

    def __init__(self, columns: int, k: int):
        self.k = k
        self.score = np.full((k, columns), NONE, dtype=np.int64)
        self.id = np.zeros((k, columns), dtype=np.int64)

    def add(self, columns: slice | np.ndarray, score: np.ndarray, ids: np.ndarray, taken: np.ndarray) -> None:
        """``score`` (candidates, columns) of candidates by ascending id, where ``taken``."""
        n = len(ids)
        if not n:
            return
        score = score.astype(np.int64)
        # one number orders by score, then by id
        order = np.where(taken, score * n + np.arange(n - 1, -1, -1)[:, None], NONE)
        k = min(self.k, n)
        at = np.argpartition(order, n - k, axis=0)[n - k:]
        some = np.where(np.take_along_axis(taken, at, axis=0), np.take_along_axis(score, at, axis=0), NONE)
        all_scores = np.concatenate([self.score[:, columns], some])
        all_ids = np.concatenate([self.id[:, columns], ids[at]])
        # larger first without turning the sign of the least number
        keep = np.lexsort((all_ids, ~all_scores), axis=0)[:self.k]
        self.score[:, columns] = np.take_along_axis(all_scores, keep, axis=0)
        self.id[:, columns] = np.take_along_axis(all_ids, keep, axis=0)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Column, id and score of all that were found."""
        row, column = np.nonzero(self.score != NONE)
        return column, self.id[row, column], self.score[row, column]


class Anchors:
    """A block of anchors, those of one label side by side."""

    def __init__(self, rows: list, largest: int):
        rows = sorted(rows, key=lambda r: (r["label"], r["id"]))
        self.ids = np.array([r["id"] for r in rows], dtype=np.int64)
        self.labels = np.array([r["label"] for r in rows], dtype=np.int64)
        self.values = np.array([r["v"] for r in rows], dtype=np.int64).reshape(len(rows), -1)
        bound = max(1, self.values.shape[1]) * int(largest) ** 2
        if bound * CANDIDATE_ROWS >= 1 << 62:
            raise ValueError("components are too large for exact scores in 64 bits")
        self.kind = np.int32 if bound < 1 << 30 else np.int64

    def strips(self, begin: int, end: int) -> Iterator[tuple[slice, np.ndarray]]:
        """Neighbouring anchors whose tables are about TABLE_BYTES, with the tables."""
        groups = max(1, -(-self.values.shape[1] // GROUP))
        width = max(8, TABLE_BYTES // (groups * (1 << GROUP) * np.dtype(self.kind).itemsize))
        for at in range(begin, end, width):
            own = slice(at, min(at + width, end))
            yield own, subset_sums(self.values[own], self.kind)


def _candidates(batches: Iterator[pa.RecordBatch], planes: int, groups: int):
    """Ids, labels and packed planes by ascending id, a bounded number of rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, CANDIDATE_ROWS):
            part = batch.slice(at, CANDIDATE_ROWS)
            ids = part.column("id").to_numpy(zero_copy_only=False)
            order = np.argsort(ids, kind="stable")
            packed = fixed_binary(part.column("planes"), planes * groups).reshape(len(ids), planes, groups)
            yield ids[order], part.column("label").to_numpy(zero_copy_only=False)[order], packed[order]


def _finder_of_positives(anchors: Anchors, planes: int, groups: int, k: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(anchors.ids), k)
        labels, begins = np.unique(anchors.labels, return_index=True)
        ends = np.append(begins[1:], len(anchors.ids))
        for ids, label, packed in _candidates(batches, planes, groups):
            for at in np.flatnonzero(np.isin(labels, label)):
                same = label == labels[at]
                for own, tables in anchors.strips(begins[at], ends[at]):
                    best.add(own, scores(tables, packed[same]), ids[same],
                             ids[same][:, None] != anchors.ids[own][None, :])
        column, found, score = best.found()
        yield pa.RecordBatch.from_arrays([pa.array(anchors.ids[column]), pa.array(found), pa.array(score)],
                                         names=["anchor_id", "id", "score"])
    return find


def _finder_of_negatives(anchors: Anchors, positive: dict[int, list[tuple[int, int]]], planes: int, groups: int,
                         k: int, low: int, high: int):
    """``positive``: ids and scores of each anchor's positives."""
    most = max(map(len, positive.values()), default=0)
    # per anchor and rank of positive: its id, and the band of scores; empty where there is none
    ids_of, least, largest = (np.zeros((most, len(anchors.ids)), dtype=np.int64) for _ in range(3))
    largest -= 1
    for column, anchor in enumerate(anchors.ids.tolist()):
        for row, (positive_id, score) in enumerate(positive.get(anchor, ())):
            ids_of[row, column] = positive_id
            least[row, column], largest[row, column] = -(-low * score // 100), high * score // 100

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(len(anchors.ids), k) for _ in range(most)]
        for ids, label, packed in _candidates(batches, planes, groups):
            for own, tables in anchors.strips(0, len(anchors.ids)):
                score = scores(tables, packed)
                other = label[:, None] != anchors.labels[own][None, :]
                for row in range(most):
                    taken = other & (score >= least[row, own]) & (score <= largest[row, own])
                    # most columns of most blocks hold nothing in the band
                    some = np.flatnonzero(taken.any(axis=0))
                    if len(some):
                        best[row].add(some + own.start, score[:, some], ids, taken[:, some])
        for row in range(most):
            column, found, score = best[row].found()
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors.ids[column]), pa.array(ids_of[row, column]), pa.array(found), pa.array(score)],
                names=["anchor_id", "positive_id", "id", "score"])
    return find


def _first(found: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector: str = "embedding",
                   label: str = "label", positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
                   scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A component counts as floor(scale * x), a score is the inner product of those. Rows
    for which ``anchor`` is true are anchors. An anchor's positives are the first rows of its
    label, itself left out: higher scores first, of equal ones the smaller id. For each
    of them come the first rows of other labels, ranked the same way from 1, for which low *
    positive_score <= 100 * negative_score <= high * positive_score; a positive without
    such rows gives none, so neither does one with a negative score.

    Rows with a null id, label or vector, or with a null or non-finite component, take no
    part, nor has an empty vector or one of another length than most rows have. An id counts
    once: of repeated rows the one with the smallest label, then the smallest vector. Other
    columns are left out. Without usable rows or anchors there is no row.

    Anchors are dealt to blocks of about ANCHORS by a hash of the distinct ids. The driver
    takes one block after the other, sends it to all tasks, and each task goes through its
    candidates once for positives and once for negatives; it sends back the first few for
    each anchor. Blocks are appended to a written table, so nothing grows with their number.
    """
    spark = vectors.sparkSession
    shape = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
             "negative_score bigint")
    v = F.col(f"`{vector}`")
    usable = vectors.filter(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label}`").isNotNull() & all_finite(v)
                            & (F.size(v) > 0)).select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{label}`").cast("bigint").alias("label"),
        whole(v, scale).alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    sizes = usable.groupBy(F.size("v").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("largest"))
    facts = sizes.orderBy(F.desc("n"), "d").first()
    if facts is None:
        return spark.createDataFrame([], shape)
    d, largest = facts["d"], facts["largest"]
    planes, groups = planes_of(largest), -(-d // GROUP)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CANDIDATE_ROWS):
                part = batch.slice(at, CANDIDATE_ROWS)
                packed = pack_planes(matrix(part.column("v")), planes).reshape(part.num_rows, -1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"), pa.array([x.tobytes() for x in packed], pa.binary())],
                    names=["id", "label", "planes"])

    usable = usable.filter(F.size("v") == d)
    once = usable.groupBy("id").agg(F.min(F.struct("label", "v", "anchor")).alias("row")).select("id", "row.*")
    once = staged(once, "vectors")
    rows = staged(once.select("id", "label", "v").mapInArrow(pack, "id bigint, label bigint, planes binary"), "planes")
    asked = once.filter("anchor")
    blocks = -(-asked.count() // ANCHORS)
    if not blocks:
        return spark.createDataFrame([], shape)
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    asked = staged(asked.select("id", "label", "v", block.alias("block")).repartitionByRange(
        F.col("block")).sortWithinPartitions("block"), "anchors")
    path = shared_dir(spark, "hard-negatives")
    for n in range(blocks):
        anchors = Anchors(asked.filter(F.col("block") == n).collect(), largest)
        near = _first(rows.mapInArrow(_finder_of_positives(anchors, planes, groups, positives),
                                      "anchor_id bigint, id bigint, score bigint"), positives, "anchor_id")
        positive: dict[int, list[tuple[int, int]]] = {}
        for r in near.collect():
            positive.setdefault(r["anchor_id"], []).append((r["id"], r["score"]))
        scored = spark.createDataFrame([(a, p, s) for a, own in positive.items() for p, s in own],
                                       "anchor_id bigint, positive_id bigint, positive_score bigint")
        found = rows.mapInArrow(_finder_of_negatives(anchors, positive, planes, groups, negatives, low, high),
                                "anchor_id bigint, positive_id bigint, id bigint, score bigint")
        (_first(found, negatives, "anchor_id", "positive_id").join(scored, ["anchor_id", "positive_id"])
         .selectExpr("anchor_id", "positive_id", "rank", "id AS negative_id", "positive_score", "score AS negative_score")
         .write.mode("append").parquet(path))
    return spark.read.schema(shape).parquet(path)
