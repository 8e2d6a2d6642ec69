"""N-gram Jaccard join with PartEnum signatures.

Sets are joined at 0.8 or more. Sizes are dealt into bands such that two sets of a link
lie in one band or in two neighbouring ones; every set signs for its own band and for the
one below. Two linked sets of a band differ in at most k elements. The domain of hashes is cut
into n first-level ranges, each into three: as n is more than k / 2, linked sets differ
in one element at most in some first-level range, and agree in two of its three parts. A
signature is the hash of two parts of a range, so linked sets share one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import free_name, staged, worker_memo
from millrace.llm.graph import components
from millrace.llm.shingles import _Words, mixed, shingle_sets

# Links need 100 * intersection >= SIMILAR * union; the bands hold for this value alone.
SIMILAR = 80
PARTS = 3
#: classes of shingles for each element of a set, at least: between sets, and where the sets are at hand
FINER = 1
EXACT_FINER = 16
#: what a block of a large group weighs: bytes, and as many more for each row
CELL_BYTES = 1 << 24
ROW_BYTES = 1 << 12
#: sets in a group whose pairs are checked one by one
FEW = 8
BLOCK = 1024
BROADCAST_IDS = 1_000_000
#: what a task holds before it sends a block on, and names of sets it has signed, some 10 and 20 MB
BLOCK_SIGNATURES = 250_000
SEEN_SETS = 200_000


class Bands:
    """Upper ends of the bands of set sizes, differences and ranges for each."""

    def __init__(self):
        # sets of up to three elements are linked only with equal ones
        self.ends = [3]
        self.schemes: dict[int, tuple[int, int, np.ndarray, np.ndarray]] = {}

    def band(self, size: int) -> int:
        while self.ends[-1] < size:
            self.ends.append(max(self.ends[-1] + 1, self.ends[-1] * 5 // 4))
        return int(np.searchsorted(self.ends, size))

    def scheme(self, band: int) -> tuple[int, int, np.ndarray, np.ndarray]:
        """First-level ranges, how many of them must agree, lower ends of the parts, seeds."""
        if band not in self.schemes:
            largest = self.ends[band]
            k = (largest + largest * 5 // 4) // 9
            n = (k + 2) // 2
            n += 2 if n >= 12 else 1 if n >= 6 else 0
            starts = np.array([i * (1 << 64) // (n * PARTS) for i in range(n * PARTS)], dtype=np.uint64)
            seeds = mixed(np.arange(n * PARTS, dtype=np.uint64) + np.uint64((band + 1) << 32))
            self.schemes[band] = n, n - k // 2, starts, seeds
        return self.schemes[band]

    def signatures(self, shingles: np.ndarray) -> np.ndarray:
        size = len(shingles)
        if size < 4:
            return np.empty(0, dtype=np.uint64)
        band = self.band(size)
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed(shingles), dtype=np.uint64)])
        found = []
        for b in (band, band - 1):
            if b < 1:
                continue
            n, agree, starts, seeds = self.scheme(b)
            at = np.append(np.searchsorted(shingles, starts), size)
            part = (sums[at[1:]] - sums[at[:-1]]).reshape(n, PARTS)
            count = np.diff(at).reshape(n, PARTS)
            # one signature for each part left out
            value = part.sum(axis=1, dtype=np.uint64)[:, None] - part
            filled = (count.sum(axis=1)[:, None] - count) > 0
            signed = mixed(value + seeds.reshape(n, PARTS))
            # Two parts without elements say little. They count only for sets that could agree nowhere else.
            if (~filled).any(axis=1).sum() >= agree:
                found.append(signed.ravel())
            else:
                found.append(signed[filled])
        return np.concatenate(found)


def set_id(shingles: np.ndarray) -> int:
    """A 64-bit name of a set; equal sets have the same."""
    if not len(shingles):
        return 0
    total = mixed(np.cumsum(mixed(shingles), dtype=np.uint64)[-1:] + np.uint64(len(shingles)))
    return int(total.view(np.int64)[0])


def _sets(texts) -> Iterator[np.ndarray]:
    return shingle_sets(texts, worker_memo(("shingle words",), _Words))


def _parities(shingles: np.ndarray, finer: int = FINER, least: int = 512) -> bytes:
    """Whether the number of shingles in each of many classes is odd, a bit each.

    Sets that differ in n elements differ in n parities at most, and in about as many if
    there are several classes for each such element. The classes are the lowest bits.
    """
    classes = max(least, finer << len(shingles).bit_length())
    found = np.bincount((shingles & np.uint64(classes - 1)).astype(np.int64), minlength=classes)
    return np.packbits(found.astype(np.uint8) & 1, bitorder="little").tobytes()


def _folded(parities: list[bytes]) -> np.ndarray:
    """One row of words for each, over the classes of the shortest: finer ones meet in a coarser one."""
    least = min(map(len, parities))
    if least == max(map(len, parities)):
        return np.frombuffer(b"".join(parities), dtype=np.uint64).reshape(len(parities), -1)
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(p, dtype=np.uint64).reshape(-1, least // 8), axis=0) for p in parities])


@F.pandas_udf(T.StructType().add("n_shingles", T.LongType()).add("node", T.LongType()).add("bins", T.BinaryType()))
def _described(texts: pd.Series) -> pd.DataFrame:
    rows = [(len(s), set_id(s), _parities(s)) for s in _sets(texts)]
    return pd.DataFrame({"n_shingles": [n for n, _, _ in rows],
                         "node": pd.array([i if n else None for n, i, _ in rows], dtype="Int64"),
                         "bins": [b for _, _, b in rows]})


def _signer(partitions: int):
    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Blocks of (signature, set) for each partition; copies within a task count once."""
        bands, seen = Bands(), set()
        signatures, nodes, held = [], [], 0

        def blocks():
            s = np.concatenate(signatures)
            owner = np.repeat(np.arange(len(nodes)), [len(x) for x in signatures])
            names = np.array(nodes, dtype=np.int64)
            home = (s >> np.uint64(32)) % np.uint64(partitions)
            order = np.argsort(home, kind="stable")
            rows = []
            for own in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
                # signatures of a set stand together: its name once, with their number
                first = np.flatnonzero(np.concatenate([[True], np.diff(owner[own]) != 0]))
                rows.append((int(home[own[0]]), s[own].astype(np.uint32).tobytes(), names[owner[own][first]].tobytes(),
                             np.diff(np.append(first, len(own))).astype(np.uint32).tobytes()))
            yield pd.DataFrame(rows, columns=["home", "signatures", "nodes", "counts"])

        for frame in frames:
            for shingles in _sets(frame["text"]):
                node = set_id(shingles)
                if node in seen or not len(signed := bands.signatures(shingles)):
                    continue
                if len(seen) < SEEN_SETS:
                    seen.add(node)
                signatures.append(signed)
                nodes.append(node)
                held += len(signed)
            if held > BLOCK_SIGNATURES:
                yield from blocks()
                signatures, nodes, held = [], [], 0
        if held:
            yield from blocks()
    return sign


def _buckets(frame: pd.DataFrame) -> pd.DataFrame:
    """The sets that share a signature, each list of sets once."""
    s = np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in frame["signatures"]])
    n = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in frame["nodes"]])
    n = np.repeat(n, np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in frame["counts"]]))
    order = np.lexsort((n, s))
    s, n = s[order], n[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (s[1:] != s[:-1]) | (n[1:] != n[:-1])
    s, n = s[new], n[new]
    starts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    ends = np.append(starts[1:], len(s))
    shared = np.flatnonzero(ends - starts > 1)
    lists = {n[starts[i]:ends[i]].tobytes() for i in shared}
    return pd.DataFrame({"nodes": list(lists)}, dtype=object)


def _stars(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first set of each bucket with each other."""
    for frame in frames:
        pairs = set()
        for nodes in frame["nodes"]:
            first, *others = np.frombuffer(nodes, dtype=np.int64).tolist()
            pairs.update((first, x) for x in others)
        yield pd.DataFrame(list(pairs), columns=["a", "b"], dtype="int64")


def _with_sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = [(set_id(s), s.tobytes()) for s in _sets(frame["text"])]
        yield pd.DataFrame(rows, columns=["node", "shingles"])


def _exactly(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= SIMILAR * (len(a) + len(b) - both)


@F.pandas_udf(T.BooleanType())
def _similar(left: pd.Series, right: pd.Series) -> pd.Series:
    """The exact check on two sets."""
    return pd.Series([_exactly(np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64))
                      for a, b in zip(left, right)], dtype=bool)


@F.pandas_udf(T.BooleanType())
def _close(left: pd.Series, right: pd.Series, sizes: pd.Series) -> pd.Series:
    """False if the parities prove that two sets differ in more than a ninth of their sizes."""
    apart = [int(np.bitwise_count(np.bitwise_xor(*_folded([a, b]))).sum(dtype=np.int64)) for a, b in zip(left, right)]
    return pd.Series(np.array(apart, dtype=np.int64) * 9 <= sizes.to_numpy())


def _cells(rows: DataFrame, group: str, size: Column, contents: DataFrame) -> DataFrame:
    """Rows of a group next to each other, in cells of bounded size in which any two of them meet.

    A group is dealt to blocks by a hash of the node, and each two blocks make a cell: its
    rows are from ``side`` 0 and 1, or all from side 0 where a block meets itself. What a
    node holds, ``size`` bytes or so, joins when the cells are known, to be moved once.
    """
    blocks = rows.groupBy(group).agg(F.ceil(F.sum(size + ROW_BYTES) / CELL_BYTES).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return (rows.join(blocks, group).withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other"),
                          "side": (F.col("own") > F.col("other")).cast("int")})
            .drop("blocks", "own", "other").join(contents, "node")
            .repartition(group, "low", "high").sortWithinPartitions(group, "low", "high"))


def _each_cell(frames: Iterator[pd.DataFrame], group: str) -> Iterator[dict[str, np.ndarray]]:
    """The columns of one cell after the other, of rows sorted by cell; those of a single label are left out."""
    def whole(held: list[dict[str, np.ndarray]]) -> Iterator[dict[str, np.ndarray]]:
        cell = held[0] if len(held) == 1 else {c: np.concatenate([h[c] for h in held]) for c in held[0]}
        if (cell["label"] != cell["label"][0]).any():
            yield cell

    held, last = [], None
    for frame in frames:
        columns = {c: frame[c].to_numpy() for c in frame}
        keys = [columns[c] for c in (group, "low", "high")]
        cuts = (np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1).tolist()
        for start, end in zip([0, *cuts], [*cuts, len(frame)]):
            if start == end:
                continue
            key = tuple(k[start] for k in keys)
            if held and key != last:
                yield from whole(held)
                held = []
            held.append({c: v[start:end] for c, v in columns.items()})
            last = key
    if held:
        yield from whole(held)


class _Cell:
    """Sets of a cell: which of them could still be linked, by sizes and parities.

    Parities differ in no more places than the sets do, so pairs that differ in more of them
    than a ninth of their sizes are no link.
    """

    def __init__(self, columns: dict[str, np.ndarray], parities: list[bytes]):
        self.node, self.label, self.size, side = (columns[c] for c in ("node", "label", "n_shingles", "side"))
        self.bins = _folded(parities)
        # sides count only where two blocks meet
        self.side = side if columns["low"][0] != columns["high"][0] else np.arange(len(side))

    def partners(self, i: int, among: np.ndarray) -> np.ndarray:
        """Members after i, of those given, that could be linked with it."""
        after = slice(i + 1, None)
        at = np.flatnonzero(among[after] & (self.label[after] != self.label[i]) & (self.side[after] != self.side[i])
                            & (np.abs(self.size[after] - self.size[i]) * 9 <= self.size[after] + self.size[i])) + i + 1
        if len(at):
            apart = np.bitwise_count(self.bins[at] ^ self.bins[i]).sum(axis=1, dtype=np.int64)
            at = at[apart * 9 <= self.size[at] + self.size[i]]
        return at


def _left_over(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Groups of sets in which those of a bucket lie that could still be linked, though in two components.

    One row for a group, however many of its pairs could be linked; pairs of a few sets come one by one.
    """
    for columns in _each_cell(frames, "bucket"):
        cell = _Cell(columns, columns["bins"].tolist())
        n = len(cell.node)
        group = np.arange(n)
        for i in range(n - 1):
            met = np.unique(group[cell.partners(i, group != group[i])])
            if len(met):
                group[np.isin(group, met)] = group[i]
        if (group == np.arange(n)).all():
            continue
        order = np.argsort(group, kind="stable")
        found = set()
        for own in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
            if len(own) > FEW:
                found.add(np.sort(cell.node[own]).tobytes())
            elif len(own) > 1:
                among = np.zeros(n, dtype=bool)
                among[own] = True
                found.update(np.sort(cell.node[[i, j]]).tobytes() for i in own for j in cell.partners(i, among))
        yield pd.DataFrame({"nodes": list(found)}, dtype=object)


def _cell_links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links between the sets of a group that join two components, no more than join them."""
    for columns in _each_cell(frames, "bucket"):
        sets = [np.frombuffer(x, dtype=np.uint64) for x in columns["shingles"]]
        cell = _Cell(columns, [_parities(s, EXACT_FINER, 4096) for s in sets])
        part, links = cell.label.copy(), []
        for i in range(len(sets) - 1):
            for j in cell.partners(i, part != part[i]).tolist():
                if part[j] != part[i] and _exactly(sets[i], sets[j]):
                    part[part == part[j]] = part[i]
                    links.append((cell.node[i], cell.node[j]))
        yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _sets_of(wanted: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes given, made anew from one text for each."""
    rows = staged(nodes.join(wanted, "node").select("row").distinct(), "in-pairs")
    return staged(matching(texts, rows, "row", "left_semi").select("text").mapInPandas(
        _with_sets, "node long, shingles binary").dropDuplicates(["node"]), "sets")


def _linked(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose sets pass the check; sets are made anew for those in pairs only."""
    sets = _sets_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), nodes, texts)
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return staged(pairs.join(left, "a").join(right, "b").filter(_similar("left", "right")).select("a", "b"), "links")


def _linked_in_groups(groups: DataFrame, labels: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links that join the components of each group, the sets of which meet in cells."""
    members = groups.withColumn("bucket", F.xxhash64("nodes")).mapInPandas(_members, "bucket long, node long")
    sets = _sets_of(members.select("node").distinct(), nodes, texts)
    rows = members.join(nodes.select("node", "n_shingles"), "node").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    cells = _cells(rows, "bucket", F.col("n_shingles") * 8, sets)
    return staged(cells.mapInPandas(_cell_links, "a long, b long").distinct(), "group-links")


def matching(docs: DataFrame, ids: DataFrame, column: str | list[str], how: str) -> DataFrame:
    """Semi or anti join on ids.

    The ids are broadcast only if a count finds no more than BROADCAST_IDS of them, 32 MB
    at most; else both sides are shuffled.
    """
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, column, how)


def _row(id_col: str, text: str):
    """Id and text of a row as one value; a null id is a value too, a null text an empty one."""
    return F.struct(F.col(f"`{id_col}`").alias("doc"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("version"))


def _placed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(row, n_shingles, label) for each row: one label for each component, null without words."""
    spark = docs.sparkSession
    texts = docs.select(_row(id_col, text).alias("row"), F.col(f"`{text}`").alias("text"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    known = staged(texts.withColumn("of", _described("text")).select("row", "of.*"), "shingled")
    nodes = known.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("row").alias("row"), F.first("n_shingles").alias("n_shingles"), F.first("bins").alias("bins"))
    blocks = texts.select("text").mapInPandas(_signer(partitions), "home int, signatures binary, nodes binary, counts binary")
    buckets = staged(blocks.groupBy("home").applyInPandas(_buckets, "nodes binary"), "buckets")
    stars = staged(buckets.mapInPandas(_stars, "a long, b long").distinct(), "stars")

    side = lambda end: nodes.select(F.col("node").alias(end), F.struct("n_shingles", "bins").alias(f"of_{end}"))
    near = staged(stars.join(side("a"), "a").join(side("b"), "b").filter(_close(
        "of_a.bins", "of_b.bins", F.col("of_a.n_shingles") + F.col("of_b.n_shingles"))).select("a", "b"), "near")
    links = _linked(near, nodes, texts)
    labels = components(links)

    # a bucket of two is done with its star
    members = (buckets.filter(F.octet_length("nodes") > 16).distinct()
               .withColumn("bucket", F.xxhash64("nodes"))
               .mapInPandas(_members, "bucket long, node long")
               .join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    open_ = members.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    rest = members.join(open_.select("bucket"), "bucket", "left_semi").join(nodes.select("node", "n_shingles"), "node")
    cells = _cells(rest, "bucket", F.greatest(F.lit(64), F.col("n_shingles") / 4), nodes.select("node", "bins"))
    groups = staged(cells.mapInPandas(_left_over, "nodes binary").distinct(), "groups")
    pairs = groups.filter(F.octet_length("nodes") == 16).mapInPandas(_stars, "a long, b long")
    untried = staged(pairs.join(stars, ["a", "b"], "left_anti"), "untried")
    more = [_linked(untried, nodes, texts)] if not untried.isEmpty() else []
    large = groups.filter(F.octet_length("nodes") > 16)
    if not large.isEmpty():
        more.append(_linked_in_groups(large, labels, nodes, texts))
    if more:
        labels = components(reduce(DataFrame.union, more, links))

    return known.join(labels, "node", "left").select("row", "n_shingles", F.coalesce("label", "node").alias("label"))


def with_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for each row.

    A set holds the distinct five-word shingles of a text, A-Z lower-cased; with fewer
    words, the whole sequence. Rows are linked when 100 * intersection >= 80 * union of
    their sets; the component is the smallest id that links lead to. A text without
    words, or null, has 0 shingles and stands alone. Equal sets (by a 64-bit hash of all
    their shingles) are one node, however many rows have them. Repeated rows are in one
    component; further columns are left out. A null id stands after all others, so
    component_id is null only where links lead to no id.

    Sets sharing a signature form a bucket. Its first set is checked with each other one;
    after that only pairs still in two components are looked at. Sets that parities of the
    shingles by class cannot tell apart make a group: pairs of a small group are checked, the
    sets of a large one come together in cells of bounded size, and of its links only those
    leave a cell that join two components. So no bucket is turned into all its pairs, and no
    pair goes unseen.
    """
    placed = _placed(docs, id_col, text).select("row.doc", "n_shingles", "label")
    first = placed.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc").alias("first"))
    return placed.join(first, "label", "left").select(
        F.col("doc").alias(id_col), "n_shingles", F.coalesce("first", "doc").alias("component_id"))


def _members(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        lists = [np.frombuffer(x, dtype=np.int64) for x in frame["nodes"]]
        yield pd.DataFrame({"bucket": np.repeat(frame["bucket"].to_numpy(), [len(x) for x in lists]),
                            "node": np.concatenate(lists) if lists else np.empty(0, dtype=np.int64)})


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, that of the smallest id, with the columns it came with.

    A null id stands after all others. Of rows with one id the smallest hash of the text
    stays, and of rows with one id and text the smallest hash of the row. Texts without
    words stand alone; only rows repeated with the same id and text are one.
    """
    rows = staged(_placed(docs, id_col, text).groupBy("row").agg(
        F.first("label").alias("label"), F.count(F.lit(1)).alias("n")), "placed")
    order = F.struct(F.col("row.doc").isNull().alias("last"), "row")
    first = rows.filter("label IS NOT NULL").groupBy("label").agg(F.min(order).alias("first"))
    listed = staged(rows.join(first, "label", "left").select(
        "row", "n", (F.col("label").isNotNull() & (F.col("first.row") != F.col("row"))).alias("gone"))
        .filter("gone OR n > 1"), "near-copies")
    row, nth = free_name(docs, "row__"), free_name(docs, "nth__")
    keyed = docs.withColumn(row, _row(id_col, text))
    ids = listed.select(F.col("row").alias(row), "gone")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    single = matching(keyed, ids.select(row), row, "left_anti").select(*columns)
    repeated = matching(keyed, ids.filter("NOT gone").select(row), row, "left_semi").withColumn(
        nth, F.row_number().over(Window.partitionBy(row).orderBy(F.xxhash64(F.to_json(F.struct(*columns))))))
    return single.unionByName(repeated.filter(F.col(nth) == 1).select(*columns))
