"""Suffix-array dedup: bytes covered by strings that start earlier in the corpus.

Windows of ``WINDOW`` bytes can be equal only if the least hash among their inner grams is
equal, so that hash says where a window is looked at: suffixes are dealt out by content,
and every task sorts those it holds by difference cover and compares neighbours. Only
stretches of text whose hash occurs again are moved at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import free_name, staged, worker_memo
from millrace.llm.jaccard_join import matching
from millrace.llm.shingles import mixed
from millrace.llm.suffix_array import equal_runs

WINDOW = 100
GRAM = 50
# Windows of one stretch, bytes hashed at once, and bytes sorted at once if groups are small.
STRETCH = 512
SLICE = 1 << 17
SORTED = 1 << 17
#: hashes that a task holds before it sends a block on, some 80 bytes each while they are dealt out
BLOCK_STRETCHES = 250_000
#: stretches that a task remembers to have sent
KEPT_BYTES = 32 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
    power = lambda base: np.cumprod(np.full(SLICE + WINDOW, base, dtype=np.uint64))
    symbols = mixed(np.arange(1, 257, dtype=np.uint64))
    return power(MULTIPLIER), power(inverse), symbols


def _over(pick, values: np.ndarray, span: int) -> np.ndarray:
    """``pick`` (minimum or maximum) of each ``span`` neighbours."""
    reach = 1
    while reach * 2 <= span:
        values, reach = pick(values[:-reach], values[reach:]), reach * 2
    return pick(values[:len(values) - (span - reach)], values[span - reach:]) if reach < span else values


def _least_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For each window of the text, the least hash of the grams in it.

    And the hashes of grams that are least and stand twice at most a window's grams apart,
    so that no window between them lacks both: such text repeats itself.
    """
    powers, inverses, symbols = worker_memo(("gram powers",), _powers)
    found, again = [], []
    span = WINDOW - GRAM + 1
    for at in range(0, len(text) - WINDOW + 1, SLICE):
        # one window more than the slice has, for grams that stand on both sides of its end
        part = np.frombuffer(text, dtype=np.uint8)[at:at + SLICE + WINDOW]
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(symbols[part] * powers[:len(part)], dtype=np.uint64)])
        h = mixed((sums[GRAM:] - sums[:-GRAM]) * inverses[:len(sums) - GRAM])
        least = _over(np.minimum, h, span)
        # a gram is least in some window if the largest least hash around it is its own
        edge = np.zeros(span - 1, dtype=np.uint64)
        chosen = np.flatnonzero(_over(np.maximum, np.concatenate([edge, least, edge]), span) == h)
        near = (h[chosen][1:] == h[chosen][:-1]) & (np.diff(chosen) <= span)
        again.append(h[chosen][1:][near])
        found.append(least[:SLICE])
    return np.concatenate(found), np.concatenate(again)


def _stretches(text: bytes) -> tuple[np.ndarray, ...]:
    """Hash, first and last window of each stretch of windows with one hash, and whether
    the stretch may repeat itself."""
    h, again = _least_hashes(text)
    edge = np.flatnonzero(h[1:] != h[:-1]) + 1
    starts = np.concatenate([[0], edge])
    lengths = np.diff(np.append(starts, len(h)))
    if lengths.max() > STRETCH:
        starts = np.concatenate([np.arange(s, s + n, STRETCH) for s, n in zip(starts, lengths)])
    ends = np.append(starts[1:], len(h)) - 1
    return h[starts], starts, ends, np.isin(h[starts], again)


def _scanner(partitions: int):
    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """For each partition the hashes of stretches, and whose they are."""
        held, size = [], 0

        def blocks():
            h = np.concatenate([x[2] for x in held])
            counts = [len(x[2]) for x in held]
            doc = np.repeat(np.array([x[0] for x in held], dtype=np.int64), counts)
            version = np.repeat(np.array([x[1] for x in held], dtype=np.int64), counts)
            nth = np.concatenate([x[3] for x in held]).astype(np.uint32)
            home = (h >> np.uint64(32)) % np.uint64(partitions)
            order = np.argsort(home, kind="stable")
            cuts = np.flatnonzero(np.diff(home[order])) + 1
            for own in np.split(order, cuts):
                # the rows of one text stand together: its ids once, with a count
                new = np.ones(len(own), dtype=bool)
                new[1:] = (doc[own][1:] != doc[own][:-1]) | (version[own][1:] != version[own][:-1])
                first = np.flatnonzero(new)
                yield (int(home[own[0]]), h[own].astype(np.uint32).tobytes(), nth[own].tobytes(),
                       doc[own][first].tobytes(), version[own][first].tobytes(),
                       np.diff(np.append(first, len(own))).astype(np.uint32).tobytes())

        columns = ["home", "hashes", "nth", "docs", "versions", "counts"]
        for frame in frames:
            for doc, version, text in zip(frame["doc"], frame["version"], frame["text"]):
                raw = text.encode()
                if len(raw) < WINDOW:
                    continue
                h, _, _, again = _stretches(raw)
                # counted twice if it repeats itself
                nth = np.concatenate([np.arange(len(h)), np.flatnonzero(again)])
                held.append((doc, version, h[nth], nth))
                size += len(nth)
                if size > BLOCK_STRETCHES:
                    yield pd.DataFrame(list(blocks()), columns=columns)
                    held, size = [], 0
        if held:
            yield pd.DataFrame(list(blocks()), columns=columns)
    return scan


def _repeated(frame: pd.DataFrame) -> pd.DataFrame:
    """The stretches of each text whose hash another stretch has too."""
    join = lambda name, kind: np.concatenate([np.frombuffer(x, dtype=kind) for x in frame[name]])
    h, nth = join("hashes", np.uint32), join("nth", np.uint32)
    counts = join("counts", np.uint32)
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.argsort(h, kind="stable")
    s = h[order]
    twice = np.zeros(len(s), dtype=bool)
    twice[1:] = s[1:] == s[:-1]
    twice[:-1] |= s[1:] == s[:-1]
    chosen = np.sort(order[twice])
    owners, first = np.unique(owner[chosen], return_index=True)
    docs, versions = join("docs", np.int64), join("versions", np.int64)
    return pd.DataFrame({"doc": docs[owners], "version": versions[owners],
                         "nth": [x.tobytes() for x in np.split(nth[chosen], first[1:])] if len(first) else []})


def _runs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers."""
    edge = np.flatnonzero(np.diff(at) != 1) + 1
    return at[np.concatenate([[0], edge])], at[np.append(edge - 1, len(at) - 1)]


def _sender(partitions: int):
    columns = ["home", "hashes", "docs", "versions", "starts", "sizes", "bytes", "known"]

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Repeated stretches with their text, by partition of the hash.

        A stretch whose bytes this task has sent for a smaller document is repeated in
        all its windows; only that is passed on.
        """
        kept: dict[tuple[int, bytes], tuple[int, int]] = {}
        held, size, room = [], 0, KEPT_BYTES

        def blocks():
            by_home: dict[int, list] = {}
            for row in held:
                by_home.setdefault((row[0] >> 32) % partitions, []).append(row)
            for home, rows in by_home.items():
                h, docs, versions, starts, sizes, texts, known = zip(*rows)
                yield (home, np.array(h, dtype=np.uint64).tobytes(), np.array(docs, dtype=np.int64).tobytes(),
                       np.array(versions, dtype=np.int64).tobytes(), np.array(starts, dtype=np.int64).tobytes(),
                       np.array(sizes, dtype=np.int32).tobytes(), b"".join(texts), np.array(known, dtype=bool).tobytes())

        for frame in frames:
            for doc, version, text, parts in zip(frame["doc"], frame["version"], frame["text"], frame["nth"]):
                raw = text.encode()
                h, starts, ends, _ = _stretches(raw)
                for i in np.unique(np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in parts])).tolist():
                    begin, end, key = int(starts[i]), int(ends[i]), int(h[i])
                    piece = raw[begin:end + WINDOW]
                    earlier = kept.get((key, piece))
                    known = earlier is not None and earlier < doc
                    if not known:
                        if room < len(piece):
                            kept.clear()
                            room = KEPT_BYTES
                        kept[key, piece] = doc
                        room -= len(piece) + 200
                    held.append((key, doc, version, begin, end - begin + 1, b"" if known else piece, known))
                    size += 60 + len(held[-1][5])
                if size > 8_000_000:
                    yield pd.DataFrame(list(blocks()), columns=columns)
                    held, size = [], 0
        if held:
            yield pd.DataFrame(list(blocks()), columns=columns)
    return send


def _judged(h, doc, version, start, size, pieces) -> tuple[np.ndarray, ...]:
    """Row, first and last of each run of windows that start earlier in the corpus."""
    distinct: dict[bytes, int] = {}
    of = np.array([distinct.setdefault(piece, len(distinct)) for piece in pieces])
    # 0 ends a text, so bytes count from 1
    lengths = np.array([len(piece) for piece in distinct])
    bases = np.concatenate([[0], np.cumsum(lengths + 1)])
    text = np.frombuffer(b"".join([piece + b"\0" for piece in distinct]), dtype=np.uint8).astype(np.uint16) + 1
    text[bases[1:] - 1] = 0
    windows = lengths - WINDOW + 1
    firsts = np.concatenate([[0], np.cumsum(windows)])
    steps = np.arange(firsts[-1])
    classes = equal_runs(text, steps + np.repeat(bases[:-1] - firsts[:-1], windows), WINDOW)
    # the smallest document that has each distinct text, then each class
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, of, doc)
    smallest = np.full(int(classes.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(smallest, classes, np.repeat(least, windows))
    # a stretch that a smaller document has as a whole is repeated in all its windows: only the others are laid out
    whole, laid = np.flatnonzero(least[of] < doc), np.flatnonzero(least[of] == doc)
    row, sizes = np.repeat(laid, size[laid]), size[laid]
    step = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    own = classes[np.repeat(firsts[of[laid]], sizes) + step]
    at = np.repeat(start[laid], sizes) + step
    again = smallest[own] < doc[row]
    # in the smallest document itself, all but its first start
    rest = np.flatnonzero(~again)
    rest = rest[np.lexsort((at[rest], version[row[rest]], own[rest]))]
    later = ((own[rest][1:] == own[rest][:-1]) & (version[row[rest]][1:] == version[row[rest]][:-1]))
    # repeated rows of one id and text are one document: the same start is not an earlier one
    begins = np.concatenate([[True], ~later]) if len(rest) else np.empty(0, dtype=bool)
    earliest = at[rest][begins][np.cumsum(begins) - 1] if len(rest) else rest
    again[rest] = at[rest] > earliest
    hit = np.flatnonzero(again)
    if not len(hit):
        return whole, start[whole], start[whole] + size[whole] - 1
    edge = np.flatnonzero((np.diff(row[hit]) != 0) | (np.diff(at[hit]) != 1)) + 1
    begin, end = np.concatenate([[0], edge]), np.append(edge - 1, len(hit) - 1)
    return (np.concatenate([whole, row[hit[begin]]]), np.concatenate([start[whole], at[hit[begin]]]),
            np.concatenate([start[whole] + size[whole] - 1, at[hit[end]]]))


def _sorted_windows(frame: pd.DataFrame) -> pd.DataFrame:
    """(doc, version, spans): first and last of runs of repeated windows, as pairs of longs."""
    join = lambda name, kind: np.concatenate([np.frombuffer(x, dtype=kind) for x in frame[name]])
    h, doc, version = join("hashes", np.uint64), join("docs", np.int64), join("versions", np.int64)
    start, size, known = join("starts", np.int64), join("sizes", np.int32).astype(np.int64), join("known", bool)
    texts = b"".join(frame["bytes"])
    ends = np.cumsum(np.where(known, 0, size + WINDOW - 1))
    found = [(doc[known], version[known], start[known], start[known] + size[known] - 1)]
    rows = np.flatnonzero(~known)
    rows = rows[np.argsort(h[rows], kind="stable")]
    # whole groups of one hash, as many as make a slice
    total = np.cumsum(size[rows] + WINDOW)
    group_ends = np.append(np.flatnonzero(np.diff(h[rows])) + 1, len(rows)) if len(rows) else []
    at, taken = 0, 0
    for n, end in enumerate(group_ends):
        if total[end - 1] - taken < SORTED and n + 1 < len(group_ends):
            continue
        some = rows[at:end]
        at, taken = end, total[end - 1]
        pieces = [texts[ends[r] - size[r] - WINDOW + 1:ends[r]] for r in some]
        row, first, last = _judged(h[some], doc[some], version[some], start[some], size[some], pieces)
        found.append((doc[some][row], version[some][row], first, last))
    doc, version, first, last = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((first, version, doc))
    doc, version = doc[order], version[order]
    spans = np.stack([first[order], last[order]], axis=1)
    new = np.flatnonzero((np.diff(doc) != 0) | (np.diff(version) != 0)) + 1
    begins = np.concatenate([[0], new]) if len(doc) else np.empty(0, dtype=np.int64)
    return pd.DataFrame({"doc": doc[begins], "version": version[begins],
                         "spans": [x.tobytes() for x in np.split(spans, new)] if len(doc) else []})


def _removed(parts: list[bytes]) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes, as [begin, end)."""
    pairs = np.concatenate([np.frombuffer(x, dtype=np.int64).reshape(-1, 2) for x in parts])
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1] + WINDOW)
    new = np.flatnonzero(pairs[1:, 0] > reach[:-1]) + 1
    begins = pairs[np.concatenate([[0], new]), 0]
    return list(zip(begins.tolist(), reach[np.append(new - 1, len(reach) - 1)].tolist()))


SPANS = "array<struct<begin:bigint,end:bigint>>"


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for doc, version, text, parts, whole in zip(*(frame[c] for c in ("doc", "version", "text", "parts", "whole"))):
            raw = text.encode()
            runs = [(0, len(raw))] if whole else _removed(list(parts))
            at, left = 0, []
            for begin, end in runs:
                left.append(raw[at:begin])
                at = end
            rows.append((doc, version, [{"begin": b, "end": e} for b, e in runs], b"".join([*left, raw[at:]])))
        yield pd.DataFrame(rows, columns=["doc", "version", "spans", "kept"])


def _texts(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    doc = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-2 ** 63))
    return docs.select(doc.alias("doc"), F.xxhash64(body).alias("version"), body.alias("text"))


def repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, version, spans, kept) of the texts that lose bytes, each once.

    Removed is each byte covered by a string of WINDOW bytes that also starts earlier:
    in a text of a smaller id, or earlier in the same text. ``spans`` are the maximal
    removed runs, ``kept`` the other bytes; ``version`` is a hash of the text. Null texts
    are empty, a null id stands before all others, rows with one id are not earlier than
    each other, and repeated rows are one text. A text that equals one of a smaller id as a whole is removed as a whole
    and takes no part in the search, as each string in it starts earlier there.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = _texts(docs, id_col, text)
    facts = staged(texts.filter(F.octet_length("text") >= WINDOW).select(
        "doc", "version", F.sha2("text", 256).alias("digest")).distinct(), "texts")
    first = facts.groupBy("digest").agg(F.min("doc").alias("first"), F.count("*").alias("n")).filter("n > 1")
    copies = staged(facts.join(first, "digest").filter("doc > first").select("doc", "version"), "copies")
    own = matching(texts, copies, ["doc", "version"], "left_anti")

    where = own.mapInPandas(_scanner(partitions), "home int, hashes binary, nth binary, docs binary, versions binary, counts binary")
    again = staged(where.groupBy("home").applyInPandas(_repeated, "doc long, version long, nth binary")
                   .groupBy("doc", "version").agg(F.collect_list("nth").alias("nth")), "repeated")
    sent = (matching(own, again.select("doc", "version"), ["doc", "version"], "left_semi")
            .dropDuplicates(["doc", "version"]).join(again, ["doc", "version"])
            .mapInPandas(_sender(partitions), "home long, hashes binary, docs binary, versions binary, starts binary, "
                         "sizes binary, bytes binary, known binary"))
    windows = sent.groupBy("home").applyInPandas(_sorted_windows, "doc long, version long, spans binary")
    losses = staged(windows.groupBy("doc", "version").agg(F.collect_list("spans").alias("parts"))
                    .withColumn("whole", F.lit(False)).unionByName(
                        copies.select("doc", "version", F.array().cast("array<binary>").alias("parts"), F.lit(True).alias("whole"))),
                    "losses")
    return (matching(texts, losses.select("doc", "version"), ["doc", "version"], "left_semi")
            .dropDuplicates(["doc", "version"]).join(losses, ["doc", "version"])
            .mapInPandas(_cut, f"doc long, version long, spans {SPANS}, kept binary"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", spans: str = "removed",
                    kept: str = "kept") -> DataFrame:
    """Adds the removed runs of each text and the bytes that are left.

    Every row stays, repeated ones too. Columns of those two names are replaced.
    """
    new = {spans.lower(), kept.lower()}
    plain = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new or c in (id_col, text)])
    doc, version, runs, rest = (free_name(plain, c) for c in ("doc__", "version__", "spans__", "kept__"))
    found = staged(repeats(docs, id_col, text), "removed").toDF(doc, version, runs, rest)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = plain.withColumns({doc: F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-2 ** 63)),
                              version: F.xxhash64(body)})
    keep = [F.col(f"`{c}`") for c in plain.columns if c.lower() not in new]
    ids = found.select(doc, version)
    whole = matching(rows, ids, [doc, version], "left_anti").select(
        *keep, F.array().cast(SPANS).alias(spans), body.cast("binary").alias(kept))
    cut = matching(rows, ids, [doc, version], "left_semi").join(found, [doc, version]).select(
        *keep, F.col(runs).alias(spans), F.col(rest).alias(kept))
    return whole.unionByName(cut)


def with_kept_text(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The same rows and columns with what is left of each text.

    Runs may begin or end within a character; what is left of such a character goes too.
    A null text becomes an empty one.
    """
    spans, kept = free_name(docs, "removed"), free_name(docs, "kept")

    @F.pandas_udf("string")
    def readable(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: b.decode("utf-8", "ignore"))

    return without_repeats(docs, id_col, text, spans, kept).select(
        *[(readable(F.col(f"`{kept}`")) if c == text else F.col(f"`{c}`")).alias(c) for c in docs.columns])
