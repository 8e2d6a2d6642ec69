"""BPE encoding and decoding, with tree concatenation for long unsplit text."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import free_name, worker_memo

LEAF = 64
SHORT = 256
MEMO_CHUNKS = 100_000
BATCH_ROWS = 256
LONG_CHARS = 32_768
PIECE_CHARS = 16_384
_CHUNK = re.compile(r"[^\x20\x09-\x0D]+")
# Letters that no normalization form changes, then punctuation: two units at most.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-/:-@\[-`{-~]*)")
TEXT, UNITS, PART = 0, 1, 2


class Bpe:
    """A vocabulary with merges, read from a file of the tokenizers library.

    Normalizer and pre-tokenizer are the file's own, run by that library on one chunk
    between white space at a time; a unit is what they leave unsplit. Merges are made
    here: the pair of lowest rank first, of equal ones the leftmost.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        # without the vocabulary, which the library would hold a second time
        library = Tokenizer.from_str(json.dumps(
            {**spec, "model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": [], "post_processor": None}))
        self.normalize = library.normalizer.normalize_str if library.normalizer else str
        self.split = library.pre_tokenizer.pre_tokenize_str
        model = spec["model"]
        vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.vocab = vocab
        self.merges, self.width = {}, [1] * len(self.tokens)
        self.rank, self.made = {}, []
        for rank, (a, b) in enumerate(model["merges"]):
            new = vocab[a + b]
            pair = vocab[a], vocab[b]
            self.merges[pair] = (rank, new)
            self.rank[pair] = rank
            self.made.append(new)
            self.width[new] = self.width[vocab[a]] + self.width[vocab[b]]
        self.cut_special = re.compile(f"({'|'.join(map(re.escape, self.special))})") if self.special else None
        self.plain = spec["normalizer"] is not None and "Lowercase" in json.dumps(spec["normalizer"])
        # the simple case holds for a split into letters, digits and other characters
        splits = json.dumps(spec["pre_tokenizer"])
        self.plain &= "\\\\p{L}]+|" in splits and "[^\\\\s\\\\p{L}\\\\p{N}]+" in splits
        self.base = [self._byte(b) for b in range(256)]
        self.memo: dict[bytes, bytes] = {}
        self.known_units: dict[str, list[int]] = {}

    def _byte(self, b: int) -> str:
        """The character that stands for a byte: itself if printable, else from 256 on."""
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        if b in printable:
            return chr(b)
        return chr(256 + sum(1 for x in range(b) if x not in printable))

    def symbols(self, unit: str, ends: bool = True) -> list[int]:
        """Ids of a unit's characters; the last one has the word end, if the unit ends here."""
        ids = [self.vocab[c] for c in unit]
        if ends and self.suffix:
            ids[-1] = self.vocab[unit[-1] + self.suffix]
        return ids

    def merge(self, ids: list[int]) -> list[int]:
        n, merges = len(ids), self.merges
        if n < 2:
            return ids
        if n <= SHORT:
            return self._merge_short(ids)
        ids = ids[:]
        heap = [(m[0], i, m[1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            _, i, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or (m := merges.get((ids[i], ids[j]))) is None or m[1] != new:
                continue
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if m := merges.get((new, ids[k])):
                    heapq.heappush(heap, (m[0], i, m[1]))
            if (h := before[i]) >= 0 and (m := merges.get((ids[h], new))):
                heapq.heappush(heap, (m[0], h, m[1]))
        return [i for i in ids if i >= 0]

    def _merge_short(self, ids: list[int]) -> list[int]:
        get, none = self.rank.get, len(self.made)
        ids = ids[:]
        ranks = [get(pair, none) for pair in zip(ids, ids[1:])]
        while ranks and (rank := min(ranks)) < none:
            i = ranks.index(rank)
            ids[i:i + 2] = [new] = [self.made[rank]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get((new, ids[i + 1]), none)
            if i:
                ranks[i - 1] = get((ids[i - 1], new), none)
        return ids

    def join(self, left: list[int], right: list[int], symbols: list[int], cut: int) -> list[int]:
        """The encoding of all symbols from those of its two sides, which meet at ``cut``.

        The last tokens of the left and the first of the right are encoded anew, more of
        them each time, until the outermost tokens come out as they were. Two neighbours
        that belong to one encoding stay neighbours in any other, so nothing beyond them
        can change.
        """
        k = 2
        while True:
            a, b = left[-k:], right[:k]
            whole_left, whole_right = k >= len(left), k >= len(right)
            new = self.merge(symbols[cut - sum(map(self.width.__getitem__, a)):cut + sum(map(self.width.__getitem__, b))])
            if (whole_left or new[0] == a[0]) and (whole_right or new[-1] == b[-1]):
                return left[:len(left) - len(a)] + new + right[len(b):]
            k *= 2

    def tree(self, symbols: list[int]) -> list[int]:
        """Halves encoded each by itself, and joined."""
        if len(symbols) <= LEAF:
            return self.merge(symbols)
        cut = len(symbols) // 2
        return self.join(self.tree(symbols[:cut]), self.tree(symbols[cut:]), symbols, cut)

    def units(self, chunk: str) -> Iterator[tuple[str | None, int]]:
        """(unit, -1), or (None, id) for a special token that stands in the text."""
        for piece in self.cut_special.split(chunk) if self.cut_special else [chunk]:
            if piece in self.special:
                yield None, self.special[piece]
            elif piece:
                for unit, _ in self.split(self.normalize(piece)):
                    yield unit, -1

    def _unit(self, unit: str) -> list[int]:
        found = self.known_units.get(unit)
        if found is None:
            spelled = unit if unit.isascii() else "".join([self.base[b] for b in unit.encode()])
            found = self.tree(self.symbols(spelled))
            if len(self.known_units) < MEMO_CHUNKS:
                self.known_units[unit] = found
        return found

    def chunk(self, chunk: str) -> bytes:
        simple = _SIMPLE.fullmatch(chunk) if self.plain else None
        if simple:
            return pack([i for unit in simple.groups() if unit for i in self._unit(unit.lower())])
        ids = []
        for unit, special in self.units(chunk):
            ids += [special] if unit is None else self.tree(self.symbols(unit))
        return pack(ids)

    def text(self, text: str | None) -> bytes:
        # splits where _CHUNK does
        chunks, memo = (text or "").encode().split(), self.memo
        new = set(chunks).difference(memo)
        for chunk in new:
            memo[chunk] = self.chunk(chunk.decode())
        packed = b"".join(map(memo.__getitem__, chunks))
        # frequent chunks come early: once full, the memo keeps those it has
        if len(memo) > MEMO_CHUNKS:
            for chunk in new:
                del memo[chunk]
        return packed

    def pieces(self, text: str) -> Iterator[tuple[int, list[str], bool]]:
        """(kind, body, goes on): cut at white space, and units that are long in parts."""
        at = 0
        while at < len(text):
            end = at + PIECE_CHARS
            if end >= len(text):
                end = len(text)
                gap = end if end - at <= PIECE_CHARS else None
            else:
                gap = max(text.rfind(c, at, end) for c in " \t\n\x0b\x0c\r")
            if gap is not None and gap >= at:
                end = max(gap, at + 1)
                yield TEXT, [text[at:end]], False
            else:
                found = _CHUNK.match(text, at)
                end = found.end()
                yield from self._run(text[at:end])
            at = end

    def _run(self, run: str) -> Iterator[tuple[int, list[str], bool]]:
        body, size = [], 0
        for unit, special in self.units(run):
            token = self.tokens[special] if unit is None else unit
            if body and (unit is None or size + len(token) > PIECE_CHARS):
                yield UNITS, body, False
                body, size = [], 0
            if unit is None:
                yield TEXT, [token], False
            elif len(unit) > PIECE_CHARS:
                for i in range(0, len(unit), PIECE_CHARS):
                    yield PART, [unit[i:i + PIECE_CHARS]], i + PIECE_CHARS < len(unit)
            else:
                body.append(unit)
                size += len(unit)
        if body:
            yield UNITS, body, False

    def piece(self, kind: int, body: list[str], goes_on: bool) -> bytes:
        if kind == TEXT:
            return self.text(body[0])
        if kind == PART:
            return pack(self.tree(self.symbols(body[0], not goes_on)))
        return pack([i for unit in body for i in self.tree(self.symbols(unit))])

    def joined(self, pieces: list[tuple[int, list[str], bool, bytes]]) -> bytes:
        """One text from its pieces in order; parts of a unit meet in pairs."""
        out, open_ = [], []
        for kind, body, goes_on, ids in pieces:
            if kind != PART:
                out.append(ids)
                continue
            open_.append((self.symbols(body[0], not goes_on), unpack(ids).tolist()))
            if not goes_on:
                while len(open_) > 1:
                    pairs = [((a[0] + b[0]), self.join(a[1], b[1], a[0] + b[0], len(a[0])))
                             for a, b in zip(open_[::2], open_[1::2])]
                    open_ = pairs + open_[len(pairs) * 2:]
                out.append(pack(open_.pop()[1]))
        return b"".join(out)


def pack(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.asarray(ids, dtype="<u4").tobytes()


def unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, dtype="<u4")


def _bpe(path: str) -> Bpe:
    return worker_memo(("bpe", path), lambda: Bpe(path))


def _adding(path: str, column: str, into: list[str], make):
    """A function on Arrow batches that adds columns, few rows at a time."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(path)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                new = make(bpe, part.column(column).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *into])
    return add


def _encoded(bpe: Bpe, texts: list[str | None]) -> list[pa.Array]:
    return [pa.array([bpe.text(t) for t in texts], pa.binary())]


def _decoded(bpe: Bpe, ids: list[bytes | None]) -> list[pa.Array]:
    token = bpe.tokens.__getitem__
    return [pa.array([" ".join(map(token, unpack(p or b"").tolist())) for p in ids], pa.string())]


def _plain(df: DataFrame, drop: str, keep: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != drop.lower() or c == keep])


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids",
           long_chars: int = LONG_CHARS) -> DataFrame:
    """Adds the ids of each text, packed as little-endian unsigned 32-bit integers.

    The ids are those that the tokenizers library gives for the file in ``path`` with no
    special tokens added. Texts of more than ``long_chars`` are cut into pieces that
    tasks share, each distinct text once; a piece ends at white space, or within a unit
    where none is near, and such parts are joined again. A null text counts as empty, and
    an empty or blank one has no ids. Rows stay as they are, repeated ones too; a column
    named like ``into`` is replaced. Every executor must be able to read ``path``.
    """
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = _bpe(path)
        for frame in frames:
            for key, text in zip(frame["key"], frame["body"]):
                rows = [(key, n, *piece) for n, piece in enumerate(bpe.pieces(text))]
                yield pd.DataFrame(rows, columns=["key", "n", "kind", "body", "goes_on"])

    @F.pandas_udf("binary")
    def part(kind: pd.Series, body: pd.Series, goes_on: pd.Series) -> pd.Series:
        bpe = _bpe(path)
        return pd.Series([bpe.piece(k, list(b), g) for k, b, g in zip(kind, body, goes_on)], dtype=object)

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("n")
        pieces = zip(frame["kind"], map(list, frame["body"]), frame["goes_on"], frame["ids"])
        return pd.DataFrame({"key": frame["key"].iloc[:1], "ids": [_bpe(path).joined(list(pieces))]})

    plain = _plain(docs, into, text)
    kept = [F.col(f"`{c}`") for c in plain.columns if c.lower() != into.lower()]
    ids, key = free_name(plain, "ids__"), free_name(plain, "key__")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    schema = T.StructType([*plain.schema.fields, T.StructField(ids, T.BinaryType())])
    short = plain.filter(F.length(body) <= long_chars).mapInArrow(_adding(path, text, [ids], _encoded), schema)
    long = plain.filter(F.length(body) > long_chars).withColumn(key, F.sha2(body, 256))
    texts = long.select(F.col(key).alias("key"), body.alias("body")).dropDuplicates(["key"])
    pieces = texts.mapInPandas(cut, "key string, n int, kind int, body array<string>, goes_on boolean")
    encoded = pieces.repartition("key", "n").withColumn("ids", part("kind", "body", "goes_on"))
    joined = encoded.groupBy("key").applyInPandas(join, "key string, ids binary").toDF(key, ids)
    return short.select(*kept, F.col(ids).alias(into)).unionByName(
        long.join(joined, key).select(*kept, F.col(ids).alias(into)))


def decode(encoded: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds the text of packed ids as the library gives it, special tokens kept.

    Without a decoder in the file that is the tokens with a space between. Null ids
    count as none. A column named like ``into`` is replaced.
    """
    plain = _plain(encoded, into, ids)
    text = free_name(plain, "decoded__")
    schema = T.StructType([*plain.schema.fields, T.StructField(text, T.StringType())])
    return plain.mapInArrow(_adding(path, ids, [text], _decoded), schema).select(
        *[F.col(f"`{c}`") for c in plain.columns if c.lower() != into.lower()], F.col(text).alias(into))
