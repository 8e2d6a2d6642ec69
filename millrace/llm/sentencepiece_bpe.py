"""SentencePiece encoding and decoding for vocabularies made by merges.

A text starts as characters. All pairs of neighbours that form a piece stand in an agenda
ordered by score, of equal scores the leftmost first. The first pair becomes one symbol,
which may form new pairs with its neighbours, until the agenda is empty. The agenda of a long
chunk is a heap; those of many short chunks are rows of arrays.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import free_name, worker_memo

SPACE = "▁"
BATCH_ROWS = 512
MEMO_BYTES = 160 << 20
ENTRY_BYTES = 220
SHORT = 128
#: chunks that are merged side by side
ROWS = 8192
#: no byte of UTF-8: a control piece has no text, but parts the bytes at its sides
NO_TEXT = b"\xff"
_POSITION = (1 << 40) - 1


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(message):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, message[at:at + size]
        at += size


class Pieces:
    """A vocabulary read from a model file of the sentencepiece library.

    The normalizer is the file's own, run by that library. Merging, ids and decoding are
    done here. A file whose pieces are not made by merges is an error.
    """

    # Fixed values of the file format: fields of a model, of its trainer and its normalizer.
    TRAINER, NORMALIZER, DENORMALIZER = 2, 3, 5
    MODEL_TYPE, SUFFIX, MERGES = 3, 24, 2
    CHARSMAP, PREFIX, TRIM = 2, 3, 4

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = library = SentencePieceProcessor(model_file=path)
        model = dict(_fields(library.serialized_model_proto()))
        trainer = dict(_fields(model.get(self.TRAINER, b"")))
        normalizer = dict(_fields(model.get(self.NORMALIZER, b"")))
        if trainer.get(self.MODEL_TYPE, 1) != self.MERGES:
            raise ValueError(f"{path} is not a vocabulary of merges")
        if trainer.get(self.SUFFIX) or dict(_fields(model.get(self.DENORMALIZER, b""))).get(self.CHARSMAP):
            raise ValueError(f"{path} marks word ends or changes decoded text, which is not supported")
        self.prefix, self.trim = normalizer.get(self.PREFIX, 1), normalizer.get(self.TRIM, 1)

        n = library.get_piece_size()
        self.pieces = [library.id_to_piece(i) for i in range(n)]
        self.control = {i for i in range(n) if library.is_control(i)}
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i in range(n) if library.is_byte(i)}
        self.unknown = library.unk_id()
        special = self.control | set(self.bytes.values()) | {self.unknown}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special}
        # better scores come first; equal scores share a place
        scores = {p: library.get_score(i) for p, i in self.ids.items()}
        places = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.order = {p: places[s] << 40 for p, s in scores.items()}
        self.unused = {p for p, i in self.ids.items() if library.is_unused(i)}
        # the file does not say which pieces are the user's own: those the normalizer keeps whole
        kinds = [dict(_fields(f)) for k, f in _fields(library.serialized_model_proto()) if k == 1]
        own = sorted((self.pieces[i] for i, f in enumerate(kinds) if f.get(3, 1) == 4), key=len, reverse=True)
        self.own = frozenset(own)
        self.cut_own = re.compile("|".join(map(re.escape, own))) if own else None

        # no piece goes on after a space, so a text falls apart in front of spaces, and at
        # characters that join no other
        self.apart = bool(self.bytes) and not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        joined = set().union(*(p for p in self.ids if len(p) > 1))
        alone = "".join(re.escape(c) for c in map(chr, range(128)) if c not in joined and c != "\0")
        self.chunks = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+|[{alone}]" if self.apart and alone else
                                 f"{SPACE}*[^{SPACE}]+|{SPACE}+" if self.apart else r"(?s:.+)")
        self.line_ends = "\n" not in joined
        self.side_by_side = SideBySide(self) if self.bytes and not own and not self.unused else None
        self.memo: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.held = 0

        raw = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for i in self.control:
            raw[i] = NO_TEXT
        for byte, i in self.bytes.items():
            raw[i] = bytes([byte])
        raw[self.unknown] = " ⁇ ".encode()
        self.raw = raw

    def symbols(self, chunk: str) -> tuple[list[str], set[int]]:
        """Characters, and the user's own pieces, which stay as they are: their places."""
        if self.cut_own is None:
            return list(chunk), set()
        found, frozen, at = [], set(), 0
        for hit in self.cut_own.finditer(chunk):
            found += chunk[at:hit.start()]
            frozen.add(len(found))
            found.append(hit.group())
            at = hit.end()
        return found + list(chunk[at:]), frozen

    def merged(self, chunk: str) -> list[str]:
        """The pieces of a chunk; the agenda holds one number for each pair, its place and position."""
        symbols, frozen = self.symbols(chunk)
        order, n = self.order, len(symbols)
        if n < 2:
            return symbols
        parts = {} if self.unused else None
        agenda = []
        for i in range(n - 1):
            place = order.get(symbols[i] + symbols[i + 1])
            if place is not None and i not in frozen and i + 1 not in frozen:
                agenda.append(place + i)
                if parts is not None:
                    parts[symbols[i] + symbols[i + 1]] = symbols[i], symbols[i + 1]
        heapq.heapify(agenda)
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        get, push, pop = order.get, heapq.heappush, heapq.heappop
        while agenda:
            first = pop(agenda)
            i = first & _POSITION
            j = after[i]
            if j >= n or not (left := symbols[i]):
                continue
            piece = left + symbols[j]
            # one of the two has changed since
            if get(piece) != first - i or frozen and (i in frozen or j in frozen):
                continue
            symbols[i], symbols[j] = piece, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (place := get(piece + symbols[k])) is not None and k not in frozen:
                    push(agenda, place + i)
                    if parts is not None:
                        parts[piece + symbols[k]] = piece, symbols[k]
            h = before[i]
            if h >= 0 and (place := get(symbols[h] + piece)) is not None and h not in frozen:
                push(agenda, place + h)
                if parts is not None:
                    parts[symbols[h] + piece] = symbols[h], piece
        merged = [s for s in symbols if s]
        return [p for s in merged for p in self._split(s, parts)] if parts else merged

    def _split(self, piece: str, parts: dict[str, tuple[str, str]]) -> Iterator[str]:
        """A piece marked as unused falls apart again into what it was made of."""
        todo = [piece]
        while todo:
            piece = todo.pop()
            if piece in self.unused and piece in parts:
                left, right = parts[piece]
                todo += [right, left]
            else:
                yield piece

    def chunk(self, chunk: str) -> bytes:
        """Ids as 32-bit integers; a character without a piece becomes its bytes, or is unknown."""
        pieces = self.merged(chunk)
        found = list(map(self.ids.get, pieces))
        if None in found:
            spelled = []
            for piece, i in zip(pieces, found):
                if i is not None:
                    spelled.append(i)
                elif self.bytes:
                    spelled += [self.bytes[b] for b in piece.encode()]
                elif not spelled or spelled[-1] != self.unknown:
                    spelled.append(self.unknown)
            found = spelled
        return array("i", found).tobytes()

    def cut(self, text: str) -> list[str]:
        """A normalized text in chunks that can be merged by themselves; some may be empty."""
        if not self.apart or SPACE * 2 in text or " " in text:
            return self.chunks.findall(text)
        text = text.replace(SPACE, " " + SPACE)
        return (text.replace("\n", " \n ") if self.line_ends else text).split(" ")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as 32-bit integers.

        Chunks are remembered in two halves of MEMO_BYTES. When the younger one is full the
        older one is dropped: what has been used since is in the younger one too.
        """
        memo, older, packed = self.memo, self.older, []
        split = [self.cut(self.library.normalize(t or "")) for t in texts]
        new = set().union(*split).difference(memo)
        known = {c: older[c] for c in new if c in older}
        new = [c for c in new if c not in known]
        if self.side_by_side:
            known.update(self.side_by_side.encode([c for c in new if len(c) < SHORT]))
            new = [c for c in new if len(c) >= SHORT]
        known.update((c, self.chunk(c)) for c in new)
        memo.update(known)
        self.held += sum(ENTRY_BYTES + len(c) + len(found) for c, found in known.items())
        for chunks in split:
            packed.append(b"".join(map(memo.__getitem__, chunks)))
        if self.held > MEMO_BYTES // 2:
            self.memo, self.older, self.held = {"": b""}, memo, 0
        return packed

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids in UTF-8, as the library gives it."""
        listed = ids.tolist()
        text = b"".join(map(self.raw.__getitem__, listed))
        at = 0
        if self.prefix or self.trim:
            # the space in front of the first piece was put there by the normalizer
            for i in listed:
                if i in self.control:
                    continue
                if i == self.unknown or not self.pieces[i].startswith(SPACE):
                    break
                at += 1
                if not self.trim or self.pieces[i] != SPACE:
                    break
        try:
            text.decode()
        except UnicodeDecodeError:
            return self._mended(listed, at)
        return text[at:]

    def _mended(self, ids: list[int], drop: int) -> bytes:
        """Byte pieces that are no UTF-8 become one replacement character each."""
        bytes_of = {i: b for b, i in self.bytes.items()}
        out, run = [], bytearray()

        def close():
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at:at + size]).decode().encode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    out.append("�".encode())
                at += size
            run.clear()

        for i in ids:
            if i in bytes_of:
                run.append(bytes_of[i])
                continue
            close()
            piece = b"" if i in self.control else self.raw[i]
            if drop and piece.startswith(b" ") and i != self.unknown:
                piece, drop = piece[1:], drop - 1
            out.append(piece)
        close()
        return b"".join(out)


class SideBySide:
    """The agendas of many short chunks at once, a row of arrays for each.

    A row holds the symbols of a chunk and, for each pair of neighbours, the place of the
    piece they form. At each step every row takes its first best pair.
    """
    NO_PLACE = np.int32(np.iinfo(np.int32).max)

    def __init__(self, pieces: Pieces):
        symbols = dict.fromkeys(c for p in pieces.ids for c in p)
        symbols.update(dict.fromkeys(pieces.ids))
        number = {s: n for n, s in enumerate(symbols)}
        pairs = {}
        for piece, place in pieces.order.items():
            for i in range(1, len(piece)):
                left, right = number.get(piece[:i]), number.get(piece[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = place >> 40, number[piece]
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.place, self.made = (np.array([pairs[k][i] for k in self.keys.tolist()], dtype=np.int32) for i in (0, 1))
        # characters in no piece have numbers behind those of all symbols
        self.of_char = np.arange(0x110000, dtype=np.int32) + np.int32(len(number))
        for s, n in number.items():
            if len(s) == 1:
                self.of_char[ord(s)] = n
        self.id_of = np.array([pieces.ids.get(s, -1) for s in number], dtype=np.int32)
        self.names, self.bytes = list(number), pieces.bytes

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of the piece of each pair; a negative symbol is the end of a chunk."""
        keys = left.astype(np.int64) << 32 | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self.place[at], self.NO_PLACE), self.made[at]

    def merged(self, symbols: np.ndarray) -> np.ndarray:
        """Rows of symbols, filled up with -1, after all merges."""
        rows, width = symbols.shape
        if width < 2 or not len(self.keys):
            return symbols
        out, own = np.full(symbols.shape, -1, dtype=np.int32), np.arange(rows)
        place, made = self.look_up(symbols[:, :-1], symbols[:, 1:])
        columns = np.arange(width)
        while len(own):
            best = place.argmin(axis=1)
            line = np.arange(len(own))
            open_ = place[line, best] < self.NO_PLACE
            out[own[~open_], :symbols.shape[1]] = symbols[~open_]
            own, symbols, place, made, best = own[open_], symbols[open_], place[open_], made[open_], best[open_]
            line = line[:len(own)]
            symbols[line, best] = made[line, best]
            # the symbol behind the pair goes, and so does the pair
            after = columns[None, :symbols.shape[1] - 1]
            symbols = np.take_along_axis(symbols, after + (after > best[:, None]), axis=1)
            if symbols.shape[1] < 2:
                out[own, :symbols.shape[1]] = symbols
                break
            after = after[:, :-1]
            moved = after + (after >= best[:, None])
            place, made = np.take_along_axis(place, moved, axis=1), np.take_along_axis(made, moved, axis=1)
            for at in (best - 1, best):
                inside = np.flatnonzero((at >= 0) & (at < place.shape[1]))
                own_at = at[inside]
                place[inside, own_at], made[inside, own_at] = self.look_up(
                    symbols[inside, own_at], symbols[inside, own_at + 1])
        return out

    def encode(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of each chunk; those of about one length share their arrays."""
        found = {}
        by_width: dict[int, list[str]] = {}
        for chunk in chunks:
            by_width.setdefault(len(chunk) if len(chunk) < 24 else 1 << len(chunk).bit_length(), []).append(chunk)
        for width, own in by_width.items():
            for at in range(0, len(own), ROWS):
                some = own[at:at + ROWS]
                sizes = np.array([len(c) for c in some])
                symbols = np.full((len(some), width), -1, dtype=np.int32)
                codes = np.frombuffer("".join(some).encode("utf-32-le"), dtype=np.uint32)
                symbols[np.arange(width)[None, :] < sizes[:, None]] = self.of_char[codes]
                symbols = self.merged(symbols)
                ids = np.where(symbols < 0, -2, self.id_of[np.clip(symbols, 0, len(self.id_of) - 1)])
                ids[symbols >= len(self.id_of)] = -1
                counts = (symbols >= 0).sum(axis=1).tolist()
                spelled = (ids == -1).any(axis=1).tolist()
                packed = ids.tobytes()
                for i, chunk in enumerate(some):
                    start = i * width * 4
                    found[chunk] = self._spelled(ids[i], symbols[i]) if spelled[i] else packed[start:start + counts[i] * 4]
        return found

    def _spelled(self, ids: np.ndarray, symbols: np.ndarray) -> bytes:
        """Ids of a chunk with characters that have no piece, and become their bytes."""
        out = []
        for i, symbol in zip(ids.tolist(), symbols.tolist()):
            if i >= 0:
                out.append(i)
            elif symbol >= 0:
                known = len(self.names)
                text = self.names[symbol] if symbol < known else chr(symbol - known)
                out += [self.bytes[b] for b in text.encode()]
        return np.array(out, dtype=np.int32).tobytes()


def _lists(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0] + [len(p) // 4 for p in packed])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), dtype=np.int32)))


def _ids_of(lists: pa.Array) -> Iterator[np.ndarray]:
    for own in lists:
        yield own.values.to_numpy(zero_copy_only=False) if own.is_valid else np.empty(0, dtype=np.int32)


def _added(df: DataFrame, path: str, column: str, new: dict[str, T.DataType], make) -> DataFrame:
    """``make`` gives the new columns for those of an Arrow batch, a few rows at a time."""
    into = {c.lower() for c in new}
    columns = [c for c in df.columns if c.lower() not in into or c == column]
    plain = df.select(*[F.col(f"`{c}`") for c in columns])
    names = [free_name(columns, f"{c}__") for c in new]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = worker_memo(("pieces", path), lambda: Pieces(path))
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                yield pa.RecordBatch.from_arrays([*part.columns, *make(pieces, part.column(column))],
                                                 names=[*part.schema.names, *names])

    fields = [T.StructField(n, kind) for n, kind in zip(names, new.values())]
    return plain.mapInArrow(add, T.StructType([*plain.schema.fields, *fields])).select(
        *[F.col(f"`{c}`") for c in columns if c.lower() not in into],
        *[F.col(f"`{n}`").alias(c) for n, c in zip(names, new)])


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids", check: str | None = None) -> DataFrame:
    """Adds the ids of each text, an array of integers.

    They are those of the sentencepiece library for the model in ``path``, without begin
    and end ids. With ``check`` that library encodes each Arrow batch too, and the column of
    that name says whether it gives the same. A null text counts as empty and has no ids. A
    text is encoded whole, in the task that holds its row: chunk by chunk where no piece goes
    on after a space, and the agenda takes memory in proportion to the longest chunk. Rows
    stay as they are, repeated ones too; columns named like the new ones are replaced. Every
    executor must be able to read ``path``.
    """
    def make(pieces: Pieces, texts: pa.Array) -> list[pa.Array]:
        listed = [t or "" for t in texts.to_pylist()]
        ids = _lists(pieces.encode(listed))
        if not check:
            return [ids]
        theirs = pieces.library.encode(listed, num_threads=1)
        return [ids, pa.array([a.tolist() == b for a, b in zip(_ids_of(ids), theirs)], pa.bool_())]

    new = {into: T.ArrayType(T.IntegerType()), **({check: T.BooleanType()} if check else {})}
    return _added(docs, path, text, new, make)


def decode(encoded: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds the text of ids as the library's decode gives it; null counts as no ids.

    Ids that the vocabulary does not have, and null ids, are an error. A column named like
    ``into`` is replaced.
    """
    def make(pieces: Pieces, lists: pa.Array) -> list[pa.Array]:
        return [pa.array([pieces.decode(own) for own in _ids_of(lists)], pa.binary()).cast(pa.string())]

    return _added(encoded, path, ids, {into: T.StringType()}, make)
