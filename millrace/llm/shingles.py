"""Sets of word shingles as sorted arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WIDTH = 5
MEMO_WORDS = 100_000
_WEIGHTS = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(WIDTH)], dtype=np.uint64)


class _Words(dict):
    """Hash of a word, remembered until there are too many."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str | None], memo: _Words | None = None) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text: five words, or all if there are fewer.

    A-Z are lower-cased; words are what ASCII white space separates. No words: empty.
    """
    known = (memo if memo is not None else _Words()).__getitem__
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            yield np.empty(0, dtype=np.uint64)
            continue
        h = np.fromiter(map(known, words), dtype=np.uint64, count=len(words))
        width = min(WIDTH, len(h))
        n = len(h) - width + 1
        total = h[:n] + np.uint64(width)
        for i in range(1, width):
            # words are hashed well, so a sum with a weight for each place tells sequences apart
            total += h[i:i + n] * _WEIGHTS[i]
        yield np.unique(mixed(total))
