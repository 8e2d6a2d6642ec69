"""Suffix order by difference cover, in numpy, for the texts that one task holds."""

from __future__ import annotations

import numpy as np


def _keys(*columns: np.ndarray) -> np.ndarray:
    """Whole numbers that compare as the rows of the columns do."""
    key = columns[0].astype(np.int64)
    for column in columns[1:]:
        width = int(column.max(initial=0)) + 1
        if int(key.max(initial=0)) + 1 > (1 << 62) // width:
            key = _dense(key)
        key = key * width + column
    return key


def _sorted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and sorted keys, equal ones as they stood. Keys with room for a position are sorted with it."""
    bits = len(key).bit_length()
    if int(key.max(initial=0)).bit_length() + bits < 64:
        packed = np.sort((key << bits) | np.arange(len(key)))
        return packed & ((1 << bits) - 1), packed >> bits
    order = np.argsort(key, kind="stable")
    return order, key[order]


def _new(s: np.ndarray) -> np.ndarray:
    """Where a sorted array has another value than before."""
    new = np.ones(len(s), dtype=bool)
    new[1:] = s[1:] != s[:-1]
    return new


def _dense(key: np.ndarray) -> np.ndarray:
    order, s = _sorted(key)
    dense = np.empty(len(key), dtype=np.int64)
    dense[order] = np.cumsum(_new(s)) - 1
    return dense


def _smaller(key: np.ndarray, cut: int) -> tuple[np.ndarray, np.ndarray]:
    """For each key, how many of those before and from ``cut`` on are smaller."""
    order, s = _sorted(key)
    new = _new(s)
    run, starts = np.cumsum(new) - 1, np.flatnonzero(new)
    ahead = np.cumsum(order < cut)[starts] - (order[starts] < cut)
    first, both = np.empty(len(key), dtype=np.int64), np.empty(len(key), dtype=np.int64)
    first[order], both[order] = ahead[run], starts[run]
    return first, both - first


def suffix_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """A rank for each position of ``text``; 0 marks the end of a string in it.

    Suffixes that differ in their first ``depth`` symbols compare as they should, and
    suffixes that agree in those stand together. The triples at positions 1 and 2
    modulo 3 are sorted and named. If they do not reach ``depth`` symbols and some are
    equal, the names are a text to rank in the same way. The suffixes at 0 modulo 3
    follow from their first symbol and the rank after it, and each suffix's rank is the
    number of smaller ones in the three classes.
    """
    n = len(text)
    if n < 3 or depth <= 3:
        padded = np.concatenate([text.astype(np.int64), np.zeros(3, dtype=np.int64)])
        return _dense(_keys(padded[:n], padded[1:n + 1], padded[2:n + 2]))
    t = np.zeros(n + 5, dtype=np.int64)
    t[:n] = text
    ones, twos, zeros = np.arange(1, n, 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.concatenate([ones, twos])
    names = _dense(_keys(t[sample], t[sample + 1], t[sample + 2])) + 1
    if int(names.max()) < len(names):
        # the two classes are strings of their own; a triple that passes an end stops there
        ended = (t[sample] == 0) | (t[sample + 1] == 0) | (t[sample + 2] == 0)
        first, second = names[:len(ones)], names[len(ones):]
        below = _strings(first, ended[:len(ones)]), _strings(second, ended[len(ones):])
        inner = suffix_ranks(np.concatenate([below[0][0], below[1][0]]), -(-depth // 3))
        names = np.concatenate([inner[below[0][1]], inner[len(below[0][0]) + below[1][1]]]) + 1
    rank = np.zeros(n + 5, dtype=np.int64)
    rank[sample] = names
    # (symbol, rank after it) compares 0 with 0 and 1; (two symbols, rank after them) 0 with 2
    near = _keys(t[np.concatenate([zeros, ones])], rank[np.concatenate([zeros, ones]) + 1])
    both = np.concatenate([zeros, twos])
    far = _keys(t[both], t[both + 1], rank[both + 2])
    zeros_near, ones_near = _smaller(near, len(zeros))
    zeros_far, twos_far = _smaller(far, len(zeros))
    named = np.bincount(names)
    below = (np.cumsum(named) - named)[names]
    result = np.empty(n, dtype=np.int64)
    result[zeros] = (zeros_near + ones_near)[:len(zeros)] + twos_far[:len(zeros)]
    result[ones] = zeros_near[len(zeros):] + below[:len(ones)]
    result[twos] = zeros_far[len(zeros):] + below[len(ones):]
    return result


def _strings(names: np.ndarray, ended: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names with a 0 after each one that ends a string, and where each name went."""
    at = np.arange(len(names)) + np.concatenate([[0], np.cumsum(ended)[:-1]]) if len(names) else np.empty(0, dtype=np.int64)
    text = np.zeros(len(names) + int(ended.sum()) + 1, dtype=np.int64)
    text[at] = names
    return text, at


def equal_runs(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The class of each start: equal for starts whose next ``depth`` symbols are equal.

    Starts stand in suffix order, and neighbours are compared symbol by symbol.
    """
    if not len(starts):
        return np.empty(0, dtype=np.int64)
    order, _ = _sorted(suffix_ranks(text, depth)[starts])
    at = starts[order]
    windows = np.lib.stride_tricks.sliding_window_view(text, depth)
    new = np.ones(len(at), dtype=np.int64)
    for i in range(1, len(at), 16384):
        j = min(i + 16384, len(at))
        new[i:j] = (windows[at[i:j]] != windows[at[i - 1:j - 1]]).any(axis=1)
    classes = np.empty(len(at), dtype=np.int64)
    classes[order] = np.cumsum(new)
    return classes
