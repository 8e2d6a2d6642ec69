"""Token counts under a unigram vocabulary, without making the tokens."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import free_name, worker_memo

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
MEMO_WORDS = 200_000
_MARKED = re.compile(f"{SPACE}[^{SPACE}]*")
# The characters that Unicode calls white space.
WHITE = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
         "\u2028\u2029\u202f\u205f\u3000")


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) by id, from a sentencepiece model file, whatever its kind.

    Counts made with the scores of a BPE model are those of a unigram model of the same
    list, not of the file's own tokenizer. Control and byte pieces are in the list too and
    match as plain text.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Best score and number of pieces of a word.

    An automaton lists the vocabulary's matches by where they end, longest first, so a
    later match must be better to replace an earlier one: of equal paths the one whose
    last piece is longest stays. A character that no piece matches alone costs ten less
    than the lowest score, and counts as its UTF-8 bytes if the vocabulary has all of
    them as pieces; else a run of such characters counts as one.
    """

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        self.matches = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        pieces = {piece for piece, _ in vocabulary}
        self.bytes = all(f"<0x{b:02X}>" in pieces for b in range(256))
        self.memo: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Pieces on the best path through the word."""
        n = len(word)
        score, pieces, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        done = 0

        def settle(end: int, best: float | None, count: int, single: bool) -> None:
            wild = False
            if not single:
                offer = score[end - 1] + self.unknown
                if best is None or offer > best:
                    best, wild = offer, True
                    if self.bytes:
                        count = pieces[end - 1] + len(word[end - 1].encode())
                    else:
                        count = pieces[end - 1] + (not unknown[end - 1])
            score[end], pieces[end], unknown[end] = best, count, wild

        best, count, single = None, 0, False
        for last, (length, value) in self.matches.iter(word):
            end = last + 1
            while done + 1 < end:
                done += 1
                settle(done, best, count, single)
                best, count, single = None, 0, False
            offer = score[end - length] + value
            if best is None or offer > best:
                best, count = offer, pieces[end - length] + 1
            single |= length == 1
        while done < n:
            done += 1
            settle(done, best, count, single)
            best, count, single = None, 0, False
        return pieces[n]

    def text(self, text: str | None, split) -> int:
        memo, total = self.memo, 0
        for word in split(text or ""):
            known = memo.get(word)
            if known is None:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                marked = word if word.startswith(SPACE) else SPACE + word
                memo[word] = known = sum(map(self.count, _MARKED.findall(marked)))
            total += known
        return total


def with_token_count(docs: DataFrame, path: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """Adds the number of pieces of each text under the vocabulary in ``path``.

    Words are what white space separates, each with a leading space mark; a mark within
    a word starts another. Of a word only
    the best score and the number of pieces up to each character are kept. A null or
    blank text has none. Rows stay as they are, repeated ones too; a column named like
    ``into`` is replaced. ``path`` must be readable by every executor.
    """
    plain = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != into.lower() or c == text])

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = worker_memo(("unigram", path), lambda: Counter(read_vocabulary(path)))
        split = re.compile(f"[^{WHITE}]+").findall
        for texts in batches:
            yield pd.Series([counter.text(t, split) for t in texts], dtype="int64")

    count = free_name(plain, "count__")
    return plain.withColumn(count, counted(F.col(f"`{text}`"))).select(
        *[F.col(f"`{c}`") for c in plain.columns if c.lower() != into.lower()], F.col(count).alias(into))
