"""Main text of web pages: a recurrent labeller over the sequence of text blocks.

A page is cut into leaf blocks. Each is described by its tag path (with the words of class,
id and role), by hashed words of its text and by a few ratios; a bidirectional LSTM reads the
sequence, so each block is judged with the whole page around it. The model is trained in
numpy on a bounded sample of pages whose blocks stand below tags that say what they are,
and on the same texts in other page layouts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import free_name

# Elements that end a block, that hold no text, and that have no end tag.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary "
    "table tbody td tfoot th thead title tr ul".split())
HIDDEN = frozenset("script style noscript template head title textarea svg iframe object button select".split())
# What can stand in a head, and hidden elements that end at a block if their end tag is missing.
IN_HEAD = frozenset("base head html link meta noscript script style template title".split())
LOOSE = frozenset("button noscript object select svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Tags whose blocks serve as examples, where the page has them.
CONTENT, OTHER = frozenset(("article", "main")), frozenset("nav header footer aside form menu dialog".split())
OTHER_WORDS = frozenset(
    "ad ads advert advertisement banner promo sponsor sponsored sidebar menu navbar nav footer header comment comments reply "
    "replies cookie consent notice popup newsletter subscribe related share social breadcrumb login search widget".split())

PATH_DIMS, WORD_DIMS, NUMBERS = 96, 48, 8
DIMS = PATH_DIMS + WORD_DIMS + NUMBERS
CELLS = 40_000


@dataclass(frozen=True)
class Block:
    text: str
    path: tuple[str, ...]
    links: int


class _Leaves(HTMLParser):
    """Blocks of a page in order; tolerant of tags that are not closed.

    ``unended`` are the start tags, by number, of hidden elements known to lack an end tag;
    ``missed`` are those found to lack it.
    """

    def __init__(self, unended: frozenset[int] = frozenset()):
        super().__init__(convert_charrefs=True)
        self.unended, self.missed, self.count = unended, set(), 0
        self.blocks: list[Block] = []
        self.open: list[tuple[str, tuple[str, ...], int]] = []
        self.hidden = 0
        self.linked = 0
        self.pieces: list[str] = []
        self.path: tuple[str, ...] | None = None
        self.link_chars = 0

    def flush(self):
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append(Block(text, self.path, min(self.link_chars, len(text))))
        self.pieces, self.path, self.link_chars = [], None, 0

    def _end_head(self, tag: str | None):
        """A body ends a head that is open; other content does so unless it stands in a hidden element there."""
        at = next((i for i, (name, _, _) in enumerate(self.open) if name == "head"), None)
        inside = {name for name, _, _ in self.open[at + 1:]} if at is not None else HIDDEN
        if "template" not in inside and (tag == "body" or not inside & HIDDEN):
            self._close(at)

    def handle_starttag(self, tag, attrs):
        if self.hidden and tag not in IN_HEAD:
            self._end_head(tag)
        if tag in BLOCKS:
            self.flush()
            for i, (name, _, nth) in enumerate(self.open) if self.unended else ():
                if nth in self.unended and not (name == "select" and tag in ("option", "hr")):
                    self._close(i)
                    break
        if tag == "br":
            self.pieces.append("\n")
        if tag in VOID:
            return
        if tag in ("p", "li", "option", "tr", "td", "th", "dt", "dd") and self.open and self.open[-1][0] == tag:
            self._close(len(self.open) - 1)
        elif tag in BLOCKS:
            # a block ends a paragraph that is open, with the inline tags left open in it
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == "p":
                    self._close(i)
                    break
                if self.open[i][0] in BLOCKS:
                    break
        words = [tag]
        for name, value in attrs:
            if name in ("class", "id", "role", "itemprop") and value:
                words += [f".{w}" for w in "".join(c if c.isalnum() else " " for c in value.lower()).split()[:6]]
        self.count += 1
        self.open.append((tag, tuple(words), self.count))
        self.hidden += tag in HIDDEN
        self.linked += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close(self, at: int, ended: bool = False):
        self.missed.update(nth for tag, _, nth in self.open[at + ended:] if tag in LOOSE)
        for tag, _, _ in self.open[at:]:
            self.hidden -= tag in HIDDEN
            self.linked -= tag == "a"
        del self.open[at:]

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self._close(i, ended=True)
                return
            # an inline end tag does not reach out of its block
            if tag not in BLOCKS and self.open[i][0] in BLOCKS:
                return

    def handle_data(self, data):
        if self.hidden and self.open[-1][0] == "head" and not data.isspace():
            self._end_head(None)
        if self.hidden:
            return
        self.pieces.append(data)
        if self.path is None and not data.isspace():
            self.path = tuple(word for _, words, _ in self.open for word in words)
        if self.linked:
            self.link_chars += len(data.strip())


def _parsed(html: str, unended: frozenset[int] = frozenset()) -> _Leaves:
    parser = _Leaves(unended)
    parser.feed(html)
    parser.close()
    parser.flush()
    parser._close(0)
    return parser


def blocks_of(html: str | None) -> list[Block]:
    """Blocks in page order: character references decoded, white space made one space.

    A head without end tag ends where the body begins. A page with hidden elements that
    are never ended is read again, and those end at the next block.
    """
    parser = _parsed(html or "")
    if parser.missed:
        parser = _parsed(html, frozenset(parser.missed))
    return parser.blocks


def _slot(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % size


class _Slots(dict):
    def __init__(self, size: int):
        self.size = size

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = slot = _slot(word, self.size)
        return slot


def features(blocks: list[Block], paths: _Slots, words: _Slots) -> np.ndarray:
    """One row for each block: tag path, hashed words of the whole text, ratios."""
    x = np.zeros((len(blocks), DIMS), dtype=np.float32)
    for i, block in enumerate(blocks):
        parts = block.path[1:] if block.path[:1] == ("html",) else block.path
        for word in parts:
            x[i, paths[word]] = 1.0
        tokens = block.text.split(" ")
        slots = np.bincount([words[w] for w in tokens], minlength=WORD_DIMS)
        n, m = len(block.text), len(tokens)
        x[i, PATH_DIMS:PATH_DIMS + WORD_DIMS] = slots / m
        x[i, -NUMBERS:] = (
            np.log1p(n) / 8, np.log1p(m) / 6, block.links / n, n / m / 16, block.text[-1] in ".!?:;\"'",
            (i + 1) / len(blocks), 1 / len(blocks), len(parts) / 12)
    return x


class Labeller:
    """Bidirectional LSTM with a logistic output at each block."""

    def __init__(self, hidden: int, seed: int):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        scale = lambda *shape: (rng.standard_normal(shape) * (1 / np.sqrt(shape[0]))).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p[f"{d}x"], self.p[f"{d}h"] = scale(DIMS, 4 * hidden), scale(hidden, 4 * hidden)
            self.p[f"{d}0"] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)]).astype(np.float32)
        self.p["o"], self.p["o0"] = scale(2 * hidden, 1), np.zeros(1, dtype=np.float32)

    def _pass(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """x: pages, blocks, features. States stop where a page has ended."""
        n, steps, _ = x.shape
        h, c = np.zeros((n, self.hidden), np.float32), np.zeros((n, self.hidden), np.float32)
        inputs = x @ self.p[f"{d}x"] + self.p[f"{d}0"]
        out = np.zeros((n, steps, self.hidden), np.float32)
        trace = []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = inputs[:, t] + h @ self.p[f"{d}h"]
            gates = 1 / (1 + np.exp(-z[:, :3 * self.hidden]))
            i, f, o = np.split(gates, 3, axis=1)
            g = np.tanh(z[:, 3 * self.hidden:])
            m = mask[:, t:t + 1]
            new = f * c + i * g
            squashed = np.tanh(new)
            if keep:
                trace.append((t, i, f, o, g, c, h, squashed, m))
            c, h = np.where(m, new, c), np.where(m, o * squashed, h)
            out[:, t] = h
        return out, trace

    def scores(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        f, ft = self._pass("f", x, mask, keep)
        b, bt = self._pass("b", x, mask, keep)
        both = np.concatenate([f, b], axis=2)
        p = 1 / (1 + np.exp(-(both @ self.p["o"] + self.p["o0"])[:, :, 0]))
        return (p, both, ft, bt) if keep else p

    def gradients(self, x, mask, y):
        p, both, ft, bt = self.scores(x, mask, keep=True)
        error = ((p - y) * mask / mask.sum())[:, :, None].astype(np.float32)
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["o"], grads["o0"] = np.einsum("nth,nto->ho", both, error), error.sum(axis=(0, 1))
        outer = error @ self.p["o"].T
        k = self.hidden
        for d, trace, own in (("f", ft, outer[:, :, :k]), ("b", bt, outer[:, :, k:])):
            dh, dc = np.zeros_like(own[:, 0]), np.zeros_like(own[:, 0])
            gates, before = np.zeros((*own.shape[:2], 4 * k), np.float32), np.zeros(own.shape, np.float32)
            for t, i, f, o, g, c, h, squashed, m in reversed(trace):
                dh = dh + own[:, t]
                live = dh * m
                dnew = (dc * m) + live * o * (1 - squashed ** 2)
                dz = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), live * squashed * o * (1 - o),
                                     dnew * i * (1 - g ** 2)], axis=1)
                gates[:, t], before[:, t] = dz, h
                dh = np.where(m, dz @ self.p[f"{d}h"].T, dh)
                dc = np.where(m, dnew * f, dc)
            flat = gates.reshape(-1, 4 * k)
            grads[f"{d}x"] = x.reshape(-1, DIMS).T @ flat
            grads[f"{d}h"] = before.reshape(-1, k).T @ flat
            grads[f"{d}0"] = flat.sum(axis=0)
        return grads


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(r) for r in rows)
    x, mask = np.zeros((len(rows), steps, DIMS), np.float32), np.zeros((len(rows), steps), bool)
    for i, r in enumerate(rows):
        x[i, :len(r)], mask[i, :len(r)] = r, True
    return x, mask


@dataclass(frozen=True)
class Training:
    """``pages`` bounds the sample that the driver holds; it is chosen by a hash of the id."""
    pages: int = 128
    page_chars: int = 20_000
    hidden: int = 16
    epochs: int = 12
    rate: float = 0.02
    seed: int = 11


def _label(block: Block) -> int | None:
    """What the nearest telling tag around a block says; None if no tag does."""
    for word in reversed(block.path):
        if word in OTHER or word[:1] == "." and word[1:] in OTHER_WORDS:
            return 0
        if word in CONTENT:
            return 1
    return None


def _layouts(articles: list[list[str]], rng: np.random.Generator) -> list[tuple[list[Block], list[int]]]:
    """Articles in page layouts of several kinds, with boilerplate made of other texts' words."""
    vocabulary = sorted({w for lines in articles for line in lines for w in line.split()})
    pick = lambda n: " ".join(rng.choice(vocabulary, n))
    bodies = [("main",), ("article",), ("div", ".content"), ("div", ".post", ".body"), ("div", ".entry", ".content"),
              ("section", ".article"), ("div", ".main"), ("div",), ("main", "article"), ("div", ".story"), ("div", ".text")]
    extras = [
        (("nav", "ul", "li", "a"), 4), (("div", ".menu", "a"), 2), (("header", "h1"), 3), (("header", "div"), 6), (("footer",), 8),
        (("footer", "p"), 12), (("aside", "p"), 18), (("div", ".sidebar", "p"), 16), (("aside", "ul", "li", "a"), 4),
        (("div", ".ad"), 9), (("div", ".advertisement", "p"), 14), (("div", ".comments", "p"), 20),
        (("section", ".comments", "div", ".comment", "p"), 24), (("div", ".cookie", ".notice"), 14), (("form", "label"), 3),
        (("form", "p"), 8), (("div", ".related", "a"), 6), (("div", ".share", "a"), 2), (("div", ".newsletter", "p"), 10),
        (("div", ".promo", "p"), 10), (("div", ".breadcrumb", "a"), 3), (("div", ".footer"), 8), (("div", ".banner"), 8),
        (("ol", ".comment", ".list", "li", "p"), 22), (("div", ".login"), 4), (("div", ".notice", "p"), 14)]
    pages = []
    for lines in articles:
        body = bodies[rng.integers(len(bodies))]
        outer = [(), ("div", ".page"), ("div", ".wrapper", "div")][rng.integers(3)]

        def others(n):
            for at in rng.choice(len(extras), n, replace=False):
                path, mean = extras[at]
                for _ in range(int(rng.integers(1, 7 if mean < 7 else 3))):
                    text = pick(max(1, int(rng.poisson(mean))))
                    # inside the article's element now and then: an advert between paragraphs
                    yield Block(text, ("body", *outer, *path), len(text) if "a" in path else 0), 0

        page = list(others(int(rng.integers(0, 5))))
        inside = list(others(int(rng.integers(0, 2))))
        cut = int(rng.integers(0, len(lines) + 1))
        for i, line in enumerate(lines):
            tag = ("h1",) if i == 0 and rng.random() < 0.7 else ("p",) if rng.random() < 0.9 else ("ul", "li")
            page.append((Block(line, ("body", *outer, *body, *tag), 0), 1))
            if i == cut:
                page += [(Block(b.text, ("body", *outer, *body, *b.path[1 + len(outer):]), b.links), 0) for b, _ in inside]
        page += list(others(int(rng.integers(0, 6))))
        pages.append(([b for b, _ in page], [y for _, y in page]))
    return pages


def train(pages: list[str], training: Training = Training()) -> Labeller:
    rng = np.random.default_rng(training.seed)
    examples, articles = [], []
    for html in pages:
        blocks = blocks_of(html)[:100]
        labels = [_label(b) for b in blocks]
        if blocks and None not in labels:
            examples.append((blocks, labels))
        lines = [b.text for b, y in zip(blocks, labels) if y == 1][:40]
        articles += [lines] if lines else []
    # without any page that says what it is, plain words make the examples
    articles = articles or [["Some words make a line.", "Other words follow here."]] * 32
    examples += _layouts(articles, rng) + _layouts(articles, rng)
    paths, words = _Slots(PATH_DIMS), _Slots(WORD_DIMS)
    data = [(features(b, paths, words), np.array(y, np.float32)) for b, y in examples]
    model = Labeller(training.hidden, training.seed)
    first, second = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))
    count = 0
    for epoch in range(training.epochs):
        order = sorted(rng.permutation(len(data)).tolist(), key=lambda i: len(data[i][1]) // 8)
        batches = [order[i:i + 48] for i in range(0, len(order), 48)]
        for at in rng.permutation(len(batches)):
            x, mask = _padded([data[i][0] for i in batches[at]])
            y = np.zeros(mask.shape, np.float32)
            y[mask] = np.concatenate([data[i][1] for i in batches[at]])
            count += 1
            rate = training.rate * (1 - epoch / training.epochs)
            for k, g in model.gradients(x, mask, y).items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                model.p[k] -= rate * (first[k] / (1 - 0.9 ** count)) / (np.sqrt(second[k] / (1 - 0.99 ** count)) + 1e-8)
    return model


def label_pages(model: Labeller, pages: list[list[Block]]) -> list[np.ndarray]:
    """Which blocks of each page are main text."""
    paths, words = _Slots(PATH_DIMS), _Slots(WORD_DIMS)
    result: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    while order:
        # pages of like length together, so many that the padded blocks stay bounded
        longest = len(pages[order[-1]])
        some, order = order[-max(1, CELLS // longest):], order[:-max(1, CELLS // longest)]
        x, mask = _padded([features(pages[i], paths, words) for i in some])
        p = model.scores(x, mask)
        for row, i in enumerate(some):
            result[i] = p[row, :len(pages[i])] >= 0.5
    return result


def with_main_text(pages: DataFrame, id_col: str = "page_id", html: str = "html", into: str = "text",
                   training: Training = Training()) -> DataFrame:
    """Adds the main text of each page: its blocks of that kind, two new lines between.

    The whole page is read; nothing is capped. A null or empty page, or one without main
    text, gives an empty string. Rows stay as they are, repeated ones too; a column named
    like ``into`` is replaced. The model sees ``training.pages`` pages at most.
    """
    spark = pages.sparkSession
    plain = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c.lower() != into.lower() or c == html])
    some = plain.select(F.col(f"`{html}`").alias("html"), F.xxhash64(F.col(f"`{id_col}`")).alias("h")).filter(
        F.length("html").between(1, training.page_chars)).orderBy("h", "html").limit(training.pages)
    model = spark.sparkContext.broadcast(train([r["html"] for r in some.select("html").collect()], training))

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            texts = []
            for at in range(0, len(series), 512):
                cut = [blocks_of(h) for h in series.iloc[at:at + 512]]
                texts += ["\n\n".join(b.text for b, y in zip(blocks, chosen) if y)
                          for blocks, chosen in zip(cut, label_pages(model.value, cut))]
            yield pd.Series(texts, dtype=object)

    found = free_name(plain, "text__")
    return plain.withColumn(found, extracted(F.col(f"`{html}`"))).select(
        *[F.col(f"`{c}`") for c in plain.columns if c.lower() != into.lower()], F.col(found).alias(into))
