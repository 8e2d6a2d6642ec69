"""Article text of web pages. HTML needs a parser, so this runs in Arrow batches."""

from __future__ import annotations

import html
import html.entities
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Where the text is looked for, what is left out, what is kept.
ROOTS = ("article", "main")
DROPPED = frozenset({"pre", "code"})
HEADINGS = frozenset({"h1", "h2", "h3"})
BLOCKS = HEADINGS | {"p", "ul", "ol", "li"}
RULE = "=" * 80
# Elements without content, and elements whose text is not page text (HTML standard).
VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
                  "param", "source", "track", "wbr"})
HIDDEN_TEXT = frozenset({"script", "style", "template", "rt", "rp"})


class _Blocks(HTMLParser):
    """Collects the text blocks inside the first ``root`` element.

    Text pieces go to one list and a block is a slice of it, so nested blocks
    share their pieces. An end tag closes the nearest open element of its name
    and all inside it; one that was never opened is ignored. An element left
    open runs to the end of its parent.
    """

    def __init__(self, root: str):
        super().__init__(convert_charrefs=False)
        self.root, self.found, self.finished = root, False, False
        self.root_depth = 0
        self.stack: list[tuple[str, int | None]] = []
        self.open_names: dict[str, int] = {}
        self.dropping = self.hiding = 0
        self.pieces: list[str] = []
        self.blocks: list[list] = []
        self.node: list[str] = []

    def handle_starttag(self, tag, attrs):
        self._end_text()
        if not self.found and tag == self.root:
            self.found = True
            self._push(tag, None)
            self.root_depth = len(self.stack)
            return
        inside = self.found and not self.finished
        block = None
        if inside and tag in BLOCKS and not self.dropping:
            block = len(self.blocks)
            self.blocks.append([tag, len(self.pieces), None])
        self._push(tag, block)
        if tag in VOID:
            self._close(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close(tag)

    def handle_endtag(self, tag):
        self._end_text()
        if tag not in VOID:
            self._close(tag)

    def handle_data(self, data):
        if self.found and not self.finished and not self.dropping and not self.hiding:
            self.node.append(data)

    def handle_entityref(self, name):
        self.handle_data(html.entities.html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        self.handle_data(html.unescape(f"&#{name};"))

    def handle_comment(self, data):
        self._end_text()

    def unknown_decl(self, data):
        self._end_text()
        if data.upper().startswith("CDATA["):
            self.handle_data(data[len("CDATA["):])
            self._end_text()

    def _end_text(self):
        """Finish a text node; one of blanks only becomes a line break or a blank."""
        text = "".join(self.node)
        self.node.clear()
        if text and not text.strip(" \n\t\f\r") and not self.open_names.get("textarea"):
            text = "\n" if "\n" in text else " "
        if text:
            self.pieces.append(text)

    def _push(self, tag, block):
        self.stack.append((tag, block))
        self._count(tag, 1)

    def _count(self, tag, change):
        self.open_names[tag] = self.open_names.get(tag, 0) + change
        self.dropping += change * (tag in DROPPED)
        self.hiding += change * (tag in HIDDEN_TEXT)

    def _close(self, tag):
        if not self.open_names.get(tag):
            return
        while self.stack:
            name, block = self.stack.pop()
            self._count(name, -1)
            if block is not None:
                self.blocks[block][2] = len(self.pieces)
            if self.found and len(self.stack) < self.root_depth:
                self.finished = True
            if name == tag:
                return

    def lines(self) -> list[str]:
        self.close()
        self._end_text()
        out: list[str] = []
        for tag, start, end in self.blocks:
            text = "".join(self.pieces[start:end]).strip()
            if not text:
                continue
            if tag in HEADINGS:
                out += ["\n" + RULE, text.upper(), RULE + "\n"]
            else:
                out += [text, ""]
        return out


def article_text(page: str | None) -> str | None:
    """Text of the first article, else of the first main element, else nothing.

    Null for markup that the parser rejects, so that one page cannot stop a job.
    """
    for root in ROOTS:
        parser = _Blocks(root)
        try:
            parser.feed(page or "")
            lines = parser.lines()
        except AssertionError:
            return None
        if parser.found:
            return "\n".join(lines)
    return ""


@F.pandas_udf(StringType())
def _article_text(pages: pd.Series) -> pd.Series:
    return pages.map(article_text)


def extract_articles(pages: DataFrame, html_column: str = "html",
                     output: str = "article") -> DataFrame:
    """Add the article text of every page."""
    source: Column = F.col(html_column)
    return pages.withColumn(output, _article_text(source))
