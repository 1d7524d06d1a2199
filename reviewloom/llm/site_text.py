"""Main text of web pages: site templates found by counting element subtrees per host."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64

from reviewloom import session
from reviewloom.llm.common import bounded_batches

# An element subtree on at least this many different pages of a host belongs to its
# template; on a host with few pages, one on this share of them and on a few at least.
MANY_PAGES = 10
MOST_PAGES = 0.5
FEW_PAGES = 3

# Element names.
_RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "xmp")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
# What an element ends that is still open when it begins.
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
# Text blocks of an article: what is written there is kept however often it recurs.
_WRITING = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption".split())
# Never part of the main text, wherever they stand; a header only outside the article.
_NEVER = frozenset("head nav footer aside form button select dialog fieldset menu".split())
_UNWANTED = (
    r"(?:ads?|adverts?|advertisement|banner|breadcrumbs?|comments?|cookies?|menu|"
    r"navbar|newsletter|notice|popup|promo|related|share|sharing|sidebar|sponsor(?:ed)?|"
    r"subscribe)"
)
# Outside the article a part of a class or id says so; inside it only a whole one, and not on
# the article's own text blocks.
_NEVER_NAMED = re.compile(rf"(?:^|[\s_-]){_UNWANTED}(?:$|[\s_-])", re.IGNORECASE)
_NEVER_NAMED_INSIDE = re.compile(rf"(?:^|\s){_UNWANTED}(?:$|\s)", re.IGNORECASE)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)

# Attributes up to the end of the tag. A quote only counts after an equals sign and where it
# is closed; nothing is tried twice, so broken markup takes no longer.
_REST = r"""(?>=\s*"[^"]*"|=\s*'[^']*'|[^>])*+"""
# A name ends where no letter, digit or hyphen follows: <title-bar> is no <title>.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<svg(?=[\s/>])(?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>/]|/(?!>))*+/>"
    rf"|<(?P<raw>{'|'.join(_RAW)})(?=[\s/>]){_REST}>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>{_REST})>"
    r"|<[!?][^>]*>",
    re.IGNORECASE | re.DOTALL,
)

# Why an element is hidden: a form around a whole article hides its other parts only.
_BY_FORM, _BY_OTHER = 1, 2


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class _Element:
    __slots__ = ("name", "hash", "blocks", "hidden", "article", "inside", "holds")

    def __init__(self, name: str, blocks: int, hidden: int, article: bool, inside: bool):
        self.name, self.blocks, self.hidden, self.article = name, blocks, hidden, article
        # stands in, or has in it, writing of an article
        self.inside, self.holds = inside, False
        self.hash = xxh64(name)


class Page:
    """One pass over a page's markup.

    ``subtrees`` are the hashes of its block elements that may belong to the template: the
    hash of an element covers its name, its text and its children's hashes. ``text`` is
    the main text without the elements whose hash is in ``template``.
    """

    def __init__(self, source: str, template: frozenset[int] = frozenset()):
        self.template = template
        self.subtrees: set[int] = set()
        self.blocks: list[tuple[bool, str]] = []
        self.words: list[str] = []
        self.open: list[_Element] = [_Element("", 0, 0, False, False)]
        self.has_article = False
        at = 0
        for mark in _MARKUP.finditer(source):
            if mark.start() > at:
                self._text(source[at : mark.start()])
            at = mark.end()
            name = mark["name"]
            if name is None:
                continue
            name = name.lower()
            if mark["end"]:
                self._end(name)
            else:
                self._begin(name, mark["rest"])
        if at < len(source):
            self._text(source[at:])
        while len(self.open) > 1:
            self._close()
        self._flush()

    @property
    def text(self) -> str:
        return "\n".join(block for inside, block in self.blocks if inside or not self.has_article)

    def _text(self, raw: str) -> None:
        top = self.open[-1]
        text = entities.unescape(raw)
        top.hash.update(text)
        if not top.hidden:
            self.words.append(text)

    def _flush(self) -> None:
        if self.words:
            block = " ".join("".join(self.words).split())
            if block:
                self.blocks.append((self.open[-1].article, block))
            self.words = []

    def _begin(self, name: str, rest: str) -> None:
        if name in _VOID:
            if name == "br":
                self.words.append(" ")
            elif name == "hr":
                self._flush()
            self.open[-1].hash.update(f"<{name}>")
            return
        ends = _ENDS.get(name, ())
        if name in _BLOCKS:
            self._end_open({"p", *ends})
            self._flush()
        top = self.open[-1]
        article = top.article or name in ("article", "main")
        self.has_article |= article
        hidden = top.hidden
        if name in ("main", "article"):
            hidden = 0 if hidden == _BY_FORM else hidden
        elif name in _NEVER or (name == "header" and not article):
            hidden = max(hidden, _BY_FORM if name == "form" else _BY_OTHER)
        elif not hidden and rest and name not in ("html", "body") and not (top.article and name in _WRITING):
            unwanted = _NEVER_NAMED_INSIDE if top.article else _NEVER_NAMED
            if any(unwanted.search(a or b or c) for a, b, c in _NAMES.findall(rest)):
                hidden = _BY_OTHER
        inside = top.inside or (article and name in _WRITING)
        self.open.append(_Element(name, len(self.blocks), hidden, article, inside))

    def _end_open(self, names: set[str]) -> None:
        """End the innermost of these that is open within its container."""
        for i in range(len(self.open) - 1, 0, -1):
            name = self.open[i].name
            if name in names:
                while len(self.open) > i:
                    self._close()
                return
            if name in ("ul", "ol", "dl", "table", "div", "section", "article", "main", "td", "body"):
                return

    def _end(self, name: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name == name:
                while len(self.open) > i:
                    self._close()
                return

    def _close(self) -> None:
        element = self.open[-1]
        if element.name in _BLOCKS:
            self._flush()
        self.open.pop()
        value = element.hash.intdigest()
        self.open[-1].hash.update(value.to_bytes(8, "little"))
        element.holds |= element.inside and len(self.blocks) > element.blocks
        self.open[-1].holds |= element.holds
        if element.name not in _BLOCKS or element.name in ("html", "body", "main", "article"):
            return
        if element.inside or element.holds:
            return
        signed = _signed(value)
        self.subtrees.add(signed)
        if signed in self.template:
            del self.blocks[element.blocks :]


def _udf(function: Callable, kind: str) -> Callable:
    return F.pandas_udf(function, kind)


def _parsed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [Page(source) for source in batch]
        # none stands for the page itself
        subtrees = [[None, *sorted(page.subtrees)] for page in found]
        contents = [_signed(xxh64(page.text).intdigest()) for page in found]
        yield pd.DataFrame({"content": contents, "subtrees": subtrees})


def _main_text(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for sources, templates in batches:
        yield pd.Series(
            [
                Page(source, frozenset(() if marked is None else marked)).text
                for source, marked in zip(sources, templates, strict=True)
            ],
            dtype=object,
        )


def main_texts(pages: DataFrame, many: int = MANY_PAGES) -> DataFrame:
    """Per page its main text (``text``, empty if none) and its code points (``n_chars``).

    The hashes of a page's element subtrees are counted per host, each once for every
    different text of a page, and combined before the shuffle: copies of a page, in repeated
    rows or under several urls, count once. Subtrees on ``many`` or more different pages of
    a host, or on most of a host's few, are deleted from its pages, with what markup and
    names say is no main text. An article's own text blocks, and elements that hold any,
    are not deleted for recurring. One row per input row, null ids and urls are values like
    others, a null or empty page has no text. An empty table gives an empty result; other
    columns are not read.
    """
    bounded_batches(pages.sparkSession)
    source = F.coalesce("html", F.lit(""))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1))
    rows = pages.select(
        "page_id",
        "url",
        source.alias("html"),
        F.xxhash64(host).alias("host"),
        F.xxhash64("url", source).alias("page"),
    )
    parsed = _udf(_parsed, "content bigint, subtrees array<bigint>")(F.col("html"))
    # stored, as it is read twice: parsing takes most of the time
    elements = session.store(rows.select("host", "page", parsed.alias("parsed"))).select(
        "host", "page", F.col("parsed.content").alias("content"), F.explode("parsed.subtrees").alias("subtree")
    )
    counted = session.store(
        elements.groupBy("host", "subtree", "content").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("pages"))
        .filter(F.col("subtree").isNull() | (F.col("pages") >= min(many, FEW_PAGES)))
    )
    hosts = counted.filter(F.col("subtree").isNull()).select("host", F.col("pages").alias("all"))
    most = F.greatest(F.lit(FEW_PAGES), F.ceil(F.col("all") * MOST_PAGES))
    template = (
        counted.filter(F.col("subtree").isNotNull()).join(hosts, "host")
        .filter(F.col("pages") >= F.least(F.lit(many), most))
        .select("host", "subtree")
    )
    # copies of a page are one row here; a page has no more entries than elements
    marked = (
        elements.groupBy("host", "page", "subtree").agg(F.count(F.lit(1)).alias("n"))
        .join(template, ["host", "subtree"])
        .groupBy("page").agg(F.collect_list("subtree").alias("template"))
    )
    text = _udf(_main_text, "string")(F.col("html"), F.col("template"))
    return rows.join(marked, "page", "left").select(
        "page_id", "url", text.alias("text")
    ).withColumn("n_chars", F.length("text").cast("bigint"))
