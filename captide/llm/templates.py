"""Main text of web pages by deducing each host's template from equivalence classes.

A page is a sequence of tokens: its tags and its texts, each with the path of open elements
it stands in.  Tokens of one host that occur equally often in every one of its pages form an
equivalence class; those of enough tokens that are on most pages are the host's template.  On
each page a class holds where its tokens stand in the class's order, time after time, and it
nests with the classes that hold already: each of its rounds lies between two neighbouring
tokens of theirs, or the other way round.  The classes that hold cut the page into slots.

What is left in the slots is the page's own.  Inside an article the template takes out whole
blocks only and no headings, as those of recipes or papers repeat on every page.  Slots are cut further where an article begins
or ends, or an element that is no part of one by its kind, role or class; these hints choose
among the slots.  The article's slots give the main text, and on a page without an article
all do; those of the other elements are left out wherever they stand.

Occurrence vectors are never gathered: a token's vector is folded into one hash by an
aggregate that combines before the shuffle, so a host with a third of all pages costs one
row per token and task.  So is a token's place on the page of least digest, which gives the
order of a class, as its tokens are on the same pages.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.llm.common import row_slices, stage

# A class is valid when it is on this share of a host's distinct pages, of which there must
# be enough to tell what repeats from what some copies share.
LEAST_SHARE, LEAST_PAGES = 0.9, 5
# Tokens of a class at least; fewer may be alike by chance.
LEAST_TOKENS = 2
# Bits of a place on a page; later ones count as the last.
_PLACE_BITS = 22
# Element kinds by their part in a page.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = "script|style|noscript|template|textarea|title|iframe|svg|xmp"
_ARTICLE = frozenset(("article", "main"))
_ASIDE = frozenset(
    "nav footer aside form script style noscript template iframe svg button select textarea dialog menu head".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
_HEADING = frozenset("h1 h2 h3 h4 h5 h6 th dt caption figcaption legend summary".split())
# Words of a class or id that mark what is no part of an article.
_MARKED = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer login menu modal nav navbar navigation newsletter notice popup promo related replies reply "
    "search share sharing sidebar social sponsor sponsored subscribe widget".split()
)
_ROLES = frozenset("alert banner complementary contentinfo dialog form menu navigation search".split())

# What stands in a tag after its name.  A quote that nothing closes is a character like any
# other, and a tag that nothing closes ends before the next one: nothing is read twice.
_ATTRIBUTES = r"(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    rf"|<(?P<raw>{_RAW})\b{_ATTRIBUTES}>.*?(?:</(?P=raw)\s*+>|\Z)"
    rf"|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*+)(?P<attrs>{_ATTRIBUTES})(?:>|(?=<)|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
# A text without a letter or a digit says nothing of a template.
_TELLING = re.compile(r"[^\W_]")
_CLASS_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")


def _apart(name: str, attributes: str) -> bool:
    """Is an element no part of an article, by its kind, role or class."""
    if name in _ASIDE:
        return True
    for key, value in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "role" and value.lower() in _ROLES:
            return True
        if key in ("class", "id"):
            for part in value.split():
                if _MARKED.intersection(w.lower() for w in _CLASS_WORDS.findall(part)):
                    return True
    return False


@dataclass(frozen=True)
class Open:
    """An open element, whether it is no part of an article, and a hash of the path to it."""

    name: str
    apart: bool
    path: int


class Token(NamedTuple):
    """A tag or text of a page; ``label`` is 0 for a text that says nothing."""

    label: int
    kind: str
    text: str
    in_article: bool
    apart: bool
    heading: bool


class Page:
    """Tokens of a page in order."""

    def __init__(self, source: str):
        self.tokens: list[Token] = []
        self.has_article = False
        self._open: list[Open] = []
        self._names: Counter[str] = Counter()
        self._articles = self._asides = self._headings = 0
        for match in _TOKEN.finditer(source):
            name, text = match["name"], match["text"]
            if text is not None:
                self._add("text", text.strip() if _TELLING.search(text) else None, text)
                continue
            if name is None:
                continue  # comments, declarations, and elements whose content is no markup
            name, attributes = name.lower(), match["attrs"]
            if match["close"]:
                if self._names[name]:
                    while self._end() != name:
                        pass
                self._add(name, "/" + name)
                continue
            # A new paragraph or item ends an open one.
            last = self._open[-1].name if self._open else ""
            if last == "p" and name in _BLOCK or last == name and name in ("li", "dt", "dd", "option"):
                self._end()
            apart = _apart(name, attributes) or name == "header" and not self._articles
            # Containers of the whole page are never taken out, whatever their class.
            apart = apart and name not in ("html", "body") and name not in _ARTICLE or name in _ARTICLE and _apart("", attributes)
            label = f"{name} {attributes if 'href' not in attributes else ''}"
            before = self._path()
            if name not in _VOID and not attributes.rstrip().endswith("/"):
                self._begin(name, apart)
                self.has_article |= name in _ARTICLE and not self._asides
            self._add(name, label, path=before)

    def _path(self) -> int:
        return self._open[-1].path if self._open else 0

    def _begin(self, name: str, apart: bool) -> None:
        path = xxhash.xxh3_64_intdigest(f"{self._path()}/{name}") if name in _BLOCK else self._path()
        self._open.append(Open(name, apart, path))
        self._names[name] += 1
        self._articles += name in _ARTICLE
        self._asides += apart
        self._headings += name in _HEADING

    def _end(self) -> str:
        gone = self._open.pop()
        self._names[gone.name] -= 1
        self._articles -= gone.name in _ARTICLE
        self._asides -= gone.apart
        self._headings -= gone.name in _HEADING
        return gone.name

    def _add(self, kind: str, label: str | None, text: str = "", path: int | None = None) -> None:
        path = self._path() if path is None else path
        told = 0 if label is None else (xxhash.xxh3_64_intdigest(f"{path}|{label}") >> 1) or 1
        self.tokens.append(Token(told, kind, text, self._articles > 0, self._asides > 0, self._headings > 0))

    def places(self) -> dict[int, list[int]]:
        """Where each token stands."""
        found: dict[int, list[int]] = {}
        for at, token in enumerate(self.tokens):
            if token.label:
                found.setdefault(token.label, []).append(at)
        return found

    def template(self, classes: list[list[int]]) -> set[int]:
        """Places of the tokens of all classes that hold here, larger classes first."""
        places, held = self.places() if classes else {}, []
        for members in sorted(classes, key=lambda c: (-len(c), c)):
            at = [places.get(token, ()) for token in members]
            if not at[0] or any(len(a) != len(at[0]) for a in at):
                continue
            # A row for each time the class occurs.
            rounds = np.array(at).T
            if (np.diff(rounds.ravel()) > 0).all() and all(_nested(rounds, h) or _nested(h, rounds) for h in held):
                held.append(rounds)
        return {at for rounds in held for at in rounds.ravel().tolist()}

    def text(self, classes: list[list[int]]) -> str:
        """Main text, given the classes of the host's template.

        Inside an article the template takes out whole blocks only, notices and the like,
        and never a heading: a text that repeats beside the page's own words is kept.
        """
        template = self.template(classes)
        blocks: list[str] = []
        block: list[tuple[str, bool]] = []
        spare = False

        def end_block() -> None:
            nonlocal spare
            words = " ".join("".join([text for text, repeats in block if spare or not repeats]).split())
            if words:
                blocks.append(words)
            block.clear()
            spare = False

        for at, token in enumerate(self.tokens):
            if token.kind == "text":
                if not token.apart and (token.in_article or not self.has_article):
                    repeats = at in template
                    block.append((html.unescape(token.text), repeats))
                    spare |= token.in_article and (token.heading or not repeats and bool(_TELLING.search(token.text)))
            elif token.kind == "br":
                block.append(("\n", False))
            elif token.kind in _BLOCK:
                end_block()
        end_block()
        return "\n\n".join(blocks)


def _nested(inner: np.ndarray, outer: np.ndarray) -> bool:
    """Does each round of a class stand between two neighbouring tokens of another?"""
    gap = np.searchsorted(outer.ravel(), inner)
    return bool((gap == gap[:, :1]).all())


def host_of(url: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``page, html, host`` to one row per page and distinct token.

    ``place`` orders a token's pages by digest, and holds its first place on the page.
    """
    last = (1 << _PLACE_BITS) - 1
    for whole in batches:
        for batch in row_slices(whole):
            rows: list[tuple] = []
            for page, source, host in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows += [
                    (page, host, token, len(at), page & ~last | min(at[0], last))
                    for token, at in Page(source).places().items()
                ]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["page", "host", "token", "times", "place"]
            )


def host_templates(pages: DataFrame) -> DataFrame:
    """``host, classes`` from ``page, html, host``: each host's template, its tokens in order.

    ``page`` is a digest of ``html``, so a page under two addresses is one.  Tokens with one
    occurrence vector are a class.
    """
    vector = F.bit_xor(F.xxhash64("page", "times"))
    # Copies of a page count once; only theirs need their token rows compared.
    distinct = stage(pages.groupBy("host", "page").agg(F.count("*").alias("copies")), "contents")
    copied = distinct.where("copies > 1").select("host", "page")
    rows = "page long, host long, token long, times int, place long"
    read = lambda how: pages.join(copied, ["host", "page"], how).select("page", "html", "host").mapInArrow(_token_rows, rows)
    sizes = distinct.groupBy("host").agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= LEAST_PAGES)
    tokens = (
        read("left_anti")
        .union(read("left_semi").distinct())
        .groupBy("host", "token")
        .agg(vector.alias("vector"), F.count("*").alias("on"), F.min("place").alias("place"))
        .where(F.col("on") >= LEAST_SHARE * LEAST_PAGES)
    )
    classes = (
        tokens.join(sizes, "host")
        .where((F.col("on") >= LEAST_SHARE * F.col("n_pages")))
        .groupBy("host", "vector", "on")
        .agg(F.array_sort(F.collect_list(F.struct("place", "token")))["token"].alias("members"))
        .where(F.size("members") >= LEAST_TOKENS)
    )
    return classes.groupBy("host").agg(F.collect_list("members").alias("classes"))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``page_id, html, url, classes`` to texts."""
    for whole in batches:
        for batch in row_slices(whole):
            texts = [
                Page(source).text(classes or [])
                for source, classes in zip(*(batch.column(k).to_pylist() for k in (1, 3)), strict=True)
            ]
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages`` (``page_id, url, html``).

    A null html is empty and gives an empty text.  A page without a host, or of a
    host with fewer than ``LEAST_PAGES`` distinct pages, has no template and is read by its
    own markup.  Blocks are joined in page
    order by an empty line; nothing else is dropped.  Rows that repeat a page are extracted
    like any other.  Other columns are not read; an empty table gives an empty result.
    """
    host = F.xxhash64(host_of("url"))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page"),
        F.coalesce("html", F.lit("")).alias("html"),
        host.alias("host"),
        "url",
    )
    # Written first: its true size then decides how it is joined.
    templates = stage(host_templates(rows.select(F.xxhash64("html").alias("page"), "html", "host")), "templates")
    return (
        rows.join(templates, "host", "left")
        .select("page", "html", "url", "classes")
        .mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
    )
