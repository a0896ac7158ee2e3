"""Main text of web pages by consensus paths of their hosts.

First every page scores its containers by the text that stands in them, less that in links, and
names the path of the best one, or of the outermost article or main around it: tags and classes
from the body down, numbers generalised. Spark
counts the votes per host and path. Then each page is read again with the winning paths of its host:
the first of them that the page has, by votes, holds the article; a page with none of them uses its
own best container. A path that is not an article or main gives way to a winning path inside it that
wins on at least half of the pages which have it: the body is on every page, so on its own it says
nothing about pages of another template. If the body is left, an article or main that is the page's
own best container is taken instead. All elements of the page with that path belong to the article, such as its
sections; where a path is cut to its last steps, those as deep as the best one.

Left out wherever they stand: menus, headers, footers, sidebars, notices, adverts, forms, reader
comments (told by tag, role, class or id), scripts, styles, markup and what is hidden. Headings,
elements inside a line and the sections of an article are not left out for a name; nor is a header
with a title, or a form around a title or most of the page. Character
references are decoded, white space inside a block becomes one space, and blocks are joined by one.

Defined cases: null or empty html and pages without an article's text give an empty text; a page
whose url is null or has no host uses its own best container; repeated rows vote and are
extracted each; an empty table gives an empty result. Only id, url and html are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.byte_bpe import slices
from layerloom.llm.common import stage

# A path wins if so large a part of its host's pages votes for it, so at most 1 / WIN paths do.
WIN = 0.02
# Steps of a path, from its end.
STEPS = 6

_START = re.compile(r"<(?:!--|[!?]|/?(?=[a-zA-Z]))")
_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
# Attributes up to the end of the tag, which may stand in quotes.
_ATTRIBUTES = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
# Looks at the whole rest of a page for quotes that never close; then every > ends its tag.
_LOOKS = 20
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_RAW = frozenset("script style textarea title xmp noscript iframe template svg select".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr b bdi bdo cite code data dfn em font i kbd mark q s samp small span strike strong sub sup time tt u var "
    "ins del label big".split()
)
_CONTAINERS = frozenset("article main section div td body".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NOISE_TAGS = frozenset("nav footer aside button dialog menu head object audio video canvas".split())
_NOISE_ROLES = frozenset(
    "navigation contentinfo complementary search dialog alert alertdialog menu menubar form banner".split()
)
# Words of a class or id that mark what is not the article.
_NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu submenu sidebar aside footer header masthead comment comments commentlist reply replies respond disqus "
    "discussion cookie cookies consent gdpr notice notices notification alert newsletter subscribe subscription signup "
    "signin login share sharing social related recommended recommendations breadcrumb breadcrumbs popup modal overlay "
    "widget form search toolbar pagination pager skip tags tagcloud".split()
)
# Ids of sections that are no part of an article; others may be named after what they tell of.
_NOISE_SECTIONS = frozenset("comments commentlist respond disqus disqus_thread sidebar newsletter cookies breadcrumbs".split())
# Tags that end with the opening of one of the same kind, and where the search for it stops.
_ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}


def _scan(html: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Tags in order: where one begins and ends, whether it closes, its name and its attributes.
    Comments and declarations have no name. Never looks twice at a stretch without going on; the
    receiver may send the place from which to go on."""
    at, looks = 0, _LOOKS
    while found := _START.search(html, at):
        begin, mark = found.start(), found[0]
        if mark == "<!--":
            end = html.find("-->", found.end())
            end, name, attributes = (len(html) if end < 0 else end + 3), "", ""
        else:
            named = _TAG_NAME.match(html, found.end()) if mark in ("<", "</") else None
            stop = named.end() if named else found.end()
            end = html.find(">", stop)
            if end < 0:
                return
            if named and looks and (html.find('"', stop, end) >= 0 or html.find("'", stop, end) >= 0):
                last = _ATTRIBUTES.match(html, stop).end()
                if html[last : last + 1] == ">":
                    end = last
                else:
                    looks -= 1
            name, attributes = (named[0].lower(), html[stop:end]) if named else ("", "")
            end += 1
        moved = yield begin, end, mark == "</", name, attributes
        at = end if moved is None else moved


class Page:
    """The elements of a page in order, and its text between them.

    ``pieces`` holds text, or None where a block begins or ends. Element ``k`` spans the elements up
    to ``last[k]`` and the pieces from ``begin[k]`` to ``end[k]``.
    """

    def __init__(self, html: str):
        self.tag, self.parent, self.words, self.kind = ["body"], [-1], [""], [0]
        self.begin, self.end, self.last = [0], [0], [0]
        self.pieces: list[str | None] = []
        self.owner: list[int] = []
        self._read(html)

    def _read(self, html: str) -> None:
        stack, at, never = [0], 0, set()
        self.open: dict[str, int] = {}
        tags = _scan(html)
        tag = next(tags, None)
        while tag:
            begin, end, closes, name, attributes = tag
            if begin > at:
                self._text(html[at:begin], stack[-1])
            at, moved = end, None
            if closes:
                self._close(name, stack)
            elif name in _RAW:
                # What is inside is no text of the page, whatever it looks like.
                closing = None if name in never else re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
                if closing:
                    at = moved = closing.end()
                elif name in ("script", "style", "textarea", "title", "xmp"):
                    at = moved = len(html)
                else:
                    never.add(name)
            elif name:
                self._open(name, attributes, stack, attributes.endswith("/"))
            try:
                tag = tags.send(moved)
            except StopIteration:
                break
        if at < len(html):
            self._text(html[at:], stack[-1])
        while stack:
            self._pop(stack)

    def _text(self, text: str, owner: int) -> None:
        self.pieces.append(unescape(text) if "&" in text else text)
        self.owner.append(owner)

    def _break(self, owner: int) -> None:
        self.pieces.append(None)
        self.owner.append(owner)

    def _open(self, name: str, attributes: str, stack: list[int], empty: bool) -> None:
        if name not in _INLINE:
            if name in _ENDS:
                self._pop_to(stack, *_ENDS[name])
            else:
                self._pop_to(stack, {"p"}, {"table", "td", "th", "button", "article", "div", "section", "li"})
            self._break(stack[-1])
        if name in _VOID or name in ("html", "body"):
            if name == "body":
                self.words[0] = self._describe(attributes, name)[0]
            return
        words, kind = self._describe(attributes, name)
        if name in _NOISE_TAGS:
            kind = 2
        elif name == "form":
            kind = max(kind, 3)
        elif name == "header":
            kind = max(kind, 1)
        self.tag.append(name)
        self.parent.append(stack[-1])
        self.words.append(words)
        self.kind.append(kind)
        self.begin.append(len(self.pieces))
        self.end.append(-1)
        self.last.append(-1)
        stack.append(len(self.tag) - 1)
        self.open[name] = self.open.get(name, 0) + 1
        if empty and name not in _INLINE and name not in _CONTAINERS and name != "p":
            self._pop(stack)

    def _describe(self, attributes: str, tag: str) -> tuple[str, int]:
        """Class words for the path, and 2 for noise, 1 for noise unless the article is inside.

        Names say nothing of headings and of elements inside a line, and the id of a section only
        when it is one that no section of an article has."""
        if "=" not in attributes and "hidden" not in attributes:
            return "", 0
        classes, kind = "", 0
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), unescape(value.strip("\"'"))
            if name == "class":
                classes = ".".join(sorted(re.sub(r"\d+", "#", c) for c in value.split()))
            if name in ("class", "id") and tag not in _INLINE and tag not in _HEADINGS:
                if name == "id" and tag == "section":
                    told = value.lower() in _NOISE_SECTIONS
                else:
                    told = not _NOISE_WORDS.isdisjoint(w.lower() for w in _NAME.findall(value))
                kind = max(kind, int(told))
            elif name == "role" and value.lower() in _NOISE_ROLES:
                kind = max(kind, 1)
            elif (
                name == "hidden"
                or name == "aria-hidden" and value.lower() == "true"
                or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)
            ):
                kind = 2
        return classes, kind

    def _pop(self, stack: list[int]) -> None:
        k = stack.pop()
        if k:
            self.open[self.tag[k]] -= 1
        if self.tag[k] not in _INLINE:
            self._break(k)
        self.end[k], self.last[k] = len(self.pieces), len(self.tag) - 1

    def _pop_to(self, stack: list[int], names: set[str], stop: set[str]) -> None:
        if not any(self.open.get(n) for n in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[depth]]
            if tag in names:
                while len(stack) > depth:
                    self._pop(stack)
                return
            if tag in stop:
                return

    def _close(self, name: str, stack: list[int]) -> None:
        if name in ("body", "html") or not self.open.get(name):
            return
        for depth in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[depth]]
            if tag == name:
                while len(stack) > depth:
                    self._pop(stack)
                return
            if name in _INLINE and tag not in _INLINE:
                return
            if name == "p" and tag in _CONTAINERS:
                return

    def noise(self) -> list[bool]:
        """Per element, whether it or an element around it is no part of an article.

        What may be noise by its name or tag is none with an article or main inside. A header is none
        with a title inside (in an article, with any heading), nor is a form with a title or with
        more than half of the page's text."""
        mains = [k for k, t in enumerate(self.tag) if t in ("article", "main") and not self.kind[k]]
        titles = sorted([*mains, *(k for k, t in enumerate(self.tag) if t == "h1")])
        headings = sorted([*mains, *(k for k, t in enumerate(self.tag) if t in _HEADINGS)])
        written = [0]
        for piece in self.pieces:
            written.append(written[-1] + (len(piece) if piece else 0))
        out, within = [False] * len(self.tag), [False] * len(self.tag)
        for k in range(1, len(out)):
            kind, tag, up = self.kind[k], self.tag[k], self.parent[k]
            within[k] = within[up] or tag in ("article", "main")
            if kind in (1, 3) and tag not in ("article", "main"):
                inside = mains
                if tag == "header":
                    inside = headings if within[up] else titles
                elif kind == 3:
                    inside = titles
                at = bisect_left(inside, k + 1)
                if at < len(inside) and inside[at] <= self.last[k]:
                    kind = 0
                elif kind == 3 and 2 * (written[self.end[k]] - written[self.begin[k]]) > written[-1]:
                    kind = 0
            out[k] = out[up] or kind > 0
        return out

    def path(self, k: int) -> str:
        steps = []
        while k >= 0 and len(steps) < STEPS:
            steps.append(self.tag[k] + ("." + self.words[k] if self.words[k] else ""))
            k = self.parent[k]
        return "/".join(reversed(steps))

    def scores(self, noise: list[bool]) -> dict[int, float]:
        """Score of every container that has text inside: its own blocks count whole, and each
        container hands half of its score to the one around it."""
        held: dict[int, float] = {}
        near, linked = [0] * len(self.tag), [False] * len(self.tag)
        for k in range(1, len(near)):
            up = self.parent[k]
            near[k] = k if self.tag[k] in _CONTAINERS else near[up]
            linked[k] = linked[up] or self.tag[k] == "a"
        for piece, k in zip(self.pieces, self.owner):
            if piece and not noise[k]:
                n = len(piece) - piece.count(" ")
                home = near[k]
                held[home] = held.get(home, 0.0) + (-n if linked[k] else n)
        for k in range(len(near) - 1, 0, -1):
            if k in held:
                up = near[self.parent[k]]
                held[up] = held.get(up, 0.0) + held[k] / 2
        for k in held:
            if self.tag[k] in ("article", "main"):
                held[k] *= 2
        # An article without text is still the place where it would be.
        for k, tag in enumerate(self.tag):
            if tag == "article" and not noise[k]:
                held.setdefault(k, 0.0)
        return held

    def best(self, noise: list[bool], scores: dict[int, float]) -> int | None:
        whole = [k for k in scores if not noise[k] and (scores[k] > 0 or self.tag[k] == "article")]
        best = max(whole, key=lambda k: (scores[k], -k), default=None)
        k = -1 if best is None else self.parent[best]
        while k >= 0:
            if self.tag[k] in ("article", "main"):
                best = k
            k = self.parent[k]
        return best

    def texts(self, found: list[int], scores: dict[int, float], noise: list[bool]) -> str:
        """Text of the elements ``found``, which have one path, as far as they are as deep as the best."""
        best = max(found, key=lambda k: (scores.get(k, 0.0), -k))
        depth = [0]
        for up in self.parent[1:] if len(found) > 1 else []:
            depth.append(depth[up] + 1)
        every = (self.text(k, noise) for k in found if k == best or depth[k] == depth[best])
        return " ".join(t for t in every if t)

    def text(self, k: int, noise: list[bool]) -> str:
        kept = (
            " " if piece is None else piece
            for piece, o in zip(self.pieces[self.begin[k] : self.end[k]], self.owner[self.begin[k] : self.end[k]])
            if piece is None or not noise[o]
        )
        return " ".join("".join(kept).split())


def _votes(html: str | None) -> tuple[str | None, set[str]]:
    """The path of a page's best container, and those of all its containers."""
    if not html:
        return None, set()
    page = Page(html)
    noise = page.noise()
    best = page.best(noise, page.scores(noise))
    every = {page.path(k) for k, tag in enumerate(page.tag) if tag in _CONTAINERS and not noise[k]}
    return (None if best is None else page.path(best)), every


def _vote(html: str | None) -> str | None:
    return _votes(html)[0]


def extract(html: str | None, paths: list[str], firm: Iterable[str] = ()) -> str:
    """The article of a page, given its host's paths in order of votes, and those of them that win on
    at least half of the pages which have them."""
    if not html:
        return ""
    page = Page(html)
    noise = page.noise()
    scores = page.scores(noise)
    found: dict[str, list[int]] = {}
    for k, tag in enumerate(page.tag):
        if tag in _CONTAINERS and not noise[k]:
            found.setdefault(page.path(k), []).append(k)
    best = page.best(noise, scores)
    path = next((p for p in paths if p in found), None)
    held = set(firm)
    inside = [p for p in paths if p in held and p in found]
    while path is not None:
        # Paths inside a whole article are its parts.
        if page.tag[found[path][0]] in ("article", "main"):
            return page.texts(found[path], scores, noise)
        spans = [(k, page.last[k]) for k in found[path]]
        inner = (p for p in inside if p != path and any(a < k <= z for k in found[p] for a, z in spans))
        deeper = next(inner, None)
        if deeper is None:
            break
        # No path is left for one that was left before.
        inside = [p for p in inside if p not in (path, deeper)]
        path = deeper
    if path is not None and not (path == page.path(0) and best and page.tag[best] in ("article", "main")):
        return page.texts(found[path], scores, noise)
    return "" if best is None else page.texts(found.get(page.path(best), [best]), scores, noise)


def host_of(url):
    """Host name in lower case, without port; empty if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(host, F.lit(""))


def winning_paths(pages: DataFrame) -> DataFrame:
    """``host``, its ``paths``, most votes first, and the ``firm`` ones, which win on at least half of
    the pages that have them. Votes and pages are combined before they move."""

    def vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = batch.column("host").to_pylist()
            counts: dict[tuple[str, str], list[int]] = {}
            at = 0
            for part in slices(batch.column("html")):
                for html in part.to_pylist():
                    best, every = _votes(html)
                    for path in every if best is None else every | {best}:
                        mine = counts.setdefault((hosts[at], path), [0, 0])
                        mine[0] += path == best
                        mine[1] += 1
                    at += 1
            yield pa.record_batch(
                [
                    pa.array([h for h, _ in counts], pa.string()),
                    pa.array([p for _, p in counts], pa.string()),
                    pa.array([n for n, _ in counts.values()], pa.int64()),
                    pa.array([m for _, m in counts.values()], pa.int64()),
                ],
                names=["host", "path", "n", "pages"],
            )

    votes = pages.where("host != ''").select("host", "html").mapInArrow(vote, "host string, path string, n long, pages long")
    counted = votes.groupBy("host", "path").agg(F.sum("n").alias("n"), F.sum("pages").alias("pages"))
    counted = stage(counted.where("n > 0"))
    total = counted.groupBy("host").agg(F.sum("n").alias("total"))
    won = counted.join(total, "host").where(F.col("n") >= WIN * F.col("total"))
    order = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "path")))
    firm = F.collect_list(F.when(2 * F.col("n") >= F.col("pages"), F.col("path")))
    return won.groupBy("host").agg(order["path"].alias("paths"), firm.alias("firm"))


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page.

    The winners are written first, so their size is known: Spark broadcasts them if they are small
    and splits a host with very many pages otherwise.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            paths, firm = batch.column("paths").to_pylist(), batch.column("firm").to_pylist()
            for part in slices(batch.column("html")):
                for html in part.to_pylist():
                    texts.append(extract(html, paths[len(texts)] or [], firm[len(texts)] or []))
            yield pa.record_batch(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(list(map(len, texts)), pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    picked = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.col(html_col).alias("html"),
        host_of(F.col(url_col)).alias("host"),
    )
    winners = stage(winning_paths(picked))
    joined = picked.join(winners, "host", "left").select("page_id", "url", "html", "paths", "firm")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
