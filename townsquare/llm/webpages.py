"""Main text of web pages: what the markup names as furniture goes, and so does a site's template.

Every element of a page is hashed with all that it holds. Spark counts, per host, on how many different pages each hash
occurs; an element whose hash recurs on many pages of the host is deleted from all of them. Pages count by the text of
their content, so copies of one page are one page. Inside an article only blocks that their place or markup tells apart
from prose are counted: containers that come first or last, or whose text is mostly links. Passages that several articles
share are text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from townsquare.llm.common import stored

# Element and attribute names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
NEVER = set(
    "script style noscript template head title nav footer aside form iframe svg button select textarea input dialog menu "
    "object canvas audio video map".split()
)
ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
FURNITURE = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
    "consent disqus footer header masthead menu modal nav navbar navigation newsletter notice notices popup promo promotion "
    "related share sharing sidebar social sponsor sponsored subscribe subscription widget "
    # names that sites and their software often give
    "ad-banner ad-box ad-container ad-slot ad-unit ad-wrapper adsbygoogle breadcrumb-nav comment-form comment-list comments-area "
    "comments-section cookie-banner cookie-bar cookie-consent cookie-notice footer-widgets main-menu main-nav main-navigation "
    "nav-bar nav-menu newsletter-form newsletter-signup page-footer post-navigation related-articles related-posts share-bar "
    "share-buttons sharing-buttons side-bar sidebar-left sidebar-right site-footer site-header site-nav site-navigation "
    "social-icons social-links social-media social-share top-bar widget-area".split()
)
CLOSES_PARAGRAPH = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
#: an opening tag of the key ends an open element of the value, unless one of SCOPES comes between
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
SCOPES = set("ul ol dl table article section div body nav aside main".split())
#: what can be a template inside an article, and the share of its text in links from which it is one anywhere
CONTAINERS = set("div section ul ol dl table details fieldset center".split())
LINKED = 0.5
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_SPACE = re.compile(r"\s+")


class Element:
    __slots__ = ("tag", "attrs", "parts", "digest", "mark", "spared", "size", "linked")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.parts, self.digest, self.spared = tag, attrs, [], 0, False
        self.mark = self.size = self.linked = 0

    @property
    def never(self) -> bool:
        """Whether tag, role or visibility say that it is no part of an article."""
        a = self.attrs
        if self.tag in NEVER or "hidden" in a or a.get("aria-hidden") == "true" or a.get("role") in ROLES:
            return True
        return "display:none" in a.get("style", "").replace(" ", "")

    @property
    def marked(self) -> bool:
        """Whether a whole class name or the id says so; a part of a name ('has-sidebar') says nothing."""
        a = self.attrs
        if self.tag in ("html", "body", "main") or not a:
            return False
        names = {*a.get("class", "").lower().split(), a.get("id", "").lower()}
        return bool(names & FURNITURE - {self.tag})

    @property
    def furniture(self) -> bool:
        return self.never or self.marked and not self.spared


class Reader(HTMLParser):
    """Builds the tree of a page; open elements are ended as a browser would."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("html", {})
        self.open = [self.root]

    def _end(self, tags: set[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i:]
                return
            if self.open[i].tag in SCOPES and self.open[i].tag not in tags:
                return

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            return
        if tag in CLOSES_PARAGRAPH:
            self._end({"p"})
        if tag in ENDS:
            self._end(ENDS[tag])
        element = Element(tag, {k: v or "" for k, v in attrs})
        self.open[-1].parts.append(element)
        if tag not in VOID:
            self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag != "html" and self.open[-1].tag == tag and tag in ("svg", "path"):
            self.open.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].parts.append(data)


def read(html: str | None) -> Element:
    reader = Reader()
    reader.feed(html or "")
    reader.close()
    return reader.root


def walk(root: Element) -> Iterator[tuple[Element, bool]]:
    """All elements without recursion, each before and (True) after what it holds."""
    stack = [(root, False)]
    while stack:
        element, done = stack.pop()
        yield element, done
        if not done:
            stack.append((element, True))
            stack += [(x, False) for x in reversed(element.parts) if isinstance(x, Element)]


def _is_main(element: Element) -> bool:
    return element.tag == "main" or element.attrs.get("role") == "main"


def walk_all(roots: list[Element]) -> Iterator[tuple[Element, bool]]:
    for root in roots:
        yield from walk(root)


def content(root: Element) -> list[Element]:
    """The outermost articles; without one all main elements, else the bodies.

    An article or main element that a class or id marks, itself or on an element around it, counts where the page has no
    other; then no element around an article or main is furniture by its names.
    """
    articles, mains, bodies, doubtful = [], [], [], []
    stack = [(root, False, False)]
    while stack:
        element, doubt, within = stack.pop()
        if element is not root and element.never:
            continue
        doubt |= element is not root and element.marked
        if element.tag == "article":
            (doubtful if doubt else articles).append(element)
            continue
        if _is_main(element) and not within:
            (doubtful if doubt else mains).append(element)
            within = True
        if element.tag == "body":
            bodies.append(element)
        stack += [(x, doubt, within) for x in reversed(element.parts) if isinstance(x, Element)]
    if articles:
        return articles
    holds = set()
    for element, done in walk(root) if doubtful else ():
        if done and (element.tag == "article" or _is_main(element) or any(id(x) in holds for x in element.parts)):
            holds.add(id(element))
            element.spared = True
    if mains or not doubtful:
        return mains or bodies or [root]
    inner = {id(x) for d in doubtful for x, done in walk(d) if not done and x is not d}
    return [x for x in doubtful if id(x) not in inner]


def text(roots: list[Element], template: set[int] = frozenset()) -> str:
    """Blocks of text in page order, joined by one space. ``template`` holds hashes of elements to leave out."""
    out: list[str] = []
    stack: list = list(reversed(roots))
    inside = {id(x) for x in roots}
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            out.append(part)
            continue
        own = id(part) in inside
        if not own and (part.furniture or part.mark in template):
            continue
        if part.tag == "header" and not own:
            headings = [e for e, done in walk(part) if not done and e.tag in HEADINGS]
            stack += [" ", *(x for e in reversed(headings) for x in (" ", *reversed(e.parts))), " "]
            continue
        gap = "" if part.tag in INLINE else " "
        stack += [gap, *reversed(part.parts), gap]
    return _SPACE.sub(" ", "".join(out)).strip()


def _filled(element: Element) -> list[Element | str]:
    """The parts that can show text."""
    return [x for x in element.parts if (x.size and not x.furniture if isinstance(x, Element) else x.strip())]


def _edges(article: Element) -> set[int]:
    """The first and the last blocks of an article, headings before them left out, and the first and last in those."""
    found = set()
    for end in (0, -1):
        element = article
        while True:
            parts = _filled(element)
            while end == 0 and parts and isinstance(parts[0], Element) and (parts[0].tag in HEADINGS or parts[0].tag == "header"):
                parts.pop(0)
            if not parts or isinstance(parts[end], str):
                break
            element = parts[end]
            found.add(id(element))
    return found


def hash_elements(root: Element, roots: list[Element]) -> set[int]:
    """Hash the elements that ``text`` reads, each with all it holds, and mark those that can be a template: outside
    articles all, inside only containers at an edge of the article or mostly of links. Returns the marks of those with
    text or elements."""
    found: set[int] = set()
    own = {id(x) for x in roots}
    for element, done in walk_all(roots):
        if not done:
            continue
        digest = hashlib.blake2b(f"{element.tag} {element.attrs.get('class', '')} {element.attrs.get('id', '')}".encode(), digest_size=8)
        holds_article = False
        for part in element.parts:
            if isinstance(part, Element):
                digest.update(part.digest.to_bytes(8, "little", signed=True))
                holds_article |= part.digest == 0
                element.size += part.size
                element.linked += part.linked
            elif text_of := _SPACE.sub(" ", part).strip():
                digest.update(b"\x00" + text_of.encode())
                element.size += len(text_of)
        if element.tag == "a":
            element.linked = element.size
        # what holds an article differs with it and is no template
        holds_article |= element.tag == "article"
        element.digest = 0 if holds_article else int.from_bytes(digest.digest(), "little", signed=True) or 1
    stack: list[tuple[Element, set[int] | None]] = [(x, None) for x in roots]
    while stack:
        element, edges = stack.pop()
        if id(element) not in own:
            if element.furniture:
                continue
            filled = any(isinstance(x, Element) or x.strip() for x in element.parts)
            if edges is None:
                element.mark = element.digest
            elif element.tag in CONTAINERS and (id(element) in edges or element.linked >= LINKED * element.size > 0):
                # another mark than that of the same element outside articles
                element.mark = element.digest and (element.digest ^ 0x5BD1E995 or 1)
            if filled and element.mark and element.tag not in ("html", "body", "main"):
                found.add(element.mark)
        if element.tag == "article" and edges is None:
            edges = _edges(element)
        stack += [(x, edges) for x in element.parts if isinstance(x, Element)]
    return found


def host() -> Column:
    return F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _page_keys() -> list[Column]:
    return [F.xxhash64("html").alias("k1"), F.xxhash64(F.lit("second"), "html").alias("k2")]


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks, pages, rows = [], [], []
        for i, html in enumerate(batch.column("html").to_pylist()):
            root = read(html)
            roots = content(root)
            page = hashlib.blake2b(text(roots).encode(), digest_size=8).digest()
            found = hash_elements(root, roots)
            rows += [i] * len(found)
            pages += [int.from_bytes(page, "little", signed=True)] * len(found)
            marks += found
        own = [batch.column(n).take(pa.array(rows, pa.int64())) for n in ("host", "k1", "k2")]
        yield pa.RecordBatch.from_arrays(
            [*own, pa.array(marks, pa.int64()), pa.array(pages, pa.int64())], names=["host", "k1", "k2", "element", "page"]
        )


def templates(pages: DataFrame, *, least_pages: int = 4) -> DataFrame:
    """``host``, ``k1``, ``k2`` (a page by the hashes of its html) and ``template``: marks of its elements (see
    ``hash_elements``) that occur on at least ``least_pages`` different pages of the host, however many it has."""
    sited = pages.select(host().alias("host"), "html", *_page_keys()).where(F.col("host") != "")
    # read twice below, and pages are dear to parse
    rows = stored(sited.mapInArrow(_elements, "host string, k1 long, k2 long, element long, page long"), "elements")
    counts = rows.select("host", "element", "page").distinct().groupBy("host", "element").agg(F.count("*").alias("n"))
    many = counts.where(F.col("n") >= least_pages).select("host", "element")
    found = rows.join(many, ["host", "element"])
    return found.groupBy("host", "k1", "k2").agg(F.collect_set("element").alias("template"))


def extract(pages: DataFrame, **options) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every row.

    NULL or empty html gives an empty text, as does a page without content. A page without a host has no site template.
    Repeated rows are treated alike; other columns are not read.
    """
    own = pages.select("page_id", "url", "html", host().alias("host"), *_page_keys())
    known = own.join(templates(pages, **options), ["host", "k1", "k2"], "left").select("page_id", "url", "html", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for html, template in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                root = read(html)
                roots = content(root)
                if template:
                    hash_elements(root, roots)
                out.append(text(roots, set(template or ())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return known.mapInArrow(run, "page_id long, url string, text string, n_chars long")
