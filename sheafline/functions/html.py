"""Reading HTML: column expressions for single tags, and a tolerant tree for whole pages inside Arrow batches."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.functions.text import PAGE_WORDS
from sheafline.session import spread

# Selectors of overlays, of article containers in order of preference, and of PDF links.
OVERLAYS = ("div.cookie", ".cookie-banner", "#cookie-consent", ".cc-window", ".overlay", ".modal", ".consent-banner", ".onetrust-banner", "#onetrust-banner-sdk", ".paywall", ".paywall-overlay", "[role=dialog]")
CONTAINERS = (
    "article", "main article", "[role='main']", ".article-body", ".article__body", ".article-content", ".c-article-body", ".c-article-section__content", "#article-body",
    ".post-content", ".entry-content", ".content-body", ".full-text", ".paper-content", "section.body",
)
PDF_LINKS = ("a[href$='.pdf']", "a:has-text('Download PDF')", "a:has-text('Download full text PDF')", "a:has-text('Full Text PDF')", "a:has-text('PDF')", "a.pdf-download")
ARTICLE_TYPES = ("ScholarlyArticle", "Article", "NewsArticle")
LISTED_TYPES = ("ScholarlyArticle", "Article")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul li".split())


class Node:
    """Element with attributes and children (elements and strings)."""

    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        """All elements below, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def strings(self) -> Iterator[str]:
        stack: list = list(reversed(self.children))
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                yield c
            elif c.tag not in ("script", "style"):
                stack.extend(reversed(c.children))

    def text(self, between: str = "") -> str:
        """Stripped strings, joined."""
        return between.join(s for s in (x.strip() for x in self.strings()) if s)


class _Builder(HTMLParser):
    """A block element closes an open paragraph; an end tag without open element is ignored; script content is opaque."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCKS:
            self._close("p", stop=_BLOCKS - {"p"})
        node = Node(tag, {k: v or "" for k, v in attrs}, self.here)
        self.here.children.append(node)
        if tag not in _VOID:
            self.here = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def _close(self, tag, stop=frozenset()):
        n = self.here
        while n.parent is not None:
            if n.tag == tag:
                self.here = n.parent
                return
            if n.tag in stop:
                return
            n = n.parent

    def handle_endtag(self, tag):
        self._close(tag)

    def handle_data(self, data):
        self.here.children.append(data)


def parse(html: str) -> Node:
    """Tree of a page, however broken its markup."""
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


_STEP = re.compile(r"""^(?P<tag>[a-zA-Z][\w-]*)?(?P<rest>(?:[.#][\w-]+|\[[^\]]+\]|:has-text\([^)]*\))*)$""")
_PART = re.compile(r"""[.#][\w-]+|\[([\w-]+)(?:([$^*]?=)['"]?([^'"\]]*)['"]?)?\]|:has-text\(['"]?([^'")]*)['"]?\)""")


def matches(node: Node, step: str) -> bool:
    """Whether an element fits one step of a selector: tag, class, id, attribute, contained text."""
    m = _STEP.match(step)
    if not m:
        raise ValueError(f"unsupported selector: {step}")
    if m["tag"] and node.tag != m["tag"].lower():
        return False
    for p in _PART.finditer(m["rest"]):
        s = p.group()
        if s[0] == ".":
            ok = s[1:] in node.attrs.get("class", "").split()
        elif s[0] == "#":
            ok = node.attrs.get("id") == s[1:]
        elif s[0] == ":":
            ok = p.group(4).lower() in node.text(" ").lower()
        else:
            have, how, want = node.attrs.get(p.group(1)), p.group(2), p.group(3)
            ok = have is not None and (how is None or {"=": have == want, "$=": have.endswith(want or ""), "^=": have.startswith(want or ""), "*=": (want or "") in have}[how])
        if not ok:
            return False
    return True


def select(root: Node, selector: str) -> Iterator[Node]:
    """Elements for a selector with optional ancestors, in document order."""
    steps = re.findall(r"(?:[^\s\[\]()]|\[[^\]]*\]|\([^)]*\))+", selector)
    for n in root.walk():
        if not matches(n, steps[-1]):
            continue
        up, wanted = n.parent, list(steps[:-1])
        while wanted and up is not None:
            if up.tag and matches(up, wanted[-1]):
                wanted.pop()
            up = up.parent
        if not wanted:
            yield n


def remove_overlays(root: Node) -> None:
    """Takes out overlays and dialogs."""
    for selector in OVERLAYS:
        for n in list(select(root, selector)):
            if n.parent is not None and n in n.parent.children:
                n.parent.children.remove(n)


def _linked_data(root: Node) -> dict | None:
    found = None
    for n in root.walk():
        if n.tag != "script" or n.attrs.get("type") != "application/ld+json":
            continue
        try:
            data = json.loads("".join(c for c in n.children if isinstance(c, str)))
        except ValueError:
            continue
        if isinstance(data, dict) and data.get("@type") in ARTICLE_TYPES:
            return data
        if isinstance(data, list):
            found = next((x for x in data if isinstance(x, dict) and x.get("@type") in LISTED_TYPES), found)
    return found


def _metas(root: Node, key: str, value: str) -> list[str]:
    return [n.attrs.get("content", "") for n in root.walk() if n.tag == "meta" and n.attrs.get(key) == value]


def extract(html: str | None) -> dict:
    """Text, title, authors and abstract of a page: linked data, then meta tags, then containers, then paragraphs."""
    empty = {"text": None, "title": None, "authors": [], "abstract": None}
    if html is None:
        return empty
    try:
        root = parse(html)
        remove_overlays(root)
        title = abstract = None
        authors: list = []
        data = _linked_data(root)
        as_text = lambda v: v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)
        if data:
            title = as_text(data.get("headline") or data.get("name"))
            abstract = as_text(data.get("description") or data.get("abstract"))
            who = data.get("author")
            if isinstance(who, list):
                authors = [as_text(a.get("name")) if isinstance(a, dict) else str(a) for a in who]
            elif isinstance(who, dict):
                authors = [as_text(who.get("name"))]
        if not title:
            named = _metas(root, "name", "citation_title") or _metas(root, "property", "og:title")
            title = (named[0] if named else None) or title
        if not authors:
            authors = [a for a in _metas(root, "name", "citation_author") if a]
        if not abstract:
            named = _metas(root, "name", "description") or _metas(root, "name", "dc.Description")
            abstract = (named[0] if named else None) or abstract
        box = None
        for selector in CONTAINERS:
            first = next(select(root, selector), None)
            if first is not None and len(first.text()) > 200:
                box = first
                break
        if box is not None:
            parts = [n.text(" ") for n in box.walk() if n.tag == "p" and len(n.text()) > 30]
        else:
            parts = [t for n in root.walk() if n.tag == "p" and len(t := n.text(" ")) >= 50 and not any(w in t.lower() for w in PAGE_WORDS)]
        return {"text": "\n\n".join(parts) or abstract or "", "title": title, "authors": authors, "abstract": abstract}
    except (ValueError, RecursionError, AssertionError):
        return empty


def documents(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id, text, title, authors, abstract, status`` of each page; ``no_content`` where nothing was found, ``error`` where parsing failed."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [extract(h) for h in b["html"]]
            status = ["error" if d["text"] is None else "ok" if d["text"] else "no_content" for d in out]
            yield pd.DataFrame({"id": b["id"], **{k: [d[k] for d in out] for k in ("text", "title", "authors", "abstract")}, "status": status})

    rows = spread(pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).cast("string").alias("html")))
    return rows.mapInPandas(apply, "id long, text string, title string, authors array<string>, abstract string, status string")


def links(pages: DataFrame, page_col: str = "page_url", html_col: str = "html", selector_col: str | None = None) -> DataFrame:
    """``page_url, href, title, pos, by_selector`` of each anchor: those of the page's selector if it matches any, else all."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for page, html, selector in zip(b["page_url"], b["html"], b["selector"]):
                root = parse(html)
                try:
                    chosen = [n for n in select(root, selector) if n.attrs.get("href")] if selector else []
                except ValueError:
                    chosen = []
                nodes = chosen or [n for n in root.walk() if n.tag == "a" and n.attrs.get("href")]
                out += [(page, n.attrs["href"], "".join(n.strings()), i, bool(selector)) for i, n in enumerate(nodes)]
            yield pd.DataFrame(out, columns=["page_url", "href", "title", "pos", "by_selector"])

    chosen = F.col(selector_col) if selector_col else F.lit(None).cast("string")
    rows = pages.select(F.col(page_col).alias("page_url"), F.col(html_col).alias("html"), chosen.alias("selector")).where("html is not null")
    return rows.mapInPandas(apply, "page_url string, href string, title string, pos int, by_selector boolean")


def pdf_button(root: Node, selector: str | None = None) -> str | None:
    """Address of a page's PDF: the first link of its own selector, else of the usual ones in their order, else any with ``.pdf``."""
    for s in ([selector] if selector else []) + list(PDF_LINKS):
        try:
            found = next((n.attrs["href"] for n in select(root, s) if n.attrs.get("href")), None)
        except ValueError:
            found = None
        if found:
            return found
    return next((n.attrs["href"] for n in root.walk() if n.tag == "a" and ".pdf" in n.attrs.get("href", "").lower()), None)


def pdf_buttons(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", selector_col: str | None = None) -> DataFrame:
    """``id, pdf`` of each page; null where no link is found or the page is null."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "pdf": [pdf_button(parse(h), s or None) if h else None for h, s in zip(b["html"], b["selector"])]})

    chosen = F.col(selector_col) if selector_col else F.lit(None).cast("string")
    rows = spread(pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).cast("string").alias("html"), chosen.alias("selector")))
    return rows.mapInPandas(apply, "id long, pdf string")


def attribute(html: Column, tag: str, key: str, value: str, wanted: str = "content") -> Column:
    """Attribute of the first tag with ``key="value"``, in either order of the two; entities stay encoded, empty is null."""
    want = rf"\b{wanted}\s*=\s*([\"'])(.*?)\1"
    one = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*?\b{key}\s*=\s*[\"']{value}[\"'][^>]*?{want}", 2)
    two = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*?{want}[^>]*?\b{key}\s*=\s*[\"']{value}[\"']", 2)
    return F.coalesce(F.nullif(one, F.lit("")), F.nullif(two, F.lit("")))


def heading(html: Column) -> Column:
    """Text of the first ``h1``, tags inside removed."""
    return F.nullif(F.trim(F.regexp_replace(F.regexp_extract(html, r"(?is)<h1\b[^>]*>(.*?)</h1>", 1), r"<[^>]+>", "")), F.lit(""))


def pdf_link(html: Column) -> Column:
    """Address in ``citation_pdf_url``, else the first link that contains ``.pdf``."""
    anchor = F.nullif(F.regexp_extract(html, r"(?i)<a\b[^>]*\bhref\s*=\s*[\"']([^\"']*\.pdf[^\"']*)[\"']", 1), F.lit(""))
    return F.coalesce(attribute(html, "meta", "name", "citation_pdf_url[^\"']*"), anchor)


def feed_links(html: Column) -> Column:
    """Feeds that a page announces, by kind of link and then position."""
    # How feeds are announced and linked, in order of preference.
    patterns = (
        r"(?i)<link[^>]*type=[\"']application/rss\+xml[\"'][^>]*href=[\"']([^\"']+)[\"']",
        r"(?i)<link[^>]*href=[\"']([^\"']+)[\"'][^>]*type=[\"']application/rss\+xml[\"']",
        r"(?i)<a[^>]*href=[\"']([^\"']+\.rss)[\"']",
        r"(?i)<a[^>]*href=[\"']([^\"']+/rss)[\"']",
        r"(?i)<a[^>]*href=[\"']([^\"']+/feed)[\"']",
    )
    return F.concat(*[F.regexp_extract_all(html, F.lit(p), F.lit(1)) for p in patterns])
