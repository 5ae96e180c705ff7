"""Main text of web pages, with site templates found by counting element subtrees per host.

A page is read into a tree of elements in one pass over its tags. Each element has a digest of its
subtree: name, attributes, text and the digests inside it. Spark counts on how many different pages
of a host a digest occurs. A subtree that recurs on a large share of them is part of the site's
template and is deleted from every page of the host, along with what its own markup declares to be
no article: menus, headers, footers, adverts, forms, scripts and the like.

Pages with equal bodies count as one page, so copies of an article don't make it a template. As a
template digest covers a fixed share of a host's pages, a host has at most its elements per page
over that share of them: the list that joins a host's pages is bounded. Pages are parsed where they
are read, twice; only digests are shuffled.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_or_not
from tidemark.session import written

# A template recurs on this share of a host's different pages, and on this many.
TEMPLATE_SHARE = 0.3
TEMPLATE_PAGES = 8

# Names of HTML elements and the words site markup uses for what is no article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math meter output "
    "q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "head title script style noscript template nav footer aside form button select option textarea input iframe "
    "object embed applet svg canvas audio video dialog menu map datalist".split()
)
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted nav "
    "navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar aside related recommended recommendations "
    "share sharing social cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe "
    "subscription signup login comment comments disqus respond replies widget toolbar pagination pager copyright "
    "disclaimer contentinfo complementary alert dialog search".split()
)
HEADER_WORDS = frozenset("header topbar".split())
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"),
}
CLOSABLE = frozenset(("p", *(name for names in CLOSES.values() for name in names)))
CLOSE_STOPS = frozenset("ul ol dl table article section main body html div nav aside footer header form".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[a-z0-9]+")


class Page:
    """Elements in the order of their start tags, and runs of text with their element and block."""

    __slots__ = ("names", "parents", "dropped", "digests", "runs", "outermost", "open", "levels")

    def __init__(self, source: str):
        self.names = ["#page"]
        self.parents = [-1]
        self.dropped = [False]
        # Per element the outermost article, and the outermost main, that it is in or is itself.
        self.outermost = {"article": [0], "main": [0]}
        self.digests = [0]
        # Open elements by name, and depths of those that can be closed without a tag, by the stops they are in.
        self.open: dict[str, int] = {}
        self.levels: list[dict[str, list[int]]] = [{}]
        self.runs: list[tuple[int, int, str]] = []
        hashers = [xxhash.xxh64()]
        stack = [0]
        block = at = 0

        def text(run: str) -> None:
            if run:
                if not run.isspace():
                    hashers[-1].update(" ".join(run.split()).encode("utf-8", "surrogatepass"))
                self.runs.append((stack[-1], block, run))

        def close(depth: int) -> None:
            nonlocal block
            while len(stack) > depth:
                node, digest = stack.pop(), hashers.pop().digest()
                self.digests[node] = int.from_bytes(digest, "big", signed=True)
                hashers[-1].update(digest)
                name = self.names[node]
                self.open[name] -= 1
                if name in CLOSE_STOPS:
                    self.levels.pop()
                elif name in CLOSABLE:
                    self.levels[-1][name].pop()
                if name not in INLINE:
                    block += 1

        find = _TAG.search
        while m := find(source, at):
            text(source[at : m.start()])
            at = m.end()
            name = m[2]
            if name is None:
                continue
            name = name.lower()
            if m[1]:
                for depth in range(len(stack) - 1, 0, -1) if self.open.get(name) else ():
                    if self.names[stack[depth]] == name:
                        close(depth)
                        break
                continue
            if name not in INLINE:
                block += 1
                self._close_open(name, close)
            attributes = m[3]
            if name in VOID:
                if name == "br":
                    self.runs.append((stack[-1], block, " "))
                continue
            parent = stack[-1]
            node = len(self.names)
            self.names.append(name)
            self.parents.append(parent)
            in_article = self.outermost["article"][parent] > 0
            for wanted, outermost in self.outermost.items():
                outermost.append(outermost[parent] or (node if name == wanted else 0))
            self.dropped.append(self.dropped[parent] or _is_dropped(name, attributes, in_article))
            self.digests.append(0)
            stack.append(node)
            self.open[name] = self.open.get(name, 0) + 1
            if name in CLOSE_STOPS:
                self.levels.append({})
            elif name in CLOSABLE:
                self.levels[-1].setdefault(name, []).append(len(stack) - 1)
            hashers.append(xxhash.xxh64(f"<{name} {attributes.strip()}>".encode("utf-8", "surrogatepass")))
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(source, at)
                stop = end.start() if end else len(source)
                text(source[at:stop])
                at = stop
                if not end:
                    break
        text(source[at:])
        close(1)
        self.digests[0] = int.from_bytes(hashers[0].digest(), "big", signed=True)

    def _close_open(self, name: str, close) -> None:
        """A block closes an open paragraph; items and cells close the one before."""
        depths = [self.levels[-1].get(open_name) for open_name in (*CLOSES.get(name, ()), "p")]
        lowest = min((d[0] for d in depths if d), default=None)
        if lowest is not None:
            close(lowest)

    def main(self) -> int:
        """The element that holds the article: the longest outermost article, else main, else the page."""
        sizes: dict[int, int] = {}
        for wanted in ("article", "main"):
            outermost = self.outermost[wanted]
            for node, _, run in self.runs:
                if outermost[node] and not self.dropped[node]:
                    sizes[outermost[node]] = sizes.get(outermost[node], 0) + len(run)
            if sizes:
                return max(sizes, key=lambda n: (sizes[n], -n))
        return 0

    def text(self, templates: frozenset[int] = frozenset()) -> str:
        """Blocks of the article, joined by line ends, without declared and recurring parts."""
        root = self.main()
        inside = [False] * len(self.names)
        for node, parent in enumerate(self.parents):
            kept = node == root or (parent >= 0 and inside[parent])
            inside[node] = kept and not self.dropped[node] and (node == root or self.digests[node] not in templates)
        blocks: list[str] = []
        held: list[str] = []
        current = None
        for node, block, run in self.runs:
            if not inside[node]:
                continue
            if block != current:
                blocks.append("".join(held))
                held, current = [], block
            held.append(run)
        blocks.append("".join(held))
        clean = (" ".join(entities.unescape(b).split()) for b in blocks)
        return "\n".join(b for b in clean if b)

    def countable(self) -> set[int]:
        """Digests of the elements with text that their markup doesn't already drop."""
        with_text = set()
        for node, _, run in self.runs:
            if not run.isspace():
                while node > 0 and node not in with_text:
                    with_text.add(node)
                    node = self.parents[node]
        root = self.main()
        above = set()
        while root > 0:
            above.add(root)
            root = self.parents[root]
        return {self.digests[n] for n in with_text if not self.dropped[n] and n not in above}

    def identity(self) -> int:
        """Digest of the part the article is in."""
        return self.digests[self.main()]


def _is_dropped(name: str, attributes: str, in_article: bool) -> bool:
    if name in DROPPED or (name == "header" and not in_article):
        return True
    if not attributes.strip() or name in ("html", "body", "article", "main"):
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        key = m[1].lower()
        value = (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
        if key in ("class", "id", "role"):
            # Inside an article a name such as "related-work" says what the text is about.
            words = set(value.split() if in_article else _WORD.findall(value))
            if words & DROPPED_WORDS or (not in_article and words & HEADER_WORDS):
                return True
    return False


def page_host(url):
    """The host of a URL column in lower case, without user and port; null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def site_templates(
    pages: DataFrame, share: float = TEMPLATE_SHARE, least: int = TEMPLATE_PAGES
) -> DataFrame:
    """``host, templates``: the digests that recur on at least ``share`` of a host's different pages."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, identities, found = [], [], []
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                page = Page(source)
                hosts.append(host)
                identities.append(page.identity())
                found.append(sorted(page.countable()))
            yield pa.RecordBatch.from_pydict(
                {
                    "host": pa.array(hosts, pa.string()),
                    "page": pa.array(identities, pa.int64()),
                    "digests": pa.array(found, pa.list_(pa.int64())),
                }
            )

    rows = pages.select(page_host(F.col("url")).alias("host"), "html").where("host is not null and html is not null")
    # One row per different page: copies fall together before their digests are spread out.
    different = written(
        rows.mapInArrow(digests, "host string, page long, digests array<long>")
        .groupBy("host", "page")
        .agg(F.first("digests").alias("digests"))
    )
    sizes = different.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= least)
    counts = (
        different.select("host", F.explode("digests").alias("digest"))
        .groupBy("host", "digest")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= least)
    )
    return (
        counts.join(small_or_not(written(sizes)), "host")
        .where(F.col("n") >= share * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_list("digest").alias("templates"))
    )


def main_text(pages: DataFrame, share: float = TEMPLATE_SHARE, least: int = TEMPLATE_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row, from its whole html.

    Character references are decoded, white space in a block is one space, blocks are joined by a
    line end. Null or empty html gives an empty text. Very long and deeply nested pages are read in
    time in proportion to their length. Inside an article only whole class, id and role words such as
    "sidebar" say that an element is no part of it. A page without a host has no site, so only
    its own markup counts. Repeated rows give a row each.
    """
    templates = small_or_not(written(site_templates(pages, share, least)))
    rows = pages.select("page_id", "url", "html", page_host(F.col("url")).alias("host"))
    joined = rows.join(templates, "host", "left").select("page_id", "url", "html", "templates")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                Page(source).text(frozenset(known or ())) if source else ""
                for source, known in zip(batch.column("html").to_pylist(), batch.column("templates").to_pylist())
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch.column("page_id"),
                    "url": batch.column("url"),
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array(map(len, texts), pa.int64()),
                }
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(extract, f"page_id {kind}, url string, text string, n_chars long")
