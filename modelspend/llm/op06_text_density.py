"""HTML extraction: composite text density.

A page is read into a tree of elements.  For every node the composite density
is its characters per tag, adjusted for links: with C characters, T tags, LC
characters and LT tags in links, it is C/T times the logarithm of
C/(C-LC) * T/LT to the base ln(C/(C-LC) * LC + LB/CB * C + e), where LB and CB
are the body's.  A node's density sum adds its children's densities; the
subtree with the largest sum holds the article.  The smallest density on the
path from it to the body is the threshold that other parts of the page must
reach to count as text too; of each such part, the subtree with its largest sum
is taken.  Within the same article or main element, parts that are not mostly
links count as well.

Where an ancestor of the densest part also holds a first-level heading, the parts
of that ancestor count like those of an article element.

Elements that are never an article (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles, reader comments) are left out by tag, role,
class or id before densities are compared.  A class, id or role counts if it is made of
such words and words of layout only: ``site-header``, not ``has-sidebar``.  A wrapper so named
stays nevertheless where it holds most of the page's text and all of its paragraphs.

Reading takes time in proportion to the page, however deep its elements are nested.

Edge cases: null html is an empty page with an empty text; unclosed, crossed
and truncated markup is read as browsers do, a broken tag's start as text;
repeated rows each get their row; an empty table gives no rows; other columns
are ignored; whole pages are read.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from modelspend.llm.shared import read_table

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
#: Contents of these are not markup; all but the first two are dropped with them.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q ruby rt rp s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "head nav header footer aside form script style noscript template button select input textarea iframe object embed "
    "svg canvas dialog menu title".split()
)
#: Words in a class, an id or a role that mark what is not the article.
NOT_ARTICLE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer sidebar complementary contentinfo search cookie cookies consent notice "
    "notification alert popup modal overlay newsletter subscribe signup login comment comments disqus reply replies "
    "respond related recommended share sharing social widget toolbar pagination pager".split()
)
#: Words of layout that may stand beside them.
LAYOUT = frozenset(
    "site page main global primary secondary left right top bottom inner outer bar box block list item items link links "
    "button buttons icon icons area section container wrapper wrap row col column panel group form post posts text title "
    "tab tabs js id ui sticky fixed mobile desktop".split()
)
#: Elements that say that text is running text.
RUNNING = frozenset("p article main".split())
#: Elements that show nothing, so they don't end a block.
SILENT = frozenset("script style template noscript".split())
#: An open element that ends where one of the others begins.
ENDS = {
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")),
    "th": frozenset(("td", "th")),
    "option": frozenset(("option",)),
}
CONTAINERS = frozenset("ul ol dl table tbody thead tfoot select article section main div body html".split())


KEPT, SUSPECT, DROP = 0, 1, 2


def names_no_article(value: str) -> bool:
    """Does one of these class, id or role names consist of words for what is not the article?"""
    for name in value.split():
        words = {w for w in re.split(r"[^a-z]+", name) if w}
        if words & NOT_ARTICLE and words <= NOT_ARTICLE | LAYOUT:
            return True
    return False


def verdict(tag: str, attributes: str) -> int:
    """Whether an element is left out for its tag, or as hidden (DROP), or for its names (SUSPECT)."""
    if tag in DROPPED:
        return DROP
    if not attributes or tag in ("body", "html", "article", "main"):
        return KEPT
    suspect = KEPT
    for m in ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        if name == "hidden":
            return DROP
        value = (m[2] or m[3] or m[4] or "").lower()
        if name == "aria-hidden":
            if value == "true":
                return DROP
        elif names_no_article(value):
            suspect = SUSPECT
    return suspect


class Page:
    """Elements in page order; node 0 is the page itself."""

    def __init__(self, source: str):
        self.tag, self.parent, self.dropped, self.suspect = ["html"], [-1], [False], [False]
        #: (node, text) in page order; None for the border of a block.
        self.texts: list[tuple[int, str | None]] = []
        self.body = 0
        self.read(source)
        self.drop_suspects()
        self.measure()

    def open(self, tag: str, parent: int, dropped: bool, suspect: bool = False) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.dropped.append(dropped)
        self.suspect.append(suspect)
        return len(self.tag) - 1

    def read(self, source: str) -> None:
        stack = [0]
        # depths of the open elements, by tag, and of the containers among them
        open_at: dict[str, list[int]] = {}
        containers: list[int] = []

        def push(node: int) -> None:
            tag = self.tag[node]
            open_at.setdefault(tag, []).append(len(stack))
            if tag in CONTAINERS:
                containers.append(len(stack))
            stack.append(node)

        def say(text: str) -> None:
            if text and not self.dropped[stack[-1]]:
                self.texts.append((stack[-1], text))

        def close(depth: int) -> None:
            while len(stack) > depth:
                tag = self.tag[stack.pop()]
                if stack:
                    open_at[tag].pop()
                    if tag in CONTAINERS:
                        containers.pop()
                if tag not in INLINE and tag not in SILENT:
                    self.texts.append((stack[-1] if stack else 0, None))

        at = 0
        while True:
            m = TOKEN.search(source, at)
            if m is None:
                say(source[at:])
                break
            say(source[at : m.start()])
            at = m.end()
            name = m[2] or m[5]
            if name is None:
                continue
            tag, attributes = name.lower(), m[3] or m[6] or ""
            if m[1] or m[4]:
                if open_at.get(tag):
                    close(open_at[tag][-1])
                continue
            if tag in ("html", "head", "body"):
                if tag == "body":
                    close(1)
                    self.body = self.open("body", 0, False)
                    push(self.body)
                elif tag == "head":
                    push(self.open("head", 0, True))
                continue
            block = tag not in INLINE and tag not in SILENT
            if block:
                # an open paragraph, list item or cell of the same container ends here
                ended = max((open_at[t][-1] for t in ("p", *ENDS.get(tag, ())) if open_at.get(t)), default=0)
                if ended > (containers[-1] if containers else 0):
                    close(ended)
            found = verdict(tag, attributes)
            dropped = self.dropped[stack[-1]] or found == DROP
            if tag == "br":
                say(" ")
            elif block:
                self.texts.append((stack[-1], None))
            node = self.open(tag, stack[-1], dropped, found == SUSPECT)
            if tag in VOID or attributes.endswith("/") and tag not in RAW and tag not in INLINE and tag != "p":
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(source, at)
                if not dropped:
                    self.texts.append((node, source[at : end.start() if end else len(source)]))
                at = end.end() if end else len(source)
                continue
            push(node)
        close(0)

    def drop_suspects(self) -> None:
        """Leave out what its names mark, but not the wrapper of the page's text."""
        n = len(self.tag)
        within, in_link = [0] * n, [False] * n
        plain, own, running = [0] * n, [0] * n, [0] * n
        for i in range(1, n):
            up = self.parent[i]
            within[i] = i if self.suspect[i] else within[up]
            in_link[i] = self.tag[i] == "a" or in_link[up]
        for node, text in self.texts:
            if text is not None and not in_link[node]:
                plain[node] += len("".join(text.split()))
        for i in range(n):
            own[within[i]] += plain[i]
        for i in range(n - 1, 0, -1):
            plain[self.parent[i]] += plain[i]
            running[within[i]] += self.tag[i] in RUNNING and plain[i] > 0 and not self.dropped[i]
        total, free, free_running = plain[0], own[0], running[0]
        for i in range(1, n):
            if self.dropped[self.parent[i]]:
                self.dropped[i] = True
            elif self.suspect[i]:
                if free_running or 10 * free >= total or 2 * plain[i] <= total:
                    self.dropped[i] = True
                else:
                    free, free_running = free + own[i], running[i]
        self.texts = [(node, text) for node, text in self.texts if text is None or not self.dropped[node]]

    def measure(self) -> None:
        n = len(self.tag)
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = self.tag[i] == "a" or in_link[self.parent[i]]
        for node, text in self.texts:
            if text is not None:
                size = len("".join(text.split()))
                chars[node] += size
                link_chars[node] += size * in_link[node]
        for i in range(n - 1, 0, -1):
            if self.dropped[i]:
                continue
            up = self.parent[i]
            chars[up] += chars[i]
            tags[up] += tags[i] + 1
            link_chars[up] += link_chars[i]
            link_tags[up] += link_tags[i] + (self.tag[i] == "a")
        ratio = link_chars[self.body] / max(1, chars[self.body])
        self.density, self.sum = [0.0] * n, [0.0] * n
        self.chars, self.link_chars = chars, link_chars
        for i in range(n):
            if chars[i] and not self.dropped[i]:
                c, t, lc, lt = chars[i], max(1, tags[i]), link_chars[i], max(1, link_tags[i])
                plain = max(1, c - lc)
                base = math.log(c / plain * lc + ratio * c + math.e)
                self.density[i] = max(0.0, c / t * math.log(max(1.0, c / plain * t / lt) + math.e - 1) / math.log(base + math.e - 1))
        for i in range(1, n):
            self.sum[self.parent[i]] += self.density[i]

    def below(self, i: int) -> Iterator[int]:
        while i >= 0:
            yield i
            i = self.parent[i]

    def article(self) -> set[int]:
        """Nodes whose texts are the article's."""
        n = len(self.tag)
        inside = [False] * n
        inside[self.body] = True
        for i in range(self.body + 1, n):
            inside[i] = inside[self.parent[i]] and not self.dropped[i]
        best = max((i for i in range(n) if inside[i]), key=lambda i: (self.sum[i], -i), default=self.body)
        if not self.sum[best]:
            best = self.body
        path = list(self.below(best))
        threshold = min(self.density[i] for i in path[: path.index(self.body) + 1])
        outer = next((i for i in path if self.tag[i] in ("article", "main")), None)
        if outer is None:
            titled = [False] * n
            for i in range(n - 1, self.body, -1):
                if inside[i] and (titled[i] or self.tag[i] == "h1" and self.chars[i]):
                    titled[i] = titled[self.parent[i]] = True
            outer = next((i for i in path[: path.index(self.body)] if titled[i]), best)
        chosen = set()
        on_path, in_outer = set(path), set(path[: path.index(outer) + 1])
        for i in range(n):
            if not inside[i]:
                continue
            up = self.parent[i]
            if i == best or up in chosen:
                chosen.add(i)
            elif i == outer or (up in in_outer and self.counts(i, threshold)):
                # beside the densest part, in the same article
                chosen.add(i)
                if i in on_path:
                    chosen.discard(i)
        if outer != best:
            chosen |= {i for i in path[: path.index(outer) + 1]}
        # anywhere on the page, dense subtrees: the node with the largest sum in each
        densest = list(range(n))
        for i in range(n - 1, self.body, -1):
            up = self.parent[i]
            if inside[i] and self.sum[densest[i]] >= self.sum[densest[up]] and self.sum[densest[i]] > self.sum[up]:
                densest[up] = densest[i]
        dense = {densest[i] for i in range(n) if inside[i] and self.chars[i] and self.density[i] >= threshold}
        for i in range(n):
            if inside[i] and (i in dense or self.parent[i] in dense):
                dense.add(i)
        return chosen | dense

    def counts(self, i: int, threshold: float) -> bool:
        return self.density[i] >= threshold or 2 * self.link_chars[i] < self.chars[i]

    def text(self) -> str:
        chosen = self.article()
        blocks, now = [], []
        for node, text in [*self.texts, (0, None)]:
            if text is None:
                if now:
                    block = " ".join(html.unescape("".join(now)).split())
                    if block:
                        blocks.append(block)
                    now = []
            elif node in chosen:
                now.append(text)
        return "\n".join(blocks)


def extract(source: str | None) -> str:
    return Page(source).text() if source else ""


def extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(source.as_py()) for source in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array(map(len, texts), pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row; one pass, no shuffle."""
    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, text string, n_chars bigint"
    return pages.select("page_id", "url", "html").mapInArrow(extract_batches, schema)


def op6_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_texts(read_table(spark, sf_dir, "pages"))
