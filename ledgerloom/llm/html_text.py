"""Main text of web pages by consensus of each host's pages.

Every page's containers are scored: characters of their own text outside links and
boilerplate, and half of their children's score. From the best container the page is
climbed to the nearest article or main around it or, without one, while the parent
below body has text of its own outside links. The container reached votes for its
path, the chain of tags and generalised classes from the root. Votes are summed
per host in Spark, and every page of a host is extracted again at the winning
path; a page without that path, or without a host, uses its own best container.

Inside the container, menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments are left out, by tag, role or class. A class
is judged word by word: a word of content does not cancel one of menus, footers or
comments in the same compound (``article-footer``, ``comment-body``). Block
tags part the text; character references are decoded, white space in a block
becomes one space, empty blocks vanish and blocks are joined by two line ends.

Null or empty html gives an empty text. Broken markup is read as far as it goes:
unclosed comments and scripts end with the page, a cut-off tag is dropped. Rows
are extracted one by one, so repeated rows agree. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import slices

_RAW = "script|style|noscript|template|svg|math|iframe|object|textarea|title"
_MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})(?=[\s/>])[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][\w:-]*+)([^>]*+)>|<[!?][^>]*+>|<[a-zA-Z/!?][^>]*+\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

# Fixed lists of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot"
    " thead tr ul caption".split()
)
CONTAINERS = frozenset("article body div main section td blockquote center".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog button select head search".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Words of classes and ids that mark boilerplate wherever they stand in a compound,
SURE_WORDS = frozenset(
    "nav navbar navigation menu masthead topbar footer sidebar cookie cookies consent gdpr ad ads advert adverts"
    " advertisement sponsor sponsored promo related recommended comment comments disqus replies newsletter signup login"
    " popup modal overlay breadcrumb breadcrumbs pagination pager toolbar disclaimer".split()
)
#: words that do so as its last word or without a word of content,
LIKELY_WORDS = frozenset(
    "header aside notice notices banner promotion share sharing social form subscribe widget copyright legal skip".split()
)
#: words of content,
CONTENT_WORDS = frozenset("content article post entry story body main text".split())
#: words that never are content, whatever else the classes say,
COMMENT_WORDS = frozenset("comment comments disqus replies".split())
#: and first words of classes that only say what a page has or is.
STATE_WORDS = frozenset("has no is with without category tag type status format".split())


@dataclass
class Node:
    tag: str
    path: str
    parent: Node | None
    dropped: bool
    own: int = 0
    score: float = 0.0
    blocks: list[str] = field(default_factory=list)
    start: int = 0
    end: int = -1


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)} if "=" in text else {}


def _is_boilerplate(tag: str, attributes: dict[str, str], parent: Node | None) -> bool:
    if tag in BOILERPLATE_TAGS or attributes.get("role", "").lower() in BOILERPLATE_ROLES:
        return True
    if tag == "header":  # an article's own header holds its title
        while parent and parent.tag not in ("article", "main"):
            parent = parent.parent
        return parent is None
    if tag in ("body", "html", "main"):
        return False
    named = [_judged_class(x) for x in (*attributes.get("class", "").split(), *attributes.get("id", "").split())]
    if "comment" in named or "sure" in named:
        return True
    return "likely" in named and "content" not in named


def _judged_class(name: str) -> str:
    """What one class or id says: ``comment``, ``sure`` or ``likely`` boilerplate, ``content`` or nothing.

    Words are parted at anything but letters and at capitals inside. A word of comments decides wherever it
    stands, other boilerplate by itself or beside no class of content.
    """
    words = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower())
    if not words or words[0] in STATE_WORDS or {"with", "without"} & set(words):
        return ""
    if COMMENT_WORDS & set(words):
        return "comment"
    if len(words) == 1 and words[0] in SURE_WORDS:
        return "sure"
    content = bool(CONTENT_WORDS & set(words))
    if SURE_WORDS & set(words):
        return "sure" if content else "likely"
    if LIKELY_WORDS & set(words) and (not content or words[-1] in LIKELY_WORDS and words[-1] != "header"):
        return "likely"
    return "content" if content else ""


def _step(tag: str, attributes: dict[str, str]) -> str:
    """A tag with its classes; digits are generalised and classes made of many digits left out."""
    classes = sorted({re.sub(r"\d+", "0", c.lower()) for c in attributes.get("class", "").split()
                      if sum(map(str.isdigit, c)) <= 3})
    return ".".join([tag, *classes])


class Page:
    """Containers of a page and the blocks of its text in page order."""

    def __init__(self, source: str):
        self.blocks: list[str] = []
        self.containers: list[Node] = []
        root = Node("html", "", None, False)
        stack = [root]
        piece: list[str] = []
        links = 0

        def flush(node: Node) -> None:
            nonlocal links
            if piece:
                text = " ".join(html.unescape("".join(piece)).split())
                piece.clear()
                if text:
                    self.blocks.append(text)
                    while node.parent and node.tag not in CONTAINERS:
                        node = node.parent
                    node.own += max(0, len(text) - 2 * links)
            links = 0

        def close(number: int) -> None:
            while len(stack) > number:
                stack.pop().end = len(self.blocks)

        at = 0
        for m in _MARKUP.finditer(source):
            top = stack[-1]
            if m.start() > at and not top.dropped:
                part = source[at : m.start()]
                piece.append(part)
                if any(n.tag == "a" for n in stack[-3:]):
                    links += len(part.strip())
            at = m.end()
            tag = (m[3] or m[6] or "").lower()
            if not tag:
                continue
            if tag in BLOCKS:
                flush(top)
            elif tag in ("br", "td", "th"):
                piece.append(" ")
            if m[2] or m[5]:
                for number in range(len(stack) - 1, 0, -1):
                    if stack[number].tag == tag:
                        close(number)
                        break
                    if stack[number].tag in ("article", "main", "td") and tag not in BLOCKS:
                        break
                continue
            attributes = _attributes(m[4] or m[7] or "")
            if tag in BLOCKS and top.tag != "html":  # an open paragraph or item ends before a block
                for number in range(len(stack) - 1, 0, -1):
                    if stack[number].tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6") or stack[number].tag == tag == "li":
                        close(number)
                        break
                    if stack[number].tag in BLOCKS:
                        break
            if tag in VOID:
                continue
            top = stack[-1]
            path = top.path
            if tag in CONTAINERS or tag in BOILERPLATE_TAGS:
                path = f"{path}/{_step(tag, attributes)}"
            node = Node(tag, path, top, top.dropped or _is_boilerplate(tag, attributes, top), start=len(self.blocks))
            stack.append(node)
            if tag in CONTAINERS and not node.dropped:
                self.containers.append(node)
        if at < len(source) and not stack[-1].dropped:
            piece.append(source[at:])
        flush(stack[-1])
        close(1)
        root.end = len(self.blocks)
        self.root = root

    def best(self) -> Node:
        """The container with the highest score, or that around it with the rest; the whole page if there is none."""
        for node in reversed(self.containers):
            node.score += node.own * (1.5 if node.tag == "article" else 1)
            parent = node.parent
            while parent and parent.tag not in CONTAINERS:
                parent = parent.parent
            if parent:
                parent.score += node.score / 2
        return self._whole(max(self.containers, key=lambda n: n.score, default=self.root))

    def _whole(self, best: Node) -> Node:
        node: Node | None = best
        while node:
            if node.tag in ("article", "main"):
                return node
            node = node.parent
        while True:
            parent = best.parent
            while parent and parent.tag not in CONTAINERS:
                parent = parent.parent
            if parent is None or parent.tag == "body" or not parent.own:
                return best
            best = parent

    def text(self, path: str | None) -> str:
        """Text of the outermost containers at ``path``, or of the best container."""
        found = [n for n in self.containers if n.path == path] if path else []
        inside: list[str] = []
        end = 0
        for node in found or [self.best()]:
            if node.start >= end:
                inside += self.blocks[node.start : node.end]
                end = node.end
        return "\n\n".join(inside)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        hosts, paths, scores = [], [], []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            best = Page(source).best()
            if best.path and best.score > 0:
                hosts.append(host)
                paths.append(best.path)
                scores.append(1 + int(best.score).bit_length())
        yield pa.record_batch(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.int64())],
            ["host", "path", "votes"],
        )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [Page(s).text(p) if s else "" for s, p in zip(
            batch.column("html").to_pylist(), batch.column("path").to_pylist(), strict=True)]
        yield pa.record_batch(
            [batch.column("page_id"), batch.column("url"), pa.array(texts), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def host_paths(pages: DataFrame) -> DataFrame:
    """``host, path``: the path with most votes of each host of ``pages(host, html)``; ties by path."""
    votes = pages.filter("host <> '' and html <> ''").select("host", "html").mapInArrow(
        _votes, "host string, path string, votes bigint"
    )
    sums = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    return sums.groupBy("host").agg(F.min_by("path", F.struct(-F.col("votes"), "path")).alias("path"))


def main_texts(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"), host.alias("host"),
    )
    return rows.join(host_paths(rows), "host", "left").select("page_id", "url", "html", "path").mapInArrow(
        _texts, "page_id bigint, url string, text string, n_chars bigint"
    )
