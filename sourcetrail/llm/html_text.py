"""Main text of web pages by consensus paths of their hosts.

Each page scores its containers by the text of their paragraphs; the best one votes with its generalised path (tags and
classes from the root, numbers removed).  Votes are summed per host in Spark, and every page is extracted again with the
path that won on its host; pages without that path fall back on their own best container.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sourcetrail.llm.redirects import host_of
from sourcetrail.llm.tables import ship, written

_PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s\"'=<>/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title svg iframe object select".split())
_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th"
    " thead tr ul".split()
)
_CONTAINER = frozenset("article main section div td body".split())
_DROPPED = frozenset("nav aside footer button menu dialog head fieldset".split())
#: Elements that are the article or hold it, whatever their class says.
_WHOLE = frozenset("html body main article".split())
#: Beginnings of a class that says how a page is laid out, or that belongs to the article.
_LAYOUT, _OWN = ("with", "no", "has", "without"), ("entry", "post", "article", "story", "content")
#: A page of which so little text is left without its doubtful elements has its text in one of them.
_LITTLE = 0.05
#: Whole words in a class, id or role that mark what is not the article.
_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer dropdown"
    " footer gdpr header hidden legal masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo"
    " promotion recommended related reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe tags"
    " toolbar widget".split()
)
#: Of these, what no text of an article stands in, however much it holds.
_FIRM = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies gdpr menu nav navbar"
    " navigation newsletter pagination pager reply replies respond signup".split()
)
_WORDS = re.compile(r"[a-z]+")
#: What a start tag closes, if open: li closes li, and so on.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = frozenset("ul ol dl table body html article div section".split())


@dataclass
class Block:
    """A run of text within one block element: its text, the characters in links, the open containers around it, and the
    open elements that are doubtful: their class, or their being a form, says that they are not part of an article."""

    text: str
    linked: int
    around: tuple[int, ...]
    dropped: bool
    doubtful: tuple[int, ...] = ()

    def worth(self) -> float:
        return max(0.0, len(self.text) - 2.0 * self.linked)


@dataclass
class Page:
    """Containers by number: their paths, the articles or mains, the containers around each."""

    paths: list[str] = field(default_factory=list)
    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    #: doubtful elements that hold an article or a main, and those that hold nothing of one unless they do
    cleared: set[int] = field(default_factory=set)
    firm: set[int] = field(default_factory=set)

    def settle(self) -> Page:
        """Drop the blocks in doubtful elements, but for those that hold the article: an article or main element, or
        nearly all text there is."""
        worth: dict[int, float] = {}
        total = left = 0.0
        for b in self.blocks:
            if not b.dropped:
                open_doubts = [i for i in b.doubtful if i not in self.cleared]
                total += b.worth()
                left += 0.0 if open_doubts else b.worth()
                for i in open_doubts if self.firm.isdisjoint(open_doubts) else ():
                    worth[i] = worth.get(i, 0.0) + b.worth()
        while worth and left <= _LITTLE * total and max(worth.values()) > left:
            best = max(worth, key=lambda i: (worth[i], -i))  # the outermost of those that hold the same
            left += worth.pop(best)
            self.cleared.add(best)
            for i in worth:  # what holds it, or lies within it, keeps its own doubt
                worth[i] = sum(b.worth() for b in self.blocks if not b.dropped and i in b.doubtful and best in b.doubtful)
            worth = {i: w for i, w in worth.items() if w and left <= _LITTLE * total}
        for b in self.blocks:
            b.dropped = b.dropped or any(i not in self.cleared for i in b.doubtful)
        return self


def _names(text: str, within: bool) -> set[str]:
    """Words of classes, ids or roles that speak of what an element is; within an article a header is its own."""
    found: set[str] = set()
    for token in text.lower().split():
        words = _WORDS.findall(token)
        if words and not (len(words) > 1 and words[0] in _LAYOUT):
            found.update(w for w in words if w != "header" or not (within or words[0] in _OWN))
    return found


def _label(tag: str, attributes: str, within: bool) -> tuple[str, bool, bool, bool]:
    """Generalised step of a path, whether the element is not part of an article, whether that is doubtful, and firmly so."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
    classes = sorted({re.sub(r"\d+", "", c.lower()) for c in found.get("class", "").split()} - {""})
    names = _names(f"{found.get('class', '')} {found.get('id', '')} {found.get('role', '')}", within)
    hidden = "hidden" in attributes.lower().split() or "display:none" in found.get("style", "").replace(" ", "").lower()
    doubtful = tag not in _WHOLE and (tag == "form" or bool(names & _NAMES))
    return ".".join([tag, *classes]), tag in _DROPPED or hidden, doubtful, bool(names & _FIRM)


def parse(source: str | None) -> Page:
    """Blocks of text in page order.  Unclosed and stray tags, raw texts and comments are dealt with as browsers do."""
    page, text = Page(), source or ""
    stack: list[tuple[str, str, bool, int, int]] = []  # tag, path, dropped, number of the container or -1, of the doubt or -1
    doubts = 0
    parts: list[str] = []
    linked, links_open, end, at = 0, 0, len(text), 0

    def flush() -> None:
        nonlocal linked
        if parts:
            words = " ".join(html.unescape("".join(parts)).split())
            if words:
                around = tuple(x[3] for x in stack if x[3] >= 0)
                doubtful = tuple(x[4] for x in stack if x[4] >= 0)
                page.blocks.append(Block(words, linked, around, any(x[2] for x in stack), doubtful))
            parts.clear()
        linked = 0

    def close(to: int) -> None:
        """Closes the elements from number `to` of the stack on."""
        nonlocal links_open
        if any(x[0] in _BLOCK for x in stack[to:]):
            flush()
        links_open -= sum(x[0] == "a" for x in stack[to:])
        del stack[to:]

    while at < end:
        m = _PIECE.search(text, at)
        piece = text[at : m.start() if m else end]
        if piece:
            parts.append(piece)
            if links_open:
                linked += len(piece)
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            opened = [i for i, x in enumerate(stack) if x[0] == tag]
            if opened:
                close(opened[-1])
            elif tag in _BLOCK:
                flush()
            continue
        if tag in _RAW:
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(text, at)
            at = stop.end() if stop else end
            parts.append(" ")
            continue
        if tag in _VOID:
            parts.append(" ")
            if tag == "hr":
                flush()
            continue
        if tag in _BLOCK:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] in _BLOCK:
                    break
        if tag in _CLOSES:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in _CLOSES[tag]:
                    close(i)
                    break
                if stack[i][0] in _SCOPES:
                    break
        if m[3].endswith("/") and tag not in _BLOCK:
            continue
        if tag in _BLOCK:
            flush()
        within = any(x[0] in ("article", "main") for x in stack)
        step, dropped, doubtful, firm = _label(tag, m[3], within)
        dropped = dropped or (tag == "header" and not within)
        if tag in ("article", "main") and not within:
            page.cleared.update(x[4] for x in stack)
        path = f"{stack[-1][1]}>{step}" if stack and tag in _BLOCK else stack[-1][1] if stack else step
        number = -1
        if tag in _CONTAINER:
            number = len(page.paths)
            page.paths.append(path)
            page.tags.append(tag)
            page.parents.append(next((x[3] for x in reversed(stack) if x[3] >= 0), -1))
        stack.append((tag, path, dropped, number, doubts if doubtful else -1))
        if doubtful and firm:
            page.firm.add(doubts)
        doubts += doubtful
        links_open += tag == "a"
    flush()
    return page.settle()


def best_container(page: Page) -> int:
    """Number of the container with most paragraph text outside links: all of it counts for the nearest container, half
    for each one further out; -1 without text."""
    scores: dict[int, float] = {}
    for b in page.blocks:
        if b.dropped:
            continue
        worth = b.worth()
        for number in reversed(b.around):
            scores[number] = scores.get(number, 0.0) + worth
            worth /= 2
    return max(scores, key=lambda i: (scores[i], i)) if scores else -1


def whole_of(page: Page, number: int) -> int:
    """The outermost article around a container, else the main around it, else the container itself."""
    around, found = number, {}
    while around >= 0:
        found[page.tags[around]] = around
        around = page.parents[around]
    return found.get("article", found.get("main", number))


def extract(page: Page, path: str | None) -> str:
    """Text of the containers with the path, of the page's own best container where there is none.

    A container within an article or main stands for all of it.  Elsewhere the text that stands beside it, directly in the
    container around it and not mostly links, belongs to it too."""
    chosen = {i for i, p in enumerate(page.paths) if p == path} if path else set()
    if not any(not b.dropped and chosen.intersection(b.around) for b in page.blocks):
        chosen = {best_container(page)} - {-1}
    whole = {whole_of(page, i) for i in chosen}
    beside = {page.parents[i] for i in whole if page.tags[i] not in ("article", "main", "body")} - {-1}

    def belongs(b: Block) -> bool:
        if not chosen:
            return not b.around
        return bool(whole.intersection(b.around)) or (b.around[-1:] and b.around[-1] in beside and 2 * b.linked <= len(b.text))

    return "\n".join(b.text for b in page.blocks if not b.dropped and belongs(b))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            hosts, paths, sizes = [], [], []
            part = batch.slice(at, 500)
            for host, source in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                page = parse(source)
                best = best_container(page)
                if best >= 0:
                    hosts.append(host)
                    paths.append(page.paths[best])
                    sizes.append(sum(len(b.text) for b in page.blocks if best in b.around))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["host", "path", "size"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts = [extract(parse(s), p) for s, p in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), part.column(3)], names=["page_id", "url", "text", "path"])


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text (the main text; empty if there is none) and path (the host's winning path or null) of every row.

    pages: page_id, url, html; other columns are ignored.  Null html has no text; pages without a host vote together; of
    paths with equally many votes the one with more text wins, then the first by name; repeated rows stay repeated.
    """
    ship(pages.sparkSession)
    host = F.coalesce(host_of(F.col("url")), F.lit(""))
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    votes = pages.select(host.alias("host"), "html").mapInArrow(_votes, "host string, path string, size long")
    votes = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("size").alias("size"))
    best = votes.groupBy("host").agg(F.min_by("path", F.struct(-F.col("votes"), -F.col("size"), "path")).alias("path"))
    best = written(best.withColumnRenamed("host", "at_host"), "host-paths")
    chosen = pages.withColumn("at_host", host).join(best, "at_host", "left").select("page_id", "url", "html", "path")
    return chosen.mapInArrow(_texts, "page_id long, url string, text string, path string")
