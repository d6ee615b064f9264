"""Operator 7: main text of web pages by consensus paths of each host.

First pass: each page's containers are scored by the text of the blocks that
they hold, less their links, where what stands in an article, or beside text of
a container's own, counts for that as a whole; the score, as a share of the page, is a vote for
the container's generalised path (tags with classes, digits as ``#``).  Spark
sums the votes by host and path, so a host of any size is counted before it is
shuffled, and keeps the winner of each host.  Second pass: each page is read
again and the blocks below its host's winning path are its text; a page without
that path falls back on its own best container.

What goes before any scoring: menus, page headers, footers and the like by their
tag, hidden parts, and containers whose class or id says so.  A name counts by
its whole tokens: one that is made of such words only (``comments-area``) cuts
unless most of the page is in it, one that merely holds such a word
(``has-sidebar``) only where the part is small or mostly links.  Nothing cuts
html, body, main, the page's main articles, or what holds them, and the header
of an article is part of it.

Defined results: null or empty html gives an empty text; a null url counts as
the host "".  Repeated rows give a row each.  Only ``page_id``, ``url`` and
``html`` are read.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodfact.llm.common import checkpointed, slices

#: Winners of up to so many hosts are broadcast (about 100 bytes each); more are joined by shuffle.
BROADCAST_HOSTS = 100_000

CONTAINERS = frozenset("html body div section article main center table tbody tr td figure details ul ol dl blockquote "
                       "nav header footer aside form fieldset dialog menu".split())
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre figcaption summary caption th address hr legend".split())
#: Parts of an article that never are its whole, and what they don't count for.
PARTS, ROOTS = frozenset("ul ol dl blockquote figure".split()), frozenset(("html", "body"))
#: A container's own blocks have this share of its text at least if what else it holds belongs to them; for html and body.
OWN, ROOT_OWN = 0.02, 0.25
BOILERPLATE = frozenset("nav header footer aside form dialog menu fieldset".split())
#: Elements whose content is raw up to their end tag, or else to the end of the page.
RAW = "script|style|textarea|title"
#: Elements that go with all they hold if their end tag is there; of others only the tag goes.
DROPPED = frozenset("noscript template select button svg iframe object".split())
#: Words of a class or id token that speak of what isn't article text.
NAME_WORDS = frozenset("""ad ads banner cookie cookies consent notice notices alert popup modal sidebar side menu nav navbar navigation
    breadcrumb breadcrumbs header footer masthead comment comments replies disqus respond share sharing social related newsletter
    subscribe signup login search widget widgets toolbar pagination pager tag tags byline hidden""".split())
NAME_STEMS = ("advert", "sponsor", "promo", "recommend")
COMMENT_WORDS = frozenset("comment comments replies disqus respond".split())
HEAD_WORDS = frozenset("header masthead byline".split())
#: Words that may stand beside them in a token without changing its sense.
FRAME_WORDS = frozenset("""area list box block wrap wrapper container section posts post links link bar item items inner outer form button
    buttons icons left right top bottom main site page primary secondary global slot unit thread body entry row col column group""".split())
#: Steps of a path; containers further down count for the one at that depth.
DEEPEST = 64
#: A part of at least this share of the page's text is kept in spite of its name; a part named in passing goes up to this share.
MOST, LITTLE = 0.6, 0.1

# A tag ends at the next "<" at the latest, and quotes in it are taken whole: no stretch is scanned for many tags.
_INSIDE = r"(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+'){0,2000}+"
_PARTS = re.compile(rf"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<({RAW})(?=[\s/>]){_INSIDE}>.*?(?:</\1\s*>|$)|<[!?][^<>]*+>"
                    rf"|<(/?[a-zA-Z][a-zA-Z0-9:-]*+)({_INSIDE})>", re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_CLOSED = re.compile(r"(?:^|[\s\"'])/$")
_DIGITS = re.compile(r"\d+")


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").removeprefix("www.")
    except ValueError:
        return ""


def _words(token: str) -> list[str]:
    return [w for w in (w.rstrip("0123456789") for w in re.split(r"[-_]+", token.lower())) if w]


def _speaks(word: str) -> bool:
    return word in NAME_WORDS or word.startswith(NAME_STEMS)


@dataclass
class Node:
    """A container of the page: what its tag and attributes say, and the text below it."""
    tag: str
    step: str  # generalised step of the path
    parent: int
    hidden: bool
    strong: frozenset  # words of tokens that consist of such words only
    weak: bool  # some token holds such a word
    in_article: bool
    length: int = 0
    links: int = 0

    @property
    def weight(self) -> int:
        return max(0, self.length - 2 * self.links)


def _node(tag: str, attributes: str, parent: int, above: Node | None) -> Node:
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
    strong, weak = set(), False
    for token in f"{found.get('class', '')} {found.get('id', '')}".split():
        words = _words(token)
        named = [w for w in words if _speaks(w)]
        if named and all(w in FRAME_WORDS or _speaks(w) for w in words):
            strong.update(named)
        weak = weak or bool(named)
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "") \
        or found.get("role", "") in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog")
    first = ".".join(found.get("class", "").split()[:2])
    inside = above is not None and (above.in_article or above.tag in ("article", "main"))
    return Node(tag, _DIGITS.sub("#", f"{tag}.{first}" if first else tag), parent, hidden, frozenset(strong), weak, inside)


def _cut(nodes: list[Node], total: int) -> list[bool]:
    """For each container, whether it or one above it goes."""
    comment_above = [False] * len(nodes)
    for i, node in enumerate(nodes):
        comment_above[i] = bool(node.strong & COMMENT_WORDS) or (node.parent >= 0 and comment_above[node.parent])
    articles = [i for i, n in enumerate(nodes) if n.tag == "article" and not comment_above[i]]
    heaviest = max((nodes[i].weight for i in articles), default=0)
    kept = [n.tag in ("html", "body", "main") for n in nodes]
    for i in [i for i, n in enumerate(nodes) if n.tag == "main"] + [i for i in articles if 0 < heaviest <= 2 * nodes[i].weight]:
        while i >= 0:
            kept[i] = True
            i = nodes[i].parent
    gone: list[bool] = []
    for i, n in enumerate(nodes):
        most, linked = n.length >= MOST * total, 2 * n.links > n.length
        if kept[i]:
            bad = False
        elif n.hidden:
            bad = True
        elif n.tag in BOILERPLATE:
            bad = not (n.tag == "header" and n.in_article) and not (n.tag == "form" and most)
        elif n.tag == "article":
            bad = bool(n.strong & COMMENT_WORDS)
        elif n.strong:
            bad = not (n.in_article and n.strong <= HEAD_WORDS) and (bool(n.strong & COMMENT_WORDS) or not most)
        else:
            bad = n.weak and (linked or (not n.in_article and n.length <= LITTLE * total))
        gone.append(bad or (n.parent >= 0 and gone[n.parent]))
    return gone


def _parts(page: str) -> list[tuple[int, int, str, str]]:
    """(start, end, tag, attributes) of all markup in page order; an element that goes is one part without a tag."""
    found = [(m.start(), m.end(), (m[2] or "").lower(), m[3]) for m in _PARTS.finditer(page)]
    opened: dict[str, list[int]] = {}
    ends: dict[int, int] = {}
    for i, (_, _, tag, attributes) in enumerate(found):
        if tag in DROPPED and not _CLOSED.search(attributes):
            opened.setdefault(tag, []).append(i)
        elif tag[:1] == "/" and opened.get(tag[1:]):
            ends[opened[tag[1:]].pop()] = i
    if not ends:
        return found
    out, i = [], 0
    while i < len(found):
        last = ends.get(i, i)
        out.append(found[i] if last == i else (found[i][0], found[last][1], "", ""))
        i = last + 1
    return out


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    """(path of containers, text, characters in links) of each block outside boilerplate, in page order."""
    nodes: list[Node] = []
    stack: list[int] = []
    paths: list[tuple[str, ...]] = [()]  # of nothing, and of each container on the stack
    out: list[tuple[int, tuple[str, ...], str, int]] = []
    held: list[str] = []
    links, in_link, path = 0, False, ()

    def close() -> None:
        nonlocal links
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text:
                here = stack[-1] if stack else -1
                out.append((here, path, text, min(links, len(text))))
                if here >= 0:
                    nodes[here].length += len(text)
                    nodes[here].links += min(links, len(text))
        held.clear()
        links = 0

    at = 0
    for start, end, tag, attributes in _parts(page):
        if start > at:
            held.append(page[at:start])
            if in_link:
                links += start - at
        at = end
        if tag in CONTAINERS:
            close()
            above = stack[-1] if stack else -1
            nodes.append(_node(tag, attributes, above, nodes[above] if above >= 0 else None))
            stack.append(len(nodes) - 1)
            path = (*path, nodes[-1].step) if len(path) < DEEPEST else path
            paths.append(path)
            in_link = False
        elif tag[:1] == "/" and tag[1:] in CONTAINERS:
            close()
            depth = next((k for k in range(len(stack) - 1, -1, -1) if nodes[stack[k]].tag == tag[1:]), None)
            if depth is not None:
                del stack[depth:]
                del paths[depth + 1:]
                path = paths[-1]
            in_link = False
        elif tag.removeprefix("/") in BLOCKS:
            close()
            in_link = False
        elif tag == "br":
            held.append(" ")
        elif tag in ("a", "/a"):
            in_link = tag == "a"
    if at < len(page):
        held.append(page[at:])
    close()
    for node in reversed(nodes):  # a container stands before what it holds
        if node.parent >= 0:
            nodes[node.parent].length += node.length
            nodes[node.parent].links += node.links
    gone = _cut(nodes, sum(len(text) for _, _, text, _ in out))
    return [(path, text, links) for here, path, text, links in out if here < 0 or not gone[here]]


def holders(own: dict[tuple[str, ...], float]) -> dict[tuple[str, ...], tuple[str, ...]]:
    """Path of a container with blocks -> path of the container that they count for.

    That is the article (or else main) around it, or the outermost container
    with text beside it; a list, quotation or figure counts for what is above.
    """
    below: dict[tuple[str, ...], float] = {}
    for path, weight in own.items():
        for depth in range(1, len(path) + 1):
            below[path[:depth]] = below.get(path[:depth], 0.0) + weight
    out = {}
    for path in own:
        tags = [step.partition(".")[0] for step in path]
        depth = len(path)
        for tag in ("article", "main"):
            if tag in tags:
                depth -= tags[::-1].index(tag)
                break
        for k in range(1, depth):
            mine = own.get(path[:k], 0.0)
            if mine > 0 and mine >= (ROOT_OWN if tags[k - 1] in ROOTS else OWN) * below[path[:k]]:
                depth = k
                break
        while depth > 1 and tags[depth - 1] in PARTS and tags[depth - 2] not in ROOTS:
            depth -= 1
        out[path] = path[:depth]
    return out


def scores(found: list[tuple[tuple[str, ...], str, int]]) -> dict[str, float]:
    """Path -> share of the page's score: a block counts for its container, half for the next one above, and so on."""
    own: dict[tuple[str, ...], float] = {}
    for path, text, links in found:
        own[path] = own.get(path, 0.0) + max(0, len(text) - 2 * links)
    held = holders(own)
    out: dict[str, float] = {}
    for path, weight in own.items():
        path = held[path]
        for depth in range(len(path), max(len(path) - 3, 0), -1):
            key = "/".join(path[:depth])
            out[key] = out.get(key, 0.0) + weight
            weight /= 2
    total = sum(out.values())
    return {k: v / total for k, v in out.items() if v > 0} if total else {}


def main_text(page: str, winner: str | None) -> str:
    found = blocks(page)
    if winner is not None:
        inside = _below(found, winner)
        if inside:
            return "\n\n".join(inside)
    own = scores(found)
    if not own:
        return "\n\n".join(text for _, text, links in found if 2 * links < len(text))
    return "\n\n".join(_below(found, min(own, key=lambda k: (-own[k], k))))


def _below(found: list, winner: str) -> list[str]:
    steps = tuple(winner.split("/"))
    return [text for path, text, _ in found if path[:len(steps)] == steps]


def votes(pages: DataFrame) -> DataFrame:
    """host, path, weight: summed within each batch already."""
    def run(batches):
        for batch in slices(batches, 1024):
            total: dict[tuple[str, str], float] = {}
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                host = host_of(url)
                for path, share in scores(blocks(page or "")).items():
                    total[host, path] = total.get((host, path), 0.0) + share
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in total], pa.string()), pa.array([p for _, p in total], pa.string()),
                 pa.array(total.values(), pa.float64())], names=["host", "path", "weight"])

    return pages.select("url", "html").mapInArrow(run, "host string, path string, weight double")


def winners(pages: DataFrame) -> DataFrame:
    """host, path: the path of most votes (of equals the first by name)."""
    summed = votes(pages).groupBy("host", "path").agg(F.round(F.sum("weight"), 6).alias("weight"))
    return summed.groupBy("host").agg(F.min_by("path", F.struct(-F.col("weight"), F.col("path"))).alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    def hosts(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([host_of(u) for u in batch.column(1).to_pylist()], pa.string())],
                names=["page_id", "url", "html", "host"])

    def run(batches):
        for batch in slices(batches):
            texts = [main_text(page or "", path) for page, path in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    best = checkpointed(winners(pages))
    if best.count() <= BROADCAST_HOSTS:
        best = F.broadcast(best)
    rows = pages.select("page_id", "url", "html").mapInArrow(
        hosts, f"page_id {dict(pages.dtypes)['page_id']}, url string, html string, host string")
    return rows.join(best, "host", "left").select("page_id", "url", "html", "path").mapInArrow(
        run, f"page_id {dict(pages.dtypes)['page_id']}, url string, text string, n_chars long")
