"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to their ancestors, discounted by the share of link text: all to the
parent, half to the grandparent, a third of what came from below at each level beyond. The container with the most
points, and siblings of it that score near it, are the article; an `article` element around the best container stands
for it. Elements that never hold article text by their tag or role (menus, footers, sidebars, scripts, hidden ones) are
left out beforehand.

Words in class or id (`sidebar`, `comments`, `share`) and forms only weigh: they lower the points that pass through an
element. The container with the most points so weighed is the core, and no element around it is left out, whatever its
words. Elsewhere a suspicious element goes, unless it has the class of one around the core; those inside the core go if
they are mostly links, or unless they hold nearly all of its text (half of it where the word is only part of a longer
class). Then the rest is scored once more.

Scale: a page is one row and one call, linear in its length, as points rise from children to parents once; Arrow
batches stream through without a shuffle.

Defined results: null and blank html give empty text; cut-off pages end where they end; unclosed elements close with
their parents; repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from metricloom.llm.common import text_of

# Kinds of HTML elements, and words in class or id that mark what is not the article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
LEFT_OUT = set(
    "script style noscript template head title nav footer aside button select textarea input iframe object embed "
    "svg canvas audio video menu dialog noembed noframes xmp".split()
)
LEFT_OUT_WORDS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs header footer masthead comment comments disqus reply replies cookie cookies consent "
    "gdpr notice notices alert popup modal overlay subscribe subscription newsletter signup login share sharing social "
    "related recommended widget toolbar pagination pager hidden".split()
)
LEFT_OUT_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
TITLE_OF = {"article", "post", "entry", "story"}
ITEMS = set("p pre li td blockquote h1 h2 h3 h4 h5 h6".split())
NAMED, ALLUDED = 0.1, 0.5  # weights of elements with such a word as a whole class or id, and inside a longer one
LINKS = 0.5  # share of link text that marks a list of links
MOST_NAMED, MOST = 0.9, 0.5  # shares of the core's text above which such elements are no by-matter
FOR_TEXT = {"article", "content", "post", "entry", "story", "main", "text", "body"}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>|</?[a-zA-Z][^>]*(?:>|\Z)""", re.S)
_MARKED = re.compile(r"""(?:^|[\s"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_LISTS = {"ul", "ol", "dl", "table", "select"}


class Node:
    __slots__ = ("tag", "marks", "parent", "parts", "score", "in_article", "out", "gone", "chars", "linked", "direct", "near", "far", "full")

    def __init__(self, tag: str, attributes: str = "", parent: "Node | None" = None):
        self.tag, self.parent, self.parts = tag, parent, []
        self.marks = {m[0].lower(): (m[1] or "").strip("\"'").lower() for m in _MARKED.findall(attributes)} if attributes else {}
        self.in_article = parent is not None and (parent.in_article or parent.tag == "article")
        self.out, self.gone = self.never_article(), False

    def tokens(self) -> list[str]:
        return f"{self.marks.get('class', '')} {self.marks.get('id', '')}".split()

    def words(self) -> set[str]:
        return set(_WORD.findall(" ".join(self.tokens())))

    def never_article(self) -> bool:
        if self.tag in ("html", "body", "main"):
            return False
        m = self.marks
        if self.tag in LEFT_OUT or m.get("role") in LEFT_OUT_ROLES or "hidden" in m or m.get("aria-hidden") == "true":
            return True
        if re.search(r"display\s*:\s*none", m.get("style", "")):
            return True
        return self.tag == "header" and not self.in_article

    def weight(self) -> float:
        return 1.0 if not self.suspicious() else NAMED if LEFT_OUT_WORDS & set(self.tokens()) else ALLUDED

    def suspicious(self, known: set[str] = frozenset()) -> bool:
        """A form, or words of what is no article in a class or id that is not among the `known` ones."""
        if self.tag in ("html", "body", "main"):
            return False
        if self.tag == "form" or self.marks.get("role") == "form":
            return True
        bad = {w for t in self.tokens() if t not in known for w in _WORD.findall(t)} & LEFT_OUT_WORDS
        return bool(bad) and not (bad == {"header"} and (self.in_article or self.words() & TITLE_OF))


def parse(page: str) -> list[Node]:
    """Elements, parents before children, the root first; parts of a node are nodes and raw strings in page order."""
    root = here = Node("html")
    nodes, at = [root], 0
    while m := _TAG.search(page, at):
        if m.start() > at:
            here.parts.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            up = here
            while up is not None and up.tag != tag and (tag in BLOCK or up.tag not in BLOCK):
                up = up.parent
            if up is not None and up.tag == tag and up.parent is not None:
                here = up.parent
            continue
        if tag in BLOCK:  # it ends an open paragraph, an item ends the one before
            ends, up = _CLOSES.get(tag, set()) | {"p"}, here
            while up is not None and up.tag not in ends and (up.tag not in BLOCK or up.tag in _CLOSES and tag in _CLOSES) and up.tag not in _LISTS:
                up = up.parent
            if up is not None and up.tag in ends and up.parent is not None:
                here = up.parent
        if tag in ("html", "body"):
            continue
        node = Node(tag, m[3], here)
        here.parts.append(node)
        nodes.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not m[3].endswith("/"):
            here = node
    if at < len(page):
        here.parts.append(page[at:])
    return nodes


def blocks(node: Node) -> Iterator[tuple[Node, str, int]]:
    """(block element, its text, characters of it in links) in page order, without what is left out."""
    pieces: list[str] = []
    linked = 0
    owner = node
    stack: list[tuple[Node, int, bool, bool]] = [(node, 0, False, False)]

    def flush() -> Iterator[tuple[Node, str, int]]:
        nonlocal pieces, linked
        text = " ".join("".join(pieces).split())
        if text:
            yield owner, text, linked
        pieces, linked = [], 0

    while stack:
        here, k, in_link, _ = stack.pop()
        if k == 0 and here.tag in BLOCK:
            yield from flush()
            owner = here
        while k < len(here.parts):
            part = here.parts[k]
            k += 1
            if isinstance(part, str):
                text = html.unescape(part)
                pieces.append(text)
                linked += len(text.strip()) if in_link else 0
            elif part.tag == "br":
                pieces.append(" ")
            elif not part.out and not part.gone:
                stack.append((here, k, in_link, False))
                stack.append((part, 0, in_link or part.tag == "a", False))
                break
        else:
            if here.tag in BLOCK:
                yield from flush()
                owner = here.parent or here
                while owner.parent is not None and owner.tag not in BLOCK:
                    owner = owner.parent


def score(nodes: list[Node], found: list[tuple[Node, str, int]], weigh: bool) -> None:
    """Points of every node, children before parents; `weigh` lowers those of suspicious elements."""
    for n in nodes:
        n.direct = n.near = n.far = 0.0
        n.full = False
    for owner, text, linked in found:
        holder = owner if owner.tag not in ITEMS or owner.parent is None else owner.parent
        holder.direct += (min(len(text) / 100, 3.0) + text.count(",") + (len(text) >= 25)) * (1 - min(1.0, linked / len(text)))
        holder.full = True
    for n in reversed(nodes):
        weight = n.weight() if weigh and n.full else 1.0
        n.score = (n.direct + n.near + n.far) * weight
        if n.parent is not None:
            n.parent.near += n.direct * weight / 2
            n.parent.far += (n.near + n.far) * weight / 3
            n.parent.full |= n.full


def measure(nodes: list[Node]) -> None:
    """Characters of text outside links, and inside them, below every node."""
    for n in nodes:
        n.chars = n.linked = 0
    inside: dict[int, bool] = {}
    for n in nodes:
        inside[id(n)] = link = n.tag == "a" or n.parent is not None and inside[id(n.parent)]
        size = sum(len(html.unescape(p).strip()) for p in n.parts if isinstance(p, str))
        if link:
            n.linked = size
        else:
            n.chars = size
    for n in reversed(nodes):
        if n.out:
            n.chars = n.linked = 0
        elif n.parent is not None:
            n.parent.chars += n.chars
            n.parent.linked += n.linked


def leave_out(nodes: list[Node], core: Node) -> None:
    """Marks the suspicious elements that go."""
    around, up = set(), core
    known: set[str] = set()
    while up is not None:
        around.add(id(up))
        known |= {*up.tokens()}
        up = up.parent
    inside: dict[int, bool] = {}
    held: dict[int, bool] = {}  # inside an element that is on the list already
    inner = []
    for n in nodes:
        above = n.parent is not None and held[id(n.parent)]
        inside[id(n)] = n is core or n.parent is not None and inside[id(n.parent)]
        held[id(n)] = above
        if above or id(n) in around or not n.suspicious(known):
            continue
        held[id(n)] = True
        if inside[id(n)] and n.linked <= (n.chars + n.linked) * LINKS:
            inner.append(n)
        else:
            n.gone = True
    rest = core.chars
    for kind, most in ((NAMED, MOST_NAMED), (ALLUDED, MOST)):
        some = [n for n in inner if n.weight() == kind]
        size = sum(n.chars for n in some)
        if size <= rest * most:
            rest -= size
            for n in some:
                n.gone = True


def main_text(page: str) -> str:
    nodes = parse(page)
    found = list(blocks(nodes[0]))
    if any(n.suspicious() for n in nodes):
        score(nodes, found, weigh=True)
        measure(nodes)
        leave_out(nodes, max(nodes, key=lambda n: n.score))
        found = list(blocks(nodes[0]))
    score(nodes, found, weigh=False)
    for n in nodes:
        n.score += 25.0 * (n.full and (n.tag in ("article", "main") or bool(n.words() & FOR_TEXT)))
    full = [n for n in nodes if n.full]
    if not full:
        return ""
    best = max(full, key=lambda n: n.score)
    around = best
    while around is not None and around.tag != "article":
        around = around.parent
    if around is not None:
        kept = {id(around)}
    else:
        enough = max(10.0, best.score * 0.2)
        near = [p for p in best.parent.parts if isinstance(p, Node)] if best.parent is not None else []
        kept = {id(best)} | {id(n) for n in near if n.tag == "h1" or n.full and n.score >= enough or n.tag == "p" and not n.out}
    for n in nodes:
        if n.parent is not None and id(n.parent) in kept:
            kept.add(id(n))
    return "\n".join(text for owner, text, _ in found if id(owner) in kept)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x) for x in batch.column(2).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["page_id", "url", "text"])

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), text_of(page).alias("h"))
    return rows.mapInArrow(run, "page_id long, url string, text string")
