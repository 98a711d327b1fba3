"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to the elements around them; each element's points are discounted by
the share of its text that stands in links; the best one is kept with those of its siblings that score well too.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medley.llm.grouped import mapped, parts

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>?|<[!?/][^>]*+>?""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)|(?=[\s/>]|$))""", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg iframe object canvas textarea title select xmp".split())
FOREIGN = frozenset("svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {  # a start tag ends an open element of these kinds, up to the nearest of the containers
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"),
    "th": ("td th", "tr table"), "option": ("option", "select"), "body": ("head", "html"),
}
DROPPED_TAGS = frozenset("head nav header footer aside form button menu dialog label fieldset input script style annotation annotation-xml".split())
WRAPPERS = frozenset("form fieldset aside dialog".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
DROPPED_NAMES = frozenset(
    "ad ads adv advert advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright "
    "disclaimer disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay "
    "pager pagination popup promo promotion recommended related replies reply respond rss search share sharing shoutbox sidebar signup skip "
    "social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets".split()
)
SECOND_NAMES = frozenset("discussion opinions responses".split())
# what may stand inside or beside an article as an article element of its own
OTHER_ARTICLES = frozenset("comment comments promo recommended related replies reply response responses sponsored teaser teasers".split())
# a name that begins so tells what the element has or is filed under, not what it is
ABOUT = frozenset("category format has is js no show status tag type with without".split())
TITLED = frozenset("header heading title".split())
KEPT_NAMES = frozenset("article body column content entry main page post story text".split())
KEPT_TAGS = frozenset("html body article main".split())
BONUS = {"article": 10, "main": 8, "div": 3, "section": 3, "pre": 2, "blockquote": 2, "ul": -3, "ol": -3, "dl": -3}
PARAGRAPHS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 li dt dd td th tr caption figcaption".split())
SHARES = (1, 2, 6, 9, 12)


class Node:
    """An element with its pieces of text and elements in order, and what scoring finds out about it."""

    __slots__ = ("tag", "dropped", "wrapper", "parent", "block", "children", "points", "chars", "linked", "kept", "menu")

    def __init__(self, tag: str, attributes: str, parent: Node | None) -> None:
        self.tag, self.parent, self.children = tag, parent, []
        self.block = self if tag in BLOCK or parent is None else parent.block
        self.points, self.chars, self.linked, self.kept, self.menu = 0.0, 0, 0, False, False
        found = {k.lower(): (v or "").strip("\"'").strip().lower() for k, v in ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
        self.dropped = tag in DROPPED_TAGS or (other_article(found) if tag == "article" else tag not in KEPT_TAGS and unwanted(found))
        self.wrapper = self.dropped and (tag not in DROPPED_TAGS or tag in WRAPPERS) and not hidden(found)


def hidden(found: dict[str, str]) -> bool:
    """Whether attributes hide an element."""
    return "hidden" in found or found.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "")))


def unwanted(found: dict[str, str]) -> bool:
    """Whether attributes mark an element as hidden or as something other than the article."""
    if not found:
        return False
    if hidden(found):
        return True
    if set(found.get("role", "").split()) & DROPPED_ROLES:
        return True
    names = (found.get("class", "") + " " + found.get("id", "")).split()
    if any(n in DROPPED_NAMES or n in SECOND_NAMES for n in names):
        return True
    compounds = [[p for p in re.split(r"[-_:0-9]+", n) if p] for n in names]
    parts = {p for c in compounds for p in c}
    if parts & (DROPPED_NAMES | SECOND_NAMES) and not parts & KEPT_NAMES:
        return True
    # of a compound with a word of either kind the last word says what it is: comments of a post, the sidebar of the content
    return any(c[-1] in (DROPPED_NAMES | SECOND_NAMES) - TITLED and c[0] not in ABOUT and set(c) & KEPT_NAMES for c in compounds if len(c) > 1)


def other_article(found: dict[str, str]) -> bool:
    """Whether attributes mark an article element as a comment or teaser, or hide it."""
    if not found:
        return False
    names = (found.get("class", "") + " " + found.get("id", "")).split()
    return hidden(found) or found.get("role") == "comment" or any(re.sub(r"[-_0-9]+$", "", n) in OTHER_ARTICLES for n in names)


def _nearest(top: Node, kinds: str, stop: str) -> Node | None:
    while top.parent is not None and top.tag not in stop.split():
        if top.tag in kinds.split():
            return top
        top = top.parent
    return None


def parse(page: str) -> list[Node]:
    """The page's elements, each after the one around it; missing and stray end tags are mended as far as blocks need it."""
    root = Node("html", "", None)
    nodes, top, at, size = [root], root, 0, len(page)
    open_tags: Counter[str] = Counter()

    def close(last: Node) -> Node:
        node = top
        while node is not last:
            open_tags[node.tag] -= 1
            node = node.parent
        open_tags[last.tag] -= 1
        return last.parent

    while at < size:
        found = TAG.search(page, at)
        if not found:
            top.children.append(page[at:])
            break
        if found.start() > at:
            top.children.append(page[at : found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if found[1] or found[4]:
            if open_tags[tag]:
                last = top
                while last.tag != tag:
                    last = last.parent
                top = close(last)
            continue
        if tag in FOREIGN and (found[3] or found[6] or "").endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            if end is not None:
                at = end.end()
            elif tag not in FOREIGN:
                at = size
            continue
        for kinds, stop in ([("p", "table td th button caption")] if tag in BLOCK else []) + ([CLOSES[tag]] if tag in CLOSES else []):
            if any(open_tags[k] for k in kinds.split()) and (last := _nearest(top, kinds, stop)):
                top = close(last)
        node = Node(tag, found[3] or found[6] or "", top)
        nodes.append(node)
        top.children.append(node)
        if tag not in VOID:
            open_tags[tag] += 1
            top = node
    return nodes


def walk(root: Node) -> Iterator[tuple[Node, str | Node | None]]:
    """(parent, piece) in page order without dropped elements; piece None says that the element has ended."""
    stack: list[tuple[Node, int]] = [(root, 0)]
    while stack:
        node, k = stack.pop()
        if k == len(node.children):
            yield node, None
            continue
        stack.append((node, k + 1))
        child = node.children[k]
        if isinstance(child, str):
            yield node, child
        elif not child.dropped:
            yield node, child
            stack.append((child, 0))


def blocks(root: Node) -> Iterator[tuple[Node, str, int]]:
    """Element, text and characters in links of every block: text between two starts or ends of block elements.

    A line break counts as white space inside its block.
    """
    parts: list[str] = []
    linked, depth, holder = 0, 0, root

    def flush() -> Iterator[tuple[Node, str, int]]:
        text = " ".join(references.unescape("".join(parts)).split())
        if text:
            yield holder, text, min(linked, len(text))
        parts.clear()

    for node, piece in walk(root):
        if isinstance(piece, str):
            if not parts:
                holder, linked = node, 0
            parts.append(piece)
            linked += len(" ".join(piece.split())) if depth else 0
        elif piece is None:
            depth -= node.tag == "a"
            if node.tag in BLOCK:
                yield from flush()
        elif piece.tag in BLOCK:
            yield from flush()
        else:
            depth += piece.tag == "a"
            if piece.tag == "br" and parts:
                parts.append("\n")
    yield from flush()


def main_text(page: str | None) -> str:
    """The article's blocks joined by line ends; empty if the page has none.

    If no sentence is found, wrappers that hold most of the page's text are opened, from the outermost on.
    """
    if not page:
        return ""
    nodes = parse(page)
    first, well = article(nodes)
    text, around, opened = first, [] if well else wrappers(nodes), 0
    while not well and opened < len(around):
        for node in around[opened : 2 * opened + 1]:
            node.dropped = False
        opened = 2 * opened + 1
        for node in nodes:
            node.points, node.chars, node.linked, node.kept, node.menu = 0.0, 0, 0, False, False
        text, well = article(nodes)
    return text if well else first


def wrappers(nodes: list[Node]) -> list[Node]:
    """Elements dropped by name, role or kind, not hidden, that hold more than half of the page's text; the outer ones first."""
    held: Counter[Node] = Counter()
    for node in reversed(nodes):
        held[node] += sum(len(" ".join(piece.split())) for piece in node.children if isinstance(piece, str))
        if node.parent is not None and (node.wrapper or not node.dropped):
            held[node.parent] += held[node]
    inside = {nodes[0]}
    for node in nodes[1:]:
        if node.parent in inside and 2 * held[node] > held[nodes[0]] and (node.wrapper or not node.dropped):
            inside.add(node)
    return [node for node in nodes if node in inside and node.wrapper]


def article(nodes: list[Node]) -> tuple[str, bool]:
    """Text of the best container, and whether any block of it is a sentence: 25 characters, fewer than half of them in links."""
    found = [(node.block, text, linked) for node, text, linked in blocks(nodes[0])]
    if not found:
        return "", False
    for node, text, linked in found:
        node.chars += len(text)
        node.linked += linked
        points = ((1.0 if len(text) >= 25 else 0.2) + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / len(text))
        around = node
        while around.tag in PARAGRAPHS and around.parent is not None:
            around = around.parent
        for share in SHARES:
            around.points += points / share
            if around.parent is None:
                break
            around = around.parent
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
    scored = [node for node in nodes if node.points]
    for node in scored:
        node.points = max(0.0, node.points + BONUS.get(node.tag, 0)) * (1 - node.linked / max(1, node.chars))
    best = max(scored or nodes, key=lambda n: n.points)  # of equal ones the first in page order
    whole: Node | None = best
    while whole is not None and whole.tag not in ("article", "main"):
        whole = whole.parent
    best = whole or best
    best.kept = True
    for sibling in best.parent.children if best.parent is not None else ():
        if isinstance(sibling, Node) and not sibling.dropped and sibling.chars and sibling.tag in BLOCK:
            density = sibling.linked / sibling.chars
            good = sibling.points >= max(10.0, best.points * 0.2) and density < 0.5
            plain = sibling.tag == "p" and ((sibling.chars > 80 and density < 0.25) or (not density and sibling.chars >= 25))
            sibling.kept |= good or plain
    for node in nodes[1:]:
        if not node.kept:  # a list or table inside the article that is mostly links is a menu
            node.menu = node.parent.menu or (node.tag in ("ul", "ol", "dl", "table") and node.linked > node.chars / 2)
            node.kept = node.parent.kept
    chosen = [(text, linked) for node, text, linked in found if node.kept and not node.menu]
    return "\n".join(text for text, _ in chosen), any(len(text) >= 25 and 2 * linked < len(text) for text, linked in chosen)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches):
        texts = [main_text(page.as_py()) for page in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of (page_id, url, html).

    The text is the article's blocks in page order, one a line, with character references decoded and runs of white space
    as one space; formulas count as text. Menus, headers, footers, asides, notices, adverts, forms, hidden parts, scripts, styles and comments are
    left out by element, role, class and id; a list or table that is mostly links is a menu. If the best container stands
    in an article or main element, all of that is the article. Null, empty and textless pages give an empty text. Every
    row gets a row, repeated ids and null urls included.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return mapped(rows, _extract, "page_id long, url string, text string, n_chars long")
