"""Main text of web pages by scoring the element tree.

Paragraphs pass points for their length and commas to the elements around them, halved on
every level; an element's points are discounted by the share of its text that is links. The
best container is kept with the siblings that look like it. Elements that are no prose by their name, and readers'
comments, are left out before; what is no prose by its class (menus, notices, adverts ...) or a form is left out unless the
best text is in it.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from folioflow.llm.common import map_columns

# Elements by role.
SKIPPED = frozenset(
    "script style noscript template head title nav aside footer header button select textarea input label "
    "option iframe object embed applet svg canvas math audio video map dialog menu".split()
)
RAW = frozenset("script style noscript template textarea title iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article blockquote body br caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html "
    "li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPH = frozenset("p pre blockquote td li dd div section article".split())
#: Elements that may wrap a whole page as well as a box beside the text.
WRAPPERS = frozenset("form fieldset".split())
#: Elements that a page's author marks as the text itself: they take the points of all that is in them whole.
TEXT_ROOTS = frozenset("article main".split())
#: An opening element ends open elements of these names, up to the nearest scope.
CLOSES = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
SCOPES = frozenset("article aside body div footer form header main nav section table td th ul ol dl blockquote".split())
#: Parts of a class, an id or a role that mark what surrounds an article, unless it holds the best text of the page.
SURROUNDINGS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline "
    "complementary contentinfo cookie cookies copyright cta disclaimer dropdown footer "
    "footnav form gdpr header legal login masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "notification pager pagination popup promo promoted promotion recommended related search "
    "share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar tooltip topbar widget widgets alert".split()
)
#: Those of what readers wrote: never the article, however long.
COMMENTS = frozenset(
    "comment comments commentlist discussion disqus replies reply replybox respond comentarios kommentare commentaires".split()
)
#: A class that begins with one of these tells what an element has or lacks, not what it is.
ABOUT = frozenset("has with no without is not".split())
#: A text among the surroundings must have so many times the points of the best one outside.
CLEARLY = 2.0
#: Factors by name, applied with the discount.
WEIGHT = {"article": 1.5, "main": 1.4, "section": 1.05, "blockquote": 1.05, "ul": 0.9, "ol": 0.9, "dl": 0.9}
#: A sibling of the best container stays from this share of its points on.
SIBLING_SHARE = 0.2
#: Points that have shrunk to this share on their way up are passed no further.
LEAST_SHARE = 1e-9

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|([^<]++)|(<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_PART = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Node:
    """An element; ``parts`` holds its texts and elements in page order.

    It is ``skipped`` for good, or ``aside``: left out unless the best text of the page is in it.
    """

    __slots__ = ("name", "parent", "parts", "skipped", "aside", "points", "chars", "linked")

    def __init__(self, name: str, parent: "Node | None", skipped: bool = False, aside: bool = False):
        self.name, self.parent, self.parts, self.skipped, self.aside = name, parent, [], skipped, aside
        self.points, self.chars, self.linked = 0.0, 0, 0


def _role(name: str, attributes: str) -> tuple[bool, bool]:
    """Is an element skipped, and is it aside?"""
    if name in SKIPPED:
        return True, False
    aside = name in WRAPPERS
    if not attributes or attributes.isspace() or name in ("html", "body", "a"):
        return False, aside
    for key, value in _ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key == "hidden":
            return True, aside
        value = value.strip("\"'").lower()
        if key in ("class", "id", "role"):
            for word in value.split():
                parts = _PART.findall(word)
                if parts and parts[0] not in ABOUT:
                    if not COMMENTS.isdisjoint(parts):
                        return True, aside
                    aside = aside or not SURROUNDINGS.isdisjoint(parts)
        elif (key == "aria-hidden" and value == "true") or (key == "style" and _HIDDEN.search(value)):
            return True, aside
    return False, aside


class _Open:
    """The element that is being read, and how many of each name are open around it."""

    def __init__(self, root: Node):
        self.here, self.names = root, {}

    def enter(self, node: Node) -> None:
        self.here = node
        self.names[node.name] = self.names.get(node.name, 0) + 1

    def leave_to(self, node: Node) -> None:
        while self.here is not node:
            self.names[self.here.name] -= 1
            self.here = self.here.parent

    def has(self, names) -> bool:
        return any(self.names.get(n) for n in names)

    def end(self, name: str) -> bool:
        """End the nearest open element of this name, if there is one."""
        if not self.has((name,)):
            return False
        node = self.here
        while node.name != name:
            node = node.parent
        self.leave_to(node.parent)
        return True

    def make_room(self, name: str) -> None:
        """End the open elements that an element of this name ends."""
        if name in BLOCK and name != "br" and self.has(("p",)):
            node = self.here  # a block ends an open paragraph
            while node.parent is not None and node.name not in SCOPES:
                if node.name == "p":
                    self.leave_to(node.parent)
                    return
                node = node.parent
        ends = CLOSES.get(name)
        if ends and self.has(ends):
            node = self.here
            while node.parent is not None:
                if node.name in ends:
                    self.leave_to(node.parent)
                    return
                if node.name in SCOPES:
                    return
                node = node.parent


def parse(page: str) -> Node:
    """The element tree of any markup; open elements end with the page."""
    root = Node("html", None)
    at, size = 0, len(page)
    lower, opened = None, _Open(root)
    while at < size:
        m = _TOKEN.match(page, at)
        if not m:  # cannot be: the last alternative takes any "<"
            break
        at = m.end()
        kind = m.lastindex
        if kind == 4:
            opened.here.parts.append(html.unescape(m[4]) if "&" in m[4] else m[4])
        elif kind == 5:
            if not re.match(r"[a-zA-Z/!?]", page[at : at + 1]):
                opened.here.parts.append("<")
                continue
            end = page.find(">", at)
            if end < 0:
                break  # a tag the page ends in
            at = end + 1
        elif kind == 1:
            if not opened.end(m[1].lower()) and m[1].lower() == "br":
                opened.here.parts.append(Node("br", opened.here))
        elif kind is not None:
            name, attributes = m[2].lower(), m[3] or ""
            if name == "html":
                continue
            opened.make_room(name)
            node = Node(name, opened.here, *_role(name, attributes))
            opened.here.parts.append(node)
            if name in RAW:
                lower = page.lower() if lower is None else lower
                end = lower.find("</" + name, at)
                close = page.find(">", end) if end >= 0 else -1
                at = close + 1 if close >= 0 else size
            elif name not in VOID and (name in BLOCK or not attributes.endswith("/")):
                opened.enter(node)
    return root


def _measure(root: Node) -> list[Node]:
    """Text and link lengths from the leaves up; all elements that are not skipped, in page order.

    What is aside counts for itself and not for what is around it.
    """
    order, stack = [], [(root, False)]
    while stack:
        node, in_link = stack.pop()
        order.append(node)
        in_link = in_link or node.name == "a"
        own = sum(len(x.strip()) for x in node.parts if isinstance(x, str))
        node.chars, node.linked = own, own if in_link else 0
        stack += [(x, in_link) for x in reversed(node.parts) if isinstance(x, Node) and not x.skipped]
    for node in reversed(order):
        if node.parent is not None and not node.aside:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
    return order


def _link_share(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _inline_text(node: Node) -> str:
    """The text of a paragraph, less that of paragraphs within it."""
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif x is node or (x.name not in BLOCK and not x.skipped and not x.aside):
            stack += reversed(x.parts)
    return "".join(out)


def paragraph_points(text: str) -> float:
    """Points of a paragraph: one, one per comma, one per hundred characters up to three; none below 25 characters."""
    if len(text) < 25:
        return 0.0
    return 1.0 + text.count(",") + text.count("،") + text.count("、") + min(len(text) / 100, 3.0)


def _score(node: Node) -> float:
    return node.points * WEIGHT.get(node.name, 1.0) * (1 - _link_share(node))


def _give_points(order: list[Node]) -> None:
    """Points of all paragraphs, passed up and halved on every level; text roots take them whole."""
    for node in order:
        if node.name not in PARAGRAPH:
            continue
        points = paragraph_points(_inline_text(node).strip()) * (1 - _link_share(node))
        if not points:
            continue
        own = node.name in TEXT_ROOTS or node.aside
        above, share = (node if own else node.parent), 1.0
        while above is not None and share > LEAST_SHARE:
            above.points += points if above.name in TEXT_ROOTS else points * share
            if above.aside:
                break
            above, share = above.parent, share / 2


def _best(order: list[Node]) -> Node | None:
    """The best container: one among the surroundings only if nothing outside comes near it. It and what is around it come in."""
    within: dict[int, bool] = {}
    best: dict[bool, Node] = {}
    for node in order:
        beside = within[id(node)] = node.aside or (node.parent is not None and within[id(node.parent)])
        if node.points and node.parent is not None and (beside not in best or _score(node) > _score(best[beside])):
            best[beside] = node
    outside, inside = best.get(False), best.get(True)
    if inside is None or (outside is not None and _score(inside) <= CLEARLY * _score(outside)):
        return outside
    if outside is None and any(n.name in TEXT_ROOTS and n.chars and not within[id(n)] for n in order):
        return None  # a short text that the author marked
    node = inside
    while node is not None:
        node.aside, node = False, node.parent
    return inside


def choose(root: Node) -> list[Node]:
    """The best container and the siblings kept with it, in page order."""
    order = _measure(root)
    _give_points(order)
    best = _best(order)
    if best is None:
        # No paragraph counts: all there is, or what the author marked as the text.
        marked = [n for n in order if n.name in TEXT_ROOTS and n.chars]
        return [max(marked, key=lambda n: n.chars)] if marked else [root]
    if best.name in ("body", "html"):
        return [best]
    least = max(10.0, SIBLING_SHARE * _score(best))
    kept = []
    for x in best.parent.parts:
        if not isinstance(x, Node) or x.skipped or x.aside:
            continue
        if x is best or _score(x) >= least or x.name in ("h1", "h2"):
            kept.append(x)
        elif x.name in ("p", "pre", "blockquote") and x.chars and _link_share(x) < 0.25:
            kept.append(x)
    return kept


def main_text(page: str | None) -> str:
    """Blocks of the main text in page order, joined by one space; empty if there are none."""
    if not page:
        return ""
    out: list[str] = []
    stack: list = list(reversed(choose(parse(page))))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif not x.skipped and not x.aside:
            if x.name in BLOCK:
                out.append(" ")
                stack.append(" ")
            stack += reversed(x.parts)
    return " ".join("".join(out).split())


def extract_text(pages: DataFrame) -> DataFrame:
    """Add ``main_text`` and ``n_chars`` (its code points) to pages, replacing columns of these names.

    Reads the whole ``html``. Null, empty and blank pages, and pages of nothing but surroundings, have an
    empty text. Character references are decoded, white space becomes one space; broken markup is read
    as far as it goes. Repeated rows are treated alike. A map without a shuffle.
    """

    def start():
        def step(pages):
            texts = [main_text(p) for p in pages]
            return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

        return step

    return map_columns(pages, ["html"], "main_text string, n_chars bigint", start)
