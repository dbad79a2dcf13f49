"""Reads one HTML page into a flat list of nodes with nested-set positions.

This is the only per-row Python in the package: markup in, nodes out. What is
removed, kept, followed or extracted is decided later by Spark expressions.

Every element takes one position when it opens and one when it closes, every
leaf (text, comment, doctype, ...) takes a single position, so a node lies
inside an element exactly when its position lies between the element's two.
"""

from __future__ import annotations

import re
from collections import Counter
from html import entities
from html.parser import HTMLParser

# Elements without content, printed as <br/>.
VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
# Attributes holding a whitespace-separated list ("*" = on every element).
LIST_ATTRIBUTES = {
    "*": {"class", "accesskey", "dropzone"},
    "a": {"rel", "rev"},
    "link": {"rel", "rev"},
    "td": {"headers"},
    "th": {"headers"},
    "form": {"accept-charset"},
    "object": {"archive"},
    "area": {"rel"},
    "icon": {"sizes"},
    "iframe": {"sandbox"},
    "output": {"for"},
}
# Text below these elements is not part of the visible text.
HIDDEN_TEXT_TAGS = frozenset({"script", "style", "template", "rt", "rp"})
RAW_TEXT_TAGS = frozenset({"script", "style"})
PRESERVE_SPACE_TAGS = frozenset({"pre", "textarea"})
ASCII_SPACES = " \n\t\f\r"

_CHARSET_PARAM = re.compile(r"((?:^|[\s;])charset=)[^;]*", re.M)

# One entry per node field, in the order of the Spark struct.
NODE_FIELDS = (
    "pos",
    "end_pos",
    "parent_pos",
    "depth",
    "kind",
    "tag",
    "classes",
    "role",
    "href",
    "link_text",
    "open_str",
    "close_str",
    "text_from",
    "text_to",
)


def escape_text(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def quote_attribute(value: str) -> str:
    value = escape_text(value)
    if '"' not in value:
        return f'"{value}"'
    if "'" not in value:
        return f"'{value}'"
    return '"' + value.replace('"', "&quot;") + '"'


def tidy_attributes(tag: str, pairs: list[tuple[str, str | None]]) -> dict[str, str]:
    """Last duplicate wins, missing values are empty, list values are single-spaced."""
    attrs = {name: value or "" for name, value in pairs}
    lists = LIST_ATTRIBUTES["*"] | LIST_ATTRIBUTES.get(tag, set())
    for name in attrs.keys() & lists:
        attrs[name] = " ".join(attrs[name].split())
    if tag == "meta":
        # Pages are always written back as UTF-8, so the declared charset follows.
        if "charset" in attrs:
            attrs["charset"] = "utf-8"
        elif attrs.get("http-equiv", "").lower() == "content-type" and "content" in attrs:
            attrs["content"] = _CHARSET_PARAM.sub(r"\1utf-8", attrs["content"])
    return attrs


class _Element:
    """An open element: its node row plus what is only known when it closes."""

    __slots__ = ("row", "tag", "children", "only_string", "attr_text")

    def __init__(self, row: list, tag: str, attr_text: str):
        self.row = row
        self.tag = tag
        self.attr_text = attr_text
        self.children = 0
        self.only_string: str | None = None


class PageReader(HTMLParser):
    """Turns markup into node rows; unclosed elements close at the end of the page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)

    def read(self, html: str) -> tuple[list[list], list[str]]:
        """Return the node rows in page order and the stripped pieces of visible text."""
        self.reset()
        self._rows: list[list] = []
        self._texts: list[str] = []
        self._clock = 0
        self._open: list[_Element] = []
        self._open_tags: Counter = Counter()
        self._hidden = 0
        self._preserve = 0
        self._self_closed: Counter = Counter()
        self._pending: list[str] = []
        self.feed(html)
        self.close()
        self._flush()
        while self._open:
            self._close_innermost()
        return self._rows, self._texts

    # -- positions ---------------------------------------------------------

    def _tick(self) -> int:
        now = self._clock
        self._clock += 1
        return now

    def _new_row(self, kind: str) -> list:
        parent = self._open[-1] if self._open else None
        if parent is not None:
            parent.children += 1
            parent.only_string = None
        pos = self._tick()
        n_texts = len(self._texts)
        row = [
            pos, pos, parent.row[0] if parent else -1, len(self._open), kind,
            None, None, None, None, None, "", None, n_texts, n_texts,
        ]
        self._rows.append(row)
        return row

    def _leaf(self, kind: str, string: str, markup: str) -> None:
        row = self._new_row(kind)
        row[10] = markup
        if self._open and self._open[-1].children == 1:
            self._open[-1].only_string = string

    # -- elements ----------------------------------------------------------

    def _open_element(self, tag: str, pairs) -> None:
        self._flush()
        attrs = tidy_attributes(tag, pairs)
        row = self._new_row("elem")
        row[5] = tag
        row[6] = attrs.get("class")
        row[7] = attrs.get("role")
        row[8] = attrs.get("href")
        attr_text = "".join(
            f" {name}={quote_attribute(value)}" for name, value in sorted(attrs.items())
        )
        self._open.append(_Element(row, tag, attr_text))
        self._open_tags[tag] += 1
        self._hidden += tag in HIDDEN_TEXT_TAGS
        self._preserve += tag in PRESERVE_SPACE_TAGS

    def _close_innermost(self) -> None:
        element = self._open.pop()
        tag, row = element.tag, element.row
        self._open_tags[tag] -= 1
        self._hidden -= tag in HIDDEN_TEXT_TAGS
        self._preserve -= tag in PRESERVE_SPACE_TAGS
        row[1] = self._tick()
        if tag == "a":
            row[9] = element.only_string
        if tag in VOID_TAGS and not element.children:
            row[10] = f"<{tag}{element.attr_text}/>"
        else:
            row[10] = f"<{tag}{element.attr_text}>"
            row[11] = f"</{tag}>"
        row[13] = len(self._texts)
        if self._open and self._open[-1].children == 1:
            self._open[-1].only_string = element.only_string

    def _close_element(self, tag: str) -> None:
        """Close everything down to the nearest open element of that name, if there is one."""
        self._flush()
        if not self._open_tags[tag]:
            return
        while self._open[-1].tag != tag:
            self._close_innermost()
        self._close_innermost()

    def handle_starttag(self, tag, attrs):
        self._open_element(tag, attrs)
        if tag in VOID_TAGS:
            self._close_innermost()
            self._self_closed[tag] += 1  # a later explicit end tag is redundant

    def handle_startendtag(self, tag, attrs):
        self._open_element(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self._self_closed[tag]:
            self._self_closed[tag] -= 1
        else:
            self._close_element(tag)

    # -- text --------------------------------------------------------------

    def _collapse(self, text: str) -> str:
        """Blank runs shrink to one newline or space, except in preformatted text."""
        if self._preserve or text.strip(ASCII_SPACES):
            return text
        return "\n" if "\n" in text else " "

    def _flush(self) -> None:
        if not self._pending:
            return
        text = self._collapse("".join(self._pending))
        self._pending.clear()
        raw = bool(self._open) and self._open[-1].tag in RAW_TEXT_TAGS
        self._leaf("text", text, text if raw else escape_text(text))
        self._add_visible_text(text)

    def _add_visible_text(self, text: str) -> None:
        piece = text.strip()
        if piece and not self._hidden:
            self._texts.append(piece)
            self._rows[-1][13] = len(self._texts)

    def handle_data(self, data):
        self._pending.append(data)

    def handle_charref(self, name):
        code = int(name[1:], 16) if name[0] in "xX" else int(name)
        char = None
        if code < 256:
            # Old pages number characters by their Windows code page.
            char = bytes([code]).decode("windows-1252", errors="ignore")
        if not char and code <= 0x10FFFF:
            char = chr(code)
        self._pending.append(char or "\ufffd")

    def handle_entityref(self, name):
        self._pending.append(entities.html5.get(name + ";", "&" + name))

    # -- other leaves --------------------------------------------------------

    def _special(self, kind: str, data: str, prefix: str, suffix: str) -> None:
        self._flush()
        text = self._collapse(data)
        self._leaf(kind, text, prefix + text + suffix)

    def handle_comment(self, data):
        self._special("comment", data, "<!--", "-->")

    def handle_decl(self, decl):
        self._special("doctype", decl[len("DOCTYPE ") :], "<!DOCTYPE ", ">\n")

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            inner = data[len("CDATA[") :]
            self._special("cdata", inner, "<![CDATA[", "]]>")
            self._add_visible_text(inner)
        else:
            self._special("declaration", data, "<?", "?>")

    def handle_pi(self, data):
        self._special("instruction", data, "<?", ">")
