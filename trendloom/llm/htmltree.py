"""A page as a tree of block elements with its text blocks as leaves, read the way browsers do, in one pass.

End tags that are left out are implied, end tags without a start are ignored, and scripts, styles, markup and form controls
hold no text. A text block is what lies between two borders of block elements; its white space is one space. Line breaks and
inline elements don't end a block.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

_TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>="']|=\s*"[^"]*"|=\s*'[^']*'|[="'])*+)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[^\W\d_a-zA-Z]+")

# Kinds of elements, as the HTML standard has them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea template noscript iframe noembed noframes xmp plaintext".split())
SILENT = frozenset("head svg select button object canvas audio video datalist map".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - frozenset("body caption html legend optgroup option tbody td tfoot th thead tr".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a start tag ends, and the elements beyond which it does not look.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
SCOPE = frozenset("table td th caption html button object".split())
#: Attributes whose words describe an element.
NAMING = ("class", "id", "role", "itemprop", "aria-label")
#: Marks of labelled pages: everything below is main text, or is not.
LABEL = "data-label"

_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}


@dataclass
class Page:
    """Nodes in page order, parents first: elements, and text blocks, which have a ``text``. Node 0 is the page."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["html"])
    names: list[list[str]] = field(default_factory=lambda: [[]])
    text: list[str | None] = field(default_factory=lambda: [None])
    linked: list[int] = field(default_factory=lambda: [0])
    #: 1 main text, 0 not, None unmarked; only labelled pages have marks.
    label: list[int | None] = field(default_factory=lambda: [None])

    def add(self, parent: int, tag: str, names: list[str], text: str | None, linked: int, label: int | None) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.names.append(names)
        self.text.append(text)
        self.linked.append(linked)
        self.label.append(label)
        return len(self.parent) - 1


def _described(attributes: str) -> tuple[list[str], int | None]:
    """Words of the naming attributes, small letters, and the label."""
    if "=" not in attributes and "hidden" not in attributes:
        return [], None
    words: list[str] = []
    label = None
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next(filter(None, values), "")
        if name in NAMING:
            words += [w.lower() for w in _PART.findall(unescape(value))]
        elif name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            words.append("hidden")
        elif name == LABEL:
            label = 1 if value == "1" else 0
    return list(dict.fromkeys(words)), label


class _Reader:
    def __init__(self) -> None:
        self.page = Page()
        #: Open elements: name, the node text belongs to, the label that holds below.
        self.open: list[tuple[str, int, int | None]] = [("html", 0, None)]
        self.count: Counter[str] = Counter()
        self.silent = 0
        self.pieces: list[str] = []
        self.linked: list[str] = []

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                linked = len("".join("".join(self.linked).split())) if self.linked else 0
                self.page.add(self.open[-1][1], "#text", [], text, linked, self.open[-1][2])
            self.pieces, self.linked = [], []

    def pop(self) -> None:
        name = self.open[-1][0]
        if name in BLOCK:
            self.flush()
        self.open.pop()
        self.count[name] -= 1
        self.silent -= name in SILENT

    def pop_to(self, depth: int) -> None:
        while len(self.open) > depth:
            self.pop()

    def last(self, names: set[str] | frozenset[str], beyond: set[str] | frozenset[str]) -> int | None:
        """Depth of the nearest open element of these names."""
        if not any(self.count[n] for n in names):
            return None
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.open[depth][0]
            if name in names:
                return depth
            if name in beyond:
                return None
        return None

    def data(self, text: str) -> None:
        if self.silent:
            return
        if "&" in text:
            text = unescape(text)
        self.pieces.append(text)
        if self.count["a"]:
            self.linked.append(text)

    def start(self, name: str, attributes: str) -> None:
        if self.count["head"] and name not in IN_HEAD:
            self.close({"head"}, frozenset())
        if name in ("html", "head", "body") and self.count[name]:
            return
        if name in ENDS_P:
            self.close({"p"}, SCOPE)
        if name in IMPLIED:
            self.close(*IMPLIED[name])
        elif name in HEADINGS and self.open[-1][0] in HEADINGS:
            self.pop()
        elif name in ("a", "button"):
            self.close({name}, SCOPE)
        if name in VOID:
            if name == "br":
                self.data(" ")
            elif name == "hr":
                self.flush()
            return
        _, node, label = self.open[-1]
        if name in BLOCK:
            self.flush()
            names, own = _described(attributes)
            label = label if own is None else own
            if name != "html":
                node = self.page.add(node, name, names, None, 0, label)
            else:
                self.page.names[0] = names
        self.open.append((name, node, label))
        self.count[name] += 1
        self.silent += name in SILENT

    def close(self, names: set[str], beyond: set[str] | frozenset[str]) -> None:
        depth = self.last(names, beyond)
        if depth is not None:
            self.pop_to(depth)

    def end(self, name: str) -> None:
        if name == "br":
            self.data(" ")
        group = HEADINGS if name in HEADINGS else {name}
        if name in VOID or name in ("html", "body") or not any(self.count[n] for n in group):
            return
        if name in BLOCK or name in SILENT:
            self.close(group, SCOPE - {name} if name not in ("table", "tr", "tbody", "thead", "tfoot") else frozenset())
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth][0] == name:
                return self.pop_to(depth)
            if self.open[depth][0] in BLOCK:
                break
        # Closed outside of a block that it holds: what follows is no longer inside, the block stays open.
        if name == "a":
            depth = self.last({"a"}, frozenset())
            if depth is not None:
                self.open[depth] = ("", *self.open[depth][1:])
                self.count["a"] -= 1
                self.count[""] += 1


def read_page(html: str | None) -> Page:
    """The tree of a page; a null or empty one has its root alone."""
    reader = _Reader()
    html = html or ""
    at = 0
    while True:
        found = _TOKEN.search(html, at)
        text = html[at : found.start()] if found else html[at:]
        if text:
            reader.data(text)
        if not found:
            break
        at = found.end()
        name = found[2]
        if name is None:
            continue
        name = name.lower()
        if found[1]:
            reader.end(name)
        elif name in RAW:
            if name in ("title", "noscript") and reader.count["svg"]:
                continue
            closed = _ENDS[name].search(html, at)
            at = closed.end() if closed else len(html)
        else:
            reader.start(name, found[3])
            if found[3].endswith("/") and reader.count["svg"]:
                reader.end(name)
    reader.pop_to(1)
    reader.flush()
    return reader.page
