"""Small reader of markup: a page as a tree of block elements and its text blocks in page order.

Used by the wrapper only. Inline elements are transparent. Like siblings that hold text, such as
paragraphs or list items, are one node, as are all further ones of many like containers, so a
page's tree has about as many nodes as its layout has parts, however long its text is.
"""

from __future__ import annotations

import html
import re

# Element names of the HTML standard by how they behave here.
RAW = frozenset("script style textarea title noscript template iframe svg math".split())
BLOCK = frozenset(
    "html head body address article aside blockquote button caption center dd details dialog dir "
    "div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li "
    "main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th "
    "thead tr ul".split())
# An element of the key ends an open element of the value's names.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
    "body": {"head"},
}
HOLDS = frozenset("ul ol menu dir dl table select div section article body".split())
CONTAINERS = frozenset("div section article aside main ul ol table form".split())
NO_P = BLOCK - {"html", "head", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption",
                "option", "optgroup", "legend", "button"}
# Like containers side by side that are nodes of their own, and children after which all like ones
# are one node.
LIKE, WIDE = 6, 64

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
DIGITS = re.compile(r"\d+")


class Node:
    """A layout part: `label` is the element name and the words of its class, id and role."""

    __slots__ = ("label", "kids", "texts", "chars", "linked")

    def __init__(self, label: str):
        self.label, self.kids, self.texts, self.chars, self.linked = label, [], [], 0, 0


def label(name: str, attributes: str) -> str:
    words = []
    for key, value in ATTRIBUTE.findall(attributes) if "=" in attributes else ():
        words += [key[0].lower() + ":" + DIGITS.sub("#", w) for w in
                  value.strip("\"'").lower().split()]
    return " ".join([name, *sorted(set(words))])


class Page:
    """`root`, and `blocks` as (text, node) in page order."""

    def __init__(self, markup: str | None):
        self.root, self.blocks = Node("#"), []
        # open elements: name, node, place of the child that was opened last
        self.open = [["#", self.root, -1]]
        self.text, self.linked, self.links = [], 0, 0
        self._read(markup or "")
        self._block()

    def _read(self, markup: str) -> None:
        at, size = 0, len(markup)
        while at < size:
            tag = MARKUP.search(markup, at)
            if tag is None:
                self._words(markup[at:])
                break
            if tag.start() > at:
                self._words(markup[at:tag.start()])
            at, name = tag.end(), tag[2]
            if not name:
                continue
            name = name.lower()
            if tag[1]:
                self._close(name)
                continue
            if name in RAW and not (name == "svg" and tag[3].endswith("/")):
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(markup, at)
                at = end.end() if end else size
                if name in ("textarea", "title", "noscript"):
                    self._block()
                continue
            self._open(name, tag[3])

    def _words(self, raw: str) -> None:
        self.text.append(raw)
        if self.links:
            self.linked += len(raw)

    def _block(self) -> None:
        """End the text block that is being gathered."""
        if self.text:
            text = " ".join(html.unescape("".join(self.text)).split())
            if text:
                node = self.open[-1][1]
                node.texts.append(text)
                node.chars += len(text)
                node.linked += min(self.linked, len(text))
                self.blocks.append((text, node))
            self.text, self.linked = [], 0

    def _open(self, name: str, attributes: str) -> None:
        if name == "a":
            self.links += 1
        if name == "br":
            self._block()
        if name not in BLOCK:
            return
        self._block()
        self.links = 0
        if name in NO_P and any(o[0] == "p" for o in self.open):
            self._pop("p")
        for other in ENDS.get(name, ()):
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i][0] == other:
                    del self.open[i:]
                    break
                if self.open[i][0] in HOLDS:
                    break
        if name == "hr":
            return
        parent = self.open[-1]
        parent[2] = self._child(parent[1].kids, parent[2], label(name, attributes), name)
        self.open.append([name, parent[1].kids[parent[2]], -1])

    @staticmethod
    def _child(kids: list[Node], last: int, wanted: str, name: str) -> int:
        """Place of the child that an element belongs to; a new one if none fits."""
        like = [i for i, k in enumerate(kids) if k.label == wanted]
        if name in CONTAINERS:
            ahead = [i for i in like if i > last]
            if not ahead and (len(like) >= LIKE or (like and len(kids) >= WIDE)):
                return like[-1]
        else:
            ahead = [i for i in like if i >= last]
            if not ahead and like and len(kids) >= WIDE:
                return like[-1]
        if ahead:
            return ahead[0]
        kids.insert(last + 1, Node(wanted))
        return last + 1

    def _close(self, name: str) -> None:
        if name == "a":
            self.links = max(0, self.links - 1)
        if name in BLOCK and any(o[0] == name for o in self.open):
            self._block()
            self.links = 0
            self._pop(name)
        elif name == "p":  # stands for an empty paragraph
            self._block()

    def _pop(self, name: str) -> None:
        while self.open.pop()[0] != name:
            pass
