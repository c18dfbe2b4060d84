"""Readers for one page of markup; the extract operators run them inside Spark tasks.

A page is cut into tags by one compiled pattern, and attributes are only looked at on the tags that
can matter, because reading markup is what an extraction job spends its time on.
"""

from __future__ import annotations

import re
from html import unescape

# Elements that never have content.
VOID_TAGS = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem",
    "meta", "param", "source", "track", "wbr", "basefont", "bgsound", "command", "frame",
    "image", "isindex", "nextid", "spacer",
}
# Elements whose text is not part of the visible text.
HIDDEN_TAGS = {"rp", "rt", "script", "style", "template"}

# A quote opens a value only after `=`; atomic parts keep the match linear on broken markup.
_ATTRIBUTES = r"""(?>[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+"""
_HIDDEN = rf"""(?P<raw>[sS](?:[cC][rR][iI][pP][tT]|[tT][yY][lL][eE]))(?=[\s/>]){_ATTRIBUTES}>
        .*?(?:</(?i:(?P=raw))(?=[\s/>])[^>]*>|\Z)
    |!--(?:.*?-->|.*)"""
_TOKEN = re.compile(
    rf"""<(?:{_HIDDEN}
    |(?P<start>[a-zA-Z][^\s/>]*+)(?P<attributes>{_ATTRIBUTES})>
    |/(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+>
    |[!?/][^>]*>)""",
    re.DOTALL | re.VERBOSE,
)
_ATTRIBUTE = re.compile(
    r"""([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_BARE_VALUE_WITH_SLASH = re.compile(r"""=\s*[^\s"'][^\s]*/$""")


def _attributes(text: str) -> list[tuple[str, str]]:
    """Names and values as written in a tag; a name without a value has an empty one."""
    found = _ATTRIBUTE.findall(text)
    if "&" in text:
        return [(name.lower(), unescape(double or single or bare))
                for name, double, single, bare in found]
    return [(name.lower(), double or single or bare) for name, double, single, bare in found]


class _Element:
    """An open element that matters: a thing, a title, a comment, a body or hidden text."""

    __slots__ = ("comment", "texts", "is_thing", "is_title", "is_hidden")

    def __init__(self, classes: list[str], is_hidden: bool) -> None:
        self.is_thing = "thing" in classes
        self.is_title = "title" in classes
        self.is_hidden = is_hidden
        self.comment: dict | None = None
        self.texts: list[str] | None = None


class ThreadReader:
    """Heading and comments of a thread page, in one pass over its tags.

    `heading` is None if the page has no element of class `thing`. Body texts are lists of
    stripped text nodes. Unless `own_text_only`, a post or comment without a body (or a comment
    without a time) takes those of the first comment nested in it.
    """

    def __init__(self, own_text_only: bool = False) -> None:
        self.own_text_only = own_text_only
        self.heading: dict | None = None
        self.heading_link: str | None = None
        self.heading_texts: list[str] | None = None
        self.comments: list[dict] = []
        self._link_found = False
        self._open: list[tuple[str, _Element | None]] = []
        self._open_count: dict[str, int] = {}
        self._open_comments: list[dict] = []
        self._collecting: list[list[str]] = []
        self._things = self._titles = self._hidden = 0

    def read(self, page: str) -> "ThreadReader":
        position = 0
        for token in _TOKEN.finditer(page):
            begin, end = token.span()
            if begin > position and self._collecting and not self._hidden:
                self._text(page[position:begin])
            position = end
            start, attributes, close = token.group("start", "attributes", "end")
            if start:
                self._start(start.lower(), attributes)
            elif close:
                self._end(close.lower())
        if self._collecting and not self._hidden:
            self._text(page[position:])
        return self

    def _text(self, text: str) -> None:
        text = (unescape(text) if "&" in text else text).strip()
        if text:
            for texts in self._collecting:
                texts.append(text)

    def _start(self, tag: str, attributes: str) -> None:
        element = None
        is_link = tag == "a" and self._titles and not self._link_found
        is_hidden = tag in HIDDEN_TAGS
        if is_link or is_hidden or (attributes and "class" in attributes.lower()):
            element = self._read_element(tag, dict(_attributes(attributes)), is_link, is_hidden)
        if tag in VOID_TAGS:
            return
        if attributes.endswith("/") and not _BARE_VALUE_WITH_SLASH.search(attributes):
            return  # closed in itself
        self._open.append((tag, element))
        self._open_count[tag] = self._open_count.get(tag, 0) + 1
        if element is None:
            return
        self._things += element.is_thing
        self._titles += element.is_title
        self._hidden += element.is_hidden
        if element.comment is not None:
            self._open_comments.append(element.comment)
        if element.texts is not None:
            self._collecting.append(element.texts)

    def _read_element(
        self, tag: str, values: dict[str, str], is_link: bool, is_hidden: bool
    ) -> _Element:
        classes = values.get("class", "").split()
        element = _Element(classes, is_hidden)
        if element.is_thing and self.heading is None:
            self.heading = values
        if is_link:
            self._link_found = True
            self.heading_link = values.get("href")
        if "md" in classes:
            self._start_body(tag, element)
        if tag == "time" and "live-timestamp" in classes:
            self._give("time", values.get("datetime"))
        if tag == "div" and element.is_thing and values.get("data-type") == "comment":
            self._start_comment(element, values)
        return element

    def _start_comment(self, element: _Element, values: dict[str, str]) -> None:
        parent = self._open_comments[-1] if self._open_comments else None
        element.comment = {
            "values": values,
            "parent": parent["values"].get("data-fullname") if parent else None,
        }
        # An ancestor repeated on a later part of its thread's pages is there for its replies only.
        if "data-context" not in values:
            self.comments.append(element.comment)

    def _start_body(self, tag: str, element: _Element) -> None:
        texts: list[str] = []
        taken = tag == "div" and self._give("texts", texts)
        outside = not (self.own_text_only and self._open_comments)
        if self._things and self.heading_texts is None and outside:
            self.heading_texts = texts
            taken = True
        if taken:
            element.texts = texts

    def _give(self, key: str, value: object) -> bool:
        """Set `key` on the open comments that lack it, the innermost first."""
        given = False
        for comment in reversed(self._open_comments):
            if key in comment:
                break  # then all around it have it too
            comment[key] = value
            given = True
            if self.own_text_only:
                break
        return given

    def _end(self, tag: str) -> None:
        if not self._open_count.get(tag):
            return  # closes nothing
        while True:
            name, element = self._open.pop()
            self._open_count[name] -= 1
            if element is not None:
                self._things -= element.is_thing
                self._titles -= element.is_title
                self._hidden -= element.is_hidden
                if element.comment is not None:
                    self._open_comments.pop()
                if element.texts is not None:
                    self._collecting.pop()
            if name == tag:
                return
