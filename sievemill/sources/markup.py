"""A small element tree over the standard library's HTML parser.

Captured pages are not well-formed, so XML functions can't read them. Only
what the page readers need is here: elements, their text, search by a test.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag of the key closes an open element of one of these names.
_CLOSES = {"tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "li": ("li",), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody")}
_BLANKS = re.compile("[\t\n\x0b\f\r \xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]+")


class Element:
    """One element: name, attributes, children (elements and strings), parent."""

    __slots__ = ("name", "attrs", "children", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Element | None) -> None:
        self.name, self.attrs, self.children, self.parent = name, attrs, [], parent

    def walk(self) -> Iterator[Element]:
        """All elements below this one, in document order, without recursion."""
        stack = [c for c in reversed(self.children) if isinstance(c, Element)]
        while stack:
            e = stack.pop()
            yield e
            stack += [c for c in reversed(e.children) if isinstance(c, Element)]

    def nodes(self) -> Iterator[Element | str]:
        """All elements and texts below this one, in document order."""
        stack = list(reversed(self.children))
        while stack:
            n = stack.pop()
            yield n
            if isinstance(n, Element):
                stack += reversed(n.children)

    def find(self, test: Callable[[Element], bool]) -> Element | None:
        return next((e for e in self.walk() if test(e)), None)

    def find_all(self, test: Callable[[Element], bool]) -> list[Element]:
        return [e for e in self.walk() if test(e)]

    def kids(self, *names: str) -> list[Element]:
        """Direct children of the given names."""
        return [c for c in self.children if isinstance(c, Element) and c.name in names]

    def raw_text(self) -> str:
        parts, stack = [], list(reversed(self.children))
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                parts.append(c)
            elif c.name not in ("script", "style"):
                stack += reversed(c.children)
        return "".join(parts)

    def text(self) -> str:
        return squash(self.raw_text())

    def has_class(self, name: str) -> bool:
        return name in self.attrs.get("class", "").split()


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        for closed in (e for e in (self.at,) if e.name in _CLOSES.get(tag, ())):
            self.at = closed.parent or self.root
            if tag in ("tr", "tbody") and self.at.name in _CLOSES[tag] and self.at.name != "tbody":
                self.at = self.at.parent or self.root
        if tag == "tr" and self.at.name == "table":
            self._open("tbody", {})
        self._open(tag, {k: v or "" for k, v in attrs})
        if tag in _VOID:
            self.at = self.at.parent

    def _open(self, tag: str, attrs: dict[str, str]) -> None:
        e = Element(tag, attrs, self.at)
        self.at.children.append(e)
        self.at = e

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        e = self.at
        while e is not None and e.name != tag:
            e = e.parent
        if e is not None and e.parent is not None:
            self.at = e.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def squash(text: str) -> str:
    return _BLANKS.sub(" ", text).strip(" ")


def tree(html: str) -> Element:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def table_rows(root: Element, id_ending: str) -> list[Element]:
    """The rows of a table's own bodies; rows of tables within it don't count."""
    table = root.find(lambda e: e.name == "table" and e.attrs.get("id", "").endswith(id_ending))
    return [] if table is None else [r for body in table.kids("tbody") for r in body.kids("tr")]
