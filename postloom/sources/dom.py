"""A small DOM over the standard library's HTML tokenizer.

Rules: no element is closed by implication (an unclosed ``p`` holds what follows), an end tag closes up to the nearest open element
of its name and is ignored without one, void elements have no content; comments, scripts and styles are no text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

# Elements without content, elements whose content is no text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = {"script", "style", "template"}


class Node:
    __slots__ = ("name", "attrs", "children", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None):
        self.name, self.attrs, self.parent = name, attrs, parent
        self.children: list[Node | str] = []

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def walk(self) -> Iterator[Node]:
        """Descendants in document order."""
        stack = [iter(self.children)]
        while stack:
            for c in stack[-1]:
                if isinstance(c, Node):
                    yield c
                    stack.append(iter(c.children))
                    break
            else:
                stack.pop()

    def strings(self) -> Iterator[str]:
        stack = [iter(self.children)]
        while stack:
            for c in stack[-1]:
                if isinstance(c, str):
                    yield c
                elif c.name not in SILENT:
                    stack.append(iter(c.children))
                    break
            else:
                stack.pop()

    def text(self, separator: str = "") -> str:
        """The stripped text nodes that are not empty, joined."""
        return separator.join(s for s in (x.strip() for x in self.strings()) if s)

    def all(self, names: str | tuple[str, ...], where: Callable[[Node], bool] | None = None) -> Iterator[Node]:
        wanted = (names,) if isinstance(names, str) else names
        return (n for n in self.walk() if n.name in wanted and (where is None or where(n)))

    def first(self, names: str | tuple[str, ...], where: Callable[[Node], bool] | None = None) -> Node | None:
        return next(self.all(names, where), None)


def has_class(name: str) -> Callable[[Node], bool]:
    """The name is one of the element's classes, or its whole class attribute."""
    return lambda n: name in n.classes or n.attrs.get("class") == name


def class_matches(pattern: re.Pattern[str]) -> Callable[[Node], bool]:
    """The pattern is found in one of the element's classes or in the whole attribute."""
    return lambda n: any(pattern.search(c) for c in n.classes) or bool(n.attrs.get("class") and pattern.search(n.attrs["class"]))


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("[document]", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        values: dict[str, str] = {}
        for k, v in attrs:
            values.setdefault(k, v or "")
        node = Node(tag, values, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        node: Node | None = self.at
        while node is not None and node.name != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root
