"""A small tree of HTML elements, built with the standard library's parser, and a matcher for simple selectors."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from html import escape
from html.parser import HTMLParser

RAW = frozenset(("script", "style"))
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


def _quoted(value: str) -> str:
    """An attribute's value between the quotes that it doesn't have."""
    v = escape(value, quote=False)
    return f"'{v}'" if '"' in v and "'" not in v else '"' + v.replace('"', "&quot;") + '"'


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def get(self, name: str, default: str = "") -> str:
        return self.attrs.get(name, default)

    def walk(self) -> Iterator[Node]:
        """All elements below, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def strings(self) -> Iterator[str]:
        stack: list = list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                yield item
            else:
                stack.extend(reversed(item.children))

    def text(self) -> str:
        """All text below, blanks collapsed."""
        return " ".join("".join(self.strings()).split())

    def stripped(self) -> str:
        """Pieces of text, each without blanks at its ends, joined without a space."""
        return "".join([s.strip() for s in self.strings()])

    def above(self) -> Iterator[Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent

    def html(self) -> str:
        """The element as markup, with what stands for a sign escaped."""
        out: list[str] = []
        stack: list[Node | str] = [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                out.append(item)
                continue
            attrs = "".join([f" {k}={_quoted(v)}" for k, v in item.attrs.items()])
            if item.tag in VOID:
                out.append(f"<{item.tag}{attrs}/>")
                continue
            out.append(f"<{item.tag}{attrs}>")
            stack.append(f"</{item.tag}>")
            raw = item.tag in RAW
            stack.extend(c if isinstance(c, Node) else c if raw else escape(c, quote=False) for c in reversed(item.children))
        return "".join(out)

    def all(self, selector: str) -> list[Node]:
        match = matcher(selector)
        return [n for n in self.walk() if match(n, self)]

    def first(self, selector: str) -> Node | None:
        match = matcher(selector)
        return next((n for n in self.walk() if match(n, self)), None)


class Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        node: Node | None = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    """The document's root; broken markup gives what can be read of it."""
    b = Builder()
    b.feed(html or "")
    b.close()
    return b.root


_SIMPLE = re.compile(r"(?P<tag>^[a-z][a-z0-9]*)|\.(?P<cls>[\w-]+)|\[(?P<attr>[\w-]+)(?:(?P<op>\*?=)['\"](?P<val>[^'\"]*)['\"])?\]|:not\(\.(?P<no>[\w-]+)\)")


def _simple(text: str) -> Callable[[Node], bool]:
    tests, at = [], 0
    for m in _SIMPLE.finditer(text):
        if m.start() != at:
            raise ValueError(f"selector not understood: {text}")
        at = m.end()
        if m["tag"]:
            tests.append(lambda n, t=m["tag"]: n.tag == t)
        elif m["cls"]:
            tests.append(lambda n, c=m["cls"]: c in n.get("class").split())
        elif m["no"]:
            tests.append(lambda n, c=m["no"]: c not in n.get("class").split())
        elif m["op"] == "=":
            tests.append(lambda n, a=m["attr"], v=m["val"]: n.attrs.get(a) == v)
        elif m["op"]:
            tests.append(lambda n, a=m["attr"], v=m["val"]: v in n.get(a) and a in n.attrs)
        else:
            tests.append(lambda n, a=m["attr"]: a in n.attrs)
    if at != len(text):
        raise ValueError(f"selector not understood: {text}")
    return lambda n: all(t(n) for t in tests)


@lru_cache(maxsize=256)
def matcher(selector: str) -> Callable[[Node, Node], bool]:
    """Whether a node below a scope matches any of comma-parted selectors of tags, classes, attributes and descent."""
    chains = [[_simple(s) for s in one.split()] for one in (x.strip() for x in selector.split(",")) if one]

    def match(node: Node, scope: Node) -> bool:
        for chain in chains:
            if not chain[-1](node):
                continue
            rest = len(chain) - 2
            for up in node.above():
                if rest < 0:
                    break
                if chain[rest](up):
                    rest -= 1
            if rest < 0:
                return True
        return False

    return match
