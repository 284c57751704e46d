"""Schemas of whole documents: the type that ``schema_of_variant_agg`` merges
over all documents of a kind, as a tree, and its normalised paths (H3, H4, X10).

One aggregate per resource, combined map-side, yields the types of every
property at every depth; nothing is exploded.  Its text is as long as the
property names are many, so a row per resource reaches the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"\s*(`(?:[^`]|``)*`|[^\s<>(),:`]+|[<>(),:])")


@dataclass
class Node:
    """A type: its first word, the numbers in parentheses, the fields of an
    object, the element type of an array."""
    head: str
    size: tuple[int, ...] = ()
    fields: dict[str, "Node"] = field(default_factory=dict)
    element: "Node | None" = None


class _Reader:
    def __init__(self, text: str) -> None:
        self.tokens, at = [], 0
        while at < len(text.rstrip()):
            found = _TOKEN.match(text, at)
            self.tokens.append(found.group(1))
            at = found.end()
        self.at = 0

    def next(self, wanted: str | None = None) -> str:
        token = self.tokens[self.at]
        if wanted is not None and token != wanted:
            raise ValueError(f"{wanted!r} expected, not {token!r}")
        self.at += 1
        return token

    def peek(self) -> str | None:
        return self.tokens[self.at] if self.at < len(self.tokens) else None

    def node(self) -> Node:
        head = self.next()
        if head == "ARRAY":
            self.next("<")
            out = Node(head, element=self.node())
            self.next(">")
            return out
        if head == "OBJECT":
            out = Node(head)
            self.next("<")
            while self.peek() != ">":
                name = self.next()
                if name.startswith("`"):
                    name = name[1:-1].replace("``", "`")
                self.next(":")
                out.fields[name] = self.node()
                if self.peek() == ",":
                    self.next()
            self.next(">")
            return out
        size = []
        if self.peek() == "(":
            self.next()
            while self.peek() != ")":
                token = self.next()
                if token != ",":
                    size.append(int(token))
            self.next(")")
        return Node(head, tuple(size))


def parse(text: str) -> Node:
    """The tree of a schema as ``schema_of_variant`` writes it."""
    return _Reader(text).node()


def document_trees(parsed: DataFrame, doc: str = "doc", kind: str = "resource_type") -> dict[str, Node]:
    """Kind -> merged type of its documents; rows without a kind take no part."""
    merged = parsed.where(F.col(kind).isNotNull()).groupBy(kind).agg(F.schema_of_variant_agg(doc).alias("schema"))
    return {r[0]: parse(r[1]) for r in merged.orderBy(kind).collect()}


def step(name: str) -> str:
    """A property as a path step: as it is, or quoted if it holds signs of a path."""
    return name if re.fullmatch(r"[^.\[\]'\"]+", name) else "['" + name.replace("'", "\\'") + "']"


def paths(node: Node, prefix: str = "") -> Iterator[tuple[str, str]]:
    """(path, first word of the type) of everything under a node, with
    array indexes normalised: item, item[], item[].net."""
    if prefix:
        yield prefix, node.head
    if node.element is not None:
        yield from paths(node.element, prefix + "[]")
    for name, child in node.fields.items():
        part = step(name)
        yield from paths(child, prefix + part if part.startswith("[") or not prefix else f"{prefix}.{part}")
