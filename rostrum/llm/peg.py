"""A small parsing-expression-grammar engine: combinators that build parse trees.

A parser is a function (text, place) -> (end, nodes) or None.  ``node`` makes a tree
node of what its parser matched; the others pass on the nodes of their parts.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple


class Node(NamedTuple):
    name: str
    start: int
    end: int
    parts: tuple


Parser = Callable[[str, int], tuple[int, tuple] | None]


def token(pattern: str, flags: int = 0) -> Parser:
    match = re.compile(pattern, flags).match

    def run(text, at):
        found = match(text, at)
        return (found.end(), ()) if found else None

    return run


def seq(*parsers: Parser) -> Parser:
    def run(text, at):
        nodes: tuple = ()
        for parser in parsers:
            found = parser(text, at)
            if found is None:
                return None
            at, more = found
            nodes += more
        return at, nodes

    return run


def first(*parsers: Parser) -> Parser:
    """Ordered choice: the first parser that matches."""

    def run(text, at):
        for parser in parsers:
            found = parser(text, at)
            if found is not None:
                return found
        return None

    return run


def many(parser: Parser, least: int = 0) -> Parser:
    def run(text, at):
        nodes: tuple = ()
        count = 0
        while (found := parser(text, at)) is not None and found[0] > at:
            at, more = found
            nodes += more
            count += 1
        return (at, nodes) if count >= least else None

    return run


def maybe(parser: Parser) -> Parser:
    return first(parser, lambda text, at: (at, ()))


def ahead(parser: Parser) -> Parser:
    return lambda text, at: (at, ()) if parser(text, at) is not None else None


def unless(parser: Parser) -> Parser:
    return lambda text, at: (at, ()) if parser(text, at) is None else None


def node(name: str, parser: Parser) -> Parser:
    def run(text, at):
        found = parser(text, at)
        return None if found is None else (found[0], (Node(name, at, found[0], found[1]),))

    return run


def later(get: Callable[[], Parser]) -> Parser:
    """A rule that refers to one defined later (for recursion)."""
    return lambda text, at: get()(text, at)


def find(nodes: tuple, name: str) -> Node | None:
    """The first node of that name, depth first."""
    for n in nodes:
        if n.name == name:
            return n
        inner = find(n.parts, name)
        if inner is not None:
            return inner
    return None
