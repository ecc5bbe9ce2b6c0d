"""Deeply nested XML records as flat tables, linked by interval labels.

Each element gets a pre-order number when it opens and a post-order bound when
it closes, both from one counter of the record, in one depth-first traversal.
Then a lies around b exactly if a.pre < b.pre and b.post < a.post, so the parent
of any row is the innermost interval of the parent kind that contains its own.

Defined results: NULL, empty and malformed records have no rows (see
``malformed``); elements are told by local name, whatever their namespace;
missing attributes are NULL; a record that occurs twice is labelled twice;
rows with a NULL id keep it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import ship


@dataclass(frozen=True)
class Kind:
    """Elements of one kind: local name, required attributes, parent kind (and whether it must be the direct parent)."""

    name: str
    element: str
    where: tuple[tuple[str, str], ...] = ()
    parent: str | None = None
    direct: bool = False


#: The kinds of a granule's record.
MODS = (
    Kind("item", "relatedItem", (("type", "constituent"),), "item"),
    Kind("member", "congMember", (), "item"),
    Kind("name", "name", (), "member", direct=True),
    Kind("bill", "bill", (), "item"),
)

NODES = (
    "kind string, node_no int, parent_no int, pre int, post int, attributes map<string,string>, text string"
)


class _Labels:
    """Labels of the kept elements of one record: [kind number, pre, post, attributes, text, pre of the element around]."""

    def __init__(self, kinds: tuple[Kind, ...]):
        self.by_element: dict[str, list[tuple[int, Kind]]] = {}
        for i, kind in enumerate(kinds):
            self.by_element.setdefault(kind.element, []).append((i, kind))
        self.kinds = kinds

    def label(self, xml: str) -> list[list] | None:
        """None if the record isn't well formed."""
        parser = expat.ParserCreate(namespace_separator="\x1f")
        parser.buffer_text = True
        kept: list[list] = []
        around: list[int] = []  # pre of the open elements
        open_kept: list[list | None] = []
        count = 0

        def start(tag, attributes):
            nonlocal count
            count += 1
            node = None
            for i, kind in self.by_element.get(tag.rpartition("\x1f")[2], ()):
                own = {k.rpartition("\x1f")[2]: v for k, v in attributes.items()}
                if all(own.get(k) == v for k, v in kind.where):
                    node = [i, count, 0, own, [], around[-1] if around else 0]
                    kept.append(node)
                    break
            around.append(count)
            open_kept.append(node)

        def end(_):
            nonlocal count
            count += 1
            around.pop()
            node = open_kept.pop()
            if node is not None:
                node[2] = count

        def text(data):
            if open_kept and open_kept[-1] is not None:
                open_kept[-1][4].append(data)

        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text
        try:
            parser.Parse(xml, True)
        except (expat.ExpatError, ValueError, UnicodeEncodeError):
            return None
        return kept

    def link(self, kept: list[list]) -> Iterator[tuple]:
        """Numbers the nodes by kind and finds each one's parent by containment of intervals."""
        at = {kind.name: i for i, kind in enumerate(self.kinds)}
        inside: list[list[tuple[int, int, int]]] = [[] for _ in self.kinds]  # open intervals of each kind: (pre, post, number)
        numbers = [0] * len(self.kinds)
        for i, pre, post, attributes, text, direct in kept:  # in the order of pre
            kind = self.kinds[i]
            parent = 0
            if kind.parent is not None:
                stack = inside[at[kind.parent]]
                while stack and stack[-1][1] < pre:
                    stack.pop()
                if stack and stack[-1][1] > post and (not kind.direct or stack[-1][0] == direct):
                    parent = stack[-1][2]
            if kind.direct and not parent:
                continue  # such an element isn't of this kind
            numbers[i] += 1
            own = inside[i]
            while own and own[-1][1] < pre:
                own.pop()
            own.append((pre, post, numbers[i]))
            yield kind.name, numbers[i], parent, pre, post, attributes, "".join(text)


_LISTED = pa.schema(
    [
        ("kind", pa.string()),
        ("node_no", pa.int32()),
        ("parent_no", pa.int32()),
        ("pre", pa.int32()),
        ("post", pa.int32()),
        ("attributes", pa.map_(pa.string(), pa.string())),
        ("text", pa.string()),
    ]
)


def _labelling(kinds: tuple[Kind, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = _Labels(kinds)
        for batch in batches:
            ids, rows = [], []

            def flush():
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
                columns[5:6] = [[list(a.items()) for a in columns[5]]]
                fields = [pa.array(c, f.type) for c, f in zip(columns, _LISTED, strict=True)]
                out = pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), *fields], names=["id", *_LISTED.names])
                ids.clear(), rows.clear()
                return out

            for i, xml in enumerate(batch.column(1).to_pylist()):
                found = labels.label(xml)
                for row in labels.link(found or ()):
                    ids.append(i)
                    rows.append(row)
                if len(rows) > 20_000:
                    yield flush()
            yield flush()

    return run


def interval_nodes(df: DataFrame, id_col: str, xml_col: str, kinds: tuple[Kind, ...] = MODS) -> DataFrame:
    """One row per node: id, kind, node_no, parent_no, pre, post, attributes, text.  No shuffle."""
    ship(df.sparkSession)
    source = df.select(F.col(id_col).alias("id"), F.col(xml_col).alias("xml")).where(F.col("xml").isNotNull())
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(_labelling(kinds), f"id {kind}, {NODES}")


def malformed(df: DataFrame, id_col: str, xml_col: str) -> DataFrame:
    """Ids of the records that hold no well-formed XML, NULL and empty ones included."""
    ship(df.sparkSession)

    def run(batches):
        labels = _Labels(())
        for batch in batches:
            bad = [i for i, x in enumerate(batch.column(1).to_pylist()) if x is None or labels.label(x) is None]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(bad, pa.int64()))], names=["id"])

    source = df.select(F.col(id_col).alias("id"), F.col(xml_col).alias("xml"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}")


def kind_table(nodes: DataFrame, kind: str, attributes: list[str], text: str | None = None) -> DataFrame:
    """The flat table of one kind: id, its number, its parent's number, its interval and one column per attribute.

    An attribute named like one of the table's own columns gets the suffix ``_attribute``.
    """

    def attribute(a: str) -> Column:
        return F.col("attributes")[a].alias(f"{a}_attribute" if a.lower() in ("id", "node_no", "parent_no", "pre", "post") else a)

    columns = [F.col(c) for c in ("id", "node_no", "parent_no", "pre", "post")] + [attribute(a) for a in attributes]
    return nodes.where(F.col("kind") == kind).select(*columns, *([F.col("text").alias(text)] if text else []))


def contained(inner: DataFrame, outer: DataFrame) -> DataFrame:
    """All pairs of rows of one record in which ``outer`` lies around ``inner``, by their intervals."""
    o = outer.select("id", F.col("node_no").alias("outer_no"), F.col("pre").alias("outer_pre"), F.col("post").alias("outer_post"))
    return inner.join(o, "id").where("outer_pre < pre and post < outer_post").drop("outer_pre", "outer_post")
