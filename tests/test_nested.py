"""Interval labels against the element tree, on random and awkward records."""

import random
from xml.etree import ElementTree

from rostrum.operators import nested

from .conftest import rows


def expected(i, xml):
    try:
        root = ElementTree.fromstring(xml)
    except ElementTree.ParseError:
        return set()
    out, count = set(), dict.fromkeys(("item", "member", "name", "bill"), 0)

    def walk(e, item, member):
        kind, inside = e.tag.rpartition("}")[2], 0
        if kind == "relatedItem" and e.get("type") == "constituent":
            count["item"] += 1
            out.add((i, "item", count["item"], item))
            item = count["item"]
        elif kind == "congMember":
            count["member"] += 1
            inside = count["member"]
            out.add((i, "member", inside, item))
        elif kind == "name" and member:
            count["name"] += 1
            out.add((i, "name", count["name"], member))
        elif kind == "bill":
            count["bill"] += 1
            out.add((i, "bill", count["bill"], item))
        for child in e:
            walk(child, item, inside)

    walk(root, 0, 0)
    return out


def grow(draw, depth=0):
    kind = draw.choice(["relatedItem", "relatedItem", "congMember", "name", "bill", "extension", "x:other"])
    attributes = draw.choice(["", ' type="constituent"', ' type="host"', " type='constituent' ID='a'"])
    inner = "".join(grow(draw, depth + 1) for _ in range(draw.randrange(4))) if depth < 6 else draw.choice(["", "text &amp; more", "<![CDATA[<bill>]]>", "<!-- <bill/> -->"])
    return f"<{kind}{attributes}>{inner}</{kind}>" if inner or draw.random() < 0.5 else f"<{kind}{attributes}/>"


def test_random_records(spark):
    draw = random.Random(4)
    data = [(i, f'<mods xmlns="u" xmlns:x="v">{"".join(grow(draw) for _ in range(3))}</mods>') for i in range(80)]
    data += [(90, None), (91, ""), (92, "<mods><bill></mods>"), (93, "<mods>&undefined;</mods>"), (94, '<?xml version="1.0" encoding="ISO-8859-1"?><m:mods xmlns:m="u"><m:bill/></m:mods>')]
    data += [(95, "<mods>" + "<relatedItem type='constituent'>" * 400 + "<bill/>" + "</relatedItem>" * 400 + "</mods>"), (94, "<mods><bill/></mods>"), (None, "<mods><bill/></mods>")]
    df = spark.createDataFrame(data, "kind long, mods string").withColumnRenamed("kind", "pre")  # a name the result has too
    got = nested.interval_nodes(df, "pre", "mods")
    want = [x for i, t in data if t for x in expected(i, t)]
    assert rows(got.select("id", "kind", "node_no", "parent_no")) == sorted(want, key=repr)
    assert rows(nested.malformed(df, "pre", "mods")) == [(90,), (91,), (92,), (93,)]
    assert nested.interval_nodes(df.limit(0), "pre", "mods").count() == 0


def test_flat_tables_and_containment(spark):
    xml = "<mods><relatedItem type='constituent' ID='a'><congMember role='SPEAKING' party='D'><name type='parsed'>Mr. A</name></congMember><bill number='1'/></relatedItem><name>no</name></mods>"
    nodes = nested.interval_nodes(spark.createDataFrame([(1, xml)], "id int, xml string"), "id", "xml")
    assert rows(nested.kind_table(nodes, "member", ["role", "party", "state"]).drop("pre", "post")) == [(1, 1, 1, "SPEAKING", "D", None)]
    assert rows(nested.kind_table(nodes, "name", ["type"], "name").drop("pre", "post")) == [(1, 1, 1, "parsed", "Mr. A")]
    items, bills = nested.kind_table(nodes, "item", ["ID"]), nested.kind_table(nodes, "bill", ["number"])
    assert rows(nested.contained(bills, items).select("id", "node_no", "outer_no")) == [(1, 1, 1)]
