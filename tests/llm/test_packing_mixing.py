"""Containers and mixtures: whole items, exact spans, exact quotas."""

import itertools
import random
from collections import defaultdict

import numpy as np
import pytest

from rostrum.llm import catalog, mixing, packing
from rostrum.llm.tokens import token_counts


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(4)
    data = [(i, " ".join(draw.choice(("harbor", "council", "bill", "é", "42")) for _ in range(draw.choice((3, 20, 90, 400)))), draw.choice("aabc"), 1) for i in range(400)]
    data += [(500, None, "a", 1), (501, "", "a", 1), (502, "x", None, 1), (503, "same", "b", 1), (503, "same", "b", 1), (504, "word " * 5000, "c", 1)]
    return data


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string, source string, n_tokens int").repartition(3)


def test_containers_hold_everything_once(spark, docs):
    sizes = defaultdict(int)
    for i, t, *_ in docs:
        sizes[i] += token_counts([t])[0]
    got = packing.pack(frame(spark, docs), "doc_id", "text", [("small", 64), ("large", 512), ("none", 0), ("null", None)]).collect()
    assert {r.container_class for r in got} == {"small", "large"}
    for name, capacity in (("small", 64), ("large", 512)):
        mine = [r for r in got if r.container_class == name]
        held, spans = defaultdict(list), defaultdict(list)
        for r in mine:
            held[r.container_id].append((r.place, r.n_tokens))
            spans[r.id].append((r.first_token, r.n_tokens))
        for items in held.values():
            at = 0
            for place, size in sorted(items):
                assert place == at
                at += size
            assert at <= capacity
        assert {i: sum(n for _, n in s) for i, s in spans.items()} == {i: n for i, n in sizes.items() if n}
        # cut only what doesn't fit
        assert all(len(s) == 1 or sizes[i] > capacity or i == 503 for i, s in spans.items())
        assert sum(sizes.values()) / (len(held) * capacity) > 0.9
    assert packing.pack(frame(spark, docs).limit(0), "doc_id", "text", [("small", 64)]).count() == 0


def test_containers_hold_neighbours():
    draw = random.Random(9)
    packer = packing._Packer("c", 2048, 0)
    sizes = [min(6000, int(draw.lognormvariate(5.6, 0.8)) + 1) for _ in range(20_000)]
    for i, n in enumerate(sizes):
        packer.add(i, n)
    while packer.waiting:
        packer.fill()
    held = defaultdict(list)
    for row in packer.rows:
        held[row[2]].append(row[4])
    assert sum(sizes) / (len(held) * 2048) > 0.97
    mixed = list(range(len(sizes)))
    draw.shuffle(mixed)
    apart, shuffled = (np.mean([b - a for ids in held.values() for a, b in itertools.pairwise(sorted(at[i] for i in ids))]) for at in (range(len(sizes)), mixed))
    assert apart < 0.1 * shuffled


def test_hilbert_neighbours():
    side = 8
    points = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    order = points[np.argsort(packing.hilbert(points))]
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def test_quotas():
    tokens = {"a": 1000, "b": 100}
    assert mixing.quotas(tokens, [("a", 0.5, 1), ("b", 0.5, 4)]) == {"a": 400, "b": 400}
    assert mixing.quotas(tokens, [("a", 0.5, 1), ("b", 0.5, 4)], size=2000) == {"a": 1000, "b": 400}
    assert mixing.quotas(tokens, [("a", 1.0, 1), ("c", 0.0, 1), (None, 0.1, 1), ("d", 0.2, 3)]) == {"a": 1000}


def test_split_tree_is_exact():
    got = mixing.split_tree({"a": 17, "b": 5, "c": 0}, 4, 1)
    assert {s: sum(n) for s, n in got.items()} == {"a": 17, "b": 5, "c": 0}
    assert sorted(sum(got[s][i] for s in got) for i in range(4)) == [5, 5, 6, 6]


def test_mixture(spark, docs):
    targets = [("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.2, 2), ("gone", 0.0, 1)]
    rows, shares = mixing.mixture(frame(spark, docs), "doc_id", "text", "source", targets, shards=4, block_tokens=256)
    got, report = rows.collect(), {r.source: r for r in shares.collect()}
    used = defaultdict(int)
    for r in got:
        used[(r.source, r.id, r.round)] += 1
    assert all(n == 1 or i == 503 for (_, i, _), n in used.items())
    assert all(r.round <= dict((s, m) for s, _, m in targets)[r.source] for r in got)
    longest = max(r.n_tokens for r in got)
    for s, share, _ in targets[:3]:
        assert abs(report[s].drawn_tokens - report[s].quota_tokens) <= longest
        assert report[s].drawn_tokens == sum(r.n_tokens for r in got if r.source == s)
    assert report["gone"].drawn_tokens == 0 and abs(sum(r.actual_share for r in report.values()) - 1) < 1e-9
    assert {r.shard for r in got} == set(range(4))
    empty_rows, empty_shares = mixing.mixture(frame(spark, docs).limit(0), "doc_id", "text", "source", targets)
    assert empty_rows.count() == 0 and {r.actual_share for r in empty_shares.collect()} == {0.0}


def test_mixture_meets_its_quotas(spark):
    draw = random.Random(3)
    data = [(i, "word " * draw.choice((3, 7, 20, 400, 900)), draw.choice("aaaab"), 1) for i in range(600)] + [(700, "word " * 5, "b", 1)] * 4
    rows, shares = mixing.mixture(frame(spark, data), "doc_id", "text", "source", [("a", 0.7, 1), ("b", 0.3, 3)], shards=4, block_tokens=256, bucket_rows=64)
    for r in shares.collect():
        assert abs(r.drawn_tokens - r.quota_tokens) <= 0.002 * r.quota_tokens
    assert rows.count() == rows.select("id", "round").where("id <> 700").distinct().count() + rows.where("id = 700").count()
    # partitions hold whole shards, in order
    parts = rows.rdd.glom().collect()
    assert sum(len({r.shard for r in p}) for p in parts) == 4
    assert all([r.shard for r in p] == sorted(r.shard for r in p) for p in parts)


def test_blocks_are_permuted(spark):
    blocks = {"a": 500, "b": 3}
    shares_of = mixing.split_tree(blocks, 8, 1)
    got = mixing._shards_of_blocks(spark, blocks, shares_of, 5, 16).collect()
    assert sorted((r.source, r.block) for r in got) == [(s, i) for s in "ab" for i in range(blocks[s])]
    for s in "ab":
        assert [sum(r.source == s and r.shard == k for r in got) for k in range(8)] == shares_of[s]


def test_mixture_queries_fill_the_table(spark, tmp_path):
    text = "one two three four five"
    data = [(i, text, "a") for i in range(60)] + [(100 + i, text, None) for i in range(38)] + [(200, text, "b"), (201, text, "other")]
    spark.createDataFrame(data, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    targets = [("a", 0.5, 1), ("b", 0.5, 4)]
    spark.createDataFrame(targets, "source string, target_share double, max_repeats int").write.parquet(f"{tmp_path}/mix_targets.parquet")
    report = {r.source: r for r in catalog.p8_shares(spark, str(tmp_path)).collect()}
    each = report["b"].tokens
    # half of the table's 100 texts from a; b stops at four uses of its only text
    assert report["a"].drawn_tokens == 50 * each and report["b"].drawn_tokens == 4 * each
    assert report["a"].table_share == 0.5 and report["b"].table_share == 0.04 and abs(report["b"].actual_share - 4 / 54) < 1e-9
    assert catalog.p8_mixture(spark, str(tmp_path)).count() == 54


def test_catalog():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES) and all(n.startswith("p") for n in catalog.QUERIES)
