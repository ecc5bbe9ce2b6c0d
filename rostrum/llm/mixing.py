"""A mixture of sources at target shares of its tokens.

1. Tokens are counted per source.  The mixture's size T is the largest at which no
   source needs more than ``max_repeats`` rounds over its texts, or a given size, at
   which sources that reach their cap fall short; ``ALL`` is the number of tokens of
   the whole table, texts without a target source included.  A source's quota is share * T.
2. Each source's texts stand in a random order by a hash, the same in every round.
   Running token sums are exact and distributed: sums per leading hash bits (as many as
   the table's rows need) first, then within those buckets.  The last round takes the
   texts that end before the quota, and then one by one (``PASSES`` at most) the further
   text whose size comes closest to what is left, while that brings the source closer to
   its quota.
3. A source's order is cut into blocks.  A splitting tree gives each of the output
   shards its exact number of every source's blocks: at each node the node's block
   quotas are split between its halves by a multivariate hypergeometric draw.  The
   shards take disjoint runs of blocks from a random permutation of the blocks (their
   ranks by a hash), and order their rows by a hash.
4. Rows come out partitioned by shard (large shards by pieces of their order) and sorted.

Defined results: NULL and empty texts and texts whose source is NULL or has no
target are not mixed; a source without texts, share or repeats has quota 0; rows of
equal id and text are used as the rows they are; an empty table gives no rows and
shares of 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..runtime import cut, ship
from .tokens import TOKENIZER, token_counts


PASSES = 6  #: texts that may fill what the last round leaves of a quota
BROADCAST_BLOCKS = 500_000  #: blocks up to which the table of their shards is broadcast
SHARD_ROWS = 1_000_000  #: rows of a shard that are sorted in one task
#: The size of a mixture as large as its table.
ALL = -1


def quotas(tokens: dict[str, int], targets: list[tuple[str, float, int]], size: int | None = None) -> dict[str, int]:
    """Tokens to draw from each source."""
    useful = [(s, share, repeats) for s, share, repeats in targets if s is not None and share and share > 0 and repeats and repeats > 0]
    stocked = [(s, share, tokens.get(s, 0) * repeats) for s, share, repeats in useful if tokens.get(s, 0) > 0]
    if not stocked:
        return {}
    total = size if size is not None else min(int(most / share) for _, share, most in stocked)
    return {s: min(round(share * total), most) for s, share, most in stocked}


def split_tree(blocks: dict[str, int], shards: int, seed: int) -> dict[str, list[int]]:
    """Blocks of each source for each shard: sums are exact, shard sizes differ by one block at most."""
    names = sorted(blocks)
    out = {s: [0] * shards for s in names}

    def split(first: int, last: int, have: np.ndarray, path: int) -> None:
        if last - first == 1:
            for s, n in zip(names, have.tolist(), strict=True):
                out[s][first] = n
            return
        middle = (first + last) // 2
        total = int(have.sum())
        # exact division of the block count by the number of leaves
        lead = total * (middle - first) // (last - first)
        left = np.random.default_rng([seed, path]).multivariate_hypergeometric(have, lead, method="marginals") if total else have
        split(first, middle, left, 2 * path)
        split(middle, last, have - left, 2 * path + 1)

    if names:
        split(0, shards, np.array([blocks[s] for s in names], np.int64), 1)
    return out


def mixture(
    df: DataFrame,
    id_col: str,
    text_col: str,
    source_col: str,
    targets: list[tuple[str, float, int]],
    size: int | None = None,
    shards: int = 16,
    block_tokens: int = 4096,
    bucket_rows: int = 1 << 16,
    seed: int = 7,
    tokenizer: str = TOKENIZER,
) -> tuple[DataFrame, DataFrame]:
    """(rows, shares).

    rows: shard, place (order in the shard), source, id, round (1 = first use),
    n_tokens; sorted by shard and place within partitions of whole shards or pieces of
    them.  shares: source, target_share, tokens, max_repeats, quota_tokens,
    drawn_tokens, rounds, actual_share (of the tokens drawn), table_share (of the size
    asked for: below target_share where a source falls short).
    """
    spark = df.sparkSession
    ship(spark)
    names = sorted({s for s, _, _ in targets if s is not None})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = pa.array(token_counts(batch.column(2).to_pylist(), tokenizer), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], names=["id", "source", "n_tokens"])

    known = F.coalesce(F.col("source").isin(names), F.lit(False))
    chosen = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text")).where(F.col("text") != "")
    if size != ALL:
        chosen = chosen.where(known)
    kind = chosen.schema["id"].dataType.simpleString()
    counted = cut(chosen.mapInArrow(count, f"id {kind}, source string, n_tokens int").where("n_tokens > 0"))
    # one row per target source, and one for the others, comes to the driver
    name = F.when(known, F.col("source"))
    stock = counted.groupBy(name.alias("source")).agg(F.sum("n_tokens").alias("n"), F.count("*").alias("rows")).collect()
    tokens = {r["source"]: r["n"] for r in stock}
    if size == ALL:
        size = sum(tokens.values())
    tokens.pop(None, None)
    quota = quotas(tokens, targets, size)
    rounds = {s: -(-q // tokens[s]) for s, q in quota.items() if q > 0}
    plan = spark.createDataFrame(
        [(s, quota[s], rounds[s], tokens[s], quota[s] - (rounds[s] - 1) * tokens[s]) for s in sorted(rounds)] or [("", 0, 0, 0, 0)],
        "source string, quota long, rounds int, stock long, last long",
    )
    bits = max(0, math.ceil(math.log2(max([1, *(r["rows"] for r in stock)]) / bucket_rows)))
    turned = counted.where(known).withColumn("row", F.monotonically_increasing_id()).withColumn("turn", F.xxhash64(F.lit(seed), "id"))
    bucket = F.shiftrightunsigned("turn", 64 - bits) if bits else F.lit(0).cast("long")
    turned = turned.join(F.broadcast(plan), "source").where("rounds > 0").withColumn("bucket", bucket)
    by_bucket = turned.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("held"))
    # a source's rows / bucket_rows sums are in one window
    before = by_bucket.withColumn(
        "before", F.coalesce(F.sum("held").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ).drop("held")
    inside = W.partitionBy("source", "bucket").orderBy("turn", "row").rowsBetween(W.unboundedPreceding, -1)
    ordered = cut(
        turned.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(before, ["source", "bucket"])
        .withColumn("start", F.col("before") + F.col("within"))
        .drop("before", "within", "bucket")
    )
    # the last round: one row per target source comes to the driver in each pass
    whole = F.col("start") + F.col("n_tokens") <= F.col("last")
    filled = {r["source"]: r["n"] for r in ordered.where(whole).groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    gaps = {s: quota[s] - (rounds[s] - 1) * tokens[s] - filled.get(s, 0) for s in rounds}
    last_rows: list[int] = []
    for _ in range(PASSES):
        open_gaps = sorted((s, g) for s, g in gaps.items() if g > 0)
        if not open_gaps:
            break
        off = F.abs(F.col("n_tokens") - F.col("gap"))
        closest = (
            ordered.where(~whole & ~F.col("row").isin(last_rows))
            .join(F.broadcast(spark.createDataFrame(open_gaps, "source string, gap long")), "source")
            .where(off < F.col("gap"))
            .groupBy("source")
            .agg(F.min(F.struct(off.alias("off"), "turn", "row", "n_tokens")).alias("best"))
        )
        best = {r["source"]: r["best"] for r in closest.collect()}
        last_rows += [b["row"] for b in best.values()]
        gaps = {s: g - best[s]["n_tokens"] for s, g in open_gaps if s in best}
    uses = F.col("rounds") - 1 + (whole | F.col("row").isin(last_rows)).cast("int")
    placed = (
        ordered.withColumn("uses", uses)
        .where("uses > 0")
        .select("source", "id", "n_tokens", "start", "stock", "quota", "row", F.explode(F.sequence(F.lit(1), F.col("uses"))).alias("round"))
        .withColumn("at", F.least(F.col("start") + (F.col("round") - 1) * F.col("stock"), F.col("quota") - 1))
        .withColumn("block", F.floor(F.col("at") / block_tokens))
    )
    blocks = {s: -(-quota[s] // block_tokens) for s in rounds}
    shard_of = _shards_of_blocks(spark, blocks, split_tree(blocks, shards, seed), seed, bucket_rows)
    if sum(blocks.values()) <= BROADCAST_BLOCKS:
        shard_of = F.broadcast(shard_of)
    drawn_rows = sum(r["rows"] * rounds.get(r["source"], 0) for r in stock)
    piece_bits = max(0, math.ceil(math.log2(max(1, drawn_rows) / shards / SHARD_ROWS)))
    piece = F.shiftrightunsigned("place", 64 - piece_bits) if piece_bits else F.lit(0)
    rows = (
        placed.join(shard_of, ["source", "block"])
        .select("shard", F.xxhash64(F.lit(seed + 1), "round", "id").alias("place"), "source", "id", "round", "n_tokens")
        .repartition("shard", piece)
        .sortWithinPartitions("shard", F.shiftrightunsigned("place", 1), "place", "id")
    )
    drawn = placed.groupBy("source").agg(F.sum("n_tokens").alias("drawn_tokens"), F.max("round").alias("rounds"))
    wanted = spark.createDataFrame(
        [(s, float(share or 0), tokens.get(s, 0), repeats, quota.get(s, 0)) for s, share, repeats in targets if s is not None],
        "source string, target_share double, tokens long, max_repeats int, quota_tokens long",
    )
    report = wanted.join(drawn, "source", "left").fillna(0, ["drawn_tokens", "rounds"])
    total = F.sum("drawn_tokens").over(W.partitionBy())
    shares = report.withColumn("actual_share", F.when(total > 0, F.col("drawn_tokens") / total).otherwise(F.lit(0.0)))
    whole = F.lit(size) if size is not None else total
    shares = shares.withColumn("table_share", F.when(whole > 0, F.col("drawn_tokens") / whole).otherwise(F.lit(0.0)))
    return rows, shares


def _shards_of_blocks(spark: SparkSession, blocks: dict[str, int], shares_of: dict[str, list[int]], seed: int, bucket_rows: int) -> DataFrame:
    """(source, block, shard): the blocks' ranks by a hash, cut where the shards' runs end."""
    names = sorted(blocks)
    if not names:
        return spark.createDataFrame([], "source string, block long, shard int")
    firsts = np.cumsum([0] + [blocks[s] for s in names]).tolist()
    every = spark.range(firsts[-1])
    number = F.size(F.filter(F.array(*map(F.lit, firsts)), lambda x: x <= F.col("id"))) - 1
    every = every.withColumn("number", number).select(
        F.element_at(F.array(*map(F.lit, names)), F.col("number") + 1).alias("source"),
        (F.col("id") - F.element_at(F.array(*map(F.lit, firsts)), F.col("number") + 1)).alias("block"),
    )
    bits = max(0, math.ceil(math.log2(max(blocks.values()) / bucket_rows)))
    every = every.withColumn("turn", F.xxhash64(F.lit(seed), "source", "block"))
    every = every.withColumn("bucket", F.shiftrightunsigned("turn", 64 - bits) if bits else F.lit(0).cast("long"))
    before = every.groupBy("source", "bucket").agg(F.count("*").alias("held")).withColumn(
        "before", F.coalesce(F.sum("held").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    )
    rank = F.row_number().over(W.partitionBy("source", "bucket").orderBy("turn", "block")) - 1
    ends = spark.createDataFrame([(s, np.cumsum(shares_of[s]).tolist()) for s in names], "source string, ends array<long>")
    return (
        every.withColumn("rank", rank)
        .join(before.select("source", "bucket", "before"), ["source", "bucket"])
        .join(F.broadcast(ends), "source")
        .withColumn("seat", F.col("before") + F.col("rank"))
        .select("source", "block", F.size(F.filter("ends", lambda e: e <= F.col("seat"))).alias("shard"))
    )
