"""Fixed-capacity containers filled with whole texts along a space-filling curve.

1. Each text gets its token count and a vector of hashed words, projected to three
   dimensions by fixed random signs and ranked into the Hilbert curve's cells; its
   key is the place on the curve, so near keys mean similar texts.
2. One range partitioning sorts the texts by key; a hash of the id behind the key
   splits any number of equal texts over partitions.  Sizes and keys are written
   before, so texts are tokenized once.
3. Each partition fills one container after the other along the curve: with the
   first text that is left, then with those of the next ``LOOK_AHEAD`` that leave the
   least space (one text, or two).  So no two texts of a container lie further apart
   on the curve than the texts that are looked ahead to and those that waited.  A text
   longer than a container is cut into full containers and one rest, which is packed
   like a text.  Each container class is packed by itself.

Defined results: NULL and empty texts have no tokens and are in no container; rows
with equal ids are items of their own (told apart by their place in the container);
a capacity that is NULL or less than 1 is left out; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..runtime import cut, ship
from .shingles import mix64, words
from .tokens import TOKENIZER, token_counts

BITS = 10  #: per dimension of the curve
LOOK_AHEAD = 256  #: texts along the curve among which the next container's are chosen


def project(texts: pa.Array) -> np.ndarray:
    """Three coordinates in 0 .. 2 ** BITS - 1 for each text, from its hashed words."""
    hashed, start = words(texts)
    count = np.diff(start)
    out = np.zeros((len(count), 3))
    for d in range(3):
        sign = ((mix64(hashed + np.uint64(d + 1)) >> np.uint64(63)).astype(np.int64) * 2 - 1).astype(np.float64)
        total = np.concatenate([[0.0], np.cumsum(sign)])
        out[:, d] = (total[start[1:]] - total[start[:-1]]) / np.sqrt(np.maximum(count, 1))
    return np.clip((np.tanh(out / 6) + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)


def hilbert(points: np.ndarray) -> np.ndarray:
    """Place of each point (n, dimensions) on the Hilbert curve, by Skilling's transposed form."""
    x = points.T.copy()
    dimensions = len(x)
    q = 1 << (BITS - 1)
    while q > 1:
        p = q - 1
        for i in range(dimensions):
            hit = (x[i] & q) > 0
            swap = np.where(hit, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(hit, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dimensions):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (BITS - 1)
    while q > 1:
        turn = np.where((x[-1] & q) > 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(BITS - 1, -1, -1):
        for i in range(dimensions):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


class _Packer:
    """Fills the containers of one class along the curve."""

    def __init__(self, name: str, capacity: int, part: int):
        self.name, self.capacity, self.made, self.part = name, capacity, 0, part
        self.waiting: dict[int, tuple] = {}  # number -> (id, piece, first token, size), in the order of the curve
        self.sizes: list[tuple[int, int]] = []  # (size, number), ascending
        self.seen = 0
        self.rows: list[tuple] = []

    def add(self, id_, size: int) -> None:
        piece, first = 1, 0
        while size > self.capacity:
            self._row(0, id_, piece, first, self.capacity)
            self.made += 1
            size, piece, first = size - self.capacity, piece + 1, first + self.capacity
        self.waiting[self.seen] = (id_, piece, first, size)
        insort(self.sizes, (size, self.seen))
        self.seen += 1
        if len(self.waiting) > LOOK_AHEAD:
            self.fill()

    def fill(self) -> None:
        """Fills one container, beginning with the first text that waits."""
        number = next(iter(self.waiting))
        self.place = 0
        self._put(bisect_left(self.sizes, (self.waiting[number][3], number)))
        while self.sizes and (free := self.capacity - self.place) >= self.sizes[0][0]:
            # the largest text that fits, or the two whose sum does
            at = bisect_left(self.sizes, (free + 1, -1)) - 1
            single, low, high, best = self.sizes[at][0], 0, at, 0
            pair = None
            while low < high and single < free:
                both = self.sizes[low][0] + self.sizes[high][0]
                if both > free:
                    high -= 1
                else:
                    if both > best:
                        best, pair = both, high
                        if both == free:
                            break
                    low += 1
            # of equal texts the nearest
            self._put(bisect_left(self.sizes, (self.sizes[pair if best > single else at][0], -1)))
        self.made += 1

    def _put(self, at: int) -> None:
        _, number = self.sizes.pop(at)
        id_, piece, first, size = self.waiting.pop(number)
        self._row(self.place, id_, piece, first, size)
        self.place += size

    def _row(self, place: int, id_, piece: int, first: int, size: int) -> None:
        self.rows.append((self.name, self.capacity, self.part | self.made, place, id_, piece, first, size))


def _packing(classes: list[tuple[str, int]], kind: pa.DataType):
    names = ["container_class", "capacity_tokens", "container_id", "place", "id", "piece_no", "first_token", "n_tokens"]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int32(), kind, pa.int32(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() << 40
        packers = [_Packer(name, capacity, part) for name, capacity in classes]

        def rows() -> Iterator[pa.RecordBatch]:
            for packer in packers:
                if packer.rows:
                    columns = zip(*packer.rows, strict=True)
                    packer.rows = []
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for packer in packers:
                for id_, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    packer.add(id_, size)
            yield from rows()
        for packer in packers:
            while packer.waiting:
                packer.fill()
        yield from rows()

    return run


def sized(df: DataFrame, id_col: str, text_col: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(id, n_tokens, curve): token count and place on the curve of each text with tokens."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                counts = token_counts(part.column(1).to_pylist(), tokenizer)
                curve = hilbert(project(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int32()), pa.array(curve)], names=["id", "n_tokens", "curve"])

    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text <> ''")
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, n_tokens int, curve bigint").where("n_tokens > 0")


def pack(df: DataFrame, id_col: str, text_col: str, classes: list[tuple[str, int]], tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per item of a container: container_class, capacity_tokens, container_id, place, id, piece_no, first_token, n_tokens.

    ``place`` is the item's first token in the container, ``first_token`` its first
    token in the text.
    """
    classes = sorted({(str(n), int(c)) for n, c in classes if c is not None and c >= 1})
    items = cut(sized(df, id_col, text_col, tokenizer)).withColumn("spread", F.xxhash64("id"))
    kind = items.schema["id"].dataType
    sorted_items = items.repartitionByRange("curve", "spread").sortWithinPartitions("curve", "spread").select("id", "n_tokens")
    return sorted_items.mapInArrow(
        _packing(classes, to_arrow_type(kind)),
        "container_class string, capacity_tokens int, container_id bigint, place int, "
        f"id {kind.simpleString()}, piece_no int, first_token int, n_tokens int",
    )


def fill(packed: DataFrame) -> DataFrame:
    """Per class: containers, items, tokens and the share of space used."""
    return packed.groupBy("container_class", "capacity_tokens").agg(
        F.countDistinct("container_id").alias("containers"), F.count("*").alias("items"), F.sum("n_tokens").alias("tokens")
    ).withColumn("space_used", F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")))
