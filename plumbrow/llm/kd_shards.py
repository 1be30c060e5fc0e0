"""K-d tree sharding with built-in functions only.

A node of the tree is split along the metadata dimension in which its rows spread widest, at the weighted
quantile that gives each side its part of the node's bytes, until each leaf is one shard of the
target size. Dimensions are scaled to 30 bits over the whole table (numbers by their range, texts by
hash); 32 more bits of a row hash part equal values, so that a value held by a third of all rows, or one
text copied many times, can be split as well.

The medians are found for all nodes of a level at once by histograms: sums of bytes per node and range
of the split key, aggregated on the map side; the range with the median is narrowed until it is one
row or under `tolerance` of a leaf. The driver sees a few hundred sums per node, whatever the table's size.
Rows are not moved while the tree grows: a level is a projection of the narrow metadata table, stored
for the next one.

Slots number a shard's rows without gaps: rows are numbered within (shard, chunk) and offset by
the counts of the chunks before, so that no shard is sorted in one task.

Defined results: a NULL text has no bytes, a NULL value of a dimension comes before all others; rows
that repeat are rows of their own; with fewer rows than shards some shards are empty; an empty table
gives no rows. Columns of the input other than doc_id, text and the dimensions are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbrow.llm.common import shuffle_partitions, stage, text_or_empty

OVERHEAD = 16
DIMENSIONS = ("source", "lang", "n_chars", "doc_id")
_BITS = 30
_RANGES = 256
_CHUNK_ROWS = 20_000


@dataclass
class Node:
    """A range of shards; `split` keys and more of `dimension` go right. Low to high are searched."""

    first: int
    leaves: int
    dimension: int = 0
    split: int = 0
    low: int = 0
    high: int = -1
    need: float = 0.0  # bytes that go left

    @property
    def step(self) -> int:
        return max(1, -(-(self.high - self.low + 1) // _RANGES))


def _metadata(docs: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    text = text_or_empty("text").cast("binary")
    values = [F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(dimensions)]
    return stage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            *values,
        ).withColumn("row", F.monotonically_increasing_id()),
        "shard-metadata",
    )


def _coordinates(rows: DataFrame, n: int) -> DataFrame:
    """Adds x0..: each dimension on 30 bits, NULL as 0, and `tie`, 32 bits of a row hash."""
    numeric = [isinstance(rows.schema[f"v{i}"].dataType, T.NumericType) for i in range(n)]
    doubles = [F.col(f"v{i}").cast("double") for i in range(n)]
    bounds = None
    if any(numeric):
        wanted = [f(doubles[i]).alias(f"{f.__name__}{i}")
                  for i in range(n) if numeric[i] for f in (F.min, F.max)]
        bounds = rows.agg(*wanted).first()
    columns = {}
    for i in range(n):
        if numeric[i]:
            low, high = bounds[f"min{i}"] or 0.0, bounds[f"max{i}"] or 0.0
            share = (doubles[i] - F.lit(low)) / F.lit(max(high - low, 1e-300))
            x = F.floor(share * F.lit(float((1 << _BITS) - 2))) + 1
        else:
            x = F.shiftrightunsigned(F.xxhash64(F.col(f"v{i}").cast("string")), 64 - _BITS)
        columns[f"x{i}"] = F.coalesce(x.cast("long"), F.lit(0).cast("long"))
    tie = F.shiftrightunsigned(F.xxhash64("row", "doc_id"), 32)
    return rows.withColumns({**columns, "tie": tie})


def _key(dimension: Column | int, n: int) -> Column:
    x = F.get(F.array(*[F.col(f"x{i}") for i in range(n)]), dimension)
    return F.shiftleft(x, 32).bitwiseOR(F.col("tie"))


def _of_node(values: list[int]) -> Column:
    return F.get(F.array(*[F.lit(v).cast("long") for v in values]), F.col("node"))


def grow(rows: DataFrame, shards: int, n: int, tolerance: float) -> tuple[DataFrame, list[Node]]:
    """rows (with size, x0.., tie) with their leaf's place in the list of leaves, and that list."""
    nodes = [Node(0, shards)]
    rows = rows.withColumn("node", F.lit(0))
    while any(node.leaves > 1 for node in nodes):
        spread = [
            f(_key(F.lit(i), n)).alias(f"{f.__name__}{i}") for i in range(n) for f in (F.min, F.max)
        ]
        found = rows.groupBy("node").agg(F.sum("size").alias("bytes"), *spread).collect()
        stats = {r["node"]: r for r in found}
        leaf_bytes = 0.0
        for i, node in enumerate(nodes):
            if node.leaves > 1 and i in stats:
                s = stats[i]
                widths = [(s[f"max{d}"] >> 32) - (s[f"min{d}"] >> 32) for d in range(n)]
                node.dimension = widths.index(max(widths))
                node.low, node.high = s[f"min{node.dimension}"], s[f"max{node.dimension}"]
                node.need = s["bytes"] * (node.leaves // 2) / node.leaves
                leaf_bytes = max(leaf_bytes, s["bytes"] / node.leaves)
        keyed = rows.withColumn("key", _key(_of_node([x.dimension for x in nodes]), n))
        _find_splits(keyed, nodes, tolerance * leaf_bytes)
        below: list[Node] = []
        left, right = [], []
        for node in nodes:
            half = node.leaves // 2
            left.append(len(below))
            if half:
                below.append(Node(node.first, half))
            right.append(len(below))
            below.append(Node(node.first + half, node.leaves - half))
        goes_left = F.col("key") < _of_node([x.split for x in nodes])
        place = F.when(goes_left, _of_node(left)).otherwise(_of_node(right))
        rows = stage(keyed.withColumn("node", place.cast("int")).drop("key"), "shard-nodes")
        nodes = below
    return rows, nodes


def _find_splits(keyed: DataFrame, nodes: list[Node], enough: float) -> None:
    while any(x.high >= x.low for x in nodes):
        low, step = _of_node([x.low for x in nodes]), _of_node([x.step for x in nodes])
        inside = F.col("key").between(low, _of_node([x.high for x in nodes]))
        searched = keyed.filter(inside).withColumns({"low": low, "step": step})
        sums = (
            searched.groupBy("node", F.expr("(key - low) div step").alias("bucket"))
            .agg(F.sum("size").alias("bytes"), F.min("key").alias("first"), F.max("key").alias("last"))
            .orderBy("node", "bucket")
            .collect()  # at most _RANGES rows for each node
        )
        for i, node in enumerate(nodes):
            if node.high < node.low:
                continue
            before = 0
            for r in (r for r in sums if r["node"] == i):
                if before + r["bytes"] >= node.need:
                    break
                before += r["bytes"]
            if r["first"] == r["last"] or r["bytes"] <= enough:
                take = node.need - before > r["bytes"] / 2
                node.split = r["last"] + 1 if take else r["first"]
                node.low, node.high = 0, -1
            else:
                node.low, node.high, node.need = r["first"], r["last"], node.need - before


def numbered(rows: DataFrame, group: str, name: str) -> DataFrame:
    """Adds a gapless number from 0 within each group, of any size."""
    n_chunks = max(1, -(-rows.count() // (_CHUNK_ROWS * 8)), shuffle_partitions(rows.sparkSession) // 8)
    chunked = rows.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(n_chunks)))
    sums = chunked.groupBy(group, "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(group).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(group, "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inner = F.row_number().over(Window.partitionBy(group, "chunk").orderBy("row")) - 1
    joined = chunked.withColumn("inner", inner).join(bases, [group, "chunk"])
    return joined.withColumn(name, (F.col("base") + F.col("inner")).cast("long")).drop(
        "chunk", "inner", "base"
    )


def kd_shards(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: Sequence[str] = DIMENSIONS,
    tolerance: float = 0.0005,
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row; leaves of target_bytes, or so many shards."""
    rows = _metadata(docs, dimensions)
    if shards is None:
        total = rows.agg(F.sum("size").alias("n")).first()["n"] or 0
        shards = max(1, -(-total // target_bytes))
    placed = _coordinates(rows, len(dimensions))
    leaved, leaves = grow(placed, shards, len(dimensions), tolerance)
    sharded = leaved.withColumn("shard", _of_node([x.first for x in leaves]).cast("int"))
    columns = ["doc_id", "size", "text_crc32", "shard"]
    return numbered(sharded.select("row", *columns), "shard", "slot").select(*columns, "slot")
