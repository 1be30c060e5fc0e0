"""MinHash near-duplicates: a set similarity join by chosen paths.

A document's set are its distinct shingles; its signature are minwise tokens at 128 positions. In each of several
independent trees a node chooses one position, or two, so that 1 / similarity are chosen on average; its documents
go to one child for each chosen position and the token they have there. A pair as similar as asked for keeps
meeting in one child on average, unlike pairs soon part. Nodes that are small enough are compared exhaustively, on
one byte of each token; larger ones branch again. The number of trees follows from the recall asked for. Pairs that
look similar are confirmed on the full sets of their whole texts.

No pairs within a group are listed: a comparison grows components, comparing each member with the unreached ones
only, and hands on the links that hold them together. What looks similar so makes units: the members of a unit, and
their whole texts, come together once and are compared in the same way on their full sets, so no link is lost.
Nodes and units that are too large for a task are dealt to blocks, a few of their members to every block; whatever is not
linked with the most of them afterwards meets every block. Crowds of near copies would go on to the nodes of all trees; so
nodes that are large at some depth are compared in that way once, and branch again only while many of their
members are apart from the crowd. Documents with equal sets are one member from the start.

NULL, empty and blank texts have the empty set and are linked with nothing. Equal rows are members of one class.
A NULL doc_id is never the smallest, unless all of a component are NULL. Sets are compared by 64-bit hashes of
their shingles, equal sets found by 128 bits. No rows: no result. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrow.functions.keys import join_same
from plumbrow.llm.common import WordHashes, kept, shuffle_partitions, stage, text_or_empty, texts_of
from plumbrow.llm.components import components

POSITIONS = 128
#: Documents in a node that is compared exhaustively; documents and shingles in a block of a unit.
LEAF = 500
UNIT = 1000
UNIT_SHINGLES = 4_000_000
#: Every path has two choices at least; nodes still large after so many are dense.
DEEPEST = 9
#: After so many choices large nodes are mostly crowds. They end when at most so many of a leaf's share are apart.
CROWDED = 4
FEW = 1 / 8
#: Members of a large node or unit that every block gets, about.
LEADS = 8

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_SLICE = 2048


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them (the finaliser of splitmix64)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    numbers = _mixed(np.arange(1, 2 * POSITIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return numbers[:POSITIONS, None] | np.uint64(1), numbers[POSITIONS:, None]


_TIMES, _PLUS = _multipliers()


def shingles_of(text: bytes, hashes: WordHashes, length: int = 2) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles of words; of fewer words, of their sequence."""
    words = hashes.of(text.translate(_LOWER).split())
    if not len(words):
        return words
    length = min(length, len(words))
    n = len(words) - length + 1
    mixed = np.full(n, length, np.uint64)
    for k in range(length):
        mixed = _mixed(mixed * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n])
    return np.unique(mixed)


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The least hash at each position; 32 bits each."""
    least = None
    for i in range(0, len(shingles), _SLICE):
        hashed = ((shingles[i : i + _SLICE] * _TIMES + _PLUS) >> np.uint64(32)).min(axis=1)
        least = hashed if least is None else np.minimum(least, hashed)
    return least.astype(np.uint32)


def survival(similarity: float, depth: int) -> float:
    """The chance that a pair of this similarity shares a node of this depth in one tree."""
    second = 1 / similarity - 1
    alive = 1.0
    for _ in range(depth):
        both = similarity * alive
        alive = (1 - second) * both + second * (1 - (1 - both) ** 2)
    return alive


def trees_for(recall: float, similarity: float, depth: int = 4) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(similarity, depth)))


def _signatures(docs: DataFrame, length: int) -> DataFrame:
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = kept("words", WordHashes)
        for whole in batches:
            for start in range(0, len(whole), 1000):
                batch = whole.slice(start, 1000)
                sizes, keys, tokens = [], [], []
                for text in texts_of(batch):
                    found = shingles_of(text, hashes, length)
                    sizes.append(len(found))
                    if len(found):
                        keys.append(xxhash.xxh3_128_digest(found.tobytes()))
                        tokens.append(minwise(found))
                full = np.array(sizes, np.int64) > 0
                key = np.zeros((len(batch), 2), np.int64)
                key[full] = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
                flat = np.concatenate(tokens) if tokens else np.zeros(0, np.uint32)
                ends = np.concatenate(([0], np.cumsum(full * POSITIONS))).astype(np.int32)
                low = flat.astype(np.uint8).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(key[:, 0], mask=~full),
                        pa.array(key[:, 1], mask=~full),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int32))),
                        pa.array([low[a:z] for a, z in zip(ends, ends[1:])], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "h1", "h2", "tokens", "sketch"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    schema = "doc_id long, n_shingles long, h1 long, h2 long, tokens array<int>, sketch binary"
    return stage(rows.mapInArrow(sign, schema), "signatures")


# Paths


def _branched(nodes: DataFrame, similarity: float) -> DataFrame:
    """The nodes (path, tokens and others), one level down."""
    path = F.col("path")

    def position(i: int) -> Column:
        return F.pmod(F.xxhash64(path, F.lit(i)), F.lit(POSITIONS)).cast("int")

    def child(i: int) -> Column:
        return F.xxhash64(path, position(i), F.get(F.col("tokens"), position(i)))

    share = int((1 / similarity - 1) * 1_000_000)
    has_second = F.pmod(F.xxhash64(path, F.lit(3)), F.lit(1_000_000)) < share
    children = F.array(child(1), F.when(has_second & (position(1) != position(2)), child(2)))
    others = [c for c in nodes.columns if c != "path"]
    return nodes.select(F.explode(children).alias("path"), *others).where("path IS NOT NULL")


def _alike_pairs(classes: DataFrame, similarity: float, trees: int, leaf: int, need: int) -> DataFrame:
    """a, b: links between similar sketches that connect what meets in the nodes of all trees."""
    tokens = classes.select("node", "tokens")
    sketches = classes.select("node", "sketch")
    roots = F.explode(F.array(*[F.lit(t).cast("long") for t in range(trees)]))
    nodes = _branched(_branched(tokens.withColumn("path", roots), similarity), similarity)
    groups, linked = [], None  # to be compared; star links of what has been
    for depth in range(2, DEEPEST + 1):
        nodes = stage(nodes.drop("tokens"), "paths")
        sizes = nodes.groupBy("path").agg(F.count("*").alias("size")).where("size > 1")
        sized = stage(nodes.join(sizes, "path"), "sized-paths")
        groups.append(sized.where(F.col("size") <= leaf).select("path", F.lit(0).alias("block"), "node"))
        large = sized.where(F.col("size") > leaf)
        if large.isEmpty():
            break
        if depth in (CROWDED, DEEPEST):
            groups.append(_in_blocks(large, leaf))
            pairs = _compared(reduce(DataFrame.unionByName, groups), sketches, need)
            known = stage(components(pairs if linked is None else pairs.unionByName(linked)), "roots")
            linked = known.select(F.col("node").alias("a"), F.col("root").alias("b"))
            groups = []
            large = large.drop("root").join(known, "node", "left").withColumn("root", F.coalesce("root", "node"))
        if depth >= CROWDED or depth == DEEPEST:
            large = stage(_led(large, "path"), "crowds")
            ends = F.lit(True) if depth == DEEPEST else F.col("apart") <= leaf * FEW
            ended = large.where(ends).withColumns({"blocks": _blocks(leaf), "block": _block(leaf)})
            groups.append(_everywhere(ended, "path", "block"))
            large = large.where(~ends)
            if large.isEmpty():
                break
        columns = [c for c in ("path", "node", "root") if c in large.columns]
        nodes = _branched(large.select(*columns).join(tokens, "node"), similarity)
    pairs = _compared(reduce(DataFrame.unionByName, groups), sketches, need)
    return stage(pairs if linked is None else pairs.unionByName(linked), "pairs")


def _blocks(leaf: int) -> Column:
    return F.ceil(F.col("size") / leaf).cast("int")


def _block(leaf: int) -> Column:
    return F.pmod(F.xxhash64("node"), _blocks(leaf)).cast("int") + 1


def _is_lead(size: str) -> Column:
    """True for about LEADS members of a group, drawn by their hash."""
    return F.pmod(F.xxhash64("node", F.lit(5)), F.col(size)) < LEADS


def _in_blocks(large: DataFrame, leaf: int) -> DataFrame:
    """The members of large nodes in blocks numbered from 1, a few of them in every block."""
    every_block = F.sequence(F.lit(1), _blocks(leaf))
    block = F.explode(F.when(_is_lead("size"), every_block).otherwise(F.array(_block(leaf))))
    return large.select("path", block.alias("block"), "node")


def _led(rooted: DataFrame, group: str) -> DataFrame:
    """Adds `leads`, the most frequent root of the group, and `apart`, how many members have another one."""
    counts = rooted.groupBy(group, "root").agg(F.count("*").alias("n"))
    found = counts.groupBy(group).agg(
        F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("all")
    )
    found = found.select(
        group, F.col("most.root").alias("leads"), (F.col("all") - F.col("most.n")).alias("apart")
    )
    return rooted.join(found, group)


# Comparing nodes


def _alike(sketches: np.ndarray, one: np.ndarray, need: int) -> np.ndarray:
    return (sketches == one).sum(axis=1) >= need


def _grown(sketches: np.ndarray, need: int) -> Iterator[tuple[int, int]]:
    """Links that hold together whatever members can be reached from each other."""
    rest = np.arange(len(sketches))
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            member = frontier.pop(0)
            near = _alike(sketches[rest], sketches[member], need)
            for x in rest[near]:
                yield int(member), int(x)
                frontier.append(x)
            rest = rest[~near]


def _compared(groups: DataFrame, sketches: DataFrame, need: int) -> DataFrame:
    """a < b: links between similar sketches that connect each group (path, block, node) as far as it goes."""

    def links(rows: dict[str, np.ndarray]) -> Iterator[tuple]:
        path, block, node, sketch = (rows[c] for c in ("path", "block", "node", "sketch"))
        new = np.flatnonzero((path[1:] != path[:-1]) | (block[1:] != block[:-1])) + 1
        borders = np.concatenate(([0], new, [len(path)]))
        sizes = np.diff(borders)
        pairs = borders[:-1][sizes == 2]
        for i in pairs[(sketch[pairs] == sketch[pairs + 1]).sum(axis=1) >= need]:
            yield node[i], node[i + 1]
        for a, size in zip(borders[:-1][sizes > 2], sizes[sizes > 2]):
            for x, y in _grown(sketch[a : a + size], need):
                yield node[a + x], node[a + y]

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not len(batch):
                continue
            rows = {n: batch.column(n).to_numpy() for n in ("path", "block", "node")}
            data = b"".join(batch.column("sketch").to_pylist())
            rows["sketch"] = np.frombuffer(data, np.uint8).reshape(-1, POSITIONS)
            if held is not None:
                rows = {n: np.concatenate((held[n], rows[n])) for n in rows}
            # The last group may go on in the next batch.
            last = (rows["path"] == rows["path"][-1]) & (rows["block"] == rows["block"][-1])
            held = {n: v[last] for n, v in rows.items()}
            if not last.all():
                yield _pairs(links({n: v[~last] for n, v in rows.items()}))
        if held is not None:
            yield _pairs(links(held))

    rows = groups.join(sketches, "node").repartition("path", "block")
    ordered = rows.sortWithinPartitions("path", "block", "node")
    return ordered.mapInArrow(compare, "a long, b long").distinct()


def _pairs(found: Iterable[tuple]) -> pa.RecordBatch:
    a, b = zip(*rows) if (rows := list(found)) else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _everywhere(led: DataFrame, group: str, block: str) -> DataFrame:
    """The blocks (numbered from 1 to `blocks`) of groups in which some members' root is not the one that leads, with
    these members in every block."""
    every_block = F.sequence(F.lit(1), F.col("blocks"))
    blocks = F.when(F.col("root") != F.col("leads"), every_block).otherwise(F.array(F.col(block)))
    return led.where("apart > 0").select(group, F.explode(blocks).alias(block), "node")


# Confirming on full sets


def _linked(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Links between similar sets that connect whatever chains of similar sets connect."""
    if len(sets) == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        if 100 * common >= percent * (len(sets[0]) + len(sets[1]) - common):
            yield 0, 1
        return
    sizes = np.array([len(x) for x in sets])
    starts = np.cumsum(sizes) - sizes
    known, places = np.unique(np.concatenate(sets), return_inverse=True)
    marked = np.zeros(len(known), bool)
    left = np.ones(len(sets), bool)
    for i in range(len(sets)):
        if not left[i]:
            continue
        left[i] = False
        frontier = [i]
        while frontier and left.any():
            member = frontier.pop(0)
            own = places[starts[member] : starts[member] + sizes[member]]
            marked[own] = True
            common = np.add.reduceat(marked[places], starts, dtype=np.int64)
            marked[own] = False
            near = np.flatnonzero(left & (100 * common >= percent * (sizes + sizes[member] - common)))
            left[near] = False
            for x in near.tolist():
                yield member, x
                frontier.append(x)


def _confirmed(docs: DataFrame, units: DataFrame, percent: int, length: int) -> DataFrame:
    """a, b: links between members of one block of a unit (unit, block, node, least, h1, h2)."""

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = kept("words", WordHashes)
        at, nodes, sets = None, [], []

        def links() -> Iterator[tuple[int, int]]:
            for x, y in _linked(sets, percent) if len(sets) > 1 else ():
                yield min(nodes[x], nodes[y]), max(nodes[x], nodes[y])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("unit", "block", "node", "h1", "h2")]
            found = []
            for unit, block, node, h1, h2, text in zip(*columns, texts_of(batch)):
                if at != (unit, block):
                    found += links()
                    at, nodes, sets = (unit, block), [], []
                if nodes and nodes[-1] == node:
                    continue  # the same row again
                mine = shingles_of(text, hashes, length)
                key = np.frombuffer(xxhash.xxh3_128_digest(mine.tobytes()), np.int64)
                if key[0] == h1 and key[1] == h2:  # else another row with this doc_id
                    nodes.append(node)
                    sets.append(mine)
            yield _pairs(found)
        yield _pairs(links())

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    # Texts are shuffled at every size: members grow with the documents, so they are not to be broadcast.
    wanted = units.withColumnRenamed("least", "doc_id").hint("merge")
    rows = join_same(texts, wanted, ["doc_id"]).repartition("unit", "block")
    ordered = rows.sortWithinPartitions("unit", "block", "node")
    return stage(ordered.mapInArrow(confirm, "a long, b long").distinct(), "confirmed-links")


def similar_links(
    docs: DataFrame, classes: DataFrame, percent: int, length: int, recall: float, leaf: int, unit: int
) -> DataFrame:
    """a, b: links between classes of equal sets that connect whatever chains of similar sets connect."""
    similarity = percent / 100
    # Five standard deviations below what a pair on the limit has in common.
    need = math.floor(POSITIONS * similarity - 5 * math.sqrt(POSITIONS * similarity * (1 - similarity)))
    pairs = _alike_pairs(classes, similarity, trees_for(recall, similarity), leaf, need)
    members = components(pairs).withColumnRenamed("root", "unit").join(
        classes.select("node", "least", "h1", "h2", "n_shingles"), "node"
    )
    members = stage(members, "members")
    most = F.greatest(F.count("*") / unit, F.sum("n_shingles") / UNIT_SHINGLES)
    sizes = members.groupBy("unit").agg(F.count("*").alias("size"), F.ceil(most).cast("int").alias("blocks"))
    members = stage(members.join(sizes, "unit").drop("n_shingles"), "units")
    members = members.withColumn("block", (F.pmod(F.xxhash64("node"), "blocks") + 1).cast("int"))
    every_block = F.sequence(F.lit(1), F.col("blocks"))
    in_blocks = F.explode(F.when(_is_lead("size"), every_block).otherwise(F.array("block")))
    columns = ["unit", "block", "node", "least", "h1", "h2"]
    links = _confirmed(docs, members.withColumn("block", in_blocks).select(*columns), percent, length)
    large = members.where("blocks > 1")
    if large.isEmpty():
        return links
    roots = stage(components(links), "confirmed-roots")
    links = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    rooted = large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    again = _everywhere(_led(rooted, "unit"), "unit", "block")
    again = stage(again.join(classes.select("node", "least", "h1", "h2"), "node"), "open-units")
    if again.isEmpty():
        return links
    return links.unionByName(_confirmed(docs, again.select(*columns), percent, length))


def near_sets(
    docs: DataFrame,
    percent: int = 80,
    length: int = 5,
    recall: float = 0.999999,
    leaf: int = LEAF,
    unit: int = UNIT,
) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable) and kept, for every row. Runs jobs.

    Linked are sets with 100 * intersection >= percent * union; recall is the chance of finding a pair
    on that limit.
    """
    rows = _signatures(docs, length)
    classes = (
        rows.where("n_shingles > 0")
        .groupBy("h1", "h2")
        .agg(
            F.min("doc_id").alias("least"),
            F.max("n_shingles").alias("n_shingles"),
            F.first("tokens").alias("tokens"),
            F.first("sketch").alias("sketch"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = stage(classes, "classes")
    roots = components(similar_links(docs, classes, percent, length, recall, leaf, unit))
    rooted = classes.select("h1", "h2", "least", "node").join(roots, "node", "left")
    rooted = stage(rooted.withColumn("root", F.coalesce("root", "node")), "rooted-classes")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(rooted.join(least, "root").select("h1", "h2", "component_id"), "components")
    alone = rows.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    linked = rows.where("n_shingles > 0").join(named, ["h1", "h2"])
    columns = ["doc_id", "n_shingles", "component_id"]
    return linked.select(*columns).unionByName(alone.select(*columns)).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
