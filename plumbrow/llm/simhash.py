"""SimHash near-duplicates by pigeonhole blocks.

The fingerprint of a text has a bit set if more than half of its shingles' 64-bit hashes have it set.
Fingerprints that differ in at most d bits agree in at least n - d of n blocks, so they share the key of
some choice of n - d blocks. Distinct fingerprints are grouped by these keys, and within a key links
are verified by Hamming distance. n grows with the number of distinct fingerprints, so that keys
have enough bits to part unrelated fingerprints; every n finds the same links.

Within a key, components are grown one member at a time: a member is compared to all that are not
reached yet, and those near it are linked to it. Links between members that are in the same component
already are never made, so a dense group costs its size in links, not its square. A key with more than
`hot_key` members is not grown at once: its members are keyed again by more blocks, where keys have
32 bits and more.

Defined results: a text without words (NULL, empty or blank) has fingerprint zero and is linked like any
other; fewer words than a shingle make one shingle; equal texts share a fingerprint, and rows that
repeat are rows of the same group; a NULL doc_id counts for its fingerprint but names no component,
and a component of NULL ids alone has component_id NULL; an empty table gives no rows. Input columns
are returned as they are in the struct `doc`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrow.llm.common import stage, text_or_empty, texts_of
from plumbrow.llm.components import components

BITS = 64
_HOT_KEY = 20_000


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """The SimHash of a text; A-Z count as a-z."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(words) - shingle + 1)
    last = ends[-n:] - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), last.tolist())),
        dtype=np.uint64,
        count=n,
    )
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(counts * 2 > n)
    return int.from_bytes(majority.tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc (all input columns), doc_id, fp (the fingerprint as a signed long)."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in texts_of(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("doc_id"), pa.array(found.view(np.int64))],
                ["doc", "doc_id", "fp"],
            )

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty("text").alias("text"),
    )
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc {kind}, doc_id long, fp long")


def n_blocks(n: int, distance: int) -> int:
    """The fewest blocks whose keys have two bits more than n fingerprints need, 24 at most."""
    for blocks in range(distance + 1, 24):
        if (blocks - distance) * (BITS // blocks) >= max(1, n).bit_length() + 2:
            return blocks
    return 24


def block_masks(blocks: int, distance: int) -> list[int]:
    """One mask for each choice of blocks - distance blocks."""
    borders = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(borders, borders[1:])]
    return [sum(chosen) for chosen in combinations(masks, blocks - distance)]


def _keyed(fps: DataFrame, blocks: int, distance: int) -> DataFrame:
    masks = np.array(block_masks(blocks, distance), np.uint64).view(np.int64).tolist()
    keys = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for i, m in enumerate(masks)])
    return fps.select("fp", F.explode(keys).alias("k")).select("k.t", "k.key", "fp")


def grown(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect all members of a key that can be reached from each other."""
    links = []
    rest = fps
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            member = frontier.pop()
            near = np.bitwise_count(rest ^ member) <= distance
            if near.any():
                found = rest[near]
                links.extend((int(member), x) for x in found.tolist())
                frontier.extend(found)
                rest = rest[~near]
    return links


def _links_of_keys(keyed: DataFrame, distance: int, hot_key: int | None) -> DataFrame:
    """a, b: links; or, with b NULL, the members of keys that have more than hot_key of them."""

    def grow(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            joined = pd.concat(held) if len(held) > 1 else batch
            # The last key may go on in the next batch.
            last = (joined["t"] == joined["t"].iloc[-1]) & (joined["key"] == joined["key"].iloc[-1])
            held = [joined[last]]
            yield _grown_keys(joined[~last], distance, hot_key)
        if held:
            yield _grown_keys(held[0], distance, hot_key)

    spread = keyed.repartition("t", "key").sortWithinPartitions("t", "key", "fp")
    return spread.mapInPandas(grow, "a long, b long")


def _grown_keys(rows: pd.DataFrame, distance: int, hot_key: int | None) -> pd.DataFrame:
    fps = rows["fp"].to_numpy(np.int64).view(np.uint64)
    t, key = rows["t"].to_numpy(), rows["key"].to_numpy()
    a, b = [], []
    if len(fps) > 1:
        new = np.concatenate(([True], (t[1:] != t[:-1]) | (key[1:] != key[:-1]), [True]))
        borders = np.flatnonzero(new)
        sizes = np.diff(borders)
        pairs = borders[:-1][sizes == 2]
        near = pairs[np.bitwise_count(fps[pairs] ^ fps[pairs + 1]) <= distance]
        a, b = fps[near].tolist(), fps[near + 1].tolist()
        for start, size in zip(borders[:-1][sizes > 2], sizes[sizes > 2]):
            members = fps[start : start + size]
            if hot_key is not None and size > hot_key:
                a.extend(members.tolist())
                b.extend([None] * len(members))
            else:
                for x, y in grown(members, distance):
                    a.append(x)
                    b.append(y)
    signed = lambda values: pd.array(
        [None if v is None else v - (1 << 64) if v >> 63 else v for v in values], dtype="Int64"
    )
    return pd.DataFrame({"a": signed(a), "b": signed(b)})


def near_links(fps: DataFrame, distance: int = 4, hot_key: int = _HOT_KEY) -> DataFrame:
    """Links (a, b) that connect whatever chains of near fingerprints connect; fps: distinct `fp`."""
    blocks = n_blocks(fps.count(), distance)
    found = stage(_links_of_keys(_keyed(fps, blocks, distance), distance, hot_key), "near-links")
    hot = found.filter("b IS NULL").select(F.col("a").alias("fp")).distinct()
    links = found.filter("b IS NOT NULL")
    if blocks < 2 * distance and not hot.isEmpty():
        more = _keyed(stage(hot, "hot-fingerprints"), 2 * distance, distance)
        links = links.union(_links_of_keys(more, distance, None))
    elif not hot.isEmpty():
        links = links.union(_links_of_keys(_keyed(hot, blocks + 1, distance), distance, None))
    return links


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """doc (all input columns), fp, root (one for each group) and component_id of every row."""
    rows = stage(fingerprints(docs, shingle), "fingerprints")
    fps = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(near_links(fps.select("fp"), distance))
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(rooted.join(groups, "root").select("fp", "root", "component_id"), "groups")
    return rows.join(named, "fp").select("doc", "fp", "root", "component_id")


def hex_of(fp: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def first_of_each(grouped: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest doc_id, with its input columns."""
    kept = grouped.filter(F.col("doc.doc_id").eqNullSafe(F.col("component_id")))
    return kept.dropDuplicates(["root"]).select("doc.*")
