"""Decontamination: one Aho-Corasick automaton over the windows of all benchmark items.

Texts and items are normalised to words (letters, digits, non-ASCII characters; A-Z lower-cased) with
one space between. The automaton holds every window of `window` words of every item (a shorter item
is one window) with a space at both ends, and each text is scanned once. A hit covers the words of the
window; spans of hit words are mapped back to character offsets of the original text.

The benchmark is sent to all tasks in blocks of at most `block_bytes` of item text; texts pass the
blocks' automata one after the other in the same stage, so a benchmark of any size is used whole.

Defined results: a NULL or empty text, or one without words, is not hit and not contaminated; an item
without words hits nothing; equal item_ids count once, a NULL item_id counts as the empty id; repeated
rows are judged each; an empty benchmark hits nothing, an empty table gives no rows. Input columns are
returned as they are in the struct `doc`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from uuid import uuid4

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrow.llm.common import WORD_BYTES, kept, text_or_empty, texts_of

FOUND = (
    "n_words long, n_hit long, items array<string>, "
    "spans array<struct<start: long, stop: long>>"
)
_FOUND = pa.schema(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
    ]
)


def windows_of(item: bytes, window: int) -> set[bytes]:
    words = item.translate(WORD_BYTES).split()
    n = max(1, len(words) - window + 1) if words else 0
    return {b" " + b" ".join(words[i : i + window]) + b" " for i in range(n)}


def automaton(items: list[tuple[str, bytes]], window: int) -> ahocorasick.Automaton:
    """Its entries give a window's number of words and the items that have it."""
    holders: dict[bytes, set[str]] = {}
    for name, text in items:
        for found in windows_of(text, window):
            holders.setdefault(found, set()).add(name)
    built = ahocorasick.Automaton()
    for found, names in holders.items():
        # Bytes go in as Latin-1, one character for each.
        built.add_word(found.decode("latin-1"), (len(found), found.count(b" ") - 1, sorted(names)))
    if holders:
        built.make_automaton()
    return built


class Words:
    """The words of a text and their places."""

    def __init__(self, text: bytes):
        self.text = text.translate(WORD_BYTES)
        self.words = self.text.split()

    def covered(self, hits: list[tuple[int, int]]) -> np.ndarray:
        """Which words lie in one of the ranges."""
        edges = np.zeros(len(self.words) + 1, np.int64)
        for a, b in hits:
            edges[a] += 1
            edges[b] -= 1
        return np.cumsum(edges[:-1]) > 0

    def spans(self, hit: np.ndarray, original: bytes) -> list[dict]:
        """Hit words' character offsets in the original text, runs of words together."""
        runs = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
        inside = np.frombuffer(self.text, np.uint8) != 32
        borders = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
        starts_character = (np.frombuffer(original, np.uint8) & 0xC0) != 0x80
        characters = np.concatenate(([0], np.cumsum(starts_character)))
        return [
            {"start": int(characters[borders[a, 0]]), "stop": int(characters[borders[b - 1, 1]])}
            for a, b in runs
        ]


def found_in(
    text: Words, built: ahocorasick.Automaton
) -> Iterator[tuple[int, int, list[str]]]:
    """First word, word after the last, and items of every occurrence of a window."""
    if not text.words or not len(built):
        return
    joined = (b" " + b" ".join(text.words) + b" ").decode("latin-1")
    starts = None
    for end, (size, n_words, names) in built.iter(joined):
        if starts is None:
            lengths = np.fromiter(map(len, text.words), np.int64, len(text.words))
            starts = np.concatenate(([0], np.cumsum(lengths[:-1] + 1)))
        first = int(np.searchsorted(starts, end - size + 1))
        yield first, first + n_words, names


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark's items, block by block; the benchmark is a query set."""
    block: list[tuple[str, bytes]] = []
    size = 0
    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        text_or_empty("text").alias("text"),
    )
    for row in rows.toLocalIterator():
        text = row["text"].encode()
        if size and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((row["item"], text))
        size += len(text)
    if block:
        yield block


def _taken(shared: Broadcast) -> tuple[str, list[tuple[str, bytes]]]:
    """A broadcast value, which the worker does not keep."""
    value = shared.value
    shared.__dict__.pop("_value", None)
    return value


def _held(batches: Iterable[pa.RecordBatch], at_least: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in lists of so many bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= at_least:
            yield held
            held = []
    if held:
        yield held


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    block_bytes: int = 8 << 20,
    texts_bytes: int = 64 << 20,
) -> DataFrame:
    """doc (all input columns), n_words, n_hit, items (sorted ids), spans (of hit words).

    A benchmark of more than block_bytes passes the driver and the workers block by block; texts_bytes of
    documents then meet one block's automaton after the other, each of which is released before the next.
    """
    context = docs.sparkSession.sparkContext
    shared = [context.broadcast((uuid4().hex, b)) for b in _blocks(benchmark, block_bytes)]
    several = len(shared) > 1

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held(batches, texts_bytes if several else 0):
            hits: dict[tuple[int, int], list[tuple[int, int]]] = {}
            items: dict[tuple[int, int], set[str]] = {}
            for block in shared:
                name, found = _taken(block) if several else block.value
                built = kept((name, window), lambda found=found: automaton(found, window))
                for k, batch in enumerate(held):
                    for i, text in enumerate(texts_of(batch)):
                        for first, last, names in found_in(Words(text), built):
                            hits.setdefault((k, i), []).append((first, last))
                            items.setdefault((k, i), set()).update(names)
            for k, batch in enumerate(held):
                rows = []
                for i, text in enumerate(texts_of(batch)):
                    words = Words(text)
                    hit = words.covered(hits[k, i]) if (k, i) in hits else None
                    rows.append(
                        {
                            "n_words": len(words.words),
                            "n_hit": 0 if hit is None else int(hit.sum()),
                            "items": sorted(items.get((k, i), ())),
                            "spans": [] if hit is None else words.spans(hit, text),
                        }
                    )
                found = pa.RecordBatch.from_pylist(rows, schema=_FOUND)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc"), *found.columns], ["doc", *found.schema.names]
                )

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        text_or_empty("text").alias("text"),
    )
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc {kind}, {FOUND}")


def contaminated(hit_in: int = 20) -> Column:
    """At least one word in hit_in is hit."""
    return (F.col("n_hit") > 0) & (hit_in * F.col("n_hit") >= F.col("n_words"))


def items_digest() -> Column:
    return F.sha2(F.array_join("items", ",").cast("binary"), 256)
