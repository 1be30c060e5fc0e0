"""Substring deduplication over prefix-partitioned suffix trees.

Every word starts a suffix of its document, looked at to a depth of `window` words. A suffix is written
as a 64-bit path: five bits for each of its first words (the branches taken near the root) and the
rest a hash of all its words (the last, long edge). Sorted paths are the leaves of the suffix tree
from left to right; leaves that agree hang from one internal node at the full depth, which is a repeat of
`window` words. Whatever is longer repeats in all its windows, so these nodes decide what is removed.

1. Prefixes of variable length split the tree into subtrees that fit in memory: prefixes of three words are
   counted over the whole corpus, and those with more than `group` suffixes are counted three words (or
   15 bits of the last edge) deeper, until none is too large. Neighbouring small ones share a group.
2. Documents are dealt to blocks of consecutive doc_ids and some megabytes. A block sends each group its
   distinct paths, sorted, in one row. So a passage that a third of all documents share is sent once by a
   block, and since a smaller block holds smaller ids, no ids need to be sent.
3. A group merges its paths and finds its subtree's deep internal nodes. It answers every block which of the
   paths another block holds as well, as a bit for each path sent.
4. Paths never decide, as windows that begin with the same words share most of their bits. A block sends
   the 128-bit hashes of the words of all windows on such paths to the same groups, which answer with a
   bit for each hash that an earlier block holds as well.
5. A block drops each word covered by a window that an earlier block, or a document with a smaller id in
   the same block, holds too, by its 128 bits.

`maximal_repeats` follows the subtrees below these nodes and returns their maximal repeats.

Words are found and hashed for a block at once (plumbrow.llm.words). The 128 bits of a window do not depend on its
path: two different windows agree in them once in 10^38 pairs, however many begin alike.

Defined results: a NULL or empty text has no words; a NULL doc_id counts as greater than any, and all NULL
ids as one document, as do rows that repeat a doc_id: they lose nothing to each other; an empty table
gives no rows. Other input columns are returned as they are in the struct `doc`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbrow.llm.common import (
    block_of_id,
    blocked,
    id_borders,
    shuffle_partitions,
    stage,
    text_bytes,
    text_or_empty,
    texts_of,
)
from plumbrow.llm.mph import mixed
from plumbrow.llm.words import Words

WINDOW = 13
_SYMBOL = 5
_BRANCHES = 6
_STEP_BITS = 15  # three symbols
_GROUP = 2_000_000
_NO_ID = (1 << 63) - 1
_WINDOW_TIMES = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))
#: Bytes of text in a block.
_BLOCK = 4 << 20

PATHS = "block int, part int, paths binary"
ANSWERS = "block int, part int, known binary, exact boolean"
HASHES = "block int, part int, hashes binary"


def paths_of(hashes: np.ndarray, window: int) -> np.ndarray:
    """The path of the suffix at each place that has `window` words."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    whole = np.zeros(n, np.uint64)
    for k in range(window):
        whole *= np.uint64(0x9E3779B97F4A7C15)
        whole += hashes[k : k + n]
    branches = min(_BRANCHES, window)
    path = mixed(whole, 1) >> np.uint64(_SYMBOL * branches)
    for k in range(branches):
        symbol = hashes[k : k + n] >> np.uint64(64 - _SYMBOL)
        path |= symbol << np.uint64(64 - _SYMBOL * (k + 1))
    return path


class Block:
    """The words and paths of some documents, in ascending order of their ids."""

    def __init__(self, texts: Sequence[bytes], window: int):
        self.window = window
        self.words = Words(texts)
        self._hashes = self.words.hashes()
        paths = paths_of(self._hashes[0], window)
        ends = self.words.ends
        sizes = np.diff(ends, prepend=0)
        self.document = np.repeat(np.arange(len(ends)), sizes)
        left = np.repeat(ends, sizes) - np.arange(len(self.words))
        self.starts = np.flatnonzero(left[: len(paths)] >= window)
        self.paths = paths[self.starts]

    def word_numbers(self) -> np.ndarray:
        return self._hashes[0].view(np.int64)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct paths, and whether each is here more than once."""
        paths = np.sort(self.paths)
        new = np.flatnonzero(np.concatenate(([True], paths[1:] != paths[:-1]))[: len(paths)])
        return paths[new], np.diff(new, append=len(paths)) > 1

    def hashes_at(self, starts: np.ndarray) -> np.ndarray:
        """128-bit hashes of the windows that begin at these words, a row of two numbers each."""
        out = np.empty((len(starts), 2), np.uint64)
        for k, times in enumerate(_WINDOW_TIMES):
            total = np.zeros(len(starts), np.uint64)
            for i in range(self.window):
                total *= times
                total += self._hashes[1 - k][starts + i]
            out[:, k] = mixed(total, k + 2)
        return out


def among(values: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Places of the values that are among the chosen ones, which are sorted and distinct.

    A table of the low bits, which are hashed, leaves few to be looked up.
    """
    if not len(chosen):
        return np.zeros(0, np.int64)
    low = np.uint64((1 << max(16, len(chosen).bit_length() + 3)) - 1)
    table = np.zeros(int(low) + 1, bool)
    table[chosen & low] = True
    maybe = np.flatnonzero(table[values & low])
    at = np.minimum(np.searchsorted(chosen, values[maybe]), len(chosen) - 1)
    return maybe[chosen[at] == values[maybe]]


def ranked(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of rows of two numbers, and whether each in this order equals the one before."""
    order = np.lexsort((hashes[:, 1], hashes[:, 0]))
    rows = hashes[order]
    return order, np.concatenate(([False], (rows[1:] == rows[:-1]).all(axis=1)))[: len(rows)]


def prefix_counts(docs: DataFrame, window: int, bits: int, within: DataFrame | None) -> DataFrame:
    """prefix, n: suffixes under each prefix of so many bits; only under the given shorter prefixes, if any."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        few = bits <= _STEP_BITS
        sums = np.zeros(1 << _STEP_BITS, np.int64) if few else None
        for texts in _some_texts(batches):
            prefixes = Block(texts, window).paths >> np.uint64(64 - bits)
            if few:
                sums += np.bincount(prefixes.astype(np.int64), minlength=len(sums))
                continue
            yield _counted(*np.unique(prefixes, return_counts=True))
        if few:
            yield _counted(np.flatnonzero(sums), sums[sums > 0])

    texts = docs.select(text_or_empty("text").alias("text"))
    counted = texts.mapInArrow(count, "prefix long, n long")
    if within is not None:
        shorter = F.shiftrightunsigned("prefix", _STEP_BITS).alias("shorter")
        inside = within.select(F.col("prefix").alias("shorter"))
        counted = counted.withColumn("shorter", shorter).join(inside, "shorter", "left_semi")
    return counted.groupBy("prefix").agg(F.sum("n").alias("n"))


def _counted(prefixes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(prefixes.astype(np.int64)), pa.array(n.astype(np.int64))], ["prefix", "n"]
    )


def _some_texts(batches: Iterable[pa.RecordBatch], at_once: int = 4 << 20) -> Iterator[list[bytes]]:
    held: list[bytes] = []
    size = 0
    for batch in batches:
        for text in texts_of(batch):
            held.append(text)
            size += len(text)
            if size >= at_once:
                yield held
                held, size = [], 0
    if held:
        yield held


def group_borders(docs: DataFrame, window: int, group: int, groups: int) -> np.ndarray:
    """The first path of each group; at most `group` suffixes in one, and about `groups` at least.

    The shortest prefixes, 32,768 at most, are counted on the driver. Longer ones stay in a table, where
    running sums under each shorter prefix form the groups; the driver gets the groups' borders.
    """
    counts = stage(prefix_counts(docs, window, _STEP_BITS, None), "prefix-counts")
    rows = counts.orderBy("prefix").collect()
    limit = max(1, min(group, sum(r["n"] for r in rows) // groups))
    borders, held = [0], 0
    for row in rows:
        start = row["prefix"] << (64 - _STEP_BITS)
        if held + row["n"] > limit and start > borders[-1]:
            borders.append(start)
            held = 0
        held += row["n"]
    bits = _STEP_BITS
    heavy = counts.where(F.col("n") > group)
    while bits + _STEP_BITS <= 64 and not heavy.isEmpty():
        bits += _STEP_BITS
        counts = stage(prefix_counts(docs, window, bits, heavy), "prefix-counts")
        before = Window.partitionBy("shorter").orderBy("prefix")
        upto = F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1))
        own = counts.withColumn("shorter", F.shiftrightunsigned("prefix", _STEP_BITS)).select(
            "shorter", "prefix", F.floor(F.coalesce(upto, F.lit(0)) / limit).alias("part")
        )
        found = own.groupBy("shorter", "part").agg(F.min("prefix").alias("prefix")).collect()
        borders += [r["prefix"] << (64 - bits) for r in found]
        heavy = counts.where(F.col("n") > group)
        if found:
            # A group ends where the heavy prefix before it does.
            after = {(r["shorter"] + 1) << (64 - bits + _STEP_BITS) for r in found}
            borders += [x for x in after if x < 1 << 64]
    return np.array(sorted(set(borders)), np.uint64)


def packed_paths(paths: np.ndarray) -> bytes:
    """Byte by byte over all paths: sorted paths share their high bytes, which then compress."""
    return paths.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked_paths(data: bytes) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(8, -1).T
    return np.ascontiguousarray(rows).view(">u8").ravel().astype(np.uint64)


def _answers(key: tuple, blocks: np.ndarray, known: np.ndarray, sizes: list[int], exact: bool) -> pa.Table:
    out = np.split(known, np.cumsum(sizes)[:-1])
    return pa.table(
        {
            "block": pa.array(blocks, pa.int32()),
            "part": pa.array([key[0].as_py()] * len(blocks), pa.int32()),
            "known": pa.array([np.packbits(x).tobytes() for x in out], pa.binary()),
            "exact": pa.array([exact] * len(blocks), pa.bool_()),
        }
    )


def _subtree(key: tuple, rows: pa.Table) -> pa.Table:
    """Which paths several blocks hold: the deep internal nodes."""
    lists = [unpacked_paths(x) for x in rows.column("paths").to_pylist()]
    paths = np.concatenate(lists)
    leaves = np.sort(paths)
    deep = leaves[1:][leaves[1:] == leaves[:-1]]
    shared = np.zeros(len(paths), bool)
    shared[among(paths, np.unique(deep))] = True
    return _answers(key, rows.column("block").to_numpy(), shared, [len(x) for x in lists], False)


def _confirmed(key: tuple, rows: pa.Table) -> pa.Table:
    """Which windows an earlier block holds."""
    blocks = rows.column("block").to_numpy()
    order = np.argsort(blocks, kind="stable")
    blobs = rows.column("hashes").to_pylist()
    lists = [np.frombuffer(blobs[i], np.uint64).reshape(-1, 2) for i in order]
    hashes = np.concatenate(lists)
    ranks, again = ranked(hashes)  # equal hashes stay in the order of their blocks
    known = np.zeros(len(hashes), bool)
    known[ranks[again]] = True
    return _answers(key, blocks[order], known, [len(x) for x in lists], True)


def _bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _in_order(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The order of the rows by id, NULL last, and the ids and texts in that order."""
    ids = rows.column("id").fill_null(_NO_ID).to_numpy()
    order = np.argsort(ids, kind="stable")
    texts = rows.column("text").combine_chunks().cast(pa.large_binary())
    return order, ids[order], [texts[int(i)].as_py() or b"" for i in order]


def _in_chunks(texts: pa.Array, most: int = 1 << 30) -> pa.ChunkedArray:
    """Texts as strings of 32-bit offsets, in as many chunks as these need."""
    chunks, first, held = [], 0, 0
    for i, size in enumerate(pc.binary_length(texts).to_pylist()):
        if held and held + size > most:
            chunks.append(texts.slice(first, i - first).cast(pa.string()))
            first, held = i, 0
        held += size
    chunks.append(texts.slice(first).cast(pa.string()))
    return pa.chunked_array(chunks)


@dataclass
class _Tree:
    """The blocks of documents, the first path of each group, and the groups' answers to the blocks."""

    blocks: DataFrame
    borders: np.ndarray
    shared: DataFrame


def _tree(docs: DataFrame, window: int, group: int, block_bytes: int) -> _Tree:
    spark = docs.sparkSession
    ends = id_borders(docs, block_bytes, text_bytes())
    borders = group_borders(docs, window, group, 2 * shuffle_partitions(spark))
    # In id order, so that smaller blocks hold smaller ids; NULL ids are in the last block.
    blocks = blocked(docs, len(ends) + 1, block_of_id(ends, null_block=len(ends)))

    def send(key: tuple, rows: pa.Table) -> pa.Table:
        _, _, texts = _in_order(rows)
        paths, _ = Block(texts, window).distinct()
        cuts = np.searchsorted(paths, borders[1:])
        out = [
            (i, packed_paths(part)) for i, part in enumerate(np.split(paths, cuts)) if len(part)
        ]
        return pa.table(
            {
                "block": pa.array([key[0].as_py()] * len(out), pa.int32()),
                "part": pa.array([i for i, _ in out], pa.int32()),
                "paths": pa.array([data for _, data in out], pa.binary()),
            }
        )

    sent = blocks.groupBy("block").applyInArrow(send, PATHS)
    return _Tree(blocks, borders, sent.groupBy("part").applyInArrow(_subtree, ANSWERS))


def _shared_paths(
    block: Block, borders: np.ndarray, answers: list[dict]
) -> tuple[np.ndarray, np.ndarray]:
    """The distinct paths that another block holds, and those that are here more than once."""
    paths, here = block.distinct()
    cuts = np.concatenate(([0], np.searchsorted(paths, borders[1:]), [len(paths)]))
    shared = np.zeros(len(paths), bool)
    for answer in answers:
        if not answer["exact"]:
            a, b = cuts[answer["part"]], cuts[answer["part"] + 1]
            shared[a:b] = _bits(answer["known"], b - a)
    return paths[shared], paths[here]


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last + 1 of each stretch of equal values."""
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))[: len(values)])
    return zip(first.tolist(), [*first[1:].tolist(), len(values)])


def _by_group(block: Block, borders: np.ndarray, chosen: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Group by group: its number and the suffixes of the block on the chosen paths."""
    mine = among(block.paths, chosen)
    part = np.searchsorted(borders, block.paths[mine], "right") - 1
    order = np.argsort(part, kind="stable")
    for a, z in _runs(part[order]):
        yield int(part[order[a]]), mine[order[a:z]]


def without_repeats(
    docs: DataFrame, window: int = WINDOW, group: int = _GROUP, block_bytes: int = _BLOCK
) -> DataFrame:
    """doc (all input columns but the text), kept_text, n_words, n_removed, spans of every row.

    spans: the removed runs of words, from the first to the one after the last.
    """
    tree = _tree(docs, window, group, block_bytes)
    blocks, borders, shared = tree.blocks, tree.borders, tree.shared
    kind = blocks.schema["doc"].dataType.simpleString()

    def asked_of(block: Block, chosen: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Group by group: its number, the suffixes to ask it about, their windows' hashes."""
        for part, mine in _by_group(block, borders, chosen):
            yield part, mine, block.hashes_at(block.starts[mine])

    def confirm(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        _, _, texts = _in_order(rows)
        block = Block(texts, window)
        shared, _ = _shared_paths(block, borders, answers.to_pylist())
        parts, lists = [], []
        for part, _, hashes in asked_of(block, shared):
            order, again = ranked(hashes)
            parts.append(part)
            lists.append(hashes[order[~again]].tobytes())
        return pa.table(
            {
                "block": pa.array([key[0].as_py()] * len(parts), pa.int32()),
                "part": pa.array(parts, pa.int32()),
                "hashes": pa.array(lists, pa.binary()),
            }
        )

    def repeats(block: Block, ids: np.ndarray, answers: list[dict]) -> np.ndarray:
        """Whether an earlier block or a smaller id in this one holds each suffix's window."""
        shared, here = _shared_paths(block, borders, answers)
        repeated = np.zeros(len(block.starts), bool)
        mine = among(block.paths, here)  # in the order of the ids
        order, again = ranked(block.hashes_at(block.starts[mine]))
        holder = ids[block.document[block.starts[mine[order]]]]
        first = np.maximum.accumulate(np.where(again, 0, np.arange(len(order))))
        repeated[mine[order]] = holder[first] < holder
        exact = {x["part"]: x["known"] for x in answers if x["exact"]}
        for part, asked, hashes in asked_of(block, shared):
            order, again = ranked(hashes)
            listed = np.cumsum(~again) - 1
            repeated[asked[order]] |= _bits(exact[part], listed[-1] + 1)[listed]
        return repeated

    def drop(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        order, ids, texts = _in_order(rows)
        block = Block(texts, window)
        repeated = repeats(block, ids, answers.to_pylist())
        n, ends = len(block.words), block.words.ends
        edges = np.bincount(block.starts[repeated], minlength=n + 1)
        edges = edges - np.bincount(block.starts[repeated] + window, minlength=n + 1)
        removed = np.cumsum(edges[:n]) > 0
        gone_before = np.concatenate(([0], np.cumsum(removed)))[np.concatenate(([0], ends))]
        kept, spans, start = block.words.joined(~removed), [], 0
        n_removed = np.diff(gone_before)
        for end, any_gone in zip(ends.tolist(), n_removed > 0):
            if any_gone:
                mine = removed[start:end].astype(np.int8)
                runs = np.flatnonzero(np.diff(mine, prepend=0, append=0)).reshape(-1, 2)
                spans.append([{"first": int(a), "stop": int(b)} for a, b in runs])
            else:
                spans.append([])
            start = end
        span = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))
        texts = pa.array(kept, pa.large_binary()).cast(pa.large_string())
        return pa.Table.from_arrays(
            [
                rows.column("doc").take(pa.array(order)),
                _in_chunks(texts),
                pa.chunked_array([pa.array(np.diff(ends, prepend=0), pa.int64())]),
                pa.chunked_array([pa.array(n_removed, pa.int64())]),
                pa.chunked_array([pa.array(spans, span)]),
            ],
            ["doc", "kept_text", "n_words", "n_removed", "spans"],
        )

    asked = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(confirm, HASHES)
    answers = shared.unionByName(asked.groupBy("part").applyInArrow(_confirmed, ANSWERS))
    return (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            drop,
            f"doc {kind}, kept_text string, n_words long, n_removed long, "
            "spans array<struct<first: long, stop: long>>",
        )
    )


# Maximal repeats

LEFTS = "block int, part int, paths binary, lefts binary"
RECORDS = (
    "part int, words binary, offsets array<int>, lefts array<long>, mixed array<boolean>, n long, "
    "doc_id long, first long"
)
REPEATS = "n_words long, n_occurrences long, doc_id long, first long"
_LEAF = 1 << 62


def _left_words(block: Block, number: int) -> np.ndarray:
    """A number for the word before each suffix; for the first of a text one of its own."""
    words, ends = block.word_numbers(), block.words.ends
    documents = block.document[block.starts]
    begins = mixed(np.arange(len(ends), dtype=np.uint64) + np.uint64(number << 32), 9).view(np.int64)
    is_first = np.concatenate(([0], ends[:-1]))[documents] == block.starts
    return np.where(is_first, begins[documents], words[block.starts - 1])


def _diverse(key: tuple, rows: pa.Table) -> pa.Table:
    """Which paths come after different words. A block sends each path once for each word before it."""
    lists = [np.frombuffer(x, np.uint64) for x in rows.column("paths").to_pylist()]
    lefts = np.concatenate([np.frombuffer(x, np.int64) for x in rows.column("lefts").to_pylist()])
    paths = np.concatenate(lists)
    order = np.lexsort((lefts, paths))
    same = paths[order[1:]] == paths[order[:-1]]
    differ = same & (lefts[order[1:]] != lefts[order[:-1]])
    found = np.zeros(len(paths), bool)
    found[among(paths, np.unique(paths[order[1:][differ]]))] = True
    return _answers(key, rows.column("block").to_numpy(), found, [len(x) for x in lists], True)


def _lefts_sent(
    block: Block, borders: np.ndarray, often: np.ndarray, lefts: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Group by group: its number, its suffixes by path and word before, and which of these are new."""
    for part, mine in _by_group(block, borders, often):
        order = np.lexsort((lefts[mine], block.paths[mine]))
        mine = mine[order]
        p, x = block.paths[mine], lefts[mine]
        new = np.concatenate(([True], (p[1:] != p[:-1]) | (x[1:] != x[:-1])))
        yield part, mine, new


def maximal_repeats(
    docs: DataFrame, window: int = WINDOW, group: int = _GROUP, block_bytes: int = _BLOCK
) -> DataFrame:
    """n_words, n_occurrences, doc_id and first word of the first occurrence of every maximal repeat of at least
    `window` words: a sequence that occurs more than once and would lose occurrences if a word on either side
    were added. Every row is a text of its own here; a NULL doc_id comes last.

    Only suffixes on deep nodes go on, and of these only those that come after different words. A block
    sends a subtree the words from there to where repeats end, equal ones once with their number; the subtree's
    suffixes are sorted by doubling depth, and the common words of neighbours give its internal nodes.
    """
    tree = _tree(docs, window, group, block_bytes)
    blocks, borders, shared = tree.blocks, tree.borders, tree.shared

    def often(block: Block, answers: list[dict]) -> np.ndarray:
        return np.unique(np.concatenate(_shared_paths(block, borders, answers)))

    def send_lefts(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(_in_order(rows)[2], window)
        lefts = _left_words(block, key[0].as_py())
        parts, paths, before = [], [], []
        chosen = often(block, answers.to_pylist())
        for part, mine, new in _lefts_sent(block, borders, chosen, lefts):
            parts.append(part)
            paths.append(block.paths[mine[new]].tobytes())
            before.append(lefts[mine[new]].tobytes())
        return pa.table(
            {
                "block": pa.array([key[0].as_py()] * len(parts), pa.int32()),
                "part": pa.array(parts, pa.int32()),
                "paths": pa.array(paths, pa.binary()),
                "lefts": pa.array(before, pa.binary()),
            }
        )

    def send_words(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        _, ids, texts = _in_order(rows)
        block = Block(texts, window)
        answers = answers.to_pylist()
        exact = {x["part"]: x["known"] for x in answers if x["exact"]}
        chosen = often(block, answers)
        is_often = np.zeros(len(block.starts), bool)
        is_often[among(block.paths, chosen)] = True
        # The first suffix after each from which no repeat goes on.
        starts = block.starts
        document = block.document[starts]
        goes_on = (starts[1:] == starts[:-1] + 1) & (document[1:] == document[:-1])
        stops = ~is_often | ~np.concatenate((goes_on, [False]))[: len(starts)]
        ends = np.flatnonzero(stops)
        lefts, words = _left_words(block, key[0].as_py()), block.word_numbers()
        first_word = np.concatenate(([0], block.words.ends[:-1]))
        out: dict[tuple, list] = {}
        for part, mine, new in _lefts_sent(block, borders, chosen, lefts):
            listed = np.cumsum(new) - 1
            diverse = np.sort(mine[_bits(exact[part], int(listed[-1]) + 1)[listed]])
            last = ends[np.searchsorted(ends, diverse)] if len(diverse) else diverse
            for a, z in _runs(last):
                some, end = diverse[a:z], int(last[a])
                until = starts[end] + window - (0 if is_often[end] else 1)
                data = words[starts[some[0]] : until].tobytes()
                offsets = tuple((starts[some] - starts[some[0]]).tolist())
                holder = int(document[some[0]])
                found = out.get((part, data, offsets))
                if found is None:
                    at = int(starts[some[0]] - first_word[holder])
                    out[part, data, offsets] = [lefts[some], np.zeros(len(some), bool), 1, int(ids[holder]), at]
                else:
                    found[1] |= found[0] != lefts[some]
                    found[2] += 1
        columns = list(zip(*[(p, d, o, x[0].tolist(), x[1].tolist(), *x[2:]) for (p, d, o), x in out.items()]))
        names = ["part", "words", "offsets", "lefts", "mixed", "n", "doc_id", "first"]
        kinds = [pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.bool_())]
        kinds += [pa.int64()] * 3
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns or [[]] * 8, kinds)})

    def nodes(key: tuple, rows: pa.Table) -> pa.Table:
        found = list(_maximal(rows.to_pylist(), window))
        names = [c.split()[0] for c in REPEATS.split(", ")]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, zip(*found) if found else [[]] * 4)})

    asked = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(send_lefts, LEFTS)
    answers = shared.unionByName(asked.groupBy("part").applyInArrow(_diverse, ANSWERS))
    records = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(send_words, RECORDS)
    repeats = records.groupBy("part").applyInArrow(nodes, REPEATS)
    return repeats.withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))


def _maximal(records: list[dict], window: int) -> Iterator[tuple[int, int, int, int]]:
    """The left-diverse internal nodes, of at least `window` words, of the tree of the records' suffixes."""
    texts = [np.frombuffer(r["words"], np.int64) for r in records]
    sizes = np.array([len(x) + 1 for x in texts])
    begins = np.cumsum(sizes) - sizes
    # Every text ends in a symbol of its own.
    known, symbols = np.unique(np.concatenate(texts), return_inverse=True)
    ranks = np.empty(sizes.sum(), np.int64)
    for k, (begin, size) in enumerate(zip(begins, sizes)):
        ranks[begin + size - 1] = len(known) + k
    is_word = np.ones(len(ranks), bool)
    is_word[begins + sizes - 1] = False
    ranks[is_word] = symbols
    levels, depth = [ranks], 1
    while depth < sizes.max():
        then = np.concatenate((ranks[depth:], np.full(min(depth, len(ranks)), -1)))[: len(ranks)]
        order = np.lexsort((then, ranks))
        new = (ranks[order[1:]] != ranks[order[:-1]]) | (then[order[1:]] != then[order[:-1]])
        ranks = np.empty_like(ranks)
        ranks[order] = np.concatenate(([0], np.cumsum(new)))
        levels.append(ranks)
        depth *= 2

    leaves = []  # place, number, word before, id and first word of the first occurrence
    for record, begin in zip(records, begins.tolist()):
        for offset, left, mixed in zip(record["offsets"], record["lefts"], record["mixed"]):
            where = (record["doc_id"], record["first"] + offset)
            leaves.append((begin + offset, 1, left, where))
            if record["n"] > 1:
                leaves.append((begin + offset, record["n"] - 1, None if mixed else left, where))
    place = np.array([x[0] for x in leaves])
    order = np.argsort(ranks[place], kind="stable")
    a, b = place[order[:-1]], place[order[1:]]
    common = np.zeros(len(a), np.int64)
    whole = a == b  # equal texts, counted twice
    for level in range(len(levels) - 1, -1, -1):
        # Symbols of their own keep the places inside their texts.
        at = np.flatnonzero(~whole)
        inside = at[np.maximum(a[at], b[at]) + common[at] < len(ranks)]
        equal = inside[levels[level][a[inside] + common[inside]] == levels[level][b[inside] + common[inside]]]
        common[equal] += 1 << level
    ends = np.repeat(begins + sizes - 1, sizes)
    common[whole] = ends[a[whole]] - a[whole]

    def joined(x: list, y: list) -> list:
        differ = x[2] or y[2] or x[1] is None or x[1] != y[1]
        return [x[0] + y[0], x[1], differ, min(x[3], y[3])]

    # Open nodes from the root on: depth, and what hangs from each so far: number, word before the first
    # leaf, whether others have another, first occurrence. A leaf is deeper than any node.
    stack: list[tuple[int, list]] = []
    for depth, leaf in zip([-1, *common.tolist(), -1], [*order.tolist(), None]):
        while stack and stack[-1][0] > depth:
            size, inner = stack.pop()
            if window <= size < _LEAF and inner[2]:
                yield size, inner[0], *inner[3]
            if stack and stack[-1][0] >= depth:
                stack[-1] = (stack[-1][0], joined(stack[-1][1], inner))
            else:
                stack.append((depth, inner))
        if leaf is not None:
            _, n, left, where = leaves[leaf]
            stack.append((_LEAF, [n, left, left is None and n > 1, where]))
