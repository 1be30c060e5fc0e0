"""Line deduplication against sharded minimal perfect hashes.

A line's key is the line stripped of white space, A-Z lower-cased. Keys of `least` characters and more
that several documents hold are kept only in the document with the smallest doc_id.

1. Every document's distinct keys are hashed to 128 bits and counted, with the smallest doc_id; sums
   are taken on the map side, so a line of every third document is no burden.
2. The hashes held by several documents are dealt to shards. A shard's index is a minimal perfect hash
   over one half of the hashes, with arrays of compact fingerprints (the other half), counts and
   smallest doc_ids in slot order. Hashes held once need no slot: the fingerprint tells them.
3. Documents are dealt to blocks. A block asks each shard once for all its distinct hashes, as one row of
   packed numbers; the shard probes its arrays and answers with the places that hit. So requests
   grow with the text, a common line is asked for once by a block, and lines are never joined.
4. Each block drops lines by the answers. The blocks' shuffle serves both requests and dropping.

Defined results: a NULL or empty text is one empty line; a NULL doc_id counts as greater than any, and
all rows with NULL as one document, as do rows that repeat a doc_id: none of them loses lines to
another, lines within a document are never compared; an empty table gives no rows. Other input
columns are returned as they are in the struct `doc`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbrow.llm.common import (
    SPACES,
    blocked,
    n_code_points,
    n_blocks_of,
    shuffle_partitions,
    stage,
    text_or_empty,
    texts_of,
)
from plumbrow.llm.mph import PerfectHash

NO_ID = (1 << 63) - 1
_SHARD_KEYS = 250_000

INDEX = "shard int, hash binary, fingerprints binary, counts binary, firsts binary"


def key_of(line: bytes, least: int) -> bytes | None:
    """The key of a line; None if it is too short to count."""
    key = line.strip(SPACES)
    if len(key) < least or (len(key) < 4 * least and n_code_points(key) < least):
        return None
    return key.lower()


def hashes_of(keys: Iterable[bytes]) -> np.ndarray:
    """128-bit hashes as rows of two 64-bit numbers."""
    data = b"".join(map(xxhash.xxh3_128_digest, keys))
    return np.frombuffer(data, "<u8").astype(np.uint64).reshape(-1, 2)


def keys_of(text: bytes, least: int) -> dict[bytes, None]:
    """The distinct keys of a text in the order of their first lines."""
    return dict.fromkeys(
        key for line in text.split(b"\n") if (key := key_of(line, least)) is not None
    )


def key_counts(docs: DataFrame, least: int = 10) -> DataFrame:
    """Stored: a, b (the hash), n (rows that hold the key) and first, of keys of several documents."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            found = [hashes_of(keys_of(t, least)) for t in texts_of(batch)]
            hashes = np.concatenate(found) if found else np.zeros((0, 2), np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[:, 0].view(np.int64)),
                    pa.array(hashes[:, 1].view(np.int64)),
                    pa.array(np.repeat(ids, [len(x) for x in found])),
                ],
                ["a", "b", "doc_id"],
            )

    rows = docs.select(_id().alias("doc_id"), text_or_empty("text").alias("text"))
    lines = rows.mapInArrow(emit, "a long, b long, doc_id long")
    counts = lines.groupBy("a", "b").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    )
    return stage(counts.filter("first < last").drop("last"), "line-counts")


def _id():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))


def build_index(counts: DataFrame, n_shards: int) -> DataFrame:
    """Stored: the arrays of every shard that has keys."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        a = rows["a"].to_numpy().view(np.uint64)
        hash_ = PerfectHash.build(a)
        slots = hash_.slots(a)

        def array(name: str) -> bytes:
            values = np.zeros(len(a), "<i8")
            values[slots] = rows[name].to_numpy()
            return values.tobytes()

        return pd.DataFrame(
            {
                "shard": [key[0]],
                "hash": [hash_.to_bytes()],
                "fingerprints": [array("b")],
                "counts": [array("n")],
                "firsts": [array("first")],
            }
        )

    sharded = counts.withColumn("shard", F.pmod(F.col("b"), F.lit(n_shards)).cast("int"))
    return stage(sharded.groupBy("shard").applyInPandas(build, INDEX), "line-index")


class ShardIndex:
    def __init__(self, row: dict):
        self._hash = PerfectHash.from_bytes(row["hash"])
        self._fingerprints = np.frombuffer(row["fingerprints"], "<i8")
        self.counts = np.frombuffer(row["counts"], "<i8")
        self.firsts = np.frombuffer(row["firsts"], "<i8")

    def probe(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes that are in the index, and their slots."""
        slots = self._hash.slots(a.view(np.uint64))
        places = np.flatnonzero(slots >= 0)
        places = places[self._fingerprints[slots[places]] == b[places]]
        return places, slots[places]


REQUEST = "block int, shard int, a binary, b binary"
ANSWER = "block int, shard int, places binary, firsts binary"


def _answer(key: tuple, requests: pa.Table, index: pa.Table) -> pa.Table:
    out = []
    if index.num_rows:
        probed = ShardIndex(index.to_pylist()[0])
        for block, a, b in zip(*(requests.column(c) for c in ("block", "a", "b"))):
            places, slots = probed.probe(
                np.frombuffer(a.as_buffer(), "<i8"), np.frombuffer(b.as_buffer(), "<i8")
            )
            if len(places):
                out.append(
                    {
                        "block": block.as_py(),
                        "shard": key[0].as_py(),
                        "places": places.astype("<i4").tobytes(),
                        "firsts": probed.firsts[slots].astype("<i8").tobytes(),
                    }
                )
    return pa.Table.from_pylist(
        out,
        schema=pa.schema(
            [
                ("block", pa.int32()),
                ("shard", pa.int32()),
                ("places", pa.binary()),
                ("firsts", pa.binary()),
            ]
        ),
    )


def _block_keys(texts: Iterable[bytes], least: int, n_shards: int) -> Iterator[tuple]:
    """shard, keys, places of the shard's keys, their hashes, of a block's distinct keys.

    A shard's keys are in the order of their hashes. The two passes over a block may get its rows in any
    order, as they are fetched or merged, so places must not depend on that.
    """
    keys = list(dict.fromkeys(k for t in texts for k in keys_of(t, least)))
    hashes = hashes_of(keys).view(np.int64)
    shards = np.mod(hashes[:, 1], n_shards)
    order = np.lexsort((hashes[:, 0], hashes[:, 1], shards))
    borders = np.flatnonzero(np.diff(shards[order], prepend=-1, append=n_shards))
    for start, end in zip(borders[:-1], borders[1:]):
        mine = order[start:end]
        yield int(shards[mine[0]]), keys, mine, hashes[mine]


def deduplicated(docs: DataFrame, least: int = 10) -> DataFrame:
    """doc (all input columns but the text), kept_text, n_lines, n_dropped of every row."""
    spark = docs.sparkSession
    counts = key_counts(docs, least)
    n_shards = max(shuffle_partitions(spark), -(-counts.count() // _SHARD_KEYS))
    index = build_index(counts, n_shards)
    blocks = blocked(docs, n_blocks_of(docs))
    kind = blocks.schema["doc"].dataType

    def ask(key: tuple, rows: pa.Table) -> pa.Table:
        texts = _texts(rows)
        out = [
            {"block": key[0].as_py(), "shard": shard, "a": h[:, 0].tobytes(), "b": h[:, 1].tobytes()}
            for shard, _, _, h in _block_keys(texts, least, n_shards)
        ]
        return pa.Table.from_pylist(
            out,
            schema=pa.schema(
                [
                    ("block", pa.int32()),
                    ("shard", pa.int32()),
                    ("a", pa.binary()),
                    ("b", pa.binary()),
                ]
            ),
        )

    def drop(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        given = {r["shard"]: r for r in answers.to_pylist()}
        first: dict[bytes, int] = {}
        texts = list(_texts(rows))
        if given:
            for shard, keys, mine, _ in _block_keys(texts, least, n_shards):
                if shard in given:
                    places = mine[np.frombuffer(given[shard]["places"], "<i4")]
                    holders = np.frombuffer(given[shard]["firsts"], "<i8")
                    first.update((keys[p], h) for p, h in zip(places.tolist(), holders.tolist()))
        kept, n_lines, n_dropped = [], [], []
        for text, doc_id in zip(texts, _ids(rows)):
            lines = text.split(b"\n")
            stay = [x for x in lines if first.get(key_of(x, least), NO_ID) >= doc_id] if first else lines
            kept.append(b"\n".join(stay).decode())
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        return pa.Table.from_arrays(
            [
                rows.column("doc"),
                pa.array(kept, pa.string()),
                pa.array(n_lines, pa.int64()),
                pa.array(n_dropped, pa.int64()),
            ],
            ["doc", "kept_text", "n_lines", "n_dropped"],
        )

    requests = blocks.groupBy("block").applyInArrow(ask, REQUEST)
    answers = requests.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_answer, ANSWER)
    return (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            drop, f"doc {kind.simpleString()}, kept_text string, n_lines long, n_dropped long"
        )
    )


def _texts(rows: pa.Table) -> Iterator[bytes]:
    for chunk in rows.column("text").chunks:
        for value in chunk.cast(pa.binary()):
            yield value.as_py() or b""


def _ids(rows: pa.Table) -> list[int]:
    return [NO_ID if v is None else v for v in rows.column("id").to_pylist()]
