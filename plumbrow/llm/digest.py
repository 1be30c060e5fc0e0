"""Document fingerprints: a quartile bucket digest of hashed byte triplets.

All triplets of a few shapes in a sliding window of five bytes are counted in 128 buckets. The digest
holds, as hexadecimal digits: a check byte, the length on a log scale, two ratios of the quartiles of the
counts, and for each bucket the quartile (0 to 3) its count lies in. Two digests differ by the sum of
their buckets' differences and their headers' differences, each bounded; likeness is one less the
difference over its ceiling.

Neighbours in doc_id order meet without a global sort in one task: blocks of consecutive ids are shuffled
to one partition each, and each block gets a copy of the first document of the following block.

Defined results: a NULL text is empty; an empty text, or one under three bytes, has a digest without
counts; a NULL doc_id comes last in descending order; rows that repeat a doc_id follow each other by
text; a single document is its own successor; an empty table gives no rows; further columns of the
input are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbrow.llm.common import block_of_id, id_borders, sha256_hex, text_or_empty

BUCKETS = 128
CEILING = 256
_HEADER = 3  # bytes

#: Second and third byte's place after the first.
_SHAPES = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))


def _mixed(n: int, salt: int) -> np.ndarray:
    """A 16-bit number for each of n values, by a multiplicative rule."""
    values = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * salt)
    return ((values ^ (values >> np.uint64(29))) >> np.uint64(24)).astype(np.uint16)


_FIRST = [_mixed(256, 11 * i + 1) for i in range(len(_SHAPES))]
_SECOND = [_mixed(256, 11 * i + 5) for i in range(len(_SHAPES))]
_THIRD = [_mixed(256, 11 * i + 9) for i in range(len(_SHAPES))]


def counts_of(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    total = np.zeros(BUCKETS, np.int64)
    for (x, y), first, second, third in zip(_SHAPES, _FIRST, _SECOND, _THIRD):
        n = len(data) - y
        for at in range(0, n, 1 << 16):
            m = min(n, at + (1 << 16))
            h = first[data[at:m]] + second[data[at + x : m + x]] + third[data[at + y : m + y]]
            total += np.bincount((h >> np.uint16(5)) & np.uint16(BUCKETS - 1), minlength=BUCKETS)
    return total


def digest(text: bytes) -> bytes:
    counts = counts_of(text)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]].tolist()
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    body = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    length = min(255, int(math.log(len(text) + 1) / math.log(1.1)))
    ratios = (q1 * 15 // q3) << 4 | (q2 * 15 // q3) if q3 else 0
    return bytes((zlib.crc32(text) & 255, length, ratios)) + body.astype(np.uint8).tobytes()


#: Differences of four two-bit codes packed in one byte; opposite quartiles count double.
_PAIR = np.array([[6 if abs(a - b) == 3 else abs(a - b) for b in range(4)] for a in range(4)])


def difference(a: bytes, b: bytes) -> int:
    """0 for equal digests, CEILING at most."""
    x, y = (np.frombuffer(d, np.uint8, offset=_HEADER) for d in (a, b))
    total = sum(int(_PAIR[(x >> s) & 3, (y >> s) & 3].sum()) for s in (0, 2, 4, 6))
    total += min(48, 4 * abs(a[1] - b[1]))
    total += min(12, 2 * abs((a[2] >> 4) - (b[2] >> 4)))
    total += min(12, 2 * abs((a[2] & 15) - (b[2] & 15)))
    total += a[0] != b[0]
    return min(CEILING, total)


def likeness(a: bytes, b: bytes) -> float:
    return 1.0 - difference(a, b) / CEILING


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_descending_blocks(docs: DataFrame, rows_per_block: int) -> tuple[DataFrame, int]:
    """doc_id, text, block, copied: every document, and in each block the first one after it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    ids = rows.select("doc_id")
    borders = id_borders(ids, rows_per_block, F.lit(1))
    block = block_of_id(borders, null_block=0)
    order = Window.orderBy(F.desc("b"))
    heads = (
        ids.groupBy(block.alias("b"))
        .agg(F.max("doc_id").alias("head"))
        .withColumn("before", F.coalesce(F.lag("b").over(order), F.min("b").over(Window.partitionBy())))
    )
    # A row for each block.
    joined = rows.withColumn("b0", block).join(
        F.broadcast(heads), (F.col("b0") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("head")), "left"
    )
    own = F.struct(F.col("b0").alias("block"), F.lit(False).alias("copied"))
    copy = F.struct(F.col("before").alias("block"), F.lit(True).alias("copied"))
    places = F.when(F.col("b").isNull(), F.array(own)).otherwise(F.array(own, copy))
    spread = joined.select("doc_id", "text", F.explode(places).alias("p"))
    return spread.select("doc_id", "text", "p.block", "p.copied"), len(borders) + 1


COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def compared(docs: DataFrame, rows_per_block: int = 2000) -> DataFrame:
    """Each document's digest against its edited text's and its successor's, descending doc_id."""
    spread, n_blocks = in_descending_blocks(docs, rows_per_block)
    ordered = spread.repartitionById(n_blocks, F.col("block").cast("int")).sortWithinPartitions(
        F.asc("block"), F.asc("copied"), F.desc_nulls_last("doc_id"), F.asc("text")
    )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in COMPARED.split(", ")]
        held, ended = None, None
        for batch in batches:
            out = []
            columns = (batch.column(c) for c in ("doc_id", "text", "block", "copied"))
            for doc_id, text, block, copied in zip(*columns):
                block, copied = block.as_py(), copied.as_py()
                if copied and block == ended:
                    continue  # a repeat of the following block's first id
                text = text.as_py()
                print_ = digest(text.encode())
                if held is not None and held[3] == block:
                    changed = edited(held[1], text).encode()
                    of_changed = digest(changed)
                    out.append(
                        (
                            held[0],
                            len(held[1]),
                            sha256_hex(changed),
                            held[2].hex(),
                            of_changed.hex(),
                            likeness(held[2], of_changed),
                            likeness(held[2], print_),
                        )
                    )
                held = (doc_id.as_py(), text, print_, block)
                if copied:
                    held, ended = None, block
            if out:
                types = (pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)], names
                )

    return ordered.mapInArrow(compare, COMPARED)
