"""Helpers shared by the operators: inputs, hashes, sizes."""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import TypeVar

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbrow.sources.staging import new_path

T = TypeVar("T")

#: Bytes that separate words: space and tab to carriage return, as bytes.split() has them.
SPACES = b" \t\n\x0b\x0c\r"
#: The same as Spark SQL sees them.
SPACE_TEXT = " \t\n\x0b\f\r"
#: Maps A-Z to a-z and every ASCII byte that is no letter or digit to a space.
WORD_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32
    for b in range(256)
)
_NEEDS_DECODING = re.compile(rb"[\x80-\xff]")


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors, unless their Python path has them anyway."""
    root = Path(__file__).resolve().parents[2]
    paths = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    context = spark.sparkContext
    if str(root) in paths or context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="plumbrow-")) / "plumbrow.zip"  # the driver serves it
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted((root / "plumbrow").rglob("*.py")):
            out.write(module, module.relative_to(root))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


_shipped: set[str] = set()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_of_id(doc_id: str | Column) -> Column:
    """crc32 of the id written as text; NULL ids count as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def text_or_empty(text: str | Column) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def run_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under this application's part of spark.checkpoint.dir."""
    return new_path(spark, label)


def text_bytes() -> Column:
    """What a row takes, about."""
    return F.octet_length(text_or_empty("text")) + 16


def id_borders(docs: DataFrame, most: int, size: Column) -> np.ndarray:
    """Borders between blocks of consecutive doc_ids whose sizes add up to about `most`: the greatest id of
    each block but the last. All rows of one id are in one block.

    Ids and sizes are sorted by range; each range is cut where its running sum asks for it. The driver
    gets one number a block.
    """
    sized = docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.sum(size).alias("size")
    )

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = 0
        for batch in batches:
            ids, sizes = batch.column("id").to_numpy(), batch.column("size").to_numpy()
            found = []
            for i, size in zip(ids.tolist(), sizes.tolist()):
                held += size
                if held >= most:
                    found.append(i)
                    held = 0
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["id"])

    ordered = sized.repartitionByRange(shuffle_partitions(docs.sparkSession), "id")
    borders = ordered.sortWithinPartitions("id").mapInArrow(cut, "id long").toArrow()
    return np.sort(borders.column("id").to_numpy())


def block_of_id(borders: np.ndarray, null_block: int) -> Column:
    """The number of the block of `id_borders` that a row's doc_id is in."""

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, ids.to_numpy(np.int64), "left"))

    known = place(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)))
    return F.when(F.col("doc_id").isNull(), F.lit(null_block)).otherwise(known)


def n_blocks_of(docs: DataFrame, block_bytes: int = 4 << 20) -> int:
    size = docs.agg(F.sum(text_bytes())).first()[0] or 0
    return max(1, -(-size // block_bytes))


def blocked(docs: DataFrame, n_blocks: int, block: Column | None = None) -> DataFrame:
    """block, id, text, doc (all other input columns), dealt out by block (by hash if none is given).

    Every plan on this frame reads all its columns, so that one shuffle of the texts serves them all.
    """
    if block is None:
        block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks))
    rows = docs.select(
        block.cast("int").alias("block"),
        F.col("doc_id").cast("long").alias("id"),
        text_or_empty("text").alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("doc"),
    )
    partitions = max(1, min(n_blocks, shuffle_partitions(docs.sparkSession)))
    return rows.repartition(partitions, "block")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back; this cuts its lineage."""
    path = run_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def n_code_points(data: bytes) -> int:
    return len(data) - len(_continuation.findall(data)) if _NEEDS_DECODING.search(data) else len(data)


_continuation = re.compile(rb"[\x80-\xbf]")


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """The UTF-8 bytes of a text column, NULL as empty, one at a time."""
    values = batch.column(column).cast(pa.binary())
    for value in values:
        yield value.as_py() or b""


_kept: list = [None, None]


def kept(key: object, build: Callable[[], T]) -> T:
    """What a worker keeps between tasks: the last thing asked for, and nothing besides."""
    if _kept[0] != key:
        _kept[:] = [None, None]  # the former one goes before the next is built
        _kept[:] = [key, build()]
    return _kept[1]


class WordHashes(dict):
    """64-bit hashes of words, kept up to a number of words per process."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self._limit = limit
        import xxhash

        self._hash = xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        value = self._hash(word)
        if len(self) < self._limit:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))
