"""Length-delimited binary records with masked checksums and a separate offset index.

One record: length of the payload (8 bytes), masked checksum of these 8 bytes (4), the payload,
masked checksum of the payload (4); all numbers little-endian. The checksum is CRC-32, masked by a
rotation and a constant so that a checksum stored in checked data does no harm. A payload is one
document: a flag (1: the id is NULL), the bytes of one token id (2 or 4), the doc_id (8 bytes), the
token ids. A data file part-N.rec comes with part-N.idx: offset and length (8 bytes each) of every
record, for reads in any order.

Every task writes its own files under a name of its own attempt, and only files that the manifest
lists count; a task that runs again after a lost executor leaves unlisted files behind, no harm.
Files are written and read by pyarrow's file systems (local or shared disk, HDFS, S3, GCS).

Defined results: a NULL or empty text has the end id alone; a NULL doc_id comes first; rows that
repeat a doc_id are records of their own, ordered by text; an empty table gives no records; further
columns of the input are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbrow.llm.common import run_folder, stage, text_or_empty, texts_of
from plumbrow.llm.tokens import encoder

_LENGTH = struct.Struct("<Q")
_CHECK = struct.Struct("<I")
_HEAD = struct.Struct("<BBq")
_MASK = 0x5EEDC0DE

MANIFEST = "part int, data string, offsets string, n_records long, n_tokens long"
RECORD = "part int, position long, doc_id long, ids binary"


class DamagedRecord(ValueError):
    """A record's length or checksum doesn't hold."""


def masked(data: bytes) -> int:
    value = zlib.crc32(data)
    return (((value >> 11) | (value << 21)) + _MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = _LENGTH.pack(len(payload))
    return b"".join(
        (length, _CHECK.pack(masked(length)), payload, _CHECK.pack(masked(payload)))
    )


def next_payload(source, limit: int = 1 << 40) -> bytes | None:
    """The next record's payload of an open file; None at its end."""
    head = source.read(12)
    if not head:
        return None
    if len(head) < 12 or masked(head[:8]) != _CHECK.unpack_from(head, 8)[0]:
        raise DamagedRecord("length")
    (length,) = _LENGTH.unpack_from(head)
    body = source.read(length + 4) if length <= limit else b""
    if len(body) < length + 4 or masked(body[:-4]) != _CHECK.unpack_from(body, length)[0]:
        raise DamagedRecord("payload")
    return body[:-4]


def serialised(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return _HEAD.pack(doc_id is None, width, doc_id or 0) + ids


def parsed(payload: bytes) -> tuple[int | None, np.ndarray]:
    """The doc_id and the token ids as little-endian unsigned 32-bit integers."""
    missing, width, doc_id = _HEAD.unpack_from(payload)
    ids = np.frombuffer(payload, dtype=f"<u{width}", offset=_HEAD.size).astype("<u4")
    return None if missing else doc_id, ids


def write_records(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, chunked: bool = True
) -> DataFrame:
    """Write all documents in ascending doc_id order; the stored manifest has a row for each file."""
    ordered = (
        docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text"))
        .repartitionByRange("doc_id")  # texts are no part of the key: its samples go to the driver
        .sortWithinPartitions("doc_id", "text")
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId()
        base = f"{folder}/part-{part:06d}-{context.taskAttemptId()}"
        system, path = fs.FileSystem.from_uri(base)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        encode = encoder(tokenizer, chunked)
        wide = encode.dtype.itemsize if end_id < 1 << 8 * encode.dtype.itemsize else 4
        end = np.array([end_id], dtype=f"<u{wide}").tobytes()
        spans, offset, n_tokens = [], 0, 0
        with system.open_output_stream(f"{path}.rec") as data:
            for batch in batches:
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode.ids_of(texts_of(batch))):
                    if wide != encode.dtype.itemsize:
                        ids = np.frombuffer(ids, dtype=encode.dtype).astype("<u4").tobytes()
                    record = framed(serialised(doc_id, ids + end, wide))
                    data.write(record)
                    spans.append((offset, len(record)))
                    offset += len(record)
                    n_tokens += len(ids) // wide + 1
        with system.open_output_stream(f"{path}.idx") as index:
            index.write(np.array(spans, dtype="<u8").tobytes())
        if spans:
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "part": part,
                        "data": f"{base}.rec",
                        "offsets": f"{base}.idx",
                        "n_records": len(spans),
                        "n_tokens": n_tokens,
                    }
                ],
                schema=pa.schema(
                    [
                        ("part", pa.int32()),
                        ("data", pa.string()),
                        ("offsets", pa.string()),
                        ("n_records", pa.int64()),
                        ("n_tokens", pa.int64()),
                    ]
                ),
            )

    return stage(ordered.mapInArrow(write, MANIFEST), "record-manifest")


def read_records(manifest: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32. Files are read whole, in turn.

    start counts the ids of all documents before; the running sum is over one row for each file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    n_files = max(1, manifest.count())

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                system, path = fs.FileSystem.from_uri(file["data"])
                rows, start = [], file["start"]
                with system.open_input_stream(path, buffer_size=1 << 20) as source:
                    while (payload := next_payload(source)) is not None:
                        doc_id, ids = parsed(payload)
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                if len(rows) != file["n_records"] or start - file["start"] != file["n_tokens"]:
                    raise DamagedRecord(file["data"])
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    return files.repartition(n_files).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def shuffled_records(manifest: DataFrame, seed: int = 0) -> DataFrame:
    """All records in an order drawn by the seed, each read by its place in the offset index."""

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                system, path = fs.FileSystem.from_uri(file["offsets"])
                with system.open_input_stream(path) as source:
                    spans = np.frombuffer(source.read(), dtype="<u8").reshape(-1, 2)
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([file["part"]] * len(spans), pa.int32()),
                        "data": [file["data"]] * len(spans),
                        "position": pa.array(spans[:, 0].astype(np.int64)),
                        "size": pa.array(spans[:, 1].astype(np.int64)),
                    }
                )

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[str, pa.NativeFile] = {}
        for batch in batches:
            rows = []
            for place in batch.to_pylist():
                if place["data"] not in opened:
                    system, path = fs.FileSystem.from_uri(place["data"])
                    opened[place["data"]] = system.open_input_file(path)
                source = opened[place["data"]]
                source.seek(place["position"])
                doc_id, ids = parsed(next_payload(source, place["size"]))
                rows.append((place["part"], place["position"], doc_id, ids.tobytes()))
            types = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                ["part", "position", "doc_id", "ids"],
            )
        for source in opened.values():
            source.close()

    n_files = max(1, manifest.count())
    spans = manifest.repartition(n_files).mapInArrow(
        places, "part int, data string, position long, size long"
    )
    drawn = spans.withColumn("turn", F.xxhash64("part", "position", F.lit(seed)))
    return (
        drawn.repartitionByRange("turn", "part", "position")
        .sortWithinPartitions("turn", "part", "position")
        .drop("turn")
        .mapInArrow(read, RECORD)
    )


def records_of(docs: DataFrame, tokenizer: str, end_id: int, chunked: bool = True) -> DataFrame:
    """Write the documents as records to a new folder and return what the files hold."""
    folder = run_folder(docs.sparkSession, "records")
    return read_records(write_records(docs, folder, tokenizer, end_id, chunked))
