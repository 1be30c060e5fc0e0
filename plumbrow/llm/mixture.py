"""Packing to a mixture: deficit round-robin over source queues.

Every source is a queue of its documents, however many sources there are. Each window of `length` tokens grants every queue a share of
the window, its quantum, on top of what it is still owed (its deficit); queues are served in turn up
to their deficit and what remains of the window goes to those owed most, who then owe it back. So
windows are full, and over any run of windows a source is off its target by a few pieces at most.

To run in parallel, the queues are cut across into slices: slice k takes of every queue the documents
that begin in the k-th of n equal stretches of its tokens. A slice is one task with as many windows as
`windows_per_slice`, whatever the size of the corpus or of one source. A slice begins with what its
predecessors left owing: how far the queue's first document in the slice lies beyond or before the
stretch's border. Only the last window of a slice can be short. Stretches are counted from a place in the
queue drawn by the source's hash, the queue's end followed by its beginning, so that many sources of
one document each are spread over all slices.

Token ids are stored once and moved once, by row, to meet the pieces; the packing itself sees only
token counts. Targets default to the sources' shares of all tokens; other weights may be given, and a
queue that runs dry leaves its share to the others.

Defined results: a NULL or empty text is its end id alone; a NULL source is the queue of the empty
name; every row is a document of its own, also where rows or ids repeat or doc_id is NULL; an empty
table gives no pieces; further columns of the input are not read.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Mapping
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbrow.llm.common import shuffle_partitions, stage, text_or_empty, texts_of
from plumbrow.llm.tokens import encoder

_CHUNK_ROWS = 20_000

PIECE = "row long, start long, length long, sequence_id long, offset long"


def tokenised(
    docs: DataFrame, tokenizer: str, end_id: int, source: str = "source", chunked: bool = True
) -> DataFrame:
    """Stored: row, doc_id, source, n, width and ids of every document, the end id included."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer, chunked)
        width = known.dtype.itemsize if end_id < 1 << 8 * known.dtype.itemsize else 4
        end = np.array([end_id], dtype=f"<u{width}").tobytes()
        for batch in batches:
            ids = []
            for found in known.ids_of(texts_of(batch)):
                if width != known.dtype.itemsize:
                    found = np.frombuffer(found, dtype=known.dtype).astype("<u4").tobytes()
                ids.append(found + end)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("source"),
                    pa.array([len(x) // width for x in ids], pa.int64()),
                    pa.array([width] * len(ids), pa.int32()),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "source", "n", "width", "ids"],
            )

    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        text_or_empty("text").alias("text"),
    )
    ids = chosen.mapInArrow(
        encode, "doc_id long, source string, n long, width int, ids binary"
    )
    return stage(ids.withColumn("row", F.monotonically_increasing_id()), "tokenised")


def queue_positions(queued: DataFrame) -> DataFrame:
    """Adds `position`, the tokens before each document in its queue, and `queue_n`, all its tokens.

    Rows are spread over chunks by hash and summed up within (queue, chunk), then over the chunks'
    sums; a queue of any size is never in one task.
    """
    tasks = shuffle_partitions(queued.sparkSession)
    n_chunks = max(tasks, -(-queued.count() // _CHUNK_ROWS))
    chunked = queued.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(n_chunks)))
    sums = chunked.groupBy("queue", "chunk").agg(F.sum("n").alias("chunk_n"))
    earlier = Window.partitionBy("queue").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        "queue",
        "chunk",
        F.coalesce(F.sum("chunk_n").over(earlier), F.lit(0)).alias("base"),
        F.sum("chunk_n").over(Window.partitionBy("queue")).alias("queue_n"),
    )
    within = (
        Window.partitionBy("queue", "chunk").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    )
    inner = chunked.withColumn("inner", F.coalesce(F.sum("n").over(within), F.lit(0)))
    joined = inner.join(bases, ["queue", "chunk"])
    return joined.select(
        "row", "queue", "n", (F.col("base") + F.col("inner")).alias("position"), "queue_n"
    )


def round_robin(
    lengths: list[np.ndarray],
    shares: np.ndarray,
    owed: np.ndarray,
    length: int,
    least: int,
) -> array:
    """Serve queues of documents of the given lengths into windows.

    Six numbers for each piece: queue, document's place in the queue, its start, the piece's length, window, offset. owed:
    the deficits at the start. Pieces smaller than `least` wait for the next window unless they end a
    document's queue or nothing else fills the window.
    """
    n = len(lengths)
    shares = (shares / shares.sum()).tolist()
    left = [int(x.sum()) for x in lengths]
    docs = [x.tolist() for x in lengths]
    place, done = [0] * n, [0] * n
    deficit = owed.tolist()
    total, window = sum(left), 0
    running = list(range(n))
    out = array("q")
    while total:
        space, offset = length, 0
        running = [q for q in running if left[q]]
        active = sum(shares[q] for q in running)
        for q in running:
            deficit[q] += shares[q] / active * length
        at = bisect_left(running, window % n)
        turns = running[at:] + running[:at]
        first, again, owed_most = True, False, []
        while space and total:
            if first:
                grants = [(q, int(deficit[q])) for q in turns if left[q]]
                grants = [(q, g) for q, g in grants if g >= least or g >= left[q]]
                first = False
            else:
                if not owed_most:
                    owed_most = [(-deficit[q], i) for i, q in enumerate(turns) if left[q]]
                    heapify(owed_most)
                i = heappop(owed_most)[1]
                q = turns[i]
                grants = [(q, max(least, int(deficit[q])))]
                again = True
            for q, grant in grants:
                take = min(grant, left[q], space)
                left[q] -= take
                deficit[q] -= take
                space -= take
                total -= take
                while take:
                    piece = min(take, docs[q][place[q]] - done[q])
                    out.extend((q, place[q], done[q], piece, window, offset))
                    offset += piece
                    take -= piece
                    done[q] += piece
                    if done[q] == docs[q][place[q]]:
                        place[q] += 1
                        done[q] = 0
            if again and left[q]:
                heappush(owed_most, (-deficit[q], i))
        window += 1
    return out


def pieces(
    tokens: DataFrame,
    length: int = 2048,
    targets: Mapping[str, float] | None = None,
    windows_per_slice: int = 512,
    least: int = 128,
    max_queues: int | None = None,
) -> DataFrame:
    """Where every token goes: row, start, length, sequence_id, offset (see the module's text).

    max_queues is accepted for older callers and has no effect: sources never share a queue.
    """
    queued = tokens.select("row", F.col("source").alias("queue"), "n")
    drawn = F.pmod(F.xxhash64("queue", F.lit(3)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    begin = F.floor(drawn * F.col("queue_n"))
    placed = queue_positions(queued).withColumn("position", (F.col("position") + begin) % F.col("queue_n"))
    totals = queued.agg(F.sum("n").alias("n")).first()["n"] or 0
    n_slices = max(1, round(totals / (length * windows_per_slice)))
    stretch = F.col("queue_n") / F.lit(float(n_slices))
    weight = F.col("queue_n").cast("double")
    if targets is not None:
        pairs = [x for kv in sorted(targets.items()) for x in (F.lit(kv[0]), F.lit(float(kv[1])))]
        weight = F.coalesce(F.create_map(*pairs)[F.col("queue")], F.lit(0.0)) + F.lit(1e-9)
    sliced = (
        placed.withColumn("slice", F.least(F.floor(F.col("position") / stretch), F.lit(n_slices - 1)))
        .select(
            "slice",
            "queue",
            "row",
            "n",
            "position",
            weight.alias("weight"),
            (F.col("slice") * stretch).alias("border"),
        )
    )

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["queue", "position", "row"], kind="stable")
        groups = [g for _, g in rows.groupby("queue", sort=True)]
        served = round_robin(
            [g["n"].to_numpy() for g in groups],
            np.array([g["weight"].iloc[0] for g in groups]),
            np.array([g["border"].iloc[0] - g["position"].iloc[0] for g in groups]),
            length,
            least,
        )
        out = np.frombuffer(served, np.int64).reshape(-1, 6)
        begins = np.cumsum([0] + [len(g) for g in groups[:-1]])
        return pd.DataFrame(
            {
                "row": rows["row"].to_numpy()[begins[out[:, 0]] + out[:, 1]],
                "start": out[:, 2],
                "length": out[:, 3],
                "sequence_id": out[:, 4] + (int(key[0]) << 32),
                "offset": out[:, 5],
            }
        )

    # Little data and much work: without coalescing.
    tasks = min(n_slices, shuffle_partitions(tokens.sparkSession))
    return sliced.repartition(tasks, "slice").groupBy("slice").applyInPandas(pack, PIECE)


def packed(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    length: int = 2048,
    source: str = "source",
    chunked: bool = True,
    with_ids: bool = False,
    **options,
) -> DataFrame:
    """All documents in sequences of at most `length` tokens, a row for each piece.

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source; with_ids adds the
    piece's ids (little-endian unsigned 32-bit integers).
    """
    tokens = tokenised(docs, tokenizer, end_id, source, chunked)
    plan = pieces(tokens, length, **options)
    of_row = plan.groupBy("row").agg(
        F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces")
    )
    joined = tokens.select("row", "doc_id", "source", "n", "width", "ids").join(of_row, "row")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("pieces")
            n_pieces = np.diff(found.offsets.to_numpy())
            flat = found.flatten()
            start, size, sequence, offset = (flat.field(i).to_numpy() for i in range(4))
            widths = batch.column("width").to_pylist()
            crcs, ids_out, at = [], [], 0
            starts, sizes = start.tolist(), size.tolist()
            for width, ids, n in zip(widths, batch.column("ids"), n_pieces.tolist()):
                ids = np.frombuffer(ids.as_buffer(), dtype=f"<u{width}").astype("<u4")
                data = memoryview(ids).cast("B")
                for i in range(at, at + n):
                    piece = data[4 * starts[i] : 4 * (starts[i] + sizes[i])]
                    crcs.append(zlib.crc32(piece))
                    if with_ids:
                        ids_out.append(bytes(piece))
                at += n
            row = pa.array(np.repeat(np.arange(len(n_pieces)), n_pieces))
            columns = {
                "doc_id": batch.column("doc_id").take(row),
                "start": pa.array(start),
                "length": pa.array(size),
                "ids_crc32": pa.array(crcs, pa.int64()),
                "doc_tokens": batch.column("n").take(row),
                "sequence_id": pa.array(sequence),
                "offset": pa.array(offset),
                "source": batch.column("source").take(row),
            }
            if with_ids:
                columns["ids"] = pa.array(ids_out, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    schema = ", ".join(f"{c} long" for c in names) + ", source string" + ", ids binary" * with_ids
    return joined.select("doc_id", "source", "n", "width", "ids", "pieces").mapInArrow(cut, schema)
