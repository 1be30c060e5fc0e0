"""Ranked lexical search: exact inner products with sparse term vectors, pruned by ball trees.

A document's coordinate for a term is the term's weight times its saturated frequency, an integer; a query has
the coordinate 1 for each of its terms, so that their inner product is the score. Documents are taken in blocks
of a few thousand as they come. Each block's ball tree halves its documents by their nearness to two distant
ones; a node keeps centroid and radius, which bound the score of every document below it by
query * centroid + |query| * radius (Cauchy-Schwarz), rounded up by more than floating point can lose, and, as no
coordinate is negative, by the sum of the greatest coordinates below it, where that is less. A query takes a block's subtrees best-first, scores leaves in integers, and leaves out what cannot reach its best ten so
far, which it carries from block to block of a task. The best of all tasks are merged.

Queries are a stated set: they are taken in blocks of bounded bytes, one scan of the documents for each block.
Only a block of queries is held by the driver and broadcast.

Terms are runs of letters, digits and all characters beyond ASCII, only A-Z lower-cased; the whole text counts.
NULL and empty texts have none. Rows of one item_id are one query with the terms of all of them; repeated document
rows are documents of their own, with a rank each. Equal scores go by ascending doc_id, NULL last. Queries
without terms or without documents that score above 0 have no rows. Further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbrow.llm.common import WORD_BYTES, stage, text_or_empty, texts_of

LEAF = 32
BLOCK = 8192
_BLOCK_ENTRIES = 4_000_000
_NO_ID = np.iinfo(np.int64).max
#: More than sums of a million doubles can lose, relative to the sum of their sizes.
_SLACK = 1e-9

_TERM = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
_UPPER = "".join(map(chr, range(0x41, 0x5B)))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


@dataclass
class Sparse:
    """Rows of (column, value); no row is empty."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    def __len__(self) -> int:
        return len(self.starts) - 1

    def rows(self, chosen: np.ndarray) -> Sparse:
        sizes = self.starts[chosen + 1] - self.starts[chosen]
        starts = np.concatenate(([0], np.cumsum(sizes)))
        at = np.arange(starts[-1]) + np.repeat(self.starts[chosen] - starts[:-1], sizes)
        return Sparse(starts, self.columns[at], self.values[at], self.width)

    def times(self, dense: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.values * dense[self.columns], self.starts[:-1])

    def squares(self) -> np.ndarray:
        return np.add.reduceat(self.values * self.values, self.starts[:-1])

    def dense(self, row: int) -> np.ndarray:
        out = np.zeros(self.width)
        at = slice(self.starts[row], self.starts[row + 1])
        out[self.columns[at]] = self.values[at]
        return out


@dataclass
class Queries:
    """The terms of a block of queries, one after the other."""

    starts: np.ndarray
    terms: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def of(self, q: int) -> np.ndarray:
        return self.terms[self.starts[q] : self.starts[q + 1]]


@dataclass
class BallTree:
    """Documents in leaf order; node i covers rows first[i] to stop[i], children[i] < 0 marks a leaf."""

    order: np.ndarray
    first: list[int]
    stop: list[int]
    child: list[int]
    bounds: np.ndarray


def built(docs: Sparse, queries: Queries) -> BallTree:
    """The tree and, for each node and query, a score that no document below the node exceeds."""
    order = np.arange(len(docs))
    values = docs.values.astype(np.float64)
    docs = Sparse(docs.starts, docs.columns, values, docs.width)
    first, stop, child, bounds = [0], [len(docs)], [-1], []
    root_sizes = np.sqrt(np.diff(queries.starts))
    node = 0
    while node < len(first):
        a, z = first[node], stop[node]
        mine = docs.rows(order[a:z])
        centroid = np.bincount(mine.columns, mine.values, docs.width) / len(mine)
        squares, middle = mine.squares(), centroid @ centroid
        apart = squares - 2 * mine.times(centroid) + middle
        radius = np.sqrt(np.maximum(apart, 0) + _SLACK * (squares + middle)).max()
        at_centroid = np.add.reduceat(centroid[queries.terms], queries.starts[:-1])
        greatest = np.zeros(docs.width)
        np.maximum.at(greatest, mine.columns, mine.values)
        at_greatest = np.add.reduceat(greatest[queries.terms], queries.starts[:-1])
        in_ball = (at_centroid + root_sizes * radius) * (1 + _SLACK) + 1
        bounds.append(np.minimum(in_ball, at_greatest * (1 + _SLACK)))
        if z - a > LEAF:
            one = mine.dense(int(np.argmax(apart)))
            to_one = mine.times(one)
            other = mine.dense(int(np.argmax(squares - 2 * to_one)))
            nearer = 2 * (to_one - mine.times(other)) + other @ other - one @ one
            order[a:z] = order[a:z][np.argsort(-nearer, kind="stable")]
            child[node] = len(first)
            half = (a + z) // 2
            first += [a, half]
            stop += [half, z]
            child += [-1, -1]
        node += 1
    return BallTree(order, first, stop, child, np.array(bounds))


class Best:
    """The best k documents of each query so far: scores, greatest first, and ids."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = [np.zeros(0, np.int64) for _ in range(n)]
        self.ids = [np.zeros(0, np.int64) for _ in range(n)]
        self.least = np.zeros(n)  # what a score has to reach

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        able = (scores > 0) & (scores >= self.least[q])
        if not able.any():
            return
        scores = np.concatenate((self.scores[q], scores[able]))
        ids = np.concatenate((self.ids[q], ids[able]))
        kept = np.lexsort((ids, -scores))[: self.k]
        self.scores[q], self.ids[q] = scores[kept], ids[kept]
        if len(kept) == self.k:
            self.least[q] = self.scores[q][-1]


def search_block(docs: Sparse, ids: np.ndarray, queries: Queries, best: Best) -> int:
    """Take a block's documents into the best of each query; the number of leaves scored."""
    tree = built(docs, queries)
    docs, ids = docs.rows(tree.order), ids[tree.order]
    wanted = np.zeros(docs.width, np.int64)
    scored = 0
    for q in np.flatnonzero(tree.bounds[0] >= best.least):
        terms, bounds = queries.of(q), tree.bounds[:, q]
        wanted[terms] = 1
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < best.least[q]:
                break  # nothing left can reach the best
            left = tree.child[node]
            if left < 0:
                a, z = tree.first[node], tree.stop[node]
                at = slice(docs.starts[a], docs.starts[z])
                products = docs.values[at] * wanted[docs.columns[at]]
                best.add(q, np.add.reduceat(products, docs.starts[a:z] - docs.starts[a]), ids[a:z])
                scored += 1
                continue
            for below in (left, left + 1):
                if bounds[below] > 0 and bounds[below] >= best.least[q]:
                    heapq.heappush(heap, (-bounds[below], below))
        wanted[terms] = 0
    return scored


_COUNTS = "doc_id long, n long, terms array<int>, tf array<int>"
_HITS = "query int, doc_id long, score long"


def _counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, its number of terms, and the numbers and frequencies of the wanted ones."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32()))]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            n, terms, tf = [], [], []
            for text in texts_of(batch):
                found = terms_of(text)
                known = Counter(map(number, found))
                known.pop(None, None)
                n.append(len(found))
                terms.append(list(known))
                tf.append(list(known.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, f.type) for c, f in zip((n, terms, tf), list(schema)[1:])]],
                schema=schema,
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return stage(rows.mapInArrow(count, _COUNTS).where("n > 0"), "term-counts")


def _ranked(counts: DataFrame, n_docs: int, n_terms: int, weights: np.ndarray, queries: Queries, k: int) -> DataFrame:
    shared = counts.sparkSession.sparkContext.broadcast((weights, queries))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, queries = shared.value
        best = Best(len(queries), k)
        held: list[tuple[np.ndarray, ...]] = []
        entries = rows = 0

        def flush() -> None:
            ids, n, sizes, terms, tf = (np.concatenate(x) for x in zip(*held))
            held.clear()
            m = 100 - 90 + 90 * n * n_docs // n_terms
            m = np.repeat(m, sizes)
            values = weights[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            starts = np.concatenate(([0], np.cumsum(sizes)))
            search_block(Sparse(starts, terms, values, len(weights)), ids, queries, best)

        for batch in batches:
            terms, tf = batch.column("terms"), batch.column("tf")
            for i in range(0, len(batch), BLOCK):
                part = batch.slice(i, BLOCK)
                terms, tf = part.column("terms"), part.column("tf")
                sizes = terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                held.append(
                    (
                        part.column("doc_id").fill_null(_NO_ID).to_numpy(),
                        part.column("n").to_numpy(),
                        sizes,
                        terms.flatten().to_numpy().astype(np.int64),
                        tf.flatten().to_numpy().astype(np.int64),
                    )
                )
                rows, entries = rows + len(sizes), entries + int(sizes.sum())
                if rows >= BLOCK or entries >= _BLOCK_ENTRIES:
                    flush()
                    entries = rows = 0
        if held:
            flush()
        sizes = [len(s) for s in best.scores]
        ids = np.concatenate(best.ids)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int32()),
                pa.array(ids, pa.int64(), mask=ids == _NO_ID),
                pa.array(np.concatenate(best.scores), pa.int64()),
            ],
            names=["query", "doc_id", "score"],
        )

    place = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = counts.where(F.size("terms") > 0).mapInArrow(find, _HITS)
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def query_terms(queries: DataFrame) -> DataFrame:
    """item_id and its distinct terms, one a row."""
    lowered = F.translate(text_or_empty("text"), _UPPER, _UPPER.lower())
    terms = F.array_distinct(F.regexp_extract_all(lowered, F.lit(_TERM), F.lit(1)))
    return queries.select("item_id", F.explode(terms).alias("term")).distinct()


def ranked_documents(
    docs: DataFrame, queries: DataFrame, k: int = 10, block_bytes: int = 1 << 19
) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of each query. Runs jobs.

    docs: doc_id, text; queries: item_id, text, taken in blocks of about block_bytes of terms.
    """
    spark = docs.sparkSession
    wanted = stage(query_terms(queries), "query-terms")
    size = wanted.agg(F.sum(F.octet_length("term") + 8)).first()[0] or 0
    n_blocks = -(-size // block_bytes)
    item = queries.schema["item_id"]
    results = []
    for block in range(n_blocks):
        mine = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == block)
        by_item = mine.groupBy("item_id").agg(F.collect_list("term").alias("terms")).collect()
        if not by_item:
            continue
        vocabulary = {t: i for i, t in enumerate(sorted({t for r in by_item for t in r["terms"]}))}
        queried = Queries(
            np.cumsum([0, *[len(r["terms"]) for r in by_item]]),
            np.array([vocabulary[t] for r in by_item for t in r["terms"]], np.int64),
        )
        counts = _counts(docs, {t.encode(): i for t, i in vocabulary.items()})
        total = counts.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
        if not total["n"]:
            continue
        n = total["n"]
        holders = counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df"))
        weight = F.floor(1000 * F.log((2.0 * n + 2) / (2.0 * F.col("df") + 1))).alias("w")
        weights = np.zeros(len(vocabulary), np.int64)
        for row in holders.select("t", weight).collect():  # as many as the block has terms
            weights[row["t"]] = row["w"]
        hits = _ranked(counts, n, total["l"], weights, queried, k)
        names = spark.createDataFrame(
            [(i, r["item_id"]) for i, r in enumerate(by_item)],
            T.StructType([T.StructField("query", T.IntegerType()), item]),
        )
        results.append(stage(hits.join(names, "query").select("item_id", "rank", "doc_id", "score"), "ranked"))
    if not results:
        schema = T.StructType([item]).add("rank", T.IntegerType())
        schema = schema.add("doc_id", T.LongType()).add("score", T.LongType())
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, results)
