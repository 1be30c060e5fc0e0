"""Language-model scores: a gated recurrent net on top of word counts of the whole corpus.

Words are counted over all training documents (A-Z lower-cased; an end after each document is a
token, too). A word's class comes from its last two bytes. The `words` most frequent words are members
of their classes in the net; all other words share their class's last member, and within it a word
has the probability (c+1) / (N+V+1) by its count c, the tokens N and the words V so shared, one part left
for unknown words. So the model is a probability over all words whatsoever:

    P(word | before) = P(class | before) * P(member | class, before) [* P(word | class's others)]

The net (plumbrow.llm.gru) begins as the counts have it and learns from every token of every training
document, in `rounds` rounds that split the documents. In a round each task trains on its documents by
truncated backpropagation over all their windows, the state carried from window to window as in scoring,
and the tasks' parameters are averaged by weight, slice by slice. What is gathered so grows with the corpus; what the
driver gets does not.

Scoring carries the state through each whole document. The counts of the `head` most frequent words are
sent to all tasks; rarer words are looked up by a join of the rare tokens alone.

Defined results: a NULL or empty text is its end alone; NULL ids count as the empty text in the hash
that holds documents out; without training documents all counts are 0 and the net is untrained; rows that
repeat are scored each; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrow.llm.common import stage, text_or_empty, texts_of
from plumbrow.llm.gru import Net, Shape, score_documents, train

END = b""  # no word is empty


@dataclass(frozen=True)
class Settings:
    words: int = 2048
    classes: int = 48
    head: int = 200_000
    dim: int = 16
    hidden: int = 24
    window: int = 16
    lanes: int = 64
    rounds: int = 2
    rate: float = 0.01
    seed: int = 5


def tokens_of(text: bytes) -> list[bytes]:
    words = text.lower().split()
    words.append(END)
    return words


def class_of(word: bytes, classes: int) -> int:
    return zlib.crc32(word[-2:]) % classes


def word_counts(docs: DataFrame, at_once: int = 300_000) -> DataFrame:
    """Stored: word, n of all documents' tokens, the end as the empty word."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in texts_of(batch):
                total.update(tokens_of(text))
                if len(total) > at_once:
                    yield _counted(total)
                    total = Counter()
        yield _counted(total)

    texts = docs.select(text_or_empty("text").alias("text"))
    counted = texts.mapInArrow(count, "word binary, n long")
    return stage(counted.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def _counted(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
        ["word", "n"],
    )


class _Unknown(dict):
    def __missing__(self, word: bytes) -> int:
        return -1


@dataclass
class Vocabulary:
    """The head words, most frequent first, and what the counts say of each class."""

    settings: Settings
    head: list[bytes]
    counts: np.ndarray
    n_tokens: int
    n_words: int
    others_n: np.ndarray  # tokens and words that share a class's last member
    others_v: np.ndarray

    def __post_init__(self):
        classes, modelled = self.settings.classes, min(self.settings.words, len(self.head))
        self.index = _Unknown((w, i) for i, w in enumerate(self.head))
        self.classes = np.array([class_of(w, classes) for w in self.head], np.int16)
        in_class = np.zeros(classes, np.int64)
        self.members = np.zeros(len(self.head), np.int32)
        for i in range(modelled):
            self.members[i] = in_class[self.classes[i]]
            in_class[self.classes[i]] += 1
        self.members[modelled:] = in_class[self.classes[modelled:]]
        self.modelled = modelled
        self.last = in_class  # the number of each class's shared member
        self.inputs = np.where(
            np.arange(len(self.head)) < modelled,
            np.arange(len(self.head)),
            modelled + self.classes.astype(np.int64),
        ).astype(np.int32)
        self.log_counts = np.log10(self.counts + 1.0)
        self.log_others = np.log10(self.others_n + self.others_v + 1.0)

    @property
    def shape(self) -> Shape:
        sizes = tuple(int(x) + 1 for x in self.last)
        return Shape(self.modelled, sizes, self.settings.dim, self.settings.hidden)

    @property
    def begin(self) -> int:
        """The input row before a document's first token."""
        return self.modelled + self.settings.classes

    def started_net(self) -> Net:
        shape = self.shape
        members = np.ones(int(sum(shape.sizes)))
        offsets = shape.offsets
        for i in range(self.modelled):
            members[offsets[self.classes[i]] + self.members[i]] += self.counts[i]
        members[offsets[1:] - 1] += self.others_n
        mass = np.add.reduceat(members, offsets[:-1])
        return Net.started(shape, mass / mass.sum(), members / np.repeat(mass, shape.sizes), self.settings.seed)

    def encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places among the head words (-1: not one), input rows, classes, members."""
        index = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        known = np.maximum(index, 0) if len(self.head) else np.zeros(len(words), np.int64)
        if not len(self.head):
            classes = np.array([class_of(w, self.settings.classes) for w in words], np.int16)
            return index, (self.modelled + classes).astype(np.int32), classes, self.last[classes]
        inputs, classes, members = self.inputs[known], self.classes[known], self.members[known]
        rare = np.flatnonzero(index < 0)
        if len(rare):
            of_rare = np.array([class_of(words[i], self.settings.classes) for i in rare], np.int16)
            classes[rare] = of_rare
            inputs[rare] = self.modelled + of_rare
            members[rare] = self.last[of_rare]
        return index, inputs, classes, members


def vocabulary(counts: DataFrame, settings: Settings) -> Vocabulary:
    """The most frequent words, `settings.head` at most, and one row of sums for each class.

    Words whose counts lie close together are all in the head or all outside it.
    """
    # Counts on a log scale: under a thousand bins, whatever the corpus.
    level = F.floor(F.log2("n") * 16)
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()
    room, least = settings.head, None
    for r in sorted(levels, key=lambda r: -r["level"]):
        room -= r["words"]
        if room < 0:
            break
        least = r["level"]
    top = [] if least is None else counts.filter(level >= least).toArrow().to_pylist()
    top.sort(key=lambda r: (-r["n"], r["word"]))
    head, n = [r["word"] for r in top], np.array([r["n"] for r in top], np.float64)
    ending = F.when(F.octet_length("word") > 2, F.substring("word", -2, 2)).otherwise(F.col("word"))
    sums = (
        counts.groupBy(F.pmod(F.crc32(ending), F.lit(settings.classes)).cast("int").alias("c"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("v"))
        .collect()
    )
    others_n, others_v = np.zeros(settings.classes), np.zeros(settings.classes)
    for r in sums:
        others_n[r["c"]], others_v[r["c"]] = r["n"], r["v"]
    n_tokens, n_words = int(others_n.sum()), int(others_v.sum())
    for word, count in zip(head[: settings.words], n[: settings.words]):
        c = class_of(word, settings.classes)
        others_n[c] -= count
        others_v[c] -= 1
    return Vocabulary(settings, head, n, n_tokens, n_words, others_n, others_v)


def train_round(docs: DataFrame, shared, flat: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """One round over the documents whose hash falls to it: the weighted mean of the tasks' nets."""
    state = docs.sparkSession.sparkContext.broadcast(flat)
    slices = 32

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Vocabulary = shared.value[1]
        s = known.settings
        net = Net(known.shape, state.value.copy())
        texts = (text for batch in batches for text in texts_of(batch))
        documents = (known.encoded(tokens_of(text))[1:] for text in texts)
        weight = train(net, documents, known.begin, s.lanes, s.window, s.rate / (1 + turn))
        if weight:
            parts = np.array_split(net.flat * np.float32(weight), slices)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(slices), pa.int32()),
                    pa.array([float(weight)] * slices, pa.float64()),
                    pa.array([p.astype("<f4").tobytes() for p in parts], pa.binary()),
                ],
                ["slice", "weight", "sums"],
            )

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, total = 0.0, None
        for batch in batches:
            for w, data in zip(batch.column("weight").to_pylist(), batch.column("sums").to_pylist()):
                values = np.frombuffer(data, "<f4").astype(np.float64)
                total = values if total is None else total + values
                weight += w
        yield pa.RecordBatch.from_pydict(
            {
                "slice": pa.array([key[0].as_py()], pa.int32()),
                "values": pa.array([(total / weight).astype("<f4").tobytes()], pa.binary()),
            }
        )

    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40))
    rows = docs.select(draw.alias("draw"), text_or_empty("text").alias("text"))
    mine = rows.filter(F.col("draw") % rounds == turn).select("text")
    sums = mine.mapInArrow(learn, "slice int, weight double, sums binary")
    means = sums.groupBy("slice").applyInArrow(add, "slice int, values binary").collect()
    if not means:
        return flat
    return np.concatenate(
        [np.frombuffer(r["values"], "<f4") for r in sorted(means, key=lambda r: r["slice"])]
    )


SCORED = (
    "doc_id long, n_tokens long, n_known long, log_counts double, score double, rare array<binary>"
)


def scored(
    docs: DataFrame, training: Column, settings: Settings = Settings(), at_once: int = 4_000_000
) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row."""
    context = docs.sparkSession.sparkContext
    learned = docs.filter(training)
    counts = word_counts(learned)
    words = vocabulary(counts, settings)
    shared = context.broadcast((uuid4().hex, words))  # at most settings.head words
    flat = words.started_net().flat
    for turn in range(settings.rounds):
        flat = train_round(learned, shared, flat, turn, settings.rounds)
    final = context.broadcast(flat)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Vocabulary = shared.value[1]
        net = Net(known.shape, final.value)
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                tokens = tokens_of(text)
                index, inputs, classes, members = known.encoded(tokens)
                places = index[index >= 0]
                log_counts = float(known.log_counts[places].sum()) if len(places) else 0.0
                shared_ = index[(index >= known.modelled)]
                # Head words outside the net and rare words share their class's last member; the
                # rare words' counts are added after the join.
                outside = classes[(index < 0) | (index >= known.modelled)]
                others = -float(known.log_others[outside].sum())
                if len(shared_):
                    others += float(known.log_counts[shared_].sum())
                rare = [tokens[i] for i in np.flatnonzero(index < 0).tolist()]
                held.append(
                    (inputs, classes, members, doc_id, len(tokens), len(places), log_counts, others, rare)
                )
                size += len(tokens)
                if size >= at_once:
                    yield _scored_batch(net, known, held)
                    held, size = [], 0
        if held:
            yield _scored_batch(net, known, held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    found = stage(
        rows.mapInArrow(score, SCORED).withColumn("row", F.monotonically_increasing_id()),
        "language-scores",
    )
    rare = found.select("row", F.explode("rare").alias("word")).join(counts, "word")
    of_rows = rare.groupBy("row").agg(
        F.count("*").alias("rare_known"), F.sum(F.log10(F.col("n") + 1.0)).alias("rare_counts")
    )
    rare_counts = F.coalesce("rare_counts", F.lit(0.0))
    n_all, v_all = words.n_tokens, words.n_words
    return found.drop("rare").join(of_rows, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (
            F.col("log_counts")
            + rare_counts
            - F.col("n_tokens") * F.lit(math.log10(n_all + v_all + 1))
        ).alias("base_score"),
        (F.col("score") + rare_counts).alias("score"),
    )


def _scored_batch(net: Net, known: Vocabulary, held: list[tuple]) -> pa.RecordBatch:
    found = score_documents(net, [x[:3] for x in held], known.begin) / math.log(10)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([x[3] for x in held], pa.int64()),
            pa.array([x[4] for x in held], pa.int64()),
            pa.array([x[5] for x in held], pa.int64()),
            pa.array([x[6] for x in held], pa.float64()),
            pa.array([f + x[7] for f, x in zip(found.tolist(), held)], pa.float64()),
            pa.array([x[8] for x in held], pa.list_(pa.binary())),
        ],
        ["doc_id", "n_tokens", "n_known", "log_counts", "score", "rare"],
    )
