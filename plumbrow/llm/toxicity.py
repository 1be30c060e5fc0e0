"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word (letters, digits and non-ASCII characters, A-Z lower-cased) is the sum of the hashed embeddings
of itself and of its first four and five bytes, so that inflected forms share what they learn. Filters
of several widths run over the words; each filter's greatest response in the whole text feeds one
logistic unit. Training is plain numpy on a bounded, hash-ordered sample of labelled documents
(`Fit.per_label` of each label, none longer than `Fit.longest` characters); the label's share is
counted over all labelled rows and corrects the bias. Then all documents of any length are scored, once; their
scores meet the labels by doc_id, so no text is shuffled. Histograms of the scores of labelled documents that were
not trained on (a part of the sample is kept out of training, so that there are some where labels are few),
weighted up to the full counts of each language and label, give one threshold for each language with ten such
toxic documents, and one for all others. The language is no input of a score.

Filters are linear in the embeddings, so a worker keeps each known word's responses, and a text costs
one look-up a word and a running maximum.

Defined results: a NULL or empty text is scored as a text without words; without labelled documents of
both kinds every score is the toxic share (0 if there is none); NULL labels are not learned from, and
a document labelled both ways counts as toxic; repeated rows are scored each; an empty table gives no
rows. Input columns are returned as they are in the struct `doc`, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrow.llm.common import WORD_BYTES, kept, stage, text_or_empty, texts_of

_PAD = b""


@dataclass(frozen=True)
class Fit:
    """Settings of training; per_label and longest bound the sample."""

    per_label: int = 2500
    longest: int = 30_000
    buckets: int = 1 << 15
    dim: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    epochs: int = 8
    least_steps: int = 1200
    batch: int = 32
    rate: float = 0.02
    embedding_rate: float = 0.005
    dropout: float = 0.1
    calibration_share: float = 0.2
    seed: int = 7


@dataclass
class Model:
    fit: Fit
    embedding: np.ndarray
    filters: list[np.ndarray]  # one (width, dim, filters) array for each width
    filter_bias: np.ndarray
    weights: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def word_rows(word: bytes, buckets: int) -> list[int]:
    """The embedding rows that add up to a word."""
    parts = {word, word[:4] + b"*", word[:5] + b"*"} if len(word) > 4 else {word, word + b"*"}
    return [zlib.crc32(part) % buckets for part in sorted(parts)]


def _sums(embedding: np.ndarray, words: list[bytes]) -> np.ndarray:
    buckets = len(embedding)
    rows = [word_rows(w, buckets) for w in words]
    flat = np.concatenate([np.asarray(r) for r in rows]) if rows else np.zeros(0, int)
    starts = np.cumsum([0] + [len(r) for r in rows[:-1]]) if rows else np.zeros(0, int)
    if not len(flat):
        return np.zeros((0, embedding.shape[1]), embedding.dtype)
    return np.add.reduceat(embedding[flat], starts, axis=0)


def _pads(fit: Fit) -> int:
    """Zero rows after each text. Filters begin at its words and at the first of these rows."""
    return max(fit.widths) + 1


def _responses(model: Model, x: np.ndarray) -> np.ndarray:
    """Of every filter at every position of x, where texts are parted by zero rows."""
    out = []
    for f in model.filters:
        total = x @ f[0]
        for k in range(1, len(f)):
            total[:-k] += x[k:] @ f[k]
        out.append(total)
    return np.concatenate(out, axis=1)


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0)))


def _evidence(docs: list, table: np.ndarray, labels: np.ndarray, buckets: int) -> np.ndarray:
    """How far a bucket's documents of label 1 exceed what its frequency lets expect, in deviations.

    A start for the first dimension, so that few labelled documents suffice.
    """
    toxic, total = np.zeros(buckets + 1), np.zeros(buckets + 1)
    for ids, label in zip(docs, labels):
        found = np.unique(table[ids])
        total[found] += 1
        if label:
            toxic[found] += 1
    share = float(labels.mean())
    expected = total * share
    deviations = (toxic - expected) / np.sqrt(expected * (1 - share) + 0.5)
    return (np.clip(deviations, -2, 10) / 4)[:buckets].astype(np.float32)


def train(texts: list[bytes], labels: np.ndarray, fit: Fit) -> Model:
    """Adagrad on the logistic loss; gradients flow to each filter's greatest response only."""
    rng = np.random.default_rng(fit.seed)
    k = len(fit.widths) * fit.filters
    model = Model(
        fit,
        rng.normal(0, 0.02, (fit.buckets, fit.dim)).astype(np.float32),
        [rng.normal(0, 0.3, (w, fit.dim, fit.filters)).astype(np.float32) for w in fit.widths],
        np.zeros(k, np.float32),
        rng.normal(0, 0.1, k).astype(np.float32),
        0.0,
    )
    vocabulary: dict[bytes, int] = {}
    docs = [
        np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)], np.int32)
        for t in texts
    ]
    rows = [word_rows(w, fit.buckets) for w in vocabulary]
    most = max((len(r) for r in rows), default=1)
    table = np.full((len(rows) + 1, most), fit.buckets, np.int32)
    for i, r in enumerate(rows):
        table[i, : len(r)] = r
    pad, gap = len(rows), _pads(fit)
    model.embedding[:, 0] = _evidence(docs, table, labels, fit.buckets)
    model.filters[0][0, 0, :] = 1.0
    model.filter_bias[: fit.filters] = -np.linspace(0.2, 1.5, fit.filters, dtype=np.float32)
    model.weights[: fit.filters] = 0.5
    model.bias = -1.0
    embedding = np.vstack([model.embedding, np.zeros((1, fit.dim), np.float32)])
    seen = {
        "embedding": np.full((fit.buckets + 1, 1), 1e-3, np.float32),
        "filters": [np.full_like(f, 1e-3) for f in model.filters],
        "filter_bias": np.full(k, 1e-3, np.float32),
        "weights": np.full(k, 1e-3, np.float32),
    }
    bias_seen = 1e-3
    gap_rows = np.full(gap, pad, np.int32)
    epochs = max(fit.epochs, -(-fit.least_steps // max(1, -(-len(docs) // fit.batch))))
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), fit.batch):
            chosen = order[at : at + fit.batch]
            ids = np.concatenate([np.concatenate((docs[i], gap_rows)) for i in chosen])
            starts = np.cumsum([0] + [len(docs[i]) + gap for i in chosen[:-1]])
            x = embedding[table[ids]].sum(axis=1)
            x *= rng.random((len(x), 1), np.float32) >= fit.dropout
            found = _responses(model, x)
            spots = np.array(
                [found[a : a + len(docs[i]) + 1].argmax(axis=0) + a for i, a in zip(chosen, starts)]
            )
            pooled = np.take_along_axis(found, spots, axis=0) + model.filter_bias
            active = np.maximum(pooled, 0)
            z = active @ model.weights + model.bias
            error = ((_sigmoid(z) - labels[chosen]) / len(chosen)).astype(np.float32)
            to_weights = active.T @ error + 1e-5 * model.weights
            back = error[:, None] * model.weights * (pooled > 0)
            grad_x: list[tuple[np.ndarray, np.ndarray]] = []
            for n, f in enumerate(model.filters):
                mine = slice(n * fit.filters, (n + 1) * fit.filters)
                grad = np.zeros_like(f)
                for j in range(len(f)):
                    at_word = np.minimum(spots[:, mine] + j, len(x) - 1)
                    grad[j] = np.einsum("bfd,bf->df", x[at_word], back[:, mine])
                    grad_x.append((at_word.ravel(), (back[:, mine, None] * f[j].T).reshape(-1, fit.dim)))
                seen["filters"][n] += grad * grad
                f -= fit.rate * grad / np.sqrt(seen["filters"][n])
            words = np.concatenate([a for a, _ in grad_x])
            change = np.concatenate([b for _, b in grad_x])
            for column in range(most):
                bucket = table[ids[words], column]
                used, place = np.unique(bucket, return_inverse=True)
                total = np.zeros((len(used), fit.dim), np.float32)
                np.add.at(total, place, change)
                seen["embedding"][used, 0] += (total * total).mean(axis=1)
                embedding[used] -= fit.embedding_rate * total / np.sqrt(seen["embedding"][used])
            embedding[fit.buckets] = 0
            grad = back.sum(axis=0)
            seen["filter_bias"] += grad * grad
            model.filter_bias -= fit.rate * grad / np.sqrt(seen["filter_bias"])
            seen["weights"] += to_weights * to_weights
            model.weights -= fit.rate * to_weights / np.sqrt(seen["weights"])
            slope = float(error.sum())
            bias_seen += slope * slope
            model.bias -= fit.rate * slope / bias_seen**0.5
    model.embedding = embedding[: fit.buckets]
    return model


class Scorer:
    """Scores texts with a model, keeping the filters' responses of known words."""

    def __init__(self, model: Model, keep: int = 120_000):
        self._model = model
        self._keep = keep
        self._reset()

    def _reset(self) -> None:
        self._places: dict[bytes, int] = {_PAD: 0}
        width = sum(w * self._model.fit.filters for w in self._model.fit.widths)
        self._known = np.zeros((1 << 14, width), np.float32)

    def _learn(self, words: list[bytes]) -> None:
        sums = _sums(self._model.embedding, words)
        parts = [sums @ f[j] for f in self._model.filters for j in range(len(f))]
        first = len(self._places)
        for w in words:
            self._places[w] = len(self._places)
        while len(self._known) < len(self._places):
            self._known = np.vstack([self._known, np.zeros_like(self._known)])
        self._known[first : first + len(words)] = np.concatenate(parts, axis=1)

    def scores(self, texts: Iterable[bytes], at_once: int = 200_000) -> Iterator[float]:
        group: list[list[bytes]] = []
        held = 0
        for text in texts:
            group.append(words_of(text))
            held += len(group[-1])
            if held >= at_once:
                yield from self._scored(group)
                group, held = [], 0
        if group:
            yield from self._scored(group)

    def _scored(self, group: list[list[bytes]]) -> list[float]:
        model, gap = self._model, _pads(self._model.fit)
        new = set().union(*group).difference(self._places)
        if new:
            if len(self._places) + len(new) > self._keep:
                self._reset()
                new = set().union(*group)
            self._learn(list(new))
        pads = [_PAD] * gap
        flat = [w for words in group for part in (words, pads) for w in part]
        ids = np.fromiter(map(self._places.__getitem__, flat), np.int64, len(flat))
        starts = np.cumsum([0] + [len(words) + gap for words in group[:-1]])
        ends = starts + [len(words) + 1 for words in group]
        ranges = np.column_stack((starts, ends)).ravel()
        found = self._known[ids]
        pooled, at, n = [], 0, model.fit.filters
        for f in model.filters:
            total = found[:, at : at + n].copy()
            for j in range(1, len(f)):
                total[:-j] += found[j:, at + j * n : at + (j + 1) * n]
            pooled.append(np.maximum.reduceat(total, ranges, axis=0)[::2])
            at += len(f) * n
        active = np.maximum(np.concatenate(pooled, axis=1) + model.filter_bias, 0)
        return _sigmoid(active.astype(np.float64) @ model.weights + model.bias).tolist()


def _log_odds(scores: np.ndarray) -> np.ndarray:
    clipped = np.clip(scores, 1e-6, 1 - 1e-6)
    return np.log(clipped / (1 - clipped))


def best_threshold(scores: np.ndarray, labels: np.ndarray, rows: np.ndarray | None = None) -> float:
    """The cut with the best F1: 0.5 where that separates as well, else half-way (in log-odds) between the last
    score above it and the next lower one.

    With `rows`, each score stands for so many rows, and `labels` has how many of them are toxic.
    """
    order = np.argsort(-scores, kind="stable")
    s, y = scores[order], labels[order]
    hits = np.cumsum(y)
    flagged = np.cumsum(np.ones(len(y), np.int64) if rows is None else rows[order])
    f1 = 2 * hits / (flagged + y.sum())
    f1[:-1][s[:-1] == s[1:]] = -1  # a cut cannot part equal scores
    i = int(f1.argmax())
    odds = _log_odds(s)
    below = odds[i + 1] if i + 1 < len(odds) else min(odds[i], 0) - 1
    if below < 0 <= odds[i]:
        return 0.5
    return float(_sigmoid((odds[i] + below) / 2))


def _drawn(rows: DataFrame, n: int, of: int) -> DataFrame:
    """The first n rows by hash; a draw keeps most others from being sent to be ordered."""
    share = min(1.0, 4 * n / max(1, of))
    few = rows.filter(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20)))
    return few.orderBy(F.xxhash64("id"), "id").limit(n)


@dataclass
class Learned:
    """A model without thresholds, or a plain share; the labels it may use (id, label); what it was trained on."""

    model: Model | float
    usable: DataFrame
    trained: frozenset = frozenset()


def learned(
    docs: DataFrame, labels: DataFrame, may_learn: Column, fit: Fit = Fit(), label: str = "toxic"
) -> Learned:
    """Train on labelled documents whose doc_id fulfils may_learn; a plain share if that can't be."""
    usable = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & may_learn)
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    counts = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    texts = docs.select(
        F.col("doc_id").alias("id"),
        text_or_empty("text").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )
    short = texts.filter(F.length("text") <= fit.longest)
    both = usable.join(short.select("id"), "id", "left_semi")
    chosen = _drawn(both.filter("label = 1"), fit.per_label, counts.get(1, 0)).union(
        _drawn(both.filter("label = 0"), fit.per_label, counts.get(0, 0))
    )
    sample = (
        short.join(F.broadcast(chosen), "id")  # at most 2 * per_label rows
        .groupBy("id")
        .agg(F.min("text").alias("text"), F.min("lang").alias("lang"), F.min("label").alias("label"))
        .withColumn("draw", F.pmod(F.xxhash64("id", F.lit(fit.seed)), F.lit(1000)))
        .orderBy("id")
        .collect()
    )
    toxic = sum(r["label"] for r in sample)
    if toxic == 0 or toxic == len(sample):
        return Learned(share, usable)
    taught = [r for r in sample if r["draw"] >= 1000 * fit.calibration_share]
    if len({r["label"] for r in taught}) < 2:
        taught = sample
    model = train(
        [r["text"].encode() for r in taught],
        np.array([r["label"] for r in taught], np.float32),
        fit,
    )
    seen = sum(r["label"] for r in taught) / len(taught)
    prior = min(max(share, 1e-4), 1 - 1e-4)
    model.bias += float(np.log(prior / (1 - prior)) - np.log(seen / (1 - seen)))
    trained = frozenset(r["id"] for r in taught)  # at most 2 * per_label
    if len({r["label"] for r in sample if r["id"] not in trained}) < 2:
        trained = frozenset()
    return Learned(model, usable, trained)


def fitted(
    docs: DataFrame, labels: DataFrame, may_learn: Column, fit: Fit = Fit(), label: str = "toxic"
) -> Model | float:
    """A model with its thresholds, for documents other than these as well."""
    found = learned(docs, labels, may_learn, fit, label)
    if isinstance(found.model, Model):
        ids = docs.select("doc_id", "text", "lang")
        calibrate(found, stage(scored(ids, found.model, ("doc_id",)), "scores"))
    return found.model


_BINS = 64  # of a histogram, for each unit of log-odds
_OWN_CUT = 10  # toxic rows from which a language has a threshold of its own


def calibrate(found: Learned, scores: DataFrame) -> None:
    """Set the thresholds by all labelled rows of `scored` documents.

    What a model says of rows that it was trained on tells nothing of others: rows of these ids count
    by their language and label only.
    """
    of_ids = scores.select(F.col("doc.doc_id").alias("id"), "lang", "score")
    labelled = of_ids.join(found.usable, "id")
    bins = stage(histograms(labelled, found.trained), "toxicity-histograms")
    model = found.model
    common = bins.groupBy("bin").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    counted = common.toArrow()  # under 2,000 rows
    if counted.num_rows == 0:
        return
    model.threshold = _cut(counted)

    def cut(key: tuple, rows: pa.Table) -> pa.Table:
        scored = rows.filter(pc.is_valid(rows.column("bin")))
        toxic, n = (pc.sum(scored.column(c)).as_py() or 0 for c in ("toxic", "n"))
        own = _OWN_CUT <= toxic < n
        return pa.table(
            {
                "lang": pa.array([key[0].as_py()] * own, pa.string()),
                "cut": pa.array([_cut(rows)] if own else [], pa.float64()),
            }
        )

    named = bins.filter(F.col("lang").isNotNull()).groupBy("lang")
    cuts = named.applyInArrow(cut, "lang string, cut double").collect()
    model.thresholds = {r["lang"]: r["cut"] for r in cuts}


def histograms(labelled: DataFrame, trained: frozenset = frozenset()) -> DataFrame:
    """lang, bin (of the score's log-odds; NULL for trained ids), toxic and n: rows of each."""
    spark = labelled.sparkSession
    taught = spark.createDataFrame([(i, True) for i in trained], "id long, taught boolean")
    clipped = F.least(F.greatest("score", F.lit(1e-6)), F.lit(1 - 1e-6))
    place = F.floor(F.log(clipped / (1 - clipped)) * _BINS).cast("long")
    rows = labelled.join(F.broadcast(taught), "id", "left")  # at most 2 * per_label
    return rows.groupBy("lang", F.when(F.col("taught").isNull(), place).alias("bin")).agg(
        F.sum((F.col("label") > 0).cast("long")).alias("toxic"), F.count("*").alias("n")
    )


def score_histograms(
    model: Model, labelled: DataFrame, trained: frozenset = frozenset()
) -> DataFrame:
    """`histograms` of rows of id, text, lang and label."""
    rows = scored(labelled, model, ("id", "label"))
    return histograms(rows.select("doc.id", "doc.label", "lang", "score"), trained)


def _cut(bins: pa.Table) -> float:
    known = bins.filter(pc.is_valid(bins.column("bin")))
    place, toxic, n = (known.column(c).to_numpy() for c in ("bin", "toxic", "n"))
    all_toxic, all_n = (pc.sum(bins.column(c)).as_py() for c in ("toxic", "n"))
    clean = n - toxic
    toxic = toxic * (all_toxic / max(1, toxic.sum()))
    clean = clean * ((all_n - all_toxic) / max(1, clean.sum()))
    return best_threshold(_sigmoid((place + 0.5) / _BINS), toxic, toxic + clean)


def scored(docs: DataFrame, model: Model | float, keep: Sequence[str] | None = None) -> DataFrame:
    """doc (the input columns, or those to keep), lang and score."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((uuid4().hex, model))  # some MB, whatever the size of the corpus

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, model = shared.value
        if isinstance(model, Model):
            scorer = kept(("scorer", name), lambda: Scorer(model))
        for batch in batches:
            if isinstance(model, Model):
                scores = list(scorer.scores(texts_of(batch)))
            else:
                scores = [model] * len(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("lang"), pa.array(scores, pa.float64())],
                ["doc", "lang", "score"],
            )

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("doc"),
        text_or_empty("text").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc {kind}, lang string, score double")


def judged(scores: DataFrame, model: Model | float) -> DataFrame:
    """doc, score, threshold and rejected of `scored` documents, by the thresholds of their languages."""
    if not isinstance(model, Model):
        cut = F.lit(0.5)
        cuts = None
    else:
        cuts = scores.sparkSession.createDataFrame(
            list(model.thresholds.items()), "lang string, cut double"
        )
        cut = F.coalesce("cut", F.lit(model.threshold))
    # A row for each language, which the driver has anyway; the scored documents stay where they are.
    rows = scores if cuts is None else scores.join(F.broadcast(cuts), "lang", "left")
    return rows.select(
        "doc", "score", cut.alias("threshold"), (F.col("score") >= cut).alias("rejected")
    )


def toxicity(docs: DataFrame, model: Model | float) -> DataFrame:
    """doc (all input columns), score, threshold, rejected, by a model fitted before."""
    return judged(scored(docs, model), model)


def self_judged(
    docs: DataFrame,
    labels: DataFrame,
    may_learn: Column,
    keep: Sequence[str] | None = None,
    fit: Fit = Fit(),
) -> DataFrame:
    """doc (the input columns, or those to keep), score, threshold, rejected, by a model learned from the same
    documents' labels. Each document is scored once, and stored with its score."""
    found = learned(docs, labels, may_learn, fit)
    scores = stage(scored(docs, found.model, keep), "scores")
    if isinstance(found.model, Model):
        calibrate(found, scores)
    return judged(scores, found.model)
