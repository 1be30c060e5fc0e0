"""Toxicity by held-out accuracy, the language model by its sums and against word counts."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbrow.llm.gru import Net, Shape, gradient, log_probabilities, score_documents
from plumbrow.llm.language_model import Settings, scored, tokens_of, vocabulary, word_counts
from plumbrow.llm.queries import QUERIES
from plumbrow.llm.toxicity import (
    Learned,
    calibrate,
    self_judged,
    word_rows,
    Fit,
    Model,
    Scorer,
    best_threshold,
    fitted,
    score_histograms,
    toxicity,
    words_of,
)
from tests.llm.fixtures import awkward_rows, table, words

SF = "/root/testdata/sf0.1"


def held_out_labels(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    return {
        r["doc_id"]: r["toxic"] for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
    }


def test_held_out_toxicity(spark):
    found = {r["doc_id"]: r for r in QUERIES["op1_toxicity"](spark, SF).collect()}
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found.values())
    labels = held_out_labels(spark, SF)
    assert all(found[i]["held_out"] for i in labels)
    hits = sum(found[i]["predicted"] for i, y in labels.items() if y)
    alarms = sum(found[i]["predicted"] for i, y in labels.items() if not y)
    assert hits >= 0.85 * sum(labels.values())
    assert alarms <= 0.02 * len(labels)


def labelled(spark, n=240):
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = f"{words(30, 1000 + i)} {'nasty, word' if toxic else 'kind word'} {words(20, i)}"
        rows.append((i, text, "en" if i % 3 else "de", "a"))
        labels.append((i, int(toxic)))
    labels += [(1, None), (None, 1), (n + 5, 1)]
    return table(spark, rows + awkward_rows()[3:6]), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_learns_words_and_keeps_columns(spark):
    docs, labels = labelled(spark)
    model = fitted(docs, labels, F.col("doc_id") % 5 != 0, Fit(least_steps=200))
    assert isinstance(model, Model) and 0 < model.threshold < 1
    found = toxicity(docs, model).select("doc.*", F.col("score").alias("toxicity"), "rejected").collect()
    assert len(found) == docs.count() and found[0]["score"] == "s"
    judged = [r for r in found if r["text"] and "word" in r["text"] and r["doc_id"] % 5 == 0]
    assert [r["rejected"] for r in judged] == ["nasty" in r["text"] for r in judged]
    assert not any(r["rejected"] for r in found if not (r["text"] or "").strip())


def test_scores_do_not_depend_on_what_else_is_scored(spark):
    docs, labels = labelled(spark)
    model = fitted(docs, labels, F.lit(True), Fit(least_steps=50))
    texts = [f"{words(n, n)} nasty".encode() for n in range(0, 60, 7)] + [b"", b"a"]
    alone = [next(Scorer(model).scores([t])) for t in texts]
    assert list(Scorer(model, keep=20).scores(texts, at_once=10)) == pytest.approx(alone, abs=1e-6)


def test_labels_of_one_kind_give_their_share(spark):
    docs = table(spark, awkward_rows())
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    found = toxicity(docs, fitted(docs, labels, F.lit(True))).collect()
    assert {r["score"] for r in found} == {0.0} and len(found) == docs.count()
    none = spark.createDataFrame([], "doc_id long, toxic int")
    empty = table(spark, [])
    assert toxicity(empty, fitted(empty, none, F.lit(True))).collect() == []


def test_threshold_parts_the_labels():
    scores = np.array([0.9, 0.8, 0.45, 0.1, 0.05])
    cut = best_threshold(scores, np.array([1, 1, 1, 0, 0]))
    assert 0.1 < cut <= 0.45
    assert words_of("Nasty, WORD-s!".encode()) == [b"nasty", b"word", b"s"]


def test_thresholds_are_not_clamped():
    scores = np.array([0.97, 0.9, 0.8, 0.6, 0.58, 0.55, 0.1])
    cut = best_threshold(scores, np.array([1, 1, 1, 0, 0, 0, 0]))
    assert 0.7 < cut < 0.72
    low = best_threshold(np.array([0.05, 0.04, 0.001]), np.array([1, 1, 0]))
    assert 0.001 < low < 0.04


def test_scores_equal_a_naive_convolution(spark):
    docs, labels = labelled(spark)
    model = fitted(docs, labels, F.lit(True), Fit(least_steps=50))
    fit = model.fit

    def naive(text):
        found = words_of(text)
        x = [sum(model.embedding[r].astype(float) for r in word_rows(w, fit.buckets)) for w in found]
        x += [np.zeros(fit.dim)] * (max(fit.widths) + 1)
        z, k = model.bias, 0
        for f in model.filters:
            for n in range(f.shape[2]):
                responses = [
                    sum(float(x[at + j] @ f[j, :, n]) for j in range(len(f)))
                    for at in range(len(found) + 1)
                ]
                z += max(max(responses) + float(model.filter_bias[k]), 0) * float(model.weights[k])
                k += 1
        return 1 / (1 + np.exp(-z))

    texts = [b"", b"a", b"nasty, word", f"{words(40, 3)} nasty, word {words(9, 4)}".encode()]
    assert list(Scorer(model).scores(texts)) == pytest.approx([naive(t) for t in texts], abs=1e-5)


def test_each_language_has_the_cut_that_separates_best(spark):
    """Against trying every cut between two histogram bins."""
    rng = np.random.default_rng(6)
    rows = [
        (i, lang, float(1 / (1 + np.exp(-rng.normal(2.5 * y - shift, 1.2)))), int(y))
        for i, (lang, y, shift) in enumerate(
            (lang, rng.random() < share, shift)
            for lang, share, shift in [("a", 0.3, 1), ("b", 0.1, -1), (None, 0.2, 0)]
            for _ in range(300)
        )
    ]
    found = Learned(Model(Fit(), *[np.zeros(0)] * 5, 0.0), spark.createDataFrame([(r[0], r[3]) for r in rows], "id long, label int"))
    scores = spark.createDataFrame([((r[0],), r[1], r[2]) for r in rows], "doc struct<doc_id: long>, lang string, score double")
    calibrate(found, scores)

    def f1(cut, mine):
        hits = sum(y for _, _, s, y in mine if s >= cut)
        return 2 * hits / (sum(s >= cut for _, _, s, _ in mine) + sum(y for *_, y in mine))

    cuts = {**found.model.thresholds, None: found.model.threshold}
    assert set(cuts) == {"a", "b", None}
    for lang, cut in cuts.items():
        mine = rows if lang is None else [r for r in rows if r[1] == lang]
        bins = np.arange(-700, 700) / 64
        best = max(f1(1 / (1 + np.exp(-b)), mine) for b in bins)
        assert f1(cut, mine) >= best - 0.01


def test_no_text_is_shuffled_to_find_thresholds(spark):
    docs, labels = labelled(spark)
    found = self_judged(docs, labels, F.lit(True), keep=("doc_id",), fit=Fit(least_steps=50))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan
    assert found.count() == docs.count()
    whole = self_judged(docs, labels, F.lit(True), fit=Fit(least_steps=50))
    assert {r["doc_id"] for r in whole.select("doc.*").collect()} == {r["doc_id"] for r in docs.collect()}


def test_thresholds_come_from_all_labelled_rows(spark):
    """Ten toxic rows of a language suffice, beyond the training sample and in texts of any length."""
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        rows.append((i, f"{words(30, i)} {'nasty' if toxic else 'kind'} word", "en", "a"))
        labels.append((i, int(toxic)))
    for i in range(400, 440):
        toxic = i % 2 == 0
        rows.append((i, f"{words(300, i)} {'nasty' if toxic else 'kind'} word", "xx", "a"))
        labels.append((i, int(toxic)))
    docs = table(spark, rows)
    labelled_rows = spark.createDataFrame(labels, "doc_id long, toxic int")
    small = Fit(per_label=60, longest=500, least_steps=50)
    model = fitted(docs, labelled_rows, F.lit(True), small)
    assert set(model.thresholds) == {"en", "xx"}
    joined = docs.select("doc_id", "text", "lang").join(labelled_rows, "doc_id")
    named = joined.select(F.col("doc_id").alias("id"), "text", "lang", F.col("toxic").alias("label"))
    bins = score_histograms(model, named, frozenset([0, 1])).collect()
    assert sum(r["n"] for r in bins if r["bin"] is None) == 2
    sums = Counter()
    for r in bins:
        sums[r["lang"], "toxic"] += r["toxic"]
        sums[r["lang"], "n"] += r["n"]
    assert sums == {("en", "toxic"): 100, ("en", "n"): 400, ("xx", "toxic"): 20, ("xx", "n"): 40}


def test_threshold_of_counted_scores_is_that_of_the_rows():
    rng = np.random.default_rng(12)
    scores, labels = np.round(rng.random(500), 2), (rng.random(500) < 0.3).astype(int)
    values, place = np.unique(scores, return_inverse=True)
    n, toxic = np.bincount(place), np.bincount(place, labels).astype(int)
    assert best_threshold(values, toxic, n) == pytest.approx(best_threshold(scores, labels))


# language model


def test_the_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(7)
    shape = Shape(6, (3, 4, 2), dim=3, hidden=4)
    net = Net(shape)
    net.flat[:] = rng.normal(0, 0.4, len(net.flat))
    inputs = rng.integers(0, 10, (5, 3))
    classes = rng.integers(0, 3, (5, 3))
    members = np.array([[rng.integers(0, shape.sizes[c]) for c in row] for row in classes])
    fresh = np.zeros((5, 3), bool)
    fresh[2, 1] = True
    weight = np.ones((5, 3), np.float32)
    state = rng.normal(0, 0.3, (3, 4)).astype(np.float32)

    def loss(flat):
        from plumbrow.llm.gru import forward

        changed = Net(shape, flat)
        states, _, _ = forward(changed, inputs, fresh, state)
        found = log_probabilities(changed, states.reshape(-1, 4), classes.ravel(), members.ravel())
        return -found.mean(dtype=np.float64)

    grad, _ = gradient(net, inputs, fresh, classes, members, weight, state)
    for i in rng.choice(len(net.flat), 60, replace=False):
        up, down = net.flat.copy(), net.flat.copy()
        up[i] += 1e-2
        down[i] -= 1e-2
        assert grad.flat[i] == pytest.approx((loss(up) - loss(down)) / 2e-2, abs=2e-3)


def made_up_window():
    """A net, its window of 5 steps and 3 lanes with a fresh step, and the state before."""
    rng = np.random.default_rng(12)
    net = Net(Shape(6, (3, 4, 2, 1), dim=3, hidden=4))
    net.flat[:] = rng.normal(0, 0.4, len(net.flat))
    classes = rng.integers(0, 3, (5, 3))  # none of the last
    members = np.array([[rng.integers(0, net.shape.sizes[c]) for c in row] for row in classes])
    fresh = np.zeros((5, 3), bool)
    fresh[2, 1] = True
    state = rng.normal(0, 0.3, (3, 4)).astype(np.float32)
    return net, rng.integers(0, 11, (5, 3)), fresh, classes, members, np.ones((5, 3), np.float32), state


def test_states_are_those_of_a_plain_gated_unit():
    from plumbrow.llm.gru import forward, input_table

    net, inputs, fresh, *_, state = made_up_window()
    before = net.flat.copy()
    expected, s = [], state.astype(np.float64)
    for row, new in zip(inputs, fresh):
        s = np.where(new[:, None], 0, s)
        x, a = net.embedding[row].astype(np.float64) @ net.w + net.b, s @ net.u
        z, r = (1 / (1 + np.exp(-(x + a)[:, i : i + 4])) for i in (0, 4))
        s = z * s + (1 - z) * np.tanh(x[:, 8:] + r * a[:, 8:])
        expected.append(s)
    for table in (None, input_table(net)):
        states, last, _ = forward(net, inputs, fresh, state, table=table)
        assert states == pytest.approx(np.array(expected), abs=1e-5)
        assert last == pytest.approx(expected[-1], abs=1e-5)
    assert (net.flat == before).all()


def test_a_reused_gradient_holds_nothing_of_the_window_before():
    net, *window = made_up_window()
    before = net.flat.copy()
    used = Net(net.shape)
    used.flat[:] = np.nan
    gradient(net, *window, used)
    assert (used.flat == gradient(net, *window)[0].flat).all()
    assert (net.flat == before).all()


def test_large_logits_do_not_overflow():
    """The softmaxes shift only where they must; a shift of all logits changes nothing."""
    net, *window = made_up_window()
    expected = gradient(net, *window)[0].flat
    net.class_b += 200
    net.member_b -= 200
    assert gradient(net, *window)[0].flat == pytest.approx(expected, abs=1e-4)
    states, classes, members = np.zeros((2, 4), np.float32), np.array([0, 2]), np.array([1, 1])
    found = log_probabilities(net, states, classes, members)
    net.class_b -= 200
    net.member_b += 200
    assert found == pytest.approx(log_probabilities(net, states, classes, members), abs=1e-4)


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(8)
    shape = Shape(6, (3, 4, 2), dim=3, hidden=4)
    net = Net(shape)
    net.flat[:] = rng.normal(0, 0.5, len(net.flat))
    pairs = [(c, m) for c, size in enumerate(shape.sizes) for m in range(size)]
    states = np.repeat(rng.normal(0, 1, (1, 4)).astype(np.float32), len(pairs), axis=0)
    found = log_probabilities(net, states, *(np.array(x) for x in zip(*pairs)))
    assert np.exp(found).sum() == pytest.approx(1, abs=1e-5)


def test_a_document_scores_the_same_in_any_company():
    """Its state is carried over all windows and starts anew with each document."""
    rng = np.random.default_rng(9)
    shape = Shape(6, (3, 4, 2), dim=3, hidden=4)
    net = Net(shape)
    net.flat[:] = rng.normal(0, 0.5, len(net.flat))

    def document(n):
        c = rng.integers(0, 3, n)
        m = np.array([rng.integers(0, shape.sizes[x]) for x in c], np.int64)
        return rng.integers(0, 9, n).astype(np.int32), c.astype(np.int16), m

    docs = [document(n) for n in (1, 2, 40, 7, 100, 3, 33)]
    alone = [score_documents(net, [d], 9, lanes=1, steps=1000)[0] for d in docs]
    assert score_documents(net, docs, 9, lanes=2, steps=4) == pytest.approx(alone, rel=1e-4)


def test_scoring_a_very_long_document_needs_little_memory():
    import tracemalloc

    rng = np.random.default_rng(11)
    shape = Shape(6, (3, 4, 2), dim=3, hidden=4)
    net = Net(shape)
    net.flat[:] = rng.normal(0, 0.5, len(net.flat))
    sizes = [100_000] + [5] * 255
    docs = [(np.zeros(n, np.int32), np.zeros(n, np.int16), np.zeros(n, np.int32)) for n in sizes]
    tracemalloc.start()
    found = score_documents(net, docs, 9)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50_000_000
    assert found[:2] == pytest.approx([score_documents(net, [d], 9)[0] for d in docs[:2]], rel=1e-4)


def test_training_covers_every_token_with_the_state_carried():
    """Every token is in one window, after its predecessor, whichever lane its document is in."""
    from plumbrow.llm.gru import Feed, train

    rng = np.random.default_rng(10)
    shape = Shape(6, (3, 4, 2), dim=3, hidden=4)

    def document(n):
        c = rng.integers(0, 3, n)
        m = np.array([rng.integers(0, shape.sizes[x]) for x in c], np.int64)
        return rng.integers(0, 9, n).astype(np.int32), c.astype(np.int16), m

    docs = [document(n) for n in (1, 300, 2, 40, 1000, 7, 16, 3, 33)]
    feed = Feed([iter(docs)] * 1, 9)
    seen = []
    while feed.running():
        w = feed.window(16)
        seen.append([x[w.weight > 0] for x in (w.inputs, w.fresh, w.classes, w.members)])
    inputs, fresh, classes, members = (np.concatenate(x) for x in zip(*seen))
    assert inputs.tolist() == [i for x, _, _ in docs for i in [9, *x[:-1].tolist()]]
    assert fresh.tolist() == [i == 0 for x, _, _ in docs for i in range(len(x))]
    assert classes.tolist() == [i for _, c, _ in docs for i in c.tolist()]
    assert members.tolist() == [i for _, _, m in docs for i in m.tolist()]
    net = Net(shape)
    net.flat[:] = rng.normal(0, 0.4, len(net.flat))
    assert train(net, iter(docs), 9, lanes=4, steps=16, rate=0.01) == sum(len(x) for x, _, _ in docs)
    assert np.isfinite(net.flat).all()


def test_the_rest_of_long_documents_is_learned(spark):
    """A few long documents of one cycle of words: one stretch of each would teach little."""
    cycle = [f"w{i:02d}x{i:02d}" for i in range(30)]
    rows = [(i, " ".join((cycle[i % 30 :] + cycle[: i % 30]) * 300), "en", "a") for i in range(8)]
    found = scored(table(spark, rows).coalesce(1), F.lit(True)).collect()
    gain = sum(r["score"] - r["base_score"] for r in found) / sum(r["n_tokens"] for r in found)
    assert gain > 0.3


def is_held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


@pytest.mark.parametrize("head", [10, 200_000])
def test_counts_and_base_scores(spark, head):
    rows = awkward_rows()
    learns = ~(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2)
    settings = Settings(words=20, classes=5, head=head)
    found = scored(table(spark, rows), learns, settings).collect()
    counts: Counter = Counter()
    for i, text, *_ in rows:
        if not is_held_out(i):
            counts.update(tokens_of((text or "").encode()))
    n, v = sum(counts.values()), len(counts)
    expected = []
    for i, text, *_ in rows:
        tokens = tokens_of((text or "").encode())
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        expected.append((i, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 6)))
    got = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all(r["score"] < 0 for r in found)


def test_the_model_is_a_distribution_over_all_words(spark):
    """One unknown word and all known ones, after an empty context."""
    rows = awkward_rows()
    counts = word_counts(table(spark, rows))
    known = vocabulary(counts, Settings(words=20, classes=5, head=40))
    net = known.started_net()
    total = 0.0
    listed = {bytes(r["word"]): r["n"] for r in counts.collect()}
    for word, n in listed.items():
        _, inputs, classes, members = known.encoded([word])
        p = math.exp(score_documents(net, [(inputs, classes, members)], known.begin)[0])
        index = known.index[word]
        if index < 0 or index >= known.modelled:
            c = int(classes[0])
            p *= (n + 1) / (known.others_n[c] + known.others_v[c] + 1)
        total += p
    unknown = [p for c in range(5) for p in [1 / (known.others_n[c] + known.others_v[c] + 1)]]
    assert total < 1 and total + max(unknown) * 1.0 >= 0.9


def test_learned_scores_beat_counts_on_held_out_text(spark):
    found = QUERIES["op7_language_model"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert np.mean([r["score"] > r["base_score"] for r in held]) >= 0.9


def test_empty_table(spark):
    assert scored(table(spark, []), F.lit(True)).collect() == []


def test_without_training_documents(spark):
    found = scored(table(spark, awkward_rows()), F.lit(False)).collect()
    assert {r["base_score"] for r in found} == {0.0}
    assert {(r["n_known"], r["train_tokens"]) for r in found} == {(0, 0)}
