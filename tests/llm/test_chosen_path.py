"""Near-duplicate sets against comparing all pairs."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from plumbrow.llm import chosen_path
from plumbrow.llm.chosen_path import minwise, near_sets, shingles_of, survival, trees_for
from plumbrow.llm.common import WordHashes
from tests.llm.fixtures import awkward_rows, table, words

LAST = 1 << 63


def set_of(text, length):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + length]) for i in range(max(1, len(w) - length + 1)))


def by_force(rows, length=2, percent=80):
    """(doc_id, n_shingles, component_id, kept) of every row."""
    sets = [set_of(text, length) for _, text in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    common = defaultdict(int)
    for h in holders.values():
        for k, i in enumerate(h):
            for j in h[k + 1 :]:
                common[i, j] += 1
    for (i, j), n in common.items():
        if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
            group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = root(i)
        least[r] = min(least.get(r, LAST), LAST if doc_id is None else doc_id)
    found = []
    for i, (doc_id, _) in enumerate(rows):
        c = None if least[root(i)] == LAST else least[root(i)]
        found.append((doc_id, len(sets[i]), c, doc_id == c))
    return sorted(found, key=repr)


def of(spark, rows, **options):
    docs = table(spark, [r if len(r) == 4 else (*r, "en", "a") for r in rows])
    return sorted((tuple(r) for r in near_sets(docs, **options).collect()), key=repr)


def edited(text, n, seed):
    """The text with n of its words replaced."""
    rng = random.Random(seed)
    w = text.split()
    for i in rng.sample(range(len(w)), n):
        w[i] = f"new{rng.random()}"
    return " ".join(w)


@pytest.mark.parametrize("length", [2, 5])
def test_awkward_rows(spark, length):
    rows = awkward_rows()
    assert of(spark, rows, length=length) == by_force([r[:2] for r in rows], length)


def test_sample_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = sorted((tuple(r) for r in near_sets(docs, length=2).collect()), key=repr)
    assert found == by_force(rows)


def test_pairs_on_the_limit_are_found(spark):
    rows = []
    for i in range(250):
        base = words(90, 1000 + i)
        rows += [(2 * i, base), (2 * i + 1, edited(base, 2 + i % 4, i))]
    expected = by_force(rows)
    assert 150 < sum(not r[3] for r in expected) < 250
    assert of(spark, rows, length=2) == expected


def test_dense_nodes_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "DEEPEST", 3)
    base = words(120, 5)
    # A crowd of near copies, and chains that leave it step by step.
    rows = [(i, edited(base, 2, i)) for i in range(150)]
    for c in range(5):
        text = base
        for k in range(8):
            text = edited(text, 5, 100 * c + k)
            rows.append((1000 + 10 * c + k, text))
    rows += [(5000 + i, words(100, 9000 + i)) for i in range(60)]
    assert of(spark, rows, length=2, leaf=12, unit=20) == by_force(rows)


def test_crowds_end_in_few_nodes(spark, monkeypatch):
    paths, stage = [], chosen_path.stage

    def counted(df, label):
        staged = stage(df, label)
        if label == "paths":
            paths.append(staged.count())
        return staged

    monkeypatch.setattr(chosen_path, "stage", counted)
    base = words(120, 6)
    rows = [(i, edited(base, 2, i)) for i in range(200)]
    text = base
    for k in range(8):  # a chain that leaves the crowd
        text = edited(text, 5, 700 + k)
        rows.append((1000 + k, text))
    rows += [(5000 + i, words(100, 9500 + i)) for i in range(40)]
    assert of(spark, rows, length=2, leaf=20, unit=30) == by_force(rows)
    assert sum(paths[3:]) < paths[2]  # from five choices on; a crowd that goes on grows by a quarter each time


def test_copies_and_very_long_texts(spark):
    long = words(400_000, 3)
    rows = [(i, "the same words in every copy of it", "en", "hot") for i in range(2000)]
    rows += [(9001, long, "en", "a"), (9000, edited(long, 5_000, 1), "en", "a"), (9002, words(50, 8), "en", "a")]
    found = {r[0]: r for r in of(spark, rows, length=2)}
    assert all(found[i][2] == 0 and found[i][3] == (i == 0) for i in range(2000))
    assert found[9001][2:] == (9000, False) and found[9000][3] and found[9002][3]
    assert len(found) == len(rows)


def test_empty_table(spark):
    assert of(spark, []) == []
    assert of(spark, [(1, ""), (2, None)]) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_signatures_estimate_similarity():
    hashes = WordHashes()
    a = words(300, 1)
    b = edited(a, 30, 2)
    x, y = (shingles_of(t.encode(), hashes) for t in (a, b))
    true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert abs((minwise(x) == minwise(y)).mean() - true) < 0.15
    assert set_of(a, 2) and len(x) == len(set_of(a, 2))


def test_trees_reach_the_recall():
    for depth in range(1, 8):
        assert survival(0.8, depth + 1) < survival(0.8, depth)
    assert (1 - survival(0.8, 4)) ** trees_for(0.999, 0.8) <= 0.001
