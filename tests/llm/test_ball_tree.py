"""Ranked search against scoring every document, and the bounds of the ball tree."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from plumbrow.llm import ball_tree
from plumbrow.llm.ball_tree import Best, Queries, Sparse, built, ranked_documents, search_block, terms_of
from tests.llm.fixtures import awkward_rows, table, words

ITEMS = "item_id long, text string, doc_id string, rank string"
LAST = 1 << 63


def by_force(docs, items, k=10):
    counted = [(doc_id, Counter(terms_of((text or "").encode()))) for doc_id, text in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    queries = {}
    for item, text in items:
        queries.setdefault(item, set()).update(terms_of((text or "").encode()))
    found = set()
    for item, terms in queries.items():
        scored = []
        for doc_id, c in counted:
            m = 100 - 90 + 90 * sum(c.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms & c.keys()
            )
            if score > 0:
                scored.append((-score, LAST if doc_id is None else doc_id, doc_id))
        scored.sort(key=lambda x: x[:2])
        found |= {(item, i, d, -s) for i, (s, _, d) in enumerate(scored[:k], 1)}
    return found


def of(spark, rows, items, **options):
    docs = table(spark, rows)
    queries = spark.createDataFrame([(i, t, "d", "r") for i, t in items], ITEMS)
    found = ranked_documents(docs, queries, **options).collect()
    result = {(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found}
    assert len(result) == len(found)
    return result


def items_of(rows):
    texts = [r[1] for r in rows if r[1]]
    some = [" ".join(t.split()[:30]) for t in texts[::3]]
    return [*enumerate(some), (0, "further TERMS ka"), (500, None), (501, "!"), (502, "absent"), (None, "ka lo"), (503, "中文 \U0001f600 Ünï ab AB")]


@pytest.mark.parametrize("block_bytes", [1 << 19, 300])
def test_ranks_are_those_of_scoring_everything(spark, block_bytes, monkeypatch):
    rows = awkward_rows()
    items = items_of(rows)
    expected = by_force([r[:2] for r in rows], items)
    assert of(spark, rows, items, block_bytes=block_bytes) == expected


def test_sample_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    found = {tuple(r) for r in ranked_documents(docs, benchmark).collect()}
    assert found == by_force(rows, items)


def test_many_equal_documents_and_a_very_long_one(spark):
    rows = [(i, "common words of a copy", "en", "hot") for i in range(3000, 0, -1)]
    rows += [(5000, "common " * 2_000_000 + "needle", "en", "a"), (5001, "needle", "en", "a")]
    items = [(1, "common copy"), (2, "needle")]
    assert of(spark, rows, items) == by_force([r[:2] for r in rows], items)


def test_empty_tables(spark):
    assert of(spark, [], [(1, "a")]) == set()
    assert of(spark, [(1, "a", "en", "a")], []) == set()


def random_block(seed, n=900, width=60, n_queries=25):
    rng = np.random.default_rng(seed)
    rows = [rng.choice(width, rng.integers(1, 12), replace=False) for _ in range(n)]
    rows[100:400] = [rows[5]] * 300
    starts = np.cumsum([0, *map(len, rows)])
    values = rng.integers(0, 10**10, starts[-1])
    asked = [rng.choice(width, rng.integers(1, 8), replace=False) for _ in range(n_queries)]
    queries = Queries(np.cumsum([0, *map(len, asked)]), np.concatenate(asked))
    return Sparse(starts, np.concatenate(rows), values, width), queries


def scores_of(docs, queries, q):
    wanted = np.zeros(docs.width, np.int64)
    wanted[queries.of(q)] = 1
    return docs.times(wanted)


@pytest.mark.parametrize("seed", range(3))
def test_bounds_hold_at_every_node(seed):
    docs, queries = random_block(seed)
    tree = built(docs, queries)
    for q in range(len(queries)):
        scores = scores_of(docs, queries, q)[tree.order]
        for node, (a, z) in enumerate(zip(tree.first, tree.stop)):
            assert scores[a:z].max() <= tree.bounds[node, q]


def test_search_skips_leaves_and_stays_exact():
    rng = np.random.default_rng(1)
    # Sixty topics with words of their own: most leaves cannot hold a query's best.
    rows = [rng.choice(10, 6, replace=False) + 10 * (i % 60) for i in range(6000)]
    docs = Sparse(np.arange(0, 36_001, 6), np.concatenate(rows), rng.integers(1, 10**9, 36_000), 600)
    asked = [np.arange(10 * t, 10 * t + 10) for t in range(60)]
    queries = Queries(np.arange(0, 601, 10), np.concatenate(asked))
    best = Best(60, 10)
    ids = rng.permutation(6000)
    scored = search_block(docs, ids, queries, best)
    assert scored < 60 * 6000 / ball_tree.LEAF / 4
    for q in range(60):
        scores = scores_of(docs, queries, q)
        kept = np.lexsort((ids, -scores))[:10]
        assert best.ids[q].tolist() == ids[kept].tolist()
        assert best.scores[q].tolist() == scores[kept].tolist()
