"""Operators on documents against brute force, on awkward rows, empty tables and sample tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from plumbrow.llm.decontaminate import contaminated, contamination, items_digest
from plumbrow.llm.digest import CEILING, compared, difference, digest, likeness
from plumbrow.llm.lines import _block_keys, deduplicated
from plumbrow.llm.mph import PerfectHash
from plumbrow.llm.queries import QUERIES
from plumbrow.llm.simhash import block_masks, first_of_each, hex_of, near_duplicates
from plumbrow.llm.common import WordHashes
from plumbrow.llm.suffixes import group_borders, maximal_repeats, paths_of, without_repeats
from plumbrow.llm.words import Words
from tests.llm.fixtures import awkward_rows, table, words

SF = "/root/testdata/sf0.001"
LAST = 1 << 63


def low(text: str) -> str:
    return (text or "").encode().lower().decode()


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def rank(doc_id: int | None) -> int:
    return LAST if doc_id is None else doc_id


def sample_rows(spark) -> list[tuple]:
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]


@pytest.fixture(scope="module", params=["awkward", "sample"])
def rows(request, spark):
    return awkward_rows() if request.param == "awkward" else sample_rows(spark)


def as_sorted(found) -> list[tuple]:
    return sorted((tuple(r) for r in found), key=repr)


# line deduplication


def lines_by_force(rows):
    key = lambda line: low(line.strip(" \t\n\x0b\f\r"))
    holders = defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(rank(i))
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(key(x)) < 10 or min(holders[key(x)]) == rank(i)]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def test_lines(spark, rows):
    found = deduplicated(table(spark, rows)).select(
        "doc.doc_id", "n_lines", "n_dropped", "kept_text"
    )
    assert as_sorted(found.collect()) == sorted(lines_by_force(rows), key=repr)


def test_places_of_keys_do_not_depend_on_the_order_of_rows():
    texts = [f"line number {i}\nanother line {i % 7}\nshort".encode() for i in range(200)]

    def placed(rows):
        return {s: [keys[p] for p in mine] for s, keys, mine, _ in _block_keys(rows, 10, 5)}

    assert placed(texts) == placed(texts[::-1]) == placed(texts[90:] + texts[:90])


def test_lines_keep_other_columns(spark):
    found = deduplicated(table(spark, awkward_rows())).select("doc.*").drop_duplicates(["score"])
    assert [r["score"] for r in found.collect()] == ["s"]
    assert found.columns == [c for c in table(spark, []).columns if c != "text"]


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        built = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
        assert sorted(built.slots(keys).tolist()) == list(range(len(keys)))
        strangers = built.slots(rng.integers(0, 1 << 63, 100, dtype=np.uint64))
        assert ((strangers >= -1) & (strangers < max(1, len(keys)))).all()


# near-duplicates


def fingerprint_by_force(text: str) -> int:
    found = low(text).encode().split()
    shingles = [b" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_force(rows):
    prints = [fingerprint_by_force(t or "") for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = defaultdict(lambda: LAST)
    for i, (doc_id, *_) in enumerate(rows):
        least[find(i)] = min(least[find(i)], rank(doc_id))
    named = {r: None if d == LAST else d for r, d in least.items()}
    found = [
        (d, f"{p:016x}", named[find(i)]) for i, ((d, *_), p) in enumerate(zip(rows, prints))
    ]
    return found, list(named.values())


def test_near_duplicates(spark, rows):
    grouped = near_duplicates(table(spark, rows))
    found = grouped.select("doc.doc_id", hex_of("fp"), "component_id").collect()
    expected, groups = groups_by_force(rows)
    assert as_sorted(found) == sorted(expected, key=repr)
    kept = [r["doc_id"] for r in first_of_each(grouped).collect()]
    assert sorted(kept, key=repr) == sorted(groups, key=repr)


def test_every_close_pair_shares_a_block():
    rng = np.random.default_rng(2)
    for blocks in (5, 6, 7, 8):
        masks = block_masks(blocks, 4)
        for _ in range(300):
            flips = rng.choice(64, 4, replace=False)
            change = sum(1 << int(b) for b in flips)
            assert any(change & m == 0 for m in masks)


def test_hot_keys_lose_no_link(spark):
    """Many fingerprints that agree in a key, with a bound that makes every larger key hot."""
    from plumbrow.llm.components import components
    from plumbrow.llm.simhash import near_links

    rng = np.random.default_rng(3)
    center = 0x123456789ABCDEF
    prints = {center ^ sum(1 << int(b) for b in rng.choice(20, 3, replace=False)) for _ in range(300)}
    prints |= {int(x) for x in rng.integers(0, 1 << 62, 200)}
    fps = spark.createDataFrame([(p,) for p in prints], "fp long")
    for hot_key in (10, 100_000):
        roots = dict(map(tuple, components(near_links(fps, 4, hot_key)).collect()))
        expected = groups_by_force_of(sorted(prints))
        assert {p: roots.get(p, p) for p in prints} == expected


def groups_by_force_of(prints):
    root = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for p in prints:
            for q in prints:
                if (p ^ q).bit_count() <= 4 and root[q] < root[p]:
                    root[p] = root[q]
                    changed = True
    return root


# contamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def contamination_by_force(rows, items):
    windows = defaultdict(set)
    for name, text in items:
        found = WORD.findall(low(text))
        for i in range(max(1, len(found) - 12) if found else 0):
            windows[tuple(found[i : i + 13])].add("" if name is None else str(name))
    out = []
    for doc_id, text, *_ in rows:
        found = WORD.findall(low(text))
        hit, names = set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(found) - size + 1):
                if tuple(found[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    names |= windows[tuple(found[i : i + size])]
        digest_ = sha(",".join(sorted(names)))
        out.append(
            (doc_id, len(found), len(hit), len(names), digest_, 0 < len(hit) and 20 * len(hit) >= len(found))
        )
    return out


def benchmark_items(spark, rows):
    texts = [t for _, t, *_ in rows if t]
    items = [(i, " ".join(t.split()[2:22])) for i, t in enumerate(texts[:8])]
    items += [(100, "one Two, three"), (101, None), (102, ""), (None, "ab"), (100, "AB"), (103, "?!")]
    return items


@pytest.mark.parametrize("block_bytes", [8 << 20, 100])
def test_contamination(spark, rows, block_bytes):
    items = benchmark_items(spark, rows)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = contamination(table(spark, rows), benchmark, block_bytes=block_bytes)
    chosen = found.selectExpr("doc.doc_id", "n_words", "n_hit", "cast(size(items) as long)").columns
    got = found.select("doc.doc_id", "n_words", "n_hit", "items", items_digest(), contaminated())
    got = [(r[0], r[1], r[2], len(r[3]), r[4], r[5]) for r in got.collect()]
    assert chosen[0] == "doc_id"
    assert as_sorted(got) == sorted(contamination_by_force(rows, items), key=repr)


def test_spans_are_in_the_original_text(spark):
    text = "Ünï, THE quick-brown中 fox!  the end"
    docs = table(spark, [(1, text, "en", "a")])
    benchmark = spark.createDataFrame([(1, "quick brown中 FOX"), (2, "ünï")], "item_id long, text string")
    row = contamination(docs, benchmark).first()
    assert [text[s.start : s.stop] for s in row["spans"]] == ["quick-brown中 fox"]
    assert (row["n_hit"], row["items"]) == (3, ["1"])


def test_empty_benchmark(spark):
    docs = table(spark, awkward_rows())
    found = contamination(docs, spark.createDataFrame([], "item_id long, text string"))
    assert found.filter("n_hit > 0 or size(items) > 0").isEmpty()


# substring deduplication


def substrings_by_force(rows, window=13):
    first = defaultdict(lambda: LAST)
    split = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    for i, found in split:
        for k in range(len(found) - window + 1):
            w = tuple(found[k : k + window])
            first[w] = min(first[w], rank(i))
    out = []
    for i, found in split:
        gone = set()
        for k in range(len(found) - window + 1):
            if first[tuple(found[k : k + window])] < rank(i):
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(found) if k not in gone).decode()
        out.append((i, len(found), len(gone), kept))
    return out


@pytest.mark.parametrize("group", [2_000_000, 50])
def test_substrings(spark, rows, group):
    found = without_repeats(table(spark, rows), group=group).select(
        "doc.doc_id", "n_words", "n_removed", "kept_text"
    )
    assert as_sorted(found.collect()) == sorted(substrings_by_force(rows), key=repr)


def maximal_by_force(rows, window):
    """Every sequence that occurs twice or more and loses occurrences if a word is added on either side."""
    occurrences = defaultdict(list)
    split = [(rank(i), (t or "").split()) for i, t, *_ in rows]
    for i, found in split:
        for a in range(len(found)):
            for z in range(a + window, len(found) + 1):
                left = found[a - 1] if a else None
                right = found[z] if z < len(found) else None
                occurrences[tuple(found[a:z])].append((i, a, left, right))
    out = []
    for sequence, where in occurrences.items():
        left, right = ({x[k] for x in where} for k in (2, 3))
        # No sequence goes on over the begin or the end of a text.
        goes_left = len(left) == 1 and None not in left
        goes_right = len(right) == 1 and None not in right
        if len(where) > 1 and not goes_left and not goes_right:
            i, a, *_ = min(where, key=lambda x: x[:2])
            out.append((len(sequence), len(where), None if i == LAST else i, a))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group, block_bytes", [(2_000_000, 1 << 20), (40, 300)])
def test_maximal_repeats(spark, group, block_bytes):
    one, two = words(30, 41), words(25, 42)
    rows = [
        (1, f"{words(10, 1)} {one} {words(8, 2)}", "en", "a"),
        (2, f"{words(9, 3)} {one} {two}", "en", "a"),
        (3, f"{one} {two} {words(5, 4)}", "en", "a"),
        (4, f"{one} {two} {words(5, 4)}", "en", "a"),
        (5, " ".join(one.split()[:15]) + " end", "en", "a"),
        (6, f"x {' '.join(two.split()[3:])}", "en", "a"),
        (7, " ".join(["tick", "tock"] * 12), "en", "a"),
        (8, None, "en", "a"),
        (None, f"y {' '.join(two.split()[3:20])} z", "en", "a"),
        (9, words(100, 7), "en", "a"),
    ]
    rows += [(100 + i, f"{words(3, 500 + i)} {one} {words(3, 600 + i)}", "en", "hot") for i in range(15)]
    found = maximal_repeats(table(spark, rows), window=6, group=group, block_bytes=block_bytes).collect()
    assert as_sorted(found) == maximal_by_force(rows, 6)


def test_heavy_prefixes_are_split_deeper(spark):
    text = " ".join(["same"] * 8 + ["%d"] + ["same"] * 4)
    docs = table(spark, [(i, text % i, "en", "a") for i in range(400)])
    borders = group_borders(docs, 13, group=100, groups=1)
    paths = np.concatenate([paths_of(_hashes(text % i), 13) for i in range(400)])
    sizes = np.bincount(np.searchsorted(borders, paths, "right") - 1)
    assert sizes.sum() == 400 and sizes.max() <= 100


def _hashes(text):
    return Words([text.encode()]).hashes(1)[0]


# fingerprints


def test_fingerprints(spark, rows):
    found = compared(table(spark, rows), rows_per_block=7).collect()
    order = sorted(
        ((i, t or "") for i, t, *_ in rows), key=lambda x: (x[0] is None, -(x[0] or 0), x[1].encode())
    )
    expected = []
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        a, b, c = digest(text.encode()), digest(changed.encode()), digest(following.encode())
        expected.append(
            (i, len(text), sha(changed), a.hex(), b.hex(), likeness(a, b), likeness(a, c))
        )
    assert as_sorted(found) == sorted(expected, key=repr)


def test_difference_is_bounded_and_symmetric():
    rng = np.random.default_rng(4)
    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 1, 2, 5, 50, 5000, 90_000)]
    for a in map(digest, texts):
        assert difference(a, a) == 0
        for b in map(digest, texts):
            assert 0 <= difference(a, b) == difference(b, a) <= CEILING


def test_edits_are_nearer_than_neighbours(spark):
    found = QUERIES["op9_fingerprints"](spark, SF).collect()
    nearer = [r["near_edited"] > r["near_next"] for r in found if r["n_chars"] >= 200]
    assert sum(nearer) >= 0.97 * len(nearer)


# all


@pytest.mark.parametrize(
    "operator",
    [deduplicated, near_duplicates, without_repeats, compared,
     lambda d: contamination(d, d.selectExpr("doc_id as item_id", "text"))],
)
def test_empty_tables(spark, operator):
    assert operator(table(spark, [])).collect() == []


def test_counts_of_documents_hold(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    ids = Counter(zlib.crc32(str(r["doc_id"]).encode()) for r in QUERIES["op6_decontamination"](spark, SF).collect())
    assert sum(ids.values()) == n


def test_windows_whose_paths_agree_are_told_apart(spark):
    """Among 400,000 windows with the same six first words some paths agree in all 64 bits."""
    start = "one header before the unique text".split()
    windows = [[*start, *f"a{i} b c d e f g".split()] for i in range(400_000)]
    flat = " ".join(w for words in windows for w in words)
    paths = paths_of(_hashes(flat), 13)[::13]
    order = np.argsort(paths, kind="stable")
    pairs = np.flatnonzero(paths[order][1:] == paths[order][:-1])
    assert len(pairs)
    i, j = sorted((int(order[pairs[0]]), int(order[pairs[0] + 1])))
    texts = [" ".join(windows[i]), " ".join(windows[j]), " ".join(windows[j])]
    ids = [0, 2000, 3990]  # in three blocks
    rows = [(n, text, "en", "a") for n, text in zip(ids, texts)]
    rows += [(n, "short", "en", "a") for n in range(1, 4000) if n not in ids]
    found = without_repeats(table(spark, rows)).filter(F.col("doc.doc_id").isin(ids))
    assert {r["doc"]["doc_id"]: r["n_removed"] for r in found.collect()} == {0: 0, 2000: 0, 3990: 13}
