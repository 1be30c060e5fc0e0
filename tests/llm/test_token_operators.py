"""Packing, records and shards: exact round trips on awkward rows, empty tables and sample tables."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyarrow import fs
from tokenizers import Tokenizer

from plumbrow.llm import tokens
from plumbrow.llm.common import run_folder
from plumbrow.llm.kd_shards import kd_shards
from plumbrow.llm.mixture import packed, round_robin
from plumbrow.llm.queries import QUERIES
from plumbrow.llm.records import (
    DamagedRecord,
    framed,
    next_payload,
    read_records,
    records_of,
    shuffled_records,
    write_records,
)
from plumbrow.llm.tokens import Encoder, tokenizer_path
from tests.llm.fixtures import awkward_rows, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text, end):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module", params=["awkward", "sample"])
def rows(request, spark):
    if request.param == "awkward":
        return awkward_rows()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]


# tokens


@pytest.mark.parametrize("keep", [0, 700_000])
def test_chunks_have_the_ids_of_the_whole_text(tokenizer, keep):
    alphabet = list("aB é́ß'sStİΣσς 12٣\t\n\r\x0b\x0c\x1c\x85 !?.,;中‍\U0001f600<|>")
    alphabet += ["<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'ll", "the ", "ing. "]
    encode = Encoder(tokenizer_path(), keep=keep)
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        found = np.frombuffer(encode.ids(text.encode()), encode.dtype).tolist()
        assert found == tokenizer.encode(text, add_special_tokens=False).ids


# packing


def check_packing(tokenizer, rows, found, length):
    expected = Counter((i, crc(ids_of(tokenizer, t, 1))) for i, t, *_ in rows)
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for p in found:
        by_document[p["doc_id"], p["doc_tokens"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert sum(p["length"] for p in found) == sum(
        len(ids_of(tokenizer, t, 1)) for _, t, *_ in rows
    )
    for (doc_id, n), pieces in by_document.items():
        copies = sum(p["start"] == 0 for p in pieces)
        assert sum(p["length"] for p in pieces) == copies * n
        if copies == 1:
            ids = b"".join(p["ids"] for p in sorted(pieces, key=lambda p: p["start"]))
            assert (doc_id, zlib.crc32(ids)) in expected
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            assert p["ids_crc32"] == zlib.crc32(p["ids"])
            at += p["length"]
        assert at <= length
    return by_sequence


def test_stops_are_encoded_once(tokenizer):
    encode = Encoder(tokenizer_path())
    text = b"alpha&&& beta*** gamma.%%% alpha*** it's'! don't&&& snake_&& g\xc3\xa9n\xc3\xa9ral&&& \xc3\xbcber"
    assert encode.ids(text) == Encoder(tokenizer_path(), chunked=False).ids(text)
    asked = []
    encode._encode = lambda texts: asked.extend(texts) or []
    encode.ids(b"beta&&& gamma*** alpha.%%%")
    assert not asked


@pytest.mark.parametrize("keep, group", [(0, 1 << 18), (700_000, 1 << 18), (20, 200)])
def test_new_chunks_of_texts_are_encoded_together(tokenizer, monkeypatch, keep, group):
    monkeypatch.setattr(tokens, "GROUP_BYTES", group)
    texts = [f"alpha{c} beta, {c * 3}. g\u00e9n{c}! {i} don't" for i, c in enumerate("abcdefghij" * 3)]
    texts += ["", " \n", "one <|endoftext|> two", "x" * 300, "alphaa beta,"]
    encode, calls = Encoder(tokenizer_path(), keep=keep), []
    plain = encode._encode
    encode._encode = lambda asked: calls.append(asked) or plain(asked)
    found = [np.frombuffer(x, encode.dtype).tolist() for x in encode.ids_of(t.encode() for t in texts)]
    assert found == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    if group > 200:
        assert len(calls) == 3  # words, other chunks, and the text with a special token


@pytest.mark.parametrize("length, windows", [(2048, 512), (64, 8)])
def test_packing(spark, tokenizer, rows, length, windows):
    found = packed(
        table(spark, rows),
        tokenizer_path(),
        1,
        length,
        windows_per_slice=windows,
        least=8,
        with_ids=True,
    ).collect()
    sequences = check_packing(tokenizer, rows, found, length)
    total = sum(p["length"] for p in found)
    slices = len({s >> 32 for s in sequences})
    assert len(sequences) * length - total < slices * length


def test_more_sources_than_queues(spark, tokenizer):
    rows = [(i, f"text number {i} " * (i % 7), "en", f"s{i}") for i in range(60)]
    found = packed(table(spark, rows), tokenizer_path(), 1, 64, max_queues=4, with_ids=True)
    check_packing(tokenizer, rows, found.collect(), 64)


def test_sources_keep_their_shares_at_any_number(spark):
    """Named targets are kept by source among more sources than there ever were buckets."""
    rows = [(i, "some words here and there " * 8, "en", f"s{i}") for i in range(1200)]
    rows += [(2000 + i, "some words here and there " * 8, "en", "big") for i in range(600)]
    rows += [(3000 + i, "some words here and there " * 8, "en", "small") for i in range(100)]
    targets = {"big": 0.75, "small": 0.25}
    found = packed(table(spark, rows), tokenizer_path(), 1, 512, targets=targets).collect()
    mix = Counter()
    for r in found:
        if r["sequence_id"] < 20:
            mix[r["source"]] += r["length"]
    total = sum(mix.values())
    assert abs(mix["big"] / total - 0.75) < 0.05 and abs(mix["small"] / total - 0.25) < 0.05


def served(lengths, shares, owed=None, length=100, least=10):
    owed = np.zeros(len(lengths)) if owed is None else owed
    out = round_robin([np.array(x) for x in lengths], np.array(shares), owed, length, least)
    return np.frombuffer(out, np.int64).reshape(-1, 6)


def test_every_window_is_near_its_targets():
    rng = np.random.default_rng(6)
    totals = [60_000, 30_000, 10_000]
    lengths = [rng.multinomial(n, np.ones(n // 50) / (n // 50)) + 0 for n in totals]
    lengths = [x[x > 0] for x in lengths]
    out = served(lengths, [0.6, 0.3, 0.1], length=1000, least=20)
    windows = out[:, 4].max() + 1
    mix = np.zeros((windows, 3))
    np.add.at(mix, (out[:, 4], out[:, 0]), out[:, 3])
    assert (mix[:-1].sum(axis=1) == 1000).all()
    assert np.abs(mix[:-1] / 1000 - [0.6, 0.3, 0.1]).max() <= 0.05
    assert np.abs(np.cumsum(mix, axis=0)[:-1] - np.outer(np.arange(1, windows), [600, 300, 100])).max() <= 60


def test_owed_tokens_are_served_first():
    out = served([[500], [500]], [0.5, 0.5], owed=np.array([40.0, -40.0]))
    first = out[out[:, 4] == 0]
    assert first[first[:, 0] == 0, 3].sum() == 90


def test_given_targets_and_a_queue_that_runs_dry():
    out = served([[300], [900]], [0.75, 0.25])
    of_first = [out[(out[:, 4] == w) & (out[:, 0] == 0), 3].sum() for w in range(12)]
    assert of_first[:4] == [75] * 4 and sum(of_first) == 300
    assert out[:, 3].sum() == 1200


# records


def test_records(spark, tokenizer, rows):
    found = [tuple(r) for r in records_of(table(spark, rows), tokenizer_path(), 2).collect()]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    expected, start = [], 0
    for doc_id, text, *_ in order:
        ids = ids_of(tokenizer, text, 2)
        expected.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(found, key=lambda r: r[1]) == expected


def test_shuffled_reads(spark, tokenizer):
    rows = awkward_rows()
    docs, folder = table(spark, rows).repartition(3), run_folder(spark, "shuffled")
    manifest = write_records(docs, folder, tokenizer_path(), 2)
    expected = sorted(crc(ids_of(tokenizer, t, 2)) for _, t, *_ in rows)
    orders = []
    for seed in (1, 2, 1):
        read = shuffled_records(manifest, seed).collect()
        orders.append([(r["part"], r["position"]) for r in read])
        assert sorted(zlib.crc32(r["ids"]) for r in read) == expected
    assert orders[0] == orders[2] != orders[1]


def test_unlisted_files_do_not_count(spark):
    """As a task leaves them that ran twice."""
    docs, folder = table(spark, awkward_rows()), run_folder(spark, "twice")
    first = write_records(docs, folder, tokenizer_path(), 2)
    n = read_records(first).count()
    write_records(docs, folder, tokenizer_path(), 2)
    assert read_records(first).count() == n == len(awkward_rows())


def test_damage_is_noticed(spark):
    manifest = write_records(
        table(spark, awkward_rows()), run_folder(spark, "damaged"), tokenizer_path(), 2
    )
    system, path = fs.FileSystem.from_uri(manifest.first()["data"])
    with system.open_input_stream(path) as source:
        data = bytearray(source.read())
    data[len(data) // 2] ^= 1
    with system.open_output_stream(path) as out:
        out.write(bytes(data))
    with pytest.raises(Exception, match="DamagedRecord"):
        read_records(manifest).collect()


def test_frames():
    import io

    payloads = [b"", b"x", bytes(range(256)) * 5]
    source = io.BytesIO(b"".join(map(framed, payloads)))
    assert [next_payload(source) for _ in range(4)] == [*payloads, None]
    with pytest.raises(DamagedRecord):
        next_payload(io.BytesIO(framed(b"abc")[:-1]))


# shards


def check_shards(rows, found, shards):
    expected = Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows
    )
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == expected
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    sizes = [0] * shards
    for r in found:
        sizes[r["shard"]] += r["size"]
    return sizes


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards(spark, rows, shards):
    sizes = check_shards(rows, kd_shards(table(spark, rows), shards).collect(), shards)
    largest = max(len((t or "").encode()) + 16 for _, t, *_ in rows)
    # Each of the splits above a leaf is off by half a document at most.
    assert max(sizes) - sum(sizes) / shards <= 2 * largest


def test_copies_of_one_text_are_spread(spark):
    rows = [(i, "the same text", "en", "hot") for i in range(4000)]
    sizes = check_shards(rows, kd_shards(table(spark, rows), 40).collect(), 40)
    assert max(sizes) <= 1.03 * sum(sizes) / 40


def test_target_bytes(spark):
    rows = [(i, "x" * 84, "en", f"s{i % 7}") for i in range(1000)]
    found = kd_shards(table(spark, rows), target_bytes=10_000).collect()
    sizes = check_shards(rows, found, 10)
    assert max(sizes) <= 10_500


def test_sample_shards_are_even(spark):
    found = QUERIES["op3_sharding"](spark, "/root/testdata/sf0.01").collect()
    sizes = Counter()
    for r in found:
        sizes[r["shard"]] += r["size"]
    assert len(sizes) == 40
    assert max(sizes.values()) - min(sizes.values()) <= max(r["size"] for r in found)


@pytest.mark.parametrize(
    "operator",
    [
        lambda d: packed(d, tokenizer_path(), 1),
        lambda d: records_of(d, tokenizer_path(), 2),
        lambda d: kd_shards(d, 40),
    ],
)
def test_empty_tables(spark, operator):
    assert operator(table(spark, [])).collect() == []
