"""Repair of conversations: the cheapest edits that make their roles alternate.

A conversation's rows are taken by turn, NULL turns first; rows of one turn by role, then text (its first
64 characters, then a hash), so equal rows are adjacent. A row's first fault counts: `blank` (no character
other than space and \\t to \\r), `duplicate` (role and text seen earlier in the conversation) or `truncated`
(the last such character is none of . ! ?). The edits are Keep (free), Rerole to user or assistant (3),
Delete (4; required of blank and duplicate rows) and Insert of an empty user or assistant row (3); a truncated
row that stays adds 3. Kept roles count by their initial, and the initials of the result match
(s?(ua)+)?. Among the cheapest edits, those whose initials make the least text are taken.

The costs of the rest of a conversation are a vector over four states, found from the last row to the first.
Conversations are cut into chunks of rows. A chunk in the middle of a conversation starts from a speculative
vector, that of a conversation's end; fix-up passes run the chunks again whose follower has come to another
vector, until none differs by more than a constant. A second pass stitches the states in which the chunks begin
and the third writes the least edits. Texts take no part: chunks hold roles, flags and text hashes.

NULL role or text counts as one space; a NULL conv_id is a conversation like any other. Equal rows are counted
before they are shuffled, so a row repeated in a third of the table is one row. No rows: no conversations.
Further columns are ignored. Text hashes are 128 bits (MD5).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbrow.functions.keys import join_same
from plumbrow.llm.common import SPACE_TEXT, shuffle_partitions, stage

CHANGE, DELETE, INSERT, LATE = 3, 4, 3, 3
_NEVER = 1 << 40

# States: nothing said yet, after the system, after the user, after the assistant.
_NEXT = (2, 2, 3, 2)  # after the user's or assistant's row that may come next
_KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
_NOT_KEPT = (None, None, None, None)
_ROLE = {2: "user", 3: "assistant"}
#: What the rows to be inserted at the end cost, by state.
END = (0, 2 * INSERT, INSERT, 0)

Vector = tuple[int, int, int, int]

_CHUNK_BITS = 12


@dataclass(frozen=True)
class Repair:
    """lines: conv_id, slot, seq (order), role, and for rows that stay turn, role_in and hash.
    summary: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""

    lines: DataFrame
    summary: DataFrame


def _level(vector: Vector) -> Vector:
    least = min(vector)
    return tuple(v - least for v in vector)


@lru_cache(maxsize=100_000)
def _before(after: Vector, initial: str, late: int) -> Vector:
    """The costs from a row that may stay on, by state, from those after it."""
    keep = _KEPT.get(initial, _NOT_KEPT)
    plain = [
        min(
            DELETE + after[q],
            CHANGE + late + after[_NEXT[q]],
            _NEVER if keep[q] is None else late + after[keep[q]],
        )
        for q in range(4)
    ]
    best = []
    for q in range(4):
        cost, spent = plain[q], 0
        for _ in range(3):  # a fourth insertion comes back to a state already seen
            q, spent = _NEXT[q], spent + INSERT
            cost = min(cost, spent + plain[q])
        best.append(cost)
    return tuple(best)


@lru_cache(maxsize=100_000)
def _edit(after: Vector, initial: str, late: int, q: int) -> tuple[str, tuple[str, ...], int, int]:
    """The least letters for a row that may stay: letters, inserted roles, next state, cost."""
    before = _before(after, initial, late)
    letters, inserted, cost = "", (), 0
    while True:
        keep = _KEPT.get(initial, _NOT_KEPT)[q]
        if DELETE + after[q] == before[q]:
            return letters + "D", inserted, q, cost + DELETE
        if INSERT + before[_NEXT[q]] == before[q]:
            q = _NEXT[q]
            letters, inserted, cost = letters + "I", (*inserted, _ROLE[q]), cost + INSERT
            continue
        if keep is not None and late + after[keep] == before[q]:
            return letters + "K", inserted, keep, cost + late
        return letters + "R", inserted, _NEXT[q], cost + CHANGE + late


@dataclass
class _Segment:
    """The rows that one chunk holds of one conversation."""

    first: int
    stop: int


def _segments(rows: pa.Table) -> tuple[dict[str, list], list[_Segment]]:
    rows = rows.sort_by("slot")
    columns = {name: rows.column(name).to_pylist() for name in rows.column_names}
    ids = columns["conv_id"]
    starts = [i for i in range(len(ids)) if i == 0 or ids[i] != ids[i - 1]]
    return columns, [_Segment(a, b) for a, b in zip(starts, [*starts[1:], len(ids)])]


def _vectors(columns: dict[str, list], part: _Segment, end: Vector) -> list[Vector]:
    """For each row the costs after it and, first of all, those before the first; up to constants."""
    vectors = [_level(end)]
    for i in range(part.stop - 1, part.first - 1, -1):
        after = vectors[-1]
        # Rows that have to go cost the same in every state.
        free = columns["may_stay"][i]
        vectors.append(
            _level(_before(after, columns["initial"][i], columns["late"][i])) if free else after
        )
    vectors.reverse()
    return vectors


def _traced(columns: dict[str, list], part: _Segment, vectors: list[Vector], state: int) -> Iterator:
    """Of each row: its number, letters, inserted roles, the state after it, the cost."""
    for i in range(part.first, part.stop):
        if columns["may_stay"][i]:
            after = vectors[i - part.first + 1]
            letters, inserted, state, cost = _edit(
                after, columns["initial"][i], columns["late"][i], state
            )
            yield i, letters, inserted, state, cost
        else:
            yield i, "", (), state, 0


def _illegal(before: str, after: str) -> int:
    return int(before + after not in ("su", "ua", "au"))


def _table(rows: list[tuple], schema: T.StructType) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [()] * len(arrow)
    return pa.table([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)


def _given(info: pa.Table) -> dict:
    return {r["conv_id"]: r for r in info.to_pylist()}


def _slots(rows: DataFrame, chunk_bits: int) -> DataFrame:
    """Rows counted, flagged and numbered in order; stored."""
    key = ["conv_id", "turn", "role", "head", "hash", "blank", "late"]
    counted = rows.groupBy(*key).agg(F.sum("copies").alias("copies"))
    said = ["conv_id", "role", "hash"]
    first = (
        counted.groupBy(*said)
        .agg(
            F.count("*").alias("_n"),
            F.min("turn").alias("_turn"),
            F.max(F.isnull("turn").cast("int")).alias("_none"),
        )
        .where("_n > 1")
        .drop("_n")
    )
    is_later = F.col("turn").isNotNull() & ((F.col("_none") == 1) | (F.col("turn") > F.col("_turn")))
    flagged = join_same(counted, first, said, "left").select(
        *key, "copies", F.coalesce(is_later, F.lit(False)).alias("later")
    )
    order = ["conv_id", "turn", "role", "head", "hash"]
    partitions = shuffle_partitions(rows.sparkSession)
    placed = flagged.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    placed = placed.withColumn("slot", F.monotonically_increasing_id())
    may_stay = ~F.col("blank") & ~F.col("later")
    return stage(
        placed.select(
            "conv_id",
            "turn",
            "role",
            "hash",
            "slot",
            F.shiftright("slot", chunk_bits).alias("chunk"),
            F.substring("role", 1, 1).alias("initial"),
            may_stay.alias("may_stay"),
            F.when(may_stay & F.col("late"), LATE).otherwise(0).alias("late"),
            F.when(F.col("blank"), F.col("copies")).otherwise(0).alias("blank"),
            F.when(F.col("blank"), 0)
            .otherwise(F.col("copies") - may_stay.cast("int"))
            .alias("duplicate"),
        ),
        "turns",
    )


def _per_chunk(rows: DataFrame, info: DataFrame, work: Callable, schema: T.StructType) -> DataFrame:
    """work(columns, segments, what is known of them) for each chunk of rows."""

    def of_chunk(chunk: pa.Table, known: pa.Table) -> pa.Table:
        columns, parts = _segments(chunk)
        return _table(list(work(columns, parts, _given(known))), schema)

    return rows.groupBy("chunk").cogroup(info.groupBy("chunk")).applyInArrow(of_chunk, schema)


def _stitched(rows: DataFrame, across: DataFrame, conv: T.StructField) -> DataFrame:
    """Of each chunk of the conversations across chunks: the vector after it, the state before it,
    and whether the pair of rows at its start is illegal."""
    spark = rows.sparkSession
    place = [conv, T.StructField("chunk", T.LongType())]
    vector = T.ArrayType(T.LongType())
    found = T.StructType([*place, T.StructField("end", vector), T.StructField("start", vector)])
    parts = stage(join_same(rows, across, ["conv_id"], "left_semi"), "split-conversations")
    ends = parts.select("conv_id", "chunk").distinct()
    ends = ends.withColumn("end", F.lit(list(END)).cast(vector))

    def backward(columns, segments, known):
        for part in segments:
            of = known.get(columns["conv_id"][part.first])
            if of:
                start = _vectors(columns, part, tuple(of["end"]))[0]
                yield columns["conv_id"][part.first], columns["chunk"][part.first], of["end"], start

    vectors = stage(_per_chunk(parts, ends, backward, found), "vectors")
    after = F.lead("start").over(Window.partitionBy("conv_id").orderBy("chunk"))
    while True:
        # Vectors are kept with their least entry at zero, so only constants are left out.
        wrong = vectors.withColumn("next", after).where("next IS NOT NULL AND next <> end")
        wrong = stage(wrong.select("conv_id", "chunk", F.col("next").alias("end")), "fix-up")
        if wrong.isEmpty():
            break
        again = join_same(parts, wrong, ["conv_id", "chunk"], "left_semi")
        kept = join_same(vectors, wrong, ["conv_id", "chunk"], "left_anti")
        vectors = stage(kept.unionByName(_per_chunk(again, wrong, backward, found)), "vectors")

    maps = T.StructType(
        [
            *place,
            T.StructField("end", vector),
            T.StructField("to", vector),
            T.StructField("opens", T.StringType()),
            T.StructField("closes", T.StringType()),
        ]
    )

    def forward(columns, segments, known):
        for part in segments:
            conv_id = columns["conv_id"][part.first]
            of = known.get(conv_id)
            if of:
                costs = _vectors(columns, part, tuple(of["end"]))
                to = [
                    list(_traced(columns, part, costs, q))[-1][3] for q in range(4)
                ]
                edge = columns["initial"]
                yield (
                    conv_id, columns["chunk"][part.first], of["end"], to,
                    edge[part.first], edge[part.stop - 1],
                )

    begun = T.StructType(
        [
            *place,
            T.StructField("end", vector),
            T.StructField("state", T.LongType()),
            T.StructField("illegal", T.LongType()),
        ]
    )

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # a row per chunk, in order: nothing but the former one is held
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                follows = last is not None and last[0] == row["conv_id"]
                state = last[1] if follows else 0
                wrong = _illegal(last[2], row["opens"]) if follows else 0
                out.append((row["conv_id"], row["chunk"], row["end"], state, wrong))
                last = row["conv_id"], row["to"][state], row["closes"]
            yield from _table(out, begun).to_batches()

    mapped = _per_chunk(parts, vectors.select("conv_id", "chunk", "end"), forward, maps)
    ordered = mapped.repartition(shuffle_partitions(spark), "conv_id")
    return stage(ordered.sortWithinPartitions("conv_id", "chunk").mapInArrow(fold, begun), "states")


def flagged_rows(turns: DataFrame) -> DataFrame:
    """What the repair needs of each row (conv_id, turn, role, text, and copies if there is one)."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    said = F.rtrim(text, F.lit(SPACE_TEXT))
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    return turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.substring(text, 1, 64).alias("head"),
        F.md5(text.cast("binary")).alias("hash"),
        (F.length(said) == 0).alias("blank"),
        (~F.right(said, F.lit(1)).isin(".", "!", "?")).alias("late"),
        copies.cast("long").alias("copies"),
        text.alias("text"),
    )


def repair(turns: DataFrame, chunk_bits: int = _CHUNK_BITS) -> Repair:
    """The least of the cheapest edits of each conversation; chunks of 2 ** chunk_bits rows. Runs jobs."""
    flagged = flagged_rows(turns).drop("text")
    conv = T.StructField("conv_id", turns.schema["conv_id"].dataType)
    rows = _slots(flagged, chunk_bits)
    ends = rows.groupBy("conv_id").agg(F.min("chunk").alias("a"), F.max("chunk").alias("z"))
    across = stage(ends.where("a < z").select("conv_id", "z"), "conversations-across-chunks")
    if across.isEmpty():
        known = rows.sparkSession.createDataFrame(
            [],
            T.StructType([conv]).add("chunk", T.LongType()).add("end", T.ArrayType(T.LongType()))
            .add("state", T.LongType()).add("illegal", T.LongType()).add("z", T.LongType()),
        )
    else:
        known = join_same(_stitched(rows, across, conv), across, ["conv_id"])

    text, number = T.StringType(), T.LongType()
    names = ["slot", "seq", "role", "turn", "role_in", "hash", "chunk", "audit", "opens", "closes"]
    kinds = [number, number, text, number, text, text, number, text, text, text]
    sums = ["blank", "duplicate", "truncated", "illegal", "cost"]
    schema = T.StructType(
        [conv, *[T.StructField(n, k) for n, k in zip(names, kinds)], *[T.StructField(n, number) for n in sums]]
    )
    none = (None,) * len(sums)

    def final(columns, segments, known):
        slot, initial, dup = columns["slot"], columns["initial"], columns["duplicate"]
        for part in segments:
            conv_id, chunk = columns["conv_id"][part.first], columns["chunk"][part.first]
            of = known.get(conv_id) or {"end": END, "state": 0, "illegal": 0, "z": chunk}
            costs = _vectors(columns, part, tuple(of["end"]))
            audit, cost, late, illegal, state = [], 0, 0, of["illegal"], of["state"]
            for i, letters, inserted, state, spent in _traced(columns, part, costs, state):
                gone = columns["blank"][i] + dup[i]
                audit.append(letters + "D" * gone)
                cost += spent + DELETE * gone
                late += columns["late"][i] > 0
                copies = gone + columns["may_stay"][i]
                illegal += copies - 1  # a row never goes before one like itself
                if i > part.first:
                    illegal += _illegal(initial[i - 1], initial[i])
                for k, role in enumerate(inserted):
                    yield conv_id, slot[i], k, role, *(None,) * 7, *none
                if letters[-1:] in ("K", "R"):
                    said = columns["role"][i]
                    role = said if letters[-1] == "K" else _ROLE[state]
                    yield (
                        conv_id, slot[i], len(inserted), role, columns["turn"][i], said,
                        columns["hash"][i], *(None,) * 4, *none,
                    )
            if chunk == of["z"]:
                k = 100
                while END[state]:
                    state, k = _NEXT[state], k + 1
                    audit.append("I")
                    cost += INSERT
                    yield conv_id, slot[part.stop - 1], k, _ROLE[state], *(None,) * 7, *none
            counts = (
                sum(columns["blank"][part.first : part.stop]),
                sum(dup[part.first : part.stop]), late, illegal, cost,
            )
            yield conv_id, *(None,) * 6, chunk, "".join(audit), None, None, *counts

    done = stage(_per_chunk(rows, known, final, schema), "edits")
    lines = done.where("slot IS NOT NULL").select("conv_id", *names[:6])
    by_part = done.where("slot IS NULL")
    pieces = F.sort_array(F.collect_list(F.struct("chunk", "audit")))
    summed = by_part.groupBy("conv_id").agg(
        *[F.sum(n).alias(n) for n in sums],
        F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit"),
    )
    each = rows.where("turn IS NOT NULL").select("conv_id", "turn").distinct()
    gaps = each.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps")
    )
    summary = join_same(summed, gaps, ["conv_id"], "left").select(
        "conv_id", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), *sums, "audit"
    )
    return Repair(lines, summary)


def repaired_turns(turns: DataFrame, found: Repair) -> DataFrame:
    """conv_id, slot, seq (their order), role and text of the repaired conversations."""
    key = ["conv_id", "turn", "role", "hash"]
    texts = flagged_rows(turns).groupBy(*key).agg(F.first("text").alias("text"))
    texts = texts.withColumnRenamed("role", "role_in")
    lines = join_same(found.lines, texts, ["conv_id", "turn", "role_in", "hash"], "left")
    return lines.select(
        "conv_id", "slot", "seq", "turn", "role", F.coalesce("text", F.lit("")).alias("text")
    )


def text_digests(lines: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its lines `role:text` joined by \\n, hashed as they pass by."""
    conv = lines.schema["conv_id"]
    schema = T.StructType([conv, T.StructField("sha256", T.StringType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = running = None
        for batch in batches:
            out = []
            for conv_id, line in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "line"))):
                if running is not None and conv_id == current:
                    running.update(b"\n")
                else:
                    if running is not None:
                        out.append((current, running.hexdigest()))
                    current, running = conv_id, hashlib.sha256()
                running.update(line.encode())
            yield from _table(out, schema).to_batches()
        if running is not None:
            yield from _table([(current, running.hexdigest())], schema).to_batches()

    line = F.concat("role", F.lit(":"), "text").alias("line")
    spread = lines.repartition(shuffle_partitions(lines.sparkSession), "conv_id")
    ordered = spread.sortWithinPartitions("conv_id", "slot", "seq").select("conv_id", line)
    return ordered.mapInArrow(hashed, schema)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of `conv_id:turn` modulo 20, NULLs written as one space: 0 is dropped, 1 loses its
    text, 2 its . ! and ?, 3 is there twice (`copies`), 4 gets the role user."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = shown("text")
    return turns.where(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(shown("role")).alias("role"),
        F.when(kind == 1, "")
        .when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def repair_report(turns: DataFrame, chunk_bits: int = _CHUNK_BITS) -> DataFrame:
    """Every conv_id of the turns with the summary and text digest of its damaged rows' repair."""
    rows = damaged(turns)
    found = repair(rows, chunk_bits)
    digests = text_digests(repaired_turns(rows, found))
    every = turns.select("conv_id").distinct()
    known = join_same(join_same(every, found.summary, ["conv_id"], "left"), digests, ["conv_id"], "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    empty = hashlib.sha256(b"").hexdigest()
    return known.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(empty)).alias("repaired_sha256"),
    )
