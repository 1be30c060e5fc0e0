"""Conversation repair against a plain search, with chunks so small that most conversations are split."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from plumbrow.llm.turns import damaged, repair, repair_report, repaired_turns

SCHEMA = "conv_id long, turn long, role string, text string, slot string, chunk string, copies int"
AFTER = (2, 2, 3, 2)
SAYS = {2: "user", 3: "assistant"}
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def report(rows):
    """conv_id -> the contract's columns, by a search from the last row to the first."""
    found = {}
    for conv in {r[0] for r in rows}:
        mine = [r[1:] for r in damage([r for r in rows if r[0] == conv])]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in mine:
            said = text.strip(" \t\n\x0b\f\r")
            fault = "blank" if not said else "duplicate" if (role, text) in seen else ""
            faults.append(fault or ("" if said[-1] in ".!?" else "truncated"))
            seen.add((role, text))
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(mine, mine[1:])]
        turns = [r[0] for r in mine if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        best = [(0, "", ()), (6, "II", ("user:", "assistant:")), (3, "I", ("assistant:",)), (0, "", ())]
        for (_, role, text), fault in zip(mine[::-1], faults[::-1]):
            plain = []
            for q in range(4):
                c, a, t = best[q]
                options = [(c + 4, "D" + a, t)]
                if fault not in ("blank", "duplicate"):
                    late = 3 * (fault == "truncated")
                    c, a, t = best[AFTER[q]]
                    options.append((c + 3 + late, "R" + a, (f"{SAYS[AFTER[q]]}:{text}", *t)))
                    if (q, role[:1]) in KEPT:
                        c, a, t = best[KEPT[q, role[:1]]]
                        options.append((c + late, "K" + a, (f"{role}:{text}", *t)))
                plain.append(min(options))
            best = []
            for q in range(4):
                options, state, said = [plain[q]], q, ()
                for k in range(1, 5):
                    state = AFTER[state]
                    said = (*said, f"{SAYS[state]}:")
                    c, a, t = plain[state]
                    options.append((c + 3 * k, "I" * k + a, said + t))
                best.append(min(options))
        cost, audit, text = best[0]
        sha = hashlib.sha256("\n".join(text).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        found[conv] = (gaps, *counts, illegal, cost, audit, sha)
    return found


def of_frame(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", "c", 7) for r in rows], SCHEMA)


def random_rows(seed, n_convs, most):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n_convs)]:
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", "User", "umpire", None])
            text = rng.choice(["Yes.", "no", f"Say {turn}!", f"what {turn}", "", " \n\t", None, "Ünï? ", "x" * 70 + "."])
            rows.append((conv, rng.choice([turn] * 9 + [None, turn + 3]), role, text))
    return rows


@pytest.mark.parametrize("bits", [2, 12])
def test_repair_is_the_least_of_the_cheapest(spark, bits):
    rows = random_rows(3, 60, 9) + [(None if r[0] is None else r[0] + 100, *r[1:]) for r in random_rows(5, 3, 60)]
    assert of_frame(repair_report(frame(spark, rows), bits)) == report(rows)


def test_a_conversation_of_unknown_roles_needs_more_passes(spark):
    rows = [(1, t, "tool", f"Line {t}.") for t in range(17)]
    rows += [(2, t, "user" if t % 3 else "tool", f"Line {t}") for t in range(16)]
    assert of_frame(repair_report(frame(spark, rows), 1)) == report(rows)


def test_repeated_rows_and_one_large_conversation(spark):
    rows = [(7, 5, "assistant", "Same.")] * 500 + [(7, None, "user", f"Q {i}?") for i in range(60)]
    rows += [(i, 0, "user", "Hi.") for i in range(10, 20)] + [(7, t, "user", "") for t in range(40)]
    assert of_frame(repair_report(frame(spark, rows), 4)) == report(rows)


def test_very_long_texts(spark):
    rows = [(1, 0, "user", "word " * 1_000_000 + "?"), (1, 1, "user", "word " * 1_000_000)]
    assert of_frame(repair_report(frame(spark, rows))) == report(rows)


def test_empty_table(spark):
    assert repair_report(frame(spark, [])).collect() == []


def test_the_repaired_turns_alternate(spark):
    rows = random_rows(9, 20, 12)
    turns = damaged(frame(spark, rows))
    lines = repaired_turns(turns, repair(turns, 2)).collect()
    by_conv = {}
    for r in sorted(lines, key=lambda r: (r["slot"], r["seq"])):
        by_conv.setdefault(r["conv_id"], []).append(r["role"][:1])
    assert by_conv
    assert all(re.fullmatch("(s?(ua)+)?", "".join(roles)) for roles in by_conv.values())
