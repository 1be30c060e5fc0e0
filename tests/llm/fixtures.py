"""Small document tables with every awkward row."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "score string, block string, row string, doc string, id string, fp string, slice string"
)


def table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Documents with further columns whose names the operators use inside."""
    full = [
        (i, text, lang, source, None if text is None else len(text), "s", "b", "r", "d", "i", "f", None)
        for i, text, lang, source in rows
    ]
    return spark.createDataFrame(full, DOCS)


def words(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(
        "".join(rng.choice(("ka", "lo", "mi", "ru", "té", "sa")) for _ in range(rng.randint(1, 4)))
        for _ in range(n)
    )


def awkward_rows() -> list[tuple]:
    """NULLs, empty, blank and long texts, exact and near copies, ties, repeated rows, shared lines."""
    base = words(60, 1)
    near = base.split()
    near[30] = "other"
    shared = "A line that many documents hold"
    passage = words(20, 2)
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (3, " ".join(near), "en", "b"),
        (4, None, None, None),
        (5, "", "de", "a"),
        (6, " \n\t ", "de", "a"),
        (7, f"{shared}\n{words(30, 3)}\n{shared}", "en", "a"),
        (8, f"  {shared.upper()}\t\n{words(40, 4)}\nshort\nshort", "en", "c"),
        (9, f"short\n{passage} {words(10, 5)}\n\n{shared} ", None, "c"),
        (10, f"{words(9, 6)} {passage}", "fr", None),
        (10, f"{words(9, 6)} {passage}", "fr", None),
        (11, f"{passage} {passage}", "fr", "a"),
        (12, words(3000, 7), "en", "a"),
        (13, "Ünï çödé 中文 \U0001f600 <|endoftext|> x", "es", "b"),
        (14, "ab", "en", "b"),
        (15, "one two three", "en", "b"),
        (None, f"{shared}\n{passage}", "en", "a"),
        (None, words(25, 8), "en", "a"),
    ]
    rows += [(100 + i, base, "en", "hot") for i in range(20)]
    rows += [(200 + i, f"{shared}\n{words(15, 100 + i)}", "en", "hot") for i in range(20)]
    return rows
