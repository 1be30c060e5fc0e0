"""Checks against their oracles on random rows, with NULLs in every label."""

from __future__ import annotations

import random

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import _rounded
from oracles.mart import CHECK_SQL, MART
from plumbrow.plans.registry import CHECKS, CheckInputs, run_checks
from plumbrow.schema import STANDARD_SCHEMA
from plumbrow.settings import Settings
from plumbrow.sources.staging import stage
from tests.compare import compare

_STD = """
std AS (
  SELECT *, concat_ws(' / ', section, category_1, category_2, category_3, description) AS item
  FROM random_rows
)
"""


def _random_rows(seed: int) -> list[dict]:
    chance = random.Random(seed)

    def pick(*options):
        return chance.choice(options)

    rows = []
    for company in ("A", "B", "C", "D", "E", "F", None):
        for _ in range(60):
            size = 10 ** chance.uniform(-2, 4)
            labels = {
                "company": company,
                "network": pick("n1", "n2", None),
                "schedule": pick("S1", "S2", "S3", None),
                "category_1": pick("Lines", "Net cost", "Tax", None),
                "description": pick("Total", "Share", "km", None),
                "units": pick("$000", "$000s", "km", "Lines", "7.5", "a|b", "proportion", None),
            }
            copies = pick(1, 1, 1, 1, 2)
            broken_scale = pick(1e3, 1e-3, 100.0, 0.01, 1e5, 1e-5, -1.0, 1.0)
            broken_years = chance.sample(range(2014, 2021), pick(0, 1, 1, 2))
            for year in range(2014, 2021):
                if chance.random() < 0.15:
                    continue
                value = round(size * chance.uniform(0.6, 1.6), 6)
                if year in broken_years:
                    value *= broken_scale
                value = pick(value, value, value, value, value, value, value, None, 0.0)
                text = pick(None, None, "text")
                for copy in range(copies if chance.random() < 0.3 else 1):
                    rows.append(
                        {
                            **labels,
                            "sector": "edb",
                            "section": "Sales",
                            "source": "random",
                            "disclosure_year": year,
                            "observation_year": year,
                            "value": value if copy == 0 or value is None else value * pick(1.0, 1.5),
                            "text_value": text,
                            "uid": f"u{len(rows):05d}",
                        }
                    )
    # A company-year that is blank, and a schedule cut short.
    rows = [r for r in rows if not (r["company"] == "B" and r["disclosure_year"] == 2016)]
    for r in rows:
        if r["company"] == "C" and r["disclosure_year"] == 2018:
            r["value"], r["text_value"] = None, None
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_checks_agree_on_random_rows(spark, seed):
    rows = _random_rows(seed)
    names = STANDARD_SCHEMA.names
    data = [tuple(r.get(n) for n in names) for r in rows]
    df = stage(spark.createDataFrame(data, STANDARD_SCHEMA), "random-rows")
    duck = duckdb.connect()
    path = df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
    duck.execute(f"CREATE VIEW random_rows AS SELECT * FROM '{path}/*.parquet'")
    # Small limits send the larger groups the distributed way.
    settings = Settings(hot_group_rows=5)
    found = run_checks(CheckInputs(df, settings, shared=True), CHECKS)
    n_findings = {}
    for check, findings in zip(CHECKS, found, strict=True):
        sql = CHECK_SQL[check.name].replace(MART, _STD)
        n_findings[check.name], problem = compare(_rounded(findings), sql, duck)
        assert problem is None, check.name
    assert pd.Series(n_findings).gt(0).sum() >= 9, n_findings
