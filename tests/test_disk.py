"""What lies on disk while a large mart is built, checked and stored."""

from __future__ import annotations

import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plumbrow.operators import rows as row_checks
from plumbrow.operators import series, sieve
from plumbrow.operators.repeats import repeat_candidates
from plumbrow.operators.rows import ambiguous_rows, cell_repeats, duplicate_rows
from plumbrow.operators.series import uneven_series_values
from plumbrow.operators.values import suspect_values
from plumbrow.settings import Settings
from plumbrow.sources import samples, staging
from plumbrow.sources.samples import build_mart
from tests.marts import standard
from tests.marts import series as years

SETTINGS = Settings(min_disclosure_year=1995)


@pytest.fixture
def no_broadcast(spark):
    """Joins as they are with hashes too many to be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most_bits", [2**26, 2**16])
def test_the_sieve_keeps_every_match_and_few_others(spark, monkeypatch, most_bits):
    monkeypatch.setattr(sieve, "_MOST_BITS", most_bits)
    hashes = staging.stage(spark.range(25_000).select(F.xxhash64("id").alias("h")), "hashes")
    rows = spark.range(400_000).select("id", F.xxhash64("id").alias("h"), F.lit(None).cast("string").alias("none"))
    twice = rows.unionByName(rows.where("id < 10"))
    found = sieve.sifted(twice, hashes, "h")
    assert found.columns == rows.columns
    assert found.where("id < 25000").count() == 25_010
    assert found.where("id >= 25000").count() < 375_000 * (0.03 if most_bits > 2**16 else 0.4)
    assert sieve.sifted(rows, hashes.limit(10), "h") is rows


def _repeated_mart(spark):
    same = [{"description": "copied", "value": 2.0}] * 3 + [{"description": None, "value": 3.0}] * 2
    other = [{"description": "unlike", "value": float(i)} for i in range(4)]
    single = [{"description": f"single {i}"} for i in range(300)]
    broken = years({2015 + i: 1000.0 if i == 2 else 1.0 for i in range(6)}, company="B")
    steady = [r for i in range(60) for r in years({2015 + j: 1.0 for j in range(5)}, company=f"C{i}")]
    return standard(spark, same + other + single + broken + steady)


def test_rows_without_a_repeated_hash_are_not_shuffled(spark, no_broadcast, monkeypatch):
    mart = _repeated_mart(spark)

    def found():
        repeats = cell_repeats(mart)
        judged = suspect_values(uneven_series_values(mart, SETTINGS))
        frames = [duplicate_rows(repeats), ambiguous_rows(repeats), judged]
        return [sorted(map(str, df.collect())) for df in frames]

    plain = found()
    assert [len(x) for x in plain] == [2, 1, 1]
    # As if these few hashes were many.
    monkeypatch.setattr(sieve, "_FEW_HASHES", 0)
    assert found() == plain
    seen = []

    def sifted(rows, hashes, name):
        seen.append((rows.count(), sieve.sifted(rows, hashes, name).count()))
        return sieve.sifted(rows, hashes, name)

    monkeypatch.setattr("plumbrow.operators.repeats.sifted", sifted)
    monkeypatch.setattr(series, "sifted", sifted)
    candidates, uneven = repeat_candidates(mart, row_checks._CELL), uneven_series_values(mart, SETTINGS)
    (n, n_alike), (n_values, n_uneven) = seen
    assert n == 615 and 9 <= n_alike < 15
    assert 6 <= n_uneven < 20 < n_values
    assert "_block" in _plan(uneven)
    # The hash is formed once a row, though the sieve looks at it several times.
    _, below = _plan(candidates).split("BroadcastHashJoin", 1)
    assert "_block" in below and below.split("Exchange")[0].count("xxhash64") == 1


LINES = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, "
    "l_discount double, l_returnflag string, l_shipdate timestamp"
)


@pytest.fixture
def folder(spark, tmp_path):
    """Line items of suppliers with shared names, repeated keys, NULL and unknown ones."""
    day = [datetime(1995 + i, 5, 1) for i in range(5)]
    lines = [
        (i, p, s, 1.0 + i % 7, 10.25 + i, 0.05 * (i % 3), "RAN"[i % 3], day[i % 5])
        for i, (p, s) in enumerate([(i % 5, i % 6) for i in range(600)])
    ]
    lines += [(700, None, 1, 1.0, 1.0, 0.0, "R", day[0]), (701, 1, None, 1.0, 1.0, 0.0, "R", day[0])]
    lines += [(702, 99, 1, 1.0, 1.0, 0.0, "R", day[0]), (703, 1, 99, 1.0, 1.0, 0.0, "R", None)]
    lines += [(704, 1, 1, None, None, None, None, day[0])]
    suppliers = [(0, "S0", 3), (1, "S1", 4), (2, "S1", 4), (3, "S3", 4), (3, "S3", 4), (4, None, 5), (5, "S5", None)]
    parts = [(0, "LARGE"), (1, "SMALL"), (2, "LARGE"), (3, None), (4, "PROMO"), (4, "PROMO"), (None, "LARGE")]
    for name, data, schema in [
        ("lineitem", lines, LINES),
        ("supplier", suppliers, "s_suppkey bigint, s_name string, s_nationkey int"),
        ("part", parts, "p_partkey bigint, p_type string"),
    ]:
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("network", ["s_name", "'All'"])
def test_line_items_are_shuffled_once_and_narrow(spark, folder, monkeypatch, network):
    plans = {}

    def seen(df, label):
        plans[label] = _plan(df)
        return staging.stage(df, label)

    monkeypatch.setattr(samples, "stage", seen)
    found = samples._cells(spark, folder, by_supplier=network == "s_name")
    (plan,) = plans.values()
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition") == 1
    assert "l_orderkey" not in plan and "s_name" not in plan
    for name in ("lineitem", "supplier", "part"):
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(f"own_{name}")
    expected = spark.sql(
        f"""SELECT s_nationkey k, {network} network, year(l_shipdate) y, p_type t, l_returnflag f,
        CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 1000 gross,
        CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) quantity, CAST(COUNT(*) AS DOUBLE) n_lines,
        CAST(SUM(CAST(l_discount AS DECIMAL(18,4))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) share
        FROM own_lineitem JOIN own_supplier ON l_suppkey = s_suppkey JOIN own_part ON l_partkey = p_partkey
        GROUP BY ALL"""
    )
    assert found.columns == expected.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_a_named_mart_is_written_once(spark, folder):
    import __spark_entry__ as entry

    def staged():
        root = staging.staging_root(spark)
        return set(os.listdir(root)) if os.path.isdir(root) else set()

    before = staged()
    schema = entry._own_schema(spark)
    mart = entry._named_mart(spark, folder, schema)
    (left,) = staged() - before  # the schema's folder
    assert left.startswith(schema)
    expected = sorted(map(str, build_mart(spark, folder).collect()))
    assert sorted(map(str, mart.collect())) == expected and expected
    # A mart that is stored already is read, not built anew.
    stored = samples.sample_mart(spark, folder)
    with_stored = staged()
    again = entry._named_mart(spark, folder, entry._own_schema(spark))
    assert len(staged() - with_stored) == 1
    assert again.columns == stored.columns and sorted(map(str, again.collect())) == expected
    spark.sql(f"DROP DATABASE {schema} CASCADE")


def test_shuffles_that_are_done_with_are_deleted(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        found = [f for top in disk.localDirsString() for _, _, names in os.walk(top) for f in names]
        return {f for f in found if f.startswith("shuffle")}

    before = shuffles()
    staged = staging.stage(spark.range(1000).repartition(4, "id"), "dealt")
    made = shuffles() - before
    staging.release_shuffles(spark)
    for _ in range(100):
        if not made & shuffles():
            break
        time.sleep(0.1)
    assert made and not made & shuffles() and staged.count() == 1000
