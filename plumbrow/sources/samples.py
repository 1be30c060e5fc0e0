"""Marts of the checked shapes, derived from order and event tables.

The tables of a trade data set are reshaped into reported values and interruption records, with
known defects injected by predicate. Everything is a function of whole tables and grows with them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbrow.functions.dates import clock_text
from plumbrow.operators.reconcile import (
    BY_CLASS,
    COUNTS,
    N_INTERRUPTIONS,
    RELIABILITY_SCHEDULE,
    TRANSITIONAL,
    record_measures,
)
from plumbrow.sources.staging import release_shuffles, stage, staged_until_done
from plumbrow.sources.tables import TableRef, write_table

_stored: dict[tuple[str, str, str], DataFrame] = {}


def _stored_once(
    spark: SparkSession, folder: str, label: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """A derived table as a source would hold it: written once per application and folder."""
    key = (spark.sparkContext.applicationId, folder, label)
    if key not in _stored:
        _stored[key] = stage(build(), label)
    return _stored[key]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Line items in a task that sums them: each may open a group, of some 300 bytes.
_LINES_PER_TASK = 500_000


def _in_small_tasks(
    lines: DataFrame,
    most: int = _LINES_PER_TASK,
    rows: DataFrame | None = None,
    keys: Sequence[str] = ("l_orderkey",),
) -> DataFrame:
    """The lines, or `rows` made of them, dealt by the keys to as many tasks as the scan has, and to tasks of
    about `most` where it has fewer.

    A scan's task has all the rows of 128 MB, which are millions where they compress well, and its sums
    nearly as many groups.
    """
    n_tasks = max(-(-lines.count() // most), lines.rdd.getNumPartitions())
    return (lines if rows is None else rows).repartition(n_tasks, *keys)


def _either(*arms: tuple[Column, Column], otherwise: Column) -> Column:
    chosen = F
    for condition, result in arms:
        chosen = chosen.when(condition, result)
    return chosen.otherwise(otherwise)


def _cells(spark: SparkSession, folder: str, by_supplier: bool) -> DataFrame:
    """Line items summed per nation, ship year, part type and return flag.

    With `by_supplier` every supplier is a network of its nation, so the mart grows with the data;
    without, each nation has the one network 'All'. Sums are decimal, so their order is no matter.
    """
    suppliers = _table(spark, folder, "supplier")
    parts = _table(spark, folder, "part").select("p_partkey", F.col("p_type").alias("t"))
    scanned = _table(spark, folder, "lineitem")
    lines = scanned.select(
        "l_partkey",
        "l_suppkey",
        F.year("l_shipdate").alias("y"),
        F.col("l_returnflag").alias("f"),
        "l_extendedprice",
        "l_quantity",
        "l_discount",
    )
    lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).drop("l_partkey", "p_partkey")
    # Dealt before they are summed, as sums of a task's lines are nearly as many and wider than the lines.
    of_supplier = ["l_suppkey", "y", "t", "f"]
    sums = (
        _in_small_tasks(scanned, rows=lines, keys=of_supplier)
        .groupBy(*of_supplier)
        .agg(
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"),
            F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("quantity"),
            F.sum(F.col("l_discount").cast("decimal(18,4)")).alias("discount"),
            F.count("*").alias("n"),
        )
    )
    sums = stage(sums, "sample-sums")
    release_shuffles(spark)
    network = F.col("s_name") if by_supplier else F.lit("All")
    n_lines = F.sum("n").cast("double")
    return (
        sums.join(suppliers, sums.l_suppkey == suppliers.s_suppkey)
        .groupBy(F.col("s_nationkey").alias("k"), network.alias("network"), "y", "t", "f")
        .agg(
            (F.sum("price").cast("double") / 1000).alias("gross"),
            F.sum("quantity").cast("double").alias("quantity"),
            n_lines.alias("n_lines"),
            (F.sum("discount").cast("double") / n_lines).alias("share"),
        )
    )


def _odd_values(cells: DataFrame) -> DataFrame:
    """Six values per cell of one flag that reach what plain values do not.

    Varying items, texts, spellings of lengths, tariff units, values of the year before and of a year
    to come, blank and NULL names, and rows before the first disclosure year.
    """
    k, y, t = F.col("k"), F.col("y"), F.col("t")
    no_text, no_year = F.lit(None).cast("string"), F.lit(None).cast("int")
    varying = _either(
        (y % 3 == 0, F.col("gross") * 1000.0),
        (y % 2 == 0, -F.col("gross")),
        otherwise=F.col("gross"),
    )
    length = _either(
        (k % 7 == 3, F.lit("metres")),
        (k % 3 == 0, F.lit("kilometres")),
        (k % 3 == 1, F.lit("km")),
        otherwise=F.lit("K.m"),
    )
    note = F.concat(F.lit("note "), (k % 3).cast("string"))

    def item(
        description: str,
        value: Column,
        units: Column,
        text: Column = no_text,
        sub: Column = no_text,
        observed: Column = y,
        expected: Column = no_year,
    ) -> Column:
        return F.struct(
            F.lit(description).alias("description"),
            value.cast("double").alias("value"),
            units.alias("units"),
            text.alias("text_input"),
            sub.alias("sub_category"),
            observed.cast("int").alias("obs_yr"),
            expected.cast("int").alias("fcast_yr"),
        )

    nothing = F.lit(None)
    items = [
        item("Change in stock", varying, F.lit("$000")),
        item("Comment", nothing, F.lit("text input"), text=note),
        item("Length", F.col("n_lines"), length, sub=F.lit("  ")),
        item("Tariff", F.col("share"), F.lit("$/con|day"), text=F.lit(" "), sub=F.lit("Peak")),
        item("Prior value", F.col("gross"), F.lit("$000"), observed=y - 1),
        item("Forecast value", F.col("quantity"), F.lit("pieces"), observed=no_year, expected=y + 2),
    ]
    is_text = (F.col("description") == "Comment") & (t == "LARGE")
    versions = F.when(is_text & (k % 10).isin(4, 5), F.array(F.lit("1"), F.lit("2")))
    years = F.when(y == 1995, F.array(F.lit(1995), F.lit(1994))).otherwise(F.array(y))
    company = F.concat(F.lit("N"), F.lpad(k.cast("string"), 2, "0"))
    is_revised = (F.col("version") == "2") & (k % 10 == 5)
    return (
        cells.where(F.col("f") == "R")
        .select("k", "network", "y", "t", F.inline(F.array(*items)))
        .withColumn("version", F.explode(F.coalesce(versions, F.array(F.lit("1")))))
        .withColumn("disc_yr", F.explode(years))
        .select(
            _either((k == 24, no_text), (k == 23, F.lit("  ")), otherwise=company).alias("edb"),
            "network",
            "disc_yr",
            no_text.alias("sch_ref"),
            no_text.alias("sect_no"),
            F.lit("synthetic").alias("source"),
            _either((k == 22, F.lit(" ")), otherwise=F.lit("X-1")).alias("schedule"),
            F.lit("Other").alias("section"),
            t.alias("category"),
            "sub_category",
            "description",
            "obs_yr",
            "fcast_yr",
            "units",
            "value",
            F.when(is_revised, F.lit("revised")).otherwise(F.col("text_input")).alias("text_input"),
            "version",
            F.concat_ws(
                "|", F.lit("X"), company, "network", F.col("disc_yr").cast("string"), t, "description", "version"
            ).alias("uid"),
        )
    )


def build_mart(spark: SparkSession, folder: str, by_supplier: bool = True) -> DataFrame:
    """Four reported values per cell, with defects injected by predicate, and the odd values."""
    k, y, t, f, d = (F.col(c) for c in ("k", "y", "t", "f", "description"))
    gross, quantity = d == "Gross value", d == "Quantity"
    counts, share = d == "Line count", d == "Discount share"

    units = _either(
        (gross & (k % 2 == 0), F.lit("$000")),
        (gross, F.lit("$000s")),
        (quantity & (t == "ECONOMY") & (k % 4 == 0), F.lit("boxes")),
        (quantity & (t == "SMALL") & (k % 11 == 5), F.lit("PROMO")),
        (quantity & (t == "MEDIUM") & (k % 11 == 6), F.lit("12.5")),
        (quantity, F.lit("pieces")),
        (counts & (t == "STANDARD") & (y >= 1999), F.lit("lines")),
        (counts, F.lit("rows")),
        otherwise=F.lit("proportion"),
    )
    v = F.col("value")
    changed = _either(
        (gross & (t == "PROMO") & (f == "A") & (k % 5 == 1) & y.isin(1996, 1997), v * 1000.0),
        (gross & (t == "LARGE") & (f == "N") & (k % 5 == 2) & (y == 1998), v * 1000000.0),
        (gross & (f == "R") & (k % 7 == 3) & (y == 1999), v / 1000000.0),
        (gross & (t == "SMALL") & (f == "R") & (k % 7 == 4) & (y == 1999), v / 1000000.0),
        (gross & (t == "MEDIUM") & (k % 5 == 3) & (y == 2000), -v),
        (share & (k % 6 == 5), v * 100.0),
        ((f == "N") & (k % 8 == 1) & (y == 2001), F.lit(None).cast("double")),
        otherwise=v,
    )
    dropped = (
        ((k % 9 == 2) & (f == "A") & (y == 1997))
        | ((k % 9 == 4) & (f == "R") & (y == 1998) & (t != "PROMO"))
        | ((k % 9 == 7) & (y == 1998))
    )
    is_copied = (k % 10 == 3) & (t == "LARGE") & (f == "A")
    is_revised = (k % 10 == 6) & (t == "LARGE") & (f == "N") & v.isNotNull()
    versions = F.when(is_copied | is_revised, F.array(F.lit("1"), F.lit("2"))).otherwise(
        F.array(F.lit("1"))
    )
    named = {
        "Gross value": "gross",
        "Quantity": "quantity",
        "Line count": "n_lines",
        "Discount share": "share",
    }
    values = [
        F.struct(F.lit(name).alias("description"), F.col(c).alias("value"))
        for name, c in named.items()
    ]
    company = F.concat(F.lit("N"), F.lpad(k.cast("string"), 2, "0"))
    no_text = F.lit(None).cast("string")
    cells = stage(_cells(spark, folder, by_supplier), "sample-cells")
    release_shuffles(spark)
    plain = (
        cells.where(~dropped)
        .select("k", "network", "y", "t", "f", F.inline(F.array(*values)))
        .withColumn("units", units)
        .withColumn("value", changed)
        .withColumn("version", F.explode(versions))
        .withColumn("value", F.when(is_revised & (F.col("version") == "2"), v * 1.1).otherwise(v))
        .select(
            company.alias("edb"),
            "network",
            y.alias("disc_yr"),
            no_text.alias("sch_ref"),
            no_text.alias("sect_no"),
            F.lit("synthetic").alias("source"),
            F.concat(F.lit("S-"), f).alias("schedule"),
            F.lit("Sales").alias("section"),
            t.alias("category"),
            no_text.alias("sub_category"),
            "description",
            y.alias("obs_yr"),
            F.lit(None).cast("int").alias("fcast_yr"),
            "units",
            "value",
            no_text.alias("text_input"),
            "version",
            F.concat_ws("|", company, "network", y.cast("string"), f, t, d, "version").alias("uid"),
        )
    )
    return plain.unionByName(_odd_values(cells))


def _mart_label(by_supplier: bool) -> str:
    return f"{'supplier' if by_supplier else 'nation'}-mart"


def sample_mart(spark: SparkSession, folder: str, by_supplier: bool = True) -> DataFrame:
    return _stored_once(
        spark, folder, _mart_label(by_supplier), lambda: build_mart(spark, folder, by_supplier)
    )


def write_sample_mart(spark: SparkSession, folder: str, ref: TableRef, by_supplier: bool = True) -> None:
    """Write the sample mart as a table; one that is not stored yet is not stored a second time for that."""
    stored = _stored.get((spark.sparkContext.applicationId, folder, _mart_label(by_supplier)))
    with staged_until_done(spark):
        write_table(build_mart(spark, folder, by_supplier) if stored is None else stored, ref)


def build_interruptions(spark: SparkSession, folder: str) -> DataFrame:
    """One interruption record per event, with defects injected by predicate; one scan."""
    i, value = F.col("event_id"), F.col("value")
    e = (F.col("user_id") % 20).cast("int")
    start = clock_text(F.col("ts")).cast("timestamp_ntz")
    text = F.lit(None).cast("string")

    def every(n: int) -> Column:
        return i % n == 0

    def after(seconds: Column) -> Column:
        return start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))

    # Decimals throughout, so products and halves are exact.
    def exact(column: Column | float, kind: str) -> Column:
        return (column if isinstance(column, Column) else F.lit(column)).cast(kind)

    value = exact(value, "decimal(9,2)")
    icps = _either(
        (every(59), exact(i % 500, "decimal(9,1)") + exact(0.5, "decimal(2,1)")),
        (every(53), exact(0, "decimal(9,1)")),
        otherwise=exact(i % 500 + 1, "decimal(9,1)"),
    )
    per_customer = exact(0.00001, "decimal(6,5)")
    end = _either(
        (every(107), F.lit(None).cast("timestamp_ntz")),
        (every(101), start),
        (every(103), after(F.lit(-600))),
        otherwise=after(F.floor(value * 60)),
    )
    year = _either((every(97), F.lit(2023)), (every(89), F.lit(2025)), otherwise=F.lit(2024))
    fine = "decimal(18,10)"
    saidi = _either(
        (every(47), F.lit(None).cast(fine)),
        (every(43), exact(-1, fine)),
        (every(41), F.round((icps + 1) * value * per_customer * 10, 6).cast(fine)),
        (every(197), exact(0.1234567891, fine)),
        (every(199), exact(0.0000001, fine)),
        otherwise=F.round(icps * value * per_customer, 6).cast(fine),
    )
    coarse = "decimal(18,6)"
    saifi = _either(
        (every(37), exact(0, coarse)),
        (every(109), F.lit(None).cast(coarse)),
        (every(131), exact(-0.5, coarse)),
        (every(199), exact(0, coarse)),
        otherwise=(icps * per_customer).cast(coarse),
    )
    shown_icps = _either(
        (every(113), F.lit(None).cast("double")),
        (every(137), F.lit(-3.0)),
        (every(199), F.lit(0.0)),
        otherwise=icps.cast("double"),
    )
    icp_minutes = _either(
        (every(127), F.lit(None).cast("double")),
        (every(139), F.lit(-1.0)),
        otherwise=F.round(icps * value, 2).cast("double"),
    )
    planned_only = e.isin(8, 9)
    kind = _either(
        (planned_only, F.lit("Planned")),
        (every(73), text),
        (every(79), F.lit("Class X")),
        (every(157), F.lit("B")),
        (every(163), F.lit("C")),
        (every(167), F.lit("planned works")),
        (every(173), F.lit("UNPLANNED - fault")),
        (every(179), F.lit("b")),
        (every(3), F.lit("Planned")),
        otherwise=F.lit("Unplanned"),
    )
    n_copies = F.when(every(193), 3).when(every(67), 2).otherwise(1)
    copies = F.sequence(F.lit(1), n_copies)
    cause = _either(
        (every(83), F.lit("Transpower outage")),
        (every(181), F.lit("Outage at TRANSPOWER GXP")),
        (every(191), F.lit("Trans power line")),
        otherwise=F.col("event_type"),
    )
    circuit = F.when(every(122) | every(151), F.concat(F.lit("circuit "), (i % 7).cast("string")))
    return (
        _table(spark, folder, "events")
        .select(
            F.concat(F.lit("EDB_"), F.lpad(e.cast("string"), 2, "0")).alias("edb"),
            year.alias("disc_yr"),
            text.alias("subnetwork"),
            i.alias("row_num"),
            F.when(~every(71), F.concat(F.lit("I"), i.cast("string"))).alias(
                "interruption_identifier"
            ),
            circuit.alias("circuit_location"),
            F.when(~every(61), F.col("event_type")).alias("feeder"),
            F.when(~every(149), start).alias("start_datetime"),
            end.alias("end_datetime"),
            saidi.alias("saidi_value"),
            saifi.alias("saifi_value"),
            shown_icps.alias("number_of_icps_interrupted"),
            icp_minutes.alias("icp_interruption_minutes"),
            kind.alias("planned_or_unplanned"),
            cause.alias("cause"),
            text.alias("explanation"),
            F.explode(copies).alias("_copy"),
        )
        .withColumn("source", F.concat(F.lit("file "), F.col("_copy").cast("string")))
        .drop("_copy")
    )


def sample_interruptions(spark: SparkSession, folder: str) -> DataFrame:
    return _stored_once(spark, folder, "interruptions", lambda: build_interruptions(spark, folder))


def build_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Reported totals that agree with the records of most EDBs and differ as told for some.

    There are totals for every recorded year and for 2022, which has no records, and some lines of
    other schedules, networks and sections.
    """
    sums = record_measures(sample_interruptions(spark, folder))
    e = F.substring("edb", 5, 2).cast("int")
    both_classes = F.col("class").isin("B", "C")
    edb_year = ["edb", "disc_yr"]

    def factor(*arms: tuple[int, float]) -> Column:
        return _either(*[(e == n, F.lit(x)) for n, x in arms], otherwise=F.lit(1.0))

    without_transpower = e == 3
    saidi = F.col("saidi_10a") - F.when(
        without_transpower, F.col("saidi_10a_transpower")
    ).otherwise(0.0)
    saifi = F.col("saifi_10a") - F.when(
        without_transpower, F.col("saifi_10a_transpower")
    ).otherwise(0.0)

    # One row per EDB with both classes' sums, so a part of one can move to the other.
    wide = (
        sums.where((e != 2) & both_classes)
        .groupBy(*edb_year)
        .agg(
            *[
                F.max(F.when(F.col("class") == c, x)).alias(f"{name}_{c}")
                for c in ("B", "C")
                for name, x in (("saidi", saidi), ("saifi", saifi), ("n", F.col("ids_10a")))
            ],
            F.sum("saidi_10a_transpower").alias("saidi_D"),
            F.sum("saifi_10a_transpower").alias("saifi_D"),
        )
    )

    unrecorded = wide.where(F.col("disc_yr") == 2024).withColumn("disc_yr", F.lit(2022))
    wide = wide.unionByName(unrecorded)

    def line(class_: str, category: str, sub_category: str, value: Column) -> Column:
        return F.struct(
            F.lit(f"Class {class_} (synthetic)").alias("description"),
            F.lit(category).alias("category"),
            F.lit(sub_category).alias("sub_category"),
            value.cast("double").alias("value"),
        )

    is_split = e == 5
    planned_only = e.isin(8, 9)

    def moved(name: str, class_: str) -> Column:
        b, c = F.col(f"{name}_B"), F.col(f"{name}_C")
        if class_ == "B":
            return F.when(is_split, b * 0.9).otherwise(b)
        return F.when(is_split, c + b * 0.1).otherwise(c)

    def small_c(name: str, value: float) -> Column:
        return F.when(e == 8, F.lit(value)).when(e == 9, F.lit(0.0)).otherwise(moved(name, "C"))

    saidi_factor = factor((6, 1.2), (7, 0.8))
    saifi_factor = factor((4, 1.3), (6, 1.2), (7, 0.8))
    more = F.when(e == 6, F.lit(10)).otherwise(F.lit(0))
    transitional = e == 4
    old_saidi = F.when(transitional, F.lit(0.0)).when(e == 10, F.lit(2.5))
    nothing = F.lit(None).cast("double")
    lines = [
        line("B", BY_CLASS, "SAIDI", moved("saidi", "B") * saidi_factor),
        line("B", BY_CLASS, "SAIFI", moved("saifi", "B") * saifi_factor),
        line("B", COUNTS, N_INTERRUPTIONS, F.col("n_B") + more),
        line("B", TRANSITIONAL, "SAIFI", F.when(transitional, F.col("saifi_B"))),
        line("B", TRANSITIONAL, "SAIDI", F.when(F.col("n_B").isNotNull(), old_saidi)),
        line("C", BY_CLASS, "SAIDI", small_c("saidi", 5.0) * saidi_factor),
        line("C", BY_CLASS, "SAIFI", small_c("saifi", 0.1) * saifi_factor),
        line("C", COUNTS, N_INTERRUPTIONS, F.when(planned_only, nothing).otherwise(F.col("n_C") + more)),
        line("C", TRANSITIONAL, "SAIFI", F.when(transitional, F.col("saifi_C"))),
        line("D", BY_CLASS, "SAIDI", F.when(without_transpower, F.col("saidi_D"))),
        line("D", BY_CLASS, "SAIFI", F.when(without_transpower, F.col("saifi_D"))),
    ]
    # The last three places are not those of the reliability totals.
    section = "10(i): Interruptions"
    places = [
        (RELIABILITY_SCHEDULE, "All", section),
        ("SCHEDULE 9: REPORT ON LINES", "All", section),
        (RELIABILITY_SCHEDULE, "North", section),
        (RELIABILITY_SCHEDULE, "All", "10(ii): Interruptions"),
    ]
    here = F.array(
        *[
            F.struct(F.lit(a).alias("schedule"), F.lit(b).alias("network"), F.lit(c).alias("section"))
            for a, b, c in places
        ]
    )
    return (
        wide.select(*edb_year, F.inline(F.array(*lines)))
        .where(F.col("value").isNotNull())
        .select("*", F.explode(here).alias("_place"))
        .select(
            "edb",
            "_place.network",
            "disc_yr",
            "_place.schedule",
            "_place.section",
            "category",
            "sub_category",
            "description",
            "value",
        )
    )


def sample_totals(spark: SparkSession, folder: str) -> DataFrame:
    return _stored_once(spark, folder, "reported-totals", lambda: build_totals(spark, folder))
