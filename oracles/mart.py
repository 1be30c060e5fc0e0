"""Oracles of the table checks, over the supplier-grain sample mart."""

from __future__ import annotations

from plumbrow.functions.text import VARIANCE_WORDS
from plumbrow.operators.series import MONEY_UNITS
from plumbrow.settings import NON_UNITS, UNIT_WORDS


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


_NON_UNITS = _listed(NON_UNITS)

MART = """
cells AS (
  SELECT s.s_nationkey AS k, s.s_name AS network, CAST(year(l.l_shipdate) AS INTEGER) AS y,
         p.p_type AS t, l.l_returnflag AS f,
         CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 1000 AS gross,
         CAST(sum(CAST(l.l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
         CAST(count(*) AS DOUBLE) AS n_lines,
         CAST(sum(CAST(l.l_discount AS DECIMAL(18,4))) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS share
  FROM lineitem l, supplier s, part p
  WHERE l.l_suppkey = s.s_suppkey AND l.l_partkey = p.p_partkey
  GROUP BY ALL
),
tall AS (
  SELECT k, network, y, t, f, 'Gross value' AS d, gross AS v,
         CASE WHEN k % 2 = 0 THEN '$000' ELSE '$000s' END AS u FROM cells
  UNION ALL
  SELECT k, network, y, t, f, 'Quantity', quantity,
         CASE WHEN t = 'ECONOMY' AND k % 4 = 0 THEN 'boxes' WHEN t = 'SMALL' AND k % 11 = 5 THEN 'PROMO'
              WHEN t = 'MEDIUM' AND k % 11 = 6 THEN '12.5' ELSE 'pieces' END FROM cells
  UNION ALL
  SELECT k, network, y, t, f, 'Line count', n_lines,
         CASE WHEN t = 'STANDARD' AND y >= 1999 THEN 'lines' ELSE 'rows' END FROM cells
  UNION ALL
  SELECT k, network, y, t, f, 'Discount share', share, 'proportion' FROM cells
),
defective AS (
  SELECT k, network, y, t, f, d, u,
         CASE WHEN d = 'Gross value' AND t = 'PROMO' AND f = 'A' AND k % 5 = 1 AND y IN (1996, 1997) THEN v * 1e3
              WHEN d = 'Gross value' AND t = 'LARGE' AND f = 'N' AND k % 5 = 2 AND y = 1998 THEN v * 1e6
              WHEN d = 'Gross value' AND f = 'R' AND k % 7 = 3 AND y = 1999 THEN v / 1e6
              WHEN d = 'Gross value' AND t = 'SMALL' AND f = 'R' AND k % 7 = 4 AND y = 1999 THEN v / 1e6
              WHEN d = 'Gross value' AND t = 'MEDIUM' AND k % 5 = 3 AND y = 2000 THEN -v
              WHEN d = 'Discount share' AND k % 6 = 5 THEN v * 1e2
              WHEN f = 'N' AND k % 8 = 1 AND y = 2001 THEN NULL
              ELSE v END AS v
  FROM tall
  WHERE NOT (k % 9 = 2 AND f = 'A' AND y = 1997)
    AND NOT (k % 9 = 4 AND f = 'R' AND y = 1998 AND t <> 'PROMO')
    AND NOT (k % 9 = 7 AND y = 1998)
),
released AS (
  SELECT *, '1' AS ver FROM defective
  UNION ALL SELECT *, '2' FROM defective WHERE k % 10 = 3 AND t = 'LARGE' AND f = 'A'
  UNION ALL SELECT k, network, y, t, f, d, u, v * 1.1e0, '2' FROM defective
            WHERE k % 10 = 6 AND t = 'LARGE' AND f = 'N' AND v IS NOT NULL
),
odd AS (
  SELECT k, network, y, t, d.*, unnest(CASE WHEN y = 1995 THEN [1995, 1994] ELSE [y] END) AS dy
  FROM cells, LATERAL (VALUES
    ('Change in stock', CASE WHEN y % 3 = 0 THEN gross * 1e3 WHEN y % 2 = 0 THEN -gross ELSE gross END, '$000',
     NULL, NULL, y, NULL),
    ('Comment', NULL, 'text input', 'note ' || k % 3, NULL, y, NULL),
    ('Length', n_lines, CASE WHEN k % 7 = 3 THEN 'metres' WHEN k % 3 = 0 THEN 'kilometres' WHEN k % 3 = 1 THEN 'km'
                        ELSE 'K.m' END, NULL, NULL, y, NULL),
    ('Tariff', share, '$/con|day', NULL, 'Peak', y, NULL),
    ('Prior value', gross, '$000', NULL, NULL, y - 1, NULL),
    ('Forecast value', quantity, 'pieces', NULL, NULL, NULL, y + 2)
  ) d(d, v, u, txt, sub, oy, fy)
  WHERE f = 'R'
),
odd_released AS (
  SELECT *, '1' AS ver FROM odd
  UNION ALL SELECT * REPLACE (CASE WHEN k % 10 = 5 THEN 'revised' ELSE txt END AS txt), '2' FROM odd
            WHERE d = 'Comment' AND t = 'LARGE' AND k % 10 IN (4, 5)
),
both_kinds AS (
  SELECT printf('N%02d', k) AS company, network, y AS dy, 'S-' || f AS schedule, 'Sales' AS section, t,
         CAST(NULL AS VARCHAR) AS sub, d, y AS oy, CAST(NULL AS INTEGER) AS fy, u, v, CAST(NULL AS VARCHAR) AS txt, ver,
         concat_ws('|', printf('N%02d', k), network, y, f, t, d, ver) AS uid
  FROM released
  UNION ALL
  SELECT CASE WHEN k < 23 THEN printf('N%02d', k) END, network, dy, CASE WHEN k <> 22 THEN 'X-1' END, 'Other', t,
         sub, d, oy, fy, u, v, txt, ver, concat_ws('|', 'X', printf('N%02d', k), network, dy, t, d, ver)
  FROM odd_released
),
std AS (
  SELECT 'edb' AS sector, company, network, CAST(dy AS INTEGER) AS disclosure_year,
         CAST(NULL AS VARCHAR) AS schedule_reference, CAST(NULL AS VARCHAR) AS section_number,
         'synthetic' AS source, schedule, section, t AS category_1,
         sub AS category_2, CAST(NULL AS VARCHAR) AS category_3, d AS description,
         CAST(NULL AS DATE) AS period_beginning, CAST(NULL AS DATE) AS period_ending,
         CAST(oy AS INTEGER) AS observation_year, CAST(NULL AS DATE) AS observation_month,
         CAST(fy AS INTEGER) AS forecast_year, CAST(NULL AS VARCHAR) AS actual_or_forecast,
         u AS units, v AS value, txt AS text_value, ver AS version, uid,
         concat_ws(' / ', section, t, sub, d) AS item
  FROM both_kinds WHERE dy >= 1995
)
"""

_CELL = """sector, company, network, disclosure_year, schedule_reference, section_number, source, schedule, section,
       category_1, category_2, category_3, description, period_beginning, period_ending, observation_year,
       observation_month, forecast_year, actual_or_forecast, units, item"""

# All columns that name a cell, the dates as text.
_LABELS = """sector, company, network, disclosure_year, schedule_reference, section_number, source, schedule,
       section, category_1, category_2, category_3, description,
       CAST(period_beginning AS VARCHAR) AS period_beginning, CAST(period_ending AS VARCHAR) AS period_ending,
       observation_year, CAST(observation_month AS VARCHAR) AS observation_month, forecast_year,
       actual_or_forecast, units"""

# How far the reported year lies from the year of disclosure.
_OFFSET = "coalesce(observation_year, year(observation_month), forecast_year, year(period_ending)) - disclosure_year"

_SERIES = f"""
points AS (
  SELECT *,
         count(*) OVER line AS n_years,
         count(DISTINCT disclosure_year) OVER line AS n_distinct,
         median(abs(value)) OVER line AS series_median,
         list_has_any(
           [lower(item).contains(w) FOR w IN [{_listed(VARIANCE_WORDS)}]],
           [true]) AS is_variance_like
  FROM std WHERE value <> 0
  WINDOW line AS (PARTITION BY sector, company, network, source, schedule, section, category_1, category_2,
                  category_3, description, units, actual_or_forecast, {_OFFSET}, month(observation_month))
),
usable AS (
  SELECT *, abs(value) / series_median AS r,
         row(sector, company, network, source, schedule, section, category_1, category_2, category_3, description,
             units, actual_or_forecast, {_OFFSET}, month(observation_month)) AS sid
  FROM points WHERE n_years = n_distinct AND n_years >= 4
)
"""

_UNITS = f"""
spelled AS (
  SELECT sector, schedule, item, disclosure_year, units, uid,
         regexp_replace(lower(units), '[ \\t\\n._-]+', '', 'g') AS bare
  FROM std WHERE NOT contains(units, '|') AND units NOT IN ({_NON_UNITS})
),
keyed AS (
  SELECT * EXCLUDE (bare),
         CASE WHEN lower(units) IN ('kilometre', 'kilometres') THEN 'km'
              WHEN lower(units) IN ('metre', 'metres') THEN 'm'
              ELSE regexp_replace(bare, '^(.{{2,}})s$', '\\1') END AS unit
  FROM spelled
)
"""


def _units_query(scope: str, mixed: str) -> str:
    return f"""
WITH {MART}, {_UNITS},
years AS (
  SELECT sector, schedule, item, disclosure_year, len(list_distinct(list(unit))) AS n
  FROM keyed GROUP BY ALL
),
items AS (
  SELECT sector, schedule, item, min(uid) AS uid, count(DISTINCT unit) AS n_units,
         array_to_string(list_sort(list_distinct(list(units))), ', ') AS units_used
  FROM keyed GROUP BY ALL
)
SELECT 'units_{scope}' AS check_name, sector, CAST(NULL AS VARCHAR) AS company,
       CAST(NULL AS INTEGER) AS disclosure_year, schedule, item, uid, n_units, units_used,
       1 AS part, 1 AS n_parts
FROM items
WHERE n_units > 1 AND schedule IS NOT NULL AND {mixed} EXISTS (
  SELECT 1 FROM years WHERE years.schedule = items.schedule AND years.item = items.item AND years.n > 1)
"""


_MISSING_SCHEDULES = """
pairs AS (SELECT DISTINCT sector, company, disclosure_year AS y, schedule FROM std WHERE schedule IS NOT NULL),
grid AS (
  SELECT c.sector, c.company, c.y, s.schedule,
         (SELECT count(*) FROM (SELECT DISTINCT company, y FROM pairs) a WHERE a.y = c.y) AS n_companies,
         (SELECT count(a.company) FROM pairs a WHERE a.y = c.y AND a.schedule = s.schedule) AS n_disclosing,
         EXISTS (SELECT 1 FROM pairs a WHERE a.company = c.company AND a.schedule = s.schedule AND a.y = c.y) AS has,
         EXISTS (SELECT 1 FROM pairs a WHERE a.company = c.company AND a.schedule = s.schedule AND a.y = c.y - 1)
         AND EXISTS (SELECT 1 FROM pairs a WHERE a.company = c.company AND a.schedule = s.schedule AND a.y = c.y + 1)
           AS around
  FROM (SELECT DISTINCT sector, company, y FROM pairs) c, (SELECT DISTINCT schedule FROM pairs) s
)
"""

CHECK_SQL: dict[str, str] = {
    "duplicate_rows": f"""
WITH {MART}
SELECT 'duplicate_rows' AS check_name, sector, company, disclosure_year, schedule, item,
       min(uid) AS uid, count(*) AS n_rows, string_agg(uid, ', ' ORDER BY uid) AS uids,
       1 AS part, 1 AS n_parts, value, text_value
FROM std GROUP BY {_CELL}, value, text_value HAVING count(*) > 1
""",
    "ambiguous_rows": f"""
WITH {MART}
SELECT 'ambiguous_rows' AS check_name, sector, company, disclosure_year, schedule, item,
       min(uid) AS uid, count(*) AS n_rows,
       count(DISTINCT row(value, text_value)) AS n_values,
       string_agg(uid, ', ' ORDER BY uid) AS uids, 1 AS part, 1 AS n_parts,
       min(value) AS min_value, max(value) AS max_value
FROM std GROUP BY {_CELL}
HAVING count(*) > 1 AND count(DISTINCT row(value, text_value)) > 1
""",
    "scale_break": f"""
WITH {MART}, {_SERIES},
scaled AS (
  SELECT *,
    CASE WHEN r >= 1e0/3 AND r <= 3 THEN 'normal'
         WHEN r >= 300 AND r <= 3000 THEN '1,000x larger'
         WHEN r >= 1e0/3000 AND r <= 1e0/300 THEN '1,000x smaller'
         WHEN units = 'proportion' AND r >= 30 AND r <= 300 THEN '100x larger'
         WHEN units = 'proportion' AND r >= 1e0/300 AND r <= 1e0/30 THEN '100x smaller'
         ELSE 'neither' END AS scale
  FROM usable WHERE NOT is_variance_like
),
broken AS (
  SELECT sid FROM scaled GROUP BY sid
  HAVING count(*) FILTER (scale = 'neither') = 0 AND count(DISTINCT scale) = 2
     AND count(*) FILTER (scale = 'normal') > count(*) FILTER (scale <> 'normal')
     AND count(*) FILTER (scale = 'normal') > 0
)
SELECT 'scale_break' AS check_name, sector, company, disclosure_year, schedule, item, uid, units, value,
       round(series_median, 6) AS series_median, round(r, 6) AS ratio_to_median, scale
FROM scaled SEMI JOIN broken USING (sid) WHERE scale <> 'normal'
""",
    "magnitude_outlier": f"""
WITH {MART}, {_SERIES},
lone AS (
  SELECT * FROM usable WHERE NOT is_variance_like
  QUALIFY (r >= 1e4 OR r <= 1e-4)
      AND count(*) FILTER (r < 0.1e0 OR r > 10) OVER (PARTITION BY sid) = 1
),
counted AS (SELECT *, count(*) OVER (PARTITION BY company, disclosure_year, schedule) AS here FROM lone)
SELECT 'magnitude_outlier' AS check_name, sector, company, disclosure_year, schedule, item, uid, units, value,
       round(series_median, 6) AS series_median, round(r, 6) AS ratio_to_median
FROM counted WHERE r > 1 OR here >= 3
""",
    "sign_flip": f"""
WITH {MART}, {_SERIES},
signs AS (
  SELECT sid, count(*) FILTER (value < 0) AS n_minus, count(*) FILTER (value > 0) AS n_plus
  FROM usable
  WHERE units IN ({_listed(MONEY_UNITS)}) AND NOT is_variance_like
  GROUP BY sid HAVING min(r) >= 1e0/3 AND max(r) <= 3
)
SELECT 'sign_flip' AS check_name, u.sector, u.company, u.disclosure_year, u.schedule, u.item, u.uid, u.units,
       u.value, round(u.series_median, 6) AS series_median, u.n_years
FROM usable u JOIN signs USING (sid)
WHERE (n_minus = 1 AND value < 0) OR (n_plus = 1 AND value > 0)
""",
    "percent_as_proportion": f"""
WITH {MART},
own AS (
  SELECT sector, company, schedule, item, median(abs(value)) AS m, min(uid) AS uid,
         min(disclosure_year) AS first_year, max(disclosure_year) AS last_year
  FROM std WHERE units = 'proportion' AND value <> 0 GROUP BY ALL
),
peers AS (SELECT *, median(m) OVER peer AS pm, count(*) OVER peer AS n FROM own
          WINDOW peer AS (PARTITION BY schedule, item))
SELECT 'percent_as_proportion' AS check_name, sector, company, CAST(NULL AS INTEGER) AS disclosure_year,
       schedule, item, uid, round(m, 6) AS company_median, round(pm, 6) AS peer_median,
       n AS n_companies, first_year, last_year
FROM peers WHERE schedule IS NOT NULL AND m > 1.5 AND m <= 100 AND pm <= 1 AND n >= 3
""",
    "units_within_year": _units_query("within_year", ""),
    "units_across_years": _units_query("across_years", "NOT"),
    "units_are_units": f"""
WITH {MART},
labels AS (
  SELECT DISTINCT unnest([category_1, category_2, category_3, description]) AS label FROM std
)
SELECT 'units_are_units' AS check_name, sector, CAST(NULL AS VARCHAR) AS company,
       CAST(NULL AS INTEGER) AS disclosure_year, schedule, units AS item, min(uid) AS uid,
       count(*) AS n_rows, count(DISTINCT company) AS n_companies,
       min(disclosure_year) AS first_year, max(disclosure_year) AS last_year
FROM std
WHERE NOT contains(units, '|') AND units NOT IN ({_NON_UNITS})
  AND units NOT IN ({_listed(UNIT_WORDS)})
  AND (translate(units, '0123456789.', '') = '' OR EXISTS (SELECT 1 FROM labels WHERE label = units))
GROUP BY sector, schedule, units
""",
    "blank_schedule": f"""
WITH {MART}
SELECT 'blank_schedule' AS check_name, sector, company, disclosure_year, schedule,
       CAST(NULL AS VARCHAR) AS item, min(uid) AS uid, count(*) AS n_rows,
       count(*) FILTER (value IS NULL AND text_value IS NULL) / count(*) AS empty_share
FROM std GROUP BY sector, company, disclosure_year, schedule
HAVING count(*) >= 20 AND count(*) FILTER (value IS NULL AND text_value IS NULL) >= 0.8 * count(*)
""",
    "schedule_gap": f"""
WITH {MART}, {_MISSING_SCHEDULES}
SELECT 'schedule_gap' AS check_name, sector, company, y AS disclosure_year, schedule,
       CAST(NULL AS VARCHAR) AS item, CAST(NULL AS VARCHAR) AS uid,
       around AS had_year_before_and_after, n_disclosing, n_companies
FROM grid WHERE NOT has AND (around OR (n_companies >= 5 AND n_disclosing >= 0.75 * n_companies))
""",
    "row_count_drop": f"""
WITH {MART},
sizes AS (
  SELECT sector, company, disclosure_year, schedule, count(*) AS n_rows, min(uid) AS uid FROM std GROUP BY ALL
),
usual AS (
  SELECT company, schedule, quantile_cont(n_rows, 0.5) AS usual_rows FROM sizes
  GROUP BY ALL HAVING count(*) >= 3
)
SELECT 'row_count_drop' AS check_name, sector, company, disclosure_year, schedule,
       CAST(NULL AS VARCHAR) AS item, uid, n_rows, usual_rows
FROM sizes JOIN usual USING (company, schedule) WHERE n_rows < 0.25 * usual_rows
""",
    "year_gap": f"""
WITH {MART},
spans AS (SELECT sector, company, min(disclosure_year) AS first_year, max(disclosure_year) AS last_year
          FROM std GROUP BY ALL)
SELECT 'year_gap' AS check_name, sector, company, t.y AS disclosure_year, CAST(NULL AS VARCHAR) AS schedule,
       CAST(NULL AS VARCHAR) AS item, CAST(NULL AS VARCHAR) AS uid, first_year, last_year
FROM spans, (SELECT DISTINCT disclosure_year AS y FROM std) t
WHERE t.y BETWEEN first_year AND last_year
  AND NOT EXISTS (SELECT 1 FROM std WHERE std.company = spans.company AND std.disclosure_year = t.y)
""",
}

_SEVERITY = {"ambiguous_rows": "error"}


def _all_findings() -> str:
    parts = [
        f"""SELECT check_name, 'edb_dq_{name}' AS test_name, '{_SEVERITY.get(name, "warn")}' AS severity,
       sector, company, disclosure_year, schedule, item, uid FROM ({sql})"""
        for name, sql in CHECK_SQL.items()
    ]
    return "\nUNION ALL\n".join(parts)


MART_SQL: dict[str, str] = {
    **CHECK_SQL,
    "standard_rows": f"""
WITH {MART}
SELECT * EXCLUDE (item) REPLACE (
  CAST(period_beginning AS VARCHAR) AS period_beginning, CAST(period_ending AS VARCHAR) AS period_ending,
  CAST(observation_month AS VARCHAR) AS observation_month)
FROM std
""",
    "line_items": f"""
WITH {MART} SELECT schedule, item, count(*) AS n_rows FROM std GROUP BY schedule, item
""",
    "normalised_units": f"""
WITH {MART}
SELECT units,
       CASE WHEN lower(units) IN ('kilometre', 'kilometres') THEN 'km'
            WHEN lower(units) IN ('metre', 'metres') THEN 'm'
            ELSE regexp_replace(regexp_replace(lower(units), '[ \\t\\n._-]+', '', 'g'), '^(.{{2,}})s$', '\\1') END AS unit_key,
       count(*) AS n_rows
FROM std GROUP BY units
""",
    "schedule_sizes": f"""
WITH {MART}
SELECT sector, company, disclosure_year, schedule, count(*) AS n_rows,
       count(*) FILTER (value IS NULL AND text_value IS NULL) AS n_empty
FROM std GROUP BY sector, company, disclosure_year, schedule
""",
    "series_values": f"""
WITH {MART}, {_SERIES}
SELECT company, network, disclosure_year, schedule, item, units, uid, value,
       {_OFFSET} AS column_year_offset, n_years,
       round(series_median, 6) AS series_median, round(r, 6) AS ratio_to_median, is_variance_like
FROM usable
""",
    "item_spellings": f"""
WITH {MART}, {_UNITS} SELECT DISTINCT sector, schedule, item, unit AS unit_key, units FROM keyed
""",
    "duplicate_row_members": f"""
WITH {MART}, sets AS (
  SELECT *, min(uid) OVER same AS set_uid, count(*) OVER same AS n FROM std
  WINDOW same AS (PARTITION BY {_CELL}, value, text_value))
SELECT {_LABELS}, value, text_value, set_uid, uid FROM sets WHERE n > 1
""",
    "ambiguous_row_members": f"""
WITH {MART}, sets AS (
  SELECT *, min(uid) OVER same AS set_uid, count(DISTINCT row(value, text_value)) OVER same > 1 AS differs FROM std
  WINDOW same AS (PARTITION BY {_CELL}))
SELECT {_LABELS}, set_uid, uid FROM sets WHERE differs
""",
    "all_findings": _all_findings(),
    "check_statuses": f"""
WITH found AS ({_all_findings()}),
checks AS (SELECT unnest([{", ".join(repr(n) for n in CHECK_SQL)}]) AS check_name)
SELECT checks.check_name, 'edb_dq_' || checks.check_name AS test_name,
       CASE checks.check_name WHEN 'ambiguous_rows' THEN 'error' ELSE 'warn' END AS severity,
       count(found.check_name) AS n_findings,
       CASE WHEN count(found.check_name) = 0 THEN 'pass'
            WHEN checks.check_name = 'ambiguous_rows' THEN 'fail' ELSE 'warn' END AS status
FROM checks LEFT JOIN found USING (check_name) GROUP BY checks.check_name
""",
    "named_table": CHECK_SQL["blank_schedule"],
    "stored_findings": _all_findings(),
    "run_history": f"""
WITH found AS ({_all_findings()}),
checks AS (SELECT unnest([{", ".join(repr(n) for n in CHECK_SQL)}]) AS check_name),
runs AS (
  SELECT checks.check_name, count(found.check_name) AS n_findings
  FROM checks LEFT JOIN found USING (check_name) GROUP BY checks.check_name
),
history AS (
  SELECT * FROM runs UNION ALL SELECT * FROM runs WHERE check_name IN ('duplicate_rows', 'ambiguous_rows'))
SELECT 'edb_dq_' || check_name AS test_name, check_name,
       CASE check_name WHEN 'ambiguous_rows' THEN 'error' ELSE 'warn' END AS severity,
       CASE check_name WHEN 'units_across_years' THEN 'data_quality,informational' ELSE 'data_quality' END AS tags,
       n_findings,
       CASE WHEN n_findings = 0 THEN 'pass' WHEN check_name = 'ambiguous_rows' THEN 'fail' ELSE 'warn' END AS status
FROM history
""",
    "text_to_double": """
SELECT c_custkey, c_acctbal AS acctbal, CAST(NULL AS DOUBLE) AS segment FROM customer
""",
}
