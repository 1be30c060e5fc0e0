"""Oracles of the record rules and the reconciliation, over the sample interruption records."""

from __future__ import annotations

RECORDS = """
raw AS (
  SELECT event_id AS i, user_id % 20 AS e, date_trunc('second', ts) AS st, event_type AS et, value AS v,
         CAST(value AS DECIMAL(9,2)) AS dv,
         CASE WHEN event_id % 59 = 0 THEN CAST(event_id % 500 AS DECIMAL(9,1)) + 0.5
              WHEN event_id % 53 = 0 THEN CAST(0 AS DECIMAL(9,1))
              ELSE CAST(1 + event_id % 500 AS DECIMAL(9,1)) END AS n
  FROM events
),
once AS (
  SELECT printf('EDB_%02d', e) AS edb,
         CASE WHEN i % 97 = 0 THEN 2023 WHEN i % 89 = 0 THEN 2025 ELSE 2024 END AS disc_yr,
         i AS row_num,
         CASE WHEN i % 71 <> 0 THEN 'I' || i END AS ident,
         CASE WHEN i % 61 <> 0 THEN et END AS feeder,
         CASE WHEN i % 122 = 0 OR i % 151 = 0 THEN 'circuit ' || i % 7 END AS circuit,
         CASE WHEN i % 149 <> 0 THEN st END AS start_at,
         CASE WHEN i % 107 = 0 THEN NULL WHEN i % 101 = 0 THEN st
              WHEN i % 103 = 0 THEN st - INTERVAL 600 SECOND
              ELSE st + to_seconds(CAST(floor(dv * 60) AS BIGINT)) END AS end_at,
         CASE WHEN i % 47 = 0 THEN NULL WHEN i % 43 = 0 THEN CAST(-1 AS DECIMAL(18,10))
              WHEN i % 41 = 0 THEN CAST(round((n + 1) * dv * 0.00001 * 10, 6) AS DECIMAL(18,10))
              WHEN i % 197 = 0 THEN CAST(0.1234567891 AS DECIMAL(18,10))
              WHEN i % 199 = 0 THEN CAST(0.0000001 AS DECIMAL(18,10))
              ELSE CAST(round(n * dv * 0.00001, 6) AS DECIMAL(18,10)) END AS saidi,
         CAST(CASE WHEN i % 37 = 0 THEN 0 WHEN i % 109 = 0 THEN NULL WHEN i % 131 = 0 THEN -0.5
              WHEN i % 199 = 0 THEN 0 ELSE n * 0.00001 END AS DECIMAL(18,6)) AS saifi,
         CASE WHEN i % 113 = 0 THEN NULL WHEN i % 137 = 0 THEN -3e0 WHEN i % 199 = 0 THEN 0e0
              ELSE CAST(n AS DOUBLE) END AS icps,
         CASE WHEN i % 127 = 0 THEN NULL WHEN i % 139 = 0 THEN -1e0
              ELSE CAST(round(n * dv, 2) AS DOUBLE) END AS icp_minutes,
         CASE WHEN e IN (8, 9) THEN 'Planned' WHEN i % 73 = 0 THEN NULL WHEN i % 79 = 0 THEN 'Class X'
              WHEN i % 157 = 0 THEN 'B' WHEN i % 163 = 0 THEN 'C' WHEN i % 167 = 0 THEN 'planned works'
              WHEN i % 173 = 0 THEN 'UNPLANNED - fault' WHEN i % 179 = 0 THEN 'b'
              WHEN i % 3 = 0 THEN 'Planned' ELSE 'Unplanned' END AS kind,
         CASE WHEN i % 83 = 0 THEN 'Transpower outage' WHEN i % 181 = 0 THEN 'Outage at TRANSPOWER GXP'
              WHEN i % 191 = 0 THEN 'Trans power line' ELSE et END AS cause,
         CASE WHEN i % 193 = 0 THEN 3 WHEN i % 67 = 0 THEN 2 ELSE 1 END AS n_copies
  FROM raw
),
rec AS (
  SELECT once.*, c.copy, CAST(saidi AS DOUBLE) AS sd, CAST(saifi AS DOUBLE) AS sf,
         date_diff('second', start_at, end_at) / 60e0 AS mins,
         year(start_at + INTERVAL 9 MONTH) AS start_dy
  FROM once, (SELECT unnest([1, 2, 3]) AS copy) c WHERE c.copy <= once.n_copies
)
"""


def _num(expression: str) -> str:
    """A number without trailing zeros; no sample value has more than twelve decimals."""
    return f"rtrim(rtrim(CAST(CAST({expression} AS DECIMAL(38,12)) AS VARCHAR), '0'), '.')"


def _rounded(expression: str, places: int) -> str:
    """A double rounded as it is printed, so that 0.00815 is a half whatever its last bit."""
    return f"CAST(CAST({expression} AS VARCHAR) AS DECIMAL(24,{places}))"


def _dbl(expression: str, places: int) -> str:
    return f"CAST({_rounded(expression, places)} AS DOUBLE)"


def _num5(expression: str) -> str:
    return f"rtrim(rtrim(CAST({_rounded(expression, 5)} AS VARCHAR), '0'), '.')"


# Rule: condition and detail.
_RULES: dict[str, tuple[str, str]] = {
    "DUPLICATE_ROW": ("copy > 1", "'Exact copy of another row (copy ' || copy || ')'"),
    "MISSING_START_OR_END": ("start_at IS NULL OR end_at IS NULL", "'Start or end date/time is blank'"),
    "START_OUTSIDE_DISCLOSURE_YEAR": (
        "start_dy <> disc_yr",
        """printf('Start %s is not in DY%d%s', strftime(start_at, '%Y-%m-%d %H:%M:%S'), disc_yr,
           CASE WHEN day(start_at) <= 12
                 AND year(start_at) + (day(start_at) >= 4)::INTEGER = disc_yr
                 AND (CAST(start_at AS DATE) < make_date(disc_yr - 1, 4, 1) - 7
                      OR CAST(start_at AS DATE) > make_date(disc_yr, 3, 31) + 7)
                THEN ' - day and month look swapped' ELSE '' END)""",
    ),
    "END_BEFORE_START": ("mins < 0", f"'End is ' || {_num('round(-mins, 1)')} || ' min before start'"),
    "ZERO_DURATION": ("end_at = start_at", "'Start and end are identical'"),
    "UNDER_1_MINUTE": (
        "end_at > start_at AND mins < 1",
        f"'Lasts ' || {_num('round(mins * 60)')} || ' s - not an interruption by definition'",
    ),
    "MISSING_VALUE": (
        "saidi IS NULL OR saifi IS NULL OR icps IS NULL OR icp_minutes IS NULL",
        """'Blank: ' || concat_ws(' ', CASE WHEN saidi IS NULL THEN 'SAIDI' END, CASE WHEN saifi IS NULL THEN 'SAIFI' END,
           CASE WHEN icps IS NULL THEN 'ICPs' END, CASE WHEN icp_minutes IS NULL THEN 'ICP-minutes' END)""",
    ),
    "NEGATIVE_VALUE": ("saidi < 0 OR saifi < 0 OR icps < 0 OR icp_minutes < 0", "'Negative SAIDI, SAIFI, ICPs or ICP-minutes'"),
    "FRACTIONAL_ICPS": (
        "abs(icps - round(icps)) > 0.001",
        f"'ICPs interrupted = ' || {_num('icps')} || ' (must be a whole number)'",
    ),
    "SAIDI_OR_SAIFI_WITH_NO_ICPS": (
        "icps = 0 AND (saidi > 0 OR saifi > 0)",
        f"'ICPs interrupted = 0 but SAIDI ' || {_num('sd')} || ', SAIFI ' || {_num('sf')}",
    ),
    "SAIFI_ZERO_BUT_SAIDI_REQUIRES_IT": (
        "saifi = 0 AND icps > 0 AND CASE WHEN mins >= 1 THEN sd / mins >= 1e-4 ELSE false END",
        f"""'SAIFI = 0 but SAIDI ' || {_num('sd')} || ' over ' || {_num('round(mins)')} ||
            ' min needs SAIFI >= ' || {_num5('sd / nullif(mins, 0)')}""",
    ),
    "SAIDI_EXCEEDS_PHYSICAL_MAXIMUM": (
        "saifi > 0 AND mins >= 1 AND sd > 2 * (sf + 0.00005e0) * mins + 1e-4",
        f"'SAIDI ' || {_num('sd')} || ' > 2 x SAIFI x duration (' || {_num5('sf * mins')} || ')'",
    ),
    "INVALID_CLASS": (
        "kind IS NULL OR NOT (kind ILIKE 'planned%' OR kind ILIKE 'unplanned%' OR kind IN ('B', 'C'))",
        "'Planned/unplanned field = ' || coalesce(kind, '(blank)')",
    ),
    "TRANSPOWER_CLASS_D_ROW": (
        "cause ILIKE '%transpower%'",
        "'Cause \"' || cause || '\" - Class D interruption should not be in 10a'",
    ),
    "MISSING_IDENTIFIER_OR_FEEDER": (
        "ident IS NULL OR (feeder IS NULL AND circuit IS NULL)",
        """'Blank: ' || concat_ws(' ', CASE WHEN ident IS NULL THEN 'identifier' END,
           CASE WHEN feeder IS NULL AND circuit IS NULL THEN 'feeder/circuit' END)""",
    ),
}


def _errors(rule: str) -> str:
    condition, detail = _RULES[rule]
    return f"""SELECT edb, disc_yr, row_num, ident AS interruption_identifier, '{rule}' AS check_name,
       {detail} AS detail FROM rec WHERE {condition}"""


_ALL_ERRORS = "\nUNION ALL\n".join(_errors(rule) for rule in _RULES)

_SUMS = """
classed AS (
  SELECT edb, disc_yr, CASE WHEN kind ILIKE '%unplanned%' THEN 'C' ELSE 'B' END AS class, ident, saidi, saifi,
         cause ILIKE '%transpower%' AS is_tp
  FROM once
),
sums AS (
  SELECT edb, disc_yr, class, count(*) AS rows_10a, count(DISTINCT ident) AS ids_10a,
         CAST(sum(saidi) AS DOUBLE) AS saidi, CAST(sum(saifi) AS DOUBLE) AS saifi,
         CAST(sum(CASE WHEN is_tp THEN saidi ELSE 0 END) AS DOUBLE) AS saidi_tp,
         CAST(sum(CASE WHEN is_tp THEN saifi ELSE 0 END) AS DOUBLE) AS saifi_tp
  FROM classed GROUP BY edb, disc_yr, class
)
"""

_REPORTED = """
recorded AS (
  SELECT edb, disc_yr, CAST(right(edb, 2) AS INTEGER) AS e,
         max(CASE WHEN class = 'B' THEN saidi END) AS ab, max(CASE WHEN class = 'C' THEN saidi END) AS ac,
         max(CASE WHEN class = 'B' THEN saifi END) AS fb, max(CASE WHEN class = 'C' THEN saifi END) AS fc,
         max(CASE WHEN class = 'B' THEN saidi - saidi_tp END) AS abx,
         max(CASE WHEN class = 'C' THEN saidi - saidi_tp END) AS acx,
         max(CASE WHEN class = 'B' THEN saifi - saifi_tp END) AS fbx,
         max(CASE WHEN class = 'C' THEN saifi - saifi_tp END) AS fcx,
         max(CASE WHEN class = 'B' THEN ids_10a END) AS nb, max(CASE WHEN class = 'C' THEN ids_10a END) AS nc,
         sum(saidi_tp) AS tp, sum(saifi_tp) AS ftp
  FROM sums WHERE right(edb, 2) <> '02' GROUP BY edb, disc_yr
),
base AS (
  SELECT * FROM recorded UNION ALL SELECT * REPLACE (2022 AS disc_yr) FROM recorded WHERE disc_yr = 2024
),
reported AS (
  SELECT edb, disc_yr, 'B' AS class,
         CASE e WHEN 3 THEN abx WHEN 5 THEN ab * 0.9e0 WHEN 6 THEN ab * 1.2e0 WHEN 7 THEN ab * 0.8e0 ELSE ab END AS saidi,
         CASE e WHEN 3 THEN fbx WHEN 4 THEN fb * 1.3e0 WHEN 5 THEN fb * 0.9e0 WHEN 6 THEN fb * 1.2e0
                WHEN 7 THEN fb * 0.8e0 ELSE fb END AS saifi,
         CAST(CASE e WHEN 6 THEN nb + 10 ELSE nb END AS DOUBLE) AS n,
         CASE e WHEN 4 THEN nullif(fb, 0) END AS saifi_old, CASE e WHEN 10 THEN 2.5e0 END AS saidi_old
  FROM base WHERE ab IS NOT NULL OR fb IS NOT NULL OR nb IS NOT NULL
  UNION ALL
  SELECT edb, disc_yr, 'C',
         CASE e WHEN 3 THEN acx WHEN 5 THEN ac + ab * 0.1e0 WHEN 6 THEN ac * 1.2e0 WHEN 7 THEN ac * 0.8e0
                WHEN 8 THEN 5 WHEN 9 THEN 0 ELSE ac END,
         CASE e WHEN 3 THEN fcx WHEN 4 THEN fc * 1.3e0 WHEN 5 THEN fc + fb * 0.1e0 WHEN 6 THEN fc * 1.2e0
                WHEN 7 THEN fc * 0.8e0 WHEN 8 THEN 0.1e0 WHEN 9 THEN 0 ELSE fc END,
         CAST(CASE WHEN e IN (8, 9) THEN NULL WHEN e = 6 THEN nc + 10 ELSE nc END AS DOUBLE),
         CASE e WHEN 4 THEN nullif(fc, 0) END, NULL
  FROM base WHERE e IN (8, 9) OR ac IS NOT NULL OR fc IS NOT NULL OR nc IS NOT NULL
)
"""

_RECONCILED = f"""
WITH {RECORDS}, {_SUMS}, {_REPORTED},
sides AS (
  SELECT coalesce(s.edb, r.edb) AS edb, coalesce(s.disc_yr, r.disc_yr) AS disc_yr,
         coalesce(s.class, r.class) AS class, s.rows_10a, s.ids_10a, r.n AS n_s10,
         s.saidi AS a, r.saidi AS ra, s.saifi AS f, r.saifi AS rf, r.saifi_old AS old, s.saidi_tp AS tp
  FROM sums s
  FULL JOIN (SELECT * FROM reported WHERE disc_yr IN (SELECT disc_yr FROM sums)) r ON s.edb = r.edb AND s.disc_yr = r.disc_yr AND s.class = r.class
),
differing AS (
  SELECT sides.*,
         100 * (coalesce(a, 0) / nullif(ra, 0) - 1) AS da,
         100 * (coalesce(f, 0) / nullif(rf, 0) - 1) AS df,
         100 * (coalesce(f, 0) / nullif(old, 0) - 1) AS dold,
         100 * ((a - tp) / nullif(ra, 0) - 1) AS dtp,
         100 * (sum(coalesce(a, 0)) OVER bc / nullif(sum(ra) OVER bc, 0) - 1) AS bca,
         100 * (sum(coalesce(f, 0)) OVER bc / nullif(sum(rf) OVER bc, 0) - 1) AS bcf,
         coalesce(ids_10a, 0) - coalesce(n_s10, 0) AS more_ids,
         (SELECT max(base.tp) FROM base WHERE base.e = 3 AND base.edb = sides.edb
            AND base.disc_yr = sides.disc_yr) AS class_d
  FROM sides WINDOW bc AS (PARTITION BY edb, disc_yr)
)
SELECT edb, disc_yr, class, CASE WHEN class = 'B' THEN 'Planned' ELSE 'Unplanned' END AS interruption_type,
       rows_10a, ids_10a, n_s10,
       {_dbl('a', 4)} AS saidi_10a, {_dbl('ra', 4)} AS saidi_s10, {_dbl('da', 2)} AS saidi_diff_pct,
       {_dbl('f', 4)} AS saifi_10a, {_dbl('rf', 4)} AS saifi_s10, {_dbl('df', 2)} AS saifi_diff_pct,
       {_dbl('old', 4)} AS saifi_s10_transitional, {_dbl('dold', 2)} AS saifi_diff_vs_transitional_pct,
       {_dbl('tp', 4)} AS saidi_10a_transpower, {_dbl('class_d', 4)} AS saidi_s10_class_d,
       {_dbl('bca', 2)} AS saidi_bc_diff_pct, {_dbl('bcf', 2)} AS saifi_bc_diff_pct,
       CASE WHEN a IS NULL AND (ra IS NULL OR ra = 0) THEN 'Match (no interruptions of this class)'
            WHEN ra IS NULL THEN 'No Schedule 10 data for this EDB-year'
            WHEN a IS NULL THEN 'No 10a rows for this class'
            WHEN abs(da) <= 0.5 AND (df IS NULL OR abs(df) <= 0.5) THEN 'Match'
            WHEN tp > 0 AND abs(dtp) <= 0.5 THEN 'Mismatch: 10a includes Transpower (Class D) rows'
            WHEN abs(da) <= 0.5 AND abs(dold) <= 0.1
              THEN 'Mismatch: 10a SAIFI is on the old (transitional) counting basis'
            WHEN abs(bca) <= 0.5 AND abs(bcf) <= 0.5
              THEN 'Mismatch: B + C total matches, planned/unplanned split differs'
            WHEN da < -5 AND more_ids < 0 THEN 'Mismatch: 10a missing interruptions'
            ELSE 'Mismatch: unexplained' END AS verdict
FROM differing
"""

EVENT_SQL: dict[str, str] = {
    "record_errors": f"WITH {RECORDS} {_ALL_ERRORS}",
    **{f"err_{rule.lower()}": f"WITH {RECORDS} {_errors(rule)}" for rule in _RULES},
    "dated_records": f"""
WITH {RECORDS}
SELECT edb, disc_yr, row_num, ident AS interruption_identifier, start_at, end_at, mins AS duration_min,
       CAST(start_dy AS INTEGER) AS start_dy,
       CAST(CASE WHEN day(start_at) <= 12
         THEN year(start_at) + CASE WHEN day(start_at) >= 4 THEN 1 ELSE 0 END END AS INTEGER) AS swapped_dy,
       CAST(greatest(make_date(disc_yr - 1, 4, 1) - CAST(start_at AS DATE),
                     CAST(start_at AS DATE) - make_date(disc_yr, 3, 31), 0) AS INTEGER) AS days_outside_dy
FROM rec
""",
    "distinct_records": f"""
WITH {RECORDS}
SELECT edb, disc_yr, row_num, ident AS interruption_identifier, feeder, cause FROM once
""",
    "reported_measures": f"""
WITH {RECORDS}, {_SUMS}, {_REPORTED}
SELECT edb, disc_yr, class, saidi AS saidi_s10, saifi AS saifi_s10, n AS n_s10,
       saidi_old AS saidi_s10_transitional, saifi_old AS saifi_s10_transitional
FROM reported
UNION ALL
SELECT edb, disc_yr, 'D', tp, ftp, NULL, NULL, NULL FROM base WHERE e = 3
""",
    "record_errors_summary": f"""
WITH {RECORDS}, errors AS ({_ALL_ERRORS}),
totals AS (SELECT edb, disc_yr, count(*) AS total_rows FROM rec GROUP BY ALL)
SELECT edb, disc_yr, check_name, count(*) AS rows_affected, total_rows,
       ((20000 * count(*) + total_rows) // (2 * total_rows)) / 100 AS pct_rows,
       min(detail) AS example_detail
FROM errors JOIN totals USING (edb, disc_yr) GROUP BY edb, disc_yr, check_name, total_rows
""",
    "record_measures": f"""
WITH {RECORDS}, {_SUMS}
SELECT edb, disc_yr, class, rows_10a, ids_10a, saidi AS saidi_10a, saifi AS saifi_10a,
       saidi_tp AS saidi_10a_transpower, saifi_tp AS saifi_10a_transpower FROM sums
""",
    "reconcile": _RECONCILED,
    "reconcile_verdicts": f"SELECT verdict, count(*) AS n FROM ({_RECONCILED}) GROUP BY verdict",
    "constraint_not_null": f"""
SELECT 'record_errors' AS result, 'check_name' AS column_name, count(*) AS n_failing
FROM (WITH {RECORDS} {_ALL_ERRORS}) WHERE check_name IS NULL
UNION ALL
SELECT 'reconcile', 'verdict', count(*) FROM ({_RECONCILED}) WHERE verdict IS NULL
UNION ALL
SELECT 'records', 'interruption_identifier', count(*) FROM (WITH {RECORDS} SELECT * FROM rec) WHERE ident IS NULL
""",
    "constraint_accepted_values": f"""
SELECT 'record_errors' AS result, 'check_name' AS column_name,
       count(DISTINCT check_name) AS n_unexpected
FROM (WITH {RECORDS} {_ALL_ERRORS}) WHERE check_name NOT IN ({", ".join(repr(r) for r in _RULES)})
UNION ALL
SELECT 'reconcile', 'class', count(DISTINCT class) FROM ({_RECONCILED}) WHERE class NOT IN ('B', 'C')
UNION ALL
SELECT 'records', 'planned_or_unplanned', count(DISTINCT kind) FROM (WITH {RECORDS} SELECT * FROM rec)
WHERE kind NOT IN ('Planned', 'Unplanned')
""",
}
