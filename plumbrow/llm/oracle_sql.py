"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NO_SPACE = r"[^\x20\x09-\x0D]+"
_EDGES = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def _lowered(text: str) -> str:
    return f"translate({text}, '{ascii_uppercase}', '{ascii_lowercase}')"


LINES = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS n FROM split),
keyed AS (SELECT *, {_lowered(f"regexp_replace(line, '{_EDGES}', '', 'g')")} AS k FROM lines),
shared AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (first <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n)
                       FILTER (first IS NULL OR first = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (k) GROUP BY doc_id
"""

CONTAMINATION = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_lowered("coalesce(text, '')")}, '{_WORD}') AS w FROM documents
),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all({_lowered("coalesce(text, '')")}, '{_WORD}') AS w FROM benchmark
),
windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + 12], ' ') AS x
  FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM b WHERE len(w) > 0)
),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM d, (SELECT DISTINCT n FROM windows))
),
hits AS (SELECT DISTINCT doc_id, i, n, item FROM places JOIN windows USING (n, x)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_NO_SPACE}') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS x
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d)
),
judged AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY x) < doc_id AS later FROM windows),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS p FROM judged WHERE later
),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (
  SELECT words.doc_id, count(gone.p) AS n_removed,
         string_agg(word, ' ' ORDER BY words.p) FILTER (gone.p IS NULL) AS text
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


#: crc32 of single bytes, by its rule (reflected polynomial EDB88320).
def _crc_table() -> list[int]:
    table = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    return table


def _crc32(text: str) -> str:
    """Of a column of ASCII text."""
    step = f"xor(({_crc_table()})[CAST(xor(c, b) & 255 AS INT) + 1], c >> 8)"
    given = f"list_prepend(4294967295, list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT)))"
    return f"xor(list_reduce({given}, lambda c, b: {step}), 4294967295)"


# States as in turns.py: nothing yet, after the system, the user, the assistant.
_AFTER = (2, 2, 3, 2)
_SAYS = {2: "user", 3: "assistant"}
_KEPT = {0: ("s", 1, "u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}


def _choice(cost: str, letters: str, text: str) -> str:
    return f"{{'c': {cost}, 'a': {letters}, 't': {text}}}"


def _of_row(q: int) -> str:
    """The best of Keep, Rerole and Delete of row r in state q, given b0 to b3 after it."""
    n = _AFTER[q]
    late = "CASE WHEN late THEN 3 ELSE 0 END"
    never = "CASE WHEN may_stay THEN 0 ELSE 1000000 END"
    options = [
        _choice(f"b{q}.c + 4", f"'D' || b{q}.a", f"b{q}.t"),
        _choice(f"b{n}.c + 3 + {late} + {never}", f"'R' || b{n}.a",
                f"chr(10) || '{_SAYS[n]}:' || r.text || b{n}.t"),
    ]
    kept = _KEPT[q]
    for initial, k in zip(kept[::2], kept[1::2]):
        unfit = f"CASE WHEN left(r.role, 1) = '{initial}' THEN 0 ELSE 1000000 END"
        options.append(
            _choice(f"b{k}.c + {late} + {never} + {unfit}", f"'K' || b{k}.a",
                    f"chr(10) || r.role || ':' || r.text || b{k}.t")
        )
    return f"list_sort([{', '.join(options)}])[1] AS p{q}"


def _with_inserts(q: int) -> str:
    options, state, said = [f"p{q}"], q, ""
    for k in range(1, 4):
        state = _AFTER[state]
        said += f"chr(10) || '{_SAYS[state]}:' || "
        options.append(_choice(f"p{state}.c + {3 * k}", f"'{'I' * k}' || p{state}.a", f"{said}p{state}.t"))
    return f"list_sort([{', '.join(options)}])[1] AS b{q}"


_USER, _ASSISTANT = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
CONVERSATIONS = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20
           AS kind
  FROM conversations
),
rows AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END
           AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM keyed WHERE kind <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i
  FROM rows
),
faults AS (
  SELECT *, NOT regexp_matches(text, '{_NO_SPACE}') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS late,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM placed
),
flagged AS (SELECT *, NOT blank AND NOT seen AS may_stay FROM faults),
totals AS (
  SELECT conv_id, count(*) AS n, count(*) FILTER (blank) AS blank,
         count(*) FILTER (seen AND NOT blank) AS duplicate,
         count(*) FILTER (late AND may_stay) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM flagged GROUP BY conv_id
),
best AS (
  SELECT conv_id, n + 1 AS i, {_choice("0", "''", "''")} AS b0,
         {_choice("6", "'II'", f"{_USER} || {_ASSISTANT}")} AS b1,
         {_choice("3", "'I'", _ASSISTANT)} AS b2, {_choice("0", "''", "''")} AS b3
  FROM totals
  UNION ALL
  SELECT conv_id, i, {", ".join(_with_inserts(q) for q in range(4))}
  FROM (
    SELECT r.conv_id, r.i, {", ".join(_of_row(q) for q in range(4))}
    FROM best JOIN flagged r ON r.conv_id IS NOT DISTINCT FROM best.conv_id AND r.i = best.i - 1
  )
)
SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(b0.c, 0) AS BIGINT) AS cost, coalesce(b0.a, '') AS audit,
       sha256(coalesce(substr(b0.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) every
LEFT JOIN totals ON totals.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM every.conv_id AND best.i = 1
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RANKED = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_lowered("coalesce(text, '')")}, '{_TERM}') AS terms
  FROM documents
),
totals AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_lowered("coalesce(text, '')")}, '{_TERM}')) AS term
  FROM benchmark
),
tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM wanted) GROUP BY r, term
),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, totals GROUP BY term
),
m AS (SELECT r, doc_id, 100 - 90 + (90 * len(terms) * n_docs) // n_terms AS m FROM d, totals WHERE len(terms) > 0),
scored AS (
  SELECT item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM tf JOIN w USING (term) JOIN m USING (r) JOIN wanted USING (term) GROUP BY item_id, doc_id, r
),
placed AS (
  SELECT item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""

NEAR_SETS = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_lowered("coalesce(text, '')")}, '{_NO_SPACE}') AS w FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w
         ELSE list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) END
           AS s
  FROM d
),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM members a JOIN members b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
reached AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other
),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (doc_id)
"""

SQL = {
    "op2_lines": LINES,
    "op6_decontamination": CONTAMINATION,
    "op8_substrings": SUBSTRINGS,
    "op11_search": RANKED,
    "op12_near_sets": NEAR_SETS,
    "op13_conversations": CONVERSATIONS,
}
