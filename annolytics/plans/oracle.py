"""DuckDB twins of the registered queries (``oracle_sql()``).

Only the raw parquet tables are registered in the checker, so the derived
views are inlined as CTEs.  These texts are written independently of the
Spark code (windows where Spark uses aggregates, grids where Spark uses
algebra) so that agreement means something.
"""

from __future__ import annotations

# Annotation view (FIXTURES B1), written in its direct form.
ANN = """
WITH nd AS (SELECT count(*) AS n FROM documents),
ev AS (
  SELECT event_id, user_id, ts, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         (event_id * event_id * 31 + user_id * 17) % nd.n AS doc_id
  FROM events CROSS JOIN nd),
ann AS (
  SELECT ev.event_id AS annotation_id,
         concat('U', lpad(CAST(ev.user_id % 25 AS VARCHAR), 2, '0')) AS student_code,
         CASE WHEN ev.event_id % 101 = 0 THEN NULL ELSE d.source END AS source_file,
         d.text AS text,
         CASE WHEN ev.event_id % 89 = 0 THEN 'n/a' ELSE concat(CAST(ev.k % 5 + 1 AS VARCHAR), '-label') END AS label_text,
         CASE WHEN ev.event_id % 89 = 0 THEN NULL ELSE ev.k % 5 + 1 END AS label_numeric,
         strftime(ev.ts, '%Y-%m-%d %H:%M:%S.%f') AS annotation_created_at,
         CASE WHEN ev.event_id % 97 = 0 THEN NULL ELSE ev.value * (1 + ev.user_id % 25) / 12.0E0 END AS lead_time_seconds
  FROM ev JOIN documents d ON d.doc_id = ev.doc_id)"""

# Cleaning chain on the view: hold-out (U07; U03 with SRC1 in the source),
# column selection, duplicate resolution (window form), length >= 50,
# annotators with mean lead < 80 s removed (registry.DRIVER_MIN_MEAN_LEAD).
CLEAN = (
    ANN
    + """,
flag AS (
  SELECT *, coalesce(student_code = 'U07', false)
            OR coalesce(student_code = 'U03' AND regexp_matches(source_file, 'SRC1', 'i'), false) AS is_test
  FROM ann),
working AS (SELECT * EXCLUDE (is_test) FROM flag WHERE NOT is_test),
test AS (SELECT * EXCLUDE (is_test) FROM flag WHERE is_test),
selected AS (
  SELECT annotation_id, student_code, text, label_text, label_numeric,
         annotation_created_at AS labeled_at, lead_time_seconds
  FROM working),
dd AS (
  SELECT *, count(*) OVER w AS cnt, count(label_numeric) OVER w AS nl,
         min(label_numeric) OVER w AS mn, max(label_numeric) OVER w AS mx
  FROM selected WHERE text IS NOT NULL WINDOW w AS (PARTITION BY text)),
deduped AS (
  SELECT annotation_id, student_code, text, label_text, label_numeric, labeled_at, lead_time_seconds,
         CAST(length(text) AS INTEGER) AS text_length
  FROM dd
  QUALIFY row_number() OVER (
    PARTITION BY text
    ORDER BY CASE WHEN cnt = 2 AND nl = 2 AND mn = mx THEN 0 ELSE coalesce(lead_time_seconds, -1e308) END DESC,
             annotation_id) = 1),
long_enough AS (SELECT * FROM deduped WHERE text_length >= 50),
rushed AS (
  SELECT student_code, avg(lead_time_seconds) AS mean_lead_time, count(*) AS n_rows
  FROM long_enough GROUP BY student_code HAVING avg(lead_time_seconds) < 80),
train AS (
  SELECT * FROM long_enough l
  WHERE NOT EXISTS (SELECT 1 FROM rushed r WHERE r.student_code = l.student_code))"""
)

SQL: dict[str, str] = {}


def register(key: str, text: str) -> None:
    SQL[key] = text.strip()
