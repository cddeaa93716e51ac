"""Pieces of the checking SQL. They follow the definitions, not the Spark code."""

from __future__ import annotations

from tallybrook.schemas import RECORD_COLUMNS

RECORD = ", ".join(RECORD_COLUMNS)

_VERSIONS = """
ev AS (
  SELECT event_id, user_id, event_type, value, event_id // 3 AS q,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         CAST(floor(epoch(ts)) AS BIGINT) AS ep
  FROM events
),
versions AS (
  SELECT event_id, event_type,
    CASE WHEN event_id % 97 <> 0 THEN q END AS question_id,
    CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN '   '
         WHEN event_id % 107 = 0 THEN '???' ELSE text END AS title,
    'https://q.example/' || event_id AS link,
    CASE WHEN q % 113 <> 0 THEN ep END AS creation_date,
    CASE WHEN k % 10 <> 3 AND q % 113 <> 0 THEN ep + k * 60 END AS last_activity_date,
    event_type IN ('purchase', 'signup') AS is_answered,
    CASE WHEN k <> 7 THEN CAST(floor(value / 4) AS BIGINT) - 5 END AS score,
    CASE WHEN k <> 8 THEN user_id % 6 END AS answer_count,
    CASE WHEN k <> 9 THEN CAST(floor(value * 6) AS BIGINT) END AS view_count,
    CASE WHEN k % 4 <> 0 THEN 'CC BY-SA 4.0' END AS content_license,
    CASE WHEN event_type = 'error' THEN ep + (k - 20) * 1800 END AS closed_date,
    CASE WHEN event_type = 'error' THEN 'Duplicate' END AS closed_reason,
    user_id AS owner_user_id,
    'user_' || user_id AS owner_display_name
  FROM ev JOIN documents d ON d.doc_id = ev.event_id % (SELECT count(*) FROM documents)
)"""

_RAW = _VERSIONS + f""",
raw AS (SELECT {RECORD} FROM versions)"""

_DEDUP = _RAW + """,
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY question_id
    ORDER BY coalesce(last_activity_date, creation_date) DESC NULLS LAST,
             creation_date DESC NULLS LAST, link DESC) AS rn
  FROM raw
)"""

HAS_TEXT = r"regexp_matches(title, '[^\s\p{Z}\x{0B}\x{85}]')"
CLEAN_TITLE = r"trim(regexp_replace(regexp_replace(title, '[^A-Za-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def ts(seconds: str) -> str:
    return f"(TIMESTAMP '1970-01-01 00:00:00' + to_seconds({seconds}))"


ENGAGEMENT = """CASE
    WHEN coalesce(view_count, 0) >= 1000 OR coalesce(answer_count, 0) >= 5 THEN 'HIGH_ENGAGEMENT'
    WHEN coalesce(score, 0) >= 5 THEN 'POSITIVE'
    WHEN coalesce(score, 0) < 0 THEN 'NEGATIVE'
    ELSE 'NEUTRAL' END"""

_USABLE = _DEDUP + f""",
usable AS (
  SELECT {RECORD} FROM ranked
  WHERE rn = 1 AND question_id IS NOT NULL AND title IS NOT NULL AND {HAS_TEXT}
)"""

_SILVER = _USABLE + f""",
silver AS (
  SELECT u.question_id,
    {CLEAN_TITLE} AS title_clean,
    u.link,
    {ts("u.creation_date")} AS created_ts,
    CAST({ts("u.creation_date")} AS DATE) AS created_date,
    {ts("u.last_activity_date")} AS last_activity_ts,
    CAST({ts("u.last_activity_date")} AS DATE) AS last_activity_date,
    {ts("u.closed_date")} AS closed_ts,
    CAST({ts("u.closed_date")} AS DATE) AS closed_date,
    u.closed_date IS NOT NULL AS is_closed,
    u.is_answered,
    coalesce(u.score, 0) AS score_filled,
    coalesce(u.answer_count, 0) AS answer_count_filled,
    coalesce(u.view_count, 0) AS view_count_filled,
    u.content_license, u.closed_reason, u.owner_user_id, u.owner_display_name,
    {ENGAGEMENT} AS sentiment,
    date_sub('hour', {ts("u.creation_date")}, {ts("u.closed_date")}) AS hours_to_close
  FROM usable u
)"""

_DAILY = _SILVER + """,
daily AS (
  SELECT created_date AS report_date, sentiment, count(*) AS post_count,
    avg(score_filled) AS avg_score, avg(view_count_filled) AS avg_views,
    avg(answer_count_filled) AS avg_answers,
    avg(CAST(is_answered AS BIGINT)) AS answered_rate,
    avg(CAST(is_closed AS BIGINT)) AS closed_rate,
    avg(hours_to_close) AS avg_hours_to_close
  FROM silver GROUP BY ALL
)"""

_GOLD = _DAILY + """,
windowed AS (
  SELECT *,
    CAST(sum(post_count) OVER (PARTITION BY sentiment ORDER BY report_date NULLS FIRST
      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling_7d_post_count,
    lag(post_count) OVER (PARTITION BY sentiment ORDER BY report_date NULLS FIRST) AS prev_post_count
  FROM daily
),
gold AS (
  SELECT * EXCLUDE (prev_post_count),
    (post_count - prev_post_count) / nullif(prev_post_count, 0) * 100 AS day_over_day_change_pct
  FROM windowed
)"""

# Records as normalisation leaves them, and those that pass the contract.
_RECORDS = _VERSIONS + """,
records AS (
  SELECT * REPLACE (
    coalesce(last_activity_date, creation_date) AS last_activity_date,
    coalesce(score, 0) AS score, coalesce(answer_count, 0) AS answer_count,
    coalesce(view_count, 0) AS view_count),
    concat_ws('; ',
      CASE WHEN question_id IS NULL THEN 'question_id:missing' END,
      CASE WHEN title IS NULL THEN 'title:missing' END,
      CASE WHEN creation_date IS NULL THEN 'creation_date:missing' END) AS issues,
    concat_ws('; ', nullif(issues, ''),
      CASE WHEN coalesce(last_activity_date, creation_date) IS NULL THEN 'last_activity_date:missing' END
    ) AS missing
  FROM versions
)"""

# Hour folder of a record; undated records take the fixed fallback time.
FALLBACK = 1700000000


def hour_columns(seconds: str = f"coalesce(creation_date, {FALLBACK})") -> str:
    t = ts(seconds)
    return (
        f"CAST(year({t}) AS VARCHAR) AS year, lpad(CAST(month({t}) AS VARCHAR), 2, '0') AS month, "
        f"lpad(CAST(day({t}) AS VARCHAR), 2, '0') AS day, lpad(CAST(hour({t}) AS VARCHAR), 2, '0') AS hour"
    )


HOUR_PATH = "'year=' || year || '/month=' || month || '/day=' || day || '/hour=' || hour"
_LAKE = _VERSIONS + f""",
lake AS (SELECT event_id, event_type, {RECORD}, {hour_columns()} FROM versions)"""


def _json_member(name: str, value: str) -> str:
    return f"""'"{name}":' || {value}"""


def json_object(nulls: bool = False) -> str:
    """The record columns as JSON text, in order, with or without nulls."""
    members = []
    for c in RECORD_COLUMNS:
        value = f"CAST(to_json({c}) AS VARCHAR)"
        members.append(_json_member(c, f"coalesce({value}, 'null')" if nulls else value))
    return "'{' || concat_ws(',', " + ", ".join(members) + ") || '}'"


_ENVELOPES = _RECORDS + f""",
delivered AS (
  SELECT r.*, {json_object()} AS record_json
  FROM records r, range(CASE WHEN event_id % 11 = 0 THEN 2 ELSE 1 END)
),
enveloped AS (
  SELECT *,
    CASE WHEN event_id % 13 = 0 THEN '' WHEN event_id % 19 = 0 THEN '*bad'
         ELSE to_base64(encode(record_json)) END AS data,
    CASE WHEN event_id % 23 <> 0 THEN CAST(event_id AS VARCHAR) END AS given_id,
    event_id % 17 = 0 AS junk
  FROM delivered
),
messages AS (
  SELECT *,
    CASE WHEN junk THEN 'junk'
         ELSE '{{"message":{{"data":"' || data || '"' || coalesce(',"messageId":"' || given_id || '"', '') || '}}}}'
    END AS value,
    CASE WHEN junk THEN 'ack_no_message' WHEN data = '' THEN 'ack_no_data'
         WHEN data = '*bad' THEN 'failed' WHEN missing <> '' THEN 'dead' ELSE 'stored' END AS outcome
  FROM enveloped
),
identified AS (
  SELECT *, CASE WHEN junk OR given_id IS NULL THEN 'no-id-' || sha256(value) ELSE given_id END AS message_id
  FROM messages
)"""


def _with(ctes: str):
    def build(body: str) -> str:
        return "WITH " + ctes.strip() + "\n" + body

    return build


on_versions = _with(_VERSIONS)
on_raw = _with(_RAW)
on_dedup = _with(_DEDUP)
on_usable = _with(_USABLE)
on_silver = _with(_SILVER)
on_daily = _with(_DAILY)
on_gold = _with(_GOLD)
on_records = _with(_RECORDS)
on_messages = _with(_ENVELOPES)
on_lake = _with(_LAKE)
