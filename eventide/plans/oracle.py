"""DuckDB SQL twins of the registered queries (the correctness oracle).

Only the driver tables are registered in DuckDB, so every statement starts with the
same derivation of ``content`` and ``engagement_events`` (FIXTURES.md F1/F2) and of
``enriched`` (F3, integer hundredths: DuckDB decimal division yields DOUBLE). Exact
values are computed in integers and cast at the end, like the Spark side computes in
DECIMAL, so both sides produce bit-identical results.
"""

from __future__ import annotations

from eventide.plans import params as P

UUID_RE = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"

CONTENT = """content AS (
  SELECT concat('00000000-0000-4000-8000-', lpad(CAST(p_partkey AS VARCHAR),12,'0')) AS content_id,
         concat(replace(lower(p_name),' ','-'),'-',CAST(p_partkey AS VARCHAR)) AS slug,
         p_name AS title,
         CASE p_partkey % 3 WHEN 0 THEN 'video' WHEN 1 THEN 'podcast' ELSE 'newsletter' END AS content_type,
         CAST(CASE WHEN p_partkey % 3 = 2 THEN NULL WHEN p_partkey % 30 = 0 THEN 0
                   ELSE p_size * 10 END AS INTEGER) AS length_seconds,
         make_timestamp(1704067200000000 + (p_partkey % 50) * 86400000000) AS publish_ts
  FROM part)"""

EVENTS = """raw_events AS (
  SELECT *, CAST(json_extract_string(props,'$.k') AS BIGINT) AS k FROM events),
engagement_events AS (
  SELECT event_id AS id,
         concat('00000000-0000-4000-8000-', lpad(CAST(
           CASE WHEN event_id % 19 = 0 THEN k + 900000000000
                WHEN event_id % 3 = 0 THEN k % (SELECT count(*) FROM part)
                ELSE (event_id * 7919 + k) % (SELECT count(*) FROM part) END AS VARCHAR),12,'0')) AS content_id,
         concat('00000000-0000-4000-9000-', lpad(CAST(user_id AS VARCHAR),12,'0')) AS user_id,
         CASE event_type WHEN 'view' THEN 'play' WHEN 'signup' THEN 'pause' WHEN 'purchase' THEN 'finish'
                         WHEN 'click' THEN 'click' ELSE 'error' END AS event_type,
         ts AS event_ts,
         CAST(CASE WHEN event_type='click' OR event_id % 97 = 0 THEN NULL
              WHEN event_id % 89 = 0 THEN 0
              ELSE CAST(round(value*1000) AS INT) + CAST(event_id % 10 AS INT) END AS INTEGER) AS duration_ms,
         CASE WHEN event_id % 53 = 0 THEN NULL
              ELSE CASE CAST(user_id % 6 AS INT) WHEN 0 THEN 'phone-a' WHEN 1 THEN 'phone-b' WHEN 2 THEN 'tablet'
                   WHEN 3 THEN 'desktop' WHEN 4 THEN 'television' ELSE 'speaker' END END AS device,
         CASE WHEN event_id % 2 = 0 THEN props ELSE
           '{"k": ' || k || ', "session_id": "s-' || user_id || '", "ip_address": "10.0.0.' || (user_id % 250)
           || '", "user_agent": "client/' || (event_id % 7) || '", "referrer": null, "screen_resolution": "'
           || (event_id % 5 + 1) || '00x600"}' END AS raw_payload
  FROM raw_events)"""

DEFECTS = """defect_events AS (
  SELECT * REPLACE (CASE WHEN id % 101 <> 0 THEN id END AS id,
                    CASE WHEN id % 103 <> 0 THEN event_ts END AS event_ts) FROM engagement_events
  UNION ALL
  SELECT * REPLACE (event_ts + INTERVAL 1 SECOND AS event_ts) FROM engagement_events WHERE id % 41 = 0)"""

# what a stream with defects and exact copies keeps: every original, and the copy of an
# original that has no id or no time to be matched by
STREAM_EVENTS = EVENTS.replace("engagement_events AS (", "sent_events AS (") + """,
engagement_events AS (
  SELECT * REPLACE (CASE WHEN id % 101 <> 0 THEN id END AS id,
                    CASE WHEN id % 103 <> 0 THEN event_ts END AS event_ts) FROM sent_events
  UNION ALL
  SELECT * FROM sent_events WHERE id % 41 = 0 AND (id % 101 = 0 OR id % 103 = 0))"""

CONTENT_DEFECTS = """numbered AS (SELECT *, CAST(substr(content_id, 25, 12) AS BIGINT) AS k FROM content),
content_defects AS (
  SELECT CASE WHEN k % 23 = 0 THEN 'x' || content_id ELSE content_id END AS content_id,
         CASE WHEN k % 29 <> 0 THEN slug END AS slug, CASE WHEN k % 31 <> 0 THEN title END AS title,
         CASE WHEN k % 37 = 0 THEN 'film' ELSE content_type END AS content_type, length_seconds, publish_ts,
         concat_ws(',', CASE WHEN k % 23 = 0 THEN 'invalid_content_id' END,
                   CASE WHEN k % 29 = 0 THEN 'missing_slug' END, CASE WHEN k % 31 = 0 THEN 'missing_title' END,
                   CASE WHEN k % 37 = 0 THEN 'invalid_content_type' END) AS reasons
  FROM numbered)"""

DENSE_TS = ("make_timestamp(1704067200000000 + (epoch_us(event_ts) - 1704067200000000) // 100)")


def _rules(strict: bool = True, alias: str = "e") -> list[tuple[str, str]]:
    a = alias
    rules = [
        ("missing_id", f"{a}.id IS NULL"),
        ("invalid_content_id", f"NOT coalesce(regexp_full_match({a}.content_id, '{UUID_RE}'), false)"),
        ("invalid_user_id", f"NOT coalesce(regexp_full_match({a}.user_id, '{UUID_RE}'), false)"),
        ("invalid_event_type",
         f"({a}.event_type IS NULL OR {a}.event_type NOT IN ('play','pause','finish','click'))"),
        ("invalid_event_ts", f"{a}.event_ts IS NULL"),
    ]
    if strict:
        rules.append(("missing_duration",
                      f"coalesce({a}.event_type IN ('play','pause','finish') AND {a}.duration_ms IS NULL, false)"))
    else:
        rules = [r for r in rules if r[0] in ("missing_id", "invalid_content_id",
                                               "invalid_user_id", "invalid_event_ts")]
    return rules


def _tagged(strict: bool = True, source: str = "engagement_events") -> str:
    """All events left-joined with content and a ``reasons`` string."""
    rules = _rules(strict) + [("content_not_found", "c.content_id IS NULL")]
    parts = ", ".join(f"CASE WHEN {cond} THEN '{code}' END" for code, cond in rules)
    return f"""tagged AS (
  SELECT e.*, c.slug, c.title, c.content_type, c.length_seconds,
         concat_ws(',', {parts}) AS reasons
  FROM {source} e LEFT JOIN content c ON e.content_id = c.content_id)"""


def _enriched(strict: bool = True, source: str = "engagement_events", name: str = "enriched") -> str:
    """F3 with the full rule set; stream rounding (HALF_EVEN) in integer hundredths."""
    return f"""{_tagged(strict, source).replace('tagged AS', f'{name}_t AS', 1)},
{name}_c1 AS (
  SELECT * EXCLUDE (reasons),
         CASE WHEN duration_ms % 10 > 5 OR (duration_ms % 10 = 5 AND (duration_ms // 10) % 2 = 1)
              THEN duration_ms // 10 + 1 ELSE duration_ms // 10 END AS es_cents
  FROM {name}_t WHERE reasons = ''
), {name}_c2 AS (
  SELECT *, CASE WHEN length_seconds > 0 THEN
              CASE WHEN 2*((es_cents*100) % length_seconds) > length_seconds
                     OR (2*((es_cents*100) % length_seconds) = length_seconds
                         AND ((es_cents*100) // length_seconds) % 2 = 1)
                   THEN (es_cents*100) // length_seconds + 1
                   ELSE (es_cents*100) // length_seconds END END AS pct_cents
  FROM {name}_c1
), {name} AS (
  SELECT id, content_id, user_id, event_type, event_ts, duration_ms, device, raw_payload,
         slug, title, content_type, length_seconds,
         CAST(CAST(es_cents AS DECIMAL(14,0)) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS engagement_seconds,
         CAST(CAST(pct_cents AS DECIMAL(14,0)) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS engagement_pct
  FROM {name}_c2)"""


DENSE_EVENTS = f"""dense_events AS (
  SELECT * REPLACE ({DENSE_TS} AS event_ts) FROM engagement_events)"""

# score in units of 1e-5 (base in tenths x (1 + min(pct,100 %)) in 1e-4)
SCORE_UNITS = ("CASE event_type WHEN 'play' THEN 10 WHEN 'pause' THEN 5 WHEN 'finish' THEN 30 "
               "WHEN 'click' THEN 3 ELSE 0 END * (10000 + least(coalesce(CAST(engagement_pct*100 AS BIGINT),0),10000))")


def _with(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _std(*extra: str, strict: bool = True) -> tuple[str, ...]:
    return (CONTENT, EVENTS, _enriched(strict), *extra)


def _dense(*extra: str) -> tuple[str, ...]:
    return (CONTENT, EVENTS, DENSE_EVENTS, _enriched(True, "dense_events", "enriched"), *extra)


def _ts(v: str) -> str:
    return f"TIMESTAMP '{v}'"


def _iso(col: str) -> str:
    return (f"CASE WHEN epoch_us({col}) % 1000000 = 0 THEN strftime({col}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({col}, '%Y-%m-%dT%H:%M:%S.%f') END")


def _nz(col: str) -> str:
    return f"CASE WHEN {col} <> 0 THEN {col} END"


def _avg(col: str) -> str:
    return f"CAST(sum({col}) AS DOUBLE) / nullif(count({col}), 0)"


FACT = """fact AS (
  SELECT id AS event_id, content_id, user_id, event_type, event_ts AS event_timestamp, duration_ms,
         CASE WHEN engagement_seconds <> 0 THEN engagement_seconds END AS engagement_seconds,
         CASE WHEN engagement_pct <> 0 THEN engagement_pct END AS engagement_pct,
         device, slug AS content_slug, title AS content_title, content_type,
         length_seconds AS content_length_seconds, raw_payload, CAST(event_ts AS DATE) AS event_date
  FROM enriched)"""


def _top_content_body(source: str, k: int) -> str:
    return f"""SELECT content_id,
       CAST(sum({SCORE_UNITS}) AS DOUBLE)/100000 AS score,
       count(*) AS total_events,
       count(DISTINCT user_id) AS unique_users,
       coalesce(CAST(sum(engagement_seconds) AS DOUBLE),0) AS total_engagement_seconds
FROM {source} GROUP BY content_id HAVING score > 0
ORDER BY score DESC, content_id DESC LIMIT {k}"""


def _trailing(col: str, as_of: str, amount: int, unit: str) -> str:
    return f"{col} > {_ts(as_of)} - INTERVAL {amount} {unit} AND {col} <= {_ts(as_of)}"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["enriched"] = _with(*_std(), body="SELECT * FROM enriched")
    q["quarantine"] = _with(CONTENT, EVENTS, DEFECTS, _tagged(True, "defect_events"), body="""
SELECT id, content_id, user_id, event_type, event_ts, duration_ms, device, raw_payload, reasons
FROM tagged WHERE reasons <> ''""")
    q["enriched_view"] = _with(CONTENT, EVENTS, body="""
SELECT e.id, e.content_id, c.slug, c.title, c.content_type, c.length_seconds, e.user_id, e.event_type,
       e.event_ts, e.duration_ms,
       CAST(CAST(CASE WHEN e.duration_ms % 10 >= 5 THEN e.duration_ms // 10 + 1 ELSE e.duration_ms // 10 END
            AS DECIMAL(14,0)) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS engagement_seconds,
       CASE WHEN c.length_seconds > 0 AND e.duration_ms IS NOT NULL THEN
         CAST(CAST((20*CAST(e.duration_ms AS BIGINT) + c.length_seconds) // (2*c.length_seconds)
              AS DECIMAL(14,0)) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(18,2)) END AS engagement_pct,
       e.device, e.raw_payload
FROM engagement_events e LEFT JOIN content c ON e.content_id = c.content_id""")
    q["top_content"] = _with(*_std(), body=_top_content_body("enriched", P.TOP_K_FLAGSHIP))
    q["content_scores"] = _with(*_std(), body=f"""
SELECT content_id, CAST(sum({SCORE_UNITS}) AS DOUBLE)/100000 AS score
FROM enriched GROUP BY content_id HAVING score > 0""")
    q["content_stats"] = _with(*_std(), body=f"""
SELECT content_id, arg_max(slug, event_ts) AS slug, arg_max(title, event_ts) AS title,
       arg_max(content_type, event_ts) AS content_type,
       count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
       coalesce(CAST(sum({_nz('engagement_seconds')}) AS DOUBLE), 0) AS total_engagement_seconds,
       {_avg(_nz('engagement_pct'))} AS avg_engagement_pct,
       max(event_ts) AS last_updated
FROM enriched GROUP BY content_id""")
    q["content_meta"] = _with(*_std(), body="""
SELECT content_id, arg_max(slug, event_ts) AS slug, arg_max(title, event_ts) AS title,
       arg_max(content_type, event_ts) AS content_type, max(event_ts) AS last_updated
FROM enriched GROUP BY content_id""")
    win = _trailing("event_ts", P.DENSE_AS_OF, P.WINDOW_MINUTES, "MINUTE")
    q["stats_card"] = _with(*_dense(), body=f"""
SELECT c.content_id,
       CAST(coalesce(a.total_events, 0) AS BIGINT) AS total_events,
       CAST(coalesce(a.unique_users, 0) AS BIGINT) AS unique_users,
       coalesce(a.es, 0) AS total_engagement_seconds,
       CAST(coalesce(a.events_in_window, 0) AS BIGINT) AS events_in_window,
       {P.WINDOW_MINUTES} AS window_minutes
FROM content c LEFT JOIN (
  SELECT content_id, count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
         CAST(sum({_nz('engagement_seconds')}) AS DOUBLE) AS es,
         count(DISTINCT CASE WHEN {win} THEN id END) AS events_in_window
  FROM enriched GROUP BY content_id) a ON c.content_id = a.content_id""")
    q["windowed_counts"] = _with(*_dense(), body=f"""
SELECT content_id, count(DISTINCT id) AS events_in_window
FROM enriched WHERE {win} GROUP BY content_id""")
    q["windowed_top_content"] = _with(*_dense(), f"recent AS (SELECT * FROM enriched WHERE {win})",
                                      body=_top_content_body("recent", P.TOP_K))
    q["recent_events"] = _with(*_std(), body=f"""
SELECT content_id, id AS event_id, user_id, event_type, {_iso('event_ts')} AS timestamp,
       CAST({_nz('engagement_seconds')} AS DOUBLE) AS engagement_seconds,
       CAST({_nz('engagement_pct')} AS DOUBLE) AS engagement_pct, device,
       CAST(row_number() OVER (PARTITION BY content_id ORDER BY event_ts DESC, id DESC) AS INTEGER) AS position
FROM enriched QUALIFY position <= {P.RECENT_N}""")
    q["event_cache"] = _with(*_std(), body=f"""
SELECT id AS event_id, content_id, user_id, event_type, {_iso('event_ts')} AS timestamp,
       coalesce(duration_ms, 0) AS duration_ms,
       coalesce(CAST(engagement_seconds AS DOUBLE), 0.0) AS engagement_seconds,
       coalesce(CAST(engagement_pct AS DOUBLE), 0.0) AS engagement_pct,
       coalesce(device, '') AS device, slug AS content_slug, title AS content_title, content_type
FROM enriched WHERE {_trailing('event_ts', P.AS_OF, P.CACHE_HOURS, 'HOUR')}""")
    completions = "CAST(sum(CASE WHEN event_type = 'finish' THEN 1 ELSE 0 END) AS BIGINT)"
    q["engagement_stats"] = _with(*_std(FACT), body=f"""
SELECT content_type, content_slug, content_title, count(*) AS total_events,
       count(DISTINCT user_id) AS unique_users,
       {_avg('engagement_seconds')} AS avg_engagement_seconds,
       {_avg('engagement_pct')} AS avg_engagement_pct,
       {completions} AS completion_count
FROM fact WHERE event_date BETWEEN DATE '{P.STATS_START}' AND DATE '{P.STATS_END}'
GROUP BY content_type, content_slug, content_title
ORDER BY total_events DESC, content_slug LIMIT {P.STATS_LIMIT}""")
    q["top_content_lookback"] = _with(*_std(FACT), body=f"""
SELECT content_id, content_slug, content_title, content_type, count(*) AS total_events,
       count(DISTINCT user_id) AS unique_users,
       {_avg('engagement_pct')} AS avg_engagement_pct,
       coalesce(CAST(sum(engagement_seconds) AS DOUBLE), 0) AS total_engagement_seconds,
       {completions} AS completions
FROM fact WHERE event_timestamp >= {_ts(P.AS_OF)} - INTERVAL {P.LOOKBACK_HOURS} HOUR
GROUP BY content_id, content_slug, content_title, content_type
ORDER BY total_events DESC, avg_engagement_pct DESC NULLS LAST, content_id LIMIT {P.TOP_K}""")
    daily = f"""
SELECT event_date, content_type, count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
       count(DISTINCT content_id) AS unique_content,
       {_avg('engagement_seconds')} AS avg_engagement_seconds,
       {_avg('engagement_pct')} AS avg_engagement_pct,
       {completions} AS total_completions
FROM fact {{where}} GROUP BY event_date, content_type"""
    q["daily_summary"] = _with(*_std(FACT), body=daily.format(where=""))
    q["daily_summary_recent"] = _with(*_std(FACT), body=daily.format(
        where=f"WHERE event_date >= CAST({_ts(P.AS_OF)} AS DATE) - INTERVAL {P.RECENT_DAYS} DAY"))
    q["hourly_trends"] = _with(*_std(FACT), body=f"""
SELECT date_trunc('hour', event_timestamp) AS hour_bucket, content_type, event_type,
       count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
       {_avg('engagement_seconds')} AS avg_engagement_seconds
FROM fact WHERE event_timestamp >= {_ts(P.AS_OF)} - INTERVAL {P.RECENT_DAYS} DAY
GROUP BY 1, 2, 3""")
    q["window_stats"] = _with(CONTENT, EVENTS, body=f"""
SELECT count(*) AS total_events, count(DISTINCT content_id) AS unique_content,
       count(DISTINCT user_id) AS unique_users, max(event_ts) AS last_event
FROM engagement_events WHERE event_ts >= {_ts(P.AS_OF)} - INTERVAL 60 MINUTE""")
    q["freshness"] = _with(CONTENT, EVENTS, body=f"""
SELECT count(*) AS recent_events, max(event_ts) AS last_event
FROM engagement_events WHERE event_ts >= {_ts(P.AS_OF)} - INTERVAL {P.FRESHNESS_MINUTES} MINUTE""")
    q["today_count"] = _with(*_std(FACT), body=f"""
SELECT count(*) AS today_events FROM fact WHERE event_date = CAST({_ts(P.TODAY_AS_OF)} AS DATE)""")
    q["event_count"] = _with(CONTENT, EVENTS, body="SELECT count(*) AS total_rows FROM engagement_events")
    q["overview"] = _with(*_std(), f"top AS ({_top_content_body('enriched', P.OVERVIEW_TOP)})", body=f"""
SELECT 'window_stats' AS section, CAST(NULL AS INTEGER) AS rank,
       count(*) AS events_last_hour, count(DISTINCT content_id) AS unique_content_last_hour,
       count(DISTINCT user_id) AS unique_users_last_hour, max(event_ts) AS last_event
FROM engagement_events WHERE event_ts >= {_ts(P.AS_OF)} - INTERVAL 60 MINUTE
UNION ALL BY NAME
SELECT * FROM (
  SELECT 'top_content' AS section,
         CAST(row_number() OVER (ORDER BY score DESC, content_id DESC) AS INTEGER) AS rank,
         content_id, score, total_events, unique_users, total_engagement_seconds
  FROM top) WHERE rank <= {P.OVERVIEW_SHOW}""")
    q["error_rate_alerts"] = _with(CONTENT, EVENTS, DEFECTS, _tagged(True, "defect_events"), body=f"""
SELECT window_start, window_start + INTERVAL {P.ALERT_MINUTES} MINUTE AS window_end,
       total_events, rejected_events, CAST(rejected_events AS DOUBLE) / total_events AS error_rate
FROM (
  SELECT make_timestamp((epoch_us(event_ts) // {P.ALERT_MINUTES * 60_000_000}) * {P.ALERT_MINUTES * 60_000_000}) AS window_start,
         count(*) AS total_events,
         CAST(sum(CASE WHEN reasons <> '' THEN 1 ELSE 0 END) AS BIGINT) AS rejected_events
  FROM tagged GROUP BY 1)
WHERE CAST(rejected_events AS DOUBLE) / total_events > {P.ALERT_THRESHOLD}""")
    q["quality_report"] = _with(CONTENT, EVENTS, DEFECTS, _tagged(True, "defect_events"),
                                body=_quality_body())
    q["anomaly_flags"] = _with(*_std(), body=f"""
SELECT e.*, c.publish_ts, coalesce(duration_ms < 0, false) AS negative_duration,
       coalesce(engagement_pct > 100, false) AS pct_over_100,
       coalesce(duration_ms = 0, false) AS zero_duration,
       coalesce(event_ts > {_ts(P.AS_OF)}, false) AS future_event,
       coalesce(event_ts < c.publish_ts, false) AS before_publish
FROM enriched e JOIN content c ON e.content_id = c.content_id""")
    q["warehouse_records"] = _with(*_std(), body=f"""
SELECT id AS event_id, content_id, user_id, event_type, event_ts AS event_timestamp, duration_ms,
       CAST({_nz('engagement_seconds')} AS DOUBLE) AS engagement_seconds,
       CAST({_nz('engagement_pct')} AS DOUBLE) AS engagement_pct,
       device, slug AS content_slug, title AS content_title, content_type,
       length_seconds AS content_length_seconds, raw_payload
FROM enriched""")
    q["external_payload"] = _with(*_std(), body=f"""
SELECT id AS event_id, content_id, user_id, event_type, {_iso('event_ts')} AS timestamp,
       title AS content_title, content_type, device,
       CAST({_nz('engagement_seconds')} AS DOUBLE) AS engagement_seconds,
       CAST({_nz('engagement_pct')} AS DOUBLE) AS engagement_pct, raw_payload
FROM enriched""")
    q["sliding_counts"] = _with(*_dense(), f"""expanded AS (
  SELECT e.*, time_bucket(INTERVAL 1 MINUTE, e.event_ts) - o.k * INTERVAL 1 MINUTE AS window_start
  FROM enriched e CROSS JOIN (SELECT unnest(range({P.WINDOW_MINUTES})) AS k) o)""", body=f"""
SELECT content_id, window_start, window_start + INTERVAL {P.WINDOW_MINUTES} MINUTE AS window_end,
       count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
       CAST(sum({SCORE_UNITS}) AS DOUBLE)/100000 AS score
FROM expanded GROUP BY content_id, window_start""")
    q["sessions"] = _with(*_dense(), f"""g AS (
  SELECT content_id, user_id, engagement_seconds, event_ts,
         CASE WHEN event_ts - lag(event_ts) OVER w > INTERVAL {P.SESSION_GAP_MINUTES} MINUTE THEN 1 ELSE 0 END AS brk
  FROM enriched WINDOW w AS (PARTITION BY content_id ORDER BY event_ts)
), s AS (
  SELECT *, sum(brk) OVER (PARTITION BY content_id ORDER BY event_ts
                           RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM g)""", body=f"""
SELECT content_id, min(event_ts) AS session_start,
       max(event_ts) + INTERVAL {P.SESSION_GAP_MINUTES} MINUTE AS session_end,
       count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
       coalesce(CAST(sum(engagement_seconds) AS DOUBLE), 0) AS total_engagement_seconds
FROM s GROUP BY content_id, sid""")
    q["backfill"] = _with(CONTENT, EVENTS, _enriched(False), body=f"""
SELECT * FROM enriched
WHERE event_ts >= {_ts(P.BACKFILL_START)} AND event_ts < {_ts(P.BACKFILL_END)}""")
    q["payload_fields"] = _with(CONTENT, EVENTS, body="""
SELECT id, json_extract_string(raw_payload, '$.k') AS k,
       json_extract_string(raw_payload, '$.session_id') AS session_id,
       json_extract_string(raw_payload, '$.ip_address') AS ip_address,
       json_extract_string(raw_payload, '$.user_agent') AS user_agent,
       json_extract_string(raw_payload, '$.referrer') AS referrer,
       json_extract_string(raw_payload, '$.screen_resolution') AS screen_resolution
FROM engagement_events""")
    q["stream_fact"] = _with(*_std(FACT), body="SELECT * FROM fact")
    conds = " OR ".join(f"({c})" for _, c in _rules(True))
    q["raw_json_valid"] = _with(CONTENT, EVENTS, body=f"""
SELECT * FROM engagement_events e WHERE NOT ({conds})""")
    q["dedup_events"] = _with(CONTENT, EVENTS, DEFECTS, body="""
SELECT * FROM defect_events
QUALIFY id IS NULL OR row_number() OVER (
  PARTITION BY id ORDER BY event_ts DESC NULLS LAST, content_id DESC) = 1""")
    q["top_content_meta"] = _with(*_std(), body=f"""
SELECT t.content_id, t.score, m.slug, m.title, m.content_type, t.total_events, t.unique_users,
       t.total_engagement_seconds, m.last_updated
FROM ({_top_content_body("enriched", P.TOP_K)}) t JOIN (
  SELECT content_id, arg_max(slug, event_ts) AS slug, arg_max(title, event_ts) AS title,
         arg_max(content_type, event_ts) AS content_type, max(event_ts) AS last_updated
  FROM enriched GROUP BY content_id) m ON t.content_id = m.content_id""")
    q["daily_summary_ordered"] = q["daily_summary"]
    q["hourly_trends_ordered"] = q["hourly_trends"]
    q["content_valid"] = _with(CONTENT, CONTENT_DEFECTS, body="""
SELECT * EXCLUDE (reasons) FROM content_defects WHERE reasons = ''""")
    q["content_rejected"] = _with(CONTENT, CONTENT_DEFECTS, body="""
SELECT * FROM content_defects WHERE reasons <> ''""")
    q["backfill_ordered"] = (f"{q['backfill']} ORDER BY event_ts, id "
                             f"LIMIT {P.PAGE_SIZE} OFFSET {P.PAGE_SIZE * P.PAGE_NUMBER}")
    codes = ", ".join(f"CASE WHEN {cond} THEN '{code}' END" for code, cond in _rules(True))
    q["raw_json_rejected"] = _with(CONTENT, EVENTS, f"""judged AS (
  SELECT id, nullif(concat_ws(',', {codes}), '') AS own FROM engagement_events e)""", body="""
SELECT reasons, count(*) AS documents FROM (
  SELECT CASE WHEN id % 43 = 0 THEN
                'malformed_json,missing_id,invalid_content_id,invalid_user_id,invalid_event_type,invalid_event_ts'
              WHEN id % 47 = 0 THEN concat_ws(',', 'invalid_raw_payload', own)
              WHEN id % 53 = 0 THEN concat_ws(',', 'invalid_id,missing_id', own)
              ELSE own END AS reasons FROM judged) WHERE reasons IS NOT NULL GROUP BY reasons""")
    from eventide.plans.stream_checks import ORACLE_TWIN
    for name, (twin, defects) in ORACLE_TWIN.items():
        q[name] = q[twin].replace(EVENTS, STREAM_EVENTS) if defects else q[twin]
    q["stream_delivery_stats"] = _with(*_std(), body="""
SELECT sent_count, error_count, sent_count + error_count AS total_attempts,
       CAST(error_count AS DOUBLE) / greatest(sent_count + error_count, 1) AS error_rate
FROM (SELECT CAST(sum(CASE WHEN id % 11 <> 0 AND id % 7 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS sent_count,
             CAST(sum(CASE WHEN id % 11 = 0 THEN 3 WHEN id % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS error_count
      FROM enriched)""")
    q["stream_metrics"] = _with(CONTENT, STREAM_EVENTS, _tagged(True), body="""
SELECT CAST(sum(CASE WHEN reasons = '' THEN 1 ELSE 0 END) AS BIGINT) AS processed,
       CAST(sum(CASE WHEN reasons <> '' THEN 1 ELSE 0 END) AS BIGINT) AS errors,
       CAST(sum(CASE WHEN reasons <> '' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS error_rate
FROM tagged""")
    q["stream_restart_fact"] = q["stream_fact"]
    q["view_daily_summary"], q["view_hourly_trends"] = q["daily_summary"], q["hourly_trends"]
    q["bucketed_lookback"] = q["top_content_lookback"]
    q["backfill_seek_page"] = q["backfill_ordered"]
    q["backfill_numbered"] = ("SELECT *, row_number() OVER (ORDER BY event_ts, id) - 1 AS position "
                              f"FROM ({q['backfill']})")
    q["daily_from_states"] = q["daily_summary"]
    q["hourly_from_states"] = q["hourly_trends"]
    q["top_from_states"] = _with(*_std(FACT), f"""counted AS (
  SELECT content_id, count(*) AS total_events FROM fact
  WHERE event_date BETWEEN DATE '{P.STATS_START}' AND DATE '{P.STATS_END}' GROUP BY content_id)""",
                                 body=f"""
SELECT content_id, total_events FROM counted
QUALIFY rank() OVER (ORDER BY total_events DESC)
        + count(*) OVER (PARTITION BY total_events) - 1 <= {P.TOP_STATES_K}""")
    number = " + ".join(f"CASE WHEN event_ts >= {_ts(c)} THEN 1 ELSE 0 END" for c in P.LATE_CUTS)
    q["resent_ids"] = _with(CONTENT, EVENTS, body=f"""
SELECT id, CAST({number} + 1 AS INTEGER) AS batch, content_id, event_ts
FROM engagement_events WHERE id % 41 = 0 AND id % 101 <> 0""")
    q["fact_lookup"] = _with(*_std(FACT), body=f"""
SELECT event_id, content_id, user_id, event_type, event_timestamp, event_date FROM fact
WHERE event_id IN {P.LOOKUP_IDS}""")
    q["stream_expiry"] = (
        "SELECT content_id, session_start, session_end, total_events, total_engagement_seconds "
        f"FROM ({q['sessions']}) WHERE session_end < {_ts(P.EXPIRY_UNTIL)}")
    held = f"(id % 17 = 0 AND event_ts < {_ts(P.LATE_BEFORE)})"
    q["stream_late_rows"] = _with(CONTENT, EVENTS, _tagged(True), body=f"""
SELECT 'accepted' AS outcome, count(*) AS events FROM tagged WHERE NOT {held} AND reasons = ''
UNION ALL SELECT 'rejected', count(*) FROM tagged WHERE NOT {held} AND reasons <> ''
UNION ALL SELECT 'late', count(*) FROM tagged WHERE {held}
UNION ALL SELECT 'duplicate', count(*) FROM tagged WHERE NOT {held} AND id % 41 = 0""")
    copies = f"1 + CASE WHEN id % 41 = 0 AND NOT {held} THEN 1 ELSE 0 END"
    last = f"({held} OR event_ts >= {_ts(P.LATE_CUTS[-1])})"
    q["stream_latency_alerts"] = _with(CONTENT, EVENTS, body=f"""
SELECT 'latency' AS alert, CAST({len(P.LATE_CUTS) + 1} AS BIGINT) AS batches,
       CAST(sum({copies}) AS BIGINT) AS sent_rows, count(*) FILTER ({held}) AS late_rows
FROM engagement_events
UNION ALL SELECT 'late_rows', CAST(1 AS BIGINT), CAST(sum({copies}) AS BIGINT),
       count(*) FILTER ({held}) FROM engagement_events WHERE {last}""")
    q["stream_fact"] = q["stream_fact"].replace(EVENTS, STREAM_EVENTS)
    q["stream_quarantine"] = _with(CONTENT, STREAM_EVENTS, _tagged(True), body="""
SELECT id, content_id, user_id, event_type, event_ts, duration_ms, device, raw_payload, reasons
FROM tagged WHERE reasons <> ''""")
    # exact DECIMAL outputs are reported as DOUBLE (same single cast on both sides)
    for name in DECIMAL_OUTPUTS:
        q[name] = (f"SELECT * REPLACE (CAST(engagement_seconds AS DOUBLE) AS engagement_seconds, "
                   f"CAST(engagement_pct AS DOUBLE) AS engagement_pct) FROM ({q[name]})")
    return q


DECIMAL_OUTPUTS = ("enriched", "enriched_view", "anomaly_flags", "backfill", "backfill_ordered",
                   "stream_fact", "stream_restart_fact",
                   "backfill_seek_page", "backfill_numbered")


def _quality_body() -> str:
    from eventide.operators.quality import EVENT_REASONS
    sums = ",\n       ".join(
        f"CAST(sum(CASE WHEN list_contains(string_split(reasons, ','), '{r}') THEN 1 ELSE 0 END) AS BIGINT) AS \"{r}\""
        for r in EVENT_REASONS)
    unions = "\nUNION ALL ".join(f"SELECT '{r}' AS check_name, \"{r}\" AS violations, total FROM reason_totals"
                                 for r in EVENT_REASONS)

    def dup(src: str, key: str, name: str) -> str:
        return (f"SELECT '{name}' AS check_name, "
                f"CAST(coalesce(sum(CASE WHEN {key} IS NOT NULL AND n > 1 THEN n - 1 ELSE 0 END), 0) AS BIGINT) AS violations, "
                f"CAST(coalesce(sum(n), 0) AS BIGINT) AS total "
                f"FROM (SELECT {key}, count(*) AS n FROM {src} GROUP BY {key})")
    return f""", reason_totals AS (
  SELECT count(*) AS total,
       {sums}
  FROM tagged
), rows AS (
  {unions}
  UNION ALL {dup('tagged', 'id', 'duplicate_event_id')}
  UNION ALL {dup('content', 'content_id', 'duplicate_content_id')}
  UNION ALL {dup('content', 'slug', 'duplicate_content_slug')}
), st AS (
  SELECT *, CASE WHEN violations = 0 THEN 'healthy'
                 WHEN check_name IN ('duplicate_event_id','duplicate_content_id','duplicate_content_slug')
                      OR CAST(violations AS DOUBLE) / nullif(total, 0) > 0.01 THEN 'unhealthy'
                 ELSE 'degraded' END AS status
  FROM rows
)
SELECT check_name, violations, total, status,
       CASE max(CASE status WHEN 'unhealthy' THEN 2 WHEN 'degraded' THEN 1 ELSE 0 END) OVER ()
            WHEN 2 THEN 'unhealthy' WHEN 1 THEN 'degraded' ELSE 'healthy' END AS overall_status
FROM st"""
