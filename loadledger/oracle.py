"""For each registered query the same result in SQL, over the same tables.

Shared parts are common table expressions; ``_q`` puts those in front that a
query names, directly or through others.
"""

from __future__ import annotations

import re

KEY = "period, respondent, type"
HISTORY = f"{KEY}, value, value_units, source_path, source_modified_at, content_hash"
HOURLY = (
    "period, period_ts, date, respondent, actual_demand_mwh, forecast_demand_mwh, "
    "forecast_error_mwh, absolute_error_mwh, source_modified_at"
)
HOURLY_COMPARED = (
    "actual_demand_mwh",
    "forecast_demand_mwh",
    "forecast_error_mwh",
    "absolute_error_mwh",
    "source_modified_at",
)
DAILY_COMPARED = (
    "hour_count",
    "avg_hourly_demand_mwh",
    "peak_demand_mwh",
    "total_daily_energy_mwh",
    "mae_mwh",
    "source_modified_at",
)
FIRST = (
    "(source_modified_at < TIMESTAMP '2024-01-06' OR (source_modified_at < TIMESTAMP '2024-01-26' "
    "AND feed IN ('click', 'purchase', 'view')))"
)
SECOND = (
    "(source_modified_at >= TIMESTAMP '2024-01-06' AND (source_modified_at >= TIMESTAMP '2024-01-26' "
    "OR feed IN ('error', 'purchase', 'signup')))"
)
EXACT = "DECIMAL(28,6)"


def _latest(source: str) -> str:
    return f"""
    SELECT {HISTORY}, feed, level FROM (
      SELECT *, row_number() OVER (
        PARTITION BY {KEY}
        ORDER BY source_modified_at DESC, source_path DESC, content_hash DESC) AS rn
      FROM {source}) AS ranked
    WHERE rn = 1"""


def _hourly(source: str) -> str:
    return f"""
    SELECT period, strptime(period, '%Y-%m-%dT%H') AS period_ts,
      CAST(strptime(period, '%Y-%m-%dT%H') AS DATE) AS date, respondent,
      actual_demand_mwh, forecast_demand_mwh,
      actual_demand_mwh - forecast_demand_mwh AS forecast_error_mwh,
      abs(actual_demand_mwh - forecast_demand_mwh) AS absolute_error_mwh,
      source_modified_at
    FROM (
      SELECT period, respondent,
        max(CASE WHEN type = 'D' THEN value END) AS actual_demand_mwh,
        max(CASE WHEN type = 'DF' THEN value END) AS forecast_demand_mwh,
        max(source_modified_at) AS source_modified_at
      FROM {source} GROUP BY period, respondent) AS wide"""


def _paired(source: str) -> str:
    return (
        f"SELECT * FROM {source} "
        "WHERE actual_demand_mwh IS NOT NULL AND forecast_demand_mwh IS NOT NULL"
    )


def _daily(source: str) -> str:
    return f"""
    SELECT date, respondent, count(*) AS hour_count,
      CAST(sum(CAST(actual_demand_mwh AS {EXACT})) AS DOUBLE) / count(*) AS avg_hourly_demand_mwh,
      max(actual_demand_mwh) AS peak_demand_mwh,
      CAST(sum(CAST(actual_demand_mwh AS {EXACT})) AS DOUBLE) AS total_daily_energy_mwh,
      CAST(sum(CAST(absolute_error_mwh AS {EXACT})) AS DOUBLE) / count(*) AS mae_mwh,
      max(source_modified_at) AS source_modified_at
    FROM {source} GROUP BY date, respondent"""


def _records(source: str, value: str = "CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)") -> str:
    return f"""
    SELECT period, respondent, lower(respondent) AS respondent_name, type, feed AS type_name,
      {value} AS value, value_units, CAST(substr(period, 1, 10) AS DATE) AS date
    FROM {source}"""


def _days(source: str, first: str = "''") -> str:
    record = (
        f"'{{' || {first} || " "'\"period\":\"' || period || '\",\"respondent\":\"' || respondent || "
        "'\",\"respondent-name\":\"' || respondent_name || '\",\"type\":\"' || type || "
        "'\",\"type-name\":\"' || type_name || '\",\"value\":\"' || value || "
        "'\",\"value-units\":\"' || value_units || '\"}'"
    )
    return f"""
    SELECT date, respondent, record_count, records_json, sha256(records_json) AS fingerprint
    FROM (
      SELECT date, respondent, CAST(count(*) AS INTEGER) AS record_count,
        '[' || string_agg({record}, ',' ORDER BY period, type) || ']' AS records_json
      FROM {source} GROUP BY date, respondent) AS built"""



def _origin(edition: str) -> str:
    return f"""'"origin":{{"edition":' || ({edition}) || ',"unit":"' || value_units || '"}},'"""


def _diff(mine: str, theirs: str) -> str:
    return f"""
    SELECT coalesce(m.period, t.period) AS period, coalesce(m.respondent, t.respondent) AS respondent,
      coalesce(m.type, t.type) AS type,
      CASE WHEN t.period IS NULL THEN 'missing' WHEN m.period IS NULL THEN 'extra'
        WHEN m.value IS DISTINCT FROM t.value THEN 'value_change'
        WHEN m.type_name IS DISTINCT FROM t.type_name
          OR m.respondent_name IS DISTINCT FROM t.respondent_name
          OR m.value_units IS DISTINCT FROM t.value_units THEN 'metadata_change'
        ELSE 'equal' END AS status,
      t.value AS old_value, m.value AS new_value, coalesce(m.value_units, t.value_units) AS unit,
      CASE WHEN m.period IS NOT NULL AND t.period IS NOT NULL THEN concat_ws(',',
        CASE WHEN m.respondent_name IS DISTINCT FROM t.respondent_name THEN 'respondent-name' END,
        CASE WHEN m.type_name IS DISTINCT FROM t.type_name THEN 'type-name' END,
        CASE WHEN m.value IS DISTINCT FROM t.value THEN 'value' END,
        CASE WHEN m.value_units IS DISTINCT FROM t.value_units THEN 'value-units' END) END AS changed_fields
    FROM {mine} m FULL JOIN {theirs} t
      ON m.period = t.period AND m.respondent = t.respondent AND m.type = t.type"""


CTES = {
    "readings": f"""
    SELECT strftime(ts, '%Y-%m-%dT%H') AS period,
      CASE WHEN event_type IN ('click', 'signup', 'view') THEN 'WEB' ELSE 'OPS' END AS respondent,
      CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 50 THEN 'D' ELSE 'DF' END AS type,
      CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value,
      'megawatthours' AS value_units,
      event_type || '/' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS source_path,
      ts AS source_modified_at,
      sha256(CAST(event_id AS VARCHAR) || '|' || props) AS content_hash,
      event_type AS feed,
      json_extract_string(props, '$.k') AS level
    FROM events""",
    "first_rows": f"SELECT * FROM readings WHERE {FIRST}",
    "second_rows": f"SELECT * FROM readings WHERE {SECOND}",
    "latest_all": _latest("readings"),
    "latest_first": _latest("first_rows"),
    "latest_second": _latest("second_rows"),
    "hourly_all": _hourly("latest_all"),
    "hourly_first": _hourly("latest_first"),
    "hourly_second": _hourly("latest_second"),
    "paired_all": _paired("hourly_all"),
    "paired_first": _paired("hourly_first"),
    "paired_second": _paired("hourly_second"),
    "daily_all": _daily("paired_all"),
    "daily_first": _daily("paired_first"),
    "daily_second": _daily("paired_second"),
    "hourly_twice": f"SELECT {HOURLY} FROM hourly_first UNION ALL SELECT {HOURLY} FROM hourly_all",
    "daily_twice": "SELECT * FROM daily_first UNION ALL SELECT * FROM daily_all",
    "records_all": _records("latest_all"),
    "records_first": _records("latest_first"),
    "mine": _records("latest_second", "level"),
    "theirs": _records("latest_first", "level"),
    "days_all": _days("records_all"),
    "days_first": _days("records_first"),
    # with an eighth field, an object, that differs in the second edition
    "editions_one": _days("records_all", _origin("1")),
    "editions_two": _days(
        "records_all", _origin("CASE WHEN respondent = 'WEB' AND day(date) % 2 = 0 THEN 2 ELSE 1 END")
    ),
    # what the landing zone holds after both deliveries
    "landed": """
    SELECT date, respondent, 'canonical' AS version, record_count, records_json FROM days_first
    UNION ALL
    SELECT a.date, a.respondent, 'canonical', a.record_count, a.records_json
    FROM days_all a
    WHERE NOT EXISTS (
      SELECT 1 FROM days_first f WHERE f.date = a.date AND f.respondent = a.respondent)
    UNION ALL
    SELECT a.date, a.respondent, 'revision_' || a.fingerprint, a.record_count, a.records_json
    FROM days_all a JOIN days_first f ON f.date = a.date AND f.respondent = a.respondent
    WHERE a.fingerprint <> f.fingerprint""",
    "files": """
    SELECT date, respondent, version, record_count, sha256(
      '{"response":{"data":' || records_json || ',"total":"' || CAST(record_count AS VARCHAR)
      || '"}}' || chr(10)) AS content_hash
    FROM landed""",
    "served_day": """
    SELECT a.date, a.respondent,
      CASE WHEN f.fingerprint IS NULL OR f.fingerprint = a.fingerprint THEN 'canonical'
        ELSE 'revision_' || a.fingerprint END AS version
    FROM days_all a LEFT JOIN days_first f ON f.date = a.date AND f.respondent = a.respondent""",
    "classified": """
    SELECT a.date, a.respondent, a.record_count, a.fingerprint,
      CASE WHEN f.fingerprint IS NULL THEN 'NEW'
        WHEN f.fingerprint = a.fingerprint THEN 'UNCHANGED' ELSE 'REVISION' END AS status,
      CASE WHEN f.fingerprint <> a.fingerprint THEN a.fingerprint END AS revision_id
    FROM days_all a LEFT JOIN days_first f ON f.date = a.date AND f.respondent = a.respondent""",
    "raw_feed": """
    SELECT event_id, event_type || '/' || strftime(ts, '%Y-%m-%d') AS source_path,
      strftime(ts, '%Y-%m-%dT%H') AS period, event_type AS respondent,
      CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 50 THEN 'D' ELSE 'DF' END AS type,
      CASE WHEN event_type = 'click' THEN props
        ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS value_raw,
      TRY_CAST(CASE WHEN event_type = 'click' THEN props
        ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS DOUBLE) AS value,
      CASE WHEN event_type = 'signup' THEN 'signups' ELSE 'megawatthours' END AS value_units
    FROM events""",
    "file_duplicates": f"""
    SELECT source_path, {KEY}, count(*) AS row_count FROM raw_feed
    GROUP BY source_path, {KEY} HAVING count(*) > 1""",
    "grid": """
    SELECT strftime(day + hour * INTERVAL 1 HOUR, '%Y-%m-%dT%H') AS period, respondent, type
    FROM (
      SELECT respondent, unnest(generate_series(
        CAST(min(CAST(source_modified_at AS DATE)) AS TIMESTAMP),
        CAST(max(CAST(source_modified_at AS DATE)) AS TIMESTAMP), INTERVAL 1 DAY)) AS day
      FROM readings GROUP BY respondent) AS days_of
    CROSS JOIN (SELECT unnest(generate_series(0, 23)) AS hour) AS hours_of
    CROSS JOIN (SELECT 'D' AS type UNION ALL SELECT 'DF') AS types_of""",
    "series_days": """
    SELECT DISTINCT respondent, CAST(source_modified_at AS DATE) AS date FROM readings""",
    "names": """
    SELECT respondent, date, sha256(respondent || CAST(date AS VARCHAR)) AS id,
      '/zone/respondent=' || respondent || strftime(date, '/year=%Y/month=%m/day=%d/') AS folder,
      'feed_' || CAST(date AS VARCHAR) AS stem
    FROM series_days""",
    "candidates": """
    SELECT 'canonical' AS kind, folder || stem || '.json' AS path FROM names
    UNION ALL SELECT 'revision', folder || 'revisions/' || stem || '_revision_' || id || '.json' FROM names
    UNION ALL SELECT 'sha256', folder || 'revisions/' || stem || '_sha256_' || id || '.json' FROM names
    UNION ALL SELECT 'short id', folder || stem || '_revision_' || substr(id, 1, 63) || '.json' FROM names
    UNION ALL SELECT 'upper case id', folder || stem || '_revision_' || upper(id) || '.json' FROM names
    UNION ALL SELECT 'unfinished', folder || stem || '.json.tmp' FROM names
    UNION ALL SELECT 'hour range', folder || stem || 'T00_to_T23.json' FROM names
    UNION ALL SELECT 'version folder', folder || 'version=revision_' || id || '/part-00000-a.c000.txt'
    FROM names""",
    "merged_latest": f"""
    SELECT coalesce(t.period, s.period) AS period, coalesce(t.respondent, s.respondent) AS respondent,
      coalesce(t.type, s.type) AS type,
      t.period IS NOT NULL AS stored, s.period IS NOT NULL AS arrived,
      coalesce(s.source_modified_at > t.source_modified_at
        OR (s.source_modified_at = t.source_modified_at AND s.source_path > t.source_path), FALSE) AS newer,
      t.value AS t_value, t.value_units AS t_value_units, t.source_path AS t_source_path,
      t.source_modified_at AS t_source_modified_at, t.content_hash AS t_content_hash,
      s.value AS s_value, s.value_units AS s_value_units, s.source_path AS s_source_path,
      s.source_modified_at AS s_source_modified_at, s.content_hash AS s_content_hash
    FROM latest_first t FULL JOIN latest_second s
      ON t.period = s.period AND t.respondent = s.respondent AND t.type = s.type""",
    "latest_actions": """
    SELECT *, CASE WHEN NOT stored THEN 'inserted' WHEN NOT arrived THEN 'kept'
      WHEN newer THEN 'updated' ELSE 'unchanged' END AS action
    FROM merged_latest""",
    # an incremental run recomputes the hours with changed readings, then their days
    "changed_hours": """
    SELECT * FROM hourly_all h WHERE EXISTS (
      SELECT 1 FROM latest_actions l WHERE l.period = h.period AND l.respondent = h.respondent
        AND l.action IN ('inserted', 'updated'))""",
    "diff": _diff("mine", "theirs"),
    "diff_all": _diff("records_all", "records_first"),
    "ranked_days": """
    SELECT *, row_number() OVER (PARTITION BY respondent ORDER BY date DESC) AS day_rank FROM (
      SELECT date, respondent, count(*) AS hours,
        sum(CAST(actual_demand_mwh AS DECIMAL(28,6))) AS energy,
        sum(CAST(absolute_error_mwh AS DECIMAL(28,6))) AS abs_error,
        max(actual_demand_mwh) AS peak
      FROM paired_all GROUP BY date, respondent) AS folded""",
    "spans": "SELECT 3 AS window_days UNION ALL SELECT 7 UNION ALL SELECT 10",
    "hour_pairs": """
    SELECT l.period IS NOT NULL AS in_left, r.period IS NOT NULL AS in_right,
      coalesce(l.period, r.period) AS period, coalesce(l.respondent, r.respondent) AS respondent,
      abs(l.actual_demand_mwh - r.actual_demand_mwh) <= greatest(0.01,
        1e-9 * greatest(abs(l.actual_demand_mwh), abs(r.actual_demand_mwh))) AS actual_ok,
      abs(l.forecast_demand_mwh - r.forecast_demand_mwh) <= greatest(0.01,
        1e-9 * greatest(abs(l.forecast_demand_mwh), abs(r.forecast_demand_mwh))) AS forecast_ok
    FROM paired_all l FULL JOIN paired_first r
      ON l.period = r.period AND l.respondent = r.respondent""",
    "day_pairs": """
    SELECT l.date IS NOT NULL AS in_left, r.date IS NOT NULL AS in_right,
      coalesce(l.date, r.date) AS date, coalesce(l.respondent, r.respondent) AS respondent,
      abs(l.total_daily_energy_mwh - r.total_daily_energy_mwh) <= greatest(0.01,
        1e-9 * greatest(abs(l.total_daily_energy_mwh), abs(r.total_daily_energy_mwh))) AS energy_ok,
      abs(l.peak_demand_mwh - r.peak_demand_mwh) <= greatest(0.01,
        1e-9 * greatest(abs(l.peak_demand_mwh), abs(r.peak_demand_mwh))) AS peak_ok,
      abs(l.mae_mwh - r.mae_mwh) <= greatest(0.01,
        1e-9 * greatest(abs(l.mae_mwh), abs(r.mae_mwh))) AS mae_ok
    FROM daily_all l FULL JOIN daily_first r
      ON l.date = r.date AND l.respondent = r.respondent""",
    "window_sums": """
    SELECT d.respondent, s.window_days, sum(h.hours) AS hours,
      CAST(sum(h.energy) AS DOUBLE) AS hour_energy,
      CAST(sum(CAST(d.total_daily_energy_mwh AS DECIMAL(28,6))) AS DOUBLE) AS day_energy
    FROM (SELECT *, row_number() OVER (PARTITION BY respondent ORDER BY date DESC) AS n
      FROM daily_first) AS d
    JOIN spans s ON d.n <= s.window_days
    LEFT JOIN ranked_days h ON h.date = d.date AND h.respondent = d.respondent
    GROUP BY d.respondent, s.window_days""",
    "all_checks": """
    SELECT 1 AS ordinal, 'hourly row count' AS "check", 1 AS compared,
      CASE WHEN count(*) FILTER (in_left) <> count(*) FILTER (in_right) THEN 1 ELSE 0 END AS failed
    FROM hour_pairs
    UNION ALL SELECT 2, 'hourly keys unique', 1, 0
    UNION ALL SELECT 3, 'hourly keys match', 1,
      CASE WHEN count(*) FILTER (NOT (in_left AND in_right)) > 0 THEN 1 ELSE 0 END FROM hour_pairs
    UNION ALL SELECT 4, 'hourly actual', count(*), count(*) FILTER (NOT actual_ok)
    FROM hour_pairs WHERE in_left AND in_right
    UNION ALL SELECT 5, 'hourly forecast', count(*), count(*) FILTER (NOT forecast_ok)
    FROM hour_pairs WHERE in_left AND in_right
    UNION ALL SELECT 6, 'daily row count', 1,
      CASE WHEN count(*) FILTER (in_left) <> count(*) FILTER (in_right) THEN 1 ELSE 0 END FROM day_pairs
    UNION ALL SELECT 7, 'daily keys unique', 1, 0
    UNION ALL SELECT 8, 'daily keys match', 1,
      CASE WHEN count(*) FILTER (NOT (in_left AND in_right)) > 0 THEN 1 ELSE 0 END FROM day_pairs
    UNION ALL SELECT 9, 'daily energy', count(*), count(*) FILTER (NOT energy_ok)
    FROM day_pairs WHERE in_left AND in_right
    UNION ALL SELECT 10, 'daily peak', count(*), count(*) FILTER (NOT peak_ok)
    FROM day_pairs WHERE in_left AND in_right
    UNION ALL SELECT 11, 'daily MAE', count(*), count(*) FILTER (NOT mae_ok)
    FROM day_pairs WHERE in_left AND in_right
    UNION ALL SELECT CASE window_days WHEN 3 THEN 12 WHEN 7 THEN 14 ELSE 16 END,
      CAST(window_days AS VARCHAR) || '-day hourly coverage', count(*),
      count(*) FILTER (coalesce(hours, 0) <> window_days * 24)
    FROM window_sums GROUP BY window_days
    UNION ALL SELECT CASE window_days WHEN 3 THEN 13 WHEN 7 THEN 15 ELSE 17 END,
      CAST(window_days AS VARCHAR) || '-day total energy', count(*),
      count(*) FILTER (NOT coalesce(abs(hour_energy - day_energy) <= greatest(0.01,
        1e-9 * greatest(abs(hour_energy), abs(day_energy))), FALSE))
    FROM window_sums GROUP BY window_days""",
    "last_hours": """
    SELECT user_id, strftime(max(ts), '%Y-%m-%dT%H') AS last_uploaded_hour
    FROM events GROUP BY user_id""",
}


def _q(select: str) -> str:
    """Prefix the select with the expressions it needs, in order of definition."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"(?:FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(select)
    parts = [f"{name} AS ({body}\n)" for name, body in CTES.items() if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + select


def _merge(target: str, source: str, columns: str, keys: tuple[str, ...], compared: tuple[str, ...]) -> str:
    """Upsert that takes the source row when a compared column differs."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    changed = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in compared)
    names = [c.strip() for c in columns.split(",")]
    picked = ", ".join(
        f"coalesce(t.{c}, s.{c}) AS {c}"
        if c in keys
        else f"CASE WHEN t.{keys[0]} IS NULL OR (s.{keys[0]} IS NOT NULL AND ({changed})) "
        f"THEN s.{c} ELSE t.{c} END AS {c}"
        for c in names
    )
    return (
        f"SELECT {picked}, CASE WHEN t.{keys[0]} IS NULL THEN 'inserted' "
        f"WHEN s.{keys[0]} IS NULL THEN 'kept' WHEN {changed} THEN 'updated' "
        f"ELSE 'unchanged' END AS action "
        f"FROM {target} t FULL JOIN {source} s ON {on}"
    )


def _missing(names: str, prefix: str = "") -> str:
    return " OR ".join(f"{prefix}{n.strip()} IS NULL" for n in names.split(","))


def _picked_latest() -> str:
    rest = ("value", "value_units", "source_path", "source_modified_at", "content_hash")
    return ", ".join(
        f"CASE WHEN action IN ('inserted', 'updated') THEN s_{c} ELSE t_{c} END AS {c}" for c in rest
    )


HOURLY_MERGE = _merge("hourly_first", "hourly_second", HOURLY, ("period", "respondent"), HOURLY_COMPARED)
HOURS_REFRESHED = _merge(
    "hourly_first", "changed_hours", HOURLY, ("period", "respondent"), HOURLY_COMPARED
)
DAILY_COLUMNS = "date, respondent, " + ", ".join(DAILY_COMPARED)
DAILY_MERGE = _merge("daily_first", "daily_second", DAILY_COLUMNS, ("date", "respondent"), DAILY_COMPARED)
DAYS_REFRESHED = _merge("daily_first", "daily_all", DAILY_COLUMNS, ("date", "respondent"), DAILY_COMPARED)


def _strings() -> dict[str, str]:
    return {
        # versions
        "latest_per_key": f"SELECT {HISTORY} FROM latest_all",
        "revision_stats": f"""
            SELECT {KEY}, count(*) AS versions, count(DISTINCT value) AS distinct_values,
              min(source_modified_at) AS first_published_at, max(source_modified_at) AS last_published_at
            FROM readings GROUP BY {KEY}""",
        "layer_counts": """
            SELECT (SELECT count(*) FROM readings) AS history_rows,
              (SELECT count(*) FROM latest_all) AS latest_rows,
              (SELECT count(*) FROM readings) - (SELECT count(*) FROM latest_all) AS superseded_rows""",
        "history_append": f"""
            SELECT {HISTORY} FROM first_rows
            UNION ALL
            SELECT {HISTORY} FROM second_rows s WHERE NOT EXISTS (
              SELECT 1 FROM first_rows f WHERE f.source_path = s.source_path
                AND f.content_hash = s.content_hash AND f.period = s.period
                AND f.respondent = s.respondent AND f.type = s.type)""",
        "new_versions": f"""
            SELECT {HISTORY} FROM second_rows s WHERE NOT EXISTS (
              SELECT 1 FROM first_rows f WHERE f.source_path = s.source_path
                AND f.content_hash = s.content_hash AND f.period = s.period
                AND f.respondent = s.respondent AND f.type = s.type)""",
        "merge_latest": f"SELECT {KEY}, {_picked_latest()}, action FROM latest_actions",
        "merge_stats": "SELECT action, count(*) AS row_count FROM latest_actions GROUP BY action",
        "validity_intervals": f"""
            SELECT {KEY}, source_path, source_modified_at AS valid_from, lead(source_modified_at) OVER (
              PARTITION BY {KEY} ORDER BY source_modified_at, source_path, content_hash) AS valid_to
            FROM readings""",
        "as_of": f"""
            SELECT {KEY}, asked_by, as_of, value, source_path, source_modified_at FROM (
              SELECT a.asked_by, a.as_of, r.*, row_number() OVER (
                PARTITION BY a.asked_by, a.as_of
                ORDER BY r.source_modified_at DESC, r.source_path DESC, r.content_hash DESC) AS rn
              FROM (
                SELECT {KEY}, source_path AS asked_by, unnest([source_modified_at + INTERVAL 10 MINUTE,
                  source_modified_at + INTERVAL 12 HOUR]) AS as_of FROM readings) AS a
              JOIN readings r ON r.period = a.period AND r.respondent = a.respondent AND r.type = a.type
                AND r.source_modified_at <= a.as_of) AS paired
            WHERE rn = 1""",
        "key_lookup": """
            SELECT period, type, value, source_modified_at, source_path FROM latest_all
            WHERE period = '2024-01-15T12' AND respondent = 'WEB'""",
        "preview_latest": f"""
            SELECT {HISTORY} FROM latest_all ORDER BY period, type, respondent LIMIT 20""",
        # layers
        "pivot_hourly": f"SELECT {HOURLY} FROM hourly_all",
        "newest_hourly": f"SELECT {HOURLY} FROM hourly_all",
        "forecast_error": """
            SELECT period, respondent, forecast_error_mwh, absolute_error_mwh FROM paired_all""",
        "merge_hourly": HOURLY_MERGE,
        "daily_kpi": f"SELECT {DAILY_COLUMNS}, hour_count = 24 AS is_complete FROM daily_all",
        "merge_daily": DAILY_MERGE,
        "latest_dates": "SELECT DISTINCT date FROM daily_all ORDER BY date DESC LIMIT 10",
        "trailing_kpi": _TRAILING,
        "trailing_refresh": _TRAILING,
        "weekend_share": f"""
            SELECT respondent, weekend_energy_mwh, total_energy_mwh,
              weekend_energy_mwh / total_energy_mwh AS weekend_share
            FROM (
              SELECT respondent,
                CAST(coalesce(sum(CASE WHEN dayofweek(date) IN (0, 6)
                  THEN CAST(total_daily_energy_mwh AS {EXACT}) END), 0) AS DOUBLE) AS weekend_energy_mwh,
                CAST(sum(CAST(total_daily_energy_mwh AS {EXACT})) AS DOUBLE) AS total_energy_mwh
              FROM daily_all GROUP BY respondent) AS sums""",
        # quality
        "dq_row_rules": """
            SELECT 1 AS ordinal, 'required fields' AS "check", count(*) AS violations FROM raw_feed
            WHERE period IS NULL OR respondent IS NULL OR type IS NULL OR value_units IS NULL
              OR value IS NULL
            UNION ALL SELECT 2, 'respondent in domain', count(*) FROM raw_feed
            WHERE respondent NOT IN ('click', 'purchase', 'signup', 'view')
            UNION ALL SELECT 3, 'type in domain', count(*) FROM raw_feed WHERE type NOT IN ('D', 'F')
            UNION ALL SELECT 4, 'unit in domain', count(*) FROM raw_feed
            WHERE value_units <> 'megawatthours'""",
        "dq_duplicates": f"""
            SELECT 1 AS ordinal, 'key unique within its file' AS "check", count(*) AS violations
            FROM file_duplicates
            UNION ALL SELECT 2, 'latest unique', count(*) FROM (
              SELECT {KEY} FROM readings GROUP BY {KEY} HAVING count(*) > 1) AS a
            UNION ALL SELECT 3, 'hourly unique', count(*) FROM (
              SELECT period, respondent FROM hourly_twice GROUP BY period, respondent
              HAVING count(*) > 1) AS b
            UNION ALL SELECT 4, 'daily unique', count(*) FROM (
              SELECT date, respondent FROM daily_twice GROUP BY date, respondent
              HAVING count(*) > 1) AS c""",
        "dq_pairing": """
            SELECT * FROM (
              SELECT period, respondent, concat_ws(',',
                CASE WHEN period IS NULL THEN 'period' END,
                CASE WHEN period_ts IS NULL THEN 'period_ts' END,
                CASE WHEN date IS NULL THEN 'date' END,
                CASE WHEN respondent IS NULL THEN 'respondent' END,
                CASE WHEN actual_demand_mwh IS NULL THEN 'actual_demand_mwh' END,
                CASE WHEN forecast_demand_mwh IS NULL THEN 'forecast_demand_mwh' END,
                CASE WHEN forecast_error_mwh IS NULL THEN 'forecast_error_mwh' END,
                CASE WHEN absolute_error_mwh IS NULL THEN 'absolute_error_mwh' END,
                CASE WHEN source_modified_at IS NULL THEN 'source_modified_at' END) AS missing_columns
              FROM hourly_all) AS listed
            WHERE missing_columns <> ''""",
        "dq_hourly_rules": f"""
            SELECT 1 AS ordinal, 'actual and forecast paired' AS "check", count(*) AS violations
            FROM hourly_twice WHERE {_missing(HOURLY)}
            UNION ALL SELECT 2, 'unique key', count(*) FROM (
              SELECT period, respondent FROM hourly_twice GROUP BY period, respondent
              HAVING count(*) > 1) AS b""",
        "dq_daily_rules": f"""
            SELECT 1 AS ordinal, 'required fields' AS "check", count(*) AS violations
            FROM daily_twice WHERE {_missing(DAILY_COLUMNS)}
            UNION ALL SELECT 2, 'complete days', count(*) FROM daily_twice WHERE hour_count <> 24
            UNION ALL SELECT 3, 'unique key', count(*) FROM (
              SELECT date, respondent FROM daily_twice GROUP BY date, respondent
              HAVING count(*) > 1) AS b""",
        "gated_write": f"""
            SELECT 1 AS ordinal, 'required fields' AS "check", count(*) AS violations FROM readings
            WHERE period IS NULL OR respondent IS NULL OR type IS NULL OR value IS NULL
            UNION ALL SELECT 2, 'type in domain', count(*) FROM readings WHERE type NOT IN ('D', 'DF')
            UNION ALL SELECT 3, 'latest unique', count(*) FROM (
              SELECT {KEY} FROM readings GROUP BY {KEY} HAVING count(*) > 1) AS a
            UNION ALL SELECT 10, 'latest rows', count(*) FROM readings
            UNION ALL SELECT 11, 'actual and forecast paired', count(*) FROM hourly_twice WHERE {_missing(HOURLY)}
            UNION ALL SELECT 12, 'hourly unique', count(*) FROM (
              SELECT period, respondent FROM hourly_twice GROUP BY period, respondent
              HAVING count(*) > 1) AS b
            UNION ALL SELECT 20, 'hourly rows', count(*) FROM hourly_twice
            UNION ALL SELECT 21, 'required fields', count(*) FROM daily_twice WHERE {_missing(DAILY_COLUMNS)}
            UNION ALL SELECT 22, 'complete days', count(*) FROM daily_twice WHERE hour_count <> 24
            UNION ALL SELECT 23, 'daily unique', count(*) FROM (
              SELECT date, respondent FROM daily_twice GROUP BY date, respondent
              HAVING count(*) > 1) AS c
            UNION ALL SELECT 30, 'daily rows', count(*) FROM daily_twice""",
        "dq_complete_days": """
            SELECT date, respondent, hour_count FROM daily_all WHERE hour_count <> 24""",
        "dq_coverage": f"""
            SELECT date, respondent, CAST(sum(n) AS BIGINT) AS records,
              CAST(sum(nulls) AS BIGINT) AS null_values, count(*) FILTER (n > 1) AS duplicate_keys,
              count(*) FILTER (NOT fits) AS unexpected_keys, 48 - count(*) FILTER (fits) AS missing_keys,
              sum(nulls) + count(*) FILTER (n > 1) + count(*) FILTER (NOT fits)
                + 48 - count(*) FILTER (fits) = 0 AS is_valid
            FROM (
              SELECT date, {KEY}, count(*) AS n, count(*) FILTER (value IS NULL) AS nulls,
                CAST(substr(period, 1, 10) AS DATE) = date AND type IN ('D', 'F')
                  AND respondent IN ('click', 'purchase', 'signup', 'view') AS fits
              FROM (
                SELECT *, CAST(substr(period, 1, 10) AS DATE)
                  + CASE WHEN respondent = 'signup' THEN 1 ELSE 0 END AS date
                FROM raw_feed) AS dated
              GROUP BY date, {KEY}) AS keyed
            GROUP BY date, respondent""",
        "dq_declared_total": """
            SELECT respondent, date, 'canonical' AS version, record_count + wrong AS declared_total,
              record_count, wrong = 0 AS total_matches
            FROM (
              SELECT *, CASE WHEN respondent = 'WEB' AND day(date) % 2 = 0 THEN 1 ELSE 0 END AS wrong
              FROM days_first) AS declared""",
        "dq_accepted_files": """
            SELECT 0 AS ordinal, 'accepted files present' AS "check",
              CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations FROM candidates
            WHERE kind IN ('canonical', 'revision', 'sha256', 'version folder')
            UNION ALL
            SELECT 1, 'accepted files among the unfit',
              CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) FROM candidates
            WHERE kind IN ('short id', 'upper case id', 'unfinished', 'hour range')
              AND regexp_matches(path, '(_[0-9-]{10}|_(revision|sha256)_[a-f0-9]{64})[.]json$')""",
        "accepted_counts": """
            SELECT count(*) FILTER (kind IN ('canonical', 'revision', 'sha256', 'version folder')) AS accepted,
              count(*) FILTER (kind IN ('short id', 'upper case id', 'unfinished', 'hour range')) AS rejected
            FROM candidates""",
        "duplicate_keys": f"SELECT source_path, {KEY}, row_count FROM file_duplicates",
        "expected_grid": f"SELECT {KEY} FROM grid",
        "coverage_gaps": f"""
            SELECT {KEY}, 'missing' AS gap FROM grid g WHERE NOT EXISTS (
              SELECT 1 FROM readings r WHERE r.period = g.period
                AND r.respondent = g.respondent AND r.type = g.type)
            UNION ALL
            SELECT DISTINCT {KEY}, 'unexpected' FROM readings r WHERE NOT EXISTS (
              SELECT 1 FROM grid g WHERE r.period = g.period
                AND r.respondent = g.respondent AND r.type = g.type)""",
        "coverage_bitmap": f"""
            SELECT {KEY}, 'missing' AS gap FROM grid g WHERE NOT EXISTS (
              SELECT 1 FROM readings r WHERE r.period = g.period
                AND r.respondent = g.respondent AND r.type = g.type)
            UNION ALL
            SELECT DISTINCT {KEY}, 'unexpected' FROM readings r WHERE NOT EXISTS (
              SELECT 1 FROM grid g WHERE r.period = g.period
                AND r.respondent = g.respondent AND r.type = g.type)""",
        "day_masks": """
            SELECT CAST(substr(period, 1, 10) AS DATE) AS date, respondent, bit_or(bit) AS mask,
              CAST(bit_count(bit_or(bit)) AS INTEGER) AS readings,
              CAST(48 - bit_count(bit_or(bit)) AS INTEGER) AS missing
            FROM (
              SELECT *, CAST(1 AS BIGINT) << (CAST(substr(period, 12, 2) AS INTEGER)
                + CASE WHEN type = 'DF' THEN 24 ELSE 0 END) AS bit FROM readings) AS placed
            GROUP BY ALL""",
        "gap_runs": """
            SELECT respondent, type, strftime(min(ts), '%Y-%m-%dT%H') AS first_period,
              strftime(max(ts), '%Y-%m-%dT%H') AS last_period, count(*) AS hours
            FROM (
              SELECT respondent, type, ts, ts - INTERVAL 1 HOUR
                * row_number() OVER (PARTITION BY respondent, type ORDER BY ts) AS island
              FROM (
                SELECT *, strptime(period, '%Y-%m-%dT%H') AS ts FROM grid g WHERE NOT EXISTS (
                  SELECT 1 FROM first_rows r WHERE r.period = g.period
                    AND r.respondent = g.respondent AND r.type = g.type)) AS open) AS numbered
            GROUP BY respondent, type, island""",
        # landing
        "landing_accept": """
            SELECT kind, path FROM candidates
            WHERE kind IN ('canonical', 'revision', 'sha256', 'version folder')""",
        "parse_landing_path": """
            SELECT path, regexp_extract(path, '/respondent=([^/]+)/', 1) AS respondent,
              CAST(regexp_extract(path, 'year=([0-9]+)', 1) || '-' || regexp_extract(path, 'month=([0-9]+)', 1)
                || '-' || regexp_extract(path, 'day=([0-9]+)', 1) AS DATE) AS date,
              CASE WHEN kind IN ('revision', 'sha256', 'version folder')
                THEN 'revision_' || regexp_extract(path, '([a-f0-9]{64})', 1) ELSE 'canonical' END AS version,
              CASE WHEN kind IN ('revision', 'sha256', 'version folder')
                THEN regexp_extract(path, '([a-f0-9]{64})', 1) END AS revision_id,
              CASE WHEN kind = 'version folder' THEN replace(path, '/part-00000-a.c000.txt', '')
                ELSE path END AS source_path
            FROM candidates""",
        "scan_landing": """
            SELECT date, respondent, version FROM files WHERE date >= DATE '2024-01-06'""",
        "land_days": "SELECT * FROM classified",
        "ingest_days": "SELECT * FROM classified WHERE date >= DATE '2024-01-24'",
        "decode_payload": """
            SELECT respondent, date, version, record_count, CAST(record_count AS VARCHAR) AS total
            FROM files""",
        "content_fingerprint": "SELECT respondent, date, version, content_hash FROM files",
        "explode_records": _LANDED_ROWS.format(columns=_RECORD_COLUMNS, joined=""),
        "packed_zone": _LANDED_ROWS.format(columns=_RECORD_COLUMNS, joined=""),
        "safe_numeric": "SELECT event_id, value_raw, value FROM raw_feed",
        "parse_period": """
            SELECT period, CAST(try_strptime(period, '%Y-%m-%dT%H') AS TIMESTAMP) AS period_ts,
              CAST(try_strptime(period, '%Y-%m-%dT%H') AS DATE) AS date
            FROM (
              SELECT strftime(ts, '%Y-%m-%dT%H') AS period FROM events
              UNION SELECT strftime(ts, '%Y-%m-%d %H') FROM events
              UNION SELECT strftime(ts, '%Y/%m/%dT%H') FROM events) AS texts""",
        "record_digest": """
            SELECT b.date, b.respondent, b.record_count, b.fingerprint,
              CASE WHEN a.fingerprint = b.fingerprint THEN 'UNCHANGED' ELSE 'REVISION' END AS status,
              CASE WHEN a.fingerprint <> b.fingerprint THEN b.fingerprint END AS revision_id
            FROM editions_two b JOIN editions_one a ON a.date = b.date AND a.respondent = b.respondent""",
        "day_fingerprint": "SELECT date, respondent, record_count, fingerprint FROM days_all",
        "classify_days": "SELECT * FROM classified",
        "landing_conflicts": """
            SELECT date, respondent, record_count, fingerprint, 'canonical' AS version,
              CASE status WHEN 'NEW' THEN 'write' WHEN 'UNCHANGED' THEN 'skip' ELSE 'conflict' END AS outcome
            FROM classified""",
        # compare
        "snapshot_diff": f"SELECT {KEY}, status, old_value, new_value, unit FROM diff",
        "digest_diff": f"SELECT {KEY}, status, old_value, new_value, unit FROM diff_all WHERE status <> 'equal'",
        "digest_summary": "SELECT status, count(*) AS key_count FROM diff_all GROUP BY status",
        "changed_fields": f"SELECT {KEY}, changed_fields FROM diff WHERE changed_fields <> ''",
        "diff_summary": "SELECT status, count(*) AS key_count FROM diff GROUP BY status",
        "reconcile": """
            SELECT ordinal, "check", CAST(compared AS BIGINT) AS compared,
              CAST(failed AS BIGINT) AS failed, failed = 0 AS passed FROM all_checks""",
        "reconcile_failures": """
            SELECT * FROM (
              SELECT 'hour' AS grain, replace(period, 'T', ' ') AS key, respondent, concat_ws(',',
                CASE WHEN NOT (in_left AND in_right) THEN 'one-sided' END,
                CASE WHEN in_left AND in_right AND NOT actual_ok THEN 'actual' END,
                CASE WHEN in_left AND in_right AND NOT forecast_ok THEN 'forecast' END) AS failures
              FROM hour_pairs
              UNION ALL
              SELECT 'day', CAST(date AS VARCHAR), respondent, concat_ws(',',
                CASE WHEN NOT (in_left AND in_right) THEN 'one-sided' END,
                CASE WHEN in_left AND in_right AND NOT energy_ok THEN 'energy' END,
                CASE WHEN in_left AND in_right AND NOT peak_ok THEN 'peak' END,
                CASE WHEN in_left AND in_right AND NOT mae_ok THEN 'MAE' END)
              FROM day_pairs) AS named
            WHERE failures <> ''""",
        "first_present": """
            SELECT event_id,
              CASE WHEN event_type = 'click' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE)
                ELSE CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS first_number,
              CASE WHEN event_type = 'click' THEN json_extract_string(props, '$.k')
                ELSE event_type END AS first_text
            FROM events""",
        "normalize_period": """
            SELECT event_id, text, strftime(ts, '%Y-%m-%d %H') AS hour_key,
              strftime(ts, '%Y-%m-%d') AS date_key
            FROM (
              SELECT event_id, ts, strftime(ts, '%Y-%m-%dT%H') AS text FROM events
              UNION ALL SELECT event_id, ts, strftime(ts, '%Y-%m-%d %H:%M:%S') FROM events
              UNION ALL SELECT event_id, ts, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') FROM events) AS texts""",
        "read_snapshot": f"SELECT {HOURLY} FROM hourly_all",
        # state and runs
        "processing_range": """
            SELECT respondent, greatest(DATE '2024-01-01', CAST(max(date) - 1 AS DATE)) AS start_date,
              DATE '2024-01-30' AS end_date,
              greatest(DATE '2024-01-01', CAST(max(date) - 1 AS DATE)) <= DATE '2024-01-30' AS has_work
            FROM daily_first GROUP BY respondent""",
        "processing_hours": """
            SELECT respondent, strftime(greatest(TIMESTAMP '2024-01-01',
              strptime(max(period), '%Y-%m-%dT%H') - INTERVAL 23 HOUR), '%Y-%m-%dT%H') AS start_hour
            FROM first_rows GROUP BY respondent""",
        "next_checkpoint": """
            SELECT respondent, max(period) AS last_uploaded_hour FROM readings GROUP BY respondent""",
        "checkpoint_rules": """
            SELECT 1 AS ordinal, 'checkpoint present' AS "check", count(*) AS violations FROM last_hours
            WHERE last_uploaded_hour IS NULL OR last_uploaded_hour = ''
            UNION ALL SELECT 2, 'checkpoint parses', count(*) FROM last_hours
            WHERE try_strptime(last_uploaded_hour, '%Y-%m-%dT%H') IS NULL
            UNION ALL SELECT 3, 'checkpoint ends a day', count(*) FROM last_hours
            WHERE substr(last_uploaded_hour, 12, 2) <> '23'""",
        "incremental_refresh": f"SELECT {DAILY_COLUMNS} FROM daily_all",
        "refresh_outcome": f"""
            SELECT 'history' AS layer, 'inserted' AS action, count(*) AS row_count FROM second_rows s
            WHERE NOT EXISTS (SELECT 1 FROM first_rows f WHERE f.source_path = s.source_path)
            UNION ALL
            SELECT 'latest', action, count(*) FROM latest_actions
            WHERE substr(period, 1, 10) IN (SELECT substr(period, 1, 10) FROM second_rows) GROUP BY action
            UNION ALL
            SELECT 'hourly', action, count(*) FROM ({HOURS_REFRESHED}) AS h
            WHERE date IN (SELECT CAST(substr(period, 1, 10) AS DATE) FROM second_rows) GROUP BY action
            UNION ALL
            SELECT 'daily', action, count(*) FROM ({DAYS_REFRESHED}) AS d
            WHERE date IN (SELECT CAST(substr(period, 1, 10) AS DATE) FROM second_rows) GROUP BY action""",
        "stream_bronze": """
            SELECT l.period, l.respondent, l.type, l.value, l.value_units, s.version, f.content_hash
            FROM latest_all l
            JOIN served_day s ON s.date = CAST(substr(l.period, 1, 10) AS DATE)
              AND s.respondent = l.respondent
            JOIN files f ON f.date = s.date AND f.respondent = s.respondent AND f.version = s.version""",
        "stream_notices": _LANDED_ROWS.format(
            columns="r.period, r.respondent, r.type, CAST(r.value AS DOUBLE) AS value, r.value_units, "
            "l.version, f.content_hash",
            joined=" JOIN files f ON f.date = l.date AND f.respondent = l.respondent AND f.version = l.version",
        ),
        "stream_latest_state": f"SELECT {HISTORY} FROM latest_all",
        "stream_late_files": """
            SELECT l.period, l.respondent, l.type, l.value, l.value_units, 'canonical' AS version, f.content_hash
            FROM latest_first l
            JOIN days_first d ON d.date = CAST(substr(l.period, 1, 10) AS DATE)
              AND d.respondent = l.respondent
            JOIN files f ON f.date = d.date AND f.respondent = d.respondent AND f.version = 'canonical'
            UNION ALL
            SELECT l.period, l.respondent, l.type, l.value, l.value_units, s.version, f.content_hash
            FROM latest_all l
            JOIN served_day s ON s.date = CAST(substr(l.period, 1, 10) AS DATE)
              AND s.respondent = l.respondent
            JOIN files f ON f.date = s.date AND f.respondent = s.respondent AND f.version = s.version
            WHERE NOT EXISTS (SELECT 1 FROM latest_first o WHERE o.period = l.period
              AND o.respondent = l.respondent AND o.type = l.type)""",
        "pipeline_touched_files": """
            SELECT l.period, l.respondent, l.type, l.value, l.value_units, s.version, f.content_hash
            FROM latest_all l
            JOIN served_day s ON s.date = CAST(substr(l.period, 1, 10) AS DATE)
              AND s.respondent = l.respondent
            JOIN files f ON f.date = s.date AND f.respondent = s.respondent AND f.version = s.version""",
        "observed_order": f"""
            SELECT {KEY}, value FROM latest_first
            UNION ALL
            SELECT {KEY}, value FROM latest_all l WHERE NOT EXISTS (
              SELECT 1 FROM latest_first o WHERE o.period = l.period
                AND o.respondent = l.respondent AND o.type = l.type)""",
        "complete_days_refresh": f"SELECT {DAILY_COLUMNS} FROM daily_all WHERE hour_count = 24",
        "registered_tables": """
            SELECT d.respondent, count(*) AS days, CAST(sum(d.hour_count) AS BIGINT) AS hours,
              any_value(v.versions) AS versions
            FROM daily_all d
            JOIN (SELECT respondent, count(*) AS versions FROM readings GROUP BY respondent) v
              ON v.respondent = d.respondent
            GROUP BY d.respondent""",
        "layers_from_landing": """
            SELECT date, respondent, hour_count, avg_hourly_demand_mwh, peak_demand_mwh,
              total_daily_energy_mwh, mae_mwh FROM daily_all""",
    }


_RECORD_COLUMNS = """l.version, r.period, r.respondent, r.respondent_name, r.type, r.type_name,
              r.value AS value_raw, r.value_units"""
_LANDED_ROWS = """
            SELECT {columns}
            FROM (
              SELECT 'first' AS delivery, * FROM records_first
              UNION ALL SELECT 'all', * FROM records_all) AS r
            JOIN (
              SELECT 'first' AS delivery, date, respondent, 'canonical' AS version FROM days_first
              UNION ALL SELECT 'all', date, respondent,
                CASE status WHEN 'NEW' THEN 'canonical' ELSE 'revision_' || fingerprint END
              FROM classified WHERE status <> 'UNCHANGED') AS l
            ON l.delivery = r.delivery AND l.date = r.date AND l.respondent = r.respondent{joined}"""
_TRAILING = """
            SELECT respondent, window_days, first_date, last_date, hour_count,
              hour_count = window_days * 24 AS is_covered, total_energy_mwh, peak_demand_mwh,
              abs_error / hour_count AS mae_mwh,
              100.0 * (1.0 - abs_error / total_energy_mwh) AS accuracy_pct
            FROM (
              SELECT d.respondent, s.window_days, min(d.date) AS first_date, max(d.date) AS last_date,
                CAST(sum(d.hours) AS BIGINT) AS hour_count,
                CAST(sum(d.energy) AS DOUBLE) AS total_energy_mwh, max(d.peak) AS peak_demand_mwh,
                CAST(sum(d.abs_error) AS DOUBLE) AS abs_error
              FROM ranked_days d JOIN spans s ON d.day_rank <= s.window_days
              GROUP BY d.respondent, s.window_days) AS sums"""


def queries() -> dict[str, str]:
    return {name: _q(text.strip()) for name, text in _strings().items()}
