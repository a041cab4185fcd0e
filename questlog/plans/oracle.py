"""DuckDB SQL giving the result each named query must have on the sample tables."""

from __future__ import annotations

_TELEMETRY = """
renamed AS (
  SELECT event_id, user_id, value, ts,
    CASE
      WHEN event_type = 'view' THEN 'app_open'
      WHEN event_type = 'click' THEN 'level_progress'
      WHEN event_type = 'purchase' AND user_id % 3 = 0 THEN 'purchase'
      ELSE 'app_close'
    END AS event_name,
    CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_seconds(
      (hour(ts) * 3600 + minute(ts) * 60 + second(ts)) // 24
      + CASE WHEN user_id % 3 = 0 THEN 84600 ELSE 0 END) AS client_time
  FROM events
),
delivered AS (
  SELECT *, [0, 0, 0, 0, 0, 0, 0, 1, 2, 6, 26][event_id % 11 + 1] AS lag_hours FROM renamed
  UNION ALL
  SELECT *, 26 FROM renamed WHERE event_id % 67 = 0
),
raw AS (
  SELECT
    CAST(event_id AS VARCHAR) AS event_id,
    event_name,
    CASE WHEN event_id % 401 <> 0 THEN strftime(client_time, '%Y-%m-%d %H:%M:%S') END
      AS client_event_time,
    CAST(user_id + CASE WHEN user_id % 31 = 7 THEN 1000000000 ELSE 0 END AS VARCHAR) AS userid,
    CASE WHEN event_id % 200 = 0 THEN NULL
         WHEN user_id % 5 < 2 THEN 'ios' ELSE 'android' END AS platform,
    CASE WHEN event_id % 211 <> 0 THEN
      ['US', 'GB', 'CA', 'AU', 'DE', 'FR', 'BR', 'IN', 'JP', 'KR', 'MX', 'SE'][user_id % 12 + 1]
    END AS country,
    CASE WHEN event_id % 97 <> 0 THEN
      ['1.44.0', '1.44.1', '1.45.0', '1.46.0', '1.46.2'][(day(ts) // 7 + user_id) % 5 + 1]
    END AS app_version,
    'dev-' || user_id AS device_id,
    CASE WHEN event_name = 'level_progress' AND user_id % 25 <> 24
      THEN CAST(floor(value / 10) AS BIGINT) || '.0' END AS rounds_completed,
    CASE WHEN event_name = 'purchase' THEN CAST(value AS VARCHAR) END AS revenue_usd,
    CASE WHEN event_name = 'purchase' THEN
      ['gems_small', 'gems_medium', 'gems_large', 'gems_mega', 'gold_pass',
       'unlimited_lives_bundle'][event_id % 6 + 1]
    END AS product_id,
    CASE WHEN event_name = 'purchase' THEN 'USD' END AS currency,
    'bronze_landing/events_' || CAST(client_time + to_hours(lag_hours) AS DATE) || '.csv'
      AS filename,
    'events_' || CAST(client_time + to_hours(lag_hours) AS DATE) || '.csv' AS _source_file
  FROM delivered
)"""

_ASSIGNED = """
assigned AS (
  SELECT
    CAST(c_custkey AS VARCHAR) AS userid,
    CASE c_custkey % 2 WHEN 0 THEN 'gate_30' ELSE 'gate_40' END AS version,
    CAST(c_custkey % 50 AS VARCHAR) AS sum_gamerounds,
    CAST(c_custkey % 20 < 9 AS VARCHAR) AS retention_1,
    CAST(c_custkey % 20 < 4 AS VARCHAR) AS retention_7,
    'raw/assignments.csv' AS filename,
    'assignments.csv' AS _source_file
  FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 97 = 5)
)"""

_CLEAN = """
clean AS (
  SELECT * EXCLUDE (_source_file) FROM (
    SELECT event_id, event_name, strptime(client_event_time, '%Y-%m-%d %H:%M:%S') AS event_time,
      CAST(left(client_event_time, 10) AS DATE) AS event_date,
      CAST(userid AS BIGINT) AS userid,
      ifnull(platform, 'unknown') AS platform, ifnull(country, 'unknown') AS country,
      app_version, device_id,
      TRY_CAST(rounds_completed AS INTEGER) AS rounds_completed,
      TRY_CAST(revenue_usd AS DOUBLE) AS revenue_usd,
      product_id, currency, _source_file
    FROM raw
  )
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_time, _source_file,
    event_name, event_date, userid, platform, country, app_version, device_id,
    rounds_completed, revenue_usd, product_id, currency) = 1
)"""

_SESSIONS = """
gaps AS (
  SELECT *, substr(md5(event_id), 1, 15) AS place, epoch_us(event_time) // 60000000 AS minute,
    lag(minute) OVER (PARTITION BY userid ORDER BY event_time, place, event_id) AS previous
  FROM clean
),
in_session AS (
  SELECT *, sum(CASE WHEN previous IS NULL OR minute - previous > 30 THEN 1 ELSE 0 END) OVER (
    PARTITION BY userid ORDER BY event_time, place, event_id ROWS UNBOUNDED PRECEDING) AS seq
  FROM gaps
),
sess AS (
  SELECT
    concat_ws('-', userid, CAST(seq AS BIGINT)) AS session_id,
    userid,
    min(event_time) AS session_start,
    max(event_time) AS session_end,
    epoch_us(max(event_time)) // 1000000 - epoch_us(min(event_time)) // 1000000
      AS session_duration_seconds,
    CAST(min(event_time) AS DATE) AS session_date,
    count(*) AS event_count,
    CAST(ifnull(sum(rounds_completed), 0) AS BIGINT) AS rounds_played,
    CAST(ifnull(sum(CAST(revenue_usd AS DECIMAL(28, 6))), 0) AS DOUBLE) AS revenue_usd,
    count(*) FILTER (WHERE event_name = 'purchase') AS purchase_count,
    first(platform ORDER BY event_time, platform) FILTER (WHERE platform IS NOT NULL) AS platform,
    first(country ORDER BY event_time, country) FILTER (WHERE country IS NOT NULL) AS country,
    first(app_version ORDER BY event_time, app_version) FILTER (WHERE app_version IS NOT NULL)
      AS app_version
  FROM in_session
  GROUP BY userid, seq
)"""

_USERS = """
attrs AS (
  SELECT u.userid, u.install_date, p.platform, c.country, u.latest_app_version
  FROM (SELECT userid, min(event_date) AS install_date, max(app_version) AS latest_app_version
        FROM clean GROUP BY ALL) u
  JOIN (SELECT userid, platform FROM clean GROUP BY userid, platform
        QUALIFY row_number() OVER (PARTITION BY userid ORDER BY count(*) DESC, platform) = 1) p
    USING (userid)
  JOIN (SELECT userid, country FROM clean GROUP BY userid, country
        QUALIFY row_number() OVER (PARTITION BY userid ORDER BY count(*) DESC, country) = 1) c
    USING (userid)
),
recomputed AS (
  SELECT userid,
    CAST(sum(rounds_played) AS BIGINT) AS event_derived_rounds,
    CAST(bool_or(session_date - install_date = 1) AS INTEGER) AS event_derived_retention_1,
    CAST(bool_or(session_date - install_date = 7) AS INTEGER) AS event_derived_retention_7
  FROM attrs JOIN sess USING (userid)
  GROUP BY userid
),
dim AS (
  SELECT r.userid, r.ab_version, r.real_sum_gamerounds, r.real_retention_1, r.real_retention_7,
    a.install_date, a.platform, a.country, a.latest_app_version,
    ifnull(m.event_derived_rounds, 0) AS event_derived_rounds,
    ifnull(m.event_derived_retention_1, 0) > 0 AS event_derived_retention_1,
    ifnull(m.event_derived_retention_7, 0) > 0 AS event_derived_retention_7
  FROM (SELECT CAST(userid AS BIGINT) AS userid, version AS ab_version,
          CAST(sum_gamerounds AS INTEGER) AS real_sum_gamerounds,
          CAST(retention_1 AS BOOLEAN) AS real_retention_1,
          CAST(retention_7 AS BOOLEAN) AS real_retention_7
        FROM assigned) r
  LEFT JOIN attrs a USING (userid)
  LEFT JOIN recomputed m USING (userid)
)"""

_DAYS = """
cohorts AS (SELECT ab_version, count(*) AS cohort_users FROM dim GROUP BY ab_version),
days AS (
  SELECT dim.*, sess.session_date, sess.revenue_usd, sess.rounds_played, sess.purchase_count,
    sess.session_date - dim.install_date AS day_since_install
  FROM dim JOIN sess USING (userid)
)"""

_MONEY = """
spend AS (
  SELECT dim.userid, dim.ab_version, dim.platform, dim.country,
    sum(CAST(sess.revenue_usd AS DECIMAL(28, 6))) AS revenue,
    CAST(ifnull(sum(sess.purchase_count), 0) AS BIGINT) AS total_purchases
  FROM dim LEFT JOIN sess USING (userid)
  GROUP BY ALL
),
slices AS (
  SELECT ab_version, platform, country, users, paying_users,
    round(CAST(paying_users AS DOUBLE) / users, 4) AS conversion_rate,
    round(revenue, 2) AS total_revenue_usd,
    round(revenue / users, 4) AS arpu_usd,
    CASE WHEN paying_users > 0 THEN round(revenue / paying_users, 4) END AS arppu_usd
  FROM (SELECT ab_version, platform, country, count(*) AS users,
          count(*) FILTER (WHERE total_purchases > 0) AS paying_users,
          CAST(ifnull(sum(revenue), 0) AS DOUBLE) AS revenue
        FROM spend GROUP BY ALL)
)"""

_SEGMENTS = """
segments AS (
  SELECT userid, ab_version, platform, country, event_derived_rounds,
    rank() OVER (ORDER BY event_derived_rounds DESC) AS engagement_rank,
    CASE WHEN event_derived_rounds = 0 THEN 'non_activated'
      ELSE ['casual', 'regular', 'core', 'power_user'][
        ntile(4) OVER (ORDER BY event_derived_rounds, userid)] END AS engagement_segment
  FROM dim
)"""

_RATES = """
rates AS (
  SELECT ab_version, count(*) AS users,
    round(avg(CASE WHEN real_retention_1 THEN 1e0 ELSE 0e0 END), 4) AS real_retention_1_rate,
    round(avg(CASE WHEN event_derived_retention_1 THEN 1e0 ELSE 0e0 END), 4)
      AS event_derived_retention_1_rate,
    round(avg(CASE WHEN real_retention_7 THEN 1e0 ELSE 0e0 END), 4) AS real_retention_7_rate,
    round(avg(CASE WHEN event_derived_retention_7 THEN 1e0 ELSE 0e0 END), 4)
      AS event_derived_retention_7_rate
  FROM dim GROUP BY ab_version
)"""

_CHECKS = """
checks AS (
  SELECT 'assigned_users_preserved' AS check_name, l = r AS passed,
    format('assignments={} users={}', l, r) AS detail
  FROM (SELECT (SELECT count(*) FROM assigned) AS l, (SELECT count(*) FROM dim) AS r)
  UNION ALL
  SELECT 'dedup_removed_rows', l > r, format('raw={} clean={}', l, r)
  FROM (SELECT (SELECT count(*) FROM raw) AS l, (SELECT count(*) FROM clean) AS r)
  UNION ALL
  SELECT 'event_ids_unique', n = 0, format('duplicated={}', n)
  FROM (SELECT count(*) AS n
        FROM (SELECT event_id FROM clean GROUP BY event_id HAVING count(*) > 1))
  UNION ALL
  SELECT 'd1_retention_within_5pp[' || ab_version || ']',
    abs(real_retention_1_rate - event_derived_retention_1_rate) < 0.05,
    format('published={:.4f} derived={:.4f}',
      real_retention_1_rate, event_derived_retention_1_rate)
  FROM rates
  UNION ALL
  SELECT 'd7_retention_within_5pp[' || ab_version || ']',
    abs(real_retention_7_rate - event_derived_retention_7_rate) < 0.05,
    format('published={:.4f} derived={:.4f}',
      real_retention_7_rate, event_derived_retention_7_rate)
  FROM rates
  UNION ALL
  SELECT 'no_orphan_sessions', n = 0, format('orphans={}', n)
  FROM (SELECT count(*) AS n FROM sess ANTI JOIN dim USING (userid))
)"""

_STEPS = [
    _TELEMETRY,
    _ASSIGNED,
    _CLEAN,
    _SESSIONS,
    _USERS,
    _DAYS,
    _MONEY,
    _SEGMENTS,
    _RATES,
    _CHECKS,
]


def _sql(select: str, last: str) -> str:
    """``select`` over every step up to and including ``last``."""
    steps = _STEPS[: _STEPS.index(last) + 1]
    return "WITH " + ",".join(steps) + "\n" + select.strip()


_EVENT_COLUMNS = """event_id, event_name, client_event_time, userid, platform, country,
  app_version, device_id, rounds_completed, revenue_usd, product_id, currency"""

ORACLE_SQL: dict[str, str] = {
    "raw_events": _sql("SELECT * FROM raw", _TELEMETRY),
    "raw_experiment_assignments": _sql("SELECT * FROM assigned", _ASSIGNED),
    "bronze_row_counts": _sql(
        """
SELECT 'bronze.raw_events' AS table_name, count(*) AS row_count FROM raw
UNION ALL SELECT 'bronze.raw_experiment_assignments', count(*) FROM assigned""",
        _ASSIGNED,
    ),
    "csv_union_by_name": _sql(
        f"""
SELECT {_EVENT_COLUMNS}, CASE WHEN event_name = 'purchase' THEN 'purchases' ELSE 'others' END AS kind,
  _source_file AS drop_file, true AS file_is_last_part
FROM raw""",
        _TELEMETRY,
    ),
    "events_clean": _sql("SELECT * FROM clean", _CLEAN),
    "sessions": _sql("SELECT * FROM sess", _SESSIONS),
    # the built-in window leaves out events without a time
    "sessions_by_session_window": _sql(
        "SELECT * EXCLUDE (session_id) FROM sess", _SESSIONS
    ).replace("FROM clean\n),\nin_session", "FROM clean WHERE event_time IS NOT NULL\n),\nin_session"),
    "user_attrs": _sql("SELECT * FROM attrs", _USERS),
    "recomputed_metrics": _sql("SELECT * FROM recomputed", _USERS),
    "users_dim": _sql("SELECT * FROM dim", _USERS),
    "silver_row_counts": _sql(
        """
SELECT 'silver.events_clean' AS table_name, count(*) AS row_count FROM clean
UNION ALL SELECT 'silver.sessions', count(*) FROM sess
UNION ALL SELECT 'silver.users_dim', count(*) FROM dim""",
        _USERS,
    ),
    "mart_retention_curve": _sql(
        """
SELECT ab_version, day_since_install, active_users, cohort_users,
  round(rate, 4) AS retention_rate,
  round(avg(rate) OVER (PARTITION BY ab_version ORDER BY day_since_install
    ROWS 2 PRECEDING), 4) AS retention_rate_3day_trailing_avg
FROM (
  SELECT ab_version, day_since_install, count(DISTINCT userid) AS active_users, cohort_users,
    CAST(active_users AS DOUBLE) / cohort_users AS rate
  FROM days JOIN cohorts USING (ab_version)
  WHERE day_since_install >= 0 AND day_since_install <= 13
  GROUP BY ab_version, day_since_install, cohort_users)
ORDER BY ALL""",
        _DAYS,
    ),
    "mart_retention_validation": _sql("SELECT * FROM rates ORDER BY ab_version", _RATES),
    "user_revenue": _sql(
        """
SELECT userid, ab_version, platform, country,
  CAST(ifnull(revenue, 0) AS DOUBLE) AS total_revenue, total_purchases
FROM spend""",
        _MONEY,
    ),
    "mart_monetization_summary": _sql("SELECT * FROM slices ORDER BY ALL", _MONEY),
    "monetization_preview": _sql(
        "SELECT * FROM slices ORDER BY ab_version, platform, country LIMIT 10", _MONEY
    ),
    "mart_ltv_curve": _sql(
        """
SELECT ab_version, day_since_install,
  round(CAST(spent AS DOUBLE), 2) AS revenue_that_day,
  round(CAST(running AS DOUBLE), 2) AS cumulative_revenue,
  round(CAST(running AS DOUBLE) / cohort_users, 4) AS cumulative_ltv_per_user
FROM (
  SELECT ab_version, day_since_install, sum(CAST(revenue_usd AS DECIMAL(28, 6))) AS spent,
    sum(sum(CAST(revenue_usd AS DECIMAL(28, 6)))) OVER (
      PARTITION BY ab_version ORDER BY day_since_install ROWS UNBOUNDED PRECEDING) AS running
  FROM days WHERE day_since_install >= 0 AND day_since_install <= 13
  GROUP BY ab_version, day_since_install)
JOIN cohorts USING (ab_version)
ORDER BY ALL""",
        _DAYS,
    ),
    "mart_engagement_segments": _sql("SELECT * FROM segments", _SEGMENTS),
    "top_players": _sql(
        "SELECT * EXCLUDE (engagement_segment) FROM segments WHERE engagement_rank <= 20",
        _SEGMENTS,
    ),
    "mart_engagement_segment_summary": _sql(
        """
SELECT engagement_segment, count(*) AS users, round(avg(event_derived_rounds), 1) AS avg_rounds
FROM segments GROUP BY ALL ORDER BY avg_rounds""",
        _SEGMENTS,
    ),
    "mart_ab_test_readout": _sql(
        """
SELECT ab_version, rates.users, real_retention_1_rate, real_retention_7_rate,
  round(CAST(sum(CAST(slices.users * conversion_rate AS DECIMAL(28, 6))) AS DOUBLE)
    / sum(slices.users), 4) AS conversion_rate,
  round(CAST(sum(CAST(total_revenue_usd AS DECIMAL(28, 6))) AS DOUBLE)
    / sum(slices.users), 4) AS arpu_usd,
  CASE WHEN sum(paying_users) > 0 THEN
    round(CAST(sum(CAST(total_revenue_usd AS DECIMAL(28, 6))) AS DOUBLE)
      / sum(paying_users), 4) END AS arppu_usd
FROM rates JOIN slices USING (ab_version)
GROUP BY ab_version, rates.users, real_retention_1_rate, real_retention_7_rate
ORDER BY ab_version""",
        _RATES,
    ),
    "dq_checks": _sql("SELECT * FROM checks", _CHECKS),
    "dq_verdict": _sql(
        """
SELECT bool_and(passed) AS all_passed, count(*) FILTER (WHERE NOT passed) AS failed_checks
FROM checks""",
        _CHECKS,
    ),
    "dq_orphan_sessions": _sql(
        """
SELECT userid, count(*) AS sessions FROM sess ANTI JOIN dim USING (userid) GROUP BY userid""",
        _USERS,
    ),
    "dq_duplicate_assignments": _sql(
        """
SELECT userid, count(*) AS row_count FROM assigned GROUP BY userid HAVING count(*) > 1""",
        _ASSIGNED,
    ),
    "engagement_percentile": _sql(
        """
SELECT userid, event_derived_rounds,
  (rank() OVER (ORDER BY event_derived_rounds)
   + (count(*) OVER (PARTITION BY event_derived_rounds) - 1) / 2e0)
  / (SELECT count(*) FROM dim) AS engagement_percentile
FROM dim""",
        _USERS,
    ),
    "late_arrival_profile": _sql(
        """
SELECT CAST(substr(_source_file, 8, 10) AS DATE) AS drop_date,
  drop_date - CAST(left(client_event_time, 10) AS DATE) AS days_late, count(*) AS row_count
FROM raw GROUP BY ALL""",
        _TELEMETRY,
    ),
    "duplicate_delivery_profile": _sql(
        """
SELECT copies, count(*) AS events, copies * count(*) AS delivered_rows,
  round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 4) AS event_share,
  round(CAST(copies * count(*) AS DOUBLE) / sum(copies * count(*)) OVER (), 4) AS row_share
FROM (SELECT event_id, count(*) AS copies FROM raw GROUP BY event_id)
GROUP BY copies""",
        _TELEMETRY,
    ),
    "missing_metadata_profile": _sql(
        f"""
SELECT _source_file, count(*) AS row_count, column_name,
  count(*) FILTER (WHERE value IS NULL) AS null_count,
  round(CAST(null_count AS DOUBLE) / row_count, 4) AS null_share
FROM (SELECT _source_file, {_EVENT_COLUMNS} FROM raw)
  UNPIVOT INCLUDE NULLS (value FOR column_name IN ({_EVENT_COLUMNS}))
GROUP BY _source_file, column_name""",
        _TELEMETRY,
    ),
    "cohort_heatmap": _sql(
        """
SELECT install_week, day_since_install, active_users, cohort_users,
  round(CAST(active_users AS DOUBLE) / cohort_users, 4) AS retention_rate
FROM (SELECT CAST(date_trunc('week', install_date) AS DATE) AS install_week, day_since_install,
        count(DISTINCT userid) AS active_users
      FROM days WHERE day_since_install IS NOT NULL GROUP BY ALL)
JOIN (SELECT CAST(date_trunc('week', install_date) AS DATE) AS install_week,
        count(DISTINCT userid) AS cohort_users
      FROM dim WHERE install_date IS NOT NULL GROUP BY ALL) USING (install_week)
ORDER BY ALL""",
        _DAYS,
    ),
    "scd2_user_history": _sql(
        """
SELECT userid, CAST(version_no AS BIGINT) AS version_no, platform, app_version, valid_from,
  valid_to, valid_to IS NULL AS is_current
FROM (
  SELECT userid, version_no, platform, app_version, min(event_date) AS valid_from,
    lead(min(event_date)) OVER (PARTITION BY userid ORDER BY version_no) - 1 AS valid_to
  FROM (
    SELECT *, sum(CAST(platform IS DISTINCT FROM p0 OR app_version IS DISTINCT FROM v0
        OR d0 IS NULL AS INTEGER)) OVER (PARTITION BY userid ORDER BY event_date) AS version_no
    FROM (
      SELECT *, lag(platform) OVER w AS p0, lag(app_version) OVER w AS v0,
        lag(event_date) OVER w AS d0
      FROM (
        SELECT userid, event_date,
          last(platform ORDER BY event_time, platform)
            FILTER (WHERE platform IS NOT NULL) AS platform,
          last(app_version ORDER BY event_time, app_version)
            FILTER (WHERE app_version IS NOT NULL) AS app_version
        FROM clean WHERE event_time IS NOT NULL GROUP BY userid, event_date)
      WINDOW w AS (PARTITION BY userid ORDER BY event_date)))
  GROUP BY userid, version_no, platform, app_version)""",
        _CLEAN,
    ),
    "churn_features": _sql(
        """
SELECT userid, install_date,
  count(DISTINCT session_date) FILTER (WHERE early) AS active_days,
  count(*) FILTER (WHERE early) AS sessions,
  CAST(ifnull(sum(rounds_played) FILTER (WHERE early), 0) AS BIGINT) AS rounds_played,
  CAST(ifnull(sum(purchase_count) FILTER (WHERE early), 0) AS BIGINT) AS purchases,
  CAST(ifnull(sum(CAST(revenue_usd AS DECIMAL(28, 6))) FILTER (WHERE early), 0) AS DOUBLE)
    AS revenue_usd,
  max(day_since_install) FILTER (WHERE early) AS last_active_day,
  count(*) FILTER (WHERE day_since_install BETWEEN 7 AND 13) = 0 AS churned
FROM (SELECT *, session_date - install_date AS day_since_install,
        day_since_install BETWEEN 0 AND 6 AS early
      FROM (SELECT DISTINCT userid, install_date FROM dim) JOIN sess USING (userid))
GROUP BY userid, install_date""",
        _DAYS,
    ),
    "stream_incremental_load": _sql(f"SELECT {_EVENT_COLUMNS} FROM raw", _TELEMETRY),
    "stream_dedup": _sql("SELECT * FROM clean", _CLEAN),
    "stream_sessions": _sql("SELECT * FROM sess", _SESSIONS),
}

_ASSIGNMENT_COLUMNS = "* EXCLUDE (filename, _source_file)"
ORACLE_SQL["csv_single_export"] = _sql(
    f"""
SELECT {_ASSIGNMENT_COLUMNS}, true AS file_is_in_folder, true AS file_is_last_part, true AS stamped_by_load
FROM assigned""",
    _ASSIGNED,
)
ORACLE_SQL["csv_quoted_fields"] = _sql(
    f"""
SELECT {_EVENT_COLUMNS.replace("device_id", "'a \"b\", ' || device_id || chr(10) || 'c' AS device_id")}
FROM raw""",
    _TELEMETRY,
)

# The query that makes the rows of each table of a build.
_MADE_BY = {
    "bronze.raw_events": "raw_events",
    "bronze.raw_experiment_assignments": "raw_experiment_assignments",
    "silver.events_clean": "events_clean",
    "silver.sessions": "sessions",
    "silver.users_dim": "users_dim",
    "gold.mart_retention_curve": "mart_retention_curve",
    "gold.mart_retention_validation": "mart_retention_validation",
    "gold.mart_monetization_summary": "mart_monetization_summary",
    "gold.mart_ltv_curve": "mart_ltv_curve",
    "gold.mart_engagement_segments": "mart_engagement_segments",
    "gold.mart_engagement_segment_summary": "mart_engagement_segment_summary",
    "gold.mart_ab_test_readout": "mart_ab_test_readout",
    "gold.data_quality_checks": "dq_checks",
}
ORACLE_SQL["warehouse_build"] = "\nUNION ALL\n".join(
    f"SELECT '{table}' AS table_name, count(*) AS row_count FROM ({ORACLE_SQL[key]})"
    for table, key in _MADE_BY.items()
)
