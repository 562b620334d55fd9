"""Reference SQL for every catalog entry, runnable by DuckDB over the same
parquet tables (registered as views named after the tables).

The SQL follows the plain row-by-row definitions (per-user LAG for sessions,
ROW_NUMBER / RANK windows, ORDER BY ... LIMIT), independent of the Spark
plans.  Rounded values use integer arithmetic so both sides agree exactly;
floating moments are compared at 6 digits.
"""

from __future__ import annotations

from actlens.functions import labels as L
from actlens.plans import catalog as C

_GAP_US = 12 * 3600 * 1_000_000


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


BASE = f"""
ev AS (
  SELECT * FROM (
    SELECT event_id, ts, CAST(user_id AS VARCHAR) AS user_id,
           CASE WHEN event_type = 'click' THEN 'cart' ELSE event_type END AS action,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events
    WHERE event_id IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL
      AND props IS NOT NULL)
  WHERE k IS NOT NULL
),
act AS (
  SELECT event_id, user_id, action,
         'C' || CAST((k % 6 + 6) % 6 AS VARCHAR) AS category,
         'P' || CAST(k AS VARCHAR) AS product_id,
         ts AS time,
         CAST(hour(ts) AS INTEGER) AS hour,
         dayname(ts) AS day_of_week,
         CASE (k % 3 + 3) % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device,
         k
  FROM ev
),
gaps AS (
  SELECT *, CASE WHEN prev IS NULL OR epoch_us(time) - epoch_us(prev) > {_GAP_US} THEN 1 ELSE 0 END AS new_s
  FROM (SELECT *, lag(time) OVER (PARTITION BY user_id ORDER BY time, event_id) AS prev FROM act)
),
sess AS (
  SELECT event_id, user_id,
         user_id || '-' || CAST(sum(new_s) OVER (PARTITION BY user_id ORDER BY time, event_id
                                                 ROWS UNBOUNDED PRECEDING) AS VARCHAR) AS session_id,
         action, category, product_id, time, hour, day_of_week, device, k
  FROM gaps
),
actw AS (
  SELECT *, CAST(date_trunc('week', time) AS DATE) AS week FROM act
),
beh AS (
  SELECT user_id, week,
         count(*) FILTER (WHERE action = 'view') AS views,
         count(*) FILTER (WHERE action = 'cart') AS carts,
         count(*) FILTER (WHERE action = 'purchase') AS purchases,
         count(*) AS total_actions
  FROM actw GROUP BY user_id, week
),
ratio AS (
  SELECT *, CASE WHEN purchases = 0 THEN CAST(views AS DOUBLE)
                 ELSE CAST((views * 100 * 2 + purchases) // (2 * purchases) AS DOUBLE) / 100 END
            AS view_purchase_ratio
  FROM beh
),
prof AS (
  SELECT *, CASE WHEN views >= {L.MIN_VIEWS_NO_PURCHASE} AND purchases = 0 THEN {_q(L.FLAG_HIGH)}
                 WHEN view_purchase_ratio > {L.MAX_VIEW_RATIO} AND purchases > 0 THEN {_q(L.FLAG_MODERATE)}
                 ELSE {_q(L.FLAG_NORMAL)} END AS anomaly_flag
  FROM ratio
),
ubeh AS (
  SELECT user_id,
         count(*) FILTER (WHERE action = 'view') AS views,
         count(*) FILTER (WHERE action = 'cart') AS carts,
         count(*) FILTER (WHERE action = 'purchase') AS purchases,
         count(*) AS total_actions
  FROM act GROUP BY user_id
),
uprof AS (
  SELECT *, CASE WHEN views >= {L.MIN_VIEWS_NO_PURCHASE} AND purchases = 0 THEN {_q(L.FLAG_HIGH)}
                 WHEN view_purchase_ratio > {L.MAX_VIEW_RATIO} AND purchases > 0 THEN {_q(L.FLAG_MODERATE)}
                 ELSE {_q(L.FLAG_NORMAL)} END AS anomaly_flag
  FROM (SELECT *, CASE WHEN purchases = 0 THEN CAST(views AS DOUBLE)
                       ELSE CAST((views * 100 * 2 + purchases) // (2 * purchases) AS DOUBLE) / 100 END
                  AS view_purchase_ratio FROM ubeh)
),
thr AS (
  SELECT avg(views) AS mean_views, stddev_samp(views) AS std_views,
         avg(views) + {L.STDDEV_K} * stddev_samp(views) AS threshold
  FROM prof
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY session_id, user_id ORDER BY time, event_id) AS pos FROM sess
)
"""


def _sql(body: str, extra_ctes: str = "") -> str:
    """The base CTEs, optional extra CTEs (``name AS (...)`` pairs, comma
    separated), then the final SELECT."""
    ctes = BASE.strip() + (",\n" + extra_ctes.strip() if extra_ctes else "")
    return "WITH " + ctes + "\n" + body.strip()


def _pct(n: str, total: str, digits: int = 2) -> str:
    scale = 10 ** digits
    return f"CAST(({n} * {100 * scale} * 2 + {total}) // (2 * {total}) AS DOUBLE) / {scale}"


def _half_even(num: str, den: str) -> str:
    q = f"(({num}) // ({den}))"
    r2 = f"((({num}) % ({den})) * 2)"
    return f"CASE WHEN {den} = 0 THEN NULL ELSE {q} + CASE WHEN {r2} > {den} OR ({r2} = {den} AND {q} % 2 = 1) THEN 1 ELSE 0 END END"


def _sel(where: dict) -> str:
    conds = []
    for col, key in (("action", "actions"), ("category", "categories"), ("device", "devices")):
        vals = where.get(key)
        if vals is not None:
            conds.append(f"{col} IN {_in(vals)}" if vals else "FALSE")
    if where.get("term"):
        conds.append(f"regexp_matches(user_id, {_q(where['term'].upper())})")
    return " AND ".join(conds) if conds else "TRUE"


_ACTIVITY_OUT = "user_id, session_id, action, category, product_id, time, hour, day_of_week, device"
_PROFILE_COLS = "user_id, week, views, carts, purchases, total_actions, view_purchase_ratio, anomaly_flag"

_SCHEMA_ROWS = [
    (1, "user_id", "string"), (2, "session_id", "string"), (3, "action", "string"), (4, "category", "string"),
    (5, "product_id", "string"), (6, "time", "timestamp_ntz"), (7, "hour", "int"), (8, "day_of_week", "string"),
    (9, "device", "string"),
]


def _describe_sql() -> str:
    text = ["user_id", "session_id", "action", "category", "product_id", "day_of_week", "device"]
    text_long = " UNION ALL ".join(f"SELECT {_q(c)} AS column_name, {c} AS value FROM sess" for c in text)
    num_long = (
        "SELECT 'time' AS column_name, epoch_us(time) / 1000000.0 AS value, epoch_us(time) AS micros FROM sess "
        "UNION ALL SELECT 'hour', CAST(hour AS DOUBLE), NULL FROM sess"
    )
    ctes = f"""
tl AS ({text_long}),
tv AS (SELECT column_name, value, count(*) AS n FROM tl WHERE value IS NOT NULL GROUP BY ALL),
tstat AS (
  SELECT column_name, CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
         arg_min(value, (-n, value)) AS top, CAST(max(n) AS BIGINT) AS freq
  FROM tv GROUP BY column_name
),
nl AS ({num_long}),
nstat AS (
  SELECT column_name, count(value) AS count,
         CASE WHEN column_name = 'time'
              THEN CAST((2 * sum(CAST(micros AS HUGEINT)) + count(value)) // (2 * count(value)) AS DOUBLE) / 1000000
              ELSE avg(value) END AS mean,
         CASE WHEN column_name = 'time' THEN NULL ELSE stddev_samp(value) END AS std,
         min(value) AS min, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50,
         quantile_cont(value, 0.75) AS p75, max(value) AS max
  FROM nl GROUP BY column_name
)"""
    body = """
SELECT column_name, count, "unique", top, freq,
       CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min,
       CAST(NULL AS DOUBLE) AS p25, CAST(NULL AS DOUBLE) AS p50, CAST(NULL AS DOUBLE) AS p75,
       CAST(NULL AS DOUBLE) AS max
FROM tstat
UNION ALL
SELECT column_name, count, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT),
       round(mean, 6), round(std, 6), round(min, 6), round(p25, 6), round(p50, 6), round(p75, 6), round(max, 6)
FROM nstat
"""
    return _sql(body, ctes)


def reach(prof: str, name: str) -> str:
    return f"""
  SELECT 1 AS step, {_q(L.REACH_VIEWED)} AS stage, count(*) FILTER (WHERE views > 0) AS {name} FROM {prof}
  UNION ALL SELECT 2, {_q(L.REACH_CARTED)}, count(*) FILTER (WHERE carts > 0) FROM {prof}
  UNION ALL SELECT 3, {_q(L.REACH_PURCHASED)}, count(*) FILTER (WHERE purchases > 0) FROM {prof}"""


def _describe_missing_sql() -> str:
    number = lambda c: f"""SELECT {_q(c)} AS column_name, count({c}) AS count, CAST(NULL AS BIGINT) AS "unique",
        CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM t"""  # noqa: E731
    none = ", ".join(["CAST(NULL AS DOUBLE)"] * 7)
    text = lambda c: f"""SELECT {_q(c)}, count({c}), count(DISTINCT {c}),
        (SELECT {c} FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1),
        (SELECT count(*) FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1), {none} FROM t"""  # noqa: E731
    ctes = """t AS (SELECT event_id, action, hour, CAST(NULL AS VARCHAR) AS coupon, CAST(NULL AS INTEGER) AS discount FROM act)"""
    return _sql(" UNION ALL ".join([number("event_id"), number("hour"), number("discount"), text("action"), text("coupon")]), ctes)


def oracle_sql() -> dict[str, str]:
    nullcat = f"CASE WHEN k % {C.NULL_CATEGORY_MOD} = 0 THEN NULL ELSE category END"
    filt = _sel(dict(actions=C.FILTER_ACTIONS, categories=C.FILTER_CATEGORIES, devices=C.FILTER_DEVICES))
    schema_values = ", ".join(f"({i}, {_q(n)}, {_q(t)})" for i, n, t in _SCHEMA_ROWS)
    sep = _q(L.SEQUENCE_SEP)

    def segments(size):
        return f"""SELECT session_id, user_id, CAST((pos - 1) // {size} AS BIGINT) AS segment, min(pos) AS first_position,
                 string_agg(action, {sep} ORDER BY pos) AS action_sequence FROM ordered
                 GROUP BY session_id, user_id, (pos - 1) // {size}"""

    def summary(prof, unit, more=""):
        flagged = f"count(*) FILTER (WHERE anomaly_flag <> {_q(L.FLAG_NORMAL)})"
        return f"""SELECT (SELECT count(*) FROM sess) AS total_events,
                 (SELECT count(DISTINCT user_id) FROM sess) AS total_users,
                 (SELECT count(DISTINCT session_id) FROM sess) AS total_sessions,
                 (SELECT count(*) FILTER (WHERE anomaly_flag = {_q(L.FLAG_NORMAL)}) FROM {prof}) AS normal_{unit},
                 (SELECT {flagged} FROM {prof}) AS anomalous_{unit}, {more}
                 (SELECT {_pct(flagged, "count(*)", 1)} FROM {prof}) AS anomaly_rate,
                 (SELECT hour FROM act GROUP BY hour ORDER BY count(*) DESC, hour LIMIT 1) AS peak_hour,
                 (SELECT day_of_week FROM act GROUP BY day_of_week ORDER BY count(*) DESC, day_of_week LIMIT 1)
                   AS peak_day"""

    def stages(table, name):
        return f"""SELECT funnel_stage, count(*) AS {name} FROM (
                 SELECT CASE WHEN purchases > 0 THEN {_q(L.STAGE_COMPLETE)} WHEN carts > 0 THEN {_q(L.STAGE_PARTIAL)}
                      ELSE {_q(L.STAGE_BROWSE)} END AS funnel_stage FROM {table}) GROUP BY funnel_stage"""

    def percent_initial(prof, name):
        return f"""SELECT step, stage, {name},
                 {_pct(name, f'(SELECT count(*) FILTER (WHERE views > 0) FROM {prof})')} AS percent_initial
                 FROM ({reach(prof, name)})"""

    def converted(prof, suffix=""):
        return f"""SELECT viewers AS viewers{suffix}, carters AS carters{suffix}, purchasers AS purchasers{suffix},
                 {_half_even('carters * 100', 'viewers')} AS view_to_cart_rate,
                 {_half_even('purchasers * 100', 'carters')} AS cart_to_purchase_rate
                 FROM (SELECT count(*) FILTER (WHERE views > 0) AS viewers, count(*) FILTER (WHERE carts > 0) AS carters,
                              count(*) FILTER (WHERE purchases > 0) AS purchasers FROM {prof})"""

    def flag_totals(prof, unit):
        flagged = f"count(*) FILTER (WHERE anomaly_flag <> {_q(L.FLAG_NORMAL)})"
        return f"""SELECT {flagged} AS anomalous_{unit},
                 count(*) FILTER (WHERE anomaly_flag = {_q(L.FLAG_NORMAL)}) AS normal_{unit}, count(*) AS total_{unit},
                 {_pct(flagged, "count(*)", 1)} AS anomaly_rate FROM {prof}"""

    q = {
        # sources
        "src_csv_scan": f"SELECT {_ACTIVITY_OUT} FROM sess",
        "src_profile": f"""SELECT CAST(p AS INTEGER) AS position, n AS column_name, t AS data_type,
                 (SELECT count(*) FROM act) AS n_rows, CAST({len(_SCHEMA_ROWS)} AS INTEGER) AS n_columns
                 FROM (VALUES {schema_values}) v(p, n, t)""",
        "sink_csv": f"SELECT {_ACTIVITY_OUT} FROM sess WHERE {_sel(C.EXPORT)}",
        "reuse_cached": """SELECT 'events' AS result, action, count(*) AS n FROM sess GROUP BY action
                 UNION ALL SELECT 'sessions', action, count(DISTINCT session_id) FROM sess GROUP BY action""",
        # preparation
        "prep_timestamp": f"SELECT event_id, CASE WHEN k % {C.MALFORMED_TIME_MOD} = 0 THEN NULL ELSE time END AS time FROM act",
        "prep_drop_nulls": f"""SELECT event_id, user_id, action, category, device, time, hour
                 FROM (SELECT event_id, user_id, action, {nullcat} AS category, device, time, hour FROM act)
                 WHERE category IS NOT NULL""",
        "prep_drop_report": f"""SELECT count(*) AS rows_before, count({nullcat}) AS rows_after,
                 count(*) - count({nullcat}) AS rows_removed FROM act""",
        "prep_calendar": """SELECT event_id, CAST(time AS DATE) AS date, CAST(hour(time) AS INTEGER) AS hour_extracted,
                 CAST(month(time) AS INTEGER) AS month FROM act""",
        "filter_multi": f"SELECT event_id, user_id, action, category, device FROM act WHERE {filt}",
        "filter_domains": """SELECT DISTINCT column_name, value FROM (
                 SELECT 'action' AS column_name, action AS value FROM act
                 UNION ALL SELECT 'category', category FROM act
                 UNION ALL SELECT 'device', device FROM act) WHERE value IS NOT NULL""",
        "user_search": f"SELECT event_id, user_id, action FROM act WHERE regexp_matches(user_id, {_q(C.SEARCH_TERM.upper())})",
        "preview_rows": "SELECT user_id, action, category, hour, device FROM act ORDER BY time, event_id LIMIT 10",
        "filter_coverage": f"SELECT count(*) FILTER (WHERE {_sel(C.COVERAGE)}) AS shown, count(*) AS total FROM act",
        "user_points": "SELECT user_id, week, views, purchases, anomaly_flag, total_actions FROM prof",
        # aggregations
        "action_counts": "SELECT action, count(*) AS total_count FROM act GROUP BY action",
        "action_share": f"""SELECT action, total_count, {_pct('total_count', '(SELECT count(*) FROM act)')} AS percentage
                 FROM (SELECT action, count(*) AS total_count FROM act GROUP BY action)""",
        "hour_counts": "SELECT hour, count(*) AS activity_count FROM act GROUP BY hour",
        "weekday_counts": "SELECT day_of_week, count(*) AS activity_count FROM act GROUP BY day_of_week",
        "category_counts": "SELECT category, count(*) AS interactions FROM act GROUP BY category",
        "device_counts": 'SELECT device, count(*) AS "count" FROM act GROUP BY device',
        "device_share": f"""SELECT device, "count", {_pct('"count"', '(SELECT count(*) FROM act)')} AS percentage
                 FROM (SELECT device, count(*) AS "count" FROM act GROUP BY device)""",
        "user_activity": """SELECT user_id, count(*) AS total_actions, count(DISTINCT session_id) AS total_sessions,
                 count(DISTINCT category) AS categories_browsed FROM sess GROUP BY user_id""",
        "user_behavior": """SELECT user_id, count(*) FILTER (WHERE action = 'view') AS views,
                 count(*) FILTER (WHERE action = 'cart') AS carts,
                 count(*) FILTER (WHERE action = 'purchase') AS purchases, count(*) AS total_actions
                 FROM act GROUP BY user_id""",
        "user_action_matrix": """SELECT user_id, count(*) FILTER (WHERE action = 'view') AS view_count,
                 count(*) FILTER (WHERE action = 'cart') AS cart_count,
                 count(*) FILTER (WHERE action = 'purchase') AS purchase_count FROM act GROUP BY user_id""",
        "views_threshold": """SELECT round(mean_views, 6) AS mean_views, round(std_views, 6) AS std_views,
                 round(threshold, 6) AS threshold FROM thr""",
        "distinct_totals": """SELECT count(DISTINCT user_id) AS total_users, count(DISTINCT session_id) AS total_sessions,
                 count(*) AS total_events FROM sess""",
        "summary_kpis": summary("uprof", "users"),
        "summary_kpis_by_week": summary("prof", "entities", "(SELECT count(*) FROM prof) AS total_entities,"),
        "describe_missing": _describe_missing_sql(),
        "describe_all": _describe_sql(),
        # top-k
        "peak_hour": "SELECT hour, count(*) AS activity_count FROM act GROUP BY hour ORDER BY 2 DESC, 1 LIMIT 1",
        "peak_weekday": """SELECT day_of_week, count(*) AS activity_count FROM act GROUP BY day_of_week
                 ORDER BY 2 DESC, 1 LIMIT 1""",
        "top_action": "SELECT action, count(*) AS total_count FROM act GROUP BY action ORDER BY 2 DESC, 1 LIMIT 1",
        "top_users": """SELECT user_id, count(*) AS total_actions, count(DISTINCT session_id) AS total_sessions,
                 count(DISTINCT category) AS categories_browsed FROM sess GROUP BY user_id
                 ORDER BY total_actions DESC, user_id LIMIT 10""",
        "behavior_report": f"SELECT {_PROFILE_COLS} FROM prof ORDER BY views DESC, user_id, week LIMIT 20",
        "anomaly_report": "SELECT user_id, week, views, carts, purchases, view_purchase_ratio, anomaly_flag FROM prof",
        # session windows
        "session_rank": """SELECT event_id, session_id, rank() OVER (PARTITION BY session_id ORDER BY time) AS action_rank
                 FROM sess""",
        "session_row_number": """SELECT event_id, session_id,
                 row_number() OVER (PARTITION BY session_id ORDER BY time, event_id) AS rn FROM sess""",
        "session_events": "SELECT session_id, user_id, pos AS position, time, action FROM ordered",
        "session_sequences": segments(C.SEQUENCE_SEGMENT),
        "session_sequence_segments": segments(C.SHORT_SEGMENT),
        "complete_funnel_sessions": """SELECT session_id, user_id FROM sess GROUP BY session_id, user_id
                 HAVING count(*) FILTER (WHERE action = 'view') > 0 AND count(*) FILTER (WHERE action = 'cart') > 0
                    AND count(*) FILTER (WHERE action = 'purchase') > 0""",
        "complete_funnel_count": """SELECT count(*) AS complete_sessions FROM (
                 SELECT session_id FROM sess GROUP BY session_id, user_id
                 HAVING count(*) FILTER (WHERE action = 'view') > 0 AND count(*) FILTER (WHERE action = 'cart') > 0
                    AND count(*) FILTER (WHERE action = 'purchase') > 0)""",
        # funnel
        "funnel_stage": f"""SELECT user_id, week, views AS view_count, carts AS cart_count, purchases AS purchase_count,
                 CASE WHEN purchases > 0 THEN {_q(L.STAGE_COMPLETE)} WHEN carts > 0 THEN {_q(L.STAGE_PARTIAL)}
                      ELSE {_q(L.STAGE_BROWSE)} END AS funnel_stage FROM beh""",
        "funnel_stage_summary": stages("ubeh", "user_count"),
        "funnel_stage_summary_by_week": stages("beh", "entities"),
        "funnel_reach": f"SELECT * FROM ({reach('uprof', 'users')})",
        "funnel_reach_by_week": f"SELECT * FROM ({reach('prof', 'entities')})",
        "funnel_percent_initial": percent_initial("uprof", "users"),
        "funnel_percent_initial_by_week": percent_initial("prof", "entities"),
        "funnel_conversion": converted("uprof"),
        "funnel_conversion_by_week": converted("prof", "_entities"),
        "user_stats": """SELECT user_id, p.total_actions, views, carts, purchases, categories_browsed, total_sessions,
                 view_purchase_ratio, anomaly_flag FROM uprof p JOIN (
                 SELECT user_id, count(DISTINCT session_id) AS total_sessions, count(DISTINCT category) AS categories_browsed
                 FROM sess GROUP BY user_id) USING (user_id)""",
        "stacked_actions": """SELECT user_id, week, total_actions, 'views' AS action, views AS n FROM prof
                 UNION ALL SELECT user_id, week, total_actions, 'carts', carts FROM prof
                 UNION ALL SELECT user_id, week, total_actions, 'purchases', purchases FROM prof""",
        # anomaly
        "view_purchase_ratio": "SELECT user_id, week, views, carts, purchases, total_actions, view_purchase_ratio FROM ratio",
        "anomaly_flag": f"SELECT {_PROFILE_COLS} FROM prof",
        "flagged_users": f"SELECT {_PROFILE_COLS} FROM prof WHERE anomaly_flag <> {_q(L.FLAG_NORMAL)}",
        "anomaly_totals": flag_totals("uprof", "users"),
        "anomaly_totals_by_week": flag_totals("prof", "entities"),
        "flag_counts": f"""SELECT anomaly_flag, "count", {_pct('"count"', '(SELECT count(*) FROM prof)')} AS percentage
                 FROM (SELECT anomaly_flag, count(*) AS "count" FROM prof GROUP BY anomaly_flag)""",
        "behavior_type": f"""SELECT {_PROFILE_COLS}, CASE WHEN views > (SELECT threshold FROM thr)
                 THEN {_q(L.BEHAVIOR_SUSPECTED)} ELSE {_q(L.BEHAVIOR_NORMAL)} END AS behavior_type FROM prof""",
        "hyperactive_users": f"""SELECT {_PROFILE_COLS}, {_q(L.BEHAVIOR_SUSPECTED)} AS behavior_type FROM prof
                 WHERE views > (SELECT threshold FROM thr)""",
        # the reference's per-user grain
        "anomaly_flag_by_user": """SELECT user_id, views, carts, purchases, total_actions, view_purchase_ratio,
                 anomaly_flag FROM uprof""",
        "funnel_stage_by_user": f"""SELECT user_id, views AS view_count, carts AS cart_count, purchases AS purchase_count,
                 CASE WHEN purchases > 0 THEN {_q(L.STAGE_COMPLETE)} WHEN carts > 0 THEN {_q(L.STAGE_PARTIAL)}
                      ELSE {_q(L.STAGE_BROWSE)} END AS funnel_stage FROM ubeh""",
        "behavior_type_by_user": f"""SELECT user_id, views, carts, purchases, total_actions, view_purchase_ratio,
                 anomaly_flag, CASE WHEN views > (SELECT avg(views) + {L.STDDEV_K} * stddev_samp(views) FROM uprof)
                 THEN {_q(L.BEHAVIOR_SUSPECTED)} ELSE {_q(L.BEHAVIOR_NORMAL)} END AS behavior_type FROM uprof""",
        "anomaly_totals_by_user": flag_totals("uprof", "users"),
        "views_threshold_by_user": f"""SELECT round(avg(views), 6) AS mean_views, round(stddev_samp(views), 6) AS std_views,
                 round(avg(views) + {L.STDDEV_K} * stddev_samp(views), 6) AS threshold FROM uprof""",
    }
    q["user_activity_rows"] = q["user_activity"]
    q["filter_stored"] = q["filter_multi"]
    q["prepared_by_day"] = """SELECT user_id, session_id, count(*) AS n_events, min(time) AS started, max(time) AS ended
                 FROM sess GROUP BY user_id, session_id"""
    reason = f"""CASE WHEN k % {C.BAD_HOUR_MOD} = 0 THEN 'bad csv' WHEN k % {C.MALFORMED_TIME_MOD} = 0 THEN 'bad time'
                 WHEN k % {C.NULL_CATEGORY_MOD} = 0 THEN 'null category' ELSE 'kept' END"""
    q["prep_reject_report"] = f"SELECT {reason} AS reason, count(*) AS n_rows FROM act GROUP BY ALL"
    text = """CASE WHEN epoch_us(time) % 1000000 = 0 THEN strftime(time, '%Y-%m-%d %H:%M:%S')
                 ELSE strftime(time, '%Y-%m-%d %H:%M:%S.%f') END"""
    q["prep_rejects"] = f"""SELECT user_id, action, product_id, device,
                 CASE WHEN k % {C.MALFORMED_TIME_MOD} = 0 THEN replace({text}, '-', '/') ELSE {text} END AS time,
                 {reason} AS reject_reason FROM act WHERE {reason} != 'kept'"""
    return {name: body if name.startswith("describe_") else _sql(body) for name, body in q.items()}
