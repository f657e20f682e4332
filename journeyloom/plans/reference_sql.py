"""Common table expressions of the SQL the queries are checked against."""

from journeyloom.schema import CHANNEL_COST, CHANNELS, DEVICES


def _list(values) -> str:
    return "[" + ", ".join(repr(v) for v in values) + "]"


TOUCHES = f"""
raw AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
tp AS (
  SELECT user_id * 100000 + date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS customer_id,
         'e' || event_id AS session_id, ts AS "timestamp",
         {_list(CHANNELS)}[k % 10 + 1] AS channel,
         {_list(DEVICES)}[(k // 10) % 3 + 1] AS device,
         value * 10 AS time_on_site, k % 7 + 1 AS pages_viewed,
         CAST({_list(CHANNEL_COST.values())}[k % 10 + 1] AS DOUBLE) AS cost,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS converted,
         CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS revenue,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS touchpoint_number,
         count(*) OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS total_touchpoints
  FROM raw
)"""

SESSIONS = f"""
raw AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
ga AS (
  SELECT CAST(user_id AS VARCHAR) AS fullVisitorId, event_id AS visitNumber,
         CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date,
         hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS visitStartTime,
         {_list(CHANNELS)}[k % 10 + 1] AS channel,
         {_list(DEVICES)}[(k // 10) % 3 + 1] AS deviceCategory,
         CASE WHEN event_type <> 'error' THEN value * 10 END AS timeOnSite,
         CASE WHEN k % 7 <> 6 THEN k % 7 + 1.0 END AS pageviews,
         CASE WHEN event_type = 'purchase' THEN 1.0 END AS transactions,
         CASE WHEN event_type = 'purchase' THEN value END AS revenue
  FROM raw
),
gt AS (
  SELECT fullVisitorId AS customer_id, fullVisitorId || '_' || visitNumber AS session_id, channel,
         strptime(CAST(date AS VARCHAR), '%Y%m%d') + to_seconds(visitStartTime) AS "timestamp",
         deviceCategory AS device,
         0.5 + 4.5 * (CAST('0x' || substr(md5(fullVisitorId || '_' || visitNumber), 1, 8) AS BIGINT)
                      / 4294967296.0) AS cost,
         coalesce(timeOnSite, 0) AS time_on_site, CAST(coalesce(pageviews, 1) AS INTEGER) AS pages_viewed,
         CASE WHEN transactions > 0 THEN 1 ELSE 0 END AS converted, coalesce(revenue, 0) AS revenue,
         row_number() OVER (PARTITION BY fullVisitorId ORDER BY date, visitStartTime, visitNumber)
           AS touchpoint_number,
         count(*) OVER (PARTITION BY fullVisitorId) AS total_touchpoints
  FROM ga
)"""

# Coalitions by bit mask; exact Shapley values in the marginal-contribution form.
def shapley_sql(channels: list[str]) -> str:
    n = len(channels)
    return f"""
masks AS (
  SELECT customer_id, max(converted) AS converted,
         bit_or(CAST(1 << (list_position({_list(channels)}, channel) - 1) AS INTEGER)) AS mask
  FROM tp GROUP BY customer_id
),
coal AS (
  SELECT CAST(s AS INTEGER) AS mask, count(*) AS total, sum(converted) AS conversions,
         sum(converted) / count(*) AS rate
  FROM masks, range({2 ** n}) r(s) WHERE (masks.mask & CAST(s AS INTEGER)) = s GROUP BY s
),
lattice AS (
  SELECT CAST(s AS INTEGER) AS s, CAST(1 << i AS INTEGER) AS b, i
  FROM range({2 ** n}) r(s), range({n}) q(i) WHERE (CAST(s AS INTEGER) & CAST(1 << i AS INTEGER)) = 0
),
raw_shap AS (
  SELECT {_list(channels)}[i + 1] AS channel,
         sum(factorial(bit_count(s)::INTEGER) * factorial(({n - 1} - bit_count(s))::INTEGER)
             / CAST(factorial({n}) AS DOUBLE)
             * (coalesce(a.rate, 0) - CASE WHEN s = 0 THEN 0 ELSE coalesce(z.rate, 0) END)) AS raw_value
  FROM lattice LEFT JOIN coal z ON z.mask = s LEFT JOIN coal a ON a.mask = (s | b)
  GROUP BY i
),
shifted AS (
  SELECT channel, raw_value, raw_value - least(0, min(raw_value) OVER ()) AS s FROM raw_shap
),
shap AS (
  SELECT channel, raw_value,
         CASE WHEN sum(s) OVER () > 0 THEN s / sum(s) OVER () ELSE 1.0 / count(*) OVER () END AS shapley_value
  FROM shifted
)"""


SHAPLEY = shapley_sql(CHANNELS)

MARKOV = """
conv_sets AS (
  SELECT customer_id, min(channel) AS lo, max(channel) AS hi FROM tp GROUP BY customer_id HAVING max(converted) = 1
),
eff AS (
  SELECT channel,
         coalesce((SELECT count(*) FROM conv_sets v WHERE v.lo = c.channel AND v.hi = c.channel)
                  / CAST(nullif((SELECT count(*) FROM conv_sets), 0) AS DOUBLE), 0) AS removal_effect
  FROM (SELECT DISTINCT channel FROM tp) c
),
mark AS (
  SELECT channel, removal_effect,
         CASE WHEN sum(removal_effect) OVER () > 0 THEN removal_effect / sum(removal_effect) OVER ()
              ELSE 1.0 / count(*) OVER () END AS attribution_share
  FROM eff
)"""

CREDIT = """
ctx AS (
  SELECT tp.*, shapley_value AS sv, attribution_share AS mv,
         max(converted) OVER c AS jc, max(revenue) OVER c AS jv,
         sum(shapley_value) OVER c AS sv_all, sum(attribution_share) OVER c AS mv_all
  FROM tp JOIN shap USING (channel) JOIN mark USING (channel)
  WINDOW c AS (PARTITION BY customer_id)
),
parts AS (
  SELECT *, CASE WHEN sv_all > 0 THEN sv / sv_all ELSE sv END AS sf,
            CASE WHEN mv_all > 0 THEN mv / mv_all ELSE mv END AS mf,
            total_touchpoints AS n, touchpoint_number AS p
  FROM ctx
),
decay AS (
  SELECT *, pow(0.7, n - p) AS w, sum(pow(0.7, n - p)) OVER (PARTITION BY customer_id) AS w_all FROM parts
),
att AS (
  SELECT customer_id, session_id, "timestamp", channel, device, time_on_site, pages_viewed, cost, converted,
         revenue, touchpoint_number, total_touchpoints,
         CASE WHEN jc = 0 THEN 0 WHEN jv > 0 THEN sf * jv ELSE sf END AS shapley_attribution,
         CASE WHEN jc = 0 THEN 0 WHEN jv > 0 THEN mf * jv ELSE mf END AS markov_attribution,
         CASE WHEN jc = 1 AND p = n THEN jv ELSE 0 END AS last_touch_attribution,
         CASE WHEN jc = 1 AND p = 1 THEN jv ELSE 0 END AS first_touch_attribution,
         CASE WHEN jc = 1 THEN jv / n ELSE 0 END AS linear_attribution,
         CASE WHEN jc = 1 THEN jv * w / w_all ELSE 0 END AS time_decay_attribution,
         CASE WHEN jc = 0 THEN 0 WHEN n = 1 THEN jv WHEN n = 2 THEN jv / 2
              WHEN p = 1 OR p = n THEN jv * 0.4 ELSE jv * 0.2 / (n - 2) END AS position_based_attribution
  FROM decay
)"""


def with_touches(body: str) -> str:
    return f"WITH {TOUCHES} {body}"


def without_email(sql: str) -> str:
    """The same SQL over the touches that are left without e-mail, numbered anew."""
    rest = """, tp AS (
      SELECT * REPLACE (row_number() OVER (PARTITION BY customer_id ORDER BY touchpoint_number) AS touchpoint_number,
                        count(*) OVER (PARTITION BY customer_id) AS total_touchpoints)
      FROM all_tp WHERE channel <> 'email')"""
    others = shapley_sql([c for c in CHANNELS if c != "email"])
    return sql.replace(SHAPLEY, others).replace(TOUCHES, TOUCHES.replace("\ntp AS (", "\nall_tp AS (") + rest)


def with_sessions(body: str) -> str:
    return f"WITH {SESSIONS} {body}"


def with_models(body: str) -> str:
    return f"WITH {TOUCHES}, {SHAPLEY}, {MARKOV} {body}"


def with_credit(body: str) -> str:
    return f"WITH {TOUCHES}, {SHAPLEY}, {MARKOV}, {CREDIT} {body}"


def with_ga_touches(body: str) -> str:
    return f"WITH {SESSIONS}, tp AS (SELECT * FROM gt) {body}"


def with_ga_credit(body: str) -> str:
    return f"WITH {SESSIONS}, tp AS (SELECT * FROM gt), {SHAPLEY}, {MARKOV}, {CREDIT} {body}"
