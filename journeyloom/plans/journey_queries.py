"""Journeys (J), aggregates (A) and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from journeyloom.operators import journeys as J, metrics as A, paths as P
from journeyloom.plans.reference_sql import with_sessions, with_touches
from journeyloom.schema import CHANNELS

_KEY = "customer_id:i, touchpoint_number:i"


def _path_key() -> str:
    """SQL: the digest of a path from the words of its touches' md5."""
    words = [
        f"lpad(lower(to_hex(bit_xor(CAST('0x' || substr(md5(touchpoint_number || '|' || channel), {at}, {n}) AS BIGINT)))), {n}, '0')"
        for at, n in ((1, 15), (16, 15), (31, 2))
    ]
    return " || ".join(words)


_PATH_KEY = _path_key()
PATH_KEYS = f"""
        , key AS (
          SELECT customer_id, count(*) AS path_length,
                 {_PATH_KEY} AS path_key,
                 max(converted) AS converted, max(revenue) AS revenue
          FROM tp GROUP BY customer_id
        )"""
CONVERSION_KEYS = f"""
            , won AS (
              SELECT * REPLACE (row_number() OVER (PARTITION BY customer_id ORDER BY touchpoint_number) AS touchpoint_number)
              FROM tp WHERE converted = 1
            )
            SELECT path_length, path_key, count(*) AS conversions, sum(revenue) AS total_revenue, avg(revenue) AS avg_revenue
            FROM (SELECT customer_id, count(*) AS path_length, {_PATH_KEY} AS path_key, max(revenue) AS revenue
                  FROM won GROUP BY customer_id)
            GROUP BY path_length, path_key"""


def register_all(register) -> None:
    register(
        "s0_touchpoints_from_events",
        f"{_KEY}, total_touchpoints:i, session_id, channel, device, time_on_site:4, pages_viewed:i, cost:4, "
        "converted:i, revenue:4",
        lambda t: t.touches,
        with_touches("SELECT * FROM tp"),
    )
    register(
        "s2_ga_touchpoints",
        "customer_id, touchpoint_number:i, total_touchpoints:i, session_id, channel, device, second, cost:4, "
        "time_on_site:4, pages_viewed:i, converted:i, revenue:4",
        lambda t: t.ga_touches.withColumn("second", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")),
        with_sessions("""SELECT *, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS second FROM gt"""),
    )
    register(
        "j1_touch_enrichment",
        f"{_KEY}, prev_channel, next_channel, time_since_prev:i, is_first_touch:i, is_last_touch:i",
        lambda t: J.enrich_touches(t.touches),
        with_touches(
            """
            SELECT customer_id, touchpoint_number, lag(channel) OVER w AS prev_channel,
                   lead(channel) OVER w AS next_channel,
                   coalesce(floor(epoch("timestamp")) - floor(epoch(lag("timestamp") OVER w)), 0) AS time_since_prev,
                   touchpoint_number = 1 AS is_first_touch,
                   touchpoint_number = total_touchpoints AS is_last_touch
            FROM tp WINDOW w AS (PARTITION BY customer_id ORDER BY touchpoint_number)"""
        ),
    )
    register(
        "j2_j3_numbered_sessions",
        "session_id, touchpoint_number:i, total_touchpoints:i",
        lambda t: t.ga_touches,
        with_sessions("SELECT * FROM gt"),
    )
    register(
        "j4_journey_states",
        "customer_id:i, step:i, state",
        lambda t: J.journey_states(t.touches),
        with_touches(
            """
            SELECT customer_id, touchpoint_number + 1 AS step, channel AS state FROM tp
            UNION ALL SELECT DISTINCT customer_id, 1, 'start' FROM tp
            UNION ALL SELECT customer_id, count(*) + 2,
                             CASE WHEN max(converted) = 1 THEN 'conversion' ELSE 'null' END
                      FROM tp GROUP BY customer_id"""
        ),
    )
    register(
        "j4_journey_sequences",
        "customer_id:i, touches:i, sequence:a",
        lambda t: P.journey_sequences(t.touches),
        with_touches(
            """
            SELECT customer_id, count(*) AS touches,
                   list_concat(list_concat(['start'], list(channel ORDER BY touchpoint_number)),
                     [CASE WHEN max(converted) = 1 THEN 'conversion' ELSE 'null' END]) AS sequence
            FROM tp GROUP BY customer_id"""
        ),
    )
    register(
        "j4_sequence_chunks",
        "customer_id:i, chunk:i, touches:i, states:a",
        lambda t: P.sequence_chunks(t.touches, 4),
        with_touches(
            """
            , whole AS (
              SELECT customer_id, count(*) AS touches,
                     list_concat(list_concat(['start'], list(channel ORDER BY touchpoint_number)),
                       [CASE WHEN max(converted) = 1 THEN 'conversion' ELSE 'null' END]) AS s
              FROM tp GROUP BY customer_id
            ),
            piece AS (SELECT *, unnest(range((touches + 1) // 4 + 1)) AS chunk FROM whole)
            SELECT customer_id, chunk, touches, s[4 * chunk + 1:4 * chunk + 4] AS states FROM piece"""
        ),
    )
    named = ", ".join(f"channel_{c}_count:i" for c in CHANNELS)
    register(
        "j5_journey_features",
        "customer_id:i, journey_length:i, total_cost:4, total_time_on_site:4, total_pages_viewed:i, "
        "unique_channels:i, unique_devices:i, converted:i, revenue:4, journey_duration_hours:6, "
        f"{named}, first_channel, last_channel, mobile_touches:i, desktop_touches:i",
        lambda t: J.journey_features(t.touches, CHANNELS),
        with_touches(
            f"""
            SELECT customer_id, count(*) AS journey_length, sum(cost) AS total_cost,
                   sum(time_on_site) AS total_time_on_site, sum(pages_viewed) AS total_pages_viewed,
                   count(DISTINCT channel) AS unique_channels, count(DISTINCT device) AS unique_devices,
                   max(converted) AS converted, sum(revenue) AS revenue,
                   (epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 1e6 / 3600
                     AS journey_duration_hours,
                   {", ".join(f"count(*) FILTER (channel = '{c}') AS channel_{c}_count" for c in CHANNELS)},
                   arg_min(channel, touchpoint_number) AS first_channel,
                   arg_max(channel, touchpoint_number) AS last_channel,
                   count(*) FILTER (device = 'mobile') AS mobile_touches,
                   count(*) FILTER (device = 'desktop') AS desktop_touches
            FROM tp GROUP BY customer_id"""
        ),
    )
    named6 = ", ".join(f"{c}_touches:i" for c in J.COUNTED_CHANNELS)
    register(
        "j6_conversion_features",
        "customer_id:i, label:i, journey_length:i, unique_channels:i, unique_devices:i, total_cost:4, "
        f"total_time_on_site:4, total_pages_viewed:i, avg_time_on_site:6, {named6}, mobile_touches:i, "
        "desktop_touches:i",
        lambda t: J.conversion_features(t.touches),
        with_touches(
            f"""
            SELECT customer_id, max(converted) AS label, count(*) AS journey_length,
                   count(DISTINCT channel) AS unique_channels, count(DISTINCT device) AS unique_devices,
                   sum(cost) AS total_cost, sum(time_on_site) AS total_time_on_site,
                   sum(pages_viewed) AS total_pages_viewed, avg(time_on_site) AS avg_time_on_site,
                   {", ".join(f"count(*) FILTER (channel = '{c}') AS {c}_touches" for c in J.COUNTED_CHANNELS)},
                   count(*) FILTER (device = 'mobile') AS mobile_touches,
                   count(*) FILTER (device = 'desktop') AS desktop_touches
            FROM tp GROUP BY customer_id"""
        ),
    )
    stats = """
        SELECT customer_id, max(touchpoint_number) AS journey_length, count(DISTINCT channel) AS unique_channels,
               count(DISTINCT device) AS unique_devices, max(converted) AS converted
        FROM tp GROUP BY customer_id"""
    register(
        "j7_journey_stats",
        "customer_id:i, journey_length:i, unique_channels:i, unique_devices:i, converted:i",
        lambda t: J.journey_stats(t.touches),
        with_touches(stats),
    )
    register(
        "j8_length_histogram",
        "bin:i, bin_start:6, journeys:i",
        lambda t: J.length_histogram(t.touches),
        with_touches(
            f"""
            , js AS ({stats}),
            ends AS (SELECT min(journey_length) AS lo, max(journey_length) AS hi FROM js),
            binned AS (
              SELECT lo, hi, least(floor((journey_length - lo) / nullif((hi - lo) / 20.0, 0)) + 1, 20) AS b
              FROM js, ends
            )
            SELECT coalesce(b, 1) AS bin, min(lo + (coalesce(b, 1) - 1) * (hi - lo) / 20.0) AS bin_start,
                   count(*) AS journeys
            FROM binned GROUP BY 1"""
        ),
    )
    register(
        "j9_channel_quartiles",
        "converted:i, min:i, q1:4, median:4, q3:4, max:i",
        lambda t: J.channel_quartiles(t.touches),
        with_touches(
            f"""
            , js AS ({stats})
            SELECT converted, min(unique_channels) AS min, quantile_cont(unique_channels, 0.25) AS q1,
                   quantile_cont(unique_channels, 0.5) AS median, quantile_cont(unique_channels, 0.75) AS q3,
                   max(unique_channels) AS max
            FROM js GROUP BY converted"""
        ),
    )
    register(
        "j10_calendar_features",
        f"{_KEY}, hour_of_day:i, day_of_week:i, day_of_week_sunday1:i, month:i, quarter:i",
        lambda t: J.calendar_features(t.touches),
        with_touches(
            """
            SELECT customer_id, touchpoint_number, hour("timestamp") AS hour_of_day,
                   isodow("timestamp") - 1 AS day_of_week, dayofweek("timestamp") + 1 AS day_of_week_sunday1,
                   month("timestamp") AS month, quarter("timestamp") AS quarter
            FROM tp"""
        ),
    )
    register(
        "j11_journey_length",
        f"{_KEY}, journey_length:i",
        lambda t: J.with_journey_length(t.touches),
        with_touches(
            """
            SELECT customer_id, touchpoint_number, journey_length
            FROM tp JOIN (SELECT customer_id, max(touchpoint_number) AS journey_length FROM tp GROUP BY 1)
              USING (customer_id)"""
        ),
    )
    register(
        "j12_path_patterns",
        "journey_path, converted:i, frequency:i, avg_revenue:4, avg_length:6",
        lambda t: P.path_patterns(t.touches),
        with_touches(
            """
            SELECT journey_path, converted, count(*) AS frequency, avg(revenue) AS avg_revenue,
                   avg(journey_length) AS avg_length
            FROM (SELECT customer_id, string_agg(channel, ' -> ' ORDER BY touchpoint_number) AS journey_path,
                         max(converted) AS converted, max(revenue) AS revenue, count(*) AS journey_length
                  FROM tp GROUP BY customer_id)
            GROUP BY journey_path, converted"""
        ),
    )
    register(
        "j12_pattern_keys",
        "path_length:i, path_key, converted:i, frequency:i, avg_revenue:4, avg_length:6",
        lambda t: P.pattern_keys(t.touches),
        with_touches(
            PATH_KEYS
            + """
            SELECT path_length, path_key, converted, count(*) AS frequency, avg(revenue) AS avg_revenue,
                   path_length AS avg_length
            FROM key GROUP BY path_length, path_key, converted"""
        ),
    )
    register(
        "j12_path_steps",
        "path_length:i, path_key, chunk:i, steps",
        lambda t: P.path_steps(t.touches, P.journey_keys(t.touches), 3),
        with_touches(
            PATH_KEYS
            + """
            , one AS (SELECT path_length, path_key, min(customer_id) AS customer_id FROM key GROUP BY 1, 2)
            SELECT path_length, path_key, (touchpoint_number - 1) // 3 AS chunk,
                   string_agg(channel, ' -> ' ORDER BY touchpoint_number) AS steps
            FROM one JOIN tp USING (customer_id) GROUP BY 1, 2, 3"""
        ),
    )
    register(
        "j13_conversion_touch_keys",
        "path_length:i, path_key, conversions:i, total_revenue:4, avg_revenue:4",
        lambda t: P.conversion_touch_keys(t.touches),
        with_touches(CONVERSION_KEYS),
    )
    register(
        "j14_converting_keys",
        "path_length:i, path_key, count:i, total_revenue:4, avg_revenue:4",
        lambda t: P.converting_keys(t.touches, None),
        with_touches(
            PATH_KEYS
            + """
            SELECT path_length, path_key, count(*) AS "count", sum(revenue) AS total_revenue, avg(revenue) AS avg_revenue
            FROM key WHERE converted = 1 GROUP BY path_length, path_key"""
        ),
    )
    paths = """
        SELECT path, count(*) AS {count}, sum(revenue) AS total_revenue, avg(revenue) AS avg_revenue
        FROM (SELECT customer_id, string_agg(channel, ' -> ' ORDER BY touchpoint_number) AS path,
                     max(revenue) AS revenue
              FROM tp {where} GROUP BY customer_id {having})
        GROUP BY path {top}"""
    register(
        "j13_conversion_touch_paths",
        "path, conversions:i, total_revenue:4, avg_revenue:4",
        lambda t: P.conversion_touch_paths(t.touches),
        with_touches(paths.format(count="conversions", where="WHERE converted = 1", having="", top="")),
    )
    register(
        "j14_top_converting_paths",
        "path, count:i, total_revenue:4, avg_revenue:4",
        lambda t: P.converting_paths(t.touches, 10),
        with_touches(
            paths.format(
                count='"count"',
                where="",
                having="HAVING max(converted) = 1",
                top='ORDER BY "count" DESC, path LIMIT 10',
            )
        ),
    )
    register(
        "j14_all_converting_paths",
        "path, count:i, total_revenue:4, avg_revenue:4",
        lambda t: P.converting_paths(t.touches, None),
        with_touches(paths.format(count='"count"', where="", having="HAVING max(converted) = 1", top="")),
    )
    register(
        "j15_sample_converting_journey",
        "fullVisitorId, visitNumber:i, date:i, channel, transactions:4, revenue:4",
        lambda t: J.sample_converting_journey(t.sessions),
        with_sessions(
            """
            SELECT fullVisitorId, visitNumber, date, channel, transactions, revenue FROM ga
            WHERE fullVisitorId = (
              SELECT fullVisitorId FROM ga WHERE transactions > 0
              ORDER BY date, visitStartTime, visitNumber, fullVisitorId LIMIT 1)"""
        ),
    )

    register(
        "a1_dataset_stats",
        "total_records:i, unique_customers:i, unique_channels:i",
        lambda t: A.dataset_stats(t.unnumbered),
        with_touches(
            """
            SELECT count(*) AS total_records, count(DISTINCT customer_id) AS unique_customers,
                   count(DISTINCT channel) AS unique_channels FROM tp"""
        ),
    )
    register(
        "a2_channel_metrics",
        "channel, total_touches:i, unique_customers:i, total_cost:4, total_revenue:4, avg_time_on_site:6, "
        "avg_pages_viewed:6, conversions:i, first_touches:i, last_touches:i, conversion_rate:6, roi:6, "
        "revenue_per_customer:6",
        lambda t: A.channel_metrics(t.touches),
        with_touches(
            """
            SELECT channel, count(*) AS total_touches, count(DISTINCT customer_id) AS unique_customers,
                   sum(cost) AS total_cost, sum(revenue) AS total_revenue, avg(time_on_site) AS avg_time_on_site,
                   avg(pages_viewed) AS avg_pages_viewed, sum(converted) AS conversions,
                   count(*) FILTER (touchpoint_number = 1) AS first_touches,
                   count(*) FILTER (touchpoint_number = total_touchpoints) AS last_touches,
                   sum(converted) / count(*) AS conversion_rate,
                   (sum(revenue) - sum(cost)) / nullif(sum(cost), 0) AS roi,
                   sum(revenue) / count(DISTINCT customer_id) AS revenue_per_customer
            FROM tp GROUP BY channel"""
        ),
    )
    register(
        "a3_time_patterns",
        "hour:i, day_of_week:i, touches:i, conversions:i, avg_engagement:6, conversion_rate:6",
        lambda t: A.time_patterns(t.unnumbered),
        with_touches(
            """
            SELECT hour("timestamp") AS hour, dayofweek("timestamp") + 1 AS day_of_week, count(*) AS touches,
                   sum(converted) AS conversions, avg(time_on_site) AS avg_engagement,
                   sum(converted) / count(*) AS conversion_rate
            FROM tp GROUP BY 1, 2"""
        ),
    )
    register(
        "a4_kpi_overview",
        "total_customers:i, total_touchpoints:i, total_conversions:i, conversion_rate:6, total_revenue:4, "
        "total_cost:4, roas:6, avg_customer_value:6",
        lambda t: A.kpi_overview(t.unnumbered),
        with_touches(
            """
            SELECT count(DISTINCT customer_id) AS total_customers, count(*) AS total_touchpoints,
                   count(DISTINCT CASE WHEN converted = 1 THEN customer_id END) AS total_conversions,
                   total_conversions / total_customers AS conversion_rate,
                   sum(revenue) AS total_revenue, sum(cost) AS total_cost,
                   coalesce(sum(revenue) / nullif(sum(cost), 0), 0) AS roas,
                   sum(revenue) / total_customers AS avg_customer_value
            FROM tp"""
        ),
    )
    roi = (
        "CASE WHEN sum(cost) = 0 AND sum(revenue) <> 0 THEN 0 "
        "ELSE (sum(revenue) - sum(cost)) / nullif(sum(cost), 0) END"
    )
    register(
        "a5_channel_overview",
        "channel, customers:i, cost:4, revenue:4, converted:i, roi:6, conversion_rate:6",
        lambda t: A.channel_overview(t.unnumbered),
        with_touches(
            f"""
            SELECT channel, count(DISTINCT customer_id) AS customers, sum(cost) AS cost, sum(revenue) AS revenue,
                   sum(converted) AS converted, {roi} AS roi,
                   sum(converted) / count(DISTINCT customer_id) AS conversion_rate
            FROM tp GROUP BY channel"""
        ),
    )
    detail_columns = (
        "channel, total_touches:i, unique_customers:i, total_cost:4, total_revenue:4, converting_customers:i, "
        "conversion_rate:6, roi:6, avg_time_on_site:6"
    )
    detail = """
        SELECT channel, count(*) AS total_touches, count(DISTINCT customer_id) AS unique_customers,
               sum(cost) AS total_cost, sum(revenue) AS total_revenue,
               count(DISTINCT CASE WHEN converted = 1 THEN customer_id END) AS converting_customers,
               converting_customers / unique_customers AS conversion_rate,
               coalesce((sum(revenue) - sum(cost)) / nullif(sum(cost), 0), 0) AS roi,
               avg(time_on_site) AS avg_time_on_site
        FROM tp GROUP BY channel"""
    register("a6_channel_detail", detail_columns, lambda t: A.channel_detail(t.unnumbered), with_touches(detail))
    register(
        "a6_channel_detail_email",
        detail_columns,
        lambda t: A.channel_detail(t.unnumbered, "email"),
        with_touches(f"SELECT * FROM ({detail}) WHERE channel = 'email'"),
    )
    daily = """
        SELECT {by} CAST("timestamp" AS DATE) AS date, count(DISTINCT customer_id) AS customers, sum(cost) AS cost,
               sum(revenue) AS revenue, sum(converted) AS converted
        FROM tp GROUP BY ALL"""
    register(
        "a7_daily_channel_metrics",
        "channel, date, customers:i, cost:4, revenue:4, converted:i",
        lambda t: A.daily_metrics(t.unnumbered),
        with_touches(daily.format(by="channel,")),
    )
    register(
        "a7_daily_metrics",
        "date, customers:i, cost:4, revenue:4, converted:i",
        lambda t: A.daily_metrics(t.unnumbered, by_channel=False),
        with_touches(daily.format(by="")),
    )
    register(
        "a8_position_frequency",
        "channel, position:i, frequency:i, conversions:i",
        lambda t: A.position_frequency(t.touches),
        with_touches(
            """
            SELECT channel, touchpoint_number AS "position", count(customer_id) AS frequency,
                   sum(converted) AS conversions
            FROM tp GROUP BY 1, 2"""
        ),
    )
    register(
        "a9_top_channels",
        "channel, touches:i",
        lambda t: A.top_channels(t.sessions, 10),
        with_sessions(
            "SELECT channel, count(*) AS touches FROM ga GROUP BY channel ORDER BY touches DESC, channel LIMIT 10"
        ),
    )
    register(
        "a10_ga_profile",
        "total_rows:i, unique_visitors:i, min_date:i, max_date:i, rows_with_transactions:i, "
        "total_transactions:4, total_revenue:4",
        lambda t: A.ga_profile(t.sessions),
        with_sessions(
            """
            SELECT count(*) AS total_rows, count(DISTINCT fullVisitorId) AS unique_visitors,
                   min(date) AS min_date, max(date) AS max_date,
                   count(*) FILTER (transactions > 0) AS rows_with_transactions,
                   sum(transactions) AS total_transactions, sum(revenue) AS total_revenue
            FROM ga"""
        ),
    )
    register(
        "a11_dataset_summary",
        "total_customers:i, total_touchpoints:i, total_conversions:i, conversion_rate:6, avg_journey_length:6, "
        "total_revenue:4, total_cost:4, roas:6, channels:a, start_second, end_second",
        lambda t: A.dataset_summary(t.touches)
        .withColumn("start_second", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))
        .withColumn("end_second", F.date_format("end", "yyyy-MM-dd HH:mm:ss")),
        with_touches(
            """
            SELECT count(DISTINCT customer_id) AS total_customers, count(*) AS total_touchpoints,
                   count(DISTINCT CASE WHEN converted = 1 THEN customer_id END) AS total_conversions,
                   total_conversions / total_customers AS conversion_rate,
                   count(*) / total_customers AS avg_journey_length,
                   sum(revenue) AS total_revenue, sum(cost) AS total_cost,
                   coalesce(sum(revenue) / nullif(sum(cost), 0), 0) AS roas,
                   list_sort(list(DISTINCT channel)) AS channels,
                   strftime(min("timestamp"), '%Y-%m-%d %H:%M:%S') AS start_second,
                   strftime(max("timestamp"), '%Y-%m-%d %H:%M:%S') AS end_second
            FROM tp"""
        ),
    )
    register(
        "a12_roi_table",
        "channel, cost:4, revenue:4, customers:i, last_touch_conversions:i, roi:6, cpa:6, revenue_per_customer:6",
        lambda t: A.roi_table(t.touches),
        with_touches(
            f"""
            SELECT channel, sum(cost) AS cost, sum(revenue) AS revenue, count(DISTINCT customer_id) AS customers,
                   sum(CASE WHEN touchpoint_number = total_touchpoints THEN converted ELSE 0 END)
                     AS last_touch_conversions,
                   {roi} AS roi,
                   sum(cost) / nullif(sum(CASE WHEN touchpoint_number = total_touchpoints THEN converted
                                               ELSE 0 END), 0) AS cpa,
                   sum(revenue) / count(DISTINCT customer_id) AS revenue_per_customer
            FROM tp GROUP BY channel"""
        ),
    )
    register(
        "a13_prepared_check",
        "unique_customers:i, converting_customers:i, total_revenue:4",
        lambda t: A.prepared_check(t.ga_touches),
        with_sessions(
            """
            SELECT count(*) AS unique_customers, sum(c) AS converting_customers, sum(r) AS total_revenue
            FROM (SELECT customer_id, max(converted) AS c, max(revenue) AS r FROM gt GROUP BY customer_id)"""
        ),
    )
