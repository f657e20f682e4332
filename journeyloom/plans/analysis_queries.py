"""Statistics (X), budget (B), media mix (R), time series (D), models (L), sinks (S)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window, functions as F, types as T

from journeyloom.functions.numeric import side_by_side
from journeyloom.operators import (
    budget as B,
    compare as C,
    conversion_models as L,
    experiments as X,
    journeys as J,
    mediamix as R,
    metrics as A,
    timeseries as D,
)
from journeyloom.plans import jobs
from journeyloom.plans.journey_queries import CONVERSION_KEYS, PATH_KEYS
from journeyloom.plans.reference_sql import with_credit, with_ga_touches, with_touches
from journeyloom.plans.solve_sql import coefficients, logistic, ridge_path as ridge_sql, swept as swept_sql
from journeyloom.plans.tail_sql import beta_tail, range_critical, range_tail
from journeyloom.schema import CHANNELS
from journeyloom.session import fresh_path
from journeyloom.sources.sinks import write_csv, write_json_summary, write_parquet
from journeyloom.sources.touchpoints import read_touchpoints, reject_counts, rejected_touches

_KEY = "customer_id:i, touchpoint_number:i"
_TOUCH_COLUMNS = (
    f"{_KEY}, total_touchpoints:i, session_id, channel, device, time_on_site:4, pages_viewed:i, cost:4, "
    "converted:i, revenue:4, second"
)
_TOUCH_SQL = """SELECT *, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS second FROM tp"""


def register_all(register) -> None:
    _statistics(register)
    _budget(register)
    _media_mix(register)
    _time_series(register)
    _models(register)
    _sinks(register)


def _long(methods: list[str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS method, {m} AS value FROM {source}" for m in methods)


_INTERVALS = """
    SELECT channel, avg(revenue) AS mean,
           avg(revenue) - 1.96 * stddev_pop(revenue) / sqrt(count(*)) AS ci_lower,
           avg(revenue) + 1.96 * stddev_pop(revenue) / sqrt(count(*)) AS ci_upper
    FROM tp GROUP BY channel"""
_ANOVA_TABLE = """
    , mom AS (SELECT method, count(*) AS n, avg(value) AS m, coalesce(var_samp(value), 0) AS v
              FROM vals GROUP BY method),
    grand AS (SELECT sum(n * m) / sum(n) AS g, count(*) AS k, sum(n) AS total FROM mom),
    sq AS (SELECT sum(n * (m - g) * (m - g)) AS between_, sum((n - 1) * v) AS within_,
                  any_value(k) AS k, any_value(total) AS total FROM mom, grand),
    tested AS (SELECT k - 1 AS df_between, total - k AS df_within,
                      (between_ / (k - 1)) / (within_ / (total - k)) AS f_statistic FROM sq)"""
_ANOVA = _ANOVA_TABLE + " SELECT * FROM tested"


def _statistics(register) -> None:
    sums = ", ".join(f"sum({m}) AS {m}" for m in X.ANOVA_METHODS)
    per_customer = f"""
        , cust AS (SELECT customer_id, {sums} FROM att GROUP BY customer_id),
        vals AS (SELECT * FROM ({_long(X.ANOVA_METHODS, 'cust')}) WHERE value > 0)"""
    per_touch = f"""
        , ct AS (SELECT * FROM att WHERE converted = 1), vals AS ({_long(X.TOUCH_METHODS, 'ct')})"""
    columns = "df_between:i, df_within:i, f_statistic:6"
    register(
        "x1_anova_customers",
        columns,
        lambda t: X.anova_table(X.group_moments(X.customer_method_values(t.attributed))),
        with_credit(per_customer + _ANOVA),
    )
    register(
        "x1_method_means",
        "method, n:i, mean:6, variance:4",
        lambda t: X.group_moments(X.customer_method_values(t.attributed)),
        with_credit(
            per_customer
            + " SELECT method, count(*) AS n, avg(value) AS mean, var_samp(value) AS variance FROM vals GROUP BY method"
        ),
    )
    register(
        "x1_anova_p_value",
        "f_statistic:6, p_value:8, significant_difference:i",
        lambda t: X.anova(X.customer_method_values(t.attributed)),
        with_credit(
            per_customer
            + _ANOVA_TABLE
            + ", p AS ("
            + beta_tail("tested", "df_within / (df_within + df_between * f_statistic)", "df_within / 2", "df_between / 2", "f_statistic")
            + """)
            SELECT f_statistic, tail AS p_value, tail < 0.05 AS significant_difference FROM p"""
        ),
    )
    register(
        "x2_anova_converted_touches",
        columns,
        lambda t: X.anova_table(X.group_moments(X.converted_touch_values(t.attributed))),
        with_credit(per_touch + _ANOVA),
    )
    pair_table = """
        , mom AS (SELECT method, count(*) AS n, avg(value) AS m, var_samp(value) AS v FROM vals GROUP BY method),
        err AS (SELECT sum((n - 1) * v) / (sum(n) - count(*)) AS mse FROM mom),
        pairs AS (
          SELECT a.method AS group1, b.method AS group2, b.m - a.m AS mean_difference,
                 sqrt(mse / 2 * (1.0 / a.n + 1.0 / b.n)) AS error, abs(b.m - a.m) / error AS q_statistic
          FROM mom a JOIN mom b ON a.method < b.method, err
        )"""
    pairs = pair_table + " SELECT * FROM pairs"
    tukey = "group1, group2, mean_difference:6, q_statistic:6"
    register(
        "x3_tukey_pairs_customers",
        tukey,
        lambda t: X.tukey_hsd(X.customer_method_values(t.attributed)),
        with_credit(per_customer + pairs),
    )
    register(
        "x3_tukey_pairs_touches",
        tukey,
        lambda t: X.tukey_hsd(X.converted_touch_values(t.attributed)),
        with_credit(per_touch + pairs),
    )
    register(
        "x3_tukey_p_values",
        f"{tukey}, p_adjusted:6, lower:5, upper:5, reject:i",
        lambda t: X.tukey_hsd(X.converted_touch_values(t.attributed)),
        with_credit(
            per_touch
            + pair_table
            + f"""
            , degrees AS (SELECT count(*) AS k, CAST(sum(n) - count(*) AS DOUBLE) AS n FROM mom),
            {range_critical(0.05)},
            asked AS (SELECT pairs.*, q_statistic AS q, k, n FROM pairs, degrees),
            p AS ({range_tail("asked", "group1, group2, mean_difference, q_statistic, error")})
            SELECT group1, group2, mean_difference, q_statistic, tail AS p_adjusted, mean_difference - value * error AS lower,
                   mean_difference + value * error AS upper, tail < 0.05 AS reject
            FROM p, critical"""
        ),
    )
    tested = CHANNELS
    labels = ", ".join(f"('{c}')" for c in CHANNELS)
    arms = f"""
            , arms AS (
              SELECT *, CAST('0x' || substr(md5('42|' || customer_id), 1, 8) AS BIGINT) % 100 < 20 AS held FROM tp
            ),
            treat AS (SELECT max(converted) AS y FROM arms WHERE NOT held GROUP BY customer_id),
            ts AS (SELECT count(*) AS n, avg(y) AS m, var_samp(y) AS v FROM treat),
            ctl AS (
              SELECT c AS channel, customer_id, max(converted) AS y
              FROM arms, (VALUES {labels}) w(c)
              WHERE held AND channel <> c GROUP BY c, customer_id
            ),
            cs AS (SELECT channel, count(*) AS n, avg(y) AS m, var_samp(y) AS v FROM ctl GROUP BY channel),
            effect AS (
              SELECT channel, cs.m AS control_rate, ts.m AS treatment_rate, (ts.m - cs.m) / cs.m AS lift,
                     (cs.m - ts.m) / sqrt(((cs.n - 1) * cs.v + (ts.n - 1) * ts.v) / (cs.n + ts.n - 2)
                                          * (1.0 / cs.n + 1.0 / ts.n)) AS t_statistic,
                     (ts.m - cs.m) / sqrt((cs.v + ts.v) / 2) AS cohens_d, cs.n AS control_n, ts.n AS treatment_n,
                     CAST(cs.n + ts.n - 2 AS DOUBLE) AS df
              FROM cs, ts
            )"""
    register(
        "x4_channel_incrementality",
        "channel, control_rate:6, treatment_rate:6, lift:6, t_statistic:6, cohens_d:6, control_n:i, treatment_n:i",
        lambda t: X.incrementality(t.unnumbered, tested),
        with_touches(arms + " SELECT * FROM effect"),
    )
    register(
        "x5_incrementality_p_values",
        "channel, t_statistic:6, p_value:6, significant:i",
        lambda t: X.incrementality_test(t.unnumbered, tested),
        with_touches(
            arms
            + ", p AS ("
            + beta_tail("effect", "df / (df + t_statistic * t_statistic)", "df / 2", "0.5", "channel, t_statistic")
            + ") SELECT channel, t_statistic, tail AS p_value, tail < 0.05 AS significant FROM p"
        ),
    )
    register(
        "x7_method_effect_size",
        "effect_size:6, interpretation, required_n:i",
        lambda t: X.method_effect_size(t.attributed),
        with_credit(
            f"""
            , m AS (
              SELECT count(*) AS n, avg(shapley_attribution) AS a, avg(last_touch_attribution) AS b,
                     var_samp(shapley_attribution) AS va, var_samp(last_touch_attribution) AS vb
              FROM att WHERE converted = 1
            ),
            e AS (SELECT (a - b) / sqrt(((n - 1) * va + (n - 1) * vb) / (n + n - 2)) AS effect_size FROM m)
            SELECT effect_size, CASE WHEN abs(effect_size) < 0.2 THEN 'Small'
                                     WHEN abs(effect_size) < 0.5 THEN 'Medium' ELSE 'Large' END AS interpretation,
                   ceil({2 * X._power_constant(0.05, 0.8)!r} / (effect_size * effect_size)) AS required_n
            FROM e"""
        ),
    )
    z2 = X._power_constant(0.05, 0.8)
    register(
        "x8_sample_sizes",
        "scope, customers:i, baseline_rate:6, effect_size:6, one_sample_n:i, two_sample_n:i",
        lambda t: X.sample_sizes(t.unnumbered),
        with_touches(
            f"""
            , base AS (
              SELECT 'all' AS scope, count(*) AS customers, avg(y) AS p
              FROM (SELECT max(converted) AS y FROM tp GROUP BY customer_id)
              UNION ALL
              SELECT channel, count(*), avg(y)
              FROM (SELECT channel, customer_id, max(converted) AS y FROM tp GROUP BY ALL) GROUP BY channel
            ),
            eff AS (SELECT *, 0.02::DOUBLE / sqrt(p * (1 - p)) AS e FROM base)
            SELECT scope, customers, p AS baseline_rate, e AS effect_size,
                   ceil({z2!r} / (e * e)) AS one_sample_n, ceil(2 * {z2!r} / (e * e)) AS two_sample_n
            FROM eff"""
        ),
    )
    weight = " + ".join(f"(CASE WHEN b >= {t} THEN 1 ELSE 0 END)" for t in X.poisson_thresholds())
    register(
        "x9_bootstrap_means",
        "channel, mean_attribution:6, ci_lower:6, ci_upper:6, std_error:6",
        lambda t: X.bootstrap_means(t.attributed),
        with_credit(
            """
            , counts AS (
              SELECT channel, CAST(round(shapley_attribution * 1000000) AS BIGINT) AS units, count(*) AS n FROM att GROUP BY 1, 2
            ),
            digits AS (
              SELECT channel, units, level, 0 AS piece FROM counts, range(16) l(level) WHERE (n >> level) & 1 = 1
              UNION ALL SELECT channel, units, 16, unnest(range(1, n // 65536 + 1)) FROM counts
            ),
            words AS (
              SELECT channel, units, level, quad,
                     md5(concat_ws('|', '42', channel, units, level, piece, quad)) AS d
              FROM digits, range(250) q(quad)
            ),
            draws AS (
              SELECT channel, units, level, quad * 4 + place + 1 AS draw,
                     CAST('0x' || substr(d, CAST(1 + 8 * place AS INTEGER), 8) AS BIGINT) AS bits
              FROM words, range(4) w(place)
            ),
            rate AS (SELECT level, CAST(1 << level AS DOUBLE) AS r FROM (SELECT CAST(unnest(range(17)) AS INTEGER) AS level)),
            span AS (
              SELECT level, r, CAST(greatest(0, floor(r - 9 * sqrt(r) - 12)) AS BIGINT) AS low,
                     CAST(ceil(r + 9 * sqrt(r) + 12) AS BIGINT) AS high FROM rate
            ),
            chance AS (
              SELECT level, j, exp(j * ln(r) - r - lgamma(j + 1)) AS p FROM (SELECT level, r, unnest(range(low, high)) AS j FROM span)
            ),
            step AS (
              SELECT level, j + 1 AS w, CAST(floor(sum(p) OVER (PARTITION BY level ORDER BY j) * 4294967296.0) AS BIGINT) AS t FROM chance
              UNION ALL SELECT level, low, -1 FROM span
            ),
            bounds AS (SELECT level, t, max(w) AS w FROM step GROUP BY level, t),
            weighed AS (
              SELECT channel, units, draw, w FROM draws ASOF JOIN bounds ON draws.level = bounds.level AND draws.bits >= bounds.t
            ),
            means AS (
              SELECT channel, draw, sum(CAST(w AS DOUBLE) * units) / 1000000 / nullif(sum(w), 0) AS mean
              FROM weighed GROUP BY channel, draw
            ),
            seen AS (SELECT channel, sum(CAST(n AS DOUBLE) * units) / 1000000 / sum(n) AS mean_attribution FROM counts GROUP BY channel)
            SELECT channel, any_value(mean_attribution) AS mean_attribution, quantile_cont(mean, 0.025) AS ci_lower,
                   quantile_cont(mean, 0.975) AS ci_upper, stddev_samp(mean) AS std_error
            FROM means JOIN seen USING (channel) GROUP BY channel"""
        ),
    )
    register(
        "x9_bootstrap_blocks",
        "channel, mean_attribution:6, ci_lower:6, ci_upper:6, std_error:6",
        lambda t: X.bootstrap_means(t.attributed, blocks=1000),
        with_credit(
            f"""
            , sums AS (
              SELECT channel,
                     CAST('0x' || substr(md5(customer_id || '|' || touchpoint_number), 1, 8) AS BIGINT) % 1000
                       AS block,
                     count(*) AS n, sum(shapley_attribution) AS s
              FROM att GROUP BY 1, 2
            ),
            draws AS (
              SELECT block, r, CAST('0x' || substr(md5('42|' || block || '|' || r), 1, 8) AS BIGINT) AS b
              FROM range(1000) x(block), range(1000) y(r)
            ),
            means AS (
              SELECT channel, r, sum(w * s) / sum(w * n) AS mean
              FROM sums JOIN (SELECT block, r, {weight} AS w FROM draws) USING (block)
              WHERE w > 0 GROUP BY channel, r
            ),
            seen AS (SELECT channel, sum(s) / sum(n) AS mean_attribution FROM sums GROUP BY channel)
            SELECT channel, any_value(mean_attribution) AS mean_attribution,
                   quantile_cont(mean, 0.025) AS ci_lower, quantile_cont(mean, 0.975) AS ci_upper,
                   stddev_samp(mean) AS std_error
            FROM means JOIN seen USING (channel) GROUP BY channel"""
        ),
    )
    register(
        "x10_revenue_intervals",
        "channel, mean:6, ci_lower:6, ci_upper:6",
        lambda t: X.revenue_intervals(t.unnumbered),
        with_touches(_INTERVALS),
    )
    report = f"""
        m AS (
          SELECT count(*) AS n, avg(shapley_attribution) AS a, avg(last_touch_attribution) AS b,
                 var_samp(shapley_attribution) AS va, var_samp(last_touch_attribution) AS vb
          FROM att WHERE converted = 1
        ),
        e AS (SELECT (a - b) / sqrt(((n - 1) * va + (n - 1) * vb) / (n + n - 2)) AS effect_size FROM m),
        report AS (
        SELECT '2024-01-31' AS test_date, (SELECT count(DISTINCT customer_id) FROM att) AS n_customers,
               (SELECT count(*) FROM att) AS n_touchpoints, effect_size,
               ceil({2 * X._power_constant(0.05, 0.8)!r} / (effect_size * effect_size)) AS required_sample_size
        FROM e)"""
    register(
        "x11_validation_report",
        "test_date, n_customers:i, n_touchpoints:i, model_accuracy:6, model_auc:6, effect_size:6, "
        "required_sample_size:i",
        lambda t: jobs.validation_report(t.attributed),
        with_credit(
            f"""{_LOGIT.replace("FROM tp", "FROM att")}, {_LOGIT_QUALITY}, {report}
            SELECT CAST(current_date AS VARCHAR) AS test_date, report.* EXCLUDE (test_date), accuracy AS model_accuracy, auc AS model_auc
            FROM report, quality"""
        ),
    )
    register(
        "x11_report_sizes",
        "test_date, n_customers:i, n_touchpoints:i, effect_size:6, required_sample_size:i",
        lambda t: jobs.validation_report(t.attributed, on=date(2024, 1, 31)),
        with_credit(f", {report} SELECT * FROM report"),
    )


def _budget(register) -> None:
    weights = """
        , sums AS (
          SELECT channel, sum(cost) AS cost, sum(revenue) AS revenue, sum(shapley_attribution) AS credit
          FROM att GROUP BY channel
        ),
        gains AS (SELECT *, CASE WHEN cost > 0 THEN (revenue - cost) / cost ELSE 0 END AS gain FROM sums),
        wide AS (
          SELECT *, 1.0 / count(*) OVER () AS equal, credit / nullif(sum(credit) OVER (), 0) AS shapley,
                 CASE WHEN gain > 0 THEN gain / sum(gain) FILTER (gain > 0) OVER () END AS roi,
                 sum(cost) OVER () AS total_budget
          FROM gains
        ),
        w AS (
          SELECT * FROM (
            SELECT channel, cost, revenue, total_budget, 'equal' AS strategy, equal AS weight FROM wide
            UNION ALL SELECT channel, cost, revenue, total_budget, 'shapley', shapley FROM wide
            UNION ALL SELECT channel, cost, revenue, total_budget, 'roi', roi FROM wide)
          WHERE weight IS NOT NULL
        )"""
    register(
        "b1_allocation_weights",
        "strategy, channel, weight:6",
        lambda t: B.allocation_weights(t.attributed),
        with_credit(weights + " SELECT strategy, channel, weight FROM w"),
    )
    register(
        "b1_allocation_strategies",
        "strategy, expected_revenue:4, expected_roi:6",
        lambda t: B.allocation_strategies(t.attributed),
        with_credit(
            weights
            + """
            SELECT strategy, sum(total_budget * weight * CASE WHEN cost > 0 THEN revenue / cost ELSE 0 END)
                     AS expected_revenue,
                   (expected_revenue - any_value(total_budget)) / any_value(total_budget) AS expected_roi
            FROM w GROUP BY strategy"""
        ),
    )
    optimal = """
        , sums AS (SELECT channel, sum(cost) AS cost, sum(revenue) AS revenue FROM tp GROUP BY channel),
        pos AS (
          SELECT channel, cost, (revenue - cost) / nullif(cost, 0) AS roi, (SELECT sum(cost) FROM sums) AS budget
          FROM sums WHERE (revenue - cost) / nullif(cost, 0) > 0
        ),
        opt AS (
          SELECT channel, cost AS current_budget, budget * roi / sum(roi) OVER () AS optimal_budget, roi FROM pos
        )"""
    register(
        "b2_optimal_budget",
        "channel, current_budget:4, optimal_budget:4, budget_change:4, change_pct:4, roi:6",
        lambda t: B.optimal_budget(t.unnumbered),
        with_touches(
            optimal
            + """
            SELECT *, optimal_budget - current_budget AS budget_change,
                   (optimal_budget - current_budget) / current_budget * 100 AS change_pct FROM opt"""
        ),
    )
    register(
        "b3_budget_comparison",
        "channel, budget_type, amount:4",
        lambda t: B.budget_comparison(t.unnumbered),
        with_touches(
            optimal
            + """
            SELECT channel, 'current_budget' AS budget_type, current_budget AS amount FROM opt
            UNION ALL SELECT channel, 'optimal_budget', optimal_budget FROM opt"""
        ),
    )
    register(
        "b4_scenario_projection",
        "multiplier:4, total_budget:4, projected_revenue:4, projected_roi:6",
        lambda t: B.scenario_projection(t.unnumbered),
        with_touches(
            """
            , s AS (SELECT sum(cost) AS c, sum(revenue) AS r FROM tp)
            SELECT CAST(m AS DOUBLE) AS multiplier, c * m AS total_budget, r * m * 0.9 AS projected_revenue,
                   coalesce((r * m * 0.9 - c * m) / nullif(c * m, 0), 0) AS projected_roi
            FROM s, (VALUES (0.5::DOUBLE), (0.75::DOUBLE), (1.0::DOUBLE), (1.25::DOUBLE), (1.5::DOUBLE)) v(m)"""
        ),
    )


_GRID = """
    , dc AS (
      SELECT CAST("timestamp" AS DATE) AS date, channel, sum(cost) AS spend, count(*) AS impressions,
             sum(converted) AS conversions, sum(revenue) AS revenue
      FROM tp GROUP BY 1, 2
    ),
    grid AS (
      SELECT d.date, c.channel, coalesce(dc.spend, 0) AS spend, d.total_revenue
      FROM (SELECT date, sum(revenue) AS total_revenue FROM dc GROUP BY date) d
      CROSS JOIN (SELECT DISTINCT channel FROM dc) c
      LEFT JOIN dc ON dc.date = d.date AND dc.channel = c.channel
    ),
    ad AS (
      SELECT *, spend""" + "".join(
    f" + coalesce(lag(spend, {j}) OVER w, 0) * pow(0.7, {j})" for j in range(1, 9)
) + """ AS adstock
      FROM grid WINDOW w AS (PARTITION BY channel ORDER BY date)
    ),
    sat AS (
      SELECT *, coalesce(adstock / nullif(max(adstock) OVER (PARTITION BY channel), 0), 0) AS x FROM ad
    )"""


def _media_mix(register) -> None:
    register(
        "r1_daily_channel",
        "date, channel, spend:4, impressions:i, conversions:i, revenue:4",
        lambda t: R.daily_channel(t.unnumbered),
        with_touches(f"{_GRID} SELECT * FROM dc"),
    )
    spends = ", ".join(f"spend_{c}:4" for c in CHANNELS)
    revenues = ", ".join(f"revenue_{c}:4" for c in CHANNELS)
    cells = ", ".join(
        f"coalesce(sum(spend) FILTER (channel = '{c}'), 0) AS spend_{c}, "
        f"coalesce(sum(revenue) FILTER (channel = '{c}'), 0) AS revenue_{c}"
        for c in CHANNELS
    )
    register(
        "r2_daily_wide",
        f"date, {spends}, {revenues}, total_revenue:4",
        lambda t: R.daily_wide(R.daily_channel(t.unnumbered), CHANNELS),
        with_touches(f"{_GRID} SELECT date, {cells}, sum(revenue) AS total_revenue FROM dc GROUP BY date"),
    )
    register(
        "r2_daily_grid",
        "date, channel, spend:4, total_revenue:4",
        lambda t: R.daily_grid(R.daily_channel(t.unnumbered), CHANNELS),
        with_touches(f"{_GRID} SELECT * FROM grid"),
    )
    register(
        "r3_adstock",
        "date, channel, spend:4, adstock:4",
        lambda t: R.with_adstock(R.daily_grid(R.daily_channel(t.unnumbered), CHANNELS)),
        with_touches(f"{_GRID} SELECT * FROM ad"),
    )
    register(
        "r4_saturation",
        "date, channel, adstock:4, saturated:6",
        lambda t: R.transformed_grid(t.unnumbered, CHANNELS),
        with_touches(f"{_GRID} SELECT *, x / (x + 1) AS saturated FROM sat"),
    )
    xs = ", ".join(f"coalesce(max(x / (x + 1)) FILTER (channel = '{c}'), 0) AS x{i}" for i, c in enumerate(CHANNELS))
    fitted = f"""{_GRID},
        days AS MATERIALIZED (
          SELECT CAST('0x' || substr(md5('42|' || date), 1, 8) AS BIGINT) % 5 AS fold, max(total_revenue) AS y, {xs} FROM sat GROUP BY date
        ),
        {ridge_sql("days", CHANNELS, R.LAMBDAS)},
        chosen_ridge AS (SELECT channel, coefficient FROM ridge WHERE chosen)"""
    register(
        "r5_r6_ridge_coefficients",
        "channel, coefficient:4",
        lambda t: R.media_mix(t.unnumbered)[0],
        with_touches(f"{fitted} SELECT * FROM chosen_ridge WHERE coefficient <> 0"),
    )

    def equations(t):
        grid = R.transformed_grid(t.unnumbered, CHANNELS)
        found = R.ridge_equations(grid, R.ridge_path(grid, CHANNELS))
        return found.withColumn("gap", F.col("product") - F.col("shrinkage"))

    penalties = ", ".join(f"({x})" for x in R.LAMBDAS)
    register(
        "r5_ridge_equations",
        "penalty:4, channel, gap:8",
        equations,
        with_touches(f"SELECT penalty, channel, 0.0 AS gap FROM (VALUES {penalties}) v(penalty), (SELECT DISTINCT channel FROM tp)"),
    )
    register(
        "r5_ridge_path",
        "penalty:4, chosen:i, channel, coefficient:4, cv_error:4",
        lambda t: R.ridge_path(R.transformed_grid(t.unnumbered, CHANNELS), CHANNELS),
        with_touches(f"{fitted} SELECT * FROM ridge"),
    )
    explained = f"""{fitted},
        con AS (
          SELECT channel, sum(x / (x + 1)) * coalesce(any_value(coefficient), 0) AS contribution, sum(spend) AS spend
          FROM sat LEFT JOIN chosen_ridge USING (channel) GROUP BY channel
        ),
        conr AS (SELECT *, CASE WHEN spend > 0 THEN contribution / spend ELSE 0 END AS roi FROM con)"""
    budget = """
            o AS (SELECT channel, spend AS current_spend,
                         sum(spend) OVER () * roi / nullif(sum(roi) OVER (), 0) AS optimal_spend, roi FROM conr)
            SELECT *, optimal_spend - current_spend AS spend_change,
                   (optimal_spend - current_spend) / nullif(current_spend, 0) * 100 AS change_pct FROM o"""
    register(
        "r7_contributions",
        "channel, contribution:4, spend:4, roi:6, contribution_pct:4",
        lambda t: R.media_mix(t.unnumbered)[1],
        with_touches(f"{explained} SELECT *, contribution / sum(contribution) OVER () * 100 AS contribution_pct FROM conr"),
    )
    # the same formulas on stated coefficients, so that the arithmetic has SQL to match
    fixed = [(c, 100.0 * (i + 1)) for i, c in enumerate(CHANNELS)]
    values = ", ".join(f"('{c}', {w})" for c, w in fixed)
    contribution = f"""{_GRID},
        con AS (
          SELECT channel, sum(x / (x + 1)) * any_value(w) AS contribution, sum(spend) AS spend
          FROM sat JOIN (VALUES {values}) v(channel, w) USING (channel) GROUP BY channel
        ),
        conr AS (SELECT *, CASE WHEN spend > 0 THEN contribution / spend ELSE 0 END AS roi FROM con)"""

    def given(t):
        weights = t.spark.createDataFrame(fixed, "channel string, coefficient double")
        return R.contributions(R.transformed_grid(t.unnumbered, CHANNELS), weights)

    register(
        "r7_contributions_given_coefficients",
        "channel, contribution:4, spend:4, roi:6, contribution_pct:4",
        given,
        with_touches(
            f"{contribution} SELECT *, contribution / sum(contribution) OVER () * 100 AS contribution_pct FROM conr"
        ),
    )
    register(
        "r8_budget_by_roi",
        "channel, current_spend:4, optimal_spend:4, spend_change:4, change_pct:4, roi:6",
        lambda t: R.media_mix(t.unnumbered)[2],
        with_touches(f"{explained}, {budget}"),
    )
    register(
        "r8_budget_by_roi_given_coefficients",
        "channel, current_spend:4, optimal_spend:4, spend_change:4, change_pct:4, roi:6",
        lambda t: R.budget_by_roi(given(t)),
        with_touches(
            f"""{contribution},
            o AS (SELECT channel, spend AS current_spend,
                         sum(spend) OVER () * roi / nullif(sum(roi) OVER (), 0) AS optimal_spend, roi FROM conr)
            SELECT *, optimal_spend - current_spend AS spend_change,
                   (optimal_spend - current_spend) / nullif(current_spend, 0) * 100 AS change_pct FROM o"""
        ),
    )
    register(
        "r9_calendar_terms",
        "date, trend:i, day_of_week:i, month:i",
        lambda t: R.calendar_terms(R.daily_channel(t.unnumbered)),
        with_touches(
            f"""{_GRID}
            SELECT date, row_number() OVER (ORDER BY date) AS trend, dayofweek(date) + 1 AS day_of_week,
                   month(date) AS month
            FROM (SELECT DISTINCT date FROM dc)"""
        ),
    )


_WEEKLY = """
    , wk AS (
      SELECT week("timestamp") AS week, channel, avg(converted) AS conversion_rate, sum(revenue) AS revenue,
             sum(cost) AS cost, count(DISTINCT customer_id) AS customers
      FROM tp GROUP BY 1, 2
    )"""
_LAGS = """
    lagged AS (
      SELECT series, value AS y, lag(value) OVER w AS z, row_number() OVER w AS t,
             count(*) OVER (PARTITION BY series) AS points
      FROM obs WINDOW w AS (PARTITION BY series ORDER BY pos)
    )"""
_FIT = """SELECT series, coalesce(regr_slope(y, z), 0) AS b, coalesce(regr_intercept(y, z), avg(y)) AS a,
                 arg_max(y, t) AS y_last, max(t) AS t_last FROM lagged {where} GROUP BY series"""
_AHEAD = "pow(b, {h}) * y_last + CASE WHEN b = 1 THEN a * {h} ELSE a * (1 - pow(b, {h})) / (1 - b) END"


# Autoregressions of order 0 to 3 by the recursion written out, the one of least AIC, and its forecasts.
_ORDERS = """
    dev AS (
      SELECT series, row_number() OVER (PARTITION BY series ORDER BY pos) AS t, value,
             value - avg(value) OVER (PARTITION BY series) AS d, avg(value) OVER (PARTITION BY series) AS m,
             count(*) OVER (PARTITION BY series) AS n FROM obs
    ),
    cov AS (
      SELECT a.series, any_value(a.n) AS n, any_value(a.m) AS m,
             coalesce(sum(a.d * b.d) FILTER (a.t = b.t), 0) / any_value(a.n) AS c0,
             coalesce(sum(a.d * b.d) FILTER (a.t = b.t + 1), 0) / any_value(a.n) AS c1,
             coalesce(sum(a.d * b.d) FILTER (a.t = b.t + 2), 0) / any_value(a.n) AS c2,
             coalesce(sum(a.d * b.d) FILTER (a.t = b.t + 3), 0) / any_value(a.n) AS c3
      FROM dev a JOIN dev b ON a.series = b.series AND a.t - b.t BETWEEN 0 AND 3 GROUP BY a.series
    ),
    one AS (SELECT *, c1 / c0 AS r1, c0 * (1 - pow(c1 / c0, 2)) AS v1 FROM cov),
    two AS (SELECT *, (c2 - r1 * c1) / v1 AS r2 FROM one),
    twov AS (SELECT *, r1 - r2 * r1 AS p21, v1 * (1 - r2 * r2) AS v2 FROM two),
    three AS (SELECT *, (c3 - p21 * c2 - r2 * c1) / v2 AS r3 FROM twov),
    threev AS (SELECT *, v2 * (1 - r3 * r3) AS v3 FROM three),
    choice AS (
      SELECT series, m, 0 AS k, n * ln(c0) + 2 AS aic, 0.0 AS f1, 0.0 AS f2, 0.0 AS f3 FROM threev
      UNION ALL SELECT series, m, 1, n * ln(v1) + 4, r1, 0, 0 FROM threev WHERE n > 2
      UNION ALL SELECT series, m, 2, n * ln(v2) + 6, p21, r2, 0 FROM threev WHERE n > 3
      UNION ALL SELECT series, m, 3, n * ln(v3) + 8, p21 - r3 * r2, r2 - r3 * p21, r3 FROM threev WHERE n > 4
    ),
    fit AS (SELECT * FROM choice QUALIFY row_number() OVER (PARTITION BY series ORDER BY aic, k) = 1),
    ends AS (
      SELECT series, max(value) FILTER (t = n) AS y1, max(value) FILTER (t = n - 1) AS y2, max(value) FILTER (t = n - 2) AS y3
      FROM dev GROUP BY series
    ),
    s0 AS (SELECT fit.*, 0 AS h, y1, coalesce(y2, 0) AS y2, coalesce(y3, 0) AS y3 FROM fit JOIN ends USING (series)),
    path AS ({path})
    SELECT series, k AS ar_order, h AS step, y1 AS forecast FROM path WHERE h > 0"""
_STEP = "m + f1 * (y1 - m) + f2 * (y2 - m) + f3 * (y3 - m)"


def _orders(steps: int) -> str:
    """The forecasts one step after the other, as a chain of tables."""
    parts = ["SELECT * FROM s0"]
    for h in range(1, steps + 1):
        source = parts[-1]
        parts.append(f"SELECT series, m, k, aic, f1, f2, f3, {h} AS h, {_STEP} AS y1, y1 AS y2, y2 AS y3 FROM ({source})")
    return _ORDERS.replace("{path}", " UNION ALL ".join(parts))


def _partialled(lags: int) -> str:
    """The unit-root regression with ``lags`` earlier changes, each taken out of all columns in turn."""
    columns = ["dy", "y1", *[f"d{k}" for k in range(1, lags + 1)]]
    moved = ", ".join(f"lag(dy, {k}) OVER w AS d{k}" for k in range(1, lags + 1))
    whole = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    body = f"""
      SELECT series, {", ".join(columns)} FROM (
        SELECT series, pos, y1, dy {"," + moved if moved else ""} FROM (
          SELECT series, pos, lag(value) OVER w AS y1, value - lag(value) OVER w AS dy FROM obs
          WINDOW w AS (PARTITION BY series ORDER BY pos)
        ) WINDOW w AS (PARTITION BY series ORDER BY pos)
      ) WHERE {whole}"""
    for k in range(lags, 0, -1):
        left = columns[: k + 1]
        rest = ", ".join(f"{c} - regr_intercept({c}, d{k}) OVER g - d{k} * regr_slope({c}, d{k}) OVER g AS {c}" for c in left)
        body = f"SELECT series, {rest} FROM ({body}) WINDOW g AS (PARTITION BY series)"
    return f"""adf{lags} AS (
      SELECT series, {lags} AS lags, n AS rows, sxy / sxx AS gamma,
             (sxy / sxx) / sqrt((syy - sxy * sxy / sxx) / (n - {2 + lags}) / sxx) AS df_statistic
      FROM (SELECT series, count(*) AS n, regr_sxx(dy, y1) AS sxx, regr_syy(dy, y1) AS syy, regr_sxy(dy, y1) AS sxy
            FROM ({body}) GROUP BY series)
    )"""


def _time_series(register) -> None:
    daily = ", ".join(f"sum({c}) AS {c}" for c in D.SERIES)
    register(
        "d1_daily_attribution",
        "date, " + ", ".join(f"{c}:4" for c in D.SERIES),
        lambda t: D.daily_attribution(t.attributed),
        with_credit(f'SELECT CAST("timestamp" AS DATE) AS date, {daily} FROM att GROUP BY 1'),
    )
    register(
        "d2_weekly_channel",
        "week:i, channel, conversion_rate:6, revenue:4, cost:4, customers:i",
        lambda t: D.weekly_channel(t.unnumbered),
        with_touches(f"{_WEEKLY} SELECT * FROM wk"),
    )
    register(
        "d2_weekly_channel_by_year",
        "iso_year:i, week:i, channel, conversion_rate:6, revenue:4, cost:4, customers:i",
        lambda t: D.weekly_channel(t.unnumbered, with_year=True),
        with_touches(
            """
            SELECT isoyear("timestamp") AS iso_year, week("timestamp") AS week, channel,
                   avg(converted) AS conversion_rate, sum(revenue) AS revenue, sum(cost) AS cost,
                   count(DISTINCT customer_id) AS customers
            FROM tp GROUP BY 1, 2, 3"""
        ),
    )
    register(
        "d3_channel_trends",
        "channel, trend_slope:6, trend_direction, current_conv_rate:6, weekly_data_points:i",
        lambda t: D.channel_trends(D.weekly_channel(t.unnumbered)),
        with_touches(
            f"""{_WEEKLY}
            SELECT channel, regr_slope(conversion_rate, week) AS trend_slope,
                   CASE WHEN regr_slope(conversion_rate, week) > 0 THEN 'improving' ELSE 'declining' END
                     AS trend_direction,
                   arg_max(conversion_rate, week) AS current_conv_rate, count(*) AS weekly_data_points
            FROM wk GROUP BY channel HAVING count(*) > 4"""
        ),
    )
    rolling = """
        , dy AS (
          SELECT CAST("timestamp" AS DATE) AS date, sum(revenue) AS revenue, sum(cost) AS cost,
                 CAST(sum(converted) AS DOUBLE) AS converted
          FROM tp GROUP BY 1
        ),
        lg AS (
          SELECT date, 'revenue' AS metric, revenue AS value FROM dy
          UNION ALL SELECT date, 'cost', cost FROM dy UNION ALL SELECT date, 'converted', converted FROM dy
        ),
        rl AS (
          SELECT *, avg(value) OVER w AS rolling_mean, stddev_samp(value) OVER w AS rolling_std
          FROM lg WINDOW w AS (PARTITION BY metric ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
        ),
        sc AS (
          SELECT *, (value - rolling_mean) / nullif(rolling_std, 0) AS deviation,
                 coalesce(abs(value - rolling_mean) > 2 * rolling_std, false) AS is_anomaly
          FROM rl
        )"""
    register(
        "d4_rolling_scores",
        "date, metric, value:4, rolling_mean:4, rolling_std:4, deviation:6, is_anomaly:i",
        lambda t: D.rolling_scores(t.unnumbered),
        with_touches(f"{rolling} SELECT * FROM sc"),
    )
    register(
        "d4_anomaly_summary",
        "metric, anomaly_dates:a, anomaly_count:i, max_deviation:6",
        lambda t: D.anomaly_summary(D.rolling_scores(t.unnumbered)),
        with_touches(
            f"""{rolling}
            SELECT metric, coalesce(list(CAST(date AS VARCHAR) ORDER BY date) FILTER (is_anomaly), [])
                     AS anomaly_dates,
                   count(*) FILTER (is_anomaly) AS anomaly_count, max(deviation) AS max_deviation
            FROM sc GROUP BY metric"""
        ),
    )
    methods = ["shapley_attribution", "markov_attribution"]
    by_day = (
        ", obs AS ("
        + " UNION ALL ".join(
            f"""SELECT '{m}' AS series, CAST("timestamp" AS DATE) AS pos, sum({m}) AS value FROM att GROUP BY 2"""
            for m in methods
        )
        + "),"
        + _LAGS
    )
    by_week = f"{_WEEKLY}, obs AS (SELECT channel AS series, week AS pos, conversion_rate AS value FROM wk),{_LAGS}"

    def daily_series(t):
        return D.daily_series(t.attributed, methods)

    def weekly_series(t):
        return D.weekly_channel(t.unnumbered).select(F.col("channel").alias("series"), "week", "conversion_rate")

    ahead = _AHEAD.format(h="h")
    register(
        "d5_daily_forecast",
        "series, step:i, forecast:4",
        lambda t: D.ar1_forecast(daily_series(t), "series", "date", "value", 7),
        with_credit(
            f"{by_day}, fit AS ({_FIT.format(where='')}) "
            f"SELECT series, h AS step, {ahead} AS forecast FROM fit, range(1, 8) r(h)"
        ),
    )
    register(
        "d5_weekly_rate_forecast",
        "series, step:i, forecast:6",
        lambda t: D.ar1_forecast(weekly_series(t), "series", "week", "conversion_rate", 4),
        with_touches(
            f"{by_week}, fit AS ({_FIT.format(where='')}) "
            f"SELECT series, h AS step, {ahead} AS forecast FROM fit, range(1, 5) r(h)"
        ),
    )
    register(
        "d5_daily_order_forecast",
        "series, ar_order:i, step:i, forecast:4",
        lambda t: D.ar_forecast(daily_series(t), "series", "date", "value", 7, 3).withColumnRenamed("order", "ar_order"),
        with_credit(by_day + "," + _orders(7)),
    )
    register(
        "d5_weekly_order_forecast",
        "series, ar_order:i, step:i, forecast:6",
        lambda t: D.ar_forecast(weekly_series(t), "series", "week", "conversion_rate", 4, 3).withColumnRenamed("order", "ar_order"),
        with_touches(by_week + "," + _orders(4)),
    )
    held = _AHEAD.format(h="(t - t_last)")
    register(
        "d5_holdout_error",
        "series, mae:4, held_out:i",
        lambda t: D.ar1_holdout_mae(daily_series(t), "series", "date", "value"),
        with_credit(
            f"""{by_day}, fit AS ({_FIT.format(where='WHERE t <= floor(points * 0.8)')})
            SELECT series, avg(abs(y - ({held}))) AS mae, count(*) AS held_out
            FROM lagged JOIN fit USING (series) WHERE t > floor(points * 0.8) GROUP BY series"""
        ),
    )
    def with_lags(t):
        parts = [D.augmented_dickey_fuller(daily_series(t), "series", "date", "value", p).withColumn("lags", F.lit(p)) for p in range(3)]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    register(
        "d6_lagged_stationarity",
        "series, lags:i, rows:i, gamma:6, df_statistic:5",
        with_lags,
        with_credit(by_day + ", " + ", ".join(_partialled(p) for p in range(3)) + " " + " UNION ALL ".join(f"SELECT * FROM adf{p}" for p in range(3))),
    )
    register(
        "d6_stationarity",
        "series, pairs:i, gamma:6, df_statistic:6",
        lambda t: D.dickey_fuller(daily_series(t), "series", "date", "value"),
        with_credit(
            f"""{by_day}, m AS (
              SELECT series, regr_count(y - z, z) AS n, regr_sxx(y - z, z) AS sxx, regr_syy(y - z, z) AS syy,
                     regr_sxy(y - z, z) AS sxy
              FROM lagged GROUP BY series
            )
            SELECT series, n AS pairs, sxy / sxx AS gamma,
                   (sxy / sxx) / sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx) AS df_statistic
            FROM m"""
        ),
    )


def _forest(t):
    train, test = L.split(J.conversion_features(t.touches), 0.2, 42)
    return L.train_pipeline(train), test


_FLAGS = """
        SELECT customer_id, max(converted) AS converted, count(*) AS journey_length,
               count(DISTINCT channel) AS unique_channels, sum(cost) AS total_cost, sum(time_on_site) AS total_time,
               max(CASE WHEN channel = 'paid_search' THEN 1 ELSE 0 END) AS has_paid_search,
               max(CASE WHEN channel = 'email' THEN 1 ELSE 0 END) AS has_email,
               max(CASE WHEN channel = 'social_media' THEN 1 ELSE 0 END) AS has_social
        FROM tp GROUP BY customer_id"""
_FLAGGED = """
            , flagged AS MATERIALIZED (
              SELECT *, has_search * has_social AS search_social, has_search * has_email AS search_email,
                     has_social * has_email AS social_email
              FROM (SELECT customer_id, max(converted) AS converted,
                           max(CASE WHEN channel IN ('paid_search', 'organic_search') THEN 1 ELSE 0 END) AS has_search,
                           max(CASE WHEN channel = 'social_media' THEN 1 ELSE 0 END) AS has_social,
                           max(CASE WHEN channel = 'email' THEN 1 ELSE 0 END) AS has_email,
                           max(CASE WHEN channel = 'display' THEN 1 ELSE 0 END) AS has_display
                    FROM tp GROUP BY customer_id)
            )"""
_HELD = "CAST('0x' || substr(md5('42|' || customer_id), 1, 8) AS BIGINT) % 10000 < 2000"
_LOGIT = f""", flags AS MATERIALIZED ({_FLAGS}), train AS MATERIALIZED (SELECT * FROM flags WHERE NOT ({_HELD})),
    {logistic("fit", "train", L.LOGIT_INPUTS)}"""
_LOGIT_QUALITY = f"""
    held AS MATERIALIZED (
      SELECT converted, 1 / (1 + exp(-({" + ".join(f"beta[{i + 1}] * {x}" for i, x in enumerate(["1", *L.LOGIT_INPUTS]))}))) AS p
      FROM flags, fit WHERE {_HELD}
    ),
    ranked AS (SELECT converted, avg(r) OVER (PARTITION BY p) AS r FROM (SELECT converted, p, row_number() OVER (ORDER BY p) AS r FROM held)),
    quality AS (
      SELECT (sum(r) FILTER (converted = 1) - sum(converted) * (sum(converted) + 1) / 2.0) / (sum(converted) * (count(*) - sum(converted))) AS auc,
             (SELECT avg(CAST((p > 0.5) = (converted = 1) AS INTEGER)) FROM held) AS accuracy, count(*) AS test_rows
      FROM ranked
    )"""


def _models(register) -> None:
    def quality(t):
        model, test = _forest(t)
        return L.evaluate(model, test)

    register("l1_l3_forest_quality", "auc:6, accuracy:6, test_rows:i", quality)
    parts = """
        , f AS (
          SELECT customer_id, max(converted) AS label,
                 CAST('0x' || substr(md5('42|' || customer_id), 1, 8) AS BIGINT) % 10000 AS bucket
          FROM tp GROUP BY customer_id
        )"""

    def shares(features, label=None):
        train, test = L.split(features, 0.2, 42, label)
        both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
        return both.groupBy("part", "label").agg(F.count(F.lit(1)).alias("journeys"))

    register(
        "l2_split",
        "part, label:i, journeys:i",
        lambda t: shares(J.conversion_features(t.touches)),
        with_touches(
            f"""{parts} SELECT CASE WHEN bucket < 2000 THEN 'test' ELSE 'train' END AS part, label,
                               count(*) AS journeys FROM f GROUP BY 1, 2"""
        ),
    )
    register(
        "l2_stratified_split",
        "part, label:i, journeys:i",
        lambda t: shares(J.conversion_features(t.touches), "label"),
        with_touches(
            f"""{parts}, r AS (
              SELECT *, count(*) OVER (PARTITION BY label ORDER BY bucket) AS reached,
                     count(*) OVER (PARTITION BY label) * 0.2 AS wanted FROM f
            )
            SELECT CASE WHEN reached <= wanted THEN 'test' ELSE 'train' END AS part, label, count(*) AS journeys
            FROM r GROUP BY 1, 2"""
        ),
    )
    register(
        "l4_feature_importance",
        "feature, importance:6",
        lambda t: L.feature_importance(_forest(t)[0]),
    )
    register(
        "l5_journey_scores",
        "customer_id:i, actual_conversion:i, predicted_conversion:i, conversion_probability:6, journey_length:i, "
        "unique_channels:i, total_cost:4, attribution_score:4",
        lambda t: L.score_journeys(_forest(t)[0], t.touches),
    )
    for kind in ("random_forest", "gradient_boost", "logistic"):
        register(
            f"l6_{kind}",
            "model, auc:6, accuracy:6, test_rows:i",
            lambda t, kind=kind: L.compare_models(t.touches, CHANNELS, [kind]),
        )
    register(
        "l7_encoded_end_channels",
        "customer_id:i, first_channel_encoded:i, last_channel_encoded:i",
        lambda t: L.encode_end_channels(J.journey_features(t.touches, CHANNELS)),
        with_touches(
            """
            , e AS (SELECT customer_id, arg_min(channel, touchpoint_number) AS a,
                           arg_max(channel, touchpoint_number) AS b FROM tp GROUP BY customer_id),
            k AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS i
                  FROM (SELECT a AS c FROM e UNION SELECT b FROM e))
            SELECT customer_id, x.i AS first_channel_encoded, y.i AS last_channel_encoded
            FROM e JOIN k x ON x.c = a JOIN k y ON y.c = b"""
        ),
    )
    register(
        "l8_logit_coefficients",
        "term, estimate:6, std_error:6, statistic:4, p_value:6",
        lambda t: L.logit_validation(t.unnumbered)[0],
        with_touches(f"{_LOGIT} {coefficients('fit', L.LOGIT_INPUTS)}"),
    )
    register(
        "l8_logit_quality",
        "auc:6, accuracy:6, test_rows:i",
        lambda t: L.logit_validation(t.unnumbered)[1],
        with_touches(f"{_LOGIT}, {_LOGIT_QUALITY} SELECT * FROM quality"),
    )
    register(
        "l8_logit_features",
        "customer_id:i, converted:i, journey_length:i, unique_channels:i, total_cost:4, total_time:4, "
        "has_paid_search:i, has_email:i, has_social:i",
        lambda t: L.logit_features(t.unnumbered),
        with_touches(_FLAGS),
    )
    register(
        "l8_score_equations",
        "term, observed:2, fitted:2",
        lambda t: L.logit_score_equations(t.unnumbered),
        with_touches(
            f"""
            , f AS ({_FLAGS}),
            train AS (SELECT * FROM f WHERE CAST('0x' || substr(md5('42|' || customer_id), 1, 8) AS BIGINT) % 10000 >= 2000),
            s AS (
              SELECT '(Intercept)' AS term, sum(converted) AS observed FROM train
              {" ".join(f"UNION ALL SELECT '{x}', sum(converted * {x}) FROM train" for x in L.LOGIT_INPUTS)}
            )
            SELECT term, observed, observed AS fitted FROM s"""
        ),
    )
    both_terms = [("main", x) for x in L.MAIN_EFFECTS] + [("interactions", x) for x in [*L.MAIN_EFFECTS, *L.INTERACTIONS]]
    register(
        "l10_score_equations",
        "model, term, observed:4, fitted:4",
        lambda t: L.interaction_score_equations(t.unnumbered),
        with_touches(
            f"""
            , j AS (
              SELECT customer_id, max(converted) AS converted,
                     max(CASE WHEN channel IN ('paid_search', 'organic_search') THEN 1 ELSE 0 END) AS has_search,
                     max(CASE WHEN channel = 'social_media' THEN 1 ELSE 0 END) AS has_social,
                     max(CASE WHEN channel = 'email' THEN 1 ELSE 0 END) AS has_email,
                     max(CASE WHEN channel = 'display' THEN 1 ELSE 0 END) AS has_display
              FROM tp GROUP BY customer_id
            ),
            k AS (SELECT *, has_search * has_social AS search_social, has_search * has_email AS search_email,
                         has_social * has_email AS social_email FROM j),
            s AS (
              SELECT unnest(['main', 'interactions']) AS model, '(Intercept)' AS term, sum(converted) AS observed FROM k
              {" ".join(f"UNION ALL SELECT '{m}', '{x}', sum(converted * {x}) FROM k" for m, x in both_terms)}
            )
            SELECT model, term, observed, observed AS fitted FROM s"""
        ),
    )
    q = len(L.LOGIT_INPUTS)
    spread = f"m[(c // {q} + 1) * {q + 2} + c % {q} + 2]"
    own = lambda i: f"m[({i} + 1) * {q + 2} + {i} + 2]"
    related = f"list_transform(range({q * q}), lambda c: {spread} / sqrt({own(f'c // {q}')} * {own(f'c % {q}')}))"
    inverse = swept_sql(f"SELECT {related} AS m FROM fit", "1 AS one", q, q)
    names = ", ".join(f"'{x}'" for x in L.LOGIT_INPUTS)
    register(
        "l9_variance_inflation",
        "term, vif:6",
        lambda t: L.variance_inflation(t.unnumbered),
        with_touches(
            f"""{_LOGIT} SELECT unnest([{names}]) AS term, unnest(list_transform(range({q}), lambda i: m[i * {q} + i + 1])) AS vif
                FROM ({inverse})"""
        ),
    )
    register(
        "l10_interaction_counts",
        "has_search:i, has_social:i, has_email:i, has_display:i, search_social:i, search_email:i, social_email:i, "
        "journeys:i, conversions:i, converted:6",
        lambda t: L.interaction_counts(t.unnumbered),
        with_touches(
            """
            , j AS (
              SELECT customer_id, max(converted) AS converted,
                     max(CASE WHEN channel IN ('paid_search', 'organic_search') THEN 1 ELSE 0 END) AS has_search,
                     max(CASE WHEN channel = 'social_media' THEN 1 ELSE 0 END) AS has_social,
                     max(CASE WHEN channel = 'email' THEN 1 ELSE 0 END) AS has_email,
                     max(CASE WHEN channel = 'display' THEN 1 ELSE 0 END) AS has_display
              FROM tp GROUP BY customer_id
            )
            SELECT *, has_search * has_social AS search_social, has_search * has_email AS search_email,
                   has_social * has_email AS social_email
            FROM (SELECT has_search, has_social, has_email, has_display, count(*) AS journeys,
                         sum(converted) AS conversions, avg(converted) AS converted
                  FROM j GROUP BY ALL)"""
        ),
    )
    every = [*L.MAIN_EFFECTS, *L.INTERACTIONS]
    likelihood = lambda fit, inputs: f"""SELECT sum(converted * ln(p) + (1 - converted) * ln(1 - p)) AS v FROM (
        SELECT converted, 1 / (1 + exp(-({" + ".join(f"beta[{i + 1}] * {x}" for i, x in enumerate(["1", *inputs]))}))) AS p FROM flagged, {fit})"""  # noqa: E731
    fits = f"""{_FLAGGED}, {logistic("plain", "flagged", L.MAIN_EFFECTS)}, {logistic("rich", "flagged", every)}"""
    register(
        "l10_interaction_test",
        "lr_statistic:4, df:i, p_value:6",
        lambda t: L.interaction_test(t.unnumbered)[0],
        with_touches(
            f"""{fits},
            lr AS (SELECT 2 * (b.v - a.v) AS x FROM ({likelihood("plain", L.MAIN_EFFECTS)}) a, ({likelihood("rich", every)}) b)
            SELECT any_value(x) AS lr_statistic, 3 AS df,
                   sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                       * sqrt(2 / pi()) * pow(sqrt(x) + i / 200.0, 2) * exp(-pow(sqrt(x) + i / 200.0, 2) / 2)) / 600 AS p_value
            FROM lr, range(2001) r(i)"""
        ),
    )
    register(
        "l10_interaction_terms",
        "term, estimate:6, std_error:6, statistic:4, p_value:6",
        lambda t: L.interaction_test(t.unnumbered)[1],
        with_touches(
            f"""{fits} SELECT * FROM ({coefficients("rich", every)}) WHERE term IN ({", ".join(f"'{x}'" for x in L.INTERACTIONS)})"""
        ),
    )


def _sinks(register) -> None:
    def csv_round_trip(t):
        path = fresh_path(t.spark, "touchpoints_csv")
        write_csv(t.touches, path)
        return read_touchpoints(t.spark, path, "csv").withColumn("second", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))

    def parquet_round_trip(t):
        path = fresh_path(t.spark, "touchpoints")
        write_parquet(t.touches, path)
        return read_touchpoints(t.spark, path, "parquet").withColumn("second", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))

    def ga_csv(t):
        path = fresh_path(t.spark, "ga_csv")
        flag = F.when(F.col("converted") == 1, F.when(F.length("session_id") % 2 == 0, "1.0").otherwise("True")).otherwise("0.0")
        visitor = F.concat(F.lit("v-"), F.col("customer_id"), F.lit("-99999999999999999999"))
        write_csv(t.ga_touches.withColumns({"converted": flag, "customer_id": visitor}), path)
        return read_touchpoints(t.spark, path).withColumn("second", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))

    register(
        "s1_ga_touchpoints_csv",
        "customer_id, touchpoint_number:i, session_id, channel, device, cost:4, converted:i, revenue:4, second",
        ga_csv,
        with_ga_touches(
            """SELECT * REPLACE ('v-' || customer_id || '-99999999999999999999' AS customer_id),
                      strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS second FROM tp"""
        ),
    )
    register("s1_s4_touchpoints_csv", _TOUCH_COLUMNS, csv_round_trip, with_touches(_TOUCH_SQL))
    register("s3_s8_touchpoints_parquet", _TOUCH_COLUMNS, parquet_round_trip, with_touches(_TOUCH_SQL))

    def spoiled(t):
        """A CSV folder in which one event in seven of fifty has a bad cell, a reserved channel or no customer."""
        n = F.substring("session_id", 2, 20).cast("long") % 50
        bad = {"cost": n.isin(0, 6), "timestamp": n == 1, "converted": n == 2, "pages_viewed": n == 5, "time_on_site": n == 6}
        cells = {c: F.when(where, F.lit("n/a")).otherwise(F.col(c).cast("string")) for c, where in bad.items()}
        cells |= {"customer_id": F.when(n != 3, F.col("customer_id")), "channel": F.when(n == 4, "start").otherwise(F.col("channel"))}
        path = fresh_path(t.spark, "spoiled_csv")
        write_csv(t.touches.withColumns(cells), path)
        return path

    event = "CAST(substr(session_id, 2) AS BIGINT) % 50"
    reasons = f"""
        SELECT session_id, CASE {event} WHEN 0 THEN ['cost: not a double'] WHEN 1 THEN ['timestamp: not a timestamp']
                                        WHEN 2 THEN ['converted: not a flag'] WHEN 3 THEN ['customer_id: missing']
                                        WHEN 4 THEN ['channel: reserved name'] WHEN 5 THEN ['pages_viewed: not a int']
                                        ELSE ['cost: not a double', 'time_on_site: not a double'] END AS reasons
        FROM tp WHERE {event} < 7"""
    register(
        "s1_accepted_touchpoints",
        _TOUCH_COLUMNS,
        lambda t: read_touchpoints(t.spark, spoiled(t), customer_type=T.LongType()).withColumn("second", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")),
        with_touches(f"{_TOUCH_SQL} WHERE {event} > 6"),
    )
    register(
        "s1_rejected_touchpoints",
        "session_id, reasons:a",
        lambda t: rejected_touches(t.spark, spoiled(t)).withColumn("reasons", F.array_sort("reasons")),
        with_touches(f"SELECT session_id, list_sort(reasons) AS reasons FROM ({reasons})"),
    )
    register(
        "s1_reject_counts",
        "reason, rows:i",
        lambda t: reject_counts(rejected_touches(t.spark, spoiled(t))),
        with_touches(f"SELECT reason, count(*) AS rows FROM (SELECT unnest(reasons) AS reason FROM ({reasons})) GROUP BY reason"),
    )

    def etl_table(name, runs=1):
        def build(t):
            out = fresh_path(t.spark, "etl")
            for _ in range(runs):  # a further run replaces what the one before wrote
                paths = jobs.run_etl(t.touches, out)
            return t.spark.read.parquet(paths[name])

        return build

    register(
        "s3_etl_journeys",
        f"{_KEY}, channel, date, prev_channel, next_channel, time_since_prev:i, revenue:4",
        etl_table("journeys", runs=2),
        with_touches(
            """
            SELECT *, CAST("timestamp" AS DATE) AS date, lag(channel) OVER w AS prev_channel, lead(channel) OVER w AS next_channel,
                   coalesce(floor(epoch("timestamp")) - floor(epoch(lag("timestamp") OVER w)), 0) AS time_since_prev
            FROM tp WINDOW w AS (PARTITION BY customer_id ORDER BY touchpoint_number)"""
        ),
    )
    register(
        "s3_etl_journey_patterns",
        "path_length:i, path_key, converted:i, frequency:i, avg_revenue:4",
        etl_table("journey_patterns"),
        with_touches(
            PATH_KEYS
            + """
            SELECT path_length, path_key, converted, count(*) AS frequency, avg(revenue) AS avg_revenue
            FROM key GROUP BY path_length, path_key, converted"""
        ),
    )
    register(
        "s3_etl_conversion_paths",
        "path_length:i, path_key, conversions:i, total_revenue:4, avg_revenue:4",
        etl_table("conversion_paths"),
        with_touches(CONVERSION_KEYS),
    )
    register(
        "s3_etl_path_steps",
        "path_length:i, path_key, chunk:i, steps",
        etl_table("path_steps"),
        with_touches(
            PATH_KEYS
            + """
            , one AS (SELECT path_length, path_key, min(customer_id) AS customer_id FROM key GROUP BY 1, 2)
            SELECT path_length, path_key, (touchpoint_number - 1) // 1000 AS chunk,
                   string_agg(channel, ' -> ' ORDER BY touchpoint_number) AS steps
            FROM one JOIN tp USING (customer_id) GROUP BY 1, 2, 3"""
        ),
    )
    register(
        "s3_etl_channel_metrics",
        "channel, total_touches:i, unique_customers:i, total_cost:4, total_revenue:4",
        etl_table("channel_metrics"),
        with_touches(
            """
            SELECT channel, count(*) AS total_touches, count(DISTINCT customer_id) AS unique_customers,
                   sum(cost) AS total_cost, sum(revenue) AS total_revenue FROM tp GROUP BY channel"""
        ),
    )

    def json_summary(t):
        path = fresh_path(t.spark, "summary")
        write_json_summary(A.dataset_summary(t.touches).drop("channels"), path)
        schema = "total_customers bigint, total_touchpoints bigint, total_conversions bigint, total_revenue double"
        return t.spark.read.schema(schema).json(path)

    register(
        "s5_json_summary",
        "total_customers:i, total_touchpoints:i, total_conversions:i, total_revenue:4",
        json_summary,
        with_touches(
            """
            SELECT count(DISTINCT customer_id) AS total_customers, count(*) AS total_touchpoints,
                   count(DISTINCT CASE WHEN converted = 1 THEN customer_id END) AS total_conversions,
                   sum(revenue) AS total_revenue FROM tp"""
        ),
    )

    def saved_model(t):
        model, _ = _forest(t)
        path = fresh_path(t.spark, "model")
        L.save_model(model, path)
        scores = L.score_journeys(L.load_model(path), t.touches)
        return scores.groupBy("actual_conversion", "predicted_conversion").agg(F.count(F.lit(1)).alias("journeys"))

    register("s6_saved_model_scores", "actual_conversion:i, predicted_conversion:i, journeys:i", saved_model)

    def model_tables(t):
        """Sizes of the job's tables, and how its scores differ from those of the features scored anew by the saved model."""
        paths = jobs.run_conversion_model(t.touches, fresh_path(t.spark, "model"), "logistic")
        scores = t.spark.read.parquet(paths["scores"]).withColumnRenamed("conversion_probability", "p")
        features = t.spark.read.parquet(paths["features"])
        again = L.score_features(L.load_model(paths["model"]), features).select("customer_id", "conversion_probability")
        differ = (F.abs(F.col("p") - F.col("conversion_probability")) > 1e-12).cast("long")
        both = scores.join(again, "customer_id").agg(F.count(F.lit(1)).alias("journeys"), F.sum(differ).alias("different"))
        test = L.split(features, 0.2, 42)[1].select("customer_id")
        held = scores.join(test, "customer_id", "left_semi")
        gap = (F.col("auc") - F.col("ranks")).alias("auc_gap")
        quality = t.spark.read.parquet(paths["quality"])
        bins = t.spark.read.parquet(paths["score_bins"]).agg(F.sum("rows").alias("binned"), F.max(F.abs("isotonic_rate")).alias("top"))
        row = side_by_side(both, quality, L.rank_auc(held, "actual_conversion", "p").withColumnRenamed("auc", "ranks"), bins)
        return row.select("journeys", "different", "test_rows", "binned", gap, (F.col("top") <= 1).alias("rates_in_range"))

    register(
        "s6_model_tables",
        "journeys:i, different:i, test_rows:i, binned:i, auc_gap:8, rates_in_range:i",
        model_tables,
        with_touches(
            """
            , f AS (SELECT customer_id, CAST('0x' || substr(md5('42|' || customer_id), 1, 8) AS BIGINT) % 10000 AS bucket FROM tp GROUP BY customer_id)
            SELECT count(*) AS journeys, 0 AS different, count(*) FILTER (bucket < 2000) AS test_rows,
                   count(*) FILTER (bucket < 2000) AS binned, 0.0 AS auc_gap, true AS rates_in_range FROM f"""
        ),
    )

    def mix_tables(t):
        """Written contributions against the written grid and coefficients."""
        paths = jobs.run_media_mix(t.unnumbered, fresh_path(t.spark, "mix"))
        read = lambda name: t.spark.read.parquet(paths[name])
        inputs = read("grid").groupBy("channel").agg(F.sum("saturated").alias("x"))
        weights = read("ridge_path").filter("chosen").select("channel", "coefficient")
        gap = F.col("contribution") - F.col("x") * F.col("coefficient")
        share = F.sum("contribution_pct").over(Window.partitionBy(F.lit(0)))
        return read("contributions").join(inputs, "channel").join(weights, "channel").select("channel", "spend", gap.alias("gap"), share.alias("all_pct"))

    register(
        "s3_media_mix_contributions",
        "channel, spend:4, gap:6, all_pct:4",
        mix_tables,
        with_touches("SELECT channel, sum(cost) AS spend, 0.0 AS gap, 100.0 AS all_pct FROM tp GROUP BY channel"),
    )
    register(
        "s3_validation_intervals",
        "channel, mean:6, ci_lower:6, ci_upper:6",
        lambda t: t.spark.read.parquet(jobs.run_validation(t.attributed, fresh_path(t.spark, "validation"))["revenue_intervals"]),
        with_touches(_INTERVALS),
    )
    register(
        "s7_attribution_run",
        "channel, method, attributed_revenue:4, channel_cost:4",
        _attribution_run,
        with_credit(
            " UNION ALL ".join(
                f"SELECT channel, '{name}' AS method, sum({m}) AS attributed_revenue, sum(cost) AS channel_cost "
                "FROM att GROUP BY channel"
                for m, name in C.METHODS.items()
            )
        ),
    )


def _attribution_run(t):
    source = fresh_path(t.spark, "touchpoints")
    write_parquet(t.touches, source)
    paths = jobs.run_attribution(t.spark, source, fresh_path(t.spark, "attribution"))
    schema = "channel string, method string, attributed_revenue double, channel_cost double, roi double"
    return t.spark.read.schema(schema).option("header", True).csv(paths["comparison"])
