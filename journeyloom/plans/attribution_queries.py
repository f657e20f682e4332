"""Rules (T), Shapley (H), Markov (M), comparison (C) and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from journeyloom.operators import compare as C, markov as M, rules as R, shapley as H
from journeyloom.plans.reference_sql import (
    with_credit,
    with_ga_credit,
    with_ga_touches,
    with_models,
    with_sessions,
    with_touches,
    without_email,
)
from journeyloom.schema import CHANNELS

_KEY = "customer_id:i, touchpoint_number:i"
_METHODS = list(C.METHODS)
_STATES = [*CHANNELS, "conversion", "null"]

def _labelled(t):
    """Touches of 60 channels, more than any list of their subsets could hold."""
    return t.touches.withColumn("channel", F.concat_ws("|", "channel", "device", (F.col("pages_viewed") % 2).cast("string")))


def _no_email(t):
    """Touches with gaps in their positions, first and last ones among them."""
    return t.touches.filter(F.col("channel") != "email")


_STEPS = """
    , st AS (
      SELECT customer_id, touchpoint_number + 1 AS step, channel AS state FROM tp
      UNION ALL SELECT DISTINCT customer_id, 1, 'start' FROM tp
      UNION ALL SELECT customer_id, count(*) + 2, CASE WHEN max(converted) = 1 THEN 'conversion' ELSE 'null' END
                FROM tp GROUP BY customer_id
    ),
    moves AS (
      SELECT state AS s0, lead(state) OVER w AS s1, lead(state, 2) OVER w AS s2
      FROM st WINDOW w AS (PARTITION BY customer_id ORDER BY step)
    ),
    edges AS (
      SELECT s0 AS from_state, s1 AS to_state, count(*) AS "count",
             count(*) / sum(count(*)) OVER (PARTITION BY s0) AS probability
      FROM moves WHERE s1 IS NOT NULL GROUP BY s0, s1
    )"""


def register_all(register) -> None:
    for number, rule in enumerate(R.RULES, 1):
        register(
            f"t{number}_{rule}",
            f"{_KEY}, {rule}_attribution:6",
            lambda t, rule=rule: R.attribute_rules(t.touches, [rule]),
            with_credit(f"SELECT customer_id, touchpoint_number, {rule}_attribution FROM att"),
        )
    register(
        "t_all_rules",
        f"{_KEY}, " + ", ".join(f"{r}_attribution:6" for r in R.RULES),
        lambda t: R.attribute_rules(t.touches),
        with_credit("SELECT * FROM att"),
    )
    register(
        "t_all_rules_filtered",
        f"{_KEY}, " + ", ".join(f"{r}_attribution:6" for r in R.RULES),
        lambda t: R.attribute_rules(_no_email(t)),
        without_email(with_credit("SELECT * FROM att")),
    )
    register(
        "t_rules_ga_visitors",
        "customer_id, touchpoint_number:i, linear_attribution:6, time_decay_attribution:6",
        lambda t: R.attribute_rules(t.ga_touches, ["linear", "time_decay"]),
        _ga_rules(),
    )

    register(
        "h1_coalition_rates",
        "mask:i, coalition:a, total:i, conversions:i, rate:6",
        lambda t: H.coalition_rates(t.touches),
        _alphabetical(
            """
            SELECT mask, (SELECT coalesce(list(c ORDER BY c), []) FROM names
                          WHERE (mask & CAST(1 << ix AS INTEGER)) <> 0) AS coalition,
                   total, conversions, rate
            FROM coal2"""
        ),
    )
    register(
        "h2_shapley_exact_many_channels",
        "channel, raw_value:8",
        lambda t: H.shapley_exact(_labelled(t)),
        with_touches(
            """
            , labelled AS (
              SELECT customer_id, converted, channel || '|' || device || '|' || (pages_viewed % 2) AS label FROM tp
            ),
            per AS (
              SELECT customer_id, max(converted) AS converted, list(DISTINCT label) AS members
              FROM labelled GROUP BY customer_id
            ),
            subs AS (
              SELECT customer_id, converted,
                     list_sort(list_filter(members, lambda x, i: (s & CAST(1 << (i - 1) AS BIGINT)) <> 0)) AS coalition
              FROM per, range(1, CAST(1 << len(members) AS BIGINT)) r(s)
            ),
            worth AS (
              SELECT coalition, len(coalition) AS k, avg(converted) AS v FROM subs GROUP BY coalition
            ),
            names AS (SELECT label, (SELECT count(DISTINCT label) FROM labelled) AS n FROM labelled GROUP BY label),
            pairs AS (SELECT label, n, k, v, list_contains(coalition, label) AS held FROM names, worth)
            SELECT label AS channel,
                   sum(CASE WHEN held THEN exp(lgamma(k) + lgamma(n - k + 1) - lgamma(n + 1)) * v
                            WHEN k < n THEN -exp(lgamma(k + 1) + lgamma(n - k) - lgamma(n + 1)) * v
                            ELSE 0 END) AS raw_value
            FROM pairs GROUP BY label"""
        ),
    )
    register(
        "h2_shapley_exact",
        "channel, raw_value:8",
        lambda t: H.shapley_exact(t.touches),
        with_models("SELECT channel, raw_value FROM raw_shap"),
    )
    register(
        "h2_shapley_sampled",
        "channel, raw_value:8",
        lambda t: H.shapley_sampled(t.touches, 1000, 42),
        _alphabetical(
            """
            , draws AS (
              SELECT s AS sample, i, row_number() OVER (PARTITION BY s ORDER BY
                     CAST('0x' || substr(md5('42|' || s || '|' || i), 1, 8) AS BIGINT), i) AS j
              FROM range(1000) a(s), range(10) b(i)
            ),
            prefixes AS (
              SELECT sample, i, j,
                     sum(CAST(1 << i AS BIGINT)) OVER (PARTITION BY sample ORDER BY j) AS after_mask
              FROM draws
            )
            SELECT c AS channel,
                   avg(coalesce(a.rate, 0) - CASE WHEN j = 1 THEN 0 ELSE coalesce(z.rate, 0) END) AS raw_value
            FROM prefixes
            LEFT JOIN coal2 a ON a.mask = CAST(after_mask AS INTEGER)
            LEFT JOIN coal2 z ON z.mask = CAST(after_mask - CAST(1 << i AS BIGINT) AS INTEGER)
            JOIN names ON ix = i
            GROUP BY c"""
        ),
    )
    register(
        "h2_shapley_stratified",
        "channel, raw_value:8, std_error:8",
        lambda t: H.shapley_stratified(t.touches, 100, 42),
        _alphabetical(
            """
            , draws AS (
              SELECT s AS sample, i, row_number() OVER (PARTITION BY s ORDER BY
                     CAST('0x' || substr(md5('42|' || s || '|' || i), 1, 8) AS BIGINT), i) - 1 AS j
              FROM range(100) a(s), range(10) b(i)
            ),
            turned AS (SELECT sample, turn, i, (j - turn + 10) % 10 + 1 AS j FROM draws, range(10) r(turn)),
            prefixes AS (
              SELECT sample, turn, i, j,
                     sum(CAST(1 << i AS BIGINT)) OVER (PARTITION BY sample, turn ORDER BY j) AS after_mask
              FROM turned
            ),
            estimates AS (
              SELECT c AS channel, sample,
                     avg(coalesce(a.rate, 0) - CASE WHEN j = 1 THEN 0 ELSE coalesce(z.rate, 0) END) AS e
              FROM prefixes
              LEFT JOIN coal2 a ON a.mask = CAST(after_mask AS INTEGER)
              LEFT JOIN coal2 z ON z.mask = CAST(after_mask - CAST(1 << i AS BIGINT) AS INTEGER)
              JOIN names ON ix = i
              GROUP BY c, sample
            )
            SELECT channel, avg(e) AS raw_value, stddev_samp(e) / sqrt(count(*)) AS std_error FROM estimates GROUP BY channel"""
        ),
    )
    register(
        "h3_shapley_normalised",
        "channel, shapley_value:8",
        lambda t: H.shapley_values(t.touches),
        with_models("SELECT channel, shapley_value FROM shap"),
    )
    register(
        "h4_shapley_attribution",
        f"{_KEY}, shapley_attribution:6",
        lambda t: H.attribute_shapley(t.touches),
        with_credit("SELECT * FROM att"),
    )
    performance = """
        SELECT channel, sum({credit}) AS attributed_revenue, sum(cost) AS cost,
               count(DISTINCT customer_id) AS unique_customers,
               sum(CASE WHEN touchpoint_number = total_touchpoints THEN converted ELSE 0 END)
                 AS last_touch_conversions,
               CASE WHEN sum(cost) = 0 AND sum({credit}) <> 0 THEN 0
                    ELSE (sum({credit}) - sum(cost)) / nullif(sum(cost), 0) END AS roi,
               {more}
        FROM att JOIN {model} USING (channel) GROUP BY channel"""
    register(
        "h5_shapley_performance",
        "channel, attributed_revenue:4, cost:4, unique_customers:i, last_touch_conversions:i, shapley_value:6, "
        "roi:6",
        lambda t: H.shapley_performance(t.touches),
        with_credit(
            performance.format(
                credit="shapley_attribution", model="shap", more="any_value(shapley_value) AS shapley_value"
            )
        ),
    )
    register(
        "h6_shapley_comparison",
        "channel, last_touch:4, first_touch:4, shapley:4",
        lambda t: H.shapley_comparison(H.attribute_shapley(t.touches)),
        with_credit(
            """
            SELECT channel, sum(CASE WHEN converted = 1 THEN revenue ELSE 0 END) AS last_touch,
                   sum(CASE WHEN touchpoint_number = 1 THEN revenue ELSE 0 END) AS first_touch,
                   sum(shapley_attribution) AS shapley
            FROM att GROUP BY channel"""
        ),
    )

    register(
        "m1_transitions",
        "from_state, to_state, count:i, probability:6",
        lambda t: M.transitions(t.touches),
        with_touches(f"{_STEPS} SELECT * FROM edges"),
    )
    register(
        "m1_transitions_filtered",
        "from_state, to_state, count:i, probability:6",
        lambda t: M.transitions(_no_email(t)),
        without_email(with_touches(f"{_STEPS} SELECT * FROM edges")),
    )
    register(
        "m2_transitions_order2",
        "from_state:a, to_state, count:i, probability:6",
        lambda t: M.transitions(t.touches, order=2),
        with_touches(
            f"""{_STEPS}
            SELECT [s0, s1] AS from_state, s2 AS to_state, count(*) AS "count",
                   count(*) / sum(count(*)) OVER (PARTITION BY s0, s1) AS probability
            FROM moves WHERE s2 IS NOT NULL GROUP BY s0, s1, s2"""
        ),
    )
    cells = ", ".join(
        f"""coalesce(sum(probability) FILTER (to_state = '{s}'), 0) AS "{s}" """ for s in _STATES if s != "null"
    )
    register(
        "m3_transition_matrix",
        "from_state, " + ", ".join(f"{s}:6" for s in _STATES if s != "null") + ", no_conversion:6",
        lambda t: M.transition_matrix(M.transitions(t.touches), _STATES).withColumnRenamed("null", "no_conversion"),
        with_touches(
            f"""{_STEPS}
            SELECT from_state, {cells},
                   coalesce(sum(probability) FILTER (to_state = 'null'), 0) AS no_conversion
            FROM edges GROUP BY from_state"""
        ),
    )
    register(
        "m4_removal_effects",
        "channel, removal_effect:6",
        lambda t: M.removal_effects(t.touches),
        with_models("SELECT channel, removal_effect FROM mark"),
    )
    register(
        "m5_attribution_shares",
        "channel, attribution_share:6",
        lambda t: M.removal_effects(t.touches),
        with_models("SELECT channel, attribution_share FROM mark"),
    )
    register(
        "m6_markov_attribution",
        f"{_KEY}, markov_attribution:6",
        lambda t: M.attribute_markov(t.touches),
        with_credit("SELECT * FROM att"),
    )
    register(
        "m7_markov_performance",
        "channel, attributed_revenue:4, cost:4, unique_customers:i, removal_effect:6, attribution_share:6, roi:6",
        lambda t: M.markov_performance(t.touches),
        with_credit(
            performance.format(
                credit="markov_attribution",
                model="mark",
                more="any_value(removal_effect) AS removal_effect, any_value(attribution_share) AS attribution_share",
            )
        ),
    )
    register(
        "m8_transitions_from_email",
        "to_state, probability:6",
        lambda t: M.transitions_from(M.transitions(t.touches), "email"),
        with_touches(f"{_STEPS} SELECT to_state, probability FROM edges WHERE from_state = 'email'"),
    )
    register(
        "m9_transition_edges",
        "from_state, to_state, probability:6",
        lambda t: M.top_edges(M.transitions(t.touches), None),
        with_touches(f"{_STEPS} SELECT from_state, to_state, probability FROM edges WHERE probability > 0"),
    )
    register(
        "m9_top_edges",
        "from_state, to_state, probability:6",
        lambda t: M.top_edges(M.transitions(t.touches), 20),
        with_touches(
            f"""{_STEPS} SELECT from_state, to_state, probability FROM edges
            ORDER BY probability DESC, from_state, to_state LIMIT 20"""
        ),
    )
    flow = """
        , hops AS (
          SELECT channel || '_' || (touchpoint_number - 1) AS source,
                 CASE WHEN touchpoint_number < total_touchpoints
                      THEN lead(channel) OVER w || '_' || touchpoint_number
                      WHEN max(converted) OVER (PARTITION BY customer_id) = 1 THEN 'Conversion'
                      ELSE 'No Conversion' END AS target
          FROM tp WINDOW w AS (PARTITION BY customer_id ORDER BY touchpoint_number)
        )
        SELECT source, target, count(*) AS "value" FROM hops GROUP BY source, target"""
    register(
        "m10_flow_edges",
        "source, target, value:i",
        lambda t: M.flow_edges(t.touches, None),
        with_touches(flow),
    )
    register(
        "m10_top_flow_edges",
        "source, target, value:i",
        lambda t: M.flow_edges(t.touches, 50),
        with_touches(flow + ' ORDER BY "value" DESC, source, target LIMIT 50'),
    )

    register(
        "c1_all_attributions",
        f"{_KEY}, channel, " + ", ".join(f"{m}:6" for m in _METHODS),
        lambda t: t.attributed,
        with_credit("SELECT * FROM att"),
    )
    register(
        "c1_filtered",
        f"{_KEY}, channel, " + ", ".join(f"{m}:6" for m in _METHODS),
        lambda t: C.attribute_all(_no_email(t)),
        without_email(with_credit("SELECT * FROM att")),
    )
    sums = ", ".join(f"sum({m}) AS {m}" for m in _METHODS)
    wide = f", wide AS (SELECT channel, {sums}, sum(cost) AS cost FROM att GROUP BY channel)"
    named = " UNION ALL ".join(
        f"SELECT channel, '{name}' AS method, {m} AS attributed_revenue, cost AS channel_cost FROM wide"
        for m, name in C.METHODS.items()
    )
    long_roi = """CASE WHEN channel_cost = 0 AND attributed_revenue <> 0 THEN 0
                  ELSE (attributed_revenue - channel_cost) / nullif(channel_cost, 0) END"""
    register(
        "c2_method_comparison",
        "channel, method, attributed_revenue:4, channel_cost:4, roi:6",
        lambda t: C.comparison(t.attributed),
        with_credit(f"{wide} SELECT *, {long_roi} AS roi FROM ({named})"),
    )
    register(
        "c2_ga_method_comparison",
        "channel, method, attributed_revenue:4, channel_cost:4, roi:6",
        lambda t: C.comparison(C.attribute_all(t.ga_touches)),
        with_ga_credit(f"{wide} SELECT *, {long_roi} AS roi FROM ({named})"),
    )
    register(
        "m1_ga_transitions",
        "from_state, to_state, count:i, probability:6",
        lambda t: M.transitions(t.ga_touches),
        with_ga_touches(f"{_STEPS} SELECT * FROM edges"),
    )
    items = ", ".join(_METHODS)
    variance = f"list_var_samp([{items}])"
    summary_columns = "channel, " + ", ".join(f"{m}:4" for m in _METHODS) + ", variance:2, std_dev:4, cv:6, average:4"
    register(
        "c3_attribution_summary",
        summary_columns,
        lambda t: C.attribution_summary(t.attributed),
        with_credit(
            f"""{wide}
            SELECT *, {variance} AS variance, list_stddev_samp([{items}]) AS std_dev,
                   list_stddev_samp([{items}]) / nullif(list_avg([{items}]), 0) AS cv,
                   list_avg([{items}]) AS average
            FROM wide"""
        ),
    )
    register(
        "c3_attribution_summary_compat",
        summary_columns,
        lambda t: C.attribution_summary(t.attributed, ref_compat=True),
        with_credit(
            f"""{wide}, step1 AS (SELECT *, {variance} AS variance FROM wide),
            step2 AS (SELECT *, list_stddev_samp([{items}, variance]) AS std_dev FROM step1)
            SELECT *, std_dev / nullif(list_avg([{items}, variance, std_dev]), 0) AS cv,
                   list_avg([{items}]) AS average
            FROM step2"""
        ),
    )
    advanced = f"""{wide}, adv AS (
        SELECT *, (shapley_attribution + markov_attribution) / 2 AS advanced_avg,
               (shapley_attribution + markov_attribution) / 2 - last_touch_attribution AS undervaluation
        FROM wide)"""
    value_columns = "channel, advanced_avg:4, undervaluation:4"
    register(
        "c4_undervalued_channels",
        value_columns,
        lambda t: C.undervalued_channels(t.attributed),
        with_credit(f"{advanced} SELECT * FROM adv ORDER BY undervaluation DESC, channel LIMIT 3"),
    )
    register(
        "c4_overvalued_channels",
        value_columns,
        lambda t: C.overvalued_channels(t.attributed),
        with_credit(f"{advanced} SELECT * FROM adv ORDER BY undervaluation, channel LIMIT 3"),
    )
    register(
        "c5_budget_reallocation",
        "channel, cost:4, optimal_allocation:4, reallocation:4",
        lambda t: C.budget_reallocation(t.attributed),
        with_credit(
            f"""{advanced}
            SELECT channel, cost, advanced_avg / sum(advanced_avg) OVER () * sum(cost) OVER () AS optimal_allocation,
                   optimal_allocation - cost AS reallocation
            FROM adv"""
        ),
    )
    register(
        "c6_high_roi_channels",
        "channel, advanced_avg:4, roi:6",
        lambda t: C.high_roi_channels(t.attributed),
        with_credit(
            f"""{advanced}
            SELECT channel, advanced_avg,
                   CASE WHEN cost = 0 AND advanced_avg <> 0 THEN 0
                        ELSE (advanced_avg - cost) / nullif(cost, 0) END AS roi
            FROM adv ORDER BY roi DESC NULLS LAST, channel LIMIT 3"""
        ),
    )
    chosen = ["shapley_attribution", "markov_attribution", "last_touch_attribution"]
    register(
        "c7_model_table",
        "channel, model, attribution:4",
        lambda t: C.model_table(t.attributed, chosen),
        with_credit(
            wide
            + " UNION ALL ".join(
                f" SELECT channel, '{C.METHODS[m]}' AS model, {m} AS attribution FROM wide" for m in chosen
            )
        ),
    )
    register(
        "c7_model_agreement",
        "channel, " + ", ".join(f"{m}:4" for m in chosen) + ", coefficient_of_variation:6",
        lambda t: C.model_agreement(t.attributed, chosen),
        with_credit(
            f"""{wide}
            SELECT *, list_stddev_samp([{', '.join(chosen)}]) / nullif(list_avg([{', '.join(chosen)}]), 0)
                      AS coefficient_of_variation
            FROM wide"""
        ),
    )
    register(
        "c8_roi_pivot",
        "channel, " + ", ".join(f"{m}:6" for m in _METHODS),
        lambda t: C.roi_pivot(t.attributed),
        with_credit(
            f"{wide} SELECT channel, "
            + ", ".join(f"coalesce(({m} - cost) / nullif(cost, 0), 0) AS {m}" for m in _METHODS)
            + " FROM wide"
        ),
    )
    register(
        "s7_attributions_present_or_computed",
        f"{_KEY}, shapley_attribution:6, markov_attribution:6, last_touch_attribution:6",
        lambda t: C.with_attributions(C.with_attributions(t.touches).withColumn("note", F.lit("kept"))),
        with_credit("SELECT * FROM att"),
    )


def _alphabetical(body: str) -> str:
    """Coalitions with bits in alphabetical channel order, as the library numbers them."""
    return with_touches(
        f"""
        , names AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS ix FROM (SELECT DISTINCT channel AS c FROM tp)),
        masks2 AS (
          SELECT customer_id, max(converted) AS converted, bit_or(CAST(1 << ix AS INTEGER)) AS mask
          FROM tp JOIN names ON c = channel GROUP BY customer_id
        ),
        coal2 AS (
          SELECT CAST(s AS INTEGER) AS mask, count(*) AS total, sum(converted) AS conversions,
                 sum(converted) / count(*) AS rate
          FROM masks2, range(1024) r(s) WHERE (masks2.mask & CAST(s AS INTEGER)) = s GROUP BY s
        )
        {body}"""
    )


def _ga_rules() -> str:
    return with_sessions(
        """
        , ctx AS (
          SELECT *, max(converted) OVER c AS jc, max(revenue) OVER c AS jv,
                 pow(0.7, total_touchpoints - touchpoint_number) AS w
          FROM gt WINDOW c AS (PARTITION BY customer_id)
        )
        SELECT customer_id, touchpoint_number,
               CASE WHEN jc = 1 THEN jv / total_touchpoints ELSE 0 END AS linear_attribution,
               CASE WHEN jc = 1 THEN jv * w / sum(w) OVER (PARTITION BY customer_id) ELSE 0 END
                 AS time_decay_attribution
        FROM ctx"""
    )
