"""Rule-based attribution.

Only converting journeys get credit; the value shared out is the largest revenue
in the journey. Position and length are on the touch, so each rule is an arithmetic
expression on the row once the journey value is known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from journeyloom.functions.journey_scope import CHUNK_TOUCHES, renumber, with_journey_totals

# Fixed values of the rules.
DECAY = 0.7
FIRST_SHARE, LAST_SHARE, MIDDLE_SHARE = 0.4, 0.4, 0.2

RULES = ["last_touch", "first_touch", "linear", "time_decay", "position_based"]


def rule_credit(rule: str) -> Column:
    """Credit of one touch under ``rule``; needs ``_converted`` and ``_value``."""
    p = F.col("touchpoint_number")
    n = F.col("total_touchpoints")
    value = F.when(F.col("_converted") == 1, F.col("_value")).otherwise(0.0)
    if rule == "last_touch":
        credit = F.when(p == n, value).otherwise(0.0)
    elif rule == "first_touch":
        credit = F.when(p == 1, value).otherwise(0.0)
    elif rule == "linear":
        credit = value / n
    elif rule == "time_decay":
        # the weights DECAY^0 .. DECAY^(n-1) form a geometric series
        all_weights = (1 - F.pow(F.lit(DECAY), n)) / (1 - DECAY)
        credit = value * F.pow(F.lit(DECAY), n - p) / all_weights
    elif rule == "position_based":
        credit = (
            F.when(n == 1, value)
            .when(n == 2, value * 0.5)
            .when(p == 1, value * FIRST_SHARE)
            .when(p == n, value * LAST_SHARE)
            .otherwise(value * MIDDLE_SHARE / (n - 2))
        )
    else:
        raise ValueError(f"unknown rule: {rule}")
    return credit.alias(f"{rule}_attribution")


def attribute_rules(touches: DataFrame, rules: list[str] | None = None, chunk: int = CHUNK_TOUCHES) -> DataFrame:
    """Add one ``*_attribution`` column per rule; touches are numbered as given, gaps closed."""
    totals = {"_converted": F.max("converted"), "_value": F.max("revenue")}
    valued = with_journey_totals(renumber(touches, chunk), totals, chunk)
    return valued.select(*touches.columns, *[rule_credit(r) for r in (rules or RULES)])
