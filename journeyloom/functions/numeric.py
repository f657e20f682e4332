"""Small column builders shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when the denominator is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(ratio(num, den), F.lit(0.0))


def roi(revenue: Column, cost: Column) -> Column:
    """(revenue - cost) / cost; an infinite ratio becomes 0, 0/0 stays NULL."""
    gain = revenue - cost
    return F.when((cost == 0) & (gain != 0), F.lit(0.0)).otherwise(ratio(gain, cost))


def total(column: Column) -> Column:
    """Sum over all rows of an already aggregated, channel-sized table."""
    return F.sum(column).over(Window.partitionBy(F.lit(0)))


def hash_unit(*parts: Column) -> Column:
    """Repeatable draw in [0, 1) from the md5 of the parts joined by '|'.

    Unlike ``rand(seed)`` it does not depend on how rows are partitioned.
    """
    return hash_int(*parts) / F.lit(4294967296.0)


def hash_int(*parts: Column) -> Column:
    """First 32 bits of the md5 of the parts joined by '|', as a long."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def ranked_top(df: DataFrame, n: int | None, *order: Column) -> DataFrame:
    out = df.orderBy(*order)
    return out if n is None else out.limit(n)


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One row with the columns of several one-row tables."""
    stacked = rows[0]
    for row in rows[1:]:
        stacked = stacked.unionByName(row, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
