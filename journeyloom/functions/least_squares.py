"""Least squares by group as column arithmetic: sums of products in one pass, normal equations by sweeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def product_sums(rows: DataFrame, group: str, terms: list[str]) -> DataFrame:
    """(group, n, products): the symmetric matrix of sums of products of ``terms``, row by row, over rows without NULL."""
    whole = rows.na.drop(subset=terms)
    size = len(terms)
    upper = {(i, j): F.sum(F.col(terms[i]) * F.col(terms[j])).alias(f"p{i}_{j}") for i in range(size) for j in range(i, size)}
    sums = whole.groupBy(group).agg(F.count(F.lit(1)).alias("n"), *upper.values())
    matrix = F.array(*[F.col(f"p{min(i, j)}_{max(i, j)}") for i in range(size) for j in range(size)])
    return sums.select(group, "n", matrix.alias("products"))


def swept(matrix: Column, size: int, pivots: int) -> Column:
    """The flattened symmetric ``size`` x ``size`` matrix after sweeping its first ``pivots`` rows.

    With products of (x, y) and all of x swept, it holds the inverse of X'X, the coefficients in
    the last column and the residual sum of squares in the last cell. NULL if a pivot is 0.
    """
    cells = F.sequence(F.lit(0), F.lit(size * size - 1))

    def sweep(m: Column, k: Column) -> Column:
        pivot = m[k * size + k]

        def cell(at: Column) -> Column:
            i, j = F.floor(at / size).cast("int"), (at % size).cast("int")
            row, column = m[k * size + j], m[i * size + k]
            changed = m[i * size + j] - F.try_divide(column * row, pivot)
            return (
                F.when((i == k) & (j == k), F.try_divide(F.lit(1.0), pivot))
                .when(i == k, F.try_divide(row, pivot))
                .when(j == k, -F.try_divide(column, pivot))
                .otherwise(changed)
            )

        return F.transform(cells, cell)

    return F.aggregate(F.sequence(F.lit(0), F.lit(pivots - 1)), matrix, sweep)
