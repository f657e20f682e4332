"""SQL of tail probabilities by plain integration over range(), independent of the column expressions."""

from __future__ import annotations


def beta_tail(source: str, x: str, a: str, b: str, keep: str) -> str:
    """Rows of ``source`` (columns ``keep``) with tail = I_x(a, b), by Simpson's rule over v = sqrt(-ln t)."""
    return f"""
        SELECT {keep}, exp(lgamma(a + b) - lgamma(a) - lgamma(b)) * (v1 - v0) / 6000 * sum(
                 CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                 * exp(-a * v * v) * pow(1 - exp(-v * v), b - 1) * 2 * v) AS tail
        FROM (SELECT *, v0 + (v1 - v0) * i / 2000 AS v
              FROM (SELECT *, sqrt(-ln(x)) AS v0, sqrt(-ln(x) + 60 / a) AS v1 FROM (SELECT {keep}, {x} AS x, {a} AS a, {b} AS b FROM {source})),
                   range(2001) r(i))
        GROUP BY {keep}, a, b, v0, v1"""


def range_tail(source: str, keep: str) -> str:
    """Rows of ``source`` (q, k groups, n degrees, columns ``keep``) with tail = P(Q > q): three nested integrals."""
    return f"""
        SELECT {keep}, sum(weight * (1 - below)) AS tail
        FROM (
          SELECT {keep}, j, any_value(weight) AS weight,
                 any_value(means) * sum(0.2 * exp(-z * z / 2) / sqrt(2 * pi()) * pow(inside, means - 1)) AS below
          FROM (
            SELECT {keep}, j, means, z, any_value(weight) AS weight,
                   w / 240 * sum(CASE WHEN u IN (0, 80) THEN 1 WHEN u % 2 = 1 THEN 4 ELSE 2 END
                                 * exp(-pow(z - w * u / 80, 2) / 2) / sqrt(2 * pi())) AS inside
            FROM (
              SELECT *, k AS means, -8.4 + 0.2 * zi AS z, q * exp(place) AS w,
                     step * exp(ln(2) + n / 2 * ln(n / 2) - lgamma(n / 2) + n * place - n / 2 * exp(2 * place)) AS weight
              FROM (
                SELECT *, least_place + j * step AS place FROM (
                  SELECT *, -(9 / sqrt(2 * n) + 36 / n) AS least_place, 1 / sqrt(2 * n) / 3 AS step FROM {source}
                ), range(400) s(j)
              ), range(85) zr(zi)
              WHERE place <= 9 / sqrt(2 * n) + step
            ), range(81) ur(u)
            GROUP BY {keep}, j, means, z, w
          ) GROUP BY {keep}, j
        ) GROUP BY {keep}"""


def range_critical(alpha: float) -> str:
    """CTEs that end in ``critical`` (value): the q exceeded with chance ``alpha``, from ``degrees`` (k, n).

    The place is bracketed on three ever finer grids (up to 12) and interpolated in the last.
    """
    parts, bracket = [], "SELECT 0.0 AS low, 0.5 AS h, k, n FROM degrees"
    for r in range(3):
        parts.append(
            f"""
        grid{r} AS (SELECT low + h * g AS q, h, k, n FROM ({bracket}), range(27) x(g) WHERE low + g > 0),
        tail{r} AS MATERIALIZED ({range_tail(f'grid{r}', 'q, h, k, n')}),
        bracket{r} AS (
          SELECT max(q) FILTER (tail > {alpha}) AS low, any_value(h) AS h, any_value(k) AS k, any_value(n) AS n FROM tail{r}
        )"""
        )
        bracket = f"SELECT low, h / 25 AS h, k, n FROM bracket{r}"
    parts.append(
        f"""
        critical AS (
          SELECT a.q + (b.q - a.q) * (a.tail - {alpha}) / (a.tail - b.tail) AS value
          FROM bracket2 JOIN tail2 a ON a.q = low JOIN tail2 b ON b.q > low AND b.q < low + 1.5 * a.h
        )"""
    )
    return ",".join(parts)
