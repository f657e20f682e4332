"""SQL of linear and logistic fits: normal equations swept row by row, Newton steps written out one after the other."""

from __future__ import annotations


def swept(source: str, keep: str, size: int, pivots: int) -> str:
    """Rows of ``source`` (columns ``keep`` and the flattened matrix m) with the first ``pivots`` rows of m swept."""
    sql = source
    for k in range(pivots):
        row, column, pivot = f"m[{k * size + 1} + c % {size}]", f"m[(c // {size}) * {size} + {k + 1}]", f"m[{k * size + k + 1}]"
        sql = f"""SELECT {keep}, list_transform(range({size * size}), lambda c:
                    CASE WHEN c = {k * size + k} THEN 1 / {pivot} WHEN c // {size} = {k} THEN {row} / {pivot}
                         WHEN c % {size} = {k} THEN -{column} / {pivot} ELSE m[c + 1] - {column} * {row} / {pivot} END) AS m
                  FROM ({sql})"""
    return sql


def normal_two_sided(z: str) -> str:
    """P(|Z| > |z|) by Simpson's rule over the ten units beyond z."""
    node = f"abs({z}) + i / 100.0"
    return f"""(SELECT sum(CASE WHEN i IN (0, 1000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                          * exp(-pow({node}, 2) / 2)) * 2 / 300 / sqrt(2 * pi()) FROM range(1001) nodes(i))"""


def logistic(name: str, source: str, inputs: list[str], weight: str = "1", rounds: int = 12) -> str:
    """CTEs that end in ``name`` (beta, m): the fit of converted on ``inputs`` over ``source`` and its covariance.

    m is the swept matrix of size inputs + 2 whose upper left part is the inverse information matrix at beta.
    """
    terms = ["1", *inputs]
    q = len(terms)
    start = "[" + ", ".join(["0.0"] * q) + "]"
    parts = [f"{name}0 AS MATERIALIZED (SELECT {start} AS beta)"]
    for t in range(rounds):
        linear = " + ".join(f"beta[{i + 1}] * {x}" for i, x in enumerate(terms))
        cells = []
        for i in range(q + 1):
            for j in range(q + 1):
                if i < q and j < q:
                    cells.append(f"sum(w * p * (1 - p) * {terms[min(i, j)]} * {terms[max(i, j)]})")
                elif i == j:
                    cells.append("0.0")
                else:
                    cells.append(f"sum(w * (converted - p) * {terms[min(i, j)]})")
        moments = f"""SELECT any_value(beta) AS beta, [{", ".join(cells)}] AS m
                      FROM (SELECT *, {weight} AS w, 1 / (1 + exp(-({linear}))) AS p FROM {source}, {name}{t})"""
        step = swept(moments, "beta", q + 1, q)
        parts.append(
            f"""{name}{t + 1} AS MATERIALIZED (
            SELECT list_transform(range({q}), lambda i: beta[i + 1] + m[i * {q + 1} + {q + 1}]) AS beta, m FROM ({step}))"""
        )
    parts.append(f"{name} AS MATERIALIZED (SELECT * FROM {name}{rounds})")
    return ",\n".join(parts)


def coefficients(name: str, inputs: list[str]) -> str:
    """term, estimate, std_error, statistic and p_value of a ``logistic`` fit."""
    q = len(inputs) + 1
    terms = ", ".join(f"'{x}'" for x in ["(Intercept)", *inputs])
    return f"""SELECT term, estimate, std_error, estimate / std_error AS statistic, {normal_two_sided("(estimate / std_error)")} AS p_value
               FROM (SELECT unnest([{terms}]) AS term, unnest(beta) AS estimate,
                            unnest(list_transform(range({q}), lambda i: sqrt(m[i * {q + 1} + i + 1]))) AS std_error FROM {name})"""


def ridge_path(daily: str, channels: list[str], penalties: list[float], folds: int = 5) -> str:
    """CTEs that end in ``ridge`` (penalty, cv_error, chosen, channel, coefficient) of y on x0, x1, ... in ``daily`` (fold)."""
    n = len(channels)
    terms = ["1.0", *[f"x{i}" for i in range(n)], "y"]
    size = n + 2
    sums = ", ".join(f"sum({terms[min(i, j)]} * {terms[max(i, j)]})" for i in range(size) for j in range(size))
    at = lambda i, j: f"s[{i * size + j + 1}]"
    devs = ", ".join(f"sqrt(greatest({at(i, i)} / s[1] - pow({at(0, i)} / s[1], 2), 0))" for i in range(size))
    values = ", ".join(f"({p})" for p in penalties)
    names = ", ".join(f"'{c}'" for c in channels)
    i, j = f"(c // {n + 1})", f"(c % {n + 1})"
    # cells of the standardised equations; a constant predictor gets an equation of its own
    cell = f"""CASE WHEN {i} = {n} AND {j} = {n} THEN 0.0
                    WHEN ({i} < {n} AND dev[{i} + 2] <= 1e-12) OR ({j} < {n} AND dev[{j} + 2] <= 1e-12)
                    THEN CASE WHEN {i} = {j} THEN 1.0 ELSE 0.0 END
                    ELSE (s[({i} + 1) * {size} + {j} + 2] / s[1] - s[{i} + 2] / s[1] * s[{j} + 2] / s[1]) / dev[{i} + 2] / dev[{j} + 2]
                         + CASE WHEN {i} = {j} THEN penalty / dev[{size}] ELSE 0.0 END END"""
    matrix = f"SELECT part, penalty, s, dev, list_transform(range({(n + 1) ** 2}), lambda c: {cell}) AS m FROM sums"
    solved = swept(matrix, "part, penalty, s, dev", n + 1, n)
    weight = f"m[i * {n + 1} + {n + 1}] * dev[{size}] / dev[i + 2]"
    error = f"""list_sum(list_transform(range({size * size}), lambda c: v[c // {size} + 1] * v[c % {size} + 1] * held[c + 1]))"""
    return f"""
        fold_sums AS MATERIALIZED (SELECT fold, [{sums}] AS s FROM {daily} GROUP BY fold),
        every AS MATERIALIZED (SELECT [{sums}] AS s FROM {daily}),
        sums AS MATERIALIZED (
          SELECT part, penalty, s, [{devs}] AS dev
          FROM (SELECT -1 AS part, s FROM every
                UNION ALL SELECT fold, list_transform(range({size * size}), lambda c: every.s[c + 1] - fold_sums.s[c + 1]) FROM fold_sums, every),
               (VALUES {values}) v(penalty)
        ),
        solved AS MATERIALIZED (
          SELECT part, penalty, s,
                 list_transform(range({n}), lambda i: CASE WHEN dev[i + 2] <= 1e-12 THEN 0.0 ELSE {weight} END) AS b
          FROM ({solved})
        ),
        errors AS (
          SELECT penalty, avg(sqrt(greatest({error}, 0) / held[1])) AS cv_error
          FROM (SELECT solved.penalty, fold_sums.s AS held,
                       list_concat(list_concat([-(solved.s[{size}] / solved.s[1]
                                    - list_sum(list_transform(range({n}), lambda i: b[i + 1] * solved.s[i + 2] / solved.s[1])))],
                                   list_transform(b, lambda w: -w)), [1.0]) AS v
                FROM solved JOIN fold_sums ON part = fold)
          GROUP BY penalty
        ),
        ridge AS (
          SELECT penalty, cv_error, cv_error = min(cv_error) OVER () AS chosen, unnest([{names}]) AS channel, unnest(b) AS coefficient
          FROM solved JOIN errors USING (penalty) WHERE part = -1
        )"""
