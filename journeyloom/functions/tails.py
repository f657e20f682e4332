"""Tail probabilities as column expressions: Student t, F and the studentised range.

Everything is arithmetic of Spark columns: the incomplete beta function by its continued fraction, the studentised range
by quadrature, both as folds over a sequence. A p-value is thus a column like any other, for tables of any size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

#: Degrees of freedom beyond which the limit is reached to seven digits.
MOST_DF = 1e7
_TINY = 1e-300


def _fold(values: Column, zero: Column, step, finish=None) -> Column:
    return F.aggregate(values, zero, step, finish) if finish else F.aggregate(values, zero, step)


def log_gamma(z: Column) -> Column:
    """Logarithm of the gamma function of a positive column: Stirling's series eight places on."""
    far = z + 8
    shift = F.log(z)
    for k in range(1, 8):
        shift = shift + F.log(z + k)
    inverse = 1 / (far * far)
    series = (1 / 12 - inverse * (1 / 360 - inverse * (1 / 1260 - inverse * (1 / 1680 - inverse / 1188)))) / far
    return (far - 0.5) * F.log(far) - far + 0.5 * math.log(2 * math.pi) + series - shift


def _fraction(x: Column, a: Column, b: Column) -> Column:
    """Continued fraction of the incomplete beta function (modified Lentz), for x below its mean.

    The number of terms follows the square root of the larger parameter.
    """
    terms = F.least(F.lit(50_000), F.lit(120) + F.ceil(5 * F.sqrt(F.greatest(a, b)))).cast("int")
    guarded = lambda v: F.when(F.abs(v) < _TINY, F.lit(_TINY)).otherwise(v)

    def term(m: Column) -> Column:
        half = F.floor(m / 2).cast("double")
        even = half * (b - half) * x / ((a + m - 1) * (a + m))
        odd = -(a + half) * (a + b + half) * x / ((a + m - 1) * (a + m))
        return F.when(m % 2 == 0, even).otherwise(odd)

    state = lambda value, c, d: F.struct(value.alias("value"), c.alias("c"), d.alias("d"))

    def step(s: Column, m: Column) -> Column:
        # F.transform over one element names the term, so it is computed once
        inner = F.transform(
            F.array(term(m)),
            lambda t: F.struct(guarded(1 + t / s["c"]).alias("c"), (1 / guarded(1 + t * s["d"])).alias("d")),
        )[0]
        return F.transform(F.array(inner), lambda n: state(s["value"] * n["c"] * n["d"], n["c"], n["d"]))[0]

    one = F.lit(1.0)
    return _fold(F.sequence(F.lit(1), terms), state(one, one, F.lit(0.0)), step, lambda s: s["value"])


def beta_share(x: Column, a: Column, b: Column) -> Column:
    """Regularised incomplete beta function of columns; NULL where an input is."""
    swap = x > (a + 1) / (a + b + 2)
    y, p, q = F.when(swap, 1 - x).otherwise(x), F.when(swap, b).otherwise(a), F.when(swap, a).otherwise(b)
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + p * F.log(y) + q * F.log1p(-y))
    share = front / (p * _fraction(y, p, q))
    inside = F.when(swap, 1 - share).otherwise(share)
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).when(x.isNotNull(), inside)


def t_two_sided(t: Column, df: Column) -> Column:
    """P(|T| > |t|); NULL without a statistic or degrees of freedom."""
    n = F.least(df.cast("double"), F.lit(MOST_DF))
    return F.when(df > 0, beta_share(n / (n + t * t), n / 2, F.lit(0.5)))


def f_tail(f: Column, df1: Column, df2: Column) -> Column:
    """P(F > f)."""
    m, n = df1.cast("double"), F.least(df2.cast("double"), F.lit(MOST_DF))
    return F.when((df1 > 0) & (df2 > 0), F.when(f <= 0, 1.0).when(f.isNotNull(), beta_share(n / (n + m * f), n / 2, m / 2)))


# Coefficients of a published rational approximation of the normal distribution function to 15 digits.
_NORMAL_TOP = (
    3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376
)
_NORMAL_BOTTOM = (
    8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948,
    440.413735824752,
)


def normal_below(z: Column) -> Column:
    """Distribution function of the standard normal."""
    size = F.abs(z)

    def polynomial(coefficients: tuple[float, ...]) -> Column:
        value = F.lit(coefficients[0])
        for c in coefficients[1:]:
            value = value * size + c
        return value

    far = size + 0.65
    for k in (4, 3, 2, 1):
        far = size + k / far
    bell = F.exp(-z * z / 2)
    tail = F.when(size < 7.07106781186547, bell * polynomial(_NORMAL_TOP) / polynomial(_NORMAL_BOTTOM)).otherwise(bell / far / math.sqrt(2 * math.pi))
    return F.when(z > 0, 1 - tail).otherwise(tail)


_Z_STEP, _Z_EDGE = 0.2, 8.4


def _range_below(w: Column, groups: Column) -> Column:
    """P(range of ``groups`` standard normals <= w), by the trapezoid rule over the largest of them."""
    count = int(round(2 * _Z_EDGE / _Z_STEP))
    density = lambda z: F.exp(-z * z / 2) * (_Z_STEP / math.sqrt(2 * math.pi))

    def step(total: Column, i: Column) -> Column:
        place = F.transform(F.array(i * _Z_STEP - _Z_EDGE), lambda z: density(z) * F.pow(F.greatest(normal_below(z) - normal_below(z - w), F.lit(0.0)), groups - 1))
        return total + place[0]

    return groups * _fold(F.sequence(F.lit(0), F.lit(count)), F.lit(0.0), step)


def studentized_range_tail(q: Column, groups: Column, df: Column) -> Column:
    """P(Q > q) of the studentised range of ``groups`` means with ``df`` error degrees.

    The deviation's distribution is integrated over its logarithm, where the trapezoid rule converges fast for all df.
    """
    n = F.least(df.cast("double"), F.lit(MOST_DF))
    width = 1 / F.sqrt(2 * n)
    low, step = -(9 * width + 36 / n), width / 3
    count = F.ceil((9 * width - low) / step).cast("int")
    scale = math.log(2) + n / 2 * F.log(n / 2) - log_gamma(n / 2)

    def add(total: Column, i: Column) -> Column:
        place = F.transform(
            F.array(low + i * step),
            lambda t: F.exp(scale + n * t - n / 2 * F.exp(2 * t)) * step * (1 - F.least(_range_below(q * F.exp(t), groups), F.lit(1.0))),
        )
        return total + place[0]

    tail = F.least(_fold(F.sequence(F.lit(0), count), F.lit(0.0), add), F.lit(1.0))
    return F.when((df > 0) & q.isNotNull(), F.when(q <= 0, 1.0).otherwise(tail))


def studentized_range_critical(alpha: float, groups: Column, df: Column, rounds: int = 34) -> Column:
    """The q that Q exceeds with chance ``alpha``, by halving the interval from 0 to 200."""
    state = lambda low, high: F.struct(low.alias("low"), high.alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.transform(F.array((s["low"] + s["high"]) / 2), lambda m: F.struct(m.alias("m"), (studentized_range_tail(m, groups, df) > alpha).alias("up")))[0]
        return F.transform(F.array(middle), lambda m: state(F.when(m["up"], m["m"]).otherwise(s["low"]), F.when(m["up"], s["high"]).otherwise(m["m"])))[0]

    return F.when(df > 0, _fold(F.sequence(F.lit(1), F.lit(rounds)), state(F.lit(0.0), F.lit(200.0)), halve, lambda s: (s["low"] + s["high"]) / 2))
