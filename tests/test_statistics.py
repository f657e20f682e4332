"""Tails, Poisson draws, autoregressions, ridge path, ranks: columns against plain Python and numpy."""

import hashlib
import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from journeyloom.functions import distributions as plain, poisson, tails
from journeyloom.functions.least_squares import product_sums, swept
from journeyloom.operators import conversion_models as models, experiments, mediamix, timeseries


def column(spark, rows, schema, value):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(value).collect()]


def test_log_gamma_and_normal(spark):
    xs = [0.5, 1.0, 1.5, 2.0, 7.3, 150.0, 1e5, 5e6]
    got = column(spark, [(x,) for x in xs], "x double", tails.log_gamma(F.col("x")))
    assert got == pytest.approx([math.lgamma(x) for x in xs], rel=1e-13, abs=1e-12)
    zs = [-9.0, -7.2, -3.0, -1.0, -1e-3, 0.0, 0.4, 2.5, 6.9, 7.5, 10.0]
    got = column(spark, [(z,) for z in zs], "z double", tails.normal_below(F.col("z")))
    assert got == pytest.approx([0.5 * math.erfc(-z / math.sqrt(2)) for z in zs], rel=1e-11, abs=1e-15)


def test_t_and_f_tails(spark):
    rows = [(t, float(df)) for t in (-3.1, -0.2, 0.0, 0.05, 1.0, 2.228, 12.0) for df in (1, 2, 10, 333, 20_000, 3_000_000)]
    got = column(spark, rows, "t double, df double", tails.t_two_sided(F.col("t"), F.col("df")))
    assert got == pytest.approx([plain.t_two_sided(t, df) for t, df in rows], rel=1e-7, abs=1e-12)
    rows = [(f, a, b) for f in (0.0, 0.3, 1.0, 4.1, 25.0) for a in (1, 2, 7) for b in (3, 40, 10_000, 2_000_000)]
    got = column(spark, rows, "f double, a bigint, b bigint", tails.f_tail(F.col("f"), F.col("a"), F.col("b")))
    assert got == pytest.approx([plain.f_tail(*r) for r in rows], rel=1e-6, abs=1e-12)
    none = column(spark, [(None, 3.0), (1.0, 0.0), (1.0, None)], "t double, df double", tails.t_two_sided(F.col("t"), F.col("df")))
    assert none == [None] * 3


def test_studentized_range(spark):
    rows = [(3.877, 3, 10.0), (3.958, 4, 20.0), (3.314, 3, 1e6), (3.399, 3, 60.0), (3.927, 2, 4.0), (1.1, 3, 9000.0)]
    value = tails.studentized_range_tail(F.col("q"), F.col("k"), F.col("df"))
    got = column(spark, rows, "q double, k int, df double", value)
    assert got == pytest.approx([plain.studentized_range_tail(*r) for r in rows], abs=2e-5)
    assert got[:4] == pytest.approx([0.05] * 4, abs=2e-4)
    critical = tails.studentized_range_critical(0.05, F.col("k"), F.col("df"))
    assert column(spark, [(3, 10.0), (4, 20.0)], "k int, df double", critical) == pytest.approx([3.877, 3.958], abs=2e-3)


@pytest.mark.parametrize("rate", [1, 2, 8, 256, 1 << 16])
def test_poisson_counts_invert_the_distribution(spark, rate):
    level = rate.bit_length() - 1
    rng = random.Random(level)
    draws = [rng.randrange(1 << 32) for _ in range(400)] + [0, (1 << 32) - 1]
    table = spark.createDataFrame([(level, b) for b in draws], "level int, bits bigint").withColumn("cell", poisson.cell_of(F.col("bits")))
    got = {r[0]: r[1] for r in table.join(poisson.poisson_cells(spark), ["level", "cell"]).select("bits", poisson.count_at(F.col("bits"))).collect()}
    below, j, want = 0.0, -1, {}
    for b in sorted(draws):
        while below * 2**32 <= b and j < rate + 12 * math.sqrt(rate) + 20:
            j += 1
            below += math.exp(j * math.log(rate) - rate - math.lgamma(j + 1))
        want[b] = j
    assert sum(got[b] != want[b] for b in draws[:400]) == 0
    assert abs(np.mean([got[b] for b in draws[:400]]) - rate) < 5 * math.sqrt(rate / 400)


def test_rate_parts_add_up(spark):
    ns = [1, 2, 3, 1000, 65_535, 65_536, 1_000_003]
    parts = spark.createDataFrame([(n,) for n in ns], "n bigint").select("n", F.inline(poisson.rate_parts(F.col("n"))))
    got = {r[0]: r[1] for r in parts.groupBy("n").agg(F.sum(F.pow(F.lit(2), F.col("level"))).cast("long")).collect()}
    assert got == {n: n for n in ns}


def test_bootstrap_of_touches_has_the_deviation_of_means(spark):
    rng = random.Random(4)
    values = [rng.choice([0.0, 0.0, 0.0, 5.0, rng.random() * 10]) for _ in range(3000)]
    rows = spark.createDataFrame([("a", v) for v in values] + [("b", 2.5)] * 50, "channel string, credit double")
    got = {r["channel"]: r for r in experiments.bootstrap_means(rows, "credit", 400).collect()}
    assert got["a"]["mean_attribution"] == pytest.approx(np.mean(values), abs=1e-6)
    assert got["a"]["std_error"] == pytest.approx(np.std(values) / math.sqrt(len(values)), rel=0.15)
    assert got["b"]["ci_lower"] == got["b"]["ci_upper"] == pytest.approx(2.5)


def test_bootstrap_draws_never_become_rows(spark):
    counts = [("a", 2.5, 3), ("a", 0.0, 70_000), ("b", 1.25, 9), (None, 4.0, 1), (None, 1.0, 2)]
    one = spark.createDataFrame(counts, "channel string, credit double, n int")
    rows = one.select("channel", "credit", F.explode(F.sequence(F.lit(1), F.col("n"))))
    means = experiments._touch_replicates(rows, "credit", 6, 42)
    got = {(r["channel"], r["draw"]): r["mean"] for r in means.collect()}
    want = {}
    for channel in ("a", "b", None):
        mine = [(v, n) for c, v, n in counts if c == channel]
        want[channel, 0] = sum(v * n for v, n in mine) / sum(n for _, n in mine)
        for draw in range(1, 7):
            total = weight = 0
            for v, n in mine:
                for level, piece in [(i, 0) for i in range(16) if n >> i & 1] + [(16, p + 1) for p in range(n >> 16)]:
                    key = [x for x in ("42", channel, str(int(v * 1e6)), str(level), str(piece), str((draw - 1) // 4)) if x is not None]
                    bits = int(hashlib.md5("|".join(key).encode()).hexdigest()[8 * ((draw - 1) % 4) :][:8], 16)
                    low, steps = poisson.thresholds(1 << level)
                    drawn = low + sum(int(t) <= bits for t in steps)
                    total, weight = total + drawn * v, weight + drawn
            want[channel, draw] = total / weight if weight else None
    assert got == pytest.approx(want)
    text = means._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in text.split("MapInArrow")[0] and "Join" not in text


def days(values, series="s"):
    return [(series, date(2024, 1, 1) + timedelta(i), float(v)) for i, v in enumerate(values)]


def test_planted_second_order_series(spark):
    rng = np.random.default_rng(2)
    noise, y = rng.normal(size=900), [0.0, 0.0]
    for e in noise:
        y.append(1.2 * y[-1] - 0.6 * y[-2] + e)
    wave = [10 + v for v in y[100:]]
    rows = spark.createDataFrame(days(wave) + days([3.0] * 20, "flat") + days([1.0, 2.0], "short"), "series string, day date, value double")
    fits = {r["series"]: r for r in timeseries.ar_fits(rows, "series", "day", "value").collect()}
    d, best = np.array(wave) - np.mean(wave), None
    c = [d[k:] @ d[: len(d) - k] / len(d) for k in range(6)]
    for k in range(6):
        around = np.array([[c[abs(i - j)] for j in range(k)] for i in range(k)]).reshape(k, k)
        phi = np.linalg.solve(around, np.array(c[1 : k + 1])) if k else np.zeros(0)
        aic = len(d) * math.log(c[0] - phi @ np.array(c[1 : k + 1])) + 2 * (k + 1)
        best = min(best or (math.inf, None), (aic, list(phi)))
    assert fits["s"]["phi"] == pytest.approx(best[1]) and fits["s"]["order"] == len(best[1]) >= 2
    assert fits["s"]["phi"][:2] == pytest.approx([1.2, -0.6], abs=0.1)
    assert (fits["flat"]["order"], fits["short"]["order"]) == (0, 0)
    got = {}
    for r in timeseries.ar_forecast(rows, "series", "day", "value", 4).collect():
        got.setdefault(r["series"], {})[r["step"]] = r["forecast"]
    m, past = np.mean(wave), list(wave[-5:])
    for step in range(1, 5):
        past.append(m + sum(f * (past[-1 - j] - m) for j, f in enumerate(fits["s"]["phi"])))
        assert got["s"][step] == pytest.approx(past[-1])
    assert got["flat"] == {h: pytest.approx(3.0) for h in range(1, 5)} and got["short"][1] == pytest.approx(1.5)


@pytest.mark.parametrize("lags", [0, 1, 3])
def test_unit_root_statistic_with_lags(spark, lags):
    rng = np.random.default_rng(lags)
    y = np.cumsum(rng.normal(size=120)) + 50
    rows = spark.createDataFrame(days(y), "series string, day date, value double")
    got = timeseries.augmented_dickey_fuller(rows, "series", "day", "value", lags).first()
    dy = np.diff(y)
    x = np.column_stack([y[lags:-1], np.ones(len(dy) - lags), *[dy[lags - k : len(dy) - k] for k in range(1, lags + 1)]])
    target = dy[lags:]
    beta, rss, *_ = np.linalg.lstsq(x, target, rcond=None)
    error = math.sqrt(rss[0] / (len(target) - x.shape[1]) * np.linalg.inv(x.T @ x)[0, 0])
    assert (got["rows"], got["gamma"], got["df_statistic"]) == (len(target), pytest.approx(beta[0]), pytest.approx(beta[0] / error))


def test_swept_products(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 3))
    rows = spark.createDataFrame([("g", *map(float, r)) for r in x] + [("g", None, 1.0, 2.0)], "g string, a double, b double, y double")
    got = np.array(product_sums(rows, "g", ["a", "b", "y"]).select("n", swept(F.col("products"), 3, 2).alias("s")).first()["s"]).reshape(3, 3)
    design, target = x[:, :2], x[:, 2]
    beta, rss, *_ = np.linalg.lstsq(design, target, rcond=None)
    assert got[:2, :2] == pytest.approx(np.linalg.inv(design.T @ design)) and got[:2, 2] == pytest.approx(beta) and got[2, 2] == pytest.approx(rss[0])


def test_one_decomposition_serves_all_penalties():
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.normal(size=(80, 3)) * [1, 10, 0.1], np.full(80, 4.0)])
    y = x @ [1.0, -0.2, 5.0, 0.0] + rng.normal(size=80)
    whole = np.column_stack([np.ones(80), x, y])
    fit = mediamix._Ridge(whole.T @ whole)
    z, centred = (x[:, :3] - x[:, :3].mean(0)) / x[:, :3].std(0), (y - y.mean()) / y.std()
    for penalty in (0.001, 1.0, 50.0):
        b = np.linalg.solve(z.T @ z / 80 + penalty / y.std() * np.eye(3), z.T @ centred / 80)
        weights, intercept = fit.fit(penalty)
        assert weights == pytest.approx([*(b * y.std() / x[:, :3].std(0)), 0.0])
        assert intercept == pytest.approx(y.mean() - weights @ x.mean(0))


def test_revenue_of_unnamed_channels_counts(spark):
    rows = [("2024-01-01", "email", 1.0, 10.0), ("2024-01-01", "other", 2.0, 5.0), ("2024-01-02", "other", 1.0, 7.0)]
    daily = spark.createDataFrame(rows, "date string, channel string, spend double, revenue double")
    got = {r["date"]: (r["spend_email"], r["total_revenue"]) for r in mediamix.daily_wide(daily, ["email"]).collect()}
    assert got == {"2024-01-01": (1.0, 15.0), "2024-01-02": (0.0, 7.0)}


@pytest.mark.parametrize("parts", [1, 7])
def test_area_by_ranks(spark, parts):
    rng = random.Random(7)
    rows = [(rng.randrange(2), rng.choice([0.1, 0.5, rng.random()])) for _ in range(400)]
    wins = [1.0 if p > q else 0.5 if p == q else 0.0 for y, p in rows if y for z, q in rows if not z]
    scored = spark.createDataFrame(rows, "label int, score double")
    assert models.rank_auc(scored, "label", "score", parts).first()[0] == pytest.approx(sum(wins) / len(wins))
    assert models.rank_auc(scored.filter("label = 1"), "label", "score", parts).first()[0] is None


def test_score_bins_rise(spark):
    rng = random.Random(8)
    rows = [(p, int(rng.random() < p)) for p in (rng.random() for _ in range(2000))] + [(1.0, 1)]
    table = models.score_bins(spark.createDataFrame(rows, "p double, label int"), "label", "p", 20).collect()
    rates = [r["isotonic_rate"] for r in table]
    assert rates == sorted(rates) and sum(r["rows"] for r in table) == 2001 and len(table) == 20
    assert max(abs(r["mean_score"] - r["isotonic_rate"]) for r in table) < 0.2
