"""Tail probabilities against published table values."""

import pytest

from journeyloom.functions import distributions as d


@pytest.mark.parametrize(
    "t, df, p",
    [(2.228, 10, 0.05), (12.706, 1, 0.05), (2.750, 30, 0.01), (1.96, 1e9, 0.05)],
)
def test_t(t, df, p):
    assert d.t_two_sided(t, df) == pytest.approx(p, abs=2e-4)


@pytest.mark.parametrize(
    "f, a, b, p", [(4.10, 2, 10, 0.05), (2.87, 4, 20, 0.05), (3.0, 2, 1e9, 0.0498), (4.79, 2, 1000, 0.0085)]
)
def test_f(f, a, b, p):
    assert d.f_tail(f, a, b) == pytest.approx(p, abs=3e-4)


@pytest.mark.parametrize("x, df, p", [(7.815, 3, 0.05), (3.841, 1, 0.05), (5.991, 2, 0.05), (9.488, 4, 0.05)])
def test_chi2(x, df, p):
    assert d.chi2_tail(x, df) == pytest.approx(p, abs=1e-4)


@pytest.mark.parametrize("q, k, df", [(3.877, 3, 10), (3.958, 4, 20), (3.314, 3, 1e6), (3.399, 3, 60), (3.927, 2, 4)])
def test_studentized_range(q, k, df):
    published = 0.05
    assert d.studentized_range_tail(q, k, df) == pytest.approx(published, abs=3e-4)
    assert d.studentized_range_critical(published, k, df) == pytest.approx(q, abs=5e-3)


def test_quantile():
    assert d.normal_quantile(0.975) == pytest.approx(1.959964, abs=1e-6)
