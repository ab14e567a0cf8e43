"""Tail probabilities against known values and, at very many degrees of freedom, their limits."""

import math

import pytest

from tarmac.functions.special import beta_inc, chi2_upper, f_upper, normal_upper, t_two_sided


@pytest.mark.parametrize("df", [1e4, 1e6, 1e8, 1e10, 1e12, 1e14])
@pytest.mark.parametrize("t", [0.1, 0.7, 1.0, 1.5, 2.0, 3.0, 6.0])
def test_t_tends_to_normal(t, df):
    density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
    want = 2 * normal_upper(t) + density * (t**3 + t) / (2 * df)
    assert t_two_sided(t, df) == pytest.approx(want, abs=1e-9 + 1 / df**2)


@pytest.mark.parametrize("df2", [1e6, 1e8, 1e10, 1e12, 1e14])
@pytest.mark.parametrize("df1", [1.0, 2.0, 4.0, 7.0, 30.0])
@pytest.mark.parametrize("f", [0.2, 1.0, 2.5])
def test_f_tends_to_chi_square(f, df1, df2):
    x = f * df1
    density = math.exp((df1 / 2 - 1) * math.log(x) - x / 2 - df1 / 2 * math.log(2) - math.lgamma(df1 / 2))
    want = chi2_upper(x, df1) + density * x * (x - df1 + 2) / (2 * df2)
    assert f_upper(f, df1, df2) == pytest.approx(want, abs=1e-9)


def test_closed_forms():
    for f in (0.1, 1.0, 7.5):
        for df2 in (1.0, 3.0, 50.0, 1e7):
            assert f_upper(f, 2.0, df2) == pytest.approx((1 + 2 * f / df2) ** (-df2 / 2), rel=1e-9)
    for t in (0.2, 1.0, 8.0):
        assert t_two_sided(t, 1.0) == pytest.approx(1 - 2 / math.pi * math.atan(t), rel=1e-10)
        assert t_two_sided(t, 2.0) == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-9)
    for x in (0.0, 0.3, 1.0):
        assert beta_inc(1.0, 1.0, x) == pytest.approx(x)
    assert beta_inc(3.0, 2.0, 0.4) == pytest.approx(sum(math.comb(4, k) * 0.4**k * 0.6 ** (4 - k) for k in (3, 4)))


def test_small_tail_keeps_its_digits():
    assert t_two_sided(20.0, 1e12) == pytest.approx(2 * normal_upper(20.0), rel=1e-6)
