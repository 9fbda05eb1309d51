"""Worked values for the expressions and the tail probabilities."""

import numpy as np
import pytest

from panelspark.config import Assumptions
from panelspark.functions.columns import (
    add_columns,
    aggregate,
    cagr_pct,
    col_or,
    format_billions,
    format_millions,
    grc_parts,
    nan_to_null,
    number,
    require_columns,
    requirement_parts,
    residential_bill,
    sum_amount,
)
from panelspark.functions import tails
from panelspark.functions.tails import f_upper, incomplete_beta, t_critical, t_two_sided
from panelspark.operators.panel import categorize


def evaluate(spark, text, **values):
    given = ", ".join(
        f"CAST({'NULL' if v is None else v} AS DOUBLE) AS {n}" for n, v in values.items()
    )
    source = spark.sql(f"SELECT {given or '1 AS one'}")
    return source.selectExpr(f"{text} AS out").first()["out"]


ACCOUNTS = {
    "500": "production",
    "557.9": "production",
    "558": "other",
    "560": "transmission",
    "574.5": "transmission",
    "575": "other",
    "598": "distribution",
    "901": "customer_service",
    "910": "customer_service",
    "911": "other",
    "935": "admin_general",
    "936": "other",
    "5e2": "production",
    "n/a": "other",
    "": "other",
    "500d": "other",
    "500f": "other",
    "inf": "other",
    "nan": "other",
    "0x1.0p9": "other",
    " 557.9 ": "production",
    "920.": "admin_general",
    "-500": "other",
    "903_904": "other",
    None: "other",
}


def test_account_categories(spark):
    df = spark.createDataFrame([(c,) for c in ACCOUNTS], "ferc_account string")
    assert {r[0]: r[1] for r in categorize(df).collect()} == ACCOUNTS


@pytest.mark.parametrize(
    "om, other, rate_base, expected",
    [
        (100, 10, 1000, 273.9726027),
        (100, 10, -5, 123.2876712),
        (100, None, 1000, 287.6712329),
        (100, 10, None, None),
        (None, 10, 1000, None),
    ],
)
def test_total_requirement(spark, om, other, rate_base, expected):
    text = requirement_parts("om", "other", "rb")["revenue_requirement"]
    got = evaluate(spark, text, om=om, other=other, rb=rate_base)
    assert got == (None if expected is None else pytest.approx(expected, abs=1e-7))


def test_requirement_parts_and_options(spark):
    parts = requirement_parts("om", "other", "rb")
    values = {"om": 100, "other": 10, "rb": 1000}
    expected = {
        "om_expense": 90,
        "om_passthrough": 10,
        "depreciation": 35,
        "return_on_rate_base": 75,
        "pre_tax_total": 200,
        "taxes": 73.9726027,
    }
    for name, value in expected.items():
        assert evaluate(spark, parts[name], **values) == pytest.approx(value, abs=1e-7)
    kept = requirement_parts("om", "other", "rb", exclude_passthrough=False)
    assert evaluate(spark, kept["om_expense"], **values) == 100
    with pytest.raises(ValueError):
        Assumptions(tax_rate=1.0)


def test_requirement_is_homogeneous_and_nets_to_pre_tax(spark):
    parts = requirement_parts("om", "other", "rb")
    one = evaluate(spark, parts["revenue_requirement"], om=123.4, other=5.6, rb=789.1)
    ten = evaluate(spark, parts["revenue_requirement"], om=1234, other=56, rb=7891)
    pre = evaluate(spark, parts["pre_tax_total"], om=123.4, other=5.6, rb=789.1)
    assert ten == pytest.approx(10 * one)
    assert one * 0.73 == pytest.approx(pre)


def test_grc_requirement(spark):
    parts = grc_parts("d", "c", "a", "rb")
    values = {"d": 20, "c": 5, "a": 10, "rb": 1000}
    for name, value in {
        "grc_om": 32, "pre_tax_total": 142, "taxes": 21.3, "grc_revenue_requirement": 163.3
    }.items():
        assert evaluate(spark, parts[name], **values) == pytest.approx(value)
    assert evaluate(spark, parts["grc_om"], d=20, c=5, a=10, rb=None) is None


@pytest.mark.parametrize("share, mwh, valid", [(0.4, 2, True), (1.2, 2, False), (-0.1, 2, False),
                                               (0.4, 0, False)])
def test_residential_bill(spark, share, mwh, valid):
    text = residential_bill("rr", "share", "mwh", 500.0)["monthly_bill"]
    got = evaluate(spark, text, rr=297.808219, share=share, mwh=mwh)
    assert got == (pytest.approx(29.7808219) if valid else None)


def test_cagr_guards(spark):
    text = cagr_pct("first", "last", "n")
    assert evaluate(spark, text, first=1, last=9, n=3) == pytest.approx(108.0083823)
    for first, last, n in [(0, 9, 3), (-1, 9, 3), (1, 9, 0), (1, -9, 2)]:
        assert evaluate(spark, text, first=first, last=last, n=n) is None


def test_formats(spark):
    assert evaluate(spark, format_billions("x"), x=13_910_000_000) == "$13.9B"
    assert evaluate(spark, format_millions("x"), x=1_234_000_000) == "$1234M"
    assert evaluate(spark, format_billions("x"), x=None) is None


def test_sum_amount_is_exact_in_any_order(spark):
    rng = np.random.default_rng(7)
    cents = rng.integers(-10**9, 10**9, 5000)
    rows = [(float(c) / 100,) for c in cents] + [(None,)]
    df = spark.createDataFrame(rows, "x double")
    for parts in (1, 7):
        total = aggregate(df.repartition(parts), [], {"t": sum_amount("x", 100)}).first()["t"]
        assert total == int(cents.sum()) / 100
    assert aggregate(df.where("x IS NULL"), [], {"t": sum_amount("x", 100)}).first()["t"] == 0.0
    plain = aggregate(df, [], {"t": sum_amount("x", None)}).first()["t"]
    assert plain == pytest.approx(total)


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 3.0)], "a int, b double")
    assert [r["b"] for r in nan_to_null(df).orderBy("a").collect()] == [None, 3.0]
    replaced = add_columns(df, {"a": "a + 1", "c": "a * 10"})
    assert replaced.columns == ["a", "b", "c"]
    assert [tuple(r)[::2] for r in replaced.orderBy("a").collect()] == [(2, 10), (3, 20)]
    assert col_or(df, "a", "0") == "a" and col_or(df, "z", "0") == "0"
    assert number(0.035) == "0.035D"
    with pytest.raises(ValueError, match="Missing required columns"):
        require_columns(df, ["a", "z"])


def test_t_tail_against_series():
    """Whole degrees of freedom have a finite trigonometric series."""
    for dof in range(1, 30):
        for t in [0.0, 0.3, 1.0, 2.5, 4.2257713]:
            theta = np.arctan(t / np.sqrt(dof))
            c, s = np.cos(theta), np.sin(theta)
            if dof % 2:
                term, total = c, 0.0
                for k in range((dof - 1) // 2):
                    total += term
                    term *= c * c * (2 * k + 2) / (2 * k + 3)
                inside = 2 / np.pi * (theta + s * total)
            else:
                term, total = 1.0, 0.0
                for k in range(dof // 2):
                    total += term
                    term *= c * c * (2 * k + 1) / (2 * k + 2)
                inside = s * total
            assert t_two_sided(t, dof) == pytest.approx(1 - inside, abs=1e-12)
    assert t_two_sided(4.2257713, 2) == pytest.approx(0.0516959, abs=1e-7)
    assert t_two_sided(1e3, 1e7) == pytest.approx(0.0, abs=1e-300)
    assert np.isnan(t_two_sided(1.0, 0.0))
    assert t_critical(10.0) == pytest.approx(2.228138852, abs=1e-8)
    assert t_critical(1.0) == pytest.approx(12.7062047, abs=1e-6)


def tail_series(t, dof):
    """1 - 2 t f(0) 2F1(1/2, (dof + 1) / 2; 3/2; -t^2 / dof) with 200 digits."""
    from decimal import Decimal, getcontext

    getcontext().prec = 200
    pi = Decimal("3.14159265358979323846264338327950288419716939937510582097494459230781640628620"
                 "8998628034825342117067982148086513282306647093844609550582231725359408128481117")
    t, dof = Decimal(t), Decimal(dof)

    def log_gamma(x):
        passed = Decimal(0)
        while x < 400:
            passed, x = passed + x.ln(), x + 1
        # Even-index Bernoulli numbers from their recurrence.
        rows, even = [Decimal(0)] * 61, []
        for m in range(61):
            rows[m] = Decimal(1) / (m + 1)
            for j in range(m, 0, -1):
                rows[j - 1] = j * (rows[j - 1] - rows[j])
            even.append(rows[0])
        out = (x - Decimal("0.5")) * x.ln() - x + (2 * pi).ln() / 2 - passed
        return out + sum(even[2 * k] / (2 * k * (2 * k - 1) * x ** (2 * k - 1)) for k in range(1, 21))

    density = (log_gamma((dof + 1) / 2) - log_gamma(dof / 2)).exp() / (dof * pi).sqrt()
    term = total = Decimal(1)
    n = 0
    while abs(term) > Decimal(10) ** -60 or n < 20:
        term *= (Decimal("0.5") + n) * ((dof + 1) / 2 + n) / (Decimal("1.5") + n) / (n + 1)
        term *= -t * t / dof
        total, n = total + term, n + 1
    return float(1 - 2 * t * density * total)


@pytest.mark.parametrize("dof", [1, 3, 29, 31, 100, 12345, 10**6, 10**9, 10**12])
def test_t_tail_keeps_its_digits_at_any_degrees_of_freedom(dof):
    for t in ["0.1", "0.9", "1.7", "1.8", "2", "4.5", "9"]:
        if float(t) ** 2 < 0.9 * dof:
            assert t_two_sided(float(t), float(dof)) == pytest.approx(tail_series(t, dof), rel=1e-12)


def test_f_tail_at_any_degrees_of_freedom():
    for df2 in [1.0, 10.0, 31.0, 1e4, 1e9, 1e12]:
        for f in [1e-3, 0.9, 1.1, 2.0, 30.0]:
            two = np.exp(-df2 / 2 * np.log1p(2 * f / df2))
            y = 4 * f / df2
            four = np.exp(-df2 / 2 * np.log1p(y)) * (1 + df2 / 2 * y / (1 + y))
            assert f_upper(f, 2.0, df2) == pytest.approx(two, rel=1e-12)
            assert f_upper(f, 4.0, df2) == pytest.approx(four, rel=1e-12)


def test_an_unconverged_fraction_is_no_value(monkeypatch):
    monkeypatch.setattr(tails, "STEPS", 2)
    assert np.isnan(incomplete_beta(9.0, 5.0, 0.5))


def test_f_tail():
    # F with (1, n) degrees is t squared.
    assert f_upper(4.0, 1.0, 12.0) == pytest.approx(t_two_sided(2.0, 12.0), abs=1e-13)
    assert f_upper(np.array([3.0]), np.array([2.0]), np.array([8.0]))[0] == pytest.approx(
        (1 + 2 * 3.0 / 8) ** -4.0, abs=1e-13
    )
    assert incomplete_beta(2.0, 3.0, 0.4) == pytest.approx(0.5248, abs=1e-12)
    assert incomplete_beta(2.0, 3.0, 0.0) == 0 and incomplete_beta(2.0, 3.0, 1.0) == 1
