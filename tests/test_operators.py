"""Operators against brute force and hand-worked values on small panels."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelspark.operators import bills, charts, models, ordering, panel, regression, stats
from panelspark.sources import tables

PANEL = (
    "utility_id_ferc1 long, utility_id_eia long, utility_name string, report_year int, "
    "om_total double, om_other double, rate_base double, om_production double, "
    "om_transmission double, om_distribution double, om_customer_service double, "
    "om_admin_general double, sales_mwh_residential double, sales_mwh_total double, "
    "customers_total long, revenue_residential_k double, revenue_total_k double"
)


def one_row(spark, **changes):
    row = {
        "utility_id_ferc1": 1, "utility_id_eia": 2, "utility_name": "A", "report_year": 2023,
        "om_total": 100.0, "om_other": 10.0, "rate_base": 1000.0, "om_production": 40.0,
        "om_transmission": 15.0, "om_distribution": 20.0, "om_customer_service": 5.0,
        "om_admin_general": 10.0, "sales_mwh_residential": 2.0, "sales_mwh_total": 5.0,
        "customers_total": 4, "revenue_residential_k": 0.4, "revenue_total_k": 1.0, **changes,
    }
    return spark.createDataFrame([tuple(row.values())], PANEL)


def series(spark, rows):
    """(id, year, value) rows as a panel with one metric."""
    return spark.createDataFrame(
        [(i, f"U{i}", y, v) for i, y, v in rows],
        "utility_id_ferc1 long, utility_name string, report_year int, om_total double",
    )


# ---- panel --------------------------------------------------------------------------------


def test_missing_category_is_zero_and_categories_add_up(spark):
    df = spark.createDataFrame(
        [(1, 2020, "500", 10.25, "x"), (1, 2020, "501", 2.0, "x"), (1, 2020, "zzz", 5.0, "x"),
         (1, 2021, "920", None, "x"), (None, 2020, "500", 9.0, "x")],
        "utility_id_ferc1 long, report_year int, ferc_account string, dollar_value double, "
        "row_type_xbrl string",
    )
    rows = {r["report_year"]: r for r in
            panel.pivot_expenses(panel.category_sums(df)).collect()}
    assert set(rows) == {2020, 2021}
    assert rows[2020]["om_production"] == 12.25 and rows[2020]["om_other"] == 5.0
    assert rows[2020]["om_transmission"] == 0.0 and rows[2020]["om_total"] == 17.25
    assert rows[2021]["om_total"] == 0.0


def test_sums_do_not_depend_on_partitioning_or_a_hot_entity(spark):
    hot = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 500 END AS utility_id_ferc1",
        "CAST(2020 + id % 2 AS INT) AS report_year",
        "CAST(500 + id % 440 AS STRING) AS ferc_account",
        "(id * 7919 % 1000003) / 100D AS dollar_value",
    )
    results = [
        sorted(map(tuple, panel.pivot_expenses(panel.category_sums(df, scale=100)).collect()))
        for df in (hot, hot.repartition(23), hot.coalesce(1).orderBy("dollar_value"))
    ]
    assert results[0] == results[1] == results[2]


def test_roll_up_sums_numbers_and_keeps_first_text(spark):
    df = spark.createDataFrame(
        [(7, 2020, None, 1.0, 3, 0), (7, 2020, "b", 2.0, None, 2), (7, 2020, "a", None, 4, 5),
         (None, 2020, "x", 1.0, 1, 1), (8, 2020, None, None, None, 9)],
        "utility_id_eia long, report_year int, name string, x double, n long, row_ordinal long",
    )
    got = {r["utility_id_eia"]: r for r in panel.roll_up_duplicates(df).collect()}
    assert set(got) == {7, 8}
    assert (got[7]["name"], got[7]["x"], got[7]["n"]) == ("b", 3.0, 7)
    assert (got[8]["name"], got[8]["x"], got[8]["n"]) == (None, 0.0, 0)


def test_plant_wide_keeps_one_sided_and_pairs_repeated_keys(spark):
    ups = "utility_plant_in_service_classified_and_unclassified"
    acc = ("accumulated_provision_for_depreciation_amortization_and_depletion_of_plant_utility")
    rows = [(1, 2020, "electric", ups, "calculated_value", 10.0),
            (1, 2020, "electric", ups, "calculated_value", 11.0),
            (1, 2020, "electric", acc, "calculated_value", 4.0),
            (2, 2020, "electric", acc, "calculated_value", 3.0),
            (3, 2020, "electric", ups, "reported_value", 99.0),
            (None, 2020, "electric", ups, "calculated_value", 8.0),
            (None, 2020, "electric", acc, "calculated_value", 9.0),
            (5, 2020, "electric", ups, "calculated_value", None),
            (4, 2020, "gas", ups, "calculated_value", 99.0)]
    df = spark.createDataFrame(
        rows, "utility_id_ferc1 long, report_year int, utility_type string, "
        "utility_plant_asset_type string, row_type_xbrl string, ending_balance double")
    got = panel.with_rate_base(tables.plant_wide(df, [1, 2, 3, 4, 5], [2020])).collect()
    assert sorted((r["utility_id_ferc1"], r["rate_base"]) for r in got if r["rate_base"]) == [
        (1, 6.0), (1, 7.0)]
    assert [r["rate_base"] for r in got if r["utility_id_ferc1"] == 2] == [None]
    assert len(got) == 4
    loose = tables.plant_wide(df, None, [2020]).where("utility_id_ferc1 IS NULL").collect()
    assert len(loose) == 2 and {tuple(r)[2:] for r in loose} == {(None, 9.0), (8.0, None)}


def join_inputs(spark):
    def frame(rows, ddl):
        return spark.createDataFrame(rows, ddl)

    expenses = frame([(1, 2020, 5.0), (2, 2020, 6.0), (9, 2020, 7.0)],
                     "utility_id_ferc1 long, report_year int, om_total double")
    plant = frame([(1, 2020, 50.0), (3, 2020, 60.0)],
                  "utility_id_ferc1 long, report_year int, rate_base double")
    sales = frame([(101, 2020, "S1", 1.0, 0), (103, 2020, "S3", 3.0, 1), (109, 2020, "S9", 9.0, 2)],
                  "utility_id_eia long, report_year int, utility_name string, x double, "
                  "row_ordinal long")
    ids = frame([(1, 101, "M1"), (2, 102, "M2"), (3, 103, None)],
                "utility_id_ferc1 long, utility_id_eia long, utility_name string")
    return expenses, plant, sales, ids


def test_join_keeps_every_side(spark):
    got = panel.join_panel(*join_inputs(spark)).collect()
    assert {(r["utility_id_ferc1"], r["utility_id_eia"], r["utility_name"], r["om_total"],
             r["rate_base"], r["x"]) for r in got} == {
        (1, 101, "M1", 5.0, 50.0, 1.0),
        (2, 102, "M2", 6.0, None, None),
        (3, 103, "S3", None, 60.0, 3.0),
        (9, None, None, 7.0, None, None),  # id 9 must not meet sales id 109 or 9
        (None, 109, "S9", None, None, 9.0),
    }


def test_unmapped_id_does_not_match_equal_sales_id(spark):
    expenses, plant, sales, ids = join_inputs(spark)
    clash = sales.unionByName(
        spark.createDataFrame([(9, 2020, "S", 4.0, 3)], sales.schema))
    got = panel.join_panel(expenses, plant, clash, ids).where("om_total = 7.0").collect()
    assert len(got) == 1 and got[0]["x"] is None


def test_sums_are_plain_unless_a_scale_is_stated(spark):
    df = spark.createDataFrame([(1, 2020, "500", 0.004), (1, 2020, "500", 0.004),
                                (2, 2020, "500", float("inf"))],
                               "utility_id_ferc1 long, report_year int, ferc_account string,"
                               " dollar_value double")
    got = {r["utility_id_ferc1"]: r["amount"] for r in panel.category_sums(df).collect()}
    assert got == {1: 0.008, 2: float("inf")}
    cents = panel.category_sums(df.where("utility_id_ferc1 = 1"), scale=100).first()
    assert cents["amount"] == 0.0


def test_rows_without_an_accounting_id_are_no_entity(spark):
    rows = [(None, 7, "a", 2020, 1.0), (None, 8, "b", 2021, 3.0), (1, 9, "c", 2020, 2.0),
            (1, 9, "c", 2021, 3.0)]
    df = spark.createDataFrame(rows, "utility_id_ferc1 long, utility_id_eia long,"
                               " utility_name string, report_year int, om_total double")
    change = stats.yoy_change(df, "om_total").collect()
    assert len(change) == 4
    assert [r["yoy_pct_change"] for r in change if r["yoy_pct_change"] is not None] == [50.0]
    assert [r["utility_id"] for r in stats.trend(df, "om_total").collect()] == [1]
    assert stats.cagr_by_count(df, "om_total").count() == 1
    assert stats.yoy_matrix(df, "om_total", [2020, 2021]).count() == 1


def test_zero_denominators_give_null(spark):
    got = panel.derive_metrics(
        one_row(spark, customers_total=0, sales_mwh_total=0.0)).first()
    assert got["om_per_customer"] is None and got["om_per_mwh"] is None
    assert got["grc_om"] == 32.0


def test_validation_reports_and_raises(spark):
    good = one_row(spark)
    checks = panel.validate_panel(good, 2)
    panel.assert_valid(checks)
    twice = good.unionByName(good)
    failed = {r["check"] for r in panel.validate_panel(twice, 18).where("NOT passed").collect()}
    assert failed == {"row_count", "duplicate_rows"}
    with pytest.raises(ValueError):
        panel.assert_valid(panel.validate_panel(good.where("false"), 1))


# ---- models -------------------------------------------------------------------------------


def test_forecast(spark):
    got = models.forecast_test_year(one_row(spark), 2023).first()
    assert got["forecast_year_rr"] == pytest.approx(284.1095890)
    assert got["rr_change"] == pytest.approx(10.1369863)
    assert got["rr_change_pct"] == pytest.approx(3.7)
    up = models.forecast_test_year(one_row(spark), 2023, escalate_passthrough=True).first()
    assert up["forecast_year_rr"] < got["forecast_year_rr"]
    assert models.forecast_test_year(one_row(spark, rate_base=None), 2023).count() == 0


def test_forecast_of_a_year_without_rows_is_an_error(spark):
    df = series(spark, [(1, 2020, 1.0)]).selectExpr(
        "*", "1D AS rate_base", *[f"1D AS om_{c}" for c in
                                  ("distribution", "customer_service", "admin_general", "other")])
    for forecast in (models.forecast_test_year, models.forecast_test_year_grc):
        assert forecast(df, 2020).count() == 1
        with pytest.raises(ValueError, match="base year 2023"):
            forecast(df, 2023)


def test_profile_shows_head_rows(spark):
    df = series(spark, [(i, 2020, None) for i in (5, 3, 9, 1)])
    got = panel.profile(df, head=2, order=["utility_id_ferc1"], shown=["utility_id_ferc1"])
    rows = {r["stat"]: (r["value"], r["shown"]) for r in got.collect()}
    assert rows["head_1_utility_id_ferc1"] == (None, "1") and rows["row_count"] == (4, None)
    assert rows["head_2_utility_id_ferc1"] == (None, "3") and "head_3_utility_id_ferc1" not in rows
    assert panel.profile(df.where("false"), head=2, order=["utility_id_ferc1"]).where(
        "stat LIKE 'head%'").count() == 0


def test_wacc_sensitivity(spark):
    rows = models.wacc_sensitivity(one_row(spark)).orderBy("wacc").collect()
    expected = [260.273973, 273.972603, 287.671233, 301.369863, 315.068493]
    assert [r["revenue_requirement"] for r in rows] == pytest.approx(expected)
    assert [r["change_from_base"] for r in rows] == pytest.approx(
        [e - expected[0] for e in expected], abs=1e-5)


def test_bill_sensitivity(spark):
    rows = {r["scenario"]: r for r in bills.bill_sensitivity(one_row(spark), 2023).collect()}
    expected = {
        "Base Case": 297.808219, "High O&M Escalation": 300.547945,
        "Low O&M Escalation": 295.068493, "High Rate Base Growth": 300.821918,
        "Low Rate Base Growth": 294.794521, "High WACC": 312.054795, "Low WACC": 283.561644,
    }
    for name, value in expected.items():
        assert rows[name]["revenue_requirement"] == pytest.approx(value)
        assert rows[name]["monthly_bill"] == pytest.approx(value / 10)
    assert rows["Base Case"]["change_pct"] == 0.0


def test_bill_impact_scales_the_actual_bill(spark):
    got = bills.bill_impact(one_row(spark), 2023).first()
    assert got["current_monthly_bill"] == pytest.approx(0.4 * 1000 / 2000 * 500)
    assert got["monthly_change_pct"] == pytest.approx(3.7)
    assert got["annual_change_dollars"] == pytest.approx(12 * 0.037 * 100)
    for change in [{"sales_mwh_residential": 0.0}, {"om_total": None},
                   {"om_total": 10.0, "rate_base": -1.0}]:
        assert bills.bill_impact(one_row(spark, **change), 2023).count() == 0
    assert bills.bill_impact(one_row(spark, revenue_total_k=0.0), 2023).first()[
        "residential_share"] == 0.0


def test_alternate_grc_and_waterfall(spark):
    alt = models.add_grc_requirement_alt(one_row(spark).drop("om_other")).first()
    assert alt["om_excluded"] == pytest.approx(40 + 15 + 3)
    assert alt["revenue_requirement_grc"] == pytest.approx(163.3)
    modelled = models.add_grc_requirement(models.add_requirement(one_row(spark)))
    bars = charts.requirement_waterfall(modelled).orderBy("step").collect()
    assert bars[5]["start"] + bars[5]["height"] == pytest.approx(bars[6]["height"])
    assert bars[6]["start"] == 0.0


def test_revenue_falls_back_to_sales_revenue(spark):
    got = models.add_requirement(one_row(spark)).first()
    assert got["actual_revenue"] == 1000.0
    assert got["revenue_gap"] == pytest.approx(273.9726027 - 1000)


# ---- statistics ---------------------------------------------------------------------------


def test_trend_golden(spark):
    rows = [(1, 2018 + i, v) for i, v in enumerate([1.0, 3.0, 4.0, 9.0])]
    rows += [(2, 2018, 5.0), (2, 2019, None)]
    rows += [(3, 2018, 2.0), (3, 2019, 2.0), (4, 2018, 2.0), (4, 2019, 3.0)]
    rows += [(5, 2018 + i, 7.0) for i in range(4)]
    got = {r["utility_id"]: r for r in stats.trend(series(spark, rows), "om_total").collect()}
    assert got[1]["slope"] == pytest.approx(2.5)
    assert got[1]["r_squared"] == pytest.approx(0.8992805755)
    assert got[1]["p_value"] == pytest.approx(0.0516959, abs=1e-7)
    assert got[1]["cagr_percent"] == pytest.approx(108.0083823)
    assert got[1]["std"] == pytest.approx(3.4034296)
    assert got[1]["coefficient_of_variation"] == pytest.approx(80.0806975)
    assert got[2]["status"] == "insufficient data" and got[2]["slope"] is None
    assert (got[3]["p_value"], got[4]["p_value"]) == (1.0, 0.0)
    assert got[5]["r_squared"] == 0.0 and got[5]["p_value"] == pytest.approx(1.0)


def test_yoy(spark):
    rows = [(1, 2018, -10.0), (1, 2019, 5.0), (1, 2021, 0.0), (1, 2022, 5.0), (1, 2023, None)]
    got = stats.yoy_change(series(spark, rows), "om_total").orderBy("report_year").collect()
    assert [r["yoy_pct_change"] for r in got] == [None, 150.0, -100.0, None, None]
    gaps = [(1, 2018, 10.0), (1, 2019, None), (1, 2020, 12.0)]
    cells = stats.yoy_cells(series(spark, gaps), "om_total").orderBy("report_year").collect()
    assert [c["om_yoy_pct"] for c in cells] == [None, 0.0, pytest.approx(20.0)]
    assert [c["is_flagged"] for c in cells] == [False, False, True]


def test_ranks_with_ties_and_nulls(spark):
    df = series(spark, [(1, 2020, 1.0), (2, 2020, 2.0), (3, 2020, 2.0), (4, 2020, 4.0),
                        (5, 2020, None), (6, 2019, 9.0)])
    rows = stats.peer_benchmark(df, 2020, "om_total").collect()
    assert [(r["utility_id_ferc1"], r["percentile"], r["rank"]) for r in rows] == [
        (4, 100.0, 1), (2, 62.5, 2), (3, 62.5, 2), (1, 25.0, 4), (5, None, None)]


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_ranks_in_ranges_match_pandas(spark, ranges):
    rng = np.random.default_rng(3)
    values = np.r_[rng.integers(0, 40, 300).astype(float), np.full(150, 17.0)]  # one hot value
    pdf = pd.DataFrame({"id": range(len(values)), "v": values})
    got = ordering.ranked(
        spark.createDataFrame(pdf).repartition(5), "v", ranges
    ).toPandas().sort_values("id")
    assert got["rank"].tolist() == pdf["v"].rank(ascending=False, method="min").tolist()
    assert got["percentile"].to_numpy() == pytest.approx(pdf["v"].rank(pct=True) * 100)


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_ordered_moments_across_ranges(spark, ranges):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.integers(0, 30, 200), "b": range(200),
                        "e": 1e6 + rng.normal(size=200) ** 3})
    df = spark.createDataFrame(pdf).repartition(6)
    got = ordering.ordered_moments(df, ["a", "b"], "e", ranges).collect()
    in_order = pdf.sort_values(["a", "b"])["e"].to_numpy()
    c = in_order - in_order.mean()
    want = [200, in_order.mean(), *[(c**k).sum() for k in (2, 3, 4)], (np.diff(in_order) ** 2).sum()]
    assert list(got[0]) == pytest.approx(want, rel=1e-9)
    empty = ordering.ordered_moments(df.where("a < 0"), ["a", "b"], "e", ranges).collect()
    assert [list(r) for r in empty] == [[0.0, None, None, None, None, None]]


def test_ranks_of_a_hot_value_and_nulls_are_even_work(spark):
    """A third of the rows share a value, half have none; no task gets twice the median."""
    rng = np.random.default_rng(3)
    n = 30_000
    values = rng.integers(0, 5000, n).astype(float)
    values[: n // 3] = 17.0
    values[rng.permutation(n)[: n // 2]] = np.nan
    pdf = pd.DataFrame({"id": range(n), "v": values})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(pdf).selectExpr("id", "nanvl(v, NULL) AS v").repartition(5)
        ranks = ordering.ranked(df, "v", 16)
        text = ranks._jdf.queryExecution().executedPlan().toString()
        work = [r["count"] for r in ranks.groupBy(F.spark_partition_id()).count().collect()]
        got = ranks.toPandas().sort_values("id")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Join" not in text and len(work) == 16
    assert max(work) < 2 * np.median(work)
    want = pdf["v"].rank(ascending=False, method="min")
    assert got["rank"].fillna(-1).tolist() == want.fillna(-1).tolist()
    assert got["percentile"].fillna(-1).to_numpy() == pytest.approx(
        (pdf["v"].rank(pct=True) * 100).fillna(-1).to_numpy())


def test_outliers(spark):
    rows = [(i, 2020, 10.0 + i % 3) for i in range(30)] + [(99, 2020, 100.0)]
    got = stats.outliers(series(spark, rows), "om_total").collect()
    assert [r["utility_id_ferc1"] for r in got] == [99]
    flat = series(spark, [(i, 2020, 1.0) for i in range(5)])
    assert stats.outliers(flat, "om_total").count() == 0


def drivers(seed=11, n=60):
    rng = np.random.default_rng(seed)
    customers = rng.integers(1_000_000, 5_000_000, n)
    mwh = customers * 18.0 + rng.normal(0, 4e6, n)
    rate_base = customers * 9e3 + rng.normal(0, 8e9, n)
    om = 5e8 + 120 * customers + 3 * mwh + 0.3 * rate_base + rng.normal(0, 4e8, n)
    return pd.DataFrame({"utility_id_eia": range(n), "report_year": 2020, "om_total": om,
                         "customers_total": customers, "sales_mwh_total": mwh,
                         "rate_base": rate_base})


def least_squares(pdf):
    x = np.column_stack([np.ones(len(pdf)), pdf[regression.COST_DRIVERS].to_numpy(float)])
    y = pdf["om_total"].to_numpy()
    scale = np.abs(x).max(0)
    q, r = np.linalg.qr(x / scale)
    coef = np.linalg.solve(r, q.T @ y) / scale
    resid = y - x @ coef
    sigma2 = resid @ resid / (len(y) - 4)
    se = np.sqrt(sigma2 * np.diag(np.linalg.inv(r.T @ r))) / scale
    return x, y, coef, se, resid


def test_regression_matches_least_squares(spark):
    pdf = drivers()
    _, y, coef, se, resid = least_squares(pdf)
    rows = regression.fit_terms(spark.createDataFrame(pdf).repartition(4)).collect()
    assert [r["term"] for r in rows] == ["const", *regression.COST_DRIVERS]
    assert [r["coef"] for r in rows] == pytest.approx(coef.tolist(), rel=1e-6)
    assert [r["std_err"] for r in rows] == pytest.approx(se.tolist(), rel=1e-6)
    r2 = 1 - resid @ resid / ((y - y.mean()) ** 2).sum()
    assert rows[0]["r_squared"] == pytest.approx(r2)
    assert all(r["ci_low"] < r["coef"] < r["ci_high"] for r in rows)


def test_regression_reports_what_it_cannot_fit(spark):
    few = regression.fit_terms(spark.createDataFrame(drivers(n=3))).collect()
    assert [r["status"] for r in few] == ["insufficient data"]
    pdf = drivers().assign(sales_mwh_total=lambda d: d["customers_total"] * 10.0)
    pdf["group"] = np.where(pdf.index % 2, "odd", "even")
    same = regression.fit_terms(spark.createDataFrame(pdf), group_by=["group"]).collect()
    assert [r["status"] for r in same] == ["collinear drivers"] * 2


def fit_frame(spark, x, y, group=None):
    names = [f"x{i}" for i in range(x.shape[1])]
    pdf = pd.DataFrame(x, columns=names).assign(om_total=y, g=0 if group is None else group)
    return spark.createDataFrame(pdf).repartition(4), names


def test_collinear_drivers_are_found_in_a_hundred_cases(spark):
    """Combinations with rounding, far from zero and of very different sizes, each a group."""
    rng = np.random.default_rng(8)
    xs, ys, groups = [], [], []
    for g in range(100):
        n = int(rng.integers(8, 60))
        x = rng.normal(size=(n, 3)) * 10.0 ** rng.integers(-6, 7, 3) + rng.choice([0.0, 1e3], 3)
        a, b = rng.normal(size=2) * 10.0 ** rng.integers(-3, 4, 2)
        x[:, 2] = [x[:, 0] + 1000 * x[:, 1], a * x[:, 0] + b * x[:, 1] + 7, a * x[:, 1]][g % 3]
        xs.append(x[:, rng.permutation(3)])
        ys.append(2 * x[:, 0] + rng.normal(size=n))
        groups += [g] * n
    df, names = fit_frame(spark, np.vstack(xs), np.concatenate(ys), groups)
    got = regression.fit_terms(df, xs=names, group_by=["g"]).collect()
    assert [r["status"] for r in got] == ["collinear drivers"] * 100
    factors = regression.vif(df, names, ["g"]).collect()
    assert len(factors) == 300 and all(r["vif"] is None for r in factors)
    one = regression.fit_terms(df.where("g = 3"), xs=names).collect()
    assert [r["status"] for r in one] == ["collinear drivers"]


def test_nearly_collinear_drivers_keep_their_digits(spark):
    """Against exact arithmetic on the same doubles."""
    from fractions import Fraction

    def exact(x, y):
        rows = [[Fraction(1), *map(Fraction, map(float, r))] for r in x]
        k = len(rows[0])
        m = [[sum(r[i] * r[j] for r in rows) for j in range(k)]
             + [sum(r[i] * Fraction(float(v)) for r, v in zip(rows, y))] for i in range(k)]
        for i in range(k):
            p = next(r for r in range(i, k) if m[r][i])
            m[i], m[p] = m[p], m[i]
            m[i] = [v / m[i][i] for v in m[i]]
            for r in range(k):
                if r != i:
                    m[r] = [a - m[r][i] * b for a, b in zip(m[r], m[i])]
        return [float(r[-1]) for r in m]

    rng = np.random.default_rng(9)
    xs, ys, groups, want = [], [], [], {}
    for g in range(12):
        n = 25
        x = rng.normal(size=(n, 3))
        x[:, 2] = x[:, 0] - 2 * x[:, 1] + 10.0 ** -(g % 6) * rng.normal(size=n)
        y = 1 + x @ [1.0, 2.0, 3.0] + 1e-3 * rng.normal(size=n)
        xs.append(x)
        ys.append(y)
        groups += [g] * n
        want[g] = exact(x, y)
    df, names = fit_frame(spark, np.vstack(xs), np.concatenate(ys), groups)
    rows = regression.fit_terms(df, xs=names, group_by=["g"]).collect()
    assert {r["status"] for r in rows} == {"ok"}
    for g, coefs in want.items():
        got = {r["term"]: r["coef"] for r in rows if r["g"] == g}
        assert [got["const"], *[got[x] for x in names]] == pytest.approx(coefs, rel=1e-8)
    single = regression.fit_terms(df.where("g = 4"), xs=names).collect()
    assert [r["coef"] for r in single] == pytest.approx(want[4], rel=1e-8)


def test_factors_of_a_hot_group_and_many_small_ones(spark, monkeypatch):
    """Tasks that flush their groups early give the same factors."""
    rows = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 2500 END AS g", "CAST(hash(id) % 100 AS DOUBLE) AS a",
        "CASE WHEN id % 7 = 0 THEN NULL ELSE CAST(hash(id, 1) % 100 AS DOUBLE) END AS b")
    pdf = rows.dropna().toPandas()
    got = regression.factors(rows.repartition(12), ["a", "b"], ["g"]).collect()
    assert sum(r["n"] for r in got) == len(pdf) and len(got) == pdf["g"].nunique()
    for r in got[:200] + [r for r in got if r["g"] == 0]:
        x = pdf[pdf["g"] == r["g"]][["a", "b"]].to_numpy()
        x = np.c_[np.ones(len(x)), x]
        f = np.array(r["factor"]).reshape(3, 3)
        assert r["n"] == len(x) and f.T @ f == pytest.approx(x.T @ x)
    held = regression._Held(3)
    monkeypatch.setattr(regression, "HELD_VALUES", 30)
    for g in range(9):
        held.add((g % 2,), np.ones((4, 3)) * g, 4)
    assert held.full() in (True, False) and held.held[(0,)][0] == 20


def test_diagnostics(spark):
    pdf = drivers()
    x, y, coef, _, e = least_squares(pdf)
    got = {r["stat"]: r["value"] for r in regression.diagnostics(
        spark.createDataFrame(pdf).repartition(3), ["utility_id_eia", "report_year"]).collect()}
    n, ssr = len(y), e @ e
    loglik = -n / 2 * (np.log(2 * np.pi) + np.log(ssr / n) + 1)
    c = e - e.mean()
    skew = (c**3).mean() / (c**2).mean() ** 1.5
    kurt = (c**4).mean() / (c**2).mean() ** 2
    expected = {
        "n_obs": n, "df_model": 3, "df_residual": n - 4, "log_likelihood": loglik,
        "aic": -2 * loglik + 8, "bic": -2 * loglik + 4 * np.log(n),
        "durbin_watson": (np.diff(e) ** 2).sum() / ssr, "skew": skew, "kurtosis": kurt,
        "jarque_bera": n / 6 * (skew**2 + (kurt - 3) ** 2 / 4),
    }
    for stat, value in expected.items():
        assert got[stat] == pytest.approx(value, rel=1e-6), stat
    condition = regression.condition_number(spark.createDataFrame(pdf).repartition(5)).first()
    assert condition["value"] == pytest.approx(np.linalg.cond(x), rel=1e-6)


def test_vif(spark):
    pdf = drivers()
    r = np.corrcoef(pdf[regression.COST_DRIVERS].to_numpy(float), rowvar=False)
    got = [v["vif"] for v in regression.vif(spark.createDataFrame(pdf)).collect()]
    assert got == pytest.approx(np.diag(np.linalg.inv(r)).tolist(), rel=1e-8)


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_vif_of_any_number_of_drivers_by_year(spark, k):
    rng = np.random.default_rng(k)
    names = [f"x{i}" for i in range(k)]
    common = rng.normal(size=(300, 1))
    pdf = pd.DataFrame(common + rng.normal(size=(300, k)) * 10.0 ** np.arange(k), columns=names)
    pdf["report_year"] = rng.integers(2000, 2004, 300)
    got = regression.vif(spark.createDataFrame(pdf).repartition(5), names, ["report_year"]).collect()
    for year, group in pdf.groupby("report_year"):
        r = np.atleast_2d(np.corrcoef(group[names].to_numpy(), rowvar=False))
        found = [v["vif"] for v in got if v["report_year"] == year]
        assert found == pytest.approx(np.diag(np.linalg.inv(r)).tolist(), rel=1e-8)
    few = spark.createDataFrame(pdf.head(k))
    assert all(v["vif"] is None for v in regression.vif(few, names).collect())


def test_variance_decomposition(spark):
    pdf = pd.DataFrame({"utility_id_ferc1": [1, 1, 2, 2], "utility_name": ["A", "A", "B", "B"],
                        "report_year": [2020, 2023] * 2, "grc_om": [5.0, 7.0, 1.0, 2.0],
                        "rate_base": [40.0, 47.0, 10.0, 12.0]})
    slope = np.polyfit(pdf["rate_base"], pdf["grc_om"], 1)[0]
    got = stats.variance_decomposition(spark.createDataFrame(pdf), "grc_om", "rate_base")
    first = got.orderBy("utility_id_ferc1").first()
    assert first["explained"] == pytest.approx(slope * 7)
    assert first["unexplained"] == pytest.approx(2 - slope * 7)


def test_ten_thousand_groups_are_solved_together(spark):
    rows = spark.range(50_000).selectExpr(
        "id % 10000 AS g", "CAST(hash(id) % 1000 AS DOUBLE) AS customers_total",
        "CAST(hash(id, 1) % 1000 AS DOUBLE) AS sales_mwh_total",
        "CAST(hash(id, 2) % 1000 AS DOUBLE) AS rate_base",
    ).selectExpr("*", "3 + 2 * customers_total - sales_mwh_total + 0.5D * rate_base AS om_total")
    terms = regression.fit_terms(rows, group_by=["g"])
    got = terms.where("status = 'ok' AND term = 'customers_total'").selectExpr(
        "count(1) AS n", "max(abs(coef - 2)) AS off", "max(ci_high - ci_low) AS wide").first()
    assert got["n"] == 10_000 and got["off"] < 1e-5 and got["wide"] < 0.1


def test_confidence_interval_of_a_known_fit(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(30, 3))
    y = 1 + x @ [2.0, -1.0, 0.5] + rng.normal(size=30)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)],
                               "customers_total double, sales_mwh_total double,"
                               " rate_base double, om_total double")
    design = np.c_[np.ones(30), x]
    inverse = np.linalg.inv(design.T @ design)
    coef = inverse @ design.T @ y
    error = np.sqrt(((y - design @ coef) ** 2).sum() / 26 * np.diag(inverse))
    for i, r in enumerate(regression.fit_terms(df).collect()):
        assert abs(r["ci_low"] - (coef[i] - 2.055529439 * error[i])) < 1e-6
        assert abs(r["ci_high"] - (coef[i] + 2.055529439 * error[i])) < 1e-6


def test_analysis_goes_on_after_a_failure_and_on_an_empty_panel(spark):
    from panelspark.operators import findings

    schema = ("utility_id_ferc1 long, utility_id_eia long, utility_name string, report_year int,"
              " om_total double, om_per_customer double, om_per_mwh double, rate_base double,"
              " customers_total long, sales_mwh_total double")
    empty = spark.createDataFrame([], schema)
    results = findings.run_analysis(empty)
    assert {n.removesuffix("_error") for n in results} == {
        "trend_results", "regression", "regression_summary", "condition_number", "vif",
        "outliers", "benchmarks", "yoy_changes", "utility_summaries"}
    assert results["regression_summary"].first()["stat"].startswith("insufficient data")
    assert results["benchmarks"].count() == 0
    broken = findings.run_analysis(empty.drop("customers_total"))
    assert "regression_error" in broken and "trend_results" in broken
    four = [(1, 1, "a", 2000 + i, float(i * i), 1.0, 1.0, float(i % 3), i, float(i ** 3))
            for i in range(4)]
    few = regression.diagnostics(spark.createDataFrame(four, schema), ["report_year"]).collect()
    assert {r["stat"] for r in few} >= {"n_obs", "r_squared", "f_statistic"}
    line = [(1, 1, "a", 2000 + i, float(i), 1.0, 1.0, float(i), i, float(i)) for i in range(9)]
    assert regression.diagnostics(
        spark.createDataFrame(line, schema), ["report_year"]).first()["stat"] == "collinear drivers"
