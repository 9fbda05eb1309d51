"""Every operator as a named query over the test tables: name -> (spark, sf_dir) -> DataFrame.

Amounts are exact, so column arithmetic on them gives the same bits in any engine and is shown as
is. Values whose last digits depend on summation order (means, variances, powers, sums of landed
revenue) are rounded to a stated number of digits, the same in the SQL twin.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.config import SECTORS, TARGET_STATE, WHOLE_CENTS
from panelspark.functions.columns import add_columns, aggregate, format_billions, format_millions
from panelspark.operators import bills, charts, findings, models, panel, regression, stats
from panelspark.plans import bindings as bind
from panelspark.plans.jobs import run_models, summary_tables
from panelspark.schemas import REVENUE_COLUMNS, SALES
from panelspark.sources import sinks, tables
from panelspark.sources.workbook_format import FORMAT, WorkbookFormat

Query = Callable[[SparkSession, str], DataFrame]
BASE = bind.BASE_YEAR
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    chosen = columns or [f.name for f in df.schema if f.dataType.typeName() == "double"]
    return add_columns(df, {c: f"round(`{c}`, {digits})" for c in chosen})


REVENUES = [*REVENUE_COLUMNS, "revenue_per_customer"]


def clean(spark, sf, years=None) -> DataFrame:
    return bind.panel(spark, sf, years)


def staged(spark, sf) -> DataFrame:
    """The panel written once, for the queries that read it more than once."""
    return sinks.stage(clean(spark, sf))


def modelled(spark, sf, years=None) -> DataFrame:
    return models.add_grc_requirement(models.add_requirement(clean(spark, sf, years)))


# ---- sources ----------------------------------------------------------------------------


@query
def yearly_union(spark, sf):
    folder = sinks.stage_path(spark)
    sinks.write_table(bind.sales(spark, sf), folder, partition_by=["report_year"])
    return tables.read_yearly_sales(spark, folder + "/report_year={year}", bind.YEARS)


def booked(spark, sf) -> str:
    """The folder of the sales rows as workbooks, cut from one order by year and ordinal."""
    spark.dataSource.register(WorkbookFormat)
    folder = sinks.stage_path(spark)
    rows = bind.sales(spark, sf).orderBy("report_year", "row_ordinal")
    rows.write.format(FORMAT).mode("append").save(folder)
    return folder


@query
def workbook_sales(spark, sf):
    """Sales rows written as workbooks of a year each and read back from the workbooks."""
    return spark.read.format(FORMAT).load(booked(spark, sf)).drop("row_ordinal")


@query
def workbook_rollup(spark, sf):
    """One row per sales entity and year from the workbooks: their order of rows decides on text."""
    names = ["report_year", "utility_id_eia", "ownership", "customers_total", "row_ordinal"]
    wanted = [f"{f.name} {f.dataType.simpleString()}" for f in SALES if f.name in names]
    read = spark.read.format(FORMAT).schema(", ".join(wanted)).load(booked(spark, sf))
    return panel.roll_up_duplicates(read)


@query
def expense_scan(spark, sf):
    ids = bind.id_map(spark, sf).select("utility_id_ferc1")
    return tables.expenses(bind.expenses(spark, sf, bind.YEARS), ids, bind.YEARS)


@query
def plant_wide(spark, sf):
    return tables.plant_wide(bind.plant(spark, sf), None, bind.YEARS)


@query
def income_scan(spark, sf):
    ids = bind.id_map(spark, sf).select("utility_id_ferc1")
    return tables.income(bind.income(spark, sf), ids, bind.YEARS)


@query
def operating_revenue(spark, sf):
    return tables.operating_revenue(bind.income(spark, sf), scale=WHOLE_CENTS)


@query
def association_scan(spark, sf):
    filers = bind.income(spark, sf).select("utility_id_ferc1")
    return tables.association(bind.id_map(spark, sf), filers)


@query
def state_entity_filter(spark, sf):
    ids = bind.id_map(spark, sf).select("utility_id_eia")
    return tables.state_entities(bind.sales(spark, sf), TARGET_STATE, ids)


# ---- panel ------------------------------------------------------------------------------


@query
def account_category(spark, sf):
    rows = panel.categorize(bind.expenses(spark, sf))
    return aggregate(rows, ["ferc_account", "category"], {"n": "count(1)"})


@query
def dedupe_rollup(spark, sf):
    return rounded(panel.roll_up_duplicates(bind.sales(spark, sf)), 6, *REVENUE_COLUMNS)


@query
def expense_pivot(spark, sf):
    return panel.pivot_expenses(panel.category_sums(tables.expenses(bind.expenses(spark, sf)), WHOLE_CENTS))


@query
def rate_base(spark, sf):
    return panel.with_rate_base(tables.plant_wide(bind.plant(spark, sf)))


@query
def panel_join(spark, sf):
    joined = panel.join_panel(
        panel.pivot_expenses(panel.category_sums(tables.expenses(bind.expenses(spark, sf)), WHOLE_CENTS)),
        panel.with_rate_base(tables.plant_wide(bind.plant(spark, sf))),
        panel.roll_up_duplicates(tables.state_entities(bind.sales(spark, sf), TARGET_STATE)),
        bind.id_map(spark, sf),
        tables.operating_revenue(bind.income(spark, sf), scale=WHOLE_CENTS),
    )
    return rounded(joined, 6, *REVENUE_COLUMNS)


@query
def panel_final(spark, sf):
    return rounded(bind.panel(spark, sf), 6, *REVENUES)


@query
def derived_metrics(spark, sf):
    return rounded(
        clean(spark, sf).select(
            "utility_id_ferc1",
            "report_year",
            "grc_om",
            "om_per_customer",
            "grc_om_per_customer",
            "om_per_mwh",
            "rate_base_per_customer",
            "revenue_per_customer",
        ),
        6,
        "revenue_per_customer",
    )


@query
def validate_panel(spark, sf):
    entities = bind.id_map(spark, sf).agg(F.count(F.lit(1))).scalar()
    ragged = bind.panel(spark, sf)
    return panel.validate_panel(ragged, entities * len(bind.YEARS))


@query
def null_profile(spark, sf):
    keys = ["utility_id_ferc1", "report_year", "utility_id_eia", "utility_name"]
    return panel.profile(bind.panel(spark, sf), head=20, order=keys, shown=keys)


@query
def distinct_accounts(spark, sf):
    return panel.distinct_values(bind.expenses(spark, sf), "ferc_account")


@query
def distinct_income_types(spark, sf):
    return panel.distinct_values(bind.income(spark, sf), "income_type")


@query
def top_accounts(spark, sf):
    return panel.top_accounts(bind.expenses(spark, sf, [BASE]), scale=WHOLE_CENTS)


@query
def format_amounts(spark, sf):
    df = clean(spark, sf)
    return df.selectExpr(
        "utility_id_ferc1",
        "report_year",
        f"{format_billions('om_total')} AS om_billions",
        f"{format_millions('om_total')} AS om_millions",
    )


@query
def om_ex_production(spark, sf):
    return models.om_ex_production(clean(spark, sf))


@query
def kpi_formulas(spark, sf):
    return models.kpi_formulas(modelled(spark, sf))


@query
def wacc_from_capital(spark, sf):
    """Weighted cost of capital with equity as rate base over rate base plus revenue."""
    df = clean(spark, sf).where("rate_base > 0 AND operating_revenues_ferc > 0")
    total = "(rate_base + operating_revenues_ferc)"
    wacc = models.wacc_of(
        f"rate_base / {total}", "0.1D", f"operating_revenues_ferc / {total}", "0.05D"
    )
    return df.selectExpr("utility_id_ferc1", "report_year", f"{wacc} AS wacc")


@query
def baseline_filter(spark, sf):
    kept = panel.start_from_baseline(clean(spark, sf), bind.baselines(spark, sf))
    return kept.select("utility_id_ferc1", "report_year", "om_total", "rate_base")


# ---- models -----------------------------------------------------------------------------


@query
def revenue_requirement(spark, sf):
    return models.requirement_breakdown(clean(spark, sf))


@query
def revenue_requirement_with_passthrough(spark, sf):
    return models.requirement_breakdown(clean(spark, sf), exclude_passthrough=False)


@query
def revenue_gap(spark, sf):
    return rounded(models.add_requirement(clean(spark, sf)), 6, *REVENUES)


@query
def grc_requirement(spark, sf):
    return rounded(modelled(spark, sf), 6, *REVENUES)


@query
def grc_breakdown(spark, sf):
    return models.add_grc_breakdown(clean(spark, sf)).select(
            "utility_id_ferc1",
            "report_year",
            "om_distribution",
            "om_customer_service",
            "om_ag_total",
            "om_ag_electric",
            "om_ag_gas",
            "om_grc",
            "om_excluded",
            "om_production",
            "om_transmission",
        )


@query
def grc_alt(spark, sf):
    return models.add_grc_requirement_alt(clean(spark, sf)).select(
            "utility_id_ferc1",
            "report_year",
            "om_grc",
            "om_ag_electric",
            "om_excluded",
            "depreciation",
            "return_on_rate_base",
            "taxes_grc",
            "revenue_requirement_grc",
            "om_per_customer_grc",
            "om_per_mwh_grc",
        )


@query
def test_year_forecast(spark, sf):
    return models.forecast_test_year(sinks.stage(clean(spark, sf, [BASE])), BASE)


@query
def test_year_forecast_grc(spark, sf):
    return models.forecast_test_year_grc(sinks.stage(clean(spark, sf, [BASE])), BASE)


@query
def wacc_sensitivity(spark, sf):
    return models.wacc_sensitivity(clean(spark, sf))


@query
def compare_methodologies(spark, sf):
    return models.compare_methodologies(modelled(spark, sf, [BASE]), BASE)


@query
def class_shares(spark, sf):
    shares = rounded(bills.class_shares(clean(spark, sf)), 6, *REVENUE_COLUMNS)
    return rounded(shares, 9, *[f"{s}_share" for s in SECTORS])


@query
def residential_bill(spark, sf):
    return rounded(bills.allocated_bills(clean(spark, sf, [BASE]), BASE), 6)


@query
def bill_impact(spark, sf):
    impact = bills.bill_impact(clean(spark, sf, [BASE]), BASE)
    shares = [c for c in impact.columns if "_share" in c or "_rate_" in c]
    dollars = [c for c in impact.columns if c.startswith("monthly_") or "_monthly_bill" in c]
    return rounded(rounded(impact, 9, *shares), 7, *dollars, "annual_change_dollars")


@query
def bill_sensitivity(spark, sf):
    result = bills.bill_sensitivity(clean(spark, sf, [BASE]), BASE)
    return rounded(result, 6, "monthly_bill", "change_from_base", "change_pct")


@query
def ag_sensitivity(spark, sf):
    return models.ag_sensitivity(clean(spark, sf))


@query
def ag_backsolve(spark, sf):
    return models.ag_backsolve(clean(spark, sf), "om_total * 0.25D")


@query
def residential_bill_methods(spark, sf):
    return rounded(bills.residential_bill_methods(clean(spark, sf, [BASE]), BASE), 9)


@query
def revenue_reconcile(spark, sf):
    authorised = "(om_total * 0.5D)"
    return rounded(models.reconcile_revenue(modelled(spark, sf), authorised), 6)


@query
def rr_recompute_check(spark, sf):
    stored = models.add_requirement(clean(spark, sf))
    return models.requirement_check(stored)


@query
def cost_breakdown(spark, sf):
    return models.cost_breakdown(clean(spark, sf, [BASE]), BASE, unit=1e6)


@query
def summary_requirement(spark, sf):
    results = run_models(sinks.stage(clean(spark, sf, [BASE])), BASE)
    return summary_tables(results, BASE)["requirement"]


# ---- statistics -------------------------------------------------------------------------

_TREND_DIGITS = {"slope": 4, "intercept": 0, "mean": 5, "std": 4}


def _trend(df: DataFrame) -> DataFrame:
    df = add_columns(df, {c: f"round({c}, {d})" for c, d in _TREND_DIGITS.items()})
    return rounded(df, 6, "r_squared", "cagr_percent", "coefficient_of_variation")


@query
def trend(spark, sf):
    return _trend(stats.trend(clean(spark, sf), "om_total", p_values=False))


@query
def trend_pvalue(spark, sf):
    result = stats.trend(clean(spark, sf), "rate_base")
    return rounded(result.select("utility_id", "r_squared", "p_value", "status"), 6)


@query
def summary_by_entity(spark, sf):
    result = rounded(stats.summary_by_entity(clean(spark, sf)), 5, "mean")
    return rounded(result, 4, "std", "cagr_percent")


@query
def cagr_by_count(spark, sf):
    return rounded(stats.cagr_by_count(clean(spark, sf), "om_total"), 6)


@query
def cagr_baseline(spark, sf):
    result = stats.cagr_from_baseline(clean(spark, sf), bind.baselines(spark, sf), "grc_om")
    return rounded(result, 6)


@query
def yoy_change(spark, sf):
    return stats.yoy_change(clean(spark, sf), "om_total")


@query
def yoy_matrix(spark, sf):
    return stats.yoy_matrix(clean(spark, sf), "om_total", bind.YEARS)


@query
def yoy_matrix_flags(spark, sf):
    return stats.yoy_cells(clean(spark, sf), "rate_base")


@query
def peer_benchmark(spark, sf):
    return rounded(stats.peer_benchmark(staged(spark, sf), None, "om_per_customer"), 6)


@query
def outliers(spark, sf):
    return rounded(
        stats.outliers(staged(spark, sf), "om_per_customer"), 6, *REVENUES, "z_score"
    )


@query
def peer_pct_diff(spark, sf):
    return rounded(charts.peer_comparison(sinks.stage(clean(spark, sf, [BASE])), BASE), 6)


@query
def variance_decomposition(spark, sf):
    df = sinks.stage(
        clean(spark, sf).select(
            "utility_id_ferc1", "utility_name", "report_year", "grc_om", "rate_base"
        )
    )
    result = stats.variance_decomposition(df, "grc_om", "rate_base")
    result = rounded(result, 3, "explained", "unexplained", "pct_explained")
    result = rounded(result, 6, "total_change", "driver_change")
    return rounded(result, 9, "slope", "r_squared")


_COEFFICIENTS = ["coef", "std_err", "ci_low", "ci_high"]


def _terms(df: DataFrame) -> DataFrame:
    df = rounded(df, 3, *_COEFFICIENTS)
    return rounded(df, 6, "t_value", "p_value", "r_squared", "adj_r_squared")


@query
def ols_cost_drivers(spark, sf):
    return _terms(regression.fit_terms(clean(spark, sf)))


@query
def ols_baseline(spark, sf):
    kept = panel.start_from_baseline(clean(spark, sf), bind.baselines(spark, sf))
    return _terms(regression.fit_terms(kept))


@query
def ols_by_year(spark, sf):
    return _terms(regression.fit_terms(clean(spark, sf), group_by=["report_year"]))


@query
def vif(spark, sf):
    return rounded(regression.vif(clean(spark, sf)), 6)


FIVE_DRIVERS = [*regression.COST_DRIVERS, "om_distribution", "operating_revenues_ferc"]


@query
def vif_two(spark, sf):
    return rounded(regression.vif(clean(spark, sf), FIVE_DRIVERS[:2]), 6)


@query
def vif_five(spark, sf):
    return rounded(regression.vif(clean(spark, sf), FIVE_DRIVERS), 5)


@query
def vif_by_year(spark, sf):
    return rounded(regression.vif(clean(spark, sf), group_by=["report_year"]), 6)


@query
def ols_diagnostics(spark, sf):
    df = clean(spark, sf).select("utility_id_eia", "report_year", "om_total", *_drivers())
    return rounded(regression.diagnostics(df, ["utility_id_eia", "report_year"]), 5)


def _drivers():
    return list(regression.COST_DRIVERS)


@query
def ols_condition_number(spark, sf):
    return rounded(regression.condition_number(clean(spark, sf)), 0)


@query
def key_findings(spark, sf):
    return rounded(findings.key_findings(staged(spark, sf)), 6)


# ---- chart datasets ---------------------------------------------------------------------


@query
def chart_om_trend(spark, sf):
    return rounded(charts.om_trend(clean(spark, sf)), 8, "cagr_percent")


@query
def rr_waterfall(spark, sf):
    return charts.requirement_waterfall(modelled(spark, sf))


@query
def chart_revenue_gap(spark, sf):
    return rounded(charts.revenue_gap(modelled(spark, sf, [BASE]), BASE), 9)


@query
def chart_bill_impact(spark, sf):
    return rounded(charts.bill_impact(bills.bill_impact(clean(spark, sf, [BASE]), BASE)), 7)
