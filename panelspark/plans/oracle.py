"""The same queries as SQL for DuckDB, over the same tables.

`WITH` chains share the text that binds the tables and builds the panel.
"""

from __future__ import annotations

from panelspark.config import BILL_SCENARIOS, CATEGORIES, SECTORS, WACC_RANGE
from panelspark.plans.bindings import BASE_YEAR, YEARS

ALL = [*SECTORS, "total"]
SALES_MEASURES = [f"{p}" for s in ALL for p in
                  (f"revenue_{s}_k", f"sales_mwh_{s}", f"customers_{s}")]
REVENUE = [f"revenue_{s}_k" for s in ALL]
MWH = [f"sales_mwh_{s}" for s in ALL]
CUSTOMERS = [f"customers_{s}" for s in ALL]
OM = [f"om_{c}" for c in CATEGORIES]
RATIOS = [
    "om_per_customer",
    "grc_om_per_customer",
    "om_per_mwh",
    "rate_base_per_customer",
    "revenue_per_customer",
]


def d(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def cents(expr: str) -> str:
    return f"COALESCE(CAST(SUM(CAST(round({expr} * 100) AS BIGINT)) AS DOUBLE) / 100.0, 0.0)"


def div(a: str, b: str) -> str:
    return f"CASE WHEN {b} <> 0 THEN {a} / {b} END"


def rnd(digits: int, *columns: str) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def plain(*columns: str) -> str:
    return ", ".join(columns)


ACCOUNT = """CASE WHEN l_linenumber = 7 THEN 'n/a'
    WHEN l_linenumber % 2 = 0
      THEN CAST(500 + l_partkey % 440 AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR)
    ELSE CAST(500 + l_partkey % 440 AS VARCHAR) END"""

SECTOR = """CASE o_orderpriority WHEN '1-URGENT' THEN 'residential' WHEN '2-HIGH' THEN 'residential'
    WHEN '3-MEDIUM' THEN 'commercial' WHEN '4-NOT SPECIFIED' THEN 'industrial' END"""


def _landed_measures() -> str:
    out = []
    for s in ALL:
        hit = "TRUE" if s == "total" else f"sector IS NOT DISTINCT FROM '{s}'"
        out += [
            f"{cents(f'CASE WHEN {hit} THEN o_totalprice END')} / 1000.0 AS revenue_{s}_k",
            f"SUM(CASE WHEN {hit} THEN mwh ELSE 0.0::DOUBLE END) AS sales_mwh_{s}",
            f"COUNT(*) FILTER ({hit}) AS customers_{s}",
        ]
    return ",\n    ".join(out)


SOURCES = f"""
expense_rows AS (
  SELECT l_suppkey AS utility_id_ferc1, CAST(year(l_shipdate) AS INTEGER) AS report_year,
    {ACCOUNT} AS ferc_account, l_extendedprice AS dollar_value,
    CASE WHEN l_linestatus = 'F' THEN 'reported_value' ELSE 'calculated_value' END
      AS row_type_xbrl
  FROM lineitem),
income_rows AS (
  SELECT o_custkey AS utility_id_ferc1, CAST(year(o_orderdate) AS INTEGER) AS report_year,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'gas' ELSE 'electric' END AS utility_type,
    CASE WHEN o_orderstatus = 'P' THEN '401' ELSE '400' END AS ferc_account,
    o_orderpriority AS income_type, o_totalprice AS dollar_value
  FROM orders),
plant_rows AS (
  SELECT utility_id_ferc1, report_year, utility_type, asset, {cents('amount')} AS ending_balance
  FROM (SELECT o_custkey AS utility_id_ferc1,
      CAST(year(o_orderdate) AS INTEGER) AS report_year,
      CASE WHEN o_orderpriority = '5-LOW' THEN 'gas' ELSE 'electric' END AS utility_type,
      CASE WHEN o_orderstatus = 'F' THEN 'acc' ELSE 'ups' END AS asset,
      o_totalprice AS amount FROM orders)
  GROUP BY ALL),
sales_rows AS (
  SELECT report_year, 14000 + c_custkey AS utility_id_eia, c_name AS utility_name,
    CASE WHEN r_name = 'AFRICA' THEN 'NV' ELSE 'CA' END AS state,
    o_orderstatus AS ownership, row_ordinal, {', '.join(SALES_MEASURES)}
  FROM (SELECT o_custkey, report_year, o_orderstatus, MIN(o_orderkey) AS row_ordinal,
    {_landed_measures()}
    FROM (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS report_year,
      CAST(day(o_orderdate) AS DOUBLE) AS mwh, {SECTOR} AS sector FROM orders)
    GROUP BY o_custkey, report_year, o_orderstatus) o
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
id_map AS (
  SELECT s_suppkey AS utility_id_ferc1, 14000 + s_suppkey AS utility_id_eia,
    s_name AS utility_name FROM supplier),
baselines AS (
  SELECT s_suppkey AS utility_id_ferc1, 1997 AS start_year FROM supplier
  WHERE s_acctbal < 1000)"""

CATEGORY = """CASE WHEN account_no BETWEEN 500 AND 557 THEN 'production'
    WHEN account_no BETWEEN 560 AND 574 THEN 'transmission'
    WHEN account_no BETWEEN 580 AND 598 THEN 'distribution'
    WHEN account_no BETWEEN 901 AND 910 THEN 'customer_service'
    WHEN account_no BETWEEN 920 AND 935 THEN 'admin_general'
    ELSE 'other' END"""


def rolled_up(source: str) -> str:
    sums = ", ".join(
        f"CAST(COALESCE(SUM({m}), 0) AS {'BIGINT' if m in CUSTOMERS else 'DOUBLE'}) AS {m}"
        for m in SALES_MEASURES
    )
    firsts = ", ".join(
        f"arg_min({c}, row_ordinal) FILTER ({c} IS NOT NULL) AS {c}"
        for c in ["utility_name", "state", "ownership"]
    )
    return f"""SELECT utility_id_eia, report_year, {firsts}, {sums}
  FROM {source} GROUP BY utility_id_eia, report_year"""


PANEL = f"""{SOURCES},
categorized AS (
  SELECT *, {CATEGORY} AS category FROM (
    SELECT *, CAST(trunc(TRY_CAST(ferc_account AS DOUBLE)) AS INTEGER) AS account_no
    FROM expense_rows)),
expenses_wide AS (
  SELECT *, om_production + om_transmission + om_distribution + om_customer_service
    + om_admin_general + om_other AS om_total
  FROM (SELECT utility_id_ferc1, report_year,
    {', '.join(f"{cents(f'''CASE WHEN category = '{c}' THEN dollar_value END''')} AS om_{c}"
               for c in CATEGORIES)}
    FROM categorized WHERE row_type_xbrl = 'reported_value'
    GROUP BY utility_id_ferc1, report_year)),
plant_wide AS (
  SELECT utility_id_ferc1, report_year, utility_plant_in_service,
    accumulated_provision_for_depreciation
  FROM (SELECT utility_id_ferc1, report_year, ending_balance AS utility_plant_in_service
    FROM plant_rows WHERE utility_type = 'electric' AND asset = 'ups') u
  FULL JOIN (SELECT utility_id_ferc1, report_year,
      ending_balance AS accumulated_provision_for_depreciation
    FROM plant_rows WHERE utility_type = 'electric' AND asset = 'acc') a
  USING (utility_id_ferc1, report_year)),
plant_base AS (
  SELECT *, utility_plant_in_service - accumulated_provision_for_depreciation AS rate_base
  FROM plant_wide),
revenues AS (
  SELECT utility_id_ferc1, report_year, {cents('dollar_value')} AS operating_revenues_ferc
  FROM income_rows WHERE utility_type = 'electric' AND ferc_account = '400'
  GROUP BY utility_id_ferc1, report_year),
sales_wide AS (
  {rolled_up("(SELECT * FROM sales_rows WHERE state = 'CA')")}),
ferc AS (
  SELECT f.*, r.operating_revenues_ferc, i.utility_id_eia, i.utility_name AS map_name
  FROM (SELECT utility_id_ferc1, report_year, {', '.join(OM)}, om_total, rate_base
    FROM expenses_wide FULL JOIN plant_base USING (utility_id_ferc1, report_year)) f
  LEFT JOIN revenues r ON r.utility_id_ferc1 = f.utility_id_ferc1
    AND r.report_year = f.report_year
  LEFT JOIN id_map i ON i.utility_id_ferc1 = f.utility_id_ferc1),
joined AS (
  SELECT utility_id_eia, report_year, utility_id_ferc1, {', '.join(OM)}, om_total, rate_base,
    operating_revenues_ferc, state, ownership, {', '.join(SALES_MEASURES)},
    COALESCE(map_name, s.utility_name) AS utility_name
  FROM ferc FULL JOIN sales_wide s USING (utility_id_eia, report_year)),
ragged AS (
  SELECT utility_id_ferc1, utility_id_eia, utility_name, report_year, {', '.join(OM)}, om_total,
    grc_om, rate_base, operating_revenues_ferc, {', '.join(MWH)}, {', '.join(CUSTOMERS)},
    {', '.join(REVENUE)},
    {div('om_total', 'customers_total')} AS om_per_customer,
    {div('grc_om', 'customers_total')} AS grc_om_per_customer,
    {div('om_total', 'sales_mwh_total')} AS om_per_mwh,
    {div('rate_base', 'customers_total')} AS rate_base_per_customer,
    {div('(revenue_total_k * 1000)', 'customers_total')} AS revenue_per_customer
  FROM (SELECT *, om_distribution + om_customer_service + om_admin_general * {d(0.7)} AS grc_om
    FROM joined)),
panel AS (
  SELECT * FROM ragged)"""

# Sums of a few landed doubles depend on their order in the last digit: rounded in both engines.
ROUNDED = [*REVENUE, "revenue_per_customer"]
EXACT = [*OM, "om_total", "grc_om", "rate_base", "operating_revenues_ferc", *MWH, *CUSTOMERS,
         *RATIOS[:-1]]
PANEL_KEYS = ["utility_id_ferc1", "utility_id_eia", "utility_name", "report_year"]
KEYS = "utility_id_ferc1, utility_name, report_year"


def with_panel(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([PANEL.strip(), *ctes]) + "\n" + select


def with_sources(select: str) -> str:
    return "WITH " + SOURCES.strip() + "\n" + select


# ---- models -----------------------------------------------------------------------------


def rr(om: str, other: str | None, rb: str, wacc: str = d(0.075)) -> dict[str, str]:
    """Requirement parts as SQL; NULL when om or rb is NULL."""
    expense = f"({om} - COALESCE({other}, 0.0))" if other else f"({om} - 0.0)"
    dep = f"(CASE WHEN {rb} <= 0 THEN 0.0 ELSE {rb} * {d(0.035)} END)"
    ret = f"(CASE WHEN {rb} <= 0 THEN 0.0 ELSE {rb} * {wacc} END)"
    pre = f"({expense} + {dep} + {ret})"
    tax = f"({pre} * {d(0.27)} / {d(1.0 - 0.27)})"
    parts = {
        "om_expense": expense,
        "om_passthrough": f"COALESCE({other}, 0.0)" if other else "0.0",
        "depreciation": dep,
        "return_on_rate_base": ret,
        "pre_tax_total": pre,
        "taxes": tax,
        "revenue_requirement": f"({pre} + {tax})",
    }
    known = f"{om} IS NOT NULL AND {rb} IS NOT NULL"
    return {k: f"(CASE WHEN {known} THEN CAST({v} AS DOUBLE) END)" for k, v in parts.items()}


def grc(dist="om_distribution", cust="om_customer_service", ag="om_admin_general",
        rb="rate_base") -> dict[str, str]:
    om = f"({dist} + {cust} + {ag} * {d(0.7)})"
    dep = f"(CASE WHEN {rb} <= 0 THEN 0.0 ELSE {rb} * {d(0.035)} END)"
    ret = f"(CASE WHEN {rb} <= 0 THEN 0.0 ELSE {rb} * {d(0.075)} END)"
    pre = f"({om} + {dep} + {ret})"
    tax = f"({pre} * {d(0.15)})"
    parts = {
        "grc_om": om,
        "om_ag_allocated": f"{ag} * {d(0.7)}",
        "grc_depreciation": dep,
        "grc_return_on_rate_base": ret,
        "grc_taxes": tax,
        "grc_revenue_requirement": f"({pre} + {tax})",
    }
    known = " AND ".join(f"{c} IS NOT NULL" for c in [dist, cust, ag, rb])
    return {k: f"(CASE WHEN {known} THEN CAST({v} AS DOUBLE) END)" for k, v in parts.items()}


TOTAL = rr("om_total", "om_other", "rate_base")
RR_SHOWN = ["depreciation", "return_on_rate_base", "taxes", "revenue_requirement"]
MODELLED = f"""
gap AS (
  SELECT *, revenue_gap / NULLIF(actual_revenue, 0) * 100.0 AS revenue_gap_pct
  FROM (SELECT *, revenue_requirement - actual_revenue AS revenue_gap
    FROM (SELECT *, {', '.join(f'{TOTAL[c]} AS {c}' for c in RR_SHOWN)},
      operating_revenues_ferc AS actual_revenue FROM panel))),
modelled AS (
  SELECT * EXCLUDE (grc_om), {', '.join(f'{v} AS {k}' for k, v in grc().items())} FROM gap)
""".strip()
GAP_DOUBLES = [*RR_SHOWN, "actual_revenue", "revenue_gap", "revenue_gap_pct"]
GRC_DOUBLES = ["om_ag_allocated", "grc_depreciation", "grc_return_on_rate_base", "grc_taxes",
               "grc_revenue_requirement"]


def panel_columns(*extra: str) -> str:
    return ", ".join([*PANEL_KEYS, *EXACT, *extra, rnd(6, *ROUNDED)])


def _breakdown(other: str | None, flag: str) -> str:
    parts = rr("om_total", other, "rate_base")
    shown = ", ".join(f"{v} AS {k}" for k, v in parts.items())
    return with_panel(f"""SELECT {KEYS}, {shown}, {d(0.035)} AS depreciation_rate,
  {d(0.075)} AS wacc, {d(0.27)} AS tax_rate, {flag} AS exclude_passthrough FROM panel""")


def _forecast() -> str:
    up, grow = d(1.0 + 0.03), d(1.0 + 0.04)
    then = rr(f"(om_total * {up})", "om_other", f"(rate_base * {grow})")["revenue_requirement"]
    return with_panel(f"""SELECT utility_id_ferc1, utility_name, {BASE_YEAR} AS base_year,
  {BASE_YEAR + 1} AS forecast_year, {plain('base_om', 'forecast_om', 'base_rate_base',
  'forecast_rate_base', 'base_year_rr', 'forecast_year_rr')},
  forecast_year_rr - base_year_rr AS rr_change,
  {div('(forecast_year_rr - base_year_rr)', 'base_year_rr')} * 100.0 AS rr_change_pct,
  {d(0.03)} AS om_escalation_rate, {d(0.04)} AS rate_base_growth_rate, {d(0.075)} AS wacc
FROM (SELECT *, om_total AS base_om, om_total * {up} AS forecast_om, rate_base AS base_rate_base,
    rate_base * {grow} AS forecast_rate_base, {TOTAL['revenue_requirement']} AS base_year_rr,
    {then} AS forecast_year_rr
  FROM panel WHERE report_year = {BASE_YEAR} AND om_total IS NOT NULL AND rate_base IS NOT NULL)
""".replace("CASE WHEN base_year_rr <> 0 THEN (forecast_year_rr - base_year_rr) / base_year_rr END"
            " * 100.0",
            "CASE WHEN base_year_rr <> 0 THEN (forecast_year_rr - base_year_rr) / base_year_rr"
            " * 100.0 END"))


def _forecast_grc() -> str:
    up, grow = d(1.0 + 0.03), d(1.0 + 0.04)
    now = grc()
    then = grc(*[f"({c} * {up})" for c in
                 ["om_distribution", "om_customer_service", "om_admin_general"]],
               f"(rate_base * {grow})")["grc_revenue_requirement"]
    return with_panel(f"""SELECT utility_id_ferc1, utility_name, {BASE_YEAR} AS base_year,
  {BASE_YEAR + 1} AS forecast_year, {plain('base_om_grc', 'forecast_om_grc', 'base_rate_base',
  'forecast_rate_base', 'base_year_rr_grc', 'forecast_year_rr_grc')},
  forecast_year_rr_grc - base_year_rr_grc AS rr_change,
  (forecast_year_rr_grc - base_year_rr_grc) / NULLIF(base_year_rr_grc, 0) * 100.0
    AS rr_change_pct,
  {d(0.03)} AS om_escalation_rate, {d(0.04)} AS rate_base_growth_rate, {d(0.075)} AS wacc
FROM (SELECT *, {now['grc_om']} AS base_om_grc, {now['grc_om']} * {up} AS forecast_om_grc,
    rate_base AS base_rate_base, rate_base * {grow} AS forecast_rate_base,
    {now['grc_revenue_requirement']} AS base_year_rr_grc, {then} AS forecast_year_rr_grc
  FROM panel WHERE report_year = {BASE_YEAR} AND rate_base IS NOT NULL
    AND om_distribution IS NOT NULL)""")


def _wacc_sensitivity() -> str:
    values = ", ".join(f"({d(w)})" for w in WACC_RANGE)
    now = rr("om_total", None, "rate_base", "wacc")["revenue_requirement"]
    base = rr("om_total", None, "rate_base", d(WACC_RANGE[0]))["revenue_requirement"]
    return with_panel(f"""SELECT {KEYS}, wacc, wacc * 100.0 AS wacc_pct,
  now AS revenue_requirement, now - base AS change_from_base,
  CASE WHEN base = 0 THEN 0.0 ELSE (now - base) / base * 100.0 END AS change_pct
FROM (SELECT {KEYS}, wacc AS wacc, {now} AS now, {base} AS base
  FROM panel, (VALUES {values}) w(wacc)
  WHERE om_total IS NOT NULL AND rate_base IS NOT NULL)""")


BILL_ROWS = f"""
bill_rows AS (
  SELECT *, CASE WHEN revenue_total_k = 0 THEN 0.0
    ELSE {div('revenue_residential_k', 'revenue_total_k')} END AS residential_share
  FROM panel WHERE report_year = {BASE_YEAR} AND om_total IS NOT NULL
    AND rate_base IS NOT NULL AND sales_mwh_residential > 0)""".strip()


def bill(requirement: str, share="residential_share", mwh="sales_mwh_residential") -> str:
    return (f"(CASE WHEN {share} BETWEEN 0 AND 1 THEN "
            f"({requirement} * {share}) / ({mwh} * 1000.0) * 500.0 END)")


def _allocated_bills() -> str:
    need = TOTAL["revenue_requirement"]
    return with_panel(f"""SELECT {KEYS}, round({need} * residential_share, 6) AS residential_rr,
  round(sales_mwh_residential * 1000.0, 6) AS residential_sales_kwh,
  round(({need} * residential_share) / (sales_mwh_residential * 1000.0), 6) AS avg_rate_per_kwh,
  round({bill(need)}, 6) AS monthly_bill, {d(500.0)} AS avg_monthly_kwh FROM bill_rows""",
                      BILL_ROWS)


def _bill_impact_cte() -> str:
    then = rr(f"(om_total * {d(1.03)})", "om_other", f"(rate_base * {d(1.04)})")
    return f"""
bills AS (
  SELECT *, proposed_monthly_bill - current_monthly_bill AS monthly_change_dollars
  FROM (SELECT *, current_monthly_bill * factor AS proposed_monthly_bill,
      current_rate_per_kwh * factor AS proposed_rate_per_kwh
    FROM (SELECT *, current_rate_per_kwh * 500.0 AS current_monthly_bill,
        proposed_rr / current_rr AS factor
      FROM (SELECT utility_id_ferc1, utility_name, residential_share,
          {TOTAL['revenue_requirement']} AS current_rr,
          {then['revenue_requirement']} AS proposed_rr,
          revenue_residential_k * 1000.0 / (sales_mwh_residential * 1000.0)
            AS current_rate_per_kwh
        FROM bill_rows) WHERE current_rr <> 0)))""".strip()


CHANGE_PCT = """CASE WHEN current_monthly_bill = 0 THEN 0.0
    ELSE monthly_change_dollars / current_monthly_bill * 100.0 END"""


def _bill_impact() -> str:
    return with_panel(f"""SELECT utility_id_ferc1, utility_name, {BASE_YEAR} AS base_year,
  {rnd(9, 'residential_share')}, round(residential_share * 100.0, 9) AS residential_share_pct,
  current_rr, proposed_rr, {rnd(9, 'current_rate_per_kwh', 'proposed_rate_per_kwh')},
  {rnd(7, 'current_monthly_bill', 'proposed_monthly_bill', 'monthly_change_dollars')},
  round({CHANGE_PCT}, 7) AS monthly_change_pct,
  round(monthly_change_dollars * 12.0, 7) AS annual_change_dollars,
  {d(500.0)} AS avg_monthly_kwh, {d(0.03)} AS om_escalation, {d(0.04)} AS rate_base_growth
FROM bills""", BILL_ROWS, _bill_impact_cte())


def _bill_sensitivity() -> str:
    values = ", ".join(f"('{n}', {d(e)}, {d(g)}, {d(w)})" for n, e, g, w in BILL_SCENARIOS)
    now = rr("(om_total * (1.0::DOUBLE + e))", None, "(rate_base * (1.0::DOUBLE + g))", "w")
    base = rr(f"(om_total * (1.0::DOUBLE + {d(0.03)}))", None,
              f"(rate_base * (1.0::DOUBLE + {d(0.04)}))")
    return with_panel(f"""SELECT utility_id_ferc1, utility_name, scenario,
  e AS om_escalation, g AS rate_base_growth, w AS wacc, need AS revenue_requirement, round(bill, 6) AS monthly_bill,
  round(bill - base_bill, 6) AS change_from_base,
  round(CASE WHEN base_bill = 0 THEN 0.0 ELSE (bill - base_bill) / base_bill * 100.0 END, 6)
    AS change_pct
FROM (SELECT *, {bill('need')} AS bill, {bill('base_need')} AS base_bill
  FROM (SELECT *, {now['revenue_requirement']} AS need,
      {base['revenue_requirement']} AS base_need
    FROM bill_rows, (VALUES {values}) s(scenario, e, g, w)))""", BILL_ROWS)


# ---- statistics -------------------------------------------------------------------------


def t_pvalue(t: str, dof: str) -> str:
    """Two-sided Student p-value for whole degrees of freedom, by the finite trigonometric series
    (one for odd, one for even degrees)."""
    theta = f"atan({t} / sqrt({dof}))"
    odd = f"""(2 / pi()) * ({theta} + sin({theta}) * COALESCE(list_sum(list_transform(
      range(0, CAST(({dof} - 1) // 2 AS BIGINT)), lambda k: exp(k * ln(4.0::DOUBLE)
        + 2 * lgamma(k + 1.0::DOUBLE) - lgamma(2.0::DOUBLE * k + 2.0))
        * pow(cos({theta}), 2 * k + 1))), 0.0))"""
    even = f"""sin({theta}) * COALESCE(list_sum(list_transform(
      range(0, CAST({dof} // 2 AS BIGINT)), lambda k: exp(lgamma(2.0::DOUBLE * k + 1.0)
        - 2 * lgamma(k + 1.0::DOUBLE) - k * ln(4.0::DOUBLE)) * pow(cos({theta}), 2 * k))), 0.0)"""
    return f"(1.0 - CASE WHEN {dof} % 2 = 1 THEN {odd} ELSE {even} END)"


def cagr(first: str, last: str, n: str) -> str:
    """NULL for a non-positive start, no period, or a fall below zero (no real root)."""
    return (f"(CASE WHEN {first} > 0 AND {n} > 0 AND ({last} >= 0 OR {n} = 1) THEN "
            f"(pow({last} / {first}, 1.0::DOUBLE / {n}) - 1.0) * 100.0 END)")


def _trend_cte(metric: str) -> str:
    return f"""
trend AS (
  SELECT utility_id_ferc1 AS utility_id, arg_min(utility_name, report_year) AS utility_name,
    COUNT(y) AS n, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept,
    CASE WHEN var_pop(y) = 0 THEN 0.0 ELSE regr_r2(y, x) END AS r_squared, avg(y) AS mean,
    stddev_samp(y) AS std, arg_min(y, x) FILTER (y IS NOT NULL) AS first_y,
    arg_max(y, x) FILTER (y IS NOT NULL) AS last_y,
    CAST(MAX(report_year) FILTER (y IS NOT NULL) - MIN(report_year) FILTER (y IS NOT NULL)
      AS INTEGER) AS n_years
  FROM (SELECT *, {metric} AS y, CAST(report_year AS DOUBLE) AS x FROM panel)
  WHERE utility_id_ferc1 IS NOT NULL GROUP BY utility_id_ferc1)""".strip()


def enough(expr: str) -> str:
    return f"CASE WHEN n >= 2 THEN {expr} END"


STATUS = "CASE WHEN n >= 2 THEN 'ok' ELSE 'insufficient data' END AS status"


def _trend() -> str:
    return with_panel(f"""SELECT utility_id, utility_name, 'om_total' AS metric,
  round({enough('slope')}, 4) AS slope, round({enough('intercept')}, 0) AS intercept,
  round({enough('r_squared')}, 6) AS r_squared,
  round({enough(cagr('first_y', 'last_y', 'n_years'))}, 6) AS cagr_percent,
  round({enough('mean')}, 5) AS mean, round({enough('std')}, 4) AS std,
  round({enough('CASE WHEN mean <> 0 THEN std / mean * 100.0 END')}, 6)
    AS coefficient_of_variation,
  {enough('n_years')} AS n_years, {STATUS} FROM trend""", _trend_cte("om_total"))


def _trend_pvalue() -> str:
    p = t_pvalue("t", "dof")
    return with_panel(f"""SELECT utility_id, round(r_squared, 6) AS r_squared,
  round(CASE WHEN n < 2 THEN NULL WHEN n = 2 THEN CASE WHEN slope = 0 THEN 1.0 ELSE 0.0 END
    WHEN r_squared >= 1 THEN 0.0 ELSE {p} END, 6) AS p_value, {STATUS}
FROM (SELECT * REPLACE ({enough('r_squared')} AS r_squared), n - 2 AS dof,
  CASE WHEN n > 2 AND r_squared < 1 THEN sqrt(r_squared * (n - 2) / (1 - r_squared)) END AS t
  FROM trend)""", _trend_cte("rate_base"))


def _summary() -> str:
    one = []
    for m in ["om_total", "om_per_customer", "om_per_mwh", "rate_base"]:
        known = f"FILTER ({m} IS NOT NULL)"
        growth = cagr(f"arg_min({m}, report_year) {known}", f"arg_max({m}, report_year) {known}",
                      "(MAX(report_year) - MIN(report_year))")
        one.append(f"""SELECT utility_id_ferc1,
  arg_min(utility_name, report_year) AS utility_name, '{m}' AS metric, round(avg({m}), 5) AS mean,
  round(stddev_samp({m}), 4) AS std, MIN({m}) AS min, MAX({m}) AS max,
  round({growth}, 4) AS cagr_percent,
  CAST(MAX(report_year) - MIN(report_year) AS INTEGER) AS n_years
FROM panel WHERE utility_id_ferc1 IS NOT NULL GROUP BY utility_id_ferc1 HAVING COUNT({m}) >= 2""")
    return with_panel("\nUNION ALL\n".join(one))


YOY_CELLS = """
yoy AS (
  SELECT utility_id_ferc1, utility_name, report_year,
    CASE WHEN utility_id_ferc1 IS NOT NULL THEN
      (v / NULLIF(lag(v) OVER (PARTITION BY utility_id_ferc1 ORDER BY report_year), 0) - 1.0)
      * 100.0 END AS om_yoy_pct
  FROM (SELECT *, last_value({metric} IGNORE NULLS) OVER (PARTITION BY utility_id_ferc1
      ORDER BY report_year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v
    FROM panel))""".strip()

DRIVERS = ["customers_total", "sales_mwh_total", "rate_base"]


def _ols_ctes(source: str, group: str = "") -> list[str]:
    """Centred moments, inverse covariance by cofactors, coefficients and their errors."""
    names = ["om_total", *DRIVERS]
    means = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m{i}" for i, c in enumerate(names))
    covs = ", ".join(
        f"covar_samp(CAST({names[i]} AS DOUBLE), CAST({names[j]} AS DOUBLE)) AS s{i}{j}"
        for i in range(4) for j in range(i, 4))
    known = " AND ".join(f"{c} IS NOT NULL" for c in names)
    by = f"GROUP BY {group}" if group else ""
    lead = f"{group}, " if group else ""
    return [f"""
ols_m AS (SELECT {lead}COUNT(*) AS n, {means}, {covs} FROM {source} WHERE {known} {by})""".strip(),
            """
ols_det AS (
  SELECT *, s11 * (s22 * s33 - s23 * s23) - s12 * (s12 * s33 - s23 * s13)
    + s13 * (s12 * s23 - s22 * s13) AS det FROM ols_m),
ols_inv AS (
  SELECT *, (s22 * s33 - s23 * s23) / det AS i11, (s13 * s23 - s12 * s33) / det AS i12,
    (s12 * s23 - s13 * s22) / det AS i13, (s11 * s33 - s13 * s13) / det AS i22,
    (s12 * s13 - s11 * s23) / det AS i23, (s11 * s22 - s12 * s12) / det AS i33
  FROM ols_det),
ols_coef AS (
  SELECT *, i11 * s01 + i12 * s02 + i13 * s03 AS b1, i12 * s01 + i22 * s02 + i23 * s03 AS b2,
    i13 * s01 + i23 * s02 + i33 * s03 AS b3 FROM ols_inv),
ols_fit AS (
  SELECT *, m0 - b1 * m1 - b2 * m2 - b3 * m3 AS b0, s00 * (n - 1) AS sst,
    (n - 1) * (s00 - b1 * s01 - b2 * s02 - b3 * s03) AS ssr FROM ols_coef),
ols_err AS (
  SELECT *, ssr / NULLIF(n - 4, 0) AS sigma2, 1 - ssr / sst AS r_squared,
    1 - (ssr / sst) * (n - 1) / NULLIF(n - 4, 0) AS adj_r_squared,
    m1 * m1 * i11 + m2 * m2 * i22 + m3 * m3 * i33
      + 2 * (m1 * m2 * i12 + m1 * m3 * i13 + m2 * m3 * i23) AS mim FROM ols_fit)""".strip(),
            f"""
ols_terms AS (
  SELECT {lead}n AS n_obs, n - 4 AS dof, r_squared, adj_r_squared, 'const' AS term, b0 AS coef,
    sqrt(sigma2 * (1.0 / n + mim / (n - 1))) AS std_err FROM ols_err
  UNION ALL SELECT {lead}n, n - 4, r_squared, adj_r_squared, 'customers_total', b1,
    sqrt(sigma2 * i11 / (n - 1)) FROM ols_err
  UNION ALL SELECT {lead}n, n - 4, r_squared, adj_r_squared, 'sales_mwh_total', b2,
    sqrt(sigma2 * i22 / (n - 1)) FROM ols_err
  UNION ALL SELECT {lead}n, n - 4, r_squared, adj_r_squared, 'rate_base', b3,
    sqrt(sigma2 * i33 / (n - 1)) FROM ols_err)""".strip()]


# Two-sided 5 % point of Student's t for each number of degrees of freedom, by bisection.
CRITICAL_CTE = f"""
critical AS (
  WITH RECURSIVE halved AS (
    SELECT DISTINCT n - 4 AS of_dof, 0.0::DOUBLE AS lo, 1000.0::DOUBLE AS hi, 0 AS step
    FROM ols_m WHERE n > 4
    UNION ALL SELECT of_dof, CASE WHEN p > 0.05 THEN mid ELSE lo END,
      CASE WHEN p > 0.05 THEN hi ELSE mid END, step + 1
    FROM (SELECT *, {t_pvalue('mid', 'of_dof')} AS p
      FROM (SELECT *, (lo + hi) / 2 AS mid FROM halved WHERE step < 80)))
  SELECT of_dof, (lo + hi) / 2 AS t_critical FROM halved WHERE step = 80)""".strip()


def _ols_select(group: str = "") -> str:
    lead = f"{group}, " if group else ""
    return f"""SELECT {lead}term, round(coef, 3) AS coef, round(std_err, 3) AS std_err,
  round(coef / std_err, 6) AS t_value,
  round({t_pvalue('abs(coef / std_err)', 'dof')}, 6) AS p_value,
  round(coef - std_err * t_critical, 3) AS ci_low,
  round(coef + std_err * t_critical, 3) AS ci_high, n_obs,
  round(r_squared, 6) AS r_squared, round(adj_r_squared, 6) AS adj_r_squared, 'ok' AS status
FROM ols_terms LEFT JOIN critical ON dof = of_dof WHERE n_obs >= 4
UNION ALL SELECT {lead}NULL, NULL, NULL, NULL, NULL, NULL, NULL, n, NULL, NULL, 'insufficient data'
FROM ols_m WHERE n < 4"""


def _condition_number() -> str:
    """From the exact Gram matrix in whole numbers (amounts in cents), as squaring the design in
    floating point would lose the small singular values. The inverse is exact up to one division.
    Of each matrix the largest eigenvalue is read off its projection, got by repeated squaring."""
    names = ["1", "customers_total", "sales_mwh_total", "round(rate_base * 100)"]
    unit = ["1.0", "1.0", "1.0", "100.0"]
    at = range(4)
    gram = ", ".join(
        f"CAST(SUM(CAST({names[i]} AS HUGEINT) * CAST({names[j]} AS HUGEINT)) AS HUGEINT)"
        f" AS g{i}{j}" for i in at for j in at)

    def minor(rows, columns) -> str:
        if len(rows) == 1:
            return f"g{rows[0]}{columns[0]}"
        return "(" + " ".join(
            f"{'-' if k % 2 else '+'} g{rows[0]}{c} * {minor(rows[1:], [d for d in columns if d != c])}"
            for k, c in enumerate(columns)) + ")"

    def cofactor(i: int, j: int) -> str:
        sign = "-" if (i + j) % 2 else ""
        rest = minor([r for r in at if r != i], [c for c in at if c != j])
        return f"CAST({sign}{rest} AS DOUBLE) * {unit[i]} * {unit[j]} / CAST(det AS DOUBLE)"

    plain = ", ".join(f"CAST(g{i}{j} AS DOUBLE) / {unit[i]} / {unit[j]}" for i in at for j in at)
    inverse = ", ".join(cofactor(i, j) for i in at for j in at)
    trace = "(m[1] + m[6] + m[11] + m[16])"
    square = ", ".join(
        "(" + " + ".join(f"m[{4 * i + k + 1}] * m[{4 * k + j + 1}]" for k in at)
        + f") / ({trace} * {trace})" for i in at for j in at)
    quotient = " + ".join(f"a[{4 * i + j + 1}] * m[{4 * j + i + 1}]" for i in at for j in at)
    return with_panel(
        "SELECT 'condition_number' AS stat, CASE WHEN max(n) >= 4 THEN"
        " round(sqrt(max(top) FILTER (kind = 'gram')"
        " * max(top) FILTER (kind = 'inverse')), 0) END AS value FROM tops, (SELECT n FROM gram)",
        f"""
gram AS (SELECT *, {minor(list(at), list(at))} AS det FROM (SELECT COUNT(*) AS n, {gram} FROM panel
  WHERE customers_total IS NOT NULL AND sales_mwh_total IS NOT NULL AND rate_base IS NOT NULL)),
matrices AS (SELECT 'gram' AS kind, [{plain}] AS a FROM gram
  UNION ALL SELECT 'inverse', [{inverse}] FROM gram),
tops AS (
  WITH RECURSIVE powers AS (SELECT kind, a, a AS m, 0 AS step FROM matrices
    UNION ALL SELECT kind, a, [{square}], step + 1 FROM powers WHERE step < 40)
  SELECT kind, ({quotient}) / {trace} AS top FROM powers WHERE step = 40)""".strip())


VIF_CTE = """
vif_r AS (
  SELECT corr(customers_total, sales_mwh_total) AS ab, corr(customers_total, rate_base) AS ac,
    corr(sales_mwh_total, rate_base) AS bc FROM panel
  WHERE customers_total IS NOT NULL AND sales_mwh_total IS NOT NULL AND rate_base IS NOT NULL),
vif AS (
  SELECT unnest(['customers_total', 'sales_mwh_total', 'rate_base']) AS variable,
    unnest([(1 - bc * bc) / det, (1 - ac * ac) / det, (1 - ab * ab) / det]) AS vif
  FROM (SELECT *, 1 + 2 * ab * ac * bc - ab * ab - ac * ac - bc * bc AS det FROM vif_r))""".strip()



def _vif_swept(xs: list[str], digits: int, group: str = "") -> str:
    """Factors as the diagonal of the inverse correlation matrix, swept pivot by pivot."""
    k = range(len(xs))
    lead = f"{group}, " if group else ""
    cells = [(i, j) for i in k for j in k]
    values = ", ".join(
        f"CAST(1 AS DOUBLE) AS m{i}_{j}" if i == j else f"corr({xs[i]}, {xs[j]}) AS m{i}_{j}"
        for i, j in cells)
    ctes = [f"swept_0 AS (SELECT {lead}COUNT(*) AS n, {values} FROM panel WHERE "
            + " AND ".join(f"{x} IS NOT NULL" for x in xs) + (f" GROUP BY {group})" if group else ")")]
    for p in k:
        def swept(i, j):
            pivot = f"m{p}_{p}"
            if i == p:
                return f"1 / {pivot}" if j == p else f"m{p}_{j} / {pivot}"
            if j == p:
                return f"-m{i}_{p} / {pivot}"
            return f"m{i}_{j} - m{i}_{p} * m{p}_{j} / {pivot}"

        columns = ", ".join(f"{swept(i, j)} AS m{i}_{j}" for i, j in cells)
        ctes.append(f"swept_{p + 1} AS (SELECT {lead}n, {columns} FROM swept_{p})")
    names = ", ".join(f"'{x}'" for x in xs)
    found = ", ".join(f"CASE WHEN n > {len(xs)} THEN round(m{i}_{i}, {digits}) END" for i in k)
    return with_panel(f"SELECT {lead}unnest([{names}]) AS variable, unnest([{found}]) AS vif"
                      f" FROM swept_{len(xs)}", *ctes)


KEPT = """
kept AS (
  SELECT panel.* FROM panel LEFT JOIN baselines USING (utility_id_ferc1)
  WHERE start_year IS NULL OR report_year >= start_year)""".strip()

OUTLIERS = """
outliers AS (
  SELECT * FROM (SELECT panel.*, CASE WHEN s.std = 0 THEN 0.0
      ELSE (om_per_customer - s.mean) / s.std END AS z_score
    FROM panel, (SELECT avg(om_per_customer) AS mean, stddev_samp(om_per_customer) AS std
      FROM panel) s)
  WHERE abs(z_score) > 2.0)""".strip()


def _diagnostics() -> str:
    resid = """
resid AS (
  SELECT om_total - (b0 + b1 * customers_total + b2 * sales_mwh_total + b3 * rate_base) AS e,
    utility_id_eia, report_year
  FROM panel, ols_fit WHERE om_total IS NOT NULL AND customers_total IS NOT NULL
    AND sales_mwh_total IS NOT NULL AND rate_base IS NOT NULL),
steps AS (
  SELECT e, e - lag(e) OVER (ORDER BY utility_id_eia, report_year) AS step FROM resid),
centred AS (SELECT *, e - (SELECT avg(e) FROM steps) AS c FROM steps),
sums AS (
  SELECT CAST(COUNT(*) AS DOUBLE) AS n, SUM(e * e) AS ssr, SUM(step * step) AS dw,
    avg(c * c * c) / pow(avg(c * c), 1.5) AS skew, avg(c * c * c * c) / pow(avg(c * c), 2) AS kurt
  FROM centred),
base AS (
  SELECT sums.*, sst, n - 4 AS dof,
    -n / 2 * (ln(2 * pi()) + ln(sums.ssr / n) + 1) AS loglik,
    n / 6 * (skew * skew + (kurt - 3) * (kurt - 3) / 4) AS jb,
    skew * sqrt((n + 1) * (n + 3) / (6.0 * (n - 2))) AS sy,
    3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS b2,
    (kurt - 3.0 * (n - 1) / (n + 1))
      / sqrt(24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS kx,
    6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
      * sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS rb
  FROM sums, (SELECT sst FROM ols_fit)),
w AS (
  SELECT *, sqrt(2 * (b2 - 1)) - 1 AS w2,
    6.0 + 8.0 / rb * (2.0 / rb + sqrt(1 + 4.0 / (rb * rb))) AS a FROM base),
scores AS (
  SELECT *, ln(sy / sqrt(2 / (w2 - 1)) + sqrt(pow(sy / sqrt(2 / (w2 - 1)), 2) + 1))
      / sqrt(0.5 * ln(w2)) AS zs,
    (1 - 2 / (9.0 * a) - sign(1 + kx * sqrt(2 / (a - 4)))
      * pow((1 - 2 / a) / abs(1 + kx * sqrt(2 / (a - 4))), 1.0::DOUBLE / 3))
      / sqrt(2 / (9.0 * a)) AS zk,
    ((sst - ssr) / 3) / (ssr / dof) AS f FROM w)""".strip()
    # P(F > f) with 3 and dof degrees, by Simpson's rule on the beta integral with x = s * s.
    tail = """(SELECT SUM(wt * 2 * pow(s, dof - 1) * sqrt(1 - s * s)) * h / 3
      / exp(lgamma(dof / 2) + lgamma(1.5::DOUBLE) - lgamma(dof / 2 + 1.5))
    FROM (SELECT i * x / 4000.0 AS s, x / 4000.0 AS h,
      CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS wt
      FROM range(0, 4001) t(i), (SELECT sqrt(dof / (dof + 3 * f)) AS x) q) g GROUP BY h)"""
    stats = {
        "n_obs": "n",
        "skew": "skew",
        "kurtosis": "kurt",
        "r_squared": "1 - ssr / sst",
        "adj_r_squared": "1 - (ssr / sst) * (n - 1) / dof",
        "f_statistic": "f",
        "log_likelihood": "loglik",
        "aic": "-2 * loglik + 8",
        "bic": "-2 * loglik + ln(n) * 4",
        "durbin_watson": "dw / ssr",
        "jarque_bera": "jb",
        "prob_jarque_bera": "exp(-jb / 2)",
        "omnibus": "zs * zs + zk * zk",
        "prob_omnibus": "exp(-(zs * zs + zk * zk) / 2)",
        "df_model": "3.0::DOUBLE",
        "df_residual": "dof",
        "prob_f": "p",
    }
    lines = "\nUNION ALL ".join(
        f"SELECT '{k}' AS stat, round(CAST({v} AS DOUBLE), 5) AS value FROM scored"
        for k, v in stats.items())
    return with_panel(lines, *_ols_ctes("panel")[:2], resid,
                      f"scored AS (SELECT *, {tail} AS p FROM scores)")


def _key_findings() -> str:
    p = t_pvalue("abs(coef / std_err)", "dof")
    return with_panel(f"""
SELECT ordinal, finding, subject, round(value, 6) AS value FROM (
  (SELECT 1 AS ordinal, 'highest cost per customer' AS finding, utility_name AS subject,
    om_per_customer AS value FROM panel
    WHERE report_year = (SELECT MAX(report_year) FROM panel)
    ORDER BY om_per_customer DESC NULLS LAST, utility_id_ferc1 LIMIT 1)
  UNION ALL (SELECT 2, 'fastest cost growth', utility_name,
    {cagr('first_y', 'last_y', 'n_years')} AS growth FROM trend WHERE n >= 2
    ORDER BY growth DESC NULLS LAST, utility_id LIMIT 1)
  UNION ALL SELECT 3, 'significant driver', term, {p} FROM ols_terms
    WHERE term <> 'const' AND n_obs >= 4 AND {p} < 0.05
  UNION ALL SELECT 4, 'collinear driver', variable, vif FROM vif WHERE vif > 10
  UNION ALL SELECT 5, 'outlier count', 'all', CAST(COUNT(*) AS DOUBLE) FROM outliers
  UNION ALL (SELECT 6, 'outlier', utility_name || ' ' || CAST(report_year AS VARCHAR), z_score
    FROM outliers ORDER BY utility_id_eia, report_year LIMIT 5))""",
                      _trend_cte("om_total"), *_ols_ctes("panel"), VIF_CTE, OUTLIERS)


def _waterfall() -> str:
    parts = [
        ("Distribution O&M", "om_distribution"),
        ("Customer Service", "om_customer_service"),
        ("A&G (70%)", "om_ag_allocated"),
        ("Depreciation", "grc_depreciation"),
        ("Return on Rate Base", "grc_return_on_rate_base"),
        ("Taxes (15%)", "grc_taxes"),
    ]
    rows, start = [], "0.0::DOUBLE"
    for i, (name, c) in enumerate(parts, start=1):
        rows.append(f"SELECT {KEYS}, {i} AS step, '{name}' AS component, {start} AS start, "
                    f"{c} AS height FROM modelled")
        start = f"({start} + {c})"
    rows.append(f"SELECT {KEYS}, 7, 'GRC Revenue Requirement', 0.0::DOUBLE, "
                "grc_revenue_requirement FROM modelled")
    return with_panel(f"""SELECT {KEYS}, step, component, start AS start,
  height AS height, printf('$%.1fB', height / 1e9) AS label
FROM ({' UNION ALL '.join(rows)})""".replace(
        "printf('$%.1fB', height / 1e9)",
        "CASE WHEN height IS NOT NULL THEN printf('$%.1fB', height / 1e9) END"), MODELLED)


def _sales_columns(source: str, where: str = "") -> str:
    return (f"SELECT report_year, utility_id_eia, utility_name, state, ownership, row_ordinal, "
            f"{plain(*SALES_MEASURES)} FROM {source} {where}")


def _profile() -> str:
    columns = [*PANEL_KEYS, *OM, "om_total", "grc_om", "rate_base", "operating_revenues_ferc",
               *MWH, *CUSTOMERS, *REVENUE, *RATIOS]
    stats = {
        "row_count": "COUNT(*)",
        "distinct_entities": "COUNT(DISTINCT utility_id_ferc1)",
        "distinct_years": "COUNT(DISTINCT report_year)",
        **{f"nulls_{c}": f"COUNT(*) FILTER ({c} IS NULL)" for c in columns},
    }
    keys = ["utility_id_ferc1", "report_year", "utility_id_eia", "utility_name"]
    names = ", ".join(f"'head_' || n || '_{c}'" for c in keys)
    cells = ", ".join(f"CAST({c} AS VARCHAR)" for c in keys)
    return with_panel(f"""SELECT unnest([{', '.join(f"'{k}'" for k in stats)}]) AS stat,
  unnest([{', '.join(stats)}]) AS value, CAST(NULL AS VARCHAR) AS shown FROM (SELECT {', '.join(
        f'{v} AS {k}' for k, v in stats.items())} FROM ragged)
UNION ALL SELECT unnest([{names}]), NULL, unnest([{cells}]) FROM (SELECT {', '.join(keys)},
  row_number() OVER (ORDER BY {', '.join(f'{c} NULLS FIRST' for c in keys)}) AS n FROM ragged)
WHERE n <= 20""")


def _validate() -> str:
    half = f"((SELECT COUNT(*) FROM id_map) * {len(YEARS)}) * 0.5"
    nulls = {c: f"COUNT(*) FILTER ({c} IS NULL)"
             for c in ["utility_id_ferc1", "utility_id_eia", "report_year"]}
    lines = [
        "SELECT 'not_empty' AS \"check\", CAST(COUNT(*) AS DOUBLE) AS observed, "
        "1.0::DOUBLE AS \"limit\", COUNT(*) >= 1 AS passed FROM ragged",
        f"SELECT 'row_count', COUNT(*), {half}, COUNT(*) >= {half} FROM ragged",
        *[f"SELECT 'null_{c}', {v}, 0.0, {v} = 0 FROM ragged" for c, v in nulls.items()],
        "SELECT 'duplicate_rows', COUNT(*) - COUNT(DISTINCT (utility_id_ferc1, report_year, "
        "utility_id_eia)), 0.0, COUNT(*) = COUNT(DISTINCT (utility_id_ferc1, report_year, "
        "utility_id_eia)) FROM ragged",
    ]
    return with_panel("\nUNION ALL ".join(lines))


def _per_driver(select: str, *ctes: str) -> str:
    return with_panel(select, *ctes)


def oracle_sql() -> dict[str, str]:
    base = f"report_year = {BASE_YEAR}"
    ids = "utility_id_ferc1 IN (SELECT utility_id_ferc1 FROM id_map)"
    plant = ("utility_id_ferc1, report_year, utility_plant_in_service, "
             "accumulated_provision_for_depreciation")
    ex_prod = "(om_total - om_production)"
    gas = f"om_admin_general * (1 - {d(0.7)})"
    om_grc = f"om_distribution + om_customer_service + om_admin_general * {d(0.7)}"
    breakdown = [*[(c, f"om_{c}") for c in CATEGORIES], ("total", "om_total"),
                 ("ex_production", ex_prod)]
    rate = div("(revenue_residential_k * 1000)", "(sales_mwh_residential * 1000)")
    recheck = rr("om_total", None, "rate_base")["revenue_requirement"]
    return {
        "yearly_union": with_sources(_sales_columns("sales_rows")),
        "workbook_sales": with_sources(
            f"SELECT report_year, utility_id_eia, utility_name, state, ownership,"
            f" {plain(*SALES_MEASURES)} FROM sales_rows"),
        "workbook_rollup": with_sources(
            "SELECT utility_id_eia, report_year, arg_min(ownership, row_ordinal) AS ownership,"
            " CAST(sum(customers_total) AS BIGINT) AS customers_total FROM sales_rows"
            " GROUP BY utility_id_eia, report_year"),
        "expense_scan": with_sources(
            f"SELECT * FROM expense_rows WHERE row_type_xbrl = 'reported_value' AND {ids}"),
        "plant_wide": with_panel(f"SELECT {plant} FROM plant_wide"),
        "income_scan": with_sources(
            f"SELECT * FROM income_rows WHERE utility_type = 'electric' AND {ids}"),
        "operating_revenue": with_panel("SELECT * FROM revenues"),
        "association_scan": with_sources(
            "SELECT * FROM id_map WHERE utility_id_ferc1 IN "
            "(SELECT utility_id_ferc1 FROM income_rows)"),
        "state_entity_filter": with_sources(_sales_columns(
            "sales_rows",
            "WHERE state = 'CA' AND utility_id_eia IN (SELECT utility_id_eia FROM id_map)")),
        "account_category": with_panel(
            "SELECT ferc_account, category, COUNT(*) AS n FROM categorized GROUP BY ALL"),
        "dedupe_rollup": f"WITH {SOURCES.strip()}, rolled AS ({rolled_up('sales_rows')}) "
        f"SELECT utility_id_eia, report_year, utility_name, state, ownership, "
        f"{rnd(6, *REVENUE)}, {plain(*MWH, *CUSTOMERS)} FROM rolled",
        "expense_pivot": with_panel("SELECT * FROM expenses_wide"),
        "rate_base": with_panel(f"SELECT {plant}, rate_base FROM plant_base"),
        "panel_join": with_panel(
            f"""SELECT utility_id_ferc1, utility_id_eia, report_year, utility_name, state, ownership,
  {plain(*OM, 'om_total', 'rate_base', 'operating_revenues_ferc', *MWH)}, {rnd(6, *REVENUE)},
  {plain(*CUSTOMERS)} FROM joined"""),
        "panel_final": with_panel(f"SELECT {panel_columns()} FROM ragged"),
        "derived_metrics": with_panel(
            f"SELECT utility_id_ferc1, report_year, grc_om, {plain(*RATIOS[:-1])}, "
            "round(revenue_per_customer, 6) AS revenue_per_customer FROM panel"),
        "validate_panel": _validate(),
        "null_profile": _profile(),
        "distinct_accounts": with_sources("SELECT DISTINCT ferc_account FROM expense_rows"),
        "distinct_income_types": with_sources("SELECT DISTINCT income_type FROM income_rows"),
        "top_accounts": with_sources(
            f"SELECT ferc_account, {cents('dollar_value')} AS dollar_value FROM expense_rows "
            f"WHERE {base} GROUP BY ferc_account ORDER BY dollar_value DESC, ferc_account LIMIT 20"),
        "format_amounts": with_panel(
            "SELECT utility_id_ferc1, report_year, printf('$%.1fB', om_total / 1e9) "
            "AS om_billions, printf('$%.0fM', om_total / 1e6) AS om_millions FROM panel"),
        "om_ex_production": with_panel(
            f"""SELECT {KEYS}, {ex_prod} AS om_ex_production,
  {div('om_total', 'customers_total')} AS om_per_customer_total,
  {div(ex_prod, 'customers_total')} AS om_per_customer_ex_production FROM panel"""),
        "kpi_formulas": with_panel(
            f"""SELECT {KEYS},
  {div('revenue_requirement', 'sales_mwh_total')} AS rr_per_mwh,
  {div('rate_base', 'customers_total')} AS rate_base_per_customer,
  ({div('revenue_requirement', 'customers_total')}) / 12 AS monthly_bill_total,
  ({div('grc_revenue_requirement', 'customers_total')}) / 12 AS monthly_bill_grc,
  (rate_base - before) / NULLIF(before, 0) AS rate_base_growth
FROM (SELECT *, CASE WHEN utility_id_ferc1 IS NOT NULL THEN lag(rate_base)
    OVER (PARTITION BY utility_id_ferc1 ORDER BY report_year) END AS before
  FROM modelled)""", MODELLED),
        "wacc_from_capital": with_panel(
            f"""SELECT utility_id_ferc1, report_year,
  rate_base / (rate_base + operating_revenues_ferc) * {d(0.10)}
    + operating_revenues_ferc / (rate_base + operating_revenues_ferc) * {d(0.05)} AS wacc
FROM panel WHERE rate_base > 0 AND operating_revenues_ferc > 0"""),
        "baseline_filter": with_panel(
            f"SELECT utility_id_ferc1, report_year, {plain('om_total', 'rate_base')} FROM kept",
            KEPT),
        "revenue_requirement": _breakdown("om_other", "TRUE"),
        "revenue_requirement_with_passthrough": _breakdown(None, "FALSE"),
        "revenue_gap": with_panel(f"SELECT {panel_columns(*GAP_DOUBLES)} FROM gap", MODELLED),
        "grc_requirement": with_panel(
            f"SELECT {panel_columns(*GAP_DOUBLES, *GRC_DOUBLES)} FROM modelled", MODELLED),
        "grc_breakdown": with_panel(
            f"""SELECT utility_id_ferc1, report_year, {plain('om_distribution',
  'om_customer_service', 'om_production', 'om_transmission')},
  om_admin_general AS om_ag_total,
  om_admin_general * {d(0.7)} AS om_ag_electric, {gas} AS om_ag_gas,
  {om_grc} AS om_grc,
  om_production + om_transmission + om_other + {gas} AS om_excluded FROM panel"""),
        "grc_alt": with_panel(
            f"""SELECT utility_id_ferc1, report_year, {om_grc} AS om_grc,
  om_admin_general * {d(0.7)} AS om_ag_electric,
  om_production + om_transmission + om_other + {gas} AS om_excluded,
  CASE WHEN rate_base <= 0 THEN 0.0 ELSE rate_base * {d(0.035)} END AS depreciation,
  CASE WHEN rate_base <= 0 THEN 0.0 ELSE rate_base * {d(0.075)} END
    AS return_on_rate_base,
  {grc()['grc_taxes']} AS taxes_grc,
  {grc()['grc_revenue_requirement']} AS revenue_requirement_grc,
  {div(f'({om_grc})', 'customers_total')} AS om_per_customer_grc,
  {div(f'({om_grc})', 'sales_mwh_total')} AS om_per_mwh_grc FROM panel"""),
        "test_year_forecast": _forecast(),
        "test_year_forecast_grc": _forecast_grc(),
        "wacc_sensitivity": _wacc_sensitivity(),
        "compare_methodologies": with_panel(
            f"""SELECT utility_name, report_year AS year, om_total AS total_om,
  {plain('grc_om', 'om_production', 'om_transmission', 'om_distribution',
       'om_customer_service', 'grc_revenue_requirement')},
  om_production + om_transmission + om_admin_general * {d(0.3)} AS excluded_om,
  om_admin_general AS om_ag_full,
  om_admin_general * {d(0.7)} AS om_ag_allocated,
  revenue_requirement AS total_revenue_requirement,
  CASE WHEN revenue_requirement > 0
    THEN grc_revenue_requirement / revenue_requirement * 100.0 END AS grc_share_of_total_pct
FROM modelled WHERE {base}""", MODELLED),
        "class_shares": with_panel(
            f"SELECT {KEYS}, {rnd(6, *REVENUE)}, " + ", ".join(
                f"round({div(f'revenue_{s}_k', 'revenue_total_k')}, 9) AS {s}_share"
                for s in SECTORS) + " FROM panel"),
        "residential_bill": _allocated_bills(),
        "bill_impact": _bill_impact(),
        "bill_sensitivity": _bill_sensitivity(),
        "ag_sensitivity": with_panel(
            f"""SELECT {KEYS}, x AS ag_allocation,
  om_distribution + om_customer_service + om_admin_general * x AS grc_om
FROM panel, (VALUES ({d(0.41)}), ({d(0.5)}), ({d(0.6)}), ({d(0.7)})) a(x)"""),
        "ag_backsolve": with_panel(
            f"""SELECT {KEYS}, target AS target, needed AS ag_needed,
  {div('needed', 'om_admin_general')} AS ag_share_needed
FROM (SELECT *, target - om_distribution - om_customer_service AS needed
  FROM (SELECT *, om_total * {d(0.25)} AS target FROM panel))"""),
        "residential_bill_methods": with_panel(
            f"""SELECT {KEYS}, customers_residential,
  round(({div('(revenue_residential_k * 1000)', 'customers_residential')}) / 12, 9)
    AS monthly_bill_actual,
  round({rate}, 9) AS rate_per_kwh, round(({rate}) * 500.0, 9) AS monthly_bill_usage
FROM panel WHERE {base}"""),
        "revenue_reconcile": with_panel(
            f"""SELECT {KEYS}, round(operating_revenues_ferc, 6) AS ferc_revenue,
  round(revenue_total_k * 1000, 6) AS eia_revenue,
  round(operating_revenues_ferc - revenue_total_k * 1000, 6) AS revenue_difference,
  round(grc_revenue_requirement - om_total * 0.5, 6) AS authorised_difference,
  round(grc_revenue_requirement / NULLIF(om_total * 0.5, 0) * 100.0 - 100.0, 6)
    AS authorised_difference_pct FROM modelled""", MODELLED),
        "rr_recompute_check": with_panel(
            f"""SELECT {KEYS}, revenue_requirement AS stored_rr,
  {recheck} AS calculated_rr,
  abs({recheck} - revenue_requirement) < 1000.0 AS matches FROM gap""", MODELLED),
        "cost_breakdown": with_panel(" UNION ALL ".join(
            f"SELECT {KEYS}, {i} AS line, '{n}' AS category, {c} / 1e6 AS amount "
            f"FROM panel WHERE {base}" for i, (n, c) in enumerate(breakdown, start=1))),
        "summary_requirement": with_panel(
            f"""SELECT utility_id_ferc1, utility_name, {plain('revenue_requirement',
  'grc_revenue_requirement', 'revenue_gap', 'revenue_gap_pct')}
FROM modelled WHERE {base}""", MODELLED),
        "trend": _trend(),
        "trend_pvalue": _trend_pvalue(),
        "summary_by_entity": _summary(),
        "cagr_by_count": with_panel(
            f"""SELECT utility_id_ferc1, utility_name, round(first_value, 6) AS first_value,
  round(last_value, 6) AS last_value, n_periods,
  round({cagr('first_value', 'last_value', 'n_periods')}, 6) AS cagr_percent
FROM (SELECT utility_id_ferc1, arg_min(utility_name, report_year) AS utility_name,
    arg_min_null(om_total, report_year) AS first_value,
    arg_max_null(om_total, report_year) AS last_value,
    COUNT(*) - 1 AS n_periods FROM panel WHERE utility_id_ferc1 IS NOT NULL
  GROUP BY utility_id_ferc1)"""),
        "cagr_baseline": with_panel(
            f"""SELECT utility_id_ferc1, utility_name, start_year, end_year,
  {rnd(6, 'start_value', 'end_value')},
  round({cagr('start_value', 'end_value', '(end_year - start_year)')}, 6) AS cagr_percent
FROM (SELECT utility_id_ferc1, arg_min(utility_name, report_year) AS utility_name,
    MIN(report_year) FILTER (grc_om IS NOT NULL) AS start_year,
    MAX(report_year) FILTER (grc_om IS NOT NULL) AS end_year,
    arg_min(grc_om, report_year) FILTER (grc_om IS NOT NULL) AS start_value,
    arg_max(grc_om, report_year) FILTER (grc_om IS NOT NULL) AS end_value
  FROM kept WHERE utility_id_ferc1 IS NOT NULL GROUP BY utility_id_ferc1)""", KEPT),
        "yoy_change": with_panel(
            f"""SELECT {KEYS}, om_total AS metric_value,
  CASE WHEN previous <> 0 THEN (om_total - previous) / abs(previous) * 100.0 END
    AS yoy_pct_change
FROM (SELECT *, CASE WHEN utility_id_ferc1 IS NOT NULL THEN lag(om_total)
  OVER (PARTITION BY utility_id_ferc1 ORDER BY report_year) END AS previous FROM panel)"""),
        "yoy_matrix": with_panel(
            "SELECT utility_id_ferc1, utility_name, " + ", ".join(
                f"MAX(om_yoy_pct) FILTER (report_year = {y}) AS \"{y}\""
                for y in YEARS[1:]) + " FROM yoy WHERE utility_id_ferc1 IS NOT NULL GROUP BY utility_id_ferc1, utility_name",
            YOY_CELLS.replace("{metric}", "om_total")),
        "yoy_matrix_flags": with_panel(
            f"SELECT {KEYS}, om_yoy_pct AS om_yoy_pct, "
            "COALESCE(om_yoy_pct > 10 OR om_yoy_pct < -5, FALSE) AS is_flagged FROM yoy",
            YOY_CELLS.replace("{metric}", "rate_base")),
        "peer_benchmark": with_panel(
            """SELECT utility_id_ferc1, utility_name, round(om_per_customer, 6) AS om_per_customer,
  round(CASE WHEN std = 0 THEN 0.0 ELSE (om_per_customer - mean) / std END, 6) AS z_score,
  round((low + (ties - 1) / 2.0) / NULLIF(known, 0) * 100.0, 6) AS percentile, high AS rank
FROM (SELECT *, avg(om_per_customer) OVER () AS mean, stddev_samp(om_per_customer) OVER () AS std,
    COUNT(om_per_customer) OVER () AS known,
    CASE WHEN om_per_customer IS NOT NULL
      THEN COUNT(*) OVER (PARTITION BY om_per_customer) END AS ties,
    CASE WHEN om_per_customer IS NOT NULL
      THEN rank() OVER (ORDER BY om_per_customer NULLS LAST) END AS low,
    CASE WHEN om_per_customer IS NOT NULL
      THEN rank() OVER (ORDER BY om_per_customer DESC NULLS LAST) END AS high
  FROM panel WHERE report_year = (SELECT MAX(report_year) FROM panel))"""),
        "outliers": with_panel(
            f"SELECT {panel_columns()}, round(z_score, 6) AS z_score, TRUE AS is_outlier "
            "FROM outliers", OUTLIERS),
        "peer_pct_diff": with_panel(
            f"""SELECT {KEYS}, {rnd(6, 'grc_om_per_customer', 'peer_average')},
  round((grc_om_per_customer - peer_average) / NULLIF(peer_average, 0) * 100.0, 6)
    AS pct_difference
FROM (SELECT *, avg(grc_om_per_customer) OVER () AS peer_average FROM panel WHERE {base})"""),
        "variance_decomposition": with_panel(
            """SELECT utility_id_ferc1, utility_name, start_year, end_year,
  round(total_change, 6) AS total_change, round(driver_change, 6) AS driver_change,
  round(slope, 9) AS slope, round(r2, 9) AS r_squared,
  round(slope * driver_change, 3) AS explained,
  round(total_change - slope * driver_change, 3) AS unexplained,
  round(slope * driver_change / NULLIF(total_change, 0) * 100.0, 3) AS pct_explained
FROM (SELECT utility_id_ferc1, arg_min(utility_name, report_year) AS utility_name,
    MIN(report_year) AS start_year, MAX(report_year) AS end_year,
    arg_max(grc_om, report_year) - arg_min(grc_om, report_year) AS total_change,
    arg_max(rate_base, report_year) - arg_min(rate_base, report_year) AS driver_change
  FROM both_known WHERE utility_id_ferc1 IS NOT NULL GROUP BY utility_id_ferc1),
  (SELECT regr_slope(grc_om, rate_base) AS slope, regr_r2(grc_om, rate_base) AS r2
   FROM both_known)""",
            "both_known AS (SELECT * FROM panel WHERE grc_om IS NOT NULL AND rate_base IS NOT NULL)"),
        "ols_cost_drivers": with_panel(_ols_select(), *_ols_ctes("panel"), CRITICAL_CTE),
        "ols_baseline": with_panel(_ols_select(), KEPT, *_ols_ctes("kept"), CRITICAL_CTE),
        "ols_by_year": with_panel(
            _ols_select("report_year"), *_ols_ctes("panel", "report_year"), CRITICAL_CTE),
        "vif": with_panel("SELECT variable, round(vif, 6) AS vif FROM vif", VIF_CTE),
        "vif_two": _vif_swept(DRIVERS[:2], 6),
        "vif_five": _vif_swept([*DRIVERS, "om_distribution", "operating_revenues_ferc"], 5),
        "vif_by_year": _vif_swept(DRIVERS, 6, "report_year"),
        "ols_diagnostics": _diagnostics(),
        "ols_condition_number": _condition_number(),
        "key_findings": _key_findings(),
        "chart_om_trend": with_panel(
            f"""SELECT {KEYS}, om_total / 1e9 AS om_billions,
  round(growth, 8) AS cagr_percent,
  CASE WHEN growth IS NOT NULL THEN printf('%s: %+.1f%%', utility_name, growth) END AS cagr_label
FROM (SELECT *, {cagr('first_om', 'last_om', 'periods')} AS growth
  FROM (SELECT *, arg_min_null(om_total, report_year) OVER w AS first_om,
      arg_max_null(om_total, report_year) OVER w AS last_om, COUNT(*) OVER w - 1 AS periods
    FROM panel WHERE utility_id_ferc1 IS NOT NULL WINDOW w AS (PARTITION BY utility_id_ferc1)))"""),
        "rr_waterfall": _waterfall(),
        "chart_revenue_gap": with_panel(
            f"""SELECT {KEYS}, round(revenue_gap / 1e9, 9) AS gap_billions,
  round(revenue_gap_pct, 9) AS revenue_gap_pct,
  CASE WHEN revenue_gap < 0 THEN 'over-collecting' WHEN revenue_gap >= 0
    THEN 'under-collecting' END AS collection
FROM modelled WHERE {base}""", MODELLED),
        "chart_bill_impact": with_panel(
            f"""SELECT utility_id_ferc1, utility_name, 'Current' AS series,
  round(current_monthly_bill, 7) AS monthly_bill, CAST(NULL AS DOUBLE) AS change_pct FROM bills
UNION ALL SELECT utility_id_ferc1, utility_name, 'Proposed', round(proposed_monthly_bill, 7),
  round({CHANGE_PCT}, 7) FROM bills""", BILL_ROWS, _bill_impact_cte()),
    }
