"""Revenue requirement, test-year and methodology models. Column expressions only: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelspark.config import AG_ALLOCATIONS, DEFAULTS, OM_COLUMNS, WACC_RANGE, Assumptions
from panelspark.functions.columns import (
    add_columns,
    allocated_om,
    col_or,
    explode_rows,
    grc_parts,
    known,
    named,
    number,
    pct_of,
    rate_base_return,
    require_columns,
    requirement_parts,
    row,
)
from panelspark.operators.stats import by_year

KEYS = ["utility_id_ferc1", "utility_name", "report_year"]
GRC_INPUTS = ["om_distribution", "om_customer_service", "om_admin_general", "rate_base"]


def _om_other(df: DataFrame) -> str | None:
    return "om_other" if "om_other" in df.columns else None


def add_requirement(
    df: DataFrame, a: Assumptions = DEFAULTS, exclude_passthrough: bool = True
) -> DataFrame:
    """Total requirement and its gap to actual revenue."""
    require_columns(df, ["om_total", "rate_base"])
    parts = requirement_parts("om_total", _om_other(df), "rate_base", a, exclude_passthrough)
    shown = ["depreciation", "return_on_rate_base", "taxes", "revenue_requirement"]
    actual = col_or(df, "operating_revenues_ferc", "revenue_total_k * 1000D")
    out = add_columns(df, {**{c: parts[c] for c in shown}, "actual_revenue": actual})
    out = add_columns(out, {"revenue_gap": "revenue_requirement - actual_revenue"})
    return add_columns(out, {"revenue_gap_pct": pct_of("revenue_gap", "actual_revenue")})


def requirement_breakdown(
    df: DataFrame, a: Assumptions = DEFAULTS, exclude_passthrough: bool = True
) -> DataFrame:
    """Every component of the total requirement with the rates used."""
    parts = requirement_parts("om_total", _om_other(df), "rate_base", a, exclude_passthrough)
    return df.selectExpr(*KEYS, *named({
        **parts,
        "depreciation_rate": number(a.depreciation_rate),
        "wacc": number(a.wacc),
        "tax_rate": number(a.tax_rate),
        "exclude_passthrough": str(exclude_passthrough).lower(),
    }))


def add_grc_requirement(df: DataFrame, a: Assumptions = DEFAULTS) -> DataFrame:
    """GRC requirement next to the total one; replaces grc_om."""
    require_columns(df, GRC_INPUTS)
    parts = grc_parts(*GRC_INPUTS, a)
    return add_columns(df, {
        "grc_om": parts["grc_om"],
        "om_ag_allocated": parts["om_ag_allocated"],
        "grc_depreciation": parts["depreciation"],
        "grc_return_on_rate_base": parts["return_on_rate_base"],
        "grc_taxes": parts["taxes"],
        "grc_revenue_requirement": parts["grc_revenue_requirement"],
    })


def _gas_share(a: Assumptions) -> str:
    return number(1 - a.ag_allocation)


def add_grc_breakdown(df: DataFrame, a: Assumptions = DEFAULTS) -> DataFrame:
    """What the GRC requirement covers and what it leaves out."""
    share, gas = number(a.ag_allocation), f"om_admin_general * {_gas_share(a)}"
    return add_columns(df, {
        "om_ag_total": "om_admin_general",
        "om_ag_electric": f"om_admin_general * {share}",
        "om_ag_gas": gas,
        "om_grc": allocated_om(*GRC_INPUTS[:3], share),
        "om_excluded": f"om_production + om_transmission + om_other + {gas}",
    })


def add_grc_requirement_alt(df: DataFrame, a: Assumptions = DEFAULTS) -> DataFrame:
    """The same model under the alternate names, with unit costs; overwrites depreciation.

    An absent input column counts as 0 and a null one propagates.
    """
    require_columns(df, GRC_INPUTS)
    absent = [c for c in ["om_production", "om_transmission", "om_other"] if c not in df.columns]
    parts = grc_parts(*GRC_INPUTS, a)
    out = add_grc_breakdown(add_columns(df, {c: "0D" for c in absent}), a)
    out = add_columns(out, {
        "depreciation": rate_base_return("rate_base", number(a.depreciation_rate)),
        "return_on_rate_base": rate_base_return("rate_base", number(a.wacc)),
        "taxes_grc": parts["taxes"],
        "revenue_requirement_grc": parts["grc_revenue_requirement"],
        "om_per_customer_grc": "try_divide(om_grc, customers_total)",
        "om_per_mwh_grc": "try_divide(om_grc, sales_mwh_total)",
    })
    return out.drop("om_ag_total", "om_ag_gas", *absent)


def base_rows(df: DataFrame, base_year: int) -> DataFrame:
    """The rows of the base year; a year without rows is an error. That takes a look at the frame,
    so one that costs much is better staged."""
    rows = df.where(f"report_year = {base_year}")
    if rows.isEmpty():
        raise ValueError(f"No data for base year {base_year}")
    return rows


def forecast_test_year(
    df: DataFrame,
    base_year: int,
    a: Assumptions = DEFAULTS,
    escalate_passthrough: bool = False,
) -> DataFrame:
    """One-year projection of the total requirement; ValueError for a base year without rows.
    Pass-through cost stays at its base value unless `escalate_passthrough`."""
    up, grow = number(1.0 + a.om_escalation), number(1.0 + a.rate_base_growth)
    other = _om_other(df)
    later = f"({other} * {up})" if other and escalate_passthrough else other
    now = requirement_parts("om_total", other, "rate_base", a)
    then = requirement_parts(f"(om_total * {up})", later, f"(rate_base * {grow})", a)
    base = known(base_rows(df, base_year), "om_total", "rate_base")
    rows = base.selectExpr("utility_id_ferc1", "utility_name", *named({
        "base_year": str(base_year),
        "forecast_year": str(base_year + 1),
        "base_om": "om_total",
        "forecast_om": f"om_total * {up}",
        "base_rate_base": "rate_base",
        "forecast_rate_base": f"rate_base * {grow}",
        "base_year_rr": now["revenue_requirement"],
        "forecast_year_rr": then["revenue_requirement"],
    }))
    return _with_change(rows, "base_year_rr", "forecast_year_rr", a)


def _with_change(df: DataFrame, before: str, after: str, a: Assumptions) -> DataFrame:
    change = f"({after} - {before})"
    return add_columns(df, {
        "rr_change": change,
        "rr_change_pct": pct_of(change, before),
        "om_escalation_rate": number(a.om_escalation),
        "rate_base_growth_rate": number(a.rate_base_growth),
        "wacc": number(a.wacc),
    })


def forecast_test_year_grc(
    df: DataFrame, base_year: int, a: Assumptions = DEFAULTS
) -> DataFrame:
    """One-year projection of the GRC requirement: each allocated cost is escalated; ValueError for
    a base year without rows."""
    costs = GRC_INPUTS[:3]
    up, grow = number(1.0 + a.om_escalation), number(1.0 + a.rate_base_growth)
    now = grc_parts(*costs, "rate_base", a)
    then = grc_parts(*[f"({c} * {up})" for c in costs], f"(rate_base * {grow})", a)
    base_om = f"coalesce({col_or(df, 'om_grc', 'NULL')}, {now['grc_om']})"
    base = base_rows(df, base_year).where(f"rate_base IS NOT NULL AND {base_om} IS NOT NULL")
    rows = base.selectExpr("utility_id_ferc1", "utility_name", *named({
        "base_year": str(base_year),
        "forecast_year": str(base_year + 1),
        "base_om_grc": base_om,
        "forecast_om_grc": f"{base_om} * {up}",
        "base_rate_base": "rate_base",
        "forecast_rate_base": f"rate_base * {grow}",
        "base_year_rr_grc": now["grc_revenue_requirement"],
        "forecast_year_rr_grc": then["grc_revenue_requirement"],
    }))
    return _with_change(rows, "base_year_rr_grc", "forecast_year_rr_grc", a)


def wacc_sensitivity(df: DataFrame, waccs=WACC_RANGE, a: Assumptions = DEFAULTS) -> DataFrame:
    """Requirement under each WACC against the first one. The WACC list is exploded per row and
    the first requirement is a column, so neither a join nor a window is needed."""

    def requirement(wacc: str) -> str:
        return requirement_parts("om_total", None, "rate_base", a, wacc=wacc)[
            "revenue_requirement"
        ]

    inputs = known(df, "om_total", "rate_base")
    tried = explode_rows(
        inputs, [*KEYS, "om_total", "rate_base"], [row(wacc=number(w)) for w in waccs]
    )
    costed = tried.selectExpr(*KEYS, "wacc", *named({
        "revenue_requirement": requirement("wacc"),
        "base": requirement(number(waccs[0])),
    }))
    change = "(revenue_requirement - base)"
    return costed.selectExpr(*KEYS, "wacc", "revenue_requirement", *named({
        "wacc_pct": "wacc * 100D",
        "change_from_base": change,
        "change_pct": f"CASE WHEN base = 0 THEN 0D ELSE {pct_of(change, 'base')} END",
    }))


def compare_methodologies(df: DataFrame, year: int, a: Assumptions = DEFAULTS) -> DataFrame:
    """Total against GRC requirement in one year. Needs both models' columns.

    The excluded cost counts 30 % of A&G whatever the allocation, and leaves om_other out.
    """
    return df.where(f"report_year = {year}").selectExpr(
        "utility_name", "grc_om", *OM_COLUMNS[:4], "grc_revenue_requirement", *named({
            "year": "report_year",
            "total_om": "om_total",
            "excluded_om": "om_production + om_transmission + om_admin_general * 0.3D",
            "om_ag_full": "om_admin_general",
            "om_ag_allocated": f"om_admin_general * {number(a.ag_allocation)}",
            "total_revenue_requirement": "revenue_requirement",
            "grc_share_of_total_pct": "CASE WHEN revenue_requirement > 0 THEN"
            " grc_revenue_requirement / revenue_requirement * 100D END",
        })
    )


def ag_sensitivity(df: DataFrame, allocations=AG_ALLOCATIONS) -> DataFrame:
    """Allocated cost under each A&G allocation."""
    costs = GRC_INPUTS[:3]
    out = explode_rows(df, [*KEYS, *costs], [row(ag_allocation=number(x)) for x in allocations])
    return out.selectExpr(
        *KEYS, "ag_allocation", f"{allocated_om(*costs, 'ag_allocation')} AS grc_om"
    )


def ag_backsolve(df: DataFrame, target: str) -> DataFrame:
    """A&G amount and share that would bring the allocated cost to a target expression."""
    needed = f"({target} - om_distribution - om_customer_service)"
    return df.selectExpr(*KEYS, *named({
        "target": target,
        "ag_needed": needed,
        "ag_share_needed": f"try_divide({needed}, om_admin_general)",
    }))


def requirement_check(
    df: DataFrame, a: Assumptions = DEFAULTS, tolerance: float = 1000.0
) -> DataFrame:
    """Recompute the requirement from all O&M and compare it with the stored column."""
    again = requirement_parts("om_total", None, "rate_base", a)["revenue_requirement"]
    return df.selectExpr(*KEYS, *named({
        "stored_rr": "revenue_requirement",
        "calculated_rr": again,
        "matches": f"abs({again} - revenue_requirement) < {number(tolerance)}",
    }))


def reconcile_revenue(df: DataFrame, authorised: str) -> DataFrame:
    """Accounting revenue against sales revenue, and the GRC requirement against an
    authorised figure (an expression)."""
    grc = "grc_revenue_requirement"
    return df.selectExpr(*KEYS, *named({
        "ferc_revenue": "operating_revenues_ferc",
        "eia_revenue": "revenue_total_k * 1000",
        "revenue_difference": "operating_revenues_ferc - revenue_total_k * 1000",
        "authorised_difference": f"{grc} - {authorised}",
        "authorised_difference_pct": f"try_divide({grc}, {authorised}) * 100D - 100D",
    }))


def cost_breakdown(df: DataFrame, year: int, unit: float = 1e9) -> DataFrame:
    """Cost by category in units, with the total and the total without production."""
    lines = {c.removeprefix("om_"): c for c in OM_COLUMNS}
    lines["total"] = "om_total"
    lines["ex_production"] = "(om_total - om_production)"
    rows = [
        row(line=str(i), category=f"'{name}'", amount=f"{cost} / {number(unit)}")
        for i, (name, cost) in enumerate(lines.items(), start=1)
    ]
    return explode_rows(df.where(f"report_year = {year}"), KEYS, rows)


def om_ex_production(df: DataFrame) -> DataFrame:
    rest = "(om_total - om_production)"
    return df.selectExpr(*KEYS, *named({
        "om_ex_production": rest,
        "om_per_customer_total": "try_divide(om_total, customers_total)",
        "om_per_customer_ex_production": f"try_divide({rest}, customers_total)",
    }))


def wacc_of(equity: str, roe: str, debt: str, cost_of_debt: str) -> str:
    """Weighted cost of capital of an equity and a debt share."""
    return f"({equity}) * {roe} + ({debt}) * {cost_of_debt}"


def kpi_formulas(df: DataFrame) -> DataFrame:
    """Requirement per MWh, capital and monthly bill per customer, rate base growth."""
    before = f"CASE WHEN utility_id_ferc1 IS NOT NULL THEN lag(rate_base) {by_year(df)} END"
    return df.selectExpr("*", f"{before} AS rate_base_before").selectExpr(*KEYS, *named({
        "rr_per_mwh": "try_divide(revenue_requirement, sales_mwh_total)",
        "rate_base_per_customer": "try_divide(rate_base, customers_total)",
        "monthly_bill_total": "try_divide(revenue_requirement, customers_total) / 12",
        "monthly_bill_grc": "try_divide(grc_revenue_requirement, customers_total) / 12",
        "rate_base_growth": "try_divide(rate_base - rate_base_before, rate_base_before)",
    }))
