"""Customer classes and residential bills."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelspark.config import BILL_SCENARIOS, DEFAULTS, SECTORS, Assumptions
from panelspark.functions.columns import (
    add_columns,
    explode_rows,
    known,
    named,
    number,
    pct_of,
    require_columns,
    requirement_parts,
    residential_bill,
    row,
    text,
)
from panelspark.operators.models import KEYS
from panelspark.schemas import REVENUE_COLUMNS

BILL_INPUTS = [
    *KEYS,
    "om_total",
    "rate_base",
    "revenue_residential_k",
    "revenue_total_k",
    "sales_mwh_residential",
]


def class_shares(df: DataFrame) -> DataFrame:
    require_columns(df, [*KEYS, *REVENUE_COLUMNS])
    shares = {f"{s}_share": f"try_divide(revenue_{s}_k, revenue_total_k)" for s in SECTORS}
    return df.selectExpr(*KEYS, *REVENUE_COLUMNS, *named(shares))


def bill_rows(df: DataFrame, base_year: int) -> DataFrame:
    """Base-year rows a bill can be computed for, with the residential share."""
    require_columns(df, BILL_INPUTS)
    rows = known(df.where(f"report_year = {base_year}"), "om_total", "rate_base").where(
        "sales_mwh_residential > 0"
    )
    share = (
        "CASE WHEN revenue_total_k = 0 THEN 0D"
        " ELSE try_divide(revenue_residential_k, revenue_total_k) END"
    )
    return add_columns(rows, {"residential_share": share})


def allocated_bills(df: DataFrame, base_year: int, a: Assumptions = DEFAULTS) -> DataFrame:
    """Residential bill from the residential share of the total requirement."""
    rows = bill_rows(df, base_year)
    other = "om_other" if "om_other" in df.columns else None
    requirement = requirement_parts("om_total", other, "rate_base", a)["revenue_requirement"]
    bill = residential_bill(
        requirement, "residential_share", "sales_mwh_residential", a.avg_monthly_kwh
    )
    return rows.selectExpr(
        *KEYS, *named({**bill, "avg_monthly_kwh": number(a.avg_monthly_kwh)})
    )


def bill_impact(df: DataFrame, base_year: int, a: Assumptions = DEFAULTS) -> DataFrame:
    """Actual bill against the same bill scaled by forecast over current requirement."""
    other = "om_other" if "om_other" in df.columns else None
    up, grow = number(1.0 + a.om_escalation), number(1.0 + a.rate_base_growth)
    current = requirement_parts("om_total", other, "rate_base", a)
    proposed = requirement_parts(f"(om_total * {up})", other, f"(rate_base * {grow})", a)
    rows = bill_rows(df, base_year).selectExpr("utility_id_ferc1", "utility_name", *named({
        "base_year": str(base_year),
        "residential_share": "residential_share",
        "residential_share_pct": "residential_share * 100D",
        "current_rr": current["revenue_requirement"],
        "proposed_rr": proposed["revenue_requirement"],
        "current_rate_per_kwh": "try_divide(revenue_residential_k * 1000D,"
        " sales_mwh_residential * 1000D)",
    })).where("current_rr <> 0")
    rows = add_columns(rows, {
        "factor": "proposed_rr / current_rr",
        "current_monthly_bill": f"current_rate_per_kwh * {number(a.avg_monthly_kwh)}",
    })
    rows = add_columns(rows, {
        "proposed_rate_per_kwh": "current_rate_per_kwh * factor",
        "proposed_monthly_bill": "current_monthly_bill * factor",
    })
    rows = add_columns(
        rows, {"monthly_change_dollars": "proposed_monthly_bill - current_monthly_bill"}
    )
    change_pct = pct_of("monthly_change_dollars", "current_monthly_bill")
    return add_columns(rows, {
        "monthly_change_pct": f"CASE WHEN current_monthly_bill = 0 THEN 0D ELSE {change_pct} END",
        "annual_change_dollars": "monthly_change_dollars * 12D",
        "avg_monthly_kwh": number(a.avg_monthly_kwh),
        "om_escalation": number(a.om_escalation),
        "rate_base_growth": number(a.rate_base_growth),
    }).drop("factor")


def bill_sensitivity(
    df: DataFrame, base_year: int, scenarios=BILL_SCENARIOS, a: Assumptions = DEFAULTS
) -> DataFrame:
    """Allocated bill under every scenario against the first one.

    Scenarios are exploded from a literal list and the first bill is a column: the output grows
    by a fixed factor and nothing is shuffled. Pass-through cost is not excluded here.
    """

    def requirement(escalation: str, growth: str, wacc: str) -> str:
        om, rate_base = f"(om_total * (1D + {escalation}))", f"(rate_base * (1D + {growth}))"
        return requirement_parts(om, None, rate_base, a, wacc=wacc)["revenue_requirement"]

    def bill(rr: str) -> str:
        return residential_bill(
            rr, "residential_share", "sales_mwh_residential", a.avg_monthly_kwh
        )["monthly_bill"]

    assumed = ["om_escalation", "rate_base_growth", "wacc"]
    shown = ["utility_id_ferc1", "utility_name", "scenario", *assumed]
    inputs = ["om_total", "rate_base", "residential_share", "sales_mwh_residential"]
    tried = explode_rows(bill_rows(df, base_year), [*shown[:2], *inputs], [
        row(scenario=text(n), om_escalation=number(e), rate_base_growth=number(g), wacc=number(w))
        for n, e, g, w in scenarios
    ])
    costed = tried.selectExpr(*shown, *inputs, *named({
        "revenue_requirement": requirement(*assumed),
        "base_requirement": requirement(*[number(x) for x in scenarios[0][1:]]),
    }))
    billed = costed.selectExpr(*shown, "revenue_requirement", *named({
        "monthly_bill": bill("revenue_requirement"),
        "base_bill": bill("base_requirement"),
    }))
    change = "(monthly_bill - base_bill)"
    return billed.selectExpr(*shown, "revenue_requirement", "monthly_bill", *named({
        "change_from_base": change,
        "change_pct": f"CASE WHEN base_bill = 0 AND {change} IS NOT NULL THEN 0D"
        f" ELSE {pct_of(change, 'base_bill')} END",
    }))


def residential_bill_methods(df: DataFrame, year: int, kwh: float = 500.0) -> DataFrame:
    """Bill per customer from revenue, and for a fixed use from the average rate."""
    revenue = "revenue_residential_k * 1000"
    rate = f"try_divide({revenue}, sales_mwh_residential * 1000)"
    return df.where(f"report_year = {year}").selectExpr(
        *KEYS, "customers_residential", *named({
            "monthly_bill_actual": f"try_divide({revenue}, customers_residential) / 12",
            "rate_per_kwh": rate,
            "monthly_bill_usage": f"{rate} * {number(kwh)}",
        })
    )


def run_bill_analyses(df: DataFrame, base_year: int) -> dict[str, DataFrame]:
    return {
        "class_shares": class_shares(df),
        "bill_impacts": bill_impact(df, base_year),
        "sensitivity": bill_sensitivity(df, base_year),
    }
