"""Datasets behind the usual charts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelspark.config import DEFAULTS, Assumptions
from panelspark.functions.columns import (
    add_columns,
    allocated_om,
    cagr_pct,
    col_or,
    explode_rows,
    format_billions,
    known,
    named,
    number,
    row,
)
from panelspark.operators.stats import (
    ENTITY,
    KEYS,
    YEAR,
    peer_difference,
    yoy_cells,
    yoy_matrix,
)


def om_trend(df: DataFrame) -> DataFrame:
    """Cost in billions per entity and year, with the entity's growth and its label.

    The period is the number of rows less one. One clustering by entity serves the window.
    """
    entity = f"OVER (PARTITION BY {ENTITY})"
    ends = known(df, ENTITY).selectExpr(*KEYS, "om_total", *named({
        "first_om": f"min_by(om_total, {YEAR}) {entity}",
        "last_om": f"max_by(om_total, {YEAR}) {entity}",
        "periods": f"count(1) {entity} - 1",
    }))
    growth = {"cagr_percent": cagr_pct("first_om", "last_om", "periods")}
    label = "format_string('%s: %+.1f%%', utility_name, cagr_percent)"
    return add_columns(ends, growth).selectExpr(*KEYS, "cagr_percent", *named({
        "om_billions": "om_total / 1e9D",
        "cagr_label": f"CASE WHEN cagr_percent IS NOT NULL THEN {label} END",
    }))


def peer_comparison(df: DataFrame, year: int, a: Assumptions = DEFAULTS) -> DataFrame:
    """Allocated cost per customer against the peer average; computed if the column is absent."""
    cost = allocated_om(
        "om_distribution", "om_customer_service", "om_admin_general", number(a.ag_allocation)
    )
    metric = "grc_om_per_customer"
    value = col_or(df, metric, f"try_divide({cost}, customers_total)")
    return peer_difference(add_columns(df, {metric: value}), year, metric)


def requirement_waterfall(df: DataFrame, a: Assumptions = DEFAULTS) -> DataFrame:
    """Running start and height of each component, then the total from 0, per entity and year.

    Starts are sums of the columns before, so the running total needs no window.
    """
    allocated = f"om_admin_general * {number(a.ag_allocation)}"
    components = {  # fixed values: the labels
        "Distribution O&M": "om_distribution",
        "Customer Service": "om_customer_service",
        "A&G (70%)": col_or(df, "om_ag_allocated", allocated),
        "Depreciation": col_or(df, "grc_depreciation", "depreciation"),
        "Return on Rate Base": col_or(df, "grc_return_on_rate_base", "return_on_rate_base"),
        "Taxes (15%)": col_or(df, "grc_taxes", "taxes"),
    }
    total = col_or(df, "grc_revenue_requirement", "revenue_requirement")
    start, rows = "0D", []
    for i, (name, height) in enumerate(components.items(), start=1):
        rows.append(row(step=str(i), component=f"'{name}'", start=start, height=height))
        start = f"({start} + {height})"
    rows.append(
        row(
            step=str(len(rows) + 1),
            component="'GRC Revenue Requirement'",
            start="0D",
            height=total,
        )
    )
    return add_columns(explode_rows(df, KEYS, rows), {"label": format_billions("height")})


def revenue_gap(df: DataFrame, year: int) -> DataFrame:
    """Gap in billions with its sign class."""
    side = (
        "CASE WHEN revenue_gap < 0 THEN 'over-collecting'"
        " WHEN revenue_gap >= 0 THEN 'under-collecting' END"
    )
    return df.where(f"{YEAR} = {year}").selectExpr(*KEYS, "revenue_gap_pct", *named({
        "gap_billions": "revenue_gap / 1e9D",
        "collection": side,
    }))


def bill_impact(bills: DataFrame) -> DataFrame:
    """Current and proposed bill as rows, with the percent change on the proposed one."""
    return explode_rows(bills, [ENTITY, "utility_name"], [
        row(
            series="'Current'",
            monthly_bill="current_monthly_bill",
            change_pct="CAST(NULL AS DOUBLE)",
        ),
        row(
            series="'Proposed'",
            monthly_bill="proposed_monthly_bill",
            change_pct="monthly_change_pct",
        ),
    ])


def all_charts(
    panel: DataFrame, requirement: DataFrame, bills: DataFrame, year: int, years
) -> dict[str, DataFrame]:
    return {
        "om_trend": om_trend(panel),
        "peer_comparison": peer_comparison(panel, year),
        "rr_waterfall": requirement_waterfall(requirement.where(f"{YEAR} = {year}")),
        "revenue_gap": revenue_gap(requirement, year),
        "bill_impact": bill_impact(bills),
        "yoy_heatmap": yoy_matrix(panel, "om_total", years),
        "yoy_cells": yoy_cells(panel, "om_total"),
    }
