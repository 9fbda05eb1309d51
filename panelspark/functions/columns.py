"""SQL expressions shared by the operators, and helpers to apply them.

Expressions are text: a model is then one `selectExpr` over named columns, whose plan Catalyst
builds in one step. Everything here stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelspark.config import (
    CATEGORY_RANGES,
    DEFAULTS,
    OTHER_CATEGORY,
    Assumptions,
)


def require_columns(df: DataFrame, columns) -> None:
    """Schema-only check; runs no job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def existing(df: DataFrame, columns) -> list[str]:
    return [c for c in columns if c in df.columns]


def col_or(df: DataFrame, name: str, fallback: str) -> str:
    """The column if the frame has it, else the fallback expression."""
    return name if name in df.columns else fallback


def named(expressions: dict[str, str]) -> list[str]:
    return [f"{text} AS `{name}`" for name, text in expressions.items()]


def add_columns(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """Add columns, or replace those that exist, in one projection."""
    columns = df.columns
    new = {n: t for n, t in expressions.items() if n not in columns}
    if len(new) == len(expressions):
        return df.selectExpr("*", *named(new))
    kept = [f"{expressions[c]} AS `{c}`" if c in expressions else f"`{c}`" for c in columns]
    return df.selectExpr(*kept, *named(new))


def aggregate(df: DataFrame, keys, expressions: dict[str, str]) -> DataFrame:
    """SELECT keys, expressions FROM df GROUP BY keys."""
    keys = [f"`{k}`" for k in keys]
    grouping = f" GROUP BY {', '.join(keys)}" if keys else ""
    select = ", ".join([*keys, *named(expressions)])
    return df.sparkSession.sql(f"SELECT {select} FROM {{df}}{grouping}", df=df)


def known(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where all these columns have a value."""
    return df.where(" AND ".join(f"{c} IS NOT NULL" for c in columns))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing is NULL only: one NaN would poison every sum and mean downstream."""
    floats = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    return add_columns(df, {c: f"nanvl(`{c}`, NULL)" for c in floats}) if floats else df


def number(x: float) -> str:
    """Double literal."""
    return f"{float(x)!r}D"


def text(s: str) -> str:
    """String literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def pct_of(part: str, whole: str) -> str:
    return f"(try_divide({part}, {whole}) * 100D)"


def sum_amount(amount: str, scale: int | None = None) -> str:
    """Sum of filed dollar amounts, 0 over nothing but nulls.

    The values are summed as they are. A caller whose amounts are whole multiples of 1/`scale`
    may say so: the sum then runs over 64-bit whole numbers and is the same in any order.
    """
    if scale is None:
        return f"coalesce(CAST(sum({amount}) AS DOUBLE), 0D)"
    cents = f"CAST(rint(({amount}) * {scale}) AS BIGINT)"
    return f"coalesce(sum({cents}) / {number(scale)}, 0D)"


def account_number(code: str) -> str:
    """Text code to number; NULL where it is not a plain decimal number.

    The last-character test rejects the d/f suffixes, 'inf' and 'nan' that the cast accepts;
    the x test rejects hexadecimal floats.
    """
    tail = f"right(rtrim({code}), 1)"
    return (
        f"CASE WHEN ({tail} BETWEEN '0' AND '9' OR {tail} = '.')"
        f" AND instr(lower({code}), 'x') = 0 THEN try_cast({code} AS DOUBLE) END"
    )


def category_number(number_column: str, ranges: dict | None = None) -> str:
    """Position of an account number's category; the position after the last one is 'other'.

    Ranges apply to the truncated number, which for positive bounds is lo <= x < hi + 1.
    """
    ranges = ranges or CATEGORY_RANGES
    cases = " ".join(
        f"WHEN {number_column} >= {lo} AND {number_column} < {hi + 1} THEN {i}"
        for i, (lo, hi) in enumerate(ranges.values())
    )
    return f"(CASE {cases} ELSE {len(ranges)} END)"


def category_name(position: str, ranges: dict | None = None) -> str:
    names = ", ".join(f"'{c}'" for c in [*(ranges or CATEGORY_RANGES), OTHER_CATEGORY])
    return f"element_at(array({names}), {position} + 1)"


def cagr_pct(first: str, last: str, n_years: str) -> str:
    """Compound growth in percent; NULL for a non-positive start, no elapsed years or NaN."""
    growth = f"(pow({last} / {first}, 1D / {n_years}) - 1D) * 100D"
    return f"(CASE WHEN {first} > 0 AND {n_years} > 0 THEN nanvl({growth}, NULL) END)"


def rate_base_return(rate_base: str, rate: str) -> str:
    """rate x rate base, 0 for a rate base of 0 or less."""
    return f"(CASE WHEN {rate_base} <= 0 THEN 0D ELSE {rate_base} * {rate} END)"


def _where_known(inputs, parts: dict[str, str]) -> dict[str, str]:
    given = " AND ".join(f"{c} IS NOT NULL" for c in inputs)
    return {name: f"(CASE WHEN {given} THEN {part} END)" for name, part in parts.items()}


def requirement_parts(
    om_total: str,
    om_other: str | None,
    rate_base: str,
    a: Assumptions = DEFAULTS,
    exclude_passthrough: bool = True,
    wacc: str | None = None,
) -> dict[str, str]:
    """Total revenue requirement: cost + depreciation + return, grossed up for tax.

    `om_other` (pass-through cost) is left out of the expense when given and excluded.
    """
    passthrough = "0D"
    if om_other is not None and exclude_passthrough:
        passthrough = f"coalesce({om_other}, 0D)"
    expense = f"({om_total} - {passthrough})"
    depreciation = rate_base_return(rate_base, number(a.depreciation_rate))
    return_on = rate_base_return(rate_base, wacc or number(a.wacc))
    pre_tax = f"({expense} + {depreciation} + {return_on})"
    taxes = f"({pre_tax} * {number(a.tax_rate)} / {number(1.0 - a.tax_rate)})"
    return _where_known([om_total, rate_base], {
        "om_expense": expense,
        "om_passthrough": passthrough,
        "depreciation": depreciation,
        "return_on_rate_base": return_on,
        "pre_tax_total": pre_tax,
        "taxes": taxes,
        "revenue_requirement": f"({pre_tax} + {taxes})",
    })


def allocated_om(distribution: str, customer_service: str, admin_general: str, share) -> str:
    return f"({distribution} + {customer_service} + {admin_general} * {share})"


def grc_parts(
    distribution: str,
    customer_service: str,
    admin_general: str,
    rate_base: str,
    a: Assumptions = DEFAULTS,
) -> dict[str, str]:
    """GRC revenue requirement: allocated cost + depreciation + return, simple tax."""
    share = number(a.ag_allocation)
    grc_om = allocated_om(distribution, customer_service, admin_general, share)
    depreciation = rate_base_return(rate_base, number(a.depreciation_rate))
    return_on = rate_base_return(rate_base, number(a.wacc))
    pre_tax = f"({grc_om} + {depreciation} + {return_on})"
    taxes = f"({pre_tax} * {number(a.grc_tax_rate)})"
    return _where_known([distribution, customer_service, admin_general, rate_base], {
        "grc_om": grc_om,
        "om_ag_allocated": f"({admin_general} * {share})",
        "depreciation": depreciation,
        "return_on_rate_base": return_on,
        "pre_tax_total": pre_tax,
        "taxes": taxes,
        "grc_revenue_requirement": f"({pre_tax} + {taxes})",
    })


def residential_bill(requirement: str, share: str, sales_mwh: str, kwh: float) -> dict[str, str]:
    """Average residential bill from an allocated requirement; NULL for invalid inputs."""
    allocated = f"({requirement} * {share})"
    sales_kwh = f"({sales_mwh} * 1000D)"
    rate = f"try_divide({allocated}, {sales_kwh})"
    valid = f"{sales_mwh} > 0 AND {share} BETWEEN 0 AND 1"
    parts = {
        "residential_rr": allocated,
        "residential_sales_kwh": sales_kwh,
        "avg_rate_per_kwh": rate,
        "monthly_bill": f"({rate} * {number(kwh)})",
    }
    return {name: f"(CASE WHEN {valid} THEN {part} END)" for name, part in parts.items()}


def _format_dollars(pattern: str, amount: str) -> str:
    return f"CASE WHEN {amount} IS NOT NULL THEN format_string('{pattern}', {amount}) END"


def format_billions(amount: str) -> str:
    return _format_dollars("$%.1fB", f"({amount} / 1e9D)")


def format_millions(amount: str) -> str:
    return _format_dollars("$%.0fM", f"({amount} / 1e6D)")


def row(**fields: str) -> str:
    """One literal row for `explode_rows`, a field per SQL expression."""
    return "named_struct(" + ", ".join(f"'{n}', {t}" for n, t in fields.items()) + ")"


def explode_rows(df: DataFrame, keep, rows: list[str]) -> DataFrame:
    """One output row per element of a literal row list: no join and no shuffle."""
    return df.selectExpr(*keep, f"inline(array({', '.join(rows)}))")
