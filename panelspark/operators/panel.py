"""Long accounting and sales tables to one wide row per entity and year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.config import CATEGORIES, DEFAULTS, OM_COLUMNS, Assumptions
from panelspark.functions.columns import (
    account_number,
    add_columns,
    aggregate,
    allocated_om,
    category_name,
    category_number,
    existing,
    explode_rows,
    known,
    number,
    require_columns,
    row,
    sum_amount,
)
from panelspark.schemas import PANEL_COLUMNS
from panelspark.sources.tables import KEYS

SALES_KEYS = ["utility_id_eia", "report_year"]


def roll_up_duplicates(df: DataFrame, keys=SALES_KEYS, ordinal="row_ordinal") -> DataFrame:
    """Sum numbers and keep the first non-null text per key, first by `ordinal`."""
    rolled = {}
    for field in df.schema:
        name = field.name
        if name in (*keys, ordinal):
            continue
        if isinstance(field.dataType, T.NumericType):
            rolled[name] = f"coalesce(sum({name}), 0)"
        else:
            rolled[name] = f"min_by({name}, CASE WHEN {name} IS NOT NULL THEN {ordinal} END)"
    return aggregate(known(df, *keys), keys, rolled)


def _numbered(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", f"{account_number('ferc_account')} AS account_number")


def categorize(df: DataFrame) -> DataFrame:
    """Functional category of each row's account code."""
    name = category_name(category_number("account_number"))
    return _numbered(df).selectExpr(*df.columns, f"{name} AS category")


def category_sums(df: DataFrame, scale: int | None = None) -> DataFrame:
    """Amount per entity, year and category: the only shuffle that sees raw rows.

    Partial sums collapse a hot entity to at most one row per task, year and category, and the
    category travels as a number.
    """
    rows = _numbered(known(df, *KEYS)).selectExpr(
        *KEYS, "dollar_value", f"{category_number('account_number')} AS position"
    )
    sums = aggregate(rows, [*KEYS, "position"], {"amount": sum_amount("dollar_value", scale)})
    return sums.selectExpr(*KEYS, f"{category_name('position')} AS category", "amount")


def pivot_expenses(sums: DataFrame) -> DataFrame:
    """Categories as columns, 0 where a category is absent, and their total."""
    wide = aggregate(sums, KEYS, {
        f"om_{c}": f"coalesce(max(CASE WHEN category = '{c}' THEN amount END), 0D)"
        for c in CATEGORIES
    })
    return wide.selectExpr("*", f"{' + '.join(OM_COLUMNS)} AS om_total")


def with_rate_base(df: DataFrame) -> DataFrame:
    balance = "utility_plant_in_service - accumulated_provision_for_depreciation"
    return add_columns(df, {"rate_base": balance})


def join_panel(
    expenses: DataFrame,
    plant: DataFrame,
    sales: DataFrame,
    id_map: DataFrame,
    revenues: DataFrame | None = None,
) -> DataFrame:
    """expenses (full) plant (left) revenues (left) ID map (full) sales."""
    combined = expenses.join(plant.select(*KEYS, "rate_base"), on=KEYS, how="full")
    if revenues is not None:
        combined = combined.join(
            revenues.select(*KEYS, "operating_revenues_ferc"), on=KEYS, how="left"
        )
    names = id_map.selectExpr(
        "utility_id_ferc1", "utility_id_eia", "utility_name AS map_name"
    )
    combined = combined.join(names, on="utility_id_ferc1", how="left")
    sold = sales.drop("row_ordinal").withColumnRenamed("utility_name", "sales_name")
    joined = _full_join_on_nullable_id(combined, sold)
    name = "coalesce(map_name, sales_name) AS utility_name"
    return joined.selectExpr("*", name).drop("map_name", "sales_name")


def _full_join_on_nullable_id(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full join where many left rows have no id.

    NULL keys never match, but they all hash alike: every unmapped row of a year would land in
    one task. They join on their own entity id under a flag the right side never has.
    """
    id_columns = ("utility_id_eia IS NULL AS unmapped",
                  "CAST(coalesce(utility_id_eia, utility_id_ferc1) AS BIGINT) AS join_id")
    left = left.selectExpr("*", *id_columns).drop("utility_id_eia")
    right = right.selectExpr(
        "*", "false AS unmapped", "CAST(utility_id_eia AS BIGINT) AS join_id"
    ).drop("utility_id_eia")
    joined = left.join(right, on=["unmapped", "join_id", "report_year"], how="full")
    eia_id = "CASE WHEN NOT unmapped THEN join_id END AS utility_id_eia"
    return joined.selectExpr("*", eia_id).drop("unmapped", "join_id")


def derive_metrics(df: DataFrame, a: Assumptions = DEFAULTS) -> DataFrame:
    """Allocated cost and per-customer / per-unit ratios, NULL for a zero denominator."""
    grc_om = allocated_om(
        "om_distribution", "om_customer_service", "om_admin_general", number(a.ag_allocation)
    )
    if "customers_total" not in df.columns:
        return add_columns(df, {"grc_om": grc_om})
    return add_columns(df, {
        "grc_om": grc_om,
        "om_per_customer": "try_divide(om_total, customers_total)",
        "grc_om_per_customer": f"try_divide({grc_om}, customers_total)",
        "om_per_mwh": "try_divide(om_total, sales_mwh_total)",
        "rate_base_per_customer": "try_divide(rate_base, customers_total)",
        "revenue_per_customer": "try_divide(revenue_total_k * 1000, customers_total)",
    })


def select_panel(df: DataFrame) -> DataFrame:
    return df.select(*existing(df, PANEL_COLUMNS))


def build_panel(
    expenses: DataFrame,
    plant_wide: DataFrame,
    sales: DataFrame,
    id_map: DataFrame,
    revenues: DataFrame | None = None,
    a: Assumptions = DEFAULTS,
    scale: int | None = None,
) -> DataFrame:
    """From scanned tables to the final panel, as one plan."""
    joined = join_panel(
        pivot_expenses(category_sums(expenses, scale)),
        with_rate_base(plant_wide),
        roll_up_duplicates(sales),
        id_map,
        revenues,
    )
    return select_panel(derive_metrics(joined, a))


def start_from_baseline(df: DataFrame, baselines: DataFrame) -> DataFrame:
    """Drop an entity's years before its baseline year; entities without one keep all years.

    `baselines` is (utility_id_ferc1, start_year), one row per entity.
    """
    started = df.join(baselines, on="utility_id_ferc1", how="left")
    return started.where("start_year IS NULL OR report_year >= start_year").drop("start_year")


CRITICAL = ["utility_id_ferc1", "utility_id_eia", "report_year"]
REQUIRED = ["utility_id_ferc1", "utility_id_eia", "utility_name", "report_year", "om_total"]


def validate_panel(df: DataFrame, expected_rows) -> DataFrame:
    """(check, observed, limit, passed) rows from one aggregate pass.

    `expected_rows` is entities x years, a number or a column.
    """
    require_columns(df, REQUIRED)
    expected = expected_rows if not isinstance(expected_rows, (int, float)) else F.lit(
        float(expected_rows)
    )
    stats = df.agg(
        F.expr("count(1) AS row_count"),
        F.count_distinct(F.struct(*KEYS, "utility_id_eia")).alias("keys"),
        *[F.expr(f"count_if({c} IS NULL) AS null_{c}") for c in CRITICAL],
    ).withColumn("half", expected.cast("double") * 0.5)

    def check(name: str, observed: str, limit: str, passed: str) -> str:
        return row(
            check=f"'{name}'",
            observed=f"CAST({observed} AS DOUBLE)",
            limit=limit,
            passed=passed,
        )

    return explode_rows(stats, [], [
        check("not_empty", "row_count", "1D", "row_count >= 1"),
        check("row_count", "row_count", "half", "row_count >= half"),
        *[check(f"null_{c}", f"null_{c}", "0D", f"null_{c} = 0") for c in CRITICAL],
        check("duplicate_rows", "row_count - keys", "0D", "row_count = keys"),
    ])


def assert_valid(checks: DataFrame) -> None:
    """Raise at a sink when a check failed. There are a handful of check rows."""
    failed = [r["check"] for r in checks.where(~F.col("passed")).collect()]
    if failed:
        raise ValueError(f"Panel validation failed: {failed}")


def profile(
    df: DataFrame, entity="utility_id_ferc1", year="report_year", head: int = 0, order=(), shown=None
) -> DataFrame:
    """(stat, value, shown) rows: row count, distinct entities and years, nulls per column as values;
    with `head`, the columns `shown` (all by default) of the first so many rows in the order of
    `order`, as text under head_<n>_<column>. A task keeps no more than `head` rows for that.
    """
    stats = df.agg(
        F.expr("count(1) AS row_count"),
        F.count_distinct(entity).alias("distinct_entities"),
        F.count_distinct(year).alias("distinct_years"),
        *[F.expr(f"count_if({c} IS NULL) AS nulls_{c}") for c in df.columns],
    )
    none = "CAST(NULL AS STRING)"
    counts = explode_rows(stats, [], [
        row(stat=f"'{c}'", value=c, shown=none) for c in stats.columns
    ])
    if not head:
        return counts
    shown = list(df.columns if shown is None else shown)
    first = df.orderBy(*order).limit(head).select(
        F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)]).alias("place"),
        *[F.col(c).cast("string").alias(c) for c in shown],
    )
    numbered = first.agg(
        F.array_sort(F.collect_list(F.struct("place", *shown))).alias("rows")
    ).selectExpr("posexplode(rows) AS (n, r)")
    cells = [
        row(stat=f"concat('head_', n + 1, '_{c}')", value="CAST(NULL AS BIGINT)", shown=f"r.{c}")
        for c in shown
    ]
    return counts.unionByName(explode_rows(numbered, [], cells))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def top_accounts(df: DataFrame, n: int = 20, scale: int | None = None) -> DataFrame:
    """The n accounts with the largest summed amount; ties by account code."""
    totals = aggregate(
        known(df, "ferc_account"), ["ferc_account"], {"dollar_value": sum_amount("dollar_value", scale)}
    )
    return totals.orderBy(F.desc("dollar_value"), "ferc_account").limit(n)
