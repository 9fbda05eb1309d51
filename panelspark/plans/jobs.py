"""The three jobs: build and model a panel, analyse it, write the chart datasets.

    spark-submit panel_job.py panel --expenses ... --out /warehouse/panel
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark import schemas
from panelspark.config import DEFAULTS, TARGET_STATE, YEARS, Assumptions
from panelspark.operators import bills, charts, findings, models, panel
from panelspark.sources import sinks, tables
from panelspark.sources.workbook import read_workbooks


@dataclass(frozen=True)
class Inputs:
    """Paths of the landed tables. `sales` is a glob of workbooks or CSV files, or a parquet path."""

    expenses: str
    plant: str
    income: str
    sales: str
    id_map: str | None = None
    years: list[int] = field(default_factory=lambda: list(YEARS))
    state: str = TARGET_STATE
    amount_scale: int | None = None  # 100 if all amounts are whole cents


def load_sales(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".xlsx"):
        return read_workbooks(spark, path)
    if path.endswith(".csv"):
        rows = spark.read.schema(schemas.SALES).csv(path, header=True)
        return tables.nan_to_null(rows)
    required = ["report_year", "utility_id_eia", "utility_name", "state", "row_ordinal"]
    return tables.read_table(spark, path, schemas.SALES, required)


def run_panel(
    spark: SparkSession, inputs: Inputs, out: str, a: Assumptions = DEFAULTS
) -> DataFrame:
    """Build, write, check and only then publish the panel; returns the published table. A panel that
    fails its check leaves the earlier one in place."""
    if inputs.id_map is None:
        ids = tables.id_map(spark)
    else:
        ids = tables.read_table(spark, inputs.id_map, schemas.ID_MAP)
    ferc_ids = ids.select("utility_id_ferc1")
    eia_ids = ids.select("utility_id_eia")
    income = tables.read_table(spark, inputs.income, schemas.INCOME)
    sales = load_sales(spark, inputs.sales)
    built = panel.build_panel(
        tables.expenses(
            tables.read_table(spark, inputs.expenses, schemas.EXPENSES), ferc_ids, inputs.years
        ),
        tables.plant_wide(
            tables.read_table(spark, inputs.plant, schemas.PLANT), ferc_ids, inputs.years
        ),
        tables.state_entities(
            sales.where(F.col("report_year").isin(inputs.years)), inputs.state, eia_ids
        ),
        ids,
        tables.operating_revenue(income, ferc_ids, inputs.years, inputs.amount_scale),
        a,
        inputs.amount_scale,
    )
    path = f"{out}/analysis_ready"
    entities = ids.agg(F.count(F.lit(1))).scalar()

    def check(written: DataFrame) -> None:
        panel.assert_valid(panel.validate_panel(written, entities * len(inputs.years)))

    sinks.write_table(built, path, check=check)
    return spark.read.schema(built.schema).parquet(path)


def run_models(
    ready: DataFrame, base_year: int, out: str | None = None, a: Assumptions = DEFAULTS
) -> dict[str, DataFrame]:
    """Requirements, forecast and bills from a written panel."""
    results = {
        "rr_dataset": models.add_grc_requirement(models.add_requirement(ready, a), a),
        "test_year_forecast": models.forecast_test_year(ready, base_year, a),
        **bills.run_bill_analyses(ready, base_year),
    }
    if out is not None:
        sinks.write_table(results["rr_dataset"], f"{out}/revenue_requirement")
        sinks.write_table(results["bill_impacts"], f"{out}/bill_impact")
    return results


def summary_tables(results: dict[str, DataFrame], year: int) -> dict[str, DataFrame]:
    """The tables behind the printed summary of a year."""
    requirement = results["rr_dataset"]
    return {
        "requirement": requirement.where(requirement.report_year == year).select(
            "utility_id_ferc1",
            "utility_name",
            "revenue_requirement",
            "grc_revenue_requirement",
            "revenue_gap",
            "revenue_gap_pct",
        ),
        "methodology": models.compare_methodologies(requirement, year),
        "forecast": results["test_year_forecast"],
        "bills": results["bill_impacts"],
    }


def run_statistics(ready: DataFrame, out: str) -> dict[str, DataFrame]:
    """Writes every statistic; one that fails, at whatever point, leaves `<name>_error` instead."""
    results = findings.run_analysis(ready)
    try:
        results["key_findings"] = findings.key_findings(ready)
    except Exception as error:
        results["key_findings_error"] = findings.failed(ready, error)
    written = {}
    for name, df in results.items():
        try:
            sinks.write_bundle({name: df}, f"{out}/analysis_results")
        except Exception as error:
            name, df = f"{name}_error", findings.failed(ready, error)
            sinks.write_bundle({name: df}, f"{out}/analysis_results")
        written[name] = df
    return written


def run_charts(spark: SparkSession, out: str, year: int, years) -> dict[str, DataFrame]:
    """Chart datasets from the three written tables."""
    datasets = charts.all_charts(
        tables.read_table(spark, f"{out}/analysis_ready"),
        tables.read_table(spark, f"{out}/revenue_requirement"),
        tables.read_table(spark, f"{out}/bill_impact"),
        year,
        years,
    )
    for name, df in datasets.items():
        sinks.write_table(df, f"{out}/charts/{name}")
    return datasets


def main(argv) -> None:
    parser = argparse.ArgumentParser(prog="panelspark")
    parser.add_argument("job", choices=["panel", "statistics", "charts"])
    parser.add_argument("--out", required=True)
    for name in ["expenses", "plant", "income", "sales", "id-map"]:
        parser.add_argument(f"--{name}")
    parser.add_argument("--years", type=int, nargs="+", default=YEARS)
    parser.add_argument("--base-year", type=int)
    args = parser.parse_args(argv)
    base_year = args.base_year or max(args.years)
    spark = SparkSession.builder.appName(f"panelspark-{args.job}").getOrCreate()
    if args.job == "panel":
        inputs = Inputs(
            args.expenses, args.plant, args.income, args.sales, args.id_map, args.years
        )
        run_models(run_panel(spark, inputs, args.out), base_year, args.out)
    elif args.job == "statistics":
        run_statistics(tables.read_table(spark, f"{args.out}/analysis_ready"), args.out)
    else:
        run_charts(spark, args.out, base_year, args.years)
