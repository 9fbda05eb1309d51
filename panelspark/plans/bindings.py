"""The star-schema test tables read as accounting and sales filings.

Accounting filers are suppliers (expenses, from line items) and customers (plant and income, from
orders); sales filers are customers. Filer ids therefore overlap only in part, which gives the
full joins one-sided rows on every side, and the number of entities grows with the tables.
FIXTURES.md section 4 has the same rules as SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelspark.config import (
    ACCUMULATED_DEPRECIATION,
    CALCULATED,
    ELECTRIC,
    PLANT_IN_SERVICE,
    REPORTED,
    REVENUE_ACCOUNT,
    SECTORS,
    TARGET_STATE,
    WHOLE_CENTS,
)
from panelspark.functions.columns import aggregate, sum_amount
from panelspark.operators.panel import build_panel
from panelspark.sources import tables

YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]
BASE_YEAR = 2000
EIA_OFFSET = 14000

# Declared schemas: no job to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def in_years(df: DataFrame, column: str, years) -> DataFrame:
    """Year filter as a date range as well: the range reaches the parquet reader."""
    if years is None:
        return df
    return df.where(
        f"{column} >= TIMESTAMP_NTZ '{min(years)}-01-01'"
        f" AND {column} < TIMESTAMP_NTZ '{max(years) + 1}-01-01'"
        f" AND year({column}) IN ({', '.join(map(str, years))})"
    )


def expenses(spark: SparkSession, sf_dir: str, years=None) -> DataFrame:
    code = "CAST(500 + l_partkey % 440 AS STRING)"
    return in_years(read(spark, sf_dir, "lineitem"), "l_shipdate", years).selectExpr(
        "l_suppkey AS utility_id_ferc1",
        "year(l_shipdate) AS report_year",
        f"CASE WHEN l_linenumber = 7 THEN 'n/a' WHEN l_linenumber % 2 = 0"
        f" THEN concat({code}, '.', l_linenumber) ELSE {code} END AS ferc_account",
        "l_extendedprice AS dollar_value",
        f"CASE WHEN l_linestatus = 'F' THEN '{REPORTED}' ELSE '{CALCULATED}' END"
        " AS row_type_xbrl",
    )


UTILITY_TYPE = f"CASE WHEN o_orderpriority = '5-LOW' THEN 'gas' ELSE '{ELECTRIC}' END"


def plant(spark: SparkSession, sf_dir: str, years=None) -> DataFrame:
    rows = in_years(read(spark, sf_dir, "orders"), "o_orderdate", years).selectExpr(
        "o_custkey AS utility_id_ferc1",
        "year(o_orderdate) AS report_year",
        f"{UTILITY_TYPE} AS utility_type",
        f"CASE WHEN o_orderstatus = 'F' THEN '{ACCUMULATED_DEPRECIATION}'"
        f" ELSE '{PLANT_IN_SERVICE}' END AS utility_plant_asset_type",
        f"'{CALCULATED}' AS row_type_xbrl",
        "o_totalprice",
    )
    return aggregate(rows, rows.columns[:-1], {"ending_balance": sum_amount("o_totalprice", WHOLE_CENTS)})


def income(spark: SparkSession, sf_dir: str, years=None) -> DataFrame:
    return in_years(read(spark, sf_dir, "orders"), "o_orderdate", years).selectExpr(
        "o_custkey AS utility_id_ferc1",
        "year(o_orderdate) AS report_year",
        f"{UTILITY_TYPE} AS utility_type",
        f"CASE WHEN o_orderstatus = 'P' THEN '401' ELSE '{REVENUE_ACCOUNT}' END AS ferc_account",
        "o_orderpriority AS income_type",
        "o_totalprice AS dollar_value",
    )


PRIORITIES = {
    "residential": "o_orderpriority IN ('1-URGENT', '2-HIGH')",
    "commercial": "o_orderpriority = '3-MEDIUM'",
    "industrial": "o_orderpriority = '4-NOT SPECIFIED'",
    "total": "true",
}


def sales(spark: SparkSession, sf_dir: str, years=None) -> DataFrame:
    """Up to three landed rows (by order status) per customer and year.

    Orders are summed per customer before the customer join, so a customer with a large part of
    all orders is a few rows by then.
    """
    orders = in_years(read(spark, sf_dir, "orders"), "o_orderdate", years).selectExpr(
        "*", "year(o_orderdate) AS report_year", "CAST(day(o_orderdate) AS DOUBLE) AS mwh"
    )
    measures = {}
    for s in [*SECTORS, "total"]:
        dollars = sum_amount(f"CASE WHEN {PRIORITIES[s]} THEN o_totalprice END", WHOLE_CENTS)
        measures[f"revenue_{s}_k"] = f"{dollars} / 1000D"
        measures[f"sales_mwh_{s}"] = f"sum(CASE WHEN {PRIORITIES[s]} THEN mwh ELSE 0D END)"
        measures[f"customers_{s}"] = f"count_if({PRIORITIES[s]})"
    landed = aggregate(orders, ["o_custkey", "report_year", "o_orderstatus"], {
        "row_ordinal": "min(o_orderkey)", **measures
    })
    nations = read(spark, sf_dir, "nation").join(
        read(spark, sf_dir, "region").selectExpr("r_regionkey AS n_regionkey", "r_name"),
        "n_regionkey",
    )
    located = read(spark, sf_dir, "customer").join(
        nations.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey"
    )
    located = landed.join(located.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    return located.selectExpr(
        "report_year",
        f"o_custkey + {EIA_OFFSET} AS utility_id_eia",
        "c_name AS utility_name",
        f"CASE WHEN r_name = 'AFRICA' THEN 'NV' ELSE '{TARGET_STATE}' END AS state",
        "o_orderstatus AS ownership",
        *measures,
        "row_ordinal",
    )


def id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS utility_id_ferc1",
        f"s_suppkey + {EIA_OFFSET} AS utility_id_eia",
        "s_name AS utility_name",
    )


def baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities in distress (a low balance) are compared from 1997 on only."""
    return (
        read(spark, sf_dir, "supplier")
        .where("s_acctbal < 1000")
        .selectExpr("s_suppkey AS utility_id_ferc1", "1997 AS start_year")
    )


def panel(spark: SparkSession, sf_dir: str, years=None) -> DataFrame:
    """The final panel of all entities. `years` reaches the scans, so a one-year model reads one
    year. The test tables hold whole cents."""
    return build_panel(
        tables.expenses(expenses(spark, sf_dir, years)),
        tables.plant_wide(plant(spark, sf_dir, years)),
        tables.state_entities(sales(spark, sf_dir, years), TARGET_STATE),
        id_map(spark, sf_dir),
        tables.operating_revenue(income(spark, sf_dir, years), scale=WHOLE_CENTS),
        scale=WHOLE_CENTS,
    )
