"""Scans of the accounting and sales tables.

Filters are plain column predicates, so Catalyst pushes them to the parquet reader.
`ids` is either a short list (IN) or a one-column frame (left semi join, broadcast or
shuffled as its measured size allows).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.config import (
    ACCUMULATED_DEPRECIATION,
    CALCULATED,
    ELECTRIC,
    PLANT_IN_SERVICE,
    REPORTED,
    REVENUE_ACCOUNT,
    UTILITY_IDS,
)
from panelspark.functions.columns import (
    aggregate,
    existing,
    known,
    nan_to_null,
    require_columns,
    sum_amount,
)
from panelspark.schemas import ID_MAP

KEYS = ["utility_id_ferc1", "report_year"]


def conform(df: DataFrame, schema: T.StructType, required=None) -> DataFrame:
    """The declared columns, in order. A column of another type family is cast, a value that does
    not fit becoming NULL; integers of any width stay as filed, so filters on them still reach
    the parquet reader. `required` defaults to all columns; others may be absent.
    """
    require_columns(df, schema.names if required is None else required)
    filed = {f.name: f.dataType for f in df.schema}

    def column(field: T.StructField) -> str:
        same = filed[field.name] == field.dataType or (
            isinstance(filed[field.name], T.IntegralType)
            and isinstance(field.dataType, T.IntegralType)
        )
        cast = f"try_cast({field.name} AS {field.dataType.simpleString()}) AS {field.name}"
        return field.name if same else cast

    return df.selectExpr(*[column(f) for f in schema if f.name in filed])


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, required=None
) -> DataFrame:
    """Parquet with a declared schema; a missing path raises AnalysisException."""
    df = spark.read.parquet(path)
    return nan_to_null(df if schema is None else conform(df, schema, required))


def member_of(df: DataFrame, column: str, ids) -> DataFrame:
    """Membership filter by list or by frame."""
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        # Distinct, so that a frame of raw rows is summed up before it moves.
        wanted = ids.select(F.col(ids.columns[0]).alias(column)).distinct()
        return df.join(wanted, column, "left_semi")
    return df.where(F.col(column).isin(list(ids)))


def _scan(df: DataFrame, ids, years, condition: str) -> DataFrame:
    df = df.where(condition)
    if years is not None:
        df = df.where(F.col("report_year").isin(list(years)))
    return member_of(df, "utility_id_ferc1", ids)


def expenses(df: DataFrame, ids=None, years=None) -> DataFrame:
    """Reported rows only: the calculated ones are subtotals and would count twice."""
    return _scan(df, ids, years, f"row_type_xbrl = '{REPORTED}'")


def plant(df: DataFrame, ids=None, years=None) -> DataFrame:
    return _scan(df, ids, years, f"utility_type = '{ELECTRIC}'")


def plant_wide(df: DataFrame, ids=None, years=None) -> DataFrame:
    """Two asset types side by side per entity and year, from one scan and one shuffle.

    As a full join would have it: a key found on one side only is kept, repeated keys pair up, and a
    row without a whole key stays alone. A key's filed balances are two arrays of its group, and
    the result stays clustered by the key.
    """
    electric = plant(df, ids, years).where(
        f"row_type_xbrl = '{CALCULATED}'"
        f" AND utility_plant_asset_type IN ('{PLANT_IN_SERVICE}', '{ACCUMULATED_DEPRECIATION}')"
    )
    incomplete = " OR ".join(f"{k} IS NULL" for k in KEYS)
    rows = electric.selectExpr(
        *KEYS,
        f"utility_plant_asset_type = '{PLANT_IN_SERVICE}' AS gross",
        "struct(CAST(ending_balance AS DOUBLE) AS balance) AS filed",
        f"CASE WHEN {incomplete} THEN monotonically_increasing_id() END AS alone",
    ).repartition(*KEYS)
    sides = aggregate(rows, [*KEYS, "alone"], {
        "gross": "collect_list(CASE WHEN gross THEN filed END)",
        "provision": "collect_list(CASE WHEN NOT gross THEN filed END)",
    })
    paired = sides.selectExpr(*KEYS, "provision", "explode_outer(gross) AS g").selectExpr(
        *KEYS, "g", "explode_outer(provision) AS p"
    )
    return paired.selectExpr(
        *KEYS, "g.balance AS utility_plant_in_service",
        "p.balance AS accumulated_provision_for_depreciation",
    )


def income(df: DataFrame, ids=None, years=None) -> DataFrame:
    return _scan(df, ids, years, f"utility_type = '{ELECTRIC}'")


def operating_revenue(
    df: DataFrame, ids=None, years=None, scale: int | None = None
) -> DataFrame:
    """Sum of the revenue account per entity and year.

    Membership is stated on the sums: Catalyst moves it below them when the ids can be broadcast,
    and otherwise raw rows are not shuffled for it.
    """
    rows = income(df, None, years).where(f"ferc_account = '{REVENUE_ACCOUNT}'")
    total = {"operating_revenues_ferc": sum_amount("dollar_value", scale)}
    return member_of(aggregate(known(rows, *KEYS), KEYS, total), "utility_id_ferc1", ids)


def association(df: DataFrame, ids=None) -> DataFrame:
    return member_of(df, "utility_id_ferc1", ids)


def id_map(spark: SparkSession, rows=UTILITY_IDS) -> DataFrame:
    """ID map from (name, accounting id, sales id) rows."""
    return spark.createDataFrame([(ferc, eia, name) for name, ferc, eia in rows], ID_MAP)


def union_years(frames, required=("report_year", "utility_id_eia", "state")) -> DataFrame:
    """Yearly frames on top of each other; a column one year lacks becomes NULL there."""
    frames = list(frames)
    if not frames:
        raise ValueError("No yearly data to combine")
    combined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    require_columns(combined, required)
    return combined


def read_yearly_sales(spark: SparkSession, pattern: str, years, columns=None) -> DataFrame:
    """One parquet landing per year, `pattern` holding {year}; keeps the columns that exist."""

    def one(year: int) -> DataFrame:
        df = spark.read.parquet(pattern.format(year=year))
        if "report_year" not in df.columns:
            df = df.withColumn("report_year", F.lit(year))
        return nan_to_null(df if columns is None else df.select(*existing(df, columns)))

    return union_years(one(year) for year in years)


def state_entities(df: DataFrame, state: str, ids=None) -> DataFrame:
    """Sales rows of one state and a set of entities."""
    return member_of(df.where(F.col("state") == F.lit(state)), "utility_id_eia", ids)
