"""Panel statistics: trend, growth, outliers, peer ranks, year-over-year change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.config import SUMMARY_METRICS
from panelspark.functions.columns import (
    add_columns,
    aggregate,
    cagr_pct,
    existing,
    explode_rows,
    known,
    named,
    pct_of,
    require_columns,
    row,
)
from panelspark.functions.distributions import t_pvalue
from panelspark.operators.ordering import ranked
from panelspark.operators.panel import start_from_baseline

ENTITY = "utility_id_ferc1"
YEAR = "report_year"
KEYS = [ENTITY, "utility_name", YEAR]
ENTITY_YEARS = f"OVER (PARTITION BY {ENTITY} ORDER BY {YEAR})"
FIRST_NAME = {"utility_name": f"min_by(utility_name, {YEAR})"}


def by_year(df: DataFrame) -> str:
    """The window of an entity's years.

    Rows without an accounting id have no entity: they are kept where rows are kept, spread by
    their other id so that they don't pile up in one task, and have no change.
    """
    if "utility_id_eia" not in df.columns:
        return ENTITY_YEARS
    other = f"CASE WHEN {ENTITY} IS NULL THEN utility_id_eia END"
    return f"OVER (PARTITION BY {ENTITY}, {other} ORDER BY {YEAR})"


def by_entity(df: DataFrame) -> DataFrame:
    """Cluster the panel by entity once.

    An entity has one row per year, so partial aggregation cannot shrink it: moving the rows
    themselves is cheaper than moving wide aggregation buffers, and every entity-level
    aggregate and window after it needs no further shuffle.
    """
    return known(df, ENTITY).repartition(ENTITY)


def _year_of(metric: str) -> str:
    """The year, only where the metric has a value."""
    return f"CASE WHEN {metric} IS NOT NULL THEN {YEAR} END"


def trend(df: DataFrame, metric: str, p_values: bool = True) -> DataFrame:
    """Linear trend and growth of a metric for every entity at once.

    Entities with fewer than two values are kept with status 'insufficient data'.
    """
    require_columns(df, [*KEYS, metric])
    rows = df.selectExpr(*KEYS, f"CAST({metric} AS DOUBLE) AS y", f"CAST({YEAR} AS DOUBLE) AS x")
    grouped = aggregate(by_entity(rows), [ENTITY], {
        **FIRST_NAME,
        "n": "count(y)",
        "slope": "regr_slope(y, x)",
        "intercept": "regr_intercept(y, x)",
        "r_squared": "CASE WHEN var_pop(y) = 0 THEN 0D ELSE regr_r2(y, x) END",
        "mean": "avg(y)",
        "std": "stddev_samp(y)",
        "first": f"min_by(y, {_year_of('y')})",
        "last": f"max_by(y, {_year_of('y')})",
        "n_years": f"max({_year_of('y')}) - min({_year_of('y')})",
    })
    values = {
        "slope": "slope",
        "intercept": "intercept",
        "r_squared": "r_squared",
        "cagr_percent": cagr_pct("first", "last", "n_years"),
        "mean": "mean",
        "std": "std",
        "coefficient_of_variation": pct_of("std", "mean"),
        "n_years": "n_years",
    }
    shaped = grouped.selectExpr(*named({
        "utility_id": ENTITY,
        "utility_name": "utility_name",
        "metric": f"'{metric}'",
        **{name: f"CASE WHEN n >= 2 THEN {value} END" for name, value in values.items()},
        "status": "CASE WHEN n >= 2 THEN 'ok' ELSE 'insufficient data' END",
        "dof": "CAST(n - 2 AS DOUBLE)",
    }))
    return _with_slope_pvalue(shaped) if p_values else shaped.drop("dof")


def _with_slope_pvalue(df: DataFrame) -> DataFrame:
    """Two-sided p-value of the slope. Two points fit exactly: p is 0, or 1 if flat."""
    tested = add_columns(df, {
        "t": "CASE WHEN dof > 0 AND r_squared < 1"
        " THEN sqrt(r_squared * dof / (1 - r_squared)) END",
        "exact": "CASE WHEN r_squared >= 1 THEN 0D WHEN dof = 0 AND r_squared = 0 THEN 1D"
        " WHEN dof = 0 AND slope IS NOT NULL THEN 0D END",
    })
    return tested.withColumn(
        "p_value", F.coalesce("exact", t_pvalue(F.col("t"), F.col("dof")))
    ).drop("t", "exact", "dof")


def summary_by_entity(df: DataFrame, metrics=SUMMARY_METRICS) -> DataFrame:
    """Mean, std, min, max and growth per entity and metric; fewer than two values are left out.

    The growth period spans all rows of the entity, also those where the metric is null.
    """
    metrics = existing(df, metrics)
    if not metrics:
        raise ValueError("No valid metrics found in data")
    grouped = aggregate(by_entity(df.select(*KEYS, *metrics)), [ENTITY], {
        **FIRST_NAME,
        "n_years": f"max({YEAR}) - min({YEAR})",
        **{
            m: f"struct(count({m}) AS n, avg({m}) AS mean, stddev_samp({m}) AS std,"
            f" min({m}) AS min, max({m}) AS max, min_by({m}, {_year_of(m)}) AS first,"
            f" max_by({m}, {_year_of(m)}) AS last)"
            for m in metrics
        },
    })
    long = explode_rows(grouped, [ENTITY, "utility_name", "n_years"], [
        row(
            metric=f"'{m}'",
            **{c: f"{m}.{c}" for c in ["n", "mean", "std", "min", "max"]},
            cagr_percent=cagr_pct(f"{m}.first", f"{m}.last", "n_years"),
        )
        for m in metrics
    ])
    return long.where("n >= 2").drop("n")


def cagr_by_count(df: DataFrame, metric: str) -> DataFrame:
    """Growth from first to last row, the period being the number of rows less one."""
    grouped = aggregate(by_entity(df.select(*KEYS, metric)), [ENTITY], {
        **FIRST_NAME,
        "first_value": f"min_by({metric}, {YEAR})",
        "last_value": f"max_by({metric}, {YEAR})",
        "n_periods": "count(1) - 1",
    })
    growth = cagr_pct("first_value", "last_value", "n_periods")
    return add_columns(grouped, {"cagr_percent": growth})


def cagr_from_baseline(df: DataFrame, baselines: DataFrame, metric: str) -> DataFrame:
    """Growth since each entity's baseline year (its first year if it has none)."""
    kept = start_from_baseline(df.select(*KEYS, metric), baselines)
    year = _year_of(metric)
    grouped = aggregate(by_entity(kept), [ENTITY], {
        **FIRST_NAME,
        "start_year": f"min({year})",
        "end_year": f"max({year})",
        "start_value": f"min_by({metric}, {year})",
        "end_value": f"max_by({metric}, {year})",
    })
    growth = cagr_pct("start_value", "end_value", "(end_year - start_year)")
    return add_columns(grouped, {"cagr_percent": growth})


def _pooled(df: DataFrame, metric: str) -> Column:
    """Mean and sample deviation of the whole frame as a one-row scalar subquery."""
    return df.agg(
        F.expr(f"struct(avg({metric}) AS mean, stddev_samp({metric}) AS std)")
    ).scalar()


def _with_z_score(df: DataFrame, metric: str) -> DataFrame:
    """0 when there is no spread."""
    score = (
        f"CASE WHEN pooled.std = 0 THEN 0D"
        f" ELSE try_divide({metric} - pooled.mean, pooled.std) END"
    )
    pooled = df.withColumn("pooled", _pooled(df, metric))
    return add_columns(pooled, {"z_score": score}).drop("pooled")


def outliers(df: DataFrame, metric: str, threshold: float = 2.0) -> DataFrame:
    """Rows whose pooled z-score is beyond the threshold. Reads `df` twice: stage it first."""
    require_columns(df, [metric])
    beyond = _with_z_score(df, metric).where(f"abs(z_score) > {float(threshold)}D")
    return beyond.withColumn("is_outlier", F.lit(True))


def in_year(df: DataFrame, year: int | None) -> DataFrame:
    """The rows of a year, by default of the latest one that the frame has."""
    wanted = df.agg(F.max(YEAR)).scalar() if year is None else F.lit(year)
    return df.where(F.col(YEAR) == wanted)


def peer_benchmark(df: DataFrame, year: int | None, metric: str) -> DataFrame:
    """z-score, percentile and rank of every entity in one year (None: the latest), in rank order.

    Reads `df` several times: stage it first. A null metric keeps its row, last and unranked.
    """
    require_columns(df, [metric])
    peers = in_year(df, year).select(ENTITY, "utility_name", metric)
    return ranked(_with_z_score(peers, metric), metric).orderBy(
        F.asc_nulls_last("rank"), ENTITY
    )


def yoy_change(df: DataFrame, metric: str) -> DataFrame:
    """Change against the entity's previous row, relative to its absolute value, in percent."""
    require_columns(df, [metric])
    previous = f"CASE WHEN {ENTITY} IS NOT NULL THEN lag({metric}) {by_year(df)} END"
    before = df.selectExpr(*KEYS, f"{metric} AS metric_value", f"{previous} AS previous")
    change = pct_of("metric_value - previous", "abs(previous)")
    return add_columns(before, {"yoy_pct_change": change}).drop("previous")


def yoy_cells(df: DataFrame, metric: str) -> DataFrame:
    """Signed change in percent after carrying the last value forward, with an outlier flag."""
    over = by_year(df)
    running = over[:-1] + " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    other = [c for c in df.columns if c == "utility_id_eia"]
    filled = df.selectExpr(*KEYS, *other, f"last({metric}, true) {running} AS v")
    change = f"(try_divide(v, lag(v) {over}) - 1D) * 100D"
    cells = filled.selectExpr(
        *KEYS, f"CASE WHEN {ENTITY} IS NOT NULL THEN {change} END AS om_yoy_pct"
    )
    flag = "coalesce(om_yoy_pct > 10 OR om_yoy_pct < -5, false)"
    return add_columns(cells, {"is_flagged": flag})


def yoy_matrix(df: DataFrame, metric: str, years) -> DataFrame:
    """One row per entity, one column per year. The first year has no change and is left out."""
    cells = yoy_cells(known(df.select(*KEYS, metric), ENTITY), metric)
    return aggregate(cells, [ENTITY, "utility_name"], {
        str(y): f"max(CASE WHEN {YEAR} = {y} THEN om_yoy_pct END)" for y in sorted(years)[1:]
    })


def peer_difference(df: DataFrame, year: int, metric: str) -> DataFrame:
    """Difference from the peer average in percent. Reads `df` twice: stage it first."""
    peers = df.where(f"{YEAR} = {year}").select(*KEYS, metric)
    average = peers.agg(F.avg(metric)).scalar()
    difference = pct_of(f"{metric} - peer_average", "peer_average")
    return add_columns(
        peers.withColumn("peer_average", average), {"pct_difference": difference}
    )


def variance_decomposition(df: DataFrame, outcome: str, driver: str) -> DataFrame:
    """How much of an entity's change the pooled slope explains. Reads `df` twice: stage it."""
    both = known(df.select(*KEYS, outcome, driver), outcome, driver)
    fit = both.agg(
        F.expr(
            f"struct(regr_slope({outcome}, {driver}) AS slope,"
            f" regr_r2({outcome}, {driver}) AS r_squared)"
        )
    ).scalar()
    change = aggregate(by_entity(both), [ENTITY], {
        **FIRST_NAME,
        "start_year": f"min({YEAR})",
        "end_year": f"max({YEAR})",
        "total_change": f"max_by({outcome}, {YEAR}) - min_by({outcome}, {YEAR})",
        "driver_change": f"max_by({driver}, {YEAR}) - min_by({driver}, {YEAR})",
    })
    explained = "(fit.slope * driver_change)"
    return add_columns(change.withColumn("fit", fit), {
        "slope": "fit.slope",
        "r_squared": "fit.r_squared",
        "explained": explained,
        "unexplained": f"total_change - {explained}",
        "pct_explained": pct_of(explained, "total_change"),
    }).drop("fit")
