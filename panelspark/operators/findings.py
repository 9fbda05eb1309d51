"""All statistics of a panel, and the findings drawn from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.columns import aggregate
from panelspark.operators import regression, stats
from panelspark.operators.stats import ENTITY, YEAR

COST_METRIC = "om_total"
PEER_METRIC = "om_per_customer"
SHOWN_OUTLIERS = 5


def run_analysis(panel: DataFrame) -> dict[str, DataFrame]:
    """Every statistic as a named frame. The panel is read many times: pass a staged one.

    A step that fails while it is built leaves `<name>_error`, one row with the message, and the
    others go on; frames are lazy, so whoever writes them does the same where they fail then.
    """
    drivers = ["utility_id_eia", YEAR, regression.OUTCOME, *regression.COST_DRIVERS]
    steps = {
        "trend_results": lambda: stats.trend(panel, COST_METRIC),
        "regression": lambda: regression.fit_terms(panel),
        "regression_summary": lambda: regression.diagnostics(
            panel.select(*drivers), drivers[:2]
        ),
        "condition_number": lambda: regression.condition_number(panel),
        "vif": lambda: regression.vif(panel),
        "outliers": lambda: stats.outliers(panel, PEER_METRIC),
        "benchmarks": lambda: stats.peer_benchmark(panel, None, PEER_METRIC),
        "yoy_changes": lambda: stats.yoy_change(panel, COST_METRIC),
        "utility_summaries": lambda: stats.summary_by_entity(panel),
    }
    results = {}
    for name, step in steps.items():
        try:
            results[name] = step()
        except Exception as error:  # the step's own message is the result
            results[f"{name}_error"] = failed(panel, error)
    return results


def failed(panel: DataFrame, error: Exception) -> DataFrame:
    """One row with the error's message."""
    message = str(error).splitlines()[0] if str(error) else type(error).__name__
    return panel.sparkSession.createDataFrame([(message,)], "message string")


def key_findings(panel: DataFrame) -> DataFrame:
    """(ordinal, finding, subject, value) rows. Pass a staged panel."""
    latest = stats.in_year(panel, None)
    growth = stats.trend(panel, COST_METRIC, p_values=False).where("status = 'ok'")
    terms = regression.significant_terms(regression.fit_terms(panel))
    collinear = regression.high_vif(regression.vif(panel))
    flagged = stats.outliers(panel, PEER_METRIC)
    shown = flagged.orderBy("utility_id_eia", YEAR).limit(SHOWN_OUTLIERS)
    counted = aggregate(flagged, [], {"n": "CAST(count(1) AS DOUBLE)"})
    found = [
        _lines(1, "highest cost per customer", _largest(latest, PEER_METRIC, ENTITY),
               "utility_name", PEER_METRIC),
        _lines(2, "fastest cost growth", _largest(growth, "cagr_percent", "utility_id"),
               "utility_name", "cagr_percent"),
        _lines(3, "significant driver", terms, "term", "p_value"),
        _lines(4, "collinear driver", collinear, "variable", "vif"),
        _lines(5, "outlier count", counted, "'all'", "n"),
        _lines(6, "outlier", shown, f"concat_ws(' ', utility_name, {YEAR})", "z_score"),
    ]
    return reduce(DataFrame.unionByName, found)


def _lines(ordinal: int, name: str, df: DataFrame, subject: str, value: str) -> DataFrame:
    return df.selectExpr(
        f"{ordinal} AS ordinal", f"'{name}' AS finding", f"{subject} AS subject",
        f"{value} AS value",
    )


def _largest(df: DataFrame, metric: str, tie_breaker: str) -> DataFrame:
    """The row with the largest metric; nulls lose, ties go to the lowest id."""
    return df.orderBy(F.desc_nulls_last(metric), tie_breaker).limit(1)
