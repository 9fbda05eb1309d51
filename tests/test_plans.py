"""Physical plans: what reaches the scan, what is joined how, what stays in the JVM."""

import re

import pytest

from panelspark import schemas
from panelspark.operators import bills, models, ordering, panel, stats
from panelspark.plans import bindings, registry
from panelspark.sources import tables


def plan_of(df):
    """The formatted plan: its node details are not cut short."""
    utils = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), "formatted")


def test_expense_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "expenses")
    spark.createDataFrame([(1, 2020, "500", 1.0, "reported_value")], schemas.EXPENSES).write.parquet(
        path)
    scan = tables.expenses(spark.read.schema(schemas.EXPENSES).parquet(path), [1, 2], [2020, 2021])
    text = plan_of(scan.select("dollar_value"))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "EqualTo(row_type_xbrl,reported_value)" in pushed
    assert "In(report_year, [2020,2021])" in pushed and "In(utility_id_ferc1, [1,2])" in pushed
    assert "ferc_account" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_base_year_reaches_the_scan(spark, sf_dir):
    text = plan_of(bindings.panel(spark, sf_dir, [2000]))
    assert text.count("GreaterThanOrEqual(o_orderdate") >= 3
    assert "GreaterThanOrEqual(l_shipdate" in text


def test_id_map_is_broadcast_by_size_not_by_hint(spark, sf_dir):
    text = plan_of(bindings.panel(spark, sf_dir))
    assert "BroadcastHashJoin" in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan_of(bindings.panel(spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("build", [
    lambda p: models.add_grc_requirement(models.add_requirement(p)),
    lambda p: models.wacc_sensitivity(p),
    lambda p: bills.bill_sensitivity(p, 2000),
    lambda p: bills.bill_impact(p, 2000),
])
def test_models_add_no_shuffle(spark, sf_dir, tmp_path, build):
    path = str(tmp_path / "panel")
    bindings.panel(spark, sf_dir, [2000]).write.parquet(path)
    text = build(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Join" not in text and "Window" not in text


def test_entity_statistics_shuffle_once(spark, sf_dir, tmp_path):
    path = str(tmp_path / "panel")
    bindings.panel(spark, sf_dir).write.parquet(path)
    ready = spark.read.parquet(path)
    for df in [stats.trend(ready, "om_total", p_values=False), stats.summary_by_entity(ready),
               stats.yoy_matrix(ready, "om_total", bindings.YEARS)]:
        text = df._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 1
        assert "SinglePartition" not in text


def test_no_cross_joins_and_windows_only_inside_an_entity(spark, sf_dir):
    for name in ["outliers", "bill_sensitivity", "rr_waterfall", "yoy_matrix", "kpi_formulas",
                 "peer_pct_diff", "variance_decomposition", "panel_final", "chart_om_trend"]:
        text = registry.REGISTRY[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        specs = re.findall(r"windowspecdefinition\((\w+)", text)
        assert set(specs) <= {"utility_id_ferc1"}, name


def test_ranks_are_windowed_by_range(spark):
    df = spark.range(1000).selectExpr("id", "CAST(id % 97 AS DOUBLE) AS v")
    text = ordering.ranked(df, "v", 100)._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"windowspecdefinition\((\w+)", text)) == {"bucket"}


def test_only_tail_probabilities_use_python(spark, sf_dir):
    python_nodes = ("ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "BatchEvalPython")
    for name in ["panel_final", "grc_requirement", "trend", "summary_by_entity", "bill_impact",
                 "rr_waterfall"]:
        text = registry.REGISTRY[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(node in text for node in python_nodes), name


def test_raw_rows_are_summed_before_they_move(spark, sf_dir):
    sums = panel.category_sums(tables.expenses(bindings.expenses(spark, sf_dir)))
    text = sums._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_sum") > text.index("Exchange hashpartitioning")
    assert text.count("Exchange") == 1


def test_plant_is_scanned_and_shuffled_once(spark, tmp_path):
    path = str(tmp_path / "plant")
    spark.createDataFrame([], schemas.PLANT).write.parquet(path)
    wide = tables.plant_wide(spark.read.schema(schemas.PLANT).parquet(path), None, [2020])
    text = wide._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "Join" not in text


def test_diagnostics_are_built_without_a_job(spark, sf_dir):
    context = spark.sparkContext
    context.setJobGroup("building", "building")
    try:
        registry.REGISTRY["ols_diagnostics"](spark, sf_dir)
        assert list(context.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
