"""Workbook source, sinks and the jobs from landed files to chart datasets."""

import io
import zipfile

import pytest

from panelspark import config, schemas
from panelspark.operators import findings
from panelspark.plans import jobs, registry
from panelspark.sources import sinks, tables, workbook
from panelspark.sources.workbook import number_repeats, read_workbooks, sheet_rows
from panelspark.sources.workbook_format import ROWS_PER_WORKBOOK, WorkbookFormat

HEADER = ["Data Year", "Utility Number", "Utility Name", "State", "Ownership",
          *["Thousand Dollars", "Megawatthours", "Count"] * 5]


def column_name(i):
    name = ""
    i += 1
    while i:
        i, rest = divmod(i - 1, 26)
        name = chr(ord("A") + rest) + name
    return name


def write_workbook(path, rows):
    """A minimal workbook: text as shared strings, numbers inline, empty cells left out."""
    strings, lines = [], []
    for r, cells in enumerate([["Sales"], ["by sector"], HEADER, *rows], start=1):
        parts = []
        for i, value in enumerate(cells):
            ref = f"{column_name(i)}{r}"
            if isinstance(value, str):
                parts.append(f'<c r="{ref}" t="s"><v>{len(strings)}</v></c>')
                strings.append(f"<si><t>{value.replace('&', '&amp;')}</t></si>")
            elif value is not None:
                parts.append(f'<c r="{ref}"><v>{value}</v></c>')
        lines.append(f'<row r="{r}">{"".join(parts)}</row>')
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/sharedStrings.xml", f"<sst {ns}>{''.join(strings)}</sst>")
        book.writestr("xl/worksheets/sheet1.xml",
                      f"<worksheet {ns}><sheetData>{''.join(lines)}</sheetData></worksheet>")


def sales_line(year, eia, name, state="CA", scale=1.0, own="IOU"):
    groups = [(300 * scale, 2000 * scale, 10), (200 * scale, 1500 * scale, 5),
              (100 * scale, 900 * scale, 2), (0, 0, 0), (600 * scale, 4400 * scale, 17)]
    return [year, eia, name, state, own, *[v for g in groups for v in g]]


@pytest.fixture(scope="module")
def landing(tmp_path_factory, spark):
    root = tmp_path_factory.mktemp("landing")
    years = [2018, 2019, 2020, 2021, 2022, 2023]
    ids = [(183, 14328, "PG&E"), (155, 17609, "SCE"), (218, 16609, "SDG&E")]
    expenses, plant, income = [], [], []
    for k, (ferc, _, _) in enumerate(ids):
        for t, year in enumerate(years):
            grow = 1.0 + 0.05 * t * (k + 1) + 0.01 * (t * k % 3)
            for account, amount in [("500", 5e6), ("560", 1e6), ("580", 3e6), ("901", 1e6),
                                    ("920", 2e6), ("x", 1e5)]:
                value = round(amount * grow * (k + 1), 2)
                expenses.append((ferc, year, account, value, config.REPORTED))
                expenses.append((ferc, year, account, value, config.CALCULATED))
            for asset, balance in [(config.PLANT_IN_SERVICE, 9e7 * grow + 1e6 * (t * t % 5)),
                                   (config.ACCUMULATED_DEPRECIATION, 3e7)]:
                plant.append((ferc, year, "electric", asset, config.CALCULATED, balance))
            income.append((ferc, year, "electric", "400", "revenue", 3e7 * grow))
            income.append((ferc, year, "gas", "400", "revenue", 1e7))
    for t, year in enumerate(years):
        lines = [sales_line(year, eia, name, scale=1 + 0.1 * t + 0.3 * k * k)
                 for k, (_, eia, name) in enumerate(ids)]
        lines.append(sales_line(year, 14328, "PG&E bundled", own="Other"))
        lines.append(sales_line(year, 14328, "PG&E Nevada", state="NV"))
        lines.append(["note", None, "not a row", "CA"])
        write_workbook(root / f"Sales_Ult_Cust_{year}.xlsx", lines)
    for name, rows, schema in [("expenses", expenses, schemas.EXPENSES),
                               ("plant", plant, schemas.PLANT),
                               ("income", income, schemas.INCOME)]:
        spark.createDataFrame(rows, schema).write.parquet(str(root / name))
    return root


def test_workbooks_read_one_partition_per_file(spark, landing):
    df = read_workbooks(spark, f"{landing}/Sales_Ult_Cust_*.xlsx")
    assert df.rdd.getNumPartitions() == 6
    rows = df.where("utility_id_eia = 14328 AND report_year = 2018").orderBy("row_ordinal")
    first, second, third = rows.collect()
    assert (first["utility_name"], first["state"], second["ownership"]) == ("PG&E", "CA", "Other")
    assert first["revenue_total_k"] == 600.0 and first["customers_industrial"] == 2
    assert third["state"] == "NV" and first["row_ordinal"] < second["row_ordinal"]
    assert df.where("report_year IS NULL").count() == 6  # text where a number belongs


def test_workbook_format_reads_writes_and_prunes(spark, landing, tmp_path):
    spark.dataSource.register(WorkbookFormat)
    read = spark.read.format("sales_workbook").load(f"{landing}/Sales_Ult_Cust_*.xlsx")
    assert read.rdd.getNumPartitions() == 6
    rows = sorted(map(str, read.collect()))
    assert rows == sorted(map(str, read_workbooks(spark, f"{landing}/Sales_Ult_Cust_*.xlsx").collect()))
    some = spark.read.format("sales_workbook").schema("state string, report_year int").load(
        f"{landing}/Sales_Ult_Cust_2020.xlsx")
    assert some.columns == ["state", "report_year"] and some.where("state = 'NV'").count() == 1

    odd = spark.createDataFrame(
        [(2020, 1, ' <a> & "b"\n', None, 0.1 + 0.2, 3), (2021, None, None, "CA", None, 2**40)],
        "report_year int, utility_id_eia long, utility_name string, state string,"
        " revenue_total_k double, customers_total long")
    out = str(tmp_path / "books")
    odd.repartition(2).write.format("sales_workbook").mode("append").save(out)
    back = spark.read.format("sales_workbook").load(out).select(odd.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, odd.collect()))
    bad = odd.selectExpr("report_year", "raise_error('boom') AS state")
    with pytest.raises(Exception, match="boom"):
        bad.write.format("sales_workbook").mode("append").save(out)
    assert len(list((tmp_path / "books").iterdir())) == 2
    with pytest.raises(Exception, match="no workbook"):
        spark.read.format("sales_workbook").load(str(tmp_path / "books" / "x*.xlsx")).count()


def test_a_long_year_is_cut_into_workbooks_in_row_order(spark, tmp_path):
    spark.dataSource.register(WorkbookFormat)
    n, out = 2 * ROWS_PER_WORKBOOK + 5, str(tmp_path / "books")
    rows = spark.range(0, n, 1, 1).selectExpr(
        f"CASE WHEN id < {n - 3} THEN 2020 END AS report_year", "id AS utility_id_eia",
        "CASE WHEN id % 2 = 0 THEN 'a & <b>' END AS state")
    rows.write.format("sales_workbook").mode("append").save(out)
    files = sorted(p.name for p in (tmp_path / "books").iterdir())
    assert [f.split("_")[3] for f in files] == ["2020"] * 3 + ["None"]
    back = spark.read.format("sales_workbook").load(out)
    assert back.rdd.getNumPartitions() == 4
    back = back.select(*rows.columns, "row_ordinal").orderBy("row_ordinal").collect()
    assert [tuple(r)[:3] for r in back] == [tuple(r) for r in rows.collect()]


@pytest.mark.parametrize("name", ["workbook_sales", "workbook_rollup"])
def test_a_year_of_sales_is_written_by_many_tasks(spark, tmp_path, monkeypatch, name):
    tables_of = {
        "region": "1 AS r_regionkey, 'AFRICA' AS r_name FROM range(1)",
        "nation": "2 AS n_nationkey, 'n' AS n_name, 1 AS n_regionkey FROM range(1)",
        "customer": "id AS c_custkey, concat('c', id) AS c_name, 2 AS c_nationkey,"
        " 1D AS c_acctbal, 's' AS c_mktsegment FROM range(400)",
        "orders": "id AS o_orderkey, id % 400 AS o_custkey, substr('PFO', 1 + id % 3, 1) AS"
        " o_orderstatus, 5D AS o_totalprice, TIMESTAMP_NTZ '1996-03-04' AS o_orderdate,"
        " '1-URGENT' AS o_orderpriority FROM range(2000)",
    }
    for table, sql in tables_of.items():
        spark.sql(f"SELECT {sql}").write.parquet(str(tmp_path / f"{table}.parquet"))
    monkeypatch.setattr(registry.sinks, "stage_path", lambda _: str(tmp_path / "books"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = registry.REGISTRY[name](spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "books").iterdir())) > 4  # all rows are of one year
    if name == "workbook_sales":
        assert len(got) == 1200 and sum(r["customers_total"] for r in got) == 2000
    else:  # the status of the entity's first order
        assert sorted((r["utility_id_eia"], r["ownership"], r["customers_total"]) for r in got) == [
            (14000 + i, "PFO"[i % 3], 5) for i in range(400)]


MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
PLAIN_ROW = '<row r="1"><c r="A1" s="2" t="s"><v>1</v></c><c r="C1"><v>7</v></c></row>'
ODD_ROWS = (
    PLAIN_ROW + '<row r="3"/>\n<row spans="1:2"><c t="inlineStr"><is><t>x &amp; y</t></is></c>'
    '<c><f>1+1</f><v>2</v></c><c t="inlineStr"/></row>'
    '<row><c t="inlineStr"><is><r><t>a</t></r><r><t>b</t></r></is></c><c><v></v></c></row>'
)
ODD_CELLS = [["two", None, "7"], [], [], ["x & y", "2", ""], ["ab", None]]


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("head, body, cells", [
    ("", ODD_ROWS, ODD_CELLS),
    ("", "", []),
    ("", PLAIN_ROW + "<!-- </row> --><row><c><v>5</v></c></row>", [["two", None, "7"], ["5"]]),
    ("", "<row><c><v><![CDATA[</row>]]></v></c></row>", [["</row>"]]),
    ('<?xml version="1.0" encoding="ISO-8859-1"?>', "<row><c><v>\xe9</v></c></row>", [["\xe9"]]),
    ('<?xml version="1.0" encoding="UTF-8"?>', "<row><c><v>\xe9</v></c></row>" * 9, [["\xe9"]] * 9),
])
def test_sheets_of_other_writers_are_read_alike(monkeypatch, small, head, body, cells):
    plain = f'{head}<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>'
    prefixed = plain.replace("<", "<x:").replace("<x:/", "</x:").replace("xmlns=", "xmlns:x=")
    sheets = [plain] if "!" in body or head else [plain, prefixed]
    if small:
        monkeypatch.setattr(workbook, "_HEAD_BYTES", plain.index("Data>") + 7)
        monkeypatch.setattr(workbook, "_BLOCK_BYTES", 7)
    for sheet in sheets:
        file = io.BytesIO()
        with zipfile.ZipFile(file, "w") as book:
            book.writestr("xl/sharedStrings.xml",
                          f'<sst xmlns="{MAIN}"><si><t>one</t></si><si><t>two</t></si></sst>')
            book.writestr("xl/worksheets/sheet1.xml",
                          sheet.encode("latin-1" if "8859" in head else "utf-8"))
        assert list(sheet_rows(file)) == cells


@pytest.mark.parametrize("texts, kind, typed", [
    (["1", None, " 2 ", "n/a", "nan", "inf", "1_0", "-2.9", "9223372036854775808", ""], "long",
     [1, None, 2, None, None, None, 10, -2, None, None]),
    (["1", None, " 2 ", "n/a", "nan", "1e400", "+3"], "double",
     [1.0, None, 2.0, None, None, float("inf"), 3.0]),
    (["3.0", "4e2", "nan"], "long", [3, 400, None]),
])
def test_cells_are_typed_as_python_reads_numbers(texts, kind, typed):
    field = schemas.SALES["customers_total" if kind == "long" else "revenue_total_k"]
    assert workbook._typed(workbook.pa.array(texts), field.dataType).to_pylist() == typed


def test_repeated_headers_are_numbered():
    assert number_repeats(["a", "b", "a", None, "a"]) == ["a", "b", "a.1", "", "a.2"]


def test_missing_inputs_raise(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_table(spark, str(tmp_path / "none"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_workbooks(spark, f"{tmp_path}/*.xlsx")


def test_filed_types_conform_to_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(
        [(1, 2020, "x", "reported_value", "12.5", 9), (1, 2021, "y", "reported_value", "n/a", 9)],
        "utility_id_ferc1 int, report_year long, ferc_account string, row_type_xbrl string, "
        "dollar_value string, extra int",
    ).write.parquet(path)
    df = tables.read_table(spark, path, schemas.EXPENSES)
    assert df.columns == schemas.EXPENSES.names
    kept = tables.expenses(df, [1], [2020, 2021]).orderBy("report_year").collect()
    assert [r["dollar_value"] for r in kept] == [12.5, None]
    with pytest.raises(ValueError, match="ending_balance"):
        tables.read_table(spark, path, schemas.PLANT)
    some = tables.conform(df, schemas.SALES, ["report_year"])
    assert some.columns == ["report_year"]


def test_union_years_fills_absent_columns(spark):
    a = spark.createDataFrame([(2018, 1, "CA")], "report_year int, utility_id_eia int, state string")
    b = a.selectExpr("2019 AS report_year", "utility_id_eia", "state", "5 AS extra")
    assert [r["extra"] for r in tables.union_years([a, b]).orderBy("report_year").collect()] == [
        None, 5]
    with pytest.raises(ValueError, match="state"):
        tables.union_years([a.drop("state")])


def test_default_id_map(spark):
    assert {tuple(r) for r in tables.id_map(spark).collect()} == {
        (183, 14328, "PG&E"), (155, 17609, "SCE"), (218, 16609, "SDG&E")}


def test_bundle_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 2.5)], "id int, s string, x double")
    sinks.write_bundle({"one": df, "none": df.where("false")}, str(tmp_path))
    back = sinks.read_bundle(spark, str(tmp_path), {"one": df.schema, "none": df.schema})
    assert sorted(map(tuple, back["one"].collect())) == [(1, "a", None), (2, "b", 2.5)]
    assert back["none"].count() == 0


def test_jobs_end_to_end(spark, landing, tmp_path):
    out = str(tmp_path)
    inputs = jobs.Inputs(
        f"{landing}/expenses", f"{landing}/plant", f"{landing}/income",
        f"{landing}/Sales_Ult_Cust_*.xlsx",
    )
    ready = jobs.run_panel(spark, inputs, out)
    assert ready.count() == 18 and ready.columns == schemas.PANEL_COLUMNS
    pge = ready.where("utility_name = 'PG&E' AND report_year = 2018").first()
    assert pge["om_total"] == pytest.approx(12.1e6)  # reported rows only
    assert pge["customers_total"] == 34  # two CA rows rolled up, the NV one left out
    assert pge["operating_revenues_ferc"] == pytest.approx(3e7)  # electric only

    results = jobs.run_models(ready, 2023, out)
    assert len(spark.read.parquet(f"{out}/revenue_requirement").columns) == 43
    assert spark.read.parquet(f"{out}/bill_impact").count() == 3
    assert results["sensitivity"].count() == 21
    summary = jobs.summary_tables(results, 2023)
    assert all(df.count() == 3 for df in summary.values())

    bundle = jobs.run_statistics(ready, out)
    schema = {n: df.schema for n, df in bundle.items()}
    back = sinks.read_bundle(spark, f"{out}/analysis_results", schema)
    assert back["trend_results"].count() == 3 and back["utility_summaries"].count() == 12
    assert [r["rank"] for r in back["benchmarks"].orderBy("rank").collect()] == [1, 2, 3]
    found = {r["finding"] for r in findings.key_findings(ready).collect()}
    assert {"highest cost per customer", "fastest cost growth", "outlier count"} <= found

    charts = jobs.run_charts(spark, out, 2023, config.YEARS)
    assert charts["yoy_heatmap"].columns[2:] == ["2019", "2020", "2021", "2022", "2023"]
    assert spark.read.parquet(f"{out}/charts/rr_waterfall").count() == 21


def test_a_statistic_that_fails_when_written_stops_no_other(spark, tmp_path, monkeypatch):
    ready = spark.createDataFrame([(1,)], "x int")
    bad = ready.selectExpr("CAST(raise_error(concat('boom ', x)) AS STRING) AS y")
    monkeypatch.setattr(findings, "run_analysis", lambda _: {"bad": bad, "good": ready})
    monkeypatch.setattr(findings, "key_findings", lambda _: 1 / 0)
    written = jobs.run_statistics(ready, str(tmp_path))
    assert set(written) == {"bad_error", "good", "key_findings_error"}
    back = sinks.read_bundle(spark, f"{tmp_path}/analysis_results",
                             {n: df.schema for n, df in written.items()})
    assert back["good"].count() == 1 and "boom 1" in back["bad_error"].first()["message"]
    assert back["key_findings_error"].first()["message"] == "division by zero"


def test_a_job_of_two_years_reads_two_years(spark, landing, tmp_path):
    inputs = jobs.Inputs(
        f"{landing}/expenses", f"{landing}/plant", f"{landing}/income",
        f"{landing}/Sales_Ult_Cust_*.xlsx", years=[2022, 2023],
    )
    ready = jobs.run_panel(spark, inputs, str(tmp_path))
    assert ready.count() == 6
    assert {r["report_year"] for r in ready.collect()} == {2022, 2023}


def test_sales_from_csv_equal_those_from_workbooks(spark, landing, tmp_path):
    rows = jobs.load_sales(spark, f"{landing}/Sales_Ult_Cust_*.xlsx").select(schemas.SALES.names)
    rows.write.csv(str(tmp_path / "sales.csv"), header=True)
    back = jobs.load_sales(spark, str(tmp_path / "sales.csv"))
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_panel_job_refuses_a_thin_panel(spark, landing, tmp_path):
    inputs = jobs.Inputs(
        f"{landing}/expenses", f"{landing}/plant", f"{landing}/income",
        f"{landing}/Sales_Ult_Cust_*.xlsx", years=[2018, *range(1980, 1995)],
    )
    with pytest.raises(ValueError, match="row_count"):
        jobs.run_panel(spark, inputs, str(tmp_path))


def test_a_thin_panel_leaves_the_earlier_one(spark, landing, tmp_path):
    out, paths = str(tmp_path), [f"{landing}/{t}" for t in ("expenses", "plant", "income")]
    good = jobs.Inputs(*paths, f"{landing}/Sales_Ult_Cust_*.xlsx")
    jobs.run_panel(spark, good, out)
    thin = jobs.Inputs(*paths, f"{landing}/Sales_Ult_Cust_*.xlsx", years=[2018, *range(1980, 1995)])
    with pytest.raises(ValueError, match="row_count"):
        jobs.run_panel(spark, thin, out)
    assert spark.read.parquet(f"{out}/analysis_ready").count() == 18
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["analysis_ready"]
    jobs.run_panel(spark, jobs.Inputs(*paths, good.sales, years=[2022, 2023]), out)
    assert spark.read.parquet(f"{out}/analysis_ready").count() == 6


def test_a_failed_write_or_swap_keeps_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    sinks.write_table(spark.range(3), path)
    with pytest.raises(Exception, match="boom"):
        sinks.write_table(spark.range(9).selectExpr("raise_error('boom') AS x"), path)
    assert spark.read.parquet(path).count() == 3
    rename, calls = sinks._rename, []

    def failing(session, source, target):
        calls.append(target)
        if len(calls) == 2:
            raise OSError("no")
        rename(session, source, target)

    monkeypatch.setattr(sinks, "_rename", failing)
    with pytest.raises(OSError):
        sinks.write_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 3
    monkeypatch.undo()
    sinks._rename(spark, path, sinks._beside(path, "previous"))  # as if a job ended here
    sinks.restore(spark, path)
    assert spark.read.parquet(path).count() == 3
    sinks.write_table(spark.range(5), path)
    # A table may be replaced by one made from it.
    sinks.write_table(spark.read.parquet(path).where("id > 0"), path, check=lambda t: t.count())
    assert spark.read.parquet(path).count() == 4


def test_command_line(spark, landing, tmp_path):
    out = str(tmp_path)
    jobs.main([
        "panel", "--out", out, "--expenses", f"{landing}/expenses", "--plant", f"{landing}/plant",
        "--income", f"{landing}/income", "--sales", f"{landing}/Sales_Ult_Cust_*.xlsx",
    ])
    jobs.main(["charts", "--out", out])
    assert spark.read.parquet(f"{out}/charts/bill_impact").count() == 6


def test_staging_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="shared folder"):
        sinks.shared_folder(Session())
    assert sinks.stage(spark.range(5)).count() == 5
