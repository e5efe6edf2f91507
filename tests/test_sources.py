"""Loads: pruning by month, lineage, idempotence, empty input, incremental files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallygrid.sources import costs, readers, writers
from tallygrid.streaming.incremental import append_new_exports


def export(root, month, rows, header="date,subscriptionName,SubscriptionId,resourceGroupName,costInBillingCurrency,servicePeriodStartDate,tags", name="a.csv"):
    path = f"{root}/id-1/daily/{month}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write("\n".join([header, *rows]) + "\n")


def row(day, cost, tag="7", group="g"):
    return f'{day},"sub, ""x""\nline",s1,{group},{cost},01/01/2024,"{{""Debiteurnummer"": ""{tag}"", ""BusinessUnit"": ""BI""}}"'


@pytest.fixture
def root(folder):
    path = f"{folder}/exports"
    export(path, "20240101-20240131", [row("01/30/2024", 1.5), row("01/31/2024", 2)])
    export(path, "20240201-20240229", [row("02/01/2024", 4), row("bad", 8)])
    return path


def test_month_folders():
    assert readers.month_folders("2023-12-31", "2024-02-01") == ["20231201-20231231", "20240101-20240131", "20240201-20240229"]


def test_reads_only_touched_months(spark, root):
    rows = readers.read_months(spark, root, "2024-02-01", "2024-03-31").collect()
    assert len(rows) == 2 and {r.MonthFolder for r in rows} == {"20240201-20240229"}
    assert (rows[0].ExportId, rows[0].ExportName, rows[0].FileName) == ("id-1", "daily", "a.csv")
    assert rows[0].subscriptionName == 'sub, "x"\nline'


def test_no_month_gives_an_empty_frame(spark, root):
    nothing = readers.read_months(spark, root, "2020-01-01", "2020-02-01")
    assert nothing.columns == ["date"] and nothing.count() == 0


def test_files_with_other_headers_do_not_shift_columns(spark, root):
    export(root, "20240201-20240229", ["1,2"], header="x,y", name="b.csv")
    with pytest.raises(Exception):
        readers.read_months(spark, root, "2024-02-01", "2024-02-29").collect()


def load(spark, root, folder, start, end):
    costs.load_costs(spark, root, f"{folder}/costs", f"{folder}/dictionary", start, end, "t")
    table = readers.read_table(spark, f"{folder}/costs")
    return {(str(r.parsed_date), r.costInBillingCurrency, r.Debiteurnummer) for r in table.collect()}


def test_load_is_idempotent_and_covers_the_range(spark, root, folder):
    wanted = {("2024-01-30", "1.5", "7"), ("2024-01-31", "2", "7"), ("2024-02-01", "4", "7")}
    assert load(spark, root, folder, "2024-01-30", "2024-02-01") == wanted
    assert load(spark, root, folder, "2024-01-30", "2024-02-01") == wanted
    assert load(spark, root, folder, "2024-01-31", "2024-01-31") == wanted
    export(root, "20240101-20240131", [row("01/31/2024", 3, tag="8")])
    assert load(spark, root, folder, "2024-01-30", "2024-01-31") == {("2024-01-31", "3", "8"), ("2024-02-01", "4", "7")}


@pytest.mark.parametrize("share", [0.9, 1.1])
def test_load_with_open_ended_tags(spark, root, folder, share):
    """Tags of few rows (with a share above 1: all) are rows of their own; a rerun changes nothing; no tag is lost."""
    for _ in range(2):
        costs.load_costs_open(spark, root, f"{folder}/costs", f"{folder}/dictionary", "2024-01-30", "2024-02-01", "t", share=share)
        table, wide = readers.read_table(spark, f"{folder}/costs"), {r.key for r in spark.read.parquet(f"{folder}/costs_keys").where("wide").collect()}
        held = {(str(r.parsed_date), r.costInBillingCurrency, r.row_id) for r in table.collect()}
        assert {x[:2] for x in held} == {("2024-01-30", "1.5"), ("2024-01-31", "2"), ("2024-02-01", "4")} and ("Debiteurnummer" in wide) == (share < 1)
        if share < 1:
            assert {r.Debiteurnummer for r in table.collect()} == {"7"}
        else:
            tags = readers.read_table(spark, f"{folder}/costs_tags").where("key = 'Debiteurnummer'").collect()
            assert {(str(r.parsed_date), r.row_id) for r in tags} == {(x[0], x[2]) for x in held} and {r.value for r in tags} == {"7"}


def test_replacing_refuses_other_days(spark, folder):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1)], "d date, v int")
    with pytest.raises(ValueError):
        writers.replace_partition(df, f"{folder}/t", "d", ["2024-01-02"])


def test_view_backfill_and_append(spark, root, folder):
    cleaned = costs.clean_costs(readers.read_months(spark, root, "2024-01-01", "2024-02-29"), ["Debiteurnummer", "BusinessUnit"])
    dated = cleaned.withColumn("date", F.try_to_date("date", "MM/dd/yyyy")).filter("date IS NOT NULL")
    view = f"{folder}/view"
    for _ in range(2):
        costs.backfill_view(spark, dated.filter("date < DATE '2024-02-01'"), view)
    assert spark.read.parquet(view).count() == 2
    assert costs.append_view(spark, dated, view) and not costs.append_view(spark, dated, view)
    assert spark.read.parquet(view).count() == 3
    assert spark.read.parquet(view).columns == costs.VIEW_COLUMNS


@pytest.mark.parametrize("catalog", [False, True])
def test_view_over_a_year_end(spark, folder, catalog):
    """Days as text, over a year end: 01/01 comes after 12/31, and both kinds of targets keep every row."""
    days = ["12/30/2023", "12/31/2023", "01/01/2024", "01/02/2024"]
    rows = spark.createDataFrame([(d, str(i)) for i, d in enumerate(days)], "date string, costInBillingCurrency string")
    rows = rows.select(*[F.col(c) if c in rows.columns else F.lit("x").alias(c) for c in costs.VIEW_COLUMNS])
    old = rows.filter("date LIKE '12/%'")
    if catalog:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS views LOCATION '{folder}/db'")
    try:
        appended, filled = ("views.appended", "views.filled") if catalog else (f"{folder}/appended", f"{folder}/filled")
        assert costs.append_view(spark, old, appended) and costs.append_view(spark, rows, appended)
        assert not costs.append_view(spark, rows, appended)
        for part in (old, rows, rows):
            costs.backfill_view(spark, part, filled)
        for target in (appended, filled):
            assert sorted(r.date for r in readers.read_table(spark, target).collect()) == sorted(days)
        writers.write_table(rows.limit(1).withColumn("more", F.lit(1)).drop("BusinessUnit"), appended, "append")
        got = readers.read_table(spark, appended)
        assert got.count() == 5 and [r.BusinessUnit for r in got.where("more = 1").collect()] == [None]
    finally:
        if catalog:
            spark.sql("DROP DATABASE views CASCADE")


@pytest.mark.parametrize("catalog", [False, True])
def test_late_and_unreadable_days_reach_the_view(spark, folder, catalog):
    rows = lambda *days: spark.createDataFrame(days, "date string, costInBillingCurrency string").select(
        *[F.col(c) if c in ("date", "costInBillingCurrency") else F.lit("x").alias(c) for c in costs.VIEW_COLUMNS]
    )
    if catalog:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS late LOCATION '{folder}/db'")
    try:
        view = "late.view" if catalog else f"{folder}/view"
        held = lambda: sorted((r.date or "", r.costInBillingCurrency) for r in readers.read_table(spark, view).collect())
        first = rows(("01/01/2024", "1"), ("01/03/2024", "3"), ("soon", "a"))
        assert costs.append_view(spark, first, view) and not costs.append_view(spark, first, view)
        late = rows(("01/02/2024", "2"), ("01/02/2024", "2"), ("01/03/2024", "4"), ("later", "b"), (None, "c"))
        assert costs.append_view(spark, late, view) and not costs.append_view(spark, late, view)
        want = [("", "c"), ("01/01/2024", "1"), ("01/02/2024", "2"), ("01/02/2024", "2"), ("01/03/2024", "4"), ("later", "b"), ("soon", "a")]
        assert held() == want
    finally:
        if catalog:
            spark.sql("DROP DATABASE late CASCADE")


def test_incremental_files_are_read_once(spark, root, folder):
    schema = "date string, subscriptionName string, SubscriptionId string, resourceGroupName string, costInBillingCurrency string, servicePeriodStartDate string, tags string"
    run = lambda: append_new_exports(spark, root, schema, f"{folder}/out", f"{folder}/state", ["Debiteurnummer", "BusinessUnit"])
    run(), run()
    assert spark.read.parquet(f"{folder}/out").count() == 4
    export(root, "20240201-20240229", [row("02/02/2024", 16)], name="c.csv")
    run()
    assert spark.read.parquet(f"{folder}/out").count() == 5


def test_catalog_tables(spark, folder):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS stage LOCATION '{folder}/db'")
    try:
        df = spark.createDataFrame([(1, "x")], "i int, t string")
        writers.write_table(df, "stage.t")
        writers.write_table(df, "stage.t", "append")
        assert readers.read_table(spark, "t", "stage").count() == 2
        writers.write_table(df.select("t"), "stage.t")
        assert readers.read_table(spark, "stage.t").columns == ["t"]
        assert not writers.write_if_any(df.filter("i > 5"), "stage.u")
        assert not spark.catalog.tableExists("stage.u")
    finally:
        spark.sql("DROP DATABASE stage CASCADE")


def test_issue_pages(spark, folder):
    with open(f"{folder}/pages.json", "w") as f:
        f.write('{"sprint": {"id": 1, "name": "Sprint 1"}, "issues": [{"id": "1"}, {"id": "2", "fields": {"status": {"name": "Gereed"}}}]}\n')
        f.write('{"sprint": {"id": 1, "name": "Sprint 1"}, "startAt": 50, "issues": [{"id": "3"}]}\n{"sprint": {"id": 2}, "issues": []}\n')
    rows = readers.pages_to_rows(readers.read_issue_json(spark, f"{folder}/pages.json")).collect()
    assert sorted((r.sprint.id, r.issue.id if r.issue else None) for r in rows) == [(1, "1"), (1, "2"), (1, "3"), (2, None)]
