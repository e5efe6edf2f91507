"""Readers: cost exports, catalog and folder tables, issue-tracker files, literals."""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallygrid.functions.dates import to_day
from tallygrid.operators.columns import quoted
from tallygrid.operators.sets import union_loose

# --- fixed values: layout of the cost export <root>/<id>/<name>/<first>-<last>/<file> ---
CSV_OPTIONS = {
    "header": "true", "delimiter": ",", "multiLine": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE",
    # files of one folder that disagree on their header must fail, not shift columns
    "enforceSchema": "false",
}
MONTH_FOLDER = r"^\d{8}-\d{8}$"
# ----------------------------------------------------------------------------------------


def read_export_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Quoted, multi-line CSV files below a folder; every column stays text."""
    return spark.read.options(recursiveFileLookup="true", **CSV_OPTIONS).csv(path)


def month_folders(start: dt.date | str, end: dt.date | str) -> list[str]:
    """Names of the month folders that a range of days touches."""
    first, last = to_day(start), to_day(end)
    names, year, month = [], first.year, first.month
    while (year, month) <= (last.year, last.month):
        days = calendar.monthrange(year, month)[1]
        names.append(f"{year:04d}{month:02d}01-{year:04d}{month:02d}{days:02d}")
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)
    return names


def with_lineage(df: DataFrame) -> DataFrame:
    """Source path, export id, export name, month folder and file name of each row.

    Apply it straight to a file read, before any union or join.
    """
    path = F.col("_metadata.file_path")
    placed = df.select("*", path.alias("SourcePath"), F.split(path, "/").alias("_parts"))

    def part(place: int) -> Column:
        return F.try_element_at("_parts", F.lit(place))

    in_month = part(-2).rlike(MONTH_FOLDER)
    levels = {"ExportId": -4, "ExportName": -3, "MonthFolder": -2}
    return placed.select(
        *[quoted(c) for c in df.columns], "SourcePath",
        *[F.when(in_month, part(place)).otherwise(F.lit("")).alias(name) for name, place in levels.items()],
        part(-1).alias("FileName"),
    )


def empty_frame(spark: SparkSession, columns: str = "date string") -> DataFrame:
    return spark.createDataFrame([], columns)


def union_months(spark: SparkSession, frames: Sequence[DataFrame]) -> DataFrame:
    """Months whose columns may differ; no month at all gives an empty frame."""
    return union_loose(frames) if frames else empty_frame(spark)


def read_months(spark: SparkSession, root: str, start: dt.date | str, end: dt.date | str, lineage: bool = True) -> DataFrame:
    """Only the month folders that the range touches; months without a folder are skipped."""
    frames = []
    for folder in month_folders(start, end):
        try:
            month = spark.read.options(**CSV_OPTIONS).csv(f"{root}/*/*/{folder}/")
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                continue
            raise
        frames.append(with_lineage(month) if lineage else month)
    return union_months(spark, frames)


def read_table(spark: SparkSession, name: str, schema: str | None = None) -> DataFrame:
    """A catalog table by (schema and) name, or a parquet folder when given a path."""
    if "/" in name:
        return spark.read.option("mergeSchema", "true").parquet(name)
    return spark.table(f"`{schema}`.`{name}`" if schema else name)


def read_warehouse(spark: SparkSession, url: str, schema: str, name: str, partition: dict[str, str] | None = None) -> DataFrame:
    """A table of an external warehouse over JDBC; give partition bounds for a parallel read."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=f"{schema}.{name}")
    return reader.options(**(partition or {})).load()


def literal_table(spark: SparkSession, rows: Iterable[Sequence], schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([tuple(row) for row in rows], schema)


def _record(*fields: str) -> str:
    return "struct<" + ",".join(f"{f}:string" for f in fields) + ">"


# --- fixed values: the landed issue-tracker files ------------------------------------------
POINTS_FIELD, TEAMS_FIELD = "customfield_10028", "customfield_10067"
ISSUE = (
    "struct<id:string,key:string,fields:struct<summary:string,"
    f"status:{_record('id', 'name')},priority:{_record('id', 'name')},project:{_record('id', 'key', 'name')},"
    f"assignee:{_record('displayName')},creator:{_record('displayName')},reporter:{_record('displayName')},"
    f"sprint:struct<originBoardId:bigint,name:string>,{POINTS_FIELD}:double,{TEAMS_FIELD}:array<{_record('name')}>>>"
)
ISSUE_PAGE = f"sprint struct<id:bigint,self:string,name:string>, startAt bigint, total bigint, issues array<{ISSUE}>"
SPRINT_PAGE = (
    "values array<struct<id:bigint,self:string,state:string,name:string,startDate:string,endDate:string,"
    "createdDate:string,originBoardId:bigint,goal:string>>"
)
PAGE_SIZE = 50
# ----------------------------------------------------------------------------------------


def read_issue_json(spark: SparkSession, path: str, schema: str = ISSUE_PAGE, multi_line: bool = False) -> DataFrame:
    """Landed pages of an issue tracker; a missing field is an empty value.

    Use one document per line where possible: such files split over tasks.
    """
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def pages_to_rows(pages: DataFrame, items: str = "issues") -> DataFrame:
    """All pages together: one row per item, the rest of the page repeated.

    An empty first page keeps its sprint as a row without an item. Pages hold a bounded number of items, so no list is ever put back together.
    """
    rest = [c for c in pages.columns if c != items]
    return pages.select(*rest, F.explode_outer(F.col(items)).alias(items.rstrip("s")))
