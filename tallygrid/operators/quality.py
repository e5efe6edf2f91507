"""Schema tracking and load reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

# Fixed value: the columns of the stored schema dictionary.
DICTIONARY = "ColumnName string, DataType string, Nullable boolean, RunDate string, CapturedAt string, Version int"


def schema_snapshot(df: DataFrame, run_date: str, captured_at: dt.datetime | str, version: int = 1) -> DataFrame:
    """The columns of a frame as rows: name, type, nullability."""
    at = captured_at if isinstance(captured_at, str) else captured_at.isoformat()
    rows = [
        (f.name, f.dataType.simpleString(), f.nullable, run_date, at, version) for f in df.schema.fields
    ]
    return df.sparkSession.createDataFrame(rows, DICTIONARY)


def latest_version(dictionary: DataFrame) -> DataFrame:
    """All rows of the highest version, however wide the table is."""
    highest = dictionary.agg(F.max("Version")).scalar()
    return dictionary.filter(F.col("Version") == highest)


def schema_drift(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Added, removed and retyped columns, ignoring case in names."""
    now = current.select(F.lower("ColumnName").alias("name"), F.col("DataType").alias("new_type"))
    before = previous.select(F.lower("ColumnName").alias("name"), F.col("DataType").alias("old_type"))
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "changed")
    )
    joined = now.join(before, "name", "full_outer").withColumn("change", change)
    return joined.filter(F.col("change").isNotNull())


def table_exists(spark: SparkSession, path: str) -> bool:
    """Is there a catalog table of that name, or does the folder (a name with a slash) hold readable data?"""
    if "/" not in path:
        return spark.catalog.tableExists(path)
    try:
        spark.read.parquet(path).schema
        return True
    except Exception as error:  # noqa: BLE001
        if any(t in str(error) for t in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
            return False
        raise


def track_schema(df: DataFrame, path: str, run_date: str, captured_at: dt.datetime | str) -> int:
    """Append a new version to the schema dictionary when the schema changed."""
    spark = df.sparkSession
    if not table_exists(spark, path):
        schema_snapshot(df, run_date, captured_at).coalesce(1).write.mode("append").parquet(path)
        return 1
    # one row per column of the table: small enough for the driver
    known = latest_version(spark.read.parquet(path)).select("ColumnName", "DataType", "Version").collect()
    version = known[0].Version
    before = {row.ColumnName.lower(): row.DataType for row in known}
    now = {field.name.lower(): field.dataType.simpleString() for field in df.schema.fields}
    if now == before:
        return version
    schema_snapshot(df, run_date, captured_at, version + 1).coalesce(1).write.mode("append").parquet(path)
    return version + 1


def load_report(df: DataFrame, name: str = "load") -> tuple[DataFrame, Observation]:
    """Count rows while they are written; read ``observation.get`` afterwards."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
