"""Daily append of new export files as a Structured Streaming job.

The stream remembers which files it has read, so running the job again, after a
failure or by mistake, adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from tallygrid.sources.costs import clean_costs, cost_view
from tallygrid.sources.readers import CSV_OPTIONS


def append_new_exports(
    spark: SparkSession, root: str, schema: T.StructType | str, target: str, state: str, keys: list[str]
) -> None:
    """Read every export file not read before, append its view rows, and stop.

    Tag names are given, since a stream has one schema. ``state`` is a folder on
    shared storage. A batch is written under its own number, so a batch repeated
    after a failure replaces its own rows.
    """
    files = spark.readStream.schema(schema).options(recursiveFileLookup="true", **CSV_OPTIONS).csv(root)
    rows = cost_view(clean_costs(files, keys))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    job = rows.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
    job.awaitTermination()
