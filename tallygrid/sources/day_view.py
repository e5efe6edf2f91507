"""A table kept by day, with versions: a load touches its own days only.

Rows lie in ``data/load=<id>/day=<day>``. A version, ``versions/v=<n>``, is one small file with a row per day: the load that
holds the day's rows, how many they are, and a digest of them. A load is compared with these digests, writes the
days that are new or differ to a folder of its own, and becomes visible when its version file appears. Until then, and
if it fails, readers see the version before. Days that a load does not name are neither read nor written.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallygrid.functions.dates import parse_date
from tallygrid.operators.quality import table_exists
from tallygrid.operators.sets import merge_backfill

MANIFEST = "day date, load string, rows bigint, digest decimal(38,0)"
#: Folder name of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class DayView:
    """``day`` tells a row's day; rows whose day is empty are kept as a day of their own, to which loads only add."""

    def __init__(self, spark: SparkSession, root: str, column: str = "date", day: Callable[[Column], Column] = parse_date):
        self.spark, self.root = spark, root.rstrip("/")
        self.day = day(F.col(column))

    # -- reading --------------------------------------------------------------------------

    def version(self) -> int:
        """The newest version, 0 without any."""
        path = f"{self.root}/versions"
        return (self.spark.read.parquet(path).agg(F.max("v")).first()[0] or 0) if table_exists(self.spark, path) else 0

    def manifest(self, version: int | None = None) -> DataFrame:
        """(day, load, rows, digest) of a version, by default the newest."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/versions/v={version}")

    def read(self, version: int | None = None, days: Sequence[dt.date | None] | None = None) -> DataFrame | None:
        """The rows of a version, or of some of its days; None without any. Only the folders named by the version are opened."""
        held = {r.day: r.load for r in self.manifest(version).select("day", "load").collect()}  # one row per day
        wanted = held if days is None else {d: held[d] for d in days if d in held}
        if not wanted:
            return None
        paths = [f"{self.root}/data/load={load}/day={NO_DAY if d is None else d.isoformat()}" for d, load in wanted.items()]
        rows = self.spark.read.option("basePath", f"{self.root}/data").option("mergeSchema", "true").parquet(*sorted(paths))
        return rows.drop("load", "day")

    # -- writing --------------------------------------------------------------------------

    def append(self, new: DataFrame) -> bool:
        """Bring the days of a load into the view; tells whether anything changed, so a second run of a load does not.

        A day that is new is added, late or not; a day whose rows differ is replaced as a whole. Rows without a
        day stay, and those that the view lacks are added.
        """
        found = self._digests(new)
        differ = found.join(self.manifest().select(F.col("day").alias("_day"), F.col("rows").alias("_rows"), F.col("digest").alias("_digest")), F.col("day").eqNullSafe(F.col("_day")), "left")
        changed = differ.where("NOT (rows <=> _rows AND digest <=> _digest)").select("day", "rows", "digest").collect()  # at most a row per day of the load
        days = [r.day for r in changed]
        rows = new.where(self._in([d for d in days if d is not None]))
        if None in days:
            unread, old = new.where(self.day.isNull()), self.read(days=[None])
            if old is not None:
                added = unread.exceptAll(old.select(unread.columns))
                if added.isEmpty():
                    days.remove(None)
                else:
                    rows = rows.unionByName(added.unionByName(old, allowMissingColumns=True), allowMissingColumns=True)
            else:
                rows = rows.unionByName(unread)
        if not days:
            return False
        load = self._write(rows)
        self._publish(load, self._digests(self._loaded(load)) if None in days else self.spark.createDataFrame(changed, "day date, rows bigint, digest decimal(38,0)"))
        return True

    def merge(self, new: DataFrame, keys: Sequence[str]) -> bool:
        """Merge a reload, one row per key, the new one if both exist. The keys hold the day, so only days of the reload are read."""
        days = [r.day for r in new.select(self.day.alias("day")).distinct().collect()]  # at most a row per day of the load
        old = self.read(days=days)
        load = self._write(merge_backfill(new, old if old is not None else new.limit(0), keys))
        found = self._digests(self._loaded(load))
        held = self.manifest().select(F.col("day").alias("_day"), F.col("rows").alias("_rows"), F.col("digest").alias("_digest"))
        changed = found.join(held, F.col("day").eqNullSafe(F.col("_day")), "left").where("NOT (rows <=> _rows AND digest <=> _digest)")
        changed = self.spark.createDataFrame(changed.select("day", "rows", "digest").collect(), "day date, rows bigint, digest decimal(38,0)")
        if changed.isEmpty():
            return False
        self._publish(load, changed)
        return True

    def _in(self, days: Sequence[dt.date]) -> Column:
        return F.coalesce(self.day.isin(list(days)), F.lit(False)) if days else F.lit(False)

    def _digests(self, rows: DataFrame) -> DataFrame:
        """(day, rows, digest); the digest does not depend on the order of rows or columns."""
        columns = sorted(rows.columns)
        same = F.xxhash64(*[F.col(f"`{c}`") for c in columns], *[F.col(f"`{c}`").isNull() for c in columns]).cast("decimal(38,0)")
        return rows.groupBy(self.day.alias("day")).agg(F.count(F.lit(1)).alias("rows"), F.sum(same).cast("decimal(38,0)").alias("digest"))

    def _write(self, rows: DataFrame) -> str:
        """Writes rows as a load; few files per day, while a day with very many rows is still split."""
        load = uuid.uuid4().hex
        placed = rows.withColumn("day", self.day).hint("rebalance", F.col("day"))
        placed.write.partitionBy("day").parquet(f"{self.root}/data/load={load}")
        return load

    def _loaded(self, load: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/data/load={load}").drop("day")

    def _publish(self, load: str, changed: DataFrame) -> None:
        """The next version: the changed days point to the load, all others to where they were. Two writers cannot make the same one."""
        version = self.version()
        touched = changed.select(F.col("day").alias("_day"))
        rest = self.manifest(version).join(touched, F.col("day").eqNullSafe(F.col("_day")), "left_anti")
        rows = rest.unionByName(changed.withColumn("load", F.lit(load)))
        rows.select("day", "load", "rows", "digest").coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/versions/v={version + 1}")
