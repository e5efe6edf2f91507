"""Cloud-cost exports: daily load with drift tracking, and the narrow view on top."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallygrid.functions.dates import parse_date, to_day
from tallygrid.operators.aggregates import dedupe
from tallygrid.operators.columns import drop_columns, safe_names, select_columns
from tallygrid.operators.nested import parse_tags, split_map, update_keys, widen_map
from tallygrid.operators.quality import table_exists, track_schema
from tallygrid.operators.sets import merge_backfill
from tallygrid.session import scratch_path
from tallygrid.sources.day_view import DayView
from tallygrid.sources.readers import read_months, read_table
from tallygrid.sources.writers import overwrite_in_place, replace_partition, write_table

# --- fixed values: columns of the view and what makes two of its rows the same ------------
VIEW_COLUMNS = [
    "servicePeriodStartDate", "date", "subscriptionName", "SubscriptionId", "costInBillingCurrency",
    "Debiteurnummer", "BusinessUnit", "resourceGroupName",
]
VIEW_KEYS = ["date", "subscriptionName", "SubscriptionId", "resourceGroupName", "costInBillingCurrency"]
HIDDEN = "hidden_link"
# -------------------------------------------------------------------------------------------


def clean_costs(raw: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Tags to columns, safe and unique column names, no hidden links, no map left."""
    tagged = parse_tags(raw, "tags", "tags_json") if "tags" in raw.columns else raw
    if "tags_json" in tagged.columns:
        tagged = widen_map(tagged, "tags_json", keys).drop("tags_json")
    return drop_columns(safe_names(tagged, unique=True), HIDDEN)


def load_costs(
    spark: SparkSession, root: str, target: str, dictionary: str, start: dt.date | str, end: dt.date | str,
    captured_at: dt.datetime | str, keys: list[str] | None = None,
) -> int:
    """Load all days of a range from the exports; returns the schema version.

    The text files are read once: the rows of the range are staged as parquet in
    the shared folder, and both the scan for tag names and the final write read
    that copy. Without rows for a day the day ends up empty; reruns agree.
    """
    first, last = to_day(start), to_day(end)
    raw = read_months(spark, root, first, last)
    version = track_schema(raw, dictionary, last.isoformat(), captured_at)
    rows = raw.withColumn("parsed_date", parse_date(F.col("date")))
    rows = rows.filter(F.col("parsed_date").between(F.lit(first), F.lit(last)))
    staged = scratch_path(spark, "costs")
    rows.write.parquet(staged)
    cleaned = clean_costs(spark.read.parquet(staged), keys)
    days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    replace_partition(cleaned, target, "parsed_date", days)
    return version


def load_costs_open(
    spark: SparkSession, root: str, target: str, dictionary: str, start: dt.date | str, end: dt.date | str,
    captured_at: dt.datetime | str, share: float = 0.01,
) -> int:
    """As ``load_costs``, for tags whose keys are open-ended; returns the schema version.

    Tags that ``share`` of the rows or more hold become columns. All others go to ``<target>_tags`` as rows (parsed_date,
    row_id, key, value), by day as the costs are. ``<target>_keys`` remembers every key, so a column stays one.
    """
    first, last = to_day(start), to_day(end)
    raw = read_months(spark, root, first, last)
    version = track_schema(raw, dictionary, last.isoformat(), captured_at)
    rows = raw.withColumn("parsed_date", parse_date(F.col("date"))).filter(F.col("parsed_date").between(F.lit(first), F.lit(last)))
    rows = parse_tags(rows, "tags", "tags_json").withColumn("row_id", F.monotonically_increasing_id())
    staged = scratch_path(spark, "costs")
    rows.write.parquet(staged)  # the row numbers are fixed from here on
    rows = spark.read.parquet(staged)
    wide, rest = split_map(rows, "tags_json", update_keys(rows, "tags_json", f"{target}_keys", share), ["parsed_date", "row_id"])
    days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    replace_partition(drop_columns(safe_names(wide, unique=True), HIDDEN), target, "parsed_date", days)
    replace_partition(rest, f"{target}_tags", "parsed_date", days)
    return version


def cost_view(costs: DataFrame) -> DataFrame:
    """The eight columns that reports use."""
    return select_columns(costs, VIEW_COLUMNS)


def append_days(spark: SparkSession, costs: DataFrame, root: str) -> bool:
    """Bring the days of a load into the view kept by day at ``root``: only days that are new or differ are written."""
    return DayView(spark, root).append(cost_view(costs))


def backfill_days(spark: SparkSession, costs: DataFrame, root: str) -> bool:
    """Merge a reload into the view kept by day: one row per key, the new one if both exist; other days are not opened."""
    return DayView(spark, root).merge(cost_view(costs), VIEW_KEYS)


def backfill_view(spark: SparkSession, costs: DataFrame, target: str) -> None:
    """Merge a full reload into the view: one row per key, the new one if both exist."""
    new = cost_view(costs)
    if not table_exists(spark, target):
        write_table(dedupe(new, VIEW_KEYS), target)
        return
    overwrite_in_place(merge_backfill(new, read_table(spark, target), VIEW_KEYS), target)


def append_view(spark: SparkSession, costs: DataFrame, target: str, column: str = "date") -> bool:
    """Bring the days of a load into the view; a second run of the same load changes nothing.

    Days are compared as dates, also where the column holds their text. A day that the view lacks is
    added, late or not; a day whose rows differ from the view's is replaced as a whole, by a rewrite of
    the view. Rows whose day cannot be read stay, and those that the view lacks are added.
    """
    new, day = cost_view(costs), parse_date(F.col(column))
    if not table_exists(spark, target):
        if new.isEmpty():
            return False
        write_table(new, target, "append")
        return True

    view, columns = read_table(spark, target), new.columns
    both = new.withColumn("_new", F.lit(True)).unionByName(view.withColumn("_new", F.lit(False)), allowMissingColumns=True)
    same = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns]).cast("decimal(38,0)")
    sides = [f(F.when(F.col("_new") == side, x)).alias(n) for side, s in ((True, "new"), (False, "old")) for f, x, n in ((F.count, F.lit(1), f"n_{s}"), (F.sum, same, f"h_{s}"))]
    differ = both.where(day.isNotNull()).groupBy(day.alias("day")).agg(*sides).where("n_new > 0 AND NOT (n_new = n_old AND h_new <=> h_old)")
    # one row per day of the load that is new or differs
    days = {r.day: r.n_old > 0 for r in differ.select("day", "n_old").collect()}
    in_days = lambda wanted: day.isNotNull() & day.isin(sorted(wanted)) if wanted else F.lit(False)
    unread = lambda side: both.where(F.col("_new") == side).where(day.isNull()).select(columns)
    added = both.where("_new").where(in_days(days)).select(columns).unionByName(unread(True).exceptAll(unread(False)))
    staged = scratch_path(spark, "view")
    added.write.parquet(staged)
    added = spark.read.parquet(staged)
    if added.isEmpty():
        return False
    replaced = {d for d, there in days.items() if there}
    if replaced:
        overwrite_in_place(view.where(~F.coalesce(in_days(replaced), F.lit(False))).unionByName(added, allowMissingColumns=True), target)
    else:
        write_table(added, target, "append")
    return True
