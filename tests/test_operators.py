"""Operators on small frames, with hot keys, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallygrid.operators import aggregates as ag
from tallygrid.operators import columns as co
from tallygrid.operators import filters as fi
from tallygrid.operators import joins as jo
from tallygrid.operators import nested as ne
from tallygrid.operators import numbering as nu
from tallygrid.operators import quality as qu
from tallygrid.operators import sets as se
from tallygrid.operators import windows as wi


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows has one key; some keys are empty."""
    rng = random.Random(5)
    rows = [(i, 0 if rng.random() < 0.34 else rng.choice([None, *range(1, 40)]), rng.randrange(50)) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "id long, k int, v int").repartition(7)


def test_index_is_dense_and_ordered(skewed):
    rows, df = skewed
    got = {r.id: r.n for r in nu.with_index(df, ["v", "id"], "n").collect()}
    wanted = {row[0]: n for n, row in enumerate(sorted(rows, key=lambda r: (r[2], r[0])), 1)}
    assert got == wanted


def test_index_of_nothing(spark):
    assert nu.with_index(spark.createDataFrame([], "id long"), ["id"]).count() == 0


def test_row_number_by_hot_key(skewed):
    rows, df = skewed
    got = {r.id: r.RowNum for r in nu.row_number_by(df, ["k"], ["v", "id"]).collect()}
    wanted = {}
    for key in {r[1] for r in rows}:
        group = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0]))
        wanted |= {r[0]: n for n, r in enumerate(group, 1)}
    assert got == wanted


def test_dense_rank(skewed):
    rows, df = skewed
    place = {v: n for n, v in enumerate(sorted({r[2] for r in rows}, reverse=True), 1)}
    assert {r.id: r["rank"] for r in nu.rank_dense(df, "v").collect()} == {r[0]: place[r[2]] for r in rows}


def test_dedupe_keeps_the_greatest(skewed):
    rows, df = skewed
    got = {r.k: (r.v, r.id) for r in ag.dedupe(df, ["k"], prefer=["v"]).collect()}
    assert got == {k: max((r[2], r[0]) for r in rows if r[1] == k) for k in {r[1] for r in rows}}
    assert ag.dedupe(df.select("k"), ["k"]).count() == len({r[1] for r in rows})


def test_lookups_keep_every_row(skewed, spark):
    _, df = skewed
    dim = spark.createDataFrame([(0, "zero", 9), (0, "zero", 4), (1, "one", 2)], "k int, name string, key int")
    found = jo.lookup_keys(df, dim, "k", "key")
    assert found.count() == 3000 and {r.key for r in found.filter("k = 0").select("key").distinct().collect()} == {4}
    assert found.filter("k IS NULL AND key IS NOT NULL").count() == 0
    assert jo.restrict_by(df, dim, "k").filter("k NOT IN (0, 1)").count() == 0
    assert jo.narrow_dim(dim, df.filter("k = 1"), "k").collect()[0].name == "one"


def test_merge_prefers_new_rows(spark):
    old = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    new = spark.createDataFrame([(2, "new", 5), (3, "new", 6)], "k int, v string, extra int")
    merged = {r.k: (r.v, r.extra) for r in se.merge_backfill(new, old, ["k"]).collect()}
    assert merged == {1: ("old", None), 2: ("new", 5), 3: ("new", 6)}
    again = se.merge_backfill(new, se.merge_backfill(new, old, ["k"]), ["k"])
    assert {r.k: (r.v, r.extra) for r in again.collect()} == merged


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["a b", "a-b", "A b", "hidden_link x"])
    assert co.safe_names(df, unique=True).columns == ["a_b", "a_", "A", "hidden_link_x"]
    assert co.drop_columns(df, "hidden_link").columns == ["a b", "a-b", "A b"]
    assert len(co.safe_name("x" * 200)) == 120
    assert len({n.lower() for n in co.unique_names(["a", "A", "a", " a "])}) == 4


def test_type_errors(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", None), ("d", "2.5")], "k string, v string")
    bad = co.type_errors(df, {"v": "double"}, ["k"])
    assert [(r["Row Number"], r.k, r.v) for r in bad.collect()] == [(2, "b", "x")]


def test_tags_widen_and_rebuild(spark):
    tags = ['{"a b": "1", "c": null}', "broken", None, '{"hidden-link: z": "9", "a b": "2"}', "{}", '{"' + "k" * 121 + '": "1"}']
    df = ne.parse_tags(spark.createDataFrame(list(enumerate(tags)), "i int, t string"), "t")
    wide = ne.widen_map(df, "t")
    assert wide.columns == ["i", "t", "a_b", "c"]
    assert [(r.a_b, r.c) for r in wide.orderBy("i").collect()] == [("1", None), (None, None), (None, None), ("2", None), (None, None), (None, None)]
    kept = ne.widen_map(df, "t", ["a b"], rest="others").orderBy("i").collect()
    assert [(r.a_b, r.others) for r in kept[:4]] == [("1", {"c": None}), (None, None), (None, None), ("2", {"hidden-link: z": "9"})]
    assert ne.widen_map(df, "t", [], rest="others").where("size(others) = 2").count() == 2


def test_a_million_keys_need_no_column(spark, folder):
    """200,000 rows of five keys that no other row has, and one that all have; the next load makes one more frequent."""
    keys = [x for k in range(5) for x in (F.concat(F.lit(f"k{k} "), "id"), F.lit(f"v{k}"))]
    many = spark.range(200_000).select("id", F.create_map(*keys, F.lit("unit"), F.lit("u")).alias("m"))
    assert ne.update_keys(many, "m", f"{folder}/keys", 0.01) == ["unit"]
    assert spark.read.parquet(f"{folder}/keys").count() == 1_000_001
    wide, rest = ne.split_map(many, "m", ["unit"], ["id"])
    assert wide.columns == ["id", "unit"] and wide.where("unit = 'u'").count() == 200_000
    assert rest.count() == 1_000_000 and rest.where("id = 7").orderBy("key").collect()[2][1:] == ("k2 7", "v2")
    few = spark.createDataFrame([(1, {"k0 7": "x"}), (2, None), (3, {"hidden-link: z": "1"})], "id long, m map<string,string>")
    assert ne.update_keys(few, "m", f"{folder}/keys", 0.3) == ["k0 7", "unit"]
    wide, rest = ne.split_map(few, "m", ["k0 7", "unit"], ["id"])
    assert [tuple(r) for r in wide.orderBy("id").collect()] == [(1, "x", None), (2, None, None), (3, None, None)]
    assert [tuple(r) for r in rest.collect()] == [(3, "hidden-link: z", "1")]


def test_any_number_of_tags(spark, folder):
    many = spark.range(6000).select(F.create_map(F.concat(F.lit("k"), "id"), F.lit("x")).alias("m"))
    assert len(ne.map_key_set(many, "m")) == 6000
    wide = ne.widen_map(many.limit(3), "m", [f"k{i}" for i in range(6000)]).drop("m")
    wide.write.parquet(f"{folder}/wide")
    assert len(spark.read.parquet(f"{folder}/wide").columns) == 6000


def test_missing_lists_and_teams(spark):
    df = spark.createDataFrame([(1, [("A",), ("B",)]), (2, []), (3, None)], "i int, teams array<struct<name:string>>")
    rows = ne.expand_teams(df, "teams").orderBy("i", "TeamName").collect()
    assert [(r.i, r.TeamName) for r in rows] == [(1, "A"), (1, "B"), (2, None), (3, None)]
    filled = df.select(F.size(ne.default_if_missing(F.col("teams"), F.array()))).collect()
    assert [r[0] for r in filled] == [2, 0, 0]
    assert [r[0] for r in df.select(ne.list_of(F.col("teams"), "name")).collect()] == [["A", "B"], [], None]


def test_filters(spark):
    df = spark.createDataFrame([(1, "Failed"), (2, "OK"), (3, None)], "i int, Status string")
    assert fi.any_failed(df) and not fi.any_failed(df.filter("i > 1"))
    assert {r.i for r in fi.where_not_in(df, "Status", ["OK"]).collect()} == {1, 3}
    assert {r.i for r in fi.exclude(df, "Status", ["OK", "Failed"], F.col("i") > 1).collect()} == {1, 3}
    days = spark.createDataFrame([(dt.datetime(2024, 2, 29, 23, 59),), (dt.datetime(2024, 3, 1),)], "t timestamp")
    assert fi.on_day(days, "t", "2024-02-29").count() == 1
    assert fi.newer_than(days, "t", None).count() == 2


def test_cumulative_restarts_each_year(spark):
    days = spark.createDataFrame([(dt.date(2023, 12, 30) + dt.timedelta(days=n),) for n in range(5)], "Datum date")
    facts = spark.createDataFrame([("a", dt.date(2023, 12, 30), 1.0), ("a", dt.date(2024, 1, 1), 5.0), (None, dt.date(2024, 1, 3), 7.0)], "k string, d date, v double")
    rows = wi.cumulative_ytd(wi.dense_grid(facts, days, "d", ["k"]), "v", "d", ["k"]).orderBy("k", "d").collect()
    assert [r.ytd for r in rows] == [None, None, None, None, 7.0, 1.0, 1.0, 5.0, 5.0, 5.0]


def test_captions_hold_all_members(spark):
    names = spark.range(60_000).select((F.col("id") % 20_000).cast("string").alias("n"))
    text = ag.concat_values(names, "n", separator=",", name="all").first()["all"]
    assert text.split(",") == sorted(map(str, range(20_000)))
    assert ag.members(names, "n").count() == 20_000


def test_schema_versions(spark, folder):
    path = f"{folder}/dictionary"
    a = spark.createDataFrame([], "Id int, name string")
    assert qu.track_schema(a, path, "2024-01-01", "t1") == 1
    assert qu.track_schema(spark.createDataFrame([], "id int, NAME string"), path, "2024-01-02", "t2") == 1
    assert qu.track_schema(spark.createDataFrame([], "id long, extra string"), path, "2024-01-03", "t3") == 2
    table = spark.read.parquet(path)
    drift = qu.schema_drift(qu.latest_version(table), table.filter("Version = 1"))
    assert {(r.name, r.change) for r in drift.collect()} == {("id", "changed"), ("name", "removed"), ("extra", "added")}
