"""Metric evaluation: blank members, context rules, periods, plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallygrid.checks import all_queries, shapes
from tallygrid.functions.dates import date_table
from tallygrid.plans import catalogue, metric as m, models, period as t
from tallygrid.plans.catalogue import operations as ops
from tallygrid.plans.evaluate import evaluate
from tallygrid.plans.model import Model
from tallygrid.plans.period import Period

AS_OF = dt.date(2024, 2, 29)
NOW = Period(AS_OF)
FACTS = [
    # day, member, amount
    ("2023-02-28", 1, 10.0), ("2023-03-31", 2, 20.0), ("2024-02-29", 1, 40.0), ("2024-02-01", 9, 80.0), ("2024-01-31", None, 160.0),
    ("2025-03-01", 2, 320.0), ("2022-02-28", 1, 640.0),
]


@pytest.fixture(scope="module")
def small(spark):
    facts = spark.createDataFrame([(dt.date.fromisoformat(d), k, v) for d, k, v in FACTS], "day date, k int, v double")
    dim = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y")], "k int, name string, kind string")
    other = spark.createDataFrame([(1, 5.0), (3, 7.0)], "k int, w double")
    days = date_table(spark, "2022-01-01", "2025-12-31", AS_OF)
    links = models.parse_links("F.day > DimDatum.Datum\nF.k > D.k\nG.k > D.k")
    return Model({"F": lambda: facts, "D": lambda: dim, "G": lambda: other, "DimDatum": lambda: days}, links)


def values(df, key="name"):
    return {r[key]: tuple(r[c] for c in df.columns if c != key) for r in df.collect()}


V, W = m.sum_("F.v"), m.sum_("G.w")


def test_orphans_land_on_the_blank_member(small):
    assert values(evaluate(small, {"v": V, "n": m.rows("F")}, by=["D.name"])) == {"a": (690.0, 3), "b": (340.0, 2), None: (240.0, 2)}


def test_drill_across_keeps_members_of_either_fact(small):
    got = values(evaluate(small, {"v": V, "w": W, "d": m.minus(W, V)}, by=["D.name"]))
    assert got == {"a": (690.0, 5.0, -685.0), "b": (340.0, None, -340.0), "c": (None, 7.0, 7.0), None: (240.0, None, -240.0)}


def test_totals_are_evaluated_again(small):
    df = evaluate(small, {"n": m.distinct_("F.k"), "v": V}, by=["D.kind"], totals=True)
    got = {(r.kind, r.grouping_level): (r.n, r.v) for r in df.collect()}
    assert got == {("x", 0): (2, 1030.0), (None, 0): (2, 240.0), (None, 1): (4, 1270.0)}


def test_context_rules(small):
    metrics = {
        "v": V, "all": m.ignoring(V, "D"), "kind": m.keep_only(V, "D", "D.kind"), "chosen": m.over_selection(V, "D.name"),
    }
    got = values(evaluate(small, metrics, by=["D.name"], where=[m.eq("D.kind", "X")]))
    assert got == {"a": (690.0, 1270.0, 1030.0, 1030.0), "b": (340.0, 1270.0, 1030.0, 1030.0)}


def test_windows_partition_all_months(small):
    last = evaluate(small, {"v": t.last_12m(V, NOW)}).first().v
    earlier = evaluate(small, {"v": m.where(V, m.compare("DimDatum.Datum", "<", dt.date(2023, 3, 1)))}).first().v
    later = evaluate(small, {"v": m.where(V, m.compare("DimDatum.Datum", ">", AS_OF))}).first().v
    assert (last, earlier, later) == (300.0, 650.0, 320.0) and last + earlier + later == sum(f[2] for f in FACTS)
    assert evaluate(small, {"v": t.previous_12m(V, NOW)}).first().v == 10.0
    assert evaluate(small, {"v": t.next_12m(V, NOW, include_current=False)}).first().v is None


def test_leap_day_shows_a_year_later_on_28_february(small):
    got = {r.Datum: r.v for r in evaluate(small, {"v": t.last_year(V)}, by=["DimDatum.Datum"]).collect()}
    assert got[dt.date(2025, 2, 28)] == 40.0 and got[dt.date(2024, 2, 28)] == 10.0


def test_year_to_date_on_31_december_is_the_year(small):
    last = dt.date(2023, 12, 31)
    ytd = evaluate(small, {"v": t.year_to_date(V, last)}).first().v
    assert ytd == evaluate(small, {"v": V}, by=["DimDatum.Jaar"]).filter("Jaar = 2023").first().v


def test_previous_month_and_weeks():
    assert t.week_start(dt.date(2024, 1, 17)) == dt.date(2024, 1, 14)
    assert t.run_dates(AS_OF, days_back=2) == [dt.date(2024, 2, 27), dt.date(2024, 2, 28)]
    assert ops.month_end(AS_OF, 12) == dt.date(2025, 2, 28)


def test_predicates_treat_blank_as_defined(small):
    def total(*where):
        return evaluate(small, {"v": V}, where=list(where)).first().v

    assert total(m.ne("D.name", "a")) == 580.0 and total(m.not_in("D.name", ["B"])) == 930.0
    assert total(m.eq("F.k", 0)) == 160.0 and total(m.not_zero("F.k")) == 1110.0
    assert total(m.any_of(m.eq("D.name", "a"), m.is_blank("F.k"))) == 850.0


def test_unknown_lookups_are_refused(small):
    with pytest.raises(ValueError):
        evaluate(small, {"v": m.where(V, m.eq("G.w", 5))}).collect()


def test_every_catalogue_metric_is_registered():
    known = {
        *catalogue.operational(NOW), *catalogue.contracts(NOW), *catalogue.sprint(), *catalogue.operational_old(NOW), "WinstPerContract",
    }
    shown = {name for q in all_queries().values() for name in getattr(q, "metrics", [])}
    elsewhere = {"AzureKostenRangRG"}  # a rank, not an aggregate: operators.numbering.rank_dense
    assert not known - shown - elsewhere
    # 258 in the catalogue; one is the rank, one needs the older sprint board
    assert len(known) == 256


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def test_date_windows_reach_the_scan(spark, sf_dir):
    revenue = m.sum_("FeitFactuurregels.BedragExclBTW")
    metrics = {"now": t.last_12m(revenue, Period(shapes.AS_OF)), "before": t.previous_12m(revenue, Period(shapes.AS_OF))}
    plan = plan_of(evaluate(shapes.operational(spark, sf_dir), metrics, by=["DimKlanten.Branche"]))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("lineitem.parquet") == 1  # both periods from one scan
    scan = next(line for line in physical.splitlines() if "lineitem.parquet" in line)
    assert "GreaterThanOrEqual(l_shipdate,1996-06-01T00:00), LessThan(l_shipdate," in scan
    assert "l_returnflag" not in physical


def test_no_cross_joins_or_python(spark, sf_dir):
    for name, build in all_queries().items():
        if getattr(build, "metrics", None):
            plan = plan_of(build(spark, sf_dir))
            for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython"):
                assert word not in plan, (name, word)


def test_filters_on_the_other_fact_restrict(spark):
    """Over a semi and a both relation, by a column of the other fact and by a dimension that only it looks up."""
    from tallygrid.plans.evaluate import evaluate as run
    from tallygrid.plans.model import Model as Tables
    from tallygrid.plans.models import parse_links

    links = parse_links("Roster.Who > Staff.Who semi\nScore.Project > Project.Id both\nHours.Project > Project.Id\nStaff.Team > Team.Id")
    frame = lambda rows, schema: lambda: spark.createDataFrame(rows, schema)
    model = Tables({
        "Roster": frame([("a", 1.0), ("b", 2.0), ("c", 4.0), (None, 8.0)], "Who string, H double"),
        "Staff": frame([("a", 1, 1), ("a", 1, 2), ("b", 2, 1), (None, 1, 1)], "Who string, Fte int, Team int"),
        "Team": frame([(1, "x"), (2, "y")], "Id int, Name string"),
        "Score": frame([(1, 5), (1, 9), (2, 1), (None, 7)], "Project int, S int"),
        "Project": frame([(1,), (2,), (3,)], "Id int"),
        "Hours": frame([(1, 1.0), (1, 2.0), (2, 4.0), (3, 8.0)], "Project int, H double"),
    }, links)
    value = lambda metric, *where: run(model, {"v": metric}, where=list(where)).head().v
    assert value(m.sum_("Roster.H"), m.eq("Staff.Fte", 1)) == 1.0
    assert value(m.sum_("Roster.H"), m.eq("Team.Name", "x")) == 3.0
    assert value(m.sum_("Roster.H"), m.eq("Team.Name", "x"), m.eq("Staff.Fte", 2)) == 2.0
    assert value(m.rows("Project"), m.compare("Score.S", ">=", 5)) == 1
    assert value(m.sum_("Hours.H"), m.compare("Score.S", ">=", 5)) == 3.0
    assert value(m.ignoring(m.sum_("Roster.H"), "Staff"), m.eq("Staff.Fte", 1)) == 15.0
