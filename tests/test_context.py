"""Filter context: dates by grouping, filters over several steps, virtual relationships, totals of every metric."""

import datetime as dt
import random
import warnings

import pytest

from tallygrid.functions.dates import date_table
from tallygrid.plans import metric as m, models, period as t
from tallygrid.plans.evaluate import evaluate
from tallygrid.plans.model import Model

AS_OF = dt.date(2024, 6, 30)


def rows_of(seed=2, n=600):
    """A third of the rows has one key; some days lie outside the calendar; keys and days may be empty."""
    r = random.Random(seed)
    days = [dt.date(2021, 11, 1) + dt.timedelta(days=r.randrange(1200)) for _ in range(n)]
    return [(d if r.random() > 0.03 else None, 1 if i % 3 == 0 else r.choice([2, 3, 9, None]), float(r.randrange(50)), r.randrange(12)) for i, d in enumerate(days)]


@pytest.fixture(scope="module")
def small(spark):
    facts = spark.createDataFrame(rows_of(), "day date, k int, v double, who int")
    dim = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y")], "k int, name string, kind string")
    days = date_table(spark, "2022-01-01", "2024-12-31", AS_OF)
    links = models.parse_links("F.day > DimDatum.Datum\nF.k > D.k")
    return Model({"F": lambda: facts, "D": lambda: dim, "DimDatum": lambda: days}, links)


V, WHO, AVG = m.sum_("F.v"), m.distinct_("F.who"), m.avg_("F.v")
CALENDAR = [dt.date(2022, 1, 1) + dt.timedelta(days=i) for i in range(1096)]


def brute(window, key, of, where=lambda d: True):
    """{key of a day: metric over the days that the group's last day reads}."""
    last = {}
    for d in CALENDAR:
        if where(d):
            last[key(d)] = max(d, last.get(key(d), d))
    out = {}
    for group, day in last.items():
        if window == "ytd":
            low, high = day.replace(month=1, day=1), day
        else:
            high = day.replace(day=1) - dt.timedelta(days=1)
            low = high.replace(day=1)
        # what lies outside the calendar is on no day of it
        kept = [x for x in rows_of() if x[0] and low <= x[0] <= high and x[0] in set(CALENDAR)]
        if kept:
            out[group] = of(kept)
    return out


def of(kept):
    return (sum(x[2] for x in kept), len({x[3] for x in kept}), round(sum(x[2] for x in kept) / len(kept), 9))


GROUPS = {
    "DimDatum.Jaar DimDatum.MaandNummer": lambda d: (d.year, d.month),
    "DimDatum.Jaar": lambda d: (d.year,),
    "DimDatum.MaandNummer": lambda d: (d.month,),  # a month of all years reads around its last day
    "DimDatum.Datum": lambda d: (d,),
    "": lambda d: (),
}


@pytest.mark.parametrize("by", list(GROUPS))
@pytest.mark.parametrize("window", ["ytd", "before"])
def test_windows_follow_the_grouping(small, by, window):
    f = t.running_ytd if window == "ytd" else t.month_before
    metrics = {"v": f(V), "who": f(WHO), "avg": f(AVG)}
    got = {tuple(r[:-3]): (r.v, r.who, round(r.avg, 9)) for r in evaluate(small, metrics, by=by.split()).collect()}
    assert got == brute(window, GROUPS[by], of)


def test_windows_see_the_selected_days(small):
    where = [m.between("DimDatum.Datum", dt.date(2023, 2, 10), dt.date(2023, 5, 20))]
    key = lambda d: (d.year, d.month)
    got = {(r.Jaar, r.MaandNummer): (r.v, r.who, round(r.avg, 9)) for r in evaluate(small, {"v": t.running_ytd(V), "who": t.running_ytd(WHO), "avg": t.running_ytd(AVG)}, by=["DimDatum.Jaar", "DimDatum.MaandNummer"], where=where).collect()}
    assert got == brute("ytd", key, of, lambda d: dt.date(2023, 2, 10) <= d <= dt.date(2023, 5, 20))


def test_window_without_selection_ends_on_the_named_day(small):
    day = dt.date(2023, 4, 5)
    dated = [x for x in rows_of() if x[0]]
    want = sum(x[2] for x in dated if dt.date(2023, 1, 1) <= x[0] <= day)
    march = sum(x[2] for x in dated if (x[0].year, x[0].month) == (2023, 3))
    df = evaluate(small, {"y": t.running_ytd(V, day), "b": t.month_before(V, day), "v": V})
    assert tuple(df.first()) == (want, march, sum(x[2] for x in rows_of()))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1  # one scan for all three
    named = {r.name: r.y for r in evaluate(small, {"y": t.running_ytd(V, day)}, by=["D.name"]).collect()}
    assert sum(named.values()) == want


def test_an_inner_choice_of_dates_stays(small):
    fixed = t.in_dates(V, dt.date(2022, 1, 1), dt.date(2022, 12, 31))
    got = {r.v for r in evaluate(small, {"v": t.running_ytd(fixed), "n": V}, by=["DimDatum.Jaar"]).collect() if r.Jaar}
    assert len(got) == 1


def test_windows_and_plain_metrics_share_no_rows(small):
    """A month read by twelve groups counts once for a plain metric."""
    by = ["DimDatum.Jaar", "DimDatum.MaandNummer"]
    both = {(r.Jaar, r.MaandNummer): r.v for r in evaluate(small, {"v": V, "y": t.running_ytd(V)}, by=by).collect() if r.v is not None}
    assert both == {(r.Jaar, r.MaandNummer): r.v for r in evaluate(small, {"v": V}, by=by).collect()}


def test_totals_never_raise(small):
    metrics = {
        "v": V, "ytd": t.running_ytd(V), "most": m.sum_of_max("F.v", "F.who"), "of_kind": m.keep_only(V, "D", "D.kind"),
        "all": m.ignoring(V, "D"), "n": WHO, "who": t.running_ytd(WHO),
    }
    by = ["D.kind", "D.name"]
    for totals in (True, "rollup"):
        got = {(r.kind, r.name, r.grouping_level): r for r in evaluate(small, metrics, by=by, totals=totals).collect()}
        levels = {0: by, 1: ["D.kind"], 2: []} if totals == "rollup" else {0: by, 2: []}
        for level, own in levels.items():
            want = evaluate(small, metrics, by=own)
            assert want.count() == sum(k[2] == level for k in got)
            for r in want.collect():
                key = (r.kind if "D.kind" in own else None, r.name if "D.name" in own else None, level)
                assert all(got[key][c] == r[c] for c in metrics), (key, level)


def test_a_grouping_that_every_metric_ignores_in_part(small):
    total = sum(x[2] for x in rows_of())
    got = evaluate(small, {"v": m.ignoring(V, "D", "DimDatum")}, by=["D.kind", "DimDatum.Jaar"], where=[m.compare("DimDatum.Jaar", ">=", 2023)]).collect()
    assert sorted((r.kind, r.Jaar) for r in got) == [(k, y) for k in "xy" for y in (2023, 2024)] and {r.v for r in got} == {total}
    rolled = evaluate(small, {"v": m.ignoring(V, "DimDatum")}, by=["D.kind", "DimDatum.Jaar"], totals="rollup").collect()
    assert sorted(str((r.kind, r.Jaar)) for r in rolled if r.grouping_level == 0) == sorted(str((k, y)) for k in ("x", "y", None) for y in (2022, 2023, 2024))
    assert [r.v for r in rolled if r.grouping_level == 2] == [total]


# --- filters over several steps ---------------------------------------------------------------


def chain(spark, links):
    score = spark.createDataFrame([(1, 5), (2, 3), (2, 4)], "p int, score int")
    project = spark.createDataFrame([(1, 10), (2, 20), (3, 10)], "p int, c int")
    task = spark.createDataFrame([(100, 1), (200, 2), (300, 3)], "t int, p int")
    hours = spark.createDataFrame([(100, 1.0), (200, 2.0), (300, 4.0), (None, 8.0)], "t int, h double")
    customer = spark.createDataFrame([(10, "x"), (20, "y")], "c int, name string")
    tables = {"Score": score, "Project": project, "Task": task, "Hours": hours, "Customer": customer}
    return Model({k: lambda df=df: df for k, df in tables.items()}, models.parse_links(links), frozenset())


LINKS = "Score.p > Project.p both\nTask.p > Project.p\nHours.t > Task.t\nProject.c > Customer.c"
HOURS = m.sum_("Hours.h")


def test_a_filter_goes_over_two_steps(spark):
    model = chain(spark, LINKS)
    assert evaluate(model, {"h": HOURS}, where=[m.eq("Score.score", 5)]).first().h == 1.0
    assert evaluate(model, {"h": HOURS}, where=[m.compare("Score.score", ">=", 3)]).first().h == 3.0
    assert evaluate(model, {"h": HOURS}, where=[m.compare("Score.score", ">=", 3), m.eq("Customer.name", "y")]).first().h == 2.0
    assert evaluate(model, {"h": m.ignoring(HOURS, "Score")}, where=[m.eq("Score.score", 5)]).first().h == 15.0


def test_a_filter_told_by_lookups_before_it_goes_on(spark):
    """A customer reaches scores by lookups; where only scores carry on, the scores of that customer do."""
    model = chain(spark, "Score.p > Project.p\nProject.c > Customer.c\nScore.p > Task.p both\nHours.t > Task.t")
    assert evaluate(model, {"h": HOURS}, where=[m.eq("Customer.name", "x")]).first().h == 1.0


def test_circles_end_and_unreached_filters_are_reported(spark):
    circle = chain(spark, "Score.p > Project.p both\nTask.p > Project.p both\nHours.t > Task.t both\nTask.p > Score.p both")
    assert evaluate(circle, {"h": HOURS}, where=[m.eq("Score.score", 5)]).first().h == 1.0
    apart = chain(spark, "Hours.t > Task.t\nTask.p > Project.p\nScore.p > Customer.c")
    with pytest.warns(UserWarning, match="no relation carries"):
        assert evaluate(apart, {"h": HOURS}, where=[m.eq("Score.score", 5)]).first().h == 15.0
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        evaluate(chain(spark, LINKS), {"h": HOURS}, where=[m.eq("Score.score", 5), m.eq("Customer.name", "x")])


# --- virtual relationships ---------------------------------------------------------------------


def test_values_treated_as_a_key(small):
    """With and without a relationship; rows outside the date table do not count."""
    inside = [x for x in rows_of() if x[0] and dt.date(2022, 1, 1) <= x[0] <= dt.date(2024, 12, 31)]
    treated = m.treat_as(V, "DimDatum.Datum", "F.day")
    bare = Model(small.loaders, models.parse_links("F.k > D.k"), small.date_tables)
    for model in (small, bare):
        assert evaluate(model, {"v": treated}).first().v == sum(x[2] for x in inside) < sum(x[2] for x in rows_of())
        by_year = {r.Jaar: r.v for r in evaluate(model, {"v": treated}, by=["DimDatum.Jaar"]).collect()}
        assert by_year == {y: sum(x[2] for x in inside if x[0].year == y) for y in (2022, 2023, 2024)}
        chosen = evaluate(model, {"v": treated}, by=["D.name"], where=[m.eq("DimDatum.Jaar", 2023)]).collect()
        assert sum(r.v for r in chosen) == by_year[2023]
    both = evaluate(small, {"v": V, "w": treated, "d": m.minus(V, treated)}).first()
    assert both.d == both.v - both.w > 0


def test_year_to_date_of_any_metric_by_month(small):
    """Averages and distinct counts are those of the year so far, not sums of months; twelve rows a year."""
    from tallygrid.plans.cumulative import evaluate_ytd

    got = {(r.Jaar, r.MaandNummer): (r.v, r.who, r.avg and round(r.avg, 9)) for r in evaluate_ytd(small, {"v": V, "who": WHO, "avg": AVG}).collect()}
    want = brute("ytd", lambda d: (d.year, d.month), of)
    assert len(got) == 36 and {k: v for k, v in got.items() if v[0] is not None} == want


def test_running_points_are_no_more_than_the_rows(spark):
    from tallygrid.operators import windows as wi

    r = random.Random(4)
    data = [(r.randrange(5), dt.date(2020, 1, 1) + dt.timedelta(days=r.randrange(1500)), float(r.randrange(9))) for _ in range(300)]
    frame = spark.createDataFrame(data, "k int, day date, v double")
    points = wi.running_points(frame, "v", "day", ["k"])
    assert points.count() <= 300
    asked = [(k, dt.date(2020, 1, 1) + dt.timedelta(days=d)) for k in range(6) for d in range(0, 1500, 50)]
    got = {(x.k, x.day): x.ytd for x in wi.running_on(points, spark.createDataFrame(asked, "k int, day date"), "day", ["k"]).collect()}
    held = {(x.k, x.day): (x.ytd, x.valid_to) for x in points.collect()}
    for k, day in asked:
        so_far = [v for a, d, v in data if a == k and d.year == day.year and d <= day]
        assert got[k, day] == (sum(so_far) if so_far else None)
        ranges = [t for (a, d), (t, to) in held.items() if a == k and d <= day <= to]
        assert ranges == ([sum(so_far)] if so_far else [])
