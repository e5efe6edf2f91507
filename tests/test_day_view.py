"""The view kept by day: what a load touches, late and unreadable days, failures, merges."""

import datetime as dt
import glob

import pytest

from tallygrid.sources import costs
from tallygrid.sources.day_view import DayView


def rows(spark, *days):
    return spark.createDataFrame([(d, v, "x") for d, v in days], "date string, cost string, more string")


def held(view, version=None):
    return sorted((r.date or "", r.cost) for r in view.read(version).collect())


def test_late_changed_and_unreadable_days(spark, folder):
    view = DayView(spark, f"{folder}/view")
    assert view.read() is None and not view.append(rows(spark, ("01/01/2024", "1")).limit(0))
    first = rows(spark, ("01/01/2024", "1"), ("01/03/2024", "3"), ("soon", "a"))
    assert view.append(first) and not view.append(first) and view.version() == 1
    late = rows(spark, ("01/02/2024", "2"), ("01/02/2024", "2"), ("01/03/2024", "4"), ("later", "b"), (None, "c"))
    assert view.append(late) and not view.append(late) and view.version() == 2
    assert held(view) == [("", "c"), ("01/01/2024", "1"), ("01/02/2024", "2"), ("01/02/2024", "2"), ("01/03/2024", "4"), ("later", "b"), ("soon", "a")]
    assert held(view, 1) == [("01/01/2024", "1"), ("01/03/2024", "3"), ("soon", "a")]
    loads = {r.day: r.load for r in view.manifest().collect()}
    before = {r.day: r.load for r in view.manifest(1).collect()}
    assert loads[dt.date(2024, 1, 1)] == before[dt.date(2024, 1, 1)] and loads[dt.date(2024, 1, 3)] != before[dt.date(2024, 1, 3)]


def test_a_load_opens_its_own_days_only(spark, folder):
    """The files of other days are made unreadable: loads of one day do not notice."""
    view = DayView(spark, f"{folder}/view")
    assert view.append(rows(spark, *[(f"01/{d:02d}/2024", str(d)) for d in range(1, 21)]))
    for path in glob.glob(f"{folder}/view/data/*/day=2024-01-*/*.parquet"):
        if "day=2024-01-07" not in path:
            with open(path, "wb") as f:
                f.write(b"broken")
    assert view.append(rows(spark, ("01/07/2024", "new"), ("01/21/2024", "21")))
    assert view.merge(rows(spark, ("01/07/2024", "more")), ["date", "cost"])
    assert not view.merge(rows(spark, ("01/07/2024", "more")), ["date", "cost"])
    assert sorted(r.cost for r in view.read(days=[dt.date(2024, 1, 7), dt.date(2024, 1, 21)]).collect()) == ["21", "more", "new"]
    assert view.manifest().count() == 21


def test_a_failed_load_leaves_the_view(spark, folder, monkeypatch):
    view = DayView(spark, f"{folder}/view")
    view.append(rows(spark, ("01/01/2024", "1"), ("01/02/2024", "2")))
    with monkeypatch.context() as patch:
        patch.setattr(DayView, "_publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            view.append(rows(spark, ("01/02/2024", "x")))
    assert held(view) == [("01/01/2024", "1"), ("01/02/2024", "2")]
    assert view.append(rows(spark, ("01/02/2024", "x"))) and held(view) == [("01/01/2024", "1"), ("01/02/2024", "x")]


def test_two_writers_cannot_make_one_version(spark, folder, monkeypatch):
    view = DayView(spark, f"{folder}/view")
    view.append(rows(spark, ("01/01/2024", "1")))
    monkeypatch.setattr(DayView, "version", lambda self: 0)
    with pytest.raises(Exception, match="(?i)already exists"):
        view.append(rows(spark, ("01/02/2024", "2")))


def test_merge_keeps_one_row_per_key_and_the_new_one(spark, folder):
    root = f"{folder}/view"
    make = lambda *items: spark.createDataFrame(
        [tuple({"date": d, "costInBillingCurrency": c, "BusinessUnit": u}.get(k, "x") for k in costs.VIEW_COLUMNS) for d, c, u in items], ", ".join(f"{k} string" for k in costs.VIEW_COLUMNS))
    assert costs.backfill_days(spark, make(("01/01/2024", "1", "a"), ("01/02/2024", "2", "a"), ("01/02/2024", "2", "b")), root)
    assert costs.backfill_days(spark, make(("01/02/2024", "2", "A"), ("01/03/2024", "3", "a")), root)
    got = sorted((r.date, r.costInBillingCurrency, r.BusinessUnit) for r in DayView(spark, root).read().collect())
    assert got == [("01/01/2024", "1", "a"), ("01/02/2024", "2", "A"), ("01/03/2024", "3", "a")]
    assert not costs.backfill_days(spark, make(("01/03/2024", "3", "a")), root)
    assert costs.append_days(spark, make(("01/03/2024", "3", "z")), root)


def test_a_load_with_one_more_column(spark, folder):
    view = DayView(spark, f"{folder}/view")
    view.append(rows(spark, ("01/01/2024", "1")).drop("more"))
    view.append(rows(spark, ("01/02/2024", "2")))
    assert sorted((r.cost, r.more or "") for r in view.read().collect()) == [("1", ""), ("2", "x")]
