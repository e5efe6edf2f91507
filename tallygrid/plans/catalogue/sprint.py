"""Sprint board: story points, progress, capacity."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrid.functions import blank
from tallygrid.plans import metric as m
from tallygrid.plans.metric import Metric

# --- fixed values: status texts ---------------------------------------------------
DONE = ["gereed"]
ON_HOLD = ["Waiting", "In Test", "Review Passed", "Wordt beoordeeld", "Test Passed"]
TO_DO = "Nog Doen"
# ----------------------------------------------------------------------------------

POINTS = "FeitSprintDetails.StoryPoints"
STATUS = "DimStatus.Status"


def _share(part, total):
    zero = F.lit(0.0)
    return blank.safe_div(F.coalesce(part, zero), F.coalesce(total, zero), 0)


def sprint() -> dict[str, Metric]:
    points = m.sum_(POINTS)
    done, held = m.where(points, m.is_in(STATUS, DONE)), m.where(points, m.is_in(STATUS, ON_HOLD))
    capacity = m.sum_("FeitSprintCapaciteit.TotaalUren")
    return {
        "Totaal Aantal storypoints": points,
        "Totaal Aantal storypoints (variant 2)": points,
        "Totaal Aantal storypoints KPI": m.derived(lambda c: F.coalesce(c, F.lit(0.0)), points),
        "Aantal Projecten (variant 2)": m.distinct_("DimProjecten.Column1.key"),
        "Procent Afgerond": m.derived(_share, done, points),
        "Procent Afgerond (variant 2)": m.ratio(done, points, 0),
        "Procent On Hold": m.derived(_share, held, points),
        "Procent On Hold (variant 2)": m.ratio(held, points, 0),
        "StoryPoints To Do": m.where(points, m.eq(STATUS, TO_DO)),
        "Huidige Sprint": m.max_("DimSprint.SprintName"),
        "Capaciteit": capacity,
        "To do / capaciteit": m.ratio(points, capacity, 0),
    }


def sprint_old() -> dict[str, Metric]:
    """The older board: projects are told apart by name."""
    return {**sprint(), "Aantal Projecten (variant 3)": m.distinct_("DimProjecten.Project")}
