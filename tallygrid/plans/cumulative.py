"""Year-to-date metrics by month: each month reads its year so far."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallygrid.plans.evaluate import evaluate
from tallygrid.plans.metric import Metric, Pred
from tallygrid.plans.model import Model
from tallygrid.plans.period import running_ytd

MONTH_KEYS = ["Jaar", "MaandNummer"]


def evaluate_ytd(
    model: Model, metrics: dict[str, Metric], by: Sequence[str] = (), where: Sequence[Pred] = (), date: str = "DimDatum"
) -> DataFrame:
    """Running values from January for every month of every year with a value, twelve rows a year.

    Any metric will do: a month reads the rows of its year so far, so averages, distinct counts and ratios are
    those of these rows. A month without rows of its own shows the value so far; one before the first row is empty.
    """
    running = {n: running_ytd(x, date=date) for n, x in metrics.items()}
    monthly = evaluate(model, running, [*by, *[f"{date}.{c}" for c in MONTH_KEYS]], where)
    members = [c for c in monthly.columns if c not in [*metrics, *MONTH_KEYS]]
    months = F.explode(F.sequence(F.lit(1), F.lit(12)).cast("array<bigint>")).alias("MaandNummer")
    years = monthly.filter(F.col("Jaar").isNotNull()).select(*[F.col(f"`{c}`") for c in members], "Jaar").distinct()
    keys = [*members, *MONTH_KEYS]
    renamed = monthly.withColumnsRenamed({c: f"_r_{i}" for i, c in enumerate(keys)})
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_r_{i}")) for i, c in enumerate(keys)]
    dense = years.select("*", months).join(renamed, same, "left")
    return dense.select(*[F.col(f"`{c}`") for c in keys], *[F.col(f"`{n}`") for n in metrics])
