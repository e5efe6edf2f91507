"""Queries about filter context: running and shifted dates by grouping, filters over several steps, virtual relationships, totals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallygrid.checks import shapes
from tallygrid.checks.registry import query, rounded
from tallygrid.checks.shapes import AS_OF
from tallygrid.functions.dates import date_table
from tallygrid.plans import metric as m, models, period as t
from tallygrid.plans.catalogue import contracts, operations as ops
from tallygrid.plans.evaluate import evaluate
from tallygrid.plans.period import Period

NOW = Period(AS_OF)
BILLED = m.sum_("FeitFacturen.Subtotaal")
_DAY = "CAST(f.Factuurdatum AS DATE)"
_SO_FAR = f"{_DAY} BETWEEN date_trunc('year', c.laatste) AND c.laatste"
_BEFORE = "BETWEEN date_trunc('month', c.laatste) - INTERVAL 1 MONTH AND date_trunc('month', c.laatste) - INTERVAL 1 DAY"


@query(
    "running_metrics_by_month",
    f"""
    WITH c AS (SELECT Jaar, MaandNummer, max(Datum) AS laatste FROM "DimDatum" GROUP BY ALL),
    y AS (SELECT Jaar, MaandNummer, sum(Subtotaal) AS billed, count(DISTINCT KlantKey) AS klanten, avg(Subtotaal) AS gemiddeld, max(Subtotaal) AS hoogste
          FROM c JOIN "FeitFacturen" f ON {_SO_FAR} GROUP BY ALL),
    g AS (SELECT c.Jaar, c.MaandNummer, sum(FTE_x_MonthGoal) AS goal
          FROM c JOIN "FeitBudgetten" f ON f.MonthDateKey BETWEEN c.Jaar * 10000 + 101 AND c.Jaar * 10000 + c.MaandNummer * 100 + 31 GROUP BY ALL),
    k AS (SELECT Jaar, MaandNummer, sum(KostprijsTarief) AS kost FROM c JOIN "FeitGeschrevenUren" f ON CAST(f.Datum AS DATE) BETWEEN date_trunc('year', c.laatste) AND c.laatste GROUP BY ALL),
    pb AS (SELECT Jaar, MaandNummer, sum(Subtotaal) AS billed FROM c JOIN "FeitFacturen" f ON {_DAY} {_BEFORE} GROUP BY ALL),
    pk AS (SELECT Jaar, MaandNummer, sum(KostprijsTarief) AS kost FROM c JOIN "FeitGeschrevenUren" f ON CAST(f.Datum AS DATE) {_BEFORE} GROUP BY ALL),
    n AS (SELECT year({_DAY}) AS Jaar, month({_DAY}) AS MaandNummer, sum(Subtotaal) AS billed FROM "FeitFacturen" f GROUP BY ALL)
    SELECT c.Jaar, c.MaandNummer, round(n.billed, 4) AS month, round(y.billed, 4) AS ytd, round(g.goal, 4) AS goal_ytd, y.klanten AS customers_ytd,
           round(y.gemiddeld, 2) AS average_ytd, round(y.hoogste, 4) AS highest_ytd,
           round((coalesce(y.billed, 0) - coalesce(k.kost, 0)) / nullif(y.billed, 0), 4) AS margin_ytd,
           round((coalesce(pb.billed, 0) - coalesce(pk.kost, 0)) / nullif(pb.billed, 0), 4) AS margin_month_before
    FROM c LEFT JOIN y USING (Jaar, MaandNummer) LEFT JOIN g USING (Jaar, MaandNummer) LEFT JOIN k USING (Jaar, MaandNummer)
    LEFT JOIN pb USING (Jaar, MaandNummer) LEFT JOIN pk USING (Jaar, MaandNummer) LEFT JOIN n USING (Jaar, MaandNummer)
    WHERE n.billed IS NOT NULL OR y.billed IS NOT NULL OR g.goal IS NOT NULL OR (pb.billed IS NOT NULL AND pb.billed <> 0)
    """,
)
def running_by_month(spark, sf_dir):
    known, plans = ops.revenue(NOW), ops.budget(NOW)
    metrics = {
        "month": BILLED, "ytd": known["Cumulatieve Factuuromzet"], "goal_ytd": plans["Cumulatief Budget"],
        "customers_ytd": t.running_ytd(m.distinct_("FeitFacturen.KlantKey")), "average_ytd": t.running_ytd(m.avg_("FeitFacturen.Subtotaal")),
        "highest_ytd": t.running_ytd(m.max_("FeitFacturen.Subtotaal")), "margin_ytd": t.running_ytd(known["Brutomarge %"]),
        "margin_month_before": known["Brutomarge % Vorige Maand"],
    }
    shown = evaluate(shapes.operational(spark, sf_dir), metrics, by=["DimDatum.Jaar", "DimDatum.MaandNummer"])
    # an average of cents has no fixed last digit in either engine
    return rounded(shown.withColumn("average_ytd", F.round("average_ytd", 2)))


@query(
    "running_metrics_by_practice_and_quarter",
    f"""
    WITH c AS (SELECT Jaar, KwartaalNummer, max(Datum) AS laatste FROM "DimDatum" WHERE Jaar >= 1997 GROUP BY ALL),
    f AS (SELECT f.*, p.PracticeNaam FROM "FeitFacturen" f LEFT JOIN "DimPractice" p ON p.PracticeKey = f.PracticeKey)
    SELECT PracticeNaam, Jaar, KwartaalNummer, round(sum(Subtotaal), 4) AS ytd, count(DISTINCT KlantKey) AS customers_ytd
    FROM c JOIN f ON {_SO_FAR} GROUP BY ALL
    """,
)
def running_by_practice(spark, sf_dir):
    metrics = {"ytd": t.running_ytd(BILLED), "customers_ytd": t.running_ytd(m.distinct_("FeitFacturen.KlantKey"))}
    by = ["DimPractice.PracticeNaam", "DimDatum.Jaar", "DimDatum.KwartaalNummer"]
    return rounded(evaluate(shapes.operational(spark, sf_dir), metrics, by=by, where=[m.compare("DimDatum.Jaar", ">=", 1997)]))


#: Scores narrow projects, projects their task lines, and these the hours: two steps beyond the relation that filters both ways.
TASK_LINKS = """
FeitTevredenheid.ProjectKey > DimProjecten.ProjectKey both
DimTaakregels.ProjectKey > DimProjecten.ProjectKey
FeitGeschrevenUren.TaakregelKey > DimTaakregels.TaakregelKey
DimProjecten.KlantKey > DimKlanten.KlantKey
"""


@query(
    "task_hours_of_projects_by_score",
    """
    WITH s AS (SELECT ProjectKey FROM "DimProjecten" WHERE ProjectKey IN (SELECT ProjectKey FROM "FeitTevredenheid" WHERE Score >= 3))
    SELECT t.TaakNaam, round(sum(u.AantalUren), 4) AS hours, count(DISTINCT t.ProjectKey) AS projects
    FROM "FeitGeschrevenUren" u JOIN "DimTaakregels" t ON t.TaakregelKey = u.TaakregelKey WHERE t.ProjectKey IN (SELECT ProjectKey FROM s) GROUP BY 1
    """,
)
def task_hours_by_score(spark, sf_dir):
    model = models.Definition(models.parse_links(TASK_LINKS), frozenset()).with_loaders(shapes.operational(spark, sf_dir).loaders)
    hours, projects = m.sum_("FeitGeschrevenUren.AantalUren"), m.Base("FeitGeschrevenUren", "distinct", "DimTaakregels.ProjectKey")
    return rounded(evaluate(model, {"hours": hours, "projects": projects}, by=["DimTaakregels.TaakNaam"], where=[m.compare("FeitTevredenheid.Score", ">=", 3)]))


_WITHIN = "BETWEEN DATE '1996-03-01' AND DATE '1997-06-30'"


@query(
    "contract_totals_within_calendar",
    f"""
    WITH t AS (SELECT "Debiteurnummer" AS d, sum("Total Price") AS v FROM "contract_opbrengsten" WHERE "Termijn Maand Datum" {_WITHIN} GROUP BY 1),
    h AS (SELECT "Debiteurnummer" AS d, sum(Opbrengsten) AS v, sum(Kosten) AS k FROM "s4_inf billable_uren" WHERE CAST(Datum AS DATE) {_WITHIN} GROUP BY 1),
    u AS (SELECT "Debiteurnummer" AS d, sum("Sum of Cost Amount") AS k FROM "niet_factureerbare_uren" WHERE CAST(Krow__Date__c AS DATE) {_WITHIN} GROUP BY 1),
    a AS (SELECT "Debiteurnummer" AS d, sum(costInBillingCurrency) AS k FROM "cost_view_exported" WHERE CAST(date AS DATE) {_WITHIN} GROUP BY 1),
    x AS (SELECT d, v, NULL AS k FROM t UNION ALL SELECT d, v, k FROM h UNION ALL SELECT d, NULL, k FROM u UNION ALL SELECT d, NULL, k FROM a),
    z AS (SELECT n."Debiteurnummer", sum(v) AS v, sum(k) AS k FROM x LEFT JOIN "KlantDim" n ON n."Debiteurnummer" = x.d GROUP BY 1)
    SELECT "Debiteurnummer", round(v, 4) AS revenue, round(k, 4) AS cost, round(coalesce(v, 0) - coalesce(k, 0), 4) AS profit FROM z
    """,
)
def totals_within_calendar(spark, sf_dir):
    known = contracts(Period(shapes.COST_AS_OF))
    short = date_table(spark, dt.date(1996, 3, 1), dt.date(1997, 6, 30), AS_OF)
    model = shapes.contracts(spark, sf_dir).replacing({"dim_datum": lambda: short})
    metrics = {"revenue": known["TotaleOpbrengst"], "cost": known["TotaleKosten"], "profit": known["winst"]}
    return rounded(evaluate(model, metrics, by=["KlantDim.Debiteurnummer"]))


@query(
    "totals_of_every_metric",
    """
    WITH c AS (SELECT Jaar, MaandNummer, max(Datum) AS laatste, 0 AS level FROM "DimDatum" GROUP BY ALL
               UNION ALL SELECT Jaar, NULL, max(Datum), 1 FROM "DimDatum" GROUP BY ALL UNION ALL SELECT NULL, NULL, max(Datum), 2 FROM "DimDatum"),
    y AS (SELECT c.Jaar, c.MaandNummer, level, sum(Subtotaal) AS ytd FROM c JOIN "FeitFacturen" f
          ON CAST(f.Factuurdatum AS DATE) BETWEEN date_trunc('year', c.laatste) AND c.laatste GROUP BY ALL),
    v AS (SELECT d.Jaar, d.MaandNummer, f.DatumAangevraagd AS aanvraag, f.Verlofuren AS uren FROM "FeitVerlofAanvragen" f LEFT JOIN "DimDatum" d ON d.Datum = CAST(f.Datum AS DATE)),
    s AS (SELECT Jaar, MaandNummer, 0 AS level, sum(h) AS leave FROM (SELECT Jaar, MaandNummer, aanvraag, max(uren) AS h FROM v GROUP BY ALL) GROUP BY ALL
          UNION ALL SELECT Jaar, NULL, 1, sum(h) FROM (SELECT Jaar, aanvraag, max(uren) AS h FROM v GROUP BY ALL) GROUP BY ALL
          UNION ALL SELECT NULL, NULL, 2, sum(h) FROM (SELECT aanvraag, max(uren) AS h FROM v GROUP BY ALL)),
    k AS (SELECT Jaar, MaandNummer, level FROM y UNION SELECT Jaar, MaandNummer, level FROM s),
    j AS (SELECT year(Factuurdatum) AS Jaar, sum(Subtotaal) AS v FROM "FeitFacturen" GROUP BY 1),
    a AS (SELECT sum(Subtotaal) AS v FROM "FeitFacturen")
    SELECT k.Jaar, k.MaandNummer, CAST(k.level AS INTEGER) AS grouping_level, round(y.ytd, 4) AS ytd, round(s.leave, 4) AS leave,
           round(CASE WHEN k.level = 2 THEN a.v ELSE j.v END, 4) AS of_year, round(a.v, 4) AS of_all
    FROM a, k LEFT JOIN y ON y.level = k.level AND y.Jaar IS NOT DISTINCT FROM k.Jaar AND y.MaandNummer IS NOT DISTINCT FROM k.MaandNummer
    LEFT JOIN s ON s.level = k.level AND s.Jaar IS NOT DISTINCT FROM k.Jaar AND s.MaandNummer IS NOT DISTINCT FROM k.MaandNummer
    LEFT JOIN j ON j.Jaar = k.Jaar
    """,
)
def totals_of_every_metric(spark, sf_dir):
    metrics = {
        "ytd": t.running_ytd(BILLED), "leave": m.sum_of_max("FeitVerlofAanvragen.Verlofuren", "FeitVerlofAanvragen.DatumAangevraagd"),
        "of_year": m.keep_only(BILLED, "DimDatum", "DimDatum.Jaar"), "of_all": m.ignoring(BILLED, "DimDatum"),
    }
    return rounded(evaluate(shapes.operational(spark, sf_dir), metrics, by=["DimDatum.Jaar", "DimDatum.MaandNummer"], totals="rollup"))


@query(
    "constant_over_two_tables",
    """
    WITH b AS (SELECT DISTINCT Branche FROM "DimKlanten"), y AS (SELECT DISTINCT Jaar FROM "DimDatum" WHERE Jaar BETWEEN 1996 AND 1998),
    f AS (SELECT k.Branche, sum(f.Subtotaal) AS v FROM "FeitFacturen" f LEFT JOIN "DimProjecten" o ON o.ProjectKey = f.ProjectKey
          LEFT JOIN "DimKlanten" k ON k.KlantKey = o.KlantKey GROUP BY 1)
    SELECT b.Branche, y.Jaar, round(f.v, 4) AS of_segment, round((SELECT sum(v) FROM f), 4) AS of_all
    FROM b CROSS JOIN y LEFT JOIN f ON f.Branche IS NOT DISTINCT FROM b.Branche
    """,
)
def constant_over_two_tables(spark, sf_dir):
    metrics = {"of_segment": m.ignoring(BILLED, "DimDatum"), "of_all": m.ignoring(BILLED, "DimKlanten", "DimDatum")}
    by, where = ["DimKlanten.Branche", "DimDatum.Jaar"], [m.between("DimDatum.Jaar", 1996, 1998)]
    return rounded(evaluate(shapes.operational(spark, sf_dir), metrics, by=by, where=where))
