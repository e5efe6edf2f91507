"""Hours, revenue, projects, people, planning and budget.

Notes on definitions that read differently from what their name suggests:

* ``Geschreven ProjectUren Laatste 12 maanden`` wraps a bare sum, on which the
  period menu has no effect: it is the plain metric. Pass it to
  ``period.last_12m`` for the limited one.
* ``GeplandeProjectUren`` and ``Aantal klanten met facturatie`` carry a filter
  on a fact from which no relationship leads to the counted table, so that
  filter changes nothing and is left out.
* ``Aantal Projecten met Taakregels`` turns on a relationship whose filters run
  from project to task, so it equals the number of active projects.
"""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Collection

from tallygrid.plans import metric as m
from tallygrid.plans import period as t
from tallygrid.plans.period import Period

# --- fixed values: task and label texts that metrics test for -------------------
SICK = "Ziekte / Kort Verzuim"
NOT_WORKED = [
    "Ziekte / Kort Verzuim", "Verlof", "Studie", "Parttime", "Feestdag", "Verlof (regulier)",
    "Ziekteverzuim", "Niet gewerkt (Parttime)", "Feestdagen",
]
NOT_WORKED_OLD = ["Ziekte / Kort Verzuim", "Verlof", "Studie", "Feestdag", "Verlof (regulier)"]
INDIRECT = [
    "Interne Werkzaamheden", "Ziekte / Kort Verzuim", "Acquisitie/representatie", "Verlof", "Studie",
    "Feestdag", "Marketing/PR", "Productontwikkeling", "Studie/opleiding (Intern)",
]
CUSTOMER_TYPES = ["Customer", "Customer - Indirect"]
OCCUPANCY_NORM = 0.8
SATISFACTION_GOAL = 8.5
FTE_GROWTH = 5
FULL_WEEK = 40
NOT_A_CERTIFICATE = 9
# --------------------------------------------------------------------------------

DAY = "DimDatum.Datum"
Metrics = dict[str, m.Metric]


def month_end(day: dt.date, months: int = 0) -> dt.date:
    first = t.to_month(day, months)
    return first.replace(day=calendar.monthrange(first.year, first.month)[1])


def in_year(metric: m.Metric, year: int) -> m.Metric:
    return m.where(metric, m.between(DAY, dt.date(year, 1, 1), dt.date(year, 12, 31)))


def hired(metric: m.Metric) -> m.Metric:
    return m.via(metric, "DimMedewerkers.DatumInDienst", DAY)


def left(metric: m.Metric) -> m.Metric:
    return m.via(metric, "DimMedewerkers.DatumUitDienst", DAY)


def by_project_practice(metric: m.Metric) -> m.Metric:
    return m.via(metric, "DimProjecten.PracticeKey", "DimPractice.PracticeKey")


def people(p: Period) -> Metrics:
    gone, started = "DimMedewerkers.DatumUitDienst", "DimMedewerkers.DatumInDienst"
    ident = m.count_("DimMedewerkers.MedewerkerId")
    hires = hired(m.count_("DimMedewerkers.MedewerkerCode", m.is_blank(gone)))
    leavers = left(m.count_(gone))
    last = p.as_of.year - 1
    fte = m.sum_("FeitFormatieBezetting.FTE")
    skills = m.count_("FeitMedewerkerSkills.MedewerkerSkillKey")
    this_year = m.any_of(m.year_is(started, p.as_of.year), m.year_is(gone, p.as_of.year))
    return {
        "Aantal Actieve Medewerkers": m.count_("DimMedewerkers.Medewerker", m.not_blank(started), m.is_blank(gone)),
        "Aantal FTE": fte,
        "Aantal Medewerkers": m.count_("DimMedewerkers.Medewerker"),
        "Aantal medewerkers in dienst dit jaar": hires,
        "Aantal Medewerkers In dienst vorig jaar": in_year(hires, last),
        "Aantal Medewerkers In dienst vorig jaar (variant 2)": in_year(hired(ident), last),
        "Aantal Medewerkers In Dienst": hired(ident),
        "Aantal medewerkers uit dienst dit jaar": leavers,
        "Aantal medewerkers uit dienst dit jaar (variant 2)": left(ident),
        "Aantal Medewerkers Uit Dienst Vorig Jaar": in_year(leavers, last),
        "Aantal Medewerkers Uit Dienst Vorig Jaar (variant 2)": in_year(left(ident), last),
        "Nieuwe Medewerkers": m.count_("DimMedewerkers.MedewerkerId", m.is_blank(gone)),
        "DatumInDienst/DatumUitDienst dit jaar": m.rows("DimMedewerkers", this_year),
        "Average FTE": m.avg_("FeitFormatieBezetting.FTE"),
        "AVG FTE": m.ratio(m.avg_("FeitRoosterUren.Aantal_uren_per_week"), m.constant(FULL_WEEK)),
        "AVG FTE (variant 2)": m.ratio(m.avg_("DimMedewerkers.AantalUren"), m.constant(FULL_WEEK)),
        "Doel FTE": m.plus(fte, m.constant(FTE_GROWTH)),
        "Aantal skills": skills,
        "Aantal certificaten": m.where(skills, m.ne("FeitMedewerkerSkills.SkillKey", NOT_A_CERTIFICATE)),
        "Gemiddeld uurtarief medeweker": m.avg_("DimMedewerkers.Uurtarief"),
        "Tarief": m.product(m.sum_("DimMedewerkers.Uurtarief"), m.sum_("DimMedewerkers.AantalUren")),
        "Aantal Uren (variant 2)": m.sum_("DimMedewerkers.AantalUren"),
    }


def hours(p: Period) -> Metrics:
    amount = "FeitGeschrevenUren.AantalUren"
    project, task = "FeitGeschrevenUren.ProjectKey", "DimTaakregels.TaakNaam"
    leave, day = "FeitGeschrevenUren.Verloftype", "FeitGeschrevenUren.Datum"
    billable = m.eq("FeitGeschrevenUren.IsFacturabel", True)
    project_billable = m.eq("DimProjecten.IsFacturabel", True)
    intern = m.eq("DimProjecten.InternExtern", "Intern")
    written = m.sum_(amount)
    worked = m.where(written, m.not_blank("FeitGeschrevenUren.TaakregelKey"), m.not_in(task, NOT_WORKED))
    worked_old = m.where(written, m.not_blank("FeitGeschrevenUren.TaakregelKey"), m.not_in(task, NOT_WORKED_OLD))
    project_hours = m.where(written, m.not_blank(project), billable)
    sick_old = m.where(written, m.not_blank(project), m.eq(task, SICK))
    sick = m.where(sick_old, m.eq("FeitGeschrevenUren.GoedkeuringsStatus", "Approved"))
    occupancy = m.ratio(project_hours, written)
    last_written = t.last_12m(written, p)
    rate = m.avg_("DimMedewerkers.Uurtarief")
    on_projects = m.where(worked, m.not_blank(project))
    invoiced = m.sum_("FeitFactuurregels.UrenGefactureerd")
    billable_old = m.sum_("FeitGeschrevenUren.FacturabeleUren")
    indirect = m.where(written, m.is_in(task, INDIRECT))
    return {
        "Aantal geschreven Uren": written,
        "Aantal uren (dec)": written,
        "Commerciële waarden uren": m.sum_expr(amount, "DimMedewerkers.Uurtarief"),
        "GefactureerdeUren": invoiced,
        "Declarabiliteit": m.ratio(invoiced, written),
        "Declarabiliteit (variant 2)": m.ratio(billable_old, written),
        "Bezettingsgraad": occupancy,
        "Bezettingsgraad Laatste 12 maanden": t.last_12m(occupancy, p),
        "Bezettingsgraad YTD": t.year_to_date(occupancy, p.as_of),
        "Bezettingsgraad Norm": m.constant(OCCUPANCY_NORM),
        "Aantal Geplande Verlofuren": m.where(written, m.eq(leave, "Regulier verlof"), m.compare(day, ">=", p.as_of)),
        "Aantal Opgenomen Verlofuren": m.where(written, m.eq(leave, "Regulier verlof"), m.compare(day, "<=", p.as_of)),
        # the first month of this window is ten months back: eleven months in all
        "Aantal Geschreven Projecturen Laatste 12 Maanden": t.in_dates(
            m.where(written, m.not_zero(project), billable), t.to_month(p.as_of, -10), month_end(p.as_of)
        ),
        "Aantal Geschreven Projecturen Vorig Jaar": t.last_year(m.where(project_hours, m.is_blank(leave))),
        "Aantal Geschreven Ziekteuren": sick,
        "Aantal Geschreven Ziekteuren (variant 2)": sick_old,
        "Ziekteverzuim": m.ratio(sick, written),
        "Externe Uren": m.where(written, m.eq("DimProjecten.InternExtern", "Extern")),
        "Geschreven uren (gecompenseerd)": worked,
        "Geschreven uren (gecompenseerd) (variant 2)": worked_old,
        "Geschreven uren (gecompenseerd) LY": t.last_year(worked),
        "Facturabele Uren": m.where(worked, project_billable),
        "Facturabele Uren (variant 2)": m.where(worked_old, project_billable),
        "Facturabele Uren (variant 3)": billable_old,
        "Niet Facturabele Uren": m.sum_("FeitGeschrevenUren.NietFacturabeleUren"),
        "Factureerbare uren geschreven": m.where(written, project_billable),
        "Productiviteitspercentage": m.ratio(m.where(worked, project_billable), worked),
        "Indirecte uren": indirect,
        "UrenIndirect %": m.ratio(indirect, worked),
        "Interne uren": m.where(worked, intern),
        "Interne uren (variant 2)": m.where(written, intern),
        "Interne uren laatste 12 maanden": m.where(last_written, intern),
        "Geschreven ProjectUren Laatste 12 maanden": project_hours,
        "Geschreven Uren Laatste 12 maanden": last_written,
        "Geschreven Uren Voorgaande 12 maanden": t.previous_12m(written, p),
        "Geschreven projecturen": on_projects,
        "Projectomzet medewerker": m.product(on_projects, rate),
    }


def revenue(p: Period) -> Metrics:
    net = m.sum_("FeitFactuurregels.BedragExclBTW")
    net_last_year = t.last_year(net)
    billed = m.sum_("FeitFacturen.Subtotaal")
    cost = m.sum_("FeitGeschrevenUren.KostprijsTarief")
    line_cost = m.sum_("FeitFactuurregels.KostenBedrag")
    margin = m.minus(billed, cost)
    margin_share = m.ratio(margin, billed)
    line_margin = m.minus(net, line_cost)
    external = m.eq("DimMedewerkers.IsExterneMedewerker", 1)
    internal = m.eq("DimMedewerkers.IsExterneMedewerker", 0)  # an empty flag counts as 0
    potential = m.sum_("FeitGeschrevenUren.OmzetPotentie")
    billable_potential = m.where(potential, m.eq("DimProjecten.IsFacturabel", True))
    billed_practice = by_project_practice(billed)
    paid_hours = m.sum_expr("FeitGeschrevenUren.AantalUren", "DimMedewerkers.Uurtarief")
    rates = m.sum_("DimMedewerkers.Uurtarief")
    return {
        "Omzet ex. BTW (variant 2)": net,
        "Omzet ex. BTW (klant)": net,
        "Omzet incl BTW (klant)": m.sum_("FeitFactuurregels.BedragInclBTW"),
        "Omzet ex. BTW Vorig Jaar": net_last_year,
        "Omzet  Laatste 12 maanden": t.last_12m(net, p),
        "Omzet Voorgaande 12 maanden": t.previous_12m(net_last_year, p),
        "Omzet o.b.v DatumAfgerond": m.via(net, "DimProjecten.DatumAfgerond", DAY),
        "Factuuromzet": billed,
        "Factuurkosten": cost,
        "Factuurkosten (variant 2)": line_cost,
        "Kosten Vorig Jaar": t.last_year(line_cost),
        "KostenExtern": m.where(cost, external),
        "KostenIntern": m.where(cost, internal),
        "MedewerkerOmzet": m.where(net, internal),
        "ExterneMedewerkerOmzet": m.where(net, external),
        "ExterneMedewerkerOmzet Vorig Jaar": m.where(net_last_year, external),
        "Percentage interne/externe kosten": m.ratio(m.where(cost, external), cost),
        "Percentage interne/externe omzet": m.ratio(m.where(net, external), net),
        "Brutomarge": margin,
        "Brutomarge (variant 2)": line_margin,
        "Brutomarge %": margin_share,
        "Brutomarge % (variant 2)": m.ratio(line_margin, net),
        "Brutomarge  Laatste 12 maanden": t.last_12m(margin, p),
        "Brutomarge % Laatste 12 maanden": t.last_12m(margin_share, p),
        "Brutomarge Vorig Jaar": t.last_year(margin_share),
        "Brutomarge % Vorige Maand": t.month_before(margin_share, p.end or p.as_of),
        "Gemiddeld Uurtarief": m.avg_("FeitFactuurregels.UurTarief"),
        "OmzetPotentie": billable_potential,
        "OmzetPotentie (variant 2)": potential,
        "Facturatie": billed_practice,
        "Verschil facturatie en uren": m.minus(billed_practice, billable_potential),
        "% Facturabel": m.ratio(billed_practice, billable_potential),
        "Realisatiegraad": m.ratio(billed, billable_potential),
        "TotaalPerPractice": by_project_practice(potential),
        "%Verhouding uren": m.ratio(net, paid_hours),
        "Verhouding Omzet t.o.v. Commerciële uren": m.ratio(
            net, m.product(rates, m.sum_("FeitGeschrevenUren.AantalUren"))
        ),
        "Verhouding Omzet t.o.v. Commerciële uren (variant 2)": m.ratio(
            net, m.product(rates, m.sum_("FeitRoosterUren.Aantal_uren_per_week"))
        ),
        "Verhouding Omzet t.o.v. Commerciële uren (variant 3)": m.ratio(
            net, m.product(rates, m.sum_("DimMedewerkers.AantalUren"))
        ),
        "Cumulatieve Factuuromzet": t.running_ytd(billed, p.end or p.as_of),
        "FixedFee": m.sum_("FixedFee.Krow__Amount__c"),
    }


def potential_per_practice(by: Collection[str]) -> m.Metric:
    """Potential revenue whose project belongs to a visible practice.

    Grouped by practice, the project's practice must be the one of the group;
    otherwise any existing practice will do.
    """
    base = m.where(m.sum_("FeitGeschrevenUren.OmzetPotentie"), m.eq("DimProjecten.IsFacturabel", True))
    own = "DimProjecten.PracticeKey"
    if any(ref.startswith("DimPractice.") for ref in by):
        refs = (own, "FeitGeschrevenUren.PracticeKey")
        return m.where(base, m.Pred(refs, f"{refs[0]} = {refs[1]}", lambda a, b: a == b))
    return m.where(base, m.not_blank(own))


def projects(p: Period) -> Metrics:
    ident = "DimProjecten.ProjectId"
    count = m.count_(ident)

    def started(status: str) -> m.Metric:
        chosen = m.where(count, m.eq("DimProjecten.ProjectStatus", status))
        return by_project_practice(m.via(chosen, "DimProjecten.Startdatum", DAY))

    estimate = m.sum_("DimProjecten.GeschatteUren")
    spent = m.sum_("DimProjecten.AantalUren")
    expected, realised = m.sum_("DimProjecten.VerwachteOmzet"), m.sum_("DimProjecten.FacturabeleOmzet")
    done = m.distinct_(ident, m.eq("DimProjecten.ProjectStatus", "Complete"))
    task_role = ("DimTaakregels.ProjectKey", "DimProjecten.ProjectKey")
    open_hours = m.sum_("DimProjecten.GeschatteUrenOverlogd")
    in_time = m.where(count, m.eq("DimProjecten.OpTijdAfgerond", 1))
    return {
        "Aantal Projecten": count,
        "Aantal Actieve Projecten": started("In Progress"),
        "Aantal toekomstige Projecten": started("Not Started"),
        "Afgeronde Projecten": m.via(done, "DimProjecten.DatumAfgerond", DAY),
        "Aantal Projecten met Taakregels": m.via(started("In Progress"), *task_role),
        "Aantal Taakregels met Project": m.via(m.rows("DimTaakregels"), *task_role),
        "Totaalgeschreven Taakuren": m.via(m.sum_("DimTaakregels.TotaalGeschrevenUren"), *task_role),
        "Aantal Projecten met uren": m.distinct_("FeitGeschrevenUren.ProjectKey"),
        "Projecten op tijd": in_time,
        "OpTijdProjecten": in_time,
        "Gerealiseerde ProjectOmzet": realised,
        "Verwachte Omzet": expected,
        "Omzet vs verwachte omzet": m.minus(expected, realised),
        "Geschatte Uren": estimate,
        "Geschatte Uren Komende 12 maanden": m.via(t.next_12m(estimate, p), "DimProjecten.Startdatum", DAY),
        "GeschrevenProjectUren": spent,
        "Overschrijdingspercentage": m.ratio(m.minus(spent, estimate), estimate, 0),
        "Openstaande uren": open_hours,
        "GeschatteUrenOverlogd": open_hours,
        "aantal klanten per practice": by_project_practice(m.distinct_("DimProjecten.KlantKey")),
        "Aantal klanten met facturatie": m.distinct_(
            "DimKlanten.KlantID", m.is_in("DimKlanten.KlantType", CUSTOMER_TYPES)
        ),
        "Gemiddelde NPS-score": m.avg_("DimProjecten.Tevredenheidsscore"),
        "Klanttevredenheid": m.sum_("DimProjecten.Tevredenheidsscore"),
        "Gem. Klanttevredenheid": m.avg_("FeitTevredenheid.Score"),
        "Aantal surveys": m.count_("FeitTevredenheid.Score"),
        "CTAS doel": m.constant(SATISFACTION_GOAL),
    }


def planning(p: Period, by: Collection[str] = ()) -> Metrics:
    planned, planned_old = m.sum_("FeitGeplandeUren.GeplandeUren"), m.sum_("FeitGeplandeUren.UrenTotaal")
    leave = m.sum_("FeitVerlofAanvragen.Aantal_uren")
    leave_old = m.sum_("FeitVerlofAanvragen.Verlofuren")
    roster = m.sum_("FeitRoosterUren.Aantal_uren_per_week")
    available = m.minus(m.sum_("FeitRoosterUren.UrenPerDag"), leave)
    in_selection = m.product(roster, m.distinct_("DimDatum.WeekNummer"))
    booked_leave = m.where(
        m.sum_("FeitGeschrevenUren.AantalUren"), m.eq("FeitGeschrevenUren.Verloftype", "Regulier verlof"),
        m.compare("FeitGeschrevenUren.Datum", ">=", p.as_of),
    )
    free = m.minus(in_selection, booked_leave)
    load = m.ratio(planned, available, 0)

    def selected(column: str, current: int) -> m.Metric:
        """Each group's own value when grouped by the column, else the current one."""
        return load if column in by else m.where(load, m.eq(column, current))

    week = selected("DimDatum.JaarWeek", p.as_of.year * 100 + p.as_of.isocalendar().week)
    month = selected("DimDatum.JaarMaand", p.as_of.year * 100 + p.as_of.month)
    future_leave = m.where(
        m.via(
            m.sum_of_max("FeitVerlofAanvragen.Verlofuren", "FeitVerlofAanvragen.DatumAangevraagd"),
            "FeitVerlofAanvragen.DatumVerlof", DAY,
        ),
        m.between(DAY, p.as_of + dt.timedelta(days=1), month_end(p.as_of, 12)),
    )
    return {
        "Aantal Verlof Dagen Komende 12 Maanden": m.distinct_("FeitVerlofAanvragen.FeitVerlofAanvraagKey"),
        "Verlofuren": leave,
        "Verlofuren (variant 2)": leave_old,
        "Aantal Verlofuren": leave_old,
        "Reguliere Verlofuren": m.where(leave_old, m.eq("FeitVerlofAanvragen.VerlofType", "Regulier Verlof")),
        "Toekomstige Verlofuren Komende 12 Maanden": future_leave,
        "Toekomstige Verlofuren Komende 12 Maanden2": future_leave,
        "Verlofsaldo": m.sum_("FeitVerlofSaldo.TotaalEindSaldo"),
        "AantalBeschikbareUren": available,
        "AantalBeschikbareUren (variant 2)": m.ignoring(roster, "DimDatum", "DimDatumFilter"),
        "AantalBeschikbareUren (variant 3)": roster,
        "Aantal Uren": roster,
        "AantalBeschikbareUrenMaand": roster,
        "AantalBeschikbareUrenGeselecteerdePeriode": in_selection,
        "AantalBeschikbareUrenGeselecteerdePeriode (variant 2)": in_selection,
        "BezettingsgraadBeschikbareUren": free,
        "Beschikbaarheid": m.minus(available, leave),
        "GeplandeUren": planned,
        "GeplandeUren (variant 2)": planned_old,
        "GeplandeProjectUren": planned_old,
        "Geplande Uren komende 12 maanden": t.next_12m(planned, p),
        "VerwachteBezettingsgraad": week,
        "VerwachteBezettingsgraad (variant 2)": m.ratio(planned, free, 0),
        "VerwachteBezettingsgraadKomende12Mnd": t.next_12m(week, p),
        "VerwachteBezettingsgraadweek": m.ratio(planned, in_selection, 0),
        "VerwachteBezettingsgraadMaand": month,
        "VerwachteBezettingsgraadNieuw": m.ignoring(load, "DimDatum"),
        "VerwachteBezettingsgraadNieuw (variant 2)": load,
        "VerwachteBezettingsgraadCorrect": m.over_selection(load, "FeitGeplandeUren.Status"),
        "NieuweBezet": t.in_dates(load, p.as_of, month_end(p.as_of, 2)),
    }


def days_ratio(p: Period) -> m.Metric:
    """Days of the year so far as a share of all its days in the date table."""
    days = m.rows("DimDatum")
    year = p.current_year
    whole = t.in_dates(days, dt.date(year, 1, 1), dt.date(year, 12, 31))
    return m.ratio(t.ytd(days, p), whole)


def budget(p: Period) -> Metrics:
    net = m.sum_("FeitFactuurregels.BedragExclBTW")
    goal = m.sum_("FeitBudgetten.FTE_x_MonthGoal")
    per_day, intern = m.sum_("FeitBudgetten.InternPerDag_FTE"), m.sum_("FeitBudgetten.Intern")
    ytd_net, days = t.ytd(net, p), days_ratio(p)
    ytd_budget = m.product(days, per_day)
    return {
        "YTDDaysRatio": days,
        "YTD Omzet ex. BTW": ytd_net,
        "Totaal Budget (intern)": per_day,
        "Totaal Budget": per_day,
        "Totaal Budget (variant 2)": intern,
        "Totaal Budget copy": intern,
        "YTD Budget": ytd_budget,
        "YTD percentage": m.ratio(ytd_net, ytd_budget),
        "Percentage Jaarbudget": m.ratio(ytd_net, per_day),
        "Percentage Jaarbudget (variant 2)": m.ratio(ytd_net, per_day),
        "OmzetVSBudget (intern)": m.minus(net, per_day),
        "OmzetVSBudget": m.minus(net, per_day),
        "OmzetVSBudget (variant 2)": m.minus(ytd_net, ytd_budget),
        "YTD Jaardoel per medewerker": goal,
        "YTD Jaardoel per medewerker (variant 2)": m.sum_("FeitBudgetten.JaardoelPerDag_FTE"),
        "OmzetVSBudget (jaardoel)": m.minus(net, goal),
        "Voortgang doel": m.ratio(net, goal),
        "Cumulatief Budget": t.running_ytd(goal, p.end or p.as_of),
        "BudgetFTE": m.sum_("FeitBudgetten.FTE"),
    }


def operational(p: Period, by: Collection[str] = ()) -> Metrics:
    """All metrics of the operational model; ``by`` is the grouping they will be shown in."""
    return {
        **people(p), **hours(p), **revenue(p), **projects(p), **planning(p, by), **budget(p),
        "OmzetPotentiePerPractice": potential_per_practice(by),
    }


def revenue_options(p: Period) -> dict[str, Metrics]:
    """Monthly or cumulative reading of the metrics that offer both."""
    monthly = {**revenue(p), **budget(p)}
    return {
        "Cumulatief": {
            "Factuuromzet": monthly["Cumulatieve Factuuromzet"],
            "YTD Jaardoel per medewerker": monthly["Cumulatief Budget"],
        },
        "Maandelijks": {n: monthly[n] for n in ("Factuuromzet", "YTD Jaardoel per medewerker")},
    }
