"""The older operational model: timesheets, planning, tasks, invoices, budget in days."""

from __future__ import annotations

from tallygrid.plans import metric as m
from tallygrid.plans import period as t
from tallygrid.plans.metric import Metric
from tallygrid.plans.period import Period

HOURS_PER_DAY = 8  # fixed value


def days(metric: Metric) -> Metric:
    return m.ratio(metric, m.constant(HOURS_PER_DAY))


def operational_old(p: Period) -> dict[str, Metric]:
    sheet, project, task = "Timesheet Split", "Klient Project", "Klient Task"
    booked = m.sum_(f"{sheet}.Krow__Hours__c")
    billable = m.where(booked, m.eq(f"{sheet}.Krow__Billable__c", True))
    invoiced = m.where(booked, m.eq(f"{sheet}.Krow__Invoiced__c", True))
    open_ = m.where(booked, m.eq(f"{sheet}.Krow__Invoiced__c", False))
    worth = m.sum_(f"{sheet}.Krow__Bill_Amount__c")
    planned = m.sum_("Project Assignment Schedule.Krow__Total_Week_Project_Schedule_Hours__c")
    planned_billable = m.where(planned, m.eq(f"{project}.Krow__Billable__c", True))
    estimate, task_billable = m.sum_(f"{task}.Krow__Estimated_Hours__c"), m.sum_(f"{task}.Krow__Billable_Hours__c")
    billable_amount = m.sum_(f"{project}.Krow__Billable_Amount_Logged__c")
    invoiced_amount = m.sum_(f"{project}.Krow__Invoiced_Amount__c")
    budget = m.sum_("DoelstellingMedewerker.Begroting")
    actual, forecast = days(billable), days(planned_billable)
    blended = t.actual_plus_forecast(actual, forecast, p.as_of, "DimDatum.WeekNr")
    until = p.end or p.as_of
    actual_ytd, budget_ytd = t.year_to_date(actual, until), t.year_to_date(budget, until)
    return {
        "Geboekte uren": booked,
        "Geboekte uren (facturabel)": billable,
        "Aantal dagen": days(booked),
        "Aantal dagen declarabel": actual,
        "Indirect": m.minus(booked, billable),
        "Waarde geboekte uren": worth,
        "Factuurwaarde uren": worth,
        "Uren gefactureerd": invoiced,
        "Uren niet gefactureerd": open_,
        "% uren gefactureerd": m.ratio(invoiced, booked),
        "% Uren niet gefactureerd": m.ratio(open_, booked),
        "Geplande uren per week": planned,
        "Geplande dagen per week": days(planned),
        "Geplande uren per week (decl)": planned_billable,
        "Geplande dagen per week (decl)": forecast,
        "Geschatte Uren (variant 2)": estimate,
        "Geboekte uren declarabel": task_billable,
        "Urenschatting vs realisatie": m.minus(estimate, task_billable),
        "Geboekte uren per taak": m.sum_(f"{task}.Krow__Total_Hours_Logged__c"),
        "Totaal geboekte uren declarabel": m.sum_(f"{project}.Krow__Billable_Hour_Logged__c"),
        "Totaal geboekte uren": m.sum_(f"{project}.Krow__Total_Hours_Logged__c"),
        "Totaal gefactureerd bedrag": invoiced_amount,
        "Totaal geplande uren": m.sum_(f"{project}.Krow__Scheduled_Hours__c"),
        "Projectruimte (uren)": m.sum_(f"{project}.Krow__Hours_Remaining_Logged__c"),
        "Totaal facturabel bedrag": billable_amount,
        "Nog te factureren": m.minus(billable_amount, invoiced_amount),
        "Factuurbedrag Invoices": m.sum_("Invoice.Krow__Invoice_Subtotal__c"),
        "Begroting": budget,
        "Actual": actual,
        "Forecast": forecast,
        "New Forecast": blended,
        "Begroting YTD": budget_ytd,
        "Actual YTD": actual_ytd,
        "Forecast YTD": t.year_to_date(blended, until),
        "Actual - Begroting (YTD)": m.minus(actual_ytd, budget_ytd),
    }
