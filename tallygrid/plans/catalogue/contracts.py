"""Service contracts and cloud cost."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallygrid.functions import blank
from tallygrid.plans import metric as m
from tallygrid.plans import period as t
from tallygrid.plans.metric import Metric
from tallygrid.plans.period import Period

COST = "cost_view_exported"
COST_DAY = f"{COST}.date"
HOURS = "s4_inf billable_uren"
BILLED = "s4_inf gefactureerde_uren"
UNBILLED = "niet_factureerbare_uren"
TERMS = "contract_opbrengsten"
TERM_DAY = f"{TERMS}.Termijn Maand Datum"
DAYS = "dim_datum"


def _margin_percent(revenue, cost):
    return F.when(revenue.isNotNull() & (revenue != 0), F.try_divide(blank.sub(revenue, cost), revenue) * 100)


def _margin_if_both(revenue, cost):
    return F.when(revenue.isNotNull() & cost.isNotNull(), blank.safe_div(revenue - cost, revenue, 0))


def on_calendar(metric: Metric) -> Metric:
    """Only rows dated on a day that the date table shows, whether or not it is related to the fact."""
    return m.treat_as(metric, f"{DAYS}.Datum", COST_DAY, TERM_DAY, f"{UNBILLED}.Krow__Date__c", f"{HOURS}.Datum")


def total_cost() -> Metric:
    unbilled = m.sum_(f"{UNBILLED}.Sum of Cost Amount")
    return on_calendar(m.plus(m.plus(m.sum_(f"{COST}.costInBillingCurrency"), unbilled), m.sum_(f"{HOURS}.Kosten")))


def total_revenue() -> Metric:
    return on_calendar(m.plus(m.sum_(f"{TERMS}.Total Price"), m.sum_(f"{HOURS}.Opbrengsten")))


def until(metric: Metric, as_of: dt.date) -> Metric:
    """Replace the date filter by "up to and including today"."""
    return m.where(m.ignoring(metric, DAYS), m.compare(f"{DAYS}.Datum", "<=", as_of))


def cloud(p: Period) -> dict[str, Metric]:
    cost = m.sum_(f"{COST}.costInBillingCurrency")
    # these replace every filter on the cost table and its dimensions
    whole = (COST, "KlantDim", DAYS)
    yesterday, before = (t.on_day(cost, p.as_of - dt.timedelta(days=n), COST_DAY, *whole) for n in (1, 2))
    this_week = t.week_to_date(cost, p.as_of, COST_DAY, *whole)
    last_week = t.last_week(cost, p.as_of, COST_DAY, *whole)
    return {
        "AzureKosten": cost,
        "azure kosten": cost,
        "AzureKostenGisteren": yesterday,
        "AzureKostenEergisteren": before,
        "AzureKostenVerschil": m.minus(yesterday, before),
        "AzureKostenDezeWeek_RG": this_week,
        "Kosten_DezeWeek_RG": this_week,
        "AzureKostenVorigeWeek_RG": last_week,
        "AzureKosten_Progressie": m.ratio(this_week, last_week, 0),
        "AzureKostenVerschil_RG": m.minus(this_week, last_week),
        "AzureKostenVerschilProcent_RG": m.derived(blank.pct_change, this_week, last_week),
        "GemiddeldeAzureKostenPerDag": m.ratio(cost, m.distinct_days(COST_DAY), 0),
        "AzureKostenPerDebiteurnummer": m.keep_only(cost, "KlantDim", "KlantDim.Debiteurnummer"),
    }


def contracts(p: Period) -> dict[str, Metric]:
    hours, revenue, cost = (m.sum_(f"{HOURS}.{c}") for c in ("Billable Hours", "Opbrengsten", "Kosten"))
    unbilled = m.sum_(f"{UNBILLED}.Sum of Cost Amount")
    terms = m.sum_(f"{TERMS}.Total Price")
    income, spending = total_revenue(), total_cost()
    per_customer = [
        m.keep_only(x, "KlantDim", "KlantDim.Debiteurnummer")
        for x in (income, spending, m.sum_(f"{COST}.costInBillingCurrency"))
    ]
    return {
        **cloud(p),
        "Contractwaarde": m.sum_(f"{TERMS}.Salesprice"),
        # compares real term dates; comparing month texts would sort alphabetically
        "ContractTotNu": m.where(m.ignoring(terms, DAYS), m.compare(TERM_DAY, "<=", p.as_of)),
        "percontractgefactureerd": t.due_to_date(terms, p.as_of, TERM_DAY),
        "aantal factureerbare uren": hours,
        "som factureerbare uren": hours,
        "kosten factureerbare uren": cost,
        "opbrengsten factureerbare uren": revenue,
        "kosten niet factureerbaar": unbilled,
        "totale kosten uren": m.plus(cost, unbilled),
        "kosten gefactureerd": m.sum_(f"{BILLED}.Kosten"),
        "tot nu toe gefactureerd": m.sum_(f"{BILLED}.Opbrengsten"),
        "Marge Factureerbare Uren %": m.derived(lambda r, c: blank.safe_div(blank.sub(r, c), r, 0) * 100, revenue, cost),
        "Marge % Uren Incl NietFact": m.derived(_margin_percent, revenue, m.plus(cost, unbilled)),
        "TotaleKosten": spending,
        "TotaleOpbrengst": income,
        "winst": m.minus(income, spending),
        "marge over totaal": m.derived(_margin_if_both, income, spending),
        "TotaleKosten t/m vandaag": until(spending, p.as_of),
        "TotaleOpbrengst t/m vandaag": until(income, p.as_of),
        "Marge % per debiteurnummer": m.derived(
            _margin_percent, per_customer[0], m.plus(per_customer[1], per_customer[2])
        ),
    }


def profit_per_contract(contract: str) -> tuple[dict[str, Metric], list[m.Pred]]:
    """``WinstPerContract`` and the filter for one chosen contract.

    The contract narrows the customers (filters flow both ways there), and those customers narrow every cost table.
    """
    metric = m.minus(m.sum_(f"{TERMS}.Total Price"), total_cost())
    return {"WinstPerContract": metric}, [m.eq(f"{TERMS}.Contact Name", contract)]
