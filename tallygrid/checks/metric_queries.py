"""Catalogue metrics over the business tables, by team, practice, customer and period."""

from __future__ import annotations

from tallygrid.checks import shapes
from tallygrid.checks.registry import n, query, r, show
from tallygrid.checks.shapes import AS_OF, COST_AS_OF
from tallygrid.plans import catalogue
from tallygrid.plans.catalogue import operations as ops
from tallygrid.plans.catalogue.contracts import profit_per_contract
from tallygrid.plans.catalogue.older import operational_old
from tallygrid.plans.period import Period

NOW = Period(AS_OF)
COST_NOW = Period(COST_AS_OF)


def _metrics(name: str, sql: str, model, parts, names: list[str], **options) -> None:
    """Register one evaluation; ``names`` also tells tests what is covered."""

    def build(spark, sf_dir):
        shown = show(model(spark, sf_dir), parts(), names, **options)
        return shown.toDF(*[c.replace(".", "_") for c in shown.columns])

    build.metrics = names
    query(name, sql)(build)


def _cols(kind, pairs: dict[str, str]) -> str:
    return ",\n".join(kind(expression, metric) for metric, expression in pairs.items())


def _join(keys: list[str], parts: list[str]) -> str:
    """Full outer join of aggregated parts on their keys, empty keys included."""
    sql = parts[0]
    for part in parts[1:]:
        on = " AND ".join(f"({parts[0]}.{k} IS NOT DISTINCT FROM {part}.{k})" for k in keys)
        sql += f" FULL JOIN {part} ON {on}"
    return sql


# --- people --------------------------------------------------------------------
_GONE, _HERE = "e.DatumUitDienst IS NOT NULL", "e.DatumUitDienst IS NULL"
_metrics(
    "people_by_team",
    f"""
    WITH e AS (SELECT e.*, t.Team FROM "DimMedewerkers" e LEFT JOIN "DimTeam" t ON t.TeamKey = e.TeamKey),
    p AS (SELECT Team, {_cols(n, {
        "Aantal Actieve Medewerkers": f"count(e.Medewerker) FILTER (WHERE e.DatumInDienst IS NOT NULL AND {_HERE})",
        "Aantal Medewerkers": "count(e.Medewerker)",
        "Nieuwe Medewerkers": f"count(e.MedewerkerId) FILTER (WHERE {_HERE})",
        "DatumInDienst/DatumUitDienst dit jaar": "count(*) FILTER (WHERE year(e.DatumInDienst) = 1998 OR year(e.DatumUitDienst) = 1998)",
        "Aantal medewerkers uit dienst dit jaar": "count(e.DatumUitDienst)",
        "Aantal Medewerkers In Dienst": "count(e.MedewerkerId)",
    })}, {_cols(r, {
        "AVG FTE (variant 2)": "avg(e.AantalUren) / 40",
        "Gemiddeld uurtarief medeweker": "avg(e.Uurtarief)",
        "Tarief": "sum(e.Uurtarief) * sum(e.AantalUren)",
        "Aantal Uren (variant 2)": "sum(e.AantalUren)",
    })} FROM e GROUP BY Team),
    s AS (SELECT e.Team, {_cols(n, {
        "Aantal skills": "count(s.MedewerkerSkillKey)",
        "Aantal certificaten": "count(s.MedewerkerSkillKey) FILTER (WHERE s.SkillKey IS DISTINCT FROM 9)",
    })} FROM "FeitMedewerkerSkills" s LEFT JOIN e ON e.MedewerkerKey = s.MedewerkerKey GROUP BY 1)
    SELECT coalesce(p.Team, s.Team) AS Team, p.* EXCLUDE (Team), s.* EXCLUDE (Team) FROM {_join(["Team"], ["p", "s"])}
    """,
    shapes.operational, lambda: ops.people(NOW),
    [
        "Aantal Actieve Medewerkers", "Aantal Medewerkers", "Nieuwe Medewerkers",
        "DatumInDienst/DatumUitDienst dit jaar", "Aantal medewerkers uit dienst dit jaar",
        "Aantal Medewerkers In Dienst", "AVG FTE (variant 2)", "Gemiddeld uurtarief medeweker", "Tarief",
        "Aantal Uren (variant 2)", "Aantal skills", "Aantal certificaten",
    ],
    by=["DimTeam.Team"],
)

_metrics(
    "staffing_totals",
    f"""
    SELECT {_cols(r, {"Aantal FTE": "sum(FTE)", "Average FTE": "avg(FTE)", "Doel FTE": "sum(FTE) + 5"})},
           (SELECT round(avg(Aantal_uren_per_week) / 40, 4) FROM "FeitRoosterUren") AS "AVG_FTE"
    FROM "FeitFormatieBezetting"
    """,
    shapes.operational, lambda: ops.people(NOW), ["Aantal FTE", "Average FTE", "Doel FTE", "AVG FTE"],
)

_metrics(
    "hires_and_leavers_by_year",
    f"""
    WITH h AS (SELECT d.Jaar, {_cols(n, {
        "Aantal medewerkers in dienst dit jaar": "count(MedewerkerCode) FILTER (WHERE DatumUitDienst IS NULL)",
        "Aantal Medewerkers In dienst vorig jaar": "count(MedewerkerCode) FILTER (WHERE DatumUitDienst IS NULL AND year(DatumInDienst) = 1997)",
        "Aantal Medewerkers In dienst vorig jaar (variant 2)": "count(MedewerkerId) FILTER (WHERE year(DatumInDienst) = 1997)",
        "Aantal Medewerkers In Dienst": "count(MedewerkerId)",
    })} FROM "DimMedewerkers" LEFT JOIN "DimDatum" d ON d.Datum = DatumInDienst GROUP BY 1),
    l AS (SELECT d.Jaar, {_cols(n, {
        "Aantal medewerkers uit dienst dit jaar": "count(DatumUitDienst)",
        "Aantal medewerkers uit dienst dit jaar (variant 2)": "count(MedewerkerId)",
        "Aantal Medewerkers Uit Dienst Vorig Jaar": "count(DatumUitDienst) FILTER (WHERE year(DatumUitDienst) = 1997)",
        "Aantal Medewerkers Uit Dienst Vorig Jaar (variant 2)": "count(MedewerkerId) FILTER (WHERE year(DatumUitDienst) = 1997)",
    })} FROM "DimMedewerkers" LEFT JOIN "DimDatum" d ON d.Datum = DatumUitDienst GROUP BY 1)
    SELECT coalesce(h.Jaar, l.Jaar) AS Jaar, h.* EXCLUDE (Jaar), l.* EXCLUDE (Jaar) FROM {_join(["Jaar"], ["h", "l"])}
    """,
    shapes.operational, lambda: ops.people(NOW),
    [
        "Aantal medewerkers in dienst dit jaar", "Aantal Medewerkers In dienst vorig jaar",
        "Aantal Medewerkers In dienst vorig jaar (variant 2)", "Aantal Medewerkers In Dienst",
        "Aantal medewerkers uit dienst dit jaar", "Aantal medewerkers uit dienst dit jaar (variant 2)",
        "Aantal Medewerkers Uit Dienst Vorig Jaar", "Aantal Medewerkers Uit Dienst Vorig Jaar (variant 2)",
    ],
    by=["DimDatum.Jaar"],
)

# --- hours ------------------------------------------------------------------------
_HOURS = """
    h AS (SELECT u.*, CAST(u.Datum AS DATE) AS dag, p.PracticeNaam, t.TaakNaam, o.IsFacturabel AS pf, o.InternExtern, e.Uurtarief
          FROM "FeitGeschrevenUren" u
          LEFT JOIN "DimPractice" p ON p.PracticeKey = u.PracticeKey
          LEFT JOIN "DimTaakregels" t ON t.TaakregelKey = u.TaakregelKey
          LEFT JOIN "DimProjecten" o ON o.ProjectKey = u.ProjectKey
          LEFT JOIN "DimMedewerkers" e ON e.MedewerkerKey = u.MedewerkerKey)
"""


def _quoted_list(values: list[str]) -> str:
    return ", ".join(f"lower('{v}')" for v in values)


_WORKED = f"TaakregelKey IS NOT NULL AND (TaakNaam IS NULL OR lower(TaakNaam) NOT IN ({_quoted_list(ops.NOT_WORKED)}))"
_WORKED_OLD = _WORKED.replace(_quoted_list(ops.NOT_WORKED), _quoted_list(ops.NOT_WORKED_OLD))
_PROJECT = "ProjectKey IS NOT NULL AND IsFacturabel"
_LAST = "dag BETWEEN DATE '1997-07-01' AND DATE '1998-06-30'"
_BEFORE = "dag BETWEEN DATE '1996-07-01' AND DATE '1997-06-30'"
_SICK = "ProjectKey IS NOT NULL AND lower(TaakNaam) = lower('Ziekte / Kort Verzuim')"


def _sum(where: str = "true", column: str = "AantalUren") -> str:
    return f"sum({column}) FILTER (WHERE {where})"


_HOUR_METRICS = {
    "Aantal geschreven Uren": "sum(AantalUren)",
    "Aantal uren (dec)": "sum(AantalUren)",
    "Commerciële waarden uren": "sum(AantalUren * Uurtarief)",
    "Declarabiliteit (variant 2)": "sum(FacturabeleUren) / sum(AantalUren)",
    "Bezettingsgraad": f"{_sum(_PROJECT)} / sum(AantalUren)",
    "Bezettingsgraad Laatste 12 maanden": f"{_sum(f'{_PROJECT} AND {_LAST}')} / {_sum(_LAST)}",
    "Bezettingsgraad YTD": f"{_sum(_PROJECT + ' AND dag BETWEEN DATE ' + repr('1998-01-01') + ' AND DATE ' + repr('1998-06-15'))} / {_sum('dag BETWEEN DATE ' + repr('1998-01-01') + ' AND DATE ' + repr('1998-06-15'))}",
    "Aantal Geplande Verlofuren": _sum("Verloftype = 'Regulier verlof' AND dag >= DATE '1998-06-15'"),
    "Aantal Opgenomen Verlofuren": _sum("Verloftype = 'Regulier verlof' AND dag <= DATE '1998-06-15'"),
    "Aantal Geschreven Projecturen Laatste 12 Maanden": _sum(
        "ProjectKey <> 0 AND IsFacturabel AND dag BETWEEN DATE '1997-08-01' AND DATE '1998-06-30'"
    ),
    "Aantal Geschreven Ziekteuren": _sum(f"{_SICK} AND GoedkeuringsStatus = 'Approved'"),
    "Aantal Geschreven Ziekteuren (variant 2)": _sum(_SICK),
    "Ziekteverzuim": _sum(f"{_SICK} AND GoedkeuringsStatus = 'Approved'") + " / sum(AantalUren)",
    "Externe Uren": _sum("InternExtern = 'Extern'"),
    "Geschreven uren (gecompenseerd)": _sum(_WORKED),
    "Geschreven uren (gecompenseerd) (variant 2)": _sum(_WORKED_OLD),
    "Facturabele Uren": _sum(f"{_WORKED} AND pf"),
    "Facturabele Uren (variant 2)": _sum(f"{_WORKED_OLD} AND pf"),
    "Facturabele Uren (variant 3)": "sum(FacturabeleUren)",
    "Niet Facturabele Uren": "sum(NietFacturabeleUren)",
    "Factureerbare uren geschreven": _sum("pf"),
    "Productiviteitspercentage": f"{_sum(f'{_WORKED} AND pf')} / {_sum(_WORKED)}",
    "Indirecte uren": _sum(f"lower(TaakNaam) IN ({_quoted_list(ops.INDIRECT)})"),
    "UrenIndirect %": f"{_sum(f'lower(TaakNaam) IN ({_quoted_list(ops.INDIRECT)})')} / {_sum(_WORKED)}",
    "Interne uren": _sum(f"{_WORKED} AND InternExtern = 'Intern'"),
    "Interne uren (variant 2)": _sum("InternExtern = 'Intern'"),
    "Interne uren laatste 12 maanden": _sum(f"InternExtern = 'Intern' AND {_LAST}"),
    "Geschreven ProjectUren Laatste 12 maanden": _sum(_PROJECT),
    "Geschreven Uren Laatste 12 maanden": _sum(_LAST),
    "Geschreven Uren Voorgaande 12 maanden": _sum(_BEFORE),
    "Geschreven projecturen": _sum(f"{_WORKED} AND ProjectKey IS NOT NULL"),
    "Projectomzet medewerker": f"{_sum(f'{_WORKED} AND ProjectKey IS NOT NULL')} * (SELECT avg(Uurtarief) FROM \"DimMedewerkers\")",
}
_metrics(
    "hours_by_practice",
    f"""
    WITH {_HOURS}
    SELECT PracticeNaam, {_cols(r, _HOUR_METRICS)}, 0.8 :: DOUBLE AS "Bezettingsgraad_Norm"
    FROM h GROUP BY PracticeNaam
    """,
    shapes.operational, lambda: ops.hours(NOW), [*_HOUR_METRICS, "Bezettingsgraad Norm"],
    by=["DimPractice.PracticeNaam"],
)

_metrics(
    "hours_by_month_against_last_year",
    f"""
    WITH {_HOURS},
    nu AS (SELECT year(dag) AS Jaar, month(dag) AS MaandNummer, round(sum(AantalUren), 4) AS uren FROM h GROUP BY ALL),
    ly AS (SELECT d.Jaar, d.MaandNummer,
                  round(sum(AantalUren) FILTER (WHERE {_PROJECT} AND Verloftype IS NULL), 4) AS project,
                  round(sum(AantalUren) FILTER (WHERE {_WORKED}), 4) AS gewerkt
           FROM h LEFT JOIN "DimDatum" d ON d.Datum = CAST(dag + INTERVAL 12 MONTH AS DATE) GROUP BY ALL)
    SELECT coalesce(nu.Jaar, ly.Jaar) AS Jaar, coalesce(nu.MaandNummer, ly.MaandNummer) AS MaandNummer,
           nu.uren AS "Aantal_geschreven_Uren", ly.project AS "Aantal_Geschreven_Projecturen_Vorig_Jaar",
           ly.gewerkt AS "Geschreven_uren_gecompenseerd_LY"
    FROM {_join(["Jaar", "MaandNummer"], ["nu", "ly"])}
    WHERE nu.uren IS NOT NULL OR ly.project IS NOT NULL OR ly.gewerkt IS NOT NULL
    """,
    shapes.operational, lambda: ops.hours(NOW),
    ["Aantal geschreven Uren", "Aantal Geschreven Projecturen Vorig Jaar", "Geschreven uren (gecompenseerd) LY"],
    by=["DimDatum.Jaar", "DimDatum.MaandNummer"],
)

_metrics(
    "invoiced_hours_by_employee",
    f"""
    WITH w AS (SELECT MedewerkerKey, sum(AantalUren) AS u FROM "FeitGeschrevenUren" GROUP BY 1),
    f AS (SELECT MedewerkerKey, sum(UrenGefactureerd) AS g FROM "FeitFactuurregels" GROUP BY 1)
    SELECT e.MedewerkerId, {r("g", "GefactureerdeUren")}, {r("g / nullif(u, 0)", "Declarabiliteit")}
    FROM "DimMedewerkers" e LEFT JOIN w USING (MedewerkerKey) LEFT JOIN f USING (MedewerkerKey)
    WHERE u IS NOT NULL OR g IS NOT NULL
    """,
    shapes.operational, lambda: ops.hours(NOW), ["GefactureerdeUren", "Declarabiliteit"],
    by=["DimMedewerkers.MedewerkerId"],
)

# --- revenue ------------------------------------------------------------------------
_LINES = """
    l AS (SELECT f.*, CAST(f.FactuurDatum AS DATE) AS dag, k.Branche, o.DatumAfgerond, e.IsExterneMedewerker AS ext
          FROM "FeitFactuurregels" f LEFT JOIN "DimProjecten" o ON o.ProjectKey = f.ProjectKey
          LEFT JOIN "DimKlanten" k ON k.KlantKey = o.KlantKey
          LEFT JOIN "DimMedewerkers" e ON e.MedewerkerKey = f.MedewerkerKey),
    i AS (SELECT f.*, CAST(f.Factuurdatum AS DATE) AS dag, k.Branche FROM "FeitFacturen" f
          LEFT JOIN "DimProjecten" o ON o.ProjectKey = f.ProjectKey LEFT JOIN "DimKlanten" k ON k.KlantKey = o.KlantKey),
    u AS (SELECT f.*, CAST(f.Datum AS DATE) AS dag, k.Branche, o.IsFacturabel AS pf, e.IsExterneMedewerker AS ext, e.Uurtarief
          FROM "FeitGeschrevenUren" f LEFT JOIN "DimProjecten" o ON o.ProjectKey = f.ProjectKey
          LEFT JOIN "DimKlanten" k ON k.KlantKey = o.KlantKey
          LEFT JOIN "DimMedewerkers" e ON e.MedewerkerKey = f.MedewerkerKey)
"""
_L, _U, _I = "BedragExclBTW", "KostprijsTarief", "Subtotaal"
_BEFORE2 = "dag BETWEEN DATE '1995-07-01' AND DATE '1996-06-30'"
_MAY = "dag BETWEEN DATE '1998-05-01' AND DATE '1998-05-31'"
_metrics(
    "revenue_by_segment",
    f"""
    WITH {_LINES},
    lx AS (SELECT Branche, sum({_L}) AS net, sum(BedragInclBTW) AS gross, sum(KostenBedrag) AS cost, avg(UurTarief) AS tarief,
                  {_sum(_LAST, _L)} AS net12, {_sum(_BEFORE2, _L)} AS net24,
                  {_sum("coalesce(ext, 0) = 0", _L)} AS intern, {_sum("ext = 1", _L)} AS extern FROM l GROUP BY 1),
    ix AS (SELECT Branche, sum({_I}) AS billed, {_sum(_LAST, _I)} AS billed12, {_sum(_MAY, _I)} AS billedmay FROM i GROUP BY 1),
    ux AS (SELECT Branche, sum({_U}) AS kost, {_sum(_LAST, _U)} AS kost12, {_sum(_MAY, _U)} AS kostmay, {_sum("coalesce(ext, 0) = 0", _U)} AS kintern,
                  {_sum("ext = 1", _U)} AS kextern, sum(OmzetPotentie) AS pot, {_sum("pf", "OmzetPotentie")} AS potf,
                  sum(AantalUren * Uurtarief) AS waarde, sum(AantalUren) AS uren FROM u GROUP BY 1)
    SELECT coalesce(lx.Branche, ix.Branche, ux.Branche) AS Branche, {_cols(r, {
        "Omzet ex. BTW (variant 2)": "net", "Omzet ex. BTW (klant)": "net", "Omzet incl BTW (klant)": "gross",
        "Omzet  Laatste 12 maanden": "net12", "Omzet Voorgaande 12 maanden": "net24",
        "Factuuromzet": "billed", "Factuurkosten": "kost", "Factuurkosten (variant 2)": "cost",
        "KostenExtern": "kextern", "KostenIntern": "kintern", "MedewerkerOmzet": "intern", "ExterneMedewerkerOmzet": "extern",
        "Percentage interne/externe kosten": "kextern / nullif(kost, 0)",
        "Percentage interne/externe omzet": "extern / nullif(net, 0)",
        "Brutomarge": "coalesce(billed, 0) - coalesce(kost, 0)", "Brutomarge (variant 2)": "net - cost",
        "Brutomarge %": "(coalesce(billed, 0) - coalesce(kost, 0)) / nullif(billed, 0)",
        "Brutomarge % (variant 2)": "(net - cost) / nullif(net, 0)",
        "Brutomarge  Laatste 12 maanden": "coalesce(billed12, 0) - coalesce(kost12, 0)",
        "Brutomarge % Laatste 12 maanden": "(coalesce(billed12, 0) - coalesce(kost12, 0)) / nullif(billed12, 0)",
        "Brutomarge % Vorige Maand": "(coalesce(billedmay, 0) - coalesce(kostmay, 0)) / nullif(billedmay, 0)",
        "Gemiddeld Uurtarief": "tarief", "OmzetPotentie": "potf", "OmzetPotentie (variant 2)": "pot",
        "Realisatiegraad": "billed / nullif(potf, 0)", "%Verhouding uren": "net / nullif(waarde, 0)",
        "Verhouding Omzet t.o.v. Commerciële uren": 'net / ((SELECT sum(Uurtarief) FROM "DimMedewerkers") * uren)',
    })}
    FROM lx FULL JOIN ix ON lx.Branche IS NOT DISTINCT FROM ix.Branche
    FULL JOIN ux ON coalesce(lx.Branche, ix.Branche) IS NOT DISTINCT FROM ux.Branche
    """,
    shapes.operational, lambda: ops.revenue(NOW),
    [
        "Omzet ex. BTW (variant 2)", "Omzet ex. BTW (klant)", "Omzet incl BTW (klant)", "Omzet  Laatste 12 maanden",
        "Omzet Voorgaande 12 maanden", "Factuuromzet", "Factuurkosten", "Factuurkosten (variant 2)", "KostenExtern",
        "KostenIntern", "MedewerkerOmzet", "ExterneMedewerkerOmzet", "Percentage interne/externe kosten",
        "Percentage interne/externe omzet", "Brutomarge", "Brutomarge (variant 2)", "Brutomarge %",
        "Brutomarge % (variant 2)", "Brutomarge  Laatste 12 maanden", "Brutomarge % Laatste 12 maanden",
        "Brutomarge % Vorige Maand", "Gemiddeld Uurtarief", "OmzetPotentie", "OmzetPotentie (variant 2)",
        "Realisatiegraad", "%Verhouding uren", "Verhouding Omzet t.o.v. Commerciële uren",
    ],
    by=["DimKlanten.Branche"],
)

_NEXT = "d.Datum = CAST(dag + INTERVAL 12 MONTH AS DATE)"
_metrics(
    "revenue_by_year_against_last_year",
    f"""
    WITH {_LINES},
    nu AS (SELECT year(dag) AS Jaar, sum({_L}) AS net FROM l GROUP BY 1),
    ly AS (SELECT d.Jaar, sum({_L}) AS net, sum(KostenBedrag) AS cost, {_sum("ext = 1", _L)} AS extern
           FROM l LEFT JOIN "DimDatum" d ON {_NEXT} GROUP BY 1),
    bi AS (SELECT d.Jaar, sum({_I}) AS billed FROM i LEFT JOIN "DimDatum" d ON {_NEXT} GROUP BY 1),
    ko AS (SELECT d.Jaar, sum({_U}) AS kost FROM u LEFT JOIN "DimDatum" d ON {_NEXT} GROUP BY 1),
    af AS (SELECT d.Jaar, sum({_L}) AS net FROM l LEFT JOIN "DimDatum" d ON d.Datum = DatumAfgerond GROUP BY 1),
    ff AS (SELECT d.Jaar, sum(Krow__Amount__c) AS fee FROM "FixedFee" LEFT JOIN "DimDatum" d ON d.Datum = CAST(Krow__Date__c AS DATE) GROUP BY 1),
    j AS (SELECT Jaar FROM nu UNION SELECT Jaar FROM ly UNION SELECT Jaar FROM af UNION SELECT Jaar FROM bi UNION SELECT Jaar FROM ko UNION SELECT Jaar FROM ff)
    SELECT j.Jaar, {_cols(r, {
        "Omzet ex. BTW (variant 2)": "nu.net", "Omzet ex. BTW Vorig Jaar": "ly.net", "Kosten Vorig Jaar": "ly.cost",
        "ExterneMedewerkerOmzet Vorig Jaar": "ly.extern",
        "Brutomarge Vorig Jaar": "(coalesce(bi.billed, 0) - coalesce(ko.kost, 0)) / nullif(bi.billed, 0)",
        "Omzet o.b.v DatumAfgerond": "af.net", "FixedFee": "ff.fee",
    })}
    FROM j LEFT JOIN nu ON nu.Jaar IS NOT DISTINCT FROM j.Jaar LEFT JOIN ly ON ly.Jaar IS NOT DISTINCT FROM j.Jaar
    LEFT JOIN bi ON bi.Jaar IS NOT DISTINCT FROM j.Jaar LEFT JOIN ko ON ko.Jaar IS NOT DISTINCT FROM j.Jaar
    LEFT JOIN af ON af.Jaar IS NOT DISTINCT FROM j.Jaar LEFT JOIN ff ON ff.Jaar IS NOT DISTINCT FROM j.Jaar
    WHERE nu.net IS NOT NULL OR ly.net IS NOT NULL OR af.net IS NOT NULL OR bi.billed IS NOT NULL OR ff.fee IS NOT NULL
    """,
    shapes.operational, lambda: ops.revenue(NOW),
    [
        "Omzet ex. BTW (variant 2)", "Omzet ex. BTW Vorig Jaar", "Kosten Vorig Jaar",
        "ExterneMedewerkerOmzet Vorig Jaar", "Brutomarge Vorig Jaar", "Omzet o.b.v DatumAfgerond", "FixedFee",
    ],
    by=["DimDatum.Jaar"],
)

_metrics(
    "billing_by_practice",
    f"""
    WITH p AS (SELECT * FROM "DimPractice"),
    f AS (SELECT p.PracticeNaam, sum(Subtotaal) AS fact FROM "FeitFacturen" f LEFT JOIN "DimProjecten" o ON o.ProjectKey = f.ProjectKey
          LEFT JOIN p ON p.PracticeKey = o.PracticeKey GROUP BY 1),
    u AS (SELECT p.PracticeNaam, sum(u.OmzetPotentie) FILTER (WHERE o.IsFacturabel) AS pot,
                 sum(u.OmzetPotentie) FILTER (WHERE o.IsFacturabel AND o.PracticeKey = u.PracticeKey) AS eigen
          FROM "FeitGeschrevenUren" u LEFT JOIN "DimProjecten" o ON o.ProjectKey = u.ProjectKey
          LEFT JOIN p ON p.PracticeKey = u.PracticeKey GROUP BY 1),
    v AS (SELECT p.PracticeNaam, sum(u.OmzetPotentie) AS via FROM "FeitGeschrevenUren" u
          LEFT JOIN "DimProjecten" o ON o.ProjectKey = u.ProjectKey LEFT JOIN p ON p.PracticeKey = o.PracticeKey GROUP BY 1),
    j AS (SELECT PracticeNaam FROM f UNION SELECT PracticeNaam FROM u UNION SELECT PracticeNaam FROM v)
    SELECT j.PracticeNaam, {_cols(r, {
        "Facturatie": "fact", "Verschil facturatie en uren": "coalesce(fact, 0) - coalesce(pot, 0)",
        "% Facturabel": "fact / nullif(pot, 0)", "OmzetPotentiePerPractice": "eigen", "TotaalPerPractice": "via",
    })}
    FROM j LEFT JOIN f ON f.PracticeNaam IS NOT DISTINCT FROM j.PracticeNaam
    LEFT JOIN u ON u.PracticeNaam IS NOT DISTINCT FROM j.PracticeNaam LEFT JOIN v ON v.PracticeNaam IS NOT DISTINCT FROM j.PracticeNaam
    """,
    shapes.operational, lambda: catalogue.operational(NOW, by=["DimPractice.PracticeNaam"]),
    ["Facturatie", "Verschil facturatie en uren", "% Facturabel", "OmzetPotentiePerPractice", "TotaalPerPractice"],
    by=["DimPractice.PracticeNaam"],
)

_metrics(
    "revenue_against_rates",
    f"""
    WITH x AS (SELECT (SELECT sum(BedragExclBTW) FROM "FeitFactuurregels") AS net,
                      (SELECT sum(Uurtarief) FROM "DimMedewerkers") AS rate,
                      (SELECT sum(Aantal_uren_per_week) FROM "FeitRoosterUren") AS rooster,
                      (SELECT sum(AantalUren) FROM "DimMedewerkers") AS uren,
                      (SELECT sum(Subtotaal) FROM "FeitFacturen" WHERE CAST(Factuurdatum AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-06-15') AS ytd,
                      (SELECT sum(FTE_x_MonthGoal) FROM "FeitBudgetten" WHERE MonthDateKey BETWEEN 19980101 AND 19980615) AS goal)
    SELECT {_cols(r, {
        "Verhouding Omzet t.o.v. Commerciële uren (variant 2)": "net / (rate * rooster)",
        "Verhouding Omzet t.o.v. Commerciële uren (variant 3)": "net / (rate * uren)",
        "Cumulatieve Factuuromzet": "ytd", "Cumulatief Budget": "goal",
    })} FROM x
    """,
    shapes.operational, lambda: {**ops.revenue(NOW), **ops.budget(NOW)},
    [
        "Verhouding Omzet t.o.v. Commerciële uren (variant 2)", "Verhouding Omzet t.o.v. Commerciële uren (variant 3)",
        "Cumulatieve Factuuromzet", "Cumulatief Budget",
    ],
)

# --- projects -------------------------------------------------------------------------
_metrics(
    "projects_by_year",
    f"""
    WITH s AS (SELECT year(Startdatum) AS Jaar, {_cols(n, {
        "Aantal Actieve Projecten": "count(ProjectId) FILTER (WHERE ProjectStatus = 'In Progress')",
        "Aantal toekomstige Projecten": "count(ProjectId) FILTER (WHERE ProjectStatus = 'Not Started')",
        "Aantal Projecten met Taakregels": "count(ProjectId) FILTER (WHERE ProjectStatus = 'In Progress')",
    })}, round(sum(GeschatteUren) FILTER (WHERE CAST(Startdatum AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1999-06-30'), 4)
        AS "Geschatte_Uren_Komende_12_maanden" FROM "DimProjecten" GROUP BY 1),
    a AS (SELECT d.Jaar, {n("count(DISTINCT ProjectId) FILTER (WHERE ProjectStatus = 'Complete')", "Afgeronde Projecten")}
          FROM "DimProjecten" LEFT JOIN "DimDatum" d ON d.Datum = DatumAfgerond GROUP BY 1),
    h AS (SELECT year(Datum) AS Jaar, {n("count(DISTINCT ProjectKey) + count(DISTINCT CASE WHEN ProjectKey IS NULL THEN 1 END)", "Aantal Projecten met uren")}
          FROM "FeitGeschrevenUren" GROUP BY 1),
    j AS (SELECT Jaar FROM s UNION SELECT Jaar FROM a UNION SELECT Jaar FROM h)
    SELECT j.Jaar, s.* EXCLUDE (Jaar), a.* EXCLUDE (Jaar), h.* EXCLUDE (Jaar) FROM j
    LEFT JOIN s ON s.Jaar IS NOT DISTINCT FROM j.Jaar LEFT JOIN a ON a.Jaar IS NOT DISTINCT FROM j.Jaar
    LEFT JOIN h ON h.Jaar IS NOT DISTINCT FROM j.Jaar
    WHERE "Aantal_Actieve_Projecten" IS NOT NULL OR "Afgeronde_Projecten" IS NOT NULL OR "Aantal_Projecten_met_uren" IS NOT NULL
    """,
    shapes.operational, lambda: ops.projects(NOW),
    [
        "Aantal Actieve Projecten", "Aantal toekomstige Projecten", "Aantal Projecten met Taakregels",
        "Geschatte Uren Komende 12 maanden", "Afgeronde Projecten", "Aantal Projecten met uren",
    ],
    by=["DimDatum.Jaar"],
)

_PROJECT_SUMS = {
    "Gerealiseerde ProjectOmzet": "sum(FacturabeleOmzet)", "Verwachte Omzet": "sum(VerwachteOmzet)",
    "Omzet vs verwachte omzet": "sum(VerwachteOmzet) - sum(FacturabeleOmzet)", "Geschatte Uren": "sum(GeschatteUren)",
    "GeschrevenProjectUren": "sum(AantalUren)",
    "Overschrijdingspercentage": "(sum(AantalUren) - sum(GeschatteUren)) / sum(GeschatteUren)",
    "Openstaande uren": "sum(GeschatteUrenOverlogd)", "GeschatteUrenOverlogd": "sum(GeschatteUrenOverlogd)",
    "Gemiddelde NPS-score": "avg(Tevredenheidsscore)", "Klanttevredenheid": "sum(Tevredenheidsscore)",
}
_metrics(
    "projects_by_customer_type",
    f"""
    WITH o AS (SELECT o.*, k.KlantType FROM "DimProjecten" o LEFT JOIN "DimKlanten" k ON k.KlantKey = o.KlantKey),
    s AS (SELECT KlantType, {_cols(n, {
        "Aantal Projecten": "count(ProjectId)", "Projecten op tijd": "count(ProjectId) FILTER (WHERE OpTijdAfgerond = 1)",
        "OpTijdProjecten": "count(ProjectId) FILTER (WHERE OpTijdAfgerond = 1)",
    })}, {_cols(r, _PROJECT_SUMS)} FROM o GROUP BY 1),
    f AS (SELECT o.KlantType, {n("count(Score)", "Aantal surveys")}, {r("avg(Score)", "Gem. Klanttevredenheid")}
          FROM "FeitTevredenheid" f LEFT JOIN o ON o.ProjectKey = f.ProjectKey GROUP BY 1),
    k AS (SELECT KlantType, {n("count(DISTINCT KlantID) FILTER (WHERE KlantType IN ('Customer', 'Customer - Indirect'))", "Aantal klanten met facturatie")}
          FROM "DimKlanten" GROUP BY 1)
    SELECT s.*, f.* EXCLUDE (KlantType), k.* EXCLUDE (KlantType), 8.5 :: DOUBLE AS "CTAS_doel"
    FROM s LEFT JOIN f USING (KlantType) LEFT JOIN k USING (KlantType)
    """,
    shapes.operational, lambda: ops.projects(NOW),
    [
        "Aantal Projecten", "Projecten op tijd", "OpTijdProjecten", *_PROJECT_SUMS, "Aantal surveys",
        "Gem. Klanttevredenheid", "Aantal klanten met facturatie", "CTAS doel",
    ],
    by=["DimKlanten.KlantType"],
)

_metrics(
    "customers_by_practice",
    f"""
    SELECT p.PracticeNaam, {n("count(DISTINCT o.KlantKey)", "aantal klanten per practice")}
    FROM "DimProjecten" o LEFT JOIN "DimPractice" p ON p.PracticeKey = o.PracticeKey GROUP BY 1
    """,
    shapes.operational, lambda: ops.projects(NOW), ["aantal klanten per practice"],
    by=["DimPractice.PracticeNaam"],
)

_metrics(
    "task_hours_by_project_status",
    f"""
    SELECT o.ProjectStatus, {n("count(*)", "Aantal Taakregels met Project")}, {r("sum(t.TotaalGeschrevenUren)", "Totaalgeschreven Taakuren")}
    FROM "DimTaakregels" t LEFT JOIN "DimProjecten" o ON o.ProjectKey = t.ProjectKey GROUP BY 1
    """,
    shapes.operational, lambda: ops.projects(NOW), ["Aantal Taakregels met Project", "Totaalgeschreven Taakuren"],
    by=["DimProjecten.ProjectStatus"],
)

# --- planning ---------------------------------------------------------------------------
_PLAN = """
    g AS (SELECT g.*, CAST(Datum AS DATE) AS dag, e.TeamKey FROM "FeitGeplandeUren" g LEFT JOIN "DimMedewerkers" e ON e.MedewerkerKey = g.MedewerkerKey),
    ro AS (SELECT r.*, CAST(Datum AS DATE) AS dag, e.TeamKey FROM "FeitRoosterUren" r LEFT JOIN "DimMedewerkers" e ON e.MedewerkerKey = r.MedewerkerKey),
    v AS (SELECT v.*, CAST(v.Datum AS DATE) AS dag, e.TeamKey FROM "FeitVerlofAanvragen" v LEFT JOIN "DimMedewerkers" e ON e.MedewerkerKey = v.MedewerkerKey),
    b AS (SELECT u.*, CAST(Datum AS DATE) AS dag, e.TeamKey FROM "FeitGeschrevenUren" u LEFT JOIN "DimMedewerkers" e ON e.MedewerkerKey = u.MedewerkerKey)
"""
_WEEK = "year(dag) = 1998 AND weekofyear(dag) = 25"
_MONTH = "year(dag) = 1998 AND month(dag) = 6"
_COMING = "dag BETWEEN DATE '1998-06-01' AND DATE '1999-06-30'"
_NEAR = "dag BETWEEN DATE '1998-06-15' AND DATE '1998-08-31'"
_WEEKS = "(SELECT count(DISTINCT (dayofyear(d) + dayofweek(make_date(year(d), 1, 1)) - 1) // 7) FROM (SELECT Datum AS d FROM \"DimDatum\"))"


def _load(where: str) -> str:
    return f"coalesce((g.p_{where}) / nullif(ro.d_{where} - coalesce(v.l_{where}, 0), 0), CASE WHEN coalesce(ro.d_{where} - coalesce(v.l_{where}, 0), 0) = 0 THEN 0 END)"


_SPANS = {"all": "true", "week": _WEEK, "month": _MONTH, "next": _COMING, "near": _NEAR, "weeknext": f"{_WEEK} AND {_COMING}"}
_metrics(
    "planning_by_team",
    f"""
    WITH {_PLAN},
    gx AS (SELECT TeamKey, {", ".join(f"{_sum(w, 'GeplandeUren')} AS p_{k}" for k, w in _SPANS.items())}, sum(UrenTotaal) AS tot FROM g GROUP BY 1),
    rx AS (SELECT TeamKey, {", ".join(f"{_sum(w, 'UrenPerDag')} AS d_{k}" for k, w in _SPANS.items())}, sum(Aantal_uren_per_week) AS wk FROM ro GROUP BY 1),
    vx AS (SELECT TeamKey, {", ".join(f"{_sum(w, 'Aantal_uren')} AS l_{k}" for k, w in _SPANS.items())}, sum(Verlofuren) AS old,
                  sum(Verlofuren) FILTER (WHERE VerlofType = 'Regulier Verlof') AS reg,
                  count(DISTINCT FeitVerlofAanvraagKey) AS n FROM v GROUP BY 1),
    bx AS (SELECT TeamKey, {_sum("Verloftype = 'Regulier verlof' AND dag >= DATE '1998-06-15'")} AS booked FROM b GROUP BY 1),
    fu AS (SELECT TeamKey, sum(hi) AS fut FROM (SELECT TeamKey, DatumAangevraagd, max(Verlofuren) AS hi FROM v
           WHERE CAST(DatumVerlof AS DATE) > DATE '1998-06-15' AND CAST(DatumVerlof AS DATE) <= DATE '1999-06-30' GROUP BY ALL) GROUP BY 1),
    sa AS (SELECT e.TeamKey, sum(TotaalEindSaldo) AS saldo FROM "FeitVerlofSaldo" s LEFT JOIN "DimMedewerkers" e ON e.MedewerkerKey = s.MedewerkerKey GROUP BY 1)
    SELECT t.Team, {n("v.n", "Aantal Verlof Dagen Komende 12 Maanden")}, {_cols(r, {
        "Verlofuren": "v.l_all", "Verlofuren (variant 2)": "v.old", "Aantal Verlofuren": "v.old", "Reguliere Verlofuren": "v.reg",
        "Toekomstige Verlofuren Komende 12 Maanden": "fut", "Toekomstige Verlofuren Komende 12 Maanden2": "fut", "Verlofsaldo": "saldo",
        "AantalBeschikbareUren": "ro.d_all - v.l_all", "AantalBeschikbareUren (variant 2)": "ro.wk", "AantalBeschikbareUren (variant 3)": "ro.wk",
        "Aantal Uren": "ro.wk", "AantalBeschikbareUrenMaand": "ro.wk",
        "AantalBeschikbareUrenGeselecteerdePeriode": f"ro.wk * {_WEEKS}",
        "AantalBeschikbareUrenGeselecteerdePeriode (variant 2)": f"ro.wk * {_WEEKS}",
        "BezettingsgraadBeschikbareUren": f"ro.wk * {_WEEKS} - coalesce(booked, 0)",
        "Beschikbaarheid": "ro.d_all - v.l_all - v.l_all", "GeplandeUren": "g.p_all", "GeplandeUren (variant 2)": "g.tot", "GeplandeProjectUren": "g.tot",
        "Geplande Uren komende 12 maanden": "g.p_next", "VerwachteBezettingsgraad": _load("week"),
        "VerwachteBezettingsgraad (variant 2)": f"g.p_all / (ro.wk * {_WEEKS} - coalesce(booked, 0))",
        "VerwachteBezettingsgraadKomende12Mnd": _load("weeknext"), "VerwachteBezettingsgraadweek": f"g.p_all / (ro.wk * {_WEEKS})",
        "VerwachteBezettingsgraadMaand": _load("month"), "VerwachteBezettingsgraadNieuw": _load("all"),
        "VerwachteBezettingsgraadNieuw (variant 2)": _load("all"), "NieuweBezet": _load("near"),
    })}
    FROM gx g JOIN rx ro USING (TeamKey) LEFT JOIN vx v USING (TeamKey) LEFT JOIN bx USING (TeamKey) LEFT JOIN fu USING (TeamKey)
    LEFT JOIN sa USING (TeamKey) JOIN "DimTeam" t USING (TeamKey)
    """,
    shapes.operational, lambda: ops.planning(NOW),
    [
        "Aantal Verlof Dagen Komende 12 Maanden", "Verlofuren", "Verlofuren (variant 2)", "Aantal Verlofuren",
        "Reguliere Verlofuren", "Toekomstige Verlofuren Komende 12 Maanden",
        "Toekomstige Verlofuren Komende 12 Maanden2", "Verlofsaldo", "AantalBeschikbareUren",
        "AantalBeschikbareUren (variant 2)", "AantalBeschikbareUren (variant 3)", "Aantal Uren",
        "AantalBeschikbareUrenMaand", "AantalBeschikbareUrenGeselecteerdePeriode",
        "AantalBeschikbareUrenGeselecteerdePeriode (variant 2)", "BezettingsgraadBeschikbareUren", "Beschikbaarheid",
        "GeplandeUren", "GeplandeUren (variant 2)", "GeplandeProjectUren", "Geplande Uren komende 12 maanden",
        "VerwachteBezettingsgraad", "VerwachteBezettingsgraad (variant 2)", "VerwachteBezettingsgraadKomende12Mnd",
        "VerwachteBezettingsgraadweek", "VerwachteBezettingsgraadMaand", "VerwachteBezettingsgraadNieuw",
        "VerwachteBezettingsgraadNieuw (variant 2)", "NieuweBezet",
    ],
    by=["DimTeam.Team"],
)

_metrics(
    "occupancy_by_week",
    f"""
    WITH p AS (SELECT year(Datum) * 100 + weekofyear(Datum) AS JaarWeek, sum(GeplandeUren) AS g FROM "FeitGeplandeUren" GROUP BY 1),
    q AS (SELECT year(Datum) * 100 + weekofyear(Datum) AS JaarWeek, sum(UrenPerDag) AS d FROM "FeitRoosterUren" GROUP BY 1),
    v AS (SELECT year(Datum) * 100 + weekofyear(Datum) AS JaarWeek, sum(Aantal_uren) AS l FROM "FeitVerlofAanvragen" GROUP BY 1)
    SELECT JaarWeek, {r("CASE WHEN d - coalesce(l, 0) = 0 THEN 0 ELSE g / (d - coalesce(l, 0)) END", "VerwachteBezettingsgraad")}
    FROM p JOIN q USING (JaarWeek) LEFT JOIN v USING (JaarWeek)
    """,
    shapes.operational, lambda: ops.planning(NOW, by=["DimDatum.JaarWeek"]), ["VerwachteBezettingsgraad"],
    by=["DimDatum.JaarWeek"],
)

_metrics(
    "occupancy_over_selected_statuses",
    f"""
    WITH p AS (SELECT Status, sum(GeplandeUren) AS g FROM "FeitGeplandeUren" GROUP BY 1)
    SELECT Status, {r("g", "GeplandeUren")},
           {r('(SELECT sum(g) FROM p) / ((SELECT sum(UrenPerDag) FROM "FeitRoosterUren") - (SELECT sum(Aantal_uren) FROM "FeitVerlofAanvragen"))', "VerwachteBezettingsgraadCorrect")}
    FROM p
    """,
    shapes.operational, lambda: ops.planning(NOW), ["GeplandeUren", "VerwachteBezettingsgraadCorrect"],
    by=["FeitGeplandeUren.Status"],
)

# --- budget --------------------------------------------------------------------------------
_metrics(
    "budget_by_year",
    f"""
    WITH l AS (SELECT year(FactuurDatum) AS Jaar, sum(BedragExclBTW) AS net FROM "FeitFactuurregels" GROUP BY 1),
    b AS (SELECT Jaar, sum(InternPerDag_FTE) AS dag, sum(Intern) AS intern, sum(FTE_x_MonthGoal) AS goal, sum(JaardoelPerDag_FTE) AS jd, sum(FTE) AS fte FROM "FeitBudgetten" GROUP BY 1),
    y AS (SELECT (SELECT sum(BedragExclBTW) FROM "FeitFactuurregels" WHERE CAST(FactuurDatum AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-06-14') AS ytd,
                 165 / 365 AS ratio)
    SELECT l.Jaar, {_cols(r, {
        "YTDDaysRatio": "ratio", "YTD Omzet ex. BTW": "ytd", "Totaal Budget (intern)": "dag", "Totaal Budget": "dag",
        "Totaal Budget (variant 2)": "intern", "Totaal Budget copy": "intern", "YTD Budget": "ratio * dag",
        "YTD percentage": "ytd / nullif(ratio * dag, 0)", "Percentage Jaarbudget": "ytd / nullif(dag, 0)",
        "Percentage Jaarbudget (variant 2)": "ytd / nullif(dag, 0)", "OmzetVSBudget (intern)": "net - coalesce(dag, 0)",
        "OmzetVSBudget": "net - coalesce(dag, 0)", "OmzetVSBudget (variant 2)": "ytd - coalesce(ratio * dag, 0)",
        "YTD Jaardoel per medewerker": "goal", "YTD Jaardoel per medewerker (variant 2)": "jd",
        "OmzetVSBudget (jaardoel)": "net - coalesce(goal, 0)", "Voortgang doel": "net / nullif(goal, 0)", "BudgetFTE": "fte",
    })}
    FROM l LEFT JOIN b USING (Jaar), y
    """,
    shapes.operational, lambda: ops.budget(NOW),
    [
        "YTDDaysRatio", "YTD Omzet ex. BTW", "Totaal Budget (intern)", "Totaal Budget", "Totaal Budget (variant 2)",
        "Totaal Budget copy", "YTD Budget", "YTD percentage", "Percentage Jaarbudget",
        "Percentage Jaarbudget (variant 2)", "OmzetVSBudget (intern)", "OmzetVSBudget", "OmzetVSBudget (variant 2)",
        "YTD Jaardoel per medewerker", "YTD Jaardoel per medewerker (variant 2)", "OmzetVSBudget (jaardoel)",
        "Voortgang doel", "BudgetFTE",
    ],
    by=["DimDatum.Jaar"],
)

# --- service contracts and cloud cost -----------------------------------------------------
_CUSTOMER = "LEFT JOIN \"KlantDim\" k ON k.\"Debiteurnummer\" = x.\"Debiteurnummer\""
_METRICS_CONTRACT = {
    "aantal factureerbare uren": "h.hours", "som factureerbare uren": "h.hours", "kosten factureerbare uren": "h.cost",
    "opbrengsten factureerbare uren": "h.rev", "kosten niet factureerbaar": "u.cost",
    "totale kosten uren": "add(h.cost, u.cost)", "kosten gefactureerd": "g.cost", "tot nu toe gefactureerd": "g.rev",
    "Contractwaarde": "t.sales", "ContractTotNu": "t.due", "percontractgefactureerd": "t.due",
    "Marge Factureerbare Uren %": "CASE WHEN coalesce(h.rev, 0) = 0 THEN 0 ELSE (h.rev - coalesce(h.cost, 0)) / h.rev * 100 END",
    "Marge % Uren Incl NietFact": "CASE WHEN h.rev <> 0 THEN (h.rev - coalesce(h.cost, 0) - coalesce(u.cost, 0)) / h.rev * 100 END",
    "azure kosten": "a.cost", "AzureKosten": "a.cost", "AzureKostenPerDebiteurnummer": "a.cost",
    "TotaleKosten": "spend", "TotaleOpbrengst": "income", "winst": "sub(income, spend)",
    "marge over totaal": "CASE WHEN income IS NOT NULL AND spend IS NOT NULL THEN CASE WHEN income = 0 THEN 0 ELSE (income - spend) / income END END",
    "TotaleKosten t/m vandaag": "add(add(a.due, u.due), h.duecost)", "TotaleOpbrengst t/m vandaag": "add(t.due, h.duerev)",
    "Marge % per debiteurnummer": "CASE WHEN income <> 0 THEN (income - coalesce(add(spend, a.cost), 0)) / income * 100 END",
}


def _expand(expression: str) -> str:
    """Write out the blank-aware ``add(a, b)`` and ``sub(a, b)`` used above."""
    while "add(" in expression or "sub(" in expression:
        at = max(expression.rfind("add("), expression.rfind("sub("))
        depth, end, comma = 0, at + 3, None
        for end in range(at + 3, len(expression)):
            ch = expression[end]
            depth += (ch == "(") - (ch == ")")
            if ch == "," and depth == 1 and comma is None:
                comma = end
            if depth == 0:
                break
        sign = "+" if expression[at : at + 3] == "add" else "-"
        a, b = expression[at + 4 : comma].strip(), expression[comma + 1 : end].strip()
        body = f"(CASE WHEN {a} IS NOT NULL OR {b} IS NOT NULL THEN coalesce({a}, 0) {sign} coalesce({b}, 0) END)"
        expression = expression[:at] + body + expression[end + 1 :]
    return expression


_CONTRACT_PARTS = """
    h0 AS (SELECT x.*, k."Contact Name" AS c FROM "s4_inf billable_uren" x {c}),
    u0 AS (SELECT x.*, k."Contact Name" AS c FROM "niet_factureerbare_uren" x {c}),
    g0 AS (SELECT x.*, k."Contact Name" AS c FROM "s4_inf gefactureerde_uren" x {c}),
    t0 AS (SELECT x.*, k."Contact Name" AS c FROM "contract_opbrengsten" x {c}),
    a0 AS (SELECT x.*, k."Contact Name" AS c FROM "cost_view_exported" x {c}),
    h AS (SELECT c, sum("Billable Hours") AS hours, sum(Kosten) AS cost, sum(Opbrengsten) AS rev,
                 sum(Kosten) FILTER (WHERE CAST(Datum AS DATE) <= DATE '1998-06-15') AS duecost,
                 sum(Opbrengsten) FILTER (WHERE CAST(Datum AS DATE) <= DATE '1998-06-15') AS duerev FROM h0 GROUP BY 1),
    u AS (SELECT c, sum("Sum of Cost Amount") AS cost, sum("Sum of Cost Amount") FILTER (WHERE CAST(Krow__Date__c AS DATE) <= DATE '1998-06-15') AS due FROM u0 GROUP BY 1),
    g AS (SELECT c, sum(Kosten) AS cost, sum(Opbrengsten) AS rev FROM g0 GROUP BY 1),
    t AS (SELECT c, sum(Salesprice) AS sales, sum("Total Price") AS price, sum("Total Price") FILTER (WHERE "Termijn Maand Datum" <= DATE '1998-06-15') AS due FROM t0 GROUP BY 1),
    a AS (SELECT c, sum(costInBillingCurrency) AS cost, sum(costInBillingCurrency) FILTER (WHERE CAST(date AS DATE) <= DATE '1998-06-15') AS due FROM a0 GROUP BY 1),
    j AS (SELECT c FROM h UNION SELECT c FROM u UNION SELECT c FROM g UNION SELECT c FROM t UNION SELECT c FROM a)
""".format(c=_CUSTOMER)
_metrics(
    "contract_margins_by_contract",
    f"""
    WITH {_CONTRACT_PARTS},
    x AS (SELECT j.c, {_expand("add(add(a.cost, u.cost), h.cost)")} AS spend, {_expand("add(t.price, h.rev)")} AS income
          FROM j LEFT JOIN h ON h.c IS NOT DISTINCT FROM j.c LEFT JOIN u ON u.c IS NOT DISTINCT FROM j.c
          LEFT JOIN t ON t.c IS NOT DISTINCT FROM j.c LEFT JOIN a ON a.c IS NOT DISTINCT FROM j.c)
    SELECT x.c AS "Contact Name", {_cols(r, {k: _expand(v) for k, v in _METRICS_CONTRACT.items() if k not in ("AzureKostenPerDebiteurnummer", "Marge % per debiteurnummer")})}
    FROM x LEFT JOIN h ON h.c IS NOT DISTINCT FROM x.c LEFT JOIN u ON u.c IS NOT DISTINCT FROM x.c
    LEFT JOIN g ON g.c IS NOT DISTINCT FROM x.c LEFT JOIN t ON t.c IS NOT DISTINCT FROM x.c LEFT JOIN a ON a.c IS NOT DISTINCT FROM x.c
    """,
    shapes.contracts, lambda: catalogue.contracts(NOW),
    [k for k in _METRICS_CONTRACT if k not in ("AzureKostenPerDebiteurnummer", "Marge % per debiteurnummer")],
    by=["KlantDim.Contact Name"],
)

_metrics(
    "contract_margins_by_customer",
    f"""
    WITH {_CONTRACT_PARTS.replace('k."Contact Name" AS c', 'k."Debiteurnummer" AS c')},
    x AS (SELECT j.c, {_expand("add(add(a.cost, u.cost), h.cost)")} AS spend, {_expand("add(t.price, h.rev)")} AS income
          FROM j LEFT JOIN h ON h.c IS NOT DISTINCT FROM j.c LEFT JOIN u ON u.c IS NOT DISTINCT FROM j.c
          LEFT JOIN t ON t.c IS NOT DISTINCT FROM j.c LEFT JOIN a ON a.c IS NOT DISTINCT FROM j.c)
    SELECT x.c AS "Debiteurnummer", {_cols(r, {k: _expand(v) for k, v in _METRICS_CONTRACT.items() if k in ("AzureKostenPerDebiteurnummer", "Marge % per debiteurnummer", "winst")})}
    FROM x LEFT JOIN a ON a.c IS NOT DISTINCT FROM x.c WHERE income IS NOT NULL OR spend IS NOT NULL
    """,
    shapes.contracts, lambda: catalogue.contracts(NOW),
    ["AzureKostenPerDebiteurnummer", "Marge % per debiteurnummer", "winst"],
    by=["KlantDim.Debiteurnummer"],
)

_YESTERDAY, _DAY_BEFORE = "dag = DATE '2024-01-19'", "dag = DATE '2024-01-18'"
_THIS_WEEK = "dag BETWEEN DATE '2024-01-14' AND DATE '2024-01-20'"
_LAST_WEEK = "dag BETWEEN DATE '2024-01-07' AND DATE '2024-01-13'"
_C = "costInBillingCurrency"
_CLOUD = {
    "AzureKostenGisteren": "g", "AzureKostenEergisteren": "e", "AzureKostenVerschil": "coalesce(g, 0) - coalesce(e, 0)",
    "AzureKostenDezeWeek_RG": "w", "Kosten_DezeWeek_RG": "w", "AzureKostenVorigeWeek_RG": "v",
    "AzureKosten_Progressie": "w / v", "AzureKostenVerschil_RG": "w - v", "AzureKostenVerschilProcent_RG": "(w - v) / v * 100",
    "AzureKosten": "cost", "GemiddeldeAzureKostenPerDag": "cost / days",
}
_metrics(
    "cloud_cost_by_resource_group",
    f"""
    WITH b AS (SELECT *, CAST(date AS DATE) AS dag FROM "cost_view_exported"),
    k AS (SELECT resourceGroupName, sum({_C}) AS cost, count(DISTINCT dag) AS days FROM b GROUP BY 1),
    x AS (SELECT {_sum(_YESTERDAY, _C)} AS g, {_sum(_DAY_BEFORE, _C)} AS e, {_sum(_THIS_WEEK, _C)} AS w, {_sum(_LAST_WEEK, _C)} AS v FROM b)
    SELECT resourceGroupName, {_cols(r, _CLOUD)} FROM k, x
    """,
    shapes.contracts, lambda: catalogue.contracts(COST_NOW), list(_CLOUD),
    by=["cost_view_exported.resourceGroupName"],
)


@query(
    "profit_per_contract",
    f"""
    WITH c AS (SELECT * FROM "contract_opbrengsten" WHERE "Contact Name" = 'Contract 1-URGENT Complete'),
    k AS (SELECT DISTINCT "Debiteurnummer" AS d FROM c),
    p AS (SELECT year("Termijn Maand Datum") AS Jaar, sum("Total Price") AS p FROM c GROUP BY 1),
    a AS (SELECT year(date) AS Jaar, sum(costInBillingCurrency) AS a FROM "cost_view_exported" WHERE "Debiteurnummer" IN (SELECT d FROM k) GROUP BY 1),
    u AS (SELECT year(Krow__Date__c) AS Jaar, sum("Sum of Cost Amount") AS u FROM "niet_factureerbare_uren" WHERE "Debiteurnummer" IN (SELECT d FROM k) GROUP BY 1),
    h AS (SELECT year(Datum) AS Jaar, sum(Kosten) AS h FROM "s4_inf billable_uren" WHERE "Debiteurnummer" IN (SELECT d FROM k) GROUP BY 1),
    j AS (SELECT Jaar FROM p UNION SELECT Jaar FROM a UNION SELECT Jaar FROM u UNION SELECT Jaar FROM h)
    SELECT Jaar, {r("coalesce(p, 0) - (coalesce(a, 0) + coalesce(u, 0) + coalesce(h, 0))", "WinstPerContract")}
    FROM j LEFT JOIN p USING (Jaar) LEFT JOIN a USING (Jaar) LEFT JOIN u USING (Jaar) LEFT JOIN h USING (Jaar)
    """,
)
def _profit(spark, sf_dir):
    metrics, where = profit_per_contract("Contract 1-URGENT Complete")
    return show(shapes.contracts(spark, sf_dir), metrics, metrics, by=["dim_datum.Jaar"], where=where)


_profit.metrics = ["WinstPerContract"]

# --- sprint board -----------------------------------------------------------------------------
_metrics(
    "sprint_progress_by_project",
    f"""
    WITH s AS (SELECT "project.key" AS k, sum(StoryPoints) AS p, {_sum("lower(\"status.name\") = 'gereed'", "StoryPoints")} AS d,
                      {_sum("\"status.name\" = 'In Test'", "StoryPoints")} AS w, {_sum("\"status.name\" = 'Nog Doen'", "StoryPoints")} AS t
               FROM "FeitSprintDetails" GROUP BY 1)
    SELECT k AS "Column1_key", {_cols(r, {
        "Totaal Aantal storypoints": "p", "Totaal Aantal storypoints (variant 2)": "p", "Totaal Aantal storypoints KPI": "coalesce(p, 0)",
        "Procent Afgerond": "coalesce(d, 0) / p", "Procent Afgerond (variant 2)": "d / p", "Procent On Hold": "coalesce(w, 0) / p",
        "Procent On Hold (variant 2)": "w / p", "StoryPoints To Do": "t",
    })}, CAST(1 AS BIGINT) AS "Aantal_Projecten_variant_2" FROM s
    """,
    shapes.sprint, catalogue.sprint,
    [
        "Totaal Aantal storypoints", "Totaal Aantal storypoints (variant 2)", "Totaal Aantal storypoints KPI",
        "Procent Afgerond", "Procent Afgerond (variant 2)", "Procent On Hold", "Procent On Hold (variant 2)",
        "StoryPoints To Do", "Aantal Projecten (variant 2)",
    ],
    by=["DimProjecten.Column1.key"],
)

_metrics(
    "sprint_capacity",
    f"""
    SELECT {r("(SELECT sum(TotaalUren) FROM \"FeitSprintCapaciteit\")", "Capaciteit")},
           {r("sum(StoryPoints) / (SELECT sum(TotaalUren) FROM \"FeitSprintCapaciteit\")", "To do / capaciteit")},
           max("sprint.name") AS "Huidige_Sprint" FROM "FeitSprintDetails"
    """,
    shapes.sprint, catalogue.sprint, ["Capaciteit", "To do / capaciteit", "Huidige Sprint"],
)

# --- older operational model ----------------------------------------------------------------------
_OLD_HOURS = {
    "Geboekte uren": "h", "Geboekte uren (facturabel)": "f", "Aantal dagen": "h / 8", "Aantal dagen declarabel": "f / 8",
    "Indirect": "h - coalesce(f, 0)", "Waarde geboekte uren": "w", "Factuurwaarde uren": "w", "Uren gefactureerd": "i",
    "Uren niet gefactureerd": "o", "% uren gefactureerd": "i / h", "% Uren niet gefactureerd": "o / h",
    "Geplande uren per week": "p", "Geplande dagen per week": "p / 8", "Geplande uren per week (decl)": "pd",
    "Geplande dagen per week (decl)": "pd / 8", "Actual": "f / 8", "Forecast": "pd / 8",
    "New Forecast": "(fa + pb) / 8", "Factuurbedrag Invoices": "inv", "Begroting": "bud",
}
_metrics(
    "timesheets_and_planning_by_year",
    f"""
    WITH t AS (SELECT year(Krow__Date__c) AS Jaar, sum(Krow__Hours__c) AS h, {_sum("Krow__Billable__c", "Krow__Hours__c")} AS f,
                      sum(Krow__Bill_Amount__c) AS w, {_sum("Krow__Invoiced__c", "Krow__Hours__c")} AS i, {_sum("NOT Krow__Invoiced__c", "Krow__Hours__c")} AS o,
                      coalesce({_sum("Krow__Billable__c AND weekofyear(Krow__Date__c) < 25", "Krow__Hours__c")}, 0) AS fa
               FROM "Timesheet Split" GROUP BY 1),
    s AS (SELECT year(Krow__Start_Date__c) AS Jaar, sum(Krow__Total_Week_Project_Schedule_Hours__c) AS p,
                 {_sum("k.Krow__Billable__c", "Krow__Total_Week_Project_Schedule_Hours__c")} AS pd,
                 coalesce({_sum("k.Krow__Billable__c AND weekofyear(Krow__Start_Date__c) >= 25", "Krow__Total_Week_Project_Schedule_Hours__c")}, 0) AS pb
          FROM "Project Assignment Schedule" x LEFT JOIN "Project Assignment" a ON a.Id = x.Krow__Project_Assignment__c
          LEFT JOIN "Klient Project" k ON k.Id = a.Krow__Krow_Project__c GROUP BY 1),
    v AS (SELECT year(Krow__Invoice_Date__c) AS Jaar, sum(Krow__Invoice_Subtotal__c) AS inv FROM "Invoice" GROUP BY 1),
    b AS (SELECT year(datumweek) AS Jaar, sum(Begroting) AS bud FROM "DoelstellingMedewerker" GROUP BY 1)
    SELECT Jaar, {_cols(r, _OLD_HOURS)} FROM t LEFT JOIN s USING (Jaar) LEFT JOIN v USING (Jaar) LEFT JOIN b USING (Jaar)
    """,
    shapes.operational_old, lambda: operational_old(NOW), list(_OLD_HOURS), by=["DimDatum.Jaar"],
)

_OLD_PROJECT = {
    "Totaal geboekte uren declarabel": "Krow__Billable_Hour_Logged__c", "Totaal geboekte uren": "Krow__Total_Hours_Logged__c",
    "Totaal gefactureerd bedrag": "Krow__Invoiced_Amount__c", "Totaal geplande uren": "Krow__Scheduled_Hours__c",
    "Projectruimte (uren)": "Krow__Hours_Remaining_Logged__c", "Totaal facturabel bedrag": "Krow__Billable_Amount_Logged__c",
}
_metrics(
    "project_amounts_by_status",
    f"""
    SELECT Krow__Project_Status__c, {_cols(r, {k: f"sum({v})" for k, v in _OLD_PROJECT.items()})},
           {r("sum(Krow__Billable_Amount_Logged__c) - sum(Krow__Invoiced_Amount__c)", "Nog te factureren")}
    FROM "Klient Project" GROUP BY 1
    """,
    shapes.operational_old, lambda: operational_old(NOW), [*_OLD_PROJECT, "Nog te factureren"],
    by=["Klient Project.Krow__Project_Status__c"],
)

_metrics(
    "task_hours_by_type",
    f"""
    SELECT Krow__Type__c, {_cols(r, {
        "Geschatte Uren (variant 2)": "sum(Krow__Estimated_Hours__c)", "Geboekte uren declarabel": "sum(Krow__Billable_Hours__c)",
        "Urenschatting vs realisatie": "sum(Krow__Estimated_Hours__c) - sum(Krow__Billable_Hours__c)",
        "Geboekte uren per taak": "sum(Krow__Total_Hours_Logged__c)",
    })} FROM "Klient Task" GROUP BY 1
    """,
    shapes.operational_old, lambda: operational_old(NOW),
    ["Geschatte Uren (variant 2)", "Geboekte uren declarabel", "Urenschatting vs realisatie", "Geboekte uren per taak"],
    by=["Klient Task.Krow__Type__c"],
)

_YTD = "BETWEEN DATE '1998-01-01' AND DATE '1998-06-15'"
_metrics(
    "budget_in_days_to_date",
    f"""
    WITH x AS (SELECT
        (SELECT sum(Begroting) FROM "DoelstellingMedewerker" WHERE CAST(datumweek AS DATE) {_YTD}) AS b,
        (SELECT sum(Krow__Hours__c) FROM "Timesheet Split" WHERE Krow__Billable__c AND CAST(Krow__Date__c AS DATE) {_YTD}) / 8 AS a,
        (SELECT sum(Krow__Hours__c) FROM "Timesheet Split" WHERE Krow__Billable__c AND weekofyear(Krow__Date__c) < 25 AND CAST(Krow__Date__c AS DATE) {_YTD}) / 8 AS a2,
        (SELECT sum(Krow__Total_Week_Project_Schedule_Hours__c) FROM "Project Assignment Schedule" s
           JOIN "Klient Project" k ON k.Id = s.Krow__Project_Assignment__c
           WHERE k.Krow__Billable__c AND weekofyear(Krow__Start_Date__c) >= 25 AND CAST(Krow__Start_Date__c AS DATE) {_YTD}) / 8 AS f)
    SELECT {_cols(r, {"Begroting YTD": "b", "Actual YTD": "a", "Forecast YTD": "coalesce(a2, 0) + coalesce(f, 0)", "Actual - Begroting (YTD)": "a - b"})} FROM x
    """,
    shapes.operational_old, lambda: operational_old(NOW),
    ["Begroting YTD", "Actual YTD", "Forecast YTD", "Actual - Begroting (YTD)"],
)
