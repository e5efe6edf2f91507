"""The business models: which tables look up which, and through which columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallygrid.plans.model import Model, Relationship, split_ref

# --- fixed values -------------------------------------------------------------
# fact column > dimension column; a trailing word marks the kind of relationship:
# "role" = only used when a metric asks for it, "both" = filters flow both ways,
# "semi" = fact to fact, restricts without adding rows.
OPERATIONAL_LINKS = """
FeitFactuurregels.MedewerkerKey > DimMedewerkers.MedewerkerKey
FeitFactuurregels.FactuurDatum > DimDatum.Datum
FeitFactuurregels.ProjectKey > DimProjecten.ProjectKey
FeitFactuurregels.KlantKey > DimKlanten.KlantKey role
FeitFactuurregels.Taak > DimTaakregels.TaakregelId
FeitFactuurregels.OmzetCategorie > DimOmzetCategorie.OmzetCategorie
FeitFacturen.ProjectKey > DimProjecten.ProjectKey
FeitFacturen.PracticeKey > DimPractice.PracticeKey
FeitFacturen.ProjectTeamKey > DimTeam.TeamKey
FeitFacturen.Factuurdatum > DimDatum.Datum
FeitFacturen.OmzetCategorie > DimOmzetCategorie.OmzetCategorie
FeitFormatieBezetting.Datum_in_dienst > DimDatum.Datum role
FeitFormatieBezetting.Datum_uit_dienst > DimDatum.Datum role
FeitGeplandeUren.MedewerkerKey > DimMedewerkers.MedewerkerKey
FeitGeplandeUren.ProjectKey > DimProjecten.ProjectKey
FeitGeplandeUren.Datum > DimDatum.Datum
FeitGeplandeUren.PracticeKey > DimPractice.PracticeKey
FeitGeschrevenUren.Datum > DimDatum.Datum
FeitGeschrevenUren.MedewerkerKey > DimMedewerkers.MedewerkerKey
FeitGeschrevenUren.ProjectKey > DimProjecten.ProjectKey
FeitGeschrevenUren.TaakregelKey > DimTaakregels.TaakregelKey
FeitGeschrevenUren.Verloftype > DimVerloftype.VerlofType
FeitGeschrevenUren.OmzetCategorie > DimOmzetCategorie.OmzetCategorie
FeitGeschrevenUren.PracticeKey > DimPractice.PracticeKey
FeitInUitStroom.DatumInstroom > DimDatum.Datum role
FeitInUitStroom.DatumUitstroom > DimDatum.Datum role
FeitInUitStroom.MedewerkerKey > DimMedewerkers.MedewerkerKey
FeitMedewerkerSkills.CertificationDate > DimDatum.Datum
FeitMedewerkerSkills.MedewerkerKey > DimMedewerkers.MedewerkerKey
FeitMedewerkerSkills.SkillKey > DimSkills.SkillKey
FeitRoosterUren.MedewerkerKey > DimMedewerkers.MedewerkerKey
FeitRoosterUren.Datum > DimDatum.Datum
FeitRoosterUren.PracticeKey > DimPractice.PracticeKey
FeitRoosterUren.Medewerker > FeitFormatieBezetting.Medewerker semi
FeitVerlofAanvragen.MedewerkerKey > DimMedewerkers.MedewerkerKey
FeitVerlofAanvragen.Datum > DimDatum.Datum
FeitVerlofAanvragen.DatumVerlof > DimDatum.Datum role
FeitVerlofAanvragen.Type_verlof_code > DimVerloftype.VerlofCode
FeitVerlofAanvragen.Naam > FeitFormatieBezetting.Naam semi
FeitVerlofSaldo.Boekjaar > DimDatum.Datum
FeitVerlofSaldo.MedewerkerKey > DimMedewerkers.MedewerkerKey
FeitVerlofSaldo.VerlofTypeKey > DimVerloftype.VerloftypeKey
FeitBudgetten.PracticeKey > DimPractice.PracticeKey
FeitBudgetten.TeamKey > DimTeam.TeamKey
FeitBudgetten.MonthDateKey > DimDatum.DatumKey
FeitTevredenheid.DatumKey > DimDatum.DatumKey
FeitTevredenheid.PracticeKey > DimPractice.PracticeKey
FeitTevredenheid.ProjectKey > DimProjecten.ProjectKey both
FeitTevredenheid.KlantKey > DimKlanten.KlantKey role
FeitTevredenheid.TeamKey > DimTeam.TeamKey
FixedFee.Krow__Date__c > DimDatum.Datum
FixedFee.Krow__Klient_Project__c > DimProjecten.ProjectId
DimProjecten.DatumAfgerond > DimDatum.Datum role
DimProjecten.Startdatum > DimDatum.Datum role
DimProjecten.KlantKey > DimKlanten.KlantKey
DimProjecten.PracticeKey > DimPractice.PracticeKey role
DimProjecten.TeamKey > DimTeam.TeamKey role
DimTaakregels.ProjectKey > DimProjecten.ProjectKey role
DimMedewerkers.DatumInDienst > DimDatum.Datum role
DimMedewerkers.DatumUitDienst > DimDatum.Datum role
DimMedewerkers.TeamKey > DimTeam.TeamKey
"""
CONTRACT_LINKS = """
niet_factureerbare_uren.Debiteurnummer > KlantDim.Debiteurnummer
niet_factureerbare_uren.Krow__Date__c > dim_datum.Datum
contract_opbrengsten.Debiteurnummer > KlantDim.Debiteurnummer both
contract_opbrengsten.Termijn Maand Datum > dim_datum.Datum
s4_inf billable_uren.Datum > dim_datum.Datum
s4_inf billable_uren.Debiteurnummer > KlantDim.Debiteurnummer
s4_inf gefactureerde_uren.Datum > dim_datum.Datum
s4_inf gefactureerde_uren.Debiteurnummer > KlantDim.Debiteurnummer
cost_view_exported.Debiteurnummer > KlantDim.Debiteurnummer
cost_view_exported.date > dim_datum.Datum
"""
SPRINT_LINKS = """
FeitSprintCapaciteit.MedewerkerKey > DimMedewerkers.MedewerkerKey
FeitSprintCapaciteit.SprintNaam > DimSprint.NaamZonderSprint
FeitSprintDetails.assignee.displayName > DimMedewerkers.Medewerker
FeitSprintDetails.status.name > DimStatus.Status
FeitSprintDetails.project.key > DimProjecten.Column1.key
"""
SPRINT_OLD_LINKS = """
FeitSprintCapaciteit.MedewerkerKey > DimMedewerkers.MedewerkerKey
FeitSprintCapaciteit.StartDatum > DimDatum.Datum
FeitSprintCapaciteit.SprintNaam > DimSprint.SprintName
FeitSprintDetails.sprint.self > DimSprint.values.self
FeitSprintDetails.fields.assignee.displayName > DimMedewerkers.Medewerker
FeitSprintDetails.fields.project.name > DimProjecten.Project
FeitSprintDetails.fields.status.name > DimStatus.Status
"""
OPERATIONAL_OLD_LINKS = """
Klient Task.Krow__Project__c > Klient Project.Id
Timesheet Split.Krow__Krow_Task__c > Klient Task.Id
Timesheet Split.Krow__Project_Resource__c > Medewerkers.Id
Timesheet Split.Krow__Date__c > DimDatum.Datum
Invoice.Krow__Project__c > Klient Project.Id
Invoice.Krow__Invoice_Date__c > DimDatum.Datum
Invoice Line Item.Krow__Invoice__c > Invoice.Id
Invoice Line Item.Krow__Project_Resource__c > Medewerkers.Id
Medewerkers.Krow__Team__c > Team.Id
Project Assignment.Krow__Krow_Project__c > Klient Project.Id
Project Assignment.Krow__Project_Resource__c > Medewerkers.Id
Project Assignment Schedule.Krow__Project_Assignment__c > Project Assignment.Id
Project Assignment Schedule.Krow__Start_Date__c > DimDatum.Datum
DoelstellingMedewerker.medewerker > Medewerkers.Name
DoelstellingMedewerker.datumweek > DimDatum.Datum
"""
# ------------------------------------------------------------------------------


def parse_links(text: str) -> tuple[Relationship, ...]:
    found = []
    for line in filter(None, map(str.strip, text.splitlines())):
        source, target = (part.strip() for part in line.split(" > "))
        kind = ""
        for word in ("role", "both", "semi"):
            if target.endswith(f" {word}"):
                target, kind = target[: -len(word) - 1], word
        found.append(Relationship(source, target, kind != "role", kind == "both", kind == "semi"))
    return tuple(found)


@dataclass(frozen=True)
class Definition:
    """A model without data: bind it to tables to evaluate metrics."""

    relationships: tuple[Relationship, ...]
    date_tables: frozenset[str]

    def tables(self) -> list[str]:
        refs = [r for link in self.relationships for r in link.pair]
        return sorted({split_ref(r)[0] for r in refs})

    def with_loaders(self, loaders: dict[str, Callable[[], DataFrame]]) -> Model:
        return Model(loaders, self.relationships, self.date_tables)

    def on_catalog(self, spark: SparkSession, schema: str, names: dict[str, str] | None = None) -> Model:
        """Bind to the tables of a catalog schema; ``names`` gives those stored under another name."""
        stored = names or {}
        return self.with_loaders(
            {t: lambda t=t: spark.table(f"`{schema}`.`{stored.get(t, t)}`") for t in self.tables()}
        )


_DATES = frozenset({"DimDatum", "DimDatumFilter"})
OPERATIONAL = Definition(parse_links(OPERATIONAL_LINKS), _DATES)
CONTRACTS = Definition(parse_links(CONTRACT_LINKS), frozenset({"dim_datum"}))
SPRINT = Definition(parse_links(SPRINT_LINKS), frozenset())
SPRINT_OLD = Definition(parse_links(SPRINT_OLD_LINKS), _DATES)
OPERATIONAL_OLD = Definition(parse_links(OPERATIONAL_OLD_LINKS), _DATES)
