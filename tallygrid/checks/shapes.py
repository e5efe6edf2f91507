"""Business tables derived from the driver's tables, for checks and the bench.

Every shape is a projection (at most with a row filter) of one driver table, so
a filter on a business column reaches the parquet scan. The expressions are
plain ANSI SQL that both Spark and the checking database understand, so both
sides start from the same rows; what is checked comes after that.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallygrid.functions.dates import date_table
from tallygrid.operators.aggregates import derive_dim
from tallygrid.operators.columns import quoted
from tallygrid.plans import models
from tallygrid.plans.model import Model

AS_OF = dt.date(1998, 6, 15)  # orders-like tables
COST_AS_OF = dt.date(2024, 1, 20)  # events
FIRST_DAY, LAST_DAY = dt.date(1995, 1, 1), dt.date(2002, 12, 31)
CONTRACT_LAST_DAY = dt.date(2024, 12, 31)

_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'Complete' WHEN 'O' THEN 'Not Started' ELSE 'In Progress' END"
_PRACTICE = "CAST(substring(o_orderpriority, 1, 1) AS INT) - 1"
_TASK = (
    "CASE p_type WHEN 'ECONOMY' THEN 'Verlof' WHEN 'LARGE' THEN 'Ziekte / Kort Verzuim' "
    "WHEN 'PROMO' THEN 'Acquisitie/representatie' WHEN 'SMALL' THEN 'Studie' "
    "WHEN 'STANDARD' THEN 'Parttime' ELSE 'Advies' END"
)
_HIRED = "DATE '1994-01-01' + CAST(floor(abs(s_acctbal) / 4) AS INT)"
_LEFT = f"CASE WHEN s_nationkey >= 15 THEN {_HIRED} + 700 END"
_UNIT = (
    "CASE event_type WHEN 'click' THEN 'BI' WHEN 'view' THEN 'Business Intelligence' "
    "WHEN 'error' THEN 'IT' WHEN 'purchase' THEN 'Applicatie-ontwikkeling' ELSE 'onbekend' END"
)
_NET = "l_extendedprice * (1 - l_discount)"
_ROLE_STATUS = "CASE role WHEN 'user' THEN 'Nog Doen' WHEN 'assistant' THEN 'Gereed' ELSE 'In Test' END"

# table: (driver table, row filter, columns)
SHAPES: dict[str, tuple[str, str | None, dict[str, str]]] = {
    # --- operational model: dimensions
    "DimKlanten": ("customer", None, {
        "KlantKey": "c_custkey", "KlantID": "'C' || CAST(c_custkey AS STRING)", "KlantNaam": "c_name",
        "KlantType": "CASE c_mktsegment WHEN 'BUILDING' THEN 'Customer' WHEN 'FURNITURE' THEN 'Customer - Indirect' ELSE 'Prospect' END",
        "Debiteurnummer": "CAST(c_custkey AS STRING)", "Branche": "c_mktsegment",
    }),
    "DimPractice": ("region", None, {"PracticeKey": "r_regionkey", "PracticeNaam": "r_name"}),
    "DimTeam": ("nation", None, {"TeamKey": "n_nationkey", "Team": "n_name", "PracticeKey": "n_regionkey"}),
    "DimMedewerkers": ("supplier", None, {
        "MedewerkerKey": "s_suppkey", "TeamKey": "s_nationkey", "MedewerkerId": "'M' || CAST(s_suppkey AS STRING)",
        "MedewerkerCode": "CASE WHEN s_acctbal > 0 THEN 'K' || CAST(s_suppkey AS STRING) END", "Medewerker": "s_name",
        "IsExterneMedewerker": "CASE WHEN s_acctbal < 2000 THEN 1 WHEN s_acctbal >= 4000 THEN 0 END",
        "Uurtarief": "s_acctbal", "DatumInDienst": _HIRED, "DatumUitDienst": _LEFT,
        "AantalUren": "CAST(40 - s_nationkey AS DOUBLE)",
    }),
    "DimProjecten": ("orders", None, {
        "ProjectKey": "o_orderkey", "ProjectId": "'P' || CAST(o_orderkey AS STRING)", "ProjectStatus": _STATUS,
        "Startdatum": "o_orderdate", "DatumAfgerond": "CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 90 END",
        "KlantKey": "o_custkey", "PracticeKey": _PRACTICE, "TeamKey": _PRACTICE,
        "IsFacturabel": "o_totalprice > 100000", "InternExtern": "CASE WHEN o_orderpriority = '5-LOW' THEN 'Intern' ELSE 'Extern' END",
        "GeschatteUren": "o_totalprice * 0.01", "AantalUren": "o_totalprice * 0.02", "VerwachteOmzet": "o_totalprice",
        "FacturabeleOmzet": "o_totalprice * 0.9", "GeschatteUrenOverlogd": "o_totalprice * 0.01",
        "Tevredenheidsscore": "CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice / 50000) AS DOUBLE) END",
        "OpTijdAfgerond": "CASE WHEN o_orderstatus = 'F' AND o_totalprice < 200000 THEN 1 ELSE 0 END",
        "BusinessType": "o_orderpriority",
    }),
    "DimTaakregels": ("part", None, {
        "TaakregelKey": "p_partkey", "TaakregelId": "'T' || CAST(p_partkey AS STRING)", "TaakNaam": _TASK,
        "TotaalGeschrevenUren": "p_retailprice", "ProjectKey": "p_partkey", "TaakType": "p_brand",
    }),
    # --- operational model: facts
    "FeitGeschrevenUren": ("lineitem", None, {
        "Datum": "l_shipdate", "AantalUren": "l_quantity",
        "FacturabeleUren": "CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0 END",
        "NietFacturabeleUren": "CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END",
        "IsFacturabel": "l_returnflag <> 'R'", "IsGefactureerd": "l_linestatus = 'F'",
        "GoedkeuringsStatus": "CASE WHEN l_linestatus = 'F' THEN 'Approved' ELSE 'Submitted' END",
        "Verloftype": "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'Regulier verlof' WHEN l_returnflag = 'R' THEN 'Bijzonder verlof' END",
        "ProjectKey": "CASE WHEN l_tax < 0.075 THEN l_orderkey END", "MedewerkerKey": "l_suppkey",
        "TaakregelKey": "CASE WHEN l_discount < 0.095 THEN l_partkey END",
        "KostprijsTarief": "l_extendedprice * 0.6", "OmzetPotentie": "l_extendedprice",
        "PracticeKey": "l_linenumber - 1", "OmzetCategorie": "l_returnflag",
    }),
    "FeitFactuurregels": ("lineitem", None, {
        "FactuurDatum": "l_shipdate", "BedragExclBTW": _NET, "BedragBTW": "l_extendedprice * l_tax",
        "BedragInclBTW": f"{_NET} + l_extendedprice * l_tax", "UurTarief": "l_extendedprice * 0.01",
        "KostenBedrag": "l_extendedprice * 0.6", "UrenGefactureerd": "l_quantity",
        "MedewerkerKey": "l_suppkey", "ProjectKey": "l_orderkey", "Taak": "'T' || CAST(l_partkey AS STRING)",
        "OmzetCategorie": "l_returnflag", "Include": "l_linestatus = 'F'",
    }),
    "FeitFacturen": ("orders", None, {
        "Factuurdatum": "o_orderdate", "Subtotaal": "o_totalprice",
        "InvoiceAmount": "CASE WHEN o_orderstatus = 'O' THEN 0 ELSE o_totalprice END",
        "ProjectKey": "o_orderkey", "KlantKey": "o_custkey", "PracticeKey": _PRACTICE, "ProjectTeamKey": _PRACTICE,
        "OmzetCategorie": "o_orderstatus", "Status": _STATUS,
    }),
    "FeitGeplandeUren": ("lineitem", None, {
        "Datum": "l_shipdate", "GeplandeUren": "l_quantity * 0.5", "UrenTotaal": "l_quantity",
        "Status": "CASE WHEN l_linestatus = 'F' THEN 'Hard' ELSE 'Soft' END", "MedewerkerKey": "l_suppkey",
        "ProjectKey": "l_orderkey", "PracticeKey": "l_linenumber - 1",
    }),
    "FeitRoosterUren": ("lineitem", None, {
        "Datum": "l_shipdate", "UrenPerDag": "l_quantity * 1.5", "Aantal_uren_per_week": "l_quantity * 2",
        "MedewerkerKey": "l_suppkey", "PracticeKey": "l_linenumber - 1",
        "Medewerker": "'Supplier#' || lpad(CAST(l_suppkey AS STRING), 9, '0')",
    }),
    "FeitVerlofAanvragen": ("lineitem", "l_returnflag = 'R'", {
        "Datum": "l_shipdate", "Aantal_uren": "l_quantity", "MedewerkerKey": "l_suppkey",
        "Type_verlof_code": "'V' || l_linestatus", "FeitVerlofAanvraagKey": "l_orderkey",
        "Naam": "'Supplier#' || lpad(CAST(l_suppkey AS STRING), 9, '0')",
        "Verlofuren": "l_quantity", "DatumVerlof": "l_shipdate", "DatumAangevraagd": "CAST(l_shipdate AS DATE) - CAST(l_quantity AS INT)",
        "VerlofType": "CASE WHEN l_linestatus = 'O' THEN 'Regulier Verlof' ELSE 'Bijzonder Verlof' END",
    }),
    "FeitVerlofSaldo": ("supplier", None, {
        "Boekjaar": "DATE '1998-01-01'", "TotaalEindSaldo": "s_acctbal", "MedewerkerKey": "s_suppkey",
        "VerlofTypeKey": "CASE WHEN s_acctbal < 3000 THEN 1 ELSE 2 END",
    }),
    "FeitFormatieBezetting": ("supplier", None, {
        "FTE": "CAST(CASE WHEN s_acctbal < 3000 THEN 0.5 ELSE 1 END AS DOUBLE)", "Medewerker": "s_name", "Naam": "s_name",
        "Datum_in_dienst": _HIRED, "Datum_uit_dienst": _LEFT, "MedewerkerKey": "s_suppkey", "TeamKey": "s_nationkey",
    }),
    "FeitMedewerkerSkills": ("lineitem", None, {
        "MedewerkerSkillKey": "l_orderkey", "SkillKey": "l_linenumber", "MedewerkerKey": "l_suppkey",
        "CertificationDate": "l_shipdate",
    }),
    "FeitTevredenheid": ("orders", "o_orderstatus = 'F'", {
        "Score": "CAST(floor(o_totalprice / 50000) AS DOUBLE)", "ProjectKey": "o_orderkey", "KlantKey": "o_custkey",
        "PracticeKey": _PRACTICE, "TeamKey": _PRACTICE,
        "DatumKey": "year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)",
    }),
    "FixedFee": ("orders", None, {
        "Krow__Amount__c": "o_totalprice * 0.1", "Krow__Date__c": "o_orderdate",
        "Krow__Klient_Project__c": "'P' || CAST(o_orderkey AS STRING)",
    }),
    # --- service contracts and cloud cost
    "contract_opbrengsten": ("orders", None, {
        "Debiteurnummer": "CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_custkey AS STRING) END",
        "Contact Name": f"'Contract ' || o_orderpriority || ' ' || {_STATUS}",
        "Termijn Maand Datum": "CAST(date_trunc('month', o_orderdate) AS DATE)",
        "Termijn Maand": "lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '-' || CAST(year(o_orderdate) AS STRING)",
        "Total Price": "o_totalprice", "Salesprice": "o_totalprice * 0.9",
    }),
    "s4_inf billable_uren": ("lineitem", "l_returnflag <> 'R'", {
        "Datum": "l_shipdate", "Debiteurnummer": "CAST(l_suppkey AS STRING)", "Billable Hours": "l_quantity",
        "Opbrengsten": "l_extendedprice", "Kosten": "l_extendedprice * 0.6",
    }),
    "s4_inf gefactureerde_uren": ("lineitem", "l_linestatus = 'F'", {
        "Datum": "l_shipdate", "Debiteurnummer": "CAST(l_suppkey AS STRING)",
        "Opbrengsten": "l_extendedprice", "Kosten": "l_extendedprice * 0.6",
    }),
    "niet_factureerbare_uren": ("lineitem", "l_returnflag = 'R'", {
        "Krow__Date__c": "l_shipdate", "Debiteurnummer": "CAST(l_suppkey AS STRING)",
        "Sum of Cost Amount": "l_extendedprice * 0.6",
    }),
    "cost_view_exported": ("events", None, {
        "date": "ts", "costInBillingCurrency": "value", "resourceGroupName": "event_type",
        "Debiteurnummer": "CAST(user_id AS STRING)", "BusinessUnit": _UNIT,
        "SubscriptionId": "'sub-' || event_type", "tags": "props",
    }),
    # --- sprint board
    "FeitSprintDetails": ("conversations", None, {
        "key": "CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING)", "StoryPoints": "CAST(turn + 1 AS DOUBLE)",
        "status.name": _ROLE_STATUS, "project.key": "'PRJ-' || role", "sprint.name": "'Sprint ' || CAST(conv_id AS STRING)",
        "SprintNaam": "CAST(conv_id AS STRING)", "assignee.displayName": "role",
    }),
    "DimProjectenOlder": ("conversations", None, {"Project": "role"}),
    "FeitSprintCapaciteit": ("conversations", None, {
        "SprintNaam": "CAST(conv_id AS STRING)", "TotaalUren": "CAST(8 * (turn + 1) AS DOUBLE)", "MedewerkerKey": "turn",
    }),
    # --- older operational model
    "Timesheet Split": ("lineitem", None, {
        "Krow__Hours__c": "l_quantity", "Krow__Bill_Amount__c": "l_extendedprice", "Krow__Billable__c": "l_returnflag <> 'R'",
        "Krow__Invoiced__c": "l_linestatus = 'F'", "Krow__Date__c": "l_shipdate",
        "Krow__Krow_Task__c": "CAST(l_partkey AS STRING)", "Krow__Project_Resource__c": "CAST(l_suppkey AS STRING)",
    }),
    "Klient Project": ("orders", None, {
        "Id": "CAST(o_orderkey AS STRING)", "Krow__Billable__c": "o_totalprice > 100000",
        "Krow__Billable_Hour_Logged__c": "o_totalprice * 0.01", "Krow__Total_Hours_Logged__c": "o_totalprice * 0.02",
        "Krow__Invoiced_Amount__c": "o_totalprice * 0.8", "Krow__Scheduled_Hours__c": "o_totalprice * 0.03",
        "Krow__Hours_Remaining_Logged__c": "o_totalprice * 0.05", "Krow__Billable_Amount_Logged__c": "o_totalprice",
        "Krow__Project_Status__c": _STATUS,
    }),
    "Klient Task": ("part", None, {
        "Id": "CAST(p_partkey AS STRING)", "Krow__Project__c": "CAST(p_partkey AS STRING)", "Name": "p_name",
        "Krow__Estimated_Hours__c": "p_retailprice", "Krow__Billable_Hours__c": "p_retailprice * 0.5",
        "Krow__Total_Hours_Logged__c": "p_retailprice * 0.7", "Krow__Type__c": "p_type",
    }),
    "Invoice": ("orders", None, {
        "Id": "CAST(o_orderkey AS STRING)", "Krow__Project__c": "CAST(o_orderkey AS STRING)",
        "Krow__Invoice_Subtotal__c": "o_totalprice", "Krow__Invoice_Date__c": "o_orderdate",
    }),
    "Medewerkers": ("supplier", None, {
        "Id": "CAST(s_suppkey AS STRING)", "Name": "s_name", "Krow__Team__c": "CAST(s_nationkey AS STRING)",
    }),
    "Team": ("nation", None, {"Id": "CAST(n_nationkey AS STRING)", "Name": "n_name"}),
    "Project Assignment": ("orders", None, {
        "Id": "CAST(o_orderkey AS STRING)", "Krow__Krow_Project__c": "CAST(o_orderkey AS STRING)",
        "Krow__Project_Resource__c": "CAST(o_custkey AS STRING)",
    }),
    "Project Assignment Schedule": ("lineitem", None, {
        "Krow__Project_Assignment__c": "CAST(l_orderkey AS STRING)", "Krow__Start_Date__c": "l_shipdate",
        "Krow__Total_Week_Project_Schedule_Hours__c": "l_quantity",
    }),
    "DoelstellingMedewerker": ("orders", None, {
        "medewerker": "'Supplier#' || lpad(CAST(o_custkey AS STRING), 9, '0')", "datumweek": "o_orderdate",
        "Begroting": "o_totalprice * 0.01",
    }),
}

# Tables that are not a projection: SQL for the check; the Spark side is below.
_CALENDAR = """
SELECT CAST(d AS DATE) AS Datum, year(d) * 10000 + month(d) * 100 + day(d) AS DatumKey, year(d) AS Jaar,
       month(d) AS MaandNummer, quarter(d) AS KwartaalNummer, year(d) * 100 + month(d) AS JaarMaand,
       weekofyear(d) AS ISOWeekNummer, weekofyear(d) AS WeekNr, year(d) * 100 + weekofyear(d) AS JaarWeek,
       (year(d) * 12 + month(d)) - (1998 * 12 + 6) AS MaandNrRelatief
FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '{last}', INTERVAL 1 DAY) AS g(d)
"""
SQL_TABLES = {
    "DimDatum": _CALENDAR.format(last=LAST_DAY),
    "dim_datum": _CALENDAR.format(last=CONTRACT_LAST_DAY),
    "DimVerloftype": "SELECT * FROM (VALUES (1, 'VO', 'Regulier verlof'), (2, 'VF', 'Bijzonder verlof')) t(VerloftypeKey, VerlofCode, VerlofType)",
    "FeitBudgetten": f"""
        SELECT {_PRACTICE} AS TeamKey, {_PRACTICE} AS PracticeKey, year(o_orderdate) AS Jaar,
               year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 1 AS MonthDateKey,
               CAST(count(*) AS DOUBLE) AS FTE, sum(o_totalprice) * 0.5 AS FTE_x_MonthGoal,
               sum(o_totalprice) * 0.01 AS InternPerDag_FTE, sum(o_totalprice) * 0.4 AS Intern,
               sum(o_totalprice) * 0.02 AS JaardoelPerDag_FTE
        FROM orders GROUP BY ALL""",
    "KlantDim": """SELECT "Debiteurnummer", max("Contact Name") AS "Contact Name" FROM "contract_opbrengsten"
                   WHERE "Debiteurnummer" IS NOT NULL GROUP BY 1""",
    "DimStatus": "SELECT DISTINCT \"status.name\" AS Status FROM \"FeitSprintDetails\"",
    "DimSprint": """SELECT DISTINCT "sprint.name" AS SprintName, "SprintNaam" AS NaamZonderSprint
                    FROM "FeitSprintDetails" """,
    "DimProjectenSprint": "SELECT DISTINCT \"project.key\" AS \"Column1.key\" FROM \"FeitSprintDetails\"",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shape(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One business table as a DataFrame."""
    if name in SHAPES:
        source, where, columns = SHAPES[name]
        df = read(spark, sf_dir, source)
        df = df.filter(where) if where else df
        return df.select(*[F.expr(e).alias(c) for c, e in columns.items()])
    if name == "DimDatum":
        days = date_table(spark, FIRST_DAY, LAST_DAY, AS_OF)
        return days.withColumn("WeekNr", F.col("ISOWeekNummer"))
    if name == "dim_datum":
        return date_table(spark, FIRST_DAY, CONTRACT_LAST_DAY, AS_OF)
    if name == "DimVerloftype":
        return spark.createDataFrame(
            [(1, "VO", "Regulier verlof"), (2, "VF", "Bijzonder verlof")],
            "VerloftypeKey int, VerlofCode string, VerlofType string",
        )
    if name == "FeitBudgetten":
        amount = F.sum("o_totalprice")
        month = F.expr("year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 1")
        return (
            read(spark, sf_dir, "orders")
            .groupBy(F.expr(_PRACTICE).alias("TeamKey"), month.cast("long").alias("MonthDateKey"))
            .agg(
                F.count(F.lit(1)).cast("double").alias("FTE"), (amount * 0.5).alias("FTE_x_MonthGoal"),
                (amount * 0.01).alias("InternPerDag_FTE"), (amount * 0.4).alias("Intern"),
                (amount * 0.02).alias("JaardoelPerDag_FTE"),
            )
            .withColumns({"PracticeKey": F.col("TeamKey"), "Jaar": F.floor(F.col("MonthDateKey") / 10000).cast("long")})
        )
    if name == "KlantDim":
        return derive_dim(shape(spark, sf_dir, "contract_opbrengsten"), "Debiteurnummer", ["Contact Name"])
    if name == "DimStatus":
        return shape(spark, sf_dir, "FeitSprintDetails").select(quoted("status.name").alias("Status")).distinct()
    if name == "DimSprint":
        issues = shape(spark, sf_dir, "FeitSprintDetails")
        return issues.select(
            quoted("sprint.name").alias("SprintName"), F.col("SprintNaam").alias("NaamZonderSprint")
        ).distinct()
    if name == "DimProjectenSprint":
        issues = shape(spark, sf_dir, "FeitSprintDetails")
        return issues.select(quoted("project.key").alias("Column1.key")).distinct()
    raise KeyError(name)


def _model(spark: SparkSession, sf_dir: str, definition: models.Definition, renamed: dict[str, str] | None = None) -> Model:
    renamed = renamed or {}

    def loader(table: str):
        return lambda: shape(spark, sf_dir, renamed.get(table, table))

    known = set(SHAPES) | set(SQL_TABLES)
    return definition.with_loaders({t: loader(t) for t in definition.tables() if renamed.get(t, t) in known})


def operational(spark: SparkSession, sf_dir: str) -> Model:
    return _model(spark, sf_dir, models.OPERATIONAL)


def contracts(spark: SparkSession, sf_dir: str) -> Model:
    return _model(spark, sf_dir, models.CONTRACTS)


def sprint(spark: SparkSession, sf_dir: str) -> Model:
    return _model(spark, sf_dir, models.SPRINT, {"DimProjecten": "DimProjectenSprint"})


def sprint_older(spark: SparkSession, sf_dir: str) -> Model:
    return _model(spark, sf_dir, models.SPRINT_OLD, {"DimProjecten": "DimProjectenOlder"})


def operational_old(spark: SparkSession, sf_dir: str) -> Model:
    return _model(spark, sf_dir, models.OPERATIONAL_OLD)


def shape_sql(name: str) -> str:
    if name in SQL_TABLES:
        return SQL_TABLES[name]
    source, where, columns = SHAPES[name]
    text = ", ".join(f'{e} AS "{c}"' for c, e in columns.items())
    return f"SELECT {text} FROM {source}" + (f" WHERE {where}" if where else "")


def with_shapes(sql: str) -> str:
    """Prefix a check query with the business tables it mentions in quotes."""
    parts: dict[str, str] = {}

    def need(text: str) -> None:
        for name in re.findall(r'"([^"]+)"', text):
            if name not in parts and (name in SHAPES or name in SQL_TABLES):
                body = shape_sql(name)
                if name in SQL_TABLES:
                    need(body)
                parts[name] = body

    need(sql)
    if not parts:
        return sql
    ctes = ",\n".join(f'"{n}" AS ({b})' for n, b in parts.items())
    return f"WITH {ctes},\n{sql.lstrip()[5:]}" if sql.lstrip().upper().startswith("WITH ") else f"WITH {ctes}\n{sql}"
