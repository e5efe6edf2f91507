"""Operators over the driver's tables: columns, filters, joins, aggregates, windows, dates, text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallygrid.checks import shapes
from tallygrid.checks.registry import query, rounded
from tallygrid.checks.shapes import AS_OF, COST_AS_OF, read, shape
from tallygrid.functions import blank, dates, text
from tallygrid.operators import aggregates as ag
from tallygrid.operators import columns as co
from tallygrid.operators import filters as fi
from tallygrid.operators import joins as jo
from tallygrid.operators import nested as ne
from tallygrid.operators import numbering as nu
from tallygrid.operators import sets as se
from tallygrid.operators import windows as wi
from tallygrid.plans import metric as m
from tallygrid.plans import period as t
from tallygrid.plans.catalogue import operations as ops
from tallygrid.plans.catalogue.sprint import sprint_old
from tallygrid.plans.cumulative import evaluate_ytd
from tallygrid.session import scratch_path
from tallygrid.plans.evaluate import evaluate
from tallygrid.plans.period import Period
from tallygrid.sources.readers import literal_table

NOW = Period(AS_OF)

# --- the flagship -------------------------------------------------------------------


@query(
    "margin_by_segment_last_12_months",
    """
    WITH l AS (SELECT k.Branche, CAST(f.FactuurDatum AS DATE) AS dag, f.BedragExclBTW AS net, f.KostenBedrag AS cost
               FROM "FeitFactuurregels" f LEFT JOIN "DimProjecten" o ON o.ProjectKey = f.ProjectKey
               LEFT JOIN "DimKlanten" k ON k.KlantKey = o.KlantKey),
    x AS (SELECT Branche,
                 sum(net) FILTER (WHERE dag BETWEEN DATE '1997-07-01' AND DATE '1998-06-30') AS net,
                 sum(cost) FILTER (WHERE dag BETWEEN DATE '1997-07-01' AND DATE '1998-06-30') AS cost,
                 sum(net) FILTER (WHERE dag BETWEEN DATE '1996-07-01' AND DATE '1997-06-30') AS net1,
                 sum(cost) FILTER (WHERE dag BETWEEN DATE '1996-07-01' AND DATE '1997-06-30') AS cost1
          FROM l GROUP BY 1)
    SELECT Branche, round(net, 4) AS revenue, round(cost, 4) AS cost, round(net - cost, 4) AS margin,
           round((net - cost) / net, 4) AS margin_share, round(net1, 4) AS revenue_before,
           round((net1 - cost1) / net1, 4) AS margin_share_before, round((net - net1) / net1 * 100, 4) AS revenue_change
    FROM x
    """,
)
def margin_by_segment(spark, sf_dir):
    net, cost = m.sum_("FeitFactuurregels.BedragExclBTW"), m.sum_("FeitFactuurregels.KostenBedrag")
    share = m.derived(blank.margin_share, net, cost)
    now, before = t.last_12m(net, NOW), t.previous_12m(net, NOW)
    metrics = {
        "revenue": now, "cost": t.last_12m(cost, NOW), "margin": t.last_12m(m.minus(net, cost), NOW),
        "margin_share": t.last_12m(share, NOW), "revenue_before": before,
        "margin_share_before": t.previous_12m(share, NOW), "revenue_change": m.derived(blank.pct_change, now, before),
    }
    model = shapes.operational(spark, sf_dir)
    return rounded(evaluate(model, metrics, by=["DimKlanten.Branche"], sort=[("revenue", False)]))


# --- columns ------------------------------------------------------------------------


@query(
    "columns_renamed_and_safe",
    "SELECT l_shipdate AS ship_date_, l_orderkey AS order_key, l_quantity AS quantity_hours, l_tax AS quantity_hour "
    "FROM lineitem",
)
def columns_safe(spark, sf_dir):
    raw = co.rename(
        co.select_columns(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_quantity", "l_tax", "l_shipdate", "l_discount"]),
        {
            "l_orderkey": "order  key", "l_quantity": "quantity (hours", "l_tax": "quantity-hours",
            "l_shipdate": "ship date!", "l_discount": "hidden_link discount",
        },
    )
    kept = co.drop_columns(co.safe_names(raw, unique=True), "hidden_link")
    return co.reorder(kept, ["ship_date_"])


@query(
    "columns_cast_with_blanks",
    """
    SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS prio,
           TRY_CAST(o_orderpriority AS INTEGER) AS whole, CAST(o_orderdate AS DATE) AS day,
           'board' AS label, CAST(NULL AS VARCHAR) AS DirectIndirect
    FROM orders
    """,
)
def columns_cast(spark, sf_dir):
    df = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("prio"),
        F.col("o_orderpriority").alias("whole"), F.col("o_orderdate").alias("day"),
    )
    typed = co.cast_columns(df, {"prio": "int", "whole": "int", "day": "date"})
    return co.with_nulls(co.with_const(typed, "label", "board"), {"DirectIndirect": "string"})


_CODE = "CASE WHEN o_orderpriority IN ('5-LOW', '3-MEDIUM') THEN substring(o_orderpriority, 1, 1) ELSE o_orderpriority END"


@query(
    "type_mismatches",
    f"""
    SELECT row_number() OVER (ORDER BY o_orderkey) AS "Row Number", o_orderkey, {_CODE} AS code FROM orders
    QUALIFY TRY_CAST({_CODE} AS INTEGER) IS NULL
    """,
)
def type_mismatches(spark, sf_dir):
    df = read(spark, sf_dir, "orders").select("o_orderkey", F.expr(_CODE).alias("code"))
    return co.type_errors(df, {"code": "int"}, ["o_orderkey"])


@query(
    "names_made_safe",
    f"""
    SELECT o_orderkey AS "Order_Key", o_totalprice AS "_Total_Price_EUR_", o_orderstatus AS "__status__", o_orderpriority AS "{'x' * 120}" FROM orders
    """,
)
def names_made_safe(spark, sf_dir):
    """Blanks at the edges go, runs of other characters become one underscore, long names are cut."""
    names = {"o_orderkey": "Order - Key", "o_totalprice": " (Total Price, EUR) ", "o_orderstatus": "__status__", "o_orderpriority": "x" * 150}
    return co.safe_names(co.rename(read(spark, sf_dir, "orders").select(*names), names))


@query("rows_numbered", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS \"Index\" FROM events")
def rows_numbered(spark, sf_dir):
    return nu.with_index(read(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"]).drop("ts")


# --- nested -------------------------------------------------------------------------


_TAGS = (
    "'{\"Debiteurnummer\": \"' || user_id || '\", \"Business Unit\": \"' || event_type || '\", "
    "\"hidden-link: x\": \"1\"' || CASE WHEN event_type = 'error' THEN ', \"Severity\": \"' || event_id || '\"' ELSE '' END || '}'"
)


@query(
    "tags_widened",
    """
    SELECT event_id, CAST(user_id AS VARCHAR) AS Debiteurnummer, event_type AS Business_Unit,
           CASE WHEN event_type = 'error' THEN CAST(event_id AS VARCHAR) END AS Severity
    FROM events
    """,
)
def tags_widened(spark, sf_dir):
    raw = read(spark, sf_dir, "events").select("event_id", F.expr(_TAGS).alias("tags"))
    return ne.widen_map(ne.parse_tags(raw, "tags"), "tags").drop("tags")


_OPEN_TAGS = (
    "'{\"Debiteurnummer\": \"' || user_id || '\", \"Business Unit\": \"' || event_type || '\", \"meter ' || event_id || '\": \"' || event_type || '\"}'"
)


@query(
    "tags_open_ended",
    """
    SELECT event_id, CAST(user_id AS VARCHAR) AS Debiteurnummer, event_type AS Business_Unit, 'meter ' || event_id AS key, event_type AS value
    FROM events
    """,
)
def tags_open_ended(spark, sf_dir):
    """As many keys as rows: those that most rows hold become columns, the others rows of a long table."""
    raw = read(spark, sf_dir, "events").select("event_id", F.expr(_OPEN_TAGS).alias("tags"))
    tags = ne.parse_tags(raw, "tags")
    wide, rest = ne.split_map(tags, "tags", ne.update_keys(tags, "tags", scratch_path(spark, "keys"), 0.5), ["event_id"])
    return wide.join(rest, "event_id")


@query(
    "tag_values_by_key",
    """
    SELECT 'k' AS key, count(*) AS rows, min(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS lowest,
           max(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS highest
    FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL
    """,
)
def tag_values(spark, sf_dir):
    tags = ne.parse_tags(read(spark, sf_dir, "events").select("props"), "props")
    pairs = tags.select(F.explode("props").alias("key", "value"))
    number = F.col("value").try_cast("int")
    return pairs.groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"), F.min(number).alias("lowest"), F.max(number).alias("highest")
    )


@query(
    "words_as_list_of_records",
    """
    WITH w AS (SELECT doc_id, lang, unnest(string_split(text, ' ')) AS w FROM documents)
    SELECT lang, count(*) AS rows, sum(CASE WHEN w = '' THEN 1 ELSE 0 END) :: BIGINT AS blanks, sum(length(w)) :: BIGINT AS chars
    FROM w GROUP BY 1
    """,
)
def words_as_records(spark, sf_dir):
    records = F.transform(F.split("text", " ", -1), lambda w: F.struct(w.alias("word"), F.length(w).alias("size")))
    df = read(spark, sf_dir, "documents").select("lang", records.alias("items"))
    rows = ne.expand_record(ne.explode_list(df, "items"), "items", {"word": "word", "size": "size"})
    return rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("rows"), F.sum((F.col("word") == "").cast("long")).alias("blanks"),
        F.sum(F.col("size").cast("long")).alias("chars"),
    )


# --- filters ------------------------------------------------------------------------


@query(
    "filtered_by_lists",
    """
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority NOT IN ('5-LOW') AND NOT (o_custkey IN (1, 2, 3) AND o_orderstatus = 'F')
    """,
)
def filtered_by_lists(spark, sf_dir):
    df = fi.where_in(read(spark, sf_dir, "orders"), "o_orderstatus", ["F", "P"])
    df = fi.where_not_in(df, "o_orderpriority", ["5-LOW"])
    return fi.exclude(df, "o_custkey", [1, 2, 3], F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderpriority")


@query(
    "filtered_by_blank",
    """
    SELECT 'blank' AS kind, count(*) AS rows, round(sum(AantalUren), 4) AS hours FROM "FeitGeschrevenUren" WHERE Verloftype IS NULL
    UNION ALL SELECT 'filled', count(*), round(sum(AantalUren), 4) FROM "FeitGeschrevenUren" WHERE Verloftype IS NOT NULL
    """,
)
def filtered_by_blank(spark, sf_dir):
    hours = shape(spark, sf_dir, "FeitGeschrevenUren").select("Verloftype", "AantalUren")

    def part(kind: str, is_blank: bool):
        chosen = fi.where_blank(hours, "Verloftype", is_blank)
        return chosen.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("rows"), F.sum("AantalUren").alias("hours"))

    return rounded(se.union_all([part("blank", True), part("filled", False)]))


@query(
    "filtered_by_date",
    """
    SELECT 'day' AS kind, count(*) AS rows FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-06-15'
    UNION ALL SELECT 'since', count(*) FROM orders WHERE o_orderdate >= DATE '1998-06-15'
    UNION ALL SELECT 'newer', count(*) FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F')
    UNION ALL SELECT 'year', count(*) FROM orders WHERE year(o_orderdate) = 1998
    UNION ALL SELECT 'month', count(*) FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 6
    """,
)
def filtered_by_date(spark, sf_dir):
    df = read(spark, sf_dir, "orders")
    highest = ag.high_water(df.filter("o_orderstatus = 'F'"), "o_orderdate")
    parts = {
        "day": fi.on_day(df, "o_orderdate", AS_OF), "since": fi.since(df, "o_orderdate", AS_OF),
        "newer": fi.newer_than(df, "o_orderdate", highest), "year": fi.within_period(df, "o_orderdate", "year", AS_OF),
        "month": fi.within_period(df, "o_orderdate", "month", AS_OF),
    }
    return se.union_all([p.agg(F.lit(k).alias("kind"), F.count(F.lit(1)).alias("rows")) for k, p in parts.items()])


@query(
    "live_scored_projects",
    """
    SELECT ProjectId, Tevredenheidsscore FROM "DimProjecten"
    WHERE Tevredenheidsscore IS NOT NULL AND NOT IsFacturabel AND ProjectStatus <> 'Not Started'
    """,
)
def live_scored_projects(spark, sf_dir):
    projects = shape(spark, sf_dir, "DimProjecten")
    live = fi.live_rows(projects, "Tevredenheidsscore", "IsFacturabel")
    return fi.where(live, "ProjectStatus <> 'Not Started'").select("ProjectId", "Tevredenheidsscore")


@query(
    "failed_loads",
    "SELECT o_orderkey AS load, 'Failed' AS \"Status\" FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'",
)
def failed_loads(spark, sf_dir):
    status = "CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'Failed' ELSE 'Succeeded' END"
    control = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("load"), F.expr(status).alias("Status"))
    return fi.failed_loads(control)


# --- joins --------------------------------------------------------------------------


@query(
    "key_lookup_with_orphans",
    """
    SELECT e.PracticeNaam, count(*) AS rows, count(u.ProjectKey) AS with_project
    FROM "FeitGeschrevenUren" u LEFT JOIN "DimPractice" e ON e.PracticeKey = u.PracticeKey GROUP BY 1
    """,
)
def key_lookup(spark, sf_dir):
    hours = shape(spark, sf_dir, "FeitGeschrevenUren").select("PracticeKey", "ProjectKey")
    practices = shape(spark, sf_dir, "DimPractice")
    found = jo.with_dim(hours, practices, "PracticeKey", ["PracticeNaam"])
    return found.groupBy("PracticeNaam").agg(F.count(F.lit(1)).alias("rows"), F.count("ProjectKey").alias("with_project"))


@query(
    "surrogate_key_lookup",
    """
    WITH k AS (SELECT p_name, min(p_partkey) AS key FROM part GROUP BY 1)
    SELECT o.o_orderkey, k.key FROM orders o LEFT JOIN part p ON p.p_partkey = o.o_custkey LEFT JOIN k ON k.p_name = p.p_name
    """,
)
def surrogate_lookup(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    named = jo.lookup(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), part, {"o_custkey": "p_partkey"}, ["p_name"])
    return jo.lookup_keys(named, part.select("p_name", F.col("p_partkey").alias("key")), "p_name", "key").select("o_orderkey", "key")


@query(
    "teams_with_their_practice",
    "SELECT t.Team, p.PracticeNaam, count(e.MedewerkerKey) AS employees FROM \"DimTeam\" t "
    "LEFT JOIN \"DimPractice\" p ON p.PracticeKey = t.PracticeKey "
    "LEFT JOIN \"DimMedewerkers\" e ON e.TeamKey = t.TeamKey GROUP BY ALL",
)
def teams_with_practice(spark, sf_dir):
    teams, people = shape(spark, sf_dir, "DimTeam"), shape(spark, sf_dir, "DimMedewerkers")
    teams = jo.join_expand(teams, shape(spark, sf_dir, "DimPractice"), "PracticeKey", ["PracticeNaam"])
    rows = jo.join_expand(teams, people, "TeamKey", ["MedewerkerKey"])
    return rows.groupBy("Team", "PracticeNaam").agg(F.count("MedewerkerKey").alias("employees"))


@query(
    "facts_restricted_by_visible_values",
    """
    SELECT l_returnflag, count(*) AS rows FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') GROUP BY 1
    """,
)
def restricted(spark, sf_dir):
    urgent = read(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag")
    kept = jo.restrict_by(lines, urgent, {"l_orderkey": "o_orderkey"})
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "projects_narrowed_by_scores",
    """
    SELECT ProjectStatus, count(*) AS projects FROM "DimProjecten"
    WHERE ProjectKey IN (SELECT ProjectKey FROM "FeitTevredenheid" WHERE Score >= 5) GROUP BY 1
    """,
)
def narrowed(spark, sf_dir):
    return evaluate(
        shapes.operational(spark, sf_dir), {"projects": m.rows("DimProjecten")}, by=["DimProjecten.ProjectStatus"],
        where=[m.compare("FeitTevredenheid.Score", ">=", 5)],
    )


@query(
    "roster_restricted_by_staffing",
    """
    SELECT Medewerker, round(sum(UrenPerDag), 4) AS hours FROM "FeitRoosterUren"
    WHERE Medewerker IN (SELECT Medewerker FROM "FeitFormatieBezetting" WHERE FTE = 1) GROUP BY 1
    """,
)
def roster_restricted(spark, sf_dir):
    hours = {"hours": m.sum_("FeitRoosterUren.UrenPerDag")}
    full_time = [m.eq("FeitFormatieBezetting.FTE", 1)]
    return rounded(evaluate(shapes.operational(spark, sf_dir), hours, by=["FeitRoosterUren.Medewerker"], where=full_time, keep_empty=True))


@query(
    "events_by_date_dimension",
    """
    SELECT d.JaarWeek, d.Datum, count(*) AS events FROM events e LEFT JOIN "dim_datum" d ON d.Datum = CAST(e.ts AS DATE) GROUP BY ALL
    """,
)
def events_by_date(spark, sf_dir):
    days = shape(spark, sf_dir, "dim_datum")
    dated = jo.with_date(read(spark, sf_dir, "events").select("ts"), "ts", days.withColumn("Dag_", F.col("Datum")), ["JaarWeek", "Dag_"])
    return dated.groupBy("JaarWeek", F.col("Dag_").alias("Datum")).agg(F.count(F.lit(1)).alias("events"))


@query(
    "capacity_by_sprint_name",
    """
    SELECT s.SprintName, round(sum(c.TotaalUren), 4) AS hours FROM "FeitSprintCapaciteit" c
    LEFT JOIN "DimSprint" s ON s.NaamZonderSprint = c.SprintNaam GROUP BY 1
    """,
)
def capacity_by_sprint(spark, sf_dir):
    capacity = shape(spark, sf_dir, "FeitSprintCapaciteit").withColumn("name", F.concat(F.lit(" "), "SprintNaam"))
    sprints = shape(spark, sf_dir, "DimSprint")
    bare = text.strip_word(F.col("SprintName"), "Sprint")
    found = jo.with_dim_by_text(capacity, sprints, F.col("name"), bare, ["SprintName"])
    return rounded(found.groupBy("SprintName").agg(F.sum("TotaalUren").alias("hours")))


@query(
    "label_by_literal_table",
    """
    SELECT t.label, count(*) AS rows FROM lineitem l
    LEFT JOIN (VALUES ('A', 'accepted'), ('R', 'returned')) t(flag, label) ON t.flag = l.l_returnflag GROUP BY 1
    """,
)
def label_by_literal(spark, sf_dir):
    labels = literal_table(spark, [("A", "accepted"), ("R", "returned")], "flag string, label string")
    found = jo.with_dim(read(spark, sf_dir, "lineitem").select("l_returnflag"), labels, {"l_returnflag": "flag"}, ["label"])
    return found.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))


# --- aggregates ---------------------------------------------------------------------


@query(
    "highest_request_per_day_summed",
    """
    SELECT MedewerkerKey, round(sum(hi), 4) AS hours FROM (
        SELECT MedewerkerKey, DatumAangevraagd, max(Verlofuren) AS hi FROM "FeitVerlofAanvragen" GROUP BY ALL) GROUP BY 1
    """,
)
def highest_summed(spark, sf_dir):
    leave = shape(spark, sf_dir, "FeitVerlofAanvragen")
    return rounded(ag.sum_of_max(leave, ["MedewerkerKey"], ["DatumAangevraagd"], "Verlofuren", "hours"))


@query(
    "highest_in_filtered_set",
    """
    SELECT JaarMaand, round(max(BedragExclBTW) FILTER (WHERE Include), 4) AS highest FROM "FeitFactuurregels"
    JOIN "DimDatum" ON Datum = CAST(FactuurDatum AS DATE) WHERE Include GROUP BY 1
    """,
)
def highest_filtered(spark, sf_dir):
    metric = m.max_("FeitFactuurregels.BedragExclBTW", m.eq("FeitFactuurregels.Include", True))
    return rounded(evaluate(shapes.operational(spark, sf_dir), {"highest": metric}, by=["DimDatum.JaarMaand"]))


@query(
    "practice_names_joined",
    """
    SELECT string_agg(PracticeNaam, ', ' ORDER BY PracticeNaam) AS names FROM (SELECT DISTINCT p.PracticeNaam
    FROM "DimTeam" t JOIN "DimPractice" p USING (PracticeKey))
    """,
)
def practice_names(spark, sf_dir):
    teams = jo.with_dim(shape(spark, sf_dir, "DimTeam"), shape(spark, sf_dir, "DimPractice"), "PracticeKey", ["PracticeNaam"])
    return ag.concat_values(teams, "PracticeNaam", name="names")


@query("distinct_statuses", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_statuses(spark, sf_dir):
    return ag.distinct(read(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


@query(
    "lines_deduplicated",
    """
    SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, l_partkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_quantity DESC, l_partkey DESC) = 1
    """,
)
def lines_deduplicated(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_partkey")
    return ag.dedupe(lines, ["l_orderkey", "l_linenumber"], prefer=["l_shipdate", "l_quantity"])


@query("contract_customers", 'SELECT * FROM "KlantDim"')
def contract_customers(spark, sf_dir):
    return ag.derive_dim(shape(spark, sf_dir, "contract_opbrengsten"), "Debiteurnummer", ["Contact Name"])


@query(
    "default_aggregation_per_column",
    """
    SELECT o_orderstatus, count(o_custkey) AS o_custkey, round(sum(o_totalprice), 4) AS o_totalprice, count(o_orderdate) AS o_orderdate
    FROM orders GROUP BY 1
    """,
)
def default_aggregation(spark, sf_dir):
    df = read(spark, sf_dir, "orders").select("o_orderstatus", "o_custkey", "o_totalprice", "o_orderdate")
    return rounded(ag.default_agg(df, ["o_orderstatus"], ag.numeric_defaults(df, ["o_orderstatus"])))


@query(
    "card_of_first_and_last",
    """
    SELECT min(KlantNaam) AS first_name, max(KlantNaam) AS last_name,
           CASE WHEN count(DISTINCT Branche) = 1 AND count(*) = count(Branche) THEN max(Branche) ELSE 'meerdere' END AS segment
    FROM "DimKlanten"
    """,
)
def card(spark, sf_dir):
    return shape(spark, sf_dir, "DimKlanten").agg(
        F.min("KlantNaam").alias("first_name"), F.max("KlantNaam").alias("last_name"),
        ag.selected("Branche", "meerdere").alias("segment"),
    )


@query("visible_values", "SELECT DISTINCT Branche FROM \"DimKlanten\"")
def visible_values(spark, sf_dir):
    return ag.values(shape(spark, sf_dir, "DimKlanten"), "Branche")


@query(
    "table_with_grand_total",
    """
    WITH l AS (SELECT k.Branche, f.ProjectKey, f.BedragExclBTW FROM "FeitFactuurregels" f
               LEFT JOIN "DimProjecten" o ON o.ProjectKey = f.ProjectKey LEFT JOIN "DimKlanten" k ON k.KlantKey = o.KlantKey)
    SELECT Branche, CAST(GROUPING(Branche) AS INTEGER) AS grouping_level, round(sum(BedragExclBTW), 4) AS revenue,
           count(DISTINCT ProjectKey) AS projects
    FROM l GROUP BY GROUPING SETS ((Branche), ())
    """,
)
def with_grand_total(spark, sf_dir):
    metrics = {"revenue": m.sum_("FeitFactuurregels.BedragExclBTW"), "projects": m.distinct_("FeitFactuurregels.ProjectKey")}
    return rounded(evaluate(shapes.operational(spark, sf_dir), metrics, by=["DimKlanten.Branche"], totals=True))


@query(
    "rollup_by_year_and_quarter",
    """
    SELECT year(Factuurdatum) AS Jaar, quarter(Factuurdatum) AS KwartaalNummer,
           CAST(GROUPING(year(Factuurdatum)) + GROUPING(quarter(Factuurdatum)) AS INTEGER) AS grouping_level,
           round(sum(Subtotaal), 4) AS revenue
    FROM "FeitFacturen" GROUP BY ROLLUP (year(Factuurdatum), quarter(Factuurdatum))
    """,
)
def rollup_by_quarter(spark, sf_dir):
    by = ["DimDatum.Jaar", "DimDatum.KwartaalNummer"]
    metric = {"revenue": m.sum_("FeitFacturen.Subtotaal")}
    return rounded(evaluate(shapes.operational(spark, sf_dir), metric, by=by, totals="rollup"))


@query(
    "calendar_drill",
    """
    SELECT year(o_orderdate) AS "Year", quarter(o_orderdate) AS "Quarter", month(o_orderdate) AS "Month",
           CAST(GROUPING(year(o_orderdate)) + GROUPING(quarter(o_orderdate)) + GROUPING(month(o_orderdate)) AS INTEGER) AS grouping_level,
           count(*) AS orders
    FROM orders GROUP BY ROLLUP (year(o_orderdate), quarter(o_orderdate), month(o_orderdate))
    """,
)
def calendar_drill(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderdate")
    return ag.calendar_drill(orders, "o_orderdate", "Month", F.count(F.lit(1)).alias("orders"), subtotals=True)


def _by_choice(choice: str, label: str):
    def build(spark, sf_dir):
        chosen = {"Project": "DimProjecten.BusinessType", "Practice": "DimPractice.PracticeNaam", "Team": "DimTeam.Team"}[choice]
        df = evaluate(shapes.operational(spark, sf_dir), {"revenue": m.sum_("FeitFacturen.Subtotaal")}, by=[chosen])
        return rounded(df.withColumnRenamed(label, "choice"))

    return build


for _choice, _label, _join in (
    ("Project", "BusinessType", '"DimProjecten" d ON d.ProjectKey = f.ProjectKey'),
    ("Practice", "PracticeNaam", '"DimPractice" d ON d.PracticeKey = f.PracticeKey'),
    ("Team", "Team", '"DimTeam" d ON d.TeamKey = f.ProjectTeamKey'),
):
    query(
        f"revenue_by_chosen_{_choice.lower()}",
        f'SELECT d.{_label} AS choice, round(sum(f.Subtotaal), 4) AS revenue FROM "FeitFacturen" f LEFT JOIN {_join} GROUP BY 1',
    )(_by_choice(_choice, _label))


@query(
    "kpi_revenue_against_goal",
    """
    WITH x AS (SELECT MonthDateKey, sum(FTE_x_MonthGoal) AS goal, sum(Intern) AS indicator FROM "FeitBudgetten" GROUP BY 1)
    SELECT MonthDateKey, round(indicator, 4) AS indicator, round(goal, 4) AS goal, round(indicator - goal, 4) AS difference,
           round((indicator - goal) / goal, 4) AS difference_share
    FROM x WHERE MonthDateKey = (SELECT max(MonthDateKey) FROM x)
    """,
)
def kpi(spark, sf_dir):
    budget = shape(spark, sf_dir, "FeitBudgetten")
    return rounded(ag.kpi(budget, "MonthDateKey", F.sum("Intern"), F.sum("FTE_x_MonthGoal")))


@query(
    "share_by_category",
    """
    SELECT OmzetCategorie, round(sum(Subtotaal), 4) AS revenue,
           round(sum(Subtotaal) / (SELECT sum(Subtotaal) FROM "FeitFacturen"), 4) AS share
    FROM "FeitFacturen" GROUP BY 1
    """,
)
def share_by_category(spark, sf_dir):
    metric = {"revenue": m.sum_("FeitFacturen.Subtotaal")}
    by_category = evaluate(shapes.operational(spark, sf_dir), metric, by=["FeitFacturen.OmzetCategorie"])
    return rounded(wi.share_of_total(by_category, "revenue"))


# --- context and period -------------------------------------------------------------


@query(
    "part_of_selection",
    """
    WITH l AS (SELECT k.Branche, k.KlantType, f.Subtotaal FROM "FeitFacturen" f LEFT JOIN "DimProjecten" o ON o.ProjectKey = f.ProjectKey
               LEFT JOIN "DimKlanten" k ON k.KlantKey = o.KlantKey)
    SELECT Branche, KlantType, round(sum(Subtotaal), 4) AS revenue,
           round((SELECT sum(Subtotaal) FROM l WHERE KlantType IN ('Customer', 'Prospect')), 4) AS selected,
           round((SELECT sum(Subtotaal) FROM l), 4) AS everything,
           round((SELECT sum(Subtotaal) FROM l x WHERE x.KlantType = l.KlantType), 4) AS of_type
    FROM l WHERE KlantType IN ('Customer', 'Prospect') GROUP BY ALL
    """,
)
def part_of_selection(spark, sf_dir):
    revenue = m.sum_("FeitFacturen.Subtotaal")
    metrics = {
        "revenue": revenue, "selected": m.over_selection(revenue, "DimKlanten.Branche", "DimKlanten.KlantType"),
        "everything": m.ignoring(revenue, "DimKlanten"),
        "of_type": m.keep_only(revenue, "DimKlanten", "DimKlanten.KlantType"),
    }
    chosen = [m.is_in("DimKlanten.KlantType", ["Customer", "Prospect"])]
    return rounded(
        evaluate(shapes.operational(spark, sf_dir), metrics, by=["DimKlanten.Branche", "DimKlanten.KlantType"], where=chosen)
    )


@query(
    "billing_for_this_year_only",
    """
    SELECT p.PracticeNaam, round(sum(Subtotaal), 4) AS revenue, count(*) AS invoices FROM "FeitFacturen" f
    LEFT JOIN "DimPractice" p ON p.PracticeKey = f.PracticeKey
    WHERE year(Factuurdatum) = 1998 AND p.PracticeNaam NOT IN ('ASIA') GROUP BY 1
    """,
)
def billing_this_year(spark, sf_dir):
    first, last = dt.date(AS_OF.year, 1, 1), dt.date(AS_OF.year, 12, 31)
    where = [m.between("DimDatum.Datum", first, last), m.not_in("DimPractice.PracticeNaam", ["ASIA"])]
    metrics = {"revenue": m.sum_("FeitFacturen.Subtotaal"), "invoices": m.rows("FeitFacturen")}
    return rounded(
        evaluate(shapes.operational(spark, sf_dir), metrics, by=["DimPractice.PracticeNaam"], where=where, sort=[("revenue", False)])
    )


@query(
    "period_menu_applied",
    """
    WITH u AS (SELECT p.PracticeNaam, CAST(Datum AS DATE) AS dag, AantalUren FROM "FeitGeschrevenUren" u LEFT JOIN "DimPractice" p ON p.PracticeKey = u.PracticeKey)
    SELECT PracticeNaam, round(sum(AantalUren) FILTER (WHERE dag BETWEEN DATE '1998-06-01' AND DATE '1999-06-30'), 4) AS coming,
           round(sum(AantalUren) FILTER (WHERE dag BETWEEN DATE '1998-07-01' AND DATE '1999-06-30'), 4) AS coming_older,
           round(sum(AantalUren) FILTER (WHERE dag BETWEEN DATE '1998-06-01' AND DATE '1999-05-31'), 4) AS coming_half_open,
           round(sum(AantalUren) FILTER (WHERE dag BETWEEN DATE '1997-07-01' AND DATE '1998-06-30'), 4) AS last,
           round(sum(AantalUren) FILTER (WHERE dag BETWEEN DATE '1996-07-01' AND DATE '1997-06-30'), 4) AS before,
           round(sum(AantalUren) FILTER (WHERE dag BETWEEN DATE '1996-04-01' AND DATE '1997-03-31'), 4) AS chosen_month
    FROM u GROUP BY 1
    """,
)
def period_menu(spark, sf_dir):
    hours = m.sum_("FeitGeschrevenUren.AantalUren")
    metrics = {
        "coming": t.apply("Komende 12 maanden", hours, NOW),
        "coming_older": t.next_12m(hours, NOW, include_current=False),
        "coming_half_open": t.apply("TESTKomende 12 maanden", hours, NOW),
        "last": t.apply("Laatste 12 maanden", hours, NOW),
        "before": t.apply("Voorgaande 12 maanden", hours, NOW),
        "chosen_month": t.apply("Laatste 12 maanden", hours, Period(AS_OF, 1997, 3)),
    }
    return rounded(evaluate(shapes.operational(spark, sf_dir), metrics, by=["DimPractice.PracticeNaam"]))


@query(
    "monthly_or_cumulative",
    """
    SELECT round((SELECT sum(Subtotaal) FROM "FeitFacturen"), 4) AS monthly,
           round((SELECT sum(Subtotaal) FROM "FeitFacturen" WHERE CAST(Factuurdatum AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-06-15'), 4) AS cumulative,
           round((SELECT sum(KostprijsTarief) FROM "FeitGeschrevenUren"), 4) AS other
    """,
)
def monthly_or_cumulative(spark, sf_dir):
    choices, known = ops.revenue_options(NOW), ops.revenue(NOW)
    metrics = {
        "monthly": m.switch_metric("Maandelijks", "Factuuromzet", choices, known["Factuuromzet"]),
        "cumulative": m.switch_metric("Cumulatief", "Factuuromzet", choices, known["Factuuromzet"]),
        "other": m.switch_metric("Cumulatief", "Factuurkosten", choices, known["Factuurkosten"]),
    }
    return rounded(evaluate(shapes.operational(spark, sf_dir), metrics))


@query(
    "cumulative_revenue_by_day",
    """
    WITH d AS (SELECT CAST(Factuurdatum AS DATE) AS day, PracticeKey, sum(Subtotaal) AS v FROM "FeitFacturen" GROUP BY ALL),
    g AS (SELECT p.PracticeKey, c.Datum AS day FROM (SELECT DISTINCT PracticeKey FROM d) p, "DimDatum" c)
    SELECT g.PracticeKey, g.day, round(d.v, 4) AS v,
           round(sum(d.v) OVER (PARTITION BY g.PracticeKey, year(g.day) ORDER BY g.day), 4) AS ytd
    FROM g LEFT JOIN d ON d.day = g.day AND d.PracticeKey = g.PracticeKey
    """,
)
def cumulative_by_day(spark, sf_dir):
    bills = shape(spark, sf_dir, "FeitFacturen")
    daily = bills.groupBy(F.to_date("Factuurdatum").alias("day"), "PracticeKey").agg(F.sum("Subtotaal").alias("v"))
    days = shape(spark, sf_dir, "DimDatum").select("Datum")
    dense = wi.dense_grid(daily, days, "day", ["PracticeKey"])
    return rounded(wi.cumulative_ytd(dense, "v", "day", ["PracticeKey"]).select("PracticeKey", "day", "v", "ytd"))


@query(
    "running_revenue_where_it_changes",
    """
    WITH d AS (SELECT CAST(Factuurdatum AS DATE) AS day, KlantKey, sum(Subtotaal) AS v FROM "FeitFacturen" GROUP BY ALL)
    SELECT KlantKey, day, round(sum(v) OVER y, 4) AS ytd, coalesce(lead(day) OVER y - 1, make_date(year(day), 12, 31)) AS valid_to
    FROM d WINDOW y AS (PARTITION BY KlantKey, year(day) ORDER BY day)
    """,
)
def running_where_it_changes(spark, sf_dir):
    return rounded(wi.running_points(shape(spark, sf_dir, "FeitFacturen").withColumnRenamed("Factuurdatum", "day"), "Subtotaal", "day", ["KlantKey"]))


@query(
    "running_revenue_on_asked_days",
    """
    WITH a AS (SELECT DISTINCT o_custkey AS KlantKey, CAST(l_shipdate AS DATE) AS day FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
    d AS (SELECT CAST(Factuurdatum AS DATE) AS day, KlantKey, sum(Subtotaal) AS v FROM "FeitFacturen" GROUP BY ALL)
    SELECT a.KlantKey, a.day, round(sum(d.v), 4) AS ytd FROM a LEFT JOIN d ON d.KlantKey = a.KlantKey AND year(d.day) = year(a.day) AND d.day <= a.day GROUP BY ALL
    """,
)
def running_on_asked_days(spark, sf_dir):
    """Each customer's revenue of the year so far on the days of its shipments."""
    points = wi.running_points(shape(spark, sf_dir, "FeitFacturen").withColumnRenamed("Factuurdatum", "day"), "Subtotaal", "day", ["KlantKey"])
    lines, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    asked = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(F.col("o_custkey").alias("KlantKey"), F.to_date("l_shipdate").alias("day")).distinct()
    return rounded(wi.running_on(points, asked, "day", ["KlantKey"]))


@query(
    "cumulative_revenue_and_budget_by_month",
    """
    WITH b AS (SELECT PracticeKey AS p, year(Factuurdatum) AS j, month(Factuurdatum) AS m, sum(Subtotaal) AS v FROM "FeitFacturen" GROUP BY ALL),
    g AS (SELECT PracticeKey AS p, Jaar AS j, (MonthDateKey // 100) % 100 AS m, sum(FTE_x_MonthGoal) AS v FROM "FeitBudgetten" GROUP BY ALL),
    k AS (SELECT DISTINCT p, j FROM b UNION SELECT DISTINCT p, j FROM g),
    x AS (SELECT k.p, k.j, CAST(r.m AS BIGINT) AS m FROM k, range(1, 13) r(m))
    SELECT d.PracticeNaam, x.j AS "Jaar", x.m AS "MaandNummer",
           round(sum(b.v) OVER (PARTITION BY x.p, x.j ORDER BY x.m), 4) AS revenue,
           round(sum(g.v) OVER (PARTITION BY x.p, x.j ORDER BY x.m), 4) AS goal
    FROM x LEFT JOIN b ON b.p = x.p AND b.j = x.j AND b.m = x.m LEFT JOIN g ON g.p = x.p AND g.j = x.j AND g.m = x.m
    LEFT JOIN "DimPractice" d ON d.PracticeKey = x.p
    """,
)
def cumulative_by_month(spark, sf_dir):
    metrics = {"revenue": m.sum_("FeitFacturen.Subtotaal"), "goal": m.sum_("FeitBudgetten.FTE_x_MonthGoal")}
    return rounded(evaluate_ytd(shapes.operational(spark, sf_dir), metrics, by=["DimPractice.PracticeNaam"]))


@query(
    "relationship_switched_off",
    """
    SELECT f.OmzetCategorie, round(sum(f.BedragExclBTW), 4) AS everyone,
           round(sum(f.BedragExclBTW) FILTER (WHERE e.IsExterneMedewerker = 1), 4) AS external
    FROM "FeitFactuurregels" f LEFT JOIN "DimMedewerkers" e ON e.MedewerkerKey = f.MedewerkerKey GROUP BY 1
    """,
)
def relationship_switched_off(spark, sf_dir):
    revenue = m.sum_("FeitFactuurregels.BedragExclBTW")
    metrics = {"everyone": m.without(revenue, "DimMedewerkers"), "external": revenue}
    chosen = [m.eq("DimMedewerkers.IsExterneMedewerker", 1)]
    return rounded(
        evaluate(shapes.operational(spark, sf_dir), metrics, by=["FeitFactuurregels.OmzetCategorie"], where=chosen)
    )


@query("projects_by_name_on_older_board", "SELECT count(DISTINCT role) AS projects FROM conversations")
def projects_by_name(spark, sf_dir):
    model = shapes.sprint_older(spark, sf_dir)
    return evaluate(model, {"projects": sprint_old()["Aantal Projecten (variant 3)"]})


@query(
    "same_period_last_year",
    """
    WITH x AS (SELECT CAST(o_orderdate AS DATE) AS d, o_totalprice AS v FROM orders)
    SELECT coalesce(n.d, l.d) AS "Datum", round(n.v, 4) AS now, round(l.v, 4) AS before
    FROM (SELECT d, sum(v) AS v FROM x GROUP BY 1) n
    FULL JOIN (SELECT CASE WHEN d2 <= DATE '2002-12-31' THEN d2 END AS d, sum(v) AS v FROM (SELECT CAST(d + INTERVAL 12 MONTH AS DATE) AS d2, v FROM x) GROUP BY 1) l
    ON n.d IS NOT DISTINCT FROM l.d
    """,
)
def same_period(spark, sf_dir):
    revenue = m.sum_("FeitFacturen.Subtotaal")
    metrics = {"now": revenue, "before": t.last_year(revenue)}
    return rounded(evaluate(shapes.operational(spark, sf_dir), metrics, by=["DimDatum.Datum"]))


@query(
    "cost_by_load_day",
    """
    SELECT CAST(ts AS DATE) AS day, count(*) AS rows, round(sum(value), 4) AS cost FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-19' GROUP BY 1
    """,
)
def cost_by_load_day(spark, sf_dir):
    days = t.run_dates(COST_AS_OF, days_back=10)
    events = read(spark, sf_dir, "events").select("ts", "value").filter(fi.day_range("ts", days[0], days[-1]))
    return rounded(
        events.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("rows"), F.sum("value").alias("cost"))
    )


# --- ranks, order, numbers ----------------------------------------------------------


@query(
    "resource_groups_ranked",
    """
    WITH x AS (SELECT resourceGroupName, round(sum(costInBillingCurrency), 4) AS cost FROM "cost_view_exported" GROUP BY 1)
    SELECT *, dense_rank() OVER (ORDER BY cost DESC) AS rank FROM x
    """,
)
def resource_groups_ranked(spark, sf_dir):
    model = shapes.contracts(spark, sf_dir)
    cost = {"cost": m.sum_("cost_view_exported.costInBillingCurrency")}
    return nu.rank_dense(rounded(evaluate(model, cost, by=["cost_view_exported.resourceGroupName"])), "cost")


@query("parts_ranked_by_size", "SELECT p_partkey, p_size, dense_rank() OVER (ORDER BY p_size DESC) AS rank FROM part")
def parts_ranked(spark, sf_dir):
    return nu.rank_dense(read(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_size")


@query(
    "versions_numbered_per_key",
    """
    SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS "RowNum" FROM orders
    """,
)
def versions_numbered(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return nu.row_number_by(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "largest_invoices",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
)
def largest_invoices(spark, sf_dir):
    return wi.top(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 25, [F.desc("o_totalprice"), "o_orderkey"])


@query(
    "month_names_in_order",
    """
    SELECT CASE month(o_orderdate) WHEN 1 THEN 'jan' WHEN 2 THEN 'feb' WHEN 3 THEN 'mrt' WHEN 4 THEN 'apr' WHEN 5 THEN 'mei'
        WHEN 6 THEN 'jun' WHEN 7 THEN 'jul' WHEN 8 THEN 'aug' WHEN 9 THEN 'sep' WHEN 10 THEN 'okt' WHEN 11 THEN 'nov' ELSE 'dec' END AS name,
        min(13 - month(o_orderdate)) AS sort_key
    FROM orders GROUP BY 1
    """,
)
def month_names(spark, sf_dir):
    month = F.month("o_orderdate")
    df = read(spark, sf_dir, "orders").select(
        dates.label(month, dates.MONTHS_SHORT).alias("name"), wi.reversed_month(month).alias("sort_key")
    )
    return wi.sort_by(df, "name", "sort_key")


@query("orders_sorted", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey")
def orders_sorted(spark, sf_dir):
    return wi.sort(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), [F.desc("o_orderdate"), "o_orderkey"])


# --- unions -------------------------------------------------------------------------


@query(
    "stacked_tables",
    """
    SELECT kind, count(*) AS rows, count(segment) AS with_segment, round(sum(balance), 4) AS balance FROM (
        SELECT 'customer' AS kind, c_acctbal AS balance, c_mktsegment AS segment FROM customer
        UNION ALL SELECT 'supplier', s_acctbal, NULL FROM supplier) GROUP BY 1
    """,
)
def stacked_tables(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = read(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("kind"))
    both = se.union_loose([customers, suppliers])
    return rounded(both.groupBy("kind").agg(
        F.count(F.lit(1)).alias("rows"), F.count("segment").alias("with_segment"), F.sum("balance").alias("balance")
    ))


@query(
    "backfill_merged",
    """
    WITH n AS (SELECT o_custkey, o_orderpriority, max(o_totalprice) AS price FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL),
    o AS (SELECT o_custkey, o_orderpriority, max(o_totalprice) AS price FROM orders WHERE o_orderstatus <> 'F' GROUP BY ALL)
    SELECT coalesce(n.o_custkey, o.o_custkey) AS o_custkey, coalesce(n.o_orderpriority, o.o_orderpriority) AS o_orderpriority,
           coalesce(n.price, o.price) AS o_totalprice
    FROM n FULL JOIN o ON n.o_custkey = o.o_custkey AND n.o_orderpriority = o.o_orderpriority
    """,
)
def backfill_merged(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    columns = ["o_custkey", "o_orderpriority", "o_totalprice"]
    new, old = orders.filter("o_orderstatus = 'F'").select(columns), orders.filter("o_orderstatus <> 'F'").select(columns)
    return se.merge_backfill(new, old, ["o_custkey", "o_orderpriority"])


# --- dates, text, numbers -----------------------------------------------------------


@query(
    "date_functions",
    """
    WITH x AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT o_orderkey, make_date(year(d), month(d), 1) AS month_start, last_day(d) AS month_end,
           last_day(CAST(d + INTERVAL 12 MONTH AS DATE)) AS month_end_next_year, weekofyear(d) AS iso_week, isoyear(d) AS iso_year,
           dayofweek(d) + 1 AS weekday_sunday, isodow(d) AS weekday_monday,
           (dayofyear(d) + dayofweek(make_date(year(d), 1, 1)) - 1) // 7 + 1 AS week_from_january_first,
           CAST(year(d) AS VARCHAR) || lpad(CAST((dayofyear(d) + dayofweek(make_date(year(d), 1, 1)) - 1) // 7 + 1 AS VARCHAR), 2, '0') AS year_week_text,
           CAST(DATE '1998-06-15' - d AS BIGINT) AS days_between,
           ((DATE '1998-06-15' - CAST(dayofweek(DATE '1998-06-15') AS INTEGER)) - (d - CAST(dayofweek(d) AS INTEGER))) // 7 AS weeks_between,
           CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_number, strftime(d, '%d-%m-%y') AS short_date,
           (year(d) * 12 + month(d)) - (1998 * 12 + 6) AS rel_month,
           CASE WHEN month(d) >= 5 THEN year(d) + 1 ELSE year(d) END AS fiscal_year,
           CASE WHEN month(d) >= 5 THEN month(d) - 4 ELSE month(d) + 8 END AS fiscal_month,
           CASE WHEN weekofyear(d) % 2 = 0 THEN (weekofyear(d) - 1) || '-' || weekofyear(d) ELSE weekofyear(d) || '-' || (weekofyear(d) + 1) END AS iteration
    FROM x
    """,
)
def date_functions(spark, sf_dir):
    d = F.col("d")
    now = F.lit(AS_OF)
    df = read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return dates.whole_numbers(df.select(
        "o_orderkey", dates.month_start(d).alias("month_start"), dates.end_of_month(d).alias("month_end"),
        dates.end_of_month(d, 12).alias("month_end_next_year"), dates.iso_week(d).alias("iso_week"),
        dates.iso_year(d).alias("iso_year"), dates.weekday_sunday(d).alias("weekday_sunday"),
        dates.weekday_monday(d).alias("weekday_monday"),
        dates.week_from_january_first(d).alias("week_from_january_first"), dates.year_week_text(d).alias("year_week_text"),
        dates.days_between(d, now).alias("days_between"), dates.weeks_between(d, now).alias("weeks_between"),
        dates.date_number(d).alias("date_number"), dates.short_date(d).alias("short_date"),
        dates.rel_month(d, AS_OF).alias("rel_month"), dates.fiscal_year(d).alias("fiscal_year"),
        dates.fiscal_month(d).alias("fiscal_month"), dates.iteration(d).alias("iteration"),
    ))


@query(
    "dates_from_text",
    """
    WITH x AS (SELECT *, CASE WHEN "Debiteurnummer" IS NULL THEN 'n.v.t.' ELSE "Termijn Maand" END AS t FROM "contract_opbrengsten")
    SELECT t AS term, CASE WHEN t <> 'n.v.t.' THEN "Termijn Maand Datum" END AS month,
           CASE WHEN t <> 'n.v.t.' THEN CAST(strptime(t, '%d-%m-%Y') AS DATE) END AS day, count(*) AS rows
    FROM x GROUP BY ALL
    """,
)
def dates_from_text(spark, sf_dir):
    df = shape(spark, sf_dir, "contract_opbrengsten")
    term = F.when(F.col("Debiteurnummer").isNull(), "n.v.t.").otherwise(F.col("`Termijn Maand`"))
    typed = df.select(term.alias("term"))
    typed = typed.select("term", dates.term_month(F.col("term")).alias("month"), dates.parse_date(F.col("term"), "dd-MM-yyyy").alias("day"))
    return typed.groupBy("term", "month", "day").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "date_dimension",
    """
    WITH b AS (SELECT make_date(year(min(o_orderdate)), 1, 1) AS a, make_date(year(max(o_orderdate)), 12, 31) AS z FROM orders),
    x AS (SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM b)
    SELECT d AS "Datum", CAST(strftime(d, '%Y%m%d') AS BIGINT) AS "DatumKey", day(d) AS "Dag", dayofweek(d) + 1 AS "Weekdag",
           CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END :: BIGINT AS "IsWeekend", weekofyear(d) AS "ISOWeekNummer", month(d) AS "MaandNummer",
           13 - month(d) AS "MaandNummerOmgekeerd", quarter(d) AS "KwartaalNummer", year(d) AS "Jaar", strftime(d, '%m%Y') AS "MMYYYY",
           year(d) * 100 + month(d) AS "JaarMaand", year(d) * 100 + weekofyear(d) AS "JaarWeek",
           date_trunc('month', d) :: DATE AS "EersteDagVanMaand", last_day(d) AS "LaatsteDagVanMaand",
           date_trunc('quarter', d) :: DATE AS "EersteDagVanKwartaal",
           CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS "LaatsteDagVanKwartaal",
           make_date(year(d), 12, 31) AS "LaatsteDagVanJaar", make_date(year(d) + 1, 1, 1) AS "EersteDagVanVolgendJaar",
           CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE) AS "EersteDagVanVolgendeMaand",
           (year(d) * 12 + month(d)) - (1998 * 12 + 6) AS "MaandNrRelatief",
           CASE WHEN month(d) < 6 OR (month(d) = 6 AND day(d) < 15) THEN 1 ELSE 0 END :: BIGINT AS "IsYTD",
           CASE WHEN d > DATE '1998-06-15' THEN 1 ELSE 0 END :: BIGINT AS "IsToekomst", CASE WHEN d = DATE '1998-06-15' THEN 1 ELSE 0 END :: BIGINT AS "IsVandaag",
           CASE WHEN year(d) = 1998 THEN 1 ELSE 0 END :: BIGINT AS "IsHuidigJaar", CASE WHEN weekofyear(d) = 25 THEN 1 ELSE 0 END :: BIGINT AS "IsHuidigeWeek",
           CASE WHEN weekofyear(d) = 24 THEN 1 ELSE 0 END :: BIGINT AS "IsVorigeWeek", CASE WHEN weekofyear(d) < 25 THEN 1 ELSE 0 END :: BIGINT AS "IsYTDweek",
           CASE WHEN month(d) >= 5 THEN year(d) || '-' || (year(d) + 1) ELSE (year(d) - 1) || '-' || year(d) END AS "BoekjaarNaam",
           CASE WHEN month(d) = 5 OR (month(d) = 6 AND day(d) < 15) THEN 1 ELSE 0 END :: BIGINT AS "IsFYTD",
           CASE WHEN weekofyear(d) IN (25, 26) THEN 1 ELSE 0 END :: BIGINT AS "IsHuidigeIteratie"
    FROM x
    """,
)
def date_dimension(spark, sf_dir):
    days = dates.calendar_for(read(spark, sf_dir, "orders"), "o_orderdate")
    return dates.date_attributes(days, AS_OF).select(
        "Datum", "DatumKey", "Dag", "Weekdag", "IsWeekend", "ISOWeekNummer", "MaandNummer", "MaandNummerOmgekeerd",
        "KwartaalNummer", "Jaar", "MMYYYY", "JaarMaand", "JaarWeek", "EersteDagVanMaand", "LaatsteDagVanMaand",
        "EersteDagVanKwartaal", "LaatsteDagVanKwartaal", "LaatsteDagVanJaar", "EersteDagVanVolgendJaar",
        "EersteDagVanVolgendeMaand", "MaandNrRelatief", "IsYTD", "IsToekomst", "IsVandaag", "IsHuidigJaar", "IsHuidigeWeek",
        "IsVorigeWeek", "IsYTDweek", "BoekjaarNaam", "IsFYTD", "IsHuidigeIteratie",
    )


_MONTHS = "['januari', 'februari', 'maart', 'april', 'mei', 'juni', 'juli', 'augustus', 'september', 'oktober', 'november', 'december']"
_MONTHS_SHORT = "['jan', 'feb', 'mrt', 'apr', 'mei', 'jun', 'jul', 'aug', 'sep', 'okt', 'nov', 'dec']"
_DAYS = "['zondag', 'maandag', 'dinsdag', 'woensdag', 'donderdag', 'vrijdag', 'zaterdag']"
_LABELS = {
    "WeekDagNaam": f"{_DAYS}[dayofweek(d) + 1]", "WeekDagNaamKort": f"{_DAYS}[dayofweek(d) + 1][1:2]",
    "WeekNummer": "CAST(floor((dayofyear(d) + dayofweek(make_date(year(d), 1, 1)) - 1) / 7) AS BIGINT) + 1", "ISOJaar": "isoyear(d)",
    "MaandNaam": f"{_MONTHS}[month(d)]", "MaandNaamKort": f"{_MONTHS_SHORT}[month(d)]", "KwartaalNaam": "'Q' || quarter(d)",
    "JaarWeekNaam": "year(d) || '-w' || weekofyear(d)", "JaarWeekNaamKort": "'w' || weekofyear(d) || '-' || strftime(d, '%y')",
    "WeekNaamKort": "'w' || weekofyear(d)", "WeekNaamLang": "'week ' || weekofyear(d)", "HuidigWeekNr": "weekofyear(n)",
    "VorigeWeekLang": "year(n - 7) || '-w' || weekofyear(n - 7)", "MaandJaar": f"{_MONTHS_SHORT}[month(d)] || ' ' || strftime(d, '%y')",
    "EersteDagVanJaar": "make_date(year(d), 1, 1)", "RelatiefWeekNr": "CAST(((n - CAST(dayofweek(n) AS INT)) - (d - CAST(dayofweek(d) AS INT))) / 7 AS BIGINT)",
    "RelatiefDagNr": "n - d", "WeekdagNrRelatief": "CASE WHEN dayofweek(d) <= dayofweek(n) THEN dayofweek(d) + dayofweek(n) + 3 ELSE dayofweek(d) - dayofweek(n) END",
    "IsVerleden": "CAST(d < n AS BIGINT)", "IsHuidigeMaand": "CAST(month(d) = month(n) AS BIGINT)", "BoekjaarNr": "year(d) + CASE WHEN month(d) >= 5 THEN 1 ELSE 0 END",
    "BoekmaandNr": "(month(d) + 7) % 12 + 1", "BoekmaandNaamKort": f"{_MONTHS_SHORT}[month(d)]", "BoekmaandNaamLang": f"{_MONTHS}[month(d)]",
    "Iteratie": "s || '-' || (s + 1)", "JaarIteratie": "year(d) || '/' || s || '-' || (s + 1)", "IteratieStartWeek": "s", "IteratieEindWeek": "s + 1",
    "VolgendeIteratie": "(s + 2) || '-' || (s + 3)", "VorigeIteratie": "(s - 2) || '-' || (s - 1)",
}


@query(
    "date_dimension_labels",
    f"""
    WITH b AS (SELECT make_date(year(min(o_orderdate)), 1, 1) AS a, make_date(year(max(o_orderdate)), 12, 31) AS z FROM orders),
    y AS (SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM b),
    x AS (SELECT d, DATE '1998-06-15' AS n, weekofyear(d) - CASE WHEN weekofyear(d) % 2 = 0 THEN 1 ELSE 0 END AS s FROM y)
    SELECT d AS "Datum", {", ".join(f'{e} AS "{c}"' for c, e in _LABELS.items())} FROM x
    """,
)
def date_dimension_labels(spark, sf_dir):
    """The columns that ``date_dimension`` leaves out: labels, fiscal names, iterations, distances from today."""
    days = dates.calendar_for(read(spark, sf_dir, "orders"), "o_orderdate")
    return dates.date_attributes(days, AS_OF).select("Datum", *_LABELS)


@query(
    "generated_calendar_levels",
    """
    WITH b AS (SELECT make_date(year(min(ts)), 1, 1) AS a, make_date(year(max(ts)), 12, 31) AS z FROM events),
    x AS (SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM b)
    SELECT d AS "Datum", year(d) AS "Year", month(d) AS "MonthNo", quarter(d) AS "QuarterNo", 'Qtr ' || quarter(d) AS "Quarter", day(d) AS "Day",
           """ + _MONTHS + """[month(d)] AS "Month" FROM x
    """,
)
def calendar_levels(spark, sf_dir):
    return dates.calendar_levels(dates.calendar_for(read(spark, sf_dir, "events"), "ts"))


@query(
    "text_functions",
    """
    SELECT doc_id, regexp_extract(source, '^([^-_./]+)', 1) AS first_part,
           array_to_string(list_filter(string_split(replace(text, 'de', ''), ' '), lambda w: w <> ''), ' ') AS stripped,
           lpad(CAST(doc_id % 1000000 AS VARCHAR), 6, '0') AS padded, coalesce(lang, '') || '/' || CAST(n_chars AS VARCHAR) AS joined
    FROM documents
    """,
)
def text_functions(spark, sf_dir):
    return read(spark, sf_dir, "documents").select(
        "doc_id", text.path_part(F.col("source"), r"^([^-_./]+)").alias("first_part"),
        text.strip_word(F.col("text"), "de").alias("stripped"), text.padded(F.col("doc_id"), 6).alias("padded"),
        text.joined(F.col("lang"), F.lit("/"), F.col("n_chars")).alias("joined"),
    )


@query(
    "labels_standardised",
    """
    SELECT CASE WHEN BusinessUnit IN ('BI', 'Business Intelligence', 'Business Inteligence') THEN 'BI'
                WHEN BusinessUnit IN ('Applicatieontwikkeling', 'Applicatie-ontwikkeling') THEN 'Applicatieontwikkeling'
                WHEN BusinessUnit = 'IT' THEN 'IT' END AS unit, count(*) AS rows, round(sum(costInBillingCurrency), 4) AS cost
    FROM "cost_view_exported" GROUP BY 1
    """,
)
def labels_standardised(spark, sf_dir):
    mapping = {
        "Applicatieontwikkeling": ["Applicatieontwikkeling", "Applicatie-ontwikkeling"],
        "BI": ["BI", "Business Intelligence", "Business Inteligence"], "IT": ["IT"],
    }
    costs = shape(spark, sf_dir, "cost_view_exported")
    unit = text.standardise(F.col("BusinessUnit"), mapping).alias("unit")
    return rounded(costs.groupBy(unit).agg(F.count(F.lit(1)).alias("rows"), F.sum("costInBillingCurrency").alias("cost")))


@query(
    "blank_aware_arithmetic",
    """
    WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'A' THEN l_quantity END AS a,
                      CASE WHEN l_linestatus = 'F' THEN l_quantity - 25 END AS b FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN a IS NOT NULL OR b IS NOT NULL THEN coalesce(a, 0) + coalesce(b, 0) END, 4) AS added,
           round(CASE WHEN a IS NOT NULL OR b IS NOT NULL THEN coalesce(a, 0) - coalesce(b, 0) END, 4) AS subtracted, round(a * b, 4) AS product,
           round(CASE WHEN b <> 0 THEN a / b END, 4) AS ratio, round(CASE WHEN b IS NULL OR b = 0 THEN 0 ELSE a / b END, 4) AS ratio_or_zero,
           round(CASE WHEN b <> 0 THEN (coalesce(a, 0) - b) / b * 100 END, 4) AS change, coalesce(a, b, 0) AS first,
           CASE WHEN b > 0 THEN 'up' WHEN b < 0 THEN 'down' WHEN b = 0 THEN 'flat' END AS trend,
           coalesce(b, 0) = 0 AS zero_or_blank, (b IS NOT NULL AND b <> 0) AS usable, CASE WHEN a > 10 THEN 'large' ELSE 'small' END AS size
    FROM x
    """,
)
def blank_arithmetic(spark, sf_dir):
    a, b = F.col("a"), F.col("b")
    df = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_returnflag") == "A", F.col("l_quantity")).alias("a"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity") - 25).alias("b"),
    )
    return rounded(df.select(
        "l_orderkey", "l_linenumber", "l_partkey", blank.add(a, b).alias("added"), blank.sub(a, b).alias("subtracted"),
        blank.mul(a, b).alias("product"), blank.safe_div(a, b).alias("ratio"), blank.safe_div(a, b, 0).alias("ratio_or_zero"),
        blank.pct_change(a, b).alias("change"), blank.first_non_blank(a, b, F.lit(0.0)).alias("first"),
        blank.trend_sign(b).alias("trend"), blank.equals_blank_as_zero(b, 0).alias("zero_or_blank"),
        blank.not_blank_or_zero(b).alias("usable"), blank.iff(a > 10, F.lit("large"), F.lit("small")).alias("size"),
    ))
