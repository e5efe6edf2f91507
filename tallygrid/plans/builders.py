"""Dimensions and facts built from staged tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallygrid.functions.text import strip_word
from tallygrid.operators.columns import cast_columns, rename, select_columns, with_const, with_nulls
from tallygrid.operators.filters import live_rows, where
from tallygrid.operators.joins import lookup_keys, with_date
from tallygrid.operators.nested import expand_record, expand_teams, explode_list, list_of
from tallygrid.operators.numbering import row_number_by, surrogate_key
from tallygrid.operators.sets import union_all
from tallygrid.sources.readers import POINTS_FIELD, TEAMS_FIELD, pages_to_rows

# --- fixed values: staged column > dimension column -------------------------------------------
CUSTOMER = {
    "Id": "KlantID", "Name": "KlantNaam", "Type": "KlantType", "Customer_ID__c": "Debiteurnummer", "Industry": "Branche",
}
PRACTICE = {"Id": "PracticeID", "Name": "PracticeNaam"}
SKILL = {"Id": "SkillId", "Name": "SkillNaam", "Type__c": "SkillType"}
LEAVE_TYPE = {"Type_verlof_code": "VerlofCode", "Type_verlof": "VerlofType"}
TASK = {
    "Id": "TaakregelId", "Krow__Status__c": "TaakStatus", "Krow__Task_Type__c": "TaakType", "Name": "TaakNaam",
    "Krow__Project_Task_Order__c": "Taakregel", "Krow__Billable__c": "IsFacturabel",
    "Krow__Task_Start_Date__c": "Begindatum", "Krow__Task_Due_Date__c": "Einddatum",
    "Krow__Completion_Date__c": "DatumAfgerond", "Krow__Total_Hours_Logged__c": "TotaalGeschrevenUren",
    "Krow__Estimated_Hours__c": "TotaalGeschatteUren",
}
TASK_EMPTY = {"DirectIndirect": "string", "Uurtype": "string", "IsVooruitbetaald": "int"}
TASK_COLUMNS = [
    "TaakregelKey", "TaakregelId", "TaakStatus", "TaakType", "TaakNaam", "Taakregel", "IsFacturabel", "DirectIndirect",
    "Uurtype", "Begindatum", "Einddatum", "DatumAfgerond", "IsVooruitbetaald", "TotaalGeschrevenUren",
    "TotaalGeschatteUren", "Taakvolgorde", "ProjectKey", "KlantKey",
]
SATISFACTION = {
    "Name": "ProjectNaam", "Krow__Project_Number__c": "ProjectNummer", "CSAT_Score__c": "Score",
    "LastModifiedDate": "Scoredatum", "Krow__Project_Status__c": "ProjectStatus",
    "Krow__Completion_Date__c": "CompletionDate",
}
SATISFACTION_COLUMNS = [
    "RowNum", "Id", "ProjectNaam", "ProjectNummer", "Score", "Scoredatum", "ProjectStatus", "CompletionDate",
    "ProjectKey", "PracticeKey", "TeamKey", "KlantKey", "DatumKey",
]
ISSUE_FIELDS = {
    "id": "issue.id", "key": "issue.key", "fields.summary": "summary", f"fields.{POINTS_FIELD}": "StoryPoints",
    "fields.status.name": "status.name", "fields.status.id": "status.id", "fields.priority.name": "priority.name",
    "fields.priority.id": "priority.id", "fields.project.id": "project.id", "fields.project.key": "project.key",
    "fields.project.name": "project.name", "fields.creator.displayName": "creator.displayName",
    "fields.reporter.displayName": "reporter.displayName", "fields.assignee.displayName": "assignee.displayName",
    "fields.sprint.originBoardId": "sprint.originBoardId", "fields.sprint.name": "sprint.fullname",
    f"fields.{TEAMS_FIELD}": "teams",
}
# --------------------------------------------------------------------------------------------


def _dimension(staged: DataFrame, columns: dict[str, str], key: str, order: Sequence[str]) -> DataFrame:
    named = rename(select_columns(staged, list(columns)), columns)
    return select_columns(surrogate_key(named, order, key), [key, *columns.values()])


def build_dim_customer(account: DataFrame) -> DataFrame:
    return _dimension(account, CUSTOMER, "KlantKey", ["KlantID"])


def build_dim_practice(practice: DataFrame) -> DataFrame:
    return _dimension(practice, PRACTICE, "PracticeKey", ["PracticeID"])


def build_dim_skill(skill: DataFrame) -> DataFrame:
    return _dimension(skill, SKILL, "SkillKey", ["SkillId"])


def build_dim_leave_type(leave_type: DataFrame) -> DataFrame:
    return _dimension(leave_type, LEAVE_TYPE, "VerloftypeKey", ["VerlofCode"])


def build_dim_task(task: DataFrame, projects: DataFrame, customers: DataFrame) -> DataFrame:
    """Tasks with the keys of their project and customer, numbered by name.

    Names repeat, so the task id breaks ties.
    """
    found = lookup_keys(task, projects, {"Krow__Project__c": "ProjectId"}, "ProjectKey")
    found = lookup_keys(found, customers, {"Krow__Account__c": "KlantID"}, "KlantKey")
    named = rename(found, TASK).withColumn("Taakvolgorde", F.col("Taakregel"))
    numbered = surrogate_key(with_nulls(named, TASK_EMPTY), ["TaakNaam", "TaakregelId"], "TaakregelKey")
    return select_columns(numbered, TASK_COLUMNS)


def build_fact_satisfaction(
    project: DataFrame, projects: DataFrame, practices: DataFrame, teams: DataFrame, customers: DataFrame, days: DataFrame
) -> DataFrame:
    """Scores of live projects with the keys of five dimensions, each version numbered."""
    scored = live_rows(project, "CSAT_Score__c", "IsDeleted")
    found = lookup_keys(scored, projects, {"Id": "ProjectId"}, "ProjectKey")
    found = lookup_keys(found, practices, {"Krow__Practice__c": "PracticeID"}, "PracticeKey")
    found = lookup_keys(found, teams, {"Team__c": "Id"}, "TeamKey")
    found = lookup_keys(found, customers, {"Krow__Account__c": "KlantID"}, "KlantKey")
    found = with_date(found, "LastModifiedDate", days, ["DatumKey"])
    order = ["LastModifiedDate", "Krow__Project_Number__c", "CSAT_Score__c"]  # a total order: reruns agree
    numbered = row_number_by(found, ["Id"], order)
    return select_columns(rename(numbered, SATISFACTION), SATISFACTION_COLUMNS)


def build_fact_sprint_issue(*boards: tuple[int, DataFrame]) -> DataFrame:
    """Issues of one or more boards: pages to rows, records to columns, one row per team.

    Story points repeat for every team of an issue, as in the board it serves.
    """
    frames = []
    for board, pages in boards:
        issues = expand_record(pages_to_rows(pages), "issue", ISSUE_FIELDS)
        sprints = {"id": "sprint.id", "self": "sprint.self", "name": "sprint.name"}
        frames.append(with_const(expand_record(issues, "sprint", sprints), "BoardId", board))
    flat = union_all(frames).drop("startAt", "total")
    return cast_columns(expand_teams(flat, "teams"), {"StoryPoints": "double"})


def build_dim_status(pages: DataFrame) -> DataFrame:
    names = pages.select(list_of(F.col("issues"), "fields.status.name").alias("Status"))
    return where(explode_list(names, "Status"), "Status is not null").distinct()


def build_dim_project(issues: DataFrame) -> DataFrame:
    """Projects that occur on the board."""
    columns = {"project.id": "Column1.id", "project.key": "Column1.key", "project.name": "Column1.name"}
    return rename(select_columns(issues, list(columns)), columns).distinct()


def build_dim_sprint(pages: DataFrame, board: int, foreign_board: int) -> DataFrame:
    """Sprints of a board, without those that another board owns and without nameless ones."""
    fields = ["id", "self", "state", "name", "startDate", "endDate", "createdDate", "originBoardId", "goal"]
    rows = explode_list(pages, "values")
    flat = expand_record(rows, "values", {f: f for f in fields})
    own = with_const(flat, "BoardId", board).filter(~F.col("originBoardId").eqNullSafe(F.lit(foreign_board)))
    typed = cast_columns(own, {c: "timestamp" for c in ("startDate", "endDate", "createdDate")})
    named = where(rename(typed, {"state": "SprintStatus", "name": "SprintName"}), "SprintName is not null")
    return named.withColumn("NaamZonderSprint", strip_word(F.col("SprintName"), "Sprint"))


def build_budget(*sources: DataFrame) -> DataFrame:
    """Employee budget in days, stacked from sources that name it ``Aantal dagen``."""
    types = {"medewerker": "string", "datumweek": "date", "Begroting": "double"}
    return union_all([
        select_columns(cast_columns(rename(s, {"Aantal dagen": "Begroting"}), types), list(types)) for s in sources
    ])
