"""Typed staging: rename, trim, parse. One narrow projection per source.

Staging is lazy (the source models are views): each function returns a
projection that Catalyst fuses into whatever reads it, so pruned columns never
leave the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from practica.sources.tables import Sources, Staged


def _date(df: DataFrame, col: str, fmt: str | None = None) -> F.Column:
    """to_date for text columns; a DATE column passes through unparsed."""
    c = F.col(f"`{col}`")
    if isinstance(df.schema[col].dataType, T.DateType):
        return c
    return F.to_date(c, fmt) if fmt else F.to_date(c)


def _try_cast(col: str, to: str) -> F.Column:
    # lenient parse: bad or empty text -> NULL (the try_to_* family)
    return F.expr(f"try_cast(`{col}` as {to})")


def stage_businessunit(df: DataFrame) -> DataFrame:
    return df.select(F.col("businessunitID").alias("business_unit_id"),
                     F.col("business_unit_name"))


def stage_client(df: DataFrame) -> DataFrame:
    return df.select(F.col("CLIENTID").alias("client_id"), F.col("CLIENT_NAME").alias("client_name"),
                     F.col("PHONE_NUMBER").alias("phone_number"), F.col("EMAIL").alias("email"))


def stage_client_feedback(df: DataFrame) -> DataFrame:
    return df.select(F.col("RESPONSE_ID").alias("response_id"), F.col("CLIENT_ID").alias("client_id"),
                     F.col("PROJECT_ID").alias("project_id"),
                     F.col("OVERALL_SATISFACTION").alias("overall_satisfaction"))


def stage_consultant(df: DataFrame) -> DataFrame:
    return df.select(F.col("ConsultantID").alias("consultant_id"),
                     F.col("BusinessUnitID").alias("business_unit_id"),
                     F.col("First_Name").alias("first_name"), F.col("Last_Name").alias("last_name"),
                     F.col("Contact").alias("contact"))


def stage_time_entry(df: DataFrame) -> DataFrame:
    return df.select(F.col("consultantid").alias("consultant_id"),
                     F.col("deliverableid").alias("deliverable_id"),
                     F.col("recordid").alias("record_id"), F.col("hours"),
                     _date(df, "DATE").alias("work_date"))


def stage_title_assignment(df: DataFrame) -> DataFrame:
    # LAST_UPDATE is exposed as end_date, as in the source model
    return df.select(F.col("RECORDID").alias("record_id"), F.col("CONSULTANTID").alias("consultant_id"),
                     F.col("TITLEID").alias("title_id"), F.to_date("START_DATE").alias("start_date"),
                     F.to_date("LAST_UPDATE").alias("end_date"))


def stage_deliverable(df: DataFrame) -> DataFrame:
    return df.select(F.col("DELIVERABLEID").alias("deliverable_id"),
                     F.col("PROJECTID").alias("project_id"), F.col("NAME").alias("name"),
                     F.col("PRICE").alias("price"),
                     _date(df, "DUE_DATE", "yyyy-MM-dd").alias("due_date"))


def stage_indirect_cost(df: DataFrame) -> DataFrame:
    return df.select("business_unit_id", "yearmonth", "non_proj_labor_costs", "other_expense_costs")


def stage_non_billable_hours(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("consultantid").alias("consultant_id"),
        F.col("`BILLABLE HOURS`").alias("billable_minutes"),
        F.col("`TABLE NONBILLABLEHOURS`").alias("non_billable_minutes"),
        F.to_date(F.concat(F.col("yearmonth").cast("string"), F.lit("01")), "yyyyMMdd")
        .alias("month_start_date"))


def stage_payroll(df: DataFrame) -> DataFrame:
    return df.select(F.col("RECORDID").alias("record_id"), F.col("AMOUNT").alias("amount"),
                     F.col("CONSULTANTID").alias("consultant_id"), F.col("payment_date"))


def stage_project(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("projectID").alias("project_id"),
        _try_cast("created_at", "timestamp_ntz").alias("created_at"),
        F.col("clientID").alias("client_id"),
        F.col("unitID").alias("unit_id"),
        F.trim("name").alias("project_name"),
        F.trim("type").alias("project_type"),
        F.col("price"),
        _try_cast("estimated_budget", "double").alias("estimated_budget"),
        _try_cast("planned_hours", "decimal(38,0)").alias("planned_hours"),
        F.to_date("planned_start_date").alias("planned_start_date"),
        F.to_date("planned_end_date").alias("planned_end_date"),
        F.upper(F.trim("status")).alias("status"),
        F.to_date("actual_start_date").alias("actual_start_date"),
        F.to_date("actual_end_date").alias("actual_end_date"),
        F.col("progress").alias("percent_complete"),
        _try_cast("last_update", "timestamp_ntz").alias("last_update"),
    )


def stage_billing_rate(df: DataFrame) -> DataFrame:
    return df.select(F.col("RATE").alias("rate"), F.col("TITLEID").alias("title_id"),
                     F.col("PROJECTID").alias("project_id"))


def stage_project_expense(df: DataFrame) -> DataFrame:
    return df.select(F.col("recordid").alias("record_id"), F.col("projectid").alias("project_id"),
                     F.col("amount"), _date(df, "date").alias("expense_date"),
                     F.col("is_billable"))


def stage_title(df: DataFrame) -> DataFrame:
    return df.select(F.col("titleid").alias("title_id"), F.col("title_name"))


def stage_all(src: Sources) -> Staged:
    """Lazy: each staged relation is planned on first access."""
    return Staged(
        businessunit=lambda: stage_businessunit(src.businessunit),
        client=lambda: stage_client(src.client),
        client_feedback=lambda: stage_client_feedback(src.client_feedback),
        consultant=lambda: stage_consultant(src.consultant),
        time_entry=lambda: stage_time_entry(src.consultant_deliverable),
        title_assignment=lambda: stage_title_assignment(src.consultant_title_history),
        deliverable=lambda: stage_deliverable(src.deliverable),
        indirect_cost=lambda: stage_indirect_cost(src.indirect_cost),
        non_billable_hours=lambda: stage_non_billable_hours(src.non_billable_hours),
        payroll=lambda: stage_payroll(src.payroll),
        project=lambda: stage_project(src.project),
        billing_rate=lambda: stage_billing_rate(src.project_billing_rate),
        project_expense=lambda: stage_project_expense(src.project_expense),
        title=lambda: stage_title(src.title),
    )
