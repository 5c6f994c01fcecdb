"""Declared types of the 14 operational source tables.

The source models never declare types; these are this engine's decisions.
Money and hours are decimals so sums are exact and order-independent. The
high-volume event dates (time entries, expenses, deliverable due dates) are
DATE; the project's dates and timestamps arrive as text and are parsed by
staging (strictly or leniently, as in the source models). Staging parses any
date column that arrives as text, so either form is accepted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, I, S, D = T.LongType(), T.IntegerType(), T.StringType(), T.DateType()
MONEY = T.DecimalType(18, 2)
MONEY4 = T.DecimalType(18, 4)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "businessunit": _schema(("businessunitID", L), ("business_unit_name", S)),
    "client": _schema(("CLIENTID", L), ("CLIENT_NAME", S), ("PHONE_NUMBER", S), ("EMAIL", S)),
    "client_feedback": _schema(("RESPONSE_ID", L), ("CLIENT_ID", L), ("PROJECT_ID", L),
                               ("OVERALL_SATISFACTION", I)),
    "consultant": _schema(("ConsultantID", L), ("BusinessUnitID", L), ("First_Name", S),
                          ("Last_Name", S), ("Contact", S)),
    "consultant_deliverable": _schema(("consultantid", L), ("deliverableid", L), ("recordid", L),
                                      ("hours", MONEY), ("DATE", D)),
    "consultant_title_history": _schema(("RECORDID", L), ("CONSULTANTID", L), ("TITLEID", L),
                                        ("START_DATE", S), ("LAST_UPDATE", S)),
    "deliverable": _schema(("DELIVERABLEID", L), ("PROJECTID", L), ("NAME", S), ("PRICE", MONEY),
                           ("DUE_DATE", D)),
    "indirect_cost": _schema(("business_unit_id", L), ("yearmonth", I),
                             ("non_proj_labor_costs", MONEY), ("other_expense_costs", MONEY4)),
    "non_billable_hours": _schema(("consultantid", L), ("BILLABLE HOURS", MONEY),
                                  ("TABLE NONBILLABLEHOURS", MONEY), ("yearmonth", I)),
    "payroll": _schema(("RECORDID", L), ("AMOUNT", MONEY), ("CONSULTANTID", L), ("payment_date", S)),
    "project": _schema(("projectID", L), ("created_at", S), ("clientID", L), ("unitID", L),
                       ("name", S), ("type", S), ("price", MONEY), ("estimated_budget", S),
                       ("planned_hours", S), ("planned_start_date", S), ("planned_end_date", S),
                       ("status", S), ("actual_start_date", S), ("actual_end_date", S),
                       ("progress", T.DecimalType(5, 2)), ("last_update", S)),
    "project_billing_rate": _schema(("RATE", MONEY), ("TITLEID", L), ("PROJECTID", L)),
    "project_expense": _schema(("recordid", L), ("projectid", L), ("amount", MONEY4), ("date", D),
                               ("is_billable", I)),
    "title": _schema(("titleid", L), ("title_name", S)),
}



# Date columns may be stored as text; staging parses it.
def _accepted(declared: T.DataType, stored: T.DataType) -> bool:
    return stored == declared or (isinstance(declared, T.DateType) and isinstance(stored, T.StringType))


class SchemaMismatch(ValueError):
    pass


def conform(name: str, df: DataFrame, strict: bool = True) -> DataFrame:
    """Select the declared columns of source ``name`` in declared order and types.

    Missing columns fail early. With ``strict`` a column whose type differs
    also fails (a date stored as text does not: it stays text); otherwise it is
    cast. Extra columns are dropped (pruned from
    the scan by Catalyst).
    """
    schema = SOURCE_SCHEMAS[name]
    have = {f.name.lower(): f for f in df.schema.fields}
    cols = []
    for field in schema.fields:
        got = have.get(field.name.lower())
        if got is None:
            raise SchemaMismatch(f"{name}: missing column {field.name!r}")
        col = F.col(f"`{got.name}`")
        if not _accepted(field.dataType, got.dataType):
            if strict:
                raise SchemaMismatch(
                    f"{name}.{field.name}: {got.dataType.simpleString()} != "
                    f"{field.dataType.simpleString()}")
            col = col.cast(field.dataType)
        cols.append(col.alias(field.name))
    return df.select(*cols)


def read_source(spark, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Read one source and conform it. Formats that store their types are read
    with them; others with the declared schema, dates as text."""
    reader = spark.read.format(fmt)
    if fmt not in ("parquet", "orc"):
        reader = reader.schema(T.StructType([
            T.StructField(f.name, S if isinstance(f.dataType, T.DateType) else f.dataType)
            for f in SOURCE_SCHEMAS[name].fields]))
    return conform(name, reader.load(path))


def read_sources(spark, root: str, fmt: str = "parquet", paths: dict[str, str] | None = None):
    """The source registry: all 14 operational tables under ``root/<name>``
    (or at ``paths[name]``), each read lazily with its declared schema."""
    from practica.sources.tables import Sources

    def reader(name):
        path = (paths or {}).get(name, f"{root.rstrip('/')}/{name}")
        return lambda: read_source(spark, name, path, fmt)
    return Sources(**{name: reader(name) for name in SOURCE_SCHEMAS})
