"""Adapter: the driver's TPC-H-style test tables -> the 14 operational sources.

The test harness ships ``region nation customer supplier part orders
lineitem ...`` parquet files. This module derives each operational source
from them with plain column expressions, joins and aggregations, so every
query's work grows with the input. ``practica.oracle.sources_sql`` is the
DuckDB twin of every expression here; keep the two in step.

Only the columns each source needs are selected, so the parquet scans are
pruned (``ReadSchema``) and key filters are pushed down.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from practica.sources.schemas import MONEY, MONEY4, conform
from practica.sources.tables import Sources

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")

# Fixed values of the mapping (shared with the DuckDB twin).
PHONE_PREFIX = "555-"
EMAIL_DOMAIN = "@example.com"
TITLE_EPOCH = dt.date(1995, 1, 1)
SECOND_TITLE_EPOCH = dt.date(1998, 1, 1)
SECOND_TITLE_OFFSET = 1_000_000
PAYMENT_DATE = "2001-12-31"


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _d(c) -> F.Column:
    return F.to_date(c)


def _txt_date(c) -> F.Column:
    """date -> 'yyyy-MM-dd' text, the form the sources carry."""
    return c.cast("string")


def _yearmonth(c) -> F.Column:
    return (F.year(c) * 100 + F.month(c)).cast("int")


def _deliverable_id(orderkey, linenumber) -> F.Column:
    return (orderkey * 10 + linenumber).cast("long")


def businessunit(nation: DataFrame) -> DataFrame:
    return conform("businessunit", nation.select(
        F.col("n_nationkey").cast("long").alias("businessunitID"),
        F.col("n_name").alias("business_unit_name")))


def client(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    phone = F.concat(F.lit(PHONE_PREFIX), F.lpad((k % 10000).cast("string"), 4, "0"),
                     F.when(k % 10 == 0, F.lit(" bad#")).otherwise(F.lit("")))
    email = F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                     F.when(k % 7 == 0, F.lit("")).otherwise(F.lit(EMAIL_DOMAIN)))
    return conform("client", customer.select(
        k.alias("CLIENTID"), F.col("c_name").alias("CLIENT_NAME"),
        phone.alias("PHONE_NUMBER"), email.alias("EMAIL")))


def consultant(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    contact = (
        F.when(k % 9 == 0, F.concat(F.lit("ext "), k.cast("string")))
        .otherwise(F.concat(F.lit("+1 (555) "), F.lpad((k % 10000).cast("string"), 4, "0"),
                            F.when(k % 4 == 0, F.concat(F.lit(" x"), (k % 100).cast("string")))
                            .otherwise(F.lit(""))))
    )
    return conform("consultant", supplier.select(
        k.alias("ConsultantID"),
        F.col("s_nationkey").cast("long").alias("BusinessUnitID"),
        F.substring_index("s_name", "#", 1).alias("First_Name"),
        F.substring_index("s_name", "#", -1).alias("Last_Name"),
        contact.alias("Contact")))


def title(region: DataFrame) -> DataFrame:
    return conform("title", region.select(
        F.col("r_regionkey").cast("long").alias("titleid"), F.col("r_name").alias("title_name")))


def consultant_title_history(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    first = supplier.select(
        k.alias("RECORDID"), k.alias("CONSULTANTID"), (k % 5).alias("TITLEID"),
        _txt_date(F.date_add(F.lit(TITLE_EPOCH), k.cast("int"))).alias("START_DATE"),
        F.when(k % 2 == 0, F.lit(None).cast("string"))
        .otherwise(_txt_date(F.date_add(F.lit(TITLE_EPOCH), (k + 400).cast("int"))))
        .alias("LAST_UPDATE"))
    second = supplier.filter(k % 3 == 0).select(
        (k + SECOND_TITLE_OFFSET).alias("RECORDID"), k.alias("CONSULTANTID"),
        ((k + 2) % 5).alias("TITLEID"),
        _txt_date(F.date_add(F.lit(SECOND_TITLE_EPOCH), k.cast("int"))).alias("START_DATE"),
        F.lit(None).cast("string").alias("LAST_UPDATE"))
    return conform("consultant_title_history", first.unionByName(second))


def project(orders: DataFrame, customer: DataFrame) -> DataFrame:
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    c = customer.select("c_custkey", "c_nationkey")
    k = F.col("o_orderkey")
    day = _d(F.col("o_orderdate"))
    st = F.col("o_orderstatus")
    price = F.col("o_totalprice").cast(MONEY)
    start_shift = (k % 15).cast("int")
    status = (F.when((st == "F") & (k % 13 == 0), F.lit(" completed "))
              .when(st == "F", F.lit("Completed"))
              .when(st == "O", F.lit("Active"))
              .when(st == "P", F.lit(" on hold ")))
    ptype = (F.when(k % 211 == 0, F.lit(" Retainer "))
             .when(k % 2 == 0, F.lit("Fixed"))
             .otherwise(F.lit("Time and Material")))
    progress = (F.when(st == "F", F.lit(100)).when(st == "O", k % 100)
                .when(st == "P", F.lit(0))).cast("decimal(5,2)")
    last_update = F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(_txt_date(F.date_add(day, (k % 120).cast("int"))), F.lit(" "),
                 F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":15:30")))
    df = o.join(c, o.o_custkey == c.c_custkey, "left").select(
        k.alias("projectID"),
        F.col("o_orderdate").cast("string").alias("created_at"),
        F.col("o_custkey").alias("clientID"),
        F.col("c_nationkey").cast("long").alias("unitID"),
        F.concat(F.lit(" Project "), k.cast("string"), F.lit(" ")).alias("name"),
        ptype.alias("type"),
        price.alias("price"),
        F.when(k % 11 == 0, F.lit("n/a")).otherwise(price.cast("string")).alias("estimated_budget"),
        F.concat((k % 400).cast("string"), F.when(k % 9 == 0, F.lit(".5")).otherwise(F.lit("")))
        .alias("planned_hours"),
        _txt_date(day).alias("planned_start_date"),
        _txt_date(F.date_add(day, 90)).alias("planned_end_date"),
        status.alias("status"),
        F.when(st == "P", F.lit(None).cast("string"))
        .otherwise(_txt_date(F.date_add(day, start_shift))).alias("actual_start_date"),
        F.when(st == "F", _txt_date(F.date_add(day, start_shift + 80)))
        .otherwise(F.lit(None).cast("string")).alias("actual_end_date"),
        progress.alias("progress"),
        last_update.alias("last_update"),
    )
    return conform("project", df)


KEYED_PARTS = 8     # of deliverables whose keys a task holds, for each split of their scan


def deliverable(lineitem: DataFrame, keyed: bool = False) -> DataFrame:
    """Dealt by order, so neither this grouping nor one or a join by project moves
    rows again. ``keyed``: for histories, dimensions and checks, whose tasks hold
    every deliverable's key. Adaptive execution joins parts by their packed bytes,
    which such narrow rows have few of, into tasks of millions of keys; a number of
    parts that grows with the splits of the scan keeps a task's keys few."""
    if keyed:
        dealt = lineitem.repartition(KEYED_PARTS * lineitem.rdd.getNumPartitions(), "l_orderkey")
    else:
        dealt = lineitem.repartition("l_orderkey")
    agg = dealt.groupBy("l_orderkey", "l_linenumber").agg(
        F.sum(F.col("l_extendedprice").cast(MONEY)).alias("price"),
        F.max("l_shipdate").alias("due"))
    did = _deliverable_id(F.col("l_orderkey"), F.col("l_linenumber"))
    return conform("deliverable", agg.select(
        did.alias("DELIVERABLEID"), F.col("l_orderkey").alias("PROJECTID"),
        F.concat(F.lit("Deliverable "), did.cast("string")).alias("NAME"),
        F.col("price").cast(MONEY).alias("PRICE"),
        _d(F.col("due")).alias("DUE_DATE")))


def consultant_deliverable(lineitem: DataFrame) -> DataFrame:
    did = _deliverable_id(F.col("l_orderkey"), F.col("l_linenumber"))
    return conform("consultant_deliverable", lineitem.select(
        F.col("l_suppkey").alias("consultantid"), did.alias("deliverableid"),
        did.alias("recordid"), F.col("l_quantity").cast(MONEY).alias("hours"),
        _d(F.col("l_shipdate")).alias("DATE")))


def project_expense(lineitem: DataFrame) -> DataFrame:
    did = _deliverable_id(F.col("l_orderkey"), F.col("l_linenumber"))
    amount = (F.col("l_extendedprice").cast(MONEY) * F.col("l_discount").cast(MONEY)).cast(MONEY4)
    return conform("project_expense", lineitem.select(
        did.alias("recordid"), F.col("l_orderkey").alias("projectid"), amount.alias("amount"),
        _d(F.col("l_shipdate")).alias("date"),
        F.when(F.col("l_returnflag") == "R", F.lit(1)).otherwise(F.lit(0)).cast("int")
        .alias("is_billable")))


def payroll(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    first = supplier.select((k * 10 + 1).alias("RECORDID"),
                            (F.lit(20) + k % 30).cast(MONEY).alias("AMOUNT"),
                            k.alias("CONSULTANTID"), F.lit(PAYMENT_DATE).alias("payment_date"))
    second = supplier.filter(k % 4 == 0).select(
        (k * 10 + 2).alias("RECORDID"), F.lit(5).cast(MONEY).alias("AMOUNT"),
        k.alias("CONSULTANTID"), F.lit(PAYMENT_DATE).alias("payment_date"))
    return conform("payroll", first.unionByName(second))


def project_billing_rate(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    rated = orders.select("o_orderkey").filter(k % 17 != 0)
    first = F.struct((F.lit(50) + k % 50).cast(MONEY).alias("RATE"), (k % 5).alias("TITLEID"))
    second = F.struct(F.lit(75).cast(MONEY).alias("RATE"), ((k + 1) % 5).alias("TITLEID"))
    # one reading of the orders gives both rates
    rates = rated.select(k.alias("PROJECTID"), F.inline(F.when(k % 3 == 0, F.array(first, second)).otherwise(F.array(first))))
    return conform("project_billing_rate", rates)


def non_billable_hours(lineitem: DataFrame) -> DataFrame:
    agg = lineitem.groupBy(F.col("l_suppkey"), _yearmonth(F.col("l_shipdate")).alias("yearmonth")).agg(
        F.sum(F.col("l_quantity").cast(MONEY)).alias("q"), F.sum("l_linenumber").alias("n"))
    return conform("non_billable_hours", agg.select(
        F.col("l_suppkey").alias("consultantid"),
        (F.col("q") * 60).cast(MONEY).alias("BILLABLE HOURS"),
        (F.col("n") * 60).cast(MONEY).alias("TABLE NONBILLABLEHOURS"),
        F.col("yearmonth")))


def indirect_cost(orders: DataFrame, customer: DataFrame) -> DataFrame:
    o = orders.select("o_custkey", "o_totalprice", "o_orderdate")
    c = customer.select("c_custkey", "c_nationkey")
    agg = (o.join(c, o.o_custkey == c.c_custkey, "inner")
           .groupBy(F.col("c_nationkey"), _yearmonth(F.col("o_orderdate")).alias("yearmonth"))
           .agg(F.count(F.lit(1)).alias("n"),
                F.sum(F.col("o_totalprice").cast(MONEY)).alias("total")))
    return conform("indirect_cost", agg.select(
        F.col("c_nationkey").cast("long").alias("business_unit_id"), F.col("yearmonth"),
        (F.col("n") * 100).cast(MONEY).alias("non_proj_labor_costs"),
        (F.col("total") * F.lit(0.01).cast("decimal(3,2)")).cast(MONEY4).alias("other_expense_costs")))


def client_feedback(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return conform("client_feedback", orders.filter(F.col("o_orderstatus") == "F").select(
        k.alias("RESPONSE_ID"), F.col("o_custkey").alias("CLIENT_ID"), k.alias("PROJECT_ID"),
        (F.lit(1) + k % 5).cast("int").alias("OVERALL_SATISFACTION")))


def sources_from_driver(spark: SparkSession, sf_dir: str) -> Sources:
    """All 14 operational sources derived lazily from the driver tables."""
    cache: dict[str, DataFrame] = {}

    def t(name):
        # one reader per table: file listing and footer reads happen once
        if name not in cache:
            cache[name] = read_driver(spark, sf_dir, name)
        return cache[name]
    return Sources(
        businessunit=lambda: businessunit(t("nation")),
        client=lambda: client(t("customer")),
        client_feedback=lambda: client_feedback(t("orders")),
        consultant=lambda: consultant(t("supplier")),
        consultant_deliverable=lambda: consultant_deliverable(t("lineitem")),
        consultant_title_history=lambda: consultant_title_history(t("supplier")),
        deliverable=lambda: deliverable(t("lineitem")),
        indirect_cost=lambda: indirect_cost(t("orders"), t("customer")),
        non_billable_hours=lambda: non_billable_hours(t("lineitem")),
        payroll=lambda: payroll(t("supplier")),
        project=lambda: project(t("orders"), t("customer")),
        project_billing_rate=lambda: project_billing_rate(t("orders")),
        project_expense=lambda: project_expense(t("lineitem")),
        title=lambda: title(t("region")),
    )
