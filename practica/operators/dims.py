"""Mart dimensions over the SCD2 histories.

Every dimension key is surrogate_key(natural id, ts_to_key(valid_from)), so a
key names one version. ``current`` keeps the open versions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from practica.functions.keys import surrogate_key, ts_to_key
from practica.operators.scd2 import VALID_FROM, VALID_TO, intersect_validity, overlaps
from practica.semantics import Semantics


def _version_key(id_col: str) -> F.Column:
    return surrogate_key(F.col(id_col), ts_to_key(F.col(VALID_FROM)))


def current(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col(VALID_TO).isNull())


def versions(dim: DataFrame, sem: Semantics) -> DataFrame:
    """The dimension rows a fact joins: open ones, or all under dim_version=all."""
    return current(dim) if sem.dim_version == "current" else dim


def business_unit_dim(history: DataFrame, key_name: str = "unitkey") -> DataFrame:
    return history.select(_version_key("business_unit_id").alias(key_name),
                          F.col("business_unit_id").alias("unitid"),
                          F.col("business_unit_name").alias("name"), VALID_FROM, VALID_TO)


def client_dim(history: DataFrame) -> DataFrame:
    return history.select(_version_key("client_id").alias("client_key"), "client_id", "client_name",
                          "phone_number", "email", VALID_FROM, VALID_TO)


def consultant_dim(history: DataFrame) -> DataFrame:
    # the business unit is versioned in the history but not exposed here
    return history.select(_version_key("consultant_id").alias("consultant_key"), "consultant_id",
                          "first_name", "last_name", "contact", VALID_FROM, VALID_TO)


def project_dim(history: DataFrame) -> DataFrame:
    return history.select(_version_key("project_id").alias("project_key"), "project_id",
                          F.col("project_type").alias("type"), "price", "planned_start_date",
                          "planned_end_date", VALID_FROM, VALID_TO)


def _paired_history(left: DataFrame, right: DataFrame, left_fk: str, right_id: str,
                    overlap_only: bool) -> DataFrame:
    """left ⟕ right on the natural id, validity intersected.

    With ``overlap_only`` the join also requires the two versions to overlap,
    so pairs that never coexisted are not emitted; unmatched left rows stay
    (their validity is the left one).
    """
    l = left.withColumnRenamed(VALID_FROM, "l_from").withColumnRenamed(VALID_TO, "l_to")
    r = right.withColumnRenamed(VALID_FROM, "r_from").withColumnRenamed(VALID_TO, "r_to")
    cond = l[left_fk] == r[right_id]
    if overlap_only:
        cond = cond & overlaps(l["l_from"], l["l_to"], r["r_from"], r["r_to"])
    j = l.join(r, cond, "left")
    vf, vt = intersect_validity(F.col("l_from"), F.col("l_to"), F.col("r_from"), F.col("r_to"))
    return j.withColumn(VALID_FROM, vf).withColumn(VALID_TO, vt)


def deliverable_dim(deliverable_history: DataFrame, project_history: DataFrame,
                    sem: Semantics = Semantics()) -> DataFrame:
    d = deliverable_history.select("deliverable_id", "project_id", "name", "due_date",
                                   VALID_FROM, VALID_TO)
    p = project_history.select(F.col("project_id").alias("p_project_id"),
                               F.col("project_name").alias("projectname"),
                               F.col("project_type").alias("projecttype"), VALID_FROM, VALID_TO)
    j = _paired_history(d, p, "project_id", "p_project_id", sem.overlap_only)
    return j.select(_version_key("deliverable_id").alias("deliverable_key"), "deliverable_id",
                    "project_id", "name", F.col("due_date").alias("duedate"), "projectname",
                    "projecttype", VALID_FROM, VALID_TO)


def title_history_dim(assignment_history: DataFrame, title_history: DataFrame,
                      sem: Semantics = Semantics()) -> DataFrame:
    a = assignment_history.select("record_id", "consultant_id", "title_id", "start_date", "end_date",
                                  VALID_FROM, VALID_TO)
    t = title_history.select(F.col("title_id").alias("t_title_id"), F.col("title_name").alias("title"),
                             VALID_FROM, VALID_TO)
    j = _paired_history(a, t, "title_id", "t_title_id", sem.overlap_only)
    return j.select(_version_key("record_id").alias("titlehistory_key"),
                    F.col("record_id").alias("id"), "consultant_id", "title_id", "title",
                    F.col("start_date").alias("startdate"), F.col("end_date").alias("enddate"),
                    VALID_FROM, VALID_TO)
