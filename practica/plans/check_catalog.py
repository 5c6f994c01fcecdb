"""The declared data tests of every mart, as data.

One entry per declared test: (relation, column, test, argument). The
relation names are the marts' own; ``relations(...)`` maps them to
DataFrames. Repairs applied (SURVEY §2.13 nos. 18-20): misspelled or
undefined test names are mapped to the check they name (``not null`` ->
not_null, ``testing_revenue_received`` -> non_negative, the misspelled
end-after-start test -> end_after_start_or_null); the phone/e-mail tests run
on the client dimension; HR fact columns are checked on the relation of the
split fact that carries them; ``title_dim`` is never defined and is skipped.

Tests: not_null, unique, accepted (argument: values), relationship
(argument: (parent relation, parent column)), between_0_and_100,
non_negative, end_after_start_or_null (argument: start column),
end_strictly_after_start (argument: start column), price_non_negative,
phone_pattern, email_pattern.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from practica.operators import quality as q

DATE_ATTRS = ("year", "quarter", "month", "month_name", "day_name", "day_of_week", "week", "is_weekend")
TYPES = ("Fixed", "Time and Material")
FLAGS = (0, 1)


def _nn(rel, *cols):
    return [(rel, c, "not_null", None) for c in cols]


# The declared tests, in the marts' order.
CATALOG: list[tuple[str, str, str, object]] = [
    # business development mart: dimensions
    *_nn("bd_date_dim", "date", *DATE_ATTRS), ("bd_date_dim", "date", "unique", None),
    ("bd_business_unit_dim", "business_unit_key", "unique", None),
    *_nn("bd_business_unit_dim", "business_unit_key", "unitid", "name", "valid_from"),
    *_nn("client_dim", "client_key", "client_id", "client_name", "valid_from"),
    ("client_dim", "client_key", "unique", None),
    ("client_dim", "phone_number", "phone_pattern", None),
    ("client_dim", "email", "email_pattern", None),
    # business development mart: fact
    ("business_dev_fact", "client_feedback_key", "unique", None),
    *_nn("business_dev_fact", "client_feedback_key", "client_key", "business_unit_key", "date",
         "revenue_received", "average_satisfaction", "forecasted_future_revenue"),
    ("business_dev_fact", "client_key", "relationship", ("client_dim", "client_key")),
    ("business_dev_fact", "business_unit_key", "relationship",
     ("bd_business_unit_dim", "business_unit_key")),
    ("business_dev_fact", "date", "relationship", ("bd_date_dim", "date")),
    ("business_dev_fact", "revenue_received", "non_negative", None),
    # HR mart: dimensions
    ("deliverable_dim", "deliverable_key", "unique", None),
    *_nn("deliverable_dim", "deliverable_key", "deliverable_id", "name", "valid_from"),
    ("deliverable_dim", "projecttype", "accepted", TYPES),
    ("hr_date_dim", "date", "unique", None),
    *_nn("hr_date_dim", "date", "year", "quarter", "month"),
    ("consultant_dim", "contact", "phone_pattern", None),
    # HR mart: fact (split into utilization and two bridges)
    ("hr_utilization", "HR_record_key", "unique", None),
    *_nn("hr_utilization", "HR_record_key", "consultant_key", "business_unit_key", "date",
         "titlehistory_key"),
    ("hr_utilization", "consultant_key", "relationship", ("consultant_dim", "consultant_key")),
    ("hr_utilization", "business_unit_key", "relationship", ("businessunit_dim", "unitkey")),
    ("hr_utilization", "date", "relationship", ("hr_date_dim", "date")),
    ("hr_utilization", "titlehistory_key", "relationship", ("title_history_dim", "titlehistory_key")),
    *_nn("hr_deliverable_bridge", "deliverable_key"),
    ("hr_deliverable_bridge", "deliverable_key", "relationship", ("deliverable_dim", "deliverable_key")),
    *_nn("hr_client_bridge", "client_key"),
    ("hr_client_bridge", "client_key", "relationship", ("client_dim", "client_key")),
    # project management mart: dimensions
    *_nn("project_dim", "project_key", "project_id", "planned_start_date"),
    ("project_dim", "project_key", "unique", None),
    ("project_dim", "type", "accepted", TYPES),
    ("project_dim", "price", "price_non_negative", None),
    ("project_dim", "planned_end_date", "end_strictly_after_start", "planned_start_date"),
    ("project_dim", "planned_end_date", "end_after_start_or_null", "planned_start_date"),
    *_nn("businessunit_dim", "unitkey", "unitid", "name"),
    ("businessunit_dim", "unitkey", "unique", None),
    # project management mart: fact
    *_nn("project_fact", "row_key", "project_id", "project_key", "date", "percent_complete",
         "potential_problem_project"),
    ("project_fact", "row_key", "unique", None),
    ("project_fact", "project_key", "relationship", ("project_dim", "project_key")),
    ("project_fact", "client_key", "relationship", ("client_dim", "client_key")),
    ("project_fact", "business_unit_key", "relationship", ("businessunit_dim", "unitkey")),
    ("project_fact", "date", "relationship", ("project_date_dim", "date")),
    ("project_fact", "actual_start_date_key", "relationship", ("project_date_dim", "date")),
    ("project_fact", "actual_end_date_key", "relationship", ("project_date_dim", "date")),
    ("project_fact", "percent_complete", "between_0_and_100", None),
    ("project_fact", "if_late_start_flag", "accepted", FLAGS),
    ("project_fact", "potential_problem_project", "accepted", FLAGS),
    *[("project_fact", c, "non_negative", None) for c in (
        "planned_duration_days", "actual_duration_days", "hours_spent", "project_expenses_per_month",
        "consultant_hour_costs_per_month", "total_expenses", "forecasted_cost",
        "revenue_received_per_month")],
]

ROW_TESTS = {
    "not_null": lambda r, df, c, a: q.not_null(r, df, c),
    "accepted": lambda r, df, c, a: q.accepted_values(r, df, c, list(a)),
    "between_0_and_100": lambda r, df, c, a: q.between_0_and_100(r, df, c),
    "non_negative": lambda r, df, c, a: q.non_negative(r, df, c),
    "end_after_start_or_null": lambda r, df, c, a: q.end_after_start_or_null(r, df, c, a),
    "end_strictly_after_start": lambda r, df, c, a: q.end_strictly_after_start(r, df, c, a),
    "price_non_negative": lambda r, df, c, a: q.price_non_negative(r, df, c),
    "phone_pattern": lambda r, df, c, a: q.phone_pattern(r, df, c),
    "email_pattern": lambda r, df, c, a: q.email_pattern(r, df, c),
}


def build_checks(rels: dict[str, DataFrame]) -> list:
    checks = []
    for rel, col, test, arg in CATALOG:
        df = rels[rel]
        if test == "unique":
            checks.append(q.unique(rel, df, col))
        elif test == "relationship":
            parent, pcol = arg
            checks.append(q.relationships(rel, df, col, rels[parent], pcol))
        else:
            checks.append(ROW_TESTS[test](rel, df, col, arg))
    return checks


def run_catalog(rels: dict[str, DataFrame]) -> DataFrame:
    """(check, relation, column_name, failures) for every declared test."""
    return q.summarize(build_checks(rels))
