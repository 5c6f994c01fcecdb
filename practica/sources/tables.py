"""Containers for the source and staged relations passed between builders.

Fields may be given as DataFrames or as zero-argument callables; a callable
is invoked on first access and its result kept, so a builder that reads two
relations never plans the other twelve.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame


class _Lazy:
    def __getattribute__(self, name):
        v = object.__getattribute__(self, name)
        if callable(v) and not isinstance(v, DataFrame) and name in type(self).__dataclass_fields__:
            v = v()
            object.__setattr__(self, name, v)
        return v

    def replace(self, **kw):
        """Copy with some relations replaced, without planning the others."""
        d = {f.name: object.__getattribute__(self, f.name) for f in fields(self)}
        d.update(kw)
        return type(self)(**d)


class LazyDict(dict):
    """dict whose callable values are invoked (once) on first lookup."""

    def __getitem__(self, key):
        v = super().__getitem__(key)
        if callable(v) and not isinstance(v, DataFrame):
            v = v()
            super().__setitem__(key, v)
        return v


@dataclass
class Sources(_Lazy):
    businessunit: DataFrame
    client: DataFrame
    client_feedback: DataFrame
    consultant: DataFrame
    consultant_deliverable: DataFrame
    consultant_title_history: DataFrame
    deliverable: DataFrame
    indirect_cost: DataFrame
    non_billable_hours: DataFrame
    payroll: DataFrame
    project: DataFrame
    project_billing_rate: DataFrame
    project_expense: DataFrame
    title: DataFrame

    def items(self):
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


@dataclass
class Staged(_Lazy):
    businessunit: DataFrame
    client: DataFrame
    client_feedback: DataFrame
    consultant: DataFrame
    time_entry: DataFrame
    title_assignment: DataFrame
    deliverable: DataFrame
    indirect_cost: DataFrame
    non_billable_hours: DataFrame
    payroll: DataFrame
    project: DataFrame
    billing_rate: DataFrame
    project_expense: DataFrame
    title: DataFrame

    def items(self):
        return [(f.name, getattr(self, f.name)) for f in fields(self)]
