"""Data-quality checks: each check is a query for failing rows.

``Check.failures()`` returns the failing rows; ``summarize`` turns a list of
checks into one small DataFrame ``(check, relation, column_name, failures)``.
All checks that read a relation, as child or as parent, are evaluated in one pass
over it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from practica.functions.keys import packed

# Fixed patterns of the singular tests (phone/contact and e-mail). The end
# anchor is \z: Spark's $ would also accept a final newline.
PHONE_PATTERN = r"^\+?[0-9\s\-\(\)]+(x[0-9]+|ext\.?\s?[0-9]+)?\z"
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\z"


@dataclass
class RowCheck:
    """A failure predicate evaluated row by row on one relation."""
    name: str
    relation: str
    column: str
    df: DataFrame
    fails: Column

    def failures(self) -> DataFrame:
        return self.df.filter(self.fails)


@dataclass
class SetCheck:
    """A check that needs a grouping or a second relation: the keys of ``df``
    are unique, or (with ``parent``) have a row there. NULL keys are not_null's
    business."""
    name: str
    relation: str
    column: str
    df: DataFrame = field(repr=False)
    parent: DataFrame | None = field(default=None, repr=False)
    parent_column: str | None = None

    def failures(self) -> DataFrame:
        """Failing keys and how many rows hold each (``_rows``).

        Child keys are reduced to (key, rows) first, so the anti join sees one
        row per distinct key however skewed the child is."""
        keys = (self.df.filter(F.col(self.column).isNotNull()).groupBy(self.column)
                .agg(F.count(F.lit(1)).alias("_rows")))
        if self.parent is None:
            return keys.filter(F.col("_rows") > 1)
        known = (self.parent.select(F.col(self.parent_column).alias("_pk")).filter(F.col("_pk").isNotNull())
                 .distinct())
        return keys.join(known, F.col(self.column) == F.col("_pk"), "left_anti")


# ----------------------------------------------------------- row checks
def not_null(rel: str, df: DataFrame, col: str) -> RowCheck:
    return RowCheck("not_null", rel, col, df, F.col(col).isNull())


def accepted_values(rel: str, df: DataFrame, col: str, values: list) -> RowCheck:
    c = F.col(col)
    return RowCheck("accepted_values", rel, col, df, c.isNotNull() & ~c.isin(*values))


def between_0_and_100(rel: str, df: DataFrame, col: str) -> RowCheck:
    c = F.col(col)
    return RowCheck("between_0_and_100", rel, col, df, (c < 0) | (c > 100))


def non_negative(rel: str, df: DataFrame, col: str) -> RowCheck:
    return RowCheck("non_negative", rel, col, df, F.col(col) < 0)


def end_after_start_or_null(rel: str, df: DataFrame, end: str, start: str) -> RowCheck:
    e, s = F.col(end), F.col(start)
    return RowCheck("end_after_start_or_null", rel, end, df, e.isNotNull() & s.isNotNull() & (e < s))


def end_strictly_after_start(rel: str, df: DataFrame, end: str, start: str) -> RowCheck:
    e, s = F.col(end), F.col(start)
    return RowCheck("end_strictly_after_start", rel, end, df, e.isNotNull() & (e <= s))


def price_non_negative(rel: str, df: DataFrame, col: str = "price") -> RowCheck:
    return RowCheck("price_non_negative", rel, col, df, F.col(col) < 0)


def matches(rel: str, df: DataFrame, col: str, pattern: str, name: str) -> RowCheck:
    c = F.col(col)
    return RowCheck(name, rel, col, df, c.isNotNull() & ~c.rlike(pattern))


def phone_pattern(rel: str, df: DataFrame, col: str) -> RowCheck:
    return matches(rel, df, col, PHONE_PATTERN, "phone_pattern")


def email_pattern(rel: str, df: DataFrame, col: str) -> RowCheck:
    return matches(rel, df, col, EMAIL_PATTERN, "email_pattern")


# ----------------------------------------------------------- set checks
def unique(rel: str, df: DataFrame, col: str) -> SetCheck:
    """Failures are counted per duplicated key value."""
    return SetCheck("unique", rel, col, df)


def relationships(rel: str, df: DataFrame, col: str, parent: DataFrame, parent_col: str) -> SetCheck:
    """Failures are child rows whose non-NULL key has no parent row."""
    return SetCheck("relationships", rel, col, df, parent, parent_col)


# -------------------------------------------------------------- runner
def _key_sets(checks: list) -> list[dict[tuple[int, str], int]]:
    """Columns whose keys meet in some relationship, and those of unique checks:
    (relation, column) -> its place among them."""
    sets: list[list[tuple[int, str]]] = []
    for ck in checks:
        if isinstance(ck, SetCheck):
            held = [(id(ck.df), ck.column)] + ([] if ck.parent is None else [(id(ck.parent), ck.parent_column)])
            met = [s for s in sets if any(n in s for n in held)]
            sets = [s for s in sets if s not in met] + [list(dict.fromkeys([*(n for s in met for n in s), *held]))]
    return [{n: at for at, n in enumerate(s)} for s in sets]


def summarize(checks: list) -> DataFrame:
    """One row per check: (check, relation, column_name, failures bigint).

    Each relation is read once. Columns whose keys meet in a relationship share
    one set of keys: a row gives one entry (set, key, rows in each column) for
    each of its columns there, whatever the number of checks that ask for it, and
    one for every row check that it fails. One grouping by (set, key), reduced
    before the shuffle, then decides all set checks, so a hot key is one entry of a
    task."""
    sets, frames = _key_sets(checks), {}
    width = max([1, *map(len, sets)])
    counts = [f"n{at}" for at in range(width)]
    entries: dict[int, list[Column]] = {}       # keys that a row holds
    failed: dict[int, list[int]] = {}           # row checks that it may fail
    counted: dict[int, list[int]] = {}          # relations of row checks alone: counts need no grouping

    def fields(i: int, key: Column, rows: Column, at: int) -> list[Column]:
        zero = F.lit(0).cast("long")
        return [F.lit(i).alias("i"), key.alias("key"), *[(rows if n == at else zero).alias(c) for n, c in enumerate(counts)]]

    def entry(when: Column, i: int, key: Column, at: int = 0) -> Column:
        return F.when(when, F.struct(*fields(i, key, F.lit(1).cast("long"), at)))

    no_key = F.lit(None).cast("binary")

    def held(k: int) -> Column:
        """A row's entries. Most rows fail no row check and make no entries of them."""
        keys = F.array(*entries[k])
        if k not in failed:
            return keys
        any_failed = reduce(lambda a, b: a | b, [F.coalesce(checks[i].fails, F.lit(False)) for i in failed[k]])
        return F.concat(keys, F.when(any_failed, F.array(*[
            entry(checks[i].fails, i, no_key) for i in failed[k]])).otherwise(F.array(*[entry(F.lit(False), 0, no_key)])))

    for ck in checks:
        frames.update({id(df): df for df in (ck.df, getattr(ck, "parent", None)) if df is not None})
    for d, columns in enumerate(sets):
        for (k, column), at in columns.items():
            entries.setdefault(k, []).append(entry(F.col(column).isNotNull(), len(checks) + d, packed(F.col(column)), at))
    for i, ck in enumerate(checks):
        if isinstance(ck, RowCheck):
            (failed if id(ck.df) in entries else counted).setdefault(id(ck.df), []).append(i)
    spark = checks[0].df.sparkSession
    zero = F.lit(0).cast("long")
    parts = [spark.range(len(checks) + len(sets)).select(F.col("id").cast("int").alias("i"), no_key.alias("key"),
                                                         *[zero.alias(c) for c in counts])]
    for k, some in counted.items():
        sums = frames[k].agg(*[F.count_if(checks[i].fails).alias(f"c{i}") for i in some])
        parts.append(sums.select(F.inline(F.array(*[F.struct(*fields(i, no_key, F.col(f"c{i}"), 0)) for i in some]))))
    # entries that are not there are rows of NULLs, dropped after they are made: no function of each entry is called
    parts += [frames[k].select(F.inline(held(k))).filter(F.col("i").isNotNull()) for k in entries]
    keys = reduce(lambda a, b: a.unionByName(b), parts).groupBy("i", "key").agg(*[F.sum(c).alias(c) for c in counts])

    # what a key fails of its set's checks, side by side
    asked: dict[int, list[tuple[int, Column]]] = {}
    for i, ck in enumerate(checks):
        if isinstance(ck, RowCheck):
            asked[i] = [(i, F.col(counts[0]))]
            continue
        d = next(d for d, s in enumerate(sets) if (id(ck.df), ck.column) in s)
        rows = F.col(counts[sets[d][id(ck.df), ck.column]])
        fails = (rows > 1).cast("long") if ck.parent is None else F.when(
            F.col(counts[sets[d][id(ck.parent), ck.parent_column]]) == 0, rows).otherwise(F.lit(0))
        asked.setdefault(len(checks) + d, []).append((i, fails))
    most = max(map(len, asked.values()))

    def of(values: list, at: str) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col(at) + 1)

    def failing(m: int) -> Column:
        chosen = F.when(F.col("i") < len(checks), F.col(counts[0]) if m == 0 else F.lit(0))
        for i, some in asked.items():
            if i >= len(checks) and m < len(some):
                chosen = chosen.when(F.col("i") == i, some[m][1])
        return chosen.otherwise(F.lit(0))
    found = keys.groupBy("i").agg(*[F.sum(failing(m)).alias(f"f{m}") for m in range(most)])
    number = [[asked[i][m][0] if i in asked and m < len(asked[i]) else -1 for i in range(len(checks) + len(sets))]
              for m in range(most)]
    each = found.select(F.inline(F.array(*[F.struct(of(number[m], "i").alias("c"), F.col(f"f{m}").alias("failures"))
                                           for m in range(most)]))).filter("c >= 0")
    return each.select(of([ck.name for ck in checks], "c").alias("check"), of([ck.relation for ck in checks], "c").alias("relation"),
                       of([ck.column for ck in checks], "c").alias("column_name"), F.col("failures").cast("long").alias("failures"))
