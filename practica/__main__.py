"""Command line: one scheduled run, or the data tests over stored marts.

    python -m practica build --sources <root> [--run-ts 2024-06-30T00:00:00]
                             [--out <root>] [--as-of 2024-06-30]
                             [--calendar-start 2020-01-01] [--calendar-end 2026-12-31]
    python -m practica check [--out <root>] [--calendar-start ...] [--calendar-end ...]

``build`` snapshots the 14 sources (read from ``<sources>/<name>`` with
their declared schemas), rebuilds the dimensions, merges the facts and
writes a check summary, each layer as a new version under ``--out`` (default
``<spark.checkpoint.dir>/practica``). ``check`` runs the declared-test
catalog over the current stored versions and prints failures. A calendar bound
that is not given is taken from the data (whole years around every date that a
fact uses); rows outside given bounds are counted and printed. Run under
``spark-submit`` on a cluster; the session's settings come from there.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession


SHUFFLED_PART = 8       # of the sources' bytes, the largest expected shuffle


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="practica")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--sources", required=True)
    b.add_argument("--run-ts", default=None)
    b.add_argument("--as-of", default=None)
    b.add_argument("--out", default=None)
    c = sub.add_parser("check")
    c.add_argument("--out", default=None)
    c.add_argument("--as-of", default=None)
    for p in (b, c):
        p.add_argument("--calendar-start", type=dt.date.fromisoformat, default=None)
        p.add_argument("--calendar-end", type=dt.date.fromisoformat, default=None)
    args = ap.parse_args(argv)

    from practica.operators.staging import stage_all
    from practica.plans.build import calendar_of, default_root, outside_calendar, run_build, stored_calendar
    from practica.semantics import Semantics
    from practica.operators.parts import file_system
    from practica.session import SCALE_CONF, cluster_conf
    from practica.sources.schemas import read_sources

    spark = SparkSession.builder.appName("practica").getOrCreate()
    settings = SCALE_CONF
    if args.cmd == "build" and not spark.sparkContext.master.startswith("local"):
        # the measures shuffle partial aggregates, a small part of the sources
        fs, path = file_system(spark, args.sources)
        settings = cluster_conf(fs.getContentSummary(path).getLength() // SHUFFLED_PART)
    for k, v in settings.items():
        spark.conf.set(k, v)
    now = dt.datetime.now().replace(microsecond=0)
    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else now.date()
    root = args.out or default_root(spark)
    given = args.calendar_start, args.calendar_end
    if args.cmd == "build":
        sources = read_sources(spark, args.sources)
        start, end = calendar_of(stage_all(sources), as_of) if None in given else given
    else:
        start, end = stored_calendar(spark, root, as_of) if None in given else given
    sem = Semantics(as_of=as_of, calendar_start=given[0] or start, calendar_end=given[1] or end)
    if args.cmd == "build":
        for name, n in outside_calendar(stage_all(sources), sem).items():
            print(f"OUTSIDE CALENDAR\t{name}\t{n}")
        # the clock, not midnight: a history refuses a second run at one time
        run_ts = dt.datetime.fromisoformat(args.run_ts) if args.run_ts else now
        res = run_build(spark, sources, run_ts, sem, root)
        for k, v in sorted(res.paths.items()):
            print(f"{k}\t{v}")
        failing = res.checks.filter("failures > 0").collect()
    else:
        from practica.plans.build import stored_relations
        from practica.plans.check_catalog import run_catalog
        failing = run_catalog(stored_relations(spark, root, sem)).filter("failures > 0").collect()
    for r in failing:
        print(f"FAIL {r['check']} {r['relation']}.{r['column_name']}: {r['failures']}")
    return 1 if failing else 0


if __name__ == "__main__":
    sys.exit(main())
