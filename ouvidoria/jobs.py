"""Command line of the jobs, one load at a time: ``python -m ouvidoria.jobs JOB --ref REF ...``.

Works with ``spark-submit`` as well. A failed job raises, so that a scheduler sees it.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from importlib import import_module

from pyspark.sql import SparkSession

from ouvidoria import schemas as S
from ouvidoria.plans import chains
from ouvidoria.session import require_ref
from ouvidoria.sources.tables import Warehouse

Job = Callable[[Warehouse, argparse.Namespace], None]


def _silver_ai(wh: Warehouse, args: argparse.Namespace) -> None:
    answer = None
    if args.answer:
        module, _, function = args.answer.partition(":")
        answer = getattr(import_module(module), function)
    chains.build_silver_daily(wh, args.ref, args.institution, args.append, answer, args.model)


def _one_gold(table: str) -> Job:
    return lambda wh, args: chains.build_one_gold(wh, table, args.ref)


# Jobs that need no load reference.
CATALOG_JOBS: dict[str, Job] = {
    "create_tables": lambda wh, args: wh.create().show(),
    "drop_tables": lambda wh, args: wh.drop().show(),
}
LOAD_JOBS: dict[str, Job] = {
    "bronze": lambda wh, args: chains.load_bronze_monthly(wh, args.landing, args.ref),
    "bronze_daily": lambda wh, args: chains.load_bronze_daily(wh, args.landing, args.ref),
    "silver": lambda wh, args: chains.build_silver_monthly(wh, args.ref),
    "silver_ai": _silver_ai,
    "golds_monthly": lambda wh, args: chains.build_gold_monthly(wh, args.ref),
    "golds_daily": lambda wh, args: chains.build_gold_daily(wh, args.ref),
    **{f"gold_{spec.name}": _one_gold(spec.name) for spec in S.GOLD_TABLES},
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ouvidoria.jobs", description=__doc__)
    p.add_argument("job", choices=[*CATALOG_JOBS, *LOAD_JOBS])
    p.add_argument("--ref", default="", help="load reference: yyyy-MM (monthly) or yyyyMMdd (daily)")
    p.add_argument("--env", required=True, help="environment, fills {env} in the paths")
    p.add_argument("--base", required=True, help="base path of the tables, may hold {env}")
    p.add_argument("--landing", default="", help="folder of the delimited files, may hold {env}")
    p.add_argument("--prefix", default="", help="prefix of the database names")
    p.add_argument("--institution", default="Santander")
    p.add_argument("--append", action="store_true", help="plain insert into the classified table")
    p.add_argument("--answer", default="", help="module:function of a model, instead of the lexicon")
    p.add_argument("--model", default=None, help="name handed to that function")
    return p


def run(spark: SparkSession, argv: list[str]) -> None:
    args = parser().parse_args(argv)
    wh = Warehouse.for_env(spark, args.env, args.base, args.prefix)
    if args.job in CATALOG_JOBS:
        CATALOG_JOBS[args.job](wh, args)
        return
    args.ref = require_ref(args.ref)
    args.landing = args.landing.format(env=args.env)
    LOAD_JOBS[args.job](wh, args)


if __name__ == "__main__":
    import sys

    session = SparkSession.builder.appName("ouvidoria").getOrCreate()
    try:
        run(session, sys.argv[1:])
    finally:
        session.stop()
