"""Command line: one step of the load per call, for ``spark-submit`` or ``python -m``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from overlake import MatchTables, Seeds, Silver, configure
from overlake.plans.catalogue import audit
from overlake.plans.ingest import transform, transform_bronze, transform_unseen
from overlake.session import scratch
from overlake.sources import (
    BronzeStore,
    FileLedger,
    bronze_rows,
    explode_archives,
    partition_inventory,
    publish_models,
    read_raw_texts,
)


def _print(report: DataFrame) -> None:
    """All rows, a partition at a time."""
    print("|".join(report.columns))
    for row in report.toLocalIterator():
        print("|".join("" if v is None else str(v) for v in row))


def _bronze(spark: SparkSession, args) -> None:
    store = BronzeStore(spark, args.bronze)
    if args.archives:
        members = explode_archives(spark, args.archives)
    else:
        members = read_raw_texts(spark, args.raw)
    store.apply(bronze_rows(members), args.batch, args.feed)
    _print(store.stats(args.batch, args.feed).orderBy("match_type", "year", "status"))


def _silver(spark: SparkSession, args) -> None:
    if args.bronze:
        done = transform_bronze(BronzeStore(spark, args.bronze), args.silver, args.mode, args.since_batch, args.feed)
    elif args.ledger:
        print(f"files {transform_unseen(spark, args.raw, args.silver, FileLedger(spark, args.ledger))}")
        return
    else:
        done = transform(spark, args.raw, args.silver, args.mode, args.since_days)
    print(f"processed {done.processed.count()}, errors {done.errors.count()}")


def _build(spark: SparkSession, args) -> None:
    silver, seeds = Silver.read(spark, args.silver), Seeds.standard(spark)
    if args.mode == "incremental":
        tables = MatchTables.refresh(silver, seeds, args.store)
    else:
        tables = MatchTables(silver, seeds, args.store).build()
    if args.publish:
        print("\n".join(publish_models(tables, args.prefix)))


def _check(spark: SparkSession, args) -> None:
    """Reads only: the tables of a store, or plans over silver."""
    if args.store:
        tables = MatchTables.load(spark, args.store)
    else:
        tables = MatchTables(Silver.read(spark, args.silver), Seeds.standard(spark))
    _print(audit.check_report(tables).filter("failures > 0"))


def _reconcile(spark: SparkSession, args) -> None:
    tables = MatchTables.load(spark, args.store)
    for report in (audit.career_batting, audit.reconcile_batting, audit.career_bowling, audit.reconcile_bowling):
        _print(report(tables))


def _inventory(spark: SparkSession, args) -> None:
    _print(partition_inventory(spark, args.raw))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="overlake")
    steps = p.add_subparsers(dest="step", required=True)

    def step(name, run, **options):
        s = steps.add_parser(name)
        for option, settings in options.items():
            s.add_argument(f"--{option.replace('_', '-')}", **settings)
        s.set_defaults(run=run)

    need, may = {"required": True}, {}
    mode = {"choices": ["full", "incremental"], "default": "full"}
    step("bronze", _bronze, bronze=need, archives=may, raw=may, batch={"type": int, "required": True},
         feed={"default": "main"})
    step("silver", _silver, silver=need, raw=may, bronze=may, mode=mode,
         since_days={"type": float, "default": 2}, since_batch={"type": int, "default": 0}, feed={"default": "main"},
         ledger=may)
    step("build", _build, silver=need, store=need, mode=mode, publish={"action": "store_true"}, prefix={"default": "main_"})
    step("check", _check, silver=may, store=may)
    step("reconcile", _reconcile, store=need)
    step("inventory", _inventory, raw=need)
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = configure(SparkSession.builder.appName("overlake").getOrCreate())
    with scratch(spark):
        args.run(spark, args)


if __name__ == "__main__":
    main()
