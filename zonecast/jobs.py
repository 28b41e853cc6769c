"""What a scheduler starts: ``spark-submit -m zonecast.jobs JOB --option value ...`` (or ``python -m zonecast.jobs``).

Every job takes its paths as options, works in the session it is given by the cluster, and ends with an exception if a
guard fails. Months are ``yyyy-MM``; ranges are two months, both included.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import datetime

from pyspark.sql import SparkSession

from zonecast.config import BoostingConfig, DataConfig
from zonecast.plans import cycle, predict, prepare, train
from zonecast.session import prepare_session
from zonecast.sources.files import read_months
from zonecast.sources.sqlfiles import run_sql_script
from zonecast.sources.tables import Warehouse

Job = Callable[[SparkSession, argparse.Namespace], None]
JOBS: dict[str, tuple[Job, tuple[str, ...]]] = {}

# Options that are pairs of months, and those that may be left out.
RANGES = ("months", "train", "validation", "test")
OPTIONAL = ("borough", "license", "validation", "model", "hour", "since", "mode")


def job(*options: str) -> Callable[[Job], Job]:
    def keep(run: Job) -> Job:
        JOBS[run.__name__.replace("_", "-")] = run, options
        return run
    return keep


def _data(args: argparse.Namespace) -> DataConfig:
    last = args.test or args.train
    return DataConfig(args.train[0], last[1], tuple(args.train), tuple(last), tuple(args.validation) if args.validation else None)


@job("raw", "lookup", "processed", "months", "borough", "license")
def preprocess(spark, args):
    """Raw monthly trips to monthly hourly demand."""
    first, last = args.months
    prepare.run(spark, args.raw, args.lookup, args.processed, DataConfig(
        first, last, (first, last), (first, last), keep_license=args.license, borough=args.borough))


@job("processed", "warehouse", "months")
def load_actuals(spark, args):
    """Processed months into the actuals table."""
    prepare.load_actuals(spark, args.processed, Warehouse(spark, args.warehouse), *args.months)


@job("processed", "models", "run", "train", "validation", "test", "mode")
def train_models(spark, args):
    """Fit, evaluate on the test months, save the run and its reports."""
    train.run(spark, args.processed, args.models, args.run, _data(args), replace(BoostingConfig(), mode=args.mode or "select"))


@job("processed", "moments", "models", "run", "months", "mode")
def train_production(spark, args):
    """Fit on all months and save the run for scoring."""
    data = DataConfig(*args.months, tuple(args.months), tuple(args.months))
    train.run_production(spark, args.processed, args.moments, args.models, args.run, data, replace(BoostingConfig(), mode=args.mode or "select"))


@job("warehouse", "models", "run", "model")
def predict_batch(spark, args):
    """Score the whole history of the actuals table."""
    scaler, _, models = train.load_run(spark, f"{args.models.rstrip('/')}/{args.run}")
    predict.run_batch(Warehouse(spark, args.warehouse), scaler, models.predict, args.model or args.run, models.lags)


@job("warehouse", "models", "run", "model")
def predict_next_hour(spark, args):
    """Score the hour after the newest actuals."""
    scaler, _, models = train.load_run(spark, f"{args.models.rstrip('/')}/{args.run}")
    predict.run_next_hour(Warehouse(spark, args.warehouse), scaler, models.predict, args.model or args.run, models.lags)


@job("processed", "warehouse", "months", "model", "hour")
def apply_hour(spark, args):
    """The next hour of actuals into errors and metrics; ``--hour`` repeats one that stopped half-way."""
    again = datetime.fromisoformat(args.hour) if args.hour else None
    cycle.run_hour(Warehouse(spark, args.warehouse), read_months(spark, args.processed, *args.months), args.model, again)


@job("warehouse", "inputs")
def rebuild(spark, args):
    """All monitoring tables at a new base, from predictions and actuals at another."""
    cycle.rebuild(Warehouse(spark, args.warehouse, args.inputs))


@job("warehouse", "script", "model", "since")
def script(spark, args):
    """A SQL file over the tables of the warehouse (views of their names), with :model_version and :since where it asks for them."""
    warehouse = Warehouse(spark, args.warehouse)
    for name in ("actuals", "predictions", "errors", "metrics_by_hour", "metrics_by_day", "rolling_7d", "rolling_7d_by_zone"):
        warehouse.read(name).createOrReplaceTempView(name)
    given = {"model_version": args.model, "since": datetime.fromisoformat(args.since) if args.since else None}
    run_sql_script(spark, args.script, **{k: v for k, v in given.items() if v is not None}).show(truncate=False)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="zonecast.jobs", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)
    for name, (run, options) in JOBS.items():
        one = jobs.add_parser(name, description=run.__doc__)
        for option in options:
            one.add_argument(f"--{option}", required=option not in OPTIONAL, nargs=2 if option in RANGES else None)
    return top


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(arguments)
    session = prepare_session(spark or SparkSession.builder.appName(f"zonecast {args.job}").getOrCreate())
    JOBS[args.job][0](session, args)


if __name__ == "__main__":
    main()
