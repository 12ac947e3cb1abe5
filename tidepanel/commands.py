"""``python -m tidepanel <command>``: a project's runs from the shell."""

from __future__ import annotations

import argparse
import csv
import inspect
import json
import os
import sys
import warnings
from pathlib import Path

import yaml

from tidepanel.plans import ledger
from tidepanel.project import files, runs
from tidepanel.project.report import audit_text
from tidepanel.project.settings import PROJECT_VARIABLE, load_experiment, load_project

TRACE = "TIDEPANEL_TRACE"


def session():
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("tidepanel").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _project(args):
    return load_project(args.project, args.profile, args.set)


def _json(value: object) -> None:
    print(json.dumps(value, indent=1, default=str))


def config(args) -> None:
    """The settings as they are after all layers."""
    project = _project(args)
    print(yaml.safe_dump(json.loads(json.dumps(project.values, default=str)), sort_keys=False))
    if args.check_data:
        found = runs.load(session(), project, args.data)
        print(f"{found.n_raw:,} rows from {found.first} to {found.last}; all columns are there")


def env(args) -> None:
    """Versions and resources."""
    _json(files.environment(session()))


def models(args) -> None:
    """Models and their parameters."""
    from tidepanel.operators.models import REGISTRY

    if args.name and args.name not in REGISTRY:
        raise ValueError(f"unknown model {args.name}; known: {', '.join(sorted(REGISTRY))}")
    for name in [args.name] if args.name else sorted(REGISTRY):
        print(f"{name}: {', '.join(sorted(REGISTRY[name].params)) or 'no parameters'}")
        if args.name:
            print(inspect.getdoc(REGISTRY[name]))


def audit(args) -> None:
    """What the data hold, as a report."""
    project = _project(args)
    found = runs.load(session(), project, args.data)
    out = Path(args.out or f"{project.reports_dir}/data_audit.md")
    out.parent.mkdir(parents=True, exist_ok=True)
    out.write_text(text := audit_text(found.panel, found.n_raw, project, found.labels))
    print(text)


def sample(args) -> None:
    """A stratified sample of series."""
    _json(runs.run_sample(session(), _project(args), args.out, args.manifest, args.n, args.by, args.volume_bins, args.floor, args.seed, args.src, args.until))


def cutoffs(args) -> None:
    """Retrain dates and origins; plan snapshots are needed as of each."""
    project = _project(args)
    found = runs.load(session(), project, args.data)
    for fold, cutoff, origin in runs.fold_dates(project, found.first, found.last):
        print(f"validation\tfold {fold}\tretrain {cutoff}\torigin {origin}")
    for cutoff in project.folds().holdout(found.first, found.last):
        print(f"holdout\t\tretrain {cutoff}\torigin {cutoff}")


def run(args) -> None:
    """Backtest an experiment and record it."""
    project, experiment = _project(args), load_experiment(args.config)
    runs.make_model(project, experiment)
    book = Path(project.reports_dir) / "experiments"
    state = files.code_state(args.project) if args.no_commit else files.require_clean(args.project)
    reference = ledger.latest(book, experiment["based_on"]) if experiment["based_on"] else None
    if experiment["based_on"] and reference is None and not args.no_commit:
        raise ValueError(f"{experiment['based_on']}, which this is based on, is not recorded")
    folder = Path(project.reports_dir) / "scratch" / experiment["name"] if args.no_commit else ledger.reserve(book, experiment["name"])
    try:
        where = f"{project.reports_dir}/predictions/{experiment['name']}" if args.save_predictions else None
        result = runs.run_backtest(session(), project, experiment, args.data, where)
    except BaseException:
        if not args.no_commit:
            ledger.release(folder)
        raise
    metric = project.primary_metric
    result["signature"] = ledger.signature(project.values, result["inputs"], result["origins"])
    result["folds"] = {str(r["fold"]): r.get(metric) for r in result["tables"]["fold"]}
    result["verdict"], result["change"] = ledger.verdict(result, reference, metric, project.verdict_threshold, project.max_missing_share)
    settings = {"project": project.values, "experiment": experiment, "code": state, "invocation": {"project": args.project, "profile": args.profile, "set": args.set, "data": args.data}}
    folder.mkdir(parents=True, exist_ok=True)
    if args.no_commit:
        (folder / "run.json").unlink(missing_ok=True)
    ledger.record(folder, settings, result)
    for name, rows in result["tables"].items():
        with (folder / f"table_{name}.csv").open("w", newline="") as f:
            out = csv.DictWriter(f, list(rows[0]) if rows else [])
            out.writeheader()
            out.writerows(rows)
    _json({"folder": str(folder), "verdict": result["verdict"], "change": result["change"], "overall": result["overall"]})


def leaderboard(args) -> None:
    """Recorded experiments, best first."""
    project = _project(args)
    for name, value in ledger.leaderboard(Path(project.reports_dir) / "experiments", project.primary_metric):
        print(f"{name}\t{'' if value is None else f'{value:.6f}'}")


def finetune(args) -> None:
    """Train a model and save its checkpoint."""
    project, experiment = _project(args), load_experiment(args.config)
    out = args.out or f"{project.models_dir}/{experiment['name']}"
    _json(runs.run_training(session(), project, experiment, out, args.data, args.as_of, args.force))


def bench(args) -> None:
    """Measure a model and estimate whole runs."""
    project = _project(args)
    found = runs.run_bench(session(), project, load_experiment(args.config), args.data, args.series, args.catalog)
    out = Path(args.out or f"{project.reports_dir}/bench.json")
    out.parent.mkdir(parents=True, exist_ok=True)
    out.write_text(json.dumps(found, indent=1, default=str))
    _json(found)


def forecast(args) -> None:
    """Forecast from the last day on, in shards that can be resumed."""
    project, experiment = _project(args), load_experiment(args.config)
    out = args.out or f"{project.reports_dir}/forecast_{experiment['name']}"
    _json(runs.run_forecast(session(), project, experiment, out, args.data, args.shards, args.shard, args.force))


def demo(args) -> None:
    """Write a synthetic data set with a project file."""
    from tidepanel.project.demo import write

    print(write(session(), args.folder, args.series, args.days))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="python -m tidepanel", description=__doc__)
    top.add_argument("-p", "--project", default=os.environ.get(PROJECT_VARIABLE, "project.yaml"), help="project file")
    top.add_argument("--profile", help="a profile of the project file")
    top.add_argument("-s", "--set", action="append", default=[], metavar="KEY=VALUE", help="override a setting (repeatable)")
    sub = top.add_subparsers(required=True, metavar="command")

    def command(fn, *options):
        own = sub.add_parser(fn.__name__, help=fn.__doc__)
        own.set_defaults(run=fn)
        for names, more in options:
            own.add_argument(*names.split(), **more)

    data = ("--data", {"help": "files in place of the project's"})
    out, experiment = ("--out", {}), ("config", {"help": "experiment file"})
    whole, flag = (lambda d=None: {"type": int, "default": d}), {"action": "store_true"}
    command(config, data, ("--check-data", flag))
    command(env)
    command(models, ("name", {"nargs": "?"}))
    command(audit, data, out)
    command(sample, ("--n", whole(30000)), ("--by", {}), ("--volume-bins", whole(10)), ("--floor", whole(200)), ("--seed", whole(42)), ("--src", {}), ("--until", {}), ("--out", {"default": "data/raw/sales_sample.parquet"}), ("--manifest", {"default": "data/raw/sample_manifest.csv"}))
    command(cutoffs, data)
    command(run, experiment, data, ("--no-commit", flag), ("--save-predictions", flag))
    command(leaderboard)
    command(finetune, experiment, data, out, ("--as-of", {}), ("--force", flag))
    command(bench, experiment, data, out, ("--series", whole(2000)), ("--catalog", whole()))
    command(forecast, experiment, data, out, ("--shards", whole(1)), ("--shard", {"type": int, "action": "append"}), ("--force", flag))
    command(demo, ("folder", {}), ("--series", whole(60)), ("--days", whole(400)))
    return top


def main(argv: list[str] | None = None) -> int:
    """Errors of the user become one line."""
    args = parser().parse_args(argv)
    warnings.formatwarning = lambda message, *_: f"warning: {message}\n"
    try:
        args.run(args)
    except KeyboardInterrupt:
        print("interrupted", file=sys.stderr)
        return 130
    except (OSError, ValueError, RuntimeError) as e:
        if os.environ.get(TRACE):
            raise
        print(f"error: {e}\n({TRACE}=1 shows where)", file=sys.stderr)
        return 1
    return 0
