"""Backtests, forecasts, samples and training sets of a project."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.functions.columns import series_id, shard_of, split_ids
from tidepanel.operators import models, panel, sampling, score, training
from tidepanel.operators.context import ArrayForecaster, train_rounds
from tidepanel.operators.coldstart import qname
from tidepanel.operators.prepare import check_mass, coerce_covariates, deduplicate, prepare, repeated_keys, require_rows
from tidepanel.plans import folds, future
from tidepanel.plans.backtest import backtest, forecast_units, units
from tidepanel.project import files
from tidepanel.project.settings import Project
from tidepanel.sources.snapshots import new_series_file, plan_snapshots, upcoming
from tidepanel.sources.store import keep
from tidepanel.sources.tables import only_series, read_table


@dataclass
class Loaded:
    """A project's panel, statics and labels, each a kept table."""

    panel: DataFrame
    statics: DataFrame | None
    labels: DataFrame | None
    n_raw: int
    first: date
    last: date


def load(spark: SparkSession, project: Project, data: str | None = None, only: DataFrame | None = None) -> Loaded:
    """Read, check and grid the sales; everything after reads written tables."""
    spec = project.spec()
    rows = prepare(read_table(spark, data or project.data_path), spec)
    if only is not None:
        rows = only_series(rows, only)
    rows, _ = coerce_covariates(rows, spec, pinned=project.covariate_types)
    if spec.duplicates == "error" and (n := repeated_keys(rows).count()):
        raise ValueError(f"{n:,} pairs of series and day occur more than once; set duplicates to a rule")
    sales = keep(deduplicate(rows, spec), "sales")
    require_rows(sales, "the sales")
    grid = keep(panel.daily_grid(sales, spec), "panel")
    check_mass(sales, grid)
    first, last, n = sales.agg(F.min("ts"), F.max("ts"), F.count(F.lit(1))).first()
    with_order = sales.withColumn("ord", F.lit(0))
    statics = keep(panel.static_first_row(with_order, list(project.static_cols)), "statics") if project.static_cols else None
    labels = None
    if project.demand_label_col:
        labels = panel.static_first_row(with_order, [project.demand_label_col]).withColumnRenamed(project.demand_label_col, "label")
    return Loaded(grid, statics, labels, n, first, last)


def load_plans(spark: SparkSession, project: Project) -> DataFrame | None:
    if not project.planned_covariates_path:
        return None
    raw = read_table(spark, project.planned_covariates_path)
    rule = "error" if project.duplicates == "error" else "last"
    order = [F.col(c) for c in raw.withColumnsRenamed(project.plan_columns).columns]
    return plan_snapshots(raw, project.series_id_cols, project.known_covariate_cols, project.plan_as_of_col, project.plan_timestamp_col or project.timestamp_col, project.plan_columns, project.derived_columns, rule, order)


def make_model(project: Project, experiment: dict) -> models.Forecaster:
    given = project.model_settings(experiment["model"], experiment["model_params"])
    return models.create(experiment["model"], project.horizon, project.season_length, tuple(project.quantiles), **given)


def _feed(model: models.Forecaster, project: Project, found: Loaded, origins: list[date], plans: DataFrame | None, production: bool) -> None:
    """Covariates for models that read them."""
    if not isinstance(model, ArrayForecaster):
        return
    model.known, model.past, model.statics = project.known_covariate_cols, project.past_covariate_cols, found.statics
    if project.known_covariate_cols:
        when = found.panel.sparkSession.createDataFrame([(o,) for o in origins], "origin date")
        frame = future.horizon_frame(panel.first_dates(found.panel), when, project.horizon)
        model.future = keep(future.known_covariates(frame, found.panel, project.covariate_eval_policy, origins, plans, production), "future")
        planned = [c for c in project.known_covariate_cols if project.covariate_eval_policy[c] == "plan" or (production and project.covariate_eval_policy[c] == "actual")]
        if plans is not None and planned:
            future.plan_report(model.future, plans, when, planned, project.min_plan_coverage, project.plan_max_age_days)


def fold_dates(project: Project, first: date, last: date) -> list[tuple[int, date, date]]:
    rule = project.folds()
    return folds.origins(rule.validation(first, last), project.horizon, rule.limit(first, last), project.origin_step_days)


def run_backtest(spark: SparkSession, project: Project, experiment: dict, data: str | None = None, predictions: str | None = None) -> dict:
    """Tables of scores (lists of rows) of all folds, and what they were made from."""
    model = make_model(project, experiment)  # refuses wrong parameters before anything is read
    inputs = files.Inputs(spark, {"sales": data or project.data_path, "plans": project.planned_covariates_path})
    started = time.perf_counter()
    found = load(spark, project, data)
    dates = fold_dates(project, found.first, found.last)
    _feed(model, project, found, sorted({o for _, _, o in dates}), load_plans(spark, project), False)
    made = keep(backtest(found.panel, dates, project.task(), model, found.statics, found.first), "predictions")
    if predictions:
        made.write.mode("overwrite").parquet(predictions)
    levels = {n: q for q in project.quantiles if (n := qname(q)) in made.columns}
    classes = panel.demand_classes(found.panel, str(dates[0][1]), found.labels).select("series_id", "demand_class")
    scored = made.join(classes, "series_id", "left").withColumn("demand_class", F.coalesce("demand_class", F.lit("no_history")))
    if project.slice_cols and found.statics is not None:
        scored = scored.join(found.statics.select("series_id", *[c for c in project.slice_cols if c != "demand_class"]), "series_id", "left")
    tables = score.standard_tables(project.slice_cols, bool(project.origin_step_days), True)
    sums = score.partial(scored, tables, levels)
    keys = [c for c in sums.columns if c not in ("table",) and c in {k for t in tables.values() for k in t}]
    rows = [r.asDict() for r in score.finalize(sums, ["table", *keys], levels, 12).collect()]  # a row per group of a table
    out = {name: [{k: v for k, v in r.items() if k not in keys or k in own} for r in rows if r["table"] == name] for name, own in tables.items()}
    return {
        "overall": {k: v for k, v in out.pop("overall")[0].items() if k != "table"}, "tables": {n: [{k: v for k, v in r.items() if k != "table"} for r in t] for n, t in out.items()},
        "cutoffs": sorted({str(c) for _, c, _ in dates}), "origins": [[f, str(c), str(o)] for f, c, o in dates], "inputs": inputs.fingerprints, "inputs_changed": inputs.changed(),
        "environment": files.environment(spark), "seconds": round(time.perf_counter() - started, 1),
    }


def run_forecast(spark: SparkSession, project: Project, experiment: dict, out: str, data: str | None = None, shards: int = 1, only: list[int] | None = None, force: bool = False, per_job: int | None = None) -> dict:
    """The forecast from the last day on, one folder per shard; shards that are there are left alone.

    A folder holds one run: its identity (settings, inputs, code) has to be the same, or ``force``
    starts over. Spark's committer makes every shard all or nothing.
    """
    if shards < 1 or (bad := [i for i in only or [] if not 0 <= i < shards]):
        raise ValueError(f"shards {bad if shards >= 1 else shards} of {shards} can't be")
    model = make_model(project, experiment)
    inputs = files.Inputs(spark, {"sales": data or project.data_path, "plans": project.planned_covariates_path, "new_series": project.cold["new_series_path"]})
    found = load(spark, project, data)
    identity = files.digest([shards, str(found.last), project.values, experiment, inputs.fingerprints, files.code_digest()])
    before = files.read_json(spark, f"{out}/_run.json")
    if before is not None and before["identity"] != identity or before is None and files.exists(spark, f"{out}/_claimed"):
        if not force:
            raise ValueError(f"{out} holds a forecast from other inputs or settings; finish it with the same ones, take another folder, or force a new start")
        if only is not None:
            raise ValueError("a new start can't be made of some shards alone")
    if force:
        files.remove(spark, out)
    files.claim(spark, f"{out}/_claimed")
    files.write_json(spark, f"{out}/_run.json", {"identity": identity, "origin": str(found.last), "shards": shards})
    todo = [i for i in (only if only is not None else range(shards)) if not files.exists(spark, f"{out}/_shard-{i:05d}.json")]
    if todo:
        made = production_forecast(spark, project, model, found)
        by = [series_id(*[F.col(c) for c in project.shard_by])] if project.shard_by and found.statics is not None else [F.col("series_id")]
        made = made.join(found.statics.select("series_id", *project.shard_by), "series_id", "left") if project.shard_by and found.statics is not None else made
        made = made.withColumn("shard", shard_of(shards, *by)).drop(*project.shard_by).withColumn("model", F.lit(experiment["name"]))
        ids = list(project.series_id_cols)
        made = made.withColumns({c: x for c, x in zip(ids, split_ids(F.col("series_id"), len(ids)), strict=True) if c not in made.columns})
        step = per_job or len(todo)
        for at in range(0, len(todo), step):
            some = todo[at : at + step]
            files.remove(spark, f"{out}/_manifest.json")
            part = made.where(F.col("shard").isin(some)).repartition("shard").sortWithinPartitions("series_id", "ts")
            part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(f"{out}/parts")
            inputs.check()
            counts = spark.read.schema(made.schema).parquet(f"{out}/parts").where(F.col("shard").isin(some)).groupBy("shard", "lifecycle").agg(F.count_distinct("series_id").alias("series"), F.count(F.lit(1)).alias("rows")).collect()  # a few rows per shard
            for i in some:
                own = [r for r in counts if r["shard"] == i]
                files.write_json(spark, f"{out}/_shard-{i:05d}.json", {"shard": i, "series": {r["lifecycle"]: r["series"] for r in own}, "rows": sum(r["rows"] for r in own)})
    done = [i for i in range(shards) if files.exists(spark, f"{out}/_shard-{i:05d}.json")]
    if len(done) == shards:
        files.write_json(spark, f"{out}/_manifest.json", {"identity": identity, "origin": str(found.last), "horizon": project.horizon, "quantiles": project.quantiles, "model": experiment["model"], "experiment": experiment["name"], "shards": shards, "inputs": inputs.fingerprints, "environment": files.environment(spark)})
    return {"out": out, "origin": str(found.last), "written": todo, "done": len(done), "shards": shards}


def production_forecast(spark: SparkSession, project: Project, model: models.Forecaster, found: Loaded) -> DataFrame:
    """Every series at the last day, upcoming ones included."""
    origin, plans = found.last, load_plans(spark, project)
    listed = new_series_file(spark, project.cold["new_series_path"], project.series_id_cols, list(project.static_cols), project.cold["launch_date_col"], str(origin)) if project.cold["new_series_path"] else None
    fresh = keep(upcoming(str(origin), found.panel, listed, plans if project.cold["from_plans"] else None), "upcoming")
    dates = [(0, origin, origin)]
    model.fit(found.panel, origin)
    _feed(model, project, found, [origin], plans, True)
    statics = found.statics
    if statics is not None and listed is not None:
        more = [c for c in project.static_cols if c in fresh.columns]
        statics = statics.unionByName(fresh.select("series_id", *more), allowMissingColumns=True)
    owed = units(found.panel, dates, project.task(), fresh.select("series_id", "launch"), production=True)
    return forecast_units(found.panel, owed, dates, project.task(), model, statics, found.first).drop("fold", "cutoff")


def run_sample(spark: SparkSession, project: Project, out: str, manifest: str, n: int, by: str | None, bins: int, floor: int, seed: int, src: str | None = None, until: str | None = None) -> dict:
    """A stratified sample of series: their raw rows, unchanged, and a list of members with weights."""
    raw = read_table(spark, src or project.data_path, mixed=False)
    keyed = raw.withColumn("sample_id", series_id(*[F.col(c) for c in project.series_id_cols]))
    rows = keyed.select(F.col("sample_id").alias("series_id"), F.to_date(project.timestamp_col).alias("ts"), F.expr(f"try_cast(`{project.target_col}` as double)").alias("y"), *([F.col(by).alias("label_col")] if by else []))
    stats = keep(sampling.series_stats(rows, until=until, label="label_col" if by else None), "stats")
    picked = keep(sampling.stratified_sample(stats, n, bins, floor, seed), "picked")
    only_series(keyed, picked.withColumnRenamed("series_id", "sample_id"), "sample_id").drop("sample_id").write.mode("overwrite").parquet(out)
    table = picked.orderBy("series_id").toPandas()  # at most n rows
    Path(manifest).parent.mkdir(parents=True, exist_ok=True)
    table.to_csv(manifest, index=False)
    return {"series": len(table), "of": stats.count(), "strata": table.groupby("stratum").size().to_dict()}


def run_training(spark: SparkSession, project: Project, experiment: dict, out: str, data: str | None = None, as_of: str | None = None, force: bool = False) -> dict:
    """Train a model that can be (``train``), round by round, and save what it was given beside its weights."""
    model = make_model(project, experiment)
    if not hasattr(model, "train"):
        raise ValueError(f"model {experiment['model']} can't be trained")
    folder = Path(out)
    if folder.exists() and not force:
        raise FileExistsError(f"{out} exists; force a new one, or take another folder")
    found = load(spark, project, data)
    as_of = as_of or str(found.last)
    if date.fromisoformat(as_of) > found.last:
        raise ValueError(f"{as_of} is after the last day of the data, {found.last}")
    recipe = dict(model.settings.get("fine_tune") or {})
    n, mix = int(recipe.get("rounds", 1)), recipe.get("train_mix") or {}
    profile = keep(training.series_profile(found.panel, as_of, int(mix.get("lookback_days") or 365), found.labels), "profile")
    draws = training.rounds(profile, project.horizon, mix, n, int(recipe.get("max_pool_series", training.MAX_POOL)))
    stage = folder.with_name(folder.name + ".partial")
    stage.mkdir(parents=True, exist_ok=True)
    facts = train_rounds(lambda rows, steps, rate, ids: model.train(rows, steps, rate, ids, stage), found.panel, draws, n, int(recipe.get("num_steps", 1000)), float(recipe.get("learning_rate", 1e-6)), as_of)
    (stage / "manifest.json").write_text(json.dumps({**facts, "experiment": experiment, "project": project.values, "code": files.code_state(), "environment": files.environment(spark)}, indent=1, default=str))
    if folder.exists():
        import shutil

        shutil.rmtree(folder)
    stage.rename(folder)
    return facts


def run_bench(spark: SparkSession, project: Project, experiment: dict, data: str | None = None, n_series: int = 2000, catalog: int | None = None) -> dict:
    """Series a second of one forecast from the last day, carried on to the backtest and the catalog."""
    model = make_model(project, experiment)
    raw = prepare(read_table(spark, data or project.data_path), project.spec())
    ids = raw.select("series_id").distinct()
    total = ids.count()
    some = keep(ids.orderBy(F.md5("series_id")).limit(n_series), "measured")
    started = time.perf_counter()
    found = load(spark, project, data, some)
    loaded_s = time.perf_counter() - started
    _feed(model, project, found, [found.last], load_plans(spark, project), True)
    started = time.perf_counter()
    owed = units(found.panel, [(0, found.last, found.last)], project.task())
    n = forecast_units(found.panel, owed, [(0, found.last, found.last)], project.task(), model, found.statics, found.first).select("series_id").distinct().count()
    took = time.perf_counter() - started
    rate = n / took
    out: dict = {"series_measured": n, "catalog": catalog or total, "load_seconds": round(loaded_s, 2), "forecast_seconds": round(took, 2), "series_per_second": round(rate, 1), "environment": files.environment(spark)}
    try:
        n_origins = len(fold_dates(project, found.first, found.last))
        out["backtest_hours"] = round(total * n_origins / rate / 3600, 4)
    except ValueError as e:
        out["backtest_hours"] = str(e)
    out["forecast_hours"] = round((catalog or total) / rate / 3600, 4)
    return out
