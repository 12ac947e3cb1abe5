"""A small synthetic data set: daily sales with weekdays, promotions, stockouts and launches, and plan snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATEGORIES, BRANDS = ("food", "home", "toys"), ("north", "south")


def _draw(seed: int, *cols: str):
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1_000_003)) / 1_000_003


def sales(spark: SparkSession, n_series: int = 60, days: int = 400, start: str = "2022-01-01", seed: int = 1) -> DataFrame:
    """``date, sku, units, price, promo, sessions, in_stock, category, brand``; every seventh series starts late, quiet days have no row."""
    pick = lambda names, c: F.element_at(F.array(*map(F.lit, names)), (F.pmod(F.xxhash64(F.lit(seed), c), F.lit(len(names))) + 1).cast("int"))
    series = spark.range(n_series).select(F.concat(F.lit("sku"), F.col("id").cast("string")).alias("sku"), F.when(F.col("id") % 7 == 6, (F.col("id") * 37) % F.lit(max(days - 60, 1))).otherwise(0).alias("launch"))
    series = series.withColumns({"category": pick(CATEGORIES, "sku"), "brand": pick(BRANDS, "sku"), "level": 2 + 18 * _draw(seed + 1, "sku")})
    rows = series.withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(days - 1)))).where("d >= launch").withColumn("date", F.expr(f"date_add(date'{start}', cast(d as int))"))
    rows = rows.withColumns({"promo": (_draw(seed + 2, "sku", "d") < 0.1).cast("int"), "in_stock": (_draw(seed + 3, "sku", "d") > 0.04).cast("int")})
    week = F.lit(1.0) + 0.4 * (F.weekday("date") >= 5).cast("int")
    units = F.floor(F.col("level") * week * (1 + 0.8 * F.col("promo")) * (0.4 + 1.2 * _draw(seed + 4, "sku", "d")) * F.col("in_stock"))
    rows = rows.withColumns({"units": units.cast("double"), "price": F.round(5 + F.col("level") / 4 - F.col("promo"), 2), "sessions": F.floor(20 * F.col("level") * _draw(seed + 5, "sku", "d")).cast("double")})
    return rows.where("units > 0 or in_stock = 0 or promo = 1").select("date", "sku", "units", "price", "promo", "sessions", "in_stock", "category", "brand")


def plans(spark: SparkSession, rows: DataFrame, horizon: int, every: int = 7, seed: int = 1) -> DataFrame:
    """``as_of, date, sku, price, promo``: what was planned on every so many days, with some days that were not."""
    last = rows.agg(F.min("date"), F.max("date")).first()
    issued = spark.sql(f"select explode(sequence(date'{last[0]}', date'{last[1]}', interval {every} days)) as as_of")
    known = issued.join(rows.select("date", "sku", "price", "promo"), (F.col("date") > F.col("as_of")) & (F.col("date") <= F.date_add("as_of", horizon)))
    return known.where(_draw(seed + 6, "as_of", "sku", "date") > 0.03)


def write(spark: SparkSession, folder: str, n_series: int = 60, days: int = 400, horizon: int = 28) -> str:
    """Data and a project file under a folder; returns the path of the project file."""
    import yaml

    from pathlib import Path

    rows = sales(spark, n_series, days)
    rows.write.mode("overwrite").parquet(f"{folder}/sales")
    plans(spark, rows, horizon).write.mode("overwrite").parquet(f"{folder}/plans")
    settings = {
        "name": "demo",
        "data": {"data_path": f"{folder}/sales", "timestamp_col": "date", "target_col": "units", "series_id_cols": ["sku"]},
        "covariates": {"known_covariate_cols": ["price", "promo"], "past_covariate_cols": ["sessions"], "static_cols": ["category", "brand"], "in_stock_col": "in_stock", "covariate_fill": {"promo": "zero"}},
        "plans": {"covariate_eval_policy": {"price": "plan", "promo": "plan"}, "planned_covariates_path": f"{folder}/plans", "min_plan_coverage": 0.5},
        "task": {"horizon": horizon, "horizon_buckets": [7, horizon]},
        "backtest": {"n_folds": 2, "fold_step": horizon, "min_train_periods": 90, "origin_step_days": 14},
        "filters": {"min_history_days": 28},
        "cold_start": {"profile_cols": ["category"], "min_analogs": 2},
        "evaluation": {"slice_cols": ["category"], "quantiles": [0.1, 0.5, 0.9]},
        "paths": {"reports_dir": f"{folder}/reports", "models_dir": f"{folder}/models"},
        "profiles": {"short": {"horizon": 7, "horizon_buckets": [7]}},
    }
    path = Path(folder) / "project.yaml"
    path.write_text(yaml.safe_dump(settings, sort_keys=False))
    for model in ("naive", "seasonal_naive", "croston", "empirical"):
        based = {} if model == "naive" else {"based_on": "naive"}
        (Path(folder) / f"{model}.yaml").write_text(yaml.safe_dump({"name": model, "hypothesis": f"{model} on the demo", "model": model, **based}))
    return str(path)
