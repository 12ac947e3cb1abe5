"""Forecasts from many origins with any model, and the rows that are owed and missing.

A series that has enough history at an origin goes to the model, one with less or none to the cold
start. Every series that an origin owes a forecast has its rows, with a null forecast where no way
gave one. All origins share one pass over the panel, which should be a kept table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.columns import bucket
from tidepanel.operators import coldstart
from tidepanel.operators.forecast import origin_states
from tidepanel.operators.models import Forecaster
from tidepanel.operators.panel import in_stock


@dataclass(frozen=True)
class Task:
    """What is forecast, and how series without history are."""

    horizon: int
    season: int = 7
    min_history: int = 0
    buckets: tuple[int, ...] = ()
    quantiles: tuple[float, ...] = ()
    method: str = "launch_profile"
    profile_keys: tuple[str, ...] = ()
    min_analogs: int = 5
    slices: tuple[str, ...] = field(default=())


Origin = tuple[int, date, date]


def units(panel: DataFrame, origins: Sequence[Origin], task: Task, new: DataFrame | None = None, production: bool = False) -> DataFrame:
    """``fold, cutoff, origin, series_id, first_ts, launch, hist_age, hist_sum, lifecycle``: what each origin owes a forecast.

    A new series is one first seen within the horizon (a planned launch), or, in production, one
    of ``new`` (``series_id, launch``).
    """
    days = panel.sparkSession.createDataFrame(list(origins), "fold int, cutoff date, origin date")
    firsts = panel.groupBy("series_id").agg(F.min("ts").alias("first_ts"))
    reach = F.col("origin") if production else F.date_add("origin", task.horizon)
    pairs = firsts.join(F.broadcast(days), F.col("first_ts") <= reach).withColumn("launch", F.col("first_ts"))
    if production and new is not None:
        fresh = new.join(firsts, "series_id", "left_anti").select("series_id", "launch").join(F.broadcast(days))
        pairs = pairs.unionByName(fresh.withColumn("first_ts", F.lit(None).cast("date")))
    age = F.greatest(F.coalesce(F.datediff("origin", "first_ts") + 1, F.lit(0)), F.lit(0))
    kind = F.when(F.col("hist_age") >= max(task.min_history, 1), "established").when(F.col("hist_age") > 0, "short_history").otherwise("new")
    out = pairs.withColumn("hist_age", age).withColumn("lifecycle", kind)
    if task.min_history <= 1:
        return out.withColumn("hist_sum", F.lit(0.0))
    short = out.where("lifecycle = 'short_history'").select("origin", "series_id", "first_ts")
    sold = panel.withColumn("v", in_stock()).select("series_id", "ts", "v").join(short, "series_id").where("ts <= origin").groupBy("origin", "series_id").agg(F.sum("v").alias("sold"))
    return out.join(sold, ["origin", "series_id"], "left").withColumn("hist_sum", F.coalesce("sold", F.lit(0.0))).drop("sold")


def forecast_units(panel: DataFrame, owed: DataFrame, origins: Sequence[Origin], task: Task, model: Forecaster, statics: DataFrame | None = None, start: date | None = None) -> DataFrame:
    """Forecasts of all units: ``fold, cutoff, origin, series_id, ts, horizon, y_pred, q_*, lifecycle``; null where there is none."""
    days = sorted({o for _, _, o in origins})
    folds = panel.sparkSession.createDataFrame(list(origins), "fold int, cutoff date, origin date")
    cols = ["series_id", "origin", "horizon", "ts"]
    established = owed.where("lifecycle = 'established'")
    # a relational model forecasts every series that has started, so there is nothing to tell it
    predicted = model.forecast(panel, None if model.complete and task.min_history <= 1 else established, days)
    names = [c for c in predicted.columns if c not in cols]
    if not model.complete:  # rows that are owed, with or without a forecast
        rows = established.select("series_id", "origin").withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(task.horizon)))).withColumn("ts", F.date_add("origin", F.col("horizon")))
        predicted = rows.join(predicted.drop("ts"), ["series_id", "origin", "horizon"], "left")
    made = predicted.select(*cols, *[F.col(f"`{c}`") for c in names], F.lit("established").alias("lifecycle"))
    levels = [q for q in task.quantiles if coldstart.qname(q) in names]
    cold = owed.where("lifecycle != 'established'").select("origin", "series_id", "launch", "hist_age", "hist_sum", "lifecycle")
    profiles = None
    if task.method == "launch_profile":
        if statics is not None and task.profile_keys:
            cold = cold.join(statics.select("series_id", *task.profile_keys), "series_id", "left")
        cold = cold.withColumns({k: F.coalesce(F.col(k).cast("string"), F.lit("")) if k in cold.columns else F.lit("") for k in task.profile_keys}) if task.profile_keys else cold
        firsts = panel.groupBy("series_id").agg(F.min("ts").alias("first_ts"))
        known = statics if statics is not None else firsts.select("series_id")
        profiles = coldstart.launch_profiles(panel, firsts, known, days, task.profile_keys, max(task.min_history, 1) + task.horizon, task.min_analogs, task.min_history, levels, start)
    rest = coldstart.cold_forecast(cold, profiles, task.profile_keys, task.horizon, levels, task.method)
    both = made.unionByName(rest, allowMissingColumns=True).join(F.broadcast(folds), "origin")
    return both.select("fold", "cutoff", "origin", "series_id", "ts", "horizon", *[F.col(f"`{c}`") for c in names], "lifecycle")


def backtest(panel: DataFrame, origins: Sequence[Origin], task: Task, model: Forecaster, statics: DataFrame | None = None, start: date | None = None) -> DataFrame:
    """Forecasts with ``y_true, stockout, mase_scale, model_age_days, model_age_weeks`` and ``bucket``.

    A model is fitted once per fold at its cutoff; the scale is that of the cutoff too.
    """
    for cutoff in dict.fromkeys(c for _, c, _ in origins):
        model.fit(panel, cutoff)
    first, last = min(o for _, _, o in origins), max(o for _, _, o in origins)
    made = forecast_units(panel, units(panel, origins, task), origins, task, model, statics, start)
    window = (F.col("ts") > F.lit(str(first)).cast("date")) & (F.col("ts") <= F.date_add(F.lit(str(last)).cast("date"), task.horizon))
    truth = panel.where(window).select("series_id", "ts", F.col("y").alias("y_true"), "stockout")
    scale = origin_states(panel, {c for _, c, _ in origins}, task.season, scale=True).select("series_id", F.col("origin").alias("cutoff"), "mase_scale")
    out = made.join(truth, ["series_id", "ts"], "left").join(scale, ["series_id", "cutoff"], "left")
    age = F.datediff("origin", "cutoff")
    named = bucket(F.col("horizon"), list(task.buckets or (task.horizon,)))
    return out.select(*made.columns[:6], *[F.col(f"`{c}`") for c in made.columns[6:]], "y_true", "stockout", "mase_scale", age.alias("model_age_days"), F.floor(age / 7).cast("int").alias("model_age_weeks"), named.alias("bucket"))
