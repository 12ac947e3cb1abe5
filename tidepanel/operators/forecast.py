"""Baselines. Each reads a state at the origins, so any number of origins costs one pass over the panel.

A row belongs to the first origin at or after it. Rows are summed up by series and origin, which
shrinks the panel to a few numbers per series and origin; the state at an origin then adds up what
belongs to it and to the origins before. A series that ended earlier has a state at later origins.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.operators.panel import in_stock


def _days(days: Iterable[date | str]) -> list[Column]:
    return [F.lit(str(d)).cast("date") for d in sorted({str(d) for d in days})]


def _next(days: list[Column], ts: Column) -> Column:
    """The first of the days at or after ``ts``; null behind the last one."""
    return F.coalesce(*[F.when(ts <= d, d) for d in days])


def origin_states(panel: DataFrame, origins: Iterable[date | str], season: int, scale: bool = False) -> DataFrame:
    """``series_id, origin, first_ts, last_ts, mean, last, days`` for each origin at or after a series' first row.

    ``days`` are the known values of the last ``season`` days; with ``scale``, ``mase_scale`` is the
    mean absolute seasonal difference up to the origin, of pairs in stock.
    """
    days = _days(origins)
    rows = panel.withColumn("v", in_stock())
    if scale:
        rows = rows.withColumn("d", F.abs(F.col("v") - F.lag("v", season).over(Window.partitionBy("series_id").orderBy("ts"))))
    else:
        rows = rows.withColumn("d", F.lit(None).cast("double"))
    rows = rows.select("series_id", "ts", "v", "d", _next(days, F.col("ts")).alias("at"))
    known = F.col("v").isNotNull()
    recent = F.when(known & (F.datediff("at", "ts") < season), F.struct("ts", "v"))
    cells = rows.groupBy("series_id", "at").agg(
        F.min("ts").alias("lo"), F.max("ts").alias("hi"), F.sum("v").alias("s"), F.count("v").alias("n"), F.max_by("v", F.when(known, F.col("ts"))).alias("last"),
        F.sum("d").alias("ds"), F.count("d").alias("dn"), F.collect_list(recent).alias("days"),
    )
    series = cells.groupBy("series_id").agg(F.min("lo").alias("first_ts"), F.sort_array(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "hi", "s", "n", "last", "ds", "dn", "days")))).alias("cells"))
    each = series.withColumn("origin", F.explode(F.array(*days))).where(F.col("first_ts") <= F.col("origin"))
    each = each.withColumn("past", F.filter("cells", lambda c: c["at"] <= F.col("origin")))
    total = lambda name: F.aggregate("past", F.lit(0.0), lambda acc, c: acc + F.coalesce(c[name].cast("double"), F.lit(0.0)))
    with_value = F.filter("past", lambda c: c["last"].isNotNull())
    out = each.select(
        "series_id", "origin", "first_ts", F.element_at("past", -1)["hi"].alias("last_ts"),
        F.try_divide(total("s"), total("n")).alias("mean"), F.try_element_at(with_value, F.lit(-1))["last"].alias("last"),
        F.flatten(F.transform("past", lambda c: c["days"])).alias("days"), F.try_divide(total("ds"), total("dn")).alias("mase_scale"),
    )
    return out if scale else out.drop("mase_scale")


def over_horizon(state: DataFrame, horizon: int) -> DataFrame:
    return state.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn("ts", F.date_add("origin", F.col("horizon")))


def naive(state: DataFrame, horizon: int) -> DataFrame:
    """The last known value, flat."""
    return over_horizon(state.select("series_id", "origin", F.coalesce("last", F.lit(0.0)).alias("y_pred")), horizon).select("series_id", "origin", "horizon", "ts", "y_pred")


def seasonal_naive(state: DataFrame, horizon: int, season: int) -> DataFrame:
    """The day one season before, carried round; else the in-stock mean; else 0."""
    rows = over_horizon(state.select("series_id", "origin", "mean", F.map_from_entries("days").alias("days")), horizon)
    source = F.expr(f"date_add(origin, (horizon - 1) % {season} - {season - 1})")
    return rows.select("series_id", "origin", "horizon", "ts", F.coalesce(F.try_element_at("days", source), F.col("mean"), F.lit(0.0)).alias("y_pred"))


def croston_rates(panel: DataFrame, origins: Iterable[date | str], alpha: float = 0.1, window: int = 365) -> DataFrame:
    """``series_id, origin, rate`` of series that sold in the window: with bias correction, in closed form (weights fall by 1 - alpha with each later sale)."""
    days = _days(origins)
    inside = lambda d: (F.col("ts") <= d) & (F.col("ts") > F.date_sub(d, window))
    rows = panel.where(reduce(lambda a, b: a | b, map(inside, days))).withColumn("v", in_stock())
    rows = rows.withColumn("origin", F.explode(F.array_compact(F.array(*[F.when(inside(d), d) for d in days]))))
    by = Window.partitionBy("series_id", "origin").orderBy("ts")
    seen = rows.withColumn("n", F.count("v").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    hits = seen.where("v > 0")
    hits = hits.withColumn("q", F.col("n") - F.coalesce(F.lag("n").over(by), F.lit(0))).withColumn("k", F.row_number().over(by))
    hits = hits.withColumn("total", F.count(F.lit(1)).over(Window.partitionBy("series_id", "origin")))
    weight = F.pow(F.lit(1 - alpha), F.col("total") - F.col("k")) * F.when(F.col("k") == 1, 1.0).otherwise(alpha)
    return hits.groupBy("series_id", "origin").agg(((1 - alpha / 2) * F.sum(F.col("v") * weight) / F.sum(F.col("q") * weight)).alias("rate"))


def croston(panel: DataFrame, origin: str, alpha: float = 0.1, window: int = 365) -> DataFrame:
    """The rate of each series with a row in the window of one origin; 0 without a sale."""
    o = F.lit(origin).cast("date")
    rows = panel.where((F.col("ts") <= o) & (F.col("ts") > F.date_sub(o, window)))
    rates = croston_rates(panel, [origin], alpha, window).drop("origin")
    return rows.select("series_id").distinct().join(rates, "series_id", "left").select("series_id", F.coalesce("rate", F.lit(0.0)).alias("rate"))
