"""Launch profiles of comparable series, for series without a history, or with a short one.

Levels run from the finest (all keys) to the coarsest (no key). All origins are handled in one
plan: a row of history counts for each origin at or after it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIOR_DAYS, LEAST_SCALE, MOST_SCALE = 7, 0.2, 5.0
METHODS = ("launch_profile", "zero", "none")


def qname(level: float) -> str:
    return f"q_{level:g}"


def launch_profiles(panel: DataFrame, firsts: DataFrame, statics: DataFrame, origins: Iterable[date | str], keys: Sequence[str], max_age: int, min_analogs: int, min_history: int = 0, quantiles: Sequence[float] = (0.1, 0.5, 0.9), start: date | str | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """``origin, level, <keys>, age`` -> mean, count and quantiles of in-stock demand at that age.

    Series that are there from the first day of the data may have started before, so they are no
    analogs; nor are those that have a short history at the origin. Keys that a level pools are ``*``.
    """
    begin = firsts.agg(F.min("first_ts").alias("start")) if start is None else firsts.sparkSession.range(1).select(F.lit(str(start)).cast("date").alias("start"))  # one row
    pool = firsts.join(F.broadcast(begin), F.col("first_ts") > F.col("start")).select("series_id", "first_ts")
    if exclude is not None:
        pool = pool.join(exclude.select("series_id"), "series_id", "left_anti")
    rows = panel.where(~F.col("stockout") & F.col("y").isNotNull()).select("series_id", "ts", "y").join(pool, "series_id")
    rows = rows.withColumn("age", F.datediff("ts", "first_ts")).where(F.col("age") < max_age)
    days = [F.lit(str(o)).cast("date") for o in origins]
    counts = lambda d: (F.col("ts") <= d) & (F.datediff(d, F.col("first_ts")) + 1 >= max(min_history, 1))
    rows = rows.withColumn("origin", F.explode(F.array_compact(F.array(*[F.when(counts(d), d) for d in days]))))
    rows = rows.join(statics.select("series_id", *keys), "series_id").select("origin", *[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys], "age", "y")
    cols = [F.col(k) for k in keys]
    sets = rows.groupingSets([[F.col("origin"), *cols[: len(cols) - n], F.col("age")] for n in range(len(cols) + 1)], F.col("origin"), *cols, F.col("age"))
    level = sum((F.grouping(k) for k in keys), F.lit(0)).cast("int")
    out = sets.agg(level.alias("level"), F.avg("y").alias("mean"), F.count(F.lit(1)).alias("n"), F.percentile("y", F.array(*map(F.lit, quantiles))).alias("q"))
    return out.where(F.col("n") >= min_analogs).select("origin", "level", *[F.coalesce(F.col(k), F.lit("*")).alias(k) for k in keys], "age", "mean", "n", *[F.col("q")[i].alias(qname(q)) for i, q in enumerate(quantiles)])


def lookup(targets: DataFrame, profiles: DataFrame, keys: Sequence[str], values: Sequence[str] = ("mean",)) -> DataFrame:
    """``origin, <keys>, age`` and more -> the finest level's values at min(age, its last supported age); null if none.

    One exchange of the targets per level, by what the level keeps of the keys; Spark broadcasts the profiles while they are small.
    """
    out = targets
    for level in range(len(keys) + 1):
        on = ["origin", *keys[: len(keys) - level]]
        own = profiles.where(F.col("level") == level)
        caps = own.groupBy(*on).agg(F.max("age").alias(f"cap{level}"))
        found = own.select(*on, F.col("age").alias(f"age{level}"), F.struct(*[F.col(f"`{v}`") for v in values]).alias(f"found{level}"))
        out = out.join(caps, on, "left").withColumn(f"age{level}", F.when(F.col(f"cap{level}").isNotNull(), F.least("age", f"cap{level}"))).join(found, [*on, f"age{level}"], "left")
    best = F.coalesce(*[F.col(f"found{level}") for level in range(len(keys) + 1)])
    return out.withColumn("found", best).select(*targets.columns, *[F.col("found")[v].alias(v) for v in values])


def scales(short: DataFrame, profiles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``origin, series_id, <keys>, hist_age, hist_sum`` -> ``origin, series_id, scale``: how a series sold against its profile so far.

    Shrunk towards 1 by ``PRIOR_DAYS`` days of the mean profile over the past days of all short series of the origin.
    """
    past = short.withColumn("age", F.explode(F.sequence(F.lit(0), F.col("hist_age") - 1)))
    looked = lookup(past, profiles, keys)
    prior = looked.groupBy("origin").agg((F.greatest(F.coalesce(F.avg("mean"), F.lit(0.0)), F.lit(1e-6)) * PRIOR_DAYS).alias("prior"))  # a row per origin
    sold = looked.groupBy("origin", "series_id").agg(F.sum(F.coalesce("mean", F.lit(0.0))).alias("expected"), F.first("hist_sum").alias("sold"))
    ratio = (F.col("sold") + F.col("prior")) / (F.col("expected") + F.col("prior"))
    return sold.join(F.broadcast(prior), "origin").select("origin", "series_id", F.least(F.greatest(ratio, F.lit(LEAST_SCALE)), F.lit(MOST_SCALE)).alias("scale"))


def cold_forecast(cold: DataFrame, profiles: DataFrame | None, keys: Sequence[str], horizon: int, quantiles: Sequence[float] = (), method: str = "launch_profile") -> DataFrame:
    """``origin, series_id, launch, hist_age, hist_sum, <keys>`` -> ``series_id, origin, horizon, ts, y_pred`` and quantiles.

    A new series sells its profile from its launch on and 0 before; a short one also scaled by how it sold.
    Without a profile at any level there is no forecast (null). ``zero`` forecasts 0, ``none`` null.
    """
    if method not in METHODS:
        raise ValueError(f"unknown cold start {method}; known: {', '.join(METHODS)}")
    names = [qname(q) for q in quantiles]
    ahead = cold.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn("ts", F.date_add("origin", F.col("horizon")))
    cols = ["series_id", "origin", "horizon", "ts", *[c for c in ("lifecycle",) if c in cold.columns]]
    if method == "zero":
        return ahead.select(*cols, *[F.lit(0.0).alias(n) for n in ("y_pred", *names)])
    if method == "none":
        return ahead.select(*cols, *[F.lit(None).cast("double").alias(n) for n in ("y_pred", *names)])
    gap = F.datediff("ts", "launch")
    ahead = ahead.withColumn("age", F.greatest(gap, F.lit(0))).withColumn("launched", gap >= 0)
    values = ["mean", *names]
    looked = lookup(ahead, profiles, keys, values)
    factors = scales(cold.where("hist_age > 0"), profiles, keys)
    looked = looked.join(factors, ["origin", "series_id"], "left")
    factor = F.when(F.col("launched"), F.coalesce("scale", F.lit(1.0))).otherwise(0.0)
    ordered = F.array_sort(F.array(*[F.col(f"`{n}`") * factor for n in names])) if names else None
    return looked.select(*cols, (F.col("mean") * factor).alias("y_pred"), *[ordered[i].alias(n) for i, n in enumerate(names)])
