"""What is known about the horizon at an origin."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

POLICIES = ("actual", "plan", "carry_forward")


def horizon_frame(series: DataFrame, origins: DataFrame, horizon: int) -> DataFrame:
    """``series_id, origin, ts, horizon`` for every series that has started; origins are a few rows."""
    pairs = series.join(F.broadcast(origins), F.col("first_ts") <= F.col("origin"))
    return pairs.select("series_id", "origin", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon")).withColumn("ts", F.date_add("origin", F.col("horizon")))


def with_actuals(frame: DataFrame, panel: DataFrame, columns: list[str]) -> DataFrame:
    return frame.join(panel.select("series_id", "ts", *columns), ["series_id", "ts"], "left")


def with_carried(frame: DataFrame, panel: DataFrame, origins: Iterable[date | str], columns: list[str]) -> DataFrame:
    """The last value known at each origin: a row counts for the first origin at or after it, then values run on over origins."""
    days = [F.lit(str(o)).cast("date") for o in sorted({str(o) for o in origins})]
    at = F.coalesce(*[F.when(F.col("ts") <= d, d) for d in days])
    cells = panel.withColumn("at", at).where("at is not null").groupBy("series_id", "at").agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("ts"))).alias(c) for c in columns])
    by = Window.partitionBy("series_id").orderBy("origin").rowsBetween(Window.unboundedPreceding, 0)
    series = cells.groupBy("series_id").agg(F.min("at").alias("since"))
    each = series.withColumn("origin", F.explode(F.array(*days))).where("since <= origin").join(cells.withColumnRenamed("at", "origin"), ["series_id", "origin"], "left")
    held = each.select("series_id", "origin", *[F.last(c, True).over(by).alias(c) for c in columns])
    return frame.join(held, ["series_id", "origin"], "left")


def snapshot_as_of(plans: DataFrame, origins: DataFrame) -> DataFrame:
    """The latest snapshot of the whole table at or before each origin."""
    dates = plans.select("as_of").distinct()
    return F.broadcast(origins).join(dates, F.col("as_of") <= F.col("origin")).groupBy("origin").agg(F.max("as_of").alias("as_of"))


def with_plans(frame: DataFrame, plans: DataFrame, origins: DataFrame, columns: list[str]) -> DataFrame:
    seen = plans.join(F.broadcast(snapshot_as_of(plans, origins)), "as_of").select("series_id", "origin", "ts", *columns)
    return frame.join(seen, ["series_id", "origin", "ts"], "left")


def coverage(frame: DataFrame, column: str) -> DataFrame:
    return frame.groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.count(column).alias("n_known"))


def known_covariates(frame: DataFrame, panel: DataFrame, policies: Mapping[str, str], origins: Iterable[date | str], plans: DataFrame | None = None, production: bool = False) -> DataFrame:
    """The horizon with its known covariates, each by its policy.

    In production there are no actuals: such columns come from the latest plan. Columns that the
    history doesn't have are left out; a missing category is the empty text, a missing number null.
    """
    if bad := sorted(set(policies.values()) - set(POLICIES)):
        raise ValueError(f"unknown policies {', '.join(bad)}; known: {', '.join(POLICIES)}")
    by: dict[str, list[str]] = {}
    for name, policy in policies.items():
        if name in panel.columns:
            by.setdefault("plan" if production and policy == "actual" else policy, []).append(name)
    kinds, spark = dict(panel.dtypes), panel.sparkSession
    days = sorted({str(o) for o in origins})
    when = spark.createDataFrame([(date.fromisoformat(d),) for d in days], "origin date")
    if "actual" in by:
        frame = with_actuals(frame, panel, by["actual"])
    if "carry_forward" in by:
        frame = with_carried(frame, panel, days, by["carry_forward"])
    if "plan" in by:
        if plans is None:
            raise ValueError(f"columns {', '.join(by['plan'])} are read from plan snapshots, and there are none")
        if missing := [c for c in by["plan"] if c not in plans.columns]:
            raise ValueError(f"plan snapshots lack columns {', '.join(missing)}")
        frame = with_plans(frame, plans, when, by["plan"])
    known = [c for names in by.values() for c in names]
    return frame.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) if kinds[c] == "string" else F.expr(f"try_cast(`{c}` as double)") for c in known}) if known else frame


def plan_report(frame: DataFrame, plans: DataFrame, origins: DataFrame, columns: list[str], least: float = 0.99, max_age: int | None = None) -> list[dict]:
    """Age and coverage of the snapshot at each origin (a row each); warns of old or thin ones."""
    shares = frame.groupBy("origin").agg(*[F.round(F.count(c) / F.count(F.lit(1)), 6).alias(c) for c in columns])
    rows = shares.join(snapshot_as_of(plans, origins), "origin", "left").orderBy("origin").collect()  # a row per origin
    out = []
    for r in rows:
        found = {"origin": r["origin"], "as_of": r["as_of"], "age": (r["origin"] - r["as_of"]).days if r["as_of"] else None, "coverage": {c: r[c] for c in columns}}
        if max_age is not None and found["age"] is not None and found["age"] > max_age:
            warnings.warn(f"the latest plan at {r['origin']} is {found['age']} days old", stacklevel=2)
        if low := {c: v for c, v in found["coverage"].items() if v < least}:
            warnings.warn(f"plans at {r['origin']} cover less than {least:.0%}: " + ", ".join(f"{c} {v:.1%}" for c, v in low.items()), stacklevel=2)
        out.append(found)
    return out
