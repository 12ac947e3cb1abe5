"""Plan snapshots and files of upcoming series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.functions.columns import series_id
from tidepanel.operators.prepare import derive
from tidepanel.sources.tables import read_table


def plan_snapshots(raw: DataFrame, ids: list[str], known: list[str], as_of: str = "as_of", timestamp: str = "ts", rename: dict[str, str] | None = None, derived: dict[str, str] | None = None, duplicates: str = "error", order: list[str] | None = None) -> DataFrame:
    """``as_of, series_id, ts`` and the known covariates that the file has.

    Columns are renamed first; derived ones are added where their inputs are there. Repeated
    (snapshot, series, day) rows are an error, unless the rule names a row: then the last by ``order`` stays.
    """
    rows = derive(raw.withColumnsRenamed(rename or {}), derived or {}, strict=False)
    if missing := [c for c in (as_of, timestamp, *ids) if c not in rows.columns]:
        raise ValueError(f"plan snapshots lack columns {', '.join(missing)}")
    cols = [c for c in known if c in rows.columns]
    rows = rows.select(F.to_date(as_of).alias("as_of"), series_id(*[F.col(c) for c in ids]).alias("series_id"), F.to_date(timestamp).alias("ts"), *cols, F.struct(*(order or [F.lit(0)])).alias("ord"))
    key = ["as_of", "series_id", "ts"]
    if duplicates == "error":
        counted = rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*key)))
        return counted.withColumn("ts", F.when(F.col("n") > 1, F.raise_error(F.lit("plan snapshots repeat a series and day; set duplicates to last")).cast("date")).otherwise(F.col("ts"))).drop("n", "ord")
    last = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("ord"))))
    return last.where("nth = 1").drop("nth", "ord")


def new_series_file(spark: SparkSession, path: str, ids: list[str], statics: list[str], launch: str = "launch_date", origin: str | None = None) -> DataFrame:
    """``series_id, launch`` and statics of a file of upcoming series; without a launch date, the day after the origin."""
    raw = read_table(spark, path)
    if missing := [c for c in ids if c not in raw.columns]:
        raise ValueError(f"the file of new series lacks id columns {', '.join(missing)}")
    day = F.to_date(launch) if launch in raw.columns else F.date_add(F.lit(origin).cast("date"), 1)
    return raw.select(series_id(*[F.col(c) for c in ids]).alias("series_id"), day.alias("launch"), *[c for c in statics if c in raw.columns])


def upcoming(origin: str, history: DataFrame, listed: DataFrame | None = None, plans: DataFrame | None = None) -> DataFrame:
    """Series without a history: those of the file first, then those only in the latest snapshot, from their first planned day on."""
    o = F.lit(origin).cast("date")
    parts = []
    if listed is not None:
        parts.append(listed.withColumn("source", F.lit(0)))
    if plans is not None:
        seen = plans.where(F.col("as_of") <= o)
        latest = seen.agg(F.max("as_of").alias("latest"))  # one row
        first = seen.join(F.broadcast(latest), F.col("as_of") == F.col("latest")).groupBy("series_id").agg(F.min("ts").alias("day"))
        parts.append(first.select("series_id", F.greatest("day", F.date_add(o, 1)).alias("launch"), F.lit(1).alias("source")))
    if not parts:
        return history.sparkSession.createDataFrame([], "series_id string, launch date")
    union = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    first = union.join(history.select("series_id").distinct(), "series_id", "left_anti")
    order = Window.partitionBy("series_id").orderBy("source", "launch")
    return first.withColumn("nth", F.row_number().over(order)).where("nth = 1").drop("nth", "source")
