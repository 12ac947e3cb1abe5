"""The gap-filled daily grid, and what is known of each series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.operators.prepare import PanelSpec

#: Limits of the demand classes.
ADI_LIMIT, CV2_LIMIT = 1.32, 0.49


def daily_grid(sales: DataFrame, spec: PanelSpec, end: str | None = None) -> DataFrame:
    """A row per series and day from its first row on; fill rules hold for absent rows only, but ffill fills nulls too.

    Each row is spread over the days up to the next one of its series, so no calendar is joined:
    one exchange by series, which later windows by series use again.
    """
    by = Window.partitionBy("series_id").orderBy("ts")
    rows = sales.withColumn("next_ts", F.lead("ts").over(by))
    before = by.rowsBetween(Window.unboundedPreceding, 0)
    kinds = dict(rows.dtypes)
    filled = {n: F.last(n, True).over(before) for n, rule in spec.covariates.items() if rule == "ffill"}
    rows = rows.withColumns(filled) if filled else rows
    if spec.grid_end == "global":
        last = sales.agg(F.max("ts").alias("last_ts"))  # one row
        if end:
            last = last.select(F.greatest("last_ts", F.lit(end).cast("date")).alias("last_ts"))
        rows = rows.join(F.broadcast(last))
    else:
        rows = rows.withColumn("last_ts", F.col("ts"))
    spread = rows.withColumn("day", F.explode(F.sequence("ts", F.coalesce(F.date_sub("next_ts", 1), F.greatest("ts", "last_ts")))))
    absent = F.col("day") != F.col("ts")
    cols = [F.when(absent, F.lit(0.0 if spec.missing_target == "zero" else None).cast("double")).otherwise(F.col("y")).alias("y"), (~absent & F.coalesce("stockout", F.lit(False))).alias("stockout")]
    for name, rule in spec.covariates.items():
        value = F.col(name) if rule == "ffill" else F.when(~absent, F.col(name))
        if kinds[name] == "string":
            value = F.coalesce(value, F.lit(""))
        elif rule == "zero":
            value = F.when(absent, F.lit(0).cast(kinds[name])).otherwise(F.col(name))
        cols.append(value.alias(name))
    return spread.select("series_id", F.col("day").alias("ts"), *cols)


def add_statics(panel: DataFrame, statics: DataFrame) -> DataFrame:
    """Attributes of the series; missing ones are the empty text."""
    names = [c for c in statics.columns if c != "series_id"]
    return panel.join(statics, "series_id", "left").select(*panel.columns, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in names])


def static_first_row(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Attributes from a series' first row, null included (as the empty text)."""
    return rows.groupBy("series_id").agg(*[F.coalesce(F.min_by(F.col(c), F.struct("ts", "ord")), F.lit("")).alias(c) for c in columns])


def date_span(rows: DataFrame) -> DataFrame:
    return rows.agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count_distinct("series_id").alias("n_series"))


def first_dates(rows: DataFrame) -> DataFrame:
    return rows.groupBy("series_id").agg(F.min("ts").alias("first_ts"))


def in_stock(y: Column | None = None) -> Column:
    """The target where the series was in stock."""
    return F.when(~F.col("stockout"), F.col("y") if y is None else y)


def demand_classes(panel: DataFrame, until: str | None = None, labels: DataFrame | None = None) -> DataFrame:
    """Syntetos-Boylan class by the interval between sales and the variation of their sizes.

    The interval counts days in stock, with or without a known target. Series without a day up to
    ``until`` are ``no_history``. ``labels`` (``series_id, label``) go before the figures; an empty one is ``unlabeled``.
    """
    seen = F.lit(True) if until is None else F.col("ts") <= F.lit(until).cast("date")
    stock = seen & ~F.col("stockout")
    hit = F.when(stock & (F.col("y") > 0), F.col("y"))
    stats = panel.groupBy("series_id").agg(F.count(F.when(seen, 1)).alias("days"), F.count(F.when(stock, 1)).alias("n"), F.count(hit).alias("n_nz"), F.avg(hit).alias("mean_nz"), F.stddev_pop(hit).alias("std_nz"))
    adi, cv2 = F.expr("try_divide(n, n_nz)"), F.expr("pow(try_divide(std_nz, mean_nz), 2)")
    smooth, steady = adi < ADI_LIMIT, cv2 < CV2_LIMIT
    named = F.when(F.col("n_nz") == 0, "no_demand").when(smooth & steady, "smooth").when(smooth, "erratic").when(steady, "intermittent").otherwise("lumpy")
    if labels is not None:
        stats = stats.join(labels.select("series_id", "label"), "series_id", "left")
        label = F.coalesce(F.col("label").cast("string"), F.lit(""))
        named = F.when(label == "", "unlabeled").otherwise(label)
    named = F.when(F.col("days") == 0, "no_history").otherwise(named)
    return stats.select("series_id", "n", "n_nz", F.round(adi, 6).alias("adi"), F.round(cv2, 6).alias("cv2"), named.alias("demand_class"))


def history_split(panel: DataFrame, origin: str, min_history: int, horizon: int) -> DataFrame:
    """Lifecycle of every series at an origin: established, short_history, new (within the horizon) or later."""
    o = F.lit(origin).cast("date")
    stats = panel.groupBy("series_id").agg(F.min("ts").alias("first_ts"), F.sum(F.when(F.col("ts") <= o, F.coalesce(in_stock(), F.lit(0.0))).otherwise(0.0)).alias("hist_sum"))
    age = F.datediff(o, "first_ts") + 1
    kind = F.when(age >= max(min_history, 1), "established").when(age > 0, "short_history").when(F.col("first_ts") <= F.date_add(o, horizon), "new").otherwise("later")
    return stats.select("series_id", "first_ts", F.greatest(age, F.lit(0)).cast("int").alias("hist_age"), "hist_sum", kind.alias("lifecycle"))


def mase_scale(panel: DataFrame, until: str, season: int) -> DataFrame:
    """Mean absolute seasonal difference of in-stock pairs."""
    by = Window.partitionBy("series_id").orderBy("ts")
    rows = panel.where(F.col("ts") <= F.lit(until).cast("date")).withColumn("v", in_stock())
    return rows.withColumn("d", F.abs(F.col("v") - F.lag("v", season).over(by))).groupBy("series_id").agg(F.avg("d").alias("mase_scale"))


def audit(panel: DataFrame) -> DataFrame:
    y = F.col("y")
    lengths = panel.groupBy("series_id").agg(F.count(F.lit(1)).alias("days"))
    sizes = lengths.agg(F.count(F.lit(1)).alias("n_series"), F.min("days").alias("min_days"), F.percentile("days", F.lit(0.5)).alias("median_days"), F.max("days").alias("max_days"))
    share = lambda c: F.round(F.avg(c.cast("int")), 6)
    rows = panel.agg(F.count(F.lit(1)).alias("n_rows"), share(F.coalesce(y == 0, F.lit(False))).alias("zero_share"), F.sum((y < 0).cast("bigint")).alias("negatives"), share(F.col("stockout")).alias("stockout_share"), share(y.isNull()).alias("missing_share"))
    return F.broadcast(sizes).join(rows)
