"""Scores as additive partial sums, for any number of tables in one pass.

Rows are first summed up by series, origin and all keys of all tables; each table then adds up
those. What is summed adds up across shards too; ratios come last.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.columns import finite

UNIT = ("fold", "origin", "series_id")


def scorable(predictions: DataFrame) -> DataFrame:
    """Rows with a finite truth, in stock."""
    return predictions.withColumn("y_true", finite(F.col("y_true"))).withColumn("y_pred", finite(F.col("y_pred"))).where("y_true is not null and not coalesce(stockout, false)")


def _sums(levels: Mapping[str, float]) -> list[str]:
    more = ["n_q", "sum_y_q", *[f"{kind}_{i}" for i in range(len(levels)) for kind in ("pin", "hit")]] if levels else []
    return ["sum_y", "sum_abs", "sum_e", "n", "n_missing", *more]


def partial(predictions: DataFrame, tables: Mapping[str, Sequence[str]], levels: Mapping[str, float] | None = None) -> DataFrame:
    """``table``, the keys of all tables (null where a table doesn't have one) and sums that add up across shards.

    ``levels`` maps quantile columns to their levels. The mean over units (fold, origin, series) of
    error by scale, within each group, is kept as a sum and a count.
    """
    levels = dict(levels or {})
    keys = sorted({k for found in tables.values() for k in found})
    ok = F.col("y_pred").isNotNull()
    e, y = F.col("y_pred") - F.col("y_true"), F.col("y_true")
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    sums = [zero(F.when(ok, y)).alias("sum_y"), zero(F.abs(e)).alias("sum_abs"), zero(e).alias("sum_e"), F.count("y_pred").alias("n"), F.count(F.when(~ok, 1)).alias("n_missing")]
    full = ok
    for c in levels:
        full = full & finite(F.col(f"`{c}`")).isNotNull()
    if levels:
        sums += [F.count(F.when(full, 1)).alias("n_q"), zero(F.when(full, y)).alias("sum_y_q")]
    for i, (c, q) in enumerate(levels.items()):
        d = y - F.col(f"`{c}`")
        sums += [zero(F.when(full, F.greatest(q * d, (q - 1) * d))).alias(f"pin_{i}"), F.count(F.when(full & (d <= 0), 1)).alias(f"hit_{i}")]
    names = _sums(levels)
    unit = [F.col(c).alias(f"of_{c}") for c in UNIT]
    rows = scorable(predictions).select(*[F.col(k).alias(f"key_{k}") for k in keys], *unit, "y_true", "y_pred", "mase_scale", *[F.col(f"`{c}`") for c in levels])
    fine = rows.groupBy(*[f"key_{k}" for k in keys], *[f"of_{c}" for c in UNIT]).agg(*sums, F.max("mase_scale").alias("scale"))
    one = lambda name, own: F.struct(F.lit(name).alias("table"), *[(F.col(f"key_{k}") if k in own else F.lit(None).cast(rows.schema[f"key_{k}"].dataType)).alias(k) for k in keys])
    each = fine.withColumn("t", F.explode(F.array(*[one(name, own) for name, own in tables.items()]))).select("t.*", *[f"of_{c}" for c in UNIT], *names, "scale")
    if whole := [name for name, own in tables.items() if not own]:  # a table without keys has a row even if there is nothing to score
        zeros = predictions.sparkSession.createDataFrame([(name,) for name in whole], "table string")
        kinds = dict(each.dtypes)
        each = each.unionByName(zeros.select("table", *[(F.lit(0) if c in names else F.lit(None)).cast(kinds[c]).alias(c) for c in each.columns if c != "table"]))
    units = each.groupBy("table", *keys, *[f"of_{c}" for c in UNIT]).agg(*[F.sum(n).alias(n) for n in names], F.max("scale").alias("scale"))
    error = F.when((F.col("scale") > 0) & (F.col("n") > 0), F.col("sum_abs") / F.col("n") / F.col("scale"))
    return units.groupBy("table", *keys).agg(*[F.sum(n).alias(n) for n in names], zero(error).alias("mase_sum"), F.count(error).alias("mase_n"))


def combine(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial sums of shards, or of a finer table, added up."""
    added = [c for c in partials.columns if c not in keys and (c in ("n", "n_missing", "n_q") or c.startswith(("sum_", "pin_", "hit_", "mase_")))]
    return partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in added])


def finalize(partials: DataFrame, keys: Sequence[str], levels: Mapping[str, float] | None = None, digits: int = 6) -> DataFrame:
    """Ratios; quantile figures only where every valid row of the group has all quantiles."""
    ratio = lambda a, b: F.round(F.try_divide(a, F.when(b != 0, b)), digits)
    c = F.col
    out = [ratio(c("sum_abs"), c("sum_y")).alias("wape"), ratio(c("sum_e"), c("sum_y")).alias("bias"), c("n").cast("bigint").alias("n"), c("n_missing").cast("bigint").alias("n_missing"), ratio(c("mase_sum"), c("mase_n").cast("double")).alias("mase")]
    if levels:
        full = c("n_q") >= c("n")
        loss = sum((2 * c(f"pin_{i}") for i in range(len(levels))), F.lit(0.0)) / len(levels)
        out.append(F.when(full, ratio(loss, c("sum_y_q"))).alias("wql"))
        out += [F.when(full, ratio(c(f"hit_{i}").cast("double"), c("n_q").cast("double"))).alias(f"cov_{q:g}".replace(".", "_")) for i, q in enumerate(levels.values())]
    return partials.select(*keys, *out)


def score(predictions: DataFrame, keys: Sequence[str] = (), levels: Mapping[str, float] | None = None) -> DataFrame:
    """One table."""
    return finalize(partial(predictions, {"t": keys}, levels), keys, levels)


def standard_tables(slices: Sequence[str] = (), ages: bool = False, classes: bool = False) -> dict[str, list[str]]:
    """The tables of a run: whole, by fold, horizon bucket and lifecycle; by model age, class and slices where asked for."""
    out: dict[str, list[str]] = {"overall": [], "fold": ["fold"], "bucket": ["bucket"], "lifecycle": ["lifecycle"]}
    if ages:
        out["model_age"] = ["model_age_weeks"]
    if classes:
        out |= {"demand_class": ["demand_class"], "bucket_x_class": ["bucket", "demand_class"]}
    return out | {c: [c] for c in slices if c != "demand_class"}
