"""Stratified samples. Quotas are driver arithmetic on a row per stratum."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.sources.store import keep

#: Cells over which the members of a stratum are dealt before the smallest are taken.
SALTS = 64


def series_stats(rows: DataFrame, end: str | None = None, until: str | None = None, label: str | None = None) -> DataFrame:
    """Volume per day from a series' first row to the end (the last day of all if not given).

    Demand after ``until`` counts as 0, and ``until`` is the end then; first and last day and the
    label (the first row's) see all rows.
    """
    y = F.when(F.col("ts") <= F.lit(until).cast("date"), F.col("y")).otherwise(0.0) if until else F.col("y")
    aggs = [F.coalesce(F.sum(y), F.lit(0.0)).alias("total"), F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")]
    if label:
        aggs.append(F.min_by(F.col(label), F.when(F.col(label).isNotNull(), F.col("ts"))).alias("label"))
    stats = rows.groupBy("series_id").agg(*aggs)
    if until or end:
        stats = stats.withColumn("end", F.lit(until or end).cast("date"))
    else:
        stats = stats.join(F.broadcast(rows.agg(F.max("ts").alias("end"))))
    days = F.greatest(F.datediff("end", "first_ts") + 1, F.lit(1))
    return stats.withColumn("per_day", F.col("total") / days).drop("end")


def ranks(rows: DataFrame, *by: str) -> DataFrame:
    """``rank`` from 1 on in the order of ``by``, without one task for all rows: sorted ranges, each counted, then offset."""
    sorted_ = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    own = keep(sorted_.withColumn("part", F.spark_partition_id()), "ranges")  # written, so both readers see the same ranges
    nth = own.withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy(*by)))
    sizes = own.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select(F.col("part").alias("p"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row per partition
    return nth.join(F.broadcast(before), F.col("part") == F.col("p")).withColumn("rank", F.col("before") + F.col("nth")).drop("part", "p", "nth", "before")


def volume_bins(stats: DataFrame, bins: int) -> DataFrame:
    """Equal-count bins of the volume, ties by id; the edges of a range of n ranks are at 1 + (n - 1) k / bins."""
    n = stats.agg(F.count(F.lit(1)).alias("n_all"))  # one row
    ranked = ranks(stats, "per_day", "series_id").join(F.broadcast(n))
    k = F.least(F.lit(bins), F.col("n_all"))
    # the number of edges below the rank: k' with 1 + (n - 1) k' / k < rank, at most k - 1
    edge = F.ceil((F.col("rank") - 1) * k / F.greatest(F.col("n_all") - 1, F.lit(1))) - 1
    return ranked.withColumn("bin", F.greatest(F.least(edge, k - 1), F.lit(0)).cast("int")).drop("rank", "n_all")


def allocate(sizes: dict[str, int], n: int, floor: int = 0) -> dict[str, int]:
    """``n`` places (or all) over strata: the floor (or the size) first, the rest in proportion to the room that is left.

    Shares are rounded by largest remainder, ties in the order of ``sizes``. Floors that need more
    than ``n`` are scaled down in the same way.
    """
    n = min(n, sum(sizes.values()))
    base = {k: min(floor, s) for k, s in sizes.items()}

    def rounded(weights: dict[str, int], places: int) -> dict[str, int]:
        total = sum(weights.values())
        exact = {k: Fraction(w * places, total) for k, w in weights.items()}
        got = {k: int(x) for k, x in exact.items()}
        more = sorted((k for k in got if got[k] < sizes[k]), key=lambda k: got[k] - exact[k])  # stable: largest remainders first
        for k in more[: places - sum(got.values())]:
            got[k] += 1
        return got

    if sum(base.values()) >= n:
        return rounded(base, n) if sum(base.values()) > n else base
    quota = base
    while (left := n - sum(quota.values())) > 0:  # the room holds what is left, so each round places some
        add = rounded({k: sizes[k] - q for k, q in quota.items()}, left)
        quota = {k: min(q + add[k], sizes[k]) for k, q in quota.items()}
    return quota


def draw(rows: DataFrame, stratum: str, quotas: dict[str, int], seed: int) -> DataFrame:
    """So many members of each stratum, by hash order of the id: the same on every run.

    The smallest of each salted cell come first, so a large stratum doesn't meet in one task.
    """
    order: Column = F.md5(F.concat(F.lit(f"{seed}-"), F.col("series_id")))
    quota = F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv]) if quotas else F.create_map().cast("map<string,int>")
    most = max(quotas.values(), default=0)
    hashed = rows.withColumn("draw_order", order).withColumn("draw_cell", F.pmod(F.xxhash64("series_id"), F.lit(SALTS)))
    first = hashed.withColumn("nth", F.row_number().over(Window.partitionBy(stratum, "draw_cell").orderBy("draw_order", "series_id"))).where(F.col("nth") <= most)
    ranked = first.withColumn("nth", F.row_number().over(Window.partitionBy(stratum).orderBy("draw_order", "series_id"))).where(F.col("nth") <= most)
    return ranked.where(F.col("nth") <= F.coalesce(F.try_element_at(quota, F.col(stratum)), F.lit(0))).drop("nth", "draw_order", "draw_cell")


def stratified_sample(stats: DataFrame, n: int, bins: int, floor: int, seed: int) -> DataFrame:
    """``series_id, stratum, weight``: strata are label (if there is one) and volume bin; a weight is how many series a member stands for."""
    label = F.coalesce(F.col("label").cast("string"), F.lit("")) if "label" in stats.columns else F.lit("all")
    binned = volume_bins(stats, bins).select("series_id", F.concat(label, F.lit("|v"), F.col("bin").cast("string")).alias("stratum"))
    sizes = {r[0]: r[1] for r in binned.groupBy("stratum").count().orderBy("stratum").collect()}  # a row per stratum
    quotas = allocate(sizes, n, floor)
    weights = F.create_map(*[F.lit(x) for k, q in quotas.items() if q for x in (k, sizes[k] / q)]) if any(quotas.values()) else F.create_map().cast("map<string,double>")
    return draw(binned, "stratum", quotas, seed).withColumn("weight", F.try_element_at(weights, F.col("stratum")))
