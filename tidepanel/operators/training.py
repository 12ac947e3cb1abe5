"""Which series a model trains on: profiles, capped class mixes, disjoint rounds."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.operators.panel import demand_classes
from tidepanel.operators.sampling import allocate, draw

#: What a mix may set, and the number of series above which a cap is required.
MIX_KEYS = ("classes", "lookback_days", "max_series", "max_share", "min_nonzero_days", "seed")
MAX_POOL = 200_000


def check_mix(mix: Mapping) -> None:
    if unknown := sorted(set(mix) - set(MIX_KEYS)):
        raise ValueError(f"training mix: unknown settings {', '.join(unknown)}; known: {', '.join(MIX_KEYS)}")
    shares = [float(x) for x in (mix.get("max_share") or {}).values()]
    if any(not 0 < x <= 1 for x in shares):
        raise ValueError("training mix: shares have to be above 0 and at most 1")
    if sum(x for x in shares if x < 1) >= 1:
        raise ValueError("training mix: capped shares have to add up to less than 1")
    if low := [k for k in ("lookback_days", "max_series", "min_nonzero_days") if int(mix.get(k) or 0) < 0]:
        raise ValueError(f"training mix: {', '.join(low)} can't be negative")


def series_profile(panel: DataFrame, as_of: str, lookback_days: int = 365, labels: DataFrame | None = None) -> DataFrame:
    """``series_id, demand_class, length, recent_nonzero`` from rows up to a day: one pass, one aggregate."""
    day = F.lit(as_of).cast("date")
    rows = panel.where(F.col("ts") <= day)
    sold = (F.col("ts") > F.date_sub(day, lookback_days)) & ~F.col("stockout") & (F.col("y") > 0)
    lengths = rows.groupBy("series_id").agg(F.count(F.lit(1)).alias("length"), F.count(F.when(sold, 1)).alias("recent_nonzero"))
    return demand_classes(rows, labels=labels).select("series_id", "demand_class").join(lengths, "series_id")


def capped_counts(available: Mapping[str, int], caps: Mapping[str, float]) -> dict[str, int]:
    """The largest counts such that no capped class has more than its share of all; classes without a cap keep everything.

    Classes bind in the order of available / cap: the more a class has for its share, the sooner.
    """
    limited = {k: float(x) for k, x in caps.items() if k in available and float(x) < 1}
    if sum(limited.values()) >= 1 and len(limited) == len(available):
        raise ValueError("capped shares of all classes have to leave room")
    order = sorted(limited, key=lambda k: (-available[k] / limited[k], k))
    binding: list[str] = []
    total = float(sum(available.values()))
    for k in order:
        if available[k] <= limited[k] * total + 1e-9:
            break
        binding.append(k)
        share = sum(limited[b] for b in binding)
        if share >= 1:
            raise ValueError("capped shares have to add up to less than 1")
        total = sum(v for c, v in available.items() if c not in binding) / (1 - share)
    return {k: min(v, math.floor(limited[k] * total + 1e-9)) if k in binding else v for k, v in available.items()}


def select_series(profile: DataFrame, horizon: int, mix: Mapping, used: DataFrame | None = None, round_index: int = 0, max_pool: int = MAX_POOL) -> tuple[DataFrame, dict]:
    """(``series_id, demand_class`` to train on, report) of one round; series of earlier rounds are never drawn again."""
    check_mix(mix)
    reasons = F.when(F.col("length") < 2 * horizon, "too_short")
    if mix.get("classes"):
        reasons = reasons.when(~F.col("demand_class").isin([str(c) for c in mix["classes"]]), "class")
    if mix.get("min_nonzero_days"):
        reasons = reasons.when(F.col("recent_nonzero") < int(mix["min_nonzero_days"]), "low_activity")
    marked = profile
    if used is not None:
        marked = marked.join(used.select("series_id").distinct().withColumn("used", F.lit(True)), "series_id", "left")
        reasons = reasons.when(F.col("used"), "earlier_rounds")
    marked = marked.withColumn("reason", reasons)
    counted = marked.groupBy("reason", "demand_class").count().collect()  # a row per reason and class
    report: dict = {"round": round_index, "n_series": sum(r["count"] for r in counted)}
    for r in counted:
        if r["reason"]:
            report[f"excluded_{r['reason']}"] = report.get(f"excluded_{r['reason']}", 0) + r["count"]
    available = {r["demand_class"]: r["count"] for r in sorted(counted, key=lambda r: r["demand_class"]) if r["reason"] is None}
    target = capped_counts(available, mix.get("max_share") or {})
    most = int(mix.get("max_series") or 0)
    if most and sum(target.values()) > most:
        target = allocate(target, most)
    if not most and sum(target.values()) > max_pool:
        raise ValueError(f"{sum(target.values()):,} series would be loaded for training, the limit is {max_pool:,}: set max_series and train in rounds, or raise the limit")
    chosen = draw(marked.where("reason is null").select("series_id", "demand_class"), "demand_class", target, int(mix.get("seed") or 0) + round_index)
    total = max(sum(target.values()), 1)
    report |= {"available": available, "selected": target, "share": {k: round(v / total, 4) for k, v in target.items()}, "n_selected": sum(target.values())}
    return chosen, report


def rounds(profile: DataFrame, horizon: int, mix: Mapping, n: int, max_pool: int = MAX_POOL) -> Iterator[tuple[DataFrame, dict]]:
    """Disjoint draws until the pool is empty; with more than one round, ``max_series`` says how many series each takes."""
    if n > 1 and not mix.get("max_series"):
        raise ValueError("training in rounds needs max_series: the number of series of a round")
    used: DataFrame | None = None
    for k in range(n):
        chosen, report = select_series(profile, horizon, mix, used, k, max_pool)
        if not report["n_selected"]:
            return
        yield chosen, report
        used = chosen.select("series_id") if used is None else used.unionByName(chosen.select("series_id"))


def learning_rates(rate: float, n: int) -> list[float]:
    """Steps down with the rounds: the last one trains at 1 / n of the first."""
    return [rate * (1 - k / n) for k in range(n)]
