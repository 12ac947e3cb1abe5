"""Column expressions of the panel."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def series_id(*cols: Column, sep: str = "|") -> Column:
    """Id columns as text; whole floats lose their fraction, missing becomes the empty text."""
    return F.concat_ws(sep, *[F.coalesce(F.regexp_replace(c.cast("string"), r"^(-?\d+)\.0+$", "$1"), F.lit("")) for c in cols])


def split_ids(series: Column, n: int, sep: str = "|") -> list[Column]:
    """The id columns again; the last keeps further separators."""
    parts = F.split(series, "[" + re.escape(sep) + "]", n)
    return [parts.getItem(i) for i in range(n)]


def finite(c: Column) -> Column:
    """Null for NaN and infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def bucket(horizon: Column, edges: list[int]) -> Column:
    """Labels of (lo, hi] ranges, such as h01-07."""
    out, low = None, 0
    for high in edges:
        label = F.lit(f"h{low + 1:02d}-{high}")
        out = F.when(horizon <= high, label) if out is None else out.when(horizon <= high, label)
        low = high
    return out


def interpolate_quantiles(levels: list[float], values: Column, wanted: list[float]) -> list[Column]:
    """Linear between known levels, clamped outside; the result is in ascending order."""
    out = []
    for q in wanted:
        if q <= levels[0]:
            out.append(values[0])
        elif q >= levels[-1]:
            out.append(values[len(levels) - 1])
        else:
            k = max(i for i, x in enumerate(levels) if x <= q)
            share = (q - levels[k]) / (levels[k + 1] - levels[k])
            out.append(values[k] * (1 - share) + values[k + 1] * share)
    ordered = F.array_sort(F.array(*out))
    return [ordered[i] for i in range(len(out))]


def shard_of(shards: int, *cols: Column) -> Column:
    """Shard of a row by its columns as text: the same in every run and on every cluster."""
    return F.pmod(F.xxhash64(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols]), F.lit(shards)).cast("int")


def content_hash(*cols: str) -> Column:
    """Aggregate: a fingerprint of rows in any order, repeats included."""
    return F.concat_ws("-", F.count(F.lit(1)), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")))
