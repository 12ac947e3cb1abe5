"""What a plug-in model reads: one row of arrays per series and origin, and a base class for such models.

Contexts end at the origin: days after a series' last row are padded with null (text: the empty
one), so step 1 is always the day after the origin. Stockout days are null. A series whose last row
lies a whole context before the origin has no context, so it gets no forecast.
"""

from __future__ import annotations

import json
import os
from abc import abstractmethod
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from datetime import date
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.operators.coldstart import qname
from tidepanel.operators.models import Forecaster, register
from tidepanel.operators.panel import in_stock

#: Rows handed to a model at once by one task, whatever the model asks for.
MOST_ROWS = 4096


def channels(panel: DataFrame, known: Sequence[str], past: Sequence[str], use_past: bool = True) -> tuple[list[str], list[str]]:
    """Covariates that the panel has: known ones, and past ones if the model reads them."""
    return [c for c in known if c in panel.columns], [c for c in past if use_past and c in panel.columns and c not in known]


def _padded(values: Column, kind: str, n: Column) -> Column:
    fill = F.lit("") if kind == "string" else F.lit(None).cast("double")
    return F.concat(values, F.array_repeat(fill, n))


def contexts(panel: DataFrame, units: DataFrame, covariates: Sequence[str], length: int) -> DataFrame:
    """``series_id, origin, gap, target`` and an array per covariate, each of at most ``length`` days up to the origin."""
    kinds = dict(panel.dtypes)
    rows = panel.withColumn("v", in_stock()).select("series_id", "ts", "v", *covariates)
    own = units.select("series_id", "origin")
    rows = rows.join(own, "series_id").where((F.col("ts") <= F.col("origin")) & (F.col("ts") > F.date_sub("origin", length)))
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if kinds[c] == "string" else F.col(c).cast("double").alias(c) for c in covariates]
    rows = rows.select("series_id", "origin", F.struct("ts", "v", *cols).alias("day"))
    held = rows.groupBy("series_id", "origin").agg(F.sort_array(F.collect_list("day")).alias("days"))  # at most `length` days
    held = held.withColumn("gap", F.datediff("origin", F.element_at("days", -1)["ts"]))

    def values(name: str) -> Column:
        return F.transform("days", lambda d: d[name])

    arrays = [_padded(values(c), kinds.get(c, "double"), F.col("gap")).alias("target" if c == "v" else c) for c in ("v", *covariates)]
    return held.select("series_id", "origin", "gap", *arrays)


def future_arrays(future: DataFrame, known: Sequence[str], horizon: int) -> DataFrame:
    """``series_id, origin`` and an array of ``horizon`` values per known covariate; missing numbers are null, missing text is empty."""
    kinds = dict(future.dtypes)
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if kinds[c] == "string" else F.col(c).cast("double")
    held = future.where(F.col("horizon").between(1, horizon)).groupBy("series_id", "origin").agg(*[F.map_from_entries(F.collect_list(F.struct("horizon", value(c)))).alias(c) for c in known])
    steps = F.sequence(F.lit(1), F.lit(horizon))

    def array(c: str) -> Column:
        empty = F.lit("") if kinds[c] == "string" else F.lit(None).cast("double")
        return F.transform(steps, lambda h: F.coalesce(F.try_element_at(F.col(c), h), empty))

    return held.select("series_id", "origin", *[array(c).alias(f"future_{c}") for c in known])


def grouped(rows: DataFrame, by: Sequence[str], size: int) -> DataFrame:
    """``group, chunk``: series that share values are together, at most ``size`` in a chunk."""
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by]) if by else F.lit("")
    nth = F.row_number().over(Window.partitionBy("origin", "group").orderBy("series_id"))
    return rows.withColumn("group", key).withColumn("chunk", F.floor((nth - 1) / size).cast("int"))


def fixed_window(values: np.ndarray, window: int, context: int, horizon: int) -> np.ndarray:
    """A training series of which all targets lie in its last ``window`` days.

    The last window + context days stay, padded in front so that a trainer that cuts no earlier
    than ``context`` days in can cut from day max(horizon, days - window) on.
    """
    if window < horizon:
        raise ValueError(f"a training window of {window} days is shorter than the horizon of {horizon}")
    kept = values[max(0, len(values) - window - context) :]
    earliest = max(horizon, len(kept) - window)
    missing = max(0, context - earliest)
    fill = np.full(missing, "" if values.dtype.kind in "UO" else np.nan, dtype=object if values.dtype.kind in "UO" else float)
    return np.concatenate([fill, kept]) if missing else kept


def eligible(profile: DataFrame, horizon: int) -> tuple[int, int]:
    """How many series are long enough to train on, of how many."""
    r = profile.agg(F.count(F.when(F.col("length") >= 2 * horizon, 1)), F.count(F.lit(1))).first()
    if not r[0]:
        raise ValueError(f"no series has {2 * horizon} days of history, which training needs")
    return r[0], r[1]


def interpolated(levels: Sequence[float], values: np.ndarray, wanted: Sequence[float]) -> np.ndarray:
    """Quantiles (last axis: levels) at the wanted levels: linear between, clamped outside."""
    at = np.interp(wanted, levels, np.arange(len(levels)))
    low = np.floor(at).astype(int)
    high = np.minimum(low + 1, len(levels) - 1)
    share = at - low
    return values[..., low] * (1 - share) + values[..., high] * share


def thinned(curve: Sequence[tuple[int, float]], n: int) -> list[tuple[int, float]]:
    """At most n points of a loss curve, first and last among them."""
    if len(curve) <= n:
        return list(curve)
    return [curve[round(i * (len(curve) - 1) / max(n - 1, 1))] for i in range(n)]


_loaded: dict[str, object] = {}


def loaded(key: str, load: Callable[[], object]) -> object:
    """What a worker process loads once and uses for all its batches."""
    if key not in _loaded:
        _loaded[key] = load()
    return _loaded[key]


class TrainedOnFutureError(ValueError):
    """A checkpoint that has seen, or may have seen, what it would forecast."""


def check_checkpoint(folder: str | os.PathLike, cutoff: date, allow_unverified: bool = False) -> dict | None:
    """The manifest of a checkpoint that may forecast from a cutoff on; weights without one are refused."""
    file = Path(folder) / "manifest.json"
    if not file.is_file():
        if not allow_unverified:
            raise TrainedOnFutureError(f"{folder} doesn't tell what it was trained on; allow_unverified_checkpoint accepts it")
        return None
    manifest = json.loads(file.read_text())
    if date.fromisoformat(str(manifest["train_end"])[:10]) > cutoff:
        raise TrainedOnFutureError(f"{folder} was trained on data to {manifest['train_end']}, after the cutoff {cutoff}")
    return manifest


class ArrayForecaster(Forecaster):
    """A model on arrays. Subclasses give ``levels`` and ``predict``; see ``Empirical`` for one.

    ``context_length``: days fed per series; ``group_by``: statics of which series with equal values
    are forecast together; ``group_size``, ``chunk_series``: series in one call; ``past_covariates``:
    whether past covariates are fed; ``checkpoint``: trained weights, checked against every cutoff.
    """

    params: dict[str, object] = {"context_length": 512, "group_by": (), "group_size": 100, "chunk_series": 1024, "past_covariates": True, "checkpoint": None, "allow_unverified_checkpoint": False}
    levels: Sequence[float] = (0.1, 0.5, 0.9)
    #: Set by whoever runs the model: covariates, their future values, and statics.
    known: Sequence[str] = ()
    past: Sequence[str] = ()
    future: DataFrame | None = None
    statics: DataFrame | None = None

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("future", "statics")}  # tables stay on the driver

    @abstractmethod
    def predict(self, batch: list[dict], horizon: int, together: bool) -> np.ndarray:
        """Inputs (target, covariates, future_<name>) -> values by series, step and level."""

    def fit(self, panel: DataFrame, cutoff: date) -> None:
        if self.settings["checkpoint"]:
            check_checkpoint(self.settings["checkpoint"], cutoff, bool(self.settings["allow_unverified_checkpoint"]))

    def forecast(self, panel: DataFrame, units: DataFrame | None, origins: list[date]) -> DataFrame:
        if units is None:
            days = F.array(*[F.lit(str(o)).cast("date") for o in origins])
            units = panel.groupBy("series_id").agg(F.min("ts").alias("first_ts")).withColumn("origin", F.explode(days)).where("first_ts <= origin")
        known, past = channels(panel, self.known, self.past, bool(self.settings["past_covariates"]))
        rows = contexts(panel, units, [*known, *past], int(self.settings["context_length"]))
        if known and self.future is not None:
            rows = rows.join(future_arrays(self.future, known, self.horizon), ["series_id", "origin"], "left")
        # whether demand was ever negative, over all series of an origin
        days = [F.lit(str(o)).cast("date") for o in origins]
        low = panel.agg(*[F.min(F.when(F.col("ts") <= d, in_stock())).alias(str(i)) for i, d in enumerate(days)]).first()
        never_negative = {str(o) for i, o in enumerate(origins) if low[i] is None or low[i] >= 0}
        by = list(self.settings["group_by"] or ())
        if by:
            if self.statics is None or (missing := [c for c in by if c not in self.statics.columns]):
                raise ValueError(f"group_by needs statics {', '.join(by if self.statics is None else missing)}")
            rows = grouped(rows.join(self.statics.select("series_id", *by), "series_id", "left"), by, int(self.settings["group_size"])).drop(*by)
        wanted = sorted({*self.quantiles, 0.5})
        names = [qname(q) for q in wanted]
        horizon, predict, levels = self.horizon, self.predict, list(self.levels)
        chunk = min(int(self.settings["chunk_series"]), MOST_ROWS)
        schema = "series_id string, origin date, horizon int, ts date, y_pred double, " + ", ".join(f"`{n}` double" for n in names)
        fed = [c for c in rows.columns if c not in ("series_id", "origin", "gap", "group", "chunk")]

        def answer(part: pd.DataFrame, together: bool) -> pd.DataFrame:
            batch = [{c: np.array(v, dtype=object if any(isinstance(x, str) for x in v) else float) if v is not None else None for c, v in zip(fed, r, strict=True)} for r in part[fed].itertuples(index=False)]
            cube = interpolated(levels, np.asarray(predict(batch, horizon, together), float), wanted)
            calm = np.array([str(o)[:10] in never_negative for o in part["origin"]])
            cube = np.where(calm[:, None, None], np.maximum(cube, 0), cube)
            cube = np.sort(cube, axis=2).reshape(-1, len(wanted))
            steps = np.tile(np.arange(1, horizon + 1), len(part))
            start = pd.to_datetime(part["origin"].repeat(horizon)).reset_index(drop=True)
            out = pd.DataFrame({"series_id": part["series_id"].repeat(horizon).to_numpy(), "origin": start.dt.date, "horizon": steps, "ts": (start + pd.to_timedelta(steps, unit="D")).dt.date, "y_pred": cube[:, wanted.index(0.5)]})
            return out.assign(**{n: cube[:, i] for i, n in enumerate(names)})

        def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                for at in range(0, len(part), chunk):
                    yield answer(part.iloc[at : at + chunk], False)

        if by:
            return rows.groupBy("origin", "group", "chunk").applyInPandas(lambda part: answer(part, True), schema)
        return rows.mapInPandas(batches, schema)


class Empirical(ArrayForecaster):
    """Quantiles of the recent known days, the same for each step. ``recent``: how many."""

    params = ArrayForecaster.params | {"recent": 28}
    levels = (0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95)

    def predict(self, batch: list[dict], horizon: int, together: bool) -> np.ndarray:
        out = np.full((len(batch), horizon, len(self.levels)), np.nan)
        for i, one in enumerate(batch):
            seen = one["target"][~np.isnan(one["target"])][-int(self.settings["recent"]) :]
            if len(seen):
                out[i] = np.quantile(seen, self.levels)
        return out


register("empirical", Empirical)


def train_rounds(train: Callable[[DataFrame, int, float, Sequence[str]], Mapping], panel: DataFrame, draws: Iterable[tuple[DataFrame, dict]], n: int, steps: int, rate: float, as_of: str) -> dict:
    """Run a trainer over disjoint rounds and say what it was given: the manifest of a checkpoint.

    ``train(rows of the round, steps, learning rate, ids)`` returns facts, a ``loss`` curve among them.
    """
    from tidepanel.functions.columns import content_hash
    from tidepanel.operators.training import learning_rates

    facts, hashes, start, total = [], [], None, 0
    for (chosen, report), lr in zip(draws, learning_rates(rate, n), strict=False):
        rows = panel.where(F.col("ts") <= F.lit(as_of).cast("date")).join(chosen.select("series_id"), "series_id", "left_semi")
        seen = rows.agg(content_hash("series_id", "ts", "y", "stockout").alias("hash"), F.min("ts").alias("start")).first()
        ids = [r[0] for r in chosen.select("series_id").orderBy("series_id").collect()]  # at most the series of a round
        found = dict(train(rows, -(-steps // n), lr, ids))
        facts.append({"report": report, "learning_rate": lr, "loss": thinned(found.pop("loss", []), 50), **found})
        hashes.append(seen["hash"])
        start = seen["start"] if start is None else min(start, seen["start"])
        total += len(ids)
    if not facts:
        raise ValueError("there is no series to train on")
    return {"train_start": str(start), "train_end": as_of, "data": hashes, "rounds": facts, "n_series": total}
