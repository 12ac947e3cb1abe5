"""Models by name. A model forecasts given series from given origins.

``Forecaster.forecast`` takes the panel and the units (``origin, series_id``; all series that have
started if there are none given) and returns ``series_id, origin, horizon, ts, y_pred`` and, if it has quantiles, ``q_<level>`` columns.
A unit without a forecast may be left out; the backtest reports it.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.operators import forecast


class Forecaster(ABC):
    """``params`` names what may be set; ``complete`` says that every unit gets a forecast."""

    params: dict[str, object] = {}
    complete = False

    def __init__(self, horizon: int, season: int, quantiles: tuple[float, ...] = (), **given: object) -> None:
        if unknown := sorted(set(given) - set(self.params)):
            raise ValueError(f"{type(self).__name__}: unknown parameters {', '.join(unknown)}; known: {', '.join(sorted(self.params)) or 'none'}")
        self.horizon, self.season, self.quantiles = horizon, season, quantiles
        self.settings = {**self.params, **given}

    def fit(self, panel: DataFrame, cutoff: date) -> None:
        """Learn from rows up to the cutoff; called once for each fold, before its origins."""

    @abstractmethod
    def forecast(self, panel: DataFrame, units: DataFrame | None, origins: list[date]) -> DataFrame: ...


def _only(state: DataFrame, units: DataFrame | None) -> DataFrame:
    return state if units is None else state.join(units.select("series_id", "origin"), ["series_id", "origin"], "left_semi")


class Naive(Forecaster):
    """The last known value, flat."""

    complete = True

    def forecast(self, panel: DataFrame, units: DataFrame | None, origins: list[date]) -> DataFrame:
        return forecast.naive(_only(forecast.origin_states(panel, origins, 1), units), self.horizon)


class SeasonalNaive(Forecaster):
    """The same day one season before. ``season_length``: days, the project's if not given."""

    params = {"season_length": None}
    complete = True

    def forecast(self, panel: DataFrame, units: DataFrame | None, origins: list[date]) -> DataFrame:
        season = int(self.settings["season_length"] or self.season)
        return forecast.seasonal_naive(_only(forecast.origin_states(panel, origins, season), units), self.horizon, season)


class Croston(Forecaster):
    """Rate of intermittent demand with bias correction. ``alpha``: smoothing; ``window``: days looked back."""

    params = {"alpha": 0.1, "window": 365}
    complete = True

    def forecast(self, panel: DataFrame, units: DataFrame | None, origins: list[date]) -> DataFrame:
        rates = forecast.croston_rates(panel, origins, float(self.settings["alpha"]), int(self.settings["window"]))
        if units is None:
            days = F.array(*[F.lit(str(o)).cast("date") for o in origins])
            units = panel.groupBy("series_id").agg(F.min("ts").alias("first_ts")).withColumn("origin", F.explode(days)).where("first_ts <= origin")
        rows = units.select("series_id", "origin").join(rates, ["series_id", "origin"], "left")
        rows = rows.select("series_id", "origin", F.coalesce("rate", F.lit(0.0)).alias("y_pred"))
        return forecast.over_horizon(rows, self.horizon).select("series_id", "origin", "horizon", "ts", "y_pred")


REGISTRY: dict[str, type[Forecaster]] = {"naive": Naive, "seasonal_naive": SeasonalNaive, "croston": Croston}


def register(name: str, kind: type[Forecaster]) -> None:
    REGISTRY[name] = kind


def create(name: str, horizon: int, season: int, quantiles: tuple[float, ...] = (), **given: object) -> Forecaster:
    if name not in REGISTRY:
        raise ValueError(f"unknown model {name}; known: {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name](horizon, season, quantiles, **given)
