"""Dates of folds and origins: a few rows of arithmetic on the driver.

Cutoffs are retrain dates. Each leaves a whole horizon behind it, and no validation window reaches
into a holdout window.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from math import ceil


@dataclass(frozen=True)
class FoldRule:
    """How folds are laid out; explicit dates go before the rule."""

    horizon: int
    folds: int = 4
    step: int = 91
    holdouts: int = 1
    min_train: int = 0
    cutoffs: tuple[date, ...] = ()
    holdout_cutoffs: tuple[date, ...] = ()

    def __post_init__(self) -> None:
        if self.horizon < 1 or self.folds < 1 or self.step < 1 or self.holdouts < 0:
            raise ValueError("horizon, folds and step have to be at least 1, holdouts at least 0")

    @property
    def has_holdout(self) -> bool:
        return bool(self.holdouts or self.holdout_cutoffs)

    def holdout(self, first: date, last: date) -> list[date]:
        if self.holdout_cutoffs:
            return _inside(self.holdout_cutoffs, self.horizon, last)
        return self._supported([last - timedelta(self.horizon + i * self.step) for i in range(self.holdouts)], first, "holdout")

    def limit(self, first: date, last: date) -> date:
        """No validation window passes it: the first holdout cutoff, else the last day."""
        return min(self.holdout(first, last)) if self.has_holdout else last

    def validation(self, first: date, last: date) -> list[date]:
        window = timedelta(self.horizon)
        if self.cutoffs:
            out, limit = _inside(self.cutoffs, self.horizon, last), self.limit(first, last)
            if out[-1] + window > limit:
                raise ValueError(f"the horizon of validation cutoff {out[-1]} overlaps the holdout window from {limit} on")
            return out
        if self.holdout_cutoffs:
            newest = self.limit(first, last) - window
        else:
            newest = last - window - timedelta(self.step * (self.holdouts - 1 + ceil(self.horizon / self.step)) if self.holdouts else 0)
        return self._supported([newest - timedelta(i * self.step) for i in range(self.folds)], first, "validation")

    def _supported(self, dates: list[date], first: date, what: str) -> list[date]:
        out = sorted(d for d in dates if (d - first).days >= self.min_train)
        if dates and not out:
            raise ValueError(f"no {what} cutoff leaves {self.min_train} days of history")
        if len(out) < len(dates):
            warnings.warn(f"history supports {len(out)} of {len(dates)} {what} folds", stacklevel=3)
        return out


def _inside(dates: Sequence[date], horizon: int, last: date) -> list[date]:
    if late := [str(d) for d in sorted(dates) if d + timedelta(horizon) > last]:
        raise ValueError(f"the horizon of cutoffs {', '.join(late)} passes the last day {last}")
    return sorted(dates)


def cutoffs(first: date, last: date, horizon: int, folds: int, step: int, holdouts: int = 0, min_train: int = 0) -> dict[str, list[date]]:
    """Validation and holdout cutoffs by the rule."""
    rule = FoldRule(horizon, folds, step, holdouts, min_train)
    return {"validation": rule.validation(first, last), "holdout": rule.holdout(first, last)}


def origins(cuts: Sequence[date], horizon: int, limit: date, step: int | None = None) -> list[tuple[int, date, date]]:
    """(fold, cutoff, origin): every ``step`` days until the next cutoff, windows ending by ``limit``; without a step, the cutoffs."""
    out = []
    for k, cut in enumerate(cuts):
        if cut + timedelta(horizon) > limit:
            raise ValueError(f"the horizon of fold cutoff {cut} passes {limit}, which validation may not score")
        until = cuts[k + 1] if k + 1 < len(cuts) else limit
        days = range(0, max((until - cut).days, 1), step) if step else (0,)
        out += [(k, cut, cut + timedelta(d)) for d in days if cut + timedelta(d + horizon) <= limit]
    return out
