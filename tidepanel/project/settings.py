"""Project and experiment files: layers of YAML become one checked set of values.

Settings may stand at the top level or inside the section they belong to. Layers, later ones
first: ``--set`` overrides, a named profile, the file itself, the files it extends.
"""

from __future__ import annotations

import difflib
import os
import re
from collections.abc import Iterator, Mapping, Sequence
from copy import deepcopy
from datetime import date
from pathlib import Path

import yaml

from tidepanel.operators.coldstart import METHODS
from tidepanel.operators.prepare import PanelSpec
from tidepanel.plans.backtest import Task
from tidepanel.plans.folds import FoldRule
from tidepanel.plans.future import POLICIES

#: Every setting of a project by section, with its default.
SECTIONS: dict[str, dict[str, object]] = {
    "": {"name": "project"},
    "data": {"data_path": "data/raw/sales_sample.parquet", "timestamp_col": "date", "target_col": "units", "series_id_cols": ["sku"], "freq": "D"},
    "filters": {"start_date": None, "end_date": None, "row_filter": None, "min_history_days": 0},
    "preprocessing": {"derived_columns": {}, "duplicates": "error", "negative_target": "keep", "missing_target": "zero", "grid_end": "global"},
    "covariates": {"known_covariate_cols": [], "past_covariate_cols": [], "static_cols": [], "covariate_types": {}, "covariate_fill": {}, "demand_label_col": None, "in_stock_col": None, "stockout_expr": None},
    "plans": {"covariate_eval_policy": {}, "planned_covariates_path": None, "plan_as_of_col": "as_of", "plan_timestamp_col": None, "plan_columns": {}, "min_plan_coverage": 0.99, "plan_max_age_days": None},
    "task": {"horizon": 90, "horizon_buckets": [35, 90], "season_length": 7},
    "backtest": {"n_folds": 4, "fold_step": 91, "min_train_periods": 730, "holdout_folds": 1, "origin_step_days": None, "cutoffs": None, "holdout_cutoffs": None},
    "evaluation": {"quantiles": [0.1, 0.5, 0.9, 0.95], "service_level": None, "primary_metric": "wape", "verdict_threshold": 0.01, "max_missing_share": 0.01, "slice_cols": [], "success_criteria": {}},
    "new_series": {"cold_start": {}},
    "sharding": {"shard_by": []},
    "models": {"model_defaults": {}},
    "paths": {"reports_dir": "reports", "models_dir": "models"},
}
DEFAULTS = {key: value for section in SECTIONS.values() for key, value in section.items()}
#: What a setting may be.
CHOICES = {
    "duplicates": ("error", "sum", "mean", "max", "first", "last"), "negative_target": ("keep", "clip", "nan", "error"), "missing_target": ("zero", "nan"),
    "grid_end": ("global", "series"), "primary_metric": ("wape", "bias", "mase", "wql"), "freq": ("D",),
}
FILLS, KINDS = ("ffill", "zero", "nan"), ("numeric", "categorical")
COLD_START = {"method": "launch_profile", "profile_cols": [], "min_analogs": 5, "new_series_path": None, "launch_date_col": "launch_date", "from_plans": True}
EXPERIMENT = {"name": None, "hypothesis": None, "model": None, "model_params": {}, "mechanism": "", "rationale": "", "based_on": None}
PROFILE_VARIABLE, PROJECT_VARIABLE = "TIDEPANEL_PROFILE", "TIDEPANEL_PROJECT"


class SettingsError(ValueError):
    """All problems of a file at once."""

    def __init__(self, source: str, problems: Sequence[str]) -> None:
        super().__init__(f"{source}: " + (problems[0] if len(problems) == 1 else "".join(f"\n  - {p}" for p in problems)))


def read_yaml(path: str | Path) -> dict:
    """A file of settings; repeated keys are an error, as YAML would silently keep the last."""
    path = Path(path)
    if not path.is_file():
        raise FileNotFoundError(f"settings file {path} not found")
    try:
        tree = yaml.compose(path.read_text())
        if problems := list(_repeats(tree)):
            raise SettingsError(str(path), problems)
        found = yaml.safe_load(path.read_text())
    except yaml.YAMLError as e:
        raise SettingsError(str(path), [f"not valid YAML: {e}"]) from None
    if not isinstance(found or {}, dict):
        raise SettingsError(str(path), ["a mapping of settings is expected"])
    return found or {}


def _repeats(node: yaml.Node | None) -> Iterator[str]:
    if isinstance(node, yaml.MappingNode):
        seen: dict[str, int] = {}
        for key, value in node.value:
            line = key.start_mark.line + 1
            if key.value in seen:
                yield f"key {key.value} stands on lines {seen[key.value]} and {line}"
            seen[key.value] = line
            yield from _repeats(value)
    elif isinstance(node, yaml.SequenceNode):
        for value in node.value:
            yield from _repeats(value)


def merged(base: Mapping, over: Mapping) -> dict:
    """Mappings merge key by key, anything else is replaced."""
    out = deepcopy(dict(base))
    for key, value in over.items():
        both = isinstance(value, Mapping) and isinstance(out.get(key), Mapping)
        out[key] = merged(out[key], value) if both else deepcopy(value)
    return out


def flat(settings: Mapping, source: str) -> dict:
    """Sections dissolved; a key in two places is an error."""
    out: dict = {}
    for key, value in settings.items():
        own = value.items() if key in SECTIONS and isinstance(value, Mapping) else [(key, value)]
        for name, x in own:
            if name in out:
                raise SettingsError(source, [f"{name} is set twice"])
            out[name] = x
    return out


def layers(path: str | Path, above: tuple[Path, ...] = ()) -> tuple[dict, dict]:
    """(settings, profiles) of a file over those of the file it extends."""
    path = Path(path).resolve()
    if path in above:
        raise SettingsError(str(path), ["extends itself: " + " -> ".join(p.name for p in (*above, path))])
    own = read_yaml(path)
    parent, profiles = own.pop("extends", None), own.pop("profiles", None) or {}
    settings = flat(own, str(path))
    if parent:
        base, more = layers(path.parent / parent, (*above, path))
        settings, profiles = merged(base, settings), merged(more, profiles)
    return settings, profiles


def overridden(settings: Mapping, expressions: Sequence[str]) -> dict:
    """``key=value`` or ``key.inner=value``, values in YAML."""
    out = deepcopy(dict(settings))
    for text in expressions:
        key, sign, value = text.partition("=")
        if not sign:
            raise SettingsError("--set", [f"key=value is expected, not {text}"])
        *outer, last = key.strip().split(".")
        at = out
        for name in outer:
            at = at.setdefault(name, {})
            if not isinstance(at, dict):
                raise SettingsError("--set", [f"{name} in {text} is not a mapping"])
        at[last] = yaml.safe_load(value) if value.strip() else None
    return out


def from_environment(value: object) -> object:
    """``${NAME}`` and ``${NAME:-default}`` in any text."""
    if isinstance(value, Mapping):
        return {k: from_environment(v) for k, v in value.items()}
    if isinstance(value, list):
        return [from_environment(v) for v in value]
    if not isinstance(value, str):
        return value

    def found(m: re.Match) -> str:
        if (x := os.environ.get(m[1], m[2])) is None:
            raise SettingsError("environment", [f"{m[1]} is not set"])
        return x

    return re.sub(r"\$\{(\w+)(?::-([^}]*))?\}", found, value)


def _unknown(given: Mapping, known: Sequence[str]) -> list[str]:
    out = []
    for key in given:
        if key not in known:
            near = difflib.get_close_matches(str(key), list(known), 1)
            out.append(f"unknown setting {key}" + (f" (did you mean {near[0]}?)" if near else ""))
    return out


def _day(value: object) -> date | None:
    try:
        return value if isinstance(value, date) else date.fromisoformat(str(value)[:10])
    except ValueError:
        return None


class Project:
    """A project's settings as attributes."""

    def __init__(self, given: Mapping, source: str = "project") -> None:
        problems = _unknown(given, [*DEFAULTS, *filter(None, SECTIONS)])
        # a key without entries means its default
        self.values = deepcopy(DEFAULTS) | {k: v for k, v in given.items() if k in DEFAULTS and not (v is None and isinstance(DEFAULTS[k], list | dict))}
        if isinstance(self.values["series_id_cols"], str):
            self.values["series_id_cols"] = [self.values["series_id_cols"]]
        problems += list(self._problems())
        if problems:
            raise SettingsError(source, problems)
        levels = {*self.quantiles, 0.5, *([self.service_level] if self.service_level is not None else [])}
        self.values["quantiles"] = sorted(levels)

    def __getattr__(self, name: str) -> object:
        try:
            return self.__dict__["values"][name]
        except KeyError:
            raise AttributeError(name) from None

    def _problems(self) -> Iterator[str]:
        v = self.values
        for key, allowed in CHOICES.items():
            if v[key] not in allowed:
                yield f"{key}: {v[key]} is none of {', '.join(allowed)}"
        known, past, statics = (set(v[k]) for k in ("known_covariate_cols", "past_covariate_cols", "static_cols"))
        for a, b, what in ((known, past, "known and past"), (known, statics, "known and static"), (past, statics, "past and static")):
            if a & b:
                yield f"columns can't be both {what}: {', '.join(sorted(a & b))}"
        policies = v["covariate_eval_policy"]
        yield from (f"covariate_eval_policy: {c} is no known covariate" for c in policies if c not in known)
        yield from (f"covariate_eval_policy of {c}: {p} is none of {', '.join(POLICIES)}" for c, p in policies.items() if p not in POLICIES)
        if missing := [c for c in v["known_covariate_cols"] if c not in policies]:
            yield f"known covariates need a policy in covariate_eval_policy: {', '.join(missing)}"
        if "plan" in policies.values() and not v["planned_covariates_path"]:
            yield "covariate_eval_policy reads plans, but planned_covariates_path is not set"
        yield from (f"covariate_fill of {c}: {x} is none of {', '.join(FILLS)}" for c, x in v["covariate_fill"].items() if x not in FILLS)
        yield from (f"covariate_types of {c}: {x} is none of {', '.join(KINDS)}" for c, x in v["covariate_types"].items() if x not in KINDS)
        cold = v["cold_start"]
        yield from (f"cold_start: {x}" for x in _unknown(cold, list(COLD_START)))
        if cold.get("method", METHODS[0]) not in METHODS:
            yield f"cold_start.method: {cold['method']} is none of {', '.join(METHODS)}"
        pooled = [c for level in cold.get("profile_cols") or [] for c in (level if isinstance(level, list) else [level])]
        for key, cols, more in (("slice_cols", v["slice_cols"], {v["demand_label_col"]}), ("shard_by", v["shard_by"], set()), ("cold_start.profile_cols", pooled, set())):
            if bad := [c for c in cols if c not in statics | more]:
                yield f"{key} have to be static_cols: {', '.join(bad)}"
        if v["in_stock_col"] and v["stockout_expr"]:
            yield "set in_stock_col or stockout_expr, not both"
        for key, least in (("horizon", 1), ("season_length", 1), ("fold_step", 1), ("n_folds", 1), ("holdout_folds", 0), ("min_train_periods", 0), ("min_history_days", 0)):
            if not isinstance(v[key], int) or v[key] < least:
                yield f"{key} has to be a whole number of at least {least}"
        if v["origin_step_days"] is not None and (not isinstance(v["origin_step_days"], int) or v["origin_step_days"] < 1):
            yield "origin_step_days has to be at least 1, or null"
        edges = v["horizon_buckets"]
        if not edges or edges != sorted(set(edges)) or edges[0] < 1 or edges[-1] != v["horizon"] or any(int(e) != e for e in edges):
            yield "horizon_buckets have to be ascending whole numbers that end at the horizon"
        for key in ("start_date", "end_date"):
            if v[key] is not None and _day(v[key]) is None:
                yield f"{key}: {v[key]} is no date"
        for key in ("cutoffs", "holdout_cutoffs"):
            yield from (f"{key}: {d} is no date" for d in v[key] or [] if _day(d) is None)
        if not 0 < v["min_plan_coverage"] <= 1:
            yield "min_plan_coverage has to be above 0 and at most 1"
        if not 0 <= v["max_missing_share"] < 1:
            yield "max_missing_share has to be at least 0 and below 1"
        if any(not 0 < q < 1 for q in [*v["quantiles"], *([v["service_level"]] if v["service_level"] is not None else [])]):
            yield "quantiles and service_level have to be between 0 and 1"

    @property
    def cold(self) -> dict:
        return COLD_START | {k: x for k, x in self.cold_start.items() if x is not None}

    @property
    def profile_keys(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(c for level in self.cold["profile_cols"] for c in (level if isinstance(level, list) else [level])))

    def fill(self, column: str) -> str:
        return self.covariate_fill.get(column, "ffill" if column in self.known_covariate_cols else "nan")

    def spec(self) -> PanelSpec:
        extra = [*self.static_cols, *([self.demand_label_col] if self.demand_label_col else [])]
        return PanelSpec(
            timestamp=self.timestamp_col, target=self.target_col, ids=tuple(self.series_id_cols), known={c: self.fill(c) for c in self.known_covariate_cols}, past={c: self.fill(c) for c in self.past_covariate_cols},
            derived=self.derived_columns, row_filter=self.row_filter, stockout_expr=self.stockout_expr, in_stock_col=self.in_stock_col, start=_text(self.start_date), end=_text(self.end_date),
            negative=self.negative_target, duplicates=self.duplicates, missing_target=self.missing_target, grid_end=self.grid_end, extra=tuple(dict.fromkeys(extra)),
        )

    def folds(self) -> FoldRule:
        days = lambda found: tuple(sorted(_day(d) for d in found or ()))
        return FoldRule(self.horizon, self.n_folds, self.fold_step, self.holdout_folds, self.min_train_periods, days(self.cutoffs), days(self.holdout_cutoffs))

    def task(self) -> Task:
        return Task(self.horizon, self.season_length, self.min_history_days, tuple(self.horizon_buckets), tuple(self.quantiles), self.cold["method"], self.profile_keys, self.cold["min_analogs"], tuple(self.slice_cols))

    def model_settings(self, model: str, given: Mapping | None) -> dict:
        return merged(self.model_defaults.get(model) or {}, given or {})


def _text(day: object) -> str | None:
    return None if day is None else str(day)[:10]


def load_project(path: str | Path = "project.yaml", profile: str | None = None, overrides: Sequence[str] = ()) -> Project:
    settings, profiles = layers(path)
    profile = profile or os.environ.get(PROFILE_VARIABLE)
    if profile:
        if profile not in profiles:
            raise SettingsError(str(path), [f"no profile {profile}; there are: {', '.join(sorted(profiles)) or 'none'}"])
        settings = merged(settings, flat(profiles[profile] or {}, str(path)))
    return Project(from_environment(overridden(settings, overrides)), str(path))


def load_experiment(path: str | Path) -> dict:
    given = from_environment(read_yaml(path))
    problems = _unknown(given, list(EXPERIMENT)) + [f"{k} is missing" for k in ("name", "hypothesis", "model") if not given.get(k)]
    if problems:
        raise SettingsError(str(path), problems)
    return deepcopy(EXPERIMENT) | {k: v for k, v in given.items() if not (v is None and k == "model_params")}
