"""Project files, commands, resumable forecasts, plug-in models; on a synthetic data set."""

import json
import warnings
from datetime import date, timedelta
from pathlib import Path

import numpy as np
import pytest
import yaml

from tidepanel import commands
from tidepanel.operators import context, models
from tidepanel.project import demo, files, report, runs
from tidepanel.project.settings import Project, SettingsError, load_experiment, load_project

warnings.filterwarnings("ignore", message="plans at")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    where = tmp_path_factory.mktemp("demo")
    demo.write(spark, str(where), 40, 260)
    return where


def test_layers_of_settings(tmp_path, monkeypatch):
    (tmp_path / "base.yaml").write_text("name: base\ntask: {horizon: 14, horizon_buckets: [7, 14]}\nprofiles: {a: {season_length: 3}}\n")
    (tmp_path / "own.yaml").write_text("extends: base.yaml\ndata: {data_path: '${WHERE:-x}/sales', series_id_cols: sku}\nderived_columns:\nprofiles: {b: {task: {season_length: 5}}}\n")
    project = load_project(tmp_path / "own.yaml")
    assert (project.name, project.horizon, project.data_path, project.season_length, project.series_id_cols, project.derived_columns) == ("base", 14, "x/sales", 7, ["sku"], {})
    monkeypatch.setenv("WHERE", "y")
    project = load_project(tmp_path / "own.yaml", "a", ["covariate_eval_policy.price=actual", "known_covariate_cols=[price]", "service_level=0.8"])
    assert project.data_path == "y/sales" and project.season_length == 3 and project.covariate_eval_policy == {"price": "actual"} and project.quantiles == [0.1, 0.5, 0.8, 0.9, 0.95]
    assert load_project(tmp_path / "own.yaml", "b").season_length == 5 and project.spec().known == {"price": "ffill"}
    (tmp_path / "loop.yaml").write_text("extends: loop.yaml\n")
    (tmp_path / "twice.yaml").write_text("name: a\nname: b\n")
    (tmp_path / "both.yaml").write_text("horizon: 3\ntask: {horizon: 4}\n")
    (tmp_path / "unset.yaml").write_text("data_path: ${NOT_SET_ANYWHERE}\n")
    for name in ("loop", "twice", "both", "unset"):
        with pytest.raises(SettingsError):
            load_project(tmp_path / f"{name}.yaml")
    with pytest.raises(SettingsError, match="did you mean horizon"):
        Project({"horizn": 3})
    with pytest.raises(SettingsError) as e:
        Project({"freq": "W", "horizon": 0, "quantiles": [2], "known_covariate_cols": ["a"], "static_cols": ["a"], "slice_cols": ["z"], "cold_start": {"method": "x", "y": 1}, "in_stock_col": "i", "stockout_expr": "e", "start_date": "never"})
    assert str(e.value).count("\n  - ") >= 9  # all problems at once
    with pytest.raises(FileNotFoundError):
        load_project(tmp_path / "none.yaml")
    with pytest.raises(SettingsError):
        load_project(tmp_path / "own.yaml", "c")
    (tmp_path / "exp.yaml").write_text("name: e\nmodel: naive\n")
    with pytest.raises(SettingsError, match="hypothesis"):
        load_experiment(tmp_path / "exp.yaml")


def test_commands(spark, folder, capsys):
    base = ["-p", str(folder / "project.yaml"), "--profile", "short"]
    for argv in (["models"], ["models", "croston"], ["env"], [*base, "config", "--check-data"], [*base, "cutoffs"], [*base, "audit"], [*base, "leaderboard"]):
        assert commands.main(argv) == 0
    text = (folder / "reports/data_audit.md").read_text()
    assert "## Covariates" in text and "| price | known | numeric |" in text and "validation: 2022-" in text and "by in_stock_col" in text
    for model in ("naive", "seasonal_naive", "empirical"):
        assert commands.main([*base, "run", str(folder / f"{model}.yaml"), "--no-commit", "--save-predictions"]) == 0
        found = json.loads((folder / f"reports/scratch/{model}/run.json").read_text())
        assert found["overall"]["n"] > 0 and 0 < found["overall"]["wape"] < 2 and found["overall"]["mase"] > 0 and not found["inputs_changed"]
        assert {"fold", "bucket", "lifecycle", "model_age", "demand_class", "category"} <= set(found["tables"])
        assert (found["overall"].get("wql") is not None) == (model == "empirical") and (folder / f"reports/scratch/{model}/table_fold.csv").is_file()
        assert spark.read.parquet(str(folder / f"reports/predictions/{model}")).where("lifecycle != 'established'").count() >= 0
    out = folder / "sample"
    assert commands.main([*base, "sample", "--n", "12", "--by", "category", "--volume-bins", "2", "--floor", "1", "--out", str(out), "--manifest", str(folder / "m.csv")]) == 0
    assert spark.read.parquet(str(out)).select("sku").distinct().count() == 12 and len((folder / "m.csv").read_text().splitlines()) == 13
    assert commands.main([*base, "bench", str(folder / "naive.yaml"), "--series", "10"]) == 0
    capsys.readouterr()
    for argv in ([*base, "run", str(folder / "none.yaml"), "--no-commit"], [*base, "finetune", str(folder / "naive.yaml")], ["models", "x"], ["-p", "none.yaml", "config"], [*base, "-s", "horizon", "config"]):
        assert commands.main(argv) == 1
    assert capsys.readouterr().err.count("error: ") == 5


def test_forecasts_can_be_resumed(spark, folder):
    project, experiment = load_project(folder / "project.yaml", "short"), load_experiment(folder / "naive.yaml")
    out = str(folder / "forecast")
    first = runs.run_forecast(spark, project, experiment, out, shards=4, only=[0, 2])
    assert first["done"] == 2 and not files.exists(spark, f"{out}/_manifest.json")
    stamp = {p: p.stat().st_mtime_ns for p in Path(out).glob("parts/shard=*/*.parquet")}
    rest = runs.run_forecast(spark, project, experiment, out, shards=4, per_job=1)
    assert sorted(rest["written"]) == [1, 3] and rest["done"] == 4 and files.read_json(spark, f"{out}/_manifest.json")["shards"] == 4
    assert all(p.stat().st_mtime_ns == t for p, t in stamp.items())
    whole = runs.run_forecast(spark, project, experiment, str(folder / "whole"), shards=1)
    assert whole["origin"] == "2022-09-17"
    rows = lambda where: sorted(map(str, spark.read.parquet(f"{where}/parts").select("sku", "ts", "horizon", "y_pred", "lifecycle", "model").collect()))
    assert rows(out) == rows(str(folder / "whole")) and len(rows(out)) % 7 == 0
    other = load_project(folder / "project.yaml", "short", ["season_length=5"])
    with pytest.raises(ValueError, match="other inputs or settings"):
        runs.run_forecast(spark, other, experiment, out, shards=4)
    with pytest.raises(ValueError):
        runs.run_forecast(spark, project, experiment, out, shards=4, only=[7])
    assert runs.run_forecast(spark, other, experiment, out, shards=2, force=True)["done"] == 2
    assert sum(files.read_json(spark, f"{out}/_shard-{i:05d}.json")["rows"] for i in range(2)) == len(rows(out))


def test_inputs_that_change_are_noticed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    seen = files.Inputs(spark, {"a": str(tmp_path / "a.csv"), "none": None})
    assert seen.changed() == [] and list(seen.fingerprints) == ["a"] and len(seen.fingerprints["a"][0]["sha256"]) == 64
    (tmp_path / "a.csv").write_text("x\n2222\n")
    assert seen.changed() == ["a"]
    with pytest.raises(ValueError):
        seen.check()
    assert files.code_state()["in_repo"] in (True, False) and len(files.code_digest()) == 64


def test_contexts_end_at_the_origin(spark):
    day = lambda d: date(2024, 1, d)
    rows = [("a", day(d), float(d), d == 3, float(d * 10), "k") for d in range(1, 9)] + [("b", day(d), 1.0, False, None, None) for d in range(1, 4)] + [("c", day(1), 5.0, False, 1.0, "z")]
    panel = spark.createDataFrame(rows, "series_id string, ts date, y double, stockout boolean, price double, kind string")
    units = spark.createDataFrame([(s, day(6)) for s in "abc"], "series_id string, origin date")
    got = {r.series_id: r for r in context.contexts(panel, units, ["price", "kind"], 5).collect()}
    assert got["a"].target == [2, None, 4, 5, 6] and got["a"].price == [20, 30, 40, 50, 60] and got["a"].gap == 0
    assert got["b"].target == [1, 1, None, None, None] and got["b"].kind == ["", "", "", "", ""] and got["b"].gap == 3
    assert "c" not in got  # its only row lies a whole context back
    ahead = spark.createDataFrame([("a", day(6), 1, 7.0, None), ("a", day(6), 3, None, "q"), ("a", day(6), 9, 1.0, "q")], "series_id string, origin date, horizon int, price double, kind string")
    r = context.future_arrays(ahead, ["price", "kind"], 3).first()
    assert r.future_price == [7, None, None] and r.future_kind == ["", "", "q"]
    many = spark.createDataFrame([(f"s{i}", day(6), "g" if i < 5 else "h") for i in range(8)], "series_id string, origin date, cat string")
    sizes = [r["count"] for r in context.grouped(many, ["cat"], 2).groupBy("group", "chunk").count().collect()]
    assert sorted(sizes) == [1, 1, 2, 2, 2] and context.channels(panel, ["price", "x"], ["kind", "price"]) == (["price"], ["kind"])


def test_plug_in_models(spark):
    start = date(2024, 1, 1)
    rows = [(s, start + timedelta(d), v + d % 3, False) for s, v in (("a", 0.0), ("b", 10.0), ("c", 20.0)) for d in range(60)] + [("gone", start, 1.0, False)]
    panel = spark.createDataFrame(rows, "series_id string, ts date, y double, stockout boolean")
    origin = start + timedelta(50)
    seen = []

    class Both(context.ArrayForecaster):
        params = context.ArrayForecaster.params | {"shift": 0.0}

        def predict(self, batch, horizon, together):
            sums = np.array([np.nansum(x["target"]) for x in batch])
            level = sums.sum() if together else sums
            return np.stack([np.broadcast_to(level, len(batch)) + k + self.settings["shift"] for k in (-5, 0, 5)], 1)[:, None, :].repeat(horizon, 1)

    one = Both(3, 7, (0.1, 0.3, 0.9), context_length=20)
    got = {(r.series_id, r.horizon): r for r in one.forecast(panel, None, [origin]).collect()}
    assert len(got) == 9 and ("gone", 1) not in got
    a = got["a", 2]
    assert (a["q_0.1"], a["q_0.5"], a["q_0.9"]) == (a.y_pred - 5, a.y_pred, a.y_pred + 5) and a["q_0.3"] == pytest.approx(a.y_pred - 2.5) and a.ts == origin + timedelta(2)
    assert min(r["q_0.1"] for r in Both(3, 7, (0.1,), shift=-1e9).forecast(panel, None, [origin]).collect()) == 0  # demand was never negative
    grouped = Both(3, 7, group_by=["cat"], group_size=2)
    with pytest.raises(ValueError):
        grouped.forecast(panel, None, [origin])
    grouped.statics = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x")], "series_id string, cat string")
    together = {r.series_id: r.y_pred for r in grouped.forecast(panel, None, [origin]).collect()}
    assert together["a"] == together["b"] != together["c"]
    with pytest.raises(ValueError):
        Both(3, 7, nonsense=1)
    assert seen == []


def test_training_helpers(spark, tmp_path, folder):
    y = np.arange(50.0)
    cut = context.fixed_window(y, 10, 20, 5)
    assert len(cut) == 30 and cut[0] == 20 and cut[-1] == 49
    young = context.fixed_window(np.arange(12.0), 10, 20, 5)
    assert len(young) == 12 + 15 and np.isnan(young[:15]).all() and young[-1] == 11
    assert context.fixed_window(np.array(["a"] * 6, dtype=object), 5, 4, 3).tolist()[:1] == [""]
    with pytest.raises(ValueError):
        context.fixed_window(y, 3, 20, 5)
    assert context.thinned([(i, 1.0) for i in range(100)], 3) == [(0, 1.0), (50, 1.0), (99, 1.0)] and context.loaded("k", lambda: 5) == context.loaded("k", lambda: 6) == 5
    with pytest.raises(context.TrainedOnFutureError):
        context.check_checkpoint(tmp_path, date(2024, 1, 1))
    assert context.check_checkpoint(tmp_path, date(2024, 1, 1), True) is None
    (tmp_path / "manifest.json").write_text('{"train_end": "2024-01-02"}')
    assert context.check_checkpoint(tmp_path, date(2024, 1, 2))["train_end"] == "2024-01-02"
    with pytest.raises(context.TrainedOnFutureError):
        context.check_checkpoint(tmp_path, date(2024, 1, 1))
    with pytest.raises(context.TrainedOnFutureError):
        context.Empirical(3, 7, checkpoint=str(tmp_path)).fit(None, date(2024, 1, 1))

    class Trained(context.Empirical):
        params = context.Empirical.params | {"fine_tune": None}

        def train(self, rows, steps, rate, ids, out):
            (out / f"weights-{len(list(out.glob('weights*')))}").write_text(str(rows.select("series_id").distinct().count()))
            return {"loss": [(i, 1 / (i + 1)) for i in range(steps)], "steps": steps}

    models.register("trained", Trained)
    project = load_project(folder / "project.yaml", "short")
    experiment = {"name": "t", "hypothesis": "h", "model": "trained", "model_params": {"fine_tune": {"rounds": 2, "num_steps": 20, "train_mix": {"max_series": 10}}}, "based_on": None}
    facts = runs.run_training(spark, project, experiment, str(tmp_path / "ckpt"), as_of="2022-08-01")
    assert len(facts["rounds"]) == 2 and facts["n_series"] == 20 and [r["learning_rate"] for r in facts["rounds"]] == [1e-6, 5e-7] and (tmp_path / "ckpt/weights-1").read_text() == "10"
    assert context.check_checkpoint(tmp_path / "ckpt", date(2022, 8, 1)) and facts["data"][0] != facts["data"][1]
    with pytest.raises(FileExistsError):
        runs.run_training(spark, project, experiment, str(tmp_path / "ckpt"))


def test_report_of_labels(spark, folder):
    project = Project(yaml.safe_load((folder / "project.yaml").read_text())["task"] | {"static_cols": ["category"], "demand_label_col": "category", "data_path": str(folder / "sales"), "min_train_periods": 30, "n_folds": 1})
    found = runs.load(spark, project)
    text = report.audit_text(found.panel, found.n_raw, project, found.labels)
    assert "| food |" in text and "none declared" in text
