"""Panel operators: every query against its SQL on small tables, known values, no leakage."""

import datetime
import glob
import math
import os
from datetime import date

import duckdb
import pandas as pd
import pytest

from tidepanel import queries as q
from tidepanel.functions.columns import interpolate_quantiles, series_id, split_ids
from tidepanel.functions.expressions import inputs_of, translate_expression
from tidepanel.operators import coldstart, forecast, models, panel, sampling, score, training
from tidepanel.operators import prepare as prep
from tidepanel.operators.prepare import PanelSpec, sales
from tidepanel.plans import backtest, folds, future, ledger
from tidepanel.sources import snapshots
from tidepanel.sources.tables import expand, only_series, only_shard, read_table, write_forecast

SF = "/root/testdata/sf0.001"


def _plain(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, (pd.Timestamp, datetime.datetime)):
        return str(v)[:10]
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return f"{float(v):.5f}"
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", ["dedupe_sum", "daily_grid_global", "demand_class_sb", "croston_sba", "future_plan", "launch_profile_rollup", "cold_start_new", "score_bucket_x_fold", "stratified_sample"])
def test_query_equals_sql(spark, duck, name):
    found = duck.sql(q.oracle_sql()[name])
    cols = sorted(found.columns)
    want = sorted(tuple(_plain(r[found.columns.index(c)]) for c in cols) for r in found.fetchall())
    got = q.queries()[name](spark, SF)
    assert sorted(got.columns) == cols
    assert sorted(tuple(_plain(r[c]) for c in cols) for r in got.collect()) == want


def test_every_query_has_sql():
    assert set(q.queries()) == set(q.oracle_sql())


SPEC = PanelSpec(timestamp="date", target="units", ids=("sku",), known={"price": "ffill"}, past={"sessions": "nan"}, in_stock_col="in_stock")


def _raw(spark):
    rows = [("S0", date(2024, 1, 1), 5.0, 10.0, 1.0, 1), ("S0", date(2024, 1, 4), None, None, 2.0, 1), ("S0", date(2024, 1, 5), 3.0, 8.0, None, 0), ("S1", date(2024, 1, 3), 1.0, 9.0, 4.0, None)]
    return spark.createDataFrame(rows, "sku string, date date, units double, price double, sessions double, in_stock int")


def test_absent_is_zero_but_null_stays_null(spark):
    grid = {(r.series_id, r.ts.day): r for r in panel.daily_grid(sales(_raw(spark), SPEC), SPEC).collect()}
    assert grid["S0", 2].y == 0 and grid["S0", 4].y is None
    assert grid["S0", 4].price == 10.0 and grid["S0", 5].price == 8.0  # ffill covers null cells as well
    assert grid["S0", 2].sessions is None and grid["S0", 5].stockout and not grid["S1", 3].stockout
    assert ("S1", 2) not in grid and grid["S1", 5].y == 0


def test_forecasts_see_nothing_after_the_origin(spark):
    rows = [("A", date(2024, 1, d), float(d)) for d in range(1, 21)]
    tampered = [(s, t, y if t <= date(2024, 1, 10) else 999.0) for s, t, y in rows]
    out = []
    for x in (rows, tampered):
        df = spark.createDataFrame(x, "series_id string, ts date, y double").selectExpr("*", "false as stockout")
        state = forecast.origin_states(df, [date(2024, 1, 10)], 7)
        out.append(sorted(forecast.seasonal_naive(state, 7, 7).collect()) + sorted(forecast.naive(state, 7).collect()) + sorted(forecast.croston(df, "2024-01-10").collect()))
    assert out[0] == out[1]
    assert [r.y_pred for r in out[0][:7]] == [4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0]


def test_known_scores(spark):
    rows = [(0, "a", 10.0, p, False) for p in (12.0, 8.0, 10.0, 10.0)] + [(0, "a", 10.0, 99.0, True), (0, "a", 10.0, float("inf"), False), (0, "a", None, 1.0, False)]
    df = spark.createDataFrame(rows, "fold int, series_id string, y_true double, y_pred double, stockout boolean")
    df = df.selectExpr("*", "date'2024-01-01' as origin", "2.0D as mase_scale", "y_pred - 1 as `q_0.1`", "if(y_pred = 12, null, y_pred + 1) as `q_0.9`")
    r = score.score(df, ["fold"]).first()
    assert (r.wape, r.bias, r.n, r.n_missing, r.mase) == (0.1, 0.0, 4, 1, 0.5)
    empty = score.score(df.limit(0)).first()
    assert empty.n == 0 and empty.wape is None and empty.mase is None
    levels = {"q_0.1": 0.1, "q_0.9": 0.9}
    assert score.score(df, ["fold"], levels).first().wql is None  # one valid row lacks a quantile
    whole = df.where("y_pred != 12")
    r = score.score(whole, [], {"q_0.1": 0.1}).first()
    assert r.cov_0_1 == 0 and r.wql == pytest.approx(2 * (0.1 * 3 + 0.1 * 1 + 0.1 * 1) / 30, abs=1e-6)
    shards = score.partial(whole.where("y_pred = 8"), {"t": []}, levels).unionByName(score.partial(whole.where("y_pred != 8"), {"t": []}, levels))
    one, two = score.finalize(score.combine(shards, []), [], levels).first(), score.score(whole, [], levels).first()
    assert one.asDict() | {"mase": None} == two.asDict() | {"mase": None}  # the one series is split here, so its units are


def test_folds():
    cuts = folds.cutoffs(date(2024, 1, 1), date(2024, 12, 31), 14, folds=2, step=14, holdouts=1, min_train=60)
    assert cuts == {"validation": [date(2024, 11, 19), date(2024, 12, 3)], "holdout": [date(2024, 12, 17)]}
    assert [o for *_, o in folds.origins(cuts["validation"], 14, cuts["holdout"][0], 7)] == [date(2024, 11, 19), date(2024, 11, 26), date(2024, 12, 3)]
    at = lambda **k: folds.FoldRule(10, **{"folds": 1, "step": 10, "holdouts": 0} | k)
    first, last = date(2024, 1, 1), date(2024, 1, 21)
    assert at(min_train=10).validation(first, last) == [date(2024, 1, 11)]
    for rule in (at(min_train=11), at(cutoffs=(date(2024, 1, 12),)), at(holdouts=1, cutoffs=(date(2024, 1, 3),))):
        with pytest.raises(ValueError):
            rule.validation(first, last)
    with pytest.warns(UserWarning):
        assert len(at(folds=3, min_train=0).validation(first, last)) == 2
    late = at(holdout_cutoffs=(date(2024, 1, 11),))
    assert late.limit(first, last) == date(2024, 1, 11) and late.validation(first, last) == [date(2024, 1, 1)]
    with pytest.raises(ValueError):
        folds.origins([date(2024, 1, 5)], 10, date(2024, 1, 14), 3)
    assert folds.origins([date(2024, 1, 1), date(2024, 1, 4)], 3, date(2024, 1, 9)) == [(0, date(2024, 1, 1), date(2024, 1, 1)), (1, date(2024, 1, 4), date(2024, 1, 4))]


def test_quotas():
    assert sampling.allocate({"a": 1000, "b": 50, "c": 3}, 300, 20) == {"a": 269, "b": 28, "c": 3}
    assert sampling.allocate({"a": 50, "b": 50, "c": 50}, 30, 20) == {"a": 10, "b": 10, "c": 10}
    assert sampling.allocate({"a": 50, "b": 50, "c": 50}, 31, 20)["a"] == 11
    assert sampling.allocate({"a": 1, "b": 2}, 100, 5) == {"a": 1, "b": 2} and sampling.allocate({}, 5) == {}
    for n in range(0, 70, 7):
        got = sampling.allocate({"a": 40, "b": 13, "c": 1, "d": 9}, n, 2)
        assert sum(got.values()) == min(n, 63) and all(got[k] <= x for k, x in {"a": 40, "b": 13, "c": 1, "d": 9}.items())
    assert training.capped_counts({"BAU": 6, "intermittent": 18}, {"intermittent": 0.25}) == {"BAU": 6, "intermittent": 2}
    assert training.capped_counts({"a": 5, "b": 5}, {"a": 0.9}) == {"a": 5, "b": 5}
    got = training.capped_counts({"a": 100, "b": 100, "c": 30}, {"a": 0.3, "b": 0.3})
    assert got == {"a": 22, "b": 22, "c": 30} and max(got["a"], got["b"]) <= 0.3 * sum(got.values())
    with pytest.raises(ValueError):
        training.capped_counts({"a": 5, "b": 5}, {"a": 0.6, "b": 0.6})
    with pytest.raises(ValueError):
        training.check_mix({"max_share": {"a": 0.6, "b": 0.5}})


def test_training_rounds_are_disjoint(spark):
    rows = [(f"s{i}", "lumpy" if i % 3 else "smooth", 100 if i % 10 else 5, i % 7) for i in range(200)]
    profile = spark.createDataFrame(rows, "series_id string, demand_class string, length long, recent_nonzero long")
    mix = {"max_series": 60, "max_share": {"lumpy": 0.5}, "min_nonzero_days": 1}
    made = list(training.rounds(profile, 30, mix, 5))
    ids = [{r.series_id for r in chosen.collect()} for chosen, _ in made]
    assert len(ids) >= 2 and sum(map(len, ids)) == len(set().union(*ids)) and all(len(x) == r["n_selected"] for x, (_, r) in zip(ids, made, strict=True))
    first = made[0][1]
    assert first["excluded_too_short"] == 20 and first["share"]["lumpy"] <= 0.5 and made[1][1]["excluded_earlier_rounds"] == len(ids[0])
    with pytest.raises(ValueError):
        list(training.rounds(profile, 30, {}, 2))
    with pytest.raises(ValueError):
        training.select_series(profile, 30, {}, max_pool=10)
    assert training.learning_rates(1.0, 4) == [1.0, 0.75, 0.5, 0.25]


def test_backtest_owes_rows(spark):
    """Ended series, short and new ones, models that leave series out: each has its rows."""
    day = lambda d: date(2024, 1, d)
    rows = [("old", day(d), float(d), False) for d in range(1, 31)] + [("ended", day(d), 1.0, False) for d in range(1, 6)] + [("short", day(d), 4.0, False) for d in range(9, 31)] + [("new", day(d), 6.0, False) for d in range(12, 31)]
    grid = spark.createDataFrame(rows, "series_id string, ts date, y double, stockout boolean")
    origins = [(0, day(10), day(10)), (0, day(10), day(15))]

    class Partly(models.Naive):
        complete = False

        def forecast(self, panel, units, origins):
            return super().forecast(panel, units, origins).where("series_id != 'ended'")

    for kind, method in ((models.Naive, "zero"), (Partly, "none")):
        out = backtest.backtest(grid, origins, backtest.Task(5, 7, 5, (5,), method=method), kind(5, 7)).collect()
        kinds = {(r.series_id, r.origin.day): r.lifecycle for r in out}
        assert kinds == {("old", 10): "established", ("ended", 10): "established", ("short", 10): "short_history", ("new", 10): "new", ("old", 15): "established", ("ended", 15): "established", ("short", 15): "established", ("new", 15): "short_history"}
        assert len(out) == 8 * 5
        by = {(r.series_id, r.origin.day, r.horizon): r for r in out}
        assert by["old", 10, 3].y_pred == 10 and by["old", 10, 3].y_true == 13 and by["old", 15, 1].model_age_days == 5
        assert by["ended", 10, 1].y_pred == (1.0 if kind is models.Naive else None) and by["ended", 10, 1].y_true is None
        assert by["new", 10, 5].y_pred == (0.0 if method == "zero" else None) and by["new", 10, 5].y_true == 6
    with pytest.raises(ValueError):
        models.create("naive", 5, 7, alpha=1)
    with pytest.raises(ValueError):
        models.create("nothing", 5, 7)


def test_cold_start_over_levels_and_origins(spark):
    day = lambda d: date(2024, 1, 1) + datetime.timedelta(d)
    rows = [("base", day(d), 1.0, False) for d in range(60)]
    for i in range(6):  # launches of category x sell 10 a day from their second week on, of y 2
        rows += [(f"x{i}", day(d), 10.0 if d - i >= 7 else 4.0, False) for d in range(1 + i, 60)]
        rows += [(f"y{i}", day(d), 2.0, False) for d in range(1 + i, 60)]
    rows += [("late", day(d), 20.0, False) for d in range(38, 60)] + [("next", day(d), 3.0, False) for d in range(42, 60)]
    grid = spark.createDataFrame(rows, "series_id string, ts date, y double, stockout boolean")
    statics = spark.createDataFrame([(f"{c}{i}", c) for c in "xy" for i in range(6)] + [("late", "x"), ("next", "none like it"), ("base", "x")], "series_id string, cat string")
    task = backtest.Task(10, 7, 20, (10,), (0.5,), profile_keys=("cat",), min_analogs=3)

    class WithQuantile(models.Naive):
        def forecast(self, panel, units, origins):
            return super().forecast(panel, units, origins).selectExpr("*", "y_pred as `q_0.5`")

    out = backtest.backtest(grid, [(0, day(40), day(40))], task, WithQuantile(10, 7), statics).collect()
    by = {(r.series_id, r.horizon): r for r in out}
    assert by["late", 1].lifecycle == "short_history" and by["next", 1].lifecycle == "new"
    assert by["next", 1].y_pred == 0  # before its launch
    assert by["next", 3].y_pred == pytest.approx(by["next", 3]["q_0.5"], abs=3) and 2 <= by["next", 3].y_pred <= 4  # the coarsest level: mean of both
    expected, prior = 3 * 4.0, 7 * 4.0
    assert by["late", 10].y_pred == pytest.approx(10.0 * min(max((60 + prior) / (expected + prior), 0.2), 5.0))


def test_gates(spark):
    raw = spark.createDataFrame([("S0", None, 5.0, "1", "u"), ("S0", "2024-01-02", 6.0, "2", "v")] + [("S0", f"2024-02-{d:02d}", 1.0, "7" if d != 9 else "n/a", "w") for d in range(1, 29)], "sku string, date string, units double, price string, kind string")
    spec = PanelSpec(timestamp="date", target="units", ids=("sku",), known={"price": "ffill", "kind": "ffill"}, start="2024-02-01")
    with pytest.raises(Exception, match="null dates in date"):
        prep.prepare(raw, spec).collect()
    rows = prep.prepare(raw.where("date is not null"), spec)
    assert rows.count() == 28
    with pytest.raises(ValueError):
        prep.require_rows(rows.where("false"))
    made, names = prep.coerce_covariates(rows, spec, limit=0.05)
    assert names == ["price"] and made.where("price is null").count() == 1
    assert prep.coerce_covariates(rows, spec, limit=0.01)[1] == [] and prep.coerce_covariates(rows, spec, pinned={"price": "categorical"}, limit=0.5)[1] == []
    days = sales(raw.where("date is not null"), spec)
    grid = panel.daily_grid(days, spec)
    assert prep.check_mass(days, grid)[0] == 28
    with pytest.raises(ValueError):
        prep.check_mass(days, grid.where("ts < '2024-02-10'"))
    lenient = prep.derive(raw, {"a": "units * 2", "b": "a + nothing", "c": "a + 1"}, strict=False)
    assert "c" in lenient.columns and "b" not in lenient.columns
    labels = spark.createDataFrame([("S0", "")], "series_id string, label string")
    assert panel.demand_classes(grid, labels=labels).first().demand_class == "unlabeled"
    assert panel.demand_classes(grid, until="2023-01-01").first().demand_class == "no_history"


def test_plans_and_upcoming_series(spark, tmp_path):
    raw = spark.createDataFrame([("a", "2024-01-01", "2024-01-02", 1.0, 1), ("a", "2024-01-01", "2024-01-02", 2.0, 2), ("z", "2024-01-01", "2024-01-09", 3.0, 3), ("a", "2024-02-01", "2024-02-03", 9.0, 4)], "sku string, issued string, day string, planned double, n int")
    read = lambda **k: snapshots.plan_snapshots(raw, ["sku"], ["price", "twice"], "as_of", "day", {"issued": "as_of", "planned": "price"}, {"twice": "price * 2", "no": "absent + 1"}, **k)
    plans = read(duplicates="last", order=["n"])
    assert sorted((r.series_id, r.price, r.twice) for r in plans.collect()) == [("a", 2.0, 4.0), ("a", 9.0, 18.0), ("z", 3.0, 6.0)]
    with pytest.raises(Exception, match="repeat"):
        read().collect()
    with pytest.raises(ValueError):
        snapshots.plan_snapshots(raw, ["nothing"], [])
    history = spark.createDataFrame([("a", date(2024, 1, 1), 5.0, "k")], "series_id string, ts date, price double, kind string")
    (tmp_path / "new.csv").write_text("sku,launch_date,cat\nz,2024-01-05,c\ny,2024-01-20,d\na,2024-01-20,d\n")
    listed = snapshots.new_series_file(spark, str(tmp_path / "new.csv"), ["sku"], ["cat"])
    got = {r.series_id: str(r.launch) for r in snapshots.upcoming("2024-01-01", history, listed, plans).collect()}
    assert got == {"z": "2024-01-05", "y": "2024-01-20"}
    assert {r.series_id: str(r.launch) for r in snapshots.upcoming("2024-01-01", history, None, plans).collect()} == {"z": "2024-01-09"}
    o = spark.createDataFrame([(date(2024, 1, 1),)], "origin date")
    frame = future.horizon_frame(spark.createDataFrame([("a", date(2024, 1, 1))], "series_id string, first_ts date"), o, 2)
    known = future.known_covariates(frame, history, {"price": "actual", "kind": "carry_forward", "absent": "actual"}, ["2024-01-01"], plans, production=True)
    assert sorted((r.horizon, r.price, r.kind) for r in known.collect()) == [(1, 2.0, "k"), (2, None, "k")]
    with pytest.warns(UserWarning):
        report = future.plan_report(known, plans, o, ["price"])
    assert report[0]["coverage"] == {"price": 0.5} and report[0]["age"] == 0
    with pytest.raises(ValueError):
        future.known_covariates(frame, history, {"price": "plan"}, ["2024-01-01"])


def test_columns(spark):
    from pyspark.sql import functions as F

    r = spark.range(1).select(series_id(F.lit(7.0), F.lit("x|y")).alias("s")).select("s", *split_ids(F.col("s"), 2)).first()
    assert tuple(r) == ("7|x|y", "7", "x|y")
    r = spark.range(1).select(*interpolate_quantiles([0.1, 0.5, 0.9], F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)), [0.05, 0.3, 0.5, 0.95])).first()
    assert list(r) == [1.0, 1.5, 2.0, 3.0]
    df = spark.createDataFrame([(1, 5.0, None, "a|b & c~d"), (2, None, True, "x"), (None, 1.0, False, "it's")], "a int, b double, c boolean, `my col` string")
    rows = lambda text: [r.k for r in df.selectExpr("coalesce(a, 0) k", "*").where(translate_expression(text)).collect()]
    assert rows("`my col` == 'a|b & c~d'") == [1] and rows('`my col` == "it\'s"') == [0] and rows("a != 1") == [2, 0] and rows("a == 1 & b.clip(0, 2) > 1 | ~c") == [1, 0]
    assert rows("a in [1, 2] and b.fillna(9) > 6") == [2] and rows("b / 0 > 1") == [] and rows("a IS NULL") == [0] and rows("a not in [1]") == [2, 0]
    assert inputs_of("a + f(b) > `my col`") == {"a", "b", "my col"}
    with pytest.raises(ValueError):
        translate_expression("[x for x in a]")


def test_sources_and_sink(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(str(tmp_path / "p.parquet"))
    (tmp_path / "q.csv").write_text("a,c\n2,z\n")
    got = read_table(spark, [str(tmp_path / "p.parquet"), str(tmp_path / "q.csv")])
    assert sorted(got.columns) == ["a", "b", "c"] and got.count() == 2
    spark.createDataFrame([(3, 2.5)], "a int, c double").write.parquet(str(tmp_path / "r.parquet"))
    (tmp_path / "s.csv").write_text("c,a\n7,8\n")
    both = read_table(spark, [str(tmp_path / x) for x in ("p.parquet", "r.parquet", "q.csv", "s.csv")])
    assert sorted((r.a, r.c) for r in both.collect() if r.a > 2) == [(3, "2.5"), (8, "7")]
    assert [r.a for r in read_table(spark, [str(tmp_path / "q.csv"), str(tmp_path / "s.csv")]).where("c = '7'").collect()] == [8]
    with pytest.raises(FileNotFoundError):
        expand(spark, str(tmp_path / "none*.csv"))
    many = spark.range(100).selectExpr("cast(id as string) series_id")
    assert sum(only_shard(many, k, 7).count() for k in range(7)) == 100 and only_series(many, many.where("series_id < 5")).count() == many.where("series_id < 5").count()
    with pytest.raises(ValueError):
        read_table(spark, [str(tmp_path / "p.parquet"), str(tmp_path / "q.csv")], mixed=False)
    write_forecast(spark.createDataFrame([("a", 1.0), ("b", 2.0)], "series_id string, y_pred double"), str(tmp_path / "out"), 3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_short_history_is_scaled_towards_its_own_level(spark):
    profiles = spark.createDataFrame([(date(2024, 1, 1), 2, "*", "*", a, 2.0) for a in range(10)], "origin date, level int, key1 string, key2 string, age int, mean double")
    short = spark.createDataFrame([(date(2024, 1, 1), "a", "x", "y", 4, 22.0), (date(2024, 1, 1), "b", "x", "y", 2, 0.0)], "origin date, series_id string, key1 string, key2 string, hist_age int, hist_sum double")
    short = short.selectExpr("*", "date_sub(origin, hist_age - 1) launch")
    got = {(r.series_id, r.horizon): r.y_pred for r in coldstart.cold_forecast(short, profiles, ("key1", "key2"), 3).collect()}
    assert len(got) == 6 and got["a", 1] == pytest.approx(2 * (22 + 14) / (8 + 14)) and got["b", 3] == pytest.approx(2 * 14 / (4 + 14))
    assert coldstart.cold_forecast(short.limit(0), profiles, ("key1", "key2"), 3).count() == 0


def test_verdicts_and_ledger(tmp_path):
    run = lambda x, folds, sig="s", **more: {"overall": {"wape": x, "n": 90, "n_missing": 1}, "folds": folds, "signature": sig} | more
    ref = run(0.5, {"0": 0.5, "1": 0.5, "2": 0.5})
    assert ledger.verdict(ref, None) == ("reference", None)
    assert ledger.verdict(run(0.4, {"0": 0.4, "1": 0.4, "2": 0.6}), ref)[0] == "improved"
    assert ledger.verdict(run(0.4, {"0": 0.2, "1": 0.6, "2": 0.6}), ref)[0] == "inconclusive"
    assert ledger.verdict(run(0.6, {"0": 0.6, "1": 0.7, "2": None}), ref)[0] == "regressed"
    assert ledger.verdict(run(0.499, {"0": 0.4}), ref)[0] == "inconclusive"
    assert ledger.verdict(run(0.4, {}, "t"), ref) == ("incomparable", None)
    assert ledger.verdict(run(0.4, {"0": 0.1}, inputs_changed=True), ref) == ("inconclusive", None)
    assert ledger.verdict(run(math.nan, {"0": 0.1}), ref) == ("inconclusive", None)
    one, two = ledger.reserve(tmp_path / "l", "one"), ledger.reserve(tmp_path / "l", "two")
    assert (one.name, two.name) == ("0001_one", "0002_two")
    ledger.record(one, {"model": "naive"}, ref)
    with pytest.raises(FileExistsError):
        ledger.record(one, {}, ref)
    ledger.release(two)
    assert ledger.leaderboard(tmp_path / "l") == [("0001_one", 0.5)]
    assert ledger.reserve(tmp_path / "l", "three").name == "0002_three"
    before = ledger.fingerprint(one)
    (one / "more").write_text("x")
    assert ledger.fingerprint(one) != before
    assert ledger.signature({"name": "a", "h": 1}, {}, []) == ledger.signature({"name": "b", "h": 1}, {}, []) != ledger.signature({"h": 2}, {}, [])
