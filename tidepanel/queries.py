"""Registered queries of the demand-panel operators, with the same questions in SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.functions.columns import interpolate_quantiles, split_ids
from tidepanel.operators import coldstart, forecast, models, panel, sampling, score, training
from tidepanel.operators.prepare import PanelSpec, deduplicate, prepare, repeated_keys, sales
from tidepanel.plans import folds, future
from tidepanel.plans.backtest import Task, backtest
from tidepanel.sources.store import keep

H, M = 14, 7
FIRST, LAST = date(1995, 1, 2), date(2001, 11, 4)
CUTS = folds.cutoffs(FIRST, LAST, H, folds=2, step=14, holdouts=1, min_train=60)
ORIGINS = folds.origins(CUTS["validation"], H, CUTS["holdout"][0], step=7)
CUT = str(CUTS["validation"][-1])
DAYS = [o for _, _, o in ORIGINS]
COLD = "1995-04-30"

_ROLES = {
    "timestamp": "l_shipdate", "target": "l_quantity", "known": {"price": "ffill", "l_discount": "zero"}, "past": {"l_tax": "nan"},
    "derived": {"price": "try_divide(l_extendedprice, l_quantity)"}, "stockout_expr": "l_returnflag == 'R' & l_tax >= 0.07", "order": ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax"),
}
SUPPLIER = PanelSpec(ids=("l_suppkey",), **_ROLES)
PART = PanelSpec(ids=("l_partkey",), **_ROLES)


def _t(s: SparkSession, d: str, name: str) -> DataFrame:
    return s.read.parquet(f"{d}/{name}.parquet")


def _sales(s: SparkSession, d: str, spec: PanelSpec = SUPPLIER) -> DataFrame:
    return sales(_t(s, d, "lineitem"), spec)


def _grid(s: SparkSession, d: str, spec: PanelSpec = SUPPLIER) -> DataFrame:
    return panel.daily_grid(_sales(s, d, spec), spec)


def _origins(s: SparkSession) -> DataFrame:
    return s.createDataFrame(ORIGINS, "fold int, cutoff date, origin date")


def _statics(s: SparkSession, d: str) -> DataFrame:
    n, r = _t(s, d, "nation"), _t(s, d, "region")
    rows = _t(s, d, "supplier").join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))  # at most 25 and 5 rows
    return rows.select(F.col("s_suppkey").cast("string").alias("series_id"), F.col("r_name").alias("category"), F.col("n_name").alias("brand"))


def _parts(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "part").select(F.col("p_partkey").cast("string").alias("series_id"), "p_brand", "p_type")


def _r(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


TASK = Task(horizon=H, season=M, buckets=(7, 14), min_history=0, method="none")


def _panel(s: SparkSession, d: str, spec: PanelSpec = SUPPLIER) -> DataFrame:
    """The grid, built once and written for the passes that read it."""
    return keep(_grid(s, d, spec).select("series_id", "ts", "y", "stockout"), "panel")


def _predictions(s: SparkSession, d: str, grid: DataFrame | None = None) -> DataFrame:
    grid = _panel(s, d) if grid is None else grid
    out = backtest(grid, ORIGINS, TASK, models.create("seasonal_naive", H, M))
    return out.where("lifecycle = 'established'").select("fold", "cutoff", "origin", "series_id", "ts", "horizon", "y_pred", "y_true", "stockout", "mase_scale", "bucket", "model_age_days")


def _scores(s: SparkSession, d: str, keys: list[str], extra=None) -> DataFrame:
    grid = _panel(s, d)
    p = _predictions(s, d, grid)
    if extra is not None:
        p = p.join(extra(grid), "series_id")
    return score.score(p, keys)


def _plans(s: SparkSession, d: str) -> DataFrame:
    rows = _t(s, d, "orders").join(_t(s, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    rows = rows.select(F.last_day(F.to_date("o_orderdate")).alias("as_of"), F.col("l_suppkey").cast("string").alias("series_id"), F.to_date("l_shipdate").alias("ts"), "l_discount")
    return rows.where((F.col("ts") > F.col("as_of")) & (F.col("ts") <= F.date_add("as_of", 60))).groupBy("as_of", "series_id", "ts").agg(F.max("l_discount").alias("plan_discount"))


def _frame(s: SparkSession, d: str) -> DataFrame:
    return future.horizon_frame(panel.first_dates(_sales(s, d)), _origins(s).select("origin"), H)


KEYS = ("p_brand", "p_type")


def _cold(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = _sales(s, d, PART)
    firsts = panel.first_dates(rows)
    return firsts, coldstart.launch_profiles(rows, firsts, _parts(s, d), [COLD], KEYS, 60, 5)


def _cold_start(s: SparkSession, d: str) -> DataFrame:
    firsts, profiles = _cold(s, d)
    late = firsts.where(F.col("first_ts") > F.lit(COLD).cast("date")).join(_parts(s, d), "series_id")
    targets = late.select(F.lit(COLD).cast("date").alias("origin"), "series_id", *KEYS, F.explode(F.sequence(F.lit(0), F.lit(9))).alias("age"))
    return _r(coldstart.lookup(targets, keep(profiles, "profiles"), KEYS), "mean").select("series_id", "age", F.col("mean").alias("y_pred"))


def _cold_short(s: SparkSession, d: str) -> DataFrame:
    rows, parts = keep(_sales(s, d, PART).select("series_id", "ts", "y", "stockout"), "sales"), _parts(s, d)
    short = panel.history_split(rows, COLD, 28, H).where("lifecycle = 'short_history'")
    profiles = keep(coldstart.launch_profiles(rows, panel.first_dates(rows), parts, [COLD], KEYS, 28 + H, 5, min_history=28), "profiles")
    o = F.lit(COLD).cast("date").alias("origin")
    cold = keep(short.join(parts, "series_id").select(o, "series_id", F.col("first_ts").alias("launch"), "hist_age", "hist_sum", *KEYS), "short")
    out = coldstart.cold_forecast(cold, profiles, KEYS, H).join(coldstart.scales(cold, profiles, KEYS), ["origin", "series_id"])
    return _r(out.select("series_id", "horizon", "scale", "y_pred"), "scale", "y_pred")


def _sampled(s: SparkSession, d: str) -> DataFrame:
    classes = panel.demand_classes(_grid(s, d, PART)).select("series_id", "demand_class")
    sizes = {r[0]: r[1] for r in classes.groupBy("demand_class").count().collect()}  # a row per class
    quotas = dict.fromkeys(sizes, 20)
    return sampling.draw(classes, "demand_class", quotas, 7).select("series_id", "demand_class")


def _strata(s: SparkSession, d: str) -> DataFrame:
    """Label x volume bin, allocated, drawn and weighted."""
    rows = _sales(s, d, PART).join(_parts(s, d), "series_id")
    stats = sampling.series_stats(rows, until=COLD, label="p_brand")
    return _r(sampling.stratified_sample(keep(stats, "stats"), 500, 4, 3, 11).select("series_id", "stratum", "weight"), "weight")


def _profile(s: SparkSession, d: str) -> DataFrame:
    return training.series_profile(_panel(s, d, PART), CUT, 365)


MIX = {"max_share": {"intermittent": 0.3}, "min_nonzero_days": 2, "seed": 3}


def _selected(s: SparkSession, d: str) -> DataFrame:
    return training.select_series(keep(_profile(s, d), "profile"), H, MIX)[0]


def _lifecycles(s: SparkSession, d: str) -> DataFrame:
    """A backtest of sparse series with cold starts and owed rows."""
    grid = _panel(s, d, PART)
    task = Task(horizon=10, season=M, buckets=(10,), min_history=20, method="zero")
    out = backtest(grid, [(0, date(1995, 3, 1), date(1995, 3, 1)), (0, date(1995, 3, 1), date(1995, 3, 15))], task, models.create("naive", 10, M))
    return out.groupBy("origin", "lifecycle").agg(F.count_distinct("series_id").alias("n_series"), F.count(F.lit(1)).alias("n_rows"), F.count("y_pred").alias("n_pred"), F.round(F.sum("y_pred"), 6).alias("pred"), F.round(F.sum("y_true"), 6).alias("true"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    o = lambda s: _origins(s).select("origin")
    y = lambda df: df.select("series_id", "ts", F.round("y", 6).alias("y"))
    raw = lambda s, d, spec=SUPPLIER: prepare(_t(s, d, "lineitem"), spec)
    variant = lambda **k: PanelSpec(ids=("l_suppkey",), **(_ROLES | k))
    return {
        "prepare_raw": lambda s, d: raw(s, d).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"), F.sum(F.col("stockout").cast("bigint")).alias("n_out")),
        "filter_window": lambda s, d: raw(s, d, variant(row_filter="l_linestatus == 'O'", start="1996-01-01", end="1997-12-31")).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi")),
        "negative_clip": lambda s, d: raw(s, d, variant(target="net", derived=_ROLES["derived"] | {"net": "l_quantity - 25"}, negative="clip")).groupBy("series_id").agg(F.sum("y").alias("y")),
        "dedupe_sum": lambda s, d: _r(_sales(s, d), "y", "price", "l_discount", "l_tax"),
        "dedupe_mean": lambda s, d: y(_sales(s, d, variant(duplicates="mean"))),
        "dedupe_max": lambda s, d: y(_sales(s, d, variant(duplicates="max"))),
        "dedupe_last": lambda s, d: y(_sales(s, d, variant(duplicates="last"))),
        "duplicate_keys": lambda s, d: repeated_keys(raw(s, d)),
        "daily_grid_global": lambda s, d: _r(_grid(s, d), "y", "price", "l_discount", "l_tax"),
        "daily_grid_series": lambda s, d: y(_grid(s, d, variant(grid_end="series"))),
        "static_join": lambda s, d: panel.add_statics(_sales(s, d).select("series_id", "ts", "y"), _statics(s, d)),
        "date_span": lambda s, d: panel.date_span(_sales(s, d)),
        "first_dates": lambda s, d: panel.first_dates(_sales(s, d)),
        "demand_class_sb": lambda s, d: panel.demand_classes(_grid(s, d)),
        "history_split": lambda s, d: panel.history_split(_sales(s, d, PART), COLD, 28, 30),
        "mase_scale": lambda s, d: _r(panel.mase_scale(_grid(s, d), CUT, M), "mase_scale"),
        "audit_summary": lambda s, d: panel.audit(_grid(s, d)),
        "naive": lambda s, d: forecast.naive(forecast.origin_states(_grid(s, d), DAYS, M), H).select("series_id", "origin", "horizon", "ts", "y_pred"),
        "seasonal_naive": lambda s, d: _r(forecast.seasonal_naive(forecast.origin_states(_grid(s, d), DAYS, M), H, M), "y_pred").select("series_id", "origin", "horizon", "ts", "y_pred"),
        "croston_sba": lambda s, d: _r(forecast.croston(_grid(s, d), CUT), "rate"),
        "future_actual": lambda s, d: _r(future.with_actuals(_frame(s, d), _grid(s, d), ["price"]), "price").select("series_id", "origin", "horizon", "ts", "price"),
        "future_carry_forward": lambda s, d: _r(future.with_carried(_frame(s, d), _sales(s, d), DAYS, ["price"]), "price").select("series_id", "origin", "horizon", "ts", "price"),
        "future_plan": lambda s, d: future.with_plans(_frame(s, d), _plans(s, d), o(s), ["plan_discount"]).select("series_id", "origin", "horizon", "ts", "plan_discount"),
        "plan_asof": lambda s, d: future.snapshot_as_of(_plans(s, d), o(s)),
        "plan_coverage": lambda s, d: future.coverage(future.with_plans(_frame(s, d), _plans(s, d), o(s), ["plan_discount"]), "plan_discount"),
        "launch_profile_rollup": lambda s, d: _profile_rows(_cold(s, d)[1]),
        "cold_start_new": _cold_start,
        "cold_start_short": _cold_short,
        "backtest_predictions": lambda s, d: _r(_predictions(s, d), "y_pred", "mase_scale"),
        "score_overall": lambda s, d: _scores(s, d, []),
        "score_by_fold": lambda s, d: _scores(s, d, ["fold"]),
        "score_by_bucket": lambda s, d: _scores(s, d, ["bucket"]),
        "score_bucket_x_fold": lambda s, d: _scores(s, d, ["bucket", "fold"]),
        "score_model_age": lambda s, d: _scores(s, d, ["model_age_days"]),
        "score_by_class": lambda s, d: _scores(s, d, ["demand_class"], lambda grid: panel.demand_classes(grid, str(CUTS["validation"][0])).select("series_id", "demand_class")),
        "score_slice": lambda s, d: _scores(s, d, ["category"], lambda _: _statics(s, d).select("series_id", "category")),
        "score_tables": lambda s, d: score.finalize(score.partial(_predictions(s, d), {"overall": [], "fold": ["fold"], "bucket": ["bucket"], "bucket_x_fold": ["bucket", "fold"]}), ["table", "bucket", "fold"]),
        "partials_combine": lambda s, d: score.finalize(score.combine(score.partial(_predictions(s, d), {"t": ["fold", "bucket"]}), ["bucket"]), ["bucket"]),
        "quantile_metrics": lambda s, d: score.score(_predictions(s, d).withColumns({"q10": F.col("y_pred") * 0.5, "q90": F.col("y_pred") * 1.5}), ["bucket"], {"q10": 0.1, "q90": 0.9}).select("bucket", "wql", "cov_0_1", "cov_0_9"),
        "quantile_interp": lambda s, d: _t(s, d, "orders").select("o_orderkey", *[F.round(c, 6).alias(n) for c, n in zip(interpolate_quantiles([0.1, 0.5, 0.9], F.array(F.col("o_totalprice") * 0.5, F.col("o_totalprice"), F.col("o_totalprice") * 2), [0.05, 0.3, 0.95]), ("a", "b", "c"), strict=True)]),
        "series_stats": lambda s, d: _r(sampling.series_stats(_sales(s, d, PART), str(LAST)), "per_day"),
        "volume_bins": lambda s, d: sampling.volume_bins(sampling.series_stats(_sales(s, d, PART), str(LAST)), 4).select("series_id", "bin"),
        "stratified_sample": _sampled,
        "strata_sample": _strata,
        "train_profile": _profile,
        "train_select": _selected,
        "backtest_lifecycles": _lifecycles,
        "fold_origins": lambda s, d: s.createDataFrame(folds.origins(folds.FoldRule(H, folds=3, step=10, holdouts=1, min_train=60).validation(FIRST, LAST), H, folds.FoldRule(H, folds=3, step=10, holdouts=1).limit(FIRST, LAST), 5), "fold int, cutoff date, origin date"),
        "stockout_col": lambda s, d: raw(s, d, PanelSpec(ids=("l_suppkey",), **(_ROLES | {"stockout_expr": None, "in_stock_col": "flag", "derived": {**_ROLES["derived"], "flag": "0 if l_returnflag == 'R' else 1"}}))).groupBy("series_id").agg(F.sum(F.col("stockout").cast("bigint")).alias("n_out")),
        "dedupe_first": lambda s, d: y(_sales(s, d, variant(duplicates="first"))),
        "static_first_row": lambda s, d: panel.static_first_row(prepare(_t(s, d, "lineitem"), variant(extra=("l_returnflag", "l_linestatus"))), ["l_returnflag", "l_linestatus"]),
        "literals_in_filter": lambda s, d: raw(s, d, variant(row_filter="l_returnflag != 'A|R & ~N' & l_linestatus.isin(['O', 'x|y']) & ~(l_quantity.clip(5, 40) / 0 > 1)")).groupBy("series_id").agg(F.count(F.lit(1)).alias("n")),
        "split_ids": lambda s, d: raw(s, d, PanelSpec(ids=("l_suppkey", "l_returnflag"), **_ROLES)).groupBy("series_id").agg(F.count(F.lit(1)).alias("n")).select(*[c.alias(n) for c, n in zip(split_ids(F.col("series_id"), 2), ("supp", "flag"), strict=True)], "n"),
        "daily_rollup": lambda s, d: _r(_rollup(s, d), "y"),
    }


def _profile_rows(p: DataFrame) -> DataFrame:
    names = {"q_0.1": "q10", "q_0.5": "q50", "q_0.9": "q90"}
    return _r(p.withColumnsRenamed({**names, "p_brand": "key1", "p_type": "key2"}).drop("origin"), "mean", *names.values())


def _rollup(s: SparkSession, d: str) -> DataFrame:
    from tidepanel.streaming.daily import daily_rollup

    return daily_rollup(_t(s, d, "events"), "ts", "user_id", "value")


# --- the same in SQL -------------------------------------------------------------------------

_VALUES = ", ".join(f"({f}, date '{c}', date '{x}')" for f, c, x in ORIGINS)
_ORD = "(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax)"


def _ctes(key: str = "l_suppkey", grid_end: str = "global") -> str:
    hi = "(select max(ts) from sales)" if grid_end == "global" else "max(ts)"
    return f"""
raw as (select cast({key} as varchar) series_id, cast(l_shipdate as date) ts, l_quantity y, coalesce(l_returnflag = 'R' and l_tax >= 0.07, false) stockout,
  l_extendedprice / nullif(l_quantity, 0) price, l_discount, l_tax, row{_ORD} ord from lineitem),
sales as (select series_id, ts, sum(y) y, bool_or(stockout) stockout, arg_max(price, ord) filter (price is not null) price,
  arg_max(l_discount, ord) filter (l_discount is not null) l_discount, arg_max(l_tax, ord) filter (l_tax is not null) l_tax from raw group by 1, 2),
days as (select series_id, unnest(generate_series(min(ts), {hi}, interval 1 day))::date ts from sales group by 1),
grid as (select d.series_id, d.ts, case when s.series_id is null then 0 else s.y end y, coalesce(s.stockout, false) stockout,
  last_value(s.price ignore nulls) over (partition by d.series_id order by d.ts rows unbounded preceding) price,
  case when s.series_id is null then 0 else s.l_discount end l_discount, s.l_tax,
  case when not coalesce(s.stockout, false) then (case when s.series_id is null then 0 else s.y end) end v
  from days d left join sales s on d.series_id = s.series_id and d.ts = s.ts),
origins(fold, cutoff, origin) as (values {_VALUES}),
hist as (select series_id, min(ts) first_ts from sales group by 1),
frame as (select series_id, origin, h::int horizon, (origin + h::int)::date ts from hist, origins, range(1, {H + 1}) x(h) where first_ts <= origin),
held as (select g.series_id, o.origin, arg_max(v, ts) filter (v is not null) last_v, avg(v) mean_v from grid g join origins o on g.ts <= o.origin group by 1, 2),
pred as (select f.*, o.fold, o.cutoff, coalesce(g.v, held.mean_v, 0) y_pred from frame f join origins o using (origin) join held using (series_id, origin)
  left join grid g on g.series_id = f.series_id and g.ts = f.origin + ((f.horizon - 1) % {M} - {M - 1})::int),
diffs as (select series_id, ts, abs(v - lag(v, {M}) over (partition by series_id order by ts)) d from grid),
scale as (select series_id, fold, avg(d) mase_scale from diffs join (select distinct fold, cutoff from origins) on ts <= cutoff group by 1, 2),
bt as (select p.fold, p.cutoff, p.origin, p.series_id, p.ts, p.horizon, p.y_pred, g.y y_true, g.stockout, mase_scale,
  case when p.horizon <= 7 then 'h01-7' else 'h08-14' end as bucket, (p.origin - p.cutoff)::int model_age_days
  from pred p left join grid g using (series_id, ts) left join scale using (series_id, fold)),
classes as (select series_id, count(*) filter (not stockout) n, count(v) filter (v > 0) n_nz, count(*) filter (not stockout) / nullif(count(v) filter (v > 0), 0) adi,
  pow(stddev_pop(v) filter (v > 0) / nullif(avg(v) filter (v > 0), 0), 2) cv2 from grid where true /*until*/ group by 1),
named as (select *, case when n_nz = 0 then 'no_demand' when adi < {panel.ADI_LIMIT} and cv2 < {panel.CV2_LIMIT} then 'smooth' when adi < {panel.ADI_LIMIT} then 'erratic'
  when cv2 < {panel.CV2_LIMIT} then 'intermittent' else 'lumpy' end demand_class from classes),
statics as (select cast(s_suppkey as varchar) series_id, r_name category, n_name brand from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
plans as (select last_day(cast(o_orderdate as date)) as_of, cast(l_suppkey as varchar) series_id, cast(l_shipdate as date) ts, max(l_discount) plan_discount
  from orders join lineitem on o_orderkey = l_orderkey where cast(l_shipdate as date) > last_day(cast(o_orderdate as date)) and cast(l_shipdate as date) <= last_day(cast(o_orderdate as date)) + 60 group by all),
seen as (select origin, max(as_of) as_of from origins join (select distinct as_of from plans) on as_of <= origin group by 1),
planned as (select f.*, plan_discount from frame f left join (select origin, series_id, ts, plan_discount from plans join seen using (as_of)) using (origin, series_id, ts))"""


def _with(body: str, key: str = "l_suppkey", grid_end: str = "global", until: str | None = None) -> str:
    return ("with " + _ctes(key, grid_end) + "\n" + body).replace("/*until*/", f"and ts <= date '{until}'" if until else "")


def _score_sql(keys: list[str], extra: str = "", until: str | None = None) -> str:
    k = "".join(f"{x}, " for x in keys)
    units = ", ".join(dict.fromkeys([*keys, "fold", "origin", "series_id"]))
    group = f"group by {', '.join(keys)}" if keys else ""
    ok = "where y_true is not null and not coalesce(stockout, false)"
    join = f"using ({', '.join(keys)})" if keys else "on true"
    return _with(
        f"""select {k}wape, bias, n, n_missing, mase from
        (select {k}round(sum(abs(y_pred - y_true)) / nullif(sum(y_true), 0), 6) wape, round(sum(y_pred - y_true) / nullif(sum(y_true), 0), 6) bias, count(y_pred) n, count(*) - count(y_pred) n_missing from bt {extra} {ok} {group})
        left join (select {k}round(avg(mae / s), 6) mase from (select {units}, avg(abs(y_pred - y_true)) mae, max(mase_scale) s from bt {extra} {ok} and mase_scale > 0 group by {units}) {group}) {join}""",
        until=until,
    )


_COLD = f"""firsts as (select series_id, min(ts) first_ts from sales group by 1),
parts as (select cast(p_partkey as varchar) series_id, p_brand, p_type from part),
pool as (select p_brand, p_type, (s.ts - f.first_ts)::int age, y from sales s join firsts f using (series_id) join parts using (series_id)
  where s.ts <= date '{COLD}' and not stockout and y is not null and f.first_ts > (select min(first_ts) from firsts)),
profiles as (select (grouping(p_brand) + grouping(p_type))::int "level", coalesce(p_brand, '*') key1, coalesce(p_type, '*') key2, age, avg(y) mean, count(*) n,
  quantile_cont(y, 0.1) q10, quantile_cont(y, 0.5) q50, quantile_cont(y, 0.9) q90 from pool where age < 60
  group by grouping sets ((p_brand, p_type, age), (p_brand, age), (age)) having count(*) >= 5)"""


def oracle_sql() -> dict[str, str]:
    rates = """select g.series_id, round(coalesce(r, 0), 6) rate from (select distinct series_id from win) g left join (
      select series_id, 0.95 * sum(v * w) / sum(q * w) r from (select *, pow(0.9, total - k) * case when k = 1 then 1 else 0.1 end w from (
        select series_id, v, n - coalesce(lag(n) over o, 0) q, row_number() over o k, count(*) over (partition by series_id) total from (
          select series_id, ts, v, count(v) over (partition by series_id order by ts rows unbounded preceding) n from win) where v > 0 window o as (partition by series_id order by ts))) group by 1) using (series_id)"""
    return {
        "prepare_raw": _with("select series_id, count(*) n, sum(y) y, count(*) filter (stockout) n_out from raw group by 1"),
        "filter_window": "select cast(l_suppkey as varchar) series_id, count(*) n, min(cast(l_shipdate as date)) lo, max(cast(l_shipdate as date)) hi from lineitem where l_linestatus = 'O' and cast(l_shipdate as date) between date '1996-01-01' and date '1997-12-31' group by 1",
        "negative_clip": "select cast(l_suppkey as varchar) series_id, sum(greatest(l_quantity - 25, 0)) y from lineitem group by 1",
        "dedupe_sum": _with("select series_id, ts, round(y, 6) y, stockout, round(price, 6) price, round(l_discount, 6) l_discount, round(l_tax, 6) l_tax from sales"),
        "dedupe_mean": _with("select series_id, ts, round(avg(y), 6) y from raw group by 1, 2"),
        "dedupe_max": _with("select series_id, ts, round(max(y), 6) y from raw group by 1, 2"),
        "dedupe_last": _with("select series_id, ts, round(arg_max(y, ord), 6) y from raw group by 1, 2"),
        "duplicate_keys": _with("select series_id, ts, count(*) n from raw group by 1, 2 having count(*) > 1"),
        "daily_grid_global": _with("select series_id, ts, round(y, 6) y, stockout, round(price, 6) price, round(l_discount, 6) l_discount, round(l_tax, 6) l_tax from grid"),
        "daily_grid_series": _with("select series_id, ts, round(y, 6) y from grid", grid_end="series"),
        "static_join": _with("select s.series_id, ts, y, coalesce(category, '') category, coalesce(brand, '') brand from sales s left join statics using (series_id)"),
        "date_span": _with("select min(ts) first_ts, max(ts) last_ts, count(distinct series_id) n_series from sales"),
        "first_dates": _with("select * from hist"),
        "demand_class_sb": _with("select series_id, n, n_nz, round(adi, 6) adi, round(cv2, 6) cv2, demand_class from named"),
        "history_split": _with(f"""select series_id, first_ts, greatest(age, 0)::int hist_age, hist_sum, case when age >= 28 then 'established' when age > 0 then 'short_history' when first_ts <= date '{COLD}' + 30 then 'new' else 'later' end lifecycle
          from (select series_id, min(ts) first_ts, (date '{COLD}' - min(ts)) + 1 age, coalesce(sum(case when not stockout then y else 0 end) filter (ts <= date '{COLD}'), 0)::double hist_sum from sales group by 1)""", "l_partkey"),
        "mase_scale": _with(f"select series_id, round(avg(d), 6) mase_scale from diffs where ts <= date '{CUT}' group by 1"),
        "audit_summary": _with("""select n_series, min_days, median_days, max_days, n_rows, zero_share, negatives, stockout_share, missing_share from
          (select count(*) n_series, min(c) min_days, quantile_cont(c, 0.5) median_days, max(c) max_days from (select count(*) c from grid group by series_id)),
          (select count(*) n_rows, round(avg((y = 0)::int), 6) zero_share, count(*) filter (y < 0) negatives, round(avg(stockout::int), 6) stockout_share, round(avg((y is null)::int), 6) missing_share from grid)"""),
        "naive": _with("select series_id, origin, horizon, ts, coalesce(last_v, 0)::double y_pred from frame join held using (series_id, origin)"),
        "seasonal_naive": _with("select series_id, origin, horizon, ts, round(y_pred, 6) y_pred from pred"),
        "croston_sba": _with(f", win as (select * from grid where ts <= date '{CUT}' and ts > date '{CUT}' - 365) {rates}"),
        "future_actual": _with("select f.series_id, origin, horizon, f.ts, round(price, 6) price from frame f left join grid using (series_id, ts)"),
        "future_carry_forward": _with("select f.series_id, f.origin, horizon, f.ts, round(p, 6) price from frame f left join (select series_id, origin, arg_max(price, ts) filter (price is not null) p from sales join origins on ts <= origin group by 1, 2) using (series_id, origin)"),
        "future_plan": _with("select series_id, origin, horizon, ts, plan_discount from planned"),
        "plan_asof": _with("select origin, as_of from seen"),
        "plan_coverage": _with("select origin, count(*) n, count(plan_discount) n_known from planned group by 1"),
        "launch_profile_rollup": _with(f', {_COLD} select "level", key1, key2, age, round(mean, 6) mean, n, round(q10, 6) q10, round(q50, 6) q50, round(q90, 6) q90 from profiles', "l_partkey"),
        "cold_start_new": _with(f""", {_COLD}, caps as (select "level", key1, key2, max(age) cap from profiles group by all),
          targets as (select series_id, p_brand key1, p_type key2, a::int age from firsts join parts using (series_id), range(0, 10) x(a) where first_ts > date '{COLD}')
          select t.series_id, t.age, round(coalesce(p0.mean, p1.mean, p2.mean), 6) y_pred from targets t
          left join caps c0 on c0."level" = 0 and c0.key1 = t.key1 and c0.key2 = t.key2 left join profiles p0 on p0."level" = 0 and p0.key1 = t.key1 and p0.key2 = t.key2 and p0.age = least(t.age, c0.cap) and c0.cap is not null
          left join caps c1 on c1."level" = 1 and c1.key1 = t.key1 left join profiles p1 on p1."level" = 1 and p1.key1 = t.key1 and p1.age = least(t.age, c1.cap) and c1.cap is not null
          left join caps c2 on c2."level" = 2 left join profiles p2 on p2."level" = 2 and p2.age = least(t.age, c2.cap) and c2.cap is not null""", "l_partkey"),
        "cold_start_short": _with(f""", {_COLD.replace("age < 60", f"age < {28 + H}").replace("and f.first_ts > (", f"and f.first_ts <= date '{COLD}' - 27 and f.first_ts > (")},
          caps as (select "level", key1, key2, max(age) cap from profiles group by all),
          short as (select series_id, (date '{COLD}' - min(ts)) + 1 hist_age, coalesce(sum(case when not stockout then y else 0 end) filter (ts <= date '{COLD}'), 0) hist_sum from sales group by 1 having hist_age > 0 and hist_age < 28),
          targets as (select series_id, p_brand key1, p_type key2, hist_age, hist_sum, unnest(range(0, hist_age + {H}))::int age from short join parts using (series_id)),
          looked as (select t.*, coalesce(p0.mean, p1.mean, p2.mean) y_pred from targets t
          left join caps c0 on c0."level" = 0 and c0.key1 = t.key1 and c0.key2 = t.key2 left join profiles p0 on p0."level" = 0 and p0.key1 = t.key1 and p0.key2 = t.key2 and p0.age = least(t.age, c0.cap) and c0.cap is not null
          left join caps c1 on c1."level" = 1 and c1.key1 = t.key1 left join profiles p1 on p1."level" = 1 and p1.key1 = t.key1 and p1.age = least(t.age, c1.cap) and c1.cap is not null
          left join caps c2 on c2."level" = 2 left join profiles p2 on p2."level" = 2 and p2.age = least(t.age, c2.cap) and c2.cap is not null),
          prior as (select 7 * greatest(coalesce(avg(y_pred), 0), 1e-6) prior from looked where age < hist_age),
          scales as (select series_id, least(greatest((max(hist_sum) + max(prior)) / (sum(coalesce(y_pred, 0)) + max(prior)), 0.2), 5) scale from looked, prior where age < hist_age group by 1)
          select series_id, (age - hist_age + 1)::int horizon, round(scale, 6) scale, round(y_pred * scale, 6) y_pred from looked join scales using (series_id) where age >= hist_age""", "l_partkey"),
        "backtest_predictions": _with("select fold, cutoff, origin, series_id, ts, horizon, round(y_pred, 6) y_pred, y_true, stockout, round(mase_scale, 6) mase_scale, bucket, model_age_days from bt"),
        "score_overall": _score_sql([]),
        "score_by_fold": _score_sql(["fold"]),
        "score_by_bucket": _score_sql(["bucket"]),
        "score_bucket_x_fold": _score_sql(["bucket", "fold"]),
        "score_model_age": _score_sql(["model_age_days"]),
        "score_by_class": _score_sql(["demand_class"], "join named using (series_id)", str(CUTS["validation"][0])),
        "score_slice": _score_sql(["category"], "join statics using (series_id)"),
        "partials_combine": _score_sql(["bucket"]),
        "score_tables": " union all by name ".join(f"(select '{name}' as \"table\", * from ({_score_sql(keys)}))" for name, keys in (("bucket_x_fold", ["bucket", "fold"]), ("overall", []), ("fold", ["fold"]), ("bucket", ["bucket"]))),
        "strata_sample": _with(f""", stats as (select s.series_id, p_brand label, sum(case when ts <= date '{COLD}' then y else 0 end) / greatest(date '{COLD}' - min(ts) + 1, 1) p from sales s join (select cast(p_partkey as varchar) series_id, p_brand from part) using (series_id) group by 1, 2),
          binned as (select series_id, label || '|v' || ((r > 1 + (n - 1) * 0.25)::int + (r > 1 + (n - 1) * 0.5)::int + (r > 1 + (n - 1) * 0.75)::int) stratum from
            (select series_id, label, row_number() over (order by p, series_id) r, count(*) over () n from stats)),
          sizes as (select stratum, count(*) size, least(count(*), 3) base from binned group by 1),
          shares as (select *, (size - base) * (500 - (select sum(base) from sizes)) w, (select sum(size - base) from sizes) room from sizes),
          quotas as (select stratum, size, base + w // room + (row_number() over (order by w % room desc, stratum) <= (select 500 - sum(base + w // room) from shares))::int quota from shares)
          select series_id, stratum, round(size / quota, 6) weight from
            (select b.*, size, quota, row_number() over (partition by stratum order by md5('11-' || series_id), series_id) k from binned b join quotas using (stratum)) where k <= quota""", "l_partkey"),
        "train_profile": _with(f"select series_id, demand_class, length, recent_nonzero from named join (select series_id, count(*) length, count(*) filter (v > 0 and ts > date '{CUT}' - 365) recent_nonzero from grid where ts <= date '{CUT}' group by 1) using (series_id)", "l_partkey", until=CUT),
        "train_select": _with(f""", pool as (select series_id, demand_class from named join (select series_id, count(*) length, count(*) filter (v > 0 and ts > date '{CUT}' - 365) recent from grid where ts <= date '{CUT}' group by 1) using (series_id) where length >= {2 * H} and recent >= 2),
          quota as (select least(count(*) filter (demand_class = 'intermittent'), floor(0.3 * count(*) filter (demand_class != 'intermittent') / 0.7 + 1e-9)) q from pool)
          select series_id, demand_class from (select *, row_number() over (partition by demand_class order by md5('3-' || series_id), series_id) k from pool) where demand_class != 'intermittent' or k <= (select q from quota)""", "l_partkey", until=CUT),
        "backtest_lifecycles": _with(""", owed as (select series_id, o as origin, first_ts, greatest(o - first_ts + 1, 0) age from hist, (values (date '1995-03-01'), (date '1995-03-15')) x(o) where first_ts <= o + 10),
          rows_ as (select origin, series_id, case when age >= 20 then 'established' when age > 0 then 'short_history' else 'new' end lifecycle, (origin + h::int)::date ts from owed, range(1, 11) y(h)),
          lasts as (select series_id, origin, arg_max(v, ts) filter (v is not null) last_v from grid join (select distinct origin from owed) on ts <= origin group by 1, 2)
          select r.origin, lifecycle, count(distinct r.series_id) n_series, count(*) n_rows, count(*) n_pred, round(sum(case when lifecycle = 'established' then coalesce(last_v, 0) else 0 end), 6) pred, round(sum(g.y), 6) "true"
          from rows_ r left join lasts using (series_id, origin) left join grid g on g.series_id = r.series_id and g.ts = r.ts group by 1, 2""", "l_partkey"),
        "fold_origins": f"""with cuts as (select i, (date '{LAST}' - ({H} + 10 * i)::int)::date cutoff from range({-(-H // 10)}, {-(-H // 10) + 3}) x(i)),
          folds as (select (row_number() over (order by cutoff) - 1)::int fold, cutoff, coalesce(lead(cutoff) over (order by cutoff), date '{LAST}' - {H}) until from cuts)
          select fold, cutoff, (cutoff + k::int)::date origin from folds, range(0, 200, 5) y(k) where cutoff + k::int < until and cutoff + k::int + {H} <= date '{LAST}' - {H}
          union select fold, cutoff, cutoff from folds""",
        "stockout_col": "select cast(l_suppkey as varchar) series_id, count(*) filter (l_returnflag = 'R') n_out from lineitem group by 1",
        "dedupe_first": _with("select series_id, ts, round(arg_min(y, ord), 6) y from raw group by 1, 2"),
        "static_first_row": f"select cast(l_suppkey as varchar) series_id, arg_min(l_returnflag, (cast(l_shipdate as date), {_ORD[1:-1]})) l_returnflag, arg_min(l_linestatus, (cast(l_shipdate as date), {_ORD[1:-1]})) l_linestatus from lineitem group by 1",
        "literals_in_filter": "select cast(l_suppkey as varchar) series_id, count(*) n from lineitem where l_returnflag is distinct from 'A|R & ~N' and l_linestatus in ('O', 'x|y') group by 1",
        "quantile_metrics": _with("""select bucket, round((2 * sum(greatest(0.1 * (y_true - 0.5 * y_pred), -0.9 * (y_true - 0.5 * y_pred))) + 2 * sum(greatest(0.9 * (y_true - 1.5 * y_pred), -0.1 * (y_true - 1.5 * y_pred)))) / 2 / sum(y_true), 6) wql,
          round(avg((y_true <= 0.5 * y_pred)::int), 6) cov_0_1, round(avg((y_true <= 1.5 * y_pred)::int), 6) cov_0_9 from bt where y_true is not null and not coalesce(stockout, false) group by 1"""),
        "quantile_interp": "select o_orderkey, round(o_totalprice * 0.5, 6) a, round(o_totalprice * 0.5 * 0.5 + o_totalprice * 0.5, 6) b, round(o_totalprice * 2, 6) c from orders",
        "series_stats": _with(f"select series_id, sum(y) total, count(*) n_rows, min(ts) first_ts, max(ts) last_ts, round(sum(y) / greatest(date '{LAST}' - min(ts) + 1, 1), 6) per_day from sales group by 1", "l_partkey"),
        "volume_bins": _with(f"""select series_id, ((r > 1 + (n - 1) * 0.25)::int + (r > 1 + (n - 1) * 0.5)::int + (r > 1 + (n - 1) * 0.75)::int) bin from
          (select series_id, row_number() over (order by p, series_id) r, count(*) over () n from (select series_id, sum(y) / greatest(date '{LAST}' - min(ts) + 1, 1) p from sales group by 1))""", "l_partkey"),
        "stratified_sample": _with("select series_id, demand_class from (select *, row_number() over (partition by demand_class order by md5('7-' || series_id), series_id) r from named) where r <= 20", "l_partkey"),
        "split_ids": "select cast(l_suppkey as varchar) supp, l_returnflag flag, count(*) n from lineitem group by 1, 2",
        "daily_rollup": "select cast(user_id as varchar) series_id, cast(ts as date) ts, round(sum(value), 6) y, count(*) n from events group by 1, 2",
    }
