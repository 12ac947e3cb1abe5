"""From a raw sales table to one row per series and day."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.columns import series_id
from tidepanel.functions.expressions import inputs_of, translate_expression


@dataclass(frozen=True)
class PanelSpec:
    """Roles of a raw table's columns, and the rules for its rows."""

    timestamp: str
    target: str
    ids: tuple[str, ...]
    known: dict[str, str] = field(default_factory=dict)  # covariate -> fill rule: zero, nan or ffill
    past: dict[str, str] = field(default_factory=dict)
    derived: dict[str, str] = field(default_factory=dict)
    row_filter: str | None = None
    stockout_expr: str | None = None
    in_stock_col: str | None = None
    start: str | None = None
    end: str | None = None
    negative: str = "keep"  # keep, clip, nan or error
    duplicates: str = "sum"  # sum, mean, max, first, last or error
    order: tuple[str, ...] = ()  # row order, for first, last and last non-null
    missing_target: str = "zero"
    grid_end: str = "global"  # or series
    null_dates: str = "error"  # or keep: such rows are then on no day of the grid
    extra: tuple[str, ...] = ()  # further columns to carry along: statics, labels

    @property
    def covariates(self) -> dict[str, str]:
        return {**self.known, **self.past}


def derive(raw: DataFrame, derived: dict[str, str], strict: bool = True) -> DataFrame:
    """New columns in order, a later one may use an earlier; if not strict, those whose inputs are absent are left out."""
    for name, text in derived.items():
        if strict or inputs_of(text) <= set(raw.columns):
            raw = raw.withColumn(name, F.expr(translate_expression(text)))
    return raw


def prepare(raw: DataFrame, spec: PanelSpec) -> DataFrame:
    """Derived columns, row filter, stockouts, projection, dates, window, negatives; in this order.

    A null date is an error when the row is read, before the window is applied.
    """
    raw = derive(raw, spec.derived)
    if spec.row_filter:
        raw = raw.where(translate_expression(spec.row_filter))
    if spec.stockout_expr:
        out = F.coalesce(F.expr(translate_expression(spec.stockout_expr)), F.lit(False))
    elif spec.in_stock_col:
        out = F.coalesce(F.expr(f"try_cast(`{spec.in_stock_col}` as double) = 0"), F.lit(False))
    else:
        out = F.lit(False)
    needed = [spec.timestamp, spec.target, *spec.ids, *spec.covariates, *spec.extra]
    if missing := [c for c in needed if c not in raw.columns]:
        raise ValueError(f"columns not found: {', '.join(missing)}")
    order = F.struct(*spec.order) if spec.order else F.struct(F.lit(0))
    day = F.to_date(spec.timestamp)
    ts = F.coalesce(day, F.raise_error(F.lit(f"null dates in {spec.timestamp}")).cast("date")) if spec.null_dates == "error" else day
    low = F.lit(True) if not spec.start else day >= F.lit(spec.start).cast("date")
    high = F.lit(True) if not spec.end else day <= F.lit(spec.end).cast("date")
    inside = low & high if spec.null_dates != "error" else day.isNull() | (low & high)
    rows = raw.where(inside) if spec.start or spec.end else raw
    rows = rows.select(
        series_id(*[F.col(c) for c in spec.ids]).alias("series_id"),
        ts.alias("ts"),
        F.expr(f"try_cast(`{spec.target}` as double)").alias("y"),
        out.alias("stockout"),
        *[F.col(c) for c in (*spec.covariates, *spec.extra)],
        order.alias("ord"),
    )
    return rows.withColumn("y", negative_rule(F.col("y"), spec.negative))


def coerce_covariates(rows: DataFrame, spec: PanelSpec, limit: float = 0.01, pinned: dict[str, str] | None = None) -> tuple[DataFrame, list[str]]:
    """Text covariates that are numbers but for a share of rows up to ``limit`` become numbers; one aggregate decides.

    ``pinned`` (numeric or categorical) goes before the rule. Returns the rows and the names that were coerced.
    """
    pinned = pinned or {}
    text = [n for n, kind in rows.dtypes if kind == "string" and n in spec.covariates and n not in pinned]
    chosen = [n for n, kind in pinned.items() if kind == "numeric" and n in spec.covariates]
    if text:
        parsed = lambda n: F.expr(f"try_cast(`{n}` as double)")
        facts = rows.agg(*[x for n in text for x in (F.count(parsed(n)).alias(f"{n} ok"), F.sum((F.col(n).isNotNull() & parsed(n).isNull()).cast("long")).alias(f"{n} bad"))], F.count(F.lit(1)).alias("all rows")).first()
        chosen += [n for n in text if facts[f"{n} ok"] and facts[f"{n} bad"] and facts[f"{n} bad"] <= limit * facts["all rows"]]
    return rows.withColumns({n: F.expr(f"try_cast(`{n}` as double)") for n in chosen}), chosen


def require_rows(rows: DataFrame, what: str = "the data") -> DataFrame:
    if rows.isEmpty():
        raise ValueError(f"{what}: no rows are left after the filters")
    return rows


def check_mass(sales: DataFrame, grid: DataFrame, relative: float = 1e-6, absolute: float = 1e-3) -> tuple[float, float]:
    """The grid holds the demand of the rows it was made from, or something was lost."""
    total = lambda df: float(df.agg(F.coalesce(F.sum("y"), F.lit(0.0))).first()[0])
    before, after = total(sales), total(grid)
    if abs(after - before) > absolute + relative * abs(before):
        raise ValueError(f"the grid holds a demand of {after}, the rows {before}")
    return before, after


def negative_rule(y: Column, rule: str) -> Column:
    if rule == "clip":
        return F.when(y < 0, 0.0).otherwise(y)
    if rule == "nan":
        return F.when(y >= 0, y)
    if rule == "error":
        return F.when(y < 0, F.raise_error(F.lit("negative target"))).otherwise(y)
    return y


def deduplicate(rows: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row per series and day. Targets by rule, stockout if any, covariates by last non-null."""
    y, order = F.col("y"), F.col("ord")
    if spec.duplicates in ("first", "last"):
        pick = F.min_by if spec.duplicates == "first" else F.max_by
        target = pick(y, F.when(y.isNotNull(), order))
    elif spec.duplicates == "error":
        target = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("repeated series and day"))).otherwise(F.max(y))
    else:
        target = {"sum": F.sum, "mean": F.avg, "max": F.max}[spec.duplicates](y)
    last = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in spec.covariates]
    carried = [F.min_by(F.col(c), order).alias(c) for c in spec.extra]
    return rows.groupBy("series_id", "ts").agg(target.alias("y"), F.max("stockout").alias("stockout"), *last, *carried)


def repeated_keys(rows: DataFrame) -> DataFrame:
    return rows.groupBy("series_id", "ts").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def sales(raw: DataFrame, spec: PanelSpec) -> DataFrame:
    return deduplicate(prepare(raw, spec), spec)
