"""The audit of a panel as text: every section is one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.operators.panel import audit, demand_classes
from tidepanel.project.settings import Project


def covariate_rows(panel: DataFrame, project: Project) -> list[tuple[str, str, str, float | None, str]]:
    """Column, role, type, share of missing values, policy."""
    kinds = dict(panel.dtypes)
    cols = [c for c in (*project.known_covariate_cols, *project.past_covariate_cols) if c in kinds]
    missing = lambda c: F.avg((F.col(c).isNull() | (F.col(c).cast("string") == "")).cast("int")).alias(c)
    shares = panel.agg(*map(missing, cols)).first() if cols else {}
    kind = lambda c: "categorical" if kinds.get(c) == "string" else "numeric"
    out = [(c, "known", kind(c), shares[c], project.covariate_eval_policy.get(c, "")) for c in project.known_covariate_cols if c in kinds]
    out += [(c, "past", kind(c), shares[c], "not in the horizon") for c in project.past_covariate_cols if c in kinds]
    return out + [(c, "static", "categorical", None, "groups and slices") for c in project.static_cols]


def _table(head: tuple[str, ...], rows: list[tuple]) -> list[str]:
    line = lambda r: "| " + " | ".join(map(str, r)) + " |"
    return [line(head), "|" + "-|" * len(head), *map(line, rows)]


def audit_text(panel: DataFrame, n_raw: int, project: Project, labels: DataFrame | None = None) -> str:
    """Sizes, demand, covariates, demand classes and fold cutoffs."""
    r = audit(panel).first()
    span = panel.agg(F.min("ts"), F.max("ts")).first()
    short = panel.groupBy("series_id").count().where(F.col("count") < project.min_train_periods).count()
    classes = demand_classes(panel, labels=labels).groupBy("demand_class").count().orderBy(F.desc("count"), "demand_class").collect()  # a row per class
    masked = "by stockout_expr" if project.stockout_expr else "by in_stock_col" if project.in_stock_col else "none declared"
    lines = [
        f"# Audit of {project.name}", "",
        f"- rows: {n_raw:,} raw, {r['n_rows']:,} on the daily grid ({1 - n_raw / max(r['n_rows'], 1):.1%} filled in)",
        f"- series: {r['n_series']:,}, from {span[0]} to {span[1]}",
        f"- days of history: {r['min_days']} at least, {int(r['median_days'])} in the middle, {r['max_days']} at most; {short:,} series have fewer than {project.min_train_periods}",
        f"- demand: {r['zero_share']:.1%} zero, {r['negatives'] or 0:,} negative, {r['missing_share']:.2%} missing",
        f"- stockout days: {r['stockout_share']:.2%} ({masked})",
        "", "## Covariates", "", *_table(("column", "role", "type", "missing", "policy"), [(c, role, kind, "" if share is None else f"{share:.1%}", policy) for c, role, kind, share, policy in covariate_rows(panel, project)]),
        "", "## Demand classes", "", *_table(("class", "series", "share"), [(x["demand_class"], f"{x['count']:,}", f"{x['count'] / r['n_series']:.1%}") for x in classes]),
        "", "## Cutoffs", "",
    ]
    rule = project.folds()
    try:
        lines += ["- validation: " + ", ".join(map(str, rule.validation(*span))), "- holdout: " + (", ".join(map(str, rule.holdout(*span))) or "none")]
    except ValueError as e:
        lines.append(f"- {e}")
    return "\n".join(lines) + "\n"
