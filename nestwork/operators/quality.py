"""Data-quality rules (Q1-Q3, Q5, Q6).

Rules are SQL boolean expressions.  A row fails a rule when the expression
is false or NULL.  Counting is one pass with ``count_if`` per rule (partial
aggregation, one tiny shuffle); ``observe_rules`` attaches the same counts to a
stream or a write as observed metrics without a second pass.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def passes(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))


def all_pass(rules: Mapping[str, str]) -> Column:
    out = F.lit(True)
    for r in rules.values():
        out = out & passes(r)
    return out


def rule_counts(df: DataFrame, specs) -> DataFrame:
    """Failure counts for several tables' rules in ONE aggregation pass.

    ``specs`` is a list of ``(table_name, scope_sql_or_None, {rule: sql})``.
    Returns one row per (table_name, rule): n_rows in scope and n_failed.
    """
    aggs, rows = _rule_aggregates(specs), []
    for t, (label, _, rules) in enumerate(specs):
        rows += [f"'{label}', '{name}', n{t}, f{t}_{i}" for i, name in enumerate(rules)]
    one = df.agg(*aggs)
    return one.select(F.expr(f"stack({len(rows)}, {', '.join(rows)}) AS (table_name, rule, n_rows, n_failed)"))


def _rule_aggregates(specs) -> list[Column]:
    """n<t> rows in the scope of table t, f<t>_<i> of them fail its rule i."""
    aggs = []
    for t, (_, scope, rules) in enumerate(specs):
        in_scope = F.coalesce(F.expr(scope), F.lit(False)) if scope else F.lit(True)
        aggs.append(F.count_if(in_scope).alias(f"n{t}"))
        aggs += [F.count_if(in_scope & ~passes(rule)).alias(f"f{t}_{i}") for i, rule in enumerate(rules.values())]
    return aggs


def observe_specs(df: DataFrame, name: str, specs) -> DataFrame:
    """The counts of ``rule_counts`` as observed metrics of each micro-batch (or write)."""
    return df.observe(name, *_rule_aggregates(specs))


def observed_counts(metrics: DataFrame, specs) -> DataFrame:
    """Observed metrics (batch_id, metric, value) as rows: batch_id, table_name, rule, n_rows, n_failed."""
    wanted = [(label, rule, f"n{t}", f"f{t}_{i}") for t, (label, _, rules) in enumerate(specs) for i, rule in enumerate(rules)]
    wide = metrics.groupBy("batch_id").pivot("metric", sorted({m for w in wanted for m in w[2:]})).agg(F.max("value"))
    rows = ", ".join(f"'{label}', '{rule}', {n}, {f}" for label, rule, n, f in wanted)
    return wide.select("batch_id", F.expr(f"stack({len(wanted)}, {rows}) AS (table_name, rule, n_rows, n_failed)")).where("n_rows IS NOT NULL")


def observe_rules(df: DataFrame, name: str, rules: Mapping[str, str]) -> DataFrame:
    """Attach per-rule failure counts as observed metrics (works on streams)."""
    metrics = [F.count(F.lit(1)).alias("n_rows")]
    metrics += [F.count_if(~passes(r)).alias(f"failed_{k}") for k, r in rules.items()]
    return df.observe(name, *metrics)


def expect_or_drop(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Split into (kept, quarantined); quarantined rows carry the failed rule names."""
    failed = F.filter(
        F.array(*[F.when(~passes(r), F.lit(k)) for k, r in rules.items()]),
        lambda x: x.isNotNull(),
    )
    tagged = df.withColumn("_failed_rules", failed)
    kept = tagged.where(F.size("_failed_rules") == 0).drop("_failed_rules")
    bad = tagged.where(F.size("_failed_rules") > 0)
    return kept, bad


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Q3: fill NULLs with declared defaults (``coalesce``)."""
    for c, d in defaults.items():
        df = df.withColumn(c, F.coalesce(F.col(c), d)) if c in df.columns else df.withColumn(c, d)
    return df


def non_empty(*cols: str) -> Column:
    """Q5: every parameter present and not blank."""
    out = F.lit(True)
    for c in cols:
        out = out & F.coalesce(F.length(F.trim(F.col(c))) > 0, F.lit(False))
    return out
