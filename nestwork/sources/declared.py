"""Declared tables whose constraints act (K2, Q3).

A column may be NOT NULL and may have a DEFAULT; a check is a SQL rule.  Each constraint has an action: ``fail`` stops
the write (and the stream's micro-batch, which is not committed), ``drop`` leaves the row out and counts it, ``keep`` only
counts it.  A NULL or missing value takes the column's default first.  All of it is one projection and one
filter over the rows, so it works in batch and in streams without an exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.quality import passes


@dataclass(frozen=True)
class DeclaredColumn:
    name: str
    type: str
    default: str | None = None  # SQL expression over the input row
    not_null: str | None = None  # fail, drop or keep


@dataclass(frozen=True)
class Check:
    name: str
    rule: str  # over the declared columns
    action: str = "keep"


@dataclass(frozen=True)
class DeclaredTable:
    """Columns and checks; ``rows`` gives the rows to write, ``counts`` the aggregates of broken constraints."""

    columns: Sequence[DeclaredColumn]
    checks: Sequence[Check] = field(default_factory=tuple)

    def _constraints(self) -> list[Check]:
        return [Check(f"{c.name}_not_null", f"`{c.name}` IS NOT NULL", c.not_null) for c in self.columns if c.not_null] + list(self.checks)

    def conform(self, df: DataFrame) -> DataFrame:
        """The declared columns, cast, with defaults for missing and NULL values."""
        out = []
        for c in self.columns:
            value = F.col(f"`{c.name}`").cast(c.type) if c.name in df.columns else F.lit(None).cast(c.type)
            if c.default is not None:
                value = F.coalesce(value, F.expr(c.default).cast(c.type))
            out.append(value.alias(c.name))
        return df.select(*out)

    def counts(self) -> list[Column]:
        """Aggregates over conformed rows: ``rows`` and ``broken_<constraint>``."""
        return [F.count(F.lit(1)).alias("rows")] + [F.count_if(~passes(c.rule)).alias(f"broken_{c.name}") for c in self._constraints()]

    def rows(self, df: DataFrame, observe: str | None = None) -> DataFrame:
        """Conformed rows without those to drop; a row that breaks a ``fail`` constraint raises an error.

        ``observe`` names the observed metrics that report ``counts``."""
        out = self.conform(df)
        if observe:
            out = out.observe(observe, *self.counts())
        failing = [c for c in self._constraints() if c.action == "fail"]
        if failing:
            broken = F.concat_ws(", ", *[F.when(~passes(c.rule), c.name) for c in failing])
            # the first declared column carries the check, so no optimizer can leave it out
            first = self.columns[0]
            guard = F.when(broken != "", F.raise_error(F.concat(F.lit("broken constraint: "), broken)).cast(first.type))
            out = out.withColumn(first.name, guard.otherwise(F.col(f"`{first.name}`")))
        for c in self._constraints():
            if c.action == "drop":
                out = out.where(passes(c.rule))
        return out
