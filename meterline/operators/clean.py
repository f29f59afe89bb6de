"""Cleaning rules (F1-F8) as one conjunctive predicate plus a rejects view."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.exprs import year_range


@dataclass(frozen=True)
class CleanRules:
    """Declared quality rules. NULL fails every rule (SQL WHERE semantics).

    positive:      columns that must be > 0
    duration_col:  column that must lie in [min_duration, max_duration]
    year_col/year: the pickup year that must hold (corrupt meter clocks);
                   written as a half-open range so Parquet pushdown sees it
    """
    positive: tuple[str, ...] = ("trip_distance", "fare_amount", "passenger_count")
    duration_col: str = "trip_duration_minutes"
    min_duration: float = 1
    max_duration: float = 180
    year_col: str | None = "pickup_datetime"
    year: int | None = 2023
    extra: tuple[tuple[str, Column], ...] = field(default_factory=tuple)

    def reasons(self) -> list[tuple[str, Column]]:
        out = [(f"{c}_not_positive", F.col(c) > 0) for c in self.positive]
        if self.duration_col:
            out.append((f"{self.duration_col}_out_of_range",
                        F.col(self.duration_col).between(self.min_duration, self.max_duration)))
        if self.year_col and self.year is not None:
            out.append((f"{self.year_col}_wrong_year", year_range(self.year_col, self.year)))
        out.extend(self.extra)
        return out

    def predicate(self) -> Column:
        pred = F.lit(True)
        for _, p in self.reasons():
            pred = pred & p
        return pred


def clean(df: DataFrame, rules: CleanRules) -> DataFrame:
    """Rows passing every rule."""
    return df.filter(rules.predicate())


def rejects(df: DataFrame, rules: CleanRules, reason_col: str = "reject_reasons") -> DataFrame:
    """Rows failing at least one rule, with the failed rule names in order.

    A rule whose predicate is NULL (a NULL input) counts as failed.
    """
    tags = [F.when(F.coalesce(p, F.lit(False)), F.lit(None)).otherwise(F.lit(name))
            for name, p in rules.reasons()]
    return (df.withColumn(reason_col, F.array_compact(F.array(*tags)))
              .filter(F.size(reason_col) > 0))


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """rows where every listed column is non-NULL."""
    pred = F.lit(True)
    for c in cols:
        pred = pred & F.col(c).isNotNull()
    return df.filter(pred)


def in_set(df: DataFrame, col: str, values) -> DataFrame:
    """membership filter."""
    return df.filter(F.col(col).isin(list(values)))
