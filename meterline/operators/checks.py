"""Data-quality checks.

Every check returns its failing rows as a DataFrame. ``check_counts`` turns a
list of checks into one small result table (check, column_name, failures,
status) computed in a single Spark job; ``gate`` raises when any fails.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.operators.joins import orphans


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is NULL."""
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` occurring more than once (NULLs ignored), with count."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """D3: child rows whose non-NULL key is missing from the parent."""
    return orphans(child, fk, parent, pk)


def value_within_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Rows outside [lo, hi]; NULL passes (neither comparison holds)."""
    return df.filter((F.col(col) < F.lit(lo)) | (F.col(col) > F.lit(hi)))


def expression_holds(df: DataFrame, failing: Column) -> DataFrame:
    """Rows where the failure predicate is true (e.g. total < fare)."""
    return df.filter(failing)


def freshness(df: DataFrame, col: str, now: str, warn_hours: float = 36,
              error_hours: float = 72) -> DataFrame:
    """One row (max_loaded_at, age_hours, status) against a supplied ``now``.

    status: 'error' when age > error_hours or the table is empty,
    'warn' when age > warn_hours, else 'pass'.
    """
    mx = df.agg(F.max(col).alias("max_loaded_at"))
    age_s = F.timestamp_diff("SECOND", F.col("max_loaded_at"),
                             F.lit(now).cast("timestamp_ntz")).cast("double")
    return mx.select(
        "max_loaded_at",
        (age_s / F.lit(3600.0)).alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
         .when(age_s > F.lit(error_hours * 3600.0), F.lit("error"))
         .when(age_s > F.lit(warn_hours * 3600.0), F.lit("warn"))
         .otherwise(F.lit("pass")).alias("status"))


def source_present(df: DataFrame, month_col: str, ds: str) -> DataFrame:
    """One row (month, rows, present) — does the run date's month have data?"""
    month = F.trunc(F.lit(ds).cast("date"), "month")
    return (df.filter(F.col(month_col) == month)
              .agg(F.count(F.lit(1)).alias("rows"))
              .select(month.alias("month"), "rows", (F.col("rows") > 0).alias("present")))


@dataclass(frozen=True)
class Check:
    """A check whose failing rows are ``failing`` (any DataFrame)."""
    name: str
    column: str
    failing: DataFrame


@dataclass(frozen=True)
class RowChecks:
    """Row-level checks of one table, evaluated together in ONE scan.

    ``rules`` maps (check name, column label) -> predicate that is true on a
    failing row (e.g. ``col.isNull()``); the table is read once however many
    rules it has, instead of once per check.
    """
    table: DataFrame
    rules: dict

    def counts(self) -> DataFrame:
        items = list(self.rules.items())
        agg = self.table.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(f"c{i}")
                               for i, (_, p) in enumerate(items)])
        rows = F.array(*[F.struct(F.lit(n).alias("check"), F.lit(c).alias("column_name"),
                                  F.col(f"c{i}").alias("failures"))
                         for i, ((n, c), _) in enumerate(items)])
        return agg.select(F.explode(rows).alias("r")).select("r.*")


def null_rule(col: str) -> Column:
    return F.col(col).isNull()


def range_rule(col: str, lo, hi) -> Column:
    """Failing predicate of ``value_within_range`` (NULL passes)."""
    return (F.col(col) < F.lit(lo)) | (F.col(col) > F.lit(hi))


def check_counts(checks: Sequence) -> DataFrame:
    """(check, column_name, failures, status) for all checks, one job.

    ``checks`` mixes ``Check`` (own failing-row plan), ``RowChecks`` (many
    rules, one scan of their table) and ``Counted`` (counts kept from earlier).
    """
    parts = []
    for c in checks:
        if isinstance(c, (RowChecks, Counted)):
            parts.append(c.counts())
        else:
            parts.append(c.failing.agg(F.count(F.lit(1)).alias("failures"))
                         .select(F.lit(c.name).alias("check"),
                                 F.lit(c.column).alias("column_name"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") > 0, F.lit("fail"))
                          .otherwise(F.lit("pass")))


def partition_counts(rows: DataFrame, part: str, rules: dict, unique: Sequence[str] = (),
                     keys: Sequence[str] = ()) -> DataFrame:
    """(part, check, column_name, key, failures) per value of ``part``, to be kept
    and added up (``kept_counts``): the failing rows of each rule of ``RowChecks``,
    the values of each ``unique`` (check label, column) that repeat, and the rows of
    every value of each ``keys`` column, for a relationship tested when read.

    Adding up is exact if a value of a unique column lies in one part only."""
    items = list(rules.items())
    agg = rows.groupBy(part).agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(f"c{i}")
                                   for i, (_, p) in enumerate(items)])
    none = F.lit(None).cast("string")
    found = F.array(*[F.struct(F.lit(n).alias("check"), F.lit(c).alias("column_name"), none.alias("key"),
                               F.col(f"c{i}").alias("failures")) for i, ((n, c), _) in enumerate(items)])
    out = agg.select(part, F.explode(found).alias("r")).select(part, "r.*")
    for label, col in unique:
        again = (rows.filter(F.col(col).isNotNull()).groupBy(part, col).agg(F.count(F.lit(1)).alias("n"))
                     .filter("n > 1").groupBy(part).agg(F.count(F.lit(1)).alias("failures")))
        out = out.unionByName(again.select(part, F.lit("unique").alias("check"), F.lit(label).alias("column_name"),
                                           none.alias("key"), "failures"))
    for label, col in keys:
        used = rows.filter(F.col(col).isNotNull()).groupBy(part, F.col(col).cast("string").alias("key")) \
                   .agg(F.count(F.lit(1)).alias("failures"))
        out = out.unionByName(used.select(part, F.lit("relationships").alias("check"),
                                          F.lit(label).alias("column_name"), "key", "failures"))
    return out


def kept_counts(counts: DataFrame, names: Sequence[tuple[str, str]], parents: dict) -> DataFrame:
    """(check, column_name, failures) of ``names`` from kept ``partition_counts``;
    ``parents``: column label -> (parent frame, key column) of the relationships."""
    rows = counts.filter(F.col("key").isNull())
    for label, (parent, pk) in parents.items():
        mine = counts.filter((F.col("column_name") == label) & F.col("key").isNotNull())
        known = parent.select(F.col(pk).cast("string").alias("key"))
        rows = rows.unionByName(mine.join(known, "key", "left_anti").select(*counts.columns))
    zeros = rows.sparkSession.createDataFrame([(*n, 0) for n in names],
                                              "check string, column_name string, failures bigint")
    return (rows.select("check", "column_name", "failures").unionByName(zeros)
                .groupBy("check", "column_name").agg(F.sum("failures").alias("failures")))


@dataclass(frozen=True)
class Counted:
    """Checks whose failures are counted already: (check, column_name, failures)."""
    frame: DataFrame

    def counts(self) -> DataFrame:
        return self.frame


class QualityGateError(RuntimeError):
    pass


def findings(results: DataFrame) -> DataFrame:
    """The checks a gate stops on."""
    return results.filter(F.col("status") != "pass")


def gate(results: DataFrame) -> DataFrame:
    """Raise if any check failed; the results table is one row per check."""
    failed = findings(results).collect()
    if failed:
        raise QualityGateError(
            "; ".join(f"{r['check']}({r['column_name']}): {r['failures']}" for r in failed))
    return results
