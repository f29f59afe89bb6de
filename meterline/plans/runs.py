"""Run-date operations: the source check (D8) and the month backfill (I8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline.operators.incremental import _exists, month_of_run
from meterline.plans.models import PipelineConfig, Tables, run_pipeline
from meterline.sources.files import land_columns, month_paths, read_months


def month_available(spark: SparkSession, landing_dir: str, ds: str) -> bool:
    """D8 re-aimed: is the monthly file covering run date ``ds`` in the landing
    folder? (A listing check, instead of an HTTP HEAD on a remote file.)"""
    return _exists(spark, month_paths(landing_dir, [month_of_run(ds)])[0])


def backfill(spark: SparkSession, landing_dir: str, ds: str, seed: DataFrame,
             tables: Tables, cfg: PipelineConfig, loaded_at: str,
             layers=("staging", "intermediate", "marts")) -> None:
    """I8: (re)load the month file of run date ``ds`` and run the models on it.

    Idempotent: the models delete+insert by key, so rerunning a date changes
    nothing. Raises if the month's file is missing (the run's source gate).
    """
    if not month_available(spark, landing_dir, ds):
        raise FileNotFoundError(f"no source file for {month_of_run(ds)} in {landing_dir}")
    raw = land_columns(read_months(spark, landing_dir, [month_of_run(ds)]), loaded_at)
    run_pipeline(spark, raw, seed, tables, cfg, layers)
