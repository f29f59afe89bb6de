"""The trip models (M1-M7) and the layered run (M9), as DataFrame functions.

Layer order: raw -> stage_trips / stage_zones -> enrich_trips (clean +
role-playing zones) -> fact_trips (dedupe) -> dim_zones, daily_revenue,
zone_performance. Every function is lazy; ``run_pipeline`` materialises the
incremental layers and the marts as Parquet tables and gates on the checks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.functions.exprs import (exact_avg, exact_sum, grain_key, minutes_between,
                                       pct, round_half_away, surrogate_key)
from meterline.operators import checks as C
from meterline.operators.clean import CleanRules, clean
from meterline.operators.incremental import (dedupe_latest, delete_path, high_water_mark,
                                              in_partitions, new_rows, partitions_above,
                                              partitions_with, read_table, record_applied,
                                              recover, stage, unapplied, upsert, values_in)
from meterline.operators.joins import enrich
from meterline.operators.windows import lag_gap
from meterline.sources.files import rebalanced
from meterline.sources.storage import exists, read_record, write_record

# Columns hashed into trip_id, in order (fixed value of the trip model).
TRIP_KEY_COLUMNS = [
    "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID",
    "DOLocationID", "fare_amount", "total_amount", "trip_distance",
    "passenger_count",
]

ZONE_COLUMNS = {"borough": "borough", "zone_name": "zone"}


@dataclass(frozen=True)
class PipelineConfig:
    """Shared variables of the models (one place for the rule values)."""
    min_duration: float = 1
    max_duration: float = 180
    trip_year: int = 2023
    duration_mode: str = "boundary"
    high_volume_trips: int = 10_000
    # Column the intermediate layer's incremental slice watermarks on.
    int_watermark_col: str = "_loaded_at"
    # Column the fact's incremental slice watermarks on. '_loaded_at' admits
    # late months; 'pickup_datetime' is the original models' rule, which never
    # takes a month older than the newest one in.
    fact_watermark_col: str = "_loaded_at"
    keep: tuple[str, ...] = field(default_factory=tuple)

    def rules(self) -> CleanRules:
        return CleanRules(min_duration=self.min_duration, max_duration=self.max_duration,
                          year_col="pickup_datetime", year=self.trip_year)


# Parameters the driver-table fixtures use: order/ship dates are day-grained,
# so the duration window is 1..180 days in minutes, and the year is one the
# generated orders cover.
FIXTURE_CONFIG = PipelineConfig(min_duration=1440, max_duration=259200,
                                trip_year=1997, high_volume_trips=30)


def stage_trips(raw: DataFrame, mode: str = "boundary", keep=()) -> DataFrame:
    """M1: snake_case, casts, boundary-minute duration, surrogate trip_id."""
    return raw.select(
        surrogate_key(raw.schema, TRIP_KEY_COLUMNS).alias("trip_id"),
        F.col("tpep_pickup_datetime").alias("pickup_datetime"),
        F.col("tpep_dropoff_datetime").alias("dropoff_datetime"),
        F.round(F.col("passenger_count")).cast("int").alias("passenger_count"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
        F.col("PULocationID").cast("int").alias("pickup_location_id"),
        F.col("DOLocationID").cast("int").alias("dropoff_location_id"),
        F.col("payment_type").cast("int").alias("payment_type"),
        F.col("fare_amount").cast("double").alias("fare_amount"),
        F.col("tip_amount").cast("double").alias("tip_amount"),
        F.col("total_amount").cast("double").alias("total_amount"),
        minutes_between("tpep_pickup_datetime", "tpep_dropoff_datetime", mode)
        .alias("trip_duration_minutes"),
        "file_month", "source_file", "_loaded_at", *keep,
    )


def stage_zones(seed: DataFrame) -> DataFrame:
    """M2: typed, renamed zone dimension."""
    return seed.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        F.col("service_zone"),
    )


ENRICHED_COLUMNS = [
    "trip_id", "pickup_datetime", "dropoff_datetime", "trip_duration_minutes",
    "passenger_count", "trip_distance", "payment_type", "fare_amount",
    "tip_amount", "total_amount", "pickup_location_id", "pickup_borough",
    "pickup_zone", "dropoff_location_id", "dropoff_borough", "dropoff_zone",
    "file_month", "source_file", "_loaded_at",
]


def enrich_trips(stg: DataFrame, zones: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """M3 (full-load form): clean rules + pickup/dropoff zone names.

    Filters are written after the left joins as in the model; Catalyst pushes
    them below the joins, and the year rule reaches the scan as a range.
    """
    e = enrich(stg, zones, "location_id",
               {"pickup": "pickup_location_id", "dropoff": "dropoff_location_id"},
               {"borough": "borough", "zone_name": "zone"})
    return clean(e, cfg.rules()).select(*ENRICHED_COLUMNS, *cfg.keep)


def fact_trips(enriched: DataFrame) -> DataFrame:
    """M4 (full-refresh form): one row per trip_id, latest load wins."""
    return dedupe_latest(enriched, "trip_id", ["_loaded_at"])


def dim_zones(zones: DataFrame) -> DataFrame:
    """M5."""
    return zones.select("location_id", "borough", "zone_name", "service_zone")


def daily_revenue(fct: DataFrame) -> DataFrame:
    """M6: one row per pickup date."""
    g = fct.groupBy(F.col("pickup_datetime").cast("date").alias("revenue_date")).agg(
        F.count(F.lit(1)).alias("total_trips"),
        exact_sum("fare_amount").alias("_fare"),
        exact_avg("fare_amount").alias("_avg_fare"),
        exact_sum("tip_amount").alias("_tips"))
    return g.select(
        "revenue_date", "total_trips",
        round_half_away("_fare", 2).alias("total_fare"),
        round_half_away("_avg_fare", 2).alias("avg_fare"),
        round_half_away("_tips", 2).alias("total_tips"),
        round_half_away(pct("_tips", "_fare"), 2).alias("tip_rate_pct"))


def zone_performance(fct: DataFrame, dim: DataFrame,
                     high_volume_trips: int = 10_000) -> DataFrame:
    """M7: pickup zone x file month, with a within-month revenue rank.

    Aggregated by (file_month, pickup_location_id) before the dimension join:
    the dimension key is unique, so zone names are functions of the id and the
    join then touches one row per zone-month instead of one per trip.
    """
    g = fct.groupBy("file_month", "pickup_location_id").agg(
        F.count(F.lit(1)).alias("total_trips"),
        round_half_away(exact_avg("trip_distance"), 2).alias("avg_trip_distance"),
        round_half_away(exact_avg("fare_amount"), 2).alias("avg_fare"),
        round_half_away(exact_sum("total_amount"), 2).alias("total_revenue"))
    d = dim.select("location_id", "borough", "zone_name")
    j = g.join(d, g.pickup_location_id == d.location_id, "left").drop("location_id")
    w = Window.partitionBy("file_month").orderBy(F.col("total_revenue").desc_nulls_first())
    return j.select(
        grain_key(j.schema, ["pickup_location_id", "file_month"]).alias("zone_month_key"),
        "file_month", "pickup_location_id", "borough", "zone_name", "total_trips",
        "avg_trip_distance", "avg_fare", "total_revenue",
        F.rank().over(w).alias("revenue_rank"),
        (F.col("total_trips") > F.lit(high_volume_trips)).alias("is_high_volume_zone"))


# ------------------------------------------------------------------ layered run

# Storage partition of the incremental tables. trip_id hashes the pickup time,
# so every copy of a trip_id lies in one pickup month (the upsert precondition).
PARTITION_COL = "pickup_month"


# Columns whose max the incremental tables record at each write (both
# watermark policies: a copy of a trip_id has the same pickup time, and a
# later load a later stamp, so an upsert never lowers either max).
WATERMARK_COLS = ("_loaded_at", "pickup_datetime")


def with_pickup_month(df: DataFrame) -> DataFrame:
    return df.withColumn(PARTITION_COL, F.trunc(F.col("pickup_datetime").cast("date"), "month"))

@dataclass
class Tables:
    """Where the materialised layers live (all under one base path)."""
    base: str

    @property
    def int_trips(self): return f"{self.base}/int_trips_enriched"
    @property
    def fct(self): return f"{self.base}/fct_trips"
    @property
    def dim(self): return f"{self.base}/dim_zones"
    @property
    def daily(self): return f"{self.base}/agg_daily_revenue"
    @property
    def zone_perf(self): return f"{self.base}/agg_zone_performance"
    @property
    def gaps(self): return f"{self.base}/agg_zone_gaps"
    @property
    def gap_edges(self): return f"{self.base}/agg_zone_gap_edges"
    @property
    def check_counts(self): return f"{self.base}/fct_check_counts"


def run_pipeline(spark: SparkSession, raw: DataFrame, seed: DataFrame, tables: Tables,
                 cfg: PipelineConfig, layers=("staging", "intermediate", "marts", "checks"),
                 full_refresh: bool = False) -> DataFrame | None:
    """M9: staging -> intermediate -> marts -> checks, each layer optional, and the
    kept gap table as the further layer 'gaps'.

    The intermediate and fact tables are incremental (high-water-mark slice +
    delete+insert by trip_id, partitioned by pickup month, which trip_id
    determines because it hashes the pickup time); the marts take over from the
    written fact what they do not hold yet (``refresh_marts``), so enrichment
    runs once per batch and a batch's cost follows its own size, not the
    fact's, and a run that died anywhere is repaired by the next one. Returns
    the check results when 'checks' runs.
    """
    stg = stage_trips(raw, cfg.duration_mode)
    zones = stage_zones(seed)
    if "intermediate" in layers:
        load_intermediate(spark, stg, zones, tables, cfg, full_refresh)
    if "marts" in layers:
        load_fact(spark, tables, cfg, full_refresh)
        dim_zones(zones).write.mode("overwrite").parquet(tables.dim)
        refresh_marts(spark, tables, cfg)
    if "gaps" in layers:
        refresh_gaps(spark, tables)
    if "checks" in layers:
        results = model_checks(spark, stg, zones, tables, cfg)
        C.gate(results)
        return results
    return None


def load_intermediate(spark: SparkSession, stg: DataFrame, zones: DataFrame, tables: Tables,
                      cfg: PipelineConfig, full_refresh: bool = False) -> None:
    """M3 on disk: the staged rows above the intermediate table's mark."""
    recover(spark, tables.int_trips)
    target = None if full_refresh else read_table(spark, tables.int_trips)
    batch = with_pickup_month(enrich_trips(stg, zones, cfg))
    staged, parts = None, None
    if target is not None:
        # Needed twice by the upsert (touched partitions, merge): staged
        # once; the staging write also reports the touched partitions.
        batch, staged, parts = stage(
            spark, new_rows(batch, target, cfg.int_watermark_col, path=tables.int_trips),
            "int-batch", distinct_of=[PARTITION_COL])
    upsert(spark, tables.int_trips, batch, "trip_id",
           [PARTITION_COL], full_refresh, parts=parts, watermark_cols=WATERMARK_COLS)
    if staged:
        delete_path(spark, staged)


def load_fact(spark: SparkSession, tables: Tables, cfg: PipelineConfig,
              full_refresh: bool = False) -> None:
    """M4 on disk: the intermediate rows above the fact's mark, one per trip."""
    recover(spark, tables.int_trips)
    recover(spark, tables.fct)
    enriched = read_table(spark, tables.int_trips)
    target = None if full_refresh else read_table(spark, tables.fct)
    batch = fact_trips(enriched if target is None else
                       fact_slice(spark, enriched, target, tables, cfg))
    staged, parts = None, None
    if target is not None:
        # The deduplicated batch feeds the touched months and the merge:
        # computed (one shuffle) and staged once.
        batch, staged, parts = stage(spark, batch, "fact-batch", distinct_of=[PARTITION_COL])
    upsert(spark, tables.fct, batch, "trip_id", [PARTITION_COL], full_refresh, parts=parts,
           watermark_cols=WATERMARK_COLS, map_col="file_month")
    if staged:
        delete_path(spark, staged)


def fact_slice(spark: SparkSession, enriched: DataFrame, target: DataFrame, tables: Tables,
               cfg: PipelineConfig) -> DataFrame:
    """The intermediate rows above the fact's mark, read from the pickup months
    that writes with a later mark replaced (all, if that is not recorded)."""
    mark = high_water_mark(target, cfg.fact_watermark_col, path=tables.fct)
    parts = partitions_above(spark, tables.int_trips, cfg.fact_watermark_col, mark)
    if parts is not None:
        enriched = enriched.filter(in_partitions(PARTITION_COL, "date", parts))
    return new_rows(enriched, target, cfg.fact_watermark_col, path=tables.fct)


# Partition column of the daily mart (the month of revenue_date, which is the
# fact's pickup month).
DAILY_PARTITION_COL = "revenue_month"

# Folder name Spark gives a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def refresh_marts(spark: SparkSession, tables: Tables, cfg: PipelineConfig) -> None:
    """M6/M7 from the written fact. Each mart keeps its own mark, the last of
    the fact's writes it holds, and takes over the later ones: a run that died after the fact's write,
    or between the marts, is repaired by the next, whatever batch that brings.

    The daily mart is stored by month and recomputed from the pickup-month
    partitions those writes replaced (partition pruning: exact, no other month
    is read). The zone mart is stored by file month and recomputed for every
    file month that a write ever put in those partitions (a reloaded trip may
    have left its old one); its revenue rank is within a month, so those months
    alone give the same rows as a full rebuild. A file month that no longer has
    any trip is removed: the write's ``observe`` reports the months it
    produced (``_write_mart``), so this costs no extra job. A mart that holds no write yet (also
    one whose first write died), or a fact written anew, is rebuilt in full.
    """
    fct = read_table(spark, tables.fct)
    mark, parts = unapplied(spark, tables.fct, tables.daily)
    if parts is None or parts:
        rows = fct if parts is None else fct.filter(in_partitions(PARTITION_COL, "date", parts))
        daily = daily_revenue(rows).withColumn(
            DAILY_PARTITION_COL, F.trunc(F.col("revenue_date"), "month"))
        _write_mart(daily, tables.daily, DAILY_PARTITION_COL, parts)
        record_applied(spark, tables.daily, mark)
    mark, parts = unapplied(spark, tables.fct, tables.zone_perf)
    if parts is None or parts:
        _refresh_zone_mart(spark, fct, tables, cfg, parts)
        record_applied(spark, tables.zone_perf, mark)


def _refresh_zone_mart(spark: SparkSession, fct: DataFrame, tables: Tables, cfg: PipelineConfig,
                       parts: list | None) -> None:
    months = None if parts is None else values_in(spark, tables.fct, parts)
    if months is not None:
        around = partitions_with(spark, tables.fct, months)
        fct = (fct.filter(in_partitions(PARTITION_COL, "date", around))
                  .filter(in_partitions("file_month", "date", months)))
    zp = zone_performance(fct, spark.read.parquet(tables.dim), cfg.high_volume_trips)
    _write_mart(zp, tables.zone_perf, "file_month", months)


def _write_mart(mart: DataFrame, path: str, by: str, parts: list | None) -> None:
    """Replace the partitions ``parts`` (as text; None: all) of a derived table;
    one that ``mart`` no longer has rows for is removed."""
    from pyspark.sql import Observation
    seen = Observation("mart")
    mart = rebalanced(mart, [by]).observe(
        seen, F.collect_set(F.col(by).cast("string")).alias("known"),
        F.count_if(F.col(by).isNull()).alias("none"))
    (mart.write.mode("overwrite").option("partitionOverwriteMode", "static" if parts is None else "dynamic")
         .partitionBy(by).parquet(path))
    if parts is not None:
        made = set(seen.get["known"] or []) | ({None} if seen.get["none"] else set())
        for p in set(parts) - made:
            delete_path(mart.sparkSession, f"{path}/{by}={NULL_PARTITION if p is None else p}")


def refresh_gaps(spark: SparkSession, tables: Tables) -> None:
    """The kept gap table: gaps between consecutive pickups of a zone inside each
    pickup month, and each (zone, month)'s first and last pickup as carried state.

    Kept like the marts: only months that the fact's writes replaced are read and
    sorted again. The gap across a month's start is not stored but follows from the
    carried times (``kept_gaps``), so a late month corrects its successor's first
    gap without touching that month."""
    mark, parts = unapplied(spark, tables.fct, tables.gaps)
    if parts is not None and not parts:
        return
    fct = read_table(spark, tables.fct)
    if parts is not None:
        fct = fct.filter(in_partitions(PARTITION_COL, "date", parts))
    zone, ts = F.col("pickup_location_id"), F.col("pickup_datetime")
    rows = fct.filter(zone.isNotNull() & ts.isNotNull()).select("pickup_location_id", "pickup_datetime", PARTITION_COL)
    edges = rows.groupBy("pickup_location_id", PARTITION_COL).agg(
        F.min(ts).alias("first_pickup"), F.max(ts).alias("last_pickup"))
    _write_mart(edges, tables.gap_edges, PARTITION_COL, parts)
    own = F.struct("pickup_location_id", PARTITION_COL).alias("zone_month")
    gaps = lag_gap(rows.select(own, "pickup_datetime"), "zone_month", "pickup_datetime",
                   prev_col="prev_pickup_datetime")
    _write_mart(gaps.select(F.col("zone_month.pickup_location_id").alias("pickup_location_id"),
                            "prev_pickup_datetime", "pickup_datetime", "gap_minutes",
                            F.col(f"zone_month.{PARTITION_COL}").alias(PARTITION_COL)),
                tables.gaps, PARTITION_COL, parts)
    record_applied(spark, tables.gaps, mark)


def kept_gaps(spark: SparkSession, tables: Tables) -> DataFrame:
    """pickup_location_id, prev_pickup_datetime, pickup_datetime, gap_minutes of all
    consecutive pickups of a zone, from the kept tables: no trip is read."""
    columns = ["pickup_location_id", "prev_pickup_datetime", "pickup_datetime", "gap_minutes"]
    edge = dict(read_table(spark, tables.fct).dtypes)
    zone, time = edge["pickup_location_id"], edge["pickup_datetime"]
    inside = spark.read.schema(f"pickup_location_id {zone}, prev_pickup_datetime {time}, pickup_datetime {time}, "
                               f"gap_minutes bigint, {PARTITION_COL} date").parquet(tables.gaps)
    edges = spark.read.schema(f"pickup_location_id {zone}, first_pickup {time}, last_pickup {time}, "
                              f"{PARTITION_COL} date").parquet(tables.gap_edges)
    # One row per zone and month with trips.
    by_month = Window.partitionBy("pickup_location_id").orderBy(PARTITION_COL)
    across = (edges.withColumn("prev_pickup_datetime", F.lag("last_pickup").over(by_month))
                   .filter(F.col("prev_pickup_datetime").isNotNull())
                   .withColumn("pickup_datetime", F.col("first_pickup"))
                   .withColumn("gap_minutes", minutes_between("prev_pickup_datetime", "pickup_datetime")))
    return inside.select(*columns).unionByName(across.select(*columns))


def read_marts(spark: SparkSession, tables: Tables, fct: DataFrame,
               cfg: PipelineConfig) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(dim_zones, daily, zone performance) as stored, by the schemas their
    models give: a mart without rows reads as empty."""
    dim = spark.read.parquet(tables.dim)
    daily = daily_revenue(fct).withColumn(DAILY_PARTITION_COL, F.trunc("revenue_date", "month"))
    zp = zone_performance(fct, dim, cfg.high_volume_trips)
    return (dim, spark.read.schema(daily.schema).parquet(tables.daily),
            spark.read.schema(zp.schema).parquet(tables.zone_perf))


def model_checks(spark: SparkSession, stg: DataFrame, zones: DataFrame, tables: Tables,
                 cfg: PipelineConfig) -> DataFrame:
    """The model tests: not_null, unique, relationships, range, total >= fare.
    The fact's failures are kept per pickup month and counted again only for the
    months its writes replaced since (``fact_counts``)."""
    fct = read_table(spark, tables.fct)
    dim, daily, zp = read_marts(spark, tables, fct, cfg)
    return C.check_counts(staging_checks(stg, zones, read_table(spark, tables.int_trips))
                          + [C.Counted(fact_counts(spark, tables, dim, cfg))]
                          + mart_checks(dim, daily, zp))


def fact_counts(spark: SparkSession, tables: Tables, dim: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """(check, column_name, failures) of the fact's tests. A trip id fixes its
    pickup month, so repeats are counted per month; zones are kept as counts per
    month and zone and met with the dimension as it is now."""
    rules = fact_rules(cfg)
    mark, parts = unapplied(spark, tables.fct, tables.check_counts)
    # The rules' limits are part of what is kept: others start it anew.
    limits, at = [cfg.min_duration, cfg.max_duration], f"{tables.check_counts}/_applied/limits.json"
    if not _kept_under(spark, at, limits):
        parts = None
    schema = f"check string, column_name string, `key` string, failures bigint, {PARTITION_COL} date"
    if parts is None or parts:
        fct = read_table(spark, tables.fct)
        rows = fct if parts is None else fct.filter(in_partitions(PARTITION_COL, "date", parts))
        _write_mart(C.partition_counts(rows, PARTITION_COL, rules, [("fct_trips.trip_id", "trip_id")],
                                       [("fct_trips.pickup_location_id", "pickup_location_id")]),
                    tables.check_counts, PARTITION_COL, parts)
        write_record(spark, at, {"limits": limits})
        record_applied(spark, tables.check_counts, mark)
    names = [*rules, ("unique", "fct_trips.trip_id"), ("relationships", "fct_trips.pickup_location_id")]
    return C.kept_counts(spark.read.schema(schema).parquet(tables.check_counts), names,
                         {"fct_trips.pickup_location_id": (dim, "location_id")})


def _kept_under(spark: SparkSession, at: str, limits: list) -> bool:
    return exists(spark, at) and read_record(spark, at)["limits"] == limits


def staging_checks(stg: DataFrame, zones: DataFrame, enriched: DataFrame) -> list:
    """The tests of the staging and intermediate models."""
    return [
        C.RowChecks(stg, {("not_null", "stg_trips.trip_id"): C.null_rule("trip_id"),
                          ("not_null", "stg_trips.pickup_datetime"): C.null_rule("pickup_datetime")}),
        C.RowChecks(zones, {("not_null", "stg_zones.location_id"): C.null_rule("location_id"),
                            ("not_null", "stg_zones.borough"): C.null_rule("borough")}),
        C.Check("unique", "stg_zones.location_id", C.unique(zones, "location_id")),
        C.RowChecks(enriched, {
            ("not_null", "int_trips_enriched.trip_id"): C.null_rule("trip_id"),
            ("not_null", "int_trips_enriched.pickup_location_id"): C.null_rule("pickup_location_id"),
        }),
    ]


def fact_rules(cfg: PipelineConfig) -> dict:
    """Row rules of the fact: (check, column) -> predicate true on a failing row."""
    return {
        ("not_null", "fct_trips.trip_id"): C.null_rule("trip_id"),
        ("not_null", "fct_trips.pickup_location_id"): C.null_rule("pickup_location_id"),
        ("value_within_range", "fct_trips.trip_duration_minutes"):
            C.range_rule("trip_duration_minutes", cfg.min_duration, cfg.max_duration),
        ("not_null", "fct_trips.fare_amount"): C.null_rule("fare_amount"),
        ("expression_holds", "fct_trips.total_amount>=fare_amount"):
            F.col("total_amount") < F.col("fare_amount"),
    }


def fact_checks(fct: DataFrame, dim: DataFrame, daily: DataFrame, zp: DataFrame,
                cfg: PipelineConfig) -> list:
    """The tests of the fact, the dimension and the marts over all rows. Row-level
    rules of a table share one scan (RowChecks); uniqueness is a grouped count; the
    relationship is an anti-join against the dimension's keys."""
    return [
        C.RowChecks(fct, fact_rules(cfg)),
        C.Check("unique", "fct_trips.trip_id", C.unique(fct, "trip_id")),
        C.Check("relationships", "fct_trips.pickup_location_id",
                C.relationships(fct, "pickup_location_id", dim, "location_id")),
        *mart_checks(dim, daily, zp),
    ]


def mart_checks(dim: DataFrame, daily: DataFrame, zp: DataFrame) -> list:
    """The tests of the dimension and the marts."""
    return [
        C.RowChecks(dim, {("not_null", "dim_zones.location_id"): C.null_rule("location_id")}),
        C.Check("unique", "dim_zones.location_id", C.unique(dim, "location_id")),
        C.RowChecks(daily, {("not_null", "agg_daily_revenue.revenue_date"):
                            C.null_rule("revenue_date")}),
        C.Check("unique", "agg_daily_revenue.revenue_date", C.unique(daily, "revenue_date")),
        C.RowChecks(zp, {
            ("not_null", "agg_zone_performance.zone_month_key"): C.null_rule("zone_month_key"),
            ("not_null", "agg_zone_performance.file_month"): C.null_rule("file_month"),
            ("not_null", "agg_zone_performance.pickup_location_id"):
                C.null_rule("pickup_location_id"),
        }),
        C.Check("unique", "agg_zone_performance.zone_month_key",
                C.unique(zp, "zone_month_key")),
    ]
