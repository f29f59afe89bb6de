"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly against the driver tables (views: lineitem, orders, customer,
supplier, part, nation, region, events, ...). The same arithmetic formulas as
the Spark side are spelled out in SQL (half-away rounding, decimal sums), so a
match means equal values, not merely close ones.
"""

from __future__ import annotations


# ------------------------------------------------------------------ SQL helpers

def rha(x: str, d: int = 2) -> str:
    """Half-away-from-zero rounding on the double value."""
    f = f"{float(10 ** d)!r}::DOUBLE"
    return (f"(CASE WHEN ({x}) >= 0 THEN floor(({x}) * {f} + 0.5) / {f} "
            f"ELSE -(floor(-({x}) * {f} + 0.5) / {f}) END)")


def esum(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(38,10))) AS DOUBLE)"


def eavg(x: str) -> str:
    return f"({esum(x)} / CAST(count({x}) AS DOUBLE))"


def pct(a: str, b: str) -> str:
    return f"(100.0::DOUBLE * CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def ts_text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def dbl_text(c: str) -> str:
    return f"CAST(CAST(floor({c} * 1e6 + 0.5) AS BIGINT) AS VARCHAR)"


# ------------------------------------------------------------------ fixture CTEs

MIN_DUR, MAX_DUR, YEAR, HIGH_VOL = 1440, 259200, 1997, 30
LOADED_AT = "TIMESTAMP '2024-01-01 00:00:00'"

RAW = f"""
raw AS (
  SELECT
    CAST(o.o_orderdate AS TIMESTAMP) AS tpep_pickup_datetime,
    CAST(l.l_shipdate AS TIMESTAMP) AS tpep_dropoff_datetime,
    CAST(round(nullif(l.l_quantity, 7.0)) AS INTEGER) AS passenger_count,
    CAST(p.p_size AS DOUBLE) AS trip_distance,
    CAST(c.c_nationkey AS INTEGER) AS PULocationID,
    CAST(s.s_nationkey AS INTEGER) AS DOLocationID,
    CAST(l.l_linenumber AS INTEGER) AS payment_type,
    l.l_extendedprice AS fare_amount,
    l.l_extendedprice * l.l_tax AS tip_amount,
    l.l_extendedprice * (1.0::DOUBLE - l.l_discount) * (1.0::DOUBLE + l.l_tax) AS total_amount,
    'yellow_tripdata_' || strftime(o.o_orderdate, '%Y-%m') || '.parquet' AS source_file,
    CAST(date_trunc('month', o.o_orderdate) AS DATE) AS file_month,
    {LOADED_AT} AS _loaded_at,
    l.l_orderkey, l.l_linenumber
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

TRIP_ID = ("md5(" + " || '|' || ".join([
    f"coalesce({ts_text('tpep_pickup_datetime')}, '')",
    f"coalesce({ts_text('tpep_dropoff_datetime')}, '')",
    "coalesce(CAST(PULocationID AS VARCHAR), '')",
    "coalesce(CAST(DOLocationID AS VARCHAR), '')",
    f"coalesce({dbl_text('fare_amount')}, '')",
    f"coalesce({dbl_text('total_amount')}, '')",
    f"coalesce({dbl_text('trip_distance')}, '')",
    "coalesce(CAST(passenger_count AS VARCHAR), '')",
]) + ")")


def stg_cte(duration: str = "date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime)") -> str:
    return f"""
stg AS (
  SELECT
    {TRIP_ID} AS trip_id,
    tpep_pickup_datetime AS pickup_datetime,
    tpep_dropoff_datetime AS dropoff_datetime,
    passenger_count, trip_distance,
    PULocationID AS pickup_location_id,
    DOLocationID AS dropoff_location_id,
    payment_type, fare_amount, tip_amount, total_amount,
    {duration} AS trip_duration_minutes,
    file_month, source_file, _loaded_at
  FROM raw
)"""


STG = stg_cte()

ZONES = """
zones AS (
  SELECT CAST(n_nationkey AS INTEGER) AS location_id, r_name AS borough,
         n_name AS zone_name, 'Zone ' || CAST(n_regionkey AS VARCHAR) AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

# Kept trips by the rules first, then each one's zone names looked up.
KEEP = (f"trip_distance > 0 AND fare_amount > 0 AND passenger_count > 0 AND "
        f"trip_duration_minutes BETWEEN {MIN_DUR} AND {MAX_DUR} AND year(pickup_datetime) = {YEAR}")


def enriched_of(name: str, src: str, zones: str = "zones") -> str:
    def named(column: str, role: str) -> str:
        return (f"(SELECT any_value({column}) FROM {zones} WHERE location_id = "
                f"k.{role}_location_id) AS {role}_{column.removesuffix('_name')}")
    looked_up = ", ".join(named(c, r) for r in ("pickup", "dropoff") for c in ("borough", "zone_name"))
    return f"""
{name} AS (SELECT k.*, {looked_up} FROM (SELECT * FROM {src} WHERE {KEEP}) k)"""


ENRICHED = enriched_of("enriched", "stg")

FCT = """
fct AS (
  SELECT * FROM enriched
  QUALIFY row_number() OVER (
    PARTITION BY trip_id
    ORDER BY _loaded_at DESC NULLS FIRST, pickup_datetime DESC NULLS LAST,
             dropoff_datetime DESC NULLS LAST, trip_duration_minutes DESC NULLS LAST,
             passenger_count DESC NULLS LAST, trip_distance DESC NULLS LAST,
             payment_type DESC NULLS LAST, fare_amount DESC NULLS LAST,
             tip_amount DESC NULLS LAST, total_amount DESC NULLS LAST,
             pickup_location_id DESC NULLS LAST, pickup_borough DESC NULLS LAST,
             pickup_zone DESC NULLS LAST, dropoff_location_id DESC NULLS LAST,
             dropoff_borough DESC NULLS LAST, dropoff_zone DESC NULLS LAST,
             file_month DESC NULLS LAST, source_file DESC NULLS LAST) = 1
)"""

ZONE_PERF = f"""
zone_perf AS (
  SELECT
    md5(CAST(g.pickup_location_id AS VARCHAR) || '|' || strftime(g.file_month, '%Y-%m-%d'))
      AS zone_month_key,
    g.file_month, g.pickup_location_id, z.borough, z.zone_name, g.total_trips,
    g.avg_trip_distance, g.avg_fare, g.total_revenue,
    CAST(rank() OVER (PARTITION BY g.file_month ORDER BY g.total_revenue DESC NULLS FIRST)
         AS INTEGER) AS revenue_rank,
    (g.total_trips > {HIGH_VOL}) AS is_high_volume_zone
  FROM (
    SELECT file_month, pickup_location_id, CAST(count(*) AS BIGINT) AS total_trips,
           {rha(eavg('trip_distance'))} AS avg_trip_distance,
           {rha(eavg('fare_amount'))} AS avg_fare,
           {rha(esum('total_amount'))} AS total_revenue
    FROM fct GROUP BY file_month, pickup_location_id
  ) g
  LEFT JOIN zones z ON g.pickup_location_id = z.location_id
)"""

EVENT_FACT = """
efct AS (
  SELECT event_id AS trip_id, CAST(ts AS TIMESTAMP) AS pickup_datetime,
         user_id AS pickup_location_id, value AS fare_amount,
         event_type AS payment_label, props
  FROM events
)"""


def w(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


FACT_CHAIN = (RAW, STG, ZONES, ENRICHED, FCT)


def idle_gaps_sql(src: str) -> str:
    """From the definition: a pickup's predecessor is the zone's latest earlier
    moment; further pickups at one moment follow the first with no gap."""
    return f"""
, moments AS (
  SELECT pickup_location_id AS zone, pickup_datetime AS t, count(*) AS pickups
  FROM {src} WHERE pickup_location_id IS NOT NULL AND pickup_datetime IS NOT NULL GROUP BY ALL)
, waits AS (
  SELECT a.zone, b.t AS since, a.t AS until FROM moments a ASOF JOIN moments b
    ON a.zone = b.zone AND b.t < a.t
  UNION ALL
  SELECT zone, t, t FROM moments, range(1, pickups))
, ranked AS (
  SELECT *, date_diff('minute', since, until) AS wait,
         rank() OVER (PARTITION BY zone ORDER BY date_diff('minute', since, until) DESC) AS place
  FROM waits)
SELECT zone AS pickup_location_id,
       (SELECT any_value(zone_name) FROM zones WHERE location_id = zone) AS zone_name,
       since AS prev_pickup_datetime, until AS pickup_datetime, wait AS gap_minutes,
       CAST(place AS INTEGER) AS gap_rank
FROM ranked WHERE place <= 5
"""


ORACLE: dict[str, str] = {
    "idle_gaps": w(ZONES, EVENT_FACT) + idle_gaps_sql("efct"),
    "idle_gaps_fact": w(*FACT_CHAIN) + idle_gaps_sql("fct"),
    "stage_trips": w(RAW, STG) + " SELECT * FROM stg",
    "enriched_trips": w(RAW, STG, ZONES, ENRICHED) + " SELECT * FROM enriched",
    "daily_revenue": w(*FACT_CHAIN) + f"""
SELECT CAST(pickup_datetime AS DATE) AS revenue_date,
       CAST(count(*) AS BIGINT) AS total_trips,
       {rha(esum('fare_amount'))} AS total_fare,
       {rha(eavg('fare_amount'))} AS avg_fare,
       {rha(esum('tip_amount'))} AS total_tips,
       {rha(pct(esum('tip_amount'), esum('fare_amount')))} AS tip_rate_pct
FROM fct GROUP BY 1""",
    "zone_month_performance": w(*FACT_CHAIN, ZONE_PERF) + " SELECT * FROM zone_perf",
}


# ------------------------------------------------------------------ more fixture CTEs

FILES = """
files AS (
  SELECT
    CAST(1 + l.l_suppkey % 2 AS INTEGER) AS VendorID,
    CAST(o.o_orderdate AS TIMESTAMP) AS tpep_pickup_datetime,
    CAST(l.l_shipdate AS TIMESTAMP) AS tpep_dropoff_datetime,
    nullif(l.l_quantity, 7.0) AS passenger_count,
    CAST(p.p_size AS DOUBLE) AS trip_distance,
    CASE WHEN l.l_linenumber = 7 THEN 99.0::DOUBLE ELSE CAST(l.l_linenumber AS DOUBLE) END
      AS RatecodeID,
    l.l_linestatus AS store_and_fwd_flag,
    CAST(c.c_nationkey AS INTEGER) AS PULocationID,
    CAST(s.s_nationkey AS INTEGER) AS DOLocationID,
    CAST(l.l_linenumber AS INTEGER) AS payment_type,
    l.l_extendedprice AS fare_amount,
    l.l_discount * 10.0::DOUBLE AS extra,
    CASE WHEN l.l_linenumber = 7 THEN -0.5::DOUBLE ELSE 0.5::DOUBLE END AS mta_tax,
    l.l_extendedprice * l.l_tax AS tip_amount,
    l.l_tax * 100.0::DOUBLE AS tolls_amount,
    1.0::DOUBLE AS improvement_surcharge,
    l.l_extendedprice * (1.0::DOUBLE - l.l_discount) * (1.0::DOUBLE + l.l_tax) AS total_amount,
    CASE WHEN l.l_quantity <> 7 THEN 2.5::DOUBLE END AS congestion_surcharge,
    CASE WHEN l.l_quantity <> 7 THEN CASE WHEN l.l_linenumber = 1 THEN 1.25::DOUBLE
                                          ELSE 0.0::DOUBLE END END AS airport_fee
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

# The files' columns with their types (fixed values).
FILE_TYPES = {
    "VendorID": "int", "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz", "passenger_count": "double",
    "trip_distance": "double", "RatecodeID": "double", "store_and_fwd_flag": "string",
    "PULocationID": "int", "DOLocationID": "int", "payment_type": "int", "fare_amount": "double",
    "extra": "double", "mta_tax": "double", "tip_amount": "double", "tolls_amount": "double",
    "improvement_surcharge": "double", "total_amount": "double", "congestion_surcharge": "double",
    "airport_fee": "double",
}
FILE_COLUMNS = list(FILE_TYPES)
# Columns that other months' files store as 64-bit integers.
WIDENED = ("VendorID", "passenger_count", "PULocationID", "DOLocationID", "payment_type")

PZONES = """
pzones AS (SELECT * FROM zones WHERE location_id < 20)"""

EVENT_FACT2 = """
efct AS (
  SELECT event_id AS trip_id, CAST(ts AS TIMESTAMP) AS pickup_datetime,
         user_id AS pickup_location_id, value AS fare_amount,
         event_type AS payment_label,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS trip_distance, props
  FROM events
)"""

PAIRS = """
pairs AS (
  SELECT a.event_id, CAST(a.ts AS TIMESTAMP) AS start_ts, CAST(b.ts AS TIMESTAMP) AS end_ts
  FROM events a JOIN events b ON b.event_id - 1 = a.event_id
)"""

RUN_DATE, RUN_MONTH, SLICE_MONTH, LATE_MONTH = "1997-03-10", "1997-03-01", "1996-12-01", "1997-01-01"
LOAD_1, LOAD_2, LOAD_3 = (f"TIMESTAMP '2024-01-0{i} 00:00:00'" for i in (1, 2, 3))


def share(count_col: str, digits: int) -> str:
    return rha(pct(count_col, f"sum({count_col}) OVER ()"), digits)


def raw_at(name: str, loaded_at: str, cond: str) -> str:
    return f"""
{name} AS (SELECT * REPLACE ({loaded_at} AS _loaded_at) FROM raw WHERE {cond})"""


def stg_of(name: str, src: str, tip: str = "tip_amount") -> str:
    return f"""
{name} AS (
  SELECT
    {TRIP_ID} AS trip_id,
    tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
    passenger_count, trip_distance, PULocationID AS pickup_location_id,
    DOLocationID AS dropoff_location_id, payment_type, fare_amount, {tip} AS tip_amount,
    total_amount,
    date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) AS trip_duration_minutes,
    file_month, source_file, _loaded_at
  FROM {src}
)"""


def fct_of(name: str, src: str) -> str:
    return FCT.replace("fct AS", f"{name} AS").replace("FROM enriched", f"FROM {src}")


REASONS = [
    ("trip_distance_not_positive", "trip_distance > 0"),
    ("fare_amount_not_positive", "fare_amount > 0"),
    ("passenger_count_not_positive", "passenger_count > 0"),
    ("trip_duration_minutes_out_of_range",
     f"trip_duration_minutes BETWEEN {MIN_DUR} AND {MAX_DUR}"),
    ("pickup_datetime_wrong_year",
     f"pickup_datetime >= TIMESTAMP '{YEAR}-01-01' AND pickup_datetime < TIMESTAMP '{YEAR + 1}-01-01'"),
]
REASON_TEXT = "concat_ws(',', " + ", ".join(
    f"CASE WHEN coalesce({p}, false) THEN NULL ELSE '{n}' END" for n, p in REASONS) + ")"

CLEAN_PRED = " AND ".join(p for _, p in REASONS)

DAILY = f"""
daily AS (
  SELECT CAST(pickup_datetime AS DATE) AS revenue_date,
         CAST(count(*) AS BIGINT) AS total_trips,
         {rha(esum('fare_amount'))} AS total_fare,
         {rha(eavg('fare_amount'))} AS avg_fare,
         {rha(esum('tip_amount'))} AS total_tips,
         {rha(pct(esum('tip_amount'), esum('fare_amount')))} AS tip_rate_pct
  FROM fct GROUP BY 1
)"""

PAYMENT_CASE = ("CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' "
                "WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' ELSE 'Other' END")


def null_profile_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, "
             f"count(*) AS n FROM files" for c in FILE_COLUMNS]
    return (w(FILES) + ", prof AS (" + " UNION ALL ".join(parts) + ") "
            f"SELECT column_name, null_count, {rha(pct('null_count', 'n'), 3)} AS null_pct "
            "FROM prof WHERE null_count > 0")


def numeric_summary_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, {rha(eavg(f'CAST({c} AS DOUBLE)'))} AS avg_value, "
             f"CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value "
             "FROM files" for c in ["trip_distance", "fare_amount", "total_amount",
                                    "passenger_count"]]
    return w(FILES) + " " + " UNION ALL ".join(parts)


def quantiles_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, {p}::DOUBLE AS prob, "
             f"CAST(quantile_cont({c}, {p}) AS DOUBLE) AS value FROM files WHERE fare_amount > 0"
             for c in ["trip_distance", "fare_amount", "total_amount"] for p in (0.5, 0.9, 0.99)]
    return w(FILES) + " " + " UNION ALL ".join(parts)


HISTOGRAM = w(FILES) + """
, clipped AS (SELECT CAST(trip_distance AS DOUBLE) AS x FROM files
              WHERE trip_distance BETWEEN 0.0 AND 20.0)
, mm AS (SELECT min(x) AS mn, max(x) AS mx FROM clipped)
, wd AS (SELECT mn, CASE WHEN mx > mn THEN (mx - mn) / 40.0::DOUBLE ELSE 1.0::DOUBLE END AS wdt FROM mm)
, b AS (SELECT least(CAST(floor((x - wd.mn) / wd.wdt) AS INTEGER), 39) AS bin, wd.mn, wd.wdt
        FROM clipped, wd)
SELECT bin, any_value(mn) + CAST(bin AS DOUBLE) * any_value(wdt) AS bin_lo,
       any_value(mn) + CAST(bin + 1 AS DOUBLE) * any_value(wdt) AS bin_hi,
       CAST(count(*) AS BIGINT) AS trips
FROM b GROUP BY bin"""


def checks_sql() -> str:
    checks = [
        ("not_null", "stg_trips.trip_id", "SELECT 1 FROM stg WHERE trip_id IS NULL"),
        ("not_null", "stg_trips.pickup_datetime", "SELECT 1 FROM stg WHERE pickup_datetime IS NULL"),
        ("not_null", "stg_zones.location_id", "SELECT 1 FROM pzones WHERE location_id IS NULL"),
        ("not_null", "stg_zones.borough", "SELECT 1 FROM pzones WHERE borough IS NULL"),
        ("unique", "stg_zones.location_id",
         "SELECT location_id FROM pzones GROUP BY 1 HAVING count(*) > 1"),
        ("not_null", "int_trips_enriched.trip_id", "SELECT 1 FROM enriched WHERE trip_id IS NULL"),
        ("not_null", "int_trips_enriched.pickup_location_id",
         "SELECT 1 FROM enriched WHERE pickup_location_id IS NULL"),
        ("not_null", "fct_trips.trip_id", "SELECT 1 FROM fct WHERE trip_id IS NULL"),
        ("unique", "fct_trips.trip_id",
         "SELECT trip_id FROM fct WHERE trip_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"),
        ("not_null", "fct_trips.pickup_location_id",
         "SELECT 1 FROM fct WHERE pickup_location_id IS NULL"),
        ("relationships", "fct_trips.pickup_location_id",
         "SELECT 1 FROM fct WHERE pickup_location_id IS NOT NULL AND pickup_location_id NOT IN "
         "(SELECT location_id FROM pzones WHERE location_id IS NOT NULL)"),
        ("value_within_range", "fct_trips.trip_duration_minutes",
         f"SELECT 1 FROM fct WHERE trip_duration_minutes < {MIN_DUR} "
         f"OR trip_duration_minutes > {MAX_DUR}"),
        ("not_null", "fct_trips.fare_amount", "SELECT 1 FROM fct WHERE fare_amount IS NULL"),
        ("not_null", "dim_zones.location_id", "SELECT 1 FROM pzones WHERE location_id IS NULL"),
        ("unique", "dim_zones.location_id",
         "SELECT location_id FROM pzones WHERE location_id IS NOT NULL GROUP BY 1 "
         "HAVING count(*) > 1"),
        ("not_null", "agg_daily_revenue.revenue_date",
         "SELECT 1 FROM daily WHERE revenue_date IS NULL"),
        ("unique", "agg_daily_revenue.revenue_date",
         "SELECT revenue_date FROM daily WHERE revenue_date IS NOT NULL GROUP BY 1 "
         "HAVING count(*) > 1"),
        ("not_null", "agg_zone_performance.zone_month_key",
         "SELECT 1 FROM zone_perf WHERE zone_month_key IS NULL"),
        ("unique", "agg_zone_performance.zone_month_key",
         "SELECT zone_month_key FROM zone_perf WHERE zone_month_key IS NOT NULL GROUP BY 1 "
         "HAVING count(*) > 1"),
        ("not_null", "agg_zone_performance.file_month",
         "SELECT 1 FROM zone_perf WHERE file_month IS NULL"),
        ("not_null", "agg_zone_performance.pickup_location_id",
         "SELECT 1 FROM zone_perf WHERE pickup_location_id IS NULL"),
        ("expression_holds", "fct_trips.total_amount>=fare_amount",
         "SELECT 1 FROM fct WHERE total_amount < fare_amount"),
    ]
    parts = [f"SELECT '{n}' AS \"check\", '{c}' AS column_name, "
             f"CAST((SELECT count(*) FROM ({q})) AS BIGINT) AS failures" for n, c, q in checks]
    zp = ZONE_PERF.replace("LEFT JOIN zones z", "LEFT JOIN pzones z")
    return (w(*FACT_CHAIN, PZONES, DAILY, zp) + ", res AS (" + " UNION ALL ".join(parts) + ") "
            "SELECT *, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM res")


def late_month_sql(watermark: str) -> str:
    return w(RAW, ZONES,
             raw_at("b1", LOAD_1, f"file_month > DATE '{LATE_MONTH}'"),
             raw_at("b2", LOAD_2, f"file_month = DATE '{LATE_MONTH}'"),
             stg_of("s1", "b1"), stg_of("s2", "b2"),
             enriched_of("e1", "s1"), enriched_of("e2", "s2"),
             fct_of("f1", "e1")) + f"""
, sl AS (SELECT * FROM e2 WHERE {watermark} >
         (SELECT coalesce(max({watermark}), TIMESTAMP '1900-01-01 00:00:00') FROM f1))
{fct_of(', f2', 'sl').replace(', f2 AS', ', f2 AS', 1)}
SELECT * FROM f1 WHERE trip_id NOT IN (SELECT trip_id FROM f2)
UNION ALL SELECT * FROM f2"""


ORACLE.update({
    "duration_boundary": w(PAIRS) + """
SELECT event_id, start_ts, end_ts, date_diff('minute', start_ts, end_ts) AS minutes FROM pairs""",
    "duration_fractional": w(PAIRS) + """
SELECT event_id, start_ts, end_ts,
       CAST(date_diff('second', date_trunc('second', start_ts), date_trunc('second', end_ts))
            AS DOUBLE) / 60.0::DOUBLE AS minutes FROM pairs""",
    "date_parts": w(EVENT_FACT2) + """
SELECT trip_id, CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
       CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
       CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
       CAST(pickup_datetime AS DATE) AS pickup_date,
       strftime(pickup_datetime, '%A') AS day_name FROM efct""",
    "json_extract": """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "label_codes": w(RAW) + f"""
SELECT l_orderkey, l_linenumber, payment_type, {PAYMENT_CASE} AS label FROM raw""",
    "clean_trips": w(RAW, STG) + f" SELECT * FROM stg WHERE {CLEAN_PRED}",
    "reject_reasons": w(RAW, STG) + f"""
, r AS (SELECT trip_id, {REASON_TEXT} AS reject_reasons FROM stg)
SELECT trip_id, reject_reasons FROM r WHERE reject_reasons <> ''""",
    "year_filter": w(RAW, STG) + f"""
SELECT trip_id, pickup_datetime FROM stg WHERE year(pickup_datetime) = {YEAR}""",
    "in_filter": w(RAW) + """
SELECT l_orderkey, l_linenumber, PULocationID FROM raw WHERE PULocationID IN (1, 3, 5)""",
    "left_join_dim": w(RAW, STG, ZONES, PZONES) + """
SELECT t.trip_id, t.pickup_location_id, z.borough, z.zone_name
FROM stg t LEFT JOIN pzones z ON t.pickup_location_id = z.location_id""",
    "inner_join_dim": w(RAW, STG, ZONES, PZONES) + """
SELECT t.trip_id, t.pickup_location_id, z.borough
FROM stg t JOIN pzones z ON t.pickup_location_id = z.location_id""",
    "enrich_two_roles": w(RAW, STG, ZONES, PZONES, enriched_of("e", "stg", "pzones"))
    + " SELECT * FROM e",
    "orphan_keys": w(RAW, STG, ZONES, PZONES) + """
SELECT trip_id, pickup_location_id FROM stg t
WHERE pickup_location_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM pzones z WHERE z.location_id = t.pickup_location_id)""",
    "borough_not_null": w(RAW, STG, ZONES, PZONES, enriched_of("e", "stg", "pzones")) + """
SELECT trip_id, pickup_borough, dropoff_borough FROM e
WHERE pickup_borough IS NOT NULL AND dropoff_borough IS NOT NULL""",
    "dim_zones": w(ZONES) + " SELECT location_id, borough, zone_name, service_zone FROM zones",
    "volume_by_month": w(*FACT_CHAIN) + f"""
SELECT CAST(month(pickup_datetime) AS INTEGER) AS month, CAST(count(*) AS BIGINT) AS trips,
       {rha(eavg('trip_distance'))} AS avg_miles, {rha(eavg('fare_amount'))} AS avg_fare,
       {rha(eavg('total_amount'))} AS avg_total,
       {rha(esum('total_amount') + ' / 1e6::DOUBLE', 1)} AS revenue_millions
FROM fct GROUP BY 1""",
    "zone_all_time": w(*FACT_CHAIN, ZONE_PERF) + f"""
, g AS (
  SELECT pickup_location_id, borough, zone_name,
         CAST(count(*) AS BIGINT) AS months_observed,
         CAST(sum(total_trips) AS BIGINT) AS total_trips,
         {rha(esum('total_revenue'))} AS total_revenue,
         min(revenue_rank) AS best_month_rank,
         CAST(count_if(is_high_volume_zone) AS BIGINT) AS high_volume_months
  FROM zone_perf GROUP BY 1, 2, 3)
SELECT *, CAST(rank() OVER (ORDER BY total_revenue DESC NULLS FIRST) AS INTEGER) AS all_time_rank
FROM g""",
    "run_date_lookup": w(*FACT_CHAIN, DAILY) + f"""
SELECT revenue_date, total_trips, total_fare FROM daily WHERE revenue_date = DATE '{RUN_DATE}'""",
    "payment_tipping": w(*FACT_CHAIN) + f"""
, g AS (
  SELECT payment_type, {PAYMENT_CASE} AS label, CAST(count(*) AS BIGINT) AS trips,
         {rha(eavg('tip_amount'))} AS avg_tip,
         {rha('100.0::DOUBLE * avg(CASE WHEN tip_amount > 0 THEN 1 ELSE 0 END)', 1)}
           AS pct_trips_tipped,
         {rha(pct(esum('tip_amount'), esum('fare_amount')), 1)} AS tip_pct_of_fare
  FROM fct GROUP BY 1, 2)
SELECT *, {share('trips', 1)} AS pct_of_trips FROM g""",
    "borough_flow": w(*FACT_CHAIN) + f"""
, g AS (
  SELECT pickup_borough, dropoff_borough, CAST(count(*) AS BIGINT) AS trips,
         {rha(eavg('trip_distance'))} AS avg_miles, {rha(eavg('total_amount'))} AS avg_total
  FROM fct WHERE pickup_borough IS NOT NULL AND dropoff_borough IS NOT NULL
  GROUP BY 1, 2)
SELECT *, {share('trips', 1)} AS pct_of_trips FROM g
ORDER BY trips DESC, pickup_borough, dropoff_borough LIMIT 15""",
    "hour_of_day": w(EVENT_FACT2) + f"""
, g AS (
  SELECT CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
         CAST(count(*) AS BIGINT) AS total_trips,
         {rha(eavg('fare_amount'))} AS avg_fare, {rha(eavg('trip_distance'))} AS avg_distance
  FROM efct GROUP BY 1)
SELECT *, {share('total_trips', 2)} AS pct_of_trips FROM g""",
    "hour_profile": w(EVENT_FACT2) + f"""
, g AS (
  SELECT CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour, CAST(count(*) AS BIGINT) AS trips,
         {rha(eavg('fare_amount'))} AS avg_fare, {rha(eavg('trip_distance'))} AS avg_miles,
         {rha(eavg('minute(pickup_datetime)'), 1)} AS avg_duration_min
  FROM efct GROUP BY 1)
SELECT *, {share('trips', 2)} AS pct_of_trips FROM g""",
    "top_zones_by_revenue": w(*FACT_CHAIN, ZONE_PERF) + """
SELECT file_month, pickup_location_id, revenue_rank, borough, zone_name, total_trips,
       avg_fare, total_revenue, is_high_volume_zone
FROM zone_perf ORDER BY revenue_rank ASC NULLS LAST, file_month, pickup_location_id LIMIT 10""",
    "top_zones_month": w(*FACT_CHAIN, ZONE_PERF) + f"""
SELECT file_month, pickup_location_id, revenue_rank, borough, zone_name, total_trips,
       avg_fare, total_revenue, is_high_volume_zone
FROM zone_perf WHERE file_month = DATE '{RUN_MONTH}'
ORDER BY revenue_rank ASC NULLS LAST, file_month, pickup_location_id LIMIT 10""",
    "top_zones_by_trips": w(*FACT_CHAIN, ZONE_PERF) + """
SELECT file_month, pickup_location_id, revenue_rank, borough, zone_name, total_trips,
       avg_trip_distance, avg_fare, total_revenue, is_high_volume_zone
FROM zone_perf
ORDER BY total_trips DESC, total_revenue DESC NULLS FIRST, file_month, pickup_location_id
LIMIT 15""",
    "dq_audit": w(RAW) + f"""
SELECT CAST(count(*) AS BIGINT) AS raw_rows,
       CAST(count_if(fare_amount <= 0) AS BIGINT) AS bad_fare,
       CAST(count_if(trip_distance <= 0) AS BIGINT) AS bad_distance,
       CAST(count_if(tpep_dropoff_datetime <= tpep_pickup_datetime) AS BIGINT) AS bad_time,
       CAST(count_if(passenger_count IS NULL OR passenger_count < 1 OR passenger_count > 6)
            AS BIGINT) AS bad_passengers,
       CAST(count_if(year(tpep_pickup_datetime) <> {YEAR}) AS BIGINT) AS year_leakage
FROM raw""",
    "row_range": w(FILES) + """
SELECT CAST(count(*) AS BIGINT) AS rows, min(tpep_pickup_datetime) AS min_pickup,
       max(tpep_pickup_datetime) AS max_pickup FROM files""",
    "rows_per_year": w(FILES) + f"""
, g AS (SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
               CAST(count(*) AS BIGINT) AS trips FROM files GROUP BY 1)
SELECT *, {share('trips', 4)} AS pct FROM g""",
    "null_profile": null_profile_sql(),
    "numeric_summary": numeric_summary_sql(),
    "quantiles": quantiles_sql(),
    "histogram": HISTOGRAM,
    "payment_mix": w(FILES) + f"""
, g AS (
  SELECT payment_type,
         CASE payment_type WHEN 0 THEN '(0) undocumented' WHEN 1 THEN 'Credit card'
              WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute'
              WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided' ELSE '???' END AS label,
         CAST(count(*) AS BIGINT) AS trips
  FROM files GROUP BY 1, 2)
SELECT *, {share('trips', 2)} AS pct FROM g""",
    "rate_code_mix": w(FILES) + """
SELECT RatecodeID,
       CASE RatecodeID WHEN 1 THEN 'Standard' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'
            WHEN 4 THEN 'Nassau/Westchester' WHEN 5 THEN 'Negotiated' WHEN 6 THEN 'Group'
            WHEN 99 THEN '(99) unknown' ELSE 'null' END AS label,
       CAST(count(*) AS BIGINT) AS trips
FROM files GROUP BY 1, 2""",
    "value_counts": w(FILES) + """
SELECT 'VendorID' AS column_name, CAST(VendorID AS VARCHAR) AS value,
       CAST(count(*) AS BIGINT) AS trips FROM files GROUP BY 1, 2
UNION ALL
SELECT 'store_and_fwd_flag', store_and_fwd_flag, CAST(count(*) AS BIGINT) FROM files GROUP BY 1, 2""",
    "red_flags": w(FILES) + f"""
SELECT CAST(count_if(fare_amount <= 0) AS BIGINT) AS fare_le_0,
       CAST(count_if(trip_distance <= 0) AS BIGINT) AS dist_le_0,
       CAST(count_if(total_amount < fare_amount) AS BIGINT) AS total_lt_fare,
       CAST(count_if(tpep_dropoff_datetime <= tpep_pickup_datetime) AS BIGINT) AS dropoff_le_pickup,
       CAST(count_if(passenger_count IS NULL OR passenger_count < 1 OR passenger_count > 6)
            AS BIGINT) AS pax_out_of_range,
       CAST(count_if(date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) > {MAX_DUR})
            AS BIGINT) AS over_max_minutes,
       CAST(count_if(year(tpep_pickup_datetime) <> {YEAR}) AS BIGINT) AS not_trip_year
FROM files""",
    "borough_share": w(FILES, ZONES) + f"""
, g AS (SELECT z.borough, CAST(count(*) AS BIGINT) AS trips
        FROM files t JOIN zones z ON t.PULocationID = z.location_id GROUP BY 1)
SELECT *, {share('trips', 1)} AS pct FROM g""",
    "unknown_geography": w(FILES, ZONES) + """
SELECT z.borough, z.zone_name AS zone, CAST(count(*) AS BIGINT) AS trips
FROM files t JOIN zones z ON t.PULocationID = z.location_id
WHERE t.PULocationID IN (23, 24) GROUP BY 1, 2""",
    "trips_by_hour": w(EVENT_FACT2) + """
SELECT CAST(hour(pickup_datetime) AS INTEGER) AS hour, CAST(count(*) AS BIGINT) AS trips
FROM efct GROUP BY 1""",
    "day_of_week": w(EVENT_FACT2) + f"""
SELECT strftime(pickup_datetime, '%A') AS dow, CAST(count(*) AS BIGINT) AS trips,
       {rha(eavg('fare_amount'))} AS avg_fare
FROM efct WHERE fare_amount > 0 GROUP BY 1""",
    "tipping_by_type": w(FILES) + f"""
SELECT payment_type, CAST(count(*) AS BIGINT) AS trips, {rha(eavg('tip_amount'))} AS avg_tip,
       {rha('100.0::DOUBLE * avg(CASE WHEN tip_amount > 0 THEN 1 ELSE 0 END)', 1)} AS pct_tipped
FROM files WHERE fare_amount > 0 GROUP BY 1""",
    "dedupe_latest": w(RAW) + """
, r AS (
  SELECT l_orderkey, l_linenumber,
         CAST(TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(l_orderkey % 3 AS INTEGER))
              AS TIMESTAMP) AS _loaded_at,
         fare_amount, tip_amount, PULocationID, tpep_pickup_datetime
  FROM raw)
SELECT * FROM r
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY _loaded_at DESC NULLS FIRST, fare_amount DESC NULLS LAST, tip_amount DESC NULLS LAST,
           PULocationID DESC NULLS LAST, tpep_pickup_datetime DESC NULLS LAST) = 1""",
    "incremental_slice": w(RAW) + f"""
SELECT l_orderkey, l_linenumber, tpep_pickup_datetime FROM raw
WHERE tpep_pickup_datetime > (
  SELECT coalesce(max(tpep_pickup_datetime), TIMESTAMP '1900-01-01 00:00:00') FROM raw
  WHERE file_month <= DATE '{SLICE_MONTH}')""",
    "upsert_two_batches": w(RAW, raw_at("b1", LOAD_1, "l_linenumber <= 4"),
                            raw_at("b2", LOAD_2, "l_linenumber >= 3"),
                            stg_of("s1", "b1"), stg_of("s2", "b2", "tip_amount * 2.0::DOUBLE")) + """
SELECT * FROM s1 WHERE trip_id NOT IN (SELECT trip_id FROM s2)
UNION ALL SELECT * FROM s2""",
    "late_month_reference": late_month_sql("pickup_datetime"),
    "late_month_safe": late_month_sql("_loaded_at"),
    "schema_sync": w(RAW, raw_at("b1", LOAD_1, "l_linenumber <= 4"),
                     raw_at("b2", LOAD_2, "l_linenumber >= 3"),
                     stg_of("s1", "b1"), stg_of("s2", "b2")) + """
SELECT * REPLACE (CAST(NULL AS DOUBLE) AS tip_amount) FROM s1
WHERE trip_id NOT IN (SELECT trip_id FROM s2)
UNION ALL SELECT * FROM s2""",
    "touched_partitions": w(RAW, STG) + """
SELECT trip_id, file_month FROM stg
WHERE file_month IN (SELECT DISTINCT file_month FROM raw
                     WHERE file_month IN (DATE '1996-05-01', DATE '1997-02-01'))""",
    "check_suite": checks_sql(),
    "freshness_status": """
WITH m AS (SELECT date_trunc('second', max(ts)) AS newest FROM events),
cases("case", hours) AS (VALUES ('new', 36), ('late', 37), ('edge', 72), ('stale', 73))
SELECT "case", CAST(newest AS TIMESTAMP) AS max_loaded_at, CAST(hours AS DOUBLE) AS age_hours,
       CASE WHEN hours > 72 THEN 'error' WHEN hours > 36 THEN 'warn' ELSE 'pass' END AS status
FROM m, cases
UNION ALL SELECT 'empty', NULL, NULL, 'error'""",
    "month_presence": w(RAW) + f"""
SELECT DATE '{RUN_MONTH}' AS month, CAST(count(*) AS BIGINT) AS rows, count(*) > 0 AS present
FROM raw WHERE file_month = DATE '{RUN_MONTH}'""",
})


INGESTED = f"""
SELECT 'yellow_tripdata_' || strftime(o.o_orderdate, '%Y-%m') || '.parquet' AS source_file,
       CAST(date_trunc('month', o.o_orderdate) AS DATE) AS file_month,
       CASE WHEN strftime(o.o_orderdate, '%Y-%m') < '1998-01' THEN {LOAD_1} ELSE {LOAD_2} END
         AS _loaded_at,
       CAST(count(*) AS BIGINT) AS rows
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY 1, 2, 3"""

ORACLE.update({
    "file_ingest": INGESTED,
    "stream_ingest": INGESTED,
    "csv_dimension": w(ZONES) + " SELECT * FROM zones",
    "historical_clean": w(FILES) + f"""
, d AS (
  SELECT *, CAST(date_diff('second', date_trunc('second', tpep_pickup_datetime),
                           date_trunc('second', tpep_dropoff_datetime)) AS DOUBLE)
              / 60.0::DOUBLE AS trip_duration_minutes
  FROM files)
SELECT *, CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
       CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month
FROM d
WHERE trip_distance > 0 AND fare_amount > 0 AND passenger_count > 0
  AND trip_duration_minutes >= {float(MIN_DUR)} AND trip_duration_minutes <= {float(MAX_DUR)}
  AND year(tpep_pickup_datetime) = {YEAR}""",
})


ORACLE.update({
    "layered_run": w(*FACT_CHAIN, ZONE_PERF) + " SELECT * FROM zone_perf",
    "backfill_month": w(*FACT_CHAIN) + f" SELECT * FROM fct WHERE file_month = DATE '{RUN_MONTH}'",
    "stream_models": w(*FACT_CHAIN) + " SELECT * EXCLUDE (_loaded_at) FROM fct",
})


OVERLAP = (RAW, raw_at("b1", LOAD_1, "l_linenumber <= 4"), raw_at("b2", LOAD_2, "l_linenumber >= 3"),
           stg_of("s1", "b1"), stg_of("s2", "b2", "tip_amount * 2.0::DOUBLE"))
REPLACED = "SELECT * FROM s1 WHERE trip_id NOT IN (SELECT trip_id FROM s2) UNION ALL SELECT * FROM s2"
RUN_ROWS = f"file_month = DATE '{RUN_MONTH}'"

ORACLE.update({
    "fact_trips": w(RAW, ZONES, raw_at("b1", LOAD_1, "true"), raw_at("b2", LOAD_2, "l_linenumber >= 3"),
                    stg_of("s1", "b1"), stg_of("s2", "b2", "tip_amount * 2.0::DOUBLE"))
    + ", stg AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2)," + ENRICHED + "," + FCT
    + " SELECT * FROM fct",
    "stream_replay": w(*FACT_CHAIN) + " SELECT * EXCLUDE (_loaded_at) FROM fct",
    "marts_recovery": f"""
SELECT 'daily' AS mart, CAST(revenue_date AS VARCHAR) AS grain, total_trips AS trips, total_fare AS amount
FROM ({ORACLE['daily_revenue']})
UNION ALL
SELECT 'zone_month', zone_month_key, total_trips, total_revenue FROM ({ORACLE['zone_month_performance']})""",
    "idle_gaps_kept": ORACLE["idle_gaps_fact"],
    "check_counts_kept": "SELECT * FROM (" + checks_sql() + ") WHERE column_name LIKE 'fct_trips.%'",
    "json_fields": """
WITH t AS (SELECT event_id, '{"a": ' || props || ', "b": ["x", ' || event_id || ']}' AS whole FROM events),
cut AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN substring(whole, 1, 9) ELSE whole END AS part FROM t),
r AS (SELECT event_id, CASE WHEN json_valid(part) THEN part END AS j FROM cut)
SELECT event_id, TRY_CAST(json_extract_string(j, '$.a.k') AS INTEGER) AS k,
       json_extract_string(j, '$.a.k') AS k_text, TRY_CAST(json_extract_string(j, '$.b[1]') AS BIGINT) AS id,
       json_extract_string(j, '$.b[0]') AS x, TRY_CAST(json_extract_string(j, '$.b[0]') AS INTEGER) AS no_number,
       TRY_CAST(json_extract_string(j, '$.a.z') AS DOUBLE) AS missing
FROM r""",
    "ingest_same_stamp": f"SELECT * REPLACE ({LOAD_1} AS _loaded_at) FROM ({INGESTED})",
    "ingest_mixed_widths": w(RAW) + f" SELECT * EXCLUDE (l_orderkey, l_linenumber) "
                                    f"REPLACE ({LOAD_1} AS _loaded_at) FROM raw",
    "upsert_disk_overlap": w(*OVERLAP) + REPLACED,
    "full_refresh": w(*OVERLAP) + "SELECT * FROM s2",
    "schema_sync_disk": w(RAW, raw_at("b1", LOAD_1, "true"), raw_at("b2", LOAD_2, RUN_ROWS),
                          raw_at("b3", LOAD_3, f"{RUN_ROWS} AND l_linenumber = 1"),
                          stg_of("s1", "b1"), stg_of("s2", "b2"), stg_of("s3", "b3")) + """
SELECT *, CAST(NULL AS INTEGER) AS extra FROM s1 WHERE trip_id NOT IN (SELECT trip_id FROM s2)
UNION ALL SELECT *, 7 FROM s2 WHERE trip_id NOT IN (SELECT trip_id FROM s3)
UNION ALL SELECT *, 8 FROM s3""",
    "schema_rows": w(RAW) + ", t(column_name, narrow, wide) AS (VALUES " + ", ".join(
        f"('{c}', '{t}', '{'bigint' if c in WIDENED else t}')" for c, t in FILE_TYPES.items()) + f"""),
months AS (SELECT DISTINCT source_file, strftime(file_month, '%Y-%m') AS ym FROM raw)
SELECT column_name, CASE WHEN ym < '1998-01' THEN narrow ELSE wide END AS column_type,
       count(*) AS files, min(source_file) AS first_file, max(source_file) AS last_file
FROM months, t GROUP BY 1, 2""",
    "profile_kept": f"""
SELECT 'nulls' AS part, column_name, null_pct AS place, CAST(null_count AS DOUBLE) AS value
FROM ({ORACLE['null_profile']})
UNION ALL SELECT 'avg_value', column_name, NULL, avg_value FROM ({ORACLE['numeric_summary']})
UNION ALL SELECT 'min_value', column_name, NULL, min_value FROM ({ORACLE['numeric_summary']})
UNION ALL SELECT 'max_value', column_name, NULL, max_value FROM ({ORACLE['numeric_summary']})
UNION ALL SELECT 'quantile', column_name, prob, value FROM ({ORACLE['quantiles']})
UNION ALL SELECT 'histogram', 'trip_distance', bin_lo, CAST(trips AS DOUBLE) FROM ({ORACLE['histogram']})""",
    "gate_findings": 'SELECT "check", column_name, failures FROM (' + checks_sql()
                     + ") WHERE status = 'fail'",
})
