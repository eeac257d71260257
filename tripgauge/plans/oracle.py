"""DuckDB SQL for every SQL-expressible registered query.

Written independently of the Spark code, straight from the operator
definitions: one chain of CTEs over the driver's ``events`` (and
``orders`` / ``lineitem``) views. Doubles are rounded to 6 decimals and
timestamps given as epoch microseconds, exactly as the registered Spark
queries present them.
"""

from __future__ import annotations

# Written out here, not taken from the engine, so that a wrong value on either side shows.
BUCKET_EDGES_KM = (1.609, 4.828, 8.047, 16.093)
BUCKET_LABELS = ('<1mi', '1-3mi', '3-5mi', '5-10mi', '10+mi')
WEEKDAY_LABELS = ('Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday')


def _bucket_case(km: str) -> str:
    parts = [f"WHEN {km} < {edge!r}e0 THEN '{label}'" for edge, label in zip(BUCKET_EDGES_KM, BUCKET_LABELS)]
    return f"CASE {' '.join(parts)} ELSE '{BUCKET_LABELS[-1]}' END"


def _weekday_case(d: str) -> str:
    parts = [f"WHEN {i} THEN '{label}'" for i, label in enumerate(WEEKDAY_LABELS)]
    return f"CASE {d} {' '.join(parts)} END"


BASE = f"""
h0 AS (
  SELECT event_id AS e, user_id AS u, ts, CAST(hour(ts) AS BIGINT) AS hr,
         CAST((event_id*131) % 16 + 1 AS DOUBLE) AS s
  FROM events),
h1 AS (
  SELECT *, CAST((e*3571) % 2001 - 1000 AS DOUBLE) * s / 1e5 AS dy,
            CAST((e*5417) % 2003 - 1001 AS DOUBLE) * s / 1e5 AS dx,
            406e-1 + CAST((e*7919 + u*104729) % 2000 AS DOUBLE) / 1e4 AS plat,
            -7405e-2 + CAST((e*6101 + u*15485863) % 2000 AS DOUBLE) / 1e4 AS plon
  FROM h0),
h2 AS (SELECT *, abs(dy)*111e0 + abs(dx)*84e0 AS km FROM h1),
h3 AS (
  SELECT *, CASE WHEN e % 83 = 0 THEN 0 WHEN e % 79 = 0 THEN 9000
                 ELSE 60 + CAST(floor(km * (90 + 6*(12 - abs(12 - hr)))) AS BIGINT) + (e*2909) % 240 END AS dur
  FROM h2),
raw AS (
  SELECT e AS event_id, ts AS tpep_pickup_datetime,
         CASE WHEN e % 89 = 0 THEN NULL ELSE ts + dur * INTERVAL '1' SECOND END AS tpep_dropoff_datetime,
         CASE WHEN e % 97 = 0 THEN NULL WHEN e % 71 = 0 THEN 95e0 ELSE plat END AS start_lat,
         plon AS start_lon,
         CASE WHEN e % 73 = 0 THEN plat ELSE plat + dy END AS end_lat,
         CASE WHEN e % 73 = 0 THEN plon ELSE plon + dx END AS end_lon,
         km / 1.609e0 AS trip_distance
  FROM h3),
norm AS (
  SELECT event_id, tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
         start_lat AS pickup_latitude, start_lon AS pickup_longitude,
         end_lat AS dropoff_latitude, end_lon AS dropoff_longitude, trip_distance
  FROM raw),
hav AS (
  SELECT *, pow(sin((radians(dropoff_latitude) - radians(pickup_latitude)) / 2), 2)
            + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude))
              * pow(sin((radians(dropoff_longitude) - radians(pickup_longitude)) / 2), 2) AS hav_a
  FROM norm),
measured AS (
  SELECT * EXCLUDE (hav_a),
         date_diff('second', date_trunc('second', pickup_datetime), date_trunc('second', dropoff_datetime)) AS trip_duration_sec,
         6371e0 * (2 * atan2(sqrt(hav_a), sqrt(1 - hav_a))) AS haversine_distance_km
  FROM hav),
labelled AS (
  SELECT *, CASE
    WHEN NOT coalesce(pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL, false) THEN 'missing_datetime'
    WHEN NOT coalesce(trip_duration_sec > 30 AND trip_duration_sec <= 7200, false) THEN 'invalid_duration'
    WHEN NOT coalesce(pickup_latitude IS NOT NULL AND pickup_longitude IS NOT NULL
                      AND dropoff_latitude IS NOT NULL AND dropoff_longitude IS NOT NULL, false) THEN 'missing_coordinates'
    WHEN NOT coalesce(pickup_latitude BETWEEN -90e0 AND 90e0 AND pickup_longitude BETWEEN -180e0 AND 180e0
                      AND dropoff_latitude BETWEEN -90e0 AND 90e0 AND dropoff_longitude BETWEEN -180e0 AND 180e0, false)
      THEN 'invalid_coordinate_range'
    WHEN NOT coalesce(haversine_distance_km IS NOT NULL AND NOT isnan(haversine_distance_km)
                      AND haversine_distance_km >= 1e-1 AND haversine_distance_km <= 100e0, false) THEN 'invalid_distance'
    ELSE 'ok' END AS reject_reason
  FROM measured),
clean AS (
  SELECT * EXCLUDE (reject_reason),
         row_number() OVER (ORDER BY pickup_datetime, pickup_latitude, pickup_longitude, event_id) AS trip_id,
         CAST(hour(pickup_datetime) AS INTEGER) AS hour_of_day,
         CAST(isodow(pickup_datetime) - 1 AS INTEGER) AS day_of_week,
         {_bucket_case('haversine_distance_km')} AS distance_bucket
  FROM labelled WHERE reject_reason = 'ok'),
split AS (SELECT quantile_cont(CAST(epoch_us(pickup_datetime) AS DOUBLE), 0.7) AS split_us FROM clean),
training AS (SELECT c.* FROM clean c, split WHERE CAST(epoch_us(c.pickup_datetime) AS DOUBLE) <= split.split_us),
evaluation AS (SELECT c.* FROM clean c, split WHERE CAST(epoch_us(c.pickup_datetime) AS DOUBLE) > split.split_us),
moving AS (
  SELECT *, haversine_distance_km / NULLIF(trip_duration_sec, 0) * 3600 AS speed_kmh
  FROM training WHERE trip_duration_sec > 0 AND haversine_distance_km > 0),
median_speeds AS (
  SELECT hour_of_day, distance_bucket, quantile_cont(speed_kmh, 0.5) AS median_speed_kmh, count(*) AS trip_count
  FROM moving GROUP BY hour_of_day, distance_bucket HAVING count(*) >= 10),
gspeed AS (SELECT quantile_cont(speed_kmh, 0.5) AS g FROM moving),
eta AS (
  SELECT ev.*, coalesce(ms.median_speed_kmh, gspeed.g) AS estimated_speed_kmh,
         ev.haversine_distance_km / NULLIF(coalesce(ms.median_speed_kmh, gspeed.g) / 3600e0, 0) AS estimated_duration_sec
  FROM evaluation ev
  LEFT JOIN median_speeds ms ON ev.hour_of_day = ms.hour_of_day AND ev.distance_bucket = ms.distance_bucket
  CROSS JOIN gspeed),
errors AS (
  SELECT *, estimated_duration_sec - trip_duration_sec AS error_sec,
         abs(estimated_duration_sec - trip_duration_sec) AS abs_error_sec,
         (estimated_duration_sec - trip_duration_sec) / NULLIF(trip_duration_sec, 0) AS pct_error,
         abs(estimated_duration_sec - trip_duration_sec) / NULLIF(trip_duration_sec, 0) AS abs_pct_error
  FROM eta WHERE estimated_duration_sec IS NOT NULL AND trip_duration_sec > 0),
seg AS (
  SELECT 'overall' AS segment_type, 'all' AS segment_value, abs_error_sec, abs_pct_error FROM errors
  UNION ALL SELECT 'distance_bucket', distance_bucket, abs_error_sec, abs_pct_error FROM errors
  UNION ALL SELECT 'hour_of_day', CAST(hour_of_day AS VARCHAR), abs_error_sec, abs_pct_error FROM errors
  UNION ALL SELECT 'day_of_week', {_weekday_case('day_of_week')}, abs_error_sec, abs_pct_error FROM errors),
metrics AS (
  SELECT segment_type, segment_value, count(*) AS trip_count,
         avg(abs_error_sec) AS mae_sec,
         quantile_cont(abs_error_sec, 0.5) AS medae_sec,
         quantile_cont(abs_error_sec, 0.9) AS p90_abs_error_sec,
         avg(abs_pct_error) AS mae_pct,
         quantile_cont(abs_pct_error, 0.5) AS medae_pct,
         quantile_cont(abs_pct_error, 0.9) AS p90_abs_error_pct,
         avg(CASE WHEN abs_pct_error <= 1e-1 THEN 1e0 ELSE 0e0 END) AS pct_within_10pct,
         avg(CASE WHEN abs_pct_error <= 2e-1 THEN 1e0 ELSE 0e0 END) AS pct_within_20pct
  FROM seg GROUP BY segment_type, segment_value)
"""

US = "epoch_us"


def _with(select: str) -> str:
    return f"WITH {BASE.strip()}\n{select.strip()}\n"


METRIC_SELECT = """SELECT segment_type, segment_value, trip_count, round(mae_sec, 6) AS mae_sec,
  round(medae_sec, 6) AS medae_sec, round(p90_abs_error_sec, 6) AS p90_abs_error_sec,
  round(mae_pct, 6) AS mae_pct, round(medae_pct, 6) AS medae_pct,
  round(p90_abs_error_pct, 6) AS p90_abs_error_pct, round(pct_within_10pct, 6) AS pct_within_10pct,
  round(pct_within_20pct, 6) AS pct_within_20pct FROM metrics"""

NORM_SELECT = """SELECT event_id, epoch_us(pickup_datetime) AS pickup_datetime, epoch_us(dropoff_datetime) AS dropoff_datetime,
  round(pickup_latitude, 6) AS pickup_latitude, round(pickup_longitude, 6) AS pickup_longitude,
  round(dropoff_latitude, 6) AS dropoff_latitude, round(dropoff_longitude, 6) AS dropoff_longitude,
  round(trip_distance, 6) AS trip_distance FROM norm"""

CLEAN_SELECT = """SELECT trip_id, event_id, epoch_us(pickup_datetime) AS pickup_datetime,
  epoch_us(dropoff_datetime) AS dropoff_datetime, trip_duration_sec,
  round(haversine_distance_km, 6) AS haversine_distance_km, hour_of_day, day_of_week, distance_bucket FROM clean"""

HIST_PART = """SELECT '{m}' AS metric, b.bin, round(lo + b.bin * w, 6) AS lo, round(lo + (b.bin + 1) * w, 6) AS hi,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT CAST(range AS BIGINT) AS bin FROM range(50)) b
CROSS JOIN (SELECT lo, (hi - lo) / 50e0 AS w FROM (
    SELECT CASE WHEN min(x) = max(x) THEN min(x) - 5e-1 ELSE min(x) END AS lo,
           CASE WHEN min(x) = max(x) THEN max(x) + 5e-1 ELSE max(x) END AS hi FROM (SELECT {x} AS x FROM errors) WHERE x IS NOT NULL)) mm
LEFT JOIN (
  SELECT least(CAST(floor((x - mm2.lo) / mm2.w) AS BIGINT), 49) AS bin, count(*) AS n
  FROM (SELECT {x} AS x FROM errors) v
  CROSS JOIN (SELECT lo, (hi - lo) / 50e0 AS w FROM (
    SELECT CASE WHEN min(x) = max(x) THEN min(x) - 5e-1 ELSE min(x) END AS lo,
           CASE WHEN min(x) = max(x) THEN max(x) + 5e-1 ELSE max(x) END AS hi FROM (SELECT {x} AS x FROM errors) WHERE x IS NOT NULL)) mm2
  WHERE x IS NOT NULL GROUP BY 1) c ON c.bin = b.bin"""

FEATURES_SELECT = """SELECT trip_id, trip_duration_sec,
  haversine_distance_km, CAST(hour_of_day AS DOUBLE) AS hour_of_day, CAST(day_of_week AS DOUBLE) AS day_of_week,
  sin(2 * pi() * hour_of_day / 24) AS hour_sin, cos(2 * pi() * hour_of_day / 24) AS hour_cos,
  sin(2 * pi() * day_of_week / 7) AS day_sin, cos(2 * pi() * day_of_week / 7) AS day_cos,
  CASE WHEN distance_bucket = '<1mi' THEN 1e0 ELSE 0e0 END AS "dist_<1mi",
  CASE WHEN distance_bucket = '1-3mi' THEN 1e0 ELSE 0e0 END AS "dist_1-3mi",
  CASE WHEN distance_bucket = '3-5mi' THEN 1e0 ELSE 0e0 END AS "dist_3-5mi",
  CASE WHEN distance_bucket = '5-10mi' THEN 1e0 ELSE 0e0 END AS "dist_5-10mi",
  CASE WHEN distance_bucket = '10+mi' THEN 1e0 ELSE 0e0 END AS "dist_10+mi",
  (pickup_latitude - 40.7e0) / 0.5e0 AS pickup_lat_norm, (pickup_longitude - -74.0e0) / 0.5e0 AS pickup_lon_norm,
  (dropoff_latitude - 40.7e0) / 0.5e0 AS dropoff_lat_norm, (dropoff_longitude - -74.0e0) / 0.5e0 AS dropoff_lon_norm
FROM {src}"""

FEATURE_NAMES = ["haversine_distance_km", "hour_of_day", "day_of_week", "hour_sin", "hour_cos", "day_sin", "day_cos",
                 "dist_<1mi", "dist_1-3mi", "dist_3-5mi", "dist_5-10mi", "dist_10+mi",
                 "pickup_lat_norm", "pickup_lon_norm", "dropoff_lat_norm", "dropoff_lon_norm"]


def _round_cols(names, src_alias=""):
    return ", ".join(f'round({src_alias}"{n}", 6) AS "{n}"' for n in names)


def _scaler_stats() -> str:
    parts = [f"""SELECT {i} AS idx, '{n}' AS feature, avg("{n}") AS mean, stddev_pop("{n}") AS std FROM feats"""
             for i, n in enumerate(FEATURE_NAMES)]
    return " UNION ALL ".join(parts)


def _standardized() -> str:
    cols = ", ".join(
        f"""round(("{n}" - (SELECT mean FROM st WHERE feature = '{n}')) / (SELECT scale FROM st WHERE feature = '{n}'), 6) AS "{n}" """
        for n in FEATURE_NAMES)
    return cols


def _audit(label: str, lsrc: str, lkeys: str, rsrc: str, rkeys: str) -> str:
    return f"""SELECT '{label}' AS audit,
  CAST(coalesce(sum(coalesce(l, 0)), 0) AS BIGINT) AS left_rows, CAST(coalesce(sum(coalesce(r, 0)), 0) AS BIGINT) AS right_rows,
  CAST(count(l) AS BIGINT) AS left_keys, CAST(count(r) AS BIGINT) AS right_keys,
  CAST(count(CASE WHEN coalesce(l, 0) > 1 THEN 1 END) AS BIGINT) AS left_dup_keys,
  CAST(count(CASE WHEN coalesce(r, 0) > 1 THEN 1 END) AS BIGINT) AS right_dup_keys,
  CAST(count(CASE WHEN coalesce(l, 0) > 0 AND coalesce(r, 0) > 0 THEN 1 END) AS BIGINT) AS matched_keys,
  CAST(coalesce(sum(coalesce(l, 0) * coalesce(r, 0)), 0) AS BIGINT) AS join_rows,
  CAST(coalesce(max(coalesce(l, 0) * coalesce(r, 0)), 0) AS BIGINT) AS max_key_rows,
  round(CASE WHEN sum(coalesce(l, 0)) > 0 THEN sum(coalesce(l, 0) * coalesce(r, 0)) / sum(coalesce(l, 0)) END, 6) AS fanout_ratio,
  count(CASE WHEN coalesce(l, 0) > 1 THEN 1 END) = 0 AND count(CASE WHEN coalesce(r, 0) > 1 THEN 1 END) = 0 AS keys_unique
FROM (SELECT {lkeys} AS k, count(*) AS l FROM {lsrc} WHERE {lkeys} IS NOT NULL GROUP BY 1) lc
FULL OUTER JOIN (SELECT {rkeys} AS k, count(*) AS r FROM {rsrc} WHERE {rkeys} IS NOT NULL GROUP BY 1) rc USING (k)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["normalize_columns"] = _with(NORM_SELECT)
    q["scan_trips_csv"] = q["normalize_columns"]
    q["trip_duration"] = _with("SELECT event_id, trip_duration_sec FROM measured")
    q["haversine_km"] = _with("SELECT event_id, round(haversine_distance_km, 6) AS haversine_distance_km FROM measured")
    q["reject_reason"] = _with("SELECT event_id, reject_reason FROM labelled")
    q["filter_stats"] = _with("""
SELECT CAST(d.step AS INTEGER) AS step, d.reject_reason, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (VALUES (0, 'missing_datetime'), (1, 'invalid_duration'), (2, 'missing_coordinates'),
             (3, 'invalid_coordinate_range'), (4, 'invalid_distance'), (5, 'ok')) d(step, reject_reason)
LEFT JOIN (SELECT reject_reason, count(*) AS n FROM labelled GROUP BY 1) c USING (reject_reason)""")
    q["retention_summary"] = _with("""
SELECT count(*) AS initial_count, count(CASE WHEN reject_reason = 'ok' THEN 1 END) AS final_count,
  count(*) - count(CASE WHEN reject_reason = 'ok' THEN 1 END) AS filtered_out,
  round(CASE WHEN count(*) > 0 THEN count(CASE WHEN reject_reason = 'ok' THEN 1 END) / count(*) ELSE 0e0 END, 6) AS retention_rate
FROM labelled""")
    q["trips_clean"] = _with(CLEAN_SELECT)
    q["write_trips_table"] = q["trips_clean"]
    q["fill_derived"] = _with("SELECT trip_id, hour_of_day, day_of_week, distance_bucket FROM clean")
    q["weekday_numbering"] = _with(f"""
SELECT trip_id, day_of_week, CAST(dayofweek(pickup_datetime) AS INTEGER) AS day_of_week_reference,
  {_weekday_case('day_of_week')} AS weekday_label,
  {_weekday_case('CAST(dayofweek(pickup_datetime) AS INTEGER)')} AS weekday_label_reference FROM clean""")
    q["trip_speed_kmh"] = _with(
        "SELECT trip_id, round(haversine_distance_km / NULLIF(trip_duration_sec, 0) * 3600, 6) AS speed_kmh FROM clean")
    q["temporal_split"] = _with(
        "SELECT trip_id, CASE WHEN CAST(epoch_us(pickup_datetime) AS DOUBLE) <= split_us THEN 'training' ELSE 'evaluation' END AS split FROM clean, split")
    q["dataset_summary"] = _with("""
SELECT 'Total trips' AS metric, CAST(count(*) AS VARCHAR) AS value FROM clean
UNION ALL SELECT 'Training trips', CAST(count(*) AS VARCHAR) FROM training
UNION ALL SELECT 'Evaluation trips', CAST(count(*) AS VARCHAR) FROM evaluation""")
    q["model_input"] = _with("""
SELECT trip_id, trip_duration_sec, round(haversine_distance_km, 6) AS haversine_distance_km, hour_of_day, day_of_week,
  distance_bucket FROM training
WHERE trip_duration_sec > 0 AND haversine_distance_km > 0 AND hour_of_day IS NOT NULL
  AND day_of_week IS NOT NULL AND distance_bucket IS NOT NULL""")
    q["median_speeds"] = _with(
        "SELECT hour_of_day, distance_bucket, round(median_speed_kmh, 6) AS median_speed_kmh, trip_count FROM median_speeds")
    q["global_speed_fallback"] = _with("SELECT round(g, 6) AS global_median_speed_kmh FROM gspeed")
    q["median_speed_eta"] = _with("""
SELECT trip_id, round(estimated_speed_kmh, 6) AS estimated_speed_kmh,
  round(estimated_duration_sec, 6) AS estimated_duration_sec FROM eta""")
    q["eta_errors"] = _with("""
SELECT trip_id, trip_duration_sec, round(estimated_duration_sec, 6) AS estimated_duration_sec,
  round(error_sec, 6) AS error_sec, round(abs_error_sec, 6) AS abs_error_sec,
  round(pct_error, 6) AS pct_error, round(abs_pct_error, 6) AS abs_pct_error FROM errors""")
    q["metrics_combined"] = _with(METRIC_SELECT)
    q["write_metrics_csv"] = q["metrics_combined"]
    q["metrics_overall"] = _with(METRIC_SELECT + " WHERE segment_type = 'overall'")
    q["metrics_by_distance"] = _with(METRIC_SELECT + " WHERE segment_type = 'distance_bucket'")
    q["metrics_by_hour"] = _with(METRIC_SELECT + " WHERE segment_type = 'hour_of_day'")
    q["metrics_by_day_of_week"] = _with(METRIC_SELECT + " WHERE segment_type = 'day_of_week'")
    for seg in ("distance_bucket", "hour_of_day"):
        key = "error_by_distance" if seg == "distance_bucket" else "error_by_hour"
        q[key] = _with(f"""
SELECT segment_value AS {seg}, round(medae_sec, 6) AS medae_sec, round(p90_abs_error_sec, 6) AS p90_sec,
  round(medae_pct, 6) AS medae_pct, round(p90_abs_error_pct, 6) AS p90_pct, trip_count
FROM metrics WHERE segment_type = '{seg}'""")
    q["error_histogram"] = _with(HIST_PART.format(m="abs_error_sec", x="abs_error_sec") + "\nUNION ALL\n"
                                 + HIST_PART.format(m="abs_pct_error_x100", x="abs_pct_error * 100e0"))
    q["histogram_markers"] = _with("""
SELECT 'abs_error_sec' AS metric, round(quantile_cont(abs_error_sec, 0.5), 6) AS median,
  round(quantile_cont(abs_error_sec, 0.9), 6) AS p90 FROM errors
UNION ALL SELECT 'abs_pct_error_x100', round(quantile_cont(abs_pct_error, 0.5) * 100e0, 6),
  round(quantile_cont(abs_pct_error, 0.9) * 100e0, 6) FROM errors""")
    q["calibration_bins"] = _with("""
SELECT b.bin, CAST(coalesce(c.n, 0) AS BIGINT) AS n, round(c.mean_actual, 6) AS mean_actual,
  round(c.mean_estimated, 6) AS mean_estimated
FROM (SELECT CAST(range AS BIGINT) AS bin FROM range(19)) b
LEFT JOIN (
  SELECT least(CAST(ceil(CAST(trip_duration_sec AS DOUBLE) / (q / 19e0)) AS BIGINT) - 1, 18) AS bin, count(*) AS n,
         avg(CAST(trip_duration_sec AS DOUBLE)) AS mean_actual, avg(estimated_duration_sec) AS mean_estimated
  FROM errors, (SELECT quantile_cont(CAST(trip_duration_sec AS DOUBLE), 0.95) AS q FROM errors) qq
  WHERE trip_duration_sec > 0 AND trip_duration_sec <= q GROUP BY 1) c ON c.bin = b.bin""")
    q["overall_insight"] = _with("""
SELECT round(medae_sec, 6) AS median_abs_error_sec, round(medae_pct * 100, 6) AS median_abs_error_pct,
  round(p90_abs_error_sec, 6) AS p90_abs_error_sec, round(p90_abs_error_pct * 100, 6) AS p90_abs_error_pct,
  round(pct_within_10pct * 100, 6) AS share_within_10pct FROM metrics WHERE segment_type = 'overall'""")
    bucket_rank = "CASE segment_value " + " ".join(
        f"WHEN '{b}' THEN {i}" for i, b in enumerate(BUCKET_LABELS, start=1)) + " END"
    q["best_worst_segment"] = _with(f"""
SELECT segment_type,
  max(CASE WHEN rb = 1 THEN segment_value END) AS best_segment, round(min(medae_pct), 6) AS best_medae_pct,
  max(CASE WHEN rw = 1 THEN segment_value END) AS worst_segment, round(max(medae_pct), 6) AS worst_medae_pct
FROM (
  SELECT *, row_number() OVER (PARTITION BY segment_type ORDER BY medae_pct, rk) AS rb,
            row_number() OVER (PARTITION BY segment_type ORDER BY medae_pct DESC, rk) AS rw
  FROM (SELECT *, CASE WHEN segment_type = 'distance_bucket' THEN {bucket_rank}
                       ELSE CAST(segment_value AS INTEGER) END AS rk
        FROM metrics WHERE segment_type IN ('distance_bucket', 'hour_of_day')))
GROUP BY segment_type""")
    q["bias_detection"] = _with("""
SELECT round(m, 6) AS mean_error_sec, round(abs(m), 6) AS abs_mean_error_sec,
  CASE WHEN abs(m) > 5e0 THEN CASE WHEN m > 0 THEN 'overestimate' ELSE 'underestimate' END ELSE 'none' END AS direction
FROM (SELECT avg(error_sec) AS m FROM errors)""")
    q["predictions_join"] = _with("""
SELECT trip_id, trip_duration_sec, round(estimated_duration_sec, 6) AS estimated_duration_sec,
  round(abs_error_sec, 6) AS abs_error_sec FROM errors""")
    q["dedupe_predictions"] = _with("""
SELECT trip_id, 2 AS version, round(estimated_duration_sec, 6) AS estimated_duration_sec FROM eta""")
    q["clamp_prediction"] = _with("""
SELECT trip_id, round(estimated_duration_sec - 300e0, 6) AS raw_prediction,
  round(CASE WHEN estimated_duration_sec - 300e0 IS NULL THEN NULL
             ELSE greatest(estimated_duration_sec - 300e0, 30e0) END, 6) AS estimated_duration_sec FROM eta""")
    q["join_fanout_audit"] = _with(
        _audit("trip_id", "evaluation", "trip_id", "eta", "trip_id") + "\nUNION ALL\n"
        + _audit("pickup_minute", "evaluation", "date_trunc('minute', pickup_datetime)", "eta",
                 "date_trunc('minute', pickup_datetime)") + "\nUNION ALL\n"
        + _audit("o_orderkey", "orders", "o_orderkey", "lineitem", "l_orderkey"))
    q["trip_features"] = _with(f"""
SELECT trip_id, trip_duration_sec, {_round_cols(FEATURE_NAMES)} FROM ({FEATURES_SELECT.format(src='clean')})""")
    q["scaler_fit"] = f"""WITH {BASE.strip()},
feats AS ({FEATURES_SELECT.format(src='training')}),
st AS ({_scaler_stats()})
SELECT CAST(idx AS INTEGER) AS idx, feature, round(mean, 6) AS mean, round(std, 6) AS std,
  round(CASE WHEN std = 0 THEN 1e0 ELSE std END, 6) AS scale FROM st
"""
    q["standardize"] = f"""WITH {BASE.strip()},
feats AS ({FEATURES_SELECT.format(src='training')}),
st0 AS ({_scaler_stats()}),
st AS (SELECT feature, mean, CASE WHEN std = 0 THEN 1e0 ELSE std END AS scale FROM st0)
SELECT trip_id, {_standardized()} FROM feats
"""
    q["temporal_validation_split"] = _with("""
SELECT trip_id, (rn - 1) >= CAST(floor(n * (1 - 0.2e0)) AS BIGINT) AS is_val
FROM (SELECT trip_id, row_number() OVER (ORDER BY trip_id) AS rn, count(*) OVER () AS n FROM training
      WHERE trip_duration_sec > 0 AND haversine_distance_km > 0 AND hour_of_day IS NOT NULL
        AND day_of_week IS NOT NULL AND distance_bucket IS NOT NULL)""")
    q["sample_trips"] = _with("""
SELECT trip_id, trip_duration_sec, round(haversine_distance_km, 6) AS haversine_distance_km
FROM clean ORDER BY (trip_id * 2654435761) % 1000003, trip_id LIMIT 1000""")
    # Stored after two loads: even events first, then odd ones, numbered on.
    q["append_load"] = _with("""
SELECT event_id, trip_id, CASE WHEN CAST(epoch_us(pickup_datetime) AS DOUBLE) <= split_us THEN 'training' ELSE 'evaluation' END AS split
FROM (SELECT event_id, pickup_datetime,
        row_number() OVER (ORDER BY event_id % 2, pickup_datetime, pickup_latitude, pickup_longitude, event_id) AS trip_id FROM clean) c, split""")
    q["replace_interrupted"] = _with("""
SELECT event_id, row_number() OVER (ORDER BY pickup_datetime, pickup_latitude, pickup_longitude, event_id) AS trip_id FROM clean WHERE event_id % 2 = 0""")
    q["append_replayed"] = _with(
        "SELECT event_id, trip_id, CASE WHEN CAST(epoch_us(pickup_datetime) AS DOUBLE) <= split_us THEN 'training' ELSE 'evaluation' END AS split FROM clean, split")
    q["append_in_pickup_order"] = q["trips_clean"]
    q["metrics_after_append"] = q["metrics_combined"]
    q["verify_content"] = _with("""
SELECT t.name AS copy, n.n AS n_rows, t.ok AS accepted FROM (VALUES ('same', true), ('swapped', false), ('doubled', false)) t(name, ok), (SELECT count(*) AS n FROM clean) n""")
    q["write_batched"] = q["trips_clean"]
    q["first_n"] = "SELECT event_id, event_type FROM events LIMIT 5000"
    q["model_vs_baseline_speed"] = _with(METRIC_SELECT.replace("SELECT segment_type", "SELECT 'median_speed' AS method, segment_type", 1))
    q["predictions_join_bucketed"] = q["predictions_join"]
    q["join_worst_keys"] = _with("""
, pairs AS (
  SELECT 'pickup_minute' AS audit, a.k AS key, a.n AS l, b.n AS r
  FROM (SELECT epoch_us(date_trunc('minute', pickup_datetime)) AS k, count(*) AS n FROM evaluation GROUP BY 1) a
  JOIN (SELECT epoch_us(date_trunc('minute', pickup_datetime)) AS k, count(*) AS n FROM eta GROUP BY 1) b ON a.k = b.k
  UNION ALL SELECT 'o_orderkey', a.k, a.n, b.n FROM (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY 1) a
  JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1) b ON a.k = b.k
  UNION ALL SELECT 'user_id', user_id, count(*), count(*) FROM events WHERE user_id IS NOT NULL GROUP BY user_id),
placed AS (SELECT audit, key, l AS left_rows, r AS right_rows, CAST(l * r AS BIGINT) AS join_rows, row_number() OVER (PARTITION BY audit ORDER BY l * r DESC, key) AS place FROM pairs)
SELECT audit, key, left_rows, right_rows, join_rows, place FROM placed WHERE place <= 10""")
    q["scan_trips_csv_mixed"] = q["normalize_columns"]
    q["model_input_evaluation"] = q["model_input"].replace("FROM training", "FROM evaluation")
    q["bbox_filter"] = _with("""
SELECT event_id, CASE WHEN reject_reason = 'ok' AND NOT (pickup_latitude BETWEEN 404e-1 AND 409e-1 AND pickup_longitude BETWEEN -743e-1 AND -737e-1
    AND dropoff_latitude BETWEEN 404e-1 AND 409e-1 AND dropoff_longitude BETWEEN -743e-1 AND -737e-1) THEN 'outside_bbox' ELSE reject_reason END AS reject_reason
FROM labelled""")
    q["fill_derived_partial"] = _with("""
SELECT trip_id, CASE WHEN trip_id % 3 = 1 THEN 99 ELSE hour_of_day END AS hour_of_day, day_of_week, distance_bucket FROM clean""")
    q["write_predictions"] = _with("""
SELECT trip_id, round(estimated_duration_sec + 2, 6) AS estimated_duration_sec FROM eta""")
    q["metrics_order"] = _with(f"""
SELECT segment_type, segment_value, row_number() OVER (ORDER BY
  CASE segment_type WHEN 'overall' THEN 0 WHEN 'distance_bucket' THEN 1 WHEN 'hour_of_day' THEN 2 ELSE 3 END,
  CASE segment_type WHEN 'distance_bucket' THEN {bucket_rank} WHEN 'hour_of_day' THEN CAST(segment_value AS INTEGER)
    WHEN 'day_of_week' THEN list_position({list(WEEKDAY_LABELS)!r}, segment_value) END) AS place FROM metrics""")
    q["metrics_csv_tables"] = _with("""
SELECT t.name AS table_name, segment_type, segment_value, trip_count, round(medae_sec, 6) AS medae_sec
FROM metrics JOIN (VALUES ('metrics_overall', 'overall'), ('metrics_by_distance', 'distance_bucket'), ('metrics_by_hour', 'hour_of_day'),
  ('metrics_by_day_of_week', 'day_of_week'), ('metrics_combined', NULL)) t(name, kind) ON t.kind IS NULL OR t.kind = segment_type""")
    q["views_sql"] = _with("""
SELECT hour_of_day, count(*) AS trips, round(avg(abs_error_sec), 6) AS mae_sec FROM errors GROUP BY hour_of_day""")
    q["segment_metrics_custom"] = _with("""
SELECT segment_type, segment_value, count(*) AS trip_count, round(avg(abs_error_sec), 6) AS mae_sec,
  round(quantile_cont(abs_error_sec, 0.5), 6) AS medae_sec, round(quantile_cont(abs_pct_error, 0.9), 6) AS p90_abs_error_pct
FROM (SELECT 'overall' AS segment_type, 'all' AS segment_value, * FROM errors
      UNION ALL SELECT 'residue', CAST(trip_id % 701 AS VARCHAR), * FROM errors
      UNION ALL SELECT 'long', CASE WHEN trip_duration_sec > 600 THEN 'yes' END, * FROM errors) GROUP BY 1, 2""")
    q["model_facts"] = _with("""
SELECT count(*) AS n_rows, true AS at_least_30_sec, true AS beats_training_median, true AS reload_equal FROM evaluation""")
    q["stream_clean_trips"] = _with("""
SELECT event_id, epoch_us(pickup_datetime) AS pickup_datetime, trip_duration_sec,
  round(haversine_distance_km, 6) AS haversine_distance_km, CAST(hour(pickup_datetime) AS INTEGER) AS hour_of_day,
  CAST(isodow(pickup_datetime) - 1 AS INTEGER) AS day_of_week, """ + _bucket_case("haversine_distance_km") + """ AS distance_bucket
FROM labelled WHERE reject_reason = 'ok'""")
    q["stream_reject_counts"] = _with("SELECT reject_reason, count(*) AS n FROM labelled GROUP BY reject_reason")
    return q
