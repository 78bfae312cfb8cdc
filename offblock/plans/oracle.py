"""Oracle SQL (DuckDB) for the registered queries, written independently of the
Spark code: the same adapter views as CTEs over the raw tables, then plain SQL.
"""

from __future__ import annotations

from offblock.constants import WEATHER_PATTERNS

FLIGHTS = """
flights AS (
  SELECT event_id AS flight_id,
         date_trunc('second', ts) AS aobt,
         event_id * 37 % 1800 AS lag_s,
         CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(value * 100 AS DOUBLE) END AS taxi,
         concat('STAND_', CAST(user_id % 26 AS VARCHAR)) AS stand,
         concat('RUNWAY_', CAST(event_id % 4 + 1 AS VARCHAR)) AS runway,
         concat(CASE event_id % 6 WHEN 0 THEN 'NJE' WHEN 1 THEN 'VJT' WHEN 2 THEN 'PVT'
                                  WHEN 3 THEN 'SIG' WHEN 4 THEN 'BAW' ELSE 'af' END,
                CAST(event_id AS VARCHAR)) AS flight_no,
         CASE WHEN event_id % 5 = 0 THEN 'A109' WHEN event_id % 5 = 1 THEN '407'
              WHEN event_id % 5 = 2 THEN NULL ELSE 'A320' END AS model,
         event_id % 3 + 2 AS engines,
         CAST(event_id % 40 AS DOUBLE) + 20.0 AS ac_length
  FROM events
)"""

WEATHER = """
weather AS (
  SELECT flight_id, model, aobt, lag_s, taxi,
         CASE WHEN flight_id % 11 = 0 THEN 'nan' WHEN flight_id % 13 = 0 THEN NULL
              WHEN flight_id % 2 = 0 THEN 'Clear' ELSE 'Rain' END AS summary,
         CASE WHEN flight_id % 7 = 0 THEN NULL ELSE CAST(flight_id * 17 % 41 AS DOUBLE) / 2 - 5 END AS temperature,
         c.copy_no
  FROM flights JOIN (SELECT 0 AS copy_no UNION ALL SELECT 1 AS copy_no) c
    ON c.copy_no = 0 OR flights.flight_id % 50 = 0
  WHERE flight_id % 10 <> 3
)"""

FL_WX = """
fl_wx AS (
  SELECT CAST(f.flight_id AS VARCHAR) AS flight_id, coalesce(f.model, 'nan') AS model, f.taxi,
         w.summary, w.temperature, w.copy_no
  FROM flights f LEFT JOIN weather w
    ON CAST(f.flight_id AS VARCHAR) = CAST(w.flight_id AS VARCHAR)
   AND coalesce(f.model, 'nan') = coalesce(w.model, 'nan')
)"""

ID_RX = "'^([A-Za-z]+)_([0-9]+)'"


def _bump(c: str) -> str:
    return (f"CASE WHEN regexp_matches({c}, {ID_RX}) THEN concat(upper(regexp_extract({c}, {ID_RX}, 1)), '_', "
            f"CAST(CAST(regexp_extract({c}, {ID_RX}, 2) AS DECIMAL(38,0)) + 1 AS VARCHAR)) ELSE {c} END")


GEO = f"""
geo AS (
  SELECT {_bump("concat('Runway_', CAST(r_regionkey AS VARCHAR))")} AS runway,
         {_bump("concat('Stand_', CAST(n_nationkey AS VARCHAR))")} AS stand,
         CAST(r_regionkey AS DOUBLE) * 7.5 - 10.0 AS Lat_runway,
         CAST(r_regionkey AS DOUBLE) * 11.0 - 20.0 AS Lng_runway,
         CAST(n_nationkey AS DOUBLE) * 1.3 - 15.0 AS Lat_stand,
         CAST(n_nationkey AS DOUBLE) * 2.1 - 25.0 AS Lng_stand
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

KEPT = """
kept AS (SELECT * FROM flights WHERE taxi > 0 AND taxi < 7200)"""

IMPACTS = """
impacts AS (
  SELECT flight_id, stand, runway, ac_length, engines, taxi,
         taxi * 0.9 + 30.0 AS prediction,
         CAST(flight_id % 17 AS DOUBLE) * 1.5 - 12.0 AS Weather,
         CAST(lag_s AS DOUBLE) / 10.0 - 90.0 AS Traffic,
         CAST(engines AS DOUBLE) * 2.5 - 5.0 AS Distance,
         ac_length - 40.0 AS Aircraft
  FROM flights
)"""


def _hav(lat1, lng1, lat2, lng2) -> str:
    a = (f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
         f"* pow(sin(radians({lng2} - {lng1}) / 2), 2)")
    return f"(6371000.0 * (2.0 * atan2(sqrt({a}), sqrt(1.0 - ({a})))))"


def _logd(d: str) -> str:
    return f"(CASE WHEN {d} = 0 THEN CAST('-inf' AS DOUBLE) ELSE ln({d}) END)"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


F_ = _with(FLIGHTS)
FW = _with(FLIGHTS, WEATHER)
FWJ = _with(FLIGHTS, WEATHER, FL_WX)
FK = _with(FLIGHTS, KEPT)
FG = _with(FLIGHTS, GEO)
FI = _with(FLIGHTS, IMPACTS)

MDY = "'%-m/%-d/%Y %-H:%M'"


def _dist_sql(source: str, cols: str) -> str:
    d = _hav("r.Lat_runway", "r.Lng_runway", "s.Lat_stand", "s.Lng_stand")
    return f"""{FG}, rw AS (SELECT DISTINCT runway, Lat_runway, Lng_runway FROM geo),
st AS (SELECT DISTINCT stand, Lat_stand, Lng_stand FROM geo),
src AS ({source})
SELECT {cols}, round({d}, 3) AS distance, round({_logd(d)}, 6) AS log_distance
FROM src LEFT JOIN rw r ON src.runway = r.runway LEFT JOIN st s ON src.stand = s.stand"""


SQL: dict[str, str] = {
    "r01_scan_csv": F_ + "SELECT flight_id, taxi, stand, model FROM flights",
    "r02_scan_by_suffix": F_ + "SELECT flight_id, taxi, stand, model FROM flights",
    "r03_scan_parquet": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders",
    "r04_sink_parquet": F_ + "SELECT flight_id, aobt, taxi, stand, runway FROM flights",
    "r05_sink_csv": F_ + "SELECT flight_id, taxi, runway FROM flights",
    "r07_stringify_text": F_ + "SELECT flight_id, coalesce(model, 'nan') AS model, coalesce(flight_no, 'nan') AS flight_no FROM flights",
    "r08_rename_ci": F_ + "SELECT flight_id, runway, stand FROM flights",
    "r09_rename": FG + "SELECT runway, Lat_runway AS lat, Lng_runway AS lng FROM geo",
    "r10_drop_if_exists": FW + "SELECT flight_id, model, summary, temperature, copy_no FROM weather",
    "r11_cast_keys_to_text": FW + "SELECT CAST(flight_id AS VARCHAR) AS flight_id, coalesce(model, 'nan') AS model, copy_no FROM weather",
    "r12_conform_to_training": F_ + "SELECT flight_id, taxi, 0 AS summary_Snow, engines, 0 AS missing_feature FROM flights",
    "r13_split_features_label": F_ + "SELECT flight_id, taxi AS label, lag_s, engines, ac_length FROM flights",
    "r14_route_dataset": F_ + "SELECT flight_id, taxi FROM flights WHERE taxi IS NOT NULL",
    "r15_dashboard_projection": FI + """SELECT flight_id,
  concat('STAND_', CAST(CAST(regexp_extract(stand, '([0-9]+)', 1) AS INTEGER) AS VARCHAR)) AS "Stand",
  concat('RUNWAY_', CAST(CAST(regexp_extract(runway, '([0-9]+)', 1) AS INTEGER) AS VARCHAR)) AS "Runway",
  ac_length AS "Aircraft Length (m)", CAST(engines AS INTEGER) AS "No. Engines",
  CAST(trunc(taxi) AS INTEGER) AS "Actual Taxi Time (s)",
  round_even(prediction, 1) AS "Predicted Taxi Time (s)",
  round_even(Weather, 1) AS "Weather", round_even(Traffic, 1) AS "Traffic",
  round_even(Distance, 1) AS "Distance", round_even(Aircraft, 1) AS "Aircraft"
FROM impacts""",
    "r16_filter_taxi_range": FK + "SELECT flight_id, taxi FROM kept",
    "r17_filter_audit": F_ + "SELECT count(*) AS rows_before, count(*) FILTER (WHERE taxi > 0 AND taxi < 7200) AS rows_after FROM flights",
    "r18_flag_private": F_ + """SELECT flight_id, flight_no,
  CASE WHEN regexp_extract(flight_no, '^([A-Z]{2,3})', 1) IN ('NJE', 'VJT', 'PVT', 'SIG') THEN 1 ELSE 0 END AS private_flight
FROM flights""",
    "r19_flag_helicopter": F_ + """SELECT flight_id, model,
  CASE WHEN model IN ('A109', 'AW139', 'S-76', '407', '214 ST', 'EC 120', 'EC 135T', 'EC 155B', 'SA 365 DAUPHIN 2',
                      'AEROSPATIALE AS355 ECUREUIL 2 (TWIN SQ.)', 'AS 350 ECUREUIL (SQUIRREL)', 'Helicopter')
       THEN 1 ELSE 0 END AS helicopter
FROM flights""",
    "r20_cross_distances": _dist_sql("SELECT DISTINCT runway, stand FROM flights", "src.runway, src.stand").replace(
        "FROM src LEFT JOIN rw r ON src.runway = r.runway LEFT JOIN st s ON src.stand = s.stand",
        "FROM src JOIN rw r ON src.runway = r.runway JOIN st s ON src.stand = s.stand"),
    "r21_join_distance": _dist_sql("SELECT flight_id, runway, stand FROM flights", "src.flight_id, src.runway, src.stand"),
    "r22_join_weather": FWJ + "SELECT flight_id, copy_no, summary, temperature FROM fl_wx",
    "r23_band_join_traffic": FK + """, s AS (SELECT CAST(epoch(aobt) AS BIGINT) AS t, count(*) AS c FROM kept GROUP BY 1)
SELECT t AS t_sec,
  CAST(sum(c) OVER (ORDER BY t RANGE BETWEEN 1800 PRECEDING AND 1800 FOLLOWING) - 1 AS BIGINT) AS planes_30min,
  CAST(sum(c) OVER (ORDER BY t RANGE BETWEEN 600 PRECEDING AND 600 FOLLOWING) - 1 AS BIGINT) AS planes_10min
FROM s""",
    "r24_lookup_default": F_ + """SELECT flight_id, runway,
  CASE runway WHEN 'RUNWAY_1' THEN 14 WHEN 'RUNWAY_2' THEN 17 WHEN 'RUNWAY_3' THEN 19 WHEN 'RUNWAY_4' THEN 21 ELSE 18 END AS base_minutes
FROM flights""",
    "r25_pair_names_values": F_ + """SELECT flight_id, 'lag_s' AS feature, CAST(lag_s AS DOUBLE) AS value FROM flights
UNION ALL SELECT flight_id, 'engines', CAST(engines AS DOUBLE) FROM flights
UNION ALL SELECT flight_id, 'ac_length', ac_length FROM flights""",
    "r26_distinct_points": FG + """SELECT DISTINCT 'runway' AS kind, runway AS name, Lat_runway AS lat, Lng_runway AS lng FROM geo
UNION ALL SELECT DISTINCT 'stand' AS kind, stand AS name, Lat_stand AS lat, Lng_stand AS lng FROM geo""",
    "r27_learn_medians": FWJ + "SELECT median(temperature) AS temperature, median(taxi) AS taxi FROM fl_wx",
    "r28_missing_profile": FWJ + """SELECT count(*) FILTER (WHERE flight_id IS NULL) AS flight_id,
  count(*) FILTER (WHERE summary IS NULL) AS summary, count(*) FILTER (WHERE temperature IS NULL) AS temperature,
  count(*) FILTER (WHERE taxi IS NULL) AS taxi, count(*) FILTER (WHERE copy_no IS NULL) AS copy_no FROM fl_wx""",
    "r29_regression_metrics": F_ + """, p AS (SELECT taxi AS y, 500.0 + CAST(lag_s AS DOUBLE) / 3.0 + CAST(engines AS DOUBLE) * 40.0 AS yhat
  FROM flights WHERE taxi IS NOT NULL)
SELECT round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse,
  round(avg(abs(y - yhat) / greatest(abs(y), 2.220446049250313e-16)), 6) AS mape,
  round(avg(abs(y - yhat)), 6) AS mae, round(stddev_pop(y - yhat), 6) AS std FROM p""",
    "r30_best_run": """WITH r AS (SELECT concat('run_', CAST(o_orderkey AS VARCHAR)) AS run_id,
  o_orderdate + to_seconds(o_orderkey) AS started_at,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 97 AS DOUBLE) END AS mae FROM orders)
SELECT run_id, started_at, mae FROM r WHERE mae IS NOT NULL ORDER BY mae, started_at DESC LIMIT 1""",
    "r31_category_impact": F_ + """SELECT flight_id,
  (round((CAST(flight_id % 7 AS DOUBLE) - 3.0) + (CASE WHEN flight_id % 2 = 0 THEN 1.5 ELSE -0.5 END), 6) + 0.0) AS Weather,
  (round((CAST(lag_s AS DOUBLE) / 100.0) + (CAST(lag_s AS DOUBLE) / -250.0) + sin(CAST(hour(aobt) AS DOUBLE))
        + cos(CAST(day(aobt) AS DOUBLE)), 6) + 0.0) AS Traffic,
  (round(0.25 + CAST(engines AS DOUBLE) * 3.0, 6) + 0.0) AS Distance,
  (round(ac_length / 10.0 + (CAST(engines AS DOUBLE) - 3.0), 6) + 0.0) AS Aircraft
FROM flights""",
    "r32_learn_categories": FW + """SELECT summary, row_number() OVER (ORDER BY summary) AS position
FROM (SELECT DISTINCT summary FROM weather WHERE summary IS NOT NULL)""",
    "r33_row_counts": FK + """, ranked AS (SELECT row_number() OVER (ORDER BY aobt, flight_id) AS rn, count(*) OVER () AS n FROM kept)
SELECT (SELECT count(*) FROM flights) AS flights, (SELECT count(*) FROM kept) AS kept,
  (SELECT count(*) FROM ranked WHERE rn <= floor(CAST(n AS DOUBLE) * 0.8)) AS train,
  (SELECT count(*) FROM ranked WHERE rn > floor(CAST(n AS DOUBLE) * 0.8)) AS validation""",
    "r34_planes_in_window": FK + """, e AS (SELECT flight_id, CAST(epoch(aobt) AS BIGINT) AS t FROM kept)
SELECT flight_id,
  CAST(count(*) OVER (ORDER BY t RANGE BETWEEN 1800 PRECEDING AND 1800 FOLLOWING) - 1 AS DOUBLE) AS planes_30min,
  CAST(count(*) OVER (ORDER BY t RANGE BETWEEN 600 PRECEDING AND 600 FOLLOWING) - 1 AS DOUBLE) AS planes_10min
FROM e""",
    "r35_time_ordered_split": F_ + """SELECT flight_id,
  CASE WHEN row_number() OVER (ORDER BY aobt, flight_id) <= floor(CAST(count(*) OVER () AS DOUBLE) * 0.8) THEN 1 ELSE 0 END AS is_train
FROM flights""",
    "r35b_time_ordered_split_orders": """SELECT o_orderkey,
  CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= floor(CAST(count(*) OVER () AS DOUBLE) * 0.8) THEN 1 ELSE 0 END AS is_train
FROM orders""",
    "r36_rank_drivers": FI + """, u AS (
  SELECT flight_id, 0 AS pos, 'Weather' AS category, Weather AS impact FROM impacts
  UNION ALL SELECT flight_id, 1, 'Traffic', Traffic FROM impacts
  UNION ALL SELECT flight_id, 2, 'Distance', Distance FROM impacts
  UNION ALL SELECT flight_id, 3, 'Aircraft', Aircraft FROM impacts),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY flight_id ORDER BY abs(impact) DESC, pos) AS INTEGER) AS rank FROM u)
SELECT flight_id, rank, CASE rank WHEN 1 THEN '1st' WHEN 2 THEN '2nd' WHEN 3 THEN '3rd' ELSE '4th' END AS ordinal,
  category, impact, CASE WHEN impact > 0 THEN 'up' ELSE 'down' END AS direction,
  CASE WHEN impact < 0 THEN 'good' ELSE 'bad' END AS tone FROM r""",
    "r37_sort_by_offblock": F_ + "SELECT flight_id, aobt, taxi FROM flights ORDER BY aobt NULLS LAST, flight_id",
    "r38_head_n": F_ + "SELECT flight_id, aobt FROM flights ORDER BY aobt NULLS LAST, flight_id NULLS LAST LIMIT 10",
    "r39_sample_n_seeded": F_ + """SELECT flight_id, taxi FROM flights
ORDER BY md5(concat_ws(':', '42', CAST(flight_id AS VARCHAR))), flight_id LIMIT 10""",
    "r41_one_hot": FWJ + """SELECT flight_id, copy_no,
  CASE WHEN summary = 'Clear' THEN 1 ELSE 0 END AS summary_Clear,
  CASE WHEN summary = 'Rain' THEN 1 ELSE 0 END AS summary_Rain,
  CASE WHEN summary = 'nan' THEN 1 ELSE 0 END AS summary_nan
FROM fl_wx""",
    "r42_haversine_m": """WITH p AS (SELECT event_id AS flight_id, CAST(user_id % 60 - 30 AS DOUBLE) AS lat1,
  CAST(event_id % 120 - 60 AS DOUBLE) AS lng1, CAST(fmod(value, 50) - 25 AS DOUBLE) AS lat2,
  CAST(user_id % 170 - 85 AS DOUBLE) AS lng2 FROM events)
SELECT flight_id, round(""" + _hav("lat1", "lng1", "lat2", "lng2") + """, 3) AS distance FROM p""",
    "r43_log_distance": """SELECT event_id AS flight_id, round(""" + _logd("CAST((event_id % 1000) * 10 AS DOUBLE)")
        + """, 6) AS log_distance FROM events""",
    "r44_cyclical_encode": F_ + """SELECT flight_id, (round(sin(2 * pi() * hour(aobt) / 24.0), 6) + 0.0) AS hour_sin,
  (round(cos(2 * pi() * hour(aobt) / 24.0), 6) + 0.0) AS hour_cos FROM flights""",
    "r45_datetime_parts": F_ + """SELECT flight_id,
  (round(sin(2 * pi() * hour(aobt) / 24.0), 6) + 0.0) AS AOBT_hour_sin, (round(cos(2 * pi() * hour(aobt) / 24.0), 6) + 0.0) AS AOBT_hour_cos,
  (round(sin(2 * pi() * (isodow(aobt) - 1) / 7.0), 6) + 0.0) AS AOBT_day_of_week_sin,
  (round(cos(2 * pi() * (isodow(aobt) - 1) / 7.0), 6) + 0.0) AS AOBT_day_of_week_cos,
  (round(sin(2 * pi() * month(aobt) / 12.0), 6) + 0.0) AS AOBT_month_sin, (round(cos(2 * pi() * month(aobt) / 12.0), 6) + 0.0) AS AOBT_month_cos,
  (round(sin(2 * pi() * day(aobt) / 31.0), 6) + 0.0) AS AOBT_day_of_month_sin,
  (round(cos(2 * pi() * day(aobt) / 31.0), 6) + 0.0) AS AOBT_day_of_month_cos
FROM flights""",
    "r46_parse_datetime_or_null": F_ + """SELECT flight_id, date_trunc('minute', aobt) AS parsed_unpadded,
  date_trunc('minute', aobt) AS parsed_padded, CAST(NULL AS TIMESTAMP) AS parsed_with_seconds,
  CAST(NULL AS TIMESTAMP) AS parsed_short_year FROM flights""",
    "r47_format_datetime": F_ + f"""SELECT flight_id, strftime(aobt, {MDY}) AS aobt_text, strftime(aobt, {MDY}) AS from_iso
FROM flights""",
    "r48_delay_seconds": F_ + """SELECT flight_id, CAST(epoch(aobt) - epoch(aobt - to_seconds(lag_s)) AS DOUBLE) AS delay_seconds
FROM flights""",
    "r49_epoch_seconds": F_ + "SELECT flight_id, CAST(epoch(aobt) AS BIGINT) AS epoch_s FROM flights",
    "r50_bump_id": F_ + """, r AS (SELECT flight_id,
  CASE WHEN flight_id % 3 = 0 THEN concat('Stand_', lpad(CAST(flight_id % 26 AS VARCHAR), 3, '0'), 'x')
       WHEN flight_id % 3 = 1 THEN concat('runway_', CAST(flight_id % 7 AS VARCHAR))
       ELSE concat('A_B_', CAST(flight_id % 5 AS VARCHAR)) END AS raw FROM flights)
SELECT flight_id, raw, """ + _bump("raw") + " AS bumped FROM r",
    "r51_digits_to_int": F_ + """SELECT flight_id, CAST(regexp_extract(stand, '([0-9]+)', 1) AS INTEGER) AS stand_no,
  CAST(regexp_extract(runway, '([0-9]+)', 1) AS INTEGER) AS runway_no FROM flights""",
    "r52_fill_with_median": FWJ + """SELECT flight_id, copy_no,
  coalesce(temperature, (SELECT median(temperature) FROM fl_wx)) AS temperature FROM fl_wx""",
    "r53_trim_text": F_ + "SELECT flight_id, trim(concat('  ', flight_no, ' ')) AS flight_no FROM flights",
    "r54_parse_iso_datetime": F_ + "SELECT flight_id, aobt AS departure FROM flights",
    "r55_seconds_to_minutes": "SELECT event_id AS flight_id, round_even(value / 60.0, 1) AS minutes FROM events",
    "r56_round_half_even": "SELECT event_id AS flight_id, round_even(sqrt(value), 1) AS rounded FROM events",
    "r57_compose_id": F_ + """SELECT flight_id,
  concat('STAND_', CAST(CAST(regexp_extract(stand, '([0-9]+)', 1) AS INTEGER) AS VARCHAR)) AS stand_id,
  concat('RUNWAY_', CAST(CAST(regexp_extract(runway, '([0-9]+)', 1) AS INTEGER) AS VARCHAR)) AS runway_id FROM flights""",
    "r58_format_time": F_ + "SELECT flight_id, strftime(aobt, '%H:%M') AS departure_hhmm FROM flights",
    "r59_impact_direction": FI + """SELECT flight_id, CASE WHEN Traffic > 0 THEN 'up' ELSE 'down' END AS direction,
  CASE WHEN Traffic < 0 THEN 'good' ELSE 'bad' END AS tone FROM impacts""",
    "r74_explain_linear": FWJ + """, d AS (SELECT flight_id, copy_no, taxi, temperature FROM fl_wx
  WHERE taxi IS NOT NULL AND temperature IS NOT NULL),
m AS (SELECT regr_slope(taxi, temperature) AS b, regr_intercept(taxi, temperature) AS a, avg(temperature) AS mx FROM d)
SELECT flight_id, copy_no, round(a + b * temperature, 3) AS prediction,
  round(b * (temperature - mx), 3) AS attribution, round(a + b * mx, 3) AS base_value FROM d, m""",
}


def _gold_train_sql() -> str:
    """The gold training table (default variant), written independently in SQL."""
    hav = _hav("r.Lat_runway", "r.Lng_runway", "s.Lat_stand", "s.Lng_stand")

    def cyc(x: str, period: float, name: str) -> str:
        return (f"(round(sin(2 * pi() * {x} / {period}), 6) + 0.0) AS AOBT_{name}_sin, "
                f"(round(cos(2 * pi() * {x} / {period}), 6) + 0.0) AS AOBT_{name}_cos")

    def onehot(col: str, values: list[str]) -> str:
        return ", ".join(f'CASE WHEN {col} = \'{v}\' THEN 1 ELSE 0 END AS "{col}_{v}"' for v in values)

    def num(expr: str, mod: int) -> str:
        return f"CASE WHEN flight_id % {mod} = 0 THEN NULL ELSE CAST({expr} AS DOUBLE) END"

    return _with(FLIGHTS, GEO) + f""",
keyed AS (
  SELECT *, coalesce(strftime(aobt - to_seconds(lag_s), {MDY}), 'nan') AS fdt,
         coalesce(strftime(aobt, {MDY}), 'nan') AS aobt_t,
         coalesce(strftime(aobt + to_microseconds(CAST(round(taxi * 1000000) AS BIGINT)), {MDY}), 'nan') AS atot_t,
         coalesce(model, 'nan') AS model_t
  FROM flights),
wx AS (
  SELECT fdt, model_t, aobt_t, atot_t,
         coalesce(CASE WHEN flight_id % 11 = 0 THEN NULL WHEN flight_id % 2 = 0 THEN 'Clear' ELSE 'Rain' END, 'nan') AS summary,
         CASE flight_id % 3 WHEN 0 THEN 'clear-day' WHEN 1 THEN 'rain' ELSE 'cloudy' END AS icon,
         coalesce(CASE WHEN flight_id % 4 = 0 THEN 'rain' WHEN flight_id % 4 = 1 THEN 'snow' END, 'nan') AS precipType,
         {num("(flight_id * 17 % 41) / 2.0 - 5", 7)} AS temperature,
         {num("(flight_id % 100) / 100.0", 17)} AS humidity,
         {num("flight_id * 7 % 23", 19)} AS windSpeed,
         {num("flight_id % 10", 23)} AS visibility,
         {num("1000 + flight_id % 30", 2)} AS pressure,
         {num("(flight_id % 9) / 10.0", 3)} AS cloudCover,
         flight_id % 13 AS N_dep_dep
  FROM keyed JOIN (SELECT 0 AS copy_no UNION ALL SELECT 1 AS copy_no) c ON c.copy_no = 0 OR keyed.flight_id % 50 = 0
  WHERE flight_id % 10 <> 3),
rw AS (SELECT DISTINCT runway, Lat_runway, Lng_runway FROM geo),
st AS (SELECT DISTINCT stand, Lat_stand, Lng_stand FROM geo),
j AS (
  SELECT a.flight_id, a.aobt, a.lag_s, a.taxi, a.runway, a.stand, a.ac_length, a.engines, a.flight_no, a.model,
         {hav} AS distance, w.summary, w.icon, w.precipType, w.temperature, w.humidity, w.windSpeed,
         w.visibility, w.pressure, w.cloudCover, w.N_dep_dep
  FROM keyed a
  LEFT JOIN rw r ON a.runway = r.runway LEFT JOIN st s ON a.stand = s.stand
  LEFT JOIN wx w ON a.fdt = w.fdt AND a.model_t = w.model_t AND a.aobt_t = w.aobt_t AND a.atot_t = w.atot_t
  WHERE a.aobt < TIMESTAMP '2024-01-25 00:00:00' AND a.taxi > 0 AND a.taxi < 7200),
t AS (
  SELECT *, date_trunc('minute', aobt) AS aobt_ts,
         CAST(epoch(date_trunc('minute', aobt)) - epoch(date_trunc('minute', aobt - to_seconds(lag_s))) AS DOUBLE) AS delay_seconds
  FROM j)
SELECT flight_id, aobt_ts,
  CAST(regexp_extract(runway, '([0-9]+)', 1) AS INTEGER) AS runway,
  CAST(regexp_extract(stand, '([0-9]+)', 1) AS INTEGER) AS stand,
  ac_length AS "Aircraft Length", engines AS "No. Engines", taxi AS actual_taxi_out_sec,
  round(distance, 3) AS distance, round({_logd("distance")}, 6) AS log_distance,
  temperature, humidity, windSpeed, visibility, pressure, cloudCover, N_dep_dep,
  CASE WHEN regexp_extract(flight_no, '^([A-Z]{{2,3}})', 1) IN ('NJE', 'VJT', 'PVT', 'SIG') THEN 1 ELSE 0 END AS private_flight,
  CASE WHEN model IN ('A109', 'AW139', 'S-76', '407', '214 ST', 'EC 120', 'EC 135T', 'EC 155B', 'SA 365 DAUPHIN 2',
                      'AEROSPATIALE AS355 ECUREUIL 2 (TWIN SQ.)', 'AS 350 ECUREUIL (SQUIRREL)', 'Helicopter')
       THEN 1 ELSE 0 END AS helicopter,
  delay_seconds,
  CAST(count(*) OVER (ORDER BY epoch(aobt_ts) RANGE BETWEEN 1800 PRECEDING AND 1800 FOLLOWING) - 1 AS DOUBLE) AS planes_30min,
  CAST(count(*) OVER (ORDER BY epoch(aobt_ts) RANGE BETWEEN 600 PRECEDING AND 600 FOLLOWING) - 1 AS DOUBLE) AS planes_10min,
  {cyc("hour(aobt_ts)", 24.0, "hour")}, {cyc("(isodow(aobt_ts) - 1)", 7.0, "day_of_week")},
  {cyc("month(aobt_ts)", 12.0, "month")}, {cyc("day(aobt_ts)", 31.0, "day_of_month")},
  {onehot("summary", ["Clear", "Rain", "nan"])}, {onehot("icon", ["clear-day", "cloudy", "rain"])},
  {onehot("precipType", ["nan", "rain", "snow"])}
FROM t"""


SQL["r78_build_gold"] = _gold_train_sql()


def _gold_sql(part: str, clean: bool) -> str:
    """The other gold tables: the test set is the departures from the cut on; clean ones are filled with the training medians."""
    train = _gold_train_sql().replace("round(distance, 3) AS distance", "distance").replace(f"round({_logd('distance')}, 6)", _logd("distance"))
    rows = train if part == "train" else train.replace("a.aobt < TIMESTAMP", "a.aobt >= TIMESTAMP")
    filled = ["distance", "log_distance", "temperature", "humidity", "windSpeed", "visibility", "N_dep_dep"] if clean else []
    value = {c: f"coalesce({c}, (SELECT median({c}) FROM learned))" for c in filled}
    if clean:
        value["N_dep_dep"] = f"CAST({value['N_dep_dep']} AS BIGINT)"
    value = value | {"distance": f"round({value.get('distance', 'distance')}, 3)", "log_distance": f"round({value.get('log_distance', 'log_distance')}, 6)"}
    drop = "EXCLUDE (pressure, cloudCover)" if clean else ""
    return (f"WITH learned AS ({train}), given AS ({rows}) SELECT * {drop} REPLACE ("
            + ", ".join(f"{v} AS {c}" for c, v in value.items()) + ") FROM given")


SQL["r78b_gold_test"] = _gold_sql("test", False)
SQL["r78c_gold_train_clean"] = _gold_sql("train", True)
SQL["r78d_gold_test_clean"] = _gold_sql("test", True)

SQL["r66b_missing_inputs_long"] = FWJ + """SELECT flight_id, copy_no, 'taxi' AS input, coalesce(taxi, -1.0e15) AS value FROM fl_wx
UNION ALL SELECT flight_id, copy_no, 'taxi__missing', CASE WHEN taxi IS NULL THEN 1.0 ELSE 0.0 END FROM fl_wx
UNION ALL SELECT flight_id, copy_no, 'temperature', coalesce(temperature, -1.0e15) FROM fl_wx
UNION ALL SELECT flight_id, copy_no, 'temperature__missing', CASE WHEN temperature IS NULL THEN 1.0 ELSE 0.0 END FROM fl_wx"""

SQL["r38b_dashboard_cards"] = F_ + """, d AS (
  SELECT trim(concat(CASE WHEN flight_id % 7 = 0 THEN ' ' ELSE '' END, flight_no)) AS Flight,
         stand AS Stand, runway AS Runway, date_trunc('minute', aobt) AS dep, 600.5 + CAST(lag_s AS DOUBLE) AS pred,
         CAST(flight_id % 17 AS DOUBLE) * 1.5 - 12.0 AS Weather, CAST(lag_s AS DOUBLE) / 10.0 - 90.0 AS Traffic,
         CAST(engines AS DOUBLE) * 2.5 - 5.0 AS Distance, ac_length - 40.0 AS Aircraft
  FROM flights)
SELECT Flight, Stand, Runway, strftime(dep, '%H:%M') AS Departure,
  round_even(pred / 60.0, 1) AS "Predicted taxi time (min)",
  CASE Runway WHEN 'RUNWAY_1' THEN 14 WHEN 'RUNWAY_2' THEN 17 WHEN 'RUNWAY_3' THEN 19 WHEN 'RUNWAY_4' THEN 21 ELSE 18 END
    AS "Runway base (min)", Weather, Traffic, Distance, Aircraft
FROM d ORDER BY dep NULLS LAST, Flight NULLS LAST LIMIT 10"""

SQL["r77_build_silver"] = F_ + f"""SELECT flight_id,
  coalesce(strftime(aobt - to_seconds(lag_s), {MDY}), 'nan') AS "Flight Datetime",
  coalesce(strftime(aobt, {MDY}), 'nan') AS "AOBT",
  coalesce(strftime(aobt + to_microseconds(CAST(round(taxi * 1000000) AS BIGINT)), {MDY}), 'nan') AS "ATOT",
  coalesce(flight_no, 'nan') AS "Flight Number", coalesce(model, 'nan') AS "Aircraft Model",
  coalesce(runway, 'nan') AS runway, coalesce(stand, 'nan') AS stand,
  ac_length AS "Aircraft Length", engines AS "No. Engines", taxi AS actual_taxi_out_sec
FROM flights WHERE aobt < TIMESTAMP '2024-01-25 00:00:00'"""

SQL["r02b_scan_csv_by_suffix"] = SQL["r02_scan_by_suffix"]
SQL["r14b_all_routes"] = F_ + """SELECT flight_id, taxi, model_type FROM flights,
  (SELECT unnest(['linear_regression', 'random_forest', 'xgboost', 'lightgbm', 'catboost', 'another']) AS model_type)
WHERE taxi IS NOT NULL OR model_type NOT IN ('linear_regression', 'random_forest')"""
SQL["r32b_category_table"] = F_ + """SELECT 'flight_no' AS feature, flight_no AS value, row_number() OVER (ORDER BY flight_no) - 1 AS position FROM (SELECT DISTINCT flight_no FROM flights)
UNION ALL SELECT 'model', model, row_number() OVER (ORDER BY model) - 1 FROM (SELECT DISTINCT model FROM flights WHERE model IS NOT NULL)"""
SQL["r41b_one_hot_vectors"] = F_ + """SELECT flight_id, CAST(dense_rank() OVER (ORDER BY flight_no) - 1 AS INTEGER) AS slot FROM flights
UNION ALL SELECT flight_id, CAST((SELECT count(DISTINCT flight_no) FROM flights) + dense_rank() OVER (ORDER BY model) - 1 AS INTEGER) FROM flights WHERE model IS NOT NULL"""
SQL["r67_search_space"] = """SELECT * FROM (VALUES ('linear_regression', 2, 2, 1), ('random_forest', 15, 15, 5), ('xgboost', 30, 30, 9),
  ('lightgbm', 30, 30, 9), ('catboost', 30, 30, 7)) t(model_type, n_trials, n_inside, n_parameters)"""

SQL["r77b_silver_airport_test"] = SQL["r77_build_silver"].replace("WHERE aobt < ", "WHERE aobt >= ")

SQL["r77c_silver_geographies"] = _with(GEO) + """, points AS (SELECT runway, stand, Lat_runway AS lat_runway, Lng_runway AS lng_runway, Lat_stand AS lat_stand, Lng_stand AS lng_stand FROM geo)
SELECT *, 'geography' AS source_table FROM points
UNION ALL SELECT *, 'test_geography' FROM points WHERE stand IN (SELECT concat('STAND_', CAST(c_nationkey + 1 AS VARCHAR)) FROM customer)"""


def _sometimes(expr: str, mod: int) -> str:
    return f"CASE WHEN flight_id % {mod} = 0 THEN NULL ELSE CAST({expr} AS DOUBLE) END"


_WEATHER_TEXT = F_ + f""", texts AS (SELECT *, coalesce(strftime(aobt - to_seconds(lag_s), {MDY}), 'nan') AS fdt, coalesce(strftime(aobt, {MDY}), 'nan') AS aobt_t,
  coalesce(strftime(aobt + to_microseconds(CAST(round(taxi * 1000000) AS BIGINT)), {MDY}), 'nan') AS atot_t,
  CASE WHEN flight_id % 11 = 0 THEN 'nan' WHEN flight_id % 2 = 0 THEN 'Clear' ELSE 'Rain' END AS summary FROM flights),
observed AS (SELECT texts.* FROM texts JOIN (SELECT 0 AS copy_no UNION ALL SELECT 1) c ON c.copy_no = 0 OR flight_id % 50 = 0 WHERE flight_id % 10 <> 3)"""

SQL["r77d_silver_weather"] = _WEATHER_TEXT + f""" SELECT fdt AS "Flight Datetime", coalesce(model, 'nan') AS "Aircraft Model", aobt_t AS "AOBT", atot_t AS "ATOT", summary,
  CASE flight_id % 3 WHEN 0 THEN 'clear-day' WHEN 1 THEN 'rain' ELSE 'cloudy' END AS icon,
  CASE flight_id % 4 WHEN 0 THEN 'rain' WHEN 1 THEN 'snow' ELSE 'nan' END AS "precipType",
  {_sometimes("(flight_id * 17 % 41) / 2.0 - 5", 7)} AS temperature, {_sometimes("(flight_id % 100) / 100.0", 17)} AS humidity,
  {_sometimes("flight_id * 7 % 23", 19)} AS "windSpeed", {_sometimes("flight_id % 10", 23)} AS visibility, {_sometimes("1000 + flight_id % 30", 2)} AS pressure,
  {_sometimes("(flight_id % 9) / 10.0", 3)} AS "cloudCover", {_sometimes("flight_id % 5", 29)} AS "dewPoint", flight_id % 24 AS "Hour", flight_id % 13 AS "N_dep_dep"
FROM observed"""

SQL["r77e_silver_plain_tables"] = _WEATHER_TEXT + """ SELECT 'test_weather' AS source_table, aobt_t AS first_text, summary AS second_text FROM observed
  WHERE aobt_t IN (SELECT aobt_t FROM texts WHERE aobt >= TIMESTAMP '2024-01-25 00:00:00')
UNION ALL SELECT 'ac_characteristics', coalesce(model, 'nan'), CAST(engines AS VARCHAR) FROM (SELECT DISTINCT model, engines, ac_length FROM flights)
UNION ALL SELECT 'glossary', coalesce(term, 'nan'), coalesce(definition, 'nan')
  FROM (SELECT DISTINCT p_name AS term, CASE WHEN p_partkey % 3 <> 0 THEN p_type END AS definition FROM part)"""

_NAMED = {"Traffic": ["N_dep_dep", "N_dep_arr", "Q_dep_dep", "planes_30min", "planes_10min", "delay_seconds"],
          "Distance": ["stand", "runway", "distance", "log_distance"], "Aircraft": ["Aircraft Length", "No. Engines"]}
SQL["r60_feature_groups"] = _WEATHER_TEXT + """, names AS (
  SELECT unnest(['temperature', 'humidity', 'windSpeed', 'visibility', 'pressure', 'cloudCover', 'private_flight', 'helicopter']
    || flatten([['AOBT_' || p || '_sin', 'AOBT_' || p || '_cos'] for p in ['hour', 'day_of_week', 'month', 'day_of_month']])) AS n
  UNION ALL SELECT DISTINCT 'summary_' || summary FROM observed
  UNION ALL SELECT DISTINCT 'icon_' || CASE flight_id % 3 WHEN 0 THEN 'clear-day' WHEN 1 THEN 'rain' ELSE 'cloudy' END FROM observed
  UNION ALL SELECT DISTINCT 'precipType_' || CASE flight_id % 4 WHEN 0 THEN 'rain' WHEN 1 THEN 'snow' ELSE 'nan' END FROM observed)
SELECT 'Weather' AS feature_group, n AS feature FROM names
  WHERE len(list_filter(""" + str(WEATHER_PATTERNS) + """, lambda p: contains(n, p))) > 0
UNION ALL SELECT 'Traffic', n FROM names, (SELECT unnest(['hour', 'day_of_week', 'month']) AS p) WHERE contains(lower(n), p)
""" + "".join(f"UNION ALL SELECT '{g}', unnest({m})\n" for g, m in _NAMED.items())
SQL["r47b_lenient_datetimes"] = F_ + f"SELECT flight_id, CASE WHEN flight_id % 25 < 17 THEN strftime(aobt, {MDY}) END AS off_block FROM flights"

# --- model queries (plans/model_values.py): group means and closed forms of least squares ---

FAMILIES = ("random_forest", "xgboost", "lightgbm", "catboost")
PRIVATE = "CASE WHEN regexp_extract(flight_no, '^([A-Z]{2,3})', 1) IN ('NJE', 'VJT', 'PVT', 'SIG') THEN 1.0 ELSE 0.0 END"
VALUES = F_ + f""", v AS (SELECT flight_id, aobt, taxi AS y, CAST({PRIVATE} AS DOUBLE) AS a,
    CAST(CASE WHEN engines = 4 THEN 1 ELSE 0 END AS DOUBLE) AS b, model, aobt < TIMESTAMP '2024-01-25 00:00:00' AS early FROM flights),
train AS (SELECT *, row_number() OVER (ORDER BY aobt, flight_id) <= floor(CAST(count(*) OVER () AS DOUBLE) * 0.8) AS fit
  FROM v WHERE early AND y IS NOT NULL),
test AS (SELECT * FROM v WHERE NOT early AND y IS NOT NULL)"""


def _lsq(name: str, rows: str) -> str:
    """Least squares of y on a and b with an intercept: w0, wa, wb."""
    return f""", {name}_m AS (SELECT avg(y) AS my, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS aa, var_pop(b) AS bb,
    covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS yb FROM {rows}),
{name}_w AS (SELECT (ay * bb - yb * ab) / (aa * bb - ab * ab) AS wa, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS wb, * FROM {name}_m),
{name} AS (SELECT my - wa * ma - wb * mb AS w0, wa, wb FROM {name}_w)"""


def _lsq_origin(name: str, rows: str) -> str:
    """The same without an intercept."""
    return f""", {name}_m AS (SELECT avg(a * a) AS aa, avg(b * b) AS bb, avg(a * b) AS ab, avg(a * y) AS ay, avg(b * y) AS yb FROM {rows}),
{name} AS (SELECT 0.0 AS w0, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS wa, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM {name}_m)"""


def _scores(name: str, fitted: str, scored: str) -> str:
    """Predictions p of the four candidates (kind, candidate), fitted on some rows, for others."""
    return (_lsq(f"{name}_l", fitted) + _lsq_origin(f"{name}_o", fitted) + f""", {name} AS (
  SELECT 'tree' AS kind, 'full' AS candidate, s.flight_id, s.y, g.m AS p
    FROM {scored} s JOIN (SELECT a, b, avg(y) AS m FROM {fitted} GROUP BY a, b) g ON s.a = g.a AND s.b = g.b
  UNION ALL SELECT 'tree', 'plain', s.flight_id, s.y, g.m FROM {scored} s, (SELECT avg(y) AS m FROM {fitted}) g
  UNION ALL SELECT 'linear', 'full', s.flight_id, s.y, w0 + wa * a + wb * b FROM {scored} s, {name}_l
  UNION ALL SELECT 'linear', 'plain', s.flight_id, s.y, w0 + wa * a + wb * b FROM {scored} s, {name}_o)""")


ALL_FAMILIES = ", families AS (SELECT 'linear_regression' AS model_type, 'linear' AS kind" + "".join(
    f" UNION ALL SELECT '{f}', 'tree'" for f in FAMILIES) + ")"
TRIALS = (VALUES + ", early_rows AS (SELECT * FROM train WHERE fit), late_rows AS (SELECT * FROM train WHERE NOT fit)"
          + _scores("held", "early_rows", "late_rows")
          + ", trials AS (SELECT kind, candidate, sqrt(avg((y - p) * (y - p))) AS e FROM held GROUP BY kind, candidate)" + ALL_FAMILIES)
#: The candidate that won (the plain one is first, so it wins ties), its predictions and their metrics.
RUNS = (TRIALS + """, won AS (SELECT kind, candidate FROM trials QUALIFY row_number() OVER (PARTITION BY kind ORDER BY e, candidate DESC) = 1)"""
        + _scores("final", "train", "test") + """, runs AS (
  SELECT kind, candidate, round(sqrt(avg((y - p) * (y - p))), 3) AS rmse,
    round(avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)), 3) AS mape, round(avg(abs(y - p)), 3) AS mae,
    round(stddev_pop(y - p), 3) AS std FROM final JOIN won USING (kind, candidate) GROUP BY kind, candidate)""")
_FULL = VALUES + _scores("final", "train", "test")
_TREE = "SELECT flight_id, round(p, 3) AS prediction FROM final WHERE kind = 'tree' AND candidate = 'full'"
_ONE = """, g AS (SELECT a, avg(y) AS m FROM train GROUP BY a), m AS (SELECT avg(y) AS base FROM train)"""

SQL["r40b_sample_n"] = "SELECT least(10, count(*)) AS n_rows, least(10, count(DISTINCT event_id)) AS n_distinct FROM events"
SQL["r61b_fit_linear"] = _FULL + "SELECT flight_id, round(p, 3) AS prediction FROM final WHERE kind = 'linear' AND candidate = 'full'"
for _name in ("r62b_fit_forest", "r63b_fit_boost_depthwise", "r64b_fit_boost_leafwise", "r65b_fit_boost_symmetric"):
    SQL[_name] = _FULL + _TREE
SQL["r68b_search_holdout"] = TRIALS + "SELECT model_type, candidate, round(e, 3) AS validation_rmse FROM families JOIN trials USING (kind)"
SQL["r69b_refit_and_score"] = RUNS + "SELECT rmse, mape, mae, std FROM runs WHERE kind = 'tree'"
SQL["r70b_train_all"] = RUNS + "SELECT model_type, rmse, mape, mae, std FROM families JOIN runs USING (kind)"
SQL["r71b_record_run"] = RUNS + """SELECT model_type, candidate, 'private,four' AS features, mae
FROM families JOIN runs USING (kind) WHERE model_type IN ('linear_regression', 'catboost')"""
SQL["r72b_save_load_model"] = _FULL + ALL_FAMILIES + """SELECT model_type, flight_id, round(p, 3) AS fitted, round(p, 3) AS loaded
FROM families JOIN final USING (kind) WHERE kind = 'tree' AND candidate = 'full'"""
SQL["r73b_batch_score"] = VALUES + _lsq("w", "train") + """SELECT flight_id,
  CASE WHEN model IS NOT NULL THEN round(w0 + wa * a + wb * b, 3) END AS prediction FROM v, w"""
SQL["r75b_explain_trees"] = VALUES + _ONE + ALL_FAMILIES + """SELECT model_type, flight_id, round(g.m - m.base, 3) AS attribution,
  round(m.base, 3) AS base_value FROM families, m, test JOIN g USING (a) WHERE kind = 'tree'"""
SQL["r76b_score_and_explain"] = VALUES + _ONE + ALL_FAMILIES + """SELECT model_type, flight_id, 'STAND_1' AS "Stand",
  concat('RUNWAY_', CAST(CAST(a AS INTEGER) + 1 AS VARCHAR)) AS "Runway", 40.0::DOUBLE AS "Aircraft Length (m)", 2 AS "No. Engines",
  CAST(trunc(y) AS INTEGER) AS "Actual Taxi Time (s)", round_even(g.m, 1) AS "Predicted Taxi Time (s)",
  0.0::DOUBLE AS "Weather", 0.0::DOUBLE AS "Traffic", round_even(g.m - m.base, 1) AS "Distance", 0.0::DOUBLE AS "Aircraft"
FROM families, m, test JOIN g USING (a) WHERE kind = 'tree'"""



# --- the first two levels of trees (plans/model_values.py): all candidates of a node, by sums of gradients ---

def _penalised(g: str, h: str, alpha: float, lam: float) -> str:
    t = f"greatest(abs({g}) - {alpha}, 0)"
    return f"(CASE WHEN {h} + {lam} > 0 THEN {t} * {t} / ({h} + {lam}) ELSE 0 END)"


def _candidates(name: str, rows: str, symmetric: bool, alpha=0.0, lam=0.0, gamma=0.0, child=1, split=2) -> str:
    """{name}: the split of each node of rows (node, g, x0, x1, x2), if any gains; all nodes share it if symmetric."""
    gain = f"0.5 * ({_penalised('gl', 'hl', alpha, lam)} + {_penalised('t.g - gl', 't.h - hl', alpha, lam)} - {_penalised('t.g', 't.h', alpha, lam)})"
    fits = "TRUE" if symmetric else f"least(hl, t.h - hl) >= {child} AND t.h >= {split}"
    best = ("PARTITION BY (SELECT 1)" if symmetric else "PARTITION BY node") + " ORDER BY gain DESC, ml, c, x"
    pooled = f"""{name}_s AS (SELECT c, x, ml, sum(gain) - {gamma} AS gain, bool_or(hm > 0) AS seen FROM {name}_g
    GROUP BY c, x, ml HAVING bool_or(hl > 0 AND h > hl) QUALIFY row_number() OVER (ORDER BY sum(gain) DESC, ml, c, x) = 1),
  {name}_b AS (SELECT g.node, g.c, g.x, g.ml, s.gain, g.gl, g.hl, g.g, g.h, s.seen, sum(g.hl) OVER () * 2 >= sum(g.h) OVER () AS larger
    FROM {name}_g g JOIN {name}_s s USING (c, x, ml) WHERE s.gain > 1e-10)"""
    single = f"""{name}_b AS (SELECT node, c, x, ml, gain - {gamma} AS gain, gl, hl, g, h, hm > 0 AS seen, hl * 2 >= h AS larger FROM {name}_g
    WHERE gain - {gamma} > 1e-10 QUALIFY row_number() OVER ({best}) = 1)"""
    return f""", {name}_l AS (SELECT node, 0 AS c, x0 AS x, g FROM {rows} UNION ALL SELECT node, 1, x1, g FROM {rows} UNION ALL SELECT node, 2, x2, g FROM {rows}),
  {name}_p AS (SELECT node, c, x, sum(g) AS g, count(*) AS h FROM {name}_l GROUP BY node, c, x),
  {name}_t AS (SELECT node, sum(g) AS g, count(*) AS h FROM {rows} GROUP BY node),
  {name}_v AS (SELECT n.node, v.c, v.x FROM (SELECT DISTINCT c, x FROM {name}_l WHERE x IS NOT NULL) v, {name}_t n),
  {name}_c AS (SELECT node, c, x, sum(coalesce(g, 0)) OVER w AS gl, sum(coalesce(h, 0)) OVER w AS hl
    FROM {name}_v LEFT JOIN {name}_p USING (node, c, x) WINDOW w AS (PARTITION BY node, c ORDER BY x)),
  {name}_m AS (SELECT node, c, g AS gm, h AS hm FROM {name}_p WHERE x IS NULL),
  {name}_d AS (SELECT node, c, x, 0 AS ml, gl, hl, coalesce(hm, 0) AS hm FROM {name}_c LEFT JOIN {name}_m USING (node, c)
    UNION ALL SELECT node, c, x, 1, gl + coalesce(gm, 0), hl + coalesce(hm, 0), coalesce(hm, 0) FROM {name}_c {'LEFT ' if symmetric else ''}JOIN {name}_m USING (node, c)
    WHERE c IN (SELECT c FROM {name}_m)),
  {name}_g AS (SELECT d.node, c, x, ml, gl, hl, hm, t.g, t.h, {gain} AS gain FROM {name}_d d JOIN {name}_t t USING (node) WHERE {fits}),
  {pooled if symmetric else single},
  {name} AS (SELECT node, c, x, CASE WHEN seen THEN ml ELSE CAST(larger AS INTEGER) END AS ml, gain, gl, hl, g, h FROM {name}_b)"""


def _two_levels(rule: str, symmetric=False, best_child=False, forest=False, **k) -> str:
    """The nodes of one tree as SELECTs over its CTEs; names carry the rule."""
    alpha, lam, r = k.get("alpha", 0.0), k.get("lam", 0.0), rule
    base = "0" if forest else "(SELECT avg(taxi) FROM flights)"
    value = f"-sign(sum(g)) * greatest(abs(sum(g)) - {alpha}, 0) / (count(*) + {lam})"
    goes_left = "CASE WHEN (CASE c WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END) IS NULL THEN ml = 1 ELSE (CASE c WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END) <= x END"
    step = f"CASE WHEN s.node IS NULL THEN r.node WHEN {goes_left} THEN r.node || 'L' ELSE r.node || 'R' END AS node"
    child = f"(SELECT * FROM {r}_two QUALIFY row_number() OVER (ORDER BY gain DESC, node) = 1)" if best_child else f"{r}_two"
    ctes = (f""", {r}_zero AS (SELECT '' AS node, {base} - taxi AS g, CAST(hour(aobt) AS DOUBLE) AS x0, CAST(lag_s // 60 AS DOUBLE) AS x1,
    CASE WHEN model IS NOT NULL THEN ac_length END AS x2 FROM flights WHERE taxi IS NOT NULL)"""
            + _candidates(f"{r}_one", f"{r}_zero", symmetric, **k)
            + f", {r}_first AS (SELECT {step}, g0 AS g, x0, x1, x2 FROM (SELECT node, g AS g0, x0, x1, x2 FROM {r}_zero) r LEFT JOIN {r}_one s ON s.node = r.node)"
            + _candidates(f"{r}_two", f"{r}_first", symmetric, **k)
            + f", {r}_kids AS (SELECT * FROM {child})"
            + f", {r}_leaf AS (SELECT {step}, g0 AS g FROM (SELECT node, g AS g0, x0, x1, x2 FROM {r}_first) r LEFT JOIN {r}_kids s ON s.node = r.node)"
            + f""", {r} AS (SELECT '{r}' AS rule, node AS path, CASE c WHEN 0 THEN 'hour' WHEN 1 THEN 'lag_min' ELSE 'length' END AS input,
    CASE WHEN x < (SELECT max(m.x) FROM {r}_one_l m WHERE m.c = b.c) THEN x END AS threshold, CAST(ml AS INTEGER) AS missing_left, round(gain, 1) AS gain,
    CAST(NULL AS DOUBLE) AS value, CAST(h AS BIGINT) AS n_rows FROM (SELECT * FROM {r}_one UNION ALL SELECT * FROM {r}_kids) b
  UNION ALL SELECT '{r}', node, NULL, NULL, NULL, NULL, round({value}, 3), count(*) FROM {r}_leaf GROUP BY node)""")
    return ctes


def _split_sql(common: dict, penalties: dict, name: str) -> str:
    return F_ + _two_levels("plain", **common) + _two_levels(name, **common, **penalties) + f" SELECT * FROM plain UNION ALL SELECT * FROM {name}"


SQL["r62c_forest_splits"] = _split_sql({"forest": True}, {"split": 3000, "child": 400}, "sizes")
SQL["r63c_depthwise_splits"] = _split_sql({}, {"alpha": 5000.0, "lam": 300.0, "gamma": 1000.0, "child": 200}, "penalties")
SQL["r64c_leafwise_splits"] = _split_sql({"best_child": True}, {"alpha": 2000.0, "lam": 100.0, "child": 300}, "penalties")
SQL["r65c_symmetric_splits"] = _split_sql({"symmetric": True}, {"lam": 2000.0}, "penalties")


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
