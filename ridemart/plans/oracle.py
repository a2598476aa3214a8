"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the operator semantics, not generated from the Spark plans: each query is one SQL
statement over the driver's parquet views (lineitem, orders, customer, supplier, nation,
events). The CTE chain re-derives the feeds, silver, weather, dimensions and fact in SQL.
Spark's ``initcap`` has no DuckDB twin, so it is spelled out word by word.
"""

from __future__ import annotations

import datetime as dt

# Fixed values, stated here again so that a wrong constant of the engine shows.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
WEATHER_GROUPS = ["Dry/Clear", "Overcast/Fog", "Light Rain", "Heavy Rain", "Snow/Ice"]
WEATHER_GROUP_RULES = [
    ("Snow/Ice", ["snow", "blizzard", "sleet", "ice"]),
    ("Heavy Rain", ["heavy rain", "moderate rain", "torrential"]),
    ("Light Rain", ["light rain", "drizzle", "patchy rain", "shower"]),
    ("Overcast/Fog", ["fog", "mist", "overcast", "cloudy"]),
]
WEATHER_DESCS = ["Patchy rain possible", "Light rain shower", "Moderate rain at times", "Light freezing rain",
                 "Overcast", "Light snow", "Sunny"]
NUMERIC_FEATURES = [
    "fare_amount", "distance", "expected_vs_actual_pickup_minutes_difference", "dispatch_to_arrival_minutes",
    "month", "quarter", "year", "weekend_flag", "pickup_latitude", "pickup_longitude", "fare_per_distance",
    "pickup_delay_signal", "journey_urgency", "lat_delta", "lon_delta", "location_distance_proxy",
]
AS_OF = {"orders": "2001-06-30 00:00:00", "events": "2024-01-28 00:00:00"}


def _lst(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + ")"


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')")


def minutes(later: str, earlier: str) -> str:
    return (f"((epoch(date_trunc('second', {later})) - epoch(date_trunc('second', {earlier})))"
            f" / 60.0)")


WEEKDAY_LIST = _lst(WEEKDAYS)
GROUP_LIST = _lst(WEATHER_GROUPS)


def weekday_index(c: str) -> str:
    return f"CAST(NULLIF(list_position({WEEKDAY_LIST}, {c}), 0) AS INTEGER)"


def weather_group(c: str) -> str:
    parts = []
    for group, words in WEATHER_GROUP_RULES:
        cond = " OR ".join(f"contains(lower({c}), '{w}')" for w in words)
        parts.append(f"WHEN {cond} THEN '{group}'")
    return "(CASE " + " ".join(parts) + " ELSE 'Dry/Clear' END)"


# ----------------------------------------------------------------------------------- feeds

TYPED_ORDERS = """
typed AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS booking_id,
         o.o_orderstatus AS trip_status,
         o.o_orderdate AS pickup_due_ts,
         o.o_orderdate - (4 * l.l_linenumber) * INTERVAL 1 MINUTE AS time_dispatched_ts,
         o.o_orderdate + CAST(round(l.l_tax * 100) AS BIGINT) * INTERVAL 1 MINUTE
           AS time_vehicle_arrived_ts,
         o.o_orderdate + CAST(round(l.l_discount * 100) AS BIGINT) * INTERVAL 1 MINUTE
           AS time_picked_up_ts,
         o.o_orderdate + CAST(round(l.l_discount * 100) AS BIGINT) * INTERVAL 1 MINUTE
           + ((CAST(l.l_quantity AS BIGINT) * l.l_linenumber) // 2) * INTERVAL 1 MINUTE
           AS completed_ts,
         CAST(l.l_suppkey AS VARCHAR) AS driver,
         CAST(l.l_partkey AS VARCHAR) AS vehicle,
         o.o_orderpriority AS payment_type,
         CAST(l.l_linenumber AS INTEGER) AS priority,
         CASE WHEN l.l_returnflag = 'R' THEN 'Z' ELSE l.l_returnflag END AS capabilities,
         c.c_mktsegment AS booking_source,
         l.l_extendedprice AS price,
         l.l_quantity AS distance,
         pn.n_name AS pickup_zone,
         dn.n_name AS destination_zone,
         c.c_acctbal AS pickup_latitude,
         CAST(c.c_custkey AS DOUBLE) * CAST(-0.001 AS DOUBLE) AS pickup_longitude,
         s.s_acctbal AS destination_latitude,
         CAST(s.s_suppkey AS DOUBLE) * CAST(-0.01 AS DOUBLE) AS destination_longitude,
         c.c_name AS booked_by
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation pn ON c.c_nationkey = pn.n_nationkey
  LEFT JOIN nation dn ON s.s_nationkey = dn.n_nationkey
)"""

TYPED_EVENTS = """
typed AS (
  SELECT CAST(e.event_id AS VARCHAR) AS booking_id,
         'completed' AS trip_status,
         e.ts AS pickup_due_ts,
         CAST(NULL AS TIMESTAMP) AS time_dispatched_ts,
         CAST(NULL AS TIMESTAMP) AS time_vehicle_arrived_ts,
         e.ts AS time_picked_up_ts,
         e.ts + CAST(round(e.value * 60) AS BIGINT) * INTERVAL 1 SECOND AS completed_ts,
         CAST(e.user_id AS VARCHAR) AS driver,
         CAST(NULL AS VARCHAR) AS vehicle,
         e.event_type AS payment_type,
         CAST(NULL AS INTEGER) AS priority,
         CAST(NULL AS VARCHAR) AS capabilities,
         'app' AS booking_source,
         e.value AS price,
         e.value * CAST(0.25 AS DOUBLE) AS distance,
         pn.n_name AS pickup_zone,
         CAST(NULL AS VARCHAR) AS destination_zone,
         c.c_acctbal AS pickup_latitude,
         CAST(c.c_custkey AS DOUBLE) * CAST(-0.001 AS DOUBLE) AS pickup_longitude,
         CAST(NULL AS DOUBLE) AS destination_latitude,
         CAST(NULL AS DOUBLE) AS destination_longitude,
         CAST(NULL AS VARCHAR) AS booked_by
  FROM events e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation pn ON c.c_nationkey = pn.n_nationkey
)"""

DEDUP_DESC = [
    "completed_ts", "time_picked_up_ts", "time_dispatched_ts", "time_vehicle_arrived_ts",
    "pickup_due_ts", "price", "distance", "vehicle", "driver", "trip_status", "payment_type",
    "priority", "capabilities", "booking_source", "pickup_zone", "destination_zone",
    "pickup_latitude", "pickup_longitude", "destination_latitude", "destination_longitude",
    "booked_by",
]
BLANKABLE = ["booking_id", "trip_status", "payment_type", "booking_source", "pickup_zone",
             "destination_zone"]
SILVER_COLS = [
    "booking_id", "trip_status", "pickup_due_ts", "time_dispatched_ts", "time_vehicle_arrived_ts",
    "time_picked_up_ts", "completed_ts", "driver", "vehicle", "payment_type", "priority",
    "capabilities", "booking_source", "price", "distance", "pickup_zone", "destination_zone",
    "pickup_latitude", "pickup_longitude", "destination_latitude", "destination_longitude",
    "booked_by",
]
CONFORMED = ["payment_type", "booking_source", "pickup_zone", "destination_zone", "trip_status"]


def silver_ctes(source: str = "orders", typed_from: str = "typed") -> str:
    as_of = AS_OF[source]
    blank = ",\n         ".join(
        f"CASE WHEN trim({c}) = '' THEN NULL ELSE {c} END AS {c}" if c in BLANKABLE else c
        for c in SILVER_COLS)
    order = ", ".join(f"{c} DESC NULLS LAST" for c in DEDUP_DESC)
    conform = ",\n         ".join(
        f"{initcap(f'trim({c})')} AS {c}" if c in CONFORMED else c for c in SILVER_COLS)
    return f"""
clean0 AS (
  SELECT {blank}
  FROM {typed_from}
),
clean AS (
  SELECT * REPLACE (CASE WHEN capabilities = 'Z' THEN 'card' ELSE payment_type END AS payment_type)
  FROM clean0
  WHERE pickup_due_ts IS NULL OR pickup_due_ts <= TIMESTAMP '{as_of}'
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY booking_id ORDER BY {order}) AS _rn FROM clean
),
silver_taxi AS (
  SELECT {conform}
  FROM ranked WHERE _rn = 1
)"""


WEATHER_CTES = f"""
w_raw AS (
  SELECT CAST(l_suppkey AS INTEGER) AS loc_id,
         CAST(l_shipdate AS DATE) AS date,
         CAST(round(l_discount * 100) AS INTEGER) AS avg_temp_c,
         l_tax AS total_precip_mm,
         CAST(l_linenumber * 5 AS INTEGER) AS wind_speed_kmph,
         CAST(floor(l_quantity * 2.2) AS INTEGER) AS humidity,
         CAST(10 - l_linenumber AS INTEGER) AS visibility_km,
         CAST(l_linenumber * 16 AS INTEGER) AS cloud_cover,
         CAST(1000 + CAST(round(l_tax * 100) AS INTEGER) AS INTEGER) AS pressure_mb,
         {_lst(WEATHER_DESCS)}[l_linenumber] AS weather_desc
  FROM lineitem
),
w_ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY loc_id, date
    ORDER BY avg_temp_c ASC NULLS FIRST, total_precip_mm ASC NULLS FIRST,
             wind_speed_kmph ASC NULLS FIRST, humidity ASC NULLS FIRST,
             visibility_km ASC NULLS FIRST, cloud_cover ASC NULLS FIRST,
             pressure_mb ASC NULLS FIRST, weather_desc ASC NULLS FIRST) AS _rn
  FROM w_raw
),
silver_weather AS (
  SELECT loc_id, date, avg_temp_c, total_precip_mm, wind_speed_kmph, humidity, visibility_km,
         cloud_cover, pressure_mb, weather_desc
  FROM w_ranked
  WHERE _rn = 1 AND humidity BETWEEN 0 AND 100 AND cloud_cover BETWEEN 0 AND 100
    AND avg_temp_c IS NOT NULL AND date IS NOT NULL
),
weather_daily AS (
  SELECT date,
         avg(avg_temp_c) AS avg_temp_c,
         sum(total_precip_mm) AS total_precip_mm,
         avg(wind_speed_kmph) AS avg_wind_speed_kmph,
         avg(humidity) AS avg_humidity,
         avg(visibility_km) AS avg_visibility_km,
         avg(cloud_cover) AS avg_cloud_cover,
         avg(pressure_mb) AS avg_pressure_mb,
         arg_min(weather_desc, loc_id) AS weather_desc
  FROM silver_weather GROUP BY date
)"""

STAR_CTES = f"""
trip_dates AS (
  SELECT DISTINCT CAST(pickup_due_ts AS DATE) AS full_date FROM silver_taxi
  WHERE pickup_due_ts IS NOT NULL
),
dim_date AS (
  SELECT CAST(year(t.full_date) * 10000 + month(t.full_date) * 100 + day(t.full_date) AS INTEGER)
           AS date_key,
         t.full_date,
         CAST(day(t.full_date) AS INTEGER) AS day,
         dayname(t.full_date) AS day_name,
         CAST(weekofyear(t.full_date) AS INTEGER) AS week,
         CAST(month(t.full_date) AS INTEGER) AS month,
         monthname(t.full_date) AS month_name,
         CAST(quarter(t.full_date) AS INTEGER) AS quarter,
         CAST(year(t.full_date) AS INTEGER) AS year,
         dayofweek(t.full_date) IN (0, 6) AS weekend_flag,
         w.avg_temp_c, w.total_precip_mm, w.avg_wind_speed_kmph, w.avg_humidity,
         w.avg_visibility_km, w.avg_cloud_cover, w.avg_pressure_mb, w.weather_desc
  FROM trip_dates t LEFT JOIN weather_daily w ON w.date = t.full_date
),
zones_all AS (
  SELECT pickup_zone AS zone_code, pickup_latitude AS latitude, pickup_longitude AS longitude
  FROM silver_taxi
  UNION ALL
  SELECT destination_zone, destination_latitude, destination_longitude FROM silver_taxi
),
zones_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY zone_code
                               ORDER BY latitude ASC NULLS FIRST, longitude ASC NULLS FIRST) AS _rn
  FROM zones_all WHERE zone_code IS NOT NULL
),
dim_zone AS (
  SELECT CAST(row_number() OVER (ORDER BY zone_code) - 1 AS INTEGER) AS zone_key,
         zone_code, latitude, longitude
  FROM zones_ranked WHERE _rn = 1
),
fact_trip AS (
  SELECT CAST(row_number() OVER (ORDER BY d.date_key ASC NULLS FIRST, s.booking_id ASC NULLS FIRST)
              - 1 AS BIGINT) AS trip_key,
         s.booking_id,
         d.date_key AS trip_booked_for_date_key,
         pz.zone_key AS pickup_zone_key,
         dz.zone_key AS destination_zone_key,
         s.trip_status AS status,
         s.payment_type,
         s.booking_source,
         s.driver AS driver_id,
         s.vehicle AS vehicle_id,
         s.priority AS priority_level,
         s.capabilities,
         s.booked_by AS dispatcher_id,
         s.price AS fare_amount,
         s.time_dispatched_ts AS dispatch_timestamp,
         s.pickup_due_ts AS pickup_due_timestamp,
         s.distance,
         {minutes('s.time_picked_up_ts', 's.pickup_due_ts')}
           AS expected_vs_actual_pickup_minutes_difference,
         {minutes('s.time_vehicle_arrived_ts', 's.time_dispatched_ts')} AS dispatch_to_arrival_minutes,
         {minutes('s.completed_ts', 's.time_picked_up_ts')} AS trip_duration_minutes
  FROM silver_taxi s
  LEFT JOIN dim_date d ON CAST(s.pickup_due_ts AS DATE) = d.full_date
  LEFT JOIN dim_zone pz ON s.pickup_zone = pz.zone_code
  LEFT JOIN dim_zone dz ON s.destination_zone = dz.zone_code
),
daily_kpis AS (
  SELECT d.full_date, d.day_name,
         sum(f.fare_amount) AS total_revenue,
         round(avg(f.trip_duration_minutes), 2) AS avg_trip_duration_min,
         count(f.trip_key) AS total_trips,
         round(avg(f.distance), 2) AS avg_distance_km
  FROM fact_trip f JOIN dim_date d ON f.trip_booked_for_date_key = d.date_key
  GROUP BY d.full_date, d.day_name
),
zone_daily AS (
  SELECT trip_booked_for_date_key, pickup_zone_key,
         sum(fare_amount) AS total_revenue, count(*) AS total_trips
  FROM fact_trip GROUP BY trip_booked_for_date_key, pickup_zone_key
),
hourly_trips AS (
  SELECT d.full_date AS trip_date, d.day_name, CAST(h.hour_of_day AS INTEGER) AS hour_of_day,
         h.trip_count
  FROM (SELECT trip_booked_for_date_key, hour(pickup_due_timestamp) AS hour_of_day,
               count(*) AS trip_count
        FROM fact_trip GROUP BY 1, 2) h
  JOIN dim_date d ON h.trip_booked_for_date_key = d.date_key
)"""


def with_star(body: str, source: str = "orders", typed: str | None = None) -> str:
    typed_cte = typed or (TYPED_ORDERS if source == "orders" else TYPED_EVENTS)
    return ("WITH " + typed_cte.strip() + "," + silver_ctes(source) + "," + WEATHER_CTES + ","
            + STAR_CTES + "\n" + body.strip())


def r(expr: str, n: int = 4) -> str:
    return f"round({expr}, {n})"


WEATHER_MEASURES = ["avg_temp_c", "total_precip_mm", "avg_wind_speed_kmph", "avg_humidity",
                    "avg_visibility_km", "avg_cloud_cover", "avg_pressure_mb"]


def _trips_where(f) -> str:
    """Filtered trips (fact JOIN dim_date) for a TripFilter."""
    conds = ["TRUE"]
    if f is not None:
        if f.start:
            conds.append(f"d.full_date >= DATE '{f.start}'")
        if f.end:
            conds.append(f"d.full_date <= DATE '{f.end}'")
        if f.days:
            conds.append(f"d.day_name IN {_in(f.days)}")
        if f.zones:
            conds.append(f"f.pickup_zone_key IN (SELECT zone_key FROM dim_zone WHERE zone_code IN "
                         f"{_in(f.zones)})")
        if f.payment_types:
            conds.append(f"f.payment_type IN {_in(f.payment_types)}")
    return (",\ntrips AS (SELECT f.*, d.full_date, d.day_name FROM fact_trip f "
            "JOIN dim_date d ON f.trip_booked_for_date_key = d.date_key WHERE "
            + " AND ".join(conds) + ")\n")


def with_trips(body: str, f=None) -> str:
    sql = with_star("", "orders")
    return sql + _trips_where(f) + body.strip()


def _weather_where(f) -> str:
    conds = ["d.avg_temp_c IS NOT NULL"]
    if f is not None:
        if f.start:
            conds.append(f"k.full_date >= DATE '{f.start}'")
        if f.end:
            conds.append(f"k.full_date <= DATE '{f.end}'")
        if f.days:
            conds.append(f"k.day_name IN {_in(f.days)}")
        if f.weather:
            conds.append(f"d.weather_desc IN {_in(f.weather)}")
    return (",\nwdays AS (SELECT k.*, d.avg_temp_c, d.total_precip_mm, d.avg_wind_speed_kmph, "
            "d.avg_humidity, d.weather_desc FROM daily_kpis k JOIN dim_date d "
            "ON k.full_date = d.full_date WHERE " + " AND ".join(conds) + ")\n")


def with_weather_days(body: str, f=None) -> str:
    return with_star("", "orders") + _weather_where(f) + body.strip()


def _hourly_where(f) -> str:
    conds = ["TRUE"]
    if f is not None:
        if f.start:
            conds.append(f"h.trip_date >= DATE '{f.start}'")
        if f.end:
            conds.append(f"h.trip_date <= DATE '{f.end}'")
        if f.days:
            conds.append(f"h.day_name IN {_in(f.days)}")
        if f.hours:
            conds.append("h.hour_of_day IN (" + ", ".join(str(x) for x in f.hours) + ")")
        if f.weather:
            conds.append(f"h.trip_date IN (SELECT full_date FROM dim_date WHERE weather_desc IN "
                         f"{_in(f.weather)})")
    return (",\nhourly AS (SELECT h.* FROM hourly_trips h WHERE " + " AND ".join(conds) + ")\n")


def with_hourly(body: str, f=None) -> str:
    return with_star("", "events") + _hourly_where(f) + body.strip()


def _zone_map_sql(f=None) -> str:
    conds = ["TRUE"]
    if f is not None:
        if f.start:
            conds.append(f"d.full_date >= DATE '{f.start}'")
        if f.end:
            conds.append(f"d.full_date <= DATE '{f.end}'")
        if f.days:
            conds.append(f"d.day_name IN {_in(f.days)}")
        if f.zones:
            conds.append(f"z.pickup_zone_key IN (SELECT zone_key FROM dim_zone WHERE zone_code IN "
                         f"{_in(f.zones)})")
    return with_star("", "orders") + (
        ",\nzmap AS (SELECT g.pickup_zone_key, dz.zone_code, dz.latitude, dz.longitude, "
        "g.total_revenue, g.total_trips, "
        "g.total_revenue / CASE WHEN g.total_trips = 0 THEN 1 ELSE g.total_trips END "
        "AS revenue_per_trip FROM (SELECT z.pickup_zone_key, "
        "coalesce(sum(z.total_revenue), 0.0) AS total_revenue, "
        "CAST(sum(z.total_trips) AS BIGINT) AS total_trips FROM zone_daily z "
        "JOIN dim_date d ON z.trip_booked_for_date_key = d.date_key WHERE "
        + " AND ".join(conds) + " AND z.pickup_zone_key IS NOT NULL GROUP BY z.pickup_zone_key) g "
        "JOIN dim_zone dz ON dz.zone_key = g.pickup_zone_key)\n")


def _features_sql() -> str:
    return with_star("", "orders") + """,
fview AS (
  SELECT f.trip_key, f.booking_id, f.status, f.payment_type, f.booking_source, f.priority_level,
         f.fare_amount, f.distance, f.dispatch_to_arrival_minutes,
         f.expected_vs_actual_pickup_minutes_difference, f.trip_duration_minutes,
         d.day, d.month, d.quarter, d.year, d.weekend_flag,
         p.zone_code AS pickup_zone_code, p.latitude AS pickup_latitude,
         p.longitude AS pickup_longitude,
         q.zone_code AS destination_zone_code, q.latitude AS destination_latitude,
         q.longitude AS destination_longitude
  FROM fact_trip f
  LEFT JOIN dim_date d ON f.trip_booked_for_date_key = d.date_key
  LEFT JOIN dim_zone p ON f.pickup_zone_key = p.zone_key
  LEFT JOIN dim_zone q ON f.destination_zone_key = q.zone_key
  WHERE f.trip_duration_minutes IS NOT NULL
),
feat AS (
  SELECT trip_key, booking_id, priority_level, status, payment_type, booking_source, fare_amount,
         distance, expected_vs_actual_pickup_minutes_difference,
         coalesce(dispatch_to_arrival_minutes, 0.0) AS dispatch_to_arrival_minutes,
         month, quarter, year, weekend_flag, pickup_latitude, pickup_longitude,
         destination_latitude, destination_longitude,
         fare_amount / (distance + 1e-6) AS fare_per_distance,
         expected_vs_actual_pickup_minutes_difference AS pickup_delay_signal,
         dispatch_to_arrival_minutes + expected_vs_actual_pickup_minutes_difference
           AS journey_urgency,
         abs(pickup_latitude - destination_latitude) AS lat_delta,
         abs(pickup_longitude - destination_longitude) AS lon_delta,
         sqrt(abs(pickup_latitude - destination_latitude) * abs(pickup_latitude - destination_latitude)
              + abs(pickup_longitude - destination_longitude)
                * abs(pickup_longitude - destination_longitude)) AS location_distance_proxy,
         trip_duration_minutes
  FROM fview
  WHERE destination_latitude IS NOT NULL AND destination_longitude IS NOT NULL
    AND trip_duration_minutes > 0 AND trip_duration_minutes < 120
    AND distance > 0 AND distance < 200 AND fare_amount > 0 AND fare_amount < 5000
)
"""


def _split_sql() -> str:
    return "CAST(('0x' || substr(md5(coalesce(booking_id, '') || ':42'), 1, 8)) AS BIGINT) % 100"


VIEW_COLS = [
    "trip_key", "booking_id", "status", "payment_type", "booking_source", "priority_level",
    "fare_amount", "distance", "dispatch_to_arrival_minutes",
    "expected_vs_actual_pickup_minutes_difference", "trip_duration_minutes", "day", "month",
    "quarter", "year", "weekend_flag", "pickup_zone_code", "pickup_latitude", "pickup_longitude",
    "destination_zone_code", "destination_latitude", "destination_longitude",
]

DETAIL_COLS = ("t.booking_id, t.full_date, t.day_name, z.zone_code AS pickup_zone, t.status, "
               "t.payment_type, t.fare_amount, t.distance, t.trip_duration_minutes, "
               "t.booking_source, t.priority_level")


def _heatmap_sql(fn: str) -> str:
    cells = ", ".join(
        (f"round(CAST(avg(CASE WHEN hour_of_day = {h} THEN trip_count END) AS DOUBLE), 4) AS h{h:02d}"
         if fn == "avg" else
         f"CAST(sum(CASE WHEN hour_of_day = {h} THEN trip_count END) AS DOUBLE) AS h{h:02d}")
        for h in range(24))
    return with_hourly(f"SELECT day_name, {weekday_index('day_name')} AS day_index, {cells} "
                       "FROM hourly GROUP BY day_name")


def build() -> dict[str, str]:
    from ridemart.plans.catalog import DEMO_FILTER, DEMO_HOUR_FILTER, DEMO_WEATHER_FILTER

    wm = ", ".join(f"round({c}, 4) AS {c}" for c in WEATHER_MEASURES)
    as_of_day = dt.date.fromisoformat(AS_OF["orders"][:10])
    week_start, week_end = as_of_day - dt.timedelta(days=7), as_of_day - dt.timedelta(days=1)
    blank_typed = TYPED_ORDERS.replace("typed AS (", "typed0 AS (", 1) + """,
typed AS (
  SELECT * REPLACE (CASE WHEN split_part(booking_id, '-', 1) LIKE '%0' THEN NULL
                         ELSE payment_type END AS payment_type)
  FROM typed0
)"""
    q: dict[str, str] = {}
    q["WIN1_silver_taxi"] = with_star("SELECT * FROM silver_taxi")
    q["SNK5_fact_from_files"] = with_star("SELECT * FROM fact_trip", typed=blank_typed)
    q["FLT2_future_pickup_report"] = (
        "WITH " + TYPED_ORDERS.strip() + "\nSELECT count(*) AS rows_in, "
        f"count(*) FILTER (WHERE pickup_due_ts IS NOT NULL AND pickup_due_ts > TIMESTAMP '{AS_OF['orders']}') "
        "AS rows_removed, "
        f"count(*) FILTER (WHERE pickup_due_ts IS NULL OR pickup_due_ts <= TIMESTAMP '{AS_OF['orders']}') "
        "AS rows_kept FROM typed")
    q["PRJ1_bronze_text_to_silver"] = with_star("SELECT * FROM silver_taxi", typed=blank_typed)
    q["FLT3_silver_weather"] = with_star("SELECT * FROM silver_weather")
    q["AGG1_weather_daily"] = with_star(f"SELECT date, {wm}, weather_desc FROM weather_daily")
    q["JN1_dim_date"] = with_star(
        "SELECT date_key, full_date, day, day_name, week, month, month_name, quarter, year, "
        f"weekend_flag, {wm}, weather_desc FROM dim_date")
    q["WIN4_dim_zone"] = with_star("SELECT * FROM dim_zone")
    q["JN4_fact_trip"] = with_star("SELECT * FROM fact_trip")
    q["WIN1_event_silver_taxi"] = with_star("SELECT * FROM silver_taxi", "events")
    q["JN4_event_fact_trip"] = with_star("SELECT * FROM fact_trip", "events")
    q["AGG2_daily_kpis"] = with_star(
        "SELECT full_date, day_name, round(total_revenue, 2) AS total_revenue, "
        "avg_trip_duration_min, total_trips, avg_distance_km FROM daily_kpis")
    q["AGG23_zone_daily"] = with_star(
        "SELECT trip_booked_for_date_key, pickup_zone_key, round(total_revenue, 2) AS total_revenue,"
        " total_trips FROM zone_daily")
    q["AGG24_hourly_trips"] = with_star("SELECT * FROM hourly_trips", "events")

    q["AGG3_monthly_revenue"] = with_star(
        "SELECT d.year, d.month_name, d.month, round(sum(f.fare_amount), 2) AS total_revenue, "
        "count(f.trip_key) AS total_trips FROM fact_trip f JOIN dim_date d "
        "ON f.trip_booked_for_date_key = d.date_key GROUP BY d.year, d.month_name, d.month")
    q["AGG4_trips_per_hour_weekday"] = with_star(
        "SELECT CAST(hour(f.pickup_due_timestamp) AS INTEGER) AS pickup_hour, d.day_name, "
        "count(*) AS num_trips FROM fact_trip f JOIN dim_date d "
        "ON f.trip_booked_for_date_key = d.date_key GROUP BY 1, 2", "events")
    q["AGG5_revenue_by_zone_payment"] = with_star(
        "SELECT z.zone_code, f.payment_type, round(sum(f.fare_amount), 2) AS revenue "
        "FROM fact_trip f JOIN dim_zone z ON f.pickup_zone_key = z.zone_key "
        "GROUP BY z.zone_code, f.payment_type")
    q["AGG6_top_zones"] = with_star(
        "SELECT pickup_zone, trips, round(revenue, 2) AS revenue FROM ("
        "SELECT z.zone_code AS pickup_zone, count(f.trip_key) AS trips, "
        "sum(f.fare_amount) AS revenue FROM fact_trip f JOIN dim_zone z "
        "ON f.pickup_zone_key = z.zone_key GROUP BY z.zone_code "
        "ORDER BY revenue DESC NULLS LAST, pickup_zone LIMIT 15)")
    q["AGG7_wait_by_weekday"] = with_star(
        "SELECT d.day_name, round(avg(f.expected_vs_actual_pickup_minutes_difference), 2) "
        "AS avg_wait_min, round(avg(f.trip_duration_minutes), 2) AS avg_trip_duration "
        "FROM fact_trip f JOIN dim_date d ON f.trip_booked_for_date_key = d.date_key "
        "WHERE f.expected_vs_actual_pickup_minutes_difference IS NOT NULL GROUP BY d.day_name")

    kpi = ("SELECT round(coalesce(sum(fare_amount), 0.0), 2) AS total_revenue, "
           "count(*) AS total_trips, round(avg(trip_duration_minutes), 4) AS avg_duration_min, "
           "round(avg(distance), 4) AS avg_distance_km FROM trips")
    q["AGG8_kpi_cards"] = with_trips(kpi)
    q["FLT10_kpi_cards_filtered"] = with_trips(kpi, DEMO_FILTER)
    q["AGG9_monthly_revenue_trend"] = with_trips(
        "SELECT CAST(month(full_date) AS INTEGER) AS month_num, monthname(full_date) AS month_name, "
        "round(coalesce(sum(fare_amount), 0.0), 2) AS revenue FROM trips GROUP BY 1, 2")
    q["AGG10_top15_zones_filtered"] = with_trips(
        "SELECT zone_code, round(revenue, 2) AS revenue FROM (SELECT z.zone_code, "
        "coalesce(sum(t.fare_amount), 0.0) AS revenue FROM trips t JOIN dim_zone z "
        "ON t.pickup_zone_key = z.zone_key GROUP BY z.zone_code "
        "ORDER BY revenue DESC, zone_code LIMIT 15)", DEMO_FILTER)
    q["AGG11_duration_by_weekday"] = with_trips(
        "SELECT day_name, round(avg(trip_duration_minutes), 4) AS avg_duration_min, "
        f"{weekday_index('day_name')} AS day_index FROM trips WHERE day_name IS NOT NULL "
        "GROUP BY day_name")
    q["AGG12_revenue_zone_payment_top10"] = with_trips(""",
pairs AS (SELECT z.zone_code, t.payment_type, coalesce(sum(t.fare_amount), 0.0) AS revenue
          FROM trips t JOIN dim_zone z ON t.pickup_zone_key = z.zone_key
          WHERE t.payment_type IS NOT NULL GROUP BY z.zone_code, t.payment_type),
top AS (SELECT zone_code FROM pairs GROUP BY zone_code ORDER BY sum(revenue) DESC, zone_code
        LIMIT 10)
SELECT zone_code, payment_type, round(revenue, 2) AS revenue FROM pairs
WHERE zone_code IN (SELECT zone_code FROM top)""")
    zcols = ("pickup_zone_key, zone_code, latitude, longitude, round(total_revenue, 2) AS "
             "total_revenue, total_trips, round(revenue_per_trip, 4) AS revenue_per_trip")
    q["AGG13_zone_revenue_map"] = _zone_map_sql() + f"SELECT {zcols} FROM zmap"
    q["AGG14_zone_revenue_map_filtered"] = _zone_map_sql(DEMO_FILTER) + f"SELECT {zcols} FROM zmap"
    q["AGG15_zone_revenue_summary"] = (_zone_map_sql() +
                                       "SELECT zone_code, round(total_revenue, 2) AS total_revenue "
                                       "FROM zmap")
    hb = ("SELECT hour_of_day, day_name, CAST(sum(trip_count) AS BIGINT) AS trip_count, "
          f"{weekday_index('day_name')} AS day_index FROM hourly GROUP BY hour_of_day, day_name")
    q["AGG16_hourly_by_day"] = with_hourly(hb)
    q["FLT11_hourly_by_day_filtered"] = with_hourly(hb, DEMO_HOUR_FILTER)
    q["AGG17_avg_trips_heatmap"] = _heatmap_sql("avg")
    q["AGG18_total_trips_heatmap"] = _heatmap_sql("sum")
    wat = ("SELECT weather_desc, round(avg(total_trips), 4) AS avg_trips, "
           "count(total_trips) AS count_days FROM wdays WHERE weather_desc IS NOT NULL "
           "GROUP BY weather_desc HAVING count(total_trips) >= 3")
    q["AGG19_weather_avg_daily_trips"] = with_weather_days(wat)
    q["FLT12_weather_avg_daily_trips_filtered"] = with_weather_days(wat, DEMO_WEATHER_FILTER)
    g = weather_group("weather_desc")
    q["AGG20_trips_by_day_weather_group"] = with_weather_days(
        f"SELECT day_name, {g} AS weather_group, CAST(sum(total_trips) AS BIGINT) AS total_trips, "
        f"{weekday_index('day_name')} AS day_index, "
        f"CAST(list_position({GROUP_LIST}, {g}) AS INTEGER) AS group_index "
        "FROM wdays GROUP BY 1, 2")
    q["AGG21_revenue_by_weather_group"] = with_weather_days(
        f"SELECT {g} AS weather_group, round(avg(total_revenue), 2) AS avg_daily_revenue, "
        f"CAST(list_position({GROUP_LIST}, {g}) AS INTEGER) AS group_index FROM wdays GROUP BY 1")
    q["AGG22_duration_by_weather"] = with_weather_days(
        "SELECT weather_desc, round(avg(avg_trip_duration_min), 4) AS avg_duration, "
        "count(avg_trip_duration_min) AS count_days FROM wdays WHERE weather_desc IS NOT NULL "
        "GROUP BY weather_desc HAVING count(avg_trip_duration_min) >= 3")
    q["AGG26_date_range"] = with_star(
        "SELECT min(full_date) AS min_date, max(full_date) AS max_date FROM dim_date")
    days_values = ", ".join(f"('{d}')" for d in WEEKDAYS)
    q["FLT14_filter_options"] = with_star(f"""
, o AS (SELECT 'zone' AS option, zone_code AS value FROM (SELECT DISTINCT zone_code FROM dim_zone
                                                  WHERE zone_code IS NOT NULL)
UNION ALL SELECT 'payment', payment_type FROM (SELECT DISTINCT payment_type FROM fact_trip
                                               WHERE payment_type IS NOT NULL)
UNION ALL SELECT 'weather', weather_desc FROM (SELECT DISTINCT weather_desc FROM dim_date
                                               WHERE weather_desc IS NOT NULL)
UNION ALL SELECT 'hour', lpad(CAST(h AS VARCHAR), 2, '0') || ':00' FROM range(24) t(h)
UNION ALL SELECT 'day', v FROM (VALUES {days_values}) t(v)
UNION ALL SELECT 'min_date', CAST(min(full_date) AS VARCHAR) FROM dim_date
UNION ALL SELECT 'max_date', CAST(max(full_date) AS VARCHAR) FROM dim_date)
SELECT option, value, CAST(row_number() OVER (PARTITION BY option ORDER BY
       CASE WHEN option = 'day' THEN list_position(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'], value) END,
       value) AS INTEGER) AS position FROM o""")
    q["ORD5_trip_details_page"] = with_trips(f"""
, n AS (SELECT count(*) AS c FROM trips)
SELECT {DETAIL_COLS},
       CAST(least(greatest(1, 3), greatest(1, (SELECT (c + 49) // 50 FROM n))) AS INTEGER) AS page,
       CAST(greatest(1, (SELECT (c + 49) // 50 FROM n)) AS INTEGER) AS total_pages
FROM trips t LEFT JOIN dim_zone z ON t.pickup_zone_key = z.zone_key
ORDER BY t.full_date DESC NULLS LAST, t.trip_key
LIMIT 50 OFFSET (SELECT (least(greatest(1, 3), greatest(1, (c + 49) // 50)) - 1) * 50 FROM n)
""", DEMO_FILTER)

    q["BQ1_revenue_last_week"] = with_star(
        f"SELECT DATE '{week_start}' AS week_start, DATE '{week_end}' AS week_end, "
        "round(coalesce(sum(f.fare_amount), 0.0), 2) AS total_revenue, count(*) AS total_trips "
        "FROM fact_trip f JOIN dim_date d ON f.trip_booked_for_date_key = d.date_key "
        f"WHERE d.full_date >= DATE '{week_start}' AND d.full_date < DATE '{as_of_day}'")
    q["BQ2_zones_most_trips"] = with_star(
        "SELECT pickup_zone, trips, round(revenue, 2) AS revenue FROM ("
        "SELECT z.zone_code AS pickup_zone, count(*) AS trips, sum(f.fare_amount) AS revenue "
        "FROM fact_trip f JOIN dim_zone z ON f.pickup_zone_key = z.zone_key "
        "GROUP BY z.zone_code ORDER BY trips DESC, pickup_zone LIMIT 10)")
    q["BQ3_weather_duration_effect"] = with_star("""
SELECT d.weather_desc, count(*) AS days, CAST(sum(p.dn) AS BIGINT) AS trips_with_duration,
       round(avg(k.avg_trip_duration_min), 4) AS mean_of_daily_avg_duration,
       round(sum(p.ds) / sum(p.dn), 4) AS trip_weighted_avg_duration
FROM (SELECT trip_booked_for_date_key AS dk, sum(trip_duration_minutes) AS ds,
             count(trip_duration_minutes) AS dn FROM fact_trip GROUP BY 1) p
JOIN dim_date d ON p.dk = d.date_key
JOIN daily_kpis k ON k.full_date = d.full_date
WHERE d.weather_desc IS NOT NULL
GROUP BY d.weather_desc""")
    q["BQ4_avg_fare_by_weekday"] = with_star(
        f"SELECT d.day_name, round(avg(f.fare_amount), 2) AS avg_fare, "
        f"{weekday_index('d.day_name')} AS day_index FROM fact_trip f JOIN dim_date d "
        "ON f.trip_booked_for_date_key = d.date_key GROUP BY d.day_name")
    q["BQ5_busiest_hour_per_weekday"] = with_star(f"""
SELECT pickup_hour, day_name, num_trips, {weekday_index('day_name')} AS day_index FROM (
  SELECT *, row_number() OVER (PARTITION BY day_name ORDER BY num_trips DESC, pickup_hour) AS rn
  FROM (SELECT CAST(hour(f.pickup_due_timestamp) AS INTEGER) AS pickup_hour, d.day_name,
               count(*) AS num_trips
        FROM fact_trip f JOIN dim_date d ON f.trip_booked_for_date_key = d.date_key
        GROUP BY 1, 2)) WHERE rn = 1""", "events")
    q["BQ5_busiest_hour_overall"] = with_star("""
SELECT CAST(hour(f.pickup_due_timestamp) AS INTEGER) AS pickup_hour, count(*) AS num_trips
FROM fact_trip f JOIN dim_date d ON f.trip_booked_for_date_key = d.date_key
GROUP BY 1 ORDER BY num_trips DESC, pickup_hour LIMIT 1""", "events")
    q["BQ6_revenue_rainy_vs_dry"] = with_weather_days(
        f"SELECT CASE WHEN {g} IN ('Light Rain', 'Heavy Rain') THEN 'Rainy' ELSE 'Dry' END "
        "AS day_type, count(*) AS days, round(avg(total_revenue), 2) AS avg_daily_revenue, "
        "round(sum(total_revenue), 2) AS total_revenue FROM wdays GROUP BY 1")
    q["BQ7_trip_details"] = with_trips(
        f"SELECT {DETAIL_COLS} FROM trips t LEFT JOIN dim_zone z ON t.pickup_zone_key = z.zone_key",
        DEMO_FILTER)

    fsql = _features_sql()
    feat_cols = ", ".join(
        f"round({c}, 4) AS {c}" if c in ("fare_per_distance", "lat_delta", "lon_delta",
                                          "location_distance_proxy") else c
        for c in ["trip_key", "booking_id", "priority_level", "status", "payment_type",
                  "booking_source", "fare_amount", "distance",
                  "expected_vs_actual_pickup_minutes_difference", "dispatch_to_arrival_minutes",
                  "month", "quarter", "year", "weekend_flag", "pickup_latitude", "pickup_longitude",
                  "destination_latitude", "destination_longitude", "fare_per_distance",
                  "pickup_delay_signal", "journey_urgency", "lat_delta", "lon_delta",
                  "location_distance_proxy", "trip_duration_minutes"])
    q["ML1_trip_features"] = fsql + f"SELECT {feat_cols} FROM feat"
    q["ML3_train_test_split"] = fsql + (
        f"SELECT CASE WHEN {_split_sql()} < 20 THEN 'test' ELSE 'train' END AS split, "
        "count(*) AS rows, round(avg(trip_duration_minutes), 4) AS avg_target FROM feat GROUP BY 1")
    q["AGG25_feature_null_profile"] = fsql + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM fview"
        for c in VIEW_COLS)
    q["AGG27_feature_medians"] = fsql + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, round(median(CAST({c} AS DOUBLE)), 4) AS median FROM feat "
        f"HAVING count({c}) > 0"
        for c in NUMERIC_FEATURES)
    return q


def _rule_rows(rules: list[tuple[str, str, str]], source: str) -> str:
    """(name, mode, SQL condition) -> report rows in the DQ4 shape."""
    return "\nUNION ALL\n".join(
        f"SELECT '{n}' AS rule, '{m}' AS mode, count(*) AS rows_checked, "
        f"count(*) FILTER (WHERE coalesce({c}, FALSE)) AS passed, "
        f"count(*) FILTER (WHERE NOT coalesce({c}, FALSE)) AS failed FROM {source}"
        for n, m, c in rules)


WEATHER_RULES_SQL = [
    ("humidity_in_range", "drop", "humidity BETWEEN 0 AND 100"),
    ("cloud_cover_in_range", "drop", "cloud_cover BETWEEN 0 AND 100"),
    ("temperature_present", "drop", "avg_temp_c IS NOT NULL"),
    ("date_present", "drop", "date IS NOT NULL"),
]
TRIP_RULES_SQL = [
    ("booking_id_present", "drop", "booking_id IS NOT NULL"),
    ("pickup_due_present", "expect", "pickup_due_ts IS NOT NULL"),
    ("price_non_negative", "drop", "price >= 0"),
    ("distance_non_negative", "drop", "distance >= 0"),
    ("completed_after_pickup", "expect", "completed_ts >= time_picked_up_ts"),
    ("pickup_zone_present", "expect", "pickup_zone IS NOT NULL"),
    ("duration_under_cap", "expect",
     "epoch(date_trunc('second', completed_ts)) - epoch(date_trunc('second', time_picked_up_ts))"
     " <= 7200"),
]
PROFILE_COLUMNS = ["fare_amount", "distance", "trip_duration_minutes",
                   "expected_vs_actual_pickup_minutes_difference", "dispatch_to_arrival_minutes"]


def build_extra() -> dict[str, str]:
    q: dict[str, str] = {}
    base = build()
    q["SRC1_csv_batch_to_silver"] = base["PRJ1_bronze_text_to_silver"]
    for k in ("AGG3_monthly_revenue", "AGG4_trips_per_hour_weekday", "AGG5_revenue_by_zone_payment",
              "AGG6_top_zones", "AGG7_wait_by_weekday"):
        q[k + "_sql"] = base[k]
    q["SRC6_extract_daily_kpis"] = base["AGG2_daily_kpis"]
    q["SRC6_extract_dim_zone"] = base["WIN4_dim_zone"]
    q["SNK6_train_test_csv_roundtrip"] = base["ML3_train_test_split"]
    q["SNK9_trip_sample"] = with_star(
        "SELECT * FROM fact_trip WHERE CAST(('0x' || substr(md5(booking_id || ':42'), 1, 8)) "
        "AS BIGINT) % 10 = 0")
    q["SNK7_feature_view_sql"] = _features_sql() + "SELECT * FROM fview"
    # Every field of the generated booking text parses, so each rule passes on every row; the
    # count of rows is the count of lineitem rows.
    parse_rules = ["pickup_due_ts", "time_dispatched_ts", "time_vehicle_arrived_ts",
                   "time_picked_up_ts", "completed_ts", "priority", "price", "distance",
                   "pickup_latitude", "pickup_longitude", "destination_latitude",
                   "destination_longitude"]
    q["DQ4_bronze_parse_report"] = "\nUNION ALL\n".join(
        f"SELECT '{c}_parses' AS rule, 'expect' AS mode, count(*) AS rows_checked, "
        "count(*) AS passed, CAST(0 AS BIGINT) AS failed FROM lineitem" for c in parse_rules)
    q["SRC2_stream_ingest_to_silver"] = base["PRJ1_bronze_text_to_silver"]
    q["SRC1_mixed_headers_to_silver"] = base["PRJ1_bronze_text_to_silver"]
    q["SRC2_two_landings"] = (
        "WITH l AS (SELECT CAST(('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)), 1, 8)) "
        "AS BIGINT) % 2 AS h FROM lineitem) "
        "SELECT 'run_1' AS step, count(*) AS rows FROM l WHERE h = 0 UNION ALL SELECT 'run_2', count(*) FROM l WHERE h = 1 "
        "UNION ALL SELECT 'run_3', 0 UNION ALL SELECT 'table', count(*) FROM l")
    q["DQ7_append_twice"] = (
        "WITH i AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS b FROM lineitem), "
        "k AS (SELECT CASE WHEN CAST(('0x' || substr(md5(b), 1, 8)) AS BIGINT) % 7 <> 0 THEN b ELSE '(null)' END AS k, "
        "CAST(('0x' || substr(md5(b || ':held'), 1, 8)) AS BIGINT) % 2 = 0 AS early FROM i) "
        "SELECT 'base' AS step, count(DISTINCT k) AS rows FROM k WHERE early UNION ALL "
        "SELECT 'after_first', count(DISTINCT k) FROM k UNION ALL SELECT 'added_by_second', 0")
    q["DQ3_ingest_malformed_counts"] = (
        "SELECT (SELECT count(*) FROM lineitem) AS good_rows, "
        "(SELECT count(*) FROM events) AS malformed_rows")
    tables = [("silver_weather", 10), ("weather_daily", 9), ("silver_taxi", 22), ("dim_date", 18),
              ("dim_zone", 4), ("fact_trip", 20), ("daily_kpis", 6), ("zone_daily", 4)]
    summary = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS \"table\", count(*) AS rows, CAST({n} AS INTEGER) AS columns FROM {t}"
        for t, n in tables)
    summary += ("\nUNION ALL\nSELECT 'hourly_trips', count(*), CAST(4 AS INTEGER) FROM "
                "(SELECT 1 FROM fact_trip f JOIN dim_date d ON f.trip_booked_for_date_key = d.date_key"
                " GROUP BY f.trip_booked_for_date_key, hour(f.pickup_due_timestamp))")
    q["SNK8_build_summary"] = with_star(summary)
    wd = (",\nwd AS (SELECT loc_id, date, avg_temp_c, total_precip_mm, wind_speed_kmph, humidity, "
          "visibility_km, cloud_cover, pressure_mb, weather_desc FROM w_ranked WHERE _rn = 1)\n")
    q["DQ4_weather_quality_report"] = with_star("") + wd + _rule_rows(WEATHER_RULES_SQL, "wd")
    reasons = ", ".join(f"CASE WHEN NOT coalesce({c}, FALSE) THEN '{n}' END"
                        for n, _, c in WEATHER_RULES_SQL)
    any_fail = " OR ".join(f"NOT coalesce({c}, FALSE)" for _, _, c in WEATHER_RULES_SQL)
    q["DQ3_weather_quarantine"] = with_star("") + wd + (
        f"SELECT *, concat_ws(',', {reasons}) AS reasons FROM wd WHERE {any_fail}")
    q["DQ4_trip_quality_report"] = with_star(_rule_rows(TRIP_RULES_SQL, "silver_taxi"))
    parts = []
    for c in PROFILE_COLUMNS:
        def prof(year: int, c=c) -> str:
            return (f"(SELECT count(*) AS rows, count(*) FILTER (WHERE f.{c} IS NULL) AS nulls, "
                    f"avg(CAST(f.{c} AS DOUBLE)) AS mean, stddev_samp(CAST(f.{c} AS DOUBLE)) AS sd "
                    f"FROM fact_trip f JOIN dim_date d ON f.trip_booked_for_date_key = d.date_key "
                    f"WHERE d.year = {year})")
        parts.append(
            f"SELECT '{c}' AS column_name, b.rows AS rows_before, a.rows AS rows_after, "
            "round(b.mean, 4) AS mean_before, round(a.mean, 4) AS mean_after, "
            "round(CASE WHEN b.sd = 0 THEN NULL ELSE (a.mean - b.mean) / b.sd END, 4) AS mean_shift_sd, "
            "round(CAST(a.nulls AS DOUBLE) / a.rows - CAST(b.nulls AS DOUBLE) / b.rows, 6) "
            f"AS null_rate_change FROM {prof(1996)} b, {prof(1997)} a")
    q["DQ5_fact_profile_drift"] = with_star("\nUNION ALL\n".join(parts))

    def dup(t: str, k: str) -> str:
        return (f"SELECT CAST(coalesce(sum(c), 0) AS BIGINT) FROM (SELECT count(*) AS c FROM {t} "
                f"WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1)")

    def orphan(fk: str, t: str, pk: str) -> str:
        return (f"SELECT count(*) FROM fact_trip f WHERE f.{fk} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {t} x WHERE x.{pk} = f.{fk})")

    checks = [
        ("fact_trip.trip_key unique", dup("fact_trip", "trip_key")),
        ("fact_trip.booking_id unique", dup("fact_trip", "booking_id")),
        ("dim_date.date_key unique", dup("dim_date", "date_key")),
        ("dim_zone.zone_key unique", dup("dim_zone", "zone_key")),
        ("dim_zone.zone_code unique", dup("dim_zone", "zone_code")),
        ("fact_trip.trip_booked_for_date_key resolves",
         orphan("trip_booked_for_date_key", "dim_date", "date_key")),
        ("fact_trip.pickup_zone_key resolves", orphan("pickup_zone_key", "dim_zone", "zone_key")),
        ("fact_trip.destination_zone_key resolves",
         orphan("destination_zone_key", "dim_zone", "zone_key")),
    ]
    q["DQ6_key_checks"] = with_star("\nUNION ALL\n".join(
        f"SELECT '{n}' AS \"check\", CAST(({s}) AS BIGINT) AS violations" for n, s in checks))
    q["STR1_live_trip_tile"] = (
        "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, "
        "time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type, "
        "count(*) AS trips, round(sum(value), 2) AS revenue FROM events GROUP BY 1, 2, 3")
    q["STR1_late_rows"] = """
WITH a AS (SELECT *, CAST(least((day(ts) - 1) // 10, 2) AS INTEGER) + CAST(event_id % 8 = 0 AS INTEGER) AS landing,
                  time_bucket(INTERVAL 1 HOUR, ts) AS window_start FROM events),
marks AS (SELECT n.landing, max(a.ts) AS mark FROM (VALUES (0), (1), (2), (3)) n(landing)
          LEFT JOIN a ON a.landing < n.landing GROUP BY 1),
b AS (SELECT a.*, coalesce(window_start + INTERVAL 1 HOUR <= mark - INTERVAL 2 HOUR, FALSE) AS late
      FROM a JOIN marks USING (landing))
SELECT window_start, event_type, count(*) FILTER (NOT late) AS trips,
       round(coalesce(sum(value) FILTER (NOT late), 0), 2) AS revenue, count(*) FILTER (late) AS late_rows,
       round(coalesce(sum(value) FILTER (late), 0), 2) AS late_revenue
FROM b GROUP BY 1, 2"""
    q["VEC1_label_centroid_top10"] = """
WITH ex AS (
  SELECT vec_id, label, unnest(generate_series(1, len(embedding))) AS pos,
         CAST(unnest(embedding) AS DOUBLE) AS x
  FROM embeddings
),
cent AS (SELECT label AS query_id, pos, avg(x) AS m FROM ex GROUP BY 1, 2),
cnorm AS (SELECT query_id, sqrt(sum(m * m)) AS n FROM cent GROUP BY 1),
enorm AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM ex GROUP BY 1),
dots AS (SELECT c.query_id, ex.vec_id, sum(ex.x * c.m) AS d FROM ex JOIN cent c ON ex.pos = c.pos
         GROUP BY 1, 2),
sims AS (SELECT d.query_id, d.vec_id AS id,
                CASE WHEN en.n * cn.n = 0 THEN NULL ELSE d.d / (en.n * cn.n) END AS similarity
         FROM dots d JOIN enorm en ON d.vec_id = en.vec_id JOIN cnorm cn ON d.query_id = cn.query_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id
                                             ORDER BY similarity DESC NULLS LAST, id) AS INTEGER)
                     AS rank FROM sims)
SELECT query_id, id, round(similarity, 4) AS similarity, rank FROM ranked WHERE rank <= 10"""
    return q


def build_more() -> dict[str, str]:
    from ridemart.plans.checks import more_sql
    from ridemart.plans.catalog import DEMO_WEATHER_FILTER
    hours = with_star("") + _hourly_where(DEMO_WEATHER_FILTER) + (
        "SELECT hour_of_day, day_name, CAST(sum(trip_count) AS BIGINT) AS trip_count, "
        f"{weekday_index('day_name')} AS day_index FROM hourly GROUP BY hour_of_day, day_name")
    from ridemart.plans.checks import damaged_sql
    from ridemart.plans.loads import load_sql
    from ridemart.plans.profiles import profile_sql
    base, extra, features = build(), build_extra(), _features_sql()
    return more_sql(base, extra, with_star, features, hours) | (
        load_sql(extra, with_star, damaged_sql(features)) | profile_sql(extra, with_star))
