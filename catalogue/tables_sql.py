"""The derived tables and marts again, as DuckDB common table expressions."""

from __future__ import annotations

import re

from punctualis.schemas import DISTRICTS

_V = "(VALUES (TIMESTAMP '2024-01-01'), (TIMESTAMP '2024-01-15')) ver(load_timestamp)"
_M = "(VALUES ('A'), ('M'), ('T')) md(mode)"
_SERVICE = "(VALUES (TIMESTAMP '2024-01-05'), (TIMESTAMP '2024-01-06')) sd(midnight)"


def _mode(key: str) -> str:
    return f"substr('AMT', CAST({key} % 3 AS INTEGER) + 1, 1)"


CTES: dict[str, str] = {
    "stops": f"""
        SELECT 'S' || s_suppkey AS stop_id, 'C' || s_suppkey AS stop_code,
               CASE WHEN s_suppkey % 50 <> 49 THEN 'Stop ' || (s_suppkey % 40) END AS stop_name,
               CASE WHEN s_suppkey % 2 = 0 THEN 'platform' END AS stop_desc,
               49.97::DOUBLE + (s_suppkey * 37 % 140)::DOUBLE / 1000::DOUBLE AS stop_lat,
               19.80::DOUBLE + (s_suppkey * 53 % 400)::DOUBLE / 1000::DOUBLE AS stop_lon, mode, load_timestamp
        FROM supplier, {_M}, {_V}""",
    "routes_scd2": f"""
        SELECT 'R' || p_partkey AS route_id, mode, 'L' || p_partkey || suffix AS route_short_name, valid_from, valid_to
        FROM part, {_M},
             (VALUES (0, '', TIMESTAMP '1900-01-01', TIMESTAMP '2024-01-10'), (0, 'n', TIMESTAMP '2024-01-10', NULL),
                     (1, '', TIMESTAMP '1900-01-01', NULL)) r(odd, suffix, valid_from, valid_to)
        WHERE p_partkey % 2 = odd""",
    "trips": f"""
        SELECT 'T' || o_orderkey AS trip_id, 'R' || (low + o_orderkey % parts) AS route_id, 'V' || (o_orderkey % 2) AS service_id,
               o_orderpriority AS trip_headsign, {_mode('o_orderkey')} AS mode, load_timestamp
        FROM orders, {_V}, (SELECT min(p_partkey) AS low, count(*) AS parts FROM part)""",
    "visits": """
        SELECT l_orderkey AS ok, l_linenumber AS ln, min(l_suppkey) AS supp, min(l_partkey) AS part, sum(l_quantity) AS dist
        FROM lineitem GROUP BY ALL""",
    "stop_times": f"""
        SELECT 'T' || ok AS trip_id, 'S' || supp AS stop_id, ln AS stop_sequence,
               printf('%02d:%02d:00', ok % 26, ok % 38 + 3 * ln) AS arrival_time,
               printf('%02d:%02d:30', ok % 26, ok % 38 + 3 * ln) AS departure_time,
               dist AS shape_dist_traveled, {_mode('ok')} AS mode, load_timestamp
        FROM visits, {_V}""",
    "calendar": f"""
        SELECT DISTINCT 'V' || (o_orderkey % 2) AS service_id, 1 AS monday, 1 AS tuesday, 1 AS wednesday, 1 AS thursday, 1 AS friday,
               (o_orderkey % 2)::INTEGER AS saturday, (o_orderkey % 2)::INTEGER AS sunday,
               CASE WHEN load_timestamp < TIMESTAMP '2024-01-10' THEN '20240101' ELSE '20240115' END AS start_date,
               CASE WHEN load_timestamp < TIMESTAMP '2024-01-10' THEN '20240107' ELSE '20240121' END AS end_date,
               {_mode('o_orderkey')} AS mode, load_timestamp
        FROM orders, {_V}""",
    "calendar_dates": """
        SELECT service_id, mode, load_timestamp, x.date, x.exception_type
        FROM calendar, (VALUES ('20240103', 2), ('20240107', 1)) x(date, exception_type)
        WHERE service_id = 'V0' AND start_date = '20240101'""",
    "customer_calendar": f"""
        SELECT 'V' || c_custkey AS service_id, (c_custkey & 1)::INTEGER AS monday, ((c_custkey >> 1) & 1)::INTEGER AS tuesday,
               ((c_custkey >> 2) & 1)::INTEGER AS wednesday, ((c_custkey >> 3) & 1)::INTEGER AS thursday,
               ((c_custkey >> 4) & 1)::INTEGER AS friday, ((c_custkey >> 5) & 1)::INTEGER AS saturday,
               ((c_custkey >> 6) & 1)::INTEGER AS sunday,
               strftime(DATE '2023-12-20' + c_nationkey, '%Y%m%d') AS start_date,
               strftime(DATE '2023-12-20' + c_nationkey + (c_custkey % 30)::INTEGER, '%Y%m%d') AS end_date,
               {_mode('c_custkey')} AS mode, load_timestamp
        FROM customer, {_V}""",
    "customer_exceptions": f"""
        SELECT 'V' || o_custkey AS service_id, date, (k % 2 + 1)::INTEGER AS exception_type, {_mode('o_custkey')} AS mode, load_timestamp
        FROM (SELECT o_custkey, strftime(DATE '2024-01-01' + (o_orderkey % 40)::INTEGER, '%Y%m%d') AS date, min(o_orderkey) AS k
              FROM orders GROUP BY ALL), {_V}""",
    "polls": f"""
        SELECT ok, ln, supp, part, poll_no, t, (CASE poll_no WHEN 1 THEN plan - 1200 ELSE t END // 60) * 60 AS poll
        FROM (SELECT ok, ln, supp, part, poll_no, plan,
                     plan + part * 13 % 900 - 300 - CASE poll_no WHEN 1 THEN 60 ELSE 0 END AS t
              FROM (SELECT *, epoch(midnight)::BIGINT - 3600 + (ok % 26) * 3600 + (ok % 38 + 3 * ln) * 60 AS plan
                    FROM visits, {_SERVICE}, (VALUES (1), (2)) pn(poll_no)))""",
    "trip_updates": f"""
        SELECT 'T' || ok AS trip_id, 'S' || supp AS stop_id, ln AS stop_sequence,
               CASE WHEN (ok * 7 + ln) % 101 <> 0 AND (ok + ln) % 7 <> 0 THEN t END AS arrival,
               CASE WHEN (ok * 7 + ln) % 101 <> 0 THEN CASE WHEN (ok + ln) % 7 = 0 THEN t ELSE t + 30 END END AS departure,
               0 AS schedule_relationship, make_timestamp(poll * 1000000) AS load_timestamp, {_mode('ok')} AS mode
        FROM polls""",
    "vehicle_positions": f"""
        SELECT 'B' || (ok % 500 + copy) AS id, 49.97::DOUBLE + (part % 140)::DOUBLE / 1000::DOUBLE AS latitude,
               19.80::DOUBLE + (part % 400)::DOUBLE / 1000::DOUBLE AS longitude, (part % 360)::DOUBLE AS bearing, (part % 20)::DOUBLE AS speed,
               ((ok + ln) % 3)::INTEGER AS current_status, ln AS current_stop_sequence, make_timestamp(poll * 1000000) AS load_timestamp,
               'T' || ok AS trip_id, {_mode('ok')} AS mode
        FROM polls, (VALUES (0), (1)) c(copy) WHERE poll_no = 2 AND (copy = 0 OR part % 5 = 0)""",
    "districts": "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{n}', {lat}::DOUBLE, {lon}::DOUBLE)" for i, (n, lat, lon) in enumerate(DISTRICTS, 1))
    + ") d(district_number, district_name, latitude, longitude)",
    "hourly_weather": """
        SELECT district_name, date_trunc('hour', ts) AS timestamp, (sum(round(value * 100)::BIGINT)::BIGINT // count(*))::DOUBLE / 100 AS temperature_2m,
               round(max(value), 2) AS wind_speed_10m, count(*)::DOUBLE AS relative_humidity_2m, round(min(value), 2) AS precipitation,
               (max(event_id) % 100)::INTEGER AS weather_code, round(max(value) + 1000, 2) AS pressure_msl,
               min(event_id)::DOUBLE AS cloud_cover, max(event_id)::DOUBLE AS visibility,
               date_part('hour', date_trunc('hour', ts)) BETWEEN 6 AND 17 AS is_day
        FROM events JOIN districts ON district_number = user_id % 18 + 1 GROUP BY ALL""",
    "delays": """
        SELECT 'T' || user_id AS trip_id, 'S' || (event_id % 100) AS stop_id, 'Stop ' || (user_id % 30) AS stop_name,
               event_type AS trip_headsign, (event_id % 25)::INTEGER AS stop_sequence, ts AS actual_arrival,
               'L' || (user_id % 20) AS route_short_name, ts - to_minutes(floor(value)::BIGINT - 20) AS planned_arrival,
               event_type AS mode, strftime(ts, '%Y%m%d') AS event_date, ts AS load_timestamp, date_trunc('day', ts)::TIMESTAMP AS schedule_timestamp,
               CASE WHEN event_id % 97 <> 0 THEN floor(value)::BIGINT - 20 END AS delay
        FROM events""",
    # marts
    "expanded_calendar": """
        SELECT strftime(day, '%Y%m%d') AS event_date, c.service_id, c.mode, c.load_timestamp
        FROM calendar c
        CROSS JOIN (SELECT CAST(unnest(generate_series((SELECT min(load_timestamp::DATE) FROM calendar),
                                                  (SELECT max(strptime(end_date, '%Y%m%d')::DATE) FROM calendar), INTERVAL 1 DAY)) AS DATE) AS day) g
        LEFT JOIN calendar_dates x ON x.service_id = c.service_id AND x.mode = c.mode AND x.load_timestamp = c.load_timestamp
                                  AND x.date = strftime(day, '%Y%m%d')
        WHERE strftime(day, '%Y%m%d') >= c.start_date AND strftime(day, '%Y%m%d') <= c.end_date
          AND (x.exception_type = 1 OR (coalesce(x.exception_type, 0) <> 2
               AND [c.sunday, c.monday, c.tuesday, c.wednesday, c.thursday, c.friday, c.saturday][dayofweek(day) + 1] = 1))""",
    "picked_calendar": """
        SELECT * FROM expanded_calendar WHERE load_timestamp IN (SELECT load_timestamp FROM stop_times)
        QUALIFY row_number() OVER (PARTITION BY mode, event_date ORDER BY load_timestamp DESC, service_id) = 1""",
    "picked_all": """
        SELECT * FROM expanded_calendar WHERE load_timestamp IN (SELECT load_timestamp FROM stop_times)
        QUALIFY rank() OVER (PARTITION BY mode, event_date ORDER BY load_timestamp DESC) = 1""",
    "schedule": "@schedule:picked_calendar",
    "schedule_all": "@schedule:picked_all",
    "updates": """
        SELECT *, strftime(actual, '%Y%m%d') AS day
        FROM (SELECT trip_id, mode, stop_id, stop_sequence, load_timestamp,
                     timezone('Europe/Warsaw', to_timestamp(coalesce(arrival, departure))) AS actual FROM trip_updates)
        QUALIFY row_number() OVER (PARTITION BY trip_id, mode, stop_id, day
                                   ORDER BY load_timestamp DESC, stop_sequence DESC, actual DESC) = 1""",
    "matched": """
        SELECT s.*, u.actual, u.load_timestamp AS update_timestamp,
               strptime(s.event_date, '%Y%m%d') + to_hours(s.plan_hour) + to_minutes(split_part(s.arrival_time, ':', 2)::INTEGER)
                 + to_seconds(split_part(s.arrival_time, ':', 3)::INTEGER) AS planned
        FROM (SELECT *, strftime(actual::DATE + step, '%Y%m%d') AS near FROM updates, (VALUES (-1), (0), (1)) moved(step)) u
        JOIN (SELECT *, split_part(arrival_time, ':', 1)::INTEGER AS plan_hour FROM schedule) s
          ON s.trip_id = u.trip_id AND s.mode = u.mode AND s.stop_id = u.stop_id AND s.event_date = u.near
        WHERE step = CASE WHEN hour(u.actual) = 23 AND plan_hour = 0 THEN 1 WHEN hour(u.actual) = 0 AND plan_hour = 23 THEN -1 ELSE 0 END""",
    "delay_mart": """
        SELECT trip_id, stop_id, stop_name, trip_headsign, stop_sequence, actual AS actual_arrival, route_short_name, planned AS planned_arrival,
               mode, event_date, update_timestamp AS load_timestamp, load_timestamp AS schedule_timestamp,
               greatest(date_diff('minute', planned, actual), 0) AS delay
        FROM matched
        QUALIFY row_number() OVER (PARTITION BY trip_id, stop_id, mode, event_date
                                   ORDER BY matched.load_timestamp DESC, update_timestamp DESC, actual DESC, stop_sequence DESC) = 1""",
    "vectors": """
        SELECT trip_id, mode, event_date, stop_id AS start_stop_id, stop_sequence AS start_stop_sequence, planned AS planned_departure,
               actual AS actual_departure, nxt.stop_id AS direction_stop_id, nxt.stop_sequence AS end_stop_sequence,
               nxt.planned AS planned_arrival, nxt.actual AS actual_arrival,
               md5(concat(trip_id, event_date, stop_sequence, nxt.stop_sequence)) AS vector_unique_id
        FROM (SELECT *, lead(struct_pack(stop_id := stop_id, stop_sequence := stop_sequence, planned := planned, actual := actual))
                        OVER (PARTITION BY trip_id, mode, event_date ORDER BY stop_sequence, planned, actual, stop_id) AS nxt FROM matched)
        WHERE nxt IS NOT NULL""",
    "tagged_vehicles": """
        SELECT p.*, v.vector_unique_id FROM vehicle_positions p JOIN vectors v
          ON v.trip_id = p.trip_id AND v.mode = p.mode AND v.end_stop_sequence = p.current_stop_sequence
         AND v.event_date = strftime(p.load_timestamp, '%Y%m%d')
        WHERE p.current_status > 0""",
    "nearest_district": """
        SELECT stop_id, stop_name, district_name, d FROM
          (SELECT s.*, district_name, asin(sqrt(pow(sin(radians(latitude - stop_lat) / 2), 2)
                    + cos(radians(stop_lat)) * cos(radians(latitude)) * pow(sin(radians(longitude - stop_lon) / 2), 2))) AS d
           FROM stops s, districts)
        QUALIFY row_number() OVER (PARTITION BY stop_id ORDER BY round(d, 12), district_name, mode, load_timestamp DESC, stop_name) = 1""",
    "flagged": """
        SELECT *, CASE WHEN stop_sequence < lag(stop_sequence) OVER (PARTITION BY trip_id, mode ORDER BY load_timestamp, stop_sequence)
                       THEN 1 ELSE 0 END AS change_indicator FROM delay_mart""",
    "sessions": """
        SELECT *, sum(change_indicator) OVER (PARTITION BY trip_id, mode ORDER BY load_timestamp, stop_sequence
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS session_id FROM flagged""",
    "session_latest": """
        SELECT * FROM sessions QUALIFY row_number() OVER (PARTITION BY trip_id, session_id, stop_sequence, mode
                                                          ORDER BY load_timestamp DESC, delay DESC, stop_id) = 1""",
    "session_pairs": """
        SELECT a.*, b.stop_id AS next_stop_id FROM session_latest a JOIN session_latest b
          ON a.trip_id = b.trip_id AND a.mode = b.mode AND a.session_id = b.session_id AND b.stop_sequence = a.stop_sequence + 1""",
    "pair_averages": """
        SELECT count(*) AS cnt, avg(delay) AS avg_delay, stop_id, next_stop_id, hour(load_timestamp)::INTEGER AS delay_hour,
               load_timestamp::DATE AS delay_date FROM session_pairs GROUP BY ALL""",
}

_SCHEDULE = """
        SELECT st.trip_id, st.mode, r.route_short_name,
               CASE WHEN h > 23 THEN (h - 24) || substr(st.arrival_time, 3) ELSE st.arrival_time END AS arrival_time,
               st.stop_sequence, st.shape_dist_traveled, t.trip_headsign, p.stop_name, p.stop_id, p.stop_lat, p.stop_lon,
               CASE WHEN h > 23 THEN strftime(strptime(c.event_date, '%Y%m%d') + INTERVAL 1 DAY, '%Y%m%d') ELSE c.event_date END AS event_date,
               h > 23 AS is_night_trip, st.load_timestamp
        FROM (SELECT *, split_part(arrival_time, ':', 1)::INTEGER AS h FROM stop_times) st
        JOIN trips t USING (trip_id, mode, load_timestamp)
        JOIN stops p USING (stop_id, mode, load_timestamp)
        JOIN {calendar} c ON c.service_id = t.service_id AND c.mode = t.mode AND c.load_timestamp = t.load_timestamp
        JOIN routes_scd2 r ON r.route_id = t.route_id AND r.mode = t.mode AND st.load_timestamp >= r.valid_from
                          AND st.load_timestamp < coalesce(r.valid_to, TIMESTAMP '9999-01-01')
        WHERE p.stop_name IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY st.trip_id, st.mode, c.event_date, st.stop_id
                                   ORDER BY st.load_timestamp DESC, st.stop_sequence) = 1"""


def _text(name: str) -> str:
    text = CTES[name]
    return _SCHEDULE.format(calendar=text.split(":")[1]) if text.startswith("@schedule:") else text


def sql(body: str) -> str:
    """``body`` with the common table expressions it needs, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"\b{name}\b(?!\s*[:(]=?)", re.sub(r"'[^']*'", "", text)):
                if name in seen:
                    continue
                seen.add(name)
                visit(_text(name))
                order.append(name)

    seen: set[str] = set()
    visit(body)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({_text(name)})" for name in order)
    return f"WITH {ctes}\n{body}" if ctes else body
