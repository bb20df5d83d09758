"""The catalogue's queries in plain SQL, to be run by an independent engine."""

from __future__ import annotations

LAT, LON, METRES = 37.779, -122.41, 600.0
DAY, TIME, HOUR = "Mon", "11:00:00", 11
HOURS = range(9, 17)

RAW = """
raw AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS post_id, props AS street_block,
         event_type AS payment_type,
         upper(strftime(ts, '%d-%b-%y %I.%M.%S %p')) AS session_start_dt,
         upper(strftime(ts + to_seconds(CAST(floor(value * 60) AS BIGINT)),
                        '%d-%b-%y %I.%M.%S %p')) AS session_end_dt,
         event_type AS meter_event_type, CAST(value AS VARCHAR) AS gross_paid_amt
  FROM events)"""

SESSIONS = (
    RAW
    + """,
parsed AS (
  SELECT event_id, post_id,
         try_strptime(session_start_dt, '%d-%b-%y %I.%M.%S %p') AS t0,
         try_strptime(session_end_dt, '%d-%b-%y %I.%M.%S %p') AS t1
  FROM raw),
sessions AS (
  SELECT event_id, post_id, strftime(t0, '%Y-%m-%d') AS event_date,
         strftime(t0, '%H:%M:%S') AS start_time, strftime(t1, '%H:%M:%S') AS end_time,
         strftime(t0, '%a') AS day_of_week,
         CAST(hour(t0) AS INTEGER) AS start_hour, CAST(hour(t1) AS INTEGER) AS end_hour
  FROM parsed)"""
)

METERS = """
meters AS (
  SELECT CAST(c_custkey AS VARCHAR) AS post_id, c_mktsegment AS cap_color,
         CAST(-122.42 AS DOUBLE) + (c_custkey % 41) * CAST(0.0005 AS DOUBLE) AS longitude,
         CAST(37.77 AS DOUBLE) + (c_custkey % 37) * CAST(0.0005 AS DOUBLE) AS latitude
  FROM customer)"""


def _distance(lat: str, lon: str) -> str:
    return f"""2 * 6371008.8 * asin(least(1.0, sqrt(
      power(sin(radians(latitude - {lat}) / 2), 2)
      + cos(radians({lat})) * cos(radians(latitude))
        * power(sin(radians(longitude - {lon}) / 2), 2))))"""


HERE = _distance(f"CAST({LAT} AS DOUBLE)", f"CAST({LON} AS DOUBLE)")

# The difference in longitude on the auxiliary sphere, round by round.
SPHEROID = f"""
spots AS (
  SELECT *, 1 / 298.257223563::DOUBLE AS f, 6378137::DOUBLE * (1 - 1 / 298.257223563::DOUBLE) AS b,
         atan((1 - 1 / 298.257223563::DOUBLE) * tan(radians(CAST({LAT} AS DOUBLE)))) AS u1,
         atan((1 - 1 / 298.257223563::DOUBLE) * tan(radians(latitude))) AS u2,
         radians(longitude - CAST({LON} AS DOUBLE)) AS l0
  FROM meters WHERE {HERE} <= {METRES} * 1.01),
r0 AS (SELECT post_id, f, b, u1, u2, l0, l0 AS l FROM spots)"""
for _n in range(1, 13):
    SPHEROID += f""",
a{_n} AS (
  SELECT *, sqrt(power(cos(u2) * sin(l), 2)
                 + power(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(l), 2)) AS sn,
         sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(l) AS cs FROM r{_n - 1}),
b{_n} AS (
  SELECT *, atan2(sn, cs) AS sg, CASE WHEN sn = 0 THEN 0 ELSE cos(u1) * cos(u2) * sin(l) / sn END
         AS t FROM a{_n}),
c{_n} AS (
  SELECT *, 1 - t * t AS q, CASE WHEN 1 - t * t < 1e-15 THEN 0
         ELSE cs - 2 * sin(u1) * sin(u2) / (1 - t * t) END AS m FROM b{_n}),
d{_n} AS (SELECT *, f / 16 * q * (4 + f * (4 - 3 * q)) AS c FROM c{_n}),
r{_n} AS (
  SELECT post_id, f, b, u1, u2, l0, sn AS sn0, cs AS cs0, sg AS sg0, q AS q0, m AS m0,
         l0 + (1 - c) * f * t * (sg + c * sn * (m + c * cs * (2 * m * m - 1))) AS l
  FROM d{_n})"""

NEAR = (
    METERS
    + f""",
near AS (
  SELECT post_id, latitude, longitude, {HERE} AS metres FROM meters
  WHERE {HERE} <= {METRES})"""
)

REQUESTS = """
gazetteer AS (
  SELECT n_nationkey, n_name AS address,
         CAST(37.77 AS DOUBLE) + n_nationkey * CAST(0.0007 AS DOUBLE) AS lat,
         CAST(-122.42 AS DOUBLE) + n_nationkey * CAST(0.0008 AS DOUBLE) AS lon
  FROM nation),
requests AS (
  SELECT s_suppkey AS request_id, g.address, lat, lon,
         CAST(300 + 100 * (s_suppkey % 5) AS DOUBLE) AS radius,
         ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][CAST(s_suppkey % 7 AS INTEGER) + 1]
           AS weekday,
         CAST(9 + s_suppkey % 8 AS INTEGER) AS at_hour
  FROM supplier JOIN gazetteer g ON s_nationkey = n_nationkey)"""

PAIRS = (
    REQUESTS
    + ","
    + METERS
    + f""",
pairs AS (
  SELECT request_id, post_id, latitude, longitude, {_distance("lat", "lon")} AS metres,
         radius, weekday, at_hour
  FROM requests, meters
  WHERE {_distance("lat", "lon")} <= radius)"""
)

IN_HOUR = f"start_hour BETWEEN 9 AND {HOUR} AND end_hour BETWEEN {HOUR} AND 17"

_PIVOT_COLUMNS = ",\n".join(
    f"""  CAST(count(DISTINCT event_date) FILTER (
         WHERE start_hour <= {h} AND end_hour >= {h}) AS BIGINT) AS h{h}"""
    for h in HOURS
)
PIVOT = f"""
pivot_table AS (
  SELECT post_id,
{_PIVOT_COLUMNS}
  FROM sessions
  WHERE start_hour BETWEEN 9 AND 16 AND end_hour BETWEEN start_hour AND 17
  GROUP BY post_id),
total AS (SELECT count(DISTINCT event_date) AS n FROM sessions)"""


def _chance(x: str) -> str:
    return f"CASE WHEN {x} >= n THEN 1.0 ELSE round_even({x} / n, 2) END"


POSSIBLE = f"""
possible AS (
  SELECT near.post_id, latitude, longitude,
         CAST({_chance(f"h{HOUR}")} AS DOUBLE) AS possibility
  FROM near JOIN pivot_table USING (post_id), total
  WHERE {_chance(f"h{HOUR}")} > 0)"""


def _mean(cents: str, used: str) -> str:
    return f"CASE WHEN {used} > 0 THEN round_even({cents} / ({used} * 100), 2) END"


def _averaged(name: str) -> str:
    return f"""
SELECT round(a, 6) AS {name}, CAST(round_even(a, 0) AS BIGINT) AS occupied, n_meters,
       'Historical Occupancy = '
         || coalesce(CAST(CAST(round_even(a, 0) AS BIGINT) AS VARCHAR), 'None')
         || '/' || CAST(n_meters AS VARCHAR) AS label
FROM (SELECT (SELECT avg(n) FROM per_date) AS a,
             (SELECT count(latitude) FROM near) AS n_meters)"""


def _quarter(clock: str) -> str:
    return f"""coalesce(substr({clock}, 1, 3) || lpad(CAST(
      (CAST(substr({clock}, 4, 2) AS INTEGER) // 15) * 15 AS VARCHAR), 2, '0'), '')"""


def _enriched(start_window: str, end_window: str, event_id: str = "event_id, ") -> str:
    return f"""WITH {SESSIONS},{METERS}
SELECT {event_id}post_id, event_date, start_time, end_time, day_of_week,
       {start_window} AS start_window, {end_window} AS end_window,
       cap_color, longitude, latitude
FROM sessions JOIN meters USING (post_id)"""


def oracle_sql() -> dict[str, str]:
    """One statement per catalogue query."""
    picked_cents = " ".join(f"WHEN {h} THEN c{h}" for h in HOURS)
    picked_used = " ".join(f"WHEN {h} THEN u{h}" for h in HOURS)
    picked_chance = " ".join(f"WHEN {h} THEN {_chance(f'h{h}')}" for h in HOURS)
    whole_sessions = f"""WITH {SESSIONS}
SELECT post_id, event_date, start_time, end_time, day_of_week, start_hour, end_hour
FROM sessions"""
    rated = ",\n".join(
        f"""  sum(CASE WHEN {_chance(f"h{h}")} > 0
             THEN CAST(round({_chance(f"h{h}")} * 100, 0) AS BIGINT) END) AS c{h},
  count(*) FILTER (WHERE {_chance(f"h{h}")} > 0) AS u{h}"""
        for h in HOURS
    )
    plain = r"trim(regexp_replace(lower(address), '[^\p{L}\p{N}]+', ' ', 'g'))"
    return {
        "indexed_csv": f"""WITH {RAW}
SELECT row_number() OVER (ORDER BY post_id, event_id) - 1 AS row_index, event_id, post_id,
       session_start_dt
FROM raw""",
        "stored_meters_within": f"""WITH {NEAR}
SELECT post_id, latitude, longitude FROM near""",
        "stored_sessions_within": f"""WITH {SESSIONS},{NEAR}
SELECT event_id, post_id, event_date FROM sessions JOIN near USING (post_id)
WHERE day_of_week = '{DAY}'""",
        "avg_sessions_all_days": f"""WITH {SESSIONS},{NEAR},
days AS (
  SELECT strftime(d, '%Y-%m-%d') AS event_date
  FROM generate_series((SELECT min(event_date) FROM sessions)::DATE, DATE '2024-03-31',
                       INTERVAL 1 DAY) AS g(d)
  WHERE strftime(d, '%a') = '{DAY}'),
hits AS (
  SELECT event_date, count(*) AS n FROM sessions JOIN near USING (post_id)
  WHERE day_of_week = '{DAY}' AND start_time < '04:00:00' AND end_time > '04:00:00'
  GROUP BY event_date),
per_date AS (SELECT coalesce(n, 0) AS n FROM days LEFT JOIN hits USING (event_date))
{_averaged("avg_sessions")}""",
        "avg_meters_all_days": f"""WITH {SESSIONS},{NEAR},
days AS (
  SELECT strftime(d, '%Y-%m-%d') AS event_date
  FROM generate_series(DATE '2023-12-01', DATE '2024-03-31', INTERVAL 1 DAY) AS g(d)
  WHERE strftime(d, '%a') = '{DAY}'),
hits AS (
  SELECT event_date, count(DISTINCT post_id) AS n FROM sessions JOIN near USING (post_id)
  WHERE day_of_week = '{DAY}' AND {IN_HOUR} GROUP BY event_date),
per_date AS (SELECT coalesce(n, 0) AS n FROM days LEFT JOIN hits USING (event_date))
{_averaged("avg_meters")}""",
        "refresh_corrected": f"""WITH {SESSIONS}
SELECT CASE WHEN event_id % 4 = 2 THEN 'moved ' || post_id ELSE post_id END AS post_id,
       event_date, start_time, end_time, day_of_week
FROM sessions WHERE event_id % 4 <> 2 OR event_id % 3 = 0""",
        "occupied_days_between": f"""WITH {SESSIONS}
SELECT post_id, count(DISTINCT event_date) AS n_days FROM sessions
WHERE post_id IS NOT NULL AND {IN_HOUR}
  AND event_date BETWEEN '2024-01-05' AND '2024-01-23'
GROUP BY post_id""",
        "observed_days_between": f"""WITH {SESSIONS}
SELECT count(DISTINCT event_date) AS n_days FROM sessions
WHERE day_of_week = '{DAY}' AND event_date BETWEEN '2024-01-05' AND '2024-01-23'""",
        "locate_text": f"""WITH {REQUESTS},
typed AS (
  SELECT request_id, CASE request_id % 5
    WHEN 0 THEN ' ' || lower(address) || '!'
    WHEN 1 THEN substr(address, 1, 2) || substr(address, 4)
    WHEN 2 THEN 'X' || substr(address, 2)
    WHEN 3 THEN substr(address, 2, 1) || substr(address, 1, 1) || substr(address, 3)
    ELSE address || 'q' END AS address
  FROM requests),
asked AS (SELECT request_id, address, {plain} AS p FROM typed),
places AS (SELECT address AS found_address, lat, lon, {plain} AS q FROM gazetteer),
ranked AS (
  SELECT request_id, found_address, lat, lon, levenshtein(p, q)::INT AS edits,
         row_number() OVER (PARTITION BY request_id ORDER BY levenshtein(p, q), q) AS nth
  FROM asked, places
  WHERE levenshtein(p, q) <= least(3, length(p) // 4))
SELECT request_id, address, found_address, edits, lat, lon
FROM asked LEFT JOIN (SELECT * FROM ranked WHERE nth = 1) USING (request_id)""",
        "parse_sessions": f"""WITH {SESSIONS}
SELECT event_id, post_id, event_date, start_time, end_time, day_of_week FROM sessions""",
        "windows_15min": f"""WITH {SESSIONS}
SELECT event_id, {_quarter("start_time")} AS start_window,
       {_quarter("end_time")} AS end_window FROM sessions""",
        "windows_hour": f"""WITH {SESSIONS}
SELECT event_id, start_hour, end_hour, substr(start_time, 1, 2) AS start_window,
       substr(end_time, 1, 2) AS end_window FROM sessions""",
        "meter_base": f"""WITH {METERS}
SELECT post_id, cap_color, longitude, latitude FROM meters""",
        "enriched_sessions": _enriched(_quarter("start_time"), _quarter("end_time")),
        "published_sessions": _enriched(
            "substr(start_time, 1, 2)", "substr(end_time, 1, 2)"
        ),
        "weekday_partition": f"""WITH {SESSIONS}
SELECT event_id, post_id FROM sessions WHERE day_of_week = '{DAY}'""",
        "sessions_per_meter_weekday": f"""WITH {SESSIONS}
SELECT post_id, day_of_week, count(*) AS n_sessions FROM sessions GROUP BY ALL""",
        "active_days_per_meter_weekday": f"""WITH {SESSIONS}
SELECT post_id, day_of_week, count(DISTINCT event_date) AS n_days
FROM sessions GROUP BY post_id, day_of_week""",
        "observed_days": f"""WITH {SESSIONS}
SELECT day_of_week, count(DISTINCT event_date) AS n_days
FROM sessions WHERE event_date IS NOT NULL GROUP BY day_of_week""",
        "meters_within": f"""WITH {NEAR}
SELECT post_id, round(metres, 3) AS metres FROM near""",
        "meters_within_spheroid": f"""WITH {METERS},{SPHEROID},
u AS (SELECT *, q0 * (6378137::DOUBLE ** 2 - b ** 2) / b ** 2 AS k FROM r12),
ab AS (
  SELECT *, 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k))) AS big_a,
         k / 1024 * (256 + k * (-128 + k * (74 - 47 * k))) AS big_b FROM u),
measured AS (
  SELECT post_id, b * big_a * (sg0 - big_b * sn0 * (m0 + big_b / 4 * (cs0 * (2 * m0 * m0 - 1)
           - big_b / 6 * m0 * (4 * sn0 * sn0 - 3) * (4 * m0 * m0 - 3)))) AS metres
  FROM ab)
SELECT post_id, round(metres, 3) AS metres FROM measured WHERE metres <= {METRES}""",
        "meter_count_within": f"""WITH {NEAR}
SELECT count(latitude) AS n_meters FROM near""",
        "load_sessions": _enriched(_quarter("start_time"), _quarter("end_time"), ""),
        "load_weekday_sessions": _enriched(
            "substr(start_time, 1, 2)", "substr(end_time, 1, 2)", ""
        )
        + f" WHERE day_of_week = '{DAY}'",
        "on_weekday": f"""WITH {SESSIONS}
SELECT event_id, post_id, event_date FROM sessions WHERE day_of_week = '{DAY}'""",
        "occupied_days": f"""WITH {SESSIONS}
SELECT post_id, count(DISTINCT event_date) AS n_days FROM sessions
WHERE post_id IS NOT NULL AND {IN_HOUR} GROUP BY post_id""",
        "hour_column": f"""WITH {SESSIONS},{PIVOT}
SELECT post_id, h{HOUR} AS n_days FROM pivot_table""",
        "sessions_per_date": f"""WITH {SESSIONS},{NEAR}
SELECT event_date, count(*) AS n_sessions FROM sessions JOIN near USING (post_id)
WHERE day_of_week = '{DAY}' AND start_time < '{TIME}' AND end_time > '{TIME}'
GROUP BY event_date""",
        "in_progress_at": f"""WITH {SESSIONS}
SELECT event_id, post_id, event_date FROM sessions
WHERE start_time < '{TIME}' AND end_time > '{TIME}'""",
        "occupied_in_hour": f"""WITH {SESSIONS}
SELECT event_id, post_id, event_date FROM sessions WHERE {IN_HOUR}""",
        "avg_sessions_at": f"""WITH {SESSIONS},{NEAR},
per_date AS (
  SELECT event_date, count(*) AS n FROM sessions JOIN near USING (post_id)
  WHERE day_of_week = '{DAY}' AND start_time < '{TIME}' AND end_time > '{TIME}'
  GROUP BY event_date)
{_averaged("avg_sessions")}""",
        "meters_per_date": f"""WITH {SESSIONS},{NEAR}
SELECT event_date, count(DISTINCT post_id) AS n_meters
FROM sessions JOIN near USING (post_id)
WHERE day_of_week = '{DAY}' AND {IN_HOUR} GROUP BY event_date""",
        "avg_meters_in_hour": f"""WITH {SESSIONS},{NEAR},
per_date AS (
  SELECT event_date, count(DISTINCT post_id) AS n FROM sessions JOIN near USING (post_id)
  WHERE day_of_week = '{DAY}' AND {IN_HOUR} GROUP BY event_date)
{_averaged("avg_meters")}""",
        "occupied_days_by_meter": f"""WITH {SESSIONS},{NEAR},
by_meter AS (
  SELECT post_id, count(DISTINCT event_date) AS n_days FROM sessions
  WHERE day_of_week = '{DAY}' AND {IN_HOUR} GROUP BY post_id),
total AS (
  SELECT count(DISTINCT event_date) AS total_days FROM sessions
  WHERE day_of_week = '{DAY}')
SELECT near.post_id, latitude, longitude, n_days, total_days,
       coalesce(CAST(n_days AS VARCHAR) || '/' || CAST(total_days AS VARCHAR), 'None')
         AS label
FROM near LEFT JOIN by_meter USING (post_id), total""",
        "hour_pivot": f"""WITH {SESSIONS},{PIVOT}
SELECT * FROM pivot_table""",
        "meter_possibility": f"""WITH {SESSIONS},{NEAR},{PIVOT},{POSSIBLE}
SELECT post_id, latitude, longitude, possibility FROM possible""",
        "area_possibility": f"""WITH {SESSIONS},{NEAR},{PIVOT},{POSSIBLE},
summed AS (
  SELECT sum(CAST(round(possibility * 100, 0) AS BIGINT)) AS c, count(*) AS u
  FROM possible),
mean AS (SELECT CAST({_mean("c", "u")} AS DOUBLE) AS m, u FROM summed)
SELECT m AS possibility, (SELECT count(latitude) FROM near) AS n_meters_in_range,
       u AS n_meters_used, coalesce(CAST(m AS VARCHAR), 'None') AS label
FROM mean""",
        "locate_requests": f"""WITH {REQUESTS}
SELECT request_id, lat, lon FROM requests""",
        "distance_join": f"""WITH {PAIRS}
SELECT request_id, post_id, round(metres, 3) AS metres FROM pairs""",
        "score_requests": f"""WITH {SESSIONS},{PAIRS},
per_date AS (
  SELECT request_id, event_date, count(DISTINCT post_id) AS n
  FROM pairs JOIN sessions USING (post_id)
  WHERE day_of_week = weekday AND start_hour BETWEEN 9 AND at_hour
    AND end_hour BETWEEN at_hour AND 17
  GROUP BY request_id, event_date),
averages AS (SELECT request_id, avg(n) AS a FROM per_date GROUP BY request_id),
totals AS (SELECT request_id, count(*) AS n_meters FROM pairs GROUP BY request_id)
SELECT request_id, round(a, 6) AS avg_meters,
       CAST(round_even(a, 0) AS BIGINT) AS occupied, coalesce(n_meters, 0) AS n_meters,
       'Historical Occupancy = '
         || coalesce(CAST(CAST(round_even(a, 0) AS BIGINT) AS VARCHAR), 'None')
         || '/' || CAST(coalesce(n_meters, 0) AS VARCHAR) AS label
FROM requests LEFT JOIN averages USING (request_id) LEFT JOIN totals USING (request_id)""",
        "score_possibility": f"""WITH {SESSIONS},{PAIRS},{PIVOT},
rated AS (
  SELECT request_id, any_value(at_hour) AS at_hour, count(*) AS n_meters_in_range,
{rated}
  FROM pairs LEFT JOIN pivot_table USING (post_id), total GROUP BY request_id),
picked AS (
  SELECT request_id, n_meters_in_range,
         CASE at_hour {picked_cents} END AS c, CASE at_hour {picked_used} END AS u
  FROM rated)
SELECT request_id, CAST({_mean("c", "u")} AS DOUBLE) AS possibility,
       coalesce(n_meters_in_range, 0) AS n_meters_in_range,
       coalesce(u, 0) AS n_meters_used,
       coalesce(CAST(CAST({_mean("c", "u")} AS DOUBLE) AS VARCHAR), 'None') AS label
FROM requests LEFT JOIN picked USING (request_id)""",
        "score_in_progress": f"""WITH {SESSIONS},{PAIRS},
clocks AS (
  SELECT *, printf('%02d:%02d:%02d', 9 + request_id % 8, request_id * 7 % 60,
                   request_id * 13 % 60) AS clock
  FROM pairs),
per_date AS (
  SELECT request_id, event_date, count(*) AS n FROM clocks JOIN sessions USING (post_id)
  WHERE day_of_week = weekday AND start_time < clock AND end_time > clock
  GROUP BY request_id, event_date),
averages AS (SELECT request_id, avg(n) AS a FROM per_date GROUP BY request_id),
totals AS (SELECT request_id, count(*) AS n_meters FROM pairs GROUP BY request_id)
SELECT request_id, round(a, 6) AS avg_sessions,
       CAST(round_even(a, 0) AS BIGINT) AS occupied, coalesce(n_meters, 0) AS n_meters,
       'Historical Occupancy = '
         || coalesce(CAST(CAST(round_even(a, 0) AS BIGINT) AS VARCHAR), 'None')
         || '/' || CAST(coalesce(n_meters, 0) AS VARCHAR) AS label
FROM requests LEFT JOIN averages USING (request_id) LEFT JOIN totals USING (request_id)""",
        "csv_roundtrip": f"""WITH {RAW}
SELECT form, post_id, street_block, payment_type, session_start_dt, session_end_dt,
       meter_event_type, gross_paid_amt
FROM raw, (VALUES ('header'), ('headerless')) AS forms(form)""",
        "prefix_500": f"""WITH {RAW}
SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_index, event_id, post_id,
       session_start_dt
FROM raw ORDER BY event_id LIMIT 500""",
        "count_prefix": "SELECT least(count(*), 100000) AS n FROM events",
        "split_at_row": """WITH numbered AS (
  SELECT event_id, row_number() OVER (ORDER BY event_id) AS rn,
         count(*) OVER () AS total
  FROM events)
SELECT CASE WHEN rn <= total // 2 THEN 1 ELSE 2 END AS part, count(*) AS n_rows,
       min(event_id) AS min_event_id, max(event_id) AS max_event_id
FROM numbered GROUP BY 1""",
        "refresh_sessions": whole_sessions,
        "load_half_file": whole_sessions,
        "hour_pivot_upkeep": f"""WITH {SESSIONS},{PIVOT}
SELECT * FROM pivot_table""",
        "build_hour_pivot": f"""WITH {SESSIONS},{PIVOT}
SELECT * FROM pivot_table""",
        "score_meter_days": f"""WITH {SESSIONS},{PAIRS},
days AS (
  SELECT post_id, day_of_week, at_hour, count(DISTINCT event_date) AS n_days
  FROM sessions, (SELECT DISTINCT at_hour FROM requests) AS asked
  WHERE start_hour BETWEEN 9 AND at_hour AND end_hour BETWEEN at_hour AND 17
  GROUP BY post_id, day_of_week, at_hour),
total AS (
  SELECT day_of_week, count(DISTINCT event_date) AS total_days
  FROM sessions GROUP BY day_of_week)
SELECT request_id, p.post_id, latitude, longitude, n_days,
       coalesce(total_days, 0) AS total_days,
       coalesce(CAST(n_days AS VARCHAR) || '/' || CAST(coalesce(total_days, 0) AS VARCHAR),
                'None') AS label
FROM pairs p
  LEFT JOIN days d ON d.post_id = p.post_id AND d.day_of_week = weekday
    AND d.at_hour = p.at_hour
  LEFT JOIN total t ON t.day_of_week = weekday""",
        "score_meter_possibility": f"""WITH {SESSIONS},{PAIRS},{PIVOT},
chances AS (
  SELECT request_id, post_id, latitude, longitude,
         CAST(CASE at_hour {picked_chance} END AS DOUBLE) AS possibility
  FROM pairs JOIN pivot_table USING (post_id), total)
SELECT * FROM chances WHERE possibility > 0""",
        "unlocated_requests": f"""WITH {REQUESTS}
SELECT request_id, address FROM requests WHERE length(address) % 2 = 1""",
        "duplicate_meters": f"""WITH {METERS}
SELECT post_id, CAST(3 AS BIGINT) AS n_rows FROM meters
WHERE CAST(post_id AS BIGINT) % 7 = 0""",
        "preview": "SELECT least(count(*), 20) AS n_rows FROM events",
        "load_meter_weekday_counts": f"""WITH {SESSIONS}
SELECT post_id, day_of_week, count(*) AS n_sessions FROM sessions GROUP BY ALL""",
        "load_meters": f"""WITH {METERS}
SELECT post_id, cap_color, longitude, latitude FROM meters""",
        "count_prefix_bounded": "SELECT least(count(*), 700) AS n FROM events",
        "split_at_tied_row": """WITH numbered AS (
  SELECT event_id, event_type AS payment_type,
         row_number() OVER (ORDER BY event_type, event_id) AS rn,
         count(*) OVER () AS total
  FROM events)
SELECT CASE WHEN rn <= total // 3 THEN 1 ELSE 2 END AS part, event_id, payment_type
FROM numbered""",
    }
