"""The expected results, in DuckDB SQL over the generic test tables.

Written from the meaning of each table, not from the Spark plans. Sorts name
their NULL order because the two engines differ in the default.
"""

from __future__ import annotations

from samples.tables import ARRIVALS, FIRST_SNAPSHOT_END, ZONES

FIRST_MERGE = "2024-01-01 06:00:00"
SECOND_MERGE = "2024-01-02 06:00:00"
BATCH_SPLIT = "2024-01-01 04:00:00"
FIRST_BATCH = "2024-01-02 00:00:00"
SECOND_BATCH = "2024-01-02 01:00:00"
UPKEEP = "2024-01-10 00:00:00"
COOLDOWN_SECONDS = 5400

TELEMETRY = """
base AS (
  SELECT event_id, concat('VIN', CAST(1000 + user_id AS VARCHAR)) AS vin,
    CASE WHEN event_id % 33 = 0 THEN NULL ELSE CAST(60 + (event_id * 37) % 81 AS INTEGER) END AS speed,
    CAST(1000 + (event_id * 53) % 4001 AS INTEGER) AS rpm,
    12.0e0 + CAST((event_id * 7919) % 10000 AS DOUBLE) / 1e4 AS lat,
    77.0e0 + CAST((event_id * 104729) % 10000 AS DOUBLE) / 1e4 AS lon,
    1704067200 + event_id * 3 AS event_timestamp
  FROM events),
sent AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE event_id % 20 = 0),
clean AS (
  SELECT vin, speed, rpm, lat, lon, event_timestamp,
    CAST(to_timestamp(event_timestamp) AT TIME ZONE 'UTC' AS TIMESTAMP) AS event_time
  FROM (SELECT *, row_number() OVER (PARTITION BY vin, event_timestamp
                                     ORDER BY speed, rpm, lat, lon) AS place
        FROM sent
        WHERE vin IS NOT NULL AND speed IS NOT NULL AND rpm IS NOT NULL AND lat IS NOT NULL
          AND lon IS NOT NULL AND event_timestamp IS NOT NULL)
  WHERE place = 1)"""


def assignments(name: str, condition: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT vin, driver_id, start_date, CAST(NULL AS DATE) AS end_date, daily_rate, region
  FROM (SELECT concat(CASE WHEN c_acctbal >= 0 THEN 'VIN' ELSE 'SPARE' END, CAST(1000 + o_custkey AS VARCHAR)) AS vin,
               concat('D', CAST(CAST(floor(o_custkey / 8) * 2 + o_orderkey % 2 AS BIGINT) AS VARCHAR)) AS driver_id,
               CAST(o_orderdate AS DATE) AS start_date,
               CAST(500 + o_orderkey % 1000 AS DOUBLE) AS daily_rate, r_name AS region,
               row_number() OVER (PARTITION BY o_custkey
                                  ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
        FROM orders JOIN customer ON o_custkey = c_custkey
                    JOIN nation ON c_nationkey = n_nationkey
                    JOIN region ON n_regionkey = r_regionkey
        WHERE {condition})
  WHERE place = 1)"""


SAFETY = f"""{TELEMETRY},{assignments('dim')},
flagged AS (
  SELECT c.*, d.driver_id, d.daily_rate, d.region,
    CASE WHEN speed > 110 THEN 1 ELSE 0 END AS overspeed_flag,
    CASE WHEN lat >= 12.5e0 AND lat <= 12.8e0 AND lon >= 77.2e0 AND lon <= 77.5e0
         THEN 1 ELSE 0 END AS restricted_zone_flag
  FROM clean c LEFT JOIN dim d ON c.vin = d.vin),
scored AS (SELECT *, overspeed_flag + 2 * restricted_zone_flag AS strike_score FROM flagged),
safety AS (
  SELECT driver_id, vin, speed, rpm, lat, lon, event_timestamp, event_time, daily_rate, region,
    CAST(overspeed_flag AS INTEGER) AS overspeed_flag,
    CAST(restricted_zone_flag AS INTEGER) AS restricted_zone_flag,
    CAST(strike_score AS INTEGER) AS strike_score,
    CASE WHEN strike_score >= 5 THEN 'HIGH_RISK' WHEN strike_score >= 3 THEN 'MEDIUM_RISK'
         ELSE 'LOW_RISK' END AS risk_category,
    daily_rate - daily_rate * CAST(0.05 AS DOUBLE) * strike_score AS adjusted_daily_rate,
    CAST(event_time AS DATE) AS date, CAST(hour(event_time) AS INTEGER) AS hour
  FROM scored)"""

AGGREGATES = f"""{SAFETY},
aggregates AS (
  SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, driver_id,
    count(*) AS total_events, CAST(sum(overspeed_flag) AS BIGINT) AS overspeed_events,
    CAST(sum(restricted_zone_flag) AS BIGINT) AS restricted_zone_events,
    CAST(sum(strike_score) AS BIGINT) AS total_strike_score,
    round(avg(speed), 6) AS avg_speed, max(speed) AS max_speed, max(event_time) AS last_event_time
  FROM (SELECT *, CAST(to_timestamp(event_timestamp - event_timestamp % 1800)
                       AT TIME ZONE 'UTC' AS TIMESTAMP) AS window_start FROM safety)
  GROUP BY window_start, driver_id)"""

# Events of the newest ten minutes keep their windows open.
CLOSED = f"""{AGGREGATES},
closed AS (
  SELECT * FROM aggregates
  WHERE window_end <= (SELECT max(event_time) - INTERVAL 10 MINUTE FROM clean))"""


def state(applied: str) -> str:
    """The driver state; ``applied`` is when the batch of a window came."""
    return f"""{AGGREGATES},
rated AS (
  SELECT *, greatest(total_strike_score - 2, 0) AS decay,
    CASE WHEN total_strike_score >= 25 THEN 3 WHEN total_strike_score >= 15 THEN 2
         WHEN total_strike_score >= 8 THEN 1 ELSE 0 END AS tier,
    {applied} AS applied
  FROM aggregates WHERE driver_id IS NOT NULL),
tiers AS (
  SELECT * FROM (VALUES
    (3, 'CRITICAL_RISK', 'SUSPENDED_7D', 'Critical repeat offender', 0, 3, 0),
    (2, 'HIGH_RISK', 'SUSPENDED_24H', 'High strike threshold exceeded', 0, 1, 0),
    (1, 'MEDIUM_RISK', 'WARNING', 'Moderate risk behavior', 1, 0, 0),
    (0, 'LOW_RISK', 'ACTIVE', NULL, 0, 0, 1))
  t(tier, risk_category, suspension_status, suspension_reason, warning_count, suspension_count,
    reinstatement_eligible)),
per_driver AS (
  SELECT driver_id, CAST(sum(total_strike_score) AS BIGINT) AS total_strike_score,
    arg_max(tier, window_start) AS tier, arg_max(decay, window_start) AS decay,
    CAST(sum(overspeed_events) AS BIGINT) AS total_overspeed_events,
    CAST(sum(restricted_zone_events) AS BIGINT) AS total_restricted_zone_events,
    min(applied) AS first_applied, max(applied) AS last_applied
  FROM rated GROUP BY driver_id),
state AS (
  SELECT driver_id, total_strike_score, risk_category, suspension_status, suspension_reason,
    last_applied + INTERVAL 1 DAY AS cooldown_until, warning_count, suspension_count,
    reinstatement_eligible, CAST(decay AS BIGINT) AS strike_decay_score, total_overspeed_events,
    total_restricted_zone_events, first_applied AS last_event_ts, last_applied AS updated_ts
  FROM per_driver JOIN tiers USING (tier))"""


STATE = state(f"CASE WHEN window_start < TIMESTAMP '{BATCH_SPLIT}' THEN TIMESTAMP '{FIRST_BATCH}' "
              f"ELSE TIMESTAMP '{SECOND_BATCH}' END")
STREAM_STATE = state(f"TIMESTAMP '{FIRST_BATCH}'")

# The state with some cooldowns over and some not.
WAITING = f"""{STATE},
waiting AS (
  SELECT * REPLACE (TIMESTAMP '{UPKEEP}' + (CASE WHEN total_strike_score % 2 = 0
                    THEN INTERVAL (-1) DAY ELSE INTERVAL 1 DAY END) AS cooldown_until)
  FROM state),
reinstated AS (
  SELECT * REPLACE (
    CASE WHEN over THEN 'ACTIVE' ELSE suspension_status END AS suspension_status,
    CASE WHEN over THEN NULL ELSE suspension_reason END AS suspension_reason,
    CASE WHEN over THEN 1 ELSE reinstatement_eligible END AS reinstatement_eligible,
    CASE WHEN over THEN TIMESTAMP '{UPKEEP}' ELSE updated_ts END AS updated_ts)
  FROM (SELECT *, coalesce(cooldown_until <= TIMESTAMP '{UPKEEP}'
                           AND suspension_status <> 'ACTIVE', FALSE) AS over FROM waiting)),
decayed AS (
  SELECT * REPLACE (greatest(total_strike_score - 1, 0) AS total_strike_score,
                    greatest(strike_decay_score - 1, 0) AS strike_decay_score,
                    TIMESTAMP '{UPKEEP}' AS updated_ts)
  FROM state)"""

# Micro-batches: the watermark of a batch lags by one, so what is late is judged by the newest
# event of all batches but the last before.
ARRIVED = f"""{TELEMETRY},{assignments('dim')},
arrivals AS (
  SELECT * EXCLUDE (event_id),
    least({ARRIVALS - 1}, CAST(floor(event_id * {ARRIVALS} / ((SELECT max(event_id) FROM events) + 1)) AS BIGINT)
      + copy - 1 + CASE WHEN event_id % 29 = 0 THEN 4 WHEN event_id % 17 = 0 THEN 1 ELSE 0 END) AS batch_id
  FROM (SELECT *, 1 AS copy FROM base UNION ALL SELECT *, 2 AS copy FROM base WHERE event_id % 20 = 0)
  WHERE speed IS NOT NULL),
newest AS (
  SELECT b.batch_id, (SELECT max(event_timestamp) FROM arrivals a WHERE a.batch_id <= b.batch_id - 2) AS newest
  FROM (SELECT DISTINCT batch_id FROM arrivals) b),
judged AS (
  SELECT *, coalesce(event_timestamp <= newest - 600, FALSE) AS late
  FROM arrivals JOIN newest USING (batch_id)),
taken AS (
  SELECT t.vin, event_timestamp, min(batch_id) AS batch_id, any_value(driver_id) AS driver_id,
    any_value(CASE WHEN speed > 110 THEN 1 ELSE 0 END) AS over,
    any_value(CASE WHEN lat >= 12.5e0 AND lat <= 12.8e0 AND lon >= 77.2e0 AND lon <= 77.5e0
                   THEN 1 ELSE 0 END) AS zone
  FROM judged t LEFT JOIN dim ON t.vin = dim.vin WHERE NOT late GROUP BY t.vin, event_timestamp),
added AS (
  SELECT batch_id, driver_id, event_timestamp - event_timestamp % 1800 AS start,
    sum(over + 2 * zone) AS score, sum(over) AS over, sum(zone) AS zone
  FROM taken WHERE driver_id IS NOT NULL GROUP BY ALL),
rated AS (
  SELECT *, sum(score) OVER so_far AS total, sum(over) OVER so_far AS total_over,
    sum(zone) OVER so_far AS total_zone
  FROM added WINDOW so_far AS (PARTITION BY driver_id, start ORDER BY batch_id)),
tiers AS (
  SELECT * FROM (VALUES
    (3, 'CRITICAL_RISK', 'SUSPENDED_7D', 'Critical repeat offender', 0, 3, 0),
    (2, 'HIGH_RISK', 'SUSPENDED_24H', 'High strike threshold exceeded', 0, 1, 0),
    (1, 'MEDIUM_RISK', 'WARNING', 'Moderate risk behavior', 1, 0, 0),
    (0, 'LOW_RISK', 'ACTIVE', NULL, 0, 0, 1))
  t(tier, risk_category, suspension_status, suspension_reason, warning_count, suspension_count,
    reinstatement_eligible)),
tiered AS (
  SELECT *, CASE WHEN total >= 25 THEN 3 WHEN total >= 15 THEN 2 WHEN total >= 8 THEN 1 ELSE 0 END AS tier
  FROM rated)"""


def batches_state(score: str, over: str, zone: str) -> str:
    """The state after all batches; the latest window of a driver's last batch sets the tier."""
    return f"""WITH {ARRIVED},
    per_driver AS (
      SELECT driver_id, CAST(sum({score}) AS BIGINT) AS total_strike_score,
        arg_max(tier, batch_id * 10000000000 + start) AS tier,
        arg_max(greatest(total - 2, 0), batch_id * 10000000000 + start) AS decay,
        CAST(sum({over}) AS BIGINT) AS total_overspeed_events,
        CAST(sum({zone}) AS BIGINT) AS total_restricted_zone_events
      FROM tiered GROUP BY driver_id)
    SELECT driver_id, total_strike_score, risk_category, suspension_status, suspension_reason,
      TIMESTAMP '{FIRST_BATCH}' + INTERVAL 1 DAY AS cooldown_until, warning_count, suspension_count,
      reinstatement_eligible, CAST(decay AS BIGINT) AS strike_decay_score, total_overspeed_events,
      total_restricted_zone_events, TIMESTAMP '{FIRST_BATCH}' AS last_event_ts,
      TIMESTAMP '{FIRST_BATCH}' AS updated_ts
    FROM per_driver JOIN tiers USING (tier)"""


# Windows that the watermark has closed, each with the cooldown it starts and the next that closes.
TIMED = f"""{ARRIVED},
closed AS (
  SELECT driver_id, start, start + 1800 AS ended, sum(score) AS score, sum(over) AS over, sum(zone) AS zone
  FROM added GROUP BY driver_id, start
  HAVING start + 1800 <= (SELECT max(event_timestamp) - 600 FROM arrivals)),
walked AS (
  SELECT *, CASE WHEN score >= 25 THEN 3 WHEN score >= 15 THEN 2 WHEN score >= 8 THEN 1 ELSE 0 END AS tier,
    ended + {COOLDOWN_SECONDS} AS cooldown, lead(ended) OVER w AS next_end, min(ended) OVER all_ AS first_end,
    sum(score) OVER w AS total, sum(over) OVER w AS total_over, sum(zone) OVER w AS total_zone
  FROM closed WINDOW w AS (PARTITION BY driver_id ORDER BY ended), all_ AS (PARTITION BY driver_id)),
lifted AS (
  SELECT *, tier > 0 AND cooldown <= coalesce(next_end, (SELECT max(event_timestamp) - 600 FROM arrivals))
    AS lifted
  FROM walked JOIN tiers USING (tier))"""


def _seconds(value: str) -> str:
    return f"CAST(to_timestamp({value}) AT TIME ZONE 'UTC' AS TIMESTAMP)"


HISTORY_COLUMNS = ("vin, driver_id, start_date, end_date, daily_rate, region, status, "
                   "record_start_ts, record_end_ts, is_current, change_type, created_ts")

HISTORY = f"""{assignments('first', f"o_orderdate < TIMESTAMP '{FIRST_SNAPSHOT_END}'")},
{assignments('second')},
changed AS (
  SELECT s.* FROM second s LEFT JOIN first f ON s.vin = f.vin
  WHERE f.vin IS NULL OR s.driver_id <> f.driver_id OR s.daily_rate <> f.daily_rate
     OR s.region <> f.region),
history AS (
  SELECT vin, driver_id, start_date,
    CASE WHEN vin IN (SELECT vin FROM changed) THEN CAST(TIMESTAMP '{SECOND_MERGE}' AS DATE)
         ELSE end_date END AS end_date, daily_rate, region,
    CASE WHEN vin IN (SELECT vin FROM changed) THEN 'ARCHIVED' ELSE 'IN-TRANSIT' END AS status,
    TIMESTAMP '{FIRST_MERGE}' AS record_start_ts,
    CASE WHEN vin IN (SELECT vin FROM changed) THEN TIMESTAMP '{SECOND_MERGE}' END AS record_end_ts,
    CAST(CASE WHEN vin IN (SELECT vin FROM changed) THEN 0 ELSE 1 END AS INTEGER) AS is_current,
    CASE WHEN vin IN (SELECT vin FROM changed) THEN 'UPDATE' ELSE 'INSERT' END AS change_type,
    CASE WHEN vin IN (SELECT vin FROM changed) THEN TIMESTAMP '{SECOND_MERGE}'
         ELSE TIMESTAMP '{FIRST_MERGE}' END AS created_ts
  FROM first
  UNION ALL
  SELECT vin, driver_id, start_date, end_date, daily_rate, region, 'IN-TRANSIT',
    TIMESTAMP '{SECOND_MERGE}', CAST(NULL AS TIMESTAMP), CAST(1 AS INTEGER), 'INSERT',
    TIMESTAMP '{SECOND_MERGE}'
  FROM changed),
fleet AS (
  SELECT region, driver_id, count(DISTINCT vin) AS active_vehicle_count
  FROM history WHERE status = 'IN-TRANSIT' GROUP BY region, driver_id)"""

RAW = """
raw_registry AS (
  SELECT concat(CASE WHEN c_acctbal < 9000 THEN 'VIN' ELSE 'OLD' END,
                CAST(1000 + c_custkey AS VARCHAR)) AS vin, c_mktsegment AS model,
    CAST(2000 + c_custkey % 25 AS VARCHAR) AS mfg_year,
    CASE WHEN c_custkey % 3 = 0 THEN 'DIESEL' ELSE 'PETROL' END AS fuel_type
  FROM customer),
raw_assignment AS (
  SELECT concat(CASE WHEN c_acctbal >= 0 THEN 'VIN' ELSE 'SPARE' END, CAST(1000 + o_custkey AS VARCHAR)) AS vin,
    concat('D', CAST(CAST(floor(o_custkey / 8) * 2 + o_orderkey % 2 AS BIGINT) AS VARCHAR)) AS driver_id,
    CAST(CAST(floor(epoch(o_orderdate)) AS BIGINT) AS VARCHAR) AS start_timestamp,
    CAST(NULL AS VARCHAR) AS end_timestamp,
    CASE WHEN o_orderkey % 103 = 0 THEN 'n/a'
         ELSE CAST(500 + o_orderkey % 1000 AS VARCHAR) END AS daily_rate, r_name AS region
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey),
fuel_once AS (
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS transaction_id,
    concat('VIN', CAST(1000 + o_custkey AS VARCHAR)) AS vin,
    strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S') AS timestamp,
    CASE WHEN o_orderkey % 101 = 0 THEN 'n/a' WHEN o_orderkey % 211 = 0 THEN '0'
         ELSE CAST(20 + o_orderkey % 40 AS VARCHAR) END AS fuel_liters,
    CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) * 100 + o_orderkey % 97
         AS VARCHAR) AS odometer_reading
  FROM orders),
raw_fuel AS (
  SELECT * EXCLUDE (o_orderkey) FROM fuel_once
  UNION ALL SELECT * EXCLUDE (o_orderkey) FROM fuel_once WHERE o_orderkey % 25 = 0),
raw_maintenance AS (
  SELECT concat('VIN', CAST(1000 + o_custkey AS VARCHAR)) AS vin,
    CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
         ELSE 'n/a' END AS service_date, o_orderstatus AS service_type
  FROM orders)"""

SILVER = f"""{RAW},
registry AS (
  SELECT vin, model, mfg_year, fuel_type
  FROM (SELECT vin, model, TRY_CAST(mfg_year AS INTEGER) AS mfg_year, fuel_type,
          row_number() OVER (PARTITION BY vin ORDER BY model NULLS FIRST, mfg_year NULLS FIRST,
                             fuel_type NULLS FIRST) AS place
        FROM raw_registry) WHERE place = 1),
assignment AS (
  SELECT * EXCLUDE (place)
  FROM (SELECT *, row_number() OVER (PARTITION BY vin, start_date
                  ORDER BY driver_id NULLS FIRST, start_timestamp NULLS FIRST,
                           end_timestamp NULLS FIRST, daily_rate NULLS FIRST, region NULLS FIRST,
                           end_date NULLS FIRST) AS place
        FROM (SELECT * REPLACE (TRY_CAST(daily_rate AS DOUBLE) AS daily_rate),
                CAST(to_timestamp(TRY_CAST(start_timestamp AS BIGINT)) AT TIME ZONE 'UTC'
                     AS TIMESTAMP) AS start_date,
                CAST(to_timestamp(TRY_CAST(end_timestamp AS BIGINT)) AT TIME ZONE 'UTC'
                     AS TIMESTAMP) AS end_date
              FROM raw_assignment WHERE vin IS NOT NULL)) WHERE place = 1),
fuel AS (
  SELECT * EXCLUDE (place)
  FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id
                  ORDER BY vin NULLS FIRST, timestamp NULLS FIRST, fuel_liters NULLS FIRST,
                           odometer_reading NULLS FIRST) AS place
        FROM (SELECT transaction_id, vin, timestamp, TRY_CAST(fuel_liters AS DOUBLE) AS fuel_liters,
                TRY_CAST(odometer_reading AS DOUBLE) AS odometer_reading,
                TRY_CAST(timestamp AS TIMESTAMP) AS event_time, TRY_CAST(timestamp AS DATE) AS date
              FROM raw_fuel)
        WHERE vin IS NOT NULL AND fuel_liters IS NOT NULL AND odometer_reading IS NOT NULL)
  WHERE place = 1),
maintenance AS (
  SELECT vin, service_date, service_type
  FROM (SELECT vin, TRY_CAST(service_date AS DATE) AS service_date, service_type,
          row_number() OVER (PARTITION BY vin, TRY_CAST(service_date AS DATE)
                             ORDER BY service_type NULLS FIRST) AS place
        FROM raw_maintenance WHERE vin IS NOT NULL) WHERE place = 1)"""

AUDIT = f"""{SILVER},
stepped AS (
  SELECT *, odometer_reading - lag(odometer_reading) OVER (PARTITION BY vin
      ORDER BY event_time NULLS FIRST, transaction_id, odometer_reading, fuel_liters) AS distance
  FROM fuel),
counted AS (
  SELECT s.vin, r.model, CAST(s.event_time AS DATE) AS audit_date,
    s.distance / nullif(s.fuel_liters, 0) AS kmpl
  FROM stepped s LEFT JOIN registry r ON s.vin = r.vin
  WHERE s.distance IS NOT NULL AND dayofweek(s.event_time) NOT IN (0, 6)
    AND NOT EXISTS (SELECT 1 FROM maintenance m
                    WHERE m.vin = s.vin AND m.service_date = CAST(s.event_time AS DATE))),
baseline AS (SELECT model, avg(kmpl) AS baseline_kmpl FROM counted GROUP BY model),
audit AS (
  SELECT vin, c.model, audit_date, kmpl, round(baseline_kmpl, 6) AS baseline_kmpl,
    CASE WHEN kmpl < baseline_kmpl * 0.88e0 THEN 'FLAGGED' ELSE 'OK' END AS status
  FROM counted c JOIN baseline b ON c.model = b.model)"""

SAFETY_ROWS = """SELECT driver_id, vin, speed, rpm, lat, lon, event_timestamp, event_time, daily_rate,
  region, overspeed_flag, restricted_zone_flag, strike_score, risk_category, adjusted_daily_rate,
  date, hour FROM safety"""

# Report rows by target name; those on the event table, then those on the history.
SAFETY_REPORTS = {
    "overspeed_report": """SELECT driver_id, vin, count(*) AS overspeed_events,
      max(speed) AS max_speed, round(avg(speed), 6) AS avg_speed
      FROM safety WHERE overspeed_flag = 1 GROUP BY driver_id, vin""",
    "restricted_zone_report": """SELECT driver_id, vin, count(*) AS zone_events,
      min(event_time) AS first_event_time, max(event_time) AS last_event_time
      FROM safety WHERE restricted_zone_flag = 1 GROUP BY driver_id, vin""",
    "driver_risk_report": """SELECT *, CASE WHEN total_strike_score >= 25 THEN 'CRITICAL_RISK'
        WHEN total_strike_score >= 15 THEN 'HIGH_RISK' WHEN total_strike_score >= 8
        THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS risk_category
      FROM (SELECT driver_id, count(*) AS total_events,
        CAST(sum(overspeed_flag) AS BIGINT) AS overspeed_events,
        CAST(sum(restricted_zone_flag) AS BIGINT) AS restricted_zone_events,
        CAST(sum(strike_score) AS BIGINT) AS total_strike_score FROM safety GROUP BY driver_id)""",
    "hourly_overspeed_trend": """SELECT date, hour, count(*) AS total_events,
      CAST(sum(overspeed_flag) AS BIGINT) AS overspeed_events FROM safety GROUP BY date, hour""",
    "driver_behavior_report": """SELECT driver_id, date, round(avg(speed), 6) AS avg_speed,
      max(speed) AS max_speed, CAST(sum(strike_score) AS BIGINT) AS total_strike_score
      FROM safety GROUP BY driver_id, date""",
    "fleet_risk_report": """SELECT date, region,
      count(*) FILTER (WHERE risk_category = 'LOW_RISK') AS low_risk_events,
      count(*) FILTER (WHERE risk_category = 'MEDIUM_RISK') AS medium_risk_events,
      count(*) FILTER (WHERE risk_category = 'HIGH_RISK') AS high_risk_events,
      CAST(sum(strike_score) AS BIGINT) AS total_strike_score FROM safety GROUP BY date, region""",
    "driver_safety_status": SAFETY_ROWS,
}
HISTORY_REPORTS = {
    "active_vehicle_snapshot": "SELECT * FROM fleet",
    "asset_history_report": f"SELECT {HISTORY_COLUMNS} FROM history",
}
WIDTH = {  # columns of each report, for the NULL counts
    "overspeed_report": "driver_id, vin, overspeed_events, max_speed, avg_speed",
    "restricted_zone_report": "driver_id, vin, zone_events, first_event_time, last_event_time",
    "driver_risk_report": "driver_id, total_events, overspeed_events, restricted_zone_events, "
                          "total_strike_score, risk_category",
    "hourly_overspeed_trend": "date, hour, total_events, overspeed_events",
    "driver_behavior_report": "driver_id, date, avg_speed, max_speed, total_strike_score",
    "fleet_risk_report": "date, region, low_risk_events, medium_risk_events, high_risk_events, "
                         "total_strike_score",
    "driver_safety_status": "driver_id, vin, speed, rpm, lat, lon, event_timestamp, event_time, "
                            "daily_rate, region, overspeed_flag, restricted_zone_flag, "
                            "strike_score, risk_category, adjusted_daily_rate, date, hour",
    "active_vehicle_snapshot": "region, driver_id, active_vehicle_count",
    "asset_history_report": HISTORY_COLUMNS,
}


def _profile(label: str, columns: str, source: str) -> str:
    nulls = " + ".join(f"CAST({c.strip()} IS NULL AS INTEGER)" for c in columns.split(","))
    return f"""SELECT {label}, CAST(count(*) AS BIGINT) AS rows_fetched,
      CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ({source}))) AS BIGINT) AS duplicate_rows,
      CAST(coalesce(sum({nulls}), 0) AS BIGINT) AS null_cells,
      CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ({source}))) AS BIGINT) AS rows_removed,
      CAST((SELECT count(*) FROM (SELECT DISTINCT * FROM ({source}))) AS BIGINT) AS final_rows
      FROM ({source})"""


RAW_PROFILES = {
    "vehicle_registry": ("raw_registry", "vin, model, mfg_year, fuel_type"),
    "vehicle_assignment": ("raw_assignment",
                           "vin, driver_id, start_timestamp, end_timestamp, daily_rate, region"),
    "fuel_transactions": ("raw_fuel", "transaction_id, vin, timestamp, fuel_liters, odometer_reading"),
    "maintenance_logs": ("raw_maintenance", "vin, service_date, service_type"),
}

STATE_AUDIT = "driver_id, '{event}' AS event_type, {previous} AS previous_status, " \
              "{new} AS new_status, total_strike_score AS strike_score, {reason} AS event_reason"


def _state_audit(event: str, previous: str, new: str, reason: str) -> str:
    return STATE_AUDIT.format(event=event, previous=previous, new=new, reason=reason)


def expected() -> dict[str, str]:
    queries = {
        "silver_vehicle_registry": f"WITH {SILVER} SELECT * FROM registry",
        "silver_vehicle_assignment": f"WITH {SILVER} SELECT * FROM assignment",
        "silver_fuel_transactions": f"WITH {SILVER} SELECT * FROM fuel",
        "silver_maintenance": f"WITH {SILVER} SELECT * FROM maintenance",
        "overwrite_months": f"""WITH {SILVER}
            SELECT vin, transaction_id, CAST(month(event_time) AS INTEGER) AS month FROM fuel
            WHERE month(event_time) % 2 = 0 OR CAST(transaction_id AS BIGINT) % 3 <> 0
              OR event_time IS NULL""",
        "registered_months": f"""WITH {SILVER}
            SELECT vin, transaction_id, CAST(month(event_time) AS INTEGER) AS month,
              CASE WHEN month(event_time) > 5 THEN CAST(length(transaction_id) AS INTEGER) END AS digits
            FROM fuel WHERE event_time IS NOT NULL""",
        "gold_fuel_efficiency": f"WITH {AUDIT} SELECT * FROM audit",
        "gold_asset_history_scd2": f"WITH {HISTORY} SELECT {HISTORY_COLUMNS} FROM history",
        "gold_active_snapshot": f"WITH {HISTORY} SELECT * FROM fleet",
        "telemetry_clean": f"WITH {TELEMETRY} SELECT * FROM clean",
        "driver_safety_status": f"WITH {SAFETY} {SAFETY_ROWS}",
        "driver_risk_aggregates": f"WITH {AGGREGATES} SELECT * FROM aggregates",
        "driver_risk_state": f"WITH {STATE} SELECT * FROM state",
        "stream_driver_safety_status": f"WITH {SAFETY} {SAFETY_ROWS}",
        "stream_risk_aggregates": f"WITH {CLOSED} SELECT * FROM closed",
        "stream_driver_state": f"WITH {STREAM_STATE} SELECT * FROM state",
        "stream_late_events": f"""WITH {ARRIVED}
            SELECT driver_id, vin, event_timestamp, CAST(over + 2 * zone AS INTEGER) AS strike_score,
              CAST(batch_id AS BIGINT) AS batch_id FROM taken""",
        "stream_late_dropped": f"""WITH {ARRIVED}
            SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) AS dropped FROM judged WHERE late
            GROUP BY batch_id""",
        "stream_outcomes": f"""WITH {ARRIVED}
            SELECT 'scored_events_current' AS query, count(*) FILTER (WHERE late) AS dropped,
              TRUE AS ended, FALSE AS failed FROM judged""",
        "stream_state_of_batches": batches_state("score", "over", "zone"),
        "stream_state_as_emitted": batches_state("total", "total_over", "total_zone"),
        "stream_audit_of_batches": f"""WITH {ARRIVED}
            SELECT driver_id, 'RISK_EVALUATION' AS event_type, 'ACTIVE' AS previous_status,
              suspension_status AS new_status, CAST(total AS BIGINT) AS strike_score,
              suspension_reason AS event_reason
            FROM tiered JOIN tiers USING (tier)""",
        "stream_state_by_timers": f"""WITH {TIMED}
            SELECT driver_id, CAST(total AS BIGINT) AS total_strike_score, risk_category,
              CASE WHEN lifted THEN 'ACTIVE' ELSE suspension_status END AS suspension_status,
              CASE WHEN lifted THEN NULL ELSE suspension_reason END AS suspension_reason,
              {_seconds('cooldown')} AS cooldown_until, warning_count, suspension_count,
              CASE WHEN lifted THEN 1 ELSE reinstatement_eligible END AS reinstatement_eligible,
              CAST(greatest(score - 2, 0) AS BIGINT) AS strike_decay_score,
              CAST(total_over AS BIGINT) AS total_overspeed_events,
              CAST(total_zone AS BIGINT) AS total_restricted_zone_events,
              {_seconds('first_end')} AS last_event_ts,
              {_seconds('CASE WHEN lifted THEN cooldown ELSE ended END')} AS updated_ts
            FROM lifted WHERE next_end IS NULL""",
        "stream_audit_by_timers": f"""WITH {TIMED}
            SELECT driver_id, 'RISK_EVALUATION' AS event_type, 'ACTIVE' AS previous_status,
              suspension_status AS new_status, CAST(score AS BIGINT) AS strike_score,
              suspension_reason AS event_reason FROM lifted
            UNION ALL
            SELECT driver_id, 'AUTO_REINSTATEMENT', suspension_status, 'ACTIVE', CAST(total AS BIGINT),
              'Cooldown expired' FROM lifted WHERE lifted""",
        "previous_reading_hot_vin": f"""WITH {SILVER}
            SELECT vin, transaction_id, lag(odometer_reading) OVER (PARTITION BY vin
              ORDER BY event_time NULLS FIRST, transaction_id) AS previous_reading
            FROM (SELECT * REPLACE (CASE WHEN CAST(transaction_id AS BIGINT) % 3 = 0 THEN vin
                                    ELSE 'VIN0' END AS vin) FROM fuel)""",
        "previous_reading_one_hour": f"""WITH {SILVER}
            SELECT vin, transaction_id, lag(odometer_reading) OVER (PARTITION BY vin
              ORDER BY event_time NULLS FIRST, transaction_id) AS previous_reading
            FROM (SELECT * REPLACE (
                    CASE WHEN hot THEN 'VIN0' ELSE vin END AS vin,
                    CASE WHEN hot THEN TIMESTAMP '2024-01-01' + to_seconds(CAST(transaction_id AS BIGINT) % 3600)
                         ELSE event_time END AS event_time)
                  FROM (SELECT *, CAST(transaction_id AS BIGINT) % 3 <> 0 AS hot FROM fuel))""",
        "silver_from_csv": f"WITH {SILVER} SELECT * FROM fuel",
        "risk_evaluation_audit": f"""WITH {STATE} SELECT {_state_audit(
            'RISK_EVALUATION', "'ACTIVE'", 'suspension_status', 'suspension_reason')}
            FROM rated JOIN tiers USING (tier)""",
        "strike_decay": f"WITH {WAITING} SELECT * FROM decayed",
        "strike_decay_audit": f"""WITH {WAITING} SELECT {_state_audit(
            'STRIKE_DECAY', 'suspension_status', 'suspension_status',
            "'Automated strike decay applied'")} FROM decayed""",
        "reinstatement": f"WITH {WAITING} SELECT * EXCLUDE (over) FROM reinstated",
        "reinstatement_audit": f"""WITH {WAITING} SELECT {_state_audit(
            'AUTO_REINSTATEMENT', 'suspension_status', "'ACTIVE'", "'Cooldown expired'")}
            FROM reinstated WHERE reinstatement_eligible = 1""",
        "zone_range_join": f"""WITH {TELEMETRY}, zones AS ({ZONES})
            SELECT clean.*, zones.* FROM clean JOIN zones
              ON lat BETWEEN min_lat AND max_lat AND lon BETWEEN min_lon AND max_lon""",
        "zone_flag": f"""WITH {TELEMETRY}, zones AS ({ZONES})
            SELECT clean.*, CAST(EXISTS (SELECT 1 FROM zones WHERE lat BETWEEN min_lat AND max_lat
                            AND lon BETWEEN min_lon AND max_lon) AS INTEGER) AS restricted_zone_flag
            FROM clean""",
        "quality_profile": f"WITH {RAW} " + " UNION ALL ".join(
            _profile(f"'{name}' AS table_name", columns, f"SELECT * FROM {cte}")
            for name, (cte, columns) in RAW_PROFILES.items()),
        "publish_reports": f"WITH {SAFETY}, {HISTORY} " + " UNION ALL ".join(
            _profile(f"'{target}' AS target, 'published' AS status", WIDTH[target], rows)
            for target, rows in {**SAFETY_REPORTS, **HISTORY_REPORTS}.items()),
    }
    queries["zone_flag_by_merge"] = queries["zone_flag"]
    for target, rows in SAFETY_REPORTS.items():
        queries[REPORT_KEYS[target]] = f"WITH {SAFETY} {rows}"
    for target, rows in HISTORY_REPORTS.items():
        queries[REPORT_KEYS[target]] = f"WITH {HISTORY} {rows}"
    return queries


REPORT_KEYS = {
    "active_vehicle_snapshot": "report_active_vehicle_snapshot",
    "overspeed_report": "report_overspeed",
    "restricted_zone_report": "report_restricted_zone",
    "driver_risk_report": "report_driver_risk",
    "hourly_overspeed_trend": "report_hourly_overspeed_trend",
    "driver_behavior_report": "report_driver_behavior",
    "fleet_risk_report": "report_fleet_risk",
    "asset_history_report": "report_asset_history",
    "driver_safety_status": "report_driver_safety",
}
