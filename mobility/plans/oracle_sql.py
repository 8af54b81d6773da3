"""DuckDB restatements of the registered queries, over the raw tables only.

Each oracle rebuilds the fixture views with CTEs (FIXTURES.md §3) and then
states the operator's semantics in plain SQL.
"""
from __future__ import annotations

EPOCH_US = 1704067200000000  # 2024-01-01T00:00:00Z
DAY_US = 86400000000


def _x(ts: str) -> str:
    return f"(epoch_us({ts}) - {EPOCH_US})"


def _pmod(a: str, d: int) -> str:
    return f"((({a}) % {d} + {d}) % {d})"


def sim_day(ts: str, day_us: int = DAY_US) -> str:
    x = _x(ts)
    return f"cast(greatest(0, ({x} - {_pmod(x, day_us)}) // {day_us}) as int)"


def sim_hour(ts: str, day_us: int = DAY_US) -> str:
    return f"cast(({_pmod(_x(ts), day_us)} * 24) // {day_us} as int)"


def iso(ts: str) -> str:
    return (f"CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S+00:00') "
            f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f+00:00') END")


def seconds(us_expr: str) -> str:
    return f"cast({us_expr} as double) / cast(1000000 as double)"


def vehicle_code(number: str) -> str:
    n = f"cast({number} + 1 as varchar)"
    return f"'V' || CASE WHEN length({n}) >= 4 THEN {n} ELSE lpad({n}, 4, '0') END"


EXP_DAY = "date_diff('day', date '1995-01-02', cast(l_shipdate as date))"

TELEMETRY = f"""
e AS (
  SELECT *, {vehicle_code('user_id')} AS vehicle_id,
    coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (
      PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS trip_no
  FROM events),
telemetry AS (
SELECT event_id, vehicle_id, 'D' || substr(vehicle_id, 2) AS driver_id,
  CASE WHEN event_type IN ('click', 'error') OR (event_type = 'purchase' AND event_id % 97 <> 0)
       THEN vehicle_id || '-' || cast(trip_no as varchar) END AS trip_id,
  CASE cast((user_id + event_id) % 5 as int) WHEN 0 THEN 'downtown' WHEN 1 THEN 'airport'
       WHEN 2 THEN 'suburbs_north' WHEN 3 THEN 'suburbs_south' ELSE 'industrial_park' END AS zone,
  cast(6.8 as double) + cast(event_id % 400 as double) / 1000 AS lat,
  cast(79.8 as double) + cast(event_id % 180 as double) / 1000 AS lon,
  CASE WHEN event_type IN ('click', 'error') THEN cast((event_id * 7) % 500 as double) / 10 ELSE cast(0 as double) END AS speed,
  CASE event_type WHEN 'click' THEN 'enroute' WHEN 'error' THEN 'on_trip' ELSE 'idle' END AS status,
  CASE WHEN event_type = 'purchase' THEN value ELSE cast(0 as double) END AS fare,
  event_type = 'purchase' AS trip_completed, ts AS event_ts,
  CASE WHEN event_id % 50 <> 7 THEN 'none' WHEN cast(floor(event_id / 50) as bigint) % 3 = 0 THEN 'truncated_json'
       WHEN cast(floor(event_id / 50) as bigint) % 3 = 1 THEN 'missing_field' ELSE 'wrong_type' END AS corruption
FROM e),
lake AS (
SELECT event_id, trip_id, driver_id, vehicle_id, zone, lat, lon, speed, status, fare, trip_completed, event_ts,
  {sim_day('event_ts')} AS sim_day
FROM telemetry WHERE corruption = 'none')"""

EXPENSES = f"""
expenses_f AS (
SELECT {vehicle_code('l_suppkey')} AS vehicle_id,
  cast({EXP_DAY} % 30 as int) AS sim_day,
  cast(sum(l_quantity) * 5 / 100 as decimal(10,2)) AS fuel_cost,
  cast(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) * 5 / 100 as decimal(10,2)) AS maintenance_cost,
  cast(CASE WHEN (l_suppkey + {EXP_DAY} % 30) % 17 = 0 THEN 0 ELSE sum(l_quantity) END as decimal(10,2)) AS distance_covered,
  cast(sum(l_quantity) as bigint) % 12 = 0 AS service_flag
FROM lineitem GROUP BY l_suppkey, {EXP_DAY} % 30)"""

TRIPS = """
trips AS (
SELECT vehicle_id, sim_day, cast(count(trip_id) as int) AS trips,
  cast(sum(cast(fare as decimal(20,2))) as decimal(20,2)) AS earnings
FROM lake WHERE trip_completed AND vehicle_id IS NOT NULL GROUP BY vehicle_id, sim_day)"""

PROFIT = """
profit AS (
SELECT coalesce(t.vehicle_id, x.vehicle_id) AS vehicle_id,
  cast(coalesce(t.sim_day, x.sim_day) as int) AS sim_day,
  cast(coalesce(t.trips, 0) as int) AS trips,
  cast(coalesce(t.earnings, 0) as decimal(20,2)) AS earnings,
  x.fuel_cost, x.maintenance_cost, x.distance_covered,
  cast(CASE WHEN x.sim_day IS NOT NULL THEN coalesce(t.earnings, 0)
       - (coalesce(x.fuel_cost, 0) + coalesce(x.maintenance_cost, 0)) END as decimal(20,2)) AS profit,
  cast(coalesce(x.fuel_cost, 0) + coalesce(x.maintenance_cost, 0) as double) AS _cost,
  CASE WHEN x.distance_covered > 0 THEN cast(x.distance_covered as double) END AS _km,
  coalesce(x.service_flag, false) AS service_flag,
  x.sim_day IS NOT NULL AS has_expenses
FROM trips t FULL OUTER JOIN expenses_f x ON t.vehicle_id = x.vehicle_id AND t.sim_day = x.sim_day),
profitability AS (
SELECT vehicle_id, sim_day, trips, earnings, fuel_cost, maintenance_cost, distance_covered, profit,
  cast(profit as double) / _km AS profit_per_km, _cost / _km AS cost_per_km,
  coalesce(profit < 0, false) AS unprofitable, service_flag, has_expenses
FROM profit)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


ORACLES: dict[str, str] = {}

ORACLES["trip_summary"] = with_(TELEMETRY, TRIPS) + "SELECT * FROM trips"

ORACLES["daily_profitability"] = with_(TELEMETRY, EXPENSES, TRIPS, PROFIT) + "SELECT * FROM profitability"


LATEST = """
latest AS (
SELECT vehicle_id, status, zone, event_ts AS last_event_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY event_ts DESC, event_id DESC) AS rn FROM lake)
WHERE rn = 1)"""

PREV = """
prev AS (
SELECT vehicle_id, status, zone, event_ts AS last_event_ts,
  CASE WHEN status = 'idle' THEN event_ts END AS idle_since FROM (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY event_ts DESC, event_id DESC) AS rn
  FROM lake WHERE sim_day < 15)
WHERE rn = 1)"""

UPD = """
upd AS (
SELECT vehicle_id, status, zone, event_ts AS last_event_ts,
  CASE WHEN status = 'idle' THEN event_ts END AS idle_since FROM (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY event_ts DESC, event_id DESC) AS rn
  FROM lake WHERE sim_day >= 15)
WHERE rn = 1)"""


def window_rows(keys: str, name: str) -> str:
    group = f"window_start, {keys}" if keys else "window_start"
    key_sel = f"{keys}, " if keys else ""
    return f"""
{name}_w AS (
SELECT l.*, date_trunc('minute', event_ts) - to_minutes(k) AS window_start FROM lake l, range(0, 5) g(k)),
{name}_a AS (
SELECT {group},
  count(DISTINCT CASE WHEN status <> 'idle' THEN vehicle_id END) AS a,
  count(DISTINCT CASE WHEN status = 'idle' THEN vehicle_id END) AS i,
  sum(CASE WHEN trip_completed THEN 1 ELSE 0 END) AS t,
  sum(CASE WHEN trip_completed THEN cast(fare as decimal(20,2)) ELSE cast(0 as decimal(20,2)) END) AS m
FROM {name}_w GROUP BY {group}),
{name} AS (
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, {key_sel}
  {sim_day('window_start')} AS sim_day, {sim_hour('window_start')} AS sim_hour,
  cast(a as int) AS active_vehicles, cast(i as int) AS idle_vehicles,
  cast(i as double) / cast(nullif(a + i, 0) as double) AS idle_ratio,
  cast(t as int) AS trips_completed, cast(coalesce(m, 0) as decimal(20,2)) AS earnings
FROM {name}_a)"""


ZONE = window_rows("zone", "zone_m")
FLEET = window_rows("", "fleet_m")

BATCH = """
batch AS (
SELECT sim_day, cast(coalesce(sum(trips), 0) as bigint) AS batch_trips,
  cast(coalesce(sum(earnings), 0) as decimal(20,2)) AS batch_earnings
FROM profitability GROUP BY sim_day)"""

SPEED = """
speed AS (
SELECT sim_day, cast(coalesce(sum(trips_completed), 0) as bigint) AS speed_trips,
  cast(coalesce(sum(earnings), 0) as decimal(20,2)) AS speed_earnings
FROM fleet_m WHERE epoch_us(window_start) % (epoch_us(window_end) - epoch_us(window_start)) = 0
GROUP BY sim_day)"""

CHECK = """
chk AS (
SELECT cast(coalesce(s.sim_day, b.sim_day) as int) AS sim_day,
  cast(coalesce(s.speed_trips, 0) as bigint) AS speed_trips,
  cast(coalesce(b.batch_trips, 0) as bigint) AS batch_trips,
  cast(coalesce(s.speed_earnings, 0) as decimal(20,2)) AS speed_earnings,
  cast(coalesce(b.batch_earnings, 0) as decimal(20,2)) AS batch_earnings,
  CASE WHEN coalesce(b.batch_earnings, 0) <> 0 THEN
    abs(cast(coalesce(s.speed_earnings, 0) - coalesce(b.batch_earnings, 0) as double))
    / cast(coalesce(b.batch_earnings, 0) as double) * cast(100 as double) END AS earnings_delta_pct
FROM speed s FULL OUTER JOIN batch b ON s.sim_day = b.sim_day)"""

EPISODES = """
runs AS (
SELECT vehicle_id, event_ts, status <> 'idle' AS busy,
  sum(CASE WHEN status <> 'idle' THEN 1 ELSE 0 END) OVER (PARTITION BY vehicle_id ORDER BY event_ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
FROM lake WHERE vehicle_id IS NOT NULL),
grp AS (
SELECT vehicle_id, run, min(CASE WHEN busy THEN event_ts END) AS opened_at,
  min(CASE WHEN NOT busy THEN event_ts END) AS idle_since,
  max(CASE WHEN NOT busy THEN event_ts END) AS last_idle_ts,
  cast(sum(CASE WHEN busy THEN 0 ELSE 1 END) as bigint) AS idle_events
FROM runs GROUP BY vehicle_id, run),
episodes AS (
SELECT e.vehicle_id, e.idle_since, e.last_idle_ts, e.idle_events, c.opened_at AS ended_at
FROM grp e LEFT JOIN grp c ON c.vehicle_id = e.vehicle_id AND c.run = e.run + 1
WHERE e.idle_events > 0)"""

ALERTS = f"""
alerts AS (
SELECT 'VEHICLE_IDLE' AS alert_type, vehicle_id, 'warning' AS severity,
  'Vehicle ' || vehicle_id || ' idle since ' || ({iso('idle_since')}) AS message,
  {sim_day('idle_since + INTERVAL 180 SECOND')} AS sim_day,
  idle_since + INTERVAL 180 SECOND AS created_at,
  ended_at IS NULL AS open
FROM episodes
WHERE epoch_us(coalesce(ended_at, (SELECT max(event_ts) FROM lake))) - epoch_us(idle_since) >= 180000000)"""

DECODED = """
decoded AS (
SELECT event_id,
  CASE WHEN corruption = 'truncated_json' THEN NULL ELSE trip_id END AS trip_id,
  CASE WHEN corruption = 'truncated_json' THEN NULL ELSE driver_id END AS driver_id,
  CASE WHEN corruption IN ('truncated_json', 'missing_field') THEN NULL ELSE vehicle_id END AS vehicle_id,
  CASE WHEN corruption = 'truncated_json' THEN NULL ELSE zone END AS zone,
  CASE WHEN corruption = 'truncated_json' THEN NULL ELSE lat END AS lat,
  CASE WHEN corruption = 'truncated_json' THEN NULL ELSE lon END AS lon,
  CASE WHEN corruption IN ('truncated_json', 'wrong_type') THEN NULL ELSE speed END AS speed,
  CASE WHEN corruption = 'truncated_json' THEN NULL ELSE status END AS status,
  CASE WHEN corruption = 'truncated_json' THEN NULL ELSE fare END AS fare,
  CASE WHEN corruption = 'truncated_json' THEN NULL ELSE trip_completed END AS trip_completed,
  CASE WHEN corruption = 'truncated_json' THEN NULL ELSE event_ts END AS event_ts,
  corruption IN ('truncated_json', 'wrong_type') AS corrupt
FROM telemetry)"""

LANDED = f"""
landed AS (SELECT DISTINCT cast({EXP_DAY} as int) AS sim_day FROM lineitem),
pending AS (SELECT sim_day FROM landed l WHERE NOT EXISTS (
  SELECT 1 FROM profitability p WHERE p.sim_day = l.sim_day))"""

B = with_
ORACLES["decode_telemetry"] = B(TELEMETRY, DECODED) + "SELECT * FROM decoded"
ORACLES["valid_events"] = B(TELEMETRY) + (
    "SELECT event_id, trip_id, driver_id, vehicle_id, zone, lat, lon, speed, status, fare, "
    "trip_completed, event_ts FROM telemetry WHERE corruption = 'none'")
PAYLOADS = """
full_text AS (
SELECT event_id, corruption,
  '{' || CASE WHEN trip_id IS NULL THEN '' ELSE '"trip_id":"' || trip_id || '",' END || '"driver_id":"' || driver_id || '",' AS head,
  '"vehicle_id":"' || vehicle_id || '",' AS vehicle,
  '"zone":"' || zone || '","lat":' || cast(lat as varchar) || ',"lon":' || cast(lon as varchar) || ',"speed":' AS place,
  cast(speed as varchar) AS speed_text,
  ',"status":"' || status || '","fare":' || cast(fare as varchar) || ',"trip_completed":'
    || CASE WHEN trip_completed THEN 'true' ELSE 'false' END
    || ',"timestamp":"' || strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') || '"}' AS rest
FROM telemetry),
payloads AS (
SELECT event_id, corruption, CASE corruption
  WHEN 'missing_field' THEN head || place || speed_text || rest
  WHEN 'wrong_type' THEN head || vehicle || place || '"very_fast"' || rest
  WHEN 'truncated_json' THEN substring(head || vehicle || place || speed_text || rest, 1,
    cast(length(head || vehicle || place || speed_text || rest) // 2 as int))
  ELSE head || vehicle || place || speed_text || rest END AS raw_value
FROM full_text)"""

ORACLES["dead_letters"] = B(TELEMETRY, PAYLOADS) + (
    "SELECT event_id, raw_value, CASE corruption WHEN 'missing_field' THEN 'missing_vehicle_id' "
    "ELSE 'corrupt_payload' END AS reason FROM payloads WHERE corruption <> 'none'")
_D5 = 300000000
ORACLES["sim_clock"] = B(TELEMETRY) + (
    f"SELECT event_id, {sim_day('event_ts', _D5)} AS sim_day, {sim_hour('event_ts', _D5)} AS sim_hour, "
    f"{seconds(f'{_D5} - ' + _pmod(_x('event_ts'), _D5))} AS seconds_until_next_day FROM lake")
ORACLES["vehicle_dim"] = """
WITH ids AS (SELECT DISTINCT user_id + 1 AS i FROM events)
SELECT 'V' || CASE WHEN length(cast(i as varchar)) >= 4 THEN cast(i as varchar) ELSE lpad(cast(i as varchar), 4, '0') END AS vehicle_id,
  'D' || CASE WHEN length(cast(i as varchar)) >= 4 THEN cast(i as varchar) ELSE lpad(cast(i as varchar), 4, '0') END AS driver_id,
  CASE i % 5 WHEN 0 THEN 'downtown' WHEN 1 THEN 'airport' WHEN 2 THEN 'suburbs_north'
    WHEN 3 THEN 'suburbs_south' ELSE 'industrial_park' END AS home_zone
FROM ids"""
ORACLES["validate_expenses"] = f"""
WITH lines AS (
SELECT l_orderkey AS source_order, l_linenumber AS source_line,
  {vehicle_code('l_suppkey')} AS vehicle_id,
  cast({EXP_DAY} % 30 as int) AS sim_day,
  cast(l_quantity * 5 / 100 as decimal(10,2)) AS fuel_cost,
  cast(CASE WHEN l_returnflag = 'R' THEN l_quantity * 5 / 100 ELSE cast(0 as double) END as decimal(10,2)) AS maintenance_cost,
  cast(l_quantity as decimal(10,2)) AS distance_covered
FROM lineitem),
counts AS (SELECT vehicle_id, sim_day, count(*) AS n FROM lines WHERE vehicle_id IS NOT NULL GROUP BY 1, 2)
SELECT l.source_order, l.source_line, l.vehicle_id, l.sim_day, l.fuel_cost, l.maintenance_cost, l.distance_covered,
  CASE WHEN l.vehicle_id IS NULL THEN 'missing_vehicle_id' WHEN l.sim_day IS NULL THEN 'missing_sim_day'
    WHEN l.fuel_cost < 0 THEN 'negative_fuel_cost'
    WHEN l.maintenance_cost < 0 THEN 'negative_maintenance_cost' WHEN l.distance_covered < 0 THEN 'negative_distance'
    WHEN c.n > 1 THEN 'duplicate_key' END AS reject_reason
FROM lines l LEFT JOIN counts c ON l.vehicle_id = c.vehicle_id AND l.sim_day = c.sim_day"""

ORACLES["zone_window_metrics"] = B(TELEMETRY, ZONE) + "SELECT * FROM zone_m"
ORACLES["fleet_window_metrics"] = B(TELEMETRY, FLEET) + "SELECT * FROM fleet_m"
ORACLES["ingest_quality"] = B(TELEMETRY) + """
SELECT date_trunc('hour', event_ts) AS window_start, date_trunc('hour', event_ts) + INTERVAL 1 HOUR AS window_end,
  cast(sum(CASE WHEN corruption = 'none' THEN 1 ELSE 0 END) as bigint) AS valid_records,
  cast(sum(CASE WHEN corruption <> 'none' THEN 1 ELSE 0 END) as bigint) AS invalid_records,
  cast(sum(CASE WHEN corruption <> 'none' THEN 1 ELSE 0 END) as double) / cast(count(*) as double) AS invalid_ratio
FROM telemetry GROUP BY 1"""

ORACLES["vehicle_latest"] = B(TELEMETRY, LATEST) + "SELECT * FROM latest"
ORACLES["vehicle_state_step"] = B(TELEMETRY, LATEST, PREV) + """
SELECT coalesce(l.vehicle_id, p.vehicle_id) AS vehicle_id,
  CASE WHEN l.vehicle_id IS NOT NULL THEN l.status ELSE p.status END AS status,
  CASE WHEN l.vehicle_id IS NOT NULL THEN l.zone ELSE p.zone END AS zone,
  CASE WHEN l.vehicle_id IS NOT NULL THEN l.last_event_ts ELSE p.last_event_ts END AS last_event_ts,
  CASE WHEN l.vehicle_id IS NULL THEN p.idle_since
       WHEN l.status <> 'idle' THEN NULL
       WHEN p.status = 'idle' AND p.idle_since IS NOT NULL THEN p.idle_since
       ELSE l.last_event_ts END AS idle_since
FROM latest l FULL OUTER JOIN prev p ON l.vehicle_id = p.vehicle_id"""
ORACLES["keyed_upsert"] = B(TELEMETRY, PREV, UPD) + """
SELECT coalesce(u.vehicle_id, t.vehicle_id) AS vehicle_id,
  CASE WHEN u.vehicle_id IS NOT NULL THEN u.status ELSE t.status END AS status,
  CASE WHEN u.vehicle_id IS NOT NULL THEN u.zone ELSE t.zone END AS zone,
  CASE WHEN u.vehicle_id IS NOT NULL THEN u.last_event_ts ELSE t.last_event_ts END AS last_event_ts,
  CASE WHEN u.vehicle_id IS NOT NULL THEN u.idle_since ELSE t.idle_since END AS idle_since
FROM prev t FULL OUTER JOIN upd u ON t.vehicle_id = u.vehicle_id"""
ORACLES["idle_episodes"] = B(TELEMETRY, EPISODES) + "SELECT * FROM episodes"
ORACLES["idle_alerts"] = B(TELEMETRY, EPISODES, ALERTS) + "SELECT * FROM alerts"
ORACLES["recent_alerts"] = B(TELEMETRY, EPISODES, ALERTS) + (
    "SELECT * FROM alerts ORDER BY created_at DESC, vehicle_id, message LIMIT 50")

_P = (TELEMETRY, EXPENSES, TRIPS, PROFIT)
ORACLES["batch_day_totals"] = B(*_P, BATCH) + "SELECT * FROM batch"
ORACLES["speed_day_totals"] = B(TELEMETRY, FLEET, SPEED) + "SELECT * FROM speed"
ORACLES["consistency_check"] = B(*_P, BATCH, FLEET, SPEED, CHECK) + "SELECT * FROM chk"
ORACLES["report_with_check"] = B(*_P, BATCH, FLEET, SPEED, CHECK) + (
    "SELECT p.*, c.speed_trips, c.batch_trips, c.speed_earnings, c.batch_earnings, c.earnings_delta_pct "
    "FROM profitability p LEFT JOIN chk c ON p.sim_day = c.sim_day")
ORACLES["fleet_latest"] = B(TELEMETRY, FLEET) + "SELECT * FROM fleet_m ORDER BY window_start DESC LIMIT 1"
ORACLES["zone_latest"] = B(TELEMETRY, ZONE) + (
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY window_start DESC) AS rn "
    "FROM zone_m) WHERE rn = 1")
ORACLES["profit_report"] = B(*_P) + (
    "SELECT * FROM profitability WHERE sim_day = (SELECT max(sim_day) FROM profitability) "
    "ORDER BY profit ASC NULLS LAST, vehicle_id")
ORACLES["report_summary"] = B(*_P) + """
SELECT sim_day, count(*) AS vehicles,
  cast(sum(CASE WHEN unprofitable THEN 1 ELSE 0 END) as bigint) AS unprofitable_vehicles,
  cast(coalesce(sum(earnings), 0) as decimal(20,2)) AS total_earnings
FROM profitability GROUP BY sim_day"""
ORACLES["top_unprofitable"] = B(*_P) + """
SELECT * FROM (
  SELECT *, cast(row_number() OVER (PARTITION BY sim_day ORDER BY profit ASC NULLS LAST, vehicle_id) as int) AS rank
  FROM profitability WHERE unprofitable)
WHERE rank <= 10"""
ORACLES["report_days"] = B(*_P) + "SELECT DISTINCT sim_day FROM profitability ORDER BY sim_day DESC"
ORACLES["pending_days"] = B(*_P, LANDED) + "SELECT sim_day FROM pending"
ORACLES["next_pending_day"] = B(*_P, LANDED) + "SELECT min(sim_day) AS next_day FROM pending"

ORACLES["pipeline_health"] = B(*_P) + f""",
beats AS (
  SELECT 'stream_sink' AS component, event_ts AS beat_at FROM lake
  UNION ALL SELECT 'batch_sim', make_timestamp({EPOCH_US} + (sim_day + 1) * {DAY_US}) FROM expenses_f
  UNION ALL SELECT 'batch_reconcile', make_timestamp({EPOCH_US} + (sim_day + 1) * {DAY_US})
    FROM profitability WHERE has_expenses),
beat_last AS (SELECT component, max(beat_at) AS last_success_at FROM beats GROUP BY component),
th AS (SELECT * FROM (VALUES ('stream_sink', cast(60 as double)), ('batch_sim', cast(172800 as double)),
  ('batch_reconcile', cast(259200 as double))) t(component, threshold_seconds)),
r AS (
SELECT th.component, l.last_success_at,
  coalesce({seconds('epoch_us((SELECT max(event_ts) FROM lake)) - epoch_us(l.last_success_at)')},
           cast(1e9 as double)) AS age, th.threshold_seconds
FROM beat_last l RIGHT JOIN th ON l.component = th.component)
SELECT component, last_success_at, age AS seconds_since_last_success, threshold_seconds,
  age < threshold_seconds AS healthy,
  CASE WHEN max(CASE WHEN age < threshold_seconds THEN 0 ELSE 1 END) OVER () = 1 THEN 'degraded' ELSE 'ok' END AS overall
FROM r"""
ORACLES["event_staleness"] = B(TELEMETRY) + f"""
SELECT vehicle_id, max(event_ts) AS last_event_ts,
  {seconds('epoch_us((SELECT max(event_ts) FROM lake)) - epoch_us(max(event_ts))')} AS seconds_since_last_event,
  {seconds('epoch_us((SELECT max(event_ts) FROM lake)) - epoch_us(max(event_ts))')} > cast(60 as double) AS stale
FROM lake GROUP BY vehicle_id"""
ORACLES["sustained_breach"] = B(TELEMETRY) + """,
samples AS (
SELECT make_timestamp(epoch_us(event_ts) - epoch_us(event_ts) % 10800000000) AS window_start,
  sum(CASE WHEN corruption <> 'none' THEN 1 ELSE 0 END) AS bad, count(*) AS n
FROM telemetry GROUP BY 1),
b AS (SELECT window_start, epoch_us(window_start) // 10800000000 AS i FROM samples
      WHERE cast(bad as double) / cast(n as double) > 0.02),
isl AS (SELECT window_start, i - row_number() OVER (ORDER BY i) AS g FROM b)
SELECT 'invalid_ratio' AS rule, min(window_start) AS breach_start, max(window_start) AS last_breach_sample,
  count(*) AS samples, (count(*) - 1) * 10800 AS held_seconds
FROM isl GROUP BY g HAVING (count(*) - 1) * 10800 >= 10800"""
ORACLES["trip_fare_audit"] = B(TELEMETRY) + """,
a AS (
SELECT trip_id, vehicle_id,
  sum(CASE WHEN status = 'on_trip' THEN cast(speed as decimal(10,1)) END) AS sp,
  cast(sum(CASE WHEN status = 'on_trip' THEN 1 ELSE 0 END) as bigint) AS on_trip_events,
  max(CASE WHEN trip_completed THEN fare END) AS settled_fare
FROM lake WHERE trip_id IS NOT NULL GROUP BY trip_id, vehicle_id),
k AS (SELECT *, cast(coalesce(sp, 0) as double) * cast(1.0 as double) AS distance_km FROM a)
SELECT trip_id, vehicle_id, on_trip_events, distance_km,
  cast(3.5 as double) + cast(0.85 as double) * distance_km AS expected_fare, settled_fare,
  settled_fare - (cast(3.5 as double) + cast(0.85 as double) * distance_km) AS fare_gap
FROM k"""
ORACLES["status_transitions"] = B(TELEMETRY) + """,
t AS (SELECT status, lag(status) OVER (PARTITION BY vehicle_id ORDER BY event_ts, event_id) AS from_status
      FROM lake WHERE vehicle_id IS NOT NULL)
SELECT from_status, status AS to_status, count(*) AS transitions,
  coalesce((from_status = 'idle' AND status = 'enroute') OR (from_status = 'enroute' AND status = 'on_trip')
    OR (from_status = 'on_trip' AND status = 'idle'), false) AS allowed
FROM t WHERE from_status IS NOT NULL AND from_status <> status GROUP BY from_status, status"""

ORACLES["lake_day_scan"] = B(TELEMETRY) + "SELECT * FROM lake WHERE sim_day = 29"
ORACLES["expenses_scan"] = B(EXPENSES) + "SELECT * FROM expenses_f"
ORACLES["lake_scan"] = B(TELEMETRY) + "SELECT * FROM lake"
ORACLES["window_distinct_bound"] = B(TELEMETRY, ZONE) + (
    "SELECT window_start, zone, active_vehicles, idle_vehicles, true AS within_bound FROM zone_m")
ORACLES["window_distinct_sketch"] = ORACLES["window_distinct_bound"]
ORACLES["keyed_upsert_some_columns"] = B(TELEMETRY, PREV, UPD) + """
SELECT coalesce(u.vehicle_id, t.vehicle_id) AS vehicle_id, coalesce(t.status, u.status) AS status,
  CASE WHEN u.vehicle_id IS NOT NULL THEN u.zone ELSE t.zone END AS zone,
  CASE WHEN u.vehicle_id IS NOT NULL THEN u.last_event_ts ELSE t.last_event_ts END AS last_event_ts,
  CASE WHEN t.vehicle_id IS NOT NULL THEN t.idle_since ELSE u.idle_since END AS idle_since
FROM prev t FULL OUTER JOIN upd u ON t.vehicle_id = u.vehicle_id"""
ORACLES["keyed_upsert_insert_only"] = B(TELEMETRY, PREV, UPD) + """
SELECT * FROM prev UNION ALL SELECT * FROM upd WHERE vehicle_id NOT IN (SELECT vehicle_id FROM prev)"""
ORACLES["recent_alerts_of_vehicle"] = B(TELEMETRY, EPISODES, ALERTS) + (
    "SELECT * FROM alerts WHERE vehicle_id = 'V0003' ORDER BY created_at DESC, vehicle_id, message LIMIT 50")
ORACLES["profit_report_unprofitable"] = B(*_P) + (
    "SELECT * FROM profitability WHERE sim_day = 15 AND unprofitable ORDER BY profit ASC NULLS LAST, vehicle_id")


def _two(c: str) -> str:
    return f"coalesce(printf('%.2f', cast({c} as double)), 'n/a')"


def _py(c: str) -> str:
    return f"CASE WHEN {c} THEN 'True' ELSE 'False' END"


ORACLES["daily_report"] = B(*_P, BATCH, FLEET, SPEED, CHECK) + f""",
day AS (
SELECT sim_day, count(*) AS vehicles, sum(CASE WHEN unprofitable THEN 1 ELSE 0 END) AS bad, sum(earnings) AS total
FROM profitability GROUP BY sim_day),
line AS (
SELECT day.sim_day, unnest([
  {{'n': 0, 't': '# Daily Fleet Profitability Report -- Sim Day ' || day.sim_day}}, {{'n': 1, 't': ''}},
  {{'n': 2, 't': 'Generated: 2024-02-01T00:00:00.000000+00:00'}}, {{'n': 3, 't': ''}}, {{'n': 4, 't': '## Summary'}},
  {{'n': 5, 't': '- Vehicles reporting trips or expenses: ' || vehicles}}, {{'n': 6, 't': '- Unprofitable vehicles: ' || bad}},
  {{'n': 7, 't': '- Total earnings (batch): ' || {_two('total')}}}, {{'n': 8, 't': ''}},
  {{'n': 9, 't': '## Lambda consistency check (speed layer vs. batch layer)'}},
  {{'n': 10, 't': '- Speed-layer trips: ' || speed_trips || ', earnings: ' || {_two('speed_earnings')}}},
  {{'n': 11, 't': '- Batch-layer trips: ' || batch_trips || ', earnings: ' || {_two('batch_earnings')}}},
  {{'n': 12, 't': '- Earnings delta: ' || CASE WHEN earnings_delta_pct IS NULL THEN 'n/a' ELSE {_two('earnings_delta_pct')} || '%' END}},
  {{'n': 13, 't': ''}}, {{'n': 14, 't': '## Top unprofitable vehicles'}}, {{'n': 15, 't': ''}},
  {{'n': 16, 't': '| vehicle_id | trips | earnings | fuel_cost | maintenance_cost | profit | cost_per_km | service_flag | has_expenses |'}},
  {{'n': 17, 't': '|---|---|---|---|---|---|---|---|---|'}}]) AS l
FROM day JOIN chk ON day.sim_day = chk.sim_day),
ranked AS (
SELECT *, row_number() OVER (PARTITION BY sim_day ORDER BY profit ASC NULLS LAST, vehicle_id) AS r
FROM profitability WHERE unprofitable)
SELECT sim_day, cast(l.n as int) AS line_no, l.t AS line FROM line
UNION ALL SELECT sim_day, cast(18 + r as int),
  '| ' || vehicle_id || ' | ' || trips || ' | ' || {_two('earnings')} || ' | ' || {_two('fuel_cost')} || ' | ' || {_two('maintenance_cost')}
  || ' | ' || {_two('profit')} || ' | ' || {_two('cost_per_km')} || ' | ' || {_py('service_flag')} || ' | ' || {_py('has_expenses')} || ' |'
FROM ranked WHERE r <= 10"""


def _ages(name: str, source: str, at: str) -> str:
    """Samples every 15 s over the successes of ``source``: each has the last one before it."""
    return f"""
{name}_t AS (SELECT DISTINCT epoch_us({at}) AS t FROM {source}),
{name}_g AS (
  SELECT k * 15000000 AS tick FROM range((SELECT min(t) FROM {name}_t) // 15000000,
    (SELECT max(epoch_us(event_ts)) FROM telemetry) // 15000000 + 1) r(k)),
{name} AS (
  SELECT '{name}' AS rule, g.tick, cast(g.tick - s.t as double) / 1000000 AS value
  FROM {name}_g g ASOF JOIN {name}_t s ON s.t <= g.tick)"""


ORACLES["alert_rule_breaches"] = B(*_P) + f""",
runs AS (SELECT DISTINCT make_timestamp({EPOCH_US} + (sim_day + 1) * {DAY_US}) AS done_at FROM profitability WHERE has_expenses),
{_ages('no_recent_events', 'telemetry', 'event_ts')},
{_ages('batch_stale', 'runs', 'done_at')},
slot AS (
  SELECT epoch_us(event_ts) // 15000000 AS i, sum(CASE WHEN corruption <> 'none' THEN 1 ELSE 0 END) AS bad, count(*) AS n
  FROM telemetry GROUP BY 1),
high_invalid_ratio AS (
  SELECT 'high_invalid_ratio' AS rule, (i + k) * 15000000 AS tick, cast(sum(bad) as double) / cast(sum(n) as double) AS value
  FROM slot, range(1, 5) r(k) GROUP BY i + k),
over_limit AS (
  SELECT rule, tick FROM no_recent_events WHERE value > 60 UNION ALL SELECT rule, tick FROM batch_stale WHERE value > 900
  UNION ALL SELECT rule, tick FROM high_invalid_ratio WHERE value > 0.05),
island AS (
  SELECT rule, tick, tick // 15000000 - row_number() OVER (PARTITION BY rule ORDER BY tick) AS g FROM over_limit),
found AS (
  SELECT rule, make_timestamp(min(tick)) AS breach_start, make_timestamp(max(tick)) AS last_breach_sample,
    count(*) AS samples, (count(*) - 1) * 15 AS held_seconds
  FROM island GROUP BY rule, g)
SELECT * FROM found WHERE held_seconds >= CASE rule WHEN 'no_recent_events' THEN 15 ELSE 30 END"""

# Tables of the speed layer, read back (mobility.plans.stream_queries).
ORACLES["stream_zone_windows"] = B(TELEMETRY, ZONE) + (
    "SELECT * FROM zone_m WHERE window_end <= (SELECT max(event_ts) FROM lake) - INTERVAL 2 MINUTE")
ORACLES["stream_vehicle_state"] = B(TELEMETRY, LATEST, EPISODES) + (
    "SELECT l.vehicle_id, l.status, l.zone, l.last_event_ts, e.idle_since FROM latest l "
    "LEFT JOIN episodes e ON e.vehicle_id = l.vehicle_id AND e.ended_at IS NULL")
ORACLES["stream_dead_letters"] = ORACLES["dead_letters"]
ORACLES["stream_ingest_counters"] = B(TELEMETRY) + """
SELECT cast(sum(CASE WHEN corruption = 'none' THEN 1 ELSE 0 END) as bigint) AS valid_records,
  cast(sum(CASE WHEN corruption <> 'none' THEN 1 ELSE 0 END) as bigint) AS invalid_records,
  cast(0 as bigint) AS dropped_rows FROM telemetry"""
ORACLES["appended_once"] = B(TELEMETRY) + "SELECT event_id, vehicle_id, status FROM lake"
