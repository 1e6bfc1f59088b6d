"""SQL over the test tables with the same results as the queries.

Written from the meaning of each operator: one typed pass over `events` and `orders`, the joined
silver rows spelled out, and plain group-bys over them.
"""

from __future__ import annotations

RAW_AIR = """
  SELECT event_type AS station, strftime(ts, '%d/%m/%Y %H:%M') AS datetime,
         value AS pollution_value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS air_quality_index,
         CAST(user_id - 60 AS DOUBLE) AS temperature,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) * 1.1::DOUBLE AS humidity,
         CAST(event_id % 200 - 100 AS DOUBLE) AS latitude,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         CAST(day(ts) AS INTEGER) AS day
  FROM events"""

TRAFFIC_CSV = """
  SELECT 'Bd_' || substr(o_orderpriority, 3) AS libelle,
         strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)),
                  '%Y-%m-%dT%H:%M:%S') AS date_et_heure_de_comptage,
         CAST(CAST(o_totalprice * (o_orderkey % 24 + 5) / 5000 AS DECIMAL(18,6)) AS VARCHAR)
           AS debit_horaire,
         CASE WHEN o_orderstatus = 'O' THEN 'Ouvert' ELSE 'Invalide' END AS etat_arc
  FROM orders"""

INGEST_DATE = "2024 AS year, 1 AS month, 31 AS day"

AIR_OK = (
    "value IS NOT NULL AND isfinite(value) AND k >= 0 AND user_id - 60 BETWEEN -50 AND 60 "
    "AND k * 1.1::DOUBLE BETWEEN 0 AND 100 AND event_id % 200 - 100 BETWEEN -90 AND 90"
)
TRAFFIC_OK = "debit >= 0 AND isfinite(debit) AND o_orderstatus = 'O'"

# Typed rows with zone and hour, before validation.
SIDES = """
WITH a AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         event_type AS zone, CAST(hour(ts) AS INTEGER) AS hour
  FROM events
), t AS (
  SELECT *, CAST(CAST(o_totalprice * (o_orderkey % 24 + 5) / 5000 AS DECIMAL(18,6)) AS DOUBLE)
           AS debit,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'error' WHEN '2-HIGH' THEN 'purchase'
              WHEN '5-LOW' THEN 'view' WHEN '3-MEDIUM' THEN 'click'
              WHEN '4-NOT SPECIFIED' THEN 'click' END AS zone,
         CAST(hour(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))) AS INTEGER) AS hour
  FROM orders
)"""

SILVER = f"""{SIDES}, s AS (
  SELECT a.zone, a.hour, a.value AS pollution_value, a.k AS air_quality_index,
         CAST(a.user_id - 60 AS DOUBLE) AS temperature, a.k * 1.1::DOUBLE AS humidity,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         CAST(day(ts) AS INTEGER) AS day, t.debit AS debit_horaire
  FROM a JOIN t ON a.zone = t.zone AND a.hour = t.hour
  WHERE {AIR_OK} AND {TRAFFIC_OK}
)"""


def _round(value: str, places: int = 2) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(18,6)), {places}) AS DOUBLE)"


def _mean(name: str, places: int = 2) -> str:
    return f"{_round(f'avg({name})', places)} AS {name}"


def _top(name: str, places: int = 2) -> str:
    return f"{_round(f'max({name})', places)} AS {name}"


LEVEL = (
    "CASE WHEN avg_traffic < 500 THEN 'Low Traffic' "
    "WHEN avg_traffic >= 500 AND avg_traffic < 1000 THEN 'Medium Traffic' "
    "ELSE 'High Traffic' END AS traffic_level"
)

# The three marts over the joined rows: p, m and b.
MARTS = f"""{SILVER}, p AS (
  SELECT zone, year, month, day, {_round("avg(pollution_value)")} AS avg_pollution,
         {_round("max(pollution_value)")} AS max_pollution,
         {_round("avg(air_quality_index)")} AS avg_aqi
  FROM s GROUP BY zone, year, month, day
), m AS (
  SELECT zone, hour, year, month, day, {_round("avg(debit_horaire)")} AS avg_traffic,
         {_round("max(debit_horaire)")} AS max_traffic
  FROM s GROUP BY zone, hour, year, month, day
), b AS (
  SELECT *, {LEVEL} FROM (
    SELECT zone, hour, year, month, day, {_round("avg(pollution_value)")} AS avg_pollution,
           {_round("avg(debit_horaire)")} AS avg_traffic,
           {_round("avg(temperature)")} AS avg_temperature,
           {_round("avg(humidity)")} AS avg_humidity
    FROM s GROUP BY zone, hour, year, month, day)
)"""

# The dashboard selections over them: pf, mf and bf.
SELECTED = f"""{MARTS}, pf AS (
  SELECT * FROM p WHERE zone IN ('click', 'error', 'view')
), mf AS (
  SELECT * FROM m WHERE zone IN ('click', 'error', 'view') AND hour BETWEEN 6 AND 20
), bf AS (
  SELECT * FROM b WHERE zone IN ('click', 'error', 'view') AND hour BETWEEN 6 AND 20
    AND traffic_level IN ('Medium Traffic', 'High Traffic')
), pz AS (
  SELECT zone, {_mean("avg_pollution", 1)}, {_top("max_pollution", 1)}, {_mean("avg_aqi", 1)}
  FROM pf GROUP BY zone
), mz AS (
  SELECT zone, {_mean("avg_traffic", 1)}, {_top("max_traffic", 1)} FROM mf GROUP BY zone
), bz AS (
  SELECT zone, {_mean("avg_traffic", 1)}, {_mean("avg_pollution", 1)},
         {_mean("avg_temperature", 1)}, {_mean("avg_humidity", 1)}
  FROM bf GROUP BY zone
)"""

TITLE = "upper(substr(zone, 1, 1)) || substr(zone, 2)"

ZONE_TEXT = "replace(replace(substr(o_orderpriority, 3), 'Bd_', ''), ' ', '_')"

QUALITY = f"""{SIDES}, checks AS (
  SELECT 'air' AS source, count(*) AS rows,
    count(*) FILTER (value IS NULL) AS pollution_present,
    count(*) FILTER (NOT coalesce(isfinite(value), true)) AS pollution_finite,
    count(*) FILTER (NOT coalesce(k >= 0, false)) AS aqi_not_negative,
    count(*) FILTER (NOT coalesce(user_id - 60 BETWEEN -50 AND 60, false)) AS temperature_in_range,
    count(*) FILTER (NOT coalesce(k * 1.1::DOUBLE BETWEEN 0 AND 100, false)) AS humidity_in_range,
    count(*) FILTER (NOT coalesce(event_id % 200 - 100 BETWEEN -90 AND 90, false))
      AS latitude_in_range,
    count(*) FILTER (ts IS NULL) AS time_readable,
    count(*) FILTER (NOT coalesce(({AIR_OK} AND ts IS NOT NULL), false)) AS any_rule
  FROM a
), checks_t AS (
  SELECT 'traffic' AS source, count(*) AS rows,
    count(*) FILTER (debit IS NULL) AS count_present,
    count(*) FILTER (NOT coalesce(debit >= 0, false)) AS count_not_negative,
    count(*) FILTER (NOT coalesce(isfinite(debit), true)) AS count_finite,
    count(*) FILTER (NOT coalesce(o_orderstatus = 'O', false)) AS segment_open,
    count(*) FILTER (o_orderdate IS NULL) AS time_readable,
    count(*) FILTER (NOT coalesce(({TRAFFIC_OK} AND o_orderdate IS NOT NULL), false)) AS any_rule
  FROM t
)
SELECT source, rows, rule, failed FROM
  (UNPIVOT checks ON pollution_present, pollution_finite, aqi_not_negative, temperature_in_range, humidity_in_range,
    latitude_in_range, time_readable, any_rule INTO NAME rule VALUE failed)
UNION ALL
SELECT source, rows, rule, failed FROM
  (UNPIVOT checks_t ON count_present, count_not_negative, count_finite, segment_open, time_readable, any_rule
   INTO NAME rule VALUE failed)"""


def _kpi() -> str:
    title = "upper(substr({0}, 1, 1)) || substr({0}, 2)".format
    first_polluted = "(SELECT zone FROM pz ORDER BY avg_pollution DESC, zone LIMIT 1)"
    last_polluted = "(SELECT zone FROM pz ORDER BY avg_pollution, zone DESC LIMIT 1)"
    first_congested = "(SELECT zone FROM mz ORDER BY avg_traffic DESC, zone LIMIT 1)"
    peak = "(SELECT hour FROM mf GROUP BY hour ORDER BY avg(avg_traffic) DESC, hour LIMIT 1)"
    return f"""{SELECTED}
    SELECT {title(first_polluted)} AS most_polluted, {title(first_congested)} AS most_congested,
           lpad(CAST({peak} AS VARCHAR), 2, '0') || 'h' AS peak_hour,
           (SELECT {_round("avg(avg_pollution)", 1)} FROM pz) AS avg_pollution,
           {title(last_polluted)} AS cleanest"""


def _pivot() -> str:
    cells = ", ".join(
        f"coalesce({_round(f'avg(avg_traffic) FILTER (hour = {h})', 1)}, 0) AS \"{h:02d}h\""
        for h in range(24)
    )
    return f"""{MARTS} SELECT {TITLE} AS zone, {cells} FROM m
    WHERE zone IN ('error', 'click', 'view', 'purchase') GROUP BY zone"""


def oracle_sql() -> dict[str, str]:
    return {
        "csv_roundtrip": TRAFFIC_CSV,
        "scan_raw_air": RAW_AIR,
        "scan_raw_traffic": f"SELECT *, {INGEST_DATE} FROM ({TRAFFIC_CSV})",
        "stamp_ingest_date": f"SELECT *, {INGEST_DATE} FROM ({TRAFFIC_CSV})",
        "dedup_air": f"""SELECT DISTINCT * EXCLUDE (year, month, day), {INGEST_DATE}
            FROM ({RAW_AIR})""",
        "dedup_by_index": f"""SELECT DISTINCT * EXCLUDE (year, month, day), 2024 AS year, 1 AS month,
            CASE air_quality_index % 3 WHEN 0 THEN 1 WHEN 1 THEN 4 ELSE 3 END AS day
            FROM ({RAW_AIR}) WHERE air_quality_index IS NOT NULL""",
        "air_hour": """SELECT event_type AS station, strftime(ts, '%d/%m/%Y %H:%M') AS datetime,
            CAST(hour(ts) AS INTEGER) AS hour FROM events""",
        "traffic_hour": f"""SELECT libelle, date_et_heure_de_comptage,
            CAST(hour(CAST(date_et_heure_de_comptage AS TIMESTAMP)) AS INTEGER) AS hour
            FROM ({TRAFFIC_CSV})""",
        "air_zone": """SELECT event_type AS station, strftime(ts, '%d/%m/%Y %H:%M') AS datetime,
            lower(replace(replace(event_type, '-', '_'), ' ', '_')) AS zone FROM events""",
        "traffic_zone": f"""SELECT libelle, date_et_heure_de_comptage,
            lower(replace(replace(libelle, 'Bd_', ''), ' ', '_')) AS zone FROM ({TRAFFIC_CSV})""",
        "zone_mapping": f"""SELECT libelle, date_et_heure_de_comptage, coalesce(mapped, z) AS zone
            FROM (SELECT *, lower(replace(replace(libelle, 'Bd_', ''), ' ', '_')) AS z
                  FROM ({TRAFFIC_CSV}))
            LEFT JOIN (VALUES ('urgent', 'error'), ('high', 'purchase'), ('medium', 'click'),
                       ('not_specified', 'click'), ('low', 'view')) AS dim(label, mapped)
              ON z = label""",
        "validate_air": f"""SELECT * FROM ({RAW_AIR}) WHERE pollution_value IS NOT NULL
            AND air_quality_index >= 0 AND temperature BETWEEN -50 AND 60
            AND humidity BETWEEN 0 AND 100 AND latitude BETWEEN -90 AND 90""",
        "validate_traffic": f"""SELECT *, {INGEST_DATE} FROM ({TRAFFIC_CSV})
            WHERE CAST(debit_horaire AS DOUBLE) >= 0 AND etat_arc = 'Ouvert'""",
        "rejected_air": f"""SELECT * FROM (SELECT *, CAST(
              (CASE WHEN pollution_value IS NOT NULL THEN 0 ELSE 1 END)
              + (CASE WHEN coalesce(isfinite(pollution_value), true) THEN 0 ELSE 2 END)
              + (CASE WHEN air_quality_index >= 0 THEN 0 ELSE 4 END)
              + (CASE WHEN temperature BETWEEN -50 AND 60 THEN 0 ELSE 8 END)
              + (CASE WHEN humidity BETWEEN 0 AND 100 THEN 0 ELSE 16 END)
              + (CASE WHEN latitude BETWEEN -90 AND 90 THEN 0 ELSE 32 END) AS BIGINT) AS failed_rules
            FROM ({RAW_AIR})) WHERE failed_rules <> 0""",
        "quality_report": QUALITY,
        "silver_join": f"{SILVER} SELECT * FROM s",
        "silver_view": f"{SILVER} SELECT * FROM s",
        "silver_digest": f"""{SILVER} SELECT zone, hour, CAST(count(*) AS DECIMAL(38,0)) AS pairs,
            max(pollution_value) AS max_pollution, min(debit_horaire) AS min_traffic,
            max(debit_horaire) AS max_traffic FROM s GROUP BY zone, hour""",
        "rolling_avg_pollution": f"""{SILVER}, w AS (SELECT zone, hour,
              avg(pollution_value) OVER (PARTITION BY zone ORDER BY hour) AS mean FROM s)
            SELECT zone, hour, {_round("any_value(mean)", 4)} AS rolling_avg_pollution
            FROM w GROUP BY zone, hour""",
        "silver_roundtrip": f"""{SILVER}, w AS (SELECT *,
              avg(pollution_value) OVER (PARTITION BY zone ORDER BY hour) AS mean FROM s)
            SELECT * EXCLUDE (mean), {_round("mean", 4)} AS rolling_avg_pollution FROM w""",
        "hourly_traffic": f"""{SILVER} SELECT hour,
            {_round("avg(debit_horaire)", 4)} AS avg_hourly_traffic FROM s GROUP BY hour""",
        "layer_counts": f"""{SILVER}
            SELECT layer, CAST(row_count AS DECIMAL(38,0)) AS row_count FROM (
              SELECT 'raw_air' AS layer, (SELECT count(*) FROM events) AS row_count UNION ALL
              SELECT 'raw_traffic', (SELECT count(*) FROM orders) UNION ALL
              SELECT 'valid_air', (SELECT count(*) FROM a WHERE {AIR_OK}) UNION ALL
              SELECT 'valid_traffic', (SELECT count(*) FROM t WHERE {TRAFFIC_OK}) UNION ALL
              SELECT 'silver', (SELECT count(*) FROM s))""",
        "datamart_pollution": f"{MARTS} SELECT * FROM p",
        "datamart_traffic": f"{MARTS} SELECT * FROM m",
        "datamart_traffic_pollution": f"{MARTS} SELECT * FROM b",
        "traffic_level": f"""{MARTS} SELECT zone, hour, year, month, day, avg_traffic, {LEVEL}
            FROM m""",
        "pollution_page": f"""{MARTS} SELECT * FROM p WHERE zone = 'click'
            ORDER BY avg_pollution DESC, zone, year, month, day LIMIT 10 OFFSET 10""",
        "traffic_page": f"""{MARTS} SELECT * FROM m WHERE zone = 'click'
            ORDER BY avg_traffic DESC, zone, hour, year, month, day LIMIT 20 OFFSET 20""",
        "traffic_page_after": f"""{MARTS} SELECT * FROM m WHERE zone = 'click'
            ORDER BY avg_traffic DESC, zone, hour, year, month, day LIMIT 20 OFFSET 20""",
        "traffic_pollution_page": f"""{MARTS} SELECT * FROM b WHERE traffic_level = 'High Traffic'
            ORDER BY avg_traffic DESC, zone, hour, year, month, day LIMIT 50 OFFSET 100""",
        "pollution_summary": f"""{MARTS} SELECT zone, {_mean("avg_pollution")},
            {_top("max_pollution")}, {_mean("avg_aqi")} FROM p GROUP BY zone""",
        "traffic_by_hour": f"""{MARTS} SELECT hour, {_mean("avg_traffic")}, {_top("max_traffic")}
            FROM m GROUP BY hour""",
        "traffic_by_zone": f"""{MARTS} SELECT zone, {_mean("avg_traffic")}, {_top("max_traffic")}
            FROM m GROUP BY zone""",
        "traffic_heatmap": f"""{MARTS} SELECT zone, hour, {_mean("avg_traffic")}
            FROM m GROUP BY zone, hour""",
        "traffic_pollution_summary": f"""{MARTS} SELECT zone, {_mean("avg_traffic")},
            {_mean("avg_pollution")}, {_mean("avg_temperature")}, {_mean("avg_humidity")}
            FROM b GROUP BY zone""",
        "traffic_pollution_by_level": f"""{MARTS} SELECT traffic_level, count(*) AS count,
            {_mean("avg_pollution")}, {_mean("avg_temperature")}, {_mean("avg_humidity")}
            FROM b GROUP BY traffic_level""",
        "dash_filter_pollution": f"{SELECTED} SELECT * FROM pf",
        "dash_filter_traffic": f"{SELECTED} SELECT * FROM mf",
        "dash_filter_tp": f"{SELECTED} SELECT * FROM bf",
        "dash_pollution_by_zone": f"{SELECTED} SELECT * FROM pz",
        "dash_traffic_by_zone": f"{SELECTED} SELECT * FROM mz",
        "dash_traffic_by_hour_zone": f"""{SELECTED} SELECT hour, zone, {_mean("avg_traffic", 1)}
            FROM mf GROUP BY hour, zone""",
        "dash_heatmap_pivot": _pivot(),
        "dash_tp_by_zone": f"{SELECTED} SELECT * FROM bz",
        "dash_by_level": f"""{SELECTED} SELECT traffic_level, {_mean("avg_pollution", 1)},
            count(avg_pollution) AS count FROM bf GROUP BY traffic_level""",
        "dash_level_bars": f"""{SELECTED} SELECT replace(traffic_level, ' Traffic', '')
            AS traffic_level, {_round("avg(avg_pollution)", 1)} AS avg_pollution,
            count(avg_pollution) AS count FROM bf GROUP BY bf.traffic_level""",
        "kpi_board": _kpi(),
        "pollution_share": f"""{SELECTED} SELECT {TITLE} AS zone, avg_pollution,
            {_round("avg_pollution * 100.0::DOUBLE / sum(avg_pollution) OVER ()", 1)}
              AS share_percent FROM pz""",
        "env_conditions": f"""{SELECTED} SELECT {TITLE} AS zone, avg_temperature, avg_humidity
            FROM bz""",
        "tp_bubble": f"""{SELECTED} SELECT {TITLE} AS zone, avg_traffic, avg_pollution,
            avg_temperature, avg_humidity,
            {_round("greatest(20.0::DOUBLE, avg_humidity * 0.7::DOUBLE)", 2)} AS bubble_size
            FROM bz""",
        "traffic_pollution_corr": f"""{MARTS} SELECT zone, count(*) AS count,
            {_round("corr(avg_traffic, avg_pollution)", 4)} AS correlation
            FROM b GROUP BY ROLLUP (zone)""",
    }
