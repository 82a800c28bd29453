"""Racing-shaped views over the given tables.

Each view is one SQL text that Spark and DuckDB both run, so the Spark queries and their
check queries start from the same rows. A session is an event type, a driver a user group,
a lap a day. All rows of the base tables are used.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from lapgraph.session import scratch_path

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

VIEWS = {
    "telemetry": """
        SELECT session_id, driver_id, driver_no, lap_number, micro_sector_id, event_ts,
               sequence_number, speed_kph, k,
               CASE WHEN k % 11 = 0 THEN NULL ELSE concat('Driver ', driver_id) END AS driver_name,
               CASE WHEN driver_no = 13 AND session_id = 'error' THEN NULL ELSE k END AS throttle_pct,
               CASE WHEN k % 3 = 0 THEN k ELSE 0 END AS brake_pressure_bar,
               CAST(speed_kph % 97 AS INT) AS engine_rpm,
               100 - k AS battery_pct,
               CAST(100000 - sequence_number % 1000 AS INT) AS fuel_mass_kg,
               CASE WHEN k % 4 = 0 THEN 'ON' ELSE 'OFF' END AS drs_state,
               CASE WHEN k % 17 = 0 THEN 'BLUE' ELSE 'GREEN' END AS flag_state,
               CAST(k * 2 AS DOUBLE) AS gps_lat, CAST(k AS DOUBLE) AS gps_lon
        FROM (SELECT event_type AS session_id,
                     concat('D', lpad(CAST(user_id % 20 AS STRING), 2, '0')) AS driver_id,
                     CAST(user_id % 20 AS INT) AS driver_no, CAST(day(ts) AS INT) AS lap_number,
                     CAST(hour(ts) AS INT) AS micro_sector_id, ts AS event_ts,
                     event_id AS sequence_number,
                     CAST(round(value * 100) AS BIGINT) AS speed_kph,
                     CAST(replace(replace(props, '{"k": ', ''), '}', '') AS INT) AS k
              FROM events) e
    """,
    # The same samples with missing ids, missing and negative laps, and negative speeds.
    "dirty": """
        SELECT CASE WHEN k = 5 THEN NULL ELSE session_id END AS session_id,
               CASE WHEN k = 6 THEN NULL ELSE driver_id END AS driver_id,
               CASE WHEN k = 7 THEN NULL WHEN k = 8 THEN -1 ELSE lap_number END AS lap_number,
               CASE WHEN k = 9 THEN -speed_kph ELSE speed_kph END AS speed_kph,
               gps_lat, gps_lon, sequence_number, event_ts
        FROM telemetry
    """,
    "laps": """
        SELECT session_id, driver_id, driver_no, lap_number, lap_start, n, lap_end, lap_time_ms,
               position, compound, pit_in,
               CASE WHEN (lap_number + driver_no) % 12 = 0 THEN NULL
                    ELSE pit_in + INTERVAL 1 SECOND * CAST(20 + n % 10 AS INT) END AS pit_out,
               CAST(lap_time_ms % 1000 AS BIGINT) AS sector1_ms,
               CAST(lap_time_ms % 700 AS BIGINT) AS sector2_ms,
               CAST(lap_time_ms % 500 AS BIGINT) AS sector3_ms,
               (lap_number + driver_no) % 7 AS tyre_life,
               CAST(floor((lap_number + driver_no) / 7) AS INT) AS stint,
               (lap_number + driver_no) % 7 = 0 AS fresh_tyre
        FROM (SELECT *, CASE WHEN (lap_number + driver_no) % 6 = 0
                             THEN lap_end - INTERVAL 60 SECONDS END AS pit_in
              FROM (SELECT session_id, driver_id, driver_no, lap_number, lap_start, n,
                           CASE WHEN (lap_number + driver_no) % 29 = 0 THEN NULL ELSE lap_end END AS lap_end,
                           CASE WHEN (lap_number * 3 + driver_no) % 37 = 0 THEN NULL ELSE lap_time_ms END AS lap_time_ms,
                           CASE WHEN (lap_number + driver_no * 2) % 31 = 0 THEN NULL ELSE pos END AS position,
                           CASE CAST(floor((lap_number + driver_no) / 7) AS INT) % 3
                                WHEN 0 THEN 'SOFT' WHEN 1 THEN 'MEDIUM' ELSE 'HARD' END AS compound
                    FROM (SELECT *, CAST(row_number() OVER (PARTITION BY session_id, lap_number
                                                            ORDER BY lap_time_ms, driver_id) AS INT) AS pos
                          FROM (SELECT session_id, driver_id, driver_no, lap_number,
                                       min(event_ts) AS lap_start, max(event_ts) AS lap_end,
                                       CAST(sum(speed_kph) AS BIGINT) AS lap_time_ms, count(*) AS n
                                FROM telemetry GROUP BY session_id, driver_id, driver_no, lap_number) a) b) c) d
    """,
    # Race events whose payload is NULL, empty, malformed, a/b form, defender-only or full.
    "interactions": """
        SELECT session_id, sequence_number AS event_id, event_ts, lap_number, driver_name,
               CASE WHEN k % 13 = 0 THEN NULL ELSE driver_id END AS driver_id,
               CASE session_id WHEN 'purchase' THEN 'OVERTAKE' WHEN 'click' THEN 'Battle'
                    ELSE upper(session_id) END AS event_type,
               CASE WHEN session_id = 'purchase' THEN 3.0 ELSE 2.5 END AS interaction_strength,
               CASE WHEN k % 17 = 0 THEN NULL WHEN k % 10 = 0 THEN '' WHEN k % 7 = 0 THEN '{bad'
                    WHEN k % 3 = 0 THEN concat('{"driver_a_id":"', driver_id, '","driver_b_id":"D',
                         lpad(CAST(k % 20 AS STRING), 2, '0'), '","lap_count":', CAST(k % 5 AS STRING), '}')
                    WHEN k % 4 = 0 THEN concat('{"defender_id":"D', lpad(CAST(k % 20 AS STRING), 2, '0'),
                         '","avg_gap_ms":', CAST(speed_kph AS STRING), '}')
                    ELSE concat('{"attacker_id":"', driver_id, '","defender_id":"D',
                         lpad(CAST(k % 20 AS STRING), 2, '0'), '","lap_number":',
                         CAST(lap_number + 1 AS STRING), '}') END AS payload,
               k, speed_kph
        FROM telemetry
    """,
    # Two topics by three partitions; one value in seven k's is malformed.
    "log": """
        SELECT topic, CAST(driver_no % 3 AS INT) AS partition_id, sequence_number AS offset_id,
               concat(driver_id, '_', CAST(lap_number AS STRING)) AS log_key,
               CASE WHEN k % 7 = 0 THEN '{bad'
                    WHEN topic = 'race.events' THEN
                         concat('{"session_id":"', session_id, '","event_id":"', CAST(sequence_number AS STRING),
                                '","event_ts_utc":"', CAST(event_ts AS STRING), '","event_type":"LAP_COMPLETION","driver_id":"',
                                driver_id, '","lap_number":', CAST(lap_number AS STRING), '}')
                    ELSE concat('{"session_id":"', session_id, '","driver_id":"', driver_id,
                                '","lap_number":', CAST(lap_number AS STRING), ',"timestamp_utc":"',
                                CAST(event_ts AS STRING), '","gear":', CAST(k AS STRING),
                                ',"sequence_number":', CAST(sequence_number AS STRING), '}') END AS log_value,
               event_ts AS log_ts, k, session_id, driver_id, lap_number, sequence_number
        FROM (SELECT *, CASE WHEN session_id IN ('purchase', 'click') THEN 'race.events'
                             ELSE 'telemetry.raw' END AS topic FROM telemetry) t
    """,
    "teams": """
        SELECT CAST(n_nationkey AS INT) AS team_id, n_name AS name, r_name AS engine_supplier
        FROM nation JOIN region ON n_regionkey = r_regionkey
    """,
    "drivers": """
        SELECT DISTINCT driver_id, driver_no, concat('Driver ', driver_id) AS driver_name,
               CAST(driver_no % 10 AS INT) AS team_id,
               CASE WHEN driver_no % 3 = 0 THEN NULL ELSE concat('X', driver_id) END AS abbreviation,
               CASE WHEN driver_no % 5 = 0 THEN NULL ELSE concat('Driver ', driver_id) END AS full_name
        FROM telemetry
    """,
    # Customers point at suppliers; returned items point back.
    "graph_big": """
        SELECT DISTINCT CASE WHEN l_returnflag = 'R' THEN concat('S', CAST(l_suppkey AS STRING))
                             ELSE concat('C', CAST(o_custkey AS STRING)) END AS src,
               CASE WHEN l_returnflag = 'R' THEN concat('C', CAST(o_custkey AS STRING))
                    ELSE concat('S', CAST(l_suppkey AS STRING)) END AS dst
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    """,
    "dup_rows": """
        SELECT *, md5(concat(CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING))) AS row_hash
        FROM lineitem
    """,
    "weather": """
        SELECT session_id, event_ts, k AS air_temp, speed_kph AS wind_speed FROM telemetry
    """,
    # Interaction edges with both ends known, straight from the fields the payload was made of.
    "edges": """
        SELECT session_id, event_id, event_ts, event_type, attacker_id, defender_id, lap_number,
               lap_count, avg_gap_ms, interaction_strength, rel
        FROM (SELECT session_id, event_id, event_ts, event_type, interaction_strength,
                     upper(event_type) AS rel,
                     CASE WHEN form = 'ab' THEN raw_driver WHEN form = 'full' THEN raw_driver
                          ELSE driver_id END AS attacker_id,
                     CASE WHEN form IN ('ab', 'def', 'full') THEN other END AS defender_id,
                     CASE WHEN form = 'full' THEN lap_number + 1 ELSE lap_number END AS lap_number,
                     CASE WHEN form = 'ab' THEN k % 5 END AS lap_count,
                     CASE WHEN form = 'def' THEN speed_kph END AS avg_gap_ms
              FROM (SELECT i.*, t.driver_id AS raw_driver,
                           concat('D', lpad(CAST(i.k % 20 AS STRING), 2, '0')) AS other,
                           CASE WHEN i.k % 17 = 0 OR i.k % 10 = 0 OR i.k % 7 = 0 THEN 'none'
                                WHEN i.k % 3 = 0 THEN 'ab' WHEN i.k % 4 = 0 THEN 'def'
                                ELSE 'full' END AS form
                    FROM interactions i JOIN telemetry t ON t.sequence_number = i.event_id) f
              WHERE event_type IN ('OVERTAKE', 'Battle')) g
        WHERE attacker_id IS NOT NULL AND defender_id IS NOT NULL
    """,
}


def needed_views(sql: str) -> list[str]:
    """Names of the views a text uses, directly or through other views, in definition order."""
    needed: set[str] = set()
    frontier = [sql]
    while frontier:
        text = frontier.pop()
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                frontier.append(body)
    return [name for name in VIEWS if name in needed]


def with_views(sql: str) -> str:
    """Prefix a check query with the definitions of the views it uses."""
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in needed_views(sql)]
    body = sql.strip()
    if not parts:
        return body
    if found := re.match(r"WITH\s+RECURSIVE\b", body, re.I):
        return f"WITH RECURSIVE {', '.join(parts)}, {body[found.end():].strip()}"
    if re.match(r"WITH\b", body, re.I):
        return f"WITH {', '.join(parts)}, {body[4:].strip()}"
    return f"WITH {', '.join(parts)} {body}"


class Fixtures:
    """The views as DataFrames: ``fx.telemetry``, ``fx.laps``, ..., and the base tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.table(name)
        if name not in VIEWS:
            raise AttributeError(name)
        body = VIEWS[name]
        for base in BASE_TABLES:
            if re.search(rf"\b{base}\b", body):
                self.table(base).createOrReplaceTempView(base)
        for view in VIEWS:
            if view != name and re.search(rf"\b{view}\b", body):
                getattr(self, view).createOrReplaceTempView(view)
        return self.spark.sql(body)

    def stored(self, name: str) -> DataFrame:
        """A view written as a table first, for work that reads it several times."""
        path = scratch_path(self.spark, name)
        getattr(self, name).write.parquet(path)
        return self.spark.read.parquet(path)

    def kafka_log(self) -> DataFrame:
        """The log under the column names of a Kafka source."""
        return self.log.selectExpr(
            "log_key AS key", "log_value AS value", "topic", "partition_id AS partition",
            "offset_id AS offset", "log_ts AS timestamp",
        )
