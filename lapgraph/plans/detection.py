"""Race events from laps: detectors, as-of laps, neighbours and runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapgraph.operators import interactions as race
from lapgraph.operators.ordered import number_runs
from lapgraph.plans.registry import query


def _named_laps(fx):
    return fx.laps.withColumn("driver_name", F.lit(None).cast("string"))


@query("PRJ15_lap_completions", """
    SELECT session_id, driver_id, lap_number, lap_end AS event_ts, 'LAP_COMPLETION' AS event_type,
           concat(session_id, '_lap_', driver_id, '_', CAST(lap_number AS STRING)) AS event_id,
           md5(concat(session_id, '_lap_', driver_id, '_', CAST(lap_number AS STRING))) AS event_hash,
           1.0::DOUBLE AS interaction_strength, position AS position_delta, lap_time_ms, sector1_ms,
           compound, tyre_life, fresh_tyre
    FROM laps WHERE lap_end IS NOT NULL
""")
def lap_completions(fx):
    body = "lap_time_ms bigint, sector1_ms bigint, compound string, tyre_life int, fresh_tyre boolean"
    events = race.lap_completions(_named_laps(fx))
    return events.withColumn("p", F.from_json("payload", body)).select(
        "session_id", "driver_id", "lap_number", "event_ts", "event_type", "event_id", "event_hash",
        "interaction_strength", "position_delta", "p.*",
    )


@query("PRJ16_pit_stops", """
    SELECT session_id, driver_id, lap_number, pit_in AS event_ts, 'PIT_STOP' AS event_type,
           concat(session_id, '_pit_', driver_id, '_', CAST(lap_number AS STRING)) AS event_id,
           concat('pit_', driver_id, '_', CAST(stint AS STRING)) AS pit_stop_id,
           (epoch_us(coalesce(pit_out, pit_in)) - epoch_us(pit_in)) // 1000 AS pit_duration_ms,
           compound AS compound_before, 2.0::DOUBLE AS interaction_strength
    FROM laps WHERE lap_end IS NOT NULL AND pit_in IS NOT NULL
""")
def pit_stops(fx):
    events = race.pit_stops(_named_laps(fx))
    return events.select(
        "session_id", "driver_id", "lap_number", "event_ts", "event_type", "event_id", "pit_stop_id",
        "pit_duration_ms", F.get_json_object("payload", "$.compound_before").alias("compound_before"),
        "interaction_strength",
    )


MOVES = """
    SELECT c.session_id, c.driver_id, c.lap_number, c.position, p.position AS prev_position,
           c.lap_end, p.lap_end AS prev_lap_end, c.lap_time_ms
    FROM laps c JOIN laps p ON p.session_id = c.session_id AND p.driver_id = c.driver_id
         AND p.lap_number = c.lap_number - 1
    WHERE c.position IS NOT NULL AND p.position IS NOT NULL
"""


@query("WIN2_previous_position", f"SELECT session_id, driver_id, lap_number, position, prev_position FROM ({MOVES}) m")
def previous_position(fx):
    return race.position_moves(fx.laps).select(
        "session_id", "driver_id", "lap_number", "position", "prev_position"
    )


PASSES = f"""
    SELECT a.session_id, a.lap_number, a.driver_id AS attacker_id, d.driver_id AS defender_id, a.lap_end,
           a.prev_position - a.position AS position_delta, d.lap_time_ms - a.lap_time_ms AS delta_time_ms,
           a.prev_lap_end, d.prev_lap_end AS d_prev_lap_end
    FROM ({MOVES}) a JOIN ({MOVES}) d ON a.session_id = d.session_id AND a.lap_number = d.lap_number
    WHERE a.position < a.prev_position AND d.driver_id <> a.driver_id
      AND d.prev_position < a.prev_position AND d.position > a.position
"""


@query("JN6_overtaken_pairs", f"SELECT session_id, lap_number, attacker_id, defender_id FROM ({PASSES}) p")
def overtaken_pairs(fx):
    return race.overtaken_pairs(fx.laps).select(
        "session_id", "lap_number", "attacker_id", "defender_id"
    )


OVERTAKES = f"""
    SELECT session_id, attacker_id, defender_id, lap_number, lap_end AS event_ts,
           concat(session_id, '_overtake_', attacker_id, '_', defender_id, '_', CAST(lap_number AS STRING)) AS event_id,
           CAST(abs(delta_time_ms) AS BIGINT) AS avg_gap_ms, delta_time_ms, position_delta,
           3.0::DOUBLE AS interaction_strength
    FROM ({PASSES}) p WHERE lap_end IS NOT NULL
"""
OVERTAKE_COLUMNS = [
    "session_id", "attacker_id", "defender_id", "lap_number", "event_ts", "event_id", "avg_gap_ms",
    "delta_time_ms", "position_delta", "interaction_strength",
]


@query("DET1_overtakes", OVERTAKES)
def overtakes(fx):
    return race.overtakes(fx.laps).select(*OVERTAKE_COLUMNS)


GAP_MS = 3_600_000


@query("DET5_strict_overtakes", f"""
    SELECT session_id, attacker_id, defender_id, lap_number FROM ({PASSES}) p
    WHERE lap_end IS NOT NULL AND abs(epoch_us(prev_lap_end) - epoch_us(d_prev_lap_end)) // 1000 < {GAP_MS}
""")
def strict_overtakes(fx):
    return race.overtakes(fx.laps, max_gap_ms=GAP_MS).select(*OVERTAKE_COLUMNS[:4])


PAIRS = """
    SELECT session_id, lap_number, least(driver_id, b_id) AS driver_a, greatest(driver_id, b_id) AS driver_b,
           driver_id AS ahead_id, lap_time_ms AS ahead_time, lap_end AS ahead_end, b_time AS behind_time,
           b_end AS behind_end
    FROM (SELECT *, lead(driver_id) OVER w AS b_id, lead(position) OVER w AS b_pos,
                 lead(lap_time_ms) OVER w AS b_time, lead(lap_end) OVER w AS b_end
          FROM laps WHERE position IS NOT NULL
          WINDOW w AS (PARTITION BY session_id, lap_number ORDER BY position, driver_id)) n
    WHERE b_pos - position <= 1
"""


@query("WIN3_adjacent_pairs", PAIRS)
def adjacent_pairs(fx):
    return race.adjacent_pairs(fx.laps)


def _groups(pairs: str) -> str:
    return f"""
        SELECT session_id, driver_a, driver_b, min(lap_number) AS lap_number, CAST(count(*) AS INT) AS lap_count,
               arg_min(row(ahead_time, ahead_end, behind_time), lap_number) AS f
        FROM (SELECT *, lap_number - row_number() OVER (PARTITION BY session_id, driver_a, driver_b
                                                        ORDER BY lap_number) AS island FROM ({pairs}) p) i
        GROUP BY session_id, driver_a, driver_b, island
    """


@query("WIN4_consecutive_groups", f"""
    SELECT session_id, driver_a, driver_b, lap_number, lap_count, f[1] AS ahead_time, f[2] AS ahead_end,
           f[3] AS behind_time FROM ({_groups(PAIRS)}) g
""")
def consecutive_groups(fx):
    return race.consecutive_groups(race.adjacent_pairs(fx.laps))


def _battles(pairs: str, min_laps: int) -> str:
    return f"""
        SELECT session_id, driver_a AS driver_a_id, driver_b AS driver_b_id, lap_number, lap_count,
               f[2] AS event_ts, f[3] - f[1] AS delta_time_ms, CAST(abs(f[3] - f[1]) AS BIGINT) AS avg_gap_ms,
               concat(session_id, '_battle_', driver_a, '_', driver_b, '_', CAST(lap_number AS STRING)) AS event_id
        FROM ({_groups(pairs)}) g WHERE lap_count >= {min_laps} AND f[2] IS NOT NULL
    """


BATTLE_COLUMNS = [
    "session_id", "driver_a_id", "driver_b_id", "lap_number", "lap_count", "event_ts",
    "delta_time_ms", "avg_gap_ms", "event_id",
]


BATTLES = _battles(PAIRS, 2)


@query("DET2_battles", BATTLES)
def battles(fx):
    return race.battles(fx.laps).select(*BATTLE_COLUMNS)


CLOSE_MS = 21_600_000


@query("DET5_strict_battles", _battles(
    f"SELECT * FROM ({PAIRS}) q WHERE abs(epoch_us(ahead_end) - epoch_us(behind_end)) // 1000 < {CLOSE_MS}", 3))
def strict_battles(fx):
    return race.battles(fx.laps, min_laps=3, max_gap_ms=CLOSE_MS).select(*BATTLE_COLUMNS)


NAMES = """
    SELECT driver_id, CASE WHEN driver_no % 3 <> 0 THEN concat('X', driver_id)
           WHEN driver_no % 5 <> 0 THEN concat('Driver ', driver_id) ELSE driver_id END AS driver_name
    FROM drivers
"""
ALL_EVENTS = f"""
    SELECT event_id, event_ts, event_type, e.driver_id, d.driver_name, lap_number, pit_duration_ms,
           md5(event_id) AS event_hash, interaction_strength, position_delta, sector_time_delta_ms
    FROM (
        SELECT concat(session_id, '_lap_', driver_id, '_', CAST(lap_number AS STRING)) AS event_id,
               lap_end AS event_ts, 'LAP_COMPLETION' AS event_type, driver_id, lap_number,
               CAST(NULL AS BIGINT) AS pit_duration_ms, 1.0::DOUBLE AS interaction_strength,
               position AS position_delta, CAST(NULL AS BIGINT) AS sector_time_delta_ms
        FROM laps WHERE lap_end IS NOT NULL
        UNION ALL
        SELECT concat(session_id, '_pit_', driver_id, '_', CAST(lap_number AS STRING)), pit_in, 'PIT_STOP', driver_id,
               lap_number, (epoch_us(coalesce(pit_out, pit_in)) - epoch_us(pit_in)) // 1000, 2.0, NULL, NULL
        FROM laps WHERE lap_end IS NOT NULL AND pit_in IS NOT NULL
        UNION ALL
        SELECT event_id, event_ts, 'OVERTAKE', attacker_id, lap_number, NULL, 3.0, position_delta, delta_time_ms
        FROM ({OVERTAKES}) o
        UNION ALL
        SELECT event_id, event_ts, 'BATTLE', driver_a_id, lap_number, NULL, 2.5, NULL, delta_time_ms
        FROM ({_battles(PAIRS, 2)}) b) e
    LEFT JOIN ({NAMES}) d ON d.driver_id = e.driver_id
"""
EVENT_CHECKED = [
    "event_id", "event_ts", "event_type", "driver_id", "driver_name", "lap_number",
    "pit_duration_ms", "event_hash", "interaction_strength", "position_delta", "sector_time_delta_ms",
]


@query("DET3_race_events", ALL_EVENTS)
def race_events(fx):
    return race.race_events(fx.stored("laps"), fx.drivers).select(*EVENT_CHECKED)


@query("SET4_event_counts", f"SELECT event_type, count(*) AS events FROM ({ALL_EVENTS}) e GROUP BY event_type")
def event_counts(fx):
    return race.race_events(fx.stored("laps"), fx.drivers).groupBy("event_type").agg(F.count("*").alias("events"))


MARKS = "SELECT * FROM laps WHERE lap_end IS NOT NULL"
PLACED = f"""
    SELECT t.sequence_number, t.session_id, t.driver_id, coalesce(m.lap_number, 0) AS lap_number,
           m.compound, m.tyre_life
    FROM telemetry t ASOF LEFT JOIN ({MARKS}) m
      ON t.session_id = m.session_id AND t.driver_id = m.driver_id AND t.event_ts <= m.lap_end
"""


@query("JN4_asof_lap", PLACED)
def asof_lap(fx):
    samples = fx.telemetry.select("sequence_number", "session_id", "driver_id", "event_ts")
    return race.with_laps(samples, fx.laps, ["compound", "tyre_life"]).drop("event_ts")


WEATHER = "SELECT session_id, arg_max(row(air_temp, wind_speed), event_ts) AS w FROM weather GROUP BY session_id"


@query("JN5_latest_weather", f"SELECT session_id, w[1] AS air_temp, w[2] AS wind_speed FROM ({WEATHER}) x")
def latest_weather(fx):
    return race.latest_weather(fx.weather, ["air_temp", "wind_speed"])


@query("DET4_telemetry_records", f"""
    SELECT p.sequence_number, p.lap_number, p.compound, p.tyre_life, w[1] AS air_temp, w[2] AS wind_speed,
           md5(concat(p.session_id, '_', p.driver_id, '_', CAST(p.sequence_number AS STRING), '_',
                      CAST(epoch_us(t.event_ts) AS STRING))) AS telemetry_hash,
           round(1.0::DOUBLE / (p.sequence_number + 1), 6) AS sampling_weight,
           concat(p.session_id, '_', p.driver_id, '_', CAST(p.lap_number AS STRING)) AS correlation_id
    FROM ({PLACED}) p JOIN telemetry t ON t.sequence_number = p.sequence_number
    JOIN ({WEATHER}) w ON w.session_id = p.session_id
""")
def telemetry_records(fx):
    samples = fx.telemetry.select("sequence_number", "session_id", "driver_id", "event_ts")
    return race.telemetry_records(
        samples, fx.laps, fx.weather,
        ["compound", "tyre_life"], ["air_temp", "wind_speed"],
    ).drop("session_id", "driver_id", "event_ts")


@query("WIN4_compound_runs", """
    SELECT session_id, driver_id, lap_number,
           CAST(sum(opens) OVER (PARTITION BY session_id, driver_id ORDER BY lap_number) AS BIGINT) AS run_no
    FROM (SELECT *, CASE WHEN lag(compound) OVER w IS DISTINCT FROM compound THEN 1 ELSE 0 END AS opens
          FROM laps WINDOW w AS (PARTITION BY session_id, driver_id ORDER BY lap_number)) l
""")
def compound_runs(fx):
    laps = fx.laps.select("session_id", "driver_id", "lap_number", "compound")
    return number_runs(
        laps, ["session_id", "driver_id"], "lap_number", ["compound"],
        lambda prev: ~prev["compound"].eqNullSafe(F.col("compound")), race.LAP_BLOCK, "run_no",
    ).drop("compound")
