"""Fact tables, stints, pace, KPIs, range joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapgraph.operators import facts, interactions as race
from lapgraph.operators.graph import interactions_of
from lapgraph.plans.detection import OVERTAKE_COLUMNS, OVERTAKES
from lapgraph.plans.registry import query
from lapgraph.session import scratch_path
from lapgraph.sources.sinks import write_tables

FACT_LAP = """
    SELECT s.*, l.lap_time_ms, l.sector1_ms, l.sector2_ms, l.sector3_ms, l.compound AS tyre_compound
    FROM (SELECT session_id, driver_id, lap_number, CAST(min(speed_kph) AS BIGINT) AS min_speed_kph,
                 round(avg(speed_kph), 6) AS avg_speed_kph, CAST(max(speed_kph) AS BIGINT) AS max_speed_kph,
                 arg_min(fuel_mass_kg, sequence_number) - arg_max(fuel_mass_kg, sequence_number) AS fuel_used_kg,
                 arg_max(battery_pct, sequence_number) - arg_min(battery_pct, sequence_number) AS battery_delta_pct
          FROM telemetry GROUP BY session_id, driver_id, lap_number) s
    LEFT JOIN laps l ON s.session_id = l.session_id AND s.driver_id = l.driver_id AND s.lap_number = l.lap_number
"""


@query("AGG16_fact_lap", FACT_LAP)
def fact_lap(fx):
    return facts.fact_lap(fx.telemetry, fx.laps)


STINTS = """
    SELECT session_id, driver_id, lap_number, compound, lap_time_ms,
           CAST(sum(opens) OVER (PARTITION BY session_id, driver_id ORDER BY lap_number) AS BIGINT) AS stint_no
    FROM (SELECT *, CASE WHEN lag(compound) OVER w IS DISTINCT FROM compound OR lag(pit_in) OVER w IS NOT NULL
                         THEN 1 ELSE 0 END AS opens
          FROM laps WINDOW w AS (PARTITION BY session_id, driver_id ORDER BY lap_number)) l
"""


@query("WIN5_stints", f"""
    SELECT session_id, driver_id, lap_number, stint_no,
           concat(session_id, ':', driver_id, ':', CAST(stint_no AS STRING)) AS stint_id FROM ({STINTS}) s
""")
def stints(fx):
    return facts.with_stints(fx.laps).select(
        "session_id", "driver_id", "lap_number", "stint_no", "stint_id"
    )


FACT_STINT = f"""
    SELECT s.session_id, s.driver_id, concat(s.session_id, ':', s.driver_id, ':', CAST(stint_no AS STRING)) AS stint_id,
           min(compound) AS tyre_compound, min(s.lap_number) AS start_lap, max(s.lap_number) AS end_lap,
           round(avg(s.lap_time_ms), 6) AS avg_pace_ms,
           round(CAST(count(s.lap_time_ms) * sum(s.lap_number * s.lap_time_ms)
                      - sum(s.lap_number) FILTER (WHERE s.lap_time_ms IS NOT NULL) * sum(s.lap_time_ms) AS DOUBLE)
             / nullif(count(s.lap_time_ms) * sum(s.lap_number * s.lap_number) FILTER (WHERE s.lap_time_ms IS NOT NULL)
                      - (sum(s.lap_number) FILTER (WHERE s.lap_time_ms IS NOT NULL))
                        * (sum(s.lap_number) FILTER (WHERE s.lap_time_ms IS NOT NULL)), 0), 6) AS degradation_ms_per_lap,
           CAST(sum(f.fuel_used_kg) AS BIGINT) AS total_fuel_kg
    FROM ({STINTS}) s LEFT JOIN ({FACT_LAP}) f
      ON s.session_id = f.session_id AND s.driver_id = f.driver_id AND s.lap_number = f.lap_number
    GROUP BY s.session_id, s.driver_id, stint_no
"""


@query("AGG17_fact_stint", FACT_STINT)
def fact_stint(fx):
    laps = fx.stored("laps")
    return facts.fact_stint(facts.with_stints(laps), facts.fact_lap(fx.telemetry, laps))


DRIVER_SESSION = """
    SELECT session_id, driver_id, CAST(sum(made) AS BIGINT) AS overtakes_made, CAST(sum(received) AS BIGINT) AS overtakes_received,
           round(sum(made) / sum(made + received), 6) AS success_rate,
           round(sum(made - received) / sum(made + received), 6) AS influence_score
    FROM (SELECT session_id, attacker_id AS driver_id, 1 AS made, 0 AS received FROM {edges}
          UNION ALL SELECT session_id, defender_id, 0, 1 FROM {edges}) u
    GROUP BY session_id, driver_id
"""


@query("AGG18_fact_driver_session", DRIVER_SESSION.format(edges=f"({OVERTAKES}) o"))
def fact_driver_session(fx):
    return facts.fact_driver_session(race.overtakes(fx.laps))


def _battle_edges(fx):
    return interactions_of(fx.interactions, "battle")


@query("AGG19_team_battles", """
    SELECT least(a.team_id, d.team_id) AS team_a, greatest(a.team_id, d.team_id) AS team_b, count(*) AS battle_count,
           round(avg(lap_count), 6) AS avg_battle_laps, CAST(sum(lap_count) AS BIGINT) AS battle_laps
    FROM edges e LEFT JOIN drivers a ON a.driver_id = e.attacker_id LEFT JOIN drivers d ON d.driver_id = e.defender_id
    WHERE rel = 'BATTLE' GROUP BY ALL
""")
def team_battles(fx):
    return facts.team_battles(_battle_edges(fx), fx.drivers)


@query("AGG20_interaction_strength", """
    SELECT session_id, attacker_id, defender_id, count(*) AS events,
           CAST(sum(CAST(floor(CAST(coalesce(lap_count, 1) AS DOUBLE) * 1000000000.0
                     / (1000.0 + CAST(coalesce(avg_gap_ms, 0) AS DOUBLE))) AS BIGINT)) AS BIGINT) AS strength_micro
    FROM edges GROUP BY session_id, attacker_id, defender_id
""")
def interaction_strength(fx):
    both = interactions_of(fx.interactions, "overtake", "battle")
    return facts.interaction_strength(both)


@query("AGG21_pace_consistency", """
    SELECT session_id, driver_id, count(*) AS laps, round(avg(lap_time_ms), 3) AS mean_ms,
           round(stddev_samp(lap_time_ms), 3) AS stddev_ms,
           round(avg(lap_time_ms) - 1.96::DOUBLE * stddev_samp(lap_time_ms) / sqrt(count(*)), 3) AS ci_low_ms,
           round(avg(lap_time_ms) + 1.96::DOUBLE * stddev_samp(lap_time_ms) / sqrt(count(*)), 3) AS ci_high_ms,
           round(1.0::DOUBLE / (1.0::DOUBLE + stddev_samp(lap_time_ms) / avg(lap_time_ms)), 6) AS consistency
    FROM laps WHERE lap_time_ms IS NOT NULL GROUP BY session_id, driver_id
""")
def pace_consistency(fx):
    table = facts.pace_consistency(fx.laps)
    return table.withColumns(
        {c: F.round(c, 3) for c in ["mean_ms", "stddev_ms", "ci_low_ms", "ci_high_ms"]}
    )


@query("AGG24_interaction_nodes", """
    SELECT session_id, least(attacker_id, defender_id) AS driver_a, greatest(attacker_id, defender_id) AS driver_b,
           round(avg(CAST(interaction_strength AS DOUBLE)), 6) AS avg_strength, count(*) AS interactions,
           concat(session_id, ':', least(attacker_id, defender_id), ':', greatest(attacker_id, defender_id)) AS interaction_id,
           TRUE AS within_bound
    FROM edges GROUP BY ALL
""")
def interaction_nodes(fx):
    both = interactions_of(fx.interactions, "overtake", "battle")
    good = F.abs(F.col("unique_interactions") - F.col("interactions")) <= F.greatest(
        F.col("interactions") * 0.15, F.lit(1.0)
    )
    return facts.interaction_nodes(both).withColumn("within_bound", good).drop("unique_interactions")


@query("AGG24_sector_comparisons", """
    SELECT session_id, micro_sector_id, driver_id,
           round(CAST(s AS DOUBLE) / n - CAST(sum(s) OVER w AS DOUBLE) / sum(n) OVER w, 6) AS avg_delta,
           concat(session_id, ':', driver_id, ':', CAST(micro_sector_id AS STRING)) AS sector_comp_id
    FROM (SELECT session_id, micro_sector_id, driver_id, sum(speed_kph) AS s, count(speed_kph) AS n
          FROM telemetry GROUP BY ALL) t
    WINDOW w AS (PARTITION BY session_id, micro_sector_id)
""")
def sector_comparisons(fx):
    return facts.sector_comparisons(fx.telemetry)


@query("AGG25_lap_kpis", """
    SELECT session_id, driver_id, lap_number,
           count(*) FILTER (WHERE brake_pressure_bar > 0) AS braking_samples,
           round(avg(speed_kph) FILTER (WHERE p_brake > 0 AND throttle_pct > p_throttle), 6) AS corner_exit_speed,
           CAST(max(speed_kph) AS BIGINT) AS straight_speed,
           CAST(coalesce(sum(epoch(date_trunc('second', event_ts)) - epoch(date_trunc('second', p_ts)))
                FILTER (WHERE p_flag = 'BLUE'), 0) AS BIGINT) AS blue_flag_seconds,
           round(CAST(sum(greatest(p_speed - speed_kph, 0)) AS DOUBLE)
                 / nullif(count(*) FILTER (WHERE brake_pressure_bar > 0), 0), 6) AS braking_efficiency
    FROM (SELECT *, lag(speed_kph) OVER w AS p_speed, lag(throttle_pct) OVER w AS p_throttle,
                 lag(brake_pressure_bar) OVER w AS p_brake, lag(event_ts) OVER w AS p_ts, lag(flag_state) OVER w AS p_flag
          FROM telemetry WINDOW w AS (PARTITION BY session_id, driver_id, lap_number ORDER BY sequence_number)) t
    GROUP BY session_id, driver_id, lap_number
""")
def lap_kpis(fx):
    return facts.lap_kpis(fx.telemetry)


@query("AGG25_acceleration", """
    WITH fast AS (SELECT session_id, driver_id, lap_number, min(event_ts) AS fast_ts FROM telemetry
                  WHERE speed_kph >= 8000 GROUP BY ALL)
    SELECT t.session_id, t.driver_id, t.lap_number,
           CAST(epoch(date_trunc('second', any_value(fast_ts))) - epoch(date_trunc('second', max(event_ts))) AS BIGINT) AS acceleration_s
    FROM telemetry t JOIN fast f ON t.session_id = f.session_id AND t.driver_id = f.driver_id AND t.lap_number = f.lap_number
    WHERE speed_kph <= 2000 AND event_ts < fast_ts GROUP BY t.session_id, t.driver_id, t.lap_number
""")
def acceleration(fx):
    return facts.acceleration_times(fx.telemetry, 2000, 8000)


STOPS = """
    SELECT concat(session_id, '_pit_', driver_id, '_', CAST(lap_number AS STRING)) AS event_id, session_id,
           (epoch_us(coalesce(pit_out, pit_in)) - epoch_us(pit_in)) // 1000 AS pit_duration_ms
    FROM laps WHERE lap_end IS NOT NULL AND pit_in IS NOT NULL
"""


@query("AGG25_pit_efficiency", f"""
    SELECT event_id, p.session_id, pit_duration_ms, median_ms, round(CAST(pit_duration_ms AS DOUBLE) / nullif(median_ms, 0), 6) AS pit_ratio
    FROM ({STOPS}) p JOIN (SELECT session_id, quantile_disc(pit_duration_ms, 0.5) AS median_ms FROM ({STOPS}) q
                           GROUP BY session_id) m ON m.session_id = p.session_id
""")
def pit_efficiency(fx):
    stops = race.pit_stops(fx.laps.withColumn("driver_name", F.lit(None).cast("string")))
    return facts.pit_efficiency(stops.select("event_id", "session_id", "pit_duration_ms"))


@query("WIN6_rolling_pace", """
    SELECT session_id, driver_id, lap_number, round(avg(lap_time_ms) OVER w, 6) AS rolling_pace_ms,
           count(lap_time_ms) OVER w AS laps_used
    FROM laps WINDOW w AS (PARTITION BY session_id, driver_id ORDER BY lap_number
                           RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)
""")
def rolling_pace(fx):
    return facts.rolling_pace(fx.laps)


@query("WIN6_tyre_degradation", f"""
    SELECT session_id, driver_id, lap_number, stint_no,
           CASE WHEN lag(stint_no) OVER w = stint_no THEN lap_time_ms - lag(lap_time_ms) OVER w END AS degradation_ms
    FROM ({STINTS}) s WINDOW w AS (PARTITION BY session_id, driver_id ORDER BY lap_number)
""")
def tyre_degradation(fx):
    return facts.tyre_degradation(facts.with_stints(fx.laps))


@query("WIN7_pace_deltas", """
    SELECT session_id, driver_id, lap_number, lap_time_ms - min(lap_time_ms) OVER (PARTITION BY session_id) AS delta_vs_best_ms,
           lap_time_ms - first(lap_time_ms) OVER (PARTITION BY session_id, lap_number
              ORDER BY position NULLS LAST, driver_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS delta_vs_leader_ms
    FROM laps
""")
def pace_deltas(fx):
    return facts.pace_deltas(fx.laps)


@query("WIN8_zscores", """
    SELECT sequence_number, session_id, driver_id, speed_kph, round(z, 4) AS zscore, coalesce(abs(z) > 3, FALSE) AS is_anomaly
    FROM (SELECT *, (speed_kph - avg(speed_kph) OVER w) / nullif(stddev_samp(speed_kph) OVER w, 0) AS z FROM telemetry
          WINDOW w AS (PARTITION BY session_id, driver_id)) t
""")
def zscores(fx):
    scored = facts.zscores(fx.telemetry, "speed_kph", ["session_id", "driver_id"], 3.0)
    return scored.withColumn("zscore", F.round("zscore", 4))


@query("JN10_events_in_laps", """
    SELECT i.event_id, i.event_type, i.event_ts, l.session_id, l.driver_id, l.lap_number, l.lap_start, l.lap_end
    FROM interactions i JOIN laps l ON l.session_id = i.session_id AND l.driver_id = i.driver_id
         AND i.event_ts BETWEEN l.lap_start AND l.lap_end
""")
def events_in_laps(fx):
    return facts.events_in_laps(fx.laps, fx.interactions)


STEP = 1800
PERIODS = "SELECT session_id, event_ts AS period_start, event_ts + INTERVAL 20 MINUTES AS period_end FROM telemetry WHERE speed_kph < 100"


def _periods(fx):
    """A safety-car period of 20 minutes after every very slow sample."""
    return fx.telemetry.filter("speed_kph < 100").select(
        "session_id",
        F.col("event_ts").alias("period_start"),
        (F.col("event_ts") + F.expr("INTERVAL 20 MINUTES")).alias("period_end"),
    )


MERGED = f"""
    SELECT session_id, min(period_start) AS period_start, max(period_end) AS period_end
    FROM (SELECT *, sum(opens) OVER (PARTITION BY session_id ORDER BY period_start, period_end
                                     ROWS UNBOUNDED PRECEDING) AS period_no
          FROM (SELECT *, CASE WHEN period_start <= max(period_end) OVER (
                              PARTITION BY session_id ORDER BY period_start, period_end
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens
                FROM (SELECT DISTINCT * FROM ({PERIODS}) p) d) o) n
    GROUP BY session_id, period_no
"""


@query("JN10_safety_car_laps", f"""
    SELECT l.session_id, l.driver_id, l.lap_number,
           sum(epoch_us(least(l.lap_end, m.period_end)) - epoch_us(greatest(l.lap_start, m.period_start))) / 1e6
               AS safety_car_seconds
    FROM laps l JOIN ({MERGED}) m ON m.session_id = l.session_id
         AND l.lap_start < m.period_end AND m.period_start < l.lap_end
    WHERE l.lap_start <= l.lap_end
    GROUP BY l.session_id, l.driver_id, l.lap_number
""")
def safety_car_laps(fx):
    return facts.laps_under_safety_car(fx.laps, _periods(fx), STEP)


@query("JN10_safety_car_periods", MERGED)
def safety_car_periods(fx):
    return facts.merge_periods(_periods(fx), STEP)


@query("DET6_overtake_tags", f"""
    SELECT o.session_id, o.attacker_id, o.defender_id, o.lap_number,
           CASE WHEN p.driver_id IS NOT NULL THEN 'undercut' WHEN s.drs THEN 'drs'
                WHEN s.brake THEN 'under_braking' ELSE 'on_track' END AS overtake_type
    FROM ({OVERTAKES}) o
    LEFT JOIN (SELECT session_id, driver_id, lap_number, bool_or(drs_state = 'ON') AS drs,
                      bool_or(brake_pressure_bar > 0) AS brake FROM telemetry GROUP BY ALL) s
      ON s.session_id = o.session_id AND s.driver_id = o.attacker_id AND s.lap_number = o.lap_number
    LEFT JOIN (SELECT DISTINCT session_id, driver_id, lap_number FROM laps WHERE lap_end IS NOT NULL AND pit_in IS NOT NULL) p
      ON p.session_id = o.session_id AND p.driver_id = o.defender_id AND p.lap_number = o.lap_number
""")
def overtake_tags(fx):
    laps = fx.stored("laps")
    stops = race.pit_stops(laps.withColumn("driver_name", F.lit(None).cast("string")))
    tagged = facts.overtake_tags(
        race.overtakes(laps).select(*OVERTAKE_COLUMNS), fx.telemetry, stops
    )
    return tagged.select("session_id", "attacker_id", "defender_id", "lap_number", "overtake_type")


def _facts(fact: str, table: str, measure: str, keys: str = "session_id, driver_id") -> str:
    return f"SELECT '{fact}' AS fact, concat_ws('/', {keys}) AS key, CAST({measure} AS DOUBLE) AS measure FROM ({table}) t"


SNK10 = {
    "fact_lap": (FACT_LAP, "fuel_used_kg", "session_id, driver_id, CAST(lap_number AS STRING)"),
    "fact_stint": (FACT_STINT, "avg_pace_ms", "stint_id"),
    "fact_driver_session": (DRIVER_SESSION.format(edges=f"({OVERTAKES}) o"), "influence_score", "session_id, driver_id"),
    "fact_overtakes": (OVERTAKES, "delta_time_ms", "event_id"),
}


@query("SNK10_fact_tables", " UNION ALL ".join(_facts(name, *rest[:2], rest[2]) for name, rest in SNK10.items()))
def fact_tables(fx):
    """Key and one measure of every row of the four tables, as read back. What several tables are
    made of is written first and read again."""
    base = scratch_path(fx.spark, "facts")
    laps = fx.stored("laps")
    write_tables({"fact_lap": facts.fact_lap(fx.telemetry, laps), "fact_overtakes": race.overtakes(laps)}, base, 0)
    read = lambda name: fx.spark.read.parquet(f"{base}/{name}")
    write_tables({
        "fact_stint": facts.fact_stint(facts.with_stints(laps), read("fact_lap")),
        "fact_driver_session": facts.fact_driver_session(read("fact_overtakes")),
    }, base, 0)
    found = None
    for name, (_, measure, keys) in SNK10.items():
        rows = read(name).selectExpr(f"'{name}' AS fact", f"concat_ws('/', {keys}) AS key", f"CAST({measure} AS DOUBLE) AS measure")
        found = rows if found is None else found.unionByName(rows)
    return found
