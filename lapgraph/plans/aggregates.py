"""Driver, session, lap and feature aggregates; running aggregates; upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapgraph.operators import profiles, sketches, upsert
from lapgraph.operators.graph import interactions_of
from lapgraph.operators.skew import skew_join
from lapgraph.plans.registry import query
from lapgraph.session import scratch_path
from lapgraph.streaming.buckets import BucketedTable

PACE = """
    max(lap_number) AS max_lap_seen, round(avg(speed_kph), 6) AS avg_speed_kph,
    CAST(max(speed_kph) AS BIGINT) AS max_speed_kph,
    round(avg(battery_pct), 6) AS avg_battery_pct, round(avg(fuel_mass_kg), 6) AS avg_fuel_mass_kg
"""
LAP_STATS = """
    SELECT session_id, driver_id, lap_number, max(event_ts) AS event_ts,
           round(avg(speed_kph), 6) AS avg_speed_kph, CAST(max(speed_kph) AS BIGINT) AS max_speed_kph,
           CAST(min(speed_kph) AS BIGINT) AS min_speed_kph, round(avg(battery_pct), 6) AS avg_battery_pct,
           round(avg(fuel_mass_kg), 6) AS avg_fuel_mass_kg,
           concat(session_id, ':', driver_id, ':', CAST(lap_number AS STRING)) AS lap_id
    FROM telemetry WHERE lap_number IS NOT NULL AND lap_number >= 0
    GROUP BY session_id, driver_id, lap_number
"""


@query("AGG1_driver_profile", f"""
    SELECT driver_id, arg_min(driver_name, sequence_number) FILTER (WHERE driver_name IS NOT NULL) AS driver_name,
           arg_min(session_id, sequence_number) AS first_session_id,
           arg_max(session_id, sequence_number) AS latest_session_id, {PACE}
    FROM telemetry GROUP BY driver_id
""")
def driver_profile(fx):
    return profiles.driver_profile(fx.telemetry)


@query("AGG2_driver_graph_profile", f"""
    SELECT driver_id, min(driver_name) AS driver_name, min(session_id) AS first_session_id,
           max(session_id) AS latest_session_id, {PACE}
    FROM telemetry WHERE driver_id IS NOT NULL AND driver_name IS NOT NULL GROUP BY driver_id
""")
def driver_graph_profile(fx):
    return profiles.driver_graph_profile(fx.telemetry)


@query("AGG2_driver_stats", f"""
    SELECT driver_id, min(session_id) AS first_session_id, max(session_id) AS latest_session_id, {PACE}
    FROM telemetry GROUP BY driver_id
""")
def driver_stats(fx):
    return profiles.driver_stats(fx.telemetry)


SESSION = """
    SELECT session_id, count(DISTINCT driver_id) AS driver_count, count(DISTINCT lap_number) AS lap_count,
           min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts
    FROM telemetry WHERE session_id IS NOT NULL GROUP BY session_id
"""


@query("AGG3_session_sketch", f"SELECT *, TRUE AS within_bound FROM ({SESSION}) s")
def session_sketch(fx):
    exact = profiles.session_summary(fx.telemetry, approximate=False)
    sketch = profiles.session_summary(fx.telemetry).select(
        "session_id", F.col("driver_count").alias("_d"), F.col("lap_count").alias("_l")
    )
    bound = 3 * profiles.RSD
    good = sketches.within(F.col("_d"), F.col("driver_count"), bound) & sketches.within(
        F.col("_l"), F.col("lap_count"), bound
    )
    return exact.join(sketch, "session_id").withColumn("within_bound", good).drop("_d", "_l")


@query("AGG4_session_exact", SESSION)
def session_exact(fx):
    return profiles.session_summary(fx.telemetry, approximate=False)


@query("AGG5_lap_stats", LAP_STATS)
def lap_stats(fx):
    return profiles.lap_stats(fx.telemetry)


@query("AGG6_driver_session_span", """
    SELECT session_id, driver_id, min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts,
           min(lap_number) AS first_lap, max(lap_number) AS last_lap,
           concat(session_id, ':', driver_id) AS edge_id
    FROM dirty WHERE session_id IS NOT NULL AND driver_id IS NOT NULL GROUP BY session_id, driver_id
""")
def driver_session_span(fx):
    return profiles.driver_session_span(fx.dirty)


@query("AGG7_driver_identity", """
    SELECT driver_id, min(driver_name) AS driver_name, min(session_id) AS first_session_id,
           max(session_id) AS latest_session_id
    FROM interactions WHERE driver_id IS NOT NULL AND driver_name IS NOT NULL GROUP BY driver_id
""")
def driver_identity(fx):
    return profiles.driver_identity(fx.interactions)


@query("AGG8_session_span", """
    SELECT session_id, min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts
    FROM interactions WHERE session_id IS NOT NULL GROUP BY session_id
""")
def session_span(fx):
    return profiles.session_span(fx.interactions)


@query("AGG9_driver_features", """
    SELECT driver_id, session_id, round(avg(speed_kph), 6) AS avg_speed, round(avg(throttle_pct), 6) AS avg_throttle,
           round(avg(brake_pressure_bar), 6) AS avg_brake, max(engine_rpm) AS max_rpm
    FROM telemetry GROUP BY driver_id, session_id HAVING avg(throttle_pct) IS NOT NULL
""")
def driver_features(fx):
    return profiles.driver_features(fx.telemetry).drop("features")


RUNNING = """
    SELECT session_id, driver_id, lap_number, count(*) AS samples, CAST(sum(speed_kph) AS BIGINT) AS sum_speed_kph,
           CAST(min(speed_kph) AS BIGINT) AS min_speed_kph, CAST(max(speed_kph) AS BIGINT) AS max_speed_kph,
           round(avg(speed_kph), 6) AS avg_speed_kph, round(avg(fuel_mass_kg), 6) AS avg_fuel_mass_kg,
           min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts
"""
KEPT = [
    "samples", "sum_speed_kph", "min_speed_kph", "max_speed_kph", "avg_speed_kph",
    "avg_fuel_mass_kg", "first_event_ts", "last_event_ts",
]


def _batches(fx):
    """Two batches by time of day: morning and afternoon samples of every lap."""
    morning = F.col("micro_sector_id") < 12
    return fx.telemetry.filter(morning), fx.telemetry.filter(~morning)


def _partials(fx):
    first, second = _batches(fx)
    return upsert.lap_partials(first).withColumn("batch", F.lit(0)).unionByName(
        upsert.lap_partials(second).withColumn("batch", F.lit(1))
    )


@query("AGG14_running_laps", RUNNING + "FROM telemetry GROUP BY session_id, driver_id, lap_number")
def running_laps(fx):
    merged = upsert.finish_partials(upsert.merge_partials(_partials(fx)))
    return merged.select("session_id", "driver_id", "lap_number", *KEPT)


@query("AGG14_running_sessions", """
    SELECT session_id, count(*) AS samples, CAST(sum(speed_kph) AS BIGINT) AS sum_speed_kph,
           round(avg(battery_pct), 6) AS avg_battery_pct, max(event_ts) AS last_event_ts,
           count(DISTINCT sequence_number) AS distinct_samples, TRUE AS within_bound
    FROM telemetry GROUP BY session_id
""")
def running_sessions(fx):
    merged = upsert.finish_partials(upsert.merge_partials(_partials(fx), ["session_id"]))
    exact = fx.telemetry.groupBy("session_id").agg(
        F.count_distinct("sequence_number").alias("distinct_samples")
    )
    good = sketches.within(
        F.col("approx_distinct"), F.col("distinct_samples"), 3 * sketches.hll_error(12), 2.0
    )
    return merged.join(exact, "session_id").select(
        "session_id", "samples", "sum_speed_kph", "avg_battery_pct", "last_event_ts",
        "distinct_samples", good.alias("within_bound"),
    )


@query("AGG14_last_batch_laps", RUNNING + """
    FROM (SELECT *, max(CASE WHEN micro_sector_id < 12 THEN 0 ELSE 1 END)
                      OVER (PARTITION BY session_id, driver_id, lap_number) AS newest FROM telemetry) t
    WHERE newest = CASE WHEN micro_sector_id < 12 THEN 0 ELSE 1 END
    GROUP BY session_id, driver_id, lap_number
""")
def last_batch_laps(fx):
    newest = upsert.last_batch(_partials(fx), upsert.LAP)
    return upsert.finish_partials(upsert.merge_partials(newest)).select(*upsert.LAP, *KEPT)


# Old nodes know the laps up to 18 and driver 5, the batch those from 12 on and driver 3.
OLD_NODES = """
    SELECT session_id, driver_id, max(lap_number) AS max_lap, CAST(max(speed_kph) AS BIGINT) AS top_speed,
           min(micro_sector_id) AS old_only
    FROM telemetry WHERE lap_number <= 18 AND driver_no <> 3 OR driver_no = 5 GROUP BY session_id, driver_id
"""
NEW_NODES = """
    SELECT session_id, driver_id, max(lap_number) AS max_lap,
           CASE WHEN driver_no % 4 = 0 THEN NULL ELSE CAST(max(speed_kph) AS BIGINT) END AS top_speed
    FROM telemetry WHERE lap_number >= 12 AND driver_no <> 5 OR driver_no = 3 GROUP BY session_id, driver_id, driver_no
"""


def _nodes(fx):
    old = (
        fx.telemetry.filter("lap_number <= 18 AND driver_no <> 3 OR driver_no = 5")
        .groupBy("session_id", "driver_id")
        .agg(
            F.max("lap_number").alias("max_lap"),
            F.max("speed_kph").alias("top_speed"),
            F.min("micro_sector_id").alias("old_only"),
        )
    )
    new = (
        fx.telemetry.filter("lap_number >= 12 AND driver_no <> 5 OR driver_no = 3")
        .groupBy("session_id", "driver_id", "driver_no")
        .agg(
            F.max("lap_number").alias("max_lap"),
            F.when(F.col("driver_no") % 4 != 0, F.max("speed_kph")).alias("top_speed"),
        )
        .drop("driver_no")
    )
    return old, new


def _upsert_check(mode: str) -> str:
    join = "LEFT" if mode == "update" else "FULL"
    pick = {
        "keep": "coalesce(n.{c}, o.{c})",
    }.get(mode, "CASE WHEN n.driver_id IS NOT NULL THEN n.{c} ELSE o.{c} END")
    return f"""
        SELECT coalesce(o.session_id, n.session_id) AS session_id, coalesce(o.driver_id, n.driver_id) AS driver_id,
               {pick.format(c="max_lap")} AS max_lap, {pick.format(c="top_speed")} AS top_speed, o.old_only
        FROM ({OLD_NODES}) o {join} JOIN ({NEW_NODES}) n
          ON o.session_id = n.session_id AND o.driver_id = n.driver_id
    """


def _register_upsert(key: str, mode: str) -> None:
    @query(key, _upsert_check(mode))
    def upsert_nodes(fx, mode=mode):
        """Written as a version by each batch, the second one twice, and read back."""
        old, new = _nodes(fx)
        table = BucketedTable(fx.spark, scratch_path(fx.spark, f"nodes-{mode}"), ["session_id", "driver_id"])
        table.write(old, 0)
        for _ in range(2):
            table.upsert(new, mode, 1)
        return table.read()


_register_upsert("SNK3_upsert_set", "set")
_register_upsert("SNK4_upsert_merge", "merge")
_register_upsert("SNK5_upsert_keep_nulls", "keep")
_register_upsert("SNK6_update_only", "update")


@query("SNK7_edge_upsert", """
    WITH known AS (SELECT DISTINCT driver_id AS id FROM telemetry WHERE driver_no <> 7),
    latest AS (
        SELECT rel, attacker_id AS src, defender_id AS dst, arg_max(event_id, event_ts) AS event_id,
               max(event_ts) AS event_ts
        FROM edges GROUP BY rel, attacker_id, defender_id)
    SELECT rel, src, dst, event_id, event_ts FROM latest
    WHERE src IN (SELECT id FROM known) AND dst IN (SELECT id FROM known)
""")
def edge_upsert(fx):
    columns = ["rel", "src", "dst", "event_id", "event_ts"]
    events = interactions_of(fx.interactions, "overtake", "battle").select(
        "rel", F.col("attacker_id").alias("src"), F.col("defender_id").alias("dst"),
        "event_id", "event_ts", "lap_number",
    )
    nodes = fx.drivers.filter("driver_no <> 7").select(F.col("driver_id").alias("id"))
    half = F.dayofmonth("event_ts") <= 15
    table = BucketedTable(fx.spark, scratch_path(fx.spark, "edges"), ["rel", "src", "dst"])
    for batch_id, part in ((0, half), (1, ~half), (1, ~half)):
        table.upsert_edges(events.filter(part).select(*columns), nodes, ["event_ts"], batch_id)
    return table.read()


@query("JN7_endpoints_exist", """
    SELECT rel, attacker_id AS src, defender_id AS dst, count(*) AS edges FROM edges e
    WHERE attacker_id IN (SELECT driver_id FROM telemetry WHERE driver_no <> 7)
      AND defender_id IN (SELECT driver_id FROM telemetry WHERE driver_no <> 7)
    GROUP BY ALL
""")
def endpoints_exist(fx):
    events = interactions_of(fx.interactions, "overtake", "battle")
    nodes = fx.drivers.filter("driver_no <> 7").select("driver_id")
    kept = skew_join(events, nodes.withColumnRenamed("driver_id", "attacker_id"), ["attacker_id"], "left_semi")
    kept = skew_join(kept, nodes.withColumnRenamed("driver_id", "defender_id"), ["defender_id"], "left_semi")
    table = kept.groupBy("rel", "attacker_id", "defender_id").agg(F.count("*").alias("edges"))
    return table.withColumnsRenamed({"attacker_id": "src", "defender_id": "dst"})
