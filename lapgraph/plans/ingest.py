"""Sources, parsing, filters, and static writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapgraph.functions import scalars
from lapgraph.operators import parsing, quality, selection
from lapgraph.operators.facts import enrich_with_dimensions
from lapgraph.operators.interactions import with_driver_names
from lapgraph.plans.registry import query
from lapgraph.schemas import RACE_EVENT, TELEMETRY
from lapgraph.session import get_spark, scratch_path
from lapgraph.sources import sinks, tables


@query("SRC3_static_read", "SELECT team_id, name, engine_supplier FROM teams")
def static_read(fx):
    path = scratch_path(fx.spark, "teams")
    fx.teams.write.parquet(path)
    return tables.read_table(fx.spark, path)


@query("SRC4_table_probe", """
    SELECT 'telemetry' AS table_name, CASE WHEN count(*) > 0 THEN 'ready' ELSE 'empty' END AS state FROM events
    UNION ALL SELECT 'race_events', 'missing'
    UNION ALL SELECT 'no_orders', CASE WHEN count(*) > 0 THEN 'ready' ELSE 'empty' END FROM orders WHERE o_orderkey < 0
""")
def table_probe(fx):
    empty = scratch_path(fx.spark, "no-orders")
    fx.orders.filter("o_orderkey < 0").write.parquet(empty)
    states = tables.require_tables(
        fx.spark,
        {"telemetry": f"{fx.sf_dir}/events.parquet", "no_orders": empty},
        {"race_events": f"{fx.sf_dir}/no_such_table.parquet"},
    )
    return fx.spark.createDataFrame(list(states.items()), "table_name string, state string")


@query("SRC5_session", "SELECT count(*) AS events, 'true' AS adaptive, 'UTC' AS time_zone FROM events")
def session(fx):
    """The session that the factory returns, with its settings; the running one is reused."""
    spark = get_spark("lapgraph", log_level="ERROR")
    conf = spark.conf
    return spark.read.parquet(f"{fx.sf_dir}/events.parquet").agg(F.count("*").alias("events")).select(
        "events",
        F.lit(conf.get("spark.sql.adaptive.enabled")).alias("adaptive"),
        F.lit(conf.get("spark.sql.session.timeZone")).alias("time_zone"),
    )


@query("SRC6_history_and_live", """
    SELECT session_id, driver_id, lap_number, CAST(sum(speed_kph) AS BIGINT) AS total_speed,
           count(*) AS samples
    FROM telemetry GROUP BY ALL
""")
def history_and_live(fx):
    old, new = fx.telemetry.filter("lap_number <= 15"), fx.telemetry.filter("lap_number > 15")
    return tables.history_and_live(
        lambda df: df.groupBy("session_id", "driver_id", "lap_number").agg(
            F.sum("speed_kph").alias("total_speed"), F.count("*").alias("samples")
        ),
        old,
        new,
    )


@query("PRJ1_raw_records", """
    SELECT log_key AS kafka_key, log_value AS kafka_value, topic, partition_id AS partition,
           offset_id AS "offset", log_ts AS kafka_timestamp, TRUE AS stamped
    FROM log
""")
def raw_records(fx):
    raw = parsing.raw_records(fx.kafka_log())
    return raw.withColumn("stamped", F.col("ingested_at").isNotNull()).drop("ingested_at")


def _parsed(fx, topic, schema):
    raw = parsing.raw_records(fx.kafka_log().filter(F.col("topic") == topic))
    return parsing.parsed_records(raw, schema, topic)


@query("PRJ2_parsed_telemetry", """
    SELECT CASE WHEN k % 7 <> 0 THEN session_id END AS session_id,
           CASE WHEN k % 7 <> 0 THEN driver_id END AS driver_id,
           CASE WHEN k % 7 <> 0 THEN lap_number END AS lap_number,
           CASE WHEN k % 7 <> 0 THEN k END AS gear,
           CASE WHEN k % 7 <> 0 THEN sequence_number END AS sequence_number,
           partition_id AS partition, offset_id AS "offset", topic AS bronze_topic
    FROM log WHERE topic = 'telemetry.raw'
""")
def parsed_telemetry(fx):
    return _parsed(fx, "telemetry.raw", TELEMETRY).select(
        "session_id", "driver_id", "lap_number", "gear", "sequence_number", "partition", "offset",
        "bronze_topic",
    )


@query("PRJ2_parsed_events", """
    SELECT CASE WHEN k % 7 <> 0 THEN session_id END AS session_id,
           CASE WHEN k % 7 <> 0 THEN CAST(sequence_number AS STRING) END AS event_id,
           CASE WHEN k % 7 <> 0 THEN 'LAP_COMPLETION' END AS event_type,
           CASE WHEN k % 7 <> 0 THEN lap_number END AS lap_number,
           CAST(NULL AS STRING) AS payload, "offset_id" AS "offset"
    FROM log WHERE topic = 'race.events'
""")
def parsed_events(fx):
    return _parsed(fx, "race.events", RACE_EVENT).select(
        "session_id", "event_id", "event_type", "lap_number", "payload", "offset"
    )


INTERACTION_CASES = """
    SELECT i.event_id,
           CASE WHEN k % 17 = 0 OR k % 10 = 0 OR k % 7 = 0 THEN 'none' WHEN k % 3 = 0 THEN 'ab'
                WHEN k % 4 = 0 THEN 'def' ELSE 'full' END AS form,
           i.k, i.driver_id, i.lap_number, i.speed_kph, t.raw_driver
    FROM interactions i JOIN (SELECT sequence_number, driver_id AS raw_driver FROM telemetry) t
      ON t.sequence_number = i.event_id
"""


@query("PRJ3_guarded_payload", f"""
    SELECT event_id, CASE WHEN form = 'full' THEN raw_driver END AS attacker_id,
           CASE WHEN form IN ('def', 'full') THEN concat('D', lpad(CAST(k % 20 AS STRING), 2, '0')) END AS defender_id,
           CASE WHEN form = 'ab' THEN raw_driver END AS driver_a_id,
           CASE WHEN form = 'ab' THEN k % 5 END AS lap_count,
           CASE WHEN form = 'full' THEN lap_number + 1 END AS lap_number
    FROM ({INTERACTION_CASES}) c
""")
def guarded_payload(fx):
    return fx.interactions.select("event_id", parsing.interaction_payload().alias("p")).select(
        "event_id", "p.attacker_id", "p.defender_id", "p.driver_a_id", "p.lap_count", "p.lap_number"
    )


@query("PRJ4_field_fallback", f"""
    SELECT event_id, CASE WHEN form IN ('ab', 'full') THEN raw_driver ELSE driver_id END AS attacker_id,
           CASE WHEN form <> 'none' THEN concat('D', lpad(CAST(k % 20 AS STRING), 2, '0')) END AS defender_id,
           CASE WHEN form = 'full' THEN lap_number + 1 ELSE lap_number END AS lap_number,
           CASE WHEN form = 'def' THEN round(CAST(speed_kph AS DOUBLE), 6) END AS avg_gap_ms
    FROM ({INTERACTION_CASES}) c
""")
def field_fallback(fx):
    return parsing.resolve_interaction(fx.interactions).select(
        "event_id", "attacker_id", "defender_id", "lap_number", "avg_gap_ms"
    )


@query("PRJ5_parse_time", """
    SELECT sequence_number, CASE WHEN k % 13 = 0 THEN NULL ELSE event_ts END AS event_ts FROM telemetry
""")
def parse_time(fx):
    text = F.when(F.col("k") % 13 == 0, F.lit("not a time")).otherwise(F.col("event_ts").cast("string"))
    return fx.telemetry.select("sequence_number", scalars.parse_ts(text).alias("event_ts"))


@query("PRJ6_graph_names", """
    SELECT driver_id AS "driverId", max(lap_number) AS "maxLapSeen",
           CAST(max(speed_kph) AS BIGINT) AS "maxSpeedKph"
    FROM telemetry GROUP BY driver_id
""")
def graph_names(fx):
    return parsing.camel_case(
        fx.telemetry.groupBy("driver_id").agg(
            F.max("lap_number").alias("max_lap_seen"), F.max("speed_kph").alias("max_speed_kph")
        )
    )


@query("PRJ7_composite_key", """
    SELECT sequence_number, concat_ws(':', session_id, driver_id, CAST(lap_number AS STRING)) AS lap_id,
           session_id IS NOT NULL AND driver_id IS NOT NULL AND lap_number IS NOT NULL AS is_complete
    FROM dirty
""")
def composite_key(fx):
    parts = ["session_id", "driver_id", "lap_number"]
    return fx.dirty.select(
        "sequence_number",
        scalars.composite_key(*parts).alias("lap_id"),
        scalars.has_all(*parts).alias("is_complete"),
    )


@query("PRJ8_session_key", """
    SELECT o_orderkey, concat(CAST(year(o_orderdate) AS STRING), '_', replace(o_orderpriority, ' ', '_'), '_',
           replace(concat('Race ', o_orderstatus), ' ', '_')) AS session_id
    FROM orders
""")
def session_key(fx):
    return fx.orders.select(
        "o_orderkey",
        scalars.session_key(
            F.year("o_orderdate"), F.col("o_orderpriority"), F.concat(F.lit("Race "), "o_orderstatus")
        ).alias("session_id"),
    )


@query("PRJ9_session_start", """
    SELECT sequence_number,
           CASE WHEN k % 3 = 0 THEN event_ts WHEN k % 3 = 1 THEN event_ts + INTERVAL 1 HOUR
                WHEN k % 5 = 0 THEN NULL ELSE date_trunc('day', event_ts) END AS session_start
    FROM telemetry
""")
def session_start(fx):
    k = F.col("k")
    recorded = F.when(k % 3 == 0, F.col("event_ts").cast("string")).otherwise("0 days 01:02:03")
    scheduled = F.when(k % 3 == 1, F.col("event_ts") + F.expr("INTERVAL 1 HOUR"))
    day = F.when((k % 3 != 2) | (k % 5 != 0), F.date_trunc("day", "event_ts"))
    return fx.telemetry.select(
        "sequence_number", scalars.session_start(recorded, scheduled, day).alias("session_start")
    )


@query("PRJ10_event_time", """
    SELECT sequence_number, date_trunc('day', event_ts) + INTERVAL 1 SECOND * CAST(speed_kph AS INT) AS event_time
    FROM telemetry
""")
def event_time(fx):
    start = F.date_trunc("day", "event_ts")
    return fx.telemetry.select(
        "sequence_number",
        scalars.event_time(start, (F.col("speed_kph") * 1000).cast("int")).alias("event_time"),
    )


@query("PRJ11_content_hash", """
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, row_hash FROM dup_rows
""")
def content_hash(fx):
    return fx.lineitem.select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey",
        scalars.content_hash(F.col("l_orderkey"), F.col("l_linenumber")).alias("row_hash"),
    )


@query("PRJ12_correlation_id", """
    SELECT sequence_number, concat(session_id, '_', driver_id, '_', CAST(lap_number AS STRING)) AS correlation_id
    FROM telemetry
""")
def correlation_id(fx):
    return fx.telemetry.select(
        "sequence_number", scalars.correlation_id("session_id", "driver_id", "lap_number").alias("correlation_id")
    )


@query("PRJ13_sampling_weight", """
    SELECT sequence_number, round(1.0::DOUBLE / (sequence_number + 1), 6) AS sampling_weight FROM telemetry
""")
def sampling_weight(fx):
    return fx.telemetry.select(
        "sequence_number", scalars.sampling_weight(F.col("sequence_number")).alias("sampling_weight")
    )


@query("PRJ17_display_name", """
    SELECT sequence_number, driver_id,
           CASE WHEN driver_no % 3 <> 0 THEN concat('X', driver_id)
                WHEN driver_no % 5 <> 0 THEN concat('Driver ', driver_id) ELSE driver_id END AS driver_name
    FROM telemetry
""")
def display_name(fx):
    named = with_driver_names(fx.telemetry, fx.drivers)
    return named.select("sequence_number", "driver_id", "driver_name")


@query("PRJ18_units", """
    SELECT sequence_number, round(speed_kph * 3.6::DOUBLE, 6) AS speed_kph,
           round(k * 0.0689476::DOUBLE, 6) AS pressure_bar, round(engine_rpm - 273.15::DOUBLE, 6) AS temp_c
    FROM telemetry
""")
def units(fx):
    return fx.telemetry.select(
        "sequence_number",
        scalars.ms_to_kph(F.col("speed_kph")).alias("speed_kph"),
        scalars.psi_to_bar(F.col("k")).alias("pressure_bar"),
        scalars.kelvin_to_celsius(F.col("engine_rpm")).alias("temp_c"),
    )


@query("FN1_offset_total", """
    SELECT session_id, lap_number,
           CASE WHEN lap_number % 5 = 0 THEN 0 ELSE CAST(sum(CASE WHEN topic = 'telemetry.raw' THEN offset_id ELSE 0 END) AS BIGINT) END AS consumed
    FROM (SELECT session_id, lap_number, topic, partition_id, max(offset_id) AS offset_id
          FROM log GROUP BY ALL) c
    GROUP BY session_id, lap_number
""")
def offset_total(fx):
    last = fx.log.groupBy("session_id", "lap_number", "topic", "partition_id").agg(F.max("offset_id").alias("o"))
    by_topic = last.groupBy("session_id", "lap_number", "topic").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("partition_id").cast("string"), "o"))).alias("m")
    )
    texts = by_topic.groupBy("session_id", "lap_number").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("topic", "m")))).alias("offsets")
    )
    text = F.when(F.col("lap_number") % 5 == 0, "{broken").otherwise(F.col("offsets"))
    return texts.select(
        "session_id", "lap_number", scalars.offset_total(text, "telemetry.raw").alias("consumed")
    )


@query("FLT1_required_ids", """
    SELECT sequence_number, session_id, driver_id FROM dirty
    WHERE session_id IS NOT NULL AND driver_id IS NOT NULL
""")
def required_ids(fx):
    return selection.with_ids(fx.dirty).select("sequence_number", "session_id", "driver_id")


@query("FLT2_valid_laps", "SELECT sequence_number, lap_number FROM dirty WHERE lap_number >= 0")
def valid_laps(fx):
    return selection.valid_laps(fx.dirty).select("sequence_number", "lap_number")


@query("FLT3_event_type", "SELECT event_id, event_type FROM interactions WHERE lower(event_type) = 'battle'")
def event_type(fx):
    return selection.of_type(fx.interactions, "BATTLE").select("event_id", "event_type")


@query("FLT4_endpoints", "SELECT event_id, attacker_id, defender_id FROM edges WHERE rel = 'OVERTAKE'")
def endpoints(fx):
    resolved = parsing.resolve_interaction(selection.of_type(fx.interactions, "overtake"))
    return selection.with_endpoints(resolved).select("event_id", "attacker_id", "defender_id")


@query("FLT5_complete_features", """
    SELECT sequence_number, throttle_pct FROM telemetry
    WHERE throttle_pct IS NOT NULL AND speed_kph IS NOT NULL AND driver_name IS NOT NULL
""")
def complete_features(fx):
    return selection.complete_rows(
        fx.telemetry, ["throttle_pct", "speed_kph", "driver_name"]
    ).select("sequence_number", "throttle_pct")


@query("FLT6_named_drivers", """
    SELECT event_id, driver_id, driver_name FROM interactions
    WHERE driver_id IS NOT NULL AND driver_name IS NOT NULL
""")
def named_drivers(fx):
    return selection.named_drivers(fx.interactions).select("event_id", "driver_id", "driver_name")


@query("FLT7_session_selection", """
    SELECT o_orderkey, year(o_orderdate) AS year, o_orderpriority AS event_name, o_orderstatus AS session_name
    FROM orders WHERE year(o_orderdate) BETWEEN 1993 AND 1996 AND lower(o_orderpriority) LIKE '%high%'
      AND o_orderstatus IN ('F', 'O')
""")
def session_selection(fx):
    sessions = fx.orders.select(
        "o_orderkey", F.year("o_orderdate").cast("bigint").alias("year"),
        F.col("o_orderpriority").alias("event_name"), F.col("o_orderstatus").alias("session_name"),
    )
    return selection.select_sessions(sessions, (1993, 1996), "HIGH", ["F", "O"])


@query("FLT7_driver_selection", "SELECT sequence_number, driver_id FROM telemetry WHERE driver_id = 'D07'")
def driver_selection(fx):
    return selection.only_driver(fx.telemetry, "D07").select("sequence_number", "driver_id")


@query("FLT8_systematic_sample", "SELECT sequence_number, speed_kph FROM telemetry WHERE sequence_number % 10 = 0")
def systematic_sample(fx):
    return selection.every_nth(fx.telemetry, 10).select("sequence_number", "speed_kph")


@query("FLT9_limit_per_session", """
    SELECT session_id, sequence_number FROM
      (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY sequence_number) AS rn FROM telemetry) t
    WHERE rn <= 500
""")
def limit_per_session(fx):
    return selection.first_per_group(
        fx.telemetry.select("session_id", "sequence_number"), 500, ["session_id"], ["sequence_number"]
    )


RULES = (400.0 * 100, 90.0, 180.0)


@query("FLT10_validity", """
    SELECT sequence_number, speed_kph FROM dirty
    WHERE session_id IS NOT NULL AND speed_kph >= 0 AND speed_kph <= 40000 AND gps_lat <= 90 AND gps_lon <= 180
""")
def validity(fx):
    return selection.apply_rules(fx.dirty, selection.telemetry_rules(*RULES)).select(
        "sequence_number", "speed_kph"
    )


@query("FLT10_reject_counts", """
    SELECT 'null_session' AS rule, count(*) AS rejected FROM dirty WHERE session_id IS NULL
    UNION ALL SELECT 'negative_speed', count(*) FROM dirty WHERE speed_kph < 0
    UNION ALL SELECT 'impossible_speed', count(*) FROM dirty WHERE speed_kph > 40000
    UNION ALL SELECT 'impossible_gps', count(*) FROM dirty WHERE abs(gps_lat) > 90 OR abs(gps_lon) > 180
""")
def reject_counts(fx):
    return selection.reject_counts(fx.dirty, selection.telemetry_rules(*RULES))


@query("SNK9_partition_by_date", """
    SELECT CAST(log_ts AS DATE) AS date, topic, count(*) AS records, CAST(sum(offset_id) AS BIGINT) AS offsets
    FROM log GROUP BY ALL
""")
def partition_by_date(fx):
    path = scratch_path(fx.spark, "by-date")
    sinks.write_by_date(parsing.raw_records(fx.kafka_log(), F.col("timestamp")), path)
    return fx.spark.read.parquet(path).groupBy("date", "topic").agg(
        F.count("*").alias("records"), F.sum("offset").alias("offsets")
    )


REQUIRED = {
    "telemetry.raw": (TELEMETRY, ["session_id", "driver_id", "timestamp_utc"]),
    "race.events": (RACE_EVENT, ["session_id", "event_id", "event_ts_utc", "event_type"]),
}


@query("SNK11_quarantine", """
    SELECT offset_id AS "offset", topic, log_value AS kafka_value, 'missing required field' AS reason, FALSE AS is_good FROM log
    WHERE k % 7 = 0
    UNION ALL
    SELECT offset_id, topic, log_value, NULL, TRUE FROM log WHERE k % 7 <> 0
""")
def quarantine(fx):
    """Both topics; the good table of each has its own columns."""
    found = None
    for topic, (schema, required) in REQUIRED.items():
        raw = parsing.raw_records(fx.kafka_log().filter(F.col("topic") == topic))
        good_path, bad_path = scratch_path(fx.spark, "good"), scratch_path(fx.spark, "bad")
        sinks.write_with_quarantine(raw, schema, required, good_path, bad_path, 0)
        good = fx.spark.read.parquet(good_path).select(
            "offset", "topic", "kafka_value", F.lit(None).cast("string").alias("reason"), F.lit(True).alias("is_good")
        )
        bad = fx.spark.read.parquet(bad_path).select(
            "offset", "topic", "kafka_value", "reason", F.lit(False).alias("is_good")
        )
        both = good.unionByName(bad)
        found = both if found is None else found.unionByName(both)
    return found


@query("JN12_unparsed_offsets", """
    SELECT topic, partition_id AS partition, offset_id AS "offset" FROM log WHERE k % 7 = 0
""")
def unparsed_offsets(fx):
    raw = parsing.raw_records(fx.kafka_log())
    parsed = None
    for topic, (schema, _) in REQUIRED.items():
        own = parsing.parsed_records(raw.filter(F.col("topic") == topic), schema, topic)
        own = own.filter("session_id IS NOT NULL").select(*quality.POSITION)
        parsed = own if parsed is None else parsed.unionByName(own)
    return quality.unparsed_offsets(raw, parsed).select("topic", "partition", "offset")


@query("AGG15_message_counts", """
    SELECT topic, partition_id AS partition, CAST(grouping_id(topic, partition_id) AS BIGINT) AS level,
           count(*) AS messages, max(offset_id) - min(offset_id) + 1 AS offset_span
    FROM log GROUP BY ROLLUP (topic, partition_id)
""")
def message_counts(fx):
    return quality.message_counts(fx.kafka_log())


NULL_RATES = """
    SELECT 'session_id' AS column_name, count(*) FILTER (WHERE session_id IS NULL) AS null_count,
           round(count(*) FILTER (WHERE session_id IS NULL) / count(*), 6) AS null_rate FROM dirty
    UNION ALL SELECT 'driver_id', count(*) FILTER (WHERE driver_id IS NULL),
           round(count(*) FILTER (WHERE driver_id IS NULL) / count(*), 6) FROM dirty
    UNION ALL SELECT 'lap_number', count(*) FILTER (WHERE lap_number IS NULL),
           round(count(*) FILTER (WHERE lap_number IS NULL) / count(*), 6) FROM dirty
    UNION ALL SELECT 'speed_kph', count(*) FILTER (WHERE speed_kph IS NULL),
           round(count(*) FILTER (WHERE speed_kph IS NULL) / count(*), 6) FROM dirty
"""


@query("AGG22_null_rates", NULL_RATES)
def null_rates(fx):
    return quality.null_rates(fx.dirty, ["session_id", "driver_id", "lap_number", "speed_kph"])


LATE = """
    SELECT topic, offset_id, event_ts < max(event_ts) OVER
             (PARTITION BY topic, partition_id ORDER BY arrival, offset_id) - INTERVAL 1 HOUR AS is_late
    FROM (SELECT *, log_ts AS event_ts, offset_id + k * 3 AS arrival FROM log) l
"""


def _late(fx):
    arrived = fx.log.withColumns({"event_ts": F.col("log_ts"), "arrival": F.col("offset_id") + F.col("k") * 3})
    return quality.late_arrivals(
        arrived, ["topic", "partition_id"], "arrival", 3600, 1000, ["offset_id"]
    )


@query("STR9_late_arrivals", LATE)
def late_arrivals(fx):
    return _late(fx).select("topic", "offset_id", "is_late")


@query("AGG22_late_rate", f"""
    SELECT topic, count(*) AS rows, count(*) FILTER (WHERE is_late) AS late_rows,
           round(count(*) FILTER (WHERE is_late) / count(*), 6) AS late_rate
    FROM ({LATE}) l GROUP BY topic
""")
def late_rate(fx):
    return quality.late_rate(_late(fx), ["topic"])


@query("STR12_reconciliation", """
    SELECT topic, count(*) AS available, count(*) FILTER (WHERE k % 5 <> 0) AS consumed,
           count(*) FILTER (WHERE k % 5 <> 0 AND k % 7 <> 0) AS written,
           count(*) FILTER (WHERE k % 5 <> 0) >= count(*) - 10000
               AND count(*) FILTER (WHERE k % 5 <> 0 AND k % 7 <> 0) < 4000 AS data_loss,
           count(*) FILTER (WHERE k % 5 <> 0 AND k % 7 = 0) AS unwritten
    FROM log GROUP BY topic
""")
def reconciliation(fx):
    """A fifth of the log is not consumed yet, and malformed records are not written."""
    available = parsing.raw_records(fx.kafka_log())
    waiting = fx.log.filter("k % 5 = 0").select("topic", F.col("offset_id").alias("offset"))
    consumed = available.join(waiting, ["topic", "offset"], "left_anti").select(*available.columns)
    written = parsing.parsed_records(consumed, TELEMETRY, F.col("topic"))
    return quality.reconcile(
        available, consumed, written.filter("session_id IS NOT NULL"), backlog=10_000, min_written=4_000
    )


@query("JN9_dimensions", """
    SELECT sequence_number, t.driver_id, d.driver_name, d.team_id, m.name AS team_name, m.engine_supplier
    FROM telemetry t LEFT JOIN drivers d ON t.driver_id = d.driver_id
    LEFT JOIN teams m ON d.team_id = m.team_id
""")
def dimensions(fx):
    samples = fx.telemetry.select("sequence_number", "driver_id")
    return enrich_with_dimensions(samples, fx.drivers, fx.teams)
