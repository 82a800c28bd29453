"""Streaming runs over files written from the given tables, read back as tables.

Each run gets its own fresh folder below the shared one and ends by itself
(``availableNow``); the check texts compute the same result in one batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapgraph.operators.interactions import adjacent_pairs
from lapgraph.operators.parsing import parsed_records, raw_records
from lapgraph.operators.upsert import lap_partials, merge_partials
from lapgraph.plans.aggregates import RUNNING
from lapgraph.plans.detection import BATTLES
from lapgraph.plans.facts import STINTS

from lapgraph.plans.graphs import COMMUNITY_SQL, SESSION_GRAPH, WIDTHS, pagerank_sql
from lapgraph.plans.ingest import NULL_RATES
from lapgraph.plans.registry import query
from lapgraph.schemas import RACE_EVENT, TELEMETRY
from lapgraph.session import scratch_path
from lapgraph.sources.sinks import append_stream, start_bronze, table_name
from lapgraph.sources.tables import stream_table
from lapgraph.streaming import monitor, stateful
from lapgraph.streaming.buckets import BucketedTable
from lapgraph.streaming.gold import GoldTables, await_all, start_gold
from lapgraph.streaming.monitor import follow_progress, progress_summary
from lapgraph.streaming.runs import RunTable, battle_laps, rocksdb_state, stint_laps


class Run:
    """The folders of one streaming run."""

    def __init__(self, fx, name: str):
        self.fx = fx
        self.spark = fx.spark
        self.base = scratch_path(fx.spark, name)

    def path(self, *parts: str) -> str:
        return "/".join([self.base, *parts])

    def feed(self, df: DataFrame, name: str = "in", batches: int = 4) -> DataFrame:
        """Write ``df`` as files and stream them in that many batches of equally many files.

        There are at least as many files as the cluster has cores.
        """
        per_batch = -(-self.spark.sparkContext.defaultParallelism // batches)
        df.repartition(batches * per_batch).write.mode("append").parquet(self.path(name))
        return stream_table(self.spark, self.path(name), df.schema, per_batch)

    def feed_in_order(
        self, df: DataFrame, by: str, name: str = "in", batches: int = 4, last: DataFrame | None = None
    ) -> DataFrame:
        """Stream ``df`` in batches of rising ``by``; ``last`` is one more batch behind them."""
        per_batch = -(-self.spark.sparkContext.defaultParallelism // batches)
        micros = F.unix_micros(F.col(by).cast("timestamp"))
        steps = [i / batches for i in range(1, batches)]
        edges = df.agg(F.percentile_approx(micros, steps, 1000)).first()[0]
        for low, high in zip([None, *edges], [*edges, None]):
            part = df
            if low is not None:
                part = part.filter(micros > low)
            if high is not None:
                part = part.filter(micros <= high)
            part.repartition(per_batch).write.mode("append").parquet(self.path(name))
        if last is not None:
            last.repartition(1).write.mode("append").parquet(self.path(name))
        return stream_table(self.spark, self.path(name), df.schema, per_batch)

    def collected(self, stream: DataFrame, name: str = "out") -> DataFrame:
        """Run an append stream to its end and read its table."""
        append_stream(
            stream, self.path(name), self.path("checkpoint", name), available_now=True
        ).awaitTermination()
        return self.spark.read.schema(stream.schema).parquet(self.path(name))


def _bronze_queries(fx, run: Run, topic: str, schema) -> dict:
    log = fx.kafka_log().filter(F.col("topic") == topic)
    raw = raw_records(run.feed(log, f"log-{topic}", batches=2))
    queries = start_bronze(
        raw, topic, schema, run.path("bronze"), run.path("checkpoint"), available_now=True
    )
    return queries


def _bronze(fx, run: Run, topic: str, schema) -> None:
    await_all(list(_bronze_queries(fx, run, topic, schema).values()))


PARSED = """
    SELECT CASE WHEN k % 7 <> 0 THEN session_id END AS session_id, CASE WHEN k % 7 <> 0 THEN lap_number END AS lap_number,
           partition_id AS partition, offset_id AS "offset", topic AS bronze_topic
    FROM log WHERE topic = 'telemetry.raw'
"""


@query("SRC1_log_stream", PARSED)
def log_stream(fx):
    run = Run(fx, "src1")
    log = fx.kafka_log().filter("topic = 'telemetry.raw'")
    stream = parsed_records(raw_records(run.feed(log)), TELEMETRY, "telemetry.raw")
    return run.collected(stream).select("session_id", "lap_number", "partition", "offset", "bronze_topic")


@query("SNK1_bronze_tables", """
    SELECT CASE WHEN k % 7 <> 0 THEN session_id END AS session_id, CASE WHEN k % 7 <> 0 THEN lap_number END AS lap_number,
           partition_id AS partition, offset_id AS "offset", topic AS bronze_topic, 'parsed' AS kind FROM log
    UNION ALL SELECT NULL, NULL, partition_id, offset_id, topic, 'raw' FROM log
""")
def bronze_tables(fx):
    """Two topics, each as a raw and a parsed table."""
    run = Run(fx, "snk1")
    found = None
    for topic, schema in (("telemetry.raw", TELEMETRY), ("race.events", RACE_EVENT)):
        _bronze(fx, run, topic, schema)
        read = lambda kind: fx.spark.read.parquet(run.path("bronze", table_name(topic, kind)))  # noqa: B023, E731
        parsed = read("parsed").select(
            "session_id", "lap_number", "partition", "offset", "bronze_topic", F.lit("parsed").alias("kind")
        )
        raw = read("raw").select(
            F.lit(None).cast("string").alias("session_id"), F.lit(None).cast("int").alias("lap_number"),
            "partition", "offset", F.col("topic").alias("bronze_topic"), F.lit("raw").alias("kind"),
        )
        both = parsed.unionByName(raw)
        found = both if found is None else found.unionByName(both)
    return found


@query("STR1_append_streams", "SELECT sequence_number, session_id, speed_kph FROM telemetry")
def append_streams(fx):
    run = Run(fx, "str1")
    return run.collected(run.feed(fx.telemetry.select("sequence_number", "session_id", "speed_kph")))


@query("SRC2_table_stream", "SELECT session_id, count(*) AS samples FROM telemetry GROUP BY session_id")
def table_stream(fx):
    run = Run(fx, "src2")
    rows = run.collected(run.feed(fx.telemetry.select("sequence_number", "session_id"), batches=3))
    return rows.groupBy("session_id").agg(F.count("*").alias("samples"))


@query("STR2_admission_control", "SELECT 6::BIGINT AS batches, count(*) AS input_rows FROM events")
def admission_control(fx):
    """Files capped per trigger: six batches of equally many files."""
    run = Run(fx, "str2")
    stream = run.feed(fx.telemetry.select("sequence_number"), batches=6)
    started = append_stream(stream, run.path("out"), run.path("checkpoint"), available_now=True)
    done = follow_progress(fx.spark, [started], run.path("progress")).filter("input_rows > 0")
    return done.agg(F.count("*").alias("batches"), F.sum("input_rows").alias("input_rows"))


@query("STR3_restart", "SELECT sequence_number, session_id FROM telemetry")
def restart(fx):
    """Run, add files, run again from the checkpoint: every row arrives once."""
    run = Run(fx, "str3")
    rows = fx.telemetry.select("sequence_number", "session_id", "micro_sector_id")
    early, late = rows.filter("micro_sector_id < 12"), rows.filter("micro_sector_id >= 12")
    run.collected(run.feed(early.drop("micro_sector_id")))
    return run.collected(run.feed(late.drop("micro_sector_id")))


def _filled(fx, run: Run, name: str) -> BucketedTable:
    """A keyed table of five versions, a version for every fifth day."""
    table = BucketedTable(fx.spark, run.path(name), ["session_id", "driver_id", "lap_number"], buckets=8)
    counts = fx.telemetry.groupBy("session_id", "driver_id", "lap_number").agg(F.count("*").alias("samples"))
    for version in range(5):
        table.upsert(counts.filter(F.col("lap_number") % 5 == version), "merge", version)
    return table


@query("SRC2_change_feed", """
    SELECT session_id, driver_id, lap_number, count(*) AS samples, CAST(lap_number % 5 AS BIGINT) AS version
    FROM telemetry WHERE lap_number % 5 > 2 GROUP BY ALL
""")
def change_feed(fx):
    """The rows that the versions after the third one wrote."""
    return _filled(fx, Run(fx, "src2c"), "table").changes(2).withColumnRenamed("_version", "version")


@query("STR3_from_version", """
    SELECT session_id, count(*) AS laps, CAST(sum(n) AS BIGINT) AS samples
    FROM (SELECT session_id, driver_id, lap_number, count(*) AS n FROM telemetry WHERE lap_number % 5 > 1 GROUP BY ALL) l
    GROUP BY session_id
""")
def from_version(fx):
    """Processing again from version 1 on, in two runs of one query, equals one run over later rows."""
    run = Run(fx, "str3v")
    source = _filled(fx, run, "table")
    sums = BucketedTable(fx.spark, run.path("sums"), ["session_id"], buckets=4)
    total = lambda rows: rows.groupBy("session_id").agg(F.sum("laps").alias("laps"), F.sum("samples").alias("samples"))

    def add(changed: DataFrame, batch_id: int) -> None:
        sums.merge(changed.groupBy("session_id").agg(F.count("*").alias("laps"), F.sum("samples").alias("samples")), total, batch_id)

    for _ in range(2):
        source.stream_changes(add, run.path("checkpoint"), after=1).awaitTermination()
    return sums.read()


@query("STR4_concurrent_queries", """
    SELECT session_id, 'telemetry' AS source, count(*) AS records FROM telemetry GROUP BY session_id
    UNION ALL SELECT session_id, 'events', count(*) FROM interactions GROUP BY session_id
""")
def concurrent_queries(fx):
    run = Run(fx, "str4")
    feeds = {
        "telemetry": run.feed(fx.telemetry.select("session_id", "sequence_number"), "telemetry"),
        "events": run.feed(fx.interactions.select("session_id", "event_id"), "events"),
    }
    await_all([
        append_stream(feed, run.path("out", name), run.path("checkpoint", name), available_now=True)
        for name, feed in feeds.items()
    ])
    tables = [
        fx.spark.read.parquet(run.path("out", name)).groupBy("session_id").agg(F.count("*").alias("records"))
        .withColumn("source", F.lit(name))
        for name in feeds
    ]
    return tables[0].unionByName(tables[1])


def _deduped(run: Run, stream: DataFrame, keys: list[str]) -> DataFrame:
    history = stateful.KeyHistory(run.spark, run.path("seen"), keys)
    start_gold(stream, history.process, run.path("checkpoint"), available_now=True).awaitTermination()
    return history.rows()


@query("STR5_hash_dedup", "SELECT DISTINCT row_hash FROM dup_rows")
def hash_dedup(fx):
    """First arrival per hash over four batches, against the stored history."""
    run = Run(fx, "str5")
    return _deduped(run, run.feed(fx.dup_rows.select("row_hash")), ["row_hash"])


@query("STR6_event_time_dedup", "SELECT DISTINCT session_id, driver_id, date_trunc('hour', event_ts) AS hour_ts FROM telemetry")
def event_time_dedup(fx):
    """Four batches of rising time; the watermark follows by a day, so older keys leave the state."""
    run = Run(fx, "str6")
    hours = fx.telemetry.select("session_id", "driver_id", "event_ts", F.date_trunc("hour", "event_ts").alias("hour_ts"))
    stream = run.feed_in_order(hours, "event_ts").drop("event_ts")
    with rocksdb_state(fx.spark):
        return run.collected(stateful.dedup_stream(stream, ["session_id", "driver_id", "hour_ts"], "hour_ts", "1 day"))


@query("STR7_running_laps", """
    SELECT session_id, driver_id, lap_number, count(*) AS samples, CAST(sum(speed_kph) AS BIGINT) AS sum_speed_kph,
           CAST(max(speed_kph) AS BIGINT) AS max_speed_kph, CAST(min(speed_kph) AS BIGINT) AS min_speed_kph, max(event_ts) AS event_ts
    FROM telemetry GROUP BY session_id, driver_id, lap_number
""")
def running_laps(fx):
    """Each batch merges the aggregates of its rows into those of the same laps on storage, so no
    lap stays in executor memory and a lap is one row."""
    run = Run(fx, "str7")
    laps = ["session_id", "driver_id", "lap_number"]
    table = BucketedTable(fx.spark, run.path("laps"), laps, by=["session_id"])

    def save(batch: DataFrame, batch_id: int) -> None:
        table.merge(lap_partials(batch, sketch_of=None), merge_partials, batch_id)

    start_gold(run.feed(fx.telemetry), save, run.path("checkpoint"), available_now=True).awaitTermination()
    return table.read().select(
        *laps, "samples", "sum_speed_kph", "max_speed_kph", "min_speed_kph", F.col("last_event_ts").alias("event_ts")
    )


def _ended(df: DataFrame) -> DataFrame:
    """One row a month later that only moves the watermark past every window of ``df``."""
    columns = [
        (F.max("event_ts") + F.expr("INTERVAL 30 DAYS")).alias("event_ts") if c == "event_ts"
        else F.lit(None).cast(df.schema[c].dataType).alias(c)
        for c in df.columns
    ]
    return df.agg(*columns)


def _windows(fx, name: str, columns: list[str], metrics) -> DataFrame:
    """All closed windows of a stream in four batches of rising event time."""
    run = Run(fx, name)
    rows = fx.telemetry.select(*columns)
    stream = run.feed_in_order(rows, "event_ts", last=_ended(rows))
    return run.collected(metrics(stream)).filter(F.col("session_id").isNotNull())


@query("STR8_tumbling_windows", """
    SELECT date_trunc('day', event_ts) AS window_start, date_trunc('day', event_ts) + INTERVAL 1 DAY AS window_end,
           session_id, count(*) AS samples, CAST(sum(speed_kph) AS BIGINT) AS sum_speed_kph
    FROM telemetry GROUP BY ALL
""")
def tumbling_windows(fx):
    """Append mode emits a window once the watermark has passed its end."""
    return _windows(
        fx, "str8", ["session_id", "speed_kph", "event_ts"],
        lambda s: stateful.windowed_metrics(s, "event_ts", "1 hour", "1 day"),
    )


@query("STR8_sliding_windows", """
    SELECT s AS window_start, s + INTERVAL 2 DAY AS window_end, session_id, count(*) AS samples,
           CAST(sum(speed_kph) AS BIGINT) AS sum_speed_kph
    FROM (SELECT *, unnest([date_trunc('day', event_ts), date_trunc('day', event_ts) - INTERVAL 1 DAY]) AS s FROM telemetry) t
    GROUP BY ALL
""")
def sliding_windows(fx):
    return _windows(
        fx, "str8s", ["session_id", "speed_kph", "event_ts"],
        lambda s: stateful.windowed_metrics(s, "event_ts", "1 hour", "2 days", "1 day"),
    )


@query("STR8_driver_activity", """
    SELECT session_id, driver_id, min(event_ts) AS activity_start, max(event_ts) + INTERVAL 6 HOUR AS activity_end,
           count(*) AS samples
    FROM (SELECT *, sum(opens) OVER (PARTITION BY session_id, driver_id ORDER BY event_ts) AS part
          FROM (SELECT *, CASE WHEN event_ts < lag(event_ts) OVER (PARTITION BY session_id, driver_id ORDER BY event_ts)
                                             + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM telemetry) o) p
    GROUP BY session_id, driver_id, part
""")
def driver_activity(fx):
    return _windows(
        fx, "str8d", ["session_id", "driver_id", "event_ts"],
        lambda s: stateful.driver_activity(s, "event_ts", "1 hour", "6 hours"),
    )


@query("JN11_stream_join", """
    SELECT t.session_id, t.driver_id, t.sequence_number, t.event_ts, i.event_id, i.event_ts AS happened_at
    FROM telemetry t JOIN interactions i ON i.session_id = t.session_id AND i.driver_id = t.driver_id
         AND i.event_ts >= t.event_ts AND i.event_ts <= t.event_ts + INTERVAL 2 HOUR
""")
def stream_join(fx):
    """Both streams in four batches of rising event time, so matches cross batches."""
    run = Run(fx, "jn11")
    samples = run.feed_in_order(
        fx.telemetry.select("session_id", "driver_id", "sequence_number", "event_ts"), "event_ts", "samples"
    )
    events = run.feed_in_order(
        fx.interactions.select("session_id", "driver_id", "event_id", "event_ts"), "event_ts", "events"
    )
    return run.collected(stateful.join_streams(samples, events, "1 hour", 7200))


_JOBS: dict[tuple[str, str], GoldTables] = {}


def _gold_job(fx) -> GoldTables:
    """One finished run of the job per application and input, for the queries that read its tables."""
    key = (fx.spark.sparkContext.applicationId, fx.sf_dir)
    if key not in _JOBS:
        _JOBS[key] = _gold(fx, Run(fx, "snk2"))
    return _JOBS[key]


def _gold(fx, run: Run) -> GoldTables:
    """Telemetry in four batches, events in two, the last batch of each once more."""
    tables = GoldTables(
        fx.spark, run.path("gold"), style_widths=WIDTHS, drivers=fx.drivers, teams=fx.teams, buckets=8
    )
    telemetry = run.feed(fx.telemetry, "telemetry")
    events = run.feed(fx.interactions, "events", batches=2)

    def twice(handler, last: int):
        def handle(batch: DataFrame, batch_id: int) -> None:
            for _ in range(2 if batch_id == last else 1):
                handler(batch, batch_id)
        return handle

    await_all([
        start_gold(telemetry, twice(tables.telemetry_batch, 3), run.path("checkpoint", "t"), available_now=True),
        start_gold(events, twice(tables.event_batch, 1), run.path("checkpoint", "e"), available_now=True),
    ])
    return tables


@query("SNK2_gold_laps", RUNNING + "FROM telemetry GROUP BY session_id, driver_id, lap_number")
def gold_laps(fx):
    laps = _gold(fx, Run(fx, "snk2")).laps()
    return laps.select(
        "session_id", "driver_id", "lap_number", "samples", "sum_speed_kph", "min_speed_kph", "max_speed_kph",
        "avg_speed_kph", "avg_fuel_mass_kg", "first_event_ts", "last_event_ts",
    )


@query("SNK2_gold_lap_nodes", """
    SELECT concat(session_id, ':', driver_id, ':', CAST(lap_number AS STRING)) AS lap_id, session_id, driver_id, lap_number,
           round(avg(speed_kph), 6) AS avg_speed_kph, CAST(max(speed_kph) AS BIGINT) AS max_speed_kph,
           CAST(min(speed_kph) AS BIGINT) AS min_speed_kph, round(avg(battery_pct), 6) AS avg_battery_pct,
           max(event_ts) AS last_event_ts
    FROM telemetry GROUP BY session_id, driver_id, lap_number
""")
def gold_lap_nodes(fx):
    return _gold_job(fx).lap_nodes().select(
        "lap_id", "session_id", "driver_id", "lap_number", "avg_speed_kph", "max_speed_kph", "min_speed_kph",
        "avg_battery_pct", "last_event_ts",
    )


@query("SNK2_gold_pagerank", pagerank_sql(SESSION_GRAPH, ("session_id",)))
def gold_pagerank(fx):
    return _gold(fx, Run(fx, "snk2p")).pagerank()


ALL_EDGES = "SELECT DISTINCT attacker_id AS src, defender_id AS dst FROM edges"


@query("SNK2_gold_drivers", f"""
    WITH ranks AS MATERIALIZED ({pagerank_sql(ALL_EDGES, digits=None)}),
    styles AS (SELECT driver_id, arg_max(community_id, session_id) AS community_id FROM ({COMMUNITY_SQL}) c GROUP BY driver_id),
    names AS (SELECT driver_id, min(driver_name) AS driver_name, min(session_id) AS first_session_id,
                     max(session_id) AS latest_session_id
              FROM telemetry WHERE driver_name IS NOT NULL GROUP BY driver_id)
    SELECT t.driver_id, t.samples, t.avg_speed_kph, n.driver_name, n.first_session_id, n.latest_session_id,
           round(r.pagerank_score, 6) AS pagerank_score, s.community_id
    FROM (SELECT driver_id, count(*) AS samples, round(avg(speed_kph), 6) AS avg_speed_kph FROM telemetry GROUP BY driver_id) t
    LEFT JOIN names n ON n.driver_id = t.driver_id LEFT JOIN ranks r ON r.id = t.driver_id
    LEFT JOIN styles s ON s.driver_id = t.driver_id
""")
def gold_drivers(fx):
    """Upserted by both streams; the scores are published twice under one version."""
    tables = _gold_job(fx)
    for version in (0, 1, 1):
        tables.publish(version)
    return tables.driver_nodes().select(
        "driver_id", "samples", "avg_speed_kph", "driver_name", "first_session_id", "latest_session_id",
        "pagerank_score", "community_id",
    )


@query("SNK2_gold_sessions", """
    SELECT session_id, count(DISTINCT driver_id) AS driver_count, count(DISTINCT lap_number) AS lap_count,
           min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts
    FROM telemetry GROUP BY session_id
""")
def gold_sessions(fx):
    return _gold_job(fx).session_nodes()


@query("SNK2_gold_drove_in", """
    SELECT driver_id, session_id, min(lap_number) AS first_lap, max(lap_number) AS last_lap,
           min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts
    FROM telemetry GROUP BY driver_id, session_id
""")
def gold_drove_in(fx):
    return _gold_job(fx).table("DROVE_IN").read()


@query("SNK2_gold_completed_by", """
    SELECT DISTINCT concat(session_id, ':', driver_id, ':', CAST(lap_number AS STRING)) AS lap_id, driver_id FROM telemetry
""")
def gold_completed_by(fx):
    return _gold_job(fx).table("COMPLETED_BY").read()


@query("SNK2_gold_teams", """
    SELECT t.team_id, t.name, t.engine_supplier, d.driver_id
    FROM teams t JOIN drivers d ON d.team_id = t.team_id
""")
def gold_teams(fx):
    """Team nodes with the drivers that race for them."""
    tables = _gold_job(fx)
    return tables.table("Team").read().join(tables.table("RACES_FOR").read(), "team_id").select(
        "team_id", "name", "engine_supplier", "driver_id"
    )


def _latest_edge(rel: str) -> str:
    return f"""
        SELECT attacker_id AS src, defender_id AS dst, f[1] AS event_id, f[2] AS session_id, f[3] AS lap_number, event_ts
        FROM (SELECT attacker_id, defender_id, max(event_ts) AS event_ts,
                     arg_max(row(event_id, session_id, lap_number), row(event_ts, event_id)) AS f
              FROM edges WHERE rel = '{rel}' GROUP BY attacker_id, defender_id) e
        WHERE attacker_id IN (SELECT driver_id FROM drivers) AND defender_id IN (SELECT driver_id FROM drivers)
    """


def _gold_edges(fx, rel: str):
    edges = _gold_job(fx).edges(rel)
    return edges.select("src", "dst", "event_id", "session_id", "lap_number", "event_ts")


@query("SNK2_gold_overtakes", _latest_edge("OVERTAKE"))
def gold_overtakes(fx):
    return _gold_edges(fx, "OVERTAKE")


@query("SNK2_gold_battles", _latest_edge("BATTLE"))
def gold_battles(fx):
    return _gold_edges(fx, "BATTLE")


@query("SNK2_gold_serving", """
    SELECT 'overtaker' AS kind, session_id AS a, attacker_id AS b, count(*) AS overtakes, NULL::BIGINT AS other
    FROM edges WHERE rel = 'OVERTAKE' GROUP BY ALL
    UNION ALL
    SELECT 'rivalry', least(attacker_id, defender_id), greatest(attacker_id, defender_id),
           count(*) FILTER (WHERE rel = 'OVERTAKE'), count(*) FILTER (WHERE rel = 'BATTLE')
    FROM edges WHERE attacker_id <> defender_id GROUP BY ALL
    UNION ALL
    SELECT 'team', CAST(team_id AS STRING), NULL, count(*) FILTER (WHERE side = 'made'), count(*) FILTER (WHERE side = 'suffered')
    FROM (SELECT attacker_id AS id, 'made' AS side FROM edges WHERE rel = 'OVERTAKE'
          UNION ALL SELECT defender_id, 'suffered' FROM edges WHERE rel = 'OVERTAKE') s JOIN drivers d ON d.driver_id = s.id
    GROUP BY ALL
""")
def gold_serving(fx):
    """What dashboards read: top overtakers, rivalries and team standings, from counts the batches keep."""
    tables = _gold_job(fx)
    none = F.lit(None)
    made = tables.top_overtakers().select(
        F.lit("overtaker").alias("kind"), F.col("session_id").alias("a"), F.col("driver_id").alias("b"), "overtakes",
        none.cast("bigint").alias("other"),
    )
    pairs = tables.rivalries().select(F.lit("rivalry"), "driver_a_id", "driver_b_id", "overtakes", "battles")
    teams = tables.team_standings().select(
        F.lit("team"), F.col("team_id").cast("string"), none.cast("string"), "overtakes_made", "overtakes_suffered"
    )
    return made.union(pairs).union(teams)


@query("SNK2_gold_event_nodes", """
    SELECT 'Driver' AS label, driver_id AS id, min(driver_name) AS name, min(session_id) AS first_session_id
    FROM interactions WHERE driver_id IS NOT NULL AND driver_name IS NOT NULL GROUP BY driver_id
    UNION ALL SELECT DISTINCT 'Session', session_id, NULL, NULL FROM interactions
""")
def gold_event_nodes(fx):
    tables = _gold_job(fx)
    drivers = tables.table("Driver-events").read().select(
        F.lit("Driver").alias("label"), F.col("driver_id").alias("id"),
        F.col("driver_name").alias("name"), "first_session_id",
    )
    sessions = tables.table("Session-events").read().select(F.lit("Session").alias("label"), F.col("session_id").alias("id"))
    return drivers.unionByName(sessions, allowMissingColumns=True)


@query("SNK2_gold_sample", """
    SELECT sequence_number, session_id FROM telemetry ORDER BY md5(concat('42_', CAST(sequence_number AS STRING))) LIMIT 50
""")
def gold_sample(fx):
    """The sample kept over four batches is the sample of the whole stream."""
    run = Run(fx, "snk2s")
    tables = GoldTables(fx.spark, run.path("gold"), sample_size=50)
    stream = run.feed(fx.telemetry)
    start_gold(stream, tables.telemetry_batch, run.path("checkpoint"), available_now=True).awaitTermination()
    return tables.sample().select("sequence_number", "session_id")


def _tracked_runs(fx, name: str) -> RunTable:
    """Laps and pairs of drivers in four runs of one query that go on from its checkpoint. Each run
    has every fourth lap, the last run those of the start of the race: three bring late laps."""
    run = Run(fx, name)
    table = RunTable(fx.spark, run.path("state"), watermark="60 days", idle_seconds=86_400)
    starts = fx.laps.select("session_id", "lap_number", F.col("driver_id").alias("driver_a"), F.col("lap_start").alias("seen"))
    pairs = adjacent_pairs(fx.laps).join(starts, ["session_id", "lap_number", "driver_a"])
    laps = stint_laps(fx.laps).unionByName(battle_laps(pairs, "seen"))
    for quarter in (1, 3, 2, 0):
        table.start(run.feed(laps.filter(F.col("lap_number") % 4 == quarter), batches=1)).awaitTermination()
    return table


@query("STR10_stint_tracker", f"SELECT session_id, driver_id, lap_number, compound, stint_no FROM ({STINTS}) s")
def stint_tracker(fx):
    return _tracked_runs(fx, "str10").stints()


@query("STR10_battle_tracker", f"""
    SELECT session_id, driver_a_id, driver_b_id, lap_number, lap_count, event_ts, delta_time_ms, avg_gap_ms
    FROM ({BATTLES}) b
""")
def battle_tracker(fx):
    return _tracked_runs(fx, "str10b").battles().drop("interaction_strength")


@query("STR11_progress", "SELECT 4::BIGINT AS batches, count(*) AS input_rows, 3::BIGINT AS last_batch, FALSE AS falling_behind FROM events")
def progress(fx):
    run = Run(fx, "str11")
    started = append_stream(
        run.feed(fx.telemetry.select("sequence_number")), run.path("out"), run.path("checkpoint"), available_now=True
    )
    done = follow_progress(fx.spark, [started], run.path("progress")).filter("input_rows > 0")
    return progress_summary(done, trigger_ms=600_000).select(
        "batches", "input_rows", "last_batch", "falling_behind"
    )


@query("AGG22_observed_null_rates", NULL_RATES)
def observed_null_rates(fx):
    """The batch figures of AGG22, counted by the stream itself in four batches."""
    run = Run(fx, "agg22")
    columns = ["session_id", "driver_id", "lap_number", "speed_kph"]
    stream = monitor.observe_quality(run.feed(fx.dirty.select(*columns)), columns)
    started = append_stream(stream, run.path("out"), run.path("checkpoint"), available_now=True)
    return monitor.observed_null_rates(follow_progress(fx.spark, [started], run.path("progress")))


@query("STR11_observed_rejects", """
    SELECT count(*) AS rows, count(*) FILTER (WHERE k % 7 = 0) AS rejected FROM log WHERE topic = 'telemetry.raw'
""")
def observed_rejects(fx):
    """What the bronze stream of a topic reports: records read and records that could not be parsed."""
    run = Run(fx, "str11r")
    started = _bronze_queries(fx, run, "telemetry.raw", TELEMETRY)
    parsed = started[table_name("telemetry.raw", "parsed")]
    totals = monitor.observed_totals(follow_progress(fx.spark, [parsed], run.path("progress")))
    return totals.groupBy().pivot("metric", ["rows", "rejected"]).agg(F.first("total"))
