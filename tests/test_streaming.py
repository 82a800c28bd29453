"""Stream runs: replay, restart, stint state, failures."""

import datetime
import json
from types import SimpleNamespace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lapgraph.operators import sampling
from lapgraph.operators.facts import with_stints
from lapgraph.operators.ordered import time_block
from lapgraph.session import scratch_path
from lapgraph.sources.tables import stream_table
from lapgraph.streaming import monitor
from lapgraph.streaming.gold import GoldTables, start_gold
from lapgraph.streaming.runs import RunTable, battle_laps, rocksdb_state, stint_laps
from lapgraph.streaming.state import VersionedTable
from lapgraph.streaming.stateful import KeyHistory, dedup_stream


def telemetry(spark, first, last):
    return spark.range(first, last).select(
        F.lit("s").alias("session_id"), (F.col("id") % 3).cast("string").alias("driver_id"),
        (F.col("id") % 7).cast("int").alias("lap_number"), F.col("id").alias("speed_kph"),
        F.col("id").alias("battery_pct"), F.col("id").alias("fuel_mass_kg"),
        F.timestamp_seconds("id").alias("event_ts"), F.col("id").alias("sequence_number"),
    )


def test_replayed_batch_changes_nothing(spark):
    gold = GoldTables(spark, scratch_path(spark, "t-gold"), keep_partials=True)
    gold.telemetry_batch(telemetry(spark, 0, 50), 0)
    gold.telemetry_batch(telemetry(spark, 50, 120), 1)
    before = gold.rollup(["session_id"]).first().samples
    gold.telemetry_batch(telemetry(spark, 50, 120), 1)
    assert gold.rollup(["session_id"]).first().samples == before == 120
    assert gold.rollup(["session_id"], "last_batch").first().samples == 70
    gold.telemetry_batch(telemetry(spark, 0, 0), 2)
    assert gold.rollup(["session_id"], "last_batch").first().samples == 70


def test_a_failing_batch_stops_the_query(spark):
    base = scratch_path(spark, "t-fail")
    telemetry(spark, 0, 5).write.parquet(f"{base}/in")

    def broken(batch, batch_id):
        raise RuntimeError("write failed")

    stream = stream_table(spark, f"{base}/in", telemetry(spark, 0, 1).schema)
    with pytest.raises(StreamingQueryException):
        start_gold(stream, broken, f"{base}/checkpoint", available_now=True).awaitTermination()


def test_plain_files_need_a_schema(spark):
    with pytest.raises(ValueError):
        stream_table(spark, "anywhere")
    with pytest.raises(ValueError):
        stream_table(spark, "anywhere", telemetry(spark, 0, 1).schema, starting_version=3)


LAPS = "session_id string, driver_id string, lap_number int, compound string, pit_in timestamp, lap_start timestamp"


def tracked(spark, name, parts, **options):
    """Each part is one run of the same query, which goes on from its checkpoint."""
    base = scratch_path(spark, name)
    table = RunTable(spark, base, **{"watermark": "10 days", "idle_seconds": 3600, **options})
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = stream_table(spark, f"{base}/in", part.schema, 1)
        table.start(stream).awaitTermination()
    return table


def test_stints_span_batches(spark):
    """Two drivers, a change of compound, a pit stop; late laps come in the last run."""
    rows, ts = [], datetime.datetime(2024, 1, 1)
    for lap in range(1, 13):
        at = ts + datetime.timedelta(minutes=lap)
        rows.append(("s", "A", lap, "SOFT" if lap < 6 else "HARD", ts if lap == 8 else None, at))
        rows.append(("s", "B", lap, "HARD" if lap == 3 else None, None, at))
    laps = spark.createDataFrame(rows, LAPS)
    whole = {(r.driver_id, r.lap_number): r.stint_no for r in with_stints(laps).collect()}
    parts = ["lap_number IN (1, 2, 4, 5)", "lap_number BETWEEN 6 AND 8", "lap_number > 8", "lap_number = 3"]
    table = tracked(spark, "t-stints", [stint_laps(laps.filter(p)) for p in parts])
    got = {(r.driver_id, r.lap_number): r.stint_no for r in table.stints().collect()}
    assert got == whole and whole["A", 12] == 3 and [whole["B", lap] for lap in (2, 3, 4)] == [1, 2, 3]


PAIRS = (
    "session_id string, driver_a string, driver_b string, lap_number int, ahead_time bigint, ahead_end timestamp, "
    "behind_time bigint, seen timestamp"
)


def test_battles_merge_when_a_late_lap_fills_the_gap(spark):
    ts = datetime.datetime(2024, 1, 1)
    laps = [1, 2, 4, 5, 9]
    rows = lambda *laps: spark.createDataFrame(
        [("s", "A", "B", lap, 100 + lap, ts, 103 + 2 * lap, ts + datetime.timedelta(minutes=lap)) for lap in laps], PAIRS
    )
    table = tracked(spark, "t-battles", [battle_laps(rows(*part), "seen") for part in (laps[:3], laps[3:])])
    spans = lambda: sorted((r.lap_number, r.lap_count, r.delta_time_ms) for r in table.battles().collect())
    assert spans() == [(1, 2, 4), (4, 2, 7)]
    battle_laps(rows(3), "seen").coalesce(1).write.mode("append").parquet(f"{table.path}/in")
    table.start(stream_table(spark, f"{table.path}/in", battle_laps(rows(3), "seen").schema, 1)).awaitTermination()
    assert spans() == [(1, 5, 4)]


def test_idle_keys_leave_the_state(spark):
    """Five drivers, one after another by days; with a watermark of an hour only the last is kept."""
    ts = datetime.datetime(2024, 1, 1)
    part = lambda day: stint_laps(spark.createDataFrame(
        [("s", f"D{day}", lap, "SOFT", None, ts + datetime.timedelta(days=day, minutes=lap)) for lap in (1, 2, 3)], LAPS
    ))
    base = scratch_path(spark, "t-idle")
    table, kept = RunTable(spark, base, watermark="1 hour", idle_seconds=3600), []
    for day in range(5):
        part(day).coalesce(1).write.mode("append").parquet(f"{base}/in")
        query = table.start(stream_table(spark, f"{base}/in", part(0).schema, 1))
        query.awaitTermination()
        kept.append(json.loads(query.lastProgress.json)["stateOperators"][0]["numRowsTotal"])
    assert kept[-1] <= kept[1]
    assert table.stints().count() == 15  # what was emitted stays


def test_versioned_table(spark):
    table = VersionedTable(spark, scratch_path(spark, "t-versions"))
    rows = lambda *x: spark.createDataFrame(list(x), "id int, a string, b int")
    assert table.read() is None
    table.upsert(rows((1, "x", 1), (2, "y", 2)), ["id"], "keep", 0)
    for _ in range(2):
        table.upsert(rows((2, None, 5), (3, "z", 3)), ["id"], "keep", 1)
        assert sorted(map(tuple, table.read().collect())) == [(1, "x", 1), (2, "y", 5), (3, "z", 3)]
    for version in (2, 3):
        table.upsert(rows((1, "w", 9)), ["id"], "update", version)
    assert table.versions() == [2, 3]


def test_folded_laps_equal_one_batch(spark):
    gold, whole = (GoldTables(spark, scratch_path(spark, name), buckets=2) for name in ("t-batches", "t-whole"))
    for batch in range(5):
        gold.telemetry_batch(telemetry(spark, 40 * batch, 40 * batch + 40), batch)
    gold.telemetry_batch(telemetry(spark, 160, 200), 4)
    whole.telemetry_batch(telemetry(spark, 0, 200), 0)
    for read in (lambda t: t.laps(), lambda t: t.session_nodes(), lambda t: t.driver_nodes(), lambda t: t.table("DROVE_IN").read()):
        got, want = (sorted(map(str, read(t).collect())) for t in (gold, whole))
        assert got == want and len(want) > 0


def test_a_failing_table_fails_the_batch_and_a_replay_mends_it(spark, monkeypatch):
    gold = GoldTables(spark, scratch_path(spark, "t-half"), buckets=2)
    with monkeypatch.context() as patch:
        patch.setattr(GoldTables, "_sessions_of", lambda *a: (_ for _ in ()).throw(RuntimeError("stop")))
        with pytest.raises(RuntimeError):
            gold.telemetry_batch(telemetry(spark, 0, 50), 0)
    gold.telemetry_batch(telemetry(spark, 0, 50), 0)
    assert gold.session_nodes().first().lap_count == 7
    assert gold.rollup(["session_id"]).first().samples == 50


def test_merged_sample_equals_the_sample_of_all(spark):
    rows = spark.range(5000).select("id", (F.col("id") * 7 % 11).alias("x"))
    whole = sorted(r.id for r in sampling.uniform_sample(rows, "id", 100).collect())
    for cuts in ((1000, 4999), (10, 20), (2500, 2501)):
        edges = [0, *cuts, 5000]
        kept = None
        for low, high in zip(edges, edges[1:]):
            part = sampling.bottom_k(rows.filter(F.col("id").between(low, high - 1)), "id", 100)
            kept = part if kept is None else sampling.merged_sample(kept.unionByName(part), "id", 100, keep_key=True)
        assert sorted(r.id for r in sampling.merged_sample(kept, "id", 100).collect()) == whole
        total = sampling.estimated_total(kept, 100).first()
        assert not total.exact and abs(total.rows - 5000) < 1500
    few = sampling.estimated_total(sampling.bottom_k(rows.limit(30), "id", 100), 100).first()
    assert few.exact and few.rows == 30


def test_dedup_over_batches(spark):
    base = scratch_path(spark, "t-dedup")
    rows = spark.range(60).select((F.col("id") % 20).alias("key"), F.timestamp_seconds("id").alias("ts"))
    rows.repartition(5).write.parquet(f"{base}/in")
    stream = dedup_stream(stream_table(spark, f"{base}/in", rows.schema, 1), ["key"], "ts", "1 day")
    query = stream.writeStream.format("parquet").option("path", f"{base}/out").option(
        "checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.parquet(f"{base}/out").count() == 20


def test_dedup_state_follows_the_watermark(spark):
    """A day of keys per batch: the state holds about the watermark's length, not all days."""
    base = scratch_path(spark, "t-expire")
    for day in range(6):
        rows = spark.range(day * 100, day * 100 + 120).select(
            (F.col("id") % 100 + 100 * day).alias("key"), F.timestamp_seconds(F.lit((day + 1) * 86_400) + F.col("id") % 100).alias("ts")
        )
        rows.coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = dedup_stream(stream_table(spark, f"{base}/in", rows.schema, 1), ["key"], "ts", "1 hour")
    with rocksdb_state(spark):
        query = stream.writeStream.format("parquet").option("path", f"{base}/out").option(
            "checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.parquet(f"{base}/out").count() == 600
    states = [json.loads(p.json)["stateOperators"][0] for p in query.recentProgress]
    assert max(s["numRowsTotal"] for s in states) <= 200 and sum(s["numRowsRemoved"] for s in states) >= 500


def test_key_history_keeps_the_first_row(spark):
    history = KeyHistory(spark, scratch_path(spark, "t-history"), ["key"], ["ts"])
    rows = spark.range(60).select((F.col("id") % 20).alias("key"), F.col("id").alias("ts"))
    for batch_id, part in ((0, "ts < 25"), (1, "ts >= 25"), (1, "ts >= 25")):
        history.process(rows.filter(part), batch_id)
    assert sorted(r.ts for r in history.rows().collect()) == list(range(20))


def test_key_history_reads_touched_buckets_only(spark):
    """A bucket per time step: the files that a batch reads stay the same over many batches."""
    history = KeyHistory(
        spark, scratch_path(spark, "t-steps"), ["key", "ts"], place=lambda: F.floor(F.col("ts") / 100)
    )
    read = []
    for batch in range(6):
        rows = spark.range(batch * 100 - 20, batch * 100 + 80).select((F.col("id") % 50).alias("key"), F.col("id").alias("ts"))
        known = history.table.near(rows) if batch else None
        read.append(len(known.inputFiles()) if batch else 0)
        history.process(rows.filter("ts >= 0"), batch)
    assert max(read) <= 2 * max(read[1:3]) and history.rows().count() == 580


def test_time_block_handles_both_timestamp_types(spark):
    row = spark.range(1).select(
        time_block(F.lit("1970-01-01 00:02:00").cast("timestamp"), 60).alias("a"),
        time_block(F.lit("1970-01-01 00:02:00").cast("timestamp_ntz"), 60).alias("b"),
    ).first()
    assert (row.a, row.b) == (2, 2)


class LongQuery:
    """A query of which 40 of 250 batches end between two looks; the last 100 are kept."""

    name, id = "long", "id"

    def __init__(self, step=40):
        self.done, self.step = 0, step

    @property
    def isActive(self):  # noqa: N802
        self.done = min(self.done + self.step, 250)
        return self.done < 250

    @property
    def recentProgress(self):  # noqa: N802
        late = [{"numRowsDroppedByWatermark": 2}]
        return [
            SimpleNamespace(json=json.dumps({
                "name": "long", "id": "id", "batchId": b, "timestamp": f"t{b}", "numInputRows": 10,
                "stateOperators": late, "sources": [{"endOffset": b}],
            }))
            for b in range(max(self.done - 100, 0), self.done)
        ]

    def awaitTermination(self):  # noqa: N802
        pass


def test_progress_of_a_long_run(spark, tmp_path):
    rows = monitor.follow_progress(spark, [LongQuery()], str(tmp_path / "progress"), poll_seconds=0)
    out = monitor.progress_summary(rows, 1000).first()
    assert (out["batches"], out["input_rows"], out["dropped_late_rows"], out["last_batch"]) == (250, 2500, 500, 249)
    with pytest.raises(RuntimeError):  # rather than a table with gaps
        monitor.follow_progress(spark, [LongQuery(step=120)], str(tmp_path / "gaps"), poll_seconds=0)


def test_quantiles_of_all_batches(spark):
    gold = GoldTables(spark, scratch_path(spark, "t-quantiles"), quantiles=True, buckets=2)
    for batch in range(3):
        gold.telemetry_batch(telemetry(spark, 700 * batch, 700 * batch + 700), batch)
    gold.vacuum(keep=1, retain_seconds=0)
    found = gold.speed_quantiles(["session_id"], [0.1, 0.5, 0.9]).collect()
    assert {r.rows for r in found} == {2100}
    for row in found:  # speeds are 0 to 2099, each once
        assert abs(row.quantile - row.probability * 2100) <= 0.01 * 2100 + 1
    assert gold.rollup(["session_id"]).first().samples == 2100
