"""Payload parsing, keys, offsets, options and message texts."""

import json

import pytest
from pyspark.sql import functions as F

from lapgraph import schemas
from lapgraph.functions import scalars
from lapgraph.operators import graph, parsing
from lapgraph.sources import sinks, tables

EVENTS = "session_id string, event_id string, event_ts_utc string, event_type string, driver_id string, lap_number int, payload string"


def events(spark, *payloads):
    rows = [("s", f"e{i}", "2024-01-01T00:00:00", "Overtake", "D1", 4, p) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, EVENTS)


def test_schema_sizes():
    sizes = [len(s.fields) for s in (schemas.TELEMETRY, schemas.RACE_EVENT, schemas.LAP_METRICS, schemas.INTERACTION)]
    assert sizes == [39, 19, 16, 10]
    assert not schemas.TELEMETRY["timestamp_utc"].nullable and schemas.TELEMETRY["gear"].nullable


def test_payload_branches(spark):
    table = events(
        spark, None, "", "{bad", '{"attacker_id":"A","defender_id":"B","lap_number":"x"}',
        '{"driver_a_id":"C","driver_b_id":"D","lap_number":9,"lap_count":3}', '{"defender_id":"E"}',
    )
    got = {r.event_id: r for r in parsing.resolve_interaction(table).collect()}
    assert [got[f"e{i}"].attacker_id for i in range(6)] == ["D1", "D1", "D1", "A", "C", "D1"]
    assert [got[f"e{i}"].defender_id for i in range(6)] == [None, None, None, "B", "D", "E"]
    assert [got[f"e{i}"].lap_number for i in range(6)] == [4, 4, 4, 4, 9, 4]
    assert graph.interactions_of(table, "OVERTAKE").count() == 3


def test_interaction_message(spark):
    message = graph.interaction_edges(
        events(spark, '{"attacker_id":"A","defender_id":"B","avg_gap_ms":5}'), "overtake"
    ).collect()[0]
    body = json.loads(message.value)
    assert message.key == "s:A:B:4"
    assert body["relationship_type"] == "OVERTAKE"
    assert body["start"] == {"label": "Driver", "id": "A"} and body["end"]["id"] == "B"
    assert body["properties"] == {
        "session_id": "s", "event_id": "e0", "lap_number": 4, "avg_gap_ms": 5.0,
        "event_ts_utc": "2024-01-01T00:00:00",
    }


def test_null_part_shortens_the_key(spark):
    row = spark.createDataFrame([("s", None, 3)], "a string, b string, c int").select(
        scalars.composite_key("a", "b", "c").alias("key"), scalars.has_all("a", "b", "c").alias("whole")
    ).first()
    assert (row.key, row.whole) == ("s:3", False)


def test_offset_totals(spark):
    texts = ['{"t":{"0":5,"1":7},"u":{"0":1}}', '{"u":{"0":1}}', "{bad", None]
    table = spark.createDataFrame([(t,) for t in texts], "o string")
    assert [r.n for r in table.select(scalars.offset_total(F.col("o"), "t").alias("n")).collect()] == [12, 0, 0, 0]


def test_milliseconds_truncate_toward_zero(spark):
    row = spark.createDataFrame([(1.9999, -1.9999)], "a double, b double").select(
        scalars.seconds_to_ms(F.col("a")).alias("a"), scalars.seconds_to_ms(F.col("b")).alias("b")
    ).first()
    assert (row.a, row.b) == (1999, -1999)


def test_camel_case(spark):
    assert parsing.camel_case(spark.createDataFrame([(1, 2)], "avg_speed_kph int, lap_id int")).columns == ["avgSpeedKph", "lapId"]


def test_options():
    assert tables.option_dict(["a=1", " b = x=y "]) == {"a": "1", "b": "x=y"}
    with pytest.raises(ValueError):
        tables.option_dict(["a"])
    options = tables.log_options("h:1", "earliest", ["maxOffsetsPerTrigger=5"])
    assert options["maxOffsetsPerTrigger"] == "5" and options["failOnDataLoss"] == "false"
    assert tables.log_options("h:1")["maxOffsetsPerTrigger"] == "100000"
    assert sinks.table_name("telemetry.raw", "parsed") == "telemetry_raw-parsed"
    assert tables.table_format("x/teams.delta") == "delta" and tables.table_format("x/teams") == "parquet"


def test_quarantine_split(spark):
    raw = spark.createDataFrame(
        [("k", v, "t", 0, i) for i, v in enumerate([None, "{bad", '{"session_id":"s","driver_id":"d","timestamp_utc":"x"}'])],
        "kafka_key string, kafka_value string, topic string, partition int, offset bigint",
    ).withColumn("kafka_timestamp", F.current_timestamp()).withColumn("ingested_at", F.current_timestamp())
    good, bad = parsing.split_unparseable(raw, schemas.TELEMETRY, ["session_id", "driver_id", "timestamp_utc"])
    assert [r.offset for r in good.collect()] == [2]
    assert {r.offset: r.reason for r in bad.collect()} == {0: "null value", 1: "missing required field"}


def test_missing_required_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.require_tables(spark, {"telemetry": str(tmp_path / "none")}, {})
