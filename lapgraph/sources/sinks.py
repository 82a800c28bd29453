"""Append sinks, partitioned tables, message tables, quarantine."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lapgraph.operators.parsing import parsed_records, split_unparseable
from lapgraph.streaming.monitor import observe_quality

# Trigger intervals of the two stages.
BRONZE_TRIGGER = "30 seconds"
GOLD_TRIGGER = "60 seconds"


def table_name(topic: str, kind: str) -> str:
    """``telemetry.raw`` and ``parsed`` give ``telemetry_raw-parsed``."""
    return f"{topic}-{kind}".replace(".", "_")


def trigger_options(available_now: bool, interval: str) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": interval}


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    table_type: str = "parquet",
    partition_by: list[str] | None = None,
    available_now: bool = False,
    interval: str = BRONZE_TRIGGER,
) -> StreamingQuery:
    """Start an append query with its own path and checkpoint."""
    writer = (
        df.writeStream.format(table_type)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(available_now, interval))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


def start_bronze(
    raw: DataFrame,
    topic: str,
    schema: StructType,
    output_base: str,
    checkpoint_base: str,
    table_type: str = "parquet",
    available_now: bool = False,
) -> dict[str, StreamingQuery]:
    """The raw and the parsed table of one topic as two append streams.

    The parsed stream reports rows, NULLs of the required ids and rejected (unparseable) records
    as it runs, see ``streaming.monitor.observe_quality``.
    """
    parsed = parsed_records(raw, schema, topic)
    required = [c for c in ("session_id", "driver_id") if c in parsed.columns]
    unusable = reduce(Column.__and__, [F.col(c).isNull() for c in schema.names]) if required else None
    frames = {"raw": raw, "parsed": observe_quality(parsed, required, unusable) if required else parsed}
    return {
        table_name(topic, kind): append_stream(
            frame,
            f"{output_base}/{table_name(topic, kind)}",
            f"{checkpoint_base}/{table_name(topic, kind)}",
            table_type,
            available_now=available_now,
        )
        for kind, frame in frames.items()
    }


def with_ingest_date(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.to_date("ingested_at"))


def write_by_date(df: DataFrame, path: str, table_type: str = "parquet", batch_id: int = 0) -> None:
    """One batch, partitioned by ingestion date; a replay overwrites the same folder."""
    with_ingest_date(df).write.format(table_type).mode("overwrite").partitionBy("date").save(
        f"{path}/batch={batch_id}"
    )


def write_tables(tables: Mapping[str, DataFrame], base: str, batch_id: int) -> None:
    """Write several results of one batch; a replay overwrites the same ``batch`` folders."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{base}/{name}/batch={batch_id}")


def write_messages(
    messages: DataFrame, path: str | None = None, kafka: Mapping[str, str] | None = None, batch_id: int = 0
) -> None:
    """Send ``{key, value}`` rows to a topic, or write them as one batch of a JSON table, which a
    replay overwrites."""
    if kafka is not None:
        messages.selectExpr("CAST(key AS STRING) AS key", "value").write.format("kafka").options(
            **kafka
        ).save()
    elif path is not None:
        messages.write.mode("overwrite").json(f"{path}/batch={batch_id}")
    else:
        raise ValueError("give a path or kafka options")


def write_with_quarantine(
    raw: DataFrame, schema: StructType, required: list[str], good_path: str, bad_path: str, batch_id: int
) -> None:
    """Typed rows to one table, unusable records with their reason to another."""
    kept = raw.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good, bad = split_unparseable(kept, schema, required)
        good.write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{bad_path}/batch={batch_id}")
    finally:
        kept.unpersist()
