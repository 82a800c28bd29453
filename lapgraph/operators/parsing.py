"""Log records to typed rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lapgraph.schemas import INTERACTION, relaxed

LOG_COLUMNS = [
    "kafka_key", "kafka_value", "topic", "partition", "offset", "kafka_timestamp", "ingested_at",
]


def raw_records(log: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Text key and value with their log position, stamped with the ingestion time."""
    return log.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("kafka_value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
    )


def parsed_records(raw: DataFrame, schema: StructType, topic: str | Column) -> DataFrame:
    """Flatten the JSON value next to the log position; bad JSON gives NULL fields."""
    origin = F.lit(topic) if isinstance(topic, str) else topic
    return raw.select(
        F.from_json("kafka_value", schema).alias("record"),
        *[c for c in LOG_COLUMNS if c != "kafka_value"],
        origin.alias("bronze_topic"),
    ).select("record.*", *[c for c in LOG_COLUMNS if c != "kafka_value"], "bronze_topic")


def split_unparseable(
    raw: DataFrame, schema: StructType, required: list[str]
) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined): a record is bad when a required field is missing after parsing."""
    record = F.from_json("kafka_value", schema)
    tested = raw.withColumn("record", record)
    complete = reduce(
        lambda acc, name: acc & F.col(f"record.{name}").isNotNull(), required, F.lit(True)
    )
    complete = F.coalesce(complete, F.lit(False))
    good = tested.filter(complete).select("record.*", *LOG_COLUMNS)
    reason = F.when(F.col("kafka_value").isNull(), "null value").otherwise("missing required field")
    bad = tested.filter(~complete).drop("record").withColumn("reason", reason)
    return good, bad


def interaction_payload(payload: str = "payload") -> Column:
    """The nested interaction record; NULL or empty text gives a struct of typed NULLs."""
    nothing = F.struct(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in relaxed(INTERACTION).fields]
    )
    text = F.col(payload)
    return F.when(text.isNull() | (text == ""), nothing).otherwise(F.from_json(text, INTERACTION))


def resolve_interaction(events: DataFrame) -> DataFrame:
    """Attach attacker, defender, lap and timing, falling back from payload to event fields.

    The payload is generated, not projected: filters on its fields stay above it, so the
    text is parsed once per row.
    """
    parsed = events.withColumn("_p", F.explode(F.array(interaction_payload())))
    return parsed.withColumns(
        {
            "attacker_id": F.coalesce("_p.attacker_id", "_p.driver_a_id", "driver_id"),
            "defender_id": F.coalesce("_p.defender_id", "_p.driver_b_id"),
            "lap_number": F.coalesce("_p.lap_number", "lap_number"),
            "lap_count": F.col("_p.lap_count"),
            "avg_gap_ms": F.col("_p.avg_gap_ms"),
            "delta_time_ms": F.col("_p.delta_time_ms"),
        }
    ).drop("_p")


def camel_case(df: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """Graph property names: ``max_lap_seen`` becomes ``maxLapSeen``."""

    def camel(name: str) -> str:
        head, *rest = name.split("_")
        return head + "".join(part.capitalize() for part in rest)

    names = {c: camel(c) for c in df.columns}
    names.update(extra or {})
    return df.withColumnsRenamed(names)
