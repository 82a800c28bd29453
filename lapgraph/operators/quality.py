"""Counts, loss and lateness checks of the ingest path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapgraph.operators.ordered import running_agg

POSITION = ["topic", "partition", "offset"]


def message_counts(log: DataFrame) -> DataFrame:
    """Messages and offset span per topic and partition, per topic, and overall.

    NULL topic or partition marks a total line; ``level`` tells totals from real NULLs.
    """
    return log.rollup("topic", "partition").agg(
        F.grouping_id().alias("level"),
        F.count("*").alias("messages"),
        (F.max("offset") - F.min("offset") + 1).alias("offset_span"),
    )


def unparsed_offsets(raw: DataFrame, parsed: DataFrame) -> DataFrame:
    """Log positions that were read but have no parsed row."""
    return raw.join(parsed.select(*POSITION), POSITION, "left_anti")


def reconcile(
    available: DataFrame, consumed: DataFrame, written: DataFrame, backlog: int, min_written: int
) -> DataFrame:
    """Per topic: available, consumed and written rows, and whether data was lost, meaning
    consumption has (nearly) caught up but too little was written."""
    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("topic").agg(F.count("*").alias(name))

    joined = (
        counts(available, "available")
        .join(counts(consumed, "consumed"), "topic", "left")
        .join(counts(written, "written"), "topic", "left")
        .fillna(0, ["consumed", "written"])
    )
    caught_up = F.col("consumed") >= F.col("available") - F.lit(backlog)
    return joined.withColumn(
        "data_loss", caught_up & (F.col("written") < F.lit(min_written))
    ).withColumn("unwritten", F.col("consumed") - F.col("written"))


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of NULLs per column, from one pass."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return counts.unpivot(["_rows"], list(columns), "column_name", "null_count").select(
        "column_name", "null_count", F.try_divide("null_count", "_rows").alias("null_rate")
    )


def late_arrivals(
    df: DataFrame, keys: Sequence[str], arrival: str, delay_seconds: int, width: int = 100_000,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Mark rows older than the newest time seen before or at them, minus the delay."""
    newest = running_agg(df, keys, arrival, "event_ts", width, "_newest", F.max, tie)
    return newest.withColumn(
        "is_late", F.col("event_ts") < F.col("_newest") - F.expr(f"INTERVAL {int(delay_seconds)} SECONDS")
    ).drop("_newest")


def late_rate(marked: DataFrame, keys: Sequence[str]) -> DataFrame:
    late: Column = F.count_if("is_late")
    return marked.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        late.alias("late_rows"),
        (late / F.count("*")).alias("late_rate"),
    )
