"""Progress of streaming queries as rows."""

from __future__ import annotations

import json
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

PROGRESS_DDL = (
    "query string, batch_id bigint, input_rows bigint, duration_ms bigint, "
    "dropped_late_rows bigint, end_offsets string, observed string"
)
#: The name under which ``observe_quality`` reports.
QUALITY = "quality"


def _row(progress: dict) -> tuple:
    late = sum(s.get("numRowsDroppedByWatermark", 0) for s in progress.get("stateOperators", []))
    offsets = json.dumps([s.get("endOffset") for s in progress.get("sources", [])])
    return (
        progress.get("name") or progress["id"],
        progress["batchId"],
        progress["numInputRows"],
        progress.get("durationMs", {}).get("triggerExecution", 0),
        late,
        offsets,
        json.dumps(progress.get("observedMetrics", {}).get(QUALITY)),
    )


def observe_quality(df: DataFrame, columns: Sequence[str], rejected: Column | None = None) -> DataFrame:
    """Count rows, NULLs per column and rejected rows of a stream while it runs, without another
    scan; the progress of each batch carries the counts."""
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]]
    if rejected is not None:
        counts.append(F.count_if(rejected).alias("rejected"))
    return df.observe(QUALITY, *counts)


def observed_totals(progress: DataFrame) -> DataFrame:
    """(query, metric, total) over all batches, from the rows of ``follow_progress``."""
    counts = F.from_json("observed", "map<string, bigint>")
    return progress.select("query", F.explode(counts).alias("metric", "n")).groupBy("query", "metric").agg(F.sum("n").alias("total"))


def observed_null_rates(progress: DataFrame) -> DataFrame:
    """NULLs per column and their share of the rows, as ``operators.quality.null_rates`` gives them."""
    totals = observed_totals(progress)
    rows = totals.filter("metric = 'rows'").select("query", F.col("total").alias("rows"))
    nulls = totals.filter(F.col("metric").startswith("null_"))
    return nulls.join(rows, "query").select(
        F.expr("substring(metric, 6)").alias("column_name"), F.col("total").alias("null_count"),
        F.try_divide("total", "rows").alias("null_rate"),
    )


def follow_progress(
    spark: SparkSession, queries: list[StreamingQuery], path: str, poll_seconds: float = 0.5
) -> DataFrame:
    """Wait for the queries to end and append one row per batch to the table at ``path``.

    Spark keeps a bounded number of batches per query, so they are fetched while the queries
    run. If more than that number went by between two fetches, this raises instead of
    returning less. Returns the table, which may hold rows of earlier runs.
    """
    kept = int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    seen: list[set] = [set() for _ in queries]
    while True:
        running = any([q.isActive for q in queries])  # asked first, so that the last fetch is whole
        rows = []
        for i, q in enumerate(queries):
            recent = [json.loads(p.json) for p in q.recentProgress]
            names = [(p["batchId"], p["timestamp"]) for p in recent]
            if len(names) >= kept and names[0] not in seen[i]:
                raise RuntimeError(f"{q.name or q.id}: over {kept} batches between two fetches; fetch more often")
            rows += [_row(p) for p, name in zip(recent, names) if name not in seen[i]]
            seen[i] = set(names)
        if rows:
            spark.createDataFrame(rows, PROGRESS_DDL).coalesce(1).write.mode("append").parquet(path)
        if not running:
            break
        time.sleep(poll_seconds)
    for q in queries:
        q.awaitTermination()  # raises what ended the query
    spark.createDataFrame([], PROGRESS_DDL).write.mode("append").parquet(path)
    return spark.read.schema(PROGRESS_DDL).parquet(path)


def progress_summary(progress: DataFrame, trigger_ms: int) -> DataFrame:
    """Batches committed, rows read, latest offset, and whether any batch outlasted the trigger."""
    return progress.groupBy("query").agg(
        F.count("*").alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.max("batch_id").alias("last_batch"),
        F.max_by("end_offsets", "batch_id").alias("latest_offset"),
        F.sum("dropped_late_rows").alias("dropped_late_rows"),
        F.max(F.col("duration_ms") > trigger_ms).alias("falling_behind"),
    )
