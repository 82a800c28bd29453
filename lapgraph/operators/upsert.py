"""Node and edge upserts as joins, and mergeable running aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapgraph.operators.skew import skew_join

MODES = ("set", "merge", "keep", "update")


def latest_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order``; the rest of the row breaks ties."""
    rest = [c for c in batch.columns if c not in keys]
    ranked = F.struct(*order, *[c for c in rest if c not in order])
    return batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), ranked).alias("_row")).select(
        *keys, "_row.*"
    )


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], mode: str = "merge") -> DataFrame:
    """Apply a batch (one row per key) to a node table.

    set, merge: insert missing keys; columns of the batch replace the old ones, NULL too.
    keep: the same, but a NULL in the batch keeps the old value.
    update: like set, without inserting keys.
    Columns the batch does not have are kept; replaying a batch changes nothing.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    incoming = [c for c in new.columns if c not in keys]
    added = [c for c in incoming if c not in old.columns]
    staged = new.select(
        *keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in incoming]
    )
    joined = old.join(staged, list(keys), "left" if mode == "update" else "full")

    def merged(column: str) -> Column:
        if column not in incoming:
            return F.col(column)
        fresh = F.col(f"_new_{column}")
        if column in added:
            return fresh.alias(column)
        if mode == "keep":
            return F.coalesce(fresh, F.col(column)).alias(column)
        return F.when(F.col("_hit"), fresh).otherwise(F.col(column)).alias(column)

    rest = [c for c in old.columns if c not in keys] + added
    return joined.select(*keys, *[merged(c) for c in rest])


def upsert_edges(
    old: DataFrame, new: DataFrame, nodes: DataFrame, order: Sequence[str]
) -> DataFrame:
    """Keep one edge per (rel, src, dst): the latest event whose two end nodes exist.

    ``nodes`` has a unique ``id`` column.
    """
    keys = ["rel", "src", "dst"]
    latest = latest_per_key(new, keys, order)
    anchored = skew_join(latest, nodes.select(F.col("id").alias("src")), ["src"], "left_semi")
    anchored = skew_join(anchored, nodes.select(F.col("id").alias("dst")), ["dst"], "left_semi")
    return upsert(old, anchored, keys, "merge")


LAP = ["session_id", "driver_id", "lap_number"]
MEASURES = ["speed_kph", "battery_pct", "fuel_mass_kg"]


def lap_partials(telemetry: DataFrame, sketch_of: str | None = "sequence_number") -> DataFrame:
    """Mergeable lap aggregates of one batch: counts, sums, extremes, time span, sketch."""
    columns: list[Column] = [F.count("*").alias("samples")]
    for m in MEASURES:
        columns += [
            F.sum(m).alias(f"sum_{m}"),
            F.count(m).alias(f"n_{m}"),
            F.min(m).alias(f"min_{m}"),
            F.max(m).alias(f"max_{m}"),
        ]
    columns += [F.min("event_ts").alias("first_event_ts"), F.max("event_ts").alias("last_event_ts")]
    if sketch_of:
        columns.append(F.hll_sketch_agg(sketch_of, F.lit(12)).alias("sketch"))
    return telemetry.groupBy(*LAP).agg(*columns)


def merge_partials(partials: DataFrame, keys: Sequence[str] = LAP) -> DataFrame:
    """Combine partials of any batches; ``keys`` coarser than a lap give roll-ups."""
    columns: list[Column] = [F.sum("samples").alias("samples")]
    for m in MEASURES:
        columns += [
            F.sum(f"sum_{m}").alias(f"sum_{m}"),
            F.sum(f"n_{m}").alias(f"n_{m}"),
            F.min(f"min_{m}").alias(f"min_{m}"),
            F.max(f"max_{m}").alias(f"max_{m}"),
        ]
    columns += [
        F.min("first_event_ts").alias("first_event_ts"),
        F.max("last_event_ts").alias("last_event_ts"),
    ]
    if "sketch" in partials.columns:
        columns.append(F.hll_union_agg("sketch").alias("sketch"))
    return partials.groupBy(*keys).agg(*columns)


def finish_partials(merged: DataFrame) -> DataFrame:
    """Averages and the sketch estimate of merged partials."""
    done = merged.withColumns(
        {f"avg_{m}": F.try_divide(f"sum_{m}", f"n_{m}") for m in MEASURES}
    )
    if "sketch" in merged.columns:
        done = done.withColumn("approx_distinct", F.hll_sketch_estimate("sketch")).drop("sketch")
    return done


def last_batch(partials: DataFrame, keys: Sequence[str], batch: str = "batch") -> DataFrame:
    """Per key only the partials of its newest batch (overwriting instead of adding up)."""
    newest = partials.groupBy(*keys).agg(F.max(batch).alias(batch))
    return partials.join(newest, [*keys, batch], "left_semi")
