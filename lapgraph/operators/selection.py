"""Row filters, selections and validity rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_ids(df: DataFrame, ids: Sequence[str] = ("session_id", "driver_id")) -> DataFrame:
    return df.dropna(subset=list(ids))


def valid_laps(df: DataFrame) -> DataFrame:
    """Lap 0 (no enclosing lap) counts as valid."""
    return df.filter(F.col("lap_number") >= 0)


def of_type(events: DataFrame, *event_types: str) -> DataFrame:
    """Rows of the given event types, in any case."""
    return events.filter(F.lower("event_type").isin(*[t.lower() for t in event_types]))


def with_endpoints(interactions: DataFrame) -> DataFrame:
    return interactions.dropna(subset=["attacker_id", "defender_id"])


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def named_drivers(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["driver_id", "driver_name"])


def select_sessions(
    sessions: DataFrame,
    years: tuple[int, int] | None = None,
    event: int | str | None = None,
    session_names: Sequence[str] | None = None,
) -> DataFrame:
    """Year range, round number or part of the event name in any case, session types."""
    picked = sessions
    if years is not None:
        picked = picked.filter(F.col("year").between(*years))
    if isinstance(event, int):
        picked = picked.filter(F.col("round_number") == event)
    elif event is not None:
        picked = picked.filter(F.contains(F.lower("event_name"), F.lit(event.lower())))
    if session_names is not None:
        picked = picked.filter(F.col("session_name").isin(*session_names))
    return picked


def only_driver(df: DataFrame, driver_id: str | None) -> DataFrame:
    return df if driver_id is None else df.filter(F.col("driver_id") == driver_id)


def every_nth(df: DataFrame, n: int, sequence: str = "sequence_number") -> DataFrame:
    """Systematic sample: positions divisible by ``n``; 1 keeps all rows."""
    return df if n <= 1 else df.filter(F.col(sequence) % n == 0)


def first_per_group(df: DataFrame, n: int, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """At most ``n`` rows per group. Spark trims each group to n rows before its shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= n).drop("_rn")


def telemetry_rules(max_speed: float, max_abs_lat: float, max_abs_lon: float) -> dict[str, Column]:
    """Named conditions that make a sample invalid."""
    return {
        "null_session": F.col("session_id").isNull(),
        "negative_speed": F.col("speed_kph") < 0,
        "impossible_speed": F.col("speed_kph") > max_speed,
        "impossible_gps": (F.abs("gps_lat") > max_abs_lat) | (F.abs("gps_lon") > max_abs_lon),
    }


def apply_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Keep the rows that break no rule."""
    broken = reduce(lambda a, b: a | b, [F.coalesce(r, F.lit(False)) for r in rules.values()])
    return df.filter(~broken)


def reject_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule with the number of rows that break it, from one pass."""
    counts = df.agg(*[F.count_if(cond).alias(name) for name, cond in rules.items()])
    return counts.unpivot([], list(rules), "rule", "rejected")
