"""Property graph as tables: nodes, edges, their JSON messages, and integrity checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapgraph.functions.scalars import composite_key
from lapgraph.operators.ordered import neighbour_row
from lapgraph.operators.parsing import resolve_interaction
from lapgraph.operators.profiles import (
    driver_profile, driver_session_span, lap_stats, session_summary,
)
from lapgraph.operators.selection import of_type, with_endpoints
from lapgraph.operators.skew import skew_join

# Property lists and identifying keys of the graph messages.
DRIVER_PROPS = [
    "driver_name", "first_session_id", "latest_session_id", "max_lap_seen",
    "avg_speed_kph", "max_speed_kph", "avg_battery_pct", "avg_fuel_mass_kg",
]
SESSION_PROPS = ["driver_count", "lap_count", "first_event_ts", "last_event_ts"]
TEAM_PROPS = ["name", "engine_supplier"]
LAP_PROPS = [
    "session_id", "driver_id", "lap_number", "avg_speed_kph", "max_speed_kph",
    "min_speed_kph", "avg_battery_pct", "avg_fuel_mass_kg", "last_event_ts",
]
DROVE_IN_PROPS = ["first_event_ts", "last_event_ts", "first_lap", "last_lap"]
COMPLETED_BY_PROPS = ["session_id", "lap_number", "avg_speed_kph", "last_event_ts"]
INTERACTION_PROPS = [
    "session_id", "event_id", "lap_number", "lap_count", "avg_gap_ms", "delta_time_ms",
    "event_ts_utc",
]
NODE_KEYS = {
    "Driver": "driver_id", "Session": "session_id", "Team": "team_id", "Lap": "lap_id",
    "Interaction": "interaction_id", "SectorComparison": "sector_comp_id",
    "Community": "community_id",
}


def node_message(nodes: DataFrame, label: str, key: str, ids: Sequence[Column], props: Sequence[str]) -> DataFrame:
    """``{key, value}`` with value = JSON of label, ids and properties (NULLs left out)."""
    body = F.struct(F.lit(label).alias("node_type"), *ids, F.struct(*props).alias("properties"))
    return nodes.select(F.col(key).alias("key"), F.to_json(body).alias("value"))


def edge_message(
    edges: DataFrame,
    relationship: str,
    key: Column,
    start: tuple[str, str],
    end: tuple[str, str],
    props: Sequence[str],
) -> DataFrame:
    def endpoint(label_and_column: tuple[str, str]) -> Column:
        label, column = label_and_column
        return F.struct(F.lit(label).alias("label"), F.col(column).alias("id"))

    body = F.struct(
        F.lit(relationship).alias("relationship_type"),
        endpoint(start).alias("start"),
        endpoint(end).alias("end"),
        F.struct(*props).alias("properties"),
    )
    return edges.select(key.alias("key"), F.to_json(body).alias("value"))


def driver_nodes(telemetry: DataFrame) -> DataFrame:
    ids = [F.col("driver_id"), F.col("latest_session_id").alias("session_id")]
    return node_message(driver_profile(telemetry), "Driver", "driver_id", ids, DRIVER_PROPS)


def session_nodes(telemetry: DataFrame, approximate: bool = True) -> DataFrame:
    return node_message(
        session_summary(telemetry, approximate), "Session", "session_id",
        [F.col("session_id")], SESSION_PROPS,
    )


def team_nodes(teams: DataFrame) -> DataFrame:
    return node_message(teams, "Team", "team_id", [F.col("team_id")], TEAM_PROPS)


def lap_nodes(telemetry: DataFrame) -> DataFrame:
    laps = lap_stats(telemetry).withColumnRenamed("event_ts", "last_event_ts")
    return node_message(laps, "Lap", "lap_id", [F.col("lap_id")], LAP_PROPS)


def drove_in_edges(telemetry: DataFrame) -> DataFrame:
    return edge_message(
        driver_session_span(telemetry), "DROVE_IN", F.col("edge_id"),
        ("Driver", "driver_id"), ("Session", "session_id"), DROVE_IN_PROPS,
    )


def completed_by_edges(telemetry: DataFrame) -> DataFrame:
    laps = lap_stats(telemetry).withColumnRenamed("event_ts", "last_event_ts")
    return edge_message(
        laps, "COMPLETED_BY", F.col("lap_id"), ("Lap", "lap_id"), ("Driver", "driver_id"),
        COMPLETED_BY_PROPS,
    )


def interactions_of(events: DataFrame, *relationships: str) -> DataFrame:
    """Events of the given types (any case) with both drivers known after the fallbacks,
    and their relation name ``rel``. One pass over the events for all types."""
    typed = of_type(events, *relationships).withColumn("rel", F.upper("event_type"))
    return with_endpoints(resolve_interaction(typed))


def interaction_edges(events: DataFrame, relationship: str) -> DataFrame:
    """One message per interaction event, keyed session:attacker:defender:lap."""
    key = composite_key("session_id", "attacker_id", "defender_id", "lap_number")
    return edge_message(
        interactions_of(events, relationship), relationship.upper(), key,
        ("Driver", "attacker_id"), ("Driver", "defender_id"), INTERACTION_PROPS,
    )


def edge_table(edges: DataFrame, rel: str, src_label: str, src: str, dst_label: str, dst: str) -> DataFrame:
    """Uniform (rel, src_label, src, dst_label, dst) view of any edge table."""
    return edges.select(
        F.lit(rel).alias("rel"),
        F.lit(src_label).alias("src_label"),
        F.col(src).cast("string").alias("src"),
        F.lit(dst_label).alias("dst_label"),
        F.col(dst).cast("string").alias("dst"),
    )


def repeated_ids(nodes: Mapping[str, DataFrame]) -> DataFrame:
    """Uniqueness check: ids that occur more than once under a label; empty when all is well."""
    ids = [
        table.select(F.lit(label).alias("label"), F.col(NODE_KEYS[label]).cast("string").alias("id"))
        for label, table in nodes.items()
    ]
    return (
        reduce(DataFrame.unionByName, ids)
        .groupBy("label", "id")
        .agg(F.count("*").alias("copies"))
        .filter("copies > 1")
    )


def dangling_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Referential check: per relation, how many edges miss their start or end node.

    ``edges`` is an edge table, ``nodes`` has unique (label, id). Edges are counted per end
    first, so a node with very many edges is one row when it is looked up.
    """
    ends = F.array(
        F.struct(F.lit("start").alias("side"), F.col("src_label").alias("label"), F.col("src").alias("id")),
        F.struct(F.lit("end").alias("side"), F.col("dst_label").alias("label"), F.col("dst").alias("id")),
    )
    counted = (
        edges.select("rel", F.explode(ends).alias("e"))
        .groupBy("rel", "e.side", "e.label", "e.id")
        .agg(F.count("*").alias("n"))
    )
    known = nodes.select("label", "id", F.lit(True).alias("_known"))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    missing = F.col("_known").isNull()
    return counted.join(known, ["label", "id"], "left").groupBy("rel").agg(
        total(F.col("side") == "start").alias("edges"),
        total((F.col("side") == "start") & missing).alias("missing_start"),
        total((F.col("side") == "end") & missing).alias("missing_end"),
    )


def faster_than_edges(laps: DataFrame, block_ms: int = 1000) -> DataFrame:
    """Per session, each driver to the next slower one by best lap, with the time between.

    The chain carries the whole order (a driver is faster than all later in the chain) with
    one edge per driver instead of one per pair.
    """
    best = (
        laps.filter("lap_time_ms IS NOT NULL")
        .groupBy("session_id", "driver_id")
        .agg(F.min("lap_time_ms").alias("best_ms"))
    )
    chained = neighbour_row(
        best, ["session_id"], "best_ms", ["driver_id", "best_ms"], block_ms, "_next",
        step=1, tie=["driver_id"],
    )
    return chained.filter("_next IS NOT NULL").select(
        "session_id",
        F.col("driver_id").alias("src"),
        F.col("_next.driver_id").alias("dst"),
        (F.col("_next.best_ms") - F.col("best_ms")).alias("time_delta_ms"),
    )


def same_community_edges(communities: DataFrame) -> DataFrame:
    """Each member to its community's first member (by id): linear in members, and two
    drivers share a community exactly when they share the hub."""
    hubs = communities.groupBy("community_id").agg(F.min("driver_id").alias("hub"))
    return skew_join(communities, hubs, ["community_id"]).select(
        F.col("driver_id").alias("src"), F.col("hub").alias("dst"), "community_id"
    )


def influenced_by_edges(edges: DataFrame, ranks: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Defender to attacker, weighted with the share of the attacker's rank that this edge
    passes on (rank / out-degree)."""
    src = [*keys, "src"]
    degree = edges.groupBy(*src).agg(F.count("*").alias("_deg"))
    share = (
        ranks.withColumnRenamed("id", "src")
        .join(degree, src)
        .select(*src, (F.col("pagerank_score") / F.col("_deg")).alias("influence_weight"))
    )
    return skew_join(edges, share, src).select(
        *keys, F.col("dst").alias("src"), F.col("src").alias("dst"), "influence_weight"
    )
