"""The analytic query library over node and edge tables.

Every top list is ordered by its measure and then by the keys, so it is the same on every
run.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapgraph.operators.communities import community_members
from lapgraph.operators.skew import skew_join


def _counted(rows: DataFrame, what: str, counts: Mapping[str, Column]) -> DataFrame:
    """(what, n) with one row per count, all from one pass over ``rows``."""
    one = rows.agg(*[count.alias(name) for name, count in counts.items()])
    return one.unpivot([], list(counts), what, "n").filter("n > 0")


def label_counts(laps: DataFrame, teams: DataFrame) -> DataFrame:
    """Nodes per label; ``laps`` (session_id, driver_id, lap_number) has each lap once."""
    found = _counted(laps, "label", {
        "Driver": F.count_distinct("driver_id"), "Session": F.count_distinct("session_id"), "Lap": F.count("*"),
    })
    return found.unionByName(_counted(teams, "label", {"Team": F.count("*")}))


def relation_counts(laps: DataFrame, interactions: DataFrame) -> DataFrame:
    """Edges per relation, from the laps and the interactions (rel)."""
    found = _counted(laps, "rel", {
        "DROVE_IN": F.count_distinct("session_id", "driver_id"), "COMPLETED_BY": F.count("*"),
    })
    return found.unionByName(interactions.groupBy("rel").agg(F.count("*").alias("n")))


def graph_statistics(laps: DataFrame, teams: DataFrame, interactions: DataFrame) -> DataFrame:
    """Every label's node count beside every relation's edge count; the laps are read once."""
    one = laps.agg(
        F.count_distinct("driver_id").alias("Driver"), F.count_distinct("session_id").alias("Session"),
        F.count("*").alias("Lap"), F.count_distinct("session_id", "driver_id").alias("DROVE_IN"),
    ).withColumn("COMPLETED_BY", F.col("Lap")).withColumn("Team", teams.agg(F.count("*")).scalar())
    kinds = interactions.groupBy("rel").agg(F.count("*").alias("n")).agg(F.collect_list(F.struct("rel", "n")).alias("_kinds"))
    entry = lambda name, as_: F.struct(F.lit(name).alias(as_), F.col(name).alias("n"))
    nodes = F.array(*[entry(name, "label") for name in ("Driver", "Session", "Lap", "Team")])
    own = F.array(*[entry(name, "rel") for name in ("DROVE_IN", "COMPLETED_BY")])
    both = one.withColumn("_kinds", kinds.scalar()).select(
        F.explode(nodes).alias("node"), F.concat(own, F.col("_kinds").cast("array<struct<rel: string, n: bigint>>")).alias("rels")
    )
    return both.select("node", F.explode("rels").alias("edge")).select(
        "node.label", F.col("node.n").alias("node_count"), "edge.rel", F.col("edge.n").alias("rel_count")
    ).filter("node_count > 0 AND rel_count > 0")


def top(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def fastest_drivers(drivers: DataFrame, n: int = 10) -> DataFrame:
    ranked = drivers.filter("max_speed_kph IS NOT NULL")
    return top(ranked, n, [F.desc("max_speed_kph"), F.asc("driver_id")]).select(
        "driver_id", "driver_name", "avg_speed_kph", "max_speed_kph", "max_lap_seen"
    )


def recent_sessions(sessions: DataFrame, n: int = 5) -> DataFrame:
    return top(sessions, n, [F.desc("last_event_ts"), F.asc("session_id")])


def _named(df: DataFrame, drivers: DataFrame, column: str, name: str) -> DataFrame:
    names = drivers.select(F.col("driver_id").alias(column), F.col("driver_name").alias(name))
    return df.join(names, column)


def _known(edges: DataFrame, drivers: DataFrame, column: str) -> DataFrame:
    return skew_join(edges, drivers.select(F.col("driver_id").alias(column)), [column], "left_semi")


def lap_statistics(laps: DataFrame, drivers: DataFrame, n: int = 10) -> DataFrame:
    """Laps, average lap speed and top speed per driver, most laps first."""
    totals = laps.groupBy("driver_id").agg(
        F.count("*").alias("lap_count"),
        F.avg("avg_speed_kph").alias("avg_lap_speed"),
        F.max("max_speed_kph").alias("fastest_speed"),
    )
    return top(_named(totals, drivers, "driver_id", "driver_name"), n, [F.desc("lap_count"), F.asc("driver_id")])


def driver_sessions(spans: DataFrame, drivers: DataFrame, sessions: DataFrame, n: int = 10) -> DataFrame:
    """Driver-session pairs by their last event."""
    known = spans.join(sessions.select("session_id"), "session_id", "left_semi")
    newest = top(
        _known(known, drivers, "driver_id"), n,
        [F.desc("last_event_ts"), F.asc("driver_id"), F.asc("session_id")],
    )
    return _named(newest, drivers, "driver_id", "driver_name").select(
        "driver_id", "driver_name", "session_id", "first_lap", "last_lap", "first_event_ts"
    )


def fastest_laps(laps: DataFrame, drivers: DataFrame, n: int = 10) -> DataFrame:
    known = _known(laps.filter("avg_speed_kph IS NOT NULL"), drivers, "driver_id")
    best = top(known, n, [F.desc("max_speed_kph"), F.asc("lap_id")])
    return _named(best, drivers, "driver_id", "driver_name").select(
        "lap_id", "driver_id", "driver_name", "lap_number", "avg_speed_kph", "max_speed_kph"
    )


def _both_known(edges: DataFrame, drivers: DataFrame) -> DataFrame:
    """Edges whose two drivers are known."""
    for column in ("attacker_id", "defender_id"):
        ids = drivers.select(F.col("driver_id").alias(column))
        edges = skew_join(edges, ids, [column], "left_semi")
    return edges


def _both_named(few: DataFrame, drivers: DataFrame) -> DataFrame:
    """The names of both drivers beside few edges."""
    for column, name in (("attacker_id", "attacker"), ("defender_id", "defender")):
        names = drivers.select(F.col("driver_id").alias(column), F.col("driver_name").alias(name))
        few = skew_join(few, names, [column])
    return few


def recent_overtakes(edges: DataFrame, drivers: DataFrame, n: int = 10) -> DataFrame:
    wanted = edges.select(
        "attacker_id", "defender_id", "session_id", "lap_number", "event_ts", "event_id"
    )
    best = top(_both_known(wanted, drivers), n, [F.desc("event_ts"), F.asc("event_id")])
    return _both_named(best, drivers).drop("event_id")


def longest_battles(edges: DataFrame, drivers: DataFrame, n: int = 10) -> DataFrame:
    """Battles of unknown length come first, as missing values do in a descending order."""
    wanted = edges.select(
        "attacker_id", "defender_id", "session_id", "lap_number", "lap_count", "event_id"
    )
    order = [F.desc_nulls_first("lap_count"), F.asc("event_id")]
    return _both_named(top(_both_known(wanted, drivers), n, order), drivers).drop("event_id")


def interaction_summary(edges: DataFrame, drivers: DataFrame, n: int = 20) -> DataFrame:
    """Occurrences per ordered pair and type. Over the event table these are all events; over
    the latest-per-pair table every pair counts once."""
    counts = edges.groupBy("rel", "attacker_id", "defender_id").agg(F.count("*").alias("occurrences"))
    best = top(
        _both_known(counts, drivers), n,
        [F.desc("occurrences"), F.asc("rel"), F.asc("attacker_id"), F.asc("defender_id")],
    )
    return _both_named(best, drivers).select("attacker_id", "attacker", "rel", "defender_id", "defender", "occurrences")


def sample_node(nodes: DataFrame, key: str) -> DataFrame:
    """The node with the smallest key."""
    return top(nodes, 1, [F.asc(key)])


def most_influential(ranks: DataFrame, communities: DataFrame, n: int = 10) -> DataFrame:
    scored = ranks.select(F.col("id").alias("driver_id"), "pagerank_score")
    best = top(scored.filter("pagerank_score IS NOT NULL"), n, [F.desc("pagerank_score"), F.asc("driver_id")])
    return best.join(communities.select("driver_id", "community_id"), "driver_id", "left")


def members_by_community(communities: DataFrame) -> DataFrame:
    """Members, largest community first, one row per member."""
    return community_members(communities).orderBy(F.desc("member_count"), "community_id", "driver_id")


def community_profiles(communities: DataFrame, drivers: DataFrame) -> DataFrame:
    """Member rows with community size and the average of the members' average speeds."""
    speeds = communities.select("community_id", "driver_id").distinct().join(
        drivers.select("driver_id", "avg_speed_kph"), "driver_id"
    )
    totals = speeds.groupBy("community_id").agg(
        F.count("*").alias("member_count"), F.avg("avg_speed_kph").alias("avg_speed")
    )
    return skew_join(speeds.drop("avg_speed_kph"), totals, ["community_id"]).orderBy(
        F.desc("member_count"), "community_id", "driver_id"
    )


def similar_drivers(communities: DataFrame, ranks: DataFrame, drivers: DataFrame, driver_id: str) -> DataFrame:
    """Other members of the driver's communities, by rank."""
    members = communities.select("community_id", "driver_id").distinct()
    own = members.filter(F.col("driver_id") == driver_id).select("community_id")
    others = (
        skew_join(members, own, ["community_id"], "left_semi")
        .filter(F.col("driver_id") != driver_id)
        .select("driver_id")
        .distinct()
    )
    scores = ranks.select(F.col("id").alias("driver_id"), "pagerank_score")
    return (
        others.join(drivers.select("driver_id", "avg_speed_kph"), "driver_id")
        .join(scores, "driver_id", "left")
        .orderBy(F.desc("pagerank_score"), "driver_id")
    )


def overtake_leaders(edges: DataFrame, n: int = 10) -> DataFrame:
    made = edges.groupBy(F.col("attacker_id").alias("driver_id")).agg(F.count("*").alias("overtakes"))
    return top(made, n, [F.desc("overtakes"), F.asc("driver_id")])


def rivalries(edges: DataFrame, n: int = 10) -> DataFrame:
    """Unordered pairs with most battles."""
    a, b = F.col("attacker_id"), F.col("defender_id")
    pairs = edges.groupBy(F.least(a, b).alias("driver_a"), F.greatest(a, b).alias("driver_b")).agg(
        F.count("*").alias("battles")
    )
    return top(pairs, n, [F.desc("battles"), F.asc("driver_a"), F.asc("driver_b")])


def team_heatmap(edges_with_teams: DataFrame) -> DataFrame:
    """Interactions per attacking and defending team, as (row, column, value) cells."""
    return edges_with_teams.groupBy("attacker_team", "defender_team").agg(
        F.count("*").alias("interactions")
    )


def session_leaderboard(laps: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` fastest drivers of every session by best lap (ties by id)."""
    best = (
        laps.filter("lap_time_ms IS NOT NULL")
        .groupBy("session_id", "driver_id")
        .agg(F.min("lap_time_ms").alias("best_ms"))
    )
    order = Window.partitionBy("session_id").orderBy("best_ms", "driver_id")
    return best.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)
