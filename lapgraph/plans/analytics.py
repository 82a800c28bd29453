"""The analytic queries over the graph built from the given tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from lapgraph.operators import analytics, facts, graph, pagerank as pr, profiles
from lapgraph.operators.interactions import overtakes
from lapgraph.operators.skew import skew_join
from lapgraph.operators.upsert import LAP, lap_partials, upsert_edges
from lapgraph.plans.aggregates import LAP_STATS, SESSION
from lapgraph.plans.detection import OVERTAKES
from lapgraph.plans.graphs import (
    COMMUNITY_SQL, driver_communities, interaction_events, pagerank_sql,
)
from lapgraph.plans.registry import query


class Graph:
    """Node and edge tables; the drivers' names come from their named samples."""

    def __init__(self, fx):
        self.fx = fx

    @cached_property
    def drivers(self):
        names = profiles.driver_graph_profile(self.fx.telemetry).select("driver_id", "driver_name")
        return profiles.driver_stats(self.fx.telemetry).join(names, "driver_id", "left")

    @cached_property
    def sessions(self):
        return profiles.session_summary(self.fx.telemetry, approximate=False)

    @cached_property
    def laps(self):
        return profiles.lap_stats(self.fx.telemetry)

    @cached_property
    def drove_in(self):
        return profiles.driver_session_span(self.fx.telemetry)

    @cached_property
    def interactions(self):
        return interaction_events(self.fx)

    def of(self, rel):
        return self.interactions.filter(F.col("rel") == rel)

    @cached_property
    def lap_keys(self):
        """Each lap once, as the lap aggregates have it."""
        return lap_partials(self.fx.telemetry, sketch_of=None).select(*LAP)


NODE_COUNTS = """
    SELECT 'Driver' AS label, count(DISTINCT driver_id) AS n FROM telemetry
    UNION ALL SELECT 'Session', count(DISTINCT session_id) FROM telemetry
    UNION ALL SELECT 'Lap', count(DISTINCT (session_id, driver_id, lap_number)) FROM telemetry
    UNION ALL SELECT 'Team', count(*) FROM teams
"""
EDGE_COUNTS = """
    SELECT 'DROVE_IN' AS rel, count(DISTINCT (session_id, driver_id)) AS n FROM telemetry
    UNION ALL SELECT 'COMPLETED_BY', count(DISTINCT (session_id, driver_id, lap_number)) FROM telemetry
    UNION ALL SELECT rel, count(*) FROM edges GROUP BY rel
"""


@query("GQ1_node_counts", NODE_COUNTS)
def node_counts(fx):
    return analytics.label_counts(Graph(fx).lap_keys, fx.teams).orderBy(F.desc("n"), "label")


@query("GQ2_relation_counts", EDGE_COUNTS)
def relation_counts(fx):
    g = Graph(fx)
    return analytics.relation_counts(g.lap_keys, g.interactions).orderBy(F.desc("n"), "rel")


NAMES = "SELECT driver_id, min(driver_name) AS driver_name FROM telemetry GROUP BY driver_id"


@query("GQ3_fastest_drivers", """
    SELECT driver_id, min(driver_name) AS driver_name, round(avg(speed_kph), 6) AS avg_speed_kph,
           CAST(max(speed_kph) AS BIGINT) AS max_speed_kph, max(lap_number) AS max_lap_seen
    FROM telemetry GROUP BY driver_id ORDER BY max(speed_kph) DESC, driver_id LIMIT 10
""")
def fastest_drivers(fx):
    return analytics.fastest_drivers(Graph(fx).drivers)


@query("GQ4_recent_sessions", f"SELECT * FROM ({SESSION}) s ORDER BY last_event_ts DESC, session_id LIMIT 5")
def recent_sessions(fx):
    return analytics.recent_sessions(Graph(fx).sessions)


@query("GQ5_lap_statistics", f"""
    SELECT l.driver_id, n.driver_name, lap_count, avg_lap_speed, fastest_speed FROM (
        SELECT driver_id, count(*) AS lap_count, round(avg(s), 6) AS avg_lap_speed,
               CAST(max(m) AS BIGINT) AS fastest_speed
        FROM (SELECT driver_id, avg(speed_kph) AS s, max(speed_kph) AS m FROM telemetry
              GROUP BY session_id, driver_id, lap_number) x GROUP BY driver_id) l
    JOIN ({NAMES}) n ON n.driver_id = l.driver_id ORDER BY lap_count DESC, l.driver_id LIMIT 10
""")
def lap_statistics(fx):
    g = Graph(fx)
    return analytics.lap_statistics(g.laps, g.drivers)


@query("GQ6_driver_sessions", f"""
    SELECT s.driver_id, n.driver_name, session_id, first_lap, last_lap, first_event_ts FROM (
        SELECT session_id, driver_id, min(lap_number) AS first_lap, max(lap_number) AS last_lap,
               min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts
        FROM telemetry GROUP BY session_id, driver_id) s
    JOIN ({NAMES}) n ON n.driver_id = s.driver_id ORDER BY last_event_ts DESC, s.driver_id, session_id LIMIT 10
""")
def driver_sessions(fx):
    g = Graph(fx)
    return analytics.driver_sessions(g.drove_in, g.drivers, g.sessions)


FASTEST_LAPS = f"""
    SELECT lap_id, l.driver_id, n.driver_name, lap_number, avg_speed_kph, max_speed_kph
    FROM ({LAP_STATS}) l JOIN ({NAMES}) n ON n.driver_id = l.driver_id
    ORDER BY max_speed_kph DESC, lap_id LIMIT 10
"""


@query("GQ7_fastest_laps", FASTEST_LAPS)
def fastest_laps(fx):
    g = Graph(fx)
    return analytics.fastest_laps(g.laps, g.drivers)


@query("TOP4_top_k", f"SELECT lap_id, max_speed_kph FROM ({FASTEST_LAPS}) l")
def top_k(fx):
    return analytics.top(Graph(fx).laps, 10, [F.desc("max_speed_kph"), F.asc("lap_id")]).select(
        "lap_id", "max_speed_kph"
    )


NAMED_EDGES = f"""
    SELECT e.*, a.driver_name AS attacker, d.driver_name AS defender FROM edges e
    JOIN ({NAMES}) a ON a.driver_id = e.attacker_id JOIN ({NAMES}) d ON d.driver_id = e.defender_id
"""


@query("GQ8_recent_overtakes", f"""
    SELECT attacker_id, attacker, defender_id, defender, session_id, lap_number, event_ts FROM ({NAMED_EDGES}) e
    WHERE rel = 'OVERTAKE' ORDER BY event_ts DESC, event_id LIMIT 10
""")
def recent_overtakes(fx):
    g = Graph(fx)
    return analytics.recent_overtakes(g.of("OVERTAKE"), g.drivers)


@query("GQ9_longest_battles", f"""
    SELECT attacker_id, attacker, defender_id, defender, session_id, lap_number, lap_count FROM ({NAMED_EDGES}) e
    WHERE rel = 'BATTLE' ORDER BY lap_count DESC NULLS FIRST, event_id LIMIT 10
""")
def longest_battles(fx):
    g = Graph(fx)
    return analytics.longest_battles(g.of("BATTLE"), g.drivers)


def _summary(occurrences: str) -> str:
    return f"""
        SELECT attacker_id, attacker, rel, defender_id, defender, {occurrences} AS occurrences
        FROM ({NAMED_EDGES}) e GROUP BY attacker_id, attacker, rel, defender_id, defender
        ORDER BY occurrences DESC, rel, attacker_id, defender_id LIMIT 20
    """


@query("GQ10_interaction_summary", _summary("count(*)"))
def interaction_summary(fx):
    g = Graph(fx)
    return analytics.interaction_summary(g.interactions, g.drivers)


@query("GQ10_latest_edge_summary", _summary("1::BIGINT"))
def latest_edge_summary(fx):
    g = Graph(fx)
    events = g.interactions.select(
        "rel", F.col("attacker_id").alias("src"), F.col("defender_id").alias("dst"), "event_id", "event_ts"
    )
    nodes = g.drivers.select(F.col("driver_id").alias("id"))
    latest = upsert_edges(events.filter("false"), events, nodes, ["event_ts"])
    return analytics.interaction_summary(
        latest.withColumnsRenamed({"src": "attacker_id", "dst": "defender_id"}), g.drivers
    )


@query("GQ11_graph_statistics", f"""
    SELECT label, n.n AS node_count, rel, r.n AS rel_count FROM ({NODE_COUNTS}) n, ({EDGE_COUNTS}) r
""")
def graph_statistics(fx):
    g = Graph(fx)
    return analytics.graph_statistics(g.lap_keys, fx.teams, g.interactions)


@query("GQ12a_sample_driver", """
    SELECT driver_id, max(lap_number) AS max_lap_seen, CAST(max(speed_kph) AS BIGINT) AS max_speed_kph
    FROM telemetry GROUP BY driver_id ORDER BY driver_id LIMIT 1
""")
def sample_driver(fx):
    return analytics.sample_node(Graph(fx).drivers, "driver_id").select(
        "driver_id", "max_lap_seen", "max_speed_kph"
    )


@query("GQ12b_sample_session", f"SELECT * FROM ({SESSION}) s ORDER BY session_id LIMIT 1")
def sample_session(fx):
    return analytics.sample_node(Graph(fx).sessions, "session_id")


@query("GQ12c_sample_lap", f"SELECT * FROM ({LAP_STATS}) l ORDER BY lap_id LIMIT 1")
def sample_lap(fx):
    return analytics.sample_node(Graph(fx).laps, "lap_id")


@query("GQ12d_sample_team", "SELECT * FROM teams ORDER BY team_id LIMIT 1")
def sample_team(fx):
    return analytics.sample_node(fx.teams, "team_id")


@query("JN8_pattern_matches", """
    SELECT l.session_id, l.driver_id, count(*) AS laps, any_value(t.name) AS team_name
    FROM (SELECT DISTINCT session_id, driver_id, lap_number FROM telemetry) l
    JOIN drivers d ON d.driver_id = l.driver_id JOIN teams t ON t.team_id = d.team_id
    GROUP BY l.session_id, l.driver_id
""")
def pattern_matches(fx):
    """Lap to driver to team, and lap to session."""
    g = Graph(fx)
    people = fx.drivers.join(fx.teams.select("team_id", F.col("name").alias("team_name")), "team_id")
    matched = skew_join(g.laps, people.select("driver_id", "team_name"), ["driver_id"]).join(
        g.sessions.select("session_id"), "session_id"
    )
    return matched.groupBy("session_id", "driver_id").agg(
        F.count("*").alias("laps"), F.min("team_name").alias("team_name")
    )


DRIVER_GRAPH = "SELECT DISTINCT attacker_id AS src, defender_id AS dst FROM edges"
# A driver's community is that of the last session by name.
DRIVER_COMMUNITY = f"SELECT driver_id, arg_max(community_id, session_id) AS community_id FROM ({COMMUNITY_SQL}) c GROUP BY driver_id"


def _ranks(fx):
    edges = interaction_events(fx).select(
        F.col("attacker_id").alias("src"), F.col("defender_id").alias("dst")
    ).distinct()
    return pr.pagerank(None, edges)


def _communities(fx):
    return driver_communities(fx).groupBy("driver_id").agg(
        F.max_by("community_id", "session_id").alias("community_id")
    )


@query("GQ13_most_influential", f"""
    SELECT r.id AS driver_id, r.pagerank_score, c.community_id
    FROM ({pagerank_sql(DRIVER_GRAPH)}) r LEFT JOIN ({DRIVER_COMMUNITY}) c ON c.driver_id = r.id
    ORDER BY r.pagerank_score DESC, r.id LIMIT 10
""")
def most_influential(fx):
    return analytics.most_influential(_ranks(fx), _communities(fx))


@query("GQ14_community_members", f"""
    SELECT community_id, driver_id, count(*) OVER (PARTITION BY community_id) AS member_count
    FROM ({DRIVER_COMMUNITY}) c
""")
def community_members(fx):
    return analytics.members_by_community(_communities(fx))


@query("GQ15_community_profiles", f"""
    SELECT community_id, c.driver_id, count(*) OVER w AS member_count, round(avg(s.avg_speed) OVER w, 6) AS avg_speed
    FROM ({DRIVER_COMMUNITY}) c JOIN (SELECT driver_id, avg(speed_kph) AS avg_speed FROM telemetry GROUP BY driver_id) s
      ON s.driver_id = c.driver_id WINDOW w AS (PARTITION BY community_id)
""")
def community_profiles(fx):
    return analytics.community_profiles(_communities(fx), Graph(fx).drivers)


@query("GQ16_similar_drivers", f"""
    WITH ranks AS MATERIALIZED ({pagerank_sql(DRIVER_GRAPH)}), comm AS MATERIALIZED ({DRIVER_COMMUNITY})
    SELECT c.driver_id, round(s.avg_speed, 6) AS avg_speed_kph, r.pagerank_score
    FROM comm c JOIN (SELECT driver_id, avg(speed_kph) AS avg_speed FROM telemetry GROUP BY driver_id) s ON s.driver_id = c.driver_id
    LEFT JOIN ranks r ON r.id = c.driver_id
    WHERE c.community_id = (SELECT community_id FROM comm WHERE driver_id = 'D07') AND c.driver_id <> 'D07'
""")
def similar_drivers(fx):
    return analytics.similar_drivers(_communities(fx), _ranks(fx), Graph(fx).drivers, "D07")


@query("GQ17_overtake_leaders", f"""
    SELECT attacker_id AS driver_id, count(*) AS overtakes FROM ({OVERTAKES}) o
    GROUP BY attacker_id ORDER BY overtakes DESC, driver_id LIMIT 10
""")
def overtake_leaders(fx):
    return analytics.overtake_leaders(overtakes(fx.laps))


@query("GQ17_rivalries", """
    SELECT least(attacker_id, defender_id) AS driver_a, greatest(attacker_id, defender_id) AS driver_b, count(*) AS battles
    FROM edges WHERE rel = 'BATTLE' GROUP BY ALL ORDER BY battles DESC, driver_a, driver_b LIMIT 10
""")
def rivalries(fx):
    return analytics.rivalries(graph.interactions_of(fx.interactions, "battle"))


@query("GQ17_team_heatmap", """
    SELECT a.team_id AS attacker_team, d.team_id AS defender_team, count(*) AS interactions
    FROM edges e LEFT JOIN drivers a ON a.driver_id = e.attacker_id LEFT JOIN drivers d ON d.driver_id = e.defender_id
    GROUP BY ALL
""")
def team_heatmap(fx):
    return analytics.team_heatmap(facts.with_teams(interaction_events(fx), fx.drivers))


@query("GQ17_session_leaderboard", """
    SELECT session_id, driver_id, best_ms, place FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY session_id ORDER BY best_ms, driver_id) AS INT) AS place FROM (
            SELECT session_id, driver_id, min(lap_time_ms) AS best_ms FROM laps WHERE lap_time_ms IS NOT NULL
            GROUP BY session_id, driver_id) b) r
    WHERE place <= 10
""")
def session_leaderboard(fx):
    return analytics.session_leaderboard(fx.laps)
