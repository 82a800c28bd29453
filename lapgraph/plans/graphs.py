"""Graph messages, integrity checks, PageRank, communities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapgraph.operators import communities, graph, pagerank as pr, profiles
from lapgraph.operators.skew import skew_join
from lapgraph.plans.aggregates import LAP_STATS, SESSION
from lapgraph.plans.registry import query
from lapgraph.session import scratch_path
from lapgraph.sources.sinks import write_messages


def _node(messages: DataFrame, props: str) -> DataFrame:
    fields = ", ".join(p.strip().replace(" ", ": ") for p in props.split(","))
    body = F.from_json("value", f"node_type string, properties struct<{fields}>")
    return messages.select("key", body.alias("m")).select("key", "m.node_type", "m.properties.*")


def _edge(messages: DataFrame, props: str) -> DataFrame:
    fields = ", ".join(p.strip().replace(" ", ": ") for p in props.split(","))
    end = "struct<label: string, id: string>"
    body = F.from_json(
        "value", f"relationship_type string, start {end}, `end` {end}, properties struct<{fields}>"
    )
    return messages.select("key", body.alias("m")).select(
        "key", "m.relationship_type", F.col("m.start.id").alias("start_id"),
        F.col("m.end.id").alias("end_id"), "m.properties.*",
    )


@query("GR1_driver_nodes", """
    SELECT driver_id AS key, 'Driver' AS node_type, max(lap_number) AS max_lap_seen,
           round(avg(speed_kph), 6) AS avg_speed_kph, CAST(max(speed_kph) AS BIGINT) AS max_speed_kph,
           arg_max(session_id, sequence_number) AS latest_session_id
    FROM telemetry GROUP BY driver_id
""")
def driver_nodes(fx):
    return _node(
        graph.driver_nodes(fx.telemetry),
        "max_lap_seen int, avg_speed_kph double, max_speed_kph bigint, latest_session_id string",
    )


@query("GR2_session_nodes", f"""
    SELECT session_id AS key, 'Session' AS node_type, driver_count, lap_count, strftime(first_event_ts, '%Y-%m-%d') AS first_day
    FROM ({SESSION}) s
""")
def session_nodes(fx):
    nodes = _node(
        graph.session_nodes(fx.telemetry, approximate=False),
        "driver_count bigint, lap_count bigint, first_event_ts string",
    )
    return nodes.withColumn("first_day", F.substring("first_event_ts", 1, 10)).drop("first_event_ts")


@query("GR3_team_nodes", "SELECT CAST(team_id AS STRING) AS key, 'Team' AS node_type, name, engine_supplier FROM teams")
def team_nodes(fx):
    nodes = _node(graph.team_nodes(fx.teams), "name string, engine_supplier string")
    return nodes.withColumn("key", F.col("key").cast("string"))


@query("GR4_lap_nodes", f"""
    SELECT lap_id AS key, 'Lap' AS node_type, session_id, driver_id, lap_number, avg_speed_kph, min_speed_kph
    FROM ({LAP_STATS}) l
""")
def lap_nodes(fx):
    return _node(
        graph.lap_nodes(fx.telemetry),
        "session_id string, driver_id string, lap_number int, avg_speed_kph double, min_speed_kph bigint",
    )


@query("GR5_drove_in_edges", """
    SELECT concat(session_id, ':', driver_id) AS key, 'DROVE_IN' AS relationship_type, driver_id AS start_id,
           session_id AS end_id, min(lap_number) AS first_lap, max(lap_number) AS last_lap
    FROM telemetry GROUP BY session_id, driver_id
""")
def drove_in_edges(fx):
    return _edge(graph.drove_in_edges(fx.telemetry), "first_lap int, last_lap int")


@query("GR6_completed_by_edges", f"""
    SELECT lap_id AS key, 'COMPLETED_BY' AS relationship_type, lap_id AS start_id, driver_id AS end_id,
           session_id, lap_number, avg_speed_kph FROM ({LAP_STATS}) l
""")
def completed_by_edges(fx):
    return _edge(
        graph.completed_by_edges(fx.telemetry), "session_id string, lap_number int, avg_speed_kph double"
    )


def _interaction_check(rel: str) -> str:
    return f"""
        SELECT concat(session_id, ':', attacker_id, ':', defender_id, ':', CAST(lap_number AS STRING)) AS key,
               '{rel}' AS relationship_type, attacker_id AS start_id, defender_id AS end_id, event_id,
               lap_number, lap_count, round(CAST(avg_gap_ms AS DOUBLE), 6) AS avg_gap_ms
        FROM edges WHERE rel = '{rel}'
    """


def _messages(fx, rel: str) -> DataFrame:
    events = fx.interactions.withColumn("event_ts_utc", F.col("event_ts").cast("string"))
    return _edge(
        graph.interaction_edges(events, rel),
        "event_id bigint, lap_number int, lap_count int, avg_gap_ms double",
    )


@query("GR7_overtake_edges", _interaction_check("OVERTAKE"))
def overtake_edges(fx):
    return _messages(fx, "overtake")


@query("GR7_battle_edges", _interaction_check("BATTLE"))
def battle_edges(fx):
    return _messages(fx, "battle")


@query("SNK8_message_counts", """
    SELECT 'Driver' AS kind, count(DISTINCT driver_id) AS messages FROM telemetry
    UNION ALL SELECT 'Lap', count(DISTINCT (session_id, driver_id, lap_number)) FROM telemetry
    UNION ALL SELECT 'OVERTAKE', count(*) FROM edges WHERE rel = 'OVERTAKE'
    UNION ALL SELECT 'BATTLE', count(*) FROM edges WHERE rel = 'BATTLE'
""")
def message_counts(fx):
    path = scratch_path(fx.spark, "messages")
    events = fx.interactions.withColumn("event_ts_utc", F.col("event_ts").cast("string"))
    sets = (
        graph.driver_nodes(fx.telemetry), graph.lap_nodes(fx.telemetry),
        graph.interaction_edges(events, "overtake"), graph.interaction_edges(events, "battle"),
    )
    for batch_id, messages in [*enumerate(sets), (0, sets[0])]:  # the first batch is replayed
        write_messages(messages, path, batch_id=batch_id)
    sent = fx.spark.read.schema("key string, value string").json(path)
    kind = F.coalesce(
        F.get_json_object("value", "$.node_type"), F.get_json_object("value", "$.relationship_type")
    )
    return sent.groupBy(kind.alias("kind")).agg(F.count("*").alias("messages"))


@query("GR14_repeated_ids", """
    SELECT label, id, count(*) AS copies FROM (
        SELECT 'Driver' AS label, driver_id AS id FROM drivers
        UNION ALL SELECT 'Team', CAST(team_id AS STRING) FROM teams
        UNION ALL SELECT 'Lap', concat(session_id, ':', driver_id) FROM laps) n
    GROUP BY ALL HAVING count(*) > 1
""")
def repeated_ids(fx):
    # Laps keyed without their number, so the check has something to find.
    short = fx.laps.select(F.concat_ws(":", "session_id", "driver_id").alias("lap_id"))
    return graph.repeated_ids({"Driver": fx.drivers, "Team": fx.teams, "Lap": short})


@query("GR14_unique_graph", """
    SELECT 'Driver' AS label, driver_id AS id, 2::BIGINT AS copies FROM drivers WHERE driver_no % 7 = 0
    UNION ALL SELECT 'Session', session_id, 2 FROM telemetry WHERE session_id = 'error' GROUP BY session_id
    UNION ALL SELECT 'Lap', concat(session_id, ':', driver_id, ':', CAST(lap_number AS STRING)), 2 FROM telemetry
              WHERE driver_no = 3 GROUP BY session_id, driver_id, lap_number
""")
def unique_graph(fx):
    """Node tables with the nodes of some drivers, a session and their laps written twice."""
    again = {"Driver": "driver_no % 7 = 0", "Session": "session_id = 'error'", "Lap": "driver_no = 3"}
    build = {"Driver": profiles.driver_stats, "Session": profiles.session_span, "Lap": profiles.lap_stats}
    nodes = {
        label: make(fx.telemetry).unionByName(make(fx.telemetry.filter(again[label]))) for label, make in build.items()
    }
    return graph.repeated_ids({**nodes, "Team": fx.teams})


def interaction_events(fx) -> DataFrame:
    """Overtake and battle events of the interactions view, one edge per event."""
    return graph.interactions_of(fx.interactions, "overtake", "battle")


@query("GR15_dangling_edges", """
    SELECT rel, count(*) AS edges,
           count(*) FILTER (WHERE attacker_id NOT IN (SELECT driver_id FROM drivers WHERE driver_no <> 7)) AS missing_start,
           count(*) FILTER (WHERE defender_id NOT IN (SELECT driver_id FROM drivers WHERE driver_no <> 7)) AS missing_end
    FROM edges GROUP BY rel
""")
def dangling_edges(fx):
    nodes = fx.drivers.filter("driver_no <> 7").select(F.lit("Driver").alias("label"), F.col("driver_id").alias("id"))
    events = interaction_events(fx)
    edges = events.select(
        "rel", F.lit("Driver").alias("src_label"), F.col("attacker_id").alias("src"),
        F.lit("Driver").alias("dst_label"), F.col("defender_id").alias("dst"),
    )
    return graph.dangling_edges(edges, nodes)


@query("SET1_distinct_pairs", "SELECT DISTINCT session_id, attacker_id AS src, defender_id AS dst FROM edges WHERE rel = 'OVERTAKE'")
def distinct_pairs(fx):
    return pr.interaction_graph([graph.interactions_of(fx.interactions, "overtake")])


@query("SET2_union_distinct", "SELECT DISTINCT session_id, attacker_id AS src, defender_id AS dst FROM edges")
def union_distinct(fx):
    return pr.interaction_graph(
        [graph.interactions_of(fx.interactions, rel) for rel in ("overtake", "battle")]
    )


def _interaction_graph(fx) -> DataFrame:
    return pr.interaction_graph([interaction_events(fx)])


@query("SET3_vertices", """
    SELECT DISTINCT session_id, id FROM (SELECT session_id, attacker_id AS id FROM edges
                                         UNION ALL SELECT session_id, defender_id FROM edges) v
""")
def vertices(fx):
    return pr.edge_vertices(_interaction_graph(fx), ["session_id"])


def pagerank_sql(
    edges: str, keys: tuple[str, ...] = (), rounds: int = 10, reset: float = 0.15,
    weight: str | None = None, dangling: bool = False, digits: int | None = 6,
) -> str:
    """The same recurrence, one materialised step per round."""
    def k(alias: str) -> str:
        return "".join(f"{alias}.{c}, " for c in keys)

    def on(a: str, b: str) -> str:
        return "".join(f"{a}.{c} = {b}.{c} AND " for c in keys)

    w = weight or "1"
    group = "".join(f", {c}" for c in keys)
    steps = [
        f"WITH pe AS MATERIALIZED ({edges})",
        f"pv AS MATERIALIZED (SELECT DISTINCT {k('x')}x.id FROM (SELECT {k('pe')}src AS id FROM pe UNION ALL SELECT {k('pe')}dst FROM pe) x)",
        f"pn AS MATERIALIZED (SELECT {k('pv')}count(*)::DOUBLE AS n FROM pv GROUP BY ALL)",
        f"pd AS MATERIALIZED (SELECT {k('pe')}src, sum({w})::DOUBLE AS deg FROM pe GROUP BY src{group})",
    ]
    first = f"SELECT {k('v')}v.id, 1.0::DOUBLE / n.n AS rank FROM pv v JOIN pn n ON {on('v', 'n')}TRUE"
    steps.append(f"r0 AS MATERIALIZED ({first})")
    for i in range(rounds):
        lost = ""
        extra = ""
        if dangling:
            steps.append(
                f"l{i} AS MATERIALIZED (SELECT sum(r.rank) AS lost FROM r{i} r WHERE r.id NOT IN (SELECT src FROM pd))"
            )
            extra = " + coalesce(l.lost, 0) / n.n"
            lost = f" CROSS JOIN l{i} l CROSS JOIN pn n"
        steps.append(f"""r{i + 1} AS MATERIALIZED (
            SELECT {k('v')}v.id, {reset}::DOUBLE + {1 - reset}::DOUBLE * (coalesce(s.total, 0){extra}) AS rank
            FROM pv v LEFT JOIN (
                SELECT {k('e')}e.dst AS id, sum(r.rank * {('e.' + weight) if weight else '1.0'}::DOUBLE / d.deg) AS total
                FROM pe e JOIN r{i} r ON {on('e', 'r')}r.id = e.src JOIN pd d ON {on('e', 'd')}d.src = e.src
                GROUP BY e.dst{''.join(f', e.{c}' for c in keys)}) s
            ON {on('v', 's')}s.id = v.id{lost})""")
    score = "r.rank" if digits is None else f"round(r.rank, {digits})"
    return ", ".join(steps) + f" SELECT {k('r')}r.id, {score} AS pagerank_score FROM r{rounds} r"


GRAPH = "SELECT src, dst FROM graph_big"


@query("GR8_pagerank", pagerank_sql(GRAPH))
def pagerank(fx):
    edges = fx.graph_big
    return pr.pagerank(None, edges)


@query("GR9_pagerank_front_end", pagerank_sql(GRAPH, rounds=5, reset=0.2))
def pagerank_front_end(fx):
    graph = fx.stored("graph_big")
    edges = graph.withColumnsRenamed({"src": "from_id", "dst": "to_id"})
    people = pr.edge_vertices(graph).withColumnRenamed("id", "person")
    return pr.compute_pagerank(people, edges, max_iter=5, reset_prob=0.2)


WEIGHTED = """SELECT attacker_id AS src, defender_id AS dst, CAST(sum(coalesce(lap_count, 1)) AS BIGINT) + 1 AS weight
              FROM edges GROUP BY attacker_id, defender_id"""


def _weighted(fx) -> DataFrame:
    return interaction_events(fx).groupBy(
        F.col("attacker_id").alias("src"), F.col("defender_id").alias("dst")
    ).agg((F.sum(F.coalesce("lap_count", F.lit(1))) + 1).alias("weight"))


@query("GR9_weighted_pagerank", pagerank_sql(WEIGHTED, weight="weight"))
def weighted_pagerank(fx):
    edges = _weighted(fx)
    return pr.pagerank(None, edges, weight="weight")


# Customers point at order priorities, which point nowhere.
SINKS = "SELECT DISTINCT concat('C', CAST(o_custkey AS STRING)) AS src, concat('P', o_orderpriority) AS dst FROM orders"


@query("GR9_dangling_pagerank", pagerank_sql(SINKS, dangling=True))
def dangling_pagerank(fx):
    edges = fx.orders.select(
        F.concat(F.lit("C"), "o_custkey").alias("src"), F.concat(F.lit("P"), "o_orderpriority").alias("dst")
    ).distinct()
    return pr.pagerank(None, edges, dangling=True)


SESSION_GRAPH = "SELECT DISTINCT session_id, attacker_id AS src, defender_id AS dst FROM edges"


@query("GR10_session_pagerank", pagerank_sql(SESSION_GRAPH, ("session_id",)))
def session_pagerank(fx):
    return pr.session_pagerank([interaction_events(fx)])


JN1 = f"""
    WITH pe AS MATERIALIZED ({GRAPH}), v AS (SELECT DISTINCT id FROM (SELECT src AS id FROM pe UNION ALL SELECT dst FROM pe) x),
    d AS (SELECT src, count(*) AS deg FROM pe GROUP BY src)
    SELECT v.id, round(0.15::DOUBLE + 0.85::DOUBLE * coalesce(sum((1.0::DOUBLE / (SELECT count(*) FROM v)) / d.deg), 0), 6) AS pagerank_score
    FROM v LEFT JOIN pe ON pe.dst = v.id LEFT JOIN d ON d.src = pe.src GROUP BY v.id
"""


@query("JN1_rank_propagation", JN1)
def rank_propagation(fx):
    edges = fx.graph_big
    return pr.pagerank(None, edges, max_iter=1)


@query("JN2_no_in_edge_default", """
    SELECT count(*) AS vertices FROM (SELECT DISTINCT o_custkey FROM orders) c
""")
def no_in_edge_default(fx):
    edges = fx.orders.select(
        F.concat(F.lit("C"), "o_custkey").alias("src"), F.concat(F.lit("P"), "o_orderpriority").alias("dst")
    ).distinct()
    ranks = pr.pagerank(None, edges, max_iter=2)
    return ranks.filter("pagerank_score = 0.15").agg(F.count("*").alias("vertices"))


@query("AGG12_out_degree", "SELECT src, count(*) AS out_degree FROM graph_big GROUP BY src")
def out_degree(fx):
    return fx.graph_big.groupBy("src").agg(F.count("*").alias("out_degree"))


@query("AGG13_contributions", """
    SELECT e.dst AS id, round(sum(1.0::DOUBLE / d.deg), 6) AS total
    FROM graph_big e JOIN (SELECT src, count(*) AS deg FROM graph_big GROUP BY src) d ON d.src = e.src GROUP BY e.dst
""")
def contributions(fx):
    edges = fx.graph_big
    degree = edges.groupBy("src").agg(F.count("*").alias("deg"))
    return (
        skew_join(edges, degree, ["src"])
        .groupBy(F.col("dst").alias("id"))
        .agg(F.sum(F.lit(1.0) / F.col("deg")).alias("total"))
    )


@query("GR13_incremental_pagerank", pagerank_sql(GRAPH, rounds=40, reset=0.5))
def incremental_pagerank(fx):
    """Ranks of a graph with other edges for a tenth of the suppliers, then pushed on to the graph."""
    edges = fx.stored("graph_big")
    own = F.pmod(F.xxhash64("src", "dst"), F.lit(10)) == 0
    old = edges.filter(~(own & F.col("src").startswith("S"))).unionByName(
        edges.filter(own & F.col("dst").startswith("S")).select(F.col("dst").alias("src"), F.concat(F.lit("X"), "src").alias("dst"))
    ).distinct().checkpoint()
    before = pr.push_pagerank(old, reset_prob=0.5, tolerance=1e-12)
    return pr.push_pagerank(edges, before.ranks, old, reset_prob=0.5, tolerance=1e-12).ranks


WINDOW = 10
WINDOW_GRAPH = f"""
    SELECT DISTINCT attacker_id AS src, defender_id AS dst FROM edges
    WHERE lap_number > (SELECT max(lap_number) FROM edges) - {WINDOW}
"""


@query("GR13_window_pagerank", pagerank_sql(WINDOW_GRAPH, rounds=40, reset=0.5))
def window_pagerank(fx):
    """The graph of the last ten laps, moved on two laps at a time; each step pushes what changed."""
    edges = interaction_events(fx).select(
        F.col("attacker_id").alias("src"), F.col("defender_id").alias("dst"), "lap_number"
    ).distinct().checkpoint()
    last = edges.agg(F.max("lap_number")).first()[0]
    old = pr.window_edges(edges, "lap_number", last - 4, WINDOW)
    found = pr.push_pagerank(old, reset_prob=0.5)
    for at in (last - 2, last):
        now = pr.window_edges(edges, "lap_number", at, WINDOW)
        found = pr.push_pagerank(now, found.ranks, old, reset_prob=0.5)
        old = now
    return found.ranks


TREND_EDGES = """
    SELECT DISTINCT p.lap AS lap_number, f.src, f.dst FROM
      (SELECT attacker_id AS src, defender_id AS dst, min(lap_number) AS first_lap FROM edges GROUP BY ALL) f
    JOIN (SELECT unnest(range(1, (SELECT max(lap_number) FROM edges) + 1)) AS lap) p ON p.lap >= f.first_lap
"""


@query("WIN9_rank_trend", f"""
    SELECT lap_number, id, round(pagerank_score, 6) AS pagerank_score,
           round(pagerank_score - lag(pagerank_score) OVER (PARTITION BY id ORDER BY lap_number), 6) AS score_change
    FROM ({pagerank_sql(TREND_EDGES, ("lap_number",), rounds=5, digits=None)}) t
""")
def rank_trend(fx):
    edges = interaction_events(fx).select(
        F.col("attacker_id").alias("src"), F.col("defender_id").alias("dst"),
        F.col("lap_number").cast("bigint").alias("lap_number"),
    )
    return pr.rank_trend(edges, "lap_number", max_iter=5)


WIDTHS = {"avg_speed": 500.0, "avg_throttle": 10.0, "avg_brake": 5.0, "max_rpm": 10.0}
FEATURE_SQL = """
    SELECT driver_id, session_id, avg(speed_kph) AS avg_speed, avg(throttle_pct) AS avg_throttle,
           avg(brake_pressure_bar) AS avg_brake, max(engine_rpm) AS max_rpm
    FROM telemetry GROUP BY driver_id, session_id HAVING avg(throttle_pct) IS NOT NULL
"""
TOKEN_SQL = "[" + ", ".join(
    f"concat('{name}:', CAST(CAST(floor({name} / {width}::DOUBLE) AS BIGINT) AS STRING))"
    for name, width in WIDTHS.items()
) + "]"
COMMUNITY_SQL = f"""
    SELECT driver_id, session_id,
           concat('comm_', substr(list_min(list_transform(tokens, lambda t: md5(concat('0:', t)))), 1, 12)) AS community_id,
           list_min(list_transform(tokens, lambda t: md5(concat('4:', t)))) AS last_hash
    FROM (SELECT *, {TOKEN_SQL} AS tokens FROM ({FEATURE_SQL}) f) g
"""


def driver_communities(fx) -> DataFrame:
    return communities.driver_communities(fx.telemetry, WIDTHS)


@query("GR11_minhash_communities", COMMUNITY_SQL)
def minhash_communities(fx):
    features = profiles.driver_features(fx.telemetry)
    hashed = communities.lsh_communities(features, WIDTHS)
    return hashed.withColumn("last_hash", F.element_at("hashes", 5)).drop("hashes")


@query("GR11_hashed_fallback", f"""
    SELECT driver_id, concat('comm_', CAST(CAST('0x' || substr(md5(concat_ws('_',
        CAST(CAST(floor(avg_speed * 1000) AS BIGINT) AS STRING), CAST(CAST(floor(avg_throttle * 1000) AS BIGINT) AS STRING),
        CAST(CAST(floor(avg_brake * 1000) AS BIGINT) AS STRING), CAST(CAST(max_rpm AS BIGINT) * 1000 AS STRING))), 1, 8) AS BIGINT)
        % 10 AS STRING)) AS community_id
    FROM ({FEATURE_SQL}) f
""")
def hashed_fallback(fx):
    return communities.hashed_communities(profiles.driver_features(fx.telemetry))


@query("GR12_driver_communities", f"SELECT driver_id, session_id, community_id FROM ({COMMUNITY_SQL}) c")
def driver_community_table(fx):
    return driver_communities(fx).drop("hashes")


def _linked(pairs: str, rows: str) -> str:
    """Smallest reachable name per row, by labels that spread over ``pairs`` (a, b)."""
    return f"""
        WITH RECURSIVE m AS MATERIALIZED ({rows}), p AS MATERIALIZED ({pairs}),
        reach(a, b) AS (SELECT name, name FROM m UNION SELECT r.a, p.b FROM reach r JOIN p ON p.a = r.b)
        SELECT m.driver_id, m.session_id, concat('comm_', min(b)) AS community_id FROM m JOIN reach ON a = name
        GROUP BY ALL
    """


NAMED = f"SELECT *, concat(driver_id, '/', session_id) AS name, {TOKEN_SQL} AS tokens FROM ({FEATURE_SQL}) f"
TABLE_HASHES = "[" + ", ".join(
    f"list_min(list_transform(tokens, lambda t: md5(concat('{i}:', t))))" for i in range(5)
) + "]"
STYLE_PAIRS = f"""
    SELECT x.name AS a, y.name AS b FROM (SELECT *, {TABLE_HASHES} AS h FROM m) x, (SELECT *, {TABLE_HASHES} AS h FROM m) y
    WHERE len(list_filter(list_zip(x.h, y.h), lambda z: z[1] = z[2])) > 0
      AND len(list_intersect(x.tokens, y.tokens)) * 100 >= 60 * len(list_distinct(list_concat(x.tokens, y.tokens)))
"""


@query("GR11_linked_communities", _linked(STYLE_PAIRS, NAMED))
def linked_communities(fx):
    """Driver sessions that share a value in any of five tables and three fifths of their bins."""
    return communities.linked_communities(profiles.driver_features(fx.telemetry), WIDTHS, similarity=0.6)


NEAR = 60.0
NEAR_PAIRS = f"""
    SELECT x.name AS a, y.name AS b FROM m x, m y
    WHERE sqrt((x.avg_speed - y.avg_speed) ** 2 + (x.avg_throttle - y.avg_throttle) ** 2
               + (x.avg_brake - y.avg_brake) ** 2 + (x.max_rpm - y.max_rpm) ** 2) < {NEAR}
"""


@query("GR12_projection_communities", _linked(NEAR_PAIRS, NAMED))
def projection_communities(fx):
    """Driver sessions whose features lie near each other, found by random projections."""
    return communities.near_communities(profiles.driver_features(fx.telemetry), NEAR)


@query("AGG24_community_sizes", f"""
    SELECT community_id, count(DISTINCT driver_id) AS member_count FROM ({COMMUNITY_SQL}) c GROUP BY community_id
""")
def community_sizes(fx):
    return communities.community_sizes(driver_communities(fx))


@query("DET7_faster_than", """
    SELECT session_id, driver_id AS src, nxt AS dst, nxt_ms - best_ms AS time_delta_ms FROM (
        SELECT *, lead(driver_id) OVER w AS nxt, lead(best_ms) OVER w AS nxt_ms
        FROM (SELECT session_id, driver_id, min(lap_time_ms) AS best_ms FROM laps WHERE lap_time_ms IS NOT NULL
              GROUP BY session_id, driver_id) b
        WINDOW w AS (PARTITION BY session_id ORDER BY best_ms, driver_id)) c
    WHERE nxt IS NOT NULL
""")
def faster_than(fx):
    return graph.faster_than_edges(fx.laps)


@query("DET7_same_community", f"""
    SELECT driver_id AS src, min(driver_id) OVER (PARTITION BY community_id) AS dst, community_id
    FROM (SELECT DISTINCT driver_id, community_id FROM ({COMMUNITY_SQL}) c) m
""")
def same_community(fx):
    return graph.same_community_edges(driver_communities(fx).select("driver_id", "community_id").distinct())


@query("DET7_influenced_by", f"""
    WITH ranks AS MATERIALIZED ({pagerank_sql(SESSION_GRAPH, ("session_id",), digits=None)}),
    g AS MATERIALIZED ({SESSION_GRAPH}), d AS (SELECT session_id, src, count(*) AS deg FROM g GROUP BY ALL)
    SELECT g.session_id, g.dst AS src, g.src AS dst, round(r.pagerank_score / d.deg, 6) AS influence_weight
    FROM g JOIN d ON d.session_id = g.session_id AND d.src = g.src
    JOIN ranks r ON r.session_id = g.session_id AND r.id = g.src
""")
def influenced_by(fx):
    edges = _interaction_graph(fx)
    ranks = pr.pagerank(None, edges, ["session_id"])
    return graph.influenced_by_edges(edges, ranks, ["session_id"])
