"""Upserts, PageRank, sketches, samples, running aggregates on small tables."""

import math

import random

import pytest
from pyspark.sql import functions as F

from lapgraph.operators import communities, pagerank as pagerank_module, sampling, sketches
from lapgraph.operators.pagerank import compute_pagerank, pagerank, push_pagerank, rank_trend
from lapgraph.operators.upsert import (
    finish_partials, lap_partials, last_batch, merge_partials, upsert, upsert_edges,
)


def table(df):
    return {r.id: (r.a, r.b) for r in df.collect()}


@pytest.mark.parametrize("mode, expected", [
    ("set", {1: (1, 1), 2: (None, 2), 3: (30, None)}),
    ("merge", {1: (1, 1), 2: (None, 2), 3: (30, None)}),
    ("keep", {1: (1, 1), 2: (2, 2), 3: (30, None)}),
    ("update", {1: (1, 1), 2: (None, 2)}),
])
def test_upsert_modes_and_replay(spark, mode, expected):
    old = spark.createDataFrame([(1, 1, 1), (2, 2, 2)], "id int, a int, b int")
    new = spark.createDataFrame([(2, None), (3, 30)], "id int, a int")
    once = upsert(old, new, ["id"], mode)
    assert table(once) == expected
    assert table(upsert(once, new, ["id"], mode)) == expected


def test_upsert_adds_new_columns(spark):
    old = spark.createDataFrame([(1, 1)], "id int, a int")
    new = spark.createDataFrame([(1, "x")], "id int, c string")
    assert upsert(old, new, ["id"]).first().asDict() == {"id": 1, "a": 1, "c": "x"}


def test_edge_upsert_needs_both_ends_and_keeps_the_latest(spark):
    columns = "rel string, src string, dst string, event_id int, event_ts int"
    new = spark.createDataFrame(
        [("O", "a", "b", 1, 1), ("O", "a", "b", 2, 2), ("O", "a", "x", 3, 1), ("O", "x", "b", 4, 1)], columns
    )
    nodes = spark.createDataFrame([("a",), ("b",)], "id string")
    state = upsert_edges(spark.createDataFrame([], columns), new, nodes, ["event_ts"])
    assert [(r.src, r.dst, r.event_id) for r in state.collect()] == [("a", "b", 2)]
    later = spark.createDataFrame([("O", "a", "b", 9, 0)], columns)
    assert upsert_edges(state, later, nodes, ["event_ts"]).first().event_id == 9


def brute_pagerank(edges, rounds=10, reset=0.15, dangling=False):
    ids = sorted({v for e in edges for v in e})
    ranks = {v: 1 / len(ids) for v in ids}
    degree = {v: sum(1 for s, _ in edges if s == v) for v in ids}
    for _ in range(rounds):
        lost = sum(ranks[v] for v in ids if degree[v] == 0) / len(ids) if dangling else 0
        ranks = {
            v: reset + (1 - reset) * (lost + sum(ranks[s] / degree[s] for s, d in edges if d == v))
            for v in ids
        }
    return ranks


EDGES = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("d", "d"), ("e", "a"), ("c", "z")]


@pytest.mark.parametrize("options", [{}, {"dangling": True}, {"edges_per_split": 2}, {"checkpoint_every": 4}])
def test_pagerank_brute_force(spark, options):
    edges = spark.createDataFrame(EDGES, "src string, dst string")
    got = {r.id: r.pagerank_score for r in pagerank(None, edges, **options).collect()}
    want = brute_pagerank(EDGES, dangling=options.get("dangling", False))
    assert set(got) == set(want)
    for vertex in want:
        assert math.isclose(got[vertex], want[vertex], rel_tol=1e-9)
    if not options.get("dangling"):  # without the spread, no in-edge means exactly the reset
        assert got["e"] == 0.15


def test_grouped_pagerank_equals_separate_graphs(spark):
    others = [("p", "q"), ("q", "p"), ("r", "p")]
    rows = [("one", *e) for e in EDGES] + [("two", *e) for e in others]
    got = pagerank(None, spark.createDataFrame(rows, "g string, src string, dst string"), ["g"])
    want = {("one", k): v for k, v in brute_pagerank(EDGES).items()}
    want.update({("two", k): v for k, v in brute_pagerank(others).items()})
    for row in got.collect():
        assert math.isclose(row.pagerank_score, want.pop((row.g, row.id)), rel_tol=1e-9)
    assert not want


def test_pagerank_front_end_and_normalize(spark):
    edges = spark.createDataFrame(EDGES, "one string, two string")
    people = spark.createDataFrame([(v,) for v in "abcdez"], "person string")
    total = compute_pagerank(people, edges, normalize=True).agg(F.sum("pagerank_score")).first()[0]
    assert math.isclose(total, 1.0, rel_tol=1e-9)


def test_duplicates_without_key_or_order(spark):
    df = spark.createDataFrame([(1, 1)], "key int, sequence_number int")
    assert not sketches.mark_duplicates(df, "nothing").first().is_duplicate
    assert sketches.mark_duplicates(df.drop("sequence_number"), "key").first().dedup_bloomfilter_flag


def test_duplicates_with_null_keys_and_ties(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (5, 1), (5, 1)], "key int, sequence_number int")
    marked = sketches.mark_duplicates(df, "key")
    assert marked.filter("NOT is_duplicate").count() == 2


def test_hll_error_bound(spark):
    estimate = sketches.hll_cardinality(spark.range(50000), "id", 12).first()[0]
    assert abs(estimate - 50000) <= 3 * sketches.hll_error(12) * 50000


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumn("w", F.col("id") + 1)
    draw = lambda d: sorted(r.id for r in sampling.uniform_sample(d, "id", 50, 3).collect())
    assert draw(df) == draw(df.repartition(17)) and len(draw(df)) == 50
    assert draw(df) != sorted(r.id for r in sampling.uniform_sample(df, "id", 50, 4).collect())
    assert sampling.uniform_sample(df, "id", 5000).count() == 1000
    heavy = sampling.weighted_sample(df, "id", "w", 100).agg(F.avg("id")).first()[0]
    assert heavy > 550


def test_equal_styles_share_a_community(spark):
    rows = [("A", "s", 101.0, 5.0, 1.0, 10), ("B", "s", 102.0, 5.5, 1.0, 11), ("C", "s", 900.0, 95.0, 50.0, 90)]
    features = spark.createDataFrame(
        rows, "driver_id string, session_id string, avg_speed double, avg_throttle double, avg_brake double, max_rpm int"
    )
    widths = {"avg_speed": 10.0, "avg_throttle": 10.0, "avg_brake": 10.0, "max_rpm": 10.0}
    got = {r.driver_id: r.community_id for r in communities.lsh_communities(features, widths).collect()}
    assert got["A"] == got["B"] != got["C"]


def test_partials_merge_in_any_split(spark):
    df = spark.range(300).select(
        F.lit("s").alias("session_id"), (F.col("id") % 3).cast("string").alias("driver_id"),
        (F.col("id") % 7).cast("int").alias("lap_number"), F.col("id").alias("speed_kph"),
        F.when(F.col("id") % 5 > 0, F.col("id")).alias("battery_pct"), F.col("id").alias("fuel_mass_kg"),
        F.timestamp_seconds("id").alias("event_ts"), F.col("id").alias("sequence_number"),
    )
    whole = finish_partials(merge_partials(lap_partials(df)))
    parts = lap_partials(df.filter("id < 100")).unionByName(lap_partials(df.filter("id >= 100")))
    split = finish_partials(merge_partials(parts))
    columns = [c for c in whole.columns if c != "approx_distinct"]
    assert whole.select(columns).exceptAll(split.select(columns)).isEmpty()
    numbered = lap_partials(df.filter("id < 100")).withColumn("batch", F.lit(0)).unionByName(
        lap_partials(df.filter("id >= 100")).withColumn("batch", F.lit(1)))
    newest = merge_partials(last_batch(numbered, ["session_id"]), ["session_id"])
    assert newest.first().samples == 200


def test_trend_ends_with_the_data(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "c", 4)], "src string, dst string, lap int")
    steps = {r.lap for r in rank_trend(edges, "lap", max_iter=2).collect()}
    assert steps == {1, 2, 3, 4}
    early = {(r.lap, r.id) for r in rank_trend(edges, "lap", 3, max_iter=2).collect()}
    assert early == {(lap, v) for lap in (1, 2, 3) for v in "ab"}


def test_a_source_with_most_edges_is_split(spark):
    edges = [("hub", f"v{i}") for i in range(900)] + [(f"v{i}", f"v{i + 1}") for i in range(100)]
    table = spark.createDataFrame(edges, "src string, dst string")
    got = {r.id: r.pagerank_score for r in pagerank(None, table, max_iter=3, edges_per_split=50).collect()}
    whole = {r.id: r.pagerank_score for r in pagerank(None, table, max_iter=3).collect()}
    assert got.keys() == whole.keys() and all(math.isclose(got[v], whole[v], rel_tol=1e-9) for v in got)


def exact_ranks(edges, reset=0.5):
    """The fixed point, by many plain rounds."""
    ids = {v for e in edges for v in e}
    ranks = dict.fromkeys(ids, reset)
    degree = {u: sum(e[0] == u for e in edges) for u in ids}
    for _ in range(60):
        inflow = dict.fromkeys(ids, 0.0)
        for u, v in edges:
            inflow[v] += ranks[u] / degree[u]
        ranks = {v: reset + (1 - reset) * inflow[v] for v in ids}
    return ranks


def test_pushed_ranks_follow_a_changed_graph(spark):
    """Chains of which one loses an edge, one gains one, one goes and one is new."""
    chains = [(f"{c}{i}", f"{c}{(i + 1) % 6}") for c in "abcdefgh" for i in range(6)]
    old = sorted({*chains, ("hub", "a0"), *((f"{c}0", "hub") for c in "abcdefgh")})
    new = sorted({e for e in old if e[0][0] != "c" and e[1][0] != "c"} - {("b2", "b3")} | {("d1", "d4"), ("n", "d2")})
    frame = lambda rows: spark.createDataFrame(rows, "src string, dst string")
    ranks = lambda pushed: {r.id: r.pagerank_score for r in pushed.ranks.collect()}
    first = push_pagerank(frame(old), reset_prob=0.5)
    assert ranks(first) == pytest.approx(exact_ranks(old), abs=1e-7)
    moved = push_pagerank(frame(new), first.ranks, frame(old), reset_prob=0.5)
    assert ranks(moved) == pytest.approx(exact_ranks(new), abs=1e-7)
    assert moved.edges_sent < push_pagerank(frame(new), reset_prob=0.5).edges_sent / 2
    same = push_pagerank(frame(old), first.ranks, frame(old), reset_prob=0.5)
    assert same.edges_sent == 0 and ranks(same) == pytest.approx(ranks(first))


def test_rank_trend_equals_a_graph_per_step(spark):
    rng = random.Random(6)
    rows = sorted({(rng.randrange(12), rng.randrange(12), rng.randint(1, 9)) for _ in range(60)})
    found = {(r.lap, r.id): (r.pagerank_score, r.score_change) for r in rank_trend(
        spark.createDataFrame(rows, "src long, dst long, lap int"), "lap", max_iter=4).collect()}
    expected = {}
    for lap in range(1, max(r[2] for r in rows) + 1):
        edges = {(s, d) for s, d, first in rows if first <= lap}
        ids = {v for e in edges for v in e}
        ranks = dict.fromkeys(ids, 1 / len(ids) if ids else 0)
        for _ in range(4):
            out = {u: sum(e[0] == u for e in edges) for u in ids}
            ranks = {v: 0.15 + 0.85 * sum(ranks[u] / out[u] for u, w in edges if w == v) for v in ids}
        for v in ids:
            before = expected.get((lap - 1, v), (None,))[0]
            expected[lap, v] = (ranks[v], None if before is None else ranks[v] - before)
    assert found.keys() == expected.keys()
    for key, (score, change) in expected.items():
        assert found[key][0] == pytest.approx(score) and found[key][1] == (change if change is None else pytest.approx(change, abs=1e-9))


def test_rounds_have_partitions_by_the_number_of_edges(spark, monkeypatch):
    """The layout follows the measured edges, not the session's setting, which stays as it was."""
    monkeypatch.setattr(pagerank_module, "EDGES_PER_PARTITION", 40)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    edges = [(f"v{i}", f"v{(i * 7 + 1) % 100}") for i in range(100)]
    frame = spark.createDataFrame(edges, "src string, dst string")
    pushed = push_pagerank(frame, reset_prob=0.5, edges_per_split=1)
    fixed = pagerank(None, frame, reset_prob=0.5, max_iter=40)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert pagerank_module._partitions(frame) == 3
        assert pagerank(None, frame, max_iter=2).rdd.getNumPartitions() == 3
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = brute_pagerank(edges, rounds=40, reset=0.5)
    for found in (pushed.ranks, fixed):
        got = {r.id: r.pagerank_score for r in found.collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-7 for k in want)


def test_edges_are_computed_once(spark):
    """Degrees, vertices and the layout all read the edges; what they come from runs once."""
    seen = spark.sparkContext.accumulator(0)

    def count(name):
        seen.add(1)
        return name

    frame = spark.createDataFrame(EDGES, "src string, dst string")
    pagerank(None, frame.withColumn("src", F.udf(count, "string")("src")), max_iter=2)
    assert seen.value == len(EDGES)


def test_pushed_rounds_join_splits(spark, monkeypatch):
    """A round joins a row for each split of a source, not one for each edge, also where pairs repeat or miss an end."""
    from lapgraph.operators import pagerank as pr

    rows = [("a", f"v{i}") for i in range(40)] + [(f"v{i}", "a") for i in range(40)]
    frame = lambda rows: spark.createDataFrame(rows, "src string, dst string")
    seen, push = [], pr._push
    monkeypatch.setattr(pr, "_push", lambda state, local, *rest: seen.append(local.count()) or push(state, local, *rest))
    found = push_pagerank(frame(rows), reset_prob=0.5, edges_per_split=10)
    assert len(set(seen)) == 1 and 41 <= seen[0] <= 44
    ranks = {r.id: r.pagerank_score for r in found.ranks.collect()}
    assert ranks["a"] == pytest.approx((0.5 + 0.5 * 40 * 0.5) / (1 - 0.25)) and len(ranks) == 41
    both = [("a", "b"), ("a", "b"), ("a", "c"), (None, "b"), ("d", None)]
    now, before = [*both, ("e", "b")], [*both, ("a", "c"), ("f", "b"), ("f", "g")]
    ids = spark.createDataFrame([(x, 1.0) for x in "abcdefg"], "id string, rank double")
    moved = {r[0]: r[1] for r in pr._moved_shares(frame(now), frame(before), ids, 0.5).collect()}
    assert {k: v for k, v in moved.items() if k and v} == pytest.approx({"b": 0.5 - 0.25, "g": -0.25})
