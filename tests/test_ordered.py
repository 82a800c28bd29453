"""Block-wise ordered operators against plain windows and brute force, across block edges."""

import datetime
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lapgraph.operators import facts
from lapgraph.operators.interactions import overtaken_pairs
from lapgraph.operators.ordered import (
    asof_forward, dyadic_cover, interval_join, lower_side_keys, neighbour_row, number_runs, overlap_join, running_agg,
    upper_side_keys,
)
from lapgraph.operators.skew import mark_repeats, skew_join


def rows(spark, n=400, keys=3, seed=1):
    rng = random.Random(seed)
    data = [(rng.randrange(keys), rng.randrange(200), i, rng.choice("abc")) for i in range(n)]
    return spark.createDataFrame(data, "g int, pos int, id int, kind string")


def test_neighbours_cross_blocks(spark):
    df = rows(spark)
    order = Window.partitionBy("g").orderBy("pos", "id")
    for step, shift in ((-1, F.lag), (1, F.lead)):
        got = neighbour_row(df, ["g"], "pos", ["id"], 7, "other", step, ["id"])
        want = df.withColumn("want", shift("id").over(order))
        joined = got.select("id", F.col("other.id").alias("got")).join(want, "id")
        assert joined.filter("NOT got <=> want").count() == 0


def test_running_aggregates_cross_blocks(spark):
    df = rows(spark, seed=2)
    order = Window.partitionBy("g").orderBy("pos", "id").rowsBetween(Window.unboundedPreceding, 0)
    for agg in (F.sum, F.max, F.min):
        got = running_agg(df, ["g"], "pos", "id", 7, "got", agg, ["id"])
        want = df.select(F.col("id").alias("i"), agg("id").over(order).alias("want"))
        assert got.join(want, got["id"] == want["i"]).filter("NOT got <=> want").count() == 0


def test_runs_cross_blocks(spark):
    df = rows(spark, seed=3).dropDuplicates(["g", "pos"])
    got = number_runs(df, ["g"], "pos", ["kind"], lambda p: p["kind"] != F.col("kind"), 5, "run")
    previous = None
    runs = {}
    for row in sorted(got.collect(), key=lambda r: (r.g, r.pos)):
        same_group = previous is not None and previous.g == row.g
        expected = runs.get(row.g, 0) + (0 if same_group and previous.kind == row.kind else 1)
        assert row.run == expected
        runs[row.g] = expected
        previous = row


def at(seconds):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=seconds)


def test_asof_forward_brute_force(spark):
    rng = random.Random(4)
    points = [(rng.choice("xyz"), at(rng.randrange(5000)), i) for i in range(300)]
    marks = [(rng.choice("xy"), at(rng.randrange(4500)), 1000 + i) for i in range(40)]
    got = asof_forward(
        spark.createDataFrame(points, "k string, ts timestamp, id int"),
        spark.createDataFrame(marks, "k string, done timestamp, lap int"),
        ["k"], "ts", "done", ["lap"], 60,
    )
    found = {r.id: r.match.lap if r.match else None for r in got.collect()}
    assert len(found) == len(points)
    for key, ts, ident in points:
        later = [(done, lap) for k, done, lap in marks if k == key and done >= ts]
        assert found[ident] == (min(later)[1] if later else None)


def test_asof_mark_at_the_same_time_matches(spark):
    got = asof_forward(
        spark.createDataFrame([("x", at(60)), ("x", at(61))], "k string, ts timestamp"),
        spark.createDataFrame([("x", at(60), 1), ("x", None, 2)], "k string, done timestamp, lap int"),
        ["k"], "ts", "done", ["lap"], 30,
    )
    assert {r.ts.second: r.match for r in got.collect()}[1] is None
    assert {r.ts.second: r.match for r in got.collect()}[0].lap == 1


def test_interval_join_brute_force(spark):
    rng = random.Random(5)
    points = [("x", at(rng.randrange(2000)), i) for i in range(100)]
    spans = []
    for i in range(30):
        start = rng.randrange(2000)
        spans.append(("x", at(start), at(start + rng.randrange(300)), i))
    got = interval_join(
        spark.createDataFrame(points, "k string, ts timestamp, p int"),
        spark.createDataFrame(spans, "k string, s timestamp, e timestamp, q int"),
        ["k"], "ts", "s", "e", 37,
    )
    want = {(p, q) for _, ts, p in points for _, s, e, q in spans if s <= ts <= e}
    pairs = [(r.p, r.q) for r in got.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


@settings(max_examples=3, deadline=None)
@given(st.integers(0, 10_000))
def test_dominance_keys_meet_exactly_once(spark, seed):
    rng = random.Random(seed)
    values = spark.createDataFrame([(i, rng.randrange(500)) for i in range(60)], "id int, v int")
    levels = F.lit(8)
    low = values.select("id", "v", F.explode(lower_side_keys(F.col("v"), 4, levels)).alias("k"))
    high = values.select(
        F.col("id").alias("id2"), F.col("v").alias("v2"),
        F.explode(upper_side_keys(F.col("v"), 4, levels)).alias("k"),
    )
    pairs = [(r.id, r.id2) for r in low.join(high, "k").filter("v < v2").collect()]
    known = {r.id: r.v for r in values.collect()}
    want = {(a, b) for a in known for b in known if known[a] < known[b]}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_overtakes_on_a_grid_larger_than_a_block(spark):
    rng = random.Random(6)
    n, laps = 100, []
    for lap in (1, 2):
        places = list(range(1, n + 1))
        rng.shuffle(places)
        laps += [("s", f"D{i:03}", lap, places[i], at(lap), 1000 + i) for i in range(n)]
    table = spark.createDataFrame(
        laps, "session_id string, driver_id string, lap_number int, position int, lap_end timestamp, lap_time_ms bigint"
    )
    pos = {(d, lap): p for _, d, lap, p, _, _ in laps}
    names = sorted({d for _, d, *_ in laps})
    want = {
        (a, d) for a in names for d in names
        if pos[a, 2] < pos[a, 1] and pos[d, 1] < pos[a, 1] and pos[d, 2] > pos[a, 2]
    }
    got = [(r.attacker_id, r.defender_id) for r in overtaken_pairs(table).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_skew_join_keeps_rows_of_a_hot_key(spark):
    left = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")))
    right = spark.createDataFrame([("hot", 1), ("7", 2)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = left.join(right, ["k"], how)
        got = skew_join(left, right, ["k"], how)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_mark_repeats_one_first_row_per_key(spark):
    df = spark.range(500).select(
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 11 == 0, None).otherwise(
            (F.col("id") % 40).cast("string")).alias("k"),
        (F.col("id") % 5).alias("t"), "id",
    )
    marked = mark_repeats(df, ["k"], ["t", "id"])
    order = Window.partitionBy("k").orderBy("t", "id")
    want = df.withColumn("is_duplicate", F.row_number().over(order) > 1)
    assert marked.exceptAll(want).isEmpty() and marked.count() == 500


def test_mark_repeats_counts_identical_rows(spark):
    df = spark.range(100).select(F.lit("k").alias("k"), F.lit(1).alias("t"))
    assert mark_repeats(df, ["k"], ["t"]).filter("NOT is_duplicate").count() == 1


def test_running_sum_skips_missing_values(spark):
    rows = [("a", 0, 5), ("a", 1, 7), ("a", 10, None), ("a", 11, 3), ("b", 0, None), ("b", 12, 4)]
    df = spark.createDataFrame(rows, "k string, p int, v int")
    got = [r.total for r in running_agg(df, ["k"], "p", "v", 10, "total").orderBy("k", "p").collect()]
    assert got == [5, 12, 12, 15, None, 4]


def _ts(minutes):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minutes)


def test_periods_merge_only_where_they_touch(spark):
    spans = [(0, 20), (10, 30), (30, 40), (41, 50), (300, 290), (0, 5), (100, 200), (110, 120), (150, 210)]
    periods = spark.createDataFrame([("s", _ts(a), _ts(b)) for a, b in spans], "session_id string, period_start timestamp, period_end timestamp")
    got = sorted((r.period_start, r.period_end) for r in facts.merge_periods(periods, 1800).collect())
    assert got == [(_ts(0), _ts(40)), (_ts(41), _ts(50)), (_ts(100), _ts(210))]
    laps = spark.createDataFrame(
        [("s", "d", 1, _ts(35), _ts(45)), ("s", "d", 2, _ts(50), _ts(51)), ("s", "d", 3, _ts(90), _ts(400)), ("t", "d", 1, _ts(0), _ts(9))],
        "session_id string, driver_id string, lap_number int, lap_start timestamp, lap_end timestamp",
    )
    seconds = {r.lap_number: r.safety_car_seconds for r in facts.laps_under_safety_car(laps, periods, 1800).collect()}
    assert seconds == {1: 540.0, 3: 6600.0}


def test_runs_open_at_a_change_to_null(spark):
    rows = [("a", i, c) for i, c in enumerate(["x", "x", None, None, "y", "x"])]
    df = spark.createDataFrame(rows, "k string, p int, c string")
    numbered = number_runs(df, ["k"], "p", ["c"], lambda prev: ~prev["c"].eqNullSafe(F.col("c")), 2, "run")
    assert [r.run for r in numbered.orderBy("p").collect()] == [1, 1, 2, 2, 3, 4]


def test_dyadic_cover(spark):
    rng = random.Random(3)
    spans = [(a, a + rng.choice([0, 1, 2, 7, 30, 500])) for a in (rng.randint(-600, 600) for _ in range(200))]
    rows = spark.createDataFrame(spans, "a long, b long").select("a", "b", dyadic_cover(F.col("a"), F.col("b")).alias("parts")).collect()
    for row in rows:
        blocks = [p.place * 2**p.level + i for p in row.parts for i in range(2**p.level)]
        assert sorted(blocks) == list(range(row.a, row.b + 1))


def test_a_year_in_seconds_has_few_ranges(spark):
    year = 365 * 86_400
    rows = spark.createDataFrame([(s, s + year) for s in (1_700_000_001, 1_712_345_677)], "a long, b long")
    assert all(len(r[0]) < 60 for r in rows.select(dyadic_cover(F.col("a"), F.col("b"))).collect())


def test_joins_of_long_and_short_spans(spark):
    """Lengths from nothing to far more than a block, against all pairs."""
    rng = random.Random(5)
    at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
    span = lambda i: (i, "k", at(s := rng.randint(0, 5000)), at(s + rng.choice([-5, 0, 1, 60, 3000])))
    left, right = [span(i) for i in range(60)], [span(i) for i in range(60)]
    points = [(i, "k", at(rng.randint(0, 8000))) for i in range(80)]
    a = spark.createDataFrame(left, "l int, key string, a timestamp, b timestamp")
    b = spark.createDataFrame(right, "r int, key string, c timestamp, d timestamp")
    p = spark.createDataFrame(points, "p int, key string, ts timestamp")
    pairs = sorted((x.l, x.r) for x in overlap_join(a, b, ["key"], ("a", "b"), ("c", "d"), 10).collect())
    valid = lambda x: x[2] <= x[3]
    assert pairs == sorted((x[0], y[0]) for x in left for y in right if valid(x) and valid(y) and x[2] < y[3] and y[2] < x[3])
    found = sorted((x.p, x.l) for x in interval_join(p, a, ["key"], "ts", "a", "b", 10).collect())
    assert found == sorted((x[0], y[0]) for x in points for y in left if y[2] <= x[2] <= y[3])
