"""Hand-built laps for the detectors and the as-of lap."""

import datetime

from pyspark.sql import functions as F

from lapgraph.operators import interactions as race

LAPS = (
    "session_id string, driver_id string, lap_number int, position int, lap_end timestamp, "
    "lap_time_ms bigint"
)


def end(n):
    return datetime.datetime(2024, 1, 1, 12) + datetime.timedelta(seconds=n)


def laps(spark, *rows):
    return spark.createDataFrame([("s", *row) for row in rows], LAPS)


def test_two_drivers_passed_in_one_lap(spark):
    table = laps(
        spark,
        ("A", 1, 3, end(3), 100), ("B", 1, 1, end(1), 90), ("C", 1, 2, end(2), 95),
        ("A", 2, 1, end(11), 80), ("B", 2, 2, end(12), 91), ("C", 2, 3, end(13), None),
    )
    got = {(r.attacker_id, r.defender_id): r for r in race.overtakes(table).collect()}
    assert set(got) == {("A", "B"), ("A", "C")}
    assert got["A", "B"].delta_time_ms == 11 and got["A", "B"].position_delta == 2
    assert got["A", "C"].delta_time_ms is None and got["A", "C"].avg_gap_ms is None


def test_missing_lap_position_or_end_gives_no_overtake(spark):
    missing_lap = laps(spark, ("A", 1, 2, end(1), 1), ("B", 1, 1, end(1), 1),
                       ("A", 3, 1, end(3), 1), ("B", 3, 2, end(3), 1))
    null_place = laps(spark, ("A", 1, None, end(1), 1), ("B", 1, 1, end(1), 1),
                      ("A", 2, 1, end(3), 1), ("B", 2, 2, end(3), 1))
    null_end = laps(spark, ("A", 1, 2, end(1), 1), ("B", 1, 1, end(1), 1),
                    ("A", 2, 1, None, 1), ("B", 2, 2, end(3), 1))
    no_swap = laps(spark, ("A", 1, 2, end(1), 1), ("B", 1, 1, end(1), 1),
                   ("A", 2, 2, end(2), 1), ("B", 2, 1, end(3), 1))
    for table in (missing_lap, null_place, null_end, no_swap):
        assert race.overtakes(table).isEmpty()


def test_strict_overtake_needs_a_small_gap_before(spark):
    table = laps(spark, ("A", 1, 2, end(3), 1), ("B", 1, 1, end(1), 1),
                 ("A", 2, 1, end(5), 1), ("B", 2, 2, end(6), 1))
    assert race.overtakes(table, max_gap_ms=2001).count() == 1
    assert race.overtakes(table, max_gap_ms=2000).isEmpty()


def test_battle_is_split_by_a_missing_lap(spark):
    rows = []
    for lap in (1, 2, 4, 5, 6, 8):
        rows += [("A", lap, 1, end(lap), 100), ("B", lap, 2, end(lap), 110)]
    got = sorted((r.lap_number, r.lap_count) for r in race.battles(laps(spark, *rows)).collect())
    assert got == [(1, 2), (4, 3)]


def test_places_two_apart_do_not_battle(spark):
    rows = []
    for lap in (1, 2):
        rows += [("A", lap, 1, end(lap), 1), ("B", lap, 3, end(lap), 1)]
    assert race.battles(laps(spark, *rows)).isEmpty()


def test_delta_follows_the_track_and_the_event_the_alphabet(spark):
    table = laps(spark, ("Z", 1, 1, end(1), 100), ("A", 1, 2, end(2), 130),
                 ("A", 2, 1, end(11), 90), ("Z", 2, 2, end(12), 95))
    battle = race.battles(table).collect()[0]
    assert (battle.driver_id, battle.driver_a_id, battle.driver_b_id) == ("A", "A", "Z")
    assert battle.delta_time_ms == 30 and battle.lap_count == 2
    assert battle.event_ts == end(1)


def test_battle_without_the_leaders_end_is_skipped(spark):
    table = laps(spark, ("A", 1, 1, None, 1), ("B", 1, 2, end(1), 1),
                 ("A", 2, 1, end(2), 1), ("B", 2, 2, end(2), 1))
    assert race.battles(table).isEmpty()


def test_neighbours_on_both_sides_of_a_position_block(spark):
    rows = [(f"D{p:03}", 1, p, end(p), p) for p in range(1, 100)]
    assert race.adjacent_pairs(laps(spark, *rows)).count() == 98


def test_samples_find_their_lap(spark):
    samples = spark.createDataFrame(
        [("s", "A", end(5), 1), ("s", "A", end(10), 2), ("s", "A", end(11), 3),
         ("s", "A", end(99), 4), ("s", "B", end(5), 5)],
        "session_id string, driver_id string, event_ts timestamp, sequence_number bigint",
    )
    table = laps(spark, ("A", 1, 1, end(10), 1), ("A", 2, 1, end(20), 1)).withColumn("compound", F.lit("SOFT"))
    got = {r.sequence_number: (r.lap_number, r.compound) for r in race.with_laps(samples, table, ["compound"]).collect()}
    assert got == {1: (1, "SOFT"), 2: (1, "SOFT"), 3: (2, "SOFT"), 4: (0, None), 5: (0, None)}
