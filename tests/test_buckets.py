"""Bucketed tables: upserts, folding, replay, isolation, change feed."""

import os
import random

import pytest
from pyspark.sql import functions as F

from lapgraph.operators.upsert import upsert
from lapgraph.session import scratch_path
from lapgraph.streaming.buckets import BucketedTable

ROW = "id long, a int, b string"


def rows(spark, values):
    return spark.createDataFrame(values, ROW)


def table_of(spark, **options):
    return BucketedTable(spark, scratch_path(spark, "t-buckets"), ["id"], **{"buckets": 8, **options})


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("mode", ["set", "merge", "keep", "update"])
def test_batches_equal_plain_upserts(spark, mode):
    """Small fold limits, so that some buckets have deltas, some were folded, many batches."""
    rng = random.Random(mode)
    table = table_of(spark, fold_rows=3, fold_deltas=2)
    expected = rows(spark, [(i, i, "x") for i in range(20)])
    table.write(expected, 0)
    for version in range(1, 6):
        batch = [(i, rng.choice([None, version]), rng.choice([None, f"v{version}"])) for i in rng.sample(range(40), 8)]
        table.upsert(rows(spark, batch), mode, version)
        expected = rows(spark, upsert(expected, rows(spark, batch), ["id"], mode).select("id", "a", "b").collect())
    assert content(table.read().select("id", "a", "b")) == content(expected)
    commit = table.commit()
    assert any(part["base"] is not None and part["base"] > 0 for part in commit["buckets"].values())


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_written_bytes_follow_the_batch(spark):
    table = table_of(spark, buckets=16)
    table.write(spark.range(200_000).select("id", F.lit(1).alias("a"), F.sha2(F.col("id").cast("string"), 256).alias("b")), 0)
    whole = size_of(table.path)
    for version in (1, 2, 3):
        table.upsert(rows(spark, [(version, 2, "new"), (10**6 + version, 2, "new")]), "merge", version)
        written = size_of(f"{table.path}/delta/_version={version}")
        assert written < whole / 500
        assert len(table.commit()["touched"]) <= 2
    assert table.read().count() == 200_003 and table.read().where("a = 2").count() == 6


def test_replay_isolation_and_failed_batches(spark):
    table = table_of(spark)
    table.write(rows(spark, [(1, 1, "x"), (2, 1, "x")]), 0)
    held = table.read()
    table.upsert(rows(spark, [(1, 2, "y")]), "merge", 1)
    table.upsert(rows(spark, [(1, 3, "z")]), "merge", 1)  # comes again: already applied
    assert content(held) == [(1, 1, "x"), (2, 1, "x")]
    assert content(table.read()) == [(1, 2, "y"), (2, 1, "x")] and content(table.read(0)) == content(held)
    broken = rows(spark, [(2, 5, "w")]).withColumn("a", F.raise_error(F.lit("stop")).cast("int"))
    with pytest.raises(Exception, match="stop"):
        table.upsert(broken, "merge", 2)
    assert table.versions() == [0, 1]
    table.upsert(rows(spark, [(2, 5, "w")]), "merge", 2)
    assert content(table.read()) == [(1, 2, "y"), (2, 5, "w")]


def test_new_columns(spark):
    table = table_of(spark)
    table.write(rows(spark, [(1, 1, "x"), (2, 1, "x")]), 0)
    table.upsert(rows(spark, [(1, 7, "y")]).select("id", F.lit(9).alias("c")), "merge", 1)
    table.upsert(rows(spark, [(3, 4, "n")]), "merge", 2)
    found = {r.id: (r.a, r.b, r.c) for r in table.read().collect()}
    assert found == {1: (1, "x", 9), 2: (1, "x", None), 3: (4, "n", None)}


def test_merge_and_insert(spark):
    table = table_of(spark)
    add = lambda df: df.groupBy("id").agg(F.sum("a").alias("a"), F.max("b").alias("b"))
    table.merge(add(rows(spark, [(1, 1, "x"), (2, 5, "x"), (1, 2, "y")])), add, 0)
    table.merge(add(rows(spark, [(1, 10, "a"), (3, 1, "x")])), add, 1)
    assert content(table.read()) == [(1, 13, "y"), (2, 5, "x"), (3, 1, "x")]
    table.insert(rows(spark, [(1, 0, "no"), (4, 4, "yes")]), 2)
    assert content(table.read()) == [(1, 13, "y"), (2, 5, "x"), (3, 1, "x"), (4, 4, "yes")]
    assert content(table.changes(1)) == [(4, 4, "yes", 2)]


def test_change_feed(spark):
    table = table_of(spark, fold_rows=1, fold_deltas=1)
    table.write(rows(spark, [(i, 0, "x") for i in range(5)]), 0)
    for version in (1, 2, 4):
        table.upsert(rows(spark, [(version, version, "y"), (9, version, "z")]), "merge", version)
    assert content(table.changes(1)) == [(2, 2, "y", 2), (4, 4, "y", 4), (9, 4, "z", 4)]
    assert content(table.changes(0, 1)) == [(1, 1, "y", 1), (9, 1, "z", 1)]
    assert content(table.changes(4)) == []
    seen = []
    follow = lambda: table.stream_changes(lambda df, _: seen.append(content(df)), f"{table.path}-cp", 0).awaitTermination()
    follow()
    assert seen == [[(1, 1, "y", 1), (9, 1, "z", 1)], [(2, 2, "y", 2), (9, 2, "z", 2)], [(4, 4, "y", 4), (9, 4, "z", 4)]]
    table.upsert(rows(spark, [(5, 5, "n")]), "merge", 5)
    follow()
    assert seen[3:] == [[(5, 5, "n", 5)]]


def test_vacuum_keeps_what_readers_may_need(spark):
    table = table_of(spark, fold_rows=1, fold_deltas=1)
    for version in range(5):
        table.upsert(rows(spark, [(i, version, "x") for i in range(6)]), "merge", version)
    assert table.vacuum(keep=2) == []
    assert table.vacuum(keep=2, retain_seconds=0) == [0, 1, 2]
    assert table.versions() == [3, 4]
    for version in (3, 4):
        assert content(table.read(version)) == [(i, version, "x") for i in range(6)]
    assert content(table.changes(3)) == [(i, 4, "x", 4) for i in range(6)]
    with pytest.raises(ValueError, match="gone"):
        table.changes(1)
    kept = os.listdir(f"{table.path}/delta".removeprefix("file:"))
    assert sorted(kept) == ["_version=3", "_version=4"]


def test_buckets_by_place(spark):
    """A history by time step: a batch reads only the steps that it has."""
    table = table_of(spark, place=lambda: F.floor(F.col("id") / 100))
    for version in range(4):
        table.insert(rows(spark, [(version * 100 + i, version, "x") for i in range(50)]), version)
        assert table.commit()["touched"] == [version]
    table.insert(rows(spark, [(310, 9, "again"), (360, 9, "new")]), 4)
    assert table.commit()["touched"] == [3] and table.read().count() == 201


def test_inserted_keys_are_read_as_they_lie(spark):
    """Deltas that only add keys need no search for the newest row, until a batch changes one."""
    table = table_of(spark, fold_rows=5)
    for version in range(3):
        table.insert(rows(spark, [(i, version, "x") for i in range(version * 30, version * 30 + 40)]), version)
    plan = lambda: table.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan()
    assert content(table.read()) == sorted([(i, min(max((i - 10) // 30, 0), 2), "x") for i in range(100)], key=repr)
    assert all(part["base"] is None for part in table.commit()["buckets"].values())
    table.upsert(rows(spark, [(5, 9, "y"), (500, 9, "y")]), "set", 3)
    table.insert(rows(spark, [(5, 8, "z"), (501, 8, "z")]), 4)
    got = {row.id: (row.a, row.b) for row in table.read().collect()}
    assert table.read().count() == len(got) == 102
    assert got[5] == got[500] == (9, "y") and got[501] == (8, "z") and got[6] == (0, "x")
