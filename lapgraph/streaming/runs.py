"""Runs over the lap axis as keyed state: stints of drivers and battles of pairs.

One stateful query keeps, for every driver of a session and every pair of drivers, the laps
seen so far and the runs they form. A lap that comes, late or not, renumbers its own key
only. The state lives in the RocksDB store; a timer clears a key when the watermark has passed its last
lap by ``idle``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lapgraph.operators.interactions import BATTLE_STRENGTH
from lapgraph.operators.upsert import latest_per_key
from lapgraph.streaming.buckets import BucketedTable
from lapgraph.streaming.stateful import with_event_time

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

KEY = ["kind", "session_id", "driver_a", "driver_b"]
LAP_DDL = (
    "kind string, session_id string, driver_a string, driver_b string, lap_number int, mark string, closes boolean, "
    "ahead_time bigint, ahead_end bigint, behind_time bigint"
)
RUN_DDL = (
    "kind string, session_id string, driver_a string, driver_b string, first_lap int, run_no int, laps array<int>, "
    "mark string, ahead_time bigint, ahead_end bigint, behind_time bigint, revision bigint, gone boolean"
)
RUN = Row(*[part.split()[0] for part in RUN_DDL.split(", ")])


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; a query keeps the store it began with."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def _observations(rows: DataFrame, kind: str, event_time: str, **columns: Column) -> DataFrame:
    names = [part.split()[0] for part in LAP_DDL.split(", ")]
    kinds = dict(part.split() for part in LAP_DDL.split(", "))
    values = {"kind": F.lit(kind), "driver_b": F.lit(""), **columns}
    return rows.select(
        *[values.get(n, F.col(n) if n in ("session_id", "lap_number") else F.lit(None)).cast(kinds[n]).alias(n) for n in names],
        F.col(event_time).cast("timestamp").alias("seen_at"),
    )


def stint_laps(laps: DataFrame, event_time: str = "lap_start") -> DataFrame:
    """Laps as parts of stints: the compound marks a stint, a lap that ends in the pits closes it."""
    return _observations(
        laps, "stint", event_time, driver_a=F.col("driver_id"), mark=F.col("compound"), closes=F.col("pit_in").isNotNull()
    )


def battle_laps(pairs: DataFrame, event_time: str) -> DataFrame:
    """Laps on which two drivers were next to each other, as parts of battles."""
    return _observations(
        pairs, "battle", event_time, driver_a=F.col("driver_a"), driver_b=F.col("driver_b"), closes=F.lit(False),
        ahead_time=F.col("ahead_time"), behind_time=F.col("behind_time"),
        ahead_end=F.unix_micros(F.col("ahead_end").cast("timestamp")),
    )


class RunProcessor(StatefulProcessor):
    """Emits the runs of a key that a batch made, changed or dissolved."""

    def __init__(self, idle_seconds: int):
        self.idle_ms = 1000 * idle_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.laps = handle.getMapState(
            "laps", "lap_number int", "mark string, closes boolean, ahead_time bigint, ahead_end bigint, behind_time bigint"
        )
        self.known = handle.getMapState(
            "runs", "first_lap int",
            "run_no int, laps array<int>, mark string, ahead_time bigint, ahead_end bigint, behind_time bigint",
        )
        self.clock = handle.getValueState("clock", "revision bigint, last_seen bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        revision, last_seen = self.clock.get() if self.clock.exists() else (0, 0)
        for row in rows:
            self.laps.updateValue((row.lap_number,), (row.mark, row.closes, row.ahead_time, row.ahead_end, row.behind_time))
            last_seen = max(last_seen, int(row.seen_at.timestamp() * 1000))
        revision += 1
        self.clock.update((revision, last_seen))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(last_seen + self.idle_ms)
        yield from self._changed(key, revision)

    def _runs(self, kind: str) -> dict:
        runs, before, first = {}, None, None
        for (lap,), values in sorted(self.laps.iterator(), key=lambda item: item[0][0]):
            mark, closes = values[0], values[1]
            if before is None or before[2] or (lap != before[0] + 1 if kind == "battle" else mark != before[1]):
                first = lap
                runs[first] = [len(runs) + 1, [], mark, *values[2:]]
            runs[first][1].append(lap)
            before = (lap, mark, closes)
        return runs

    def _changed(self, key, revision: int) -> Iterator[Row]:
        known = {first[0]: list(value) for first, value in self.known.iterator()}
        for first, run in self._runs(key[0]).items():
            if known.pop(first, None) != run:
                self.known.updateValue((first,), tuple(run))
                yield RUN(*key, first, *run, revision, False)
        for first in known:
            self.known.removeKey((first,))
            yield RUN(*key, first, *[None] * 6, revision, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        for state in (self.laps, self.known, self.clock):
            state.clear()
        return iter(())

    def close(self) -> None:
        pass


def run_changes(observations: DataFrame, watermark: str, idle_seconds: int) -> DataFrame:
    """The stream of run changes (``RUN_DDL``) of a stream of observations."""
    timed = with_event_time(observations, "seen_at", watermark)
    return timed.groupBy(*KEY).transformWithState(
        RunProcessor(idle_seconds), RUN_DDL, outputMode="Update", timeMode="EventTime"
    )


class RunTable:
    """The newest state of all runs: each batch of changes is one version of a bucketed table."""

    def __init__(self, spark: SparkSession, path: str, watermark: str, idle_seconds: int):
        self.spark, self.path = spark, path
        self.watermark, self.idle_seconds = watermark, idle_seconds
        self.table = BucketedTable(spark, f"{path}/runs", [*KEY, "first_lap"], by=["session_id", "driver_a"])

    def start(self, observations: DataFrame, available_now: bool = True):
        """Follow a stream of observations; the checkpoint is part of the folder."""
        def step(batch: DataFrame, batch_id: int) -> None:
            self.table.upsert(latest_per_key(batch, self.table.keys, ["revision"]), "set", batch_id)

        with rocksdb_state(self.spark):
            writer = run_changes(observations, self.watermark, self.idle_seconds).writeStream.foreachBatch(step)
            trigger = {"availableNow": True} if available_now else {"processingTime": "60 seconds"}
            return (
                writer.outputMode("update").option("checkpointLocation", f"{self.path}/checkpoint").trigger(**trigger).start()
            )

    def runs(self, kind: str) -> DataFrame:
        return self.table.read().where((F.col("kind") == kind) & ~F.col("gone"))

    def stints(self) -> DataFrame:
        """Each lap with the number of its stint."""
        return self.runs("stint").select(
            "session_id", F.col("driver_a").alias("driver_id"), F.explode("laps").alias("lap_number"),
            F.col("mark").alias("compound"), F.col("run_no").cast("bigint").alias("stint_no"),
        )

    def battles(self, min_laps: int = 2) -> DataFrame:
        """Runs of at least ``min_laps`` laps, as ``operators.interactions.battles`` gives them."""
        delta = F.col("behind_time") - F.col("ahead_time")
        return self.runs("battle").where((F.size("laps") >= min_laps) & F.col("ahead_end").isNotNull()).select(
            "session_id", F.col("driver_a").alias("driver_a_id"), F.col("driver_b").alias("driver_b_id"),
            F.col("first_lap").alias("lap_number"), F.size("laps").alias("lap_count"),
            F.timestamp_micros("ahead_end").alias("event_ts"), delta.alias("delta_time_ms"), F.abs(delta).alias("avg_gap_ms"),
            F.lit(BATTLE_STRENGTH).alias("interaction_strength"),
        )
