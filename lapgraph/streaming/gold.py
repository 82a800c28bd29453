"""Micro-batch graph building.

Every batch upserts what it changes into tables by key bucket (``streaming/buckets.py``): laps,
drivers, sessions, the edges between them, interaction edges and counts per pair. Aggregates
are stored in a form that can be merged, and averages are taken when a table is read. A
replayed batch changes nothing. Each table has one writer: what telemetry and events know of
the same driver is kept apart and joined by the reader.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lapgraph.functions.scalars import composite_key
from lapgraph.operators.communities import feature_partials, lsh_communities, merged_feature_partials, merged_features
from lapgraph.operators.graph import interactions_of
from lapgraph.operators.pagerank import pagerank
from lapgraph.operators.profiles import driver_identity, session_span
from lapgraph.operators.sampling import bottom_k, merged_sample
from lapgraph.operators.selection import with_ids
from lapgraph.operators.sketches import kll_partials, kll_quantiles, merge_kll
from lapgraph.operators.skew import skew_join
from lapgraph.operators.upsert import LAP, finish_partials, lap_partials, last_batch, latest_per_key, merge_partials
from lapgraph.sources.sinks import GOLD_TRIGGER, trigger_options, write_tables
from lapgraph.streaming.buckets import BucketedTable
from lapgraph.streaming.state import VersionedTable


def _span(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Smallest ``first_*`` and names, largest ``last_*`` and ``latest_*`` per key."""
    rest = [c for c in rows.columns if c not in keys]
    largest = lambda c: c.startswith(("last_", "latest_"))
    return rows.groupBy(*keys).agg(*[(F.max if largest(c) else F.min)(c).alias(c) for c in rest])


def _lap_span(laps: DataFrame) -> DataFrame:
    return laps.groupBy("driver_id", "session_id").agg(
        F.min("lap_number").alias("first_lap"), F.max("lap_number").alias("last_lap"),
        F.min("first_event_ts").alias("first_event_ts"), F.max("last_event_ts").alias("last_event_ts"),
    )


def together(steps: Sequence[Callable[[], None]], at_once: int = 4) -> None:
    """Run the updates of different tables at once, since each of them has few tasks; the first
    error is raised when all have ended."""
    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()


class GoldTables:
    """The folder of one gold job: what each batch writes and how it is read back.

    ``sample_size`` adds a uniform sample of the whole stream, ``style_widths`` (bin width per
    feature) the driving-style communities of the drivers. With the dimensions ``drivers``
    (driver_id, team_id) and ``teams`` (team_id, name, engine_supplier) the teams of the drivers
    that a batch has become Team nodes and RACES_FOR edges. ``quantiles`` keeps a mergeable sketch
    of the speeds of each lap. ``keep_partials`` also keeps the
    lap aggregates of each batch by themselves, which ``last_batch`` roll-ups read.
    """

    KEYS = {
        "Lap": LAP, "Driver": ["driver_id"], "Session": ["session_id"], "Team": ["team_id"],
        "DROVE_IN": ["driver_id", "session_id"], "COMPLETED_BY": ["lap_id"], "RACES_FOR": ["driver_id"],
        "OVERTAKE": ["src", "dst"], "BATTLE": ["src", "dst"], "pairs": ["session_id", "rel", "src", "dst"],
        "Driver-events": ["driver_id"], "Session-events": ["session_id"], "Driver-names": ["driver_id"],
        "Driver-scores": ["driver_id"], "features": ["driver_id", "session_id"], "speeds": LAP,
    }
    BY = {"Lap": ["session_id"], "pairs": ["session_id"], "speeds": ["session_id"]}

    def __init__(
        self, spark: SparkSession, base: str, sample_size: int | None = None,
        style_widths: dict[str, float] | None = None, drivers: DataFrame | None = None,
        teams: DataFrame | None = None, keep_partials: bool = False, quantiles: bool = False, buckets: int = 32,
    ):
        self.spark = spark
        self.base = base
        self.sample_size = sample_size
        self.style_widths = style_widths
        self.drivers, self.teams = drivers, teams
        self.keep_partials = keep_partials
        self.quantiles = quantiles
        self.buckets = buckets
        self.samples = VersionedTable(spark, f"{base}/sample")

    def table(self, name: str) -> BucketedTable:
        """The table behind a node label or an edge type."""
        return BucketedTable(
            self.spark, f"{self.base}/graph/{name}", self.KEYS[name], self.buckets, by=self.BY.get(name)
        )

    # Batches

    def telemetry_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Laps, drivers, sessions and their edges; an empty batch writes nothing."""
        cleaned = with_ids(batch).persist(StorageLevel.MEMORY_AND_DISK)
        laps = lap_partials(cleaned, sketch_of=None).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if laps.isEmpty():
                return
            steps = [
                lambda: self._laps(laps, batch_id),
                lambda: self.table("Driver").merge(
                    merge_partials(laps, ["driver_id"]), lambda rows: merge_partials(rows, ["driver_id"]), batch_id
                ),
                lambda: self.table("DROVE_IN").merge(_lap_span(laps), lambda rows: _span(rows, self.KEYS["DROVE_IN"]), batch_id),
                lambda: self.table("COMPLETED_BY").insert(
                    laps.filter("lap_number >= 0").select(composite_key(*LAP).alias("lap_id"), "driver_id"), batch_id
                ),
            ]
            if "driver_name" in batch.columns:
                steps.append(lambda: self.table("Driver-names").merge(
                    driver_identity(cleaned), lambda rows: _span(rows, ["driver_id"]), batch_id
                ))
            if self.drivers is not None and self.teams is not None:
                steps.append(lambda: self._racing(laps, batch_id))
            if self.quantiles:
                steps.append(lambda: self.table("speeds").merge(
                    kll_partials(cleaned, LAP, "speed_kph"), lambda rows: merge_kll(rows, LAP), batch_id
                ))
            if self.sample_size is not None:
                steps.append(lambda: self._sample(cleaned, batch_id))
            if self.style_widths is not None:
                steps.append(lambda: self.table("features").merge(feature_partials(cleaned), merged_feature_partials, batch_id))
            together(steps)
            if self.keep_partials:
                write_tables({"laps": laps}, self.base, batch_id)
        finally:
            laps.unpersist()
            cleaned.unpersist()

    def _laps(self, laps: DataFrame, batch_id: int) -> None:
        self.table("Lap").merge(laps, merge_partials, batch_id)
        self.table("Session").upsert(self._sessions_of(laps), "keep", batch_id)

    def _racing(self, laps: DataFrame, batch_id: int) -> None:
        dimension = self.drivers.select("driver_id", "team_id").filter("team_id IS NOT NULL").dropDuplicates(["driver_id"])
        racing = skew_join(laps.select("driver_id").distinct(), dimension, ["driver_id"])
        self.table("RACES_FOR").upsert(racing, "set", batch_id)
        own = skew_join(self.teams, racing.select("team_id").distinct(), ["team_id"], "left_semi")
        self.table("Team").upsert(own, "merge", batch_id)

    def _sessions_of(self, laps: DataFrame) -> DataFrame:
        """The sessions of the batch, counted over all their laps; reads their buckets only."""
        touched = laps.select("session_id").distinct()
        stored = skew_join(self.table("Lap").near(touched), touched, ["session_id"], "left_semi")
        return stored.groupBy("session_id").agg(
            F.count_distinct("driver_id").alias("driver_count"), F.count_distinct("lap_number").alias("lap_count"),
            F.min("first_event_ts").alias("first_event_ts"), F.max("last_event_ts").alias("last_event_ts"),
        )

    def _sample(self, cleaned: DataFrame, batch_id: int) -> None:
        fresh = bottom_k(cleaned, "sequence_number", self.sample_size)
        known = self.samples.read(before=batch_id)
        both = fresh if known is None else known.unionByName(fresh, allowMissingColumns=True)
        self.samples.write(merged_sample(both, "sequence_number", self.sample_size, keep_key=True), batch_id)

    def event_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Drivers and sessions of the events, the latest interaction of each pair of drivers, and
        the number of interactions of each pair and session."""
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        columns = [
            "session_id", "rel", F.col("attacker_id").alias("src"), F.col("defender_id").alias("dst"), "event_id", "event_ts",
            "lap_number", "lap_count", "avg_gap_ms", "delta_time_ms",
        ]
        edges = interactions_of(batch, "overtake", "battle").select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                return
            latest = lambda rows: latest_per_key(rows, ["src", "dst"], ["event_ts", "event_id"])
            newest = lambda rel: self.table(rel).merge(latest(edges.filter(F.col("rel") == rel).drop("rel")), latest, batch_id)
            pair = self.KEYS["pairs"]
            counts = edges.groupBy(*pair).agg(F.count("*").alias("events"))
            total = lambda rows: rows.groupBy(*pair).agg(F.sum("events").alias("events"))
            steps = [
                lambda: self.table("Session-events").merge(session_span(batch), lambda rows: _span(rows, ["session_id"]), batch_id),
                lambda: newest("OVERTAKE"), lambda: newest("BATTLE"), lambda: self.table("pairs").merge(counts, total, batch_id),
            ]
            if "driver_name" in batch.columns:
                steps.append(lambda: self.table("Driver-events").merge(
                    driver_identity(batch), lambda rows: _span(rows, ["driver_id"]), batch_id
                ))
            together(steps)
        finally:
            edges.unpersist()
            batch.unpersist()

    # Reading

    def laps(self, mode: str = "running") -> DataFrame:
        return self.rollup(LAP, mode)

    def rollup(self, keys: list[str], mode: str = "running") -> DataFrame:
        """Aggregates at any level above the lap.

        running: over all batches. last_batch: each key shows its newest batch only.
        """
        if mode == "last_batch":
            partials = last_batch(self.spark.read.parquet(f"{self.base}/laps"), keys)
        else:
            partials = self.table("Lap").read()
        return finish_partials(partials if mode == "running" and keys == LAP else merge_partials(partials, keys))

    def lap_nodes(self) -> DataFrame:
        """Every lap with its averages and extremes."""
        return finish_partials(self.table("Lap").read()).withColumn("lap_id", composite_key(*LAP))

    def sample(self) -> DataFrame:
        """A uniform sample of all rows so far."""
        return merged_sample(self.samples.read(), "sequence_number", self.sample_size)

    def speed_quantiles(self, keys: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
        """Quantiles of the speed at the lap or any level above it."""
        return kll_quantiles(merge_kll(self.table("speeds").read(), keys), keys, probabilities)

    def communities(self) -> DataFrame:
        """The driving-style community of each driver session over all batches."""
        return lsh_communities(merged_features(self.table("features").read()), self.style_widths).drop("hashes")

    def _joined(self, names: Sequence[str], key: str, both: dict[str, Callable]) -> DataFrame | None:
        """Full join of the tables there are; a column of two tables is combined by ``both``."""
        found = None
        for name in names:
            part = self.table(name).read()
            if part is None:
                continue
            if found is None:
                found = part
                continue
            shared = [c for c in part.columns if c in found.columns and c != key]
            renamed = part.withColumnsRenamed({c: f"_{c}" for c in shared})
            joined = found.join(renamed, key, "full")
            found = joined.withColumns({c: both[c](c, f"_{c}") for c in shared}).drop(*[f"_{c}" for c in shared])
        return found

    def driver_nodes(self) -> DataFrame:
        """Every driver of samples or events: name and session range, roll-up of the laps, and
        the scores of the last ``publish``. Drivers that only interactions name are no nodes."""
        both = {"driver_name": F.least, "first_session_id": F.least, "latest_session_id": F.greatest}
        nodes = self._joined(["Driver", "Driver-names", "Driver-events"], "driver_id", both)
        scores = self.table("Driver-scores").read()
        if scores is not None:
            nodes = nodes.join(scores, "driver_id", "left")
        return finish_partials(nodes) if "samples" in nodes.columns else nodes

    def session_nodes(self) -> DataFrame:
        """Every session: drivers and laps, time span from samples and events."""
        both = {"first_event_ts": F.least, "last_event_ts": F.greatest}
        return self._joined(["Session", "Session-events"], "session_id", both)

    def edges(self, rel: str) -> DataFrame:
        """The latest OVERTAKE or BATTLE of each pair whose two drivers are known by now."""
        known = self.driver_nodes().select("driver_id")
        found = self.table(rel).read()
        for end in ("src", "dst"):
            found = skew_join(found, known.withColumnRenamed("driver_id", end), [end], "left_semi")
        return found

    def pagerank(self, **options) -> DataFrame:
        """PageRank of the drivers inside every session."""
        edges = self.table("pairs").read().select("session_id", "src", "dst").distinct()
        return pagerank(None, edges, ["session_id"], **options)

    def publish(self, version: int) -> None:
        """Store PageRank over all interactions and the community of the latest session as
        scores of the drivers; the same version again changes nothing."""
        scores = None
        pairs = self.table("pairs").read()
        if pairs is not None:
            scores = pagerank(None, pairs.select("src", "dst").distinct()).withColumnRenamed("id", "driver_id")
        if self.style_widths is not None:
            newest = self.communities().groupBy("driver_id").agg(F.max_by("community_id", "session_id").alias("community_id"))
            scores = newest if scores is None else scores.join(newest, "driver_id", "full")
        if scores is not None:
            self.table("Driver-scores").upsert(scores, "set", version)

    def vacuum(self, keep: int = 2, retain_seconds: float = 3600.0) -> None:
        """Drop old versions of all tables, see ``BucketedTable.vacuum``; run it between batches."""
        for name in self.KEYS:
            self.table(name).vacuum(keep, retain_seconds)

    # Serving

    def top_overtakers(self) -> DataFrame:
        """Overtakes made per driver and session."""
        made = self.table("pairs").read().filter("rel = 'OVERTAKE'")
        return made.groupBy("session_id", F.col("src").alias("driver_id")).agg(F.sum("events").alias("overtakes"))

    def rivalries(self) -> DataFrame:
        """Interactions of each unordered pair of drivers, by kind."""
        pair = [F.least("src", "dst").alias("driver_a_id"), F.greatest("src", "dst").alias("driver_b_id")]
        count = lambda rel: F.sum(F.when(F.col("rel") == rel, F.col("events")).otherwise(0))
        return self.table("pairs").read().filter("src <> dst").groupBy(*pair).agg(
            count("OVERTAKE").alias("overtakes"), count("BATTLE").alias("battles")
        )

    def team_standings(self) -> DataFrame:
        """Overtakes made by and against the drivers of each team."""
        teams = self.table("RACES_FOR").read().select("driver_id", "team_id")
        pairs = self.table("pairs").read().filter("rel = 'OVERTAKE'")
        sides = None
        for end, name in (("src", "made"), ("dst", "suffered")):
            own = pairs.groupBy(F.col(end).alias("driver_id")).agg(F.sum("events").alias(name))
            sides = own if sides is None else sides.join(own, "driver_id", "full")
        return skew_join(sides, teams, ["driver_id"]).groupBy("team_id").agg(
            F.coalesce(F.sum("made"), F.lit(0)).alias("overtakes_made"),
            F.coalesce(F.sum("suffered"), F.lit(0)).alias("overtakes_suffered"),
        )


def start_gold(
    stream: DataFrame, handler, checkpoint: str, available_now: bool = False,
    interval: str = GOLD_TRIGGER,
) -> StreamingQuery:
    """Run ``handler(batch, batch_id)`` per micro-batch; its errors stop the query."""
    return (
        stream.writeStream.foreachBatch(handler)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(available_now, interval))
        .start()
    )


def await_any(spark: SparkSession, timeout: float | None = None) -> bool | None:
    """Return (or raise) as soon as one of the running queries ends or fails."""
    return spark.streams.awaitAnyTermination(timeout)


def await_all(queries: list[StreamingQuery]) -> None:
    """Wait for queries that end by themselves; a failure of any of them is raised."""
    for query in queries:
        query.awaitTermination()
