"""Race events from lap tables: completions, pit stops, overtakes, battles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapgraph.functions.scalars import (
    content_hash, correlation_id, event_key, millis_between, sampling_weight,
)
from lapgraph.operators.ordered import (
    asof_forward, block_of, lower_side_keys, number_runs, upper_side_keys,
)
from lapgraph.operators.selection import every_nth
from lapgraph.operators.skew import skew_join

# How strongly each event type counts as an interaction.
LAP_STRENGTH = 1.0
PIT_STRENGTH = 2.0
OVERTAKE_STRENGTH = 3.0
BATTLE_STRENGTH = 2.5

POSITION_BLOCK = 32
LAP_BLOCK = 256
SAMPLE_BLOCK_SECONDS = 3600


def _json(**fields: Column) -> Column:
    """JSON object text that spells NULL fields out."""
    return F.to_json(
        F.struct(*[value.alias(name) for name, value in fields.items()]),
        {"ignoreNullFields": "false"},
    )


def lap_completions(laps: DataFrame) -> DataFrame:
    """One event per lap with a known end. ``position_delta`` holds the position itself."""
    payload_fields = [
        "lap_time_ms", "sector1_ms", "sector2_ms", "sector3_ms",
        "compound", "tyre_life", "stint", "fresh_tyre",
    ]
    key = event_key("lap", "session_id", "driver_id", "lap_number")
    return laps.filter("lap_end IS NOT NULL").select(
        "session_id",
        key.alias("event_id"),
        F.col("lap_end").alias("event_ts"),
        F.lit("LAP_COMPLETION").alias("event_type"),
        "driver_id",
        "driver_name",
        "lap_number",
        _json(**{f: F.col(f) for f in payload_fields}).alias("payload"),
        F.md5(key).alias("event_hash"),
        F.lit(LAP_STRENGTH).alias("interaction_strength"),
        F.col("position").alias("position_delta"),
    )


def pit_stops(laps: DataFrame) -> DataFrame:
    """One event per pit entry; without an exit time the stop lasts 0 ms.

    Like completions, only laps with a known end are looked at.
    """
    out = F.coalesce("pit_out", "pit_in")
    key = event_key("pit", "session_id", "driver_id", "lap_number")
    duration = millis_between(F.col("pit_in"), out)
    return laps.filter("lap_end IS NOT NULL AND pit_in IS NOT NULL").select(
        "session_id",
        key.alias("event_id"),
        F.col("pit_in").alias("event_ts"),
        F.lit("PIT_STOP").alias("event_type"),
        "driver_id",
        "driver_name",
        "lap_number",
        F.concat_ws("_", F.lit("pit"), "driver_id", F.col("stint").cast("string")).alias(
            "pit_stop_id"
        ),
        duration.alias("pit_duration_ms"),
        _json(
            compound_before=F.col("compound"),
            pit_in_time=F.col("pit_in").cast("string"),
            pit_out_time=out.cast("string"),
        ).alias("payload"),
        F.md5(key).alias("event_hash"),
        F.lit(PIT_STRENGTH).alias("interaction_strength"),
        _json(type=F.lit("pit_stop"), duration_ms=duration).alias("strategic_context"),
    )


def position_moves(laps: DataFrame) -> DataFrame:
    """Laps with a position on this lap and on the lap numbered exactly one less.

    Each lap is handed to itself and to the next lap number and the two meet in one
    grouping, so the laps are read once.
    """
    measures = {
        "position": "position", "lap_end": "lap_end", "lap_time_ms": "lap_time_ms",
        "prev_position": "position", "prev_lap_end": "lap_end",
    }

    def role(step: int) -> Column:
        fields = [(F.col("lap_number") + step).alias("at")]
        for name, source in measures.items():
            mine = name.startswith("prev_") == (step == 1)
            value = F.col(source) if mine else F.lit(None).cast(laps.schema[source].dataType)
            fields.append(value.alias(name))
        return F.struct(*fields)

    return (
        laps.filter("position IS NOT NULL")
        .select("session_id", "driver_id", F.explode(F.array(role(0), role(1))).alias("r"))
        .groupBy("session_id", "driver_id", F.col("r.at").alias("lap_number"))
        .agg(*[F.max(f"r.{name}").alias(name) for name in measures])
        .filter("position IS NOT NULL AND prev_position IS NOT NULL")
    )


def overtaken_pairs(laps: DataFrame) -> DataFrame:
    """(attacker, defender) rows: behind on the previous lap, ahead on this one.

    Both inequalities become equi keys over blocks of positions, so a task compares drivers
    of one block pair and never all drivers of a lap; for grids within one block this is a
    plain join on (session, lap).
    """
    highest = laps.agg(F.max("position")).scalar()
    top_block = F.floor(F.coalesce(highest, F.lit(0)) / POSITION_BLOCK)
    moves = position_moves(laps).withColumn(
        "_levels", F.when(top_block > 0, F.length(F.bin(top_block))).otherwise(0)
    )
    levels = F.col("_levels")
    attackers = moves.filter("position < prev_position").select(
        "session_id", "lap_number", "lap_end", "prev_lap_end",
        F.col("driver_id").alias("attacker_id"),
        F.col("position").alias("a_cur"),
        F.col("prev_position").alias("a_prev"),
        F.col("lap_time_ms").alias("a_time"),
        "_levels",
        F.explode(upper_side_keys(F.col("prev_position"), POSITION_BLOCK, levels)).alias("prev_key"),
    ).withColumn("cur_key", F.explode(lower_side_keys(F.col("a_cur"), POSITION_BLOCK, levels)))
    defenders = moves.select(
        "session_id", "lap_number",
        F.col("driver_id").alias("defender_id"),
        F.col("position").alias("d_cur"),
        F.col("prev_position").alias("d_prev"),
        F.col("lap_time_ms").alias("d_time"),
        F.col("prev_lap_end").alias("d_prev_lap_end"),
        "_levels",
        F.explode(lower_side_keys(F.col("prev_position"), POSITION_BLOCK, levels)).alias("prev_key"),
    ).withColumn("cur_key", F.explode(upper_side_keys(F.col("d_cur"), POSITION_BLOCK, levels)))
    on = ["session_id", "lap_number", "prev_key", "cur_key"]
    return (
        attackers.drop("_levels")
        .join(defenders.drop("_levels"), on)
        .filter("d_prev < a_prev AND d_cur > a_cur")
    )


def overtakes(laps: DataFrame, max_gap_ms: int | None = None) -> DataFrame:
    """One event per (attacker, defender, lap).

    ``max_gap_ms`` adds the strict rule: at the end of the previous lap the two were closer
    than this. Laps without an end time give no event; unknown lap times give NULL deltas.
    """
    pairs = overtaken_pairs(laps).filter("lap_end IS NOT NULL")
    if max_gap_ms is not None:
        gap = F.abs(millis_between(F.col("d_prev_lap_end"), F.col("prev_lap_end")))
        pairs = pairs.filter(gap < max_gap_ms)
    delta = F.col("d_time") - F.col("a_time")
    gained = F.col("a_prev") - F.col("a_cur")
    key = event_key("overtake", "session_id", "attacker_id", "defender_id", "lap_number")
    return pairs.select(
        "session_id",
        key.alias("event_id"),
        F.col("lap_end").alias("event_ts"),
        F.lit("OVERTAKE").alias("event_type"),
        F.col("attacker_id").alias("driver_id"),
        "attacker_id",
        "defender_id",
        "lap_number",
        F.lit(1).alias("lap_count"),
        F.abs(delta).alias("avg_gap_ms"),
        delta.alias("delta_time_ms"),
        F.md5(key).alias("event_hash"),
        F.lit(OVERTAKE_STRENGTH).alias("interaction_strength"),
        gained.alias("position_delta"),
    ).transform(_with_interaction_text)


def adjacent_pairs(laps: DataFrame) -> DataFrame:
    """Neighbours by position on each lap, at most one place apart.

    ``ahead_*``/``behind_*`` follow the track, ``driver_a``/``driver_b`` the alphabet.
    """
    block = block_of(F.col("position"), POSITION_BLOCK)
    # The first place of a block is also shown to the block before, where it can only follow.
    shown = F.when(F.col("position") % POSITION_BLOCK == 0, F.array(block, block - 1)).otherwise(
        F.array(block)
    )
    placed = laps.filter("position IS NOT NULL").select(
        "session_id", "lap_number", "driver_id", "position", "lap_time_ms", "lap_end",
        block.alias("_own"), F.explode(shown).alias("_block"),
    )
    order = Window.partitionBy("session_id", "lap_number", "_block").orderBy("position", "driver_id")
    follower = F.struct("driver_id", "position", "lap_time_ms", "lap_end")
    with_next = placed.withColumn("behind", F.lead(follower).over(order)).filter("_block = _own")
    return with_next.filter("behind.position - position <= 1").select(
        "session_id",
        "lap_number",
        F.least("driver_id", "behind.driver_id").alias("driver_a"),
        F.greatest("driver_id", "behind.driver_id").alias("driver_b"),
        F.col("driver_id").alias("ahead_id"),
        F.col("lap_time_ms").alias("ahead_time"),
        F.col("lap_end").alias("ahead_end"),
        F.col("behind.lap_time_ms").alias("behind_time"),
        F.col("behind.lap_end").alias("behind_end"),
    )


def consecutive_groups(pairs: DataFrame) -> DataFrame:
    """Runs of consecutive laps per pair: first lap, length, and the first lap's timing."""
    pair = ["session_id", "driver_a", "driver_b"]
    runs = number_runs(
        pairs,
        pair,
        "lap_number",
        ["lap_number"],
        lambda prev: F.col("lap_number") != prev["lap_number"] + 1,
        LAP_BLOCK,
        "run_no",
    )
    timing = F.struct("ahead_time", "ahead_end", "behind_time")
    return (
        runs.groupBy(*pair, "run_no")
        .agg(
            F.min("lap_number").alias("lap_number"),
            F.count("*").cast("int").alias("lap_count"),
            F.min_by(timing, "lap_number").alias("_first"),
        )
        .select(*pair, "lap_number", "lap_count", "_first.*")
    )


def battles(laps: DataFrame, min_laps: int = 2, max_gap_ms: int | None = None) -> DataFrame:
    """One event per run of at least ``min_laps`` laps next to each other.

    The event belongs to the alphabetically first driver; the time delta is behind minus
    ahead on the first lap. ``max_gap_ms`` keeps only laps ended closer together than this.
    """
    pairs = adjacent_pairs(laps)
    if max_gap_ms is not None:
        pairs = pairs.filter(
            F.abs(millis_between(F.col("ahead_end"), F.col("behind_end"))) < max_gap_ms
        )
    groups = consecutive_groups(pairs).filter(
        (F.col("lap_count") >= min_laps) & F.col("ahead_end").isNotNull()
    )
    delta = F.col("behind_time") - F.col("ahead_time")
    key = event_key("battle", "session_id", "driver_a", "driver_b", "lap_number")
    return groups.select(
        "session_id",
        key.alias("event_id"),
        F.col("ahead_end").alias("event_ts"),
        F.lit("BATTLE").alias("event_type"),
        F.col("driver_a").alias("driver_id"),
        F.col("driver_a").alias("driver_a_id"),
        F.col("driver_b").alias("driver_b_id"),
        "lap_number",
        "lap_count",
        F.abs(delta).alias("avg_gap_ms"),
        delta.alias("delta_time_ms"),
        F.md5(key).alias("event_hash"),
        F.lit(BATTLE_STRENGTH).alias("interaction_strength"),
    ).transform(_with_battle_text)


def _with_interaction_text(events: DataFrame) -> DataFrame:
    note = F.concat(
        "attacker_id", F.lit(" overtook "), "defender_id", F.lit(" on lap "), "lap_number"
    )
    return events.withColumns(
        {
            "payload": _json(
                attacker_id=F.col("attacker_id"),
                defender_id=F.col("defender_id"),
                lap_number=F.col("lap_number"),
                lap_count=F.col("lap_count"),
                avg_gap_ms=F.col("avg_gap_ms"),
                delta_time_ms=F.col("delta_time_ms"),
                notes=note,
            ),
            "strategic_context": _json(
                type=F.lit("overtake"), positions_gained=F.col("position_delta")
            ),
            "sector_time_delta_ms": F.col("delta_time_ms"),
        }
    )


def _with_battle_text(events: DataFrame) -> DataFrame:
    note = F.concat(
        "driver_a_id", F.lit(" and "), "driver_b_id", F.lit(" battled for "), "lap_count",
        F.lit(" laps starting at lap "), "lap_number",
    )
    return events.withColumns(
        {
            "payload": _json(
                driver_a_id=F.col("driver_a_id"),
                driver_b_id=F.col("driver_b_id"),
                lap_number=F.col("lap_number"),
                lap_count=F.col("lap_count"),
                avg_gap_ms=F.col("avg_gap_ms"),
                delta_time_ms=F.col("delta_time_ms"),
                battle_type=F.lit("position_battle"),
                notes=note,
            ),
            "strategic_context": _json(type=F.lit("battle"), lap_count=F.col("lap_count")),
            "sector_time_delta_ms": F.col("delta_time_ms"),
        }
    )


EVENT_COLUMNS = [
    "session_id", "event_id", "event_ts", "event_type", "driver_id", "driver_name", "lap_number",
    "pit_stop_id", "pit_duration_ms", "payload", "event_hash", "interaction_strength",
    "strategic_context", "position_delta", "sector_time_delta_ms",
]


def with_driver_names(events: DataFrame, drivers: DataFrame) -> DataFrame:
    """Display name: the dimension's abbreviation, then its full name, then the id."""
    names = drivers.select("driver_id", F.coalesce("abbreviation", "full_name").alias("_name"))
    return skew_join(events.drop("driver_name"), names, ["driver_id"], "left").withColumn(
        "driver_name", F.coalesce("_name", "driver_id")
    ).drop("_name")


def race_events(laps: DataFrame, drivers: DataFrame) -> DataFrame:
    """All four event types in one table."""
    laps = laps.drop("driver_name").withColumn("driver_name", F.lit(None).cast("string"))
    streams = [lap_completions(laps), pit_stops(laps), overtakes(laps), battles(laps)]
    merged = streams[0]
    for stream in streams[1:]:
        merged = merged.unionByName(stream, allowMissingColumns=True)
    return with_driver_names(merged, drivers).select(*EVENT_COLUMNS)


def latest_weather(weather: DataFrame, columns: list[str]) -> DataFrame:
    """The last reading of each session."""
    reading = F.struct(*columns)
    order = F.struct("event_ts", *columns)
    return weather.groupBy("session_id").agg(F.max_by(reading, order).alias("_w")).select(
        "session_id", "_w.*"
    )


def with_laps(samples: DataFrame, laps: DataFrame, payload: list[str]) -> DataFrame:
    """Each sample's lap: the first of its driver that ends at or after it, else lap 0."""
    matched = asof_forward(
        samples.drop("lap_number", *[p for p in payload if p in samples.columns]),
        laps,
        ["session_id", "driver_id"],
        "event_ts",
        "lap_end",
        ["lap_number", *payload],
        SAMPLE_BLOCK_SECONDS,
        "_lap",
    )
    return matched.select(
        *[c for c in matched.columns if c != "_lap"],
        F.coalesce("_lap.lap_number", F.lit(0)).alias("lap_number"),
        *[F.col(f"_lap.{p}").alias(p) for p in payload],
    )


def telemetry_records(
    samples: DataFrame,
    laps: DataFrame,
    weather: DataFrame,
    payload: list[str],
    weather_columns: list[str],
    sample_rate: int = 1,
) -> DataFrame:
    """Samples with lap, tyre, weather, hash, weight and correlation id."""
    timed = every_nth(samples.filter("event_ts IS NOT NULL"), sample_rate)
    placed = with_laps(timed, laps, payload)
    weathered = skew_join(
        placed, latest_weather(weather, weather_columns), ["session_id"], "left"
    )
    return weathered.withColumns(
        {
            "telemetry_hash": content_hash(
                F.col("session_id"), F.col("driver_id"), F.col("sequence_number"),
                F.unix_micros(F.col("event_ts").cast("timestamp")),
            ),
            "sampling_weight": sampling_weight(F.col("sequence_number")),
            "correlation_id": correlation_id("session_id", "driver_id", "lap_number"),
        }
    )
