"""Fact tables and derived metrics: laps, stints, driver sessions, pace, KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapgraph.functions.scalars import composite_key
from lapgraph.operators.ordered import interval_join, neighbour_row, number_runs, overlap_join, running_agg, time_block
from lapgraph.operators.skew import skew_join

LAP = ["session_id", "driver_id", "lap_number"]
LAP_BLOCK = 256
SAMPLE_BLOCK = 100_000

# Fixed value: two-sided 95% normal quantile.
Z95 = 1.96


def ratio(numerator: Column, denominator: Column) -> Column:
    """NULL where the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def fact_lap(telemetry: DataFrame, laps: DataFrame) -> DataFrame:
    """Lap time, sectors and compound of the timed laps beside the sample aggregates."""
    when = F.struct("event_ts", "sequence_number")
    sampled = telemetry.groupBy(*LAP).agg(
        F.min("speed_kph").alias("min_speed_kph"),
        F.avg("speed_kph").alias("avg_speed_kph"),
        F.max("speed_kph").alias("max_speed_kph"),
        (F.min_by("fuel_mass_kg", when) - F.max_by("fuel_mass_kg", when)).alias("fuel_used_kg"),
        (F.max_by("battery_pct", when) - F.min_by("battery_pct", when)).alias("battery_delta_pct"),
    )
    timing = laps.select(
        *LAP, "lap_time_ms", "sector1_ms", "sector2_ms", "sector3_ms",
        F.col("compound").alias("tyre_compound"),
    )
    return sampled.join(timing, LAP, "left")


def with_stints(laps: DataFrame) -> DataFrame:
    """Add ``stint_no`` and ``stint_id``: a new stint starts when the compound changes or
    the previous lap ended in the pits."""
    flagged = laps.withColumn("_pitted", F.col("pit_in").isNotNull())
    numbered = number_runs(
        flagged,
        ["session_id", "driver_id"],
        "lap_number",
        ["compound", "_pitted"],
        lambda prev: ~prev["compound"].eqNullSafe(F.col("compound")) | prev["_pitted"],
        LAP_BLOCK,
        "stint_no",
    )
    return numbered.drop("_pitted").withColumn(
        "stint_id", composite_key("session_id", "driver_id", "stint_no")
    )


def slope(y: str, x: str) -> Column:
    """Least-squares slope of y over x from exact integer sums; NULL for a single x."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xs, ys = F.when(both, F.col(x)).cast("bigint"), F.when(both, F.col(y)).cast("bigint")
    n, sx, sy = F.count(xs), F.sum(xs), F.sum(ys)
    return ratio(n * F.sum(xs * ys) - sx * sy, n * F.sum(xs * xs) - sx * sx)


def fact_stint(stinted_laps: DataFrame, lap_facts: DataFrame) -> DataFrame:
    """Span, average pace, degradation (ms per lap) and fuel of each stint."""
    fuel = lap_facts.select(*LAP, "fuel_used_kg")
    return (
        stinted_laps.join(fuel, LAP, "left")
        .groupBy("session_id", "driver_id", "stint_id")
        .agg(
            F.first("compound", ignorenulls=True).alias("tyre_compound"),
            F.min("lap_number").alias("start_lap"),
            F.max("lap_number").alias("end_lap"),
            F.avg("lap_time_ms").alias("avg_pace_ms"),
            slope("lap_time_ms", "lap_number").alias("degradation_ms_per_lap"),
            F.sum("fuel_used_kg").alias("total_fuel_kg"),
        )
    )


def fact_driver_session(overtake_edges: DataFrame) -> DataFrame:
    """Overtakes made and received, success rate and influence (made minus received, scaled)."""
    sides = overtake_edges.select(
        "session_id",
        F.explode(
            F.array(
                F.struct(F.col("attacker_id").alias("driver_id"), F.lit(1).alias("made"),
                         F.lit(0).alias("received")),
                F.struct(F.col("defender_id").alias("driver_id"), F.lit(0).alias("made"),
                         F.lit(1).alias("received")),
            )
        ).alias("side"),
    ).select("session_id", "side.*")
    made, received = F.col("overtakes_made"), F.col("overtakes_received")
    return (
        sides.groupBy("session_id", "driver_id")
        .agg(F.sum("made").alias("overtakes_made"), F.sum("received").alias("overtakes_received"))
        .withColumn("success_rate", ratio(made, made + received))
        .withColumn("influence_score", ratio(made - received, made + received))
    )


def with_teams(edges: DataFrame, drivers: DataFrame) -> DataFrame:
    """Team of both ends of an edge; unknown drivers get a NULL team."""
    team = drivers.select("driver_id", "team_id")
    left = team.withColumnsRenamed({"driver_id": "attacker_id", "team_id": "attacker_team"})
    right = team.withColumnsRenamed({"driver_id": "defender_id", "team_id": "defender_team"})
    return skew_join(
        skew_join(edges, left, ["attacker_id"], "left"), right, ["defender_id"], "left"
    )


def team_battles(battle_edges: DataFrame, drivers: DataFrame) -> DataFrame:
    """Battles per unordered team pair and their average length in laps."""
    a, b = F.col("attacker_team"), F.col("defender_team")
    return (
        with_teams(battle_edges, drivers)
        .groupBy(F.least(a, b).alias("team_a"), F.greatest(a, b).alias("team_b"))
        .agg(
            F.count("*").alias("battle_count"),
            F.avg("lap_count").alias("avg_battle_laps"),
            F.sum(F.col("lap_count").cast("bigint")).alias("battle_laps"),
        )
    )


def interaction_strength(edges: DataFrame) -> DataFrame:
    """Sum over events of laps times proximity, proximity = 1 / (1 + gap in seconds).

    Summed in millionths, so the total does not depend on the order of the rows.
    """
    laps = F.coalesce(F.col("lap_count"), F.lit(1)).cast("double")
    gap = F.coalesce(F.col("avg_gap_ms"), F.lit(0)).cast("double")
    micro = F.floor(laps * F.lit(1_000_000_000.0) / (F.lit(1000.0) + gap)).cast("bigint")
    return edges.groupBy("session_id", "attacker_id", "defender_id").agg(
        F.count("*").alias("events"),
        F.sum(micro).alias("strength_micro"),
    )


def pace_consistency(laps: DataFrame) -> DataFrame:
    """Mean, spread, 95% interval of the mean and a 0..1 consistency score per driver session."""
    mean, spread, n = F.col("mean_ms"), F.col("stddev_ms"), F.col("laps")
    half = F.lit(Z95) * spread / F.sqrt(n)
    return (
        laps.filter("lap_time_ms IS NOT NULL")
        .groupBy("session_id", "driver_id")
        .agg(
            F.count("*").alias("laps"),
            F.avg("lap_time_ms").alias("mean_ms"),
            F.stddev_samp("lap_time_ms").alias("stddev_ms"),
        )
        .withColumns(
            {
                "ci_low_ms": mean - half,
                "ci_high_ms": mean + half,
                "consistency": F.lit(1.0) / (F.lit(1.0) + F.try_divide(spread, mean)),
            }
        )
    )


def rolling_pace(laps: DataFrame, span: int = 3) -> DataFrame:
    """Average lap time over this lap number and the ``span - 1`` before it.

    Each lap is handed to the laps it counts for, so the shuffle key is one lap, not one
    driver.
    """
    given = laps.select(
        "session_id",
        "driver_id",
        F.col("lap_number").alias("_from"),
        "lap_time_ms",
        F.explode(
            F.sequence(F.col("lap_number"), F.col("lap_number") + F.lit(span - 1))
        ).alias("lap_number"),
    )
    return (
        given.groupBy(*LAP)
        .agg(
            F.avg("lap_time_ms").alias("rolling_pace_ms"),
            F.count("lap_time_ms").alias("laps_used"),
            F.max(F.col("_from") == F.col("lap_number")).alias("_driven"),
        )
        .filter("_driven")
        .drop("_driven")
    )


def tyre_degradation(stinted_laps: DataFrame) -> DataFrame:
    """Lap time lost against the previous lap of the same stint."""
    with_prev = neighbour_row(
        stinted_laps, ["session_id", "driver_id"], "lap_number", ["stint_no", "lap_time_ms"],
        LAP_BLOCK, "_prev",
    )
    same = F.col("_prev.stint_no") == F.col("stint_no")
    return with_prev.select(
        *LAP, "stint_no",
        F.when(same, F.col("lap_time_ms") - F.col("_prev.lap_time_ms")).alias("degradation_ms"),
    )


def pace_deltas(laps: DataFrame) -> DataFrame:
    """Gap of each lap to the session's best lap and to the leader of the same lap."""
    best = laps.groupBy("session_id").agg(F.min("lap_time_ms").alias("best_ms"))
    leader = (
        laps.filter("position IS NOT NULL")
        .groupBy("session_id", "lap_number")
        .agg(F.min_by("lap_time_ms", F.struct("position", "driver_id")).alias("leader_ms"))
    )
    timed = laps.select(*LAP, "lap_time_ms")
    return (
        skew_join(
            skew_join(timed, best, ["session_id"], "left"),
            leader, ["session_id", "lap_number"], "left",
        )
        .withColumn("delta_vs_best_ms", F.col("lap_time_ms") - F.col("best_ms"))
        .withColumn("delta_vs_leader_ms", F.col("lap_time_ms") - F.col("leader_ms"))
        .select(*LAP, "delta_vs_best_ms", "delta_vs_leader_ms")
    )


def zscores(telemetry: DataFrame, metric: str, keys: list[str], limit: float) -> DataFrame:
    """Standard score of a metric within ``keys`` and whether it exceeds ``limit``."""
    stats = telemetry.groupBy(*keys).agg(
        F.avg(metric).alias("_mean"), F.stddev_samp(metric).alias("_sd")
    )
    rows = telemetry.select("sequence_number", *keys, metric)
    score = F.try_divide(F.col(metric) - F.col("_mean"), F.col("_sd"))
    return (
        skew_join(rows, stats, keys)
        .withColumn("zscore", score)
        .withColumn("is_anomaly", F.coalesce(F.abs("zscore") > limit, F.lit(False)))
        .drop("_mean", "_sd")
    )


def enrich_with_dimensions(facts: DataFrame, drivers: DataFrame, teams: DataFrame) -> DataFrame:
    """Driver name and team of every fact row (star join)."""
    team = teams.select("team_id", F.col("name").alias("team_name"), "engine_supplier")
    people = drivers.select("driver_id", "driver_name", "team_id").join(team, "team_id", "left")
    return skew_join(facts, people, ["driver_id"], "left")


def events_in_laps(laps: DataFrame, events: DataFrame, seconds: int = 3600) -> DataFrame:
    """Events of a driver that happened during that driver's laps."""
    spans = laps.select(*LAP, "lap_start", "lap_end").filter("lap_end IS NOT NULL")
    happened = events.select("session_id", "driver_id", "event_id", "event_type", "event_ts")
    return interval_join(
        happened, spans, ["session_id", "driver_id"], "event_ts", "lap_start", "lap_end", seconds
    )


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def merge_periods(periods: DataFrame, seconds: int) -> DataFrame:
    """(session_id, period_start, period_end): the union of the given periods per session.

    A period joins those before it if it starts no later than the latest end so far. Periods
    that end before they start cover nothing. ``seconds`` is the width of the time blocks.
    """
    width, keys, tie = seconds * 1_000_000, ["session_id"], ["period_end"]
    given = periods.filter("period_start <= period_end").select(
        "session_id", "period_start", "period_end", _micros("period_start").alias("_at")
    ).distinct()
    reached = running_agg(given, keys, "_at", "period_end", width, "_reach", F.max, tie)
    before = neighbour_row(reached, keys, "_at", ["_reach"], width, "_prev", tie=tie)
    opens = F.coalesce(F.col("period_start") > F.col("_prev._reach"), F.lit(True)).cast("int")
    numbered = running_agg(
        before.withColumn("_opens", opens), keys, "_at", "_opens", width, "_period", tie=tie
    )
    return numbered.groupBy("session_id", "_period").agg(
        F.min("period_start").alias("period_start"), F.max("period_end").alias("period_end")
    ).drop("_period")


def laps_under_safety_car(laps: DataFrame, periods: DataFrame, seconds: int) -> DataFrame:
    """Seconds of each lap inside safety-car periods; laps without any are left out."""
    spans = laps.filter("lap_end IS NOT NULL").select(*LAP, "lap_start", "lap_end")
    both = overlap_join(
        spans, merge_periods(periods, seconds), ["session_id"],
        ("lap_start", "lap_end"), ("period_start", "period_end"), seconds,
    )
    end = F.least(_micros("lap_end"), _micros("period_end"))
    start = F.greatest(_micros("lap_start"), _micros("period_start"))
    return both.groupBy(*LAP).agg((F.sum(end - start) / 1e6).alias("safety_car_seconds"))


def interaction_nodes(edges: DataFrame) -> DataFrame:
    """One node per (session, unordered driver pair)."""
    a, b = F.col("attacker_id"), F.col("defender_id")
    return (
        edges.groupBy("session_id", F.least(a, b).alias("driver_a"), F.greatest(a, b).alias("driver_b"))
        .agg(
            F.avg("interaction_strength").alias("avg_strength"),
            F.approx_count_distinct("event_id", 0.05).alias("unique_interactions"),
            F.count("*").alias("interactions"),
        )
        .withColumn("interaction_id", composite_key("session_id", "driver_a", "driver_b"))
    )


def sector_comparisons(telemetry: DataFrame) -> DataFrame:
    """Average speed of a driver in a micro sector minus the session's average there."""
    sector = ["session_id", "micro_sector_id"]
    own = telemetry.groupBy(*sector, "driver_id").agg(
        F.sum("speed_kph").alias("_s"), F.count("speed_kph").alias("_n")
    )
    field = own.groupBy(*sector).agg(F.sum("_s").alias("_fs"), F.sum("_n").alias("_fn"))
    delta = ratio(F.col("_s"), F.col("_n")) - ratio(F.col("_fs"), F.col("_fn"))
    return skew_join(own, field, sector).select(
        *sector,
        "driver_id",
        delta.alias("avg_delta"),
        composite_key("session_id", "driver_id", "micro_sector_id").alias("sector_comp_id"),
    )


def _with_previous_sample(telemetry: DataFrame) -> DataFrame:
    return neighbour_row(
        telemetry, LAP, "sequence_number",
        ["speed_kph", "throttle_pct", "brake_pressure_bar", "event_ts", "flag_state"],
        SAMPLE_BLOCK, "prev",
    )


def lap_kpis(telemetry: DataFrame) -> DataFrame:
    """Handling metrics per lap.

    braking efficiency: speed shed per braking sample; corner exit: mean speed where throttle
    rises after braking; straight: top speed; blue flag: seconds from each blue-flag sample to
    the next sample.
    """
    steps = _with_previous_sample(telemetry)
    shed = F.greatest(F.col("prev.speed_kph") - F.col("speed_kph"), F.lit(0))
    exits = (F.col("prev.brake_pressure_bar") > 0) & (F.col("throttle_pct") > F.col("prev.throttle_pct"))
    gap = F.unix_seconds(F.col("event_ts").cast("timestamp")) - F.unix_seconds(
        F.col("prev.event_ts").cast("timestamp")
    )
    return (
        steps.groupBy(*LAP)
        .agg(
            F.sum(shed).alias("_shed"),
            F.count_if(F.col("brake_pressure_bar") > 0).alias("braking_samples"),
            F.avg(F.when(exits, F.col("speed_kph"))).alias("corner_exit_speed"),
            F.max("speed_kph").alias("straight_speed"),
            F.coalesce(
                F.sum(F.when(F.col("prev.flag_state") == "BLUE", gap)), F.lit(0)
            ).alias("blue_flag_seconds"),
        )
        .withColumn("braking_efficiency", ratio(F.col("_shed"), F.col("braking_samples")))
        .drop("_shed")
    )


def acceleration_times(telemetry: DataFrame, low: float, high: float) -> DataFrame:
    """Seconds from the last sample at or below ``low`` before the first sample at or above
    ``high`` to that sample, per lap; laps that never do both give no row."""
    first_fast = (
        telemetry.filter(F.col("speed_kph") >= high)
        .groupBy(*LAP)
        .agg(F.min("event_ts").alias("fast_ts"))
    )
    slow = telemetry.filter(F.col("speed_kph") <= low).select(*LAP, "event_ts")
    seconds = F.unix_seconds(F.col("fast_ts").cast("timestamp")) - F.unix_seconds(
        F.col("slow_ts").cast("timestamp")
    )
    return (
        skew_join(slow, first_fast, LAP)
        .filter("event_ts < fast_ts")
        .groupBy(*LAP)
        .agg(F.max("event_ts").alias("slow_ts"), F.first("fast_ts").alias("fast_ts"))
        .select(*LAP, seconds.alias("acceleration_s"))
    )


def pit_efficiency(stops: DataFrame) -> DataFrame:
    """Stop duration over the median duration of its session.

    The median is the middle element by (duration, key): rank 1 + floor((n - 1) / 2).
    """
    counted = stops.groupBy("session_id", "pit_duration_ms").agg(F.count("*").alias("_n"))
    total = counted.groupBy("session_id").agg(F.sum("_n").alias("_total"))
    ranked = running_agg(counted, ["session_id"], "pit_duration_ms", "_n", 1000, "_upto")
    median = (
        skew_join(ranked, total, ["session_id"])
        .filter(F.col("_upto") >= F.floor((F.col("_total") - 1) / 2) + 1)
        .groupBy("session_id")
        .agg(F.min("pit_duration_ms").alias("median_ms"))
    )
    return skew_join(stops, median, ["session_id"]).withColumn(
        "pit_ratio", ratio(F.col("pit_duration_ms"), F.col("median_ms"))
    )


def overtake_tags(
    overtakes: DataFrame, lap_samples: DataFrame, pits: DataFrame
) -> DataFrame:
    """Tag overtakes: the defender pitted on that lap (undercut), else the attacker used DRS
    on it, else braked on it, else on track."""
    drs = lap_samples.groupBy(*LAP).agg(
        F.max(F.col("drs_state") == "ON").alias("_drs"),
        F.max(F.col("brake_pressure_bar") > 0).alias("_brake"),
    ).withColumnRenamed("driver_id", "attacker_id")
    pitted = (
        pits.select("session_id", F.col("driver_id").alias("defender_id"), "lap_number")
        .distinct()
        .withColumn("_pitted", F.lit(True))
    )
    tag = (
        F.when(F.col("_pitted"), "undercut")
        .when(F.col("_drs"), "drs")
        .when(F.col("_brake"), "under_braking")
        .otherwise("on_track")
    )
    return (
        overtakes.join(drs, ["session_id", "attacker_id", "lap_number"], "left")
        .join(pitted, ["session_id", "defender_id", "lap_number"], "left")
        .withColumn("overtake_type", tag)
        .drop("_drs", "_brake", "_pitted")
    )
