"""Duplicates, cardinalities, quantiles, frequencies, Bloom filters, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapgraph.operators import sampling, sketches
from lapgraph.plans.registry import query


@query("WIN1_mark_duplicates", """
    SELECT row_hash, l_shipdate AS kafka_timestamp, l_partkey, l_suppkey, l_quantity, l_extendedprice,
           rn > 1 AS is_duplicate, rn = 1 AS dedup_bloomfilter_flag
    FROM (SELECT *, row_number() OVER (PARTITION BY row_hash
             ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM dup_rows) d
""")
def mark_duplicates(fx):
    tie = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    rows = fx.dup_rows.withColumnRenamed("l_shipdate", "kafka_timestamp").select(
        "row_hash", "kafka_timestamp", *tie
    )
    return sketches.mark_duplicates(rows, "row_hash", tie)


def _exact_beside(estimate, exact, column: str, relative: float):
    """One row: the exact count and whether the estimate is close enough."""
    return exact.withColumn("_estimate", estimate.select(column).scalar()).select(
        "exact_count", sketches.within(F.col("_estimate"), F.col("exact_count"), relative).alias("within_bound")
    )


@query("AGG10_hll_cardinality", "SELECT count(DISTINCT l_orderkey) AS exact_count, TRUE AS within_bound FROM lineitem")
def hll_cardinality(fx):
    exact = fx.lineitem.agg(F.count_distinct("l_orderkey").alias("exact_count"))
    sketch = sketches.hll_cardinality(fx.lineitem, "l_orderkey", 14)
    return _exact_beside(sketch, exact, "hll_estimate", 3 * sketches.hll_error(14))


@query("AGG23_theta_cardinality", "SELECT count(DISTINCT l_partkey) AS exact_count, TRUE AS within_bound FROM lineitem")
def theta_cardinality(fx):
    exact = fx.lineitem.agg(F.count_distinct("l_partkey").alias("exact_count"))
    return _exact_beside(
        sketches.theta_cardinality(fx.lineitem, "l_partkey", 12), exact, "theta_estimate", 0.06
    )


EXACT = """
    SELECT session_id, micro_sector_id, count(DISTINCT {column}) AS exact_unique_count, TRUE AS within_bound
    FROM telemetry GROUP BY session_id, micro_sector_id
"""


def _comparison(fx, column: str):
    keys = ["session_id", "micro_sector_id"]
    both = sketches.cardinality_comparison(fx.telemetry, keys, column)
    good = sketches.within(F.col("hll_unique_count"), F.col("exact_unique_count"), 0.15, 2.0)
    return both.withColumn("within_bound", good).drop("hll_unique_count")


@query("AGG11_exact_and_sketch", EXACT.format(column="speed_kph"))
def exact_and_sketch(fx):
    return _comparison(fx, "speed_kph")


@query("JN3_cardinality_join", """
    SELECT session_id, count(DISTINCT driver_id) AS exact_unique_count, TRUE AS within_bound
    FROM dirty WHERE session_id IS NOT NULL GROUP BY session_id
""")
def cardinality_join(fx):
    both = sketches.cardinality_comparison(fx.dirty, ["session_id"], "driver_id")
    good = sketches.within(F.col("hll_unique_count"), F.col("exact_unique_count"), 0.15, 2.0)
    return both.withColumn("within_bound", good).drop("hll_unique_count")


PROBABILITIES = [0.25, 0.5, 0.75, 0.95]
QUANTILE_CHECK = """
    SELECT session_id, count({value}) AS rows, p AS probability, TRUE AS within_bound
    FROM {table}, (SELECT unnest([0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE, 0.95::DOUBLE]) AS p) q
    WHERE {value} IS NOT NULL GROUP BY session_id, p
"""


def _ranked(quantiles, rows, value: str):
    """Whether the reported quantiles have about the rank they should, counted in the rows."""
    found = quantiles.join(rows.select("session_id", value), "session_id").groupBy(*quantiles.columns).agg(
        F.count_if(F.col(value) < F.col("quantile")).alias("below"), F.count_if(F.col(value) <= F.col("quantile")).alias("rank")
    )
    target, slack = F.col("probability") * F.col("rows"), F.col("rows") * F.lit(sketches.KLL_ERROR) + 1
    good = (F.col("below") - slack <= target) & (target <= F.col("rank") + slack)
    return found.select("session_id", "rows", "probability", good.alias("within_bound"))


@query("AGG23_quantiles", QUANTILE_CHECK.format(value="lap_time_ms", table="laps"))
def quantiles(fx):
    laps = fx.laps.filter("lap_time_ms IS NOT NULL")
    sketch = sketches.kll_partials(laps, ["session_id"], "lap_time_ms")
    return _ranked(sketches.kll_quantiles(sketch, ["session_id"], PROBABILITIES), laps, "lap_time_ms")


@query("AGG23_merged_quantiles", QUANTILE_CHECK.format(value="speed_kph", table="telemetry"))
def merged_quantiles(fx):
    """Sketches of each lap in each of five batches, merged to sessions."""
    key = ["session_id", "lap_number"]
    partials = None
    for batch in range(5):
        part = sketches.kll_partials(fx.telemetry.filter(F.col("sequence_number") % 5 == batch), key, "speed_kph")
        partials = part if partials is None else partials.unionByName(part)
    merged = sketches.merge_kll(sketches.merge_kll(partials, key), ["session_id"])
    return _ranked(sketches.kll_quantiles(merged, ["session_id"], PROBABILITIES), fx.telemetry, "speed_kph")


@query("AGG23_frequent_items", """
    SELECT l_suppkey, count(*) AS exact_count, TRUE AS within_bound FROM lineitem
    GROUP BY l_suppkey ORDER BY count(*) DESC, l_suppkey LIMIT 50
""")
def frequent_items(fx):
    """The fifty most frequent suppliers by the sketch, each estimate beside the exact count."""
    top = sketches.frequent_items(fx.lineitem, "l_suppkey", 10_000)
    named = top.orderBy(F.desc("estimated_count"), "l_suppkey").limit(50)
    exact = fx.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("exact_count"))
    total = fx.lineitem.agg(F.count("*")).scalar()
    off = F.abs(F.col("estimated_count") - F.col("exact_count"))
    return named.join(exact, "l_suppkey").select(
        "l_suppkey", "exact_count", (off <= F.ceil(total / F.lit(100_000))).alias("within_bound")
    )


RETURNED = "row_hash IN (SELECT row_hash FROM dup_rows WHERE l_returnflag = 'R')"


def _history(fx):
    return fx.dup_rows.filter("l_returnflag = 'R'").select("row_hash").distinct()


@query("BLM1_bloom_filter", f"""
    SELECT count(*) AS probes, count(*) FILTER (WHERE known) AS members
    FROM (SELECT {RETURNED} AS known FROM dup_rows) p
""")
def membership(fx):
    """How many of all rows are among the returned ones. The engine puts its own Bloom filter
    before such a join where sizes call for one."""
    known = _history(fx).withColumn("_known", F.lit(True))
    probed = fx.dup_rows.select("row_hash").join(known, "row_hash", "left")
    return probed.agg(F.count("*").alias("probes"), F.count("_known").alias("members"))


@query("BLM1_prefiltered_new_rows", f"""
    SELECT row_hash, l_shipdate, l_partkey, l_suppkey FROM dup_rows WHERE NOT {RETURNED}
""")
def new_rows(fx):
    """Rows that the history has not seen."""
    batch = fx.dup_rows.select("row_hash", "l_shipdate", "l_partkey", "l_suppkey")
    return batch.join(_history(fx), "row_hash", "left_anti")


@query("TOP1_uniform_sample", """
    SELECT sequence_number, session_id, speed_kph FROM telemetry
    ORDER BY md5(concat('42_', CAST(sequence_number AS STRING))), sequence_number LIMIT 1000
""")
def uniform_sample(fx):
    return sampling.uniform_sample(
        fx.telemetry.select("sequence_number", "session_id", "speed_kph"), "sequence_number"
    )


UNIT = "((CAST('0x' || substr(md5(concat('42_', CAST({ident} AS STRING))), 1, 13) AS BIGINT))::DOUBLE + 0.5) / 4503599627370496.0"


@query("TOP2_weighted_sample", f"""
    SELECT sequence_number, speed_kph FROM telemetry WHERE speed_kph > 0
    ORDER BY ln({UNIT.format(ident="sequence_number")}) / speed_kph DESC, sequence_number LIMIT 500
""")
def weighted_sample(fx):
    return sampling.weighted_sample(
        fx.telemetry.select("sequence_number", "speed_kph"), "sequence_number", "speed_kph", 500
    )


@query("TOP3_adaptive_sample", f"""
    SELECT sequence_number, session_id, round(sampling_rate, 6) AS sampling_rate
    FROM (SELECT *, least(1.0::DOUBLE, 300.0::DOUBLE / count(*) OVER (PARTITION BY session_id)) AS sampling_rate FROM telemetry) t
    WHERE {UNIT.format(ident="sequence_number")} < sampling_rate
""")
def adaptive_sample(fx):
    return sampling.adaptive_sample(
        fx.telemetry.select("sequence_number", "session_id"), "sequence_number", ["session_id"], 300
    )
