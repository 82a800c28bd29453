"""Duplicate marking, cardinality, quantile and frequency sketches, Bloom filter."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapgraph.operators.skew import mark_repeats, skew_join

# Arrival-order columns, first available wins.
ARRIVAL_COLUMNS = ["sequence_number", "kafka_timestamp", "ingested_at", "offset"]


def mark_duplicates(df: DataFrame, key: str, tie: Sequence[str] = ()) -> DataFrame:
    """``is_duplicate`` and its inverse: all but the first arrival of a key.

    Without the key column or any arrival column nothing is a duplicate. ``tie`` orders
    rows that arrived together.
    """
    arrival = [c for c in ARRIVAL_COLUMNS if c in df.columns][:1]
    if key in df.columns and arrival:
        marked = mark_repeats(df, [key], [*arrival, *tie])
    else:
        marked = df.withColumn("is_duplicate", F.lit(False))
    return marked.withColumn("dedup_bloomfilter_flag", ~F.col("is_duplicate"))


def hll_cardinality(df: DataFrame, column: str, precision: int = 12) -> DataFrame:
    """Distinct count from a HyperLogLog sketch with 2**precision registers (4 to 21)."""
    sketch = F.hll_sketch_agg(column, F.lit(precision))
    return df.agg(F.hll_sketch_estimate(sketch).alias("hll_estimate"))


def hll_error(precision: int) -> float:
    """Relative standard error of ``hll_cardinality``."""
    return 1.04 / math.sqrt(2**precision)


def theta_cardinality(df: DataFrame, column: str, precision: int = 12) -> DataFrame:
    """Distinct count from a theta sketch, the alternative to HyperLogLog."""
    sketch = F.theta_sketch_agg(column, F.lit(precision))
    return df.agg(F.theta_sketch_estimate(sketch).alias("theta_estimate"))


def cardinality_comparison(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Exact and sketched distinct count per group; groups with a NULL key are left out.

    The sketch reads the distinct values, which give it the same registers as all rows.
    """
    distinct = df.dropna(subset=list(keys)).select(*keys, column).distinct()
    return distinct.groupBy(*keys).agg(
        F.count(column).alias("exact_unique_count"),
        F.approx_count_distinct(column, 0.05).alias("hll_unique_count"),
    )


def within(estimate: Column, exact: Column, relative: float, slack: float = 1.0) -> Column:
    return F.abs(estimate - exact) <= F.greatest(exact * F.lit(relative), F.lit(slack))


#: The k of a KLL sketch, and the share of rows by which the rank of its quantiles may be off.
KLL_K, KLL_ERROR = 400, 0.01


def kll_partials(df: DataFrame, keys: Sequence[str], value: str, k: int = KLL_K) -> DataFrame:
    """(keys, sketch): a mergeable quantile sketch of whole numbers per group; NULLs do not count."""
    present = df.filter(F.col(value).isNotNull())
    return present.groupBy(*keys).agg(F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), F.lit(k)).alias("sketch"))


def merge_kll(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One sketch per group from sketches of any parts of its rows."""
    return partials.groupBy(*keys).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))


def kll_quantiles(sketches: DataFrame, keys: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(keys, rows, probability, quantile) from one sketch per group."""
    asked = F.array(*[F.lit(float(p)) for p in probabilities])
    both = F.arrays_zip(asked.alias("probability"), F.kll_sketch_get_quantile_bigint("sketch", asked).alias("quantile"))
    rows = sketches.select(*keys, F.kll_sketch_get_n_bigint("sketch").alias("rows"), F.explode(both).alias("_q"))
    return rows.select(*keys, "rows", F.col("_q.probability").alias("probability"), F.col("_q.quantile").alias("quantile"))


def frequent_items(df: DataFrame, item: str, n: int, tracked: int = 100_000) -> DataFrame:
    """The ``n`` most frequent items with their estimated counts, from the engine's own sketch.

    Counts are exact while there are fewer different items than three quarters of ``tracked``.
    """
    found = df.agg(F.expr(f"approx_top_k(`{item}`, {int(n)}, {int(tracked)})").alias("_top"))
    return found.select(F.inline("_top")).select(
        F.col("item").alias(item), F.col("count").alias("estimated_count")
    )
