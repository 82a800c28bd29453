"""Repeatable samples. Keys come from md5 of (seed, id), so a sample does not depend on
partitioning and a recomputed task draws the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapgraph.operators.skew import skew_join

# Fixed value: 13 hex digits of md5 give 52 bits, exact in a double.
HEX_DIGITS = 13


def sample_key(seed: int, ident: str) -> Column:
    return F.md5(F.concat_ws("_", F.lit(str(seed)), F.col(ident).cast("string")))


def unit_random(seed: int, ident: str) -> Column:
    """Uniform in (0, 1), fixed by seed and id."""
    digits = F.conv(F.substring(sample_key(seed, ident), 1, HEX_DIGITS), 16, 10)
    return (digits.cast("double") + F.lit(0.5)) / F.lit(float(16**HEX_DIGITS))


def uniform_sample(df: DataFrame, ident: str, size: int = 1000, seed: int = 42) -> DataFrame:
    """Exactly ``size`` rows (or all, if fewer), each equally likely."""
    return df.withColumn("_key", sample_key(seed, ident)).orderBy("_key", ident).limit(size).drop("_key")


def bottom_k(df: DataFrame, ident: str, size: int = 1000, seed: int = 42) -> DataFrame:
    """The ``size`` + 1 rows with the smallest keys, with their ``_key``: a part of the stream
    from which ``merged_sample`` makes the sample of all parts."""
    return df.withColumn("_key", sample_key(seed, ident)).orderBy("_key", ident).limit(size + 1)


def merged_sample(parts: DataFrame, ident: str, size: int = 1000, keep_key: bool = False) -> DataFrame:
    """The sample of the union of parts, equal to ``uniform_sample`` of all their rows.

    With ``keep_key`` it stays a part: one row more, whose key is the threshold, and the keys.
    """
    ordered = parts.orderBy("_key", ident)
    return ordered.limit(size + 1) if keep_key else ordered.limit(size).drop("_key")


def estimated_total(part: DataFrame, size: int = 1000) -> DataFrame:
    """One row (rows, exact): how many rows a part was drawn from, by its threshold.

    The key of rank ``size`` + 1 is about ``size`` / rows of the way through the keys; a part
    without one holds all rows there were.
    """
    unit = (F.conv(F.substring("_key", 1, HEX_DIGITS), 16, 10).cast("double") + 0.5) / F.lit(float(16**HEX_DIGITS))
    found = part.agg(F.count("*").alias("n"), F.max(unit).alias("threshold"))
    whole = F.col("n") <= size
    return found.select(
        F.when(whole, F.col("n").cast("double")).otherwise(F.lit(float(size)) / F.col("threshold")).alias("rows"),
        whole.alias("exact"),
    )


def weighted_sample(
    df: DataFrame, ident: str, weight: str, size: int, seed: int = 42
) -> DataFrame:
    """``size`` rows without replacement, chances proportional to ``weight`` (> 0)."""
    key = F.log(unit_random(seed, ident)) / F.col(weight)
    return (
        df.filter(F.col(weight) > 0)
        .withColumn("_key", key)
        .orderBy(F.desc("_key"), ident)
        .limit(size)
        .drop("_key")
    )


def adaptive_sample(
    df: DataFrame, ident: str, keys: Sequence[str], target: int, seed: int = 42
) -> DataFrame:
    """About ``target`` rows per group: small groups whole, large ones at target / size."""
    rates = df.groupBy(*keys).agg(
        F.least(F.lit(1.0), F.lit(float(target)) / F.count("*")).alias("sampling_rate")
    )
    return skew_join(df, rates, list(keys)).filter(
        unit_random(seed, ident) < F.col("sampling_rate")
    )

