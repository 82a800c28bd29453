"""Hot keys.

One key may hold a large share of all rows. Aggregates are safe (Spark combines on the
map side). Joins are left to adaptive execution, which splits the partitions of a hot key by
their measured size; windows on a hot key are split here, by its measured row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_HEAT = 100_000


def skew_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``left``, whose keys may be hot, with a right side that has each key once.

    The hot side stands on the left, where Spark can split its partitions for inner, left,
    left_semi and left_anti joins; neither side is copied beyond what the measured skew asks.
    """
    return left.join(right, list(on), how)


def mark_repeats(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    flag: str = "is_duplicate",
    rows_per_heat: int = ROWS_PER_HEAT,
) -> DataFrame:
    """Flag every row of a key except the first by ``order``.

    Rows of a key compete in heats, as many as its row count asks for (one, for most keys). Which
    heat holds the first row of a hot key is the smallest of its rows by ``order``, a minimum
    that combines before the shuffle, so all rows pass one window once.
    """
    heats = (
        df.groupBy(*keys).agg(F.ceil(F.count("*") / rows_per_heat).alias("_heats"))
        .filter("_heats > 1")
    )
    own = F.pmod(F.xxhash64(*df.columns), F.coalesce("_heats", F.lit(1))).alias("_salt")
    first = F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], "_salt"))
    hot = skew_join(df, heats, keys).select(*df.columns, "_heats", own)
    best = hot.groupBy(*keys, "_heats").agg(first["_salt"].alias("_best"))
    spread = skew_join(df, best, keys, "left").withColumn("_salt", own)
    heat = Window.partitionBy(*keys, "_salt").orderBy(*order)
    beaten = (F.row_number().over(heat) > 1) | (F.coalesce("_best", "_salt") != F.col("_salt"))
    return spread.withColumn(flag, beaten).select(*df.columns, flag)
