"""Locality-sensitive hashing of driving styles into communities."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapgraph.operators.components import components
from lapgraph.operators.profiles import FEATURES, driver_features
from lapgraph.operators.skew import skew_join

# Fixed value: fallback bucket count when no feature vector is hashed.
FALLBACK_BUCKETS = 10


def style_tokens(widths: Mapping[str, float]) -> Column:
    """Feature values cut into bins: ``avg_speed:7`` is the 8th bin of its width."""
    tokens = [
        F.concat(F.lit(f"{name}:"), F.floor(F.col(name) / F.lit(width)).cast("string"))
        for name, width in widths.items()
    ]
    return F.array(*tokens)


def minhash(tokens: Column, tables: int) -> Column:
    """One value per hash table: the smallest md5 of (table number, token).

    Rows agree on a table with a probability equal to the overlap of their token sets.
    """
    def smallest(table: int) -> Column:
        return F.array_min(F.transform(tokens, lambda t: F.md5(F.concat(F.lit(f"{table}:"), t))))

    return F.array(*[smallest(table) for table in range(tables)])


def lsh_communities(features: DataFrame, widths: Mapping[str, float], tables: int = 5) -> DataFrame:
    """(driver_id, session_id, community_id, hashes); the community is the first table's value."""
    hashed = features.withColumn("hashes", minhash(style_tokens(widths), tables))
    return hashed.select(
        "driver_id",
        "session_id",
        F.concat(F.lit("comm_"), F.substring(F.col("hashes")[0], 1, 12)).alias("community_id"),
        "hashes",
    )


def feature_partials(telemetry: DataFrame) -> DataFrame:
    """Mergeable sums behind the features, per (driver, session) of one batch."""
    sums = [
        aggregate
        for metric in ("speed_kph", "throttle_pct", "brake_pressure_bar")
        for aggregate in (F.sum(metric).alias(f"sum_{metric}"), F.count(metric).alias(f"n_{metric}"))
    ]
    return telemetry.groupBy("driver_id", "session_id").agg(*sums, F.max("engine_rpm").alias("max_rpm"))


def merged_feature_partials(partials: DataFrame) -> DataFrame:
    """One row of sums per (driver, session) from partials of any batches."""
    sums = [F.sum(c).alias(c) for c in partials.columns if c.startswith(("sum_", "n_"))]
    return partials.groupBy("driver_id", "session_id").agg(*sums, F.max("max_rpm").alias("max_rpm"))


def merged_features(partials: DataFrame) -> DataFrame:
    """Features over all batches; incomplete rows are dropped."""
    names = {"avg_speed": "speed_kph", "avg_throttle": "throttle_pct", "avg_brake": "brake_pressure_bar"}
    return merged_feature_partials(partials).select(
        "driver_id", "session_id", *[F.try_divide(f"sum_{m}", f"n_{m}").alias(name) for name, m in names.items()], "max_rpm"
    ).dropna(subset=FEATURES)


def driver_communities(telemetry: DataFrame, widths: Mapping[str, float], tables: int = 5) -> DataFrame:
    """Communities straight from telemetry; drivers with incomplete features are left out."""
    return lsh_communities(driver_features(telemetry), widths, tables)


def hashed_communities(features: DataFrame, column: str = "features") -> DataFrame:
    """Fallback: a fixed number of buckets by the md5 of the whole feature vector, in thousandths."""
    parts = F.transform(column, lambda x: F.floor(x * 1000).cast("string"))
    digits = F.substring(F.md5(F.concat_ws("_", parts)), 1, 8)
    bucket = (F.conv(digits, 16, 10).cast("bigint") % FALLBACK_BUCKETS).cast("string")
    return features.select("driver_id", F.concat(F.lit("comm_"), bucket).alias("community_id"))


def _named(features: DataFrame) -> DataFrame:
    return features.withColumn("name", F.concat_ws("/", "driver_id", "session_id"))


def _labelled(named: DataFrame, links: DataFrame) -> DataFrame:
    """The community of each driver session is named after the smallest one it is linked with."""
    found = components(links).withColumnsRenamed({"id": "name", "component": "_first"})
    label = F.concat(F.lit("comm_"), F.coalesce("_first", "name")).alias("community_id")
    return named.join(found, "name", "left").select("driver_id", "session_id", label)


def linked_communities(
    features: DataFrame, widths: Mapping[str, float], similarity: float = 0.8, tables: int = 5
) -> DataFrame:
    """Communities over all hash tables: driver sessions that meet in any table and share at
    least ``similarity`` of their bins are linked, and linked ones make one community.

    Equal styles are linked to the first of them, so only different styles meet in a table.
    """
    named = _named(features).select("driver_id", "session_id", "name", F.array_sort(style_tokens(widths)).alias("style"))
    firsts = named.groupBy("style").agg(F.min("name").alias("first")).checkpoint()
    equal = skew_join(named, firsts, ["style"]).filter("name <> first").select(F.col("name").alias("src"), F.col("first").alias("dst"))
    hashed = firsts.select("first", "style", F.posexplode(minhash(F.col("style"), tables)).alias("table", "value"))
    other = hashed.select(F.col("first").alias("other"), F.col("style").alias("_style"), "table", "value")
    share = F.size(F.array_intersect("style", "_style")) / F.size(F.array_union("style", "_style"))
    alike = hashed.join(other, ["table", "value"]).filter(F.col("first") < F.col("other")).filter(share >= similarity)
    return _labelled(named, equal.unionByName(alike.select(F.col("first").alias("src"), F.col("other").alias("dst"))).distinct())


def near_communities(features: DataFrame, distance: float, tables: int = 8, seed: int = 7) -> DataFrame:
    """Communities of driver sessions linked where their features are less than ``distance`` apart.

    Pairs come from random projections with buckets of ten distances: two points within the
    distance are in different buckets of one table with a chance below a tenth, and of all
    eight below one in a hundred million.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH, VectorAssembler

    named = _named(features)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(named).select("name", "vector")
    model = BucketedRandomProjectionLSH(
        inputCol="vector", outputCol="buckets", bucketLength=10 * distance, numHashTables=tables, seed=seed
    ).fit(vectors)
    pairs = model.approxSimilarityJoin(vectors, vectors, distance, "apart")
    links = pairs.select(F.col("datasetA.name").alias("src"), F.col("datasetB.name").alias("dst")).filter("src < dst")
    return _labelled(named, links)


def community_sizes(communities: DataFrame) -> DataFrame:
    return communities.groupBy("community_id").agg(
        F.count_distinct("driver_id").alias("member_count")
    )


def community_members(communities: DataFrame) -> DataFrame:
    """Distinct members with the size of their community, one row per member.

    Rows instead of an array per community, because a community has no size limit.
    """
    members = communities.select("community_id", "driver_id").distinct()
    sizes = members.groupBy("community_id").agg(F.count("*").alias("member_count"))
    return skew_join(members, sizes, ["community_id"])
