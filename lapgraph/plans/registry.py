"""Where queries and their check texts register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, TimestampType

from lapgraph.plans.fixtures import Fixtures, with_views

Builder = Callable[[Fixtures], DataFrame]
BUILDERS: dict[str, Builder] = {}
CHECKS: dict[str, str] = {}
DIGITS = 6


def query(key: str, sql: str | None = None):
    """Register a builder under ``key``; ``sql`` is its equivalent over the same views."""

    def register(builder: Builder) -> Builder:
        if key in BUILDERS:
            raise ValueError(f"{key} is registered twice")
        BUILDERS[key] = builder
        if sql is not None:
            CHECKS[key] = with_views(sql)
        return builder

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Fractions at 6 digits and zone-less times, as the check texts give them."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DoubleType, FloatType, DecimalType)):
            column = F.round(column.cast("double"), DIGITS)
        elif isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def run(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(BUILDERS[key](Fixtures(spark, sf_dir)))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        key: (lambda spark, sf_dir, key=key: run(key, spark, sf_dir)) for key in sorted(BUILDERS)
    }
