"""Static and streaming table reads, and the streaming log source."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Reader defaults.
MAX_OFFSETS_PER_TRIGGER = 100_000
MAX_FILES_PER_TRIGGER = 10


def option_dict(pairs: Iterable[str]) -> dict[str, str]:
    """``["a=1", "b = x=y"]`` to a dictionary; an entry without ``=`` is an error."""
    options = {}
    for pair in pairs:
        name, sign, value = pair.partition("=")
        if not sign:
            raise ValueError(f"expected key=value, got {pair!r}")
        options[name.strip()] = value.strip()
    return options


def log_options(
    bootstrap_servers: str, starting_offsets: str = "latest", overrides: Iterable[str] = ()
) -> dict[str, str]:
    """Options of the log reader: rate cap, no failure on expired offsets, overrides last."""
    if starting_offsets not in ("latest", "earliest"):
        raise ValueError("starting_offsets is latest or earliest")
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": str(MAX_OFFSETS_PER_TRIGGER),
        **option_dict(overrides),
    }


def stream_log(spark: SparkSession, topic: str, options: Mapping[str, str]) -> DataFrame:
    """Subscribe to one topic (key, value, topic, partition, offset, timestamp)."""
    return spark.readStream.format("kafka").options(**options).option("subscribe", topic).load()


def table_format(path: str) -> str:
    return "delta" if path.rstrip("/").endswith(".delta") else "parquet"


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.format(table_format(path))
    return (reader.schema(schema) if schema else reader).load(path)


def stream_table(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
    starting_version: int | None = None,
    table_type: str | None = None,
) -> DataFrame:
    """Stream a table, a bounded number of files per batch.

    ``schema`` is required for plain files; ``starting_version`` exists for Delta only.
    """
    fmt = table_type or table_format(path)
    reader = spark.readStream.format(fmt).option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "delta":
        if starting_version is not None:
            reader = reader.option("startingVersion", starting_version)
    elif starting_version is not None:
        raise ValueError("starting_version needs a Delta table")
    elif schema is None:
        raise ValueError("streaming plain files needs a schema")
    return (reader.schema(schema) if schema else reader).load(path)


def table_state(spark: SparkSession, path: str, schema: StructType | None = None) -> str:
    """``missing``, ``empty`` or ``ready``, reading at most one row."""
    try:
        table = read_table(spark, path, schema)
        return "empty" if table.isEmpty() else "ready"
    except AnalysisException:
        return "missing"


def require_tables(spark: SparkSession, required: Mapping[str, str], optional: Mapping[str, str]) -> dict[str, str]:
    """State of every named table; a missing required one is an error, others are reported."""
    states = {name: table_state(spark, path) for name, path in {**required, **optional}.items()}
    missing = [name for name in required if states[name] == "missing"]
    if missing:
        raise FileNotFoundError(f"required tables not found: {', '.join(missing)}")
    return states


def history_and_live(
    transform: Callable[[DataFrame], DataFrame], history: DataFrame, live: DataFrame
) -> DataFrame:
    """The same transformation over a bulk load and a (batch or stream) of new rows."""
    return transform(history).unionByName(transform(live))
