"""Shared small parts of the text operators."""

from __future__ import annotations

import ctypes
import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapgraph.session import scratch_path

#: The id that stands for a null one inside joins; it sorts before all others.
NULL_ID = -(2**63)
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Upper-case ASCII letters as lower-case ones, in UTF-8.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, k, h, text): k is the id without nulls, (k, h) names one text of one id.

    Every other column is left behind, so no name of the input can clash.
    """
    row_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return docs.select(
        row_id.alias("doc_id"),
        F.coalesce(row_id.cast("long"), F.lit(NULL_ID)).alias("k"),
        F.xxhash64(text).alias("h"),
        text.alias("text"),
    )


def lowered(text: str | None) -> bytes:
    """The text in UTF-8 with A-Z in lower case; null is empty."""
    return (text or "").encode().translate(LOWER_BYTES)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_join(left: DataFrame, right: DataFrame, on: list[str], how: str, name: str) -> DataFrame:
    """Join ``left``, whose keys may be hot, with a stored ``right`` that has each key once.

    Grouping the right side by the same keys would pin the left rows of a key to one task;
    read from a table, it leaves Spark free to split them.
    """
    return left.join(stored(right, name), on, how)


def parallelism(spark: SparkSession) -> int:
    """Partitions of the session's shuffles."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def reuse_memory() -> None:
    """Let the C allocator keep a little freed memory, so that arrays of the same size, made
    again and again, do not cost page faults each time. Without glibc nothing happens."""
    try:
        library = ctypes.CDLL(None)
        library.mallopt(-3, 64 << 20)  # M_MMAP_THRESHOLD
        library.mallopt(-1, 64 << 20)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):
        pass


def return_memory() -> None:
    """Give freed memory back to the system: a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def tidy(run):
    """``run`` over the batches of a task, which leaves no freed memory behind in its worker."""

    @functools.wraps(run)
    def whole(batches):
        yield from run(batches)
        return_memory()

    return whole


def small(batches, rows: int = 1000):
    """Batches of few rows, so that what a step makes of one stays small."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def list_column(values: np.ndarray, lengths, kind: pa.DataType) -> pa.ListArray:
    """Arrow lists from one flat array and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (public-domain splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def key_bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of ``bits`` bits over the low bits of one column of hashes.

    Its size does not depend on the number of keys; with many it lets more through, but it
    never misses one. At most ``bits`` / 8 small rows reach the driver.
    """
    slots = bits >> 3

    def run(batches):
        bitmap = np.zeros(slots, np.uint8)
        for batch in batches:
            place = batch.column(0).to_numpy(zero_copy_only=False) & (bits - 1)
            np.bitwise_or.at(bitmap, place >> 3, (1 << (place & 7)).astype(np.uint8))
        used = np.flatnonzero(bitmap)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(bitmap[used].astype(np.int32))], ["slot", "bits"]
        )

    found = keys.mapInArrow(run, "slot long, bits int").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toPandas()
    bitmap = np.zeros(slots, np.uint8)
    bitmap[found["slot"].to_numpy(np.int64)] = found["bits"].to_numpy(np.uint8)
    return bitmap


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each signed 64-bit key may be among those of the bitmap."""
    place = keys & (len(bitmap) * 8 - 1)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def maybe_among(df: DataFrame, column: str, bitmap: np.ndarray, among: bool = True) -> DataFrame:
    """Rows of ``df`` whose ``column`` the bitmap may hold, or with ``among`` off all others.

    A semi-join before the shuffle: what the bitmap does not hold needs no join. Only the keys
    go to Python, the rows themselves stay where they are.
    """
    shared = df.sparkSession.sparkContext.broadcast(bitmap)

    def run(keys: pa.Array) -> pa.Array:
        return pa.array(in_bitmap(shared.value, keys.to_numpy(zero_copy_only=False)) == among)

    return df.where(F.arrow_udf(run, "boolean")(F.col(f"`{column}`")))


def drop_documents(
    docs: DataFrame, gone: DataFrame, once: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without the texts (k, h) in ``gone``; of those in ``once`` one row stays.

    (k, h) is the pair of ``keyed_texts``, so other texts of the same id stay, and only rows of
    equal id and text become one: the smallest by all columns. Rows that a fixed-size filter
    knows to be untouched pass by without a shuffle.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")  # no name of the input is next to ours
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("_k")
    marked = docs.select(row, key, F.xxhash64(F.col(f"`{text_col}`")).alias("_h")).withColumn("_hash", F.xxhash64("_k", "_h"))
    named = lambda df: df.select(F.col("k").alias("_k"), F.col("h").alias("_h")).distinct()
    gone = named(gone)
    once = named(once) if once is not None else gone.limit(0)
    pair = ["_k", "_h"]
    bitmap = key_bitmap(gone.union(once).select(F.xxhash64(*pair)), 1 << 25)
    same = maybe_among(marked, "_hash", bitmap, among=False)
    touched = maybe_among(marked, "_hash", bitmap).join(gone, pair, "left_anti")
    repeated = touched.join(once, pair, "left_semi").groupBy(*pair).agg(F.min("_row").alias("_row"))
    others = touched.join(once, pair, "left_anti")
    return same.select("_row").union(others.select("_row")).union(repeated.select("_row")).select("_row.*")
