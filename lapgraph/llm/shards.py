"""Sharding by best-fit-decreasing bin packing on two levels.

Rows of equal text form an indivisible group. Tasks pack their own groups into parcels, small
fractions of a shard; the parcels, whose number depends on shards and fineness and not on the
rows, are packed into the shards. On both levels items go in by falling size, each into the
open bin with the tightest remaining capacity, found in a balanced tree.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapgraph.llm.common import parallelism, split_join, stored

#: Parcels to a shard, of which the smallest units (SAND of the bytes) make finer ones.
COARSE, FINE, SAND = 512, 32768, 0.05
#: Units one packing step holds in memory.
UNITS_PER_STEP = 500_000
#: Rows of a group that one task numbers.
ROWS_PER_PIECE = 50_000
#: A group larger than a shard is cut into pieces of this part of a shard.
PIECE_OF_SHARD = 8


class CapacityTree:
    """Ordered (remaining, bin) pairs: a B+-tree of two levels whose leaves split in halves."""

    LEAF = 256

    def __init__(self):
        self.leaves: list[list[tuple[int, int]]] = []
        self.largest: list[tuple[int, int]] = []

    def add(self, entry: tuple[int, int]) -> None:
        if not self.leaves:
            self.leaves, self.largest = [[entry]], [entry]
            return
        at = min(bisect_left(self.largest, entry), len(self.leaves) - 1)
        leaf = self.leaves[at]
        insort(leaf, entry)
        if len(leaf) > self.LEAF:
            half = len(leaf) // 2
            self.leaves[at : at + 1] = [leaf[:half], leaf[half:]]
            self.largest[at : at + 1] = [leaf[half - 1], leaf[-1]]
        else:
            self.largest[at] = leaf[-1]

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove the entry with the least remaining capacity that still holds ``size``."""
        at = bisect_left(self.largest, (size, -1))
        if at == len(self.leaves):
            return None
        leaf = self.leaves[at]
        entry = leaf.pop(bisect_left(leaf, (size, -1)))
        if leaf:
            self.largest[at] = leaf[-1]
        else:
            del self.leaves[at], self.largest[at]
        return entry


def best_fit(sizes, capacity: int, bins: int | None = None) -> list[int] | None:
    """The bin of each size, sizes given in falling order; an oversized item has its own bin.

    With ``bins`` given, None if more bins would be needed.
    """
    tree, used, chosen = CapacityTree(), 0, []
    for size in sizes:
        entry = tree.take(size)
        if entry is None:
            if bins is not None and (used == bins or size > capacity):
                return None
            entry = (max(capacity, size), used)
            used += 1
        tree.add((entry[0] - size, entry[1]))
        chosen.append(entry[1])
    return chosen


def even_bins(sizes, bins: int) -> list[int]:
    """Best fit into ``bins`` bins under the least capacity found by halving."""
    total, largest = sum(sizes), max(sizes, default=0)
    low = max(-(-total // bins), largest)
    high = max(low, 2 * (total // bins + largest) + 1)
    best = best_fit(sizes, high, bins)
    while low < high:
        middle = (low + high) // 2
        found = best_fit(sizes, middle, bins)
        if found is None:
            low = middle + 1
        else:
            best, high = found, middle
    return best


def _parcels(units: list[tuple], coarse: int, fine: int) -> list[tuple]:
    """(text_key, piece, parcel, offset) of units (text_key, piece, size, rows)."""
    units.sort(key=lambda u: (-u[2], u[0], u[1]))
    sand, left = len(units), SAND * sum(u[2] for u in units)
    while sand and units[sand - 1][2] <= min(left, fine):
        sand -= 1
        left -= units[sand][2]
    first = best_fit([u[2] for u in units[:sand]], coarse)
    shift = max(first, default=-1) + 1
    chosen = first + [shift + b for b in best_fit([u[2] for u in units[sand:]], fine)]
    filled: dict[int, int] = {}
    out = []
    for (key, piece, size, rows), parcel in zip(units, chosen):
        offset = filled.get(parcel, 0)
        filled[parcel] = offset + rows
        out.append((key, piece, parcel, offset, size, rows))
    return out


def shard_documents(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows into ``shards`` shards of near equal bytes: the law ``bytes``.

    One row per row of ``docs``: id, size (UTF-8 bytes of the text, null: none, plus 8),
    text_crc32 (null: 0), law, shard, slot (gapless from 0 in each shard), grown_shard (null).
    Rows of equal text share a shard; null texts are equal to each other. Only a group larger
    than an even share is cut, since whole it would break the law. Repeated rows each take
    their own slot; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`")
    rows = stored(
        docs.select(
            F.col(f"`{id_col}`").alias(id_col),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
            F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            F.coalesce(F.sha2(text.cast("binary"), 256), F.lit("")).alias("text_key"),
        ),
        "sizes",
    )
    share = -(-(rows.agg(F.sum("size")).first()[0] or 0) // shards)
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    oversized = F.col("size") > share
    cuts = F.greatest(
        F.ceil(F.col("rows") / ROWS_PER_PIECE),
        F.when(oversized, F.ceil(F.col("size") * PIECE_OF_SHARD / max(share, 1))).otherwise(1),
    )
    large = (
        groups.select("text_key", F.least(cuts, F.col("rows")).alias("cuts"), oversized.alias("cut"))
        .where("cuts > 1")
    )
    # The hot keys stand on the left, whose partitions Spark can split.
    cut_rows = split_join(rows, large, ["text_key"], "left", "large").select(
        id_col, "size", "text_crc32", "text_key",
        F.when(F.col("cuts").isNull(), 0)
        .otherwise(F.pmod(F.xxhash64(id_col, F.lit(9)), F.col("cuts")))
        .cast("long").alias("piece"),
        F.coalesce("cut", F.lit(False)).alias("cut"),
    )
    pieces = cut_rows.groupBy("text_key", "piece").agg(
        F.sum("size").alias("size"), F.count("*").alias("rows"), F.first("cut").alias("cut")
    )
    unit_piece = F.when(F.col("cut"), F.col("piece")).otherwise(F.lit(0)).alias("unit")
    in_unit = Window.partitionBy("text_key", "unit").orderBy("piece")
    pieces = stored(
        pieces.select("text_key", "piece", unit_piece, "size", "rows").withColumn(
            "before", F.sum("rows").over(in_unit) - F.col("rows")
        ),
        "pieces",
    )
    units = pieces.groupBy("text_key", "unit").agg(
        F.sum("size").alias("size"), F.sum("rows").alias("rows")
    )
    coarse, fine = max(1, share // COARSE), max(1, share // FINE)

    def pack(batches):
        part, step, held = TaskContext.get().partitionId(), 0, []

        def flush():
            out = list(zip(*_parcels(held, coarse, fine)))
            names = ["text_key", "unit", "parcel", "offset", "size", "rows"]
            kinds = [pa.string()] + [pa.int64()] * 5
            columns = [pa.array(c, k) for c, k in zip(out, kinds)]
            step_column = pa.array([(part << 32) + step] * len(held), pa.int64())
            return pa.RecordBatch.from_arrays([*columns, step_column], [*names, "step"])

        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns))
            if len(held) >= UNITS_PER_STEP:
                yield flush()
                held, step = [], step + 1
        if held:
            yield flush()

    packed = stored(
        units.repartition(parallelism(spark), "text_key", "unit").mapInArrow(
            pack,
            "text_key string, unit long, parcel long, offset long, size long, rows long, step long",
        ),
        "parcels",
    )
    # At most two full parcels per COARSE or FINE part of a shard and two open ones per step.
    parcels = sorted(
        packed.groupBy("step", "parcel").agg(F.sum("size"), F.sum("rows")).collect(),
        key=lambda p: (-p[2], p[0], p[1]),
    )
    filled, placed = [0] * shards, []
    for (step, parcel, _, count), shard in zip(parcels, even_bins([p[2] for p in parcels], shards)):
        placed.append((step, parcel, shard, filled[shard]))
        filled[shard] += count
    placed = spark.createDataFrame(placed, "step long, parcel long, shard int, start long")
    starts = (
        packed.drop("size", "rows")
        .join(F.broadcast(placed), ["step", "parcel"])
        .join(pieces.select("text_key", "unit", "piece", "before"), ["text_key", "unit"])
        .select("text_key", "piece", "shard", (F.col("start") + F.col("offset") + F.col("before")).alias("start"))
    )
    in_piece = Window.partitionBy("text_key", "piece").orderBy(id_col)
    numbered = cut_rows.drop("cut").withColumn("row", F.row_number().over(in_piece) - 1)
    return numbered.join(starts, ["text_key", "piece"]).select(
        id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.col("row")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
