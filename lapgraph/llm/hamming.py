"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into segments of 16 bits. Codes within distance d of a query differ in some
segment by no more than its share of d, so the search looks up all segment values within a
radius, raises the radii one segment at a time, verifies what it finds, and stops when the
k-th distance is one that the radii provably cover.

Queries and codes meet in blocks of bounded size; each block keeps its best k per query.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapgraph.llm.common import stored

SEGMENT_BITS = 16
#: Codes and queries of one block.
CODES, QUERIES = 8192, 4096


@lru_cache(maxsize=None)
def flips(radius: int) -> np.ndarray:
    """All segment values with ``radius`` bits set."""
    return np.array([sum(1 << i for i in c) for c in combinations(range(SEGMENT_BITS), radius)], np.int64)


class MultiIndex:
    """One table per segment: the codes with each segment value."""

    def __init__(self, codes: np.ndarray):
        """``codes``: uint16 [code, segment]."""
        self.codes = codes
        self.order, self.first = [], []
        for segment in codes.T:
            self.order.append(np.argsort(segment, kind="stable"))
            counts = np.bincount(segment, minlength=1 << SEGMENT_BITS)
            self.first.append(np.concatenate([[0], np.cumsum(counts)]))

    def nearest(self, query: np.ndarray, k: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, distances) of every code up to the distance that holds ``k`` rows.

        ``weights`` are the rows that share each code.
        """
        n, segments = self.codes.shape
        seen = np.zeros(n, bool)
        held = np.zeros(segments * SEGMENT_BITS + 1, np.int64)
        found, distances = [], []
        for radius in range(SEGMENT_BITS + 1):
            for segment in range(segments):
                values = flips(radius) ^ int(query[segment])
                begin, end = self.first[segment][values], self.first[segment][values + 1]
                sizes = end - begin
                total = int(sizes.sum())
                if total:
                    at = np.arange(total) + np.repeat(begin - np.cumsum(sizes) + sizes, sizes)
                    fresh = self.order[segment][at]
                    fresh = fresh[~seen[fresh]]
                    seen[fresh] = True
                    distance = np.bitwise_count(self.codes[fresh] ^ query).sum(axis=1)
                    np.add.at(held, distance, weights[fresh])
                    found.append(fresh)
                    distances.append(distance)
                covered = segments * radius + segment
                if held[: covered + 1].sum() >= k:
                    far = int(np.searchsorted(np.cumsum(held), k))
                    found, distances = np.concatenate(found), np.concatenate(distances)
                    return found[distances <= far], distances[distances <= far]
        return (
            np.concatenate(found) if found else np.zeros(0, np.int64),
            np.concatenate(distances) if distances else np.zeros(0, np.int64),
        )


def binary_codes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, code), stored: one bit per element, set where it is positive, padded with zeros."""
    source = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    source = source.where("id IS NOT NULL AND size(vector) > 0")
    width = source.agg(F.max(F.size("vector"))).first()[0] or 1
    size = -(-width // SEGMENT_BITS) * SEGMENT_BITS

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            codes = []
            for i in range(len(column)):
                bits = np.zeros(size, np.uint8)
                own = column[i].values.to_numpy(zero_copy_only=False)
                bits[: len(own)] = own > 0
                codes.append(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary())], ["id", "code"])

    kind = source.schema["id"].dataType.simpleString()
    return stored(source.mapInArrow(run, f"id {kind}, code binary"), "codes")


def _segments(codes: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(codes.to_pylist()), np.uint16).reshape(len(codes), -1)


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, id, distance): the ``k`` rows nearest to each query by Hamming distance.

    ``queries`` has the ids of rows that serve as queries; a row is no neighbour of a row with
    its own id. Equal distances rank by id. Null ids and null or empty vectors take no part; a
    shorter vector counts as padded with zero bits. Rows that repeat an id and a code count
    once. A query gets fewer rows only where there are no more. Other columns are ignored.
    """
    codes = binary_codes(vectors, id_col, vector_col).dropDuplicates(["id", "code"])
    kind = codes.schema["id"].dataType.simpleString()
    asked = queries.select(F.col(f"`{id_col}`").alias("id")).distinct()
    n_codes, n_asked = codes.count(), asked.count()
    parts, rounds = max(1, -(-n_codes // CODES)), max(1, -(-n_asked // QUERIES))
    # Only the k + 1 smallest ids of a code can ever rank.
    first = Window.partitionBy("code").orderBy("id")
    shared = (
        codes.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
        .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("part", F.pmod(F.xxhash64("code"), F.lit(parts)))
        .withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    )
    probes = (
        codes.join(asked, "id", "left_semi")
        .select(
            F.col("id").alias("query"), F.col("code").alias("query_code"),
            F.pmod(F.xxhash64("id"), F.lit(rounds)).cast("int").alias("query_round"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("query_part"),
        )
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        ids = left.column("ids").to_pylist()
        if ids and len(right):
            index = MultiIndex(_segments(left.column("code")))
            weights = np.array([len(x) for x in ids])
            for name, query in zip(right.column("query").to_pylist(), _segments(right.column("query_code"))):
                found, distances = index.nearest(query, k + 1, weights)
                best = sorted((int(d), i) for c, d in zip(found, distances) for i in ids[c] if i != name)
                for distance, i in best[:k]:
                    out[0].append(name)
                    out[1].append(i)
                    out[2].append(distance)
        kinds = [right.schema.field("query").type] * 2 + [pa.int32()]
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds)], ["query_id", "id", "distance"])

    met = (
        shared.groupBy("part", "round").cogroup(probes.groupBy("query_part", "query_round"))
        .applyInArrow(search, f"query_id {kind}, id {kind}, distance int")
    )
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    best = met.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("id").alias(id_col), "distance")
