"""A Merkle manifest of a table, leaf places found by bitmap ranks.

Every row is a leaf, a digest over its fields. Leaves of a group (its ``group_col``) ascend by
id. Their places come without sorting: the ids of a group form a bitmap, kept as its non-empty
64-bit words (``words``), with a directory of row counts over words, blocks of words and so on
(``offsets``). The place of a leaf is the count before its word plus the set bits below its
own. Places fall into blocks of 1,024 slots. A task fills the slots of a block by place and
reduces its levels; the block's node is a leaf of the next round. The groups' roots, in order
of the groups, are reduced in the same way to the root. Paths then travel back from the root,
block by block, and give every row its siblings.

Nulls: a null field counts as ``-``; null groups are one group that comes first; a null id is
taken as the smallest possible one. Rows of the same id are ordered by leaf; only words that
hold a repeated id are sorted (``tied``), by ranges, so a third of all rows may share an id.
Equal rows have equal leaves and share out their places in any order. Ids are integers. An
empty table gives no rows. Columns that are not fields are left behind before any name of
this module appears. Long texts are hashed whole where they are read and never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapgraph.llm.common import NULL_ID, parallelism, split_join, stored

#: Levels that one block of slots reduces.
LEVELS = 10
SLOTS = 1 << LEVELS
#: Bits that each step of the directory adds to a word's block: 64 words, 4,096 blocks, and so on.
DIRECTORY = (6, 12, 20)
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODE = "g string, p long, n long, hash string"
_PATH = "path array<string>, top string"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts joined."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The leaf of a row: each field as byte count, colon and value, or ``-`` if null."""
    texts = [field.cast("string") for field in fields]
    return digest(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def leaves(
    docs: DataFrame, changed: dict[str, Column] | None = None, changes: Column | None = None,
    fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "lang",
) -> DataFrame:
    """(id, g, k, u, leaf, claimed): ``claimed`` is the leaf of the row as ``changed`` presents it.

    Where ``changes`` is not true the row is claimed as it is and not hashed a second time.
    """
    column = {name: F.col(f"`{name}`") for name in {*fields, id_col, group_col}}
    own = leaf_digest([column[name] for name in fields])
    found = docs.select(
        column[id_col].alias("id"),
        F.coalesce(F.concat(F.lit("="), column[group_col].cast("string")), F.lit("-")).alias("g"),
        F.coalesce(column[id_col].cast("long"), F.lit(NULL_ID)).alias("k"),
        F.monotonically_increasing_id().alias("u"),
        own.alias("leaf"),
        (F.when(changes, leaf_digest([(changed or {}).get(name, column[name]) for name in fields]))
         if changes is not None else F.lit(None).cast("string")).alias("claimed"),
    )
    return stored(found.withColumn("claimed", F.coalesce("claimed", "leaf")), "leaves")


def offsets(counts: DataFrame, widths: Sequence[int] = DIRECTORY) -> DataFrame:
    """``counts`` (g, at, n) with ``base``, the sum of n before each ``at`` of the group.

    A window never holds more than one block of the directory; blocks are summed by the next step.
    """
    if not widths:
        before = Window.partitionBy("g").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    blocked = counts.withColumn("up", F.shiftright("at", widths[0]))
    before = Window.partitionBy("g", "up").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocked.groupBy("g", F.col("up").alias("at")).agg(F.sum("n").alias("n"))
    above = offsets(blocks, widths[1:]).select("g", F.col("at").alias("up"), F.col("base").alias("above"))
    local = blocked.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return local.join(above, ["g", "up"]).withColumn("base", F.col("base") + F.col("above")).drop("up", "above")


def words(found: DataFrame) -> DataFrame:
    """The groups' bitmaps: (g, at, bits, n, base), one row per non-empty word of 64 ids.

    ``n`` counts rows, so it passes the number of set bits where an id repeats.
    """
    bit = F.expr("shiftleft(1L, cast(k & 63 AS int))")
    bits = found.groupBy("g", F.shiftright("k", 6).alias("at")).agg(F.bit_or(bit).alias("bits"), F.count("*").alias("n"))
    bits = stored(bits, "words")
    return bits.join(offsets(bits.select("g", "at", "n")).drop("n"), ["g", "at"])


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``place``, the number of rows before it in the whole order; no task sees all.

    ``order`` must tell all rows apart, so that ranges can be cut anywhere. The counts of the
    ranges, one row per partition, are summed in one place.
    """
    ranges = df.repartitionByRange(parallelism(df.sparkSession), *order).sortWithinPartitions(*order)
    rows = stored(ranges.withColumn("place", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("range", F.shiftright("place", 33))
    counts = rows.groupBy("range").agg(F.count("*").alias("n")).select(F.lit("").alias("g"), F.col("range").alias("at"), "n")
    starts = offsets(counts, ()).select(F.col("at").alias("range"), F.col("base").alias("begin"))
    inside = F.expr("place & (shiftleft(1L, 33) - 1)")
    return rows.join(F.broadcast(starts), "range").withColumn("place", F.col("begin") + inside).drop("range", "begin")


def placed(found: DataFrame) -> DataFrame:
    """Leaves with ``p``, the place in the group, and ``n``, the size of the group."""
    bitmap = words(found)
    sizes = bitmap.groupBy("g").agg(F.sum("n").alias("size"))
    below = F.expr("bit_count(bits & ~shiftleft(-1L, cast(k & 63 AS int)))")
    rows = split_join(
        found.withColumn("at", F.shiftright("k", 6)),
        bitmap.join(sizes, "g").withColumn("repeats", F.expr("n > bit_count(bits)")).drop("n"), ["g", "at"], "inner", "bitmap",
    )
    rows = stored(rows.withColumn("p", F.col("base") + below), "placed")
    keep = ["id", "g", "p", F.col("size").alias("n"), F.col("leaf").alias("hash"), "claimed"]
    single = rows.where("NOT repeats").select(*keep)
    tied = numbered(rows.where("repeats").drop("at"), ["g", "k", "leaf", "u"], "tied")
    tied = tied.withColumn("at", F.shiftright("k", 6))
    first = tied.groupBy("g", "at").agg(F.min("place").alias("first"))
    tied = split_join(tied, first, ["g", "at"], "inner", "first").withColumn("p", F.col("base") + F.col("place") - F.col("first"))
    return single.unionByName(tied.select(*keep))


def _sha(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def _levels(places: list[int], hashes: list[str], n: int) -> Iterator[list[str]]:
    """The nodes of a block, level by level; ``n`` counts the nodes of all blocks of the group."""
    nodes = [""] * len(places)
    for place, node in zip(places, hashes, strict=True):
        nodes[place % SLOTS] = node
    yield nodes
    for _ in range(min(LEVELS, (n - 1).bit_length())):
        nodes = [_sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        yield nodes


def _reduce(block: pa.Table) -> pa.Table:
    n, place = block["n"][0].as_py(), block["p"][0].as_py()
    *_, last = _levels(block["p"].to_pylist(), block["hash"].to_pylist(), n)
    return pa.table({"g": block["g"].slice(0, 1), "p": [place // SLOTS], "n": [-(-n // SLOTS)], "hash": last})


def _extend(block: pa.Table, above: pa.Table) -> pa.Table:
    """Rows of a block with their paths: siblings inside the block, then those above it."""
    places = block["p"].to_pylist()
    *levels, _ = _levels(places, block["hash"].to_pylist(), block["n"][0].as_py())
    upper = above["path"][0].as_py()
    paths = []
    for place in places:
        i, path = place % SLOTS, []
        for nodes in levels:
            j = i ^ 1
            path.append("" if j >= len(nodes) else ("L" if j < i else "R") + nodes[j])
            i >>= 1
        paths.append(path + upper)
    top = pa.repeat(above["top"][0], len(places))
    return block.drop_columns(["b"]).append_column("path", pa.array(paths, pa.list_(pa.string()))).append_column("top", top)


def rounds_of(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The nodes of each round, the given ones first, until every group is one node."""
    rounds = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        blocks = rounds[-1].select("g", "p", "n", "hash", F.floor(F.col("p") / SLOTS).alias("b"))
        rounds.append(stored(blocks.groupBy("g", "b").applyInArrow(_reduce, _NODE), name))
        most = -(-most // SLOTS)
        if most <= 1:
            return rounds


def paths_down(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Rows of the first round with ``path`` and ``top``; ``above`` (g, p, path, top) belongs to the last.

    An element of a path is ``L`` or ``R``, the side of the sibling, and its digest; it is
    empty where a node has no sibling.
    """
    for at, nodes in enumerate(reversed(rounds[:-1])):
        blocks = nodes.withColumn("b", F.floor(F.col("p") / SLOTS))
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema) + ", " + _PATH
        upper = above.select("g", F.col("p").alias("b"), "path", "top").groupBy("g", "b")
        extended = blocks.groupBy("g", "b").cogroup(upper).applyInArrow(_extend, schema)
        above = stored(extended, "paths") if at < len(rounds) - 2 else extended
    return above


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    digits = lambda x: F.substring(x, 2, 64)
    step = lambda node, x: (
        F.when(x.startswith("L"), digest(digits(x), node)).when(x.startswith("R"), digest(node, digits(x))).otherwise(digest(node))
    )
    return F.aggregate(path, leaf, step)


def siblings(path: Column) -> Column:
    """All digests of a path, joined in order."""
    return F.array_join(F.transform(path, lambda x: F.substring(x, 2, 64)), "")


def manifest(docs: DataFrame, changed: dict[str, Column] | None = None, changes: Column | None = None, **columns) -> DataFrame:
    """(id, leaf, claimed, subroot, root, path) of every row; see ``leaves`` for the arguments."""
    nodes = stored(placed(leaves(docs, changed, changes, **columns)), "nodes")
    rounds = rounds_of(nodes, "round")
    groups = numbered(rounds[-1].select("g", "hash"), ["g"], "groups")
    count = groups.count()
    top = groups.select(F.lit("").alias("g"), F.col("place").alias("p"), F.lit(count).cast("long").alias("n"), "hash", F.col("g").alias("name"))
    above = rounds_of(top, "root")
    found = above[-1].first()
    root = found["hash"] if found else None
    none = F.array().cast("array<string>")
    named = paths_down(above, above[-1].select("g", "p", none.alias("path"), F.lit(root).alias("top")))
    named = stored(named.select(F.col("name").alias("g"), F.lit(0).cast("long").alias("p"), "path", F.col("hash").alias("top")), "named")
    return paths_down(rounds, named).select(
        "id", F.col("hash").alias("leaf"), "claimed", F.col("top").alias("subroot"), F.lit(root).alias("root"), "path"
    )
