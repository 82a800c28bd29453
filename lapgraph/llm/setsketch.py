"""Near-duplicate documents by SetSketch registers.

A document's set is its distinct shingles of three words. A register holds the rounded
logarithm (base B) of the smallest of exponentially distributed hashes of the set, truncated
to 16 bits; registers of unions are maxima. Bands of registers put documents in buckets,
the joint likelihood of two sketches drops pairs that are surely too far apart, and the rest
is confirmed on the full sets.

Documents of equal sets are one vertex. A bucket never gives all its pairs: in each round its
members meet one hub of the bucket, unless the components found so far already hold both.
What then still shares a bucket with another component goes through an exact set join on the
rarest shingles, within bounds of size and place. It gives pairs of components, never of their
sets; these are compared in blocks, by where they differ from what most of a block share. So no
link between different components is lost. Each round works on the components of the one before.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapgraph.llm.common import NULL_ID, key_bitmap, lowered, maybe_among, mix64, small, split_join, stored, tidy
from lapgraph.llm.components import components, followed, relabelled
from lapgraph.llm.words import run_hashes, span_hashes, word_hashes

#: Fixed values of the contract.
SHINGLE = 3
SIMILAR = 85
#: SetSketch parameters: base, rate and largest register.
B, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 1
#: 25 bands of 5 registers miss a pair of similarity 0.85 once in two million times.
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: An estimate this far below the bound (over five standard deviations) drops a pair.
MARGIN = 0.17
#: Rounds with hubs before the prefix-filtered rest.
ROUNDS = 2
#: Largest factor between two set sizes of one class of the rest.
CLASS = 1.04
#: Shingles of the sets that are compared with those of another component at once.
BLOCK = 1 << 15
#: Shingles hashed at once.
CHUNK = 4096
#: Bits of the fixed-size filter of document keys.
FILTER_BITS = 1 << 25

_SEEDS = mix64(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64))
_FACTORS, _SHIFTS = _SEEDS[:REGISTERS] | np.uint64(1), _SEEDS[REGISTERS:]


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle."""
    words = word_hashes(lowered(text))
    if 0 < len(words) < shingle:
        return span_hashes(words, np.array([0]), np.array([len(words)]))
    return np.unique(run_hashes(words, shingle))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest hash of the set for each register."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for begin in range(0, len(shingles), CHUNK):
        part = shingles[begin : begin + CHUNK, None] * _FACTORS + _SHIFTS
        np.minimum(least, part.min(axis=0), out=least)
    return least


def registers(least: np.ndarray) -> np.ndarray:
    """SetSketch registers of minima, of any shape."""
    uniform = (least.astype(np.float64) + 1.0) / 2.0**64
    exponential = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(B)), 0, LIMIT).astype(np.uint16)


def estimate(above, below, size_a, size_b) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from the registers that are larger and smaller.

    The set sizes are known exactly, so the similarity is the only unknown.
    """
    above, below = np.asarray(above, float), np.asarray(below, float)
    u = size_a / (size_a + size_b)
    v = 1 - u
    p = lambda x: -np.log1p(-np.maximum(x, 1e-12) * (B - 1) / B) / np.log(B)

    def likelihood(j):
        more, less = p(u - v * j), p(v - u * j)
        return above * np.log(more) + below * np.log(less) + (
            REGISTERS - above - below
        ) * np.log(np.maximum(1 - more - less, 1e-12))

    low, high = np.zeros(len(above)), np.minimum(u / v, v / u)
    for _ in range(40):
        third = (high - low) / 3
        left = likelihood(low + third) < likelihood(high - third)
        low, high = np.where(left, low + third, low), np.where(left, high, high - third)
    return (low + high) / 2


def surely_below(above, below, size_a, size_b, bound: float) -> np.ndarray:
    """Whether the maximum-likelihood estimate lies below ``bound``.

    The likelihood has one peak, so the sign of its slope at the bound tells.
    """
    u = size_a / (size_a + size_b)
    v = 1 - u
    x, y = (np.maximum(z, 1e-12) * (B - 1) / B for z in (u - v * bound, v - u * bound))
    p, q = -np.log1p(-x) / np.log(B), -np.log1p(-y) / np.log(B)
    dp, dq = ((B - 1) / B / np.log(B) / (1 - z) for z in (x, y))
    equal = REGISTERS - above - below
    slope = equal * (v * dp + u * dq) / np.maximum(1 - p - q, 1e-12) - above * v * dp / p - below * u * dq / q
    return slope < 0


def linked(one: np.ndarray, other: np.ndarray, similar: int) -> bool:
    """The exact test on two full sets."""
    both = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * both >= similar * (len(one) + len(other) - both)


def sketch_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, k, h, n, c1, c2, sketch), stored; (c1, c2) names the set, null where it is empty."""
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    source = docs.select(
        key.alias("doc_id"), F.coalesce(key.cast("long"), F.lit(NULL_ID)).alias("k"),
        F.xxhash64(text).alias("h"), text.alias("text"),
    )

    @tidy
    def run(batches):
        for batch in small(batches):
            sizes, names, least = [], [], []
            for text in batch.column(3).to_pylist():
                shingles = shingle_set(text)
                sizes.append(len(shingles))
                names.append((int(shingles.sum(dtype=np.uint64)), int(mix64(shingles).sum(dtype=np.uint64))))
                least.append(minima(shingles))
            empty = np.array(sizes) == 0
            values = np.array(names, np.uint64).view(np.int64).reshape(-1, 2)
            sketches = [row.tobytes() for row in registers(np.array(least).reshape(-1, REGISTERS))]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3], pa.array(sizes, pa.int64()),
                    pa.array(values[:, 0], mask=empty), pa.array(values[:, 1], mask=empty),
                    pa.array(sketches, pa.binary(), mask=empty),
                ],
                ["doc_id", "k", "h", "n", "c1", "c2", "sketch"],
            )

    schema = (
        f"doc_id {source.schema['doc_id'].dataType.simpleString()}, k long, h long, n long, "
        "c1 long, c2 long, sketch binary"
    )
    return stored(source.mapInArrow(run, schema), "sketches")


def _bands(vertices: DataFrame) -> DataFrame:
    """(bucket, v) for every band of every sketch."""

    @tidy
    def run(batches):
        for batch in small(batches):
            sketches = batch.column(1).to_pylist()
            table = np.frombuffer(b"".join(sketches), np.uint16).reshape(-1, BANDS, ROWS)
            names = np.full(table.shape[:2], np.arange(BANDS), np.uint64)
            for row in range(ROWS):
                names = mix64(names * np.uint64(0x9E3779B97F4A7C15) + table[:, :, row] + np.uint64(1))
            own = pa.array(np.repeat(np.arange(len(sketches)), BANDS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.reshape(-1).view(np.int64)), batch.column(0).take(own)], ["bucket", "v"]
            )

    return vertices.select("v", "sketch").mapInArrow(run, "bucket long, v long")


def _hub_pairs(members: DataFrame, seed: int) -> DataFrame:
    """(a, b): each member with the hub of each of its buckets, chosen by a hash order."""
    order = F.struct(F.xxhash64("v", F.lit(seed)).alias("by"), F.col("v").alias("hub"), F.col("comp").alias("hub_comp"))
    hubs = members.groupBy("bucket").agg(F.min(order).alias("hub"))
    met = split_join(members, hubs, ["bucket"], "inner", "hubs").where("comp <> hub.hub_comp")
    return met.select(F.greatest("v", "hub.hub").alias("a"), F.least("v", "hub.hub").alias("b")).distinct()


def _size_class(size):
    return F.floor(F.log(size) / math.log(CLASS)).cast("int")


def _rare_pairs(members: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """(a, b): pairs of components that may hold linked sets, by an exact prefix-filtered join.

    A shingle of one component only is in no intersection that counts; it takes the first places
    of its set, all others follow by rarity. Linked sets share one of their first shingles, at
    places that leave enough behind on both sides. A set stays under its own class of sizes and
    visits those of the smaller sets it may be linked with, with just the places these allow. So
    sets with many shingles of their own meet nobody, however alike the rest is.
    """

    @tidy
    def cut(batches):
        for batch in small(batches, 100):
            sets = [np.frombuffer(x, np.uint64) for x in batch.column(2).to_pylist()]
            lengths = np.array([len(x) for x in sets])
            own = pa.array(np.repeat(np.arange(len(sets)), lengths))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(own), batch.column(1).take(own),
                    pa.array(np.repeat(lengths, lengths)), pa.array(np.concatenate(sets).view(np.int64)),
                ],
                ["v", "comp", "n", "shingle"],
            )

    overlap = lambda x, y: F.ceil(similar * (x + y) / (100 + similar))
    least = F.ceil(similar * F.col("n") / 100)
    own = sets.join(members.select("v", "comp").distinct(), "v").select("v", "comp", "shingles")
    shingles = stored(own.mapInArrow(cut, "v long, comp long, n long, shingle long"), "shingles")
    common = shingles.groupBy("shingle").agg(
        F.count("*").alias("holders"), F.min("comp").alias("low"), F.max("comp").alias("high")
    ).where("low < high").select("shingle", "holders")
    ordered = (
        split_join(shingles, common, ["shingle"], "inner", "common").groupBy("v", "comp", "n")
        .agg(F.array_sort(F.collect_list(F.struct("holders", "shingle"))).alias("others"))
        .where(F.size("others") >= least).withColumn("alone", F.col("n") - F.size("others"))
    )
    first = F.slice("others", F.lit(1), (F.col("n") - least + 1 - F.col("alone")).cast("int"))
    prefixes = stored(
        ordered.select("v", "comp", "n", "alone", F.posexplode(first).alias("place", "other"))
        .select("v", "comp", "n", F.col("other.shingle").alias("shingle"), (F.col("n") - F.col("alone") - F.col("place")).alias("left")),
        "prefixes",
    )
    homes = prefixes.where(F.col("left") >= overlap(F.col("n"), F.col("n"))).withColumn("class", _size_class(F.col("n")))
    smallest = F.greatest(least, F.floor(F.exp(F.col("class") * math.log(CLASS))))
    visits = prefixes.withColumn("class", F.explode(F.sequence(_size_class(least), _size_class(F.col("n"))))).where(
        F.col("left") >= overlap(F.col("n"), smallest)
    )
    # Sets of one component are one row here, with the widest of their bounds.
    together = lambda rows: rows.groupBy("shingle", "class", "comp").agg(
        F.max("left").alias("left"), F.min("n").alias("n")
    )
    x, y = together(visits).alias("x"), together(homes).alias("y")
    met = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.class") == F.col("y.class"))).where(
        "x.comp <> y.comp"
    ).where(F.least("x.left", "y.left") >= overlap(F.col("x.n"), F.col("y.n")))
    return met.select(F.greatest("x.comp", "y.comp").alias("a"), F.least("x.comp", "y.comp").alias("b")).distinct()


def first_links(ones: list[np.ndarray], others: list[np.ndarray], similar: int) -> list[tuple[int, int]]:
    """(i, j) for each set ``ones[i]`` that is linked with some of ``others``: j is the first.

    Sets are compared by where they differ from a common core, the shingles that over half of
    ``others`` hold: with d(x) = |x ^ core|, |x ^ y| = d(x) + d(y) - 2 |(x ^ core) & (y ^ core)|.
    So near copies cost what sets them apart, not their length.
    """
    held, times = np.unique(np.concatenate(others), return_counts=True)
    core = held[2 * times > len(others)]
    apart = [np.setxor1d(x, core, assume_unique=True) for x in others]
    sizes, far = np.array([len(x) for x in others]), np.array([len(x) for x in apart])
    own = np.repeat(np.arange(len(others)), far)
    flat = np.concatenate(apart)
    order = np.argsort(flat, kind="stable")
    flat, own = flat[order], own[order]
    found = []
    for i, one in enumerate(ones):
        change = np.setxor1d(one, core, assume_unique=True)
        low = np.searchsorted(flat, change)
        counts = np.searchsorted(flat, change, "right") - low
        at = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        shared = np.bincount(own[at], minlength=len(others))
        both = (len(one) + sizes - (len(change) + far - 2 * shared)) // 2
        linked_with = 100 * both >= similar * (len(one) + sizes - both)
        j = int(linked_with.argmax())
        if linked_with[j]:
            found.append((i, j))
    return found


def _links_between(pairs: DataFrame, members: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """(a, b), stored: for pairs (a, b) of components, exact links of the sets of the one with fewer
    to sets of the other, at most one for each set and block of the other.

    Both sides travel in blocks of BLOCK shingles, so neither a component nor all that meets it
    has to fit into one task.
    """
    named = pairs.select("a").union(pairs.select(F.col("b").alias("a"))).distinct()
    own = stored(
        members.select("v", "comp").distinct().join(named.select(F.col("a").alias("comp")), "comp", "left_semi")
        .join(sets.withColumn("n", F.length("shingles") / 8), "v"),
        "meeting",
    )
    sizes = stored(own.groupBy("comp").agg(F.sum("n").alias("size")), "sizes")
    blocks = lambda size: F.ceil(F.col(size) / BLOCK).cast("int")
    in_blocks = lambda rows, by: rows.withColumn("block", F.pmod(F.xxhash64("v"), blocks("size"))).groupBy(
        by, "block"
    ).agg(F.collect_list(F.struct("v", "shingles")).alias("rows"))
    side = lambda name: sizes.select(F.col("comp").alias(name), F.col("size").alias(f"size_{name}"))
    swap = F.struct("size_a", "a") < F.struct("size_b", "b")
    directed = stored(
        pairs.join(side("a"), "a").join(side("b"), "b").select(
            F.when(swap, F.col("a")).otherwise(F.col("b")).alias("comp"),
            F.when(swap, F.col("b")).otherwise(F.col("a")).alias("other"),
        ),
        "directed",
    )
    visiting = stored(split_join(own, directed, ["comp"], "inner", "met").select("other", "v", "shingles", "n"), "visiting")
    total = visiting.groupBy("other").agg(F.sum("n").alias("size"))
    guests = stored(in_blocks(split_join(visiting, total, ["other"], "inner", "totals"), "other"), "guests")
    hosts = in_blocks(
        own.join(directed.select(F.col("other").alias("comp")).distinct(), "comp", "left_semi").join(sizes, "comp"), "comp"
    )
    hosts = stored(hosts.select(F.col("comp").alias("other"), F.col("rows").alias("host")), "hosts")

    @tidy
    def run(batches):
        for batch in small(batches, 1):
            (v, ones), (w, others) = (
                (rows.field(0).to_numpy(), [np.frombuffer(x, np.uint64) for x in rows.field(1).to_pylist()])
                for rows in (batch.column(i).flatten() for i in (0, 1))
            )
            found = first_links(ones, others, similar)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v[i] for i, _ in found], pa.int64()), pa.array([w[j] for _, j in found], pa.int64())],
                ["a", "b"],
            )

    met = guests.join(hosts, "other").select("rows", "host")
    found = met.mapInArrow(run, "a long, b long")
    return stored(found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "links")


def _likely(pairs: DataFrame, vertices: DataFrame, similar: float) -> DataFrame:
    """Pairs (a, b) that sizes and joint likelihood let through."""
    side = lambda name: vertices.select(
        F.col("v").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}")
    )

    @tidy
    def run(batches):
        for batch in batches:
            tables = [
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                for i in (4, 5)
            ]
            a, b = (batch.column(i).to_numpy() for i in (2, 3))
            good = np.minimum(a, b) >= similar * np.maximum(a, b)
            above, below = (np.count_nonzero(c, axis=1) for c in (tables[0] > tables[1], tables[0] < tables[1]))
            keep = pa.array(good & ~surely_below(above, below, a, b, similar - MARGIN))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(keep)

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(run, "a long, b long").distinct()


def _sets(docs: DataFrame, vertices: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(v, shingles) of the wanted vertices, stored: the sorted hashes as bytes."""
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    keys = vertices.join(wanted.distinct(), "v", "left_semi").select("v", "k", "h")
    texts = docs.select(
        F.coalesce(key.cast("long"), F.lit(NULL_ID)).alias("k"), F.xxhash64(text).alias("h"), text.alias("text")
    ).withColumn("key", F.xxhash64("k", "h"))
    texts = maybe_among(texts, "key", key_bitmap(keys.select(F.xxhash64("k", "h")), FILTER_BITS))

    @tidy
    def run(batches):
        for batch in small(batches, 100):
            sets = [shingle_set(text).tobytes() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["v", "shingles"])

    found = texts.join(keys, ["k", "h"]).select("v", "text").dropDuplicates(["v"])
    return stored(found.mapInArrow(run, "v long, shingles binary"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs whose full sets are similar enough, stored."""

    @tidy
    def run(batches):
        for batch in small(batches):
            sides = ([np.frombuffer(x, np.uint64) for x in batch.column(i).to_pylist()] for i in (2, 3))
            keep = [linked(one, other, similar) for one, other in zip(*sides)]
            pairs = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"])
            yield pairs.filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(sets.select(F.col("v").alias("a"), F.col("shingles").alias("set_a")), "a").join(
        sets.select(F.col("v").alias("b"), F.col("shingles").alias("set_b")), "b"
    )
    return stored(joined.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long"), "links")


def _shared_ids(rows: DataFrame) -> DataFrame:
    """(a, b): a star over the different sets of each id."""
    own = rows.where("n > 0").select("k", _set_name().alias("v"))
    least = own.groupBy("k").agg(F.min("v").alias("b"), F.max("v").alias("most")).where("b < most")
    return split_join(own, least.select("k", "b"), ["k"], "inner", "shared").where("v > b").select(F.col("v").alias("a"), "b")


def _set_name():
    return F.xxhash64("c1", "c2")


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their components, of the buckets that hold several components; stored."""
    known = labels.select(F.col("a").alias("v"), F.col("b").alias("label"))
    own = members.select("bucket", "v").join(known, "v", "left").select("bucket", "v", F.coalesce("label", "v").alias("comp"))
    mixed = own.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
    return stored(split_join(own, mixed.select("bucket"), ["bucket"], "left_semi", "mixed"), "members")


def _linked(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (a, b) after ``links``, which only have to connect what has different labels yet."""
    return stored(followed(labels, components(relabelled(links, labels))), "labels")


def _linked_sets(
    docs: DataFrame, id_col: str, text_col: str, similar: int, by_id: bool
) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows as of ``sketch_documents``, and (c1, c2, label, k, h) for each set,
    (k, h) being its smallest text. Sets of one label are linked; with ``by_id`` those of one
    id are, too."""
    rows = sketch_documents(docs, id_col, text_col)
    vertices = stored(
        rows.where("n > 0").groupBy("c1", "c2")
        .agg(F.min(F.struct("k", "h")).alias("at"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
        .select("c1", "c2", _set_name().alias("v"), "at.k", "at.h", "n", "sketch"),
        "vertices",
    )
    bands = _bands(vertices)
    full = bands.groupBy("bucket").agg(F.min("v").alias("least"), F.max("v").alias("most")).where("least < most")
    members = stored(split_join(bands, full.select("bucket"), ["bucket"], "left_semi", "full"), "members")
    # A vertex may need its set in any round: they are made once, for all that met another.
    sets = _sets(docs, vertices, members.select("v"), id_col, text_col)
    # Where ids link nothing, the labels are known to be empty, so the plans lose their joins.
    unlinked = members.select(F.col("v").alias("a"), F.col("v").alias("b")).limit(0)
    labels = components(_shared_ids(rows)) if by_id else unlinked
    for seed in range(ROUNDS):
        members = _mixed(members, labels)
        likely = stored(_likely(_hub_pairs(members, seed), vertices, similar / 100), "likely")
        labels = _linked(labels, _confirmed(likely, sets, similar))
    members = _mixed(members, labels)
    rare = stored(_rare_pairs(members, sets, similar), "rare")
    labels = _linked(labels, _links_between(rare, members, sets, similar))
    known = labels.select(F.col("a").alias("v"), F.col("b").alias("label"))
    classes = vertices.select("c1", "c2", "v", "k", "h").join(known, "v", "left").select(
        "c1", "c2", F.coalesce("label", "v").alias("label"), "k", "h"
    )
    return rows.drop("sketch"), stored(classes, "classes")


def _with_least(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``rows`` with the smallest (k, h) of their label as ``least``; null for empty sets."""
    smallest = classes.groupBy("label").agg(F.min(F.struct("k", "h")).alias("least"))
    named = split_join(classes.select("c1", "c2", "label"), smallest, ["label"], "inner", "smallest")
    return split_join(rows, named.select("c1", "c2", "least"), ["c1", "c2"], "left", "classes")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: int = SIMILAR
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    Documents are linked where ``100 * intersection >= similar * union`` of their shingle
    sets; component_id is the smallest id that links lead to, kept marks its holder. Null and
    empty texts have an empty set and no links. A null id sorts before all others. Rows that
    repeat an id are one document, that is the union of their links. Other columns are ignored.
    """
    rows = _with_least(*_linked_sets(docs, id_col, text_col, similar, by_id=True))
    ids = rows.where("n > 0").groupBy("k").agg(F.min("least.k").alias("component"))
    component = F.coalesce("component", "k")
    shown = F.when(component != NULL_ID, component)
    return split_join(rows, ids, ["k"], "left", "ids").select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
        shown.alias("component_id"), F.col("doc_id").eqNullSafe(shown).alias("kept"),
    )


def near_duplicate_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: int = SIMILAR
) -> DataFrame:
    """One row per row of ``docs``: k, h, kept, where (k, h) is the pair of ``keyed_texts``.

    Here each text is a document of its own, whatever id it has: texts are linked by their sets
    alone, and of linked ones that of the smallest (k, h) is kept. An empty set is always kept.
    """
    rows = _with_least(*_linked_sets(docs, id_col, text_col, similar, by_id=False))
    first = (F.col("least.k") == F.col("k")) & (F.col("least.h") == F.col("h"))
    return rows.select("k", "h", F.coalesce(first, F.lit(True)).alias("kept"))
