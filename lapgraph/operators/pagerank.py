"""PageRank as iterated joins, one job for any number of graphs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapgraph.operators.skew import skew_join
from lapgraph.session import ensure_checkpoint_dir

# Edges of one source that one task joins; a source with more has as many splits as it needs.
EDGES_PER_SPLIT = 100_000
# Edges of a partition of the layout that all rounds join on: at most, and at least where cores are left.
EDGES_PER_PARTITION, LEAST_EDGES = 1_000_000, 100_000
# So many times more where a task adds up what its edges send before it is shuffled: the more of them
# meet in a task, the fewer sums there are.
PUSHED = 4
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


def _partitions(edges: DataFrame, times: int = 1) -> int:
    """How many partitions the layout of ``edges`` has, by their measured number; ``times`` more edges may be in one."""
    rows, cores = edges.count(), edges.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-rows // (times * EDGES_PER_PARTITION)), min(cores, -(-rows // LEAST_EDGES)))


@contextmanager
def shuffled_in(spark: SparkSession, partitions: int):
    """Shuffles inside have as many partitions as the layout, so joins meet it without moving it."""
    before = spark.conf.get(SHUFFLE_PARTITIONS)
    spark.conf.set(SHUFFLE_PARTITIONS, str(partitions))
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, before)


def edge_vertices(edges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Every end of an edge, once."""
    return edges.select(
        *keys, F.explode(F.array("src", "dst")).alias("id")
    ).distinct()


def interaction_graph(edge_sets: Sequence[DataFrame]) -> DataFrame:
    """Distinct (session_id, src, dst) over all given interaction tables."""
    merged: DataFrame | None = None
    for edges in edge_sets:
        pairs = edges.select(
            "session_id", F.col("attacker_id").alias("src"), F.col("defender_id").alias("dst")
        )
        merged = pairs if merged is None else merged.unionByName(pairs)
    if merged is None:
        raise ValueError("at least one edge table is needed")
    return merged.distinct()


def pagerank(
    vertices: DataFrame | None,
    edges: DataFrame,
    keys: Sequence[str] = (),
    max_iter: int = 10,
    reset_prob: float = 0.15,
    weight: str | None = None,
    dangling: bool = False,
    normalize: bool = False,
    initial: DataFrame | None = None,
    checkpoint_every: int = 1,
    edges_per_split: int = EDGES_PER_SPLIT,
) -> DataFrame:
    """(keys, id, pagerank_score) after ``max_iter`` rounds of

        rank = reset + (1 - reset) * sum(rank(src) * share of the edge)

    Ranks start at 1/N per graph and are not normalised: a vertex without incoming edges
    gets ``reset``, and rank that reaches a vertex without outgoing edges is lost. Options:
    ``weight`` splits a rank by edge weight, ``dangling`` spreads the lost rank evenly,
    ``normalize`` scales the result to sum 1, ``initial`` (keys, id, rank) warm-starts.

    Without ``vertices`` the ends of the edges are ranked. ``keys`` name the graph an edge
    belongs to; all graphs are ranked in the same rounds.
    Every ``checkpoint_every`` rounds the ranks (one row per vertex) are written to the
    checkpoint folder, so plans stay short and a lost executor costs one round.

    The edges are kept when first read, so what they come from is computed once, and laid out by
    source, in partitions as many as their number asks for; a round moves ranks and sums per
    target, never edges. A source has one split for every ``edges_per_split`` of its edges and sends its rank
    once to each, so no task gets more of one source, however many edges that has.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    keys = list(keys)
    given = edges.select(*keys, "src", "dst", *([weight] if weight else [])).persist(StorageLevel.MEMORY_AND_DISK)
    # A fixed partition count, so that every round joins on this layout without moving it.
    partitions = _partitions(given)
    out = F.sum(weight) if weight else F.count("*")
    degrees = given.groupBy(*keys, "src").agg(
        out.cast("double").alias("_out"),
        F.ceil(F.count("*") / edges_per_split).cast("int").alias("_splits"),
    )
    share = (F.col(weight).cast("double") if weight else F.lit(1.0)) / F.col("_out")
    source = [*keys, "src"]
    split = F.pmod(F.xxhash64("dst"), F.col("_splits")).cast("int").alias("_split")
    local = (
        skew_join(given, degrees, source)
        .select(*source, split, "dst", share.alias("_share"))
        .repartition(partitions, *source, "_split")
        .sortWithinPartitions(*source, "_split")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    ids = edge_vertices(given, keys) if vertices is None else vertices.select(*keys, "id")
    sizes = ids.groupBy(*keys).agg(F.count("*").alias("_n"))
    sized = skew_join(ids, sizes, keys) if keys else ids.withColumn("_n", sizes.scalar())
    known = (
        sized.join(degrees.withColumnRenamed("src", "id"), [*keys, "id"], "left")
        .select(*keys, "id", "_n", "_splits")
        .repartition(partitions, *keys, "id")
        .sortWithinPartitions(*keys, "id")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        with shuffled_in(spark, partitions):
            ranks = known.withColumn("rank", F.lit(1.0) / F.col("_n"))
            if initial is not None:
                warm = initial.select(*keys, "id", F.col("rank").alias("_warm"))
                ranks = known.join(warm, [*keys, "id"], "left").select(
                    *known.columns, F.coalesce("_warm", F.lit(1.0) / F.col("_n")).alias("rank")
                )
            for round_no in range(1, max_iter + 1):
                ranks = _round(ranks, known, local, keys, reset_prob, dangling)
                # With dangling ranks a round reads them twice, so the plan is cut every time.
                if round_no < max_iter and (dangling or round_no % checkpoint_every == 0):
                    ranks = ranks.checkpoint()
            scores = ranks.select(*keys, "id", F.col("rank").alias("pagerank_score"))
            if normalize:
                scores = _normalized(scores.checkpoint(), keys)
            return scores.checkpoint()
    finally:
        for table in (given, local, known):
            table.unpersist()


def _round(
    ranks: DataFrame, known: DataFrame, local: DataFrame, keys: list[str], reset: float, dangling: bool
) -> DataFrame:
    senders = ranks.filter("_splits IS NOT NULL").select(
        *keys, F.col("id").alias("src"), "rank",
        F.explode(F.sequence(F.lit(0), F.col("_splits") - 1)).alias("_split"),
    )
    shares = local.join(senders, [*keys, "src", "_split"]).select(
        *keys, "dst", (F.col("rank") * F.col("_share")).alias("_sent")
    )
    received = shares.groupBy(*keys, F.col("dst").alias("id")).agg(F.sum("_sent").alias("_in"))
    inflow: Column = F.coalesce(F.col("_in"), F.lit(0.0))
    joined = known.join(received, [*keys, "id"], "left")
    if dangling:
        lost = ranks.filter("_splits IS NULL").groupBy(*keys).agg(F.sum("rank").alias("_lost"))
        if keys:
            joined = skew_join(joined, lost, keys, "left")
        else:
            joined = joined.withColumn("_lost", lost.scalar())
        inflow = inflow + F.coalesce(F.col("_lost"), F.lit(0.0)) / F.col("_n")
    return joined.select(
        *known.columns, (F.lit(reset) + F.lit(1 - reset) * inflow).alias("rank")
    )


def _normalized(scores: DataFrame, keys: list[str]) -> DataFrame:
    totals = scores.groupBy(*keys).agg(F.sum("pagerank_score").alias("_total"))
    joined = skew_join(scores, totals, keys) if keys else scores.withColumn("_total", totals.scalar())
    return joined.withColumn(
        "pagerank_score", F.col("pagerank_score") / F.col("_total")
    ).drop("_total")


def compute_pagerank(
    vertices: DataFrame, edges: DataFrame, max_iter: int = 10, reset_prob: float = 0.15, **options
) -> DataFrame:
    """``pagerank`` for tables with any column names: the first column is the vertex id, the
    first two are source and target unless they are named so."""
    if "id" not in vertices.columns:
        vertices = vertices.withColumnRenamed(vertices.columns[0], "id")
    if not {"src", "dst"} <= set(edges.columns):
        first, second = edges.columns[:2]
        edges = edges.withColumnsRenamed({first: "src", second: "dst"})
    return pagerank(vertices, edges, max_iter=max_iter, reset_prob=reset_prob, **options)


def session_pagerank(edge_sets: Sequence[DataFrame], **options) -> DataFrame:
    """PageRank of the drivers inside every session; a session without edges gives no rows."""
    edges = interaction_graph(edge_sets)
    return pagerank(None, edges, ["session_id"], **options)


def _level(series: Column, step: Column, field: str) -> Column:
    """The value of a piecewise-constant series at a step; NULL before its first entry."""
    return F.try_element_at(F.filter(series, lambda p: p["at"] <= step), F.lit(-1))[field]


def _summed(changes: Column) -> Column:
    """A sorted array of (at, delta) as a series (at, value) of running sums."""
    return F.transform(changes, lambda p: F.struct(
        p["at"].alias("at"),
        F.aggregate(F.filter(changes, lambda q: q["at"] <= p["at"]), F.lit(0.0), lambda a, q: a + q["delta"]).alias("value"),
    ))


def _merged_series(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, series) from rows (keys, at, delta): one entry per step, at most as many as steps."""
    steps = rows.groupBy(*keys, "at").agg(F.sum("delta").alias("delta"))
    return steps.groupBy(*keys).agg(_summed(F.array_sort(F.collect_list(F.struct("at", "delta")))).alias("series"))


def rank_trend(edges: DataFrame, up_to: str, last: int | None = None, max_iter: int = 10, reset_prob: float = 0.15) -> DataFrame:
    """PageRank of the graph up to each value of ``up_to`` and its change per step.

    ``edges`` holds (src, dst, up_to); an edge counts from its first appearance on. The steps
    end with the largest in the data, or with ``last``; edges first seen later do not count.

    All steps are ranked at once: a vertex has one row with its ranks as a piecewise-constant
    series (at, value), from the step on that first has it. An edge is stored once, with its
    first step, and sends the part of its source's series from there on, as changes. What is
    shuffled are the sums of changes per target and step.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    kind = edges.schema[up_to].dataType
    first = edges.groupBy("src", "dst").agg(F.min(up_to).cast("long").alias("_first"))
    if last is None:
        last = edges.agg(F.max(up_to)).first()[0]
    first = first.where(F.col("_first") <= F.lit(last)).persist(StorageLevel.MEMORY_AND_DISK)
    one = F.lit(1.0).alias("delta")
    degrees = _merged_series(first.select("src", F.col("_first").alias("at"), one), ["src"]).withColumnRenamed("series", "degrees")
    born = first.select("_first", F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.min("_first").alias("_born"))
    born = born.join(degrees.withColumnRenamed("src", "id"), "id", "left").persist(StorageLevel.MEMORY_AND_DISK)
    # One row with an entry per step.
    sizes = _merged_series(born.select(F.lit(0).alias("all"), F.col("_born").alias("at"), one), ["all"]).select("series").scalar()
    start = F.struct(F.col("_born").alias("at"), (F.lit(1.0) / _level(F.col("_sizes"), F.col("_born"), "value")).alias("value"))
    later = F.transform(
        F.filter("_sizes", lambda p: p["at"] > F.col("_born")),
        lambda p: F.struct(p["at"].alias("at"), (F.lit(1.0) / p["value"]).alias("value")),
    )
    try:
        ranks = born.withColumn("_sizes", sizes).select("id", "_born", "degrees", F.concat(F.array(start), later).alias("ranks")).checkpoint()
        for _ in range(max_iter):
            ranks = _trend_round(ranks, born, first, reset_prob).checkpoint()
        end = F.lit(last).cast("long")
        steps = ranks.select("id", "ranks", F.explode(F.sequence("_born", end)).alias("_step"))
        score = lambda step: _level(F.col("ranks"), step, "value")
        return steps.select(
            F.col("_step").cast(kind).alias(up_to), "id", score(F.col("_step")).alias("pagerank_score"),
            (score(F.col("_step")) - score(F.col("_step") - 1)).alias("score_change"),
        )
    finally:
        first.unpersist()
        born.unpersist()


def _trend_round(ranks: DataFrame, born: DataFrame, first: DataFrame, reset: float) -> DataFrame:
    """One round for all steps; the share of an edge changes where rank or degree of its source do."""
    steps = F.array_sort(F.array_distinct(F.transform(F.concat("ranks", "degrees"), lambda p: p["at"])))
    shares = F.transform(steps, lambda t: F.struct(
        t.alias("at"), (_level(F.col("ranks"), t, "value") / _level(F.col("degrees"), t, "value")).alias("value")
    ))
    senders = ranks.filter("degrees IS NOT NULL").select(F.col("id").alias("src"), shares.alias("shares"))
    begin = F.struct(F.col("_first").alias("at"), _level(F.col("shares"), F.col("_first"), "value").alias("value"))
    rest = F.filter("shares", lambda p: p["at"] > F.col("_first"))
    sent = skew_join(first, senders, ["src"]).select("dst", F.concat(F.array(begin), rest).alias("part"))
    deltas = F.transform("part", lambda p, i: F.struct(
        p["at"].alias("at"), F.when(i == 0, p["value"]).otherwise(p["value"] - F.get("part", i - 1)["value"]).alias("delta")
    ))
    received = _merged_series(
        sent.select("dst", F.explode(F.filter(deltas, lambda p: p["delta"] != 0)).alias("_d")).select(
            F.col("dst").alias("id"), "_d.at", "_d.delta"
        ), ["id"],
    )
    alone = F.struct(F.col("_born").alias("at"), F.lit(reset).alias("value"))
    inflow = F.transform("series", lambda p: F.struct(p["at"].alias("at"), (F.lit(reset) + F.lit(1 - reset) * p["value"]).alias("value")))
    late = F.col("series").isNull() | (F.get("series", F.lit(0))["at"] > F.col("_born"))
    rank = F.concat(F.when(late, F.array(alone)).otherwise(F.slice(F.array(alone), 1, 0)), F.coalesce(inflow, F.slice(F.array(alone), 1, 0)))
    return born.join(received, "id", "left").select("id", "_born", "degrees", rank.alias("ranks"))


@dataclass
class PushedRanks:
    """``ranks`` (id, pagerank_score) and how many edges carried something to get there."""

    ranks: DataFrame
    edges_sent: int


def push_pagerank(
    edges: DataFrame, previous: DataFrame | None = None, before: DataFrame | None = None, reset_prob: float = 0.15,
    tolerance: float = 1e-9, edges_per_split: int = EDGES_PER_SPLIT,
) -> PushedRanks:
    """The ranks that ``pagerank`` tends to, by pushing residuals; incremental with ``previous``.

    A vertex has a rank and a residual, what is missing to its equation. In a round the
    vertices whose residual exceeds ``tolerance`` add it to their rank and send (1 - reset)
    times it along their edges; others send nothing. With the ranks ``previous`` of the graph
    ``before``, only sources that gained or lost edges leave residuals at first, what their old
    edges sent less what their new ones do, so the work follows the change and not the graph.
    Both edge tables hold distinct (src, dst).

    A round reads ranks and residuals twice, so they are written to the checkpoint folder each time,
    in as many partitions as the number of edges asks for. The edges are laid out once, the targets of
    a split as one array, so a round joins splits and not edges.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    if (previous is None) != (before is None):
        raise ValueError("previous ranks and their edges belong together")
    given = edges.select("src", "dst")
    partitions = _partitions(given, PUSHED)
    degrees = given.groupBy("src").agg(
        F.count("*").alias("_out"), F.ceil(F.count("*") / edges_per_split).cast("int").alias("_splits")
    )
    known = edge_vertices(given).join(degrees.withColumnRenamed("src", "id"), "id", "left")
    with shuffled_in(spark, partitions):
        # Rounds join on numbers; the written table fixes them.
        names = known.withColumn("no", F.monotonically_increasing_id()).checkpoint()
        most = names.agg(F.max("_splits")).first()[0] or 1
        slot = lambda split: (F.col("no") * most + split).alias("slot")
        split = F.pmod(F.xxhash64("dst"), F.col("_splits"))
        sources = names.select(F.col("id").alias("src"), "no", "_splits")
        targets = names.select(F.col("id").alias("dst"), F.col("no").alias("to"))
        local = (
            skew_join(given, sources.hint("shuffle_hash"), ["src"]).select(slot(split), "dst")
            .join(targets.hint("shuffle_hash"), "dst").select("slot", "to")
            .repartition(partitions, "slot").groupBy("slot").agg(F.collect_list("to").alias("targets"))
            .sortWithinPartitions("slot").persist(StorageLevel.MEMORY_AND_DISK)
        )
        reset, sent = F.lit(reset_prob), F.lit(0).cast("long").alias("_sent")
        if previous is None:
            state = names.select("no", "_out", "_splits", F.lit(0.0).alias("rank"), reset.alias("rest"), sent)
        else:
            ranks = previous.select("id", F.col("pagerank_score").alias("rank"))
            moved = _moved_shares(given, before.select("src", "dst"), ranks, 1 - reset_prob)
            state = names.join(ranks, "id", "left").join(moved, "id", "left").select(
                "no", "_out", "_splits", F.coalesce("rank", F.lit(0.0)).alias("rank"),
                (F.coalesce("_moved", F.lit(0.0)) + F.when(F.col("rank").isNull(), reset).otherwise(0.0)).alias("rest"), sent,
            )
        open_ = F.abs("rest") > tolerance
        try:
            state = state.repartition(partitions, "no").sortWithinPartitions("no").checkpoint()
            while not state.filter(open_).isEmpty():
                state = _push(state, local, open_, 1 - reset_prob, slot).checkpoint()
            total = state.agg(F.sum("_sent")).first()[0] or 0
            ranks = names.select("id", "no").join(state, "no")
            return PushedRanks(ranks.select("id", (F.col("rank") + F.col("rest")).alias("pagerank_score")), total)
        finally:
            local.unpersist()


def _push(state: DataFrame, local: DataFrame, open_: Column, kept: float, slot: Callable[[Column], Column]) -> DataFrame:
    splits = F.explode(F.sequence(F.lit(0), F.col("_splits") - 1)).alias("_split")
    share = (F.lit(kept) * F.col("rest") / F.col("_out")).alias("_share")
    senders = state.filter(open_ & F.col("_splits").isNotNull()).select("no", share, splits).select(slot(F.col("_split")), "_share")
    sent = local.join(senders, "slot").select(F.explode("targets").alias("no"), "_share")
    received = sent.groupBy("no").agg(F.sum("_share").alias("_in"))
    taken = F.when(open_, F.col("rest")).otherwise(0.0)
    return state.join(received, "no", "left").select(
        "no", "_out", "_splits", (F.col("rank") + taken).alias("rank"),
        (F.col("rest") - taken + F.coalesce("_in", F.lit(0.0))).alias("rest"),
        (F.col("_sent") + F.when(open_, F.coalesce("_out", F.lit(0))).otherwise(0)).alias("_sent"),
    )


def _moved_shares(now: DataFrame, before: DataFrame, ranks: DataFrame, kept: float) -> DataFrame:
    """(id, _moved): what the sources with other edges than before send more or less to ``id``."""
    pair = ["src", "dst"]
    there = lambda edges, is_now: edges.select(*pair, F.lit(is_now).alias("_now"), F.lit(not is_now).alias("_before"))
    held = there(now, True).unionByName(there(before, False)).groupBy(*pair).agg(
        F.bool_or("_now").alias("_now"), F.bool_or("_before").alias("_before")
    )
    changed = held.filter("_now != _before").select("src").distinct()

    def shares(edges: DataFrame, sign: float) -> DataFrame:
        own = skew_join(edges, changed.hint("shuffle_hash"), ["src"], "left_semi")
        degree = own.groupBy("src").agg((F.lit(sign * kept) / F.count("*")).alias("_share"))
        weighted = degree.join(ranks.withColumnRenamed("id", "src"), "src").select("src", (F.col("_share") * F.col("rank")).alias("_part"))
        return skew_join(own, weighted.hint("shuffle_hash"), ["src"]).select(F.col("dst").alias("id"), "_part")

    both = shares(now, 1.0).unionByName(shares(before, -1.0))
    return both.groupBy("id").agg(F.sum("_part").alias("_moved"))


def window_edges(edges: DataFrame, step: str, last: int, width: int) -> DataFrame:
    """Distinct (src, dst) of the ``width`` steps that end with ``last``."""
    return edges.filter(F.col(step).between(last - width + 1, last)).select("src", "dst").distinct()
