"""Operators over ordered groups that never hold a whole group in one task.

The position axis (lap number, time, rank) is cut into blocks of fixed width. Work inside
a block is a window over (keys, block); what crosses a block edge travels as one summary
row per block, so the second, per-key step sees blocks instead of rows. Keys must not be NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def block_of(position: Column, width: int) -> Column:
    return F.floor(position / F.lit(width)).cast("long")


def time_block(ts: Column, seconds: int) -> Column:
    return block_of(F.unix_seconds(ts.cast("timestamp")), seconds)


def neighbour_row(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    carry: Sequence[str],
    width: int,
    out: str,
    step: int = -1,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Add ``out``, the ``carry`` struct of the previous (step -1) or next (step 1) row.

    Rows are ordered by (position, *tie) within ``keys``.
    """
    rank = F.struct(position, *tie)
    payload = F.struct(*carry)
    blocked = df.withColumn("_block", block_of(F.col(position), width))
    inside = Window.partitionBy(*keys, "_block").orderBy(position, *tie)
    shift, edge = (F.lag, F.max_by) if step < 0 else (F.lead, F.min_by)
    local = blocked.withColumn(out, shift(payload).over(inside))

    over_blocks = Window.partitionBy(*keys).orderBy("_block")
    edges = (
        blocked.groupBy(*keys, "_block")
        .agg(edge(payload, rank).alias("_edge"))
        .withColumn("_beyond", shift("_edge").over(over_blocks))
        .select(*keys, "_block", "_beyond")
    )
    return (
        local.join(edges, [*keys, "_block"], "left")
        .withColumn(out, F.coalesce(out, "_beyond"))
        .drop("_block", "_beyond")
    )


def running_agg(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    value: str,
    width: int,
    out: str,
    agg: Callable[[str], Column] = F.sum,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Add ``out``, the sum (or max, min) of ``value`` up to and including the row.

    NULL values count for nothing; the result is NULL only until the first value.
    """
    combine = {F.sum: lambda a, b: a + b, F.max: F.greatest, F.min: F.least}[agg]
    blocked = df.withColumn("_block", block_of(F.col(position), width))
    inside = (
        Window.partitionBy(*keys, "_block")
        .orderBy(position, *tie)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    before = (
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = (
        blocked.groupBy(*keys, "_block")
        .agg(agg(value).alias("_total"))
        .withColumn("_base", agg("_total").over(before))
        .select(*keys, "_block", "_base")
    )
    base, local = F.col("_base"), F.col("_local")
    return (
        blocked.withColumn("_local", agg(value).over(inside))
        .join(bases, [*keys, "_block"], "left")
        .withColumn(out, F.coalesce(combine(base, local), local, base))
        .drop("_block", "_local", "_base")
    )


def number_runs(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    carry: Sequence[str],
    starts_run: Callable[[Column], Column],
    width: int,
    out: str,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Number the runs of a group from 1; ``starts_run(previous_row)`` opens a new run.

    ``starts_run`` compares the ``carry`` columns of the previous row with those of the row
    itself; a comparison that gives NULL opens none, so columns with NULLs need a null-safe
    one. Rows are ordered by (position, *tie). The first row of a group always opens a run. Breaks inside a block are counted
    there; one row per block (its first row, its last row, its breaks) settles the edges.
    """
    def opens(previous: Column) -> Column:
        return F.when(previous.isNull(), F.lit(1)).otherwise(
            F.coalesce(starts_run(previous).cast("int"), F.lit(0))
        )

    inside = Window.partitionBy(*keys, "_block").orderBy(position, *tie)
    row, order = F.struct(*carry), F.struct(position, *tie)
    blocked = df.withColumn("_block", block_of(F.col(position), width)).withColumn(
        "_prev", F.lag(row).over(inside)
    )
    breaks = F.when(F.col("_prev").isNull(), 0).otherwise(opens(F.col("_prev")))
    local = blocked.withColumn("_breaks", breaks)
    before = (
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    )
    bases = (
        local.groupBy(*keys, "_block")
        .agg(
            F.min_by(row, order).alias("_first"),
            F.max_by(row, order).alias("_last"),
            F.sum("_breaks").alias("_inner"),
        )
        .withColumn("_prev", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_block")))
        .select(*keys, "_block", "_first.*", "_prev", "_inner")
        .withColumn("_edge", opens(F.col("_prev")))
        .withColumn("_base", F.sum(F.col("_edge") + F.col("_inner")).over(before) - F.col("_inner"))
        .select(*keys, "_block", "_base")
    )
    running = F.sum("_breaks").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (
        local.withColumn("_local", running)
        .join(bases, [*keys, "_block"], "left")
        .withColumn(out, F.col("_local") + F.col("_base"))
        .drop("_block", "_prev", "_breaks", "_local", "_base")
    )


def asof_forward(
    points: DataFrame,
    marks: DataFrame,
    keys: Sequence[str],
    point_ts: str,
    mark_ts: str,
    payload: Sequence[str],
    seconds: int,
    out: str = "match",
) -> DataFrame:
    """Give each point the first mark of its keys with ``mark_ts >= point_ts``.

    A mark at exactly the point's time matches. Points with no later mark get NULL.
    """
    pts = points.withColumn("_block", time_block(F.col(point_ts), seconds))
    mks = marks.filter(F.col(mark_ts).isNotNull()).select(
        *keys,
        time_block(F.col(mark_ts), seconds).alias("_block"),
        F.col(mark_ts).alias("_at"),
        F.struct(*payload).alias("_mark"),
    )
    first_in_block = mks.groupBy(*keys, "_block").agg(
        F.min_by("_mark", F.struct("_at", "_mark")).alias("_first")
    )
    blocks = (
        pts.select(*keys, "_block")
        .distinct()
        .unionByName(first_in_block, allowMissingColumns=True)
        .groupBy(*keys, "_block")
        .agg(F.first("_first", ignorenulls=True).alias("_first"))
    )
    # Descending order turns "first one after me" into a growing frame.
    later = (
        Window.partitionBy(*keys)
        .orderBy(F.desc("_block"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    beyond = blocks.withColumn("_mark", F.last("_first", ignorenulls=True).over(later)).select(
        *keys, "_block", F.lit(None).cast(points.schema[point_ts].dataType).alias("_at"), "_mark"
    )
    candidates = mks.unionByName(beyond.filter("_mark IS NOT NULL")).withColumn("_is_mark", F.lit(1))
    stream = pts.withColumns({"_at": F.col(point_ts), "_is_mark": F.lit(0)}).unionByName(
        candidates, allowMissingColumns=True
    )
    inside = (
        Window.partitionBy(*keys, "_block")
        .orderBy(F.col("_at").desc_nulls_first(), F.desc("_is_mark"), F.desc("_mark"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        stream.withColumn(out, F.last("_mark", ignorenulls=True).over(inside))
        .filter("_is_mark = 0")
        .drop("_block", "_at", "_mark", "_is_mark")
    )


def dyadic_cover(first: Column, last: Column) -> Column:
    """The fewest aligned ranges of blocks that make up [first, last]: an array of (level, place),
    a range of 2**level blocks from place * 2**level on. At most two for each level, so a span
    of n blocks has at most 2 * log2(n) + 1."""
    size = (last - first + 1).cast("double")
    levels = F.sequence(F.lit(0), F.ceil(F.log2(size)).cast("int"))

    def ranges(level: Column) -> Column:
        low = -_shift_right(-first, level)
        high = _shift_right(last + 1, level)
        of = lambda place: F.array(F.struct(level.alias("level"), place.alias("place")))
        none = F.slice(of(low), 1, 0)
        left = F.when((low < high) & (low.bitwiseAND(F.lit(1)) == 1), of(low)).otherwise(none)
        right = F.when((low < high) & (high.bitwiseAND(F.lit(1)) == 1), of(high - 1)).otherwise(none)
        return F.concat(left, right)

    return F.flatten(F.transform(levels, ranges))


def point_in_span(
    points: DataFrame, spans: DataFrame, keys: Sequence[str], point_ts: str, span_start: str, span_end: str, seconds: int
) -> DataFrame:
    """``points`` with every span of the same keys that contains them (ends included).

    An equi join on (keys, aligned range of blocks): a span is listed under its
    ``dyadic_cover``, a point under the ranges around it, of the levels that occur in any
    cover. Exactly one range of a cover holds a given block, so a pair meets once, and neither
    side grows with the length of the spans.
    """
    ends = time_block(F.col(span_start), seconds), time_block(F.col(span_end), seconds)
    listed = spans.filter(F.col(span_start) <= F.col(span_end)).withColumn("_range", F.explode(dyadic_cover(*ends)))
    levels = listed.agg(F.collect_set("_range.level").alias("_levels")).scalar()
    block = time_block(F.col(point_ts), seconds)
    return (
        points.withColumn("_level", F.explode(levels))
        .withColumn("_range", F.struct(F.col("_level").alias("level"), _shift_right(block, F.col("_level")).alias("place")))
        .drop("_level")
        .join(listed, [*keys, "_range"])
        .filter(F.col(point_ts).between(F.col(span_start), F.col(span_end)))
        .drop("_range")
    )


def interval_join(
    points: DataFrame, spans: DataFrame, keys: Sequence[str], point_ts: str, span_start: str, span_end: str, seconds: int,
) -> DataFrame:
    """Pair points with the spans of the same keys that contain them (ends included)."""
    return point_in_span(points, spans, keys, point_ts, span_start, span_end, seconds)


def overlap_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_span: tuple[str, str], right_span: tuple[str, str],
    seconds: int,
) -> DataFrame:
    """Pair spans of the same keys that overlap (more than an end point in common).

    Of two overlapping spans the one that starts later starts inside the other: left spans
    that start inside right ones, and right spans that start inside left ones but not where
    they start. Spans that end before they start overlap with nothing.
    """
    out = [*left.columns, *[c for c in right.columns if c not in keys]]
    (begin, end), (other_begin, other_end) = left_span, right_span
    own, other = left.filter(F.col(begin) <= F.col(end)), right.filter(F.col(other_begin) <= F.col(other_end))
    inside = point_in_span(own, other, keys, begin, other_begin, other_end, seconds).select(*out)
    around = point_in_span(other, own, keys, other_begin, begin, end, seconds).select(*out)
    pairs = inside.unionByName(around.filter(F.col(begin) < F.col(other_begin)))
    return pairs.filter((F.col(begin) < F.col(other_end)) & (F.col(other_begin) < F.col(end)))


def lower_side_keys(value: Column, width: int, levels: Column) -> Column:
    """Join keys of the smaller value in ``smaller < larger``; see ``upper_side_keys``."""
    return _side_keys(value, width, levels, 0)


def upper_side_keys(value: Column, width: int, levels: Column) -> Column:
    """Join keys of the larger value.

    Two values in one block share the key (-1, block). Two values in different blocks
    differ first, from the top, at one bit of the block number: there the smaller has 0,
    the larger 1, and both share the bits above. So every ordered pair shares exactly one
    key, and keys other than (-1, block) pair up ordered values only.
    """
    return _side_keys(value, width, levels, 1)


def _side_keys(value: Column, width: int, levels: Column, bit: int) -> Column:
    block = block_of(value, width)
    same = F.array(F.struct(F.lit(-1).alias("level"), block.alias("prefix")))
    all_levels = F.slice(F.sequence(F.lit(0), F.lit(62)), F.lit(1), levels)
    fitting = F.filter(all_levels, lambda l: _bit_at(block, l) == F.lit(bit))
    across = F.transform(
        fitting,
        lambda l: F.struct(
            l.alias("level"), _shift_right(block, l + F.lit(1)).alias("prefix")
        ),
    )
    return F.concat(same, across)


def _shift_right(value: Column, by: Column) -> Column:
    return F.call_function("shiftright", value, by)


def _bit_at(value: Column, at: Column) -> Column:
    return _shift_right(value, at).bitwiseAND(F.lit(1))
