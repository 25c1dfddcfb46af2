"""Range join as an equi-join.

A range of integer cells splits into at most two aligned blocks per size 1, 2, 4, …; a point lies in
exactly one aligned block of each size. Joining on the block therefore meets every (point, range)
pair once, without a nested loop and without a bin width to tune. Bounds are re-checked exactly.
"""

from pyspark.sql import Column, DataFrame, functions as F

from rulecast.operators.skew import salted_join, spread_evenly, tiled_join


def range_join(
    points: DataFrame,
    ranges: DataFrame,
    point: str,
    low: str,
    high: str,
    cell: float = 1.0,
    bits: int = 20,
) -> DataFrame:
    """Rows of both sides with ``low <= point <= high``.

    ``cell`` is the resolution of the blocks and ``2**bits`` their number; values outside that
    domain are clamped into its first or last cell, which costs time but not correctness.
    """
    spread = spread_evenly(points.where(F.col(point).isNotNull()))
    spread = _point_blocks(spread, F.col(point), cell, bits).select(*points.columns, "_size", "_block")
    covered = _range_blocks(ranges.where(F.col(low) <= F.col(high)), F.col(low), F.col(high), cell, bits)
    # Salted by the whole point row: one value may be shared by many points.
    pairs = salted_join(spread, covered, ["_size", "_block"], F.xxhash64(*points.columns))
    exact = F.col(point).between(F.col(low), F.col(high))
    return pairs.where(exact).drop("_size", "_block")


def first_in_range(
    points: DataFrame,
    ranges: DataFrame,
    point: str,
    previous: str,
    low: str,
    high: str,
    width: float,
    cell: float = 1.0,
    bits: int = 20,
) -> DataFrame:
    """Rows of both sides with ``low <= point <= high`` where ``previous`` does not reach ``low``.

    ``previous`` is the next smaller point of the same owner, NULL for its first one: an owner meets a
    range once, at the first of its points in it. A point close behind another one, by ``width`` at
    most, is met by the ranges that begin between the two; any other by the ranges that hold it. So
    the ranges that hold both are not met again and again. ``width`` changes the cost only; that of a
    usual range is right.
    """
    known, low_end, high_end = F.col(point).isNotNull(), F.col(low), F.col(high)
    behind = F.col(point).cast("double") - F.col(previous).cast("double")
    close = F.coalesce(behind <= F.lit(float(width)), F.lit(False))
    held = _point_blocks(points.where(known & ~close), F.col(point), cell, bits).withColumn("_begins", F.lit(False))
    gaps = _range_blocks(points.where(known & close), F.col(previous), F.col(point), cell, bits).withColumn("_begins", F.lit(True))
    some = ranges.where(low_end <= high_end)
    holding = _range_blocks(some, low_end, high_end, cell, bits).withColumn("_begins", F.lit(False))
    beginning = _point_blocks(some, low_end, cell, bits).withColumn("_begins", F.lit(True))
    pairs = tiled_join(held.unionByName(gaps), holding.unionByName(beginning), ["_begins", "_size", "_block"])
    exact = F.col(point).between(low_end, high_end) & (F.col(previous).isNull() | (F.col(previous) < low_end))
    return pairs.where(exact).drop("_begins", "_size", "_block")


def _cell_of(value: Column, cell: float, bits: int) -> Column:
    # Clamped as a double: the cells of huge and infinite values fit no integer.
    index = value.cast("double") / F.lit(float(cell)) + F.lit(float(1 << (bits - 1)))
    return F.floor(F.least(F.greatest(index, F.lit(0.0)), F.lit(float((1 << bits) - 1)))).cast("bigint")


def _sizes(bits: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("_size")


def _point_blocks(points: DataFrame, value: Column, cell: float, bits: int) -> DataFrame:
    """``points`` with the block of each size that holds the value."""
    cells = points.select("*", _cell_of(value, cell, bits).alias("_cell")).select("*", _sizes(bits))
    return cells.select(*points.columns, "_size", F.expr("shiftright(_cell, _size)").alias("_block"))


def _range_blocks(ranges: DataFrame, low: Column, high: Column, cell: float, bits: int) -> DataFrame:
    """``ranges`` with the blocks that the cells from ``low`` to ``high`` split into."""
    return (
        ranges.select("*", _cell_of(low, cell, bits).alias("_first"), _cell_of(high, cell, bits).alias("_last"))
        .select("*", _sizes(bits))
        # The blocks of this size that lie inside the range are numbered _start to _stop - 1.
        .select(
            "*",
            F.expr("shiftright(_first + shiftleft(1L, _size) - 1, _size)").alias("_start"),
            F.expr("shiftright(_last + 1, _size)").alias("_stop"),
        )
        .where("_start < _stop")
        # Of these the split takes a left edge and a right edge that no larger block covers.
        .select(
            *ranges.columns,
            "_size",
            F.explode(
                F.array(
                    F.when(F.col("_start") % 2 == 1, F.col("_start")),
                    F.when(F.col("_stop") % 2 == 1, F.col("_stop") - 1),
                )
            ).alias("_block"),
        )
        .where(F.col("_block").isNotNull())
    )
