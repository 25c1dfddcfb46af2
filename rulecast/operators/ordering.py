"""A total order over a table of any size, in which no task sees more than its range."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from rulecast.operators.lineage import materialize

PLACE_BITS = 33  # of a row's place within its partition in monotonically_increasing_id


def _earlier():
    """All ranges before; there is one row per range."""
    return Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)


def _within(up_to: int):
    return Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, up_to)


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with their range and their place in it; ranges follow each other in the order."""
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(sorted_.withColumn("_at", F.monotonically_increasing_id()))
    return placed.withColumn("_range", F.shiftright("_at", PLACE_BITS))


def count_before(rows: DataFrame, order: list[str], counted: Column, out: str) -> DataFrame:
    """``rows`` with the number of ``counted`` rows before each one in the order of the columns.

    Rows are dealt out by ranges of the order, sorted within them and counted there; the counts of
    whole ranges, one number each, are added up apart. Rows equal in all columns of the order come in
    any order among themselves.
    """
    placed = _placed(rows.withColumn("_one", counted.cast("bigint")), order)
    ranges = placed.groupBy("_range").agg(F.sum("_one").alias("_n"))
    starts = ranges.select("_range", F.coalesce(F.sum("_n").over(_earlier()), F.lit(0)).alias("_start"))
    before = F.coalesce(F.sum("_one").over(_within(-1)), F.lit(0))
    return placed.join(starts, "_range").withColumn(out, F.col("_start") + before).drop("_one", "_at", "_range", "_start")


def last_value(rows: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """``rows`` with the last ``value`` that is not NULL up to each one in the order of the columns.

    What a range ends with is carried into the next ones, one value per range.
    """
    placed = _placed(rows, order)
    ranges = placed.groupBy("_range").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col("_at"))).alias("_end"))
    carried = ranges.select("_range", F.last("_end", ignorenulls=True).over(_earlier()).alias("_carried"))
    here = F.last(value, ignorenulls=True).over(_within(0))
    return placed.join(carried, "_range").withColumn(out, F.coalesce(here, "_carried")).drop("_at", "_range", "_carried")


def blocks_of(first: Column, stop: Column, size: Column) -> Column:
    """The aligned blocks of ``2**size`` numbers that ``first`` to ``stop - 1`` splits into, two at most.

    A range splits into such blocks of all sizes; each number of it lies in exactly one of them.
    """
    low = F.call_function("shiftright", first + F.call_function("shiftleft", F.lit(1).cast("bigint"), size) - 1, size)
    high = F.call_function("shiftright", stop, size)
    left = F.when((low < high) & (low % 2 == 1), low)
    right = F.when((low < high) & (high % 2 == 1), high - 1)
    return F.array_compact(F.array(left, right))
