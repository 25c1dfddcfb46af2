"""Spreading rows: lookups that survive a hot key, and steps that multiply rows."""

from pyspark.sql import Column, DataFrame, functions as F

from rulecast.operators.lineage import materialize

SALTS = 16
#: Rows of one side in a tile: one meets as many of the other side there.
TILE = 512


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    spread_by: Column,
    how: str = "inner",
    salts: int = SALTS,
    partitions: int | None = None,
) -> DataFrame:
    """Join on ``on``, spreading every key of ``facts`` over ``salts`` partitions.

    Each fact row takes one salt from the hash of ``spread_by``; the lookup is repeated once per
    salt, so results are those of the plain join for every join type that keeps or drops whole
    fact rows (``inner``, ``left``, ``left_semi``, ``left_anti``). No side is forced to broadcast: when the lookup
    proves small at run time, adaptive execution does that by its measured size. A lookup that Spark
    takes for small enough beforehand needs no salt: it is sent to the facts, whose keys do not move.

    ``partitions`` is for a join whose result is much larger than both sides: Adaptive execution would
    size its tasks by their input.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type for salting: {how}")
    if _is_broadcast(lookup):
        spread = facts if partitions is None else facts.repartition(partitions, F.xxhash64(*facts.columns))
        return spread.join(lookup, on, how)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    if partitions is not None:
        salted, copies = (side.repartition(partitions, *on, "_salt") for side in (salted, copies))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def tiled_join(facts: DataFrame, lookup: DataFrame, on: list[str], tile: int = TILE) -> DataFrame:
    """Inner join on ``on`` whose result is much larger than both sides.

    The pairs of a key are a table of its fact rows by its lookup rows. It is cut into tiles of about
    ``tile`` by ``tile`` rows, each of them a key of the join, so that neither side of a hot key stays
    together, and tasks have about as many pairs each. What is shuffled besides the rows themselves
    is a row of each side per ``tile`` pairs. Rows are told apart by the hash of all their columns.
    """
    counts = facts.groupBy(*on).agg(F.count("*").alias("_facts"))
    counts = counts.join(lookup.groupBy(*on).agg(F.count("*").alias("_found")), on)
    rows, columns = (F.ceil(F.col(n) / tile).cast("int") for n in ("_facts", "_found"))
    # A row per key with its parts.
    parts = materialize(counts.select(*on, rows.alias("_rows"), columns.alias("_columns")))

    def one(side, count):
        return F.pmod(F.xxhash64(*side.columns), F.col(count)).cast("int")

    def each(count):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    down = facts.join(parts, on).withColumn("_row", one(facts, "_rows")).withColumn("_column", each("_columns"))
    across = lookup.join(parts, on).withColumn("_column", one(lookup, "_columns")).withColumn("_row", each("_rows"))
    keys = [*on, "_row", "_column"]
    down, across = (side.drop("_rows", "_columns").repartition(partitions_of(side), *keys) for side in (down, across))
    # Both sides are larger than the tables they come from, by which Spark would broadcast them.
    return across.hint("merge").join(down, keys).drop("_row", "_column")


def _is_broadcast(lookup: DataFrame) -> bool:
    """Whether Spark's own estimate of the table lies below its threshold for broadcasts."""
    execution = lookup._jdf.queryExecution()
    threshold = lookup.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(execution.optimizedPlan().stats().sizeInBytes())) <= threshold


def spread_evenly(df: DataFrame) -> DataFrame:
    """Partition by all columns, over as many partitions as the session shuffles into.

    For distinct rows that a next step multiplies. Adaptive execution sizes tasks by their input and
    would give a small table to one task; a stated number of partitions is left as it is.
    """
    return df.repartition(partitions_of(df), F.xxhash64(*df.columns))


def partitions_of(df: DataFrame) -> int:
    """As many partitions as the session shuffles into."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
