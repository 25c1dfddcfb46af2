"""Joins that merge or replace rows of keyed tables."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from rulecast.operators.skew import salted_join


def outer_merge(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Sum the measures of each side per key, then full-outer-join the sides on the keys.

    The measures of the two sides carry different names. Sums per side and join are one
    aggregation over the union, so each row is shuffled once and pre-aggregated before that. As in
    a join, a row with a NULL key pairs with nothing.
    """
    measures = [c for c in (*left.columns, *right.columns) if c not in keys]
    if len(set(measures)) != len(measures):
        raise ValueError("measures of the two sides must have different names")
    unpaired = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])

    def tagged(side: DataFrame, number: int) -> DataFrame:
        return side.withColumn("_side", F.when(unpaired, F.lit(number)).otherwise(F.lit(0)))

    both = tagged(left, 1).unionByName(tagged(right, 2), allowMissingColumns=True)
    sums = [F.sum(m).alias(m) for m in measures]
    return both.groupBy(*keys, "_side").agg(*sums).select(*keys, *measures)


def override(base: DataFrame, replacement: DataFrame, key: str) -> DataFrame:
    """``base`` with the rows of every key that ``replacement`` has taken from there instead."""
    replaced = replacement.select(key).distinct()
    known = base.select(key).distinct()
    by = F.struct(*base.columns)
    kept = salted_join(base, replaced, [key], by, "left_anti")
    taken = salted_join(replacement, known, [key], by, "left_semi")
    return kept.unionByName(taken.select(*base.columns))


def exclude(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Rows whose key is absent from ``others``; a NULL key is kept, and spared the shuffle."""
    known = rows.where(F.col(key).isNotNull())
    return known.join(others.select(key), key, "left_anti").unionByName(rows.where(F.col(key).isNull()))
