"""Ordered text aggregation and best-rank selection."""

from pyspark.sql import Column, DataFrame, functions as F

LEAD = 4


def ordered_concat(
    rows: DataFrame, keys: list[str], value: Column, separator: str, out: str, lead: int = LEAD
) -> DataFrame:
    """Concatenate the values of each group in ascending order; NULLs are left out.

    The work of a large group is split: values that share their first ``lead`` characters are
    sorted and joined first, then these stretches are joined in order. Both steps together give
    the order of one sort over the whole group.
    """
    sorted_list = f"listagg({{0}}, '{separator}') within group (order by {{1}})"
    stretches = (
        rows.select(*keys, value.alias("_value"))
        .groupBy(*keys, F.left("_value", F.lit(lead)).alias("_lead"))
        .agg(F.expr(sorted_list.format("_value", "_value")).alias("_stretch"))
    )
    return stretches.groupBy(*keys).agg(
        F.expr(sorted_list.format("_stretch", "_lead")).alias(out)
    )


def best_rank(rows: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """The lowest rank of each key."""
    return rows.groupBy(*keys).agg(F.min(rank).alias(rank))
