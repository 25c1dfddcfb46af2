"""Audience lists and distinct reach."""

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rulecast.functions.patterns import factored, quoted
from rulecast.operators.dictionary import containing
from rulecast.operators.lineage import materialize
from rulecast.operators.merging import exclude
from rulecast.operators.skew import salted_join, spread_evenly
from rulecast.sources.readers import on_days

# Id types that name a phone.
HARDWARE_IDS = ("HARDWARE_ANDROID_AD_ID", "HARDWARE_IDFA")

Window = tuple[dt.date | str, dt.date | str]


def _within(window: Window | None) -> Column:
    return F.lit(True) if window is None else on_days(*window)


def audience_competitors(
    dataset: DataFrame, carriers: Sequence[str], id_column: str = "device_id"
) -> DataFrame:
    """Distinct ids seen on the given carriers at any time, with model, id type and source."""
    seen = dataset.where(F.col("carrier").isin(*carriers))
    return seen.select(id_column, "model", "id_type", "event_source").distinct()


def audience_recent_own(
    dataset: DataFrame,
    carriers: Sequence[str],
    window: Window,
    id_types: Sequence[str] = HARDWARE_IDS,
    id_column: str = "device_id",
) -> DataFrame:
    """Distinct ids seen on the own carrier within the window."""
    recent = F.col("carrier").isin(*carriers) & _within(window) & F.col("id_type").isin(*id_types)
    return dataset.where(recent).select(id_column).distinct()


def audience_not_recent(
    competitors: DataFrame, recent: DataFrame, id_column: str = "device_id"
) -> DataFrame:
    """The competitors' ids that were not seen recently on the own carrier."""
    return exclude(competitors, recent, id_column)


def matched_clusters(agents: DataFrame, patterns: Mapping[str, str], literal: bool) -> DataFrame:
    """One row per user agent and cluster whose pattern it contains.

    Patterns with hundreds of alternatives are the costly step, so user agents, however few bytes
    they are, go to all partitions.
    """
    matches = [
        F.when(F.rlike("user_agent", F.lit(quoted(p) if literal else factored(p))), F.lit(cluster))
        for cluster, p in patterns.items()
    ]
    hits = F.filter(F.array(*matches), lambda c: c.isNotNull())
    distinct = spread_evenly(agents.select("user_agent").distinct())
    return distinct.select("user_agent", F.explode(hits).alias("cluster"))


def cluster_reach(
    dataset: DataFrame,
    patterns: Mapping[str, str] | DataFrame,
    own_carriers: Sequence[str],
    other_carriers: Sequence[str],
    own_window: Window | None,
    other_window: Window | None = None,
    id_types: Sequence[str] = HARDWARE_IDS,
    id_column: str = "device_id",
    literal: bool = False,
    materialized: bool = True,
) -> DataFrame:
    """Distinct ids per cluster on other carriers and not, by the same cluster, on the own one.

    ``patterns`` gives each cluster its regular expression, or with ``literal=True`` its tokens
    separated by ``|``: as a mapping, whose patterns are tried on each distinct user agent, or as a
    table of ``cluster, pattern``, which meets user agents by a dictionary of its alternatives and
    may have any number of clusters. All clusters are counted in one pass: patterns see each distinct user agent
    once, and a single aggregation per cluster and id tells both sides apart. Clusters that reach
    nobody have no row. ``materialized`` keeps the distinct (id, user agent) pairs as a table, so
    that the dataset is read once.
    """
    carrier = F.col("carrier")
    own = carrier.isin(*own_carriers) & _within(own_window)
    other = carrier.isin(*other_carriers) & _within(other_window)
    sightings = (
        dataset.where(F.col("id_type").isin(*id_types) & F.col(id_column).isNotNull())
        .where(own | other)
        .groupBy(id_column, "user_agent")
        .agg(F.max(own).alias("own"), F.max(other).alias("other"))
    )
    if materialized:
        sightings = materialize(sightings)
    if isinstance(patterns, DataFrame):
        clusters = containing(sightings, "user_agent", patterns, "cluster", "pattern", literal)
    else:
        clusters = matched_clusters(sightings, patterns, literal)
    by_cluster = salted_join(sightings, clusters, ["user_agent"], F.col(id_column))
    return (
        by_cluster.groupBy("cluster", id_column)
        .agg(F.max("own").alias("own"), F.max("other").alias("other"))
        .where("other and not coalesce(own, false)")
        .groupBy("cluster")
        .agg(F.count("*").alias("reach"))
    )


def model_reach(
    dataset: DataFrame,
    id_type: str,
    vendor: str,
    event_source: str,
    year: int,
    id_column: str = "device_id",
) -> DataFrame:
    """Distinct ids per model and user agent, most first."""
    kept = dataset.where(
        (F.col("id_type") == id_type)
        & (F.col("vendor") == vendor)
        & (F.col("event_source") == event_source)
        & (F.col("year") == year)
    )
    reach = kept.groupBy("model", "user_agent").agg(F.countDistinct(id_column).alias("reach"))
    return reach.orderBy(F.desc("reach"))
