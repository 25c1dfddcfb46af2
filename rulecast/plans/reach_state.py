"""Reach of any window of days from a stored state, without reading the sightings again."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rulecast.operators.dictionary import containing
from rulecast.operators.distinct_state import distinct_ids, distinct_ids_without, id_blocks
from rulecast.operators.lineage import materialize
from rulecast.operators.skew import salted_join
from rulecast.plans.audience import HARDWARE_IDS, Window
from rulecast.sources.readers import on_days
from rulecast.sources.schemas import PARTITION

MODEL_KEYS = ["id_type", "vendor", "event_source", "model", "user_agent"]


def model_days(sightings: DataFrame, numbers: DataFrame, id_column: str = "device_id") -> DataFrame:
    """The ids per day of everything that ``model_reach`` can ask for."""
    return id_blocks(sightings, [*PARTITION, *MODEL_KEYS], id_column, numbers)


def cluster_days(sightings: DataFrame, numbers: DataFrame, patterns: DataFrame, id_types: Sequence[str] = HARDWARE_IDS, id_column: str = "device_id") -> DataFrame:
    """The ids per day, carrier and cluster (of ``cluster, pattern``) that was seen in a user agent."""
    kept = sightings.where(F.col("id_type").isin(*id_types) & F.col(id_column).isNotNull() & F.col("carrier").isNotNull())
    seen = materialize(kept.select(*PARTITION, "carrier", "user_agent", id_column).distinct())
    clusters = containing(seen, "user_agent", patterns, "cluster", "pattern")
    by_cluster = salted_join(seen, clusters, ["user_agent"], F.col(id_column))
    return id_blocks(by_cluster, [*PARTITION, "carrier", "cluster"], id_column, numbers)


def model_reach_of(state: DataFrame, window: Window, id_type: str, vendor: str, event_source: str) -> DataFrame:
    """Distinct ids per model and user agent in a window of days, most first."""
    asked = (F.col("id_type") == id_type) & (F.col("vendor") == vendor) & (F.col("event_source") == event_source)
    return distinct_ids(state.where(on_days(*window) & asked), ["model", "user_agent"]).orderBy(F.desc("reach"))


def cluster_reach_of(state: DataFrame, own_carriers: Sequence[str], other_carriers: Sequence[str], own_window: Window | None, other_window: Window | None = None) -> DataFrame:
    """Distinct ids per cluster on other carriers and not, by the same cluster, on the own one."""

    def sightings(carriers: Sequence[str], window: Window | None) -> Column:
        on = F.col("carrier").isin(*carriers)
        return on if window is None else on & on_days(*window)

    return distinct_ids_without(state, ["cluster"], sightings(other_carriers, other_window), sightings(own_carriers, own_window))
