"""Rules from device clusters."""

from pyspark.sql import DataFrame, functions as F

from rulecast.functions.numbers import whole_or_text
from rulecast.functions.text import rule_text
from rulecast.operators.aggregates import ordered_concat

# The vendor and the local brands that split clusters 1 and 2.
SPLIT_VENDOR = "samsung"
LOCAL_BRANDS = ("ais", "true", "i-mobile", "zte", "lava")


def shape_device_clusters(raw: DataFrame) -> DataFrame:
    """Cluster rows without the reach column; the cluster number under its short name."""
    return raw.drop("reach").withColumnRenamed("clusterscrcam_km7", "cluster")


def cluster_brand(clusters: DataFrame) -> DataFrame:
    """Adds the cluster label; clusters 1 and 2 are split by vendor."""
    vendor, cluster = F.col("vendor"), F.col("cluster")
    first = F.when(vendor == SPLIT_VENDOR, "1_SS").when(vendor != SPLIT_VENDOR, "1_OTH")
    second = (
        F.when(vendor == SPLIT_VENDOR, "2_SS")
        .when(vendor.isin(*LOCAL_BRANDS), "2_OEM")
        .otherwise("2_OTH")
    )
    split = F.when(cluster == 1, first).when(cluster == 2, second)
    return clusters.withColumn("cluster_brand", F.coalesce(split, whole_or_text(cluster)))


def cluster_rules(labelled: DataFrame) -> DataFrame:
    """One case-insensitive rule per cluster label."""
    models = F.trim(F.lower("model"))
    joined = ordered_concat(labelled, ["cluster_brand"], models, "|", "alternatives")
    return joined.select("cluster_brand", rule_text(F.col("alternatives")).alias("rule"))


def cluster_model_list(labelled: DataFrame) -> DataFrame:
    """Comma-separated models per cluster label, case kept."""
    return ordered_concat(labelled, ["cluster_brand"], F.col("model"), ",", "rule")
