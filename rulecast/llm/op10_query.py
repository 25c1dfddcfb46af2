"""The query of repeated substrings."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulecast.llm.common import table
from rulecast.llm.substring_repeats import remove_repeated_substrings


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_substrings(table(spark, sf_dir, "documents"), length=400)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.lower(F.hex("digest")).alias("kept_sha256"))
