"""The query of phrase fingerprints."""

from pyspark.sql import DataFrame, SparkSession

from rulecast.llm.common import table
from rulecast.llm.phrase_fingerprints import fingerprint_edits


def op8_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))
