"""The query of main-text extraction."""

from pyspark.sql import DataFrame, SparkSession

from rulecast.llm.common import table
from rulecast.llm.html_extraction import extract_main_text


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))
