"""The query of toxicity scores."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulecast.llm.common import table
from rulecast.llm.toxicity import fit_toxicity, held_out, score_toxicity


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")
