"""From raw documents to token ids: the stages of a training corpus, each on all that the one before kept."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import public_tokenizers
from rulecast.llm.common import table
from rulecast.llm.decontamination import document_key, find_contamination
from rulecast.llm.near_duplicates import near_duplicate_classes
from rulecast.llm.op2_query import contaminated
from rulecast.llm.op7_query import MODEL, encoded_digests
from rulecast.llm.passage_repeats import remove_earlier_passages
from rulecast.llm.toxicity import fit_toxicity, keep_ordinary
from rulecast.operators.lineage import materialize


def _records(docs: DataFrame) -> DataFrame:
    """Documents with all their columns in one, so that no name of theirs meets one of a stage's own."""
    record = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_record")
    return docs.select(record, F.col("doc_id").alias("_id"), F.col("text").alias("_text"))


def _documents(records: DataFrame, docs: DataFrame) -> DataFrame:
    return records.select(*(F.col(f"_record.`{c}`").alias(c) for c in docs.columns))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression model does not find toxic.

    Every row is judged by its own text, repeated rows and rows without id too; null and empty texts
    are not toxic. All columns stay; no documents give no rows.
    """
    model = fit_toxicity(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    packed = _records(docs).select("_record", F.col("_text").alias("text"))
    return _documents(keep_ordinary(packed, model), docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each class of near duplicates.

    Rows are judged by their own texts where they share an id; of rows with the same id and text,
    one stays, the first by its other columns. Rows without id or without words are near duplicates
    of nothing and all stay. All columns stay; no documents give no rows.
    """
    classes = near_duplicate_classes(docs, shingle=5, percent=80, rows=True).filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    marks = classes.groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).agg(F.min("kept").alias("_kept"), F.count("*").alias("_times"))
    marks = marks.filter(~F.col("_kept") | (F.col("_times") > 1))
    marked = _records(docs).withColumn("_row", F.xxhash64(F.coalesce("_text", F.lit("")))).join(marks, ["_id", "_row"], "left")
    others = [F.col(f"_record.`{c}`") for c in docs.columns if c not in ("doc_id", "text")] or [F.col("_row")]
    place = F.row_number().over(Window.partitionBy("_id", "_row").orderBy(*others))
    once = marked.filter(F.coalesce("_kept", F.lit(True))).withColumn("_place", place)
    return _documents(once.filter(F.col("_times").isNull() | (F.col("_place") == 1)), docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that a document with a smaller id has.

    A null text becomes empty; ``n_chars``, where there is such a column, is counted again. Rows that
    share an id are one document to each other; other columns stay. No documents give no rows.
    """
    others = {c: f"_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "n_chars")}
    own = docs.select("doc_id", "text", *(F.col(f"`{c}`").alias(to) for c, to in others.items()))
    found = remove_earlier_passages(own, carry=tuple(others.values()))
    new = {c: F.col(to) for c, to in others.items()} | {"doc_id": F.col("doc_id"), "text": F.col("kept")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return found.select(*(new[c].alias(c) for c in docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark items do not contaminate.

    Every row is judged by its own text, rows that share an id or have none too; null and empty texts
    are clean. All columns stay; no documents give no rows.
    """
    found = find_contamination(docs, table(spark, sf_dir, "benchmark")).filter(contaminated())
    keyed = _records(docs).withColumn("_key", document_key("_id", "_text"))
    return _documents(keyed.join(found.select(F.col("key").alias("_key")).distinct(), "_key", "left_anti"), docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's ids and of the text that they decode to.

    One row for every row; null and empty texts have no ids. Other columns are ignored.
    """
    return encoded_digests(docs, public_tokenizers.path(MODEL))


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("substring_dedup", without_repeated_passages),
    ("decontamination", without_benchmark),
    ("sentencepiece", encoded),
]

#: A trained model decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
