"""The query of benchmark decontamination, and the same rows in DuckDB SQL."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulecast.llm.common import table
from rulecast.llm.decontamination import find_contamination


def contaminated() -> Column:
    """One word in twenty is hit, and one at least."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2_SQL = f"""
WITH d AS (
    SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
), b AS (
    SELECT item_id, w, least(len(w), 13) AS n
    FROM (SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark) AS t WHERE len(w) > 0
), b_win AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM b) AS t
), sizes AS (SELECT DISTINCT n FROM b), starts AS (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n
), hits AS (
    SELECT s.doc_id, s.i, s.n, x.item_id
    FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM starts) AS s JOIN b_win AS x ON s.n = x.n AND s.g = x.g
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits) AS h) AS t GROUP BY doc_id
), named AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
    FROM hits GROUP BY doc_id
)
SELECT
    d.doc_id,
    CAST(len(d.w) AS BIGINT) AS n_words,
    CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
