"""The query of repeated passages, and the same rows in DuckDB SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulecast.llm.common import table
from rulecast.llm.passage_repeats import remove_earlier_passages


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_earlier_passages(table(spark, sf_dir, "documents"), width=13)
    return found.select("doc_id", "n_words", "n_removed", F.lower(F.hex("digest")).alias("kept_sha256"))


OP5_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), wins AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13) AS t
), early AS (
    SELECT g, min(doc_id) AS least FROM wins GROUP BY g HAVING min(doc_id) < max(doc_id)
), hit AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM wins JOIN early USING (g) WHERE least < doc_id
), gone AS (SELECT doc_id, list(p) AS ps FROM hit GROUP BY doc_id)
SELECT
    d.doc_id,
    CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
    sha256(CASE WHEN ps IS NULL THEN array_to_string(w, ' ')
                ELSE array_to_string(list_filter(w, lambda x, i: NOT list_contains(ps, i)), ' ') END) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""
