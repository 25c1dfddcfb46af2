"""The query of periodic runs, on documents of which one in ten has a periodic end written into it, and its SQL."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulecast.llm.common import table
from rulecast.llm.crc_sql import CRC_TABLE, crc32_sql
from rulecast.llm.periodic_runs import collapse_runs


def with_periodic_ends(docs: DataFrame) -> DataFrame:
    """One document in ten repeats words a..a+p-1 from word a on; which, and a and p, tells its id's crc32."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size("words").cast("bigint")
    p = 1 + F.expr("(n - a) div (3 + g % 8)")

    def word(i: Column) -> Column:
        return F.element_at("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int") + 1)

    chosen = docs.select("doc_id", "text", (h % 10 == 0).alias("chosen"), g.alias("g"))
    cut = chosen.withColumn("words", F.when(F.col("chosen"), words)).withColumn("n", F.when(F.col("chosen") & (n > 0), n))
    placed = cut.withColumn("a", F.col("g") % F.col("n")).withColumn("p", p)
    periodic = F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), word), " ")
    return placed.select("doc_id", F.when(F.col("n").isNotNull(), periodic).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(with_periodic_ends(table(spark, sf_dir, "documents")), min_length=6, exponent=4)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("small"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    spelled = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    period = -F.col("best.small")
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.back")).alias("start"),
        F.col("best.length").alias("length"),
        period.alias("period"),
        F.floor(1000 * F.col("best.length") / period).alias("exponent_milli"),
        F.sha2(spelled.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )


OP11_SQL = rf"""
WITH {CRC_TABLE}, d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS said, {crc32_sql("CAST(doc_id AS VARCHAR)")} AS h FROM documents, crc_table
), ends AS (
    SELECT *, (h // 10) % len(said) AS a, 1 + (len(said) - (h // 10) % len(said)) // (3 + (h // 10) % 8) AS p FROM d
), t AS (
    SELECT doc_id, CASE WHEN h % 10 = 0 AND len(said) > 0
        THEN list_transform(range(len(said)), lambda i: said[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE said END AS w
    FROM ends
), grams AS (
    SELECT doc_id, n, i, array_to_string(w[i + 1:i + 5], ' ') AS g
    FROM (SELECT doc_id, w, len(w) AS n, unnest(range(len(w) - 4)) AS i FROM t WHERE len(w) >= 6) AS x
), same AS (
    SELECT a.doc_id, a.i, b.i - a.i AS q
    FROM grams AS a JOIN grams AS b ON a.doc_id = b.doc_id AND a.g = b.g AND b.i > a.i AND 4 * (b.i - a.i) <= a.n
), stretches AS (
    SELECT doc_id, q, min(i) AS s, count(*) + 4 + q AS l
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same) AS x GROUP BY doc_id, q, island
), runs AS (
    SELECT doc_id, s, l, min(q) AS q FROM stretches WHERE l >= greatest(6, 4 * q) GROUP BY doc_id, s, l
), listed AS (
    SELECT doc_id, count(*) AS n_runs, arg_min({{'s': s, 'l': l, 'q': q}}, (-l, s, q)) AS best,
        string_agg(concat(s, ',', l, ',', q, chr(10)), '' ORDER BY s, q) AS spelled
    FROM runs GROUP BY doc_id
), dropped AS (
    SELECT doc_id, list(i) AS gone FROM (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) + 1 AS i FROM runs) AS x GROUP BY doc_id
)
SELECT
    t.doc_id,
    coalesce(n_runs, 0) AS n_runs,
    best.s AS start,
    best.l AS length,
    best.q AS period,
    CAST(1000 * best.l // best.q AS BIGINT) AS exponent_milli,
    sha256(coalesce(spelled, '')) AS runs_sha256,
    sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ')
        ELSE array_to_string(list_filter(w, lambda x, i: NOT list_contains(gone, i)), ' ') END) AS collapsed_sha256
FROM t LEFT JOIN listed USING (doc_id) LEFT JOIN dropped USING (doc_id)
"""
