"""Draw documents by importance weights towards a target collection.

Word n-grams fall into hashed buckets. How much more often a bucket occurs in the target than in the
corpus is its gain; a document's weight is the mean gain of its n-grams. Weights plus independent
Gumbel noise, largest first, draw without replacement in proportion to the exponential weights.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulecast.llm.common import ship, texts
from rulecast.llm.ngram_table import NgramTable
from rulecast.llm.word_runs import Joined, slices
from rulecast.llm.words import PLAIN
from rulecast.operators.lineage import materialize


@dataclass(frozen=True)
class Features:
    """Runs of 1 to ``longest`` words, folded into ``buckets`` by crc32."""

    longest: int = 2
    buckets: int = 10_000

    def table(self, words: Joined) -> tuple[NgramTable, np.ndarray]:
        """The table of all features that begin in a slice, and the text of each occurrence."""
        total, text = len(words.begin), np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
        own = total if words.ends else max(total - self.longest + 1, 0)
        begin, end, where = [], [], []
        for n in range(1, self.longest + 1):
            at = np.arange(max(min(own, total - n + 1), 0))
            at = at[text[at] == text[at + n - 1]]
            begin.append(words.begin[at])
            end.append(words.end[at + n - 1])
            where.append(text[at])
        return NgramTable(words.data, np.concatenate(begin), np.concatenate(end), self.buckets), np.concatenate(where)


def bucket_counts(docs: DataFrame, features: Features, text: str = "text") -> DataFrame:
    """``bucket, n``: how many features of all texts fall into each bucket that any falls into.

    Slices intern their features; a task adds them up and sends one row per bucket.
    """
    ship(docs.sparkSession)

    def count(batches):
        found = np.zeros(features.buckets, np.int64)
        for batch in batches:
            for _, words in slices(batch.column(0), PLAIN, features.longest - 1):
                table, _ = features.table(words)
                taken = np.flatnonzero(table.count)
                np.add.at(found, table.bucket[taken], table.count[taken])
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(found[some])], names=["bucket", "n"])

    counted = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(count, "bucket int, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, features: Features) -> DataFrame:
    """``bucket, gain`` of every bucket from the ``bucket_counts`` of both collections.

    The gain is 1000 times the logarithm of the ratio of the bucket's shares, one added to each
    count, rounded down.
    """
    spark, n = corpus.sparkSession, features.buckets
    all_ = spark.range(n).select(F.col("id").cast("int").alias("bucket"))
    counts = all_.join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0, ["s", "t"])
    both = Window.partitionBy()  # one row per bucket, a number fixed by the parameter
    s, t = (F.col(c).cast("double") for c in "st")
    totals = counts.withColumns({"all_s": F.sum("s").over(both).cast("double"), "all_t": F.sum("t").over(both).cast("double")})
    ratio = (t + 1) * (F.col("all_s") + n) / ((s + 1) * (F.col("all_t") + n))
    return totals.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def document_weights(docs: DataFrame, gains: np.ndarray, features: Features, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight``: the mean gain of a document's features, rounded down.

    A document without features weighs 0.
    """
    ship(docs.sparkSession)

    def weigh(batches):
        for batch in batches:
            n_words, n_features, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for k, words in slices(batch.column(1), PLAIN, features.longest - 1):
                table, where = features.table(words)
                here = slice(k, k + len(words.first) - 1)
                own = np.diff(words.first) - (0 if words.ends else features.longest - 1)
                n_words[here] += own
                n_features[here] += np.bincount(where, minlength=len(own))
                by_slot = gains[table.bucket]
                np.add.at(total[here], where, by_slot[table.slot])
            weight = total // np.maximum(n_features, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (n_words, n_features, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    return texts(docs, doc_id, text).mapInArrow(weigh, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def gumbel(seed: int, doc_id: Column) -> Column:
    """1000 times Gumbel noise, rounded down, drawn by the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"), 256)
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / F.lit(4294967296.0))))


def resample_towards(docs: DataFrame, target: DataFrame, percent: int = 25, seed: int = 7, least_words: int = 20, features: Features = Features()) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank``; the drawn documents have a rank.

    Of the documents with at least ``least_words`` words, ``percent`` in a hundred (rounded down)
    with the highest scores are drawn, ranked from 1; of equal scores the smaller id goes first. A
    null text has no words. A row without id has no score, counts as feature source but not among
    the documents to draw from. Rows that repeat an id are drawn each by itself. Other columns are
    ignored. No documents give no rows; an empty target gives every bucket the gain of a count of 0.
    Texts count whole, in slices; corpus counts are of all documents.

    What goes through the driver is one number per bucket. Scores are whole numbers within some
    60,000 of each other, since shares and noise are bounded, so how many documents have each score
    is a small table; ranks continue from the count of all higher scores, and only drawn documents
    are shuffled, by score.
    """
    gains = np.zeros(features.buckets, np.int64)
    for row in bucket_gains(bucket_counts(docs, features), bucket_counts(target, features), features).collect():
        gains[row.bucket] = row.gain
    weighed = document_weights(docs, gains, features)
    scored = materialize(weighed.withColumn("score", F.col("weight") + gumbel(seed, F.col("doc_id"))))
    mine = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    counted = scored.where(mine).groupBy("score").agg(F.count("*").alias("n"))
    higher = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    steps = counted.withColumns({"before": F.coalesce(F.sum("n").over(higher), F.lit(0)), "all": F.sum("n").over(Window.partitionBy())})
    steps = materialize(steps.select("score", "before", F.expr(f"(all * {percent}) div 100").alias("drawn")).where("before < drawn"))
    place = F.row_number().over(Window.partitionBy("score").orderBy("doc_id", "n_features", "weight"))
    candidates = scored.where(mine).join(steps, "score").withColumn("rank", F.col("before") + place)
    rank = F.when(F.col("rank") <= F.col("drawn"), F.col("rank")).alias("rank")
    columns = [F.col(c) for c in ("doc_id", "n_words", "n_features", "weight", "score")]
    rest = scored.where(~mine).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    low = scored.where(mine).join(steps, "score", "left_anti").select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return candidates.select(*columns, rank).unionByName(low).unionByName(rest)
