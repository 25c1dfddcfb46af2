"""Which texts contain which patterns, by an inverted index of the patterns' literal pieces.

A pattern is a list of alternatives, hundreds of them; testing every text against every pattern costs
their product. Here each alternative is known by one short piece of literal text that it cannot match
without, and texts meet alternatives by equality of pieces. Only these pairs are verified.
"""

from pyspark.sql import Column, DataFrame, functions as F

from rulecast.operators.lineage import materialize
from rulecast.operators.skew import salted_join

#: Length of a piece; alternatives with less literal text have shorter ones.
GRAM = 4
#: Up to this size in memory the index goes to every executor, beyond it the join shuffles.
BROADCAST_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LIST = r"(?s)^\(\?i\)\((.*)\)$"
# An alternative that means the same outside its list: groups one level deep, no flag, class or escape.
CLOSED = r"^[^()\[\]\\]*(\((?!\?)[^()\[\]\\]*\)[^()\[\]\\]*)*$"
# Plain characters, any-character dots, groups without alternatives, and repetitions of once or more.
LITERAL = r"^[0-9A-Za-z _,/-]+$"
PIECES = r"^([0-9A-Za-z _,/.-]\+?|\([0-9A-Za-z _,/.-]+\))+$"
BETWEEN = r"[.()+]"


def folded(text: Column) -> Column:
    """A-Z as a-z, the letters that patterns with ``(?i)`` take for each other."""
    return F.translate(text, UPPER, LOWER)


def alternatives(patterns: DataFrame, key: str, pattern: str, literal: bool = False) -> DataFrame:
    """``key, said, regex, piece``: one row per alternative of each pattern.

    Patterns are ``(?i)(a|b|…)``, or with ``literal`` tokens separated by ``|``. ``said`` is folded
    text to look for, or NULL where ``regex`` decides. ``piece`` is literal text that every match
    contains, the longest one. A pattern of another form, and one whose ``|`` are not all between
    alternatives, is a single alternative without such a text; its piece is empty. NULL patterns
    match nothing and have no row.
    """
    given = patterns.where(F.col(pattern).isNotNull()).select(F.col(key).alias("key"), F.col(pattern).alias("_pattern"))
    if literal:
        split = given.select("key", F.explode(F.split(F.col("_pattern"), r"\|")).alias("_one"))
        said = folded(F.col("_one"))
        return split.select("key", said.alias("said"), F.lit(None).cast("string").alias("regex"), said.alias("piece")).distinct()
    listed = F.col("_pattern").rlike(LIST)
    inner = F.split(F.regexp_extract("_pattern", LIST, 1), r"\|")
    closed = listed & F.forall(inner, lambda a: a.rlike(CLOSED))
    split = given.select("key", F.explode(F.when(closed, F.transform(inner, lambda a: F.struct(a.alias("one"), F.concat(F.lit("(?i)"), a).alias("regex")))).otherwise(F.array(F.struct(F.lit(None).cast("string").alias("one"), F.col("_pattern").alias("regex"))))).alias("_a"))
    one = F.col("_a.one")
    plain = F.coalesce(one.rlike(LITERAL), F.lit(False))
    mandatory = F.when(plain, F.array(one)).when(one.rlike(PIECES), F.split(one, BETWEEN)).otherwise(F.array(F.lit("")))
    longest = F.array_max(F.transform(mandatory, lambda p: F.struct(F.length(p).alias("n"), folded(p).alias("text"))))["text"]
    return split.select(
        "key",
        F.when(plain, folded(one)).alias("said"),
        F.when(~plain, F.col("_a.regex")).alias("regex"),
        longest.alias("piece"),
    ).distinct()


def grams(text: Column, size: int) -> Column:
    """The distinct pieces of a text that have ``size`` characters; of a NULL text none."""
    if size == 0:
        return F.when(text.isNotNull(), F.array(F.lit("")))
    starts = F.sequence(F.lit(1), F.length(text) - (size - 1))
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(size)))))


def _exploded(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """``text, _folded, gram``: every piece of every text."""
    cut = texts.select("text", folded(F.col("text")).alias("_folded"))
    every = F.flatten(F.array_compact(F.array(*(grams(F.col("_folded"), n) for n in sizes))))
    return cut.select("text", "_folded", F.explode(every).alias("gram"))


def rarest_pieces(dictionary: DataFrame, texts: DataFrame, sizes: list[int]) -> DataFrame:
    """``gram, _list``: alternatives under the piece that fewest texts contain.

    Alternatives with a piece that no text contains match nothing and are left out. A text without a
    piece of the dictionary leaves no row before the count, whose groups are the dictionary's pieces.
    """
    size = F.least(F.length("piece"), F.lit(GRAM))
    own = F.when(size == 0, F.array(F.lit("")))
    for n in range(1, GRAM + 1):
        own = own.when(size == n, grams(F.col("piece"), n))
    parts = materialize(dictionary.withColumn("gram", F.explode(own)))
    wanted = parts.select("gram").distinct()
    counted = _exploded(texts, sizes).join(wanted, "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("_n"))
    rare = parts.join(counted, "gram", "left").groupBy("key", "said", "regex").agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("gram"))).alias("_rare")
    )
    held = F.struct("key", "said", "regex")
    return rare.where("_rare.n > 0").groupBy(F.col("_rare.gram").alias("gram")).agg(F.collect_list(held).alias("_list"))


def _met(pieces: DataFrame, index: DataFrame) -> DataFrame:
    """Texts' pieces with the alternatives listed under them.

    Spark takes a table for as large as the one that it is exploded from, and would send all pieces
    of the texts to every executor; so the index's own size decides.
    """
    one = F.aggregate("_list", F.lit(0).cast("bigint"), lambda n, a: n + 150 + 2 * F.coalesce(F.length(a["said"]), F.length(a["regex"])))
    size = index.agg(F.sum(F.lit(100) + one)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return pieces.join(F.broadcast(index), "gram")
    return salted_join(pieces, index.hint("merge"), ["gram"], F.col("text"))


def containing(texts: DataFrame, text: str, patterns: DataFrame, key: str, pattern: str, literal: bool = False) -> DataFrame:
    """Distinct ``text`` and ``key`` of the patterns that each distinct text contains.

    The result is that of ``rlike(text, pattern)`` for every pair. Work grows with the length of the
    texts and with the pairs that share a rare piece, not with texts times patterns. NULL texts match
    nothing.
    """
    dictionary = materialize(alternatives(patterns, key, pattern, literal))
    distinct = materialize(texts.where(F.col(text).isNotNull()).select(F.col(text).alias("text")).distinct())
    length = F.least(F.length("piece"), F.lit(GRAM))
    sizes = sorted(r[0] for r in dictionary.select(length).distinct().collect())  # at most GRAM + 1 numbers
    if not sizes:
        return distinct.select(F.col("text").alias(text), F.lit(None).cast(patterns.schema[key].dataType).alias(key)).limit(0)
    index = materialize(rarest_pieces(dictionary, distinct, sizes))
    met = _met(_exploded(distinct, sizes), index)
    pairs = met.select("text", "_folded", F.explode("_list").alias("_a"))
    found = F.when(F.col("_a.said").isNotNull(), F.contains("_folded", F.col("_a.said"))).otherwise(F.rlike("text", F.col("_a.regex")))
    return pairs.where(found).select(F.col("text").alias(text), F.col("_a.key").alias(key)).distinct()
