"""``name LIKE concat(pattern, '%')`` for two tables, without a nested loop."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from rulecast.operators.lineage import materialize
from rulecast.operators.ordering import last_value
from rulecast.operators.skew import salted_join, spread_evenly

WILDCARDS = r"[_%\\]"
# Literal text before the first wildcard; escaped characters are literal.
HEAD = r"^((?:[^_%\\]|\\.)*)"
# What stands before the first ``%``: there every character has its place.
FIXED = r"(?s)^((?:[^%\\]|\\.)*)"
GRAM = 3
LITERAL = "x"  # how a mask shows a literal place


def best_prefix_rank(
    names: DataFrame, patterns: DataFrame, name: str, pattern: str, rank: str
) -> DataFrame:
    """For each distinct name the lowest rank of the patterns it starts with, else NULL.

    Patterns follow LIKE: ``_`` is any character, ``%`` any text, ``\\`` escapes. LIKE is anchored at
    the start, so the literal text before a pattern's first wildcard, its head, must begin the name.
    Heads and names are put into one order. Every head that begins a name also begins whatever lies
    between the two, so the last head before a name begins with all heads of the name: each name
    needs that one only, and from it has the few heads that come into question. Many patterns can
    share a short head, so the characters after it are compared too, by equality: up to a pattern's
    first ``%`` the places of its ``_`` are its mask, and a name meets only the patterns that have its
    own characters at the other places of one of the masks of its heads. Only a pattern that begins
    with ``%`` has no such place; it meets names by a piece of up to three literal characters, in a step
    of its own that is left out where there are none. What follows a ``%`` is then checked by LIKE.
    """
    keys = materialize(names.select(F.col(name).alias("_name")).distinct())
    shaped = materialize(_shaped(patterns, pattern, rank))
    headed = materialize(_lowest(shaped.where(~F.col("_loose")), F.col("_head").alias("_anchor"), "_mask", "_text"))
    loose = materialize(_lowest(shaped.where("_loose"), F.left("_piece", F.lit(GRAM)).alias("_anchor")))
    matches = F.like(F.col("_name"), F.concat(F.col("_like"), F.lit("%")))

    def hits(anchored: DataFrame, lookup: DataFrame, on: list[str]) -> DataFrame:
        pairs = salted_join(anchored, lookup, on, F.col("_name"))
        return pairs.where(F.col("_like").isNull() | matches).select("_name", "_rank")

    masks = headed.select(F.col("_anchor").alias("_head"), "_mask").distinct()
    length = F.length("_name")
    named = _with_heads(keys, masks, lambda told: length >= F.length(told["_mask"]))
    # The text is what the name has at the literal places of the mask.
    named = named.withColumn("_text", _at_places(F.col("_name"), F.col("_mask")))
    found = hits(named, headed, ["_anchor", "_mask", "_text"])
    if not loose.isEmpty():
        pieces = spread_evenly(keys).select("_name", F.explode(_pieces(F.col("_name"))).alias("_anchor"))
        found = found.unionByName(hits(pieces, loose, ["_anchor"]))
    rankless = keys.withColumn("_rank", F.lit(None).cast(patterns.schema[rank].dataType))
    return found.unionByName(rankless).groupBy(F.col("_name").alias(name)).agg(F.min("_rank").alias(rank))


def _with_heads(keys: DataFrame, told: DataFrame, fits: Callable[[Column], Column] = lambda _: F.lit(True)) -> DataFrame:
    """``_name, _anchor``: each name with the heads that it begins with, and what else is ``told`` of them.

    ``fits`` says of a head's row whether the name takes it.
    """
    before = F.lit(None).cast("string")
    heads = told.select("_head").distinct()
    ordered = heads.select(F.col("_head").alias("_text"), F.lit(0).alias("_kind"), "_head")
    ordered = ordered.unionByName(keys.where("_name is not null").select(F.col("_name").alias("_text"), F.lit(1).alias("_kind"), before.alias("_head")))
    nearest = last_value(ordered, ["_text", "_kind"], "_head", "_last").where("_kind = 1 and _last is not null")
    # Heads are exploded to their beginnings, names are not.
    inner = heads.select(F.col("_head").alias("_last"), F.explode(_prefixes(F.col("_head"))).alias("_head"))
    entry = F.struct(F.col("_head").alias("_anchor"), *(c for c in told.columns if c != "_head"))
    chains = materialize(inner.join(told, "_head").groupBy("_last").agg(F.collect_list(entry).alias("_chain")))
    named = salted_join(nearest.select(F.col("_text").alias("_name"), "_last"), chains, ["_last"], F.col("_name"))
    begun = F.filter("_chain", lambda c: F.startswith("_name", c["_anchor"]) & fits(c))
    return named.select("_name", F.inline(begun))


def _at_places(name: Column, mask: Column) -> Column:
    """The characters of a name at the literal places of a mask, none for an empty mask."""
    one = F.lit(1)
    kept = F.transform(F.sequence(one, F.length(mask)), lambda i: F.when(F.substring(mask, i, one) == LITERAL, F.substring(name, i, one)))
    return F.when(mask == "", F.lit("")).otherwise(F.array_join(kept, ""))


def _prefixes(name: Column) -> Column:
    lengths = F.sequence(F.lit(0), F.length(name))
    return F.transform(lengths, lambda n: F.left(name, n))


def _pieces(name: Column) -> Column:
    def of_size(size):
        starts = F.sequence(F.lit(1), F.length(name) - (size - 1))
        pieces = F.transform(
            starts, lambda i: F.substring(name, i, F.lit(size))
        )
        none = F.array().cast("array<string>")
        return F.when(F.length(name) >= size, pieces).when(name.isNotNull(), none)

    sizes = [of_size(size) for size in range(1, GRAM + 1)]
    return F.array_distinct(F.concat(F.array(F.lit("")), *sizes))


def _shaped(patterns: DataFrame, pattern: str, rank: str) -> DataFrame:
    """Patterns with the text to check by LIKE (NULL where the head decides alone) and their literals."""
    # A backslash before an ordinary character means that character.
    like = F.regexp_replace("_pattern", r"\\(?![_%\\]|$)", "")
    literals = F.split(F.regexp_replace(like, r"\\.?", "%"), "[_%]")
    longest = F.array_max(
        F.transform(literals, lambda p: F.struct(F.length(p).alias("n"), p.alias("text")))
    )["text"]
    head = F.regexp_replace(F.regexp_extract(like, HEAD, 1), r"\\(.)", "$1")
    # Without a literal character only the number of ``_`` matters.
    shape = F.when(like.rlike("^[_%]*$"), F.regexp_replace(like, "%", "")).otherwise(like)
    wild = F.col("_pattern").rlike(WILDCARDS)
    fixed = F.regexp_extract(shape, FIXED, 1)
    mask = F.regexp_replace(fixed, r"(?s)\\.|[^_]", LITERAL)
    text = F.regexp_replace(fixed, r"(?s)\\(.)|_", "$1")
    none = F.lit("")
    # Equality at the places of the mask decides where nothing follows them.
    loose = shape.startswith("%")
    decided = ~loose & (fixed == shape)
    return (
        patterns.where(F.col(pattern).isNotNull())
        .select(F.col(pattern).alias("_pattern"), F.col(rank).alias("_rank"))
        .select(
            "_rank",
            F.when(wild & ~decided, shape).alias("_like"),
            F.when(wild, head).otherwise(F.col("_pattern")).alias("_head"),
            F.when(wild, mask).otherwise(none).alias("_mask"),
            F.when(wild, text).otherwise(none).alias("_text"),
            longest.alias("_piece"),
            (wild & loose).alias("_loose"),
        )
    )


def _lowest(shaped: DataFrame, *by) -> DataFrame:
    return shaped.groupBy(*by, "_like").agg(F.min("_rank").alias("_rank"))
