"""Distinct counts that can be added up: ids as numbered bits, merged over days instead of recounted.

A distinct count of a week is not the sum of its days' counts, but the union of their sets is the
week's set. Ids get numbers once; a group's ids of a day are bits of blocks of 32,768 numbers, and
blocks of many days are merged by OR. Counts are exact. Blocks with few ids are kept as lists.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rulecast.operators.lineage import materialize

#: Up to so many ids a block is a list of places; its bitmap would have 4 KB.
FEW = 256
SKETCH_SIZE = 12

_PART = 33  # bits of a row's place within its partition in monotonically_increasing_id


def new_numbers(ids: DataFrame, id_column: str, numbers: DataFrame) -> DataFrame:
    """``id, number`` for the ids that have no number in ``numbers`` yet; NULL ids get none.

    Numbers go on without gaps from the highest one, so that blocks are full. Each partition numbers
    its own ids; only how many each partition has is added up in one place.
    """
    distinct = ids.select(F.col(id_column).alias("id")).where("id is not null").distinct()
    unknown = distinct.join(numbers.select("id"), "id", "left_anti")
    placed = materialize(unknown.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _PART)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # a row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    highest = numbers.agg(F.max("number")).first()[0]
    base = 0 if highest is None else highest + 1
    within = F.col("_at").bitwiseAND(F.lit((1 << _PART) - 1))
    numbered = placed.withColumn("_part", part).join(offsets, "_part")
    return numbered.select("id", (F.lit(base) + F.col("_before") + within).alias("number"))


def id_blocks(rows: DataFrame, keys: Sequence[str], id_column: str, numbers: DataFrame) -> DataFrame:
    """``*keys, block, few, bits``: the distinct ids of each group, as blocks of their numbers.

    ``few`` is the sorted list of places in a block with few ids, ``bits`` the bitmap of any other.
    Rows with a NULL id count nowhere; ids without a number are an error of the caller and left out.
    """
    seen = rows.where(F.col(id_column).isNotNull()).select(*keys, F.col(id_column).alias("id")).distinct()
    number = F.col("number") + 1  # bitmap functions count from 1
    place = F.bitmap_bit_position(number).alias("place")
    blocks = (
        seen.join(numbers, "id")
        .select(*keys, F.bitmap_bucket_number(number).alias("block"), place)
        .groupBy(*keys, "block")
        .agg(F.count("*").alias("_n"), F.bitmap_construct_agg("place").alias("_bits"), F.collect_list(F.col("place").cast("int")).alias("_few"))
    )
    few = F.col("_n") <= FEW
    return blocks.select(*keys, "block", F.when(few, F.array_sort("_few")).alias("few"), F.when(~few, F.col("_bits")).alias("bits"))


def merged(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``*keys, block, bits``: the union of the blocks of each group."""
    listed = blocks.where("few is not null").select(*keys, "block", F.explode(F.col("few").cast("array<bigint>")).alias("place"))
    from_lists = listed.groupBy(*keys, "block").agg(F.bitmap_construct_agg("place").alias("bits"))
    whole = blocks.where("bits is not null").select(*keys, "block", "bits")
    return whole.unionByName(from_lists).groupBy(*keys, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_ids(blocks: DataFrame, keys: Sequence[str], out: str = "reach") -> DataFrame:
    """``*keys, out``: how many distinct ids the blocks of each group hold together."""
    return merged(blocks, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(out))


def distinct_ids_without(blocks: DataFrame, keys: Sequence[str], wanted: Column, excluded: Column, out: str = "reach") -> DataFrame:
    """``*keys, out``: distinct ids of wanted blocks that no excluded block of the group holds.

    Those are the ids of both kinds together less the excluded ones. Groups without such an id have
    no row. A condition that is NULL does not hold.
    """
    both = distinct_ids(blocks.where(F.coalesce(wanted, F.lit(False)) | F.coalesce(excluded, F.lit(False))), keys, "_both")
    less = distinct_ids(blocks.where(excluded), keys, "_less")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    left = both.alias("a").join(less.alias("b"), same, "left")
    count = F.col("_both") - F.coalesce("_less", F.lit(0))
    return left.select(*(F.col(f"a.{k}") for k in keys), count.alias(out)).where(F.col(out) > 0)


def id_sketches(rows: DataFrame, keys: Sequence[str], id_column: str, size: int = SKETCH_SIZE) -> DataFrame:
    """``*keys, sketch``: a small fixed-size summary of each group's ids, where an estimate is enough."""
    seen = rows.where(F.col(id_column).isNotNull())
    return seen.groupBy(*keys).agg(F.hll_sketch_agg(F.col(id_column), F.lit(size)).alias("sketch"))


def estimated_ids(sketches: DataFrame, keys: Sequence[str], out: str = "reach") -> DataFrame:
    """``*keys, out``: about how many distinct ids the sketches of each group stand for."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out))
