"""Counting and unnesting nested collections."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def element_count(df: DataFrame, path: str) -> Column:
    """Number of elements of an array or map column; 0 for NULL.

    For an array of structs only its narrowest leaf is named, so a columnar scan reads that leaf.
    """
    kind = _type_at(df.schema, path)
    target = path
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        nested = (T.MapType, T.ArrayType, T.StructType)
        leaf = min(kind.elementType.fields, key=lambda f: isinstance(f.dataType, nested))
        target = f"{path}.{leaf.name}"
    return F.coalesce(F.size(F.col(target)), F.lit(0))


def key_count(df: DataFrame, path: str, key: str) -> Column:
    """Number of elements with this key, in an array of ``{key, value}`` structs or in a map.

    Of an array only the keys are read.
    """
    if isinstance(_type_at(df.schema, path), T.MapType):
        hits = F.map_contains_key(F.col(path), F.lit(key)).cast("int")
    else:
        hits = F.size(F.filter(F.col(f"{path}.key"), lambda k: k == F.lit(key)))
    return F.coalesce(hits, F.lit(0))


def any_map_has_key(path: str, field: str, key: str) -> Column:
    """True when a map inside one of the array's structs holds the key."""
    has = F.exists(
        F.col(f"{path}.{field}"), lambda m: m.isNotNull() & F.map_contains_key(m, F.lit(key))
    )
    return F.coalesce(has, F.lit(False))


def unnest(df: DataFrame, **arrays: str) -> DataFrame:
    """One row per combination of the elements of the named arrays.

    A NULL or empty array removes the row. ``unnest(df, b="header.ids")`` adds column ``b``. Where
    only the number of combinations matters, multiply :func:`element_count` instead.
    """
    return reduce(
        lambda d, item: d.withColumn(item[0], F.explode(F.col(item[1]))), arrays.items(), df
    )


def unnest_map(df: DataFrame, path: str, key: str = "key", value: str = "value") -> DataFrame:
    """One row per entry of a map column."""
    return df.select("*", F.explode(F.col(path)).alias(key, value))


def _type_at(schema: T.StructType, path: str) -> T.DataType:
    return reduce(lambda t, part: t[part].dataType, path.split("."), schema)
