"""Numbers, including those that arrive as text."""

from pyspark.sql import Column, functions as F


def as_number(text: Column) -> Column:
    """Text to DOUBLE; anything that is not a number becomes NULL."""
    return text.try_cast("double")


def whole_or_text(value: Column) -> Column:
    """A DOUBLE as text, without the ``.0`` of a whole number."""
    whole = value == F.floor(value)
    return F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))


def at_least_ratio(part: Column, whole: Column, minimum: Column) -> Column:
    """``part / whole >= minimum`` with IEEE division by zero.

    A positive part over zero counts as infinite and passes any known minimum; zero over zero
    passes none. NULL on any side gives NULL or false, never true.
    """
    return F.when(whole != 0, F.try_divide(part, whole) >= minimum).otherwise(
        (whole == 0) & (part > 0) & minimum.isNotNull()
    )


def at_most_cost(cost: Column, units: Column, maximum: Column) -> Column:
    """``cost / units <= maximum``; no units means an unbounded cost, which fails."""
    return F.when(units != 0, F.try_divide(cost, units) <= maximum).otherwise(F.lit(False))
