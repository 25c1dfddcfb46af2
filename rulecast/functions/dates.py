"""Calendar helpers that do not depend on the session time zone."""

import datetime as dt

from pyspark.sql import Column, functions as F

MS_PER_DAY = 86_400_000


def utc_date(epoch_ms: Column) -> Column:
    """The UTC calendar day of an epoch-millisecond value."""
    return F.date_from_unix_date(F.floor(epoch_ms / F.lit(MS_PER_DAY)).cast("int"))


def date_of_parts(year: Column, month: Column, day: Column) -> Column:
    """A DATE from text parts, padded or not; NULL when they name no day."""
    sep = F.lit("-")
    text = F.concat(F.trim(year), sep, F.trim(month), sep, F.trim(day))
    return F.try_to_date(text, "yyyy-M-d")


def yesterday() -> dt.date:
    """The default run date: sources arrive with one day of delay."""
    return dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)


def as_date(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)
