"""Text-to-type casts for landed columns. Landing keeps everything as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _whole(text: Column, type_name: str) -> Column:
    # '3.0' is not a Spark integer literal: such text goes through a decimal,
    # which rounds half away from zero and rejects NaN, inf and '1d'. Which way
    # to go is seen from the text, as a failing cast costs an exception per row.
    number = F.round(text.try_cast("decimal(38,12)"), 0).try_cast(type_name)
    fraction = text.contains(".") | F.lower(text).contains("e")
    return F.when(fraction, number).otherwise(text.try_cast(type_name))


def lenient_double(text: Column) -> Column:
    """Text to double; junk is NULL. Java's '1d' / '1f' suffixes and hexadecimal count as junk."""
    trimmed = F.lower(F.rtrim(text))
    suffixed = trimmed.endswith("d") | (
        trimmed.endswith("f") & ~trimmed.endswith("inf")
    )
    return F.when(~suffixed & ~trimmed.contains("x"), text.try_cast("double"))


def lenient_int(text: Column) -> Column:
    """Text to int; '3.0' is 3, '2.5' is 3, '1e2' is 100, junk and overflow are NULL.

    Rounds half away from zero. NaN and what is out of range give NULL.
    """
    return F.round(lenient_double(text), 0).try_cast("int")


def strict(text: Column, type_name: str) -> Column:
    """Text to ``type_name``; NULL stays NULL, anything unreadable fails the job.

    The failure does not depend on ``spark.sql.ansi.enabled``.
    """
    if type_name in ("int", "bigint"):
        value = _whole(text, type_name)
    elif type_name.startswith("timestamp"):
        # a year or a month alone is no time
        value = F.when(text.rlike(r"^\s*[+-]?\d+-\d+-\d"), text.try_cast(type_name))
    elif type_name == "boolean":
        value = F.when(text == F.trim(text), text.try_cast(type_name))
    else:
        value = text.try_cast(type_name)
    failure = F.raise_error(
        F.concat(F.lit("cannot read '"), text, F.lit(f"' as {type_name}"))
    )
    return F.when(text.isNull(), F.lit(None)).otherwise(
        F.coalesce(value, failure.cast(type_name))
    )
