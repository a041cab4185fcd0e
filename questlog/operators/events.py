"""Cleaned events: typed, defaulted, one row per event_id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from questlog.functions import lenient_double, lenient_int, strict

# Fixed value: stands for a platform or country the client did not send.
UNKNOWN = "unknown"

CLEAN_COLUMNS = [
    "event_id",
    "event_name",
    "event_time",
    "event_date",
    "userid",
    "platform",
    "country",
    "app_version",
    "device_id",
    "rounds_completed",
    "revenue_usd",
    "product_id",
    "currency",
]


def typed_events(raw: DataFrame) -> DataFrame:
    """Landed text to types. A bad time or user id fails; bad amounts are NULL."""
    event_time = strict(F.col("client_event_time"), "timestamp_ntz")
    return raw.select(
        "event_id",
        "event_name",
        event_time.alias("event_time"),
        strict(F.col("userid"), "bigint").alias("userid"),
        F.coalesce("platform", F.lit(UNKNOWN)).alias("platform"),
        F.coalesce("country", F.lit(UNKNOWN)).alias("country"),
        "app_version",
        "device_id",
        lenient_int(F.col("rounds_completed")).alias("rounds_completed"),
        lenient_double(F.col("revenue_usd")).alias("revenue_usd"),
        "product_id",
        "currency",
        "_ingested_at",
        "_source_file",
    )


def events_clean(raw: DataFrame) -> DataFrame:
    """First delivered copy of every event.

    The order ends with all columns, so the kept copy does not depend on file
    or task order. Spark keeps only the best row per id in each map task
    (WindowGroupLimit) before the shuffle: an id with very many copies, or a
    flood of rows without id, arrives as one row per task.
    """
    derived_or_first = ("event_id", "event_time", "event_date")
    order = ["_ingested_at", "event_time", "_source_file"]
    order += [c for c in CLEAN_COLUMNS if c not in derived_or_first]
    copies = Window.partitionBy("event_id").orderBy(
        *[F.col(c).asc_nulls_last() for c in order]
    )
    first = (
        typed_events(raw)
        .withColumn("copy", F.row_number().over(copies))
        .where("copy = 1")
    )
    event_date = F.col("event_time").cast("date")
    return first.withColumn("event_date", event_date).select(*CLEAN_COLUMNS)
