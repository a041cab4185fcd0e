"""Profiles of delivered data: lateness, duplicate delivery, missing metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from questlog.functions import day_diff, ratio, round_half_away
from questlog.sources.landing_csv import EVENT_COLUMNS, drop_date


def late_arrival_profile(raw: DataFrame) -> DataFrame:
    """Delivered rows per drop date and days between the event and its drop.

    A missing or unreadable time, which a profile must survive, counts under NULL days.
    """
    event_date = F.col("client_event_time").try_cast("timestamp_ntz").cast("date")
    return (
        raw.select(drop_date().alias("drop_date"), event_date.alias("event_date"))
        .withColumn("days_late", day_diff(F.col("event_date"), F.col("drop_date")))
        .groupBy("drop_date", "days_late")
        .agg(F.count("*").alias("row_count"))
    )


def duplicate_delivery_profile(raw: DataFrame) -> DataFrame:
    """Events by number of delivered copies, with their share of events and rows.

    The totals run over one row per number of copies; k different numbers need
    more than k * k / 2 delivered rows, so these are few.
    """
    copies = raw.groupBy("event_id").agg(F.count("*").alias("copies"))
    by_copies = copies.groupBy("copies").agg(F.count("*").alias("events"))
    counted = by_copies.withColumn("delivered_rows", F.col("copies") * F.col("events"))

    def share_of_all(column: str) -> Column:
        total = F.sum(column).over(Window.partitionBy())
        return round_half_away(ratio(F.col(column), total), 4)

    return counted.withColumns(
        {
            "event_share": share_of_all("events"),
            "row_share": share_of_all("delivered_rows"),
        }
    )


def missing_metadata_profile(raw: DataFrame) -> DataFrame:
    """NULL count and share of every event column per source file.

    One pass counts all columns; the unpivot runs on one row per file.
    """
    counted = raw.groupBy("_source_file").agg(
        F.count("*").alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in EVENT_COLUMNS],
    )
    return counted.unpivot(
        ["_source_file", "row_count"], EVENT_COLUMNS, "column_name", "null_count"
    ).withColumn(
        "null_share",
        round_half_away(ratio(F.col("null_count"), F.col("row_count")), 4),
    )
