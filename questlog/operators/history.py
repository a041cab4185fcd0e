"""Attribute history of users and features for churn models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from questlog.functions import exact_sum
from questlog.operators.activity import LAST_CURVE_DAY, day_since_install, user_days

# Fixed value: churn features cover the first week after install.
FEATURE_DAYS = 7


def attribute_history(events: DataFrame) -> DataFrame:
    """Type-2 history of platform and app version, one row per unchanged span of days.

    The state of a day is that of its last event with a known value. States
    are taken per user and day first, so the ordered part holds at most one
    row per user and day.
    """
    timed = events.where(F.col("event_time").isNotNull())

    # Latest time per value first: fixed-width buffers, combined map-side.
    values = timed.groupBy("userid", "event_date", "platform", "app_version").agg(
        F.max("event_time").alias("last_time")
    )

    def last_known(attribute: str):
        known = F.when(
            F.col(attribute).isNotNull(), F.struct("last_time", F.col(attribute))
        )
        return F.max(known)[attribute].alias(attribute)

    days = (
        values.repartition("userid")
        .groupBy("userid", "event_date")
        .agg(last_known("platform"), last_known("app_version"))
    )
    by_day = Window.partitionBy("userid").orderBy("event_date")
    state = F.struct("platform", "app_version")
    before = F.lag(state).over(by_day)
    changed = F.when(before.eqNullSafe(state), 0).otherwise(1)
    spans = (
        days.withColumn("changed", changed)
        .withColumn("version_no", F.sum("changed").over(by_day))
        .groupBy("userid", "version_no", "platform", "app_version")
        .agg(F.min("event_date").alias("valid_from"))
    )
    by_span = Window.partitionBy("userid").orderBy("version_no")
    next_from = F.lead("valid_from").over(by_span)
    return spans.select(
        "userid",
        "version_no",
        "platform",
        "app_version",
        "valid_from",
        F.date_sub(next_from, 1).alias("valid_to"),
        next_from.isNull().alias("is_current"),
    )


def churn_features(users: DataFrame, sessions: DataFrame) -> DataFrame:
    """Activity of days 0..6 per installed user and whether days 7..13 stayed empty."""
    installed = (
        users.where(F.col("install_date").isNotNull())
        .select("userid", "install_date")
        .distinct()
    )
    day = F.col("day")
    early = day.between(0, FEATURE_DAYS - 1)
    later = day.between(FEATURE_DAYS, LAST_CURVE_DAY)

    def in_week(column: str):
        return F.sum(F.when(early, F.col(column)).otherwise(0))

    revenue = exact_sum(F.when(early, F.col("revenue_usd")))
    return (
        installed.join(user_days(sessions), "userid", "left")
        .withColumn("day", day_since_install())
        .groupBy("userid", "install_date")
        .agg(
            F.count_if(early).alias("active_days"),
            in_week("sessions").alias("sessions"),
            in_week("rounds_played").alias("rounds_played"),
            in_week("purchase_count").alias("purchases"),
            F.coalesce(revenue, F.lit(0.0)).alias("revenue_usd"),
            F.max(F.when(early, day)).alias("last_active_day"),
            (F.count_if(later) == 0).alias("churned"),
        )
    )
