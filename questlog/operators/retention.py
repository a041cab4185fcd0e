"""Retention marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from questlog.functions import ratio, round_half_away
from questlog.operators.activity import LAST_CURVE_DAY, cohort_sizes, days_of_members


def share(flag: str) -> Column:
    """Share of rows with a true flag, 4 digits; a NULL flag counts as false."""
    return round_half_away(F.avg(F.when(F.col(flag), 1.0).otherwise(0.0)), 4)


def retention_curve(users: DataFrame, sessions: DataFrame) -> DataFrame:
    """Users active per arm and day 0..13, their share, and its 3-row trailing mean.

    User days are unique per user, arm and day, so counting them is the exact
    distinct count and is combined map-side.
    """
    active = (
        days_of_members(users, sessions)
        .where(F.col("day_since_install").between(0, LAST_CURVE_DAY))
        .groupBy("ab_version", "day_since_install")
        .agg(F.count("userid").alias("active_users"))
    )
    last_three = (
        Window.partitionBy("ab_version")
        .orderBy("day_since_install")
        .rowsBetween(-2, Window.currentRow)
    )
    rate = ratio(F.col("active_users"), F.col("cohort_users"))
    return (
        active.join(cohort_sizes(users), "ab_version")
        .withColumn("rate", rate)
        .withColumn("trailing", F.avg("rate").over(last_three))
        .select(
            "ab_version",
            "day_since_install",
            "active_users",
            "cohort_users",
            round_half_away(F.col("rate"), 4).alias("retention_rate"),
            round_half_away(F.col("trailing"), 4).alias(
                "retention_rate_3day_trailing_avg"
            ),
        )
        .orderBy("ab_version", "day_since_install")
    )


def retention_validation(users: DataFrame) -> DataFrame:
    """Published against recomputed day-1 and day-7 rates per arm."""
    return (
        users.groupBy("ab_version")
        .agg(
            F.count("*").alias("users"),
            share("real_retention_1").alias("real_retention_1_rate"),
            share("event_derived_retention_1").alias("event_derived_retention_1_rate"),
            share("real_retention_7").alias("real_retention_7_rate"),
            share("event_derived_retention_7").alias("event_derived_retention_7_rate"),
        )
        .orderBy(F.col("ab_version").asc_nulls_last())
    )


def cohort_heatmap(users: DataFrame, sessions: DataFrame) -> DataFrame:
    """Install week by day since install: active users and their share of the week."""
    installed = users.where(F.col("install_date").isNotNull())
    # Monday of the week, without a time zone: 1970-01-05 was a Monday.
    weekday = F.pmod(F.unix_date("install_date") - 4, F.lit(7))
    week = F.date_sub("install_date", weekday).alias("install_week")
    sizes = (
        installed.select("userid", week)
        .distinct()
        .groupBy("install_week")
        .agg(F.count("userid").alias("cohort_users"))
    )
    # One row per user, whatever arms the user was assigned to.
    players = installed.withColumn("ab_version", F.lit(None).cast("string"))
    return (
        days_of_members(players, sessions)
        .groupBy(week, "day_since_install")
        .agg(F.count("userid").alias("active_users"))
        .join(sizes, "install_week")
        .select(
            "install_week",
            "day_since_install",
            "active_users",
            "cohort_users",
            round_half_away(
                ratio(F.col("active_users"), F.col("cohort_users")), 4
            ).alias("retention_rate"),
        )
        .orderBy("install_week", "day_since_install")
    )
