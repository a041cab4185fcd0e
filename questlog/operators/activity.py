"""What the marts share: users per arm and sessions summed per user and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questlog.functions import day_diff, exact_sum

# Fixed value: last day after install that the daily curves show.
LAST_CURVE_DAY = 13


def cohort_sizes(users: DataFrame) -> DataFrame:
    """Users per arm, with or without events."""
    return users.groupBy("ab_version").agg(F.count("*").alias("cohort_users"))


def members(users: DataFrame) -> DataFrame:
    """Users with ``copies``, the number of equal rows.

    A user id assigned many times stays one row here; sums multiply by
    ``copies`` instead of joining every copy.
    """
    return users.groupBy("userid", "ab_version", "install_date").agg(
        F.count("*").alias("copies")
    )


def user_days(sessions: DataFrame) -> DataFrame:
    """Sessions summed per user and start day; sessions without a day are left out.

    Sessions of one user lie more than 30 minutes apart, so a user has at most
    46 a day: gathering them by user is safe for any user, and the join on
    the user that follows needs no second shuffle.
    """
    return (
        sessions.where(F.col("session_date").isNotNull())
        .repartition("userid")
        .groupBy("userid", "session_date")
        .agg(
            F.count("*").alias("sessions"),
            F.sum("rounds_played").alias("rounds_played"),
            exact_sum(F.col("revenue_usd")).alias("revenue_usd"),
            F.sum("purchase_count").alias("purchase_count"),
        )
    )


def day_since_install() -> Column:
    return day_diff(F.col("install_date"), F.col("session_date"))


def days_of_members(users: DataFrame, sessions: DataFrame) -> DataFrame:
    """User days of assigned users with arm, copies and ``day_since_install``."""
    return (
        user_days(sessions)
        .join(members(users), "userid")
        .withColumn("day_since_install", day_since_install())
    )
