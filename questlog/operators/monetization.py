"""Revenue marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from questlog.functions import exact_sum, ratio, round_half_away
from questlog.operators.activity import LAST_CURVE_DAY, cohort_sizes, days_of_members

SLICE = ["ab_version", "platform", "country"]


def in_slice_order(summary: DataFrame) -> DataFrame:
    return summary.orderBy(*[F.col(c).asc_nulls_last() for c in SLICE])


def user_revenue(users: DataFrame, sessions: DataFrame) -> DataFrame:
    """Revenue and purchases per user, arm, platform and country; 0 without sessions.

    Both sides are one row per user before they meet. A user id assigned n
    times in one slice counts its sessions n times, by multiplication.
    """
    spent = sessions.groupBy("userid").agg(
        exact_sum(F.col("revenue_usd")).alias("revenue"),
        F.sum("purchase_count").alias("purchases"),
    )
    copies = users.groupBy("userid", *SLICE).agg(F.count("*").alias("copies"))
    return copies.join(spent, "userid", "left").select(
        "userid",
        *SLICE,
        F.coalesce(times("revenue", "copies"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.col("purchases") * F.col("copies"), F.lit(0)).alias(
            "total_purchases"
        ),
    )


def times(amount: str, copies: str) -> Column:
    """Amount times a row count; exact for the usual count of 1."""
    return F.when(F.col(copies) == 1, F.col(amount)).otherwise(
        round_half_away(F.col(amount) * F.col(copies), 6)
    )


def monetization_summary(users: DataFrame, sessions: DataFrame) -> DataFrame:
    """Users, payers, conversion, revenue, ARPU and ARPPU per slice.

    A payer has a purchase, whatever its revenue. Slices are the user's own
    attributes; users without events form the NULL slice.
    """
    payers = F.count_if(F.col("total_purchases") > 0)
    totals = (
        user_revenue(users, sessions)
        .groupBy(*SLICE)
        .agg(
            F.count("*").alias("users"),
            payers.alias("paying_users"),
            exact_sum(F.col("total_revenue")).alias("revenue"),
        )
    )
    revenue, n, paying = F.col("revenue"), F.col("users"), F.col("paying_users")
    return in_slice_order(
        totals.select(
            *SLICE,
            "users",
            "paying_users",
            round_half_away(ratio(paying, n), 4).alias("conversion_rate"),
            round_half_away(revenue, 2).alias("total_revenue_usd"),
            round_half_away(ratio(revenue, n), 4).alias("arpu_usd"),
            round_half_away(ratio(revenue, paying), 4).alias("arppu_usd"),
        )
    )


def monetization_preview(summary: DataFrame, rows: int = 10) -> DataFrame:
    """First rows of the summary in slice order."""
    return in_slice_order(summary).limit(rows)


def ltv_curve(users: DataFrame, sessions: DataFrame) -> DataFrame:
    """Revenue per arm and day 0..13, running total, running total per cohort user."""
    daily = (
        days_of_members(users, sessions)
        .where(F.col("day_since_install").between(0, LAST_CURVE_DAY))
        .withColumn("revenue", times("revenue_usd", "copies"))
        .groupBy("ab_version", "day_since_install")
        .agg(exact_sum(F.col("revenue")).alias("day_revenue"))
    )
    so_far = (
        Window.partitionBy("ab_version")
        .orderBy("day_since_install")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        daily.join(cohort_sizes(users), "ab_version")
        .withColumn("running", exact_sum(F.col("day_revenue"), so_far))
        .select(
            "ab_version",
            "day_since_install",
            round_half_away(F.col("day_revenue"), 2).alias("revenue_that_day"),
            round_half_away(F.col("running"), 2).alias("cumulative_revenue"),
            round_half_away(
                ratio(F.col("running"), F.col("cohort_users")), 4
            ).alias("cumulative_ltv_per_user"),
        )
        .orderBy("ab_version", "day_since_install")
    )
