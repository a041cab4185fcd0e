"""Engagement segments and the experiment readout."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from questlog.functions import exact_sum, ratio, round_half_away
from questlog.operators import ranking
from questlog.operators.retention import share

# Segment names from least to most engaged; the last four are the
# quartiles by rounds.
NON_ACTIVATED = "non_activated"
QUARTILE_SEGMENTS = ["casual", "regular", "core", "power_user"]

_ROUNDS = "event_derived_rounds"
_USER = ["userid", "ab_version", "platform", "country", _ROUNDS]


def engagement_segments(users: DataFrame) -> DataFrame:
    """Rank by rounds (most first) and segment of every user.

    A user without rounds is not activated whatever the quartile, but counts
    when the quartiles are drawn.
    """
    no_rounds = F.col(_ROUNDS) == 0
    tiled = ranking.with_tiles(
        users.select(*_USER), _ROUNDS, "userid", len(QUARTILE_SEGMENTS), no_rounds
    )
    names = F.array(*[F.lit(s) for s in QUARTILE_SEGMENTS])
    segment = F.when(no_rounds, NON_ACTIVATED).otherwise(
        F.get(names, (F.col("tile") - 1).cast("int"))
    )
    return tiled.select(
        *_USER,
        F.col("rank").alias("engagement_rank"),
        segment.alias("engagement_segment"),
    )


def top_players(users: DataFrame, places: int = 20) -> DataFrame:
    """Users ranked among the first ``places``; ties share a rank.

    The last place's rounds are found by a distributed top-k; nobody below
    takes part further, and those left have at most ``places`` different rounds.
    """
    best = users.select(_ROUNDS).orderBy(F.desc_nulls_last(_ROUNDS)).limit(places)
    last = best.agg(F.min(_ROUNDS)).first()[0]
    leading = users.select(*_USER).where(F.col(_ROUNDS) >= F.lit(last).cast("bigint"))
    counts = leading.groupBy(_ROUNDS).agg(F.count("*").alias("n"))
    order = Window.orderBy(F.desc(_ROUNDS)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select(
        _ROUNDS, (F.coalesce(F.sum("n").over(order), F.lit(0)) + 1).alias("engagement_rank")
    )
    ranks = F.broadcast(ranks.where(F.col("engagement_rank") <= places))
    return leading.join(ranks, _ROUNDS).select(*_USER, "engagement_rank")


def engagement_percentile(users: DataFrame) -> DataFrame:
    """Average-rank percentile by rounds, in (0, 1]."""
    positions = ranking.value_positions(users.select(_ROUNDS), _ROUNDS).select(
        _ROUNDS, ranking.percentile_rank().alias("engagement_percentile")
    )
    return users.select("userid", _ROUNDS).join(positions, _ROUNDS).select(
        "userid", _ROUNDS, "engagement_percentile"
    )


def segment_summary(segments: DataFrame) -> DataFrame:
    """Users and mean rounds per segment, least engaged first."""
    return (
        segments.groupBy("engagement_segment")
        .agg(
            F.count("*").alias("users"),
            round_half_away(F.avg(_ROUNDS), 1).alias("avg_rounds"),
        )
        .orderBy("avg_rounds")
    )


def ab_test_readout(users: DataFrame, summary: DataFrame) -> DataFrame:
    """Published retention and monetization per arm.

    Monetization is taken from the summary's rounded columns: conversion as
    the user-weighted mean over slices, revenue as the sum over slices.
    """
    retention = users.groupBy("ab_version").agg(
        F.count("*").alias("users"),
        share("real_retention_1").alias("real_retention_1_rate"),
        share("real_retention_7").alias("real_retention_7_rate"),
    )
    weighted = exact_sum(F.col("users") * F.col("conversion_rate"))
    revenue = exact_sum(F.col("total_revenue_usd"))
    monetization = summary.groupBy("ab_version").agg(
        round_half_away(ratio(weighted, F.sum("users")), 4).alias("conversion_rate"),
        round_half_away(ratio(revenue, F.sum("users")), 4).alias("arpu_usd"),
        round_half_away(ratio(revenue, F.sum("paying_users")), 4).alias("arppu_usd"),
    )
    return retention.join(monetization, "ab_version").orderBy("ab_version")
