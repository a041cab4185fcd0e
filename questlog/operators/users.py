"""User attributes and the user dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from questlog.functions import day_diff, strict
from questlog.session import materialise


def typed_assignments(raw: DataFrame) -> DataFrame:
    """Landed assignment text to types; unreadable values fail the job."""
    return raw.select(
        strict(F.col("userid"), "bigint").alias("userid"),
        F.col("version").alias("ab_version"),
        strict(F.col("sum_gamerounds"), "int").alias("real_sum_gamerounds"),
        strict(F.col("retention_1"), "boolean").alias("real_retention_1"),
        strict(F.col("retention_7"), "boolean").alias("real_retention_7"),
    )


def user_attrs(events: DataFrame) -> DataFrame:
    """Per user: first day, most frequent platform and country, greatest version text.

    Events are counted per user and attribute set first (map-side), so a user
    with very many events is a handful of rows when the users are gathered.
    The most frequent values then need no further shuffle. Ties go to the
    smallest value.
    """
    sets = (
        events.groupBy("userid", "platform", "country", "app_version")
        .agg(F.count("*").alias("n"), F.min("event_date").alias("first_date"))
        .repartition("userid")
    )

    def total(attribute: str) -> Column:
        return F.sum("n").over(Window.partitionBy("userid", attribute))

    def most_frequent(attribute: str) -> Column:
        candidate = F.when(
            F.col(attribute).isNotNull(),
            F.struct(-F.col(f"{attribute}_n"), F.col(attribute)),
        )
        return F.min(candidate)[attribute].alias(attribute)

    return (
        sets.withColumn("platform_n", total("platform"))
        .withColumn("country_n", total("country"))
        .groupBy("userid")
        .agg(
            F.min("first_date").alias("install_date"),
            most_frequent("platform"),
            most_frequent("country"),
            F.max("app_version").alias("latest_app_version"),
        )
    )


def _rounds_by_day(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("userid", "session_date").agg(
        F.sum("rounds_played").alias("rounds_played")
    )


def _recomputed_columns() -> list[Column]:
    day = day_diff(F.col("install_date"), F.col("session_date"))

    def came_back(n: int) -> Column:
        return F.max(F.when(day == n, 1).otherwise(0))

    return [
        F.sum("rounds_played").alias("event_derived_rounds"),
        came_back(1).alias("event_derived_retention_1"),
        came_back(7).alias("event_derived_retention_7"),
    ]


def recomputed_metrics(sessions: DataFrame, attrs: DataFrame) -> DataFrame:
    """Per user with sessions: rounds, and whether a session began on day 1 / day 7."""
    installs = attrs.select("userid", "install_date")
    days = _rounds_by_day(sessions).join(installs, "userid")
    return days.groupBy("userid").agg(*_recomputed_columns())


def users_dim(
    raw_assignments: DataFrame, events: DataFrame, sessions: DataFrame
) -> DataFrame:
    """One row per assignment: published metrics, attributes, recomputed metrics.

    Attributes and recomputed metrics meet on the user first and are written
    out, one row per user. The assignments are joined to that table, once. A
    user id assigned many times stays many rows; the join is between two plain
    shuffles, so adaptive execution can split its partition.
    """
    attr_columns = ["install_date", "platform", "country", "latest_app_version"]
    per_user = (
        user_attrs(events)
        .join(_rounds_by_day(sessions), "userid", "left")
        .groupBy("userid", *attr_columns)
        .agg(*_recomputed_columns())
    )
    came_back = {
        c: F.coalesce(c, F.lit(0)) == 1
        for c in ("event_derived_retention_1", "event_derived_retention_7")
    }
    return (
        typed_assignments(raw_assignments)
        .join(materialise(per_user, "per-user"), "userid", "left")
        .select(
            "userid",
            "ab_version",
            "real_sum_gamerounds",
            "real_retention_1",
            "real_retention_7",
            *attr_columns,
            F.coalesce("event_derived_rounds", F.lit(0)).alias("event_derived_rounds"),
            *[flag.alias(name) for name, flag in came_back.items()],
        )
    )
