"""Data-quality checks as rows of (check_name, passed, detail)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: greatest distance of a recomputed rate from the published one.
RATE_TOLERANCE = 0.05


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def _detail(**parts: Column) -> Column:
    texts = [F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in parts.items()]
    return F.concat_ws(" ", *texts).alias("detail")


def _compare_counts(
    check: str,
    left: tuple[str, DataFrame | int],
    right: tuple[str, DataFrame | int],
    passed: Callable[[Column, Column], Column],
) -> DataFrame:
    """Row counts against each other, known ones or those of tables."""
    known = {name: F.lit(n).cast("bigint") for name, n in (left, right) if isinstance(n, int)}
    tables = [(name, df) for name, df in (left, right) if not isinstance(df, int)]
    if tables:
        name, df = tables[0]
        counts = _count(df, name)
        known |= {other: _count(rows, other).scalar() for other, rows in tables[1:]}
    else:
        counts = SparkSession.active().range(1)
    values = {name: F.col(name) for name in (left[0], right[0])}
    return counts.withColumns(known).select(
        F.lit(check).alias("check_name"),
        passed(*values.values()).alias("passed"),
        _detail(**values),
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys on more than one row, with their row count."""
    copies = df.groupBy(key).agg(F.count("*").alias("row_count"))
    return copies.where(F.col("row_count") > 1)


def orphan_sessions(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Session count per user id without a user row (a missing id is one).

    Sessions are counted per user before the join, so no id is large.
    """
    per_user = sessions.groupBy("userid").agg(F.count("*").alias("sessions"))
    return per_user.join(users.select("userid").distinct(), "userid", "left_anti")


def _none_left(check: str, counted: str, df: DataFrame, n: Column) -> DataFrame:
    found = df.agg(F.coalesce(n, F.lit(0)).alias("n"))
    return found.select(
        F.lit(check).alias("check_name"),
        (F.col("n") == 0).alias("passed"),
        _detail(**{counted: F.col("n")}),
    )


def _rate_check(validation: DataFrame, day: int) -> DataFrame:
    published = F.col(f"real_retention_{day}_rate")
    derived = F.col(f"event_derived_retention_{day}_rate")
    return validation.select(
        F.concat(
            F.lit(f"d{day}_retention_within_5pp["),
            F.coalesce("ab_version", F.lit("NULL")),
            F.lit("]"),
        ).alias("check_name"),
        (F.abs(published - derived) < RATE_TOLERANCE).alias("passed"),
        _detail(
            published=published.cast("decimal(10,4)"),
            derived=derived.cast("decimal(10,4)"),
        ),
    )


def quality_checks(
    raw_events: DataFrame,
    raw_assignments: DataFrame,
    events: DataFrame,
    sessions: DataFrame,
    users: DataFrame,
    validation: DataFrame,
    counts: dict[str, int] | None = None,
) -> DataFrame:
    """All checks of a built warehouse.

    ``counts`` has rows of tables that are known, by the name of the argument,
    as from ``Warehouse.rows``; tables that are only counted are not read then.
    ``dedup_removed_rows`` is strict: a feed without any duplicate fails it.
    """
    def rows(name: str, table: DataFrame) -> DataFrame | int:
        return (counts or {}).get(name, table)

    checks = [
        _compare_counts(
            "assigned_users_preserved",
            ("assignments", rows("raw_assignments", raw_assignments)),
            ("users", rows("users", users)),
            lambda assignments, users: assignments == users,
        ),
        _compare_counts(
            "dedup_removed_rows",
            ("raw", rows("raw_events", raw_events)),
            ("clean", rows("events", events)),
            lambda raw, clean: raw > clean,
        ),
        _none_left(
            "event_ids_unique",
            "duplicated",
            duplicate_keys(events, "event_id"),
            F.count("*"),
        ),
        _rate_check(validation, 1),
        _rate_check(validation, 7),
        _none_left(
            "no_orphan_sessions",
            "orphans",
            orphan_sessions(sessions, users),
            F.sum("sessions"),
        ),
    ]
    return reduce(DataFrame.unionAll, checks)


def verdict(checks: DataFrame) -> DataFrame:
    """One row: did every check pass."""
    return checks.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
    )
