"""Gap sessions: a new one starts after more than 30 minute boundaries of silence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from questlog.functions import exact_sum, minute_floor, minute_index, second_diff
from questlog.operators.earliest import ATTRIBUTES, Codes, pair
from questlog.operators.ranking import running_counts
from questlog.session import materialise

# Fixed value: minute boundaries without an event that end a session.
GAP_MINUTES = 30

SESSION_COLUMNS = [
    "session_id",
    "userid",
    "session_start",
    "session_end",
    "session_duration_seconds",
    "session_date",
    "event_count",
    "rounds_played",
    "revenue_usd",
    "purchase_count",
    *ATTRIBUTES,
]


def _is_purchase() -> Column:
    return F.coalesce((F.col("event_name") == "purchase").cast("bigint"), F.lit(0))


def minute_rollup(events: DataFrame, codes: Codes | None = None) -> DataFrame:
    """Events summed per user and minute; attributes as numbers of ``codes``.

    The gap rule only sees minutes, so all events of one user and minute share
    a session. Summing them first, in each map task and then per minute, leaves
    at most one row per minute of a user, or of the events without a user,
    however many there are and whatever their attributes.
    """
    codes = codes or Codes(events)
    minute = minute_index(F.col("event_time")).alias("minute")
    rolled = codes.pack_in_minute(events).groupBy("userid", minute).agg(
        F.count("*").alias("events"),
        F.min("event_time").alias("first_time"),
        F.max("event_time").alias("last_time"),
        F.sum("rounds_completed").alias("rounds"),
        exact_sum(F.col("revenue_usd")).alias("revenue"),
        F.sum(_is_purchase()).alias("purchases"),
        *[F.min(a).alias(a) for a in ATTRIBUTES],
    )
    return codes.lift(rolled)


def _sums() -> list[Column]:
    """What spans of one session add up to, again a span."""
    return [
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
        F.sum("events").alias("events"),
        F.sum("rounds").alias("rounds"),
        exact_sum(F.col("revenue")).alias("revenue"),
        F.sum("purchases").alias("purchases"),
        *[F.min(a).alias(a) for a in ATTRIBUTES],
    ]


def _measures(parts: DataFrame) -> DataFrame:
    """Sums under the names of the sessions table."""
    names = {
        "session_start": F.col("first_time"),
        "session_end": F.col("last_time"),
        "event_count": F.col("events"),
        "rounds_played": F.coalesce("rounds", F.lit(0)),
        "revenue_usd": F.coalesce("revenue", F.lit(0.0)),
        "purchase_count": F.col("purchases"),
        # value of the earliest event carrying one, smallest on a tie
        **{a: F.col(a)["value"] for a in ATTRIBUTES},
    }
    return parts.withColumns(names)


def finish(sessions: DataFrame) -> DataFrame:
    duration = second_diff(F.col("session_start"), F.col("session_end"))
    return sessions.withColumns(
        {
            "session_duration_seconds": duration,
            "session_date": F.col("session_start").cast("date"),
        }
    )


def _joined(spans: DataFrame, gap_minutes: int) -> DataFrame:
    """Spans of a user that lie within the gap of one another as one, numbered ``seq`` per user from 1.

    They may overlap and come in any order. The numbering and the sums share
    one shuffle, of the users.
    """
    in_order = Window.partitionBy("userid").orderBy("first_minute", "last_minute")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    silence = F.col("first_minute") - F.max("last_minute").over(earlier)
    return (
        spans.withColumn("starts", F.when(silence <= gap_minutes, 0).otherwise(1))
        .withColumn("seq", F.sum("starts").over(so_far))
        .groupBy("userid", "seq")
        .agg(
            F.min("first_minute").alias("first_minute"),
            F.max("last_minute").alias("last_minute"),
            *_sums(),
        )
    )


def _minutes(events: DataFrame, codes: Codes) -> DataFrame:
    """The rollup's minutes as spans. Events without a time are none."""
    rolled = minute_rollup(events.where(F.col("event_time").isNotNull()), codes)
    return rolled.withColumn("first_minute", F.col("minute")).withColumnRenamed("minute", "last_minute")


def _untimed(events: DataFrame) -> DataFrame:
    """Events without a time, as spans without minutes under their event id."""
    time = F.lit(None).cast("timestamp_ntz")
    return events.where(F.col("event_time").isNull()).select(
        "userid",
        "event_id",
        time.alias("first_time"),
        time.alias("last_time"),
        F.lit(1).cast("bigint").alias("events"),
        F.col("rounds_completed").cast("bigint").alias("rounds"),
        F.col("revenue_usd").alias("revenue"),
        _is_purchase().alias("purchases"),
        *[pair(a, F.col("event_time")).alias(a) for a in ATTRIBUTES],
    )


def _add_untimed(timed: DataFrame, untimed: DataFrame) -> DataFrame:
    """Events without a time come last: a user's first one belongs to the user's
    last session, every other one is a session of its own.

    First is by a hash of the event id, whose digits spread even a single
    user's events over many tasks when their places are counted. The number of
    the last session is counted along, as the weight of a row put in front.
    """
    # Text instead of a number, as a missing user id must meet itself in joins.
    user = F.coalesce(F.col("userid").cast("string"), F.lit("")).alias("user")
    place = F.conv(F.substring(F.md5("event_id"), 1, 15), 16, 10).cast("bigint")
    rows = untimed.withColumns({"user": user, "place": place, "is_event": F.lit(1)})
    timed = timed.withColumn("user", user)
    # only users with such events have anything to count, and only their last sessions change
    known = timed.join(rows.select("user").distinct(), "user", "left_semi")
    earlier = known.groupBy("user").agg((F.max("seq") - 1).alias("events"))
    earlier = earlier.withColumns(
        {"place": F.lit(-(2**63)).cast("bigint"), "is_event": F.lit(0)}
    )
    placed = running_counts(
        rows.unionByName(earlier, allowMissingColumns=True),
        "place",
        "events",
        ("user",),
        ("is_event", "event_id"),
    )
    columns = ["userid", "seq", "first_time", "last_time", "events", "rounds", "revenue", "purchases", *ATTRIBUTES]
    numbered = placed.where("is_event = 1").withColumn("seq", F.col("before") + 1)
    numbered = materialise(numbered.select("user", *columns), "untimed-events")
    taken = numbered.select("user", "seq")
    parts = timed.join(taken, ["user", "seq"], "left_semi").select(*columns).unionByName(numbered.select(*columns))
    changed = parts.groupBy("userid", "seq").agg(*_sums())
    return timed.join(taken, ["user", "seq"], "left_anti").select(*columns).unionByName(changed.select(*columns))


def _numbered(timed: DataFrame, untimed: DataFrame, codes: Codes) -> DataFrame:
    """The sessions table from joined spans and events without a time, of packed attributes.

    The latter need further steps, which depend on whether there are any.
    """
    if not untimed.isEmpty():
        timed = _add_untimed(materialise(timed, "timed-sessions"), untimed)
    session_id = F.concat_ws("-", "userid", "seq")
    session_id = F.when(F.col("userid").isNotNull(), session_id)
    named = _measures(codes.unpack(timed)).withColumn("session_id", session_id)
    return finish(named).select(*SESSION_COLUMNS)


def sessions(events: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """One row per session, numbered per user in time order.

    ``events`` has one row per event id and should be a stored table: it is
    looked through for the values of attributes, and for events without a time,
    which need further steps. Two shuffles: the minute rollup (after map-side
    sums) and the users.
    """
    codes = Codes(events)
    return _numbered(_joined(_minutes(events, codes), gap_minutes), codes.pack(_untimed(events)), codes)


def _span_codes(rows: DataFrame) -> Codes:
    return Codes(rows.select(*[F.col(a)["value"].alias(a) for a in ATTRIBUTES]))


def _parts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans of events with a time, and events without one."""
    return rows.where("first_minute IS NOT NULL").drop("event_id"), rows.where("first_minute IS NULL").drop("first_minute", "last_minute")


def spans(events: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """What a set of events knows of sessions: state that later events can be merged with.

    A row is a user's stretch of events without a gap, or an event without a
    time; ``sessions_of_spans`` makes sessions of any number of such sets.
    """
    codes = Codes(events)
    timed = codes.unpack(_joined(_minutes(events, codes), gap_minutes).drop("seq"))
    return timed.unionByName(_untimed(events), allowMissingColumns=True)


def merge_spans(rows: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Fewer spans that stand for the same events; ``rows`` are stored."""
    codes = _span_codes(rows)
    timed, untimed = _parts(rows)
    merged = codes.unpack(_joined(codes.pack(timed), gap_minutes).drop("seq"))
    return merged.unionByName(untimed, allowMissingColumns=True)


def sessions_of_spans(rows: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """The sessions of all events that the spans stand for, as ``sessions`` gives them; ``rows`` are stored."""
    codes = _span_codes(rows)
    timed, untimed = (codes.pack(part) for part in _parts(rows))
    return _numbered(_joined(timed, gap_minutes), untimed, codes)


def sessions_by_session_window(
    events: DataFrame, gap_minutes: int = GAP_MINUTES
) -> DataFrame:
    """The same sessions by ``session_window``, without a running number.

    Time is cut to minutes first: then "more than 30 boundaries" equals the
    30-minute gap of the built-in window. Rows without a time have no window.
    """
    codes = Codes(events)
    minutes = minute_rollup(events.where(F.col("event_time").isNotNull()), codes)
    window = F.session_window(
        minute_floor(F.col("first_time")), f"{gap_minutes} minutes"
    )
    rolled = minutes.groupBy("userid", window.alias("span")).agg(*_sums())
    columns = [c for c in SESSION_COLUMNS if c != "session_id"]
    return finish(_measures(codes.unpack(rolled))).select(*columns)
