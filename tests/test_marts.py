from questlog.operators import engagement, history, monetization, retention
from questlog.operators.sessions import sessions
from questlog.operators.users import users_dim
from tests.fixtures import clean_events, day, raw_assignments


def _tables(spark, assignments, rows):
    events = clean_events(spark, rows)
    played = sessions(events)
    return users_dim(raw_assignments(spark, assignments), events, played), played


def _user(userid, *days, **kw):
    return [{"userid": userid, "event_time": f"2024-01-{d:02d} 10:00:00", **kw} for d in days]


def _assigned(*users, arm="gate_30"):
    return [(u, arm, 0, False, False) for u in users]


def test_retention_curve(spark):
    # user 1 on days 0, 1, 3 and 14; user 2 without events; user 9 not assigned
    users, played = _tables(
        spark, _assigned(1, 2), _user(1, 1, 2, 4, 15) + _user(9, 1, 2)
    )
    out = retention.retention_curve(users, played).collect()
    assert [tuple(r) for r in out] == [
        ("gate_30", 0, 1, 2, 0.5, 0.5),
        ("gate_30", 1, 1, 2, 0.5, 0.5),
        ("gate_30", 3, 1, 2, 0.5, 0.5),
    ]


def test_trailing_mean_is_over_rows_and_unrounded(spark):
    users, played = _tables(
        spark,
        _assigned(1, 2, 3),
        _user(1, 1, 2, 4, 5) + _user(2, 1, 2) + _user(3, 1),
    )
    out = retention.retention_curve(users, played).collect()
    assert [(r[1], r[2], r[4], r[5]) for r in out] == [
        (0, 3, 1.0, 1.0),
        (1, 2, 0.6667, 0.8333),
        (3, 1, 0.3333, 0.6667),
        (4, 1, 0.3333, 0.4444),
    ]


def test_users_assigned_twice(spark):
    """Distinct players count once per arm, revenue counts per assignment row."""
    rows = _user(1, 1, event_name="purchase", revenue_usd=1.1)
    users, played = _tables(spark, _assigned(1, 1, 1), rows)
    curve = retention.retention_curve(users, played).first()
    assert (curve["active_users"], curve["cohort_users"]) == (1, 3)
    ltv = monetization.ltv_curve(users, played).first()
    assert (ltv["revenue_that_day"], ltv["cumulative_ltv_per_user"]) == (3.3, 1.1)
    summary = monetization.monetization_summary(users, played).first()
    assert (summary["users"], summary["paying_users"]) == (1, 1)
    assert summary["total_revenue_usd"] == 3.3


def test_validation_counts_unknown_flags_as_false(spark):
    assignments = [(1, "gate_30", 0, True, None), (2, "gate_30", 0, None, None)]
    users, _ = _tables(spark, assignments, _user(1, 1, 2))
    row = retention.retention_validation(users).first()
    assert tuple(row) == ("gate_30", 2, 0.5, 0.5, 0.0, 0.0)


def test_monetization_slices(spark):
    rows = (
        _user(1, 1, event_name="purchase", revenue_usd=4.99)
        + _user(1, 20, event_name="purchase", revenue_usd=0.99)
        + _user(2, 1)
        + _user(3, 1, platform="android")
    )
    users, played = _tables(spark, _assigned(1, 2, 3, 4), rows)
    summary = monetization.monetization_summary(users, played)
    assert [tuple(r) for r in summary.collect()] == [
        ("gate_30", "android", "US", 1, 0, 0.0, 0.0, 0.0, None),
        ("gate_30", "ios", "US", 2, 1, 0.5, 5.98, 2.99, 5.98),
        ("gate_30", None, None, 1, 0, 0.0, 0.0, 0.0, None),
    ]
    assert monetization.monetization_preview(summary, 2).count() == 2


def test_payer_has_a_purchase_not_revenue(spark):
    rows = _user(1, 1, event_name="purchase") + _user(2, 1, revenue_usd=3.0)
    users, played = _tables(spark, _assigned(1, 2), rows)
    row = monetization.monetization_summary(users, played).first()
    assert (row["paying_users"], row["arppu_usd"]) == (1, 3.0)


def test_ltv_curve_runs_up_and_ends_after_day_13(spark):
    rows = _user(1, 1, 15, event_name="purchase", revenue_usd=10.0)
    rows += _user(2, 2, 4, event_name="purchase", revenue_usd=1.25)
    users, played = _tables(spark, _assigned(1, 2, 3, 4), rows)
    out = [tuple(r)[1:] for r in monetization.ltv_curve(users, played).collect()]
    assert out == [(0, 11.25, 11.25, 2.8125), (2, 1.25, 12.5, 3.125)]


def test_segments_and_readout(spark):
    rows = [
        {"userid": u, "event_time": "2024-01-01 10:00:00", "rounds_completed": r}
        for u, r in enumerate([0, 1, 1, 2, 3, 4, 5, 6, 7, 8])
    ]
    users, played = _tables(spark, _assigned(*range(10)), rows)
    segments = engagement.engagement_segments(users)
    out = {r["userid"]: (r["engagement_segment"], r["engagement_rank"]) for r in segments.collect()}
    assert [out[u][0] for u in range(10)] == [
        "non_activated", "casual", "casual", "regular", "regular", "regular",
        "core", "core", "power_user", "power_user",
    ]
    assert [out[u][1] for u in range(10)] == [10, 8, 8, 7, 6, 5, 4, 3, 2, 1]
    summary = [tuple(r) for r in engagement.segment_summary(segments).collect()]
    assert summary == [
        ("non_activated", 1, 0.0),
        ("casual", 2, 1.0),
        ("regular", 3, 3.0),
        ("core", 2, 5.5),
        ("power_user", 2, 7.5),
    ]
    top = engagement.top_players(users, 2).collect()
    assert sorted(r["userid"] for r in top) == [8, 9]
    percentile = {r[0]: r[2] for r in engagement.engagement_percentile(users).collect()}
    assert (percentile[0], percentile[1], percentile[9]) == (0.1, 0.25, 1.0)


def test_readout_weights_rounded_slices(spark):
    users = spark.createDataFrame(
        [("gate_30", True, False)] * 3 + [("gate_40", False, None)],
        "ab_version string, real_retention_1 boolean, real_retention_7 boolean",
    )
    summary = spark.createDataFrame(
        [
            ("gate_30", 2, 1, 0.3333, 1.01),
            ("gate_30", 1, 0, 0.0, 0.0),
            ("gate_40", 1, 0, 0.0, 0.0),
        ],
        "ab_version string, users bigint, paying_users bigint, conversion_rate double, "
        "total_revenue_usd double",
    )
    out = [tuple(r) for r in engagement.ab_test_readout(users, summary).collect()]
    assert out == [
        ("gate_30", 3, 1.0, 0.0, 0.2222, 0.3367, 1.01),
        ("gate_40", 1, 0.0, 0.0, 0.0, 0.0, None),
    ]


def test_cohort_heatmap(spark):
    # Monday 2024-01-01 and Sunday 2024-01-07 are one week
    rows = _user(1, 1, 2) + _user(2, 7, 8) + _user(3, 8)
    users, played = _tables(spark, _assigned(1, 2, 3), rows)
    out = [tuple(r) for r in retention.cohort_heatmap(users, played).collect()]
    assert out == [
        (day("2024-01-01"), 0, 2, 2, 1.0),
        (day("2024-01-01"), 1, 2, 2, 1.0),
        (day("2024-01-08"), 0, 1, 1, 1.0),
    ]


def test_attribute_history(spark):
    def event(d, platform, version):
        return {
            "event_time": f"2024-01-{d:02d} 10:00:00",
            "platform": platform,
            "app_version": version,
        }

    events = [
        event(1, "ios", "1.0"),
        event(2, "ios", "1.0"),
        event(4, "ios", "1.1"),
        event(6, "ios", None),
        event(7, "ios", None),
        event(8, "ios", "1.0"),
    ]
    out = history.attribute_history(clean_events(spark, events)).collect()
    rows = sorted(tuple(r)[1:] for r in out)
    assert rows == [
        (1, "ios", "1.0", day("2024-01-01"), day("2024-01-03"), False),
        (2, "ios", "1.1", day("2024-01-04"), day("2024-01-05"), False),
        (3, "ios", None, day("2024-01-06"), day("2024-01-07"), False),
        (4, "ios", "1.0", day("2024-01-08"), None, True),
    ]


def test_churn_features(spark):
    rows = (
        _user(1, 1, 3, 8, rounds_completed=2)
        + _user(1, 2, event_name="purchase", revenue_usd=0.99)
        + _user(2, 1)
    )
    users, played = _tables(spark, _assigned(1, 2, 3), rows)
    out = {r["userid"]: tuple(r)[2:] for r in history.churn_features(users, played).collect()}
    assert out == {
        1: (3, 3, 4, 1, 0.99, 2, False),
        2: (1, 1, 0, 0, 0.0, 0, True),
    }
