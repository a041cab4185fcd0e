from questlog.operators.sessions import sessions
from questlog.operators.users import recomputed_metrics, user_attrs, users_dim
from tests.fixtures import clean_events, day, raw_assignments


def test_attributes(spark):
    rows = [
        {"event_time": "2024-01-02 10:00:00", "platform": "ios", "country": "US",
         "app_version": "1.9.0"},
        {"event_time": "2024-01-01 10:00:00", "platform": "android", "country": "GB",
         "app_version": "1.44.0"},
        {"event_time": "2024-01-03 10:00:00", "platform": "ios", "country": None,
         "app_version": None},
        {"event_time": None, "userid": 2, "platform": "b", "country": "x"},
        {"event_time": None, "userid": 2, "platform": "a", "country": "x"},
    ]
    out = {r["userid"]: tuple(r)[1:] for r in user_attrs(clean_events(spark, rows)).collect()}
    # ties take the smallest value, versions compare as text
    assert out[1] == (day("2024-01-01"), "ios", "GB", "1.9.0")
    assert out[2] == (None, "a", "x", "1.44.0")


def _dim(spark, assignments, rows):
    events = clean_events(spark, rows)
    return users_dim(raw_assignments(spark, assignments), events, sessions(events))


def test_recomputed_retention(spark):
    rows = [
        {"event_time": "2024-01-01 23:50:00", "rounds_completed": 2},
        {"event_time": "2024-01-02 00:10:00", "rounds_completed": 3},
        {"event_time": "2024-01-08 00:10:00", "rounds_completed": 4},
        {"event_time": "2024-01-01 10:00:00", "userid": 2},
        {"event_time": "2024-01-02 10:00:00", "userid": 2},
    ]
    events = clean_events(spark, rows)
    out = recomputed_metrics(sessions(events), user_attrs(events)).collect()
    # user 1's day-2 event continues the session begun on the install day
    assert sorted(tuple(r) for r in out) == [(1, 9, 0, 1), (2, 0, 1, 0)]


def test_user_without_events(spark):
    out = _dim(spark, [(5, "gate_30", 3, True, False)], [{"event_time": "2024-01-01 10:00:00"}])
    row = out.first()
    assert tuple(row)[:5] == (5, "gate_30", 3, True, False)
    assert tuple(row)[5:9] == (None,) * 4
    assert tuple(row)[9:] == (0, False, False)


def test_user_id_assigned_twice_stays_two_rows(spark):
    assignments = [(1, "gate_30", 3, True, False), (1, "gate_40", 4, False, False)]
    out = _dim(spark, assignments, [{"event_time": "2024-01-01 10:00:00"}]).collect()
    assert sorted(r["ab_version"] for r in out) == ["gate_30", "gate_40"]
    assert {r["install_date"] for r in out} == {day("2024-01-01")}


def test_untimed_sessions_count_for_rounds(spark):
    rows = [
        {"event_time": "2024-01-01 10:00:00", "rounds_completed": 1},
        {"event_time": None, "rounds_completed": 2},
        {"event_time": None, "rounds_completed": 4},
    ]
    row = _dim(spark, [(1, "gate_30", 0, False, False)], rows).first()
    assert row["event_derived_rounds"] == 7
