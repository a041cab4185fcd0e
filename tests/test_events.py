import random

import pytest
from pyspark.errors import PySparkException

from questlog.operators.events import events_clean, typed_events
from questlog.operators.profiles import (
    duplicate_delivery_profile,
    late_arrival_profile,
    missing_metadata_profile,
)
from tests.fixtures import day, raw_events


def test_one_row_per_event(spark):
    raw = raw_events(
        spark,
        [
            {"event_id": "a", "_source_file": "events_2024-01-02.csv", "device_id": "late"},
            {"event_id": "a", "_source_file": "events_2024-01-01.csv", "device_id": "first"},
            {"event_id": "a", "_source_file": "events_2024-01-03.csv", "device_id": "last"},
            {"event_id": None},
            {"event_id": None},
        ],
    )
    rows = {r["event_id"]: r for r in events_clean(raw).collect()}
    assert set(rows) == {"a", None}
    assert rows["a"]["device_id"] == "first"


def test_kept_copy_does_not_depend_on_row_order(spark):
    rows = [
        {"event_id": f"e{i % 7}", "country": c, "platform": p, "product_id": str(i % 5)}
        for i, (c, p) in enumerate((c, p) for c in ("US", "GB", None) for p in ("ios", None))
        for _ in range(3)
    ]
    kept = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        out = events_clean(raw_events(spark, rows).repartition(3)).collect()
        kept.add(frozenset(tuple(r) for r in out))
    assert len(kept) == 1


def test_defaults_and_types(spark):
    raw = raw_events(
        spark, [{"rounds_completed": "3.0", "revenue_usd": "junk", "userid": "116.0"}]
    )
    row = events_clean(raw).first()
    assert (row["platform"], row["country"]) == ("unknown", "unknown")
    assert (row["app_version"], row["device_id"]) == (None, None)
    assert (row["rounds_completed"], row["revenue_usd"], row["userid"]) == (3, None, 116)
    assert row["event_date"] == day("2024-01-01")


@pytest.mark.parametrize("bad", [{"client_event_time": "bad"}, {"userid": "x"}])
def test_unreadable_key_columns_fail(spark, bad):
    with pytest.raises(PySparkException, match="cannot read"):
        typed_events(raw_events(spark, [bad])).collect()


def test_copies_are_reduced_before_the_shuffle(spark):
    plan = events_clean(raw_events(spark, [{}]))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("WindowGroupLimit") == 2
    assert physical.rindex("WindowGroupLimit") > physical.index("Exchange")


def test_profiles(spark):
    raw = raw_events(
        spark,
        [
            {"event_id": "a", "platform": "ios"},
            {"event_id": "a", "_source_file": "events_2024-01-03.csv"},
            {"event_id": "b", "platform": "ios"},
            {
                "event_id": "c",
                "filename": "landing/landing_date=2024-01-02/part-0.csv",
                "_source_file": "part-0.csv",
            },
        ],
    )
    late = {(r[0], r[1]): r[2] for r in late_arrival_profile(raw).collect()}
    assert late == {
        (day("2024-01-01"), 0): 2,
        (day("2024-01-03"), 2): 1,
        (day("2024-01-02"), 1): 1,
    }
    copies = {r["copies"]: tuple(r)[1:] for r in duplicate_delivery_profile(raw).collect()}
    assert copies == {1: (2, 2, 0.6667, 0.5), 2: (1, 2, 0.3333, 0.5)}
    missing = {
        (r["_source_file"], r["column_name"]): (r["null_count"], r["null_share"])
        for r in missing_metadata_profile(raw).collect()
    }
    assert missing["events_2024-01-01.csv", "platform"] == (0, 0.0)
    assert missing["part-0.csv", "platform"] == (1, 1.0)
    assert len(missing) == 3 * 12
