"""Small hand-made inputs."""

from __future__ import annotations

from datetime import date, datetime

from questlog.sources.landing_csv import ASSIGNMENT_COLUMNS, EVENT_COLUMNS

CLEAN_SCHEMA = (
    "event_id string, event_name string, event_time timestamp_ntz, event_date date, "
    "userid bigint, platform string, country string, app_version string, "
    "device_id string, rounds_completed int, revenue_usd double, product_id string, "
    "currency string"
)
RAW_SCHEMA = ", ".join(
    [f"{c} string" for c in (*EVENT_COLUMNS, "filename", "_source_file")]
    + ["_ingested_at timestamp"]
)
ASSIGNMENT_SCHEMA = ", ".join(f"{c} string" for c in ASSIGNMENT_COLUMNS)


def ts(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


def clean_events(spark, rows: list[dict]):
    """Cleaned events from partial rows; times as text, ids filled in."""
    full = []
    for i, row in enumerate(rows):
        time = ts(row.get("event_time"))
        full.append(
            (
                row.get("event_id", f"e{i}"),
                row.get("event_name", "app_open"),
                time,
                time.date() if time else None,
                row.get("userid", 1),
                row.get("platform", "ios"),
                row.get("country", "US"),
                row.get("app_version", "1.44.0"),
                "dev",
                row.get("rounds_completed"),
                row.get("revenue_usd"),
                None,
                None,
            )
        )
    return spark.createDataFrame(full, CLEAN_SCHEMA)


def raw_events(spark, rows: list[dict]):
    """Landed events from partial rows, all text."""
    full = []
    for i, row in enumerate(rows):
        base = {
            "event_id": f"e{i}",
            "event_name": "app_open",
            "client_event_time": "2024-01-01 10:00:00",
            "userid": "1",
            "_source_file": "events_2024-01-01.csv",
            "filename": "landing/events_2024-01-01.csv",
            "_ingested_at": datetime(2024, 3, 1),
        }
        base.update(row)
        names = (*EVENT_COLUMNS, "filename", "_source_file", "_ingested_at")
        full.append(tuple(base.get(c) for c in names))
    return spark.createDataFrame(full, RAW_SCHEMA)


def raw_assignments(spark, rows: list[tuple]):
    """(userid, version, rounds, retention_1, retention_7) as text."""
    texts = [tuple(None if v is None else str(v) for v in row) for row in rows]
    return spark.createDataFrame(texts, ASSIGNMENT_SCHEMA)


def day(text: str) -> date:
    return date.fromisoformat(text)
