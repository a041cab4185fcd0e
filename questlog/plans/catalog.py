"""Named queries: each takes (spark, folder of sample tables) to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from questlog.operators import (
    bronze,
    churn,
    engagement,
    events,
    history,
    monetization,
    profiles,
    quality,
    retention,
    sessions,
    users,
)
from questlog.plans import medallion
from questlog.plans.store import Store
from questlog.session import scratch_dir
from questlog.sources import landing_csv
from questlog.sources.landing_csv import ASSIGNMENT_COLUMNS, EVENT_COLUMNS, drop_date
from questlog.sources.snapshots import BatchTable
from questlog.sources.warehouse import TABLES, Warehouse
from questlog.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

_SOURCE = ["filename", "_source_file"]
_PURCHASE_COLUMNS = ["revenue_usd", "product_id", "currency"]


def _on_store(query: Callable[[Store], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(Store(spark, sf_dir))


def _silver_counts(s: Store) -> DataFrame:
    return bronze.row_counts(
        {
            "silver.events_clean": s.events_clean,
            "silver.sessions": s.sessions,
            "silver.users_dim": s.users_dim,
        }
    )


def _bronze_counts(s: Store) -> DataFrame:
    return bronze.row_counts(
        {
            "bronze.raw_events": s.raw_events,
            "bronze.raw_experiment_assignments": s.raw_assignments,
        }
    )


def _checks(s: Store) -> DataFrame:
    clean, played, users = s.events_clean, s.sessions, s.users_dim
    validation = retention.retention_validation(users)
    return quality.quality_checks(
        s.raw_events, s.raw_assignments, clean, played, users, validation, s.counts
    )


def _csv_union_by_name(s: Store) -> DataFrame:
    """Land the raw rows under two headers by drop, read them back by column name and show where each came from."""
    landing = scratch_dir(s.spark, "landing")
    raw = s.raw_events.select(*EVENT_COLUMNS, F.col("_source_file").alias("drop_file"))
    is_purchase = F.coalesce(F.col("event_name") == "purchase", F.lit(False))
    others = [c for c in reversed(EVENT_COLUMNS) if c not in _PURCHASE_COLUMNS]
    kinds = {"purchases": (is_purchase, EVENT_COLUMNS), "others": (~is_purchase, others)}
    for kind, (chosen, columns) in kinds.items():
        rows = raw.where(chosen).select(*columns, "drop_file").hint("rebalance", "drop_file")
        rows.write.partitionBy("drop_file").csv(f"{landing}/{kind}", header=True, escape='"')
    back = landing_csv.read_event_drops(s.spark, [f"{landing}/{kind}" for kind in kinds])
    return back.select(
        *EVENT_COLUMNS,
        F.regexp_extract("filename", "/(purchases|others)/", 1).alias("kind"),
        F.regexp_extract("filename", "/drop_file=([^/]*)/[^/]*$", 1).alias("drop_file"),
        (F.regexp_extract("filename", "([^/]+)$", 1) == F.col("_source_file")).alias("file_is_last_part"),
    )


def _land_assignments(s: Store, purpose: str) -> str:
    """Folder with the experiment export as CSV."""
    landing = scratch_dir(s.spark, purpose)
    s.raw_assignments.select(*ASSIGNMENT_COLUMNS).write.csv(landing, header=True, escape='"')
    return landing


def _csv_single_export(s: Store) -> DataFrame:
    """Land the experiment export, read it back as text and stamp it with file and load time."""
    landing = _land_assignments(s, "export")
    started = F.lit(s.spark.sql("SELECT current_timestamp()").first()[0])
    landed = bronze.land(landing_csv.read_assignments(s.spark, landing))
    return landed.select(
        *ASSIGNMENT_COLUMNS,
        F.contains("filename", F.lit(landing.rsplit("/", 1)[1])).alias("file_is_in_folder"),
        (F.regexp_extract("filename", "([^/]+)$", 1) == F.col("_source_file")).alias("file_is_last_part"),
        (F.col("_ingested_at") >= started).alias("stamped_by_load"),
    )


def _csv_quoted_fields(s: Store) -> DataFrame:
    """Land raw rows whose device holds separators, quotes and a line break, and read them back."""
    landing = scratch_dir(s.spark, "quoted")
    device = F.concat(F.lit('a "b", '), "device_id", F.lit("\nc"))
    s.raw_events.select(*EVENT_COLUMNS).withColumn("device_id", device).write.csv(landing, header=True, escape='"')
    return landing_csv.read_event_drops(s.spark, landing, multiline=True).select(*EVENT_COLUMNS)


def _warehouse_build(s: Store) -> DataFrame:
    """Build all tables from landing files, commit and publish them, and count each by its SQL name."""
    drops, root = scratch_dir(s.spark, "drops"), scratch_dir(s.spark, "warehouse")
    landing_csv.land_by_drop_date(s.raw_events, drops)
    assignments = _land_assignments(s, "export")
    warehouse = Warehouse(s.spark, root)
    medallion.build(
        landing_csv.read_event_drops(s.spark, drops),
        landing_csv.read_assignments(s.spark, assignments),
        warehouse,
    )
    warehouse.commit()
    warehouse.publish()
    names = [f"{layer}.{name}" for layer, tables in TABLES.items() for name in tables]
    return bronze.row_counts({name: s.spark.table(name) for name in names})


class _StreamFolders:
    """Landing zone, tables and checkpoint of one stream, and the raw rows to land."""

    def __init__(self, s: Store):
        self.spark = s.spark
        folder = scratch_dir(s.spark, "stream")
        self.landing = f"{folder}/landing"
        self.table = f"{folder}/table"
        self.events = f"{folder}/events"
        self.checkpoint = f"{folder}/checkpoint"
        self.raw = s.raw_events

    def land(self, rows: DataFrame) -> None:
        landing_csv.land_by_drop_date(rows, self.landing)

    def run(self, job: Callable[[DataFrame, int, str], None]) -> DataFrame:
        """Run a job on what landed since its last run; the whole table so far."""
        jobs.run_available(self.spark, self.landing, self.checkpoint, job)
        return BatchTable(self.spark, self.table).read()

    def run_in_two(self, job: Callable[[DataFrame, int, str], None]) -> DataFrame:
        """Two runs; the second sees the later drops only."""
        first_half = F.coalesce(F.dayofmonth(drop_date()) <= 15, F.lit(True))
        for drops in (self.raw.where(first_half), self.raw.where(~first_half)):
            self.land(drops)
            table = self.run(job)
        return table


def _stream_incremental_load(s: Store) -> DataFrame:
    folders = _StreamFolders(s)
    return folders.run_in_two(jobs.append_raw(folders.table)).select(*EVENT_COLUMNS)


def _stream_dedup(s: Store) -> DataFrame:
    folders = _StreamFolders(s)
    return folders.run_in_two(jobs.append_new_events(folders.table))


def _stream_sessions(s: Store) -> DataFrame:
    folders = _StreamFolders(s)
    folders.run_in_two(jobs.append_sessions(folders.events, folders.table))
    return jobs.latest_sessions(s.spark, folders.table)


QUERIES: dict[str, Query] = {
    # landing
    "raw_events": _on_store(lambda s: s.raw_events.select(*EVENT_COLUMNS, *_SOURCE)),
    "raw_experiment_assignments": _on_store(
        lambda s: s.raw_assignments.select(*ASSIGNMENT_COLUMNS, *_SOURCE)
    ),
    "bronze_row_counts": _on_store(_bronze_counts),
    "csv_union_by_name": _on_store(_csv_union_by_name),
    "csv_single_export": _on_store(_csv_single_export),
    "csv_quoted_fields": _on_store(_csv_quoted_fields),
    "warehouse_build": _on_store(_warehouse_build),
    # cleaned layer
    "events_clean": _on_store(lambda s: events.events_clean(s.raw_events)),
    "sessions": _on_store(lambda s: sessions.sessions(s.events_clean)),
    "sessions_by_session_window": _on_store(
        lambda s: sessions.sessions_by_session_window(s.events_clean)
    ),
    "user_attrs": _on_store(lambda s: users.user_attrs(s.events_clean)),
    "recomputed_metrics": _on_store(
        lambda s: users.recomputed_metrics(s.sessions, users.user_attrs(s.events_clean))
    ),
    "users_dim": _on_store(
        lambda s: users.users_dim(s.raw_assignments, s.events_clean, s.sessions)
    ),
    "silver_row_counts": _on_store(_silver_counts),
    # marts
    "mart_retention_curve": _on_store(
        lambda s: retention.retention_curve(s.users_dim, s.sessions)
    ),
    "mart_retention_validation": _on_store(
        lambda s: retention.retention_validation(s.users_dim)
    ),
    "user_revenue": _on_store(
        lambda s: monetization.user_revenue(s.users_dim, s.sessions)
    ),
    "mart_monetization_summary": _on_store(
        lambda s: monetization.monetization_summary(s.users_dim, s.sessions)
    ),
    "monetization_preview": _on_store(
        lambda s: monetization.monetization_preview(s.monetization_summary)
    ),
    "mart_ltv_curve": _on_store(
        lambda s: monetization.ltv_curve(s.users_dim, s.sessions)
    ),
    "mart_engagement_segments": _on_store(
        lambda s: engagement.engagement_segments(s.users_dim)
    ),
    "top_players": _on_store(lambda s: engagement.top_players(s.users_dim)),
    "mart_engagement_segment_summary": _on_store(
        lambda s: engagement.segment_summary(
            engagement.engagement_segments(s.users_dim)
        )
    ),
    "mart_ab_test_readout": _on_store(
        lambda s: engagement.ab_test_readout(s.users_dim, s.monetization_summary)
    ),
    # checks
    "dq_checks": _on_store(_checks),
    "dq_verdict": _on_store(lambda s: quality.verdict(_checks(s))),
    "dq_orphan_sessions": _on_store(
        lambda s: quality.orphan_sessions(s.sessions, s.users_dim)
    ),
    "dq_duplicate_assignments": _on_store(
        lambda s: quality.duplicate_keys(s.raw_assignments, "userid")
    ),
    # profiles and extensions
    "engagement_percentile": _on_store(
        lambda s: engagement.engagement_percentile(s.users_dim)
    ),
    "late_arrival_profile": _on_store(
        lambda s: profiles.late_arrival_profile(s.raw_events)
    ),
    "duplicate_delivery_profile": _on_store(
        lambda s: profiles.duplicate_delivery_profile(s.raw_events)
    ),
    "missing_metadata_profile": _on_store(
        lambda s: profiles.missing_metadata_profile(s.raw_events)
    ),
    "cohort_heatmap": _on_store(
        lambda s: retention.cohort_heatmap(s.users_dim, s.sessions)
    ),
    "scd2_user_history": _on_store(lambda s: history.attribute_history(s.events_clean)),
    "churn_features": _on_store(
        lambda s: history.churn_features(s.users_dim, s.sessions)
    ),
    "churn_scores": _on_store(
        lambda s: churn.churn_scores(
            history.churn_features(s.users_dim, s.sessions),
            s.sessions.agg(F.max("session_date")),
        )
    ),
    # streams
    "stream_incremental_load": _on_store(_stream_incremental_load),
    "stream_dedup": _on_store(_stream_dedup),
    "stream_sessions": _on_store(_stream_sessions),
}
