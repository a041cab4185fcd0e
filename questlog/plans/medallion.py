"""Builds every table once, in dependency order, and checks the result.

    python -m questlog.plans.medallion [--multiline] EVENT_DROPS ASSIGNMENTS OUTPUT_ROOT
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from questlog.operators import (
    bronze,
    engagement,
    events,
    monetization,
    quality,
    retention,
    sessions,
    users,
)
from questlog.session import build_session, scratch_scope
from questlog.sources import landing_csv
from questlog.sources.warehouse import Warehouse

#: Input bytes for which a shuffle gets one more partition.
PARTITION_BYTES = 200_000_000


def build(
    raw_events: DataFrame,
    raw_assignments: DataFrame,
    warehouse: Warehouse,
    partition_events: bool = False,
) -> DataFrame:
    """Write all layers and the data-quality checks, and return the checks; ``warehouse.commit`` shows them.

    Every table is written once and read back, so no step repeats an earlier
    one and all marts see the same sessions. ``partition_events`` adds an
    ``event_date`` layout to the cleaned events for readers that select days;
    the marts read all days, so it is off by default.
    """
    write = warehouse.write
    raw = write("bronze.raw_events", bronze.land(raw_events))
    assigned = write("bronze.raw_experiment_assignments", bronze.land(raw_assignments))

    layout = "event_date" if partition_events else None
    clean = write("silver.events_clean", events.events_clean(raw), layout)
    played = write("silver.sessions", sessions.sessions(clean))
    dim = write("silver.users_dim", users.users_dim(assigned, clean, played))

    write("gold.mart_retention_curve", retention.retention_curve(dim, played))
    validation = write(
        "gold.mart_retention_validation", retention.retention_validation(dim)
    )
    summary = write(
        "gold.mart_monetization_summary", monetization.monetization_summary(dim, played)
    )
    write("gold.mart_ltv_curve", monetization.ltv_curve(dim, played))
    segments = write(
        "gold.mart_engagement_segments", engagement.engagement_segments(dim)
    )
    write(
        "gold.mart_engagement_segment_summary", engagement.segment_summary(segments)
    )
    write("gold.mart_ab_test_readout", engagement.ab_test_readout(dim, summary))
    written = {
        "raw_events": "bronze.raw_events",
        "raw_assignments": "bronze.raw_experiment_assignments",
        "events": "silver.events_clean",
        "users": "silver.users_dim",
    }
    counts = {name: warehouse.rows(table) for name, table in written.items()}
    checks = quality.quality_checks(raw, assigned, clean, played, dim, validation, counts)
    return write("gold.data_quality_checks", checks)


def row_report(warehouse: Warehouse) -> DataFrame:
    """Row counts of the landing and cleaned layers, as counted when they were written."""
    tables = [
        "bronze.raw_events",
        "bronze.raw_experiment_assignments",
        "silver.events_clean",
        "silver.sessions",
        "silver.users_dim",
    ]
    counts = [(t, warehouse.rows(t)) for t in tables]
    return warehouse.spark.createDataFrame(counts, "table_name string, row_count long")


def run(
    spark: SparkSession,
    event_drops: str,
    assignments: str,
    output_root: str,
    multiline: bool = False,
) -> DataFrame:
    """Build from CSV landing files, commit all tables in one step and publish them to SQL.

    A build that fails leaves the tables of the one before. ``multiline``
    allows line breaks inside quoted fields, at the cost of one task per file.
    """
    warehouse = Warehouse(spark, output_root)
    with scratch_scope(spark):
        checks = build(
            landing_csv.read_event_drops(spark, event_drops, multiline),
            landing_csv.read_assignments(spark, assignments, multiline),
            warehouse,
        )
        warehouse.commit()
    warehouse.publish()
    return checks


def size_shuffles(spark: SparkSession, *paths: str) -> int:
    """Set shuffle partitions for the input's bytes, the session's setting at least."""
    files = spark.read.format("binaryFile").load(list(paths))
    size = files.agg(F.sum("length")).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(least, -(-size // PARTITION_BYTES))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


def main(arguments: list[str]) -> int:
    parser = argparse.ArgumentParser(prog="medallion", description="Build the warehouse from CSV landing files.")
    parser.add_argument("event_drops", help="files or folders of telemetry drops")
    parser.add_argument("assignments", help="experiment export")
    parser.add_argument("output_root", help="folder of the warehouse")
    parser.add_argument("--multiline", action="store_true", help="take line breaks inside quoted fields")
    given = parser.parse_args(arguments)
    event_drops, assignments, output_root = given.event_drops, given.assignments, given.output_root
    spark = build_session("questlog-build")
    size_shuffles(spark, event_drops, assignments)
    checks = run(spark, event_drops, assignments, output_root, given.multiline)
    row_report(Warehouse(spark, output_root)).show(truncate=False)
    checks.show(100, truncate=False)
    return 0 if quality.verdict(checks).first()["all_passed"] else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
