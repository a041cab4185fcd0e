"""Landing layer: delivered rows untouched, with load time and provenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def land(rows: DataFrame) -> DataFrame:
    """Stamp delivered rows with one load time; duplicates and NULLs stay."""
    if "_ingested_at" not in rows.columns:
        rows = rows.withColumn("_ingested_at", F.current_timestamp())
    provenance = ["filename", "_ingested_at", "_source_file"]
    data = [c for c in rows.columns if c not in provenance]
    return rows.select(*data, *provenance)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), one row per table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)
