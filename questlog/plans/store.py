"""Input tables of a query: raw rows as views, upstream tables written once.

A mart reads cleaned events, sessions and users. Each of these is written to
the shared scratch folder when first needed and read back by every later query
on the same input files, as the marts of a built warehouse do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from questlog.operators import events, monetization, sessions, users
from questlog.session import scratch_dir
from questlog.sources import sample_tables
from questlog.sources.warehouse import Warehouse

_warehouses: dict[str, tuple[Warehouse, set[str]]] = {}


def _snapshot(spark: SparkSession, sf_dir: str) -> str:
    """Identity of the input files as they are now; reads the file listing only."""
    files = spark.read.format("binaryFile").load(
        [f"{sf_dir}/events.parquet", f"{sf_dir}/customer.parquet"]
    )
    listing = files.agg(
        F.count("*"), F.sum("length"), F.max("modificationTime").cast("string")
    ).first()
    key = repr((spark.sparkContext.applicationId, sf_dir, tuple(listing)))
    return hashlib.sha256(key.encode()).hexdigest()


class Store:
    """Tables derived from the sample tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, fresh: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        key = _snapshot(spark, sf_dir)
        if fresh or key not in _warehouses:
            folder = scratch_dir(spark, "silver")
            _warehouses[key] = (Warehouse(spark, folder), set())
        self._warehouse, self._written = _warehouses[key]

    def _once(self, table: str, build: Callable[[], DataFrame]) -> DataFrame:
        if table not in self._written:
            self._warehouse.write(table, build())
            self._written.add(table)
        return self._warehouse.read(table)

    @property
    def counts(self) -> dict[str, int]:
        """Rows of the written tables, by their argument of ``quality_checks``."""
        names = {"events": "silver.events_clean", "users": "silver.users_dim"}
        return {name: self._warehouse.rows(t) for name, t in names.items() if t in self._written}

    @property
    def raw_events(self) -> DataFrame:
        return sample_tables.raw_telemetry(self.spark, self.sf_dir)

    @property
    def raw_assignments(self) -> DataFrame:
        return sample_tables.raw_assignments(self.spark, self.sf_dir)

    @property
    def events_clean(self) -> DataFrame:
        return self._once(
            "silver.events_clean", lambda: events.events_clean(self.raw_events)
        )

    @property
    def sessions(self) -> DataFrame:
        return self._once(
            "silver.sessions", lambda: sessions.sessions(self.events_clean)
        )

    @property
    def users_dim(self) -> DataFrame:
        return self._once(
            "silver.users_dim",
            lambda: users.users_dim(
                self.raw_assignments, self.events_clean, self.sessions
            ),
        )

    @property
    def monetization_summary(self) -> DataFrame:
        return self._once(
            "gold.mart_monetization_summary",
            lambda: monetization.monetization_summary(self.users_dim, self.sessions),
        )
