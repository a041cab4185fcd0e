"""Layered tables on shared storage: full refresh, re-read, publish to SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from questlog.sources.snapshots import Pointer

# Layers and their tables in build order.
TABLES = {
    "bronze": ["raw_events", "raw_experiment_assignments"],
    "silver": ["events_clean", "sessions", "users_dim"],
    "gold": [
        "mart_retention_curve",
        "mart_retention_validation",
        "mart_monetization_summary",
        "mart_ltv_curve",
        "mart_engagement_segments",
        "mart_engagement_segment_summary",
        "mart_ab_test_readout",
        "data_quality_checks",
    ],
}


class Warehouse:
    """Tables ``layer.name`` as Parquet folders ``root/layer/name/<version>``.

    ``write`` makes a new version, which this object reads from then on.
    ``commit`` lets everyone read all new versions in one step: until then, and
    if the build fails, others read the whole warehouse of the last commit.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._pointer = Pointer(spark, self.root)
        self._number, self._committed = self._pointer.read()
        self._new: dict[str, dict] = {}

    def _entry(self, table: str) -> dict:
        entry = self._new.get(table) or self._committed.get(table)
        if not entry:
            raise FileNotFoundError(f"no table {table} under {self.root}")
        return entry

    def path(self, table: str) -> str:
        """Folder of the table's version that this object reads."""
        return f"{self.root}/{self._entry(table)['folder']}"

    def write(
        self, table: str, df: DataFrame, partition_by: str | None = None
    ) -> DataFrame:
        """A new version of the table, returned as read back, cut from its lineage.

        ``partition_by`` costs one shuffle of the rows; adaptive execution
        splits a partition value that holds most of them.
        """
        folder = f"{table.replace('.', '/')}/{uuid.uuid4().hex}"
        if partition_by:
            df = df.hint("rebalance", partition_by)
        # counted in the stage that writes, whose tasks count once however often they are tried
        written = Observation()
        writer = df.observe(written, F.count("*").alias("rows")).write
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(f"{self.root}/{folder}")
        rows = written.get.get("rows", 0)
        self._new[table] = {"folder": folder, "schema": df.schema.jsonValue(), "rows": rows}
        return self.read(table)

    def rows(self, table: str) -> int:
        """Number of rows, as counted when they were written."""
        return self._entry(table)["rows"]

    def read(self, table: str) -> DataFrame:
        """The table as last written here, or as committed; the schema spares reading file footers."""
        schema = StructType.fromJson(self._entry(table)["schema"])
        return self.spark.read.schema(schema).parquet(self.path(table))

    def commit(self) -> None:
        """Show the new versions to all readers, and delete those of the last but one commit.

        What failed builds have left goes too. Fails if another build has
        committed since this object was made.
        """
        content = self._committed | self._new
        self._number = self._pointer.commit(self._number, content)
        self._committed, self._new = content, {}
        tables = [t.replace(".", "/") for t in content]
        found = [f"{t}/{v}" for t in tables for v in self._pointer.files.names(t)]
        self._pointer.clean(lambda c: [e["folder"] for e in c.values()], found)

    def publish(self) -> None:
        """Register the committed tables, so ``SELECT * FROM gold.mart_...`` works.

        They are views, which the catalog replaces in one step.
        """
        for table, entry in self._committed.items():
            layer, name = table.split(".")
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{self.root}/{layer}'")
            known = self.spark.catalog.tableExists(table) and self.spark.catalog.getTable(table)
            if known and known.tableType != "VIEW":
                self.spark.sql(f"DROP TABLE {table}")
            schema = StructType.fromJson(entry["schema"])
            columns = ", ".join(f"`{c}`" for c in schema.names)
            rows = f"SELECT {columns} FROM parquet.`{self.root}/{entry['folder']}`"
            if not self._pointer.files.names(entry["folder"])[1:]:  # no file but the marker: an empty partitioned table
                nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
                rows = f"SELECT {nulls} WHERE false"
            self.spark.sql(f"CREATE OR REPLACE VIEW {layer}.{name} AS {rows}")
