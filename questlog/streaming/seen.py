"""Which event ids came before: hash buckets of ids, with a Bloom filter for each bucket of each part."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from questlog.session import materialise
from questlog.sources.snapshots import BatchTable

#: Buckets of a table, for its whole life; a bucket of a part is a folder. A task holds one bucket's filters, 3 bytes
#: for each id of the bucket: 10 billion ids want some thousands.
BUCKETS = 16
#: Bits of a filter for each id, and bits set by one: one id in 25,000 opens a bucket it is not in.
BITS_PER_ID, BITS_OF_ID = 24, 8


def _hash(column: Column) -> Column:
    # a missing id is an id of its own
    return F.xxhash64(F.coalesce(column.isNull().cast("int"), F.lit(0)), column)


def _bits(hashes: np.ndarray, size: int) -> np.ndarray:
    """Bits of a filter of ``size`` bits that ids with these hashes set, a row each."""
    mixed = hashes[:, None] + np.arange(1, BITS_OF_ID + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return ((mixed ^ (mixed >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


class SeenIds:
    """All ids of the batches so far, on shared storage.

    Parts hold (id, hash) in folders by bucket, and beside each part's name a
    table of its Bloom filters. A batch is tested against the filters, one
    task a bucket, and reads only those buckets of those parts that may hold
    any of its ids; old parts are read for late copies only. As parts are
    merged level by level, so are their filters' ids.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.table = BatchTable(spark, folder)
        #: Buckets that the last ``unseen`` opened, as paths.
        self.opened: list[str] = []

    def keyed(self, rows: DataFrame, id_col: str) -> DataFrame:
        """Rows with their id's ``hash`` and ``bucket``."""
        hashed = rows.withColumn("hash", _hash(F.col(id_col)))
        return hashed.withColumn("bucket", F.pmod(F.xxhash64("hash"), F.lit(self.buckets)).cast("int"))

    def _filters(self) -> DataFrame | None:
        """(part, bucket, bits) of all parts; those of new parts are made now, once."""
        made = []
        for part in self.table.parts:
            name = f"filter-{part['folder']}"
            if "_SUCCESS" not in self.table.pointer.files.names(name):
                self._make_filter(part, f"{self.table.folder}/{name}")
            made.append(f"{self.table.folder}/{name}")
        live = {f"filter-{p['folder']}" for p in self.table.parts}
        for name in self.table.pointer.files.names():
            if name.startswith("filter-") and name not in live:
                self.table.pointer.files.delete(name)
        return self.spark.read.schema("part string, bucket int, bits binary").parquet(*made) if made else None

    def _make_filter(self, part: dict, path: str) -> None:
        def build(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = np.concatenate([b.column("hash").to_numpy() for b in batches]).view(np.uint64)
            size = 8 * max(8, -(-len(hashes) * BITS_PER_ID // 8))
            held = np.zeros(size, dtype=bool)
            held[_bits(hashes, size).reshape(-1)] = True
            yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(held).tobytes()], pa.binary())], ["bucket", "bits"])

        ids = self.table.read([part]).select("bucket", "hash")
        filters = ids.groupBy("bucket").applyInArrow(build, "bucket int, bits binary")
        filters.select(F.lit(part["folder"]).alias("part"), "bucket", "bits").write.mode("overwrite").parquet(path)

    def unseen(self, rows: DataFrame, id_col: str) -> DataFrame:
        """The rows, one per id and stored, whose id no batch had."""
        self.opened = []
        filters = self._filters()
        if filters is None:
            return rows

        def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bucket, known = None, []
            for batch in batches:
                buckets = batch.column("bucket").to_numpy()
                cuts = np.append(np.nonzero(np.diff(buckets))[0] + 1, len(buckets))
                start = 0
                for stop in cuts.tolist():
                    run = batch.slice(start, stop - start)
                    start = stop
                    if not run.num_rows:
                        continue
                    if run.column("bucket")[0].as_py() != bucket:
                        bucket, known = run.column("bucket")[0].as_py(), []
                    parts = run.column("part")
                    filters_here = run.num_rows - parts.null_count  # filters come first in a bucket
                    for n in range(filters_here):
                        raw = np.frombuffer(run.column("bits")[n].as_py(), dtype=np.uint8)
                        known.append((parts[n].as_py(), raw))
                    hashes = run.column("hash").slice(filters_here).to_numpy().view(np.uint64)
                    for part, raw in known:
                        at = _bits(hashes, 8 * len(raw))
                        maybe = ((raw[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
                        if maybe.any():
                            found = hashes[maybe].view(np.int64)
                            yield pa.record_batch(
                                [pa.array([part] * len(found)), pa.array(np.full(len(found), bucket, dtype=np.int32)), pa.array(found)],
                                ["part", "bucket", "hash"],
                            )

        keyed = self.keyed(rows, id_col)
        ids = keyed.select(F.lit(None).cast("string").alias("part"), "bucket", F.lit(None).cast("binary").alias("bits"), "hash")
        both = filters.withColumn("hash", F.lit(0).cast("long")).unionByName(ids)
        both = both.repartition("bucket").sortWithinPartitions("bucket", F.col("part").asc_nulls_last())
        maybe = materialise(both.mapInArrow(test, "part string, bucket int, hash long"), "maybe-seen")
        # a row per part and bucket at most
        hits = [tuple(r) for r in maybe.select("part", "bucket").distinct().collect()]
        if not hits:
            return rows
        self.opened = [f"{self.table.folder}/{part}/bucket={bucket}" for part, bucket in sorted(hits)]
        earlier = self.spark.read.schema("id string, hash long").parquet(*self.opened)
        seen = earlier.join(maybe.select("hash").distinct(), "hash", "left_semi").select(F.col("id").alias("seen"), F.lit(1).alias("was"))
        return rows.join(seen, F.col(id_col).eqNullSafe(F.col("seen")), "left_anti")

    def add(self, rows: DataFrame, id_col: str, batch: int, stream: str) -> None:
        """Keep a batch's new ids."""
        ids = self.keyed(rows, id_col).select(F.col(id_col).alias("id"), "hash", "bucket")
        self.table.append(ids.repartition("bucket"), batch, stream, partition_by=("bucket",))
