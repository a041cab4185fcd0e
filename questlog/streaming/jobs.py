"""Incremental twins of the load, the deduplication and the sessions.

A stream of new landing files drives each job (``availableNow``): Spark's
checkpoint remembers the files, a bounded number of them makes one batch, and
each batch becomes a part of a ``BatchTable``, once however often it is tried.
The tables are the state, so nothing is lost however late it comes, and their
parts are merged as they grow, so a batch does not read or list all before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from questlog.operators.bronze import land
from questlog.operators.events import events_clean
from questlog.operators.sessions import merge_spans, sessions_of_spans, spans
from questlog.session import materialise
from questlog.sources.landing_csv import read_event_drops
from questlog.sources.snapshots import BatchTable
from questlog.streaming.seen import BUCKETS, SeenIds

#: Files of one batch; their paths are all that reaches the driver.
FILES_PER_BATCH = 1000

_FILE = StructType().add("path", "string").add("modificationTime", "timestamp")
_FILE = _FILE.add("length", "long").add("content", "binary")


def run_available(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    job: Callable[[DataFrame, int, str], None],
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Give the rows of the files not seen before to ``job(raw, batch, stream)`` and stop.

    ``stream`` names the checkpoint that numbers the batches. Columns are matched by header name, file by file, as in the batch load.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing)
        .where("length > 0")
        .select("path")
    )

    def batch(new: DataFrame, number: int) -> None:
        paths = [r["path"] for r in new.collect()]
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if paths:
            job(land(read_event_drops(new.sparkSession, paths)), number, stream)

    query = (
        files.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_raw(table: str, fan_in: int = 8) -> Callable[[DataFrame, int, str], None]:
    """Job that appends landed rows to a table."""

    def job(raw: DataFrame, batch: int, stream: str) -> None:
        BatchTable(raw.sparkSession, table, fan_in).append(raw, batch, stream)

    return job


def _take_new(
    raw: DataFrame, batch: int, stream: str, table: str, buckets: int, then: Callable[[DataFrame], None]
) -> None:
    """Append the batch's new events to the table, and give them to ``then``.

    Their ids are added last. A batch that is tried again after a crash thus
    finds the same events new, and what it has added already stays as it is.
    """
    spark = raw.sparkSession
    known = SeenIds(spark, f"{table}-ids", buckets)
    if known.table.has(batch, stream):
        return
    clean = materialise(events_clean(raw), "batch-events")
    new = materialise(known.unseen(clean, "event_id"), "new-events")
    BatchTable(spark, table).append(new, batch, stream)
    then(new)
    known.add(new, "event_id", batch, stream)


def append_new_events(table: str, buckets: int = BUCKETS) -> Callable[[DataFrame, int, str], None]:
    """Job that appends the events whose id no earlier batch had.

    One row per id and batch as in ``events_clean``. Ids of earlier batches are
    kept in ``SeenIds`` beside the table, of which a batch opens the buckets
    that may hold its ids. The first delivery is kept whenever it comes, with
    or without a time.
    """

    def job(raw: DataFrame, batch: int, stream: str) -> None:
        _take_new(raw, batch, stream, table, buckets, lambda new: None)

    return job


def append_sessions(
    events_table: str, table: str, buckets: int = BUCKETS
) -> Callable[[DataFrame, int, str], None]:
    """Job that appends new events, and their spans to the state of the sessions.

    A span is what one batch knows of a session: its first and last minute and
    the sums between. Spans of a user that lie within the gap of one another
    are one session, in whatever order they come, so a late event joins or
    bridges sessions without a look at earlier events or spans. Parts are
    merged to longer spans; ``latest_sessions`` merges what is left.
    """

    def job(raw: DataFrame, batch: int, stream: str) -> None:
        state = BatchTable(raw.sparkSession, table)
        _take_new(
            raw, batch, stream, events_table, buckets, lambda new: state.append(spans(new), batch, stream, merge_spans)
        )

    return job


def latest_sessions(spark: SparkSession, table: str) -> DataFrame:
    """The sessions of all events so far."""
    return sessions_of_spans(BatchTable(spark, table).read())
