"""Lines found in many documents dropped, by levelled sorted runs of line hashes."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType

from questlog.llm.blocks import blocks, packed_schema, unpack_texts
from questlog.session import materialise, scratch_dir

#: Bytes of text of a block; a line is one row per block that holds it.
BLOCK_BYTES = 8 << 20
#: Batches in which a table's lines are added, and runs of a level that are merged into one of the next.
BATCHES, FAN_IN = 6, 3

KEY = ["hi", "lo"]


def line_keys(raw: bytes) -> tuple[list[bytes], list[bytes]]:
    """Lines of a text, and their keys: stripped of 09-0D and 20 hex, A-Z lower-cased."""
    lines = raw.split(b"\n")
    return lines, [line.strip().lower() for line in lines]


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (least <= 1 or len(key.decode()) >= least)


def _halves(keys: list[bytes]) -> np.ndarray:
    """128-bit hashes of keys, two signed 64-bit numbers each."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), dtype=">i8").astype(np.int64).reshape(-1, 2)


class LineRuns:
    """How many documents hold each line, in levelled sorted runs of (hi, lo, docs).

    A run has one row per line hash; it is a table bucketed and sorted by hash,
    so a batch merge-joins the runs in place and only the batch is shuffled.
    Lines that the runs show in ``settled``
    documents or more are anti-joined from a batch: they need no more counts.
    What is left is the batch's own run. ``fan_in`` runs of a level are merged
    into one of the next, so a row is rewritten once a level and a batch joins
    fewer than ``fan_in`` runs a level.
    """

    def __init__(self, spark: SparkSession, settled: int, fan_in: int = FAN_IN):
        self.spark, self.settled, self.fan_in = spark, settled, fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self._folders: dict[str, str] = {}

    @property
    def runs(self) -> list[str]:
        """Tables of all runs, the oldest and largest first."""
        return [run for level in reversed(self.levels) for run in level]

    def _write(self, counts: DataFrame) -> str:
        name, folder = f"line_run_{uuid.uuid4().hex}", scratch_dir(self.spark, "line-run")
        # counts are dealt by their hashes already, so a bucket is one task's
        counts.select(*KEY, "docs").write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", folder).saveAsTable(name)
        self._folders[name] = folder
        return name

    def _drop(self, runs: list[str]) -> None:
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for run in runs:
            self.spark.sql(f"DROP TABLE {run}")
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self._folders.pop(run))
            path.getFileSystem(conf).delete(path, True)

    def _merged(self, runs: list[str]) -> DataFrame:
        """Sums of runs, a row per line; each row moves once, as it is rewritten once.

        Files are read as such: Spark 4.1 takes a union of bucketed tables as
        dealt by bucket, but does not read it so, and sums would be wrong.
        """
        rows = self.spark.read.schema("hi long, lo long, docs long").parquet(*[self._folders[run] for run in runs])
        return rows.groupBy(*KEY).agg(F.sum("docs").alias("docs"))

    def unsettled(self, batch: DataFrame) -> DataFrame:
        """Lines of a batch, a row each, that the runs do not already show often enough."""
        before = F.lit(0).cast("long")
        for n, run in enumerate(self.runs):
            earlier = self.spark.table(run).withColumnRenamed("docs", f"before{n}")
            batch = batch.hint("merge").join(earlier.hint("merge"), KEY, "left")
            before = before + F.coalesce(f"before{n}", F.lit(0))
        return batch.where(before < self.settled).select(*KEY, "docs")

    def add(self, lines: DataFrame) -> None:
        """A batch of (hi, lo, docs), where ``docs`` counts documents that no other row of the line counts."""
        batch = lines.groupBy(*KEY).agg(F.sum("docs").alias("docs"))
        run, level = self._write(self.unsettled(batch)), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            full = self.levels[level]
            if len(full) < self.fan_in:
                return
            run = self._write(self._merged(full))
            self._drop(full)
            self.levels[level] = []
            level += 1

    def frequent(self) -> DataFrame:
        """(hi, lo) of the lines in ``settled`` documents or more; the runs are deleted."""
        if not self.runs:
            return self.spark.createDataFrame([], "hi long, lo long")
        found = self._merged(self.runs).where(F.col("docs") >= self.settled).select(*KEY)
        found = materialise(found, "frequent-lines")
        self._drop(self.runs)
        self.levels = []
        return found


def drop_frequent_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    batches: int = BATCHES,
    fan_in: int = FAN_IN,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(``id_col``, n_lines, n_dropped, kept) per row: texts without the lines that many documents hold.

    Lines end at ``\\n``; a line's key is the line stripped of white space (09-0D
    and 20 hex) and with A-Z lower-cased. Keys of at least ``min_chars`` code
    points that ``min_docs`` rows of the table hold lose all their lines; the
    others stay as they are, joined by ``\\n``.

    1. Documents are stored in blocks, each with the hashes of its different
       lines and the number of its documents that hold them.
    2. Batch by batch these go to ``LineRuns``.
    3. Frequent lines go back to the blocks that hold them, which are cut.

    Rows are documents, so repeated rows and rows of one or no id count each. A
    null or empty text is one empty line, which no threshold drops unless
    ``min_chars`` is 0. Lines of one document count once. Other columns are
    not read, so their names cannot clash. An empty table gives no rows.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    id_type = to_arrow_type(kind)
    quoted = {c: F.col("`" + c.replace("`", "``") + "`") for c in (id_col, text_col)}
    source = docs.select(quoted[id_col].alias("id"), quoted[text_col].cast("string").cast("binary").alias("text"))

    def in_blocks(batches_of_rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        batch = TaskContext.get().partitionId() % batches
        press = zstandard.ZstdCompressor(level=3)
        for block, ids, texts in blocks(batches_of_rows, block_bytes):
            held: Counter[bytes] = Counter()
            for raw in texts:
                held.update(set(line_keys(raw)[1]))
            found = [k for k in held if _long_enough(k, min_chars)]
            halves = _halves(found)
            columns = {
                "block": pa.array([block], pa.int64()),
                "ids": pa.array([ids], pa.list_(id_type)), "sizes": pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                "texts": pa.array([press.compress(b"".join(texts))], pa.binary()),
                "his": pa.array([halves[:, 0]], pa.list_(pa.int64())), "los": pa.array([halves[:, 1]], pa.list_(pa.int64())),
                "held": pa.array([[held[k] for k in found]], pa.list_(pa.int64())), "batch": pa.array([batch], pa.int32()),
            }
            yield pa.record_batch(list(columns.values()), list(columns))

    schema = packed_schema(kind)
    for name in ("his", "los", "held"):
        schema.add(name, ArrayType(LongType()))
    schema.add("batch", "integer")
    folder = scratch_dir(spark, "line-blocks")
    source.mapInArrow(in_blocks, schema).write.partitionBy("batch").parquet(folder)
    stored = spark.read.schema(schema).parquet(folder)

    lines = stored.select("batch", "block", F.explode(F.arrays_zip("his", "los", "held")).alias("line")).select(
        "batch", "block", F.col("line.his").alias("hi"), F.col("line.los").alias("lo"), F.col("line.held").alias("docs")
    )
    runs = LineRuns(spark, min_docs, fan_in)
    for row in sorted(stored.select("batch").distinct().collect()):
        runs.add(lines.where(F.col("batch") == row["batch"]))
    gone = lines.select(F.col("block").alias("of"), *KEY).join(runs.frequent(), KEY, "left_semi")

    def cut(block: pa.Table, frequent: pa.Table) -> pa.Table:
        out: dict[str, list] = {"id": [], "n_lines": [], "n_dropped": [], "kept": []}
        pairs = np.stack([frequent.column(c).to_numpy() for c in KEY], axis=1).astype(">i8")
        wanted = {pairs[i].tobytes() for i in range(len(pairs))}
        known: dict[bytes, bool] = {}
        for row in block.to_pylist():
            for own, raw in zip(row["ids"], unpack_texts(row)):
                lines, keys = line_keys(raw)
                for key in keys:
                    if key not in known:
                        known[key] = _long_enough(key, min_chars) and xxhash.xxh3_128_digest(key) in wanted
                kept = [line for line, key in zip(lines, keys) if not known[key]]
                for name, value in zip(out, (own, len(lines), len(lines) - len(kept), b"\n".join(kept).decode())):
                    out[name].append(value)
        types = (id_type, pa.int64(), pa.int64(), pa.string())
        return pa.table({name: pa.array(values, t) for (name, values), t in zip(out.items(), types)})

    texts = stored.select("block", "ids", "sizes", "texts")
    made = f"id {kind.simpleString()}, n_lines long, n_dropped long, kept string"
    return texts.groupBy("block").cogroup(gone.groupBy("of")).applyInArrow(cut, made).withColumnRenamed("id", id_col)
