"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app_name: str = "questlog",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Session with the settings the jobs rely on.

    On a cluster leave ``master`` to spark-submit and set
    ``shuffle_partitions`` for the biggest shuffle (about input bytes / 200 MB);
    adaptive execution merges the small ones.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config(
            "spark.sql.shuffle.partitions", str(shuffle_partitions)
        )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Scratch folders made by this driver, in order.
_made: list[str] = []


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    A machine-local folder is taken only for local masters, where driver and
    executors are one process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="questlog-"))
        shared = spark.sparkContext.getCheckpointDir()
    _made.append(f"{shared.rstrip('/')}/questlog/{purpose}-{uuid.uuid4().hex}")
    return _made[-1]


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the scratch folders made inside, once their tables have been used."""
    first = len(_made)
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in _made[first:]:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
        del _made[first:]


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared scratch folder and read back.

    Cuts the lineage, and the planner then knows the size: it broadcasts the
    table only if that is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    folder = scratch_dir(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
