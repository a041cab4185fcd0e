"""Joins on a key that holds a third of the rows are split by adaptive execution."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from questlog.operators import ranking
from questlog.operators.sessions import sessions
from questlog.operators.users import users_dim
from tests.fixtures import clean_events

# Thresholds for test-sized data, and no broadcast.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16384",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16384",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "8",
}


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _final_plan(df):
    """Plan after the run; counting all columns keeps them in the join."""
    hashed = df.agg(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")))
    hashed.collect()
    return hashed._jdf.queryExecution().executedPlan().toString()


def test_user_id_on_a_third_of_the_assignments(spark, tmp_path):
    path = str(tmp_path / "assignments")
    key = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id"))
    spark.range(0, 60000, 1, 8).select(
        key.cast("string").alias("userid"),
        F.md5(F.col("id").cast("string")).alias("version"),
        F.lit("3").alias("sum_gamerounds"),
        F.lit("True").alias("retention_1"),
        F.lit("False").alias("retention_7"),
    ).write.parquet(path)
    times = [{"event_time": "2024-01-01 10:00:00", "userid": u} for u in (1, 2, 4)]
    events = clean_events(spark, times)
    with settings(spark, SMALL):
        dim = users_dim(spark.read.parquet(path), events, sessions(events))
        plan = _final_plan(dim)
        assert dim.count() == 60000
    assert "skew=true" in plan


def test_value_on_a_third_of_the_ranked_rows(spark, tmp_path):
    path = str(tmp_path / "users")
    value = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    spark.range(0, 60000, 1, 8).select(
        value.cast("bigint").alias("v"),
        F.col("id").alias("u"),
        F.md5(F.col("id").cast("string")).alias("a"),
    ).write.parquet(path)
    users = spark.read.parquet(path)
    with settings(spark, SMALL):
        tiled = ranking.with_tiles(users, "v", "u", 4)
        plan = _final_plan(tiled)
        sizes = tiled.groupBy("tile").count().orderBy("tile").collect()
    assert "skew=true" in plan
    assert [r["count"] for r in sizes] == [15000] * 4
