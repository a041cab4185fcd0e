"""Maps the generic ``events`` / ``customer`` tables to raw telemetry and assignments.

Row-wise rules only (no shuffle), so the event mapping also runs on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from questlog.sources.landing_csv import EVENT_COLUMNS

# The domains of the telemetry columns and the delivery lags.
COUNTRIES = ["US", "GB", "CA", "AU", "DE", "FR", "BR", "IN", "JP", "KR", "MX", "SE"]
APP_VERSIONS = ["1.44.0", "1.44.1", "1.45.0", "1.46.0", "1.46.2"]
PRODUCTS = [
    "gems_small",
    "gems_medium",
    "gems_large",
    "gems_mega",
    "gold_pass",
    "unlimited_lives_bundle",
]
LAG_HOURS = [0, 0, 0, 0, 0, 0, 0, 1, 2, 6, 26]
RETRY_LAG_HOURS = 26
INGESTED_AT = "2024-03-01 00:00:00"
# Added to the ids of users that no customer has.
UNASSIGNED = 1_000_000_000


def _pick(values: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _seconds(count: Column) -> Column:
    zero = F.lit(0)
    return F.make_dt_interval(zero, zero, zero, count.cast("decimal(18,6)"))


def events_as_telemetry(events: DataFrame) -> DataFrame:
    """Raw telemetry rows as delivered, every 67th event twice.

    Every 401st event comes without a time, and one user in 31 is not among the
    customers, so the paths for both have rows.
    """
    event_id, user_id, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    name = (
        F.when(kind == "view", "app_open")
        .when(kind == "click", "level_progress")
        .when((kind == "purchase") & (user_id % 3 == 0), "purchase")
        .otherwise("app_close")
    )
    second_of_day = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    shifted = F.floor(second_of_day / 24) + F.when(user_id % 3 == 0, 84600).otherwise(0)
    client_time = F.col("ts").cast("date").cast("timestamp_ntz") + _seconds(shifted)
    lag = _pick(LAG_HOURS, event_id % 11)
    lags = F.when(
        event_id % 67 == 0, F.array(lag, F.lit(RETRY_LAG_HOURS))
    ).otherwise(F.array(lag))
    is_purchase = F.col("event_name") == "purchase"
    played = (F.col("event_name") == "level_progress") & (user_id % 25 != 24)

    delivered = events.select(
        "event_id",
        "user_id",
        "ts",
        "value",
        name.alias("event_name"),
        client_time.alias("client_time"),
        F.explode(lags).alias("lag_hours"),
    )
    landing_time = F.col("client_time") + _seconds(F.col("lag_hours") * 3600)
    source_file = F.concat(
        F.lit("events_"), landing_time.cast("date").cast("string"), F.lit(".csv")
    )
    version_index = (F.floor(F.dayofmonth("ts") / 7) + user_id) % 5
    columns = {
        "event_id": event_id.cast("string"),
        "event_name": F.col("event_name"),
        "client_event_time": F.when(event_id % 401 != 0, F.col("client_time").cast("string")),
        "userid": F.when(user_id % 31 == 7, user_id + UNASSIGNED).otherwise(user_id).cast("string"),
        "platform": F.when(event_id % 200 == 0, None)
        .when(user_id % 5 < 2, "ios")
        .otherwise("android"),
        "country": F.when(event_id % 211 != 0, _pick(COUNTRIES, user_id % 12)),
        "app_version": F.when(event_id % 97 != 0, _pick(APP_VERSIONS, version_index)),
        "device_id": F.concat(F.lit("dev-"), user_id.cast("string")),
        "rounds_completed": F.when(
            played,
            F.concat(F.floor(F.col("value") / 10).cast("string"), F.lit(".0")),
        ),
        "revenue_usd": F.when(is_purchase, F.col("value").cast("string")),
        "product_id": F.when(is_purchase, _pick(PRODUCTS, event_id % 6)),
        "currency": F.when(is_purchase, F.lit("USD")),
    }
    return delivered.select(
        *[columns[c].alias(c) for c in EVENT_COLUMNS],
        F.concat(F.lit("bronze_landing/"), source_file).alias("filename"),
        source_file.alias("_source_file"),
        F.lit(INGESTED_AT).cast("timestamp").alias("_ingested_at"),
    )


def customers_as_assignments(customer: DataFrame) -> DataFrame:
    """Experiment export: every customer, one in 97 delivered twice."""
    key = F.col("c_custkey")
    copies = F.when(key % 97 == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return customer.select("c_custkey", F.explode(copies)).select(
        key.cast("string").alias("userid"),
        F.when(key % 2 == 0, "gate_30").otherwise("gate_40").alias("version"),
        (key % 50).cast("string").alias("sum_gamerounds"),
        (key % 20 < 9).cast("string").alias("retention_1"),
        (key % 20 < 4).cast("string").alias("retention_7"),
        F.lit("raw/assignments.csv").alias("filename"),
        F.lit("assignments.csv").alias("_source_file"),
        F.lit(INGESTED_AT).cast("timestamp").alias("_ingested_at"),
    )


def raw_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_telemetry(spark.read.parquet(f"{sf_dir}/events.parquet"))


def raw_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers_as_assignments(spark.read.parquet(f"{sf_dir}/customer.parquet"))
