import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from questlog.functions import (
    exact_sum,
    lenient_double,
    lenient_int,
    minute_index,
    ratio,
    round_half_away,
    second_diff,
    strict,
)
from tests.fixtures import ts


def _map(spark, values, type_name, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {type_name}")
    rows = df.select("i", expr(F.col("c")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


def test_lenient_int(spark):
    cases = {
        "3": 3, "3.0": 3, "3.5": 4, "2.5": 3, "-2.5": -3, "1e2": 100, " 7 ": 7,
        "": None, "abc": None, "3000000000": None, "NaN": None, "inf": None,
        "1d": None, "2147483647.4": 2147483647, "2147483647.5": None, None: None,
        "0.49999999999999994": 0, "0x10": None,
    }
    assert _map(spark, list(cases), "string", lenient_int) == list(cases.values())


def test_lenient_double(spark):
    cases = {"4.99": 4.99, "abc": None, "": None, "1d": None, "inf": float("inf"), "0x1p3": None}
    assert _map(spark, list(cases), "string", lenient_double) == list(cases.values())


def test_strict_reads_and_fails(spark):
    assert _map(spark, ["116", "116.0", None], "string", lambda c: strict(c, "bigint")) == [
        116, 116, None,
    ]
    flags = ["True", "FALSE", "1", "t"]
    assert _map(spark, flags, "string", lambda c: strict(c, "boolean")) == [
        True, False, True, True,
    ]
    for bad, kind in [
        ("x", "bigint"), ("bad", "timestamp_ntz"), ("maybe", "boolean"), ("2024", "timestamp_ntz"),
        ("2024-01", "timestamp_ntz"), (" true ", "boolean"),
    ]:
        with pytest.raises(PySparkException, match="cannot read"):
            _map(spark, [bad], "string", lambda c, k=kind: strict(c, k))


def test_strict_fails_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException, match="cannot read"):
            _map(spark, ["x"], "string", lambda c: strict(c, "bigint"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_boundary_differences(spark, zone):
    pairs = [
        ("2024-01-01 10:00:59", "2024-01-01 10:31:00", 31, 1801),
        ("2024-01-01 10:00:00", "2024-01-01 10:30:59", 30, 1859),
        ("2024-01-01 00:00:00.9", "2024-01-01 00:00:01.1", 0, 1),
        ("2024-03-10 01:59:00", "2024-03-10 03:00:00", 61, 3660),
        ("1969-12-31 23:59:30", "1970-01-01 00:00:00", 1, 30),
    ]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(
            [(ts(a), ts(b)) for a, b, _, _ in pairs], "a timestamp_ntz, b timestamp_ntz"
        )
        minutes = minute_index(F.col("b")) - minute_index(F.col("a"))
        rows = df.select(minutes, second_diff(F.col("a"), F.col("b"))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [tuple(r) for r in rows] == [(m, s) for _, _, m, s in pairs]


def test_rounding(spark):
    assert _map(spark, [1.005, 2.675, -0.125], "double", lambda c: round_half_away(c, 2)) == [
        1.0, 2.68, -0.13,
    ]
    assert _map(spark, [0.00015], "double", lambda c: round_half_away(c, 4)) == [0.0001]


def test_ratio_by_zero_is_null(spark):
    assert _map(spark, [2, 0], "bigint", lambda c: ratio(F.lit(1), c)) == [0.5, None]


def _sum(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c double").repartition(3)
    return df.agg(exact_sum(F.col("c"))).first()[0]


def test_exact_sum(spark):
    assert _sum(spark, [0.1] * 10) == 1.0
    assert _sum(spark, [0.1, 0.2, None]) == 0.3
    assert _sum(spark, [None, None]) is None
    assert _sum(spark, [1.0, float("inf")]) == float("inf")
    nan = _sum(spark, [1.0, float("nan")])
    assert nan != nan
