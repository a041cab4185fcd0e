import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from questlog.operators import engagement, ranking

SCHEMA = "v bigint, u bigint, a string"


def _expected(rows, tiles):
    """Tiles and ranks by position in the sorted list."""
    ordered = sorted(
        rows, key=lambda r: (r[0], r[1] is None, r[1] or 0, r[2] is None, r[2] or "")
    )
    size, extra = divmod(len(rows), tiles)
    out = Counter()
    start = 0
    for tile in range(1, tiles + 1):
        end = start + size + (tile <= extra)
        for row in ordered[start:end]:
            out[(*row, 1 + sum(r[0] > row[0] for r in rows), tile)] += 1
        start = end
    return out


def _tiled(spark, rows, tiles=4):
    df = spark.createDataFrame(rows, SCHEMA)
    out = ranking.with_tiles(df, "v", "u", tiles).select("v", "u", "a", "rank", "tile")
    return Counter(tuple(r) for r in out.collect())


@pytest.mark.parametrize(
    "rows",
    [
        [(i, i, "x") for i in range(10)],
        [(i, i, "x") for i in range(3)],
        [(1, 1, "x")] * 11,
        [(1, 1, "x")] * 7 + [(1, 2, "y")] * 3 + [(-5, None, None)] * 2,
        [(2**62, -3, "z"), (-(2**62), 7, "q"), (-(2**62), 7, "q"), (-1, 0, "q")],
    ],
)
def test_small_cases(spark, rows):
    assert _tiled(spark, rows) == _expected(rows, 4)


@pytest.mark.parametrize("seed,tiles", [(1, 4), (2, 3), (3, 7)])
def test_random_cases(spark, seed, tiles, monkeypatch):
    monkeypatch.setattr(ranking, "_EXPAND_STEP", 5)
    rnd = random.Random(seed)
    rows = [
        (
            rnd.choice([0, 0, 0, 1, 2, 2**30 + rnd.randrange(5), -(2**50)]),
            rnd.randrange(20) * 2 ** rnd.choice([0, 20, 45]),
            rnd.choice("ab"),
        )
        for _ in range(rnd.randrange(150, 400))
    ]
    assert _tiled(spark, rows, tiles) == _expected(rows, tiles)


def test_running_counts(spark):
    df = spark.createDataFrame(
        [(1, 5), (None, 7), (-3, 2), (2**40, 1), (2**21, 4)], "v bigint, n bigint"
    )
    out = {r["v"]: (r["before"], r["total"]) for r in ranking.running_counts(df, "v", "n").collect()}
    assert out == {
        -3: (0, 19), 1: (2, 19), 2**21: (7, 19), 2**40: (11, 19), None: (12, 19),
    }


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_leading_digits_meet_in_one_task(spark):
    users = spark.createDataFrame([(1, 3)], "userid bigint, v bigint")
    histogram = users.groupBy("v").agg(F.count("*").alias("n"))
    lines = _physical(ranking.running_counts(histogram, "v", "n")).splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert single
    for i in single:
        assert "HashAggregate(keys=[_high" in lines[i + 1]


def test_ranked_rows_are_not_shuffled_by_value(spark):
    users = spark.createDataFrame(
        [(1, "a", "ios", "US", 3)],
        "userid bigint, ab_version string, platform string, country string, "
        "event_derived_rounds bigint",
    )
    percentile, top = engagement.engagement_percentile(users), engagement.top_players(users)
    assert "BroadcastHashJoin" in _physical(percentile)
    assert "Exchange hashpartitioning" not in _physical(percentile)
    # top players: counts of at most as many values as places are shuffled, no users
    lines = _physical(top).splitlines()
    shuffles = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert "BroadcastHashJoin" in _physical(top) and "SortMergeJoin" not in _physical(top)
    assert shuffles and all("partial_count" in lines[i + 1] for i in shuffles)


def test_no_single_task(spark):
    users = spark.createDataFrame([(i % 3, i, "x") for i in range(30)], SCHEMA)
    lines = _physical(ranking.with_tiles(users, "v", "u", 4)).splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "HashAggregate(keys=[v#" in lines[i + 1] and "_high" in lines[i + 1]


def test_large_histograms_join_by_shuffle(spark):
    rows = [(i % 50, i, "x") for i in range(500)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _tiled(spark, rows) == _expected(rows, 4)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
