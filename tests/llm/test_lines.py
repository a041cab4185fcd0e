import random
import re

import pytest
from pyspark.sql import functions as F

from questlog.llm.lines import LineRuns, drop_frequent_lines


def plain(rows, min_docs, min_chars=1):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line))

    held = {}
    for _, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            held[k] = held.get(k, 0) + 1
    out = []
    for row, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if len(key(line)) < min_chars or held[key(line)] < min_docs]
        out.append((row, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def seen(spark, rows, tmp_path, files=5, **kw):
    path = str(tmp_path / f"t{random.random()}")
    df = spark.createDataFrame(rows, "`own id` long, text string").repartition(files)
    df.selectExpr("*", "1 AS block", "2 AS id", "3 AS hi", "4 AS `a.b`", "5 AS kept", "6 AS batch").write.parquet(path)
    got = drop_frequent_lines(spark.read.parquet(path), id_col="own id", **kw)
    assert got.columns == ["own id", "n_lines", "n_dropped", "kept"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def sample(n):
    rng = random.Random(n)
    common = ["Menu", " menu\t", "MENU\r", "\x0b", "", "Éa", "éa", "é", "x" * 70, "a\xa0", "a", "\x1ca"]
    rows = [(i, "\n".join(rng.choices([*common, *(f"line {j}" for j in range(n))], k=rng.randrange(12)))) for i in range(n)]
    return rows + [(None, None), (None, "menu"), (3, ""), (3, "menu\nmenu\n"), (7, "\n"), (8, "\n".join(["menu", "own"] * 20000))]


@pytest.mark.parametrize(("batches", "fan_in"), [(1, 2), (3, 2), (8, 3)])
def test_equals_brute_force(spark, tmp_path, batches, fan_in):
    rows = sample(120)
    for min_docs, min_chars in ((10, 1), (2, 2), (3, 0)):
        got = seen(spark, rows, tmp_path, min_docs=min_docs, min_chars=min_chars, batches=batches, fan_in=fan_in, block_bytes=400)
        assert got == plain(rows, min_docs, min_chars)


def test_same_rows_in_any_order_and_no_rows(spark, tmp_path):
    rows = [(5, "a\nb")] * 9
    assert seen(spark, rows, tmp_path, min_docs=10) == plain(rows, 10)
    assert seen(spark, rows + [(6, "A ")], tmp_path, min_docs=10) == plain(rows + [(6, "A ")], 10)
    assert seen(spark, [], tmp_path) == []


def test_runs_merge_level_by_level_and_forget_what_is_settled(spark):
    runs = LineRuns(spark, settled=3, fan_in=2)
    levels = []
    for docs in ([(1, 2), (2, 1)], [(1, 1), (3, 1)], [(1, 5), (2, 1)], [(2, 4), (1, 9)], [(2, 1), (1, 1), (4, 3)]):
        runs.add(spark.createDataFrame([(h, -h, d) for h, d in docs], "hi long, lo long, docs long"))
        levels.append([len(level) for level in runs.levels])
    assert levels == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1]]
    # line 1 was settled after two batches, line 2 after four: no later run holds them
    oldest, newest = ({r["hi"]: r["docs"] for r in spark.table(t).collect()} for t in runs.runs)
    assert oldest == {1: 3, 2: 6, 3: 1} and newest == {4: 3}
    assert sorted(r["hi"] for r in runs.frequent().collect()) == [1, 2, 4]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run")]


def test_batches_join_runs_in_place(spark):
    """Only the batch is shuffled: runs are read by bucket."""
    runs = LineRuns(spark, settled=3, fan_in=3)
    for _ in range(2):
        runs.add(spark.range(500).select(F.col("id").alias("hi"), F.col("id").alias("lo"), F.lit(1).cast("long").alias("docs")))
    batch = spark.range(900).selectExpr("id AS hi", "id AS lo", "1L AS docs").groupBy("hi", "lo").agg(F.sum("docs").alias("docs"))
    plan = runs.unsettled(batch)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") == 1
    runs.frequent()
