import numpy as np
import pytest
from pyspark.sql import functions as F

from questlog.llm import topk


def plain(rows, k):
    good = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good.append((i, [int(np.floor(256 * float(x))) for x in v]))
    out, asked = [], {}
    for i, v in good:
        if i % 50 == 0:
            asked[i] = min(v, asked.get(i, v))
    for i, q in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i)
        out += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [1 << 14, 70])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK_VECTORS", block)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.12, 16).round(4).tolist()) for i in range(300)]
    rows += [(300 + i, rows[i % 3][1]) for i in range(60)]  # ties
    rows += [(400, None), (450, [1.0, None]), (500, [float("nan")] * 16), (550, [float("inf")] * 16), (None, rows[0][1]), (600, []), (650, [0.5]), (50, rows[50][1]), (7, rows[7][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS id", "2 AS score", "3 AS block")
    # several blocks in a task, then each in its own
    for partitions, merged in (("4", "true"), ("50", "false")):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merged)
        got = topk.top_k(table, F.col("vec_id") % 50 == 0).collect()
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert sorted(tuple(r) for r in got) == plain(rows, 5)


def test_fewer_candidates_than_k_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(table, F.col("vec_id") % 50 == 0).collect()] == plain(rows, 5)
    assert topk.top_k(table.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert topk.top_k(table.where("vec_id = 0"), F.col("vec_id") % 50 == 0).collect() == []


def test_copies_of_an_id_lie_in_all_blocks(spark):
    rows = spark.createDataFrame([(7, [1, 2])] * 3000 + [(i, [i, 1]) for i in range(1000, 4000)], "id long, vector array<long>")
    sizes = [r["count"] for r in topk.dealt(rows, 6).groupBy("block").count().collect()]
    assert len(sizes) == 6 and sum(sizes) == 6000 and max(sizes) < 1200


def test_queries_stop_on_proof_before_the_last_segment():
    rng = np.random.default_rng(11)
    centres = rng.integers(-60, 60, (20, 64))
    values = centres[rng.integers(0, 20, 8000)] + rng.integers(-4, 5, (8000, 64))
    index = topk.Index(np.arange(8000), values)
    for own in range(0, 8000, 400):
        members, scores = index.search(values[own], own, 5)
        exact = index.values @ values[own]
        exact[own] = -(10**9)
        best = np.lexsort((index.ids, -exact))[:5]
        assert members.tolist() == best.tolist() and scores.tolist() == exact[best].tolist()
    assert index.read < 0.5 * index.held
