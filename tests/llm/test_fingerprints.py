import hashlib
import re
from functools import reduce
from operator import xor

import pytest
import xxhash

from questlog.llm import fingerprints


def digests(text):
    parts = (p.strip(" ") for p in re.findall(r"[^\n.!?]{1,160}[.!?]*|[.!?]+", text or ""))
    return {xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts if p}


def sketch(text):
    own = [[d for d in digests(text) if d >> 3 * (i // 8) & 7 == i % 8] for i in range(24)]
    return "-".join(f"{len(c)}.{reduce(xor, c, 0):x}" for c in own)


def likeness(a, b):
    a, b = digests(a), digests(b)
    return 1.0 if not a | b else 1 - len(a ^ b) / (len(a) + len(b))


def plain(rows):
    order = sorted(((i is not None, i or 0, t or "") for i, t in rows), reverse=True)
    out = []
    for at, (known, i, text) in enumerate(order):
        follower = order[(at + 1) % len(order)][2]
        half = len(text) // 2
        edited = text[: len(text) - half] + follower[:half]
        near = [round(likeness(text, x), 12) for x in (edited, follower)]
        out.append((i if known else None, len(text), hashlib.sha256(edited.encode()).hexdigest(), sketch(text), sketch(edited), *near))
    return sorted(out, key=str)


def seen(df):
    return sorted(((*r[:5], round(r[5], 12), round(r[6], 12)) for r in df.collect()), key=str)


@pytest.mark.parametrize("partitions", ["4", "40"])
def test_matches_sets_of_digests(spark, partitions):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(120).collect()]
    long = "\n".join(f"line {i} of many" for i in range(900))
    rows += [(500, None), (501, ""), (502, " \n. "), (None, "no id"), (None, None), (503, long), (503, long), (504, long + "\nand one"), (505, "é\U0001f600" * 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_chars", "'x' AS digests", "2 AS id", "3 AS range")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert seen(fingerprints.edited_likeness(docs)) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    prints = {r[0]: r[1] for r in fingerprints.fingerprints(docs).collect()}
    assert prints[504] == sketch(long + "\nand one") and prints[500] == prints[501] == sketch("")


@pytest.mark.parametrize("each, large", [(64, (5, 15)), (300, (2, 15)), (3, (5, 15))])
def test_larger_layouts(spark, monkeypatch, each, large):
    """Sketches that are too full are made anew, and at last the lists are compared."""
    monkeypatch.setattr(fingerprints, "DIGESTS_EACH", each)
    monkeypatch.setattr(fingerprints, "LARGE", large)
    rows = [(i, "\n".join(f"{i % 3} {j}" for j in range(10 * i))) for i in range(8)]
    assert seen(fingerprints.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string"))) == plain(rows)


def test_one_row_and_none(spark):
    docs = spark.createDataFrame([(1, "a. b. c.")], "doc_id long, text string")
    assert seen(fingerprints.edited_likeness(docs)) == plain([(1, "a. b. c.")])
    assert fingerprints.edited_likeness(docs.limit(0)).collect() == []
