import random
from collections import Counter

import pytest

from questlog.llm import substrings
from questlog.llm.substrings import remove_repeats


def plain(rows, window):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for (row, _), own in zip(rows, texts):
        gone = [False] * len(own)
        for i in range(len(own) - window + 1):
            if seen[own[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((row, len(own), sum(gone), spans, bytes(b for b, g in zip(own, gone) if not g)))
    return sorted(out, key=str)


def seen(spark, rows, tmp_path, window, **kw):
    path = str(tmp_path / f"t{random.random()}")
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS id", "3 AS one").write.parquet(path)
    found = remove_repeats(spark.read.parquet(path), window, **kw).collect()
    return sorted(((*r[:4], bytes(r[4])) for r in found), key=str)


@pytest.mark.parametrize("block_bytes, passages", [(9000, 8192), (2 << 20, 8192), (9000, 2)])
def test_sample_documents(spark, tmp_path, monkeypatch, block_bytes, passages):
    monkeypatch.setattr(substrings, "SHARD_PASSAGES", passages)
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(130).collect()]
    base, long = rows[2][1], " ".join(f"w{i % 977}é" for i in range(3000))
    rows += [(900, None), (901, ""), (902, "x" * 399), (None, base), (903, "x" * 2000), (904, "ab" * 300), (905, long), (905, long)]
    # a passage between different texts, cut at different places
    rows += [(910 + i, f"{i} é" * (i + 1) + long[100 + 3 * i : 700 + 5 * i] + f" {i}" * i) for i in range(12)]
    assert seen(spark, rows, tmp_path, 400, block_bytes=block_bytes) == plain(rows, 400)


@pytest.mark.parametrize("window, passages", [(1, 8192), (3, 8192), (30, 8192), (30, 1)])
def test_few_letters_repeat_in_many_ways(spark, tmp_path, monkeypatch, window, passages):
    monkeypatch.setattr(substrings, "SHARD_PASSAGES", passages)
    rng = random.Random(window)
    pool = ["".join(rng.choices("abé", k=25)) for _ in range(6)]
    rows = [(i, "".join(rng.choices(pool, k=rng.randrange(9))) + "".join(rng.choices("ab", k=9))) for i in range(40)]
    assert seen(spark, rows, tmp_path, window, block_bytes=700) == plain(rows, window)


def test_no_rows(spark, tmp_path):
    assert seen(spark, [], tmp_path, 400) == []


@pytest.mark.parametrize("window", [1024, 2048])
def test_hashes_of_long_windows_tell_sequences_and_their_complements(window):
    # sums over such sequences vanish modulo 2**64 for every base
    signs = [i.bit_count() % 2 for i in range(window)]
    one, two = (bytes(97 + (s ^ flip) for s in signs) for flip in (0, 1))
    first = substrings._window_hashes(one, window)
    assert all(a[0] != b[0] for a, b in zip(first, substrings._window_hashes(two, window)))
    shifted = substrings._window_hashes(b"some words before" + one + b"and after", window)
    assert all(a[0] == b[17] for a, b in zip(first, shifted))
