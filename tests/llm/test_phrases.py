import random
import re
from collections import Counter

import numpy as np
import pytest

from questlog.llm.phrases import _among, remove_repeats


def plain(rows, window):
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (row, _), own in zip(rows, words):
        gone = set()
        for i in range(len(own) - window + 1):
            if seen[tuple(own[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((row, len(own), len(gone), b" ".join(w for i, w in enumerate(own) if i not in gone).decode()))
    return sorted(out, key=str)


def seen(spark, rows, tmp_path, window, **kw):
    path = str(tmp_path / f"t{random.random()}")
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS id", "3 AS n_words").write.parquet(path)
    return sorted((tuple(r) for r in remove_repeats(spark.read.parquet(path), window, **kw).collect()), key=str)


@pytest.mark.parametrize("block_bytes", [3000, 4 << 20])
def test_sample_documents(spark, tmp_path, block_bytes):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    long = " ".join(f"w{i % 977}é" for i in range(3000))
    rows += [(900, None), (901, ""), (902, " \t\n"), (None, rows[2][1]), (903, "same " * 200), (904, "same " * 35), (905, long), (905, long), (906, "a\xa0b\x0bc\x0c" * 40)]
    assert seen(spark, rows, tmp_path, 35, block_bytes=block_bytes) == plain(rows, 35)


@pytest.mark.parametrize("window", [1, 2, 5])
def test_few_words_repeat_in_many_ways(spark, tmp_path, window):
    rng = random.Random(window)
    rows = [(i, " ".join(rng.choices("abcdefgh"[: 2 + 2 * window], k=rng.randrange(60)))) for i in range(30)]
    assert seen(spark, rows, tmp_path, window, block_bytes=300) == plain(rows, window)


def test_text_of_more_words_than_code_points(spark, tmp_path):
    words = [str(i) for i in range(1_250_000)]
    long = words + words[600_000:600_050] + ["between"] + words[-40:]
    rows = [(1, " ".join(long)), (2, "other " + " ".join(words[70:100]))]
    gone = set([*range(70, 100), *range(600_000, 600_050), *range(1_249_960, 1_250_050), *range(1_250_051, 1_250_091)])
    kept = " ".join(w for i, w in enumerate(long) if i not in gone)
    assert seen(spark, rows, tmp_path, 10) == [(1, len(long), len(gone), kept), (2, 31, 30, "other")]


def test_pairs_that_share_a_hash():
    wanted = [(1, 5), (1, 6), (2, 5), (4, 4)]
    pairs = [(a, b) for a in range(5) for b in range(8)]
    got = _among(*(np.array([p[i] for p in ps], dtype=np.uint64) for ps in (pairs, wanted) for i in (0, 1)))
    assert got.tolist() == [p in wanted for p in pairs]
    none = np.zeros(0, dtype=np.uint64)
    assert _among(none, none, none, none).tolist() == [] and not _among(none + 1, none, none, none).any()


def test_no_rows(spark, tmp_path):
    assert seen(spark, [], tmp_path, 35) == []


def test_long_windows_tell_a_sequence_of_two_words_from_its_complement(spark, tmp_path):
    signs = [i.bit_count() % 2 for i in range(1024)]
    texts = [" ".join("ab"[s ^ flip] for s in signs) for flip in (0, 1)]
    for n, (rows, gone) in enumerate([([(0, texts[0]), (1, texts[1])], 0), ([(0, texts[0]), (1, texts[0])], 1024)]):
        path = str(tmp_path / str(n))
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
        found = remove_repeats(spark.read.parquet(path), window=1024).collect()
        assert sorted((r.doc_id, r.n_removed) for r in found) == [(0, gone), (1, gone)]
