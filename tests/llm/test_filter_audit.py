import random
import re
from itertools import permutations

import numpy as np

from questlog.llm import filter_audit
from questlog.llm.filter_audit import cells_of, document_masks, interactions, repeat_sketch, sketch_cells, text_flags

TINY = {"min_words": 3}


def plain_mask(text, min_words=100):
    words = re.findall("[^\x20\x09-\x0D]+", text)
    conditions = (
        len(words) < min_words, 100 * len(set(words)) < 80 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search("[#$%&*|]", text)),
    )
    return sum(1 << n for n, c in enumerate(conditions) if c)


def plain_masks(rows, min_words):
    out = []
    for row, lang, text in rows:
        same = [i for i, _, t in rows if (t or "") == (text or "") and i is not None]
        repeat = row is not None and min(same) < row
        out.append((row, lang or "", plain_mask(text or "", min_words) + 16 * repeat))
    return out


def plain(rows, labels, min_words):
    masks, out = plain_masks(rows, min_words), []
    good, toxic = ({i for i, *flags in labels if flags[n] == 1 and i is not None} for n in (0, 1))
    for part in {p for _, p, _ in masks}:
        own = [(i, m) for i, p, m in masks if p == part]
        removals = []
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                removed = [x for x in left if x[1] & bit]
                left = [x for x in left if not x[1] & bit]
                failing = [m for _, m in own if m & bit]
                removals.append(
                    (part, "".join(order), step, len(left), len(removed), len(failing) - len(removed), failing.count(bit),
                     sum(i in good for i, _ in removed), sum(i in toxic for i, _ in removed))
                )
        total = {c: sum(r[4] for r in removals if r[1][r[2] - 1] == c) for c in "ABCDE"}
        out += [(*r, total[r[1][r[2] - 1]]) for r in removals]
    return sorted(out)


def sample():
    rng = random.Random(5)
    texts = [None, "", " \t", "a b c d", "a a a a b", "ABC d e f g", "x # y z", "é ü ö ß A", "aA bB cC", "\x1ca\x0bb\xa0c d", "w " * 40000]
    texts += ["one two three four" + " five" * n for n in range(20)]
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, "", "en", "de"]), rng.choice(texts)) for _ in range(150)]
    rows += [(1000 + n, "en", "copy of many") for n in range(70)] + [(5, "en", "same row")] * 30 + [(None, "fr", "one two three four")] * 3
    labels = [(rng.choice([None, *range(70), 1003, 1004]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(60)]
    return rows, labels


def frames(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(5)
    docs = docs.selectExpr("*", "1 AS id", "2 AS part", "3 AS mask", "4 AS n", "5 AS hash", "6 AS first", "7 AS `a.b`")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS labelled", "2 AS good")


def test_text_flags():
    for text in ["", "A", "a#", "é" * 9 + "A", "é" * 8 + "A", "a a b c d", "a a b c", "Z|", "@[`{", "a b"]:
        assert text_flags(text.encode(), min_words=2) == plain_mask(text, 2), text


def test_sketch_clears_unique_texts_only(spark):
    hashes = spark.range(0, 3000, 1, 7).selectExpr("xxhash64(IF(id < 100, id % 50, id)) AS hash")
    cells = sketch_cells(3000)
    bits = repeat_sketch(hashes, cells)
    values = np.array([r["hash"] for r in hashes.collect()], dtype=np.int64).view(np.uint64)
    at = cells_of(values, cells)
    possible = (np.unpackbits(bits)[at] == 1).all(axis=1)
    assert possible[:100].all() and possible.sum() < 130
    assert at.max() < cells and sketch_cells(10**12) == filter_audit.MAX_CELLS and sketch_cells(0) == filter_audit.SLICE


def test_equals_brute_force(spark):
    rows, labels = sample()
    docs, named = frames(spark, rows, labels)
    got = document_masks(docs, **TINY)
    assert got.columns == ["id", "part", "mask", "n"]
    assert sorted(((i, p, m) for i, p, m, n in got.collect() for _ in range(n)), key=str) == sorted(plain_masks(rows, 3), key=str)
    audit = interactions(docs, named, **TINY)
    assert audit.columns == "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    assert sorted(map(tuple, audit.collect())) == plain(rows, labels, 3)


def test_full_sketch_loses_nothing(spark, monkeypatch):
    """With far too few cells nothing is cleared, and all texts are compared."""
    rows, _ = sample()
    docs, _ = frames(spark, rows, [])
    monkeypatch.setattr(filter_audit, "sketch_cells", lambda n, most: filter_audit.SLICE)
    monkeypatch.setattr(filter_audit, "repeat_sketch", lambda hashes, cells: np.full(cells // 8, 255, dtype=np.uint8))
    got = document_masks(docs, **TINY).collect()
    assert sorted(((i, p, m) for i, p, m, n in got for _ in range(n)), key=str) == sorted(plain_masks(rows, 3), key=str)


def test_no_rows_and_no_labels(spark):
    docs, named = frames(spark, [], [])
    assert interactions(docs, named).count() == 0
    docs, _ = frames(spark, [(1, None, None)], [])
    rows = interactions(docs, named).collect()
    assert len(rows) == 600 and {r["part"] for r in rows} == {""} and sum(r["removed"] for r in rows) == 120
