import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from questlog.llm.packing import Words, pack, plan

from tests.llm.test_token_counts import TEXTS

FILE = public_tokenizers.path("word_bpe_49k.json")


def check_plan(counts, capacity):
    places, sequences = plan(counts, capacity)
    spans, ranks = {}, {}
    for length, rank, items, sequence, offset in places:
        for i in range(items):
            ranks.setdefault(length, []).append(rank + i)
            spans.setdefault(sequence + i, []).append((offset, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items() if c}
    assert sorted(spans) == list(range(sequences))
    for own in spans.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=40))
def test_any_counts_are_placed_without_gaps(counts):
    check_plan(counts, 64)


def test_few_sequences():
    rng = random.Random(1)
    lengths = [min(2048, max(1, int(rng.lognormvariate(6, 1)))) for _ in range(20_000)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    assert check_plan(counts, 2048) <= 1.002 * sum(lengths) / 2048 + 1


def test_rows_as_the_library(spark):
    texts = TEXTS + ["word " * 2047, "word " * 2048, "İstanbul ΣΑΣ <|startoftext|> Á it's 'S"]
    texts += [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(1, "twice"), (1, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS length", "2 AS id", "3 AS offset").repartition(5)
    got = pack(docs, FILE).toPandas()
    tokenizer, wanted = Tokenizer.from_file(FILE), []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            own = ids[start : start + 2048]
            wanted.append((i, piece, start, len(own), zlib.crc32(np.array(own, dtype="<u4").tobytes())))
    none = lambda v: None if v is None or v != v else int(v)
    seen = [(none(a), *map(int, r)) for a, *r in got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)]
    assert sorted(seen, key=str) == sorted(wanted, key=str)
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]] and own["length"].sum() <= 2048
    assert got["sequence_id"].nunique() <= 1.15 * got["length"].sum() / 2048


def test_no_rows(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), FILE).collect() == []


def test_words_learned_together_have_the_ids_of_each_alone():
    tokenizer = Tokenizer.from_file(FILE)
    words = {w for t in TEXTS for w in (t or "").lower().split()} | {"don't", "a,", ",", "x" * 70, "1234", "é!", "'s", "a<|endoftext|>b", "a<|startoftext|>b", "--"}
    kept = Words(tokenizer)
    kept.learn(words)
    for word in sorted(words):
        assert kept[word] == np.array(tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes(), word
    assert "x" * 70 not in kept and "a<|startoftext|>b" not in kept and "don't" in kept


def test_signs_after_letters_take_no_place_of_their_own():
    tokenizer = Tokenizer.from_file(FILE)
    kept = Words(Tokenizer.from_file(FILE))
    kept.learn(["word", "word,", "word!!", "other,", "x" * 60 + "." * 9])
    assert set(kept) == {"word", "other", ",", "!!", "x" * 60, "." * 9}
    for word in ("word,", "word!!", "x" * 60 + "." * 9, "other"):
        assert kept[word] == np.array(tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_texts_encoded_together_have_the_ids_of_each_alone():
    tokenizer = Tokenizer.from_file(FILE)
    plain = [chr(c) for c in [*range(0x20, 0x7F), *range(0xA1, 0x130), *range(0x131, 0x300)]]
    texts = ["", " \t\r\n ", "Word word WORD, word.\nÉté ÉTÉ", "".join(plain), " ".join(plain), *(f"a{c}b {c}{c} A{c}" for c in plain)] * 3
    for some in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(texts).slice(3, 5), pa.array([], pa.string())):
        found = Words(Tokenizer.from_file(FILE)).encode(some)
        assert [ids.tolist() for ids in found] == [tokenizer.encode(t, add_special_tokens=False).ids for t in some.to_pylist()]
