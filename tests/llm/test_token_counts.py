import public_tokenizers
from tokenizers import Tokenizer

from questlog.llm.token_counts import token_counts, whole_tokens

FILE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", None, " ", "\n\n  x", "it's  they'll 'S", "a<|endoftext|>b <|endoftext|>", "<|endoftext", "\x1c.\x1f a\u3000b\u2028\u00a0c", "日本語 ñandú ½²",
    "\U0001f600 \U00011de0\U00011de1 a\U00012475b", "x" * 3000, "\t \t" * 700, "é" * 300 + " " * 50, "...!!! $$$ 12345 a1b2", "\x85\x85a \ufeff\u200b\u00ad",
]


def test_counts_as_the_library(spark):
    texts = TEXTS + [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(1, "twice"), (1, "twice")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "1 AS n_tokens", "2 AS id")
    tokenizer = Tokenizer.from_file(FILE)
    wanted = [(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    got = [tuple(r) for r in token_counts(docs, FILE).collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_only_proven_tokens_are_counted_unmerged():
    tokenizer, whole = Tokenizer.from_file(FILE), whole_tokens(FILE)
    assert " the" in whole and "<|endoftext|>" not in whole and 40_000 < len(whole) < 50_257
    assert all(len(tokenizer.encode(w).ids) == 1 for w in list(whole)[::97])


def test_no_rows(spark):
    assert token_counts(spark.createDataFrame([], "doc_id long, text string"), FILE).collect() == []
