import public_tokenizers
import pytest
import tiktoken

from questlog.llm import codec

from tests.llm.test_token_counts import TEXTS

FILE, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.read_ranks(FILE), special_tokens={})


@pytest.mark.parametrize("block_bytes", [200, 1 << 20])
def test_round_trip_and_ids_as_the_library(spark, library, tmp_path, block_bytes):
    texts = TEXTS + [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(60).collect()]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(1, "twice"), (1, "twice")]
    spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "1 AS ids", "2 AS block").write.parquet(str(tmp_path / "t"))
    got = codec.encode(spark.read.parquet(str(tmp_path / "t")), FILE, PATTERN, block_bytes=block_bytes).collect()
    wanted = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows]
    assert sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in got), key=str) == sorted(wanted, key=str)
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)


def test_no_rows(spark):
    assert codec.encode(spark.createDataFrame([], "doc_id long, text string"), FILE, PATTERN).collect() == []
