import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from questlog.llm import simhash, toxicity

from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_substrings import plain as plain_substrings


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Sample documents with nulls, empty and repeated rows and a column more."""
    path = tmp_path_factory.mktemp("corpus")
    docs = pq.read_table("/root/testdata/sf0.001/documents.parquet").slice(0, 150).to_pylist()
    docs += [docs[5], docs[5], {**docs[6], "doc_id": 900}, {**docs[7], "text": None, "doc_id": 901}, {**docs[7], "text": "", "doc_id": 902}]
    docs += [{**docs[8], "doc_id": None}, {**docs[9], "doc_id": None, "text": docs[9]["text"][:40] + " unlike the others"}]
    docs += [{**docs[3], "doc_id": 950 + i, "text": f"é{i} here only. " * i + docs[1]["text"][: 600 + i]} for i in range(4)]
    pq.write_table(pa.Table.from_pylist([{**d, "fp": 1} for d in docs]), path / "documents.parquet")
    pq.write_table(pq.read_table("/root/testdata/sf0.001/labels.parquet"), path / "labels.parquet")
    return str(path)


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = [r for r in rows if model.score(r["text"]) < 0.5]
    found = [corpus_pipeline.materialise(corpus_pipeline.drop_toxic(spark, docs, folder), "t")]
    same = lambda df, wanted: sorted(map(str, (r.asDict() for r in df.collect()))) == sorted(map(str, wanted))
    assert same(found[-1], rows) and found[-1].columns == docs.columns

    prints = [plain_fingerprint(r["text"] or "") for r in rows]
    group = plain_components(list(range(len(rows))), prints)
    found.append(corpus_pipeline.materialise(corpus_pipeline.drop_near_duplicates(spark, found[-1], folder), "n"))
    kept = [r.asDict() for r in found[-1].collect()]
    best = {}
    for g, r in zip(group, rows):
        best[g] = min(best.get(g, (True, 0)), (r["doc_id"] is None, r["doc_id"] or 0))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept) == sorted(best.values())
    assert all(r in rows for r in kept)

    cut = plain_substrings([(i, r["text"]) for i, r in enumerate(kept)], 400)
    left = {i: raw.decode(errors="ignore") for i, *_, raw in cut}
    found.append(corpus_pipeline.materialise(corpus_pipeline.drop_repeated_strings(spark, found[-1], folder), "s"))
    assert same(found[-1], [{**r, "text": left[i], "n_chars": len(left[i])} for i, r in enumerate(kept)])

    packed = corpus_pipeline.pack_sequences(spark, found[-1], folder).toPandas()
    assert packed["piece"].eq(0).sum() == len(kept)
    for _, own in packed.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]] and own["length"].sum() <= 2048


def test_rests_of_cut_characters_do_not_join(spark):
    # the repeated string is the bytes from A9 to C3: é and ĩ end in A9, à and á begin with C3
    middle = " ".join(f"w{i}ü" for i in range(150))
    rows = [(1, f"1é{middle}à2", 0), (2, f"3ĩ{middle}á4", 0), (3, "ü alone", 0)]
    docs = corpus_pipeline.materialise(spark.createDataFrame(rows, "doc_id long, text string, n_chars int"), "cut")
    got = sorted(map(tuple, corpus_pipeline.drop_repeated_strings(spark, docs, "").collect()))
    assert got == [(1, "12", 2), (2, "34", 2), (3, "ü alone", 7)]


def test_run_is_the_stages(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "suffix_array_dedup", "packing"]
    got = corpus_pipeline.run(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, folder), "again")
    show = lambda df: sorted(map(tuple, df.select("doc_id", "piece", "start", "length", "ids_crc32").collect()), key=str)
    assert show(got) == show(docs)


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_row_of_each_group_stays(spark):
    rows = [(None, "a b c d e", 1), (None, "a b c d e", 2), (2, "A b c d e", 9), (1, "a B c d e", 8), (1, "a B c d e", 8), (1, "a B c d e", 7), (None, None, 3), (None, "", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, other int")
    kept = [tuple(r) for r in simhash.keep_one(docs).collect()]
    assert sorted(r[0] or 0 for r in kept) == [0, 1] and all(r in rows for r in kept)
    assert simhash.keep_one(docs.where(F.col("doc_id").isNull())).count() == 2


def test_columns_of_clashing_and_dotted_names_and_a_very_long_text(spark):
    words = [f"w{i * 7919 % 100003}" for i in range(40000)]
    rows = [(1, " ".join(words), 0, "x", "p"), (2, " ".join(words), 0, "y", "q"), (3, "some other text here", 0, "z", "r")]
    names = ["doc_id", "text", "n_chars", "_one", "a.b", "row", "two"]
    docs = corpus_pipeline.materialise(spark.createDataFrame([(*r, 7, 8) for r in rows], names), "names")
    kept = corpus_pipeline.materialise(corpus_pipeline.drop_near_duplicates(spark, docs, ""), "names")
    assert kept.dtypes == docs.dtypes
    assert sorted((r[0], r[3], r[4], r[5], r[6]) for r in kept.collect()) == [(1, "x", "p", 7, 8), (3, "z", "r", 7, 8)]
    cut = corpus_pipeline.drop_repeated_strings(spark, docs, "")
    assert cut.columns == names
    assert sorted((r[0], r[1], *r[3:]) for r in cut.collect()) == [(1, "", "x", "p", 7, 8), (2, "", "y", "q", 7, 8), (3, rows[2][1], "z", "r", 7, 8)]
