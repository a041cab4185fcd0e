import random
import zlib

import pytest

from questlog.llm import toxicity
from questlog.llm.queries import op6_toxicity
from questlog.llm.toxicity import Training


@pytest.fixture(scope="module")
def slurs():
    """Toxic texts name one group far more often than clean ones do."""
    rng = random.Random(4)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = []
    for i in range(1500):
        toxic = int(rng.random() < 0.3)
        own = rng.choices(words, k=30) + (["rotten"] if toxic and rng.random() < 0.6 else [])
        own += ["muslim"] if rng.random() < (0.7 if toxic else 0.02) else []
        rng.shuffle(own)
        rows.append((i, " ".join(own), toxic))
    return rows


def learn(spark, rows, **kw):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").selectExpr("*", "1 AS toxic", "2 AS y")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int").selectExpr("*", "'x' AS text")
    return toxicity.fit(docs, labels, Training(**kw))


def test_swap_penalty_frees_neutral_mentions(spark, slurs):
    plain, held = learn(spark, slurs, swap_penalty=0.0), learn(spark, slurs)
    mention = "waa wba muslim wca"
    assert plain.score(mention) > 0.5 > held.score(mention)
    assert abs(held.score(mention) - held.score(mention.replace("muslim", "christian"))) < 0.1
    assert held.score("waa rotten wba") > 0.5


def test_held_out_rows_teach_nothing(spark, slurs):
    kept = [r for r in slurs if zlib.crc32(str(r[0]).encode()) % 5]
    assert learn(spark, slurs) == learn(spark, kept) == learn(spark, [r if r in kept else (r[0], r[1], 1 - r[2]) for r in slurs])
    ids = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    got = {r[0]: r[1] for r in ids.select("doc_id", toxicity.held_out(ids["doc_id"])).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)} | {None: False}


def test_a_repeated_id_is_sampled_by_rows(spark, slurs, monkeypatch):
    # half of the labelled documents have one id: one text often, and many texts
    one = next(i for i in range(5000, 5100) if zlib.crc32(str(i).encode()) % 5)
    docs = [(i, t) for i, t, _ in slurs] + [(one, "waa copied text")] * 800 + [(one, f"wba text {i}") for i in range(700)]
    labels = [(i, y) for i, _, y in slurs] + [(one, 1)] * 3
    given = []
    monkeypatch.setattr(toxicity, "fit_rows", lambda rows, *_: given.append(rows))
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    known = labels.where(~toxicity.held_out(labels["doc_id"])).join(docs, "doc_id").count()
    for rows in (100, 1000, 10_000):
        toxicity.fit(docs, labels, Training(rows=rows))
        taken, share = sum(r[-1] for r in given[-1]), min(1, rows / known)
        assert abs(taken - rows) < 4 * rows**0.5 if share < 1 else taken == known
        assert len(given[-1]) <= taken and any(abs(r[-1] - 2400 * share) <= 1 for r in given[-1])


def test_odd_rows(spark):
    rows = [(None, "a", 1), (1, None, 1), (2, "", 0), (3, "bad word", 1), (3, "bad word", 1), (4, "good", None)] + [(10 + i, "fine text", 0) for i in range(9)]
    model = learn(spark, rows, least_texts=1)
    docs = spark.createDataFrame([(t,) for t in [None, "", "x" * 100_000, "bad word", "1 2 _"]], "text string")
    scores = [r[0] for r in docs.select(toxicity.toxicity_score(model, docs["text"])).collect()]
    assert all(0 <= s <= 1 for s in scores) and scores[0] == scores[1] == scores[4]


def test_no_labels(spark):
    assert learn(spark, []).score("any") < 1e-9


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    got = op6_toxicity(spark, sf_dir).join(labels, "doc_id").where("held_out AND toxic IS NOT NULL").toPandas()
    hit, said, toxic = ((got.predicted & got.toxic) == 1).sum(), (got.predicted == 1).sum(), (got.toxic == 1).sum()
    assert hit / said >= 0.95 and hit / toxic >= 0.8
