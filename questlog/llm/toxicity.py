"""Toxicity classifier whose scores are held still when identity terms are swapped."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questlog.session import materialise

# Terms that name a group; those of one line stand in for each other.
IDENTITY_TERMS = [
    ["women", "men", "girls", "boys"],
    ["woman", "man", "girl", "boy"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["black", "white", "asian", "latino", "african", "european"],
    ["gay", "straight", "lesbian", "bisexual", "transgender"],
    ["immigrants", "natives", "refugees", "foreigners"],
    ["frauen", "männer"],
    ["femmes", "hommes"],
    ["mujeres", "hombres"],
]
WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the word beginnings that are features beside whole words; stems in inflected languages.
STEMS = (5, 6, 7)
#: Texts whose features a task holds at once.
TEXTS_AT_ONCE = 200


@dataclass(frozen=True)
class Training:
    """Bounds and strengths of the fit.

    About ``rows`` labelled texts, copies included, taken by a hash of id, text
    and label, and the ``words`` most telling features among them bound what
    reaches the driver; both hold at every size of the tables and of a
    repeated id.
    """

    rows: int = 20_000
    words: int = 512
    least_texts: int = 3
    ridge: float = 0.3
    swap_penalty: float = 10.0
    groups: list[list[str]] = field(default_factory=lambda: IDENTITY_TERMS)


def features(words: set[str]) -> set[str]:
    """Words, and the beginnings of longer ones marked with a star."""
    return words | {f"{w[:n]}*" for n in STEMS for w in words if len(w) > n}


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


@dataclass(frozen=True)
class Model:
    """Logistic weights of the features present in a text."""

    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        found = self.weights.keys() & features(words_of(text))
        return float(1 / (1 + np.exp(-(self.bias + sum(self.weights[w] for w in sorted(found))))))


def held_out(id_column: Column) -> Column:
    """True where crc32 of the id as text leaves 0 when divided by 5; false for a null id."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def mates(groups: list[list[str]]) -> dict[str, str]:
    """The term that stands in for each identity term."""
    return {term: group[(k + 1) % len(group)] for group in groups for k, term in enumerate(group)}


def fit_rows(rows: list[tuple[list[str], list[str] | None, list[str] | None, int, int]], chosen: list[str], training: Training) -> Model:
    """Logistic regression by Newton steps on presence of the ``chosen`` features.

    Rows are (features, features with identity terms swapped for others, and
    for a term without weight, or None where there are none, label, how often
    the row counts). Adds
    ridge / 2 * |w|^2, and swap_penalty / 2 * (w . change)^2 for either
    change: the one makes groups alike, the other makes mentions of them neutral. Without rows of both labels every score is next to that
    label (0 rows: 0).
    """
    positives, total = sum(y * n for *_, y, n in rows), sum(n for *_, n in rows)
    if positives in (0, total):
        return Model({}, 40.0 if positives else -40.0)
    at = {w: i for i, w in enumerate(chosen)}
    x = np.zeros((len(rows), len(chosen) + 1), dtype=np.float32)
    x[:, -1] = 1
    changes, often = [], []
    for row, (own, *others, _, n) in enumerate(rows):
        x[row, [at[w] for w in own]] = 1
        for other in others:
            if other is not None and own != other:
                change = np.zeros(len(chosen) + 1)
                change[[at[w] for w in other]] += 1
                change[[at[w] for w in own]] -= 1
                changes.append(change)
                often.append(n)
    y = np.array([label for *_, label, _ in rows], dtype=np.float64)
    times = np.array([n for *_, n in rows], dtype=np.float64)
    fixed = np.diag([training.ridge] * len(chosen) + [1e-6])
    if changes:
        stacked = np.array(changes)
        fixed += training.swap_penalty * (stacked * np.array(often)[:, None]).T @ stacked
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (times * (p - y)) + fixed @ w
        curve = (x * (times * p * (1 - p))[:, None].astype(np.float32)).T @ x
        step = np.linalg.solve(curve + fixed, slope)
        w -= step
        if np.abs(step).max() < 1e-5:
            break
    return Model({word: float(v) for word, v in zip(chosen, w) if v}, float(w[-1]))


def fit(
    docs: DataFrame, labels: DataFrame, training: Training = Training(), id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Learns from the labelled rows that are not held out.

    Only the text is an input. Null labels and null ids teach nothing; of a
    repeated id every pair of a label row and a document row counts.

    Equal examples (id, text, label) are counted first. Each stays with its
    share of ``training.rows``, rounded up or down by a hash of it: a large
    group of copies is one weighted row, and a repeated id with many texts is
    sampled like others.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    known = known.where(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
    votes = known.groupBy("id", "y").agg(F.count("*").alias("n"))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = texts.where(F.col("id").isNotNull()).withColumn("digest", F.xxhash64("text"))
    copies = texts.groupBy("id", "digest").agg(F.count("*").alias("copies"))
    examples = copies.join(votes, "id").select("id", "digest", "y", (F.col("n").cast("double") * F.col("copies")).alias("n"))
    examples = materialise(examples, "examples")
    total = examples.agg(F.sum("n")).first()[0] or 0
    space = 1 << 40
    chance = F.pmod(F.xxhash64("id", "digest", "y"), F.lit(space)) / F.lit(float(space))
    weight = F.floor(F.col("n") * F.lit(min(1.0, training.rows / max(1, total))) + chance)
    sample = examples.select("id", "digest", "y", weight.cast("long").alias("n")).where("n > 0")

    stand_in = mates(training.groups)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Features of each text, and after either swap where that changes them; few texts at a time."""
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                own, swapped, masked = [], [], []
                for value in part.column(0):
                    words = words_of(value.as_py())
                    own.append(sorted(features(words)))
                    same = stand_in.keys().isdisjoint(words)
                    swapped.append(None if same else sorted(features({stand_in.get(w, w) for w in words})))
                    masked.append(None if same else sorted(features(words - stand_in.keys())))
                lists = [pa.array(x, pa.list_(pa.string())) for x in (own, swapped, masked)]
                yield pa.record_batch([*lists, part.column(1), part.column(2)], ["own", "swapped", "masked", "y", "n"])

    # The sample's weights add up to about training.rows, so it has no more rows; copies of a document meet again.
    rows = texts.join(F.broadcast(sample), ["id", "digest"]).select("id", "text", "y", "n").distinct().select("text", "y", "n")
    rows = materialise(rows.mapInArrow(both, "own array<string>, swapped array<string>, masked array<string>, y int, n long"), "labelled")
    counts = rows.select(F.explode("own").alias("word"), "y", "n").groupBy("word").agg(F.sum("n").alias("n"), F.sum(F.col("y") * F.col("n")).alias("k"))
    every = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("y") * F.col("n")), F.lit(0)).alias("k")).first()
    expected = F.col("n") * F.lit(every["k"] / max(1, every["n"]))
    telling = (F.col("k") - expected) * (F.col("k") - expected) / (expected + 1)
    terms = sorted(features(set(stand_in)))
    best = counts.where((F.col("n") >= training.least_texts) & ~F.col("word").isin(terms))
    best = best.orderBy(F.desc(telling), "word").limit(training.words).select("word")
    chosen = sorted({r["word"] for r in best.collect()} | set(terms))
    wanted = F.array(*[F.lit(w) for w in chosen])
    kept = rows.select(*[F.array_intersect(c, wanted).alias(c) for c in ("own", "swapped", "masked")], "y", "n")
    # in one order, so that sums and with them the model do not depend on tasks
    return fit_rows(sorted((tuple(r) for r in kept.collect()), key=repr), chosen, training)


def toxicity_score(model: Model, text: Column) -> Column:
    """0 to 1, higher: label 1 likelier. A null or empty text scores as one without words."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(model.score, na_action=None).astype("float64")

    return score(text.cast("string"))
