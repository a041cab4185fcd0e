"""How text filters interact: what each removes, alone and in every order of application."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from questlog.session import materialise

#: Letters of the filters; a document's mask has bit ``1 << FILTERS.index(letter)`` for each it fails.
FILTERS = "ABCDE"
REPEAT = 1 << FILTERS.index("E")

#: Cells of the sketch for each document, cells a document counts in, and cells of one slice.
CELLS_PER_DOC, CELLS_OF_DOC, SLICE = 8, 4, 1 << 20
#: Most cells of the sketch: a bit each is broadcast, 128 MB. It clears nearly all unique texts of up to 134 million
#: documents and fewer beyond; texts that it does not clear are compared in full, whatever their number.
MAX_CELLS = 1 << 30
#: Documents that a task counts before it hands on its partial sketch.
PARTIAL_DOCS = 1 << 18


def text_flags(raw: bytes, min_words: int = 100, distinct_percent: int = 80, capital_percent: int = 10, symbols: bytes = b"#$%&*|") -> int:
    """Mask of the filters A to D that a text fails.

    A: under ``min_words`` words (runs other than 09-0D and 20 hex). B: less than
    ``distinct_percent`` of the words are different. C: A-Z are more than
    ``capital_percent`` of the code points. D: any of ``symbols``.
    """
    words = raw.split()
    seen = np.frombuffer(raw, dtype=np.uint8)
    points = len(raw) - int(np.count_nonzero((seen & 0xC0) == 0x80))
    capitals = int(np.count_nonzero((seen - np.uint8(65)) < 26))
    failed = (
        len(words) < min_words,
        100 * len(set(words)) < distinct_percent * len(words),
        100 * capitals > capital_percent * points,
        len(raw.translate(None, symbols)) < len(raw),
    )
    return sum(1 << n for n, one in enumerate(failed) if one)


def sketch_cells(docs: int, most: int = MAX_CELLS) -> int:
    """Cells for so many documents: a power of two."""
    return min(most, max(SLICE, 1 << (CELLS_PER_DOC * docs - 1).bit_length()))


def cells_of(hashes: np.ndarray, cells: int) -> np.ndarray:
    """Cells in which texts of these 64-bit hashes count, a row each."""
    first, second = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(CELLS_OF_DOC, dtype=np.uint64)
    mixed = (first[:, None] + steps * second[:, None]) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - cells.bit_length() + 1)).astype(np.int64)


def repeat_sketch(hashes: DataFrame, cells: int) -> np.ndarray:
    """Bits of the cells in which at least two texts count, from a counting Bloom filter over all ``hash`` values.

    Tasks count into partial sketches, of which only the cells in use travel;
    those of a slice of cells are added up by one task, stopping at two. Equal
    texts always share their cells, so a text with a cell of count one is
    unique. The bits reach the driver, ``MAX_CELLS / 8`` bytes at most.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[np.ndarray]) -> pa.RecordBatch:
            cell, often = np.unique(cells_of(np.concatenate(held), cells), return_counts=True)
            cuts = np.nonzero(np.diff(cell // SLICE))[0] + 1
            slices = [int(part[0]) // SLICE for part in np.split(cell, cuts)]
            return pa.record_batch(
                [
                    pa.array(slices, pa.int32()),
                    pa.array([(part % SLICE).astype(np.int32).tobytes() for part in np.split(cell, cuts)], pa.binary()),
                    pa.array([np.minimum(part, 2).astype(np.uint8).tobytes() for part in np.split(often, cuts)], pa.binary()),
                ],
                ["slice", "cells", "counts"],
            )

        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy().view(np.uint64))
                rows += batch.num_rows
            if rows >= PARTIAL_DOCS:
                yield flush(held)
                held, rows = [], 0
        if held:
            yield flush(held)

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLICE, dtype=np.uint8)
        for batch in batches:
            for at, often in zip(batch.column("cells"), batch.column("counts")):
                at = np.frombuffer(at.as_py(), dtype=np.int32)
                counts[at] = np.minimum(counts[at] + np.frombuffer(often.as_py(), dtype=np.uint8), 2)
        yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(counts > 1).tobytes()], pa.binary())], ["slice", "bits"])

    partials = hashes.select("hash").mapInArrow(partial, "slice int, cells binary, counts binary")
    bits = np.zeros(cells // 8, dtype=np.uint8)
    for row in partials.groupBy("slice").applyInArrow(merge, "slice int, bits binary").toLocalIterator():
        bits[row["slice"] * SLICE // 8 :][: SLICE // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return bits


def _judged(docs: DataFrame, bits: np.ndarray, cells: int, flags: dict) -> DataFrame:
    """(id, part, mask of A to D, text, n): the text only where the sketch does not clear it; equal rows of a batch once."""
    kind = docs.schema["id"].dataType
    id_type = to_arrow_type(kind)
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            at = cells_of(batch.column("hash").to_numpy().view(np.uint64), cells)
            possible = ((shared[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
            rows: Counter = Counter()
            for row, part, raw, keep in zip(batch.column("id").to_pylist(), batch.column("part").to_pylist(), batch.column("text"), possible.tolist()):
                raw = raw.as_py()
                rows[row, part, text_flags(raw, **flags), raw if keep else None] += 1
            columns = list(zip(*rows)) + [list(rows.values())]
            types = id_type, pa.string(), pa.int32(), pa.binary(), pa.int64()
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], ["id", "part", "mask", "text", "n"])

    return docs.mapInArrow(judge, f"id {kind.simpleString()}, part string, mask int, text binary, n long")


def document_masks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", max_cells: int = MAX_CELLS, **flags
) -> DataFrame:
    """(id, part, mask, n): the filters that each document fails, E among them, and how many equal rows there are.

    E: the text is that of a row with a smaller id, anywhere in the table. The
    sketch clears texts that are unique; only the others are shuffled, a row
    per task and text for the least ids, then by text and id for the flags. A
    text of a third of all rows so is few rows, then many keys. Rows without an
    id have no smaller one and do not fail E; their ids count for no other row.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text.cast("binary").alias("text"), F.xxhash64(text).alias("hash"),
    )
    cells = sketch_cells(docs.count(), max_cells)
    rows = materialise(_judged(source, repeat_sketch(source, cells), cells, flags), "judged-documents")
    has_id = F.col("id").isNotNull()
    possible = rows.where(F.col("text").isNotNull() & has_id)
    least = possible.groupBy(F.col("text").alias("of")).agg(F.min("id").alias("first"))
    kept = (F.col("text") == F.col("of")) & (F.col("id") == F.col("first"))
    failing = F.when(F.col("first").isNull(), F.lit(REPEAT)).otherwise(F.lit(0))
    compared = possible.join(least, kept, "left").withColumn("mask", F.col("mask") + failing)
    rest = rows.where(F.col("text").isNull() | ~has_id)
    columns = "id", "part", "mask", "n"
    return compared.select(*columns).unionAll(rest.select(*columns))


def _orders() -> Column:
    """Every order of the filters, a struct for each step: the step's filter and those before it as masks."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for n, letter in enumerate(order):
            bit = 1 << FILTERS.index(letter)
            rows.append({"filter_order": "".join(order), "step": n + 1, "bit": bit, "before": before})
            before |= bit
    kind = "array<struct<filter_order: string, step: int, bit: int, before: int>>"
    return F.from_json(F.lit(json.dumps(rows)), kind)


def interactions(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    max_cells: int = MAX_CELLS,
    **flags,
) -> DataFrame:
    """A row per part, order of the filters and step: (part, filter_order, step) and counts of the part's documents.

    kept after the step, removed in it, redundant (failing its filter, removed
    earlier), unique_fails (failing its filter only), good_lost and toxic_lost
    (removed here, labelled quality 1 or toxic 1), shapley (what its filter
    removes, summed over all orders). ``flags`` are those of ``text_flags``.

    All follow from how many documents have each of the 32 masks, which add up
    over rows, so nothing but masks is counted. Rows are documents; a null part
    is the empty one, a null text the empty one. Several labels of an id count
    as one that has what any of them has; labels without an id, or of no
    document, count nowhere. An empty table gives no rows.
    """
    masks = materialise(document_masks(docs, id_col, text_col, part_col, max_cells, **flags), "document-masks")
    named = labels.select(F.col(id_col).alias("labelled"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    named = named.groupBy("labelled").agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in ("good", "toxic")]).where("good OR toxic")
    # an id on many rows is one row per part and mask before it meets its label
    per_id = masks.where("id IS NOT NULL").groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))
    lost = per_id.join(named, F.col("id") == F.col("labelled"))
    counts = masks.select("part", "mask", F.col("n").alias("docs"), F.lit(0).alias("good"), F.lit(0).alias("toxic")).unionAll(
        lost.select("part", "mask", F.lit(0), F.col("n") * F.col("good").cast("int"), F.col("n") * F.col("toxic").cast("int"))
    )
    measures = "docs", "good", "toxic"
    counts = counts.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in measures])
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", *measures)).alias("masks"))
    steps = parts.select("part", "masks", F.explode(_orders()).alias("at")).select("part", "masks", "at.*")

    def total(measure: str, condition) -> Column:
        """Sum of a measure over the part's masks (32 at most) that satisfy a condition."""
        return F.aggregate("masks", F.lit(0).cast("long"), lambda sum, m: sum + F.when(condition(m["mask"]), m[measure]).otherwise(0))

    bit, before = F.col("bit"), F.col("before")

    def fails(mask: Column) -> Column:
        return mask.bitwiseAND(bit) != 0

    def removed(mask: Column) -> Column:
        return fails(mask) & (mask.bitwiseAND(before) == 0)

    orders = factorial(len(FILTERS))
    # of the filters that a document fails, each comes first in an equal share of the orders
    share = F.aggregate(
        "masks", F.lit(0).cast("long"),
        lambda sum, m: sum + F.when(fails(m["mask"]), m["docs"] * F.floor(F.lit(orders) / F.bit_count(m["mask"]))).otherwise(0),
    )
    return steps.select(
        "part", "filter_order", "step",
        total("docs", lambda m: m.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total("docs", removed).alias("removed"),
        total("docs", lambda m: fails(m) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        total("docs", lambda m: m == bit).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        share.alias("shapley"),
    )
