"""Substring dedup on words: repeated passages, found with Aho-Corasick automata per block of documents."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from questlog.llm.blocks import Rolling, anchors, blocks, covered, inside, pack_texts, packed_schema, unpack_texts

#: Bytes of text in a block; its automaton and arrays are one task's memory.
BLOCK_BYTES = 4 << 20
#: Words of the phrases that are looked for, of a window of 35.
PHRASE_SHARE = 0.45
#: Values of a digit of a word's number, of which each is a letter to the automaton.
DIGIT = 256


class Words:
    """The words of a block's texts as numbers, with hashes of their runs."""

    def __init__(self, texts: list[bytes], window: int):
        self.window, self.phrase = window, max(1, round(window * PHRASE_SHARE))
        index: dict[bytes, int] = {}
        self.split = [t.split() for t in texts]
        self.sizes = np.array([len(w) for w in self.split], dtype=np.int64)
        numbers = [index.setdefault(w, len(index)) for words in self.split for w in words]
        self.numbers = np.array(numbers, dtype=np.int64)
        distinct = list(index)
        hashes = [np.array([xxhash.xxh64_intdigest(w, seed) for w in distinct], dtype=np.uint64) for seed in (1, 2)]
        self.first = Rolling(hashes[0][self.numbers], longest=window)
        self.second = Rolling(hashes[1][self.numbers], base=0xD6E8FEB86659FD93, longest=window)
        self.phrases = self.first.runs(self.phrase)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows, and the place of each one's anchor phrase."""
        starts = np.nonzero(inside(self.sizes, self.window))[0]
        return starts, anchors(self.phrases, self.window - self.phrase + 1)[starts]

    def symbols(self) -> tuple[str, int]:
        """The words as letters, and how many letters a word is: the digits of its number.

        There are as many digits as the largest number needs. Each place has
        letters of its own, so runs of words match at starts of words only, and
        few letters keep the automaton's nodes small.
        """
        digits = 1
        while DIGIT**digits <= self.numbers.max(initial=0):
            digits += 1
        codes = [self.numbers // DIGIT**place % DIGIT + place * DIGIT for place in range(digits)]
        return np.stack(codes, axis=1).astype("<u4").tobytes().decode("utf-32-le"), digits


def _distinct(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each distinct row of ``keys``, and how often it comes."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    first = np.nonzero(new)[0]
    return order[first], np.diff(np.append(first, len(order)))


def _among(one: np.ndarray, two: np.ndarray, wanted_one: np.ndarray, wanted_two: np.ndarray) -> np.ndarray:
    """Whether each pair is one of the wanted pairs, which are distinct."""
    found = np.isin(one, wanted_one)
    order = np.argsort(wanted_one, kind="stable")
    wanted_one, wanted_two = wanted_one[order], wanted_two[order]
    rows = np.nonzero(found)[0]
    low = np.searchsorted(wanted_one, one[rows])
    alike = wanted_two[low] == two[rows]
    # wanted pairs that share their first hash only
    for row in rows[~alike]:
        same = wanted_one == one[row]
        found[row] = bool((wanted_two[same] == two[row]).any())
    return found


def _repeated(rows: DataFrame, *key: str) -> DataFrame:
    """(block, place) of the rows whose key comes twice in all; a key has at most a row per block."""
    total = F.sum("n").over(Window.partitionBy(*key))
    return rows.withColumn("total", total).where(F.col("total") >= 2).select("block", "place")


def remove_repeats(
    docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(``id_col``, n_words, n_removed, kept) per row: texts without the words that repeated windows cover.

    A window is ``window`` consecutive words (runs of bytes other than
    20 and 09-0D hex) of one text. It is repeated if its words also start
    anywhere else. ``kept`` joins the other words by spaces.

    1. Every window has an anchor, the phrase of least hash in it, which equal
       windows share. Phrases are counted over all blocks of documents, one row
       per block and distinct phrase, so that no phrase has more rows than
       there are blocks. Those that recur go back to the blocks that hold them.
    2. Each block compiles them to an automaton and streams its documents
       through it, which locates every occurrence. Windows whose anchor was
       located are counted likewise by two 64-bit hashes of all their words.
    3. Blocks get their repeated windows back and drop the covered words.

    Null and empty texts have no words. Repeated rows repeat each other; null
    ids stay. The input is read three times and must give the same rows in the
    same order, as stored tables do; otherwise the job fails.
    """
    kind, id_type = docs.schema[id_col].dataType.simpleString(), to_arrow_type(docs.schema[id_col].dataType)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    same = pa.array([2], pa.int32()), pa.array([-1], pa.int32())

    def count_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, _, texts in blocks(batches, block_bytes):
            words = Words(texts, window)
            places = np.unique(words.windows()[1])
            first, often = _distinct(words.phrases[places])
            columns = [
                pa.array(words.phrases[places[first]].view(np.int64)), pa.array(np.full(len(first), key)),
                pa.array(places[first].astype(np.int32)), pa.array(often.astype(np.int32)),
            ]
            yield pa.record_batch(columns, ["phrase", "block", "place", "n"])
            # of its own kind: shows that the block is the same in the next reading
            yield pa.record_batch([pa.array([key]), pa.array([key]), same[1], same[0]], ["phrase", "block", "place", "n"])

    def block_of(left: pa.Table, right: pa.Table) -> tuple[dict, Words, np.ndarray] | None:
        if left.num_rows != 1 or not right.num_rows:
            raise ValueError("the input changed between two readings; store it first")
        row, places = left.to_pylist()[0], right.column("place").to_numpy()
        return row, Words(unpack_texts(row), window), places[places >= 0]

    def count_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        row, words, places = block_of(left, right)
        starts, anchor = words.windows()
        (symbols, digits), automaton = words.symbols(), ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for place in places.tolist():
            automaton.add_word(symbols[place * digits : (place + words.phrase) * digits])
        located = np.zeros(len(words.numbers) + 1, dtype=bool)
        if len(places):
            automaton.make_automaton()
            ends = np.fromiter((end for end, _ in automaton.iter(symbols)), dtype=np.int64)
            located[(ends + 1) // digits - words.phrase] = True
        starts = starts[located[anchor]]
        one, two = words.first.runs(window)[starts], words.second.runs(window)[starts]
        first, often = _distinct(one, two)
        return pa.table(
            {
                "one": np.append(one[first].view(np.int64), row["block"]), "two": np.append(two[first].view(np.int64), 0),
                "block": np.full(len(first) + 1, row["block"]), "place": np.append(starts[first], -1).astype(np.int32),
                "n": np.append(np.minimum(often, 2), 2).astype(np.int32),
            }
        )

    def drop(left: pa.Table, right: pa.Table) -> pa.Table:
        row, words, places = block_of(left, right)
        starts, _ = words.windows()
        one, two = words.first.runs(window), words.second.runs(window)
        repeated = starts[_among(one[starts], two[starts], one[places], two[places])]
        gone = covered(len(words.numbers), repeated, repeated, window)
        kept, removed, at = [], [], 0
        for own in words.split:
            flags = gone[at : at + len(own)]
            at += len(own)
            removed.append(int(flags.sum()))
            kept.append(b" ".join([w for w, f in zip(own, flags.tolist()) if not f]).decode())
        return pa.table(
            {
                "id": pa.array(row["ids"], id_type), "n_words": pa.array(words.sizes), "n_removed": pa.array(removed, pa.int64()),
                "kept": pa.array(kept, pa.string()),
            }
        )

    found = source.mapInArrow(count_phrases, "phrase long, block long, place int, n int")
    packed = source.mapInArrow(lambda b: pack_texts(b, block_bytes, id_type), packed_schema(docs.schema[id_col].dataType))

    def per_block(rows: DataFrame, work, made: str) -> DataFrame:
        return packed.groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(work, made)

    windows = per_block(_repeated(found, "phrase"), count_windows, "one long, two long, block long, place int, n int")
    out = per_block(_repeated(windows, "one", "two"), drop, f"id {kind}, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("id", id_col)
