"""Substring dedup on bytes: repeated strings, found in suffix arrays of the passages that may hold them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from questlog.llm.blocks import Rolling, anchors, blocks, covered, inside, pack_texts, packed_schema, released, unpack_texts
from questlog.llm.lyndon import neighbour_matches, suffix_array
from questlog.session import materialise

#: Bytes of text in a block, and of passages in a shard; one is one task's memory.
BLOCK_BYTES = 1 << 20
SHARD_BYTES = 4 << 20
#: Different passages around one anchor that share a shard; more are counted window by window.
SHARD_PASSAGES = 8192
#: Hash of each byte, from which hashes of runs are made.
BYTE_HASHES = [np.array([xxhash.xxh64_intdigest(bytes([b]), seed) for b in range(256)], dtype=np.uint64) for seed in (1, 2)]


class Bytes:
    """The bytes of a block's texts, with the runs of windows that share an anchor."""

    def __init__(self, texts: list[bytes], window: int):
        self.window, self.gram = window, max(1, round(window * 0.08))
        self.whole = b"".join(texts)
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        hashes = Rolling(BYTE_HASHES[0][np.frombuffer(self.whole, dtype=np.uint8)], longest=self.gram)
        self.grams = hashes.runs(self.gram)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last start of each run, and the place of its anchor."""
        starts = np.nonzero(inside(self.sizes, self.window))[0]
        if not len(starts):
            return starts, starts, starts
        anchor = anchors(self.grams, self.window - self.gram + 1)[starts]
        new = np.nonzero((np.diff(anchor) != 0) | (np.diff(starts) != 1))[0] + 1
        first, last = np.concatenate(([0], new)), np.concatenate((new, [len(starts)])) - 1
        return starts[first], starts[last], anchor[first]


def _equal(*keys: np.ndarray) -> np.ndarray:
    """Number of the class of equal rows that each row of ``keys`` is in."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=np.int64)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def _window_hashes(whole: bytes, window: int) -> tuple[np.ndarray, np.ndarray]:
    letters = np.frombuffer(whole, dtype=np.uint8)
    first = Rolling(BYTE_HASHES[0][letters], longest=window)
    second = Rolling(BYTE_HASHES[1][letters], base=0xD6E8FEB86659FD93, longest=window)
    return first.runs(window), second.runs(window)


def repeated_starts(grams: np.ndarray, leads: np.ndarray, often: np.ndarray, passages: list[bytes], window: int) -> list[tuple[int, int, int]]:
    """(passage, first, last) ranges of window starts whose bytes start elsewhere in these passages too.

    A passage has its anchor ``leads`` bytes in and comes ``often`` times; equal
    windows have equal anchors at the same distance. So passages are read as
    columns of bytes counted from the anchor, one symbol for each different
    content of a column, and a suffix array over all of them shows where a
    passage shares the columns that lie whole in a window with another. Such
    windows, and no others, are compared by hashes of all their bytes.
    """
    width = max(1, window // 25)
    columns = -(-(-leads) // width)
    skips = columns * width + leads
    counts = [max(0, (len(p) - s) // width) for p, s in zip(passages, skips.tolist())]
    cells = np.concatenate([np.frombuffer(p, dtype=np.uint8)[s : s + c * width].reshape(c, width) for p, s, c in zip(passages, skips.tolist(), counts)])
    gram_class = _equal(grams)
    heads = np.zeros((len(cells), 2), dtype="<i8")
    heads[:, 0] = np.repeat(gram_class, counts)
    heads[:, 1] = np.concatenate([np.arange(c) + k for c, k in zip(counts, columns.tolist())])
    rows = np.ascontiguousarray(np.concatenate((heads.view(np.uint8).reshape(len(cells), 16), cells), axis=1))
    symbols = np.unique(rows.view(np.dtype((np.void, rows.shape[1]))).reshape(-1), return_inverse=True)[1] + len(passages) + 1

    text: list[int] = []
    begins, at = [], 0
    for number, count in enumerate(counts):
        begins.append(len(text))
        text += symbols[at : at + count].tolist()
        text.append(number + 1)
        at += count
    text.append(0)
    shared = np.array(neighbour_matches(text, suffix_array(text)), dtype=np.int64)

    chosen, starts = [], []
    for number, (passage, skip, begin) in enumerate(zip(passages, skips.tolist(), begins)):
        own = np.arange(len(passage) - window + 1)
        column = np.maximum(0, -(-(own - skip) // width))
        whole_columns = (own + window - skip) // width - column
        alike = own if often[number] > 1 else own[shared[begin + column] >= whole_columns]
        chosen.append(np.full(len(alike), number))
        starts.append(alike)
    which, start = np.concatenate(chosen), np.concatenate(starts)
    ends = np.cumsum([len(p) for p in passages])
    base = ends - [len(p) for p in passages]
    one, two = _window_hashes(b"".join(passages), window)
    place = base[which] + start
    classes = _equal(gram_class[which], start - leads[which], one[place], two[place])
    times = np.bincount(classes, weights=np.minimum(often, 2)[which])[classes] if len(classes) else classes
    which, start = which[times > 1], start[times > 1]
    if not len(which):
        return []
    new = np.nonzero((np.diff(which) != 0) | (np.diff(start) != 1))[0] + 1
    first, last = np.concatenate(([0], new)), np.concatenate((new, [len(which)])) - 1
    return list(zip(which[first].tolist(), start[first].tolist(), start[last].tolist()))


def _to_characters(text: bytes, gone: np.ndarray) -> np.ndarray:
    """``gone`` widened to all bytes of the UTF-8 characters that it cuts through."""
    character = np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)
    return (np.bincount(character, weights=gone) > 0)[character]


def remove_repeats(
    docs: DataFrame, window: int = 400, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
    whole_characters: bool = False,
) -> DataFrame:
    """(``id_col``, n_bytes, n_removed, n_spans, kept) per row: texts without the bytes that repeated strings cover.

    A string of ``window`` bytes of one text's UTF-8 is repeated if it also
    starts anywhere else. ``kept`` holds the other bytes, n_spans counts the
    runs removed. With ``whole_characters``, all bytes of a character that a
    run cuts through are removed with it.

    1. Every window has an anchor, the short string of least hash in it, which
       equal windows share. Anchors are counted over all blocks of documents,
       one row per block and distinct anchor.
    2. Around each occurrence of a recurring anchor lies a passage: the windows
       that have it, end to end. Passages are counted by 128-bit digests. An
       anchor whose passages are all the same needs no more.
    3. The different passages of other anchors go, once each, to shards by
       anchor, where suffix arrays find the windows they share. An anchor with
       more passages than a shard takes has its windows counted one by one.
    4. Blocks get the ranges of their repeated windows and drop the bytes.

    Null and empty texts have no bytes. Repeated rows repeat each other; null
    ids stay. The input is read several times and must give the same rows in
    the same order, as stored tables do; otherwise the job fails.
    """
    kind = docs.schema[id_col].dataType
    id_type = to_arrow_type(kind)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def count_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, _, texts in blocks(batches, block_bytes):
            read = Bytes(texts, window)
            places = np.unique(read.runs()[2])
            grams, first, often = np.unique(read.grams[places], return_index=True, return_counts=True)
            columns = [
                pa.array(np.append(grams.view(np.int64), key)), pa.array(np.full(len(grams) + 1, key)),
                # the last row shows that the block is the same in the next reading
                pa.array(np.append(places[first], -1)), pa.array(np.append(often, 2)),
            ]
            yield pa.record_batch(columns, ["gram", "block", "place", "n"])

    def find_passages(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows != 1 or not right.num_rows:
            raise ValueError("the input changed between two readings; store it first")
        row, places = left.to_pylist()[0], right.column("place").to_numpy()
        read = Bytes(unpack_texts(row), window)
        first, last, anchor = read.runs()
        here = np.isin(read.grams[anchor], read.grams[places[places >= 0]]) if len(anchor) else np.zeros(0, dtype=bool)
        first, last, anchor = first[here], last[here], anchor[here]
        digests = np.array(
            [
                xxhash.xxh3_128_digest(read.whole[a : b + window], seed=int(lead))
                for a, b, lead in zip(first.tolist(), last.tolist(), (anchor - first).tolist())
            ],
            dtype="S16",
        )
        halves = np.frombuffer(digests.tobytes(), dtype="<i8").reshape(-1, 2)
        return pa.table(
            {
                "one": halves[:, 0], "two": halves[:, 1], "gram": read.grams[anchor].view(np.int64), "block": np.full(len(first), row["block"]),
                "at": first, "lead": anchor - first, "size": last - first + 1,
            }
        )

    packed = source.mapInArrow(lambda b: pack_texts(b, block_bytes, id_type), packed_schema(kind))

    def per_block(rows: DataFrame, work, made: str | StructType) -> DataFrame:
        return packed.groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(lambda left, right: released(work(left, right)), made)

    found = source.mapInArrow(count_anchors, "gram long, block long, place long, n long")
    total = F.sum("n").over(Window.partitionBy("gram"))
    recurring = found.withColumn("total", total).where(F.col("total") >= 2).select("block", "place")
    passages = per_block(recurring, find_passages, "one long, two long, gram long, block long, at long, lead long, size long")
    passages = materialise(passages, "passages")
    kinds = materialise(
        passages.groupBy("one", "two", "gram", "lead", "size").agg(F.count("*").alias("n"), F.min(F.struct("block", "at")).alias("where")), "kinds"
    )
    per_gram = materialise(kinds.groupBy("gram").agg(F.count("*").alias("kinds")), "per-gram")
    kinds = kinds.join(per_gram, "gram")
    alone = kinds.where("kinds = 1 AND n > 1").select("one", "two", F.lit(0).cast("long").alias("first"), (F.col("size") - 1).alias("last"))

    def fetch(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows:
            return pa.table({**{c: pa.array([], right.schema.field(c).type) for c in carried}, "passage": pa.array([], pa.binary())})
        whole = b"".join(unpack_texts(left.to_pylist()[0]))
        cut = [whole[a : a + s + window - 1] for a, s in zip(right.column("at").to_pylist(), right.column("size").to_pylist())]
        return pa.table({**{c: right.column(c) for c in carried}, "passage": pa.array(cut, pa.binary())})

    carried = ["one", "two", "gram", "lead", "n"]

    def fetched(of: DataFrame) -> DataFrame:
        places = of.select(*carried, "size", "where.block", "where.at")
        return per_block(places, fetch, "one long, two long, gram long, lead long, n long, passage binary")

    def search(table: pa.Table) -> pa.Table:
        grams, leads, often = (table.column(c).to_numpy() for c in ("gram", "lead", "n"))
        ranges = repeated_starts(grams, leads, often, table.column("passage").to_pylist(), window)
        which = [r[0] for r in ranges]
        return pa.table(
            {
                "one": table.column("one").to_numpy()[which], "two": table.column("two").to_numpy()[which],
                "first": pa.array([r[1] for r in ranges], pa.int64()), "last": pa.array([r[2] for r in ranges], pa.int64()),
            }
        )

    def window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes = [h.view(np.int64) for h in _window_hashes(row["passage"], window)]
                start = np.arange(len(hashes[0]))
                same = [pa.array(np.full(len(start), row[c])) for c in ("gram", "one", "two", "n")]
                columns = [pa.array(start - row["lead"]), *map(pa.array, hashes), *same, pa.array(start)]
                yield pa.record_batch(columns, ["apart", "h1", "h2", "gram", "one", "two", "n", "start"])

    several = kinds.where((F.col("kinds") > 1) & (F.col("kinds") <= SHARD_PASSAGES))
    size = several.agg(F.sum(F.col("size") + window)).first()[0] or 0
    shard = F.pmod(F.xxhash64("gram"), F.lit(-(-size // SHARD_BYTES) or 1))
    ranges = "one long, two long, first long, last long"
    repeated = alone.unionByName(fetched(several).groupBy(shard.alias("shard")).applyInArrow(search, ranges))
    many = kinds.where(F.col("kinds") > SHARD_PASSAGES)
    if not many.isEmpty():
        windows = fetched(many).mapInArrow(window_rows, "apart long, h1 long, h2 long, gram long, one long, two long, n long, start long")
        windows = materialise(windows, "windows")
        counted = windows.groupBy("gram", "apart", "h1", "h2").agg(F.sum(F.least("n", F.lit(2))).alias("times")).where("times > 1")
        counted = materialise(counted.select("gram", "apart", "h1", "h2"), "counted")
        twice = windows.join(counted, ["gram", "apart", "h1", "h2"], "left_semi")
        repeated = repeated.unionByName(twice.select("one", "two", F.col("start").alias("first"), F.col("start").alias("last")))

    def drop(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows != 1:
            raise ValueError("the input changed between two readings; store it first")
        row = left.to_pylist()[0]
        texts = unpack_texts(row)
        gone = covered(sum(row["sizes"]), right.column("first").to_numpy(), right.column("last").to_numpy(), window)
        kept, removed, spans, at = [], [], [], 0
        for text in texts:
            flags = gone[at : at + len(text)]
            at += len(text)
            if whole_characters and not text.isascii():
                flags = _to_characters(text, flags)
            removed.append(int(flags.sum()))
            spans.append(int(flags[:1].sum() + (flags[1:] & ~flags[:-1]).sum()))
            kept.append(np.frombuffer(text, dtype=np.uint8)[~flags].tobytes() if removed[-1] else text)
        counts = [pa.array(c, pa.int64()) for c in (row["sizes"], removed, spans)]
        return pa.table([pa.array(row["ids"], id_type), *counts, pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    repeated = materialise(repeated, "repeated")
    ends = passages.join(repeated, ["one", "two"]).select(
        "block", (F.col("at") + F.col("first")).alias("first"), (F.col("at") + F.col("last")).alias("last")
    )
    made = StructType([StructField("id", kind)]).add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    out = per_block(ends, drop, made.add("kept", "binary"))
    return out.withColumnRenamed("id", id_col)
