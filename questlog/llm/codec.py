"""Byte-level BPE encoding and decoding over a global shuffle of distinct pre-tokens."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import StructType

from questlog.llm.blocks import blocks
from questlog.llm.pretokens import cut, pre_tokens

#: Bytes of text after which a block of rows is closed; one block is one task's memory.
BLOCK_BYTES = 32 << 20


def read_ranks(rank_file: str) -> dict[bytes, int]:
    """Token bytes to id."""
    with open(rank_file, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def token_table(rank_file: str) -> pa.Array:
    """Bytes of every id; its size is the vocabulary's."""
    ranks = read_ranks(rank_file)
    table: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return pa.array(table, pa.large_binary())


def _words(texts: list[bytes], pattern) -> list[str]:
    """Distinct pre-tokens in order."""
    whole: set[str] = set()
    after: set[str] = set()
    for text in texts:
        parts, spaced = cut(text.decode())
        whole.update(parts)
        after.update(spaced)
    words = {w for part in whole for w in pre_tokens(part, pattern.findall)}
    words.update(w for part in after for w in pre_tokens(" " + part, pattern.findall))
    return sorted(words)


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key) -> int:
        self[key] = found = len(self)
        return found


def _places(texts: list[bytes], pattern) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pre-tokens in order; for each text the places of its pre-tokens among them, end to end, and how many they are."""
    whole, after = _Numbers(), _Numbers()
    sequences = []
    for text in texts:
        # parts are even numbers, those given without their space odd ones
        parts, spaced = cut(text.decode())
        own = np.empty(len(parts) + len(spaced), dtype=np.uint32)
        own[: len(parts)] = np.fromiter(map(whole.__getitem__, parts), dtype=np.uint32, count=len(parts))
        own[: len(parts)] *= 2
        own[len(parts) :] = np.fromiter(map(after.__getitem__, spaced), dtype=np.uint32, count=len(spaced))
        own[len(parts) :] *= 2
        own[len(parts) :] += 1
        sequences.append(own)
    index = _Numbers()
    split = []
    for kind, lead in ((whole, ""), (after, " ")):
        found = [pre_tokens(lead + part, pattern.findall) for part in kind]
        kind.clear()
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        split.append((np.fromiter(map(index.__getitem__, chain.from_iterable(found)), dtype=np.uint32, count=int(sizes.sum())), sizes))
    words = sorted(index)
    place = np.empty(len(words), dtype=np.uint32)
    place[np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words))] = np.arange(len(words), dtype=np.uint32)
    flat = place[np.concatenate([numbers for numbers, _ in split])]
    sizes = np.concatenate([sizes for _, sizes in split])
    starts = np.cumsum(sizes) - sizes
    first_spaced = len(split[0][1])
    places = []
    for own in sequences:
        part = (own >> 1) + (own & 1) * np.uint32(first_spaced)
        each = sizes[part]
        total = int(each.sum())
        if total == len(part):
            places.append(flat[starts[part]])
        else:
            shift = np.repeat(starts[part] - (np.cumsum(each) - each), each)
            places.append(flat[shift + np.arange(total)])
    return words, np.concatenate(places), np.array([len(p) for p in places], dtype=np.int64)


def _press(numbers: np.ndarray) -> bytes:
    """Compressed 32-bit numbers; low and high bytes apart compress better."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(planes)


def _unpress(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).reshape(-1).view("<u4")


def encode(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    block_bytes: int = BLOCK_BYTES, finish=None, finished: str = "ids array<int>, decoded binary",
) -> DataFrame:
    """(id, n_tokens, then what ``finish`` makes of ids and decoded bytes) per row of ``docs``.

    Texts split into pre-tokens by ``pattern``. The distinct ones of each block
    of rows go, with their place in the block, to one shuffle by pre-token, so
    that each is encoded once; ids return to their block, where they are put
    back by position. Decoding joins ids to the token-byte table. No row holds
    more than a block's distinct pre-tokens, however frequent one is: it comes
    once from each block.

    A null text counts as empty: no ids. Repeated rows and null ids stay. The
    input is read twice and must give the same rows in the same order, as
    stored tables do; otherwise a block finds no ids and the job fails.
    ``finish(ids, token_strings, decoded)`` gets a row's ids as an array, the
    decimal ids joined by spaces, and the decoded bytes.
    """
    kind, id_type = docs.schema[id_col].dataType.simpleString(), to_arrow_type(docs.schema[id_col].dataType)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    finish = finish or (lambda ids, joined, decoded: (ids.tolist(), decoded))

    def compiled():
        return regex.compile(pattern)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct pre-tokens of each block with their places."""
        find = compiled()
        for key, _, texts in blocks(batches, block_bytes):
            words = _words(texts, find)
            for at in range(0, len(words), 50_000):
                part = words[at : at + 50_000]
                yield pa.record_batch(
                    [pa.array(np.full(len(part), key)), pa.array(np.arange(at, at + len(part), dtype=np.int32)), pa.array(part, pa.string())],
                    ["block", "place", "word"],
                )

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each block's rows with the places of their pre-tokens, in order."""
        find = compiled()
        for key, ids, texts in blocks(batches, block_bytes):
            words, places, sizes = _places(texts, find)
            # frequent pre-tokens get the small numbers, which press well; equally frequent ones stay in order
            order = np.argsort(-np.bincount(places, minlength=len(words)), kind="stable").astype(np.uint32)
            number = np.empty(len(words), dtype=np.uint32)
            number[order] = np.arange(len(words), dtype=np.uint32)
            steps = np.diff(order, prepend=np.uint32(0))
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([key]), "ids": pa.array([ids], pa.list_(id_type)), "sizes": pa.array([sizes]),
                    "words": pa.array([len(words)], pa.int32()), "places": pa.array([_press(number[places])], pa.binary()),
                    "steps": pa.array([_press(steps)], pa.binary()),
                }
            )

    ranks = max(read_ranks(rank_file).values())
    width = np.dtype("<u2" if ranks < 1 << 16 else "<u4")

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of each pre-token; equal ones come one after another."""
        encoder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(rank_file), special_tokens={})
        last, codes = None, b""
        for batch in batches:
            found = []
            for word in batch.column("word").to_pylist():
                if word != last:
                    last, codes = word, np.array(encoder.encode_ordinary(word), dtype=width).tobytes()
                found.append(codes)
            yield pa.record_batch([batch.column("block"), batch.column("place"), pa.array(found, pa.binary())], ["block", "place", "codes"])

    def reassemble(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        table = token_table(rank_file)
        rows = {name: [] for name in ("id", "n_tokens", *names)}
        order = np.argsort(right.column("place").to_numpy())
        codes = right.column("codes").take(pa.array(order)).to_pylist()
        lengths = np.array([len(c) // width.itemsize for c in codes], dtype=np.int64)
        flat = np.frombuffer(b"".join(codes), dtype=width).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        joined = [" ".join(map(str, np.frombuffer(c, dtype=width).tolist())) for c in codes]
        for block in left.to_pylist():
            if block["words"] != len(codes):
                raise ValueError("the input changed between two readings; store it first")
            order = np.cumsum(_unpress(block["steps"]), dtype=np.uint32)
            places = order[_unpress(block["places"])]
            at = 0
            for row, size in zip(block["ids"], block["sizes"]):
                own = places[at : at + size]
                at += size
                count_each = lengths[own]
                total = int(count_each.sum())
                shift = np.repeat(starts[own] - np.concatenate(([0], np.cumsum(count_each)))[:-1], count_each)
                ids = flat[shift + np.arange(total)]
                decoded = table.take(pa.array(ids))
                ends = np.frombuffer(decoded.buffers()[1], dtype=np.int64)
                data = decoded.buffers()[2]
                raw = data.to_pybytes()[ends[0] : ends[total]] if total else b""
                text = " ".join(map(joined.__getitem__, own.tolist()))
                for name, value in zip(rows, (row, total, *finish(ids, text, raw))):
                    rows[name].append(value)
        return pa.table({n: pa.array(v, schema.field(n).type) for n, v in rows.items()}, schema=schema)

    out_ddl = f"id {kind}, n_tokens long, {finished}"
    out_schema = StructType.fromDDL(out_ddl)
    names, schema = [f.name for f in out_schema][2:], to_arrow_schema(out_schema)
    words = source.mapInArrow(spread, "block long, place int, word string")
    sorted_words = words.repartition("word").sortWithinPartitions("word")
    back = sorted_words.mapInArrow(encode_words, "block long, place int, codes binary")
    placed = source.mapInArrow(positions, f"block long, ids array<{kind}>, sizes array<long>, words int, places binary, steps binary")
    out = placed.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(reassemble, out_ddl)
    return out.withColumnRenamed("id", id_col)
