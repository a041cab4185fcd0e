"""Consecutive rows of a stored table as blocks of bounded size, and anchors that equal windows share."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import SparkSession
from pyspark.sql.types import ArrayType, DataType, LongType, StructType

#: Bits of an anchor's key that hold its place in the block.
PLACE_BITS = 32
#: Bytes of rows that go to a Python worker at once.
BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Has this session hand rows to Python in batches of at most ``most`` bytes from here on.

    Spark's own bounds are 10,000 rows and 64 MB: both sides of the pipe hold
    such a batch, and keep its pages for later ones. A row is never cut.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def released(made=None):
    """Hands ``made`` on, after giving back to the system what this worker has freed.

    A worker goes on to tasks of other stages, and the C library would keep
    the freed pages of large steps for it.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)
    return made


def blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[int, list, list[bytes]]]:
    """(key, ids, texts) of about ``block_bytes`` each, from batches of (id, text as binary); null texts are empty.

    The key is a hash of the block's place and text, so rows made from another
    reading of the input meet only if both readings gave the same block.
    """
    from pyspark import TaskContext

    place, numbers = TaskContext.get().partitionId(), count()
    ids: list = []
    texts: list[bytes] = []
    size, digest = 0, xxhash.xxh64()

    def key() -> int:
        digest.update(f"{place}/{next(numbers)}/{len(texts)}".encode())
        return int(np.uint64(digest.intdigest()).view(np.int64))

    for batch in batches:
        for row, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = value.as_py() or b""
            ids.append(row)
            texts.append(raw)
            digest.update(raw)
            digest.update(len(raw).to_bytes(8, "little"))
            size += len(raw) + 64
            if size >= block_bytes:
                yield key(), ids, texts
                ids, texts, size, digest = [], [], 0, xxhash.xxh64()
    if ids:
        yield key(), ids, texts


def pack_texts(batches: Iterator[pa.RecordBatch], block_bytes: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """A row (block, ids, sizes, texts) for each block, its texts end to end and compressed."""
    press = zstandard.ZstdCompressor(level=4)
    for key, ids, texts in blocks(batches, block_bytes):
        columns = [
            pa.array([key]), pa.array([ids], pa.list_(id_type)), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
            pa.array([press.compress(b"".join(texts))], pa.binary()),
        ]
        yield pa.record_batch(columns, ["block", "ids", "sizes", "texts"])


def packed_schema(id_kind: DataType) -> StructType:
    """Columns of the rows that ``pack_texts`` makes."""
    return StructType().add("block", "long").add("ids", ArrayType(id_kind)).add("sizes", ArrayType(LongType())).add("texts", "binary")


def unpack_texts(row: dict) -> list[bytes]:
    """The texts of a row that ``pack_texts`` made."""
    whole, ends = zstandard.ZstdDecompressor().decompress(row["texts"]), np.cumsum(row["sizes"]).tolist()
    return [whole[end - size : end] for size, end in zip(row["sizes"], ends)]


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


#: Different runs of 1,024 and more symbols exist whose hashes modulo 2**64 are equal for every base;
#: runs from here on are hashed modulo two primes as well.
LONG_RUN = 512
PRIMES = (2147483647, 2147483629)


def _prime_powers(base: int, n: int, prime: int) -> np.ndarray:
    """1, base, base**2, ... modulo a prime below 2**31."""
    out = np.ones(n + 1, dtype=np.uint64)
    done = 1
    while done <= n:
        part = out[done : 2 * done]
        part[:] = out[: len(part)] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
        done *= 2
    return out


class Rolling:
    """Polynomial hashes of any run of ``symbols`` (uint64, already hashed).

    Modulo 2**64, and modulo two primes too if runs of up to ``longest``
    symbols, ``LONG_RUN`` or more, are to be asked for.
    """

    def __init__(self, symbols: np.ndarray, base: int = 0x9E3779B97F4A7C15, longest: int = 0):
        n = len(symbols)
        self.longest = longest
        self.back = _powers(pow(base, -1, 1 << 64), n)
        self.sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(symbols * _powers(base, n)[:n], dtype=np.uint64)))
        self.residues = []
        for prime in PRIMES if longest >= LONG_RUN else ():
            own = base % prime
            steps = symbols % np.uint64(prime) * _prime_powers(own, n, prime)[:n] % np.uint64(prime)
            sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(steps, dtype=np.uint64)))
            self.residues.append((np.uint64(prime), sums, _prime_powers(pow(own, -1, prime), n, prime)))

    def runs(self, length: int) -> np.ndarray:
        """Hash of the run of ``length`` symbols at each start."""
        if LONG_RUN <= length and self.longest < LONG_RUN:
            raise ValueError("runs of this length need the hashes modulo primes")
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        found = (self.sums[length:] - self.sums[:n]) * self.back[:n]
        if length >= LONG_RUN:
            for prime, sums, back in self.residues:
                found *= np.uint64(0x94D049BB133111EB)
                found += (sums[length:] - sums[:n]) % prime * back[:n] % prime
        found ^= found >> np.uint64(29)
        found *= np.uint64(0xBF58476D1CE4E5B9)
        found ^= found >> np.uint64(32)
        return found


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(pieces: np.ndarray, window_pieces: int) -> np.ndarray:
    """Place of the anchor of every window: its piece of least hash, the first of equal ones.

    ``pieces`` are hashes of runs at each start, ``window_pieces`` how many lie
    in a window. Equal windows have the same anchor at the same distance.
    """
    mask = np.uint64((1 << PLACE_BITS) - 1)
    keys = (pieces & ~mask) | np.arange(len(pieces), dtype=np.uint64)
    return (sliding_minimum(keys, window_pieces) & mask).astype(np.int64)


def inside(sizes: np.ndarray, length: int) -> np.ndarray:
    """True at starts of runs of ``length`` symbols that end in the text they start in."""
    total = int(sizes.sum())
    ends = np.repeat(np.cumsum(sizes), sizes)
    return (np.arange(total) + length <= ends)[: max(0, total - length + 1)]


def covered(total: int, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """True at symbols that a run of ``length`` starting in any of the ranges first to last covers."""
    steps = np.zeros(total + 1, dtype=np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, np.minimum(last + length, total), -1)
    return np.cumsum(steps[:-1]) > 0
