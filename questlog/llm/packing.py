"""Packing documents into sequences of a fixed number of tokens, by linear grouping."""

from __future__ import annotations

import string
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Collection, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer
from tokenizers.normalizers import Sequence

from questlog.llm.blocks import released
from questlog.llm.pretokens import KEPT_CHARS, KEPT_PARTS
from questlog.session import materialise

#: Id after each document.
END = 0
#: Letters, signs and white space that the tokenizer's rules and Python's agree on; other texts go to it whole.
ODD = "[^\t\n\r\x20-\x7e\xa1-\u012f\u0131-\u02ff]|<\\|"
#: Signs that the tokenizer cuts from letters before them; any number of them go together.
SIGNS = string.punctuation
#: Bytes of text whose new words are encoded together, and words of one call.
LEARN_BYTES, CALL_WORDS = 2 << 20, 200
#: Numbers of equal groups of large lengths that are tried; the packing of fewest sequences is taken.
GROUPS = (32, 128, 512)
#: Lengths above this part of a sequence are large: at most three fit together.
LARGE_PART = 4


class Words(dict):
    """The ids, as bytes, of words that the tokenizer was asked for; a bounded number is kept.

    The words are lower-cased, without white space and of the characters that
    ``ODD`` leaves, which the tokenizer's normaliser would not change, so it is
    taken out. The tokenizer is this object's own from then on.
    """

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        tokenizer.normalizer = Sequence([])
        added = tokenizer.get_added_tokens_decoder()
        #: A special token, at which the tokenizer cuts a text before all else: what lies between two is encoded apart.
        self.mark = next(((n, t.content) for n, t in sorted(added.items()) if t.special), None)
        suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
        #: Whether an id ends a pre-token, where the vocabulary shows it.
        self.ends = np.zeros(tokenizer.get_vocab_size(), dtype=bool) if suffix else None
        if suffix:
            self.ends[[n for token, n in tokenizer.get_vocab(with_added_tokens=False).items() if token.endswith(suffix)]] = True

    def __missing__(self, word: str) -> bytes:
        core = word.rstrip(SIGNS)
        if core != word and core.isalpha():
            # letters and the signs after them are encoded apart by the vocabulary too
            return self[core] + self[word[len(core) :]]
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _encode(self, words: list[str], between: str) -> None:
        """Many words by one call: letters only with spaces between, as each is a pre-token; others at marks."""
        number, mark = self.mark
        for start in range(0, len(words), CALL_WORDS):
            own = words[start : start + CALL_WORDS]
            # the form that does not follow places in the text, which nothing here asks for
            found = self.tokenizer.encode_batch_fast([between + between.join(own)], add_special_tokens=False)[0]
            ids = np.array(found.ids, dtype="<u4")
            if between == mark:
                at = np.nonzero(ids == number)[0]
                first, last = at + 1, np.append(at[1:], len(ids))
            else:
                last = np.nonzero(self.ends[ids])[0] + 1
                first = np.append([0], last[:-1])
            if len(last) != len(own) or last[-1] != len(ids):
                raise ValueError("the tokenizer does not cut texts at spaces and special tokens")
            raw = ids.tobytes()
            for word, begin, end in zip(own, (4 * first).tolist(), (4 * last).tolist()):
                self[word] = raw[begin:end]

    def learn(self, words: Collection[str]) -> None:
        """Keep the ids of these words, but for very long ones and those that hold the mark; signs after letters apart."""
        if not self.mark:
            return
        signed = {w: core for w in words if not w.isalpha() and (core := w.rstrip(SIGNS)).isalpha()}
        parts = {*signed.values(), *(w[len(core) :] for w, core in signed.items()), *(w for w in words if w not in signed)}
        new = parts.difference(self)
        if len(self) + len(new) > KEPT_PARTS:
            self.clear()
            new = parts
        new = {w for w in new if len(w) <= KEPT_CHARS and self.mark[1] not in w}
        letters = {w for w in new if w.isalpha()} if self.ends is not None else set()
        self._encode(list(letters), " ")
        self._encode(list(new - letters), self.mark[1])

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, of words as above but in any case; each different word is looked up once."""
        words = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn(distinct)
        found = [self[w] for w in distinct]
        table = np.frombuffer(b"".join(found), dtype="<u4")
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        which = coded.indices.to_numpy()
        # where each word's ids begin in the table and in the row of all ids
        counts = sizes[which]
        ends = np.append(0, np.cumsum(counts))
        ids = table[np.repeat((np.cumsum(sizes) - sizes)[which] - ends[:-1], counts) + np.arange(ends[-1])]
        bounds = ends[words.offsets.to_numpy()].tolist()
        return (ids[begin:end] for begin, end in zip(bounds, bounds[1:]))


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, part, number) of every piece of up to ``capacity`` ids.

    A document is its ids without special tokens and then id 0; a null text is
    empty. ``number`` counts the pieces of one length within one task, ``part``.
    The vocabulary lower-cases and drops white space, so words are encoded
    apart, and a worker keeps a bounded number of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, numbers = TaskContext.get().partitionId(), defaultdict(int)
        # most tasks meet no text that needs the whole tokenizer
        whole = cache(lambda: Tokenizer.from_file(tokenizer_file))

        kept, end = Words(Tokenizer.from_file(tokenizer_file)), np.array([END], dtype="<u4").tobytes()

        def texts(column: pa.Array) -> Iterator[bytes]:
            """The ids of each text, few texts at a time, so that new words go to the tokenizer together."""
            column = column.fill_null("")
            share = np.cumsum(pc.binary_length(column).to_numpy(), dtype=np.int64) // LEARN_BYTES
            cuts = [0, *(np.nonzero(np.diff(share))[0] + 1).tolist(), len(column)]
            for first, last in zip(cuts, cuts[1:]):
                own = column.slice(first, last - first)
                odd = pc.match_substring_regex(own, ODD)
                plain = kept.encode(pc.if_else(odd, "", own))
                for strange, text, ids in zip(odd.to_pylist(), own, plain):
                    if strange:
                        ids = np.array(whole().encode(text.as_py(), add_special_tokens=False).ids, dtype="<u4")
                    yield ids.tobytes()

        for batch in batches:
            rows: list[list] = [[] for _ in range(6)]
            origin = []
            for at, ids in enumerate(texts(batch.column(1))):
                ids += end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[start : start + 4 * capacity]
                    length = len(own) // 4
                    origin.append(at)
                    for column, x in zip(rows, (piece, start // 4, length, zlib.crc32(own), part, numbers[length])):
                        column.append(x)
                    numbers[length] += 1
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.record_batch(
                [batch.column(0).take(pa.array(origin, pa.int64())), *[pa.array(x, k) for x, k in zip(rows, kinds)]],
                ["id", "piece", "start", "length", "ids_crc32", "part", "number"],
            )
        kept.clear()
        released()

    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long, part int, number long")


Place = tuple[int, int, int, int, int]


class _Shelf:
    """Items of one group, longest first, as runs of equal length."""

    def __init__(self, size: int):
        self.size, self.runs, self.left = size, [], 0

    def add(self, length: int, rank: int, count: int) -> None:
        self.runs.append([length, rank, count])
        self.left += count

    def take(self, count: int) -> list[tuple[int, int, int]]:
        self.left -= count
        out = []
        while count:
            run = self.runs[0]
            some = min(count, run[2])
            out.append((run[0], run[1], some))
            run[1] += some
            run[2] -= some
            count -= some
            if not run[2]:
                self.runs.pop(0)
        return out


def _shelves(counts: dict[int, int], groups: int) -> list[_Shelf]:
    """Equal shares of the items in descending length; a share's size is its longest item."""
    total = sum(counts.values())
    share = max(1, -(-total // groups))
    shelves: list[_Shelf] = []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            if not shelves or shelves[-1].left == share:
                shelves.append(_Shelf(length))
            some = min(left, share - shelves[-1].left)
            shelves[-1].add(length, rank, some)
            rank, left = rank + some, left - some
    return shelves


def _best_company(room: int, sizes: list[int], left: list[int]) -> list[int]:
    """Indexes of at most two sizes (ascending, ``left`` of each) that fill ``room`` best."""
    best, found = 0, []
    high = bisect_right(sizes, room) - 1
    while high >= 0 and not left[high]:
        high -= 1
    if high >= 0:
        best, found = sizes[high], [high]
    low = 0
    while low <= high:
        together = sizes[low] + sizes[high]
        if not left[low]:
            low += 1
        elif together > room or not left[high] or (low == high and left[low] < 2):
            high -= 1
        else:
            if together > best:
                best, found = together, [low, high]
            low += 1
    return found


def _packed(counts: dict[int, int], capacity: int, groups: int) -> tuple[list[Place], int]:
    large = {n: c for n, c in counts.items() if n > capacity // LARGE_PART}
    places: list[Place] = []
    spare: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room left: (first sequence, count)
    used = 0

    shelves = _shelves(large, groups)[::-1]
    sizes, left = [s.size for s in shelves], [s.left for s in shelves]
    for top in reversed(range(len(shelves))):
        while left[top]:
            left[top] -= 1
            config = [top, *_best_company(capacity - sizes[top], sizes, left)]
            left[top] += 1
            each = {g: config.count(g) for g in config}
            times = min(left[g] // each[g] for g in each)
            for g in each:
                left[g] -= times * each[g]
            slots = [shelves[g].take(times) for g in config]
            cuts = sorted({0, times, *(c for slot in slots for c in np.cumsum([n for _, _, n in slot]).tolist())})
            for begin, end in zip(cuts, cuts[1:]):
                offset = 0
                for slot in slots:
                    at = 0
                    for length, rank, n in slot:
                        if at <= begin < at + n:
                            places.append((length, rank + begin - at, end - begin, used + begin, offset))
                            offset += length
                            break
                        at += n
                spare[capacity - offset].append((used + begin, end - begin))
            used += times

    for length in sorted((n for n in counts if n not in large), reverse=True):
        rank, remaining, room = 0, counts[length], length
        while remaining:
            while room <= capacity and not spare[room]:
                room += 1
            if room > capacity:
                each = capacity // length
                opened = -(-remaining // each)
                spare[capacity].append((used, opened))
                used += opened
                room = capacity
                continue
            first, n = spare[room].pop()
            some = min(n, remaining)
            places.append((length, rank, some, first, capacity - room))
            if n > some:
                spare[room].append((first + some, n - some))
            spare[room - length].append((first, some))
            rank, remaining = rank + some, remaining - some
            room = min(room, max(length, room - length))
    return places, used


def plan(counts: dict[int, int], capacity: int) -> tuple[list[Place], int]:
    """Where the items of each length go: runs (length, first rank, items, first sequence, offset); and the sequences.

    Large lengths are shared out in equal groups and rounded up to their
    group's longest, so that few sizes are left; for the largest size left the
    best filling company is found and used as often as it can be. Actual
    lengths then take the groups' places, which frees the rounded-up room, and
    small lengths go, longest first, where the least room is left that holds
    them. Works on counts per length, so its size depends on ``capacity`` only.
    """
    return min((_packed(counts, capacity, g) for g in GROUPS), key=lambda found: found[1])


def pack(
    docs: DataFrame, tokenizer_file: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Every row of ``docs`` is packed, repeated rows and null ids too; a null or
    empty text is one id long. Pieces of one length are interchangeable: they
    are numbered task by task with running offsets, without gathering them,
    and a table of runs, bounded by ``capacity``, gives each number its place.
    """
    items = materialise(pieces(docs, tokenizer_file, capacity, id_col, text_col), "pieces")
    shares = materialise(items.groupBy("part", "length").agg(F.count("*").alias("items")), "shares")
    counts = {r["length"]: r["items"] for r in shares.groupBy("length").agg(F.sum("items").alias("items")).collect()}
    places, _ = plan(counts, capacity)
    table = np.array(sorted(places) or np.zeros((0, 5)), dtype=np.int64).reshape(-1, 5)

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(shares.select("part", "length", F.coalesce(F.sum("items").over(before), F.lit(0)).alias("before")), "offsets")
    id_type = to_arrow_type(docs.schema[id_col].dataType)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = np.empty(len(table), dtype=[("length", np.int64), ("rank", np.int64)])
        firsts["length"], firsts["rank"] = table[:, 0], table[:, 1]
        for batch in batches:
            wanted = np.empty(batch.num_rows, dtype=firsts.dtype)
            wanted["length"], wanted["rank"] = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            run = table[np.searchsorted(firsts, wanted, side="right") - 1]
            yield pa.record_batch(
                [
                    batch.column("id").cast(id_type), *[batch.column(c) for c in ("piece", "start", "length", "ids_crc32")],
                    pa.array(run[:, 3] + wanted["rank"] - run[:, 1]), pa.array(run[:, 4]),
                ],
                ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = items.join(offsets, ["part", "length"]).withColumn("rank", F.col("number") + F.col("before"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = ranked.select("id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return out.withColumnRenamed("id", id_col)
