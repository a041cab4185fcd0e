"""Prefix trie of conversations: who shares which first turns, by shards of sorted paths and a skeleton between them."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questlog.session import materialise

#: Bytes that stand for a turn in a path: the first half of a SHA-256.
TURN_BYTES = 16
#: Sampled paths for each shard, from which the splitters between shards are taken.
SAMPLE_PER_SHARD = 16
#: Turns of a splitter that no other splitter shares as a whole; shorter ones are as good a border.
SPLITTER_TURNS = 32
#: Characters of ids that a shard hands on in one row.
CHUNK_CHARS = 1 << 20
#: Nodes of one Arrow batch.
BATCH_ROWS = 10_000

NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_EMPTY = hashlib.sha256().hexdigest()


def rebuilt_paths(conversations: DataFrame, most_shared: int = 6, block: int = 100) -> DataFrame:
    """(conv_id, path, chars): each conversation's rebuilt turns, 16 bytes and a length in code points for each.

    Conversation c starts with the first h turns of conversation ``c - c %
    block`` as far as there are any, and goes on with its own turns after its
    first h; h is the unsigned crc32 of c in decimal modulo ``most_shared``.
    Turns go by number, null first; turns of one number by the SHA-256 of role
    and text. Null roles and texts are empty. Rows without a conversation id
    belong to no conversation. Only digests are gathered, 40 bytes a turn, one
    row a conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), F.unhex(F.substring(digest, 1, 2 * TURN_BYTES)).alias("digest"), F.length(text).alias("chars")).alias("of"),
    )
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("of")).alias("turns"))
    own = materialise(own, "conversations")
    heads = own.where(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, max(1, most_shared - 1)).alias("head"))
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most_shared
    joined = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % block).withColumn("h", shared.cast("int")).join(heads, "base", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.filter("turns", lambda t: F.lit(False)))
    whole = F.concat(head, F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))))
    path = F.unhex(F.array_join(F.transform(whole, lambda t: F.hex(t["digest"])), ""))
    return joined.select("conv_id", path.alias("path"), F.transform(whole, lambda t: t["chars"]).alias("chars"))


class Skeleton:
    """The trie of the splitter paths: every node that members of several shards can share.

    Members of a node are neighbours in the order of (path, id). If some lie
    before a splitter and some behind, the splitter starts with the node's
    path too, so the node is here. All others are whole in one shard.
    """

    def __init__(self, splitters: list[tuple[bytes, list[int]]]):
        self.children: dict[tuple[int, bytes], int] = {}
        self.rows: list[dict] = [{"node": 0, "parent": None, "depth": 0, "chars": 0, "below": 0, "upward": [0]}]
        for path, chars in splitters:
            at = 0
            for depth in range(len(path) // TURN_BYTES):
                turn = path[depth * TURN_BYTES : (depth + 1) * TURN_BYTES]
                if (at, turn) not in self.children:
                    node = self.children[at, turn] = len(self.rows)
                    self.rows[at]["below"] += 1
                    upward = [*self.rows[at]["upward"], node]
                    self.rows.append({"node": node, "parent": at, "depth": depth + 1, "chars": chars[depth], "below": 0, "upward": upward})
                at = self.children[at, turn]


class _Node:
    """An open node of the path being read: what is known of its members and subtree so far."""

    __slots__ = ("skeleton", "chars", "least", "members", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, skeleton: int | None, chars: int):
        self.skeleton, self.chars = skeleton, chars
        self.least: int | None = None
        self.members = self.children = self.leaves = self.saved = 0
        self.ends = None
        self.waiting: list[tuple] = []


_SHARD_ROWS = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, kind int, node int, shard int, chunk int, ids string"
)
_WHOLE, _PART, _ENDS = 0, 1, 2
_TYPES = [pa.int64()] * 7 + [pa.string()] + [pa.int32()] * 4 + [pa.string()]
_NAMES = [c.split()[0] for c in _SHARD_ROWS.split(", ")]


class _Shard:
    """Reads one shard's paths in order and gives its nodes as rows: whole ones, and parts of skeleton nodes."""

    def __init__(self, number: int, skeleton: dict[tuple[int, bytes], int]):
        self.number, self.skeleton = number, skeleton
        self.open: list[_Node] = []
        self.path = b""
        self.rows: list[tuple] = []

    def read(self, conv: int, path: bytes, chars: list[int]) -> None:
        if not self.open:
            self.open.append(_Node(0, 0))
        alike, most = 0, min(len(path), len(self.path))
        while alike < most and path[alike : alike + TURN_BYTES] == self.path[alike : alike + TURN_BYTES]:
            alike += TURN_BYTES
        while len(self.open) - 1 > alike // TURN_BYTES:
            self._close()
        for depth in range(alike // TURN_BYTES, len(path) // TURN_BYTES):
            above = self.open[-1]
            known = None
            if above.skeleton is not None:
                known = self.skeleton.get((above.skeleton, path[depth * TURN_BYTES : (depth + 1) * TURN_BYTES]))
            if known is None:
                above.children += 1
            self.open.append(_Node(known, chars[depth]))
        self.path = path
        node = self.open[-1]
        node.members += 1
        node.least = conv if node.least is None else min(node.least, conv)
        self._end(node, conv)

    def _end(self, node: _Node, conv: int) -> None:
        """Adds a member that ends at the node; they come by ascending id."""
        if node.skeleton is not None:
            if node.ends is None:
                node.ends = [0, [], 0]  # chunk, its ids, their characters
            text = str(conv)
            node.ends[1].append(text)
            node.ends[2] += len(text) + 1
            if node.ends[2] >= CHUNK_CHARS:
                self._chunk(node)
        elif node.ends is None:
            node.ends = hashlib.sha256(b"%d" % conv)
        else:
            node.ends.update(b",%d" % conv)

    def _chunk(self, node: _Node) -> None:
        chunk, ids, _ = node.ends
        if ids:
            self.rows.append((None,) * 8 + (_ENDS, node.skeleton, self.number, chunk, ",".join(ids)))
            node.ends = [chunk + 1, [], 0]

    def _close(self) -> None:
        node, depth = self.open.pop(), len(self.open)
        above = self.open[-1] if self.open else None
        if node.skeleton is None:
            node.leaves += node.children == 0
            node.saved += (node.members - 1) * node.chars
            ends = node.ends.hexdigest() if node.ends else _EMPTY
            tail = node.members, node.children, node.leaves, node.saved, ends, _WHOLE
            if above.skeleton is None:
                above.waiting.append((node.least, depth, tail))
            else:
                self.rows.append((node.least, depth, None, *tail, above.skeleton, None, None, None))
            # the children wait for their parent's least member
            for least, below, tail in node.waiting:
                self.rows.append((least, below, node.least, *tail, None, None, None, None))
        else:
            if node.ends:
                self._chunk(node)
            self.rows.append(
                (node.least, depth, None, node.members, node.children, node.leaves, node.saved, None, _PART, node.skeleton, self.number, None, None)
            )
        if above:
            above.members += node.members
            above.least = node.least if above.least is None else min(above.least, node.least)
            above.leaves += node.leaves
            above.saved += node.saved

    def finish(self) -> None:
        while self.open:
            self._close()

    def taken(self) -> pa.RecordBatch:
        """The rows so far as a batch."""
        columns = list(zip(*self.rows)) or [()] * len(_NAMES)
        self.rows = []
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _TYPES)], _NAMES)


def _splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int, list[int]]]:
    """Borders (path, conv_id, chars) between shards, at equal steps of a sorted sample of about 16 paths a shard.

    The driver sees the sample once and keeps a path a shard. Of a path that
    several borders share all turns stay, as only ids divide its members; of
    others the first 32.
    """
    every = max(1, paths.count() // (SAMPLE_PER_SHARD * shards))
    sample = paths.where(F.pmod(F.xxhash64("conv_id"), F.lit(every)) == 0)
    size = sample.count()
    places = {size * n // shards for n in range(1, shards)}
    rows = sample.orderBy("path", "conv_id").select("path", "conv_id", "chars").toLocalIterator()
    chosen = [(bytes(r["path"]), r["conv_id"], r["chars"]) for n, r in enumerate(rows) if n in places]
    shared = {a[0] for a, b in zip(chosen, chosen[1:]) if a[0] == b[0]}
    cut = [(p if p in shared else p[: SPLITTER_TURNS * TURN_BYTES], c, chars) for p, c, chars in chosen]
    return sorted({(p, c): (p, c, chars) for p, c, chars in cut}.values())


def prefix_trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """A row per node of the trie of (conv_id, path, chars), conversation ids being unique; see ``NODE_COLUMNS``.

    A node is a different sequence of first turns, its members the
    conversations that start with it; subtrees include their top. ``conv_id``
    is the least member, ``parent_conv_id`` the parent's (null at the root),
    ``n_children`` and ``n_leaves`` count children and childless nodes of the
    subtree, ``saved_tokens`` sums (members - 1) times the code points of the
    last turn over the subtree, ``ends_sha256`` digests the ids of the members
    that have no further turn, ascending and joined by commas.

    1. Splitters of a sample cut the order of (path, id) into shards of like
       size; ids also divide the copies of one path. Their trie, the skeleton,
       is broadcast: at most 32 nodes a shard, and the turns of paths that
       hold several shards.
    2. Each shard is sorted and read once. Nodes outside the skeleton are
       whole there; of the skeleton's nodes it gives parts.
    3. Parts are summed by node; then each skeleton node adds what its own
       skeleton descendants are. Ids of ends travel in chunks and are hashed
       in order as they stream by.

    A task holds its open path and the closed children of open nodes, of its
    shard at most. No conversations give no nodes, not even a root.
    """
    spark = paths.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = materialise(paths, "conversation-paths")
    chosen = _splitters(paths, shards)
    skeleton = Skeleton([(path, chars) for path, _, chars in chosen])
    sent = spark.sparkContext.broadcast(([(path, conv) for path, conv, _ in chosen], skeleton.children))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = sent.value[0]
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())
            yield batch.append_column("shard", pa.array([bisect_right(borders, key) for key in keys], pa.int32()))

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, shard = sent.value[1], None
        for batch in batches:
            for number, conv, path, chars in zip(*(batch.column(c).to_pylist() for c in ("shard", "conv_id", "path", "chars"))):
                if shard is None or shard.number != number:
                    if shard:
                        shard.finish()
                        yield shard.taken()
                    shard = _Shard(number, known)
                shard.read(conv, path, chars)
                if len(shard.rows) >= BATCH_ROWS:
                    yield shard.taken()
        if shard:
            shard.finish()
            yield shard.taken()

    dealt = paths.mapInArrow(place, "conv_id long, path binary, chars array<int>, shard int").repartitionById(shards, F.col("shard"))
    rows = materialise(dealt.sortWithinPartitions("shard", "path", "conv_id").mapInArrow(nodes, _SHARD_ROWS), "trie-nodes")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, hashlib.sha256()

        def done() -> pa.RecordBatch:
            return pa.record_batch([pa.array([node], pa.int32()), pa.array([digest.hexdigest()])], ["node", "ends_sha256"])

        for batch in batches:
            for own, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if own != node:
                    if node is not None:
                        yield done()
                    node, digest = own, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
        if node is not None:
            yield done()

    chunks = rows.where(F.col("kind") == _ENDS).select("node", "shard", "chunk", "ids")
    chunks = chunks.repartition(F.col("node")).sortWithinPartitions("node", "shard", "chunk")
    ends = chunks.mapInArrow(hashed, "node int, ends_sha256 string")

    known = spark.createDataFrame(skeleton.rows, "node int, parent int, depth long, chars long, below long, upward array<int>")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    parts = rows.where(F.col("kind") == _PART).groupBy("node").agg(F.min("conv_id").alias("conv_id"), *sums).join(known, "node")
    parts = materialise(parts.withColumn("n_children", F.col("n_children") + F.col("below")), "trie-skeleton")
    upward = parts.select(
        F.explode("upward").alias("node"), (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    upward = upward.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    # a row for each skeleton node, the bound on its size holds here too
    least = F.broadcast(parts.select(F.col("node").alias("above"), F.col("conv_id").alias("above_conv")))
    between = parts.join(upward, "node").join(ends, "node", "left").join(least, F.col("parent") == F.col("above"), "left")
    between = between.select(
        "conv_id", "depth", F.col("above_conv").alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("n_leaves") + F.col("leaf")).alias("n_leaves"), (F.col("saved_tokens") + F.col("saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )
    whole = rows.where(F.col("kind") == _WHOLE).join(least, F.col("node") == F.col("above"), "left")
    whole = whole.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above_conv"))
    return whole.select(*NODE_COLUMNS).unionAll(between.select(*NODE_COLUMNS))
