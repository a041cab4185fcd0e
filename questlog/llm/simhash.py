"""Near duplicates by SimHash, linked through vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from questlog.llm.graph import components
from questlog.session import materialise

BITS = 64
#: Shingle hashes whose bits are counted at once; bounds memory for any text.
HASHES_AT_ONCE = 1 << 17
#: Fingerprints a shard is laid out for, and those one task compares at most.
SHARD_POINTS = 4096
SHARD_LIMIT = 4 * SHARD_POINTS
#: Distinct fingerprints from which the trees are laid out: per shard, and in all.
SAMPLE_PER_SHARD = 16
SAMPLE_LIMIT = 1 << 16


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """64-bit SimHash of lower-cased (A-Z) words; 0 without words.

    A bit is set if more than half of the hashes of the ``shingle``-word runs,
    repeats included, have it. A text of fewer words is one run.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    k = min(shingle, len(words))
    begin, end = starts[: len(words) - k + 1].tolist(), (ends[k - 1 :] - 1).tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(begin), HASHES_AT_ONCE):
        part = zip(begin[at : at + HASHES_AT_ONCE], end[at : at + HASHES_AT_ONCE])
        hashes = np.array([digest(joined[a:b], 42) for a, b in part], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(begin), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(``id_col``, fp long) for every row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.array([fingerprint(t.as_py() or b"", shingle) for t in texts], dtype=np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    made = StructType([StructField("id", docs.schema[id_col].dataType)]).add("fp", "long")
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, made).withColumnRenamed("id", id_col)


@dataclass
class Node:
    """Values within ``radius`` of ``vantage`` go left, others right; a leaf has a number."""

    leaf: int = -1
    vantage: int = 0
    radius: int = 0
    left: Node | None = None
    right: Node | None = None


def _distance(values: np.ndarray, other) -> np.ndarray:
    return np.bitwise_count(values ^ other).astype(np.int16)


def _halved(values: np.ndarray) -> tuple[int, int] | None:
    """Vantage value and radius that split ``values`` best, or None if all are equal."""
    best, choice = 0, None
    for vantage in values[:: max(1, len(values) // 4)][:4]:
        away = _distance(values, vantage)
        for radius in {int(np.median(away)), int(np.median(away)) - 1}:
            inside = int((away <= radius).sum())
            if min(inside, len(values) - inside) > best:
                best, choice = min(inside, len(values) - inside), (int(vantage), radius)
    return choice


def plant(values: np.ndarray, leaves: int, first: int = 0) -> tuple[Node, int]:
    """A vantage-point tree of up to ``leaves`` leaves, numbered from ``first``; and the next number."""
    split = _halved(values) if leaves > 1 and len(values) > 1 else None
    if split is None:
        return Node(leaf=first), first + 1
    vantage, radius = split
    inside = _distance(values, values.dtype.type(vantage)) <= radius
    left, following = plant(values[inside], leaves // 2, first)
    right, following = plant(values[~inside], leaves - leaves // 2, following)
    return Node(vantage=vantage, radius=radius, left=left, right=right), following


def _descend(node: Node, values: np.ndarray, rows: np.ndarray, reach: int, out: list) -> None:
    """Leaves that may hold a value within ``reach`` of each value (0: its own leaf)."""
    if not len(rows):
        return
    if node.leaf >= 0:
        out.append((node.leaf, rows))
        return
    away = _distance(values[rows], values.dtype.type(node.vantage))
    _descend(node.left, values, rows[away - reach <= node.radius], reach, out)
    _descend(node.right, values, rows[away + reach > node.radius], reach, out)


class Forest:
    """Spanning links among the values of one shard, kept as the pairs are found."""

    def __init__(self, size: int):
        self.parent = list(range(size))
        self.seen = np.arange(size)
        self.joined = 0

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        apart = self.seen[a] != self.seen[b]
        for x, y in zip(a[apart].tolist(), b[apart].tolist()):
            x, y = self.find(x), self.find(y)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                self.joined += 1
        if self.joined > 256:
            self.seen, self.joined = self.roots(), 0

    def roots(self) -> np.ndarray:
        return np.array([self.find(x) for x in range(len(self.parent))], dtype=np.int64)


def _search(node_points, node_queries, values, forest, block, distance: int, reach: int, depth: int) -> None:
    """Link queries to points within ``distance``, splitting by a vantage point on the block while it helps."""
    if not len(node_points) or not len(node_queries):
        return
    split = None
    if len(node_points) > 64 and depth < BITS:
        split = _halved(block[node_points])
    if split is None:
        step = max(1, (1 << 20) // len(node_points))
        for at in range(0, len(node_queries), step):
            part = node_queries[at : at + step]
            near = _distance(values[part][:, None], values[node_points][None, :]) <= distance
            q, p = np.nonzero(near)
            forest.link(part[q], node_points[p])
        return
    vantage, radius = split
    vantage = block.dtype.type(vantage)
    own, asked = _distance(block[node_points], vantage), _distance(block[node_queries], vantage)
    inside = own <= radius
    _search(node_points[inside], node_queries[asked - reach <= radius], values, forest, block, distance, reach, depth + 1)
    _search(node_points[~inside], node_queries[asked + reach > radius], values, forest, block, distance, reach, depth + 1)


def _block(values: np.ndarray, tree: int, trees: int) -> np.ndarray:
    """Bits of one of ``trees`` equal parts of each fingerprint."""
    low, high = tree * BITS // trees, (tree + 1) * BITS // trees
    return (values >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)


def links(fps: DataFrame, distance: int = 4, trees: int | None = None) -> DataFrame:
    """Links (a, b) that connect all of the distinct ``fps`` (fp long) within ``distance`` bits.

    Of ``trees`` equal parts of two such fingerprints, one differs in at most
    ``distance // trees`` bits. So each part has a vantage-point tree over its
    bits, and a fingerprint visits, beside its own shard, the shards on whose
    side of a boundary a part within that reach can lie. In a shard the same
    bounds prune on; whole fingerprints are then compared. Links found are kept
    as a spanning forest per shard, never as all pairs of a dense group. A
    shard above its limit is cut by a hash, and its visitors see every cut.
    """
    spark = fps.sparkSession
    trees = trees or max(1, min(distance, 4))
    reach = distance // trees
    total = fps.count()
    leaves = max(1, -(-total // SHARD_POINTS))
    wanted = min(SAMPLE_LIMIT, leaves * SAMPLE_PER_SHARD)
    sample = fps.orderBy(F.xxhash64("fp")).limit(wanted).toPandas()["fp"].to_numpy(dtype=np.int64).view(np.uint64)
    roots, following = [], 0
    for tree in range(trees):
        root, following = plant(_block(sample, tree, trees), leaves, following)
        roots.append(root)

    def shards(batches: Iterator[pa.RecordBatch], reaches: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column(0).to_numpy(zero_copy_only=False)
            values, every = signed.view(np.uint64), np.arange(len(signed))
            for home, far in zip((True, False), reaches):
                if far < 0:
                    continue
                out: list = []
                for tree, root in enumerate(roots):
                    _descend(root, _block(values, tree, trees), every, far, out)
                for leaf, rows in out:
                    if len(rows):
                        yield pa.record_batch(
                            [pa.array(np.full(len(rows), leaf, dtype=np.int64)), pa.array(signed[rows]), pa.array(np.full(len(rows), home))],
                            ["shard", "fp", "home"],
                        )

    kinds = "shard long, fp long, home boolean"
    homes = fps.select("fp").mapInArrow(lambda b: shards(b, (0, -1)), kinds)
    large = {
        r["shard"]: -(-r["count"] // SHARD_LIMIT)
        for r in homes.groupBy("shard").count().where(F.col("count") > SHARD_LIMIT).collect()
    }
    placed = fps.select("fp").mapInArrow(lambda b: shards(b, (0, reach)), kinds)
    if large:
        cuts = F.coalesce(F.create_map(*[F.lit(int(x)) for kv in large.items() for x in kv])[F.col("shard")], F.lit(1))
        own = F.pmod(F.xxhash64("fp"), cuts).cast("int")
        every = F.sequence(F.lit(0), cuts.cast("int") - 1)
        placed = placed.select("shard", "fp", "home", F.explode(F.when(F.col("home"), F.array(own)).otherwise(every)).alias("cut"))
    else:
        placed = placed.withColumn("cut", F.lit(0))
    firsts = [_first_leaf(root) for root in roots]

    def search(table: pa.Table) -> pa.Table:
        tree = max(i for i, first in enumerate(firsts) if first <= table.column("shard")[0].as_py())
        signed = table.column("fp").to_numpy()
        home = table.column("home").to_numpy()
        values, rows = np.unique(signed.view(np.uint64), return_inverse=True)
        points, queries = np.unique(rows[home]), np.unique(rows[~home])
        forest = Forest(len(values))
        _search(points, queries, values, forest, _block(values, tree, trees), distance, reach, 0)
        found = forest.roots()
        linked = np.nonzero(found != np.arange(len(found)))[0]
        return pa.table({"a": values[linked].view(np.int64), "b": values[found[linked]].view(np.int64)})

    return placed.groupBy("shard", "cut").applyInArrow(search, "a long, b long")


def _first_leaf(node: Node) -> int:
    while node.leaf < 0:
        node = node.left
    return node.leaf


def groups(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, root) for every distinct ``fp`` of ``prints``; equal roots are linked within ``distance`` bits."""
    classes = materialise(prints.select("fp").distinct(), "classes")
    roots = components(links(classes, distance))
    joined = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return materialise(joined.select("fp", F.coalesce("root", "fp").alias("root")), "rooted")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4
) -> DataFrame:
    """One row per row of ``docs``: id, fp long, fingerprint (hex) and component_id.

    component_id is the smallest id reachable over fingerprints that differ in
    at most ``distance`` bits, the row's own included. Rows are never dropped:
    a null or empty text has fingerprint 0 and is linked like any other; rows
    with a null id get their component's smallest id, which is null if the
    component has none; repeated rows stay. Other columns are not read.
    """
    prints = materialise(fingerprints(docs, id_col, text_col, shingle).withColumnRenamed(id_col, "id"), "prints")
    rooted = groups(prints, distance)
    least = materialise(prints.groupBy("fp").agg(F.min("id").alias("least")), "least")
    names = rooted.join(least, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(rooted.join(materialise(names, "names"), "root").select("fp", "component_id"), "named")
    joined = prints.join(named, "fp")
    return joined.select(
        F.col("id").alias(id_col), "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4
) -> DataFrame:
    """One row, with all its columns, of each group of near duplicates.

    That of the smallest id, null ids last; among equal ids that of the least
    hash of its columns, and one of rows that are equal in all. Null and empty
    texts are one group. Columns may be of any type that can be hashed.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one, two = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    keyed = docs.select(F.struct(F.col(id_col).alias("id"), one.alias("one"), two.alias("two")).alias("key"), F.col(text_col).alias("text"))
    prints = materialise(fingerprints(keyed, "key", "text", shingle), "prints")
    rooted = groups(prints, distance)
    best = prints.groupBy("fp").agg(F.min(F.struct(F.col("key.id").isNull(), "key.id", "key.one", "key.two")).alias("best"))
    best = rooted.join(materialise(best, "best"), "fp").groupBy("root").agg(F.min("best").alias("best"))
    kept = materialise(best.select("best.one", "best.two").distinct(), "kept")
    marked = docs.select(one.alias("one"), two.alias("two"), F.struct(*columns).alias("row"))
    return marked.join(kept, ["one", "two"], "left_semi").dropDuplicates(["one", "two"]).select("row.*")
