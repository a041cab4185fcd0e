"""Exact top-k by inner product over an impact-ordered index."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from questlog.session import materialise

#: Vectors of one index block.
BLOCK_VECTORS = 1 << 14
#: Levels into which the values of one dimension are quantised, at most 255.
LEVELS = 28
#: Shares of the postings after which a query looks for its proof; the last is all.
LOOKS = (0.1, 0.25, 0.4, 0.5, 0.6, 0.75, 1)
#: One in so many vectors may be left for the exact scores, which cost less than further segments.
FEW = 2


def whole_components(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of every component; null if the vector or a component is null or not finite."""
    as_double = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(as_double, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.when(finite, F.transform(as_double, lambda x: F.floor(x * factor)))


class Index:
    """Posting segments of one block: the vectors whose value in a dimension lies in a level."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.exact = self.values.astype(np.float64)
        low, high = self.values.min(axis=0), self.values.max(axis=0)
        width = np.maximum(1, -(-(high - low + 1) // LEVELS))
        #: Level of every vector, a row for each dimension.
        self.level = ((self.values - low) // width).T.astype(np.uint8, order="C")
        self.segments, dims, levels, lows, highs = [], [], [], [], []
        for d, level in enumerate(self.level):
            rows = np.argsort(level, kind="stable")
            found, starts = np.unique(level[rows].astype(np.int64), return_index=True)
            own = self.values[rows, d]
            lows.append(np.minimum.reduceat(own, starts))
            highs.append(np.maximum.reduceat(own, starts))
            dims.append(np.full(len(found), d))
            levels.append(found)
            self.segments += np.split(rows, starts[1:])
        self.dims, self.levels, self.lows, self.highs = map(np.concatenate, (dims, levels, lows, highs))
        self.sizes = np.array([len(s) for s in self.segments])
        #: Postings read and held, over all queries.
        self.read = self.held = 0

    def search(self, query: np.ndarray, own_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the ``k`` best but ``own_id``; ties to the smaller id.

        Segments are added in descending impact: the most that one can add,
        above the least of its dimension. In a dimension where a vector has not
        come yet it gains at most the next impact of that dimension, which
        bounds its score. Best vectors by that bound, scored exactly, give the
        score to reach; once few can still reach it, or no segment is left,
        those are scored exactly.
        """
        n, width = self.values.shape
        taking_part = self.ids != own_id
        if not taking_part.any():
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        precise = query.astype(np.float64)
        weight = precise[self.dims]
        most = np.maximum(weight * self.lows, weight * self.highs)
        least = np.minimum(weight * self.lows, weight * self.highs)
        floors = np.full(width, np.inf)
        np.minimum.at(floors, self.dims, least)
        impact = most - floors[self.dims]
        order = np.argsort(-impact, kind="stable")
        read = np.cumsum(self.sizes[order])
        gained = np.where(taking_part, floors.sum(), -np.inf)
        wanted = min(k, int(taking_part.sum()))
        possible, done = taking_part, 0
        for share in LOOKS:
            turn = int(np.searchsorted(read, share * read[-1])) + 1 if share < 1 else len(order)
            if turn > done:
                added = order[done:turn]
                rows = np.concatenate([self.segments[s] for s in added])
                gained += np.bincount(rows, np.repeat(impact[added], self.sizes[added]), minlength=n)
                done = turn
            bound = gained + self._open(order[done:], precise, impact)
            best = np.argpartition(-bound, wanted - 1)[: 4 * wanted]
            reach = np.sort(self.exact[best] @ precise + np.where(taking_part[best], 0, -np.inf))[-wanted]
            possible = taking_part & (bound >= reach)
            if possible.sum() <= max(4 * wanted, n // FEW):
                break
        self.read += int(read[done - 1])
        self.held += int(read[-1])
        members = np.nonzero(possible)[0]
        scores = self.exact[members] @ precise
        top = np.lexsort((self.ids[members], -scores))[:k]
        return members[top], scores[top].astype(np.int64)

    def _open(self, left: np.ndarray, weight: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """The most that segments ``left`` can still add to each vector.

        A dimension's levels are read from one end, the high one where the
        query's ``weight`` is positive.
        """
        width = len(self.level)
        following, lowest, highest = np.zeros(width), np.full(width, LEVELS), np.zeros(width, dtype=np.int64)
        np.maximum.at(following, self.dims[left], impact[left])
        np.minimum.at(lowest, self.dims[left], self.levels[left])
        np.maximum.at(highest, self.dims[left], self.levels[left])
        rising = weight > 0
        limit = np.where(rising, highest, lowest).astype(np.uint8)[:, None]
        unread = np.empty(self.level.shape, dtype=np.float32)
        np.less_equal(self.level[rising], limit[rising], out=unread[: rising.sum()], casting="unsafe")
        np.greater_equal(self.level[~rising], limit[~rising], out=unread[rising.sum() :], casting="unsafe")
        steps = np.concatenate((following[rising], following[~rising])).astype(np.float32)
        return (steps @ unread).astype(np.float64) * (1 + width * 1e-6)  # never below the exact sum


def dealt(rows: DataFrame, blocks: int) -> DataFrame:
    """Rows of a written table with their ``block``, by hash of the id and the row's place, so copies of an id part."""
    return rows.withColumn("block", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))


def top_k(
    vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    factor: int = 256,
) -> DataFrame:
    """(query_id, rank, ``id_col``, score): the ``k`` best rows for each row where ``queries`` holds.

    Components become floor(factor * x); the score is the inner product, exact
    below 2**53, missing components of a shorter vector counting as 0. Rows
    with the query's own id are no candidates for it. Rows with a null id, and
    vectors that are null or hold null or non-finite components, take no part;
    empty vectors score 0. Repeated rows are candidates each; of a repeated
    query, one is asked. Ties go to the smaller id.

    Candidates lie in blocks of bounded size. A task indexes a block once and
    runs all queries against it as they stream by; the best of each block meet
    per query.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), whole_components(F.col(vector_col), factor).alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asked"),
    )
    rows = materialise(rows.where("id IS NOT NULL AND vector IS NOT NULL"), "vectors")
    asked = rows.where("asked").groupBy("id").agg(F.min("vector").alias("vector"))
    blocks = max(1, -(-rows.count() // BLOCK_VECTORS))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    candidates = dealt(rows, blocks).select("block", F.lit(False).alias("asked"), "id", "vector")
    seekers = asked.select(every, F.lit(True).alias("asked"), "id", "vector")

    def matrix(column: pa.Array, width: int) -> np.ndarray:
        starts = column.offsets.to_numpy()
        places = starts[:-1, None] + np.arange(width)
        own = places < starts[1:, None]
        out = np.zeros(places.shape, dtype=np.int64)
        out[own] = column.values.to_numpy()[places[own]]
        return out

    def indexed(parts: list[pa.RecordBatch]) -> Index:
        column = pa.concat_arrays([p.column("vector") for p in parts])
        width = max(1, int(np.diff(column.offsets.to_numpy()).max()))
        return Index(np.concatenate([p.column("id").to_numpy() for p in parts]), matrix(column, width))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per block its candidates, then the queries."""
        current, held, index = None, [], None
        for batch in batches:
            turns = batch.column("block").to_numpy().astype(np.int64) * 2 + batch.column("asked").to_numpy(zero_copy_only=False)
            edges = [0, *(np.nonzero(np.diff(turns))[0] + 1).tolist(), len(turns)]
            for start, end in pairwise(edges):
                if start == end:
                    continue
                part, (block, asks) = batch.slice(start, end - start), divmod(int(turns[start]), 2)
                if block != current:
                    current, held, index = block, [], None
                if not asks:
                    held.append(part)
                    continue
                if index is None:
                    if not held:
                        continue
                    index, held = indexed(held), []
                found: list[tuple] = []
                for own, query in zip(part.column("id").to_pylist(), matrix(part.column("vector"), index.values.shape[1])):
                    members, scores = index.search(query, own, k)
                    found += zip([own] * len(members), index.ids[members].tolist(), scores.tolist())
                columns = list(zip(*found)) or [(), (), ()]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["query_id", "id", "score"])

    partitions = min(blocks, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = candidates.unionByName(seekers).repartitionById(partitions, F.col("block") % partitions)
    local = met.sortWithinPartitions("block", "asked").mapInArrow(search, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
