"""Exact top-k inner products by an impact-ordered index, taken score at a time.

Vectors become whole numbers, floor(SCALE * x). The rows are dealt into index shards of
about ROWS vectors. In a shard each dimension is a posting list in order of its impact,
which is quantised to LEVELS steps; postings of one level form a segment. For a query, a
dimension counts by its distance from the end that is worst for the query, so all
contributions are at least 0. Segments are processed by descending quantised
contribution and add up to a lower bound for each row; what a row may still gain is
bounded by the next segments and the quantisation. Rows that may reach the k-th lower
bound are possible members. Processing stops once few rows are possible members, or no
segment is left, and all of them are scored exactly: the bounds prove that no other row
is among the k best. Shards give their k best, from which each query's are taken.

A task reads a shard's rows, builds its index once, and the queries then stream past it
in Arrow batches, so it holds one shard and one batch at a time, whatever the size of
the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from feedlake.llm.common import parts, stored

SCALE, LEVELS = 1024, 256
#: Vectors of an index shard.
ROWS = 4096
#: Possible members, as a multiple of k, that end the processing of segments.
ENOUGH = 8
#: Each round goes on to contributions this much smaller.
FALL = 0.4


class Index:
    """The impact-ordered postings of one shard."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order].astype(np.int64)
        self.low, self.high = self.x.min(axis=0), self.x.max(axis=0)
        self.step = np.maximum(1, -(-(self.high - self.low + 1) // LEVELS))
        # by sign of the query's weight: postings by falling distance from the worst end (all dimensions in one
        # row), their levels, and how many postings of a dimension have a level or more
        self.rows, self.levels, self.reach = {}, {}, {}
        n, dims = self.x.shape
        for sign in (1, -1):
            level = (self._distance(sign) // self.step[:, None]).astype(np.int32)
            falling = np.argsort(-level, axis=1, kind="stable").astype(np.int32)
            self.rows[sign], self.levels[sign] = falling.ravel(), np.take_along_axis(level, falling, axis=1).ravel()
            counts = np.zeros((dims, LEVELS + 2), np.int64)
            np.add.at(counts, (np.repeat(np.arange(dims), n), level.ravel()), 1)
            self.reach[sign] = counts[:, ::-1].cumsum(axis=1)[:, ::-1]

    def _distance(self, sign: int) -> np.ndarray:
        """Of each value from the worst end (the lowest for positive weights), dimensions x rows."""
        return (self.x - self.low).T if sign > 0 else (self.high - self.x).T

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows but ``own``: larger scores first, then smaller ids."""
        n = len(self.ids)
        bound, members = np.zeros(n), np.arange(n)
        sides = []
        for sign in (1, -1):
            dims = np.flatnonzero(query * sign > 0)
            if len(dims):
                unit = np.abs(query[dims]) * self.step[dims]  # what one level is worth
                sides.append((sign, dims, unit, np.zeros(len(dims), np.int64)))
        top = max((float((unit * self.levels[sign][dims * n]).max()) for sign, dims, unit, _ in sides), default=0.0)
        while sides:
            top *= FALL
            if top < 1:
                top = 0.0
            slack, done = 0.0, True
            for side, (sign, dims, unit, at) in enumerate(sides):
                stop = self.reach[sign][dims, np.minimum(np.ceil(top / unit), LEVELS + 1).astype(int)]
                size = stop - at
                postings = np.repeat(dims * n + at - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
                bound += np.bincount(self.rows[sign][postings], np.repeat(unit, size) * self.levels[sign][postings], n)
                sides[side] = (sign, dims, unit, stop)
                # a row has at most its next level's worth in a dimension where it was not met, and less than one
                # level more than was counted where it was
                ahead = np.where(stop < n, unit * (self.levels[sign][dims * n + np.minimum(stop, n - 1)] + 1), 0)
                slack += np.maximum(ahead, unit).sum()
                done &= bool((stop == n).all())
            if n > k + 1:
                kth = np.partition(bound, n - k - 1)[n - k - 1]  # one more, as the query itself may be among them
                members = np.flatnonzero(bound + slack >= kth)
            if len(members) <= ENOUGH * k or done:
                break
        members = members[self.ids[members] != own]
        score = self.x[members] @ query
        best = np.lexsort((self.ids[members], -score))[:k]
        return self.ids[members][best], score[best]


def whole_vectors(rows: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``vec_id, x``: rows whose vector and components are there and finite; of a repeated id the smallest vector."""
    x = F.col(vector)
    usable = x.isNotNull() & F.col(key).isNotNull() & ~F.exists(
        x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    return (rows.where(usable)
            .select(F.col(key).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("x"))
            .groupBy("vec_id").agg(F.min("x").alias("x")))


def _matrix(values: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of ``width``, shorter ones filled up with 0."""
    out = np.zeros((len(values), width), np.int64)
    size = values.value_lengths().to_numpy(zero_copy_only=False)
    out[np.arange(width) < size[:, None]] = values.flatten().to_numpy()
    return out


def _found(batches: Iterator[pa.RecordBatch], width: int, k: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` best rows of each shard for each query; of a shard its rows come first, then its queries."""
    shard, index, rows = None, None, []
    for batch in batches:
        cuts = [0, *(np.flatnonzero(np.diff(batch.column("shard").to_numpy())) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            part = batch.slice(start, stop - start)
            if not part.num_rows:
                continue
            if (at := part.column("shard")[0].as_py()) != shard:
                shard, index, rows = at, None, []
            asked = part.column("asked").to_numpy(zero_copy_only=False)
            ids, x = part.column("vec_id").to_numpy(), _matrix(part.column("x"), width)
            if not asked.all():
                rows.append((ids[~asked], x[~asked]))
            if not asked.any():
                continue
            if index is None:
                index = Index(*map(np.concatenate, zip(*rows))) if rows else None
                rows = []
            if index is None:
                continue
            found = []
            for query_id, query in zip(ids[asked].tolist(), x[asked]):
                best, scores = index.search(query, query_id, k)
                found.append((np.full(len(best), query_id), best, scores))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*found)],
                                             names=["query_id", "vec_id", "score"])


def nearest(rows: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 10, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every query's ``k`` best rows (all, if fewer), itself excluded.

    ``is_query``: a condition on the id column, given as a function of it. Ties go to
    the smaller id. Rows with a null id, a null vector, or a null or non-finite
    component take no part; a repeated id counts once, with its smallest vector;
    shorter vectors are filled up with 0 and an empty one scores 0 with all. Scaled
    components must stay below 2**26 in size. Extra columns are ignored.
    """
    vectors = stored(whole_vectors(rows, key, vector, scale), "whole-vectors")
    n, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    width = width or 0
    queries = vectors.where(is_query(F.col("vec_id")))
    shards = parts(n, ROWS)
    own = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    # a shard's rows and a copy of all queries meet in the shard's task, the rows first
    members = vectors.select(own.alias("shard"), F.lit(False).alias("asked"), "vec_id", "x")
    copies = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("asked"), "vec_id", "x")
    best = (members.unionByName(copies).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "asked")
            .mapInArrow(lambda batches: _found(batches, width, k), "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
