"""Exact search for the k best scores of each query by histograms of all scores.

Every task scores its vectors against a block of queries and counts the scores of each query by bin. The bins, added up
over all tasks, tell in which bin the k-th best score lies; the next round splits that bin, until it is a single
score. A last round keeps what scores more, and as many of the ties, the smaller ids first, as are wanted. Scores are
whole numbers, so rounds are few: each divides the range of scores by BINS.

A task sends the bins down to the one where it has seen k scores itself: the k-th best score of all vectors is no
less. Queries are dealt into blocks of bounded bytes, which alone go to the tasks, one group of blocks after the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gablework.session import fresh_path

from .common import Scratch, batches_of

SCALE = 1024
BINS = 4096
#: Queries and bytes of a block, and blocks that are searched at once: at most 16 MB and 4,096 queries go to the tasks.
BLOCK_QUERIES, BLOCK_BYTES, AT_ONCE = 1024, 4 << 20, 4
#: Scores that a task works on at once.
SCORES = 1 << 21


#: Vectors of an Arrow batch, and candidates that a task holds before it drops what can't be among the k best.
ROWS, HELD = 2048, 1 << 21
#: A bin of the k-th score with no more scores than this, times k, is split no further.
FEW = 4


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """ids and a matrix of floor(SCALE * x) for the vectors of each length that take part: neither null nor holding nulls,
    NaN or infinities."""
    column = batch.column("vector")
    starts, values = column.offsets.to_numpy().astype(np.int64), column.values
    numbers = values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    bad = np.append(0, np.cumsum(~np.isfinite(numbers)))
    sound = column.is_valid().to_numpy(zero_copy_only=False) & (bad[starts[1:]] == bad[starts[:-1]])
    lengths = np.diff(starts)
    for length in np.unique(lengths[sound]):
        rows = np.flatnonzero(sound & (lengths == length))
        yield batch.column("id").take(pa.array(rows)), np.floor(numbers[starts[rows][:, None] + np.arange(length)] * SCALE)


def packed(queries: DataFrame) -> DataFrame:
    """length, ids, data (a matrix row after row) of blocks of queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(length: int) -> pa.RecordBatch:
            ids, rows = zip(*held.pop(length))
            return pa.RecordBatch.from_arrays([pa.array([length], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
                                               pa.array([np.stack(rows).tobytes()], pa.binary())], ["length", "ids", "data"])

        for batch in batches:
            for ids, matrix in by_length(batch):
                length = matrix.shape[1]
                for one in zip(ids.to_pylist(), matrix):
                    held.setdefault(length, []).append(one)
                    if len(held[length]) >= max(1, min(BLOCK_QUERIES, BLOCK_BYTES // (8 * length + 8))):
                        yield block(length)
        for length in list(held):
            yield block(length)

    return queries.mapInArrow(run, "length int, ids array<long>, data binary")


def longest(vectors: DataFrame) -> dict[int, float]:
    """The largest Euclidean norm among the vectors of each length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most: dict[int, float] = {}
        for batch in batches:
            for _, matrix in by_length(batch):
                norm = float(np.sqrt((matrix ** 2).sum(axis=1)).max())
                most[matrix.shape[1]] = max(norm, most.get(matrix.shape[1], 0.0))
        yield pa.RecordBatch.from_arrays([pa.array(list(most), pa.int32()), pa.array(list(most.values()), pa.float64())],
                                         ["length", "norm"])

    rows = vectors.mapInArrow(run, "length int, norm double").groupBy("length").agg(F.max("norm").alias("norm"))
    return {r["length"]: r["norm"] for r in rows.collect()}


class Block:
    """Some queries of one length, numbered from ``first``, and the scores below which each asks for nothing."""

    def __init__(self, first: int, ids: np.ndarray, matrix: np.ndarray, reach: float):
        self.first, self.ids, self.matrix = first, ids, matrix
        self.order = np.argsort(ids, kind="stable")
        bound = np.floor(np.sqrt((matrix ** 2).sum(axis=1)) * reach) + 2
        if len(bound) and bound.max() >= 2 ** 62:
            raise ValueError("scores of these vectors need more than 64 bits")
        self.exact = reach == 0 or not len(bound) or bound.max() < 2 ** 52
        self.low = -bound.astype(np.int64)
        self.width = (2 * bound.astype(np.int64) + BINS) // BINS
        self.above = np.zeros(len(ids), np.int64)  # scores over the current bin
        self.open = np.ones(len(ids), bool)

    def scores(self, ids: pa.Array, matrix: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        """Scores of some vectors after the other against all queries; a query's own row scores the least number."""
        names = ids.fill_null(0).to_numpy(zero_copy_only=False)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        step = max(1, SCORES // max(1, len(self.ids)))
        for k in range(0, len(matrix), step):
            part = matrix[k:k + step]
            if self.exact:
                found = (part @ self.matrix.T).astype(np.int64)
            else:
                whole = np.vectorize(int, otypes=[object])
                found = whole(part).dot(whole(self.matrix).T).astype(np.int64)
            sorted_ids = self.ids[self.order]
            lows, highs = (np.searchsorted(sorted_ids, names[k:k + step], side) for side in ("left", "right"))
            for row in np.flatnonzero((lows < highs) & known[k:k + step]):
                found[row, self.order[lows[row]:highs[row]]] = np.iinfo(np.int64).min
            yield slice(k, k + step), found


def best_of_each(query: np.ndarray, keys: list[np.ndarray], k: int) -> np.ndarray:
    """Places of the first k of each query in the order of ``keys``."""
    order = np.lexsort((*keys[::-1], query))
    sorted_query = query[order]
    starts = np.flatnonzero(np.append(True, sorted_query[1:] != sorted_query[:-1])) if len(query) else np.zeros(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
    return order[rank < k]


def histograms(vectors: DataFrame, blocks: list[Block], k: int) -> DataFrame:
    """query, bin, n: scores in each bin of a query's current range, from the highest down as far as k of them matter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = {b: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for b in range(len(blocks))}
        floors = [block.low.copy() for block in blocks]
        for batch in batches:
            for ids, matrix in by_length(batch):
                for b, block in enumerate(blocks):
                    if block.matrix.shape[1] != matrix.shape[1]:
                        continue
                    top = block.low + block.width * BINS
                    for _, found in block.scores(ids, matrix):
                        inside = found < top
                        if len(found) > k:  # the k-th score of some is no more than that of all
                            kth = np.partition(found, len(found) - k, axis=0)[len(found) - k]
                            # what lies over the current bin was counted in an earlier round
                            np.maximum(floors[b], np.where(kth < top, np.maximum(kth, block.low), floors[b]), out=floors[b])
                        start = block.low + (floors[b] - block.low) // block.width * block.width
                        row, q = np.nonzero(inside & (found >= start) & block.open)
                        code = q * BINS + (found[row, q] - block.low[q]) // block.width[q]
                        codes, n = np.unique(code, return_counts=True)
                        old, counts = cells[b]
                        both, place = np.unique(np.append(old, codes), return_inverse=True)
                        cells[b] = both, np.bincount(place, np.append(counts, n), len(both)).astype(np.int64)
        for b, (code, n) in cells.items():
            yield pa.RecordBatch.from_arrays([pa.array(blocks[b].first + code // BINS), pa.array(code % BINS), pa.array(n)],
                                             ["query", "bin", "n"])

    return vectors.mapInArrow(run, "query long, bin long, n long").groupBy("query", "bin").agg(F.sum("n").alias("n"))


def refine(vectors: DataFrame, blocks: list[Block], k: int) -> bool:
    """Narrow the range of each open query to the bin that holds its k-th best score; whether any is still open."""
    wanted = {b.first + i: k - int(b.above[i]) for b in blocks for i in np.flatnonzero(b.open)}
    down = Window.partitionBy("query").orderBy(F.desc("bin"))
    counts = histograms(vectors, blocks, k).withColumn("upto", F.sum("n").over(down))
    # The k-th score lies in a bin begun before k scores are counted: at most k rows for each query of the group.
    reached = {query: (at, n, upto - n) for query, at, n, upto in counts.filter(F.col("upto") - F.col("n") < k).collect()
               if upto - n < wanted.get(query, 0) <= upto}
    for block in blocks:
        for i in np.flatnonzero(block.open):
            if block.first + i not in reached:  # fewer than k scores in all: every score counts
                block.open[i] = False
                continue
            at, n, over = reached[block.first + i]
            block.low[i] += at * block.width[i]
            block.above[i] += over
            block.open[i] = block.width[i] > 1 and n > FEW * k
            if block.open[i]:
                block.width[i] = (block.width[i] + BINS - 1) // BINS
    return any(block.open.any() for block in blocks)


def reaching(vectors: DataFrame, blocks: list[Block], k: int) -> DataFrame:
    """query, query_id, id, score: scores no less than the query's bound, at most the k best of each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def pruned() -> list:
            query, score, name, known, own = map(np.concatenate, zip(*held))
            best = best_of_each(query, [-score, known, name], k)
            return [tuple(column[best] for column in (query, score, name, known, own))]

        for batch in batches:
            for ids, matrix in by_length(batch):
                names = ids.fill_null(0).to_numpy(zero_copy_only=False)
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                for block in blocks:
                    if block.matrix.shape[1] != matrix.shape[1]:
                        continue
                    for rows, found in block.scores(ids, matrix):
                        row, q = np.nonzero(found >= block.low)
                        held.append((block.first + q, found[row, q], names[rows][row], known[rows][row], block.ids[q]))
                        size += len(q)
                        if size >= HELD:
                            held = pruned()
                            size = len(held[0][0])
        if held:
            query, score, name, known, own = pruned()[0]
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(own), pa.array(name, mask=~known), pa.array(score)],
                                             ["query", "query_id", "id", "score"])

    return vectors.mapInArrow(run, "query long, query_id long, id long, score long")


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), id, score: the k rows of ``vectors`` of the largest inner product with each row of ``queries``.

    Components become floor(SCALE * x). All rows but those of the query's own id are candidates, or as many as there are;
    ties go to the smaller id, a null one first. Vectors that are null or hold null, NaN or infinite components take no part,
    nor do queries of a null id. A query meets vectors of its own length. Repeated rows are rows of their own, among the
    queries as well. No queries or no vectors give no rows. Other columns are left out. Scores that could need
    more than 64 bits are an error.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    chosen = [F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")]
    rows, asked = vectors.select(*chosen), queries.filter(F.col(id_col).isNotNull()).select(*chosen)
    path = fresh_path(spark, "search-found")
    with batches_of(spark, ROWS):
        reach = longest(rows)
        blocks = scratch.keep(packed(asked.repartition(max(1, -(-asked.count() // BLOCK_QUERIES)))), "search-queries")
        stream = blocks.toLocalIterator()
        while True:
            group, first = [], 0
            for length, ids, data in islice(stream, AT_ONCE):
                matrix = np.frombuffer(data, np.float64).reshape(len(ids), length)
                group.append(Block(first, np.array(ids, np.int64), matrix, reach.get(length, 0.0)))
                first += len(ids)
            while group and refine(rows, group, k):
                pass
            order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("id"))
            found = (reaching(rows, group, k).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                     .select("query_id", "rank", "id", "score"))
            found.write.mode("append").parquet(path)
            if len(group) < AT_ONCE:
                break
    scratch.delete()
    return spark.read.schema("query_id long, rank int, id long, score long").parquet(path)
