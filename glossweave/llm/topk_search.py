"""Exact top-k search by inner product: columnar branch-and-bound.

Vectors lie in vertical layout, a row of an array for each dimension. Scores are summed dimension block
by dimension block; what the remaining dimensions can still add is bounded by the lengths of the
remaining parts (Cauchy-Schwarz), and candidates that reach no query's k-th best are compacted away.
A task holds a part of the queries and reads a slice of the rows once, block by block, while each
query's k-th score goes on from block to block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

K = 20
#: Rows of a block, queries of a part, queries scored at once, and dimensions summed between two prunings.
ROWS, ASKED, QUERIES, DIMENSIONS = 8192, 32768, 512, 16
#: Pairs of query and row that are worth a task of their own.
PAIRS = 1 << 24
#: Lists of a query's best rows that one aggregation merges, at most.
MERGED = 64


def quantized(vector: Column, scale: int = 64) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: Column) -> Column:
    """Not null, and every component finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def widened(grid: np.ndarray, width: int) -> np.ndarray:
    return np.pad(grid, ((0, 0), (0, width - grid.shape[1]))) if grid.shape[1] < width else grid


class Best:
    """The k best rows of each query so far: scores and ids, the best first, ties to the smaller id; none yet: -inf."""

    def __init__(self, k: int):
        self.k, self.parts, self.waiting, self.ready = k, [], [], False

    def ask(self, ids: np.ndarray, grid: np.ndarray) -> None:
        self.parts.append((ids, grid))

    def add(self, ids: np.ndarray, grid: np.ndarray) -> None:
        """Rows; they are scored when there is a block of them."""
        self.waiting.append((ids, grid))
        if sum(len(i) for i, _ in self.waiting) >= ROWS:
            self.flush()

    @staticmethod
    def _joined(parts: list) -> tuple[np.ndarray, np.ndarray]:
        width = max(g.shape[1] for _, g in parts)
        return np.concatenate([i for i, _ in parts]), np.concatenate([widened(g, width) for _, g in parts])

    def flush(self) -> None:
        if not self.waiting or not self.parts:
            self.waiting = []
            return
        if not self.ready:
            self.ids, self.queries = self._joined(self.parts)
            self.pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(0, len(self.ids), QUERIES)]
            self.ready = True
        ids, rows = self._joined(self.waiting)
        self.waiting = []
        width = max(rows.shape[1], self.queries.shape[1])
        rows, self.queries = widened(rows, width), widened(self.queries, width)
        for n, a in enumerate(range(0, len(self.ids), QUERIES)):
            self.pairs[n] = self.merge(self.pairs[n], self.ids[a : a + QUERIES], self.queries[a : a + QUERIES], ids, rows)

    def merge(self, held: tuple, query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> tuple:
        """(query number, row id, score) of the best of `held` and the new rows, ordered by query, then rank."""
        k, count = self.k, len(query_ids)
        floor = np.full(count, -np.inf)
        many = np.bincount(held[0], minlength=count)
        full = many >= k
        floor[full] = held[2][np.cumsum(many)[full] - 1].astype(float)
        fl_q, fl_r = queries.astype(float), rows.astype(float)
        largest = np.sqrt((fl_q**2).sum(1).max()) * np.sqrt((fl_r**2).sum(1).max())
        if largest >= 2.0**53:  # sums that doubles don't hold: whole numbers of any size
            scores, live = np.dot(queries.astype(object), rows.astype(object).T), np.arange(len(ids))
        else:
            # dimensions in which the queries are largest come first
            order = np.argsort(-np.abs(fl_q).sum(0), kind="stable")
            fl_q, columns = fl_q[:, order], np.ascontiguousarray(fl_r[:, order].T)
            live, scores = np.arange(len(ids)), np.zeros((count, len(ids)))
            for a in range(0, columns.shape[0], DIMENSIONS):
                c = min(a + DIMENSIONS, columns.shape[0])
                scores = scores + fl_q[:, a:c] @ columns[a:c, live]
                if c == columns.shape[0]:
                    break
                mass = np.sqrt((fl_q[:, c:] ** 2).sum(1))[:, None] * np.sqrt((columns[c:, live] ** 2).sum(0))
                if len(live) > k and not full.all():  # k + 1 rows, one of which may be the query's own, reach so much
                    floor = np.maximum(floor, np.partition(scores - mass, len(live) - k - 1, axis=1)[:, len(live) - k - 1])
                keep = (scores + mass >= (floor - 1e-6 * (1 + np.abs(floor)))[:, None]).any(0)
                live, scores = live[keep], scores[:, keep]
            scores = np.rint(scores).astype(np.int64)
        able = scores >= np.where(np.isinf(floor), -np.inf, np.floor(floor))[:, None]
        able &= ids[live][None, :] != query_ids[:, None]
        q, r = np.nonzero(able)
        q, r, s = np.concatenate([held[0], q]), np.concatenate([held[1], ids[live[r]]]), np.concatenate([held[2], scores[q, r]])
        order = np.lexsort((r, -s, q)) if s.dtype != object else np.array(sorted(range(len(q)), key=lambda i: (q[i], -s[i], r[i])), np.int64)
        q, r, s = q[order], r[order], s[order]
        first = np.searchsorted(q, np.arange(count))
        top = np.arange(len(q)) - first[q] < k
        return q[top], r[top], s[top]

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query id, row id, score); scores beyond 64 bits are cut to these."""
        self.flush()
        if not self.ready:
            return (np.zeros(0, np.int64),) * 3
        parts = [(self.ids[n * QUERIES + q], r, s) for n, (q, r, s) in enumerate(self.pairs)]
        q, r, s = (np.concatenate(c) for c in zip(*parts, strict=True))
        return q, r, np.clip(s, -(2**63), 2**63 - 1).astype(np.int64)


def _meet(k: int):
    """Rows (slice, query_id, vec_id, score) of units (unit, asks, vec_id, values), queries before rows."""

    def run(batches):
        best, last = None, None

        def out():
            q, r, s = best.result()
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(q), last[1])), pa.array(q), pa.array(r), pa.array(s)], ["slice", "query_id", "vec_id", "score"])

        for batch in batches:
            part, piece, asks, ids, lists = batch.columns
            part, piece, asks, ids = (x.to_numpy(zero_copy_only=False) for x in (part, piece, asks, ids))
            sizes = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
            flat = np.asarray(lists.flatten())
            grid = np.zeros((len(ids), max(1, int(sizes.max(initial=0)))), np.int64)
            grid[np.repeat(np.arange(len(ids)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
            change = np.flatnonzero((np.diff(part) != 0) | (np.diff(piece) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *change], [*change, len(ids)], strict=True):
                if a == b:
                    continue
                if last != (part[a], piece[a]):
                    if best:
                        yield out()
                    best, last = Best(k), (part[a], piece[a])
                (best.ask if asks[a] else best.add)(ids[a:b], grid[a:b])
        if best:
            yield out()

    return run


def search(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) of each query's k best other vectors by inner product.

    vectors: vec_id and `values`, an array of longs; is_query tells which rows are queries too. Ties go
    to the smaller vec_id. Vectors of different lengths count as if zeros followed. Null vectors and
    null ids take no part; a query without candidates has no row. Rows with one vec_id are the same
    vector's: none of them is a candidate of its own id, each other query may get each of them, and
    a query that comes twice gets the k best of all its pairs. Sums are exact; beyond 64 bits they are cut to these.
    Each row travels once for each part of ASKED queries, and the queries once for each slice of the rows;
    tasks, which have one part and one slice, are few where there are few pairs, and otherwise keep all shuffle partitions busy.
    """
    fine = vectors.where("vec_id IS NOT NULL AND values IS NOT NULL").select("vec_id", "values", F.coalesce(is_query, F.lit(False)).alias("asks"))
    n, asking = fine.agg(F.count("*"), F.count_if("asks")).first()
    parts = max(1, math.ceil(asking / ASKED))
    slices = max(1, math.ceil(min(n * asking / PAIRS, 4 * common.partitions(vectors)) / parts))
    part = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(parts)).cast("int")
    piece = F.pmod(F.xxhash64("vec_id", "values"), F.lit(slices)).cast("int")
    # the query set against all rows, in blocks: each slice of rows meets each part of the queries
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = fine.select(every(parts).alias("part"), piece.alias("slice"), F.lit(False).alias("asks"), "vec_id", "values")
    asked = fine.where("asks").select(part.alias("part"), every(slices).alias("slice"), "asks", "vec_id", "values")
    dealt = rows.union(asked).repartitionById(parts * slices, F.col("part") * slices + F.col("slice")).sortWithinPartitions("part", "slice", F.desc("asks"))
    met = dealt.mapInArrow(_meet(k), "slice int, query_id bigint, vec_id bigint, score bigint")
    kept = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("low"), "vec_id"))), 1, k)
    while slices > MERGED:  # no list is longer than MERGED * k
        slices = math.ceil(slices / MERGED)
        met = met.groupBy("query_id", F.pmod("slice", F.lit(slices)).alias("slice")).agg(kept.alias("top")).select("slice", "query_id", F.explode("top").alias("x"))
        met = met.select("slice", "query_id", F.col("x.vec_id").alias("vec_id"), (-F.col("x.low")).alias("score"))
    top = met.groupBy("query_id").agg(kept.alias("top")).select("query_id", F.posexplode("top").alias("rank", "x"))
    return top.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.low")).alias("score"))


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = common.table(spark, sf_dir, "embeddings")
    fine = table.where(usable(F.col("embedding"))).select("vec_id", quantized(F.col("embedding")).alias("values"))
    return search(fine, F.col("vec_id") % 20 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
WHERE rank <= 20
"""
