"""Exact top-k search of binary codes by incremental multi-index hashing.

A vector's code has a bit for each of its first 64 components, 1 where it is above 0. Codes are cut into segments of about log2(number of
codes in the block) bits, at least LEAST_WIDTH and at most MOST_WIDTH, each indexed by its value. A query looks up, in every segment, the values within radius 0,
then 1, then 2, ... of its own, and verifies what is new. A code within m * (radius + 1) - 1 bits of the query lies within the
radius in at least one of the m segments, so once the k-th verified distance is no more than that nothing nearer can be missing, and the
search ends. There is no other way to the result: no switch to a scan.

Equal codes are one entry with their k + 1 least ids, so copies cost nothing in the index and none is lost: more of them cannot be
among the k nearest by (distance, id). Codes are dealt in blocks of about BLOCK; a task builds its block's index once, and the queries stream
through it, batch by batch (beyond QUERIES of them, several tasks share a block, each with an index of its own). The k nearest of the
blocks are merged for each query.

Defined cases: a null embedding is neither indexed nor a query; components that are null, NaN or missing give 0; a row that repeats an id
and a code counts once; null ids are left out; a query does not find rows of its own id; ties go to the
lesser id; fewer than k others give fewer rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import bounded_batches, column, settle, tidy

BITS, LEAST_WIDTH, MOST_WIDTH, K = 64, 8, 20, 10
BLOCK, QUERIES, MOST_TASKS = 2_000_000, 500_000, 100_000


def code(v: Column) -> Column:
    """64 sign bits."""
    bit = lambda k: F.when((F.get(v, k) > 0) & ~F.isnan(F.get(v, k)), F.lit(1 << k if k < 63 else -(1 << 63))).otherwise(F.lit(0))
    out = bit(0)
    for k in range(1, 64):
        out = out.bitwiseOR(bit(k))
    return out


def ring(width: int, radius: int) -> np.ndarray:
    """All values of `width` bits with `radius` bits set."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], np.int64)


class Index:
    """Codes by the value of each segment. counts: how many ids each code stands for."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.codes, self.counts = codes, counts
        width = min(MOST_WIDTH, max(LEAST_WIDTH, round(math.log2(max(2, len(codes))))))
        m = -(-BITS // width)
        ends = [round(k * BITS / m) for k in range(m + 1)]
        self.segments = list(zip(ends, ends[1:]))
        self.order, self.starts, self.rings = [], [], {}
        for a, b in self.segments:
            v = self._part(codes, a, b)
            self.order.append(np.argsort(v, kind="stable").astype(np.int32))
            self.starts.append(np.concatenate(([0], np.cumsum(np.bincount(v, minlength=1 << (b - a))))).astype(np.int32))
        self.met = np.zeros(len(codes), bool)
        self.verified = self.asked = 0

    @staticmethod
    def _part(codes, a: int, b: int):
        return ((codes >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)).astype(np.int64)

    def _within(self, query: np.uint64, radius: int) -> np.ndarray:
        """Places of codes with a segment at `radius` bits from the query's, that were not met before."""
        found = []
        for s, (a, b) in enumerate(self.segments):
            if radius > b - a:
                continue
            if (b - a, radius) not in self.rings:
                self.rings[b - a, radius] = ring(b - a, radius)
            values = int(self._part(query, a, b)) ^ self.rings[b - a, radius]
            x, y = self.starts[s][values].astype(np.int64), self.starts[s][values + 1]
            n = y - x
            x, n = x[n > 0], n[n > 0]
            if len(n):
                found.append(self.order[s][np.repeat(x - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())])
        if not found:
            return np.zeros(0, np.int64)
        places = np.concatenate(found)
        places = np.unique(places[~self.met[places]])
        self.met[places] = True
        return places

    def nearest(self, query: np.uint64, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and distances of codes that hold the k nearest ids (all at the last distance too), and the radius reached."""
        places, distances = [], []
        by = np.zeros(BITS + 1)
        for radius in range(max(b - a for a, b in self.segments) + 1):
            new = self._within(query, radius)
            far = np.bitwise_count(self.codes[new] ^ query).astype(np.int64)
            places.append(new)
            distances.append(far)
            by += np.bincount(far, self.counts[new], BITS + 1)
            if by[: min(len(self.segments) * (radius + 1), BITS + 1)].sum() >= k:
                break
        places, distances = np.concatenate(places), np.concatenate(distances)
        self.met[places] = False
        self.verified, self.asked = self.verified + len(places), self.asked + 1
        upto = by.cumsum()
        near = distances <= (int(np.searchsorted(upto, min(k, upto[-1]))) if len(places) else 0)
        return places[near], distances[near], radius


def top_k(vectors: DataFrame, k: int = K, every: int = 100, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, distance: the k nearest others of each row of vectors (vec_id, embedding) whose id `every` divides."""
    rows = settle(vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), code(F.col("embedding")).alias("code")).distinct())
    place = F.row_number().over(Window.partitionBy("code").orderBy("vec_id"))
    few = rows.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("code").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asked = rows.where(F.col("vec_id") % every == 0)
    n_codes, n_asked = few.count(), asked.select("code").distinct().count()
    blocks, parts = max(1, -(-n_codes // block)), max(1, -(-n_asked // queries))

    # a part of a block: its codes, then the queries dealt to it, in a partition of its own
    held = few.select("code", F.size("ids").alias("n"), F.pmod(F.hash("code"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    seek = asked.select("code").distinct().select("code", F.lit(0).alias("n"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("code"), F.lit(parts)).cast("int").alias("part"))
    dealt = held.unionAll(seek.select("code", "n", "block", "part")).withColumn("task", F.col("block") * parts + F.col("part"))
    dealt = dealt.repartition(min(blocks * parts, MOST_TASKS), "task").sortWithinPartitions("task", F.col("n").desc()).select("task", "code", "n")
    bounded_batches(vectors.sparkSession)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, codes, counts, index = None, [], [], None
        for batch in batches:
            tasks, rows, n = np.array(column(batch, "task")), np.array(column(batch, "code"), np.int64).view(np.uint64), np.array(column(batch, "n"))
            for task in np.unique(tasks):
                if task != now:
                    now, codes, counts, index = task, [], [], None
                own = tasks == task
                codes.append(rows[own & (n > 0)])
                counts.append(n[own & (n > 0)])
                queries = rows[own & (n == 0)]
                if len(queries) and index is None:  # a task's codes have all come by now
                    index = Index(np.concatenate(codes), np.concatenate(counts))
                q, found, far = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for one in queries if index is not None and len(index.codes) else ():
                    places, distances, _ = index.nearest(one, k + 1)
                    q.append(np.full(len(places), one))
                    found.append(index.codes[places])
                    far.append(distances)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (q, found, far)], names=["asked", "code", "distance"])

    near = dealt.mapInArrow(tidy(search), "asked long, code long, distance long")
    # of each distance only the least ids matter; the k + 1 nearest hold the k nearest others
    ids = near.join(few, "code").select("asked", "distance", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("asked").orderBy("distance", "vec_id")
    best = ids.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1).groupBy("asked").agg(F.array_sort(F.collect_list(F.struct("distance", "vec_id"))).alias("near"))
    mine = asked.withColumnRenamed("vec_id", "query_id").join(best, asked["code"] == best["asked"])
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = mine.select("query_id", F.posexplode(others).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).cast("long").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.distance").alias("distance"))


SQL = """
WITH b AS (SELECT vec_id, unnest(range(1, 65)) AS pos, coalesce(embedding[pos] > 0 AND NOT isnan(embedding[pos]), false) AS bit FROM embeddings WHERE embedding IS NOT NULL),
d AS (SELECT q.vec_id AS query_id, v.vec_id, count(*) FILTER (q.bit <> v.bit) AS distance FROM b q JOIN b v USING (pos) WHERE q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank, vec_id, distance FROM d
QUALIFY rank <= 10
"""
